"""Text cleaning and client-id rules as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schemas import DETAIL

# Every character Unicode counts as white space, plus the four
# separator control characters.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Test and placeholder ids that belong to no person.
GENERIC_IDS = (
    "0",
    "1",
    "12345",
    "123456",
    "1234567",
    "12345678",
    "123456789",
    "1234567890",
    "111111",
    "1111111",
    "11111111",
    "111111111",
    "1111111111",
    "222222",
    "2222222",
    "22222222",
    "222222222",
    "2222222222",
    "333333",
    "3333333",
    "33333333",
    "333333333",
    "3333333333",
    "444444",
    "4444444",
    "44444444",
    "444444444",
    "4444444444",
    "555555",
    "5555555",
    "55555555",
    "555555555",
    "5555555555",
    "666666",
    "6666666",
    "66666666",
    "666666666",
    "6666666666",
    "777777",
    "7777777",
    "77777777",
    "777777777",
    "7777777777",
    "888888",
    "8888888",
    "88888888",
    "888888888",
    "8888888888",
    "999999",
    "9999999",
    "99999999",
    "999999999",
    "9999999999",
)

MIN_ID_LENGTH, MAX_ID_LENGTH = 6, 10


def strip(col: Column | str) -> Column:
    """Remove all leading and trailing white space, not only blanks as ``trim`` does."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(WHITESPACE))


def is_digits(col: Column) -> Column:
    return col.rlike("^[0-9]+$")


def is_one_repeated_character(col: Column) -> Column:
    return col.rlike(r"^(.)\1*$")


def id_rejection_reason(
    col: Column, min_length: int = MIN_ID_LENGTH, max_length: int = MAX_ID_LENGTH
) -> Column:
    """Name of the first rule a stripped id breaks, null when it is valid."""
    return (
        F.when(col.isNull() | ~is_digits(col), "not_digits")
        .when(col.startswith("0"), "leading_zero")
        .when(~F.length(col).between(min_length, max_length), "bad_length")
        .when(col.isin(*GENERIC_IDS), "generic")
        .when(is_one_repeated_character(col), "repeated")
    )


def is_valid_id(
    col: Column, min_length: int = MIN_ID_LENGTH, max_length: int = MAX_ID_LENGTH
) -> Column:
    """Whether a stripped id breaks no rule: one pattern and one set lookup per row."""
    pattern = rf"^(?!(.)\1*$)[1-9][0-9]{{{min_length - 1},{max_length - 1}}}$"
    return col.rlike(pattern) & ~col.isin(*GENERIC_IDS)


# A quoted string as one unit; whatever precedes a bare word consists of such units.
QUOTED = r"""'(?:\\.|[^'\\]++)*+'|"(?:\\.|[^"\\]++)*+\""""


def _replaced_where(present: Callable[[Column], Column], pattern: str, by: str) -> Callable[[Column], Column]:
    """Replacement that leaves texts alone, at the price of one look, where nothing can match."""
    return lambda text: F.when(present(text), F.regexp_replace(text, pattern, by)).otherwise(text)


def parse_literal_list(col: Column | str, element: T.StructType = DETAIL) -> Column:
    """Array of structs from the text of a Python list of dicts.

    Single quotes are accepted; bare ``None``, ``True`` and ``False`` become their JSON
    words, and a comma before a closing bracket is dropped. Text inside quotes stays as it
    is. Unreadable or missing text gives an empty array.
    """
    text = F.col(col) if isinstance(col, str) else col
    # One-element arrays, so that each step's text is worked out once.
    steps = F.array(text)
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        bare = rf"\G((?:{QUOTED}|[^'\"{word[0]}]++|{word[0]}(?!{word[1:]}\b))*+){word}"
        steps = F.transform(steps, _replaced_where(lambda t, w=word: t.contains(w), bare, f"$1{json_word}"))
    comma = rf"\G((?:{QUOTED}|[^'\",]++|,(?!\s*[\]}}]))*+),(?=\s*[\]}}])"
    steps = F.transform(steps, _replaced_where(lambda t: t.rlike(r",\s*[\]}]"), comma, "$1"))
    text = steps[0]
    kind = T.ArrayType(element)
    return F.coalesce(F.from_json(text, kind), F.array().cast(kind))
