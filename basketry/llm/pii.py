"""Personal data by weak supervision, in DataFrame expressions only.

Candidates are spans of wide patterns for e-mail addresses, IP addresses, card numbers and
phone numbers. A candidate that is also a strict (base) match of its kind always counts as
personal data; the others (addresses written out with "at" and "dot", card numbers with a
wrong check digit, phone numbers without "+", ...) are what the method decides on.

Four labelers vote yes, no or nothing on every candidate: the strict pattern, a gazetteer
(top-level domains, card issuers, reserved networks), the words before the span, and its
format. Expectation-maximisation over the counts of vote patterns estimates how often each
labeler is right, per kind, without any label. Its posteriors then train the final span
classifier: a naive Bayes model over span features (votes, length, separators, what touches
the span). Vote patterns and features take few values, so the tables the driver gets are
bounded by their number (3**4 patterns a kind, and 15 feature values a kind), whatever the
size of the corpus; the counts behind them cover every candidate of every document.

A null text is treated as empty. Offsets are code points, end exclusive. Repeated rows get
equal results; rows of other columns are never touched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import free_name, own_names, tune

KINDS = ("email", "ip", "card", "phone")

# Base patterns, fixed by the definition of each kind. Possessive quantifiers and the guards
# in front keep matching linear and free of deep recursion; they do not change what matches:
# an address part that a search can enter only in its middle fails there as it fails at its
# start, and \\G admits the place right behind the last match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider candidates of each kind.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9-])[0-9]{4}+(?:[\x20-]?+[0-9]{4}+){2}+[\x20-]?+[0-9]{1,7}+(?![0-9-])",
    "phone": r"(?<![0-9.+])\(?[0-9]{2,4}+\)?[\x20.-]{1,2}+[0-9]{3,4}+[\x20.-][0-9]{3,4}+(?![0-9.])",
}
# A text without this cannot hold a candidate of the kind.
NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9]", "phone": r"[0-9]"}

# Gazetteers: fixed values.
DOMAINS = (
    "com", "org", "net", "edu", "gov", "info", "io", "co", "us", "uk", "de", "fr", "es", "it", "nl",
    "eu", "ch", "at", "be", "ca", "au", "br", "mx", "jp", "cn", "in", "ru", "pl", "se", "no", "dk", "fi",
)
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|62|35)"
RESERVED = r"^(?:0|10|127|192\.168|169\.254|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
SERVICES = r"^\+?1?[^0-9]*(?:800|888|900)"
CUES = {
    "email": r"(?i)(?:mail|contact|write|from|to|correo|kontakt)\W*$",
    "ip": r"(?i)(?:\bip|address|host|server|addr|adresse|from)\W*$",
    "card": r"(?i)(?:card|visa|mastercard|credit|cc|tarjeta|carte|karte|number|no)\W*$",
    "phone": r"(?i)(?:phone|tel|telephone|call|mobile|fax|cell|tél|teléfono|telefon)\W*$",
}
AGAINST = r"(?i)(?:version|v\.?|isbn|issn|license|licence|order|invoice|section|id|hash|token|key|page|figure)\W*$"

# A wide candidate counts as personal data from this probability on. Marking what is none
# costs text, and the strict spans stay in any case, so the bar is high.
LEAST = 0.95

LABELERS = ("strict", "gazetteer", "context", "format")
SPAN = "struct<kind:string,s:bigint,e:bigint,base:boolean,votes:array<int>,feats:array<int>>"


def _found(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their places: array of (``m``, ``s``, ``e``)."""
    # The texts between matches give the places: a match starts where they and the earlier
    # matches end. There is one more of them than of matches.
    zipped = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
        lambda m, g: F.struct(m.alias("m"), g.alias("g")),
    )
    zipped = F.filter(zipped, lambda x: x["m"].isNotNull())
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<m:string,s:bigint,e:bigint>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["g"])
        e = s + F.length(x["m"])
        span = F.struct(x["m"].alias("m"), s.cast("bigint").alias("s"), e.cast("bigint").alias("e"))
        return F.struct(e.cast("bigint").alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a text of digits is right."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    """Whether a base match passes the further rules of its kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: _at_most_255(p))
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(m))).otherwise(False)
    return n.between(10, 15)


def _at_most_255(part: Column) -> Column:
    """Whether a part's value is at most 255, however many zeros lead it."""
    digits = F.regexp_replace(part, "^0+", "")
    return F.when(F.length(digits) > 3, False).when(digits == "", True).otherwise(digits.cast("int") <= 255)


def base_spans(text: Column, kind: str) -> Column:
    """Strict matches of a kind: leftmost, not overlapping, failing ones dropped."""
    none = F.array().cast("array<struct<m:string,s:bigint,e:bigint>>")
    some = F.filter(_found(text, BASE[kind]), lambda x: _valid(kind, x["m"]))
    return F.when(text.rlike(NEEDS[kind]), some).otherwise(none)


def _votes(kind: str, text: Column, x: Column, strict: Column) -> list[Column]:
    """1 yes, 0 no, -1 no opinion; in the order of ``LABELERS``."""
    m, none = x["m"], F.lit(-1)
    before = F.substring(text, F.greatest(x["s"].cast("int") - 23, F.lit(1)), F.least(x["s"].cast("int"), F.lit(24)))
    context = F.when(before.rlike(AGAINST), 0).when(before.rlike(CUES[kind]), 1).otherwise(none)
    if kind == "email":
        top = F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))
        gazetteer = F.when(top.isin(*DOMAINS), 1).when(F.length(top) < 2, 0).otherwise(none)
        form = F.when(m.rlike(r"^[A-Za-z0-9]") & top.rlike("^[A-Za-z]"), 1).otherwise(0)
    elif kind == "ip":
        gazetteer = F.when(m.rlike(RESERVED), 0).otherwise(1)
        form = F.when(m.rlike(r"(?:^|\.)0[0-9]"), 0).otherwise(1)
    elif kind == "card":
        gazetteer = F.when(_digits(m).rlike(ISSUERS), 1).otherwise(0)
        form = F.when(F.length(_digits(m)).isin(15, 16), 1).otherwise(0)
    else:
        gazetteer = F.when(m.rlike(SERVICES), 0).otherwise(none)
        form = F.when(F.length(_digits(m)).between(9, 13) & m.rlike(r"[\x20().-]"), 1).otherwise(0)
    return [c.cast("int") for c in (strict.cast("int"), gazetteer, context, form)]


def _features(text: Column, x: Column) -> list[Column]:
    """Small numbers that describe a span: length, separators, what touches it."""
    length = F.least(F.floor((x["e"] - x["s"]) / 6), F.lit(5)).cast("int")
    separators = F.least(F.length(F.regexp_replace(x["m"], r"[A-Za-z0-9]", "")), F.lit(5)).cast("int")
    left = F.substring(text, x["s"].cast("int"), F.lit(1))
    right = F.substring(text, x["e"].cast("int") + 1, F.lit(1))
    glued = ((x["s"] > 0) & left.rlike(r"[\p{L}\p{N}_]")) | right.rlike(r"[\p{L}\p{N}_]")
    return [length, separators, F.coalesce(glued, F.lit(False)).cast("int")]


def candidates(text: Column) -> Column:
    """All candidate spans of a text, strict ones first, each with votes and features."""
    text = F.coalesce(text, F.lit(""))
    strict = {k: base_spans(text, k) for k in KINDS}

    def described(kind: str, spans: Column, base: bool) -> Column:
        return F.transform(
            spans,
            lambda x: F.struct(
                F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.lit(base).alias("base"),
                F.array(*_votes(kind, text, x, F.lit(base))).alias("votes"),
                F.array(*_features(text, x)).alias("feats"),
            ).cast(SPAN),
        )

    parts = [described(k, strict[k], True) for k in KINDS]
    for kind in KINDS:
        wide = F.when(text.rlike(NEEDS[kind]), _found(text, WIDE[kind])).otherwise(
            F.array().cast("array<struct<m:string,s:bigint,e:bigint>>")
        )
        parts.append(described(kind, wide, False))
    return F.concat(*parts)


def _fresh(spans: Column) -> Column:
    """Without the wide candidates that overlap a strict span."""
    return F.filter(
        spans,
        lambda x: x["base"] | ~F.exists(spans, lambda y: y["base"] & (x["s"] < y["e"]) & (y["s"] < x["e"])),
    )


def with_candidates(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the array of candidate spans in the new column ``name``."""
    tune(docs.sparkSession)
    return docs.withColumn(name, candidates(docs["text"])).withColumn(name, _fresh(F.col(name)))


@dataclass
class SpanModel:
    """What the method has learned: log odds of each feature value per kind."""

    reliability: dict[str, list[tuple[float, float]]] = field(default_factory=dict)
    odds: dict[str, float] = field(default_factory=dict)
    prior: dict[str, float] = field(default_factory=dict)


def _em(patterns: dict[tuple[int, ...], int], rounds: int = 50):
    """Dawid-Skene with two classes on counts of vote patterns of one kind.

    Returns (posterior of each pattern, rates of "yes" among true and among false spans).
    Starts from the belief that labelers are right four times in five.
    """
    rates = [(0.8, 0.2)] * len(LABELERS)
    prior = 0.5
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes in patterns:
            log = math.log(prior / (1 - prior))
            for v, (yes, no) in zip(votes, rates):
                if v >= 0:
                    log += math.log(yes / no) if v else math.log((1 - yes) / (1 - no))
            posterior[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        total = sum(patterns.values())
        prior = (1 + sum(n * posterior[v] for v, n in patterns.items())) / (2 + total)
        rates = []
        for j in range(len(LABELERS)):
            seen = [(v[j], n * posterior[v], n * (1 - posterior[v])) for v, n in patterns.items() if v[j] >= 0]
            yes = (4 + sum(t for v, t, _ in seen if v)) / (5 + sum(t for _, t, _ in seen))
            no = (1 + sum(f for v, _, f in seen if v)) / (5 + sum(f for _, _, f in seen))
            rates.append((yes, no))
    return posterior, rates, prior


def fit(docs: DataFrame) -> SpanModel:
    """Reliabilities of the labelers, and the final span classifier, from all candidates."""
    plain = own_names(docs, "doc_id", "text")
    spans = with_candidates(plain, "_spans").select(F.explode("_spans").alias("x"))
    counted = spans.groupBy("x.kind", "x.votes", "x.feats").agg(F.count(F.lit(1)).alias("n")).collect()
    model = SpanModel()
    for kind in KINDS:
        rows = [(tuple(r["votes"]), tuple(r["feats"]), r["n"]) for r in counted if r["kind"] == kind]
        patterns: dict[tuple[int, ...], int] = {}
        for votes, _, n in rows:
            patterns[votes] = patterns.get(votes, 0) + n
        posterior, rates, prior = _em(patterns)
        model.reliability[kind] = rates
        model.prior[kind] = math.log(prior / (1 - prior))
        # Naive Bayes over votes and features, weighted by the posteriors.
        true: dict[tuple[int, int], float] = {}
        false: dict[tuple[int, int], float] = {}
        for votes, feats, n in rows:
            for at, value in enumerate((*votes, *feats)):
                true[at, value] = true.get((at, value), 0.0) + n * posterior[votes]
                false[at, value] = false.get((at, value), 0.0) + n * (1 - posterior[votes])
        yes, no = sum(n * posterior[v] for v, _, n in rows), sum(n * (1 - posterior[v]) for v, _, n in rows)
        for at, value in true:
            odds = math.log((true[at, value] + 1) / (yes + 6)) - math.log((false[at, value] + 1) / (no + 6))
            model.odds[f"{kind}:{at}:{value}"] = odds
    return model


def _accepted(spans: Column, model: SpanModel) -> Column:
    """Strict spans, and those wide ones that the classifier takes for personal data."""
    table = F.create_map(*[F.lit(v) for pair in model.odds.items() for v in pair]) if model.odds else None

    def score(x: Column) -> Column:
        prior = F.lit(0.0)
        for kind, value in model.prior.items():
            prior = F.when(x["kind"] == kind, F.lit(value)).otherwise(prior)
        values = F.concat(x["votes"], x["feats"])
        at = F.sequence(F.lit(0), F.size(values) - 1)
        terms = F.transform(
            at, lambda i: F.coalesce(table[F.concat_ws(":", x["kind"], i.cast("string"), values[i].cast("string"))], F.lit(0.0))
        )
        return prior + F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)

    if table is None:
        return F.filter(spans, lambda x: x["base"])
    return F.filter(spans, lambda x: x["base"] | (score(x) >= math.log(LEAST / (1 - LEAST))))


def _ordered(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    order = F.lit(len(KINDS))

    def rank(x: Column) -> Column:
        out = order
        for i, kind in enumerate(KINDS):
            out = F.when(x["kind"] == kind, F.lit(i)).otherwise(out)
        return out

    keyed = F.transform(spans, lambda x: F.struct(x["s"].alias("s"), rank(x).alias("r"), x["e"].alias("e"), x["kind"].alias("kind")))
    return F.array_sort(keyed)


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def find(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """Rows (``doc_id``, counts per kind, ``base_sha256``, ``spans``), one per input row.

    The counts and the digest are those of the strict spans, ``spans`` lists all.
    """
    model = model or fit(docs)
    found = with_candidates(own_names(docs, "doc_id", "text"), "_spans").select("doc_id", "_spans")
    base = F.filter("_spans", lambda x: x["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(_listed(_ordered(base)), 256).alias("base_sha256"),
        _listed(_ordered(_accepted(F.col("_spans"), model))).alias("spans"),
    )


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, such as ``[EMAIL]``.

    Overlapping spans are replaced together, under the kind of the first. A column
    ``n_chars`` follows the new text.
    """
    model = model or fit(docs)
    name = free_name(docs, "pii_spans")
    found = with_candidates(docs, name)
    spans = _ordered(_accepted(F.col(name), model))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    text = docs["text"]

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(x["s"] - acc["at"], F.lit(0)).cast("int"))
        mark = F.when(x["s"] >= acc["at"], F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    clean = F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))
    changed = found.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn(
            "n_chars", F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind))
        )
    return changed.select(*[f"`{c}`" for c in docs.columns])
