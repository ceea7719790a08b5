"""Answers stored by block of a scan, to be looked up by a later scan of the same table.

A block is a file split. What its rows ask for is answered elsewhere, by tasks that see the
same question from all blocks; the answers are written to one folder per block, and the next
scan's task opens the folder of its own block. Texts never travel.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import work_dir


def block_of_scan() -> Column:
    """Number of the file split that a row is read from."""
    return F.xxhash64(F.input_file_name(), F.input_file_block_start())


def store_by_block(answers: DataFrame, name: str) -> str:
    """Write rows that have a column ``block``; gives the folder."""
    folder = work_dir(answers.sparkSession, name)
    answers.repartition("block").write.partitionBy("block").parquet(folder)
    return folder


def read_block(folder: str, block: int, columns: list[str]) -> pa.Table | None:
    """The stored rows of one block, in a task; ``None`` if there is no such folder."""
    store, path = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    place = f"{path}/block={block}"
    if store.get_file_info(place).type != fs.FileType.Directory:
        return None
    tables = []
    for file in store.get_file_info(fs.FileSelector(place)):
        if file.path.endswith(".parquet"):
            with store.open_input_file(file.path) as opened:
                tables.append(pq.read_table(opened, columns=columns))
    return pa.concat_tables(tables) if tables else None


def pack(data: bytes, level: int = 3) -> bytes:
    return zstandard.compress(data, level)


def unpack(blob: bytes) -> bytes:
    return zstandard.decompress(blob)
