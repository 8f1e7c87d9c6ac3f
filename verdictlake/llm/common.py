"""What several operators share: tables, written steps, words, local constants."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdictlake.session import work_path

Query = Callable[[SparkSession, str], DataFrame]

# Runs of anything but ASCII white space; the same in Java, RE2 and Python (where
# ``bytes.split()`` without arguments cuts the UTF-8 form at the same places).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: it cuts the lineage, any executor
    can read it, and values that depend on the run (row ids) are fixed by it."""
    path = work_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Steps written inside meet Python in Arrow batches of about ``most_bytes``: a
    batch is held on both sides, in buffers that grow by doubling. A batch has one
    row at least; the rows stay the same."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most_bytes)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_KEPT: dict[Hashable, Any] = {}


def worker_keeps(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept in this Python worker for all its tasks, until a
    task asks for something else: a worker holds one cache at a time, whichever
    stages have run in it."""
    if key not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _KEPT[key] = make()
    return _KEPT[key]


def fresh_name(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores until no column has it, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def boxed(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns an operator needs, and the whole row as ``_whole``: so columns
    of any name pass through it without meeting its own."""
    return docs.select(*[F.col(f"`{c}`") for c in needed], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole"))


def unboxed(rows: DataFrame, columns: Sequence[str], **replaced: Column) -> DataFrame:
    """The whole rows again, some columns replaced."""
    return rows.select(*[replaced.get(c, F.col("_whole").getField(c)).alias(c) for c in columns])


def word_count(text: str | Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other letter as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def constants(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table of fixed values as plan constants (no Python rows)."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    structs = [F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, (list, tuple)) else F.lit(v)).alias(n)
                          for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
