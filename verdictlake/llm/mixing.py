"""Mixing sources to target weights, with DataFrame functions only.

Every source gets a share of the mixed words. Its rows get hash-random keys and
are sorted by them in ranges (blocks of the key space, as many as the source has
thousands of rows, so a source with a third of all rows is spread over many
tasks). Prefix sums of word counts over the ranges say where the source's exact
budget is spent; a source whose budget exceeds its size starts another epoch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdictlake.llm.common import WORD, boxed, table, unboxed, word_count, written
from verdictlake.operators.ordered import prefix_sums

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
KEY_BITS = 60
BLOCK_ROWS = 2048


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source (``_s``): rows, words, weight and target in words.

    ``share`` times all words is dealt by weight; a target stops at ``max_epochs``
    times its source's words and the excess goes to the others. The water level
    is found in closed form: with sources sorted by the level at which they fill
    up, the level if all earlier ones are full rises up to the first source that
    is not, then falls, so the largest one is the level. One row per source.
    """
    totals = sizes.groupBy("_s").agg(F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy("_s")
    by_level = Window.partitionBy(F.lit(0)).orderBy(F.col("_cap") / F.col("_w"), "_s")
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighted = totals.select("*", F.element_at(F.array(*map(F.lit, weights)), place).cast("double").alias("_w"),
                             (F.col("_words") * F.lit(float(max_epochs))).alias("_cap"))
    filled = F.coalesce(F.sum("_cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("_w").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("_words").over(everything) * F.lit(share) - filled) / open_weight
    return (weighted.withColumn("_level", level)
            .withColumn("_level", F.max("_level").over(everything))
            .select("_s", "_rows", "_words", "_w",
                    F.least("_cap", F.col("_level") * F.col("_w")).alias("_target")))


def random_key(doc_id: str | Column) -> Column:
    """The first 60 bits of the id's MD5: uniform, and the same on every run."""
    digest = F.md5(F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def mix(docs: DataFrame, *, size: Column | None = None, doc_id: str = "doc_id", source: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``_mix``: struct(size, source_size, target, taken) to every row.

    ``size`` defaults to the words of column ``text``. A row's ``taken`` is its
    size times the whole epochs of its source, plus what the last, cut epoch
    reaches of it: the rows of a source in key order until its budget (target,
    rounded down) is spent, the row at the cut in part. So a source takes exactly
    its budget and no row more than ``max_epochs`` times its size.

    A null source is a source of its own, sorted last; null or empty texts have
    size 0 and take 0; a null id has a fixed key; rows with equal ids are ordered
    by size, equal rows share what falls to them in any order. An empty table
    gives an empty result. Other columns, of any name, pass through; an input
    column ``_mix`` is replaced.
    """
    work = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "_mix"]).alias("_row"),
        F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source))).alias("_s"),
        (word_count("text") if size is None else size).alias("_size"), random_key(doc_id).alias("_key"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"))
    # Written first: a row per source, whose size is then known, so that a hot
    # source's rows are not dealt by source to meet it unless sources abound.
    targets = written(source_targets(work, weights, share, max_epochs), "mix-targets")
    bits = F.greatest(F.lit(0), F.least(F.lit(KEY_BITS), F.ceil(F.log2(F.col("_rows") / F.lit(BLOCK_ROWS))))).cast("int")
    ranged = work.join(targets, "_s").withColumn("_range_bits", bits)
    summed = prefix_sums(ranged, ["_s"], ["_key", "_id", "_size"],
                         F.expr(f"shiftright(_key, {KEY_BITS} - _range_bits)"), _before=F.col("_size"))
    budget = F.floor("_target").cast("bigint")
    epochs = F.when(F.col("_words") > 0, F.expr("floor(_target) div _words")).otherwise(F.lit(0)).cast("bigint")
    rest = F.greatest(F.lit(0), budget - epochs * F.col("_words") - F.col("_before"))
    taken = epochs * F.col("_size") + F.least("_size", rest)
    return summed.select("_row.*", F.struct(
        F.col("_size").alias("size"), F.col("_words").alias("source_size"), F.col("_target").alias("target"),
        taken.cast("bigint").alias("taken")).alias("_mix"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row per epoch that takes it, with its columns.

    A document that the cut epoch reaches in part is shortened there to its first
    words, joined by one space, and ``n_chars`` follows. Documents that take no
    word are left out, which includes those without any (null and empty texts).
    Texts of any length are cut whole words apart; repeated rows are mixed each by
    itself; an empty table stays empty. All other columns stay as they are,
    whatever their names.
    """
    mixed = mix(boxed(docs, "doc_id", "source", "text"), **options)
    size, taken = F.col("_mix.size"), F.col("_mix.taken")
    again = mixed.filter(taken > 0).withColumn(
        "_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((taken - 1) / size).cast("bigint"))))
    words = F.least(size, taken - F.col("_epoch") * size)
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words.cast("int")), " ")
    again = again.withColumn("text", F.when(words < size, cut).otherwise(F.col("text")))
    replaced = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.when(words < size, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_whole").getField("n_chars"))
    return unboxed(again, docs.columns, **replaced)


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of 150% of all words."""
    sizes = written(table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size")),
                    "mix-sizes")
    return mix(sizes, size=F.col("size")).select("doc_id", "_mix.*")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS s,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(COALESCE(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS key
  FROM documents),
t AS (SELECT s, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY s),
w AS (SELECT s, words, words * 2.0::DOUBLE AS cap,
             CAST(CASE (row_number() OVER (ORDER BY s) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight
      FROM t),
l AS (SELECT *, (CAST(sum(words) OVER () AS DOUBLE) * 1.5::DOUBLE
                 - COALESCE(sum(cap) OVER (ORDER BY cap / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
g AS (SELECT s, words, least(cap, max(level) OVER () * weight) AS target FROM l),
p AS (SELECT d.doc_id, d.size, g.words, g.target,
             CASE WHEN g.words > 0 THEN CAST(floor(g.target) AS BIGINT) // g.words ELSE 0 END AS epochs,
             CAST(COALESCE(sum(d.size) OVER (PARTITION BY d.s ORDER BY d.key, CAST(d.doc_id AS VARCHAR), d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM d JOIN g ON d.s = g.s)
SELECT doc_id, size, words AS source_size, target,
       CAST(epochs * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - epochs * words - before)) AS BIGINT) AS taken
FROM p"""
