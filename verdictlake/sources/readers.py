"""Readers with explicit schemas, and the flat forms of nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from verdictlake.schemas import SCHEMAS

# Suffixes that make a string path a file upload.
FILE_SUFFIXES = ["wav", "mp3", "m4a", "ogg", "flac", "webm", "aac", "aiff", "png", "jpg",
                 "jpeg", "gif", "webp", "pdf", "docx", "pptx", "xlsx"]
ROLES = ["user", "agent"]


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A contract table with its declared schema; fields it does not name are
    dropped, fields the files lack read as NULL."""
    return spark.read.schema(SCHEMAS[name]).format(fmt).load(path)


def _rescued(entries: list[Column]) -> Column:
    """JSON of the entries that hold something, NULL without any."""
    text = F.to_json(F.struct(*entries)) if entries else F.lit(None).cast("string")
    return F.nullif(text, F.lit("{}"))


def project_known(df: DataFrame, schema: StructType, rescued: str | None = None) -> DataFrame:
    """Keep the columns a schema knows, in its order, and drop the rest, so
    tables written by newer producers stay readable.

    With ``rescued`` nothing goes unseen: values are cast to the schema's types,
    and a column of that name holds, as JSON, the fields the schema does not know
    and the values that do not fit their type.
    """
    if rescued is None:
        return df.select([F.col(f.name) for f in schema.fields if f.name in df.columns])
    given, known, kept = {f.name: f.dataType for f in df.schema.fields}, {f.name for f in schema.fields}, []
    entries = [F.col(f"`{name}`").alias(name) for name in given if name not in known]
    for field in schema.fields:
        if field.name not in given:
            continue
        value = F.col(f"`{field.name}`")
        if given[field.name] == field.dataType:
            kept.append(value)
            continue
        simple = not any(isinstance(t, (ArrayType, MapType, StructType, VariantType)) for t in (given[field.name], field.dataType))
        fitted = value.try_cast(field.dataType) if simple else F.lit(None).cast(field.dataType)
        kept.append(fitted.alias(field.name))
        entries.append(F.when(fitted.isNull(), value).alias(field.name))
    return df.select(*kept, _rescued(entries).alias(rescued))


def read_rescued(spark: SparkSession, name: str, path: str, rescued: str = "_rescued") -> DataFrame:
    """A contract table of JSON lines with its declared schema, and what it does
    not hold: unknown fields, values of another type, and whole lines that are no
    JSON object (under ``_line``), as JSON in the column ``rescued``."""
    schema = StructType.fromDDL(SCHEMAS[name])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema).alias("row"), F.from_json("value", "map<string,variant>").alias("given"))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    filled = F.array(*[F.when(F.col(f"row.{f.name}").isNotNull(), F.lit(f.name)) for f in schema.fields])
    left = F.map_filter("given", lambda k, v: ~F.is_variant_null(v) & ~(F.array_contains(known, k) & F.coalesce(F.array_contains(filled, k), F.lit(False))))
    whole = F.to_json(F.struct(F.col("value").alias("_line")))
    shown = F.when(F.col("given").isNull(), whole).when(F.size(left) > 0, F.to_json(left))
    return parsed.select(*[F.col(f"row.{f.name}").alias(f.name) for f in schema.fields], shown.alias(rescued))


def flatten_transcripts(documents: DataFrame) -> DataFrame:
    """Turns of nested transcripts: dense ``turn_idx`` and a role check. A long
    conversation may come in parts; ``first_turn`` says where a part begins."""
    first = F.coalesce("first_turn", F.lit(0)) if "first_turn" in documents.columns else F.lit(0)
    return (documents.select("rollout_id", first.alias("first"), F.posexplode("transcript").alias("pos", "t"))
            .select("rollout_id", (F.col("first") + F.col("pos")).alias("turn_idx"), "t.role", "t.content",
                    "t.audio_url", F.coalesce(F.col("t.role").isin(ROLES), F.lit(False)).alias("role_ok")))


def read_transcripts(spark: SparkSession, path: str, fmt: str = "json",
                     schema: str = SCHEMAS["transcripts"]) -> DataFrame:
    return flatten_transcripts(spark.read.schema(schema).format(fmt).load(path))


def flatten_tool_events(documents: DataFrame) -> DataFrame:
    """Tool events of nested documents; ``seq`` defaults to the list position,
    ``external`` and ``is_error`` to false, ``turn_idx`` stays as recorded."""
    e = F.col("e")
    return (documents.select("rollout_id", F.posexplode("tool_events").alias("pos", "e"))
            .select("rollout_id", F.coalesce(e["seq"], F.col("pos")).alias("seq"), e["turn_idx"].alias("turn_idx"),
                    e["name"].alias("name"), e["input"].alias("input"), e["output"].alias("output"),
                    F.coalesce(e["is_error"], F.lit(False)).alias("is_error"),
                    F.coalesce(e["external"], F.lit(False)).alias("external")))


def read_tool_events(spark: SparkSession, path: str, fmt: str = "json",
                     schema: str = SCHEMAS["transcripts"]) -> DataFrame:
    return flatten_tool_events(spark.read.schema(schema).format(fmt).load(path))


def chat_messages(turns: DataFrame, page_size: int = 1000) -> DataFrame:
    """Chat-API messages (``agent`` becomes ``assistant``), one ordered array per
    rollout and page of ``page_size`` turns. A recorded conversation fits page 0;
    longer ones continue on further pages, so no group is unbounded."""
    role = F.when(F.col("role") == "agent", "assistant").otherwise(F.col("role"))
    message = F.struct("turn_idx", role.alias("role"), "content")
    return (turns.withColumn("page", F.floor(F.col("turn_idx") / page_size).cast("int"))
            .groupBy("rollout_id", "page").agg(F.sort_array(F.collect_list(message)).alias("m"))
            .select("rollout_id", "page", F.transform(
                "m", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages")))


def is_file_name(path: Column) -> Column:
    """True for a path whose last component ends in a known file suffix."""
    return F.lower(path).rlike(r"[^/]\.(?:" + "|".join(FILE_SUFFIXES) + r")/*$")


def read_seed_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` as seed rows, contents as bytes."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("seed_id"), F.element_at(F.split("path", "/"), -1).alias("filename"),
                    F.col("content").alias("bytes"), "length"))


def ingest_seeds(seeds: DataFrame, chunk_size: int = 1000) -> DataFrame:
    """Classify seeds (``seed_id, filename, text``) as JSON or file by suffix and
    count the ``chunk_size``-character chunks their text splits into (ours)."""
    return seeds.select("seed_id", F.when(is_file_name(F.col("filename")), "file").otherwise("json").alias("carrier"),
                        F.greatest(F.lit(1), F.ceil(F.length("text") / chunk_size)).alias("chunks"))


def seed_chunks(seeds: DataFrame, chunk_size: int = 1000) -> DataFrame:
    """The chunks themselves, whole text, one row each; no shuffle."""
    n = F.greatest(F.lit(1), F.ceil(F.length("text") / chunk_size)).cast("int")
    return (seeds.select("seed_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
            .select("seed_id", "chunk", F.substring(F.col("text"), F.col("chunk") * chunk_size + 1,
                                                    F.lit(chunk_size)).alias("content")))
