"""Run configurations as a table: validation, precedence, policy and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per section its keys; per key the type, then a number's range.
SECTIONS = {
    "": {"version": ("integer", 1, 1), "agent": ("mapping",), "run": ("mapping",), "thresholds": ("mapping",),
         "baseline": ("mapping",), "telemetry": ("mapping",), "output": ("text",)},
    "agent": {"entrypoint": ("text",), "meta": ("mapping",)},
    "run": {"dataset": ("dataset",), "max_turns": ("integer", 2, 40), "concurrency": ("integer", 1, None),
            "repeats": ("integer", 1, 5), "timeout_minutes": ("number", 1, None)},
    "thresholds": {"pass_rate": ("number", 0, 1), "min_scenarios": ("integer", 1, None)},
    "baseline": {"branch": ("text",), "max_regression": ("number", 0, 1)},
    "telemetry": {"redact": ("mapping",)},
    "telemetry.redact": {"enabled": ("boolean",), "patterns": ("texts",)},
}
ROOT = "\x00root"  # stands for the whole text among the keys
DATASET_ID = "^ds_[a-z0-9]+$"
DEFAULTS = {"max_turns": 12, "concurrency": 4, "repeats": 1, "timeout_minutes": 30.0,
            "min_scenarios": 1, "baseline_branch": "main"}


def _literal_map(items: dict[str, Column]) -> Column:
    return F.create_map(*[c for key, value in items.items() for c in (F.lit(key), value)])


def _entries_to_check(run_configs: DataFrame) -> DataFrame:
    """(run, section, key, value) for every key of every section, and a NULL
    value for each required key that is missing."""
    entries = "map<string,variant>"
    root = run_configs.select("run_id", "raw_config", F.from_json("raw_config", entries).alias("root"))
    stated = F.col("root").isNull() & F.col("raw_config").isNotNull() & ~F.col("raw_config").rlike(r"^\s*$")
    readable = F.when(stated, F.try_parse_json("raw_config").isNotNull()).otherwise(True)

    def inside(parent: Column, key: str) -> Column:
        return F.try_variant_get(F.try_element_at(parent, F.lit(key)), "$", entries)

    def absent(parent: Column, key: str) -> Column:
        known = F.coalesce(F.map_contains_key(parent, key), F.lit(False))
        return F.when(~known & F.col("readable"), F.create_map(F.lit(key), F.lit(None).cast("variant")))

    whole = F.when(stated, F.create_map(F.lit(ROOT), F.try_parse_json("raw_config")))
    split = root.select("run_id", "root", readable.alias("readable"), whole.alias("whole"), *[inside(F.col("root"), k).alias(k) for k in SECTIONS if k and "." not in k])
    split = split.withColumn("redact", inside(F.col("telemetry"), "redact"))
    parts = {"": "root", **{k: k for k in SECTIONS if k and "." not in k}, "telemetry.redact": "redact"}
    listed = [(F.lit(section), F.col(column)) for section, column in parts.items()]
    listed += [(F.lit(""), F.col("whole")), (F.lit(""), absent(F.col("root"), "version")), (F.lit("agent"), absent(F.col("agent"), "entrypoint"))]
    sections = F.array(*[F.struct(name.alias("section"), keys.alias("keys")) for name, keys in listed])
    return (split.select("run_id", F.inline(sections))
            .select("run_id", "section", F.explode("keys").alias("key", "value")))


def config_violations(run_configs: DataFrame) -> DataFrame:
    """One row per (run, dotted path, issue) of ``raw_config`` (JSON text).

    The text is parsed once and opened into one row per key; the rules are a
    small literal table each row looks itself up in. Unknown keys are fatal at
    every level. A text that cannot be parsed has one issue at the empty path, a
    root that is no mapping one beside those of its missing keys; a blank text is
    an empty mapping. There is no shuffle.
    """
    rules = {f"{s}.{k}" if s else k: F.struct(
        F.lit(rule[0]).alias("type"), F.lit(rule[1] if len(rule) > 1 else None).cast("int").alias("low"),
        F.lit(rule[2] if len(rule) > 2 else None).cast("int").alias("high"))
        for s, keys in {**SECTIONS, "": {**SECTIONS[""], ROOT: ("mapping",)}}.items() for k, rule in keys.items()}
    allowed = {s: F.lit(f"unknown key (allowed: {', '.join(keys)})") for s, keys in SECTIONS.items()}
    path = F.when(F.col("section") == "", F.col("key")).otherwise(F.concat_ws(".", "section", "key"))
    kind_text = F.substring_index(F.substring_index(F.schema_of_variant("value"), "<", 1), "(", 1)
    kind = F.col("kind")
    numeric, whole = kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), kind == "BIGINT"
    rows = (_entries_to_check(run_configs)
            .select("run_id", "section", path.alias("path"), "value", kind_text.alias("stated"))
            .select("*", F.nullif("stated", F.lit("VOID")).alias("kind"),
                    F.try_element_at(_literal_map(rules), F.col("path")).alias("rule"))
            # Values are taken out only where their type allows it.
            .select("*", F.when(numeric, F.try_variant_get("value", "$", "double")).alias("number"),
                    F.when(kind == "STRING", F.try_variant_get("value", "$", "string")).alias("text"),
                    F.when(kind == "ARRAY", F.try_variant_get("value", "$", "array<variant>")).alias("items")))

    number, text = F.col("number"), F.col("text")
    wanted, low, high = F.col("rule.type"), F.col("rule.low"), F.col("rule.high")
    mixed = F.exists("items", lambda p: F.schema_of_variant(p) != "STRING")
    # Issue texts. One value has one issue, the first that applies.
    issue = (F.when(F.col("rule").isNull(), F.try_element_at(_literal_map(allowed), F.col("section")))
             .when((F.col("path") == ROOT) & F.col("stated").isNull(), "not a valid document")
             .when((wanted == "mapping") & (kind != "OBJECT"), "expected a mapping")
             .when(wanted.isin("integer", "number") & ~numeric, "expected a number")
             .when((wanted == "integer") & ~whole, "expected an integer")
             .when((F.col("path") == "version") & ~F.coalesce(number == 1, F.lit(False)), "must be 1")
             .when(number < low, F.concat(F.lit("must be >= "), low))
             .when(number > high, F.concat(F.lit("must be <= "), high))
             .when(wanted.isin("text", "dataset") & ((kind != "STRING") | text.rlike(r"^\s*$")),
                   "expected a non-empty string")
             .when((wanted == "dataset") & ~text.rlike(DATASET_ID), "expected a ds_… dataset id")
             .when((F.col("path") == "agent.entrypoint") & kind.isNull(), "required (path to your RolloutAgent module)")
             .when((wanted == "boolean") & (F.col("stated") != "BOOLEAN"), "expected true or false")
             .when((wanted == "texts") & ((kind != "ARRAY") | mixed), "expected a list of regex strings"))
    # A version of the wrong type is, beside that, not 1. The filter is on the
    # exploded column, where it cannot be pushed down and repeat the rules.
    second = F.when((F.col("path") == "version") & kind.isNotNull() & ~whole, "must be 1")
    shown = F.when(F.col("path") == ROOT, "").otherwise(F.col("path")).alias("path")
    return (rows.select("run_id", shown, F.explode(F.array(issue, second)).alias("issue"))
            .filter("issue IS NOT NULL"))


def merge_config(rows: DataFrame) -> DataFrame:
    """Resolve each setting: ``flag_<name>`` over ``file_<name>`` over default."""
    names = sorted({c.removeprefix("file_") for c in rows.columns if c.startswith("file_")})
    settled = {}
    for name in names:
        sources = [F.col(c) for c in (f"flag_{name}", f"file_{name}") if c in rows.columns]
        if name in DEFAULTS:
            sources.append(F.lit(DEFAULTS[name]))
        settled[name] = F.coalesce(*sources)
    kept = [c for c in rows.columns if not c.startswith(("flag_", "file_"))]
    return rows.select(*kept, *[c.alias(n) for n, c in settled.items()])


def apply_policy(run_configs: DataFrame, ci_policy: DataFrame) -> DataFrame:
    """Apply the organisation's default, floor and cap per session; the changes
    are listed in ``warnings``. Neither rate nor default: ``config_error``."""
    joined = run_configs.join(ci_policy, "session_id", "left")
    rate, cap = F.col("pass_rate"), F.col("max_concurrency")
    floor, default = F.col("pass_rate_floor"), F.col("default_pass_rate")
    stated = F.coalesce(rate, default)

    def note(when: Column, *parts) -> Column:
        texts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
        return F.when(when, F.concat(*texts))

    # Warning texts.
    warnings = F.array_compact(F.array(
        note(rate.isNull() & default.isNotNull(),
             "thresholds.pass_rate not set — using your organization's default (", default, ")"),
        note(stated < floor, "thresholds.pass_rate ", stated,
             " is below your organization's floor — raised to ", floor),
        note(F.col("concurrency") > cap, "run.concurrency ", F.col("concurrency"),
             " exceeds your organization's cap — lowered to ", cap)))
    failed = stated.isNull()
    others = [c for c in run_configs.columns if c not in ("pass_rate", "concurrency")]
    return joined.select(
        *others, F.when(~failed, F.greatest(stated, floor)).alias("pass_rate"),
        F.least("concurrency", cap).alias("concurrency"),
        F.when(~failed, warnings).alias("warnings"),
        F.when(failed, "thresholds.pass_rate: required (0..1)").alias("config_error"))


def effective_config(rows: DataFrame) -> DataFrame:
    """Add ``effective_config``, the part of a config two runs are compared by."""
    text = F.to_json(F.struct(
        F.struct("dataset", "max_turns", "concurrency", "repeats").alias("run"),
        F.struct("pass_rate", "min_scenarios").alias("thresholds"),
        F.struct(F.col("baseline_branch").alias("branch"), "max_regression").alias("baseline")),
        {"ignoreNullFields": "false"})
    return rows.withColumn("effective_config", text)


def _entries(rows: DataFrame, value: str) -> DataFrame:
    parsed = F.from_json("effective_config", "map<string,map<string,variant>>")
    return (rows.select("run_id", F.explode(parsed).alias("section", "settings"))
            .select("run_id", "section", F.explode("settings").alias("key", "v"))
            .select("run_id", F.concat_ws(".", "section", "key").alias("path"),
                    F.coalesce(F.to_json("v"), F.lit("null")).alias(value)))


def config_drift(runs: DataFrame, baselines: DataFrame) -> DataFrame:
    """Settings that differ between a run and its baseline's config (both keyed
    by the run), including settings only one of them has."""
    return (_entries(runs, "run_value").join(_entries(baselines, "base_value"), ["run_id", "path"], "full")
            .filter("NOT (run_value <=> base_value)")
            .select("run_id", "path", "base_value", "run_value",
                    F.when(F.col("base_value").isNull(), "added")
                    .when(F.col("run_value").isNull(), "removed").otherwise("changed").alias("change")))
