"""Secret scans over a trigram inverted index, with DataFrame functions only.

From each rule's regex a Boolean query over trigrams is derived that every match
must hold, in lower case. Postings (trigram, document) are written for the trigrams
the rules ask for, intersected per rule, and only candidates are verified with
the rule's regex. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import boxed, table, unboxed, written
from verdictlake.llm.trigrams import trigram_query


class Rule(NamedTuple):
    """``group``/``least``: the group whose length must reach ``least``."""
    kind: str
    regex: str
    group: int
    least: int


# Fixed values of the base kinds: patterns, groups and least lengths. The letters
# of the keywords stand in either case. A run of hex digits, or of capitals and
# digits behind AKIA, is maximal, so a least length may stand in its pattern.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BASE_RULES = (
    Rule("assign", ASSIGN, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Published token formats, whose spans are added to the base ones.
# Key files (RFC 7468), web tokens (RFC 7519: two JSON objects and a signature of at
# least 256 bits, base64url), prefixes of GitHub and Slack, bearer tokens (RFC 6750).
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]{43,}", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}", 0, 1),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}", 0, 1),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9+/_.=-]{20,}", 0, 1),
)
RULES = BASE_RULES + MORE_RULES


def postings(docs: DataFrame, wanted: Sequence[str], key: str) -> DataFrame:
    """(trigram number, key): a row for each wanted trigram that a text holds."""
    low = F.lower("text")
    held = F.array_compact(F.array(*[F.when(low.contains(t), F.lit(i)) for i, t in enumerate(wanted)]))
    return docs.select(F.col(key), F.explode(held).alias("trigram"))


def candidates(posted: DataFrame, rules: Sequence[Rule], wanted: Sequence[str], key: str) -> DataFrame:
    """(key, rules): the numbers of the rules whose query a document's postings satisfy.

    Postings meet per document as bits, OR-ed in each task before they are
    shuffled, so a trigram that every document holds makes no large group.
    """
    words = range((len(wanted) + 62) // 63)
    masks = posted.groupBy(key).agg(*[
        F.bit_or(F.when((F.col("trigram") >= 63 * w) & (F.col("trigram") < 63 * (w + 1)),
                        F.expr(f"shiftleft(1L, cast(trigram - {63 * w} AS int))")).otherwise(F.lit(0).cast("bigint"))).alias(f"_m{w}")
        for w in words])

    def whole(need: frozenset[str]) -> Column:
        tests = []
        for w in words:
            mask = sum(1 << (i - 63 * w) for i, t in enumerate(wanted) if i // 63 == w and t in need)
            if mask:
                tests.append(F.col(f"_m{w}").bitwiseAND(F.lit(mask)) == F.lit(mask))
        return reduce(lambda a, b: a & b, tests)

    fits = [F.when(reduce(lambda a, b: a | b, map(whole, q)), F.lit(n))
            for n, q in enumerate(trigram_query(rule.regex) for rule in rules) if q]
    return masks.select(key, F.array_compact(F.array(*fits)).alias("_rules")).filter(F.size("_rules") > 0)


def spans_of(text: Column, number: int, rule: Rule) -> Column:
    """The rule's spans, leftmost and not overlapping, as array of struct(start,
    number, end) in code points: lengths of what lies between matches add up."""
    between = F.split(text, rule.regex, -1)
    found = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    steps = F.zip_with(F.zip_with(F.slice(between, F.lit(1), F.size(found)), found,
                                  lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit"))),
                       kept, lambda step, part: F.struct(step["gap"].alias("gap"), step["hit"].alias("hit"),
                                                         F.length(part).alias("part")))
    empty = F.expr("cast(array() AS array<struct<start:int, number:int, end:int>>)")
    walked = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda state, step: F.struct(
            (state["at"] + step["gap"] + step["hit"]).alias("at"),
            F.when(step["part"] >= rule.least,
                   F.concat(state["spans"], F.array(F.struct((state["at"] + step["gap"]).alias("start"), F.lit(number).alias("number"),
                                                             (state["at"] + step["gap"] + step["hit"]).alias("end")))))
            .otherwise(state["spans"]).alias("spans")))
    return F.when(F.size(found) > 0, walked["spans"]).otherwise(empty)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``_spans``: the spans of all rules as array of struct(start, number,
    end), by start, then rule number.

    A null text counts as empty and has no spans; repeated rows and null ids are
    found alike (documents of one id are candidates together, each is verified
    by itself); an empty table stays empty; texts of any length are searched
    whole. Other columns pass through, whatever their names; an input column
    ``_spans`` is replaced. The input is read twice, for the index and for
    verification.
    """
    wanted = sorted({t for rule in rules for need in trigram_query(rule.regex) for t in need})
    columns = [c for c in docs.columns if c != "_spans"]
    keyed = boxed(docs, "doc_id", "text").withColumn("_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    posted = written(postings(keyed.select("_key", "text"), wanted, "_key"), "trigram-postings")
    able = candidates(posted, rules, wanted, "_key")
    text = F.coalesce(F.col("text"), F.lit(""))
    per_rule = [F.when(F.array_contains("_rules", n), spans_of(text, n, rule)) if trigram_query(rule.regex)
                else spans_of(text, n, rule) for n, rule in enumerate(rules)]
    none = F.expr("cast(array() AS array<struct<start:int, number:int, end:int>>)")
    return (keyed.join(able, "_key", "left")
            .withColumn("_spans", F.array_sort(F.concat(*[F.coalesce(c, none) for c in per_rule])))
            .select(*[F.col("_whole").getField(c).alias(c) for c in columns], "_spans"))


def rendered(spans: Column, rules: Sequence[Rule] = RULES) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["number"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents with every span replaced by ``<secret>``; spans that touch
    or overlap give one mark, and ``n_chars`` follows. Clean texts stay as they are.

    Null texts stay null and empty ones empty; texts of any length are searched
    whole; every row stays, repeated ones and those without an id too; an empty
    table stays empty. All other columns stay as they are, whatever their names.
    """
    found = scan(boxed(docs, "doc_id", "text"), rules)
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate("_spans", start, lambda state, s: F.struct(
        F.greatest(state["at"], s["end"]).alias("at"),
        F.when((s["start"] <= state["at"]) & (state["at"] > 0), state["out"])
        .otherwise(F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("<secret>"))).alias("out")),
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
    hit = F.size("_spans") > 0
    clean = found.withColumn("text", F.when(hit, walked).otherwise(text))
    size = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else F.lit(None)
    return unboxed(clean, docs.columns, text=F.col("text"), n_chars=F.when(hit, size).otherwise(F.col("_whole").getField("n_chars")) if "n_chars" in docs.columns else size)


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every whole text, base kinds counted and digested."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("_spans", lambda s: s["number"] < len(BASE_RULES))
    numbers = F.col("_spans.number")
    counts = [(F.size("_spans") - F.size(F.array_remove(numbers, n))).cast("bigint").alias(f"n_{rule.kind}")
              for n, rule in enumerate(BASE_RULES)]
    return found.select("doc_id", *counts, F.sha2(rendered(base), 256).alias("base_sha256"),
                        rendered(F.col("_spans")).alias("spans"))


def _sql_spans(number: int, rule: Rule) -> str:
    """One rule over ``documents`` in the oracle's dialect: matches and what lies
    between them, places from running lengths."""
    regex = rule.regex.replace("'", "''")
    return rf"""
SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, start, start + hit AS stop
FROM (SELECT doc_id, part, hit,
             CAST(sum(gap + hit) OVER (PARTITION BY doc_id ORDER BY i) - hit AS BIGINT) AS start
      FROM (SELECT doc_id, i, length(found[i]) AS hit, length(kept[i]) AS part, length(gaps[i]) AS gap
            FROM (SELECT doc_id, unnest(range(1, len(found) + 1)) AS i, found, kept, gaps
                  FROM (SELECT doc_id, regexp_extract_all(text, '{regex}') AS found,
                               regexp_extract_all(text, '{regex}', {rule.group}) AS kept,
                               string_split_regex(text, '{regex}') AS gaps
                        FROM documents) m) u) v) p
WHERE part >= {rule.least}"""


OP10_SQL = f"""
WITH spans AS ({' UNION ALL '.join(_sql_spans(n, r) for n, r in enumerate(RULES))}),
per AS (
  SELECT doc_id, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access,
         count(*) FILTER (number = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) FILTER (number < {len(BASE_RULES)}) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex,
       sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id"""
