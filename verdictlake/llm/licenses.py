"""License scans: phrases, and an exact set-similarity join of text blocks with
templates. DataFrame functions only.

A block is a line of a text, a set of words; it matches a template when it holds
at least 80 percent of the template's words. So does any run of words at most
twice as long as the template, wherever lines break (templates under 8 words must
be whole there, as the word that names the license may be the missing one); only
texts that hold enough of the template's words are searched for such runs.

Of the lines: words are ordered by their global
document frequency, rarest first. Only the first words of a template in that
order (prefix filter) bring blocks to it, a block needs enough template words
(length filter), and what stands behind the shared word must suffice
(positional filter); the candidates left are verified whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import constants, lower_ascii, table, written

# Fixed values of the base: phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Fixed values of the method: label and wording of the templates.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
)
PERCENT = 80
WHOLE_BELOW = 8

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def template_sets(percent: int = PERCENT) -> list[tuple[int, str, list[str], int]]:
    """(number, label, distinct words, least overlap) of each template."""
    sets = [(n, label, list(dict.fromkeys(text.split()))) for n, (label, text) in enumerate(TEMPLATES)]
    return [(n, label, words, -(-percent * len(words) // 100)) for n, label, words in sets]


def runs(known: Column, low: Column, percent: int) -> Column:
    """(template, label, overlap, share) of each template that a run of at most
    twice its words reaches, with the largest overlap. ``known``: the template
    words that the lower-cased text holds; without enough of them it is not cut."""
    sets = [(n, label, words, len(words) if len(words) < WHOLE_BELOW else least, 2 * len(TEMPLATES[n][1].split()))
            for n, label, words, least in template_sets(percent)]
    templates = F.array(*[F.struct(F.lit(n).alias("template"), F.lit(label).alias("label"), F.array(*map(F.lit, words)).alias("words"),
                                   F.lit(least).alias("least"), F.lit(width).alias("width")) for n, label, words, least, width in sets])
    likely = F.filter(templates, lambda t: F.size(F.array_intersect(known, t["words"])) >= t["least"])
    marks = F.filter(F.transform(F.split(F.trim(F.regexp_replace(low, SEPARATORS, " ")), " "), lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
                     lambda m: F.array_contains(known, m["word"]))

    def overlap(own: Column, t: Column) -> Column:
        def of(mark: Column, i: Column) -> Column:
            near = F.filter(F.slice(own, i + 1, t["width"]), lambda m: m["at"] < mark["at"] + t["width"])
            return F.size(F.array_distinct(F.transform(near, lambda m: m["word"])))
        return F.array_max(F.transform(own, of))

    def searched(texts: Column) -> Column:  # one element: the marks of the text
        return F.flatten(F.transform(texts, lambda all_: F.transform(likely, lambda t: F.struct(
            t["template"].alias("template"), t["label"].alias("label"), t["least"].alias("least"), F.size(t["words"]).alias("size"),
            overlap(F.filter(all_, lambda m: F.array_contains(t["words"], m["word"])), t).alias("overlap")))))

    found = F.filter(F.when(F.size(likely) > 0, searched(F.array(marks))), lambda r: r["overlap"] >= r["least"])
    return F.transform(found, lambda r: F.struct(r["template"].alias("template"), r["label"].alias("label"), r["overlap"].alias("overlap"),
                                                 (r["overlap"] / r["size"]).alias("share")))


def spaced(text: Column) -> Column:
    """The words of a lower-cased text, one space before, between and behind."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, SEPARATORS, " ")), F.lit(" "))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_places(words: Column) -> dict[str, Column]:
    """n_base, first_word, last_word, base_labels of a text as ``spaced`` gives it."""
    counts, firsts, lasts = [], [], []
    back = F.reverse(words)
    for phrase, _ in PHRASES:
        mark, turned = f" {phrase} ", f" {phrase[::-1]} "
        counts.append(F.regexp_count(words, F.lit(f" {phrase}(?= )")))
        at, end = F.instr(words, mark), F.instr(back, turned)
        firsts.append(F.when(at > 0, spaces(F.substring(words, F.lit(1), at)) - 1))
        start = F.length(words) - end + 2 - len(mark)  # of the last place, from 1
        lasts.append(F.when(end > 0, spaces(F.substring(words, F.lit(1), start)) - 1))
    labels = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for n, (_, label) in zip(counts, PHRASES)]))
    return {"n_base": sum(counts[1:], counts[0]).cast("bigint"), "first_word": F.least(*firsts).cast("bigint"),
            "last_word": F.greatest(*lasts).cast("bigint"), "base_labels": labels}


def described(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document, with a row number of its own: phrase results; of each
    block, the distinct template words, for blocks with enough of them; and the
    templates that ``runs`` finds."""
    vocabulary = sorted({w for _, _, words, _ in template_sets(percent) for w in words})
    shortest = min(least for *_, least in template_sets(percent))
    text = F.coalesce(F.col("text"), F.lit(""))
    low = lower_ascii(text)
    known = F.array(*map(F.lit, vocabulary))
    lines = F.transform(F.split(low, "\n"), lambda line: F.array_intersect(F.split(line, SEPARATORS), known))
    hint = F.lower(text).contains("license")
    words = F.when(hint, spaced(low)).otherwise(F.lit("  "))
    n_words = F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("bigint")
    rows = docs.select("doc_id", n_words.alias("n_words"), words.alias("_words"), low.alias("_low"), lines.alias("_lines"))
    rows = rows.withColumn("_known", F.array_distinct(F.flatten("_lines")))
    rows = rows.select("doc_id", "n_words", *[c.alias(n) for n, c in phrase_places(F.col("_words")).items()],
                       F.filter("_lines", lambda words: F.size(words) >= shortest).alias("blocks"),
                       runs(F.col("_known"), F.col("_low"), percent).alias("runs"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "license-blocks")


def word_order(rows: DataFrame) -> list[str]:
    """Template words, rarest first by the number of blocks that hold them, over
    all documents; one row per template word reaches the driver."""
    counts = (rows.select(F.explode("blocks").alias("words")).select(F.explode("words").alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "word").collect())
    return [r.word for r in counts]


def matches(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(row, block, template, label, overlap, share) of every block that reaches a template's
    threshold."""
    order = word_order(rows)
    place = {w: i for i, w in enumerate(order)}
    index = []
    for number, label, words, least in template_sets(percent):
        ranked = sorted(words, key=lambda w: (place.get(w, -1), w))
        for i, word in enumerate(ranked[:len(words) - least + 1]):
            index.append((word, number, label, len(words), least, len(words) - i))
    prefixes = constants(rows.sparkSession, index, "word string, template int, label string, size int, least int, behind int")
    sets = constants(rows.sparkSession, [(n, words) for n, _, words, _ in template_sets(percent)], "template int, template_words array<string>")
    starters = F.array(*[F.lit(w) for w in sorted({i[0] for i in index})])
    blocks = (rows.select("row", F.posexplode("blocks").alias("block", "words"))
              .filter(F.arrays_overlap("words", starters)))
    ordered = F.array_intersect(F.array(*map(F.lit, order or [""])), F.col("words"))
    found = (blocks.select("row", "block", ordered.alias("words"))
             .select("row", "block", "words", F.posexplode("words").alias("at", "word"))
             # Of a pair's shared words the rarest has all others behind it on both sides.
             .filter(F.col("word").isin(*sorted({i[0] for i in index})))
             .join(F.broadcast(prefixes), "word")
             .filter("size(words) - at >= least AND behind >= least"))
    once = found.groupBy("row", "block", "template").agg(F.first("words").alias("words"), F.first("label").alias("label"),
                                                         F.first("size").alias("size"), F.first("least").alias("least"))
    overlap = F.size(F.array_intersect("words", "template_words"))
    return (once.join(F.broadcast(sets), "template").withColumn("overlap", overlap).filter("overlap >= least")
            .select("row", "block", "template", "label", "overlap", (F.col("overlap") / F.col("size")).alias("share")))


def scan_licenses(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    The base counts the places where a phrase's words stand one after the other;
    ``labels`` adds those of matched templates; ``score`` is 1 with a base label,
    else the largest share of a template that a block holds, 0 without a match.

    A null text counts as empty: no words, no labels, null places. Repeated rows
    and null ids are rows of their own; an empty table gives no rows; blocks are
    whole lines of any length, runs of words do not depend on line breaks; other
    columns are not read. OP9_SQL knows the lines only.
    """
    rows = described(docs, percent)
    across = rows.select("row", F.inline("runs")).select("row", "label", "share")
    found = matches(rows, percent).select("row", "label", "share").union(across).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    base = F.size("base_labels") > 0
    return (rows.drop("blocks", "runs").join(found, "row", "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
                    F.when(base, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score")))


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases and templates in every whole text."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql() -> str:
    low = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    templates = ", ".join(f"({n}, '{label}', [{', '.join(repr(w) for w in words)}], {least})" for n, label, words, least in template_sets())
    starts = " UNION ALL ".join(
        f"SELECT row, i - 1 AS place, '{label}' AS label FROM places WHERE "
        + " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split())) for phrase, label in PHRASES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, text, regexp_extract_all({low}, '{word}') AS words FROM documents),
places AS (SELECT row, words, unnest(range(1, len(words) + 1)) AS i FROM d),
hits AS ({starts}),
base AS (SELECT row, count(*) AS n, min(place) AS first, max(place) AS last, list(DISTINCT label) AS labels FROM hits GROUP BY row),
t(template, label, words, least) AS (VALUES {templates}),
b AS (SELECT row, list_distinct(regexp_extract_all(line, '{word}')) AS words
      FROM (SELECT row, unnest(string_split({low}, chr(10))) AS line FROM d) l),
m AS (SELECT row, t.label, len(list_intersect(b.words, t.words)) / len(t.words) AS share
      FROM b JOIN t ON len(list_intersect(b.words, t.words)) >= t.least),
more AS (SELECT row, list(DISTINCT label) AS labels, max(share) AS share FROM m GROUP BY row)
SELECT doc_id, CAST(len(d.words) AS BIGINT) AS n_words, COALESCE(base.n, 0) AS n_base, first AS first_word, last AS last_word,
       COALESCE(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       COALESCE(array_to_string(list_sort(list_distinct(list_concat(COALESCE(base.labels, []), COALESCE(more.labels, [])))), ','), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE COALESCE(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base ON d.row = base.row LEFT JOIN more ON d.row = more.row"""


OP9_SQL = _sql()
