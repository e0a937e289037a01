"""Licence scan by diagonal voting, in DataFrame functions only.

The hashes of all rolling word pairs of the texts meet those of a few licence notices. A hit votes
for the diagonal (place in the text less place in the notice). Votes are gathered per diagonal
as bits of the notice's pairs; neighbouring diagonals, which differ by a word put in or left
out, are merged; a notice is there if enough of its pairs are. Words themselves are compared
next to their hashes, so a full diagonal is the notice, word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from zonepulse.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Share of a notice's word pairs that must be found, and how far merged diagonals may lie apart.
ENOUGH = 0.8
SLACK = 3

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening words of public licence notices and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache",
    "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution": "cc-by",
}
#: Code of the entry that stands for a document.
_MARK = -(1 << 62)


def _templates() -> list[tuple[int, str, bool, int, int, str]]:
    """(number, label, base, pairs, place, pair) of every word pair; number -1 marks a document."""
    rows: list[tuple[int, str, bool, int, int, str]] = [(-1, "", False, 0, 0, "")]
    for number, (phrase, label) in enumerate([*BASE.items(), *NOTICES.items()]):
        words = phrase.split()
        for place, pair in enumerate(zip(words, words[1:])):
            rows.append((number, label, number < len(BASE), len(words) - 1, place, " ".join(pair)))
    return rows


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def licence_scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    n_base counts the places of base phrases; first_word and last_word are the smallest and
    largest; score is the largest share of a notice found. A null text has no words; equal rows
    give equal rows, also with a null key; other columns are ignored.
    """
    body = F.col(f"`{text}`")
    split = docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("h"), words_of(body).alias("w"))
    after = F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0)))
    # The last code of each text, in the place of its last word, stands for the document itself.
    before = F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0)))
    codes = F.concat(F.zip_with(before, after, lambda a, b: F.xxhash64(a, b)), F.array(F.lit(_MARK)))
    pairs = split.select("k", "h", "w", F.size("w").cast("long").alias("n_words"), F.posexplode(codes).alias("pos", "code"))
    found = docs.sparkSession.createDataFrame(_templates(), "tpl int, label string, base boolean, size int, place int, t_pair string")
    both = F.split("t_pair", " ")
    found = found.select("tpl", "label", "base", "size", "place", F.get(both, F.lit(0)).alias("t_word"), F.get(both, F.lit(1)).alias("t_next"))
    mark = F.col("tpl") == -1
    # About 150 rows, fixed above.
    found = F.broadcast(found.withColumn("t_code", F.when(mark, F.lit(_MARK)).otherwise(F.xxhash64("t_word", "t_next"))))
    alike = (F.get("w", F.col("pos")) == F.col("t_word")) & (F.get("w", F.col("pos") + 1) == F.col("t_next"))
    is_last = F.col("pos") == F.greatest(F.col("n_words") - 1, F.lit(0))
    hits = pairs.join(found, (F.col("code") == F.col("t_code")) & F.when(mark, is_last).otherwise(alike & ~is_last))
    diagonal = F.when(mark, 0).otherwise(F.col("pos") - F.col("place"))
    votes = hits.groupBy("k", "h", "n_words", "tpl", "label", "base", "size", diagonal.alias("diag")).agg(
        F.expr("bit_or(shiftleft(1L, place))").alias("bits"), F.count(F.lit(1)).alias("n")
    )
    order = Window.partitionBy("k", "h", "tpl").orderBy("diag")
    apart = F.coalesce(F.col("diag") - F.lag("diag").over(order) > SLACK, F.lit(True)) | F.col("base")
    groups = votes.withColumn("run", F.sum(apart.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = groups.groupBy("k", "h", "n_words", "tpl", "label", "base", "size", "run").agg(
        F.min("diag").alias("diag"), F.expr("bit_or(bits)").alias("bits"), F.max("n").alias("n")
    )
    share = F.when(F.col("tpl") >= 0, F.expr("bit_count(bits)") / F.col("size"))
    there = F.when(F.col("base"), share == 1).otherwise(share >= ENOUGH)
    spans = spans.withColumns({"share": share, "there": F.coalesce(there, F.lit(False))})
    base = F.col("there") & F.col("base")
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(F.when(c, F.col("label")))))
    done = spans.groupBy("k", "h", "n_words").agg(
        F.sum(base.cast("long")).alias("n_base"), F.min(F.when(base, F.col("diag"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diag"))).cast("long").alias("last_word"), joined(base).alias("base_labels"),
        joined(F.col("there")).alias("labels"), F.coalesce(F.max(F.when(F.col("there"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("tpl") == -1, F.col("n"))).alias("copies"),
    )
    rows = done.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select(F.col("k").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_diagonal_voting(spark: SparkSession, folder: str) -> DataFrame:
    return licence_scan(table(spark, folder, "documents"))


def _values() -> str:
    return ", ".join(f"({n}, '{label}', {base}, {size}, {place}, '{pair}')" for n, label, base, size, place, pair in _templates()[1:])


SQL = {
    "op2_diagonal_voting": f"""
WITH t(tpl, label, base, size, place, pair) AS (VALUES {_values()}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), p AS (
  SELECT r, unnest(range(1, len(w))) AS i, w FROM d WHERE len(w) > 1
), v AS (
  SELECT r, tpl, label, base, size, i - 1 - place AS diag, bit_or(1::BIGINT << place) AS bits
  FROM (SELECT r, i, w[i] || ' ' || w[i + 1] AS pair FROM p) JOIN t USING (pair) GROUP BY ALL
), g AS (
  SELECT *, CASE WHEN base OR coalesce(diag - lag(diag) OVER o > {SLACK}, true) THEN 1 ELSE 0 END AS apart
  FROM v WINDOW o AS (PARTITION BY r, tpl ORDER BY diag)
), h AS (
  SELECT *, sum(apart) OVER (PARTITION BY r, tpl ORDER BY diag ROWS UNBOUNDED PRECEDING) AS run FROM g
), s AS (
  SELECT r, label, base, min(diag) AS diag, bit_count(bit_or(bits)) / size AS share FROM h GROUP BY r, tpl, label, base, size, run
), f AS (SELECT * FROM s WHERE CASE WHEN base THEN share = 1 ELSE share >= {ENOUGH} END),
a AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(diag) FILTER (base) AS first_word, max(diag) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM f GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN a USING (r)""",
}
