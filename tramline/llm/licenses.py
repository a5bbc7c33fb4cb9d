"""License scans by diagonal voting, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.shared import ascii_lower, checked, saved

#: Words of a lower-cased text: digits, a-z and everything past ASCII.
WORD = r"([0-9a-z\x{80}-\x{10FFFF}]+)"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARKS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Longer than any array.
MANY = (1 << 31) - 1
#: Phrases whose every exact place counts.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Statements and parts of well-known notices, as lower-case words.
NOTICES = (
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc-sa", "licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1"),
    ("odbl", "this database is made available under the open database license"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
)
#: Words of a gram, for phrases and for notices.
K_BASE, K = 2, 3
#: Diagonals at most so far apart, with spans at most so far apart, are one occurrence with insertions or deletions.
DRIFT = 4
#: The part of a notice's words that an occurrence must cover.
COVER = 0.8


def template_rows(base=None, notices=NOTICES) -> list[tuple]:
    """(template, label, is_base, n, k, at, gram) for each gram of each template."""
    out = []
    for t, (label, text, k) in enumerate([(v, p, K_BASE) for p, v in (base or BASE).items()] + [(v, p, K) for v, p in notices]):
        words = text.split()
        out += [(t, label, k == K_BASE, len(words), k, i, " ".join(words[i : i + k])) for i in range(len(words) - k + 1)]
    return out


def templates(spark, base=None, notices=NOTICES) -> DataFrame:
    """The template grams with their hashes; as many rows as the given templates have words."""
    rows = template_rows(base, notices)
    text = lambda w: "CAST(NULL AS STRING)" if w is None else "'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cells = [(t, text(label), b, n, k, i, *[text(w) for w, _ in zip([*g.split(), None], "abc", strict=False)]) for t, label, b, n, k, i, g in rows]
    values = ", ".join("(" + ", ".join(map(str, c)) + ")" for c in cells)
    return spark.sql(f"SELECT *, xxhash64(t_a, t_b) AS t_hash FROM VALUES {values} AS v(template, label, is_base, n, k, at, t_a, t_b, t_c)")


def words_of(text: Column) -> Column:
    """The words of a lower-cased text in order, empty for none."""
    inner = F.btrim(text, F.lit(MARKS))
    return F.when(inner != "", F.split(inner, BETWEEN)).otherwise(F.array().cast("array<string>"))


def votes(docs: DataFrame, base=None, notices=NOTICES) -> DataFrame:
    """doc_id, row, template, label, is_base, n, k, pos, at: each place where a document's gram is a template's.

    All rolling pairs of words are hashed and meet the templates' positions in a join whose small side is the
    templates; the words themselves then have to agree, and a notice's grams have a third one. The words stay in
    their array until they are dealt out as triples, so a long text is never repeated for each of its words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", F.xxhash64(text).alias("row"), words_of(ascii_lower(text)).alias("words"))
    rest = lambda i: F.slice("words", i, MANY)
    triples = F.arrays_zip(F.col("words").alias("a"), rest(2).alias("b"), rest(3).alias("c"))
    grams = words.select("doc_id", "row", F.posexplode_outer(triples).alias("pos", "x")).select("doc_id", "row", F.col("pos").cast("long").alias("pos"), "x.a", "x.b", "x.c")
    t = templates(docs.sparkSession, base, notices)
    same = (F.xxhash64("a", "b") == F.col("t_hash")) & (F.col("a") == F.col("t_a")) & (F.col("b") == F.col("t_b")) & (F.col("t_c").isNull() | (F.col("c") == F.col("t_c")))
    return grams.join(checked(t, 20_000), same).select("doc_id", "row", "template", "label", "is_base", "n", "k", "pos", "at")


def spans(docs: DataFrame, base=None, notices=NOTICES) -> DataFrame:
    """doc_id, row, label, is_base, place (word from 0), cover (part of the template's words that agree): occurrences.

    Votes are summed by diagonal, the difference of the place in the document and the place in the template. A base
    phrase stands where a diagonal has the votes of all its grams. Of a notice, diagonals within DRIFT whose votes
    follow within DRIFT are merged."""
    key = ["doc_id", "row", "template", "label", "is_base", "n", "k"]
    diagonal = F.col("pos") - F.col("at")
    lines = saved(votes(docs, base, notices).groupBy(*key, diagonal.alias("diagonal")).agg(F.collect_set("at").alias("hits"), F.min("pos").alias("first"), F.max("pos").alias("last")))
    exact = lines.where("is_base AND size(hits) = n - k + 1").select("doc_id", "row", "label", "is_base", F.col("diagonal").alias("place"), F.lit(1.0).alias("cover"))
    order = Window.partitionBy("doc_id", "row", "template").orderBy("first", "diagonal")
    rest = lines.where("NOT is_base").withColumn("apart", F.col("first") - F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rest = rest.withColumn("shift", F.abs(F.col("diagonal") - F.lag("diagonal").over(order)))
    fresh = F.coalesce((F.col("apart") > DRIFT + F.col("k")) | (F.col("shift") > DRIFT), F.lit(True))
    rest = rest.withColumn("run", F.sum(fresh.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.flatten(F.transform("hits", lambda at: F.sequence(at, at + F.col("k") - 1)))
    merged = rest.withColumn("words", words).groupBy(*key, "run").agg(F.size(F.array_distinct(F.flatten(F.collect_list("words")))).alias("agree"), F.min("first").alias("place"))
    merged = merged.select("doc_id", "row", "label", "is_base", "place", (F.col("agree") / F.col("n")).alias("cover"))
    return exact.unionByName(merged)


def scan(docs: DataFrame, base=None, notices=NOTICES, cover: float = COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each document. A notice's label
    needs an occurrence that covers `cover` of its words; score is the best cover of any occurrence, 0 without one.
    Null and empty texts have no words; labels without any are the empty string. Rows that repeat give rows that
    repeat; no documents give none; texts of any length are read whole; other columns, whatever their names, are left
    aside."""
    per = spans(docs, base, notices).groupBy("doc_id", "row").agg(
        F.count_if("is_base").alias("n_base"),
        F.min(F.when(F.col("is_base"), F.col("place"))).alias("first_word"),
        F.max(F.when(F.col("is_base"), F.col("place"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("cover") >= cover, F.col("label")))), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = docs.select("doc_id", F.xxhash64(text).alias("row"), F.regexp_count(ascii_lower(text), F.lit(WORD)).cast("long").alias("n_words"))
    both = counts.alias("d").join(per.alias("p"), F.expr("d.doc_id <=> p.doc_id AND d.row = p.row"), "left")
    return both.select(
        F.col("d.doc_id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def oracle(base=None, notices=NOTICES) -> str:
    """The same in DuckDB's SQL."""
    values = ", ".join(f"({t}, '{label}', {str(b).lower()}, {n}, {k}, {i}, '{g}')" for t, label, b, n, k, i, g in template_rows(base, notices))
    return f"""
WITH t(template, label, is_base, n, k, tat, gram) AS (VALUES {values}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
g AS (SELECT doc_id, {K_BASE} AS k, i - 1 AS pos, words[i] || ' ' || words[i + 1] AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM d)
  UNION ALL SELECT doc_id, {K}, i - 1, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
l AS (SELECT doc_id, template, label, is_base, n, t.k, pos - tat AS diagonal, list(tat) AS hits, min(pos) AS first, max(pos) AS last FROM g JOIN t ON g.gram = t.gram AND g.k = t.k GROUP BY ALL),
r AS (SELECT *, first - max(last) OVER (PARTITION BY doc_id, template ORDER BY first, diagonal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS apart,
  abs(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY first, diagonal)) AS shift FROM l WHERE NOT is_base),
s AS (SELECT *, sum(CASE WHEN coalesce(apart > {DRIFT} + k OR shift > {DRIFT}, true) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, template ORDER BY first, diagonal ROWS UNBOUNDED PRECEDING) AS run FROM r),
w AS (SELECT doc_id, template, label, n, run, unnest(range(h, h + k)) AS word FROM (SELECT *, unnest(hits) AS h FROM s)),
m AS (SELECT doc_id, label, false AS is_base, NULL::BIGINT AS place, count(DISTINCT word)::DOUBLE / n AS cover FROM w GROUP BY doc_id, template, label, n, run
  UNION ALL SELECT doc_id, label, true, diagonal, 1.0 FROM l WHERE is_base AND len(hits) = n - k + 1),
p AS (SELECT doc_id, count(*) FILTER (is_base) AS n_base, min(place) FILTER (is_base) AS first_word, max(place) FILTER (is_base) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (cover >= {COVER}) AS labels, max(cover) AS score FROM m GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN p ON d.doc_id = p.doc_id"""
