"""Licence notices in texts: Dice coefficient over word bigrams against licence templates.

Text is cut into segments: every sentence, line, paragraph and the text as a whole. A segment's words
(letters and digits, lower case) give its set of word bigrams, and 2 * shared / (own + template's) is
compared with each template. A coefficient of ``LEAST`` is only possible if the sizes of the two sets lie
within a factor of (2 - LEAST) / LEAST, so a segment meets the templates of such sizes only: the sizes a
template can match are listed, and segments are joined with that list on their own size.

Everything is column expressions. The templates are a parameter of bounded size (``MOST_TEMPLATES``) and
broadcast; documents are not shuffled, only the segments that matched are.

Defined cases: null and empty texts have no segments; a segment of one word has no bigram and matches
nothing; a segment that a text repeats counts once; rows of equal id are one document; for a licence
with several templates the best coefficient counts; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlot.llm.common import let, text_or_empty, windows

LEAST = (8, 10)
MOST_TEMPLATES = 10_000

# Notices by SPDX identifier, as they are commonly written.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
)


def segments(text: Column) -> Column:
    """Sentences, lines, paragraphs and the text, each once."""
    lines = F.split(text, "\n", -1)
    sentences = F.flatten(F.transform(lines, lambda x: F.split(x, r"[.!?]+[ \t]+", -1)))
    paragraphs = F.split(text, r"\n[ \t\r\n]*\n", -1)
    return F.array_distinct(F.concat(sentences, lines, paragraphs, F.array(text)))


def bigrams(text: Column) -> Column:
    """Hashes of the distinct pairs of neighbouring words."""
    ws = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")
    return let(ws, lambda w: F.array_distinct(F.transform(windows(F.size(w), 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))))


def _candidates(spark, templates) -> DataFrame:
    """``(size, licence, t)``: for each size of a segment the templates it can match."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    part, whole = LEAST
    table = spark.createDataFrame(list(templates), "licence string, text string").select("licence", bigrams(F.col("text")).alias("t")).where(F.size("t") > 0)
    own = F.size("t")
    low = F.ceil(own * F.lit(part) / F.lit(2 * whole - part)).cast("int")
    high = F.floor(own * F.lit(2 * whole - part) / F.lit(part)).cast("int")
    return table.select(F.explode(F.sequence(low, high)).alias("size"), "licence", "t")


def find_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES) -> DataFrame:
    """``(doc_id, licence, dice, n_segments)`` for each document and licence found in it."""
    part, whole = LEAST
    # Bigrams are made before the rows are, else the optimizer would make them again in a filter below the join.
    made = F.transform(segments(text_or_empty(text)), lambda s: F.struct(s.alias("segment"), bigrams(s).alias("b")))
    each = docs.select(F.col(doc_id).alias("id"), F.explode(made).alias("x"))
    held = each.select("id", "x.segment", "x.b", F.size("x.b").alias("n"))
    met = held.join(F.broadcast(_candidates(docs.sparkSession, templates)), F.col("n") == F.col("size"))
    shared = met.withColumn("x", F.size(F.array_intersect("b", "t"))).where(whole * 2 * F.col("x") >= part * (F.col("n") + F.size("t")))
    dice = (F.lit(2.0) * F.col("x")) / (F.col("n") + F.size("t")).cast("double")
    best = shared.groupBy("id", "licence", F.xxhash64("segment").alias("segment")).agg(F.max(dice).alias("dice"))
    return best.groupBy(F.col("id").alias("doc_id"), "licence").agg(F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_segments"))


def op10_licence_notices(spark, sf_dir: str) -> DataFrame:
    return find_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_SPLIT = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
SQL = f"""
WITH tpl(licence, text) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEMPLATES)}),
tw AS (SELECT licence, {_SPLIT.format("text")} AS w FROM tpl),
t AS (SELECT licence, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t FROM tw),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM d),
seg AS (
  SELECT doc_id, unnest(string_split_regex(s, '[.!?]+[ \\t]+')) AS s FROM l UNION SELECT doc_id, s FROM l
  UNION SELECT doc_id, unnest(string_split_regex(text, '\\n[ \\t\\r\\n]*\\n')) FROM d UNION SELECT doc_id, text FROM d
),
w AS (SELECT doc_id, s, {_SPLIT.format("s")} AS w FROM seg),
b AS (SELECT doc_id, s, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM w WHERE len(w) > 1),
m AS (
  SELECT doc_id, licence, s, max(2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t))::DOUBLE) AS dice FROM b, t
  WHERE {LEAST[0]} * len(t) <= {2 * LEAST[1] - LEAST[0]} * len(b) AND {LEAST[0]} * len(b) <= {2 * LEAST[1] - LEAST[0]} * len(t)
    AND {2 * LEAST[1]} * len(list_intersect(b, t)) >= {LEAST[0]} * (len(b) + len(t)) GROUP BY ALL
)
SELECT doc_id, licence, max(dice) AS dice, count(*) AS n_segments FROM m GROUP BY ALL
"""
