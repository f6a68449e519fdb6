"""License scans by diagonal voting, with DataFrame functions only.

A text is lower-cased and cut into words. Every rolling 2-gram of it is hashed and joined to the
template positions that hold the same 2-gram. A match votes for the diagonal "text position minus
template position", which is the place where the whole template would begin. Neighbouring diagonals
(a few words more or less) are merged, and a span is verified when its votes cover enough of the
template. A phrase stands exactly where one diagonal has a vote of each of its 2-grams.

The templates are a fixed list of a few hundred positions, so the planner sends them to the tasks.
The exploded 2-grams stay inside the scan's stage; only matches are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Phrase and label of the base rule.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Opening words of common notices and licences, normalised.
NOTICES = [
    ("licensed under the gnu general public license", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation", "gpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at "
     "http www apache org licenses license 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction", "mit"),
    ("licensed under cc by", "cc-by"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights", "cc0"),
    ("all rights reserved", "reserved"),
]

K = 2
# Diagonals this near are one span; a span counts if votes cover this share of its template.
NEAR, COVER = 2, 0.6
NOT_WORD = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def templates() -> list[tuple[int, str, int, bool, int, str]]:
    """(template, label, length in words, whether a base phrase, position, 2-gram)."""
    out = []
    for t, (text, label) in enumerate(PHRASES + NOTICES):
        words = text.split(" ")
        out += [(t, label, len(words), t < len(PHRASES), p, " ".join(words[p : p + K])) for p in range(len(words) - K + 1)]
    return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``id_col, n_words, n_base, first_word, last_word, base_labels, labels,
    spans, score``.

    ``spans`` lists verified spans as structs (label, first word, last word, share of the template);
    ``score`` is the largest share, 0 without any. Null and empty texts have no words. Rows that
    repeat an id, and rows without one, are scanned on their own.
    """
    spark = docs.sparkSession
    rows = ", ".join(f"({t}, '{label}', {n}, {str(phrase).lower()}, {p}, '{gram}')" for t, label, n, phrase, p, gram in templates())
    # One more entry per text matches the last row, so that texts without a match stay.
    known = spark.sql(
        "SELECT template, label, length, phrase, tpos, xxhash64(split(gram, ' ')[0], split(gram, ' ')[1]) AS hash "
        f"FROM VALUES {rows}, (-1, NULL, 0, false, 0, ' ') AS t(template, label, length, phrase, tpos, gram)")
    # The Kelvin sign is the one character outside A-Z whose lower case is an ASCII letter alone.
    text = f"lower(replace(coalesce(`{text_col}`, ''), 'K', 'ĸ'))"
    words = docs.select(F.col(id_col).alias("id"), F.expr(f"split(trim(' ' FROM regexp_replace({text}, '{NOT_WORD}', ' ')), ' ')").alias("words"))
    words = words.withColumn("row", F.monotonically_increasing_id())
    grams = words.selectExpr(
        "id", "row", "CASE WHEN words[0] = '' THEN 0 ELSE size(words) END AS n_words",
        "posexplode(concat(array(xxhash64('', '')), transform(words, (w, i) -> xxhash64(w, get(words, i + 1))))) AS (at, hash)")
    # A text without words has the empty word, which ends at a null: it equals no template 2-gram.
    hits = grams.join(known, "hash").selectExpr("id", "row", "n_words", "template", "label", "length", "phrase", "tpos", "at - 1 - tpos AS diagonal")
    hits = hits.filter("template < 0 OR n_words > 0")

    votes = hits.groupBy("id", "row", "n_words", "template", "label", "length", "phrase", "diagonal").agg(
        F.count(F.lit(1)).alias("votes"), F.collect_set("tpos").alias("tpos"))
    places = votes.withColumn("base", F.expr(f"phrase AND votes = length - {K} + 1"))
    step = f"diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) > {NEAR}"
    merged = places.selectExpr("*", f"CASE WHEN {step} THEN 1 ELSE 0 END AS fresh").selectExpr(
        "*", "sum(fresh) OVER (PARTITION BY row, template ORDER BY diagonal) AS span")
    spans = merged.groupBy("row", "id", "n_words", "template", "label", "length", "span").agg(
        F.expr("size(array_distinct(flatten(collect_list(tpos))))").alias("covered"),
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"),
        F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min(F.when(F.col("base"), F.col("diagonal"))).alias("first"),
        F.max(F.when(F.col("base"), F.col("diagonal"))).alias("last"),
    ).selectExpr("*", f"CASE WHEN template >= 0 THEN covered / CAST(length - {K} + 1 AS DOUBLE) END AS share")
    verified = f"share >= {COVER}"
    labels = f"filter(array(CASE WHEN n_base > 0 OR {verified} THEN label END), x -> x IS NOT NULL)"
    return spans.groupBy("row", F.col("id").alias(id_col), "n_words").agg(
        F.sum("n_base").alias("n_base"), F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("last_word"),
        F.expr("array_join(sort_array(collect_set(CASE WHEN n_base > 0 THEN label END)), ',')").alias("base_labels"),
        F.expr(f"array_join(sort_array(array_distinct(flatten(collect_list({labels})))), ',')").alias("labels"),
        F.expr(f"sort_array(collect_list(CASE WHEN {verified} THEN struct(low AS first, label, high + length - 1 AS last, share) END))").alias("spans"),
        F.expr(f"coalesce(max(CASE WHEN {verified} THEN share END), 0D)").alias("score"),
    ).withColumn("n_words", F.col("n_words").cast("long")).drop("row")
