"""License scans by diagonal voting: word bigrams that stand in a license text vote for the offset they imply.

Everything here is DataFrame operations. A text's rolling bigram hashes are joined with the positions of the same bigrams
in the templates; votes with the same difference of positions lie on one diagonal, that is on one placed copy of the
template. Neighbouring diagonals are merged, since words added or left out shift a copy a little. A vote counts only if
both its words are the template's, so spans are verified word by word.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assaylake.session import settle

#: Phrases and the labels they stand for.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices by which licenses are usually given, and the labels they stand for.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights "
    "to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
    "with the license you may obtain a copy of the license at",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 2 of the license or at your option any "
    "later version",
    "lgpl": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
    "published by the free software foundation",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met redistributions of source code must retain the above copyright notice",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "all-rights-reserved": "all rights reserved",
}
#: Share of a notice's bigrams that must be found, and how far neighbouring diagonals may lie apart.
COVERED, APART = 0.7, 3
#: Bytes outside words, after lower-casing.
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: letters and digits of ASCII, lower-cased, and all that is not ASCII."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN, -1)


def _inner(cut: Column) -> Column:
    """Without the empty strings that splitting leaves at the ends."""
    first = F.when(F.element_at(cut, 1) == "", 2).otherwise(1)
    last = F.size(cut) - F.when(F.element_at(cut, -1) == "", 1).otherwise(0)
    return F.slice(cut, first, F.greatest(last - first + 1, F.lit(0)))


def templates(spark: SparkSession) -> DataFrame:
    """A row per bigram of each template: its hash, words, place, the template's label, kind and number of bigrams.
    A table of fixed size, a few hundred rows, so it may be broadcast. Texts are ours; hashes are Spark's."""
    rows = []
    for base, texts in ((True, [(label, phrase) for phrase, label in BASE.items()]), (False, list(NOTICES.items()))):
        for label, text in texts:
            w = re.findall("[a-z0-9]+", text)
            rows += [(f"{'base' if base else 'notice'}:{text[:40]}", label, base, len(w) - 1, k, a, b) for k, (a, b) in enumerate(zip(w, w[1:]))]
    frame = spark.createDataFrame(rows, "template string, label string, base boolean, grams int, at int, one string, two string")
    return frame.withColumn("hash", F.xxhash64("one", "two"))


def _hits(docs: DataFrame, key: str, text: str, hashes: list[int]) -> DataFrame:
    """Per row: a number for it, its id, number of words, and its bigrams that some template has, with their places."""
    cut = docs.select(F.col(key).alias("doc_id"), words(F.col(text)).alias("cut"))
    inner = cut.select("doc_id", _inner(F.col("cut")).alias("words"))
    grams = F.zip_with(
        "words",
        F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.struct(F.xxhash64(a, b).alias("hash"), a.alias("one"), b.alias("two")),
    )
    placed = F.transform(grams, lambda g, k: F.struct(k.alias("place"), g["hash"].alias("hash"), g["one"].alias("one"), g["two"].alias("two")))
    found = F.filter(placed, lambda g: g["hash"].isin(hashes))
    return inner.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("bigint").alias("n_words"), found.alias("hits"))


def _widest(grams: Column) -> Column:
    """Words that one copy of a template may spread over."""
    return 2 * grams + APART


def _cut(lines: DataFrame) -> DataFrame:
    """Spans of islands wider than a copy, as repeated notices make them. A diagonal that covers enough of the template is a
    copy by itself. Any other one is judged together with those that begin after it within a copy's reach; of spans that
    begin within one template's length the best, then the first, is kept."""
    alone = F.size("found") / F.col("grams")
    whole = lines.where(alone >= COVERED).select(
        "row", "label", "base", F.col("low").cast("bigint").alias("first"), (F.col("high") + 1).cast("bigint").alias("last"), alone.alias("coverage")
    )
    reach = 2 * max(len(text.split()) - 1 for text in NOTICES.values()) + APART
    after = Window.partitionBy("row", "template", "island").orderBy("low").rangeBetween(0, reach)
    parts = lines.where(alone < COVERED).withColumn("near", F.collect_list(F.struct("high", "found")).over(after))
    parts = parts.withColumn("near", F.filter("near", lambda x: x["high"] < F.col("low") + _widest(F.col("grams"))))
    found = F.array_distinct(F.flatten(F.col("near.found")))
    spans = parts.select(
        "row", "template", "label", "base", F.floor(F.col("low") / F.col("grams")).alias("tile"), F.col("low").cast("bigint").alias("first"),
        (F.array_max("near.high") + 1).cast("bigint").alias("last"), (F.size(found) / F.col("grams")).alias("coverage"),
    ).where(F.col("coverage") >= COVERED)
    best = F.max_by(F.struct("first", "last", "coverage"), F.struct("coverage", -F.col("first"))).alias("best")
    best = spans.groupBy("row", "template", "label", "base", "tile").agg(best)
    return whole.unionByName(best.select("row", "label", "base", "best.*"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): a row per input row with its number of words; a row per verified span with its label, first and last
    word, coverage (0 to 1) and whether it is a base phrase.

    Null and empty texts have no words and no spans. Rows with null or repeated ids and repeated rows are told apart by a
    number that is stored with them. Other columns are ignored. Texts are read once and never shuffled; what is stored,
    joined and grouped are the hits, and spans are grouped by row and template, so common phrases meet in no task.
    """
    spark = docs.sparkSession
    table = templates(spark)
    hashes = [r["hash"] for r in table.select("hash").distinct().collect()]  # of the fixed templates only
    rows = settle(_hits(docs, key, text, hashes), "license-hits")
    votes = rows.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    joined = votes.join(F.broadcast(table), ["hash", "one", "two"])
    joined = joined.select("row", "template", "label", "base", "grams", "place", "at", (F.col("place") - F.col("at")).alias("diagonal"))
    lines = joined.groupBy("row", "template", "label", "base", "grams", "diagonal").agg(
        F.min("place").alias("low"), F.max("place").alias("high"), F.collect_set("at").alias("found")
    )
    base = lines.where(F.col("base") & (F.size("found") == F.col("grams"))).select(
        "row", "label", "base", F.col("diagonal").cast("bigint").alias("first"),
        (F.col("diagonal") + F.col("grams")).cast("bigint").alias("last"), F.lit(1.0).alias("coverage"),
    )
    beside = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(beside)
    islands = lines.where(~F.col("base")).withColumn("opens", F.coalesce((gap > APART).cast("int"), F.lit(0)))
    islands = islands.withColumn("island", F.sum("opens").over(beside))
    all_of_it = Window.partitionBy("row", "template", "island")
    width = F.max("high").over(all_of_it) + 1 - F.min("low").over(all_of_it)
    islands = islands.withColumn("wide", width > _widest(F.col("grams")))
    merged = islands.where(~F.col("wide")).groupBy("row", "template", "label", "base", "grams", "island").agg(
        F.min("low").cast("bigint").alias("first"), (F.max("high") + 1).cast("bigint").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n"),
    )
    notices = merged.withColumn("coverage", F.col("n") / F.col("grams")).where(F.col("coverage") >= COVERED)
    notices = notices.select("row", "label", "base", "first", "last", "coverage").unionByName(_cut(islands.where("wide")))
    spans = base.unionByName(notices)
    return rows.select("row", "doc_id", "n_words"), spans


def summarise(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score (the best coverage)."""
    joined_set = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per = spans.groupBy("row").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        joined_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        joined_set("label").alias("labels"),
        F.max("coverage").alias("score"),
    )
    blank = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return rows.join(per, "row", "left").fillna(blank).drop("row")
