"""License scans by diagonal voting, in DataFrame functions alone.

Every two consecutive words of a text are hashed and joined to the positions at which templates hold
the same two words. A hit votes for its diagonal, the text place minus the template place: hits that
belong together share it, or lie on a neighbouring one where a word was added or lost. Votes are
kept as a bit per template position, so nothing counts twice; neighbouring diagonals are merged, and
a merged span stands when enough of its template is covered within a span not much longer.

A diagonal that covers a whole template is an exact place of the phrase. Base phrases are counted
from those, before any merging. Method labels come from longer notices.

Defined cases: a null or empty text has no words, null first_word and last_word, empty labels and
score 0; a null doc_id is a row like any other; repeated rows are answered once each; texts of one
word hold no pair and so no phrase.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The phrases counted exactly, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices found approximately, and their labels; words only, in lower case.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

GAP = 2
COVER = 0.8
LONGER = 1.5
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MARK = "\x00"


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row per template position: the two words there, and the template's number, label and pairs.

    A row of its own marks the extra entry that every text carries.
    """
    rows = [f"('{MARK}', '', -1, 0, 0, '', false)"]
    for i, (text, label, base) in enumerate([*((p, x, "true") for p, x in phrases.items()), *((p, x, "false") for p, x in notices.items())]):
        words = text.split()
        if not 2 <= len(words) <= 63:
            raise ValueError("a template has 2 to 63 words")
        rows += [f"('{a}', '{b}', {i}, {at}, {len(words) - 1}, '{label}', {base})" for at, (a, b) in enumerate(zip(words, words[1:]))]
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(left, right, template, spot, pairs, label, base)")
    return table.withColumn("gram", F.xxhash64("left", "right"))


def scan_licenses(
    documents: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None,
    cover: float = COVER, gap: int = GAP,
) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    ``spans`` are the verified places: label, first word and exclusive end.
    """
    spark = documents.sparkSession
    # the Kelvin sign is the one letter whose lower case is an ASCII letter, which it must not become
    body = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("K"), F.lit("é")))
    parts = F.split(body, WORD_BREAK)
    rows = documents.select("doc_id", F.xxhash64("text").alias("body"), parts.alias("parts"))
    lead = (F.col("parts")[0] == "").cast("int")
    tail = F.when(F.size("parts") > 1, (F.element_at("parts", -1) == "").cast("int")).otherwise(0)
    ahead = F.slice("parts", 2, F.size("parts"))
    rows = rows.select(
        "doc_id", "body", lead.alias("lead"), (F.size("parts") - lead - tail).cast("long").alias("n_words"),
        F.concat(
            F.array(F.struct(F.lit(MARK).alias("left"), F.lit("").alias("right"))),
            F.arrays_zip(F.col("parts").alias("left"), ahead.alias("right")),
        ).alias("entries"),
    )
    rows = rows.select("doc_id", "body", "lead", "n_words", F.posexplode("entries").alias("at", "entry"))
    rows = rows.select(
        "doc_id", "body", "n_words", (F.col("at") - 1 - F.col("lead")).alias("at"), F.col("entry.left").alias("l"), F.col("entry.right").alias("r"),
    ).where("r IS NOT NULL").withColumn("gram", F.xxhash64("l", "r"))
    hits = rows.join(templates(spark, phrases or BASE, NOTICES if notices is None else notices), "gram").where("l = left AND r = right")
    hits = hits.select("doc_id", "body", "n_words", "template", "spot", "pairs", "label", "base", "at")
    diagonals = hits.groupBy("doc_id", "body", "n_words", "template", "pairs", "label", "base", (F.col("at") - F.col("spot")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, spot)")).alias("voted"), F.count("*").alias("copies"),
        F.min("at").alias("first"), (F.max("at") + 2).alias("end"),
    )
    along = Window.partitionBy("doc_id", "body", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > gap).cast("int"), F.lit(1))
    grouped = diagonals.withColumn("new", new).withColumn("run", F.sum("new").over(along)).groupBy(
        "doc_id", "body", "n_words", "template", "pairs", "label", "base", "run"
    ).agg(
        F.bit_or("voted").alias("voted"), F.min("first").alias("first"), F.max("end").alias("end"), F.max("copies").alias("copies"),
        F.sum(F.when(F.col("base") & (F.bit_count("voted") == F.col("pairs")), 1).otherwise(0)).alias("places"),
        F.min(F.when(F.col("base") & (F.bit_count("voted") == F.col("pairs")), F.col("diagonal"))).alias("low"),
        F.max(F.when(F.col("base") & (F.bit_count("voted") == F.col("pairs")), F.col("diagonal"))).alias("high"),
    )
    covered = F.bit_count("voted") / F.col("pairs")
    whole = F.col("end") - F.col("first") <= F.lit(LONGER) * (F.col("pairs") + 1)
    stands = F.when(F.col("template") < 0, F.lit(False)).when(F.col("base"), F.col("places") > 0).otherwise((covered >= cover) & whole)
    grouped = grouped.withColumn("stands", stands)
    out = grouped.groupBy("doc_id", "body").agg(
        F.max("n_words").alias("n_words"), F.sum("places").cast("long").alias("n_base"), F.min("low").cast("long").alias("first_word"),
        F.max("high").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("places") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("stands"), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("places") > 0, 1.0).when(F.col("template") >= 0, F.least(covered, F.lit(1.0)))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("stands") & ~F.col("base"), F.struct("first", "end", "label")))).alias("spans"),
        F.max(F.when(F.col("template") < 0, F.col("copies"))).alias("copies"),
    )
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_copy", "copies", "body")
