"""License scan by diagonal voting.

Every rolling word k-gram of a text is hashed and joined (broadcast, the template table is
fixed) with the k-gram positions of the license templates. A match votes for the diagonal
``text position - template position``. Votes are counted per diagonal; neighbouring
diagonals (an inserted or lost word moves the rest of a notice to the next one) are merged
into one span; a span is verified by the share of the template's distinct k-grams that stand
in it, word by word. Of overlapping spans the best covered stays, of equally covered ones
the longest wording, so that a notice with a version beats the one without and the other way
round; what is still equal goes to the label that sorts first.
The base phrases are templates too: a phrase stands where its diagonal is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import ascii_words, lower_ascii, stored, whole_text, with_window_hashes

K = 3
#: Diagonals of one template at most this far apart, and spans with at most this many words between, merge.
NEAR_DIAGONALS = 3
NEAR_WORDS = 12
#: Share of a template's k-grams that a merged span must cover.
COVER = 0.6
#: Overlapping spans meet in cells of this many words.
CELL = 64

# The phrases asked for and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Wordings of public license notices and the labels they stand for.
NOTICES = [
    ("mit", "licensed under the mit license"),
    ("mit", "released under the terms of the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
                 "http www apache org licenses license 2 0"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "you should have received a copy of the gnu general public license along with this program if not see"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided "
                     "that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc-sa", "licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nc-nd", "licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved unauthorized copying of this file via any medium is strictly prohibited"),
]


def template_grams(spark: SparkSession, phrases=None, notices=None, k: int = K) -> DataFrame:
    """(gram, run, places): each k-gram of the templates with its (template, label, exact, position, total)."""
    rows = [(i, label, True, text.split()) for i, (label, text) in enumerate(PHRASES if phrases is None else phrases)]
    rows += [(i + len(rows), label, False, text.split()) for i, (label, text) in enumerate(NOTICES if notices is None else notices)]
    if any(len(words) < k for *_, words in rows):
        raise ValueError(f"every template needs at least {k} words")
    if any(len(words) - k + 1 > 64 for *_, words in rows):
        raise ValueError("a template holds 64 k-grams at most (their places are the bits of a long)")
    templates = spark.createDataFrame(rows, "template int, label string, exact boolean, words array<string>")
    hashed = with_window_hashes(templates, "words", k, "grams")
    return (
        hashed.select("template", "label", "exact", "words", F.size("grams").alias("total"), F.posexplode("grams").alias("position", "gram"))
        .groupBy("gram", F.slice("words", F.col("position") + 1, F.lit(k)).alias("run"))
        .agg(F.collect_list(F.struct("template", "label", "exact", "position", "total")).alias("places"))
    )


def votes(documents: DataFrame, k: int = K) -> DataFrame:
    """(row, doc_id, n_words, at, places): the verified k-gram matches, and one row (at = 0) a document."""
    docs = documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        ascii_words(lower_ascii(whole_text())).alias("words"),
    )
    docs = with_window_hashes(docs, "words", k, "grams")
    probes = F.concat(F.array(F.lit(None).cast("bigint")), F.col("grams"))
    probed = docs.select("row", "doc_id", "words", F.posexplode(probes).alias("at", "gram")).alias("p")
    grams = F.broadcast(template_grams(documents.sparkSession, k=k)).alias("t")
    match = (F.col("p.gram") == F.col("t.gram")) & (F.slice("words", F.greatest(F.col("at"), F.lit(1)), F.lit(k)) == F.col("run"))
    return (
        probed.join(grams, match, "left")
        .where((F.col("at") == 0) | F.col("places").isNotNull())
        .select("row", "doc_id", F.when(F.col("at") == 0, F.size("words").cast("long")).alias("n_words"), (F.col("at") - 1).alias("at"), "places")
    )


def diagonals(matches: DataFrame) -> DataFrame:
    """One row per document row, template and diagonal with votes: its votes, the template places seen, and first and last text position."""
    by = ["row", "template", "label", "exact", "total"]
    return (
        matches.where(F.col("places").isNotNull())
        .select("row", "at", F.explode("places").alias("place"))
        .select("row", "at", "place.*")
        .groupBy(*by, (F.col("at") - F.col("position")).alias("diagonal"))
        .agg(F.count(F.lit(1)).alias("votes"), F.bit_or(F.expr("shiftleft(1L, position)")).alias("seen"), F.min("at").alias("low"), F.max("at").alias("high"))
    )


def spans(diagonal: DataFrame, k: int = K) -> DataFrame:
    """Neighbouring diagonals of a template merged: (row, template, label, first, last, cover), verified.

    Diagonals are walked in the order of the text; one that continues the span so far
    (close on both the diagonal and the word axis) joins it, else it begins a new span.
    """
    order = Window.partitionBy("row", "template").orderBy("low", "diagonal")
    gap = F.abs(F.col("diagonal") - F.lag("diagonal").over(order))
    far = F.col("low") - F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when((gap <= NEAR_DIAGONALS) & (far <= NEAR_WORDS + k), 0).otherwise(1)
    numbered = diagonal.where(~F.col("exact")).withColumn("begins", begins).withColumn("span", F.sum("begins").over(order))
    merged = numbered.groupBy("row", "template", "label", "total", "span").agg(
        F.min("low").alias("first"), F.max("high").alias("last"), F.bit_count(F.bit_or("seen")).alias("seen")
    )
    cover = F.col("seen") / F.col("total")
    return merged.select("row", "template", "label", "first", (F.col("last") + k - 1).alias("last"), cover.alias("cover"), "seen").where(cover >= COVER)


def strongest(found: DataFrame) -> DataFrame:
    """Spans without those that overlap a better one of another label: better covered, or as well and longer, or else first by label."""
    cells = F.explode(F.sequence(F.floor(F.col("first") / CELL), F.floor(F.col("last") / CELL))).alias("cell")
    a = found.select("*", cells).alias("a")
    b = found.select(F.col("row"), cells, F.col("first").alias("low"), F.col("last").alias("high"), F.struct("cover", "seen").alias("strength"), F.col("label").alias("other")).alias("b")
    stronger = "strength > struct(cover, seen) or (strength = struct(cover, seen) and other < label)"
    beaten = a.join(b, ["row", "cell"]).where(f"low <= last and high >= first and other <> label and ({stronger})").select("row", "template", "first").distinct()
    return found.join(beaten, ["row", "template", "first"], "left_anti")


def licenses(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document row.

    ``score`` is the best cover of a verified span or base phrase (0 without any). Null and
    empty texts have no words, no places (first_word and last_word null) and empty labels;
    repeated rows each get their row. Only ``doc_id`` and ``text`` are read.
    """
    found = stored(votes(documents), "license-votes")
    lines = diagonals(found)
    base = lines.where(F.col("exact") & (F.col("votes") == F.col("total"))).select(
        "row", "label", F.col("diagonal").cast("long").alias("place"), F.lit(1.0).alias("cover")
    )
    own = strongest(stored(spans(lines), "license-spans")).select("row", "label", F.lit(None).cast("long").alias("place"), "cover")
    marked: Column = F.col("place").isNotNull()
    labels = base.unionByName(own).groupBy("row").agg(
        F.count("place").alias("n_base"), F.min("place").alias("first_word"), F.max("place").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(marked, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("cover").alias("score"),
    )
    return (
        found.where(F.col("n_words").isNotNull()).select("row", "doc_id", "n_words")
        .join(labels, "row", "left")
        .select(
            "doc_id", "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
            F.coalesce("base_labels", F.lit("")).alias("base_labels"),
            F.coalesce("labels", F.lit("")).alias("labels"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
