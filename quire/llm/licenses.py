"""License scans by diagonal voting.

All rolling word k-grams of a text are joined with the k-grams of templates. A hit says where in
the text the template would begin, its diagonal; hits of one diagonal are votes for one place.
Neighbouring diagonals, which differ by a few added or missing words, are merged, and a merged
span is verified by the share of the template that its hits cover. For a phrase every k-gram has
to vote on the very same diagonal, so each such diagonal is an occurrence.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import grams, keyed, long_lists, map_text, plain_words, with_found, word_count, word_hashes, written

#: Phrases to be found word by word, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Excerpts of public license texts; the labels that this operator adds.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at",
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

#: Words in a k-gram of a notice and of a phrase.
NOTICE_GRAM = 4
PHRASE_GRAM = 2
#: Merged diagonals differ by at most this many words, and follow each other within as many.
SLACK = 5
#: Share of a notice that a span has to cover.
COVER = 0.6


def _grams_of(texts: list[str | None]) -> list:
    hashes, lengths = word_hashes([plain_words(text) for text in texts])
    return [lengths, *(long_lists(*grams(hashes, lengths, n)) for n in (PHRASE_GRAM, NOTICE_GRAM))]


def templates(spark: SparkSession, texts: dict[str, str], k: int) -> DataFrame:
    """(gram, template, at, n_grams, template_words) of all k-grams; a text of fewer than ``k`` words is refused."""
    rows = []
    for name, text in texts.items():
        hashes, lengths = word_hashes([plain_words(text)])
        values, count = grams(hashes, lengths, k)
        if not len(values):
            raise ValueError(f"{name!r} has fewer than {k} words")
        rows += [(gram, name, at, int(count[0]), int(lengths[0])) for at, gram in enumerate(values.astype("int64").tolist())]
    return spark.createDataFrame(rows, "gram long, template string, at int, n_grams int, template_words int")


def votes(rows: DataFrame, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """Hits of (doc_id, text_key, text) rows by template and diagonal: from where to where, which places of the template.

    One place of a template has one word of the text on a diagonal, so repeated rows add nothing.
    """
    spark = rows.sparkSession
    found = map_text(
        rows, lambda: _grams_of, ("doc_id", "text_key", "text"),
        "n_words bigint, pairs array<bigint>, grams array<bigint>", [pa.int64()] + [pa.list_(pa.int64())] * 2,
    )
    every = found.select("doc_id", "text_key", "n_words", F.posexplode(F.concat("pairs", "grams")).alias("pos", "gram"))
    n_pairs = (F.col("n_words") - PHRASE_GRAM + 1).cast("int")
    placed = every.withColumn("pos", F.when(F.col("pos") < n_pairs, F.col("pos")).otherwise(F.col("pos") - n_pairs))
    of = templates(spark, {p: p for p in phrases}, PHRASE_GRAM).unionByName(templates(spark, notices, NOTICE_GRAM))
    hits = placed.join(F.broadcast(of), "gram")
    diagonal = (F.col("pos") - F.col("at")).alias("diagonal")
    return hits.groupBy("doc_id", "text_key", "template", "n_grams", "template_words", diagonal).agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("at").alias("places")
    )


def notice_spans(diagonals: DataFrame) -> DataFrame:
    """(doc_id, text_key, template, start, end, cover): verified spans, in words of the text, end exclusive."""
    keys = ["doc_id", "text_key", "template"]
    order = Window.partitionBy(*keys).orderBy("first", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > SLACK) | (
        F.col("first") - F.lag("last").over(order) > SLACK + NOTICE_GRAM
    )
    spans = diagonals.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    spans = spans.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = spans.groupBy(*keys, "n_grams", "template_words", "span").agg(
        F.min("first").alias("start"), (F.max("last") + NOTICE_GRAM).alias("end"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
    )
    cover = F.size("places") / F.col("n_grams")
    fits = F.col("end") - F.col("start") <= 2 * F.col("template_words")
    return merged.where((cover >= COVER) & fits).select(*keys, "start", "end", cover.alias("cover"))


def scan(
    df: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of each whole text.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are their smallest
    and largest start (null without places), ``base_labels`` their labels, ``labels`` those and
    the names of notices with a verified span; both are distinct, sorted and comma-joined.
    ``score`` is 1 with a phrase, else the largest share of a notice covered, else 0.

    A null or empty text has no words. Rows are told apart by id and text: repeated rows have the
    same result each, null ids too. Templates are small and given by the caller, so they are
    broadcast; hits are counted within the task that reads a text before anything is shuffled.
    """
    rows, keys = keyed(df, key, text), ["doc_id", "text_key"]
    diagonals = written(votes(rows, phrases, notices), "license-votes")
    names = F.create_map(*[F.lit(x) for pair in phrases.items() for x in pair])
    full = diagonals.where(F.col("template").isin(list(phrases)) & (F.size("places") == F.col("n_grams")))
    base = full.groupBy(*keys).agg(
        F.count("*").alias("n_base"), F.min("diagonal").cast("long").alias("first_word"),
        F.max("diagonal").cast("long").alias("last_word"), F.collect_set(names[F.col("template")]).alias("base_labels"),
    )
    spans = notice_spans(diagonals.where(F.col("template").isin(list(notices))))
    more = spans.groupBy(*keys).agg(F.max("cover").alias("cover"), F.collect_set("template").alias("more_labels"))
    none = F.array().cast("array<string>")
    found = with_found(with_found(rows.select(*keys, word_count("text").alias("n_words")), base), more)
    base_labels, more_labels = F.coalesce("base_labels", none), F.coalesce("more_labels", none)
    return found.select(
        F.col("doc_id").alias(key), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.concat_ws(",", F.array_sort(base_labels)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base_labels, more_labels))).alias("labels"),
        F.when(F.size(base_labels) > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
