"""License scans by diagonal voting (operator 10).

1. One pass gives the hashes of all rolling word k-grams of every text, in order.
2. They are joined with the k-grams of the templates (a fixed list, a row per k-gram).  A
   match at word p of a text and word q of a template votes for the diagonal p - q.
3. Votes are counted by text, template and diagonal; a bit for each template word tells which
   of its k-grams matched (``BITS`` words a column, as many columns as the longest template
   needs, so whole license texts may be templates).
4. Neighbouring diagonals (up to ``SLACK`` words inserted or left out) are merged into a span.
5. A span is verified: the matches must cover ``COVER`` of the template's words within a
   stretch of at most ``STRETCH`` times its length.

A phrase stands at a place exactly when all its k-grams vote for one diagonal; so the phrases'
places come from the same votes, before merging.

Words are runs of ``[0-9a-z]`` and non-ASCII characters, after lowering A-Z.

Defined cases: null and empty texts have no words, no places and a score of 0; rows are scanned
one by one, so rows that share a doc_id, and null ids, each get a row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sensorgrid.llm.common import map_batches, quoted
from sensorgrid.llm.words import SYMBOLS, Words, chunks, numbers, utf8

K = 3
SLACK = 4
COVER = 0.7
STRETCH = 1.5
#: Template words a column of bits stands for.
BITS = 62

# Phrases and labels that are counted word for word.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences of public license notices, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license": "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "lesser general public license as published by the free software foundation": "lgpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee "
    "is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under the creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "licensed under the creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under the creative commons attribution 4 0 international license": "cc-by",
}

#: Ends the list of k-grams of every text, so that texts without a match keep a row.
END = int(numbers(1, 77)[0].astype(np.int64))


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, SYMBOLS)


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str], k: int) -> tuple[DataFrame, int]:
    """``gram, template, place, n_template, label, exact``, one row per k-gram of each template,
    and the number of words of the longest one."""
    rows = [(END, -1, 0, 0, None, False)]
    for number, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        words = _words(*utf8(pa.array([text])))
        n = int(words.counts()[0])
        if n < k:
            raise ValueError(f"a template has at least {k} words: {text}")
        grams = words.grams(k)[0].view(np.int64)
        rows += [(int(g), number, q, n, label, number < len(phrases)) for q, g in enumerate(grams)]
    kind = "gram long, template int, place int, n_template int, label string, exact boolean"
    return spark.createDataFrame(rows, kind), max(row[3] for row in rows)


def _grams(k: int):
    """Rows (uid, id, text): number of words, and all k-grams with the end mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(2))
            for a, b in chunks(off):
                words = _words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                grams, first = words.grams(k)
                marked = np.insert(grams.view(np.int64), first[1:], END)
                lists = pa.ListArray.from_arrays(pa.array((first + np.arange(len(first))).astype(np.int32)), pa.array(marked))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns[:2]), pa.array(words.counts(), pa.int64()), lists],
                    names=["uid", "doc_id", "n_words", "grams"],
                )

    return run


def license_votes(docs: DataFrame, phrases: dict[str, str], notices: dict[str, str], k: int, id_col: str, text_col: str) -> DataFrame:
    """Votes by row, template and diagonal (``start``); template -1 stands for the row itself."""
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    grams = map_batches(texts, _grams(k), f"uid long, doc_id {kind}, n_words long, grams array<long>")
    rolling = grams.select("uid", "doc_id", "n_words", F.posexplode("grams").alias("at", "gram"))
    # As many rows as the caller's list of templates has words.
    known, longest = templates(docs.sparkSession, phrases, notices, k)
    matches = rolling.join(F.broadcast(known), "gram")
    start = F.when(F.col("template") < 0, 0).otherwise(F.col("at") - F.col("place"))
    return matches.groupBy(
        "uid", "doc_id", "n_words", "template", "n_template", "label", "exact", start.cast("long").alias("start")
    ).agg(
        *[
            F.bit_or(F.expr(f"if(place div {BITS} = {i}, shiftleft(1L, place % {BITS}), 0L)")).alias(f"bits{i}")
            for i in range(max(1, -(-longest // BITS)))
        ],
        F.min("at").alias("low"), F.max("at").alias("high"),
    )


def _bits(votes: DataFrame) -> list[str]:
    return [f"bits{i}" for i in range(sum(c.startswith("bits") for c in votes.columns))]


def _count(columns):
    return reduce(lambda a, b: a + b, [F.bit_count(c) for c in columns])


def _covered(names: list[str], k: int):
    """Template words under the matched k-grams: the words of a k-gram may lie in two columns."""
    words = []
    for i, name in enumerate(names):
        wide = F.col(name)
        for j in range(1, k):
            wide = wide.bitwiseOR(F.shiftleft(name, j))
            if i:
                wide = wide.bitwiseOR(F.shiftrightunsigned(names[i - 1], BITS - j))
        words.append(wide.bitwiseAND(F.lit((1 << BITS) - 1)))
    return _count(words)


def license_spans(votes: DataFrame, k: int = K) -> DataFrame:
    """Neighbouring diagonals of a template merged into spans, each verified (``found``).

    ``places`` counts the diagonals on which a whole phrase stands, ``first`` and ``last`` are the
    smallest and largest of them.  A window holds the diagonals of one template in one text."""
    order = Window.partitionBy("uid", "template").orderBy("start")
    opens = F.when(F.col("start") - F.lag("start").over(order) <= SLACK, 0).otherwise(1)
    marked = votes.withColumn("opens", opens).withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    names = _bits(votes)
    place = F.col("exact") & (_count(map(F.col, names)) == F.col("n_template") - k + 1)
    spans = marked.groupBy("uid", "doc_id", "n_words", "template", "n_template", "label", "span").agg(
        *[F.bit_or(c).alias(c) for c in names], F.min("low").alias("low"), F.max("high").alias("high"),
        F.count_if(place).alias("places"),
        F.min(F.when(place, F.col("start"))).alias("first"), F.max(F.when(place, F.col("start"))).alias("last"),
    )
    cover = F.when(F.col("template") < 0, 0.0).otherwise(_covered(names, k) / F.col("n_template"))
    near = (F.col("high") - F.col("low") + k) <= STRETCH * F.col("n_template")
    return spans.withColumn("cover", cover).withColumn("found", (F.col("places") > 0) | ((F.col("cover") >= COVER) & near))


def scan_licenses(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, k: int = K,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the largest share of any template's words that a span covers."""
    spans = license_spans(license_votes(docs, phrases, notices, k, id_col, text_col), k)

    def names(column):
        return F.array_join(F.array_sort(F.collect_set(column)), ",")

    return spans.groupBy("uid", "doc_id", "n_words").agg(
        F.sum("places").alias("n_base"), F.min("first").alias("first_word"), F.max("last").alias("last_word"),
        names(F.when(F.col("places") > 0, F.col("label"))).alias("base_labels"),
        names(F.when(F.col("found"), F.col("label"))).alias("labels"),
        F.max("cover").cast("double").alias("score"),
    ).drop("uid")
