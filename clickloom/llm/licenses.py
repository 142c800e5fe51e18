"""License notices in texts, by voting on diagonals.

Every run of GRAM words of every text is hashed and joined with the runs of the notices (`TEMPLATES`).  A hit at word
`pos` of a text and word `at` of a notice votes for the diagonal pos - at: the place where the notice would begin.
Votes are added up per diagonal; diagonals a few words apart, as inserted or missing words make them, are merged; a
merged span counts if its hits cover enough of the notice's words, and no other notice that begins there more of its own.
All that follows the join is small: only words that stand in some notice get there, and no text moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.words import mix

GRAM = 3
# Diagonals at most so many words apart are one place.
APART = 4
# Rows per Arrow batch, and runs of words in notices up to which their table is broadcast.
ROWS, SMALL = 100_000, 100_000
# The share of a notice's words that a span has to cover.
COVERED = 0.75

# Phrases that name a license, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices that licenses ask for or that are in general use, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "This project is licensed under the terms of the MIT license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(b if b in _LETTERS or b > 127 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, with A-Z in lower case."""
    return text.lower().translate(_TABLE).split() if text else []


def gram_hashes(words: list[bytes], gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash for every run of `gram` words, in order; none for fewer words."""
    n = len(words) - gram + 1
    if n < 1:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.full(n, gram, np.uint64)
    for j in range(gram):
        out = mix(out + one[j:j + n])
    return out


def template_grams(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """(hash, template, at, label, size): the runs of words of every notice."""
    rows = []
    for i, (label, text) in enumerate(templates):
        words = words_of(text.encode())
        rows += [(h, i, at, label, len(words)) for at, h in enumerate(gram_hashes(words, gram).view(np.int64).tolist())]
    return spark.createDataFrame(rows, "hash long, template int, at int, label string, size int")


def _grams(docs: DataFrame, key: str, text: str, gram: int) -> DataFrame:
    """(doc_id, print, pos, hash) for every run of words of every text; print is the text's hash."""
    schema = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("pos", pa.int32()), ("hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, prints, held, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = [len(h) for h in held]
            repeat = np.repeat(np.arange(len(held)), lengths)
            begin = np.repeat(np.cumsum(lengths) - lengths, lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()).take(pa.array(repeat)), pa.array(np.array(prints, np.int64)[repeat]),
                 pa.array((np.arange(len(repeat)) - begin).astype(np.int32)), pa.array(np.concatenate(held))], schema=schema)

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = body.as_py()
                hashes = gram_hashes(words_of(raw), gram).view(np.int64)
                if len(hashes):
                    docs.append(doc)
                    prints.append(_print(raw))
                    held.append(hashes)
                    size += len(hashes)
                if size >= ROWS:
                    yield flush()
                    docs, prints, held, size = [], [], [], 0
        if held:
            yield flush()

    return docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, print long, pos int, hash long")


def _print(raw: bytes | None) -> int:
    return xxhash.xxh3_64_intdigest(raw or b"") - (1 << 63)


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, gram: int = GRAM,
          apart: int = APART) -> DataFrame:
    """(doc_id, print, template, label, first, last, votes, covered): places where some of a notice stands.

    Of neighbouring places the best covered one is given, the first of equal ones.  first and last are the words of the text that the hits reach, covered the share of the notice's words in them.
    Rows with equal doc_id and text have their spans once.
    """
    notices = template_grams(docs.sparkSession, templates, gram)
    # The notices are a short list of the caller's; a long one is joined like any table.
    if sum(len(t) for _, t in templates) <= SMALL:
        notices = F.broadcast(notices)
    place = ["doc_id", "print", "template", "label", "size"]
    # A diagonal takes one vote per word of the notice, so its set is never longer than the notice.
    lines = (_grams(docs, key, text, gram).join(notices, "hash").withColumn("diagonal", F.col("pos") - F.col("at"))
             .groupBy(*place, "diagonal").agg(F.collect_set("at").alias("at")))
    near = Window.partitionBy(*place).orderBy("diagonal")
    after, around = near.rangeBetween(0, apart), near.rangeBetween(-apart, apart)
    merged = lines.select(
        *place, "diagonal", F.flatten(F.collect_list("at").over(after)).alias("at"),
        F.min(F.col("diagonal") + F.array_min("at")).over(after).alias("first"),
        (F.max(F.col("diagonal") + F.array_max("at")).over(after) + (gram - 1)).alias("last"))
    told = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + (gram - 1)))))
    merged = merged.select(*place, "diagonal", "first", "last", F.size("at").alias("votes"), (F.size(told) / F.col("size")).alias("covered"))
    best = F.struct("covered", -F.col("diagonal"))
    # Notices that differ by a word or two start at the same word of the text: the one that covers most is meant.
    rivals = Window.partitionBy("doc_id", "print", "first")
    return (merged.withColumn("most", F.max(best).over(around)).where(F.col("most") == best)
            .withColumn("most", F.max("covered").over(rivals)).where(F.col("most") == F.col("covered"))
            .select("doc_id", "print", "template", "label", "first", "last", "votes", "covered"))


def base_places(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES) -> DataFrame:
    """(doc_id, print, n_words, n_base, first_word, last_word, base_labels) for every row: the places of the fixed phrases."""
    kinds = [("doc_id", pa.int64()), ("print", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
             ("last_word", pa.int64()), ("base_labels", pa.string())]
    schema = pa.schema(kinds)
    wanted = [(f" {p} ".encode(), label) for p, label in phrases.items()]

    def places(words: list[bytes]) -> tuple:
        line, starts, labels = b" " + b" ".join(words) + b" ", [], set()
        for phrase, label in wanted:
            at = line.find(phrase)
            while at >= 0:
                starts.append(line.count(b" ", 0, at))
                labels.add(label)
                # The blank after a place may be the one before the next.
                at = line.find(phrase, at + len(phrase) - 1)
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raws = [body.as_py() for body in batch.column(1)]
                found = list(zip(*((_print(raw), *places(words_of(raw))) for raw in raws), strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(found, list(schema)[1:], strict=True))], schema=schema)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, print long, n_words long, n_base long, first_word long, last_word long, base_labels string")


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", covered: float = COVERED) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of docs.

    Base labels come from the fixed phrases.  labels adds those of the notices of which a place covers the share `covered`;
    score is 1 where a fixed phrase stands, else the largest share of a notice that a place covers, 0 without any.
    Null and empty texts have no words; texts shorter than GRAM words have no votes; rows with equal doc_id and different
    texts are told apart; repeated rows get equal results; rows without doc_id are like others.  An empty table gives no rows.
    """
    none = F.array().cast("array<string>")
    votes = spans(docs, key, text).groupBy("doc_id", "print").agg(
        F.collect_set(F.when(F.col("covered") >= covered, F.col("label"))).alias("found"), F.max("covered").alias("covered"))
    base = base_places(docs, key, text)
    match = base["doc_id"].eqNullSafe(votes["doc_id"]) & (base["print"] == votes["print"])
    own = F.when(F.col("base_labels") != "", F.split("base_labels", ",")).otherwise(none)
    return base.join(votes, match, "left").select(
        base["doc_id"], "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_join(F.array_sort(F.array_union(own, F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("covered", F.lit(0.0))).alias("score"))
