"""Removing lines that other documents hold too, by probing a sharded minimal perfect hash.

The distinct hashes of all lines are dealt to shards.  A shard is one minimal perfect hash function and
three flat arrays in its order: a fingerprint, the number of documents, and the first document.
Documents send the hashes of their lines to the shards and probe the arrays; no line text moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.words import mix
from clickloom.session import write_down

LEAST = 10
BLANK = b" \t\n\x0b\x0c\r"
# Distinct hashes per shard, and probes of one shard per task.
SHARD, PROBES = 250_000, 250_000

_LOAD = 1.5


class PerfectHash:
    """A minimal perfect hash over distinct pairs of 64-bit words.

    Level by level, keys are thrown at a bit array 1.5 times their number.  Keys alone on their bit are
    placed, the others go on to the next level.  A key's index is the number of set bits before its own.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.levels: list[np.ndarray] = []
        while len(first):
            size = max(1, int(len(first) * _LOAD))
            at = self._bit(first, second, len(self.levels), size)
            bits = np.bincount(at, minlength=size) == 1
            self.levels.append(bits)
            again = ~bits[at]
            first, second = first[again], second[again]
        self._count()

    @staticmethod
    def _bit(first, second, level, size):
        return (mix(first ^ mix(second + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def _count(self):
        self.before, placed = [], 0
        for bits in self.levels:
            ranks = np.cumsum(bits) - bits + placed
            self.before.append(ranks)
            placed += int(bits.sum())

    def index(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The index of each key; -1 where no level has its bit, which only happens to keys not built in."""
        found, open_ = np.full(len(first), -1, np.int64), np.arange(len(first))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.before, strict=True)):
            at = self._bit(first[open_], second[open_], level, len(bits))
            hit = bits[at]
            found[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return found

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return sizes.tobytes() + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        self, n = cls.__new__(cls), int(np.frombuffer(data, np.int64, 1)[0])
        sizes, at, self.levels = np.frombuffer(data, np.int64, n, 8), 8 + 8 * n, []
        for size in sizes:
            width = (int(size) + 7) // 8
            self.levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=int(size)).astype(bool))
            at += width
        self._count()
        return self


def line_key(line: bytes) -> bytes | None:
    """The stripped, lower-cased line, or None if it has fewer than LEAST code points."""
    key = line.strip(BLANK).lower()
    if len(key) < LEAST or len(key) < 4 * LEAST and len(key.decode("utf-8", "replace")) < LEAST:
        return None
    return key


def _hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return (h >> 64) - (1 << 63), (h & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def line_hashes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, h1, h2) for every distinct line key of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, firsts, seconds = [], [], []
            for doc, body in zip(batch.column(0), batch.column(1), strict=True):
                keys = {k for k in map(line_key, (body.as_py() or b"").split(b"\n")) if k}
                ids.extend([doc.as_py()] * len(keys))
                for k in keys:
                    a, b = _hash(k)
                    firsts.append(a)
                    seconds.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, firsts, seconds)], schema=schema)

    return docs.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, "doc_id long, h1 long, h2 long")


def build_index(counted: DataFrame, shards: int) -> DataFrame:
    """(shard, probes, hash, prints, counts, owners): one row per shard, from (h1, h2, docs, owner)."""
    def run(table: pa.Table) -> pa.Table:
        h1, h2, docs, owner = (table.column(c).to_numpy() for c in ("h1", "h2", "docs", "owner"))
        perfect = PerfectHash(h1.view(np.uint64), h2.view(np.uint64))
        at = perfect.index(h1.view(np.uint64), h2.view(np.uint64))
        prints, counts, owners = np.empty(len(at), np.uint32), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        prints[at], counts[at], owners[at] = h2.view(np.uint64).astype(np.uint32), docs, owner
        return pa.table({"shard": table.column("shard")[:1], "probes": pa.array([int(docs.sum())], pa.int64()),
                         "hash": pa.array([perfect.dump()], pa.binary()), "prints": pa.array([prints.tobytes()], pa.binary()),
                         "counts": pa.array([counts.tobytes()], pa.binary()), "owners": pa.array([owners.tobytes()], pa.binary())})

    return (counted.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int")).groupBy("shard")
            .applyInArrow(run, "shard int, probes long, hash binary, prints binary, counts binary, owners binary"))


def repeated_lines(hashes: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(doc_id, h1, h2) of lines that other documents hold and an earlier one owns.

    The probes of a shard are dealt to as many tasks as their number asks for, each with the shard's
    arrays, so a line that most documents hold is no bottleneck.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
    fans = index.select("shard", F.ceil(F.col("probes") / PROBES).cast("int").alias("fans"))
    asked = (hashes.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int")).join(fans, "shard")
             .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("fans")).cast("int")).drop("fans"))
    arrays = index.join(fans, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("fans") - 1)))

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return schema.empty_table()
        doc, h1, h2 = (left.column(c).to_numpy() for c in ("doc_id", "h1", "h2"))
        perfect = PerfectHash.load(right.column("hash")[0].as_py())
        prints, counts, owners = (np.frombuffer(right.column(c)[0].as_py(), t)
                                  for c, t in (("prints", np.uint32), ("counts", np.int64), ("owners", np.int64)))
        at = perfect.index(h1.view(np.uint64), h2.view(np.uint64))
        gone = (at >= 0) & (prints[at] == h2.view(np.uint64).astype(np.uint32)) & (counts[at] > 1) & (owners[at] != doc)
        return pa.table([doc[gone], h1[gone], h2[gone]], schema=schema)

    return asked.groupBy("shard", "salt").cogroup(arrays.groupBy("shard", "salt")).applyInArrow(probe, "doc_id long, h1 long, h2 long")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text, kept_sha256) for every row of docs.

    A line's key is the line without blanks at both ends and with A-Z in lower case.  A key of at least ten
    code points that two or more documents hold stays only in the document with the smallest doc_id, there
    with all its lines.  Null or empty texts are one empty line.  Rows without doc_id keep all lines and own
    none; rows with equal doc_id are one document for counting.  An empty table gives no rows.
    """
    hashes = write_down(line_hashes(docs, key, text))
    counted = write_down(hashes.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("owner")))
    shards = max(1, -(-counted.count() // SHARD))
    index = write_down(build_index(counted, shards))
    gone = (repeated_lines(hashes, index, shards).groupBy("doc_id")
            .agg(F.collect_list("h1").alias("h1"), F.collect_list("h2").alias("h2")))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).join(
        gone.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "h1", "h2")
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_text", pa.string()),
                        ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dropped, kept, sums = [], [], [], []
            for body, first, second in zip(*(batch.column(i) for i in (1, 2, 3)), strict=True):
                lines = (body.as_py() or b"").split(b"\n")
                total.append(len(lines))
                if first.is_valid:
                    bad = set(zip(first.as_py(), second.as_py(), strict=True))
                    keys = ((line, line_key(line)) for line in lines)
                    lines = [line for line, k in keys if k is None or _hash(k) not in bad]
                dropped.append(total[-1] - len(lines))
                left = b"\n".join(lines)
                kept.append(left.decode("utf-8", "replace"))
                sums.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in (
                (total, pa.int64()), (dropped, pa.int64()), (kept, pa.string()), (sums, pa.string())))], schema=schema)

    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_text string, kept_sha256 string")
