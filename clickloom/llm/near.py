"""Near-duplicate documents by b-bit MinHash signatures and a multi-index Hamming join.

A signature has CHUNKS chunks of CHUNK symbols, each a 16-bit MinHash.  Two signatures that differ in
at most (ERRORS + 1) * CHUNKS - 1 symbols agree, by pigeonhole, in some chunk up to ERRORS symbols, so
they share one of the keys made by leaving out ERRORS symbols of each chunk.  That finds every such pair.
At similarity 0.75 signatures differ in 10 of 40 symbols on average, and in more than 19 with a probability
of 3e-4; all pairs found are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.spread import compare_pairs, components
from clickloom.llm.words import common, min_hashes, mix, odd_multipliers, shingle_set
from clickloom.session import write_down

CHUNKS, CHUNK, ERRORS = 10, 4, 1
# The distance of signatures up to which all pairs are found.
FAR = (ERRORS + 1) * CHUNKS - 1
# Members of a cell's part and slice, about, and shingles of all of them together, which bound its memory.
BLOCK, SHINGLES = 2048, 1 << 21
# Another round of hubs pays if the last one linked at least one in GAIN members it was for.
GAIN = 20
SEED = 20240901
PERCENT = 75

_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("signature", pa.binary())])


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, print, signature): set size, 128-bit fingerprint of the set, 16-bit symbols."""
    multipliers = odd_multipliers(CHUNKS * CHUNK, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, signs = [], [], []
            for body in batch.column(1):
                found = shingle_set(body.as_py())
                sizes.append(len(found))
                prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                signs.append((mix(min_hashes(found, multipliers)) & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())],
                schema=_SIGNED)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, print binary, signature binary")


def chunk_keys(signed: DataFrame) -> DataFrame:
    """(key, node, n): the keys of every chunk with one symbol left out; the symbols are packed, not hashed again."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                rows = part.num_rows
                symbols = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16)
                symbols = symbols.reshape(rows, CHUNKS, CHUNK).astype(np.int64)
                keys = np.empty((rows, CHUNKS, CHUNK), np.int64)
                for gone in range(CHUNK):
                    packed = np.arange(CHUNKS, dtype=np.int64)[None, :] * CHUNK + gone
                    for i in range(CHUNK):
                        if i != gone:
                            packed = (packed << 16) | symbols[:, :, i]
                    keys[:, :, gone] = packed
                each = CHUNKS * CHUNK
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), each)),
                     pa.array(np.repeat(part.column(1).to_numpy(zero_copy_only=False), each))], schema=schema)

    return signed.select("node", "n", "signature").mapInArrow(run, "key long, node long, n long")


def _links(pairs: DataFrame, docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def judge(centre, member, a, b, note):
        shared = common(centre, member)
        if 100 * shared >= percent * (len(centre) + len(member) - shared):
            yield a, b

    return compare_pairs(pairs.withColumn("note", F.lit(None).cast("string")), docs, key, text, shingle_set, judge,
                         pa.schema([("a", pa.int64()), ("b", pa.int64())]), "a long, b long")


def _near_size(x: str, y: str, percent: int):
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _symbols(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint16).reshape(len(signatures), CHUNKS * CHUNK)


def _hub_pairs(members: DataFrame, percent: int, turn: int = 0) -> DataFrame:
    """(a, b): each node with one hub, out of the hubs of its buckets.

    A bucket's hub is the node first in an order by hash (of this turn) among its outer members, so that a group of copies
    has the same hub in most of its buckets.  A node takes the hub with the nearest signature.
    """
    order = F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node", "n", "at", "signature")
    hubs = members.where(~F.col("inner")).groupBy("key").agg(F.min(order).alias("hub")).select("key", "hub")
    met = (members.join(hubs, "key").where(F.col("at") != F.col("hub.at")).where(_near_size("n", "hub.n", percent))
           .select(F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.signature").alias("s"), "signature"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("far", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = (_symbols(batch.column(2).to_pylist()) != _symbols(batch.column(3).to_pylist())).sum(axis=1)
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(far, pa.int32())], schema=schema)
            yield rows.filter(pa.array(far <= FAR))

    return (met.mapInArrow(run, "a long, b long, far int").groupBy("b").agg(F.min(F.struct("far", "a"))["a"].alias("a"))
            .select("a", "b"))


def _open_buckets(members: DataFrame, reached: DataFrame) -> DataFrame:
    """The members of the buckets that hold more than one component, with `at`, the component, and `inner`.

    A member of its bucket's largest component is inner.  Inner members need no comparison with each other.
    """
    at = (members.select("key", "node", "n", "signature").join(reached, "node", "left")
          .withColumn("at", F.coalesce("component", "node")).drop("component"))
    sizes = at.groupBy("key", "at").agg(F.count(F.lit(1)).alias("size"))
    most = sizes.groupBy("key").agg(F.max(F.struct("size", "at"))["at"].alias("most"), F.count(F.lit(1)).alias("parts"))
    return write_down(at.join(most.where("parts > 1").drop("parts"), "key").withColumn("inner", F.expr("at = most")).drop("most"))


def _dealt(members: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (key, part, slice, role, node, at, inner, *columns) of cells that together hold every pair with an outer member.

    The outer members of a bucket are cut into parts of about BLOCK members or SHINGLES shingles, all its members
    into slices of that size; a cell holds one part (role 0), then one slice passes (role 1).  With one part, as in
    any bucket that one component all but fills, that is at most three rows for each member, however large the bucket.
    """
    def pieces(chosen):
        members_of, shingles_of = F.count_if(chosen) / BLOCK, F.coalesce(F.sum(F.when(chosen, F.col("n"))), F.lit(0)) / SHINGLES
        return F.ceil(F.greatest(members_of, shingles_of)).cast("int")

    counts = members.groupBy("key").agg(pieces(~F.col("inner")).alias("parts"), pieces(F.lit(True)).alias("slices"))
    counts = counts.where("parts > 0")
    dealt = members.select("key", "node", "at", "inner", *columns).join(counts, "key")
    spread = F.xxhash64("node")

    def cell(count: str):
        return F.pmod(spread, F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    kept = ["node", "at", "inner", *columns]
    held = dealt.where(~F.col("inner")).select("key", cell("parts").alias("part"), every("slices").alias("slice"),
                                               F.lit(0).alias("role"), *kept)
    passing = dealt.select("key", every("parts").alias("part"), cell("slices").alias("slice"), F.lit(1).alias("role"), *kept)
    return held.union(passing).repartition("key", "part", "slice").sortWithinPartitions("key", "part", "slice", "role")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple], tuple]]:
    """(key, held, row) for every passing row of sorted cells, held being the rows of the cell's part."""
    held, at = [], None
    pieces = (batch.slice(s, 256) for batch in batches for s in range(0, batch.num_rows, 256))
    for batch in pieces:
        for key, part, piece, role, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if at != (key, part, piece):
                held, at = [], (key, part, piece)
            if role == 0:
                held.append(row)
            else:
                yield key, held, row


class _Part:
    """The members held in a cell, as arrays."""

    def __init__(self, held: list[list], percent: int):
        self.rows, self.percent = held, percent
        self.nodes, self.sizes, self.at = (np.array([r[i] for r in held], np.int64) for i in (0, 3, 1))
        self.symbols = _symbols([r[4] for r in held])

    def partners(self, key: int, row: list) -> np.ndarray:
        """Positions of the held members to compare with row (node, at, inner, n, signature, ...) in this bucket.

        Their signatures are near, their sizes fit and they are in another component.  Of two outer members the
        greater one passes, and a pair that shares several keys belongs to the first of them.
        """
        node, at, inner, n, signature = row[:5]
        met = (self.at != at) & (np.minimum(self.sizes, n) * 100 >= np.maximum(self.sizes, n) * self.percent)
        if not inner:
            met &= self.nodes < node
        i = np.flatnonzero(met)
        if not len(i):
            return i
        same = (self.symbols[i] == np.frombuffer(signature, np.uint16)[None, :]).reshape(-1, CHUNKS, CHUNK)
        errors = CHUNK - same.sum(axis=2)
        first = (errors <= ERRORS).argmax(axis=1)
        k = np.arange(len(first))
        gone = np.where(errors[k, first] == 0, 0, same[k, first].argmin(axis=1))
        return i[(errors.sum(axis=1) <= FAR) & (first * CHUNK + gone == key >> (16 * (CHUNK - 1)))]


def _parts(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[tuple[int, _Part, list, np.ndarray]]:
    """(key, part, row, positions in part to compare it with), for rows that have any."""
    last, part = None, None
    for key, held, row in _cells(batches):
        if held is not last:
            last, part = held, _Part(held, percent)
        found = part.partners(key, row)
        if len(found):
            yield key, part, row, found


def _involved(members: DataFrame, percent: int) -> DataFrame:
    """The (key, node) that take part in a pair to compare; the pairs themselves stay in their task."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told, rows = None, set(), []
        for key, part, row, found in _parts(batches, percent):
            if part is not last:
                last, told = part, set()
            for node in (row[0], *part.nodes[found].tolist()):
                if node not in told:
                    told.add(node)
                    rows.append((key, node))
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    return _dealt(members, ["n", "signature"]).mapInArrow(run, "key long, node long").distinct()


def _links_across(members: DataFrame, docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """Links (a, b) that join all components whose members meet in a bucket and are similar enough.

    Texts are fetched for members with a near signature in another component only.  A task holds the sets of
    one part, other members pass by; a pair that earlier links of its cell have joined is skipped.
    """
    asked = write_down(_involved(members, percent))
    texts = docs.select(F.col(key).alias("node"), F.col(text).cast("binary").alias("body")).join(
        asked.select("node").distinct().hint("shuffle_hash"), "node")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets, joined, found = None, {}, {}, []

        def root(c):
            while joined.get(c, c) != c:
                c = joined[c]
            return c

        for _, part, row, partners in _parts(batches, percent):
            if part is not last:
                last, sets, joined = part, {}, {}
            mine = None
            for i in partners.tolist():
                c, d = root(row[1]), root(int(part.at[i]))
                if c == d:
                    continue
                if mine is None:
                    mine = shingle_set(row[5])
                if i not in sets:
                    sets[i] = shingle_set(part.rows[i][5])
                shared = common(mine, sets[i])
                if 100 * shared >= percent * (len(mine) + len(sets[i]) - shared):
                    joined[max(c, d)] = min(c, d)
                    found.append((row[0], int(part.nodes[i])))
            if len(found) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

    meeting = members.join(asked, ["key", "node"]).join(texts, "node")
    return _dealt(meeting, ["n", "signature", "body"]).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs.

    Documents whose sets of five-word shingles have a Jaccard similarity of at least percent / 100 are
    linked; component_id is the least doc_id reachable.  Documents with equal sets are one node.  First each
    node is compared with one hub of its buckets, which joins most groups with one comparison per member;
    in buckets with many members outside the largest component, with further hubs, as long as that joins
    groups.  Then all pairs with near signatures that share a bucket across components are compared, each
    member outside a bucket's largest component with all others, so that no link within reach of the index
    is lost while no pair leaves its task.

    Null or empty texts have no shingles and stay alone.  Rows without doc_id are kept, with a null
    component.  Repeated rows share their doc_id's component.  Other columns are ignored; an empty table
    gives an empty result.
    """
    signed = write_down(signatures(docs, key, text))
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    nodes = linked.groupBy("print").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
                                        F.first("signature").alias("signature"))
    nodes = write_down(nodes)
    keys = chunk_keys(nodes)
    shared = keys.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("key")
    every = write_down(keys.join(shared, "key").join(nodes.select("node", "signature"), "node")
                       .withColumns({"at": F.col("node"), "inner": F.lit(False)}))
    links = write_down(_links(_hub_pairs(every, percent), docs, key, text, percent))
    open_ = _open_buckets(every, write_down(components(links)))
    for turn in count(1):
        wide = open_.where("not inner").groupBy("key").count().where(F.col("count") > BLOCK)
        waiting = wide.agg(F.sum("count")).first()[0]
        if waiting is None:
            break
        wide = open_.join(wide.select("key"), "key")
        more = write_down(_links(_hub_pairs(wide, percent, turn), docs, key, text, percent))
        links = links.union(more)
        open_ = _open_buckets(open_, write_down(components(links)))
        if more.count() * GAIN < waiting:
            break
    joined = components(links.union(write_down(_links_across(open_, docs, key, text, percent))))
    classes = nodes.join(joined, "node", "left").select("print", F.coalesce("component", "node").alias("component"))
    return signed.join(classes, "print", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
