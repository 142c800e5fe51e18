"""Phrases of two and three words that stand together more often than their parts would, by language.

The counts of words, pairs and triples are one stream, laid out twice as external language-model estimation does.
In prefix order (first word, second, third) a phrase follows its own beginnings, so a reader that keeps the last
word and the last pair has the counts of the left parts at hand.  In suffix order (last word, the one before, the
one before that) it follows its own endings, which are the right parts.  In both, the triples that extend a pair
come right after the pair.  Every count is met by reading sorted streams in lockstep; nothing is looked up by hash.

Few phrases are frequent, and a frequent phrase has frequent parts.  So words are counted first, then the pairs of
frequent words, then the triples of frequent pairs.  The first two counts are of 64-bit hashes and end in a filter of at
most 2**FILTER_BITS bits.  It keeps every frequent part; what it lets through by chance is counted and dropped at the end,
so a full filter costs time and never a phrase.

A count stream is range-sorted over any number of tasks.  What a range needs from the ranges before it is the last
row of each order, three rows that are copied to its head; so one word with a third of all phrases is many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.words import mix
from clickloom.session import write_down

LEAST, SHARE, TOP = 10, 50, 2000
# Words that a task counts before it passes the counts on.
BLOCK = 2_000_000
# Rows per Arrow batch.
ROWS = 200_000
# Bits of a filter of frequent parts: 16 for each, at most 2**28 (32 MB); and the bits of one of its slices.
FILTER_BITS, SLICE_BITS = 28, 20
UNDETERMINED = "und"

KEYS = ["lang", "w1", "w2", "w3"]
_PREFIX, _SUFFIX = ["w1", "w2", "w3"], ["e1", "e2", "e3"]

# The signs at which pieces end, and the blanks between words (line ends are signs).
_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_TABLE = bytes(10 if b in _ENDS else 32 if b in _BLANKS else b for b in range(256))


def spaced(text: bytes) -> bytes:
    """A text in lower case with a space between words and a line feed as a word at every end of a piece, its own too."""
    return text.lower().translate(_TABLE).replace(b"\n", b" \n ") + b" \n"


def numbered(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """(ids, words) of texts with spaces between words: the place in `words` of each word, -1 for a line feed."""
    coded = pc.split_pattern(pa.array(texts, pa.large_binary()), b" ").flatten().dictionary_encode()
    words, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    # Between two blanks is an empty word, which is none.
    empty, end = (pc.index(words, pa.scalar(w, words.type)).as_py() for w in (b"", b"\n"))
    ids = ids[ids != empty] if empty >= 0 else ids
    ids[ids == end] = -1
    return ids, words


def _pairs(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, counts, place) of the pairs of a sequence in which 0 ends a piece; place has every position's pair or -1."""
    joined = (ids[:-1] > 0) & (ids[1:] > 0)
    codes, at, counts = np.unique(ids[:-1][joined] * size + ids[1:][joined], return_inverse=True, return_counts=True)
    place = np.full(len(joined), -1, np.int64)
    place[joined] = at
    return codes, counts, place


def _passes(hashes: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
    """Which hashes a filter lets through; all without a filter."""
    if bits is None:
        return np.ones(len(hashes), bool)
    found = np.ones(len(hashes), bool)
    for at in _bits(hashes, len(bits) * 8):
        found &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    return found


def _bits(hashes: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The two bits of each hash in a filter of `size` bits, a power of two."""
    return tuple((part & np.uint64(size - 1)).astype(np.int64) for part in (hashes, hashes >> np.uint64(32)))


def _filter(frequent: DataFrame) -> np.ndarray:
    """A bit array over frequent hashes (h); what reaches the driver is bounded by FILTER_BITS."""
    frequent = write_down(frequent)
    size = 1 << min(FILTER_BITS, max(SLICE_BITS, (16 * frequent.count()).bit_length()))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_bits(batch.column(0).to_numpy().view(np.uint64), size)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> SLICE_BITS), pa.array(at & (1 << SLICE_BITS) - 1)], names=["slice", "at"])

    def pack(table: pa.Table) -> pa.Table:
        held = np.zeros(1 << SLICE_BITS, bool)
        held[table.column("at").to_numpy()] = True
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    bits = np.zeros(size // 8, np.uint8)
    width = (1 << SLICE_BITS) // 8
    for part, held in frequent.mapInArrow(positions, "slice long, at long").groupBy("slice").applyInArrow(pack, "slice long, bits binary").collect():
        bits[part * width:(part + 1) * width] = np.frombuffer(held, np.uint8)
    return bits


def _counter(stage: int, words_kept=None, pairs_kept=None):
    """A function for mapInArrow that counts blocks of texts (lang, text).

    Stages 1 and 2 give (h, f) for the hashes of words and of pairs of kept words.  Stage 3 gives (lang, phrase, f) for kept
    words, kept pairs and triples of kept pairs, words joined by blanks; for the empty phrase, f counts all words of the language.
    """
    hashed = pa.schema([("h", pa.int64()), ("f", pa.int64())])
    named = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("f", pa.int64())])

    def rows(lang: str, places: list[np.ndarray], counts: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(counts), ROWS):
            part = slice(start, start + ROWS)
            phrases = pc.binary_join_element_wise(*(words.take(pa.array(p[part])) for p in places), b" ")
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(counts[part], pa.int64())], schema=named)

    def count(lang: str, texts: list[bytes], keep1, keep2) -> Iterator[pa.RecordBatch]:
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        ids, words = numbered(texts)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))
        there = np.bincount(ids[ids >= 0], minlength=len(words)) > 0
        kept = np.flatnonzero(there & _passes(hashes, keep1))
        total = int((ids >= 0).sum())
        if stage == 3:
            # Words are renumbered in byte order, so counts leave in prefix order.
            kept = kept[pc.sort_indices(words.take(pa.array(kept))).to_numpy().astype(np.int64)]
        # 0 ends a piece, and so do words that are not kept; a line feed's -1 is the last place.
        rank = np.zeros(len(words) + 1, np.int64)
        rank[kept] = np.arange(1, len(kept) + 1)
        hashes = np.concatenate([np.zeros(1, np.uint64), hashes[kept]])
        ids, size = rank[ids], len(kept) + 1
        ones = np.bincount(ids, minlength=size)
        if stage == 1:
            yield pa.RecordBatch.from_arrays([pa.array(hashes[1:].view(np.int64)), pa.array(ones[1:])], schema=hashed)
            return
        codes, counts, place = _pairs(ids, size)
        pair_hashes = mix(mix(hashes[codes // size]) + hashes[codes % size])
        if stage == 2:
            yield pa.RecordBatch.from_arrays([pa.array(pair_hashes.view(np.int64)), pa.array(counts)], schema=hashed)
            return
        sorted_words = pa.concat_arrays([pa.nulls(1, pa.binary()), words.take(pa.array(kept)).cast(pa.binary())])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([b""]), pa.array([total], pa.int64())], schema=named)
        yield from rows(lang, [np.arange(1, size)], ones[1:], sorted_words)
        good = _passes(pair_hashes, keep2)
        yield from rows(lang, [codes[good] // size, codes[good] % size], counts[good], sorted_words)
        held = place >= 0
        held[held] = good[place[held]]
        both = held[:-1] & held[1:]
        triples, counts = np.unique(place[:-1][both] * size + ids[2:][both], return_counts=True)
        first = codes[triples // size]
        yield from rows(lang, [first // size, first % size, triples % size], counts, sorted_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep1, keep2 = (None if x is None else x.value for x in (words_kept, pairs_kept))
        texts, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = spaced(text.as_py())
                texts.setdefault(lang, []).append(found)
                size += found.count(b" ") + 1
                if size >= BLOCK:
                    for key, held in texts.items():
                        yield from count(key, held, keep1, keep2)
                    texts, size = {}, 0
        for key, held in texts.items():
            yield from count(key, held, keep1, keep2)

    return run


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, f) of every word, pair and triple that occurs `least` times, and of all words of a language (no w1).

    Tasks count blocks of texts first.  A part of a phrase occurs as often as the phrase, so nothing needed later is rare.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
                                                       F.col(text).cast("binary").alias("text"))

    def frequent(counts: DataFrame, keys: list[str]) -> DataFrame:
        # Blocks are counted already: counting again before the shuffle would hold every phrase of a task to no avail.
        return counts.repartition(*keys).groupBy(*keys).agg(F.sum("f").alias("f")).where(F.col("f") >= least)

    kept: list = []
    for stage in (1, 2):
        hashes = frequent(texts.mapInArrow(_counter(stage, *kept), "h long, f long"), ["h"]).select("h")
        kept.append(context.broadcast(_filter(hashes)))
    found = frequent(texts.mapInArrow(_counter(3, *kept), "lang string, phrase binary, f long"), ["lang", "phrase"])
    words = F.when(F.col("phrase") != b"", F.split(F.col("phrase").cast("string"), " "))
    return found.withColumn("w", words).select("lang", *(F.get("w", i).cast("binary").alias(w) for i, w in enumerate(_PREFIX)), "f")


_HELD = ["f", "longer", "n", "p1", "p2", "s1", "s2"]


def _lockstep(stream: DataFrame, order: list[str], into: tuple[int, int, int]) -> DataFrame:
    """Reads a count stream in `order` and writes what it follows: the language's n, the word's and the pair's count.

    into: the places in _HELD of those three.  `longer` of a pair becomes the largest count of the triples after it.  Rows
    with equal keys are one.  Rows copied to the head of a range come out with `copied`, if they are pairs with triples there.
    """
    spark = stream.sparkSession
    keys = ["lang", *order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = write_down(stream.repartitionByRange(n, *keys).withColumn("range", F.spark_partition_id()))
    row = F.struct(*keys, *(c for c in stream.columns if c not in keys))
    words = sum((F.col(c).isNotNull().cast("int") for c in order), F.lit(0))
    last = ranged.groupBy("range").agg(*(F.max(F.when(words == k, row)).alias(f"last{k}") for k in range(3)))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("range", *(F.last(f"last{k}", ignorenulls=True).over(before).alias(f"last{k}") for k in range(3)))
    copies = carried.select("range", F.explode(F.array(*(f"last{k}" for k in range(3)))).alias("row")).where("row is not null")
    copies = copies.select("row.*", "range").drop("copied").withColumn("copied", F.lit(True))
    columns = ["range", *keys, *(c for c in KEYS if c not in keys), "copied", *_HELD]
    others = [c for c in columns if c not in (*keys, "range", "copied", *_HELD)]
    rows = (ranged.select(*columns).unionByName(copies.select(*columns))
            .repartition("range").sortWithinPartitions("range", *keys).select("range", *keys, "copied", *_HELD, *others))
    kinds = {f.name: f.dataType.simpleString().replace("bigint", "long") for f in rows.schema.fields}
    names = rows.columns[1:]
    schema = pa.schema([(c, {"string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "long": pa.int64()}[kinds[c]]) for c in names])
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        counts = [0, 0, 0]

        def close() -> None:
            # A copied row leaves only as a pair that has longer phrases in this range.
            if held is not None and (not held[4] or held[3] is None and held[2] is not None and held[6]):
                out.append(tuple(held))

        for batch in batches:
            for _, *row in zip(*(batch.column(i).to_pylist() for i in range(width + 1)), strict=True):
                x, y, z = row[1:4]
                if held is not None and held[:4] == row[:4]:
                    held[4], held[6] = held[4] and row[4], max(held[6], row[6])
                    continue
                size = 0 if x is None else 1 if y is None else 2 if z is None else 3
                if size < 3:
                    close()
                    counts[size] = row[5]
                    held = row
                else:
                    held[6] = max(held[6], row[5])
                if size > 0:
                    row[5 + into[0]] = counts[0]
                if size > 1:
                    row[5 + into[1]] = counts[1]
                if size > 2:
                    row[5 + into[2]] = counts[2]
                    out.append(tuple(row))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names))


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact in decimals of 38 digits for counts below 10**16."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, left * right)


def scored(counts: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the pairs and triples of a count stream, without those that mostly stand in longer ones."""
    none = F.lit(0).cast("long")
    stream = counts.withColumn("copied", F.lit(False)).withColumns({c: none for c in _HELD if c != "f"})
    stream = _lockstep(stream, _PREFIX, (2, 3, 4))
    stream = _lockstep(stream.withColumns({
        "e1": F.coalesce("w3", "w2", "w1"), "e2": F.when(F.col("w3").isNotNull(), F.col("w2")).when(F.col("w2").isNotNull(), F.col("w1")),
        "e3": F.when(F.col("w3").isNotNull(), F.col("w1"))}), _SUFFIX, (2, 5, 6)).where(F.col("w2").isNotNull())
    stream = write_down(stream)
    inside = 100 * F.col("longer") >= share * F.col("f")
    # Copies are as few as ranges: pairs whose triples go on beyond their own range.
    split = stream.where(F.col("copied") & inside).select(*KEYS[:3])
    left = stream.where(~F.col("copied") & ~inside)
    match = [left[c] == split[c] for c in KEYS[:3]]
    left = left.join(split, [*match, left["w3"].isNull()], "left_anti")
    triple = F.col("w3").isNotNull()
    early = F.struct(cut_score(F.col("f"), F.col("p1"), F.when(triple, F.col("s2")).otherwise(F.col("s1"))).alias("score"),
                     F.lit(1).alias("k"), F.col("p1").alias("l"), F.when(triple, F.col("s2")).otherwise(F.col("s1")).alias("r"))
    late = F.when(triple, F.struct(cut_score(F.col("f"), F.col("p2"), F.col("s1")).alias("score"), F.lit(2).alias("k"),
                                   F.col("p2").alias("l"), F.col("s1").alias("r")))
    return left.select("lang", F.concat_ws(" ", *(F.col(w).cast("string") for w in _PREFIX)).alias("phrase"), F.col("f").alias("a"), "n",
                       F.least(early, late).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases that bind best in each language.

    Texts are lower-cased (A-Z) and split at signs and line ends into pieces, those at blanks into words.  A phrase of two
    or three words counts with a >= `least` occurrences; of its cuts into two parts, with counts l and r, the one with the
    lowest score counts, the first of equal ones.  Phrases of which `share` percent stand in one longer phrase go.  n is
    the number of words of the language.  Rows without lang are `und`; null and empty texts have no words; repeated rows count
    as often as they stand; doc_id is not read; ties in score and a go by the bytes of the phrase.  An empty table gives no rows.
    """
    found = scored(phrase_counts(docs, text, lang, least), share)
    # The best of every salt first: no task sorts all phrases of a language.
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    inner = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))
    near = salted.withColumn("rank", inner).where(F.col("rank") <= top).drop("salt", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    return near.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
