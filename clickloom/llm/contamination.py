"""Benchmark decontamination: a BM25 index of test items, queried with every passage of the corpus by block-max WAND."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.words import SHINGLE, common, shingle_sequence, word_hashes
from clickloom.session import write_down

K1, B = 1.2, 0.75
# Items are indexed in units of at most UNIT words; passages are twice as long and overlap by half,
# so each unit that occurs lies whole in a passage.
UNIT = 64
# The part of a unit's own BM25 score that a passage must reach.
THRESHOLD = 0.6
PERCENT = 75
ANSWER = 8
BLOCK = 4
# Words of test items per index; more items make more indexes, each broadcast by itself.
INDEX_WORDS = 500_000


@dataclass
class Index:
    """Postings of terms, by term and unit, with impacts as parts of the unit's own score.

    A term's postings fall into blocks of BLOCK units, each with the greatest impact in it.
    """

    terms: np.ndarray
    units: np.ndarray
    impacts: np.ndarray
    tops: np.ndarray
    block_starts: np.ndarray
    blocks: np.ndarray
    block_tops: np.ndarray
    block_postings: np.ndarray
    texts: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]

    @classmethod
    def build(cls, term: np.ndarray, unit: np.ndarray, impact: np.ndarray, texts: dict) -> Index:
        order = np.lexsort((unit, term))
        term, unit, impact = term[order], unit[order], impact[order]
        terms, starts = np.unique(term, return_index=True)
        block = unit // BLOCK
        first = np.nonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])))[0]
        return cls(terms, unit, impact, np.maximum.reduceat(impact, starts), np.append(np.searchsorted(first, starts), len(first)),
                   block[first], np.maximum.reduceat(impact, first), np.append(first, len(term)), texts)

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """For each word hash its number in the index, or -1."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)


class _Cursor:
    """A place in the postings of one term in one block."""

    __slots__ = ("units", "impacts", "top", "at")

    def __init__(self, index: Index, entry: int):
        span = slice(index.block_postings[entry], index.block_postings[entry + 1])
        self.units, self.impacts = index.units[span].tolist(), index.impacts[span].tolist()
        self.top, self.at = float(index.block_tops[entry]), 0

    def unit(self) -> int:
        return self.units[self.at] if self.at < len(self.units) else -1

    def seek(self, unit: int) -> None:
        while self.at < len(self.units) and self.units[self.at] < unit:
            self.at += 1


def wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All units whose score over the distinct terms is at least the threshold.

    Blocks whose maxima do not add up to the threshold are skipped whole.  In the others cursors are
    kept in order of their units; the pivot is the first where the maxima add up, and cursors before it jump there.
    """
    starts = index.block_starts[terms]
    sizes = index.block_starts[terms + 1] - starts
    entries = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    bounds = np.bincount(index.blocks[entries], index.block_tops[entries])
    found = []
    for block in np.nonzero(bounds >= threshold - 1e-9)[0].tolist():
        cursors = [_Cursor(index, e) for e in entries[index.blocks[entries] == block].tolist()]
        while True:
            cursors = sorted((c for c in cursors if c.unit() >= 0), key=_Cursor.unit)
            bound, pivot = 0.0, None
            for c in cursors:
                bound += c.top
                if bound >= threshold - 1e-9:
                    pivot = c.unit()
                    break
            if pivot is None:
                break
            score = 0.0
            for c in cursors:
                if c.unit() > pivot:
                    break
                c.seek(pivot)
                if c.unit() == pivot:
                    score += c.impacts[c.at]
                    c.at += 1
            if score >= threshold:
                found.append((pivot, score))
    return found


def _units(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, unit, place, term): the words of test items, cut into units."""
    schema = pa.schema([("item_id", pa.int64()), ("unit", pa.int64()), ("place", pa.int64()), ("term", pa.int64()), ("question", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, body in zip(batch.column(0), batch.column(1), strict=True):
                terms = word_hashes(body.as_py())
                if not len(terms) or not item.is_valid:
                    continue
                n = len(terms)
                parts = -(-n // UNIT)
                unit = np.arange(n) * parts // n
                answer = _answer(body.as_py(), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, item.as_py()), pa.int64()), pa.array(unit), pa.array(np.arange(n)),
                     pa.array(terms.view(np.int64)), pa.array(np.arange(n) < answer)], schema=schema)

    return items.select(F.col(key).cast("long"), F.col(text).cast("binary")).mapInArrow(
        run, "item_id long, unit long, place long, term long, question boolean")


def _answer(body: bytes, n: int) -> int:
    """The word an item's answer begins with: its last sentences of ANSWER words together, or else its second half."""
    ends = [i + 1 for i, w in enumerate(body.split()) if w[-1:] in b".?!:" and i + 1 <= n - ANSWER]
    return ends[-1] if ends else (n + 1) // 2


def indexes(items: DataFrame, key: str, text: str) -> Iterator[Index]:
    """Indexes of at most some INDEX_WORDS words; the statistics cover all items."""
    placed = write_down(_units(items, key, text))
    names = write_down(placed.groupBy("item_id", "unit").agg(F.count(F.lit(1)).alias("words")))
    n, average, total = names.agg(F.count(F.lit(1)), F.avg("words"), F.sum("words")).first()
    if not n:
        return
    counted = placed.groupBy("item_id", "unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    frequency = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("words") / F.lit(average))
    scored = counted.join(frequency, "term").join(names, ["item_id", "unit"]).withColumn(
        "impact", idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm))
    own = scored.groupBy("item_id", "unit").agg(F.sum("impact").alias("own"))
    parts = -(-total // INDEX_WORDS)
    part = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    scored = write_down(scored.join(own, ["item_id", "unit"]).select("item_id", "unit", "term", (F.col("impact") / F.col("own")).alias("impact"), part.alias("part")))
    placed = placed.withColumn("part", part)
    for k in range(parts):
        rows = placed.where(F.col("part") == k).orderBy("item_id", "unit", "place").toPandas()
        # Units that share their most frequent term, often a language, stand together, so that blocks differ.
        often = rows["term"].map(rows["term"].value_counts())
        leads = rows.assign(often=often).sort_values(["often", "term"]).drop_duplicates(["item_id", "unit"], keep="last")
        leads = leads.sort_values(["often", "term", "item_id", "unit"])
        number = {(row.item_id, row.unit): i for i, row in enumerate(leads.itertuples(index=False))}
        texts = {}
        for (item, unit), group in rows.groupby(["item_id", "unit"], sort=True):
            terms = group["term"].to_numpy().view(np.uint64)
            question = group["question"].to_numpy()
            width = min(SHINGLE, len(terms))
            texts[number[item, unit]] = (item, np.unique(terms[question]), np.unique(terms[~question]),
                                         np.unique(shingle_sequence(terms, width)), width)
        post = scored.where(F.col("part") == k).toPandas()
        if not len(post):
            continue
        term = post["term"].to_numpy().view(np.uint64)
        unit = np.array([number[x] for x in zip(post["item_id"], post["unit"], strict=True)], np.int64)
        yield Index.build(term, unit, post["impact"].to_numpy(), texts)


def _promising(index: Index, number: np.ndarray, threshold: float) -> list[int]:
    """Where the passages begin whose distinct words' maxima add up to the threshold; no others can reach it.

    A word counts in a passage if it does not occur before it there.  Each word is in two passages at most.
    """
    at = np.nonzero(number >= 0)[0]
    if not len(at):
        return []
    order = np.argsort(number[at], kind="stable")
    same = np.append(False, number[at][order][1:] == number[at][order][:-1])
    before = np.full(len(at), -1)
    before[order[same]] = at[order[np.nonzero(same)[0] - 1]]
    top, last = index.tops[number[at]], max(0, -(-len(number) // UNIT) - 2)
    bound = np.zeros(last + 1)
    for k in (at // UNIT, at // UNIT - 1):
        fits = (k >= 0) & (k <= last) & (before < k * UNIT)
        bound += np.bincount(k[fits], top[fits], last + 1)
    return (np.nonzero(bound >= threshold - 1e-9)[0] * UNIT).tolist()


def leaks(body: bytes | None, index: Index, threshold: float = THRESHOLD, percent: int = PERCENT) -> list[tuple]:
    """(item_id, score, question overlap, answer overlap, shingle overlap, start word), the best passage per item."""
    words = word_hashes(body)
    if not len(words):
        return []
    number = index.lists(words)
    best: dict[int, tuple] = {}
    for start in _promising(index, number, threshold):
        passage, known = words[start : start + 2 * UNIT], number[start : start + 2 * UNIT]
        terms = np.unique(known[known >= 0])
        for unit, score in wand(index, terms, threshold):
            item, question, answer, shingles, width = index.texts[unit]
            have = np.unique(passage)
            asked = common(question, have) / len(question) if len(question) else 1.0
            told = common(answer, have) / len(answer) if len(answer) else 1.0
            same = common(shingles, np.unique(shingle_sequence(passage, width))) / len(shingles)
            if min(asked, told, same) * 100 >= percent and (item not in best or best[item][1] < score):
                best[item] = (item, score, asked, told, same, start)
    return list(best.values())


_HITS = "item_id long, score double, question double, answer double, shingles double, start_word long"


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                 item_text: str = "text", threshold: float = THRESHOLD, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, score, question, answer, shingles, start_word): the test items each document holds.

    Score is the part of the item's BM25 score that the best passage reaches.  Verified are the part of the
    distinct words of question and answer (the last sentences, of eight words at least) found in the passage, and of the item's five-word shingles;
    all must reach percent / 100.  A long item counts if one of its units of at most 64 words is found.

    Null or empty texts hold nothing and null or empty items are in no text; items without item_id are left
    out; rows without doc_id are reported with null.  Repeated rows give equal rows.  Empty tables give no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), *((c, pa.float64()) for c in ("score", "question", "answer", "shingles")),
                        ("start_word", pa.int64())])
    out = docs.sparkSession.createDataFrame([], f"doc_id long, {_HITS}")
    for index in indexes(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(vars(index))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(**shared.value)
            for batch in batches:
                rows = [(doc.as_py(), *hit) for doc, body in zip(batch.column(0), batch.column(1), strict=True)
                        for hit in leaks(body.as_py(), index, threshold, percent)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                                     schema=schema)

        out = out.union(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
                        .mapInArrow(run, f"doc_id long, {_HITS}"))
    return out


def _clean(shared: Broadcast, threshold: float, percent: int) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(**shared.value)
        for bodies in batches:
            yield pd.Series([not leaks(b, index, threshold, percent) for b in bodies], dtype=bool)

    return run


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                  threshold: float = THRESHOLD, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with their columns, whose texts hold no test item; checked row by row, without a join."""
    for index in indexes(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(vars(index))

        clean = F.pandas_udf(_clean(shared, threshold, percent), "boolean")
        docs = docs.where(clean(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return docs
