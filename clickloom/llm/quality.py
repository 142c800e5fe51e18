"""Quality by a sparse ensemble of rules: tree paths over text statistics, weighted by a lasso, compiled to columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = ("n_bytes", "n_words", "word_bytes", "letters", "upper", "digits", "symbols", "non_ascii", "spaces", "lines",
              "line_words", "repeated_lines", "distinct_words", "top_word", "same_as_last", "marked_words", "ended_lines", "distinct_shingles")
# Labelled rows that are fitted on: the first by a hash of their keys.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 24, 3, 0.3, 32
PENALTY, STEPS = 2e-3, 400
CUTOFF = 0.3

_KIND = np.zeros(256, np.int64)
_KIND[[*range(9, 14), 32]] = 1
_KIND[ord("a"):ord("z") + 1] = 2
_KIND[ord("A"):ord("Z") + 1] = 3
_KIND[ord("0"):ord("9") + 1] = 4
_KIND[128:] = 5


def statistics(body: bytes | None) -> list[float]:
    """The STATISTICS of one whole text; a null text counts as empty."""
    body = body or b""
    n = len(body)
    if not n:
        return [0.0] * len(STATISTICS)
    other, space, lower, upper, digit, wide = np.bincount(_KIND, np.bincount(np.frombuffer(body, np.uint8), minlength=256), 6) / n
    words = body.split()
    lines = body.split(b"\n")
    m = max(1, len(words))
    counts = Counter(words)
    marked = sum(w[-1:] in b"!%$#&*|" for w in words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    ended = sum(line.rstrip()[-1:] in b".!?:" for line in lines if line.strip())
    full = max(1, sum(1 for line in lines if line.strip()))
    pairs = len(set(zip(words, words[1:], words[2:])))
    return [float(n), float(len(words)), sum(map(len, words)) / m, lower + upper, upper, digit, other, wide, space, float(len(lines)),
            len(words) / len(lines), 1 - len(set(lines)) / len(lines), len(counts) / m,
            max(counts.values(), default=0) / m, same / m, marked / m, ended / full, pairs / max(1, len(words) - 2)]


def with_statistics(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, *STATISTICS) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(b.as_py()) for b in batch.column(1)]).reshape(batch.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T)], names=["doc_id", *STATISTICS])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)[key]}, " + ", ".join(f"{s} double" for s in STATISTICS))


Rule = tuple[tuple[int, bool, float], ...]


def _grow(x: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, depth: int, path: Rule,
          rules: set[Rule], step: np.ndarray) -> None:
    """One node of a boosted tree: split where the gain is largest, note the paths, write the leaf's step."""
    if path:
        rules.add(tuple(sorted(path)))
    g, h = slope[rows], curve[rows]
    best = (1e-6, None, None)
    if depth and len(rows) >= 40:
        whole = g.sum() ** 2 / (h.sum() + 1)
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            part = np.searchsorted(edges, x[rows, f], side="left")
            gl = np.cumsum(np.bincount(part, g, len(edges) + 1))[:-1]
            hl = np.cumsum(np.bincount(part, h, len(edges) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - whole
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, float(edges[k]))
    if best[1] is None:
        step[rows] = RATE * g.sum() / (h.sum() + 1)
        return
    _, f, cut = best
    low = x[rows, f] <= cut
    _grow(x, cuts, slope, curve, rows[low], depth - 1, (*path, (f, True, cut)), rules, step)
    _grow(x, cuts, slope, curve, rows[~low], depth - 1, (*path, (f, False, cut)), rules, step)


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """All paths of boosted trees: conjunctions of (statistic, at most, cut)."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    rules: set[Rule] = set()
    score = np.zeros(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        step = np.zeros(len(y))
        _grow(x, cuts, y - p, p * (1 - p), np.arange(len(y)), DEPTH, (), rules, step)
        score += step
    return sorted(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, low, cut in rule:
        out &= (x[:, f] <= cut) if low else (x[:, f] > cut)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, rules with weights): logistic regression with a lasso, by accelerated proximal gradient."""
    rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    start = float(np.log(rate / (1 - rate)))
    if len(y) < 40 or len(np.unique(y)) < 2:
        return start, []
    rules = tree_rules(x, y)
    z = np.stack([holds(r, x) for r in rules], axis=1).astype(np.float64)
    mean = z.mean(axis=0)
    z -= mean
    size = 4 / max(float(np.linalg.eigvalsh(z.T @ z / len(y))[-1]) + 1, 1e-9)
    w, look, b, t = np.zeros(z.shape[1]), np.zeros(z.shape[1]), start, 1.0
    for _ in range(STEPS):
        wrong = y - 1 / (1 + np.exp(-(b + z @ look)))
        new = look + size * (z.T @ wrong) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - size * PENALTY, 0)
        b += size * wrong.mean()
        ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / ahead * (new - w), new, ahead
    return float(b - mean @ w), [(r, float(v)) for r, v in zip(rules, w, strict=True) if abs(v) > 1e-4]


def score(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The ensemble as one column over the statistics."""
    total = F.lit(intercept)
    for rule, weight in rules:
        whole = F.lit(True)
        for f, low, cut in rule:
            whole &= (F.col(STATISTICS[f]) <= cut) if low else (F.col(STATISTICS[f]) > cut)
        total += F.when(whole, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most `sample` rows of `learn` that have a label, the first by a hash of key and text.

    Rows of equal hash are ordered by label and else equal, so the sample does not depend on partitioning.  A row with
    several labels is learnt from once for each.
    """
    marks = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_y"))
    rows = docs.where(learn).select(F.col(key).alias("k"), F.col(text).alias("body"),
                                    F.xxhash64(F.lit("quality"), F.col(key), F.col(text)).alias("_h"))
    # The cut that keeps `sample` rows is found on keys and hashes alone; only texts under it are joined and sorted.
    marked = rows.select("k", "_h").join(marks, F.col("k") == F.col("_id")).select("_h")
    top = marked.orderBy("_h").limit(sample).agg(F.max("_h")).first()[0] if sample else None
    if top is None:
        return np.empty((0, len(STATISTICS))), np.empty(0)
    near = rows.where(F.col("_h") <= top).join(marks, F.col("k") == F.col("_id"))
    chosen = near.select(F.struct("_y", "_h", "k").alias("id"), "body")
    got = with_statistics(chosen, "id", "body").select("doc_id._y", "doc_id._h", *STATISTICS).orderBy("_h", "_y").limit(sample).toPandas()
    return got[list(STATISTICS)].to_numpy(np.float64), got["_y"].to_numpy(np.float64)


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
            sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    Score is the probability of label 1 from the statistics of the whole text; predicted is 1 from a score
    of 0.3.  Rules and weights are learnt from at most `sample` labelled rows that are not held out.
    Null texts score as empty ones; rows without doc_id are scored but not learnt from; repeated rows score alike.
    Without labels of both kinds the score is the rate of label 1, or 0.5.  An empty table gives no rows.
    """
    x, y = labelled(docs, labels, key, text, label, ~held_out(key) & F.col(key).isNotNull(), sample)
    column = score(*fit(x, y))
    return (with_statistics(docs, key, text).select("doc_id", held_out("doc_id").alias("held_out"), column.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= CUTOFF, 1).otherwise(0)))
