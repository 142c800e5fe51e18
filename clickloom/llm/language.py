"""Language of a text by a convolutional network over its bytes, trained in numpy.

A window of WINDOW bytes is embedded byte by byte, read by filters of several widths, reduced to each
filter's greatest response, and classified by a softmax.  A text's language is that of the sum over all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 10, 6
# Labelled texts per language that are fitted on, the first by a hash of key and text, and windows of each.
SAMPLE, WINDOWS = 400, 4
# Texts that are fitted on in all, shared evenly by the languages, and languages at most, the most frequent first.
TEXTS, MOST = 40_000, 4_096
EPOCHS, BATCH, RATE = 16, 64, 0.01
SEED = 20240903
UNDETERMINED = "und"


def windows(body: bytes) -> np.ndarray:
    """All windows of a text, side by side, the last filled with zeros."""
    data = np.frombuffer(body, np.uint8)
    out = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[: len(data)] = data
    return out


class Network:
    def __init__(self, classes: list[str], weights: dict[str, np.ndarray]):
        self.classes, self.weights = classes, weights

    @classmethod
    def new(cls, classes: list[str], seed: int = SEED) -> Network:
        draw = np.random.default_rng(seed).standard_normal
        w = {"bytes": draw((256, EMBEDDING)) * 0.5}
        for k in WIDTHS:
            w[f"filter{k}"] = draw((k * EMBEDDING, FILTERS)) / np.sqrt(k * EMBEDDING)
            w[f"bias{k}"] = np.zeros(FILTERS)
        w["out"] = draw((len(WIDTHS) * FILTERS, len(classes))) * 0.1
        w["out_bias"] = np.zeros(len(classes))
        return cls(classes, {k: v.astype(np.float32) for k, v in w.items()})

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """The greatest response of each filter per window, and what training needs."""
        embedded = self.weights["bytes"][x]
        out, kept = [], []
        for k in WIDTHS:
            n = WINDOW - k + 1
            runs = np.lib.stride_tricks.sliding_window_view(embedded.reshape(len(x), -1), k * EMBEDDING, axis=1)[:, ::EMBEDDING]
            response = np.ascontiguousarray(runs).reshape(-1, k * EMBEDDING) @ self.weights[f"filter{k}"]
            response = response.reshape(len(x), n, FILTERS)
            out.append(response.max(axis=1) + self.weights[f"bias{k}"])
            kept.append(response)
        return np.concatenate(out, axis=1), [embedded, kept]

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(x)[0], 0)
        z = hidden @ self.weights["out"] + self.weights["out_bias"]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log likelihood; only each filter's greatest response passes them on."""
        pooled, (embedded, responses) = self.pooled(x)
        hidden = np.maximum(pooled, 0)
        z = hidden @ self.weights["out"] + self.weights["out_bias"]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        wrong = -p
        wrong[np.arange(len(y)), y] += 1
        wrong /= len(y)
        g = {"out": hidden.T @ wrong, "out_bias": wrong.sum(axis=0)}
        back = (wrong @ self.weights["out"].T) * (pooled > 0)
        g["bytes"] = np.zeros_like(self.weights["bytes"])
        rows = np.arange(len(x))[:, None]
        for i, (k, response) in enumerate(zip(WIDTHS, responses, strict=True)):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            at = response.argmax(axis=1)
            g[f"bias{k}"] = part.sum(axis=0)
            slope = np.zeros((k, EMBEDDING, FILTERS), np.float32)
            filters = self.weights[f"filter{k}"].reshape(k, EMBEDDING, FILTERS)
            for j in range(k):
                slope[j] = np.einsum("nfe,nf->ef", embedded[rows, at + j], part)
                np.add.at(g["bytes"], x[rows, at + j].reshape(-1), (part[:, :, None] * filters[j].T[None]).reshape(-1, EMBEDDING))
            g[f"filter{k}"] = slope.reshape(k * EMBEDDING, FILTERS)
        return g

    def predict(self, bodies: list[bytes], block: int = 256) -> tuple[list[str], list[float]]:
        """The language of each text and its share among the languages' mean likelihoods."""
        parts = [windows(b) for b in bodies]
        if not parts:
            return [], []
        flat = np.concatenate(parts)
        logs = np.concatenate([self.log_probabilities(flat[s : s + block]) for s in range(0, len(flat), block)])
        logs = logs * np.minimum(1, (flat > 0).sum(axis=1) / 32)[:, None]
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        mean = np.add.reduceat(logs, starts, axis=0) / np.array([len(p) for p in parts])[:, None]
        share = np.exp(mean - mean.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        return [self.classes[b] for b in best], share[np.arange(len(best)), best].tolist()


def fit(texts: list[bytes], languages: list[str], seed: int = SEED) -> Network | None:
    """A network trained by Adam on a few windows of each text; None without texts."""
    classes = sorted(set(languages))
    if not classes:
        return None
    net, rng = Network.new(classes, seed), np.random.default_rng(seed)
    parts, marks = [], []
    for body, language in zip(texts, languages, strict=True):
        found = windows(body)
        chosen = found[rng.permutation(len(found))[:WINDOWS]]
        parts.append(chosen)
        marks.extend([classes.index(language)] * len(chosen))
    x, y = np.concatenate(parts), np.array(marks)
    first, second, step = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2)), None, 0
    first, second = first
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for s in range(0, len(x), BATCH):
            step += 1
            for k, g in net.gradients(x[order[s : s + BATCH]], y[order[s : s + BATCH]]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.weights[k] += (RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _drawn_windows(body: Column, seed: Column) -> Column:
    """WINDOWS windows of a text's bytes, one drawn from each equal part of the whole text; fewer where the text has fewer."""
    count = F.greatest(F.ceil(F.octet_length(body) / WINDOW), F.lit(1)).cast("long")
    parts = [F.floor(count * (F.pmod(F.xxhash64(seed, F.lit(j)), F.lit(10**6)) + j * 10**6) / (WINDOWS * 10**6)).cast("int")
             for j in range(WINDOWS)]
    return F.transform(F.array_distinct(F.array(*parts)), lambda i: F.substring(body, i * WINDOW + 1, F.lit(WINDOW)))


def training_rows(docs: DataFrame, key: str, text: str, lang: str, learn: Column, sample: int, texts: int = TEXTS,
                  most: int = MOST) -> tuple[list[bytes], list[str]]:
    """Windows of at most `sample` texts per language and `texts` in all, the first by a hash of key and text.

    A language's rate decides a bound of the hash that leaves enough rows, so few are ranked; equal rows count once.
    Of more than `most` languages the most frequent are learnt, of equal ones the first by name.  What is sent to the
    driver is at most texts * WINDOWS * WINDOW bytes and the counts of `most` languages.
    """
    fit_for = docs.where(learn & F.col(key).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = fit_for.groupBy(F.col(lang).alias("l")).count().orderBy(F.desc("count"), "l").limit(most).collect()
    if not counts:
        return [], []
    each = max(1, min(sample, texts // len(counts)))
    bounds = docs.sparkSession.createDataFrame(
        [(r[0], min(10**6, int(10**6 * (each * 1.2 + 20) / r[1]) + 1)) for r in counts], "l string, bound long")
    rows = fit_for.select(F.col(lang).alias("l"), F.xxhash64(F.lit("language"), F.col(key), F.col(text)).alias("h"),
                          F.col(text).cast("binary").alias("body"))
    # At most `most` rows of bounds are broadcast.
    near = rows.join(F.broadcast(bounds), "l").where(F.pmod("h", F.lit(10**6)) < F.col("bound"))
    drawn = near.select("l", "h", _drawn_windows(F.col("body"), F.col("h")).alias("b")).groupBy("l", "h").agg(F.min("b").alias("b"))
    place = F.row_number().over(Window.partitionBy("l").orderBy(F.pmod("h", F.lit(10**6)), "h"))
    got = drawn.withColumn("place", place).where(F.col("place") <= each).orderBy("l", "place").collect()
    return [b"".join(r.b) for r in got], [r.l for r in got]


def learn_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
                    learn: Column | None = None, texts: int = TEXTS, most: int = MOST) -> Network | None:
    return fit(*training_rows(docs, key, text, lang, ~held_out(key) if learn is None else learn, sample, texts, most))


def _guessed(docs: DataFrame, network: Network | None, text: str) -> DataFrame:
    """(row, guess): every row of docs whole, and its language l, score s and whether its text has letters."""
    classes, weights = (network.classes, network.weights) if network else ([], {})

    def run(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = Network(classes, weights)
        for batch in bodies:
            names, shares = [UNDETERMINED] * len(batch), [0.0] * len(batch)
            texts = batch.to_pylist()
            letters = [bool(t) and any(map(str.isalpha, t)) for t in texts]
            able = [i for i, yes in enumerate(letters) if yes and net.classes]
            for s in range(0, len(able), 64):
                found = net.predict([texts[i].encode("utf-8", "replace") for i in able[s : s + 64]])
                for i, name, share in zip(able[s : s + 64], *found, strict=True):
                    names[i], shares[i] = name, share
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(letters, pa.bool_())],
                                             ["l", "s", "letters"])

    guess = F.arrow_udf(run, "l string, s double, letters boolean")
    return docs.select(F.struct("*").alias("row"), guess(F.col(text)).alias("guess"))


def predict_languages(docs: DataFrame, network: Network | None, text: str = "text", lang_pred: str = "lang_pred",
                      score: str = "score") -> DataFrame:
    """docs with the predicted language and its score; every byte of every text is read.

    Texts that are null or hold no letter are `und` with score 0, and so is every text without a network.
    Columns of docs named like the two new ones are replaced; others may have any names.
    """
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (lang_pred, score)]
    return _guessed(docs, network, text).select(*kept, F.col("guess.l").alias(lang_pred), F.col("guess.s").alias(score))


def in_a_language(docs: DataFrame, network: Network | None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of docs whose text has letters, with the predicted language where lang is null.

    A language that is given stays.  Without a network a null lang stays null, and texts with letters stay too.
    """
    guess = F.when(F.col("guess.l") != UNDETERMINED, F.col("guess.l"))
    fill = {lang: F.coalesce(F.col("row").getField(lang), guess)} if lang in docs.columns else {}
    return _guessed(docs, network, text).where("guess.letters").select(
        *(fill.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
              texts: int = TEXTS, most: int = MOST) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs.

    The network learns from windows drawn from the whole of at most `sample` texts per language and `texts` in all,
    of rows that are not held out and have a language, and knows at most the `most` most frequent languages.  Rows
    without doc_id are not learnt from; repeated rows get equal predictions; an empty table gives no rows.
    """
    network = learn_languages(docs, key, text, lang, sample, texts=texts, most=most)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return predict_languages(rows, network).select("doc_id", "held_out", "lang_pred", "score")
