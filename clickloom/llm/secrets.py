"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds spans.

The field tags tokens as begin, inside or outside of a secret.  It is fitted in numpy on windows around
what the patterns find, without seeing the patterns, from the shape of a token, the words beside it and
features of the whole text, and is decoded by Viterbi.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CUES = ("password", "passwd", "secret", "token", "api")

# Texts the field is fitted on: so many with a pattern and so many without, the first by a hash of their keys.
SAMPLE = 400
# Tokens around a secret that a training sequence holds, and tokens of a text without one.
AROUND, PLAIN = 24, 64
STEPS, RATE, PENALTY = 100, 0.1, 1e-3

_TOKEN = re.compile(r"[A-Za-z0-9+/_.\-]+|[=:]|[^\sA-Za-z0-9+/_.\-=:]+")
_TAGS = 3
BEGIN, INSIDE, OUTSIDE = range(_TAGS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of what the patterns find, sorted."""
    found = []
    low = text.lower()
    if any(cue in low for cue in _CUES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _secret_parts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The spans without the name of an assignment, merged."""
    parts = []
    for start, kind, end in spans:
        if kind == 0:
            start = _ASSIGN.match(text, start).start(2)
        if parts and start < parts[-1][1]:
            parts[-1] = (parts[-1][0], max(end, parts[-1][1]))
        else:
            parts.append((start, end))
    return parts


def shape(token: str) -> tuple[str, ...]:
    """Features of a token alone; words of letters have few of them, so that most share theirs."""
    core = token.rstrip(".")
    n = len(token)
    length = f"length {min(n.bit_length(), 7)}"
    if core.isalpha():
        return ("word", length, f"case {core.islower()} {core.isupper()}")
    digits = sum(c.isdigit() for c in token)
    upper = sum(c.isupper() for c in token)
    lower = sum(c.islower() for c in token)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(token).values())
    swaps = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:]))
    return (length, f"digits {4 * digits // n}", f"upper {4 * upper // n}", f"lower {4 * lower // n}",
            f"entropy {int(entropy)}", f"swaps {min(swaps, 8) // 2}", f"ascii {token.isascii()}",
            f"dense {digits > 0 and upper + lower > 0 and n >= 12}", f"all hex {n >= 12 and all(c in '0123456789abcdef' for c in token)}",
            f"symbol {token in ('=', ':')}")


def file_features(text: str, tokens: list[str]) -> tuple[str, ...]:
    """Features of the whole text: how much of it is assignments, and its line length."""
    marks = sum(text.count(c) for c in "=:{}")
    return (f"marks {min(4, int(200 * marks / max(1, len(text))))}",
            f"lines {min(6, (len(text) // (text.count(chr(10)) + 1)).bit_length() // 2)}")


class _Gains(dict):
    """What a token's own features add at most in favour of a tag other than outside; kept for a bounded number of tokens."""

    def __init__(self, field: Field):
        self.field, self.shapes = field, {}

    def __missing__(self, token: str) -> float:
        if len(self) >= 200_000:
            self.clear()
        names = shape(token)
        gain = self.shapes.get(names)
        if gain is None:
            gain = self.shapes[names] = self.field.gain(self.field.sum(names))
        self[token] = gain
        return gain


class Field:
    """Weights of features by tag, and of tags after tags."""

    def __init__(self, numbers: dict[str, int], weights: np.ndarray, after: np.ndarray):
        self.numbers, self.weights, self.after = numbers, weights, after
        # A run of tags other than outside has one transition more than tokens: this much per token at most.
        self.slack = 2 * max(0.0, float((after - after[OUTSIDE, OUTSIDE]).max()))
        others = [t for t in range(_TAGS) if t != OUTSIDE]
        # What the chain loses at most if one token within such a run is outside instead.
        self.hold = max(0.0, *(float(after[x, t] + after[t, y] - after[x, OUTSIDE] - after[OUTSIDE, y])
                               for t in others for x in range(_TAGS) for y in range(_TAGS)))
        self.alone = _Gains(self)
        self.beside = [{name[3:]: self.gain(weights[i]) for name, i in numbers.items() if name.startswith(f"{w} ")}
                       for w in ("b1", "b2", "a1")]
        self.most = sum(max([0.0, *gains.values()]) for gains in self.beside)

    def sum(self, names: tuple[str, ...]) -> np.ndarray:
        out = np.zeros(_TAGS)
        for name in names:
            i = self.numbers.get(name)
            if i is not None:
                out += self.weights[i]
        return out

    @staticmethod
    def gain(score: np.ndarray) -> float:
        return float(score[:OUTSIDE].max() - score[OUTSIDE])

    def bounds(self, tokens: list[str], whole: tuple[str, ...]) -> np.ndarray | None:
        """For each token, at least the gain of its best tag over outside, apart from the chain; None if none can be positive."""
        n = len(tokens)
        total = np.fromiter(map(self.alone.__getitem__, tokens), float, n) + self.gain(self.sum(whole))
        if total.max() + self.most + self.slack <= 0:
            return None
        near = ["", "", *tokens, ""]
        for gains, shift in zip(self.beside, (1, 0, 3), strict=True):
            total += np.fromiter(map(gains.get, near[shift : shift + n], repeat(0.0)), float, n)
        return total

    def decode(self, features: list[tuple[str, ...]]) -> list[int]:
        """The best tags of a sequence."""
        score, back = self.sum(features[0]), []
        for names in features[1:]:
            paths = score[:, None] + self.after
            back.append(paths.argmax(axis=0))
            score = paths.max(axis=0) + self.sum(names)
        tags = [int(score.argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]


def features_at(tokens: list[str], i: int, whole: tuple[str, ...]) -> tuple[str, ...]:
    """All features of a token: its shape, the words beside it (none at an edge of the text), the whole text."""
    near = lambda k: tokens[k] if 0 <= k < len(tokens) else ""
    return (*shape(tokens[i]), f"b1 {near(i - 1)}", f"b2 {near(i - 2)}", f"a1 {near(i + 1)}", *whole)


def added_spans(text: str, field: Field, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans the field tags as secrets, without those that touch a span already taken.

    A run of secret tokens holds one whose gain, with its share of the chain's, is positive.  From such a
    token the text is decoded to both sides up to tokens that are outside on any best path, so the result is that
    of decoding the whole text.
    """
    tokens = _TOKEN.findall(text)
    if not tokens:
        return []
    whole = file_features(text, tokens)
    bounds = field.bounds(tokens, whole)
    seeds = [] if bounds is None else np.nonzero(bounds + field.slack > 0)[0].tolist()
    if not seeds:
        return []
    cut = np.append(np.nonzero(bounds + field.hold < 0)[0], len(tokens))
    places = [m.span() for m in _TOKEN.finditer(text)]
    found, done = [], -1
    for seed in seeds:
        if seed < done:
            continue
        k = int(np.searchsorted(cut, seed))
        start, done = int(cut[k - 1]) if k else 0, int(cut[k])
        tags = field.decode([features_at(tokens, i, whole) for i in range(start, min(len(tokens), done + 1))])
        open_ = None
        for i, tag in enumerate([*tags, OUTSIDE], start):
            if open_ is not None and tag != INSIDE:
                found.append((places[open_][0], places[i - 1][1]))
                open_ = None
            if open_ is None and tag != OUTSIDE:
                open_ = i
    return [s for s in found if not any(s[0] < e and b < s[1] for b, e in taken)]


def _sequences(text: str) -> list[tuple[list[tuple[str, ...]], list[int]]]:
    """Training sequences of one text: the surroundings of its secrets, or its first tokens."""
    tokens, places = _TOKEN.findall(text), [m.span() for m in _TOKEN.finditer(text)]
    if not tokens:
        return []
    parts, whole = _secret_parts(text, base_spans(text)), file_features(text, tokens)
    tags = [OUTSIDE] * len(tokens)
    for start, end in parts:
        inside = [i for i, (a, b) in enumerate(places) if a < end and start < b]
        for k, i in enumerate(inside):
            tags[i] = INSIDE if k else BEGIN
    marked = [i for i, t in enumerate(tags) if t == BEGIN]
    spans = [(max(0, i - AROUND), min(len(tokens), i + AROUND)) for i in marked[:4]] or [(0, min(len(tokens), PLAIN))]
    return [([features_at(tokens, k, whole) for k in range(a, b)], tags[a:b]) for a, b in spans]


def fit(texts: list[str]) -> Field:
    """A field fitted by gradient ascent of the penalised likelihood; sums over paths go forward and backward."""
    data = [s for t in texts for s in _sequences(t)]
    counts = Counter(name for names, _ in data for token in names for name in set(token))
    numbers = {name: i for i, name in enumerate(sorted(n for n, c in counts.items() if c >= 3))}
    m, width = len(numbers), max((len(f) for _, f in data), default=1)
    if not data or not any(t != OUTSIDE for _, tags in data for t in tags):
        return Field({}, np.zeros((0, _TAGS)), np.zeros((_TAGS, _TAGS)))
    per = max(len(names) for s, _ in data for names in s)
    ids, real = np.full((len(data), width, per), m), np.zeros((len(data), width), bool)
    gold = np.full((len(data), width), OUTSIDE)
    for n, (names, tags) in enumerate(data):
        for t, token in enumerate(names):
            known = [numbers[x] for x in token if x in numbers]
            ids[n, t, : len(known)] = known
        real[n, : len(tags)], gold[n, : len(tags)] = True, tags
    weights, after = np.zeros((m + 1, _TAGS)), np.zeros((_TAGS, _TAGS))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(after), np.zeros_like(after)]
    rows = np.arange(len(data))
    total = real.sum()
    for step in range(1, STEPS + 1):
        unary = weights[ids].sum(axis=2) * real[:, :, None]
        alpha, scale = np.zeros((len(data), width, _TAGS)), np.exp(after)
        alpha[:, 0] = np.exp(unary[:, 0] - unary[:, 0].max(axis=1, keepdims=True))
        alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
        local = np.exp(unary - unary.max(axis=2, keepdims=True))
        for t in range(1, width):
            x = (alpha[:, t - 1] @ scale) * local[:, t]
            alpha[:, t] = np.where(real[:, t, None], x / x.sum(axis=1, keepdims=True), alpha[:, t - 1])
        beta = np.ones((len(data), width, _TAGS))
        pairs = np.zeros((_TAGS, _TAGS))
        for t in range(width - 2, -1, -1):
            ahead = local[:, t + 1] * beta[:, t + 1]
            both = alpha[:, t, :, None] * scale[None] * ahead[:, None, :]
            both /= both.sum(axis=(1, 2), keepdims=True)
            pairs += (both * real[:, t + 1, None, None]).sum(axis=0)
            x = ahead @ scale.T
            beta[:, t] = np.where(real[:, t + 1, None], x / x.sum(axis=1, keepdims=True), beta[:, t + 1])
        marginal = alpha * beta
        marginal /= marginal.sum(axis=2, keepdims=True)
        wrong = -marginal * real[:, :, None]
        for t in range(width):
            wrong[rows, t, gold[:, t]] += real[:, t]
        slope = np.zeros_like(weights)
        for tag in range(_TAGS):
            slope[:, tag] = np.bincount(ids.reshape(-1), np.repeat(wrong[:, :, tag].reshape(-1), per), m + 1)
        turn = -pairs
        for t in range(width - 1):
            on = real[:, t + 1]
            np.add.at(turn, (gold[on, t], gold[on, t + 1]), 1.0)
        for k, (value, g) in enumerate(((weights, slope), (after, turn))):
            g = g / total - PENALTY * value
            first, second = moments[2 * k], moments[2 * k + 1]
            first *= 0.9
            first += 0.1 * g
            second *= 0.999
            second += 0.001 * g * g
            value += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights[m] = 0
    return Field(numbers, weights[:m], after)


def training_texts(docs: DataFrame, key: str, text: str, sample: int = SAMPLE) -> list[str]:
    """At most `sample` texts with a pattern and as many without, the first by a hash of their keys."""
    body, order = F.col(text), [F.xxhash64(F.lit("secrets"), F.col(key)), F.col(text)]
    low = F.lower(body)
    marked = body.contains("AKIA") | F.contains(low, F.lit("password")) | F.contains(low, F.lit("token")) | F.contains(low, F.lit("secret"))
    some = docs.where(body.isNotNull() & (F.length(body) <= 20_000)).select(body.alias("body"), *(c.alias(f"o{i}") for i, c in enumerate(order)), marked.alias("marked"))
    texts = []
    for cond in (F.col("marked"), ~F.col("marked")):
        half = some.where(cond)
        # The cut that keeps `sample` rows is found on the hashes alone, so few texts are sorted or sent.
        top = half.select("o0").orderBy("o0").limit(sample).agg(F.max("o0")).first()[0]
        if top is not None:
            texts += [r.body for r in half.where(F.col("o0") <= top).orderBy("o0", "o1").limit(sample).select("body").collect()]
    return texts


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, field: Field | None = None) -> DataFrame:
    """(doc_id, secrets) for every row of docs; secrets is an array of (kind, start, end), sorted, in code points.

    Kinds assign, access and hex are what the fixed patterns find, crf what the field adds beside them.
    Positions count code points of the whole text, ends are exclusive.  Null or empty texts have no
    secrets; repeated rows and rows without key are read like others; an empty table gives no rows.  The field is
    fitted on at most 2 * sample texts of at most 20,000 characters; every text is tagged in full.
    """
    field = field or fit(training_texts(docs, key, text, sample))
    numbers, weights, after = field.numbers, field.weights, field.after
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Field(numbers, weights, after)
        for batch in batches:
            out = []
            for body in batch.column(1):
                body = body.as_py() or ""
                base = base_spans(body)
                more = added_spans(body, here, [(s, e) for s, _, e in base])
                rows = sorted(base + [(s, len(KINDS), e) for s, e in more])
                out.append([{"kind": (*KINDS, "crf")[k], "start": s, "end": e} for s, k, e in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "secrets"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text)).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)[key]}, secrets array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, a checksum of the patterns' spans, and all spans as text."""
    base = F.filter("secrets", lambda s: s["kind"] != "crf")
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
                        line(F.col("secrets")).alias("spans"))


def checksum(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
