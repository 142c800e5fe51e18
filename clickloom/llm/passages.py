"""Near-duplicate passages by compact windows.

For one hash function, a compact window (l, c, r) of a document stands for all its subsequences that lie
in l..r and contain c: position c has their least hash.  Windows are the nodes of the Cartesian tree over
the hashes of the document's five-word shingles; only those at least LEAST shingles wide are kept, some
two per LEAST positions.  Documents that share a passage share its least hash, so windows meet by value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.spread import compare_pairs
from clickloom.llm.words import SHINGLE, common, mix, odd_multipliers, shingle_sequence, word_hashes
from clickloom.session import write_down

WORDS = 50
LEAST = WORDS - SHINGLE + 1
# A passage of LEAST shingles holds CONTEXT of them on at least one side of any of its positions.
CONTEXT = LEAST // 2
FUNCTIONS = 3
SEED = 20240910
PERCENT = 75
# Two edited words apart; runs of equal shingles with smaller gaps are one passage.
GAP = 2 * SHINGLE
# The width to which windows are followed on either side; comparing texts finds the whole passage.
REACH = 1024
# The shingles around a window's centre by which members of a key are told apart after the hubs, on either side.
VIEW = 2 * LEAST
BASE = np.uint64(0xD6E8FEB86659FD93)
# Members of one key on either side of a task.
BLOCK = 512
# Pairs of views that are compared at once; groups with no more are compared together.
PAIRS = 256


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The least value of every full window of that width."""
    size = 1
    while size * 2 <= width:
        h = np.minimum(h[: len(h) - size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def compact_windows(h: np.ndarray, least: int = LEAST, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of all windows at least `least` wide; a value of 0 bounds documents and is in no window.

    Of equal values the leftmost is a window's centre.  l and r are followed to `reach` from c.
    """
    n = len(h)
    none = np.empty(0, np.int64)
    if n < least:
        return none, none, none
    low = _sliding_min(h, least)
    edge = np.zeros(least - 1, np.uint64)
    # The greatest of the minima of all windows around c is its own value, if c is the least in one of them.
    top = ~_sliding_min(~np.concatenate([edge, low, edge]), least)
    c = np.nonzero((top == h) & (h > 0))[0]
    own, levels = h[c], [h]
    while 2 ** len(levels) <= min(reach, n):
        size = 2 ** (len(levels) - 1)
        levels.append(np.minimum(levels[-1][: len(levels[-1]) - size], levels[-1][size:]))
    left, right = c.copy(), c.copy()
    for j in reversed(range(len(levels))):
        size, table = 2**j, levels[j]
        at = left - size
        free = at >= 0
        free[free] = table[at[free]] > own[free]
        left[free] -= size
        free = right + 1 + size <= n
        free[free] = table[right[free] + 1] >= own[free]
        right[free] += size
    wide = right - left + 1 >= least
    return left[wide], c[wide], right[wide]


def _repeated(sequence: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of all stretches of one shingle that is repeated `least` times; 0 is no shingle."""
    starts = np.nonzero(np.append(True, sequence[1:] != sequence[:-1])[: len(sequence)])[0]
    ends = np.append(starts[1:], len(sequence))[: len(starts)]
    long = (ends - starts >= least) & (sequence[starts] > 0)
    return starts[long], ends[long]


def _rows(ids: list[int], sequences: list[np.ndarray], multipliers: np.ndarray):
    """(key, doc, position, print) of windows under each of their two keys: value and context before, or after.

    One shingle that repeats itself has a window at each place.  Of neighbours with one key the first stands for all, and
    the last place of the repeated shingle: a passage shared from any other place on goes on to where that shingle ends
    in both documents, so it lies on the diagonal of those two ends, or holds nothing else.  For the latter, LEAST
    repetitions have a key of their own.

    The print is a hash of the VIEW shingles on either side of the window's centre, as far as the document goes.
    """
    starts = np.cumsum([0, *(len(s) + 1 for s in sequences)])
    flat = np.zeros(starts[-1] + 1, np.uint64)
    for s, at in zip(sequences, starts[:-1], strict=True):
        flat[at + 1 : at + 1 + len(s)] = s
    doc_of = np.repeat(np.array(ids, np.int64), [len(s) + 1 for s in sequences])
    first = np.repeat(starts[:-1] + 1, [len(s) + 1 for s in sequences])
    bound = flat == 0
    new = np.append(True, flat[1:] != flat[:-1])
    last = np.append(np.nonzero(new)[0][1:], len(flat))[np.cumsum(new) - 1] - 1
    spots = [_repeated(flat)[0]]
    keyed = [mix(mix(flat[spots[0]]) + np.uint64(3)).view(np.int64)]
    hashes = []
    for m in multipliers:
        h = mix(flat * m) | np.uint64(1)
        h[bound] = 0
        hashes.append(h)
    # sums of value * BASE ** position: of any stretch by two lookups, and the same wherever the stretch begins.
    ends = np.repeat(starts[1:], [len(s) + 1 for s in sequences])
    powers = np.cumprod(np.full(len(flat), BASE))
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(np.where(bound, np.uint64(0), mix(flat)) * powers))
    inverse = np.cumprod(np.full(len(flat), np.uint64(pow(int(BASE), -1, 2**64))))
    for f, h in enumerate(hashes):
        left, c, right = compact_windows(h)
        other = hashes[(f + 1) % len(hashes)]
        context = _sliding_min(other, CONTEXT)
        value = mix(h[c] + np.uint64(f))
        for side, begin, whole in ((1, c - CONTEXT + 1, c - left >= CONTEXT - 1), (2, c, right - c >= CONTEXT - 1)):
            near = context[begin[whole]]
            at, key = c[whole], mix((value[whole] ^ near) + np.uint64(side)).view(np.int64)
            opens = np.append(True, (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1]))[: len(at)]
            at, key = at[opens], key[opens]
            long = last[at] > at
            at, key = np.append(at, last[at[long]]), np.append(key, key[long])
            keyed.append(key)
            spots.append(at)
    at, keys = np.concatenate(spots), np.concatenate(keyed)
    around = sums[np.minimum(at + VIEW + 1, ends[at])] - sums[np.maximum(at - VIEW, first[at])]
    return keys, doc_of[at], at - first[at], (mix(around * inverse[at]) >> np.uint64(16)).view(np.int64)


def keyed_windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(deal, key, doc, at, print, hub, hub_at, hub_print): every window of at least LEAST shingles under each of its keys.

    Windows of one key in one batch meet there, with the first document as hub.  Only the hub's windows are
    dealt by key, which is null beside it, so a passage that most documents hold sends few rows to one task.
    """
    multipliers = odd_multipliers(FUNCTIONS, SEED)
    names = ("deal", "key", "doc", "at", "print", "hub", "hub_at", "hub_print")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, ids, held, size = [], [], [], 0
            for doc, body in zip(batch.column(0), batch.column(1), strict=True):
                found = shingle_sequence(word_hashes(body.as_py()))
                if len(found) >= LEAST:
                    ids.append(doc.as_py())
                    held.append(found | np.uint64(1))
                    size += len(found)
                if size > 20_000:
                    parts.append(_rows(ids, held, multipliers))
                    ids, held, size = [], [], 0
            if held:
                parts.append(_rows(ids, held, multipliers))
            if not parts:
                continue
            keys, doc, at, prints = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((at, doc, keys))
            keys, doc, at, prints = keys[order], doc[order], at[order], prints[order]
            new = np.append(True, keys[1:] != keys[:-1])
            hub = np.nonzero(new)[0][np.cumsum(new) - 1]
            apart = doc[hub] != doc
            none = pa.nulls(int((~apart).sum()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[~apart]), none, *(pa.array(x[~apart]) for x in (doc, at, prints)), none, none, none], schema=schema)
            spread = mix(doc[apart].view(np.uint64) + at[apart].view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (spread, *(x[apart] for x in (keys, doc, at, prints)), *(x[hub][apart] for x in (doc, at, prints)))],
                schema=schema)

    return (docs.where(F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
            .mapInArrow(windows, ", ".join(f"{c} long" for c in names)))


def meetings(windows: DataFrame) -> DataFrame:
    """(key, a, a_at, a_print, b, b_at, b_print): each window with the hub a of its key, the first document of its batch or of all.

    The hub's own further windows are there too, with a = b; windows whose key no other window has are not.
    """
    sent = windows.repartition("deal").sortWithinPartitions("deal", "doc", "at")
    names = ("key", "a", "a_at", "a_print", "b", "b_at", "b_print")
    met = pa.schema([(c, pa.int64()) for c in names])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            there = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            done, open_ = batch.filter(pa.array(there)), batch.filter(pa.array(~there))
            keys, doc, at, prints, hub, hub_at, hub_print = (done.column(i).to_numpy() for i in range(1, 8))
            out = [(keys, hub, hub_at, hub_print, doc, at, prints)]
            rows = [open_.column(i).to_numpy() for i in (0, 2, 3, 4)]
            if len(rows[0]):
                if last is not None:
                    rows = [np.append(x, y) for x, y in zip(last, rows, strict=True)]
                keys = rows[0]
                new = np.append(True, keys[1:] != keys[:-1])
                hub = np.nonzero(new)[0][np.cumsum(new) - 1]
                rest = ~new
                out.append((keys[rest], *(x[hub][rest] for x in rows[1:]), *(x[rest] for x in rows[1:])))
                last = [x[hub[-1] : hub[-1] + 1] for x in rows]
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=met)

    return sent.mapInArrow(meet, ", ".join(f"{c} long" for c in names))


def _with_views(places: pa.StructArray, rows: list[tuple[np.ndarray, np.ndarray]], views: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    taken, doc = (np.concatenate(c) for c in zip(*rows, strict=True))
    taken, body = places.take(pa.array(taken)), np.concatenate(views)
    ends = pa.py_buffer(np.arange(len(body) + 1, dtype=np.int32) * np.int32(body.shape[1] * body.itemsize))
    view = pa.Array.from_buffers(pa.binary(), len(body), [None, ends, pa.py_buffer(body.tobytes())])
    return pa.RecordBatch.from_arrays([taken.field(0), pa.array(doc), *(taken.field(c) for c in (1, 2, 3)), view], schema=schema)


def _views(members: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The members (key, doc, at, print, lonely) with `view`: VIEW shingles on either side as 32-bit hashes; 0 is beyond the text."""
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("print", pa.int64()), ("lonely", pa.bool_()),
                        ("view", pa.binary())])
    asked = members.groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("key", "at", "print", "lonely")).alias("places"))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = np.zeros(VIEW, np.uint32)
        for batch in batches:
            places, bounds = batch.column(2).flatten(), batch.column(2).offsets.to_numpy()
            bounds = bounds - bounds[0]
            at = places.field(1).to_numpy()
            rows, views, size = [], [], 0
            for i in range(batch.num_rows):
                found = (shingle_sequence(word_hashes(batch.column(1)[i].as_py())) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                around = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, found, edge]), 2 * VIEW + 1) if len(found) else None
                mine = np.arange(bounds[i], bounds[i + 1])
                # Another row of the same doc_id may be shorter.
                mine = mine[at[mine] < len(found)]
                if not len(mine):
                    continue
                rows.append((mine, np.full(len(mine), batch.column(0)[i].as_py(), np.int64)))
                views.append(around[at[mine]])
                size += len(mine)
                if size >= 10_000:
                    yield _with_views(places, rows, views, schema)
                    rows, views, size = [], [], 0
            if size:
                yield _with_views(places, rows, views, schema)

    return texts.join(asked.hint("shuffle_hash"), "id").select("id", "text", "places").mapInArrow(
        run, "key long, doc long, at long, print long, lonely boolean, view binary")


def _needed(percent: int, least: int = LEAST) -> int:
    """Two passages of `least` different shingles have this many in common at that similarity."""
    return -(-2 * least * percent // (100 + percent))


def _extent(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (start, end) around the centre of each row that no more than GAP places in a row without a mark bound; equal if there is none."""
    sums = np.concatenate([np.zeros((len(near), 1), np.int16), np.cumsum(near, axis=1, dtype=np.int16)], axis=1)
    empty = sums[:, GAP + 1 :] == sums[:, : -GAP - 1]
    before, after = empty[:, : VIEW - GAP][:, ::-1], empty[:, VIEW + 1 :]
    start = np.where(before.any(axis=1), VIEW - before.argmax(axis=1), 0)
    end = np.where(after.any(axis=1), VIEW + 1 + after.argmax(axis=1), near.shape[1])
    return start, np.where(empty[:, VIEW - GAP : VIEW + 1].any(axis=1), start, end)


def _near(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which places of `one`, then of `many`, hold a shingle of the other view within GAP of the diagonal, row by row."""
    width = many.shape[1]
    wide, there = np.zeros((len(many), width + 2 * GAP), one.dtype), many > 0
    wide[:, GAP : GAP + width] = one
    ours, theirs = np.zeros(wide.shape, bool), np.zeros(many.shape, bool)
    for d in range(2 * GAP + 1):
        same = (many == wide[:, d : d + width]) & there
        theirs |= same
        ours[:, d : d + width] |= same
    return ours[:, GAP : GAP + width], theirs


def _stretch(marks: np.ndarray, percent: int, least: int = LEAST, bounded: bool = False) -> np.ndarray:
    """For each row: whether `least` or more places in a row, the centre among them, have marks for that similarity.

    Of two times n different shingles c are common: 100 c >= percent (2 n - c).  If bounded, within `_extent`.
    """
    steps = np.where(marks, np.int32(100 - percent), np.int32(-2 * percent))
    if bounded:
        start, end = _extent(marks)
        places = np.arange(marks.shape[1])
        steps[(places < start[:, None]) | (places >= end[:, None])] = -2 * percent * marks.shape[1]
    sums = np.zeros((len(marks), marks.shape[1] + 1), np.int32)
    np.cumsum(steps, axis=1, out=sums[:, 1:])
    low = np.minimum.accumulate(sums[:, : VIEW + 1], axis=1)
    return (sums[:, VIEW + 1 :] >= low[:, np.minimum(VIEW, np.arange(VIEW + 1, sums.shape[1]) - least)]).any(axis=1)


def _repeats(views: np.ndarray) -> np.ndarray:
    """For each view whether it holds a shingle twice."""
    held = np.sort(views, axis=1)
    return ((held[:, 1:] == held[:, :-1]) & (held[:, 1:] > 0)).any(axis=1)


def _alike_around(one: np.ndarray, many: np.ndarray, percent: int, least: int = LEAST,
                  repeated: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each view in `many`: whether it shares a passage around its centre with `one`, and whether one may go on beyond the view.

    `one` is one view, or one for each in `many`.  Of different shingles, a passage longer than the views has a stretch of
    `least` to twice as many that is as alike as the whole, and meets by itself: views without repeated shingles leave
    nothing open.  Sets of repeated shingles are not told by their places; there the passages are compared (`repeated`, if known).
    """
    one = np.broadcast_to(one, many.shape)
    same = (many == one) & (one > 0)
    before, after = same[:, VIEW::-1], same[:, VIEW:]
    run = (np.where(before.all(axis=1), VIEW + 1, before.argmin(axis=1)) + np.where(after.all(axis=1), VIEW + 1, after.argmin(axis=1)) - 1)
    sure = run >= least
    maybe = np.zeros(len(many), bool)
    rest = np.nonzero(~sure)[0]
    ours, theirs = _near(one[rest], many[rest])
    told = _repeats(one[rest]) | _repeats(many[rest]) if repeated is None else repeated[rest]
    plain = np.nonzero(~told)[0]
    plain = plain[_stretch(theirs[plain], percent, least)]
    sure[rest[plain]] = _stretch(ours[plain], percent, least, bounded=True) & _stretch(theirs[plain], percent, least, bounded=True)
    rest, ours, theirs = rest[told], ours[told], theirs[told]
    (start, end), (there, until) = _extent(ours), _extent(theirs)
    needed = _needed(percent, least)
    for k in np.nonzero((end - start >= least) & (until - there >= least))[0].tolist():
        i = rest[k]
        values = np.unique(one[i][one[i] > 0])
        held = many[i][(many[i] > 0) & np.isin(many[i], values)]
        if len(held) < needed and len(np.unique(held)) * 2 < min(needed, len(values)):
            continue
        # Beyond the texts is nothing, which equals nothing.
        passages = shared_passages(one[i], np.where(many[i] > 0, many[i], np.uint32(2)), [0], percent, least)
        sure[i] = any(x <= VIEW < y and u <= VIEW < v for x, y, u, v, _ in passages)
        maybe[i] = not sure[i] and (start[k] == there[k] == 0 or end[k] == until[k] == many.shape[1])
    return sure, maybe


def _alike_in_parts(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, repeated: np.ndarray,
                    percent: int) -> tuple[np.ndarray, np.ndarray]:
    """`_alike_around` for pairs of rows (i of left, j of right), some at a time."""
    parts = [_alike_around(left[i[x : x + PAIRS]], right[j[x : x + PAIRS]], percent, repeated=repeated[x : x + PAIRS])
             for x in range(0, len(i), PAIRS)]
    sure, maybe = (np.concatenate([np.empty(0, bool), *c]) for c in (zip(*parts, strict=True) if parts else ((), ())))
    return sure, maybe


def _partners(left: np.ndarray, right: np.ndarray, earlier: np.ndarray, later: np.ndarray, repeats: np.ndarray, theirs: np.ndarray,
              percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): for each view on the right the views on the left, of earlier documents, up to the first that shares a passage with it.

    Only views that hold enough of the other's shingles, at any place, are compared place by place.  `repeats` and
    `theirs` say which views on the left and right have repeated shingles.
    """
    values, ids = np.unique(np.concatenate([left.ravel(), right.ravel()]), return_inverse=True)
    mine, other = ids[: left.size].reshape(left.shape), ids[left.size :].reshape(right.shape)
    open_, needed, out = np.ones(len(right), bool), _needed(percent), []
    there = np.zeros(len(values), bool)
    for i, row in enumerate(mine):
        near = np.nonzero(open_ & (later > earlier[i]))[0]
        if not len(near):
            continue
        own = row[left[i] > 0]
        there[own] = True
        marks = there[other[near]]
        there[own] = False
        told = theirs[near] | repeats[i]
        enough = marks.sum(axis=1) >= np.where(told, 1, needed)
        near, marks, told = near[enough], marks[enough], told[enough]
        may = np.zeros(len(near), bool)
        may[~told] = _stretch(marks[~told], percent)
        start, end = _extent(marks[told])
        may[told] = end - start >= LEAST
        near, told = near[may], told[may]
        sure, maybe = _alike_in_parts(left, right, np.full(len(near), i), near, told, percent)
        open_[near[sure]] = False
        out.append((np.full(int((sure | maybe).sum()), i), near[sure | maybe]))
    return tuple(np.concatenate([np.empty(0, np.int64), *c]) for c in (zip(*out, strict=True) if out else ((), ())))


def _partners_of_groups(views: np.ndarray, doc: np.ndarray, starts: np.ndarray, middles: np.ndarray, ends: np.ndarray,
                        percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) as `_partners` gives, for groups of rows that each begin with those on the left; small groups are compared together."""
    n, m, repeats = middles - starts, ends - middles, _repeats(views)
    out, small = [], n * m <= PAIRS
    for g in np.nonzero(~small)[0].tolist():
        left, right = slice(starts[g], middles[g]), slice(middles[g], ends[g])
        i, j = _partners(views[left], views[right], doc[left], doc[right], repeats[left], repeats[right], percent)
        out.append((i + starts[g], j + middles[g]))
    size = (n * m)[small]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    across = np.repeat(n[small], size)
    # All of one row on the right come together, in the order of those on the left.
    i, j = np.repeat(starts[small], size) + at % across, np.repeat(middles[small], size) + at // across
    i, j = i[doc[j] > doc[i]], j[doc[j] > doc[i]]
    sure, maybe = _alike_in_parts(views, views, i, j, repeats[i] | repeats[j], percent)
    if len(j):
        first = np.append(True, j[1:] != j[:-1])
        before = np.cumsum(sure) - sure
        found = (sure | maybe) & (before == before[np.nonzero(first)[0]][np.cumsum(first) - 1])
        out.append((i[found], j[found]))
    return tuple(np.concatenate([np.empty(0, np.int64), *c]) for c in (zip(*out, strict=True) if out else ((), ())))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted stream in batches that no group of equal leading columns goes beyond; callers bound the groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        new[0] = not held or any(held[-1].column(c)[-1].as_py() != x[0] for c, x in enumerate(columns))
        for x in columns:
            new[1:] |= x[1:] != x[:-1]
        cut = int(np.nonzero(new)[0][-1]) if new.any() else 0
        if new.any() and (held or cut):
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.concat_batches(held)


def _met_later(met: DataFrame, lonely: DataFrame, docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """(a, b, diagonal): for windows that share no passage with their hub, earlier documents under the key that do.

    All members of such a key are compared, those that share a passage with the hub too.  Members with equal
    views do share one; only the first of them is compared with others.  A task holds a block of members and
    one of lonely windows, and no other pairs leave it.
    """
    # (key, print, doc, at, lonely): the windows under the keys that have lonely ones.
    members = met.select("key", "print", "doc", "at").unionByName(
        met.select("key", F.col("a_print").alias("print"), F.col("a").alias("doc"), F.col("a_at").alias("at"))).distinct()
    members = members.join(lonely.select("key").distinct(), "key", "left_semi")
    firsts = members.groupBy("key", "print").agg(F.min(F.struct("doc", "at")).alias("first"))
    firsts = write_down(firsts.select("key", "print", F.col("first.doc").alias("doc"), F.col("first.at").alias("at")))
    met_first = write_down(lonely.join(firsts.select("key", "print", F.col("doc").alias("a"), F.col("at").alias("a_at")), ["key", "print"]))
    equal = met_first.where("a < doc").select("a", F.col("doc").alias("b"), (F.col("at") - F.col("a_at")).alias("diagonal"))
    own = met_first.where("a = doc").select("key", "print", "doc", "a_at", "at")
    alone = own.select("key", "print").distinct().withColumn("lonely", F.lit(True))
    sizes = firsts.join(alone, ["key", "print"], "left").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count("lonely").alias("m")).where("n > 1 and m > 0")
    sizes = write_down(sizes.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("lefts"),
                                    F.ceil(F.col("m") / BLOCK).cast("int").alias("rights")))
    asked = firsts.join(sizes, "key", "left_semi").join(alone, ["key", "print"], "left").withColumn(
        "lonely", F.coalesce("lonely", F.lit(False)))
    # One row per view and block it meets: on side 0 as a member that others may share a passage with, on side 1 as a lonely one.
    member = F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda i: F.struct(
        F.col("left_block").alias("left"), i.alias("right"), F.lit(0).alias("side")))
    single = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda i: F.struct(
        i.alias("left"), F.col("right_block").alias("right"), F.lit(1).alias("side")))
    parts = F.when(F.col("lonely"), F.concat(member, single)).otherwise(member)
    rows = (_views(asked, docs, key, text).join(sizes, "key")
            .withColumn("left_block", F.pmod(F.xxhash64("doc", "at"), F.col("lefts")).cast("int"))
            .withColumn("right_block", F.pmod(F.xxhash64("at", "doc"), F.col("rights")).cast("int"))
            .withColumn("part", F.explode(parts))
            .select("key", "part.left", "part.right", "part.side", "doc", "at", "print", "view")
            .repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "side", "doc", "at"))
    names = ("key", "print", "a", "from_at", "b")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches, 3):
            bucket, left, right, side, doc, place, prints = (batch.column(c).to_numpy() for c in range(7))
            starts = np.nonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])))[0]
            ends = np.append(starts[1:], len(bucket))
            views = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint32).reshape(len(bucket), -1)
            i, j = _partners_of_groups(views, doc, starts, ends - np.add.reduceat(side, starts), ends, percent)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket[j], prints[j], doc[i], place[i], doc[j])], schema=schema)

    later = rows.mapInArrow(run, ", ".join(f"{c} long" for c in names)).join(own.select("key", "print", "at"), ["key", "print"])
    return equal.unionByName(later.select("a", "b", (F.col("at") - F.col("from_at")).alias("diagonal"))).distinct()


def _runs(a: np.ndarray, b: np.ndarray, diagonals: list[int]) -> list[tuple[int, int, int]]:
    """(start in a, end in a, diagonal) of all equal runs on sorted diagonals."""
    n, out = len(a), []
    diagonals = [d for d in diagonals if -n < d < len(b)]
    at = 0
    while at < len(diagonals):
        low, held = diagonals[at], at
        while at < len(diagonals) and diagonals[at] == low + at - held and (at - held) * n < 1_000_000:
            at += 1
        high = low + at - held - 1
        # Row k holds diagonal low + k; places beyond b, and the one after a, are False.
        same = np.zeros((at - held, n + 1), bool)
        left, right = max(0, -high), min(n, len(b) - low)
        part = np.zeros(right - left + high - low, b.dtype)
        x, y = max(0, left + low), min(len(b), right + high)
        part[x - left - low : y - left - low] = b[x:y]
        np.equal(np.lib.stride_tricks.sliding_window_view(part, right - left), a[left:right], out=same[:, left:right])
        for k, d in enumerate(range(low, high + 1)):
            same[k, : max(0, -d)] = False
            same[k, min(n, len(b) - d) :] = False
        flat = np.append(False, same.ravel())
        edges = np.nonzero(flat[1:] != flat[:-1])[0]
        row, start = np.divmod(edges[::2], n + 1)
        out.append((start, start + edges[1::2] - edges[::2], row + low))
    if not out:
        return []
    x, y, d = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.lexsort((x, x + d))
    return list(zip(x[order].tolist(), y[order].tolist(), d[order].tolist(), strict=True))


def _inside(parts: list[tuple[int, int, int, int]], alike: Callable, percent: int, least: int) -> list[tuple[int, int, int, int, float]]:
    """From each run of a chain on the longest stretch of runs that is alike, if it is not inside the one before.

    Only stretches whose runs are long enough together for that similarity are compared.
    """
    x, y, u, v = np.array(parts).T
    held = np.append(0, np.cumsum(y - x))
    y, v = np.maximum.accumulate(y), np.maximum.accumulate(v)
    out, done = [], -1
    for low in range(0, len(parts), 64):
        i, j = np.arange(low, min(low + 64, len(parts)))[:, None], np.arange(low, len(parts))
        n, m = y[low:] - x[i], v[low:] - u[i]
        fits = (j >= i) & (n >= least) & (m >= least) & ((100 + percent) * (held[low + 1 :] - held[i]) >= percent * (n + m))
        for row in np.nonzero(fits.any(axis=1))[0].tolist():
            for end in (np.nonzero(fits[row])[0][::-1] + low).tolist():
                if end <= done:
                    break
                found = alike(int(x[low + row]), int(y[end]), int(u[low + row]), int(v[end]))
                if found:
                    out += found
                    done = end
                    break
    return out


def _chained(runs: list[tuple[int, int, int]], alike: Callable, percent: int, least: int) -> list[tuple[int, int, int, int, float]]:
    """The passages that these equal runs make up."""
    chains: list[list[int]] = []
    for x, y, d in runs:
        for chain in reversed(chains[-8:]):
            if -GAP <= x - chain[1] <= GAP and -GAP <= x + d - chain[3] <= GAP:
                chain[1], chain[3] = max(chain[1], y), max(chain[3], y + d)
                chain[4].append((x, y, x + d, y + d))
                break
        else:
            chains.append([x, y, x + d, y + d, [(x, y, x + d, y + d)]])

    # A chain with too many edits may still hold passages that have few.
    return [p for x, y, u, v, parts in chains if y - x >= least and v - u >= least
            for p in alike(x, y, u, v) or _inside(parts, alike, percent, least)]


def _distinct(sequence: np.ndarray) -> np.ndarray:
    """The different values, sorted; for short arrays less to do than np.unique."""
    held = np.sort(sequence)
    return held[np.append(True, held[1:] != held[:-1])[: len(held)]]


def shared_passages(a: np.ndarray, b: np.ndarray, diagonals: list[int], percent: int = PERCENT,
                    least: int = LEAST) -> list[tuple[int, int, int, int, float]]:
    """(start in a, end in a, start in b, end in b, similarity) in shingles, of passages on or near the diagonals.

    An inserted or deleted word moves the rest of a passage to another diagonal, so those within GAP of the given
    ones are read too.  More runs can make a chain too weak, so passages on the given diagonals alone stay.
    A passage that lies inside another one is not reported.
    """
    @cache
    def alike(x, y, u, v):
        if np.array_equal(a[x:y], b[u:v]):
            return [(x, y, u, v, 1.0)]
        one, two = _distinct(a[x:y]), _distinct(b[u:v])
        shared = common(one, two)
        whole = len(one) + len(two) - shared
        return [(x, y, u, v, shared / whole)] if 100 * shared >= percent * whole else []

    given = set(diagonals)
    if 0 in given and len(a) >= least and np.array_equal(a, b):
        return alike(0, len(a), 0, len(a))
    near = _runs(a, b, sorted({d + i for d in given for i in range(-GAP, GAP + 1)}))
    own = [r for r in near if r[2] in given]
    return _outermost([p for runs in ([near] if len(own) == len(near) else [own, near]) for p in _chained(runs, alike, percent, least)])


def repetitions(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int, int, float]]:
    """Passages of one repeated shingle that together cover all of b's stretches of it, if a has one, in the form of `shared_passages`."""
    if not all((s[least - 1 :] == s[: max(0, len(s) - least + 1)]).any() for s in (b, a)):
        return []
    held: dict[int, tuple[int, int]] = {}
    for x, y in zip(*(c.tolist() for c in _repeated(a, least)), strict=True):
        before = held.get(int(a[x]))
        if before is None or before[1] - before[0] < y - x:
            held[int(a[x])] = x, y
    out = []
    for u, v in zip(*(c.tolist() for c in _repeated(b, least)), strict=True):
        if int(b[u]) in held:
            x, y = held[int(b[u])]
            n = min(y - x, v - u)
            out.extend((x, x + n, at, at + n, 1.0) for at in sorted({*range(u, v - n, n), v - n}))
    return out


def _outermost(found: list[tuple[int, int, int, int, float]]) -> list[tuple[int, int, int, int, float]]:
    """The passages that lie inside no other one."""
    kept: list[tuple[int, int, int, int, float]] = []
    for p in sorted(found, key=lambda p: (p[0] - p[1] + p[2] - p[3], p)):
        if not any(q[0] <= p[0] and p[1] <= q[1] and q[2] <= p[2] and p[3] <= q[3] for q in kept):
            kept.append(p)
    return kept


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, start_word, end_word, other_id, other_start, other_end, similarity) of passages an earlier document holds too.

    A passage has at least 50 words; positions count words, ends are exclusive.  Similarity is the Jaccard
    similarity of the two passages' sets of five-word shingles, at least percent / 100, computed on the texts.
    One row per passage and the document it is compared with, not one per pair of copies.

    Null, empty or shorter texts and rows without doc_id have no passages; rows with equal doc_id are not
    compared with each other.  An empty table gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("other_id", pa.int64()),
                        ("other_start", pa.int64()), ("other_end", pa.int64()), ("similarity", pa.float64())])

    def judge(centre, member, a, b, note):
        found = shared_passages(centre, member, [int(d) for d in note.split(",")], percent)
        more = repetitions(centre, member)
        for x, y, u, v, similar in _outermost(found + more) if more else found:
            yield b, u, v + SHINGLE - 1, a, x, y + SHINGLE - 1, similar

    def compared(met: DataFrame) -> DataFrame:
        pairs = write_down(met.groupBy("a", "b").agg(
            F.array_join(F.array_sort(F.collect_set(F.col("diagonal").cast("string"))), ",").alias("note")))
        return compare_pairs(pairs, docs, key, text, lambda body: shingle_sequence(word_hashes(body)), judge, schema,
                             "doc_id long, start_word long, end_word long, other_id long, other_start long, other_end long, similarity double").distinct()

    met = write_down(meetings(keyed_windows(docs, key, text)).withColumnsRenamed({"b": "doc", "b_at": "at", "b_print": "print"}))
    apart = met.where("a < doc")
    diagonals = apart.select("a", F.col("doc").alias("b"), (F.col("at") - F.col("a_at")).alias("diagonal"))
    found = write_down(compared(diagonals))
    spans = found.groupBy(F.col("other_id").alias("a"), "doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))
    # Positions count shingles; a passage of n words has SHINGLE - 1 fewer.
    covered = F.exists("spans", lambda s: (s["start_word"] <= F.col("at")) & (F.col("at") <= s["end_word"] - SHINGLE))
    left = apart.join(spans.withColumnRenamed("doc_id", "doc"), ["a", "doc"], "left").withColumn("met", F.coalesce(covered, F.lit(False)))
    lonely = write_down(left.groupBy("key", "print", "doc", "at").agg(F.max("met").alias("met")).where("not met").drop("met"))
    later = write_down(_met_later(met, lonely, docs, key, text, percent))
    pairs = later.select("a", "b").distinct()
    rest = compared(later.unionByName(diagonals.join(pairs, ["a", "b"], "left_semi")))
    old = found.join(pairs, (F.col("other_id") == F.col("a")) & (F.col("doc_id") == F.col("b")), "left_anti")
    return old.unionByName(rest)
