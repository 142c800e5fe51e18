"""The training-data operators: edge cases, brute force on small fixtures, and planted cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import contamination, language, lines, mixing, near, passages, quality, secrets, sharding, vectors
from clickloom.llm.words import shingle_sequence, word_hashes

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Plain documents, exact and near copies, nulls, empty and long texts, repeated rows, columns named like internal ones."""
    rng = random.Random(5)
    texts = {i: prose(rng, rng.choice([3, 30, 120, 300])) for i in range(40)}
    texts[50], texts[51] = texts[3], texts[3]
    long = prose(rng, 200)
    for i in range(60, 90):
        words = long.split()
        words[rng.randrange(200)] = f"edit{i}"
        texts[i] = " ".join(words)
    texts |= {100: "", 101: "  \n\t ", 102: prose(rng, 8000), 103: "One Two", 104: "one\ttwo"}
    shared = prose(rng, 60)
    for i in range(110, 114):
        texts[i] = prose(rng, 80) + "\n" + shared + "\n" + prose(rng, 70)
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t)) for i, t in texts.items()]
    rows += [(120, None, None, None, None), (None, texts[5], "en", "s1", 3), rows[0]]
    frame = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("key", "node", "size", "rank", "hub", "shard", "block")})
    return frame.repartition(3), rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("block", [None, 3])
def test_near_duplicates_against_all_pairs(spark, corpus, empty, block, monkeypatch):
    frame, rows = corpus
    if block:
        # Cells of a few members, so that buckets are cut into parts and slices and further hubs are drawn; and two
        # groups whose members are linked inside, close but not linked across, but for one bridge.
        monkeypatch.setattr(near, "BLOCK", block)
        rng = random.Random(9)
        one = prose(rng, 120).split()
        other = one[:96] + prose(rng, 24).split()
        more = []
        for k, base in enumerate((one, other, one[:110] + prose(rng, 10).split())):
            for i in range(12):
                at = 40 + rng.randrange(3)
                more.append((1000 + 100 * k + i, " ".join(base[:at] + [f"x{k}y{i}"] + base[at + 1:]), "en", "s1", 0))
        extra = spark.createDataFrame(more, DOCS).withColumns({c: F.lit(1) for c in frame.columns[5:]})
        frame, rows = frame.unionByName(extra).repartition(3), rows + more
    found = {i: sets(t) for i, t, *_ in rows if i is not None}
    root = {i: i for i in found}
    for _ in range(5):
        for a in found:
            for b in found:
                both = len(found[a] & found[b])
                if both and 100 * both >= 75 * len(found[a] | found[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = near.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(found[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)
    assert near.near_duplicates(empty).count() == 0


def test_line_dedup_against_a_dictionary(corpus, empty):
    frame, rows = corpus
    key = lambda line: line.strip(" \t\n\v\f\r").lower()
    held = defaultdict(set)
    for i, t, *_ in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 10:
                    held[key(line)].add(i)
    want = {}
    for i, t, *_ in rows:
        every = (t or "").split("\n")
        kept = every if i is None else [x for x in every if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        want[i] = (len(every), len(every) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    got = lines.dedup_lines(frame).collect()
    assert len(got) == len(rows) and all((r.n_lines, r.n_dropped, r.kept_sha256) == want[r.doc_id] for r in got)
    assert lines.dedup_lines(empty).count() == 0


def test_perfect_hash_is_minimal_and_survives_its_bytes():
    draw = np.random.default_rng(1).integers(0, 2**63, (2, 5000)).astype(np.uint64)
    index = lines.PerfectHash.load(lines.PerfectHash(*draw).dump()).index(*draw)
    assert sorted(index.tolist()) == list(range(5000))
    assert lines.PerfectHash(draw[0, :0], draw[1, :0]).index(*draw[:, :3]).tolist() == [-1, -1, -1]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 16))
    group = base[0] + 0.02 * rng.standard_normal((300, 16))
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(base)] + [(100 + i, v.tolist(), 0) for i, v in enumerate(group)]
    rows += [(900, base[1].tolist(), 1), (901, (2 * base[1]).tolist(), 1), (902, base[1].tolist(), None), (903, None, 1), (904, [], 1),
             (905, [0.0] * 16, 1), (906, [float("nan")] * 16, 1), (907, [None] * 16, 1), (908, base[1][:8].tolist(), 1),
             (909, [float("inf")] * 16, 1)]
    good = {i: (np.array(v), label) for i, v, label in rows if i < 902 or i == 908}
    links = {i: set() for i, *_ in rows}
    for a, (x, p) in good.items():
        for b, (y, q) in good.items():
            if a < b and p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links[a].add(b), links[b].add(a)
    root = {i: i for i in links}
    for _ in range(5):
        for a in links:
            root[a] = min([root[a], *(root[b] for b in links[a])])
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    got = vectors.near_vectors(table).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (len(links[i]), root[i], root[i] == i) for i in links}
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_shards_are_even_and_keep_equal_texts_together(spark, corpus, empty):
    frame, rows = corpus
    got = sharding.balanced_shards(frame, shards=4).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    texts = {i: t or "" for i, t, *_ in rows if i is not None}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
               for r in got if r.doc_id is not None)
    assert len({r.shard for r in got if r.doc_id in (3, 50, 51)}) == 1
    assert sharding.balanced_shards(empty).count() == 0
    hot = spark.range(400).selectExpr("id as doc_id", "if(id < 200, 'same', cast(id as string)) as text")
    spread = Counter(r.shard for r in sharding.balanced_shards(hot, shards=4).collect() if r.doc_id < 200)
    assert len(spread) <= 3


def test_groups_that_fit_into_a_shard_stay_whole(spark):
    def spread(sizes, rows, shards):
        bodies = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)]
        bodies += [f"single {i}" for i in range(rows - len(bodies))]
        frame = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
        got = sharding.balanced_shards(frame, shards=shards).collect()
        assert sorted(Counter(r.shard for r in got).values()) == [rows // shards] * shards
        found = defaultdict(set)
        for r in got:
            found[bodies[r.doc_id]].add(r.shard)
        return [len(found[f"group {g}"]) for g in range(len(sizes))]

    assert spread([90, 60, 60, 40, 26], 400, 4) == [1] * 5
    assert spread([150, 90], 400, 4) == [2, 1]
    assert spread([3, 4, 2, 4], 16, 4) == [1] * 4


def test_mix_meets_its_budgets(corpus, empty):
    frame, rows = corpus
    got = mixing.mix(frame).collect()
    size = Counter()
    for _, t, _, s, _ in rows:
        size[s] += len((t or "").split())
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size and r.source_size == size[r.source]
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in size)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    words = Counter()
    for r in mixing.mixed_documents(frame).collect():
        words[r.source] += len(r.text.split())
    assert words == +taken
    assert mixing.mix(empty).count() == 0


def test_leaks_are_found_and_clean_texts_left(spark, corpus):
    frame, rows = corpus
    rng = random.Random(9)
    items = [(i, prose(rng, n, 3000) + ".") for i, n in enumerate([30, 45, 150, 3])] + [(8, None), (9, ""), (None, "a b c d e f")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    dirty = [(500 + i, prose(rng, 333) + " " + t.upper().replace("W", "w") + " " + prose(rng, 90)) for i, t in items[:3]]
    table = frame.select("doc_id", "text").union(spark.createDataFrame(dirty, "doc_id bigint, text string"))
    got = {(r.doc_id, r.item_id) for r in contamination.contaminated(table, bench).collect()}
    assert got == {(500, 0), (501, 1), (502, 2)}
    left = contamination.without_leaks(table, bench)
    assert left.count() == len(rows) and left.where("doc_id >= 500").count() == 0
    assert contamination.contaminated(table, bench.limit(0)).count() == 0
    assert contamination.contaminated(table.limit(0), bench).count() == 0


def test_wand_finds_what_scoring_every_unit_finds(spark):
    rng = random.Random(2)
    bench = spark.createDataFrame([(i, prose(rng, 40, 200)) for i in range(150)], "item_id bigint, text string")
    index = next(contamination.indexes(bench, "item_id", "text"))
    for _ in range(20):
        numbers = index.lists(word_hashes(prose(rng, 60, 200).encode()))
        terms = np.unique(numbers[numbers >= 0])
        score = np.zeros(150)
        for t in terms:
            span = slice(*index.block_postings[index.block_starts[[t, t + 1]]])
            score[index.units[span]] += index.impacts[span]
        found = dict(contamination.wand(index, terms, 0.3))
        assert set(found) == set(np.nonzero(score >= 0.3)[0].tolist())


def test_compact_windows_against_all_subsequences():
    rng = np.random.default_rng(4)
    for least in (3, 5):
        h = rng.integers(1, 40, 60).astype(np.uint64)
        h[[0, 25, 59]] = 0
        want = {}
        for i in range(60):
            for j in range(i + least, 61):
                if (h[i:j] > 0).all():
                    c = i + int(h[i:j].argmin())
                    low, high = want.get(c, (i, j - 1))
                    want[c] = (min(low, i), max(high, j - 1))
        found = passages.compact_windows(h, least)
        assert {c: (a, b) for a, c, b in zip(*(x.tolist() for x in found))} == want


def test_repeated_passages(corpus, empty):
    frame, rows = corpus
    got = passages.repeated_passages(frame).collect()
    texts = {i: (t or "").lower().split() for i, t, *_ in rows if i is not None}
    for r in got:
        mine = texts[r.doc_id][r.start_word:r.end_word]
        assert len(mine) >= 50 and r.other_id < r.doc_id and r.similarity >= 0.75
    assert {111, 112, 113} <= {r.doc_id for r in got if r.other_id >= 110 and r.end_word - r.start_word >= 60}
    assert set(range(61, 90)) <= {r.doc_id for r in got}
    assert not {r.doc_id for r in got} & (set(range(40)) | {100, 101, 102, 103, 104, 110, 120})
    assert passages.repeated_passages(empty).count() == 0


def test_passages_behind_a_hub_that_holds_less(spark):
    """The first document under the keys holds 49 of 50 words; the passage in full is in the two after it."""
    rng = random.Random(11)
    rows, late = [], []
    for i in range(0, 120, 4):
        shared = prose(rng, 50)
        edited = shared.split()
        edited[7] = edited[40] = "other"
        first = shared.rsplit(" ", 1)[0] if i % 8 else " ".join(edited)
        bodies = [first, shared, shared]
        rows += [(i + j, f"{prose(rng, 60)} {body} {prose(rng, 60)}") for j, body in enumerate(bodies)]
        late.append(i + 2)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.other_id, r.doc_id) for r in passages.repeated_passages(frame).collect()}
    assert got == {(i - 1, i) for i in late}
    # A member that shares a passage with the hub is compared with those that do not.
    rows, wanted = [], set()
    for i in range(0, 120, 4):
        one, two, three = prose(rng, 30), prose(rng, 30), prose(rng, 30)
        rows += [(i, f"{prose(rng, 40)} {one} {two} {prose(rng, 40)}"), (i + 1, f"{prose(rng, 40)} {one} {two} {three} {prose(rng, 40)}"),
                 (i + 2, f"{prose(rng, 40)} {two} {three} {prose(rng, 40)}")]
        wanted |= {(i, i + 1), (i + 1, i + 2)}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.other_id, r.doc_id) for r in passages.repeated_passages(frame).collect()} == wanted


def test_passages_go_on_beside_the_diagonal_of_a_meeting():
    """Read from one side's diagonal only, a word inserted, deleted or replaced in mid-passage hides no part of it."""
    rng = np.random.default_rng(6)
    for edit in ("insert", "delete", "replace"):
        shared = rng.integers(1, 2**62, 60).astype(np.uint64)
        other = {"insert": np.insert(shared, 30, 7), "delete": np.delete(shared, 30),
                 "replace": np.concatenate([shared[:30], [np.uint64(7)], shared[31:]])}[edit].astype(np.uint64)
        a, b = (shingle_sequence(np.concatenate([rng.integers(1, 2**62, 40).astype(np.uint64), body,
                                                 rng.integers(1, 2**62, 40).astype(np.uint64)])) for body in (shared, other))
        for diagonal in (0, len(other) - len(shared)):
            (passage,) = passages.shared_passages(a, b, [diagonal])
            assert passage[:4] == (40, 96, 40, 36 + len(b) - len(a) + 60) and passage[4] >= 0.75


def test_one_word_repeated_makes_few_windows_and_hides_no_repeat(spark):
    """Each place of a repeated word had windows, compared in all pairs; its ends stand for them, and no repeated word is missed."""
    rng = random.Random(8)
    joints = [prose(rng, 30) for _ in range(3)]
    rows = []
    for i in range(24):
        le, at = rng.choice([20, 40, 60, 90, 130]), rng.choice([20, 40, 60, 90, 130])
        rows.append((i, " ".join([prose(rng, rng.randrange(40)), rng.choice(joints), "le " * le + "at " * at, rng.choice(joints), prose(rng, rng.randrange(40))])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert passages.keyed_windows(frame, "doc_id", "text").count() < 40 * len(rows)
    covered = defaultdict(set)
    for r in passages.repeated_passages(frame).collect():
        covered[r.doc_id] |= set(range(r.start_word, r.end_word))
    seen = set()
    for i, text in rows:
        words = text.split()
        spans = [tuple(words[k:k + 50]) for k in range(len(words) - 49)]
        assert {k + j for k, span in enumerate(spans) if span in seen for j in range(50)} <= covered[i]
        seen |= set(spans)


def test_views_hold_no_passage_beyond_their_texts():
    """What is beyond both texts equals nothing, and views whose runs lie apart hold no passage that may go on."""
    rng = np.random.default_rng(9)
    width = 2 * passages.VIEW + 1
    one, other = (rng.integers(1, 2**31, width).astype(np.uint32) | np.uint32(1) for _ in range(2))
    many = np.stack([other, other, one, other])
    many[0, passages.VIEW - 5:] = one[passages.VIEW - 5:]
    many[1, passages.VIEW - 5:passages.VIEW + 5] = one[passages.VIEW - 5:passages.VIEW + 5]
    many[1, :30], many[1, -30:] = one[:30], one[-30:]
    sure, maybe = passages._alike_around(one, many, passages.PERCENT)
    assert sure.tolist() == [True, False, True, False] and not maybe.any()
    short = one.copy()
    short[passages.VIEW + 41:] = 0
    many = np.where(np.arange(width) < passages.VIEW - 3, other, short)[None, :]
    sure, maybe = passages._alike_around(short, many, passages.PERCENT)
    assert not sure.any() and not maybe.any()


def test_passages_inside_a_chain_that_is_too_weak():
    """A stretch with few edits was lost in a longer chain with many, unless it had none."""
    rng = np.random.default_rng(12)
    a = rng.integers(1, 2**62, 240).astype(np.uint64)
    b = a.copy()
    b[[70, *range(100, 240, 8)]] = rng.integers(1, 2**62, 19).astype(np.uint64)
    one, two = shingle_sequence(a), shingle_sequence(b)
    (passage,) = passages.shared_passages(one[40:], two[40:], [0])
    assert passage[0] == passage[2] == 0 and passage[1] == passage[3] >= 56 and passage[4] >= 0.75
    assert passages.shared_passages(one, one.copy(), [-3, 0]) == [(0, len(one), 0, len(one), 1.0)]


def test_views_of_much_edited_copies_leave_nothing_open():
    """A word edited in eight: the views went on to their ends, so all pairs of such copies were compared on their texts."""
    rng = np.random.default_rng(13)
    text, views = rng.integers(1, 2**62, 300).astype(np.uint64), []
    for i in range(12):
        words = text.copy()
        # The centre and its shingle stay; the first two copies have no edits near it.
        at = np.setdiff1d(np.arange(i % 8, 300, 8), np.arange(150 - 40 * (i < 2), 155 + 40 * (i < 2)))
        words[at] = rng.integers(1, 2**62, len(at))
        views.append((shingle_sequence(words)[150 - passages.VIEW:151 + passages.VIEW] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))
    views = np.stack(views)
    found = [passages._alike_around(v, views, passages.PERCENT) for v in views]
    assert not any(maybe.any() for _, maybe in found)
    assert [sure.sum() for sure, _ in found] == [2, 2] + [1] * 10


def test_groups_of_views_are_compared_as_pair_by_pair():
    rng = np.random.default_rng(14)
    width, keys, rows = 2 * passages.VIEW + 1, [], []
    for group, size in enumerate((1, 3, 40, 2, 30)):
        base = rng.integers(1, 2**31, (3, width)).astype(np.uint32)
        for side in (0, 1):
            for doc in range(side, size + 1):
                view = base[doc % 3].copy()
                view[rng.integers(0, width, rng.integers(0, 30))] = rng.integers(1, 2**31)
                view[passages.VIEW] = 5
                keys.append((group, 0, 0))
                rows.append((side, doc, view))
    side, doc = (np.array([r[c] for r in rows]) for c in (0, 1))
    views, group = np.stack([r[2] for r in rows]), np.array([k[0] for k in keys])
    starts = np.searchsorted(group, np.arange(5))
    ends = np.append(starts[1:], len(rows))
    middles = np.array([s + int((side[s:e] == 0).sum()) for s, e in zip(starts, ends, strict=True)])
    want = set()
    for s, m, e in zip(starts, middles, ends, strict=True):
        for j in range(m, e):
            for i in range(s, m):
                sure, maybe = passages._alike_around(views[i], views[j:j + 1], passages.PERCENT)
                if doc[i] < doc[j] and (sure[0] or maybe[0]):
                    want.add((i, j))
                if doc[i] < doc[j] and sure[0]:
                    break
    i, j = passages._partners_of_groups(views, doc, starts, middles, ends, passages.PERCENT)
    assert len(want) > 50 and len(i) == len(want) and set(zip(i.tolist(), j.tolist(), strict=True)) == want
    table = pa.record_batch({c: pa.array([k[x] for k in keys], pa.int64()) for x, c in enumerate("abc")})
    parts = list(passages._whole_groups(iter([table.slice(k, 17) for k in range(0, table.num_rows, 17)]), 3))
    assert pa.Table.from_batches(parts).to_pylist() == table.to_pylist()
    held = [set(p.column(0).to_pylist()) for p in parts]
    assert sum(map(len, held)) == len(set().union(*held)) == 5


def test_quality_sample_does_not_depend_on_partitioning(spark):
    rows = [(i % 5, f"a text of number {i} " * (1 + i % 7)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)] + [(1, 0)], "doc_id long, quality int")
    one, two = (quality.labelled(docs.repartition(n, "text"), labels, "doc_id", "text", "quality", F.lit(True), 50) for n in (1, 7))
    assert len(one[1]) == 50 and np.array_equal(one[0], two[0]) and np.array_equal(one[1], two[1])


def test_secrets_keep_the_patterns_and_add_the_field(spark, empty):
    rng = random.Random(1)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [f"{prose(rng, 30)} API_KEY = '{hexes(32)}' {prose(rng, 20)}" for _ in range(40)]
    texts += [prose(rng, 50) for _ in range(40)] + [None, "", "passwd: abc", "password=abc token:abcdef", "AKIA" + "A" * 16, hexes(23), "é " + hexes(24)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in secrets.digest(secrets.find_secrets(frame)).collect()}
    for i, t in enumerate(texts):
        assert got[i].base_sha256 == secrets.checksum(secrets.base_spans(t or ""))
    assert [got[i].n_assign for i in range(82, 84)] == [0, 1] and got[84].n_access == 1
    assert (got[85].n_hex, got[86].n_hex, got[86].spans) == (0, 1, "hex:2:26")
    assert got[0].n_assign == 1 and got[0].n_hex == 1 and got[80].spans == ""
    assert secrets.find_secrets(empty).count() == 0


def test_field_decodes_parts_as_it_decodes_the_whole():
    rng = random.Random(8)
    texts = [f"{prose(rng, 30)} token = {rng.getrandbits(120):030x} {prose(rng, 20)}" for _ in range(60)] + [prose(rng, 40) for _ in range(60)]
    field = secrets.fit(texts)
    for _ in range(30):
        text = f"{prose(rng, 20)} key {rng.getrandbits(110):028x} {prose(rng, 5)} secret token {prose(rng, 5)}"
        tokens, places = secrets._TOKEN.findall(text), [m.span() for m in secrets._TOKEN.finditer(text)]
        whole = secrets.file_features(text, tokens)
        tags = field.decode([secrets.features_at(tokens, i, whole) for i in range(len(tokens))])
        inside = [p for p, t in zip(places, tags) if t != secrets.OUTSIDE]
        spans = secrets.added_spans(text, field, [])
        assert [p for p in places if any(a <= p[0] and p[1] <= b for a, b in spans)] == inside


def test_quality_learns_rules_and_scores_everything(spark, empty):
    rng = random.Random(6)
    rows = [(i, prose(rng, 60) if i % 3 else " ".join(w.upper() + "!!" for w in prose(rng, 60).split()), int(i % 3 > 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(700, None), (701, ""), (None, "a b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    truth = {i: y for i, _, y in rows}
    assert all(int(r.score >= 0.5) == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert quality.quality(empty, labels).count() == 0
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}


def test_languages_learn_every_label_from_whole_texts(spark):
    """300 languages; one row in many texts under one doc_id; windows of long texts from all parts."""
    body = "".join(f"{i:06d} " for i in range(20_000))
    rows = [(i, f"text {i}", f"l{i % 300:03d}") for i in range(600)] + [(7, f"many {i}", "aa") for i in range(3_000)]
    rows += [(1000 + i, body, "long") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    texts, found = language.training_rows(docs, "doc_id", "text", "lang", F.lit(True), 30)
    counts = {name: found.count(name) for name in set(found)}
    assert len(counts) == 302 and counts["aa"] == counts["long"] == 30 and all(counts[f"l{i:03d}"] == 2 for i in range(300))
    assert max(map(len, texts)) == language.WINDOWS * language.WINDOW
    numbers = [int(w) for t, name in zip(texts, found) if name == "long" for w in t[:250].split()[1:3]]
    assert {n // 5_000 for n in numbers} == {0} and max(numbers) > 2_000
    last = [int(t[-250:].split()[1]) for t, name in zip(texts, found) if name == "long" and len(t) == 1024]
    assert min(last) >= 15_000 - 40
    again = language.training_rows(docs.repartition(3), "doc_id", "text", "lang", F.lit(True), 30)
    assert again == (texts, found)
    # Bounds: texts in all are shared by the languages; of more languages than wanted the most frequent stay.
    assert len(language.training_rows(docs, "doc_id", "text", "lang", F.lit(True), 30, texts=302)[0]) == 302
    assert set(language.training_rows(docs, "doc_id", "text", "lang", F.lit(True), 30, most=2)[1]) == {"aa", "long"}


def test_language_accuracy_on_held_out_rows(spark, empty):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.languages(frame).join(frame.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.97
    network = language.learn_languages(frame, sample=20)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (4, "x")], "doc_id bigint, text string")
    named = {r.doc_id: r.lang_pred for r in language.predict_languages(odd, network).collect()}
    assert [named[i] for i in (1, 2, 3)] == ["und"] * 3 and named[4] != "und"
    assert language.languages(empty).count() == 0


def test_network_gradients_against_differences():
    net = language.Network.new(["a", "b"])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, y = np.random.default_rng(0).integers(1, 255, (3, language.WINDOW)).astype(np.uint8), np.array([0, 1, 1])
    loss = lambda: net.log_probabilities(x)[np.arange(3), y].mean()
    for name, g in net.gradients(x, y).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before = net.weights[name][at]
        net.weights[name][at] = before + 1e-6
        up = loss()
        net.weights[name][at] = before - 1e-6
        down = loss()
        net.weights[name][at] = before
        assert g[at] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-7)


def test_shingles_are_one_sequence_in_short_texts():
    assert len(shingle_sequence(word_hashes(b"a b c"))) == 1 and len(shingle_sequence(word_hashes(b""))) == 0
    assert (word_hashes(b"A\x0bB") == word_hashes(b"a b")).all()


def test_pipeline_stages_keep_columns_and_rows(spark, corpus, empty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        for frame in (docs, corpus[0].select("doc_id", "text", "lang", "source", "n_chars"), empty):
            out = stage(spark, frame, "/root/testdata/sf0.001")
            assert out.columns == frame.columns
            assert frame is not empty or out.count() == 0, name
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_pipeline_stages_on_odd_rows(spark):
    """No language given, one doc_id with two texts, equal texts without key from two sources, names like internal ones."""
    rng = random.Random(2)
    one, two, three = (prose(rng, 60) for _ in range(3))
    rows = [(1, one, None, "a", 0), (1, two, None, "a", 0), (1, one, None, "a", 0), (2, three, None, "b", 0), (3, "12 34 !", None, "b", 0),
            (4, None, None, "b", 0), (None, one, None, "a", 0), (None, one, None, "b", 0)]
    odd = ["_guess", "_language", "_share", "_gone", "_id", "_print", "_size", "_taken", "_text", "_doc_print", "row", "guess", "turn", "body"]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in odd}).repartition(3)

    def out(stage, frame):
        got = stage(spark, frame, "/root/testdata/sf0.001")
        assert got.columns == frame.columns
        got = got.collect()
        assert all(r[c] == c for r in got for c in odd)
        return sorted(((r.doc_id, r.text, r.lang, r.source) for r in got), key=str)

    letters = [r[:4] for r in rows if r[0] not in (3, 4)]
    assert out(corpus_pipeline.language_id, docs) == sorted(letters, key=str)
    some = docs.withColumn("lang", F.expr("case when doc_id = 2 then 'en' end"))
    assert {r[2] for r in out(corpus_pipeline.language_id, some)} == {"en"}
    deduped = out(corpus_pipeline.near_dedup, docs)
    assert deduped == sorted([r[:4] for r in rows[:2] + rows[3:]], key=str)
    mixed = out(corpus_pipeline.mixing, docs)
    assert {r[3] for r in mixed if r[0] is None} == {"a", "b"} and all(len(r[1].split()) <= 60 for r in mixed)
    words = Counter()
    for r in mixed:
        words[r[3]] += len(r[1].split())
    taken = {r.source: r.taken for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    assert dict(words) == taken


@pytest.mark.parametrize("name", ["op4_line_dedup", "op7_mixing"])
def test_query_matches_check_sql(spark, name):
    from clickloom.llm.oracle import SQL
    from clickloom.llm.queries import queries
    from registry.compare import compare, connect

    sf_dir = "/root/testdata/sf0.001"
    assert compare(queries()[name](spark, sf_dir), connect(sf_dir), SQL[name]) == "ok"
