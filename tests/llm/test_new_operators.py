"""Phrases, the Merkle manifest and license notices: brute force on small tables, edge cases, planted cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm import licenses, merkle, phrases

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("f", "n", "w1", "tree", "idx", "digest", "block", "level", "pos", "print", "hash", "label", "range", "copied", "template")


@pytest.fixture(scope="module")
def corpus(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, one id with two texts, columns named like internal ones."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(11)] + ["Word", "Été", "a\x00b", "x" * 300]

    def prose(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  "]) for _ in range(n))

    rows = [(i, prose(rng.choice([1, 20, 200])), rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", None]), i) for i in range(60)]
    rows += [(100, "", "en", "s1", 0), (101, None, None, None, None), (None, prose(30), "en", "s2", 3), (102, prose(6000), "fr", "s1", 9),
             (103, " \t\n.,;", "en", "lone", 1), (7, "Another Text", "en", "s1", 2), rows[3], rows[3], (104, "hot Pair " * 400, "en", "s1", 1)]
    frame = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in CLASHING})
    return frame.repartition(3), rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def best_phrases(rows, least, top):
    count = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        pieces = [[]]
        word = ""
        for c in lower(text) + "\n":
            if c in " \t.,;:!?\n\v\f\r":
                if word:
                    pieces[-1].append(word)
                word = ""
                if c not in " \t":
                    pieces.append([])
            else:
                word += c
        for piece in pieces:
            for k in (1, 2, 3):
                for i in range(len(piece) - k + 1):
                    count[lang or "und"][tuple(piece[i:i + k])] += 1
    want = []
    for lang, f in count.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = []
        for g, a in f.items():
            if len(g) > 1 and a >= least and not any(
                    len(h) > len(g) and c >= least and 100 * c >= 50 * a and g in (h[:-1], h[1:]) for h, c in f.items()):
                score, _, left, right = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), a, left, right))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(found)[:top], 1):
            want.append((lang, rank, phrase.decode(), a, left, right, n, -score))
    return sorted(want)


def test_words_are_numbered_as_they_stand():
    """Words come from whole blocks of texts at once; blanks and signs between them leave nothing, and no phrase goes over two texts."""
    texts = [b"", b" ", b"One two,one\t\tTWO", b"a\r\nb!? ", b"\xff\xc3\x89 \xc3\x89", b"one"]
    ids, words = phrases.numbered([phrases.spaced(t) for t in texts])
    held = [b"\n" if i < 0 else words[i].as_py() for i in ids.tolist()]
    want = []
    for text in texts:
        for piece in re.split(rb"[.,;:!?\n-\r]", text):
            want += [*(w.lower() for w in re.split(rb"[ \t]+", piece) if w), b"\n"]
    assert held == want and len(set(words.to_pylist())) == len(words)


@pytest.mark.parametrize("least,top", [(3, 2000), (10, 20)])
def test_phrases_against_counting(corpus, empty, spark, monkeypatch, least, top):
    frame, rows = corpus
    monkeypatch.setattr(phrases, "BLOCK", 700)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    # More ranges than words: most ranges start in the middle of a word's phrases.
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = phrases.collocations(frame, least=least, top=top).collect()
        assert phrases.collocations(empty).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got)) == best_phrases(rows, least, top)


def test_scores_beyond_64_bits(spark):
    a, left, right = 9_876_543_210_123, 9_876_543_210_129, 9_999_999_999_999
    df = spark.createDataFrame([(a, left, right), (10, 10, 10)], "a long, l long, r long")
    got = [r[0] for r in df.select(phrases.cut_score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * a * a // (left * right), 1_000_000]


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text))


def audited(rows, width=16):
    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(out[-1][i:i + width]) for i in range(0, len(out[-1]), width)])
        return out

    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top, want = levels([trees[s][-1][0] for s in order]), []
    for place, s in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            chosen = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded, proof = leaf(r, lower(r[1])) if chosen else own, []
            for tree, k in ((trees[s], i), (top, place)):
                for level in tree[:-1]:
                    start = k // width * width
                    run = level[start:start + width]
                    left, right = run[:k - start], run[k - start + 1:]
                    proof += left + right
                    folded = digest([*left, folded, *right])
                    k //= width
            want.append((r[0], own, trees[s][-1][0], top[-1][0], digest(proof), folded, folded == top[-1][0], proof))
    return want


def shown(audit):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.proof) for r in audit.collect()), key=repr)


def test_manifest_against_recursion(corpus, empty):
    frame, rows = corpus
    want = audited(rows)
    assert shown(merkle.audit(frame, with_proof=True)) == sorted(want, key=repr)
    assert any(not w[6] for w in want)
    assert merkle.audit(empty).count() == 0 and merkle.manifest(empty).count() == 0


def test_manifest_of_many_tiers(spark, monkeypatch):
    """Runs of two levels of three, so that trees of 700 rows take four tiers."""
    monkeypatch.setattr(merkle, "WIDTH", 3)
    monkeypatch.setattr(merkle, "DEPTH", 2)
    rows = [(i, f"Text {i}", "en", "big" if i % 3 else f"s{i % 30}", i) for i in range(1000)] + [(5, "x", None, None, None)]
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    assert shown(merkle.audit(frame, with_proof=True)) == sorted(audited(rows, 3), key=repr)
    log = defaultdict(dict)
    for r in merkle.manifest(frame).collect():
        log[r.tree][r.pos] = r
    for nodes in log.values():
        # Children stand before their parent, and every place is taken once.
        at = {(r.level, r.idx): pos for pos, r in nodes.items()}
        assert sorted(nodes) == list(range(len(nodes))) and len(at) == len(nodes)
        assert all(at[level, idx] < at[level + 1, idx // 3] for level, idx in at if (level + 1, idx // 3) in at)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 80, 81, 82])
def test_places_in_closed_form(monkeypatch, n):
    monkeypatch.setattr(merkle, "WIDTH", 3)
    sizes = merkle.level_sizes(n)
    nodes = [(min((i + 1) * 3**level, n), level, i) for level, size in enumerate(sizes) for i in range(size)]
    assert [merkle.postorder(sizes, level, i) for _, level, i in sorted(nodes)] == list(range(len(nodes)))


MIT = next(t for label, t in licenses.TEMPLATES if label == "mit" and len(t) > 200)


def test_base_places_against_a_scan(corpus, empty):
    frame, rows = corpus
    letters = set("0123456789abcdefghijklmnopqrstuvwxyz")
    extra = [(900, "cc by cc by CC-BY", "en", "s", 1), (901, "the MIT license, the mit\nLicense", "en", "s", 1), (902, "xmit license mit licenses", "en", "s", 1),
             (903, "GNU General Public License and apache license", "en", "s", 1)]
    got = licenses.licenses(frame.select("doc_id", "text", "lang", "source", "n_chars").union(frame.sparkSession.createDataFrame(extra, DOCS))).collect()
    want = []
    for r in rows + extra:
        words = "".join(c if c in letters or ord(c) > 127 else " " for c in lower(r[1])).split(" ")
        words = [w for w in words if w]
        at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        want.append((r[0], len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    assert sorted((tuple(r[:6]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert licenses.licenses(empty).count() == 0
    assert len(licenses.licenses(frame).collect()) == len(rows)


def test_planted_notices(spark):
    """Whole notices, notices with words replaced, inserted and left out, and texts that only share words with them."""
    rng = random.Random(4)
    fill = [f"filler{i}" for i in range(400)]

    def around(words):
        return " ".join(rng.sample(fill, 40) + words + rng.sample(fill, 40))

    docs, want = [], {}
    for i, (label, text) in enumerate(licenses.TEMPLATES):
        docs.append((i, around(text.split())))
        want[i] = label
    for i in range(100, 130):
        words = MIT.split()
        at = rng.randrange(10, len(words) - 10)
        if i % 3 == 0:
            words[at] = "else"
        elif i % 3 == 1:
            words[at:at] = ["or", "so"]
        else:
            del words[at]
        docs.append((i, around(words)))
        want[i] = "mit"
    shuffled = MIT.split()
    rng.shuffle(shuffled)
    clean = {200: around(shuffled), 201: around("permission is hereby granted to leave".split()), 202: around(["license"] * 50), 203: "under the terms of"}
    docs += clean.items()
    got = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, label in want.items():
        assert label in got[i].labels.split(","), (i, label, got[i])
    assert all(got[i].labels == "" and got[i].score < licenses.COVERED for i in clean)
    # Of notices that differ in the last word only the one that stands there counts.
    versions = {i: got[i].labels.split(",") for i, (label, _) in enumerate(licenses.TEMPLATES) if label.startswith("gpl")}
    assert all(("gpl-2.0" in found) != ("gpl-3.0" in found) for found in versions.values())
