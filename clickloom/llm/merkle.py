"""A Merkle manifest of a dataset, kept as a postorder append log.

Every row is a leaf; 16 consecutive nodes become one, tree by tree (one per source), and the trees' roots
become the leaves of the top tree.  A builder takes an aligned run of WIDTH**DEPTH nodes in order and appends
each node to the log the moment its last child is there, so it holds one open run per level and no more.  The
place of any node in its tree's log follows from the sizes of the subtrees before it, in closed form
(`postorder`); proofs are read off the log by such places, without pointers and without building the tree again.

Trees of any size are built in tiers of DEPTH levels: the runs that the builders of one tier complete are the
leaves of the next.  One source with most of the rows is many builders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.spread import prefix_sums
from clickloom.session import write_down

WIDTH = 16
# Levels a builder completes: its run is WIDTH**DEPTH nodes, 4,096 digests of 64 bytes.
DEPTH = 3
TOP = "top"

LOG = "tree string, pos long, level int, idx long, digest string"


def digest_of(parts: list[str]) -> str:
    """Lowercase hex sha256 over the concatenated parts."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def level_sizes(n: int) -> list[int]:
    """The number of nodes on each level of a tree over n leaves, up to its root."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // WIDTH))
    return sizes


def postorder(sizes: list[int], level: int, idx: int) -> int:
    """The place of node `idx` of `level` in the completion order of its tree, from 0.

    Nodes are completed in order of (last leaf, level).  With the node's last leaf as number `end` from 1,
    the subtrees before it hold end // WIDTH**g complete nodes of each level g at or below its own; of the
    levels above, the nodes that ended earlier.  The tree's end completes every level.
    """
    n, end = sizes[0], min((idx + 1) * WIDTH**level, sizes[0])
    before = idx
    for g, held in enumerate(sizes):
        if g < level:
            before += held if end == n else end // WIDTH**g
        elif g > level:
            before += (end - 1) // WIDTH**g
    return before


def field(value: Column) -> Column:
    """A leaf's part for one value: '-' for null, else its length in UTF-8 bytes, ':' and the value."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _tree(source: Column) -> Column:
    """A tree's name: 's' and the source, or '-' for the rows without one."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("-"))


def _blocks(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(tree, block, n): every builder's run with the number of leaves of its tree; a join of runs, not of rows."""
    return nodes.select("tree", "block").distinct().join(sizes, "tree")


def _streams(frame: DataFrame, order: list[str]) -> DataFrame:
    """Rows with equal (tree, block) one after another, in `order`."""
    return frame.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def _build(nodes: DataFrame, sizes: DataFrame, tier: int) -> DataFrame:
    """LOG rows that the builders of a tier complete over (tree, idx, digest), in completion order; tier 0 logs its leaves too."""
    base = tier * DEPTH
    nodes = nodes.withColumn("block", F.expr(f"idx div {WIDTH**DEPTH}"))
    heads = _blocks(nodes, sizes).select("tree", "block", F.lit(-1).cast("long").alias("idx"), F.col("n").cast("string").alias("said"))
    rows = _streams(heads.unionByName(nodes.select("tree", "block", "idx", F.col("digest").alias("said"))), ["idx"])
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sizes, open_, out = None, [], {}, []

        def add(level: int, idx: int, digest: str) -> None:
            """Append a node; the last child of a run completes the node above, within this builder's levels."""
            if level > base or tier == 0:
                out.append((tree, postorder(sizes, level, idx), level, idx, digest))
            if level + 1 < len(sizes) and level - base < DEPTH:
                held = open_.setdefault(level, [])
                held.append(digest)
                if idx % WIDTH == WIDTH - 1 or idx == sizes[level] - 1:
                    add(level + 1, idx // WIDTH, digest_of(open_.pop(level)))

        for batch in batches:
            for name, idx, said in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                if idx < 0:
                    tree, sizes, open_ = name, level_sizes(int(said)), {}
                else:
                    add(base, idx, said)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
                out = []

    return rows.mapInArrow(run, LOG)


def build_log(leaves: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The log of every tree over leaves (tree, idx, digest), the trees' sizes (tree, n), and the number of tiers.

    idx counts the leaves of a tree from 0 without gaps.  Only the number of unfinished trees reaches the driver.
    """
    sizes = write_down(leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n")))
    log, nodes, tier = write_down(_build(leaves, sizes, 0)), None, 0
    while True:
        reach = WIDTH ** ((tier + 1) * DEPTH)
        tall = sizes.where(F.col("n") > reach)
        if not tall.head(1):
            return log, sizes, tier + 1
        tier += 1
        nodes = log.where(F.col("level") == tier * DEPTH).join(tall, "tree", "left_semi").select("tree", "idx", "digest")
        log = log.unionByName(write_down(_build(nodes, tall, tier)))


def _fold(digest: str, path: list[tuple[list[str], list[str]]]) -> str:
    for left, right in path:
        digest = digest_of([*left, digest, *right])
    return digest


def _read_off(log: DataFrame, sizes: DataFrame, above: DataFrame, tier: int, asked: DataFrame | None = None,
              with_proof: bool = False) -> DataFrame:
    """The way from each node of a tier's lowest level to the root: (tree, block, path), block the node's number, or one row
    per asked leaf (doc_id, tree, idx, digest, altered) if `asked` is given.

    above: (tree, block, path) with what the levels above the run add.  A path is text: one level after another with
    '\\n', left and right siblings with '|', digests with ','.  The nodes of a run lie in one stretch of the log,
    found by `postorder`; a run's stretch, its path and its leaves meet in one task.
    """
    base, run_size = tier * DEPTH, WIDTH**DEPTH
    tall = sizes.where(F.col("n") > WIDTH**base) if tier else sizes
    inside = log.where((F.col("level") >= base) & (F.col("level") < base + DEPTH)).join(tall.select("tree"), "tree", "left_semi")
    block = F.expr(f"idx div cast(pow({WIDTH}, {base + DEPTH} - level) as long)")
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("long")
    heads = (above.join(sizes, "tree").select("tree", "block", F.lit(0).alias("role"), F.lit(-1).cast("long").alias("at"), nothing.alias("doc_id"),
                                              F.col("n").cast("string").alias("said"), F.col("path").alias("more")))
    nodes = inside.select("tree", block.alias("block"), F.lit(1).alias("role"), F.col("pos").alias("at"), nothing.alias("doc_id"),
                          F.col("digest").alias("said"), none.alias("more"))
    rows = heads.unionByName(nodes)
    if asked is not None:
        rows = rows.unionByName(asked.select("tree", F.expr(f"idx div {run_size}").alias("block"), F.lit(2).alias("role"), F.col("idx").alias("at"),
                                             "doc_id", F.col("digest").alias("said"), F.col("altered").alias("more")))
    rows = _streams(rows, ["role", "at"]).select("tree", "block", "role", "at", "doc_id", "said", "more")
    if asked is None:
        kinds = [("tree", pa.string()), ("block", pa.int64()), ("path", pa.string())]
        sql = "tree string, block long, path string"
    else:
        kinds = [("doc_id", pa.int64()), ("tree", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                 ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("proof", pa.string())]
        sql = "doc_id long, tree string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, proof string"
    schema, by_leaf = pa.schema(kinds), asked is not None

    def text_of(path: list[tuple[list[str], list[str]]]) -> str:
        return "\n".join(f"{','.join(left)}|{','.join(right)}" for left, right in path)

    def path_of(text: str) -> list[tuple[list[str], list[str]]]:
        sides = (level.split("|") for level in text.split("\n") if level)
        return [tuple([d for d in side.split(",") if d] for side in pair) for pair in sides]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, number, sizes, held, up, out = None, 0, [], {}, [], []

        def siblings(idx: int) -> list[tuple[list[str], list[str]]]:
            """The other members of the node's run on each of this tier's levels, addressed by their places."""
            path = []
            for level in range(base, min(base + DEPTH, len(sizes) - 1)):
                first = idx // WIDTH * WIDTH
                places = [held[postorder(sizes, level, i)] for i in range(first, min(first + WIDTH, sizes[level])) if i != idx]
                path.append((places[: idx - first], places[idx - first:]))
                idx //= WIDTH
            return path + up

        def finish() -> None:
            """Unless leaves are asked for, every lowest node of the run gets its path."""
            if not by_leaf and tree is not None:
                for idx in range(number * run_size, min((number + 1) * run_size, sizes[base])):
                    out.append((tree, idx, text_of(siblings(idx))))

        def emit() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for name, block, role, at, doc, said, more in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                if role == 0:
                    finish()
                    tree, number, sizes, held, up = name, block, level_sizes(int(said)), {}, path_of(more)
                elif role == 1:
                    held[at] = said
                else:
                    path, height = siblings(at), len(sizes) - 1
                    proof = [d for left, right in path for d in left + right]
                    subroot = _fold(said, path[:height])
                    root = _fold(subroot, path[height:])
                    out.append((doc, tree, said, subroot, root, digest_of(proof), root if more == said else _fold(more, path),
                                ",".join(proof) if with_proof else None))
            if out:
                yield emit()
        finish()
        if out:
            yield emit()

    return rows.mapInArrow(run, sql)


def _paths(log: DataFrame, sizes: DataFrame, tiers: int, above: DataFrame) -> DataFrame:
    """(tree, block, path) for every run of the lowest tier; above: (tree, path) with what the trees' roots still need."""
    ways = None
    for tier in range(tiers - 1, -1, -1):
        # Trees that end in this tier have one run there.
        low, high = WIDTH ** (tier * DEPTH), WIDTH ** ((tier + 1) * DEPTH)
        ending = sizes.where((F.col("n") <= high) & ((F.col("n") > low) if tier else F.lit(True))).select("tree")
        start = above.join(ending, "tree").select("tree", F.lit(0).cast("long").alias("block"), "path")
        ways = start if ways is None else start.unionByName(ways)
        if tier:
            ways = write_down(_read_off(log, sizes, ways, tier))
    return ways


def ranked_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, tree, idx, digest, altered): leaves in the order of their source, with the digest of the altered text.

    altered: where 5 divides the unsigned crc32 of the decimal doc_id, the text with A-Z lower-cased, else the row as it is.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _tree(F.col("source").cast("string")).alias("tree"),
        leaf_digest(*own, F.col("text")).alias("digest"),
        F.when(chosen, leaf_digest(*own, F.translate("text", upper, lower))).alias("changed"))
    leaves = leaves.select("doc_id", "source", "tree", "digest", F.coalesce("changed", "digest").alias("altered"))
    return prefix_sums(write_down(leaves), ["tree"], [F.col("doc_id"), F.col("digest")], {"idx": F.lit(1).cast("long")})


def manifest(docs: DataFrame) -> DataFrame:
    """The append log of all trees, with the top tree under the name 'top': (tree, pos, level, idx, digest).

    A source's tree is named 's' and the source, '-' for rows without source.  pos counts a tree's nodes from 0 in the
    order in which they are completed; sorted by (tree, pos) the table is the log.  An empty table gives no rows.
    """
    log, _, _ = build_log(write_down(ranked_leaves(docs).select("tree", "idx", "digest")))
    return log.unionByName(_top(log)[0])


def _roots(log: DataFrame) -> DataFrame:
    """(tree, digest) of every tree's root, which is the last node of its log."""
    last = log.groupBy("tree").agg(F.max("pos").alias("pos"))
    return log.join(last, ["tree", "pos"]).select("tree", "digest")


def _top(log: DataFrame) -> tuple[DataFrame, DataFrame, int, DataFrame]:
    """The top tree's log, sizes and tiers, and its leaves (of, idx, digest); the tree without source comes first."""
    roots = write_down(_roots(log))
    placed = write_down(prefix_sums(roots.withColumn("_g", F.lit(TOP)), ["_g"], [F.col("tree") != "-", F.col("tree")], {"idx": F.lit(1).cast("long")}))
    placed = placed.select(F.col("tree").alias("of"), F.col("_g").alias("tree"), "idx", "digest")
    return *build_log(placed.select("tree", "idx", "digest")), placed.drop("tree")


def audit(docs: DataFrame, with_proof: bool = False) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified[, proof]) for every row of docs.

    A leaf is the sha256 of doc_id, source, lang, n_chars and text, each '-' if null.  Per source the leaves ascend by
    doc_id, rows without one last, rows with equal doc_id by their digests; equal rows are leaves of their own, and
    which of them comes first makes no difference.  A source of one row has its leaf as subroot.  folded_root is
    recomputed from the altered leaf (see `ranked_leaves`; an altered text that had no A-Z is the same leaf and
    verifies) and the original siblings.  Null and empty texts, long ones and further columns of any name are handled
    alike; an empty table gives no rows.  with_proof adds the siblings, level by level up to the root, from left to right.
    """
    leaves = write_down(ranked_leaves(docs))
    log, sizes, tiers = build_log(leaves.select("tree", "idx", "digest"))
    top_log, top_sizes, top_tiers, placed = _top(log)
    start = top_sizes.select("tree", F.lit("").alias("path"))
    runs = _paths(top_log, top_sizes, top_tiers, start)
    over = write_down(_read_off(top_log, top_sizes, runs, 0))
    above = placed.join(over, placed["idx"] == over["block"]).select(F.col("of").alias("tree"), "path")
    ways = _paths(log, sizes, tiers, above)
    found = _read_off(log, sizes, ways, 0, leaves.select("tree", "idx", "doc_id", "digest", "altered"), with_proof)
    named = found.withColumn("source", F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")))
    more = [F.when(F.col("proof") != "", F.split("proof", ",")).otherwise(F.array().cast("array<string>")).alias("proof")] if with_proof else []
    return named.select("doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"), *more)
