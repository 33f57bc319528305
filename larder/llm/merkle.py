"""Merkle dataset manifest by bitmap-rank indexing.

Every document is a leaf. The trees (one for each ``group`` value) take their
leaves in the order of ``doc_id``; a leaf's place is found without sorting the
leaves: the ids of a group are a compressed bitmap, kept as the non-zero 64-bit
words that map-side ``bit_or`` merges across tasks, 512 words of ids to a
container. Containers carry a popcount directory (rows before each word), and
directories of 1,024 entries stand above them until a group has one, so a rank
query is: rows before the container, before the word, and the popcount of the
word's lower bits. The query is a join on (group, word), at most 64 ids wide.

The places key slot arrays of 1,024 nodes. Each array is reduced ten levels by
one task, its root takes a slot of the next array, and so on until one node a
group is left; the groups' roots, numbered in their byte order, are reduced in
the same way. Paths come back down with the arrays, so the leaves move three
times (rank, reduce, fold) whatever the height, 110 bytes each, texts never.

Defined results: a null or empty field is hashed as such (``-`` and ``0:``). A
null group is a group of its own and the first. Rows without ``doc_id`` come
first in their group; rows of equal group and id stand in the order of their
leaf hash, so repeated rows are equal neighbouring leaves, each with its own
proof. Words with such rows (more rows than bits) are numbered by a range
shuffle of their distinct (id, leaf) instead of the bitmap. An empty table has
no leaves and an empty result. Columns other than the five hashed ones are
ignored. Very long texts are hashed whole, by the JVM.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.ranking import exclusive_prefix_sums, ordinals
from larder.llm.common import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

WORD_BITS = 6          # ids in a bitmap word: 64
CONTAINER_BITS = 9     # words in a container: 512
DIRECTORY_BITS = 10    # entries in an upper directory: 1,024
SLOT_BITS = 10         # nodes in a slot array: 1,024, reduced ten levels at once

#: The word of rows without an id: below that of the smallest long.
NO_ID = -(1 << 57) - 1

#: A step of a path: the side of the sibling (none, left, right) and its digest.
NONE, LEFT, RIGHT = 0, 1, 2
STEP = 33


# ------------------------------------------------------------------ leaves

def leaf_hash(values: list[Column]) -> Column:
    """Lower-case hex sha256 of the values, each led by its UTF-8 byte count and ``:``; null is ``-``."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def tampered_leaf(docs: DataFrame) -> Column:
    """The leaf after one is added to ``n_chars`` where 7 divides crc32(doc_id); null for rows left alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    return F.when(hit, leaf_hash([more.cast("decimal(38,0)") if f == "n_chars" else F.col(f) for f in FIELDS]))


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """``(tree, doc_id, leaf, claimed)``: digests as 32 bytes; ``claimed`` (hex, null: the leaf) is what is folded."""
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("+"), F.col("lang")))
    return docs.select(*FIELDS).select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_hash([F.col(f) for f in FIELDS])).alias("leaf"),
        F.unhex(claimed if claimed is not None else F.lit(None).cast("string")).alias("claimed"))


# ------------------------------------------------------------------ ranks

def _word() -> Column:
    return F.coalesce(F.shiftright("doc_id", WORD_BITS), F.lit(NO_ID))


def _with_directory(grouped, entry: Column) -> DataFrame:
    """Entries in order, the rows before each (``before``) and in all (``total``)."""
    found = grouped.agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    walked = F.aggregate(
        "entries", F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("before")),
        lambda acc, e: F.struct((acc["total"] + e["rows"]).alias("total"),
                                F.concat(acc["before"], F.array(acc["total"])).alias("before")))
    return found.withColumn("walked", walked).select(
        "tree", "part", "entries", F.col("walked.before").alias("before"), F.col("walked.total").alias("rows"))


def bitmap_index(found: DataFrame) -> DataFrame:
    """The ids of each tree as ``(tree, word, bits, start, n_rows, size)``: rows before the word, in it and in the tree."""
    words = found.groupBy("tree", _word().alias("word")).agg(
        F.bit_or(F.coalesce(F.expr("shiftleft(1L, cast(doc_id & 63 as int))"), F.lit(0))).alias("bits"),
        F.count(F.lit(1)).alias("rows"))
    containers = stage(_with_directory(
        words.groupBy("tree", F.shiftright("word", CONTAINER_BITS).alias("part")),
        F.struct("word", "bits", "rows")), "manifest-containers")
    n_trees = containers.select("tree").distinct().count()
    levels = []
    level = containers
    while level.count() > n_trees:
        # After five directories only the parts -1 and 0 are left: the sixth holds both.
        above = F.shiftright("part", DIRECTORY_BITS) if len(levels) < 5 else F.lit(0).cast("long")
        level = stage(_with_directory(level.select("tree", above.alias("part"), F.col("part").alias("below"), "rows")
                                      .groupBy("tree", "part"), F.struct("below", "rows")), "manifest-directory")
        levels.append(level)
    bases = level.select("tree", "part", F.lit(0).cast("long").alias("base"), F.col("rows").alias("size"))
    for level in reversed(levels):
        opened = level.join(bases, ["tree", "part"]).select(
            "tree", "base", "size", F.inline(F.arrays_zip("entries", "before")))
        bases = opened.select("tree", F.col("entries.below").alias("part"), (F.col("base") + F.col("before")).alias("base"),
                              "size")
    opened = containers.join(bases, ["tree", "part"]).select(
        "tree", "base", "size", F.inline(F.arrays_zip("entries", "before")))
    return opened.select("tree", F.col("entries.word").alias("word"), F.col("entries.bits").alias("bits"),
                         (F.col("base") + F.col("before")).alias("start"), F.col("entries.rows").alias("n_rows"), "size")


def with_places(found: DataFrame) -> DataFrame:
    """``found`` (see ``leaves``) plus ``pos``, its place in the tree from 0, and ``size``, the tree's leaves."""
    index = stage(bitmap_index(found), "manifest-index")
    crowded = F.col("n_rows") != F.bit_count("bits")
    keyed = found.withColumn("word", _word())
    columns = ["tree", "doc_id", "leaf", "claimed", "pos", "size"]
    placed = keyed.join(index.where(~crowded), ["tree", "word"]).withColumn(
        "pos", F.expr("start + bit_count(bits & ~shiftleft(-1L, cast(doc_id & 63 as int)))")).select(*columns)
    repeated = index.where(crowded).select("tree", "word", "start", "size")
    if repeated.isEmpty():
        return placed
    return placed.union(_repeated_places(keyed, repeated).select(*columns))


def _repeated_places(keyed: DataFrame, words: DataFrame) -> DataFrame:
    """Places of rows in words that hold repeated or missing ids: equal rows are one row with a count until the end."""
    rows = keyed.join(words.select("tree", "word"), ["tree", "word"], "left_semi")
    distinct = rows.groupBy("tree", "word", "doc_id", "leaf", "claimed").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col(c).asc_nulls_first() for c in ("tree", "word", "doc_id", "leaf", "claimed")]
    counted = stage(exclusive_prefix_sums(distinct, order, ["n"]), "manifest-repeated")
    firsts = counted.groupBy("tree", "word").agg(F.min("before_n").alias("first"))
    shift = words.join(firsts, ["tree", "word"]).select("tree", "word", "size", (F.col("start") - F.col("first")).alias("shift"))
    return counted.join(shift, ["tree", "word"]).select(
        "tree", "doc_id", "leaf", "claimed", "size",
        F.explode(F.sequence(F.col("shift") + F.col("before_n"), F.col("shift") + F.col("before_n") + F.col("n") - 1)).alias("pos"))


# ------------------------------------------------------------------ nodes

def _hash(*digests: bytes) -> bytes:
    """H over the digests as hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def _reduce(slots: list[bytes], size: int) -> list[list[bytes]]:
    """The levels of one slot array of a level with ``size`` nodes: the array itself first, its root last."""
    levels = [slots]
    for _ in range(min(SLOT_BITS, (size - 1).bit_length())):
        below = levels[-1]
        levels.append([_hash(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def _steps(levels: list[list[bytes]], slot: int) -> bytes:
    """The siblings on the way from ``slot`` to the root of its array."""
    path = []
    for level in levels[:-1]:
        if slot & 1:
            path.append(bytes([LEFT]) + level[slot - 1])
        elif slot + 1 < len(level):
            path.append(bytes([RIGHT]) + level[slot + 1])
        else:
            path.append(bytes([NONE]) * STEP)
        slot >>= 1
    return b"".join(path)


def _fold(digest: bytes, path: bytes) -> bytes:
    for i in range(0, len(path), STEP):
        side, sibling = path[i], path[i + 1:i + STEP]
        digest = _hash(digest) if side == NONE else _hash(sibling, digest) if side == LEFT else _hash(digest, sibling)
    return digest


def _siblings_hash(path: bytes) -> str:
    """H of the siblings, level by level."""
    return _hash(*[path[i + 1:i + STEP] for i in range(0, len(path), STEP) if path[i] != NONE]).hex()


def _slots(table: pa.Table, column: str) -> tuple[list[int], list[bytes]]:
    """The slot of each row, and the array they fill."""
    at = [p & ((1 << SLOT_BITS) - 1) for p in table.column("pos").to_pylist()]
    slots: list[bytes] = [b""] * len(at)
    for i, digest in zip(at, table.column(column).to_pylist()):
        slots[i] = digest
    return at, slots


def _above(column: str = "size") -> Column:
    """Nodes of a tree after one more array level: the size over 1,024, rounded up."""
    return F.shiftright(F.col(column) + ((1 << SLOT_BITS) - 1), SLOT_BITS)


def block_roots(placed: DataFrame) -> DataFrame:
    """``(tree, pos, size, digest)``: the roots of the leaves' slot arrays."""
    def root(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        _, slots = _slots(table, "leaf")
        return pa.table({"tree": table.column("tree")[:1], "pos": pa.array([table.column("block")[0].as_py()], pa.int64()),
                         "size": pa.array([size], pa.int64()), "digest": pa.array([_reduce(slots, size)[-1][0]], pa.binary())})

    keyed = placed.select("tree", "pos", "size", "leaf", F.shiftright("pos", SLOT_BITS).alias("block"))
    roots = keyed.groupBy("tree", "block").applyInArrow(root, "tree string, pos long, size long, digest binary")
    return roots.withColumn("size", _above())


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths ``(tree, pos, path)`` of the nodes to their tree's root, and the roots ``(tree, digest)``.

    One written table a round; a round takes a tree from n nodes to n / 1,024.
    """
    def reduce(table: pa.Table) -> pa.Table:
        at, slots = _slots(table, "digest")
        levels = _reduce(slots, table.column("size")[0].as_py())
        return pa.table({"tree": table.column("tree"), "pos": table.column("pos"), "size": table.column("size"),
                         "path": pa.array([_steps(levels, i) for i in at], pa.binary()),
                         "root": pa.array([levels[-1][0]] * len(at), pa.binary())})

    nodes = stage(nodes, "manifest-nodes")
    rounds = []
    while (nodes.agg(F.max("size")).first()[0] or 0) > 1:
        keyed = nodes.withColumn("block", F.shiftright("pos", SLOT_BITS))
        done = stage(keyed.groupBy("tree", "block").applyInArrow(
            reduce, "tree string, pos long, size long, path binary, root binary"), "manifest-nodes")
        rounds.append(done)
        nodes = done.where(F.col("pos").bitwiseAND((1 << SLOT_BITS) - 1) == 0).select(
            "tree", F.shiftright("pos", SLOT_BITS).alias("pos"), _above().alias("size"), F.col("root").alias("digest"))
    roots = nodes.select("tree", "digest")
    if not rounds:
        return nodes.select("tree", "pos", F.lit(b"").alias("path")), roots
    paths = rounds[-1].select("tree", "pos", "path")
    for below in reversed(rounds[:-1]):
        above = paths.select("tree", F.col("pos").alias("block"), F.col("path").alias("rest"))
        paths = below.withColumn("block", F.shiftright("pos", SLOT_BITS)).join(above, ["tree", "block"]).select(
            "tree", "pos", F.concat("path", "rest").alias("path"))
    return paths, roots


# ------------------------------------------------------------------ manifest

MANIFEST = ("tree string, pos long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean, path binary")


def manifest(docs: DataFrame, claimed: Column | None = None, keep_paths: bool = True) -> DataFrame:
    """Every document's leaf, place, path and roots, and what its ``claimed`` leaf folds to.

    ``claimed`` is a hex leaf column over ``docs`` (null or absent: the leaf
    itself). ``path`` is a sequence of 33-byte steps (side of the sibling, its
    digest), from the leaf over the group's root to the root.
    """
    found = stage(leaves(docs, claimed), "manifest-leaves")
    placed = stage(with_places(found), "manifest-placed")
    paths, subroots = climb(block_roots(placed))
    trees = stage(ordinals(subroots, ["tree"], "pos"), "manifest-trees")
    top = trees.select(F.lit("").alias("tree"), "pos", F.lit(trees.count()).cast("long").alias("size"), "digest")
    top_paths, roots = climb(top)
    root = roots.first()  # one row, of 32 bytes
    whole = F.lit(root["digest"] if root else None).cast("binary")
    # One row a tree.
    trees = trees.join(top_paths.select("pos", F.col("path").alias("last")), "pos").select(
        "tree", F.col("digest").alias("subroot"), "last")
    blocks = paths.join(trees, "tree").select(
        "tree", F.col("pos").alias("block"), F.concat("path", "last").alias("rest"), "subroot", whole.alias("root"))

    def fold(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("proof_sha256", "folded_root", "verified", "path")}
        if left.num_rows:
            rest, subroot, top_root = (right.column(c)[0].as_py() for c in ("rest", "subroot", "root"))
            at, slots = _slots(left, "leaf")
            levels = _reduce(slots, left.column("size")[0].as_py())
            for i, other in zip(at, left.column("claimed").to_pylist()):
                path = _steps(levels, i) + rest
                folded = _fold(other or slots[i], path)
                out["proof_sha256"].append(_siblings_hash(path))
                out["folded_root"].append(folded.hex())
                out["verified"].append(folded == top_root)
                out["path"].append(path if keep_paths else None)
        else:
            subroot = top_root = b""
            slots, at = [], []
        return pa.table({
            "tree": left.column("tree"), "pos": left.column("pos"), "doc_id": left.column("doc_id"),
            "leaf": pa.array([slots[i].hex() for i in at], pa.string()),
            "subroot": pa.array([subroot.hex()] * len(at), pa.string()), "root": pa.array([top_root.hex()] * len(at), pa.string()),
            "proof_sha256": pa.array(out["proof_sha256"], pa.string()), "folded_root": pa.array(out["folded_root"], pa.string()),
            "verified": pa.array(out["verified"], pa.bool_()), "path": pa.array(out["path"], pa.binary())})

    keyed = placed.withColumn("block", F.shiftright("pos", SLOT_BITS))
    done = keyed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(fold, MANIFEST)
    return done.withColumn("lang", F.when(F.col("tree") != "", F.expr("substring(tree, 2)"))).drop("tree")
