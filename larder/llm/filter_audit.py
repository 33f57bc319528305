"""Filter interaction audit by decision diagrams.

Which documents a chain of filters drops at which step depends on their order.
A document is reduced to the mask of the filters it fails, and masks to counts
per part, which Spark does (at most 2^k rows a part for k filters). Each part's
counts become a decision diagram: one level a filter, two branches a node (pass,
fail), equal subdiagrams shared, every node weighted with the documents below
it. Swapping two neighbouring levels changes only these two, so all k! orders
are walked by one adjacent swap each, and the all-pass path of an order reads
off what stays after every step. Nothing is counted again for an order.

Filters of the corpus (words are maximal runs without ASCII white space): A under
100 words, B under 80 % distinct words, C over 10 % capitals, D any of ``#$%&*|``,
E a text equal to that of a smaller doc_id anywhere in the table.

Defined results: a null text is an empty one (and equal to it); a null language
is the part ``''``. Rows without doc_id have no label, pass E and make none
fail it; repeated rows count each and, sharing the smallest id, pass E together.
Of several labels for an id, any 1 counts. An empty table gives no parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage

#: Fixed values of the corpus filters.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
MARKS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"

#: More filters than this have too many orders to list (6! = 720).
MOST_FILTERS = 6

WEIGHTS = ("documents", "good", "toxic")


# ------------------------------------------------------------------ masks

def corpus_failures(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, A, B, C, D, digest)`` of each row: its own failures and its text's sha256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"), F.size(words).cast("long").alias("words"),
        F.size(F.array_distinct(words)).cast("long").alias("distinct"), capitals.cast("long").alias("capitals"))
    return measured.select(
        "doc_id", "part", (F.col("words") < LEAST_WORDS).alias("A"),
        (F.col("distinct") * 100 < F.col("words") * LEAST_DISTINCT).alias("B"),
        (F.col("capitals") * 100 > F.length("text").cast("long") * MOST_CAPITALS).alias("C"),
        F.col("text").rlike(MARKS).alias("D"), F.unhex(F.sha2("text", 256)).alias("digest"))


def with_repeats(found: DataFrame) -> DataFrame:
    """Counts ``(doc_id, part, A, B, C, D, n, E)`` of equal rows; E where a smaller id has the same text.

    The smallest id of a text comes from a map-side minimum, and rows look it
    up under (text, id), so a text that a third of all rows share stays spread.
    """
    smallest = found.groupBy("digest").agg(F.min("doc_id").alias("first")).where(F.col("first").isNotNull()).select(
        F.col("digest").alias("of"), "first")
    counted = found.groupBy("doc_id", "digest", "part", "A", "B", "C", "D").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(smallest, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first")), "left")
    return joined.select("doc_id", "part", "A", "B", "C", "D", "n",
                         (F.col("doc_id").isNotNull() & F.col("first").isNull()).alias("E"))


def with_labels(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``found`` plus ``good`` and ``toxic`` (0 or 1; 0 without a label)."""
    one = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = found.join(one, F.col("doc_id") == F.col("labelled"), "left").drop("labelled")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic")})


def mask_counts(found: DataFrame, filters: Sequence[str], n: Column | None = None) -> DataFrame:
    """``(part, mask, documents, good, toxic)``: bit i of the mask is set where filter i fails."""
    n = F.lit(1) if n is None else n
    mask = sum((F.when(F.col(f), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    return found.groupBy("part", mask.alias("mask")).agg(
        F.sum(n).cast("long").alias("documents"), F.sum(n * F.col("good")).cast("long").alias("good"),
        F.sum(n * F.col("toxic")).cast("long").alias("toxic"))


# ------------------------------------------------------------------ diagrams

class Diagram:
    """A count-weighted decision diagram over ``k`` filters.

    Level i holds its nodes as pairs (pass, fail) of nodes of level i + 1; the
    last level holds the weights. Equal pairs are one node. ``order[i]`` is the
    filter that level i asks for.
    """

    def __init__(self, k: int, counts: dict[int, tuple[int, ...]], zero: tuple[int, ...]):
        self.order = list(range(k))
        self.nodes: list[list[tuple[int, int]]] = [[] for _ in range(k)]
        self.weights: list[list[tuple[int, ...]]] = [[] for _ in range(k + 1)]
        self._known: list[dict] = [{} for _ in range(k + 1)]
        self.root = self._build(0, 0, counts, zero)

    def _build(self, level: int, mask: int, counts: dict, zero: tuple) -> int:
        if level == len(self.order):
            return self._leaf(counts.get(mask, zero))
        low = self._build(level + 1, mask, counts, zero)
        high = self._build(level + 1, mask | 1 << level, counts, zero)
        return self._node(level, low, high)

    def _leaf(self, weight: tuple) -> int:
        known, weights = self._known[-1], self.weights[-1]
        if weight not in known:
            known[weight] = len(weights)
            weights.append(weight)
        return known[weight]

    def _node(self, level: int, low: int, high: int) -> int:
        known = self._known[level]
        if (low, high) not in known:
            known[low, high] = len(self.nodes[level])
            self.nodes[level].append((low, high))
            below = self.weights[level + 1]
            self.weights[level].append(tuple(a + b for a, b in zip(below[low], below[high])))
        return known[low, high]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next: nodes above keep their pairs, nodes below stay."""
        upper, lower = self.nodes[level], self.nodes[level + 1]
        self.nodes[level + 1], self.weights[level + 1], self._known[level + 1] = [], [], {}
        self.nodes[level] = [
            (self._node(level + 1, lower[low][0], lower[high][0]), self._node(level + 1, lower[low][1], lower[high][1]))
            for low, high in upper]
        self._known[level] = {pair: i for i, pair in enumerate(self.nodes[level])}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> list[tuple[int, ...]]:
        """Weights of what is there at first and after each step."""
        at, path = self.root, [self.weights[0][self.root]]
        for level in range(len(self.order)):
            at = self.nodes[level][at][0]
            path.append(self.weights[level + 1][at])
        return path


def adjacent_swaps(k: int) -> Iterator[int]:
    """Levels to swap so that all k! orders come up once: the last filter sweeps through each order of the others."""
    if k < 2:
        return
    down = True
    inner = adjacent_swaps(k - 1)
    while True:
        yield from (range(k - 2, -1, -1) if down else range(k - 1))
        step = next(inner, None)
        if step is None:
            return
        yield step + (1 if down else 0)
        down = not down


def audit_steps(counts: dict[int, tuple[int, ...]], filters: Sequence[str]) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of one part."""
    k = len(filters)
    diagram = Diagram(k, counts, (0,) * len(WEIGHTS))
    paths = {tuple(diagram.order): diagram.all_pass()}
    for level in adjacent_swaps(k):
        diagram.swap(level)
        paths[tuple(diagram.order)] = diagram.all_pass()
    fails, unique, shapley = [0] * k, [0] * k, [0] * k
    for order, path in paths.items():
        removed = [a[0] - b[0] for a, b in zip(path, path[1:])]
        fails[order[0]], unique[order[-1]] = removed[0], removed[-1]
        for f, r in zip(order, removed):
            shapley[f] += r
    rows = []
    for order, path in sorted(paths.items()):
        name = "".join(filters[f] for f in order)
        for step, (f, before, after) in enumerate(zip(order, path, path[1:]), 1):
            gone, good, toxic = (a - b for a, b in zip(before, after))
            rows.append((name, step, after[0], gone, fails[f] - gone, unique[f], good, toxic, shapley[f]))
    return rows


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def audit(counts: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Every order and step of each part of ``mask_counts``: a task holds one part's at most 2^k rows."""
    if len(filters) > MOST_FILTERS:
        raise ValueError(f"{len(filters)} filters have too many orders to list; {MOST_FILTERS} at most")
    filters = tuple(filters)
    types = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
    names = [f.split()[0] for f in AUDIT.split(", ")]

    def part(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("mask", *WEIGHTS)]
        rows = audit_steps({m: tuple(w) for m, *w in zip(*columns)}, filters)
        name = table.column("part")[0].as_py()
        values = zip(*[(name, *r) for r in rows])
        return pa.table([pa.array(v, t) for v, t in zip(values, types)], names=names)

    return counts.groupBy("part").applyInArrow(part, AUDIT)


def corpus_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five corpus filters."""
    found = stage(corpus_failures(docs), "audit-failures")
    marked = with_labels(with_repeats(found), labels)
    return audit(mask_counts(marked, FILTERS, F.col("n")), FILTERS)
