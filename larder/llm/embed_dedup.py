"""Embedding near-duplicates by product quantisation.

Rows with equal label and vector form a class first, so copies cost one row.
Class vectors, scaled to length one, go to coarse inverted lists (nearest of k
centroids); the residual to the centroid is coded in ``SUBSPACES`` subspaces of
``CODES`` words each. Every class is a query. A vector of list l lies on l's side
of the plane between l and the query's own list, so a partner within the radius r
of the similarity lies in l only if the step to it crosses that plane. Of a step of
length r, the part across a plane has a standard deviation of r times the share of
the sample's variance across it (at least r / sqrt(dimensions)); the query probes l
if the plane is within ``PROBE_DEVIATIONS`` of these (never more than r, beyond
which nothing can lie) and l's widest member can be within r. In up to nine
dimensions that loses no pair; in more, a pair near the limit may be missed, or be
counted on one side only, and the tests measure the recall against brute force. In a probed list, distances come from the query's lookup tables (one a
subspace) and the codes. A member whose coded distance is within r plus its own
coding error is a candidate, a bound that loses nothing, and the exact cosine decides.

Quantisers are fitted on a bounded sample (``SAMPLE_ROWS`` classes, by a hash);
every class is indexed. Lists and their queries are cut into blocks of
``BLOCK_ROWS``, so one list, label or group of near copies spreads over many
tasks; a block reports each query's number of links and the links' spanning stars.

Edge cases: a vector that is null, empty, zero or holds a null or non-finite
component, or whose label is null, links with nothing; vectors of different
lengths do not link; a row's copies count as links; a null id is never a
component's smallest id, and such a row is not kept; an empty table gives an empty
result. Other input columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.skew import hot_keys, replicate_for_salts, salt_rows
from larder.llm.common import components, stage

SIMILARITY = 0.98
SUBSPACES = 8
CODES = 64
LIST_ROWS = 2048
MOST_LISTS = 4096
SAMPLE_ROWS = 20_000
BLOCK_ROWS = 1024
PROBE_DEVIATIONS = 3.0
PAIRS_AT_ONCE = 1 << 16
SALT_ROWS = 1_000_000
SLACK = 1e-6


class Quantiser:
    """Centroids of the lists and codebooks of the residuals, for vectors of one length."""

    def __init__(self, centroids: np.ndarray, books: list[np.ndarray], first: int, sample: np.ndarray):
        self.centroids, self.books, self.first = centroids, books, first
        self.cuts = np.cumsum([0] + [b.shape[1] for b in books])
        self.apart = np.sqrt(_squares(centroids, centroids))
        # a unit step's standard deviation across the plane between two lists, times the lists' distance
        values, axes = np.linalg.eigh(np.cov(sample.T, bias=True).reshape(sample.shape[1], -1))
        values = np.maximum(values, 0)
        turned = centroids @ axes * np.sqrt(values / (values.sum() or 1.0))
        self.across = np.maximum(np.sqrt(_squares(turned, turned)), self.apart / np.sqrt(sample.shape[1]))

    def probed(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each vector's own list, the lists it probes (a mask) and its squared distances to all."""
        far = _squares(x, self.centroids)
        near = far.argmin(1)
        gap = far - far[np.arange(len(x)), near][:, None]  # twice the way to the plane, times the lists' distance
        step = np.minimum(self.apart, PROBE_DEVIATIONS * self.across)[near]
        return near, gap <= 2 * radius * step + SLACK, far

    def coded(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and coding errors."""
        codes = np.empty((len(residual), len(self.books)), np.uint8)
        error = np.zeros(len(residual))
        for s, book in enumerate(self.books):
            part = residual[:, self.cuts[s]:self.cuts[s + 1]]
            codes[:, s] = _squares(part, book).argmin(1)
            error += ((part - book[codes[:, s]])**2).sum(1)
        return codes, np.sqrt(error)

    def distances(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Table-lookup distances of queries to the coded members of list ``at``."""
        residual = queries - self.centroids[at]
        total = np.zeros((len(queries), len(codes)))
        for s, book in enumerate(self.books):
            table = _squares(residual[:, self.cuts[s]:self.cuts[s + 1]], book)
            total += table[:, codes[:, s]]
        return np.sqrt(np.maximum(total, 0))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([_squares(x[i:i + 4096], centers).argmin(1) for i in range(0, len(x), 4096)])
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centers)
        np.add.at(total, own, x)
        centers[n > 0] = total[n > 0] / n[n > 0, None]
    return centers


def _scaled(v: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(v).max(1))
    return np.ldexp(v, -exponent[:, None])


def _unit(v: np.ndarray) -> np.ndarray:
    v = _scaled(v)
    return v / np.sqrt((v * v).sum(1))[:, None]


def fit(vectors: list[np.ndarray], rows: int) -> dict[int, Quantiser]:
    """A quantiser for each vector length in the sample; lists are numbered through."""
    rng = np.random.default_rng(11)
    by_length: dict[int, list] = {}
    for v in vectors:
        by_length.setdefault(len(v), []).append(v)
    out, first = {}, 0
    for length, own in sorted(by_length.items()):
        x = _unit(np.array(own, float))
        k = int(np.clip(round(rows * len(own) / len(vectors) / LIST_ROWS), 1, min(MOST_LISTS, max(1, len(own) // 4))))
        centers = _kmeans(x, k, rng)
        residual = x - centers[_squares(x, centers).argmin(1)]
        edges = np.linspace(0, length, min(SUBSPACES, length) + 1).astype(int)
        books = [_kmeans(residual[:8192, a:b], CODES, rng) for a, b in zip(edges[:-1], edges[1:])]
        out[length] = Quantiser(centers, books, first, x)
        first += len(centers)
    return out


def _valid():
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col("label").isNotNull() & F.coalesce(good & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _index(classes: DataFrame, quantisers, radius: float) -> DataFrame:
    """Each class with its list, codes, coding error and the lists it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = quantisers.value
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            own, codes, errors, away, probes, gaps = ([None] * len(vectors) for _ in range(6))
            lengths = np.array([len(v) for v in vectors])
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                q = models.get(int(length))
                if q is None:  # a length the sample lacks: one list, searched whole
                    for i in at:
                        own[i], codes[i], errors[i], away[i], probes[i], gaps[i] = -int(length), b"", 0.0, 0.0, [-int(length)], [0.0]
                    continue
                x = _unit(np.array([vectors[i] for i in at], float))
                near, reach, far = q.probed(x, radius)
                code, error = q.coded(x - q.centroids[near])
                for j, i in enumerate(at):
                    own[i], codes[i], errors[i] = q.first + int(near[j]), code[j].tobytes(), float(error[j])
                    away[i] = float(np.sqrt(far[j, near[j]]))
                    asked = np.flatnonzero(reach[j])
                    probes[i], gaps[i] = (q.first + asked).tolist(), np.sqrt(far[j, asked]).tolist()
            packed = [np.array(v, "<f8").tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), batch.column("label"), batch.column("n"), pa.array(packed, pa.binary()), pa.array(own, pa.int64()),
                 pa.array(codes, pa.binary()), pa.array(errors, pa.float64()), pa.array(away, pa.float64()),
                 pa.array(probes, pa.list_(pa.int64())), pa.array(gaps, pa.list_(pa.float64()))],
                names=["cid", "label", "n", "vector", "list", "codes", "error", "away", "probes", "gaps"])

    return classes.select("cid", F.col("label").cast("string").alias("label"), "n", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        run, "cid long, label string, n long, vector binary, list long, codes binary, error double, away double, "
             "probes array<long>, gaps array<double>")


def _search(index: DataFrame, quantisers, similarity: float, radius: float) -> DataFrame:
    """(cid, links, root): a query's linked rows in one block of a list, and the smallest class of its links' star."""
    groups = index.groupBy("label", "list").agg(F.max("away").alias("widest"), F.count("*").alias("rows")).select(
        F.col("label").alias("_label"), F.col("list").alias("at"), "widest", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("nm"))

    def probing(*columns: str) -> DataFrame:
        """Queries and the lists of their label that they probe: nothing within the radius lies beyond a list's widest member."""
        each = index.select("label", *columns, F.explode(F.arrays_zip("probes", "gaps")).alias("probe"))
        return each.join(groups, (F.col("label") == F.col("_label")) & (F.col("probe.probes") == F.col("at"))).where(
            F.col("probe.gaps") <= F.col("widest") + radius + SLACK).drop("probe", "_label", "widest")

    blocks = stage(probing().groupBy("label", "at", "nm").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("nq")), "vector-blocks")
    blocks = blocks.withColumnsRenamed({"label": "_of", "at": "_at"})
    own = index.join(blocks, (F.col("label") == F.col("_of")) & (F.col("list") == F.col("_at"))).select(
        "label", F.col("list").alias("at"), F.pmod(F.xxhash64("cid"), "nm").cast("int").alias("mb"),
        F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"), F.lit(False).alias("asks"), "cid", "n", "vector", "codes", "error")
    # the probes' rows stay slim until a query's lists are together: its vector is shuffled once, then repeated in place
    lists = probing("cid").drop("nm").join(blocks, (F.col("label") == F.col("_of")) & (F.col("at") == F.col("_at"))).groupBy("cid").agg(
        F.collect_list(F.struct("at", "nm", "nq")).alias("lists")).withColumnRenamed("cid", "_cid")
    queries = index.select("label", "cid", "n", "vector").join(lists, F.col("cid") == F.col("_cid")).select(
        "label", "cid", "n", "vector", F.explode("lists").alias("to")).select(
        "label", F.col("to.at").alias("at"), F.explode(F.sequence(F.lit(0), F.col("to.nm") - 1)).alias("mb"),
        F.pmod(F.xxhash64("cid"), "to.nq").cast("int").alias("qb"), F.lit(True).alias("asks"), "cid", "n", "vector",
        F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error"))

    def run(group: pa.Table) -> pa.Table:
        asks = np.array(group.column("asks").to_pylist(), bool)
        at = group.column("at")[0].as_py()
        cid = group.column("cid").to_numpy()
        n = group.column("n").to_numpy()
        x = np.array([np.frombuffer(v, "<f8") for v in group.column("vector").to_pylist()])
        q_at, m_at = np.flatnonzero(asks), np.flatnonzero(~asks)
        empty = pa.table({"cid": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not len(q_at) or not len(m_at):
            return empty
        unit, x = _unit(x), _scaled(x)
        quantiser = next((q for q in quantisers.value.values() if 0 <= at - q.first < len(q.centroids)), None)
        if quantiser is None:
            close = np.ones((len(q_at), len(m_at)), bool)
        else:
            codes = np.array([np.frombuffer(c, np.uint8) for c in group.column("codes").take(pa.array(m_at)).to_pylist()])
            error = group.column("error").to_numpy()[m_at]
            close = quantiser.distances(unit[q_at], at - quantiser.first, codes) <= radius + error + SLACK
        a, b = np.nonzero(close & (cid[q_at][:, None] != cid[m_at][None]))
        norm = np.sqrt((x * x).sum(1))
        linked = np.zeros(len(a), bool)
        for i in range(0, len(a), PAIRS_AT_ONCE):
            u, v = q_at[a[i:i + PAIRS_AT_ONCE]], m_at[b[i:i + PAIRS_AT_ONCE]]
            linked[i:i + PAIRS_AT_ONCE] = (x[u] * x[v]).sum(1) / (norm[u] * norm[v]) >= similarity
        a, b = q_at[a[linked]], m_at[b[linked]]
        if not len(a):
            return empty
        links = np.zeros(len(cid), np.int64)
        np.add.at(links, a, n[b])
        root = cid.copy()
        while True:  # smallest class reachable by this block's links
            least = root.copy()
            np.minimum.at(least, a, root[b])
            np.minimum.at(least, b, root[a])
            if (least == root).all():
                break
            root = least
        some = np.unique(np.concatenate([a, b]))
        return pa.table({"cid": cid[some], "links": links[some], "root": root[some]})

    return own.unionByName(queries).groupBy("label", "at", "mb", "qb").applyInArrow(run, "cid long, links long, root long")


def embedding_components(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each of ``vectors``: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    radius = float(np.sqrt(2 - 2 * similarity))
    rows = vectors.select("vec_id", "label", "embedding")
    classes = rows.where(_valid()).groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    total = classes.count()
    sample = classes.select("cid", "embedding").orderBy(F.xxhash64("embedding"), "cid").limit(SAMPLE_ROWS).toArrow()
    quantisers = spark.sparkContext.broadcast(fit([np.array(v, float) for v in sample.column("embedding").to_pylist()], total))
    index = stage(_index(classes, quantisers, radius), "vector-index")
    found = stage(_search(index, quantisers, similarity, radius), "vector-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).select("node", "component")
    named = classes.join(links, "cid", "left").join(groups, F.col("cid") == F.col("node"), "left").select(
        "label", "embedding", "first", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "cid").alias("of"))
    least = named.groupBy("of").agg(F.min("first").alias("component_id"))
    named = stage(named.join(least, "of").select(
        F.xxhash64("label", "embedding").alias("key"), F.col("label").alias("_label"), F.col("embedding").alias("_embedding"),
        F.col("n").alias("copies"), (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id"), "vector-named")
    # rows that link with nothing meet no class: their key only spreads them
    keyed = rows.withColumn("key", F.when(_valid(), F.xxhash64("label", "embedding")).otherwise(F.xxhash64("vec_id")))
    hot = hot_keys(named, "key", "copies", SALT_ROWS)
    keyed = salt_rows(keyed, F.col("key"), hot)
    named = replicate_for_salts(named, F.col("key"), hot).withColumnsRenamed({"key": "_key", "_salt": "_part"})
    same = (F.col("key") == F.col("_key")) & (F.col("_salt") == F.col("_part")) & (F.col("label") == F.col("_label")) & (
        F.col("embedding") == F.col("_embedding"))
    component = F.when(F.col("_key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return keyed.join(named, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
