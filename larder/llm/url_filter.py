"""URL filter: the ratio of two character language models, with host rules before it.

Rules (host, path) decide first; the URLs that they allow or block are the
labelled URLs of two smoothed variable-order Markov models over characters:
order 0 to ``ORDER`` counts, each order interpolated with the next lower one by
Witten-Bell weights. A URL that no rule fits is judged by the difference of
its log-likelihoods per character under the accepted and the rejected model; it
is blocked when the calibrated difference is below the threshold.

The counts are gathered from all labelled URLs of the table outside the calibration
fold (a fifth, by a hash of the URL) into a written table keyed by the exact context
and character, which grows with the input like the work of the tasks. Every distinct
URL is laid out as its runs of ``ORDER`` + 1 characters; the distinct runs and the
counts are grouped by the two characters before the last, which decide all
counts of orders 2 to 4 (a group has at most 262,144 distinct runs by the
alphabet), and get both classes' probabilities there. The runs' log ratios are
joined back, those of frequent runs by broadcast, and summed by URL, in whole
steps of 1 / ``STEPS``, so the sum does not depend on the order. The driver gets
the counts of pairs of characters (at most 4,096 rows by the alphabet; orders 0
and 1) and the fold's score histogram (``BINS`` bins) only; the threshold is its
cut with the best mean of both classes' rates.

Edge cases: a null URL or one without ``://`` has an empty host and path and
is judged by the models (a null as empty); without labelled URLs of both
classes the method allows; equal cuts go to the lowest; repeated rows count and get
equal results. Input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.skew import hot_keys, replicate_for_salts, salt_rows
from larder.llm.common import TMP, add_columns, number_rows, slices, stage

#: (host, path, verdict); the rules of the contract.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
ORDER = 4
SYMBOLS = 64
#: Bits of a character, and the steps of a log ratio's unit in sums.
BITS = 6
STEPS = float(1 << 32)
#: A run of more than this part of all characters is frequent; so fewer runs than this are.
FREQUENT = 10_000
#: Rows of one URL that one task joins, at most (or a 10,000th part of all).
KEY_ROWS = 1_000_000
FOLDS = 5
BINS = 2001
SPREAD = 10.0


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def by_host(rules: tuple = RULES) -> dict[str, list]:
    """Rules by host, the longest first (host and path, then in code point order)."""
    out: dict[str, list] = {}
    for host, path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        out.setdefault(host, []).append((path, host + path, verdict))
    return out


def rule_for(host: str, path: str, rules: dict[str, list]) -> tuple[str | None, str | None]:
    """The longest rule of the host or a parent domain whose path begins the URL's."""
    best: tuple[str | None, str | None] = (None, None)
    at = 0
    while host and at >= 0:
        for prefix, name, verdict in rules.get(host[at:], ()):
            if path.startswith(prefix) and (best[0] is None or len(name) > len(best[0])):
                best = (name, verdict)
        at = host.find(".", at) + 1 or -1
    return best


def _symbols() -> np.ndarray:
    """Byte to symbol: letters (cases as one), digits, common URL marks; all else is 1, the start 0."""
    out = np.ones(256, np.int64)
    for i, c in enumerate(b"abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#[]@!$&'()*+,;=%"):
        out[c] = 2 + i
    for c in range(65, 91):
        out[c] = out[c + 32]
    return out


class Counts:
    """The written table (run, n0, n1) of both classes' runs, their pairs of characters, and the threshold."""

    def __init__(self, runs: DataFrame, pairs: np.ndarray):
        self.runs, self.pairs, self.threshold = runs, pairs, 0.0


def _judge(urls: list, rules: dict[str, list]) -> tuple[list, list, list, list]:
    got = [parts(u) for u in urls]
    ruled = [rule_for(h, p, rules) for h, p in got]
    return [h for h, _ in got], [p for _, p in got], [r for r, _ in ruled], [v for _, v in ruled]


def _bytes(urls: list) -> list[bytes]:
    return [(u or "").encode("utf-8", "surrogatepass").replace(b"\0", b"\1") for u in urls]


def _fold(urls: list[bytes]) -> np.ndarray:
    import zlib

    return np.array([zlib.crc32(u) % FOLDS == 0 for u in urls], bool)


def runs_of(urls: list[bytes], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``ORDER`` + 1 characters (the latest in the lowest bits) that end at each character, and the URLs' lengths (with an end mark)."""
    joined = np.frombuffer(b"".join(b"\0" * ORDER + u + b"\n" for u in urls), np.uint8)
    codes = symbols[joined]
    codes[joined == 0] = 0
    n = np.array([len(u) + 1 for u in urls], np.int64)
    ends = np.cumsum(n + ORDER)
    real = np.ones(len(codes), bool)
    real[(ends - n - ORDER)[:, None] + np.arange(ORDER)] = False
    at = np.flatnonzero(real)
    out = np.zeros(len(at), np.int64)
    for k in range(ORDER, -1, -1):
        out = (out << BITS) + codes[at - k]
    return out, n


def _numbered(urls: DataFrame, rules: tuple) -> DataFrame:
    """The distinct ``url`` with the rule's class (0 allowed, 1 blocked), whether in the fold, times and a row number; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts, take = by_host(rules), number_rows()
        for batch in slices(batches, "url"):
            texts = batch.column("url").to_pylist()
            c = [{"allow": 0, "block": 1}.get(v) for v in _judge(texts, hosts)[3]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("url"), batch.column("times"), pa.array(c, pa.int32()), pa.array(_fold(_bytes(texts))),
                 pa.array(take(batch.num_rows), pa.int64())], names=["url", "times", "c", "fold", "row"])

    distinct = urls.groupBy("url").agg(F.count("*").alias("times"))
    return stage(distinct.mapInArrow(run, "url string, times long, c int, fold boolean, row long"), "urls")


def _laid_out(urls: DataFrame) -> DataFrame:
    """(row, times, c, run) for each character of ``urls``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = _symbols()
        for batch in slices(batches, "url", 1 << 18):
            runs, n = runs_of(_bytes(batch.column("url").to_pylist()), symbols)
            at = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays([batch.column(k).take(at) for k in ("row", "times", "c")] + [pa.array(runs)],
                                             names=["row", "times", "c", "run"])

    return urls.select("url", "row", "times", "c").mapInArrow(run, "row long, times long, c int, run long")


def pair_counts(counts: DataFrame) -> np.ndarray:
    """Both classes' counts by character before and last character (class, before, last)."""
    out = np.zeros((2, SYMBOLS * SYMBOLS))
    pair = F.col("run").bitwiseAND(F.lit(SYMBOLS * SYMBOLS - 1).cast("long"))
    for r in counts.groupBy(pair.alias("pair")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():
        out[:, r["pair"]] = r["n0"], r["n1"]
    return out.reshape(2, SYMBOLS, SYMBOLS)


def _interpolated(p: np.ndarray, n: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Witten-Bell: the next lower order's ``p`` weighs as much as the context has ``kinds`` of characters."""
    return (n + kinds * p + 1e-9 * p) / (total + kinds + 1e-9)


def probability(runs: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Probability of each run's last character, by one class's counts ``n`` of the runs (repeats are summed) and of ``pairs``.

    ``runs`` hold all counted runs that share with any of them the two characters before the last.
    """
    before, last = runs >> BITS & SYMBOLS - 1, runs & SYMBOLS - 1
    singles = pairs.sum(0)
    p = _interpolated(np.full(len(runs), 1 / SYMBOLS), singles[last], singles.sum(), float((singles > 0).sum()))
    p = _interpolated(p, pairs[before, last], pairs.sum(1)[before], (pairs > 0).sum(1).astype(float)[before])
    for k in range(2, ORDER + 1):
        ends, at = np.unique(runs & (1 << BITS * (k + 1)) - 1, return_inverse=True)
        own = np.bincount(at, n)
        _, of = np.unique(ends >> BITS, return_inverse=True)
        p = _interpolated(p, own[at], np.bincount(of, own)[of][at], np.bincount(of, own > 0)[of][at])
    return p


def ratios(runs: DataFrame, model: Counts) -> DataFrame:
    """(run, n, ratio) of ``runs`` (run, n), each once: log-likelihood of the last character as accepted minus as rejected."""
    pairs = model.pairs

    def group(rows: pa.Table) -> pa.Table:
        run = rows.column("run").to_numpy()
        p = [probability(run, rows.column(f"n{c}").to_numpy(), pairs[c]) for c in range(2)]
        out = pa.table([rows.column("run"), rows.column("n"), *map(pa.array, p)], names=["run", "n", "p0", "p1"])
        return out.filter(pa.array(rows.column("n").to_numpy() > 0))

    both = runs.select("run", "n", *[F.lit(0).cast("long").alias(f"n{c}") for c in range(2)]).union(
        model.runs.select("run", F.lit(0).cast("long"), "n0", "n1"))
    context = F.shiftright("run", BITS).bitwiseAND(F.lit(SYMBOLS * SYMBOLS - 1).cast("long"))
    found = both.groupBy(context.alias("context")).applyInArrow(group, "run long, n long, p0 double, p1 double")
    return found.select("run", "n", (F.log("p0") - F.log("p1")).alias("ratio"))


def scores(urls: DataFrame, model: Counts) -> DataFrame:
    """(row, score) of numbered URLs: mean log-likelihood difference per character, accepted minus rejected.

    Every URL holds the runs of its scheme: the ratios of frequent runs are sent to all tasks, so their characters
    are summed where they are read, and no run left for the shuffle holds more than a ``FREQUENT``-th part of all.
    """
    laid = _laid_out(urls).select("row", "run")
    step = F.round(F.col("ratio") * F.lit(STEPS)).cast("long")
    known = ratios(laid.groupBy("run").agg(F.count("*").alias("n")), model).select("run", "n", step.alias("steps"))
    known = stage(known, "url-runs")
    share = known.select(F.sum("n") / F.lit(FREQUENT)).scalar()
    frequent = F.broadcast(known.where(F.col("n") > share).select("run", "steps"))
    others = laid.join(frequent, "run", "left_anti").join(known.where(F.col("n") <= share).select("run", "steps"), "run")
    found = laid.join(frequent, "run").select("row", "steps").union(others.select("row", "steps"))
    return found.groupBy("row").agg((F.sum(F.col("steps").cast("decimal(20,0)")) / F.lit(STEPS) / F.count("*")).cast("double").alias("score"))


def train(pages: DataFrame, rules: tuple = RULES) -> Counts | None:
    """Counts of both classes from all labelled URLs outside the fold, then the fold's threshold."""
    urls = _numbered(pages.select(F.col("url").cast("string").alias("url")).where("url is not null"), rules).where("c is not null")
    each = [F.coalesce(F.sum(F.when(F.col("c") == c, F.col("times"))), F.lit(0)).alias(f"n{c}") for c in range(2)]
    runs = stage(_laid_out(urls.where("not fold")).groupBy("run").agg(*each), "url-counts")
    if not all(runs.agg(*[F.max(f"n{c}") for c in range(2)]).first()):
        return None
    model = Counts(runs, pair_counts(runs))
    fold = urls.where("fold")
    place = F.rint((F.col("score") + SPREAD) / (2 * SPREAD) * (BINS - 1))
    place = F.least(F.greatest(place, F.lit(0.0)), F.lit(BINS - 1.0)).cast("int")
    tally = np.zeros((2, BINS))
    for r in fold.join(scores(fold, model), "row").groupBy("c", place.alias("bin")).agg(F.sum("times").alias("n")).collect():
        tally[r["c"], r["bin"]] = r["n"]
    model.threshold = cut(tally)
    return model


def cut(tally: np.ndarray) -> float:
    """The score from which a URL is allowed: best mean of the shares of allowed above and blocked below."""
    if not tally[0].sum() or not tally[1].sum():
        return 0.0
    above = 1 - np.concatenate([[0], np.cumsum(tally[0])[:-1]]) / tally[0].sum()
    below = np.concatenate([[0], np.cumsum(tally[1])[:-1]]) / tally[1].sum()
    both = above + below
    best = np.flatnonzero(both == both.max())
    middle = (best[0] + best[-1]) / 2  # a wide gap between the classes is cut in its middle
    return float((middle - 0.5) / (BINS - 1) * 2 * SPREAD - SPREAD)


FIELDS = [T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()),
          T.StructField("verdict", T.StringType())]


def url_filter(pages: DataFrame, model: Counts | None, rules: tuple = RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the method's score (0 without a model)."""

    def start() -> Callable:
        hosts = by_host(rules)
        return lambda texts: dict(zip(("host", "path", "rule", "verdict"), _judge(texts, hosts)))

    found = add_columns(pages.drop("score"), "url", T.StructType(FIELDS), start)
    if not model:
        return found.withColumn("verdict", F.coalesce("verdict", F.lit("allow"))).withColumn("score", F.lit(0.0))
    key = F.coalesce(F.col("url").cast("string"), F.lit(""))
    urls = _numbered(pages.select(key.alias("url")), rules)
    hot = hot_keys(urls, "url", "times", KEY_ROWS)
    scored = urls.join(scores(urls, model), "row").select(F.col("url").alias(TMP + "url"), "score")
    scored = replicate_for_salts(scored, F.col(TMP + "url"), hot).withColumnRenamed("_salt", TMP + "part")
    plain = [f.name for f in found.schema.fields if isinstance(f.dataType, T.AtomicType)]
    keyed = salt_rows(found.withColumn(TMP + "key", key), F.col(TMP + "key"), hot, plain, TMP + "salt")
    same = (F.col(TMP + "key") == F.col(TMP + "url")) & (F.col(TMP + "salt") == F.col(TMP + "part"))
    found = keyed.join(scored, same, "left").drop(*[TMP + c for c in ("key", "url", "salt", "part")])
    judged = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    return found.withColumn("verdict", F.coalesce("verdict", judged))
