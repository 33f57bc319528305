"""Mixing sources to target weights, in blocks of a fixed number of words.

Each source's words, in a fixed order of its documents, are packed into blocks
of ``BLOCK_WORDS`` (the last one may be shorter). The mix is a set of slots, dealt
to output shards of about ``SHARD_SLOTS``. How many slots a source gives to each
shard is a multinomial draw with the source's total held, so the totals meet the
targets; a source's slots are drawn in runs of ``RUN_SLOTS``, each by a task of its
own, from a seed of source and run. A source's slots are numbered through all
shards; number r stands for block ``permutation(r mod blocks)`` of its pass ``r div
blocks``, each pass with its own keyed pseudorandom permutation, so a block is
drawn as often as any other, or once more. Blocks and slots meet in a join on
the block's index.

Targets: sources in code point order, null last, weigh 1, 2, 3, repeating; a
target stops at ``MOST`` times its source's size and the excess is shared
by weight among the others. Sources are a table, numbered by a range shuffle; there
may be as many as documents. Only sums over all sources reach the driver, one
row for each time that the excess is shared again.

Word offsets come from sums within (source, hash bucket) groups and the sums of
the groups before, so a source with a third of all rows is spread over many
tasks. Everything is drawn from ``SEED`` and the rows' content: reruns agree.

Edge cases: a null text has no words and is never taken; a source without words
has target zero; if every source stands at its limit, the mix is smaller than
the input; rows with equal id, text and source are interchangeable; an empty
table gives an empty result. Working columns replace clashing input columns only
inside the operator.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larder.functions.ranking import ordinals
from larder.llm.common import TMP, slices, stage

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
RUN_SLOTS = 1 << 16
MOST_RUN_TASKS = 100_000
MOST = 3
BUCKET_ROWS = 20_000
SEED = 20_240_601
WORD = r"[^\x20\x09-\x0D]+"


def _sources(totals: DataFrame, block_words: int, most: int = MOST) -> DataFrame:
    """(sid, source, size, target, blocks, draws) of the sources in ``totals`` (source, words)."""
    by_source = totals.groupBy("source").agg(F.sum("words").alias("size"))
    numbered = stage(ordinals(by_source, [F.col("source").isNull(), F.col("source")], "sid"), "mix-numbered")
    weight, limit = F.col("sid") % 3 + 1, F.col("size") * most
    unit, stopped = 0.0, None
    while True:  # the level only rises, so a source once at its limit stays there
        over = F.lit(unit) * weight > limit
        got = numbered.agg(F.sum("size").alias("all"), F.sum(F.when(over, limit)).alias("given"),
                           F.sum(F.when(~over, weight)).alias("open"), F.count(F.when(over, 1)).alias("stopped")).first()
        if got["stopped"] == stopped or not got["open"]:
            break
        unit, stopped = (got["all"] - (got["given"] or 0)) / got["open"], got["stopped"]
    target = F.when(over, limit.cast("double")).otherwise(F.lit(unit) * weight)
    blocks = F.expr(f"(size + {block_words - 1}) div {block_words}")
    draws = F.when(F.col("size") > 0, F.rint(F.col("target") * F.col("blocks") / F.col("size"))).otherwise(0).cast("long")
    return numbered.select("sid", "source", "size", target.alias("target"), blocks.alias("blocks")).withColumn("draws", draws)


def drawn_shards(sid: int, run: int, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """Ascending shards of a run's ``n`` slots: each shard's count is multinomial."""
    return np.sort(np.random.default_rng([seed, sid, run]).integers(0, shards, n))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutation of range(size), for arrays of each: a four-round Feistel network, walked until in range."""
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    size, x = size.astype(np.uint64), index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        a, b, m, k = x[todo] >> bits[todo], x[todo] & mask[todo], mask[todo], key.astype(np.uint64)[todo]
        for r in range(4):
            a, b = b, a ^ (_scrambled(b + k + np.uint64(r * 0x9E3779B97F4A7C15 % (1 << 64))) & m)
        x[todo] = a << bits[todo] | b
        todo = todo[x[todo] >= size[todo]]
    return x.astype(np.int64)


def _scrambled(v: np.ndarray) -> np.ndarray:
    v = (v ^ v >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ v >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return v ^ v >> np.uint64(31)


class Mix:
    """The parts of a mix: ``docs`` (staged, with sid, size, start), ``sources`` (staged) and ``slots``."""

    def __init__(self, docs: DataFrame, sources: DataFrame, slots: DataFrame):
        self.docs, self.sources, self.slots = docs, sources, slots


def plan(docs: DataFrame, keep: list[Column], block_words: int = BLOCK_WORDS, seed: int = SEED) -> Mix:
    """Sizes, word offsets, targets and slots. ``keep`` are further columns of the staged rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = stage(docs.select(
        *keep, F.col("source").cast("string").alias(TMP + "source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias(TMP + "size"),
        F.xxhash64("doc_id", text).alias(TMP + "hash"), F.col("doc_id").alias(TMP + "id")), "mix-sizes")
    rows = sized.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    sized = sized.withColumn(TMP + "bucket", F.pmod(TMP + "hash", F.lit(buckets)))
    totals = stage(sized.groupBy(F.col(TMP + "source").alias("source"), F.col(TMP + "bucket").alias("bucket")).agg(
        F.sum(TMP + "size").alias("words")), "mix-totals")
    sources = stage(_sources(totals, block_words), "mix-sources")
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    named = sources.select(F.col("source").alias("_of"), "sid", F.col("size").alias("source_size"), "target")
    # sources meet the buckets, not the documents: a key of the documents' join has one bucket's rows
    offsets = totals.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
    offsets = offsets.join(named, F.col("_s").eqNullSafe(F.col("_of"))).drop("_of")
    inside = F.sum(TMP + "size").over(Window.partitionBy(TMP + "source", TMP + "bucket").orderBy(TMP + "hash", TMP + "id").rowsBetween(
        Window.unboundedPreceding, -1))
    placed = sized.withColumn("_inside", F.coalesce(inside, F.lit(0)))
    placed = placed.join(offsets, F.col(TMP + "source").eqNullSafe(F.col("_s")) & (F.col(TMP + "bucket") == F.col("_b")), "left")
    start = (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias("start")
    out = placed.select(*[F.col(f"`{c}`") for c in sized.columns if not c.startswith(TMP)], "sid",
                        F.col(TMP + "size").alias("size"), "source_size", "target", start)
    return Mix(stage(out, "mix-placed"), sources, _slots(sources, seed=seed))


def _slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, sid, number, block): one row for each slot of the mix."""
    total = sources.agg(F.sum("draws")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    runs = sources.where("draws > 0").select("sid", "blocks", "draws", F.explode(F.expr(f"sequence(0, (draws - 1) div {RUN_SLOTS})")).alias("run"))
    runs = runs.repartition(min(MOST_RUN_TASKS, 1 + total // RUN_SLOTS), "sid", "run")

    def together(held: list) -> pa.RecordBatch:
        n = [len(number) for _, _, number, _ in held]
        sid, size = (np.repeat(np.array([h[k] for h in held], np.int64), n) for k in (0, 1))
        number, shard = (np.concatenate([h[k] for h in held]) for k in (2, 3))
        key = _scrambled(sid.astype(np.uint64) * np.uint64(1_000_003) + (number // size).astype(np.uint64) * np.uint64(7919) + np.uint64(seed))
        block = permuted(number % size, size, key)
        return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(sid), pa.array(number), pa.array(block)],
                                          names=["shard", "sid", "number", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for sid, blocks, draws, at in zip(*(batch.column(c).to_pylist() for c in ("sid", "blocks", "draws", "run"))):
                number = np.arange(at * RUN_SLOTS, min(draws, (at + 1) * RUN_SLOTS), dtype=np.int64)
                held.append((sid, blocks, number, drawn_shards(sid, at, len(number), shards, seed)))
                rows += len(number)
                if rows >= RUN_SLOTS:
                    yield together(held)
                    held, rows = [], 0
        if held:
            yield together(held)

    return runs.mapInArrow(run, "shard long, sid long, number long, block long")


def pieces(mix: Mix, keep: list[str], block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document and block it has words in: from and to are word places in the document."""
    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    some = mix.docs.where("size > 0").select(*keep, "sid", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    high = F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("size"))
    return some.select("*", low.alias("from"), high.alias("to"))


def _drawn(mix: Mix) -> DataFrame:
    """(sid, block, times) of the blocks drawn. They grow with the input and shuffle small, so they are never broadcast."""
    return mix.slots.groupBy("sid", "block").agg(F.count("*").alias("times")).hint("merge")


def taken_words(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, size, source_size, target, and the words that the mix takes of it."""
    mix = plan(docs, ["doc_id"], block_words)
    drawn = _drawn(mix)
    took = pieces(mix, [], block_words).join(drawn, ["sid", "block"]).groupBy("sid", "start").agg(
        F.sum((F.col("to") - F.col("from")) * F.col("times")).alias("taken"))
    return _with_taken(mix.docs, took)


def _with_taken(docs: DataFrame, took: DataFrame) -> DataFrame:
    """Only documents with words are looked up: source and word offset name them."""
    named = took.select(F.col("sid").alias("_sid"), F.col("start").alias("_start"), "taken")
    same = (F.col("sid") == F.col("_sid")) & (F.when(F.col("size") > 0, F.col("start")) == F.col("_start"))
    return docs.join(named, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: (shard, sid, number, block, words), one row a slot, words of the block in order."""
    mix = plan(docs, ["text"], block_words)
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    parts = pieces(mix, ["text"], block_words).select(
        "sid", "block", F.struct("start", F.slice(words, F.col("from").cast("int") + 1, (F.col("to") - F.col("from")).cast("int")).alias("w")).alias("part"))
    blocks = parts.groupBy("sid", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["w"])).alias("words"))
    return mix.slots.join(blocks, ["sid", "block"])


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The columns of ``docs``, with what the mix takes of each document.

    The first row of a document holds its words in blocks drawn at least once,
    a second and third those in blocks drawn as often; n_chars follows the text.
    Documents of which nothing is taken go.
    """
    columns = [c for c in docs.columns if not c.startswith(TMP)]
    numbered = stage(docs.select(*[F.col(f"`{c}`") for c in columns], F.monotonically_increasing_id().alias(TMP + "row")), "mix-rows")
    mix = plan(numbered, [F.col(TMP + "row").alias("row")], block_words)
    drawn = _drawn(mix)
    parts = pieces(mix, ["row"], block_words).join(drawn, ["sid", "block"]).select(
        "row", F.struct("from", "to", "times").alias("part"))
    parts = parts.groupBy(F.col("row").alias(TMP + "key")).agg(F.array_sort(F.collect_list("part")).alias(TMP + "parts"))
    # the parts grow with the documents, so they are shuffled at any size, never broadcast
    joined = numbered.join(parts.hint("merge"), F.col(TMP + "row") == F.col(TMP + "key"))
    schema = T.StructType([f for f in docs.schema.fields if f.name in columns])
    names, word = [f.name for f in schema.fields], re.compile("[^\\x20\\x09-\\x0D]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, texts = [], []
            for i, (text, got) in enumerate(zip(batch.column("text").to_pylist(), batch.column(TMP + "parts").to_pylist())):
                at = [m.span() for m in word.finditer(text)]
                for k in range(1, max(p["times"] for p in got) + 1):
                    runs: list[list[int]] = []
                    for p in got:
                        if p["times"] < k:
                            continue
                        if runs and runs[-1][1] == p["from"]:
                            runs[-1][1] = p["to"]
                        else:
                            runs.append([p["from"], p["to"]])
                    rows.append(i)
                    texts.append("\n".join(text[at[a][0]:at[b - 1][1]] for a, b in runs))
            taken = batch.take(pa.array(rows, pa.int64()))
            cols = {n: taken.column(n) for n in names}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(t) for t in texts], pa.int64()).cast(taken.column("n_chars").type)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return joined.select(*[F.col(f"`{n}`") for n in names], TMP + "parts").mapInArrow(run, schema)
