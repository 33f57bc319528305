"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the hashes
of the text's word shingles. Two texts link when their fingerprints differ in
at most ``max_bits`` bits. Every distinct fingerprint emits all variants within
half that radius; two fingerprints within the radius share a variant, and
all fingerprints that share one are within the radius of each other, so a
variant's group never holds more than the ball's size (65 for one bit). The
shuffle is on the variant; neighbours within a sorted group are linked, which
keeps every component, and each link is verified by its bit distance.

Copies share a fingerprint and meet in a map-side combined aggregate; only
distinct fingerprints take part in the search.

Edge cases: a null or empty text, or one of white space, has fingerprint zero,
linked like any other; a text of fewer words than a shingle is hashed whole; a
null id never is a component's smallest id (null if it has no other); repeated
rows are copies; an empty table gives an empty result. Input columns named
like an output are replaced.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larder.functions.skew import hot_keys, replicate_for_salts, salt_rows
from larder.llm.common import LOWER, TMP, add_columns, components, number_rows, stage

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
SALT_ROWS = 1_000_000


def _fingerprinter(words_each: int, numbered: bool):
    def start():
        import numpy as np
        import xxhash

        digest, at_once = xxhash.xxh64_intdigest, 1 << 17
        rows = number_rows() if numbered else None

        def hashes(text: str | None) -> list[int]:
            words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
            if not words:
                return []
            joined = b" ".join(words)
            if len(words) <= words_each:
                return [digest(joined, HASH_SEED)]
            ends, at = [], -1
            for w in words:
                at += len(w) + 1
                ends.append(at)
            starts = [0] + [e + 1 for e in ends[:-1]]
            return [digest(joined[s:e], HASH_SEED) for s, e in zip(starts, ends[words_each - 1:])]

        def bits(h: list[int]) -> "np.ndarray":
            """How many of the hashes have each bit set (a long text in steps)."""
            total = np.zeros(64, np.int64)
            for i in range(0, len(h), at_once):
                part = np.array(h[i:i + at_once], np.uint64).view(np.uint8).reshape(-1, 8)
                total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
            return total

        def run(texts: list) -> dict:
            out = np.zeros(len(texts), np.uint64)
            for i, text in enumerate(texts):
                h = hashes(text)
                if h:
                    out[i] = np.packbits(bits(h) * 2 > len(h), bitorder="little").view(np.uint64)[0]
            got = {TMP + "fp": out.view(np.int64)}
            return got | {TMP + "row": rows(len(texts))} if numbered else got

        return run

    return start


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS, numbered: bool = False) -> DataFrame:
    """``docs`` with the fingerprint (signed 64 bits) in a working column; optionally numbered rows."""
    fields = [T.StructField(TMP + "fp", T.LongType())]
    if numbered:
        fields.append(T.StructField(TMP + "row", T.LongType()))
    return add_columns(docs, "text", T.StructType(fields), _fingerprinter(words_each, numbered))


def ball(radius: int) -> list[int]:
    """Masks of all bit flips within ``radius``, as signed 64-bit numbers."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (fp, component) for the distinct values of ``fps`` that link to another."""
    if max_bits % 2:
        raise ValueError("half the radius must be whole")
    distinct = fps.select(F.col(TMP + "fp").alias("fp")).distinct()
    flips = F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in ball(max_bits // 2)])
    variants = distinct.select("fp", F.explode(flips).alias("variant"))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = variants.select("fp", before.alias("before")).where("before is not null").select(
        F.col("before").alias("a"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    links = pairs.where(near)
    return components(links).select(F.col("node").alias("fp"), "component")


def _grouped(printed: DataFrame, max_bits: int) -> DataFrame:
    """``printed`` (a staged table) with the component's smallest fingerprint in a working column."""
    found = fingerprint_components(printed, max_bits).select(F.col("fp").alias(TMP + "node"), F.col("component").alias(TMP + "of"))
    joined = printed.join(found, F.col(TMP + "fp") == F.col(TMP + "node"), "left")
    return joined.withColumn(TMP + "of", F.coalesce(F.col(TMP + "of"), F.col(TMP + "fp"))).drop(TMP + "node")


def simhash_components(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Every row's (doc_id, fingerprint, component_id); see the module's text."""
    printed = stage(fingerprints(docs.select("doc_id", "text"), words_each).drop("text"), "simhash")
    classes = printed.groupBy(TMP + "fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    # class grain from here on: copies come back only in the last join
    classes = stage(_grouped(classes, max_bits), "simhash-classes")
    least = classes.groupBy(F.col(TMP + "of").alias("of")).agg(F.min("first").alias("component_id"))
    named = classes.select(F.col(TMP + "fp").alias("node"), F.col(TMP + "of").alias("of")).join(least, "of").drop("of")
    hot = hot_keys(classes, TMP + "fp", "copies", SALT_ROWS)
    named = replicate_for_salts(named, F.col("node"), hot).withColumnRenamed("_salt", "_part")
    same = (F.col(TMP + "fp") == F.col("node")) & (F.col("_salt") == F.col("_part"))
    return salt_rows(printed, F.col(TMP + "fp"), hot).join(named, same, "left").select(
        "doc_id", F.lower(F.lpad(F.hex(TMP + "fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs``, one row of each component: the smallest id's (null last; first of equal rows)."""
    keep = [c for c in docs.columns if not c.startswith(TMP)]
    printed = stage(fingerprints(docs, words_each, numbered=True), "simhash-rows")
    slim = printed.select("doc_id", TMP + "fp", TMP + "row")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col(TMP + "row").alias("r"))
    classes = stage(_grouped(slim.groupBy(TMP + "fp").agg(F.min(order).alias("first")), max_bits), "simhash-classes")
    chosen = classes.groupBy(TMP + "of").agg(F.min("first").alias("first")).select(F.col("first.r").alias(TMP + "row"))
    return printed.join(chosen, TMP + "row", "left_semi").select(*[F.col(f"`{c}`") for c in keep])
