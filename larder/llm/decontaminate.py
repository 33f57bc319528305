"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ``window`` consecutive words of a benchmark item; an
item of fewer words, but not none, is one pattern of its own length. Words are
numbered within a block of patterns (a word the block does not know is 0 and
stands in no pattern), and patterns of one length L are searched together:

* SHIFT: for every pair of neighbouring words in a pattern, how far the window
  may move when it ends in that pair; any other pair moves it L - 1 words on.
  A text that shares little with the benchmark is looked at every L - 1 words.
* buckets: the patterns by the hash of their last pair, with their first pair
  beside them; only those of the bucket with the right first pair are compared.
* comparison: the pattern's words against the text's, word by word.

Texts are never shuffled. The benchmark is cut into blocks of at most
``BLOCK_WORDS`` words (windows whole, by overlapping segments), which bounds
what is on the driver and broadcast at any time; a larger benchmark takes a pass
over the texts for each block, whose findings are written and merged by row.
With one block, which holds some 1,500 items of 80 words, there is one pass and
no merge.

Defined results: null and word-less texts have no words and no hits, null and
word-less items no pattern. Repeated items (same id, same or other text) are one
item, found if any of their windows is; items without id share the id ``''``.
Rows of documents are judged one by one, repeated ones alike; columns other than
the key and the text are kept unless they clash with the result's.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.ranking import exclusive_prefix_sums
from larder.llm.common import LOWER, TMP, slices, stage

#: Words of a window.
WINDOW = 10
#: Words of benchmark text compiled, broadcast and searched at once (about 60 MB compiled).
BLOCK_WORDS = 120_000
#: New words of a segment, the piece of an item that a block takes whole.
SEGMENT_WORDS = 1_000

#: Words in UTF-8: every byte above ASCII belongs to one.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

FOUND = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "hits")


_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_STRETCH = 1 << 20


def words_of(text: str | None) -> Iterator[bytes]:
    """The words of a text, taken from stretches of about a megabyte that end between words."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + _STRETCH)
        end = gap.start() if gap else len(data)
        yield from WORD.findall(data, at, end)
        at = end


# ------------------------------------------------------------------ patterns

class Patterns:
    """The compiled windows of one block."""

    def __init__(self, segments: list[tuple[str, int, bytes]], window: int = WINDOW):
        """``segments``: (item, words of the whole item, space-joined words of the segment)."""
        self.numbers: dict[bytes, int] = {}
        self.lengths: dict[int, Length] = {}
        known: dict[tuple, set[str]] = {}
        for item, total, text in segments:
            number = self.numbers
            ids = tuple(number.setdefault(w, len(number) + 1) for w in text.split(b" "))
            length = min(window, total)
            for i in range(len(ids) - length + 1):
                known.setdefault(ids[i:i + length], set()).add(item)
        by_length: dict[int, list] = {}
        for words, items in known.items():
            by_length.setdefault(len(words), []).append((words, tuple(sorted(items))))
        for length, patterns in sorted(by_length.items()):
            self.lengths[length] = Length(length, patterns, len(self.numbers) + 1)

    def search(self, words: Iterable[bytes]) -> tuple[int, list[tuple[int, int]], set[str]]:
        """The number of words, the hit stretches (start, end) in order, and the items found."""
        get = self.numbers.get
        ids = array("i", [get(w, 0) for w in words])
        stretches: list[tuple[int, int]] = []
        items: set[str] = set()
        for length in self.lengths.values():
            stretches += length.search(ids, items)
        return len(ids), merged(stretches), items


class Length:
    """SHIFT table and suffix buckets of the patterns of one length (blocks of two words; of one for single words)."""

    def __init__(self, length: int, patterns: list[tuple[tuple, tuple]], base: int):
        self.length, self.base = length, base
        self.block = min(2, length)
        self.free = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, list[tuple[int, array, tuple]]] = {}
        for words, items in patterns:
            for end in range(self.block, length + 1):
                key = self._key(words, end)
                self.shift[key] = min(self.shift.get(key, self.free), length - end)
            entry = (self._key(words, self.block), array("i", words), items)
            self.buckets.setdefault(self._key(words, length), []).append(entry)

    def _key(self, words, end: int) -> int:
        """The block of words that ends before ``end``, as one number."""
        return words[end - 2] * self.base + words[end - 1] if self.block == 2 else words[end - 1]

    def search(self, ids: array, items: set[str]) -> list[tuple[int, int]]:
        found = []
        length, base, free, pairs = self.length, self.base, self.free, self.block == 2
        shift, buckets = self.shift.get, self.buckets
        end, total = length, len(ids)
        while end <= total:
            key = ids[end - 2] * base + ids[end - 1] if pairs else ids[end - 1]
            step = shift(key, free)
            if step:
                end += step
                continue
            start = end - length
            first = ids[start] * base + ids[start + 1] if pairs else ids[start]
            for prefix, words, of in buckets[key]:
                if prefix == first and ids[start:end] == words:
                    found.append((start, end))
                    items.update(of)
            end += 1
        return found


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


# ------------------------------------------------------------------ blocks

SEGMENT = "item string, segment long, total long, words binary, n long, text_key string"


def segments(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Items as segments of ``SEGMENT_WORDS`` new words that overlap by a window less one, so every window is whole in one."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = list(words_of(text))
                digest = hashlib.sha256(b" ".join(words)).hexdigest()
                for k, start in enumerate(range(0, max(1, len(words) - window + 1), SEGMENT_WORDS) if words else ()):
                    piece = words[start:start + SEGMENT_WORDS + window - 1]
                    rows.append((item, k, len(words), b" ".join(piece), len(piece), digest))
            values = list(zip(*rows)) or [[]] * 6
            types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)],
                                             names=[f.split()[0] for f in SEGMENT.split(", ")])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("string").alias("text"))
    return items.mapInArrow(cut, SEGMENT).dropDuplicates(["item", "text_key", "segment"])


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, int]:
    """The segments with their block number, and the number of blocks (of at most ``block_words`` and a segment)."""
    order = [F.col("item"), F.col("text_key"), F.col("segment")]
    numbered = exclusive_prefix_sums(segments(benchmark, window), order, ["n"])
    found = stage(numbered.withColumn("block", F.floor(F.col("before_n") / block_words)), "benchmark-blocks")
    last = found.agg(F.max("block")).first()[0]
    return found, 0 if last is None else int(last) + 1


def compiled(found: DataFrame, block: int, window: int = WINDOW) -> Patterns:
    """One block's patterns; the driver holds at most ``block_words`` words and a segment of them."""
    rows = found.where(F.col("block") == block).orderBy("before_n").select("item", "total", "words").collect()
    return Patterns([(r.item, r.total, bytes(r.words)) for r in rows], window)


# ------------------------------------------------------------------ search

def _digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _judged(n: int, stretches: list, items: set[str]) -> tuple:
    hit = sum(b - a for a, b in stretches)
    names = sorted(items)
    return n, hit, len(names), _digest(names), hit > 0, names, [x for s in stretches for x in s]


_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("hits", T.ArrayType(T.LongType()))])
_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int64()))


def _searched(docs: DataFrame, kept: list[str], patterns: Patterns) -> DataFrame:
    """``kept`` columns of each row, and the result columns by one block."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)  # bounded: one block
    schema = T.StructType([docs.schema[c] for c in kept] + _RESULT.fields)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value.search
        for batch in slices(batches, TMP + "text"):
            rows = [_judged(*search(words_of(t))) for t in batch.column(TMP + "text").to_pylist()]
            found = [pa.array(v, t) for v, t in zip(list(zip(*rows)) or [[]] * len(_ARROW), _ARROW)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + found, names=names)

    text = F.col("text").cast("string").alias(TMP + "text")
    return docs.select(*[F.col(f"`{c}`") for c in kept], text).mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  keep_text: bool = False) -> DataFrame:
    """Every row of ``docs``, with its text only if asked for, and what of the benchmark it holds.

    Added: ``n_words``, ``n_hit`` (words inside any occurrence), ``n_items``,
    ``items_sha256`` (of the sorted ids, comma-joined), ``contaminated``,
    ``items`` (the ids) and ``hits`` (starts and ends of the hit stretches, in
    words, by turns).
    """
    found, n_blocks = blocks(benchmark, window, block_words)
    kept = [c for c in docs.columns if c not in FOUND and (keep_text or c != "text") and not c.startswith(TMP)]
    if n_blocks <= 1:
        return _searched(docs, kept, compiled(found, 0, window) if n_blocks else Patterns([], window))
    # Several passes: rows are numbered once, in a written table, and each pass' findings are written.
    row = TMP + "row"
    columns = [F.col(f"`{c}`") for c in kept if c != "text"]
    numbered = stage(docs.select(*columns, "text").withColumn(row, F.monotonically_increasing_id()), "benchmark-texts")
    base = _searched(numbered, [*kept, row], Patterns([], window)).drop("n_hit", "n_items", "items_sha256", "contaminated",
                                                                        "items", "hits")
    texts = numbered.select(row, "text")
    passes = [stage(_searched(texts, [row], compiled(found, b, window)).where("contaminated").select(row, "items", "hits"),
                    "benchmark-pass") for b in range(n_blocks)]
    union = passes[0]
    for p in passes[1:]:
        union = union.union(p)
    hits = union.groupBy(row).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                  F.collect_list("hits").alias("parts")).withColumnRenamed(row, TMP + "of")
    joined = base.join(hits, F.col(row) == F.col(TMP + "of"), "left").drop(row, TMP + "of")
    return joined.select(*kept, "n_words", *_merged_columns())


def _merged_columns() -> list:
    """The result columns from a row's findings of several passes."""
    @F.udf("array<bigint>", useArrow=True)
    def stretches(parts):
        flat = [(p[i], p[i + 1]) for p in parts for i in range(0, len(p), 2)] if parts is not None else []
        return [int(x) for s in merged(flat) for x in s]

    hits = F.when(F.col("parts").isNull(), F.array().cast("array<bigint>")).otherwise(stretches("parts"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.aggregate(F.transform(hits, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"),
                        lambda a, x: a + x)
    return [n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), F.col("parts").isNotNull().alias("contaminated"),
            items.alias("items"), hits.alias("hits")]
