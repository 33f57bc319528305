"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's subwords are the character 3- and 4-grams of its lower-cased letters
(anything else counts as a blank; grams of blanks only are skipped), hashed
into ``BUCKETS`` embeddings. Their average goes through a linear softmax, both
trained by stochastic gradient descent in numpy. Since the layer is linear,
scoring sums each bucket's class scores, over the whole text.

Fitting uses a bounded sample: ``SAMPLE_ROWS`` labelled rows a language, chosen
by a hash of the row over the whole table, and of each ``SAMPLE_GRAMS`` grams
drawn from its whole text. A fifth of the sample is held aside to fit a
temperature and the score below which a prediction is rejected: that of the
``REJECT_SHARE`` quantile of the correct predictions, ``REJECT_MOST`` at most.

Edge cases: a null text or one without a letter is ``und`` with score 0 and is
rejected; without any labelled row every text is ``und``; ties go to the first
language in code point order; repeated rows get equal results. Input columns
named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import add_columns, slices

BUCKETS = 1 << 14
DIM = 16
ORDERS = (3, 4)
SAMPLE_ROWS = 1500
SAMPLE_GRAMS = 256
EPOCHS = 6
BATCH = 64
RATE = 0.5
REJECT_SHARE = 0.001
REJECT_MOST = 0.5
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def _letters() -> np.ndarray:
    """Per code point below 2^16: itself if a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


def _hashed(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the gram that starts at each place, and whether it counts."""
    n = max(0, len(codes) - order + 1)
    h = np.full(n, 2166136261 + order, np.uint32)
    full = np.zeros(n, bool)
    for k in range(order):
        part = codes[k:k + n]
        h = (h ^ part) * np.uint32(16777619)
        full |= part != 32
    h ^= h >> np.uint32(15)
    h *= np.uint32(2246822519)
    return (h >> np.uint32(13)) & np.uint32(BUCKETS - 1), full


def _codes(text: str, letters: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(raw < 1 << 16, letters[np.minimum(raw, (1 << 16) - 1)], raw)


def _grams(text: str, letters: np.ndarray) -> np.ndarray:
    codes = _codes(text, letters)
    parts = [h[full] for h, full in (_hashed(codes, k) for k in ORDERS)]
    return np.concatenate(parts)


def sample_grams(docs: DataFrame, lang: Column, rows: int = SAMPLE_ROWS, grams: int = SAMPLE_GRAMS) -> list:
    """At most ``rows`` (lang, grams) a language, from labelled rows with a letter, in a fixed order."""
    labelled = docs.select(lang.cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(
        "lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, min(1.0, rows / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.where(draw < share)

    def run(batches):
        letters, rng = _letters(), np.random.default_rng(0)
        for batch in slices(batches, "text"):
            out: dict[str, list] = {"lang": [], "grams": [], "h": []}
            for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                got = _grams(text, letters)
                if not len(got):
                    continue
                seed = int(np.bitwise_xor.reduce(got)) * 131 + len(got)
                rng = np.random.default_rng(seed)
                picked = got if len(got) <= grams else got[rng.integers(0, len(got), grams)]
                out["lang"].append(name)
                out["grams"].append(picked.astype("<u4").tobytes())
                out["h"].append(seed)
            yield pa.RecordBatch.from_arrays([pa.array(out["lang"], pa.string()), pa.array(out["grams"], pa.binary()),
                                              pa.array(out["h"], pa.int64())], names=["lang", "grams", "h"])

    found = chosen.mapInArrow(run, "lang string, grams binary, h long")
    most = rows * len(counts)
    return found.orderBy("h", "lang", "grams").limit(2 * most).collect()


class Model:
    """Class scores per bucket, bias, temperature and rejection threshold."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, reject: float):
        self.langs, self.table, self.bias = langs, table, bias
        self.temperature, self.reject = temperature, reject


def fit(sample: list, epochs: int = EPOCHS) -> Model | None:
    """Embeddings and softmax by SGD over the sample; a fifth of it calibrates."""
    langs = sorted({r["lang"] for r in sample}, key=lambda x: x.encode())
    if not langs:
        return None
    at = {x: i for i, x in enumerate(langs)}
    bags = [np.frombuffer(bytes(r["grams"]), "<u4").astype(np.int64) for r in sample]
    want = np.array([at[r["lang"]] for r in sample])
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    aside = np.arange(len(bags)) % 5 == 4
    train = np.flatnonzero(~aside)
    weight = len(train) / (len(langs) * np.maximum(1, np.bincount(want[train], minlength=len(langs))))
    steps, done = max(1, epochs * len(train) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(train)
        for i in range(0, len(order), BATCH):
            some = order[i:i + BATCH]
            ids = np.concatenate([bags[j] for j in some])
            sizes = np.array([len(bags[j]) for j in some])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(emb[ids], starts, axis=0) / sizes[:, None]
            p = _softmax(mean @ out + bias)
            p[np.arange(len(some)), want[some]] -= 1
            p *= weight[want[some]][:, None] / len(some)
            rate = np.float32(RATE * max(0.05, 1 - done / steps) * 4)
            back = (p @ out.T / sizes[:, None] * BATCH).astype(np.float32)
            out -= rate * (mean.T @ p).astype(np.float32)
            bias -= rate * p.sum(0).astype(np.float32)
            np.subtract.at(emb, ids, rate * np.repeat(back, sizes, axis=0))
            done += 1
    table = (emb @ out).astype(np.float32)
    logits = np.array([table[b].mean(0) + bias for b in bags], np.float64)
    held = np.flatnonzero(aside) if aside.any() else np.arange(len(bags))
    temperature = min((0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: -np.log(
        _softmax(logits[held] / t)[np.arange(len(held)), want[held]] + 1e-9).mean())
    p = _softmax(logits[held] / temperature)
    right = p.max(1)[p.argmax(1) == want[held]]
    reject = float(min(REJECT_MOST, np.quantile(right, REJECT_SHARE))) if len(right) else 0.0
    return Model(langs, table, bias, temperature, reject)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _sums(codes: np.ndarray, starts: np.ndarray, table: np.ndarray, at_once: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Per text (texts begin at ``starts`` in ``codes``): class score sums and counted grams."""
    total = np.zeros((len(starts), table.shape[1]))
    count = np.zeros(len(starts))
    for order in ORDERS:
        for lo in range(0, len(codes), at_once):
            h, full = _hashed(codes[lo:lo + at_once + order - 1], order)
            if not len(h):
                continue
            for k in range(1, order):  # grams that would reach into the next text
                past = starts[1:] - k - lo
                full[past[(past >= 0) & (past < len(h))]] = False
            first = max(0, int(np.searchsorted(starts, lo, "right")) - 1)
            last = int(np.searchsorted(starts, lo + len(h), "left"))
            cuts = np.maximum(starts[first:last] - lo, 0)
            weight = full[:, None] * table[h]
            total[first:last] += np.add.reduceat(weight, cuts, axis=0, dtype=np.float64)
            count[first:last] += np.add.reduceat(full.astype(np.int64), cuts)
    return total, count


def _scorer(model: Model | None) -> Callable:
    def start():
        letters = _letters()

        def run(texts: list) -> dict:
            known = [i for i, t in enumerate(texts) if model and t and LETTER.search(t)]
            langs, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            if known:
                codes = [_codes(texts[i], letters).astype(np.uint32) for i in known]
                sizes = np.array([len(c) for c in codes])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                total, count = _sums(np.concatenate(codes), starts, model.table)
                p = _softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
                for i, k, s in zip(known, p.argmax(1), p.max(1)):
                    langs[i], scores[i], rejected[i] = model.langs[k], float(s), bool(s < model.reject)
            return {"lang_pred": langs, "score": scores, "rejected": rejected, "_stay": [not x for x in rejected]}

        return run

    return start


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("rejected", T.BooleanType())]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected."""
    return add_columns(docs, "text", T.StructType(FIELDS), lambda: _only(_scorer(model)(), [f.name for f in FIELDS]))


def drop_rejected(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose language is predicted and not rejected."""
    return add_columns(docs, "text", T.StructType([T.StructField("_stay", T.BooleanType())]),
                       lambda: _only(_scorer(model)(), ["_stay"]), where="_stay")


def _only(fn: Callable, names: list[str]) -> Callable:
    return lambda texts: {k: v for k, v in fn(texts).items() if k in names}


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text, mod 4, is 2 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> Model | None:
    """Model of the rows outside the held-out fold."""
    return fit(sample_grams(docs.where(~held_out(F.col("doc_id"))), F.col("lang")))
