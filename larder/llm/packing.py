"""Packing documents into token windows by lexical retrieval.

Documents are dealt by a hash of their content into shards of about
``SHARD_BYTES`` of text. A shard's task builds a BM25 inverted index of its documents
(token ids are the terms; weights by frequency, rarity and length). The seed of
a window, the lowest unused document or the rest of a cut one, asks the index
with all its weighted terms; the unused documents that share one fill the window
in falling order of score. Where they run out before it is full, the window's other
documents ask, the latest first; only when none of them shares a term with an
unused document the next unused one follows, and asks in turn. A document
that does not fit is cut at the window's end, and its rest is the next seed: every
window is full. A shard's last tokens go to sequences of falling powers of two,
which are never padded, so there is no padding at all.

Every document is indexed and packed; neighbours decide only the order. Terms in
half of a shard's documents or more have no weight. Token ids are those of the
tokenizer's own file; words of letters alone go straight to its merge model, all
else through the whole tokenizer, and both are remembered within a Python worker (at most
``CACHE_WORDS`` words each).

Edge cases: a null or empty text is its end id alone; repeated rows are packed
each for itself, in a fixed order; a text longer than a window spans several;
one that is much longer than a shard stays one document of one shard; an empty
table gives an empty result. Input columns other than id and text are not used.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import once_a_worker, slices

WINDOW = 2048
END_ID = 1
SHARD_BYTES = 4 << 20
K1, B = 1.2, 0.75
CACHE_WORDS = 850_000
TOKENIZER = "word_bpe_49k.json"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def encoder(path: str, cache_words: int = CACHE_WORDS) -> tuple[Callable[[str | None], bytes], str]:
    """Text to ids as the tokenizer gives them without adding special tokens, and the ids' type (16 bits if all fit).

    Where a text holds the string of one of the tokenizer's own added tokens, that
    is its id, and the parts around it are encoded each for itself. White space separates words for this tokenizer, so a text's ids are its
    words' ids in a row; within a word of Latin letters and ASCII marks, its
    pieces are letters, single digits, runs of marks, and clitics.
    """
    import struct

    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    added = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
    marks = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
    whole.encode_special_tokens = True  # the words below hold none
    merges = whole.model
    code = "H" if whole.get_vocab_size() <= 1 << 16 else "I"
    to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = "".join(chr(c) for c in range(0x100) if chr(c).isalpha())
    mapped = {ord(c): to_bytes.pre_tokenize_str(c.lower())[0][0] for c in letters}
    latin = re.compile(f"[!-~{letters}]+")
    piece = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{letters}]+|[0-9]|[^0-9{letters}]+")
    odd_space = "\x1c\x1d\x1e\x1f"
    blank = re.compile("[^ \t\n\r\x0b\x0c]+")
    known: dict[str, bytes] = {}
    packers = [struct.Struct(f"<{n}{code}").pack for n in range(65)]

    def pieces_of(part: str) -> bytes:
        """Ids of one piece, in byte symbols."""
        ids = [t.id for t in merges.tokenize(part)]
        return packers[len(ids)](*ids) if len(ids) < len(packers) else struct.pack(f"<{len(ids)}{code}", *ids)

    def merged(part: str, known: dict) -> bytes:
        got = known.get(part)
        if got is None:
            got = pieces_of(part)
            if len(known) >= cache_words:
                known.clear()
            known[part] = got
        return got

    ends = {mark: pieces_of(mark) for mark in ".,"}

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            end = ends.get(word[-1])
            body = word if end is None else word[:-1]
            if body.isalpha() and max(body) < "\u0100":  # one piece of letters
                low = body.lower()
                if not low.isascii():
                    low = low.translate(mapped)
                    got = merged(low, known)
                elif low == word:  # its byte symbols are itself, so words and pieces share a place
                    got = pieces_of(low)
                else:
                    got = merged(low, self)
                if end is not None:
                    got += end
            elif latin.fullmatch(word):
                got = b"".join([merged(p.translate(mapped), known) for p in piece.findall(word.lower())])
            else:
                ids = whole.encode(word, add_special_tokens=False).ids
                got = struct.pack(f"<{len(ids)}{code}", *ids)
            if len(word) <= 64:
                if len(self) >= cache_words:
                    self.clear()
                self[word] = got
            return got

    words = Words()

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if any(mark in text for mark in added):
            return b"".join(struct.pack(f"<{code}", added[p]) if p in added else plain(p) for p in marks.split(text))
        return plain(text)

    def plain(text: str) -> bytes:
        parts = blank.findall(text) if any(c in text for c in odd_space) else text.split()
        return b"".join(map(words.__getitem__, parts))

    return encode, "<u2" if code == "H" else "<u4"


def tokenized(docs: DataFrame, path: str, shards: int, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, shard, ids, kind): little-endian ids of that type, the end id last."""
    text = F.col("text").cast("string")
    shard = F.pmod(F.xxhash64(F.col("doc_id"), F.coalesce(text, F.lit(""))), F.lit(shards))
    source = docs.select(F.col("doc_id").cast("long"), shard.alias("shard"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = once_a_worker(f"encoder:{path}:{cache_words}", lambda: encoder(path, cache_words))
        end = np.array([END_ID], kind).tobytes()
        for batch in slices(batches, "text"):
            ids = [encode(t) + end for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), pa.array(ids, pa.binary()), pa.array([kind] * len(ids))],
                names=["doc_id", "shard", "ids", "kind"])

    return source.mapInArrow(run, "doc_id long, shard long, ids binary, kind string")


class Index:
    """BM25 inverted index of the documents of one shard."""

    def __init__(self, docs: list[np.ndarray]):
        n = len(docs)
        terms, counts, sizes = [], [], []
        for ids in docs:
            t, c = np.unique(ids[:-1], return_counts=True)
            terms.append(t)
            counts.append(c)
            sizes.append(len(t))
        term, tf = np.concatenate(terms).astype(np.int64), np.concatenate(counts)
        doc = np.repeat(np.arange(n), sizes)
        df = np.bincount(term) if len(term) else np.zeros(1, np.int64)
        rarity = np.maximum(0, np.log((n - df + 0.5) / (df + 0.5)))
        length = np.array([len(d) for d in docs], float)
        weight = rarity[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / length.mean()))
        keep = weight > 0
        term, doc, weight = term[keep], doc[keep], weight[keep]
        self.n, self.rarity = n, rarity
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
        self.terms, self.own = term, weight
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(df)))])
        self.open = np.ones(len(df), bool)
        self.held = n

    def forget(self, unused: np.ndarray) -> None:
        """Drop the used documents from the lists, whose order stays."""
        keep = unused[self.doc].astype(bool)
        self.first = np.concatenate([[0], np.cumsum(keep)])[self.first]
        self.doc, self.weight = self.doc[keep], self.weight[keep]
        self.held = int(np.count_nonzero(unused))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a weighted term, best first (ties: lowest first)."""
        query = self.terms[self.bounds[seed]:self.bounds[seed + 1]]
        query = query[self.open[query]]
        spans = [slice(a, b) for a, b in zip(self.first[query].tolist(), self.first[query + 1].tolist()) if a < b]
        found = np.concatenate([self.doc[s] for s in spans]) if spans else np.zeros(0, np.int64)
        if len(found):
            weight = np.concatenate([self.weight[s] for s in spans])
            if len(found) * 8 < self.n:
                some, place = np.unique(found, return_inverse=True)
                score = np.bincount(place, weight)
            else:
                score = np.bincount(found, weight, self.n)
                some = np.flatnonzero(score)
                score = score[some]
            left = unused[some].astype(bool)
            found, score = some[left], score[left]
        if not len(found):
            self.open[query] = False  # documents are never unused again, so such a term finds nothing later
            return found
        return found[np.argsort(-score, kind="stable")]


def pack(docs: list[np.ndarray], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for every piece; sequences are numbered from 0."""
    index = Index(docs)
    sizes = [len(d) for d in docs]
    unused = np.ones(len(docs), bool)
    out: list[tuple[int, int, int, int, int]] = []
    left, sequence, cursor = sum(sizes), 0, 0
    seed, at = -1, 0  # the rest of a cut document
    room = 0
    near: list[int] = []
    to_ask: list[int] = []  # the window's documents that have not asked, the latest last
    rest = len(docs)  # unused documents
    while left:
        if not room:
            if out:
                sequence += 1
            room = size = window if left >= window else 1 << (left.bit_length() - 1)
            near, to_ask = [], []
        if seed < 0:
            while not near and to_ask:
                near = index.neighbours(to_ask.pop(), unused)[::-1].tolist()
            if near:
                seed = near.pop()
                if not unused[seed]:
                    seed = -1
                    continue
            else:
                while not unused[cursor]:
                    cursor += 1
                seed = cursor
            unused[seed] = False
            rest -= 1
            at = 0
            if rest * 5 < index.held * 4:
                index.forget(unused)
        n = min(room, sizes[seed] - at)
        out.append((seed, at, n, sequence, size - room))
        room -= n
        left -= n
        at += n
        if at == sizes[seed]:
            to_ask.append(seed)
            seed = -1
    return out


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
                   cache_words: int = CACHE_WORDS) -> DataFrame:
    """One row for each piece of a document: where it stands in it and in its sequence."""
    path = tokenizer or default_tokenizer()
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("long"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("doc_id").to_pylist(), group.column("ids").to_pylist()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        kind = group.column("kind")[0].as_py()
        ids = [np.frombuffer(r[1], kind) for r in rows]
        shard = group.column("shard")[0].as_py()
        pieces = pack(ids, window)
        doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces))
        crc = [zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n, *_ in pieces]
        sizes = np.array([len(i) for i in ids], np.int64)
        return pa.table({
            "doc_id": pa.array([rows[d][0] for d in doc], pa.int64()), "start": start, "length": length,
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": sizes[doc], "sequence_id": (shard << 32) + sequence, "offset": offset})

    return tokenized(docs, path, shards, cache_words).groupBy("shard").applyInArrow(run, SCHEMA)
