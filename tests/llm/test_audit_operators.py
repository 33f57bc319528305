"""Manifest, filter audit and decontamination against brute force, edge rows and SQL."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.llm import decontaminate, filter_audit, merkle, queries, sql

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ manifest

MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def way_up(levels, at):
    for level in levels[:-1]:
        other = at ^ 1
        yield at & 1, level[other] if other < len(level) else None
        at >>= 1


def brute_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    for group in by.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
    trees = {v: tree_of([leaf_of(*r) for r in by[v]]) for v in langs}
    top = tree_of([trees[v][-1][0] for v in langs])
    for k, v in enumerate(langs):
        for at, r in enumerate(by[v]):
            path = [*way_up(trees[v], at), *way_up(top, k)]
            claimed = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                claimed = (*r[:4], r[4] + 1)
            folded = leaf_of(*claimed)
            for odd, other in path:
                folded = H(folded if other is None else other + folded if odd else folded + other)
            yield (r[0], leaf_of(*r), trees[v][-1][0], top[-1][0], H("".join(o for _, o in path if o)), folded,
                   folded == top[-1][0])


def manifest_rows(n):
    rnd = random.Random(1)
    rows = [(i, f"text é {i}", ["en", "de", None, ""][i % 4], "s", i) for i in range(n)]
    rows += [(-i * 7919, None, "negative", "s", None) for i in range(200)]
    rows += [(rnd.randrange(-2**63, 2**63), "", "wide", None, 3) for _ in range(n // 3)]
    rows += [(2**63 - 1, "x", "wide", "s", 2**63 - 1), (-2**63, "x", "wide", "s", 1), (5, "x", "alone", "a", 1)]
    rows += [(77, "copy", "en", "s", 1)] * 50 + [(77, "version", "en", "s", i) for i in range(40)]
    return rows + [(None, "n", "en", "s", 1)] * 5 + [(None, "m", None, "s", 1)]


def test_manifest_equals_brute_force(spark):
    rows = manifest_rows(4_500)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = rows_of(merkle.manifest(df, merkle.tampered_leaf(df)), MANIFEST)
    assert got == sorted(brute_manifest(rows), key=repr)
    assert not all(r[-1] for r in got)


def test_manifest_places_and_paths(spark):
    rows = [(i * 3, "t", "en", "s", 1) for i in range(2_100)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert sorted((r.doc_id, r.pos) for r in got) == [(i * 3, i) for i in range(2_100)]
    for r in got[::97]:
        assert len(r.path) == 12 * merkle.STEP  # 2,100 leaves: twelve levels
        assert merkle._fold(bytes.fromhex(r.leaf), bytes(r.path)).hex() == r.root and r.verified


def test_manifest_of_edge_rows(spark, docs, no_docs, clashing):
    got = rows_of(merkle.manifest(docs, merkle.tampered_leaf(docs)), MANIFEST)
    assert got == sorted(brute_manifest([tuple(r) for r in docs.collect()]), key=repr)
    assert rows_of(merkle.manifest(clashing, merkle.tampered_leaf(clashing)), MANIFEST) == got
    assert merkle.manifest(no_docs).count() == 0


# ------------------------------------------------------------------ filter audit

AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    found = []
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)),
            doc_id is not None and first[text] < doc_id)) if bad}
        found.append((lang or "", fails, doc_id in good, doc_id in toxic))
    for part in {f[0] for f in found}:
        here, removed = [f for f in found if f[0] == part], Counter()
        out = []
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed[f] += len(gone)
                out.append((f, "".join(order), step, len(left), len(gone), sum(f in d[1] for d in here) - len(gone),
                            sum(d[1] == {f} for d in here), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        yield from ((part, *o[1:], removed[o[0]]) for o in out)


def audit_rows():
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(150)] + ["LOUD", "VERY", "50%", "a|b"]
    rows = []
    for i in range(220):
        n = rnd.choice([0, 40, 99, 100, 101, 140])
        few = rnd.random() < 0.4
        text = " ".join(rnd.choice(vocabulary[:20] if few else vocabulary) if rnd.random() < 0.6 else f"u{k}" for k in range(n))
        rows.append((i * 3 % 201, rnd.choice([text, rows[-1][1] if rows else text]), rnd.choice(["en", "de", None, ""]), "s", 1))
    rows += [(None, "same text", "en", "s", 1), (900, "same text", "fr", "s", 1), (901, "same text", "en", "s", 1),
             (902, None, "en", "s", 1), (903, "", "en", "s", 1), (903, "", "en", "s", 1), (904, "\t\n\x0b\x0c\r word", "en", "s", 1)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 901, 2)] + [(4, 1, 1), (None, 1, 1), (6, None, None)]
    return rows, [(a, b, None if c is None else int(c)) for a, b, c in labels]


def test_audit_equals_brute_force(spark):
    rows, labels = audit_rows()
    got = filter_audit.corpus_audit(spark.createDataFrame(rows, DOCS).repartition(4),
                                    spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rows_of(got, AUDIT) == sorted(brute_audit(rows, labels), key=repr)


def test_audit_of_edge_rows(spark, docs, no_docs, clashing):
    labels = spark.createDataFrame([(103, 1, 0), (104, 0, 1)], "doc_id long, quality int, toxic int")
    want = sorted(brute_audit([tuple(r) for r in docs.collect()], [(103, 1, 0), (104, 0, 1)]), key=repr)
    assert rows_of(filter_audit.corpus_audit(docs, labels), AUDIT) == want
    assert rows_of(filter_audit.corpus_audit(clashing, labels), AUDIT) == want
    assert filter_audit.corpus_audit(no_docs, labels).count() == 0
    assert rows_of(filter_audit.corpus_audit(docs, labels.limit(0)), AUDIT)[0][7] == 0


def test_swaps_walk_every_order_and_keep_the_function():
    rnd = random.Random(9)
    for k in (1, 2, 3, 4, 5):
        counts = {m: (rnd.randint(0, 2), rnd.randint(0, 1), 0) for m in range(2**k)}
        diagram = filter_audit.Diagram(k, counts, (0, 0, 0))
        seen = {tuple(diagram.order)}
        for level in filter_audit.adjacent_swaps(k):
            diagram.swap(level)
            seen.add(tuple(diagram.order))
            for m in range(2**k):  # every mask still leads to its own weight
                at = diagram.root
                for i, f in enumerate(diagram.order):
                    at = diagram.nodes[i][at][m >> f & 1]
                assert diagram.weights[k][at] == counts[m]
        assert seen == set(itertools.permutations(range(k)))
    # Equal subfunctions are one node: a function of one filter has two nodes below its level, one elsewhere.
    plain = filter_audit.Diagram(3, {m: (m & 1, 0, 0) for m in range(8)}, (0, 0, 0))
    assert [len(n) for n in plain.nodes] == [1, 2, 2]


def test_audit_refuses_too_many_filters(spark):
    with pytest.raises(ValueError):
        filter_audit.audit(spark.createDataFrame([], "part string, mask int, documents long, good long, toxic long"), "ABCDEFG")


# ------------------------------------------------------------------ decontamination

DECON = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def simple_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_decontamination(texts, items, window=10):
    patterns = {}
    for item, text in items:
        words = simple_words(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            patterns.setdefault(tuple(words[i:i + n]), set()).add("" if item is None else str(item))
    lengths = {len(p) for p in patterns}
    for doc_id, text in texts:
        words, hit, found = simple_words(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                of = patterns.get(tuple(words[i:i + n]))
                if of:
                    hit.update(range(i, i + n))
                    found |= of
        yield doc_id, len(words), len(hit), len(found), H(",".join(sorted(found))), bool(hit)


def benchmark_rows():
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ä", "ß9"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 9, 10, 11, 30])))) for i in range(100, 140)]
    items += [(1, "One, two; THREE four five six seven eight nine ten eleven"), (1, "a second text of item one with ten whole words here"),
              (2, None), (3, " ... "), (None, "nameless item " * 6), (4, items[5][1]), (4, items[5][1])]
    texts = []
    for i in range(150):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 5, 60]))]
        if i % 3 == 0:
            words += (rnd.choice(items)[1] or "").split()
        texts.append((i, rnd.choice([" ", ", ", "\n"]).join(words)))
    texts += [(900, None), (901, ""), (902, "one two three four five six seven eight nine ten"), (903, "one two three four"),
              (None, "nameless item nameless item nameless item nameless item nameless item nameless"),
              (904, "filler words " * 40_000 + "ONE two three four five six seven eight nine ten eleven" + " more" * 300_000)]
    return texts + texts[:5], items


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 60])
def test_decontamination_equals_brute_force(spark, block_words):
    texts, items = benchmark_rows()
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(df, bench, block_words=block_words)
    assert rows_of(got, DECON) == sorted(brute_decontamination(texts, items), key=repr)
    if block_words < 100:
        assert decontaminate.blocks(bench, block_words=block_words)[1] > 5


def test_long_items_are_cut_without_losing_windows(spark):
    words = [f"x{i}" for i in range(2 * decontaminate.SEGMENT_WORDS + 40)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    texts = [(i, " ".join(words[i:i + 10])) for i in range(0, len(words) - 9, 7)] + [(10**6, " ".join(words))]
    got = decontaminate.decontaminate(spark.createDataFrame(texts, "doc_id long, text string"), bench, block_words=500)
    assert all(r.n_hit == r.n_words and r.items == ["1"] for r in got.collect())


def test_decontamination_of_edge_rows(spark, docs, no_docs, clashing):
    bench = spark.createDataFrame([(7, "same same same same same"), (8, "x")], "item_id long, text string")
    want = sorted(brute_decontamination([(r.doc_id, r.text) for r in docs.collect()], [(7, "same same same same same"), (8, "x")]), key=repr)
    assert rows_of(decontaminate.decontaminate(docs, bench), DECON) == want
    assert rows_of(decontaminate.decontaminate(clashing, bench), DECON) == want
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    none = decontaminate.decontaminate(docs, bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == docs.count()
    kept = decontaminate.decontaminate(docs, bench, keep_text=True).where(~F.col("contaminated"))
    assert set(docs.columns) < set(kept.columns) and kept.count() == docs.count() - 2


def test_search_skips_words_that_no_item_holds():
    patterns = decontaminate.Patterns([("1", 30, b" ".join(b"k%d" % i for i in range(30)))])
    table = patterns.lengths[10]
    looked = []
    table.shift = Looked(table.shift, looked)
    ids = decontaminate.array("i", [0] * 9_000)
    assert table.search(ids, set()) == [] and len(looked) == -(-(9_000 - 9) // 9)


class Looked(dict):
    def __init__(self, of, seen):
        super().__init__(of)
        self.seen = seen

    def get(self, key, default=None):
        self.seen.append(key)
        return super().get(key, default)


# ------------------------------------------------------------------ SQL

@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    from support import SF_SMALL

    found = queries.queries()[name](spark, SF_SMALL)
    cursor = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    want = sorted((tuple(r) for r in cursor.fetchall()), key=repr)
    assert rows_of(found, columns) == want and sql


@pytest.mark.parametrize("name", sorted(queries.base_oracle_sql()))
def test_base_query_equals_sql(spark, duck, name):
    from support import SF_SMALL

    found = queries.base_queries()[name](spark, SF_SMALL)
    cursor = duck.execute(queries.base_oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    want = sorted((tuple(r) for r in cursor.fetchall()), key=repr)
    assert rows_of(found, columns) == want and queries.base_oracle_sql()[name]
