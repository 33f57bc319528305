"""Operators over document texts, against brute force on the edge frame."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import boosting, lang_id, license_scan, license_texts, mixing, packing, pii, quality, simhash

WS = "[^\x20\x09-\x0d]+"


def _by_row(df, *columns):
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=repr)


def _texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


# --- SimHash

def _fingerprint(text):
    words = re.findall(WS, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(items, linked):
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_simhash_components_equal_brute_force(spark, docs):
    base = [(i, _prose_variant(i)) for i in range(1000, 1060)]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(base, "doc_id long, text string"))
    rows = _texts(more)
    prints = [_fingerprint(t) for _, t in rows]
    groups = _components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = sorted([(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, groups)], key=repr)
    assert _by_row(simhash.simhash_components(more), "doc_id", "fingerprint", "component_id") == want
    assert len(set(groups)) < len(set(prints))


def _prose_variant(i):
    words = [f"w{(i // 6) * 31 + k}" for k in range(400)]
    words[i % 6] = "other" if i % 6 else words[0]
    return " ".join(words)


def test_simhash_dedup_keeps_one_of_each_group(docs, clashing, no_docs):
    kept = simhash.simhash_dedup(docs).collect()
    comp = simhash.simhash_components(docs).collect()
    assert len(kept) == len({(r["component_id"]) for r in comp})
    assert sum(r["doc_id"] == 103 for r in kept) <= 1
    assert simhash.simhash_dedup(clashing).count() == len(kept)
    assert simhash.simhash_components(no_docs).count() == 0
    assert simhash.simhash_dedup(no_docs).columns == docs.columns


def test_ball_covers_radius():
    masks = simhash.ball(1)
    assert len(masks) == 65 and len({m & (1 << 64) - 1 for m in masks}) == 65


# --- PII

TEXT = ("Mail a.b+c@mail.example.com, a@b.c@d.e x@y..z 10.0.0.255 1.2.3.256 1.2.3.4.5 or 4539 1488 0343 6467 and 4539148803436469 "
        "+1 (386) 555-3733 +49 1 +12345678901234567 é@a.b")


def _base_by_regex(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        s = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def test_base_spans_equal_patterns():
    for text in (TEXT, "", "@", "a@b", "a@b.c.", "@@a@b.c", TEXT * 50, "1.2.3.4 5.6.7.8", "a@b.c" * 3):
        assert pii.base_spans(text) == _base_by_regex(text)
    rng = np.random.default_rng(4)
    for _ in range(3000):
        text = "".join(rng.choice(list("0012.. -+@a()"), rng.integers(1, 40)))
        assert pii.base_spans(text) == _base_by_regex(text), text
    assert [pii.KINDS[k] for _, k, _ in pii.base_spans(TEXT)] == ["email", "email", "ip", "ip", "card", "phone"]


def test_long_texts_take_time_in_proportion(spark, docs):
    import time

    model = pii.train(docs.union(spark.createDataFrame([(500, TEXT, "en", "s", len(TEXT))], docs.schema)))
    started = time.time()
    digits = "7" * 1_000_000
    assert pii.spans(digits, None) == ([], [])
    base, kept = pii.spans((TEXT + " (at) 12-34 56/78 90.12\n") * 2000, model)
    assert len(base) == 2000 * 6 and set(base) <= set(kept)
    words = license_scan.words_of("mit license " * 200_000)
    places = license_scan.scan(words, license_scan.compiled())[0]
    assert places == list(range(0, 400_000, 2))
    assert time.time() - started < 60


def test_pii_rows_and_redaction(spark, docs, clashing, no_docs):
    own = docs.union(spark.createDataFrame([(500, TEXT, "en", "s", len(TEXT))], docs.schema))
    model = pii.train(own)
    row = pii.find(own, model).where("doc_id = 500").first()
    base = pii.base_spans(TEXT)
    joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
    assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert set(joined.split(",")) <= set(row["spans"].split(","))
    assert [row[f"n_{k}"] for k in pii.KINDS] == [2, 2, 1, 1]
    empty = pii.find(own, model).where("doc_id = 100").first()
    assert (empty["spans"], empty["base_sha256"]) == ("", hashlib.sha256(b"").hexdigest())
    clean = pii.redact(own, model)
    assert clean.columns == own.columns
    got = clean.where("doc_id = 500").first()
    assert not pii.base_spans(got["text"]) and got["n_chars"] == len(got["text"]) and "[EMAIL]" in got["text"]
    assert pii.find(clashing, model).count() == docs.count()
    assert pii.train(no_docs) is None and pii.find(no_docs, None).count() == 0


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:600], y[:600])
    boosting.calibrate(model, x[600:], y[600:])
    p = model.probability(x[600:])
    assert ((p > 0.5) == y[600:]).mean() > 0.95 and 0 <= p.min() and p.max() <= 1


def test_pii_model_adds_what_the_patterns_miss():
    texts = [f"call me at +1 (2{i:02d}) 555-{1000 + i} or write to u{i}@mail{i % 9}.example.com token {i * 7919 % 99991:05d}a{i}" for i in range(400)]
    rows = [{"x": pii.features(t, c), "y": pii._covered(c, pii._by_kind(pii.base_spans(t)))} for t in texts for c in pii.candidates(t)]
    model = pii.fit(rows)
    assert model is not None
    base, kept = pii.spans("please write to jo.doe @ mail3.example.com today", model)
    assert not base and len(kept) <= 1


def _pii_corpus(spark):
    """Strict forms only, between prose."""
    rows = []
    for i in range(900):
        email, ip = f"{'jkmno'[i % 5]}{'aeiou'[i % 4]}{i % 70 or ''}@mail{i % 9 or ''}.{'example.' * (i // 4 % 2)}{('com', 'org', 'net')[i % 3]}", f"{i % 223 + 1}.{i * 7 % 256}.{i * 13 % 256}.{i * 31 % 256}"
        card = f"4{i * 7919 % 10**7:07d}{i * 104729 % 10**7:07d}"
        card += next(c for c in "0123456789" if pii.luhn(card + c))
        value = (email, ip, card, f"+1 ({200 + i % 700}) 555-{i * 37 % 10000:04d}")[i % 4]
        rows.append((f"and then the words {'stay go come leave'.split()[i % 3]} {value} so it went on and on",))
    return spark.createDataFrame(rows, "text string")


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii.train(_pii_corpus(spark))


@pytest.mark.parametrize("text, added", [
    ("please write to jo.doe @ mail3.example.com today", "jo.doe @ mail3.example.com"),
    ("contact jo (at) mail (dot) com now", "jo (at) mail (dot) com"),
    ("tel 555-123-4567 please", "555-123-4567"),
    ("the host 10 . 0 . 0 . 255 is up", "10 . 0 . 0 . 255"),
    ("the card 4111.1111.1111.1111 of theirs", "4111.1111.1111.1111"),
    ("the card 4111.1111.1111.1112 of theirs", None), ("order no. 5551234567 was sent", None), ("version 1. 2. 3. 4 is out", None),
    ("we met @ noon. Then we left", None), ("on 2020-12-31 we left", None)])
def test_pii_trees_add_loose_forms_only(pii_model, text, added):
    base, kept = pii.spans(text, pii_model)
    assert not base and [text[s:e] for s, _, e in kept] == ([added] if added else [])


def test_pii_candidates_overlap():
    def texts(text, kind):
        return {text[s:e] for s, k, e in pii.candidates(text) if k == kind}

    assert {"555-123-4567", "555-987-6543"} <= texts("tel 555-123-4567 555-987-6543", 3)
    assert "4111 1111 1111 1111" in texts("4111 1111 1111 1111 12/27 123", 2)
    assert texts("1. 2. 3. 4. 5", 1) == {"1. 2. 3. 4", "2. 3. 4. 5"}
    assert texts("--a.b @ c.de.f", 0) == {x + " @ " + y for x in ("--a.b", "a.b", "b") for y in ("c.de", "c.de.f")}
    rng = np.random.default_rng(6)
    for _ in range(300):
        text = "".join(rng.choice(list("00123456789 .-/()x"), rng.integers(1, 60)))
        groups = [m.span() for m in re.finditer("[0-9]+", text)]
        for kind, least, most in ((2, 12, 20), (3, 7, 15)):
            want = {(groups[i][0], groups[j][1]) for i in range(len(groups)) for j in range(i, len(groups))
                    if all(re.fullmatch("[ ()./-]{1,3}", text[groups[k][1]:groups[k + 1][0]]) for k in range(i, j))
                    and least <= sum(b - a for a, b in groups[i:j + 1]) <= most}
            assert {(s + (text[s] == "("), e) for s, k, e in pii.candidates(text) if k == kind} == want, text


@pytest.mark.parametrize("datum", ["jo (at) a.b.c.d.e.f.g.h.com", "abcdefg." * 9 + "z (at) mail.example.com"])
def test_pii_long_addresses_are_taken_whole(pii_model, datum):
    for text in (f"Please write to {datum} now", f"Please write to {datum}. Then we meet"):
        at = text.index(datum)
        proposed = {(s, e) for s, k, e in pii.candidates(text) if k == 0}
        assert (at, at + len(datum)) in proposed
        assert all(e >= at + len(datum) for _, e in proposed) or datum.startswith("abc")
        assert all(s == at for s, _ in proposed) or datum.startswith("jo")
    text = f"please write to {datum} today"
    assert [text[s:e] for s, k, e in pii.spans(text, pii_model)[1] if k == 0] == [datum]


@pytest.mark.parametrize("text, added", [("tel 555-123-4567 555-987-6543", ["555-123-4567", "555-987-6543"]),
                                         ("paid 4111 1111 1111 1111 12/27 123 ok", ["4111 1111 1111 1111"])])
def test_pii_neighbouring_numbers_are_found(pii_model, text, added):
    base, kept = pii.spans(text, pii_model)
    assert not base and [text[s:e] for s, _, e in kept] == added


# --- licences

def test_license_words_and_places(docs, clashing, no_docs):
    rows = {r["doc_id"]: r for r in license_scan.license_scan(docs).collect()}
    for i, text in _texts(docs):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        assert rows[i]["n_words"] == len(words)
    assert rows[100]["n_words"] == 0 and rows[100]["first_word"] is None and rows[100]["labels"] == ""
    assert license_scan.license_scan(clashing).count() == docs.count()
    assert license_scan.license_scan(no_docs).count() == 0


@pytest.mark.parametrize("text, places, base, labels, score", [
    ("Licensed under the Apache License, Version 2.0.", [3], "apache", "apache,apache-2.0-notice", 1.0),
    ("Licensed under the Apache License 2.0", [3], "apache", "apache,apache-2.0-notice", 1.0),
    ("licensed under the apache license, version 3", [3], "apache", "apache", None),
    ("mit license mit license", [0, 2], "mit", "mit", 0.5),
    ("MIT-License", [0], "mit", "mit", 0.5), ("xmit license", [], "", "", 0.0), ("mité license", [], "", "", 0.0),
    ("This work is licensed under the GNU General Public License, version 3.", [7], "gpl", "gpl,gpl-3.0-notice", 1.0),
    ("Copyright 2020 A B. All rights reserved", [], "", "all-rights-reserved", 1.0), ("", [], "", "", 0.0)])
def test_license_templates(text, places, base, labels, score):
    got = license_scan.scan(license_scan.words_of(text), license_scan.compiled())
    assert sorted(got[0]) == places and ",".join(sorted(got[1])) == base and ",".join(sorted(got[1] | got[2])) == labels
    assert got[3] == score if score is not None else 0.5 <= got[3] < 1


@pytest.mark.parametrize("version, labels", [("v. 2.0", {"mpl-2.0-notice"}), ("v. 1.1", set()), ("v.", set())])
def test_license_version_is_mandatory(version, labels):
    text = f"This Source Code Form is subject to the terms of the Mozilla Public License, {version} If a copy"
    got = license_scan.scan(license_scan.words_of(text), license_scan.compiled())
    assert set(got[2]) == labels and (got[3] == 1) == bool(labels)


BSD = [license_texts.BSD_CONDITIONS, license_texts.BSD_ADVERTISING, license_texts.BSD_NAMES, license_texts.BSD_DISCLAIMER]


def whole_text(wording, holder="the widget authors"):
    """A licence as it stands in a file: regions without marks, any-word regions filled where a name belongs."""
    wording = re.sub(r"<<any: 1 >>", "", wording)
    return re.sub(r"<<any: \d+ >>", holder, wording).replace("<<opt:", "").replace(">>", "")


@pytest.mark.parametrize("label", sorted(license_texts.WHOLE))
def test_whole_licences(label):
    """The whole text is accepted under its own label alone, an altered or cut one is not, wherever it is altered."""
    by_start = license_scan.compiled()
    labels = lambda text: {x for x in license_scan.scan(license_scan.words_of(text), by_start)[2] if x.endswith("-text")}
    text = whole_text(license_texts.WHOLE[label])
    assert labels(text) == labels("Copyright (c) 2020 Jo. " + text.upper() + " Thanks to all.") == {label}
    words = text.split()
    for at in (3, len(words) // 2, len(words) - 8, len(words) - 1):
        assert labels(" ".join(words[:at] + ["wholly", "altered", "wording"] * 10 + words[at + 1:])) == set()
    assert labels(" ".join(words[:-1])) == set()


def test_clauses_tell_the_bsd_licences_apart():
    by_start = license_scan.compiled()
    for clauses, label in (((0, 3), "bsd-2-clause-text"), ((0, 2, 3), "bsd-3-clause-text"), ((0, 1, 2, 3), "bsd-4-clause-text"), ((0, 2), None)):
        text = " ".join(f"{k + 1}. {whole_text(BSD[c])}" if k and c < 3 else whole_text(BSD[c]) for k, c in enumerate(clauses))
        found = license_scan.scan(license_scan.words_of(text), by_start)[2]
        assert found == {"bsd-redistribution", *([label] if label else [])}


def test_automaton_regions():
    a = license_scan.Automaton("a <<opt: b <<any: 1 >> >> c")
    assert [a.run(x.encode().split(), 0)[0] for x in ("a c", "a b c", "a b z c", "a b z z c", "a z c")] == [True, True, True, False, False]


# --- quality

def _measures(text):
    w = re.findall(WS, text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(WS, x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_quality_measures_equal_brute_force(spark, docs, no_docs, clashing):
    more = [(200 + i, t, "en", "s0", 0) for i, t in enumerate((
        "a b c a b c", "a b c x a b c", "a a a a", "a b c", "l1\nl1\n\n \nl2\nl2 \n\x0b\nl1", "#*$%&|<> x # y", "a b a b a b a", "b\x1fc d\x85e f"))]
    own = docs.union(spark.createDataFrame(more, docs.schema))
    got = quality.quality_filter(own)
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = sorted([(i, *(m := _measures(t)), m[0] < 50 or 100 * m[4] > 50 * m[0]) for i, t in _texts(own)], key=repr)
    assert _by_row(got, "doc_id", *cols, "base_failed") == want
    assert got.where("base_failed and kept").count() == 0
    assert quality.quality_filter(no_docs).count() == 0
    assert quality.quality_filter(clashing).count() == docs.count()


def test_quality_repeats_compare_words(spark, monkeypatch):
    """With a hash of few values many windows collide; only equal words are repeats."""
    texts = ["a b c d e f g h a b c", "one two three four five six", "x y x y x y", "p q r s p q r s t u p q r", _prose_variant(1), _prose_variant(2) * 2]
    good = F.xxhash64
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.pmod(good(*c), F.lit(2)))
    own = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.measures(own, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        w = re.findall(WS, text)
        n = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
        covered = {j + k for j in range(len(w) - 2) if n[tuple(w[j:j + 3])] > 1 for k in range(3)}
        assert got[i] == len(covered), text


def test_quality_bounds_follow_the_groups(spark):
    rows = [(i, " ".join([f"w{i}x{k}" for k in range(60)]) + " ##" * (i % 3), "en", "a" if i % 2 else "b", 0) for i in range(600)]
    rows += [(1000, " ".join(f"q{k} ####" for k in range(60)), "en", "a", 0)]
    got = quality.quality_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert [r["doc_id"] for r in got.where("not kept").collect()] == [1000]


def test_quality_plan_is_native(docs):
    plan = quality.measures(docs, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- language

def test_language_on_held_out_rows(spark):
    from larder.llm.common import table

    own = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = lang_id.train(own)
    got = lang_id.identify(own, model).withColumn("held", lang_id.held_out(F.col("doc_id")))
    right = got.where("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert got.where("score < 0 or score > 1").count() == 0
    held = {r["doc_id"] for r in got.where("held").collect()}
    assert held == {r["doc_id"] for r in own.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert lang_id.drop_rejected(own, model).count() >= 0.98 * own.count()


def test_language_edges(docs, clashing, no_docs):
    model = lang_id.train(docs)
    rows = {r["doc_id"]: r for r in lang_id.identify(docs, model).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["rejected"] for i in (100, 101, 102, 106))
    assert rows[105]["lang_pred"] in ("en", "xx") and rows[107]["lang_pred"] in ("en", "xx")
    assert lang_id.identify(clashing, model).count() == docs.count()
    assert lang_id.train(no_docs) is None
    assert {r["lang_pred"] for r in lang_id.identify(docs, None).collect()} == {"und"}
    assert lang_id.drop_rejected(docs, model).columns == docs.columns


def test_language_score_is_the_whole_texts(docs):
    model = lang_id.train(docs)
    letters = lang_id._letters()
    texts = [t for _, t in _texts(docs) if lang_id.LETTER.search(t)]
    got = lang_id._scorer(model)()(texts)
    for t, name, s in zip(texts, got["lang_pred"], got["score"]):
        g = lang_id._grams(t, letters).astype(np.int64)
        p = lang_id._softmax((model.table[g].sum(0, dtype=np.float64) / max(1, len(g)) + model.bias) / model.temperature)
        assert abs(p.max() - s) < 1e-4 and model.langs[int(p.argmax())] == name or np.sort(p)[-1] - np.sort(p)[-2] < 1e-4


# --- mixing

def _targets(sizes, most=3):
    """By hand: shared by weight, the excess over a limit shared again until none is above."""
    weights = [1 + i % 3 for i in range(len(sizes))]
    out, left, open_ = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        for i in over or open_:
            out[i] = float(most * sizes[i]) if over else unit * weights[i]
            left -= out[i]
        open_ -= over or open_
    return out


def _source_rows(spark, sizes):
    names = [f"s{i:06d}" for i in range(len(sizes) - 1)] + [None] * bool(sizes)
    totals = spark.createDataFrame([(n, w) for n, size in zip(names, sizes) for w in (size - size // 3, size // 3)], "source string, words long")
    return names, sorted(mixing._sources(totals, 64).collect(), key=lambda r: r["sid"])


def test_targets(spark):
    rng = np.random.default_rng(5)
    for sizes in ([100, 100, 100], [1, 1000, 10, 0], [], [0, 0], [7], [int(x) for x in rng.lognormal(6, 3, 3000)]):
        names, got = _source_rows(spark, sizes)
        assert [r["source"] for r in got] == names and [r["size"] for r in got] == sizes
        assert [r["target"] for r in got] == pytest.approx(_targets(sizes))
        assert all(r["blocks"] == -(-r["size"] // 64) for r in got)
        assert all(r["draws"] == (round(r["target"] * r["blocks"] / r["size"]) if r["size"] else 0) for r in got)


def test_permutation_is_one(size=1000):
    i = np.arange(size)
    for n in (1, 2, 3, 64, 999, 1000):
        got = mixing.permuted(i[:n], np.full(n, n), np.full(n, 77))
        assert sorted(got) == list(range(n))


def test_draw_meets_the_totals(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RUN_SLOTS", 500)
    want = {0: 5, 1: 0, 2: 9000, 3: 1234}
    sources = spark.createDataFrame([(s, 40, n) for s, n in want.items()], "sid long, blocks long, draws long")
    rows = [tuple(r) for r in mixing._slots(sources, shard_slots=100).collect()]
    for s, n in want.items():
        own = sorted(r[2:] for r in rows if r[1] == s)
        assert [number for number, _ in own] == list(range(n))
        for at in range(0, n - 39, 40):  # a pass holds every block once
            assert sorted(b for _, b in own[at:at + 40]) == list(range(40))
    assert {r[0] for r in rows} <= set(range(103))
    assert sorted(rows) == sorted(tuple(r) for r in mixing._slots(sources.repartition(3), shard_slots=100).collect())
    # multinomial counts: chi square of the large source over the shards, 102 degrees of freedom
    counts = np.bincount([r[0] for r in rows if r[1] == 2], minlength=103)
    assert 55 < ((counts - 9000 / 103)**2 / (9000 / 103)).sum() < 165


def test_mix_of_many_sources(spark):
    """One source a document: nothing a source passes through the driver."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host"), "id").alias("source"),
                                      F.expr("repeat('a word ', cast(1 + id % 50 as int))").alias("text"))
    got = mixing.taken_words(docs).collect()
    assert len(got) == 20_000 and all(0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == r["size"] for r in got)
    order = sorted(got, key=lambda r: f"host{r['doc_id']}")
    assert [r["target"] for r in order] == pytest.approx(_targets([r["size"] for r in order]))
    assert all(abs(r["taken"] - r["target"]) <= 64 for r in got)


def test_mix_takes_what_it_should(docs, clashing, no_docs):
    got = mixing.taken_words(docs)
    rows = got.collect()
    size = {i: len(re.findall(WS, t)) for i, t in _texts(docs)}
    assert len(rows) == docs.count() and all(r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.taken_words(docs).collect()))
    by = got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 2 * mixing.BLOCK_WORDS for r in by)
    total = sum(r["taken"] for r in rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(re.findall(WS, r["text"])) for r in out.collect()) == total
    assert sum(len(r["words"]) for r in mixing.mixed_blocks(docs).collect()) == total
    assert mixing.taken_words(clashing).count() == docs.count() and mixing.mixed_documents(clashing).count() == out.count()
    assert mixing.taken_words(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


# --- packing

def test_packing_round_trip(docs, clashing, no_docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_tokenizer())
    got = packing.pack_documents(docs, shard_bytes=4000).collect()
    ids = {}
    for i, t in _texts(docs):
        ids.setdefault(i, []).append(whole.encode(t, add_special_tokens=False).ids + [1])
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(r["length"] for r in got) == total
    for r in got:
        own = ids[r["doc_id"]][0]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at.bit_count() == 1
    assert sum(r["length"] for r in packing.pack_documents(clashing).collect()) == total
    assert packing.pack_documents(no_docs).count() == 0


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_tokenizer())
    encode, kind = packing.encoder(packing.default_tokenizer())
    for t in ("a\x1cb c's don't 'LL it'S x", "Ünï cödé, ÀÉ. ß ÿ Ÿ ªº µ", "İstanbul ΣΑΣ", "é äx <|endoftext|>", "hello <|startoftext|> x", "a<|endoftext|><|startoftext|>b <|ENDOFTEXT|>", "<|endoftext|>", "e<|endoftext|>\u0301",
              "12 3,4. ... ,. a.b,c 中文 🙂",
              "\u0085 \x0b\x0c\x1d", "Ã© é Ã©", "it's THEY'LL a'b 'tis x=\"1\" naïve's çà,, d'É", "x" * 300 + " .", "²½ ¼x", "", "Ā ſ ŉ Œ œ"):
        assert np.frombuffer(encode(t), kind).tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_neighbours_come_first():
    docs = [np.array([5, 6, 7, 1], np.uint16), np.array([50, 51, 52, 1], np.uint16), np.array([60, 61, 1], np.uint16),
            np.array([5, 6, 90, 1], np.uint16), np.array([70, 71, 72, 1], np.uint16)]
    index = packing.Index(docs)
    assert index.neighbours(0, np.array([0, 1, 1, 1, 1])).tolist() == [3]
    assert [p[0] for p in packing.pack(docs, window=8)][:2] == [0, 3]


def test_neighbours_by_any_term_and_of_later_documents():
    def doc(*terms):
        return np.array([*terms, 1], np.uint16)

    # the seed's last term is its lightest of 40, and only document 5 shares one
    rare, filler = range(100, 139), [doc(900 + i, 950 + i) for i in range(4)]
    docs = [doc(*[t for t in rare for _ in range(3)], 500), *filler, doc(500, 501), doc(700, 701)]
    assert packing.Index(docs).neighbours(0, np.ones(7) * (np.arange(7) > 0)).tolist() == [5]
    # 0 shares with 4, 4 with 5, 5 with 6; the others share nothing
    docs = [doc(10, 11), doc(20, 21), doc(30, 31), doc(40, 41), doc(11, 12), doc(12, 13), doc(13, 14), doc(50, 51), doc(60, 61)]
    assert [p[0] for p in packing.pack(docs, window=16)][:6] == [0, 4, 5, 6, 1, 2]


def test_unlike_short_documents_pack_in_proportion():
    import time

    started = time.time()
    docs = [np.array([2 + i % 60000, 2 + (i * 7 + 1) % 60000, 1], np.uint16) for i in range(60_000)]
    assert len({p[0] for p in packing.pack(docs)}) == 60_000 and time.time() - started < 30


def test_quality_limits_repeat_at_any_partitioning(spark):
    """Limits and verdicts are equal bit for bit on reruns, and the fences are those of exact quartiles but for the sketch's error."""
    import math
    import random

    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["alpha", "be", "gammas", "#", "delta-", "x" * rnd.randint(1, 9)]) + str(rnd.randint(0, 400))
                         for _ in range(rnd.randint(45, 90))), ("en", "de", None)[i % 3], ("a", "b")[i % 2], 1) for i in range(1_500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    results = [sorted(map(tuple, quality.quality_filter(df.repartition(n)).collect())) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2]
    got = quality.quality_filter(df, ["doc_id", "lang", "source"]).collect()
    for lang in ("en", "de", None):
        for source in ("a", "b"):
            group = [r for r in got if r.lang == lang and r.source == source]
            fit = sorted(r.word_length for r in group if not r.base_failed)
            if len(fit) >= quality.LEAST_ROWS:
                q1, q3 = (fit[math.ceil(p * len(fit)) - 1] for p in (0.25, 0.75))
                want = q3 + quality.FENCE * max(q3 - q1, quality.FLOOR["word_length"])
                assert all(abs(r.limit_word_length - want) < 0.01 * want for r in group)


def test_mixed_documents_meet_their_parts_by_shuffle_at_any_size(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('s', id % 4) AS source", "repeat(concat('w', id, ' '), 90) AS text")
    out = mixing.mixed_documents(docs)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan


def test_packing_index_forgets_used_documents_and_finds_the_same():
    draw = np.random.default_rng(3)
    docs = [np.append(draw.integers(2, 400, draw.integers(0, 60)), 1).astype(np.uint16) for _ in range(200)]
    whole, short, unused = packing.Index(docs), packing.Index(docs), np.ones(200, bool)
    unused[draw.permutation(200)[:150]] = False
    short.forget(unused)
    assert len(short.doc) < len(whole.doc) / 2 and set(short.doc.tolist()) <= set(np.flatnonzero(unused).tolist())
    for seed in range(200):
        shared = [d for d in np.flatnonzero(unused) if np.isin(whole.terms[whole.bounds[seed]:whole.bounds[seed + 1]], docs[d][:-1]).any()]
        got = whole.neighbours(seed, unused).tolist()
        assert got == short.neighbours(seed, unused).tolist() and sorted(got) == shared


def test_encoder_of_new_words_equals_the_tokenizer():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    encode, kind = packing.encoder(path, cache_words=5)
    whole = Tokenizer.from_file(path)
    for text in ("Abc abc, ABC. abc abc", "ciónes. Ciónes, \u00df\u00e4\u00b5 \u00aa\u00ba. \u212aelvin \u0130a \u00ff\u00ff.", ". , .. a.b, don't 12, x" + "y" * 90,
                 "\u4e2d\u6587 mixed\u4e2d. stra\u00dfe, \u00d7 \u00f7."):
        got = np.frombuffer(encode(text), kind).tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids
