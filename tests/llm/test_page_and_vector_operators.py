"""URL filter, HTML extraction, embedding near-duplicates, components, the pipeline."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from larder.llm import common, embed_dedup, html_extract, url_filter
from larder.llm.common import components, table


# --- components

def test_components_equal_union_find(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(-5, 2000), (7, 7)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x: find(x) for x in parent if any(a != b and x in (a, b) for a, b in links)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- URLs

@pytest.mark.parametrize("url, host, path", [
    (None, "", ""), ("x", "", ""), ("http://A.b?x", "a.b", ""), ("http://a.B/c?d#e", "a.b", "/c"), ("://h#/x", "h", ""), ("http:///p", "", "/p"),
    ("HTTP://É.org/a://b", "É.org", "/a://b")])
def test_url_parts(url, host, path):
    assert url_filter.parts(url) == (host, path)


@pytest.mark.parametrize("host, path, rule", [
    ("net", "/", ("net/", "block")), ("a.net", "", (None, None)), ("example.net", "/en/x", ("example.net/en/", "allow")),
    ("xexample.net", "/en/", ("net/", "block")), ("m.example.org", "/fr/", ("org/fr/", "allow")), ("a.example.com", "/de/", ("example.com/de/", "block")),
    ("example.com", "/de", (None, None)), ("", "/", (None, None))])
def test_url_rules(host, path, rule):
    assert url_filter.rule_for(host, path, url_filter.by_host()) == rule


def test_url_models_tell_the_labelled_apart(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    model = url_filter.train(pages)
    got = url_filter.url_filter(pages, model)
    ruled = got.where("rule is not null")
    right = ruled.agg(F.avg(((F.col("score") >= model.threshold) == (F.col("verdict") == "allow")).cast("int"))).first()[0]
    assert right > 0.95
    assert got.where("verdict not in ('allow', 'block') or verdict is null").count() == 0


# The models in dense arrays by hashed contexts, for small tables: the written counts are held against them.
HASHED = 1 << 14
CONTEXTS = [min(url_filter.SYMBOLS**k, HASHED) if k > 2 else url_filter.SYMBOLS**k for k in range(url_filter.ORDER + 1)]
STARTS = np.concatenate([[0], np.cumsum(CONTEXTS)])
SLOTS = int(STARTS[-1]) * url_filter.SYMBOLS


def slots(urls: list[bytes], symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count slots (order, character) of the URLs laid end to end, and the URLs' lengths (with an end mark)."""
    joined = b"".join(b"\0" * url_filter.ORDER + u + b"\n" for u in urls)
    codes = symbols[np.frombuffer(joined, np.uint8)]
    codes[np.frombuffer(joined, np.uint8) == 0] = 0
    n = np.array([len(u) + 1 for u in urls], np.int64)
    ends = np.cumsum(n + url_filter.ORDER)
    real = np.ones(len(codes), bool)
    real[(ends - n - url_filter.ORDER)[:, None] + np.arange(url_filter.ORDER)] = False
    at = np.flatnonzero(real)
    out = np.empty((url_filter.ORDER + 1, len(at)), np.int64)
    context = np.zeros(len(at), np.int64)
    for k in range(url_filter.ORDER + 1):
        if k:
            context = context * url_filter.SYMBOLS + codes[at - k]
        own = context if CONTEXTS[k] == url_filter.SYMBOLS**k else (context * 0x9E3779B1 >> 11) % CONTEXTS[k]
        out[k] = (STARTS[k] + own) * url_filter.SYMBOLS + codes[at]
    return out, n


class DenseModel:
    """Both classes' counts in dense arrays, summed per context."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.reshape(2, -1, url_filter.SYMBOLS)
        self.total = self.counts.sum(2)
        self.kinds = (self.counts > 0).sum(2).astype(np.float32)

    def scores(self, urls: list[bytes], symbols: np.ndarray) -> np.ndarray:
        """Mean log-likelihood difference per character, accepted minus rejected."""
        if not urls:
            return np.zeros(0)
        slot, n = slots(urls, symbols)
        logs = []
        for c in range(2):
            p = np.full(slot.shape[1], 1 / url_filter.SYMBOLS)
            for k in range(url_filter.ORDER + 1):
                context = slot[k] >> 6
                kinds, total = self.kinds[c][context], self.total[c][context]
                p = (self.counts[c].ravel()[slot[k]] + kinds * p + 1e-9 * p) / (total + kinds + 1e-9)
            logs.append(np.log(p))
        return np.add.reduceat(logs[0] - logs[1], np.concatenate([[0], np.cumsum(n)[:-1]])) / n


def test_url_scores_equal_a_direct_model():
    """The counts' interpolation, character by character."""
    symbols = url_filter._symbols()
    train = [[b"http://a.org/x", b"http://b.org/y"], [b"http://a.net/zz"]]
    counts = np.zeros((2, SLOTS), np.float32)
    for c in range(2):
        counts[c] = np.bincount(slots(train[c], symbols)[0].ravel(), minlength=SLOTS)
    model = DenseModel(counts)
    url = b"http://a.org/zz"
    logs = np.zeros(2)
    for c in range(2):
        seen = [u + b"\n" for u in train[c]]
        for i, ch in enumerate(url + b"\n"):
            p = 1 / 64
            for k in range(url_filter.ORDER + 1):
                before = (b"\0" * 4 + url)[i + 4 - k:i + 4]
                after = [s[j] for s in seen for j in range(len(s)) if (b"\0" * 4 + s)[j + 4 - k:j + 4] == before]
                kinds = len(set(after))
                p = (after.count(ch) + kinds * p + 1e-9 * p) / (len(after) + kinds + 1e-9)
            logs[c] += np.log(p)
    assert model.scores([url], symbols)[0] == pytest.approx((logs[0] - logs[1]) / (len(url) + 1), abs=1e-4)


def test_url_scores_equal_exact_counts(spark):
    """Far more contexts than any fixed table: each URL's score is that of exact counts."""
    rng = np.random.default_rng(2)

    def name():
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789-_~"), 30))

    urls = [f"http://{name()}.{('net', 'org')[i % 2]}/{('', 'fr/')[i % 2]}{name()}" for i in range(1200)] + [None, "http://a.example/q", "http://a.example/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    model = url_filter.train(pages)
    got = {r["page_id"]: r for r in url_filter.url_filter(pages, model).collect()}
    hosts = url_filter.by_host()
    verdicts = [url_filter.rule_for(*url_filter.parts(u), hosts)[1] for u in urls]
    counts = {"allow": {}, "block": {}}
    for u, v in zip(urls, verdicts):
        if v and not url_filter._fold([u.encode()])[0]:
            text = "\0" * 4 + u + "\n"
            for i in range(4, len(text)):
                for k in range(5):
                    after = counts[v].setdefault(text[i - k:i], {})
                    after[text[i]] = after.get(text[i], 0) + 1
    assert len({c for v in counts.values() for c in v if len(c) == 4}) > 1 << 14
    for j in [*range(0, 1200, 40), 1200, 1201, 1202]:
        text, logs = "\0" * 4 + (urls[j] or "") + "\n", []
        for v in counts.values():
            total = 0.0
            for i in range(4, len(text)):
                p = 1 / 64
                for k in range(5):
                    after = v.get(text[i - k:i], {})
                    p = (after.get(text[i], 0) + len(after) * p + 1e-9 * p) / (sum(after.values()) + len(after) + 1e-9)
                total += np.log(p)
            logs.append(total)
        assert got[j]["score"] == pytest.approx((logs[0] - logs[1]) / (len(text) - 4), abs=1e-6), urls[j]
        assert got[j]["verdict"] == (verdicts[j] or ("allow" if got[j]["score"] >= model.threshold else "block"))


def url_scores(spark, urls, model):
    numbered = spark.createDataFrame([(i, u, 1, 0) for i, u in enumerate(urls)], "row long, url string, times long, c int")
    return url_filter.scores(numbered, model)


@pytest.fixture(scope="module")
def trained_urls(spark):
    urls = [f"http://{'abcdefgh'[i % 8]}{i}.{('net', 'org')[i % 2]}/{('', 'fr/')[i % 2]}{i * 7919}" for i in range(300)]
    return urls, url_filter.train(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))


def test_url_scoring_sends_one_table_and_joins_characters_once(spark, trained_urls):
    """The counts' orders are grouped, not joined one by one: the many broadcasts took the driver past its memory."""
    urls, model = trained_urls
    plan = url_scores(spark, urls, model)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len([x for x in plan.splitlines() if "Join " in x]) <= 3 and "_salt" not in plan
    assert plan.count("BroadcastExchange") <= 3
    ratios = url_filter.ratios(model.runs.select("run", F.lit(1).cast("long").alias("n")), model)._jdf.queryExecution().executedPlan().toString()
    assert "Join " not in ratios and ratios.count("Exchange") == 1


@pytest.mark.parametrize("parts", [1, 40, 1 << 40])
def test_url_scores_do_not_depend_on_what_is_frequent(spark, trained_urls, monkeypatch, parts):
    """Each character meets its run once, whether none, some or all runs are sent to all tasks."""
    urls, model = trained_urls
    want = {r["row"]: r["score"] for r in url_scores(spark, urls, model).collect()}
    monkeypatch.setattr(url_filter, "FREQUENT", parts)
    assert {r["row"]: r["score"] for r in url_scores(spark, urls, model).collect()} == want and len(want) == len(urls)


def test_url_run_probabilities_are_those_of_their_context(spark, trained_urls):
    """By plain sums over all counted runs; a run that was never counted is not lost."""
    _, model = trained_urls
    counted = {r["run"]: (r["n0"], r["n1"]) for r in model.runs.collect()}
    asked = [*sorted(counted)[::97], 0, (1 << 30) - 1]
    rows = spark.createDataFrame([(r, 2) for r in asked], "run long, n long")
    got = {r["run"]: (r["n"], r["ratio"]) for r in url_filter.ratios(rows, model).collect()}
    assert set(got) == set(asked) and {n for n, _ in got.values()} == {2}
    for run in asked:
        p = [1 / 64, 1 / 64]
        for k in range(url_filter.ORDER + 1):
            cut = (1 << 6 * (k + 1)) - 1
            for c in range(2):
                after = {}
                for r, n in counted.items():
                    if (r & cut) >> 6 == (run & cut) >> 6 and n[c]:
                        after[r & 63] = after.get(r & 63, 0) + n[c]
                p[c] = (after.get(run & 63, 0) + len(after) * p[c] + 1e-9 * p[c]) / (sum(after.values()) + len(after) + 1e-9)
        assert got[run][1] == pytest.approx(np.log(p[0]) - np.log(p[1]), abs=1e-12)


def test_url_edges(spark):
    rows = [(1, None), (2, ""), (3, "http://a.net/x" * 500), (4, "http://a.net/x"), (4, "http://a.net/x"), (None, "é\0")]
    own = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1)).withColumn("score", F.lit("s"))
    assert url_filter.train(own) is None
    got = url_filter.url_filter(own, None)
    assert got.count() == 6 and {r["verdict"] for r in got.where("rule is null").collect()} == {"allow"}
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.train(none) is None and url_filter.url_filter(none, None).count() == 0


# --- HTML

@pytest.fixture(scope="module")
def model(spark):
    return html_extract.train(table(spark, "/root/testdata/sf0.01", "pages"))


@pytest.mark.parametrize("page, text", [
    ("<article><h1>A &amp; B</h1><p>one\n two<br>three.</p><p>four, <b>five<p>six.</article><footer>no</footer>", "A & B\none two three.\nfour, five\nsix."),
    ("<body><nav><ul><li><a href=/>Menu</a></li></ul></nav><article><p>Text &am here.</p></article></body>", "Text &am here."),
    ("", ""), (None, ""), ("<script>var t='</p>';</script><style>p{}</style>", "")])
def test_html_text(model, page, text):
    assert html_extract.extract([page], model) == [text]


def test_html_cut_page_and_order(model):
    page = "<html><body><div class='ad'>Buy.</div><article><h1>Head</h1><p>First one, yes.</p><ul><li>a, b.<li>c.</ul><p>Last on"
    assert html_extract.extract([page], model)[0] == "Head\nFirst one, yes.\na, b.\nc.\nLast on"


def test_marginals_equal_enumeration():
    tree = html_extract.parse("<body><div><p>a</p><p>b</p></div><nav>c</nav></body>")
    forest = html_extract.Forest([tree])
    rng = np.random.default_rng(3)
    w, pair = rng.normal(size=html_extract.N_FEATURES), rng.normal(size=(2, 2))
    p, joint, z = forest.marginals(w, pair)
    n = len(tree.parent)
    total, ones = 0.0, np.zeros(n)
    for state in range(1 << n):
        y = [(state >> i) & 1 for i in range(n)]
        s = sum((forest.x[i] @ w) * y[i] for i in range(n)) + sum(pair[y[q], y[i]] for i, q in enumerate(tree.parent) if q >= 0)
        total += np.exp(s)
        ones += np.exp(s) * np.array(y)
    assert np.allclose(p, ones / total) and z[0] == pytest.approx(np.log(total))


def test_html_formulas_are_inline_text(model):
    page = "<body><nav><a href=/>Menu</a></nav><article><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds, as seen.</p></article></body>"
    assert html_extract.extract([page], model) == ["Here x=2 holds, as seen."]


def test_html_training_pages_have_the_features_of_whole_pages(spark):
    long = f"<article><p>{'some words here, '* 94}<a href=/x>{'link ' * 80}</a></p></article>"
    many = "<main>" + "<p>One, two.</p>" * 2500 + "</main>"
    trees = html_extract.sample(spark.createDataFrame([(long,), (many,)], "html string"))
    assert sorted(len(t.parent) for t in trees) == [3, 2502]
    for page in (long, many):
        whole = html_extract.Forest([html_extract.parse(page)]).x
        got = next(t for t in trees if len(t.parent) == len(whole))
        assert np.array_equal(html_extract.Forest([got]).x, whole) and not got.segments
    p = next(t for t in trees if len(t.parent) == 3).measured()[0]
    assert p[1] > 1900 and 0.15 < p[2] / p[1] < 0.25


def test_html_held_out_layouts(model):
    trees = [html_extract.parse(p, labelled=True) for p in html_extract.seed_pages(120, seed=99)]
    forest = html_extract.Forest(trees)
    p, _, _ = forest.marginals(model.weights, model.pair)
    seen = [(p[s + n] >= 0.5) == y[n] for t, s, y in zip(trees, forest.starts, map(html_extract.labels, trees)) for n, _, _ in t.segments]
    assert np.mean(seen) > 0.95


def test_html_edges(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>" + "Long text, yes. " * 50_000), (4, "u", "<" * 3000), (4, "u", "<a b=\"" * 500),
            (None, "u", "plain words."), (5, "u", "<div>" * 900 + "deep.")]
    own = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = {r["page_id"]: r for r in html_extract.html_extract(own, model).collect()}
    assert got[1]["text"] == "" and got[3]["n_chars"] == len(("Long text, yes. " * 50_000).strip())
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.html_extract(none, html_extract.train(none)).count() == 0


def test_html_deep_pages_take_time_in_proportion(model):
    import time

    started = time.time()
    n = 40_000
    page = "<div>" * n + "<p>one, two.</p>" + "</nav></li>" * n + "</div>" * n
    assert html_extract.parse(page).segments == [(n + 1, "one, two.", 0)]
    forest = html_extract.Forest([html_extract.parse(page)])
    assert len(forest.levels) == n + 1 and all(len(level) == 1 for level in forest.levels)
    assert isinstance(html_extract.extract([page], model)[0], str)
    assert time.time() - started < 60


# --- embeddings

def _brute(rows, least=0.98):
    ids = [r[0] for r in rows]
    good = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, float) if ok else None)
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = good[i], good[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                n[i] += 1
                n[j] += 1
                parent[find(i)] = find(j)
    comp = [find(i) for i in range(len(rows))]
    first = {}
    for i, c in zip(ids, comp):
        if i is not None:
            first[c] = min(i, first.get(c, i))
    return sorted([(i, k, first.get(c), i is not None and first.get(c) == i) for i, k, c in zip(ids, n, comp)], key=repr)


def test_embedding_components_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 16))
    rows = [(i, (centers[i % 40] + rng.normal(size=16) * 0.12 * (i % 3)).astype("f4").tolist(), i % 40 % 3) for i in range(500)]
    rows += [(600 + i, rows[0][1], 0) for i in range(60)] + [(700, rows[0][1], 1), (701, rows[0][1], None)]
    rows += [(702, None, 0), (703, [0.0] * 16, 0), (704, [float("nan")] * 16, 0), (705, [], 0), (706, [1.0, None] * 8, 0), (707, [1.0, 2.0], 0),
             (708, [2.0, 4.0], 0), (None, rows[0][1], 0), (5, rows[5][1], rows[5][2]), (709, [float("inf")] * 16, 0), (710, [1e30] * 16, 0)]
    own = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit("x")).withColumn("of", F.lit(1))
    got = embed_dedup.embedding_components(own)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == _brute([(a, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for a, v, c in rows])
    assert embed_dedup.embedding_components(own.limit(0)).count() == 0


def test_embedding_bounds_lose_nothing_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(embed_dedup, "LIST_ROWS", 20)
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(20, 12))
    rows = [(i, (centers[i % 20] + rng.normal(size=12) * 0.1).astype("f4").tolist(), 0) for i in range(400)]
    got = embed_dedup.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == _brute([(a, [float(x) for x in v], c) for a, v, c in rows])


def test_embedding_joins_and_hubs_are_salted(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "SALT_ROWS", 20)
    monkeypatch.setattr(common, "HUB_EDGES", 3)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * 0.08).astype("f4").tolist(), 0) for i in range(200)]
    rows += [(300 + i, rows[0][1], 0) for i in range(150)] + [(500 + i, None, 0) for i in range(50)]
    got = embed_dedup.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == _brute([(a, None if v is None else [float(x) for x in v], c) for a, v, c in rows])


def _unit_rows(rng, n, centers=None):
    x = rng.normal(size=(n, 64)) if centers is None else centers[rng.integers(0, len(centers), n)] + 0.5 * rng.normal(size=(n, 64))
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize("clustered", [False, True])
def test_probes_grow_little_and_find_the_partners(clustered, monkeypatch):
    """Per vector, from 50,000 to 500,000 vectors (25 and 244 lists), with partners at the very limit of 0.98."""
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(300, 64)) if clustered else None
    sample = list(_unit_rows(rng, 6000, centers))
    asked = []
    for rows in (50_000, 500_000):
        q = embed_dedup.fit(sample, rows)[64]
        x = _unit_rows(rng, 2000, centers)
        step = rng.normal(size=x.shape)
        step -= (step * x).sum(1)[:, None] * x
        near = 0.98 * x + np.sqrt(1 - 0.98**2) * step / np.linalg.norm(step, axis=1)[:, None]
        _, mask, _ = q.probed(x, np.sqrt(0.04))
        own, _, _ = q.probed(near, np.sqrt(0.04))
        assert len(q.centroids) == round(rows / embed_dedup.LIST_ROWS)
        assert mask[np.arange(len(x)), own].mean() > 0.99
        asked.append(mask.sum(1).mean())
    assert asked[0] < 8 and asked[1] < 3 * asked[0]


def test_embedding_recall_on_50000_vectors(spark):
    """All links between 50,000 clustered vectors with planted near copies, against brute force in blocks."""
    rng = np.random.default_rng(10)
    x = _unit_rows(rng, 40_000, rng.normal(size=(300, 64)))
    near = x[:10_000] + rng.normal(size=(10_000, 64)) * rng.uniform(0, 0.2, 10_000)[:, None] / 8
    x = np.concatenate([x, near]).astype("f4")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    want = np.concatenate([(unit[i:i + 2000] @ unit.T >= 0.98).sum(1) - 1 for i in range(0, len(unit), 2000)])
    frame = pd.DataFrame({"vec_id": np.arange(len(x)), "label": 0, "embedding": list(x)})
    got = embed_dedup.embedding_components(spark.createDataFrame(frame, "vec_id long, label int, embedding array<float>")).toPandas()
    links = got.sort_values("vec_id")["n_links"].to_numpy()
    assert want.sum() > 15_000 and (links <= want).all()
    assert links.sum() / want.sum() > 0.999


# --- pipeline

def test_pipeline_stages(spark, docs, clashing):
    import corpus_pipeline

    at = clashing.select(*docs.columns, F.lit("more").alias("row"), F.lit(1).alias("kept"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = at.columns
        at = step(spark, at, "/nowhere")
        assert at.columns == before, name
        at = spark.createDataFrame(at.collect(), at.schema)
    assert at.count() > 20
    assert corpus_pipeline.STAGES[-1][1](spark, at, "/nowhere").agg(F.sum("length")).first()[0] > 1000
    empty = docs.limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, "/nowhere").count() == 0, name


def test_pipeline_run(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 200
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mix", "pack"]


def test_registered_queries():
    from larder.llm import queries

    names = list(queries.queries())
    assert [n.split("_")[0] for n in names[:-1]] == [f"op{i}" for i in range(1, 14)] and names[-1] == "pipeline"
    assert set(queries.oracle_sql()) <= set(names)


PROSE = ("The quick survey of the northern orchards began in May, when the growers met. They counted every tree, and wrote the "
         "numbers down.")


@pytest.fixture(scope="module")
def seeds_model():
    return html_extract.fit(html_extract.seed_trees())


@pytest.mark.parametrize("page, text", [
    (f"<html><body><p>{PROSE}</p><p>{PROSE} {PROSE}</p></body></html>", f"{PROSE}\n{PROSE} {PROSE}"),
    (f'<html><body><nav><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></nav><h1>Orchard survey</h1><p>{PROSE}</p>'
     f"<p>{PROSE}</p><footer>&copy; 2024 Orchard people</footer></body></html>", f"Orchard survey\n{PROSE}\n{PROSE}"),
    (f"<div><h1>Orchard survey</h1><p>{PROSE}</p><p>{PROSE}</p></div>", f"Orchard survey\n{PROSE}\n{PROSE}"),
    (f'<html><body><div class="lead"><p>{PROSE}</p><p>{PROSE}</p></div></body></html>', f"{PROSE}\n{PROSE}"),
    (f"<html><body><table><tr><td><h1>Title</h1><p>{PROSE}</p></td></tr></table></body></html>", f"Title\n{PROSE}"),
    (f'<html><body><table><tr><td><a href="/">Home</a><br><a href="/a">News</a></td><td><p>{PROSE}</p><p>{PROSE}</p></td></tr></table>'
     "</body></html>", f"{PROSE}\n{PROSE}"),
    ("Just plain text without tags, but with sentences.", "Just plain text without tags, but with sentences."),
    (f"<html><body><article><p>We asked, and then <label>the patient</label> answered.</p><p>{PROSE}</p></article></body></html>",
     f"We asked, and then the patient answered.\n{PROSE}"),
    (f'<html><body><div class="cookie-banner"><p>We use cookies. Please accept.</p></div><h1>Orchard survey</h1><p>{PROSE}</p>'
     f'<p>{PROSE}</p><div class="ad">Buy now, it is cheap.</div></body></html>', f"Orchard survey\n{PROSE}\n{PROSE}"),
    (f'<html><body><article><p>{PROSE}</p><form><label>Your name</label><button>Send</button></form></article></body></html>', PROSE)])
def test_pages_without_a_named_container(seeds_model, page, text):
    assert html_extract.extract([page], seeds_model) == [text]
