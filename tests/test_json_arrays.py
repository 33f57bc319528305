"""JSON array documents by byte ranges, and chunked landing."""

import json
import random

import pytest

from larder.session import scratch_path
from larder.sources import json_arrays
from larder.sources.landing import land_chunked_documents

SCHEMA = "k long, t string, n struct<a: array<struct<x: string>>, b: string>"


@pytest.fixture()
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1201", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def records(n, seed):
    rnd = random.Random(seed)
    text = lambda: "".join(rnd.choice(["a", "é", "}", "{", "]", "[", '"', "\\", "\n", ",", ": "]) for _ in range(rnd.randint(0, 12)))
    out = []
    for i in range(n):
        r = {"k": i, "t": text() * rnd.choice([1, 1, 40])}
        if rnd.random() < 0.5:
            r["n"] = {"a": [{"x": text()} for _ in range(rnd.randint(0, 3))], "b": text()}
        out.append(r)
    return out


def norm(row):
    n = row.get("n")
    return row["k"], row["t"], None if n is None else ([x["x"] for x in n["a"]], n["b"])


def got_rows(df):
    return sorted((norm(r.asDict(recursive=True)) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_by_ranges_round_trip(spark, tmp_path, tiny_splits, indent):
    docs = [records(40, 1), records(20, 2), []]
    for i, d in enumerate(docs):
        for r in d:
            r["k"] += 1000 * i
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=indent, ensure_ascii=i == 0))
    want = sorted((norm(r) for d in docs for r in d), key=lambda r: r[0])
    assert json_arrays.pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 6
    assert got_rows(json_arrays.read(spark, str(tmp_path), SCHEMA)) == want
    landed = land_chunked_documents(spark, str(tmp_path), scratch_path(spark, "chunks"), chunk_bytes=2500)
    schema = json_arrays.T.StructType.fromDDL(SCHEMA)
    assert got_rows(json_arrays.parse(json_arrays.pieces_of_chunks(landed), schema)) == want


@pytest.mark.parametrize("separator", ["\n", "}"])
def test_chunks_put_together_are_the_bytes(spark, tmp_path, tiny_splits, separator):
    data = bytes(random.Random(3).choices(b"ab\xff\x00\n}\r,", k=6_000)) + b"end"
    (tmp_path / "a.bin").write_bytes(data)
    landed = land_chunked_documents(spark, str(tmp_path), scratch_path(spark, "chunks"), separator, chunk_bytes=500)
    rows = sorted((r.at, bytes(r.content)) for r in landed.collect())
    assert len(rows) > 8 and separator.encode().join(c for _, c in rows) == data


@pytest.mark.parametrize("text", ['{"k": 1}', '[{"k": 1}', '[{"k": 1}, "x]', '[{"k": "x}]', '[7, {"k": 1}]'])
def test_other_documents_fail_loudly(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        json_arrays.read(spark, str(tmp_path), "k string").collect()


def test_one_array_of_many_blocks_is_read_by_many_tasks(spark, tmp_path):
    with open(tmp_path / "a.json", "w") as f:
        f.write("[" + ",".join('{"k": %d, "t": "%s"}' % (i, "text " * 40) for i in range(40_000)) + "]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 << 20))
    try:
        found = json_arrays.read(spark, str(tmp_path), "k long, t string")
        assert found.rdd.getNumPartitions() >= 4
        assert found.selectExpr("count(*)", "sum(k)").first() == (40_000, 40_000 * 39_999 // 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
