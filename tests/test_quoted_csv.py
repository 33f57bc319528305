"""CSV with quoted line breaks, cut by quote parity across splits."""

import csv
import io
import random

import pytest
from support import rows_of

from larder.sources import quoted_csv, readers


@pytest.fixture()
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "701", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def records(n, seed, breaks=("\n", "\r\n", "\n\n")):
    rnd = random.Random(seed)
    field = lambda: "".join(rnd.choice(["a", "é", " ", ",", '"', "bc", *breaks]) for _ in range(rnd.randint(0, 9)))
    rows = [(str(i), field(), "x" * rnd.choice([0, 1, 300]), field()) for i in range(n)]
    rows[n // 2] = (str(n // 2), "long\n" * 200, "", "y")  # a record over many splits
    return rows


def write(path, rows, end):
    out = io.StringIO(newline="")
    w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end)
    w.writerow(["k", "Name, \"full\"", "pad", "last"])
    w.writerows(rows)
    path.write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_breaks_across_splits_round_trip_in_many_tasks(spark, tmp_path, tiny_splits, end):
    parts = [records(60, 1), records(40, 2)]
    for i, rows in enumerate(parts):
        write(tmp_path / f"{i}.csv", rows, end)
    got = readers.read_csv(spark, str(tmp_path), multi_line=True)
    assert got.columns == ["k", 'Name, "full"', "pad", "last"]
    assert sorted(map(tuple, got.collect())) == sorted(parts[0] + parts[1])
    assert quoted_csv.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    assert readers.read_csv(spark, str(tmp_path), multi_line=None).count() == 100


def test_without_breaks_it_reads_like_spark(spark, tmp_path, tiny_splits):
    write(tmp_path / "a.csv", records(30, 3, breaks=("z",))[:14], "\n")
    text = (tmp_path / "a.csv").read_text() + 'k9,,"",\n\nk10,only\n'
    (tmp_path / "a.csv").write_text(text)
    plain = readers.read_csv(spark, str(tmp_path), multi_line=False)
    assert rows_of(readers.read_csv(spark, str(tmp_path), multi_line=True)) == rows_of(plain)
    assert not quoted_csv.has_quoted_breaks(spark, str(tmp_path))
    typed = readers.read_csv(spark, str(tmp_path), schema="k string, n string, pad string, last int, more int", multi_line=True)
    assert typed.columns == ["k", "n", "pad", "last", "more"] and typed.count() == plain.count()


def test_unpaired_quotes_and_differing_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="unpaired quote"):
        readers.read_csv(spark, str(tmp_path), multi_line=True).collect()
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        readers.read_csv(spark, str(tmp_path), multi_line=True)


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("a,b\n")
    got = readers.read_csv(spark, str(tmp_path), multi_line=True)
    assert got.columns == ["a", "b"] and got.count() == 0
