"""Text formats, ids, kept rows and layers lose and mix up nothing."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL

from larder.operators import cleaning as C
from larder.operators import recommend as R
from larder.plans import layers
from larder.session import ensure_checkpoint_dir
from larder.sources import readers, writers

SCHEMA = "id long, t string, at timestamp_ntz, day date, x double"


def test_csv_round_trip_keeps_every_value(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    rows = [(1, "  x ", at, at.date(), 0.1), (2, 'a "quoted", b', None, None, None), (3, "", at, None, -1e300), (4, None, at, at.date(), 2.0),
            (5, "line\nbreak", at, None, 1.0), (6, "back\\slash \\\" end\\", at, None, 1.0)]
    path = str(tmp_path / "csv")
    writers.write_csv(spark.createDataFrame(rows, SCHEMA), path)
    got = readers.read_csv(spark, path, schema=SCHEMA, multi_line=True)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == rows


def test_csv_timestamps_of_any_precision(spark, tmp_path):
    (tmp_path / "a.csv").write_text("at,n\n2024-01-01,1\n2024-01-01T10:00:00,2.5\n2024-01-01 10:00:00.123,x\n,\n")
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), schema="at timestamp_ntz, n double").collect()
    assert [r["at"] for r in got] == [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 0, 0, 123000), None]
    assert [r["n"] for r in got] == [1.0, 2.5, None, None]


def test_broken_json_document_is_loud(spark, tmp_path):
    from pyspark.sql.types import StructType

    (tmp_path / "a.json").write_text('[{"k": 1},\n {"k": 2}]')
    (tmp_path / "b.json").write_text('[{"k": 3},\n {"k"')
    (tmp_path / "c.json").write_text("")
    raw = readers.read_raw_files(spark, str(tmp_path))
    schema = StructType.fromDDL("k long")
    with pytest.raises(Exception, match="not a JSON array document"):
        readers.parse_json_documents(raw, schema).collect()
    bad = readers.rejected_json_documents(raw, schema)
    assert [r["path"].rsplit("/", 1)[-1] for r in bad.collect()] == ["b.json"]
    good = raw.join(bad.select("path"), "path", "left_anti")
    assert sorted(r["k"] for r in readers.parse_json_documents(good, schema).collect()) == [1, 2]


def test_relational_read_refuses_a_silent_single_connection():
    with pytest.raises(ValueError, match="partition_column"):
        readers.read_jdbc(None, "jdbc:x", "stock_move")


def test_ids_never_collide(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("\\N", "x"), ("-", "x"), ("1:a", "b"), ("", ""), (None, None), ("", None)]
    ids = C.with_transaction_id(spark.createDataFrame(rows, "a string, b string")).select("transaction_id").distinct().count()
    assert ids == len(rows)


def test_keyed_dedup_keeps_known_values(spark):
    rows = [(1, None, "a"), (1, 50.0, "z"), (1, 50.0, None), (2, None, None)]
    got = C.dedup_by_key(spark.createDataFrame(rows, "k int, v double, t string"), "k").collect()
    assert sorted(map(tuple, got)) == [(1, 50.0, "z"), (2, None, None)]


def test_recommendations_keep_every_column_and_need_no_product(spark):
    df = spark.createDataFrame([("n", 1, 9.0, 4.0)], "region string, predicted_stockout int, predicted_rop double, stock_on_hand double")
    row = R.recommendations(df).first()
    assert row["region"] == "n" and row["priority"] == R.HIGH and row["recommended_order"] == 5.0


def test_layers_follow_their_inputs(spark, tmp_path):
    own = tmp_path / "tables"
    shutil.copytree(SF_SMALL, own)
    before = layers.silver_inventory(spark, str(own)).count()
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    more = part.union(part.withColumn("p_partkey", (F.col("p_partkey") + 1_000_000).cast(part.schema["p_partkey"].dataType))).toPandas()
    (own / "part.parquet").chmod(0o644)
    more.to_parquet(own / "part.parquet")
    assert layers.silver_inventory(spark, str(own)).count() == 2 * before


def test_no_local_folder_off_a_local_master():
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
