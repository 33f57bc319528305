"""Sources, sinks and landing round trips."""

import os


from support import SF_SMALL

from larder.plans import catalog
from larder.plans import fixtures as fx
from larder.session import scratch_path
from larder.sources import readers, writers
from larder.streaming.landing import land_movements_incrementally


def test_csv_parquet_json_round_trips(spark):
    inv = fx.inventory(spark, SF_SMALL)
    assert catalog.scan_csv(spark, SF_SMALL).exceptAll(inv).count() == 0
    sup = fx.suppliers_per_product(spark, SF_SMALL)
    assert catalog.scan_json_multiline(spark, SF_SMALL).exceptAll(sup).count() == 0


def test_single_file_sink_writes_one_file(spark):
    df = catalog.sink_parquet_single_file(spark, SF_SMALL)
    files = [f for f in df.inputFiles() if f.endswith(".parquet")]
    assert len(files) == 1 and df.count() == 200


def test_raw_landing_keeps_bytes(spark):
    src = scratch_path(spark, "docs")
    writers.write_json_documents(fx.suppliers_per_product(spark, SF_SMALL), src)
    landed = readers.read_raw_files(spark, src, "part-*").collect()
    for row in landed:
        with open(row.path.replace("file:", ""), "rb") as fh:
            assert fh.read() == bytes(row.content)


def test_streaming_landing_is_exactly_once(spark):
    from larder.plans.catalog import STOCK_MOVE_SCHEMA

    src, dest, ckpt = (scratch_path(spark, n) for n in ("src", "dest", "ckpt"))
    writers.write_parquet(fx.stock_move(spark, SF_SMALL), src)
    first = land_movements_incrementally(spark, src, STOCK_MOVE_SCHEMA, dest, ckpt).count()
    again = land_movements_incrementally(spark, src, STOCK_MOVE_SCHEMA, dest, ckpt).count()
    assert first == again == fx.stock_move(spark, SF_SMALL).count()


def test_object_store_conf_from_env():
    from larder.session import object_store_conf

    conf = object_store_conf({"OBJECT_STORE_ENDPOINT": "store:9000", "OBJECT_STORE_ACCESS_KEY": "k"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert conf["spark.hadoop.fs.s3a.connection.maximum"] == "100"
    assert conf["spark.hadoop.fs.s3a.attempts.maximum"] == "10"


def test_session_defaults_do_not_override_submitted_conf(tmp_path):
    import os
    import subprocess
    import sys

    import pyspark

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "probe.py"
    script.write_text(
        "import sys; sys.path.insert(0, %r)\n"
        "from larder.session import get_session\n"
        "s = get_session('local[1]', shuffle_partitions=3)\n"
        "print('TZ=' + s.conf.get('spark.sql.session.timeZone'))\n"
        "print('SP=' + s.conf.get('spark.sql.shuffle.partitions'))\n"
        "s.stop()\n" % repo)
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    env = dict(os.environ, PYSPARK_PYTHON=sys.executable, PYSPARK_DRIVER_PYTHON=sys.executable)
    out = subprocess.run(
        [submit, "--master", "local[1]", "--conf", "spark.sql.session.timeZone=Asia/Tokyo",
         "--conf", "spark.ui.enabled=false", "--conf", "spark.checkpoint.dir=" + str(tmp_path / "ckpt"),
         str(script)],
        capture_output=True, text=True, timeout=300, env=env)
    assert "TZ=Asia/Tokyo" in out.stdout, out.stderr[-2000:]
    assert "SP=3" in out.stdout


def test_read_jdbc_builds_partitioned_reads():
    from larder.sources.readers import read_jdbc

    calls = []

    class FakeReader:
        def jdbc(self, url, table, **kw):
            calls.append((url, table, kw))
            return "df"

    class FakeSession:
        read = FakeReader()

    assert read_jdbc(FakeSession(), "jdbc:x", "stock_move", partition_column="id", lower_bound=0,
                     upper_bound=1000, num_partitions=8) == "df"
    url, table, kw = calls[-1]
    assert (kw["column"], kw["lowerBound"], kw["upperBound"], kw["numPartitions"]) == ("id", 0, 1000, 8)
    assert kw["properties"]["fetchsize"] == "10000"
    read_jdbc(FakeSession(), "jdbc:x", "stock_move", predicates=["m = 1", "m = 2"])
    assert calls[-1][2]["predicates"] == ["m = 1", "m = 2"]


def test_scratch_locations_removed_at_exit(tmp_path):
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ckpt = tmp_path / "ckpt"
    script = tmp_path / "probe.py"
    script.write_text(
        "import sys; sys.path.insert(0, %r)\n"
        "from larder.session import get_session, scratch_path\n"
        "s = get_session('local[1]', 2, extra={'spark.checkpoint.dir': %r})\n"
        "p = scratch_path(s, 'x'); s.range(3).write.parquet(p)\n"
        "print('PATH=' + p)\n" % (repo, str(ckpt)))
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300)
    path = [line[5:] for line in out.stdout.splitlines() if line.startswith("PATH=")][0]
    assert not os.path.exists(path.replace("file:", "")), out.stderr[-1000:]
    assert ckpt.exists()
