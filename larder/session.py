"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a local / test session. On a cluster the submitter's
# configuration wins: these only fill keys it leaves unset.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "larder", extra: dict | None = None,
                object_store: bool = False) -> SparkSession:
    """Session with local defaults that never override the submitter.

    ``SparkConf()`` holds what spark-submit / spark-defaults set; a default
    (including ``master`` and ``shuffle_partitions``) is applied only for keys
    it leaves unset. ``extra`` is the caller's explicit choice and is applied.
    ``object_store=True`` adds the S3A settings of ``object_store_conf()`` (from
    the environment) as further defaults, so every layer can live in a bucket.
    """
    from pyspark import SparkConf, SparkContext

    # Attach to (or start) the JVM first: only then does SparkConf() load the
    # properties spark-submit handed to the driver.
    SparkContext._ensure_initialized()
    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master and not submitted.contains("spark.master"):
        builder = builder.master(master)
    defaults = dict(LOCAL_DEFAULTS)
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if object_store:
        defaults.update(object_store_conf())
    for k, v in defaults.items():
        if not submitted.contains(k):
            builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def object_store_conf(env: dict | None = None) -> dict:
    """Hadoop S3A settings for an S3-compatible object store.

    Every value is overridable through the environment. Returned as a plain
    map so callers pass it to ``SparkSession.builder.config``; no client is
    created here.
    """
    env = os.environ if env is None else env
    endpoint = env.get("OBJECT_STORE_ENDPOINT", "localhost:9000")
    scheme = "https" if env.get("OBJECT_STORE_TLS", "false").lower() == "true" else "http"
    return {
        "spark.hadoop.fs.s3a.endpoint": f"{scheme}://{endpoint}",
        "spark.hadoop.fs.s3a.access.key": env.get("OBJECT_STORE_ACCESS_KEY", ""),
        "spark.hadoop.fs.s3a.secret.key": env.get("OBJECT_STORE_SECRET_KEY", ""),
        "spark.hadoop.fs.s3a.path.style.access": env.get("OBJECT_STORE_PATH_STYLE", "true"),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "true" if scheme == "https" else "false",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.maximum": env.get("OBJECT_STORE_MAX_CONNECTIONS", "100"),
        "spark.hadoop.fs.s3a.attempts.maximum": env.get("OBJECT_STORE_MAX_ATTEMPTS", "10"),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment to shared storage and is only
    read here. Only when it is unset on a local master (tests) a fresh folder
    is created and registered with the context; elsewhere that raises, since a
    folder of the driver's own is out of the executors' sight.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - conf lookup differs across deployments
            path = None
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = _LOCAL_CHECKPOINT.get(sc.applicationId)
        if path is None:
            path = tempfile.mkdtemp(prefix="larder-ckpt-")
            _LOCAL_CHECKPOINT[sc.applicationId] = path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_LOCAL_CHECKPOINT: dict[str, str] = {}


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint folder for written tables.

    Locations handed out here are removed when the Python process exits (if
    the Spark context is still up), so repeated runs do not accumulate data
    in the shared folder. Nothing else under the folder is touched.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/larder/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(drop_scratch)
    _SCRATCH.append(path)
    return path


def drop_scratch() -> None:
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    if sc is None:
        return
    try:
        jvm = sc._jvm
        conf = sc._jsc.hadoopConfiguration()
        for path in _SCRATCH:
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(conf).delete(hpath, True)
    except Exception:  # noqa: BLE001 - best effort at interpreter exit
        pass
