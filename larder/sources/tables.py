"""Versioned tables: data folders under a path, and small numbered manifests that say which of them count.

``path/_manifests/00000007.json`` names the data folders of version 7 (and
carries the writer's own ``properties``). A writer fills new folders first and
creates the next manifest last, as one small file that must not exist yet, so

* a write that fails midway changes nothing: no manifest names its folders;
* a reader resolves the highest readable manifest once, and its plan keeps
  reading those folders while later versions are written;
* of two writers from the same version one fails instead of losing the other's
  rows;
* what a step has consumed can be recorded in the same switch as its result.

Nothing is renamed, so the same holds on object stores. ``vacuum`` drops the
folders that no kept version names. Plain folders (without manifests) are read
as they are, so every reader below takes either.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.sources import files

MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Version:
    """One state of a table: its data folders (names under the path) with their row counts, and properties."""

    number: int = 0
    folders: tuple[str, ...] = ()
    rows: dict = field(default_factory=dict)
    properties: dict = field(default_factory=dict)
    format: str = "parquet"


def current(spark: SparkSession, path: str) -> Version | None:
    """The highest complete version, or None for a path without manifests (an unfinished manifest does not count)."""
    found = [n for n in files.names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit()]
    for name in sorted(found, key=lambda n: int(n[:-5]), reverse=True):
        try:
            text = json.loads(files.read_text(spark, f"{path}/{MANIFESTS}/{name}"))
        except ValueError:
            continue
        return Version(text["number"], tuple(text["folders"]), text["rows"], text["properties"], text["format"])
    return None


def read_table(spark: SparkSession, path: str, folders: tuple[str, ...] | None = None, schema=None, **options) -> DataFrame:
    """The rows of the current version, or of some of its folders; a plain folder is read as Parquet.

    Schemas of the folders are merged, so a later batch may add columns.
    """
    path = path.rstrip("/")
    version = current(spark, path)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if version is None:
        return reader.parquet(path)
    chosen = version.folders if folders is None else folders
    if not chosen:
        raise ValueError(f"{path} has no data folders")
    if version.format == "parquet" and schema is None and len(chosen) > 1:
        reader = reader.option("mergeSchema", True)
    return reader.format(version.format).load([f"{path}/{f}" for f in chosen])


def write_folder(df: DataFrame, path: str, fmt: str = "parquet", options: dict | None = None) -> tuple[str, int]:
    """Write ``df`` as a new data folder that no version names yet; its name and the rows written (observed, not recounted)."""
    name, seen = f"data-{uuid.uuid4().hex}", Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format(fmt).options(**(options or {})).mode("error").save(f"{path.rstrip('/')}/{name}")
    return name, int(seen.get["n"])


def publish(spark: SparkSession, path: str, version: Version) -> Version:
    """Make ``version`` the current one; fails if its number is taken."""
    text = json.dumps({"number": version.number, "folders": list(version.folders), "rows": version.rows,
                       "properties": version.properties, "format": version.format})
    files.create_text(spark, f"{path.rstrip('/')}/{MANIFESTS}/{version.number:08d}.json", text)
    return version


def next_number(spark: SparkSession, path: str) -> int:
    """One above every manifest there is, unfinished ones included."""
    taken = [int(n[:-5]) for n in files.names(spark, f"{path.rstrip('/')}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit()]
    return max(taken, default=0) + 1


def replace_table(df: DataFrame, path: str, properties: dict | None = None, fmt: str = "parquet",
                  options: dict | None = None) -> Version:
    """All rows give way to ``df``, which may itself read the table."""
    spark, path = df.sparkSession, path.rstrip("/")
    number = next_number(spark, path)
    name, n = write_folder(df, path, fmt, options)
    return publish(spark, path, Version(number, (name,), {name: n}, properties or {}, fmt))


def append_table(df: DataFrame, path: str, properties: dict | None = None) -> Version:
    """The rows of ``df`` are added as one more folder; ``properties`` are added to the table's."""
    spark, path = df.sparkSession, path.rstrip("/")
    before, number = current(spark, path) or Version(), next_number(spark, path)
    name, n = write_folder(df, path)
    return publish(spark, path, Version(number, before.folders + (name,), {**before.rows, name: n},
                                        {**before.properties, **(properties or {})}))


def table_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of the current version by its manifest (None for a plain folder)."""
    version = current(spark, path.rstrip("/"))
    return None if version is None else sum(version.rows[f] for f in version.folders)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete data folders that none of the last ``keep`` versions names; no writer and no reader of older versions may be at work."""
    path = path.rstrip("/")
    numbers = sorted((n for n in files.names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")), reverse=True)
    named: set[str] = set()
    for name in numbers[:keep]:
        try:
            named.update(json.loads(files.read_text(spark, f"{path}/{MANIFESTS}/{name}"))["folders"])
        except ValueError:
            continue
    gone = [n for n in files.names(spark, path) if n.startswith("data-") and n not in named]
    for name in numbers[keep:]:
        files.delete(spark, f"{path}/{MANIFESTS}/{name}")
    for name in gone:
        files.delete(spark, f"{path}/{name}")
    return gone
