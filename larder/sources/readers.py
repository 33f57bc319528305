"""Sources: relational tables, CSV, multi-line JSON documents, Parquet, raw files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources import quoted_csv


#: What a bare empty CSV field stands for while it is read, so that a quoted one stays empty text.
NO_VALUE = "\ue000"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer_schema: bool = False, multi_line: bool | None = False) -> DataFrame:
    """CSV with a header row and doubled quotes inside quoted fields.

    With ``schema`` every field is read as text and cast leniently (ISO dates
    and timestamps of any precision; what does not fit is NULL), padding kept.
    Inference costs a full extra pass over the files; it never samples, since
    a type guessed from a sample turns the values that do not fit into NULLs.
    ``multi_line`` allows line breaks inside quoted fields: records are cut by
    quote parity across splits (``sources.quoted_csv``), so a file is still read
    by many tasks (except with inference, where Spark reads it whole). None
    looks at the files first, one scan that ends at the first such line.
    """
    if multi_line is None:
        multi_line = quoted_csv.has_quoted_breaks(spark, path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    options = {"escape": '"', "nullValue": NO_VALUE}
    r = spark.read.option("header", True).option("multiLine", multi_line).options(**options)
    if schema is None and (infer_schema or not multi_line):
        return r.option("inferSchema", infer_schema).csv(path)
    if multi_line:
        fields = quoted_csv.read(spark, path, options)
        if schema is None:
            return fields
        # As in Spark's reader, the schema names the columns by position.
        fields = fields.select(*[fields[f"`{n}`"].alias(f.name) for n, f in zip(fields.columns, schema.fields)],
                               *[F.lit(None).cast("string").alias(f.name) for f in schema.fields[len(fields.columns):]])
    else:
        fields = r.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path)
    return fields.select(*[
        fields[f"`{f.name}`"] if isinstance(f.dataType, T.StringType)
        else F.trim(fields[f"`{f.name}`"]).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON where one document spans many lines (an array of objects → rows).

    Each file is parsed by one task; prefer JSON Lines for very large inputs.
    Without a schema, inference reads the files once more. (No sampling: a
    sample of whole documents can be empty and yield an empty schema.)
    """
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None,
              fetch_size: int = 10000, predicates: list[str] | None = None,
              single_connection: bool = False) -> DataFrame:
    """Relational table scan, split into ``num_partitions`` range queries on
    ``partition_column`` so executors read in parallel (not one connection).

    ``predicates`` gives one WHERE clause per partition instead, for tables
    without a numeric / date column to range over (e.g. one clause per month
    or per hash bucket of a text key). Reading the whole table over one
    connection has to be asked for with ``single_connection``.
    """
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions, properties=props)
    if not single_connection:
        raise ValueError(f"give partition_column with bounds or predicates to read {table}, or single_connection=True")
    return spark.read.jdbc(url, table, properties=props)


def read_raw_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files as rows ``(path, modificationTime, length, content)``; bytes untouched."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def parse_json_documents(raw: DataFrame, element_schema: T.StructType) -> DataFrame:
    """Rows of landed JSON-array documents (``content`` bytes) → one row per element.

    A document that is not a JSON array fails the job with its path; take
    ``rejected_json_documents`` out first to go on without it. A blank
    document has no elements.
    """
    return _exploded(raw, element_schema).select("_e.*")


def _exploded(raw: DataFrame, element_schema: T.DataType, refine: Callable[[Column], Column] = lambda parsed: parsed) -> DataFrame:
    arr = refine(_elements(element_schema))
    bad = F.raise_error(F.concat(F.lit("not a JSON array document: "), F.col("path"))).cast(T.ArrayType(element_schema))
    return raw.select(F.explode(F.coalesce(arr, bad)).alias("_e"))


def _with_exact_numbers(parsed: Column) -> Column:
    """``parsed`` (maps of text) with top-level numbers as the variant parser reads them: decimals, not doubles.

    A document that the variant parser refuses (a name twice in an object) stays as parsed.
    """
    text = F.decode(F.col("content"), "UTF-8")
    exact = F.try_variant_get(F.try_parse_json(text), "$", "array<map<string,variant>>")

    def value(variants: Column):
        def of(name: Column, written: Column) -> Column:
            v = variants[name]
            return F.when(F.schema_of_variant(v).startswith("DECIMAL"), F.try_variant_get(v, "$", "string")).otherwise(written)
        return of

    return F.coalesce(F.zip_with(parsed, exact, lambda m, v: F.coalesce(F.transform_values(m, value(v)), m)), parsed)


def json_document_records(raw: DataFrame) -> DataFrame:
    """Rows of landed JSON-array documents with every value as text, a column for each name found.

    For documents of unknown schema: names come from all records (collected: one
    string a column), nested values stay JSON text. Numbers of up to 38 digits keep
    all their digits (without trailing zeros of a fraction); longer fractions and
    those with an exponent, and fractions inside nested values, are written as
    doubles print. Bad documents fail as in ``parse_json_documents``.
    """
    element = T.MapType(T.StringType(), T.StringType())
    rows = _exploded(raw, element, _with_exact_numbers)
    names = sorted(r[0] for r in rows.select(F.explode(F.map_keys("_e"))).distinct().collect())
    return rows.select(*[F.col("_e")[n].alias(n) for n in names])


def rejected_json_documents(raw: DataFrame, element_schema: T.StructType) -> DataFrame:
    """The landed documents that do not parse (path, length, content)."""
    return raw.where(_elements(element_schema).isNull())


def _elements(element_schema: T.DataType):
    text = F.decode(F.col("content"), "UTF-8")
    parsed = F.from_json(text, T.ArrayType(element_schema))
    return F.when(F.trim(text) == "", F.array().cast(T.ArrayType(element_schema))).otherwise(parsed)
