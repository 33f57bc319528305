"""Silver-layer cleaning operators.

Each operator is ``DataFrame (+ args) -> DataFrame`` and is meant to be chained
with ``df.transform``. Scalars (a median, a flag) stay inside the plan as
scalar subqueries instead of a driver round-trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import content_hash, normalized_names, to_double, to_timestamp_lenient

# Silver-layer names and keywords.
DATETIME_NAME_KEYWORDS = ("date", "time", "created")
PRICE_CANDIDATES = ("price", "unit_price", "cost")
QUANTITY_COLUMN = "quantity"
TRANSACTION_ID = "transaction_id"
DEDUP_KEY = "id"
SUPPLIER_ID = "supplier_id"
# How whole rows of a fact table are dealt to tasks: the share of rows in which frequent ones are looked for,
# the copies there that make a row frequent, and the most rows taken as frequent.
FREQUENT_SHARE = 1 / 512
FREQUENT_COPIES = 1000
MOST_FREQUENT = 10_000


def normalize_columns(df: DataFrame, collapse: bool = False) -> DataFrame:
    """Rename every column to its normalised form in one projection."""
    return df.toDF(*normalized_names(df.columns, collapse=collapse))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim leading/trailing spaces of every string column."""
    return df.select(*[
        F.trim(df[name]).alias(name) if isinstance(f.dataType, T.StringType) else df[name]
        for name, f in zip(df.columns, df.schema.fields)
    ])


def parse_datetimes(df: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Parse string columns whose name mentions a date/time to timestamps.

    Unparseable text becomes NULL. Columns of any other type are untouched.
    """
    out = []
    for name, f in zip(df.columns, df.schema.fields):
        lowered = name.lower()
        if isinstance(f.dataType, T.StringType) and any(k in lowered for k in DATETIME_NAME_KEYWORDS):
            out.append(to_timestamp_lenient(df[name], formats).alias(name))
        else:
            out.append(df[name])
    return df.select(*out)


def cast_with_default(df: DataFrame, column: str = QUANTITY_COLUMN, default: float = 0.0) -> DataFrame:
    """``column`` → double; NULL or malformed → ``default``. No-op if absent."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.coalesce(to_double(df[column]), F.lit(float(default))))


def price_column(df: DataFrame, candidates: Sequence[str] = PRICE_CANDIDATES) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def cast_price(df: DataFrame, candidates: Sequence[str] = PRICE_CANDIDATES) -> DataFrame:
    """Cast the first existing price-like column to double (only that one)."""
    col = price_column(df, candidates)
    if col is None:
        return df
    return df.withColumn(col, to_double(df[col]))


def approx_median(df: DataFrame, column: str, accuracy: int = 10000) -> DataFrame:
    """One-row frame with the approximate median (NULLs ignored)."""
    return df.agg(F.percentile_approx(df[column], 0.5, accuracy).alias("median"))


def median_scalar(df: DataFrame, column: str, accuracy: int = 10000) -> Column:
    """The approximate median as a scalar-subquery column (no driver trip)."""
    return df.select(F.percentile_approx(df[column], 0.5, accuracy)).scalar()


def impute_median(df: DataFrame, column: str, accuracy: int = 10000) -> DataFrame:
    """NULL → approximate median of the column; an all-NULL column stays NULL."""
    return df.withColumn(column, F.coalesce(df[column], median_scalar(df, column, accuracy)))


def with_transaction_id(df: DataFrame, column: str = TRANSACTION_ID) -> DataFrame:
    """Add a content-hash id when the column is absent.

    Deterministic (same rows → same ids on every run and after a retry), and
    applied after deduplication so identical rows stay identical.
    """
    if column in df.columns:
        return df
    return df.withColumn(column, content_hash([df[c] for c in df.columns]))


def dedup_by_key(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the first under ``order_by`` (ascending, NULLs last).

    Default order is every non-key column in column order, so the kept row is
    fully determined. Implemented as ``min(struct(...))``: a partial aggregate,
    so a hot key is combined map-side instead of landing whole in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = list(order_by) if order_by else rest
    packed = order + [c for c in rest if c not in order]
    kept = (
        df.groupBy(*[df[k] for k in keys])
        .agg(F.min(F.struct(*[x for i, c in enumerate(packed)
                              for x in (df[c].isNull().alias(f"_n{i}"), df[c].alias(f"_{i}"))])).alias("_kept"))
    )
    pos = {c: i for i, c in enumerate(packed)}
    return kept.select(*[
        kept[c] if c in keys else kept["_kept"].getField(f"_{pos[c]}").alias(c) for c in df.columns
    ])


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop whole-row duplicates."""
    return df.dropDuplicates()


def dedup_fact_rows(df: DataFrame, share: float = FREQUENT_SHARE, copies: int = FREQUENT_COPIES) -> DataFrame:
    """Drop whole-row duplicates of a table whose rows are mostly distinct.

    Combining before the shuffle would hold a map task's whole split in a hash
    table and spill it, so rows are shuffled first and each task drops the
    duplicates of its own part. Rows of very many copies (some half a million or
    more, looked for in a sample that decides nothing else) are combined before
    the shuffle instead, so none of them lands whole in one task.
    """
    columns = [df[f"`{c}`"] for c in df.columns]
    hashed = F.xxhash64(*columns)
    counts = df.select(hashed.alias("_row")).sample(share, seed=1).groupBy("_row").agg(F.count(F.lit(1)).alias("_n"))
    frequent = [r[0] for r in counts.where(F.col("_n") >= copies).orderBy(F.desc("_n")).limit(MOST_FREQUENT).collect()]
    if not frequent:
        return dedup_rows(df.repartition(*columns))
    often = hashed.isin(frequent)
    return dedup_rows(df.where(~often).repartition(*columns)).unionByName(dedup_rows(df.where(often)))


def rename_supplier_id(df: DataFrame) -> DataFrame:
    """``id`` → ``supplier_id`` unless ``supplier_id`` already exists."""
    if SUPPLIER_ID not in df.columns and DEDUP_KEY in df.columns:
        return df.withColumnRenamed(DEDUP_KEY, SUPPLIER_ID)
    return df


def layer_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """``(dataset, n_rows)`` for each named frame; one partial count each."""
    if not datasets:
        raise ValueError("layer_counts needs at least one dataset")
    frames = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        for name, df in datasets.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---------------------------------------------------------------- pipelines

def clean_transactions(df: DataFrame, datetime_formats: list[str] | None = None) -> DataFrame:
    """normalise → trim → parse dates → quantity default → dedup → id.

    Deduplication runs *before* the id is generated: with a random id first,
    no whole-row duplicate could ever be removed.
    """
    df = normalize_columns(df).transform(trim_strings)
    df = parse_datetimes(df, datetime_formats)
    df = cast_with_default(df, QUANTITY_COLUMN, 0.0)
    df = dedup_by_key(df, DEDUP_KEY) if DEDUP_KEY in df.columns else dedup_fact_rows(df)
    return with_transaction_id(df)


def clean_inventory(df: DataFrame) -> DataFrame:
    """normalise → trim → price cast → median imputation → dedup."""
    df = normalize_columns(df).transform(trim_strings)
    col = price_column(df)
    if col is not None:
        df = cast_price(df)
        df = impute_median(df, col)
    return dedup_rows(df)


def clean_suppliers(df: DataFrame) -> DataFrame:
    """normalise → trim → ``id`` rename → dedup."""
    return normalize_columns(df).transform(trim_strings).transform(rename_supplier_id).transform(dedup_rows)
