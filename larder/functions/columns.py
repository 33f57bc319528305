"""Column-level helpers shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_RUN = re.compile(r"[\s\-/]+")


def normalize_name(name: str, collapse: bool = False) -> str:
    """Strip, lower-case and turn separators into ``_``.

    ``collapse=False`` maps each space, ``-`` and ``/`` to one ``_``
    (``"a - b"`` → ``"a___b"``); ``collapse=True`` maps each *run* of
    whitespace, ``-`` and ``/`` to one ``_`` (``"a - b"`` → ``"a_b"``).
    """
    n = name.strip().lower()
    if collapse:
        return _RUN.sub("_", n)
    return n.replace(" ", "_").replace("-", "_").replace("/", "_")


def normalized_names(columns: list[str], collapse: bool = False) -> list[str]:
    """Normalised names; raises when two originals land on the same name."""
    out = [normalize_name(c, collapse) for c in columns]
    seen: dict[str, str] = {}
    clashes = []
    for orig, new in zip(columns, out):
        if new in seen:
            clashes.append(f"{seen[new]!r} and {orig!r} -> {new!r}")
        else:
            seen[new] = orig
    if clashes:
        raise ValueError("column names collide after normalisation: " + "; ".join(clashes))
    return out


def to_double(col: Column) -> Column:
    """Lenient numeric cast: malformed text becomes NULL instead of raising."""
    return col.try_cast(T.DoubleType())


def key_as(col: Column, dtype: T.DataType, wanted: T.DataType) -> Column:
    """A join key in the type of the other side: text is cast leniently (``"7"`` and ``"7.0"`` are 7, ``"A1"`` matches nothing).

    Keys of other types, and text that is wanted as text, stay as they are.
    """
    if not isinstance(dtype, T.StringType) or isinstance(wanted, T.StringType):
        return col
    text = F.trim(col)
    if not isinstance(wanted, T.IntegralType):
        return text.try_cast(wanted)
    number = text.try_cast(T.DecimalType(38, 10))
    return F.when(number == F.floor(number), number.try_cast(wanted))


def same_key(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> Column:
    """Equality of two join keys, a text key against a number included."""
    lt, rt = left.schema[left_key].dataType, right.schema[right_key].dataType
    return key_as(left[left_key], lt, rt) == key_as(right[right_key], rt, lt)


def to_timestamp_lenient(col: Column, formats: list[str] | None = None) -> Column:
    """Parse text to a wall-clock timestamp (``timestamp_ntz``); unparseable → NULL.

    Parsing happens in the session time zone and the result is converted back
    in the same zone, so the wall-clock value does not depend on it.
    """
    if formats:
        parsed = F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])
    else:
        parsed = F.try_to_timestamp(col)
    return parsed.cast(T.TimestampNTZType())


def to_day(col: Column, dtype: T.DataType) -> Column:
    """Calendar day of a date, timestamp or date-like text column."""
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(col)
    return F.to_date(to_timestamp_lenient(F.trim(col.cast("string"))))


def null_if_nan(col: Column) -> Column:
    """NaN → NULL, so comparisons and ``greatest`` treat it as missing."""
    return F.nanvl(col, F.lit(None).cast(T.DoubleType()))


def content_hash(cols: list[Column]) -> Column:
    """md5 over the text form of the given columns, each led by its length (NULL: a bare dash), so no two rows read alike."""
    texts = [c.cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", *parts))
