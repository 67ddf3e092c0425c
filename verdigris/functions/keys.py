"""Natural keys as text: ``col1=val1|col2=val2``, in Python and as columns."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_KEY = "NULL"
NULL_BUCKET = "None"


def split_columns(text: str | None) -> list[str]:
    return [c.strip() for c in (text or "").split(",") if c.strip()]


def encode(columns: list[str], row: Mapping[str, object]) -> str:
    """The key of a row whose names are in lower case; columns keep their own spelling."""
    if not columns:
        raise ValueError("a key needs at least one column")
    parts = []
    for c in columns:
        if c.lower() not in row:
            raise KeyError(c)
        v = row[c.lower()]
        parts.append(f"{c}={NULL_KEY if v is None else v}")
    return "|".join(parts)


def decode(key: str | None) -> dict[str, str | None]:
    """Column to value; a value of NULL is None, segments without text are passed over."""
    out: dict[str, str | None] = {}
    for segment in (key or "").split("|"):
        if segment:
            name, _, value = segment.partition("=")
            out[name] = None if value == NULL_KEY else value
    return out


def _shortest(column: Column) -> Column:
    # Within a function, so that it travels by value: executors need not have this package.
    @F.pandas_udf("string")
    def written(numbers: pd.Series) -> pd.Series:
        return pd.Series(list(map(repr, numbers.tolist())), dtype=object)

    return written(column)


def text(column: Column, kind: T.DataType) -> Column:
    """column as the text that Python's str gives: True, 10000000.0, 1e+16, nan, 00:00:00.500000.

    The JVM writes some doubles with more digits than they need, so fractional
    keys, which are rare, go through Python in batches; all else is built in.
    """
    if isinstance(kind, T.BooleanType):
        return F.initcap(column.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        s = column.cast("string")
        return F.when(s.contains("."), F.concat(F.substring_index(s, ".", 1), F.lit("."), F.rpad(F.substring_index(s, ".", -1), 6, "0"))).otherwise(s)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(column.isNotNull(), _shortest(column.cast("double")))
    return column.cast("string")


def key_column(df: DataFrame, columns: list[str]) -> Column:
    """The key of each row of df; a null value is NULL.  A column that df lacks raises KeyError."""
    if not columns:
        raise ValueError("a key needs at least one column")
    kinds = {f.name.lower(): f for f in df.schema.fields}
    parts = []
    for c in columns:
        if c.lower() not in kinds:
            raise KeyError(c)
        field = kinds[c.lower()]
        parts.append(F.concat(F.lit(f"{c}="), F.coalesce(text(F.col(f"`{field.name}`"), field.dataType), F.lit(NULL_KEY))))
    return F.concat_ws("|", *parts)


def decoded(key: Column) -> Column:
    """The key as a map of column to value, with null for NULL."""
    segments = F.filter(F.split(key, r"\|"), lambda s: s != "")
    value = lambda s: F.when(s.contains("="), F.substring(s, F.instr(s, "=") + 1, F.length(s))).otherwise("")
    return F.map_from_entries(F.transform(segments, lambda s: F.struct(F.substring_index(s, "=", 1).alias("key"), F.nullif(value(s), F.lit(NULL_KEY)).alias("value"))))
