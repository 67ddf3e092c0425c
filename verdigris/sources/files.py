"""Files as DataFrames: CSV, TSV, Parquet, Excel, by suffix, from disks or object stores."""

from __future__ import annotations

import codecs
import datetime as dt
import io
import re
import zipfile
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import excel

SUFFIXES = (".csv", ".tsv", ".parquet", ".xlsx", ".xls")
SEPARATORS = {".csv": ",", ".tsv": "\t"}


def charset(name: str) -> str:
    """Spark's name of an encoding, from any of its names; one that Spark does not read is refused by Spark itself."""
    try:
        plain = codecs.lookup(name).name
    except LookupError:
        return name
    return {"iso8859-1": "ISO-8859-1", "ascii": "US-ASCII"}.get(plain, plain.upper())


def view_name(source: str) -> str:
    """The last suffix off, other characters than letters, digits and _ as _; t for nothing, t_ before a digit."""
    name = re.sub(r"[^0-9A-Za-z_]", "_", re.sub(r"\.[^./]*$", "", source))
    return f"t_{name}" if name[:1].isdigit() else name or "t"


def _files(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return sorted(str(f.getPath()) for f in found or [])


def _size_mb(spark: SparkSession, pattern: str) -> float:
    jvm, total = spark._jvm, 0
    for f in _files(spark, pattern):
        path = jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return total / 1e6


def read(spark: SparkSession, path: str, encoding: str = "utf-8", max_mb: int = 0, base: str | None = None, multiline: bool = True) -> DataFrame:
    """The file, or the files of a glob, with column names in lower case.

    Files of different columns are united by name, and columns in the path
    (name=value) are columns of the rows.  multiline: quoted values of CSV and
    TSV may hold line breaks, at the price that each file is one task's; without,
    files are read in splits.  max_mb: refuse larger Excel files, which one
    process must read; 0 for no limit.
    """
    suffix = PurePosixPath(path).suffix.lower()
    if suffix not in SUFFIXES:
        raise ValueError(f"unsupported file type {suffix or path!r}; supported: {', '.join(SUFFIXES)}")
    if suffix == ".parquet":
        reader = spark.read.option("mergeSchema", True)
        df = (reader.option("basePath", base) if base else reader).parquet(path)
    elif suffix in SEPARATORS:
        df = _separated(spark, path, SEPARATORS[suffix], encoding, base, multiline)
    else:
        if max_mb > 0 and (size := _size_mb(spark, path)) > max_mb:
            raise ValueError(f"{path} has {size:.0f} MB, more than {max_mb}")
        df = _excel(spark, path)
    return df.toDF(*[c.lower() for c in df.columns])


def _separated(spark: SparkSession, path: str, sep: str, encoding: str, base: str | None, multiline: bool) -> DataFrame:
    given = {"header": True, "sep": sep, "encoding": charset(encoding), "quote": '"', "escape": '"', "multiLine": multiline, **({"basePath": base} if base else {})}
    inferred = lambda paths: spark.read.options(inferSchema=True, **given).csv(paths)
    files = _files(spark, path) if any(c in path for c in "*?[{") else [path]
    if len(files) < 2:
        return inferred(files or path)
    # Files with the same header are read together; only different ones are united.
    headers: dict[str, list[str]] = {}
    for f in files:
        headers.setdefault(_first_line(spark, f, given["encoding"]), []).append(f)
    groups = list(headers.values())
    frames = [inferred(g) for g in groups]
    if len(groups) == 1:
        return frames[0]
    # One type a column: what one group takes for a number, another may not.
    kinds: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds[f.name] = _wider(kinds.get(f.name, f.dataType), f.dataType)
    read_as = lambda df: T.StructType([T.StructField(f.name, kinds[f.name]) for f in df.schema.fields])
    same = lambda df: all(f.dataType == kinds[f.name] for f in df.schema.fields)
    frames = [df if same(df) else spark.read.options(**given).schema(read_as(df)).csv(g) for df, g in zip(frames, groups, strict=True)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    """Read on the driver, a few bytes of each file; no job."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(place).isDirectory():
        return path
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(place), encoding))
    try:
        return lines.readLine() or ""
    finally:
        lines.close()


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both: the longer number, or else text."""
    order = (T.IntegerType(), T.LongType(), T.DoubleType())
    if a == b:
        return a
    return max(a, b, key=order.index) if a in order and b in order else T.StringType()


def _excel(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet, read on the driver: names from its first row, a type for each column that holds all its cells."""
    if path.lower().endswith(".xls"):
        raise ValueError("the old binary Excel format cannot be read; save the file as .xlsx")
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(place)
    try:
        content = bytes(stream.readAllBytes())
    finally:
        stream.close()
    try:
        header, *rows = excel.rows(io.BytesIO(content)) or [[]]
    except (zipfile.BadZipFile, StopIteration, KeyError) as e:
        raise ValueError(f"{path} is no Excel file") from e
    names = [str(h) if h is not None else f"column_{i}" for i, h in enumerate(header, 1)]
    cells = [[r[i] if i < len(r) else None for i in range(len(names))] for r in rows if any(c is not None for c in r)]
    fields = []
    for i, name in enumerate(names):
        kinds = {type(r[i]) for r in cells} - {type(None)}
        whole = {frozenset(): T.StringType(), frozenset([int]): T.LongType(), frozenset([float]): T.DoubleType(), frozenset([int, float]): T.DoubleType(), frozenset([bool]): T.BooleanType(), frozenset([dt.datetime]): T.TimestampNTZType()}
        kind = whole.get(frozenset(kinds), T.StringType())
        made = {T.DoubleType: float, T.StringType: str}.get(type(kind), lambda v: v)
        for r in cells:
            r[i] = None if r[i] is None else made(r[i])
        fields.append(T.StructField(name, kind))
    return spark.createDataFrame([tuple(r) for r in cells], T.StructType(fields))
