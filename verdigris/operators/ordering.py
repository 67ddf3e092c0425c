"""Places in a global order without moving all rows to one partition."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.scratch import scratch

_TERM = re.compile(r"^(.*?)(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?\s*$", re.IGNORECASE | re.DOTALL)


def split_terms(sql: str) -> list[str]:
    """The terms of an ORDER BY, split at commas outside brackets and quotes."""
    terms, depth, quote, at = [], 0, "", 0
    for i, c in enumerate(sql):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == "," and not depth:
            terms.append(sql[at:i])
            at = i + 1
    return [t.strip() for t in [*terms, sql[at:]] if t.strip()]


def order_columns(sql: str) -> list[Column]:
    """The columns of an ORDER BY text, with the directions and null orders that it names or Spark's own."""
    out = []
    for term in split_terms(sql):
        expr, way, nulls = _TERM.match(term).groups()
        col, down = F.expr(expr), (way or "").upper() == "DESC"
        nulls = (nulls or ("LAST" if down else "FIRST")).upper()
        out.append(getattr(col, f"{'desc' if down else 'asc'}_nulls_{nulls.lower()}")())
    return out


def placed(df: DataFrame, order: list[Column], within: list[str] = (), parts: int | None = None, label: str = "placed") -> DataFrame:
    """df with _rank, the 1-based place in the order, and _pos, the 0-based place among rows equal in ``within``.

    Rows are range-partitioned and sorted once and written down; places are the
    counts of earlier partitions, which are few, plus the place in the own one.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = scratch(dealt.withColumns({"_part": F.spark_partition_id(), "_nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), label)
    earlier = lambda *by: W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(earlier(F.lit(1))), F.lit(0)).alias("_before"))
    out = dealt.join(F.broadcast(counts), "_part")  # one row a partition
    out = out.withColumn("_rank", F.col("_before") + F.col("_nth") + 1).drop("_before")
    if not within:
        return out.withColumn("_pos", F.col("_rank") - 1).drop("_part", "_nth")
    named = [F.col(c).alias(f"_g{i}") for i, c in enumerate(within)]
    groups = [f"_g{i}" for i in range(len(within))]
    local = dealt.groupBy("_part", *named).agg(F.count("*").alias("_n")).select("_part", *groups, F.coalesce(F.sum("_n").over(earlier(*groups)), F.lit(0)).alias("_ahead")).withColumnRenamed("_part", "_p")
    same = [F.col(c).eqNullSafe(F.col(g)) for c, g in zip(within, groups, strict=True)]
    out = out.withColumn("_own", F.row_number().over(W.partitionBy("_part", *within).orderBy("_nth")))
    on = F.col("_part") == F.col("_p")
    for s in same:
        on = on & s
    return out.join(local, on).withColumn("_pos", F.col("_ahead") + F.col("_own") - 1).drop("_part", "_nth", "_p", "_own", "_ahead", *groups)
