"""Exact percentiles of any number of rows: distributed selection by bucket counts.

No task holds a column. Each round counts, within the range in which a wanted rank lies, how many values fall in each of BUCKETS
equal parts, with the least and the largest of each; partial counts are combined before they are shuffled. The part that holds
the rank is the next range. When it holds few rows, or one value, only its rows are sorted and the rank is read off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixwright.sources.shared import drop, written

BUCKETS = 1024
#: Rows of a range that one task sorts.
FEW = 4096


def percentiles(rows: DataFrame, by: list[str], value: str, shares: list[float], buckets: int = BUCKETS, few: int = FEW) -> DataFrame:
    """``by``, share, value: the ``shares`` of the non-null, finite values of each group, interpolated between the two ranks
    beside them, as percentile() does. Groups without a value give no row; NaN is left out."""
    x = F.col(value).cast("double")
    rows = rows.select(*by, (x + 0.0).alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    wanted = F.explode(F.array(*(F.lit(float(s)) for s in shares)))
    ends = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    asked = ends.withColumn("share", wanted).withColumn("_p", F.col("share") * (F.col("_n") - 1))
    # A range is all that is known of a rank: how many values lie under it, and how many in it.
    ranks = asked.select(*by, F.explode(F.array_distinct(F.array(F.floor("_p"), F.ceil("_p")))).alias("_rank"), "_lo", "_hi", F.col("_n").alias("_in"), F.lit(0).cast("long").alias("_under")).distinct()
    ranks = written(ranks)
    while not ranks.where((F.col("_in") > few) & (F.col("_lo") < F.col("_hi"))).isEmpty():
        narrowed = written(_narrowed(rows, ranks, by, buckets, few))
        drop(ranks)
        ranks = narrowed
    found = written(_read_off(rows, ranks, by))
    pairs = asked.withColumn("_a", F.floor("_p")).withColumn("_b", F.ceil("_p"))
    for side in ("_a", "_b"):
        pairs = pairs.join(_keyed(found, by, "_rank", "_x"), [*_alike(by), F.col(side) == F.col("_r_rank")]).select(*pairs.columns, F.col("_r_x").alias(f"_x{side[1]}"))
    part = F.col("_p") - F.col("_a")
    out = written(pairs.select(*by, "share", F.when(part == 0, F.col("_xa")).otherwise(F.col("_xa") * (1 - part) + F.col("_xb") * part).alias("value")))
    drop(ranks, found)
    return out


def _keyed(df: DataFrame, by: list[str], *more: str) -> DataFrame:
    """``df`` with its key columns under names of their own, for a join with a table that has the same ones."""
    return df.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), *(F.col(c).alias(f"_r{c}") for c in more))


def _alike(by: list[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]


def _inside(rows: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    """Each value with the ranges that it lies in: a few ranges a group, which Spark sends to all tasks while they are small."""
    keyed = _keyed(ranges.select(*by, "_lo", "_hi").distinct(), by, "_lo", "_hi")
    return rows.join(keyed, [*_alike(by), F.col("_v") >= F.col("_r_lo"), F.col("_v") <= F.col("_r_hi")]).select(*by, F.col("_r_lo").alias("_lo"), F.col("_r_hi").alias("_hi"), "_v")


def _narrowed(rows: DataFrame, ranks: DataFrame, by: list[str], buckets: int, few: int) -> DataFrame:
    open_ = (F.col("_in") > few) & (F.col("_lo") < F.col("_hi"))
    todo = ranks.where(open_)
    # Of a range so wide that its length is no double, halves are taken. The ends never fall in one bucket.
    huge = F.col("_hi") / 2 - F.col("_lo") / 2 > 1e300
    v, lo, hi = (F.when(huge, F.col(c) / 2).otherwise(F.col(c)) for c in ("_v", "_lo", "_hi"))
    place = F.least(F.floor((v - lo) / (hi - lo) * buckets), F.lit(buckets - 1))
    counted = _inside(rows, todo, by).groupBy(*by, "_lo", "_hi", place.alias("_place")).agg(F.count("*").alias("_m"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    up_to = F.sum("_m").over(Window.partitionBy(*by, "_lo", "_hi").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0))
    parts = _keyed(counted.withColumn("_up", up_to), [*by, "_lo", "_hi"], "_m", "_up", "_least", "_most")
    start = F.col("_under") + F.col("_r_up") - F.col("_r_m")
    hit = todo.join(parts, [*_alike([*by, "_lo", "_hi"]), F.col("_rank") >= start, F.col("_rank") < F.col("_under") + F.col("_r_up")])
    narrowed = hit.select(*by, "_rank", F.col("_r_least").alias("_lo"), F.col("_r_most").alias("_hi"), F.col("_r_m").alias("_in"), start.alias("_under"))
    return narrowed.unionByName(ranks.where(~open_))


def _read_off(rows: DataFrame, ranks: DataFrame, by: list[str]) -> DataFrame:
    known = ranks.where("_lo = _hi").select(*by, "_rank", F.col("_lo").alias("_x"))
    todo = ranks.where("_lo < _hi")
    place = F.row_number().over(Window.partitionBy(*by, "_lo", "_hi").orderBy("_v")) - 1
    placed = _keyed(_inside(rows, todo, by).withColumn("_place", place), [*by, "_lo", "_hi"], "_place", "_v")
    return known.unionByName(todo.join(placed, [*_alike([*by, "_lo", "_hi"]), F.col("_rank") - F.col("_under") == F.col("_r_place")]).select(*by, "_rank", F.col("_r_v").alias("_x")))


def wide(found: DataFrame, by: list[str], names: dict[float, str]) -> DataFrame:
    """A row a group, a column a share."""
    cells = [F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in names.items()]
    return found.groupBy(*by).agg(*cells) if by else found.agg(*cells)
