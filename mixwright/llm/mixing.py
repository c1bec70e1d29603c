"""Mixing sources to target weights along a time-varying curriculum.

Every source gets a share of the words by weight, at most ``max_repeat`` times its own size. Its documents stand in a fixed
random order; the cumulative words before a document, inverted through the integral of the source's weight schedule, say at
which time of the training run the document comes. Documents are then range-sorted by that time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixwright.llm.common import WORD, checkpoint, let, text_or_empty

#: Weight schedules as (time, rate) knots, joined by straight lines; a source takes the one of its place among the sources.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
#: A source's documents are cut into groups of about this many before sizes are summed up along them.
GROUP_ROWS = 500


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def document_key() -> Column:
    """A hash of a row's doc_id and text, by which a source's documents are shuffled: ids may be null or repeated."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.md5(text_or_empty().cast("binary"))).cast("binary"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_repeat: int = 3) -> DataFrame:
    """(source, source_size, rows): one row a source -> the same with place and target.

    Sources stand by code point, null last, and weigh ``weights`` in turn. The level at which weight times level, stopped at
    ``max_repeat`` times the size, adds up to all words is found by filling sources in the order in which they stop.
    The table has a row a source, so its windows are one task of that many rows.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("place"), F.lit(len(weights))).cast("int") + 1)
    placed = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    placed = placed.withColumn("cap", (F.lit(max_repeat) * F.col("source_size")).cast("double")).withColumn("total", F.sum("source_size").over(everything).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    filled = placed.withColumn("before", F.sum("cap").over(order) - F.col("cap")).withColumn("left", F.sum("weight").over(everything) - F.sum("weight").over(order) + F.col("weight"))
    filled = filled.withColumn("level", (F.col("total") - F.col("before")) / F.col("left")).withColumn("rank", F.row_number().over(order))
    free = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("rank"))
    final = F.min_by("level", free).over(everything)
    return filled.withColumn("target", F.round(F.least(F.col("cap"), F.coalesce(F.col("weight") * final, F.col("cap"))), 6)).select("source", "source_size", "rows", "place", "target")


def arrival(fraction: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which a schedule has spent ``fraction`` of its integral: the inverse of a piecewise quadratic."""
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False)]
    total = sum(areas)
    spent = 0.0
    out = None
    for ((t0, r0), (t1, r1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        part = F.greatest(fraction * total - F.lit(spent), F.lit(0.0))
        slope = (r1 - r0) / (t1 - t0)
        # part = r0 x + slope x^2 / 2
        x = part / r0 if abs(slope) < 1e-12 else 2 * part / (r0 + F.sqrt(F.greatest(F.lit(r0 * r0) + 2 * slope * part, F.lit(0.0))))
        inside = fraction * total <= spent + area
        out = F.when(inside, t0 + x) if out is None else out.when(inside, t0 + x)
        spent += area
    return out.otherwise(F.lit(knots[-1][0]))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_repeat: int = 3, schedules=SCHEDULES) -> DataFrame:
    """``docs`` (doc_id, text, source) -> doc_id, size, source, source_size, target, taken, positions, sorted by the first of these.

    taken counts the words the mix takes of the document, repeats counted: a source whose target exceeds its size is gone
    through again, and the document at which the target ends is taken in part, so a source's words sum to the whole part
    of its target. positions (0 to 1) has the time of each use in order, as the source's demand reaches the document again;
    documents that aren't taken have none and come last.
    Null text counts as empty (size 0, taken 0); null source is a source. A source's documents stand by a hash of id and text; rows that are alike
    share their places in any order, with the same result. Empty tables give no rows. Extra columns are ignored.
    """
    sized = docs.select("doc_id", "source", word_count().alias("size"), document_key().alias("key"))
    sized = checkpoint(sized)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    most = sources.agg(F.max("rows")).first()[0] or 0
    digits = max(0, math.ceil(math.log(max(most, 1) / GROUP_ROWS, 16)))
    named = lambda d: d.withColumn("name", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
    grouped = named(sized).withColumn("part", F.substring("key", 1, digits) if digits else F.lit(""))
    # Sums by group, then sums along the groups of a source: no task holds a source.
    parts = grouped.groupBy("name", "part").agg(F.sum("size").alias("part_size"))
    along = Window.partitionBy("name").orderBy("part")
    parts = parts.withColumn("offset", F.sum("part_size").over(along) - F.col("part_size")).drop("part_size")
    parts = parts.join(named(targets(sources, weights, max_repeat)).drop("source", "rows"), "name")
    inside = Window.partitionBy("name", "part").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = grouped.withColumn("inner", F.sum("size").over(inside) - F.col("size")).join(parts, ["name", "part"])
    start = F.col("offset") + F.col("inner")
    goal = F.floor("target")
    taken = sum((F.least(F.greatest(goal - e * F.col("source_size") - start, F.lit(0)), F.col("size")) for e in range(1, max_repeat)), F.least(F.greatest(goal - start, F.lit(0)), F.col("size")))
    kind = F.pmod(F.col("place"), F.lit(len(schedules)))

    # Positions by lambdas, which stay out of generated code: written out for every use and schedule it grows too large.
    uses = F.filter(F.sequence(F.lit(0), F.lit(max_repeat - 1)), lambda e: (F.col("size") > 0) & (start + e * F.col("source_size") < goal))
    fraction = lambda e: F.coalesce(F.try_divide((start + e * F.col("source_size")).cast("double"), F.col("target")), F.lit(0.0))
    time = lambda f: F.coalesce(*(F.when(kind == i, arrival(f, s)) for i, s in enumerate(schedules)))
    mixed = placed.withColumn("taken", taken.cast("long")).withColumn("positions", F.transform(uses, lambda e: let(fraction(e), time)))
    # Those without a position are spread behind the others, else they'd all be one range.
    last = F.lit(2.0) + F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    return mixed.orderBy(F.coalesce(F.get("positions", F.lit(0)), last), "doc_id").select("doc_id", "size", "source", "source_size", "target", "taken", "positions", "key")


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with n_words, taken and positions, range-sorted by the first use into training order; rows of which the mix
    takes nothing are left out. Rows alike in id and text share the earliest positions and the largest taken of theirs. Columns
    that ``docs`` itself has under these names are kept as given_n_words, given_taken and given_positions; null ids and texts
    and empty tables are as in mix()."""
    made, own = ("n_words", "taken", "positions"), "_mixture_own_key_"
    mixed = mix(docs, **settings).where("taken > 0").groupBy(F.col("key").alias(own)).agg(F.max("size").alias("n_words"), F.max("taken").alias("taken"), F.min("positions").alias("positions"))
    kept = docs.withColumnsRenamed({c: f"given_{c}" for c in docs.columns if c in made})
    joined = kept.withColumn(own, document_key()).join(mixed, own).drop(own)
    first = F.get("positions", F.lit(0))
    return joined.repartitionByRange(first, "doc_id").sortWithinPartitions(first, "doc_id")
