"""Connected components over edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import checkpoint, forget


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> node, component, a row for each node that has an edge; component is the least node of its component.

    Every round contracts: each node moves to the neighbour that a hash, another one each round, ranks least, if that is below
    its own; edges move with their ends, and loops and repeats go. Edges fall by a constant factor a round, so all rounds
    together read little more than the first. The moves are then composed from the last round back.
    Edges with a null end and loops are left out; repeated edges count once.
    """
    tidy = lambda pairs: pairs.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left, moves = checkpoint(tidy(edges)), []
    while not left.isEmpty():
        rank = lambda node, turn=len(moves): F.struct(F.xxhash64(F.lit(turn), F.col(node)).alias("hash"), F.col(node).alias("node"))
        sides = left.select(F.col("a").alias("node"), rank("b").alias("near")).unionByName(left.select(F.col("b").alias("node"), rank("a").alias("near")))
        nearest = sides.groupBy("node").agg(F.min("near").alias("near"))
        moved = checkpoint(nearest.select("node", F.when(F.col("near") < rank("node"), F.col("near.node")).otherwise(F.col("node")).alias("goal")))
        moves.append(moved)
        previous = left
        ends = left.join(moved.select(F.col("node").alias("a"), F.col("goal").alias("to_a")), "a").join(moved.select(F.col("node").alias("b"), F.col("goal").alias("to_b")), "b")
        left = checkpoint(tidy(ends.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))))
        forget(previous)
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    forget(left)
    used, last = list(moves), moves.pop()
    while moves:
        further = last.select(F.col("node").alias("goal"), F.col("goal").alias("end"))
        last = moves.pop().join(further, "goal", "left").select("node", F.coalesce("end", "goal").alias("goal"))
    last = checkpoint(last)
    out = checkpoint(last.join(last.groupBy("goal").agg(F.min("node").alias("component")), "goal").select("node", "component"))
    forget(last, *used)
    return out
