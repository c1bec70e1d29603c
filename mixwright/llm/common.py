"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: what the session has set, spark.checkpoint.dir, or the warehouse."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared:  # the warehouse is shared by definition
            shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
        context.setCheckpointDir(shared)
    return context._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again: a lost executor costs a reread and not a recomputation.

    A table has no more than its schema and size; DataFrame.checkpoint() also keeps the constraints that the optimizer infers,
    which grow with every round of a loop until planning takes most of the time and of the driver's memory.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forget(*tables: DataFrame) -> None:
    """Delete what ``checkpoint`` has written of ``tables``, when all that is computed from them is written itself."""
    for table_ in tables:
        if path := getattr(table_, "written_to", None):
            remove(table_.sparkSession, path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a name: evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def prefix_sums(values: Column) -> Column:
    """What stands before each element of an array of numbers, summed up, and behind the last: one element more. A fold that
    grows an array copies it at every step, so sums are grown in blocks of about the root of the length."""
    grown = lambda first, part: F.aggregate(part, F.array(first), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v.cast("long"))))

    def blocks(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int"), F.lit(1))
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(0), F.size(v) - 1, width)).otherwise(F.array().cast("array<int>"))
        parts = F.transform(starts, lambda s: F.slice(v, s + 1, width))
        return let(F.struct(parts.alias("parts"), grown(F.lit(0).cast("long"), F.transform(parts, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")))).alias("firsts")), joined)

    def joined(s: Column) -> Column:
        inner = F.transform(s["parts"], lambda p, i: let(grown(F.get(s["firsts"], i), p), lambda g: F.slice(g, 1, F.size(g) - 1)))
        return F.concat(F.flatten(inner), F.array(F.element_at(s["firsts"], -1)))

    return let(values, blocks)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def salted_join(large: DataFrame, small: DataFrame, keys: Sequence[str], salt: Column, salts: int = 16) -> DataFrame:
    """Inner join for a ``large`` side whose keys may hold most rows, with a ``small`` side of one row a key: the rows of a
    key are dealt over ``salts`` tasks and the small side is repeated as often. Works at any size of either side."""
    dealt = large.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*keys, "_salt"]).drop("_salt")
