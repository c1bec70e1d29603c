"""Hard negatives by distributed radix selection over integer scores.

A request is an anchor, a window of scores and a number k: which rows of the window come first, by score and then by the smaller
vec_id? No request's rows are gathered to find out. Each round counts, by request, how many rows of the window have each leading
digit of the score; running counts from the top tell the digit in which the k-th row lies, and the next round looks at that digit
alone, until the k-th score is known. Where more rows share it than are wanted, their vec_ids are refined digit by digit in the
same way. Then only the rows that qualify leave their tasks.

Anchors are a stated query set: they meet all rows in blocks, tile by tile. A tile counts what lies over its own k-th row and no
more: what lies under it can't come first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixwright.llm.common import checkpoint, forget
from mixwright.llm.vectors import matrix, products, unpacked, usable

#: Rows and anchors of a tile, and bits of a digit.
ROWS, ANCHORS, DIGIT = 4096, 256, 9
SCALE = 256
NEGATIVES = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_MOST = 2**63 - 1
_PACKED = "part long, uids binary, ids binary, labels binary, mat binary"


def quantized(rows: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, vec and uid of the rows that take part, components as whole numbers; written, so that uid stays."""
    used = usable(rows.select("vec_id", label.cast("long").alias("label"), "embedding"), "label").where("label is not null")
    return checkpoint(used.withColumn("vec", F.transform("vec", lambda x: F.floor(x * SCALE).cast("long"))).withColumn("uid", F.monotonically_increasing_id()))


def _packed(rows: DataFrame, dim: int, most: int) -> DataFrame:
    """Blocks of up to ``most`` rows as they lie in their partitions."""
    fields = ["uid", "vec_id", "label"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def blocks(all_: bool):
            nonlocal held
            t = pa.Table.from_batches(held).combine_chunks() if held else None
            while t is not None and t.num_rows and (all_ or t.num_rows >= most):
                b, t = t.slice(0, most), t.slice(most)
                uids, ids, labels = (b.column(c).combine_chunks().to_numpy() for c in fields)
                vectors = pa.concat_arrays(b.column("vec").chunks)
                yield pa.RecordBatch.from_pydict({"part": [int(uids[0])], "uids": [uids.tobytes()], "ids": [ids.tobytes()], "labels": [labels.tobytes()], "mat": [matrix(vectors, dim, np.int64).tobytes()]})
            held = t.to_batches() if t is not None and t.num_rows else []

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= most:
                yield from blocks(False)
        yield from blocks(True)

    return rows.select(*fields, "vec").mapInArrow(pack, _PACKED)


class Selection:
    """Selects, for requests on anchors, the first rows among ``rows`` of the same or of other labels."""

    def __init__(self, rows: DataFrame, anchors: DataFrame):
        """``rows`` from quantized(); ``anchors``: those of them that requests are about."""
        self.spark = rows.sparkSession
        self.dim, self.id_low, self.id_high, n = rows.agg(F.max(F.size("vec")), F.min("vec_id"), F.max("vec_id"), F.count("*")).first()
        self.empty = not n
        if self.empty:
            return
        self.rows = checkpoint(_packed(rows, self.dim, ROWS))
        blocks = _packed(anchors.repartitionByRange("uid"), self.dim, ANCHORS)
        self.blocks = checkpoint(blocks.select("part", F.col("uids").alias("a_uids"), F.col("labels").alias("a_labels"), F.col("mat").alias("a_mat")))
        self.tiles = max(1, self.rows.count())

    def close(self) -> None:
        if not self.empty:
            forget(self.rows, self.blocks)

    def _tiles(self, requests: DataFrame, work, schema: str) -> DataFrame:
        """``work`` on each pair of a block of anchors with open requests and a block of rows: both are dealt to numbered
        tiles, where the blocks of anchors meet every block of rows once."""
        wants = requests.groupBy("block").agg(F.collect_list(F.struct("uid", F.struct("slot", "floor", "top", "low", "high", "need", "id_low", "id_high", "stage").alias("want"))).alias("wants"))
        asked = self.blocks.join(wants, self.blocks["part"] == wants["block"]).select("a_uids", "a_labels", "a_mat", "wants", F.explode(F.sequence(F.lit(0), F.lit(self.tiles - 1))).alias("tile"))
        there = self.rows.withColumn("tile", F.pmod(F.xxhash64("part"), F.lit(self.tiles)).cast("int")).drop("part")
        dim = self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    get = lambda c, d=0: unpacked(b.column(c)[r].as_py(), d, np.int64)  # noqa: B023, E731
                    uids, ids, labels, a_uids, a_labels = (get(c) for c in ("uids", "ids", "labels", "a_uids", "a_labels"))
                    scores = products(get("a_mat", dim), get("mat", dim))
                    place = {int(u): i for i, u in enumerate(a_uids)}
                    for w in b.column("wants")[r].as_py():
                        i = place[w["uid"]]
                        yield w["uid"], w["want"], scores[i], labels == a_labels[i], uids != w["uid"], ids, uids

        fields = [(name, pa.int32() if kind == "int" else pa.int64()) for name, kind in (p.split() for p in schema.split(", "))]

        def batch(held: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held, strict=True), fields, strict=True)], schema=pa.schema(fields))

        def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list = []
            for one in run(batches):
                held.extend(work(*one))
                if len(held) > 20_000:
                    yield batch(held)
                    held = []
            if held:
                yield batch(held)

        # So many partitions: their work is what counts, not their bytes.
        dealt = [side.repartition(self.tiles, "tile") for side in (there, asked)]
        return dealt[0].join(dealt[1], "tile").drop("tile").mapInArrow(batched, schema)

    def first(self, requests: DataFrame, k: int, same: bool) -> DataFrame:
        """``requests`` (uid, slot, floor, top): the first ``k`` rows of each with floor <= score <= top, of the anchor's label
        or of others -> uid, slot, rank, score, vec_id, row. An anchor is no row of its own."""
        state = checkpoint(
            self._with_block(requests).select("block", "uid", "slot", "floor", "top", F.col("floor").alias("low"), F.col("top").alias("high"), F.lit(k).cast("long").alias("need"), F.lit(self.id_low).alias("id_low"), F.lit(self.id_high).alias("id_high"), F.lit("score").alias("stage"))
        )
        while not state.where("stage <> 'done'").isEmpty():
            todo = state.where("stage <> 'done'")
            counted = self._tiles(todo, _counter(same), "uid long, slot int, digit long, n long").groupBy("uid", "slot", "digit").agg(F.sum("n").alias("n"))
            rest = checkpoint(_narrowed(todo, counted).unionByName(state.where("stage = 'done'")))
            forget(state)
            state = rest
        # The k-th row of each is known: no task gives more rows of a request than that.
        found = self._tiles(state, _gatherer(same, k), "uid long, slot int, score long, vec_id long, row long")
        place = F.row_number().over(Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "vec_id", "row"))
        out = checkpoint(found.withColumn("rank", place).where(F.col("rank") <= k))
        forget(state)
        return out

    def _with_block(self, requests: DataFrame) -> DataFrame:
        """Each request with the block that holds its anchor."""

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for part, uids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    at = unpacked(uids, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), part)), pa.array(at)], names=["block", "uid"])

        return requests.join(self.blocks.select("part", "a_uids").mapInArrow(members, "block long, uid long"), "uid")


def _shift(low: int, high: int) -> int:
    return max(0, (high - low).bit_length() - DIGIT)


def _inside(want: dict, scores: np.ndarray, alike: np.ndarray, others: np.ndarray, same: bool) -> np.ndarray:
    return (alike if same else ~alike) & others & (scores >= want["low"]) & (scores <= want["high"])


def _counter(same: bool):
    def work(uid, want, scores, alike, others, ids, _uids):
        inside = _inside(want, scores, alike, others, same)
        if want["stage"] == "score":
            values, low, high, step = scores[inside], want["low"], want["high"], -1
        else:
            values, low, high, step = ids[inside], want["id_low"], want["id_high"], 1
            values = values[(values >= low) & (values <= high)]
        if not len(values):
            return []
        # Unsigned: the distance of two 64-bit numbers may need all 64 bits.
        digits, n = np.unique((values.view(np.uint64) - np.uint64(low % 2**64)) >> np.uint64(_shift(low, high)), return_counts=True)
        digits, n = digits[::step], n[::step]
        kept = int(np.searchsorted(np.cumsum(n), want["need"])) + 1
        return [(uid, want["slot"], int(d), int(c)) for d, c in zip(digits[:kept], n[:kept], strict=True)]

    return work


def _gatherer(same: bool, k: int):
    def work(uid, want, scores, alike, others, ids, uids):
        inside = (alike if same else ~alike) & others & (scores >= want["low"]) & (scores <= want["top"])
        inside &= (scores > want["low"]) | (ids <= want["id_high"])
        at = np.flatnonzero(inside)
        at = at[np.lexsort((uids[at], ids[at], -scores[at]))[:k]]
        return [(uid, want["slot"], int(scores[i]), int(ids[i]), int(uids[i])) for i in at]

    return work


def _narrowed(todo: DataFrame, counted: DataFrame) -> DataFrame:
    """Requests after a round. ``low`` is the least score that still qualifies; in the id stage it is the k-th score, and
    ``id_high`` the largest vec_id that qualifies at it."""
    far = todo.select("uid", "slot", "stage", "need").join(counted, ["uid", "slot"])
    sign = F.when(F.col("stage") == "score", -F.col("digit")).otherwise(F.col("digit"))
    running = F.sum("n").over(Window.partitionBy("uid", "slot").orderBy(sign).rowsBetween(Window.unboundedPreceding, 0))
    hit = far.withColumn("running", running).where((F.col("running") >= F.col("need")) & (F.col("running") - F.col("n") < F.col("need"))).select("uid", "slot", "digit", "running", "n")
    rows = todo.join(hit, ["uid", "slot"], "left")
    wide = "decimal(38,0)"
    by_score = F.col("stage") == "score"
    a, b = F.when(by_score, F.col("low")).otherwise(F.col("id_low")).cast(wide), F.when(by_score, F.col("high")).otherwise(F.col("id_high")).cast(wide)
    bits = F.when(b == a, 0).otherwise(F.length(F.regexp_replace(F.conv((b - a).cast("string"), 10, 2), "^0+", "")))
    rows = rows.withColumn("width", F.element_at(F.array(*(F.lit(str(2**e)).cast(wide) for e in range(65))), F.greatest(F.lit(0), bits - DIGIT) + 1)).withColumn("a", a).withColumn("b", b)
    start = (F.col("a") + F.col("digit").cast(wide) * F.col("width")).cast(wide)
    stop = F.least(F.col("b"), (start + F.col("width") - 1).cast(wide))
    rows = rows.withColumn("start", start.cast("long")).withColumn("stop", stop.cast("long")).withColumn("left", F.col("need") - F.col("running") + F.col("n"))
    none, whole, single = F.col("digit").isNull(), F.col("running") == F.col("need"), F.col("start") == F.col("stop")
    keep = lambda name, new: F.when(none, F.col(name)).otherwise(new).alias(name)
    return rows.select(
        "block", "uid", "slot", "floor", "top",
        keep("low", F.when(by_score, F.col("start")).otherwise(F.col("low"))), keep("high", F.when(by_score, F.col("stop")).otherwise(F.col("high"))), keep("need", F.col("left")),
        keep("id_low", F.when(by_score, F.col("id_low")).otherwise(F.col("start"))), keep("id_high", F.when(by_score, F.col("id_high")).otherwise(F.col("stop"))),
        F.when(none | whole, "done").when(by_score & single, "id").when(~by_score & single, "done").otherwise(F.col("stage")).alias("stage"),
    )


def mine(rows: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """For each anchor and each of its ``positives`` first other rows of its label, the first ``negatives`` rows of other labels
    with ``least`` to ``most`` percent of the positive's score -> anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    ``rows`` has vec_id, embedding and what ``label`` and ``is_anchor`` read; further columns are ignored, whatever their names.
    Components become floor(256 x). Rows without a vec_id, a label or a vector, with an empty one, or with null or non-finite
    components take no part; shorter vectors count as padded with zeros; wholly repeated rows count once; rows that share a
    vec_id are rows of their own, each an anchor where the id is one. Ties go to the smaller vec_id. Scores beyond 64 bits end
    at the largest long. Anchors without a positive, and positives without a negative in the window, give no row, as do empty
    tables.
    """
    spark = rows.sparkSession
    used = quantized(rows, label)
    anchors = used.where(is_anchor)
    choice = Selection(used, anchors)
    if choice.empty:
        forget(used)
        return spark.createDataFrame([], NEGATIVES)
    # By Cauchy and Schwarz no score is further from 0 than this.
    longest = used.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()[0]
    reach = min(int(longest * 1.000001) + 1, _MOST)
    near = choice.first(anchors.select("uid", F.lit(0).alias("slot"), F.lit(-reach).cast("long").alias("floor"), F.lit(reach).cast("long").alias("top")), positives, same=True)
    # floor <= score <= top in whole numbers; the window of a negative score is empty.
    p = F.col("score").cast("decimal(38,0)")
    windows = near.select("uid", F.col("rank").alias("slot"), F.ceil(p * least / 100).cast("long").alias("floor"), F.floor(p * most / 100).cast("long").alias("top")).where("floor <= top")
    hard = choice.first(windows, negatives, same=False)
    named = near.select("uid", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.select("uid", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(named, ["uid", "slot"]).join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    out = checkpoint(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    choice.close()
    forget(used, near, hard)
    return out
