"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing with exact reranking.

Vectors are hashed by K normal (2-stable) projections cut into slots; a bucket is a cell of slots. Of each table a query visits
buckets in the order of the estimated chance that a neighbour as near as its k-th lies there, until the chances add up to
``success``. That a neighbour has inner product s with the query's direction fixes the mean (s times the query's projection)
and the spread (what is left of its length) of its projections, which gives each slot's chance in closed form. The candidates of
all tables are scored exactly and merged.

Vectors are fitted on a bounded sample (``SAMPLE`` distinct vectors): the spread of projections, each query's estimated k-th
score, and a floor well under it from the sample, which saves candidates that can't be answers. Every row is indexed.
Equal vectors are one entry of the index with their k+1 smallest ids: more can't be among the nearest k of a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixwright.llm.common import checkpoint, forget
from mixwright.llm.vectors import Runs, matrix, unpacked, usable

#: Distinct vectors that the driver fits on, at most.
SAMPLE = 4096
TABLES, SUCCESS = 2, 0.74
#: Wanted entries of a bucket, from which the number of projections follows; slots are WIDTH times the root mean square length.
PER_BUCKET, WIDTH = 512, 1.5
#: Bits that a projection of such slots tells.
BITS = math.log2(math.sqrt(2 * math.pi * math.e) / WIDTH)
#: Rows and queries of a block.
ROWS, QUERIES = 1024, 256
#: Chance that a cell may lose while it is put together, by projection.
LOST = 0.002
FOUND = "query_id long, rank int, vec_id long, score double"
_PACKED = "t int, bucket long, uids binary, ids binary, ends binary, mat binary"
_ASKED = "t int, bucket long, qnos binary, qids binary, floors binary, qmat binary"


def normal_cdf(x: np.ndarray) -> np.ndarray:
    """By a published rational approximation of the error function, to seven digits."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    e = 1 - t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-z * z)
    return 0.5 * (1 + np.sign(x) * e)


class Family:
    """The hash functions of all tables, from a seed."""

    def __init__(self, dim: int, hashes: int, tables: int, width: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hashes, self.tables, self.width = hashes, tables, width
        self.lines = rng.standard_normal((tables, dim, hashes))
        self.shifts = rng.uniform(0, width, (tables, hashes))
        self.factors = rng.integers(0, 2**62, hashes, dtype=np.int64) * 2 + 1

    def buckets(self, x: np.ndarray, t: int) -> np.ndarray:
        slots = np.floor((x @ self.lines[t] + self.shifts[t]) / self.width).astype(np.int64)
        return (slots * self.factors).sum(axis=1)  # wraps: another bucket with the same number only adds candidates

    def visits(self, direction: np.ndarray, t: int, score: float, spread: float, success: float) -> np.ndarray:
        """Buckets in falling order of the chance that a neighbour of that inner product lies in them."""
        codes, chances = np.zeros(1, np.int64), np.ones(1)
        middle = (direction @ self.lines[t]) * score + self.shifts[t]
        for j in range(self.hashes):
            slots = np.arange(math.floor((middle[j] - 4 * spread) / self.width), math.floor((middle[j] + 4 * spread) / self.width) + 1)
            edges = normal_cdf((np.append(slots, slots[-1] + 1) * self.width - middle[j]) / spread)
            chances = (chances[:, None] * np.diff(edges)).ravel()
            codes = (codes[:, None] + slots.astype(np.int64) * self.factors[j]).ravel()
            order = np.argsort(-chances, kind="stable")
            codes, chances = codes[order], chances[order]
            kept = int(np.searchsorted(np.cumsum(chances), chances.sum() - LOST)) + 1
            codes, chances = codes[:kept], chances[:kept]
        enough = int(np.searchsorted(np.cumsum(chances), success)) + 1
        return codes[:enough]


class Fit:
    """What the sample says of a query: the estimated k-th score, the spread of a neighbour's projections, and the floor."""

    def __init__(self, sample: np.ndarray, n: int, k: int):
        self.sample, self.k = sample, k
        # What a rank of ten times k in all vectors is in the sample: under the k-th score, and with enough above it.
        self.rank = max(k + 1, math.ceil(10 * k * len(sample) / n))
        self.lengths = np.sqrt((sample**2).sum(axis=1))
        self.z = NormalDist().inv_cdf(min(max(1 - k / n, 1e-3), 1 - 1e-12))

    def of(self, q: np.ndarray) -> tuple[np.ndarray, float, float, float]:
        length = math.sqrt(float(q @ q))
        direction = q / length
        scores = self.sample @ direction
        order = np.argsort(-scores, kind="stable")
        near = order[: self.k + 1]
        floor = float(scores[order[self.rank - 1]]) if len(order) >= self.rank else -math.inf
        reach = math.sqrt(float((self.lengths[near] ** 2).mean()))
        score = min(max(float(scores.mean() + self.z * scores.std()), float(scores[near[-1]]) if len(near) > self.k else -math.inf), 0.999 * reach)
        return direction, score, math.sqrt(max(reach**2 - score**2, 1e-6 * reach**2)), floor * length - 1e-9 * abs(floor * length) if math.isfinite(floor) else floor


def _blocks(rows: DataFrame, fields: list[str], most: int, pack, schema: str) -> DataFrame:
    """Rows of a bucket packed into blocks of at most ``most``: dealt by range, so that a large bucket spans several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(most)

        def out(found):
            rows_ = [(*key, *pack(columns)) for key, columns in found]
            if rows_:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_, strict=True), [pa.int32(), pa.int64(), *[pa.binary()] * (len(rows_[0]) - 2)], strict=True)], names=[p.split()[0] for p in schema.split(", ")])

        for b in batches:
            keys = np.stack([b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy()], axis=1)
            yield from out(runs.add(keys, [b.column(i) for i in range(2, b.num_columns)]))
        yield from out(runs.flush())

    return rows.select("t", "bucket", *fields).repartitionByRange("t", "bucket", fields[0]).sortWithinPartitions("t", "bucket", fields[0]).mapInArrow(run, schema)


def search(rows: DataFrame, queries: DataFrame, k: int = 20, tables: int = TABLES, success: float = SUCCESS, per_bucket: int = PER_BUCKET, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` rows of the largest inner product with each query, as far as found: query_id, rank, vec_id, score.

    ``rows`` and ``queries`` have vec_id and embedding; other columns are ignored, whatever their names. A query is a row of
    ``rows`` too and isn't its own answer: own is what has its id and its vector, so that of rows which share an id each counts.
    Wholly repeated rows count once. Rows without an id, and vectors that are null, empty, zero or hold null or non-finite
    components take no part; shorter vectors count as padded with zeros. Ties go to the smaller vec_id. Empty tables give no rows.
    """
    spark = rows.sparkSession
    nonzero = F.exists("vec", lambda x: x != 0.0)
    full = usable(rows).where(nonzero)
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    entries = full.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = checkpoint(entries.withColumn("uid", F.monotonically_increasing_id()))
    asked = checkpoint(usable(queries).where(nonzero).withColumn("qno", F.monotonically_increasing_id()))
    n, dim, asked_dim = entries.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0)), F.lit(0)).first()
    asked_dim = asked.agg(F.coalesce(F.max(F.size("vec")), F.lit(0))).first()[0]
    dim = max(dim, asked_dim)
    if not n or not asked_dim:
        return spark.createDataFrame([], FOUND)
    # The entries of the smallest hashes: about twice as many are looked at as are kept.
    digest = F.pmod(F.xxhash64("vec"), F.lit(1 << 20))
    drawn = entries.where(digest < math.ceil(min(1.0, 2 * sample / n + 0.001) * (1 << 20))).orderBy(F.xxhash64("vec"), "uid").limit(sample).select("vec").toArrow()
    fit = Fit(matrix(drawn.column("vec").combine_chunks(), dim), n, k)
    hashes = math.floor(math.log2(max(n / per_bucket, 1)) / BITS)
    family = Family(dim, hashes, tables, WIDTH * max(math.sqrt(float((fit.lengths**2).mean())), 1e-300))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(2), dim)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(family.buckets(x, t)), *b.columns], names=["t", "bucket", "uid", "ids", "vec"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(2), dim)
            for at in range(0, len(x), QUERIES):  # what leaves at once is bounded by the visits of so many queries
                ts, codes, which, floors = [], [], [], []
                for i in range(at, min(at + QUERIES, len(x))):
                    direction, score, spread, floor = fit.of(x[i])
                    for t in range(tables):
                        found = family.visits(direction, t, score, spread, success)
                        ts.append(np.full(len(found), t, np.int32))
                        codes.append(found)
                        which.append(np.full(len(found), i))
                        floors.append(np.full(len(found), floor))
                take = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ts)), pa.array(np.concatenate(codes)), b.column(0).take(take), b.column(1).take(take), b.column(2).take(take), pa.array(np.concatenate(floors))], names=["t", "bucket", "qno", "vec_id", "vec", "floor"])

    def pack_entries(c) -> tuple:
        return c[0].to_numpy().tobytes(), c[1].flatten().to_numpy().tobytes(), np.cumsum(c[1].value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64).tobytes(), matrix(c[2], dim).tobytes()

    def pack_queries(c) -> tuple:
        return c[0].to_numpy().tobytes(), c[1].to_numpy().tobytes(), c[2].to_numpy().tobytes(), matrix(c[3], dim).tobytes()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                uids, ids, ends, qnos, qids = (unpacked(b.column(c)[r].as_py(), dtype=np.int64) for c in ("uids", "ids", "ends", "qnos", "qids"))
                floors, x, q = unpacked(b.column("floors")[r].as_py()), unpacked(b.column("mat")[r].as_py(), dim), unpacked(b.column("qmat")[r].as_py(), dim)
                near, starts = q @ x.T, ends - np.diff(ends, prepend=0)
                made = {"qno": [], "query_id": [], "found": []}
                for i in range(len(q)):
                    at = np.flatnonzero(near[i] >= floors[i])
                    if len(at) > k + 9:  # sums of matrix products differ in the last bits: a few more than needed
                        at = at[np.argpartition(-near[i][at], k + 8)[: k + 9]]
                    if not len(at):
                        continue
                    exact, own = (x[at] * q[i]).sum(axis=1), (x[at] == q[i]).all(axis=1)
                    each = [(-float(s), int(v), int(uids[e])) for e, s, o in zip(at, exact, own, strict=True) for v in ids[starts[e] : ends[e]] if not (o and v == qids[i])]
                    made["qno"].append(int(qnos[i]))
                    made["query_id"].append(int(qids[i]))
                    made["found"].append([{"less": s, "vec_id": v, "uid": u} for s, v, u in sorted(each)[:k]])
                if made["qno"]:
                    yield pa.RecordBatch.from_pydict(made, schema=pa.schema([("qno", pa.int64()), ("query_id", pa.int64()), ("found", pa.list_(pa.struct([("less", pa.float64()), ("vec_id", pa.int64()), ("uid", pa.int64())])))]))

    index = _blocks(entries.select("uid", "ids", "vec").mapInArrow(hashed, "t int, bucket long, uid long, ids array<long>, vec array<double>"), ["uid", "ids", "vec"], ROWS, pack_entries, _PACKED)
    probes = _blocks(asked.select("qno", "vec_id", "vec").mapInArrow(visits, "t int, bucket long, qno long, vec_id long, vec array<double>, floor double"), ["qno", "vec_id", "floor", "vec"], QUERIES, pack_queries, _ASKED)
    found = index.join(probes, ["t", "bucket"]).mapInArrow(scored, "qno long, query_id long, found array<struct<less: double, vec_id: long, uid: long>>")
    merged = found.groupBy("qno", "query_id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), 1, k).alias("found"))
    out = merged.select("query_id", F.posexplode("found").alias("place", "one")).select("query_id", (F.col("place") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (0.0 - F.col("one.less")).alias("score"))
    out = checkpoint(out)
    forget(entries, asked)
    return out
