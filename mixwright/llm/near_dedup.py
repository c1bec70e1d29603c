"""Near-duplicates by Order MinHash.

Exact copies are put together first. Each different text is sketched: of its occurrence-labelled five-word shingles every
sketch takes the ``ELL`` with the least hash and keeps them in text order. Texts that agree in a sketch meet in a bucket, and
the first of a bucket is aligned with the others (word edit distance in a band): all that most buckets, which hold copies of
one text, need. Of buckets that their first does not reach whole, such as those of a passage that many texts share, each text
meets each of another component, whatever the size of the bucket: their bags of words rule out what can't be within the edit
bound, and the rest is aligned. Of a large bucket the tasks that compare bags name the texts left with a partner, and those that
align them the links that join components: neither hands on pairs. Links are closed to classes by connected components.
Alignment compares words by 32 bits of a hash of each.

A different text is a node of its own, whatever the doc_id of its rows: rows that share an id, or have none, are neither merged
nor lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixwright.llm.align import banded_distance
from mixwright.llm.common import checkpoint, forget
from mixwright.llm.components import components

#: At ``SIMILARITY`` two texts whose edits are scattered share a fifth of their shingles; the README has the measured share of
#: such pairs that meet in one of so many sketches.
SHINGLE, ELL, SKETCHES, SIMILARITY = 5, 2, 96, 0.8
#: Texts of a key are compared in blocks of about so many, each pair of blocks in one task; so many texts with all of the block
#: at once; and classes of words that a text's bag counts.
BLOCK, ROWS, BAG = 2048, 256, 512
#: Texts are aligned in blocks of about so many, of so many bytes each on average at most.
ALIGNED, ALIGNED_BYTES = 64, 1 << 15
#: Of a key with at most so many texts all pairs are formed.
FEW = 16
#: Pairs that one text takes part in as the first are dealt over tasks in lots of this many.
LOT = 64

_B = 0x9E3779B97F4A7C15
_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_SEEDS = np.array([int.from_bytes(hashlib.blake2b(b"sketch%d" % i, digest_size=8).digest(), "little") for i in range(256)], np.uint64)


class _Letters:
    """Lower case by code point, 0 for what is no letter or digit; and powers for polynomial hashes, longer as needed."""

    def __init__(self):
        self.low = np.zeros(0x10000, np.uint32)
        for i in range(0x10000):
            if not 0xD800 <= i <= 0xDFFF and (c := chr(i)).isalnum():
                low = c.lower()
                self.low[i] = ord(low) if len(low) == 1 else i
        self.powers, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.powers.size:
            n = max(n, 2 * self.powers.size, 1 << 14)
            base, back = np.uint64(_B), np.uint64(pow(_B, -1, 1 << 64))
            self.powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, base, np.uint64))])
            self.inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, back, np.uint64))])
        return self.powers[:n], self.inverse[:n]


_LETTERS: list[_Letters] = []


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def words(text: str) -> np.ndarray:
    """A hash of each word: runs of letters and digits in lower case."""
    if not _LETTERS:
        _LETTERS.append(_Letters())
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _LETTERS[0].low[np.minimum(raw, 0xFFFF)]
    if raw.size and raw.max() > 0xFFFF:
        low = np.where(raw > 0xFFFF, raw, low)
    if not raw.size:
        return np.zeros(0, np.uint64)
    inside = low > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, stop = edges[::2], edges[1::2]
    powers, inverse = _LETTERS[0].upto(raw.size + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low.astype(np.uint64) * powers[: raw.size], dtype=np.uint64)])
    return _mixed((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))


def shingles(w: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of ``size`` words, each with the number of its occurrence; a shorter text is one run."""
    if not w.size:
        return np.zeros(0, np.uint64)
    n = max(1, w.size - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(size, w.size)):
        h = h * np.uint64(_B) + w[k : k + n]
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    again = np.concatenate([[False], ordered[1:] == ordered[:-1]])
    if again.any():
        at = np.arange(n)
        label = np.zeros(n, np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(again, 0, at))).astype(np.uint64)
        h = h + label * _MIX[1]
    return _mixed(h)


def sketch(labelled: np.ndarray, sketches: int = SKETCHES, ell: int = ELL) -> list[int]:
    """Order MinHash: for each of ``sketches`` hashes, the ``ell`` least shingles in text order, as one number."""
    if not labelled.size:
        return []
    out, narrow = [], (labelled >> np.uint64(32)).astype(np.uint32)
    few = max(1, (1 << 16) // max(1, labelled.size))  # hashes at once, so that a long text takes little memory
    for a in range(0, sketches, few):
        h = (narrow[None, :] ^ (_SEEDS[a : min(a + few, sketches), None] >> np.uint64(32)).astype(np.uint32)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        h ^= h >> np.uint32(13)
        row = np.arange(h.shape[0])
        places = np.empty((h.shape[0], min(ell, labelled.size)), np.int64)
        for k in range(places.shape[1]):
            places[:, k] = h.argmin(axis=1)
            h[row, places[:, k]] = ~np.uint32(0)
        places.sort(axis=1)
        key = np.zeros(h.shape[0], np.uint64)
        for k in range(places.shape[1]):
            key = key * np.uint64(_B) + labelled[places[:, k]]
        out += _mixed(key + np.arange(a, a + h.shape[0]).astype(np.uint64)).view(np.int64).tolist()
    return out


def _digest(w: np.ndarray, text: str | None) -> str:
    return hashlib.blake2b(w.tobytes() if w.size else b"\0" + (text or "").encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            digests, counts, keys = [], [], []
            for text in part.column("text").to_pylist():
                w = words(text or "")
                # Texts without letters are copies only where they are alike.
                digests.append(_digest(w, text))
                counts.append(int(w.size))
                keys.append(sketch(shingles(w)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("raw"), pa.array(digests), pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "raw", "digest", "n_words", "sketches"])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the rows whose text is the one that was asked for; ``raw`` alone may name another by chance."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            hashed = [words(t or "") for t in part.column("text").to_pylist()]
            right = pa.array([_digest(w, t) == d for w, t, d in zip(hashed, part.column("text").to_pylist(), part.column("digest").to_pylist(), strict=True)], pa.bool_())
            packed = pa.array([(w >> np.uint64(32)).astype(np.uint32).tobytes() for w in hashed], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), packed], names=["doc_id", "words"]).filter(right)


def similar(a: bytes, b: bytes, least: float = SIMILARITY) -> bool:
    """Whether the word edit distance of two texts is at most (1 - ``least``) of the longer one's words."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    k = _budget(max(x.size, y.size), least)
    if abs(x.size - y.size) > k:
        return False
    n = min(x.size, y.size)
    head = int(np.argmin(np.append(x[:n] == y[:n], False)))
    x, y = x[head:], y[head:]
    n = min(x.size, y.size)
    tail = int(np.argmin(np.append(x[::-1][:n] == y[::-1][:n], False)))
    x, y = x[: x.size - tail], y[: y.size - tail]
    n = min(x.size, y.size)
    # Copies whose words were only replaced.
    if max(x.size, y.size) - int((x[:n] == y[:n]).sum()) <= k:
        return True
    # The words that one has and the other lacks have to be edited.
    ux, cx = np.unique(x, return_counts=True)
    uy, cy = np.unique(y, return_counts=True)
    _, ix, iy = np.intersect1d(ux, uy, assume_unique=True, return_indices=True)
    lacking = max(x.size, y.size) - int(np.minimum(cx[ix], cy[iy]).sum())
    if lacking > k:
        return False
    xs, ys, band = x.tolist(), y.tolist(), min(k, max(8, lacking + lacking // 2))
    while True:  # a narrow band first: most copies are near
        if banded_distance(xs, ys, band) is not None:
            return True
        if band == k:
            return False
        band = min(k, 4 * band)


def _budget(n: int, least: float = SIMILARITY) -> int:
    """Edits by which texts, the longer of ``n`` words, may differ."""
    return int((1 - least) * n + 1e-9)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("words_a").to_pylist(), batch.column("words_b").to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array([similar(x, y) for x, y in zip(a, b, strict=True)], pa.bool_())], names=["a", "b", "near"])


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """``pairs`` (a, b) -> a, b, near. A text that is first in many pairs is copied to as many tasks."""
    lots = pairs.groupBy("a").agg(F.ceil(F.count("*") / LOT).cast("int").alias("lots"))
    dealt = pairs.join(lots, "a").withColumn("lot", F.pmod(F.xxhash64("b"), F.col("lots")).cast("int"))
    first = lots.join(tokens.select(F.col("doc_id").alias("a"), F.col("words").alias("words_a")), "a").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")
    second = dealt.join(tokens.select(F.col("doc_id").alias("b"), F.col("words").alias("words_b")), "b")
    return second.join(first, ["a", "lot"]).select("a", "b", "words_a", "words_b").mapInArrow(_verify, "a long, b long, near boolean")


def _first(buckets: DataFrame) -> DataFrame:
    """(key, doc_id) -> key, a, b: the least doc_id of each key of several with each of the others."""
    heads = buckets.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).where("a < last").drop("last")
    # Merged at any size: a hot key's rows are split among tasks, and no side is sent whole.
    return buckets.join(heads.hint("merge"), "key").where("doc_id > a").select("key", "a", F.col("doc_id").alias("b"))


def bag(w: np.ndarray) -> np.ndarray:
    """How often the words of each of BAG classes stand in a text, up to 255."""
    return np.minimum(np.bincount(w.astype(np.int64) % BAG, minlength=BAG), 255).astype(np.uint8)


def coarser(bags: np.ndarray) -> np.ndarray:
    """Bags of an eighth of the classes, which are only nearer."""
    return np.minimum(bags.reshape(len(bags), -1, 8).sum(axis=2, dtype=np.int64), 255).astype(np.uint8)


def within_reach(left: np.ndarray, right: np.ndarray, words_left: np.ndarray, words_right: np.ndarray, asked: np.ndarray | bool = True) -> np.ndarray:
    """For texts by their bags and numbers of words: whether the bags allow that two are similar, where it is ``asked``.

    Of two texts within k edits all words of the longer one but k are matched, so that the bags differ by at most 2 * k less
    the difference of lengths; classes of words, and counts that end at 255, only bring bags nearer.
    """
    longer, shorter = np.maximum(words_left[:, None], words_right[None, :]), np.minimum(words_left[:, None], words_right[None, :])
    edits = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
    most = 2 * edits - (longer - shorter)
    out = (longer - shorter <= edits) & asked
    a, b = left.astype(np.int16), right.astype(np.int16)
    for at in range(0, len(a), ROWS):
        rows, cols = np.flatnonzero(out[at : at + ROWS].any(axis=1)) + at, np.flatnonzero(out[at : at + ROWS].any(axis=0))
        # A few classes of words first: they rule most pairs out.
        for classes in (slice(0, BAG // 8), slice(BAG // 8, BAG)):
            if not (rows.size and cols.size):
                break
            far = np.zeros((rows.size, cols.size), np.int64) if classes.start == 0 else far
            for r in range(rows.size):
                open_ = np.flatnonzero(out[rows[r], cols])
                far[r, open_] += np.abs(b[cols[open_], classes] - a[rows[r], classes]).sum(axis=1, dtype=np.int64)
            out[np.ix_(rows, cols)] &= far <= most[np.ix_(rows, cols)]
    return out


def _holders(keys: np.ndarray, owner: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of ``keys``, each held by the text at ``owner``: by 64 of those that several hold, which texts hold any, and which as bits."""
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    rank = np.empty(times.size, np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(times.size)  # frequent ones together, so that of the rest few texts hold any
    order = np.argsort(rank[which], kind="stable")
    rank, owner, out = rank[which][order], owner[order], []
    for at in range(0, int((times > 1).sum()), 64):
        here = slice(*np.searchsorted(rank, [at, at + 64]))
        texts, place = np.unique(owner[here], return_inverse=True)
        bits = np.zeros(texts.size, np.uint64)
        np.bitwise_or.at(bits, place, np.uint64(1) << (rank[here] - at).astype(np.uint64))
        out.append((texts, bits))
    return out


def _together(holders: list[tuple[np.ndarray, np.ndarray]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether two texts, of ``left`` and ``right`` (ascending places), hold one of the keys of ``holders`` both."""
    out = np.zeros((left.size, right.size), bool)
    for texts, bits in holders:
        _, r, x = np.intersect1d(left, texts, assume_unique=True, return_indices=True)
        _, c, y = np.intersect1d(right, texts, assume_unique=True, return_indices=True)
        out[np.ix_(r, c)] |= (bits[x][:, None] & bits[y][None, :]) != 0
    return out


def _met(texts: pa.StructArray, i: int, j: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of two blocks that are of different components, share no earlier key, where they meet too, and can be
    similar by their bags."""
    block, node, component, n_bytes = (texts.field(c).to_numpy() for c in ("block", "doc_id", "component", "bytes"))
    bags, n = np.frombuffer(b"".join(texts.field("bag").to_pylist()), np.uint8).reshape(-1, BAG), n_bytes.astype(np.int64) // 4
    earlier = texts.field("earlier")
    holders = _holders(earlier.flatten().to_numpy(), np.repeat(np.arange(len(texts)), pc.list_value_length(earlier).to_numpy()))
    x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for start in range(0, x.size, ROWS):
        part = x[start : start + ROWS]
        asked = (component[part][:, None] != component[y][None, :]) & ~_together(holders, part, y)
        if i == j:
            asked &= node[part][:, None] < node[y][None, :]
        r, c = np.nonzero(within_reach(bags[part], bags[y], n[part], n[y], asked))
        yield part[r], y[c]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.StructArray, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            key, i, j = (row.column(c)[0].as_py() for c in ("key", "i", "j"))
            texts = row.column("texts").flatten()
            yield key, texts, _met(texts, i, j)


def _partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of two blocks that meet any other."""
    for key, texts, met in _tiles(batches):
        some = np.zeros(len(texts), bool)
        for a, b in met:
            some[a] = some[b] = True
        found = texts.filter(pa.array(some))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), key, np.int64)), found.field("doc_id"), found.field("bytes")], names=["key", "doc_id", "bytes"])


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of two blocks that meet; of texts with their words the similar ones, as far as they join components."""
    for _, texts, met in _tiles(batches):
        node, component = (texts.field(c).to_numpy() for c in ("doc_id", "component"))
        words_ = texts.field("words").to_pylist() if texts.type.get_field_index("words") >= 0 else None
        joined: dict[int, int] = {}
        for a, b in met:
            if words_ is not None:
                keep = np.array([_join(joined, component[p], component[q], words_[p], words_[q]) for p, q in zip(a, b, strict=True)], bool)
                a, b = a[keep], b[keep]
            less = node[a] < node[b]
            a, b = np.where(less, a, b), np.where(less, b, a)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (node[a], node[b], component[a], component[b])], names=["a", "b", "ca", "cb"])


def _join(joined: dict[int, int], ca: int, cb: int, a: bytes, b: bytes) -> bool:
    """Whether two texts are similar and their components not ``joined`` yet, which they are then."""
    while ca in joined:
        ca = joined[ca]
    while cb in joined:
        cb = joined[cb]
    if ca == cb or not similar(a, b):
        return False
    joined[max(ca, cb)] = min(ca, cb)
    return True


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            bags = np.stack([bag(np.frombuffer(raw, np.uint32)) for raw in part.column("words").to_pylist()])
            for name, column in (("bag", bags), ("coarse", coarser(bags))):
                part = part.append_column(name, pa.array([b.tobytes() for b in column], pa.binary()))
            yield part


def _shared_keys(each: DataFrame) -> DataFrame:
    """Of ``each`` (key, doc_id, component) the keys under which texts of several components meet, with the number of texts. Of
    keys that the very same texts hold one stays."""
    held = F.xxhash64("doc_id")
    sums = each.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most"), F.bit_xor(held).alias("x"), F.bit_xor(F.xxhash64(held, F.lit(1))).alias("y"), F.min("doc_id").alias("first"))
    return sums.where("least < most").groupBy("n", "x", "y", "first").agg(F.min("key").alias("key")).select("key", "n")


def _paired(each: DataFrame, sums: DataFrame) -> DataFrame:
    """(a, b, ca, cb): pairs of texts of different components, with these, that share one of the keys of ``sums``, which have
    few texts."""
    own = each.join(sums.select("key"), "key")
    other = own.select("key", *(F.col(c).alias(f"{c}_b") for c in ("doc_id", "component", "bytes")))
    shorter, longer = F.least("bytes", "bytes_b"), F.greatest("bytes", "bytes_b")
    met = own.join(other, "key").where((F.col("doc_id") < F.col("doc_id_b")) & (F.col("component") != F.col("component_b")) & (shorter >= SIMILARITY * longer - 1e-6))
    return met.select(F.col("doc_id").alias("a"), F.col("doc_id_b").alias("b"), F.col("component").alias("ca"), F.col("component_b").alias("cb"))


def _plausible(pairs: DataFrame, tokens: DataFrame, bags: str) -> DataFrame:
    """Those of ``pairs`` (a, b, ca, cb) that their bags (a column of ``tokens``) allow to be similar: what is sent for a pair is
    far less than words."""
    side = lambda end: tokens.select(F.col("doc_id").alias(end), (F.col("bytes") / 4).cast("int").alias(f"n_{end}"), F.col(bags).alias(f"bag_{end}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ca", "cb", "n_a", "n_b", "bag_a", "bag_b").mapInArrow(_allowed, "a long, b long, ca long, cb long")


def _allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1).astype(np.int16) for c in ("bag_a", "bag_b"))
        m, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
        longer, shorter = np.maximum(m, n), np.minimum(m, n)
        edits = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
        yield batch.select(["a", "b", "ca", "cb"]).filter(pa.array(np.abs(x - y).sum(axis=1, dtype=np.int64) <= 2 * edits - (longer - shorter)))


def _dealt(each: DataFrame, sums: DataFrame, tokens: DataFrame, size: int) -> DataFrame:
    """Texts of a key are dealt in blocks of ``size``, and every block meets every other of its key in a row. What is sent of a
    text is what ``tokens`` have, which a text gets once for all of its keys, and which of these come earlier: those that more
    texts hold. Two texts are compared under the first that both hold."""
    blocks = sums.select("key", F.ceil(F.col("n") / size).cast("int").alias("blocks"), "n")
    held = each.join(blocks, "key").groupBy("doc_id").agg(F.collect_list(F.struct("key", "blocks", "n")).alias("dealt"))  # SKETCHES at most
    own = [F.col(c) for c in ("doc_id", "component", "bytes", "bag", "words") if c in tokens.columns]
    dealt = held.join(tokens.select(*own), "doc_id").select(*own, "dealt", F.inline("dealt"))
    sooner = F.filter("dealt", lambda d: (d["n"] > F.col("n")) | ((d["n"] == F.col("n")) & (d["key"] < F.col("key"))))
    dealt = dealt.withColumn("earlier", F.transform(sooner, lambda d: d["key"])).drop("dealt", "n")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id", "key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    texts = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.struct("block", *own, "earlier").alias("text"))
    return texts.groupBy("key", "i", "j").agg(F.collect_list("text").alias("texts"))


def _open(each: DataFrame, sums: DataFrame, tokens: DataFrame) -> DataFrame:
    """(key, doc_id, bytes): texts that under a key meet one to which they can be similar by their bags."""
    return _dealt(each, sums, tokens.drop("words"), BLOCK).mapInArrow(_partnered, "key long, doc_id long, bytes int").distinct()


def _within(each: DataFrame, sums: DataFrame, tokens: DataFrame) -> DataFrame:
    """The same as ``_paired`` for keys with many texts, of which the bags of words allow that they are similar; if ``tokens``
    have words, those alone that are similar and join components that no other pair of the task does."""
    return _dealt(each, sums, tokens, ALIGNED if "words" in tokens.columns else BLOCK).mapInArrow(_reached, "a long, b long, ca long, cb long")


def links(texts: DataFrame, sketched: DataFrame, docs: DataFrame) -> DataFrame:
    """``texts`` (node, digest, own, raw): one row a different text, ``own`` and ``raw`` the id of one of its rows and the hash of
    that row's text; ``sketched`` (node, sketches), a written table that goes as soon as it is used; ``docs`` (own, raw, text)
    -> (node, component) of all texts with a link.

    A bucket's first text is aligned with the rest, which ends most buckets. Where it isn't similar to all, each text of the
    bucket is compared with each of another component, those that the first has reached among them.
    """
    texts = texts.withColumnRenamed("node", "doc_id")
    pairs = checkpoint(_first(sketched.select(F.col("node").alias("doc_id"), F.explode("sketches").alias("key"))))
    forget(sketched)
    members = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id").select("doc_id", "digest", F.col("own").alias("_own"), F.col("raw").alias("_raw"))
    # Of the rows that hold a text one is enough, so that a hot text is read once.
    one = docs.join(members, (F.col("raw") == F.col("_raw")) & F.col("own").eqNullSafe(F.col("_own"))).select("doc_id", "digest", "text")
    rows = one.mapInArrow(_tokens, "doc_id long, words binary")
    tokens = checkpoint(rows.dropDuplicates(["doc_id"]).withColumn("bytes", F.length("words")))
    longer, shorter = F.greatest("n_a", "n_b"), F.least("n_a", "n_b")
    sizes = lambda end: tokens.select(F.col("doc_id").alias(end), F.col("bytes").alias(f"n_{end}"))
    met = pairs.select("a", "b").distinct().join(sizes("a"), "a").join(sizes("b"), "b").where(shorter >= SIMILARITY * longer - 1e-6).select("a", "b")
    judged = checkpoint(_verified(met, tokens).where("near").select("a", "b"))
    first = components(judged)
    unlike = checkpoint(pairs.join(judged, ["a", "b"], "left_anti").select("key").distinct())
    # A bucket's first text stands in all of its pairs, each other in one.
    within = checkpoint(pairs.join(unlike, "key", "left_semi"))
    doubtful = within.select("key", F.col("b").alias("doc_id")).unionByName(within.select("key", F.col("a").alias("doc_id")).distinct())
    forget(pairs)
    # A text meets its component and words once, with all of its keys, SKETCHES at most.
    keyed = doubtful.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    named = tokens.join(keyed, "doc_id").join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    held = checkpoint(named.select("doc_id", "component", "bytes", "words", "keys").mapInArrow(_bagged, "doc_id long, component long, bytes int, words binary, keys array<long>, bag binary, coarse binary"))
    forget(tokens, within)
    each = checkpoint(held.select(F.explode("keys").alias("key"), "doc_id", "component", "bytes"))
    sums = checkpoint(_shared_keys(each))
    # All texts of each bucket are compared: as pairs where they are few, to which words are sent once a pair, else in blocks, to
    # which they are sent of texts that bags leave with a partner.
    few = _paired(each, sums.where(F.col("n") <= FEW)).distinct()
    for bags in ("coarse", "bag"):
        few = _plausible(few, held, bags)
    met = checkpoint(few.distinct())
    left = checkpoint(_open(each, sums.where(F.col("n") > FEW), held))
    weighed = left.groupBy("key").agg(F.greatest(F.count("*"), F.ceil(F.sum("bytes") / ALIGNED_BYTES)).alias("n"))
    near = met.join(_verified(met.select("a", "b"), held).where("near").select("a", "b"), ["a", "b"]).unionByName(_within(left, weighed, held))
    further = checkpoint(near.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    second = components(further)
    # Components that further links join go under the least of them.
    moved = first.withColumnRenamed("component", "goal").join(second.select(F.col("node").alias("goal"), "component"), "goal", "left").select("node", F.coalesce("component", "goal").alias("component"))
    alone = second.join(first.select("node"), "node", "left_anti")
    out = checkpoint(moved.unionByName(alone))
    forget(judged, unlike, held, each, sums, met, left, further, first, second)
    return out


def _raw(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _classified(docs: DataFrame) -> DataFrame:
    """doc_id, raw, digest, n_words, node (the row's text), rep_id, component and class_id of each row of ``docs``."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("raw", _raw(F.col("text")))
    sketched = checkpoint(base.mapInArrow(_sketches, "doc_id long, raw long, digest string, n_words long, sketches array<long>"))
    exact = sketched.groupBy("digest").agg(F.min("doc_id").alias("rep_id"), F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "raw")).alias("row"), F.first("sketches").alias("sketches"))
    whole = checkpoint(exact.select("digest", "rep_id", F.col("row.doc_id").alias("own"), F.col("row.raw").alias("raw"), "sketches").withColumn("node", F.monotonically_increasing_id()))
    rows = checkpoint(sketched.drop("sketches"))
    forget(sketched)
    exact = checkpoint(whole.drop("sketches"))
    found = links(exact.drop("rep_id"), whole, base.select(F.col("doc_id").alias("own"), "raw", "text"))
    named = exact.select("digest", "rep_id", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep_id").alias("least"))
    # Of classes with one least id, which unlike texts of that id make, the first keeps it; the rest, and those without, count down.
    place = F.row_number().over(Window.partitionBy("least").orderBy("component"))
    ids = least.where("least is not null").withColumn("place", place).select("component", F.when(F.col("place") == 1, F.col("least")).otherwise(-1 - F.col("component")).alias("class_id"))
    ids = ids.unionByName(least.where("least is null").select("component", (-1 - F.col("component")).alias("class_id")))
    named = named.join(ids, "component").select("digest", "rep_id", "node", "component", "class_id")
    out = checkpoint(rows.join(named, "digest"))
    forget(rows, exact, found)
    return out


def classes(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, class_id, n_words, rep_id, a row for each row of ``docs``.

    class_id is the least doc_id of all texts joined by links; rep_id the least of the exact copies (same words, whatever the
    letter case and punctuation). Two texts are linked when aligned words agree to ``SIMILARITY`` or more of the longer text.
    Null text counts as empty; empty texts are copies of one another, as are texts of marks only where they are alike. Texts
    under five words are one shingle: copies or apart. Repeated rows stay, in one class. Rows are told apart by their texts:
    unlike texts with one doc_id are classes of their own, of which one keeps the id, and the others have negative numbers, as
    have classes without any doc_id; such numbers may differ between runs. Whole texts are used; extra columns are ignored. An
    empty table gives no rows.
    """
    return _classified(docs).select("doc_id", "class_id", "n_words", "rep_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: of those with the least doc_id (null last), and among them the least text by its
    hash, one. Unlike texts of one doc_id both stay. Columns of any name are kept as they are; ties between rows that agree in
    doc_id and text are settled by all columns."""
    of = _classified(docs)
    key = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "raw")
    chosen = of.groupBy("component").agg(F.min(key).alias("k")).select(F.col("k.doc_id").alias(_OWN[0]), F.col("k.raw").alias(_OWN[1])).distinct()
    own = docs.withColumns({_OWN[0]: F.col("doc_id").cast("long"), _OWN[1]: _raw(F.col("text").cast("string"))})
    same = own[_OWN[0]].eqNullSafe(chosen[_OWN[0]]) & (own[_OWN[1]] == chosen[_OWN[1]])
    kept = own.join(chosen, same, "left_semi")
    out = checkpoint(kept.dropDuplicates(_OWN).drop(*_OWN))
    forget(of)
    return out


#: Names of two columns that live within deduplicated() alone.
_OWN = ["_near_dedup_own_id_", "_near_dedup_own_text_"]
