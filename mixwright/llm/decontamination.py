"""Benchmark decontamination by q-gram filtering over diagonal bands.

Every text is searched for approximate copies of benchmark items. Shared character q-grams are counted by item and diagonal
band (bands overlap, so that a copy lies whole in one); a band whose count meets the bound of the q-gram lemma for the item's
edit budget is verified by alignment. The items are a query set taken in blocks of bounded size, one at a time; texts pass
through Arrow batches and are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixwright.llm.align import best_occurrence, masks
from mixwright.llm.common import checkpoint, forget

Q, EDIT_SHARE = 8, 0.08
#: Characters of items in a block: what the driver and a worker hold of the benchmark at once.
BLOCK_CHARS = 4_000_000
TABLE_BITS = 21
COMMON = 0.7
_B = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.uint64(pow(int(_B), e, 1 << 64)) for e in range(64)]
HIT = "doc_id long, item_id long, start int, stop int, distance int, item_chars int"


def _lower_table() -> np.ndarray:
    out = np.arange(0x10000, dtype=np.uint32)
    for i in range(0x10000):
        if not 0xD800 <= i <= 0xDFFF:
            low = chr(i).lower()
            if len(low) == 1:
                out[i] = ord(low)
    out[[9, 10, 11, 12, 13]] = 32
    return out


_LOWER: list[np.ndarray] = []


def codes(text: str) -> np.ndarray:
    """Code points in lower case, white space as blanks: one for each character of the text."""
    if not _LOWER:
        _LOWER.append(_lower_table())
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = _LOWER[0][np.minimum(raw, 0xFFFF)]
    return np.where(raw < 0x10000, low, raw) if raw.size and raw.max() >= 0x10000 else low


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q-gram, by doubling."""
    if c.size < q:
        return np.zeros(0, np.uint64)
    h, length = c.astype(np.uint64), 1
    out, have = None, 0
    need = q
    while need:
        if need & 1:
            out = h if out is None else out[: c.size - have - length + 1] * _POWERS[length] + h[have : have + c.size - have - length + 1]
            have += length
        need >>= 1
        if need:
            h = h[:-length] * _POWERS[length] + h[length:]
            length *= 2
    return (out ^ (out >> np.uint64(29))) * _B


class Index:
    """The q-grams of a block of items: sorted hashes with their items and places, and a bit table before them."""

    def __init__(self, items: list[tuple[int, str]], q: int, edit_share: float):
        self.q = q
        self.items = [(i, codes(t)) for i, t in items if t and t.strip()]
        self.short = [(k, c.tobytes()) for k, (_, c) in enumerate(self.items) if c.size < q]
        self.budget = np.array([max(0, min(int(edit_share * c.size), (c.size - q) // q)) for _, c in self.items], np.int64)
        self.size = np.array([c.size for _, c in self.items], np.int64)
        self.least = np.maximum(self.size - q + 1 - self.budget * q, 1)
        self.half = 2 * self.budget + 1
        parts = [grams(c, q) for _, c in self.items]
        hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(parts)), [p.size for p in parts]) if parts else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(p.size) for p in parts]) if parts else np.zeros(0, np.int64)
        # The grams that most items share say least: an item goes without up to COMMON of the count it needs, and needs that less.
        _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
        kept = np.ones(hashes.size, bool)
        for k in range(len(parts)):
            mine = np.arange(*np.searchsorted(owner, [k, k + 1]))
            often = mine[np.argsort(-times[back[mine]], kind="stable")][: int(COMMON * self.least[k])]
            kept[often[times[back[often]] > 1]] = False
            self.least[k] -= mine.size - int(kept[mine].sum())
        hashes, owner, place = hashes[kept], owner[kept], place[kept]
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = owner[order].astype(np.int64), place[order].astype(np.int64)
        self.keys, self.first, self.times = np.unique(hashes[order], return_index=True, return_counts=True)
        self.bits = np.zeros(1 << TABLE_BITS, bool)
        self.bits[self.keys >> np.uint64(64 - TABLE_BITS)] = True
        self.masks: dict[int, dict] = {}

    def bands(self, c: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first and last diagonal) of the bands that share enough q-grams with an item."""
        h = grams(c, self.q)
        at = np.flatnonzero(self.bits[h >> np.uint64(64 - TABLE_BITS)])
        if not at.size or not self.keys.size:
            return
        slot = np.minimum(np.searchsorted(self.keys, h[at]), self.keys.size - 1)
        same = self.keys[slot] == h[at]
        at, slot = at[same], slot[same]
        if not at.size:
            return
        # Slices bound what a text of many hits takes.
        total = np.cumsum(self.times[slot])
        keys, counts, cut = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while cut < at.size:
            done = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + 2_000_000, "right")))
            times = self.times[slot[cut:done]]
            pos = np.repeat(at[cut:done], times)
            entry = np.repeat(self.first[slot[cut:done]] - np.cumsum(times) + times, times) + np.arange(pos.size)
            item = self.owner[entry]
            block = (pos - self.place[entry] + self.size[item]) // self.half[item]
            found, n = np.unique(item << 36 | block, return_counts=True)
            if keys.size:
                found, back = np.unique(np.concatenate([keys, found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([counts, n])).astype(np.int64)
            keys, counts, cut = found, n, done
        # A band is two neighbouring blocks of half its width, so bands overlap by half.
        after = np.zeros_like(counts)
        after[:-1] = np.where(keys[1:] == keys[:-1] + 1, counts[1:], 0)
        items = keys >> 36
        for k in np.flatnonzero(counts + after >= self.least[items]).tolist():
            item, block = int(items[k]), int(keys[k]) & ((1 << 36) - 1)
            low = block * int(self.half[item]) - int(self.size[item])
            yield item, low, low + 2 * int(self.half[item]) - 1

    def search(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item_id, start, stop, distance, item_chars) of the copies in a text; of those of an item that overlap the nearest."""
        c = codes(text)
        found: list[tuple[int, int, int, int]] = []
        for item, low, high in self.bands(c):
            size, k = int(self.size[item]), int(self.budget[item])
            start, stop = max(0, low - k), min(c.size, high + size + k)
            if item not in self.masks:
                p = self.items[item][1].tolist()
                self.masks[item] = masks(p), masks(p[::-1])
            part = c[start:stop].tolist()
            distance, end = best_occurrence(self.masks[item][0], size, part)
            if distance <= k:
                back = part[:end][::-1][: size + k]
                _, length = best_occurrence_from_end(self.masks[item][1], size, back)
                found.append((distance, start + end - length, start + end, item))
        if self.short:
            for item, raw in self.short:
                wide, at = c.tobytes(), 0
                while (at := wide.find(raw, at)) >= 0:
                    if at % 4 == 0:
                        found.append((0, at // 4, at // 4 + len(raw) // 4, item))
                    at += len(raw) if at % 4 == 0 else 1
        out: list[tuple[int, int, int, int]] = []
        for hit in sorted(found):
            if not any(o[3] == hit[3] and o[1] < hit[2] and hit[1] < o[2] for o in out):
                out.append(hit)
        return sorted((self.items[i][0], a, b, d, int(self.size[i])) for d, a, b, i in out)


def best_occurrence_from_end(where: dict, n: int, text: list) -> tuple[int, int]:
    """The least distance of a pattern to a prefix of ``text`` and that prefix's length: the first row grows with each column."""
    full, last = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = full, 0, n
    best, end = n, 0
    for j, c in enumerate(text, 1):
        match = where.get(c, 0)
        free = ((((match & up) + up) ^ up) | match | down) & full
        right_up, right_down = (down | ~(free | up)) & full, free & up
        distance += bool(right_up & last) - bool(right_down & last)
        if distance < best:
            best, end = distance, j
        right_up, right_down = right_up << 1 | 1, right_down << 1
        up = (right_down | ~(free | right_up)) & full
        down = right_up & free & full
    return best, end


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``block_chars`` characters (a longer item alone), each read when its turn comes."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null and length(trim(text)) > 0").dropDuplicates()
    whole = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 16 * -(-whole // block_chars)
    if not parts:
        return
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    sizes = items.groupBy(part.alias("part")).agg(F.sum(F.length("text")).alias("chars")).orderBy("part").collect()  # 16 rows a block
    packed: list[list[int]] = []
    room = 0
    for row in sizes:
        if not packed or row.chars > room:
            packed.append([])
            room = block_chars
        packed[-1].append(row.part)
        room -= row.chars
    for chosen in packed:
        yield sorted((r.item_id, r.text) for r in items.where(part.isin(chosen)).toLocalIterator())


def indexes(items: list[tuple[int, str]], q: int, edit_share: float) -> list[Index]:
    """The items by q-grams; those too short for the lemma to leave a common one within their budget by shorter grams."""
    few = lambda t: len(t) >= q and int(edit_share * len(t)) > (len(t) - q) // q
    parts = [([i for i in items if not few(i[1])], q), ([i for i in items if few(i[1])], max(1, q // 2))]
    return [Index(part, size, edit_share) for part, size in parts if part]


def _search(found: list[Index], text: str) -> list[tuple[int, int, int, int, int]]:
    return sorted(hit for index in found for hit in index.search(text))


def search(docs: DataFrame, benchmark: DataFrame, q: int = Q, edit_share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` (doc_id, text) and ``benchmark`` (item_id, text) -> doc_id, item_id, start, stop, distance, item_chars: a row
    for each copy of an item in a text within ``edit_share`` of the item's characters, letter case and kinds of white space
    apart. Texts without a copy have no row.

    Null, empty and blank items and texts match nothing; an item under ``q`` characters has to stand there exactly. Repeated
    documents give their rows each, repeated items once. Whole texts are searched; extra columns are ignored. Every block of
    items takes one pass over the texts; with several, the hits of each are written before the next is read.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for items, last in _with_last(blocks(benchmark, block_chars)):
        hits = texts.mapInArrow(_searcher(items, q, edit_share), HIT)
        hits = hits if last and out is None else checkpoint(hits)
        out = hits if out is None else out.unionByName(hits)
    return texts.sparkSession.createDataFrame([], HIT) if out is None else out


def _with_last(found: Iterator) -> Iterator[tuple[list, bool]]:
    """Each element and whether it is the last; no more than two are held."""
    held = next(found, None)
    while held is not None:
        following = next(found, None)
        yield held, following is None
        held = following


def _per_worker(items: list[tuple[int, str]], q: int, edit_share: float, run: Callable) -> Callable:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = indexes(items, q, edit_share)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                yield run(found, batch.slice(i, 256))

    return each


def _searcher(items: list[tuple[int, str]], q: int, edit_share: float) -> Callable:
    names = ["doc_id", "item_id", "start", "stop", "distance", "item_chars"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]

    def run(found: list[Index], part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(doc, *hit) for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True) if text for hit in _search(found, text)]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return _per_worker(items, q, edit_share, run)


def clean(docs: DataFrame, benchmark: DataFrame, q: int = Q, edit_share: float = EDIT_SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the documents that hold a copy of an item. The texts are searched in place and not shuffled; columns,
    nulls and repeated rows stay. With several blocks of items, what each leaves is written before the next is read."""
    kept, written = docs, None
    for items, last in _with_last(blocks(benchmark, block_chars)):
        kept = kept.mapInArrow(_marker(items, q, edit_share), kept.schema)
        if not last:
            before, written = written, checkpoint(kept)
            kept = written
            if before is not None:
                forget(before)
    return kept


def _marker(items: list[tuple[int, str]], q: int, edit_share: float) -> Callable:
    def run(found: list[Index], part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array([not (t and any(index.search(t) for index in found)) for t in part.column("text").to_pylist()], pa.bool_()))

    return _per_worker(items, q, edit_share, run)
