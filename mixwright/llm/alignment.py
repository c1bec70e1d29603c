"""Alignment of two tokenizers over the same text.

Where a token of either side ends at the same byte the text is cut; tokens between two cuts form a group, and all pairs of a
group are linked. ``align`` counts in how many documents of the corpus each pair of ids is linked, and gives every document its
groups and what its links count for.

``cut_groups`` says this relationally, a row a token: positions by posexplode, ends by windowed sums of lengths, cuts by an
equi-join on document and end, groups by a running count of cuts, links by a join on document and group. A corpus has a token
for about every two and a half bytes on both sides; as rows they cost several times the tokenizers (see the README for figures),
so ``align`` takes the same steps on arrays inside the task that tokenizes: cumulative sums, a join of ends through a table of
bytes, running counts. What spans documents stays relational: counts of pairs, the best of an id, and their return to the
documents of a block, a row a document.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixwright.llm.common import checkpoint, forget

FOLDER = "/opt/tokenizers"
BYTE_BPE, BYTE_RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
# Fixed value: how the published byte-level vocabulary splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text of a block: what a task holds as arrays. A longer text is a block of its own.
BLOCK = 3_000_000
#: Pairs of one group from which they are counted by distinct ids.
WIDE = 1 << 16
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_BLOCK = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, sha string, pairs array<int>, times array<long>, "
    "ids array<long>, docs array<long>"
)
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest in
    order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, loaded once a worker."""

    loaded: dict[str, Pair] = {}

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        self.folder, self.slow = folder, None
        with open(f"{folder}/{BYTE_RANKS}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        with open(f"{folder}/{BYTE_BPE}", encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        alphabet = byte_alphabet()
        self.a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
        n = self.pieces.get_piece_size()
        self.b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.pieces.id_to_piece(i)) for i in range(n))]
        self.len_a, self.len_b = (np.array([len(x) for x in v], np.int64) for v in (self.a, self.b))
        # A token's number with what stands before it: nothing, ";" or "," on the first side, "|" or "," on the second.
        self.words = np.array([s + str(i) for s in ("", ";", ",") for i in range(len(self.a))] + [s + str(i) for s in ("|", ",") for i in range(n)], dtype=object)

    @classmethod
    def of(cls, folder: str) -> Pair:
        if folder not in cls.loaded:
            cls.loaded[folder] = cls(folder)
        return cls.loaded[folder]

    def encode_a(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), np.int64)
        except BaseException as e:  # the fast library gives up on some very long runs, with an exception of its own kind
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            from tokenizers import Tokenizer

            if self.slow is None:
                self.slow = Tokenizer.from_file(f"{self.folder}/{BYTE_BPE}")
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[list[int]]]:
        """Ids of both sides; none where a text is null or empty, or either side doesn't spell space + text."""
        none = np.zeros(0, np.int64)
        second = self.pieces.encode([t or "" for t in texts], num_threads=1)
        a_ids, b_ids = [], []
        for text, b in zip(texts, second, strict=True):
            a = none
            if text:
                raw = (" " + text).encode("utf-8", "surrogatepass")
                if b"".join(map(self.b.__getitem__, b)) == raw:
                    a = self.encode_a(" " + text)
                    if self.len_a[a].sum() != len(raw):  # bytes are only ever split
                        a = none
            a_ids.append(a)
            b_ids.append(b if len(a) else [])
        return a_ids, b_ids

    def block(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """All that is said of the documents of a block, a value a document, and their distinct pairs of ids."""
        a_ids, b_ids = self.tokens(texts)
        n_a, n_b = np.array([len(x) for x in a_ids], np.int64), np.array([len(x) for x in b_ids], np.int64)
        a = np.concatenate(a_ids) if len(a_ids) else np.zeros(0, np.int64)
        b = np.fromiter(chain.from_iterable(b_ids), np.int64, int(n_b.sum()))
        # Ends over the whole block: both sides spell the same bytes, so that every document's end is a cut.
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        seen = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, np.uint8)
        seen[end_a] = 1
        cut_b = seen[end_b] == 1
        seen[end_b] += 2
        cut_a = seen[end_a] == 3
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n = int(cut_a.sum())
        size_a, size_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        doc_of = np.repeat(np.arange(len(texts)), n_a)[start_a] if n else np.zeros(0, np.int64)
        n_groups = np.bincount(doc_of, minlength=len(texts))
        n_links = np.bincount(doc_of, weights=(size_a * size_b).astype(float), minlength=len(texts)).astype(np.int64)
        # Words in the order of groups, first side first.
        fresh_a, fresh_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        fresh_a[start_a], fresh_b[start_b] = True, True
        opening = np.zeros(len(a), bool)
        opening[(np.cumsum(n_a) - n_a)[n_a > 0]] = True
        word = np.zeros(len(a) + len(b), np.int64)
        va, vb = len(self.a), len(self.b)
        word[np.arange(len(a)) + start_b[group_a]] = a + va * np.where(opening, 0, np.where(fresh_a, 1, 2))
        word[np.arange(len(b)) + (start_a + size_a)[group_b]] = b + 3 * va + vb * np.where(fresh_b, 0, 1)
        stops = np.cumsum(n_a + n_b)
        shas = [hashlib.sha256("".join(self.words[word[e - k : e]].tolist()).encode()).hexdigest() if k else "" for e, k in zip(stops.tolist(), (n_a + n_b).tolist(), strict=True)]
        # Links: each first token with all second tokens of its group. Very wide groups are counted by their distinct ids.
        wide = size_a * size_b > WIDE
        times = np.where(wide, 0, size_b)[group_a]
        inside = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        codes = np.repeat(a, times) * vb + b[np.repeat(start_b[group_a], times) + inside]
        keys, weights = [np.repeat(doc_of[group_a], times) * (va * vb) + codes], [np.ones(len(codes), np.int64)]
        for g in np.flatnonzero(wide).tolist():
            ua, ka = np.unique(a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
            ub, kb = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
            keys.append((doc_of[g] * (va * vb) + ua[:, None] * vb + ub).ravel())
            weights.append((ka[:, None] * kb).ravel())
        if len(keys) == 1:
            keys[0].sort()
            firsts = np.flatnonzero(np.diff(keys[0], prepend=-1))
            distinct, links = keys[0][firsts], np.diff(np.append(firsts, len(keys[0])))
        else:
            distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
            links = np.bincount(back, weights=np.concatenate(weights).astype(float)).astype(np.int64)
        ids, at, docs = np.unique(distinct % (va * vb), return_inverse=True, return_counts=True)
        ends = np.searchsorted(distinct, (np.arange(len(texts)) + 1) * (va * vb))
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "sha": shas, "ends": ends, "pairs": at.astype(np.int32), "times": links, "ids": ids, "docs": docs}


def _batch(schema: str, columns: dict) -> pa.RecordBatch:
    fields = []
    for part in schema.split(", "):
        name, kind = part.split()
        inner = _KINDS[kind.removeprefix("array<").removesuffix(">")]
        fields.append((name, pa.list_(inner) if kind.startswith("array") else inner))
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in fields], schema=pa.schema(fields))


def align(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text; other
    columns are ignored, whatever their names).

    n_best counts links whose pair is in as many documents as any pair of its first id; count_sum adds up the documents of each
    link's pair. Rows that share a doc_id, or have none, are documents of their own; repeated texts count as often as they are
    there. Texts that are null or empty, or that either tokenizer doesn't spell byte for byte, have no tokens: zeros and an
    empty digest. An empty table gives no rows.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, number = Pair.of(folder), TaskContext.get().partitionId() << 33
        ids: list = []
        texts: list = []
        held = 0

        def made() -> pa.RecordBatch:
            found = pair.block(texts)
            bounds = np.concatenate([[0], found.pop("ends")]).astype(np.int32)
            lists = {c: pa.ListArray.from_arrays(bounds, pa.array(found[c], t)) for c, t in (("pairs", pa.int32()), ("times", pa.int64()))}
            # The block's ids go with its first document.
            lists |= {c: [found[c], *[None] * (len(ids) - 1)] for c in ("ids", "docs")}
            return _batch(_BLOCK, found | lists | {"block": [number] * len(ids), "doc_id": ids})

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if texts and held + len(text or "") > BLOCK:
                    yield made()
                    ids, texts, held, number = [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(text)
                held += len(text or "") + 50
        if texts:
            yield made()

    def sums(own: pa.Table, counted: pa.Table) -> pa.Table:
        """The documents of a block, with the counts of its pairs."""
        at = counted.column("at").to_numpy()
        n_docs, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n_docs[at], best[at] = counted.column("n_docs").to_numpy(), counted.column("best").to_numpy()
        lists = own.column("pairs").combine_chunks()
        pairs, times = lists.flatten().to_numpy(), own.column("times").combine_chunks().flatten().to_numpy()
        ends = np.cumsum(lists.value_lengths().to_numpy())
        running = lambda v: pa.array(np.diff(np.concatenate([[0], np.cumsum(v)])[ends], prepend=0), pa.int64())
        out = {c: own.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(out | {"n_best": running(times * best[pairs]), "count_sum": running(times * n_docs[pairs]), "groups_sha256": own.column("sha")})

    second = _second_size(folder)
    made = checkpoint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(blocks, _BLOCK))
    here = made.where("ids is not null").select("block", F.posexplode(F.arrays_zip("ids", "docs")).alias("at", "one")).select("block", "at", F.col("one.ids").alias("pair"), F.col("one.docs").alias("docs"))
    counts = here.groupBy("pair").agg(F.sum("docs").alias("n_docs"))
    # A first id has no more pairs than the second vocabulary has entries.
    most = F.max("n_docs").over(Window.partitionBy(F.expr(f"pair div {second}")))
    counts = checkpoint(counts.select("pair", "n_docs", (F.col("n_docs") == most).cast("long").alias("best")))
    back = here.select("block", "at", "pair").join(counts, "pair").select(F.col("block").alias("of"), "at", "n_docs", "best")
    # Documents are rows of their own: as one row a block, all blocks of a task were held at once by the writer and the reader.
    out = checkpoint(made.drop("ids", "docs").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(sums, OUT))
    forget(made, counts)
    return out


def _second_size(folder: str) -> int:
    return len(Pair.of(folder).b)


def cut_groups(tokens: DataFrame) -> DataFrame:
    """``tokens`` (doc, a array<struct<id, length>>, b the same) -> doc, a, b: the links of each document by the relational steps,
    a row a link, with its group."""

    def ends(side: str) -> DataFrame:
        rows = tokens.select("doc", F.posexplode(side).alias("pos", "token"))
        so_far = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        return rows.select("doc", "pos", F.col("token.id").alias("id"), F.sum("token.length").over(so_far).alias("end"))

    first, second = ends("a"), ends("b")
    cuts = first.select("doc", "end").join(second.select("doc", "end"), ["doc", "end"]).withColumn("cut", F.lit(1))

    def grouped(side: DataFrame) -> DataFrame:
        before = Window.partitionBy("doc").orderBy("end").rowsBetween(Window.unboundedPreceding, -1)
        return side.join(cuts, ["doc", "end"], "left").select("doc", "pos", "id", F.coalesce(F.sum("cut").over(before), F.lit(0)).alias("group"))

    a, b = grouped(first), grouped(second)
    return a.select("doc", "group", F.col("pos").alias("pos_a"), F.col("id").alias("a")).join(b.select("doc", "group", F.col("pos").alias("pos_b"), F.col("id").alias("b")), ["doc", "group"])
