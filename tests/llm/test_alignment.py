"""Alignment of two tokenizers against a plain version, and its relational steps."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from mixwright.llm import alignment
from tests.llm.helpers import ODD_TEXTS, docs

FOLDER = alignment.FOLDER


class Plain:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(f"{FOLDER}/{alignment.BYTE_BPE}")
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{alignment.PIECES}")
        with open(f"{FOLDER}/{alignment.BYTE_BPE}", encoding="utf-8") as f:
            self.entries = {i: e for e, i in json.load(f)["model"]["vocab"].items()}

    def a(self, i):
        return bytes(alignment.byte_alphabet()[c] for c in self.entries[i])

    def b(self, i):
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.first.encode(" " + text, add_special_tokens=False).ids, self.second.encode(text)
        spelled = (" " + text).encode()
        return (a, b) if b"".join(map(self.a, a)) == b"".join(map(self.b, b)) == spelled else ([], [])

    def groups(self, text):
        a, b = self.tokens(text)
        end_a, end_b = np.cumsum([len(self.a(i)) for i in a]).tolist(), np.cumsum([len(self.b(i)) for i in b]).tolist()
        out = [([], []) for _ in sorted({*end_a} & {*end_b})]
        for side, (ids, ends) in enumerate(((a, end_a), (b, end_b))):
            for i, e in zip(ids, ends, strict=True):
                out[sum(c < e for c in {*end_a} & {*end_b}) if len(a) < 300 else np.searchsorted(sorted({*end_a} & {*end_b}), e)][side].append(i)
        return out


def expected(rows):
    plain, count, best = Plain(), Counter(), defaultdict(int)
    each = [(doc, plain.groups(text)) for doc, text in rows]
    links = [[(p, q) for a, b in groups for p in a for q in b] for _, groups in each]
    for found in links:
        count.update(set(found))
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    text = lambda groups: ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return [
        (doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(found), sum(count[x] == best[x[0]] for x in found), sum(count[x] for x in found), hashlib.sha256(text(groups).encode()).hexdigest() if groups else "")
        for (doc, groups), found in zip(each, links, strict=True)
    ]


def key(row):
    return tuple((v is not None, v) for v in row)


def texts():
    rng = random.Random(4)
    words = ["naïve", "Straße", "données", "日本語テキスト", "emoji 😀👍🏽", "don't", "C++20", "a1b2", "  two", "\n\n", "\t", "über-lang", "<s>", "</s>", "<|endoftext|>", "<0x41>", "Ünïcödé", "ﬁne", "א ב", "1234567890", "é"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]


def test_against_plain(spark):
    rows = [*enumerate(ODD_TEXTS), *((100 + i, t) for i, t in enumerate(texts())), (100, "another text under the same id"), (None, "no id"), (200, "with ▁ inside"), (201, "repeated row"), (201, "repeated row")]
    found = alignment.align(docs(spark, rows).repartition(3))
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected(rows), key=key)
    assert found.columns == [p.split()[0] for p in alignment.OUT.split(", ")]


def test_empty_table(spark):
    assert alignment.align(docs(spark, [(1, "a")]).where("false")).collect() == []


def test_blocks_do_not_matter(spark):
    rows = docs(spark, list(enumerate(texts()))).coalesce(1)
    whole = {tuple(r) for r in alignment.align(rows).collect()}
    plain = alignment.Pair.of(FOLDER)
    parts = [plain.block([t])["n_links"][0] for t in texts()]
    assert sum(r[4] for r in whole) == sum(parts)


def test_wide_groups_are_counted_alike(monkeypatch):
    plain = alignment.Pair.of(FOLDER)
    some = [*texts(), *(t for t in ODD_TEXTS)]
    before = plain.block(some)
    monkeypatch.setattr(alignment, "WIDE", 1)
    after = plain.block(some)
    assert all(np.array_equal(before[k], after[k]) for k in before)


def test_fast_encoder_agrees():
    plain, pair = Plain(), alignment.Pair.of(FOLDER)
    rng = random.Random(9)
    random_text = ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0xA0, 0x2FFF), rng.randint(0x1F300, 0x1FAFF), 10, 32, 32])) for _ in range(rng.randint(1, 300))) for _ in range(300)]
    for text in [*random_text, *texts(), "x" * 100_000, " " * 50_000, "\n" * 50_000, "1" * 50_000]:
        assert pair.encode_a(" " + text).tolist() == plain.first.encode(" " + text, add_special_tokens=False).ids


def test_relational_steps(spark):
    pair, some = alignment.Pair.of(FOLDER), texts()
    a, b = pair.tokens(some)
    side = lambda ids, lengths: [(int(i), int(lengths[i])) for i in ids]
    rows = [(d, side(a[d], pair.len_a), side(b[d], pair.len_b)) for d in range(len(some))]
    tokens = spark.createDataFrame(rows, "doc int, a array<struct<id: int, length: int>>, b array<struct<id: int, length: int>>")
    found = {(r.doc, r.links, r.pairs) for r in alignment.cut_groups(tokens).groupBy("doc").agg(F.count("*").alias("links"), F.count_distinct("a", "b").alias("pairs")).collect()}
    block = pair.block(some)
    sizes = np.diff(block["ends"], prepend=0)
    assert found == {(d, int(block["n_links"][d]), int(sizes[d])) for d in range(len(some)) if block["n_a"][d]}


def test_no_row_holds_a_block(spark, monkeypatch):
    """What is written between the steps has a row a document, so that neither writer nor reader holds many blocks at once."""
    seen = []
    monkeypatch.setattr(alignment, "checkpoint", lambda df, real=alignment.checkpoint: seen.append(real(df)) or seen[-1])
    monkeypatch.setattr(alignment, "forget", lambda *tables: None)
    rows = list(enumerate(texts()))
    alignment.align(docs(spark, rows).coalesce(1))
    plain = alignment.Pair.of(FOLDER)
    held = {r.doc_id: r.n for r in seen[0].select("doc_id", F.size("pairs").alias("n")).collect()}
    assert held == {i: len(plain.block([t])["pairs"]) for i, t in rows} and seen[0].where("ids is not null").count() == 1
