"""Personal data, benchmark copies, near-duplicates: against plain or exhaustive versions."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from mixwright.llm import decontamination, near_dedup, pii, queries
from mixwright.llm.common import table
from mixwright.llm.align import best_occurrence, masks
from tests.llm.helpers import ODD_TEXTS, docs
from tests.llm.test_align import table as edit_table


def plain_pii(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    ok = lambda d: sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([ -]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and ok(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return out


HARD = [
    "a@b.c@d.e x@y z@@q.r.s .@-.- é.a%b+c@d-e.f- @a.b a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3", "4785380592391139 4785 3805 9239 1139-1 4785-3805-9239-1139", "+1 (988) 555-2485 4524132264652876 +12 3 +1-2-3-4-5-6-7-8 ++49 30 123456",
    "😀 u.v@w.xyz 9.9.9.9", "call 555-123-4567 or iban DE89 3704 0044 0532 0130 00, ssn 123-45-6789",
]


def test_pii_base_spans_match_plain_regex(spark, sf_dir, tmp_path):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()] + [(10_000 + i, t) for i, t in enumerate(HARD + ODD_TEXTS)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op2_pii(spark, str(tmp_path)).collect()}
    for i, text in rows:
        want = plain_pii(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest(), (i, want, got[i])
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(k == x for k, *_ in want) for x in pii.KINDS)


def test_pii_method_adds_checked_spans():
    kinds = lambda t: {(k, t[a:b]) for k, a, b, _ in pii.spans(t)[1]}
    assert ("iban", "DE89 3704 0044 0532 0130 00") in kinds(HARD[5]) and ("phone_near", "555-123-4567") in kinds(HARD[5]) and ("ssn", "123-45-6789") in kinds(HARD[5])
    assert kinds("iban DE88 3704 0044 0532 0130 00") == set() and kinds("lot 555-123-4567") == set()
    assert {("card", "4524132264652876"), ("phone", "+1 (988) 555-2485")} <= kinds("+1 (988) 555-2485 4524132264652876")
    assert kinds("visa 378282246310005") == {("card_near", "378282246310005")} and kinds("no 378282246310005") == set()
    assert pii.luhn("4785380592391139") and pii.mod97("GB82WEST12345698765432")


def test_context_counts_as_whole_words():
    added = lambda t: [k for k, *_ in pii.spans(t)[1]]
    assert added("hotel 555-123-4567") == added("excellent 555-123-4567") == []
    assert added("tel 555-123-4567") == added("Phones: 555-123-4567") == ["phone_near"]


def test_long_runs_take_linear_time():
    import time

    start = time.perf_counter()
    for text in ("1" * 1_000_000, "1." * 500_000, "1 " * 300_000, "+1" * 300_000, "a@" * 300_000, "9.9.9.9 " * 30_000 + "555-123-4567 tel " * 10_000):
        pii.spans(text)
    assert time.perf_counter() - start < 30


def test_pii_redaction(spark):
    out = {r.doc_id: r for r in pii.redact(docs(spark, [(1, "to a@b.cd now"), (2, None), (3, "")])).collect()}
    assert (out[1].text, out[1].n_chars, out[2].text, out[3].text) == ("to [EMAIL] now", 14, None, "")
    assert pii.redact(docs(spark, [])).count() == 0 and pii.find(docs(spark, [])).count() == 0


def _prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_copies_within_the_budget_are_all_found(spark):
    rng = random.Random(5)
    items = [(i, _prose(rng, rng.randrange(8, 40)) if i % 6 else "".join(rng.choice("etaoinsh") for _ in range(13 + i % 3))) for i in range(30)] + [(90, None), (91, "  "), (92, "qqq")]
    rows, want = [], set()
    for d in range(120):
        text = _prose(rng, rng.randrange(5, 120))
        if d % 3 == 0:
            item, passage = items[rng.randrange(30)]
            chars = list(passage)
            k = int(decontamination.EDIT_SHARE * len(chars)) if d % 2 else 0
            for _ in range(k):
                p = rng.randrange(len(chars))
                kind = rng.randrange(3)
                chars[p : p + (kind != 1)] = [] if kind == 2 else ["z"]
            if edit_table(list(passage), chars)[-1][-1] <= int(decontamination.EDIT_SHARE * len(passage)):
                want.add((d, item))
            text = f"{text} {''.join(chars).upper()} {_prose(rng, 10)}"
        rows.append((d, text))
    rows += [(200, None), (201, ""), (202, "an item of qqq here"), (0, rows[0][1])]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, start string")
    got = decontamination.search(docs(spark, rows), bench, block_chars=2000).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert want | {(202, 92)} <= found
    exhaustive = set()
    for d, text in rows:
        for i, passage in items:
            if text and passage and passage.strip():
                low = [ord(c) for c in passage]
                if best_occurrence(masks(low), len(low), decontamination.codes(text).tolist())[0] <= int(decontamination.EDIT_SHARE * len(passage)):
                    exhaustive.add((d, i))
    assert found == exhaustive
    assert len([r for r in got if r.doc_id == 0]) == 2
    kept = {r.doc_id for r in decontamination.clean(docs(spark, rows), bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in found}


def test_blocks_hold_their_bound(spark):
    rng = random.Random(8)
    items = [(i, _prose(rng, rng.randrange(1, 60))) for i in range(300)]
    found = list(decontamination.blocks(spark.createDataFrame(items, "item_id long, text string"), 3000))
    assert sorted(x for b in found for x in b) == items
    assert all(sum(len(t) for _, t in b) <= 3000 or len(b) == 1 for b in found)


def test_copies_in_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.search(docs(spark, [(1, "a b")]), bench).count() == 0
    assert decontamination.search(docs(spark, []), bench).count() == 0
    assert decontamination.clean(docs(spark, [(1, None)]), bench).count() == 1


def plain_words(text):
    return "".join(c.lower() if c.isalnum() else " " for c in text or "").split()


def test_near_duplicates_match_exhaustive_links(spark):
    rng = random.Random(7)
    rows = []
    for g in range(12):
        base = _prose(rng, rng.randrange(40, 200)).split()
        for _ in range(rng.randrange(1, 6)):
            copy = base[:]
            for _ in range(int(len(copy) * rng.choice([0, 0.01, 0.02]))):
                copy[rng.randrange(len(copy))] = "zz" + str(rng.randrange(99))
            rows.append((len(rows), " ".join(copy)))
    passage = _prose(rng, 60)
    rows += [(len(rows) + i, f"{_prose(rng, 90)} {passage}") for i in range(25)]
    rows += [(1000, rows[0][1].upper() + "!"), (1001, ""), (1002, None), (1003, "?!"), (1004, "?!"), (1005, "one two"), (1006, "one TWO."), (None, rows[0][1]), (None, "alone " * 9), (3, rows[3][1])]
    out = near_dedup.classes(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r.class_id for r in out if r.doc_id is not None}
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, t, plain_words(t)) for i, t in rows if i is not None]
    for x, (i, t, a) in enumerate(known):
        for j, u, b in known[:x]:
            near = (t or "") == (u or "") if not a or not b else edit_distance(a, b) <= (1 - near_dedup.SIMILARITY) * max(len(a), len(b)) + 1e-9
            if near and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert got == {i: root(i) for i in parent}
    unnamed = [r.class_id for r in out if r.doc_id is None]
    assert len(unnamed) == 2 and 0 in unnamed and min(unnamed) < 0, "rows without an id take a class with one, or a number of its own"
    kept = [r.doc_id for r in near_dedup.deduplicated(docs(spark, rows)).collect()]
    assert sorted(x for x in kept if x is not None) == sorted(set(got.values())) and kept.count(None) == 1


def edit_distance(a, b):
    row = np.arange(len(b) + 1)
    ids = {w: i for i, w in enumerate(dict.fromkeys(a + b))}
    y = np.array([ids[w] for w in b])
    for i, w in enumerate(a, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (y != ids[w]))
        new = np.concatenate([[i], new])
        row = np.minimum.accumulate(new - np.arange(new.size)) + np.arange(new.size)
    return int(row[-1])


def test_a_large_bucket_of_unlike_texts_ends(spark):
    rng = random.Random(9)
    shared = _prose(rng, 40)
    rows = [(i, f"{shared} {_prose(rng, 25)}") for i in range(60)] + [(100 + i, f"{shared} {_prose(rng, 25)} x{i}") for i in range(3)]
    out = near_dedup.classes(docs(spark, rows)).collect()
    assert len({r.class_id for r in out}) == 63


def _edited(rng, base, share, mark):
    """``base`` with ``share`` of its words replaced, at scattered places."""
    copy = base[:]
    for at in rng.sample(range(len(base)), round(share * len(base))):
        copy[at] = f"{mark}{at}"
    return copy


def test_pairs_in_buckets_of_a_shared_passage_are_found(spark):
    rng = random.Random(11)
    shared = _prose(rng, 150)
    rows, pairs = [(i, f"{shared} {_prose(rng, 60)}") for i in range(40)], []
    for g in range(20):
        own = _prose(rng, 60).split()
        copy = own[:]
        for at in rng.sample(range(60), 24):  # similarity 0.886
            copy[at] = f"zz{at}x{g}"
        pairs.append((1000 + 2 * g, 1001 + 2 * g))
        rows += [(pairs[-1][0], f"{shared} {' '.join(own)}"), (pairs[-1][1], f"{shared} {' '.join(copy)}")]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs(spark, rows)).collect()}
    assert all(got[a] == got[b] == a for a, b in pairs)
    assert all(got[i] == i for i in range(40))


def test_texts_of_a_bucket_are_compared_with_those_its_first_reached(spark):
    rng = random.Random(12)
    first = _prose(rng, 100).split()
    second, third = first[:], first[:]
    second[:18] = [f"y{i}" for i in range(18)]
    third[:36] = second[:18] + [f"z{i}" for i in range(18)]
    packed = [(near_dedup.words(" ".join(t)) >> np.uint64(32)).astype(np.uint32).tobytes() for t in (first, second, third)]
    assert near_dedup.similar(packed[0], packed[1]) and near_dedup.similar(packed[1], packed[2]) and not near_dedup.similar(packed[0], packed[2])
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs(spark, [(i, " ".join(t)) for i, t in enumerate((first, second, third))])).collect()}
    assert set(got.values()) == {0}


def _joined_rows(plan):
    """Rows that the joins of an executed plan made."""
    name = plan.nodeName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else [plan.children().apply(i) for i in range(plan.children().size())]
    made = plan.metrics().apply("numOutputRows").value() if "Join" in name else 0
    return [*([made] if made else []), *(n for p in inner for n in _joined_rows(p))]


def test_a_text_meets_its_bag_once_whatever_its_keys_and_the_size_of_groups(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    n, keys = 24, 3
    one = np.zeros(near_dedup.BAG, np.uint8).tobytes()
    held = spark.createDataFrame([(i, i, 400, bytearray(one)) for i in range(n)], "doc_id long, component long, bytes int, bag binary")
    each = held.select(F.explode(F.sequence(F.lit(1), F.lit(keys)).cast("array<long>")).alias("key"), "doc_id", "component", "bytes")
    found = near_dedup._within(each, spark.createDataFrame([(k, n) for k in range(1, keys + 1)], "key long, n long"), held)
    pairs = {(r.a, r.b) for r in found.collect()}
    assert pairs == {(a, b) for a in range(n) for b in range(a + 1, n)}
    assert sorted(_joined_rows(found._jdf.queryExecution().executedPlan())) == [n, n * keys]


def test_a_large_group_hands_on_links_between_components_and_no_pairs(spark, monkeypatch):
    """Texts of the same words in other orders: their bags allow every pair, of which few are similar."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "ALIGNED", 8)
    rng = random.Random(18)
    vocabulary, packed = np.arange(100, dtype=np.uint32), []
    for _ in range(20):
        base = rng.sample(list(vocabulary), 100)
        moved = base[5:] + base[:5]  # 10 edits
        packed += [base, moved]
    packed += [moved[5:] + moved[:5], rng.sample(list(vocabulary), 100)]
    n, keys = len(packed), 3
    packed = [np.array(w, np.uint32) for w in packed]
    rows = [(i, i, 400, bytearray(w.tobytes()), bytearray(near_dedup.bag(w).tobytes())) for i, w in enumerate(packed)]
    held = spark.createDataFrame(rows, "doc_id long, component long, bytes int, words binary, bag binary")
    each = held.select(F.explode(F.sequence(F.lit(1), F.lit(keys)).cast("array<long>")).alias("key"), "doc_id", "component", "bytes")
    sums = spark.createDataFrame([(k, n) for k in range(1, keys + 1)], "key long, n long")
    links = [(r.a, r.b, r.ca, r.cb) for r in near_dedup._within(each, sums, held).collect()]
    expected = {(i, j) for i in range(n) for j in range(i + 1, n) if near_dedup.similar(packed[i].tobytes(), packed[j].tobytes())}
    assert expected == {(2 * g, 2 * g + 1) for g in range(20)} | {(38, 40), (39, 40)}
    assert {(a, b) for a, b, _, _ in links} <= expected and len(links) == len(set(links)) and all((a, b) == (ca, cb) for a, b, ca, cb in links)
    assert {r.node: r.component for r in near_dedup.components(spark.createDataFrame([v[:2] for v in links], "a long, b long")).collect()} == {i: 38 if i == 40 else i - i % 2 for i in range(n - 1)}
    left = near_dedup._open(each, sums, held).collect()
    assert sorted((r.key, r.doc_id) for r in left) == [(1, i) for i in range(n)], "under one of their keys, once each"


def test_pairs_are_asked_for_under_the_first_key_that_both_hold():
    rng = random.Random(19)
    held = [rng.sample(range(400), rng.randrange(0, 40)) for _ in range(70)] + [[], [5], [5]]
    owner = np.array([i for i, keys in enumerate(held) for _ in keys])
    holders = near_dedup._holders(np.array([k for keys in held for k in keys], np.int64), owner)
    left, right = np.arange(0, len(held), 2), np.arange(20, len(held))
    got = near_dedup._together(holders, left, right)
    assert len(holders) > 3 and got.tolist() == [[bool(set(held[i]) & set(held[j])) for j in right] for i in left]
    assert near_dedup._holders(np.zeros(0, np.int64), np.zeros(0, np.int64)) == []


def test_bags_never_rule_similar_texts_out():
    rng = random.Random(17)
    texts = []
    for _ in range(40):
        base = [rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(rng.randrange(5, 400))]
        copy = base[:]
        for _ in range(rng.randrange(0, near_dedup._budget(len(copy)) + 1)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randrange(0, 2)] = [f"n{rng.randrange(9)}"] * rng.randrange(0, 2)
        texts += [base, copy]
    texts += [["same"] * 900, ["same"] * 800, ["same"] * 700]  # counts that end at 255
    packed = [(near_dedup.words(" ".join(t)) >> np.uint64(32)).astype(np.uint32) for t in texts]
    bags, n = np.stack([near_dedup.bag(w) for w in packed]), np.array([w.size for w in packed])
    met = near_dedup.within_reach(bags, bags, n, n)
    near = np.array([[near_dedup.similar(a.tobytes(), b.tobytes()) for b in packed] for a in packed])
    coarse = near_dedup.coarser(bags).astype(int)
    apart = np.abs(coarse[:, None] - coarse[None]).sum(axis=2)
    assert (apart <= np.abs(bags[:, None].astype(int) - bags[None]).sum(axis=2)).all()
    assert (met | ~near).all() and near.sum() > len(texts) + 40 and met.mean() < 0.5


def test_recall_by_similarity(spark):
    """Pairs that differ in scattered words, the hardest edits for shingles: at the threshold nine in ten are found."""
    rng = random.Random(14)
    rows, pairs = [], {}
    for share, n in ((0.2, 120), (0.15, 60), (0.1, 60)):
        for _ in range(n):
            base, i = _prose(rng, 200).split(), len(rows)
            rows += [(i, " ".join(base)), (i + 1, " ".join(_edited(rng, base, share, "q")))]
            pairs.setdefault(share, []).append((i, i + 1))
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs(spark, rows)).collect()}
    recall = {share: sum(got[a] == got[b] for a, b in found) / len(found) for share, found in pairs.items()}
    assert recall[0.2] >= 0.9 and recall[0.15] >= 0.97 and recall[0.1] == 1.0, recall
    assert len(set(got.values())) >= len(rows) // 2


def test_shared_and_missing_ids_neither_merge_nor_lose_texts(spark):
    rng = random.Random(16)
    a, b, c = (_prose(rng, 60) for _ in range(3))
    almost = " ".join(["changed", *c.split()[1:]])
    rows = [(1, a), (1, b), (2, a), (None, c), (None, almost), (None, b), (1, a)]
    df = docs(spark, rows).withColumns({n: F.lit("x") for n in ("_digest", "raw", "digest", "class_id", "component", "_raw", "_own", "node")})
    found = {}
    for r in near_dedup._classified(df).collect():
        found.setdefault(r.component, set()).add((r.doc_id, r.class_id))
    of = sorted(found.values(), key=len)
    assert len(of) == 3 and len({c for v in of for _, c in v}) == 3  # a with b apart, c with its near copy
    assert {frozenset(d for d, _ in v) for v in of} == {frozenset({1, 2}), frozenset({1, None}), frozenset({None})}
    kept = near_dedup.deduplicated(df)
    assert kept.columns == df.columns
    texts = sorted(r.text for r in kept.collect())
    assert len(texts) == 3 and a in texts and b in texts and ({c, almost} & set(texts))
    assert sum(r.doc_id == 1 for r in kept.collect()) == 2


def test_crowded_buckets_find_all_pairs(spark, monkeypatch):
    """Buckets of several blocks find all pairs, as the plain comparison does."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "FEW", 4)
    rng = random.Random(15)
    shared = _prose(rng, 150)
    rows, pairs = [(i, f"{shared} {_prose(rng, 60)}") for i in range(60)], []
    for g in range(20):
        own = _prose(rng, 60).split()
        pairs.append((1000 + 2 * g, 1001 + 2 * g))
        rows += [(pairs[-1][0], f"{shared} {' '.join(own)}"), (pairs[-1][1], f"{shared} {' '.join(_edited(rng, own, 0.4, f'z{g}x'))}")]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs(spark, rows)).collect()}
    assert all(got[a] == got[b] == a for a, b in pairs) and all(got[i] == i for i in range(60))


def test_near_duplicates_of_empty_tables(spark):
    assert near_dedup.classes(docs(spark, [])).count() == 0
    assert near_dedup.deduplicated(docs(spark, [])).count() == 0


def test_shingles_label_occurrences():
    w = near_dedup.words("a b a b a b")
    assert w[0] == w[2] and w[0] != w[1] and np.unique(near_dedup.shingles(w, 2)).size == 5
    assert near_dedup.words("Ab-c 1!").size == 3 and near_dedup.words("").size == 0
    assert near_dedup.words("x" * 3 + " ab")[-1] == near_dedup.words("AB")[0]
