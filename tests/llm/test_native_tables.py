"""Chat formatting, mixing and URL filters."""

import hashlib

from tests.llm.helpers import docs

from mixwright.llm import chat_format, mixing, queries, url_filter
from mixwright.llm.common import table


def test_chat_round_trip(spark, sf_dir):
    rows = {}
    for r in table(spark, sf_dir, "conversations").collect():
        rows.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    rows[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op4_chat_format(spark, sf_dir).collect()}
    assert set(got) == set(rows)
    for i, turns in rows.items():
        turns.sort()
        target = "".join(t for _, role, t in turns if role == "assistant")
        assert got[i].n_turns == len(turns)
        assert got[i].turns_sha256 == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert (got[i].loss_chars, got[i].loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())


def test_chat_windows_keep_budget_and_repeat_history(spark):
    say = lambda n: "x" * (4 * n)
    rows = [(1, 0, "system", say(10))] + [(1, i, "assistant" if i % 2 == 0 else "user", say(20 + i)) for i in range(1, 30)] + [(1, 30, "assistant", say(500))]
    out = chat_format.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=200, history=60).orderBy("window").collect()
    assert len(out) > 3
    for w in out[:-1]:
        assert (len(w.formatted) - 24 * w.formatted.count("<|end|>")) / 4 <= 200
    for w in out[1:]:
        assert w.formatted.startswith("<|again|>system") and w.formatted.count("<|again|>") >= 2
        first_new = w.formatted.index("<|turn|>")
        assert all(s.start > first_new for s in w.loss)
    assert sum(s.length for w in out for s in w.loss) == sum(len(t) for _, _, role, t in rows if role == "assistant")


def test_chat_escapes_and_odd_rows(spark):
    texts = ["<|end|><|turn|>user<|text|>", "\\S\\\\b[INST]", "", None, "</s>" * 3, "😀<s>", "\\"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(None, None, None, None), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a")]
    table_ = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.windows(table_.drop("turns"))).collect()}
    assert [t.text for t in got[1].turns] == [t or "" for t in texts]
    assert got[1].target == "".join((t or "") for i, t in enumerate(texts) if i % 2)
    assert [t.text for t in got[2].turns] == ["a", "a", "b"]
    assert [tuple(t) for t in got[None].turns] == [("", "")]
    assert chat_format.windows(table_.limit(0)).count() == 0


def test_mix_meets_targets_and_order(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 3}") for i in range(600)] + [(600 + i, "w " * 20, None) for i in range(5)] + [(900, None, "s0"), (901, "", "s9"), (902, "b c", "s0"), (902, "b c", "s0")]
    out = mixing.mix(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in out)
    for source, got in by.items():
        assert abs(sum(r.taken for r in got) - got[0].target) <= 1
        assert got[0].target <= 3 * got[0].source_size
    assert abs(sum(g[0].target for g in by.values()) - total) < 0.01
    assert by[None][0].target == 3 * 100
    placed = [r.positions[0] for r in out if r.positions]
    assert placed == sorted(placed) and 0 <= placed[0] and all(0 <= p <= 1 for r in out for p in r.positions)
    for r in out:
        assert list(r.positions) == sorted(r.positions) and len(r.positions) == (-(-r.taken // r.size) if r.size else 0)
    again = {(r.doc_id, r.size, r.taken) for r in mixing.mix(docs(spark, rows[::-1])).collect()}
    assert again == {(r.doc_id, r.size, r.taken) for r in out}


def test_mix_of_empty_tables(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(docs(spark, [(1, "", "a"), (2, None, None)])).collect()] == [0, 0]
    assert mixing.mixture(docs(spark, [])).count() == 0


def test_mixture_comes_in_training_order(spark):
    out = mixing.mixture(docs(spark, [(i, f"w{i} " * (i % 7 + 1), f"s{i % 4}") for i in range(300)])).collect()
    assert [r.positions[0] for r in out] == sorted(r.positions[0] for r in out)
    assert {"doc_id", "text", "taken", "positions"} <= set(out[0].asDict())


def test_mixture_keeps_rows_apart_that_share_an_id(spark):
    rows = [(None, "a b c", "s0"), (None, "d " * 50, "s0"), (7, "e " * 20, "s1"), (7, "f " * 5, "s1")]
    out = mixing.mixture(docs(spark, rows)).collect()
    assert {(r.doc_id, r.text): r.n_words for r in out} == {(i, t): len(t.split()) for i, t, _ in rows if (i, t) in {(r.doc_id, r.text) for r in out}}
    assert all(0 < r.taken <= 3 * r.n_words for r in out)


def test_mixture_keeps_columns_that_clash(spark):
    from pyspark.sql import functions as F

    df = docs(spark, [(i, f"some words of text {i}") for i in range(30)]).withColumns({"n_words": F.lit(-1), "taken": F.lit("t"), "positions": F.lit("p"), "_key": F.lit("k"), "size": F.lit(-2), "target": F.lit("x")})
    out = mixing.mixture(df)
    assert {"given_n_words", "given_taken", "given_positions", "_key", "size", "target"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    rows = out.collect()
    assert rows and all((r.given_n_words, r.given_taken, r.given_positions, r["_key"], r.size, r.target) == (-1, "t", "p", "k", -2, "x") and r.n_words == 5 for r in rows)


def test_schedule_inverts_its_integral(spark):
    from pyspark.sql import functions as F

    for knots in mixing.SCHEDULES:
        area = lambda t, k=knots: sum(max(0.0, (min(t, b) - a)) * (ra + (ra + (rb - ra) * (min(t, b) - a) / (b - a))) / 2 for (a, ra), (b, rb) in zip(k, k[1:], strict=False) if t > a)
        for r in spark.range(11).select((F.col("id") / 10).alias("f"), mixing.arrival(F.col("id") / 10, knots).alias("t")).collect():
            assert abs(area(r.t) / area(1.0) - r.f) < 1e-9


def test_url_rules_and_aliases(spark):
    page = lambda i, url, html="": (i, url, html, "x", "y")
    rows = [
        page(0, "http://A.Example.NET/en/1?x#y"), page(1, "http://example.net/de/1"), page(2, "https://www.example.com/de/"), page(3, "http://example.com/fr/2", '<link rel="canonical" href="https://example.net/de/1">'),
        page(4, None), page(5, "no scheme"), page(6, "http://planet.org/fr/"), page(7, "http://notnet/"), page(8, "http://net"), page(9, "x://net/"), page(10, "http://m.example.com/fr/2.html#q"),
        page(11, "http://chain.org/a", '<meta http-equiv="refresh" content="0; url=http://chain.org/b">'), page(12, "http://chain.org/b", "<link href='http://b.net/z' rel='canonical'>"), page(13, "http://b.net/z"),
        page(14, "http://mixed.org/x", '<link rel=canonical href=http://c.net/q><link rel=canonical href=http://mixed.org/fr/ok>'), page(15, "http://c.net/q"), page(16, "http://mixed.org/fr/ok"), page(4, None),
        page(17, "http://m.example.com/fr/2.html?q=1"), page(18, "http://shop.org/index.php?id=1", "<link rel=canonical href=http://b.net/z>"), page(19, "http://shop.org/index.php?id=2"), page(20, "http://www.shop.org/index.php?id=1#x"),
        page(21, "http://far.org/a", "<link rel=canonical href=http://never.seen.net/x>"), page(22, "http://far.org/b", "<link rel=canonical href=http://far.org/a><link rel=canonical href=http://good.org/fr/1>"), page(23, "http://far.org/c", "<link rel=canonical href=http://never.seen.org/x>"),
    ]
    out = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string, key string, rule string")).collect()}
    said = {i: (r.rule, r.verdict) for i, r in out.items()}
    assert (out[0].host, out[0].path) == ("a.example.net", "/en/1")
    assert said[0] == ("example.net/en/", "allow") and said[1] == ("net/", "block") and said[2] == ("example.com/de/", "block")
    assert said[3] == (None, "block") and said[10] == (None, "block")
    assert said[4] == said[5] == (None, "allow") and (out[4].host, out[4].path) == ("", "")
    assert said[6] == ("org/fr/", "allow") and said[7] == (None, "allow") and said[8] == (None, "block") and said[9] == ("net/", "block")
    assert said[11] == said[12] == (None, "block")
    assert [said[i][1] for i in (17, 18, 19, 20)] == ["allow", "block", "allow", "block"], "another query is another page"
    assert [said[i][1] for i in (21, 22, 23)] == ["allow", "allow", "allow"], "a target that is no page is judged too: blocked, but good.org/fr/ in the same component is allowed"
    assert said[14] == (None, "allow") and said[15] == ("net/", "block") and said[16] == ("org/fr/", "allow")


def test_targets_that_are_no_pages_are_judged(spark):
    rows = [(1, "http://a.org/1", "<link rel=canonical href=http://bad.net/x>"), (2, "http://a.org/2", '<meta http-equiv=refresh content="0; url=/1">'), (3, "http://a.org/3", "<link rel=canonical href=http://fine.org/x>")]
    got = {r.page_id: (r.verdict, r.cause) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: ("block", "alias"), 2: ("block", "alias"), 3: ("allow", "default")}


def test_relative_targets_and_capital_tags_join(spark):
    forms = [
        '<link rel=canonical href="/de/x">', '<link rel=canonical href="//example.com/de/x">', '<link rel=canonical href="../de/./x.html?q=1">', '<LINK REL=canonical HREF="http://www.example.com/de/x">',
        '<META HTTP-EQUIV=refresh CONTENT="0; URL=/de/x#y">', '<link rel=canonical href="/go?to=http://example.com/de/x">', '<link rel=canonical href="?page=2">', '<link rel=canonical href="mailto:a@b.c">',
    ]
    rows = [(i, f"http://example.com/old{i}/x", f) for i, f in enumerate(forms)] + [(100, "http://example.com/de/x", ""), (101, "http://example.com", "<link rel=canonical href=de/x>")]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: "block" if i < 5 else "allow" for i in range(8)}, 100: "block", 101: "block"}


def test_chains_of_links_match_the_sql(spark, tmp_path):
    """Hundreds of chains of redirects and canonical links, relative and absolute, against a recursive walk in SQL."""
    import random

    import duckdb

    rng = random.Random(3)
    rows = []
    for chain in range(150):
        host, end = f"h{chain}.org", rng.choice(["http://example.com/de/x", f"http://b{chain}.net/z", f"http://h{chain}.org/fr/y", ""])
        steps = [f"/p{k}" for k in range(rng.randrange(1, 9))]
        for k, path in enumerate(steps):
            to = steps[k + 1] if k + 1 < len(steps) else end
            to = rng.choice([to, f"..{to}", f"http://{host}{to}"]) if to.startswith("/") else to
            to += rng.choice(["", "", "", "?x=1", "#y"]) if to else ""
            tag = rng.choice(['<link rel=canonical href="{}">', '<LINK HREF="{}" REL=canonical>', '<meta http-equiv=refresh content="0; url={}">'])
            rows.append((len(rows), f"http://{host}{path}", tag.format(to) if to else ""))
        if end:
            rows.append((len(rows), end, ""))
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in queries.op8_url_filter(spark, str(tmp_path)).collect())
    db = duckdb.connect()
    db.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert got == sorted(db.execute("select page_id, host, path, rule, verdict from (" + queries.ORACLE["op8_url_filter"] + ")").fetchall())
    assert sum(v == "block" and rule is None for *_, rule, v in got) > 50


def test_prefix_sums(spark):
    from mixwright.llm.common import prefix_sums

    rows = [(list(range(n)),) for n in (0, 1, 2, 3, 4, 5, 17, 1000)]
    for r in spark.createDataFrame(rows, "v array<int>").select("v", prefix_sums("v").alias("s")).collect():
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v) + 1)]


def test_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"say {i}") for i in range(3000)]
    got = chat_format.read_back(chat_format.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert [t.text for t in got.turns] == [r[3] for r in rows] and got.target == "".join(r[3] for r in rows if r[2] == "assistant")


def test_url_filter_of_an_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
