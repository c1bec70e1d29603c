"""The queries of this subpackage: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.llm import alignment, chat_format, decontamination, hard_negatives, html_text, mixing, near_dedup, neighbours, pii, quality_rules, secrets, toxicity, url_filter
from mixwright.llm.common import table


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    # Base spans come by kind, then start; added ones, of kinds old and new, are set among them.
    rank = lambda k: F.coalesce(F.array_position(F.array(*map(F.lit, pii.KINDS + pii.FURTHER)), k), F.lit(99))
    ordered = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(rank(s["kind"]).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(ordered).alias("spans"), F.size("added").cast("long").alias("n_added"),
        F.array_min(F.transform(F.concat("base", "added"), lambda s: s["score"])).alias("least_score"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    rank = lambda k: F.array_position(F.array(*map(F.lit, (*secrets.KINDS, "random"))), k)
    ordered = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))), lambda s: s)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, secrets.KINDS), F.sha2(_joined(ordered(F.col("base"))).cast("binary"), 256).alias("base_sha256"),
        _joined(ordered(F.concat("base", "found"))).alias("spans"), F.size("found").cast("long").alias("n_random"),
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = chat_format.read_back(chat_format.windows(rows.unionByName(hostile)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"), F.length("target").cast("long").alias("loss_chars"),
        F.sha2(F.col("target").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_windows",
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", *(F.floor(F.get("positions", F.lit(e)) * 1_000_000).cast("long").alias(f"position_{e + 1}") for e in range(3))
    )


def _arrival_sql(fraction: str, knots) -> str:
    """The time at which a schedule has spent ``fraction`` of its integral, as in mixing.arrival()."""
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False)]
    whole, spent, out = sum(areas), 0.0, ""
    for ((t0, r0), (t1, r1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        part, slope = f"greatest({fraction} * {whole}::double - {spent}::double, 0::double)", (r1 - r0) / (t1 - t0)
        x = f"{part} / {r0}::double" if slope == 0 else f"2 * {part} / ({r0}::double + sqrt(greatest({r0 * r0}::double + {2 * slope}::double * {part}, 0::double)))"
        spent += area
        out += f" when {fraction} * {whole}::double <= {spent}::double then {t0}::double + {x}"
    return f"case{out} else {knots[-1][0]}::double end"


def _position_sql(use: int) -> str:
    fraction = f"coalesce((start + {use} * source_size)::double / nullif(target, 0), 0)"
    times = " ".join(f"when {i} then {_arrival_sql(fraction, s)}" for i, s in enumerate(mixing.SCHEDULES))
    return f"case when size > 0 and start + {use} * source_size < floor(target) then floor((case (place % {len(mixing.SCHEDULES)})::int {times} end) * 1000000)::bigint end as position_{use + 1}"


OP7_SQL = """
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size, md5(coalesce(doc_id::varchar, '') || ' ' || md5(coalesce(text, ''))) as k from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
p as (select *, row_number() over (order by source nulls last) - 1 as place from s),
w as (select *, (1 + place % 3)::double as weight, (3 * source_size)::double as cap, (sum(source_size) over ())::double as total from p),
f as (select *, sum(cap) over o - cap as before, sum(weight) over () - sum(weight) over o + weight as remaining, row_number() over o as rank
      from w window o as (order by cap / weight, place rows between unbounded preceding and current row)),
l as (select *, (total - before) / remaining as level from f),
c as (select *, first_value(level) over (order by case when cap > weight * level then rank end nulls last, rank) as final_level,
      bool_or(cap > weight * level) over () as any_free from l),
t as (select source, source_size, place, round(least(cap, case when any_free then weight * final_level else cap end), 6) as target from c),
x as (select d.doc_id, d.size, t.source_size, t.target, t.place, sum(d.size) over (partition by d.source order by d.k, d.doc_id nulls first, d.size rows between unbounded preceding and current row) - d.size as start
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (least(greatest(floor(target)::bigint - start, 0), size) + least(greatest(floor(target)::bigint - source_size - start, 0), size)
   + least(greatest(floor(target)::bigint - 2 * source_size - start, 0), size))::bigint as taken, """ + ", ".join(map(_position_sql, range(3))) + """
from x
"""


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("cause")


def _op8_sql() -> str:
    """The rules as a CASE, for pages and for the targets of their links; aliases by a recursive walk over alias keys."""
    ordered = sorted(url_filter.RULES, key=lambda r: (-len(r.name), r.name))
    case = lambda value: "case " + " ".join(f"when (host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}') then '{value(r)}'" for r in ordered) + " end"
    upper, lower = url_filter.UPPER, url_filter.LOWER
    host = f"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}') as host"
    path = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path"
    query = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\\?([^#]*)', 1) as query"
    parsed = f"{host}, {path}, {query}"
    key = "case when host <> '' then regexp_replace(host, '^(?:www|m)\\.', '') || '/' || regexp_replace(regexp_replace(path, '(?:/index)?(?:\\.html?)?/*$', ''), '^/+', '') || case when query <> '' then '?' || query else '' end end"
    # Targets against the page's url: folders walked by a list that grows and shrinks.
    inside = "regexp_extract(target, '(?s)^[^?#]*', 0)"
    joined = f"case when {inside} = '' then path when starts_with({inside}, '/') then {inside} else (case when contains(path, '/') then regexp_extract(path, '(?s)^.*/', 0) else '/' end) || {inside} end"
    step = "lambda a, p: case when p = ['..'] then a[1:greatest(len(a) - 1, 0)] when p = ['.'] then a else a || p end"
    walked = f"array_to_string(list_reduce(list_prepend([]::varchar[], list_transform(string_split(regexp_replace({joined}, '^/', ''), '/'), lambda x: [x])), {step}), '/')"
    asked = f"case when regexp_matches(target, '(?s)^[^#]*\\?') then regexp_extract(target, '(?s)^[^?#]*\\?([^#]*)', 1) when {inside} = '' then query else '' end"
    resolved = f"case when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') then target when starts_with(target, '//') then 'http:' || target else 'http://' || host || '/' || {walked} || case when {asked} <> '' then '?' || {asked} else '' end end"
    return f"""
with recursive u as (select page_id, html, {parsed} from pages),
r as (select page_id, host, path, query, html, {case(lambda r: r.name)} as rule, {case(lambda r: r.verdict)} as said, {key} as key from u),
tags as (select key, host, path, query, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) as tag from r),
aims as (select key as a, host, path, query, coalesce(nullif(regexp_extract(case when regexp_matches(tag, '(?is)^<link\\b.*\\brel\\s*=\\s*["'']?canonical\\b') then tag else '' end, '(?is)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1), ''),
      nullif(regexp_extract(case when regexp_matches(tag, '(?is)^<meta\\b.*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b') then tag else '' end, '(?is)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1), '')) as target from tags),
full_ as (select a, {resolved} as url from aims where target is not null),
ends as (select a, {parsed} from full_),
links as (select a, host, path, {key} as b from ends where a is not null),
sides as (select a, b from links where b is not null union select b, a from links where b is not null),
walk as (select key as origin, key as node from r where key is not null union select walk.origin, sides.b from walk join sides on walk.node = sides.a),
spoken as (select key, said from r where key is not null union all select b, {case(lambda r: r.verdict)} from links where b is not null and b <> a),
keys as (select key, bool_or(said = 'block') as blocks, bool_or(said = 'allow') as allows from spoken group by key),
decided as (select origin, bool_or(blocks) and not coalesce(bool_or(allows), false) as blocked from walk join keys on walk.node = keys.key group by origin)
select page_id, host, path, rule, coalesce(said, case when blocked then 'block' end, 'allow') as verdict from r left join decided on r.key = decided.origin
"""


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search(rows, rows.where("vec_id % 20 = 0"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP12_SQL = """
with rows_ as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from (select * from rows_ where vec_id % 50 = 0) a join rows_ b on a.vec_id <> b.vec_id),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.vec_id)::int as rank, n.vec_id as negative_id, positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same and 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by n.score desc, n.vec_id) <= 3
"""


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_pii, op3_secret_scan, op4_chat_format, op5_near_dedup, op6_toxicity, op7_mixing, op8_url_filter, op9_quality_rules, op10_html_text, op11_nearest_neighbours,
        op12_hard_negatives, op13_token_alignment,
    )
}
ORACLE = {"op7_mixing": OP7_SQL, "op8_url_filter": _op8_sql(), "op12_hard_negatives": OP12_SQL}
