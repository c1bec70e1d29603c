"""Quality rules: a learned decision list over text statistics.

``statistics`` measures every whole text with built-in expressions. ``learn`` runs sequential covering on a bounded sample of
labelled rows: a rule grows as a conjunction of thresholds, is pruned on held-back rows and kept while it stays precise.
``verdict`` turns the ordered rules into one chained Spark conditional. ``judge`` puts the three together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import BLANKS, let, text_or_empty

#: Labelled rows read per class to learn from. A bound on the sample the driver sees, not on the rows judged.
SAMPLE_PER_CLASS = 2000
#: Windows found twice are looked up one by one up to this many different ones, beyond it by sorting.
FEW = 24
SYMBOLS = r"[#*$%&|<>]"
FEATURES = ("n_words", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share", "mean_word", "digit_share")


def statistics(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, counts and shares, a row for each row of ``docs``.

    Null text counts as empty: every count is 0 and every share 0.0. Texts of any length are measured whole. Rows that repeat
    are measured each by itself; columns other than doc_id and text are ignored, unless ``keep`` names them: they come along
    in one column, kept.
    """
    along = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_along")] if keep else []
    base = docs.select(F.col("doc_id"), text_or_empty().alias("_t"), *along)
    along = ["_along"] if keep else []
    words = base.select(
        "doc_id",
        *along,
        F.array_remove(F.split("_t", BLANKS), "").alias("_w"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
        F.length(F.regexp_replace("_t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        (F.length("_t") - F.length(F.replace("_t", F.lit("!"), F.lit("")))).cast("long").alias("n_bang"),
        F.regexp_count("_t", F.lit("[0-9]+")).cast("long").alias("n_numbers"),
    )
    counted = words.select(
        "doc_id", *along, "n_symbols", "n_upper", "n_bang", "n_numbers", "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
    )
    # Three steps so that each array is made once: windows, the same sorted, those that occur twice.
    hashed = counted.withColumn(
        "_h",
        F.when(
            F.col("n_words") >= 3,
            F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(F.col("_w")[i], F.col("_w")[i + 1], F.col("_w")[i + 2])),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop("_w")
    ordered = hashed.withColumn("_s", F.sort_array("_h"))
    twice = ordered.withColumn("_d", F.array_distinct(F.filter("_s", lambda x, i: (i > 0) & (x == F.col("_s")[F.greatest(i - 1, F.lit(0))])))).drop("_s")
    repeated = F.when(F.size("_d") == 0, F.lit(0)).when(F.size("_d") <= FEW, _covered(_places_few())).otherwise(_covered(_places_many()))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return twice.withColumn("n_repeat_words", repeated.cast("long")).drop("_h", "_d").select(
        "*",
        share("n_symbols", "n_words").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_bang", "n_words").alias("bang_share"),
        share("word_chars", "n_words").alias("mean_word"),
        share("n_numbers", "n_words").alias("digit_share"),
    )


def _places_few() -> Column:
    return F.filter(F.transform("_h", lambda x, i: F.when(F.array_contains("_d", x), i)), lambda i: i.isNotNull())


def _places_many() -> Column:
    """Windows sorted together with their places; those equal to a neighbour occur twice or more."""
    pairs = F.array_sort(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def flagged(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda x, k, step: F.when((k + step >= 0) & (k + step <= last), F.get(s, k + step)["h"] == x["h"]).otherwise(False)
        return F.filter(F.transform(s, lambda x, k: F.when(same(x, k, -1) | same(x, k, 1), x["i"])), lambda i: i.isNotNull())

    return let(pairs, flagged)


def _covered(places: Column) -> Column:
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold


Rule = tuple[Condition, ...]


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> list[dict]:
    """At most ``per_class`` labelled rows of each class, chosen by a hash of doc_id, with their statistics. Rows without a
    doc_id or a label are no examples."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("quality") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])  # 2 * per_class ids
    stats = statistics(rows).select("doc_id", *FEATURES).join(F.broadcast(chosen), "doc_id")
    return sorted((r.asDict() for r in stats.collect()), key=lambda r: r["doc_id"])


def learn(rows: list[dict], max_rules: int = 12, max_conditions: int = 3, precision: float = 0.95, least: int = 3) -> list[Rule]:
    """Sequential covering for the class to reject (quality 0). Two thirds of the rows grow rules, one third prunes them and
    decides whether a rule is precise enough to stay. No rows or one class only: no rules."""
    grow = [r for i, r in enumerate(rows) if i % 3]
    prune = [r for i, r in enumerate(rows) if i % 3 == 0]
    cuts = {f: _thresholds([r[f] for r in grow]) for f in FEATURES}
    rules: list[Rule] = []
    shunned: set[str] = set()
    while len(rules) < max_rules and sum(r["quality"] == 0 for r in grow) >= least:
        rule = _pruned(_grown(grow, cuts, max_conditions, shunned), prune)
        if not rule:
            break
        bad, good = _counts(rule, prune)
        bad_grow, good_grow = _counts(rule, grow)
        if bad_grow + bad < least or bad < precision * (bad + good) or bad_grow < precision * (bad_grow + good_grow):
            shunned.add(rule[0].feature)  # no rule opens with it again
            continue
        rules.append(rule)
        grow = [r for r in grow if not all(c.holds(r) for c in rule)]
        prune = [r for r in prune if not all(c.holds(r) for c in rule)]
    return rules


def _thresholds(values: list[float], most: int = 24) -> list[float]:
    distinct = sorted(set(values))
    if len(distinct) < 2:
        return []
    places = sorted({round(k * (len(distinct) - 2) / most) for k in range(most + 1)})
    return [(distinct[p] + distinct[p + 1]) / 2 for p in places]


def _counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    met = [r["quality"] for r in rows if all(c.holds(r) for c in rule)]
    return met.count(0), len(met) - met.count(0)


def _grown(rows: list[dict], cuts: dict[str, list[float]], max_conditions: int, shunned: set[str]) -> Rule:
    rule: Rule = ()
    left = rows
    while len(rule) < max_conditions:
        bad = sum(r["quality"] == 0 for r in left)
        good = len(left) - bad
        if not good or not bad:
            break
        before = math.log2(bad / (bad + good))
        best: tuple[float, Condition] | None = None
        for feature in FEATURES:
            for threshold in () if not rule and feature in shunned else cuts[feature]:
                over = [r["quality"] for r in left if r[feature] > threshold]
                over_bad = over.count(0)
                for above, p, n in ((True, over_bad, len(over) - over_bad), (False, bad - over_bad, good - (len(over) - over_bad))):
                    if p:
                        gain = p * (math.log2(p / (p + n)) - before)
                        if best is None or gain > best[0]:
                            best = gain, Condition(feature, above, threshold)
        if best is None or best[0] <= 1e-9:
            break
        rule += (best[1],)
        left = [r for r in left if best[1].holds(r)]
    return rule


def _pruned(rule: Rule, rows: list[dict]) -> Rule:
    def worth(length: int) -> float:
        bad, good = _counts(rule[:length], rows)
        return (bad - good) / (bad + good) if bad + good else -1.0

    return rule[: max(range(1, len(rule) + 1), key=worth)] if rule else rule


def verdict(rules: list[Rule]) -> Column:
    """True where no rule of the list fires: rules in order, the first that fits decides."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for condition in rule:
            test = test & condition.column()
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """doc_id, the counts, base_failed and kept, a row for each row of ``docs``.

    A text fails the base rules with fewer than ``min_words`` words or with more than ``repeat_percent`` percent of them in
    repeated windows; empty and null texts fail. Otherwise the learned list decides; without labels it rejects nothing.
    """
    judged = _judged(statistics(docs), learn(sample(docs, labels)), min_words, repeat_percent)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _judged(measured: DataFrame, rules: list[Rule], min_words: int, repeat_percent: int) -> DataFrame:
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def kept(docs: DataFrame, labels: DataFrame, min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns as they are, in one pass without a join."""
    judged = _judged(statistics(docs, keep=tuple(docs.columns)), learn(sample(docs, labels)), min_words, repeat_percent)
    # The row number keeps the filter above the statistics: pushed below them, it would hold their expressions many times over.
    return judged.withColumn("_row", F.monotonically_increasing_id()).where("kept and _row >= 0").select("_along.*")
