"""Secret scans: known forms, and a battery of randomness tests for the rest.

Known forms come from regular expressions. Other long tokens are measured against their inferred encoding: chi-squared
uniformity over its alphabet, a runs test and a serial correlation. A token counts as a secret if it passes all three for
random (the least of their probabilities, times three) and if text of its length would hardly have so even a chi-squared
statistic; that second question is put to all tokens together under a bound on the false discovery rate (Benjamini and
Hochberg, weighted by the kind of token). Everything is DataFrame expressions, of linear time in a token's length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import checkpoint, let, prefix_sums, text_or_empty

KINDS = ("assign", "access", "hex")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: A value may stand right behind "=" (NAME=value, ?sig=value).
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Encodings by their alphabets, tried in this order.
ENCODINGS = (("hex", "^[0-9a-f]+$", "0123456789abcdef"), ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF"), ("base32", "^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), ("base62", "^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), ("base64", "^[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), ("base64url", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"))
#: Probability that two letters of a natural word agree, where no token in the tables tells it.
COINCIDENCE = 0.066
FALSE_DISCOVERIES, RANDOM = 0.001, 0.01
SPAN = "array<struct<kind:string,start:int,stop:int,value:string>>"


def matches(text: Column, kind: str, pattern: str, least: Column | None = None) -> Column:
    """All leftmost non-overlapping matches as (kind, start, stop, value) in code points: the text is cut at a mark set
    around every match, and the pieces' lengths are summed up. A text that holds the mark itself loses no place by it."""
    marked = F.split(F.regexp_replace(F.replace(text, F.lit("\u0001"), F.lit("\u0002")), pattern, "\u0001$0\u0001"), "\u0001")

    def spans(s: Column) -> Column:
        odd = F.when(F.size(s["pieces"]) > 1, F.sequence(F.lit(1), F.size(s["pieces"]) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
        place = lambda i: F.get(s["at"], i).cast("int")
        return F.transform(odd, lambda i: F.struct(F.lit(kind).alias("kind"), place(i).alias("start"), place(i + 1).alias("stop"), F.get(s["pieces"], i).alias("value")))

    return let(marked, lambda pieces: let(F.struct(pieces.alias("pieces"), prefix_sums(F.transform(pieces, F.length)).alias("at")), spans))


# Coefficients of a published approximation of the complementary error function, whose relative error is under
# 1.2e-7 everywhere, the far tail included.
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal distribution."""

    def upper(x: Column) -> Column:  # of x >= 0
        t = 1.0 / (1.0 + 0.5 * x)
        inner = F.lit(ERFC[-1])
        for c in reversed(ERFC[:-1]):
            inner = inner * t + c
        return 0.5 * t * F.exp(F.greatest(inner - x * x, F.lit(-700.0)))

    return let(z, lambda v: let(F.abs(v) / math.sqrt(2), lambda x: F.when(v >= 0, upper(x)).otherwise(1.0 - upper(x))))


def battery(value: Column) -> Column:
    """encoding, n, chi, runs, serial (tail probabilities under randomness, two-sided for the last two) and agree: the share
    of pairs of letters that agree."""
    bare = F.regexp_replace(value, "=+$", "")
    which = F.coalesce(*(F.when(value.rlike(p), F.lit(i)) for i, (_, p, _) in enumerate(ENCODINGS) if p), F.lit(len(ENCODINGS) - 1))
    alphabets = F.array(*(F.lit(a) for _, _, a in ENCODINGS))
    names = F.array(*(F.lit(n) for n, _, _ in ENCODINGS))

    def measured(s: Column) -> Column:
        cells = F.length(s["alphabet"])
        codes = F.transform(F.filter(F.split(s["bare"], ""), lambda c: c != ""), lambda c: F.position(c, s["alphabet"]))
        # How often each letter stands: what the value is shorter without it.
        times = F.transform(F.filter(F.split(s["alphabet"], ""), lambda c: c != ""), lambda c: (F.length(s["bare"]) - F.length(F.replace(s["bare"], c, F.lit("")))).cast("double"))
        return let(F.struct(codes.alias("codes"), times.alias("times"), cells.alias("cells"), s["which"].alias("which")), tests)

    def tests(s: Column) -> Column:
        n = F.size(s["codes"]).cast("double")
        # Letters of other alphabets count as one more.
        other = n - F.aggregate(s["times"], F.lit(0.0), lambda a, x: a + x)
        squares = other * other + F.aggregate(s["times"], F.lit(0.0), lambda a, x: a + x * x)
        mean = F.aggregate(s["codes"], F.lit(0.0), lambda a, c: a + c) / n
        high = F.transform(s["codes"], lambda c: c * 2 > s["cells"])
        return let(F.struct(n.alias("n"), squares.alias("squares"), mean.alias("mean"), high.alias("high"), s["codes"].alias("codes"), s["cells"].cast("double").alias("cells"), s["which"].alias("which")), results)

    def results(s: Column) -> Column:
        n = s["n"]
        chi = (s["cells"] / n * s["squares"] - n) * n / (n - 1)
        # Of short values over many cells the statistic has the mean of chi-squared, cells - 1, but only (n - 1) / n of its
        # variance: scaled, with degrees to match. Wilson and Hilferty: its cube root over the degrees is nearly normal.
        df = (s["cells"] - 1) * n / (n - 1)
        z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        ups = F.size(F.filter(s["high"], lambda h: h)).cast("double")
        downs = n - ups
        steps = F.sequence(F.lit(1), (n - 1).cast("int"))
        runs = 1.0 + F.aggregate(steps, F.lit(0.0), lambda a, i: a + F.when(F.get(s["high"], i) != F.get(s["high"], i - 1), 1.0).otherwise(0.0))
        mu = 2 * ups * downs / n + 1
        var = (mu - 1) * (mu - 2) / (n - 1)
        z_runs = F.coalesce(F.try_divide(runs - mu, F.sqrt(F.greatest(var, F.lit(0.0)))), F.lit(9.0))
        around = F.aggregate(s["codes"], F.lit(0.0), lambda a, c: a + F.pow(c - s["mean"], 2))
        along = F.aggregate(steps, F.lit(0.0), lambda a, i: a + (F.get(s["codes"], i) - s["mean"]) * (F.get(s["codes"], i - 1) - s["mean"]))
        z_serial = F.coalesce(F.try_divide(along, around) * F.sqrt(n), F.lit(9.0))
        return F.struct(
            F.element_at(names, s["which"] + 1).alias("encoding"), n.alias("n"), _tail(z_chi).alias("chi"), (2 * _tail(F.abs(z_runs))).alias("runs"),
            (2 * _tail(F.abs(z_serial))).alias("serial"), ((s["squares"] - n) / (n * (n - 1))).alias("agree"),
        )

    return let(F.struct(bare.alias("bare"), F.element_at(alphabets, which + 1).alias("alphabet"), which.alias("which")), measured)


def scan(docs: DataFrame, false_discoveries: float = FALSE_DISCOVERIES, random: float = RANDOM) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, base and found: spans (kind, start, stop, value), a row for each row of ``docs``.

    base holds the spans of the known forms; found those that the tests add, kind "random", none of which overlaps a base
    span. Tokens of under 20 characters are not tested: they are too short to tell. Null text counts as empty and has no spans.
    Whole texts are scanned, however long. Extra columns are ignored, whatever their names. Repeated rows are scanned each, and
    each of their tokens counts in the bound; tokens with equal probabilities are found or left together. An empty table gives no
    rows.
    """
    text = F.col("_t")
    none = F.array().cast(SPAN)
    assign = F.when(text.contains(":") | text.contains("="), F.filter(matches(text, "assign", ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= 8)).otherwise(none)
    access = F.when(text.contains("AKIA"), matches(text, "access", ACCESS)).otherwise(none)
    digits = F.when(text.rlike(HEX), matches(text, "hex", HEX)).otherwise(none)
    tokens = F.when(text.rlike(TOKEN), matches(text, "random", TOKEN)).otherwise(none)
    spans = docs.select("doc_id", text_or_empty().alias("_t")).select("doc_id", F.concat(assign, access, digits).alias("base"), tokens.alias("tokens"))
    apart = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    # Spans are a small part of the texts: kept, so that the texts are read once.
    spans = checkpoint(spans.select("doc_id", "base", F.transform(apart, lambda t: t.withField("tests", battery(t["value"]))).alias("tokens")))
    each = spans.select(F.explode("tokens").alias("t")).select("t.value", "t.tests.*")
    natural = each.where(F.col("value").rlike("^[A-Za-z][a-z]+$")).agg(F.sum(F.col("agree") * F.col("n")) / F.sum("n")).first()[0]
    agree = min(max(natural or COINCIDENCE, 0.04), 0.2)
    # How rarely natural text of that length agrees so little: the shorter, the less it says.
    rare = lambda n, a: _tail((F.lit(agree) - a) / F.sqrt(F.lit(2 * agree * (1 - agree)) / (n * (n - 1))))
    # Natural tokens are of one case or open with a capital, so what mixes digits or cases further in is weighted up. Weights
    # of a weighted false-discovery control have the mean 1 over all tokens.
    weight = lambda v: F.when(v.rlike("[0-9]") & v.rlike("[A-Za-z]"), 1000.0).when(v.rlike("[a-z][A-Z]") & ~v.rlike("[-_/+]"), 10.0).otherwise(1.0)
    mean = each.agg(F.avg(weight(F.col("value")))).first()[0] or 1.0
    p = lambda v, t: F.greatest(rare(t["n"], t["agree"]) / weight(v) * mean, F.lit(1e-30))
    steps = each.select(F.floor(-10 * F.log10(p(F.col("value"), {"n": F.col("n"), "agree": F.col("agree")}))).cast("int").alias("step")).groupBy("step").count()
    bound = _bound([(r["step"], r["count"]) for r in steps.collect()], false_discoveries)  # 301 steps at most
    even = lambda t: F.least(F.lit(1.0), 3 * F.least(t["chi"], t["runs"], t["serial"])) >= random
    found = F.filter("tokens", lambda t: (-10 * F.log10(p(t["value"], t["tests"])) >= bound) & even(t["tests"]))
    return spans.select("doc_id", "base", F.transform(found, lambda t: F.struct(t["kind"].alias("kind"), t["start"].alias("start"), t["stop"].alias("stop"), t["value"].alias("value"))).alias("found"))


def _bound(steps: list[tuple[int, int]], rate: float) -> float:
    """The least -10 log10 p at which the expected share of false discoveries stays under ``rate``."""
    total = sum(n for _, n in steps)
    best, above = 1e9, 0
    for step, n in sorted(steps, reverse=True):
        above += n
        if total * 10 ** (-step / 10) <= rate * above:
            best = float(step)
    return best
