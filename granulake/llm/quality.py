"""Operator 1: quality rules with risk-controlled cutoffs.

A rule rejects a text whose feature exceeds a cutoff. The cutoffs of a stratum come
from one path of growing sets of (rule, cutoff): set t holds the first t cells, and
rejects what any of them rejects. The path is ordered by rows the tests do not use,
the labelled bad texts and those without a label: cells by how many bad texts they
reject per other text. (A stratum with fewer unlabelled than good texts gives one in
`ORDERING` of its good texts to this side.) Then every set is held against the good
labelled texts: all its rules together would reject k of n; the set is safe if
Bin(n, `risk`) gives k or fewer with probability of at most `error` / (strata * rules *
cutoffs), that is, if the exact upper binomial bound of its false rejections is below
the risk. A path has no more sets than rules * cutoffs. Of the safe sets, the one that
removes most bad texts less good ones is taken; none if none removes more bad than
good. With probability 1 - `error`, the rules together then reject no more than
`risk` of the good texts of any stratum.

All is DataFrame code. Features are computed once per text, inside the row, and
written as numbers; texts are never shuffled. Labels meet features by id, and
what is counted is a table of (stratum, label, step of each rule).

Null text: no words, fails the base rule. Empty tables: no rows, no cutoffs. Null
stratum: a stratum of its own. A stratum without enough labels gets no cutoff and
loses nothing but base failures. Rows repeated under one id are judged alone; an
id labelled both good and bad counts as bad. Label columns may have any other
names beside `doc_id` and `quality`. Within one text, windows are compared by
64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granulake.llm.common import GAPS, let, saved, words

#: A power of two.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Candidate cutoffs of every rule: first * ratio ** step.
STEPS, FIRST, RATIO = 24, 0.01, 1.4
RISK, ERROR = 0.02, 0.05
#: One in so many good texts orders the path where unlabelled ones are few.
ORDERING = 5
#: More strata than this are joined by key instead of being sent to all executors.
BROADCAST_STRATA = 10_000


def count_of(text: Column, letters: str) -> Column:
    """Code points of a text that are among `letters`."""
    rest = text
    for letter in letters:
        rest = F.replace(rest, F.lit(letter), F.lit(""))
    return (F.length(text) - F.length(rest)).cast("long")


def window_hashes(parts: Column) -> Column:
    """64-bit hash of each window of `WINDOW` consecutive words, built from the hashes of its halves."""
    hashes, span = F.transform(parts, lambda w: F.xxhash64(w)), 1
    while span < WINDOW:
        hashes = let(hashes, halves(span))
        span *= 2
    return let(hashes, lambda h: F.when(F.size(h) >= WINDOW, F.slice(h, F.lit(1), F.size(h) - (WINDOW - 1))).otherwise(F.array().cast("array<bigint>")))


def halves(span: int) -> Callable[[Column], Column]:
    return lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + span)))


def repeated_words(hashes: Column) -> Column:
    """Words that lie in windows found at least twice, from the hash of each window."""

    def covered(places: Column) -> Column:
        between = F.when(F.size(places) > 1, F.sequence(F.lit(1), F.size(places) - 1)).otherwise(F.array().cast("array<int>"))
        step = lambda total, i: total + F.least(F.lit(WINDOW), places[i] - places[i - 1])
        return F.aggregate(between, F.lit(WINDOW), step)

    def places(ordered: Column) -> Column:
        same = lambda x, i: x["hash"].eqNullSafe(F.get(ordered, i - 1)["hash"]) | x["hash"].eqNullSafe(F.get(ordered, i + 1)["hash"])
        return F.sort_array(F.transform(F.filter(ordered, same), lambda x: x["at"]))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(twice, let(let(ordered, places), covered)).otherwise(F.lit(0)).cast("long")


def features(docs: DataFrame, text: str = "text", id: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """Id, stratum, counts and the base verdict of each text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(GAPS)) != "")
    split = docs.select(
        F.col(id), F.col(stratum).cast("string").alias("stratum"), body.alias("body"), words(F.col(text)).alias("words"), lines.alias("lines")
    )
    counted = split.select(
        id,
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        (F.length("body") - count_of(F.col("body"), GAPS)).cast("long").alias("word_chars"),
        count_of(F.col("body"), SYMBOLS).alias("n_symbols"),
        count_of(F.col("body"), "!").alias("n_exclaims"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        let(window_hashes(F.col("words")), repeated_words).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def rules() -> dict[str, Column]:
    """By name: the value a cutoff is held against."""
    per = lambda n, of: F.col(n) / F.greatest(F.lit(1), F.col(of))
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "exclaims_per_word": per("n_exclaims", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "chars_per_word": per("word_chars", "n_words") / 20,
        "words_per_line": per("n_words", "n_lines") / 1000,
    }


def step_of(value: Column) -> Column:
    """How many of the candidate cutoffs a value exceeds."""
    return sum(((value > FIRST * RATIO**i).cast("int") for i in range(1, STEPS)), (value > FIRST).cast("int"))


def at_most(k: Column, n: Column, share: float) -> Column:
    """P(Bin(n, share) <= k), summed over log terms so that it neither over- nor underflows."""
    odds, none = math.log(share / (1 - share)), math.log1p(-share)

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(state["top"], term)
        return F.struct(term.alias("term"), top.alias("top"), (state["sum"] * F.exp(state["top"] - top) + F.exp(term - top)).alias("sum"))

    first = n * F.lit(none)
    start = F.struct(first.alias("term"), first.alias("top"), F.lit(1.0).alias("sum"))
    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    # beyond twice the mean the tail is over one half and no test passes
    return F.when(k > 2 * share * n + 2, F.lit(1.0)).otherwise(
        F.aggregate(terms, start, add, lambda s: F.least(F.lit(1.0), F.exp(s["top"]) * s["sum"]))
    )


def cutoffs(measured: DataFrame, labels: DataFrame, id: str = "doc_id", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Stratum, rule, and the step and value of its cutoff; at most one row per stratum and rule."""
    known = rules()
    good = labels.where("quality is not null").groupBy(id).agg(F.min("quality").alias("good"))
    held = measured.where("not base_failed").join(good, id, "left")
    key = F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit("")).alias("key")
    part = (F.pmod(F.xxhash64(F.lit("order"), id), F.lit(ORDERING)) == 0).alias("part")
    steps = F.array(*[step_of(value) for value in known.values()]).alias("steps")
    rows = saved(held.select(key, "stratum", "good", part, steps).groupBy("key", "stratum", "good", "part", "steps").agg(F.count("*").alias("n")), "quality-steps")
    number = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    few = rows.groupBy("key").agg((number(F.col("good").isNull()) < number(F.col("good") == 1)).alias("few"))
    tested = (F.col("good") == 1) & ~(F.col("few") & F.col("part"))
    rows = rows.join(few, "key").withColumn("tested", F.coalesce(tested, F.lit(False))).withColumn("bad", F.coalesce(F.col("good") == 0, F.lit(False)))

    at = F.posexplode("steps").alias("rule", "step")
    cells = rows.where("not tested").select("key", "bad", "n", at).where("step > 0")
    cells = cells.select("key", "rule", "bad", "n", F.explode(F.sequence(F.lit(0), F.col("step") - 1)).alias("cutoff"))
    cells = cells.groupBy("key", "rule", "cutoff").agg(number(F.col("bad")).alias("n_bad"), number(~F.col("bad")).alias("n_other")).where("n_bad > 0")
    order = F.struct((-F.col("n_bad") / (F.col("n_other") + 1)).alias("score"), (-F.col("cutoff")).alias("lenient"), "rule", "cutoff")
    paths = saved(cells.groupBy("key").agg(F.sort_array(F.collect_list(order)).alias("path")), "quality-paths")

    # the first set of the path that rejects a text, 0 if none does
    rejects = F.transform("path", lambda cell: F.get("steps", cell["rule"]) > cell["cutoff"])
    counts = rows.where("tested or bad").join(paths, "key").select("key", "stratum", "bad", "n", F.array_position(rejects, F.lit(True)).alias("first"), F.size("path").alias("sets"))
    counts = counts.groupBy("key", "stratum", "sets", "first").agg(number(~F.col("bad")).alias("n_good"), number(F.col("bad")).alias("n_bad"))
    hit = (F.col("first") > 0) & (F.col("first") <= F.col("set"))
    tests = (
        counts.withColumn("set", F.explode(F.sequence(F.lit(1), F.col("sets"))))
        .groupBy("key", "stratum", "set")
        .agg(F.sum("n_good").alias("n"), F.sum(F.when(hit, F.col("n_good")).otherwise(0)).alias("k"), F.sum(F.when(hit, F.col("n_bad")).otherwise(0)).alias("bad"))
        .where("n > 0")
    )
    tests = saved(tests, "quality-tests")
    strata = max(1, rows.where("tested").select("key").distinct().count())
    level = error / (strata * len(known) * STEPS)
    gain = F.col("bad") - F.col("k")
    safe = tests.where((gain > 0) & (at_most(F.col("k"), F.col("n"), risk) <= level))
    best = safe.groupBy("key", "stratum").agg(F.max_by("set", F.struct(gain, -F.col("set"))).cast("int").alias("set"))
    taken = best.join(paths, "key").select("stratum", F.explode(F.slice("path", F.lit(1), F.col("set"))).alias("cell"))
    name = F.element_at(F.array(*[F.lit(x) for x in known]), F.col("rule") + 1).alias("rule")
    return (
        taken.groupBy("stratum", F.col("cell.rule").alias("rule")).agg(F.min("cell.cutoff").alias("step"))
        .select("stratum", name, "step", (F.lit(FIRST) * F.pow(F.lit(RATIO), F.col("step"))).alias("above"))
    )


def judged(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Features of each text, the rules that reject it, and whether it is kept."""
    measured = saved(features(docs, text, id, stratum), "quality-features")
    chosen = saved(
        cutoffs(measured, labels, id).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "step"))).alias("cut")),
        "quality-cutoffs",
    )
    if chosen.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        chosen = F.broadcast(chosen)
    key = F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit(""))  # a null stratum joins too
    joined = measured.withColumn("key", key).join(chosen.select(key.alias("key"), "cut"), "key", "left")
    hit = [F.when(step_of(value) > F.col("cut")[name], F.lit(name)) for name, value in rules().items()]
    failed = F.filter(F.array(*hit), lambda x: x.isNotNull())
    return joined.select(
        id, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"), failed.alias("failed_rules"), "n_exclaims", "n_lines", "stratum",
    )
