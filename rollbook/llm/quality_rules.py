"""Quality rules whose cutoffs keep the false rejections of good documents below a bound.

Each rule rejects documents in which a share, such as symbols per word, exceeds a cutoff.
The cutoffs of all rules are chosen together, on labelled documents, per stratum. They come
from one fixed sequence of levels, from loose to strict, each of which tightens one rule. A
level is allowed if what all rules together reject of the good documents there shows, by
the exact binomial distribution, that the true rate lies below the bound. The error
probability is divided among the strata. Levels need no further division: rejections only
grow on the way, so one that fails ends the sequence.
Where labels are too few to show anything, nothing is rejected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.llm.tables import WHITE, join_groups, stage

# Documents that fail these need no label: too few words, or mostly repetition.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Rejects where the expression ``share`` exceeds a cutoff, one of ``cutoffs``."""

    name: str
    share: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / n_words", (2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("duplicate_lines", "n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
    Rule("repetition", "n_repeat_words / n_words", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25)),
    Rule("word_length", "word_chars / n_words", (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0)),
)


@dataclass(frozen=True)
class Risk:
    """At most ``rate`` of a stratum's good documents are rejected, but for a probability
    of ``error`` that this fails anywhere.

    Of the allowed levels the one is taken that rejects the most junk, a good document
    that it rejects weighing as much as ``worth`` of junk; among equals the loosest.
    """

    rate: float = 0.01
    error: float = 0.05
    worth: int = 10


def features(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (the language), n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words.

    Words are runs of other than white space. ``n_lines`` counts the lines with a word, of
    which ``n_dup_lines`` equal an earlier one; ``n_repeat_words`` the words inside windows
    of three that occur twice or more. A null text has no words.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("stratum"),
        text.alias("text"),
        F.filter(F.split(text, WHITE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    # get() gives null beyond the end, where no window starts
    windows = F.when(
        F.size("words") >= 3,
        F.transform(
            F.slice("words", F.lit(1), F.size("words") - 2),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # Windows in the order of their hashes: those that occur again stand side by side.
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    sorted_ = counted.withColumn("sorted", F.when(repeats, F.array_sort(placed)))
    again = F.filter(
        "sorted",
        lambda s, j: (s["w"] == F.get("sorted", j + 1)["w"]) | (s["w"] == F.get("sorted", j - 1)["w"]),
    )
    # j - 1 is -1 for the first, which get() answers with null; null or true is true
    starts = sorted_.withColumn("starts", F.array_sort(F.transform(again, lambda s: s["i"])))
    # a window covers three words, or fewer where the next one starts inside it
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda p, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - p, F.lit(3))),
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return starts.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"),
    )


def _exceeds(rule: Rule, cutoff: float | Column) -> Column:
    return F.coalesce(F.expr(f"CASE WHEN n_words > 0 THEN {rule.share} END") > cutoff, F.lit(False))


def _log_tail(n: Column, x: Column, rate: float) -> Column:
    """The logarithm of P(X <= x) for X binomial with ``n`` trials of probability ``rate``."""
    first = n * math.log1p(-rate)
    odds = math.log(rate) - math.log1p(-rate)

    def add(sums: Column, i: Column) -> Column:
        term = sums["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(sums["sum"], term), F.least(sums["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    steps = F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, F.struct(first.alias("term"), first.alias("sum")), add)["sum"]


def levels(rules: tuple[Rule, ...]) -> list[tuple[int, float]]:
    """The sequence of levels: the number of a rule and its next cutoff. All rules go from
    their loosest to their strictest cutoff at the same pace."""
    steps = [((i + 1) / len(r.cutoffs), k, c) for k, r in enumerate(rules) for i, c in enumerate(sorted(r.cutoffs, reverse=True))]
    return [(k, c) for _, k, c in sorted(steps, key=lambda s: s[:2])]


def select_cutoffs(found: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: Risk = Risk()) -> DataFrame:
    """(stratum, n, cutoffs): for each rule, by its name, the cutoff or null if none is allowed.

    ``labels`` has doc_id and quality, 1 for good documents and 0 for junk; other values,
    nulls, and documents that ``base_failed`` rejects anyway are left out. A doc_id
    labelled several times counts once, as junk if any label says so.
    """
    once = labels.filter("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    steps = levels(rules)
    # the first level that rejects the document; one past the last if none does
    first = F.least(
        F.lit(len(steps)),
        *[F.coalesce(*[F.when(_exceeds(rules[k], c), F.lit(i)) for i, (k, c) in enumerate(steps) if k == r], F.lit(len(steps))) for r in range(len(rules))],
    )
    labelled = found.filter(~base_failed()).join(once, "doc_id").select("stratum", "quality", first.alias("first"))
    good = F.col("quality") == 1
    sums = [
        F.struct(
            F.lit(i).alias("level"),
            F.count_if((F.col("first") <= i) & good).alias("lost"),
            F.count_if((F.col("first") <= i) & ~good).alias("junk"),
        )
        for i in range(len(steps))
    ]
    counted = labelled.groupBy("stratum").agg(F.count("*").alias("n"), F.count_if(good).alias("good"), F.array(*sums).alias("levels"))
    tests = counted.agg(F.count("*").alias("tests"))
    few = lambda c: c["lost"] < F.col("good") * risk.rate
    shown = lambda c: _log_tail(F.col("good"), c["lost"], risk.rate) <= F.log(risk.error / F.col("tests"))
    allowed = F.filter("levels", lambda c: F.when(few(c), shown(c)).otherwise(False))
    # of equal gains the loosest level
    ranked = F.transform(allowed, lambda c: F.struct((c["junk"] - risk.worth * c["lost"]).alias("gain"), (-c["level"]).alias("back")))
    picked = counted.join(F.broadcast(tests)).select("stratum", "n", (-F.array_max(ranked)["back"]).alias("level"))

    def chosen(rule: int) -> Column:
        return F.coalesce(*[F.when(F.col("level") >= i, F.lit(c)) for i, (k, c) in reversed([*enumerate(steps)]) if k == rule])

    return picked.select("stratum", "n", *[chosen(k).alias(f"cutoff_{rule.name}") for k, rule in enumerate(rules)])


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words")


def apply_rules(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    risk: Risk = Risk(),
) -> DataFrame:
    """One row per document: doc_id, the counts of ``features``, base_failed, kept, failed_rules.

    A document is kept unless it has too few words or too much repetition, or exceeds an
    allowed cutoff of its stratum (the language; null is a stratum of its own). Documents
    of a stratum without labels only meet the former. Rows that repeat a doc_id are judged
    each. Other columns are not read; of ``labels``, doc_id and quality are.
    """
    staged = stage(spark)
    found = staged.table("features", features(docs))
    cutoffs = staged.table("cutoffs", select_cutoffs(found, labels, rules, risk))
    joined = join_groups(found, cutoffs, ["stratum"], F.col("doc_id"), "left")
    failed = F.array_compact(
        F.array(*[F.when(_exceeds(r, F.col(f"cutoff_{r.name}")), F.lit(r.name)) for r in rules])
    )
    return joined.select(
        *[c for c in found.columns if c != "stratum"], base_failed().alias("base_failed"), failed.alias("failed_rules")
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
