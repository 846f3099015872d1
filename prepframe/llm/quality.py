"""Operator 6: quality rules as a short-circuit cascade (DataFrame functions only).

Base measures of every whole text are columns.  Each further rule is a rejection
condition over the text and the base measures.  ``plan_cascade`` draws a Bernoulli sample of
about ``sample_rows`` texts over the whole table, measures each rule's cost (seconds of
``REPEATS`` runs of the rule on every sampled row within one job, less those of an empty rule)
and takes, one after another, the rule that rejects most of what its forerunners left per
cost.  ``apply_cascade`` evaluates the chain as
one CASE WHEN, so a text rejected by an early rule never pays for the later ones.  The
verdict does not depend on the order; only the work and ``rejected_by`` do.

Edge cases: a null or empty text has no words, all measures 0, and fails the base rule;
an empty table gives an empty result; repeated rows are judged one by one; other columns
of the input are kept by ``apply_cascade`` (its own columns replace clashing names).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SAMPLE_ROWS = 2000
SAMPLE_TASKS = 16  # partitions of the sample, so that timing it starts few tasks
REPEATS = 4  # runs of a rule on each sampled row while it is timed
BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for texts the rule turns away (over `text`, `words`, base columns)."""

    name: str
    reject: str


# All comparisons are in whole numbers, so that SQL twins agree exactly.
RULES = [
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 4 * size(filter(split(text, '\\n'), l -> length(translate(l, ' \\t\\n\\u000b\\f\\r', '')) > 0))"),
    Rule("word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    Rule("shouting", f"10 * (length(text) - length(translate(text, '{UPPER}', ''))) > 4 * word_chars"),
    Rule("exclaiming", "2 * (length(text) - length(translate(text, '!', ''))) > n_words"),
    Rule("echo", "10 * size(filter(slice(words, 2, greatest(size(words) - 1, 0)), (w, i) -> w = words[i])) > 3 * n_words"),
    Rule("no_letters", "10 * size(filter(words, w -> w rlike '\\\\p{L}')) < 4 * n_words"),
]


def _let(value: Column, body) -> Column:
    """``body`` over ``value`` computed once (a lambda variable is never inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows found twice or more in the text, the first included.

    A 64-bit hash stands for each window; it is compared within one text only.  Sorting is
    paid only by texts that do repeat a window.
    """
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )

    def positions(ranked: Column) -> Column:
        marked = F.transform(
            ranked,
            lambda e, k: F.when(
                F.coalesce(e["h"] == F.get(ranked, k - 1)["h"], F.lit(False))
                | F.coalesce(e["h"] == F.get(ranked, k + 1)["h"], F.lit(False)),
                e["i"],
            ).otherwise(F.lit(-1)),
        )
        return F.sort_array(F.filter(marked, lambda i: i >= 0))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.aggregate(
            _let(ranked, positions),
            F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
            lambda s, i: F.struct((i + 3).alias("to"), (s["n"] + i + 3 - F.greatest(s["to"], i)).alias("n")),
            lambda s: s["n"],
        )

    return _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))


def base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (and `words`).

    The measures leave through ``inline``: a later filter on them cannot be moved below
    the generator, so they are computed once per text.
    """
    squeezed = F.translate("text", SPACE, "")
    words = F.when(F.length(squeezed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(F.btrim(F.col("text"), F.lit(SPACE)), "[ \\t\\n\\x0B\\f\\r]+")
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    measures = _let(
        words,
        lambda w: F.struct(
            w.alias("words"),
            F.size(w).cast("long").alias("n_words"),
            F.length(squeezed).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    out = docs.drop("words", "base_failed", *BASE_COLUMNS).withColumn("text", F.coalesce(F.col(text), F.lit("")))
    out = out.select("*", F.inline(F.array(measures)))
    return out.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def sample_of(docs: DataFrame, rows: int, seed: int = 7) -> DataFrame:
    """About ``rows`` rows, each drawn alike, whatever their number or order."""
    n = docs.count()
    return docs if n <= rows else docs.sample(rows / n, seed)


def greedy_order(masks: dict[int, int], costs: list[float]) -> list[int]:
    """Rules by rejection per cost among the rows that the rules before leave.

    ``masks`` counts the sampled rows by the set of rules (bits) that reject them; ties go
    to the smaller number.
    """
    left, order = dict(masks), []
    todo = set(range(len(costs)))
    while todo:
        hits = {k: sum(c for m, c in left.items() if m >> k & 1) for k in todo}
        best = max(todo, key=lambda k: ((hits[k] + 0.5) / costs[k], -k))
        order.append(best)
        todo.remove(best)
        left = {m: c for m, c in left.items() if not m >> best & 1}
    return order


def plan_cascade(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> list[Rule]:
    """Rules by rejection per cost, both measured on about ``sample_rows`` texts of ``docs``.

    The sample only fixes the order in which the rules run, never a verdict.
    """
    sample = sample_of(docs.select(F.col(text).alias("text")), sample_rows).repartition(SAMPLE_TASKS)
    sample = base_measures(sample).where("NOT base_failed").persist()
    try:
        bits = sum((F.when(F.expr(r.reject), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(rules)), F.lit(0))
        masks = {r["m"]: r["n"] for r in sample.groupBy(bits.alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()}  # few rows: sets of rules met

        def seconds(condition: str) -> float:
            # The lambda's body runs once an element: it is neither hoisted nor shared.
            work = F.expr(f"aggregate(sequence(1, {REPEATS}), 0, (a, i) -> a + if({condition}, 1, 0))")
            took = []
            for _ in range(3):  # the first run compiles
                start = time.perf_counter()
                sample.agg(F.sum(work).alias("n")).collect()  # one row
                took.append(time.perf_counter() - start)
            return min(took[1:])

        empty = seconds("n_words < 0")
        costs = [max(seconds(r.reject) - empty, 1e-4) for r in rules]
        return [rules[k] for k in greedy_order(masks, costs)]
    finally:
        sample.unpersist()


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rejecting rule in the given order, null for a kept text."""
    chain = F.when(F.col("base_failed"), F.lit("base"))
    for r in rules:
        chain = chain.when(F.expr(r.reject), F.lit(r.name))
    return chain


def apply_cascade(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All input rows with base measures, ``base_failed``, ``rejected_by`` and ``kept``."""
    order = plan_cascade(docs, rules, sample_rows, text)
    out = base_measures(docs, text).withColumn("rejected_by", cascade(order))
    return out.withColumn("kept", F.col("rejected_by").isNull()).drop("words")
