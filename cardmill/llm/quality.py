"""Operator 7, quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame, functions as F

from cardmill.llm.common import SPACE_CLASS, WORD_CLASS, count_words, free, let, words_of
from cardmill.session import materialize

SYMBOLS = "[#*$%&|<>]"
SAMPLE_ROWS = 1000
# Each row of the sample is judged so often in a run, and each rule is timed in so many runs behind an unmeasured one.
REPEATS, ROUNDS = 4, 3
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# A three-word window is sorted as one number: the upper bits of its hash and its position.
PLACE_BITS = 20


@dataclass(frozen=True)
class Rule:
    """A name and a condition that is true for rows to reject."""

    name: str
    rejects: Column


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def word_chars(text: Column) -> Column:
    """Code points that are no ASCII white space."""
    return _zero(F.length(text) - F.regexp_count(text, F.lit(SPACE_CLASS)))


def symbol_count(text: Column) -> Column:
    return _zero(F.regexp_count(text, F.lit(SYMBOLS)))


def _worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD_CLASS))


def dup_line_count(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return _zero(let(_worded_lines(text), lambda ls: F.size(ls) - F.size(F.array_distinct(ls))))


def _covered(places: Column) -> Column:
    """Words inside three-word windows that start at the sorted ``places``."""

    def total(at: Column) -> Column:
        spans = F.transform(
            at, lambda p, i: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get(at, i + 1) - p, F.lit(3).cast("bigint")))
        )
        return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return let(places, total)


def _repeats(ordered: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The elements of a sorted array that are the same as a neighbour."""

    def alike(x: Column, i: Column) -> Column:
        return F.coalesce(same(x, F.get(ordered, i)), F.lit(False))

    return F.filter(ordered, lambda x, i: F.when(i > 0, alike(x, i - 1)).otherwise(False) | alike(x, i + 1))


def _covered_by_numbers(words: Column, starts: Column) -> Column:
    """For texts of fewer than 2**PLACE_BITS words: one sort of plain numbers; equal neighbours are compared in full."""
    low = (1 << PLACE_BITS) - 1

    def number(word: Column, i: Column) -> Column:
        return F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(~low).bitwiseOR(i.cast("bigint"))

    def same(x: Column, y: Column) -> Column:
        alike = F.shiftright(x.bitwiseXOR(y), PLACE_BITS) == 0
        here, there = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
        for step in range(3):
            alike = alike & (F.get(words, here + step) == F.get(words, there + step))
        return alike

    found = let(F.sort_array(F.transform(starts, number)), lambda ordered: _repeats(ordered, same))
    return _covered(F.sort_array(F.transform(found, lambda x: x.bitwiseAND(low))))


def _covered_by_windows(words: Column, starts: Column) -> Column:
    """For longer texts: the windows themselves are sorted."""

    def window(word: Column, i: Column) -> Column:
        return F.struct(
            F.struct(word, F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.cast("bigint").alias("i")
        )

    ordered = F.sort_array(F.transform(starts, window))
    found = let(ordered, lambda o: _repeats(o, lambda x, y: x["w"] == y["w"]))
    return _covered(F.sort_array(F.transform(found, lambda x: x["i"])))


def repeat_word_count(words: Column) -> Column:
    """Words in three-word windows that are found twice or more in the text, the first included.

    Windows are matched by sorting, so a text costs n log n in its number of words.
    """

    def count(ws: Column) -> Column:
        n = F.size(ws)
        starts = F.slice(ws, F.lit(1), F.greatest(n - 2, F.lit(0)))
        return F.when(n >= (1 << PLACE_BITS), _covered_by_windows(ws, starts)).otherwise(_covered_by_numbers(ws, starts))

    return let(words, count)


def with_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the five counts of a text; null and empty texts count 0 everywhere. Columns of these names are replaced."""
    docs = free(docs, *METRICS)
    text = F.col(f"`{text_col}`")
    split = docs.withColumn("_llm_words", words_of(text))
    return split.withColumns(
        {
            "n_words": F.size("_llm_words").cast("bigint"),
            "word_chars": word_chars(text),
            "n_symbols": symbol_count(text),
            "n_dup_lines": dup_line_count(text),
            "n_repeat_words": repeat_word_count(F.col("_llm_words")),
        }
    ).drop("_llm_words")


def rules_on_metrics() -> list[Rule]:
    """The rules for rows that carry the five counts."""
    n, chars, symbols, lines, repeats = (F.col(c) for c in METRICS)
    return _rules(n, chars, symbols, lines, repeats)


def rules_on_text(text_col: str = "text") -> list[Rule]:
    """The same rules on the text itself: a rule that is not reached computes nothing."""
    text = F.col(f"`{text_col}`")
    n = count_words(text)
    return _rules(n, word_chars(text), symbol_count(text), dup_line_count(text), repeat_word_count(words_of(text)))


def _rules(n: Column, chars: Column, symbols: Column, lines: Column, repeats: Column) -> list[Rule]:
    """The first two are the base rules; the thresholds are the parameters of this engine, looser than clean prose."""
    return [
        Rule("few_words", n < 50),
        Rule("repeated_words", 100 * repeats > 50 * n),
        Rule("many_symbols", 2 * symbols > n),
        Rule("word_length", (chars < 2 * n) | (chars > 15 * n)),
        Rule("repeated_lines", 10 * lines > 3 * n),
    ]


def base_failed(rules: Sequence[Rule]) -> Column:
    return rules[0].rejects | rules[1].rejects


def draw_sample(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame | None:
    """About ``sample_rows`` rows drawn over the whole table and written once, REPEATS times each; None for an empty table.

    Repeats make the rules cost more than the job around them.
    """
    total = docs.count()
    if not total:
        return None
    drawn = materialize(docs.sample(min(1.0, sample_rows / total), seed=7), "quality-sample")
    return drawn.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))).drop("_llm_copy")


def order_rules(sample: DataFrame | None, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by share of rejected rows per second, best first, each measured by itself over the sample.

    Rules are timed in turn, in several rounds, beside a rule that looks at nothing: its time is that of the job, which
    is no cost of a rule. The first round, which compiles code, does not count, and of the others the median does.
    Order changes the cost of a cascade and the rule that is named, never which rows are kept. Without a sample
    the rules keep the order given.
    """
    if sample is None:
        return list(rules)

    def run(condition: Column) -> tuple[float, int]:
        began = time.perf_counter()
        rejected = sample.agg(F.count_if(condition)).first()[0]
        return time.perf_counter() - began, rejected

    seconds: list[list[float]] = [[] for _ in rules]
    rejected = [0] * len(rules)
    for turn in range(ROUNDS + 1):
        job, _ = run(F.lit(False))
        for i, rule in enumerate(rules):
            spent, rejected[i] = run(rule.rejects)
            if turn:
                seconds[i].append(spent - job)
    gains = [n / max(median(spent), 1e-3) for n, spent in zip(rejected, seconds, strict=True)]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: -gains[i])]


def cascade(
    docs: DataFrame, rules: Sequence[Rule], sample: DataFrame | None, verdict_col: str = "failed_rule"
) -> DataFrame:
    """Adds the first rule that rejects a row, null where none does.

    The rules stand in one CASE in the order measured on ``sample``, rows with the columns that the rules read; so
    a row that one rule rejects pays for no later one. A rule that gives null does not reject.
    """
    docs = free(docs, verdict_col)
    verdict = F.lit(None).cast("string")
    for rule in reversed(order_rules(sample, rules)):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return docs.withColumn(verdict_col, verdict)


def quality_report(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the five counts, ``base_failed``, ``failed_rule`` and ``kept``.

    Null, empty and blank texts have no words and fail. Repeated rows are judged alike.
    """
    rules = rules_on_metrics()
    docs = free(docs, *METRICS, "base_failed", "failed_rule", "kept")
    # The sample is drawn from the texts, so that only its own rows are counted for it.
    sample = draw_sample(docs.select(F.col(f"`{text_col}`")), sample_rows)
    sample = None if sample is None else with_metrics(sample, text_col)
    judged = cascade(with_metrics(docs, text_col), rules, sample)
    return judged.withColumns({"base_failed": base_failed(rules), "kept": F.col("failed_rule").isNull()})


def quality_filter(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with the columns they came with."""
    sample = draw_sample(docs.select(F.col(f"`{text_col}`")), sample_rows)
    judged = cascade(docs, rules_on_text(text_col), sample, "_llm_failed_rule")
    return judged.where(F.col("_llm_failed_rule").isNull()).drop("_llm_failed_rule")
