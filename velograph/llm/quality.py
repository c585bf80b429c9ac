"""Quality rules as a short-circuit cascade, in DataFrame functions only.

measure() adds the base figures; each rule is a SQL predicate over them and the text that is true where a document is rejected.
plan_cascade() estimates each rule's cost (seconds a row, measured over whole texts) and selectivity (share rejected) on a
bounded sample, and orders rules by rejection per cost. cascade() evaluates them as one CASE whose first hit ends a row's
evaluation, so a rule that scans the text runs only where no rule before it has rejected. The order decides
only how much work a row costs, never whether it is kept: a document is kept if no rule rejects it.

Nulls count as the empty text (no words, so base_failed); an empty table plans the given order and returns no rows;
repeated rows and ties are judged alike, row by row; extra columns pass through cascade() untouched.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velograph.llm.shared import SPACE_CLASS, free_name, settle, whole_text

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows on which plan_cascade() measures, and how often it runs over each of them.
SAMPLE_ROWS, COPIES = 512, 8


@dataclass(frozen=True)
class Rule:
    """rejects: over the figures of measure(), and {text} for the whole text (null: empty)."""

    name: str
    rejects: str


#: Rules beyond the base ones, at limits usual for prose with a margin: a tenth of symbols, words of 2.5 to 12 characters on the
#: average, three tenths of lines repeated, 0.6 sentence marks a word, three tenths of words without a letter.
RULES = (
    Rule("few_letters", r"10 * regexp_count({text}, '(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D\\p{L}]++(?![^\\x20\\x09-\\x0D])') > 3 * n_words"),
    Rule("sentence_marks", "10 * regexp_count({text}, '[.!?]') > 6 * n_words"),
    Rule("symbol_share", "100 * n_symbols > 10 * word_chars"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("short_words", "2 * word_chars < 5 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
)


def rejects(rule: Rule, text: str) -> Column:
    """The rule's predicate; what it can't tell isn't rejected."""
    own = "coalesce(cast(`" + text.replace("`", "``") + "` as string), '')"
    return F.coalesce(F.expr(rule.rejects.replace("{text}", own)), F.lit(False))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long) and base_failed.

    A window is named by a 64-bit hash of its eight words' hashes; documents without a repeated window, nearly all, are
    told by a distinct count, and only the others sort their windows. Nothing is exploded or shuffled.
    """
    taken = {"n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns in the way: {sorted(taken)}")
    own = whole_text(text)
    words, lines, hashes, windows, pairs, starts = (free_name(f"__{x}", docs.columns) for x in ("words", "lines", "hashes", "windows", "pairs", "starts"))
    df = docs.withColumns({
        words: F.array_remove(F.split(own, SPACE_CLASS + "+"), ""),
        lines: F.filter(F.split(own, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        "n_symbols": F.regexp_count(own, F.lit("[" + SYMBOLS + "]")).cast("long"),
    })
    df = df.select(
        *docs.columns,
        "n_symbols",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias(hashes),
    )
    window = lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW)))
    df = df.withColumn(windows, F.when(F.col("n_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW), window)))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    df = df.withColumn(pairs, F.when(repeats, F.sort_array(F.arrays_zip(F.col(windows).alias("h"), F.sequence(F.lit(0), F.size(windows) - 1).alias("i")))))
    at = F.col(pairs)
    same = lambda p, j: (p["h"] == F.get(at, j - 1)["h"]) | (p["h"] == F.get(at, j + 1)["h"])
    df = df.withColumn(starts, F.sort_array(F.transform(F.filter(at, same), lambda p: p["i"])))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(starts, zero, lambda a, s: F.struct((s + WINDOW).alias("end"), (a["n"] + s + WINDOW - F.greatest(s, a["end"])).alias("n")), lambda a: a["n"])
    df = df.withColumn("n_repeat_words", F.coalesce(covered.cast("long"), F.lit(0).cast("long")))
    df = df.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    return df.drop(hashes, windows, pairs, starts)


def plan_cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """The rules in cascade order, with cost (seconds a row) and rejection (share of the sample).

    The sample is drawn at random and bounded by sample_rows whole rows, which are measured alone. It is written out, so that a
    rule's run over it, COPIES times in one task, holds little else than the rule; what a run without a rule takes is subtracted.
    Ties fall to the given order.
    """
    n = docs.count()
    part = docs if n <= sample_rows else docs.sample(fraction=min(1.0, 4 * sample_rows / n), seed=17)
    held = settle(measure(settle(part.limit(sample_rows), "quality-texts"), text), "quality-sample").coalesce(1)
    rows = held.count()
    if not rows:
        return [{"rule": r, "cost": 0.0, "rejection": 0.0} for r in rules]
    many = held.withColumn(free_name("__copy", held.columns), F.explode(F.sequence(F.lit(1), F.lit(COPIES))))

    def run(hit: Column) -> tuple[float, int]:
        took, hits = float("inf"), 0
        for _ in range(2):
            began = time.perf_counter()
            hits = many.agg(F.count_if(hit)).first()[0]
            took = min(took, time.perf_counter() - began)
        return took, hits

    idle = run(F.length(whole_text(text)) < 0)[0]
    found = []
    for r in rules:
        took, hits = run(rejects(r, text))
        found.append({"rule": r, "cost": max(took - idle, 0.0) / (rows * COPIES), "rejection": hits / (rows * COPIES)})
    return sorted(found, key=lambda x: -x["rejection"] / max(x["cost"], 1e-7))


def cascade(measured: DataFrame, order: list[dict], text: str = "text") -> DataFrame:
    """measured with rejected_by (the first rule of the order that rejects, else null) and kept."""
    verdict = F.when(F.col("base_failed"), "base")
    for x in order:
        verdict = verdict.when(rejects(x["rule"], text), x["rule"].name)
    return measured.withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())
