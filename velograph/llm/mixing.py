"""Temperature mixing of sources to target weights, in DataFrame functions only.

Source i with token share p_i gets the weight p_i^a / sum(p^a). The exponent a in [0, 1] (1: as found, 0: even) is bisected
to 2^-30: the largest a whose entropy reaches a target, or the smallest a under which no source repeats beyond a limit (the
larger of both, if both are given: the limit wins). Weights are then realised as a stream of blocks. Each source is a
sequence of epochs, each its own pseudo-random permutation of the source's documents; the stream's block b holds, of each
source, the documents whose first token lies in its b-th quota, and is itself a permutation of them.

A document weighs its words, one at least, so that blocks are bounded. Positions come from two levels of prefix sums
(hash buckets of some BUCKET_ROWS rows, then rows of a bucket), so no task sees a whole source. All this runs over the rows' names,
sources and sizes; whole rows join once, at the end. Only scalars reach the driver. With a budget, a
copy is kept if it ends within its source's tokens; without one the budget is the least that holds every document once.

A null source is a source of its own, a null text or doc_id is allowed, ties of the permutation fall to doc_id and tokens
(repeated rows are interchangeable), an empty table gives an empty result, extra columns pass through.
"""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from velograph.llm.shared import settle, whole_text

#: Bits of the exponent, and how many of them one pass over the source table settles.
BITS, BITS_A_PASS = 30, 5
#: Rows of the largest source that share a bucket of a permutation's hash, or fewer; a bucket is a number of its hexadecimal digits.
BUCKET_ROWS, LEAST_DIGITS = 50_000, 2
OWN = ("tokens", "epoch", "block", "place")


def token_count(text: str = "text") -> Column:
    """Words of the text, one at least: every word with the space around it becomes one character."""
    return F.greatest(F.length(F.regexp_replace(whole_text(text), r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+", "x")), F.lit(1)).cast("long")


def source_table(docs: DataFrame) -> DataFrame:
    """(source, source_tokens, source_rows), written out, so that its size is known to the planner."""
    return settle(docs.groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.count(F.lit(1)).alias("source_rows")), "mix-sources")


def bucket_digits(rows: int) -> int:
    """Hexadecimal digits that deal rows out to buckets of BUCKET_ROWS."""
    return max(LEAST_DIGITS, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS, 16)))


def _grid(sources: DataFrame, total: int, budget: float, places: list[int]) -> dict[int, tuple[float, float]]:
    """Entropy and largest repetition at each exponent j / 2^BITS; one row for each place comes back."""
    a = F.col("j") / F.lit(float(1 << BITS))
    share = F.col("source_tokens") / F.lit(float(total))
    rows = (
        sources.select("source_tokens", F.explode(F.array(*map(F.lit, places))).alias("j"))
        .withColumn("u", F.pow(share, a))
        .groupBy("j")
        .agg(F.sum("u").alias("s"), F.sum(F.col("u") * F.log("u")).alias("v"), F.max(F.col("u") / F.col("source_tokens")).alias("m"))
        .collect()
    )
    return {r["j"]: (math.log(r["s"]) - r["v"] / r["s"], budget * r["m"] / r["s"]) for r in rows}


def solve_exponent(sources: DataFrame, total: int, budget: float | None = None, entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The exponent; entropy in nats. Without a budget, repetition counts against the least budget that covers all."""

    def bisect(holds_low: bool, test) -> int:
        base, shift = 0, BITS
        while shift:
            shift -= BITS_A_PASS
            places = [base + (m << shift) for m in range(1, 1 << BITS_A_PASS)]
            seen = _grid(sources, total, budget or float(total), places)
            base = max([base, *(j for j in places if test(*seen[j]) == holds_low)])
        return base

    found = [] if entropy is not None or max_repeats is not None else [1 << BITS]
    if entropy is not None:  # the largest place that still reaches the target
        found.append(bisect(True, lambda h, _: h >= entropy))
    if max_repeats is not None and budget is not None:  # one above the largest place that is over the limit
        found.append(bisect(False, lambda _, r: r <= max_repeats) + 1)
    elif max_repeats is not None:  # repeats are (p_max / p_min)^(1 - a) then
        most, least = sources.agg(F.max("source_tokens"), F.min("source_tokens")).first()
        spread = math.log(most / least)
        found.append((1 << BITS) if spread == 0 else math.ceil(max(0.0, 1 - math.log(max_repeats) / spread) * (1 << BITS)))
    return min(max(found), 1 << BITS) / (1 << BITS)


def weigh(sources: DataFrame, total: int, exponent: float, block_tokens: int, budget: float | None = None) -> DataFrame:
    """sources with weight, target (tokens of the stream) and quota (tokens a block)."""
    u = F.pow(F.col("source_tokens") / F.lit(float(total)), F.lit(exponent))
    s, most = sources.agg(F.sum(u), F.max(F.col("source_tokens") / u)).first()
    df = sources.withColumn("weight", u / F.lit(s))
    target = F.round(F.col("weight") * F.lit(float(budget if budget is not None else most * s))).cast("long")
    if budget is None:
        target = F.greatest(target, F.col("source_tokens"))
    return df.withColumn("target", target).withColumn("quota", F.greatest(F.round(F.col("weight") * float(block_tokens)).cast("long"), F.lit(1).cast("long")))


def named_rows(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """docs, and the columns that name each of its rows for good: its Parquet file and the place in it. What isn't read from Parquet
    as it is gets written first, as a number given to rows on their way need not be the same when a task runs again."""
    for rows in (docs, None):
        rows = settle(docs, "mix-docs") if rows is None else rows
        try:
            at = rows.metadataColumn("_metadata")
            rows.select(at["file_path"], at["row_index"])  # fails here if there is no such thing
            return rows, at["file_path"], at["row_index"]
        except AnalysisException:
            continue
    raise ValueError("rows can't be named")


def mix(docs: DataFrame, block_tokens: int = 1_000_000, budget_share: float | None = None, entropy_share: float | None = None, max_repeats: float | None = None, seed: int = 7, tokens: Column | None = None, in_order: bool = False) -> DataFrame:
    """docs (with source and doc_id), a row for each copy, with tokens, epoch, block and place (from 0 within the block).

    budget_share: tokens of the stream as a share of the corpus; entropy_share: target entropy as a share of that of
    even weights; in_order: blocks are dealt out to partitions in their order and sorted, so that files written follow the stream.
    """
    if clash := set(OWN) & set(docs.columns):
        raise ValueError(f"columns in the way: {sorted(clash)}")
    # rows are known by file and place in it, and whole rows join last, as one column, so that no other name can clash with these
    docs, file, at = named_rows(docs)
    whole = docs.select(F.struct(*docs.columns).alias("__row"), file.alias("__file"), at.alias("__at_row"))
    docs = settle(docs.select(file.alias("file"), at.alias("at_row"), "source", "doc_id", (token_count() if tokens is None else tokens).alias("tokens")), "mix-rows")
    sources = source_table(docs)
    total, n, most = sources.agg(F.sum("source_tokens"), F.count(F.lit(1)), F.max("source_rows")).first()
    if not n:
        return whole.select("__row.*", F.lit(1).cast("long").alias("tokens"), F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("place")).limit(0)
    budget = None if budget_share is None else float(round(budget_share * total))
    exponent = solve_exponent(sources, total, budget, None if entropy_share is None else entropy_share * math.log(n), max_repeats)
    weighed = settle(weigh(sources, total, exponent, block_tokens, budget).select(F.col("source").alias("__source"), "source_tokens", "target", "quota"), "mix-weights")
    rows = docs.join(weighed, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    last = F.floor((F.col("target") - 1) / F.col("source_tokens")).cast("int")
    rows = rows.filter("target > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.withColumn("__hash", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("doc_id").cast("string")).cast("binary")))
    rows = rows.withColumn("__bucket", F.substring("__hash", 1, bucket_digits(most)))
    key = ["source", "epoch", "__bucket"]
    ahead = F.sum("__sum").over(W.partitionBy("source", "epoch").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1))
    sized = rows.groupBy(*key).agg(F.sum("tokens").alias("__sum")).select(*[F.col(k).alias(f"{k}_r") for k in key], F.coalesce(ahead, F.lit(0)).alias("__ahead"))
    same = F.col("source").eqNullSafe(F.col("source_r")) & (F.col("epoch") == F.col("epoch_r")) & (F.col("__bucket") == F.col("__bucket_r"))
    within = F.sum("tokens").over(W.partitionBy(*key).orderBy("__hash", "doc_id", "tokens").rowsBetween(W.unboundedPreceding, -1))
    rows = rows.join(sized, same).withColumn("__at", F.col("epoch") * F.col("source_tokens") + F.col("__ahead") + F.coalesce(within, F.lit(0)))
    rows = rows.filter(F.col("__at") + F.col("tokens") <= F.col("target")).withColumn("block", F.floor(F.col("__at") / F.col("quota")).cast("long"))
    shuffled = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("block").cast("string"), F.col("epoch").cast("string"), F.col("doc_id").cast("string")).cast("binary"))
    place = F.row_number().over(W.partitionBy("block").orderBy("__order", "source", "doc_id", "tokens")).cast("long") - 1
    rows = rows.withColumn("__order", shuffled).withColumn("place", place).select("file", "at_row", *OWN)
    rows = rows.join(whole, (F.col("file") == F.col("__file")) & (F.col("at_row") == F.col("__at_row"))).select("__row", *OWN)
    if in_order:
        blocks = weighed.agg(F.max(F.floor((F.col("target") - 1) / F.col("quota")))).first()[0] + 1
        parts = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks)
        rows = rows.repartitionById(parts, F.floor(F.col("block") * parts / blocks).cast("int")).sortWithinPartitions("block", "place")
    return rows.select("__row.*", *OWN)


def oracle(block_tokens: int, budget_share: float, entropy_share: float, max_repeats: float, seed: int) -> str:
    """DuckDB SQL of mix()'s doc_id, source, tokens, epoch, block and place."""
    half = 1 << BITS
    measures = "ln(sum(u)) - sum(u * ln(u)) / sum(u) AS h, t.budget * max(u / source_tokens) / sum(u) AS r"
    step = lambda name, test: f"""{name} AS (  -- base, bit
  SELECT 0::BIGINT AS base, {BITS - 1} AS bit
  UNION ALL
  SELECT CASE WHEN {test} THEN base + (1::BIGINT << bit) ELSE base END, bit - 1
  FROM (SELECT x.base, x.bit, {measures}
        FROM {name} x, t, LATERAL (SELECT source_tokens, pow(source_tokens / t.total, (x.base + (1::BIGINT << x.bit)) / {half}.0) AS u FROM s) v
        WHERE x.bit >= 0 GROUP BY x.base, x.bit, t.budget, t.n) q, t)"""  # noqa: E731
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, source, greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1)::BIGINT AS tokens FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS source_tokens FROM d GROUP BY source),
t AS (SELECT sum(source_tokens)::DOUBLE AS total, count(*) AS n, round({budget_share} * sum(source_tokens))::DOUBLE AS budget FROM s),
{step("e", f"h >= {entropy_share} * ln(t.n)")},
{step("r", f"r > {max_repeats}")},
a AS (SELECT least(greatest((SELECT base FROM e WHERE bit = -1), (SELECT base + 1 FROM r WHERE bit = -1)), {half}) / {half}.0::DOUBLE AS a),
w AS (SELECT source, source_tokens, total, budget, pow(source_tokens / total, a) AS u FROM s, t, a),
q AS (SELECT source, source_tokens, round(u / sum(u) OVER () * budget)::BIGINT AS target, greatest(round(u / sum(u) OVER () * {block_tokens}.0)::BIGINT, 1) AS quota FROM w),
c AS (SELECT d.*, source_tokens, target, quota, unnest(range(0, (target - 1) // source_tokens + 1))::INT AS epoch FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source WHERE target > 0),
p AS (SELECT *, epoch * source_tokens + coalesce(sum(tokens) OVER (PARTITION BY source, epoch ORDER BY md5('{seed}|' || epoch || '|' || doc_id), doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM c),
b AS (SELECT *, pos // quota AS block FROM p WHERE pos + tokens <= target)
SELECT doc_id, source, tokens, epoch, block, (row_number() OVER (PARTITION BY block ORDER BY md5('{seed}|' || block || '|' || epoch || '|' || doc_id), source, doc_id, tokens) - 1)::BIGINT AS place FROM b
"""
