"""Mixing sources to target weights: token shares raised to a bisected exponent, realised as budgeted block permutations.

The share p of a source becomes the weight p^a / sum(p^a): a = 1 leaves the shares, a = 0 makes sources equal. The
exponent is bisected over the table of source totals, five halvings to a job, so that either the entropy of the weights
meets `target_entropy` (nats; beyond what a in [0, 1] can give, the nearest end), or no source is repeated more than
`max_repetition` times, at the least exponent that allows it. Without a `budget` the budget is the least that takes
every document of every source at least once; with one, sources beyond their share are cut.

A source's documents stand in the order of a hash. Its budget takes whole passes over them and a last partial pass that
ends with the document that reaches the budget. Every block of the mix gets the same part of each source's budget, in
that order, and permutes its documents by another hash. Running token sums are taken within (source, hash range)
buckets of a few hundred rows, on top of summed-up bucket totals, so a hot source is spread over many tasks.

All steps are built-in functions. Defined cases: a null source is a source of its own; a text without a token (null and
empty ones too) takes part in no block; equal rows are taken each for itself and follow each other in any order; an
empty table gives an empty result; columns of the input that have the name of an output give way to it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import broadcast_if_small, written
from .text import without

MAX_REPETITION = 2.0
BLOCK_TOKENS = 1 << 18
BUCKET_ROWS = 500
#: Tokens of a file of a mix that is laid out by a value, about.
FILE_TOKENS = 1 << 23
_HALVINGS, _JOBS = 5, 8
_OUTPUTS = ("n_tokens", "copy", "block", "position")
_TEMPORARY = ("_q_hash", "_q_bucket", "_q_source", "_q_first", "_q_taken", "_q_order", "_q_buckets", "_q_tokens", "_q_budget", "_q_s", "_q_b")


def count_tokens(text: str) -> Column:
    """Runs of characters that are no ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0)).cast("long")


def source_totals(docs: DataFrame, source: str, tokens: Column) -> DataFrame:
    """source, tokens, documents and share of each source that has a token; written, since every later step reads it."""
    counted = docs.select(F.col(source).alias("source"), tokens.alias("n")).where("n > 0")
    return written(counted.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("documents")), "sources")


def _figures(sources: DataFrame, total: int, budget: float | None, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy and largest repetition for each exponent."""
    p = F.col("tokens") / F.lit(float(total))
    grid = sources.select(F.log(p).alias("l"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    rows = grid.groupBy("a").agg(
        F.sum(F.exp(F.col("a") * F.col("l"))).alias("z"),
        F.sum(F.exp(F.col("a") * F.col("l")) * F.col("l")).alias("zl"),
        F.max((F.col("a") - 1) * F.col("l")).alias("most"),
        F.min((F.col("a") - 1) * F.col("l")).alias("least"),
    )
    return {
        r.a: (
            math.log(r.z) - r.a * r.zl / r.z,
            math.exp(r.most - r.least) if budget is None else math.exp(r.most) / r.z * budget / total,
        )
        for r in rows.collect()
    }


def exponent(sources: DataFrame, *, max_repetition: float = MAX_REPETITION, target_entropy: float | None = None, budget: float | None = None) -> float:
    """The exponent in [0, 1] that meets the target, by bisection."""
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0

    def low_enough(figures: tuple[float, float]) -> bool:
        """Whether the exponent need not grow."""
        return figures[0] <= target_entropy if target_entropy is not None else figures[1] <= max_repetition * (1 + 1e-12)

    ends = _figures(sources, total, budget, [0.0, 1.0])
    if low_enough(ends[0.0]):
        return 0.0
    if not low_enough(ends[1.0]):
        if target_entropy is None:
            raise ValueError(f"the budget repeats every source {ends[1.0][1]:.3g} times")
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(_JOBS):
        steps = 1 << _HALVINGS
        grid = [low + (high - low) * k / steps for k in range(1, steps)]
        figures = _figures(sources, total, budget, grid)
        good = [a for a in grid if low_enough(figures[a])]
        high = min(good, default=high)
        low = max((a for a in grid if a < high), default=low)
    return high


def plan(sources: DataFrame, a: float, budget: float | None = None) -> DataFrame:
    """source, tokens, documents, weight and budget (whole tokens) of each source."""
    p = F.col("tokens").cast("double")
    scale = sources.agg(F.max(F.log(p)), F.sum("tokens")).first()
    top, total = scale[0] or 0.0, scale[1] or 0
    powered = F.exp(F.lit(a) * (F.log(p) - F.lit(top)))
    z = sources.agg(F.sum(powered)).first()[0] or 1.0
    # Without a budget: the largest tokens / weight, so that each source is taken whole at least once.
    least = sources.agg(F.max(p / powered)).first()[0] or 0.0
    spent = least * z if budget is None else float(budget)
    weight = powered / F.lit(z)
    return sources.select("source", "tokens", "documents", weight.alias("weight"), F.round(weight * F.lit(spent)).cast("long").alias("budget"))


def mix(
    docs: DataFrame, *, source: str = "source", key: str = "doc_id", text: str = "text", tokens: Column | None = None,
    max_repetition: float = MAX_REPETITION, target_entropy: float | None = None, budget: float | None = None,
    block_tokens: int = BLOCK_TOKENS, carry: list[str] | None = None, positions: bool = True,
    files_by: Column | None = None, file_values: int = 1,
) -> DataFrame:
    """A row for each taken copy of a document: the columns `carry` (default: all), n_tokens, copy, block and position.

    copy counts the passes over a source from 0. With positions=False the rows come in the order of their blocks and
    permutations within each file written, and have no position. `files_by`, an integer below `file_values`, then deals
    them out: a file holds rows of one value, and of two files of a value the one with the lower part number holds the
    earlier blocks.
    """
    base = without(docs, (*_OUTPUTS, *_TEMPORARY))
    carry = base.columns if carry is None else carry
    tokens = count_tokens(text) if tokens is None else tokens
    sources = source_totals(base, source, tokens)
    a = exponent(sources, max_repetition=max_repetition, target_entropy=target_entropy, budget=budget)
    planned = written(plan(sources, a, budget), "mix")
    blocks = max(1, -(-(planned.agg(F.sum("budget")).first()[0] or 0) // block_tokens))
    by_source = broadcast_if_small(
        planned.select(
            F.col("source").alias("_q_source"), F.col("tokens").alias("_q_tokens"), F.col("budget").alias("_q_budget"),
            F.ceil(F.col("documents") / BUCKET_ROWS).alias("_q_buckets"),
        )
    )
    hashed = F.xxhash64(F.col(source), F.col(key))
    bucket = F.pmod(F.shiftrightunsigned("_q_hash", 20), F.col("_q_buckets"))

    def dealt(columns: list[str]) -> DataFrame:
        rows = base.select(*columns, tokens.alias("n_tokens"), hashed.alias("_q_hash")).where("n_tokens > 0")
        return rows.join(by_source, F.col(source).eqNullSafe(F.col("_q_source"))).withColumn("_q_bucket", bucket)

    totals = dealt([source]).groupBy(F.col("_q_source").alias("_q_s"), F.col("_q_bucket").alias("_q_b")).agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("_q_s").orderBy("_q_b").rowsBetween(Window.unboundedPreceding, -1)
    firsts = written(totals.withColumn("_q_first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "buckets")
    within = Window.partitionBy("_q_source", "_q_bucket").orderBy("_q_hash", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt(list(dict.fromkeys([*carry, source]))).withColumn("_q_taken", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    rows = rows.join(broadcast_if_small(firsts), F.col("_q_source").eqNullSafe(F.col("_q_s")) & (F.col("_q_bucket") == F.col("_q_b")))
    start = F.col("_q_first") + F.col("_q_taken")
    full = F.expr("_q_budget div _q_tokens")
    copies = full + F.when(start < F.expr("_q_budget % _q_tokens"), 1).otherwise(0)
    copied = rows.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1)).otherwise(F.array().cast("array<bigint>"))))
    at = (F.col("copy") * F.col("_q_tokens") + start) / F.col("_q_budget")
    out = copied.withColumn("block", F.least(F.floor(at * blocks), F.lit(blocks - 1)).cast("long"))
    out = out.withColumn("_q_order", F.xxhash64("_q_hash", "copy", "block"))
    if not positions and files_by is not None:
        cuts = max(1, -(-blocks * block_tokens // (file_values * FILE_TOKENS)))
        part = (files_by * cuts + F.least(F.lit(cuts - 1), F.floor(F.col("block") * cuts / blocks))).cast("int")
        laid = out.repartitionById(file_values * cuts, part).sortWithinPartitions("block", "_q_order")
        return laid.select(*carry, "n_tokens", "copy", "block")
    if not positions:
        return out.repartition("block").sortWithinPartitions("block", "_q_order").select(*carry, "n_tokens", "copy", "block")
    place = Window.partitionBy("block").orderBy("_q_order", "copy", "n_tokens")
    return out.withColumn("position", F.row_number().over(place) - 1).select(*carry, "n_tokens", "copy", "block", "position")
