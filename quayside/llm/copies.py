"""Exact duplicates by splitting off the heavy hitters.

Texts are equal when they are identical after each run of ASCII white space has become one space; SHA-256 of the
normalised UTF-8 bytes stands for the text. The digests are written once, so that no later pass reads the texts. A
Misra-Gries summary (Spark's mergeable frequent-items sketch) finds the frequent digests, in `SUMMARIES` hash ranges, so
that no task merges the summaries of the whole table. What the summary names is counted exactly: the digests that really
hold one row in `HEAVY_SHARE` or more, at most `HEAVY_SHARE` of them, are the verified heavy hitters. Their winners are
broadcast and decide every copy's row where it lies, without a shuffle. All other digests are shuffled in the ordinary
way; such a group holds less than one row in `HEAVY_SHARE`, or slightly more where the summary has overlooked it, which
costs time and no row.

All expressions are built-in functions.

Defined cases: a null text counts as empty; the row with the smallest key stays, null keys come last; of rows with the
same text and the same key exactly one stays, the first in the order of the input's partitions; an empty table gives an
empty result; columns of the input that have the name of an output give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import checkpointed, written
from .text import without

#: A digest is heavy if it holds one row in so many; so many winners at most are broadcast.
HEAVY_SHARE = 4096
#: Hash ranges with a summary of their own, and the counters of each.
SUMMARIES, COUNTERS = 64, 1024
_OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")
_TEMPORARY = ("_q_sha", "_q_row", "_q_first", "_q_size")
# one space by itself is left alone, which spares most of the replacements
_BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BLANKS, " ")


def _hash(sha: str) -> Column:
    return F.xxhash64(sha)


def frequent(digests: DataFrame, least: int) -> DataFrame:
    """`item`: hashes of the digests that the summaries count `least` times or more; SUMMARIES * COUNTERS at most."""
    items = digests.select(_hash("_q_sha").alias("item"))
    summaries = items.groupBy(F.pmod("item", F.lit(SUMMARIES))).agg(
        F.expr(f"approx_top_k(item, {COUNTERS}, {COUNTERS})").alias("top")
    )
    return summaries.select(F.inline("top")).where(F.col("count") >= least).select("item")


def winners(digests: DataFrame, least: int) -> DataFrame:
    """(_q_sha, _q_first, _q_size) of the digests that occur `least` times or more by exact count.

    Groups are aggregated before they move, however many copies they hold.
    """
    named = F.broadcast(frequent(digests, least))
    found = digests.join(named, _hash("_q_sha") == F.col("item"), "left_semi").groupBy("_q_sha")
    return found.agg(F.min("_q_first").alias("_q_first"), F.count("*").alias("_q_size")).where(F.col("_q_size") >= least)


def mark_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """Every row with keep_id, group_size, kept and text_sha256; `carry` names the input's columns to keep, all by default."""
    sha = F.unhex(F.sha2(normalised(F.col(text)), 256))
    rows = docs.select("*", sha.alias("_q_sha"), F.monotonically_increasing_id().alias("_q_row"))
    first = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("_q_row").alias("row"))
    plain = without(docs, _OUTPUTS + _TEMPORARY).columns
    columns = [c for c in plain if carry is None or c in carry]
    rows = rows.select(*[F.col(f"`{c}`") for c in columns], "_q_sha", "_q_row", first.alias("_q_first"))
    digests = written(rows, "digests")
    # groups of one row are no copies, whatever their share of a small table is
    least = max(2, -(-digests.count() // HEAVY_SHARE))
    heavy = F.broadcast(checkpointed(winners(digests, least)))
    in_place = digests.join(heavy.withColumnRenamed("_q_first", "_q_winner"), "_q_sha")
    rest = digests.join(heavy, "_q_sha", "left_anti").selectExpr(
        "*", "min(_q_first) over (partition by _q_sha) _q_winner", "count(*) over (partition by _q_sha) _q_size"
    )
    return in_place.unionByName(rest).select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_q_winner.key").alias("keep_id"),
        F.col("_q_size").alias("group_size"),
        (F.col("_q_winner.row") == F.col("_q_row")).alias("kept"),
        F.lower(F.hex("_q_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, in the input's columns (less those named as an output)."""
    marked = mark_copies(docs, text, key)
    return marked.where("kept").drop(*_OUTPUTS)
