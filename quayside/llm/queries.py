"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .codes import compress
from .copies import mark_copies
from .counts import count_document_tokens
from .decontaminate import find_contamination
from .html import extract_text
from .licenses import scan_licenses
from .minhash import find_classes
from .mix import mix
from .oracle import OP2, OP4, OP11, OP12, OP13
from .pack import pack
from .phrases import collocations
from .quality import judge
from .shard import with_shards
from .store import table
from .substrings import remove_repeats


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, carry=["doc_id", "source"])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), carry=["doc_id", "source"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "source", "soft_failed", F.round("host_rate", 6).alias("host_rate"), "host_failed",
    )


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths are source/lang and the digits of doc_id but for its last two; every licensed document speaks for its directory."""
    docs = table(spark, sf_dir, "documents")
    digits = F.regexp_replace(F.expr("nullif(cast(doc_id div 100 as string), '0')"), "(.)(?=.)", "$1/")
    paths = docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", digits, F.col("doc_id").cast("string")).alias("path"))
    return scan_licenses(paths, speaks=F.lit(True), carry=["doc_id", "path"])


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("repeated"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_document_tokens(table(spark, sf_dir, "documents"))


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_shards(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op11_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"), carry=["vec_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pack, op2_decontaminate, op3_mix, op4_quality, op5_html, op6_minhash, op7_licenses, op8_substrings,
        op9_token_counts, op10_shard, op11_copies, op12_phrases, op13_codes,
    )
}
ORACLE: dict[str, str] = {
    "op2_decontaminate": OP2, "op4_quality": OP4, "op11_copies": OP11, "op12_phrases": OP12, "op13_codes": OP13,
}
