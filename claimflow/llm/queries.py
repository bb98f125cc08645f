"""The training-data operators as queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from claimflow.llm import (
    collocations, dac, licenses, line_join, line_rules, mixing, packing, passages, revisits, runs, shingle_join, topk, wrappers,
)
from claimflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_directly_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token ids of all documents as directly addressable codes and describe what is read back."""
    path = scratch_path(spark, "dac")
    dac.write_dac(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    rows = dac.read_dac(spark, path).select(
        "part", "segment", "doc_id", "start_in_segment", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    starts = dac.segment_starts(spark.read.parquet(path).select("part", "segment", "n_tokens"))
    return rows.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("start") + F.col("start_in_segment")).alias("start"), "n_tokens", "ids_crc32"
    )


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens: where each piece went."""
    packed = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024
    )
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3, ... of all words, none beyond three times its own: words taken per document."""
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents"), mixing.cyclic_weight, most=3))


@query
def op3_line_first_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text and the verdict of line-first cleaning."""
    rules = line_rules.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept"]
    return rules.select("doc_id", *[f"rules.{c}" for c in counts])


SQL["op3_line_first_cleaning"] = line_rules.SQL


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that have an earlier line of similarity 0.8 or more."""
    gone = line_join.removed_lines(table(spark, sf_dir, "documents"))
    return gone.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and number of links of every document, by 5-word shingles and a similarity of 0.8."""
    links = shingle_join.link_documents(table(spark, sf_dir, "documents"))
    return links.select("doc_id", "class_id", "n_links")


@query
def op6_norm_sorted_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every hundredth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


@query
def op1_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages of 50 words or more that an earlier document has too."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op2_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits among captures of all pages, with the response each stands for."""
    records = revisits.captures_of(table(spark, sf_dir, "pages"))
    lines = F.transform("headers", lambda h: F.concat(h["key"], F.lit(": "), h["value"]))
    return revisits.resolve_revisits(records).withColumn("headers", F.array_join(lines, "\n"))


SQL["op2_revisit_resolution"] = revisits.SQL


@query
def op7_wrapper_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the wrapper of its host."""
    return wrappers.extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, once a tenth of the documents has been given a repeated tail."""
    return runs.digest(runs.periodic_runs(runs.with_repeated_tails(table(spark, sf_dir, "documents"))))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of 2 to 4 words of each language."""
    return collocations.top_per_language(collocations.collocations(table(spark, sf_dir, "documents")), most=2000)


SQL["op12_collocations"] = collocations.SQL


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and licence texts in every document."""
    return licenses.summary(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
