"""A corpus pipeline of five stages: clean, remove repeated lines, keep one of near copies, mix, pack.

Each stage takes (spark, docs, sf_dir), works on all documents it is given and returns a DataFrame; `run` writes it as
Parquet to the shared folder and reads it again as the next stage's documents. All but the last stage return the
columns of `documents`.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import line_join, line_rules, mixing, packing, shingle_join
from claimflow.session import freeze, scratch_tables
from claimflow.sources.files import delete

TOKENIZER, END_ID, CAPACITY = public_tokenizers.path("byte_bpe_50k.json"), 2, 1024


REMEMBERED = 1 << 17  # pieces of text a worker keeps the ids of; the stages before leave less memory than packing alone has

_scratch: dict[tuple, list[tuple[int, str]]] = {}


def stage_of(number: int):
    """Marks a stage. When it starts, the tables that earlier stages of the run wrote for themselves are deleted.

    The result of an earlier stage has been written and read again by then; tables that `docs` still reads stay.
    """

    def mark(fn):
        @functools.wraps(fn)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            made = _scratch.setdefault((spark.sparkContext.applicationId, sf_dir), [])
            used = docs.inputFiles()
            for entry in [e for e in made if e[0] < number and not any(e[1] in f for f in used)]:
                delete(spark, entry[1])
                made.remove(entry)
            with scratch_tables() as paths:
                out = fn(spark, docs, sf_dir)
            made += [(number, p) for p in paths]
            return out

        return run_stage

    return mark


def with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    """The given columns, with another text and its number of characters."""
    changed = docs.withColumn("text", text)
    return changed.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


@stage_of(1)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without the lines that fail."""
    # Stored before it is filtered: the optimiser copies the rules' long expressions into a filter above them without end.
    rules = line_rules.clean_lines(docs).drop("text")
    text = F.when(F.col("rules.kept"), F.col("rules.text"))  # null for documents that go
    judged = freeze(rules.select(*[f"`{c}`" for c in docs.columns if c != "text"], text.alias("text")), "judged")
    return with_text(judged.where("text IS NOT NULL"), F.col("text"), docs.columns)


@stage_of(2)
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line is like."""
    return with_text(line_join.remove_lines(docs), F.col("text"), docs.columns)


@stage_of(3)
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return shingle_join.one_per_group(docs)


@stage_of(4)
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row per document and pass, with the text that its blocks take in that pass."""
    return mixing.mixed_documents(docs, mixing.cyclic_weight, most=3)


@stage_of(5)
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each row went in sequences of 1024 tokens, and its token ids."""
    packed = packing.pack(docs, TOKENIZER, END_ID, CAPACITY, remembered=REMEMBERED)
    return packed.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

# Similarity joins, seeded draws and packing are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
