"""A corpus pipeline: rules, line dedup, near-dedup, mixing and packing of the documents."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfolio.llm import line_quality, line_templates, mixing, near_dedup, packing
from dayfolio.llm.common import DOCUMENT_COLUMNS, read_table
from dayfolio.session import shared_folder


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their failing lines; rejected documents go.

    A null or empty text has no words and is rejected. Repeated rows and null
    ids are judged each by its text, texts of any length whole; nothing ties.
    An empty table stays empty; columns besides those of documents go.
    """
    judged = line_quality.assess_quality(docs.select(*DOCUMENT_COLUMNS), prefix="_q_")
    return _with_text(judged.filter("_q_kept"), "_q_clean_text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs across documents stay in the first document alone; all documents stay.

    The first is the one with the smallest id; rows that repeat an id are one
    document, and lines of a row without an id neither count nor go. A null
    text becomes empty. Lines of any length are compared whole. An empty table
    stays empty; columns besides those of documents go.
    """
    return _with_text(line_templates.drop_recurring_lines(docs.select(*DOCUMENT_COLUMNS)), "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays.

    It is the row with the smallest id; rows without an id, or whose id comes
    twice, come after all others and are told apart by their columns, so of
    equal rows one stays too. A null or empty text is like nothing and stays.
    Texts of any length are compared whole. An empty table stays empty; columns
    besides those of documents go.
    """
    rows = near_dedup.with_row_ids(docs.select(*DOCUMENT_COLUMNS), "__row")
    kept = near_dedup.near_duplicates(rows, id_col="__row").filter("kept").select("__row")
    return rows.join(kept, "__row", "left_semi").select(*DOCUMENT_COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source of its own. A document without words, so also a
    null text, is taken 0 times. Rows that agree in id, source and number of
    words are told apart by a hash of all columns, so reruns agree. Texts of any
    length count whole. An empty table stays empty; columns besides those of
    documents go.
    """
    return mixing.take_mix(docs.select(*DOCUMENT_COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and the sequences they lie in.

    A null or empty text is its end id alone; a text longer than a sequence is
    cut. Repeated rows are packed each; pieces of one length are dealt by id,
    start and content. An empty table gives no pieces.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Sketches and rounding hash with functions that SQL engines do not share; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each is written as Parquet to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
