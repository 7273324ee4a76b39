"""A corpus pipeline in five stages: quality, exact copies, near copies, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs; all but the last return the columns of documents.

Every stage: a null text counts as empty, texts of any length are taken whole, an empty table gives an empty one, and further
columns, whatever their names, are carried along (packing returns columns of its own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiforge.llm._shared import read_table, stored
from lexiforge.llm.exact_dedup import drop_copies
from lexiforge.llm.mixing import take_mix
from lexiforge.llm.near_text import drop_near_copies
from lexiforge.llm.packing import pack, tokenizer_path
from lexiforge.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Nulls and empty texts are scored like others; an id that stands in several rows goes only if each of its rows is rejected.
    """
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (runs of white space count as one space).

    The smallest doc_id stays, a null one last; of rows with that id the one whose columns come first in order.
    """
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash within two bits, or five-word shingles alike by 0.8 or more.

    Links join, so that a chain of copies is one group; the smallest doc_id stays, a null one last, then the first row.
    """
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: none to three times; wordless ones never.

    Sources sort by code point, a null one last; of rows that agree in id and size any may stand for the others.
    """
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places in training sequences; repeated rows are documents like others."""
    return pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]
#: SQL has no tokenizer and no trained classifier; tests/llm/test_pipeline.py holds run() against the stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
