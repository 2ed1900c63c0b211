"""The corpus pipeline: quality, near duplicates, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage
before it kept; between stages docs is written as Parquet and read again.
All but the last return the columns of documents: a document that the mix
takes twice is there twice, and the text of one that loses repeated
passages is what is left of it.

Odd rows, in every stage: an empty table gives no rows; a null text is treated as
an empty one; a null doc_id is no error; repeated rows are rows of their own where the stage doesn't
say otherwise; columns besides doc_id, text, source and n_chars pass through
unchanged whatever their names, but for the last stage, which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewgrid.llm import mixing, packing, quality, repeats, similarity
from crewgrid.llm.common import fold, shipped, table, unused, written


@shipped
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; trained on the labelled rows outside its held-out fold.

    Empty and null texts have features of 0 and are judged like any other; equal texts stay or go together; with an empty table or without labels
    nothing is trained and all is accepted."""
    wanted = quality.training_rows(table(spark, sf_dir, "labels"), ~F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)))
    wanted = written(wanted, "training")
    some = docs.select("doc_id", "text").join(F.broadcast(wanted.select("doc_id")), "doc_id", "left_semi")
    return quality.good_only(docs, quality.fit(quality.featured(some), wanted))


@shipped
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Texts without words (null, empty, blank) have no near duplicates and all stay; of repeated rows one stays; rows with a null id stay only
    where their group has no other."""
    return similarity.representatives(docs)


@shipped
def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in a document with a smaller id; n_chars is counted anew.

    Texts that lose nothing stay as they are, null ones too; a row with a null id loses nothing and takes nothing from others; rows of one id
    take nothing from each other."""
    return repeats.deduplicated(docs)


@shipped
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, none to three times.

    A null source is a source of its own; documents without words go by their place in the order like others; of equal rows so many are taken as
    the order says, whichever they are."""
    reps, copy = unused(docs, "reps", "copy")
    return mixing.mixed(docs, reps=reps).withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(reps)))).select(docs.columns)


@shipped
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences.

    A null or empty text is one piece, the end token; repeated rows are packed as often as they come."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("substring dedup", repeat_stage),
    ("mixing to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL can express neither the trained classifier nor best-fit packing; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage{i + 1}")
    return docs
