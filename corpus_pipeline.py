"""From raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.llm import line_dedup, mixing, packing, quality, simhash
from visitfold.llm.common import WORD, prepared, settle
from visitfold.llm.queries import byte_bpe

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are.

    Null, empty and blank texts have no words and go. Repeated rows are judged alike; an empty
    table stays empty, here and in the other stages.
    """
    prepared(spark)
    return quality.quality(docs).where("kept").select("doc.*")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; those that lose their last word go.

    ``n_chars``, where the table has it, follows the text. A text that loses nothing stays as
    it is, also one that is null or has no words. Rows equal in doc_id and text are treated
    alike; null ids come last.
    """
    found = line_dedup.drop_repeated_lines(docs)
    left = found.where(~F.col("changed") | F.col("text").rlike(WORD))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        whole = F.col("doc.n_chars")
        new["n_chars"] = F.when(F.col("changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(whole)
    return left.select(*[new.get(name, F.col(f"doc.`{name}`")).alias(name) for name in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id, a null one last.

    Shingle length and most differing bits are those of the operator: three words, two bits.
    Null, empty and blank texts have one fingerprint, so one of them stays. Of rows equal in
    doc_id and text one stays.
    """
    prepared(spark)
    return simhash.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled within its shards.

    A null source is a source, the last one. Texts without words have no size and are taken
    as the mix takes others of their block. Rows equal in doc_id and text share their fate.
    """
    return mixing.mix(docs).select("doc.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their tokens, and their places in sequences.

    A null text is packed like an empty one, as its closing token; repeated rows are packed as
    often as they are there.
    """
    prepared(spark)
    pieces = packing.cut_pieces(docs.select("doc_id", "text"), byte_bpe())
    rows = pieces.select(F.col("doc.doc_id").alias("doc_id"), "piece", "start", "length", "ids")
    return packing.pack(rows)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# No SQL: the rules rest on suffix arrays, packing on byte-pair tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents below ``sf_dir``; each stage's rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
