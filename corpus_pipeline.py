"""The training-data pipeline: five stages over `documents`, each written as Parquet and read again as the next one's docs.

Rows go by id and text, so an id that stands for several texts is as many documents. Of exact copies a row without an id
goes where another row has one; near copies without an id can't be told apart and stay. Equal rows are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm.common import materialize, table
from threadloom.llm.decontam import remove_contamination
from threadloom.llm.exact_dedup import drop_exact_copies
from threadloom.llm.packing import pack_documents
from threadloom.llm.registry import tokenizer_path
from threadloom.llm.simhash import drop_near_copies
from threadloom.llm.toxicity import drop_toxic, learn_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return drop_toxic(docs, learn_toxicity(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (5-word shingles, Jaccard similarity 0.8) the row with the smallest doc_id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Test passages are cut out; a document of which nothing is left goes. n_chars follows the text."""
    from pyspark.sql import functions as F

    cleaned = remove_contamination(docs, table(spark, sf_dir, "benchmark"))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of up to 2048."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("simhash near-dedup", near), ("benchmark decontamination", decontamination), ("packing", packing)]

#: Models, fingerprints and token ids are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
