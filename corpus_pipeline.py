"""A corpus from raw documents: each stage works on all rows that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.llm import bpe, jaccard, packing, quality, secrets, toxicity
from termweave.llm.queries import ADDED
from termweave.llm.shared import ship, stage

import public_tokenizers  # noqa: E402, I001  behind the package that may be left out

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MASK = "[secret]"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the rules accept.

    Null and empty texts have too few words and go. Repeated rows are judged alike, each by itself;
    ids play no part and may be null.
    """
    ship(spark)
    return quality.judged(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


def toxicity_grades(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose severity is that of a text that isn't toxic.

    Learns from the labelled documents among those that are left. Without toxic and other labels all
    stay, and so do null and empty texts. Repeated rows are graded alike; null ids have no label.
    """
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model, COLUMNS).where("not toxic").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each class of similar documents the one with the smallest id, once.

    A document is its id and its text: of an id with several texts only those go that are in a class
    with another that stays. Of equal ids in a class the text with the smallest hash stays. Documents
    without an id stay; so do null and empty texts, which are similar to nothing, once for each id.
    """
    ship(spark)
    docs = docs.select(*COLUMNS).withColumn("_hash", F.xxhash64("text"))
    whole = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "_hash"))
    classes = jaccard.classes(docs.select(whole.alias("key"), "text"), id="key")
    gone = stage(classes.where("key <> component_id").select("key.*").distinct())
    kept = docs.join(gone, ["doc_id", "_hash"], "left_anti")
    once = kept.where("doc_id is not null").dropDuplicates(["doc_id", "_hash"])
    return once.union(kept.where("doc_id is null")).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with secrets in its text masked.

    Null and empty texts stay as they are; repeated rows are masked alike; ids may be null.
    """
    ship(spark)
    found = secrets.scanned(docs, tuple(c for c in COLUMNS if c != "text"), "text", MASK)
    length = F.when(F.size("spans") > 0, F.char_length("masked").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).withColumnRenamed("masked", "text").select(*COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and the sequences that they are packed into.

    Null and empty texts are a piece of the end id alone. Repeated rows are documents of their own;
    ids may be null.
    """
    ship(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.sequences(docs, bpe.Bpe(ranks), added=ADDED)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity_grades", toxicity_grades),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("sequence_packing", sequence_packing),
]
#: Expectation-maximisation, regression, character models and the packing aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs)
    return docs
