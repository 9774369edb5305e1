"""The corpus pipeline: stages in order, each on what the one before kept.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the
last return the columns of ``docs``.  Between stages the rows are written as Parquet and read
again, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontaminate, language, ngram_join, pieces, pii
from starloom.llm.batches import Scratch

#: Hits of benchmark items shorter than a window decide only where they are this share of a text's words.
SHORT_ITEM_SHARE = 0.5


def _whole(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct beside id and text, so that no column of a stage can clash with one of theirs."""
    return docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language go, those without a letter; mixed ones stay, and all do where no language could be learned."""
    model = language.train(language.train_fold(docs.select("doc_id", "text", "lang")))
    if not model.languages:
        return docs
    return language.identify(_whole(docs), model).where(F.col("lang_pred") != language.UNKNOWN).select("_row.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each_group(docs, Scratch(spark))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a whole window of benchmark words in a row, or consist of shorter items to ``SHORT_ITEM_SHARE``."""
    marked = decontaminate.mark_contaminated(_whole(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    long, short = F.col("longest_hit") >= decontaminate.WINDOW, F.col("n_hit") >= SHORT_ITEM_SHARE * F.col("n_words")
    return marked.where(~(F.col("contaminated") & (long | short))).select("_row.*")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; ``n_chars`` follows the text where it changed."""
    clean = pii.redact(_whole(docs))
    values = {c: F.col(f"_row.{c}") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col("_row.text"))
        values["n_chars"] = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return clean.select(*[values[c].alias(c) for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each text, their digest, and whether they decode to the text."""
    coded = pieces.coded(docs.select("doc_id", "text"))
    return coded.select(
        "doc_id", "text", "n_pieces", "ids_sha256", F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"), "ids"
    )


STAGES = [
    ("language_id", identified),
    ("ngram_join", distinct_texts),
    ("decontamination", uncontaminated),
    ("pii", redacted),
    ("pieces", encoded),
]

#: Not expressible in SQL: the language model is learned.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.keep(docs)
    return docs
