"""Corpus preparation as five stages, each written as Parquet and read again.

toxicity -> near duplicates -> benchmark decontamination -> surrogates -> packing

Every stage keeps all rows that it doesn't reject and, but for packing, all their
columns; columns beside doc_id, text and n_chars are never read, whatever their
names.  Rows equal in every column are rows of their own.  An empty table passes
every stage; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.decontaminate import decontaminate
from corpuslens.llm.near_dup import deduplicate
from corpuslens.llm.packing import pack
from corpuslens.llm.pii import pseudonymize
from corpuslens.llm.queries import SURROGATE_KEY, vocabulary
from corpuslens.llm.scratch import remove, shared_folder
from corpuslens.llm.toxicity import score, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores below one half.

    Null and empty texts have no clause and stay.  A label counts for every row
    of its doc_id; rows without a doc_id teach nothing and are scored like all
    others.  Equal texts have equal scores.  A column ``score`` of the input is
    kept as it was.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs.select("doc_id", "text"), labels)
    # Scored under a name of its own, so that the columns of the input stay as they are.
    scored = score(docs.withColumnRenamed("score", "_given_score"), model).filter(F.col("score") < 0.5).drop("score")
    return scored.withColumnRenamed("_given_score", "score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    Of a group the smallest doc_id stays.  Null and empty texts, and rows without
    a doc_id, are copies of nothing and stay; rows equal in doc_id and text are
    one document.
    """
    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts, on either side, match nothing; rows without a doc_id
    stay.  Of a doc_id with several texts all rows go if one of them holds an item.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the text.

    Null texts stay null, and their ``n_chars`` becomes null; texts without
    entities stay as they are.  Equal texts get equal surrogates.
    """
    given = docs.withColumnRenamed("entity_kinds", "_given_kinds")
    done = pseudonymize(given, SURROGATE_KEY).drop("entity_kinds").withColumnRenamed("_given_kinds", "entity_kinds")
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens.

    Null and empty texts hold the end id alone; ties in length keep the order of
    reading; long texts are cut.
    """
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("surrogates", surrogates), ("packing", packing)]

#: Toxicity, surrogates and tokens have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's folder goes when the next one is written, the last one's with the application."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
