"""A corpus pipeline over the documents table, one operator per stage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import decontam, jaccard, mixing, tokens, toxicity
from tierline.llm.store import removed, saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    return toxicity.keep_ordinary(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one whose id names it.

    Five-word shingles and a similarity of 0.8, as near-duplicate stages take.
    Rows without an id, and documents without words, are all kept.
    """
    found = jaccard.op4_jaccard_join(spark, docs, words=5, percent=80) \
        .where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    kept = docs.join(found.hint("merge"), docs["doc_id"] == found["_id"], "left_anti")
    # Rows that repeat a doc_id and its text are copies too; ids are counted
    # apart from the texts, so the usual table without any moves no text.
    again = saved(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).count()
                  .where("count > 1").select("_id"), "pipeline_repeated")
    if again.isEmpty():
        return kept
    same = kept["doc_id"] == again["_id"]
    return kept.join(again, same, "left_anti").unionAll(
        kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a word inside an occurrence of a benchmark window; each is
    judged by its own text, whatever its id.  Rows without text stay."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order, as read back."""
    return tokens.op3_token_output(spark, docs)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies),
          ("decontamination", drop_contaminated), ("mixing", mix_sources), ("tokens", write_tokens)]

#: Classifier scores and token ids have no SQL form; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, saved(stage(spark, docs, sf_dir), f"pipeline_{name}")
        if at:
            removed(before)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
