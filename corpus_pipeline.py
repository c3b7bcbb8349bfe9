"""A training-corpus pipeline: five stages over ``documents``, each working on all that the one before kept.

Between stages the documents are written as Parquet to the shared folder and read again, and each begins
by giving back what the driver has freed.  Every stage takes null ids, texts, languages and sources, repeated rows, texts of any length, an empty
table, and further columns whatever their names; all but the last return the columns they get.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import decontaminate, mixing, near_dedup, shared, surrogates, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  A null or empty text has the odds of a text without
    words; equal texts share their fate."""
    shared.give_back(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one of smallest id (null ids come last,
    ties go by a name of the text).  Null and empty texts are equal, and so one class; of rows
    that repeat id and text one stays."""
    shared.give_back(spark)
    return near_dedup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go.  Null and empty texts have none; equal rows
    share their fate."""
    shared.give_back(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates; n_chars follows the new text.  No row goes; null texts
    stay null, equal texts stay equal."""
    shared.give_back(spark)
    return surrogates.with_surrogates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passes that the mix takes, in order of virtual finish time, and of a hash where times tie.
    Null sources are a source of their own; texts without words, null ones too, are never taken."""
    shared.give_back(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("mixing", mix_sources),
]

#: Hash sampling, trained weights and keyed permutations have no SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all stages.  What a stage has left in the shared folder goes when its rows are
    written; the last stage's rows are read from there, so its tables stay until ``shared.clean``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for number, (name, stage) in enumerate(STAGES):
        since = len(shared.FOLDERS)
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            path = shared.new_folder(spark, f"pipeline-{number}-{name}")
            docs.write.parquet(path)
            shared.clean(spark, since, keep=(path,))
            if before:
                shared.delete_path(spark, before)
                shared.FOLDERS.remove(before)
            docs, before = spark.read.parquet(path), path
    return docs
