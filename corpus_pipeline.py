"""From raw documents to a mixed training set, in five stages.

Every stage works on all that the one before kept and returns the columns of documents;
the last adds tokens, pass and block.  No statement covers the whole: masking needs a
trained tagger, so ``ORACLE_SQL`` is None and the tests compare with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontaminate, mixing, neardup, privacy, quality_rules
from millrace.llm.shared import table
from millrace.session import scratch, scratch_path

ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the certified quality rules."""
    judged = quality_rules.apply(docs, table(spark, sf_dir, "labels"), name="__rules")
    return judged.filter("__rules.kept").select(*[f"`{c}`" for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the smallest id."""
    return neardup.keep_one(docs)


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark"), name="__leaks")
    return found.filter(F.size("__leaks.hits") == 0).select(*[f"`{c}`" for c in docs.columns])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return privacy.redact(docs, privacy.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per pass of their source's quota."""
    return mixing.mix(docs)


STAGES = [("quality rules", rules), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", test_items),
          ("personal data", personal_data), ("mixing", mixture)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage made on its way is deleted then."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
