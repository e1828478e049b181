"""From raw documents to sharded training data.

Five stages, each a function (spark, docs, sf_dir) -> DataFrame that works on all
its predecessor kept; between stages the rows are written as Parquet and read
again.  All but the last return the columns of ``documents``:

1. quality        rows whose text the additive model scores below 0.7 go
2. near_duplicates one row of each class of near-duplicates (five-word shingles,
                  similarity of 0.8 or more) stays: the one with the smallest id
3. decontaminate  rows that hold ten benchmark words in a row go
4. mix            rows appear as often as the mix of sources takes them
5. shard          every row gets its shard and its place there

Defined results: a null text is an empty one; a text without words is left out by the mix at the latest,
as it has no words to take; texts are taken whole, however long; of rows with words that repeat a text the one with
the smallest id stays (a null id is an id like others); an empty table gives an empty result; columns
beyond those of ``documents``, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormlake.llm import decontaminate, jaccard_join, mixing, quality, shards
from stormlake.llm.common import Stages, pick, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = pick(table(spark, sf_dir, "labels"), doc_id="doc_id", quality="quality")
    return quality.keep_good(docs, labels)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, pick(table(spark, sf_dir, "benchmark"), item_id="item_id", text="text"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.shard_table(docs, "doc_id", "text")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("mix", mixing_stage),
    ("shard", sharding_stage),
]

#: A model fitted on labels can't be given as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        after = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return after
        after = stages.save(after, name)
        if i:
            stages.drop(docs)
        docs = after
    return docs
