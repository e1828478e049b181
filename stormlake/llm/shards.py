"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every shard draws a score for the key, ``-ln(u) / weight`` with ``u`` taken from
md5(key ':' shard), and the smallest score wins.  A shard's score does not
depend on the other shards, so one more shard takes rows only into itself, and
a shard of weight w holds a share w / sum(w) of the keys.  Only DataFrame
functions are used.

Defined results: a null key is the key ``''``; a null text has no bytes, size
16 and the crc of the empty string; repeated rows land in the same shard and
take slots of their own; an empty table gives an empty result; columns of the
input other than the ones named are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Stages, partitions, pick, table

SHARDS = 40
ROW_BYTES = 16


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0-based) that wins ``key``; ``weights`` has one positive weight a shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("rendezvous() needs at least one shard, all of positive weight")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = []
    for shard, weight in enumerate(weights):
        # 52 bits of md5, so that the fraction is exact in a double
        drawn = F.conv(F.substring(F.md5(F.concat(text, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("double")
        u = (drawn + F.lit(0.5)) / F.lit(float(1 << 52))
        scores.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*scores))["shard"]


def with_slots(stages: Stages, df: DataFrame, shard: str, slot: str) -> DataFrame:
    """Number the rows of every shard from 0 without a gap, in the order of the
    md5 of their values.

    The md5's leading digits cut a shard into ranges, so no task numbers a whole
    shard; equal rows are one row with a count until the end, so that repeated
    rows spread as well as others.  The numbering does not depend on how many
    ranges there are.
    """
    cols = df.columns
    n = partitions(df.sparkSession)
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    lead = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rows = stages.save(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
                       .withColumn("_hash", F.md5(F.concat_ws(":", *values)))
                       .withColumn("_range", F.floor(lead * F.lit(n)).cast("int")), "slots")
    before = (rows.groupBy(shard, "_range").agg(F.sum("_copies").alias("_rows"))
              .select(F.col(shard).alias("_s"), F.col("_range").alias("_r"),
                      F.coalesce(F.sum("_rows").over(W.partitionBy(shard).orderBy("_range")
                                                     .rowsBetween(W.unboundedPreceding, -1)),
                                 F.lit(0)).alias("_before")))
    inside = W.partitionBy(shard, "_range").orderBy("_hash", *cols).rowsBetween(W.unboundedPreceding, -1)
    first = (rows.withColumn("_inside", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
             .join(before, (F.col(shard) == F.col("_s")) & (F.col("_range") == F.col("_r")))
             .withColumn("_first", F.col("_before") + F.col("_inside")))
    return first.select(*cols, F.explode(F.sequence(
        F.col("_first"), F.col("_first") + F.col("_copies") - 1)).alias(slot))


def shard_table(df: DataFrame, key: str, text: str, shards: int = SHARDS,
                weights: list[float] | None = None) -> DataFrame:
    """One row a record: key, size, text_crc32, law, shard, slot in the shard,
    and the shard with one more shard of weight 1."""
    weights = weights or [1.0] * shards
    if len(weights) != shards:
        raise ValueError(f"{len(weights)} weights for {shards} shards")
    stages = Stages(df.sparkSession, "shards")
    body = F.encode(F.coalesce(df[text], F.lit("")), "UTF-8")
    rows = pick(df, key=key, size=(F.octet_length(body) + ROW_BYTES).cast("long"), text_crc32=F.crc32(body))
    old = rendezvous(F.col("key"), weights)
    new = rendezvous(F.col("key"), [*weights, 1.0])
    rows = rows.withColumn("shard", old).withColumn("grown_shard", new)
    out = with_slots(stages, rows, "shard", "slot")
    return out.select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"),
                      "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, key: str, path: str, shards: int = SHARDS,
                 weights: list[float] | None = None, shard: str = "shard") -> None:
    """Write the records as Parquet under ``path/shard=N``; a shard too large
    for one task is split by the planner's rebalance."""
    placed = df.withColumn(shard, rendezvous(df[key], weights or [1.0] * shards))
    placed.hint("rebalance", shard).write.mode("overwrite").partitionBy(shard).parquet(path)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(table(spark, sf_dir, "documents"), "doc_id", "text")



OP6_SQL = """
WITH RECURSIVE steps AS (SELECT range AS b, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, CAST(len(h) // 2 + 16 AS BIGINT) AS size, xor(list_reduce(
    [4294967295] || [('0x' || substr(h, 2 * i - 1, 2))::BIGINT FOR i IN range(1, len(h) // 2 + 1)],
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, tab),
s AS (SELECT doc_id, i, -ln((CAST(('0x' || substr(md5(doc_id::VARCHAR || ':' || i), 1, 13))::BIGINT AS DOUBLE) + 0.5::DOUBLE)
    / 4503599627370496::DOUBLE) AS score FROM documents, range(41) r(i)),
w AS (SELECT doc_id, arg_min(i, score) FILTER (WHERE i < 40) AS shard, arg_min(i, score) AS grown_shard FROM s GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws(':', doc_id, size, text_crc32, shard, grown_shard))) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM c JOIN w USING (doc_id)
"""
