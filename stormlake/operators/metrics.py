"""Binary classification metrics as aggregates (AG12 P/R/F1, AG13 AUC, AG14 confusion).

Everything is a grouped aggregate, so the metrics of many runs or cities are
one job: pass their identifying columns as ``group_cols``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlake.session import materialize


def _ratio(num, den):
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   group_cols: list[str] | None = None) -> DataFrame:
    """AG12: precision, recall, F1 of class 1 (0/0 -> 0)."""
    g = group_cols or []
    y, p = F.col(label) == 1, F.col(prediction) == 1
    c = df.groupBy(*g).agg(
        F.sum((y & p).cast("long")).alias("tp"),
        F.sum((~y & p).cast("long")).alias("fp"),
        F.sum((y & ~p).cast("long")).alias("fn"))
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn"))
    return c.select(*g, prec.alias("precision"), rec.alias("recall"), f1.alias("f1_score"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            group_cols: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """AG13: exact ROC AUC by the rank-sum (Mann-Whitney) formula, ties at half.

    Ranks need a global order of the scores: the distinct scores, with their counts, are
    dealt into ``parts`` by range (default: the shuffle partitions) and written once; a window over the parts'
    counts (one row a part and group) gives each part's first rank, and ranks
    inside a part come from a window over it.  Tied rows share the average rank.  One class -> null.
    """
    g = group_cols or []
    d = df.select(*g, F.col(label).alias("__y"), F.col(score).cast("double").alias("__s"))
    per = d.where(F.col("__s").isNotNull()).groupBy(*g, "__s").agg(
        F.count(F.lit(1)).alias("__n"), F.sum((F.col("__y") == 1).cast("long")).alias("__pos"))
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = materialize(per.repartitionByRange(parts, *g, "__s").withColumn("__b", F.spark_partition_id()))
    tot = per.groupBy(*g, "__b").agg(F.sum("__n").alias("__bn"))
    wb = Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("__bbelow", F.coalesce(F.sum("__bn").over(wb), F.lit(0))).drop("__bn")
    ws = Window.partitionBy(*g, "__b").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__below", F.coalesce(F.sum("__n").over(ws), F.lit(0)))
    per = per.join(tot, on=[*g, "__b"], how="left")
    rank = ((F.col("__bbelow") + F.col("__below")).cast("double")
            + (F.col("__n") + 1) / F.lit(2.0))
    t = per.groupBy(*g).agg(
        F.sum(F.col("__pos") * rank).alias("__rsum"),
        F.sum("__pos").alias("__np"),
        (F.sum("__n") - F.sum("__pos")).alias("__nn"))
    return t.select(*g, auc_of("__rsum", "__np", "__nn").alias("auc_roc"))


def auc_of(rank_sum: str, positives: str, negatives: str):
    """The rank-sum formula in doubles: products of counts pass 64 bits."""
    p, n = F.col(positives).cast("double"), F.col(negatives).cast("double")
    auc = (F.col(rank_sum) - p * (p + 1) / F.lit(2.0)) / (p * n)
    return F.when((p > 0) & (n > 0), auc)


def confusion_matrix(spark_df: DataFrame, label: str = "label", prediction: str = "prediction",
                     group_cols: list[str] | None = None) -> DataFrame:
    """AG14: counts on the full 2 x 2 spine (absent cells are 0)."""
    g = group_cols or []
    counts = spark_df.groupBy(*g, label, prediction).agg(F.count(F.lit(1)).alias("count"))
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"))
                                for a in (0, 1) for b in (0, 1)]))
    keys = spark_df.select(*g).distinct() if g else spark_df.sparkSession.range(1).select()
    spine = keys.select(*g, cells.alias("__c")).select(*g, "__c.actual", "__c.predicted")
    c = counts.withColumnsRenamed({label: "actual", prediction: "predicted"})
    return (spine.join(c, on=[*g, "actual", "predicted"], how="left")
                 .withColumn("count", F.coalesce("count", F.lit(0)).cast("long")))
