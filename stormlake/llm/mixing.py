"""Mixing sources to target weights.

1. Targets: every source's share of all words by weight, but at most
   ``MOST_EPOCHS`` times its own words; what is cut goes to the others by weight.
2. Packing: a source's documents, in a fixed pseudorandom order, make one long
   run of words, cut into blocks of ``block`` words.
3. Drawing: the output is dealt into shards of ``shard_blocks`` slots; each shard
   draws multinomial counts of its sources from what is left of the quotas, so
   the totals meet the targets and no source passes its limit.
4. Mapping: a source's n-th drawn slot is taken from epoch n // blocks at place
   n % blocks of that epoch's pseudorandom permutation of its full blocks, the short last
   one after them (a keyed Feistel network: no list of blocks is ever shuffled or held).
   A source's last slot takes only as many words as its target still lacks.
5. Joining: slots meet the pieces of documents in their block by (source, block).

A source is never one task's work: its documents are ordered by hash ranges,
its slots and blocks are rows keyed by block number.

Defined results: a null or wordless text has size 0 and takes nothing; null is a
source of its own, last in order; equal rows (same id, source and size) are
taken one after another and get what falls on each; rows with a null id are
treated like others; an empty table gives an empty result; a corpus without
words has targets of 0.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import Stages, mix64, partitions, pick, table

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BLOCK = 64
SHARD_BLOCKS = 16384
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) -> (source, source_size, no, target).

    Resharing what is above a limit until nothing is comes to one level L with
    target = min(limit, L * weight).  With the sources in order of limit / weight,
    L is fixed by the first source whose limit lies above the level that remains
    when all before it stand at their limits.  One row a source is all that goes
    through these windows."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    sized = (sizes.withColumn("no", (F.row_number().over(order) - 1).cast("int"))
             .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                F.col("no") % len(weights) + 1))
             .withColumn("limit", (F.col("source_size") * most).cast("double")))
    by = W.orderBy(F.col("limit") / F.col("weight"), "no")
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ((F.sum(F.col("source_size").cast("double")).over(whole)
              - F.coalesce(F.sum("limit").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("weight").over(by.rowsBetween(0, W.unboundedFollowing)))
    at = sized.withColumn("level", level)
    fits = F.col("limit") / F.col("weight") >= F.col("level")
    fixed = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), F.col("no"), F.col("level")))).over(whole)
    return at.withColumn("fixed", fixed["level"]).select(
        "source", "source_size", "no",
        F.when(F.col("fixed").isNull(), F.col("limit"))
        .otherwise(F.least(F.col("limit"), F.col("fixed") * F.col("weight"))).alias("target"))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray, rounds: int = 6) -> np.ndarray:
    """index -> place of index in a pseudorandom permutation of 0..size-1 given
    by key.  A Feistel network over the next power of four, walked on until the
    value falls below size."""
    x, size, key = index.astype(np.uint64), size.astype(np.uint64), key.astype(np.uint64)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size.astype(float), 2)) / 2)).astype(np.uint64)
    mask = (_U(1) << half) - _U(1)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for r in range(rounds):
            left, right = right, left ^ (mix64(right ^ mix64(k + _U(r + 1))) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= size[todo]]
    return x.astype(np.int64)


def draw_counts(quota: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One row of source counts for every size: multinomial draws by the share
    of the quotas that is left; a draw beyond a quota is drawn again."""
    left, out = quota.copy(), np.zeros((len(sizes), len(quota)), np.int64)
    for i, n in enumerate(sizes):
        while n > 0 and left.sum() > 0:
            n = min(n, left.sum())
            got = np.minimum(rng.multinomial(n, left / left.sum()), left)
            out[i] += got
            left -= got
            n -= got.sum()
    return out


def _deal(groups: int, shard_blocks: int, seed: int):
    """mapInPandas: quotas of a run of slots -> counts by part.  groups > 0: split
    into that many parts of whole shards; 0: into shards."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                quota = np.asarray(r.quota, np.int64)
                total = int(quota.sum())
                shards = -(-total // shard_blocks)
                each = shard_blocks * (-(-shards // groups) if groups else 1)
                sizes = [min(each, total - i) for i in range(0, total, each)]
                got = draw_counts(quota, np.asarray(sizes, np.int64), np.random.default_rng([seed, int(r.first), groups]))
                starts = int(r.first) + np.concatenate([[0], np.cumsum(sizes)[:-1]]) if sizes else []
                yield pd.DataFrame({"first": np.asarray(starts, np.int64), "quota": [list(map(int, g)) for g in got]})
    return run


def draw_shards(quotas: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """quotas (no, slots, ...) by source -> shard, the quota's columns, slot, count:
    what each output shard takes of each source, and the number of its first slot
    there.  The quotas are split over groups of shards, as many as a group has shards, and each group is drawn
    in a task of its own; a row holds one number a source."""
    slots = quotas.agg(F.sum("slots")).first()[0] or 0
    groups = max(1, math.ceil(math.sqrt(slots / shard_blocks)))
    whole = quotas.agg(F.array_sort(F.collect_list(F.struct("no", "slots"))).alias("q")).select(
        F.lit(0).cast("long").alias("first"), F.col("q.slots").alias("quota"))
    schema = "first long, quota array<long>"
    parts = whole.mapInPandas(_deal(groups, shard_blocks, seed), schema).repartition(groups, "first")
    shards = parts.mapInPandas(_deal(0, shard_blocks, seed), schema)
    drawn = shards.select("first", F.posexplode("quota").alias("no", "count")).where("count > 0")
    before = W.partitionBy("no").orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    return (drawn.withColumn("slot", F.coalesce(F.sum("count").over(before), F.lit(0)))
            .join(quotas.drop("slots"), "no").withColumn("shard", F.floor(F.col("first") / shard_blocks)).drop("first"))


@F.pandas_udf(T.LongType())
def _block_of(epoch: pd.Series, place: pd.Series, full: pd.Series, no: pd.Series, seed: pd.Series) -> pd.Series:
    """The block at a place of an epoch; the ``full`` ones are permuted, a short one stays last."""
    at, n = place.to_numpy(np.int64), full.to_numpy(np.int64)
    key = mix64((no.to_numpy(np.uint64) << _U(32)) ^ epoch.to_numpy(np.uint64) ^ mix64(seed.to_numpy(np.uint64)))
    out, inner = at.copy(), at < n
    out[inner] = permute(at[inner], n[inner], key[inner])
    return pd.Series(out)


def mix(stages: Stages, rows: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, block: int = BLOCK,
        shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows: (doc_id, source, size).  Returns

    * docs: the rows with source_size, target, no (of the source), unit (names
      the row) and start (its first word's place in the source's run of words),
    * slots: (shard, no, slot, block, words, whole): the mix, block by block: how many of the
      block's words the slot takes, from its first, and whether these are all,
    * pieces: (unit, no, block, at, start, n): the words of a row in each block, from the block's word ``at``.
    """
    spark = rows.sparkSession
    n = partitions(spark)
    rows = stages.save(rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "rows")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).cast("long").alias("source_size"))
    aims = stages.save(targets(sizes, weights, most), "targets")
    # whole epochs take every block; what the target has more is taken to the word
    aimed = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0))
    quotas = stages.save(aims.withColumn("words", F.least(aimed, F.col("source_size") * most))
                         .withColumn("n_blocks", F.ceil(F.col("source_size") / block)).withColumn("epochs", epochs)
                         .select("no", "source_size", "words", "n_blocks", (F.col("epochs") * F.col("n_blocks") + F.ceil(
                             (F.col("words") - F.col("epochs") * F.col("source_size")) / block)).cast("long").alias("slots")), "quotas")

    hashed = (rows.join(aims, rows["source"].eqNullSafe(aims["source"])).drop(aims["source"])
              .withColumn("hash", F.shiftrightunsigned(F.xxhash64("doc_id", "source", "size", F.lit(seed)), 2))
              .withColumn("range", F.floor(F.col("hash") / F.lit((1 << 62) // n + 1)).cast("int")))
    hashed = stages.save(hashed, "order")
    words = F.col("size") * F.col("copies")
    before = (hashed.groupBy("no", "range").agg(F.sum(words).alias("words"))
              .select(F.col("no"), F.col("range"), F.coalesce(F.sum("words").over(
                  W.partitionBy("no").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("b")))
    inside = W.partitionBy("no", "range").orderBy("hash", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = (hashed.withColumn("i", F.coalesce(F.sum(words).over(inside), F.lit(0)))
              .join(before, ["no", "range"]).withColumn("run", F.col("b") + F.col("i")))
    docs = stages.save(placed.select(
        "doc_id", "source", "size", "source_size", "target", "no", "run",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
        .withColumn("start", F.col("run") + F.col("copy") * F.col("size"))
        .withColumn("unit", F.concat_ws(":", "no", "start", F.when(F.col("size") == 0, F.xxhash64("doc_id"))))
        .drop("run"), "docs")

    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = (docs.where("size > 0").select("unit", "no", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
              .withColumn("from", F.greatest(F.col("start"), F.col("block") * block))
              .withColumn("n", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.col("from"))
              .select("unit", "no", "block", (F.col("from") - F.col("block") * block).alias("at"),
                      (F.col("from") - F.col("start")).alias("start"), "n"))

    # dealt out before a row becomes many slots: the planner judges by bytes and would take few tasks
    slots = draw_shards(quotas, shard_blocks, seed).repartition(n, "no", "slot").select(
        "shard", "no", "n_blocks", "source_size", "words", F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("count") - 1)).alias("slot"))
    slots = slots.withColumns({"epoch": F.expr("slot div n_blocks"), "place": F.expr("slot % n_blocks")})
    left = F.col("words") - F.col("epoch") * F.col("source_size") - F.col("place") * block
    held = F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("place") * block)
    slots = slots.select("shard", "no", "slot", _block_of("epoch", "place", F.expr(f"source_size div {block}"), "no", F.lit(seed)).alias("block"),
                         F.least(left, held).alias("words"), (left >= held).alias("whole"))
    return docs, slots, pieces


def taken(docs: DataFrame, slots: DataFrame, pieces: DataFrame) -> DataFrame:
    """docs with ``taken``: the words of each row in the mix, repeats counted."""
    # a source has one slot that is not whole, at most
    times = slots.groupBy("no", "block").agg(F.count(F.when(F.col("whole"), 1)).alias("times"),
                                             F.coalesce(F.max(F.when(~F.col("whole"), F.col("words"))), F.lit(0)).alias("words"))
    part = F.greatest(F.lit(0), F.least(F.col("n"), F.col("words") - F.col("at")))
    # the planner can't see how many rows the slots are, and would broadcast them
    got = (pieces.join(times.hint("merge"), ["no", "block"]).groupBy("unit")
           .agg(F.sum(F.col("n") * F.col("times") + part).cast("long").alias("taken")))
    return docs.join(got.hint("merge"), "unit", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED,
                    **settings) -> DataFrame:
    """The rows of docs, with all their columns, as the mix takes them: each as
    many times as its words are taken, rounded without bias: the share s = taken /
    size gives floor(s + u) rows with u a fixed pseudorandom number in [0, 1) from
    id, source and size.  So a source keeps its target in words on average
    whatever the lengths of its texts.  Rows equal in id, source and size share
    their rounded total evenly."""
    stages = Stages(docs.sparkSession, "mix")
    rows = pick(docs, doc_id=key, source=source, size=words_in(docs[text]))
    got = taken(*mix(stages, rows, seed=seed, **settings)).where("size > 0")
    # 32 bits, so that share + u is exact enough to stay below the next whole number
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "source", "size"), 32) / F.lit(float(1 << 32))
    times = (got.groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("copies"))
             .withColumn("total", F.floor(F.col("taken") / F.col("size") + u)).where("total > 0"))
    times = stages.save(times.select(*[F.col(c).alias(f"_mix_{c}") for c in ("doc_id", "source", "size", "copies", "total")],
                                     F.monotonically_increasing_id().alias("_mix_no")), "times")

    def meet(times):
        # the same plan at every size: the rows are dealt out, not met by a broadcast while the table is small
        return docs.join(times.hint("merge"), docs[key].eqNullSafe(times["_mix_doc_id"]) & docs[source].eqNullSafe(times["_mix_source"])
                         & (words_in(docs[text]) == times["_mix_size"]))

    def repeat(here, n):
        return here.select(*[here[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(0), n.cast("int"))).alias("_mix_copy")).drop("_mix_copy")

    single, several = times.where("_mix_copies = 1"), times.where("_mix_copies > 1")
    if several.isEmpty():
        stages.keep(times)
        return repeat(meet(single), F.col("_mix_total"))
    # number the equal rows: dealt into parts, so that many of them are not one task's work
    n = partitions(docs.sparkSession)
    equal = stages.save(meet(several).select(*[docs[c] for c in docs.columns], "_mix_no", "_mix_copies", "_mix_total",
                                             F.monotonically_increasing_id().alias("_mix_row"))
                        .withColumn("_mix_part", F.pmod("_mix_row", F.lit(n))), "equal")
    stages.keep(times, equal)
    before = W.partitionBy("_mix_no").orderBy("_mix_part").rowsBetween(W.unboundedPreceding, -1)
    parts = equal.groupBy("_mix_no", "_mix_part").agg(F.count(F.lit(1)).alias("n")).select(
        "_mix_no", "_mix_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_before"))
    inside = W.partitionBy("_mix_no", "_mix_part").orderBy("_mix_row")
    placed = (equal.withColumn("_mix_inside", F.row_number().over(inside)).join(parts.hint("merge"), ["_mix_no", "_mix_part"])
              .withColumn("_mix_to", F.col("_mix_before") + F.col("_mix_inside")))
    share = F.expr("_mix_to * _mix_total div _mix_copies - (_mix_to - 1) * _mix_total div _mix_copies")
    return repeat(meet(single), F.col("_mix_total")).unionByName(repeat(placed, share))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = pick(docs, doc_id="doc_id", source="source", size=words_in(docs["text"]))
    return taken(*mix(Stages(spark, "mix"), rows)).select("doc_id", "size", "source_size", "target", "taken")
