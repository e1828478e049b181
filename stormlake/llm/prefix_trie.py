"""Trie of conversation prefixes, from composable fingerprints.

Every conversation is rebuilt as the head of a base conversation followed by its own
turns after its head.  No rebuilt text is made:

1. A turn's value is 128 bits of the md5 of role and text.  A run of turns has the
   fingerprint v = sum of value * B^(turns after it) modulo 2^127 - 1; with its length it is an
   element of a monoid: (n1, v1)(n2, v2) = (n1 + n2, v1 * B^n2 + v2).
   Turns are put in order by range, each part multiplies up its own turns, and what the parts
   before give to a conversation that crosses them (one a part at most) is multiplied in after.
2. The prefix of a rebuilt conversation is the product of the base's head and of the own
   suffix: with P the products of the conversation's own turns and h the length of its head,
   base(h) * B^(j - h) + P(j) - P(h) * B^(j - h) for its own turn j.
3. A node of the trie is a (depth, fingerprint); conversations are counted by it.  The
   fingerprint of the node above comes from dividing the last turn out.
4. Equality is verified: a node's prefixes must agree in the node above and in the
   last turn's value, and where a node has turns of several conversations, each kept as a
   reference (conversation, value), the texts behind the references are
   compared.  If any differ, all is done again with other values.
5. Sums over subtrees: a node's value is written at its smallest member's place, and sums
   along a conversation from its end give what it adds to each node it passes.

Defined results: a null role or text is an empty one; turns without a number come first; turns of
one number come in the order of role and md5; rows without a conv_id take no part; rows that
repeat are turns of their own; a conversation whose head and suffix are empty is a member of the
root only; without conversations there are no nodes; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Stages, partitions, pick, table

SPAN = 100
HEADS = 6
MODULUS = 2 ** 127 - 1
BASE = 0x5DEECE66D1B54A32D192ED03A1F3C7B9 % MODULUS
_INVERSE = pow(BASE, -1, MODULUS)
_HALF, _LOW = 1 << 63, (1 << 64) - 1
_NODE = ["depth", "f1", "f2"]


def _value(d1: int, d2: int) -> int:
    return ((d1 + _HALF) << 64 | (d2 + _HALF)) % MODULUS


def _number(f1: int, f2: int) -> int:
    return f1 << 64 | (f2 + _HALF)


def _longs(values: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return (np.fromiter((v >> 64 for v in values), np.int64, len(values)),
            np.fromiter(((v & _LOW) - _HALF for v in values), np.int64, len(values)))


def head_of(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def turns_of(rows: DataFrame, salt: int) -> DataFrame:
    """rows(conv_id, turn, role, text) -> conv_id, turn, role, text, d1, d2 (the turn's value), chars."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = rows.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    digest = F.md5(F.concat(F.lit(str(salt) if salt else ""), F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    half = lambda at: (F.conv(F.substring("m", at, 16), 16, 10).cast("decimal(20,0)") - F.lit(str(_HALF)).cast("decimal(20,0)")).cast("long")
    return (rows.withColumn("m", digest).withColumn("d1", half(1)).withColumn("d2", half(17))
            .withColumn("chars", F.char_length("text").cast("long")).drop("m"))


# --- products of own turns ---------------------------------------------------

def _multiply(batches):
    """Rows in order -> the products of each conversation's turns in this part."""
    from pyspark import TaskContext
    part, last, n, p = TaskContext.get().partitionId(), None, 0, 0
    for pdf in batches:
        places, products = [], []
        for c, d1, d2 in zip(pdf["conv_id"].tolist(), pdf["d1"].tolist(), pdf["d2"].tolist(), strict=True):
            if c != last:
                last, n, p = c, 0, 0
            n, p = n + 1, (p * BASE + _value(d1, d2)) % MODULUS
            places.append(n)
            products.append(p)
        p1, p2 = _longs(products)
        yield pd.DataFrame({"part": part, "conv_id": pdf["conv_id"], "j": places, "d1": pdf["d1"], "d2": pdf["d2"],
                            "chars": pdf["chars"], "p1": p1, "p2": p2})


def _carry(pdf: pd.DataFrame) -> pd.DataFrame:
    """The parts of one conversation -> the turns and the product before each."""
    pdf, n, p, rows = pdf.sort_values("part"), 0, 0, []
    for part, turns, p1, p2 in zip(pdf["part"], pdf["n"].tolist(), pdf["p1"].tolist(), pdf["p2"].tolist(), strict=True):
        rows.append((n, p))
        n, p = n + turns, (p * pow(BASE, turns, MODULUS) + _number(p1, p2)) % MODULUS
    b1, b2 = _longs([x[1] for x in rows])
    return pd.DataFrame({"part": pdf["part"], "conv_id": pdf["conv_id"], "before": [x[0] for x in rows], "b1": b1, "b2": b2})


def _join_products(batches):
    for pdf in batches:
        products = [(_number(p1, p2) + _number(b1, b2) * pow(BASE, j, MODULUS)) % MODULUS for p1, p2, b1, b2, j in zip(
            *(pdf[c].tolist() for c in ("p1", "p2", "b1", "b2", "j")), strict=True)]
        p1, p2 = _longs(products)
        yield pdf[["conv_id", "d1", "d2", "chars"]].assign(j=pdf["j"] + pdf["before"], p1=p1, p2=p2)


_OWN = "conv_id long, j long, d1 long, d2 long, chars long, p1 long, p2 long"


def products(stages: Stages, turns: DataFrame) -> DataFrame:
    """turns -> conv_id, j (from 1), d1, d2, chars, p1, p2: the product of the conversation's turns 1..j."""
    order = ["conv_id", "turn", "role", "d1", "d2"]
    parts = stages.save(turns.select(*order, "chars").repartitionByRange(partitions(turns.sparkSession), *order)
                        .sortWithinPartitions(*order).mapInPandas(_multiply, f"part int, {_OWN}"), "parts")
    ends = parts.groupBy("part", "conv_id").agg(F.max("j").alias("n"), F.max_by(F.struct("p1", "p2"), "j").alias("p"))
    ends = ends.select("part", "conv_id", "n", "p.*")
    crossing = ends.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where(F.col("parts") > 1).select("conv_id")
    # parts that go on with the conversation of the part before: one row a part at most
    carried = stages.save(ends.join(crossing, "conv_id", "left_semi").groupBy("conv_id").applyInPandas(
        _carry, "part int, conv_id long, before long, b1 long, b2 long").where(F.col("before") > 0), "carried")
    first = parts.join(F.broadcast(carried), ["part", "conv_id"], "left_anti").drop("part")
    later = parts.join(F.broadcast(carried), ["part", "conv_id"]).mapInPandas(_join_products, _OWN)
    return first.unionByName(later)


# --- rebuilt conversations ---------------------------------------------------

def conversations(own: DataFrame) -> DataFrame:
    """One row a conversation: h, n own turns, hb head turns that the base has, the base's
    head turns, the own product at h (o1, o2) and the base's at hb (b1, b2)."""
    turn = F.when(F.col("j") < HEADS, F.struct("j", "d1", "d2", "chars", "p1", "p2"))
    each = own.groupBy("conv_id").agg(F.max("j").alias("n"), F.array_sort(F.collect_list(turn)).alias("head"))
    each = each.withColumn("h", head_of(F.col("conv_id")))
    base = each.where(F.col("conv_id") % SPAN == 0).select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    both = each.withColumn("base", F.col("conv_id") - F.col("conv_id") % SPAN).join(base, "base", "left")
    kept = F.coalesce(F.slice("base_head", F.lit(1), F.col("h")), F.slice("head", 1, 0))
    at_h = F.try_element_at("head", F.when(F.col("h") > 0, F.col("h")))
    at_hb = F.try_element_at("kept", F.when(F.size("kept") > 0, F.lit(-1)))
    none = {"1": F.lit(0), "2": F.lit(-_HALF)}  # the empty product
    part = lambda x, k: F.coalesce(x[f"p{k}"], none[k].cast("long"))
    return both.withColumn("kept", kept).select(
        "conv_id", "base", "h", "n", F.size("kept").alias("hb"), "kept",
        *[part(at_h, k).alias(f"o{k}") for k in "12"], *[part(at_hb, k).alias(f"b{k}") for k in "12"])


def _fingerprints(batches):
    for pdf in batches:
        found, above = [], []
        for p1, p2, d1, d2, o1, o2, b1, b2, k in zip(*(pdf[c].tolist() for c in (
                "p1", "p2", "d1", "d2", "o1", "o2", "b1", "b2", "k")), strict=True):
            f = (_number(p1, p2) + (_number(b1, b2) - _number(o1, o2)) * pow(BASE, k, MODULUS)) % MODULUS
            found.append(f)
            above.append((f - _value(d1, d2)) * _INVERSE % MODULUS)
        (f1, f2), (u1, u2) = _longs(found), _longs(above)
        yield pdf[["conv_id", "depth", "ref", "d1", "d2", "chars", "last"]].assign(f1=f1, f2=f2, u1=u1, u2=u2)


_ENTRY = ("conv_id long, depth long, ref long, d1 long, d2 long, chars long, last boolean, "
          "f1 long, f2 long, u1 long, u2 long")


def prefixes(own: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a prefix of a rebuilt conversation: its fingerprint (f1, f2), that without its last
    turn (u1, u2), and the last turn's value, length and reference."""
    zero = [F.lit(v).cast("long").alias(c) for c, v in (("o1", 0), ("o2", 0), ("b1", 0), ("b2", 0))]
    head = convs.select("conv_id", "base", "h", "n", "hb", F.explode("kept").alias("t")).select(
        "conv_id", F.col("t.j").alias("depth"), F.col("base").alias("ref"), "t.d1", "t.d2", "t.chars", "t.p1", "t.p2",
        ((F.col("t.j") == F.col("hb")) & (F.col("n") <= F.col("h"))).alias("last"), *zero, F.lit(0).cast("long").alias("k"))
    after = F.col("j") - F.col("h")
    tail = own.join(convs.drop("kept"), "conv_id").where(F.col("j") > F.col("h")).select(
        "conv_id", (F.col("hb") + after).alias("depth"), F.col("conv_id").alias("ref"), "d1", "d2", "chars", "p1", "p2",
        (F.col("j") == F.col("n")).alias("last"), "o1", "o2", "b1", "b2", after.alias("k"))
    return head.unionByName(tail).mapInPandas(_fingerprints, _ENTRY)


def nodes_of(entries: DataFrame) -> DataFrame:
    same = [c for c in ("u1", "u2", "d1", "d2", "chars")]
    agree = [F.min(c).eqNullSafe(F.max(c)) for c in same]
    every = agree[0]
    for a in agree[1:]:
        every = every & a
    return entries.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"),
        F.min("u1").alias("u1"), F.min("u2").alias("u2"), every.alias("agree"),
        (F.min("ref") != F.max("ref")).alias("several"))


def verified(turns: DataFrame, entries: DataFrame, nodes: DataFrame) -> bool:
    """Nodes are right: prefixes of a node agree in the node above and the last turn's value, and the texts
    behind the references of a value that nodes hold together are equal."""
    if nodes.where(~F.col("agree")).limit(1).count():
        return False
    asked = (entries.join(nodes.where("several"), _NODE, "left_semi").select(F.col("ref").alias("conv_id"), "d1", "d2").distinct())
    texts = turns.select("conv_id", "d1", "d2", "role", "text").join(asked, ["conv_id", "d1", "d2"], "left_semi")
    differ = texts.groupBy("d1", "d2").agg(((F.min("role") != F.max("role")) | (F.min("text") != F.max("text"))).alias("differ"))
    return not differ.where("differ").limit(1).count()


# --- sums, members and the trie ----------------------------------------------

def _running(stages: Stages, rows: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """Add ``before_<value>``: the sum over all rows before this one in order, in parts by range."""
    parts = stages.save(rows.repartitionByRange(partitions(rows.sparkSession), *order).withColumn("_part", F.spark_partition_id()), "running")
    sums = parts.groupBy("_part").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    over = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a part
    sums = sums.select("_part", *[F.coalesce(F.sum(f"_{v}").over(over), F.lit(0)).alias(f"_{v}") for v in values])
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = parts.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{v}") for v in values])
    return out.join(sums, "_part").select(*rows.columns, *[(F.col(f"_in_{v}") + F.col(f"_{v}")).alias(f"before_{v}") for v in values])


def subtree_sums(stages: Stages, entries: DataFrame, values: DataFrame) -> DataFrame:
    """values(conv_id, depth, saved, leaf), at each node's smallest member -> per node n_leaves, saved_tokens."""
    rows = entries.select("conv_id", *_NODE).join(values, ["conv_id", "depth"], "left").fillna(0, ["saved", "leaf"])
    run = stages.save(_running(stages, rows, ["conv_id", "depth"], ["saved", "leaf"]), "sums")
    ends = run.groupBy("conv_id").agg(*[F.max(F.col(f"before_{v}") + F.col(v)).alias(f"end_{v}") for v in ("saved", "leaf")])
    return run.join(ends, "conv_id").groupBy(*_NODE).agg(
        F.sum(F.col("end_leaf") - F.col("before_leaf")).alias("n_leaves"),
        F.sum(F.col("end_saved") - F.col("before_saved")).alias("saved_tokens"))


def _listed(batches):
    """Rows in order of (node, conv_id) -> the ids of each node in a batch, as text."""
    for pdf in batches:
        keys = pdf[_NODE].to_numpy(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])) if len(pdf) else np.zeros(0, np.int64)
        ids = pdf["conv_id"].tolist()
        edges = [*new.tolist(), len(ids)]
        yield pdf.iloc[new].rename(columns={"conv_id": "first"}).assign(
            ids=[",".join(map(str, ids[a:b])) for a, b in zip(edges[:-1], edges[1:], strict=True)])


def _hashed(batches):
    """Pieces in order of (node, first) -> one hash a node; holds the hash of one node."""
    node, state = None, None
    for pdf in batches:
        done = []
        for *key, ids in zip(*(pdf[c].tolist() for c in _NODE), pdf["ids"], strict=True):
            if key != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=[*_NODE, "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=[*_NODE, "ends_sha256"])


def ends_of(ends: DataFrame) -> DataFrame:
    """ends(depth, f1, f2, conv_id) -> per node the hash of its sorted ids.  Ids go to text in parts by
    range first, so a node with very many sends few rows to the task that hashes it."""
    n = partitions(ends.sparkSession)
    by = [*_NODE, "conv_id"]
    pieces = (ends.select(*by).repartitionByRange(n, *by).sortWithinPartitions(*by)
              .mapInPandas(_listed, "depth long, f1 long, f2 long, first long, ids string"))
    return (pieces.repartition(n, *_NODE).sortWithinPartitions(*_NODE, "first")
            .mapInPandas(_hashed, "depth long, f1 long, f2 long, ends_sha256 string"))


def prefix_trie(stages: Stages, rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text) -> one row a node."""
    for salt in count():
        turns = turns_of(rows, salt)
        own = products(stages, turns)
        convs = stages.save(conversations(own), "conversations")
        entries = stages.save(prefixes(own, convs), "prefixes")
        nodes = stages.save(nodes_of(entries), "nodes")
        if verified(turns, entries, nodes):
            break
    up = nodes.select((F.col("depth") - 1).alias("depth"), F.col("u1").alias("f1"), F.col("u2").alias("f2"))
    children = up.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(*_NODE, F.col("conv_id").alias("above"))
    full = nodes.join(children, _NODE, "left").fillna(0, ["n_children"]).select(
        *_NODE, "u1", "u2", "conv_id", "n_convs", "n_children", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("leaf"))
    full = stages.save(full, "trie")
    sums = subtree_sums(stages, entries, full.select("conv_id", "depth", "saved", "leaf"))
    empty = convs.where((F.col("hb") == 0) & (F.col("n") <= F.col("h")))
    root_key = [F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("f1"), F.lit(-_HALF).cast("long").alias("f2")]
    ends = ends_of(entries.where("last").select(*_NODE, "conv_id").unionByName(empty.select(*root_key, "conv_id")))
    zero = F.lit(0).cast("long").alias("depth")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where(F.col("n_convs") > 0)
    below = full.agg(F.count(F.when(F.col("depth") == 1, 1)).alias("n_children"), F.greatest(F.coalesce(F.sum("leaf"), F.lit(0)), F.lit(1)).alias("n_leaves"),
                     F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    root = top.select("*", zero).join(below.select("*", zero), "depth").select(
        *root_key, "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")
    child = full.withColumns({"p_depth": F.col("depth") - 1}).alias("n")
    parent = parents.unionByName(top.select(*root_key, F.col("conv_id").alias("above"))).alias("p")
    placed = child.join(parent, (F.col("p_depth") == F.col("p.depth")) & (F.col("u1") == F.col("p.f1")) & (F.col("u2") == F.col("p.f2"))).select(
        "n.depth", "n.f1", "n.f2", "n.conv_id", F.col("above").alias("parent_conv_id"), "n_convs", "n_children")
    out = placed.join(sums, _NODE).unionByName(root).join(ends, _NODE, "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations")
    return prefix_trie(Stages(spark, "prefix-trie"), pick(t, conv_id="conv_id", turn="turn", role="role", text="text"))


OP13_SQL = """
WITH RECURSIVE steps AS (SELECT range AS b, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
t AS (SELECT conv_id, coalesce(text, '') AS x, strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '') AS rx, turn,
    coalesce(role, '') AS role FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'m': md5(rx), 'n': length(x)} ORDER BY turn NULLS FIRST, role, md5(rx)) AS l FROM t GROUP BY conv_id),
heads AS (SELECT conv_id, l, xor(list_reduce([4294967295::BIGINT] || [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT FOR i IN range(1, length(conv_id::VARCHAR) + 1)],
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h FROM own, tab),
built AS (SELECT c.conv_id, coalesce(b.l, [])[1:c.h] || c.l[c.h + 1:] AS l FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefix AS (SELECT conv_id, d AS depth, md5(array_to_string([x.m FOR x IN l[1:d]], ',')) AS f,
    CASE WHEN d > 0 THEN md5(array_to_string([x.m FOR x IN l[1:d - 1]], ',')) END AS u, CASE WHEN d > 0 THEN l[d].n ELSE 0 END AS chars, len(l) = d AS last
  FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM built)),
node AS (SELECT depth, f, min(u) AS u, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM prefix GROUP BY depth, f),
kids AS (SELECT depth - 1 AS depth, u AS f, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
full_ AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * chars AS saved FROM node n LEFT JOIN kids USING (depth, f)),
sums AS (SELECT a.depth, a.f, sum(b.saved) AS saved_tokens, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves
  FROM prefix a JOIN full_ b ON b.conv_id = a.conv_id AND b.depth >= a.depth GROUP BY a.depth, a.f)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_ n JOIN sums USING (depth, f) LEFT JOIN node p ON p.depth = n.depth - 1 AND p.f = n.u
"""
