"""N-gram Jaccard join by chosen paths.

Documents are sets of hashed shingles of ``SHINGLE`` words; documents with equal sets
are one set with a number of copies.  Each set is embedded as ``COORDS`` minimum hashes.

1. Paths.  A run splits all sets by one coordinate's value.  A node of more than
   ``BUCKET`` sets is split again: a hash of the node samples coordinates (``BRANCH``
   on average), and a set goes to one child for each, named by its value there;
   so two sets share a child with probability their similarity for each
   sampled coordinate.  Nodes of one set end.  Small nodes are compared by brute force on
   the embedded sets, with a threshold far enough below the similarity wanted.  A large
   node is held against its head (its first set) before it is split: where most sets look
   similar to the head, as in a group of near copies, splitting would not part them.
   Such a node ends there: its sets near the head are tied to it, one comparison each,
   and only the others are compared, with all sets of the node.  So do the nodes of
   ``DEPTH`` levels.  A node of at most ``LOCAL`` blocks is split, by the same rule, in
   the task that compares its sets; larger ones by a shuffle a level.
   More than ``NODE_BLOCK`` sets of an ended node are compared in blocks against
   blocks, each pair of blocks a group of its own.  Runs are repeated
   until a pair at that similarity has been together with probability ``RECALL``.
2. Clusters.  The pairs found tie sets into clusters (of each node's pairs, a
   spanning forest is enough).  No pair list is ever made.
3. Links.  In each cluster, true similarities are counted on the whole shingle
   sets, in blocks of ``BLOCK`` sets against blocks; every set's links are summed up and
   linked sets are tied into classes.

Defined results: words are runs of ASCII letters (A-Z lowered), digits and
characters beyond ASCII; a text of one to four words is one shingle; a null, empty or
wordless text has no shingles, links with nothing and is a class of its own; rows
that repeat id and text are copies of each other; a null id is the largest when the smallest id of
a class is taken; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stages, chunks, mix64, partitions, pick, small_batches, table
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
COORDS = 64
BUCKET = 512
BRANCH = 1.5
DEPTH = 6
RECALL = 0.995
BLOCK = 512
NODE_BLOCK = 2048
LOCAL = 4

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_MULTIPLIERS = mix64(np.arange(1, 65, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


# --- shingles and embeddings ------------------------------------------------

class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int):
        if len(cls.up) < n:
            n = max(n, 1 << 20)
            run = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _U(b))]), dtype=np.uint64)
            cls.up, cls.down = run(_BASE), run(pow(_BASE, -1, 1 << 64))
        return cls.up, cls.down


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    up, down = _Powers.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64, out=sums[1:])
    word = np.concatenate([[False], _IS_WORD[data], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    words = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    if len(words) >= width:
        n = len(words) - width + 1
        rolled = np.zeros(n, np.uint64)
        for i in range(width):
            rolled += words[i:i + n] * _U(pow(_BASE, i + 1, 1 << 64))
        rolled = mix64(rolled)
    else:
        rolled = np.zeros(0, np.uint64)
    first = np.searchsorted(start, np.cumsum(size) - size)
    last = np.searchsorted(start, np.cumsum(size))
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            short = words[a:b] * mix64(np.arange(1, b - a + 1, dtype=np.uint64))
            out.append(mix64(short.sum(keepdims=True) + _U(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def embed(tokens: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """``coords`` minimum hashes of a set."""
    out = np.full(coords, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(tokens), 4096):
        np.minimum(out, (tokens[None, lo:lo + 4096] * _MULTIPLIERS[:coords, None]).min(1), out=out)
    return (out >> _U(32)).astype(np.uint32)


def _pieces(pdf, rows: int = 256):
    """(first row, last row + 1, their texts as bytes): a few texts at a time."""
    for at in range(0, len(pdf), rows):
        texts = [t.encode("utf-8", "replace") if t else b"" for t in pdf["text"].iloc[at:at + rows]]
        for lo, hi in chunks(texts):
            yield at + lo, at + hi, texts[lo:hi]


def _sets_of(coords: int):
    def run(batches):
        for pdf in batches:
            for lo, hi, texts in _pieces(pdf):
                sets = shingle_sets(texts)
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].astype("Int64").iloc[lo:hi].to_numpy(), "text_hash": pdf["text_hash"].to_numpy()[lo:hi],
                    "sid": [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets],
                    "size": [len(s) for s in sets], "sketch": [embed(s, coords).tobytes() if len(s) else None for s in sets],
                }).astype({"doc_id": "Int64"})
    return run


# --- paths ------------------------------------------------------------------

def runs_for(recall: float, similarity: float = SIMILARITY, branch: float = BRANCH, depth: int = DEPTH) -> int:
    """Runs after which a pair at the similarity has met in a node of ``depth``
    levels with the given probability: in a run it passes the first split with
    probability ``similarity`` and then survives a branching process with
    about Poisson(branch * similarity) common children."""
    dies = 0.0
    for _ in range(depth - 1):
        dies = math.exp(branch * similarity * (dies - 1))
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity * (1 - dies)))


def _matrix(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint32).reshape(len(sketches), -1)


def _child(node: np.ndarray, coord, value: np.ndarray) -> np.ndarray:
    return mix64(node ^ mix64((np.asarray(coord, np.uint64) << _U(32)) | value.astype(np.uint64)))


def _roots(runs: int):
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            m = _matrix(pdf["sketch"])
            nodes = [_child(np.full(len(m), mix64(np.asarray([r + 1], np.uint64))[0]), r % m.shape[1], m[:, r % m.shape[1]])
                     for r in range(runs)]
            yield pd.DataFrame({"node": np.concatenate(nodes).view(np.int64), "set_no": np.tile(pdf["set_no"].to_numpy(), runs)})
    return run


def children(node: np.ndarray, m: np.ndarray, branch: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child): the children that each row of sketches goes to from its node."""
    coords = mix64(np.arange(101, 101 + m.shape[1], dtype=np.uint64))
    row, coord = np.nonzero(mix64(node[:, None] ^ coords[None, :]) < _U(int(branch / m.shape[1] * 2.0 ** 64)))
    return row, _child(node[row], coord, m[row, coord])


def _branches(branch: float):
    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), 8192):
                part = pdf.iloc[lo:lo + 8192]
                row, child = children(part["node"].to_numpy(np.int64).view(np.uint64), _matrix(part["sketch"]), branch)
                yield pd.DataFrame({"node": child.view(np.int64), "set_no": part["set_no"].to_numpy()[row]})
    return run


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component under edges a-b among n rows."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _starts(pdf, cols: list[str]) -> np.ndarray:
    """First rows of the groups among rows sorted by cols."""
    key = pdf[cols].to_numpy()
    return np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)])) if len(key) else np.zeros(0, np.int64)


def look_near(size: np.ndarray, m: np.ndarray, head_size: np.ndarray, head: np.ndarray, least: float, similarity: float) -> np.ndarray:
    """Which rows of sketches look similar to the rows of head."""
    return (np.minimum(size, head_size) >= similarity * np.maximum(size, head_size)) & ((m == head).sum(1) >= least * m.shape[1])


def _near_heads(least: float, similarity: float):
    """mapInPandas: marks the sets that look similar to their node's head."""
    def run(batches):
        for pdf in batches:
            if len(pdf):
                near = look_near(pdf["size"].to_numpy(np.int64), _matrix(pdf["sketch"]), pdf["head_size"].to_numpy(np.int64),
                                 _matrix(pdf["head_sketch"]), least, similarity)
                yield pdf[["node", "set_no", "head", "sketch"]].assign(near=near)
    return run


def split_nodes(node: np.ndarray, rows: np.ndarray, left: np.ndarray, no: np.ndarray, size: np.ndarray, m: np.ndarray, least: float,
                similarity: float, bucket: int, branch: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of rows of the sketches m, ``left`` levels each, split until they have at most
    bucket rows or end: (group, row) of the nodes to compare, (row, head) of the ties to heads."""
    groups, members, tied, heads, n_groups = [], [], [], [], 0
    while len(rows):
        by = np.lexsort((no[rows], node))
        node, rows, left = node[by], rows[by], left[by]
        new = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        n = np.diff(np.append(new, len(rows)))
        of = np.repeat(np.arange(len(new)), n)
        large = np.flatnonzero(n[of] > bucket)
        head = rows[new[of[large]]]
        near = np.concatenate([look_near(size[r], m[r], size[h], m[h], least, similarity) for r, h in (
            (rows[large[lo:lo + 65536]], head[lo:lo + 65536]) for lo in range(0, max(1, len(large)), 65536))])
        alike = np.bincount(of[large[near]], minlength=len(new))
        ends = (n > 1) & ((n <= bucket) | (left[new] == 0) | (alike >= similarity * n))
        tie = near & ends[of[large]] & (rows[large] != head)
        tied.append(rows[large[tie]])
        heads.append(head[tie])
        here = np.flatnonzero(ends[of])
        groups.append(n_groups + of[here])
        members.append(rows[here])
        n_groups += len(new)
        on = np.flatnonzero(~ends[of] & (n[of] > 1))
        parts = [(on[lo:lo + 8192], *children(node[on[lo:lo + 8192]], m[rows[on[lo:lo + 8192]]], branch)) for lo in range(0, len(on), 8192)]
        at = np.concatenate([p[row] for p, row, _ in parts]) if parts else on
        node = np.concatenate([child for _, _, child in parts]) if parts else node[:0]
        rows, left = rows[at], left[at] - 1
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(groups), join(members), join(tied), join(heads)


def _pairs_in_nodes(least: float, similarity: float, bucket: int, branch: float):
    """mapInPandas over rows sorted by (node, i, j): ties of sets that look similar.
    Nodes that may be split (``left`` levels more) are split first.
    Pairs already tied through others, or through their node's head, are not compared
    again, and what is found is reduced to a spanning forest as it grows."""
    def solve(pdf):
        size, m, block = pdf["size"].to_numpy(np.int64), _matrix(pdf["sketch"]), pdf["block"].to_numpy()
        near_head, no, left = pdf["near"].to_numpy(bool), pdf["set_no"].to_numpy(), pdf["left"].to_numpy(np.int64)
        new = _starts(pdf, ["node", "i", "j"])
        group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(pdf))))
        across = (pdf["i"] != pdf["j"]).to_numpy()  # pairs inside a block are compared in that block's own group
        found_a, found_b, n_found = [], [], 0
        root = np.arange(len(pdf))
        tied_to_head = np.flatnonzero(near_head)
        _, first, of = np.unique(group[tied_to_head], return_index=True, return_inverse=True)
        root[tied_to_head] = tied_to_head[first[of]]

        def forest():
            # the forest so far (each row and its root) and the new pairs
            a, b = np.concatenate([np.arange(len(root)), *found_a]), np.concatenate([root, *found_b])
            return local_roots(len(root), a, b)

        row = np.flatnonzero(left < 0)
        group = group[row]
        open_rows = np.flatnonzero(left >= 0)
        if len(open_rows):
            more, members, tied, heads = split_nodes(pdf["node"].to_numpy(np.int64).view(np.uint64)[open_rows], open_rows, left[open_rows], no,
                                                     size, m, least, similarity, bucket, branch)
            row, group = np.concatenate([row, members]), np.concatenate([group, len(new) + more])
            by = np.argsort(group, kind="stable")
            row, group = row[by], group[by]
            if len(tied):
                found_a, found_b = [tied], [heads]
                root, found_a, found_b = forest(), [], []
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(row) else np.zeros(0, np.int64)
        edges = np.append(starts, len(row))
        end = np.repeat(edges[1:], np.diff(edges))
        live = np.arange(len(row))
        off = 1
        while len(live := live[live + off < end[live]]):
            for lo in range(0, len(live), 1 << 16):
                i = row[live[lo:lo + (1 << 16)]]
                j = row[live[lo:lo + (1 << 16)] + off]
                open_ = ((np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j]))
                         & (root[i] != root[j]) & ~(across[i] & (block[i] == block[j])))
                i, j = i[open_], j[open_]
                near = (m[i] == m[j]).sum(1) >= least * m.shape[1]
                found_a.append(i[near])
                found_b.append(j[near])
                n_found += int(near.sum())
            if n_found >= max(1 << 14, len(root)):
                root, found_a, found_b, n_found = forest(), [], [], 0
            off += 1
        root = forest()
        tied = np.flatnonzero((root != np.arange(len(pdf))) & ~(near_head & near_head[root]))
        return pd.DataFrame({"a": no[tied], "b": no[root[tied]]}).drop_duplicates()

    def run(batches):
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            new = _starts(held, ["node", "i", "j"])
            if len(new) > 1:
                yield solve(held[:new[-1]].reset_index(drop=True))
                held = held[new[-1]:].reset_index(drop=True)
        if held is not None and len(held):
            yield solve(held)
    return run


def candidate_ties(stages: Stages, sets: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
                   bucket: int = BUCKET, branch: float = BRANCH, depth: int = DEPTH, coords: int = COORDS,
                   node_block: int = NODE_BLOCK) -> DataFrame:
    """sets(set_no, size, sketch) -> (a, b): ties of sets that may be similar."""
    n = partitions(sets.sparkSession)
    # four standard deviations of the estimate below the similarity
    least = similarity - 4 * math.sqrt(similarity * (1 - similarity) / coords)
    frontier = sets.select("set_no", "sketch").mapInPandas(
        _roots(runs_for(recall, similarity, branch, depth)), "node long, set_no long")
    leaf = ["node", "set_no", "near", "n_near", "n_far", "left"]
    leaves, ties = [], []
    local = max(bucket, LOCAL * node_block)
    for level in range(1, depth + 1):
        # a set is in a node once: its children differ in node, coordinate or value
        frontier = stages.save(frontier, f"level{level}")
        sizes = frontier.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("set_no").alias("head")).where("n > 1")
        placed = stages.save(frontier.join(sizes, "node"), f"placed{level}")
        stages.drop(frontier)
        leaves.append(placed.where(F.col("n") <= local).select(  # one group each
            "node", "set_no", F.lit(False).alias("near"), F.lit(0).cast("long").alias("n_near"), F.lit(1).cast("long").alias("n_far"),
            F.lit(depth - level).alias("left")))
        large = placed.where(F.col("n") > local)
        if large.isEmpty():
            break
        heads = large.where("set_no = head").select("node", "set_no").join(sets, "set_no").select(
            "node", F.col("size").alias("head_size"), F.col("sketch").alias("head_sketch"))
        held = stages.save(large.select("node", "set_no", "head").join(sets, "set_no").join(heads, "node").mapInPandas(
            _near_heads(least, similarity), "node long, set_no long, head long, sketch binary, near boolean"), f"held{level}")
        counts = held.groupBy("node").agg(F.count_if("near").alias("n_near"), F.count_if(~F.col("near")).alias("n_far"))
        counts = counts.withColumn("ends", F.lit(level == depth) | (F.col("n_near") >= similarity * (F.col("n_near") + F.col("n_far"))))
        counted = held.join(counts, "node").withColumn("left", F.lit(-1))
        leaves.append(counted.where("ends").select(leaf))
        ties.append(counted.where("ends AND near AND set_no <> head").select(F.col("head").alias("a"), F.col("set_no").alias("b")))
        if level < depth:
            frontier = counted.where("NOT ends").select("node", "set_no", "sketch").mapInPandas(
                _branches(branch), "node long, set_no long")
    found = leaves[0]
    for x in leaves[1:]:
        found = found.unionByName(x)
    most = max(bucket, node_block)
    far, near = (F.ceil(F.col(c) / most).cast("int") for c in ("n_far", "n_near"))
    place = lambda blocks: F.pmod(F.xxhash64("set_no"), F.greatest(blocks, F.lit(1))).cast("int")
    # sets near the head meet the others only: a node without others has no groups
    others = F.when(F.col("near"), far).otherwise(far + near)
    dealt = (found.withColumn("block", F.when(F.col("near"), far + place(near)).otherwise(place(far)))
             .withColumn("other", F.explode(F.when(others > 0, F.sequence(F.lit(0), others - 1))))
             .join(sets, "set_no")
             .select("node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "near", "left", "set_no", "size", "sketch"))
    out = (dealt.repartition(n, "node", "i", "j").sortWithinPartitions("node", "i", "j")
           .mapInPandas(_pairs_in_nodes(least, similarity, bucket, branch), "a long, b long"))
    for x in ties:
        out = out.unionByName(x)
    return out


# --- true links -------------------------------------------------------------

def _tokens(batches):
    for pdf in batches:
        for lo, hi, texts in _pieces(pdf):
            yield pd.DataFrame({"set_no": pdf["set_no"].to_numpy()[lo:hi], "cluster": pdf["cluster"].to_numpy()[lo:hi],
                                "blocks": pdf["blocks"].to_numpy()[lo:hi], "copies": pdf["copies"].to_numpy()[lo:hi],
                                "tokens": [s.tobytes() for s in shingle_sets(texts)]})


def common_counts(sets: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Numbers of common tokens of all sets against all, by products of slices of
    the set-by-token table."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col = np.unique(np.concatenate(sets), return_inverse=True)
    by = np.argsort(col, kind="stable")
    row, col = row[by], col[by]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        a, b = np.searchsorted(col, [lo, lo + step])
        part = np.zeros((len(sets), step), np.float32)
        part[row[a:b], col[a:b] - lo] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _links(similarity: float):
    """mapInPandas over rows sorted by (cluster, i, j): links of each set in the
    block pair, weighted by copies, and its smallest tied set."""
    top, bottom = round(similarity * 1000), 1000

    def solve(rows):
        rows = rows.drop_duplicates("set_no")
        sets = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        size = np.asarray([len(s) for s in sets])
        common = common_counts(sets)
        linked = common * bottom >= top * (size[:, None] + size[None, :] - common)
        np.fill_diagonal(linked, False)
        i, j, block = (rows[c].to_numpy() for c in ("i", "j", "block"))
        if i[0] != j[0]:  # pairs inside a block are counted in that block's own group
            linked &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(linked))
        root = local_roots(len(sets), a, b)
        no = rows["set_no"].to_numpy()
        return pd.DataFrame({"set_no": no, "links": linked @ rows["copies"].to_numpy(np.int64), "tie": no[root]}).query("links > 0")

    def run(batches):
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            key = held[["cluster", "i", "j"]].to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)])) if len(key) else []
            out = [solve(held[a:b]) for a, b in zip(new[:-1], new[1:], strict=True)]
            if len(new):
                held = held[new[-1]:].reset_index(drop=True)
            if out:
                yield pd.concat(out)
        if held is not None and len(held):
            yield solve(held)
    return run


def jaccard_join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, bucket: int = BUCKET,
                 block: int = BLOCK, branch: float = BRANCH, depth: int = DEPTH, coords: int = COORDS,
                 stages: Stages | None = None, node_block: int = NODE_BLOCK) -> DataFrame:
    """docs(doc_id, text) -> a row a document row: doc_id, text_hash, class_id (smallest id
    of its class), n_links (documents at least so similar, copies included), n_shingles."""
    spark = docs.sparkSession
    stages = stages or Stages(spark, "jaccard")
    n = partitions(spark)
    small_batches(spark)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rows = stages.save(texts.mapInPandas(_sets_of(coords), "doc_id long, text_hash long, sid string, size int, sketch binary"), "rows")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("text_hash"))
    sets = stages.save(rows.where("sid IS NOT NULL").groupBy("sid").agg(
        F.first("size").alias("size"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"),
        F.min(key).alias("rep")).withColumn("set_no", F.monotonically_increasing_id()), "sets")

    ties = candidate_ties(stages, sets.select("set_no", "size", "sketch"), similarity, recall, bucket, branch, depth, coords, node_block)
    clusters = stages.save(components(stages, ties), "clusters")
    sizes = clusters.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    members = stages.save(clusters.join(sizes, "root").join(sets, clusters["node"] == sets["set_no"]).select(
        "set_no", F.col("root").alias("cluster"), "blocks", "copies", F.col("rep.doc_id").alias("doc_id"),
        F.col("rep.text_hash").alias("text_hash")), "members")
    # the same plan at every size: the texts are dealt out by document, not met by a broadcast while there are few members
    whole = (texts.alias("t").join(members.hint("merge").alias("m"), F.expr("t.doc_id <=> m.doc_id AND t.text_hash = m.text_hash"))
             .select("t.text", "m.set_no", "m.cluster", "m.blocks", "m.copies")
             .mapInPandas(_tokens, "set_no long, cluster long, blocks int, copies long, tokens binary"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (whole.withColumn("block", F.pmod(F.xxhash64("set_no"), F.col("blocks")).cast("int")).withColumn("other", other)
             .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "set_no", "copies", "tokens"))
    found = stages.save(dealt.repartition(n, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
                        .mapInPandas(_links(similarity), "set_no long, links long, tie long"), "links")
    links = found.groupBy("set_no").agg(F.sum("links").alias("links"))
    classes = components(stages, found.select(F.col("set_no").alias("a"), F.col("tie").alias("b")))

    named = (sets.select("sid", "set_no", "copies", "rep").join(classes, sets["set_no"] == classes["node"], "left")
             .withColumn("root", F.coalesce("root", "set_no")).join(links, "set_no", "left"))
    named = stages.save(named.select("sid", "root", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    first = named.groupBy("root").agg(F.min("rep").alias("first"))
    of = stages.save(named.join(first, "root").select("sid", "n_links", F.col("first.doc_id").alias("class_id"),
                                                      F.col("first.text_hash").alias("class_hash")), "classes")
    stages.keep(rows, of)
    return rows.drop("sketch").join(of, "sid", "left").select(
        "doc_id", "text_hash", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("sid").isNull(), F.col("text_hash")).otherwise(F.col("class_hash")).alias("class_hash"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("size").cast("long").alias("n_shingles"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, with all their columns, less all but the first of each
    class (smallest id, then text hash) and all but one of rows that repeat id and text."""
    stages = Stages(docs.sparkSession, "jaccard")
    joined = stages.save(jaccard_join(pick(docs, doc_id=key, text=text), similarity, stages=stages), "joined")
    mine = ~(F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("text_hash").eqNullSafe(F.col("class_hash")))
    out = stages.save(joined.where(mine).select(F.col("doc_id").alias("_out_id"), F.col("text_hash").alias("_out_hash")).distinct(), "out")
    again = stages.save(joined.where(~mine & (F.col("n_shingles") > 0)).groupBy("doc_id", "text_hash").count().where("count > 1")
                        .select(F.col("doc_id").alias("_out_id"), F.col("text_hash").alias("_out_hash")), "again")
    same = lambda x: docs[key].eqNullSafe(x["_out_id"]) & (F.xxhash64(docs[text]) == x["_out_hash"])
    stages.keep(out, again)
    # the same plan at every size, as for the texts above
    kept = docs.join(out.hint("merge"), same(out), "left_anti")
    if again.isEmpty():
        return kept
    once = kept.join(again, same(again), "left_semi").dropDuplicates([key, text])
    return kept.join(again, same(again), "left_anti").unionByName(once)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return jaccard_join(docs).select("doc_id", "class_id", "n_links", "n_shingles")


OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, len(s) AS n FROM s),
t AS (SELECT doc_id, md5_number(unnest(s)) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM t a JOIN t b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 1000 * k >= 800 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS class_id FROM documents UNION SELECT e.b, r.class_id FROM r JOIN e ON e.a = r.doc_id)
SELECT doc_id, min(class_id) AS class_id, any_value(coalesce(k, 0)) AS n_links, any_value(coalesce(n, 0)) AS n_shingles
FROM r LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM e GROUP BY a) USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
