"""Removal of repeated passages by level-wise doubling.

A word is removed if a window of ``LENGTH`` consecutive words covers it whose words also start at any
other place.  Windows are looked for at a quarter of that length first; those repeated
at one length alone are extended to twice that length, until the full length is reached or no candidates survive.

1. Short windows.  Every full window picks the leftmost of its least hashes of short windows
   (its anchor).  Equal windows pick theirs at the same offset, so a full window can only
   repeat if its anchor does.  Neighbouring windows share anchors: one row stands for all windows of an
   anchor (about one row every fourteen words), with a second hash of the
   whole region that these windows cover.
2. Rows meet by the short window's hash.  Rows alone with theirs are out.  Rows whose whole region occurs again, at
   the same offsets, are repeated at every length.  What is left, one row a
   region, goes on.
3. For each next length, the windows that extend the last level's (to the left as far as the full
   window reaches, then to the right) are counted by hash; those of one region only die, and with
   them the full windows that hold them.
4. The starts that survive at full length are merged per document and their words cut out.

Windows are told apart by two 64-bit hashes together (the short window's and the longer one's).
Counting combines before its shuffles, and regions that one batch of rows shows to repeat send one row to their
short window's task, so a passage or a text that a third of all rows share is no load of one task.

Defined results: a word is a run of bytes other than space and 0x09-0x0D; a null or empty text has
no words; texts of fewer words than a window lose none; rows that repeat, also with
their id, are places of their own; a null id is an id like others; an empty table gives an empty
result; texts of any length are read in segments; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Stages, chunks, mix64, partitions, pick, table
from .suffix_dedup import _BYTE, _POWERS, _Powers, _sliding_min, _sums

LENGTH = 35
SEGMENT = 1 << 20
SLICE = 1 << 17

_U = np.uint64
_PLACE_BITS = 24
_SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.isin(np.arange(256), list(_SPACES))
_STEP = _U(0x9E3779B97F4A7C15)
_WORD_POWERS = _Powers(0xA0761D6478BD642F)


def levels(length: int) -> list[int]:
    """Window lengths: a quarter, a half and the whole."""
    return sorted({max(1, -(-length // 4)), max(1, -(-length // 2)), length})


# --- words and their hashes ---------------------------------------------------

def _hashed(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words."""
    data = np.frombuffer(text, np.uint8)
    edge = np.flatnonzero(np.diff(_IS_SPACE[data], prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    up, down = _POWERS[0].to(len(data) + 1)
    s = _sums(data, _BYTE, up)
    return start, mix64((s[end] - s[start]) * down[start] ^ _STEP * (end - start).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of all words of a text, segment by segment."""
    out, lo = [], 0
    while lo < len(text):
        hi = lo + SEGMENT
        while hi < len(text) and text[hi] not in _SPACES:
            hi += 1
        out.append(_hashed(text[lo:hi])[1])
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Runs:
    """Hashes of runs of words."""

    def __init__(self, words: np.ndarray):
        up, self.down = _WORD_POWERS.to(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:len(words)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])


def anchors(owner: np.ndarray, words: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Word hashes of texts one after another -> rows (text, pos, lo, hi, g, r): the short window
    at pos stands for the full windows that start at pos - hi .. pos - lo."""
    short, n = levels(length)[0], len(words)
    if n < length:
        return {}
    runs = Runs(words)
    at = np.arange(n + 1 - short)
    g = runs.of(at, at + short)
    mask = _U((1 << _PLACE_BITS) - 1)
    least = (_sliding_min((g & ~mask) | at.astype(np.uint64), length - short + 1) & mask).astype(np.int64)
    starts = np.flatnonzero(owner[:n + 1 - length] == owner[length - 1:])
    if not len(starts):
        return {}
    a, o = least[starts], owner[starts]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (o[1:] != o[:-1])]))
    first, last = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    a, o = a[new], o[new]
    lo, hi = a - last, a - first
    r = mix64(runs.of(first, last + length) ^ _STEP * (lo << 16 | hi).astype(np.uint64))
    return {"text": o, "pos": a - np.searchsorted(owner, o), "lo": lo, "hi": hi, "g": g[a].view(np.int64), "r": r.view(np.int64)}


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(text number of each word, word hashes, words of that text before): short texts
    together, a long one in slices that share length - 1 words."""
    for lo, hi in chunks(texts, SEGMENT):
        if hi - lo > 1 or len(texts[lo]) <= SEGMENT:
            size = np.fromiter((len(t) + 1 for t in texts[lo:hi]), np.int64, hi - lo)
            start, words = _hashed(b"\n".join(texts[lo:hi]))
            yield lo + np.searchsorted(np.cumsum(size), start, side="right"), words, 0
        else:
            words = word_hashes(texts[lo])
            for i in range(0, max(1, len(words) - length + 1), SLICE):
                part = words[i:i + SLICE + length - 1]
                yield np.full(len(part), lo), part, i


def _find(length: int):
    """mapInPandas: documents -> rows.  ``seen`` is 0 for a region alone in its batch, 1 for the first of several
    there and 2 for the others: these are known to repeat, need no short window and are dealt out by their place."""
    def run(batches):
        for pdf in batches:
            texts = [t or b"" for t in pdf["text"]]
            ids, hashes = pdf["doc_id"].astype("Int64"), pdf["text_hash"].to_numpy(np.int64)
            found = []
            for owner, words, before in _pieces(texts, length):
                got = anchors(owner, words, length)
                if got:
                    found.append(pd.DataFrame({
                        "row": got["text"], "pos": got["pos"] + before, "lo": got["lo"], "hi": got["hi"], "g": got["g"], "r": got["r"]}))
            if not found:
                continue
            rows = pd.concat(found, ignore_index=True)
            g, r = rows["g"].to_numpy(), rows["r"].to_numpy()
            _, first, of, times = np.unique(mix64(g.view(np.uint64) ^ mix64(r.view(np.uint64))), return_index=True,
                                            return_inverse=True, return_counts=True)
            seen = np.where(times[of] == 1, 0, np.where(first[of] == np.arange(len(rows)), 1, 2))
            row = rows.pop("row").to_numpy()
            place = mix64(rows["pos"].to_numpy().view(np.uint64) ^ mix64(hashes[row].view(np.uint64)))
            yield rows.assign(g=np.where(seen == 2, place.view(np.int64), g), doc_id=ids.iloc[row].to_numpy(),
                              text_hash=hashes[row], seen=seen).astype({"doc_id": "Int64"})
    return run


_ROW = "g long, r long, doc_id long, text_hash long, pos long, lo short, hi short, seen byte"


# --- levels -------------------------------------------------------------------

def inner(offset: np.ndarray, size: int, length: int) -> np.ndarray:
    """Where the window of ``size`` starts in a full window whose short window is ``offset`` words in:
    extended to the left first."""
    short = levels(length)[0]
    return np.clip(offset - (size - short), 0, length - size)


def _keys(length: int):
    """mapInPandas: documents with their asked rows -> the rows, with keys[level][i] for their i-th offset."""
    def run(batches):
        for pdf in batches:
            out = []
            for doc_id, text_hash, text, asked in zip(pdf["doc_id"].astype("Int64"), pdf["text_hash"], pdf["text"], pdf["rows"], strict=True):
                runs = Runs(word_hashes(text))
                for x in asked:
                    o = np.arange(x["lo"], x["hi"] + 1)
                    keys = []
                    for size in levels(length)[1:]:
                        at = inner(o, size, length)
                        start = x["pos"] - o + at
                        keys.append(mix64(runs.of(start, start + size) ^ _STEP * (o - at).astype(np.uint64)).view(np.int64))
                    out.append((doc_id, text_hash, x["g"], x["r"], x["pos"], x["lo"], x["whole"], keys, o.astype(np.int32)))
            yield pd.DataFrame(out, columns=[*_DOC, "g", "r", "pos", "lo", "whole", "keys", "live"]).astype({"doc_id": "Int64"})
    return run


_DOC = ["doc_id", "text_hash"]
_KEYED = ("doc_id long, text_hash long, g long, r long, pos long, lo short, whole boolean, "
          "keys array<array<long>>, live array<int>")


def _same_doc(a: str, b: str):
    return F.expr(f"{a}.doc_id <=> {b}.doc_id AND {a}.text_hash = {b}.text_hash")


def repeated_starts(stages: Stages, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs(doc_id, text_hash, text binary) -> (doc_id, text_hash, first, last): runs of
    starts of windows that also start elsewhere."""
    n = partitions(docs.sparkSession)
    rows = docs.mapInPandas(_find(length), _ROW).repartition(n, "g")
    by, group = W.partitionBy("g").orderBy("r"), W.partitionBy("g").orderBy("r").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    again = F.coalesce(F.lag("r").over(by) == F.col("r"), F.lit(False))
    marked = rows.select("*", again.alias("again"), F.coalesce(F.lead("r").over(by) == F.col("r"), F.lit(False)).alias("more"),
                         (F.first("r").over(group) != F.last("r").over(group)).alias("mixed"))
    whole = (F.col("seen") > 0) | F.col("again") | F.col("more")
    split = stages.save(marked.where(whole | F.col("mixed")).select(
        *_DOC, "g", "r", "pos", "lo", "hi", whole.alias("whole"),
        (F.col("mixed") & ~F.col("again") & (F.col("seen") < 2)).alias("goes_on")), "anchors")

    asked = split.where("goes_on").groupBy(*_DOC).agg(F.collect_list(F.struct("g", "r", "pos", "lo", "hi", "whole")).alias("rows"))
    live = stages.save(docs.alias("d").join(asked.alias("a"), _same_doc("d", "a")).select("d.*", "a.rows")
                       .mapInPandas(_keys(length), _KEYED), "level")
    for level in range(len(levels(length)) - 1):
        key = lambda o: F.element_at(F.col("keys")[level], o - F.col("lo") + 1)  # noqa: E731, B023
        windows = live.select("g", "r", F.explode(F.array_distinct(F.transform("live", key))).alias("key"))
        alone = windows.groupBy("g", "key").agg(F.min("r").alias("r"), F.max("r").alias("r2")).where("r = r2")
        dead = alone.groupBy("g", "r").agg(F.collect_set("key").alias("dead"))
        left = live.join(dead, ["g", "r"], "left")
        stays = F.filter("live", lambda o: ~F.coalesce(F.array_contains("dead", key(o)), F.lit(False)))  # noqa: B023
        after = stages.save(left.withColumn("live", stays).drop("dead").where(F.size("live") > 0), "level")
        stages.drop(live)
        live = after
        if not live.limit(1).count():
            break
    runs = split.where("whole").selectExpr(*_DOC, "pos - hi AS first", "pos - lo AS last")
    start = F.explode(F.transform("live", lambda o: F.col("pos") - o))
    single = live.where("NOT whole").select(*_DOC, start.alias("first"))
    return runs.unionByName(single.withColumn("last", F.col("first")))


def _cut_all(length: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for doc_id, text, spans in zip(pdf["doc_id"].astype("Int64"), pdf["text"], pdf["spans"], strict=True):
                words = text.split()  # bytes split at space and 0x09-0x0D
                gone = np.zeros(len(words) + 1, np.int64)
                if spans is not None:
                    np.add.at(gone, [x["first"] for x in spans], 1)
                    np.add.at(gone, [x["last"] + length for x in spans], -1)
                stays = np.cumsum(gone)[:-1] == 0
                kept = b" ".join(compress(words, stays.tolist()))
                rows.append((doc_id, len(words), len(words) - int(stays.sum()), hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})
    return run


def remove_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_removed, kept_sha256, kept (bytes)."""
    stages = Stages(docs.sparkSession, "passage-dedup")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    starts = repeated_starts(stages, rows, length)
    spans = stages.save(starts.distinct().groupBy(*_DOC).agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")
    stages.keep(spans)
    return (rows.alias("d").join(spans.alias("s"), _same_doc("d", "s"), "left").select("d.doc_id", "d.text", "s.spans")
            .mapInPandas(_cut_all(length), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"))


def op11_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return remove_passages(docs).drop("kept")


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, i, md5_number(array_to_string(w[i + 1:i + 35], ' ')) AS h FROM (
  SELECT rid, w, unnest(range(0, len(w) - 34)) AS i FROM d)),
r AS (SELECT rid, i FROM s QUALIFY count(*) OVER (PARTITION BY h) > 1),
x AS (SELECT rid, list(DISTINCT j) AS gone FROM (SELECT rid, unnest(range(i, i + 35)) AS j FROM r) GROUP BY rid),
k AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM (
  SELECT d.rid, unnest(w) AS word, unnest(range(0, len(w))) AS j, x.gone FROM d LEFT JOIN x USING (rid))
  WHERE gone IS NULL OR NOT list_contains(gone, j) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""
