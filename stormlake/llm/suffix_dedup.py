"""Removal of repeated passages by a hash-compared suffix sort.

A byte is removed if a string of ``LENGTH`` bytes covers it that also starts at
an earlier place of the corpus (smaller doc_id, or same document and earlier).

1. Anchors.  Every window of LENGTH bytes picks the leftmost of its least
   GRAM-byte hashes; equal windows pick it at the same offset, so two
   windows can only be equal if their anchors' grams are.  Neighbouring windows
   share anchors: one row stands for all windows of an anchor (about one row
   every forty bytes), with the gram's hash and a second, independent hash of the whole
   region those windows cover.
2. Rows meet by gram.  A row whose region occurred before, at the same
   offsets, is removed whole.  Rows whose gram occurs in other regions only may
   share some windows, and only these get their bytes fetched.
3. Their suffixes (from the anchor on, and backwards from it) are sorted by a
   merge sort that compares two suffixes through the longest common
   extension, found by binary search over prefix polynomial hashes.  Neighbours'
   common extensions are verified byte by byte.  Two windows at offset o are equal if
   their rows lie in one run of backward extensions of at least o bytes and one
   of forward extensions of at least LENGTH - o.
4. The starts found are merged per document and cut out.

Grams with more than ``HOT`` different regions are not held in one task: the
windows of their rows go through a min by digest, which combines before its shuffle.

Defined results: a null or empty text has no bytes and loses none; rows that
repeat id and text are one document and get the same result; a null id comes
before all others, and texts that share an id come in the order of a hash of the
text; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stages, chunks, mix64, partitions, pick, table

LENGTH = 100
GRAM = 24
SEGMENT = 1 << 20
HOT = 20_000
BATCH = 20_000

_U = np.uint64
_PLACE_BITS = 24  # of a place in a segment run, under the hash's leading bits
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BYTE2 = mix64(np.arange(1001, 1257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE, _BASE2 = 0x2545F4914F6CDD1D, 0xD1342543DE82EF95  # odd, so invertible modulo 2^64


class _Powers:
    """base^i and base^-i modulo 2^64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = _U(base), _U(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            ones = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b)]), dtype=np.uint64)
            self.up, self.down = ones(self.base), ones(self.inverse)
        return self.up[:n], self.down[:n]


_POWERS = _Powers(_BASE), _Powers(_BASE2)


def _sums(data: np.ndarray, byte: np.ndarray, up: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[data] * up[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """min(key[i:i+width]) for every i where that fits."""
    n = len(key) - width + 1
    padded = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(texts: list[bytes], length: int, gram: int) -> dict[str, np.ndarray]:
    """Rows (text number, pos, lo, hi, gram hash, region hash): the anchor at pos
    stands for the windows that start at pos - hi .. pos - lo."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size) - size
    n = len(data)
    if n < length:
        return {}
    (up, down), (up2, down2) = (p.to(n + 1) for p in _POWERS)
    s, s2 = _sums(data, _BYTE, up), _sums(data, _BYTE2, up2)
    h = mix64((s[gram:] - s[:-gram]) * down[:n + 1 - gram])
    mask = _U((1 << _PLACE_BITS) - 1)
    at = (_sliding_min((h & ~mask) | np.arange(len(h), dtype=np.uint64), length - gram + 1) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), size)[:len(at)]
    fits = np.arange(len(at)) + length <= (begin + size)[owner]
    starts = np.flatnonzero(fits)
    if not len(starts):
        return {}
    a, o = at[starts], owner[starts]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (o[1:] != o[:-1])]))
    first, last = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    a, o = a[new], o[new]
    region = mix64((s2[last + length] - s2[first]) * down2[first])
    return {"text": o, "pos": a - begin[o], "lo": a - last, "hi": a - first,
            "g": h[a].view(np.int64), "r": region.view(np.int64)}


def _later(rows: pd.DataFrame) -> np.ndarray:
    """Rows of a batch whose region has an earlier place, at the same offsets, in the batch."""
    g, r, span = (rows[c].to_numpy() for c in ("g", "r", "span"))
    key = mix64(g.view(np.uint64) ^ mix64(r.view(np.uint64) + span.astype(np.uint64)))
    _, of, times = np.unique(key, return_inverse=True, return_counts=True)
    out = np.zeros(len(rows), bool)
    i = np.flatnonzero(times[of] > 1)
    if len(i):
        doc = rows["doc_id"].iloc[i]
        place = [~doc.isna().to_numpy(), doc.fillna(0).to_numpy(np.int64), rows["text_hash"].to_numpy()[i], rows["pos"].to_numpy()[i]]
        keys = [g[i], r[i], span[i], *place]
        by = np.lexsort(keys[::-1])
        keys = [k[by] for k in keys]
        new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys[:3]], axis=0)])
        first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        out[i[by]] = np.any([k != k[first] for k in keys[3:]], axis=0)
    return out


def _find_anchors(length: int, gram: int):
    """mapInPandas: documents -> rows.  Rows that a batch already shows to be
    repeats are done: they need no gram and are dealt out by their place, so a passage that
    very many documents share sends one row a batch to its gram's task."""
    def run(batches):
        for pdf in batches:
            found = list(one(pdf))
            if found:
                rows = pd.concat(found, ignore_index=True)
                done = _later(rows)
                spread = mix64(rows["pos"].to_numpy().view(np.uint64) ^ mix64(rows["text_hash"].to_numpy().view(np.uint64)))
                yield rows.assign(g=np.where(done, spread.view(np.int64), rows["g"]), done=done)

    def one(pdf):
        pieces, names = [], []  # segments of texts, with (row, offset)
        for i, text in enumerate(pdf["text"]):
            for lo in range(0, max(1, len(text) - length + 1), SEGMENT):
                pieces.append(text[lo:lo + SEGMENT + length - 1])
                names.append((i, lo))
        names = np.asarray(names, np.int64).reshape(-1, 2)
        ids, hashes = pdf["doc_id"].astype("Int64"), pdf["text_hash"].to_numpy(np.int64)
        for lo, hi in chunks(pieces):
            got = anchors(pieces[lo:hi], length, gram)
            if got:
                row, offset = names[lo:hi][got["text"]].T
                yield pd.DataFrame({
                    "g": got["g"], "r": got["r"], "doc_id": ids.iloc[row].to_numpy(), "text_hash": hashes[row],
                    "pos": got["pos"] + offset, "span": (got["lo"] << 8 | got["hi"]).astype(np.int32)}).astype({"doc_id": "Int64"})
    return run


_ROW = "g long, r long, doc_id long, text_hash long, pos long, span int, done boolean"


def _split_repeats(batches):
    """Rows sorted by (g, r, span, place) -> those whose region, at the same offsets,
    has an earlier place (whole), and the first row of each region that
    shares its gram with another region (not whole).  Holds one row back."""
    held = last = None  # the last region's first row, maybe to be given out; the last row's first place
    for pdf in batches:
        done = pdf["done"].to_numpy(bool)
        if done.any():
            yield pdf[done].assign(whole=True).astype({"doc_id": "Int64"})
            pdf = pdf[~done]
        if not len(pdf):
            continue
        n = len(pdf)
        g, r, span = (pdf[c].to_numpy() for c in ("g", "r", "span"))
        doc = pdf["doc_id"].astype("Int64")
        place = np.stack([doc.fillna(0).to_numpy(np.int64), doc.isna().to_numpy(np.int64),
                          pdf["text_hash"].to_numpy(np.int64), pdf["pos"].to_numpy(np.int64)], 1)
        changes = lambda x, i: np.concatenate([[last is None or x[0] != last[i]], x[1:] != x[:-1]])
        new_g = changes(g, 0)
        other = changes(r, 1) | changes(span, 2)
        new = new_g | other
        own = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        first = np.where((own >= 0)[:, None], place[np.maximum(own, 0)], place[0] if last is None else last[3])
        whole = ~new & (first != place).any(1)
        reps = np.flatnonzero(new)
        # a region's first row is given out if the region before or after it has the same gram
        shared = ~new_g[reps]
        out = [pdf[whole].assign(whole=True)]
        if len(reps):
            if held is not None and (held[1] or shared[0]):
                out.append(held[0])
            give = shared.copy()
            give[:-1] |= shared[1:]
            out.append(pdf.iloc[reps[:-1][give[:-1]]].assign(whole=False))
            held = pdf.iloc[[reps[-1]]].assign(whole=False), bool(shared[-1])
        last = (g[-1], r[-1], span[-1], first[-1] if not new[-1] else place[-1])
        yield pd.concat(out).astype({"doc_id": "Int64"})
    if held is not None and held[1]:
        yield held[0].astype({"doc_id": "Int64"})


# --- the suffix sort --------------------------------------------------------

class Suffixes:
    """Byte strings (rows of a padded matrix) with their prefix hashes."""

    def __init__(self, rows: list[bytes], width: int):
        self.size = np.fromiter(map(len, rows), np.int64, len(rows))
        self.data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in rows), np.uint8).reshape(len(rows), width)
        up, _ = _POWERS[0].to(width + 1)
        self.hash = np.zeros((len(rows), width + 1), np.uint64)
        np.cumsum(_BYTE[self.data] * up[:width], axis=1, dtype=np.uint64, out=self.hash[:, 1:])

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of rows a and b: binary search for
        the longest equal prefix hash."""
        lo, hi = np.zeros(len(a), np.int64), np.minimum(self.size[a], self.size[b])
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.hash[a, mid] == self.hash[b, mid]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Row a comes before row b."""
        k = self.extension(a, b)
        ends_a, ends_b = k == self.size[a], k == self.size[b]
        at = np.minimum(k, self.data.shape[1] - 1)
        return np.where(ends_a | ends_b, ends_a & ~ends_b, self.data[a, at] < self.data[b, at])

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the rows by suffix inside each run of equal ``group`` (rows
        come grouped).  Merge sort: every row finds its place in the other run by
        binary search, all rows of a level at once."""
        n = len(group)
        order = np.arange(n)
        new = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [n]])
        of = np.cumsum(new) - 1
        begin, end = begin[of], end[of]
        width, longest = 1, int((end - begin).max(initial=0))
        while width < longest:
            at = np.flatnonzero(end - begin > width)  # places in groups that still have two runs
            base = begin[at] + (at - begin[at]) // (2 * width) * 2 * width
            middle, stop = np.minimum(base + width, end[at]), np.minimum(base + 2 * width, end[at])
            left = at < middle
            lo, hi = np.where(left, middle, base), np.where(left, stop, middle)
            other = lo.copy()
            me = order[at]
            while (open_ := lo < hi).any():
                mid = (lo + hi) // 2
                i = np.flatnonzero(open_)
                them = order[mid[i]]
                # equal rows: those of the left run first
                goes_on = np.where(left[i], self.less(them, me[i]), ~self.less(me[i], them))
                lo[i[goes_on]] = mid[i[goes_on]] + 1
                hi[i[~goes_on]] = mid[i[~goes_on]]
            place = np.where(left, at, at - (middle - base)) + (lo - other)
            merged = order.copy()
            merged[place] = me
            order, width = merged, 2 * width
        return order

    def neighbours(self, order: np.ndarray) -> np.ndarray:
        """Common extension of each row in ``order`` with the one before it, verified byte by byte."""
        out = np.zeros(len(order), np.int64)
        if len(order) > 1:
            a, b = order[:-1], order[1:]
            k = self.extension(a, b)
            differ = (self.data[a] != self.data[b]) & (np.arange(self.data.shape[1]) < k[:, None])
            out[1:] = np.where(differ.any(1), differ.argmax(1), k)
        return out


def equal_windows(group: np.ndarray, rank: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                  regions: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, a, b): the row's windows at offsets a..b have an equal window in a
    row of the same group with a smaller rank.  Rows come grouped; region i is
    the bytes of its windows, its anchor hi[i] bytes in."""
    n = len(group)
    right = Suffixes([x[k:] for x, k in zip(regions, hi, strict=True)], length)
    left = Suffixes([x[:k][::-1] for x, k in zip(regions, hi, strict=True)], length)
    runs = []
    new = np.concatenate([[True], group[1:] != group[:-1]])
    for s in (right, left):
        order = s.sort(group)
        common = s.neighbours(order)
        common[new] = -1  # places keep their group
        runs.append((order, common))
    by_rank = np.argsort(rank, kind="stable")
    found = np.zeros((n, int(hi.max(initial=0)) + 2), bool)

    def run_of(which, least):
        order, common = runs[which]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(common < least)
        return out

    for o in range(int(lo.min(initial=0)), int(hi.max(initial=-1)) + 1):
        live = by_rank[(lo[by_rank] <= o) & (o <= hi[by_rank])]
        if len(live) < 2:
            continue
        key = (run_of(0, length - o) * (n + 1) + run_of(1, o))[live]
        _, first, of = np.unique(key, return_index=True, return_inverse=True)  # by rank: the earliest row of each class
        found[live[rank[live] != rank[live[first]][of]], o] = True
    edge = np.diff(np.pad(found, ((0, 0), (1, 0))).astype(np.int8), axis=1)
    row, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return row, a, b - 1


def _resolve(length: int):
    """mapInPandas over rows sorted by g: the starts that occur earlier."""
    def solve(pdf):
        g = pdf["g"].to_numpy()
        doc = pdf["doc_id"].astype("Int64")
        keys = (pdf["pos"].to_numpy(), pdf["text_hash"].to_numpy(), doc.fillna(0).to_numpy(np.int64), ~doc.isna().to_numpy())
        order = np.lexsort(keys)
        rank = np.empty(len(pdf), np.int64)  # rows of one place, from rows that repeat a document, have one rank
        rank[order] = np.cumsum(np.concatenate([[False], *[np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)]]))
        span = pdf["span"].to_numpy(np.int64)
        lo, hi = span >> 8, span & 255
        row, a, b = equal_windows(g, rank, lo, hi, list(pdf["region"]), length)
        pos = pdf["pos"].to_numpy()[row]
        return pd.DataFrame({"doc_id": doc.iloc[row].to_numpy(), "text_hash": pdf["text_hash"].to_numpy()[row],
                             "first": pos - b, "last": pos - a}).astype({"doc_id": "Int64"})

    def run(batches):
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            g = held["g"].to_numpy()
            if len(held) >= BATCH and g[0] != g[-1]:
                cut = int(np.flatnonzero(g != g[-1])[-1]) + 1
                yield solve(held[:cut])
                held = held[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield solve(held)
    return run


# --- in Spark ---------------------------------------------------------------

_DOC = ["doc_id", "text_hash"]


def _same_doc(a: str, b: str):
    return F.expr(f"{a}.doc_id <=> {b}.doc_id AND {a}.text_hash = {b}.text_hash")


def _regions(length: int):
    def run(batches):
        for pdf in batches:
            rows = [(g, d, h, pos, span, text[pos - (span & 255):pos - (span >> 8) + length])
                    for d, h, text, found in zip(pdf["doc_id"].astype("Int64"), pdf["text_hash"], pdf["text"], pdf["rows"], strict=True)
                    for g, pos, span in ((x["g"], x["pos"], x["span"]) for x in found)]
            yield pd.DataFrame(rows, columns=["g", *_DOC, "pos", "span", "region"]).astype({"doc_id": "Int64"})
    return run


def repeated_starts(stages: Stages, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """docs(doc_id, text_hash, text binary) -> (doc_id, text_hash, first, last): runs of
    starts of strings of ``length`` bytes that also start earlier."""
    n = partitions(docs.sparkSession)
    rows = docs.mapInPandas(_find_anchors(length, gram), _ROW)
    rows = rows.repartition(n, "g").sortWithinPartitions("g", "r", "span", *_DOC, "pos")
    split = stages.save(rows.mapInPandas(_split_repeats, f"{_ROW}, whole boolean"), "anchors")
    whole = split.where("whole").selectExpr(*_DOC, "pos - (span & 255) AS first", "pos - (span >> 8) AS last")

    shared = split.where("NOT whole")
    asked = shared.groupBy(*_DOC).agg(F.collect_list(F.struct("g", "pos", "span")).alias("rows"))
    regions = stages.save(docs.alias("d").join(asked.alias("a"), _same_doc("d", "a")).select("d.*", "a.rows")
                          .mapInPandas(_regions(length), "g long, doc_id long, text_hash long, pos long, span int, region binary"), "regions")
    many = stages.save(regions.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("g"), "hot")
    few = regions.join(many, "g", "left_anti")
    part = few.repartition(n, "g").sortWithinPartitions("g").mapInPandas(
        _resolve(length), "doc_id long, text_hash long, first long, last long")

    # windows of grams with very many regions: the earliest place by digest
    windows = (regions.join(many, "g", "left_semi")
               .select(*_DOC, "pos", "region", F.expr("span & 255").alias("hi"),
                       F.explode(F.expr("sequence(span >> 8, span & 255)")).alias("o"))
               .select(*_DOC, (F.col("pos") - F.col("o")).alias("start"),
                       F.sha2(F.expr(f"substring(region, hi - o + 1, {length})"), 256).alias("digest")))
    place = F.struct("doc_id", "text_hash", "start")
    earliest = windows.groupBy("digest").agg(F.min(place).alias("place"))
    rest = (windows.join(earliest.hint("merge"), "digest").where(~place.eqNullSafe(F.col("place")))
            .select(*_DOC, F.col("start").alias("first"), F.col("start").alias("last")))
    return whole.unionByName(part).unionByName(rest)


def merged(first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte ranges [lo, hi) covered by strings that start at first..last."""
    by = np.argsort(first, kind="stable")
    lo, hi = first[by], np.maximum.accumulate(last[by] + length)
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    at = np.flatnonzero(new)
    return lo[at], hi[np.concatenate([at[1:], [len(lo)]]) - 1]


def cut(text: bytes, spans, length: int) -> tuple[bytes, int, int]:
    """(what is kept, bytes removed, spans removed)."""
    if spans is None or not len(spans):
        return text, 0, 0
    lo, hi = merged(np.asarray([x["first"] for x in spans], np.int64), np.asarray([x["last"] for x in spans], np.int64), length)
    edges = np.concatenate([[0], hi]), np.concatenate([lo, [len(text)]])
    kept = b"".join(text[a:b] for a, b in zip(*edges, strict=True))
    return kept, len(text) - len(kept), len(lo)


def _cut_all(length: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for doc_id, text, spans in zip(pdf["doc_id"].astype("Int64"), pdf["text"], pdf["spans"], strict=True):
                kept, removed, runs = cut(text, spans, length)
                rows.append((doc_id, len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes)."""
    stages = Stages(docs.sparkSession, "suffix-dedup")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                       F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    starts = repeated_starts(stages, rows, length, gram, hot)
    spans = stages.save(starts.groupBy(*_DOC).agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")
    stages.keep(spans)
    return (rows.alias("d").join(spans.alias("s"), _same_doc("d", "s"), "left").select("d.doc_id", "d.text", "s.spans")
            .mapInPandas(_cut_all(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return remove_repeats(docs).drop("kept")


OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 200)) AS s FROM (
  SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM p),
e AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new FROM f WHERE n > 1),
g AS (SELECT doc_id, i, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM e),
spans AS (SELECT doc_id, run, min(i) AS lo, max(i) + 100 AS hi FROM g GROUP BY doc_id, run),
cuts AS (SELECT doc_id, run, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans),
k AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
    string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (lo - before) AS BIGINT)), '' ORDER BY lo) AS head
  FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
