"""Token-id output: raw id payloads and a minimal perfect hash index over them.

Payload files.  Documents are range-sorted by id; each part is encoded and
written as one file of unsigned little-endian ids (two bytes an id where the
vocabulary allows it, else four), a document's ids followed by the end id.  A
file is written under a temporary name and renamed.  The manifest (a Parquet
table) has a row a file; the directory (another) a row a document: its key, file, first
id and number of ids.

Index.  Keys are split into buckets by hash, about ``bucket_keys`` each, and every
bucket gets a minimal perfect hash of its own, built by one task: keys are
thrown at a bit table, those that meet no other key stay, the rest go to the next
table; a key's place is the rank of its bit over all tables.  At that place the
index stores the key's 32-bit fingerprint and its file, first id and length.  A
lookup reads a few bits and one place, whatever the size of the corpus, and a
key that is not there fails the fingerprint (with probability 1 - 2^-32).

Reading.  Keys meet their bucket's tables in a join; the places found are
dealt to the files' readers, which read each file front to back.

Defined results: a null text has no words, so only the end id; a null id is a key of its own; rows that repeat an id are all
written, in a fixed order, and are told apart in the index by their ordinal under that id; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Stages, mix64, open_store, partitions, pick, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BUCKET_KEYS = 50_000
CACHE_PIECES = 800_000

_U = np.uint64


# --- encoding ---------------------------------------------------------------

class _Pieces(dict):
    """piece -> ids as bytes; a piece not seen before is encoded on look-up."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        # punctuation after a letter is always a piece of its own
        stem = piece.rstrip(_PUNCTUATION)
        if stem and stem != piece and stem[-1].isalpha() and "|>" not in piece:
            ids = self[stem] + self[piece[len(stem):]]
        else:
            ids = self.encode(piece)
        self[piece] = ids
        return ids


_PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[]^_`{|}~'
#: Letters up to here have no composed forms to make and lower one by one.
_NOT_PLAIN = re.compile("[\u0130\u0250-\U0010ffff]")


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    ones stand for themselves, the others come from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, other = [""] * 256, 0
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], other = chr(0x100 + other), other + 1
    return out


_BYTE_LETTERS = _byte_letters()


class Encoder:
    """ids of a text by the tokenizers library, as bytes.

    The vocabulary's rules drop white space and never join across it, part
    letters from punctuation, and lower letters first, so a text's ids are those
    of its space-separated pieces in a row, and plain letters may be lowered
    beforehand.  Pieces that come again are looked up instead of encoded again.
    ``_separable`` checks that the tokenizer's rules are these; without them
    whole texts are encoded.
    """

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.separable = self._separable()
        self.pieces = _Pieces(self._ids_of_piece, cache_pieces)

    def _separable(self) -> bool:
        import json
        rules = json.loads(self.tokenizer.to_str())
        norm = [x.get("type") for x in (rules["normalizer"] or {}).get("normalizers", [])]
        steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (norm == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"]
                and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["add_prefix_space"]
                and steps[0]["pattern"]["Regex"].endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
                and all(x["content"].endswith("|>") and " " not in x["content"] for x in rules["added_tokens"]))

    def _bytes(self, ids: list[int]) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _ids_of_piece(self, piece: str) -> bytes:
        if piece.isalpha() and not _NOT_PLAIN.search(piece):  # one run of letters: nothing is left to split
            letters = piece.lower()
            if not letters.isascii():
                letters = "".join(_BYTE_LETTERS[b] for b in letters.encode())
            return self._bytes([t.id for t in self.tokenizer.model.tokenize(letters)])
        return self._bytes(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        if not self.separable:
            return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if text.isascii() or not _NOT_PLAIN.search(text):
            text = text.lower()
        return b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process, so that its cache lasts over tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- payload files ----------------------------------------------------------

_DIRECTORY = "key long, no int, ordinal long, file string, part int, first long, n long, width int"


def _write_part(root: str, path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        store, base = open_store(root)
        name = f"ids-{part:06d}.bin"
        temp, out, at, enc = f"{base}/.{name}.{uuid.uuid4().hex}", None, 0, None
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["key"], pdf["text"], strict=True):
                if out is None:
                    enc = encoder(path)
                    out = store.open_output_stream(temp, compression=None)
                ids = (enc(text) if text else b"") + np.asarray([end_id], enc.dtype).tobytes()
                out.write(ids)
                n = len(ids) // enc.dtype.itemsize
                rows.append((key, name, part, at, n, enc.dtype.itemsize))
                at += n
            yield pd.DataFrame(rows, columns=["key", "file", "part", "first", "n", "width"]).astype({"key": "Int64"})
        if out is not None:
            out.close()
            store.move(temp, f"{base}/{name}")
    return run


def write_ids(stages: Stages, docs: DataFrame, root: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode docs(key, text) in ascending key order into files under ``root``;
    returns the directory (key, file, part, first, n, width)."""
    store, base = open_store(root)
    store.create_dir(base, recursive=True)
    n = partitions(docs.sparkSession)
    ranged = docs.repartitionByRange(n, "key").sortWithinPartitions("key", F.xxhash64("text"))
    return stages.save(ranged.mapInPandas(_write_part(root, tokenizer_path, end_id),
                                          "key long, file string, part int, first long, n long, width int"), "directory")


# --- minimal perfect hash ---------------------------------------------------

def hash_key(key: np.ndarray, ordinal: np.ndarray) -> np.ndarray:
    return mix64(key.astype(np.int64).view(np.uint64) + mix64(ordinal.astype(np.int64).view(np.uint64) + _U(0x9E3779B97F4A7C15)))


class PerfectHash:
    """Places 0..n-1 for n distinct 64-bit hashes: levels of bit tables.

    On each level the hashes left fall into a table of twice their number;
    a slot hit once is taken, the others' hashes go on with another seed.  Two equal hashes
    would never part: that many levels raise an error."""

    MOST_LEVELS = 64

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = np.asarray(sizes, np.int64), np.asarray(words, np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(ones)])
        self.start = np.concatenate([[0], np.cumsum(self.sizes // 64)])

    @staticmethod
    def _slot(h: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(h + _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % _U(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(h):
            if len(sizes) == cls.MOST_LEVELS:
                raise ValueError("two keys have the same hash")
            size = -(-2 * len(h) // 64) * 64
            slot = cls._slot(h, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            h = h[~alone[slot]]
        return cls(np.asarray(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where no level takes it (no such key)."""
        place = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        for level, size in enumerate(self.sizes):
            slot = self._slot(h[todo], level, int(size))
            word = self.start[level] + slot // 64
            bit = (slot % 64).astype(np.uint64)
            hit = (self.words[word] >> bit) & _U(1) == 1
            below = np.bitwise_count(self.words[word] & ((_U(1) << bit) - _U(1))).astype(np.int64)
            place[todo[hit]] = (self.rank[word] + below)[hit]
            todo = todo[~hit]
        return place


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (mix64(h ^ _U(0xD1B54A32D192ED03)) >> _U(32)).astype("<u4")


_INDEX = "bucket long, sizes binary, words binary, prints binary, parts binary, firsts binary, lengths binary, width int"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    h = hash_key(pdf["k"].to_numpy(np.int64), pdf["ordinal"].to_numpy(np.int64))
    perfect = PerfectHash.build(h)
    place = perfect(h)
    put = lambda values, dtype: (lambda a: (a.__setitem__(place, values), a.tobytes())[1])(np.empty(len(h), dtype))
    return pd.DataFrame([{
        "bucket": pdf["bucket"].iloc[0], "sizes": perfect.sizes.astype("<i8").tobytes(),
        "words": perfect.words.astype("<u8").tobytes(), "prints": put(fingerprint(h), "<u4"),
        "parts": put(pdf["part"].to_numpy(), "<i4"), "firsts": put(pdf["first"].to_numpy(), "<i8"),
        "lengths": put(pdf["n"].to_numpy(), "<i8"), "width": pdf["width"].iloc[0]}])


def _keys(df: DataFrame, buckets: int) -> DataFrame:
    """key -> k (null is the smallest long), bucket."""
    return (df.withColumn("k", F.coalesce(F.col("key"), F.lit(-(1 << 63))))
            .withColumn("bucket", F.pmod(F.xxhash64("k", "ordinal"), F.lit(buckets))))


def with_ordinal(directory: DataFrame) -> DataFrame:
    """Number the rows that repeat a key; rows of single keys are not sorted for it."""
    w = W.partitionBy("key").orderBy("part", "first")
    return directory.withColumn("ordinal", (F.row_number().over(w) - 1).cast("long"))


def build_index(directory: DataFrame, buckets: int) -> DataFrame:
    """directory with ordinals -> one row a bucket: bit tables, fingerprints, places."""
    return _keys(directory, buckets).groupBy("bucket").applyInPandas(_build, _INDEX)


def lookup(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """keys(key, ordinal) -> those found, with part, first, n, width."""
    def find(wanted: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if not len(entry) or not len(wanted):
            return pd.DataFrame({c: [] for c in ("key", "ordinal", "part", "first", "n", "width")})
        e = entry.iloc[0]
        h = hash_key(wanted["k"].to_numpy(np.int64), wanted["ordinal"].to_numpy(np.int64))
        place = PerfectHash(np.frombuffer(e["sizes"], "<i8"), np.frombuffer(e["words"], "<u8"))(h)
        known = place >= 0
        known[known] = np.frombuffer(e["prints"], "<u4")[place[known]] == fingerprint(h[known])
        wanted, place = wanted[known], place[known]
        return pd.DataFrame({"key": wanted["key"].to_numpy(), "ordinal": wanted["ordinal"].to_numpy(),
                             "part": np.frombuffer(e["parts"], "<i4")[place], "first": np.frombuffer(e["firsts"], "<i8")[place],
                             "n": np.frombuffer(e["lengths"], "<i8")[place], "width": e["width"]})
    return (_keys(keys, buckets).groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInPandas(find, "key long, ordinal long, part int, first long, n long, width int"))


def _read(root: str, what):
    """mapInPandas over places in (part, first) order; what(ids) -> dict of columns."""
    def run(batches):
        store, base = open_store(root)
        part, stream = None, None
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if r.part != part:
                    if stream:
                        stream.close()
                    part, stream = r.part, store.open_input_file(f"{base}/ids-{r.part:06d}.bin")
                data = stream.read_at(r.n * r.width, r.first * r.width)
                if len(data) != r.n * r.width:
                    raise ValueError(f"ids-{r.part:06d}.bin ends before document {r.key}")
                rows.append(what(np.frombuffer(data, f"<u{r.width}")))
            got = pd.DataFrame(rows)
            yield pd.concat([pdf.reset_index(drop=True), got], axis=1).astype({"key": "Int64"})
    return run


def read_ids(places: DataFrame, root: str) -> DataFrame:
    """places -> with ``ids``: the document's ids."""
    schema = "key long, ordinal long, part int, first long, n long, width int, ids array<long>"
    return _by_file(places).mapInPandas(_read(root, lambda ids: {"ids": ids.astype(np.int64)}), schema)


def _by_file(places: DataFrame) -> DataFrame:
    cols = ["key", "ordinal", "part", "first", "n", "width"]
    return (places.select(*cols).repartition(partitions(places.sparkSession), "part")
            .sortWithinPartitions("part", "first"))


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    stages = Stages(spark, "token-ids")
    root = stages.path("payload")
    docs = pick(table(spark, sf_dir, "documents"), key="doc_id", text="text")
    return documents_in(stages, docs, root, public_tokenizers.path(VOCABULARY))


def documents_in(stages: Stages, docs: DataFrame, root: str, tokenizer_path: str,
                 bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Write, index, look every key up and read its ids back: one row a document."""
    directory = write_ids(stages, docs, root, tokenizer_path)
    numbered = stages.save(with_ordinal(directory), "numbered")
    count = numbered.count()
    buckets = max(1, -(-count // bucket_keys))
    index = stages.save(build_index(numbered, buckets), "index")
    places = lookup(numbered.select("key", "ordinal"), index, buckets)
    crc = lambda ids: {"crc": zlib.crc32(ids.astype("<u4").tobytes())}
    read = _by_file(places).mapInPandas(
        _read(root, crc), "key long, ordinal long, part int, first long, n long, width int, crc long")
    # files are in key order: a document starts after the files before its own
    files = directory.groupBy("part").agg(F.sum("n").alias("ids"))
    before = files.select("part", F.coalesce(F.sum("ids").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return read.join(before, "part").select(
        F.col("key").alias("doc_id"), (F.col("before") + F.col("first")).cast("long").alias("start"),
        F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
