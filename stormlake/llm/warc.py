"""WARC: a deterministic sharded writer and its reader.

Writing
1. Payload digests (SHA-1) are taken over the full payloads; of records with
   equal payloads of at least ``min_revisit`` bytes the one with the largest key is the
   response, the others are revisits that refer to it and carry no payload.
2. Records are ordered by key and digest.  A running total of what is sent of them (their full
   payloads, also of revisits) in that order cuts them into volumes of about ``volume_bytes``: where a volume begins
   depends on the records alone, not on the cluster.  Records of one key may lie in several volumes,
   those that repeat key and payload in one.
3. Each volume is written by one task as gzip members, one a record, into files
   that roll at ``roll_bytes`` compressed bytes.  Headers (ids, dates, lengths, digests)
   are made anew from the payloads, so the same records give the same bytes.
4. A file is written under a temporary name and then renamed; the names of the
   finished files go into a manifest, a Parquet table committed last.  A retried
   task writes the same bytes under the same names; what lost tasks leave behind
   is in no manifest and is never read.

Reading goes by the manifest: files are dealt to tasks, read member by member,
and their length and SHA-1 checked against the manifest and each payload
against its digest.

Defined results: a null payload is empty; a null key is the smallest key (kept as
null); equal payloads under one key that is the group's largest are responses all;
an empty table gives an empty manifest; other columns are never looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stages, open_store, partitions, pick, table, with_running_total

VOLUME_BYTES = 32 << 20
ROLL_BYTES = 4 << 20
MOST_VOLUMES = 1 << 16
MIN_REVISIT = 0
_NULL_KEY = -(1 << 63)
DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of capture
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "file string, volume long, no int, records long, bytes long, sha1 string, first_key long, last_key long"
_RECORD = "key long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def decide(stages: Stages, pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """pages(key, payload) -> (key, digest, n, refers_to), a row a record, without payloads."""
    body = F.coalesce(F.col("payload"), F.lit(b""))
    rows = stages.save(pages.select("key", F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("n")), "digests")
    # one row for a digest that several records share; records without one are responses
    groups = (rows.where(F.col("n") >= min_revisit).groupBy("digest", "n")
              .agg(F.max("key").alias("response"), F.count(F.lit(1)).alias("copies"))
              .where((F.col("copies") > 1) & F.col("response").isNotNull()).drop("copies"))
    other = ~F.col("key").eqNullSafe(F.col("response"))
    return rows.join(groups, ["digest", "n"], "left").select(
        "key", "digest", "n", F.when(other & F.col("response").isNotNull(), F.col("response")).alias("refers_to"))


def _headers(pairs) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in pairs) + b"\r\n"


def record(key, url, payload: bytes, digest_hex: str, n: int, refers_to) -> bytes:
    """One record's bytes: WARC headers, the HTTP head with the full payload's
    length, and the payload unless this is a revisit."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", n)])
    name = "null" if key is None else key
    kind = "response" if refers_to is None else "revisit"
    url = "".join(c for c in (url or "") if c.isprintable())  # a line break would end the header
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:record:{name}>"), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", url)] if url else []
    fields += [("WARC-Payload-Digest", digest)]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:record:{refers_to}>")]
        payload = b""
    block = http + payload
    fields += [("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + _headers(fields) + block + b"\r\n\r\n"


class _File:
    """A file of the archive while it is written: temporary name, then renamed."""

    def __init__(self, root: str, volume: int, no: int):
        self.store, base = open_store(root)
        self.name, self.volume, self.no = f"volume-{volume:08d}-{no:05d}.warc.gz", volume, no
        self.final = f"{base}/{self.name}"
        self.temp = f"{base}/.{self.name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temp, compression=None)
        self.bytes = self.records = 0
        self.sha1, self.first, self.last = hashlib.sha1(), None, None

    def add(self, key, data: bytes) -> None:
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.sha1.update(member)
        self.bytes += len(member)
        self.first = key if self.records == 0 else self.first
        self.last = key
        self.records += 1

    def commit(self) -> tuple:
        self.out.close()
        self.store.move(self.temp, self.final)
        return self.name, self.volume, self.no, self.records, self.bytes, self.sha1.hexdigest(), self.first, self.last


def _assign(bounds: list[tuple[int, str]]):
    """mapInArrow: add each row's volume, the last one that begins at its (key, digest) or before."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            keys = pc.fill_null(batch.column("key"), _NULL_KEY).to_pylist()
            volume = [max(bisect_right(bounds, x) - 1, 0) for x in zip(keys, batch.column("digest").to_pylist(), strict=True)]
            yield batch.append_column("volume", pa.array(volume, pa.int64()))
    return run


def _writer(root: str, roll_bytes: int):
    """mapInArrow over rows sorted by (volume, key, digest, kind): a plan row
    comes before the pages it is about."""
    def run(batches):
        import pyarrow as pa
        manifest = pa.schema([("file", pa.string()), ("volume", pa.int64()), ("no", pa.int32()), ("records", pa.int64()),
                              ("bytes", pa.int64()), ("sha1", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64())])
        file, plan, done = None, None, []
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for r in batch.slice(lo, 256).to_pylist():
                    if r["kind"] == 0:
                        plan = r
                        continue
                    if file and (file.volume != r["volume"] or file.bytes >= roll_bytes):
                        done.append(file.commit())
                        same = file.volume == r["volume"]
                        file = _File(root, r["volume"], file.no + 1 if same else 0)
                    file = file or _File(root, r["volume"], 0)
                    file.add(r["key"], record(r["key"], r["url"], r["payload"] or b"", r["digest"], plan["n"], plan["refers_to"]))
        if file:
            done.append(file.commit())
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(manifest.names, d, strict=True)) for d in done], schema=manifest)
    return run


def write_warc(pages: DataFrame, root: str, volume_bytes: int = VOLUME_BYTES, roll_bytes: int = ROLL_BYTES,
               min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write pages(key, url, payload) under ``root``; returns the manifest.

    There are at most MOST_VOLUMES volumes (larger ones if need be), so the list
    of the (key, digest) they begin at stays small; by it the pages are dealt out in one
    shuffle, together with the plan's rows.  Volumes are cut by the bytes that are sent to their
    tasks, those of pages that become revisits included."""
    spark = pages.sparkSession
    stages = Stages(spark, "warc")
    store, base = open_store(root)
    store.create_dir(base, recursive=True)
    plan = stages.save(decide(stages, pages, min_revisit).withColumn("size", F.col("n") + 512), "plan")
    total = plan.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    volume_bytes = max(volume_bytes, -(-total // MOST_VOLUMES))
    at = F.struct(F.coalesce("key", F.lit(_NULL_KEY)).alias("key"), "digest")
    cut = with_running_total(stages, plan.select("key", "digest", "size"), ["key", "digest"], "size", "before").groupBy(
        F.floor(F.col("before") / volume_bytes).alias("volume")).agg(F.min(at).alias("first"))
    bounds = sorted(tuple(r["first"]) for r in cut.collect())

    body = F.coalesce(F.col("payload"), F.lit(b""))
    rows = pages.select("key", F.sha1(body).alias("digest"), F.lit(1).alias("kind"), "url", "payload",
                        F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("refers_to"))
    about = plan.select("key", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                        F.lit(None).cast("binary").alias("payload"), "n", "refers_to").distinct()
    dealt = about.unionByName(rows).mapInArrow(
        _assign(bounds), "key long, digest string, kind int, url string, payload binary, n long, refers_to long, volume long")
    # a task a volume
    dealt = dealt.repartitionById(max(1, len(bounds)), F.col("volume").cast("int")).sortWithinPartitions("volume", "key", "digest", "kind")
    dealt.mapInArrow(_writer(root, roll_bytes), _MANIFEST).write.mode("overwrite").parquet(f"{root}/_manifest")
    stages.keep()
    return spark.read.parquet(f"{root}/_manifest")


def parse(data: bytes) -> dict:
    """One record's fields; raises if its payload is not what its digest says."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: payload and digest differ")
    number = lambda x: None if x is None or x == "<urn:record:null>" else int(x[len("<urn:record:"):-1])
    return {"key": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": number(fields.get("WARC-Refers-To")), "payload_bytes": n, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def _members(stream, sha1):
    """The gzip members of a stream, unpacked one at a time."""
    unpack, parts, rest = None, [], b""
    while data := rest or stream.read(1 << 20):
        if not rest:
            sha1.update(data)
        unpack = unpack or zlib.decompressobj(31)
        parts.append(unpack.decompress(data))
        rest = b""
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts, rest = None, [], unpack.unused_data
    if unpack:
        raise ValueError("the last gzip member is cut off")


def _reader(root: str, payloads: bool):
    def run(batches):
        for pdf in batches:
            for f in pdf.itertuples():
                store, base = open_store(root)
                sha1, rows = hashlib.sha1(), []
                with store.open_input_stream(f"{base}/{f.file}", compression=None) as stream:
                    for data in _members(stream, sha1):
                        r = parse(data)
                        rows.append(r if payloads else r | {"payload": None})
                        if len(rows) >= (200 if payloads else 5000):
                            yield _frame(rows)
                            rows = []
                if sha1.hexdigest() != f.sha1:
                    raise ValueError(f"{f.file} is not the file that was written")
                yield _frame(rows)
    return run


def _frame(rows) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=[x.split()[0] for x in _RECORD.split(", ")])
    return pdf.astype({"key": "Int64", "refers_to": "Int64"})


def read_warc(manifest: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """Every record of the archive's files; each file is a task's own input."""
    files = manifest.select("file", "sha1").repartition(partitions(manifest.sparkSession), "file")
    return files.mapInPandas(_reader(root, payloads), _RECORD)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pick(table(spark, sf_dir, "pages"), key="page_id", url="url", payload=F.encode("html", "UTF-8"))
    root = Stages(spark, "warc").path("archive")
    return read_warc(write_warc(pages, root), root, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, strlen(html) AS n, sha1(html) AS s, max(page_id) OVER (PARTITION BY html) AS response FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(s, CAST(1 + 5 * (i // 4) AS BIGINT), 5))::INTEGER >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM g
"""
