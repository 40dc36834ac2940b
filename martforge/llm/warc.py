"""Deterministic sharded WARC writer and its reader.

1. A light table (page_id, size, SHA-1) is written in key order; a running sum
   of sizes over that total order gives every record its shard, so the shards
   depend on the records alone, not on the number of tasks.
2. Of equal payloads the one with the smallest page_id is stored; the others
   become ``revisit`` records that point to it.
3. One shuffle brings every shard's records together, sorted.  A task streams
   them into files under a temporary name, one gzip member per record, and
   rolls to the next file at a compressed size.
4. The written names go through a manifest table.  Only what the manifest
   names (one successful attempt per shard) is renamed to its final name, and
   the manifest itself is moved into place last: that is the commit.  A reader
   opens only files of the committed manifest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from martforge.llm.common import Scratch, read

SHARD_BYTES = 32 << 20  # payload of a shard, before compression
ROLL_BYTES = 8 << 20  # compressed size at which a file is closed
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # records carry no fetch time, so the date is fixed
MANIFEST = "shard long, seq int, temporary string, final string, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that pyarrow knows by its address (file, hdfs, s3, gs, ...)."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _record(page_id, url, payload: bytes | None, n: int, digest: str, refers_to) -> bytes:
    """One WARC record.  A revisit keeps the HTTP head (with the payload's length) and drops the payload."""
    revisit = payload is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Roller:
    """Files of one shard: opened on demand, closed once they hold ``roll`` compressed bytes."""

    def __init__(self, out: str, shard: int, roll: int):
        self.fs, self.root = _fs(out)
        self.shard, self.roll, self.seq = shard, roll, 0
        self.file = None

    def write(self, record: bytes) -> tuple | None:
        if self.file is None:
            name = f"shard-{self.shard:07d}-{self.seq:05d}.warc.gz"
            self.names = (f"_temporary/{name}.{uuid.uuid4().hex}", name)
            self.file = self.fs.open_output_stream(f"{self.root}/{self.names[0]}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = member.compress(record) + member.flush()
        self.file.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1
        return self.close() if self.size >= self.roll else None

    def close(self) -> tuple | None:
        if self.file is None:
            return None
        self.file.close()
        self.file = None
        self.seq += 1
        return (self.shard, self.seq - 1, *self.names, self.records, self.size, self.sha.hexdigest())


def write_archive(pages: DataFrame, out: str, least_revisit: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a WARC record per row of (page_id, url, html) under ``out``; returns the committed manifest.

    A null html is an empty payload.  Payloads of fewer than ``least_revisit``
    bytes are all stored.  Null page_ids sort first and are never referred to
    while an equal payload has an id; rows that repeat the smallest page_id of
    a payload are all stored.  An empty table gives an empty manifest."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    light = rows.select("page_id", F.octet_length("html").cast("long").alias("n"), F.sha1(F.encode("html", "utf-8")).alias("sha1"))
    ordered = scratch.save(
        light.repartitionByRange("page_id", "sha1").withColumn("part", F.spark_partition_id()), "sizes")
    shares = sorted((r["part"], r["n"]) for r in ordered.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one row a task
    before, total = {}, 0
    for part, n in shares:
        before[part] = total
        total += n
    offsets = spark.createDataFrame(list(before.items()) or [(-1, 0)], "part int, before long")
    running = Window.partitionBy("part").orderBy("page_id", "sha1").rowsBetween(Window.unboundedPreceding, -1)
    placed = (ordered.join(F.broadcast(offsets), "part")
              .withColumn("shard", F.floor((F.col("before") + F.coalesce(F.sum("n").over(running), F.lit(0))) / shard_bytes)))
    borders = placed.groupBy("shard").agg(F.min(F.coalesce("page_id", F.lit(-(1 << 63)))).alias("least")).collect()  # one row a shard
    edges = spark.sparkContext.broadcast(np.sort(np.array([r["least"] for r in borders] or [-(1 << 63)], np.int64)))

    @F.pandas_udf("long")
    def shard_of(ids: pd.Series) -> pd.Series:
        keys = ids.fillna(-(1 << 63)).astype("int64").to_numpy()
        return pd.Series(np.maximum(np.searchsorted(edges.value, keys, "right") - 1, 0))

    originals = (ordered.filter(F.col("n") >= least_revisit).groupBy("sha1", "n")
                 .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies")).filter("copies > 1 AND refers_to IS NOT NULL"))
    repeats = (ordered.join(originals, ["sha1", "n"]).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
               .select("page_id", "sha1", "refers_to").distinct())
    marks = repeats.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "sha1",
                           F.lit(0).alias("kind"), "refers_to")
    records = rows.select("page_id", "url", "html", F.sha1(F.encode("html", "utf-8")).alias("sha1"), F.lit(1).alias("kind"),
                          F.lit(None).cast("long").alias("refers_to"))
    shards = max(1, len(borders))
    keyed = (records.unionByName(marks).withColumn("shard", shard_of("page_id")).repartition(4 * shards, "shard")
             .sortWithinPartitions("shard", "page_id", "sha1", "kind", "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, mark, done = None, None, []
        for batch in batches:
            for shard, page_id, url, text, sha1, kind, refers_to in zip(*(c.to_pylist() for c in (
                    batch["shard"], batch["page_id"], batch["url"], batch["html"], batch["sha1"], batch["kind"], batch["refers_to"]))):
                if kind == 0:
                    mark = (page_id, sha1, refers_to)
                    continue
                if roller is None or roller.shard != shard:
                    done.append(roller and roller.close())
                    roller = _Roller(out, shard, roll_bytes)
                payload = text.encode()
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                original = mark[2] if mark is not None and mark[:2] == (page_id, sha1) else None
                done.append(roller.write(_record(page_id, url, None if original is not None else payload, len(payload), digest, original)))
        done.append(roller and roller.close())
        done = [d for d in done if d]
        if done:
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=[f.split()[0] for f in MANIFEST.split(", ")])

    fs, root = _fs(out)
    fs.create_dir(f"{root}/_temporary", recursive=True)
    keyed.mapInArrow(write, MANIFEST).write.parquet(f"{out}/_manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{out}/_manifest")

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            store, top = _fs(out)
            for temporary, final in zip(batch["temporary"].to_pylist(), batch["final"].to_pylist()):
                if store.get_file_info(f"{top}/{temporary}").type != pafs.FileType.NotFound:  # a retried task finds it moved
                    store.move(f"{top}/{temporary}", f"{top}/{final}")
            yield batch.select(["final"])

    manifest.repartition("final").mapInArrow(publish, "final string").count()
    fs.move(f"{root}/_manifest", f"{root}/manifest")  # the commit
    fs.delete_dir(f"{root}/_temporary")  # what lost attempts left
    scratch.drop(ordered)
    return spark.read.schema(MANIFEST).parquet(f"{out}/manifest")


def _members(stream) -> Iterator[bytes]:
    """Records of a file, one gzip member at a time."""
    inflate, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(inflate.decompress(chunk))
            chunk = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends inside a record")


def _parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    if fields["warc-block-digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError(f"block digest of {fields['warc-record-id']} does not match")
    http, _, payload = block.partition(b"\r\n\r\n")
    ident = lambda urn: None if urn is None or urn.endswith(":null>") else int(urn.rsplit(":", 1)[1][:-1])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError(f"payload digest of {fields['warc-record-id']} does not match")
    return {
        "page_id": ident(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "payload": payload.decode() if kind == "response" else None,
        "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]), "payload_digest": digest,
        "record_type": kind, "refers_to": ident(fields.get("warc-refers-to"))}


def read_archive(spark: SparkSession, out: str, payloads: bool = True) -> DataFrame:
    """Records of a committed archive, both digests checked; a revisit's payload is null (it stands at refers_to).

    ``payloads=False`` checks the same and leaves the payload column null."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{out}/manifest")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fs, root = _fs(out)
            for name in batch["final"].to_pylist():
                found, size = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        row = _parse(member)
                        if not payloads:
                            row["payload"] = None
                        found.append(row)
                        size += len(member) if payloads else 200
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, size = [], 0
                yield pa.RecordBatch.from_pylist(found, schema)

    files = manifest.select("final").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "final")
    return files.mapInArrow(records, RECORDS)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Scratch(spark, "archive").path("warc")
    write_archive(read(spark, sf_dir, "pages"), out)
    return read_archive(spark, out, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS s FROM p),
c AS (SELECT s, min(page_id) AS least FROM h GROUP BY s)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((('0x' || substr(h.s, 1 + 5 * (i // 4), 5))::BIGINT // CAST(power(32, 3 - i % 4) AS BIGINT)) % 32 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
FROM h JOIN c ON c.s = h.s
"""
