r"""Deterministic sharded WARC writer, and a reader of its archives.

Records are range-sorted by page id into shards. Bounds come from a hash sample of
the ids weighted by payload size, so equal tables give equal shards on any cluster;
an id that fills several shards is dealt over them by payload digest. A task writes
its shards one record at a time (one gzip member each), regenerates every header and
digest, and starts the next file once the compressed size is reached.

Files are written under temporary names of their own attempt. Spark's committer
keeps the manifest rows of successful tasks only; a second job renames the files
named there and may be repeated; the manifest in the output folder is written last
and makes the archive valid. Files of lost attempts are never named and go with the
temporary folder.

Records of equal payloads of ``min_dedup_bytes`` or more: the smallest page id is the
response and the others revisit it. Only (id, digest) pairs are joined for that; the
answer travels as small marker rows with the one shuffle of the payloads.

Defined results: a null payload is empty; a null url is written as urn:page:ID; a row
with a null id has no id header and is never the response of a group that has ids;
rows that repeat both id and payload are each written, as the same type; an empty
table gives an archive without files. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from gridpanel.llm.common import written

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

SHARD_BYTES = 16 << 20      # payload of a shard at least
MAX_SHARDS = 20_000         # beyond, shards grow
FILE_SHARE = 8              # a file ends at this part of a shard's payload, compressed
SAMPLE_IDS = 20_000         # ids read by the driver for the bounds, about
MANIFEST = "shard int, seq int, temporary string, name string, records bigint, bytes bigint, sha256 string"


# ---- record format ---------------------------------------------------------------

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _uri(page_id: int | None, url: str | None) -> str:
    if url is None:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _block(fields: list[tuple[str, str]], content: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{head}Content-Length: {len(content)}\r\n\r\n".encode() + content + b"\r\n\r\n"


def render(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str) -> bytes:
    """One WARC record: a response, or a revisit of ``refers_to`` without its payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    content = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
              ("WARC-Target-URI", _uri(page_id, url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(content).hexdigest()}")]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("X-Refers-To-Page-Id", str(refers_to))]
    return _block([*fields, ("Content-Type", HTTP_TYPE)], content)


def warcinfo(name: str, date: str) -> bytes:
    return _block([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", date),
                   ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                  b"format: WARC File Format 1.1\r\n")


def member(data: bytes, level: int) -> bytes:
    """A gzip member with a fixed header, so that equal records are equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The unpacked gzip members of a stream, one at a time."""
    rest = b""
    while rest or (rest := stream.read(chunk)):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest and not (rest := stream.read(chunk)):
                raise ValueError("the archive ends within a record")
            parts.append(unpack.decompress(rest))
            rest = unpack.unused_data
        yield b"".join(parts)


def parse(record: bytes) -> dict:
    """Headers of a record in lower case, and its content under ''."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(out["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{out.get('warc-record-id')}: Content-Length does not fit the record")
    out[""] = rest[:size]
    return out


# ---- writing ---------------------------------------------------------------------

class ShardFiles:
    """Files of the shards that one task writes, under temporary names."""

    def __init__(self, base: str, file_bytes: int, level: int, date: str):
        self.fs, self.path = pafs.FileSystem.from_uri(base)
        self.file_bytes, self.level, self.date = file_bytes, level, date
        self.attempt = uuid.uuid4().hex
        self.shard, self.seq, self.out = -1, 0, None
        self.fs.create_dir(f"{self.path}/_temporary", recursive=True)

    def _open(self) -> None:
        self.name = f"part-{self.shard:06d}-{self.seq:04d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{self.attempt}"
        self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
        self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        self._put(warcinfo(self.name, self.date))

    def _put(self, record: bytes) -> None:
        data = member(record, self.level)
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield (self.shard, self.seq, self.temporary, self.name, self.records, self.bytes, self.sha.hexdigest())
            self.seq += 1

    def add(self, shard: int, record: bytes) -> Iterator[tuple]:
        if shard != self.shard or self.out is not None and self.bytes >= self.file_bytes:
            yield from self.close()
            if shard != self.shard:
                self.shard, self.seq = shard, 0
        if self.out is None:
            self._open()
        self._put(record)
        self.records += 1


def _bounds(slim: DataFrame, shard_bytes: int) -> tuple[np.ndarray, int]:
    """(ids between shards, from a sample by hash that depends on the ids alone; payload of
    a shard, about)."""
    whole = slim.agg(F.count("page_id").alias("n"), F.sum("size").alias("b")).first()
    n = min(MAX_SHARDS, max(1, -(-int(whole.b or 0) // shard_bytes)))
    payload = max(shard_bytes, int(whole.b or 0) // n)
    if n == 1 or not whole.n:
        return np.zeros(0, np.int64), payload
    every = max(1, whole.n // SAMPLE_IDS)
    sample = (slim.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0))
              .groupBy("page_id").agg(F.sum(F.col("size") + 1).alias("w")).orderBy("page_id").toPandas())
    if not len(sample):
        return np.zeros(0, np.int64), payload
    share = sample.w.cumsum().to_numpy() / sample.w.sum()
    at = np.searchsorted(share, np.arange(1, n) / n, "left")
    return sample.page_id.to_numpy()[at].astype(np.int64), payload


def _shard_of(bounds: np.ndarray):
    @pandas_udf("int")
    def shard(page_id: pd.Series, digest: pd.Series) -> pd.Series:
        ids = page_id.fillna(np.iinfo(np.int64).min).astype(np.int64).to_numpy()
        lo, hi = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
        salt = np.fromiter((int(d[:8], 16) for d in digest), np.int64, len(digest))
        return pd.Series((lo + salt % (hi - lo + 1)).astype(np.int32))
    return shard


def write_warc(pages: DataFrame, out: str, min_dedup_bytes: int = 100, shard_bytes: int = SHARD_BYTES,
               file_bytes: int | None = None, level: int = 6, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the pages' archive below the folder ``out`` and return its manifest. A file ends
    at ``file_bytes`` compressed; if that is not given, at an eighth of a shard's payload, so
    that a shard is a few files however large shards are."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("html")).withColumn("digest", F.sha2("html", 256))
    slim = written(spark, rows.select("page_id", "digest", F.octet_length("html").alias("size")), "warc-ids")
    bounds, payload = _bounds(slim, shard_bytes)
    file_bytes = file_bytes or max(1, payload // FILE_SHARE)
    shard = _shard_of(bounds)
    firsts = (slim.where(F.col("size") >= min_dedup_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null"))
    markers = (slim.join(firsts, "digest").where("page_id is null or page_id > refers_to")
               .select("page_id", "digest", "refers_to").distinct())
    full = rows.select("page_id", "digest", F.lit(None).cast("long").alias("refers_to"), "url", "html",
                       F.lit(1).alias("kind"))
    both = full.unionByName(markers.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    dealt = (both.withColumn("shard", shard("page_id", "digest")).repartition(len(bounds) + 1, "shard")
             .sortWithinPartitions("shard", "page_id", "digest", "kind", "url"))

    def write(batches):
        files, at, refers = ShardFiles(out, file_bytes, level, date), None, None

        def manifest(found):
            return pa.RecordBatch.from_pylist(
                [dict(zip([f.split()[0] for f in MANIFEST.split(", ")], x, strict=True)) for x in found], schema)

        schema = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("temporary", pa.string()),
                            ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
                            ("sha256", pa.string())])
        for batch in batches:
            done = []
            names = ("shard", "page_id", "digest", "refers_to", "url", "kind")
            html = batch.column("html").cast(pa.binary())
            for i, (s, page_id, digest, to, url, kind) in enumerate(
                    zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
                if kind == 0:
                    at, refers = (page_id, digest), to
                    continue
                to = refers if at == (page_id, digest) else None
                done += files.add(s, render(page_id, url, html[i].as_py(), digest, to, date))
            yield manifest(done)
        yield manifest(list(files.close()))

    made = written(spark, dealt.mapInArrow(write, MANIFEST), "warc-manifest")
    return commit(made, out)


def commit(made: DataFrame, out: str) -> DataFrame:
    """Rename the files that the manifest names, then write the manifest beside them.
    A rename that an earlier attempt has done already is left as it is."""
    def rename(batches):
        fs, path = pafs.FileSystem.from_uri(out)
        for batch in batches:
            for tmp, name, size in zip(*(batch.column(c).to_pylist() for c in ("temporary", "name", "bytes")),
                                       strict=True):
                if fs.get_file_info(f"{path}/{tmp}").type != pafs.FileType.NotFound:
                    fs.move(f"{path}/{tmp}", f"{path}/{name}")
                elif fs.get_file_info(f"{path}/{name}").size != size:
                    raise FileNotFoundError(f"{out}/{tmp}")
            yield batch

    made.mapInArrow(rename, made.schema).drop("temporary").write.mode("overwrite").json(f"{out}/manifest")
    fs, path = pafs.FileSystem.from_uri(out)
    if fs.get_file_info(f"{path}/_temporary").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{path}/_temporary")
    return made.sparkSession.read.schema(made.drop("temporary").schema).json(f"{out}/manifest")


# ---- reading ---------------------------------------------------------------------

RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint")


def read_warc(spark: SparkSession, out: str, payloads: bool = False) -> DataFrame:
    """Records of a committed archive, each checked against its digests. ``payloads``
    adds the payload of responses (null for revisits)."""
    manifest = spark.read.schema(MANIFEST).json(f"{out}/manifest")
    columns = RECORD + (", payload binary" if payloads else "")
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema([*fields, *([("payload", pa.binary())] if payloads else [])])

    def read(batches):
        fs, path = pafs.FileSystem.from_uri(out)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        row = _read_record(parse(data))
                        if row is None:
                            continue
                        held += len(row["payload"] or b"") if payloads else 200
                        rows.append(row)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # by number: a few names are a few bytes, which would else meet in one task
    files = manifest.select("name").repartition(max(1, min(manifest.count(), 10_000)))
    return files.mapInArrow(read, columns)


def _read_record(r: dict) -> dict | None:
    kind = r["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    content = r[""]
    if f"sha256:{hashlib.sha256(content).hexdigest()}" != r["warc-block-digest"]:
        raise ValueError(f"{r['warc-record-id']}: block digest does not fit")
    http, _, payload = content.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?m)^Content-Length: (\d+)", http)[1])
    digest = r["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{r['warc-record-id']}: payload digest does not fit")
    number = {k: int(r[k]) if k in r else None for k in ("x-page-id", "x-refers-to-page-id")}
    return {"page_id": number["x-page-id"], "url": r["warc-target-uri"], "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": number["x-refers-to-page-id"],
            "payload": payload if kind == "response" else None}
