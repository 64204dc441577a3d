"""WARC archives: a deterministic sharded writer and its reader.

Pages are sorted by ranges of their ids; every task writes one range into
files that roll by compressed size, under temporary names. What a finished
task has written is in the manifest; only files of the manifest get their
final names."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatt.llm.shared import stored

_MANIFEST = "shard int, file int, name string, temporary string, records long, bytes long, sha256 string"
_READ = 1 << 20


def _uri(path: str) -> str:
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder (whatever pyarrow can open)."""
    return pafs.FileSystem.from_uri(_uri(path))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page: int | None, url: str | None, payload: bytes, refers: int | None, date: str) -> bytes:
    """One record as a gzip member of its own. A revisit holds the head of the
    response only, with the full payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A").strip()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
              f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}"]
    return _member("\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Writer:
    """Files of one shard, rolled by compressed size, under temporary names."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.folder = _open(folder)
        self.shard, self.roll, self.attempt = shard, roll_bytes, uuid.uuid4().hex
        self.done: list[dict] = []
        self.out = None

    def add(self, member: bytes) -> None:
        if self.out is not None and self.bytes + len(member) > self.roll:
            self.close()
        if self.out is None:
            self.file, self.records, self.bytes, self.sha = len(self.done), 0, 0, hashlib.sha256()
            self.name = f"part-{self.shard:06d}-{self.file:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
        self.out.write(member)
        self.sha.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)

    def close(self) -> list[dict]:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append({"shard": self.shard, "file": self.file, "name": self.name, "temporary": self.temporary,
                              "records": self.records, "bytes": self.bytes, "sha256": self.sha.hexdigest()})
        return self.done


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _boundaries(rows: DataFrame, total: int, n: int, shard_bytes: int, max_shards: int, per_shard: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Upper ends (id, tie) of all shards but the last, by bytes, from a sample
    of at most about ``per_shard`` rows a shard that a hash of the rows picks:
    the same rows give the same shards, however they are stored."""
    shards = int(min(max_shards, max(1, -(-total // shard_bytes))))
    every = max(1, n // (shards * per_shard))
    picked = rows.filter(F.pmod(F.xxhash64("id", "tie"), F.lit(every)) == 0).select("id", "tie", "size").filter("id is not null").collect()
    picked.sort(key=lambda r: (r["id"], r["tie"]))
    if shards == 1 or not picked:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    until = np.cumsum([r["size"] + 512 for r in picked])
    ends = np.searchsorted(until, until[-1] * np.arange(1, shards) / shards)
    ends = np.unique(ends[ends < len(picked) - 1])
    return np.array([picked[i]["id"] for i in ends], np.int64), np.array([picked[i]["tie"] for i in ends], np.int64)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   roll_bytes: int = 64 << 20, shard_bytes: int = 16 << 20, max_shards: int = 20_000, least_bytes: int = 0,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row of ``pages`` into ``folder`` and returns the
    manifest (one row per file), which is also stored there.

    Of payloads that are equal and have at least ``least_bytes`` bytes, the one
    with the smallest id is a response, the others are revisits of it; rows that
    repeat that id are responses too. Null html: an empty payload; null id:
    sorted first, and a response only where no row with an id has its payload.
    Other columns are ignored. No rows: an empty manifest.

    The html is shuffled once, into the ranges. Which row revisits which is
    found on digests and travels as a small row that is sorted just before the
    page's, so that a task needs one record at a time. Equal ids are split by a
    hash of their payload.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    tie = F.xxhash64("html")
    known = stored(rows.select("id", tie.alias("tie"), F.sha2("html", 256).alias("sha"), F.octet_length("html").cast("long").alias("size")), "digests")
    first = known.filter(F.col("size") >= least_bytes).groupBy("sha", "size").agg(F.min("id").alias("first"), F.count("*").alias("copies")).filter(
        "copies > 1 and first is not null")
    revisits = known.join(first, ["sha", "size"]).filter(~F.col("id").eqNullSafe(F.col("first"))).select("id", "tie", "first").distinct()
    sums = known.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    ids, ties = _boundaries(known, sums["bytes"] or 0, sums["n"], shard_bytes, max_shards)
    ends = spark.sparkContext.broadcast((ids, ties))

    @F.pandas_udf("int")
    def shard_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        ids, ties = ends.value
        known = key.notna().to_numpy()
        k, t = key.fillna(0).to_numpy(np.int64), tie.to_numpy(np.int64)
        low, high = np.searchsorted(ids, k, "left"), np.searchsorted(ids, k, "right")
        for i in np.flatnonzero(high > low):
            low[i] += int(np.searchsorted(ties[low[i]:high[i]], t[i], "left"))
        return pd.Series(np.where(known, low, 0).astype(np.int32))

    marks = revisits.select("id", "tie", F.lit(0).alias("kind"), "first", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    records = marks.unionByName(rows.select("id", tie.alias("tie"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first"), "url", "html"))
    records = records.withColumn("shard", shard_of(F.col("id").cast("long"), F.col("tie")))
    dealt = records.repartitionById(len(ids) + 1, F.col("shard")).sortWithinPartitions("shard", "id", "tie", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, mark = None, (None, None, None)
        for b in batches:
            cols = [b.column(n) for n in ("shard", "id", "tie", "kind", "first", "url", "html")]
            for i in range(b.num_rows):
                shard, page, tie, kind, first, url, html = (c[i].as_py() for c in cols)
                if kind == 0:
                    mark = (page, tie, first)
                    continue
                out = out or _Writer(folder, shard, roll_bytes)
                again = mark[2] if mark[:2] == (page, tie) else None
                out.add(record("response" if again is None else "revisit", page, url, html.encode("utf-8", "replace"), again, date))
        if out is not None:
            yield pa.RecordBatch.from_pylist(out.close(), schema=_schema(_MANIFEST))

    manifest = f"{folder}/_manifest"
    dealt.select("shard", "id", "tie", "kind", "first", "url", "html").mapInArrow(write, _MANIFEST).write.parquet(manifest)
    listed = spark.read.schema(_MANIFEST).parquet(manifest)
    _commit(listed, folder)
    return listed


def _commit(manifest: DataFrame, folder: str) -> None:
    """Gives the files of the manifest their final names (done twice, it changes
    nothing), then removes what unfinished attempts have left."""
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for b in batches:
            for name, temporary, size in zip(*(b.column(c).to_pylist() for c in ("name", "temporary", "bytes"))):
                source, target = fs.get_file_info([f"{base}/{temporary}", f"{base}/{name}"])
                if source.type != pafs.FileType.NotFound:
                    fs.move(source.path, target.path)
                elif target.type == pafs.FileType.NotFound or target.size != size:
                    raise FileNotFoundError(f"neither {temporary} nor {name} is complete")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    manifest.select("name", "temporary", "bytes").mapInArrow(rename, "n long").agg(F.sum("n")).collect()
    fs, base = _open(folder)
    if fs.get_file_info(f"{base}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_temporary")


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The gzip members of a stream, one by one."""
    z, parts = zlib.decompressobj(31), []
    for data in chunks:
        while data:
            parts.append(z.decompress(data))
            data = b""
            if z.eof:
                yield b"".join(parts)
                data, z, parts = z.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parse(member: bytes) -> dict:
    """One record; its digests are checked."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}" or kind == "response" and (digest != base32_sha1(payload) or size != len(payload)):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda uri: None if uri in (None, "<urn:page:None>") else int(uri[len("<urn:page:"):-1])
    return {"page_id": number(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": number(fields.get("WARC-Refers-To")), "url": fields["WARC-Target-URI"], "payload": payload if kind == "response" else None}


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all committed archives of ``folder``: ``page_id``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``
    and ``payload`` (responses only). Spark deals the files to tasks by size; a
    task streams a file and holds one record at a time."""
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * payloads
    schema = _schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, at = _open(path)
                with fs.open_input_stream(at, compression=None) as f:
                    some, held = [], 0
                    for member in members(iter(lambda: f.read(_READ), b"")):
                        r = parse(member)
                        some.append({n: r[n] for n in schema.names})
                        held += r["payload_bytes"] if payloads else 200
                        if held > 4 * _READ:
                            yield pa.RecordBatch.from_pylist(some, schema=schema)
                            some, held = [], 0
                    if some:
                        yield pa.RecordBatch.from_pylist(some, schema=schema)

    if not spark.read.schema(_MANIFEST).parquet(f"{folder}/_manifest").limit(1).count():
        return spark.createDataFrame([], ddl)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path")
    return files.mapInArrow(run, ddl)
