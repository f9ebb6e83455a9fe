"""Deterministic, sharded WARC writer, and the reader for what it wrote.

Records are cut into shards by ranges of ``page_id``: pages are counted and summed in
bytes over narrow ranges of ids, a running sum over those closes a shard every
``SHARD_BYTES``, and so the same pages give the same shards on any cluster. A task writes
one shard after another in id order, each record its own gzip member without a time
stamp, and rolls to a new file at ``FILE_BYTES`` compressed. Headers are made anew from
the record: length, digests, and a record id derived from the content.

Committing: a task writes under temporary names that carry its attempt; Spark commits the
manifest (one row per file) of the attempts that won, a second job renames what the
manifest names, and the manifest is written beside the files at the end. A rerun after a
loss at any point ends in the same files; temporary files of lost attempts are deleted.

Of records with equal payloads of at least ``least`` bytes, the one with the largest id is
the response and the others revisit it. Equality is that of SHA-1 and length; counts per
payload combine before the shuffle, and Spark splits a payload that half the pages share.

Defined cases: null html is an empty payload; null ids go into the first shard, revisit
others and are never revisited, unless all ids of the payload are null; rows that repeat
the largest id of their payload are all responses; an empty table writes a manifest of no
files; other columns take no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.common import stored
from terrace.session import new_work_dir

SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
#: Ids per range that sizes are summed over.
RANGE = 256
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "shard long, part int, temporary string, final string, records long, bytes long, sha256 string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
PAGE_URI = "urn:page:"


def record_types(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, sha1 (hex), refers_to (null: a response)."""
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    again = stored(
        rows.groupBy("sha1", "payload_bytes")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & (F.col("payload_bytes") >= least))
        .drop("n"),
        "payloads",
    )
    other = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return rows.join(again, ["sha1", "payload_bytes"], "left").select(
        *rows.columns, F.when(other, F.col("largest")).alias("refers_to")
    )


def shards(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """first (range of ids), shard: where each narrow range of ids goes."""
    first = F.coalesce(F.floor(F.col("page_id") / RANGE), F.lit(-1)).alias("first")
    sums = pages.groupBy(first).agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 512).alias("bytes"))
    return cut_shards(sums, shard_bytes)


def cut_shards(sums: DataFrame, shard_bytes: int) -> DataFrame:
    # Running sums in two steps: over thousands of ranges, then within them.
    sums = sums.withColumn("block", F.floor(F.col("first") / 4096))
    before = Window.partitionBy().orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.groupBy("block").agg(F.sum("bytes").alias("in_block"))
    blocks = blocks.select("block", F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("block").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    return sums.withColumn("start", start).join(blocks, "block").select(
        "first", F.floor((F.col("start") + F.col("ahead")) / shard_bytes).alias("shard")
    )


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def member(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """One record as a gzip member, made from the page alone."""
    digest = base32(sha1)
    name = "" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    key = uuid.uuid5(uuid.NAMESPACE_URL, f"{PAGE_URI}{name}:{url}:{digest}:{refers_to}")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{key}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Page-ID", name),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[2:2] = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    raw = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 6, mtime=0)


def write_warc(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, least: int = 0
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files below ``folder``; returns the manifest.

    ``folder`` is a URI that every executor reaches (file, s3, gs, hdfs).
    """
    spark = pages.sparkSession
    plan = stored(shards(pages, shard_bytes), "shards")
    n = max(1, (plan.agg(F.max("shard")).first()[0] or 0) + 1)
    where = F.coalesce(F.floor(F.col("page_id") / RANGE), F.lit(-1))
    records = record_types(pages, least).withColumn("first", where).join(plan, "first").drop("first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        shard, part, sink, done = None, 0, None, []

        def close() -> None:
            sink.close()
            done.append((shard, part, name, final, count, size, sha.hexdigest()))

        for b in batches:
            for page_id, url, payload, sha1, refers_to, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = member(page_id, url, payload, sha1, refers_to)
                if sink and (s != shard or size + len(data) > file_bytes):
                    close()
                    part, sink = (part + 1 if s == shard else 0), None
                if sink is None:
                    if s != shard:
                        part = 0
                    shard = s
                    final = f"pages-{s:06d}-{part:05d}.warc.gz"
                    name = f"_temporary-{final}-{attempt}"
                    sink, count, size, sha = fs.open_output_stream(f"{base}/{name}", compression=None), 0, 0, hashlib.sha256()
                sink.write(data)
                sha.update(data)
                count, size = count + 1, size + len(data)
        if sink:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=manifest_schema)

    manifest_schema = pa.schema(
        [("shard", pa.int64()), ("part", pa.int32()), ("temporary", pa.string()), ("final", pa.string()),
         ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]
    )
    # The digest and the address settle the order of rows that repeat an id.
    ordered = (
        records.select("page_id", "url", "payload", "sha1", "refers_to", "shard")
        .repartitionByRange(n, "shard")
        .sortWithinPartitions("shard", "page_id", "sha1", "url", "refers_to")
    )
    manifest = stored(ordered.mapInArrow(write, MANIFEST), "warc-manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for temporary, final in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                source, target = f"{base}/{temporary}", f"{base}/{final}"
                # After a lost attempt of this job the file may have its name already.
                if fs.get_file_info(source).type == pafs.FileType.File:
                    fs.move(source, target)
                elif fs.get_file_info(target).type != pafs.FileType.File:
                    raise OSError(f"{final} is missing and so is its temporary file")
            yield b

    committed = manifest.repartition(max(1, min(n, 512))).mapInArrow(rename, MANIFEST)
    committed.drop("temporary").write.mode("overwrite").parquet(f"{folder}/manifest")
    remove_temporary(folder)
    return spark.read.parquet(f"{folder}/manifest")


def remove_temporary(folder: str) -> None:
    """Delete what attempts left that did not win. Only after the manifest is written."""
    fs, base = pafs.FileSystem.from_uri(folder)
    for info in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
        if info.base_name.startswith("_temporary-"):
            fs.delete_file(info.path)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a stream of gzip members, one record at a time."""
    unzipped = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while first := unzipped.readline():
        if first != b"WARC/1.1\r\n":
            raise ValueError(f"no WARC record where one should be: {first[:40]!r}")
        headers = {}
        while (line := unzipped.readline()) != b"\r\n":
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[key] = value
        block = unzipped.read(int(headers["Content-Length"]))
        if unzipped.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers['WARC-Record-ID']} does not end where it should")
        yield headers, block


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the files that the manifest names, each checked against its digests."""
    out = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for final in b.column("final").to_pylist():
                with fs.open_input_stream(f"{base}/{final}", compression=None) as f:
                    rows = [record_row(h, block) for h, block in parse(f)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out
                )

    files = spark.read.parquet(f"{folder}/manifest").select("final")
    return files.repartition(max(1, min(files.count(), 4096))).mapInArrow(read, RECORD)


def record_row(headers: dict[str, str], block: bytes) -> tuple:
    number = lambda key: int(headers[key]) if headers.get(key) else None
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    response = headers["WARC-Type"] == "response"
    checked = [(block, headers["WARC-Block-Digest"].removeprefix("sha1:"))]
    if response:
        payload = block.partition(b"\r\n\r\n")[2]
        checked.append((payload, digest))
        if len(payload) != number("WARC-Payload-Length"):
            raise ValueError(f"record {headers['WARC-Record-ID']} has another length than its header")
    for data, expected in checked:
        if base64.b32encode(hashlib.sha1(data).digest()).decode() != expected:
            raise ValueError(f"record {headers['WARC-Record-ID']} does not match its digest")
    return (
        number("WARC-Page-ID"), number("WARC-Payload-Length"), digest, headers["WARC-Type"],
        number("WARC-Refers-To-Page-ID"),
    )


def new_folder(spark: SparkSession) -> str:
    """A fresh folder below the work root, as a URI."""
    path = new_work_dir(spark, "warc")
    return path if ":" in path else f"file://{path}"
