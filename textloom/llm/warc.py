"""WARC archives, index first.

``write_warc`` writes one record per row into files in a shared folder and
returns the index (file, offset, length, url, digest ...) as a written table;
``read_warc`` reads selected index rows back: it sorts them by file and offset,
coalesces neighbouring byte ranges into one read each, and checks every payload
against its digest. Each record is a gzip member of its own.

Files carry a name unique to the attempt that wrote them and the index holds
only those of attempts that succeeded, so lost executors and repeated tasks
leave at most files that nothing refers to.

Null payloads count as empty, null urls as empty. Equal payloads of at least
``min_revisit`` bytes: the row with the largest id is the response, others
revisit it. Rows that repeat an id: among equal payloads each is a record of
its own and all rows of the largest id are responses. Null ids never become
the target of a revisit unless all ids of the payload are null; then all are
responses. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import load, scratch_path, written

#: A file is closed and a new one begun beyond this many bytes.
ROLL_BYTES = 128 << 20
#: Ranges with a smaller gap are read at once, up to READ_BYTES a read.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20

INDEX = "id long, file string, offset long, length long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store behind a URI or plain path."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def record(rid: int | None, url: str, payload: bytes, digest: str, size: int, refers_to: int | None, level: int) -> bytes:
    """One gzip member with a response or revisit record. A revisit holds no payload, but its digest and size."""
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:textloom:page:{'' if rid is None else rid}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:textloom:page:{refers_to}>"]
    body = b"" if revisit else payload
    head.append(f"Content-Length: {len(body)}")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and content block of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 1000, level: int = 3) -> DataFrame:
    """Writes the archives under ``folder`` and returns their index. The slim (id, digest) table decides revisits before payloads move."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    twins = rows.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.max("id").alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("d"), "target")
    rows = rows.join(written(twins, "warc-twins"), F.col("digest") == F.col("d"), "left")
    refers = F.when(F.col("id").isNull() | (F.col("id") < F.col("target")), F.col("target"))
    rows = rows.select("id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "digest", "size", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        name, out, at = "", None, 0
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                if out is None or at >= ROLL_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = record(r["id"], r["url"], r["payload"] or b"", r["digest"], r["size"], r["refers_to"], level)
                out.write(data)
                made.append((r["id"], name, at, len(data), r["url"], r["digest"], r["size"], "response" if r["refers_to"] is None else "revisit", r["refers_to"]))
                at += len(data)
            if made:
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])
        if out is not None:
            out.close()

    return written(rows.mapInArrow(write, INDEX), "warc-index")


def read_warc(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The indexed records, read back from the archives: headers, digest and size of what was read, and the payload on request.

    A response whose content does not match its digest raises an error.
    """
    import hashlib

    n = max(1, index.sparkSession.sparkContext.defaultParallelism)
    wanted = index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    target = lambda x: int(t) if (t := x.removeprefix("<urn:textloom:page:").removesuffix(">")) else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            k, made, held = 0, [], 0
            while k < len(rows):
                file, start, size = rows[k]
                end, last = start + size, k + 1
                while last < len(rows) and rows[last][0] == file and rows[last][1] - end <= GAP_BYTES and rows[last][1] + rows[last][2] - start <= READ_BYTES:
                    end = max(end, rows[last][1] + rows[last][2])
                    last += 1
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{root}/{file}")
                data = source.read_at(end - start, start)
                for _, offset, length in rows[k:last]:
                    head, body = parse(data[offset - start : offset - start + length])
                    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                    if kind == "response":
                        if hashlib.sha1(body).hexdigest() != digest:
                            raise ValueError(f"{file} at {offset}: the payload does not match its digest")
                        size = len(body)
                    else:
                        size = int(head["X-Payload-Length"])
                    made.append((target(head["WARC-Record-ID"]), head.get("WARC-Target-URI", ""), size, digest, kind, target(head["WARC-Refers-To"]) if kind == "revisit" else None) + ((body,) if payloads else ()))
                    held += len(body) if payloads else 0
                k = last
                if made and (k == len(rows) or held > READ_BYTES):
                    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=False)], names=[x.split()[0] for x in schema.split(", ")])
                    made, held = [], 0

    return wanted.mapInArrow(read, schema)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages as WARC and reads every record back through the index."""
    folder = scratch_path(spark, "warc")
    index = write_warc(load(spark, sf_dir, "pages"), folder)
    return read_warc(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), t AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top, count(*) OVER (PARTITION BY payload_digest) AS n FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND n > 1 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND n > 1 AND page_id < top THEN top END AS refers_to
FROM t
"""
