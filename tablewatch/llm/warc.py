"""Operator 10: WARC archives, one gzip member per record, written and read one after the other.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the smallest id holds
the payload (``response``); the others are ``revisit`` records that refer to it. Payloads are equal
when their SHA-256 digests are. Only ids and digests meet in the grouping, and a payload that many
pages share is counted down to one row in every task before it is shuffled.

Null payloads count as empty. Repeated rows are all written; those under the smallest id of a payload
are all responses. A null id is never the smallest: such a row revisits where a row with an id has
its payload and is a response elsewhere. Other columns are ignored. A table without rows gives no
archive but a readable folder.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import open_shared, stored, work_path, write_shared

MIN_REVISIT = 100
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, is_revisit: bool = False) -> list:
    """Bytes of one WARC record, in parts: header block, HTTP header, payload (none in a revisit)."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = [http] if is_revisit else [http, payload]
    block = hashlib.sha256()
    for part in body:
        block.update(part)
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}", "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{block.hexdigest()}"]
    if is_revisit:
        lines += [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>",
                  f"WARC-Profile: {_REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {sum(map(len, body))}")
    return [("\r\n".join(lines) + "\r\n\r\n").encode(), *body, b"\r\n\r\n"]


def gzip_member(parts, level: int = 1) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join([*map(squeeze.compress, parts), squeeze.flush()])


class _Member:
    """Reads one gzip member of a stream, so many bytes at a time; ``rest`` is what follows it."""

    def __init__(self, stream, rest: bytes):
        self.stream, self.rest, self.inflate, self.ready = stream, rest, zlib.decompressobj(31), b""

    def more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.rest or self.inflate.unconsumed_tail or self.stream.read(1 << 16)
        if not data:
            raise ValueError("the archive ends within a record")
        self.rest = b""
        self.ready += self.inflate.decompress(data, 1 << 20)
        if self.inflate.eof:
            self.rest = self.inflate.unused_data
        return True

    def read(self, n: int) -> bytes:
        """Up to ``n`` bytes; fewer only at the end."""
        while len(self.ready) < n and self.more():
            pass
        out, self.ready = self.ready[:n], self.ready[n:]
        return out

    def header(self) -> tuple[bytes, dict[str, str]]:
        """A block of header lines up to the empty line, as written and by lower-case key (first line: '')."""
        while b"\r\n\r\n" not in self.ready:
            if not self.more():
                raise ValueError("a record has no end of its header")
        end = self.ready.index(b"\r\n\r\n") + 4
        raw, self.ready = self.ready[:end], self.ready[end:]
        first, *lines = raw[:-4].decode().split("\r\n")
        return raw, {"": first} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_records(stream, with_payload: bool = False) -> Iterator[dict]:
    """Records of an archive in their order. Each is inflated step by step; its content length, its
    block digest and, where it has a payload, the payload's length and digest must be right."""
    rest = stream.read(1 << 16)
    while rest:
        member = _Member(stream, rest)
        _, head = member.header()
        if not head[""].startswith("WARC/"):
            raise ValueError("not a WARC record")
        raw, http = member.header()
        block, payload = hashlib.sha256(raw), hashlib.sha256()
        left, kept = int(head["content-length"]) - len(raw), []
        n = left
        while left > 0:
            part = member.read(min(left, 1 << 18))
            if not part:
                raise ValueError("a record is shorter than its content length")
            left -= len(part)
            block.update(part)
            payload.update(part)
            if with_payload:
                kept.append(part)
        if member.read(5) != b"\r\n\r\n" or member.more():
            raise ValueError("a record is longer than its content length")
        stated, is_revisit = head["warc-payload-digest"].removeprefix("sha256:"), head["warc-type"] == "revisit"
        if block.hexdigest() != head["warc-block-digest"].removeprefix("sha256:") or not is_revisit and (
                payload.hexdigest() != stated or n != int(http["content-length"])):
            raise ValueError("a record's digest is wrong")
        own, other = (head.get(k, "").removeprefix("<urn:page:").removesuffix(">") for k in
                      ("warc-record-id", "warc-refers-to"))
        yield {"page_id": own or None, "url": head["warc-target-uri"], "payload_bytes": int(http["content-length"]),
               "payload_digest": stated, "record_type": head["warc-type"], "refers_to": other or None,
               "payload": b"".join(kept) if with_payload and not is_revisit else None}
        rest = member.rest or stream.read(1 << 16)


def with_revisits(df: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
                  ) -> DataFrame:
    """``page_id, url, payload, digest, is_revisit, refers_to`` of every row."""
    rows = df.select(
        df[id_col].cast("long").alias("page_id"),
        (df[url_col] if url_col else F.lit(None)).cast("string").alias("url"),
        F.coalesce(df[payload_col].cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # stored, so that the join has an exchange of its own whose large partitions Spark can split
    equal = stored(rows.filter(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("digest").alias("shared"), "first"), "payloads")
    joined = rows.join(equal, rows["digest"] == equal["shared"], "left")
    return joined.select("page_id", "url", "payload", "digest",
                         (F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("is_revisit"),
                         F.col("first").alias("refers_to"))


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html",
                   url_col: str | None = "url") -> None:
    """Write an archive per task to ``folder`` (in shared storage), with their list."""

    def write(batches: Iterator):
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId()
        n = [0]

        def members():
            for batch in batches:
                for page_id, url, payload, digest, is_revisit, refers_to in zip(*(c for c in batch.columns)):
                    page_id, digest, is_revisit = page_id.as_py(), digest.as_py(), is_revisit.as_py()
                    n[0] += 1
                    yield gzip_member(record(page_id, url.as_py(), payload.as_py(), digest, refers_to.as_py(),
                                             is_revisit))

        made = members()
        first = next(made, None)
        if first is not None:
            size = write_shared(folder, f"pages-{at:07d}.warc.gz", (m for x in ([first], made) for m in x))
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (at, n[0], size)],
                                             names=["file", "records", "bytes"])

    with_revisits(df, id_col, payload_col, url_col).mapInArrow(
        write, "file long, records long, bytes long").write.parquet(f"{folder}/list")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per record: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` and, on
    request, the payload (null in a revisit)."""
    fields = [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
              T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
              T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType())]
    if with_payload:
        fields.append(T.StructField("payload", T.BinaryType()))
    # one row a file
    files = sorted(r["file"] for r in spark.read.schema("file long").parquet(f"{folder}/list").collect())

    def read(batches: Iterator):
        import pyarrow as pa

        def batch_of(rows):
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            number = {"page_id", "refers_to"}
            columns = [pa.array([int(r[f.name]) if f.name in number and r[f.name] is not None else r[f.name]
                                 for r in rows], kind) for f, kind in zip(fields, kinds)]
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

        for batch in batches:
            for at in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_shared(folder, f"pages-{files[at]:07d}.warc.gz") as f:
                    for r in read_records(f, with_payload):
                        rows.append(r)
                        held += len(r["payload"] or b"") + 200
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(read, T.StructType(fields))


def round_trip(df: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
               with_payload: bool = False) -> DataFrame:
    """Write the archives to the shared folder, then read them back."""
    folder = work_path(df.sparkSession, "archives")
    write_archives(df, folder, id_col, payload_col, url_col)
    return read_archives(df.sparkSession, folder, with_payload)
