"""Operator 7: token ids in files, by canonical length-limited Huffman codes from global counts.

Writing: texts become ids (with an end id each), kept once in the shared folder; the ids' counts
over all documents give one code; documents go to files in ascending id order, each file a range of
ids. A file is a row of independent blocks. A block lists its documents, the bit offset of every
``INTERVAL``-th id, and the code bits, so a reader decodes all intervals of a block side by side by
table look-up, and any block without the others. The code itself is the length of every id's code.

Null and empty texts have the end id only. Rows with one id follow one another in the order of a
hash of their ids; null ids come first. Other columns are ignored. A table without rows gives no
file but a readable folder.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import open_shared, stored, work_path, write_shared
from tablewatch.llm.libtokens import TOGETHER, library_tokens
from tablewatch.llm.units import text_parts

#: Ids of a block at most, and between two bit offsets.
BLOCK_IDS, INTERVAL = 1 << 19, 128
#: Bits of a code at most; 2 to this power is above the size of any vocabulary used here.
MAX_BITS = 20
_BLOCK = struct.Struct("<4sIIIQ")  # mark, documents, ids, CRC-32 of what follows, its bytes
_DOC = [("doc_id", "<i8"), ("ids", "<u4"), ("kind", "u1")]  # kind: 1 goes on from the block before, 2 null id


def code_lengths(counts, limit: int = MAX_BITS):
    """Code length of every id by package-merge: optimal among codes of at most ``limit`` bits."""
    import numpy as np

    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        level, kind = both[by], by < len(leaves)
        is_leaf.append(kind)
    take, bits = 2 * len(leaves) - 2, np.zeros(len(leaves), np.uint8)
    for kind in reversed(is_leaf):
        chosen = int(kind[:take].sum())
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[order] = bits
    return lengths


class Code:
    """Canonical code of the lengths: shorter codes first, then smaller ids."""

    def __init__(self, lengths):
        import numpy as np

        self.lengths = np.asarray(lengths, np.uint8)
        self.bits = int(self.lengths.max(initial=1))
        used = np.flatnonzero(self.lengths)
        order = used[np.argsort(self.lengths[used], kind="stable")]
        spans = np.int64(1) << (self.bits - self.lengths[order].astype(np.int64))
        first = np.cumsum(spans) - spans  # codes as they begin in the table of all windows
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[order] = (first >> (self.bits - self.lengths[order].astype(np.int64))).astype(np.uint64)
        self.ids_of = np.zeros(1 << self.bits, np.uint32)
        ids = np.repeat(order.astype(np.uint32), spans)
        self.ids_of[:len(ids)] = ids
        self.length_of = self.lengths[self.ids_of].astype(np.int64)

    def encode(self, ids):
        """(code bits as bytes, bit offset of every INTERVAL-th id)."""
        import numpy as np

        lengths = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(lengths)
        at = ends - lengths
        words = np.zeros((int(ends[-1]) >> 6) + 2 if len(ids) else 1, np.uint64)
        word, room = at >> 6, 64 - (at & 63) - lengths
        codes = self.codes[ids]
        high = np.where(room >= 0, codes << np.maximum(room, 0).astype(np.uint64),
                        codes >> np.maximum(-room, 0).astype(np.uint64))
        if len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] = np.bitwise_or.reduceat(high, first)
            over = np.flatnonzero(room < 0)
            words[word[over] + 1] |= codes[over] << (64 + room[over]).astype(np.uint64)
        return words.byteswap().tobytes()[:(int(ends[-1]) + 7) // 8 if len(ids) else 0], at[::INTERVAL]

    def decode(self, data: bytes, offsets, n: int):
        """The ``n`` ids of code bits, all intervals at once."""
        import numpy as np

        raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        out = np.zeros((INTERVAL, len(offsets)), np.uint32)
        at, last = np.asarray(offsets, np.int64).copy(), len(window) - 1
        for step in range(INTERVAL):
            seen = (window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> np.uint32(32 - self.bits)
            out[step] = self.ids_of[seen]
            at += self.length_of[seen]
        return out.T.reshape(-1)[:n]


def _block(code: Code, docs, ids) -> bytes:
    import numpy as np

    bits, offsets = code.encode(ids)
    body = np.array(docs, _DOC).tobytes() + np.asarray(offsets, "<u8").tobytes() + bits
    return _BLOCK.pack(b"IDB1", len(docs), len(ids), zlib.crc32(body), len(body)) + body


def file_blocks(code: Code, documents) -> Iterator[tuple[int, int, bytes]]:
    """Blocks of ``(doc_id, ids)``: documents begun, ids, bytes. Long documents go on in the next block."""
    import numpy as np

    docs, parts, held, begun = [], [], 0, 0
    for doc_id, ids in documents:
        kind, begun = 2 * (doc_id is None), begun + 1
        while True:
            part = ids[:BLOCK_IDS - held]
            docs.append((doc_id or 0, len(part), kind))
            parts.append(part)
            held, ids, kind = held + len(part), ids[len(part):], kind | 1
            if held >= BLOCK_IDS:
                yield begun, held, _block(code, docs, np.concatenate(parts))
                docs, parts, held, begun = [], [], 0, 0
            if not len(ids):
                break
    if docs:
        yield begun, held, _block(code, docs, np.concatenate(parts))


def read_blocks(code: Code, stream) -> Iterator[tuple[int | None, bool, object]]:
    """(doc_id, whether it goes on from the part before, ids) of a file, block by block."""
    import numpy as np

    size = np.dtype(_DOC).itemsize
    while head := stream.read(_BLOCK.size):
        mark, n_docs, n_ids, crc, n_bytes = _BLOCK.unpack(head)
        body = stream.read(n_bytes)
        if mark != b"IDB1" or len(body) != n_bytes or zlib.crc32(body) != crc:
            raise ValueError("damaged block of a token file")
        points = -(-n_ids // INTERVAL)
        docs = np.frombuffer(body, _DOC, n_docs)
        offsets = np.frombuffer(body, "<u8", points, n_docs * size)
        ids, at = code.decode(body[n_docs * size + 8 * points:], offsets, n_ids), 0
        for doc_id, n, kind in docs.tolist():
            yield None if kind & 2 else doc_id, bool(kind & 1), ids[at:at + n]
            at += n


def write_files(df: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
                text_col: str = "text") -> None:
    """Write the token files of all texts to ``folder`` (in shared storage), with their list."""
    spark = df.sparkSession
    compact = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType()),
                            T.StructField("order", T.LongType())])

    def tokenise(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        import zstandard

        tokens, squeeze = library_tokens(vocabulary, byte_level=True), zstandard.ZstdCompressor(3).compress
        for batch in batches:
            for doc_ids, texts in text_parts(batch.column(0), batch.column(1).to_pylist(), TOGETHER):
                ids, counts = tokens.many(texts)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).tobytes()
                cuts = [0, *(4 * (ends + np.arange(1, len(ends) + 1))).tolist()]
                ids = [ids[i:j] for i, j in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([
                    doc_ids, pa.array([squeeze(i) for i in ids], pa.binary()),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64())], names=["doc_id", "ids", "order"])

    def unpacked(batch):
        import numpy as np
        import zstandard

        widen = zstandard.ZstdDecompressor().decompress
        for doc_id, ids in zip(batch.column(0), batch.column(1)):
            yield doc_id.as_py(), np.frombuffer(widen(ids.as_py()), "<u4")

    def count(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for batch in batches:
            parts = [ids for _, ids in unpacked(batch)]
            if parts:
                n = np.bincount(np.concatenate(parts))
                total, n = (n, total) if len(n) > len(total) else (total, n)
                total[:len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    table = stored(df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
                   .mapInArrow(tokenise, compact), "ids")
    counts = table.select("doc_id", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).collect()  # one row for each id of the vocabulary at most
    all_counts = [0] * (1 + max((r["id"] for r in counts), default=0))
    for r in counts:
        all_counts[r["id"]] = r["n"]
    lengths = code_lengths(all_counts).tobytes()
    write_shared(folder, "code", [lengths])

    def write(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId()
        sums = [0, 0]

        def counted():
            code = Code(np.frombuffer(lengths, np.uint8))
            for docs, ids, data in file_blocks(code, (x for b in batches for x in unpacked(b))):
                sums[0] += docs
                sums[1] += ids
                yield data

        blocks = counted()
        first = next(blocks, None)
        if first is not None:
            write_shared(folder, f"part-{at:07d}.ids", (d for x in ([first], blocks) for d in x))
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (at, *sums)],
                                             names=["file", "n_docs", "n_ids"])

    ordered = table.repartitionByRange(F.col("doc_id").asc_nulls_first(), "order").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "order").select("doc_id", "ids")
    ordered.mapInArrow(write, "file long, n_docs long, n_ids long").write.parquet(f"{folder}/list")


def read_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of token files: ``doc_id, start, n_tokens, ids_crc32`` and, on request, the ids.

    ``start`` counts the ids of all documents before, over all files; ``ids_crc32`` is of the ids as
    little-endian unsigned 32-bit integers.
    """
    fields = [T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    # one row a file
    files = sorted((r["file"], r["n_ids"]) for r in spark.read.schema("file long, n_docs long, n_ids long")
                   .parquet(f"{folder}/list").collect())
    bases, total = [], 0
    for name, n in files:
        bases.append((name, total))
        total += n

    def read(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        with open_shared(folder, "code") as f:
            code = Code(np.frombuffer(f.read(), np.uint8))
        for batch in batches:
            for at in batch.column(0).to_pylist():
                name, start = bases[at]
                rows: list[list] = []
                with open_shared(folder, f"part-{name:07d}.ids") as f:
                    for doc_id, goes_on, ids in read_blocks(code, f):
                        if not goes_on and len(rows) >= 2000:
                            yield _rows(rows, fields)
                            rows = []
                        if not goes_on:
                            rows.append([doc_id, start, 0, 0, []])
                        row = rows[-1]
                        row[2] += len(ids)
                        row[3] = zlib.crc32(np.ascontiguousarray(ids, "<u4"), row[3])
                        if with_ids:
                            row[4].append(ids)
                        start += len(ids)
                if rows:
                    yield _rows(rows, fields)

    def _rows(rows, kinds):
        columns = [pa_longs([r[i] for r in rows]) for i in range(4)]
        if with_ids:
            import numpy as np
            import pyarrow as pa

            columns.append(pa.array([np.concatenate(r[4]).astype(np.int64) for r in rows], pa.list_(pa.int64())))
        return _batch(columns, [k.name for k in kinds])

    def pa_longs(values):
        import pyarrow as pa

        return pa.array(values, pa.int64())

    def _batch(columns, names):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(columns, names=names)

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(read, T.StructType(fields))


def round_trip(df: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """Write the files to the shared folder, then read them back."""
    folder = work_path(df.sparkSession, "token-files")
    write_files(df, folder, vocabulary, end_id, id_col, text_col)
    return read_files(df.sparkSession, folder, with_ids)
