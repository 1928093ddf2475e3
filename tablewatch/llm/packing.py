"""Operator 4: packing by shortest-pack-first over the length histogram.

Documents become token ids plus an end id. What is longer than a sequence is cut at multiples of
its length. Lengths are counted, at most one count per length; the packing works on that histogram
alone: lengths from longest to shortest, each into the packs with most room, many equal packs at a
time. The resulting patterns (so many packs that hold these lengths) are dealt out to the pieces
by their rank among the pieces of one length. Pieces are dealt to tasks in ranges by length, a hash
and the row, so a frequent length fills many ranges; a rank counts within a range, and the counts of
the ranges before it are added. So no length has to meet in one task.

Null and empty texts are one end id. Repeated ids and rows are packed each; a null id is kept and
ranks first. Other columns are ignored. A table without rows gives none.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import TEXT_BATCH_BYTES, stored
from tablewatch.llm.libtokens import id_bytes, library_tokens
from tablewatch.llm.units import text_parts

#: Words kept for look-up, and characters of text cut into pieces together: a pipeline's
#: workers hold the models of earlier stages too. Memory and speed of a task, not results, depend on them.
MAX_KNOWN, TOGETHER = 100_000, 1 << 20
#: Pieces of a range that are ranked together, about, where there are many.
RANKED_TOGETHER = 50_000


def pieces(df: DataFrame, vocabulary: str, end_id: int, size: int = 4096, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Token pieces of at most ``size`` ids: ``doc_id, start, length, ids_crc32, doc_tokens`` and the
    ids on request. ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers."""
    fields = [T.StructField("doc_id", df.schema[id_col].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def of_texts(doc_ids, all_ids, counts, end: bytes):
        import numpy as np
        import pyarrow as pa

        out: list[list] = [[] for _ in range(6)]
        ends = np.cumsum(counts).tolist()
        for row, (first, last) in enumerate(zip([0, *ends], ends)):
            ids = all_ids[first:last].tobytes() + end
            for at in range(0, len(ids), 4 * size):
                part = ids[at:at + 4 * size]
                for column, value in zip(out, (row, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4)):
                    column.append(value)
                if with_ids:
                    out[5].append(np.frombuffer(part, "<u4").astype(np.int64))
        columns = [doc_ids.take(pa.array(out[0], pa.int64()))]
        columns += [pa.array(c, pa.int64()) for c in out[1:5]]
        if with_ids:
            columns.append(pa.array(out[5], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    def run(batches: Iterator):
        tokens, end = library_tokens(vocabulary, byte_level=False, max_known=MAX_KNOWN), id_bytes([end_id])
        for batch in batches:
            for doc_ids, texts in text_parts(batch.column(0), batch.column(1).to_pylist(), TOGETHER):
                yield of_texts(doc_ids, *tokens.many(texts), end)

    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, T.StructType(fields))


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Shortest-pack-first. ``counts``: pieces by length. Returns patterns: so many packs, each with
    these (length, times). The work and the patterns depend on the lengths, not on the counts."""
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # patterns by the room they have left
    most: list[int] = []  # the rooms, largest first

    def keep(left: int, packs: int, content: list[tuple[int, int]]) -> None:
        if left not in room:
            room[left] = []
            heapq.heappush(most, -left)
        room[left].append((packs, content))

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        todo = counts[length]
        while todo:
            while most and not room.get(-most[0]):
                room.pop(-heapq.heappop(most), None)
            if not most or -most[0] < length:
                each = size // length
                if todo >= each:
                    keep(size - each * length, todo // each, [(length, each)])
                if todo % each:
                    keep(size - todo % each * length, 1, [(length, todo % each)])
                break
            left = -most[0]
            packs, content = room[left].pop()
            # each pack takes so many before another kind of pack has more room
            below = max((r for r, x in room.items() if x and r < left), default=0)
            times = min(left // length, max(1, -(-(left - below) // length)))
            if todo < packs * times:
                times = max(1, todo // packs)
            use = min(packs, todo // times)
            if use < packs:
                room[left].append((packs - use, content))
            same = content[-1][0] == length
            grown = [*content[:-1], (length, content[-1][1] + times)] if same else [*content, (length, times)]
            keep(left - times * length, use, grown)
            todo -= use * times
    return [pattern for kind in room.values() for pattern in kind]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of a length go, by rank: (length, first rank, times, first sequence, offset).
    From the first rank on, ``times`` pieces in a row lie behind one another in a sequence."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for packs, content in patterns:
        offset = 0
        for length, times in content:
            out.append((length, rank.get(length, 0), times, sequence, offset))
            rank[length] = rank.get(length, 0) + packs * times
            offset += length * times
        sequence += packs
    return sorted(out)


def ranked(piece_rows: DataFrame) -> DataFrame:
    """Rows dealt by length in ranges, with ``_range`` (the range's number) and ``_rank`` (place among
    the rows of the range with the same length), kept in the shared folder. A length with many rows
    fills many ranges."""
    schema = T.StructType([*piece_rows.schema.fields, T.StructField("_range", T.LongType()),
                           T.StructField("_rank", T.LongType())])
    order = ["length", "_mix", "doc_id", "start", "ids_crc32", "_row"]
    least = int(piece_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, piece_rows.count() // RANKED_TOGETHER)
    dealt = piece_rows.withColumn("_mix", F.xxhash64("doc_id", "start", "ids_crc32")).withColumn(
        "_row", F.monotonically_increasing_id()).repartitionByRange(ranges, "length", "_mix", "_row")

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        at, last, rows_of_last = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.diff(length, prepend=-1))  # where a length begins in this batch
            rank = np.arange(len(length)) - np.repeat(first, np.diff(first, append=len(length)))
            if length[0] == last:  # goes on from the batch before
                rank[:first[1] if len(first) > 1 else None] += rows_of_last
            last, rows_of_last = length[-1], int(rank[-1]) + 1
            columns = batch.columns[:len(schema) - 2]
            columns += [pa.array(np.full(len(length), at, np.int64)), pa.array(rank.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return stored(dealt.sortWithinPartitions(*order).select(*piece_rows.columns).mapInArrow(run, schema), "ranked")


def pack(piece_rows: DataFrame, size: int = 4096) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (long) to rows of :func:`pieces`, whatever else they carry.

    The driver holds the histogram and the patterns, which are bounded by ``size`` alone, and the
    histogram by range: ranges follow one another by length, so that is at most one count for every
    length and every range.
    """
    rows = ranked(piece_rows)
    counts: dict[int, int] = {}
    before: dict[int, list[tuple[int, int]]] = {}  # of a range: (length, rows of it in earlier ranges)
    for r in rows.groupBy("_range", "length").count().orderBy("_range", "length").collect():
        if counts.get(r["length"]):
            before.setdefault(r["_range"], []).append((r["length"], counts[r["length"]]))
        counts[r["length"]] = counts.get(r["length"], 0) + r["count"]
    table = slots(pack_histogram(counts, size))
    names = piece_rows.columns
    schema = T.StructType([*piece_rows.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        slot_rows = np.array(table, np.int64).reshape(-1, 5)
        first_of: dict[int, int] = {}  # of a length: its first row of the slots
        for i, n in enumerate(slot_rows[:, 0].tolist()):
            first_of.setdefault(n, i)
        for batch in batches:
            length, in_range, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                                      .astype(np.int64) for n in ("length", "_range", "_rank"))
            place = np.zeros((2, len(length)), np.int64)
            by = np.lexsort((length, in_range))
            cuts = np.flatnonzero((np.diff(length[by], prepend=-1) != 0) | (np.diff(in_range[by], prepend=-1) != 0))
            for own in np.split(by, cuts[1:]) if len(by) else []:
                n, at = int(length[own[0]]), int(in_range[own[0]])
                full = rank[own] + next((x for m, x in before.get(at, []) if m == n), 0)
                low = first_of[n]
                high = np.searchsorted(slot_rows[:, 0], n, "right")
                slot = slot_rows[low + np.searchsorted(slot_rows[low:high, 1], full, "right") - 1]
                step = full - slot[:, 1]
                place[0, own] = slot[:, 3] + step // slot[:, 2]
                place[1, own] = slot[:, 4] + step % slot[:, 2] * n
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [pa.array(place[0]), pa.array(place[1])]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def pack_documents(df: DataFrame, vocabulary: str, end_id: int, size: int = 4096, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Tokenise once (kept in the shared folder) and pack: rows of :func:`pieces` with their place."""
    return pack(stored(pieces(df, vocabulary, end_id, size, id_col, text_col, with_ids), "pieces", TEXT_BATCH_BYTES), size)
