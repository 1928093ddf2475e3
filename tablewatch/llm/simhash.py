"""Operator 2: SimHash near-duplicates, with pivot distance tables.

A fingerprint has 64 bits: a bit is set if it is set in over half the XXH64 values of a text's word
shingles. Fingerprints link at ``MAX_BITS`` differing bits or fewer; linked documents form groups.

Equal fingerprints are one node. Nodes meet in cells: with the bits cut in ``b`` blocks, two nodes
that may link agree in ``b - MAX_BITS`` whole blocks, so each choice of so many blocks is a key. A
key with many nodes is dealt into chunks, and each two chunks meet in a cell of their own, so a cell
has a bounded size and no pair is lost. Within a cell every node has a table row of its distances to
reference fingerprints (pivots). Two nodes whose rows differ by more than ``MAX_BITS`` in any
coordinate cannot link (triangle inequality); the others are verified. A cell yields a spanning
forest of its links, found by widening from one node over those not yet reached, so a thousand near
copies give a thousand rows, not all their pairs.

Null texts are empty; texts without words have fingerprint zero and link like others. Null ids have
fingerprints and groups, but name no group unless all ids of it are null (then null). Repeated rows
and ids each give a row. Other columns are ignored. A table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import stored
from tablewatch.llm.graph import components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: Nodes of a chunk of a large key; a cell has two chunks.
CHUNK = 1500
N_PIVOTS = 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # of bytes: A to Z, and ASCII white space
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()][:n]
    stops = (ends[size - 1:] - 1).tolist() if len(words) >= size else [len(joined)]
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounds the memory of very long texts
        part = hashes[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the fingerprint as a signed long."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, schema)


def pivots(n: int = N_PIVOTS):
    """Reference fingerprints by a rule: the splitmix64 sequence from 1."""
    out, state, mask = [], 1, (1 << 64) - 1
    for _ in range(n):
        state = state + 0x9E3779B97F4A7C15 & mask
        z = (state ^ state >> 30) * 0xBF58476D1CE4E5B9 & mask
        z = (z ^ z >> 27) * 0x94D049BB133111EB & mask
        out.append(z ^ z >> 31)
    return out


def cell_links(fps, references) -> list[tuple[int, int]]:
    """Links (indices) that connect what can be connected within one cell of distinct fingerprints."""
    import numpy as np

    table = np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")  # the first coordinate bounds the search
    fps, table = fps[order], table[order]
    left, links = np.arange(len(fps)), []
    while len(left):
        edge, left = [left[0]], left[1:]
        while edge and len(left):
            x = edge.pop()
            first = table[left, 0]
            a, b = np.searchsorted(first, table[x, 0] - MAX_BITS, "left"), np.searchsorted(
                first, table[x, 0] + MAX_BITS, "right")
            near = left[a:b]
            for c in range(1, table.shape[1], 5):
                if len(near) < 8:
                    break
                off = np.abs(table[near, c:c + 5] - table[x, c:c + 5]).max(axis=1)
                near = near[off <= MAX_BITS]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= MAX_BITS]
            if len(near):
                links += [(order[x], order[y]) for y in near]
                edge += near.tolist()
                left = left[~np.isin(left, near)]
    return links


def blocks_for(nodes: int) -> int:
    """Blocks to cut a fingerprint into, so that a key of evenly spread nodes has about one of them."""
    return next((b for b in range(6, 12) if nodes <= 2 ** (64 * (b - MAX_BITS) // b)), 12)


def links(nodes: DataFrame, n_blocks: int, chunk: int = CHUNK) -> DataFrame:
    """``u, v``: links between distinct fingerprints ``fp`` that connect all that are within reach."""
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    masks = [sum(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in chosen)
             for chosen in combinations(range(n_blocks), n_blocks - MAX_BITS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "key"))
    large = stored(keyed.groupBy("t", "key").count().filter(F.col("count") > chunk).select(
        F.col("t").alias("lt"), F.col("key").alias("lkey"), F.ceil(F.col("count") / chunk).cast("int").alias("k")), "keys")
    dealt = keyed.join(large, (F.col("t") == F.col("lt")) & (F.col("key") == F.col("lkey")), "left").withColumn(
        "c", F.when(F.col("k").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")))
    others = F.filter(F.sequence(F.lit(0), F.col("k") - 1), lambda j: j != F.col("c"))
    cells = F.when(F.col("k").isNull(), F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))).otherwise(
        F.transform(others, lambda j: F.struct(F.least(j, F.col("c")).alias("a"), F.greatest(j, F.col("c")).alias("b"))))
    rows = dealt.select("t", "key", "fp", F.explode(cells).alias("cell")).select(
        F.xxhash64("t", "key", "cell.a", "cell.b").alias("cell"), "t", "key", F.col("cell.a").alias("a"),
        F.col("cell.b").alias("b"), "fp")
    order = ["cell", "t", "key", "a", "b", "fp"]
    dealt_out = rows.repartition(F.col("cell")).sortWithinPartitions(*order)

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        references = np.array(pivots(), np.uint64)

        def batch_of(pairs):
            u, v = np.array(pairs, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        def cell_pairs(part):
            """Links of the whole cells in ``part`` (rows of key columns and fingerprint)."""
            new = np.flatnonzero(np.r_[True, (part[1:, :5] != part[:-1, :5]).any(axis=1), True])
            sizes = np.diff(new)
            signed_fps = part[:, 5]
            fps = signed_fps.view(np.uint64) if signed_fps.flags.c_contiguous else signed_fps.copy().view(np.uint64)
            out = []
            two = new[:-1][sizes == 2]  # most cells: one pair each, all pairs at once
            if len(two):
                x, y = fps[two], fps[two + 1]
                maybe = np.ones(len(x), bool)
                for p in references:
                    off = np.bitwise_count(x ^ p).astype(np.int8) - np.bitwise_count(y ^ p).astype(np.int8)
                    maybe &= np.abs(off) <= MAX_BITS
                hit = np.flatnonzero(maybe)
                hit = hit[np.bitwise_count(x[hit] ^ y[hit]) <= MAX_BITS]
                out += zip(signed_fps[two[hit]].tolist(), signed_fps[two[hit] + 1].tolist())
            for at, size in zip(new[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                own = signed_fps[at:at + size]
                out += [(int(own[i]), int(own[j])) for i, j in cell_links(fps[at:at + size], references)]
            return out

        held = None
        for batch in batches:
            part = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)], axis=1)
            if held is not None:
                part = np.concatenate([held, part])
            if not len(part):
                continue
            last = np.flatnonzero((part[:, :5] != part[-1, :5]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0  # the last cell may go on in the next batch
            held = part[cut:]
            if cut and (pairs := cell_pairs(part[:cut])):
                yield batch_of(pairs)
        if held is not None and (pairs := cell_pairs(held)):
            yield batch_of(pairs)

    return dealt_out.mapInArrow(run, "u long, v long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: 16 hexadecimal digits, and the smallest id
    that links lead to."""
    own = stored(fingerprints(df, id_col, text_col), "fingerprints")
    nodes = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    stars = components(links(nodes, blocks_for(nodes.count())))
    led = nodes.join(stars, nodes["fp"] == stars["u"], "left").select(
        "fp", F.coalesce("v", "fp").alias("root"), "first")
    smallest = stored(led.groupBy("root").agg(F.min("first").alias("component_id")), "groups")
    named = stored(led.select("fp", "root").join(smallest, "root").select(
        F.col("fp").alias("node"), "component_id"), "named")
    return own.join(named, own["fp"] == named["node"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
