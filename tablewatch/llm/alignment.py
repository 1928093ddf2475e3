"""Operator 13: aligning the tokens of two tokenizers by the bytes they cover.

Texts of a batch are tokenised by both, and their tokens become two tables of byte ranges. An as-of
merge keyed by document finds, for each token's start, the token of the other side that covers it; both
directions together are all overlapping pairs. A token that starts where its covering token starts opens
a new group: there the tokens before it end together. Groups are the smallest runs of tokens of both
sides that cover the same bytes.

All pairs of a group are linked. They are kept as different id pairs with their number, never one by
one. How many documents hold a pair is counted over all documents: batches give each of their pairs
once with its documents, which are summed; the sums, and whether a pair is the commonest of its first id,
go back to the batches that hold the pair. So a very common pair crosses the network once a batch, not once
a document.

Null and empty texts, and texts whose tokens' bytes aren't those of the space and the text, have no
tokens. Rows with equal or null ids are documents of their own. Other columns are ignored. A document's
tokens are held by one task; documents are not cut. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewatch.llm.common import TEXT_BATCH_BYTES, stored, tokenizer_path
from tablewatch.llm.libtokens import NEW_TOGETHER, library_tokens
from tablewatch.llm.units import ArrowWordTable, in_order, text_parts

#: Bytes of text that a task tokenises at a time, and tokens that it aligns at a time, unless one document is longer.
BATCH_BYTES, TOKENS_TOGETHER = 1 << 20, 1 << 17
#: An id pair is one number: the first id times this, and the second.
PAIR = 1 << 24
#: Words that each side keeps for look-up, in each of two generations; memory of a task, not results, depends on it.
MAX_KNOWN = 100_000
_UNIT = re.compile(" +[^ ]*")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevelSide:
    """Tokens of a byte-level vocabulary of the tokenizers library; special tokens' strings are plain text."""

    def __init__(self, name: str):
        self.tokens = library_tokens(name, True, True, 2 * MAX_KNOWN)
        byte_of = _byte_of()
        entries = self.tokens.library.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        #: A vocabulary with all bytes, of a library that changes no text, gives back the text's own bytes.
        self.lossless = self.tokens.library.normalizer is None and set(byte_of) <= set(entries)

    def many(self, texts: list[str]):
        return self.tokens.many([" " + text for text in texts])


class PieceSide:
    """Tokens of a sentencepiece model, which puts a space in front itself.

    No piece has a space behind another character, so no token crosses from a word into the spaces
    behind it: spaces with the word behind them are looked up together.
    """

    lossless = False

    def __init__(self, name: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.apart = "▁" in pieces and not any(re.search("[^▁]▁", p) for p in pieces)
        # the model encodes an empty text as nothing, but a space alone ends a text
        self.space = [pieces.index("▁")] if self.apart else []
        self.table = ArrowWordTable(self._units, MAX_KNOWN)

    def _units(self, units):
        """(ids, number of ids of each) of what stands behind a space each, for an Arrow array."""
        import numpy as np

        parts, counts = [], []
        for first in range(0, len(units), NEW_TOGETHER):
            some = units[first:first + NEW_TOGETHER].to_pylist()
            found = [ids if unit else self.space for unit, ids in zip(some, self.model.encode(some, num_threads=1), strict=True)]
            counts += map(len, found)
            parts.append(np.fromiter(chain.from_iterable(found), "<u4"))
        return np.concatenate([np.empty(0, "<u4"), *parts]), np.array(counts, np.int64)

    def many(self, texts: list[str]):
        """(ids of all texts, number of ids of each) as arrays."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        plain, cut, whole = [], [], []
        for i, text in enumerate(texts):
            if not self.apart or "▁" in text:
                whole.append(i)
            else:
                (plain if "  " not in text and text[:1] != " " and text[-1:] != " " else cut).append(i)
        groups = []
        if plain:
            words = pc.split_pattern(pa.array([texts[i] for i in plain], pa.string()), " ")
            groups.append((plain, *self.table.laid_out(words)))
        if cut:
            units = [[u[1:] for u in _UNIT.findall(" " + texts[i])] for i in cut]
            groups.append((cut, *self.table.laid_out(pa.array(units, pa.list_(pa.string())))))
        for i in whole:
            ids = np.array(self.model.encode(texts[i]), "<u4")
            groups.append(([i], ids, [len(ids)]))
        return in_order(len(texts), groups)


_SIDES: dict = {}


def sides(first: str, second: str):
    """Both tokenizers of this Python process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (first, second) not in _SIDES:
        _SIDES[first, second] = ByteLevelSide(first), PieceSide(second)
    return _SIDES[first, second]


def _gives_back(side, ids, counts, raw: bytes, sizes):
    """For each text, whether its tokens' bytes are the space and the text. ``raw`` holds these, one behind another, ``sizes`` long."""
    import numpy as np

    own = b"".join(map(side.bytes_of.__getitem__, ids.tolist()))
    if own == raw and len(own) == sizes.sum():
        ends = np.concatenate([[0], np.cumsum(np.array([len(x) for x in side.bytes_of], np.int64)[ids])])[np.cumsum(counts)]
        if (ends == np.cumsum(sizes)).all():
            return np.ones(len(counts), bool)
    cuts, at, out = np.cumsum([0, *sizes]).tolist(), 0, []
    for n, i, j in zip(counts.tolist(), cuts, cuts[1:]):
        out.append(b"".join([side.bytes_of[x] for x in ids[at:at + n].tolist()]) == raw[i:j])
        at += n
    return np.array(out, bool)


def tokenised(texts: list[str | None], a, b):
    """For each side, one table ``doc, id, start, end`` of all texts; texts without tokens have no rows."""
    import numpy as np
    import pandas as pd

    places = [i for i, text in enumerate(texts) if text]
    whole = [texts[i] for i in places]
    raw = b" " + b" ".join(text.encode() for text in whole)
    sizes = np.array([len(text.encode()) + 1 for text in whole], np.int64)
    found, fits = [], np.ones(len(places), bool)
    for side in (a, b):
        ids, counts = side.many(whole) if whole else (np.empty(0, np.uint32), np.empty(0, np.int64))
        found.append((ids, np.asarray(counts, np.int64)))
        if not side.lossless and whole:
            fits &= _gives_back(side, *found[-1], raw, sizes)
    tables = []
    for side, (ids, counts) in zip((a, b), found, strict=True):
        size = np.array([len(x) for x in side.bytes_of], np.int64)
        if not fits.all():
            ids, counts = ids[np.repeat(fits, counts)], np.where(fits, counts, 0)
        ids = ids.astype(np.int64)
        doc = np.repeat(np.array(places, np.int64), counts)
        # places run on over the documents of the batch: equal texts in bytes on both sides
        end = np.cumsum(size[ids])
        tables.append(pd.DataFrame({"doc": doc, "id": ids, "start": end - size[ids], "end": end}))
    return tables


def document_slices(ta, tb, na, nb, together: int | None = None):
    """First and last document, and the rows of both tables, of documents with about ``together`` tokens of the first side.
    ``na`` and ``nb``: tokens of each document. No token covers one of another document, so slices are aligned by themselves."""
    import numpy as np

    ends = [np.concatenate([[0], np.cumsum(x)]) for x in (na, nb)]
    firsts = _runs(ends[0][:-1] // (together or TOKENS_TOGETHER)).tolist()
    for first, last in zip(firsts, [*firsts[1:], len(na)], strict=True):
        yield first, last, *(t.iloc[end[first]:end[last]] for t, end in zip((ta, tb), ends, strict=True))


def covering(one, other):
    """For each token of ``one``, the row of ``other`` whose token covers its start."""
    import numpy as np
    import pandas as pd

    right = other[["doc", "start"]].assign(row=np.arange(len(other)), other_start=other["start"])
    return pd.merge_asof(one[["doc", "start"]], right, on="start", by="doc")


def overlaps(a, b):
    """Rows of ``a`` and of ``b`` that share a byte: each token with the one that covers its start, both ways."""
    import numpy as np

    left, right = covering(a, b), covering(b, a)
    pairs = np.concatenate([np.stack([np.arange(len(a)), left["row"].to_numpy(np.int64)]),
                            np.stack([right["row"].to_numpy(np.int64), np.arange(len(b))])], axis=1)
    return np.unique(pairs, axis=1), left, right


def groups(left, right):
    """Number of the group of each token of both sides: a new one where both start together."""
    import numpy as np

    return tuple(np.cumsum(x["start"].to_numpy() == x["other_start"].to_numpy()) - 1 for x in (left, right))


def _runs(sorted_values):
    """Starts of the runs of equal values."""
    import numpy as np

    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, np.int64)


def _counted(group, ids):
    """Different ids of each group with their number: group, id, n."""
    import numpy as np

    both = group * PAIR + ids
    keys, n = np.unique(both, return_counts=True)
    return keys // PAIR, keys % PAIR, n


def linked(doc_of_group, ga, a_ids, gb, b_ids):
    """Different linked id pairs of each document with their number: doc, pair, n, sorted."""
    import numpy as np

    g, x, n = _counted(ga, a_ids)
    h, y, m = _counted(gb, b_ids)
    firsts = np.searchsorted(h, np.arange(len(doc_of_group) + 1))
    each = (firsts[1:] - firsts[:-1])[g]  # different ids on the other side of the same group
    left = np.repeat(np.arange(len(g)), each)
    right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(firsts[g], each)
    doc, pair, times = doc_of_group[g[left]], x[left] * PAIR + y[right], n[left] * m[right]
    order = np.argsort(pair)
    order = order[np.argsort(doc[order], kind="stable")]
    doc, pair, times = doc[order], pair[order], times[order]
    at = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])]) if len(doc) else np.empty(0, np.int64)
    return doc[at], pair[at], np.add.reduceat(times, at) if len(at) else times


def group_texts(ga, a_ids, ea, gb, b_ids, eb, marked) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every document; ``ea`` and ``eb`` are the ends of the documents' tokens.

    ``marked[k, id]`` is the id's text with one of ``,|;`` behind it.
    """
    import numpy as np

    n = int(ga[-1]) + 1 if len(ga) else 0
    sizes = [np.bincount(g, minlength=n) for g in (ga, gb)]
    ends = [np.cumsum(x) for x in sizes]
    words = np.empty(len(ga) + len(gb), object)
    # tokens of the first side stand behind those of the second of all groups before, and so on
    for k, (g, ids, other) in enumerate(((ga, a_ids, ends[1] - sizes[1]), (gb, b_ids, ends[0]))):
        last = np.r_[g[1:] != g[:-1], True] if len(g) else np.zeros(0, bool)
        words[np.arange(len(g)) + other[g]] = marked[np.where(last, k + 1, 0), ids]
    at = [0, *(ea + eb).tolist()]
    return ["".join(words[i:j].tolist())[:-1] for i, j in zip(at, at[1:], strict=False)]


_MARKED: dict = {}


def marked_ids(size: int):
    import numpy as np

    if size not in _MARKED:
        _MARKED[size] = np.array([[f"{i}{mark}" for i in range(size)] for mark in ",|;"], object)
    return _MARKED[size]


_BATCH = ("batch string, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>, "
          "pairs array<long>, docs array<int>, ends array<int>, places binary, times binary")


def aligned_batches(df: DataFrame, first: str, second: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A row for each batch of documents: their figures, the batch's different linked pairs with the number of
    documents that hold each, and each document's pairs (by place in that list) with their number."""
    def run(batches: Iterator):
        import uuid

        import numpy as np
        import pyarrow as pa

        a, b = sides(first, second)
        for batch in batches:
            for ids, texts in text_parts(batch.column(0), batch.column(1).to_pylist(), batch_bytes):
                n = len(texts)
                ta, tb = tokenised(texts, a, b)
                na, nb = (np.bincount(t["doc"], minlength=n) for t in (ta, tb))
                n_groups, n_links = np.zeros((2, n), np.int64)
                digests, found = [], []
                for low, high, sa, sb in document_slices(ta, tb, na, nb):
                    ga, gb = groups(covering(sa, sb), covering(sb, sa))
                    ia, ib = sa["id"].to_numpy(), sb["id"].to_numpy()
                    doc_of_group = sa["doc"].to_numpy()[_runs(ga)]
                    n_groups += np.bincount(doc_of_group, minlength=n)
                    in_group = np.bincount(ga, minlength=len(doc_of_group)) * np.bincount(gb, minlength=len(doc_of_group))
                    np.add.at(n_links, doc_of_group, in_group)
                    named = group_texts(ga, ia, np.cumsum(na[low:high]), gb, ib, np.cumsum(nb[low:high]), marked_ids(max(len(a.bytes_of), len(b.bytes_of))))
                    digests += [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in named]
                    found.append(linked(doc_of_group, ga, ia, gb, ib))
                del ta, tb, sa, sb, named
                doc, pair, times = map(np.concatenate, zip(*found, strict=True))
                pairs, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
                ends = np.searchsorted(doc, np.arange(1, n + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex])] + [pa.array([x], pa.list_(pa.int64())) for x in (ids.to_pylist(), na, nb, n_groups, n_links)]
                    + [pa.array([digests]), pa.array([pairs], pa.list_(pa.int64())), pa.array([docs.astype(np.int32)], pa.list_(pa.int32())),
                       pa.array([ends.astype(np.int32)], pa.list_(pa.int32())), pa.array([place.astype(np.int32).tobytes()], pa.binary()),
                       pa.array([times.astype(np.int64).tobytes()], pa.binary())],
                    names=[f.split()[0] for f in _BATCH.split(", ")])

    return df.mapInArrow(run, _BATCH)


def pair_counts(batches: DataFrame) -> DataFrame:
    """``pair, n_docs, best``: documents that hold a pair, and whether no other pair of its first id has more."""
    held = batches.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("x.pairs", F.col("x.docs").cast("long").alias("docs"))
    counts = stored(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n_docs")), "pairs")
    most = counts.groupBy(F.floor(F.col("pair") / F.lit(PAIR)).alias("a")).agg(F.max("n_docs").alias("most"))
    joined = counts.withColumn("a", F.floor(F.col("pair") / F.lit(PAIR))).join(most, "a")
    return joined.select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def align(df: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text",
          batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``n_best`` counts links whose pair no other pair of its first id exceeds in documents; ``count_sum``
    is the sum over links of the documents that hold the pair.
    """
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    batches = stored(aligned_batches(docs, first, second, batch_bytes), "aligned", TEXT_BATCH_BYTES)
    counts = pair_counts(batches)
    held = batches.select(F.col("batch").alias("held_by"), F.explode("pairs").alias("pair")).join(counts, "pair")

    def finish(key, rows, found):
        import numpy as np
        import pyarrow as pa

        row = {c: rows.column(c)[0] for c in rows.column_names}
        order = np.argsort(found.column("pair").to_numpy())
        n_docs, best = found.column("n_docs").to_numpy()[order], found.column("best").to_numpy(zero_copy_only=False)[order]
        place = np.frombuffer(row["places"].as_py(), np.int32)
        times = np.frombuffer(row["times"].as_py(), np.int64)
        ends = np.r_[0, row["ends"].values.to_numpy()]
        sums = [np.r_[0, np.cumsum(x)] for x in (times * best[place], times * n_docs[place])] if len(place) else [np.zeros(1, np.int64)] * 2
        return pa.table({"doc_id": row["doc_ids"].values, "n_a": row["n_a"].values, "n_b": row["n_b"].values,
                         "n_groups": row["n_groups"].values, "n_links": row["n_links"].values}
                        | {c: pa.array(np.diff(s[ends])) for c, s in zip(("n_best", "count_sum"), sums, strict=True)}
                        | {"groups_sha256": row["digests"].values})

    return batches.groupBy("batch").cogroup(held.groupBy("held_by")).applyInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def spans(text: str | None, first: str, second: str) -> list[tuple[int, int, int, int, int]]:
    """All overlapping token pairs of one text: places of both tokens, bytes from and to, number of the group."""
    a, b = tokenised([text], *sides(first, second))
    found, left, right = overlaps(a, b)
    ga, _ = groups(left, right)
    return [(i, j, max(a["start"][i], b["start"][j]), min(a["end"][i], b["end"][j]), int(ga[i])) for i, j in found.T.tolist()]
