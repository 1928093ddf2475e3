"""Operator 1: byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every byte prefix of a piece the table holds the one token that can end its encoding. Token
``t`` ends the prefix of length ``i`` if the prefix without ``t`` ends in a token ``u`` such that
merging the bytes of ``u`` and ``t`` alone gives just ``u, t``. So an append only adds entries, and
after an edit entries are recomputed until as many as the longest token has bytes agree with the
old ones. The ids are read off from the end.

Texts are split by the pattern of the vocabulary; pieces are independent. A piece that is itself a
token gets that id, as the tiktoken library does.

Null and empty texts have no ids; the digests are those of empty input. Rows are independent, so
repeated ids and rows stay as they are; other columns are ignored. Tables without rows give none.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablewatch.llm.common import tokenizer_path
from tablewatch.llm.units import PLAIN, UnitCache

#: Entries kept of pairs and pieces already decided; a full table is emptied, which changes speed only.
MAX_KNOWN = 400_000


class Vocabulary:
    """Tokens by rank, the longest token that ends a byte string, and which token may follow which.

    Behind each byte stands a state: the longest end of the bytes so far that begins a token. It says which
    token is the longest that ends there; shorter ones are ends of that token. Steps between states are found
    when first needed and kept.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.sizes = [0] * (max(self.tokens) + 1)
        for i, t in self.tokens.items():
            self.sizes[i] = len(t)
        self._begins = {t[:i] for t in ranks for i in range(len(t) + 1)}
        self._state_of: dict[bytes, int] = {b"": 0}
        self._held = [b""]
        self._step: dict[int, int] = {}
        #: longest token at the end of a state, and of a token without its first byte (-1: none)
        self.ends = [-1]
        self._shorter: dict[int, int] = {}
        self._follows: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}

    @classmethod
    def from_file(cls, name: str) -> Vocabulary:
        with open(tokenizer_path(name), "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that ``token`` is merged from last, (-1, -1) for a single byte, or None if
        merging its own bytes (the pair of lowest rank first, leftmost on ties) doesn't give it."""
        if token not in self._halves:
            data, lowest = self.tokens[token], 1 << 60
            parts, last = [data[i:i + 1] for i in range(len(data))], (-1, -1)
            while len(parts) > 1:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], lowest), i) for i in range(len(parts) - 1))
                if rank == lowest:
                    break
                last = self.ranks[parts[at]], self.ranks[parts[at + 1]]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = last if len(parts) == 1 else None
        return self._halves[token]

    def follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may stand behind ``before`` (-1: at the start)."""
        known = self._follows.get((before, token))
        if known is None:
            if len(self._follows) >= MAX_KNOWN:
                self._follows.clear()
            known = self._follows[before, token] = self._stays(before, token)
        return known

    def _stays(self, before: int, token: int) -> bool:
        """Undo the merges of both tokens, latest first: they stay apart if at no time a merge over
        their border came before the merges that are undone."""
        if self.halves(token) is None or before >= 0 and self.halves(before) is None:
            return False
        if before < 0:
            return True
        left, right, bound = before, token, 1 << 60
        while True:
            if self.ranks.get(self.tokens[left] + self.tokens[right], bound) < bound:
                return False
            inner, outer = self.halves(left)[1], self.halves(right)[0]
            if inner < 0 and outer < 0:
                return True
            if outer < 0 or inner >= 0 and left > right:
                left, bound = inner, left
            else:
                # of equal ranks the left one is merged first, so one over the border precedes this
                right, bound = outer, right + 1

    def _longest_end(self, data: bytes) -> int:
        for start in range(len(data)):
            token = self.ranks.get(data[start:])
            if token is not None:
                return token
        return -1

    def _stepped(self, state: int, byte: int) -> int:
        """The state behind ``byte``; kept for the next time."""
        data = self._held[state] + bytes([byte])
        while data not in self._begins:
            data = data[1:]
        found = self._state_of.get(data)
        if found is None:
            found = self._state_of[data] = len(self._held)
            self._held.append(data)
            self.ends.append(self._longest_end(data))
        self._step[state << 8 | byte] = found
        return found

    def shorter(self, token: int) -> int:
        """The longest token that ends ``token`` and isn't it, -1 if there is none."""
        found = self._shorter.get(token)
        if found is None:
            found = self._shorter[token] = self._longest_end(self.tokens[token][1:])
        return found

    def last_tokens(self, data: bytes, last: list[int], states: list[int], end: int) -> None:
        """Append to ``last`` the tokens that end the prefixes longer than it covers, up to ``end`` bytes,
        and to ``states`` the states there."""
        step, ends, known, sizes = self._step.get, self.ends, self._follows.get, self.sizes
        state = states[-1]
        for stop in range(len(last), end + 1):
            byte = data[stop - 1]
            at = step(state << 8 | byte)
            state = self._stepped(state, byte) if at is None else at
            token = ends[state]
            while token >= 0:
                before = last[stop - sizes[token]]
                fits = known((before, token))
                if fits or fits is None and self.follows(before, token):
                    break
                token = self.shorter(token)
            else:
                raise ValueError("no token ends this prefix: the vocabulary lacks single bytes")
            last.append(token)
            states.append(state)

    def ids(self, last: list[int]) -> list[int]:
        """The ids that a table of last tokens stands for."""
        out, end, sizes = [], len(last) - 1, self.sizes
        while end:
            token = last[end]
            out.append(token)
            end -= sizes[token]
        out.reverse()
        return out


class PrefixTable:
    """Byte string with the last token of each of its prefixes (``last[0]`` is -1)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last, self.states = vocabulary, b"", [-1], [0]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes at the end; no entry for an older prefix changes."""
        self.data += data
        self.vocabulary.last_tokens(self.data, self.last, self.states, len(self.data))

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of the bytes from ``start`` to ``end``; returns how many entries
        were computed anew."""
        old, old_states, shift = self.last, self.states, len(data) - (end - start)
        self.data = self.data[:start] + data + self.data[end:]
        self.last, self.states = old[:start + 1], old_states[:start + 1]
        agreed, settled = 0, start + len(data)
        while len(self.last) <= len(self.data):
            at = len(self.last)
            self.vocabulary.last_tokens(self.data, self.last, self.states, at)
            agreed = agreed + 1 if at > settled and old[at - shift] == self.last[at] else 0
            if agreed >= self.vocabulary.longest:
                # a state depends on no more bytes than the longest token has, and these are the old ones
                self.last += old[at - shift + 1:]
                self.states += old_states[at - shift + 1:]
                return at - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.vocabulary.ids(self.last)


class Encoder:
    """Whole texts to ids and back."""

    def __init__(self, name: str, pattern: str):
        import regex

        self.vocabulary = Vocabulary.from_file(name)
        self.pieces_of = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.units = UnitCache(self._unit)

    def piece(self, piece: str) -> tuple[int, ...]:
        ids = self.known.get(piece)
        if ids is None:
            data = piece.encode()
            token = self.vocabulary.ranks.get(data)
            ids = (token,) if token is not None else tuple(PrefixTable(self.vocabulary, data).ids())
            if len(self.known) >= MAX_KNOWN:
                self.known.clear()
            if len(piece) <= 64:
                self.known[piece] = ids
        return ids

    def _unit(self, unit: str) -> tuple[tuple[int, ...], str, bytes]:
        """Ids, their decimals joined by commas, and the bytes they decode to."""
        plain = PLAIN.fullmatch(unit, 1) if unit[0] == " " else None
        if plain:
            ids = self.piece(" " + plain[1]) + self.piece(plain[2]) if plain[2] else self.piece(unit)
        else:
            ids = tuple(chain.from_iterable(map(self.piece, self.pieces_of(unit))))
        return ids, ",".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(u[0] for u in self.units(text or "")))

    def digests(self, text: str | None) -> tuple[list, str, str]:
        """The units' ids, and the hex SHA-256 of the joined decimals and of the decoded bytes."""
        units = self.units(text or "")
        decimals, raw = ",".join([u[1] for u in units]), b"".join([u[2] for u in units])
        return [u[0] for u in units], hashlib.sha256(decimals.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(name: str, pattern: str) -> Encoder:
    """The encoder of this Python process."""
    if (name, pattern) not in _ENCODERS:
        _ENCODERS[name, pattern] = Encoder(name, pattern)
    return _ENCODERS[name, pattern]


def encode(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, on request, the ids.

    ``vocabulary`` is a rank file (name of a public one or an absolute path on every node). The
    digests are of the decimal ids joined by commas, and of the bytes that the ids decode to.
    """
    fields = [T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator):
        import pyarrow as pa

        enc = encoder(vocabulary, pattern)
        for batch in batches:
            out = {"n": [], "ids": [], "hash": [], "back": []}
            for text in batch.column(1).to_pylist():
                ids, of_ids, of_bytes = enc.digests(text)
                out["n"].append(sum(map(len, ids)))
                out["hash"].append(of_ids)
                out["back"].append(of_bytes)
                if with_ids:
                    out["ids"].append(list(chain.from_iterable(ids)))
            columns = [batch.column(0), pa.array(out["n"], pa.int64()), pa.array(out["hash"], pa.string()),
                       pa.array(out["back"], pa.string())]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the texts of id lists; bytes that are not UTF-8 become the replacement mark."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator):
        import pyarrow as pa

        enc = encoder(vocabulary, pattern)
        for batch in batches:
            texts = [enc.decode(x.as_py() or ()).decode(errors="replace") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return df.select(df[id_col].alias("doc_id"), df[ids_col].alias("ids")).mapInArrow(run, schema)
