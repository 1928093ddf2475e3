"""Ids of whole texts by the tokenizers library, as bytes (little-endian unsigned 32 bit each).

A text is cut where the vocabulary's own rules separate tokens; what lies between is given to the
library once and looked up later, which gives the ids of the whole text. The words of many texts are
looked up together, each different one once.
"""

from __future__ import annotations

import os
import re
from array import array

from tablewatch.llm.common import SPACE_CHARS, tokenizer_path
from tablewatch.llm.units import PLAIN, PLAIN_PARTS, ArrowWordTable, gathered, has_runs, in_order, units_of

#: Words that a process keeps for look-up, half of them in each of two generations, and four times as many without the
#: marks behind them, in arrays of about 40 bytes a word.
MAX_KNOWN = 600_000
#: Characters of text that are looked up together, about, and new words that the library gets at once.
TOGETHER, NEW_TOGETHER = 8 << 20, 1000
#: In front of a part of a text that has no space before it; no part has it there by itself.
BARE = "\n\n"
#: Stands for a space in a byte-level vocabulary.
SPACE = "Ġ"
#: Ends the last token of a word, in a vocabulary that drops the white space between words.
WORD_END = "</w>"


def id_bytes(ids) -> bytes:
    return array("I", ids).tobytes()


class LibraryTokens:
    """``byte_level``: the vocabulary's pattern keeps one leading space; else it drops white space.

    As the library does by default, a special token's string in a text becomes that token, unless
    ``special_as_text``. Such a token cuts the text wherever it stands, so texts with one go to the library whole.
    ``max_known`` bounds what is kept for look-up, and changes speed only.
    """

    def __init__(self, name: str, byte_level: bool, special_as_text: bool = False, max_known: int = MAX_KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import numpy as np
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path(name))
        self.library.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.size = self.library.get_vocab_size()
        self.max_known = max_known
        self.known: dict[str, bytes] = {}
        self.byte_level = byte_level
        self.table = ArrowWordTable(self._parts, max_known // 2)
        #: Words without the marks behind them, as they stand behind a space: what the library is asked for, so more are kept.
        self.heads = ArrowWordTable(self._head_ids, 2 * max_known)
        #: For each id, whether its token begins with a space, and whether it ends a word.
        self.begins, self.ends = np.zeros((2, 1 + max(self.library.get_vocab().values())), bool)
        self.begins[[i for entry, i in self.library.get_vocab().items() if entry[0] == SPACE]] = True
        self.ends[[i for entry, i in self.library.get_vocab().items() if entry.endswith(WORD_END)]] = True
        self.odd = re.compile("[\x1c-\x1f]")

    def _library(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            found = id_bytes(self.library.encode(part, add_special_tokens=False).ids)
            if len(self.known) >= self.max_known:
                self.known = {}
            if len(part) <= 64:
                self.known[part] = found
        return found

    def _spaced_unit(self, unit: str) -> bytes:
        plain = PLAIN.fullmatch(unit, 1) if unit[0] == " " else None
        if plain and plain[2]:
            return self._library(" " + plain[1]) + self._library(plain[2])
        return self._library(unit)

    def _head_ids(self, heads):
        """Ids of words as they stand behind a space. They go to the library as few texts, whose ids are cut
        in front of every token that begins with a space, or behind every one that ends a word."""
        import numpy as np

        heads, parts, counts = heads.to_pylist(), [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for first in range(0, len(heads), NEW_TOGETHER):
            some = heads[first:first + NEW_TOGETHER]
            text = (" " if self.byte_level else "") + " ".join(some)
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
            own = np.diff(np.flatnonzero(self.begins[ids]), append=len(ids)) if self.byte_level else np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(own) != len(some) or own.sum() != len(ids):
                raise ValueError("the library's tokens don't end where the words do")
            parts.append(ids)
            counts.append(own)
        return np.concatenate(parts), np.concatenate(counts)

    def _parts(self, parts):
        """Ids of the parts between white space, behind a space where the vocabulary keeps it, unless a part begins
        with a line end or ``BARE``. Most are a word whose ids stand by themselves, and marks."""
        import numpy as np
        import pyarrow.compute as pc

        fields = pc.extract_regex(parts, PLAIN_PARTS)
        short = pc.less_equal(pc.utf8_length(parts), 64)
        plain = pc.is_valid(fields)
        heads, tails = pc.struct_field(fields, 0), pc.struct_field(fields, 1)
        if self.byte_level:
            apart = pc.and_(pc.not_equal(parts, ""), pc.and_not(pc.equal(pc.utf8_rtrim_whitespace(parts), parts), pc.starts_with(parts, "\n")))
            heads, tails = pc.if_else(plain, heads, parts), pc.if_else(plain, tails, "")
            joined = pc.and_(short, pc.or_(plain, apart))
        else:
            heads, joined = pc.utf8_lower(heads), pc.and_(short, plain)
        joined = joined.to_numpy(zero_copy_only=False)
        heads, tails = (x.filter(joined).dictionary_encode() for x in (heads, tails))
        pool, begins, sizes = self.heads.coded(heads.dictionary)
        others = [self._library(tail) if tail else b"" for tail in tails.dictionary.to_pylist()]
        others += [self._unit(part) for part in parts.filter(~joined).to_pylist()]
        lengths = np.fromiter(map(len, others), np.int64, len(others)) // 4
        begins = np.concatenate([begins, len(pool) + np.cumsum(lengths) - lengths, [0]])
        sizes = np.concatenate([sizes, lengths, [0]])
        pool = np.concatenate([pool, np.frombuffer(b"".join(others), "<u4")])
        # of each part: the head and the tail, or itself and nothing
        at = np.empty((len(parts), 2), np.int64)
        at[joined, 0], at[joined, 1] = heads.indices.to_numpy(), len(heads.dictionary) + tails.indices.to_numpy()
        at[~joined, 0] = len(heads.dictionary) + len(tails.dictionary) + np.arange(len(parts) - joined.sum())
        at[~joined, 1] = len(sizes) - 1
        return gathered(pool, begins[at.ravel()], sizes[at.ravel()]), sizes[at].sum(axis=1)

    def _unit(self, part: str) -> bytes:
        if not self.byte_level:
            return self._library(part) if part else b""
        return b"" if part == BARE else self._spaced_unit(part.removeprefix(BARE) if part[:1] == "\n" else " " + part)

    def _cut(self, text: str) -> list[str]:
        """The parts of a text that Arrow's cut at spaces would not give."""
        if not self.byte_level:  # \x1c-\x1f are white space to Arrow and Python only
            return re.split(f"[{SPACE_CHARS}]+", text)
        return [u[1:] if u[0] == " " and not u[1:2].isspace() else BARE + u for u in units_of(text)]

    def many(self, texts: list[str | None]):
        """(ids of all texts, number of ids of each) as arrays; texts of about ``TOGETHER`` characters at a time."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        plain, cut, whole = [], [], []
        for i, text in enumerate(texts):
            if text:
                if any(s in text for s in self.special):
                    whole.append(i)
                elif has_runs(text) if self.byte_level else self.odd.search(text):
                    cut.append(i)
                else:
                    plain.append(i)
        groups = []
        if plain:
            own = pa.array([texts[i] for i in plain], pa.string())
            if self.byte_level:
                own = pc.binary_join_element_wise(BARE, pc.replace_substring(own, "\n", " \n"), "")
            groups.append((plain, *self.table.laid_out(pc.split_pattern(own, " ") if self.byte_level else pc.utf8_split_whitespace(own))))
        if cut:
            groups.append((cut, *self.table.laid_out(pa.array([self._cut(texts[i]) for i in cut], pa.list_(pa.string())))))
        for i in whole:
            ids = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, "<u4")
            groups.append(([i], ids, [len(ids)]))
        return in_order(len(texts), groups)

    def __call__(self, text: str | None) -> bytes:
        return self.many([text])[0].tobytes()


_LOADED: dict[tuple[str, bool, bool, int], LibraryTokens] = {}


def library_tokens(name: str, byte_level: bool, special_as_text: bool = False, max_known: int = MAX_KNOWN) -> LibraryTokens:
    """The tokenizer of this Python process."""
    key = name, byte_level, special_as_text, max_known
    if key not in _LOADED:
        _LOADED[key] = LibraryTokens(*key)
    return _LOADED[key]
