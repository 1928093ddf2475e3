"""Cutting a text where its tokens cannot cross, so that parts can be encoded once and looked up.

A token pattern with one optional leading space never joins a character with white space behind
it. A text may therefore be cut in front of every run of white space: each unit is a run of white
space (maybe none) and the run of other characters behind it, and encodes to the same ids wherever
it stands.
"""

from __future__ import annotations

import re

#: The characters with Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a" \
    "\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
_RUNS = [a + b for a in WHITE_SPACE for b in " \n"]
_ASCII_RUNS = [run for run in _RUNS if run.isascii()]
#: A word of letters that have one form only, and the ASCII marks behind it.
PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?]*)")
PLAIN_PARTS = "^(?P<head>[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)(?P<tail>[.,;:!?]*)$"


def units_of(text: str) -> list[str]:
    return _UNIT.findall(text)


class UnitCache:
    """Looks up what ``encode_unit(unit)`` gives for each unit of a text.

    Units behind one space are kept under their text without it, since splitting at the space is
    the cheapest cut. When the cache holds ``limit`` units it is put aside, and what is used again moves
    to a new one, which changes speed only; units over 64 characters are not kept.
    """

    def __init__(self, encode_unit, limit: int = 400_000):
        self.encode_unit, self.limit = encode_unit, limit
        self.spaced: dict = {}
        self.before: dict = {}
        self.other: dict = {}

    def __call__(self, text: str) -> list:
        if not text:
            return []
        if len(self.spaced) > self.limit:
            self.before, self.spaced = self.spaced, {}
        if len(self.other) > self.limit:
            self.other = {}
        if has_runs(text):
            return [self._other(u) for u in units_of(text)]
        parts = text.replace("\n", " \n").split(" ")
        first = parts.pop(0)
        get = self.spaced.get
        found = [get(p) for p in parts]
        if None in found:
            new = {p for p, value in zip(parts, found) if value is None}
            self.spaced.update((p, value) for p in new if (value := self.before.get(p)) is not None)
            for i, value in enumerate(found):
                if value is None:
                    found[i] = self._spaced(parts[i])
        return [self._other(first), *found] if first else found

    def _spaced(self, part: str):
        value = self.spaced.get(part)
        if value is None:
            value = self.encode_unit(part if part.startswith("\n") else " " + part)
            if len(part) <= 64:
                self.spaced[part] = value
        return value

    def _other(self, unit: str):
        value = self.other.get(unit)
        if value is None:
            value = self.encode_unit(unit)
            if len(unit) <= 64:
                self.other[unit] = value
        return value


def text_parts(ids, texts, batch_bytes: int):
    """Slices of a batch of about so many characters of text, one document at least."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > at and held + size > batch_bytes:
            yield ids[at:i], texts[at:i]
            at, held = i, 0
        held += size
    if at < len(texts):
        yield ids[at:], texts[at:]


class WordTable:
    """Ids of the words of many texts. Arrow finds the different words, each is looked up once, and the
    ids are laid out as arrays.

    ``encode(words)`` gives the id bytes of a list of different words. At most ``limit`` words are kept in
    each of two generations, those used again move to the younger; it changes speed only. Words over 64
    characters are not kept.
    """

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def found(self, words: list[str]) -> list[bytes]:
        if len(self.now) >= self.limit:
            self.before, self.now = self.now, {}
        out = list(map(self.now.get, words))
        missing = [i for i, value in enumerate(out) if value is None]
        if not missing:
            return out
        older = list(map(self.before.get, [words[i] for i in missing]))
        new = [i for i, value in zip(missing, older) if value is None]
        for i, value in zip(missing, older):
            out[i] = value
        for i, value in zip(new, self.encode([words[i] for i in new]), strict=True):
            out[i] = value
        keep = [i for i in missing if len(words[i]) <= 64][:max(0, self.limit - len(self.now))]
        self.now.update(zip(map(words.__getitem__, keep), map(out.__getitem__, keep)))
        return out

    def laid_out(self, words):
        """(ids of all texts, number of ids of each) for an Arrow list of words for each text."""
        import numpy as np

        ends = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        pool, begins, sizes = self.coded(coded.dictionary)
        at = coded.indices.to_numpy()
        upto = np.concatenate([[0], np.cumsum(sizes[at])])
        return gathered(pool, begins[at], sizes[at]), np.diff(upto[ends - ends[0]])

    def coded(self, different):
        """For an Arrow array of different words: (ids, where those of each word begin in them, how many they are)."""
        import numpy as np

        values = self.found(different.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        return np.frombuffer(b"".join(values), "<u4"), np.cumsum(sizes) - sizes, sizes


class Kept:
    """Words with their ids, as arrays."""

    def __init__(self, words, ids, sizes):
        self.words, self.ids, self.sizes = words, ids, sizes

    @classmethod
    def none(cls):
        import numpy as np
        import pyarrow as pa

        return cls(pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64))

    def __len__(self) -> int:
        return len(self.words)


class ArrowWordTable(WordTable):
    """A ``WordTable`` of arrays alone: ``encode(words)`` gives (ids, number of ids of each) for an Arrow array of
    different words, and Arrow looks the words up."""

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit
        self.now, self.before = Kept.none(), Kept.none()

    def coded(self, different):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.now) >= self.limit:
            self.before, self.now = self.now, Kept.none()
        now, before = (pc.fill_null(pc.index_in(different, value_set=kept.words), -1).to_numpy() for kept in (self.now, self.before))
        slot = np.where(now >= 0, now, np.where(before >= 0, before + len(self.now), -1)).astype(np.int64)
        new = np.flatnonzero(slot < 0)
        ids, sizes = self.encode(different.take(pa.array(new)))
        slot[new] = len(self.now) + len(self.before) + np.arange(len(new))
        pool = np.concatenate([self.now.ids, self.before.ids, ids])
        sizes = np.concatenate([self.now.sizes, self.before.sizes, sizes])
        begins, sizes = (np.cumsum(sizes) - sizes)[slot], sizes[slot]
        keep = np.flatnonzero((now < 0) & pc.less_equal(pc.utf8_length(different), 64).to_numpy(zero_copy_only=False))
        keep = keep[:max(0, self.limit - len(self.now))]
        if len(keep):
            self.now = Kept(pa.concat_arrays([self.now.words, different.take(pa.array(keep))]),
                            np.concatenate([self.now.ids, gathered(pool, begins[keep], sizes[keep])]),
                            np.concatenate([self.now.sizes, sizes[keep]]))
        return pool, begins, sizes


def gathered(pool, begins, sizes):
    """The runs of ``pool`` that begin at ``begins`` and are ``sizes`` long, one behind another."""
    import numpy as np

    place = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
    place += np.arange(len(place))
    return pool[place]


def in_order(n: int, groups):
    """(ids of all texts, number of ids of each) from groups ``(places, ids, counts)`` of the ``n`` texts."""
    import numpy as np

    groups = [g for g in groups if len(g[0])]
    if len(groups) == 1 and len(groups[0][0]) == n:
        return groups[0][1], groups[0][2]
    counts, parts = np.zeros(n, np.int64), [np.empty(0, "<u4")] * n
    for places, ids, own in groups:
        counts[places] = own
        for place, part in zip(places, np.split(ids, np.cumsum(own)[:-1])):
            parts[place] = part
    return np.concatenate([np.empty(0, "<u4"), *parts]), counts


def has_runs(text: str) -> bool:
    """Whether white space stands in front of a space or a line end."""
    return any(run in text for run in (_ASCII_RUNS if text.isascii() else _RUNS))
