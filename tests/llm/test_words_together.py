"""Words of many texts looked up together: same ids, bounded memory."""
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablewatch.llm import alignment as A
from tablewatch.llm import libtokens
from tablewatch.llm.units import ArrowWordTable, WordTable, text_parts

PARTS = ["a", "The", "the,", " ", " ", "  ", "\n", "é.", "中文", "ing", "\t", "\x1c", "　", "<|endoftext|>", "123", "don't", "Été!", "\r\n"]


def some_texts(n, seed):
    rng = random.Random(seed)
    return [None, "", " ", *["".join(rng.choices(PARTS, k=rng.randint(1, 12))) for _ in range(n)]]


@pytest.mark.parametrize("name,byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize("max_known", [7, 100_000])
def test_ids_of_many_texts_are_those_of_each(name, byte_level, max_known):
    own, library = libtokens.LibraryTokens(name, byte_level, max_known=max_known), Tokenizer.from_file(public_tokenizers.path(name))
    texts = some_texts(1500, 5)
    ids, counts = own.many(texts)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert list(counts) == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    # what is kept is bounded by its size alone
    assert max(len(own.table.now), len(own.table.before)) <= max_known and len(own.known) <= max_known + 2


def test_word_table_keeps_a_bounded_number_of_words():
    asked = []
    table = WordTable(lambda words: asked.append(len(words)) or [np.array([len(w)], "<u4").tobytes() for w in words], 50)
    for start in range(0, 1000, 100):
        words = [f"w{i}" for i in range(start, start + 100)]
        ids, counts = table.laid_out(pa.array([words, [], words[:3] * 2], pa.list_(pa.string())))
        assert ids.tolist() == [len(w) for w in words + words[:3] * 2] and counts.tolist() == [100, 0, 6]
        assert len(table.now) <= 50 and len(table.before) <= 50
    assert sum(asked) == 1000


def test_alignment_keeps_a_bounded_number_of_words_on_both_sides(monkeypatch):
    monkeypatch.setattr(A, "MAX_KNOWN", 20)
    side = A.PieceSide("piece_bpe_32k.model")
    texts = [t for t in some_texts(300, 9) if t]
    ids, counts = side.many(texts)
    assert ids.tolist() == [i for t in texts for i in side.model.encode(t)] and counts.sum() == len(ids)
    assert len(side.table.now) <= 20 and len(side.table.before) <= 20


def test_parts_of_a_batch_hold_at_least_a_text():
    ids, texts = pa.array(range(5)), ["aaaa", None, "bbbbbbbbb", "", "c"]
    assert [t for _, t in text_parts(ids, texts, 5)] == [["aaaa", None], ["bbbbbbbbb"], ["", "c"]]
    assert [x for i, _ in text_parts(ids, texts, 5) for x in i.to_pylist()] == list(range(5))


class Counted:
    def __init__(self, library):
        self.library, self.calls = library, 0

    def encode(self, *given, **named):
        self.calls += 1
        return self.library.encode(*given, **named)


@pytest.mark.parametrize("name,byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_new_words_go_to_the_library_together(name, byte_level):
    own = libtokens.LibraryTokens(name, byte_level)
    own.library = counted = Counted(own.library)
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeéÉßxyz", k=rng.randint(1, 9))) + rng.choice(["", "", ".", "!!"]) for _ in range(5000)]
    texts = [" ".join(words[i:i + 50]) for i in range(0, 5000, 50)]
    ids, counts = own.many(texts)
    want = [counted.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    assert counted.calls <= 250  # the first part of each text is looked up by itself where a space belongs to a word
    before, again = counted.calls, own.many(texts[:10])
    assert again[0].tolist() == ids[:len(again[0])].tolist() and counted.calls == before


def test_arrow_word_table_keeps_a_bounded_number_of_words():
    table = ArrowWordTable(lambda words: (np.array([len(w) for w in words.to_pylist()], "<u4"), np.ones(len(words), np.int64)), 50)
    for start in [*range(0, 1000, 70), 0, 0]:
        words = [f"w{i}" for i in range(start, start + 100)] + ["x" * 70]
        ids, counts = table.laid_out(pa.array([words, [], words[:3] * 2], pa.list_(pa.string())))
        assert ids.tolist() == [len(w) for w in words + words[:3] * 2] and counts.tolist() == [101, 0, 6]
        assert len(table.now) <= 50 and len(table.before) <= 50 and "x" * 70 not in table.now.words.to_pylist()
