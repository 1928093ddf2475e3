"""Alignment against brute force over whole texts of both libraries."""
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablewatch.llm import alignment as A

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
PARTS = ["a", "The", " ", "  ", "\n", "é", "中文", "😀", "ing", "\t", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "123", "don't", "aaaa", "\x00", "२", "İ", "ﬁ"]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(public_tokenizers.path(FIRST))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(SECOND))


def ranges(text, libraries):
    """``[(id, start, end)]`` of both sides, or none if their bytes aren't those of the text."""
    first, second = libraries
    out = []
    if not text:
        return [], []
    byte_of = A._byte_of()
    one = [(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    two = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode())
           for i in second.encode(text) for p in [second.id_to_piece(i)]]
    for tokens in (one, two):
        if b"".join(b for _, b in tokens) != (" " + text).encode():
            return [], []
        at, own = 0, []
        for i, b in tokens:
            own.append((i, at, at + len(b)))
            at += len(b)
        out.append(own)
    return out


def brute(rows, libraries):
    docs, held = [], Counter()
    for doc_id, text in rows:
        a, b = ranges(text, libraries)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [([i for i, s, e in a if lo <= s and e <= hi], [i for i, s, e in b if lo <= s and e <= hi]) for lo, hi in zip([0, *cuts], cuts)]
        links = [(x, y) for own, other in groups for x in own for y in other]
        held.update(set(links))
        docs.append((doc_id, a, b, groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return Counter((d, len(a), len(b), len(g), len(ls), sum(held[p] == most[p[0]] for p in ls), sum(held[p] for p in ls),
                    hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest() if g else "")
                   for d, a, b, g, ls in docs)


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25)))) for i in range(n)]
    return rows + [(None, "a null id"), (1, "the the the"), (1, "the the the"), (5000, None), (5001, ""), (5002, "one ▁ mark"),
                   (5003, " ".join(f"w{i % 50}" for i in range(4000))), (5004, "x" * 3000), (5005, " "), (5006, " both ends ")]


def test_against_brute_force(spark, libraries):
    rows = random_rows(400, 11)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, batch string, pair int")
    want = brute(rows, libraries)
    assert Counter(map(tuple, A.align(df, FIRST, SECOND).collect())) == want
    assert Counter(map(tuple, A.align(df, FIRST, SECOND, batch_bytes=300).collect())) == want  # many batches
    assert A.align(df.limit(0), FIRST, SECOND).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, A.align(nothing, FIRST, SECOND).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_overlaps_are_all_pairs_that_share_bytes(libraries):
    for _, text in random_rows(150, 12):
        a, b = ranges(text, libraries)
        if len(a) * len(b) > 100_000:
            continue
        want = {(i, j, max(s, t), min(e, f)) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b) if max(s, t) < min(e, f)}
        assert {x[:4] for x in A.spans(text, FIRST, SECOND)} == want
