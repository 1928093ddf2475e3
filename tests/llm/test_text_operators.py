"""Operators on texts against brute force, on small tables with nulls, ties, long texts and clashing names."""
import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tablewatch.llm import bpe, exact_dedup, libtokens, line_dedup, packing, quality_rules, simhash, token_files, warc
from tablewatch.llm.graph import components

RANKS = "byte_bpe_multi_50k.tiktoken"
PARTS = ["a", "B", " ", "\n", "  ", "\t", "\x85", " ", "\x1c", "'s", "É", "ß", "Σ", "中", "文", "1", "२", "!", "the", "ing",
         "<|endoftext|>", "é", "​", "İ", "😀", "\r\n", "aaaa", "\x00", " \n", "'LL", "it's,ok", "x;", "ÀB.,"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns with odd names."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    line = " ".join(f"same{i}" for i in range(60))
    rows = [(1, "Hello World"), (2, "hello world"), (3, None), (4, ""), (None, "HELLO world"), (6, long), (7, long + " tail"),
            (7, long + " tail"), (8, "Ä" * 3000), (9, f"head\n{line}\nend"), (10, f"{line}\n{line}\nother words here"),
            (11, " \t\r\n "), (12, "straße É é")]
    return spark.createDataFrame([(i, t, "n", None, 0) for i, t in rows],
                                 "doc_id long, text string, source string, digest string, n int")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def texts(n, seed, parts=PARTS, most=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference_bpe():
    with open(public_tokenizers.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_that_of_the_library(reference_bpe):
    enc = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for text in texts(2500, 1):
        ids = enc.encode(text)
        assert ids == reference_bpe.encode_ordinary(text)
        assert enc.decode(ids) == text.encode()


def test_bpe_append_and_edit_keep_the_table_exact():
    vocabulary, rng = bpe.encoder(RANKS, public_tokenizers.PATTERN).vocabulary, random.Random(2)
    for _ in range(150):
        data = bytes(rng.choices(b"abcth e'ing", k=rng.randint(0, 300)))
        a = rng.randint(0, len(data))
        b, new = min(len(data), a + rng.randint(0, 5)), bytes(rng.choices(b"abth", k=rng.randint(0, 4)))
        edited, plain = bpe.PrefixTable(vocabulary, data), bpe.PrefixTable(vocabulary, data[:a] + new + data[b:])
        work = edited.replace(a, b, new)
        assert edited.last == plain.last and edited.ids() == plain.ids() and work <= len(plain.data) - a
        grown = bpe.PrefixTable(vocabulary, data[:a])
        grown.append(data[a:])
        assert grown.last == bpe.PrefixTable(vocabulary, data).last
    far = bpe.PrefixTable(vocabulary, b"the thing " * 200)
    assert far.replace(10, 11, b"x") < 200  # not the whole rest


def test_bpe_query_shape(odd, reference_bpe):
    out = bpe.encode(odd, RANKS, public_tokenizers.PATTERN, with_ids=True)
    want = []
    for r in odd.collect():
        ids = reference_bpe.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert Counter(rows_of(out.drop("ids"))) == Counter(want)
    back = bpe.decode(out, RANKS, public_tokenizers.PATTERN)
    assert Counter(rows_of(back)) == Counter((r["doc_id"], r["text"] or "") for r in odd.collect())
    assert bpe.encode(odd.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("name,byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_library_tokens_are_those_of_whole_texts(name, byte_level):
    own, library = libtokens.LibraryTokens(name, byte_level), Tokenizer.from_file(public_tokenizers.path(name))
    for text in texts(2500, 3, [*PARTS, "<|startoftext|>", "<|ENDOFTEXT|>"]):
        assert own(text) == libtokens.id_bytes(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_exact_dedup(odd):
    got = rows_of(exact_dedup.exact_dedup(odd))
    groups: dict[str, list] = {}
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    for r in odd.collect():
        groups.setdefault(low(r["text"]), []).append(r["doc_id"])
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert Counter(got) == Counter(want)
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0


def brute_groups(fps):
    """Smallest index reachable over links, for each index."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= simhash.MAX_BITS):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint_of_shingles():
    import xxhash

    def plain(text):
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate(
            str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
        shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    for text in ["", " ", "one", "One two three", "a b c d", "a b c d a b c d a b c d", *texts(300, 4, most=40)]:
        assert simhash.fingerprint(text) == plain(text)
    assert simhash.fingerprint(None) == 0


def test_near_duplicates(spark, odd, sf_small):
    for df in (odd.filter("doc_id IS NOT NULL"), spark.read.parquet(f"{sf_small}/documents.parquet")):
        got = df.sparkSession.createDataFrame(simhash.near_duplicates(df).toPandas()).orderBy("doc_id").collect()
        fps = np.array([int(r["fingerprint"], 16) for r in got], np.uint64)
        ids = [r["doc_id"] for r in got]
        assert [r["component_id"] for r in got] == [ids[i] for i in brute_groups(fps)]
    both = rows_of(simhash.near_duplicates(odd.filter("doc_id = 2 OR doc_id IS NULL")))
    assert {r[2] for r in both} == {2}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("blocks,chunk", [(6, 60), (7, 5000)])
def test_links_of_dense_groups(spark, blocks, chunk):
    rng = np.random.default_rng(5)
    fps = []
    for centre in rng.integers(0, 1 << 63, 5, dtype=np.uint64):
        for _ in range(200):
            x = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(bit)
            fps.append(x)
    fps = np.sort(np.unique(np.array(fps, np.uint64)).view(np.int64))
    links = simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp long"), blocks, chunk)
    led = {r["u"]: r["v"] for r in components(links).collect()}
    roots = brute_groups(fps.view(np.uint64))
    assert [led.get(int(x), int(x)) for x in fps] == [int(fps[i]) for i in roots]
    assert links.count() < 15 * 10 * len(fps)  # forests, not all pairs


def test_pivots_discard_no_link():
    rng = np.random.default_rng(6)
    refs = np.array(simhash.pivots(), np.uint64)
    fps = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64) & np.uint64(0xFFFF))
    led = simhash.cell_links(fps, refs)
    assert all(np.bitwise_count(fps[a] ^ fps[b]) <= simhash.MAX_BITS for a, b in led)
    assert len(led) == len(fps) - len(set(brute_groups(fps)))


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 120)] + [(500, 700), (700, 600), (500, 500)], "u long, v long")
    assert dict(rows_of(components(chain))) == {i: 1 for i in range(2, 121)} | {600: 500, 700: 500}
    assert components(chain.limit(0)).count() == 0


def test_packing(odd):
    table = packing.pack_documents(odd, "word_bpe_49k.json", 2, size=64).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    seen = Counter()
    for r in odd.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        seen.update((r["doc_id"], at, tuple(ids[at:at + 64]), len(ids)) for at in range(0, len(ids), 64))
    assert Counter((r["doc_id"], r["start"], tuple(r["ids"]), r["doc_tokens"]) for r in table) == seen
    sequences: dict[int, list] = {}
    for r in table:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(odd.limit(0), "word_bpe_49k.json", 2).count() == 0


def test_ranks_of_a_large_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 50)
    rows = [(i, 0, 5 if i % 3 else 7, 1, 5) for i in range(700)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"), 32)
    places = [(r["sequence_id"], r["offset"] + k) for r in out.collect() for k in range(r["length"])]
    assert out.count() == 700 and len(places) == len(set(places))


def test_histogram_packing_keeps_every_piece():
    rng = random.Random(7)
    for _ in range(60):
        size = rng.choice([8, 64, 500])
        counts = {rng.randint(1, size): rng.choice([1, 2, 50, 10**9]) for _ in range(rng.randint(0, 30))}
        used: Counter = Counter()
        for packs, content in packing.pack_histogram(counts, size):
            assert packs > 0 and sum(n * k for n, k in content) <= size
            for n, k in content:
                used[n] += packs * k
        assert used == Counter(counts)


def test_code_lengths_and_round_trip():
    rng = np.random.default_rng(8)
    for size, limit in ((1, 20), (2, 20), (300, 20), (300, 9), (5000, 13)):
        counts = (rng.pareto(0.5, size) * 10).astype(np.int64) + 1
        lengths = token_files.code_lengths(counts, limit)
        assert lengths.max() <= limit and sum(0.5 ** lengths.astype(float)) <= 1
        code = token_files.Code(lengths)
        ids = rng.integers(0, size, 3001)
        bits, offsets = code.encode(ids)
        assert (code.decode(bits, offsets, len(ids)) == ids).all()
    assert token_files.code_lengths([5, 9, 12, 13, 16, 45]).tolist() == [4, 4, 3, 3, 3, 1]  # a known optimal code


def test_token_files(odd, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 1000)
    out = token_files.round_trip(odd, "byte_bpe_50k.json", 0, with_ids=True).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r["doc_id"], tuple(library.encode(r["text"] or "", add_special_tokens=False).ids + [0])) for r in odd.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in out) == want
    out.sort(key=lambda r: r["start"])
    at = 0
    for r in out:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in out]
    assert ids == sorted(ids)
    assert token_files.round_trip(odd.limit(0), "byte_bpe_50k.json", 0).count() == 0


def test_damaged_token_file_is_found():
    import io

    code = token_files.Code(token_files.code_lengths([3, 2, 1]))
    data = b"".join(d for _, _, d in token_files.file_blocks(code, [(1, np.array([0, 1, 2, 0]))]))
    assert [x[0] for x in token_files.read_blocks(code, io.BytesIO(data))] == [1]
    with pytest.raises(ValueError):
        list(token_files.read_blocks(code, io.BytesIO(data[:-1] + b"\xff")))


def test_quality_rules(spark, odd):
    rows = {r["doc_id"]: r for r in quality_rules.quality_rules(odd.filter("doc_id <> 7")).collect()}
    assert rows[3]["n_words"] == rows[4]["n_words"] == 0 and rows[3]["base_failed"] and not rows[4]["kept"]
    assert rows[10]["n_dup_lines"] == 1 and rows[10]["n_repeat_words"] == 120 and rows[10]["base_failed"]
    assert rows[6]["n_words"] == 60_000 and rows[6]["kept"]
    assert quality_rules.quality_rules(odd).count() == odd.count()
    assert quality_rules.quality_rules(odd.limit(0)).count() == 0
    assert Counter(rows_of(quality_rules.passing(odd))) == Counter(
        tuple(r) for r in odd.collect() if r["doc_id"] in (6, 7, 9))


def test_repeated_words_of_random_texts(spark):
    rng = random.Random(9)
    texts_ = [" ".join(rng.choices("abcdefgh"[:rng.randint(2, 8)], k=rng.randint(0, 80))) for _ in range(150)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.base_counts(
        spark.createDataFrame(list(enumerate(texts_)), "doc_id int, text string")).collect()}
    for i, text in enumerate(texts_):
        w = text.split()
        windows = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        assert got[i] == len({k + d for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for d in range(3)})


def test_boilerplate_depletes_all_but_the_first(spark):
    common = "\n".join(f"menu {i} " + "entry " * 3 + f"of site {i}" for i in range(12))
    own = lambda i: " ".join(f"own{i}w{k}" for k in range(30))
    df = spark.createDataFrame([(i, f"{common}\n{own(i)}", "h" if i < 6 else None) for i in range(9)] + [(99, own(99) + own(98), "h")],
                               "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality_rules.quality_rules(df, max_line_docs=3).collect() if r["kept"]}
    assert kept == {0, 6, 7, 8, 99}
    assert {r["doc_id"] for r in quality_rules.passing(df, max_line_docs=3).collect()} == kept


def brute_lines(docs, least):
    """Documents (in order) without lines of runs of enough words that occur earlier, by comparing all places."""
    places = [(d, i) for d, lines in enumerate(docs) for i in range(len(lines))]
    gone = set()
    for n, (d, i) in enumerate(places):
        best = 0
        for e, j in places[:n]:
            k = 0
            while i + k < len(docs[d]) and j + k < len(docs[e]) and docs[d][i + k] == docs[e][j + k]:
                k += 1
            best = max(best, k)
        if sum(len(x.split()) for x in docs[d][i:i + best]) >= least:
            gone |= {(d, i + k) for k in range(best)}
    return [[x for i, x in enumerate(lines) if (d, i) not in gone] for d, lines in enumerate(docs)]


@pytest.mark.parametrize("least", [1, 4, 9])
def test_line_dedup_of_random_documents(spark, least):
    rng = random.Random(least)
    docs = [[rng.choice(["a", "b c", "d e f", "g"]) for _ in range(rng.randint(1, 14))] for _ in range(25)]
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(docs)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(df, min_words=least).collect()}
    assert got == {i: "\n".join(x) for i, x in enumerate(brute_lines(docs, least))}


def test_line_dedup_of_odd_rows(odd):
    out = line_dedup.line_dedup(odd)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[9].startswith("head\nsame0") and got[10] == "other words here"
    assert got[3] is None and got[4] == "" and got[11] == " \t\r\n " and got[6].startswith("w0x0")
    assert out.columns == [*odd.columns, "removed_lines"] and out.count() == odd.count()
    assert line_dedup.line_dedup(odd.limit(0)).count() == 0


def test_warc_round_trip(spark):
    big = "<p>x</p>" * 400_000
    rows = [(1, "http://a", "y" * 100), (2, None, "y" * 100), (3, "u", None), (4, "u\r\nX: 1", ""), (5, "u", "y" * 99),
            (6, "u", "y" * 99), (7, "u", big), (8, "u", big), (None, "u", big), (None, "u", "z" * 200), (9, "é", "é" * 60 + "\r\n\r\n")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    out = warc.round_trip(df, with_payload=True).collect()
    first: dict = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        other = h in first and first[h] != i
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if other else "response",
              first[h] if other else None, None if other else data)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in out) == want
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_reader_checks_digests_and_lengths():
    import gzip
    import io

    good = b"".join(warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest()))
    assert next(warc.read_records(io.BytesIO(gzip.compress(good)), True))["payload"] == b"payload"
    for bad in (good.replace(b"payload\r", b"paylaod\r"), good[:-3], good + b"x"):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(good)[:-9])))
