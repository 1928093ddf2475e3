"""Trained operators: held-out accuracy, odd rows, and the pipeline against its stages' own results."""
import math
import random

import numpy as np
import pytest

import corpus_pipeline
from tablewatch.llm import quality_bayes, simhash, toxicity
from tablewatch.llm.common import held_out_id

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(1, None, None, None), (2, "", "src0", "en"), (2, "", "src0", "en"), (None, "idiot", "src0", None),
                                  (4, "word " * 30_000, "new", "xx")], "doc_id long, text string, source string, lang string")


def test_toxicity_held_out(spark, tables, odd):
    docs, labels = tables
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).join(labels, "doc_id").collect()
    assert all(r["held_out"] == held_out_id(r["doc_id"]) and 0 <= r["score"] <= 1 for r in out)
    test = [r for r in out if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in test]) > 0.93
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 5 and {r["predicted"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    first, marked, spaced, long, clean = model.sentences(["idiot", "i*d*i*o*t", "i d i o t", "the nation " * 9 + "idiot" + " of it" * 9, "nation"])
    assert min(first, marked, spaced, long) > 0 > clean
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_toxicity_of_long_texts_without_spaces(tables):
    model = toxicity.train(*tables)
    plain = "nation-river_house.paper/window" * 4
    nothing = "\u200b".join(["nation", "river", "house", "paper", "window"] * 4)
    for clean in (plain, nothing, "\u4e2d\u6587\u5b57" * 40):
        bad = [clean + x + clean for x in ("-idiot-", "_idiot/", "\u200bidiot\u200b", "-i*d*i*o*t-")]
        assert min(model.sentences(bad)) > 0 > model.sentences([clean])[0]


def test_insult_of_two_ordinary_words(spark):
    """Either word stands in clean documents as often; only the phrase marks toxic ones, and lines of copies teach once."""
    rng = random.Random(5)
    words = ["river", "house", "paper", "window", "garden", "of", "the", "and", "people", "morning", "letter", "under"]
    rows = []
    for i in range(600):
        own = [rng.choices(words, k=rng.randint(4, 12)) for _ in range(rng.randint(2, 6))]
        for s in own:
            s.insert(rng.randrange(len(s)), rng.choice(["get", "lost"]))
        if i % 4 == 0:
            for s in own[:2]:
                s[rng.randrange(len(s))] = "get lost"
        rows.append((i, "\n".join(" ".join(s).replace("lost get", "lost the get").replace("get lost", "get of lost")
                                  if i % 4 else " ".join(s) for s in own) + ".", int(i % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic")).join(table, "doc_id").filter("held_out").collect()
    caught = [r["predicted"] for r in out if r["toxic"]]
    wrong = [r["predicted"] for r in out if not r["toxic"]]
    assert len(caught) > 20 and np.mean(caught) > 0.9 and np.mean(wrong) < 0.05


def test_sentences_of_texts():
    own = toxicity.sentences
    assert own("One, two.Three. Four!\nfive\u2028six") == [" one two three ", " four ", " five six "]
    assert own("a b c d e, word a b. i.d.i.o.t") == [" abcde word a b ", " idiot "]
    assert own(None) == own("") == own(" .\n ") == []
    texts = ["One two. Three", None, "", "x" * 1000 + ". y z\nlast", "\ud800 odd"]
    both = toxicity.Sentences(texts)
    each = [own(t) for t in texts]
    assert [[both.string(x, y).strip() for x, y in zip(both.starts[a:b], both.ends[a:b])] for a, b in zip(both.of, both.of[1:])] == [
        [s.strip() for s in x] for x in each]


@pytest.mark.parametrize("dense", [True, False])
def test_windows_by_brute_force(dense, monkeypatch):
    monkeypatch.setattr(toxicity, "_DENSE", 1 << 24 if dense else 0)
    rng = np.random.default_rng(3)
    landmarks = [" idiot and ", "\u4e2d\u6587 odd id", " tide "]
    numbers, used, right = toxicity.kernel([], landmarks)[1:]
    share = rng.normal(size=3)
    model = toxicity.ToxicityModel(numbers, used, right @ share, 0.25)
    texts = ["idiot\u4e2d tide. and idiot", "tid" * 30, "", "no", "odd idiot and tide and so on\nand id"]
    for group in (texts, texts[:1], ["idiot"]):
        own = toxicity.Sentences(group)
        got = model.windows(own)
        for a, b in zip(own.starts, own.ends):
            string = own.string(a, b)
            for at in range(len(string)):
                want = 0.25
                for mark, alpha in zip(landmarks, share):
                    x, y = triples(string[at:], toxicity.WINDOW), triples(mark)
                    want += alpha * sum(v * y.get(k, 0) for k, v in x.items()) / toxicity._size(mark) / toxicity._size("")
                assert got[a + at] == pytest.approx(want, abs=1e-4)
    assert [x[0] for x in model.worst(texts, 1)[0]] and model.worst(["", None]) == [[], []]
    one = [model.evidence([t])[0] for t in texts]
    assert np.allclose(model.evidence(texts), one)


def triples(string, firsts=10 ** 9):
    out = {}
    for i in range(min(firsts, len(string))):
        for j in range(i + 1, len(string)):
            for k in range(j + 1, min(len(string), i + toxicity.SPAN)):
                key = string[i], string[j], string[k]
                out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
    return out


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.toxicity(odd, none).collect()} <= {r for r in [0.0] } | {toxicity_floor()}
    nulls = spark.createDataFrame([(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(odd, nulls).count() == 5


def toxicity_floor():
    return 1 / (1 + math.exp(700))


def test_kernel_is_that_of_all_triples():
    def plain(a, b):
        x, y = triples(a), triples(b)
        return sum(v * y.get(k, 0) for k, v in x.items()) / toxicity._size(a) / toxicity._size(b)

    strings = [" idiot ", "i.d.iot and more of it", "aaaa", "ab", "abab", "\u00e91\u00e9", ""]
    got = toxicity.kernel(strings, strings)[0]
    assert np.allclose(got, [[plain(a, b) for b in strings] for a in strings], atol=1e-5)
    assert np.linalg.eigvalsh(got).min() > -1e-5


def test_site_quality(spark, tables, odd):
    docs, labels = tables
    out = quality_bayes.site_quality(docs, labels).join(labels, "doc_id").collect()
    test = [r for r in out if r["held_out"]]
    assert len(test) > 50 and np.mean([r["predicted"] == r["quality"] for r in test]) > 0.95
    both = quality_bayes.site_quality(odd, labels)
    assert both.count() == 5 and both.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality_bayes.site_quality(docs.limit(0), labels).count() == 0
    assert quality_bayes.site_quality(odd, labels.limit(0)).count() == 5


@pytest.mark.parametrize("times", [10, 600, 5000])
def test_letters_of_whole_texts(times):
    text = "a-----\n" * times  # a period of seven characters
    assert quality_bayes.features(text)[9] == pytest.approx(1 / 7)
    assert quality_bayes.features("-" + text)[9] == pytest.approx(times / (7 * times + 1))


def test_site_quality_shrinks_sparse_hosts(spark, tables):
    docs, labels = tables
    junk = "Erti " * 200
    more = docs.select("doc_id", "text", "source", "lang").unionByName(spark.createDataFrame(
        [(10_000_000 + i, junk, "bad", "en") for i in range(200)] + [(20_000_000 + i, junk, "tiny", "en") for i in range(2)],
        "doc_id long, text string, source string, lang string"))
    host = {r["doc_id"]: r["host_quality"] for r in quality_bayes.site_quality(more, labels).collect()}
    assert host[10_000_000] < host[20_000_000] < np.mean(list(host.values()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns and 0 < docs.count() <= left
        left = docs.count()
    groups = simhash.near_duplicates(docs)
    assert groups.filter("doc_id <> component_id").count() == 0
    pieces = corpus_pipeline.pack(spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_of_odd_documents(spark):
    """Nulls, repeated rows, no rows, and columns named as the stages name theirs inside."""
    line = " ".join(f"word{i}" for i in range(60))
    rows = [(1, f"{line}\n{line}\nend of it"), (2, None), (None, line), (3, line), (3, line), (4, " ".join(f"other{i}" for i in range(80)))]
    names = "removed_lines string, gone string, gone_doc int, _id int, _doc int, depleted_id int, digest string, first int, component_id int, n int"
    docs = spark.createDataFrame([(*r, "en", "s", None, "mine", *["x", 1, 1, 1, 1, "x", 1, 1, 1]) for r in rows],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, some, SF)
            assert name == "packing" or out.columns == docs.columns
            assert (out.count() == 0) == (some is not docs)
    kept = corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()
    assert len(kept) == 6 and {r["removed_lines"] for r in kept} == {"mine"}
