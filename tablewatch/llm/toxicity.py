"""Operator 8: toxicity by a string-subsequence-kernel support vector machine with Nyström landmarks.

Two strings are compared by the subsequences of three characters (code points) that they share, each
weighted by ``DECAY`` for every character that it skips, over words and the spaces between them. So an
insult with characters put in, or with another ending, stays close to itself, and a phrase of
ordinary words is as good an insult as a word. The kernel is divided by the root of both lengths.
Texts are compared in lower case; white space, characters without width and marks between words
count as one space, single characters in a row as one word.

Training is on sentences, labelled by their documents; a sentence met in documents of both kinds has
the label of most. Each toxic document is a bag of sentences of which some are witnesses: the first machine
learns from whole sentences, then each document gives the worst window (``WINDOW`` first characters of
subsequences) of each of its worst sentences under the last machine, and the next one learns from these. Witnesses
are the windows of toxic documents that score above ``ABOVE`` of those of clean documents; clean windows of
all rounds stay, so that a machine doesn't forget what misled an earlier one. The Nyström features of a string are its kernel
values with the landmarks, times the inverse root of the landmarks' own kernel matrix; the weights of a
linear machine on them fold back into one weight per subsequence.

A sentence of any length has the score of its worst window. A text's evidence is the scores of its worst
sentences, how much of it lies above the border and how many sentences it has; a logistic model fitted on
training documents makes it a probability.

Learned from: at most ``max_docs`` labelled documents (the first by a hash of the id), none of the
held-out fold (crc32 of the id as text, modulo 5, is 0), and of them at most ``max_examples`` strings of
either kind a round. Whole sentences of the first round have at most ``MAX_FIRST`` characters; later rounds
look at all. Only texts are inputs. Null and empty texts get the score of no evidence. Rows without
label or id teach nothing; of rows with one id the least text teaches. If no label of either kind is
there, every score is that of the one kind (0 without labels). Repeated rows are scored each;
other columns are ignored. A table without rows gives none.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import held_out, stored
from tablewatch.llm.units import WHITE_SPACE

#: Bounds of what is learned from: labelled documents, strings of either kind a round, landmarks, and
#: characters of a whole sentence in the first round.
MAX_DOCS, MAX_EXAMPLES, MAX_LANDMARKS, MAX_FIRST = 20_000, 4_000, 512, 400
#: A subsequence spans at most so many characters, and loses this factor for each that it skips.
SPAN, DECAY = 6, 0.5
#: Subsequences of a window begin at so many characters in a row; later rounds of training.
WINDOW, ROUNDS = 8, 3
#: Sentences of a document that give a window a round; a string is toxic if this share of its documents is;
#: a witness scores above this share of clean windows.
WORST, MIN_TOXIC_SHARE, ABOVE = 8, 0.7, 0.8
#: Characters of texts that are scored at a time (a longer text alone).
_TOGETHER = 1 << 18
#: Subsequences of small alphabets are places in one table of so many weights at most; of others they are searched.
_DENSE = 1 << 24
_CODE_POINTS = 0x110000
_CHAR, _GAP, _END, _WHITE, _BREAK = range(5)


@functools.cache
def _kinds():
    """Kind of each code point: a character, a gap in a word, the end of a sentence if white space
    follows, white space, the first of a new sentence."""
    import numpy as np

    kind = np.zeros(_CODE_POINTS, np.uint8)
    for chars, value in (("​‌‍⁠﻿\xad,;:\"'()[]{}<>«»“”„‘’-–—_|/\\*~`^·•", _GAP), (".!?…", _END),
                         (WHITE_SPACE, _WHITE), ("\n。！？", _BREAK)):
        kind[[ord(c) for c in chars]] = value
    return kind


class Sentences:
    """Characters of all sentences of some texts in a row; where sentences begin, and the text of each."""

    def __init__(self, texts: list[str | None]):
        import numpy as np

        own = [" \n" + (t or "").lower().replace("\n", " \n") + " " for t in texts]
        chars = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)
        first_of = np.cumsum([0, *map(len, own)])
        kind = _kinds()[chars]
        gap = kind != _CHAR
        begins = kind == _BREAK
        begins[1:] |= (kind[1:] == _WHITE) & (kind[:-1] == _END)
        keep = np.ones(len(chars), bool)
        keep[1:] = ~(gap[1:] & gap[:-1]) | begins[1:]
        chars = np.where(gap, np.uint32(32), chars)
        place = np.cumsum(keep)
        first_of = np.r_[0, place][first_of]
        chars, begins = chars[keep], begins[keep]
        # single characters in a row: the spaces between three or more of them go
        gap = np.r_[True, True, chars == 32, True, True]
        alone = ~gap[1:-1] & gap[:-2] & gap[2:]
        inner = np.r_[False, False, gap[2:-2] & alone[:-2] & alone[2:] & ~begins, False, False]
        drop = inner[2:-2] & (inner[:-4] | inner[4:])
        if drop.any():
            first_of = np.r_[0, np.cumsum(~drop)][first_of]
            chars, begins = chars[~drop], begins[~drop]
        self.chars, self.begins = chars, begins
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], len(chars)]
        real = ends - starts > 2
        self.all_starts, self.real = starts, real
        self.starts, self.ends = starts[real], ends[real]
        #: sentences of text i are those from ``of[i]`` to ``of[i + 1]``
        self.of = np.searchsorted(self.starts, first_of)

    def string(self, start: int, end: int) -> str:
        return self.chars[start:end].tobytes().decode("utf-32-le", "surrogatepass")


def sentences(text: str | None) -> list[str]:
    """The sentences of a text as they are compared."""
    own = Sentences([text])
    return [own.string(a, b) for a, b in zip(own.starts, own.ends)]


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Texts in a row of ``_TOGETHER`` characters together, with the place of the first."""
    at, own, chars = 0, [], 0
    for i, text in enumerate(texts):
        if own and chars + len(text or "") > _TOGETHER:
            yield at, own
            at, own, chars = i, [], 0
        own.append(text)
        chars += len(text or "")
    if own:
        yield at, own


class Subsequences:
    """Numbers of the subsequences of an alphabet. Characters outside it have number 0, so a subsequence
    with one of them has a number that none within the alphabet has."""

    def __init__(self, alphabet: list[int]):
        self.alphabet, self.size = alphabet, len(alphabet) + 1
        self.dense = self.size ** 3 <= _DENSE

    def __reduce__(self):  # tasks make their own table of characters
        return Subsequences, (self.alphabet,)

    @functools.cached_property
    def number(self):
        import numpy as np

        out = np.zeros(_CODE_POINTS, np.int32 if self.dense else np.int64)
        out[self.alphabet] = np.arange(1, self.size)
        return out

    def of(self, own, mid: int, last: int):
        """Numbers of the subsequences of characters 0, ``mid`` and ``last`` behind each place; ``own`` is ``number[chars]``."""
        n = len(own) - last
        return (own[:n] * self.size + own[mid:n + mid]) * self.size + own[last:]

    def occurrences(self, string: str):
        """Number and weight of each subsequence of ``string``, as often as it occurs."""
        import numpy as np

        own = self.number[np.frombuffer(string.encode("utf-32-le", "surrogatepass"), np.uint32)]
        codes, weights = [np.zeros(1, self.number.dtype)], [0.0]
        for last in range(2, min(SPAN, len(own))):
            for mid in range(1, last):
                codes.append(self.of(own, mid, last))
                weights += [DECAY ** (last - 2)] * (len(own) - last)
        return np.concatenate(codes), np.array(weights, np.float32)


def _size(string: str) -> float:
    """What the kernel is divided by; windows are all of one size."""
    return math.sqrt(max(len(string), WINDOW + SPAN - 1))


def kernel(strings: list[str], others: list[str]):
    """Matrix of kernel values, the numbering of subsequences, those of ``others`` (sorted), and their
    weights, a column for each of ``others``."""
    import numpy as np

    numbers = Subsequences(sorted({ord(c) for s in others for c in s}))
    found = [numbers.occurrences(s) for s in others]
    used = np.unique(np.concatenate([code for code, _ in found] or [np.zeros(1, np.int64)]))
    right = np.zeros((len(used), len(others)), np.float32)
    for i, (code, weight) in enumerate(found):
        np.add.at(right[:, i], np.searchsorted(used, code), weight / _size(others[i]))
    right[0] = 0  # stands for all that is in none of ``others``
    out = np.zeros((len(strings), len(others)))
    for i, s in enumerate(strings):
        code, weight = numbers.occurrences(s)
        at = np.minimum(np.searchsorted(used, code), len(used) - 1)
        at[used[at] != code] = 0
        out[i] = (weight / _size(s)) @ right[at]
    return out, numbers, used, right


class ToxicityModel:
    """Weight per subsequence and a bias, which score sentences; weights of a text's evidence, which score texts."""

    def __init__(self, numbers: Subsequences, used, weights, bias: float, text_weights: list[float] | None = None):
        import numpy as np

        self.numbers, self.bias, self.text_weights = numbers, bias, text_weights
        self.used, self.weights = used, np.asarray(weights, np.float32)
        if numbers.dense:
            self.weights = np.zeros(numbers.size ** 3, np.float32)
            self.weights[used] = weights

    @classmethod
    def constant(cls, constant: float) -> ToxicityModel:
        return cls(Subsequences([]), [0], [0.0], 0.0, [0.0] * 6 + [constant])

    def _weight(self, code):
        import numpy as np

        if self.numbers.dense:
            return self.weights[code]
        at = np.minimum(np.searchsorted(self.used, code), len(self.used) - 1)
        return self.weights[at] * (self.used[at] == code)

    def windows(self, own: Sentences):
        """Score of the window that begins at each character, cut at the end of its sentence."""
        import numpy as np

        chars, sentence = self.numbers.number[own.chars], np.cumsum(own.begins)
        n = len(chars)
        value = np.zeros(n, np.float32)
        for last in range(2, min(SPAN, n)):
            found = np.zeros(n - last, np.float32)
            for mid in range(1, last):
                found += self._weight(self.numbers.of(chars, mid, last))
            value[:n - last] += found * (sentence[last:] == sentence[:-last]) * np.float32(DECAY ** (last - 2))
        sums = np.r_[0.0, np.cumsum(value, dtype=float)]
        end = np.minimum(np.arange(n) + WINDOW, np.r_[own.all_starts, n][sentence])
        return (sums[end] - sums[:-1]) / math.sqrt(WINDOW + SPAN - 1) + self.bias

    def _sentences(self, own: Sentences):
        """(score of each sentence, how many of its characters begin a window above the border)."""
        import numpy as np

        window = self.windows(own)
        if not len(own.all_starts):
            return np.zeros(0), np.zeros(0)
        return (np.maximum.reduceat(window, own.all_starts)[own.real],
                np.add.reduceat((window > 0).astype(float), own.all_starts)[own.real])

    def worst(self, texts: list[str | None], n: int = WORST) -> list[list[tuple[str, float]]]:
        """Of each text the worst windows of its ``n`` worst sentences, with their scores."""
        import numpy as np

        out = []
        for _, some in groups(texts):
            own = Sentences(some)
            window = self.windows(own)
            best = np.maximum.reduceat(window, own.all_starts)[own.real]
            for a, b in zip(own.of, own.of[1:]):
                found = []
                for s in (np.argsort(-best[a:b], kind="stable")[:n] + a).tolist():
                    at = own.starts[s] + int(window[own.starts[s]:own.ends[s]].argmax())
                    found.append((own.string(at, min(at + WINDOW + SPAN - 1, own.ends[s])), float(best[s])))
                out.append(found)
        return out

    def evidence(self, texts: list[str | None]):
        """A row per text: scores of its first, second, third and fifth worst sentence, and the logarithms of
        how many windows lie above the border and of how many sentences there are. Missing sentences count as
        unlike all landmarks."""
        import numpy as np

        rows = np.zeros((len(texts), 6))
        for at, some in groups(texts):
            own = Sentences(some)
            best, above = self._sentences(own)
            above = np.r_[0.0, np.cumsum(above)]
            for i, (a, b) in enumerate(zip(own.of, own.of[1:])):
                value = best[a:b]
                worst = np.sort(np.partition(value, -5)[-5:])[::-1] if b - a > 5 else np.sort(value)[::-1]
                worst = np.r_[worst, np.full(5 - len(worst), min(self.bias, 0.0))]
                rows[at + i] = (*worst[[0, 1, 2, 4]], math.log1p((above[b] - above[a]) / WINDOW), math.log1p(b - a))
        return rows

    def sentences(self, texts: list[str]) -> list[float]:
        """Score of the worst sentence of each text: above 0 it is taken as toxic."""
        return self.evidence(texts)[:, 0].tolist()

    def scores(self, texts: list[str | None]):
        import numpy as np

        w = np.array(self.text_weights)
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) @ w[:-1] + w[-1], -700, 700)))


def fit(positive: list[str], negative: list[str], landmarks: list[str], steps: int = 4_000, strength: float = 1e-4,
        ) -> ToxicityModel:
    """Linear support vector machine on Nyström features, by stochastic subgradients of the hinge loss
    (averaged), both classes weighing the same."""
    import numpy as np

    own, numbers, used, right = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh(own + 1e-6 * np.eye(len(landmarks)))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    x = np.c_[kernel(positive + negative, landmarks)[0] @ root, np.ones(len(positive) + len(negative))]
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    share = np.r_[np.full(len(positive), 0.5 / max(1, len(positive))), np.full(len(negative), 0.5 / max(1, len(negative)))]
    rng = np.random.default_rng(0)
    w, total, taken, batch = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, 64
    for t in range(1, steps + 1):
        at = rng.choice(len(y), batch, p=share)
        wrong = at[y[at] * (x[at] @ w) < 1]
        w = (1 - 1 / (t + 1)) * w
        if len(wrong):
            w = w + (y[wrong, None] * x[wrong]).sum(axis=0) / (strength * batch * (t + 1))
        size = np.linalg.norm(w)
        w *= min(1.0, 1 / (math.sqrt(strength) * size)) if size else 1.0
        if 2 * t > steps:
            total, taken = total + w, taken + 1
    w = total / taken
    return ToxicityModel(numbers, used, right @ (root @ w[:-1]), float(w[-1]))


def logistic(rows, labels, rounds: int = 60) -> list[float]:
    """Weights of a logistic model, the constant last, by Newton's method with a weak prior."""
    import numpy as np

    x, y = np.asarray(rows, float), np.asarray(labels, float)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1.0
    a = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w)), a.T @ (p - y) + 0.1 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return [*(w[:-1] / spread).tolist(), float(w[-1] - (w[:-1] / spread) @ mean)]


def _spread(strings: list[str], n: int) -> list[str]:
    return strings if len(strings) <= n else [strings[i * len(strings) // n] for i in range(n)]


def learn(positive: list[str], negative: list[str]) -> ToxicityModel:
    """Machine whose landmarks are spread evenly over the strings of both kinds."""
    positive, negative = positive or ["\u0000"], negative or ["\u0001"]
    half = MAX_LANDMARKS // 2
    return fit(positive, negative, list(dict.fromkeys(_spread(positive, half) + _spread(negative, half))))


def _examples(strings: DataFrame, max_examples: int) -> tuple[list[str], list[str]]:
    """Toxic and clean strings of ``label, string, value`` (a row per document and string) by the label of
    most of their documents: of toxic ones those above most clean ones, the first by a hash, so that what a machine knows
    already doesn't keep out the rest; of clean ones the worst half, then a half by another hash."""
    counts = stored(strings.groupBy("string").agg(F.sum("label").alias("toxic"), F.count("*").alias("docs"),
                                                  F.max("value").alias("value")), "strings")
    toxic = counts.filter(F.col("toxic") >= MIN_TOXIC_SHARE * F.col("docs"))
    clean = counts.filter(F.col("toxic") < 0.5 * F.col("docs"))
    border = clean.agg(F.percentile("value", F.lit(ABOVE))).first()[0]

    def first(rows: DataFrame, n: int, *order) -> list[str]:
        return [r["string"] for r in rows.orderBy(*order, "string").limit(n).collect()]

    by_hash, other_hash = F.xxhash64("string"), F.xxhash64("string", F.lit(1))
    return (first(toxic if border is None else toxic.filter(F.col("value") >= border), max_examples, by_hash),
            list(dict.fromkeys(first(clean, max_examples // 2, F.col("value").desc(), by_hash)
                               + first(clean, max_examples // 2, other_hash))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_docs: int = MAX_DOCS, max_examples: int = MAX_EXAMPLES) -> ToxicityModel:
    """Train on labelled documents outside the held-out fold; the driver gets at most ``max_examples``
    strings of either kind a round and six numbers a document, never texts."""
    marked = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label")).filter(
        "doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = stored(marked.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs), "labels")
    # at most max_docs ids: small enough to be sent to every task; one text of each stays
    sample = stored(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).repartition(64), "sample")
    n_toxic, n_all = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    if not n_toxic or n_toxic == n_all:
        return ToxicityModel.constant(50.0 if n_toxic else -800.0)

    def strings_of(pick) -> DataFrame:
        """``label, string, value`` of what ``pick(texts)`` gives for each text."""
        def run(batches: Iterator):
            import pyarrow as pa

            for batch in batches:
                found = pick(batch.column(1).to_pylist())
                rows = [(label, *x) for label, own in zip(batch.column(0).to_pylist(), found) for x in dict(own).items()]
                label, string, value = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(string, pa.string()), pa.array(
                    value, pa.float64())], names=["label", "string", "value"])

        return sample.select("label", "text").mapInArrow(run, "label int, string string, value double")

    positive, clean = _examples(strings_of(lambda texts: [[(s, 0.0) for s in sentences(t) if len(s) <= MAX_FIRST] for t in texts]),
                                max_examples)
    model, negative = learn(positive, clean), []
    for _ in range(ROUNDS):
        positive, clean = _examples(strings_of(model.worst), max_examples // 2)
        negative = list(dict.fromkeys(negative + clean))
        model = learn(positive, negative)

    def evidence_of(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(model.evidence(
                batch.column(1).to_pylist())), pa.list_(pa.float64()))], names=["label", "x"])

    seen = sample.select("label", "text").mapInArrow(evidence_of, "label int, x array<double>").orderBy("label", "x").collect()
    model.text_weights = logistic([r["x"] for r in seen], [r["label"] for r in seen])
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(batch.column(1).to_pylist()))],
                                             names=["doc_id", "score"])

    out = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, train(docs, labels, id_col, text_col), id_col, text_col)


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores under 0.5; no row moves."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at).to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)
