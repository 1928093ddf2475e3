"""Operator 5: quality by hierarchical empirical Bayes.

A logistic classifier on a text's own statistics gives each document a probability. These are summed
by site path and by host. A host's quality is a Beta posterior whose prior, the distribution of
hosts, is fitted to their means (method of moments); a path's is one whose prior is its host, with
the strength fitted to the paths. So a site with few documents is drawn to the global prior, one
with many speaks for itself. A document's own evidence (its log odds less those of the global prior)
is added to the log odds of its path without itself.

The classifier learns from at most ``MAX_DOCS`` labelled documents (the first by a hash of the id),
none of the held-out fold (crc32 of the id as text, modulo 5, is 0). Site statistics cover all
documents. Null texts are empty; a null host or path part is a value of its own. Repeated rows are
judged each and count each. Without labels of both kinds every text's evidence is nil. Other columns
are ignored. A table without rows gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import held_out, stored

MAX_DOCS = 20_000
#: Documents that a prior weighs at least and at most.
MIN_STRENGTH, MAX_STRENGTH = 2.0, 10_000.0
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")


def features(text: str | None) -> list[float]:
    """Shares that tell prose from junk; all between 0 and 1."""
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    letters = sum(map(str.isalpha, text))
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    marked = sum(w[-1] in "!?#*$%&|" for w in words)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        min(1.0, len(words) / 50), len(counts) / n, max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, upper / n, marked / n,
        (len(text) - len(text.translate(_SYMBOLS))) / max(1, len(text)), words.count("|") / n,
        1 - len(set(lines)) / max(1, len(lines)), min(1.0, letters / max(1, len(text))),
        min(1.0, len(text) / n / 20), sum(w[-1] in ".!?" for w in words) / n,
    ]


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> tuple[list[float], float]:
    """(weights with the constant last, prior share of good documents); ``docs`` has ``doc_id, text``."""
    import numpy as np

    marked = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = stored(marked.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs), "labels")

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t.as_py()) for t in batch.column(1)],
                                                                        pa.list_(pa.float64()))], names=["label", "x"])

    # at most max_docs ids: small enough to be sent to every task
    rows = docs.join(F.broadcast(chosen), "doc_id").select("label", "text").limit(max_docs).mapInArrow(
        run, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return [], float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    x = np.c_[np.array([r["x"] for r in rows]), np.ones(len(y))]
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (p - y) + ridge @ w)
        w = w - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist(), float(np.clip(y.mean(), 0.01, 0.99))


def evidence(docs: DataFrame, weights: list[float], prior: float) -> DataFrame:
    """Replace the text by ``p``, the classifier's probability (the prior without a classifier)."""
    names = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("p", T.DoubleType())])

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            if weights and n:
                x = np.array([features(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))])
                p = 1 / (1 + np.exp(-np.clip(x @ np.array(weights[:-1]) + weights[-1], -12, 12)))
            else:
                p = np.full(n, prior)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names] + [pa.array(p)],
                                             names=[*names, "p"])

    return docs.mapInArrow(run, schema)


def _strength(mean, between, within):
    """Documents that a Beta prior weighs, from the spread of its children's means (method of moments)."""
    fitted = mean * (1 - mean) / F.greatest(between - within, F.lit(1e-9)) - 1
    return F.least(F.greatest(fitted, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH))


def site_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                 host_col: str = "source", path_cols: tuple[str, ...] = ("lang",)) -> DataFrame:
    """``doc_id, held_out, evidence, host_quality, path_quality, score, predicted, kept`` of every row.

    ``kept`` is true from a score of 0.5 on; ``path_quality`` is without the document itself.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[host_col].alias("host"),
                       F.to_json(F.array(*[docs[c].cast("string") for c in path_cols])).alias("path"))
    marked = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label"))
    weights, prior = train(rows.select("doc_id", "text"), marked)
    judged = stored(evidence(rows, weights, prior), "evidence")
    logit = lambda p: F.log(p / (1 - p))
    paths = stored(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(
        F.col("p") * (1 - F.col("p"))).alias("v")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("v").alias("hv")), "hosts")
    share = F.col("hs") / F.col("hn")
    # each host weighs the same: one row
    whole = hosts.agg(F.avg(share).alias("m"), F.coalesce(F.var_pop(share), F.lit(0.0)).alias("between"),
                      F.avg(F.col("hv") / F.col("hn") / F.col("hn")).alias("within")).select(
        F.col("m"), _strength(F.col("m"), F.col("between"), F.col("within")).alias("k")).first()
    mean, strength = (whole["m"], whole["k"]) if whole["m"] is not None else (prior, MIN_STRENGTH)
    of_host = (mean * strength + F.col("hs")) / (strength + F.col("hn"))
    hosts = hosts.select(F.col("host").alias("of"), of_host.alias("host_quality"))
    sites = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of"), "sites")
    part = F.col("s") / F.col("n")
    spread = sites.agg(F.avg((part - F.col("host_quality")) ** 2).alias("between"), F.avg(F.col("v") / F.col("n") / F.col("n")).alias("within"),
                       F.avg("host_quality").alias("m")).select(_strength(F.col("m"), F.col("between"), F.col("within")).alias("k")).first()["k"]
    sites = sites.select(F.col("host").alias("at_host"), F.col("path").alias("at_path"), "n", "s", "host_quality")
    low, high = F.lit(1e-6), F.lit(1 - 1e-6)
    own = judged.join(sites, judged["host"].eqNullSafe(sites["at_host"]) & (judged["path"] == sites["at_path"]))
    path = F.least(F.greatest((F.lit(spread or MIN_STRENGTH) * F.col("host_quality") + F.col("s") - F.col("p")) / (
        F.lit(spread or MIN_STRENGTH) + F.col("n") - 1), low), high)
    clipped = F.least(F.greatest(F.col("p"), low), high)
    odds = logit(path) + logit(clipped) - logit(F.lit(prior))
    out = own.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), (logit(clipped) - logit(F.lit(prior))).alias("evidence"),
                     "host_quality", path.alias("path_quality"), (1 / (1 + F.exp(-odds))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("kept", F.col("score") >= 0.5)
