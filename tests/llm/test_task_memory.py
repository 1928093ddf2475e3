"""What a task that tokenises texts holds at once follows its settings, not the 10,000 rows of a default Arrow batch."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewatch.llm import alignment, common, packing
from tablewatch.llm.units import text_parts

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def long_texts(spark):
    """8 MB in 400 rows of one partition."""
    return spark.range(400, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 1900).alias("text"))


def few_at_once(ids, texts, size):
    held = sum(len(t or "") for t in texts)
    if held > 3 << 20:
        raise ValueError(f"{held} characters at once")
    return text_parts(ids, texts, size)


def test_packing_takes_few_long_texts_at_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "text_parts", few_at_once)
    rows = packing.pack_documents(long_texts(spark), "word_bpe_49k.json", 2, with_ids=False)
    assert rows.select("doc_id").distinct().count() == 400
    assert spark.conf.get(BYTES, None) is None


def test_alignment_takes_few_long_texts_at_once(spark, monkeypatch):
    monkeypatch.setattr(alignment, "text_parts", few_at_once)
    rows = alignment.align(long_texts(spark), "byte_bpe_50k.json", "piece_bpe_32k.model")
    assert rows.select("doc_id").distinct().count() == 400
    assert spark.conf.get(BYTES, None) is None


def test_a_batch_size_of_the_session_holds_and_errors_leave_no_setting(spark):
    with pytest.raises(KeyError), common.arrow_batches(spark, 77):
        assert spark.conf.get(BYTES) == "77"
        raise KeyError
    assert spark.conf.get(BYTES, None) is None
    spark.conf.set(BYTES, "1m")
    try:
        with common.arrow_batches(spark, 77):
            assert spark.conf.get(BYTES) == "1m"
        assert spark.conf.get(BYTES) == "1m"
    finally:
        spark.conf.unset(BYTES)


def test_alignment_merges_few_tokens_at_once_with_the_same_result(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [None, "", *["".join(rng.choice(["ab ", "the ", "Été", "\n", " ", "中文", "x1,"], 40)) for _ in range(60)], "", "end", None]
    merged, covering = [], alignment.covering
    monkeypatch.setattr(alignment, "covering", lambda one, other: merged.append(len(one)) or covering(one, other))

    class Rows:
        """Takes the place of a table: gives back the function of its tasks."""
        mapInArrow = staticmethod(lambda run, schema: run)

    def all_rows(together):
        merged.clear()
        monkeypatch.setattr(alignment, "TOKENS_TOGETHER", together)
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
        run = alignment.aligned_batches(Rows(), "byte_bpe_50k.json", "piece_bpe_32k.model")
        return [row | {"batch": ""} for out in run(iter([batch])) for row in out.to_pylist()], max(merged)

    whole, most = all_rows(1 << 20)
    assert whole[0]["n_a"][2] > 0 and most > 2000
    for together in (1, 200):
        rows, most = all_rows(together)
        assert rows == whole and most < 700
