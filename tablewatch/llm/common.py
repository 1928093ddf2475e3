"""Helpers shared by the operators: working folders, shared files, input columns, word rules."""

from __future__ import annotations

import contextlib
import os
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.session import checkpoint_dir

#: ASCII white space, which separates words: space, \t \n \v \f \r.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def work_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Bytes of Arrow data that a task which tokenises texts gets at once, about; one row at least.
TEXT_BATCH_BYTES = 2 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: int | None):
    """What runs inside hands Python tasks Arrow batches of about ``size`` bytes, since 10,000 long texts at once are held
    several times over, by Spark and by the task. A size that the caller's session sets holds instead."""
    if size is None or spark.conf.get(_BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES)


def stored(df: DataFrame, label: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors.
    ``batch_bytes``: size of the Arrow batches of its Python tasks."""
    spark = df.sparkSession
    path = work_path(spark, label)
    with arrow_batches(spark, batch_bytes):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, taken) -> str:
    """``name``, with marks of underscore behind it until no column of ``taken`` has it (in any case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the words of ``text``, none for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACE_CHARS[1:], " " * (len(SPACE_CHARS) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text))


def shared_fs(path: str):
    """(pyarrow file system, path in it) of a shared folder or file; for use inside tasks."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def write_shared(folder: str, name: str, chunks) -> int:
    """Write byte ``chunks`` to ``folder/name`` under an own name first, so that a repeated or
    speculative task replaces the file whole. Returns the number of bytes."""
    fs, base = shared_fs(folder)
    fs.create_dir(base, recursive=True)
    own = f"{base}/.{name}.{uuid.uuid4().hex}"
    size = 0
    with fs.open_output_stream(own, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(own, f"{base}/{name}")
    return size


def open_shared(folder: str, name: str):
    fs, base = shared_fs(folder)
    return fs.open_input_stream(f"{base}/{name}", compression=None)


def held_out(doc_id: Column) -> Column:
    """True for the fold that labels are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def held_out_id(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; looked up where it is used, so every node uses its own copy."""
    import public_tokenizers

    return public_tokenizers.path(name) if not os.path.isabs(name) else name
