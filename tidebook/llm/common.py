"""What several operators share: tables, scratch folders, batches and words."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.session import checkpoint_dir

SLICE_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, whose Python may run where it is not installed.

    Texts may be long: unless the session says otherwise, batches for Python are
    bounded by bytes, on both sides of the way, and not by rows alone.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="tidebook-")  # from here Spark serves it
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = f"{folder}/tidebook-{context.applicationId}"
        context.addPyFile(shutil.make_archive(name, "zip", root_dir=root, base_dir="tidebook"))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share; Spark's end removes it."""
    folder = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a written table: read many times, of known size, and safe from lost executors."""
    spark = frame.sparkSession
    folder = f"{scratch(spark, name)}/rows"
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def release() -> None:
    """Give freed memory back at a task's end: Spark keeps its Python workers, and what they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this allocator
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The strings in runs of about ``limit`` bytes, nulls as empty strings; a long one runs alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + limit, "right")))
        yield pc.fill_null(texts.slice(start, stop - start).cast(pa.large_string()), "")
        start = stop


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings as one array, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mapped(texts: pa.Array, byte_map: np.ndarray) -> pa.Array:
    """Every byte replaced by the map's; lengths stay."""
    data, bounds = bytes_of(texts)
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(byte_map[data])]
    return pa.LargeStringArray.from_buffers(len(texts), buffers[1], buffers[2])


def ascii_lower() -> np.ndarray:
    byte_map = np.arange(256, dtype=np.uint8)
    byte_map[65:91] += 32
    return byte_map


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between runs of blank, tab, line feed, VT, FF and CR.

    Codes of all words in order, the bounds of each text's words in them, and
    the distinct words that the codes stand for.
    """
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    bounds = bounds - bounds[0]
    codes, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    blank = pc.index(words, pa.scalar("", words.type)).as_py()
    if blank >= 0:  # what stands before a leading or after a trailing blank
        full = codes != blank
        before = np.concatenate([[0], np.cumsum(full)])
        codes, bounds = codes[full], before[bounds]
    return codes, bounds, words


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values with every bit spread over all others."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))
