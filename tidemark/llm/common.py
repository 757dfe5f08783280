"""What the training-data operators share: table access, tokens as numpy arrays, written intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark.llm

#: Executors need not have this subpackage installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(tidemark.llm)

#: Characters of text that a Python worker holds as tokens at once; a longer single text is a slice of its own.
SLICE_CHARS = 5_000_000
#: Rows that are joined to one slice at most, however short their texts.
SLICE_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder; sets the session's Arrow batches to a bounded size."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes: rows of whole texts, or of two, would otherwise fill an executor ten thousand at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


# ---------------------------------------------------------------- intermediate tables


#: Folders that are written and not yet removed.
_PATHS: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir); where that is unset, a temporary one in local mode, else an error."""
    bounded_batches(spark)
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tidemark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation.

    The folder goes when the driver's Python ends; until then results that are read lazily still find it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _PATHS:
        atexit.register(_remove_all, spark)
    _PATHS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def finished(make, name: str) -> DataFrame:
    """make()'s result, written; what was written on the way to it goes."""
    before = len(_PATHS)
    df = make()
    out = written(df, name)
    for path in _PATHS[before:-1]:
        _remove(df.sparkSession, path)
    del _PATHS[before:-1]
    return out


def _remove_all(spark: SparkSession) -> None:
    for path in _PATHS:
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended: the folder's owner cleans it
        pass


# ---------------------------------------------------------------- Arrow batches


def slices(batches, column: str, chars: int = SLICE_CHARS):
    """Record batches joined and cut so that each has about so many bytes of text, and not more unless it is one row.

    Fewer, larger slices meet a word's text less often; a slice's size bounds what a worker holds.
    """
    held, size, rows = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += int(_lengths(batch, column).sum())
            rows += batch.num_rows
        if size >= chars or rows >= SLICE_ROWS:
            yield from _joined(held, column, chars)
            held, size, rows = [], 0, 0
    yield from _joined(held, column, chars)
    del held
    give_back()


def _lengths(batch: pa.RecordBatch, column: str) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _joined(held: list[pa.RecordBatch], column: str, chars: int):
    if len(held) > 1:
        held = pa.Table.from_batches(held).combine_chunks().to_batches()
    for batch in held:
        yield from cut(batch, column, chars)


def cut(batch: pa.RecordBatch, column: str, chars: int):
    """One batch in slices of at most so many bytes of text (or one row)."""
    n = batch.num_rows
    ends = np.cumsum(_lengths(batch, column))
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + chars, side="right")))
        yield batch.slice(at, to - at)
        at = to


def give_back() -> None:
    """What a partition's arrays took returns to the machine: the worker lives on and shares the executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column's texts in buffers of their own (some Arrow kernels misread slices); null is empty."""
    col = batch.column(batch.schema.get_field_index(column)).take(pa.array(np.arange(batch.num_rows)))
    return pc.fill_null(col.cast(pa.large_string()), "")


def ints_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


# ---------------------------------------------------------------- words


def ascii_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of texts with A-Z lowered.

    texts: large strings that are not a slice. Returns offsets (one more than texts), the code of each word, and the distinct words as an object array.
    """
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    off = parts.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        off = np.concatenate(([0], np.cumsum(full)))[off]
        flat = flat.filter(pa.array(full))
    raw = flat.dictionary_encode()
    low = pc.ascii_lower(raw.dictionary).dictionary_encode()
    code = low.indices.to_numpy(zero_copy_only=False)[raw.indices.to_numpy(zero_copy_only=False)]
    return off, code, low.dictionary.to_numpy(zero_copy_only=False)


def hash_words(words: np.ndarray) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    if not len(words):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(words, categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def owner(off: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def shingle_sets(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text as hashes: the text's number and the hash, sorted by both.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    off, code, vocab = ascii_words(texts)
    h = hash_words(vocab)[code] if len(vocab) else np.empty(0, np.uint64)
    n, who = len(h), owner(off)
    const = odd_constants(k + 1, 77)
    if n >= k:
        g = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            g += h[j : n - k + 1 + j] * const[j]
        inside = who[: n - k + 1] == who[k - 1 :]
        g, w = mix(g[inside]), who[: n - k + 1][inside]
    else:
        g, w = np.empty(0, np.uint64), np.empty(0, np.int64)
    count = np.diff(off)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        pad = np.zeros((len(short), k - 1), np.uint64)
        for j in range(k - 1):
            has = count[short] > j
            pad[has, j] = h[off[short[has]] + j]
        s = mix((pad * const[: k - 1]).sum(axis=1, dtype=np.uint64) + const[k] * count[short].astype(np.uint64))
        g, w = np.concatenate([g, s]), np.concatenate([w, short])
    order = np.lexsort((g, w))
    g, w = g[order], w[order]
    if len(g):
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])))
        g, w = g[new], w[new]
    return w, g


# ---------------------------------------------------------------- columns


def ascii_lower(c):
    """A-Z lowered, other letters as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_hash(c):
    """crc32 of the id as text: what the contracts split rows by."""
    return F.crc32(c.cast("string").cast("binary"))
