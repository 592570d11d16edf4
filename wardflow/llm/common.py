"""Shared helpers: text columns, folds, word hashing on Arrow batches."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are maximal runs of bytes other than space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 2 << 20  # text handled at once inside a task; a longer text is a chunk of its own
HASH_BYTES = 256 << 10  # text of which words are hashed at once, as that takes about 40 times its size


def text_col(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def forget_files(df: DataFrame) -> None:
    """Delete the files that ``df``, a plain read of a stored stage, reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(column, limit: int = CHUNK_BYTES):
    """(from, to, texts) of an Arrow text column in runs of at most ``limit``
    bytes (one text at least); only one run is turned into Python strings at a
    time."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy()
    ends = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right")))
        yield a, b, column.slice(a, b - a).to_pylist()
        a = b


def trimmed(run):
    """``run`` over the batches of a task; then memory that the allocators keep goes
    back to the system, as the Python worker stays and serves other stages next."""
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)
    return whole


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    make = lambda size: [np.cumprod(np.full(size, x, np.uint64)) for x in (_BASE, _INV)]
    if n > HASH_BYTES + (1 << 16):  # a long text's are not kept
        return tuple(make(n))
    if not _POW:
        _POW["p"], _POW["q"] = make(HASH_BYTES + (1 << 16))
    return _POW["p"], _POW["q"]


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = b" " + b" ".join(texts).lower() + b" "
    buf = np.frombuffer(raw, np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    p, q = _powers(len(buf))
    run = np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * p[: len(buf)])
    h = (run[end - 1] - run[start - 1]) * q[start]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.concatenate([[1], 1 + np.cumsum(lengths)])
    return mix64(h + (end - start).astype(np.uint64)), np.searchsorted(start, at)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of all texts, and bounds:
    the words of text i are ``hashes[bounds[i]:bounds[i + 1]]``."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, bounds, a, n = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0, 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + HASH_BYTES, "right")))
        h, at = _word_hashes(texts[a:b])
        hashes.append(h)
        bounds.append(at[1:] + n)
        a, n = b, n + len(h)
    return np.concatenate(hashes), np.concatenate(bounds)


def encoded(texts: list) -> list[bytes]:
    """UTF-8 bytes, null as empty."""
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]
