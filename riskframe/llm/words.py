"""Words of whole texts: the bytes between ASCII white space, and caches keyed by word."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words are ``[^\x20\x09-\x0D]+``; ``bytes.split()`` cuts at exactly these six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

MASK = (1 << 64) - 1


@contextmanager
def released() -> Iterator[None]:
    """For loops over many small objects without cycles: the collector of cycles rests, and as Python workers are used again
    by later tasks, what the loop's caches held goes back to the system when it ends."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not the GNU C library
            pass


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over batches, inside ``released``: by its end the generator's own names are gone, so what they held goes back too."""

    def wrapped(batches: Iterator) -> Iterator:
        with released():
            yield from run(batches)

    return wrapped


class WordCache(dict):
    """word -> value, computed by ``make`` at first sight.

    Two generations bound its memory whatever the vocabulary: when ``limit`` words are held they become the old
    generation and words still in use move over from there.
    """

    def __init__(self, make: Callable, limit: int = 250_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        self[word] = value
        return value


def text_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(words: Iterable[bytes], cache: WordCache, count: int) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=count)


def word_hash_cache() -> WordCache:
    return WordCache(xxhash.xxh3_64_intdigest)


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every window of ``size`` consecutive word hashes (the whole sequence if shorter)."""
    n = len(h)
    if n == 0:
        return h
    width = min(size, n)
    acc = h[: n - width + 1].copy()
    step = np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, width):
        acc = acc * step + h[k : n - width + 1 + k]
    return mixed(acc + np.uint64(width))


def sized(df: DataFrame, text_col: str, name: str, keep_text: bool = True) -> DataFrame:
    """All columns of ``df`` and ``name``: the number of words of the text (0 for null)."""
    base = df.drop(name).withColumn(text_col, F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_col)
            n = pa.array([len(x.split()) if x else 0 for x in text_bytes(batch.column(at))], pa.int64())
            rest = [i for i in range(batch.num_columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), n], names=[*(batch.schema.names[i] for i in rest), name])

    out = base if keep_text else base.drop(text_col)
    return base.mapInArrow(releasing(run), out.withColumn(name, F.lit(0).cast("long")).schema)
