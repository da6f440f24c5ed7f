"""Words, hashes and Arrow plumbing shared by the text operators.

Texts reach Python as UTF-8 bytes.  ``bytes.split()`` cuts at exactly the six
white-space bytes ``\\x20 \\x09-\\x0D`` and ``bytes.lower()`` changes exactly A-Z,
so words need no regular expression.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

Batch = tuple[list, list]  # doc_ids and texts (bytes, b"" for null) of one Arrow batch
#: Bytes of text whose arrays a task holds together.
PORTION = 1 << 22


def doc_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and the text as bytes, so other columns cannot clash; null texts stay null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(ddl)])


def portions(batches: Iterator[pa.RecordBatch], most: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``most`` bytes of ``text``, however many rows a batch has."""
    for b in batches:
        if b.num_rows:
            part = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(), dtype=np.int64) // most
            edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                yield b.slice(lo, hi - lo)


def release() -> None:
    """Give freed memory back to the system: Spark keeps a worker for later tasks, and with it what its allocators hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], ddl: str) -> DataFrame:
    """``mapInArrow`` with a function that yields plain columns."""
    fields = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.record_batch([pa.array(columns[f.name], type=f.type) for f in fields], schema=fields)
        columns = None
        release()

    return df.mapInArrow(run, ddl)


def bernoulli_crc(doc_id: int | None) -> int:
    """CRC-32 of the id as decimal text; 0 for a null id."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode())


class WordHash(dict):
    """64-bit hash of a word, remembered up to a bound."""

    def __init__(self, seed: int = 0, bound: int = 400_000) -> None:
        super().__init__()
        self.seed, self.bound = seed, bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64, a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\x0b\x0c\r")] = True
#: The first 0 to 8 bytes of a number in memory.
LEADING = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)
#: Longer words are hashed one by one.
LONG_WORD = 64


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, A-Z lower-cased, and where each text's begin in them (one more at the end).

    Words of up to eight bytes are told apart surely; longer ones by a hash that takes eight bytes at a time.
    """
    data = b" " + b" ".join([t or b"" for t in texts]).lower() + b" " * 8
    space = SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # the eight bytes from each place on
    h = mix(mix(eight[start] & LEADING[np.minimum(size, 8)]) + size.astype(np.uint64))
    rest = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    done = 8
    while len(rest):
        h[rest] = mix(mix(h[rest]) ^ (eight[start[rest] + done] & LEADING[np.minimum(size[rest] - done, 8)]))
        done += 8
        rest = rest[size[rest] > done]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]])
    begin = np.cumsum([1] + [len(t or b"") + 1 for t in texts])
    return h, np.searchsorted(start, begin)


class Rolling:
    """Hashes of runs of words: a polynomial over the words' hashes, modulo 2**64, scrambled."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.inverse = pow(self.BASE, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(2 * len(self.up), n + 1)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, self.BASE, np.uint64)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, self.inverse, np.uint64)]), dtype=np.uint64)

    def prefix(self, h: np.ndarray) -> np.ndarray:
        """Prefix sums from which any run's hash follows."""
        self._grow(len(h))
        out = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.up[: len(h)], out=out[1:])
        return out

    def runs(self, prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((prefix[stop] - prefix[start]) * self.down[start])

    def windows(self, h: np.ndarray, width: int) -> np.ndarray:
        n = len(h) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        p = self.prefix(h)
        return mix((p[width:] - p[:n]) * self.down[:n])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
