"""Best-fit packing of token sequences by exact-complement hashing.

Documents become ids and are cut only where longer than a sequence.  What the
plan needs of a corpus is how many pieces have each length: at most ``capacity``
numbers, whatever the corpus size.  From the longest on, the plan looks up one,
two or three other lengths whose sum is exactly the gap (the index is addressed
by length, and a candidate's complement is one lookup), and uses that
combination as often as the remaining counts allow.  What is left is packed by
best fit on the same counts.  Every step uses up one length, so the plan has at
most ``capacity`` combinations of at most 63 different lengths.

Pieces then take their places by rank within their length.  Ranks come from
counts per salted part of a length and row numbers inside a part, so a length
that a third of all pieces share is ranked by many tasks.

A null text is the empty text and becomes one piece with the closing id alone.
Repeated rows are packed as often as they come; an empty table gives no rows.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fragcube.llm.bpe import Memory, slices
from fragcube.llm.text import doc_text, map_arrow
from fragcube.session import materialise

CAPACITY = 2048
#: Distinct words that a worker remembers.
CACHE = 500_000
#: Pieces of one length that one task ranks.
PART = 1_000


class Words:
    """Ids of white-space separated words, remembered up to a bound.

    White space always ends a token and no normalisation reaches across it, so
    the ids of a text are those of its words in a row.  The vocabulary's own special
    tokens are found in texts, as the library does by default.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.memory = Memory(self.library, True, CACHE)
        self.added = os.path.commonprefix([t.content for t in self.library.get_added_tokens_decoder().values()])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not texts:
            return []
        words = pc.ascii_split_whitespace(pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()))
        table = words.values.dictionary_encode()
        # the vocabulary folds case; special tokens keep theirs
        plain = pc.and_not(pc.string_is_ascii(table.dictionary), pc.match_substring(table.dictionary, self.added))
        folded = pc.if_else(plain, pc.ascii_lower(table.dictionary), table.dictionary)
        return self.memory.expand(folded, words.offsets.to_numpy(), table.indices.to_numpy())


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Words:
    """One tokenizer per worker."""
    return Words(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Documents as ids with a closing 0, cut where longer than ``capacity``; ``ids`` adds the ids themselves."""
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids

    def run(batches):
        own = tokenizer(vocabulary)
        for b in batches:
            for doc_ids, texts in slices(b):
                out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                for doc_id, own_ids in zip(doc_ids.to_pylist(), own.encode(texts)):
                    all_ids = np.append(own_ids, np.uint32(0)).astype("<u4")
                    for p, start in enumerate(range(0, len(all_ids), capacity)):
                        part = all_ids[start : start + capacity]
                        out["doc_id"].append(doc_id)
                        out["piece"].append(p)
                        out["start"].append(start)
                        out["length"].append(len(part))
                        out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                        if ids:
                            out["ids"].append(part.astype(np.int32))
                yield out

    return map_arrow(doc_text(docs), run, ddl)


def complement(counts: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths that sum to ``gap``, the largest lengths first."""
    if gap <= 0:
        return None
    if counts[gap] > 0:
        return [gap]

    def pair(total: int, below: int) -> list[int] | None:
        a = np.arange((total + 1) // 2, min(below, total - 1) + 1)
        if not len(a):
            return None
        both = (counts[a] > 0) & (counts[total - a] > 0) & ((a != total - a) | (counts[a] > 1))
        hit = np.flatnonzero(both)
        return [int(a[hit[-1]]), total - int(a[hit[-1]])] if len(hit) else None

    if found := pair(gap, gap - 1):
        return found
    for first in np.flatnonzero(counts[: gap - 1])[::-1]:
        first = int(first)
        if 3 * first < gap:
            break
        counts[first] -= 1
        rest = pair(gap - first, first)
        counts[first] += 1
        if rest:
            return [first, *rest]
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Combinations of lengths and how many sequences use each."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out: list[tuple[list[int], int]] = []

    def use(lengths: list[int]) -> None:
        need = Counter(lengths)
        times = min(int(counts[x]) // k for x, k in need.items())
        for x, k in need.items():
            counts[x] -= times * k
        out.append((sorted(lengths, reverse=True), times))

    for length in range(capacity, 0, -1):
        while counts[length] > 0:
            if length == capacity:
                use([length])
                continue
            counts[length] -= 1
            rest = complement(counts, capacity - length)
            counts[length] += 1
            if not rest:
                break
            use([length, *rest])
    while counts.any():  # best fit on what is left: the longest, then always the longest that still fits
        left, lengths, room = counts.copy(), [], capacity
        while True:
            fitting = np.flatnonzero(left[: room + 1])
            if not len(fitting):
                break
            length = int(fitting[-1])
            k = min(int(left[length]), room // length)
            left[length] -= k
            room -= k * length
            lengths += [length] * k
        use(lengths)
    return out


def slots(combinations: list[tuple[list[int], int]]) -> np.ndarray:
    """Per combination and length: length, first rank, first sequence, offset, pieces per sequence; in order of length and rank."""
    taken: Counter = Counter()
    rows, base = [], 0
    for lengths, times in combinations:
        offset = 0
        for length, k in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, taken[length], base, offset, k))
            taken[length] += times * k
            offset += length * k
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(stored: DataFrame) -> DataFrame:
    """``rank`` of every piece within its length, from 0, without gaps."""
    sizes = stored.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    parts = F.broadcast(sizes.select("length", F.ceil(F.col("n") / PART).alias("parts")))  # at most `capacity` rows
    salted = stored.join(parts, "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts"))).drop("parts")
    groups = salted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = groups.select(
        "length", "part",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("inside")).drop("before", "inside", "part")


def place(stored: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id`` and ``offset`` of every piece of a stored table of pieces."""
    spark = stored.sparkSession
    histogram = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    table = spark.sparkContext.broadcast(slots(plan(histogram, capacity)))
    rows = ranked(stored).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")

    def run(batches):
        at = table.value
        keys = at[:, 0] << 48 | at[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            slot = at[np.searchsorted(keys, length << 48 | rank, side="right") - 1] if len(length) else at[:0]
            past = rank - slot[:, 1]
            yield {
                **{c: b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
                "sequence_id": slot[:, 2] + past // np.maximum(slot[:, 4], 1),
                "offset": slot[:, 3] + past % np.maximum(slot[:, 4], 1) * length,
            }

    return map_arrow(rows, run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` ids."""
    return place(materialise(pieces(docs, vocabulary, capacity), "pieces"), capacity)
