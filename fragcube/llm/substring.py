"""Removal of repeated word spans by compaction of a De Bruijn graph.

Every run of ``WINDOW`` words is an edge of the graph.  A window is filed under
its *anchor*, the smallest hash among its runs of ``KMER`` words, so equal
windows have equal anchors wherever they stand.  Consecutive windows of a text
with the same anchor position form a path, and one row per path (not per
window) describes the corpus: about one row for twenty words.

1. Paths are aggregated by anchor and content.  A path that recurs in a larger
   ``doc_id`` than its first is repeated without a branch: all its windows
   there are removed as one span.
2. Where documents meet at an anchor with different paths the graph branches.
   Only there, and only for the first document of each path, paths are opened
   into their windows, and windows are joined with the smallest ``doc_id`` that
   has them.  Which paths to open is told to the second scan by a bitmap, sized
   by their number up to ``MOST_BITS``; where unrelated paths share a bit they are
   opened for nothing.
3. Spans return to their documents by coordinates.  A span is removed only if
   the words there have the hash that was compared.

Each aggregate combines inside its task first, and joins are by (anchor, content),
which adaptive execution splits where hot.  Null text has no words.  Rows with a
null ``doc_id`` are neither removed from nor compared with.  Rows that repeat a
``doc_id`` are never repeats of each other.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragcube.llm.text import Rolling, WordHash, doc_text, map_arrow, release, signed
from fragcube.session import materialise

WINDOW = 50
KMER = 10
#: Exponents of the least and greatest number of bits of the map of paths to open (4 KB, 128 MB), and its bits for each path.
LEAST_BITS, MOST_BITS = 15, 30
SPARSE = 32
#: Bits in one row of Spark's bitmaps.
ROW_BITS = 32768


#: Low bits of a hash that give way to the place, so that a minimum tells where it stands.
PLACE = np.uint64((1 << 24) - 1)


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in every window, the first of equals; values count by their upper 40 bits.

    Minima from each block's start and to each block's end meet in every window,
    so the cost does not depend on the width.
    """
    n = len(values) - width + 1
    if len(values) > int(PLACE):
        upper = values & ~PLACE
        return np.concatenate([
            np.lib.stride_tricks.sliding_window_view(upper[i : i + 100_000 + width - 1], width).argmin(axis=1) + i for i in range(0, n, 100_000)
        ])
    full = np.full(-(-len(values) // width) * width, ~np.uint64(0))
    full[: len(values)] = (values & ~PLACE) | np.arange(len(values), dtype=np.uint64)
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & PLACE).astype(np.int64)


class Graph:
    """Paths of a text."""

    def __init__(self, window: int, kmer: int) -> None:
        self.window, self.kmer = window, kmer
        self.words, self.rolling = WordHash(), Rolling()

    def prefix(self, words: list[bytes]) -> np.ndarray:
        return self.rolling.prefix(self.words.of(words))

    def paths(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Anchor, content, first window and number of windows of each path, and the prefix sums of the text."""
        p = self.prefix(words)
        n = len(words) - self.window + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return none.view(np.uint64), none.view(np.uint64), none, none, p
        at = np.arange(len(words) - self.kmer + 1)
        kmers = self.rolling.runs(p, at, at + self.kmer)
        place = first_least(kmers, self.window - self.kmer + 1)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        count = np.diff(np.append(first, n))
        return kmers[place[first]], self.rolling.runs(p, first, first + count + self.window - 1), first, count, p


def bits_for(n: int) -> int:
    """Exponent of the bits of a map of ``n`` entries."""
    return min(MOST_BITS, max(LEAST_BITS, (SPARSE * n).bit_length()))


def bit_of(path: Column, doc: Column, bits: int) -> Column:
    """Bit (from 1) of a path in a document; :func:`bits_of` is the same on arrays."""
    return path.bitwiseXOR(doc).bitwiseXOR(F.shiftleft(doc, 9)).bitwiseAND(F.lit(2**bits - 1)) + 1


def bits_of(path: np.ndarray, doc: int, size: int) -> np.ndarray:
    return (signed(path) ^ np.int64(doc) ^ (np.int64(doc) << np.int64(9))) & np.int64(size - 1)


def known_documents(docs: DataFrame) -> DataFrame:
    return doc_text(docs).filter("doc_id is not null")


def path_rows(docs: DataFrame, window: int, kmer: int) -> DataFrame:
    def run(batches):
        graph = Graph(window, kmer)
        for b in batches:
            anchors, paths, docs_, starts, counts = [], [], [], [], []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                anchor, path, start, count, _ = graph.paths((text or b"").split())
                if len(start):
                    anchors.append(anchor)
                    paths.append(path)
                    docs_.append(np.full(len(start), doc, np.int64))
                    starts.append(start)
                    counts.append(count)
            if anchors:
                yield {
                    "anchor": signed(np.concatenate(anchors)), "path": signed(np.concatenate(paths)), "doc": np.concatenate(docs_),
                    "start": np.concatenate(starts).astype(np.int32), "n": np.concatenate(counts).astype(np.int32),
                }

    return map_arrow(known_documents(docs), run, "anchor long, path long, doc long, start int, n int")


def bitmap(numbers: DataFrame, bits: int) -> np.ndarray:
    """The bits ``b`` (from 1, at most 2**bits) as bytes: at most 2**bits / ROW_BITS rows come to the driver."""
    places = numbers.selectExpr("bitmap_bucket_number(b) as bucket", "bitmap_bit_position(b) as place")
    rows = places.groupBy("bucket").agg(F.expr("bitmap_construct_agg(place)").alias("bits")).toArrow()
    out = np.zeros((2**bits // ROW_BITS, ROW_BITS // 8), np.uint8)
    for bucket, row in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        out[bucket - 1] = np.frombuffer(row, np.uint8)
    return out.ravel()


def window_rows(docs: DataFrame, opened: np.ndarray, window: int, kmer: int) -> DataFrame:
    """The windows of the paths whose bit is set, stored."""
    bits = docs.sparkSession.sparkContext.broadcast(opened)  # at most 2**MOST_BITS bits

    def run(batches):
        graph, table = Graph(window, kmer), bits.value
        for b in batches:
            held, room = [], 0
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                anchor, path, start, count, p = graph.paths((text or b"").split())
                if not len(start):
                    continue
                bit = bits_of(path, doc, 8 * len(table))
                hit = (table[bit >> 3] >> (bit & 7)) & 1 == 1
                if hit.any():
                    start, count = start[hit], count[hit]
                    at = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    held.append((np.repeat(anchor[hit], count), graph.rolling.runs(p, at, at + window), np.full(len(at), doc, np.int64), at))
                    room += len(at)
                if room > 200_000:
                    yield _columns(held)
                    held, room = [], 0
            if held:
                yield _columns(held)

    stored = materialise(map_arrow(known_documents(docs), run, "anchor long, window long, doc long, start int"), "windows")
    bits.destroy()
    return stored


def _columns(held: list[tuple]) -> dict:
    anchor, window, doc, start = (np.concatenate(x) for x in zip(*held))
    return {"anchor": signed(anchor), "window": signed(window), "doc": doc, "start": start.astype(np.int32)}


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """``doc``, ``start``, ``length`` and ``hash`` of spans whose windows all start in a smaller ``doc``."""
    rows = materialise(path_rows(docs, window, kmer), "rows")
    paths = materialise(rows.groupBy("anchor", "path").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")), "paths")
    whole = (
        rows.join(paths.filter("lo < hi").select("anchor", "path", "lo"), ["anchor", "path"]).filter("doc > lo")
        .select("doc", "start", (F.col("n") + (window - 1)).alias("length"), F.col("path").alias("hash"))
    )
    branches = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("least"), F.max("lo").alias("most")).filter("n > 1 and least < most")
    # the smallest document of an anchor has nothing before it, but its windows are what the others repeat
    meeting = materialise(paths.join(branches.select("anchor"), "anchor", "left_semi").select("path", "lo"), "meeting")
    bits = bits_for(meeting.count())
    opened = bitmap(meeting.select(bit_of(F.col("path"), F.col("lo"), bits).alias("b")), bits)
    windows = window_rows(docs, opened, window, kmer)
    least = windows.groupBy("anchor", "window").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("anchor", "window", "lo")
    single = (
        windows.join(least, ["anchor", "window"]).filter("doc > lo")
        .select("doc", "start", F.lit(window).alias("length"), F.col("window").alias("hash"))
    )
    return whole.unionByName(single)


def covered(graph: Graph, words: list[bytes], spans: list[dict]) -> np.ndarray:
    """Which words lie in a span, after comparing each span's hash with the words at its place."""
    start = np.array([s["start"] for s in spans], np.int64)
    stop = start + np.array([s["length"] for s in spans], np.int64)
    inside = stop <= len(words)
    start, stop, want = start[inside], stop[inside], np.array([s["hash"] for s in spans], np.int64)[inside]
    same = signed(graph.rolling.runs(graph.prefix(words), start, stop)) == want
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start[same], 1)
    np.add.at(change, stop[same], -1)
    return np.cumsum(change[:-1]) > 0


def with_spans(docs: DataFrame, window: int, kmer: int) -> tuple[DataFrame, str]:
    """``docs`` with a further column of its repeated spans (null where none), and that column's name."""
    name = "_spans"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    spans = repeated_spans(docs, window, kmer).groupBy("doc").agg(F.collect_list(F.struct("start", "length", "hash")).alias("spans"))
    found = spans.select(F.col("doc").alias(f"{name}doc"), F.col("spans").alias(name))
    return docs.join(found, docs["doc_id"].cast("long") == found[f"{name}doc"], "left").select(*(docs[c] for c in docs.columns), found[name]), name


def cut(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """Per document ``n_words``, ``n_removed`` and ``kept_sha256`` of the words that stay, joined by single spaces."""
    rows, name = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")), window, kmer)

    def run(batches):
        graph = Graph(window, kmer)
        for b in batches:
            n, gone, digest = [], [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column(name).to_pylist()):
                words = (text or b"").split()
                kept = words
                if spans:
                    kept = [w for w, out in zip(words, covered(graph, words, spans).tolist()) if not out]
                n.append(len(words))
                gone.append(len(words) - len(kept))
                digest.append(sha256(b" ".join(kept)).hexdigest())
            yield {"doc_id": b.column("doc_id"), "n_words": n, "n_removed": gone, "kept_sha256": digest}

    return map_arrow(rows, run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def strip(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """``docs`` with repeated words taken out of ``text``; untouched texts stay as they are, all columns remain."""
    rows, name = with_spans(docs, window, kmer)
    fields = docs.columns

    def run(batches):
        graph = Graph(window, kmer)
        for b in batches:
            at = b.schema.get_field_index("text")
            texts = b.column(at).cast(pa.binary()).to_pylist()
            for i, spans in enumerate(b.column(b.schema.get_field_index(name)).to_pylist()):
                if spans:
                    words = (texts[i] or b"").split()
                    out = covered(graph, words, spans).tolist()
                    texts[i] = b" ".join(w for w, o in zip(words, out) if not o) if any(out) else texts[i]
            columns = [b.column(b.schema.get_field_index(c)) for c in fields]
            columns[fields.index("text")] = pa.array(texts, pa.binary()).cast(b.schema.field(at).type)
            yield pa.record_batch(columns, names=fields)
        release()

    return rows.mapInArrow(run, docs.schema)
