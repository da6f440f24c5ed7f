"""Set-similarity join of documents by a count-vector R-tree.

A document's set is its distinct word shingles.  Hashing the shingles into
``GROUPS`` groups and counting gives a point; the overlap of two sets is at most
the sum of the smaller coordinates.  An R-tree over such points holds the
largest coordinate per group, the least and the greatest set size of a branch,
and passes over branches whose bound is below the overlap that the similarity
demands.  Surviving pairs are verified on the shingles themselves.

So that no task has to hold all points, they first fall into blocks: two sets
that are similar enough share one of their first shingles under any order that
all documents agree on (frequent shingles last, else by hash), if "first" means
as many as may differ plus one.  Blocks with equal members are one block, and a
block whose members all have the same larger block as their largest is left out, as
the larger one holds all its pairs (a passage that some documents share gives one
such block within another for each of its shingles);
a block of more than ``TILE`` members is split into pairs of tiles.

1. One scan finds the sets' digests, points and locally frequent shingles;
   equal sets become one class, represented by its smallest ``doc_id``.
2. A second scan writes (first shingle, class) rows, which meet by shingle.
3. The R-tree runs in every block on points alone; members without a possible
   partner leave.
4. Texts of members are sent to the largest block of each, verified there, and
   components found.  Of blocks that still span several components, members with
   another largest block than most visit that one; those with a possible partner in
   another component are found there, and sent, once
   each, to the larger of the two components, where these pairs are verified.

Tasks return links that connect what they found connected, not all pairs.  A
text without words has an empty set and no links; with fewer words than a
shingle the whole sequence is its one shingle.  Null ``doc_id`` rows are
components of their own (null).  Rows repeating a ``doc_id`` are one node of the
graph with all their texts, and give one row each.  Only ``doc_id`` and ``text`` are read.  Shingles
and sets are compared by 64- and 128-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fragcube.llm.components import components
from fragcube.llm.substring import bitmap, bits_for
from fragcube.llm.text import Rolling, doc_text, map_arrow, mix, portions, signed, word_hashes
from fragcube.session import BROADCAST_ROWS, materialise, within

WIDTH = 5
#: Similarity, in percent.
PERCENT = 80
GROUPS = 256
#: Large sets are counted in up to so many finer groups, about two shingles each; these refine the bound of the tree.
FINEST = 1 << 14
TILE = 4096
#: Bytes of text whose words are hashed together.
PIECE = 1 << 18
LEAF = 16
#: A shingle in this share of the documents counts as frequent.  It only changes the order of shingles.
FREQUENT = 1 / 2000
#: Most shingles that are sent to the tasks as frequent, the commonest first.
FREQUENT_MOST = 1 << 17


class Shingler:
    def __init__(self, width: int = WIDTH) -> None:
        self.width, self.rolling = width, Rolling()

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the distinct shingles of each text, one text's after the other's, and where each begins (one more at the end)."""
        values, sizes = [], []
        for some in pieces(texts):
            v, n = self._piece(some)
            values.append(v)
            sizes.append(n)
        return np.concatenate([np.zeros(0, np.uint64), *values]), np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))

    def _piece(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        h, first = word_hashes(texts)
        n = np.diff(first)
        p = self.rolling.prefix(h)
        many = np.where(n >= self.width, n - self.width + 1, np.minimum(n, 1))
        begin = np.cumsum(many) - many
        start = np.repeat(first[:-1] - begin, many) + np.arange(many.sum())
        s = self.rolling.runs(p, start, np.minimum(start + self.width, np.repeat(first[1:], many)))
        short = np.flatnonzero((n > 0) & (n < self.width))
        s[begin[short]] = mix(s[begin[short]] + n[short].astype(np.uint64))
        for lo, hi in zip(begin.tolist(), (begin + many).tolist()):
            s[lo:hi].sort()
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        new[begin[many > 0]] = True
        return s[new], np.bincount(np.repeat(np.arange(len(texts)), many)[new], minlength=len(texts))


def pieces(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """The texts in runs of about ``PIECE`` bytes, whose arrays stay in a core's cache."""
    lo = room = 0
    for i, text in enumerate(texts):
        room += len(text or b"")
        if room > PIECE:
            yield texts[lo : i + 1]
            lo, room = i + 1, 0
    if lo < len(texts):
        yield texts[lo:]


def cut(values: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    edges = first.tolist()
    return [values[lo:hi] for lo, hi in zip(edges, edges[1:])]


def digests(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two independent hashes of each set, as signed longs (2 x sets); zeros for empty sets."""
    n, out = np.diff(first), []
    for each in (mix(values), mix(~values ^ np.uint64(0x5851F42D4C957F2D))):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        out.append(np.where(n > 0, mix(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64)), np.uint64(0)))
    return signed(np.stack(out))


def point(shingles: np.ndarray) -> bytes | None:
    """Counts per group as bytes; None if a count needs more than a byte (such a point bounds nothing).

    Groups are the leading bits of a shingle's hash, so coarser counts are sums of neighbours.
    """
    bits = min(max((len(shingles) // 2).bit_length(), GROUPS.bit_length() - 1), FINEST.bit_length() - 1)
    counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if folded(counts, GROUPS).max() < 256 else None


def coarse(fine: bytes | None) -> bytes | None:
    return None if fine is None else folded(np.frombuffer(fine, np.uint8), GROUPS).astype(np.uint8).tobytes()


def packed(counts: bytes | None) -> bytes | None:
    """A point as it is stored and sent: most counts are small, so a Huffman code takes a third or half."""
    if counts is None:
        return None
    coder = zlib.compressobj(1, zlib.DEFLATED, -15, 8, zlib.Z_HUFFMAN_ONLY)
    return coder.compress(counts) + coder.flush()


def unpacked(points: pa.ChunkedArray) -> list[bytes | None]:
    return [p and zlib.decompress(p, -15) for p in points.to_pylist()]


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(groups, -1).sum(axis=1, dtype=np.int64)


def required(a, b):
    """Least overlap of sets of these sizes at the threshold: percent of the union, solved for the overlap."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def first_shingles(values: np.ndarray, first: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which of the sets' shingles are among the first of their set, in which the frequent ones come last."""
    n = np.diff(first)
    early = np.ones(len(values), bool)
    if len(frequent):
        early = frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] != values
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(early)])
    own = before[:-1] - np.repeat(before[first[:-1]], n)  # early ones of the set before each
    place = np.arange(len(values)) - np.repeat(first[:-1], n)
    rank = np.where(early, own, np.repeat(before[first[1:]] - before[first[:-1]], n) + place - own)
    return rank < np.repeat(n - -(-PERCENT * n // 100) + 1, n)


def commonest(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that come at least ``least`` times (2 or more), and how often; sorts ``values`` in place."""
    values.sort()
    ends = values[least - 1 :][values[least - 1 :] == values[: max(0, len(values) - least + 1)]]
    often = np.unique(ends)
    return often, np.searchsorted(values, often, side="right") - np.searchsorted(values, often)


def described(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Set size, digests and point of every text; the shingles of a batch are only held to count the frequent ones."""
    shingler = Shingler()
    for b in batches:
        held = []
        at = 0
        for some in portions([b]):
            at += some.num_rows
            values, first = shingler.of(some.column("text").to_pylist())
            id1, id2 = digests(values, first)
            fine = [point(s) for s in cut(values, first)]
            rows = {"n_shingles": np.diff(first), "id": id1, "id2": id2, "fine": [packed(p) for p in fine], "point": [packed(coarse(p)) for p in fine]}
            held.append(values)
            often, often_n = ([None] * some.num_rows for _ in range(2))
            if at == b.num_rows:
                values, counts = commonest(np.concatenate(held), int(np.ceil(max(4, FREQUENT / 2 * b.num_rows))))
                often[0], often_n[0] = signed(values), counts
            yield {"doc_id": some.column("doc_id"), **rows, "often": often, "often_n": often_n}


def sets_of(docs: DataFrame) -> DataFrame:
    """Per document: set size, digests and point; on one row of a batch also what is frequent in the batch."""
    ddl = "doc_id long, n_shingles long, id long, id2 long, fine binary, point binary, often array<long>, often_n array<long>"
    return map_arrow(doc_text(docs), described, ddl)


def frequent_shingles(sets: DataFrame, n_docs: int) -> np.ndarray:
    rows = sets.filter("often is not null").select(F.explode(F.arrays_zip("often", "often_n")).alias("x"))
    summed = rows.groupBy(F.col("x.often").alias("s")).agg(F.sum("x.often_n").alias("n")).filter(F.col("n") >= max(4, FREQUENT * n_docs))
    top = summed.orderBy(F.desc("n"), "s").limit(FREQUENT_MOST).select("s").toArrow()  # bounded by the limit
    return np.sort(top.column("s").to_numpy().view(np.uint64))


def keyed(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[dict]:
    """First shingles (``key``) of each set, with its digest."""
    shingler = Shingler()
    for b in portions(batches):
        values, first = shingler.of(b.column("text").to_pylist())
        both = digests(values, first)
        new = np.zeros(b.num_rows, bool)
        new[np.unique(both, axis=1, return_index=True)[1]] = True
        chosen = first_shingles(values, first, frequent) & np.repeat(new, np.diff(first))
        if chosen.any():
            yield {"key": signed(values[chosen]), "id": np.repeat(both[0], np.diff(first))[chosen]}


def blocks_of(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Distinct ``b1``, ``b2`` (a block), ``m`` (its members) and ``id`` (one of them), for blocks of two or more classes."""
    late = docs.sparkSession.sparkContext.broadcast(frequent)  # FREQUENT_MOST numbers at most

    def meet(batches):
        held = [(b.column("key").to_numpy(), b.column("id").to_numpy()) for b in batches]
        if not held:
            return
        key, ids = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])
        key, ids = key[first], ids[first]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        u = ids.view(np.uint64)
        b1 = mix(np.add.reduceat(mix(u), starts) + sizes.astype(np.uint64))
        b2 = mix(np.add.reduceat(mix(~u), starts))
        several = np.flatnonzero(sizes > 1)
        by_block = np.lexsort((b2[several], b1[several]))
        several = several[by_block]
        if len(several):
            same = (b1[several][1:] == b1[several][:-1]) & (b2[several][1:] == b2[several][:-1])
            several = several[np.append(True, ~same)]
        sizes = sizes[several]
        at = np.repeat(starts[several], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield {"b1": signed(np.repeat(b1[several], sizes)), "b2": signed(np.repeat(b2[several], sizes)), "m": np.repeat(sizes, sizes), "id": ids[at]}

    rows = map_arrow(doc_text(docs), lambda batches: keyed(batches, late.value), "key long, id long").repartition("key")
    stored = materialise(map_arrow(rows, meet, "b1 long, b2 long, m long, id long").distinct(), "blocks")
    late.destroy()
    return stored


def outermost(found: DataFrame) -> DataFrame:
    """The blocks without those whose members all have one other block as their largest: it holds them all."""
    largest = F.max(F.struct("m", "b1", "b2")).over(Window.partitionBy("id"))
    ends = found.withColumn("x", largest).groupBy("b1", "b2").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    inner = ends.filter("lo = hi and (lo.b1 <> b1 or lo.b2 <> b2)").select("b1", "b2")
    return found.join(inner, ["b1", "b2"], "left_anti")


def tiles(members: DataFrame) -> DataFrame:
    """Adds ``tile``: blocks above ``TILE`` members become all pairs of their tiles, others stay whole.  ``m``, if there, is the size of the block."""
    if "m" not in members.columns:
        members = members.join(members.groupBy("b1", "b2").agg(F.count(F.lit(1)).alias("m")), ["b1", "b2"])
    split = members.withColumn("parts", F.ceil(F.col("m") / TILE).cast("int")).drop("m")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    split = split.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    return split.withColumn("tile", F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).drop("own", "other", "parts")


class Tree:
    """R-tree over points in order of set size: per branch the largest coordinates and the range of sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        self.levels = [(points, sizes, sizes)]
        while len(self.levels[-1][0]) > LEAF:
            p, lo, hi = self.levels[-1]
            at = np.arange(0, len(p), LEAF)
            self.levels.append((np.maximum.reduceat(p, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)))

    def near(self, q: np.ndarray, n: int) -> np.ndarray:
        """Positions of points that may be similar enough to ``q``."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            p, lo, hi = self.levels[depth]
            at = at[(100 * hi[at] >= PERCENT * n) & (PERCENT * lo[at] <= 100 * n)]
            least = np.maximum(lo[at], -(-PERCENT * n // 100))
            bound = np.minimum(p[at], q).sum(axis=1, dtype=np.int64)
            at = at[bound >= required(n, least)]
            if depth:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return at


def possible(points: list[bytes | None], sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each member the members after it, in order of size, that may be similar enough."""
    order = np.lexsort((np.arange(len(sizes)), sizes))
    fine = [np.frombuffer(points[i], np.uint8) if points[i] else None for i in order]
    full = np.full(GROUPS, 255, np.uint8)
    table = np.stack([full if f is None else folded(f, GROUPS).astype(np.uint8) for f in fine])
    n = sizes[order]
    unbounded = np.array([points[i] is None for i in order])
    tree = Tree(table, n)
    for k, i in enumerate(order):
        if unbounded[k]:
            at = np.flatnonzero((100 * n >= PERCENT * n[k]) & (PERCENT * n <= 100 * n[k]))
        else:
            at = tree.near(table[k], int(n[k]))
        at = at[at > k]
        if fine[k] is not None and len(fine[k]) > GROUPS:
            at = np.array([j for j in at.tolist() if fine[j] is None or _overlap(fine[k], fine[j]) >= required(int(n[k]), int(n[j]))], np.int64)
        yield int(i), order[at]


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Bound of the overlap by the finest groups that both points have."""
    groups = min(len(a), len(b))
    return int(np.minimum(folded(a, groups), folded(b, groups)).sum())


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys in sorted batches, also across their borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(b.schema.get_field_index(c)).to_numpy() for c in keys])
        cuts = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), b.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            now = tuple(k[:, lo].tolist())
            if last is not None and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = now
    if held:
        yield pa.Table.from_batches(held)


BLOCK = ("b1", "b2", "tile")


def hopeful(members: DataFrame, points: DataFrame) -> DataFrame:
    """Members (``b1, b2, id``) with a possible partner in their block; ``points``: ``id``, ``n``, ``point``, ``doc``."""

    def run(batches):
        out = {k: [] for k in ("b1", "b2", "id")}
        for g in groups(batches, BLOCK):
            ids = g.column("doc").to_numpy()
            keep = np.zeros(len(ids), bool)
            for i, after in possible(unpacked(g.column("point")), g.column("n").to_numpy()):
                if len(after):
                    keep[i] = True
                    keep[after] = True
            for c in ("b1", "b2"):
                out[c] += [g.column(c)[0].as_py()] * int(keep.sum())
            out["id"] += ids[keep].tolist()
            if len(out["id"]) > 50_000:
                yield out
                out = {k: [] for k in out}
        yield out

    # points join last, so that they are sent once
    rows = tiles(members).join(points, "id").repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    return map_arrow(rows, run, "b1 long, b2 long, id long").distinct()


def unsettled(members: DataFrame, once: DataFrame, labels: DataFrame) -> DataFrame:
    """Blocks (``b1, b2``) of docs, with ``part`` and ``home``, in which all pairs of members meet that may link components.

    Pairs with one home (the block where a doc was verified) are settled.  The members of a block that have another home
    than most of it visit that home, where they meet the others: a visit is one row however many blocks call for it.
    Among themselves they meet in what is left of the block.
    """
    homes = once.select("doc", F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2")).alias("home"))
    homes = homes.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "home", F.coalesce("component", "doc").alias("part"))
    labelled = members.join(homes, "doc")

    def several(rows: DataFrame, *more) -> DataFrame:
        ends = (f(c).alias(f"{n}_{c}") for c in ("part", "home") for n, f in (("lo", F.min), ("hi", F.max)))
        return rows.groupBy("b1", "b2").agg(*ends, *more).filter("lo_part < hi_part and lo_home < hi_home").drop("lo_part", "hi_part", "lo_home", "hi_home")

    away = materialise(labelled.join(several(labelled, F.mode("home").alias("main")), ["b1", "b2"]).filter("home <> main"), "away")
    visits = away.select(F.col("main.h1").alias("b1"), F.col("main.h2").alias("b2"), "doc").distinct()
    residents = once.select("b1", "b2", "doc").join(visits.select("b1", "b2").distinct(), ["b1", "b2"], "left_semi")
    among = away.select("b1", "b2", "doc").join(several(away), ["b1", "b2"], "left_semi")
    return visits.unionByName(residents).unionByName(among).distinct().join(homes, "doc")


def between(members: DataFrame) -> DataFrame:
    """Where to verify what lies between components: rows (``b1``, ``id``) for every member with a possible partner elsewhere.

    ``members``: ``b1, b2, id, n, point, part, part_size`` and the home (``h1, h2``), within which pairs are settled;
    the new ``b1`` is the larger component of a pair.
    """

    def run(batches):
        out = {"b1": [], "id": []}
        for g in groups(batches, BLOCK):
            ids, part, size, h1, h2 = (g.column(c).to_numpy() for c in ("id", "part", "part_size", "h1", "h2"))
            found = set()
            for i, after in possible(unpacked(g.column("point")), g.column("n").to_numpy()):
                after = after[(part[after] != part[i]) & ((h1[after] != h1[i]) | (h2[after] != h2[i]))]
                other = (size[after] > size[i]) | ((size[after] == size[i]) & (part[after] < part[i]))
                for j, key in zip(after.tolist(), np.where(other, part[after], part[i]).tolist()):
                    found |= {(key, int(ids[i])), (key, int(ids[j]))}
            out["b1"] += [k for k, _ in found]
            out["id"] += [i for _, i in found]
            if len(out["id"]) > 50_000:
                yield out
                out = {"b1": [], "id": []}
        yield out

    rows = tiles(members).repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    return map_arrow(rows, run, "b1 long, id long").distinct()


def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, with their ``text`` replaced by the bytes of its ``set``."""
    shingler = Shingler()
    for b in portions(batches):
        values, first = shingler.of(b.column("text").to_pylist())
        yield b.drop_columns(["text"]).append_column("set", pa.array([s.tobytes() for s in cut(values, first)], pa.binary()))


def verified(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` (doc_ids) that connect what is connected in each block (``b1, b2, id, doc, part``)."""

    def run(batches):
        out = {"a": [], "b": []}
        for g in groups(with_sets(batches), BLOCK):
            doc, part = g.column("doc").to_pylist(), g.column("part").to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in g.column("set").to_pylist()]
            root = {p: p for p in part.tolist()}

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, after in possible([point(s) for s in sets], np.array([len(s) for s in sets])):
                for j in after.tolist():
                    x, y = find(int(part[i])), find(int(part[j]))
                    if x == y:
                        continue
                    a, b = sets[i], sets[j]
                    overlap = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * overlap >= PERCENT * (len(a) + len(b) - overlap) > 0:
                        root[x] = y
                        out["a"].append(doc[i])
                        out["b"].append(doc[j])
            if len(out["a"]) > 50_000:
                yield out
                out = {"a": [], "b": []}
        yield out

    places = tiles(members)
    if within(places, BROADCAST_ROWS):
        places = F.broadcast(places)  # else texts are sent twice
    rows = texts.join(places, "doc").repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    return map_arrow(rows, run, "a long, b long")


def texts_of(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``doc`` and ``text`` of the members, and of a few others whose hash shares a bit of a bitmap, stored.

    So the texts of all other documents are not shuffled.  The bitmap is sized by the number of members.
    """
    size = bits_for(members.count())
    bit = F.pmod(F.xxhash64("doc"), F.lit(2**size)) + 1
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(members.select(bit.alias("b")), size))

    def run(batches):
        table = bits.value
        for b in batches:
            at = b.column("b").to_numpy() - 1
            hit = (table[at >> 3] >> (at & 7)) & 1 == 1
            some = b.filter(pa.array(hit))
            yield {"doc": some.column("doc"), "text": some.column("text")}

    rows = doc_text(docs).filter("doc_id is not null").withColumnRenamed("doc_id", "doc").withColumn("b", bit)
    stored = materialise(map_arrow(rows, run, "doc long, text binary"), "texts")
    bits.destroy()
    return stored


def join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    sets = materialise(sets_of(docs), "sets")
    n_docs = sets.count()
    classes = sets.filter("n_shingles > 0 and doc_id is not null").groupBy("id", "id2", "n_shingles").agg(F.min("doc_id").alias("doc"), F.first("fine").alias("fine"), F.first("point").alias("point"))
    classes = materialise(classes.withColumnRenamed("n_shingles", "n"), "classes")
    found = outermost(blocks_of(docs, frequent_shingles(sets, n_docs)))
    # a member is a class; where two classes share the first digest both are members
    members = materialise(hopeful(found, classes.select("id", "n", "point", "doc")).withColumnRenamed("id", "doc"), "members")
    texts = texts_of(docs, members)

    sizes = members.groupBy("b1", "b2").agg(F.count(F.lit(1)).alias("m"))
    largest = members.join(sizes, ["b1", "b2"]).groupBy("doc").agg(F.max(F.struct("m", "b1", "b2")).alias("x"))
    once = materialise(largest.select("x.b1", "x.b2", F.col("doc").alias("id"), "doc", F.col("doc").alias("part")), "once")
    links = materialise(verified(once, texts), "links")
    labels = components(links)

    part_sizes = labels.groupBy(F.col("component").alias("part")).agg((F.count(F.lit(1)) + 1).alias("part_size"))
    rest = unsettled(members, once, labels).join(classes.select("doc", "n", F.col("fine").alias("point")), "doc").join(part_sizes, "part", "left")
    # stored, as the sizes of blocks and the rows themselves are read from them
    rest = between(materialise(rest.select("b1", "b2", F.col("doc").alias("id"), "n", "point", "part", F.coalesce("part_size", F.lit(1)).alias("part_size"), "home.*"), "open"))
    rest = rest.withColumnRenamed("id", "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
    rest = materialise(rest.select("b1", F.lit(0).cast("long").alias("b2"), F.col("doc").alias("id"), "doc", F.coalesce("component", "doc").alias("part")), "rest")
    more = materialise(verified(rest, texts_of(texts.withColumnRenamed("doc", "doc_id"), rest)), "links")
    final = components(links.unionByName(more))

    keys = ["id", "id2", "n_shingles"]
    rep = sets.select("doc_id", *keys).join(classes.select("id", "id2", F.col("n").alias("n_shingles"), "doc"), keys, "left")
    placed = rep.join(final.withColumnRenamed("node", "doc"), "doc", "left")
    return placed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id")).alias("component_id"))
