"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of length one whose cosine is at least ``t`` lie within a squared
distance of ``2 - 2 t``.  They are rotated to principal directions, which are dealt
to blocks of ``BLOCK`` dimensions; each block gets a part of the squared distance in
proportion to its variance, so a pair within the whole distance is within the
part of at least one block.

1. Equal vectors become one class, weighted by their number.
2. Coordinates are rounded to a byte each.  All distances below are between these
   codes, in integers, with the largest rounding error added to the distance, so
   every task comes to the same decision and no pair is lost.
3. Range join per block: the two leading coordinates fall into cells of twice the
   block's radius; a row is also sent to those later neighbour cells that its
   radius reaches, so each pair of a block meets once.  Cells of more than ``TILE``
   rows become pairs of tiles.
4. A candidate counts in the first block whose part it keeps, hence once in all.
   If the codes with their known errors prove it similar or not, that decides.
   The rest is sent as pairs and compared by the cosine of the vectors in doubles.
5. Tasks return the number of links per class and the links that connect what
   they found connected, not all pairs; components by alternating stars.

The leading cells prune where data spread widely in few directions.  For
directions that are all alike, at this distance no exact index prunes much: the
number of compared pairs is then quadratic in the rows, and so is what large
cells send (each row to every tile of its cell).

Defined results: null vectors, zero ones and those with null or non-finite
components link with nothing and are their own component; a shorter vector counts
as if it ended in zeros; rows repeating a ``vec_id`` are vectors of their own; a
null ``vec_id`` is never a component's name unless it has no other; an empty table
gives no rows.  Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from fragcube.llm.components import components
from fragcube.llm.jaccard import groups
from fragcube.llm.text import map_arrow
from fragcube.session import lookup_join, materialise, materialise_observed

THRESHOLD = 0.9
#: Dimensions of a block.
BLOCK = 16
#: Rows of a cell that one task compares with each other.
TILE = 32_768
#: Vectors that the rotation is fitted to, those with the smallest digests; any rotation gives the same result.
SAMPLE = 4096
#: Rows and columns compared at a time, so that the distances stay in the cache.
CHUNK, COLUMNS = 256, 2048
#: Slack for the rounding of distances in doubles.
SLACK = 1e-6
#: Neighbour cells that come after a cell.
LATER = [(1, 0), (-1, 1), (0, 1), (1, 1)]


def _matrix(vectors: list[bytes | None], dtype: np.dtype, dims: int) -> np.ndarray:
    """Rows of doubles, filled up with zeros."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        x = np.frombuffer(v, dtype)
        out[i, : len(x)] = x
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def as_bytes(embeddings: DataFrame, dtype: np.dtype) -> DataFrame:
    """``vec_id`` and the vector as bytes, null where it can link with nothing."""

    def run(batches):
        for b in batches:
            lists = b.column("embedding")
            out: list[bytes | None] = []
            for one in lists:
                x = None if not one.is_valid else one.values
                if x is None or x.null_count:
                    out.append(None)
                    continue
                v = x.to_numpy(zero_copy_only=False)
                out.append(v.astype(dtype).tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
            yield {"vec_id": b.column("vec_id"), "vector": out}

    kind = "float" if dtype == np.float32 else "double"
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    return map_arrow(rows, run, "vec_id long, vector binary")


class Subspaces:
    """Rotation, blocks and their parts of the distance, fitted to a sample."""

    def __init__(self, sample: np.ndarray, threshold: float, block: int = BLOCK) -> None:
        dims = sample.shape[1]
        spread, axes = np.linalg.eigh(sample.T @ sample / len(sample))
        order = np.argsort(-spread, kind="stable")
        self.parts = -(-dims // block)
        self.width = -(-dims // self.parts)
        # directions are dealt in turn, so every block leads with wide ones
        place = np.array([(k % self.parts) * self.width + k // self.parts for k in range(dims)])
        self.rotation = np.zeros((dims, self.parts * self.width))
        self.rotation[:, place] = axes[:, order]
        variance = np.zeros(self.parts * self.width)
        variance[place] = np.maximum(spread[order], 0)
        by_block = variance.reshape(self.parts, -1).sum(axis=1)
        self.limit = np.sqrt(2 - 2 * threshold)
        self.scale = 127 / min(1.0, 5 * float(np.sqrt(variance.max())))
        rounding = np.sqrt(dims) / 2 / self.scale
        self.most = ((self.limit + 2 * rounding + SLACK) * self.scale) ** 2
        self.budgets = np.floor(self.most * (by_block / by_block.sum())).astype(np.float32)  # distances are whole numbers

    def codes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (clipped, which only lessens distances) and how far each is from its vector."""
        exact = unit @ self.rotation * self.scale
        codes = np.clip(np.rint(exact), -127, 127)
        return codes.astype(np.int8), np.sqrt(((exact - codes) ** 2).sum(axis=1)) / self.scale + SLACK

    def cells(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, bool]]:
        """Rows, block, cell number and whether the cell is the row's own."""
        every = np.arange(len(codes))
        for block in range(self.parts):
            lead = codes[:, block * self.width : block * self.width + 2].astype(np.int64)
            if lead.shape[1] < 2:
                lead = np.concatenate([lead, np.zeros((len(lead), 2 - lead.shape[1]), np.int64)], axis=1)
            side = max(1, int(np.ceil(2 * np.sqrt(self.budgets[block]))))
            own = lead // side
            yield every, block, _number(own), True
            for step in LATER:
                low = (own + step) * side
                apart = np.maximum(np.maximum(low - lead, lead - (low + side - 1)), 0)
                near = np.flatnonzero((apart**2).sum(axis=1) <= self.budgets[block])
                yield near, block, _number(own[near] + step), False


def _number(cell: np.ndarray) -> np.ndarray:
    return (cell[:, 0] + 1024) * 4096 + cell[:, 1] + 1024


class Forest:
    """Which of some rows are connected so far."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def of(self, rows: np.ndarray) -> np.ndarray:
        r = self.root[rows]
        while True:
            above = self.root[r]
            if np.array_equal(above, r):
                return r
            r = above

    def joined(self, row: int, others: np.ndarray) -> list[int]:
        """Joins ``row`` with the others; one of the others per tree that was apart from it."""
        roots, first = np.unique(self.of(others), return_index=True)
        own = int(self.of(np.array([row]))[0])
        apart = roots != own
        self.root[roots[apart]] = own
        return others[first[apart]].tolist()


class Rows:
    """Some rows of a cell, with all that comparing needs."""

    def __init__(self, space: Subspaces, ids, weights, errors, codes) -> None:
        self.ids, self.weights, self.errors = ids, weights, errors
        self.values = codes.astype(np.float32).reshape(len(ids), space.parts, space.width)
        self.squares = (self.values * self.values).sum(axis=2)

    def left(self, block: int) -> np.ndarray:
        """Together with :meth:`right`, a product that is the squared distance in a block."""
        ones = np.ones((len(self.ids), 1), np.float32)
        return np.concatenate([-2 * self.values[:, block], self.squares[:, block, None], ones], axis=1)

    def right(self, block: int) -> np.ndarray:
        ones = np.ones((len(self.ids), 1), np.float32)
        return np.concatenate([self.values[:, block], ones, self.squares[:, block, None]], axis=1)


class Comparison:
    """What comparing rows of a cell finds."""

    def __init__(self, space: Subspaces, block: int, rows: Rows) -> None:
        self.space, self.block, self.rows = space, block, rows
        self.found = np.zeros(len(rows.ids), np.int64)
        self.links: list[tuple[int, int]] = []
        self.open: list[tuple[int, int]] = []
        self.forest = Forest(len(rows.ids))
        self.lefts, self.rights = {}, {}

    def distances(self, block: int, some: slice, others: slice) -> np.ndarray:
        if block not in self.lefts:
            self.lefts[block], self.rights[block] = self.rows.left(block), self.rows.right(block)
        return self.lefts[block][some] @ self.rights[block][others].T

    def all_pairs(self, some: slice, others: slice | None) -> None:
        """Compares ``some`` rows with ``others``, or with each other."""
        for lo in range(some.start, some.stop, CHUNK):
            part = slice(lo, min(some.stop, lo + CHUNK))
            start, stop = (others.start, others.stop) if others else (lo, some.stop)
            for at in range(start, stop, COLUMNS):
                self._part(part, slice(at, min(stop, at + COLUMNS)), others is None and at == lo)

    def _part(self, part: slice, others: slice, own: bool) -> None:
        space, block, rows = self.space, self.block, self.rows
        hit = self.distances(block, part, others) <= space.budgets[block]
        if own:  # each pair once: the later row is the column
            width = part.stop - part.start
            hit[:, :width] &= np.tri(width, k=-1, dtype=bool).T
        n = np.count_nonzero(hit)
        if not n:
            return
        if n > 0.02 * hit.size:
            whole = np.zeros(hit.shape)
            for k in range(space.parts):
                d = self.distances(k, part, others)
                whole += d
                if k < block:
                    hit &= d > space.budgets[k]
            i, j = np.nonzero(hit & (whole <= space.most))
            total = whole[i, j]
            i, j = i + part.start, j + others.start
        else:
            i, j = np.divmod(np.flatnonzero(hit), hit.shape[1])
            i, j = i + part.start, j + others.start
            apart = ((rows.values[i] - rows.values[j]) ** 2).sum(axis=2, dtype=np.float64)
            total = apart.sum(axis=1)
            keep = (total <= space.most) & (apart[:, :block] > space.budgets[:block]).all(axis=1)
            i, j, total = i[keep], j[keep], total[keep]
        distance, unsure = np.sqrt(total) / space.scale, rows.errors[i] + rows.errors[j]
        sure = distance + unsure < space.limit - SLACK
        check = ~sure & (distance - unsure <= space.limit + SLACK)
        self.open += zip(rows.ids[i[check]].tolist(), rows.ids[j[check]].tolist())
        i, j = i[sure], j[sure]
        np.add.at(self.found, i, rows.weights[j])
        np.add.at(self.found, j, rows.weights[i])
        starts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else []
        for a, b in zip(starts, [*starts[1:], len(i)]):
            self.links += [(int(rows.ids[i[a]]), int(rows.ids[k])) for k in self.forest.joined(int(i[a]), j[a:b])]


def compare(space: Subspaces, block: int, cross: bool, ids, weights, errors, home, tile, codes) -> tuple[np.ndarray, list, list]:
    """Weights of links per row, connecting links, and pairs left to compare, of one tile or a pair of tiles."""
    order = np.lexsort((ids, ~home, tile if cross else np.zeros(len(ids))))
    found = Comparison(space, block, Rows(space, ids[order], weights[order], errors[order], codes[order]))
    first = int((tile == tile.min()).sum()) if cross else len(ids)
    homes = int(home[order][:first].sum())
    if cross:  # own rows of either tile with all of the other, but not two visitors
        end = first + int(home[order][first:].sum())
        found.all_pairs(slice(0, homes), slice(first, len(ids)))
        found.all_pairs(slice(homes, first), slice(first, end))
    else:
        found.all_pairs(slice(0, homes), None)
        found.all_pairs(slice(0, homes), slice(homes, first))
    back = np.empty(len(ids), np.int64)
    back[order] = found.found
    return back, found.links, found.open


CELL = ("block", "cell", "pair")


def found_in_cells(codes: DataFrame, space: Subspaces, tile: int) -> DataFrame:
    """Rows (``a``, null, weight of links), (``a``, ``b``, 1) for links and (``a``, ``b``, 0) for pairs to compare.

    ``codes``: ``id``, ``weight``, ``error``, ``code``.
    """
    shared = codes.sparkSession.sparkContext.broadcast(space)  # a matrix of dims x dims

    def sizes(batches):
        own = shared.value
        for b in batches:
            for rows, block, cell, _ in own.cells(_codes(b)):
                cells, n = np.unique(cell[: len(rows)], return_counts=True)
                yield {"block": np.full(len(cells), block, np.int32), "cell": cells, "n": n}

    def send(batches):
        own = shared.value
        for b in batches:
            for rows, block, cell, home in own.cells(_codes(b)):
                some = b.take(pa.array(rows))
                yield {
                    "block": np.full(len(rows), block, np.int32), "cell": cell, "home": np.full(len(rows), home),
                    **{c: some.column(c) for c in ("id", "weight", "error", "code")},
                }

    def run(batches):
        own = shared.value
        for g in groups(batches, CELL):
            values = {c: g.column(c).combine_chunks() for c in ("id", "weight", "error", "home", "tile")}
            block, pair, parts = (g.column(c)[0].as_py() for c in ("block", "pair", "parts"))
            arrays = {c: v.to_numpy(zero_copy_only=False) for c, v in values.items()}
            n, links, checks = compare(
                own, block, pair // parts != pair % parts, arrays["id"], arrays["weight"], arrays["error"], arrays["home"], arrays["tile"], _codes(g),
            )
            some = n > 0
            k, c = len(links), len(checks)
            both = links + checks
            yield {
                "a": np.concatenate([arrays["id"][some], np.array([a for a, _ in both], np.int64)]),
                "b": [None] * int(some.sum()) + [b for _, b in both],
                "n": np.concatenate([n[some], np.ones(k, np.int64), np.zeros(c, np.int64)]),
            }

    counted = map_arrow(codes.select("code"), sizes, "block int, cell long, n long").groupBy("block", "cell").agg(F.sum("n").alias("n"))
    large = materialise(counted.filter(F.col("n") > tile).select("block", "cell", F.ceil(F.col("n") / tile).cast("int").alias("parts")), "cells")
    ddl = "block int, cell long, home boolean, id long, weight long, error float, code binary"
    rows = lookup_join(map_arrow(codes, send, ddl), large, ["block", "cell"], large.count(), ["id"], "left")
    rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    rows = rows.withColumn("pair", F.least("tile", "other").cast("long") * F.col("parts") + F.greatest("tile", "other")).drop("other")
    rows = rows.repartition(*CELL).sortWithinPartitions(*CELL)
    return map_arrow(rows, run, "a long, b long, n long")


def _codes(table: pa.RecordBatch | pa.Table) -> np.ndarray:
    column = table.column("code").to_pylist()
    return np.frombuffer(b"".join(column), np.int8).reshape(len(column), -1) if column else np.zeros((0, 1), np.int8)


def similar(pairs: DataFrame, classes: DataFrame, dtype: np.dtype, dims: int, threshold: float) -> DataFrame:
    """Of pairs ``a``, ``b`` those whose vectors have the cosine."""

    def run(batches):
        for b in batches:
            x, y = (_unit(_matrix(b.column(c).to_pylist(), dtype, dims)) for c in ("x", "y"))
            near = pa.array((x * y).sum(axis=1) >= threshold)
            kept = b.filter(near)
            yield {c: kept.column(c) for c in ("a", "b", "wa", "wb")}

    for end, vector, weight in (("a", "x", "wa"), ("b", "y", "wb")):
        pairs = pairs.join(classes.select(F.col("id").alias(end), F.col("vector").alias(vector), F.col("weight").alias(weight)), end)
    return map_arrow(pairs.select("a", "b", "x", "y", "wa", "wb"), run, "a long, b long, wa long, wb long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Per row ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    field = embeddings.schema["embedding"].dataType
    dtype = np.dtype(np.float32 if isinstance(field, ArrayType) and isinstance(field.elementType, FloatType) else np.float64)
    rows = materialise(as_bytes(embeddings, dtype).withColumn("digest", F.unhex(F.sha2("vector", 256))), "vectors")
    grouped = rows.filter("vector is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    classes, seen = materialise_observed(grouped.withColumn("id", F.monotonically_increasing_id()), "classes", F.max(F.length("vector")).alias("bytes"), F.count(F.lit(1)).alias("n"))
    alone = rows.filter("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not seen["n"]:
        return alone
    dims = seen["bytes"] // dtype.itemsize
    sample = classes.select("digest", "vector").orderBy("digest").limit(SAMPLE).select("vector").toArrow()  # bounded by the limit
    space = Subspaces(_unit(_matrix(sample.column("vector").to_pylist(), dtype, dims)), threshold, block)
    shared = embeddings.sparkSession.sparkContext.broadcast(space)

    def encode(batches):
        for b in batches:
            codes, errors = shared.value.codes(_unit(_matrix(b.column("vector").to_pylist(), dtype, dims)))
            yield {"id": b.column("id"), "weight": b.column("weight"), "error": np.nextafter(errors.astype(np.float32), np.float32(9)), "code": [c.tobytes() for c in codes]}

    codes = materialise(map_arrow(classes.select("id", "weight", "vector"), encode, "id long, weight long, error float, code binary"), "codes")
    found = materialise(found_in_cells(codes, space, tile), "found")
    checked = materialise(similar(found.filter("b is not null and n = 0").select("a", "b"), classes, dtype, dims, threshold), "checked")
    labels = components(found.filter("b is not null and n = 1").select("a", "b").unionByName(checked.select("a", "b")))

    counts = found.filter("b is null").select(F.col("a").alias("id"), "n")
    counts = counts.unionByName(checked.select(F.col("a").alias("id"), F.col("wb").alias("n"))).unionByName(checked.select(F.col("b").alias("id"), F.col("wa").alias("n")))
    placed = classes.select("id", "digest", "weight", "least").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = materialise(placed.join(counts.groupBy("id").agg(F.sum("n").alias("n")), "id", "left"), "placed")
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "component").select("digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    linked = lookup_join(rows.filter("vector is not null").select("vec_id", "digest"), named, ["digest"], seen["n"], ["vec_id"])
    linked = linked.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.unionByName(alone)
