"""Assemble an aggregated variable, select from it and reduce it.

A selection is turned into two predicates: one on the manifest, which leaves
only fragments that intersect it, and one on the cells that remain.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.axis import bound_key, idiv
from ..model import Block, FragmentError, FragmentSet, Manifest
from ..session import BROADCAST_ROWS, literal, lookup_join, within
from . import infer

#: Bytes of one chunk when its size is left to the engine.
TARGET_BYTES = 128 * 1024 * 1024

REDUCERS = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_pop,
    "var": F.var_pop,
}


@dataclass(frozen=True)
class Range:
    """Indices ``start, start+step, ...`` below ``stop``, read from the last one on if ``falling``; ``scalar`` drops the dimension."""

    start: int
    stop: int
    step: int = 1
    scalar: bool = False
    falling: bool = False

    @classmethod
    def over(cls, indices: range, scalar: bool = False) -> "Range":
        if not len(indices):
            return cls(0, 0)
        if indices.step > 0:
            return cls(indices[0], indices[-1] + 1, indices.step, scalar)
        return cls(indices[-1], indices[0] + 1, -indices.step, scalar, True)

    @property
    def indices(self) -> range:
        """In the order of the selection."""
        rising = range(self.start, self.stop, self.step)
        return rising[::-1] if self.falling else rising

    def cells(self, index: str) -> str:
        """Predicate on a global index."""
        inside = f"{index} >= {self.start} and {index} < {self.stop}"
        return inside if self.step == 1 else f"{inside} and pmod({index} - {self.start}, {self.step}) = 0"

    def place(self, index: str) -> str:
        """Where a selected index stands in the selection."""
        last = self.start + (len(self.indices) - 1) * self.step
        return f"({last} - {index}) div {self.step}" if self.falling else f"({index} - {self.start}) div {self.step}"

    def fragments(self, offset: str, size: str) -> str:
        """Predicate on the manifest, exact for steps too: the first wanted index at or after the offset is inside."""
        if self.stop <= self.start:
            return "false"
        overlap = f"{offset} < {self.stop} and {offset} + {size} > {self.start}"
        if self.step == 1:
            return overlap
        at = f"greatest({offset}, {self.start})"
        first = f"({at} + pmod({self.start} - {at}, {self.step}))"
        return f"{overlap} and {first} < {offset} + {size} and {first} < {self.stop}"


@dataclass(frozen=True)
class Points:
    """A list of indices in its own order; an index that comes twice is selected twice."""

    values: tuple[int, ...]
    scalar: bool = False

    @property
    def indices(self) -> tuple[int, ...]:
        return self.values

    @property
    def repeats(self) -> bool:
        return len(set(self.values)) < len(self.values)

    def _distinct(self) -> list[int]:
        return sorted(set(self.values))

    def cells(self, index: str) -> str:
        return f"{index} in ({', '.join(map(str, self._distinct()))})" if self.values else "false"

    def fragments(self, offset: str, size: str) -> str:
        if not self.values:
            return "false"
        listed = ", ".join(f"{v}L" for v in self._distinct())
        return f"{offset} <= {max(self.values)} and exists(array({listed}), i -> i >= {offset} and i < {offset} + {size})"


def picked(kept: range | tuple[int, ...], index: int | slice | list[int]) -> Range | Points:
    """A further selection of indices that are selected so far, by the rules of Python and numpy."""
    if isinstance(index, slice):
        chosen = kept[index]
        return Range.over(chosen) if isinstance(chosen, range) else Points(chosen)
    for i in index if isinstance(index, (list, tuple)) else [index]:
        if not -len(kept) <= i < len(kept):
            raise IndexError(f"index {i} is out of range for size {len(kept)}")
    if isinstance(index, (list, tuple)):
        return Points(tuple(kept[int(i)] for i in index))
    at = kept[int(index)]
    return Range(at, at + 1, 1, True)


@dataclass(frozen=True)
class Variable:
    """A lazy aggregated variable: cells, the fragments that serve it, and a selection.

    ``picks`` are indices.  ``bounds`` are ranges of coordinates where the manifest
    has none to turn them into indices; ``hints`` are those that were turned, kept
    for the scan to skip what lies outside.
    """

    block: Block
    manifest: Manifest
    name: str
    picks: dict[str, Range | Points] = field(default_factory=dict)
    bounds: tuple[tuple[str, object, object], ...] = ()
    hints: tuple[tuple[str, object, object], ...] = ()

    @property
    def shape(self) -> tuple[int, ...]:
        sizes = []
        for dim in self.block.dims:
            pick = self.picks.get(dim)
            if pick is None:
                sizes.append(self.manifest.dim(dim).size)
            elif not pick.scalar:
                sizes.append(len(self._kept(dim)))
        return tuple(sizes)

    def _kept(self, dim: str) -> range | tuple[int, ...]:
        """Indices of the whole axis that are still selected, in order."""
        pick = self.picks.get(dim)
        return range(self.manifest.dim(dim).size) if pick is None else pick.indices

    def _require(self, dim: str) -> None:
        if dim not in self.block.dims or (dim in self.picks and self.picks[dim].scalar):
            raise FragmentError(f"{self.name} has no dimension {dim!r}")

    def isel(self, **indices: int | slice | list[int]) -> "Variable":
        """Select by index, as numpy does: an integer drops the dimension, slices and lists keep their order."""
        picks = dict(self.picks)
        for dim, index in indices.items():
            self._require(dim)
            if any(d == dim for d, _, _ in self.bounds):
                raise FragmentError(f"{dim!r} is selected by coordinate in a manifest without coordinates: its indices are not known")
            picks[dim] = picked(self._kept(dim), index)
        return replace(self, picks=picks)

    def sel(self, method: str | None = None, **values: object) -> "Variable":
        """Select by coordinate: a label, an inclusive ``slice(low, high)`` or the nearest label.

        The coordinate table of the manifest turns a range into a range of indices and
        a label into one index, which drops the dimension; a label that is not
        there is a ``KeyError``.  Ranges also reach the Parquet scan as predicates on the
        stored coordinate.  A manifest without coordinates keeps ranges and labels as
        such predicates alone.
        """
        out = self
        for dim, value in values.items():
            out._require(dim)
            if method not in (None, "nearest"):
                raise FragmentError(f"unknown method {method!r}")
            if method == "nearest":
                row = nearest(self.manifest.coords, dim, value, self._coordinate_type(dim)).first()
                if row is None:
                    raise KeyError(f"{dim} has no coordinate values")
                out = out._at(dim, range(row["idx"], row["idx"] + 1), True, value)
                continue
            low, high = (value.start, value.stop) if isinstance(value, slice) else (value, value)
            if isinstance(value, slice) and value.step is not None:
                raise FragmentError("a range of coordinates has no step")
            if self.manifest.coords is None:
                out = replace(out, bounds=out.bounds + ((dim, low, high),))
                continue
            if self.manifest.dim(dim).descending and low is not None and high is not None and low > high:
                low, high = high, low  # on an axis that falls the greater label may come first
            found = locate(self.manifest, dim, low, high, self._coordinate_type(dim))
            if not isinstance(value, slice) and not len(found):
                raise KeyError(f"{value!r} is not a coordinate of {dim}")
            out = out._at(dim, found, not isinstance(value, slice), value)
            out = replace(out, hints=out.hints + ((dim, low, high),))
        return out

    def _coordinate_type(self, dim: str) -> str:
        return self.manifest.dim(dim).dtype or self.block.dtype(f"c_{dim}")

    def _at(self, dim: str, found: range, scalar: bool, label: object) -> "Variable":
        """The part of what is selected so far that lies in a range of indices of the axis."""
        kept = self._kept(dim)
        if isinstance(kept, range):
            low, high = (found.start, found.stop) if kept.step > 0 else (found.stop - 1, found.start - 1)
            first = max(0, -(-(low - kept.start) // kept.step))
            after = max(first, min(len(kept), -(-(high - kept.start) // kept.step)))
            chosen = kept[first:after]
        else:
            chosen = tuple(i for i in kept if i in found)
        if scalar and not len(chosen):
            raise KeyError(f"{label!r} is not among the selected coordinates of {dim}")
        if scalar:
            pick = Range(chosen[0], chosen[0] + 1, 1, True)
        else:
            pick = Range.over(chosen) if isinstance(chosen, range) else Points(chosen)
        return replace(self, picks=self.picks | {dim: pick})

    def fragments(self) -> DataFrame:
        """Fragments that meet the selection, one per grid position of this variable."""
        frags = self.manifest.frags
        for dim, pick in self.picks.items():
            frags = frags.filter(pick.fragments(f"o_{dim}", f"s_{dim}"))
        for dim, low, high in self.bounds:
            dtype = self.block.dtype(f"c_{dim}")
            low, high = bound_key(low, dtype), bound_key(high, dtype)
            if low is not None:
                frags = frags.filter(f"coalesce(hi_{dim}, {low}D) >= {low}D")
            if high is not None:
                frags = frags.filter(f"coalesce(lo_{dim}, {high}D) <= {high}D")
        lacking = [d for d in self.manifest.agg_dims if d not in self.block.dims]
        return infer.project_grid(frags, list(self.block.dims)) if lacking else frags

    def constants(self, frags: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """Fragments in which this variable has one value, if the manifest names such, and those to be read."""
        own = f"unique_{self.name}"
        if own not in frags.columns:
            return None, frags
        return frags.filter(f"`{own}` is not null"), frags.filter(f"`{own}` is null")

    def _n_fragments(self, frags: DataFrame) -> int:
        """Upper bound of the rows to join; a narrow selection on a huge manifest is probed."""
        bound = self.manifest.n_frags
        if bound > BROADCAST_ROWS and (self.picks or self.bounds) and within(frags, BROADCAST_ROWS):
            return BROADCAST_ROWS
        return bound

    def _cells(self, frags: DataFrame) -> DataFrame:
        """Cells to read; folders named by ``frag_id`` are pruned by Spark, separate files here."""
        if self.block.scan:
            dims = self.block.dims
            ranges = self.bounds + self.hints
            wanted = [*(f"l_{d}" for d in dims), *dict.fromkeys(f"c_{d}" for d, _, _ in ranges), self.name]
            return self.block.scan(frags, wanted, [(f"c_{d}", low, high) for d, low, high in ranges])
        if self.block.reader is None or not (self.picks or self.bounds):
            return self.block.cells
        return infer.cells_of(self.block, frags, self._n_fragments(frags))

    def to_df(self, numbered: bool = False) -> DataFrame:
        """Cells of the selection with global indices ``<dim>`` and the value.

        A cell that is selected twice comes twice.  With ``numbered`` the columns
        ``<dim>`` are places in the selection instead, so they tell its order.  Fragments outside the selection are gone before the join; with
        fragments stored by ``frag_id`` Spark prunes their files at run time.
        """
        dims = list(self.block.dims)
        constant, frags = self.constants(self.fragments())  # the former are made, not read
        cells = self._cells(frags)
        for dim, low, high in self.bounds + self.hints:
            if low is not None:
                cells = cells.filter(F.col(f"c_{dim}") >= F.lit(low))
            if high is not None:
                cells = cells.filter(F.col(f"c_{dim}") <= F.lit(high))
        cells = cells.select("frag_id", *[f"l_{d}" for d in dims], self.name)
        offsets = frags.select("frag_id", *[f"o_{d}" for d in dims])
        spread = [f"l_{d}" for d in dims] or [F.lit(0)]
        placed = lookup_join(cells, offsets, ["frag_id"], self._n_fragments(frags), spread).selectExpr(
            *[f"o_{d} + l_{d} as {d}" for d in dims], self.name
        )
        if constant is not None:
            if self.bounds:
                raise FragmentError(f"{self.name!r} has constant fragments, which hold no coordinates: select their range by index")
            own = f"unique_{self.name}"
            made = fill_unique(constant, dims, own).select(*dims, F.col(own).cast(self.block.dtype(self.name)).alias(self.name))
            placed = placed.unionByName(made)
        for dim, pick in self.picks.items():
            placed = placed.filter(pick.cells(dim))
        kept = [d for d in dims if not (d in self.picks and self.picks[d].scalar)]
        for dim in kept:
            pick = self.picks.get(dim)
            if isinstance(pick, Points) and (numbered or pick.repeats):
                # the selection as a table: an index and where it stands, once for each time that it is listed
                rows = literal(placed.sparkSession, [(v, i) for i, v in enumerate(pick.values)], f"`{dim}` long, `_place` long")
                placed = placed.join(F.broadcast(rows), dim)  # as long as the list that was given
                placed = placed.withColumn(dim, F.col("_place")).drop("_place") if numbered else placed.drop("_place")
            elif numbered and isinstance(pick, Range):
                placed = placed.withColumn(dim, F.expr(pick.place(f"`{dim}`")))
        return placed.select(*kept, self.name)

    def reduce(self, how: str | list[str], *over: str) -> DataFrame:
        """Reduce over the named dimensions, or over all of them."""
        return reduce_cells(self.to_df(), self.name, how, list(over))


def open_variable(fragments: FragmentSet, manifest: Manifest, name: str) -> Variable:
    """One aggregated variable as a lazy array."""
    return Variable(fragments.block_of(name), manifest, name)


def reduce_cells(cells: DataFrame, value: str, how: str | list[str], over: list[str]) -> DataFrame:
    """Aggregate out some dimensions; missing values (NULL or NaN) are skipped.

    Several reductions at once share one pass and one shuffle of partial results.
    """
    hows = [how] if isinstance(how, str) else how
    unknown = [h for h in hows if h not in REDUCERS]
    if unknown:
        raise FragmentError(f"unknown reduction {unknown}")
    dims = [c for c in cells.columns if c != value]
    absent = set(over) - set(dims)
    if absent:
        raise FragmentError(f"no dimension {sorted(absent)} to reduce over")
    keep = [d for d in dims if d not in over] if over else []
    present = F.col(value)
    if cells.schema[value].dataType.simpleString() in ("double", "float"):
        present = F.when(~F.isnan(present), present)
    return cells.groupBy(*keep).agg(*[REDUCERS[h](present).alias(f"{value}_{h}") for h in hows])


def nearest(coords: DataFrame, dim: str, value: object, dtype: str = "") -> DataFrame:
    """Index whose coordinate (a number, date or time) is closest; the lower index wins a tie."""
    key = bound_key(value, dtype)
    if key is None:
        raise FragmentError(f"there is no nearest coordinate to {value!r} on {dim}")
    gap = F.abs(F.col("value") - F.lit(key))
    best = coords.filter((F.col("dim") == dim) & F.col("value").isNotNull()).agg(
        F.min(F.struct(gap.alias("gap"), "idx", "value")).alias("b")
    )
    return best.filter("b is not null").select(F.col("b.idx").alias("idx"), F.col("b.value").alias("value"))


def locate(manifest: Manifest, dim: str, low: object, high: object, dtype: str) -> range:
    """Indices of an axis whose coordinates lie from ``low`` to ``high``; either may be None.

    Coordinates rise or fall all along an axis, so these are a range.  The ranges of
    the pieces, which the manifest's ``frags`` hold, come first: only coordinates of pieces
    that meet the wanted range are looked at.
    """
    text = dtype == "string"
    ends = [v if text or v is None else bound_key(v, dtype) for v in (low, high)]
    if any(v is not None and (e is None or isinstance(v, str) != text) for v, e in zip((low, high), ends)):
        raise KeyError(f"coordinates of {dim} are of type {dtype}")
    mark, column = ("_s", "value_s") if text else ("", "value")
    pieces, rows = manifest.frags, manifest.coords.filter(F.col("dim") == dim)
    for end, side, compare in ((ends[0], "hi", "__ge__"), (ends[1], "lo", "__le__")):
        if end is not None:
            rows = rows.filter(getattr(F.col(column), compare)(F.lit(end)))
            if f"{side}{mark}_{dim}" in pieces.columns:
                pieces = pieces.filter(getattr(F.col(f"{side}{mark}_{dim}"), compare)(F.lit(end)))
    span = pieces.agg(F.min(f"o_{dim}").alias("first"), F.max(F.col(f"o_{dim}") + F.col(f"s_{dim}")).alias("after")).first()
    if span["first"] is None:
        return range(0)
    found = rows.filter(F.col("idx").between(span["first"], span["after"] - 1)).agg(F.min("idx").alias("first"), F.max("idx").alias("last")).first()
    return range(0) if found["first"] is None else range(found["first"], found["last"] + 1)


def chunk_extents(frags: DataFrame, dims: list[str], chunks: dict[str, int]) -> DataFrame:
    """Chunks of every fragment: position inside it, global start and stop.

    A chunk stays inside its fragment and the last one takes the remainder; a
    dimension without a chunk size is kept whole.
    """
    out = frags
    for dim in dims:
        step = F.lit(chunks[dim]).cast("long") if dim in chunks else F.col(f"s_{dim}")
        out = (
            out.withColumn(f"_k_{dim}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"s_{dim}") - 1, step)))
            .withColumn(f"k_{dim}", idiv(F.col(f"_k_{dim}"), step))
            .withColumn(f"start_{dim}", F.col(f"o_{dim}") + F.col(f"_k_{dim}"))
            .withColumn(
                f"stop_{dim}", F.col(f"o_{dim}") + F.least(F.col(f"_k_{dim}") + step, F.col(f"s_{dim}"))
            )
        )
    cols = [c for d in dims for c in (f"k_{d}", f"start_{d}", f"stop_{d}")]
    return out.select("frag_id", *cols)


def chunk_positions(block: Block, chunks: dict[str, int]) -> list[Column]:
    """Chunk number of a cell inside its fragment, per dimension."""
    return [
        (idiv(F.col(f"l_{d}"), chunks[d]) if d in chunks else F.lit(0).cast("long")).alias(f"k_{d}")
        for d in block.dims
    ]


def rechunk(block: Block, chunks: dict[str, int], partitions: int | None = None) -> DataFrame:
    """Cells tagged with their chunk and partitioned by it.

    The chunk is part of the partitioning key, so a huge fragment spreads over
    as many tasks as it has chunks.
    """
    tagged = block.cells.select("*", *chunk_positions(block, chunks))
    keys = ["frag_id", *[f"k_{d}" for d in block.dims]]
    return tagged.repartition(partitions, *keys) if partitions else tagged.repartition(*keys)


def pack_chunks(block: Block, var: str, chunks: dict[str, int]) -> DataFrame:
    """One row per chunk: its place, its shape and its values in row-major order.

    Every dimension needs a chunk size, which bounds the array of a row.
    """
    whole = [d for d in block.dims if d not in chunks]
    if whole:
        raise FragmentError(f"no chunk size for {whole}")
    inner = [F.expr(f"pmod(l_{d}, {chunks[d]}) as i_{d}") for d in block.dims]
    tagged = block.cells.select("frag_id", *chunk_positions(block, chunks), *inner, F.col(var).alias("_value"))
    place = ", ".join(f"i_{d}" for d in block.dims)
    sizes = [F.expr(f"max(i_{d}) + 1 as _n_{d}") for d in block.dims]
    rows = tagged.groupBy("frag_id", *[f"k_{d}" for d in block.dims]).agg(
        F.expr(f"sort_array(collect_list(struct({place}, _value))) as _cells"), *sizes
    )
    return rows.select(
        "frag_id", *[f"k_{d}" for d in block.dims], F.array(*[f"_n_{d}" for d in block.dims]).alias("shape"),
        F.expr("transform(_cells, c -> c._value)").alias("data"),
    )


def unpack_chunks(rows: DataFrame, dims: list[str], var: str, chunks: dict[str, int]) -> DataFrame:
    """Cells of packed chunks, with their indices inside the fragment; no shuffle."""
    keys = ["frag_id", *[f"k_{d}" for d in dims], "shape"]
    cells = rows.select(*keys, F.posexplode("data").alias("_rest", var))
    for i in reversed(range(len(dims))):
        cells = cells.selectExpr(
            *[c for c in cells.columns if c != "_rest"],
            f"k_{dims[i]} * {chunks[dims[i]]} + pmod(_rest, shape[{i}]) as l_{dims[i]}", f"_rest div shape[{i}] as _rest",
        )
    return cells.select("frag_id", *[f"l_{d}" for d in dims], var)


def chunk_count(cells: Column, itemsize: int, target_bytes: int) -> Column:
    """Chunks needed to keep each below a number of bytes."""
    return F.ceil(cells * F.lit(itemsize) / F.lit(target_bytes))


def optimal_chunk_size(size: Column, count: Column) -> Column:
    """Chunk size that brings the number of chunks to a power of two (halves round to even)."""
    power = F.bround(F.log2(F.greatest(count, F.lit(1)).cast("double")))
    return F.greatest(F.bround(size / F.pow(F.lit(2.0), power)).cast("long"), F.lit(1).cast("long"))


def flat_index(dims: list[str], shape: list[int]) -> Column:
    """Row-major position of a cell."""
    total = F.lit(0).cast("long")
    for dim, size in zip(dims, shape):
        total = total * F.lit(size) + F.col(dim)
    return total


def reshape(cells: DataFrame, dims: list[str], shape: list[int], new: dict[str, int]) -> DataFrame:
    """Row-major reshape; only index arithmetic, no shuffle."""
    old_total, new_total = 1, 1
    for size in shape:
        old_total *= size
    for size in new.values():
        new_total *= size
    if old_total != new_total:
        raise FragmentError(f"cannot reshape {old_total} cells into {new_total}")
    rest = [c for c in cells.columns if c not in dims]
    flat = cells.withColumn("_flat", flat_index(dims, shape))
    cols, stride = [], new_total
    for dim, size in new.items():
        stride //= size
        cols.append(F.pmod(idiv(F.col("_flat"), stride), F.lit(size)).cast("long").alias(dim))
    return flat.select(*cols, *rest)


def fill_unique(frags: DataFrame, dims: list[str], value: str, piece: int = 65_536) -> DataFrame:
    """Cells of fragments that hold one value each, without reading any data.

    A fragment is first cut into pieces of about ``piece`` cells, which are
    spread over the tasks, so one large fragment is not expanded by one task.
    """
    step = F.lit(max(1, round(piece ** (1 / max(len(dims), 1))))).cast("long")
    out = frags.select(value, *[c for d in dims for c in (f"o_{d}", f"s_{d}")])
    for dim in dims:
        out = out.withColumn(f"_{dim}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"s_{dim}") - 1, step)))
    out = out.repartition(*[c for d in dims for c in (f"o_{d}", f"_{d}")])
    for dim in dims:
        last = F.least(F.col(f"_{dim}") + step, F.col(f"s_{dim}")) - 1
        out = out.withColumn(dim, F.explode(F.sequence(F.col(f"o_{dim}") + F.col(f"_{dim}"), F.col(f"o_{dim}") + last)))
    return out.select(*dims, value)
