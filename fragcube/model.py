"""Logical model: fragments as rows with local indices, manifests as tables.

Column names of a block of cells

* ``frag_id``  fragment the cell belongs to,
* ``file_ord`` position of the fragment in the list of inputs,
* ``l_<dim>``  index of the cell *inside* its fragment,
* ``c_<dim>``  coordinate value (only dimensions that have one),
* one column per variable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

#: Stands in for an attribute that differs between fragments (a fixed value).
DIFFERS = "See individual datasets for more information."


class FragmentError(ValueError):
    """The fragments or the manifest break a rule of the data model."""


@dataclass(frozen=True)
class Block:
    """Variables that share one tuple of dimensions.

    ``reader`` reads the cells of some fragments by name, where each fragment
    is a file of its own.  ``scan`` reads the given columns of the fragments in a table
    of the manifest, within bounds (column, low, high); its block has a schema and no
    cells.
    """

    dims: tuple[str, ...]
    coords: tuple[str, ...]
    vars: tuple[str, ...]
    cells: DataFrame
    reader: Callable[[list[str]], DataFrame] | None = None
    scan: Callable[[DataFrame, list[str], list[tuple]], DataFrame] | None = None

    def dtype(self, column: str) -> str:
        return self.cells.schema[column].dataType.simpleString()


@dataclass(frozen=True)
class FragmentSet:
    """Everything known about a set of fragments before aggregation."""

    blocks: tuple[Block, ...]
    attrs: DataFrame | None = None
    uris: DataFrame | None = None
    identifiers: dict[str, str] = field(default_factory=dict)

    @property
    def dims(self) -> list[str]:
        seen: dict[str, None] = {}
        for block in self.blocks:
            seen.update(dict.fromkeys(block.dims))
        return list(seen)

    @property
    def coords(self) -> set[str]:
        return {dim for block in self.blocks for dim in block.coords}

    def block_of(self, var: str) -> Block:
        for block in self.blocks:
            if var in block.vars:
                return block
        raise FragmentError(f"no variable named {var!r}")


@dataclass(frozen=True)
class DimClass:
    """How the starts of the fragments vary along one dimension.

    ``even`` is false when an unfragmented axis differs in size or last value.
    """

    dim: str
    dim_ord: int
    kind: str
    aggregated: bool
    descending: bool
    largest: int
    even: bool


@dataclass(frozen=True)
class DimInfo:
    """One row of ``dims``; there are only a handful of dimensions.

    ``dtype`` is the type of the coordinate, empty where there is none or it is not known.
    """

    dim: str
    dim_ord: int
    kind: str
    size: int
    f_size: int
    descending: bool
    dtype: str = ""


@dataclass(frozen=True)
class Manifest:
    """The aggregation: small tables that place fragments in the whole grid.

    ``inventory`` is what the scan of the cells left behind, a row per fragment.
    It and ``frags`` may name the fragment's ``uris`` (alternative locations) or give
    the one value ``unique_<var>`` that a variable has all over the fragment.
    ``frags`` has one row per fragment with ``f_<dim>`` (grid position),
    ``o_<dim>`` (offset in the whole array) and ``s_<dim>`` (size); it holds at
    most ``n_frags`` rows.
    """

    dims: tuple[DimInfo, ...]
    inventory: DataFrame
    dim_frags: DataFrame
    frags: DataFrame
    vars: DataFrame
    attrs: DataFrame | None
    coords: DataFrame | None
    n_frags: int

    def dim(self, name: str) -> DimInfo:
        for info in self.dims:
            if info.dim == name:
                return info
        raise FragmentError(f"no dimension named {name!r}")

    @property
    def agg_dims(self) -> list[str]:
        return [d.dim for d in self.dims if d.f_size > 1]

    @property
    def coord_dims(self) -> list[str]:
        return [d.dim for d in self.dims if d.kind != "pure"]

    @property
    def pure_dims(self) -> list[str]:
        return [d.dim for d in self.dims if d.kind == "pure"]
