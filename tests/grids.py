"""Small numpy cubes cut into fragments at arbitrary places."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd

from fragcube.model import Block, FragmentSet


def cut_points(rng: np.random.Generator, size: int, pieces: int) -> list[int]:
    inner = sorted(rng.choice(np.arange(1, size), size=min(pieces - 1, size - 1), replace=False).tolist())
    return [0, *inner, size]


def fragments_of(spark, array, dims, cuts, coords=None, seed=0, drop=(), var="v", mixed=None):
    """Cut ``array`` at ``cuts[dim]``; files come in random order. ``drop`` leaves fragments out."""
    rng = np.random.default_rng(seed)
    coords = {d: np.arange(n, dtype=float) for d, n in zip(dims, array.shape)} if coords is None else coords
    spans = [list(zip(cuts[d][:-1], cuts[d][1:])) for d in dims]
    order = rng.permutation(len(list(itertools.product(*spans))))
    parts = []
    for number, span in enumerate(itertools.product(*spans)):
        if number in drop:
            continue
        index = np.indices([b - a for a, b in span]).reshape(len(dims), -1)
        part = {"frag_id": f"f{number}", "file_ord": int(order[number])}
        for dim, local, (a, b) in zip(dims, index, span):
            part[f"l_{dim}"] = local
            if dim in coords:
                part[f"c_{dim}"] = np.asarray(coords[dim])[local + a]
        part[var] = array[tuple(slice(a, b) for a, b in span)].ravel()
        parts.append(pd.DataFrame(part))
    cells = spark.createDataFrame(pd.concat(parts).sample(frac=1, random_state=seed))
    return FragmentSet((Block(tuple(dims), tuple(d for d in dims if d in coords), (var,), cells),))


def to_array(df, dims, shape, var="v"):
    """Cells as an array; every cell must appear exactly once."""
    pdf = df.toPandas()
    assert len(pdf) == int(np.prod(shape)), (len(pdf), shape)
    assert not pdf.duplicated(list(dims)).any()
    out = np.full(shape, np.nan)
    out[tuple(pdf[d].to_numpy() for d in dims)] = pdf[var].to_numpy(dtype=float)
    return out
