"""Prefix trie of conversations, from sorted matrices of turn ids.

Every distinct sequence of first turns is a node.  Texts are hashed where they
are read; from there on a turn is two 64-bit ids and a length, a conversation a
row of them.

1. Conversations are dealt by range of their id sequences (ties by ``conv_id``),
   so a node's members lie next to each other, also across shards, and a group
   of equal conversations may fill many shards.
2. A shard sorts padded matrices of ids, ``WIDTH`` turns at a time, with
   ``numpy.lexsort``; only rows that still tie go on to the next columns, so one
   long conversation does not pad the others.  Column by column a row starts a
   node if it started one before or its id differs from the row above (the mask
   is OR-accumulated), rows that have ended leave, and ``reduceat`` gives each
   node its members.  Sums over subtrees follow from the deepest column up.
3. Only nodes that contain a shard's first or last row can have members in
   another shard: at most two paths a shard.  These leave as partial results,
   are merged by a 128-bit hash of their path, put in order, and finished by
   one pass with a stack; its input is bounded by shards times turns.  The ids of
   conversations that end in a shard's first or last sequence are sent as rows
   and hashed as a stream.

Defined results: turns are ordered by ``turn`` (null first), equal ones by role,
then by the text's SHA-256; null role or text is empty; rows without ``conv_id``
belong to no conversation; repeated rows are repeated turns; an empty table has
no nodes.  A conversation's turns (20 bytes each) are one row.  Only
``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragcube.llm.text import map_arrow
from fragcube.session import lookup_join, materialise, materialise_observed

#: Columns that are sorted at once.
WIDTH = 8
#: Turns in one shard; the number of shards grows with the input.
SHARD_TURNS = 1_000_000

NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = bytes(16)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
DDL = (
    "kind int, key binary, parent_key binary, shard long, row long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string"
)
COMPLETE, EDGE, END = 0, 1, 2


def sequences(conversations: DataFrame) -> DataFrame:
    """Per conversation ``ids`` (two longs a turn, the first not negative) and ``chars`` in order of its turns."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    digest = F.unhex(F.sha2("text", 256))
    rows = rows.select("conv_id", "turn", "role", digest.alias("digest"), F.char_length("text").cast("long").alias("chars"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "chars"))).alias("turns"))
    two = lambda t: F.array(F.shiftrightunsigned(F.xxhash64(t["role"], t["digest"]), 1), F.xxhash64(F.lit(1), t["role"], t["digest"]))
    return turns.select("conv_id", F.flatten(F.transform("turns", two)).alias("ids"), F.transform("turns", lambda t: t["chars"]).alias("chars"))


def with_heads(seqs: DataFrame, heads: DataFrame, base: str, take: str) -> DataFrame:
    """Sequences whose first ``take`` turns are replaced by the first ``take`` of the sequence of conversation ``base``.

    ``base`` and ``take`` are SQL over ``conv_id``; turns of an absent conversation are none.
    """
    own = seqs.select("conv_id", "ids", "chars", F.expr(base).cast("long").alias("base"), F.expr(take).cast("int").alias("take"))
    lent = heads.select(F.col("conv_id").alias("base"), F.col("ids").alias("head_ids"), F.col("chars").alias("head_chars"))
    both = own.join(lent, "base", "left")
    return both.select(
        "conv_id",
        F.expr("concat(slice(coalesce(head_ids, array()), 1, 2 * take), slice(ids, 2 * take + 1, size(ids)))").alias("ids"),
        F.expr("concat(slice(coalesce(head_chars, array()), 1, take), slice(chars, take + 1, size(chars)))").alias("chars"),
    )


def padded(flat: np.ndarray, first: np.ndarray, lens: np.ndarray, rows: np.ndarray, at: int) -> np.ndarray:
    """Ids of turns ``at`` to ``at + WIDTH`` of the rows, -1 beyond a row's end."""
    column = at + np.arange(WIDTH)
    inside = column < lens[rows][:, None]
    place = np.where(inside, first[rows][:, None] + column, 0)
    return np.where(inside[..., None], flat[place], -1).reshape(len(rows), -1)


def lexicographic(flat: np.ndarray, first: np.ndarray, lens: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Order of the rows by their ids, shorter ones first, ties by conversation."""
    order = np.argsort(conv, kind="stable")
    group = np.zeros(len(conv), np.int64)
    todo, at = np.arange(len(conv)), 0
    while len(todo):
        rows = order[todo]
        matrix = padded(flat, first, lens, rows, at)
        k = np.lexsort((*matrix.T[::-1], group[todo]))
        rows, matrix, g = rows[k], matrix[k], group[todo]
        order[todo] = rows
        changed = np.append(True, (matrix[1:] != matrix[:-1]).any(axis=1) | (g[1:] != g[:-1]))
        starts = np.flatnonzero(changed)
        member = np.cumsum(changed) - 1
        group[todo] = todo[starts][member]
        several = np.diff(np.append(starts, len(todo))) > 1
        todo = todo[several[member] & (lens[rows] >= at + WIDTH)]
        at += WIDTH
    return order


def levels(flat: np.ndarray, first: np.ndarray, lens: np.ndarray, chars: np.ndarray, conv: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Nodes of sorted rows by depth; members of a node lie next to each other."""
    out: list[dict[str, np.ndarray]] = []
    rows = np.arange(len(lens))
    mask = np.zeros(len(lens), bool)
    mask[:1] = True
    parent = np.full(1, -1)
    while len(rows):
        starts = np.flatnonzero(mask)
        ended = lens[rows] == len(out)
        node = np.cumsum(mask) - 1
        top = rows[starts]
        out.append({
            "parent": parent,
            "row": top,
            "n": np.diff(np.append(starts, len(rows))),
            "conv": np.minimum.reduceat(conv[rows], starts),
            "ends": np.add.reduceat(ended.astype(np.int64), starts),
            "chars": chars[first[top] + len(out) - 1] if out else np.zeros(1, np.int64),
            "holds_first": rows[starts] == 0,
            "holds_last": rows[np.append(starts[1:], len(rows)) - 1] == len(lens) - 1,
        })
        rows, node = rows[~ended], node[~ended]
        ids = flat[first[rows] + len(out) - 1] if len(rows) else flat[:0]
        mask = np.ones(len(rows), bool)
        mask[1:] = (node[1:] != node[:-1]) | (ids[1:] != ids[:-1]).any(axis=1)
        parent = node[mask]
    return out


def path_keys(ids: np.ndarray) -> list[bytes]:
    """128-bit hash of every prefix of a sequence, the empty one first."""
    keys = [ROOT]
    for turn in ids:
        keys.append(hashlib.sha256(keys[-1] + turn.tobytes()).digest()[:16])
    return keys


def shard_nodes(flat: np.ndarray, first: np.ndarray, lens: np.ndarray, chars: np.ndarray, conv: np.ndarray, shard: int) -> Iterator[dict]:
    """Rows of ``DDL`` for one shard: complete nodes, parts of the nodes at its borders, ends at its borders."""
    flat = np.concatenate([flat.reshape(-1, 2), np.zeros((1, 2), np.int64)])
    chars = np.append(chars, 0)
    order = lexicographic(flat, first, lens, conv)
    first, lens, conv = first[order], lens[order], conv[order]
    depths = levels(flat, first, lens, chars, conv)
    edge_keys = [path_keys(flat[first[i] : first[i] + lens[i]]) for i in (0, -1)]

    below_saved = below_leaves = below_parent = np.zeros(0, np.int64)
    for depth in range(len(depths) - 1, -1, -1):
        level = depths[depth]
        n, edge = level["n"], level["holds_first"] | level["holds_last"]
        lo, hi = (np.searchsorted(below_parent, np.arange(len(n)), side) for side in ("left", "right"))
        inner = lambda x: np.append(0, np.cumsum(x))[hi] - np.append(0, np.cumsum(x))[lo]  # noqa: E731, B023
        level["children"] = inner(level.pop("inner_child", np.zeros(0, np.int64)))
        level["saved"] = inner(below_saved) + np.where(edge, 0, (n - 1) * level["chars"])
        level["leaves"] = inner(below_leaves) + np.where(edge | (level["children"] > 0), 0, 1)
        # what lies on a border is added later, once, from all shards
        below_saved, below_leaves, below_parent = np.where(edge, 0, level["saved"]), np.where(edge, 0, level["leaves"]), level["parent"]
        if depth:
            depths[depth - 1]["inner_child"] = (~edge).astype(np.int64)

    for depth, level in enumerate(depths):
        edge = level["holds_first"] | level["holds_last"]
        key = [edge_keys[0 if f else 1][depth] if e else None for e, f in zip(edge.tolist(), level["holds_first"].tolist())]
        above, parent = (depths[depth - 1], level["parent"]) if depth else (None, None)
        parent_key = [None] if above is None else [above["key"][p] for p in parent.tolist()]
        parent_conv = [None] if above is None else [None if k else c for k, c in zip(parent_key, above["conv"][parent].tolist())]
        at_border = (level["holds_first"] & (lens[0] == depth)) | (level["holds_last"] & (lens[-1] == depth))
        sha, raw = [], {"key": [], "conv_id": []}
        for row, ends, border, k in zip(level["row"].tolist(), level["ends"].tolist(), at_border.tolist(), key):
            ids = conv[row : row + ends]
            if border:
                raw["key"] += [k] * ends
                raw["conv_id"] += ids.tolist()
            sha.append(None if border or (k and not ends) else hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest())
        level["key"] = key
        yield {
            "kind": np.where(edge, EDGE, COMPLETE), "key": key, "parent_key": parent_key, "shard": [shard] * len(key), "row": level["row"],
            "conv_id": level["conv"], "depth": [depth] * len(key), "parent_conv_id": parent_conv, "n_convs": level["n"],
            "n_children": level["children"], "n_leaves": level["leaves"], "saved_tokens": level["saved"], "chars": level["chars"], "ends_sha256": sha,
        }
        if raw["key"]:
            yield {c: raw.get(c, [END if c == "kind" else None] * len(raw["key"])) for c in (f.split()[0] for f in DDL.split(", "))}


def _shards(batches) -> Iterator[dict]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    ids, chars = (np.concatenate([b.column(c).flatten().to_numpy() for b in held]) for c in ("ids", "chars"))
    lens = np.concatenate([b.column("chars").value_lengths().to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
    conv = np.concatenate([b.column("conv_id").to_numpy() for b in held])
    yield from shard_nodes(ids, np.cumsum(lens) - lens, lens, chars, conv, TaskContext.get().partitionId())


def _ends(batches) -> Iterator[dict]:
    """SHA-256 of the ids of each key, as a stream of rows sorted by key and id."""
    last, state = None, None
    for b in batches:
        for key, conv in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
            if key != last:
                if state:
                    yield {"key": [last], "sha": [state.hexdigest()]}
                last, state = key, hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
    if state:
        yield {"key": [last], "sha": [state.hexdigest()]}


def _finish(batches) -> Iterator[dict]:
    """Sums of subtrees for border nodes in order of first row and depth; the stack holds one path."""
    path: list[dict] = []

    def close() -> dict:
        v = path.pop()
        v["saved_tokens"] += (v["n_convs"] - 1) * v["chars"]
        v["n_leaves"] += 0 if v["n_children"] else 1
        if path:
            path[-1]["saved_tokens"] += v["saved_tokens"]
            path[-1]["n_leaves"] += v["n_leaves"]
            v["parent_conv_id"] = path[-1]["conv_id"]
        return {c: [v.get(c)] for c in ("key", *RESULT)}

    for b in batches:
        for v in b.to_pylist():
            while len(path) > v["depth"]:
                yield close()
            if path:
                path[-1]["n_children"] += 1
            path.append(v)
    while path:
        yield close()


def trie(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the sequences (``conv_id``, ``ids``, ``chars``), columns ``RESULT``.

    ``conv_id`` is the smallest member, ``n_leaves`` and ``saved_tokens`` are taken over the node's subtree.
    """
    spark = seqs.sparkSession
    stored, seen = materialise_observed(seqs, "sequences", F.sum(F.size("chars") + 1).alias("turns"))
    shards = max(spark.sparkContext.defaultParallelism, -(-(seen["turns"] or 0) // shard_turns))
    parts = materialise(map_arrow(stored.repartitionByRange(shards, "ids", "conv_id"), _shards, DDL), "nodes")

    merged = parts.filter(f"kind = {EDGE}").groupBy("key").agg(
        F.min(F.struct("shard", "row")).alias("at"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends_sha256").alias("inside"),
    )
    ends = parts.filter(f"kind = {END}").select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    merged = merged.join(map_arrow(ends, _ends, "key binary, sha string"), "key", "left")
    merged = merged.withColumn("ends_sha256", F.coalesce("sha", "inside", F.lit(NO_ENDS)))
    ddl = "key binary, " + ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in RESULT)
    edges = materialise(map_arrow(merged.repartition(1).sortWithinPartitions("at", "depth"), _finish, ddl), "edges")

    inner = parts.filter(f"kind = {COMPLETE}")
    parents = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    under = lookup_join(inner.filter("parent_key is not null"), parents, ["parent_key"], edges.count(), ["conv_id", "depth"])
    under = under.withColumn("parent_conv_id", F.col("above"))
    return inner.filter("parent_key is null").select(RESULT).unionByName(under.select(RESULT)).unionByName(edges.select(RESULT))
