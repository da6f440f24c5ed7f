"""Periodic runs, conversation tries and near-duplicate vectors against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StringType, StructField, StructType

from fragcube.llm import periods, tries, vectors
from fragcube.llm.queries import QUERIES

# --- periodic runs


def runs_by_hand(words):
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            smaller = any(q % d == 0 and words[start : end - d] == words[start + d : end] for d in range(1, q))
            if end - start >= max(12, 2 * q) and not smaller:
                found.append((start, end - start, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_sequences(seed):
    rng = random.Random(seed)
    finder = periods.Finder()
    for _ in range(8):
        texts = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.choice([0, 1, 11, 12, 13, 90, 500]))]
            for _ in range(rng.randint(0, 3)):
                q = rng.choice([1, 2, 3, 4, 5, 7, 8, 16, 33, 64, 130, 150, 260])
                block = [rng.randrange(900) for _ in range(q)]
                words += [block[i % q] for i in range(int(q * rng.uniform(1.7, 4)))]
            texts.append(words)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        which, runs = finder.runs(np.array(sum(texts, []), np.int64), offsets)
        for i, words in enumerate(texts):
            assert list(zip(*(x[which == i].tolist() for x in runs))) == runs_by_hand(words)


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for n in (2, 8, 256):
        ntt = periods.Transform(n)
        a, b = rng.integers(0, periods.PRIME, (2, 3, n)).astype(np.uint64)
        got = ntt.backward(ntt.forward(a) * ntt.forward(b) % np.uint64(periods.PRIME))
        for row in range(3):
            want = [0] * n
            for i, x in enumerate(a[row].tolist()):
                for j, y in enumerate(b[row].tolist()):
                    want[(i + j) % n] += x * y
            assert got[row].tolist() == [w % periods.PRIME for w in want]


def test_blocks_by_transform_and_by_differences_agree():
    words = np.random.default_rng(3).integers(0, 2, 3000)
    words[1500:2300] = words[1100:1900]
    at = np.arange(0, 2000, 64)
    plain = [(i, q) for i in at.tolist() for q in range(128, 256) if (words[i : i + 64] == words[i + q : i + q + 64]).all()]
    at_found, q_found = periods.Blocks().occurrences(words, at, 64, 128, 256)
    assert sorted(zip(at_found.tolist(), q_found.tolist())) == plain


def rewritten(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return [w.decode() for w in words]


def test_periodic_query_matches_brute_force(spark, rows, tmp_path):
    table = [(i, t) for i, t, _ in rows if i != 60] + [(i, " ".join(f"w{(i * k) % 31}" for k in range(60))) for i in range(100, 160)] + [(None, "a " * 12)]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    want = []
    for doc_id, text in table:
        words = rewritten(doc_id, text)
        runs = runs_by_hand(words)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((doc_id, len(runs), *top, None if not runs else 1000 * top[1] // top[2], sha(lines), sha(collapsed_by_hand(words, runs))))
    assert sum(w[1] for w in want) > 10
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_periodic_runs_of_edge_cases(spark, docs, empty, clashing):
    assert periods.repeated_runs(empty).collect() == []
    plain = sorted(map(tuple, periods.repeated_runs(docs).collect()), key=repr)
    assert plain == sorted(map(tuple, periods.repeated_runs(clashing).collect()), key=repr)
    assert len(plain) == docs.count()
    long = spark.createDataFrame([(1, "x y z " * 40_000), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periods.repeated_runs(long).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 120_000, 3)] and got[1]["collapsed"] == "x y z"
    assert got[2]["n_words"] == 0 and got[2]["runs"] == [] and got[2]["collapsed"] == ""


# --- conversations

TURNS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType())])


def trie_by_hand(seqs):
    nodes = {}
    for conv, turns in seqs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        leaf = lambda p: not any(q[:-1] == p for q in nodes if q)
        ends = sorted(c for c in members if len(seqs[c]) == len(path))
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), sum(1 for q in nodes if q and q[:-1] == path),
            sum(map(leaf, under)), sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in under if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def ordered(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    return {c: [(r, x) for _, _, r, _, x in sorted(t)] for c, t in turns.items()}


def conversations(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), 100, 101, 150, 207, 230, -5, -100]:
        length = rng.choice([1, 2, 3, 5, 9, 20])
        for k in range(length):
            rows.append((c, k if rng.random() < 0.9 else None, rng.choice(["user", None]) if k % 2 else "system", rng.choice(["hi", "ünï 😀", "", None, "ok"]) if k < 12 else "same"))
    rows += [(c, 0, "user", "again") for c in range(300, 340)]  # a group of equal conversations
    rows += [rows[5], rows[5], (None, 1, "user", "nobody")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_trie_matches_brute_force(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, TURNS).withColumn("kind", F.lit("x")).withColumn("depth", F.lit(1))
    want = trie_by_hand(ordered(rows))
    got = tries.trie(tries.sequences(df), shard_turns=40)
    assert got.columns == tries.RESULT
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_trie_query_rebuilds_conversations(spark, tmp_path):
    rows = conversations(9)
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    own = ordered(rows)
    heads = lambda c: zlib.crc32(str(c).encode()) % 6
    base = lambda c: c - (c % 100 if c >= 0 else -(-c % 100))
    rebuilt = {c: own.get(base(c), [])[: heads(c)] + t[heads(c) :] for c, t in own.items()}
    assert sorted(map(tuple, QUERIES["op12_conversation_trie"](spark, str(tmp_path)).collect()), key=repr) == trie_by_hand(rebuilt)


def test_trie_of_few_or_no_conversations(spark):
    assert tries.trie(tries.sequences(spark.createDataFrame([], TURNS))).collect() == []
    one = [tuple(r) for r in tries.trie(tries.sequences(spark.createDataFrame([(7, None, None, None)], TURNS))).collect()]
    assert sorted(r[:7] for r in one) == [(7, 0, None, 1, 1, 1, 0), (7, 1, 7, 1, 0, 1, 0)]


def test_trie_of_one_long_conversation_beside_short_ones(spark):
    rows = [(1, k, "user", f"t{k}") for k in range(3000)] + [(c, k, "user", f"t{k}") for c in range(2, 40) for k in range(c % 5)]
    got = tries.trie(tries.sequences(spark.createDataFrame(rows, TURNS)))
    by_depth = {r["depth"]: r for r in got.collect()}
    assert len(by_depth) == 3001 and all(r["n_leaves"] == 1 for r in by_depth.values())
    assert by_depth[1]["n_convs"] == 1 + sum(c % 5 > 0 for c in range(2, 40))


# --- vectors


def links_by_hand(rows):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v) for _, v in rows]
    dims = max((len(v) for _, v in rows if v), default=1)
    x = np.array([[*v, *[0.0] * (dims - len(v))] if good else [1.0] + [0.0] * (dims - 1) for (_, v), good in zip(rows, ok)], float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9) & np.outer(ok, ok)
    np.fill_diagonal(near, False)
    label = np.arange(len(rows))
    changed = True
    while changed:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(rows))])
        changed, label = (new != label).any(), new
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        name = min(ids, default=None)
        out.append((vec_id, int(near[i].sum()), name, vec_id == name))
    return sorted(out, key=repr)


def cloud(seed, n, dims, spread=None):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) * (spread if spread is not None else 1)
    rows = [base[i] for i in range(n)]
    for i in range(n // 2):  # near copies on both sides of the threshold
        near = base[i % 20] + rng.normal(size=dims) * np.linalg.norm(base[i % 20]) / np.sqrt(dims) * rng.uniform(0.05, 0.7)
        rows.append(near * rng.uniform(0.1, 50))
    rows += [base[0]] * 15 + [-base[0]] * 3
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("dims,tile,spread", [(64, 8192, None), (64, 40, None), (5, 60, None), (24, 50, [9.0] * 2 + [1.0] * 22), (1, 30, None)])
def test_vectors_match_brute_force(spark, dims, tile, spread):
    rows = cloud(dims + tile, 160, dims, spread)
    df = spark.createDataFrame(rows, StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType()))])).repartition(3)
    got = vectors.near_duplicates(df, tile=tile)
    assert sorted(map(tuple, got.collect()), key=repr) == links_by_hand(rows)


def test_vectors_of_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1e-300, 2e-300]),
            (10, [1.0, 2.0, 0.0]), (10, [1.0, 2.0]), (None, [1.0, 2.0]), (None, [5.0, -1.0]), (None, None), (11, [1e300, -1e300])]
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType()))])
    df = spark.createDataFrame(rows, schema).withColumn("id", F.lit("x")).withColumn("digest", F.lit(1)).withColumn("n", F.lit(2))
    assert sorted(map(tuple, vectors.near_duplicates(df).collect()), key=repr) == links_by_hand(rows)
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    assert [tuple(r) for r in vectors.near_duplicates(spark.createDataFrame(rows[2:8], schema)).orderBy("vec_id").collect()] == [(i, 0, i, True) for i in range(3, 9)]


def test_every_pair_counts_in_one_block():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 32))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.05, 0.2, 0.4)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    space = vectors.Subspaces(unit, 0.9)
    codes, errors = space.codes(unit)
    seen = {}
    for block in range(space.parts):
        n, _, checks = vectors.compare(space, block, False, np.arange(len(x)), np.ones(len(x), np.int64), errors, np.ones(len(x), bool), np.zeros(len(x)), codes)
        for p in checks:
            seen[tuple(sorted(p))] = seen.get(tuple(sorted(p)), 0) + 1
        seen["sure"] = seen.get("sure", 0) + int(n.sum()) // 2
    cos = unit @ unit.T
    pairs = {(i, j) for i in range(len(x)) for j in range(i) if cos[i, j] >= 0.9}
    checked = {p for p in seen if p != "sure"}
    assert all(seen[p] == 1 for p in checked)
    assert seen["sure"] + sum(cos[p] >= 0.9 for p in checked) == len(pairs)
