"""Exact and near copies and repeated spans against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fragcube.llm import exact, jaccard, substring
from fragcube.llm.components import components


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


def exact_by_hand(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in rows]
    groups = {}
    for (i, t, *_), n in zip(rows, norm):
        groups.setdefault(n, []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for (i, _, *_), n in zip(rows, norm):
        keep = min(groups[n])[3]
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return Counter(out)


def test_exact(docs, rows, clashing):
    assert as_rows(exact.decide(docs)) == exact_by_hand(rows)
    assert as_rows(exact.decide(clashing, salts=3)) == exact_by_hand(rows)


def test_exact_compares_content_where_digests_collide(docs, rows):
    got = exact.decide(docs, digest=lambda norm: F.substring(F.sha2(norm, 256), 1, 1))
    assert as_rows(got) == exact_by_hand(rows)


def test_exact_ties_and_extreme_ids(spark):
    rows = [(2**63 - 1, "a b"), (-(2**63), "ab "), (0, "a b"), (None, "a  b"), (None, None), (5, "")]
    assert as_rows(exact.decide(spark.createDataFrame(rows, "doc_id long, text string"))) == exact_by_hand(rows)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_by_hand(rows):
    sets = {(i, t): shingles(t) for i, t, *_ in rows}
    known = [(i, s) for (i, _), s in sets.items() if i is not None and s]
    root = {i: i for i, _ in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(known):
        for j, b in known[:k]:
            if 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return Counter((i, len(sets[i, t]), None if i is None else find(i) if i in root else i) for i, t, *_ in rows)


def test_jaccard(docs, rows, clashing):
    want = components_by_hand(rows)
    assert any(c != i for i, _, c in want)
    assert as_rows(jaccard.join(docs)) == want
    assert as_rows(jaccard.join(clashing)) == want


def test_jaccard_with_tiles_and_frequent_shingles(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 2)
    monkeypatch.setattr(jaccard, "FREQUENT", 0.05)
    assert as_rows(jaccard.join(docs)) == components_by_hand(rows)


def test_jaccard_sends_a_group_of_nearly_similar_documents_once(spark, monkeypatch):
    """Copies with edits share many first shingles, and each of these gives another block of most of them."""
    rng = random.Random(3)
    rows = []
    for group in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
        for k in range(12):
            words = list(base)
            for place in rng.sample(range(2000), 21 if k < 2 else 25):  # beside the threshold on either side
                words[place] = f"edit{group}x{k}"
            rows.append((100 * group + k, " ".join(words)))
    sent = Counter()

    def counted(df, name, materialise=jaccard.materialise):
        stored = materialise(df, name)
        sent[name] += stored.count()
        return stored

    monkeypatch.setattr(jaccard, "materialise", counted)
    want = components_by_hand(rows)
    assert 3 < len({c for _, _, c in want}) < len(rows)
    assert as_rows(jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))) == want
    assert sent["open"] <= 3 * len(rows)


def test_shingles_of_many_texts_at_once(rows, monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 300)
    odd = [b"", None, b" \t\n", b"x" * 70 + b" " + b"x" * 71, b"a\x00 a", b"A b c D e " * 9, b"x" * 9 + b" " + b"x" * 16 + b" " + b"x" * 17]
    texts = odd + [None if t is None else t.encode() for _, t, _ in rows]
    plain = []
    for t in texts:
        words = (t or b"").lower().split()
        plain.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    sets = jaccard.cut(*jaccard.Shingler().of(texts))
    assert [len(set(s.tolist())) for s in sets] == [len(s) for s in sets] == [len(p) for p in plain]
    for a, p in zip(sets, plain):
        assert [len(set(a.tolist()) & set(b.tolist())) for b in sets] == [len(p & q) for q in plain]


def test_point_bounds_the_overlap():
    import numpy as np

    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 2000).astype(np.uint64) * np.uint64(2))
    for _ in range(50):
        a, b = (np.sort(rng.choice(base, rng.integers(1, 1500), replace=False)) for _ in "ab")
        bound = jaccard._overlap(*(np.frombuffer(jaccard.point(x), np.uint8) for x in (a, b)))
        assert bound >= len(np.intersect1d(a, b))


def test_tree_finds_what_all_pairs_find():
    import numpy as np

    rng = np.random.default_rng(2)
    points = rng.integers(0, 3, (200, jaccard.GROUPS)).astype(np.uint8)  # the coarsest points
    points[100:] = points[:100]
    points[100:, :20] = rng.integers(0, 3, (100, 20))
    sizes = points.sum(axis=1).astype(np.int64)
    got = {frozenset((i, int(j))) for i, after in jaccard.possible([p.tobytes() for p in points], sizes) for j in after}
    want = set()
    for i in range(200):
        for j in range(i):
            a, b = sizes[i], sizes[j]
            if 100 * min(a, b) >= 80 * max(a, b) and np.minimum(points[i], points[j]).sum() >= jaccard.required(a, b):
                want.add(frozenset((i, j)))
    assert want <= got and len(want) >= 50


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 7), (7, 100), (50, 50), (None, 3), (200, 201), (201, 202)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in [*range(2, 41), 100]}, 201: 200, 202: 200}


def spans_by_hand(rows, width):
    first = {}
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - width + 1):
            k = tuple(w[p : p + width])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if i is not None and first[tuple(w[p : p + width])] < i:
                gone[p : p + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("width,kmer", [(50, 10), (12, 4)])
def test_substring(docs, rows, width, kmer):
    want = spans_by_hand(rows, width)
    assert sum(r[2] for r in want) > 1000
    assert as_rows(substring.cut(docs, width, kmer)) == want


def test_substring_where_every_path_is_opened(docs, rows, monkeypatch):
    monkeypatch.setattr(substring, "MOST_BITS", 15)
    monkeypatch.setattr(substring, "SPARSE", 1)
    assert as_rows(substring.cut(docs)) == spans_by_hand(rows, 50)


def test_strip_keeps_columns_and_clean_texts(clashing, rows):
    got = substring.strip(clashing)
    assert got.columns == clashing.columns
    by_id = {r["doc_id"]: r["text"] for r in got.collect()}
    want = {i: (n, gone, digest) for i, n, gone, digest in spans_by_hand(rows, 50)}
    for i, t, *_ in rows:
        if want[i][1] == 0:
            assert by_id[i] == t
        else:
            assert hashlib.sha256(by_id[i].encode()).hexdigest() == want[i][2]


@pytest.mark.parametrize("op", [exact.decide, jaccard.join, substring.cut, substring.strip])
def test_empty(empty, op):
    assert op(empty).count() == 0


def peak_of(rows):
    tracemalloc.start()
    n = sum(len(r["id"]) for r in rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return n, peak


def test_a_task_holds_shingles_of_few_texts():
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(500)).encode() for _ in range(6000)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.binary())})
    n, peak = peak_of(jaccard.keyed([batch], np.zeros(0, np.uint64)))
    assert n > 90 * len(texts) and peak < 60e6  # all at once took 150 MB
    whole = Counter(zip(*(np.concatenate([r[c] for r in jaccard.keyed([batch], np.zeros(0, np.uint64))]).tolist() for c in ("key", "id"))))
    single = Counter()
    for i in range(0, 50):
        for r in jaccard.keyed([batch.slice(i, 1)], np.zeros(0, np.uint64)):
            single.update(zip(r["key"].tolist(), r["id"].tolist()))
    assert not single - whole
    again = list(jaccard.described([batch]))
    assert sum(len(r["n_shingles"]) for r in again) == len(texts) and sum(x is not None for r in again for x in r["often"]) == 1


@pytest.mark.parametrize("least", [2, 4, 500])
def test_commonest_numbers(least):
    values = np.random.default_rng(3).zipf(1.5, 300).astype(np.uint64)
    want = {v: n for v, n in Counter(values.tolist()).items() if n >= least}
    got, n = jaccard.commonest(values, least)
    assert dict(zip(got.tolist(), n.tolist())) == want


def test_a_round_of_stars_is_one_job_that_sums_what_it_writes(spark, monkeypatch):
    from fragcube.llm import components as module

    stored = []
    monkeypatch.setattr(module, "materialise_observed", lambda *a, f=module.materialise_observed: stored.append(f(*a)) or stored[-1])
    chain = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
    assert {r["component"] for r in chain.collect()} == {0} and len(stored) > 2
    assert all(sums["n"] == links.count() for links, sums in stored)
