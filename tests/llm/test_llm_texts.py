"""Tokens, packing, quality, languages, scores, licenses and URLs against brute force."""

import base64
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

P = pytest.importorskip("public_tokenizers")
from fragcube import session  # noqa: E402
from fragcube.llm import bpe, language, licenses, mixing, packing, quality, urls  # noqa: E402

RANKS, VOCABULARY = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference_bpe():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def reference_words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def odd_texts():
    rng = random.Random(3)
    letters = "abcDE's .,!?\n\t 12é漢字ñß\u0301\U0001F600—İΣ\x1c\x85\r|<>स्ﬁ\u0958"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["", " ", "<|endoftext|>", "a" * 3000, "x<|endoftext|>.y <|ENDOFTEXT|> a<|startoftext|>B. <|endoftext|>c."]


def test_codec_equals_other_library(reference_bpe):
    codec = bpe.codec(RANKS, P.PATTERN)
    texts = odd_texts()
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == reference_bpe.encode_ordinary(text)
        assert codec.decode(ids.tolist()) == text.encode()
        starts, chars = codec.offsets(text.encode(), ids)
        raw = text.encode()
        for s, c, i in zip(starts.tolist(), chars.tolist(), ids.tolist()):
            assert raw[s : s + len(codec.bytes_of[i])] == codec.bytes_of[i]
            assert len(raw[:s].decode(errors="ignore")) == c


def test_small_memory_gives_the_same_ids(reference_bpe, monkeypatch):
    codec = bpe.Codec(RANKS, P.PATTERN)
    codec.memory.bound = 20
    texts = odd_texts()[:300]
    for lo in range(0, 300, 50):
        for text, ids in zip(texts[lo : lo + 50], codec.encode(texts[lo : lo + 50])):
            assert ids.tolist() == reference_bpe.encode_ordinary(text)


def test_words_equal_the_whole_text(reference_words):
    texts = odd_texts()
    for text, ids in zip(texts, packing.tokenizer(VOCABULARY).encode([t.encode() for t in texts])):
        assert ids.tolist() == reference_words.encode(text, add_special_tokens=False).ids


def test_encode_decode_tables(docs, clashing, rows, empty, reference_bpe):
    tokens = bpe.encode(clashing, RANKS, P.PATTERN)
    decoded = bpe.decode(tokens, RANKS, P.PATTERN)
    got = Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in decoded.collect())
    assert got == Counter((i, tuple(reference_bpe.encode_ordinary(t or "")), (t or "").encode()) for i, t, _ in rows)
    trip = Counter(tuple(r) for r in bpe.round_trip(docs, RANKS, P.PATTERN).collect())
    assert trip == Counter({
        (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest()): n for (i, ids, text), n in got.items()
    })
    assert bpe.round_trip(empty, RANKS, P.PATTERN).count() == 0
    nothing = docs.sparkSession.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(nothing, RANKS, P.PATTERN).first()["decoded"]) == b""


def check_places(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pack(docs, clashing, rows, reference_words, capacity):
    got = packing.pack(clashing, VOCABULARY, capacity).collect()
    used = check_places(got, capacity)
    want = Counter()
    for i, t, _ in rows:
        ids = reference_words.encode(t or "", add_special_tokens=False).ids + [0]
        for p, s in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[s : s + capacity], "<u4")
            want[i, p, s, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert used <= math.ceil(sum(r["length"] for r in got) / capacity) * 1.1 + 1


def test_plan_uses_every_piece_once_and_fills():
    rng = random.Random(5)
    for trial in range(30):
        capacity = rng.choice([10, 50, 200])
        histogram = Counter(rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 30, 3000])))
        plan = packing.plan(histogram, capacity)
        seen = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= capacity and times > 0
            for x in lengths:
                seen[x] += times
        assert seen == histogram
        assert len(plan) <= 2 * capacity
        total = sum(k * n for k, n in histogram.items())
        if sum(histogram.values()) == 3000:
            large = sum(n for k, n in histogram.items() if 2 * k > capacity)
            assert sum(t for _, t in plan) <= max(math.ceil(total / capacity), large) * 1.05 + 1


def test_pack_empty_and_hot_length(spark, empty):
    assert packing.pack(empty, VOCABULARY).count() == 0
    docs = spark.createDataFrame([(i, "word") for i in range(30_000)], "doc_id long, text string")
    assert check_places(packing.pack(docs, VOCABULARY).collect(), 2048) == math.ceil(30_000 * 2 / 2048)


def base_by_hand(text):
    t = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            marked |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(marked)


def test_quality_counts(spark, docs, rows, clashing, empty):
    extra = [(70, "a b\n a b\na b\n\n\na b c a b c", None), (71, "x# |<> $\n" * 30, None), (72, "a b c d a b c e " * 9, None)]
    field = quality.Field(np.zeros(quality.N_FEATURES), np.zeros((2, 2)))
    both = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for r in quality.judge(both, field).collect():
        text = dict((i, t) for i, t, _ in rows + extra)[r["doc_id"]]
        want = base_by_hand(text)
        assert tuple(r)[1:6] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed)
    assert quality.judge(empty, field).count() == 0
    kept = quality.keep(clashing, field)
    assert kept.columns == clashing.columns and kept.count() == sum(base_by_hand(t)[0] >= 50 and 2 * base_by_hand(t)[4] <= base_by_hand(t)[0] for _, t, _ in rows)


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(4)
    for _ in range(100):
        n = int(rng.integers(1, 8))
        score, step = rng.normal(size=n), rng.normal(size=(2, 2))
        value = lambda y: sum(score[i] * y[i] for i in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:]))
        best = max(value([k >> i & 1 for i in range(n)]) for k in range(2**n))
        assert value(quality.viterbi(score, step)) == pytest.approx(best)


def test_field_learns_junk_lines(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    clean = lambda: "\n".join(" ".join(word() for _ in range(14)).capitalize() + "." for _ in range(6))
    junk = lambda: "\n".join(" ".join(word() + rng.choice(["###", "%%%", " |"]) for _ in range(12)) for _ in range(6))
    docs = spark.createDataFrame([(i, clean() if i % 2 else junk()) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 120)] + [(None, 1), (500, None)], "doc_id long, quality int")
    verdict = {r["doc_id"]: r["kept"] for r in quality.judge(docs, quality.train(docs, labels)).collect()}
    assert all(verdict[i] == bool(i % 2) for i in range(200))
    assert not quality.train(docs, labels.filter("quality = 1")).emit.any()


def test_languages(spark, empty):
    rng = random.Random(8)
    syllables = {"xx": ["ka", "ki", "mo"], "yy": ["ble", "tra", "oun"], "zz": ["szy", "czę", "łow"]}
    text = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(lang, 40), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 40)]
    odd = [(200, None, "xx"), (201, "12 !? \n", "xx"), (202, "", None), (203, text("xx", 90) + " " + text("zz", 30), None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    names, log_p = language.learn(docs, F.col("doc_id") < 60)
    assert names == ["xx", "yy", "zz"]
    got = {r["doc_id"]: r for r in language.identify(docs, names, log_p).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (200, 201, 202))
    mixed = {x["lang"]: x["share"] for x in got[203]["languages"]}
    assert set(mixed) == {"xx", "zz"} and mixed["xx"] == pytest.approx(630 / 960, abs=0.06)  # words of "zz" are longer
    assert all(0 <= r["score"] <= 1 for r in got.values())
    names, log_p = language.learn(empty, F.lit(True))
    assert [r["lang_pred"] for r in language.identify(docs, names, log_p).collect()] == ["und"] * len(got)
    assert language.identify(empty, names, log_p).count() == 0


def test_scores(docs, rows, clashing, empty):
    counts = Counter()
    for i, t, _ in rows:
        if mixing.trained(i):
            counts.update((t or "").encode().lower().split() + [b" "])
    total, distinct = sum(counts.values()), len(counts)
    want = {}
    for i, t, _ in rows:
        tokens = (t or "").encode().lower().split() + [b" "]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        want[i, t] = len(tokens), sum(counts[w] > 0 for w in tokens), base
    got = mixing.score(clashing, share=0.02).collect()
    assert len(got) == len(rows)  # repeated rows too
    by_id = {i: v for (i, _), v in want.items()}
    for r in got:
        n, known, base = by_id[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (not mixing.trained(r["doc_id"])) and r["score"] < 0
    assert {r["doc_id"]: round(r["base_score"], 6) for r in mixing.score(docs).collect()} == {r["doc_id"]: round(r["base_score"], 6) for r in got}
    assert mixing.score(empty).count() == 0


def test_mixing_is_a_distribution_and_learns():
    text = np.frombuffer(b"the cat sat on the mat. " * 40, np.uint8)
    at = []
    for x in (text, text[:100]):
        own = mixing.contexts(x) + (np.arange(mixing.ORDERS) * mixing.SLOTS)[:, None]
        at.append((own * mixing.SYMBOLS + np.append(x, np.uint16(mixing.END))).ravel())
    at, n = np.unique(np.concatenate(at), return_counts=True)
    model = mixing.Model(at, n)
    one = [model.score([np.frombuffer(bytes([b]), np.uint8)])[0] for b in range(256)]
    empty = model.score([np.zeros(0, np.uint8)])[0]
    # the first symbol's probabilities over all symbols sum to 1; its share is the text's score less the end's after it
    shares = [10 ** (model.score([np.frombuffer(bytes([b]), np.uint8)])[0] - _end_after(model, b)) for b in range(256)]
    assert sum(shares) + 10**empty == pytest.approx(1.0, abs=1e-3)
    assert len(one) == 256
    noise = np.random.default_rng(1).permutation(text)
    assert model.score([text])[0] > 3 * model.score([noise])[0] or model.score([text])[0] > model.score([noise])[0] / 3


def _end_after(model, b):
    """log10 probability of the closing symbol after one byte, by the definition (no refinement happens within one step)."""
    x = np.frombuffer(bytes([b]), np.uint8)
    slot = (mixing.contexts(x)[:, 1] + np.arange(mixing.ORDERS) * mixing.SLOTS) * model.n_inner
    out = 0.0
    first, length = model.first[mixing.END], model.length[mixing.END]
    for k in range(first, first + length):
        z = float(np.clip(sum(0.35 * model.odds[s + model.node[k]] for s in slot), -11.5, 11.5))
        p = 1 / (1 + math.exp(-z))
        cell = int((min(max(z, -6), 6) + 6) * (mixing.CELLS - 1) / 12 + 0.5)
        mapped = 1 / (1 + math.exp(-np.linspace(-6, 6, mixing.CELLS)[cell]))
        p = min(max(0.75 * p + 0.25 * mapped, 1e-6), 1 - 1e-6)
        out += math.log10(p if model.bit[k] else 1 - p)
    return out

def test_short_texts_are_refined_from_learnt_start():
    """Symbol by symbol by the definition, for texts of less than 128 bytes, from weights that training texts moved."""
    rng = random.Random(5)
    made = ["".join(rng.choice("abc de") for _ in range(n)).encode() for n in [0, 1, 60, 127, 90, 127]]
    texts = [np.frombuffer(t, np.uint8) for t in made]
    base = (np.arange(mixing.ORDERS) * mixing.SLOTS)[:, None]
    at = [((mixing.contexts(x) + base) * mixing.SYMBOLS + np.append(x, np.uint16(mixing.END))).ravel() for x in texts]
    at, n = np.unique(np.concatenate(at), return_counts=True)
    tree = mixing.Model(at, n).tree
    start, odds = mixing.Start(), mixing.Odds(tree, at, n, counts=True)
    start = start.newton(mixing.lessons(tree, odds, start, texts))
    start = start.mapped(mixing.lessons(tree, odds, start, texts))
    assert abs(start.weights - 0.35).max() > 0.01
    model = mixing.Model(at, n, tree, start)
    for x, got in zip(texts, model.score(texts)):
        weights, cells, want = start.weights.copy(), start.cells.copy(), 0.0
        keys, kinds = mixing.contexts(x) + base, np.append(0, mixing.KINDS[x])
        for pos, s in enumerate(np.append(x, np.uint16(mixing.END)).tolist()):
            taught = []
            for k in range(model.first[s], model.first[s] + model.length[s]):
                st = np.array([model.odds[keys[o, pos] * model.n_inner + model.node[k]] for o in range(mixing.ORDERS)], float)
                gate = kinds[pos] * mixing.DEPTHS + model.depth[k]
                z = float(np.clip(weights[gate] @ st, -11.5, 11.5))
                p, cell = 1 / (1 + math.exp(-z)), int((min(max(z, -6), 6) + 6) * (mixing.CELLS - 1) / 12 + 0.5)
                final, bit = min(max(0.75 * p + 0.25 * cells[cell], 1e-6), 1 - 1e-6), float(model.bit[k])
                want += math.log10(final if bit else 1 - final)
                taught.append((gate, (bit - p) * mixing.RATE * st, cell, (bit - cells[cell]) * mixing.MAP_RATE))
            for gate, step, cell, drift in taught:
                weights[gate] += step
                cells[cell] += drift
        assert got == pytest.approx(want, rel=2e-3)


def test_second_lesson_needs_no_texts():
    """What is kept of a chunk teaches the same as its texts, held-out ones and contexts without counts among them."""
    rng = random.Random(7)
    texts = [mixing.symbols("".join(rng.choice("abc De,é\0") for _ in range(n)).encode()) for n in [0, 1, 300, 900, 40, 700]]
    learnt = [True, False, True, True, True, False]
    base = (np.arange(mixing.ORDERS) * mixing.SLOTS)[:, None]
    at = [((mixing.contexts(x) + base) * mixing.SYMBOLS + np.append(x, np.uint16(mixing.END))).ravel() for x, own in zip(texts, learnt) if own]
    at, n = np.unique(np.concatenate(at), return_counts=True)
    tree, start = mixing.Model(at, n).tree, mixing.Start()
    places = mixing.Places(texts, keep=False, counted=learnt)
    kept = mixing.Kept(mixing.Kept.packed(places, at, n))
    want = mixing.lessons(tree, mixing.Odds(tree, at, n, counts=True), start, [x for x, own in zip(texts, learnt) if own])
    got = mixing.lessons(tree, mixing.Odds(tree, kept.at, kept.odds_n, counts=True), start, kept)
    assert np.abs(want).sum() > 0 and got == pytest.approx(want, rel=1e-9, abs=1e-9)
    none = mixing.Places(texts, keep=False, counted=[False] * len(texts))
    none = mixing.Kept(mixing.Kept.packed(none, at[:0], n[:0]))
    assert not mixing.lessons(tree, mixing.Odds(tree, none.at, none.odds_n, counts=True), start, none).any()


def test_chunks_hold_texts_of_like_lengths(monkeypatch):
    """All texts of a chunk are read in as many steps as its longest has symbols."""
    monkeypatch.setattr(mixing, "HOLD", 20_000)
    rng = random.Random(3)
    held = [(i, b"x" * (4000 if i % 10 == 0 else rng.randint(0, 100))) for i in range(400)] + [(None, b""), (3, b"")]
    want = list(held)
    chunks = list(mixing.by_length(held))
    assert not held and sorted(map(repr, sum(chunks, []))) == sorted(map(repr, want)) and list(mixing.by_length([])) == []
    assert all(sum(len(t) + 200 for _, t in c) < 20_000 + 4_200 for c in chunks)
    longest = [max(len(t) for _, t in c) for c in chunks]
    assert sum(n == 4000 for n in longest) <= 11 and sum(n <= 100 for n in longest) >= 4  # in the order that they come, each chunk has a long one


def test_contexts_are_counted_apart(spark, docs, rows):
    """Every two and three bytes and every word so far have counts of their own, wherever these are looked up."""
    words = [bytes([97 + i // 676, 97 + i // 26 % 26, 97 + i % 26]).decode() for i in range(6000)]
    many = spark.createDataFrame([(1, " ".join(words), None)], "doc_id long, text string, lang string")
    assert mixing.trained(1)
    text = " ".join(words).encode() + b"\0"
    so_far = lambda k: text[:k].rsplit(b" ", 1)[-1]
    seen = [{text[max(0, k - i) : k] for k in range(len(text))} for i in (1, 2, 3)] + [{so_far(k) for k in range(len(text))}]
    got = Counter(r["context"] // mixing.SLOTS for r in mixing.context_counts(many).collect())
    assert got == {i: len(s) for i, s in enumerate(seen)} and got[3] > 4096
    far, near = ({(r["doc_id"], r["n_tokens"]): r["score"] for r in mixing.score(docs, context_share=x).collect()} for x in (1.0, 0.0))
    assert far == pytest.approx(near, rel=1e-6)


def licenses_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                starts.append(k)
                labels.add(label)
    more, best = set(labels), 0.0
    for block in re.split(r"\n|[.!?](?=[ \t\n\x0b\f\r])", low):
        own = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", block))
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            if len(own & t) >= licenses.THRESHOLD * len(t) - 1e-9:
                more.add(label)
                best = max(best, len(own & t) / len(t))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(more)), 1.0 if starts else best)


def test_licenses(spark, rows, empty):
    texts = [
        "MIT License", "x mit license apache license y", "Licensed under CC BY-NC 4.0.\nmore", "lİcense mit lİcense", "the summit license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Before. Permission is granted, free of charge, to any person obtaining a copy of this software and documentation files! After",
        "redistribution and use in source and binary forms\nwith or without modification are permitted provided that the following conditions are met",
        "gnu general public license gnu general public license", None, "", "é CC BY",
    ]
    mine = [(1000 + i, t, None) for i, t in enumerate(texts)] + [(None, "mit license", None), (1000, "MIT License", None)]
    docs = spark.createDataFrame(mine + rows, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    got = Counter(tuple(r) for r in licenses.scan(docs.select("*", *(F.lit(1).alias(c) for c in ("key", "word", "rank", "label", "t", "n_words")))).collect())
    assert got == Counter((i, *licenses_by_hand(t)) for i, t, _ in mine + rows)
    assert licenses.scan(empty).count() == 0


WRAPPED = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that\n",
    "gpl": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3\n",
    "mpl": "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not distributed with this\n",
}


def runs_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    best = {}
    for k, (label, template) in enumerate(licenses.TEMPLATES):
        t, width = set(template.split()), math.ceil(len(template.split()) / licenses.THRESHOLD - 1e-9)
        share = max((len(t & set(words[i : i + width])) / len(t) for i in range(len(words))), default=0)
        if share >= licenses.THRESHOLD - 1e-9:
            best[k, label] = share
    return best


def test_wrapped_licenses(spark, rows):
    rng = random.Random(3)
    texts = [f"some words before\n{t}and after" for t in WRAPPED.values()] + list(WRAPPED.values())
    for _ in range(40):  # cut, doubled and shuffled notices, with other words between
        words = " ".join(rng.choices(list(WRAPPED.values()), k=2)).split()
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = rng.choice(["x", "the", "license", "\n"])
        k = rng.randrange(12)
        texts.append(rng.choice([" ", "\n"]).join(words[k:]))
    mine = [(1000 + i, t, None) for i, t in enumerate(texts)] + [(None, WRAPPED["mit"], None)]
    docs = spark.createDataFrame(mine + rows, "doc_id long, text string, lang string")
    got = Counter((r["doc_id"], r["template"], r["label"], round(r["containment"], 9)) for r in licenses.run_matches(docs).collect())
    assert got == Counter((i, k, label, round(x, 9)) for i, t, _ in {r[:2]: r for r in mine + rows}.values() for (k, label), x in runs_by_hand(t).items())
    found = {r["doc_id"]: r for r in licenses.scan(docs, wrapped=True).collect()}
    for i, label in enumerate([*WRAPPED, *WRAPPED]):
        assert label in found[1000 + i]["labels"].split(",") and found[1000 + i]["score"] >= licenses.THRESHOLD
    by_line = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert all(set(by_line[i]["labels"].split(",")) <= {"", *r["labels"].split(",")} and r["score"] >= by_line[i]["score"] for i, r in found.items())


def test_sql_of_licenses_finds_wrapped_notices(spark, tmp_path):
    """The SQL states lines and runs of words alike, so it agrees with the query where notices are wrapped, cut or mixed."""
    from oracle import compare, connect

    from fragcube.llm.queries import ORACLES, QUERIES

    rng = random.Random(11)
    texts = [None, "", "the MIT license. mit license", *WRAPPED.values(), *(" ".join(t.split()) for t in WRAPPED.values())]
    for _ in range(60):
        words = " ".join(rng.choices(list(WRAPPED.values()), k=2)).split()
        for _ in range(rng.randrange(10)):
            words[rng.randrange(len(words))] = rng.choice(["x", "the", "license.", "\n"])
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words[rng.randrange(12) :]))
    pa_table = pa.table({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    pq.write_table(pa_table, tmp_path / "documents.parquet")
    df = QUERIES["op4_license_scan"](spark, str(tmp_path))
    cursor = connect(str(tmp_path)).execute(ORACLES["op4_license_scan"])
    columns = [d[0] for d in cursor.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], columns, cursor.fetchall()) is None
    by_line = {r["doc_id"]: r["labels"] for r in licenses.scan(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()}
    assert sum(by_line[r["doc_id"]] != r["labels"] for r in df.collect()) >= 5  # runs add to what lines find


def located_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_urls(spark):
    rng = random.Random(9)
    urls_ = [None, "", "no scheme", "http://", "http://net", "http://NET/", "https://a.net/x?y#z", "https://example.net/en/1", "http://notexample.net/en/1", "https://x.org/fr/", "https://x.org/fr", "ftp://example.com/de/a://b", "http://h?q=/de/", "http://a/b\nc/d"]
    for lang in ("en", "de", "fr"):
        urls_ += [f"https://w{rng.randrange(3)}.example.com/{lang}/{rng.randrange(1000)}" for _ in range(60)]
    urls_ += [f"https://blog.example.com/de/tag-{k}/p{k}" for k in range(40)] + [f"https://blog.example.com/posts/{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls_)], "page_id long, url string, html string, template string")
    got = {r["page_id"]: r for r in urls.filter_urls(pages).collect()}
    assert len(got) == len(urls_)
    for i, u in enumerate(urls_):
        host, path = located_by_hand(u)
        fits = [r for r in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        if rule:
            assert got[i]["verdict"] == urls.RULES[rule]
        elif not u or not u.startswith("https://blog"):
            assert got[i]["verdict"] == "allow"
    assert {got[i]["template"] for i, u in enumerate(urls_) if u and "/posts/" in u} == {"/posts/*"}
    assert {got[i]["template"] for i, u in enumerate(urls_) if u and "blog.example.com/de" in u} == {"/de/*/*"}
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_deep_paths_are_told_apart(spark):
    paths = [f"/a/b/c/d/{kind}/x{k}" for k in range(60) for kind in ("bad", "good")] + ["/a/b/c/d/e/f/g/h/i/last9", "/" + "z/" * 40]
    pages = spark.createDataFrame([(i, f"http://deep.example.org{p}") for i, p in enumerate(paths)] * 2, "page_id long, url string")
    got = {r["path"]: r["template"] for r in urls.filter_urls(pages, {"example.org/a/b/c/d/bad/": "block", "example.org/a/b/c/d/good/x1": "allow"}).collect()}
    bad, good = ({got[p] for p in paths if kind in p} for kind in ("/bad/", "/good/"))
    assert len(bad) == len(good) == 1 and bad.pop().endswith("/bad/*") and good.pop().endswith("/good/*")
    assert got["/a/b/c/d/e/f/g/h/i/last9"].endswith("/f/g/h/i/*") and got[paths[-1]].endswith("/z" * 30)


def test_pure_template_is_rejected_however_few_its_labels(spark):
    pages = spark.createDataFrame([(i, f"http://half.example.net/t{i % 7}/{'p' if i < 40 else 'q'}{i}") for i in range(100)], "page_id long, url string")
    got = urls.filter_urls(pages, {f"example.net/t{k}/p": "block" for k in range(7)}).collect()
    assert {r["template"] for r in got} == {"/*/*"} and {r["verdict"] for r in got} == {"block"} and got[0]["purity"] > 0.9


def test_template_is_rejected_by_its_labels(spark):
    pages = spark.createDataFrame([(i, f"http://bad.example.com/{'de' if i % 10 else 'en'}/{i}") for i in range(200)], "page_id long, url string")
    rules = {"example.com/de/1": "allow", "example.com/de/2": "block"}
    got = urls.filter_urls(pages, {"example.com/de/1": "block"}).collect()
    unlabelled = [r for r in got if r["rule"] is None and r["path"].startswith("/de/")]
    assert unlabelled and {r["verdict"] for r in unlabelled} == {"block"}  # over half of the template's pages are blocked by rule
    assert {r["verdict"] for r in got if r["path"].startswith("/en/")} == {"allow"}
    mixed = urls.filter_urls(pages, rules).collect()
    assert {r["verdict"] for r in mixed if r["rule"] is None} == {"allow"}


@pytest.mark.parametrize("most", [4_000_000, 3_000, 100])
def test_a_task_counts_each_context_once(spark, monkeypatch, most):
    texts = [" ".join(random.Random(k).choices("the a of mixed words and others".split(), k=60)) for k in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "not learnt"), (3, None)], "doc_id long, text string").coalesce(1)
    want = Counter()
    for i, t in [*enumerate(texts), (3, "")]:
        if mixing.trained(i):
            x = mixing.symbols(t.encode())
            for k, own in enumerate(mixing.contexts(x)):
                want.update(zip((own + k * mixing.SLOTS).tolist(), np.append(x, np.uint16(mixing.END)).tolist()))
    batch = pa.record_batch({"doc_id": pa.array([*range(len(texts)), None, 3]), "text": pa.array([*(t.encode() for t in texts), b"not learnt", None], pa.binary())})
    monkeypatch.setattr(mixing, "CHUNK", 500)
    monkeypatch.setattr(mixing, "PAIRS", most)
    monkeypatch.setattr(mixing, "ROWS", 700)
    got, rows = Counter(), 0
    for out in mixing.counted_places([batch]):
        rows += len(out["n"])
        for c, s, n in zip(out["context"].tolist(), out["symbol"].tolist(), out["n"].tolist()):
            got[c, s] += n
    assert got == want and (rows == len(want) or most == 100)
    table = mixing.context_counts(docs)
    assert {(r["context"], s["symbol"]): s["n"] for r in table.collect() for s in r["seen"]} == want
    plan = table._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[2]
    assert plan.count("Exchange ") == 1  # there were two


def test_scoring_stores_less_than_its_texts(spark):
    """Chunks send and get packed counts of what they hold, and no more for being many."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    common = [word() for _ in range(2000)]
    texts = [" ".join(word() if rng.random() < 0.1 else rng.choice(common) for _ in range(rng.randint(1, 900))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = session._own_folder(spark)
    stored = lambda: sum(os.path.getsize(os.path.join(top, f)) for top, _, names in os.walk(folder) for f in names)
    got, before = [], stored()
    for n in (1, 6):
        scored = mixing.score(docs.repartition(n, "doc_id"))
        got.append({r["doc_id"]: r for r in scored.collect()})
        now = stored()
        assert now - before < sum(map(len, texts))
        before = now
    one, six = got
    assert len(one) == len(texts) and one.keys() == six.keys()
    for i, r in one.items():
        assert r["score"] == pytest.approx(six[i]["score"], rel=1e-5) and r["base_score"] == pytest.approx(six[i]["base_score"], rel=1e-9)
        assert all(r[k] == six[i][k] for k in ("held_out", "n_tokens", "n_known", "train_tokens"))


def test_words_are_cut_as_bytes_are():
    texts = [b"", b" \t\n\x0b\x0c\r", bytes(range(1, 128)) * 2, b"A\x1cb\x1fC\x85 \xc2\xa0d", "Ünï İ x ".encode(), b" a  B\tb\na "]
    codes, words, many = mixing.words_of(texts)
    ends = np.cumsum(many)
    words = words.to_pylist()
    assert len(set(words)) == len(words)
    assert [[words[c] for c in codes[e - n : e]] for e, n in zip(ends, many)] == [t.lower().split() for t in texts]
    assert mixing.words_of([])[2].tolist() == []
