"""Runs of repeated words: maximal stretches that repeat with a smallest period.

A run of period ``q`` is a stretch of at least ``max(12, 2 q)`` words in which
words ``q`` apart are identical, whose smallest period is ``q``, and which no
neighbouring word extends.  Per text:

1. At dyadic scales, periods from ``2 B`` to ``4 B - 1`` are sought with blocks of
   ``B`` words.  A run of such a period holds an aligned block of which the copy one
   period later lies in the run too.
2. A block of which some word does not stand again anywhere in the window that
   follows is passed over.  For each other block the squared differences to every place of
   that window are summed.  The sums are ``sum x^2 + sum y^2 - 2 x*y``; the product comes
   from a number theoretic transform modulo a prime, exact in 64-bit integers, of
   all blocks at once.  A sum of zero is an occurrence (a sum that is a multiple of
   the prime is sorted out in the next step); blocks below ``NTT_FROM`` words sum
   the differences without a transform, which is cheaper there.
3. The distance between a block and its copy seeds an extension to both sides by
   binary search on prefix hashes.  Seeds inside a run already known whose period
   fits into the block are multiples of it and are passed over; stretches with a
   smaller period are dropped; what stays is compared word by word.

Texts of a batch are processed together, at each scale those that are long
enough for it; words are numbered exactly, by a dictionary.

Defined results: a null text has no words; repeated rows give one row each; a
null ``doc_id`` is kept; an empty table gives no rows.  Only ``doc_id`` and
``text`` are read, whole texts in one piece (about 150 bytes of memory a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fragcube.llm.text import Rolling, arrow_schema, doc_text, mix

#: A run has at least so many words.
LEAST = 12
#: 15 * 2**27 + 1, of which 31 is a primitive root: transforms of up to 2**27 points.
PRIME, GENERATOR = 2013265921, 31
#: Blocks of at least so many words are compared by transforms.
NTT_FROM = 64
#: Words that are processed together; a longer text is processed alone.
BATCH_WORDS = 400_000

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, length, period


class Transform:
    """Number theoretic transform of the rows of a matrix, modulo ``PRIME``; its length is a power of two."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.roots, self.inverse_roots = (self._powers(pow(GENERATOR, (PRIME - 1) // n * s % (PRIME - 1), PRIME), n // 2) for s in (1, -1))
        self.scale = np.uint64(pow(n, -1, PRIME))

    @staticmethod
    def _powers(root: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, out * np.uint64(pow(root, len(out), PRIME)) % np.uint64(PRIME)])
        return out

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Result in bit-reversed order."""
        p, rows = np.uint64(PRIME), len(x)
        half = self.n // 2
        x = x.copy()
        while half:
            y = x.reshape(rows, -1, 2, half)
            a, b = y[:, :, 0], y[:, :, 1]
            low = a + b
            np.subtract(low, p, out=low, where=low >= p)
            high = (a + (p - b)) * self.roots[:: self.n // 2 // half] % p
            y[:, :, 0], y[:, :, 1] = low, high
            half //= 2
        return x

    def backward(self, x: np.ndarray) -> np.ndarray:
        """From bit-reversed order back."""
        p, rows = np.uint64(PRIME), len(x)
        half = 1
        while half < self.n:
            y = x.reshape(rows, -1, 2, half)
            a, b = y[:, :, 0].copy(), y[:, :, 1] * self.inverse_roots[:: self.n // 2 // half] % p
            low = a + b
            np.subtract(low, p, out=low, where=low >= p)
            high = a + (p - b)
            np.subtract(high, p, out=high, where=high >= p)
            y[:, :, 0], y[:, :, 1] = low, high
            half *= 2
        return x * self.scale % p


class Blocks:
    """Zero-mismatch occurrences of a scale's blocks; transforms are kept per length."""

    def __init__(self) -> None:
        self.transforms: dict[int, Transform] = {}

    def occurrences(self, words: np.ndarray, at: np.ndarray, size: int, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
        """Places ``at`` of blocks and distances from ``near`` up to ``far - 1`` at which the block may stand again.

        ``words`` must reach ``far + size`` beyond every block.
        """
        if size >= NTT_FROM:
            return self._by_transform(words, at, size, near, far)
        found = []
        block = words[at[:, None] + np.arange(size)]
        for q in range(near, far):
            apart = block - words[at[:, None] + (q + np.arange(size))]
            hit = np.flatnonzero(np.einsum("ij,ij->i", apart, apart) == 0)
            found.append((at[hit], np.full(len(hit), q)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _by_transform(self, words: np.ndarray, at: np.ndarray, size: int, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
        n = 1 << (far - near + size - 1).bit_length()
        if n not in self.transforms:
            self.transforms[n] = Transform(n)
        ntt, p = self.transforms[n], np.uint64(PRIME)
        found = []
        step = max(1, (1 << 20) // n)
        for lo in range(0, len(at), step):
            some = at[lo : lo + step]
            x = words[some[:, None] + np.arange(size)].astype(np.uint64)
            y = words[some[:, None] + (near + np.arange(far - near + size - 1))].astype(np.uint64)
            reversed_x, window = np.zeros((len(some), n), np.uint64), np.zeros((len(some), n), np.uint64)
            reversed_x[:, :size], window[:, : y.shape[1]] = x[:, ::-1], y
            product = ntt.backward(ntt.forward(reversed_x) * ntt.forward(window) % p)[:, size - 1 : size - 1 + far - near]
            squares = np.zeros((len(some), y.shape[1] + 1), np.uint64)
            np.cumsum(y * y % p, axis=1, out=squares[:, 1:])
            own = (x * x % p).sum(axis=1, keepdims=True)
            same = (own + squares[:, size:] - squares[:, :-size]) % p == 2 * product % p
            row, distance = np.nonzero(same)
            found.append((some[row], near + distance))
        return tuple(np.concatenate(x) for x in zip(*found))


class Next:
    """Where words stand again."""

    def __init__(self, words: np.ndarray) -> None:
        order = np.argsort(words, kind="stable")
        self.words, self.n = words, len(words)
        self.keys = words[order] * self.n + order
        self.gap = np.full(self.n, self.n)
        same = words[order[1:]] == words[order[:-1]]
        self.gap[order[:-1][same]] = np.diff(order)[same]

    def may_repeat(self, at: np.ndarray, size: int, near: int, far: int) -> np.ndarray:
        """Of the blocks at ``at`` those of which every word stands again from ``near`` up to ``far - 1`` further."""
        column = np.arange(size)
        left = np.flatnonzero((self.gap[at[:, None] + column] < far).all(axis=1))
        place = at[left][:, None] + column
        key = self.words[place] * self.n + place
        found = self.keys[np.minimum(np.searchsorted(self.keys, key + near), self.n - 1)]
        return left[((found >= key + near) & (found < key + far)).all(axis=1)]


class Stretches:
    """Longest common extensions in a sequence, by hashes of its prefixes."""

    def __init__(self, words: np.ndarray, rolling: Rolling) -> None:
        self.n, self.rolling = len(words), rolling
        self.prefix = rolling.prefix(mix(words.astype(np.uint64)))

    def _same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.rolling.runs(self.prefix, i, i + n) == self.rolling.runs(self.prefix, j, j + n)

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from ``i`` and ``j > i`` on."""
        return self._longest(self.n - j, lambda n, k: self._same(i[k], j[k], n))

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree before ``i`` and ``j > i``."""
        return self._longest(i.copy(), lambda n, k: self._same(i[k] - n, j[k] - n, n))

    @staticmethod
    def _longest(most: np.ndarray, same) -> np.ndarray:
        """By doubling steps, then halving ones."""
        found, open_, step = np.zeros(len(most), np.int64), np.arange(len(most)), 1
        tried = np.zeros(len(most), np.int64)
        while len(open_):
            n = np.minimum(found[open_] + step, most[open_])
            good = same(n, open_)
            found[open_[good]] = n[good]
            tried[open_] = step
            open_ = open_[good & (n < most[open_])]
            step *= 2
        step = int(tried.max(initial=0))
        while step:
            at = np.flatnonzero((tried >= step) & (found + step <= most))
            good = same(found[at] + step, at)
            found[at[good]] += step
            step //= 2
        return found


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """Block size and range of periods: a block, its copy and the way to an aligned place fit into the least run."""
    yield 4, 1, 4
    size = 2
    while 4 * size <= longest:
        yield size, 2 * size, 4 * size
        size *= 2


class Finder:
    """Runs of many sequences at once."""

    def __init__(self) -> None:
        self.blocks, self.rolling = Blocks(), Rolling()

    def runs(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Runs]:
        """Sequence number and run of every run, by sequence, start and period; ``words`` are numbered from 0, sequence ``i`` is ``words[offsets[i]:offsets[i + 1]]``."""
        lens = np.diff(offsets)
        if not len(words):
            return np.zeros(0, np.int64), (np.zeros(0, np.int64),) * 3
        top = int(words.max(initial=0)) + 1
        reach = np.zeros(len(words), np.int64)  # the furthest end of a known run around a word, whose period fits into the block
        again = Next(words)
        kept: list[tuple[np.ndarray, ...]] = []
        waiting: list[tuple[np.ndarray, ...]] = []
        for size, near, far in scales(int(lens.max(initial=0))):
            for w in [w for w in waiting if w[2].max(initial=0) <= size]:
                np.maximum.at(reach, w[0], w[1])
                waiting.remove(w)
            np.maximum.accumulate(reach, out=reach)
            long = np.flatnonzero(lens >= max(LEAST, 2 * near))
            if not len(long):
                continue
            # the long sequences in a row, each followed by a number of its own and room for the last windows
            place = np.cumsum(lens[long] + 1) - (lens[long] + 1)
            ends = place + lens[long]
            row = np.full(ends[-1] + 1 + far + size, top + len(long), np.int64)
            row[ends] = top + np.arange(len(long))
            inner = np.repeat(place, lens[long]) + _within(lens[long])
            row[inner] = words[np.repeat(offsets[long], lens[long]) + _within(lens[long])]
            n_blocks = np.maximum(0, (lens[long] - near) // size)
            which = np.repeat(np.arange(len(long)), n_blocks)
            at = place[which] + size * _within(n_blocks)
            at = at[again.may_repeat(offsets[long][which] + at - place[which], size, near, far)]
            if not len(at):
                continue
            at, q = self.blocks.occurrences(row, at, size, near, far)
            which = np.searchsorted(place, at, side="right") - 1
            origin = offsets[long][which] + at - place[which]
            fresh = reach[origin] < origin + q + size
            at, q, which = at[fresh], q[fresh], which[fresh]
            fits = (row[at] == row[at + q]) & (row[at + size - 1] == row[at + q + size - 1])
            start, end, q, which = self._extended(row, at[fits], q[fits], which[fits])
            if not len(start):
                continue
            shift = offsets[long][which] - place[which]
            kept.append((long[which], start + shift, end + shift, q))
            waiting.append((start + shift, end + shift, q))
        if not kept:
            none = np.zeros(0, np.int64)
            return none, (none, none, none)
        which, start, end, q = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((q, start))
        which, start, end, q = which[order], start[order], end[order], q[order]
        return which, (start - offsets[which], end - start, q)

    def _extended(self, row: np.ndarray, at: np.ndarray, q: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct runs that contain the seeds."""
        stretches = Stretches(row, self.rolling)
        start, length = at - stretches.left(at, at + q), stretches.right(at, at + q)
        end = at + q + length
        seeds = np.unique(np.stack([start, end, q, which]), axis=1) if len(at) else np.zeros((4, 0), np.int64)
        seeds = seeds[:, seeds[1] - seeds[0] >= np.maximum(LEAST, 2 * seeds[2])]
        start, end, q, which = seeds
        smaller = np.zeros(len(q), bool)
        for prime in _primes(int(q.max(initial=1))):
            some = np.flatnonzero((q % prime == 0) & ~smaller)
            d = q[some] // prime
            n = end[some] - start[some] - d
            smaller[some[stretches._same(start[some], start[some] + d, n)]] = True
        keep = [k for k in np.flatnonzero(~smaller).tolist() if np.array_equal(row[start[k] : end[k] - q[k]], row[start[k] + q[k] : end[k]])]
        return start[keep], end[keep], q[keep], which[keep]


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each group of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _primes(most: int) -> Iterator[int]:
    sieve = np.ones(most + 1, bool)
    sieve[:2] = False
    for i in range(2, int(most**0.5) + 1):
        if sieve[i]:
            sieve[i * i :: i] = False
    return iter(np.flatnonzero(sieve).tolist())


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def collapsed(words: list[bytes], runs: Runs) -> bytes:
    """The words without those that a run contains after its first period."""
    cover = np.zeros(len(words) + 1, np.int64)
    start, length, period = runs
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    if not len(start):
        return b" ".join(words)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


DDL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``runs`` by start and period, and ``collapsed``: each run cut to its first period."""
    schema = arrow_schema(DDL)

    def rows(finder: Finder, ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers = _Numbers()
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        words = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(offsets[-1]))
        which, runs = finder.runs(words, offsets)
        cuts = np.searchsorted(which, np.arange(len(texts) + 1))
        start, length, period = runs
        cut = [collapsed(t, (start[a:b], length[a:b], period[a:b])) for t, a, b in zip(texts, cuts, cuts[1:])]
        entries = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], names=["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), entries)
        columns = [pa.array(ids, pa.int64()), pa.array(np.diff(offsets)), lists.cast(schema.field("runs").type), pa.array([c.decode("utf-8", "replace") for c in cut], pa.string())]
        return pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for b in batches:
            ids, texts, n = [], [], 0
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                words = (text.as_py() or b"").split()
                if ids and n + len(words) > BATCH_WORDS:
                    yield rows(finder, ids, texts)
                    ids, texts, n = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                n += len(words)
            if ids:
                yield rows(finder, ids, texts)

    return doc_text(docs).mapInArrow(run, DDL)
