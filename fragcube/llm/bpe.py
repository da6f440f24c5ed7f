"""Byte-level BPE: texts to token ids with byte and character offsets, and back.

The tokenizers library applies the merges to Arrow batches.  A text is first cut
where the pattern always cuts (before a lone space and around white space), so
equal pieces recur; each distinct piece is encoded once per worker and
remembered up to a bound.  Every byte is written as one printable character,
which is what the library's merges work on; decoding reverses that table and
joins bytes, so a character that was split over several tokens comes out whole.

A null text is the empty text: no tokens, decoded to no bytes.  Rows are
independent, so repeated rows and ids simply repeat; other columns are not read.
Null ids decode to the empty value.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import unicodedata
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragcube.llm.text import doc_text, map_arrow

#: Unicode white space, as the splitting pattern understands it (fixed values).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Cuts that agree with the pattern's own: a word with at most one leading space; white space before it; one left over.
PIECES = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
#: Marks that stand alone after a letter.
MARKS = frozenset(".,;:!?")
#: Distinct pieces that a worker remembers.
CACHE = 500_000


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where printable, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def parts_below(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The parts of a token just before the merge that makes it."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
        if rank >= limit:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


@functools.lru_cache(maxsize=10_000)
def ends_in_letter(char: str) -> bool:
    """Also after normalisation and folding, which can end a letter in a mark."""
    return unicodedata.normalize("NFC", char).lower()[-1:].isalpha()


class Memory:
    """Ids of pieces, each encoded once per worker and remembered up to a bound.

    A mark after a letter at the end of a piece is a token run of its own for
    the patterns used here, so the library has to encode a piece without it;
    where the vocabulary folds case anyhow, so has its lower-case form.  Pieces
    of letters only are encoded many in a row: ``edge`` tells for each id
    whether its token starts or ends a piece.  Others go one by one.
    """

    def __init__(self, library, folds: bool, bound: int) -> None:
        self.library, self.folds, self.bound = library, folds, bound
        added = [t.content for t in library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)  # these keep their case
        names = [library.id_to_token(i) or "" for i in range(library.get_vocab_size())]
        # with folded case tokens end words, else they start with the character of a space
        self.edge = np.array([t.endswith("</w>") if folds else t.startswith(byte_characters()[32]) for t in names])
        self.known: dict[str, bytes] = {}  # ids as four bytes each: small, and nothing for the garbage collector to visit

    def coded(self, pieces: list[str]) -> list[bytes]:
        missing = set(pieces) - self.known.keys()
        if len(self.known) + len(missing) > self.bound:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
        known, parts = self.known, {}
        for p in missing:
            core = p.lower() if self.folds and p.isascii() and not self.added.search(p) else p
            mark = ""
            if core[-1:] in MARKS and ends_in_letter(core[-2:-1]):
                core, mark = core[:-1], core[-1]
            parts[p] = core, mark
        self._encode(({x for pair in parts.values() for x in pair} - known.keys()) - {""})
        known.setdefault("", b"")
        for p, (core, mark) in parts.items():
            if p not in known:
                known[p] = known[core] + known[mark]
        return [known[p] for p in pieces]

    def _encode(self, pieces: set[str]) -> None:
        if self.folds:
            plain = [p for p in pieces if p.isalpha()]
        else:
            plain = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        runs = [plain[i : i + 200] for i in range(0, len(plain), 200)]
        glue = " " if self.folds else ""
        for run, coded in zip(runs, self.library.encode_batch_fast([glue.join(r) for r in runs], add_special_tokens=False)):
            ids = np.array(coded.ids, np.uint32)
            at = np.flatnonzero(self.edge[ids])
            edges = np.append(0, at + 1) if self.folds else np.append(at, len(ids))
            if len(edges) == len(run) + 1:
                self._keep(run, ids, edges)
        left = [p for p in pieces if p not in self.known]
        for lo in range(0, len(left), 1000):
            some = left[lo : lo + 1000]
            coded = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            edges = np.searchsorted(np.array(coded.word_ids, np.int64), np.arange(len(some) + 1))
            self._keep(some, np.array(coded.ids, np.uint32), edges)

    def _keep(self, pieces: list[str], ids: np.ndarray, edges: np.ndarray) -> None:
        raw, at = ids.tobytes(), (edges * 4).tolist()
        for p, i, j in zip(pieces, at, at[1:]):
            self.known[p] = raw[i:j]

    def expand(self, pieces: pa.Array, ends: np.ndarray, index: np.ndarray | None = None) -> list[np.ndarray]:
        """Ids of texts, given all their pieces in a row (or ``index`` into the pieces) and where each text's pieces end (from 0)."""
        table = pieces.dictionary_encode()
        own = table.indices.to_numpy()
        index = own if index is None else own[index]
        # a mark after a letter is split off here for most pieces at once, so that words with and without it are one
        marked = pc.match_substring_regex(table.dictionary, f"[a-z][{''.join(sorted(MARKS))}]$")
        cores = pc.if_else(marked, pc.utf8_slice_codeunits(table.dictionary, 0, -1), table.dictionary).dictionary_encode()
        marks = pc.if_else(marked, pc.utf8_slice_codeunits(table.dictionary, -1), "").dictionary_encode()
        coded = self.coded([*cores.dictionary.to_pylist(), *marks.dictionary.to_pylist()])
        both = np.stack([cores.indices.to_numpy(), marks.indices.to_numpy() + len(cores.dictionary)], axis=1)
        size = np.fromiter(map(len, coded), np.int64, len(coded)) >> 2
        flat = np.frombuffer(b"".join(coded), np.uint32)
        flat, _ = _taken(flat, size, both.ravel())
        ids, total = _taken(flat, size[both].sum(axis=1), index)
        return np.split(ids, total[ends[1:-1]])


def _taken(flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of ``flat``, of the given sizes, in order of ``index``; and where each begins."""
    each = size[index]
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])
    return flat[np.repeat((np.cumsum(size) - size)[index] - total[:-1], each) + np.arange(total[-1])], total


class Codec:
    """Encoder and decoder of one rank file, with a bounded memory of pieces."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        table = byte_characters()
        spell = lambda b: "".join(table[x] for x in b)
        merges = []
        for token in sorted(ranks, key=ranks.get):
            if len(token) > 1:
                parts = parts_below(token, ranks)
                if len(parts) == 2:
                    merges.append((spell(parts[0]), spell(parts[1])))
        self.library = Tokenizer(models.BPE({spell(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        back = {c: i for i, c in enumerate(table)}
        size = max(ranks.values()) + 1
        self.bytes_of = [bytes(back[c] for c in self.library.id_to_token(i) or "") for i in range(size)]
        self.width = np.array([len(b) for b in self.bytes_of], np.int64)
        self.memory = Memory(self.library, False, CACHE)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [PIECES.findall(t) for t in texts]
        ends = np.cumsum([0, *map(len, cut)])
        return self.memory.expand(pa.array(list(chain.from_iterable(cut)), pa.string()), ends) if texts else []

    def offsets(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte and character at which each token starts; a token inside a character starts at that character."""
        starts = np.cumsum(self.width[ids]) - self.width[ids]
        lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        return starts, np.cumsum(lead)[starts] - 1 if len(ids) else starts

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec per worker."""
    return Codec(ranks_path, pattern)


def slices(batch: pa.RecordBatch, chars: int = 5_000_000):
    """``doc_id`` and texts (bytes, null as empty) of consecutive rows, few at a time where texts are long."""
    ids, texts = batch.column("doc_id"), batch.column("text")
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    part = np.cumsum(sizes) // chars
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(texts)] if len(texts) else []
    for lo, hi in zip(edges, edges[1:]):
        yield ids.slice(lo, hi - lo), [t or b"" for t in texts.slice(lo, hi - lo).to_pylist()]


def encode(docs: DataFrame, ranks_path: str, pattern: str, offsets: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` and, if wanted, ``byte_starts`` and ``char_starts`` of every text."""
    ddl = "doc_id long, ids array<int>" + ", byte_starts array<int>, char_starts array<int>" * offsets

    def run(batches):
        own = codec(ranks_path, pattern)
        for b in batches:
            for doc_ids, raw in slices(b):
                ids = own.encode([t.decode("utf-8", "replace") for t in raw])
                out = {"doc_id": doc_ids, "ids": lists(ids)}
                if offsets:
                    both = [own.offsets(t, i) for t, i in zip(raw, ids)]
                    out |= {"byte_starts": lists([x for x, _ in both]), "char_starts": lists([y for _, y in both])}
                yield out

    return map_arrow(doc_text(docs), run, ddl)


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def decode(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``decoded`` bytes of every list of ids."""

    def run(batches):
        own = codec(ranks_path, pattern)
        for b in batches:
            ids = b.column("ids")
            yield {"doc_id": b.column("doc_id"), "ids": ids, "decoded": [own.decode(i or ()) for i in ids.to_pylist()]}

    return map_arrow(tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of the ids (little-endian unsigned 32-bit) of every text and of the bytes that they decode to.

    The same as :func:`encode` and :func:`decode` in a row, in one Python worker.
    """

    def run(batches):
        own = codec(ranks_path, pattern)
        for b in batches:
            for doc_ids, raw in slices(b):
                ids = own.encode([t.decode("utf-8", "replace") for t in raw])
                yield {
                    "doc_id": doc_ids, "n_tokens": [len(i) for i in ids],
                    "ids_sha256": [sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                    "decoded_sha256": [sha256(own.decode(i.tolist())).hexdigest() for i in ids],
                }

    return map_arrow(doc_text(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
