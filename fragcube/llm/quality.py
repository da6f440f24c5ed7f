"""Quality rules: a linear-chain conditional random field marks lines as content or boilerplate.

Each line becomes a few yes/no features (symbols, repeated words, line and word
length, capitals, digits, sentence ends, copies of earlier lines).  The field
scores a label for a line and a change of label between lines; Viterbi decoding
finds the best labels of the whole text, and the share of words on content
lines decides whether the document stays.  Two plain rules come first: too few
words, or too many words in repeated three-word windows.

Training maximises the conditional likelihood on a bounded sample of labelled
documents (``TRAIN_DOCUMENTS``, chosen by the hash of their id; of each at most
``TRAIN_RUNS`` runs of ``TRAIN_LINES`` lines, evenly spread).  The lines of a
document carry its label.  Everything else covers every line of every text.

A null or empty text has no words and fails the first rule.  Repeated rows are
judged alike.  Without labelled documents of both kinds the field is neutral
and keeps what passes the rules.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragcube.llm.text import doc_text, map_arrow, release

TRAIN_DOCUMENTS = 3_000
TRAIN_RUNS = 4
TRAIN_LINES = 32
MIN_WORDS = 50
MAX_REPEATED = 50
#: Share of words on content lines from which a document stays.
MIN_CONTENT = 0.5

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
NOT_DIGITS = bytes(b for b in range(256) if b not in b"0123456789")
NOT_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)
NOT_MARKS = bytes(b for b in range(256) if b not in b".,;:!?")


@dataclass(frozen=True)
class Field:
    """Weights: per feature the score of "content", and the scores of a change between lines (from, to)."""

    emit: np.ndarray
    step: np.ndarray


def bins(value: float, *edges: float) -> int:
    return sum(value > e for e in edges)


#: How many values each feature has.
SIZES = (5, 5, 5, 4, 4, 4, 2, 2, 4)
OFFSETS = tuple(int(x) for x in np.cumsum((0, *SIZES[:-1])))
N_FEATURES = sum(SIZES)


def line_features(line: bytes, words: list[bytes], copy: bool) -> list[int]:
    """Positions of the features that hold for a line with words."""
    size, n = len(line), len(words)
    symbols = size - len(line.translate(None, SYMBOLS))
    values = (
        bins(symbols / n, 0, 0.1, 0.3, 0.7),
        bins(1 - len(set(words)) / n, 0, 0.3, 0.5, 0.7),
        bins(n, 1, 3, 8, 20),
        bins(sum(map(len, words)) / n, 3, 5, 9),
        bins(len(line.translate(None, NOT_CAPITALS)) / size, 0.0, 0.15, 0.5),
        bins(len(line.translate(None, NOT_DIGITS)) / size, 0.0, 0.1, 0.3),
        int(line.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"')),
        int(copy),
        bins(len(line.translate(None, NOT_MARKS)) / n, 0.05, 0.3, 0.8),
    )
    return [o + v for o, v in zip(OFFSETS, values)]


def lines_of(text: bytes) -> tuple[list[list[int]], list[int], int]:
    """Features and number of words of every line with a word, and how many of these repeat an earlier one."""
    features, sizes, seen, copies = [], [], set(), 0
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            copy = line in seen
            copies += copy
            seen.add(line)
            features.append(line_features(line, words, copy))
            sizes.append(len(words))
    return features, sizes, copies


def viterbi(content: np.ndarray, step: np.ndarray) -> list[int]:
    """The best labels (0 boilerplate, 1 content) given the content score of each line; ties go to content."""
    (b_b, b_c), (c_b, c_c) = step.tolist()
    back, b, c = [], 0.0, 0.0
    for i, score in enumerate(content.tolist()):
        if i:
            from_c_to_b, from_c_to_c = c + c_b >= b + b_b, c + c_c >= b + b_c
            back.append((from_c_to_b, from_c_to_c))
            b, c = max(c + c_b, b + b_b), max(c + c_c, b + b_c)
        c += score
    label = int(c >= b)
    out = [label]
    for to_b, to_c in reversed(back):
        label = int(to_c if label else to_b)
        out.append(label)
    return out[::-1]


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that are found twice or more, the first place included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    end = total = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def judge_text(text: bytes, field: Field) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept."""
    words = text.split()
    n = len(words)
    word_chars = len(text.translate(None, WHITE).decode("utf-8", "replace"))
    repeats = repeated_words(words)
    features, sizes, copies = lines_of(text)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEATED * n
    share = 0.0
    if n:
        labels = viterbi(field.emit[np.array(features)].sum(axis=1), field.step)
        share = sum(s for s, l in zip(sizes, labels) if l) / n
    return n, word_chars, len(text) - len(text.translate(None, SYMBOLS)), copies, repeats, failed, share, not failed and share >= MIN_CONTENT


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept")
DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def fit(x: np.ndarray, mask: np.ndarray, y: np.ndarray, rounds: int = 150, decay: float = 1e-3) -> Field:
    """Maximise the conditional likelihood of label runs.

    ``x``: runs x lines x features as positions, ``mask``: which lines exist, ``y``: label of each run's lines.
    """
    n_runs, length, _ = x.shape
    emit, step = np.zeros(N_FEATURES), np.zeros((2, 2))
    weight = 0.5 / np.maximum(np.bincount(y, minlength=2), 1)[y]  # both kinds count alike
    v = [np.zeros_like(emit), np.zeros_like(step)]
    truth = np.broadcast_to(y[:, None], mask.shape)
    for t in range(rounds):
        score = np.zeros((n_runs, length, 2))
        score[..., 1] = emit[x].sum(axis=2)
        a, b = np.zeros((n_runs, length, 2)), np.zeros((n_runs, length, 2))
        a[:, 0] = score[:, 0]
        for i in range(1, length):
            a[:, i] = np.where(mask[:, i, None], np.logaddexp(a[:, i - 1, 0, None] + step[0], a[:, i - 1, 1, None] + step[1]) + score[:, i], a[:, i - 1])
        for i in range(length - 2, -1, -1):
            ahead = score[:, i + 1] + b[:, i + 1]
            b[:, i] = np.where(mask[:, i + 1, None], np.logaddexp(ahead[:, 0, None] + step[:, 0], ahead[:, 1, None] + step[:, 1]), 0.0)
        log_z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
        p_content = np.exp(a[..., 1] + b[..., 1] - log_z[:, None])
        error = (truth - p_content) * mask * weight[:, None]
        g_emit = np.bincount(x.ravel(), np.repeat(error.ravel(), x.shape[2]), N_FEATURES) - decay * emit
        g_step = np.zeros((2, 2))
        pair = mask[:, 1:] * weight[:, None]
        for i in (0, 1):
            for j in (0, 1):
                p = np.exp(a[:, :-1, i] + step[i, j] + score[:, 1:, j] + b[:, 1:, j] - log_z[:, None])
                g_step[i, j] = (((truth[:, 1:] == i) & (truth[:, 1:] == j)) * pair).sum() - (p * pair).sum()
        g_step -= decay * step
        for w, g, s in ((emit, g_emit, v[0]), (step, g_step, v[1])):
            s += g * g
            w += 0.5 * g / np.sqrt(s + 1e-8)
    return Field(emit, step)


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit the field to the documents of ``labels`` (``doc_id``, ``quality`` 0 or 1)."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id is not null and quality in (0, 1)").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(TRAIN_DOCUMENTS)
    )

    def run(batches):
        for b in batches:
            out = {"quality": [], "features": []}
            for label, text in zip(b.column("quality").to_pylist(), b.column("text").to_pylist()):
                features, _, _ = lines_of(text or b"")
                starts = range(0, len(features), TRAIN_LINES)
                for at in sorted({int(i) for i in np.linspace(0, len(starts) - 1, TRAIN_RUNS)}) if features else ():
                    out["quality"].append(label)
                    out["features"].append([f for line in features[starts[at] : starts[at] + TRAIN_LINES] for f in line])
            yield out

    # at most TRAIN_DOCUMENTS ids are sent to every task, and so many times TRAIN_RUNS runs come back
    rows = map_arrow(doc_text(docs).join(F.broadcast(chosen), "doc_id"), run, "quality int, features array<int>").toArrow()
    y = rows.column("quality").to_numpy()
    if len(set(y.tolist())) < 2:
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)))
    per_line = len(SIZES)
    x, mask = np.zeros((len(y), TRAIN_LINES, per_line), np.int64), np.zeros((len(y), TRAIN_LINES), bool)
    order = sorted(range(len(y)), key=lambda i: (y[i], rows.column("features")[i].as_py()))  # the same sum whatever the order of tasks
    for k, i in enumerate(order):
        f = np.array(rows.column("features")[i].as_py()).reshape(-1, per_line)
        x[k, : len(f)], mask[k, : len(f)] = f, True
    return fit(x, mask, y[order].astype(np.int64))


def judge(docs: DataFrame, field: Field) -> DataFrame:
    """Counts, content share and verdict of every document."""

    def run(batches):
        for b in batches:
            rows = [judge_text(t or b"", field) for t in b.column("text").to_pylist()]
            yield {"doc_id": b.column("doc_id"), **dict(zip(NAMES, zip(*rows) if rows else [[]] * len(NAMES)))}

    return map_arrow(doc_text(docs), run, "doc_id long, " + DDL)


def keep(docs: DataFrame, field: Field) -> DataFrame:
    """The documents that stay, with all their columns; nothing is shuffled."""

    def run(batches):
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            yield b.filter(pa.array([judge_text(t or b"", field)[-1] for t in texts], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)
