"""Language identification as a mixture of languages.

A language is a distribution over hashed byte trigrams (``BUCKETS``), counted
over every learning text.  The trigrams of a text are a sample from a mixture
of languages: expectation-maximisation estimates the proportions, and the set
of languages is the one with the greatest likelihood after a penalty per
language.  Sets grow from the best single language by the language that the
current mixture explains worst, as long as the penalised likelihood rises.

The model has ``BUCKETS`` numbers per language.  Languages are a closed set of
labels; more than ``MAX_LANGUAGES`` is an error, which bounds what is sent to
the tasks.  A text that is null or has no letter is ``und`` with score 0, as is
every text when nothing was learnt.  Ties go to the language first in order.
Rows are independent; only ``doc_id``, ``text`` and (for learning) ``lang`` are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragcube.llm.text import doc_text, map_arrow

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
#: Added to every count; a trigram never seen in a language keeps a little mass.
SMOOTHING = 0.5
ROUNDS = 12
#: Log-likelihood that each further language must add, times the logarithm of the number of trigrams.
PENALTY = 3.0
#: Bytes of text handled at a time.
CHUNK = 2_000_000

FOLD = np.arange(256, dtype=np.uint32)
FOLD[ord("A") : ord("Z") + 1] += 32
FOLD[[b for b in range(128) if not chr(b).isalpha()]] = ord(" ")


def trigrams(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text: A-Z folded, other ASCII as single spaces."""
    b = FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    blank = b == 32
    b = b[~(blank & np.append(blank[1:], False))]  # of a run of spaces the last
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    return (h >> np.uint32(17)).astype(np.int64)


def learn(docs: DataFrame, chosen: Column) -> tuple[list[str], np.ndarray]:
    """Languages in order and the log-probability of each bucket, from all texts for which ``chosen`` holds."""

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                if text:
                    t = trigrams(text)
                    if lang not in totals:
                        totals[lang] = np.zeros(BUCKETS, np.int64)
                    if len(t) < 4000:
                        np.add.at(totals[lang], t, 1)
                    else:
                        totals[lang] += np.bincount(t, minlength=BUCKETS)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield {"lang": [lang] * len(at), "bucket": at.astype(np.int32), "n": counts[at]}

    rows = docs.filter(chosen & F.col("lang").isNotNull()).select("lang", F.col("text").cast("binary").alias("text"))
    counts = map_arrow(rows, run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # at most BUCKETS rows per language
    names = sorted(set(table.column("lang").to_pylist()))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; at most {MAX_LANGUAGES} can be learnt")
    model = np.full((len(names), BUCKETS), SMOOTHING)
    index = {name: i for i, name in enumerate(names)}
    model[[index[x] for x in table.column("lang").to_pylist()], table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    return names, np.log(model / model.sum(axis=1, keepdims=True)) if names else model


def proportions(p: np.ndarray, c: np.ndarray, starts: np.ndarray, doc: np.ndarray, n: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation for many texts at once.

    ``p``: likelihood of each (text, trigram) under each language of the text's set,
    ``c``: how often it occurs, ``starts``/``doc``: where texts begin / whose it is.
    Returns proportions, log-likelihood and the likelihood of each trigram under the mixture.
    """
    w = np.full((len(n), sets.shape[1]), 1.0 / sets.shape[1])
    for _ in range(ROUNDS):
        joint = p * w[doc]
        share = joint * (c / joint.sum(axis=1))[:, None]
        w = np.add.reduceat(share, starts) / n[:, None]
    mixture = (p * w[doc]).sum(axis=1)
    return w, np.add.reduceat(c * np.log(mixture), starts), mixture


def infer(grams: list[np.ndarray], log_p: np.ndarray) -> list[list[tuple[int, float]]]:
    """Languages and proportions of texts given their trigrams (none empty), the largest first."""
    pairs = [np.unique(g, return_counts=True) for g in grams]
    sizes = np.array([len(u) for u, _ in pairs])
    bucket, c = np.concatenate([u for u, _ in pairs]), np.concatenate([k for _, k in pairs]).astype(float)
    n = np.array([len(g) for g in grams], float)
    p = np.exp(log_p).T  # BUCKETS x languages
    starts = np.cumsum(sizes) - sizes
    single = np.add.reduceat(log_p.T[bucket] * c[:, None], starts)
    best_set = single.argmax(axis=1)[:, None]
    weights, value = np.ones((len(n), 1)), single.max(axis=1)
    found = [[(int(s[0]), 1.0)] for s in best_set]
    active = np.arange(len(n))
    sets, mixture = best_set, p[bucket, np.repeat(best_set[:, 0], sizes)]
    while len(active) and sets.shape[1] < len(log_p):
        doc = np.repeat(np.arange(len(active)), sizes[active])
        starts = np.cumsum(sizes[active]) - sizes[active]
        # how much better each language explains the text than the mixture does; above 1 it can raise the likelihood
        gain = np.add.reduceat(p[bucket] * np.minimum(c / mixture, 1e300)[:, None], starts) / n[active][:, None]
        np.put_along_axis(gain, sets, -1.0, axis=1)
        sets = np.column_stack([sets, gain.argmax(axis=1)])
        cost = PENALTY * np.log(n[active] + 1)
        can = n[active] * np.log(np.maximum(gain.max(axis=1), 1.0)) > cost  # an upper bound of what the language adds
        doc, bucket, c, active, sets, cost = _only(can, doc, sizes, bucket, c, active, sets, cost)
        if not len(active):
            break
        starts = np.cumsum(sizes[active]) - sizes[active]
        w, total, mixture = proportions(p[bucket[:, None], sets[doc]], c, starts, doc, n[active], sets)
        better = total - cost > value[active]
        for i in np.flatnonzero(better):
            order = sorted(zip(sets[i].tolist(), w[i].tolist()), key=lambda x: (-x[1], x[0]))
            found[active[i]] = [(a, b) for a, b in order if b > 0]
        value[active[better]] = (total - cost)[better]
        keep_pairs = better[doc]
        mixture = mixture[keep_pairs]
        doc, bucket, c, active, sets, cost = _only(better, doc, sizes, bucket, c, active, sets, cost)
    return found


def _only(which, doc, sizes, bucket, c, active, sets, cost):
    """Restrict the arrays of :func:`infer` to some texts."""
    pairs = which[doc]
    active = active[which]
    return np.repeat(np.arange(len(active)), sizes[active]), bucket[pairs], c[pairs], active, sets[which], cost[which]


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def identify(docs: DataFrame, names: list[str], log_p: np.ndarray) -> DataFrame:
    """``lang_pred``, its proportion as ``score`` and all ``languages`` with proportions, for every text."""
    model = docs.sparkSession.sparkContext.broadcast(log_p.astype(np.float32))  # MAX_LANGUAGES x BUCKETS at most

    def run(batches):
        lp = model.value.astype(float)
        for b in batches:
            doc_ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < CHUNK):
                    size += len(texts[hi] or b"")
                    hi += 1
                out = [("und", 0.0, [])] * (hi - lo)
                grams = {i: trigrams(t) for i, t in enumerate(texts[lo:hi]) if names and t and has_letter(t)}
                grams = {i: g for i, g in grams.items() if len(g)}
                if grams:
                    for i, langs in zip(grams, infer(list(grams.values()), lp)):
                        langs = [(names[k], min(1.0, w)) for k, w in langs]
                        out[i] = (*langs[0], [{"lang": a, "share": w} for a, w in langs])
                yield {"doc_id": doc_ids[lo:hi], **{k: [o[j] for o in out] for j, k in enumerate(("lang_pred", "score", "languages"))}}
                lo = hi

    return map_arrow(doc_text(docs), run, "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>")


