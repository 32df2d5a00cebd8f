"""Language of every word by a linear-chain conditional random field, and of the document by its words.

A chain is a sentence, cut after `LONGEST` words.  A word's features are its letter pairs and triples with
the neighbouring spaces (so also its affixes), and its entry in a lexicon of hashed words; together with learned
transitions between neighbouring words they give each word's chance of every language by forward-backward.
A document takes the language with most chance over its words with letters; its score is that mean.  Texts
that switch languages get a share for each.

Training maximises the likelihood of the chains of at most `per_class` documents per language (whole texts),
every word carrying its document's language.

Defined results: NULL texts and texts without a letter are `und` with score 0; without training rows every
text is; ties go to the first language in code-point order; rows are independent; other columns are kept,
those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm import samples
from vigilframe.llm import tokens as T
from vigilframe.llm.frames import bounded_batches

LONGEST = 64
PAIRS, TRIPLES, LEXICON = 1 << 16, 1 << 17, 1 << 16
RESULTS = ("lang_pred", "score", "shares")
STOP = np.zeros(256, bool)
STOP[list(b".!?\n")] = True
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Words:
    """The words of a slice: feature places of every byte, and the chains."""

    grams: np.ndarray  # per byte: pair feature, triple feature
    starts: np.ndarray
    ends: np.ndarray
    entries: np.ndarray  # lexicon feature of each word
    lettered: np.ndarray
    row: np.ndarray
    chains: np.ndarray  # first word of each chain, and the number of words


def analysed(data: np.ndarray, rows: np.ndarray) -> Words:
    data = T.LOWER[data]
    starts, ends, offsets = T.spans(data, rows)
    shown = np.where(T.SPACE[data], np.uint8(32), data).astype(np.int64)
    one, two = np.r_[shown[1:], 32], np.r_[shown[2:], 32, 32][:len(shown)]
    pairs = shown << 8 | one
    triples = ((shown << 16 | one << 8 | two) * 0x9E3779B1 >> 7) & (TRIPLES - 1)
    row = T.row_of(offsets)
    letters = np.r_[0, np.cumsum(LETTERS[data])]
    closes = np.r_[0, np.cumsum(STOP[data])]
    sentence = closes[starts] if len(starts) else closes[:0]
    new = np.ones(len(starts), bool)
    if len(starts):
        new[1:] = (np.diff(row) != 0) | (np.diff(sentence) != 0)
    first = np.flatnonzero(new)
    length = np.diff(np.r_[first, len(starts)])
    within = np.arange(len(starts)) - np.repeat(first, length)
    chains = np.flatnonzero(within % LONGEST == 0)
    return Words(
        np.stack([pairs, triples + PAIRS]), starts, ends,
        (T.span_hashes(data, starts, ends) >> T.U(48)).astype(np.int64) + PAIRS + TRIPLES,
        letters[ends] > letters[starts] if len(starts) else np.zeros(0, bool), row, np.r_[chains, len(starts)])


def emissions(words: Words, weights: np.ndarray) -> np.ndarray:
    """Score of every word and language: grams from the byte before the word to its last one, and its entry."""
    out = weights[words.entries].astype(np.float64)
    low = np.maximum(words.starts - 1, 0)
    for grams in words.grams:
        sums = np.zeros((len(grams) + 1, weights.shape[1]))
        np.cumsum(weights[grams], axis=0, out=sums[1:])
        out += sums[words.ends] - sums[low]
    return out


def marginals(scores: np.ndarray, chains: np.ndarray, move: np.ndarray, pairs: bool = False):
    """Chances of every word by forward-backward, chains of like length side by side; and summed pair chances."""
    n, k = scores.shape
    out, both = np.empty((n, k)), np.zeros((k, k))
    lengths = np.diff(chains)
    step = np.exp(move)
    order = np.argsort(lengths, kind="stable")[::-1]
    first, lengths = chains[:-1][order], lengths[order]
    lift = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -60, 0))
    longest = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(1, longest + 1), "right")
    ahead = np.empty((n, k))
    state = None
    for t in range(longest):
        at = first[:alive[t]] + t
        state = lift[at] if t == 0 else (state[:alive[t]] @ step) * lift[at]
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    back = np.empty((n, k))
    for t in range(longest - 1, -1, -1):
        at = first[:alive[t]] + t
        state = np.ones((alive[t], k))
        if t + 1 < longest and alive[t + 1]:
            later = first[:alive[t + 1]] + t + 1
            carried = lift[later] * back[later]
            state[:alive[t + 1]] = carried @ step.T
            state /= state.sum(axis=1, keepdims=True)
            if pairs:
                joint = ahead[at[:alive[t + 1]], :, None] * step[None] * carried[:, None, :]
                both += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back[at] = state
        out[at] = ahead[at] * state
    out /= out.sum(axis=1, keepdims=True)
    return out, both


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray
    move: np.ndarray


def fit(rows: list[tuple[str, str]], totals: dict, steps: int = 12, rate: float = 0.15, penalty: float = 1e-3) -> Model | None:
    langs = sorted(totals)
    if not rows:
        return None
    k = len(langs)
    weights, move = np.zeros((PAIRS + TRIPLES + LEXICON, k), np.float32), np.zeros((k, k))
    g2, m2 = np.full(weights.shape, 1e-6, np.float32), np.full((k, k), 1e-6)
    slices = []
    for row, stop, data, border in T.slices(pa.array([t for t, _ in rows], pa.large_string()), 1 << 18):
        words = analysed(data, border)
        gold = np.array([langs.index(lang) for _, lang in rows[row:stop]])[words.row]
        slices.append((words, gold))
    for _ in range(steps):
        for words, gold in slices:
            n = len(gold)
            if not n:
                continue
            chance, both = marginals(emissions(words, weights), words.chains, move, pairs=True)
            slope = chance * words.lettered[:, None]
            slope[np.arange(n), gold] -= words.lettered
            # d / d weight: a gram counts in the word whose bytes (and the one before) it starts at.
            grad = np.zeros(weights.shape, np.float32)
            low = np.maximum(words.starts - 1, 0)
            size = words.ends - low
            byte = np.repeat(low - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            owner = np.repeat(np.arange(n), size)
            for lang in range(k):
                part = np.bincount(words.entries, slope[:, lang], minlength=len(weights))
                for grams in words.grams:
                    part += np.bincount(grams[byte], slope[owner, lang], minlength=len(weights))
                grad[:, lang] = part / n
            g2 += grad * grad
            weights -= rate * (grad + penalty * weights / n) / np.sqrt(g2)
            seen = np.zeros((k, k))
            inner = np.setdiff1d(np.arange(n - 1), words.chains[1:] - 1)
            np.add.at(seen, (gold[inner], gold[inner + 1]), 1)
            slope = (both - seen) / n + penalty * move
            m2 += slope * slope
            move = np.clip(move - rate * slope / np.sqrt(m2), -4, 4)
    return Model(langs, weights, move)


def judged(model: Model | None, column) -> tuple[list, list, list]:
    n = len(column)
    lang, score, shares = ["und"] * n, [0.0] * n, [None] * n
    if model is None:
        return lang, score, shares
    for row, stop, data, rows in T.slices(column):
        words = analysed(data, rows)
        if not len(words.starts):
            continue
        chance, _ = marginals(emissions(words, model.weights), words.chains, model.move)
        chance *= words.lettered[:, None]
        count = np.bincount(words.row, words.lettered, minlength=stop - row)
        mean = np.stack([np.bincount(words.row, c, minlength=stop - row) for c in chance.T], 1) / np.maximum(count, 1)[:, None]
        for r in np.flatnonzero(count):
            piece = data[rows[r]:rows[r + 1]]
            if not ((piece | 32) - 97 < 26).any() and not any(c.isalpha() for c in piece.tobytes().decode()):
                continue
            best = int(np.argmax(mean[r]))
            lang[row + r], score[row + r], shares[row + r] = model.langs[best], min(1.0, float(mean[r, best])), mean[r].tolist()
    return lang, score, shares


def labelled(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, shares = judged(model.value, batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(lang), pa.array(score), pa.array(shares, pa.list_(pa.float64()))], ["row", *RESULTS])
    return run


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The other columns of `docs` with `lang_pred`, `score`, and `shares` by learned language."""
    rest = [c for c in docs.columns if c != text and c not in RESULTS]
    rows = bounded_batches(docs).select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.mapInArrow(labelled(sent), f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, shares array<double>")
    return out.select(*[F.col(f"row.`{c}`") for c in rest], *RESULTS)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 120, **names) -> Model | None:
    """Fit on at most `per_class` documents per language; `labels` has doc_id and label."""
    return fit(*samples.labelled(docs, labels, per_class, **names))
