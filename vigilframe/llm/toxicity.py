"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's chance is a logistic function of the cues in it (words and word beginnings); the document's
is the noisy-or of its sentences, 1 - prod(1 - p).  The weights are trained from document labels only,
through that formula, on at most `per_class` labelled documents of either label (weighted back to their
shares).  Cues are the words and beginnings whose counts differ between the labels beyond chance.
Sentences without any cue have the floor chance.  Scoring gives every sentence its chance, so the offending
ones are located.

Defined results: NULL and empty texts score the floor; without labels of both kinds everything does; rows
are independent, so repeats get equal results; other columns are kept, those named like a result replaced.
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

FLOOR = 1e-6
BEGINNINGS = (4, 5)
LEAST_GAIN = 14.0  # log-likelihood ratio below which a cue is taken for chance
RESULTS = ("score", "sentences")

LETTER = np.ones(256, bool)  # marks what is not part of a word, after lower-casing
LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False
END = np.zeros(256, np.int32)
END[list(b".!?\n")] = 1


def cues(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature hash, row, byte place) of the words and their beginnings; and nothing of how often."""
    starts, ends, offsets = T.spans(data, rows, LETTER)
    row = T.row_of(offsets)
    hashes, owners, places = [T.span_hashes(data, starts, ends)], [row], [starts]
    for size in BEGINNINGS:
        longer = ends - starts > size
        hashes.append(T.mix(T.span_hashes(data, starts[longer], starts[longer] + size) + T.U(size)))
        owners.append(row[longer])
        places.append(starts[longer])
    return np.concatenate(hashes), np.concatenate(owners), np.concatenate(places)


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def sentence_chances(self, hashes, owners, places, sentence_of):
        """(row, sentence, chance) of the sentences that hold a cue."""
        maybe = np.flatnonzero(self.near[(hashes >> T.U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.features, hashes[maybe]), len(self.features) - 1)
        hit = self.features[at] == hashes[maybe]
        maybe, at = maybe[hit], at[hit]
        sentence = sentence_of(places[maybe])
        key, back = np.unique(owners[maybe].astype(np.int64) << 32 | sentence, return_inverse=True)
        z = self.bias + np.bincount(back, self.weights[at], minlength=len(key))
        return key >> 32, key & 0xFFFFFFFF, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def __post_init__(self):
        self.near = np.zeros(1 << 16, bool)
        self.near[(self.features >> T.U(48)).astype(np.int64)] = True


def bags(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cue hashes with document and sentence of each, slice by slice; no document lies in two slices."""
    first = 0
    for row, stop, data, rows in T.slices(pa.array(texts, pa.large_string())):
        data = T.LOWER[data]
        ends = np.cumsum(END[data])
        hashes, owners, places = cues(data, rows)
        yield hashes, owners + row, ends[places] + first
        first += int(ends[-1]) + 1 if len(ends) else 1


def counted(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All cue hashes in order, and how many documents of either label hold each; memory follows the vocabulary."""
    feature, with_it = np.zeros(0, T.U), np.zeros((2, 0), np.int64)
    for hashes, doc, _ in bags(texts):
        values, at = np.unique(hashes, return_inverse=True)
        pairs = np.unique(at.astype(np.int64) * len(y) + doc)
        f, d = pairs // len(y), pairs % len(y)
        here = np.stack([np.bincount(f[y[d] == k], minlength=len(values)) for k in (0, 1)])
        feature, back = np.unique(np.concatenate([feature, values]), return_inverse=True)
        both = np.concatenate([with_it, here], axis=1)
        with_it = np.stack([np.bincount(back, x, minlength=len(feature)).astype(np.int64) for x in both])
    return feature, with_it


def fit(rows: list[tuple[str, int]], totals: dict, steps: int = 150, rate: float = 0.15, penalty: float = 1e-4) -> Model | None:
    y = np.array([int(label) for _, label in rows])
    if len(rows) == 0 or y.min() == y.max():
        return None
    weight = np.array([totals[label] / max(1, sum(1 for _, x in rows if x == label)) for label in (0, 1)])[y]
    weight /= weight.sum()
    texts = [t for t, _ in rows]
    feature, with_it = counted(texts, y)
    n = np.bincount(y, minlength=2)[:, None]
    share = (with_it.sum(0) / n.sum())[None, :]
    expected = np.stack([n * share, n * (1 - share)])
    seen = np.stack([with_it, n - with_it])
    gain = 2 * (seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))).sum(axis=(0, 1))
    chosen = np.flatnonzero((gain >= LEAST_GAIN) & (with_it[1] / n[1] > with_it[0] / n[0]))
    if not len(chosen):
        return None
    feature, held = feature[chosen], []
    for hashes, doc, sentence in bags(texts):
        at = np.minimum(np.searchsorted(feature, hashes), len(feature) - 1)
        hit = feature[at] == hashes
        held.append(np.unique(np.stack([sentence[hit], at[hit], doc[hit]], 1), axis=0))
    pair = np.concatenate(held)
    ids, s = np.unique(pair[:, 0], return_inverse=True)
    f, s_doc = pair[:, 1], np.zeros(len(ids), np.int64)
    s_doc[s] = pair[:, 2]
    w, bias = np.full(len(chosen), 1.0), -4.0
    g2, b2 = np.full(len(chosen), 1e-8), 1e-8
    for _ in range(steps):
        z = np.clip(bias + np.bincount(s, w[f], minlength=len(ids)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        rest = np.exp(np.bincount(s_doc, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(rows)))
        toxic = np.clip(1 - rest, FLOOR, 1 - 1e-9)
        # d loss / d z of a sentence: p for clean documents, -p * rest / toxic for toxic ones
        slope = weight[s_doc] * np.where(y[s_doc] == 1, -p * rest[s_doc] / toxic[s_doc], p)
        grad = np.bincount(f, slope[s], minlength=len(w)) + penalty * w / len(w)
        g2, b2 = g2 + grad**2, b2 + slope.sum() ** 2
        w -= rate * grad / np.sqrt(g2)
        bias -= rate * slope.sum() / np.sqrt(b2)
    return Model(feature, w, float(bias))


def scored(model):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            clean = np.zeros(len(batch))
            found: list[list] = [[] for _ in range(len(batch))]
            for row, _, data, rows in T.slices(batch.column(0)) if known is not None else ():
                later = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
                data = T.LOWER[data]
                breaks = np.flatnonzero(END[data])
                owner, sentence, p = known.sentence_chances(*cues(data, rows), lambda places: np.searchsorted(breaks, places))
                clean[row:row + len(rows) - 1] += np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(rows) - 1)
                for r, s, chance in zip(owner.tolist(), sentence.tolist(), p.tolist()):
                    if chance >= 0.3:
                        low = max(int(rows[r]), int(breaks[s - 1]) + 1 if s else 0)
                        high = min(int(rows[r + 1]), int(breaks[s]) + 1 if s < len(breaks) else len(data))
                        base = later[rows[r]]
                        found[row + r].append({"start": int(later[low] - base), "end": int(later[high] - base), "score": chance})
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(np.maximum(1 - np.exp(clean), FLOOR)), pa.array(found, pa.list_(span))], ["row", *RESULTS])
    return run


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The other columns of `docs` with `score` and the offending `sentences` (start, end in code points, score)."""
    rest = [c for c in docs.columns if c != text and c not in RESULTS]
    rows = bounded_batches(docs).select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.mapInArrow(scored(sent), f"row {rows.schema['row'].dataType.simpleString()}, score double, "
                                        "sentences array<struct<start:bigint,end:bigint,score:double>>")
    return out.select(*[F.col(f"row.`{c}`") for c in rest], *RESULTS)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, **names) -> Model | None:
    """Fit on at most `per_class` documents of either label; `labels` has doc_id and label 0 or 1."""
    return fit(*samples.labelled(docs, labels, per_class, **names))
