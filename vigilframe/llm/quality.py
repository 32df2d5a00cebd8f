"""Quality classifier by positive-unlabelled learning.

Trusted positives P and unlabelled web text U give, with the class prior pi, the non-negative unbiased risk

    pi * E_P[loss(+)] + max(0, E_U[loss(-)] - pi * E_P[loss(-)])

which needs no negatives.  It is minimised for a logistic model over measurements of the text, each cut into
bins at the quantiles of U.  Where the second part turns negative, its gradient is reversed, as in the
published algorithm.

U is all training rows: their measurements are written once, the quantiles, the class prior, the gradient of
every step of the fit and the level of the scores are aggregates over them, and only sums reach the driver.
`start` rows of U are used to find a starting point, and nothing else.  P are at most `positives` labelled
ones, smallest id hashes first; rows labelled 0 are never used.

The prior is estimated from P and U alone: a first model tells half of P from U, and above any of its margins U
holds at least pi times the share that the other half of P holds there.  So pi is the least ratio of both shares over the margins that
at least half of P reaches, which is exact where some margin is reached by positives only.

Defined results: NULL and empty texts are measured as empty and get a score; without positives every score is
0, without other rows 1; very long texts are measured whole, one at a time; an empty table gives an empty table;
rows are independent; other columns are kept, one named `score` is replaced.
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
from vigilframe.llm.frames import bounded_batches, pick
from vigilframe.session import materialize

BINS = 10
COLUMNS = 18  # measurements
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


def mask_of(values) -> np.ndarray:
    out = np.zeros(256, np.int8)
    out[list(values)] = 1
    return out


CLASSES = {
    "upper": mask_of(range(65, 91)), "digit": mask_of(range(48, 58)), "symbol": mask_of(b"#*$%&|<>{}[]=+~^_@/\\"),
    "shout": mask_of(b"!?"), "stop": mask_of(b".,;:"), "later": mask_of(range(128, 256)),
}


def measurements(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Measurements of each row, in the order of the columns below."""
    starts, ends, offsets = T.spans(data, rows)
    words = T.span_hashes(data, starts, ends)
    n = np.diff(offsets)
    some = np.maximum(n, 1)

    def per_row(marks):
        sums = np.r_[0, np.cumsum(marks, dtype=np.int64)]
        return sums[rows[1:]] - sums[rows[:-1]]

    def per_word(marks):
        sums = np.r_[0, np.cumsum(marks, dtype=np.int64)]
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / some

    ink = np.maximum(per_row(~T.SPACE[data]), 1)
    l_start, l_end, l_border = T.spans(data, rows, NEWLINE)
    l_hash = T.span_hashes(data, l_start, l_end)
    inside = T.row_windows(offsets, 3)
    grams = T.window_hashes(words, 3)[inside] if len(inside) else np.zeros(0, T.U)
    border = np.searchsorted(inside, offsets) if len(inside) else np.zeros(len(offsets), np.int64)
    distinct, most, repeats, lines = [], [], [], []
    for r in range(len(n)):
        _, count = np.unique(words[offsets[r]:offsets[r + 1]], return_counts=True)
        distinct.append(len(count) / some[r])
        most.append(count.max() / some[r] if len(count) else 0)
        own = grams[border[r]:border[r + 1]]
        repeats.append(1 - len(np.unique(own)) / len(own) if len(own) else 0)
        own = l_hash[l_border[r]:l_border[r + 1]]
        lines.append(1 - len(np.unique(own)) / len(own) if len(own) else 0)
    length = ends - starts
    alpha = lambda x: ((x | 32) >= 97) & ((x | 32) <= 122) | (x >= 128)
    first, last = (data[starts], data[ends - 1]) if len(starts) else (np.zeros(0, np.uint8),) * 2
    same = np.r_[False, words[1:] == words[:-1]] if len(words) else np.zeros(0, bool)
    columns = [
        np.log1p(n), ink / some, *[per_row(c[data]) / ink for c in CLASSES.values()],
        per_word(~alpha(first)), per_word(~alpha(last)), per_word(length > 15), per_word(length == 1), per_word(same),
        np.array(distinct) * np.sqrt(np.log1p(n) + 1), np.array(most), np.array(repeats), np.array(lines),
        per_row(NEWLINE[data]) / some,
    ]
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


def measured(column) -> np.ndarray:
    parts = [measurements(data, rows) for _, _, data, rows in T.slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, 1))


TAILS = [0.01, 0.02, 0.05, *[i / BINS for i in range(1, BINS)], 0.95, 0.98, 0.99]
MARGINS = 4096  # bins of the margins' distribution
LEAST_REACH = 0.5


@dataclass
class Model:
    edges: list[np.ndarray]
    weights: np.ndarray
    bias: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        first = np.r_[0, np.cumsum([len(e) + 1 for e in self.edges])]
        return np.stack([first[i] + np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)], axis=1)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[bins].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margins(self.bins(x)))


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def constant(score: float) -> Model:
    return Model([np.zeros(0)] * COLUMNS, np.zeros(COLUMNS), 30.0 if score else -30.0)


def parts(model: Model, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums over rows that any gradient needs: of the scores, by bin and in all, and of the losses of calling a row negative."""
    s = sigmoid(model.margins(bins))
    by_bin = np.bincount(bins.ravel(), np.repeat(s, bins.shape[1]), minlength=len(model.weights))
    return by_bin, s.sum(), float(-np.log(1 - s + 1e-12).sum())


class Descent:
    """Adam steps on the non-negative risk; P's sums come from its rows, U's are handed in as means."""

    def __init__(self, model: Model, positives: np.ndarray, prior: float, rate: float, penalty: float):
        self.model, self.p, self.prior, self.rate, self.penalty = model, positives, prior, rate, penalty
        self.m, self.v, self.t = np.zeros(len(model.weights) + 1), np.zeros(len(model.weights) + 1), 0

    def gradient(self, u_bins: np.ndarray, u_sum: float, u_loss: float) -> tuple[np.ndarray, float]:
        """The slopes of all weights and of the bias, and the risk."""
        model, prior, n = self.model, self.prior, len(self.p)
        p_bins, p_sum, p_loss = parts(model, self.p)
        counts = np.bincount(self.p.ravel(), minlength=len(model.weights))
        positive = float(-np.log(sigmoid(model.margins(self.p)) + 1e-12).mean())
        negative = u_loss - prior * p_loss / n
        # Slopes in the margin: loss(+) has s - 1, loss(-) has s.
        if negative >= 0:
            slopes = np.append(u_bins - prior * counts / n, u_sum - prior)
        else:
            slopes = np.append(prior * p_bins / n - u_bins, prior * p_sum / n - u_sum)
        slopes[:-1] += self.penalty * model.weights
        return slopes, prior * positive + max(0.0, negative)

    def step(self, u_bins: np.ndarray, u_sum: float, u_loss: float) -> None:
        grad, _ = self.gradient(u_bins, u_sum, u_loss)
        self.t += 1
        self.m, self.v = 0.9 * self.m + 0.1 * grad, 0.999 * self.v + 0.001 * grad**2
        step = self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)
        self.model.weights -= step[:-1]
        self.model.bias -= step[-1]


def fit_rows(model: Model, p: np.ndarray, u: np.ndarray, prior: float, steps: int, rate: float, penalty: float) -> Model:
    """The model after steps on the bins of P and of some of U."""
    descent = Descent(model, p, prior, rate, penalty)
    for _ in range(steps):
        by_bin, total, loss = parts(model, u)
        descent.step(by_bin / len(u), total / len(u), loss / len(u))
    return model


def estimated_prior(p: np.ndarray, u_counts: np.ndarray, edges: np.ndarray) -> float:
    """The least ratio of U's share to P's share above a margin, over the margins that `LEAST_REACH` of P reaches."""
    p_counts = np.histogram(np.clip(p, edges[0], edges[-1]), edges)[0]
    above_p, above_u = (np.cumsum(c[::-1])[::-1] / max(1, c.sum()) for c in (p_counts, u_counts))
    reached = above_p >= LEAST_REACH
    return float(min(1.0, (above_u[reached] / above_p[reached]).min())) if reached.any() else 0.0


def border(counts: np.ndarray, edges: np.ndarray, prior: float) -> float:
    """The margin where U is thinnest among those that about the prior's share of U lies above.

    The clipped risk leaves the level of the scores open; their order is what it learns.
    """
    share = np.cumsum(counts[::-1])[::-1] / max(1, counts.sum())
    near = np.flatnonzero(np.abs(share - prior) <= 0.25 * min(prior, 1 - prior))
    if not len(near):
        near = np.array([int(np.argmin(np.abs(share - prior)))])
    width = max(1, len(near) // 64)
    smooth = np.convolve(counts, np.ones(2 * width + 1), "same")[near]
    thin = np.flatnonzero(smooth == smooth.min())
    stretches = np.split(thin, np.flatnonzero(np.diff(thin) > 1) + 1)
    middle = near[(lambda s: (s[0] + s[-1]) // 2)(max(stretches, key=len))]
    return float((edges[middle] + edges[middle + 1]) / 2)


def scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for row, stop, data, rows in T.slices(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(row, stop - row), pa.array(known.score(measurements(data, rows)))], ["row", "score"])
    return run


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The other columns of `docs` with `score`, the chance of the positive class."""
    rest = [c for c in docs.columns if c not in (text, "score")]
    rows = bounded_batches(docs).select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.mapInArrow(scored(sent), f"row {rows.schema['row'].dataType.simpleString()}, score double")
    return out.select(*[F.col(f"row.`{c}`") for c in rest], "score")


def measured_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, stop, data, rows in T.slices(batch.column(0)):
            x = measurements(data, rows)
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(row, stop - row), values], ["h", "x"])


def binned(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            bins = model.value.bins(x).astype("<u2")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b.tobytes() for b in bins], pa.binary())], ["h", "bins"])
    return run


def bins_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1).astype(np.int64)


def summing(model: Model):
    """`parts` of all rows, one list of numbers for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                by_bin, s, loss = parts(model, bins_of(batch.column(0)))
                here = np.concatenate([by_bin, [s, loss, batch.num_rows]])
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "v"])
    return run


def counting(model: Model, edges: np.ndarray):
    """The distribution of the margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(edges) - 1, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.histogram(np.clip(model.margins(bins_of(batch.column(0))), edges[0], edges[-1]), edges)[0]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.float64))], ["i", "v"])
    return run


def added(rows: DataFrame, run, size: int) -> np.ndarray:
    """The sums of what all tasks give, in an array of `size` numbers."""
    out = np.zeros(size)
    for r in rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def distribution(table: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(counts, edges) of U's margins, over all that the model can give."""
    first = np.r_[0, np.cumsum([len(e) + 1 for e in model.edges])]
    ends = [model.bias + sum(end(model.weights[a:b]) for a, b in zip(first[:-1], first[1:])) for end in (min, max)]
    edges = np.linspace(ends[0] - 1e-6, ends[1] + 1e-6, MARGINS + 1)
    return added(table.select("bins"), counting(model, edges), MARGINS), edges


def train(docs: DataFrame, labels: DataFrame, positives: int = 4000, start: int = 6000, steps: int = 600, refine: int = 12,
          rate: float = 0.05, penalty: float = 2e-4, threshold: float = 0.3, **names) -> Model:
    """`docs` are the unlabelled rows, all of which count; of `labels` (doc_id, label) the ones are the trusted positives."""
    ones = labels.filter(F.col(names.get("label", "label")) == 1)
    rows, _ = samples.labelled(docs, ones, positives, **names)
    texts = bounded_batches(pick(docs, doc_id=names.get("doc_id", "doc_id"), text=names.get("text", "text")))
    table = materialize(texts.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(measured_rows, "h bigint, x array<double>"), "measurements")
    n = table.count()
    if not rows or not n:
        return constant(1.0 if rows else 0.0)
    tails = table.agg(*[F.percentile_approx(F.col("x")[i], TAILS, 10_000).alias(f"q{i}") for i in range(COLUMNS)]).first()
    edges = [np.unique(np.array(tails[f"q{i}"], np.float64)) for i in range(COLUMNS)]
    blank = Model(edges, np.zeros(sum(len(e) + 1 for e in edges)), 0.0)
    p = blank.bins(measured(pa.array([t for t, _ in rows], pa.large_string())))
    sent = docs.sparkSession.sparkContext.broadcast(blank)
    table = materialize(table.mapInArrow(binned(sent), "h bigint, bins binary"), "bins")
    rate_of = min(1.0, start / n)
    sampled = table.filter(F.pmod(F.xxhash64("h"), F.lit(1 << 31)) < F.lit(int(rate_of * (1 << 31)) + 1)).select("bins").collect()
    some = bins_of(pa.array([bytes(r["bins"]) for r in sampled], pa.binary())) if sampled else np.zeros((0, COLUMNS), np.int64)
    # Half of P against U, as if all of U were negative, and the prior from the margins of the other half; twice.
    priors = []
    for fitted, judged in ((p[::2], p[1::2]), (p[1::2], p[::2])) if len(p) > 1 and len(some) else ():
        first = fit_rows(Model(edges, blank.weights.copy(), 0.0), fitted, some, 0.5, 150, rate, penalty)
        priors.append(estimated_prior(first.margins(judged), *distribution(table, first)))
    prior = float(np.mean(priors)) if priors else 0.0
    if prior in (0.0, 1.0):
        return constant(prior)
    model = Model(edges, blank.weights.copy(), float(np.log(prior / (1 - prior))))
    if len(some):
        fit_rows(model, p, some, prior, steps, rate, penalty)
    descent = Descent(model, p, prior, rate / 5, penalty)
    for _ in range(refine):
        sums = added(table.select("bins"), summing(model), len(model.weights) + 3) / n
        descent.step(sums[:-3], sums[-3], sums[-2])
    counts, margins = distribution(table, model)
    model.bias += float(np.log(threshold / (1 - threshold))) - border(counts, margins, prior)
    return model
