"""Isolation forest (Liu, Ting & Zhou 2008) on Spark, from numbers that any engine can repeat.

Everything random is drawn by SHA-256 of the seed, the forest, the tree and the node, so a forest depends on neither the
partitioning nor the way it is grown, and SQL can grow the same one.  Nodes are numbered as in a heap: the root is 1, the
children of k are 2k and 2k + 1.  A node takes one of its features that are not constant in the tree's sub-sample and cuts
between the least and the most value there.

The sub-samples come from one random order of all rows: `ranked` gives every row its place r by the hash of its keys, and
tree t takes the rows with (a * r + b) mod n < psi for its own a, without a common divisor with n, and b.  So every tree
draws exactly psi rows, from all rows, and no row is tested against all trees.

Two ways lead to the same path lengths.  Forests of bounded sub-samples are grown by one task per tree and sent to the
rows.  Forests of larger sub-samples, such as a share of the table, are never gathered: rows carry their node, each level
is one aggregate of least and most value by forest, tree and node, and rows outside a tree's sub-sample travel with the
others.  As soon as a node has at most `LEAF_ROWS` rows one task finishes the tree below it.  Tables of at most
`WHOLE_LEAVES` times as many rows are dealt, packed, to one task for each batch of trees.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilframe.functions.stats import below_quantile, inverse_min_max
from vigilframe.operators.prepare import fill_features
from vigilframe.session import materialize

TREES = 100
PSI = 256
LEAF_ROWS = 1 << 20      # rows of a node that one task finishes, 40 MB for five features
WHOLE_LEAVES = 8         # times as many rows of a table whose trees one task grows whole, some 100 bytes a row
MODEL_NODES = 1 << 21    # nodes of all forests that are sent to the rows at once
TREE_BATCH = 25          # trees that one task grows over the same rows
BLOCK_ROWS = 1 << 16     # rows that are packed into one
SMALL_ROWS = 1 << 14     # rows of a node that is met together with others
FEW = 64                 # nodes of a level that are met one by one, not all at once
BATCH_BYTES = 16 << 20   # of an Arrow batch of packed rows
BUCKETS = 16 ** 4        # of the order of rows
DIGITS = 16.0 ** 13      # a draw has 13 hexadecimal digits
NODES = "forest int, tree int, node bigint, feature int, cut double, length double"


@dataclass(frozen=True)
class ForestSpec:
    """One forest of a fit: sub-sample size, share of the features per tree."""

    forest: int
    psi: int
    max_features: float = 1.0


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def depth_limit(psi: int) -> int:
    return math.ceil(math.log2(max(psi, 2)))


def scores(totals: np.ndarray, trees: int, psi: int) -> np.ndarray:
    """Negated anomaly score, close to -1 for outliers, from the summed path lengths.

    Sums are rounded to nine digits, so that their order does not matter.
    """
    return -np.power(2.0, -np.round(totals, 9) / trees / max(average_path(psi), 1e-12))


class Draws:
    """The random numbers of one tree."""

    def __init__(self, seed: int, forest: int, tree: int):
        self.name = f"{seed}-{forest}-{tree}-"

    def hexadecimal(self, what: str) -> str:
        return hashlib.sha256((self.name + what).encode()).hexdigest()

    def number(self, what: str) -> float:
        return int(self.hexadecimal(what)[:13], 16) / DIGITS

    def of_nodes(self, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers below 1 for each node: which feature, and where to cut."""
        name = hashlib.sha256((self.name + "n").encode())
        digests = []
        for node in nodes:
            digest = name.copy()
            digest.update(b"%d" % node)
            digests.append(digest.digest())
        found = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
        first, second = (np.ascontiguousarray(found[:, at:at + 8]).view(">u8").ravel().astype(np.uint64) for at in (0, 6))
        return (first >> 12).astype(np.float64) / DIGITS, ((second << 4) >> 12).astype(np.float64) / DIGITS  # digits 1-13 and 14-26

    def features(self, n: int, share: float) -> np.ndarray:
        """The features that the tree may use, in order."""
        order = sorted(range(n), key=lambda j: self.hexadecimal(f"f{j}"))
        return np.array(sorted(order[:max(1, int(share * n))]))

    def sample(self, n: int) -> tuple[int, int]:
        """a and b of the tree's sub-sample: the rows with (a * r + b) mod n < psi."""
        a = max(1, int(self.number("a") * n))
        while math.gcd(a, n) != 1:
            a += 1
        return a, int(self.number("b") * n)


def inside(r: np.ndarray, a: int, b: int, n: int, psi: int) -> np.ndarray:
    """Whether the rows at the places r are in the sub-sample, for tables of at most `LEAF_ROWS` rows."""
    return (a * r.astype(np.int64) + b) % n < psi


def cuts(x: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, allowed: np.ndarray, draws: Draws) -> tuple[np.ndarray, np.ndarray]:
    """(feature or -1, cut) of nodes from the sampled rows, which lie node by node."""
    starts, part = np.cumsum(sizes) - sizes, x[:, allowed]
    return node_cuts(np.minimum.reduceat(part, starts), np.maximum.reduceat(part, starts), nodes, allowed, draws)


def node_cuts(least: np.ndarray, most: np.ndarray, nodes: np.ndarray, allowed: np.ndarray, draws: Draws) -> tuple[np.ndarray, np.ndarray]:
    """(feature or -1, cut) from the least and most values of the allowed features."""
    free = most > least
    number = free.sum(axis=1)
    feature, cut = np.full(len(nodes), -1), np.zeros(len(nodes))
    inner = np.flatnonzero(number)
    which, where = draws.of_nodes(nodes[inner].tolist())
    wanted = np.minimum((which * number[inner]).astype(np.int64), number[inner] - 1)
    chosen = (np.cumsum(free[inner], axis=1) == (wanted + 1)[:, None]).argmax(axis=1)
    feature[inner], cut[inner] = allowed[chosen], cut_between(least[inner, chosen], most[inner, chosen], where)
    return feature, cut


def cut_between(low: np.ndarray, high: np.ndarray, where: np.ndarray) -> np.ndarray:
    drawn = low + where * (high - low)
    return np.where(drawn < high, drawn, low)


def grow(x: np.ndarray, allowed: np.ndarray, draws: Draws, limit: int) -> pd.DataFrame:
    """The nodes of a tree over its sub-sample: node, feature, cut, length (of a leaf)."""
    node, depth, levels = np.ones(len(x), np.int64), 0, []
    while len(x):
        nodes, sizes = np.unique(node, return_counts=True)
        feature, cut = (np.full(len(nodes), -1), np.zeros(len(nodes))) if depth == limit else cuts(x, sizes, nodes, allowed, draws)
        length = np.where(feature < 0, depth + np.array([average_path(s) for s in sizes.tolist()]), 0.0)
        levels.append(pd.DataFrame({"node": nodes, "feature": feature, "cut": cut, "length": length}))
        at = np.repeat(np.arange(len(nodes)), sizes)
        held = feature[at] >= 0
        x, at = x[held], at[held]
        node = 2 * nodes[at] + (x[np.arange(len(x)), feature[at]] > cut[at])
        order = np.argsort(node, kind="stable")
        x, node, depth = x[order], node[order], depth + 1
    return pd.concat(levels)


def average_paths(sizes: np.ndarray) -> np.ndarray:
    n = np.maximum(sizes, 3).astype(np.float64)
    long = 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n
    return np.where(sizes <= 1, 0.0, np.where(sizes == 2, 1.0, long))


class Table:
    """Rows in the order of their features, each feature as the number of its value among the distinct ones; -1 is NaN.

    In this order rows that differ in one feature only are sorted by it, so nothing is sorted for a tree.
    """

    def __init__(self, columns: Iterable[np.ndarray]):
        """`columns` are met one by one, so that each may be made just then and go when it is coded."""
        self.values, self.codes, key, width = [], [], None, 1
        for column in columns:
            values = np.sort(column)
            values = values[:len(values) - np.count_nonzero(np.isnan(values))]  # NaN is last
            values = values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values
            code = np.empty(len(column), np.int32)
            for at in range(0, len(column), BLOCK_ROWS):
                some = column[at:at + BLOCK_ROWS]
                code[at:at + BLOCK_ROWS] = np.where(np.isnan(some), -1, np.searchsorted(values, some))
            del column, some  # before the next is met
            size = len(values) + 1
            if key is not None and width * size > 1 << 62:
                key = np.unique(key, return_inverse=True)[1]
                width = int(key.max(initial=0)) + 1
            key, width = (code + 1).astype(np.int64) if key is None else key * size + (code + 1), width * size
            self.values.append(values)
            self.codes.append(code)
        self.order = np.argsort(key).astype(np.int32)  # of a table of at most WHOLE_LEAVES * LEAF_ROWS rows
        del key
        for j, code in enumerate(self.codes):
            self.codes[j] = code[self.order]


def part_ends(code: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most of each part of `code`; no part is empty."""
    if len(starts) <= FEW:
        parts = [code[a:a + k] for a, k in zip(starts.tolist(), sizes.tolist())]
        return np.array([p.min() for p in parts]), np.array([p.max() for p in parts])
    return np.minimum.reduceat(code, starts), np.maximum.reduceat(code, starts)


class Rows:
    """Rows of the nodes of a level, node by node: their places in the table, and the codes of the features that still vary."""

    def __init__(self, at: np.ndarray, codes: dict[int, np.ndarray], sizes: np.ndarray):
        self.at, self.codes, self.sizes = at, codes, sizes
        self.starts = np.cumsum(sizes) - sizes

    def pick(self, nodes: np.ndarray, features) -> Rows:
        """The rows of some nodes, with some features."""
        if nodes.all():
            return Rows(self.at, {f: self.codes[f] for f in features}, self.sizes)
        chosen = np.flatnonzero(nodes)
        if len(chosen) <= FEW:
            spans = [slice(a, a + k) for a, k in zip(self.starts[chosen].tolist(), self.sizes[chosen].tolist())]

            def of(array):
                return np.concatenate([array[s] for s in spans]) if len(spans) > 1 else array[spans[0]]
        else:
            where = np.flatnonzero(np.repeat(nodes, self.sizes))

            def of(array):
                return array.take(where)
        return Rows(of(self.at), {f: of(self.codes[f]) for f in features}, self.sizes[chosen])

    def split(self, feature: np.ndarray, most: np.ndarray) -> Rows:
        """The children: first those of the rows whose code is at most `most` in the node's feature, then the others."""
        high = np.empty(len(self.at), bool)
        if len(feature) <= FEW:
            rights = np.empty(len(feature), np.int64)
            for i, (a, k, f, m) in enumerate(zip(self.starts.tolist(), self.sizes.tolist(), feature.tolist(), most.tolist())):
                np.greater(self.codes[f][a:a + k], m, out=high[a:a + k])
                rights[i] = np.count_nonzero(high[a:a + k])
        else:
            high[:] = False
            for f in np.unique(feature).tolist():
                high |= self.codes[f] > np.repeat(np.where(feature == f, most, np.iinfo(np.int32).max).astype(np.int32), self.sizes)
            upto = np.concatenate([[0], np.cumsum(high, dtype=np.int32)])
            rights = (upto[self.starts + self.sizes] - upto[self.starts]).astype(np.int64)
        order = np.concatenate([np.flatnonzero(~high), np.flatnonzero(high)])
        del high
        codes = {f: code.take(order) for f, code in self.codes.items()}
        return Rows(self.at.take(order), codes, np.concatenate([self.sizes - rights, rights]))

    def sorted_keys(self, feature: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and the numbers node * span + code + 1, in ascending order; the table's order mostly has them so."""
        keys = self.codes[feature].astype(np.int64) + 1
        if len(self.sizes) > 1:
            keys += np.repeat(np.arange(len(self.sizes)) * span, self.sizes)
        if (keys[1:] >= keys[:-1]).all():
            return self.at, keys
        order = np.argsort(keys, kind="stable")
        return self.at[order], keys[order]


def add_line_lengths(total: np.ndarray, values: np.ndarray, feature: int, some: Rows, rest: Rows, nodes: np.ndarray, depth: np.ndarray,
                     draws: Draws, limit: int) -> None:
    """Add the path lengths below nodes whose sampled rows differ in one feature only: cuts are searched in the sorted rows."""
    span = len(values) + 1
    (at, keys), (rest_at, rest_keys) = some.sorted_keys(feature, span), rest.sorted_keys(feature, span)
    base = np.arange(len(nodes)) * span
    spans = np.stack([some.starts, some.starts + some.sizes, rest.starts, rest.starts + rest.sizes])
    leaves = []
    while len(nodes):
        least, most = keys[spans[0]] - base, keys[spans[1] - 1] - base
        inner = (most > least) & (depth < limit)
        done = spans[:, ~inner]
        leaves.append((done, depth[~inner] + average_paths(done[1] - done[0])))
        spans, nodes, base, depth = spans[:, inner], nodes[inner], base[inner], depth[inner]
        if not len(nodes):
            break
        cut = cut_between(values[least[inner] - 1], values[most[inner] - 1], draws.of_nodes(nodes.tolist())[1])
        last = base + np.searchsorted(values, cut, "right")
        middle, rest_middle = keys.searchsorted(last, "right"), rest_keys.searchsorted(last, "right")
        spans = np.concatenate([np.stack([spans[0], middle, spans[2], rest_middle]), np.stack([middle, spans[1], rest_middle, spans[3]])], axis=1)
        nodes, base, depth = np.concatenate([2 * nodes, 2 * nodes + 1]), np.concatenate([base, base]), np.concatenate([depth + 1, depth + 1])
    spans, length = np.concatenate([s for s, _ in leaves], axis=1), np.concatenate([v for _, v in leaves])
    order = np.argsort(spans[0])
    spans, length = spans[:, order], length[order]
    total[at] += np.repeat(length, spans[1] - spans[0])
    total[rest_at] += np.repeat(length, spans[3] - spans[2])


def add_level_lengths(total: np.ndarray, table: Table, some: Rows, rest: Rows, nodes: np.ndarray, depth: np.ndarray, draws: Draws, limit: int) -> None:
    """Add the path lengths below many nodes, all of them by one level after another, grown from the rows `some`.

    Nodes whose sampled rows differ in one feature at most leave the level with their rows.
    """
    while len(nodes):
        features = list(some.codes)
        ends = {f: part_ends(some.codes[f], some.starts, some.sizes) for f in features}
        vary = {f: most > least for f, (least, most) in ends.items()}
        free = {f: vary[f] & (least >= 0) for f, (least, most) in ends.items()}  # not while a sampled row has NaN, but maybe below
        leaf = ~np.any([*free.values(), np.zeros(len(nodes), bool)], axis=0) | (depth == limit)
        line = ~leaf & (sum(vary.values(), np.zeros(len(nodes), np.int64)) == 1)
        if leaf.any():
            length = depth[leaf] + average_paths(some.sizes[leaf])
            for part in (some.pick(leaf, []), rest.pick(leaf, [])):
                total[part.at] += np.repeat(length, part.sizes)
        for f in free:
            chosen = line & free[f]
            if chosen.any():
                add_line_lengths(total, table.values[f], f, some.pick(chosen, [f]), rest.pick(chosen, [f]), nodes[chosen], depth[chosen], draws, limit)
        inner = ~leaf & ~line
        if not inner.any():
            return
        features = [f for f in features if vary[f][inner].any()]
        least, most = (np.stack([np.where(free[f], table.values[f][ends[f][end]], 0.0)[inner] for f in features], axis=1) for end in (0, 1))
        some, rest, nodes, depth = some.pick(inner, features), rest.pick(inner, features), nodes[inner], depth[inner]
        feature, cut = node_cuts(least, most, nodes, np.array(features), draws)
        last = np.empty(len(nodes), np.int64)
        for f in np.unique(feature).tolist():
            last[feature == f] = np.searchsorted(table.values[f], cut[feature == f], "right") - 1
        some, rest = some.split(feature, last), rest.split(feature, last)
        nodes, depth = np.concatenate([2 * nodes, 2 * nodes + 1]), np.concatenate([depth + 1, depth + 1])


def divided(at: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places that are not `high`, and those that are, mostly neighbours in the table's order."""
    number, first = np.count_nonzero(high), int(high.argmax()) if len(high) else 0
    if high[first:first + number].all():
        return np.concatenate([at[:first], at[first + number:]]), at[first:first + number]
    return at.take(np.flatnonzero(~high)), at.take(np.flatnonzero(high))


def add_lengths(total: np.ndarray, table: Table, sampled: np.ndarray, allowed: np.ndarray, draws: Draws, limit: int, root: int = 1, depth: int = 0) -> None:
    """Add to `total` the path lengths of all rows of the table below the node `root`, grown from those that are sampled.

    Large nodes are met one by one, as places in the table with the rows of each feature's ends, which a child mostly takes
    over; small ones in groups, level by level.
    """
    codes, groups, held = table.codes, [], 0

    def ends_of(at: np.ndarray, f: int) -> tuple:
        code = codes[f].take(at)
        return at[code.argmin()], at[code.argmax()]

    def finish() -> None:
        nodes, depths, some, rest = zip(*groups)
        parts = []
        for ats in (some, rest):
            at = np.concatenate(ats)
            parts.append(Rows(at, {f: codes[f].take(at) for f in allowed.tolist()}, np.array([len(a) for a in ats])))
        groups.clear()
        add_level_lengths(total, table, *parts, np.array(nodes), np.array(depths), draws, limit)

    some, rest = (np.flatnonzero(inside).astype(np.int32) for inside in (sampled, ~sampled))
    stack = [(root, depth, some, rest, None)]
    del some, rest
    while stack:
        node, depth, some, rest, ends = stack.pop()
        if len(some) + len(rest) <= SMALL_ROWS:
            groups.append((node, depth, some, rest))
            held += len(some) + len(rest)
            if held > 8 * SMALL_ROWS:
                finish()
                held = 0
            continue
        if ends is None:
            ends = {f: ends_of(some, f) for f in allowed.tolist()}
        ends = {f: (a, b) for f, (a, b) in ends.items() if codes[f][a] < codes[f][b]}
        free = [f for f, (a, b) in ends.items() if codes[f][a] >= 0]
        if depth == limit or not free:
            total[some] += depth + average_path(len(some))
            total[rest] += depth + average_path(len(some))
            continue
        if len(ends) == 1:
            f, = free
            parts = [Rows(at, {f: codes[f].take(at)}, np.array([len(at)])) for at in (some, rest)]
            add_line_lengths(total, table.values[f], f, *parts, np.array([node]), np.array([depth]), draws, limit)
            continue
        which, where = (float(v[0]) for v in draws.of_nodes([node]))
        f = free[min(int(which * len(free)), len(free) - 1)]
        values, code = table.values[f], codes[f]
        cut = cut_between(values[code[ends[f][0]]], values[code[ends[f][1]]], where)
        last = int(np.searchsorted(values, cut, "right")) - 1
        some, rest = (divided(at, code.take(at) > last) for at in (some, rest))
        for high in (0, 1):
            taken = {g: e if all((code[at] > last) == high for at in e) else ends_of(some[high], g) for g, e in ends.items()}
            stack.append((2 * node + high, depth + 1, some[high], rest[high], taken))
    if groups:
        finish()


def lengths(x: np.ndarray, sampled: np.ndarray, allowed: np.ndarray, draws: Draws, limit: int, root: int = 1, depth: int = 0) -> np.ndarray:
    """Path lengths of all rows below the node `root`, grown from those that are sampled."""
    table, total, out = Table(x[:, j].copy() for j in range(x.shape[1])), np.zeros(len(x)), np.empty(len(x))
    add_lengths(total, table, sampled[table.order], allowed, draws, limit, root, depth)
    out[table.order] = total
    return out


def ranked(df: DataFrame, keys: list[str], features: list[str], seed: int) -> DataFrame:
    """The features and `r`, the row's place in a random order: by the hash of the keys, then by the features.

    Places are counted within 65,536 buckets of the hash, after the rows of the buckets before.
    """
    digest = F.sha2(F.concat_ws("-", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]), 256)
    base = df.select(digest.alias("digest"), *features).withColumn("bucket", F.conv(F.substring("digest", 1, 4), 16, 10).cast("int"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over one row a bucket, 65,536 at most
    starts = base.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("digest", *features)) - 1
    return base.withColumn("place", place).join(F.broadcast(starts), "bucket").select((F.col("before") + F.col("place")).alias("r"), *features)


class Forest:
    """Node tables of a forest, one row per tree: split feature (-1 at a leaf), cut, children, path length."""

    def __init__(self, psi: int, nodes: pd.DataFrame):
        self.psi = psi
        trees = nodes["tree"].max() + 1
        nodes = nodes.sort_values(["tree", "node"])
        row = nodes["tree"].to_numpy()
        column = nodes.groupby("tree").cumcount().to_numpy()
        shape = (trees, int(column.max()) + 1)
        place = {key: c for key, c in zip(zip(row.tolist(), nodes["node"].tolist()), column.tolist())}

        def table(values, fill, kind):
            out = np.full(shape, fill, kind)
            out[row, column] = values
            return out

        children = [[place.get((t, 2 * k + side), 0) for t, k in zip(row.tolist(), nodes["node"].tolist())] for side in (0, 1)]
        self.feature = table(nodes["feature"].to_numpy(), -1, np.int32)
        self.cut, self.length = table(nodes["cut"].to_numpy(), 0.0, float), table(nodes["length"].to_numpy(), 0.0, float)
        low, high = (table(c, 0, np.int32) for c in children)
        self.children = np.stack([high, low], axis=2).reshape(trees, -1)  # of node k at 2k and 2k + 1
        at = np.arange(shape[1], dtype=np.int32)
        leaf = np.repeat(self.feature < 0, 2, axis=1)
        self.children = np.where(leaf, np.repeat(at, 2)[None, :], self.children).astype(np.int32)  # a leaf leads to itself

    def totals(self, x: np.ndarray, counts: list[int]) -> list[np.ndarray]:
        """Path lengths of every row, summed over the first trees of each count."""
        out, total, rows = {}, np.zeros(len(x)), np.arange(len(x))
        flat = np.ascontiguousarray(x.T).ravel()  # feature f of row i at f * len(x) + i
        for tree in range(len(self.feature)):
            cut, children = self.cut[tree], self.children[tree]
            start = np.maximum(self.feature[tree], 0).astype(np.int64) * len(x)
            node = np.zeros(len(x), np.int32)
            while True:
                goes_low = flat.take(start.take(node) + rows) <= cut.take(node)
                below = children.take(2 * node + goes_low)
                if np.array_equal(below, node):
                    break
                node = below
            total = total + self.length[tree].take(node)
            out[tree + 1] = total
        return [out[c] for c in counts]


def sampled(rows: DataFrame, specs: list[ForestSpec], features: list[str], trees: int, seed: int, n: int) -> DataFrame:
    """The sub-samples of all trees: forest, tree and the features; exactly psi rows (or all) each.

    The places in the sub-sample are solved for r, so only they meet the rows.
    """
    places = []
    for spec in specs:
        for tree in range(trees):
            a, b = Draws(seed, spec.forest, tree).sample(n)
            places.append((spec.forest, tree, pow(a, -1, n) if n > 1 else 0, b, min(spec.psi, n)))
    spark = rows.sparkSession
    wide = "CAST({} AS DECIMAL(19, 0))"
    back = f"CAST(pmod({wide.format('inverse')} * {wide.format(f'j + {n} - b')}, {wide.format(n)}) AS BIGINT)"
    drawn = spark.createDataFrame(places, "forest int, tree int, inverse bigint, b bigint, psi bigint").selectExpr(
        "*", "explode(sequence(0L, psi - 1)) AS j").selectExpr("forest", "tree", f"{back} AS r")
    return rows.join(F.broadcast(drawn), "r").select("forest", "tree", *features)  # at most MODEL_NODES rows


def fit_forests(
    rows: DataFrame, features: list[str], specs: list[ForestSpec], trees: int, seed: int, n: int
) -> dict[int, Forest]:
    """Grow all trees of all forests in one job, one task group of psi rows per tree.  `rows` come from `ranked`."""
    if not n:
        return {}
    if 2 * trees * sum(min(s.psi, n) for s in specs) > MODEL_NODES:
        raise ValueError("forests of so many nodes do not travel; use forest_totals")
    share = {s.forest: s.max_features for s in specs}

    def grow_one(pdf: pd.DataFrame) -> pd.DataFrame:
        forest, tree = int(pdf["forest"].iloc[0]), int(pdf["tree"].iloc[0])
        draws = Draws(seed, forest, tree)
        nodes = grow(pdf[features].to_numpy(np.float64), draws.features(len(features), share[forest]), draws, depth_limit(len(pdf)))
        return nodes.assign(forest=forest, tree=tree)[["forest", "tree", "node", "feature", "cut", "length"]]

    grown = sampled(rows, specs, features, trees, seed, n).groupBy("forest", "tree").applyInPandas(grow_one, NODES).toPandas()
    return {s.forest: Forest(min(s.psi, n), grown[grown["forest"] == s.forest]) for s in specs}


def travelling(spec: ForestSpec, trees: int, n: int) -> bool:
    return 2 * trees * min(spec.psi, n) <= MODEL_NODES // 4


def model_totals(rows: DataFrame, features: list[str], forests: dict[int, Forest], counts: list[int]) -> DataFrame:
    """forest, n (of `counts`) and score of every row, from forests that travel."""
    shared = rows.sparkSession.sparkContext.broadcast(forests)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x = pdf[features].to_numpy(np.float64)
            for forest, model in shared.value.items():
                for n, total in zip(counts, model.totals(x, counts)):
                    yield pd.DataFrame({"forest": forest, "n": n, "score": scores(total, n, model.psi)})

    return rows.select(*features).mapInPandas(walk, "forest int, n int, score double")


def packed(rows: DataFrame, features: list[str]) -> DataFrame:
    """`rows` of at most `WHOLE_LEAVES * LEAF_ROWS` places as binary blocks: r (4 bytes a row) and the features (8 bytes)."""
    names = ["r", *features]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                held.append([batch[0].to_numpy(zero_copy_only=False).astype("<i4"), *[
                    batch[j].to_numpy(zero_copy_only=False).astype("<f8") for j in range(1, len(names))]])
                size += batch.num_rows
            if held and (batch is None or size >= BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(c).tobytes()], pa.binary()) for c in zip(*held)], names)
                held, size = [], 0

    return rows.select("r", *[F.col(f).cast("double").alias(f) for f in features]).mapInArrow(pack, ", ".join(f"`{c}` binary" for c in names))


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most `BATCH_BYTES` for the plans that run inside; a row here is a block of rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def whole_table_scores(rows: DataFrame, features: list[str], specs: list[ForestSpec], trees: int, counts: list[int], seed: int, n: int) -> DataFrame:
    """forest, n (of `counts`) and score of every row; the table has `WHOLE_LEAVES * LEAF_ROWS` rows at most.

    A task grows a batch of trees over all rows, which come to it in blocks, and gives its sums in blocks of places.
    """
    borders = sorted({*range(0, trees, TREE_BATCH), *counts, trees})
    parts = [(spec, first, last) for spec in specs for first, last in zip(borders[:-1], borders[1:])]
    size, psis = BLOCK_ROWS, {s.forest: min(s.psi, n) for s in specs}

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filled, r, columns = None, 0, np.empty(n, np.int32), []
        for batch in batches:
            columns = columns or [np.empty(n) for _ in features]
            for i in range(batch.num_rows):
                part, block = batch[0][i].as_py(), [np.frombuffer(batch[j][i].as_buffer(), "<f8" if j > 1 else "<i4") for j in range(1, batch.num_columns)]
                for column, piece in zip([r, *columns], block):
                    column[filled:filled + len(piece)] = piece
                filled += len(block[0])
        if part is None:
            return
        spec, first, last = parts[part]
        columns.reverse()
        table, psi = Table(columns.pop() for _ in features), psis[spec.forest]
        r, total = r[table.order], np.zeros(n)
        for tree in range(first, last):
            draws = Draws(seed, spec.forest, tree)
            add_lengths(total, table, inside(r, *draws.sample(n), n, psi), draws.features(len(features), spec.max_features), draws, depth_limit(psi))
        del table
        placed = np.empty(n, "<f8")
        placed[r] = total
        for block, at in enumerate(range(0, n, size)):
            yield pa.RecordBatch.from_pydict(
                {"forest": pa.array([spec.forest], pa.int32()), "first": pa.array([first], pa.int32()), "block": pa.array([block], pa.int32()),
                 "total": pa.array([placed[at:at + size].tobytes()], pa.binary())})

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        forest, pdf = int(pdf["forest"].iloc[0]), pdf.sort_values("first")
        sums, out = 0.0, {}
        for first, total in zip(pdf["first"].tolist(), pdf["total"]):
            if first in counts:
                out[first] = sums
            sums = sums + np.frombuffer(total, "<f8")
        out[trees] = sums
        return pd.concat([pd.DataFrame({"forest": forest, "n": c, "score": scores(out[c], c, psis[forest])}) for c in counts])

    with small_batches(rows.sparkSession):
        dealt = packed(rows, features).select(F.explode(F.sequence(F.lit(0), F.lit(len(parts) - 1))).alias("part"), "r", *features)
        grown = materialize(dealt.repartitionById(len(parts), F.col("part")).mapInArrow(finish, "forest int, first int, block int, total binary"), "path-lengths")
        return materialize(grown.groupBy("forest", "block").applyInPandas(score, "forest int, n int, score double"), "forest-scores")


def level_totals(rows: DataFrame, features: list[str], specs: list[ForestSpec], trees: int, seed: int, n: int) -> DataFrame:
    """forest, part (the tree), r and its path length, grown level by level until nodes have `LEAF_ROWS` rows at most."""
    by_id, limit = {s.forest: s for s in specs}, {s.forest: depth_limit(min(s.psi, n)) for s in specs}
    drawn = []
    for spec in specs:
        for tree in range(trees):
            drawn.append((spec.forest, tree, *Draws(seed, spec.forest, tree).sample(n), min(spec.psi, n)))
    sample = rows.sparkSession.createDataFrame(drawn, "forest int, tree int, draw_a bigint, draw_b bigint, draw_psi bigint")
    kind = "BIGINT" if n < 3_000_000_000 else "DECIMAL(19, 0)"
    state = rows.select("r", *features, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).select(
        "*", F.explode(F.array(*[F.lit(s.forest) for s in specs])).alias("forest")).join(F.broadcast(sample), ["forest", "tree"]).select(
        "forest", "tree", F.lit(1).cast("bigint").alias("node"), "r",
        F.expr(f"pmod(CAST(draw_a AS {kind}) * CAST(r AS {kind}) + draw_b, CAST({n} AS {kind})) < draw_psi").alias("some"), *features)
    node = ["forest", "tree", "node"]
    done, depth = None, 0

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        spec, tree, root = by_id[int(pdf["forest"].iloc[0])], int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        draws = Draws(seed, spec.forest, tree)
        found = lengths(pdf[features].to_numpy(np.float64), pdf["some"].to_numpy(), draws.features(len(features), spec.max_features),
                        draws, limit[spec.forest], root, root.bit_length() - 1)
        return pd.DataFrame({"forest": spec.forest, "part": tree, "r": pdf["r"].to_numpy(), "total": found})

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for (forest, tree), some in pdf.groupby(["forest", "tree"]):
                draws = Draws(seed, int(forest), int(tree))
                allowed = draws.features(len(features), by_id[int(forest)].max_features)
                least, most = (some[[f"{side}_{f}" for f in features]].to_numpy(np.float64)[:, allowed] for side in ("least", "most"))
                feature, at = node_cuts(least, most, some["node"].to_numpy(), allowed, draws)
                feature[some["node"].map(lambda k: int(k).bit_length() - 1).to_numpy() >= limit[int(forest)]] = -1
                mean = [average_path(int(s)) for s in some["sampled"]]
                out.append(some[node].assign(n_rows=some["n_rows"], feature=feature, cut=at, mean=mean))
            yield pd.concat(out) if out else pd.DataFrame(columns=[*node, "n_rows", "feature", "cut", "mean"])

    while True:
        state = materialize(state, f"forest-level-{depth}")
        ends = [F.min(F.when(F.col("some"), F.col(f))).alias(f"least_{f}") for f in features] + [
            F.max(F.when(F.col("some"), F.col(f))).alias(f"most_{f}") for f in features]
        sizes = state.groupBy(*node).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("some").alias("sampled"), *ends)
        found = materialize(sizes.mapInPandas(cut, "forest int, tree int, node bigint, n_rows bigint, feature int, cut double, mean double"), "forest-cuts")
        met = state.join(found, node)
        small = F.col("n_rows") <= LEAF_ROWS
        below = met.filter(small).groupBy(*node).applyInPandas(finish, "forest int, part int, r bigint, total double")
        leaf = met.filter(~small & (F.col("feature") < 0)).select("forest", F.col("tree").alias("part"), "r", (F.lit(depth) + F.col("mean")).alias("total"))
        done = below.unionByName(leaf) if done is None else done.unionByName(below).unionByName(leaf)
        inner = ~small & (F.col("feature") >= 0)
        if found.filter(inner).isEmpty():
            return done
        value = F.element_at(F.array(*features), F.col("feature") + 1)
        state = met.filter(inner).select("forest", "tree", (2 * F.col("node") + (value > F.col("cut")).cast("bigint")).alias("node"), "r", "some", *features)
        depth += 1


def forest_totals(
    rows: DataFrame, features: list[str], specs: list[ForestSpec], counts: list[int], seed: int, n: int
) -> DataFrame:
    """`score` of every row in the first trees of every forest: forest, n (of `counts`), score.

    `rows` come from `ranked` and are scanned several times; features hold no NULL.
    """
    trees = max(counts)
    light = [s for s in specs if travelling(s, trees, n)]
    heavy = [s for s in specs if not travelling(s, trees, n)]
    out = None
    for spec in light:  # one model at a time is on the driver
        part = model_totals(rows, features, fit_forests(rows, features, [spec], trees, seed, n), counts)
        out = part if out is None else out.unionByName(part)
    if heavy and n <= WHOLE_LEAVES * LEAF_ROWS:
        part = whole_table_scores(rows, features, heavy, trees, counts, seed, n)
        out = part if out is None else out.unionByName(part)
    elif heavy:
        total = level_totals(rows, features, heavy, trees, seed, n)
        sums = materialize(total.groupBy("forest", "r").agg(*[F.sum(F.when(F.col("part") < c, F.col("total"))).alias(f"first_{c}") for c in counts]), "path-lengths")
        mean = F.create_map(*[F.lit(x) for s in heavy for x in (s.forest, max(average_path(min(s.psi, n)), 1e-12))])[F.col("forest")]
        score = [F.struct(F.lit(c).alias("n"), score_of(F.col(f"first_{c}"), c, mean).alias("score")) for c in counts]
        part = sums.select("forest", F.explode(F.array(*score)).alias("s")).select("forest", "s.n", "s.score")
        out = part if out is None else out.unionByName(part)
    return out


def score_of(total: Column, trees: int, mean: Column) -> Column:
    return -F.pow(F.lit(2.0), -F.round(total, 9) / trees / mean)


def iforest_anomalies(
    df: DataFrame, features: list[str], keys: list[str], contamination: float = 0.05,
    trees: int = TREES, psi: int = PSI, seed: int = 42,
) -> DataFrame:
    """Rows below the contamination quantile, with `anomaly_score` scaled over all rows.

    The input is read once and written with a number per row; the order, the fit and the scores read only the features of
    that copy (0 for NULL), and the flagged numbers fetch their rows.
    """
    used = [f"filled_{f}" for f in features]
    both = df.withColumns({u: F.col(f) for u, f in zip(used, features)}).withColumn("row_number_", F.monotonically_increasing_id())
    rows = materialize(fill_features(both, used), "forest-rows")
    n = rows.count()
    if not n:
        return df.limit(0).withColumn("anomaly_score", F.lit(None).cast("double"))
    forest = fit_forests(ranked(rows, keys, used, seed), used, [ForestSpec(0, psi)], trees, seed, n)[0]
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
        return pd.Series(scores(shared.value.totals(x, [trees])[0], trees, shared.value.psi))

    scored = materialize(rows.select("row_number_", score(*used).alias("sample_score")), "forest-scores")
    flagged = below_quantile(inverse_min_max(scored, "sample_score", "anomaly_score"), "sample_score", contamination)
    return rows.drop(*used).join(flagged.drop("sample_score"), "row_number_").drop("row_number_")
