"""Exact k nearest neighbours of every row of a low-dimensional feature table.

Identical rows are folded into one weighted point first, so copies cost nothing however
many there are.  Points are cut into cells by a tree of median splits.  Its first tier, of
at most `MAX_LEVELS` levels, is grown on the driver from a bounded sample; where more are
needed, the executors grow a second tier below each of its cells from a sample of that cell,
so cells stay small whatever the table.  Round one searches the own cell and yields an upper
bound of the k-th distance; round two visits only the other cells whose bounding box lies
within that bound.  Boxes are nested: a query first meets the boxes of the first tier, which
the driver holds, and only those of the cells below the ones it touches, which lie in a
table.  A cell with too few rows for a bound takes that of the smallest box around it that
has enough.  Each task compares one bounded chunk of queries with one bounded chunk of points
and returns at most k rows per query.  The split samples steer load alone: any split gives
the same, exact answer.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.session import materialize

CELL_POINTS = 512  # wanted points per cell
MAX_LEVELS = 16  # of the first tier: at most 65,536 cells, so tree and boxes stay a few megabytes
SALTS = 16  # tasks that the visits of one cell of the first tier are dealt to
SAMPLE_PER_CELL = 16
QUERY_CHUNK = 1024
POINT_CHUNK = 4096
EDGE = "qid bigint, pid bigint, d2 double, w bigint"


@dataclass
class Neighbourhood:
    """`points(pid, features, m)` with multiplicity m, `edges(qid, pid, d2, w)`, row count and k."""

    points: DataFrame
    edges: DataFrame
    rows: int
    k: int


def split_tree(sample: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Split dimension and value per inner node of a complete binary tree, breadth first."""
    dims = np.zeros(2**levels - 1, dtype=np.int64)
    cuts = np.full(2**levels - 1, np.inf)
    groups = {0: sample}
    for node in range(len(dims)):
        part = groups.pop(node, sample[:0])
        best = (0, 0, np.inf)
        for dim in range(sample.shape[1]):
            column = part[:, dim]
            if not len(column):
                continue
            middle = np.median(column)
            lower = column[column < middle]
            for cut in {middle, lower.max() if len(lower) else middle}:
                left = int((column <= cut).sum())
                balance = min(left, len(column) - left)
                if balance > best[0]:
                    best = (balance, dim, cut)
        _, dims[node], cuts[node] = best
        side = part[:, dims[node]] <= cuts[node]
        groups[2 * node + 1], groups[2 * node + 2] = part[side], part[~side]
    return dims, cuts


def descend(x: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The leaf of each row in a complete binary tree."""
    node, row = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    for _ in range(int(len(dims) + 1).bit_length() - 1):
        node = 2 * node + 1 + (x[row, dims[node]] > cuts[node])
    return node - len(dims)


def _first_tier(points: DataFrame, features: list[str], levels: int, sample: np.ndarray) -> DataFrame:
    dims, cuts = split_tree(sample, levels)

    @F.pandas_udf("bigint")
    def locate(*columns: pd.Series) -> pd.Series:
        return pd.Series(descend(np.column_stack([c.to_numpy() for c in columns]), dims, cuts))

    return points.withColumn("cell", locate(*features))


def _grouped(frames):
    """(key, rows) of stretches of one `cell`, of frames in the order of cells; a cell may come in several stretches."""
    for frame in frames:
        cell = frame["cell"].to_numpy()
        border = np.flatnonzero(np.diff(cell)) + 1
        for low, high in zip([0, *border.tolist()], [*border.tolist(), len(frame)]):
            if low < high:
                yield cell[low], frame.iloc[low:high]


def _second_tier(points: DataFrame, features: list[str], levels: int, size: int, cells: int) -> DataFrame:
    """`cell` cut into 2^levels cells each, by a tree that is grown from a sample of the cell in a task of its own."""
    wanted, names = SAMPLE_PER_CELL * 2**levels, list(points.columns)
    share = min(1.0, 2.0 * wanted * cells / size) * 2**31
    order = Window.partitionBy("cell").orderBy(F.xxhash64("pid"))
    sample = points.where(F.pmod(F.xxhash64("pid", F.lit(1)), F.lit(2**31)) < F.lit(share)).select(
        "cell", *features, F.row_number().over(order).alias("place")).where(F.col("place") <= 2 * wanted)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        dims, cuts = split_tree(pdf[features].to_numpy(np.float64), levels)
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "dims": [dims], "cuts": [cuts]})

    def locate(frames):
        tree = (None, None, None)
        for cell, rows in _grouped(frames):
            if rows["pid"].iloc[0] < 0:  # the tree comes before the cell's points
                tree = (cell, np.asarray(rows["dims"].iloc[0]), np.asarray(rows["cuts"].iloc[0]))
                rows = rows.iloc[1:]
            if len(rows):
                below = descend(rows[features].to_numpy(np.float64), *tree[1:]) if tree[0] == cell else 0
                yield rows[["pid", *features, "m"]].assign(cell=cell * 2**levels + below)[names]

    trees = sample.groupBy("cell").applyInPandas(grow, "cell bigint, dims array<bigint>, cuts array<double>").select(
        "*", F.lit(-1).cast("bigint").alias("pid"), F.lit(0).cast("bigint").alias("m"), *[F.lit(0.0).alias(f) for f in features])
    both = trees.unionByName(points, allowMissingColumns=True).repartition("cell").sortWithinPartitions("cell", "pid")
    return both.mapInPandas(locate, points.schema)


def _kernel(features: list[str], k: int):
    """Search of one query chunk in one point chunk; ties in distance go to the lower id."""

    def search(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(points):
            return pd.DataFrame({"qid": [], "pid": [], "d2": [], "w": []})
        points = points.sort_values("pid")
        p, pid = points[features].to_numpy(), points["pid"].to_numpy()
        q, qid = queries[features].to_numpy(), queries["qid"].to_numpy()
        weight, limit = points["m"].to_numpy(), queries["limit2"].to_numpy()
        take = min(k, len(p))
        found = []
        for start in range(0, len(q), 128):
            block = slice(start, start + 128)
            d2 = np.zeros((len(q[block]), len(p)))
            for dim in range(p.shape[1]):
                d2 += (q[block, dim, None] - p[None, :, dim]) ** 2
            own = qid[block, None] == pid[None, :]
            d2[own & (weight[None, :] == 1)] = np.inf
            kth = np.partition(d2, take - 1, axis=1)[:, take - 1 : take]
            nearer, level = d2 < kth, d2 == kth
            room = take - nearer.sum(axis=1, keepdims=True)
            keep = nearer | (level & (np.cumsum(level, axis=1) <= room))
            row, chosen = np.nonzero(keep & np.isfinite(d2) & (d2 <= limit[block, None]))
            copies = weight[chosen] - (pid[chosen] == qid[block][row])
            found.append(pd.DataFrame({
                "qid": qid[block][row], "pid": pid[chosen], "d2": d2[row, chosen], "w": copies}))
        return pd.concat(found)

    return search


def _compare(queries: DataFrame, points: DataFrame, features: list[str], k: int) -> DataFrame:
    """Edges between queries and the points of the cell each query names."""
    chunks = (
        queries.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_CHUNK).cast("int").alias("qchunks"))
        .join(points.groupBy("cell").agg(F.ceil(F.count("*") / POINT_CHUNK).cast("int").alias("pchunks")), "cell")
    )

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = queries.join(chunks, "cell").select(
        "cell", F.pmod(F.hash("qid"), "qchunks").alias("qc"), every("pchunks").alias("pc"),
        "qid", "limit2", *features)
    right = points.join(chunks, "cell").select(
        "cell", F.pmod(F.hash("pid"), "pchunks").alias("pc"), every("qchunks").alias("qc"), "pid", "m", *features)
    keys = ["cell", "qc", "pc"]
    right = right.toDF(*right.columns)  # fresh column ids: both sides stem from one table
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_kernel(features, k), EDGE)


def nearest(edges: DataFrame, k: int) -> DataFrame:
    """Keep the k nearest per query, counting copies; at most k candidates per chunk compete."""
    order = Window.partitionBy("qid").orderBy("d2", "pid")
    before = F.coalesce(F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return edges.withColumn("before", before).where(F.col("before") < k).select(
        "qid", "pid", "d2", F.least("w", F.lit(k) - F.col("before")).alias("w"))


def _touched(x: np.ndarray, limit: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, box) pairs of the boxes that the balls of squared radius `limit` around the rows may touch."""
    rows, boxes = [], []
    step = max(1, (1 << 22) // max(1, len(low)))
    for start in range(0, len(x), step):
        part = slice(start, start + step)
        d2 = np.zeros((len(x[part]), len(low)))
        for dim in range(x.shape[1]):
            value = x[part, dim, None]
            gap = np.maximum(np.maximum(low[None, :, dim] - value, value - high[None, :, dim]), 0.0)
            d2 += gap**2
        row, box = np.nonzero(d2 <= limit[part, None])
        rows.append(row + start)
        boxes.append(box)
    return (np.concatenate(rows), np.concatenate(boxes)) if rows else (np.zeros(0, np.int64),) * 2


def _boxes(celled: DataFrame, features: list[str], cell) -> DataFrame:
    """Bounding boxes and numbers of rows of cells."""
    return celled.groupBy(cell.alias("cell")).agg(
        *[F.min(f).alias(f"lo{i}") for i, f in enumerate(features)], *[F.max(f).alias(f"hi{i}") for i, f in enumerate(features)],
        F.sum("m").alias("rows"))


def _corners(boxes: pd.DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(boxes[[f"{side}{i}" for i in range(n)]].to_numpy(np.float64) for side in ("lo", "hi"))


def around(boxes: pd.DataFrame, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each box the corners of the smallest box around it, going up the tree, with more than k rows (else of all)."""
    low, high = _corners(boxes, n)
    cell, rows = boxes["cell"].to_numpy(), boxes["rows"].to_numpy()
    out_low, out_high = low.copy(), high.copy()
    thin, up = rows <= k, 0
    while thin.any() and up < 64:
        up += 1
        above, at = np.unique(cell >> up, return_inverse=True)
        total = np.bincount(at, rows)
        lows, highs = np.full((len(above), n), np.inf), np.full((len(above), n), -np.inf)
        np.minimum.at(lows, at, low)
        np.maximum.at(highs, at, high)
        out_low[thin], out_high[thin] = lows[at[thin]], highs[at[thin]]
        thin &= (total[at] <= k) & (len(above) > 1)
    return out_low, out_high


def _visits(queries: DataFrame, features: list[str], celled: DataFrame, below: int, k: int) -> DataFrame:
    """Queries repeated for every other cell whose box their ball may touch; `below` levels lie in the second tier."""
    n, names = len(features), list(queries.columns)
    top = F.shiftright("cell", below)
    boxes = _boxes(celled, features, top).toPandas().sort_values("cell")  # of the first tier: bounded
    low, high = _corners(boxes, n)
    far_low, far_high = around(boxes, n, k)
    cells = boxes["cell"].to_numpy()

    def bounded(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """The rows, and the bounds of their balls; a row without one reaches to the corners of the box around its cell."""
        x, limit = batch[features].to_numpy(np.float64), batch["limit2"].to_numpy(np.float64).copy()
        open_ = np.flatnonzero(~np.isfinite(limit))
        if len(open_):
            at = np.searchsorted(cells, batch["cell"].to_numpy()[open_] >> below)
            gap = np.maximum(np.abs(x[open_] - far_low[at]), np.abs(x[open_] - far_high[at]))
            limit[open_] = (gap**2).sum(axis=1) * (1 + 1e-9)
        return x, limit

    def expand(batches):
        for batch in batches:
            x, limit = bounded(batch)
            row, box = _touched(x, limit, low, high)
            out = batch.iloc[row].copy()
            out["limit2"] = limit[row]
            out["home"], out["cell"] = out["cell"].to_numpy(), cells[box]
            yield (out[out["home"] != out["cell"]] if not below else out)[[*batch.columns, "home"]]

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
    met = queries.mapInPandas(expand, f"{shape}, home bigint")
    if not below:
        return met.drop("home")
    leaves = _boxes(celled, features, F.col("cell")).select(
        top.alias("cell"), F.col("cell").alias("leaf"), *[f"{side}{i}" for i in range(n) for side in ("lo", "hi")],
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = met.withColumn("salt", F.pmod(F.hash("qid"), F.lit(SALTS)))

    def descend_boxes(frames):
        held, parts = None, []
        for cell, rows in _grouped(frames):
            if cell != held:
                held, parts = cell, []
            of_box = rows["leaf"].to_numpy() >= 0
            if of_box.any():
                parts.append(rows[of_box])
            asked = rows[~of_box]
            if not len(asked) or not parts:
                continue
            here = pd.concat(parts)
            row, box = _touched(asked[features].to_numpy(np.float64), asked["limit2"].to_numpy(np.float64), *_corners(here, n))
            out = asked.iloc[row].assign(cell=here["leaf"].to_numpy()[box].astype(np.int64))
            yield out[out["home"] != out["cell"]][names]

    ends = [f"{side}{i}" for i in range(n) for side in ("lo", "hi")]
    salted = (F.col("cell") * SALTS + F.col("salt")).alias("cell")
    none = F.lit(-1).cast("bigint")
    asked = met.select(salted, *[c for c in met.columns if c not in ("cell", "salt")], none.alias("leaf"), *[F.lit(0.0).alias(e) for e in ends])
    offered = leaves.select(salted, "leaf", *ends, none.alias("qid"), none.alias("home"), F.lit(0.0).alias("limit2"), *[F.lit(0.0).alias(f) for f in features])
    both = offered.unionByName(asked).repartition("cell").sortWithinPartitions("cell", F.col("leaf") < 0)
    return both.mapInPandas(descend_boxes, queries.schema)


def neighbourhood(rows: DataFrame, features: list[str], k: int, cell_points: int = CELL_POINTS) -> Neighbourhood:
    """The k nearest other rows of every row, as weighted edges between distinct points."""
    # Ids follow the order of the feature values, which settles ties in distance.
    points = materialize(
        rows.groupBy(*features).agg(F.count("*").alias("m")).orderBy(*features)
        .withColumn("pid", F.monotonically_increasing_id())
    )
    size = points.agg(F.count("*").alias("points"), F.coalesce(F.sum("m"), F.lit(0)).alias("rows")).first()
    k = max(min(k, size["rows"] - 1), 0)
    levels = max(math.ceil(math.log2(max(size["points"], 1) / cell_points)), 0)
    first, below = min(levels, MAX_LEVELS), max(levels - MAX_LEVELS, 0)
    celled = points.withColumn("cell", F.lit(0).cast("bigint"))
    if levels:
        wanted = SAMPLE_PER_CELL * 2**first
        share = F.lit(min(1.0, 1.5 * wanted / size["points"]) * 2**31)
        sample = (
            points.where(F.pmod(F.xxhash64("pid"), F.lit(2**31)) < share).limit(2 * wanted)
            .select(*features).toPandas().to_numpy()
        )
        celled = _first_tier(points, features, first, sample)
        if below:
            celled = _second_tier(materialize(celled), features, below, size["points"], 2**first)
        celled = materialize(celled)
    own = celled.select(F.col("pid").alias("qid"), "cell", *features, F.lit(float("inf")).alias("limit2"))
    first = nearest(_compare(own, celled, features, k), k)
    if levels == 0:
        return Neighbourhood(points, materialize(first), size["rows"], k)
    first = materialize(first)
    bound = first.groupBy("qid").agg(
        F.when(F.sum("w") >= k, F.max("d2")).otherwise(F.lit(float("inf"))).alias("limit2"))
    bounded = own.drop("limit2").join(bound, "qid", "left").withColumn(
        "limit2", F.coalesce("limit2", F.lit(float("inf"))))
    visits = materialize(_visits(bounded, features, celled, below, k))
    second = _compare(visits, celled, features, k)
    return Neighbourhood(points, materialize(nearest(first.unionByName(second), k)), size["rows"], k)
