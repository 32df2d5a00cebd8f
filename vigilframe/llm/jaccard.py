"""N-gram Jaccard join: blocks of a sparse document by n-gram product, with size-derived bounds.

Documents are sets of hashed shingles; equal sets fold to the smallest id.  Two sets that link share at
least a = ceil(n * percent / 100) of the n shingles of each, so in any common order their first k shared
shingles are among the first n - a + k of both, for every k up to a.  The order puts rare shingles first:
merged partition sketches give the frequency of shingles and of words, and an error in them only costs time.
With k(n) growing with n, a document can only link if k(its smallest partner's size) of its first shingles
occur elsewhere; a count-min sketch, then exact counts, drop the others before any set is moved.

A block is all documents that share a first shingle with the block's smallest id (its pivot).  Every link
lies within some block.  First each document is compared with the pivot it shares most with, which is
linear.  Components of these links are then folded, and only blocks that still hold several components
are multiplied, first by the first shingles alone, which leaves the members that can have a partner (`may_link`), then by
the whole sets of those: cut into chunks of bounded size, incidence matrix times its transpose, accumulated over
column blocks, pairs below the size bound discarded.  A task returns a spanning forest of its links, so
no pairs of a group are written.

Defined results: NULL or wordless text has 0 shingles and no links; NULL ids get no component; rows of one
id count as one document, whatever their texts; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.llm import tokens as T
from vigilframe.llm.frames import bounded_batches, pick, small
from vigilframe.llm.sketch import estimated_repeated, repeated_cells
from vigilframe.session import materialize

WORD_BITS, SHINGLE_BITS, BIN_CELLS = 18, 19, 1 << 14
CHUNK = 200_000  # shingles of a chunk, each document counting BASE more
BASE = 400
COLUMNS, DENSE_FROM = 2048, 24
SHARE = 20  # percent of a set that k(n) asks for


def shingles(data: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their row offsets, shingle hashes, their row offsets; short texts are one shingle."""
    data = T.LOWER[data]
    starts, ends, offsets = T.spans(data, rows)
    words = T.span_hashes(data, starts, ends)
    counts = np.diff(offsets)
    inside = T.row_windows(offsets, size)
    hashes = T.window_hashes(words, size)[inside] if len(inside) else np.zeros(0, T.U)
    lengths = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        border = np.r_[0, np.cumsum(lengths)]
        whole = np.array([T.window_hashes(T.mix(words[offsets[r]:offsets[r + 1]] + T.U(counts[r])), int(counts[r]))[0] for r in short], T.U)
        hashes = np.insert(hashes, border[short], whole)
        lengths[short] = 1
    return words, offsets, hashes, np.r_[0, np.cumsum(lengths)]


def folded(hashes: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits of a set."""
    return np.bitwise_xor.reduce(T.mix(hashes)), np.add.reduce(T.mix(hashes ^ T.SECOND))


def outlines(size: int):
    """A row per document (set size and hash), then the partition's counts of words and shingles by cell, in bins."""
    names = ["doc_id", "n", "one", "two", "bin", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << WORD_BITS, np.int32), np.zeros(1 << SHINGLE_BITS, np.int32)]
        for batch in batches:
            for row, stop, data, rows in T.slices(batch.column(1)):
                words, _, hashes, border = shingles(data, rows, size)
                for total, values, bits in ((counts[0], words, WORD_BITS), (counts[1], hashes, SHINGLE_BITS)):
                    total += np.bincount((values >> T.U(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.int32)
                own = [np.unique(hashes[border[r]:border[r + 1]]) for r in range(stop - row)]
                both = np.array([folded(x) for x in own], T.U).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, stop - row), pa.array([len(x) for x in own], pa.int64()),
                    pa.array(T.signed(both[:, 0].copy())), pa.array(T.signed(both[:, 1].copy())),
                    pa.nulls(stop - row, pa.int64()), pa.nulls(stop - row, pa.binary())], names)
        cells = np.concatenate(counts).reshape(-1, BIN_CELLS)
        none = pa.nulls(len(cells), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(np.arange(len(cells))), pa.array([x.tobytes() for x in cells], pa.binary())], names)
    return run


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = np.frombuffer(counts.as_buffer(), np.int32)
            sums[number] = sums[number] + values if number in sums else values.astype(np.int64)
    for number, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([total.tobytes()], pa.binary())], ["bin", "counts"])


def ordering(partial: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cost of a word cell, and count of a frequent shingle's cell (0 for the others)."""
    bins = np.zeros((1 << WORD_BITS) + (1 << SHINGLE_BITS), np.int64).reshape(-1, BIN_CELLS)
    for x in partial.repartition("bin").mapInArrow(summed, "bin bigint, counts binary").toLocalIterator():
        bins[x["bin"]] = np.frombuffer(x["counts"], np.int64)
    words, hot = np.split(bins.ravel(), [1 << WORD_BITS])
    return (16 * np.log2(words + 1)).astype(np.int64), np.where(hot > 8 * hot.mean() + 8, hot, 0)


def least_shared(n, percent: int):
    """a(n): shingles that a set of n shares with any set it links with."""
    return -(-n * percent // 100)


def shared_firsts(n, percent: int):
    """k(n): so many shared shingles are looked for among the first ones; grows with n, up to a(n)."""
    return np.minimum(1 + n * SHARE // 100, least_shared(n, percent))


def may_link(n, m, shared, percent: int):
    """Whether sets of n and m shingles can link that have `shared` of their first ones in common.

    Of the set whose first ones end earlier in the common order, those that the other lacks there it lacks
    altogether, so at most max(a(n) - k(n), a(m) - k(m)) + shared are common to both.
    """
    rest = [least_shared(x, percent) - shared_firsts(x, percent) for x in (n, m)]
    return (100 + percent) * (np.maximum(*rest) + shared) >= percent * (n + m)


def first_shingles(batches: Iterator[pa.RecordBatch], size: int, percent: int, order):
    """For every document (batch, row, set size, its first shingles in order, how many of them hold one shared shingle)."""
    word_cost, hot = order
    for batch in batches:
        for row, stop, data, rows in T.slices(batch.column(1)):
            words, offsets, hashes, border = shingles(data, rows, size)
            cost = hot[(hashes >> T.U(64 - SHINGLE_BITS)).astype(np.int64)] << 16
            if len(hashes):
                sums = np.r_[0, np.cumsum(word_cost[(words >> T.U(64 - WORD_BITS)).astype(np.int64)])]
                first = T.row_of(border)
                first = np.arange(len(hashes)) - border[first] + offsets[first]
                cost += sums[np.minimum(first + size, len(words))] - sums[first]
            for r in range(stop - row):
                own, at = np.unique(hashes[border[r]:border[r + 1]], return_index=True)
                if len(own):
                    free = len(own) - least_shared(len(own), percent)
                    ranked = np.argsort(cost[border[r]:border[r + 1]][at], kind="stable")
                    yield batch, row + r, len(own), own[ranked[:free + shared_firsts(len(own), percent)]], free + 1


def listed_firsts(size: int, percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for _, _, _, own, _ in first_shingles(batches, size, percent, order.value):
            held.append(own)
            total += len(own)
            if total > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array([T.signed(np.concatenate(held))])], ["firsts"])
                held, total = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([T.signed(np.concatenate(held))])], ["firsts"])
    return run


def repeated_firsts(size: int, percent: int, order, bits: int, sketch):
    """The first shingles that may occur elsewhere, of the documents with enough of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, n, own, base in first_shingles(batches, size, percent, order.value):
            keep = np.flatnonzero(estimated_repeated(own, sketch.value, bits))
            if len(keep) >= shared_firsts(least_shared(n, percent), percent):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.full(len(keep), row))), pa.array(np.full(len(keep), n)),
                    pa.array(T.signed(own[keep])), pa.array(keep < base)], ["doc", "n", "shingle", "base"])
    return run


def sets(size: int):
    """Sorted shingle sets of the wanted documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, rows in T.slices(batch.column(1)):
                _, _, hashes, border = shingles(data, rows, size)
                own = [np.unique(hashes[border[r]:border[r + 1]]) for r in range(stop - row)]
                ok = [len(x) == n and int(folded(x)[0].astype(np.int64)) == one for x, n, one in zip(
                    own, batch.column(2)[row:stop].to_pylist(), batch.column(3)[row:stop].to_pylist())]
                chosen = np.flatnonzero(ok)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(chosen + row)), pa.array([own[i].tobytes() for i in chosen], pa.binary())],
                    ["doc", "shingles"])
    return run


def linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(a.as_buffer(), T.U), np.frombuffer(b.as_buffer(), T.U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(good, pa.int64())) for c in batch.columns[:2]], ["a", "b"])
    return run


def overlaps(flat: np.ndarray, owner: np.ndarray, m: int) -> np.ndarray:
    """Shared values of all pairs of m sets: sparse columns by their few pairs, full ones by dense blocks."""
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order].astype(np.int64)
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    count = np.diff(np.r_[start, len(flat)])
    column = np.repeat(np.arange(len(start)), count)
    out = np.zeros((m, m), np.float32)
    sparse = count[column] < DENSE_FROM
    c, o = column[sparse], owner[sparse]
    for step in range(1, DENSE_FROM - 1):
        same = np.flatnonzero(c[step:] == c[:-step]) if len(c) > step else []
        if not len(same):
            break
        code, times = np.unique(np.minimum(o[same], o[same + step]) * m + np.maximum(o[same], o[same + step]), return_counts=True)
        out.ravel()[code] += times
    c, o = column[~sparse], owner[~sparse]
    if len(c):
        c = np.unique(c, return_inverse=True)[1]
        for low in range(0, int(c[-1]) + 1, COLUMNS):
            a, b = np.searchsorted(c, [low, low + COLUMNS])
            block = np.zeros((m, min(COLUMNS, int(c[-1]) + 1 - low)), np.float32)
            block[o[a:b], c[a:b] - low] = 1
            out += np.triu(block @ block.T, 1)
    return out


def partners(percent: int):
    """Members of a block with a possible partner in another component, by the shared first shingles alone.

    A pair that lies in several blocks counts in that of the smallest pivot.
    """
    def run(table: pa.Table) -> pa.Table:
        pivot = table.column("pivot")[0].as_py()
        below = [x.values.to_numpy() for x in table.column("pivots")]
        below = [x[x < pivot] for x in below]
        met = overlaps(np.concatenate(below), np.repeat(np.arange(len(below)), [len(x) for x in below]), len(below))
        n, comps = table.column("n").to_numpy(), table.column("component").to_numpy()
        own = [x.values.to_numpy() for x in table.column("firsts")]
        shared = overlaps(np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own]), len(own))
        least = shared_firsts(n, percent)
        keep = np.zeros(len(n), bool)
        for low in range(0, len(n), 128):
            part = slice(low, low + 128)
            a, b = np.nonzero(
                (shared[part] >= np.minimum(least[part, None], least)) & (comps[part, None] != comps)
                & may_link(n[part, None], n, shared[part], percent) & (met[part] == 0)
                & (100 * np.minimum(n[part, None], n) >= percent * np.maximum(n[part, None], n)))
            keep[a + low] = True
            keep[b] = True
        return table.select(["pivot", "i", "j", "doc", "component"]).filter(pa.array(keep))
    return run


def multiply(percent: int):
    def run(table: pa.Table) -> pa.Table:
        docs, comps = table.column("doc").to_numpy(), table.column("component").to_numpy()
        own = [np.frombuffer(x.as_buffer(), T.U) for x in table.column("shingles")]
        n = np.array([len(x) for x in own], np.float64)
        shared = overlaps(np.concatenate(own), np.repeat(np.arange(len(own)), n.astype(np.int64)), len(own))
        found = []
        for low in range(0, len(own), 128):
            part = shared[low:low + 128].astype(np.float64)
            a, b = np.nonzero(100 * part >= percent * (n[low:low + 128, None] + n[None, :] - part))
            found.append((a + low, b))
        a, b = (np.concatenate(x) for x in zip(*found))
        wanted = comps[a] != comps[b]
        parent = {int(c): int(c) for c in comps}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for i, j in zip(a[wanted].tolist(), b[wanted].tolist()):
            x, y = root(int(comps[i])), root(int(comps[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((int(docs[i]), int(docs[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})
    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of `edges` (a, b).

    Every node hooks on its smallest neighbour, chains are halved until they are flat, and the graph of the
    roots goes round again; each round's tables are written.
    """
    answer = None
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
        hooks = materialize(hooks, "hooks")
        while True:
            up = hooks.select(F.col("node").alias("component"), F.col("component").alias("next"))
            hooks = materialize(hooks.join(up, "component").select("node", F.col("next").alias("component"), (F.col("next") != F.col("component")).alias("moved")), "hooks")
            if not hooks.filter("moved").limit(1).count():
                break
        hooks = hooks.select("node", "component")
        if answer is None:
            answer = hooks
        else:
            step = hooks.select(F.col("node").alias("component"), F.col("component").alias("next"))
            answer = materialize(answer.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component")), "components")
        ends = edges
        for side in ("a", "b"):
            ends = ends.join(hooks.select(F.col("node").alias(side), F.col("component").alias(f"new_{side}")), side)
        edges = materialize(ends.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).filter("a < b").distinct(), "edges")
        if not edges.limit(1).count():
            return answer


def with_components(nodes: DataFrame, found: DataFrame) -> DataFrame:
    return nodes.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75, max_bits: int = 1 << 28,
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest id reachable by links."""
    return linked_rows(docs.sparkSession, bounded_batches(pick(docs, doc_id=doc_id, text=text)), size, percent, max_bits)


def linked_rows(spark: SparkSession, texts: DataFrame, size: int, percent: int, max_bits: int) -> DataFrame:
    outline = materialize(texts.mapInArrow(
        outlines(size), "doc_id bigint, n bigint, one bigint, two bigint, bin bigint, counts binary"), "outline")
    order = spark.sparkContext.broadcast(ordering(outline.filter("bin IS NOT NULL").select("bin", "counts")))
    outline = outline.filter("bin IS NULL").select("doc_id", "n", "one", "two")
    known = outline.filter("n > 0 AND doc_id IS NOT NULL")
    same = ["n", "one", "two"]
    heads = materialize(known.groupBy(*same).agg(F.min("doc_id").alias("doc")), "heads")
    copies = known.select("doc_id").distinct().join(heads.select(F.col("doc").alias("doc_id")), "doc_id", "left_anti")
    single = texts.filter("doc_id IS NOT NULL").join(small(materialize(copies, "copies")), "doc_id", "left_anti").select("doc_id", "text")

    total = int((known.agg(F.sum("n")).first()[0] or 0) * (100 - percent + SHARE) / 100)
    bits, sketch = repeated_cells(single, total, 1, max_bits, listed_firsts(size, percent, order))
    postings = materialize(single.mapInArrow(
        repeated_firsts(size, percent, order, bits, sketch), "doc bigint, n bigint, shingle bigint, base boolean"), "postings")
    often = postings.groupBy("shingle").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("shingle")
    partner = F.ceil(F.col("n") * percent / 100)
    least = F.least(1 + F.floor(partner * SHARE / 100), F.ceil(partner * percent / 100))
    enough = materialize(postings.join(often, "shingle", "left_semi").groupBy("doc", "n").agg(F.count(F.lit(1)).alias("k")).filter(
        F.col("k") >= least).select("doc", "n"), "enough")
    firsts = postings.join(small(enough.select("doc")), "doc", "left_semi").select("doc", "shingle")
    postings = postings.filter("base").join(small(enough), ["doc", "n"], "left_semi")
    blocks = postings.groupBy("shingle").agg(F.min(F.struct("doc", "n")).alias("pivot"), F.max("doc").alias("last")).filter("pivot.doc < last")
    members = postings.join(blocks.select("shingle", "pivot"), "shingle").groupBy("doc", "n", "pivot").agg(F.count(F.lit(1)).alias("shared"))
    members = materialize(members.select("doc", "n", F.col("pivot.doc").alias("pivot"), F.col("pivot.n").alias("pivot_n"), "shared"), "members")

    def own(chosen: DataFrame, name: str) -> DataFrame:
        chosen = materialize(chosen.distinct().join(heads.select("doc", "n", "one"), "doc").withColumnRenamed("doc", "doc_id"), f"of-{name}")
        rows = texts.join(small(chosen), "doc_id").select("doc_id", "text", "n", "one")
        return materialize(rows.mapInArrow(sets(size), "doc bigint, shingles binary"), name)

    # What a document shares with a pivot among the shingles for which no smaller id stands bounds their overlap;
    # where it is not all they share, both lie in the block of a smaller pivot too.
    bound = F.ceil(F.greatest("n", "pivot_n") * percent / 100) - 1 + F.col("shared")
    fits = (
        (F.col("doc") != F.col("pivot")) & (100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n"))
        & ((100 + percent) * bound >= percent * (F.col("n") + F.col("pivot_n"))))
    members = members.withColumn("fits", fits)
    best = members.groupBy("doc").agg(F.max(F.when(F.col("fits"), F.struct("shared", (-F.col("pivot")).alias("p")))).alias("best"))
    wanted = materialize(best.select("doc", (-F.col("best.p")).alias("best")), "wanted")
    pairs = wanted.filter("best IS NOT NULL")
    compared = own(pairs.select("doc").unionByName(pairs.select(F.col("best").alias("doc"))), "star-sets")
    others = compared.select(F.col("doc").alias("best"), F.col("shingles").alias("other")).join(pairs.select("best").distinct(), "best", "left_semi")
    stars = materialize(compared.join(pairs, "doc").join(others, "best").select("doc", "best", "shingles", "other").mapInArrow(
        linked(percent), "a bigint, b bigint"), "stars")
    found = components(stars)

    state = with_components(members.join(wanted, "doc"), found)
    state = materialize(state.select("pivot", "doc", "n", "best", "fits", "component"), "state")
    apart = F.col("fits") & ((F.col("best").isNull()) | (F.col("best") != F.col("pivot")))
    of_pivot = F.max(F.when(F.col("doc") == F.col("pivot"), F.col("component")))
    rest = F.when(F.col("doc") != F.col("pivot"), F.col("component"))
    groups = state.groupBy("pivot").agg(
        F.min(rest).alias("low"), F.max(rest).alias("high"), of_pivot.alias("own"), F.sum(F.col("n") + BASE).alias("weight"),
        F.min(F.when(apart, F.col("component"))).alias("apart_low"), F.max(F.when(apart, F.col("component"))).alias("apart_high"))
    open_ones = groups.filter("low < high OR (apart_low IS NOT NULL AND (apart_low <> own OR apart_high <> own))").select(
        "pivot", F.ceil(F.col("weight") / CHUNK).cast("int").alias("chunks"))
    open_ones = materialize(open_ones, "open")
    dealt = state.join(open_ones, "pivot").select(
        "pivot", "doc", "n", "component", "chunks", F.pmod(F.xxhash64("doc", "pivot"), "chunks").cast("int").alias("own"))
    dealt = dealt.select("pivot", "doc", "n", "component", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with"))
    dealt = dealt.select("pivot", "doc", "n", "component", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    pivots = state.join(open_ones.select("pivot"), "pivot", "left_semi").groupBy("doc").agg(F.collect_set("pivot").alias("pivots"))
    firsts = firsts.groupBy("doc").agg(F.collect_set("shingle").alias("firsts")).join(pivots, "doc")
    possible = dealt.join(firsts, "doc").groupBy("pivot", "i", "j").applyInArrow(
        partners(percent), "pivot bigint, i int, j int, doc bigint, component bigint")
    possible = materialize(possible, "possible")
    blocks_in = possible.join(own(possible.select("doc"), "block-sets"), "doc")
    product = blocks_in.groupBy("pivot", "i", "j").applyInArrow(multiply(percent), "a bigint, b bigint")
    more = materialize(product, "links")
    if more.limit(1).count():
        found = components(stars.unionByName(more))
    rows = outline.join(heads, same, "left")
    rows = with_components(rows, found)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
