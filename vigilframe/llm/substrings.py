"""Substring deduplication: windows of words that a document with a smaller id has, too, are cut out.

1. One pass over the texts finds for each window of `size` words its smallest gram hash (its minimizer).
   Equal windows have equal minimizers, and neighbouring windows share one, so a text becomes few
   segments (gram, first window, windows, hash of the segment's words).
2. Documents with equal word sequences fold to the smallest id.  The others are cut whole, or kept whole
   if they are shorter than a window.
3. Count-min prefilter: every partition counts the grams of its segments in a sketch of `depth` rows; the
   merged sketch never counts a gram, and so a window, too low.  Only segments whose gram is estimated
   repeated go on, as bits in a broadcast of `max_bits` at most.
4. Exact grouping of what is left: equal segments first; then, for grams whose segments differ, the single
   windows of one representative per segment, hashed anew from the texts.

All groups are aggregated with partial sums; hot segments, grams and windows only ever meet in minima and
counts, joined back in skew-splitting joins.  Hashes have 64 bits, of sequences and windows 128.

Defined results: NULL text has no words; NULL ids are neither cut nor compared; repeated rows get the
same result each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm import tokens as T
from vigilframe.llm.frames import bounded_batches, pick, small_by
from vigilframe.llm.sketch import estimated_repeated, repeated_cells
from vigilframe.session import materialize

GRAM = 10
POS = 24
OUTLINE = "doc_id bigint, key bigint, key2 bigint, n_words int, grams array<bigint>, starts array<int>, lengths array<int>, bodies array<bigint>"


def keys(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for the word sequence of each row."""
    out = []
    for step in (T.STEP, T.SECOND):
        sums = np.zeros(len(words) + 1, T.U)
        np.cumsum(T.mix(words ^ step) * T.powers(step, len(words)), out=sums[1:])
        back = T.powers(T.U(pow(int(step), -1, 1 << 64)), len(words) + 1)[offsets[:-1]]
        out.append(T.signed(T.mix((sums[offsets[1:]] - sums[offsets[:-1]]) * back + np.diff(offsets).astype(T.U))))
    return out[0], out[1]


def window_minima(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of each `width` neighbouring values."""
    place = np.arange(len(grams), dtype=T.U) & T.U((1 << POS) - 1)
    low = (grams >> T.U(POS) << T.U(POS)) | place
    reach = 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    n = len(grams) - width + 1
    low = np.minimum(low[:n], low[width - reach:width - reach + n])
    at = np.arange(n, dtype=T.U)
    return (at + (((low - at) & T.U((1 << POS) - 1)))).astype(np.int64)


def outline(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, stop, data, rows in T.slices(batch.column(1)):
                starts, ends, offsets = T.spans(data, rows)
                words = T.span_hashes(data, starts, ends)
                key, key2 = keys(words, offsets)
                grams = T.window_hashes(words, GRAM)
                inside = T.row_windows(offsets, size)
                if len(inside):
                    minima = window_minima(grams, size - GRAM + 1)[inside]
                    owner = np.searchsorted(offsets, inside, "right") - 1
                    new = np.flatnonzero(np.r_[True, (np.diff(minima) != 0) | (np.diff(owner) != 0)])
                    counts = np.diff(np.r_[new, len(inside)])
                    first, place, owner = inside[new], minima[new], owner[new]
                    sums = np.zeros(len(words) + 1, T.U)
                    np.cumsum(words * T.powers(T.SECOND, len(words)), out=sums[1:])
                    back = T.powers(T.U(pow(int(T.SECOND), -1, 1 << 64)), len(words))[first]
                    body = T.mix(T.mix((sums[first + counts + size - 1] - sums[first]) * back)
                                 + counts.astype(T.U) * T.STEP + (place - first).astype(T.U))
                    border = np.searchsorted(owner, np.arange(stop - row + 1)).astype(np.int32)
                    gram, begin = grams[place], (first - offsets[owner]).astype(np.int32)
                else:
                    gram = body = np.zeros(0, T.U)
                    begin = counts = np.zeros(0, np.int32)
                    border = np.zeros(stop - row + 1, np.int32)
                lists = [pa.ListArray.from_arrays(border, pa.array(x)) for x in (
                    T.signed(gram), begin, counts.astype(np.int32), T.signed(body))]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, stop - row), pa.array(key), pa.array(key2), pa.array(np.diff(offsets).astype(np.int32)), *lists],
                    ["doc_id", "key", "key2", "n_words", "grams", "starts", "lengths", "bodies"])
    return run


def repeated_segments(bits: int, sketch):
    """Flat rows of the segments whose gram is estimated to occur at least twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sketch.value
        for batch in batches:
            doc, key, grams, starts, lengths, bodies = batch.columns
            flat = grams.flatten().to_numpy(zero_copy_only=False)
            keep = estimated_repeated(flat, marks, bits)
            owner = np.repeat(np.arange(len(doc)), grams.value_lengths().to_numpy(zero_copy_only=False))[keep]
            owner, keep = pa.array(owner), pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [doc.take(owner), key.take(owner), *[x.flatten().filter(keep) for x in (grams, bodies, starts, lengths)]],
                ["doc_id", "key", "gram", "body", "start", "length"])
    return run


def window_rows(size: int):
    """Hashes of the single windows of the listed segments, from the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0), batch.column(2).to_pylist()
            keys_wanted = batch.column(3).to_pylist()
            for row, stop, data, rows in T.slices(batch.column(1)):
                starts, ends, offsets = T.spans(data, rows)
                words = T.span_hashes(data, starts, ends)
                key, _ = keys(words, offsets)
                one, two = T.window_hashes(words, size), T.window_hashes(T.mix(words ^ T.SECOND), size, T.SECOND)
                out: list[tuple[int, np.ndarray]] = []
                for r in range(row, stop):
                    if keys_wanted[r] == key[r - row]:
                        base = offsets[r - row]
                        for s in wanted[r]:
                            at = np.arange(s["start"], s["start"] + s["length"])
                            out.append((r, s["start"], at, at + base))
                if out:
                    owner = np.concatenate([np.full(len(x[2]), x[0]) for x in out])
                    place = np.concatenate([x[3] for x in out])
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(owner)), pa.array(key[owner - row]),
                        pa.array(np.concatenate([x[2] for x in out]).astype(np.int32)),
                        pa.array(T.signed(one[place])), pa.array(T.signed(two[place]))],
                        ["doc_id", "key", "start", "one", "two"])
    return run


def cut(size: int):
    """The words outside the listed runs of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, runs, whole = batch.columns
            removed, total, kept = [], [], []
            for text, listed, all_of_it in zip(texts, runs.to_pylist(), whole.to_pylist()):
                words = text.as_py().encode().split() if text.is_valid else []
                total.append(len(words))
                if all_of_it:
                    words = []
                elif listed:
                    gone = np.zeros(len(words) + 1, np.int32)
                    at = np.array([(x["start"], x["length"]) for x in listed])
                    np.add.at(gone, at[:, 0], 1)
                    np.add.at(gone, at.sum(axis=1) + size - 1, -1)
                    words = [w for w, g in zip(words, np.cumsum(gone)) if not g]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])
    return run


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 50, depth: int = 2, max_bits: int = 1 << 30,
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the kept words joined by one space (`kept`)."""
    texts = bounded_batches(pick(docs, doc_id=doc_id, text=text))
    lines = materialize(texts.mapInArrow(outline(size), OUTLINE), "outline")
    same = ["key", "key2", "n_words"]
    first = materialize(lines.filter("doc_id IS NOT NULL").groupBy(*same).agg(
        F.min("doc_id").alias("first"), F.countDistinct("doc_id").alias("n")).filter("n > 1"), "sequences")
    copies = materialize(lines.select("doc_id", *same).join(first, same).filter(F.col("doc_id") > F.col("first")).select(
        "doc_id", "key", "n_words").distinct(), "copies")
    single = lines.filter("doc_id IS NOT NULL AND size(grams) > 0").join(
        small_by(copies.select("doc_id", "key"), F.lit(1)), ["doc_id", "key"], "left_anti")

    bits, sketch = repeated_cells(single.select("grams"), lines.agg(F.sum(F.size("grams"))).first()[0] or 0, depth, max_bits)
    segments = materialize(single.select("doc_id", "key", "grams", "starts", "lengths", "bodies").mapInArrow(
        repeated_segments(bits, sketch), "doc_id bigint, key bigint, gram bigint, body bigint, start int, length int"), "segments")

    classes = materialize(segments.groupBy("gram", "body").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")), "classes")
    later = segments.join(classes.filter("first < last").select("gram", "body", "first"), ["gram", "body"]).filter(
        F.col("doc_id") > F.col("first")).select("doc_id", "key", "start", "length")
    mixed = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    heads = materialize(segments.join(classes.join(mixed, "gram", "left_semi").select("gram", "body", F.col("first").alias("doc_id")),
                                      ["gram", "body", "doc_id"], "left_semi").select("doc_id", "key", "start", "length"), "heads")
    listed = materialize(heads.groupBy("doc_id", F.col("key").alias("wanted_key")).agg(
        F.collect_list(F.struct("start", "length")).alias("wanted")), "listed")
    windows = texts.join(small_by(listed, F.size("wanted")), "doc_id").select("doc_id", "text", "wanted", "wanted_key").mapInArrow(
        window_rows(size), "doc_id bigint, key bigint, start int, one bigint, two bigint")
    windows = materialize(windows, "windows")
    owner = windows.groupBy("one", "two").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    single_later = windows.join(owner.select("one", "two", "first"), ["one", "two"]).filter(
        F.col("doc_id") > F.col("first")).select("doc_id", "key", "start", F.lit(1).alias("length"))
    runs = later.unionByName(single_later).groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "length")).alias("runs"))
    gone = runs.select("doc_id", "key", "runs", F.lit(False).alias("whole")).unionByName(
        copies.filter(F.col("n_words") >= size).select("doc_id", "key", F.lit(None).cast(runs.schema["runs"].dataType).alias("runs"), F.lit(True).alias("whole")))
    gone = materialize(gone, "gone")
    # Ids with several different texts keep a row of runs for each; the sequence's key tells which is meant.
    many = gone.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("key", F.struct("runs", "whole")))).alias("by_key"))
    return cut_rows(texts, materialize(many, "runs"), size)


def cut_rows(texts: DataFrame, runs: DataFrame, size: int) -> DataFrame:
    weight = F.aggregate(F.map_values("by_key"), F.lit(0), lambda n, x: n + F.coalesce(F.size(x["runs"]), F.lit(0)))
    joined = texts.join(small_by(runs, weight), "doc_id", "left")
    return joined.select("doc_id", "text", "by_key").mapInArrow(
        keyed_cut(size), "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def keyed_cut(size: int):
    apply = cut(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_key = batch.column(2).to_pylist()
            runs, whole = [None] * len(by_key), [False] * len(by_key)
            touched = [i for i, x in enumerate(by_key) if x]
            if touched:
                for row, stop, data, rows in T.slices(batch.column(1).take(pa.array(touched))):
                    starts, ends, offsets = T.spans(data, rows)
                    key, _ = keys(T.span_hashes(data, starts, ends), offsets)
                    for k, i in zip(key.tolist(), touched[row:stop]):
                        hit = dict(by_key[i]).get(k)
                        if hit:
                            runs[i], whole[i] = hit["runs"], hit["whole"]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            yield from apply(iter([pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(runs, kind), pa.array(whole)], ["doc_id", "text", "runs", "whole"])]))
    return run
