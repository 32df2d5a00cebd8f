"""Line deduplication by winnowing over line hashes.

A line is a piece of the text between newlines that holds a word; other pieces are kept as they are and do
not interrupt a run.  Every `run` consecutive lines of a document form a window, and so does every shorter
sequence of lines with more than `long_words` words.  A document of fewer lines and no more words is one
window as a whole, which only equal whole documents match.  The smallest line hash of a window is its
fingerprint: a window shared by two places is guaranteed to give both the same fingerprint.  Positions of
equal fingerprints are joined with the first place (smallest document id, then line) of the same window;
matches of one size on neighbouring lines are one match extended both ways.  Lines of all matches but the
first place's are deleted.

So a line is deleted exactly if it lies in a run of at least `run` lines, or of more than `long_words` words,
that also begins at an earlier place, in another document or in its own, or if its whole short document
equals an earlier one.  `long_words=None` leaves only the windows of `run` lines.  Fingerprints seen once are
dropped before windows are compared.  All groups are minima and counts with partial sums, joined back in
skew-splitting joins.

Defined results: NULL text stays NULL; rows with a NULL id are neither changed nor compared; rows of one
id and text are one document and get the same result; texts that lose all lines become empty; very long
texts are cut as others are, one at a time; an empty table gives an empty table; other columns are kept, one
named like `into` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm import tokens as T
from vigilframe.llm.frames import bounded_batches, pick, small, small_by
from vigilframe.session import materialize

NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


def worded_lines(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, offsets of the rows) of the lines that hold a word."""
    starts, ends, _ = T.spans(data, rows, NEWLINE)
    ink = np.zeros(len(data) + 1, np.int32)
    np.cumsum(~T.SPACE[data], out=ink[1:])
    worded = ink[ends] > ink[starts]
    return starts[worded], ends[worded], np.searchsorted(starts[worded], rows)


def line_hashes(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every line that holds a word, and the offsets of the rows among them."""
    starts, ends, offsets = worded_lines(data, rows)
    return T.span_hashes(data, starts, ends), offsets


def windows(data: np.ndarray, rows: np.ndarray, starts: np.ndarray, offsets: np.ndarray, run_length: int,
            long_words: int | None) -> Iterator[tuple[int, bool, np.ndarray]]:
    """(lines, whole document, first lines) of the windows, size by size."""
    yield run_length, False, T.row_windows(offsets, run_length)
    if long_words is None:
        return
    first_words = T.spans(data, rows)[0]
    before = np.append(np.searchsorted(first_words, starts), len(first_words))
    lines = np.diff(offsets)
    short = before[offsets[1:]] - before[offsets[:-1]] <= long_words
    for size in range(1, run_length):
        at = T.row_windows(offsets, size)
        yield size, False, at[before[at + size] - before[at] > long_words]
        yield size, True, offsets[:-1][(lines == size) & short]


def row_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of each row's sequence of lines."""
    sums = np.zeros(len(hashes) + 1, T.U)
    np.cumsum(T.mix(hashes) * T.powers(T.STEP, len(hashes)), out=sums[1:])
    back = T.powers(T.U(pow(int(T.STEP), -1, 1 << 64)), len(hashes) + 1)[offsets[:-1]]
    return T.signed(T.mix((sums[offsets[1:]] - sums[offsets[:-1]]) * back + np.diff(offsets).astype(T.U)))


def fingerprints(run_length: int, long_words: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, rows in T.slices(batch.column(1)):
                starts, ends, offsets = worded_lines(data, rows)
                hashes = T.span_hashes(data, starts, ends)
                key = row_keys(hashes, offsets)
                for size, whole, at in windows(data, rows, starts, offsets, run_length, long_words):
                    if not len(at):
                        continue
                    owner = np.searchsorted(offsets, at, "right") - 1
                    minima = np.lib.stride_tricks.sliding_window_view(hashes, size).min(axis=1)[at]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(owner + row)), pa.array(key[owner]),
                        pa.array((at - offsets[owner]).astype(np.int32)), pa.array(T.signed(minima)),
                        pa.array(T.signed(T.window_hashes(hashes, size)[at])),
                        pa.array(T.signed(T.window_hashes(T.mix(hashes ^ T.SECOND), size, T.SECOND)[at])),
                        pa.array(np.full(len(at), -size if whole else size, np.int32))],
                        ["doc_id", "key", "line", "fingerprint", "one", "two", "size"])
    return run


def repeated_runs(docs: DataFrame, doc_id: str, text: str, run: int, long_words: int | None) -> DataFrame:
    """Maximal later runs: doc_id, key of the text, first line, lines, and where the first place is."""
    texts = bounded_batches(pick(docs, doc_id=doc_id, text=text)).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    prints = materialize(texts.mapInArrow(
        fingerprints(run, long_words),
        "doc_id bigint, key bigint, line int, fingerprint bigint, one bigint, two bigint, size int"), "fingerprints")
    often = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fingerprint")
    # Grouped by the window alone, whose hashes are spread anew: the windows of a common line do not stay together.
    match = ["one", "two", "size"]  # a size below 0: whole documents of so many lines
    first = prints.join(small(materialize(often, "common-lines")), "fingerprint", "left_semi").groupBy(*match).agg(
        F.min(F.struct("doc_id", "line", "key")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = prints.join(first.select(*match, "first"), match).filter(
        (F.col("doc_id") > F.col("first.doc_id")) | ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("line") > F.col("first.line"))))
    # Neighbouring matches of one size and shift are one match: extended both ways as far as the texts agree.
    later = later.select("doc_id", "key", F.col("first.doc_id").alias("source_id"), (F.col("line") - F.col("first.line")).alias("shift"), "line", F.abs("size").alias("size"))
    held = later.groupBy("doc_id", "key", "source_id", "shift", "size").agg(F.array_sort(F.collect_set("line")).alias("lines"))
    steps = F.zip_with("lines", F.sequence(F.lit(0), F.size("lines") - 1), lambda line, i: F.struct((line - i).alias("run"), line.alias("line")))
    return held.select("doc_id", "key", "source_id", "shift", "size", F.explode(steps).alias("s")).groupBy(
        "doc_id", "key", "source_id", "shift", "size", "s.run").agg(
        F.min("s.line").alias("line"), (F.count(F.lit(1)) + F.col("size") - 1).cast("int").alias("lines")).drop("run", "size")


def cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, by_key = batch.column(0), batch.column(1).to_pylist()
        out, total, removed = texts.to_pylist(), [0] * len(texts), [0] * len(texts)
        for row, stop, data, rows in T.slices(texts):
            hashes, offsets = line_hashes(data, rows)
            key = row_keys(hashes, offsets).tolist()
            for r in range(row, stop):
                total[r] = int(offsets[r - row + 1] - offsets[r - row])
                runs = dict(by_key[r] or ()).get(key[r - row])
                if not runs or out[r] is None:
                    continue
                gone = np.zeros(total[r] + 1, np.int32)
                for x in runs:
                    gone[x["line"]] += 1
                    gone[x["line"] + x["lines"]] -= 1
                gone = np.cumsum(gone) > 0
                removed[r], kept, at = int(gone[:-1].sum()), [], 0
                for piece in out[r].encode().split(b"\n"):
                    worded = bool(piece.split())
                    if not (worded and gone[at]):
                        kept.append(piece)
                    at += worded
                out[r] = b"\n".join(kept).decode() if removed[r] < total[r] else ""
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
            ["row", "text", "n_lines", "n_removed"])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = 3, into: str = "lines",
                long_words: int | None = 50) -> DataFrame:
    """`docs` with the later runs deleted from `text`, and a struct `into` (n_lines, n_removed)."""
    runs = materialize(repeated_runs(docs, doc_id, text, run, long_words), "line-runs")
    runs = runs.groupBy("doc_id", "key").agg(F.collect_list(F.struct("line", "lines")).alias("runs"))
    by_id = runs.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "runs"))).alias("by_key"))
    by_id = materialize(by_id, "line-cuts")
    weight = F.aggregate(F.map_values("by_key"), F.lit(0), lambda n, x: n + F.size(x))
    rest = [c for c in docs.columns if c not in (text, into)]
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    rows = rows.join(small_by(by_id.withColumnRenamed("doc_id", "id"), weight), "id", "left").select("text", "by_key", "row")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, n_lines bigint, n_removed bigint"
    out = rows.mapInArrow(cut_lines, schema)
    order = [F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns if c != into]
    return out.select(*order, F.struct("n_lines", "n_removed").alias(into))
