"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one bit per failed rule;
policies are sets of rules under a version name and read only the bits, so a new policy, or the effect of
leaving a rule out, never reads a text again.

Defined results: NULL and wordless texts measure 0 and fail `few_words`; repeated rows get a row each;
other columns are kept, those named like a ledger column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm import tokens as T
from vigilframe.llm.frames import bounded_batches

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")
WINDOW = 5
SYMBOLS = b"#*$%&|<>"

# Bit i is set if the i-th condition holds.  Bits are never given to another rule; new rules go to the end.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 50 * n_words",
    "shouting": "100 * n_upper > 50 * word_chars",
    "long_words": "word_chars > 25 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE_RULES = ("few_words", "repeated_windows")
POLICIES = {
    "v1": BASE_RULES,
    "v2": (*BASE_RULES, "symbols", "shouting", "long_words", "short_words"),
    "strict": tuple(RULES),
}


def mask(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol, upper, later = (np.zeros(256, np.int32) for _ in range(3))
    symbol[list(SYMBOLS)] = 1
    upper[65:91] = 1
    later[128:192] = 1  # bytes of a character after its first
    newline = np.zeros(256, bool)
    newline[10] = True
    for batch in batches:
        for row, stop, data, rows in T.slices(batch.column(0)):
            starts, ends, offsets = T.spans(data, rows)
            words = T.span_hashes(data, starts, ends)

            def per_row(marks):
                sums = np.r_[0, np.cumsum(marks, dtype=np.int64)]
                return sums[rows[1:]] - sums[rows[:-1]]

            l_start, l_end, _ = T.spans(data, rows, newline)
            ink = np.r_[0, np.cumsum(~T.SPACE[data])]
            worded = ink[l_end] > ink[l_start]
            l_hash = T.span_hashes(data, l_start, l_end)[worded]
            l_border = np.searchsorted(l_start[worded], rows)
            inside = T.row_windows(offsets, WINDOW)
            grams = T.window_hashes(words, WINDOW)[inside] if len(inside) else np.zeros(0, T.U)
            g_border = np.searchsorted(inside, offsets) if len(inside) else np.zeros(len(offsets), np.int64)
            dup, repeated = [], []
            for r in range(stop - row):
                own = l_hash[l_border[r]:l_border[r + 1]]
                dup.append(len(own) - len(np.unique(own)))
                own = grams[g_border[r]:g_border[r + 1]]
                _, back, count = np.unique(own, return_inverse=True, return_counts=True)
                twice = np.flatnonzero(count[back] > 1) if len(own) else []
                repeated.append(int(T.covered(twice, WINDOW, int(offsets[r + 1] - offsets[r])).sum()) if len(twice) else 0)
            out = [np.diff(offsets), per_row(~T.SPACE[data] & (later[data] == 0)), per_row(symbol[data]), np.array(dup),
                   np.array(repeated), per_row(upper[data]), np.diff(l_border)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(row, stop - row), *[pa.array(x.astype(np.int64)) for x in out]], ["row", *MEASURES])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of `docs`, the measurements, and `failed_bits`."""
    rest = [c for c in docs.columns if c != text and c not in (*MEASURES, "failed_bits")]
    rows = bounded_batches(docs).select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    book = rows.mapInArrow(measure, schema)
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << i}L ELSE 0L END" for i, rule in enumerate(RULES.values()))
    return book.select(*[F.col(f"row.`{c}`") for c in rest], *MEASURES, F.expr(bits).alias("failed_bits"))


def verdicts(book: DataFrame, policy) -> DataFrame:
    """The ledger with `kept`: no rule of the policy has failed."""
    return book.withColumn("kept", F.expr(f"failed_bits & {mask(policy)} = 0"))


def ablations(book: DataFrame, policy) -> DataFrame:
    """One row per rule: documents it fails, fails alone, and that would be kept without it; one pass over the bits."""
    whole = mask(policy)
    aggregates = [F.bit_or("failed_bits").alias("any_bits"), F.bit_and("failed_bits").alias("all_bits")]
    for rule in policy:
        bit = mask([rule])
        aggregates.append(F.struct(
            F.lit(rule).alias("rule"), F.count_if(F.expr(f"failed_bits & {bit} != 0")).alias("failed"),
            F.count_if(F.expr(f"failed_bits & {whole} = {bit}")).alias("failed_alone"),
            F.count_if(F.expr(f"failed_bits & {whole & ~bit} = 0")).alias("kept_without")).alias(rule))
    one = book.agg(*aggregates)
    return one.select("any_bits", "all_bits", F.explode(F.array(*policy)).alias("r")).select("r.*", "any_bits", "all_bits")
