"""Phrase collocations from counting quotient filters.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and pieces into words.  Chunks of texts keep
their words as places in a list of the chunk's distinct words.  These lists are summed to the words' counts; words of at
least `least` occurrences get ids, and the ids go back to the chunks in a join, so no vocabulary need be broadcast.
Each chunk then counts its n-grams of two and three such words in a counting quotient filter (`quotient.py`), cut by the
highest bits of the permuted keys into shards, and the sorted filters of a shard are merged.  The number of shards grows
with the words, so a shard holds about `SHARD` n-grams whatever the corpus.  A phrase can only be as frequent as its
parts, so n-grams with rarer words are never needed.

Scores are exact: decimals of 38 digits hold 1000000 * a * a for counts below 10^15.  The best phrases of a language are
ranked in parts first, then among the parts' best.

Defined results: NULL texts have no words; NULL languages are `und`, together with texts that have that value; words that
are not UTF-8 are compared by their bytes; very long texts form a chunk of their own; repeated rows each count; ties go to
the smaller first part, then by phrase in byte order; languages without a phrase, and empty tables, give no rows; only
the columns named by `text` and `lang` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.llm import quotient as Q
from vigilframe.llm import tokens as T
from vigilframe.llm.frames import bounded_batches, pick, small
from vigilframe.session import materialize

CHUNK = 8 << 20   # bytes of text
SHARD = 2 << 20   # n-grams of a shard, copies in different chunks included
BUCKETS = 1024    # of word ids
PARTS = 256       # of a language's ranking
STOPS = np.zeros(256, bool)
STOPS[[*b".,;:!?", 10, 11, 12, 13]] = True
GAPS = STOPS.copy()
GAPS[[32, 9]] = True


def squeezed(values: np.ndarray) -> bytes:
    """Numbers below 2^32, as compressed byte planes."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def unsqueezed(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n).astype(np.int64)


def chunks(chunk_bytes: int):
    """Batches (text, lang) to rows (chunk, stream, n_words, langs, words, counts).

    The stream holds twice the place of each word in the chunk's list, plus one where a piece begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, words, langs, breaks, names = TaskContext.get().partitionId() << 32, 0, [], [], [], {}

        def flush():
            word = pa.concat_arrays(words).dictionary_encode()
            n = max(len(word.dictionary), 1)
            key = np.concatenate(langs) * n + word.indices.to_numpy(zero_copy_only=False)
            distinct, place, count = np.unique(key, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")  # frequent words first: small places, which squeeze well
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            distinct, count = distinct[order], count[order]
            stream = 2 * rank[place] + np.concatenate(breaks)
            listed = word.dictionary.take(pa.array(distinct % n))
            known = list(names)
            return pa.RecordBatch.from_arrays([
                pa.array([chunk]), pa.array([squeezed(stream)], pa.binary()), pa.array([len(stream)]),
                pa.array([[known[i] for i in (distinct // n).tolist()]], pa.list_(pa.string())),
                pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed), pa.array([count], pa.list_(pa.int64()))],
                ["chunk", "stream", "n_words", "langs", "words", "counts"])

        for batch in batches:
            of_row = np.array([names.setdefault(x or "", len(names)) for x in batch.column(1).to_pylist()], np.int64)
            for row, stop, data, rows in T.slices(batch.column(0)):
                data = T.LOWER[data]
                starts, ends, border = T.spans(data, rows, GAPS)
                if len(starts):
                    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
                    letters = data[~GAPS[data]]
                    words.append(pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())))
                    langs.append(np.repeat(of_row[row:stop], np.diff(border)))
                    piece = np.append(0, np.cumsum(STOPS[data]))[starts]
                    fresh = np.diff(piece, prepend=-1) > 0
                    fresh[border[:-1][np.diff(border) > 0]] = True
                    breaks.append(fresh)
                size += len(data)
                if size >= chunk_bytes and words:
                    yield flush()
                    chunk, size, words, langs, breaks = chunk + 1, 0, [], [], []
        if words:
            yield flush()
    return run


def filters(width: int, shard_bits: int):
    """Rows ordered by chunk, first its word ids (seq 0), then its stream, to (shard, filter)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, places, ids = None, [], []
        for batch in batches:
            of, seq = (batch.column(k).to_numpy() for k in (0, 1))
            borders = np.flatnonzero((np.diff(of) != 0) | (np.diff(seq) != 0)) + 1
            for start, stop in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows]):
                if start == stop:
                    continue
                if of[start] != chunk:
                    chunk, places, ids = of[start], [], []
                if seq[start] == 0:
                    places.append(batch.column(2).slice(start, stop - start).to_numpy())
                    ids.append(batch.column(3).slice(start, stop - start).to_numpy())
                    continue
                n = int(batch.column(3)[start].as_py())
                stream = unsqueezed(batch.column(4)[start].as_py(), n)
                id_of = np.zeros(int(stream.max() >> 1) + 1, np.int64)
                if places:
                    id_of[np.concatenate(places)] = np.concatenate(ids)
                found = list(Q.shards(grams(id_of[stream >> 1], (stream & 1) > 0, width), width, shard_bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in found], pa.int32()), pa.array([f for _, f in found], pa.binary())], ["shard", "filter"])
    return run


def grams(ids: np.ndarray, fresh: np.ndarray, width: int) -> Q.Grams:
    """The counted n-grams of two and three words; id 0 marks rare words, `fresh` the first word of a piece."""
    pair = (ids[:-1] > 0) & (ids[1:] > 0) & ~fresh[1:]
    triple = pair[:-1] & pair[1:]
    two, three = np.flatnonzero(pair), np.flatnonzero(triple)
    both = np.concatenate([
        np.stack([np.zeros(len(two), np.int64), ids[two], ids[two + 1]], axis=1),
        np.stack([ids[three], ids[three + 1], ids[three + 2]], axis=1)])
    left, right = Q.permuted(both, width)
    return Q.summed(left, right, np.ones(len(left), np.int64), width)


def merge(width: int, least: int):
    """Rows ordered by shard to the n-grams of at least `least` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, merging = None, Q.Merging(width)

        def flush():
            found = merging.result()
            often = found.count >= least
            ids = Q.restored(found.left[often], found.right[often], width)
            return pa.RecordBatch.from_arrays([*[pa.array(ids[:, k]) for k in range(3)], pa.array(found.count[often])], ["x", "y", "z", "a"])

        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if s != shard:
                    if merging.stack:
                        yield flush()
                    shard, merging = s, Q.Merging(width)
                merging.add(Q.read(data.as_py(), s))
        if merging.stack:
            yield flush()
    return run


def word_ids(table: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n) of all words, and (lang, word, n, id) of those of at least `least` occurrences."""
    listed = table.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("w"))
    words = materialize(listed.groupBy(F.col("w.langs").alias("lang"), F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("n")), "words")
    often = words.filter(F.col("n") >= least).withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(BUCKETS)))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word")).cast("bigint")
    return words, materialize(often.select("lang", "word", "n", (rank * BUCKETS + F.col("bucket")).alias("id")), "word-ids")


def frequent_grams(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10,
                   chunk_bytes: int = CHUNK, shard_grams: int = SHARD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(x, y, z, a): ids and count of all n-grams of two (x is 0) and three words with a >= least; the words; the ids."""
    rows = bounded_batches(pick(docs, text=text, lang=lang)).select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    table = materialize(rows.mapInArrow(
        chunks(chunk_bytes), "chunk bigint, stream binary, n_words bigint, langs array<string>, words array<string>, counts array<bigint>"), "word-streams")
    words, ids = word_ids(table, least)
    top = ids.agg(F.coalesce(F.max("id"), F.lit(1)).alias("top")).first()["top"]
    total = table.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
    width = top.bit_length()
    if width > Q.WIDEST:
        raise ValueError(f"word ids need {width} bits; the packed n-grams hold {Q.WIDEST}, which is over four thousand million frequent words")
    shard_bits = min((2 * total // shard_grams).bit_length(), Q.half(width))
    listed = table.select("chunk", F.posexplode(F.arrays_zip("langs", "words")).alias("place", "w"))
    known = listed.select("chunk", "place", F.col("w.langs").alias("lang"), F.col("w.words").alias("word")).join(
        ids.select("lang", "word", "id"), ["lang", "word"])
    both = known.select("chunk", F.lit(0).alias("seq"), "place", "id", F.lit(None).cast("binary").alias("stream")).unionByName(
        table.select("chunk", F.lit(1).alias("seq"), F.lit(0).alias("place"), F.col("n_words").alias("id"), "stream"))
    cut = both.repartition("chunk").sortWithinPartitions("chunk", "seq").mapInArrow(filters(width, shard_bits), "shard int, filter binary")
    found = cut.repartition("shard").sortWithinPartitions("shard").mapInArrow(merge(width, least), "x bigint, y bigint, z bigint, a bigint")
    return materialize(found, "grams"), words, ids


def exact(name: str) -> str:
    return f"CAST({name} AS DECIMAL(15, 0))"


def score(a: str, l: str, r: str) -> str:
    return f"(CAST(1000000 AS DECIMAL(7, 0)) * ({exact(a)} * {exact(a)})) div ({exact(l)} * {exact(r)})"


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, best: int = 2000, share: int = 50,
                 chunk_bytes: int = CHUNK, shard_grams: int = SHARD) -> DataFrame:
    """The first `best` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases of two words are left out where a phrase of three has at least `share` percent of their occurrences.
    """
    table, words, ids = frequent_grams(docs, text, lang, least, chunk_bytes, shard_grams)
    two = table.filter("x = 0").select(F.col("y").alias("x"), F.col("z").alias("y"), "a")
    three = table.filter("x > 0")
    # The longest counterpart of a pair: its most frequent triple, on either side.
    longer = three.select("x", "y", "a").unionAll(three.select("y", "z", "a")).groupBy("x", "y").agg(F.max("a").alias("longer"))
    word = small(ids)

    def named(frame: DataFrame, column: str) -> DataFrame:
        return frame.join(word.select(
            F.col("id").alias(column), F.col("word").alias(f"{column}_word"), F.col("n").alias(f"{column}_n"), F.col("lang").alias(f"{column}_lang")), column)

    pairs = named(named(two, "x"), "y").join(longer, ["x", "y"], "left").filter(
        f"longer IS NULL OR 100 * longer < {share} * a").selectExpr(
        "x_lang AS lang", "concat(x_word, ' ', y_word) AS phrase", "a", "x_n AS l", "y_n AS r", f"{score('a', 'x_n', 'y_n')} AS score")
    cut = three.join(two.select("x", "y", F.col("a").alias("xy_n")), ["x", "y"]).join(
        two.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("yz_n")), ["y", "z"])
    cut = named(named(named(cut, "x"), "y"), "z").selectExpr(
        "x_lang AS lang", "concat(x_word, ' ', y_word, ' ', z_word) AS phrase", "a", "x_n", "xy_n", "yz_n", "z_n",
        f"{score('a', 'x_n', 'yz_n')} AS one", f"{score('a', 'xy_n', 'z_n')} AS two")
    triples = cut.selectExpr("lang", "phrase", "a", "if(one <= two, x_n, xy_n) AS l", "if(one <= two, yz_n, z_n) AS r", "least(one, two) AS score")
    every = pairs.unionByName(triples)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = every.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= best)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= best)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
