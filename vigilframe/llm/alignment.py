"""Alignment of two tokenizers by diagonal run skipping, with corpus-wide counts of the linked id pairs.

Both tokenizers cut the same bytes, a space and the text, so their tokens are two ascending arrays of end offsets.
While the arrays agree at the current shift (index in B less index in A), tokens correspond one to one; exponential
probing compares slices of doubling length and jumps over such a stretch.  Where they part, the shorter side is advanced
until both end at one place: an irregular group, resolved locally, after which the shift is the new one.  A step inside
an irregular group links the two tokens that overlap there, a token of a stretch is linked to its partner.

Counts of id pairs are corpus-wide.  Documents are dealt with in chunks of about `CHUNK` bytes; a chunk lists its
distinct pairs once with its own sums, a document keeps places in that list.  The lists are summed by pair, and the sums
go back to the chunk, so the shuffles carry a row per chunk and pair and not per link.  Only the best count of each id
of B is broadcast, which the size of B's vocabulary bounds.

Tokenizers are read on the driver and sent as bytes.  If A's ids are in the order of its merges and each of its tokens is
encoded as itself, merging by pairs and merging by the ranks of joined bytes come to the same: a pair joined within a span
is then the one that the span's own derivation joins.  The driver checks this, and tasks use the faster rank form.  They encode words with the spaces before them, each once and not at
every occurrence.  B may be cut there because its vocabulary is checked to hold no piece that goes on behind a space, else
it encodes whole texts; A because its pre-tokens end there too, but for texts with certain runs of white space, which A
encodes by its pre-tokens.  Whether the tokens of a word join to its bytes is also found once.

Defined results: NULL and empty texts, and texts whose tokens of A or B do not join to the space and the text, have no
tokens, zeros and empty groups; text that is not UTF-8 is read with U+FFFD for the bad bytes; very long texts are aligned
whole, as a chunk of their own; ties for the best count are all best; repeated rows each count and each get a result; an
empty table gives an empty table; other columns are kept, those named like a result column are replaced, and the text
itself is left out.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.frames import bounded_batches
from vigilframe.llm.pretokens import Cutter, Known, held, odd_classes, texts_of, uncollected
from vigilframe.session import materialize

CHUNK = 4 << 20
SPACE = "▁"
RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def byte_letters() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def as_ranks(description: str) -> bool:
    """Whether the tokenizer may be used by ranks: plain byte-level BPE, ids in the order of merges, tokens encoded as themselves."""
    form = json.loads(description)
    model, before = form["model"], form.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if form.get("normalizer") or model.get("type", "BPE") != "BPE" or any(before.get(k) != v for k, v in plain.items()):
        return False
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return False
    letter, vocabulary = byte_letters(), model["vocab"]
    made = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    singles = sorted(vocabulary[c] for c in letter if c in vocabulary)
    if len(singles) != 256 or None in made or singles + made != sorted(vocabulary.values()):
        return False
    texts, ids = [], []
    for token, i in vocabulary.items():
        word = bytes(letter[c] for c in token)
        if word.decode("utf-8", "ignore").encode() == word:
            texts.append(word.decode())
            ids.append([i])
    library = tokenizers.Tokenizer.from_str(description)
    library.encode_special_tokens = True
    return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)] == ids


class ByteLevel:
    """Tokenizer A."""

    def __init__(self, description: str, pattern: str, odd, by_ranks: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = tokenizers.Tokenizer.from_str(description)
        self.library.encode_special_tokens = True
        letter = byte_letters()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ranked = tiktoken.Encoding("ranked", pat_str=pattern, special_tokens={}, mergeable_ranks={
            bytes(letter[c] for c in t): i for t, i in json.loads(description)["model"]["vocab"].items()}) if by_ranks else None
        self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
        self.cutter, self.known = Cutter(pattern, odd), Known(self.encode)

    def ids(self, pieces: list[str]) -> list[list[int]]:
        if self.ranked:
            return list(map(self.ranked.encode_ordinary, pieces))
        return [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def encode(self, pieces: list[str]) -> list[bytes]:
        return list(map(packed, self.ids(pieces)))

    def of_text(self, text: str) -> bytes:
        """Packed ids of a whole text, by its pre-tokens."""
        return b"".join(b"".join(self.known.of(pieces)) for part in self.cutter.portions([text]) for _, pieces in part)


class Pieces:
    """Tokenizer B, which itself puts a space before a text."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(SPACE, " ").encode()
                      for i, p in enumerate(names)]
        probe = b"".join(self.bytes[i] for i in self.library.encode(" a  b "))
        self.by_word = probe == b"  a  b " and SPACE in names and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in names)
        self.lone = [names.index(SPACE)] if self.by_word else []

    def ids(self, pieces: list[str]) -> list[list[int]]:
        """Ids of texts; the empty one stands for a lone space."""
        return [x if p else self.lone for p, x in zip(pieces, self.library.encode(pieces, num_threads=1))]


def words(text: str) -> list[str]:
    """Words with the spaces before them, less one space, which both tokenizers get before it."""
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in re.findall(" +[^ ]*", " " + text)]


class Encoder:
    """Ids of both tokenizers for space and text."""

    ACROSS = re.compile(r"[^\S ] (?:\s|\Z)")  # white space that a pre-token of A may hold across the border of words

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b, self.known = a, b, Known(self.encode)

    def joins(self, a: list[int], b: list[int], text: str) -> bool:
        whole, of_a, of_b = (" " + text).encode(), self.a.bytes, self.b.bytes
        return b"".join([of_a[i] for i in a]) == whole and b"".join([of_b[i] for i in b]) == whole

    def encode(self, pieces: list[str]) -> list[tuple]:
        """(ids of A, ids of B) of words; (None, None) where they do not join to the word."""
        both = self.a.ids([" " + p for p in pieces]), self.b.ids(pieces)
        whole, wanted = "".join([" " + p for p in pieces]).encode(), np.array([len(p.encode()) + 1 for p in pieces])
        borders, flat, whole_words = [], [], True
        for ids, words_of in zip(both, (self.a.bytes, self.b.bytes)):
            every = list(itertools.chain.from_iterable(ids))
            border = np.cumsum([0, *map(len, ids)])
            length = np.append(0, np.cumsum([len(words_of[i]) for i in every]))[border]
            whole_words &= bool((np.diff(length) == wanted).all()) and b"".join([words_of[i] for i in every]) == whole
            borders.append((4 * border).tolist())
            flat.append(np.array(every, "<u4").tobytes())
        (of_a, of_b), (a, b) = borders, flat
        out = [(a[s:e], b[u:v]) for s, e, u, v in zip(of_a[:-1], of_a[1:], of_b[:-1], of_b[1:])]
        if whole_words:
            return out
        return [pair if self.joins(x, y, p) else (None, None) for pair, x, y, p in zip(out, *both, pieces)]

    def packed(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids of A, ids of B) of texts, both empty where they do not join to the text."""
        cut = [words(t) if t and self.b.by_word else [] for t in texts]
        found, at, out = self.known.of([w for some in cut for w in some]), 0, []
        for text, some in zip(texts, cut):
            pairs = found[at:at + len(some)]
            at += len(some)
            if not text:
                out.append((b"", b""))
                continue
            whole = bool(some) and (None, None) not in pairs
            b = b"".join([p[1] for p in pairs]) if whole else b""
            if not some or (whole and self.ACROSS.search(text)):
                a, b = self.a.of_text(" " + text), b if some else packed(self.b.ids([text])[0])
                whole = self.joins(*(np.frombuffer(x, "<u4").tolist() for x in (a, b)), text)
            else:
                a = b"".join([p[0] for p in pairs]) if whole else b""
            out.append((a, b) if whole else (b"", b""))
        return out


def diagonal_runs(lengths_a: np.ndarray, lengths_b: np.ndarray):
    """Arrays (runs, groups, links): one-to-one stretches (place in A, in B, length), irregular groups (first and end in A,
    in B) and the places linked inside those groups.  The tokens of both sides join to texts of one length.

    Behind a common end the arrays of ends agree as long as the lengths do.  So a probe compares slices of the lengths, as
    two integers whose lowest differing bit names the first place where they part.
    """
    wide = max(lengths_a.max(initial=0), lengths_b.max(initial=0)) > 255
    size, bits = (4, 5) if wide else (1, 3)
    a, b = (x.astype("<u4" if wide else np.uint8).tobytes() for x in (lengths_a, lengths_b))
    of_a, of_b = (memoryview(x).cast("I" if wide else "B") for x in (a, b))
    number, runs, groups, link_a, link_b = int.from_bytes, [], [], [], []
    i, j, n = 0, 0, len(lengths_a)
    while i < n:
        start, shift, step = i, j - i, 8
        while True:
            parted = number(a[size * i:size * (i + step)], "little") ^ number(b[size * j:size * (j + step)], "little")
            if parted:
                step = (parted & -parted).bit_length() - 1 >> bits
                i += step
                j += step
                break
            i += step
            j += step
            if i >= n:  # the last slices were equal, and shorter than the step
                i = n
                break
            step *= 2
        if i > start:
            runs += (start, start + shift, i - start)
            if i == n:
                break
        first_a, first_b = i, j
        ahead = of_a[i] - of_b[j]  # the end in A less the end in B
        link_a.append(i)
        link_b.append(j)
        while ahead:
            if ahead < 0:
                i += 1
                ahead += of_a[i]
            else:
                j += 1
                ahead -= of_b[j]
            link_a.append(i)
            link_b.append(j)
        i += 1
        j += 1
        groups += (first_a, i, first_b, j)
    return (np.array(runs, np.int64).reshape(-1, 3), np.array(groups, np.int64).reshape(-1, 4),
            np.array([link_a, link_b], np.int64))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each stretch, one after the other."""
    first = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)


class Aligner:
    """Aligns lists of texts; the results of a text are its counts, its groups and its distinct id pairs."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.encoder = Encoder(a, b)
        self.length_a, self.length_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        self.bits_b = max(len(b.bytes) - 1, 1).bit_length()
        self.bits = self.bits_b + max(len(a.bytes) - 1, 1).bit_length()
        # Ids as they are written: those of A before another of A or the bar, those of B before another of B or a new group.
        self.written = pa.array([f"{i}{mark}" for i in range(len(a.bytes)) for mark in ",|"]
                                + [f"{i}{mark}" for i in range(len(b.bytes)) for mark in ",;"], pa.large_string())

    def run(self, texts: list[str]):
        """(n_a, n_b, n_groups, n_links, groups) by text, and (text, pair, count) of the distinct pairs, ordered."""
        ids = [[np.frombuffer(x, "<u4") for x in both] for both in zip(*self.encoder.packed(texts))] or [[], []]
        n_a, n_b = (np.array([len(x) for x in some], np.int64) for some in ids)
        a, b = (np.concatenate([np.zeros(0, "<u4"), *some]).astype(np.int64) for some in ids)
        # Texts lie one behind the other: each ends at a common place, so no group crosses two texts.
        with uncollected():
            runs, groups, (link_a, link_b) = diagonal_runs(self.length_a[a], self.length_b[b])
        last_a, last_b = np.zeros(len(a) + 1, bool), np.zeros(len(b) + 1, bool)
        run_a, run_b = spread(runs[:, 0], runs[:, 2]), spread(runs[:, 1], runs[:, 2])
        for last, single, ends in ((last_a, run_a, groups[:, 1]), (last_b, run_b, groups[:, 3])):
            last[single] = True
            last[ends - 1] = True
        last_a, last_b = last_a[:-1], last_b[:-1]
        border_a, border_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
        group_at = np.append(0, np.cumsum(last_a))[border_a]
        text_of_link = np.searchsorted(border_a, np.concatenate([run_a, link_a]), "right") - 1
        pair = np.concatenate([a[run_a] << self.bits_b | b[run_b], a[link_a] << self.bits_b | b[link_b]])
        n_links = np.bincount(text_of_link, minlength=len(texts))
        keys, counts = np.unique(text_of_link << self.bits | pair, return_counts=True)
        written = self.written.take(pa.array(self.order(a, b, last_a, last_b)))
        offsets, data = (np.frombuffer(x, kind) if x is not None and x.size else np.zeros(1, kind) for x, kind in zip(written.buffers()[1:], (np.int64, np.uint8)))
        at, data = offsets[border_a + border_b].tolist(), data.tobytes()
        said = [data[s:max(s, e - 1)].decode() for s, e in zip(at[:-1], at[1:])]
        return n_a, n_b, np.diff(group_at), n_links, said, keys >> self.bits, keys & ((1 << self.bits) - 1), counts

    def order(self, a, b, last_a, last_b) -> np.ndarray:
        """Places in `written` of all tokens, a group's tokens of A before its tokens of B."""
        out = np.zeros(len(a) + len(b), np.int64)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        until_a = np.append(np.flatnonzero(last_a) + 1, 0)
        until_b = np.append(0, np.flatnonzero(last_b) + 1)
        out[np.arange(len(a)) + until_b[group_a]] = 2 * a + last_a
        out[np.arange(len(b)) + until_a[group_b]] = 2 * (len(self.length_a) + b) + last_b
        return out


def squeezed(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending places and their counts, as byte planes of the differences."""
    steps = np.diff(places, prepend=0).astype("<u4")
    planes = np.stack([steps, counts.astype("<u4")], axis=1).view(np.uint8).reshape(len(places), 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True) if len(places) else b""


def unsqueezed(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(packed, 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, n)
    both = np.ascontiguousarray(planes.T).view("<u4")
    return np.cumsum(both[:, 0].astype(np.int64)), both[:, 1].astype(np.int64)


DOC = "row {row}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, n_pairs int, links binary"


def chunks(description, model, mark: str, pattern: str, odd, by_ranks: bool, digest: bool, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held(("aligner", mark), lambda: Aligner(ByteLevel(description.value, pattern, odd, by_ranks), Pieces(model.value)))
        chunk, size, parts, rows = TaskContext.get().partitionId() << 32, 0, [], []

        def flush():
            first = np.cumsum([0] + [len(p[0]) for p in parts])
            text = np.concatenate([p[5] + f for p, f in zip(parts, first)])
            pairs, place = np.unique(np.concatenate([p[6] for p in parts]), return_inverse=True)
            count = np.concatenate([p[7] for p in parts])
            sums = np.bincount(place, weights=count, minlength=len(pairs)).astype(np.int64)
            n = int(first[-1])
            at = np.searchsorted(text, np.arange(n + 1))
            links = [squeezed(place[s:e], count[s:e]) for s, e in zip(at[:-1], at[1:])]
            said = [s for p in parts for s in p[4]]
            if digest:
                said = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in said]
            doc = pa.StructArray.from_arrays(
                [pa.concat_arrays(rows), *[pa.array(np.concatenate([p[k] for p in parts]), pa.int64()) for k in range(4)],
                 pa.array(said, pa.string()), pa.array(np.diff(at).astype(np.int32)), pa.array(links, pa.binary())],
                ["row", "n_a", "n_b", "n_groups", "n_links", "groups", "n_pairs", "links"])
            none = [None] * (n - 1)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(n, chunk)), pa.array(np.arange(1, n + 1, dtype=np.int32)), doc,
                pa.array([pairs, *none], pa.list_(pa.int64())), pa.array([sums, *none], pa.list_(pa.int64()))],
                ["chunk", "seq", "doc", "pairs", "sums"])

        for batch in batches:
            texts = [t or "" for t in texts_of(batch.column(0))]
            start = 0
            while start < len(texts):
                stop, part = start, 0
                while stop < len(texts) and part < chunk_bytes // 4:
                    part += len(texts[stop])
                    stop += 1
                parts.append(aligner.run(texts[start:stop]))
                rows.append(batch.column(1).slice(start, stop - start))
                size += part
                start = stop
                if size >= chunk_bytes:
                    yield flush()
                    chunk, size, parts, rows = chunk + 1, 0, [], []
        if parts:
            yield flush()
    return run


def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by chunk: first the counts of its pairs (seq 0), then its documents."""
    chunk, places, counts, best, table = None, [], [], [], None
    for batch in batches:
        of, seq = (batch.column(k).to_numpy() for k in (0, 1))
        borders = np.flatnonzero((np.diff(of) != 0) | (np.diff(seq > 0))) + 1
        for start, stop in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows]):
            if start == stop:
                continue
            if of[start] != chunk:
                chunk, places, counts, best, table = of[start], [], [], [], None
            if seq[start] == 0:
                places.append(batch.column(2).slice(start, stop - start).to_numpy())
                counts.append(batch.column(3).slice(start, stop - start).to_numpy())
                best.append(batch.column(4).slice(start, stop - start).to_numpy(zero_copy_only=False))
                continue
            if table is None:
                place = np.concatenate([np.zeros(0, np.int64), *places]).astype(np.int64)
                table = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                table[0][place] = np.concatenate([np.zeros(0, np.int64), *counts])
                table[1][place] = np.concatenate([np.zeros(0, np.int64), *best])
                places, counts, best = [], [], []
            doc = batch.column(5).slice(start, stop - start)
            field = dict(zip([f.name for f in doc.type], doc.flatten()))
            n_best, total = [], []
            for n, links in zip(field["n_pairs"].to_pylist(), field["links"].to_pylist()):
                place, count = unsqueezed(links, n)
                n_best.append(int((table[1][place] * count).sum()))
                total.append(int((table[0][place] * count).sum()))
            yield pa.RecordBatch.from_arrays(
                [field["row"], *[field[k] for k in RESULTS[:4]], pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), field["groups"]],
                ["row", *RESULTS])


def listed(table: DataFrame) -> DataFrame:
    """The pair lists of the chunks, one row per chunk and pair."""
    zipped = F.posexplode(F.arrays_zip("pairs", "sums")).alias("place", "p")
    return table.filter("pairs IS NOT NULL").select("chunk", zipped).select("chunk", "place", F.col("p.pairs").alias("pair"), F.col("p.sums").alias("n"))


def pair_counts(table: DataFrame, bits_b: int, vocabulary_b: int) -> DataFrame:
    """(a, b, pair, n, best) of all id pairs of the corpus; `best` marks the most frequent partners of an id of B."""
    counts = materialize(listed(table).groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts").select(
        F.expr(f"shiftright(pair, {bits_b})").alias("a"), F.expr(f"pair & {(1 << bits_b) - 1}").alias("b"), "pair", "n")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    if vocabulary_b <= 1 << 18:  # rows of `top` at most
        top = F.broadcast(top)
    return counts.join(top, "b").select("a", "b", "pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str, text: str = "text", digest: bool = False,
          chunk_bytes: int = CHUNK) -> DataFrame:
    """The other columns of `docs`, and n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    `path_a` is a description of a byte-level tokenizer with the pre-token `pattern`, `path_b` a sentence-piece model.
    `groups` writes `a1,a2|b1;a3|b2,b3`; with `digest` its SHA-256 in lowercase hex, empty where there is no token.
    """
    spark = docs.sparkSession
    with open(path_a, encoding="utf-8") as file_a, open(path_b, "rb") as file_b:
        description, model = file_a.read(), file_b.read()
    vocabulary_b = sentencepiece.SentencePieceProcessor(model_proto=model).get_piece_size()
    bits_b = max(vocabulary_b - 1, 1).bit_length()
    rest = [c for c in docs.columns if c != text and c not in RESULTS]
    packed = F.struct(F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    rows = bounded_batches(docs).select(F.col(f"`{text}`").alias("text"), packed.alias("row"))
    shape = ", ".join(f"{n}: {t}" for n, t in (f.split(" ", 1) for f in DOC.format(row=rows.schema["row"].dataType.simpleString()).split(", ")))
    mark = hashlib.sha256(f"{description}{pattern}".encode() + model).hexdigest()
    run = chunks(spark.sparkContext.broadcast(description), spark.sparkContext.broadcast(model), mark, pattern, odd_classes(),
                 as_ranks(description), digest, chunk_bytes)
    table = materialize(rows.mapInArrow(run, f"chunk bigint, seq int, doc struct<{shape}>, pairs array<bigint>, sums array<bigint>"), "alignments")
    judged = pair_counts(table, bits_b, vocabulary_b).select("pair", "n", "best")
    known = listed(table).select("chunk", "place", "pair").join(judged, "pair")
    empty = table.schema["doc"].dataType.simpleString()
    both = known.select("chunk", F.lit(0).alias("seq"), "place", "n", "best", F.expr(f"CAST(NULL AS {empty})").alias("doc")).unionByName(
        table.select("chunk", "seq", F.lit(0).alias("place"), F.lit(0).cast("bigint").alias("n"), F.lit(False).alias("best"), "doc"))
    fields = ", ".join(f"{c} {'string' if c == 'groups' else 'bigint'}" for c in RESULTS)
    out = both.repartition("chunk").sortWithinPartitions("chunk", "seq").mapInArrow(
        scored, f"row {rows.schema['row'].dataType.simpleString()}, {fields}")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)], *RESULTS)
