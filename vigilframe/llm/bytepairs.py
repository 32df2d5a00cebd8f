"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens.  Those not met before form one linked list of byte runs, with marks where a pre-token
begins; pairs never cross a mark.  Every pair of neighbours whose joined bytes have a rank lies in that rank's bucket, a
heap of list positions.  Three levels of bitmaps say which buckets hold any, 64 to a word, so three find-first-set steps
give the lowest rank; its leftmost position is merged next and its two new pairs are entered.  Entries whose pair has
changed since are stale and skipped.  A list of n bytes takes O(n log n) steps, whether it is one very long pre-token or
many short ones, and no step scans the list.

`encode` adds the ids as packed little-endian unsigned 32-bit integers, `decode` turns such ids back into bytes.  Each
pre-token is encoded by itself, and one that is an entry as a whole takes its id at once, as the tiktoken library does.

Defined results: NULL and empty texts have no ids and decode to no bytes; text that is not UTF-8 is read with U+FFFD
for the bad bytes; very long texts are encoded whole, in portions of pre-tokens; repeated rows each get their ids; an
empty table gives an empty table; ids that are not in the vocabulary, NULL ids and a rest of less than four bytes
decode to nothing; other columns are kept, one named like the added column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.pretokens import Cutter, Known, held, mapped, odd_classes, read_ranks, texts_of


class RankQueue:
    """Buckets of list positions by rank, and bitmaps of three levels that say which ranks have one."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}
        self.heaps: set[int] = set()  # ranks whose bucket was left half empty and is a heap since

    def open(self, rank: int, places: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = places
        word, group = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.mid[group] |= 1 << (word & 63)
        self.top |= 1 << group

    def lowest(self) -> int:
        """The lowest rank with a bucket: the first set bit of each level."""
        group = (self.top & -self.top).bit_length() - 1
        bits = self.mid[group]
        word = group << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> None:
        del self.buckets[rank]
        self.heaps.discard(rank)
        word, group = rank >> 6, rank >> 12
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.mid[group] &= ~(1 << (word & 63))
            if not self.mid[group]:
                self.top &= ~(1 << group)


class Merger:
    """Encodes pre-tokens by the ranks, many at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)  # a byte-level vocabulary has all bytes
        self.double = np.array([ranks.get(bytes([i >> 8, i & 255]), -1) for i in range(1 << 16)], np.int64)

    def merged(self, whole: bytes, head: bytearray) -> np.ndarray:
        """By place of `whole` the id of the token that starts there, -1 where none does; `head` marks where pieces begin."""
        size, queue, rank_of = len(whole), self.queue, self.ranks.get
        letters = np.frombuffer(whole, np.uint8).astype(np.int64)
        first = np.full(size, -1, np.int64)
        first[:-1] = self.double[letters[:-1] << 8 | letters[1:]]
        first[:-1][np.frombuffer(head, np.uint8)[1:] > 0] = -1
        places = np.flatnonzero(first >= 0)
        places = places[np.argsort(first[places], kind="stable")]
        for some in np.split(places, np.flatnonzero(np.diff(first[places])) + 1):
            if len(some):
                queue.open(int(first[some[0]]), some.tolist())
        entered = first.tolist()  # the rank under which the pair that starts at a place is queued
        token = self.single[letters].tolist()
        after = list(range(1, size + 1))
        before = list(range(-1, size))
        buckets, heaps, head = queue.buckets, queue.heaps, head + b"\1"
        while queue.top:
            rank = queue.lowest()
            bucket = buckets[rank]
            heap = rank in heaps
            if not heap:
                bucket.sort(reverse=True)
            lower = False
            while bucket and not lower:
                i = heappop(bucket) if heap else bucket.pop()
                if entered[i] != rank:
                    continue  # stale
                gone = after[i]
                end = after[gone]
                after[i] = end
                before[end] = i
                token[i], token[gone] = rank, -1
                entered[i] = entered[gone] = -1
                if not head[end]:
                    new = rank_of(whole[i:after[end]])
                    if new is not None:
                        entered[i] = new
                        lower = new < rank
                        if new not in buckets:
                            queue.open(new, [i])
                        elif new in heaps:
                            heappush(buckets[new], i)
                        else:
                            buckets[new].append(i)
                if not head[i]:
                    left = before[i]
                    new = rank_of(whole[left:end])
                    if new is None:
                        entered[left] = -1
                    else:
                        entered[left] = new
                        lower = lower or new < rank
                        if new not in buckets:
                            queue.open(new, [left])
                        elif new in heaps:
                            heappush(buckets[new], left)
                        else:
                            buckets[new].append(left)
            if not bucket:
                queue.close(rank)
            elif not heap:
                bucket.reverse()  # ascending, so a heap
                heaps.add(rank)
        return np.array(token, np.int64)

    def packed(self, pieces: list[str]) -> list[bytes]:
        """The packed ids of each piece; a piece that is an entry as a whole has that one id."""
        rank_of = self.ranks.get
        out, rest, where = [b""] * len(pieces), [], []
        for i, piece in enumerate(pieces):
            letters = piece.encode()
            rank = rank_of(letters)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif letters:
                rest.append(letters)
                where.append(i)
        if rest:
            lengths = np.array([len(x) for x in rest], np.int64)
            starts = np.cumsum(lengths) - lengths
            whole = b"".join(rest)
            head = np.zeros(len(whole), np.uint8)
            head[starts] = 1
            token = self.merged(whole, bytearray(head.tobytes()))
            alive = token >= 0
            border = np.append(0, np.cumsum(alive))[np.append(starts, len(whole))].tolist()
            ids = token[alive].astype("<u4").tobytes()
            for k, i in enumerate(where):
                out[i] = ids[4 * border[k]:4 * border[k + 1]]
        return out


def encoder(ranks, mark: str, pattern: str, odd, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(("merger", mark), lambda: Known(Merger(ranks.value).packed))
        cutter = Cutter(pattern, odd)
        for batch in batches:
            out = [[] for _ in range(batch.num_rows)]
            for part in cutter.portions(texts_of(batch.column(0))):
                found, at = known.of([p for _, pieces in part for p in pieces]), 0
                for i, pieces in part:
                    out[i].append(b"".join(found[at:at + len(pieces)]))
                    at += len(pieces)
            out = [b"".join(x) for x in out]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.binary())], ["row", into])
    return run


def decoder(ranks, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [b""] * (max(ranks.value.values(), default=0) + 2)  # the last entry stands for unknown ids
        for word, rank in ranks.value.items():
            words[rank] = word
        for batch in batches:
            out = []
            for packed in batch.column(0).to_pylist():
                ids = np.frombuffer(packed or b"", "<u4", len(packed or b"") // 4)
                out.append(b"".join([words[i] for i in np.minimum(ids, len(words) - 1).tolist()]))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.binary())], ["row", into])
    return run


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """`docs` with the packed ids of `text` by the rank file at `path`, which only the driver reads."""
    read = read_ranks(path)
    ranks = docs.sparkSession.sparkContext.broadcast(read)  # bounded by the vocabulary
    mark = hashlib.sha256(repr(sorted(read.items())).encode()).hexdigest()
    return mapped(docs, F.col(f"`{text}`"), encoder(ranks, mark, pattern, odd_classes(), into), f"{into} binary")


def decode(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`rows` with the bytes that the packed ids stand for."""
    ranks = rows.sparkSession.sparkContext.broadcast(read_ranks(path))
    return mapped(rows, F.col(f"`{ids}`"), decoder(ranks, into), f"{into} binary")
