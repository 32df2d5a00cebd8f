"""Pre-tokens of byte-level vocabularies, and what the tokenizer operators share.

A text is cut by the vocabulary's pattern before any merge.  The installed `regex` module knows newer Unicode tables
than the tokenizer libraries, so letters and digits that only the newer tables know are found once on the driver, by
asking the library itself, and texts that hold any of them are cut by a pattern with the library's classes.  Texts of
code points below 256 are cut by the standard module, whose patterns of plain ranges are faster.
"""

from __future__ import annotations

import base64
import contextlib
import functools
import gc
import re
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.frames import bounded_batches

LONG_TEXT = 1 << 20  # characters; longer texts are cut and worked through in portions
PORTION = 1 << 16    # pre-tokens
CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte sequences and their ranks, from lines of base64 and a number."""
    with open(path, "rb") as file:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in file if line.strip())}


def ranges(points: list[int]) -> list[tuple[int, int]]:
    found: list[list[int]] = []
    for p in points:
        if found and found[-1][1] == p - 1:
            found[-1][1] = p
        else:
            found.append([p, p])
    return [(a, b) for a, b in found]


@functools.cache
def odd_classes() -> dict[str, tuple[list, list]]:
    """By class, the ranges of code points that `regex` puts into it and the library does not, and the other way round."""
    every = [chr(p) for p in range(128, 0x110000) if not 0xD800 <= p < 0xE000]
    out = {}
    for name in CLASSES:
        own = regex.compile(name)
        library = tiktoken.Encoding("classes", pat_str=name, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        ours, theirs = set(), set()
        for at in range(0, len(every), 50_000):
            some = "".join(every[at:at + 50_000])
            ours.update(own.findall(some))
            theirs.update(library.decode(library.encode_ordinary(some)))
        out[name] = (ranges(sorted(map(ord, ours - theirs))), ranges(sorted(map(ord, theirs - ours))))
    return out


def in_set(spans: list[tuple[int, int]]) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


@contextlib.contextmanager
def uncollected():
    """No garbage collection: with many live pieces and no cycles it would only walk them again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Cutter:
    """Cuts texts into the pre-tokens of `pattern` as the tokenizer libraries do."""

    def __init__(self, pattern: str, odd: dict[str, tuple[list, list]]):
        low_form, exact = pattern, pattern.replace(r"\S", r"[^\s]")
        low = "".join(map(chr, range(256)))  # the libraries agree on these
        for name in CLASSES:
            low_form = self.replaced(low_form, name, in_set(ranges([ord(c) for c in regex.findall(name, low)])))
            less, more = odd[name]
            if less or more:
                whole = f"[{name}--[{in_set(less)}]]" if less else name
                whole = f"[{whole}||[{in_set(more)}]]" if more else whole
                exact = exact.replace(name, whole)
        self.low = re.compile(low_form)
        self.usual = regex.compile(pattern)
        self.exact = regex.compile(exact, regex.V1)
        every = [s for less, more in odd.values() for s in (*less, *more)]
        self.odd = re.compile(f"[{in_set(every)}]") if every else None

    @staticmethod
    def replaced(pattern: str, name: str, plain: str) -> str:
        """Class names as plain ranges: bare inside brackets, bracketed outside, \\S as the complement."""
        out, inside, i = [], False, 0
        while i < len(pattern):
            if pattern.startswith(name, i):
                out.append(plain if inside else f"[{plain}]")
                i += len(name)
                continue
            if name == r"\s" and pattern.startswith(r"\S", i):
                out.append(f"[^{plain}]")
                i += 2
                continue
            step = 2 if pattern[i] == "\\" else 1
            inside = pattern[i] == "[" or (inside and pattern[i] != "]")
            out.append(pattern[i:i + step])
            i += step
        return "".join(out)

    def chosen(self, text: str):
        try:
            text.encode("latin-1")
            return self.low
        except UnicodeEncodeError:
            pass
        return self.exact if self.odd and self.odd.search(text) else self.usual

    def portions(self, texts: list[str | None]) -> Iterator[list[tuple[int, list[str]]]]:
        """Lists of (place of the text, its pre-tokens) for about `LONG_TEXT` characters; longer texts come in parts."""
        for first, some in groups(texts, LONG_TEXT):
            part = []
            for i, text in enumerate(some, first):
                pattern = self.chosen(text)
                if len(text) <= LONG_TEXT:
                    part.append((i, pattern.findall(text)))
                    continue
                found = (m.group() for m in pattern.finditer(text))
                while pieces := list(islice(found, PORTION)):
                    yield [(i, pieces)]
            yield part


class Known(dict):
    """Results by piece.  Those of new pieces are computed together; beyond `room` bytes all go and it starts anew."""

    def __init__(self, compute: Callable[[list[str]], list], room: int = 160 << 20):
        super().__init__()
        self.compute, self.room, self.held = compute, room, 0

    def of(self, pieces: list[str]) -> list:
        """The results of the pieces, none of which is empty."""
        found = list(map(self.get, pieces))
        if not all(found):
            if self.held > self.room:
                self.clear()
                self.held, found = 0, [None] * len(pieces)
            new = list({p for p, f in zip(pieces, found) if not f})
            with uncollected():
                self.update(zip(new, self.compute(new)))
            self.held += sum(map(len, new)) * 4 + 200 * len(new)  # about what Python takes for them
            found = list(map(self.__getitem__, pieces))
        return found


_last: dict = {}


def held(key: tuple, make: Callable):
    """What `make` gives for the key.  A Python worker keeps the last one, as tasks that follow ask for the same."""
    if _last.get("key") != key:
        _last.clear()
        _last.update(key=key, value=make())
    return _last["value"]


def groups(texts: list[str | None], limit: int) -> Iterator[tuple[int, list[str]]]:
    """(first place, texts) of neighbouring texts with about `limit` characters; NULL texts are empty."""
    first, some, size = 0, [], 0
    for i, text in enumerate(texts):
        some.append(text or "")
        size += len(some[-1])
        if size >= limit:
            yield first, some
            first, some, size = i + 1, [], 0
    if some:
        yield first, some


def texts_of(column: pa.Array) -> list[str | None]:
    """The texts of a column; bytes that are not UTF-8 become U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if t is None else t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()]


def mapped(docs: DataFrame, value: Column, run, fields: str, but: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with the columns `fields` that `run` makes of batches (value, row); `run` yields (row, fields...).

    Other columns are kept, whatever their names are; those named like one of `fields` are replaced.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    rest = [c for c in docs.columns if c not in names and c not in but]
    # The row is rebuilt under place names, so that no name of the input can clash inside the map.
    packed = F.struct(F.lit(0).alias("c"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    rows = bounded_batches(docs).select(value.alias("value"), packed.alias("row"))
    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {fields}")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)], *names)
