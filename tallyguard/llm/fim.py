"""Fill-in-the-middle transformation with a piece table.

A document is a list of descriptors (buffer, first byte, number of bytes) over two buffers that never change: its text and the
sentinels. Cutting splits the text's descriptor at two code points, an arrangement permutes the parts and puts sentinel
descriptors between them, and the output is what the descriptors name, in order. Restoring reads the output as a buffer of
its own: the sentinels part it into descriptors, the inverse permutation puts these in the text's order, and what is left after
the sentinel descriptors are dropped names the text. Hashes stream over descriptors; no text is copied for them.

Where a text is cut and how it is arranged depends on ``seed`` and doc_id alone: h1 to h4 are the first four groups of eight hex
digits of sha256(``<seed>:<doc_id>``). Prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) of n code points, middle after the
larger. A text stays plain if it is empty (null counts as empty), holds a sentinel, or h3 % 100 is ``rate`` or more; else it is spm (suffix,
prefix, middle) if h4 % 100 is under ``spm``, else psm.

A null doc_id is hashed as an empty id. Rows are transformed one by one, repeated or not, and in their partitions: nothing is
shuffled. Memory is proportional to the longest text. Further columns are ignored by transform(), and kept by transform_column().
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.llm.common import map_texts
from tallyguard.llm.textops import chunks

#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 1, 90, 20
#: Order of the text's parts (0 prefix, 1 middle, 2 suffix) in each form.
ORDERS = {"plain": (0,), "psm": (0, 2, 1), "spm": (2, 0, 1)}
#: The sentinel, by its place in SENTINELS, that stands before each part.
BEFORE = {0: 0, 1: 2, 2: 1}
TEXT, MARKS = 0, 1


class Piece(NamedTuple):
    """A descriptor: ``size`` bytes of a buffer from ``start`` on."""

    buffer: int
    start: int
    size: int


class Sentinels:
    """The sentinel buffer and a descriptor for each of its three marks."""

    def __init__(self, marks: tuple[str, str, str]):
        self.marks = tuple(m.encode() for m in marks)
        if len(set(self.marks)) != 3 or not all(self.marks):
            raise ValueError("three different sentinels are needed")
        for a in self.marks:
            for b in self.marks:
                if (a != b and a in b) or any(a[:i] == b[-i:] for i in range(1, min(len(a), len(b)))):
                    raise ValueError(f"sentinels overlap: {a.decode()!r} and {b.decode()!r}")
        self.data = b"".join(self.marks)
        starts = [sum(map(len, self.marks[:i])) for i in range(3)]
        self.pieces = [Piece(MARKS, s, len(m)) for s, m in zip(starts, self.marks, strict=True)]

    def inside(self, data: bytes, start: int, end: int) -> bool:
        return any(data.find(m, start, end) >= 0 for m in self.marks)


def cut(piece: Piece, places: tuple[int, ...]) -> list[Piece]:
    """The piece split at byte places, counted from its buffer's beginning, in rising order."""
    bounds = (piece.start, *places, piece.start + piece.size)
    return [Piece(piece.buffer, a, b - a) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def arrange(parts: list[Piece], form: str, sentinels: Sentinels) -> list[Piece]:
    """Sentinel and text descriptors in the order of ``form``."""
    if form == "plain":
        return parts
    return [x for p in ORDERS[form] for x in (sentinels.pieces[BEFORE[p]], parts[p])]


def parted(data: bytes, start: int, end: int, form: str, sentinels: Sentinels) -> list[Piece]:
    """Descriptors of the parts of an output that lies in ``data``, in the order in which it holds them."""
    if form == "plain":
        return [Piece(TEXT, start, end - start)]
    found, at = [], start
    for p in ORDERS[form]:
        mark = sentinels.marks[BEFORE[p]]
        place = data.find(mark, at, end)
        if place < 0 or (not found and place != start):
            raise ValueError(f"no {form} output: {mark.decode()!r} is missing")
        found.append(place)
        at = place + len(mark)
    ends = [*found[1:], end]
    return [Piece(TEXT, a + len(sentinels.marks[BEFORE[p]]), b - a - len(sentinels.marks[BEFORE[p]])) for a, b, p in zip(found, ends, ORDERS[form], strict=True)]


def restored(parts: list[Piece], form: str) -> list[Piece]:
    """The inverse permutation: the text's parts in their own order."""
    return [parts[ORDERS[form].index(p)] for p in range(len(parts))]


def streamed(pieces: list[Piece], stores: tuple) -> str:
    """Hex sha256 of what descriptors name; ``stores`` are memory views, one for each buffer."""
    digest = hashlib.sha256()
    for b, start, size in pieces:
        digest.update(stores[b][start : start + size])
    return digest.hexdigest()


def draws(seed: int, doc_id) -> tuple[int, int, int, int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[i : i + 4], "big") for i in (0, 4, 8, 12))


def _tables(ids: pa.Array, data: np.ndarray, offsets: np.ndarray, sentinels: Sentinels, seed: int, rate: int, spm: int) -> Iterator[tuple[list[Piece], str, int, int | None, int | None]]:
    """(descriptors of the output, form, code points, those of prefix and middle) of each text of a chunk."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)  # where each code point begins
    first = np.searchsorted(begins, offsets)
    held = data.tobytes()
    for i, doc_id in enumerate(ids.to_pylist()):
        start, end = int(offsets[i]), int(offsets[i + 1])
        n = int(first[i + 1] - first[i])
        h1, h2, h3, h4 = draws(seed, doc_id)
        whole = Piece(TEXT, start, end - start)
        if not n or h3 % 100 >= rate or sentinels.inside(held, start, end):
            yield [whole], "plain", n, None, None
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        place = lambda k: int(begins[first[i] + k]) if k < n else end  # noqa: B023, E731
        form = "spm" if h4 % 100 < spm else "psm"
        yield arrange(cut(whole, (place(a), place(b))), form, sentinels), form, n, a, b - a


def _written(pieces: list[Piece], stores: tuple) -> bytes:
    return b"".join(bytes(stores[b][s : s + n]) for b, s, n in pieces)


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output."""
    marks = Sentinels(sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                stores = (memoryview(data), memoryview(marks.data))
                made = [(_written(p, stores), *rest) for p, *rest in _tables(rows.column(0), data, offsets, marks, seed, rate, spm)]
                out, form, n, a, b = (list(x) for x in zip(*made, strict=True))
                columns = [rows.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.StringType() if c in ("form", "output") else T.LongType()) for c in ("n", "form", "prefix_chars", "middle_chars", "output"))])
    return map_texts(docs.select("doc_id", "text"), run, schema)


def transform_column(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with all its columns and rows, the text replaced by its output: for use between other operators."""
    fields, at = docs.schema.fields, docs.columns.index("text")
    marks = Sentinels(parameters.get("sentinels", SENTINELS))
    seed, rate, spm = (parameters.get(k, v) for k, v in (("seed", SEED), ("rate", RATE), ("spm", SPM)))
    own = docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                stores = (memoryview(data), memoryview(marks.data))
                out = [_written(p, stores) for p, *_ in _tables(rows.column(own), data, offsets, marks, seed, rate, spm)]
                arrays = [pa.array(out, pa.binary()).cast(pa.string()) if i == at else c for i, c in enumerate(rows.columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=rows.schema.names)

    return map_texts(docs, run, T.StructType(fields))


def _restoring(sentinels: tuple[str, str, str], finish, names: list[str]):
    """A function over batches (form, output, ...): what ``finish`` makes of an output's buffers and pieces."""
    marks = Sentinels(sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "output"):
                held, stores = data.tobytes(), (memoryview(data), memoryview(marks.data))
                made = []
                for form, a, b in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    made.append(finish(restored(parted(held, a, b, form, marks), form), Piece(TEXT, a, b - a), stores))
                made = [pa.array(list(x)) for x in zip(*made, strict=True)]
                made = [x.cast(pa.string()) for x in made]
                yield pa.RecordBatch.from_arrays([*rows.columns[2:], *made], names=names)

    return run


def restore(transformed: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, text) from (doc_id, form, output): the exact texts."""
    run = _restoring(sentinels, lambda pieces, whole, stores: (_written(pieces, stores),), ["doc_id", "text"])
    schema = T.StructType([transformed.schema["doc_id"], T.StructField("text", T.StringType())])
    return map_texts(transformed.select("form", "output", "doc_id"), run, schema)


def digests(transformed: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the hashes of the output and of the text restored from it."""
    names = ["doc_id", "n", "form_", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    run = _restoring(sentinels, lambda pieces, whole, stores: (streamed([whole], stores), streamed(pieces, stores)), names)
    kept = [transformed.schema[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, kept)] + [T.StructField(n, T.StringType()) for n in names[5:]])
    rows = transformed.select("form", "output", "doc_id", "n", F.col("form").alias("form_"), "prefix_chars", "middle_chars")
    return map_texts(rows, run, schema).withColumnRenamed("form_", "form")
