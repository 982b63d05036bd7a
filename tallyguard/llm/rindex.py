"""Suffix-array dedup on a run-length index: remove every byte that a repeated string of LENGTH bytes covers.

The index is a run-compressed Burrows-Wheeler transform (heads of runs, where they begin, where each leads to) with sampled run
ends. Two neighbouring suffixes whose preceding bytes agree stay neighbours one byte earlier, and share one byte more; only at
the ends of a run a new neighbour comes, and what is shared with it is the run's sample. Matching statistics are streamed by
stepping through the runs from the end of each text backwards, from samples of rows every STEP bytes, all of them at once. The suffix
array itself isn't kept. Where a match reaches LENGTH, bytes are marked.

Distribution. Each text is winnowed: of every LENGTH - WINDOW + 1 windows of WINDOW bytes in a row the one with the least
hash is an anchor, so equal strings of LENGTH bytes have an equal anchor at the same place, and an anchor's context, the
union of the strings that have it, decides about them. Then

1. anchors are dropped unless their window, with half a window before or behind it, occurs twice in the corpus,
2. contexts that are equal as a whole (128 bits of hashes) enter the index once; being repeated they are marked as they are,
3. one copy of each remaining context, and no other bytes, goes to the index of its anchor. An index takes whole anchors, about INDEX_BYTES
   of contexts at a time; contexts of one text that overlap are joined, so that no byte is matched with itself,
4. an anchor with more than SHARE contexts (a passage in very many different surroundings) is dealt to several indexes. Each marks
   what repeats in it, and hands on one occurrence of every different string; those that two indexes have are found by
   counting their hashes, the ones without a repeated piece left out first,
5. marks meet their texts by a key of id and text. Only texts with marks are shuffled, once.

Bytes are UTF-8 bytes; matches never cross texts. A null text is empty. Texts under LENGTH bytes keep all bytes but count
like any other. Rows that repeat are texts of their own (so long ones remove each other); further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import BROADCAST_ROWS, bit_filter, checkpoint, in_filter, map_texts, maybe_broadcast, received, semi_join, send
from tallyguard.llm.minhash import _runs
from tallyguard.llm.textops import chunks, mix, powers, prefix_hash, span_hash

LENGTH = 400
INDEX_BYTES = 1_000_000
#: Contexts of one anchor that go to one index, on average.
SHARE = 2_000
#: Bytes that one step-by-step walk through the runs covers at most.
STEP = 512
#: Bit filters of one cascade at most.
LEVELS = 8


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or largest) of every ``width`` values in a row: one result for each full window."""
    step = np.minimum if least else np.maximum
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max if least else 0, values.dtype)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = step.accumulate(table, axis=1).ravel()
    behind = step.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return step(behind[: n - width + 1], ahead[width - 1 : n])


class Chunk:
    """The anchors of the texts of a chunk, and of each the strings that it decides about.

    A string of ``length`` bytes holds length - window + 1 windows; the one with the least hash is its anchor, so the strings of
    an anchor begin at successive places ``low`` to ``high``, and its context reaches from low to high + length. Of equal
    windows in one string the last counts, so that each string belongs to one anchor.
    """

    def __init__(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray, length: int, anchors: bool = True):
        self.data, self.offsets, self.length, self.window = data, offsets, length, length // 2
        self.sums = prefix_hash(data)
        whole = span_hash(self.sums, offsets[:-1], offsets[1:])
        known = ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        self.keys = mix(whole + mix(known * np.uint64(2) + ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint64))).view(np.int64)
        self.at = self.low = self.high = self.doc = np.zeros(0, np.int64)
        if anchors and len(data) >= length:
            self._winnow()
        self.fp = span_hash(self.sums, self.at, self.at + self.window).view(np.int64)

    def _winnow(self) -> None:
        length, window, n = self.length, self.window, len(self.data)
        span = length - window + 1
        value = (self.sums[window:] - self.sums[:-window]) * powers(n + 1)[1][: n - window + 1]
        keys = ((value * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
        none, ends = np.iinfo(np.uint32).max, self.offsets[1:].tolist()
        for end in ends:  # windows that would cross into the next text
            keys[max(0, end - window + 1) : end] = none
        least = _sliding(keys, span, True)
        for end in ends:  # no string of that length begins here
            least[max(0, end - length + 1) : end] = 0
        edges = np.zeros(span - 1, np.uint32)
        at = np.flatnonzero(_sliding(np.concatenate([edges, least, edges]), span, False) == keys)
        # Runs of strings with one least key; each belongs to the anchors with that key in its reach.
        begin = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
        end = np.append(begin[1:], len(least))
        run = np.searchsorted(begin, np.maximum(0, at - span + 1), "right") - 1
        low, high, own, live = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.ones(len(at), bool)
        while live.any():  # the run that holds an anchor's key is at most a few runs on
            r = np.minimum(run, len(begin) - 1)
            hit = live & (least[begin[r]] == keys[at])
            low[hit] = np.maximum(begin[r[hit]], at[hit] - span + 1)
            high[hit] = np.minimum(end[r[hit]] - 1, at[hit])
            own[hit] = r[hit]
            live &= ~hit
            run[live] += 1
        tied = own[:-1] == own[1:]
        high[:-1][tied] = np.minimum(high[:-1][tied], at[1:][tied] - span)
        keep = low <= high
        self.at, self.low, self.high = at[keep], low[keep], high[keep]
        self.doc = np.searchsorted(self.offsets, self.at, "right") - 1

    def place(self) -> np.ndarray:
        """A hash of each anchor's text and place."""
        return mix(self.keys[self.doc].view(np.uint64) + mix((self.at - self.offsets[self.doc]).astype(np.uint64))).view(np.int64)

    def sides(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchor's window with half a window before, or behind it: every string of the anchor holds one of the
        two. 0 where the anchor has no string that needs it."""
        half = self.window // 2
        before, behind = self.at - self.low >= half, self.at - self.high <= self.length - self.window - half
        a = np.where(before, self.at - half, self.at)
        b = np.where(behind, self.at + self.window + half, self.at)
        return np.where(before, span_hash(self.sums, a, self.at + self.window) | np.uint64(1), 0).view(np.int64), np.where(behind, (span_hash(self.sums, self.at, b) | np.uint64(3)) ^ np.uint64(1), 0).view(np.int64)

    def rows(self, keep: np.ndarray) -> dict[str, np.ndarray]:
        a, b, at = self.low[keep], self.high[keep] + self.length, self.at[keep]
        base = self.offsets[self.doc[keep]]
        context = mix(span_hash(self.sums, a, b) + (at - a).astype(np.uint64)).view(np.int64)
        return {"key": self.keys[self.doc[keep]], "fp": self.fp[keep], "ctx": context, "place": self.place()[keep], "first": a - base, "last": b - base}


ANCHOR = "key long, fp long, ctx long, place long, first long, last long"
CONTEXT = "fp long, key long, first long, at long, bytes binary, place long"
#: Text that is winnowed at once: its arrays stay near the processor.
PART_BYTES = 1 << 18


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def _fingerprints(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, size=PART_BYTES):
                sides = np.concatenate(Chunk(rows.column(0), data, offsets, length).sides())
                yield _batch({"h": sides[sides != 0]})

    return run


def _repeated(found: Chunk, table: np.ndarray) -> np.ndarray:
    """Which anchors' windows occur twice with half a window more, by a bit filter over sides()."""
    before, behind = found.sides()
    return ((before != 0) & in_filter(table, before)) | ((behind != 0) & in_filter(table, behind))


def _anchors(length: int, held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = received(held)
        for batch in batches:
            for rows, data, offsets in chunks(batch, size=PART_BYTES):
                found = Chunk(rows.column(0), data, offsets, length)
                yield _batch(found.rows(np.flatnonzero(_repeated(found, table))))

    return run


def _slots(places: np.ndarray, level: int) -> np.ndarray:
    """The hash of places that the filter of a level is about."""
    return mix(places.view(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.int64)


def _hashed(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch({"h": _slots(batch.column(0).to_numpy(), level)})

    return run


def _passing(level: int, held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = received(held)
        for batch in batches:
            places = batch.column(0).to_numpy()
            yield _batch({"place": places[in_filter(table, _slots(places, level))]})

    return run


def cascade(chosen: DataFrame, known: DataFrame) -> tuple[list[np.ndarray], bool]:
    """Bit filters that together tell which of the ``known`` places are ``chosen``, and whether they do so for all.

    Each is as large as its entries ask for. The first is over the chosen places, the second over the others that pass the first, the third over the chosen ones that
    pass the second, and so on until none passes, or LEVELS filters are full.
    """
    spark, tables = chosen.sparkSession, []
    inside, outside = chosen, known
    while len(tables) < LEVELS:
        level = len(tables)
        tables.append(bit_filter(inside.mapInArrow(_hashed(level), "h long"), "h"))
        passed = outside.mapInArrow(_passing(level, send(spark, tables[-1])), "place long")
        passed = checkpoint(passed if level else passed.distinct().join(chosen, "place", "left_anti"))
        if passed.isEmpty():
            return tables, True
        inside, outside = passed, inside
    return tables, False


def in_cascade(tables: list[np.ndarray], exact: bool, places: np.ndarray) -> np.ndarray:
    """Which places are chosen; those that pass all filters of a cascade that isn't exact are taken too."""
    live, out = np.arange(len(places)), np.zeros(len(places), bool)
    for level, table in enumerate(tables):
        passed = in_filter(table, _slots(places[live], level))
        out[live[~passed]] = level % 2 == 1
        live = live[passed]
    out[live] = len(tables) % 2 == 1 or not exact
    return out


def _contexts(length: int, held):
    """The bytes around the anchors at chosen places, each place once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables, exact = received(held)
        sent: set[int] = set()
        for batch in batches:
            for rows, data, offsets in chunks(batch, size=PART_BYTES):
                found = Chunk(rows.column(0), data, offsets, length)
                keep = np.flatnonzero(_repeated(found, table))
                places = found.place()[keep]
                chosen = in_cascade(tables, exact, places)
                new = []
                for i, place in zip(keep[chosen].tolist(), places[chosen].tolist(), strict=True):
                    if place not in sent:  # rows with one id and one text have the same places
                        sent.add(place)
                        new.append(i)
                keep = np.array(new, np.int64)
                blob, low = data.tobytes(), found.low[keep]
                texts = [blob[a:b] for a, b in zip(low.tolist(), (found.high[keep] + length).tolist(), strict=True)]
                yield _batch({"fp": found.fp[keep], "key": found.keys[found.doc[keep]], "first": low - offsets[found.doc[keep]], "at": found.at[keep] - low, "bytes": pa.array(texts, pa.binary()), "place": found.place()[keep]})

    return run


def chosen_contexts(texts: DataFrame, places: DataFrame, anchors: DataFrame, table: np.ndarray, length: int) -> DataFrame:
    """CONTEXT rows of the chosen ``places`` (fp, place) among ``anchors``; a place may come once from each task."""
    spark = texts.sparkSession
    tables, exact = cascade(places.select("place"), anchors.select("place"))
    found = map_texts(texts, _contexts(length, send(spark, (table, tables, exact))), CONTEXT)
    return found if exact else found.join(places.select("fp", "place"), ["fp", "place"], "left_semi").select(*found.columns)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by fp, share and place, without those of the place before."""
    last = None
    for batch in batches:
        if batch.num_rows:
            fp, place = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("fp", "place"))
            new = np.ones(len(fp), bool)
            new[1:] = (fp[1:] != fp[:-1]) | (place[1:] != place[:-1])
            new[0] = last != (fp[0], place[0])
            last = fp[-1], place[-1]
            yield batch if new.all() else batch.filter(pa.array(new))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The suffix array of a sequence of numbers under 2 to the 32: several symbols at once, then prefix doubling of what ties."""
    n = len(symbols)
    packed, width = packed_symbols(symbols)
    sa = np.argsort(packed)
    slot = np.arange(n)

    def ranked(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        return np.maximum.accumulate(np.where(first, at, 0))

    rank = np.empty(n, np.int64)
    rank[sa] = ranked(packed[sa], slot)
    at, step = slot, width
    while step < n:
        by_slot = rank[sa[at]]
        tied = np.zeros(len(at), bool)
        tied[1:] = by_slot[1:] == by_slot[:-1]
        tied[:-1] |= tied[1:]
        at = at[tied]
        if not len(at):
            break
        by_slot, follow = by_slot[tied], sa[at] + step
        key = by_slot * (n + 1) + np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        order = np.argsort(key)
        sa[at] = sa[at][order]
        rank[sa[at]] = ranked(key[order], at)
        step *= 2
    return sa


def packed_symbols(symbols: np.ndarray) -> tuple[np.ndarray, int]:
    """Four symbols from each position on (two, if a symbol has over 16 bits) as one 64-bit number, and how many; beyond the end there
    are zeros."""
    n = len(symbols)
    width = 4 if not n or int(symbols.max()) < 1 << 16 else 2
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(width - 1, np.uint64)])
    packed = padded[:n]
    for i in range(1, width):
        packed = (packed << np.uint64(64 // width)) | padded[i : n + i]
    return packed, width


def common_prefix(packed: np.ndarray, width: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols agree from positions i and j on. Ends differ by unique separators, so nothing runs over."""
    length = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    n = len(packed)
    while len(live):
        a, b = i[live] + length[live], j[live] + length[live]
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        differ = packed[a] ^ packed[b]
        same = differ == 0
        stop = differ[~same]
        for k in range(1, width):
            length[live[~same]] += stop < np.uint64(1 << (64 - k * (64 // width)))
        live = live[same]
        length[live] += width
    return length


class RunLengthIndex:
    """The run-length transform of a text of several segments, with samples at its run ends and at the rows where walks begin."""

    def __init__(self, segments: list[np.ndarray]):
        """``segments``: byte arrays; each is closed by a symbol of its own, the smallest ones."""
        sizes = np.array([len(s) for s in segments])
        self.begin = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.empty(self.begin[-1], np.uint32)
        for k, s in enumerate(segments):
            text[self.begin[k] : self.begin[k + 1] - 1] = s.astype(np.uint32) + len(segments) + 1
            text[self.begin[k + 1] - 1] = k + 1
        sa = suffix_array(text)
        before = text[sa - 1]  # the text is a circle: its first suffix has the last separator before it
        self.first = np.concatenate([[0], np.flatnonzero(before[1:] != before[:-1]) + 1])
        self.last = np.append(self.first[1:], len(sa)) - 1
        self.heads, self.runs, self.size = before[self.first], len(self.first), len(text)
        # Runs by head lie one behind the other, one byte earlier in the text.
        order = np.argsort(self.heads, kind="stable")
        lengths = (self.last - self.first + 1)[order]
        self.to = np.empty(self.runs, np.int64)
        self.to[order] = np.cumsum(lengths) - lengths
        packed, width = packed_symbols(text)
        shared = lambda rows: common_prefix(packed, width, sa[rows - 1], sa[rows])
        inner = shared(self.to[order][1:])
        #: What the suffix to which a run's first row leads shares with the one above it, and its last row's with the one below.
        self.above, self.below = np.zeros(self.runs, np.int64), np.zeros(self.runs, np.int64)
        self.above[order[1:]], self.below[order[:-1]] = inner, inner
        # Walks: from each segment's end, and every STEP bytes before it.
        steps = -(-sizes // STEP)
        ends = np.repeat(self.begin[1:] - 1, steps)
        self.at = ends - STEP * (np.arange(len(ends)) - np.repeat(np.cumsum(steps) - steps, steps))
        self.walk = np.minimum(STEP, self.at - np.repeat(self.begin[:-1], steps))
        where = np.empty(len(sa), np.int64)
        where[sa] = np.arange(len(sa))
        self.row = where[self.at]
        self.up, self.down = shared(self.row), shared(np.minimum(self.row + 1, len(sa) - 1))
        self.up[self.row == 0], self.down[self.row == len(sa) - 1] = 0, 0

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each text position the length of the longest string from there on that also starts elsewhere, and of the longest that
        also starts at a suffix above it. Separators have none."""
        best, above = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        order = np.argsort(-self.walk, kind="stable")
        at, row, up, down, walk = self.at[order], self.row[order], self.up[order], self.down[order], self.walk[order]
        live = np.searchsorted(-walk, -np.arange(1, (walk[0] if len(walk) else 0) + 1), "right")
        for step, n in enumerate(live.tolist(), 1):
            row, up, down = row[:n], up[:n], down[:n]
            run = np.searchsorted(self.first, row, "right") - 1
            up = np.where(row == self.first[run], self.above[run], up + 1)
            down = np.where(row == self.last[run], self.below[run], down + 1)
            row = row - self.first[run] + self.to[run]
            here = at[:n] - step
            above[here] = up
            best[here] = np.maximum(up, down)
        return best, above


def long_matches(segments: list[np.ndarray], length: int) -> tuple[list[list[tuple[int, int]]], np.ndarray, np.ndarray]:
    """For each segment the spans covered by strings of ``length`` bytes that also start elsewhere in the segments; and where each
    segment begins in the text of all, with the length that each position shares with a suffix above it."""
    index = RunLengthIndex(segments)
    match, above = index.matching_statistics()
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    at = np.flatnonzero(match >= length)
    if len(at):
        reach = at + match[at]
        segment = np.searchsorted(index.begin, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] > np.maximum.accumulate(reach)[:-1]) | (segment[1:] != segment[:-1])
        heads = np.flatnonzero(new)
        for a, b in zip(heads, np.append(heads[1:], len(at)), strict=True):
            k = segment[a]
            out[k].append((int(at[a] - index.begin[k]), int(reach[a:b].max() - index.begin[k])))
    return out, index.begin, above


#: What an index makes: marks, without bytes; and of an anchor in several indexes parts of contexts, with bytes.
MADE = "fp long, key long, first long, last long, at long, bytes binary, place long"


def _indexer(length: int):
    """Of contexts sorted by fp, share and place: marked spans, and what other indexes must know of those in ``shares`` indexes."""

    def made(groups: list[dict]) -> Iterator[pa.RecordBatch]:
        held = {c: np.concatenate([g[c] for g in groups]) for c in ("fp", "key", "first", "at", "place", "shares")}
        texts = [x for g in groups for x in g["bytes"]]
        keys, firsts = held["key"], held["first"]
        merged: list[list] = []
        home = np.zeros((len(texts), 2), np.int64)  # each context's segment, and where in it
        for i in np.lexsort((firsts, keys)):
            part = np.frombuffer(texts[i], np.uint8)
            if merged and merged[-1][0] == keys[i] and firsts[i] <= merged[-1][1] + merged[-1][3]:
                over = merged[-1][1] + merged[-1][3] - firsts[i]
                if over < len(part):
                    merged[-1][2].append(part[over:])
                    merged[-1][3] += len(part) - over
            else:
                merged.append([keys[i], firsts[i], [part], len(part)])
            home[i] = len(merged) - 1, firsts[i] - merged[-1][1]
        found, begin, above = long_matches([np.concatenate(m[2]) for m in merged], length)
        rows = np.array([(m[0], m[1] + a, m[1] + b) for m, s in zip(merged, found, strict=True) for a, b in s], np.int64).reshape(-1, 3)
        none = pa.nulls(len(rows), pa.int64())
        yield _batch({"fp": none, "key": rows[:, 0], "first": rows[:, 1], "last": rows[:, 2], "at": none, "bytes": pa.nulls(len(rows), pa.binary()), "place": none})
        # The first of equal strings in the order of suffixes stands for them all.
        rest = [[], []]
        for i in np.flatnonzero(held["shares"] > 1):
            start = begin[home[i, 0]] + home[i, 1]
            alone = np.flatnonzero(above[start : start + len(texts[i]) - length + 1] < length)
            if len(alone):
                cuts = np.flatnonzero(np.diff(alone) > 1) + 1
                for run in np.split(alone, cuts):
                    rest[0].append((i, run[0], run[-1] + length))
                    rest[1].append(texts[i][run[0] : run[-1] + length])
        if rest[0]:
            i, a, b = np.array(rest[0], np.int64).T
            yield _batch({"fp": held["fp"][i], "key": keys[i], "first": firsts[i] + a, "last": firsts[i] + b, "at": held["at"][i] - a, "bytes": pa.array(rest[1], pa.binary()), "place": held["place"][i]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held = [], 0
        for group in _runs(_once(batches), 2):
            own = {c: group[c].to_numpy() for c in ("fp", "key", "first", "at", "place", "shares")}
            own["bytes"] = [x.as_py() for x in group["bytes"]]
            groups.append(own)
            held += sum(map(len, own["bytes"]))
            if held >= INDEX_BYTES:
                yield from made(groups)
                groups, held = [], 0
        if groups:
            yield from made(groups)

    return run


def _grid(length: int):
    """Of each context the strings of nine tenths of ``length`` at every tenth before the anchor: (hash)."""
    step = max(1, length // 10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                part = np.frombuffer(text, np.uint8)
                starts = np.arange(at % step, min(at, len(part) - length + step) + 1, step)
                yield _batch({"h": span_hash(prefix_hash(part), starts, starts + length - step).view(np.int64)})

    return run


def _strings(length: int, held, marks: bool):
    """The strings of ``length`` bytes of a context whose piece on the grid is among the sorted numbers ``held`` (None: all strings):
    (hash, key, first). With ``marks``, ``held`` has the repeated strings themselves, and what they cover comes out:
    (key, first, last)."""
    step = max(1, length // 10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = received(held)
        for batch in batches:
            for key, first, at, text in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4, 5)), strict=True):
                part = np.frombuffer(text, np.uint8)
                sums, starts = prefix_hash(part), np.arange(len(part) - length + 1)
                if marks:
                    near = starts[np.isin(span_hash(sums, starts, starts + length).view(np.int64), known)]
                    cut = _union(np.stack([near, near + length], axis=1))
                    yield _batch({"key": np.full(len(cut), key), "first": cut[:, 0] + first, "last": cut[:, 1] + first})
                else:
                    piece = starts + (at - starts) % step  # the first place of the grid from the string's start on
                    near = starts if known is None else starts[np.isin(span_hash(sums, piece, piece + length - step).view(np.int64), known)]
                    yield _batch({"h": span_hash(sums, near, near + length).view(np.int64), "key": np.full(len(near), key), "first": near + first})

    return run


def _small(values: DataFrame) -> np.ndarray | None:
    """The numbers of a column, sorted, if they are counted to be few enough to send to every task."""
    return np.sort(np.array([r[0] for r in values.collect()], np.int64)) if values.count() <= BROADCAST_ROWS else None


def _between(parts: DataFrame, length: int) -> DataFrame:
    """Marks of strings that several indexes of an anchor have, by counting the strings that each handed on (rows of MADE).

    Most strings of such an anchor are unique. A string is counted only if a piece of it, nine tenths long, is repeated.
    """
    spark = parts.sparkSession
    pieces = _small(checkpoint(parts.mapInArrow(_grid(length), "h long").groupBy("h").count().where("count > 1").select("h")))
    strings = parts.mapInArrow(_strings(length, send(spark, pieces), False), "h long, key long, first long")
    twice = checkpoint(strings.groupBy("h").count().where("count > 1"))
    few = _small(twice.select("h"))
    if few is not None:
        return parts.mapInArrow(_strings(length, send(spark, few), True), "key long, first long, last long")
    found = semi_join(strings, twice.withColumnRenamed("count", "n"), ["h"], twice.agg(F.sum("count")).first()[0])
    return found.select("key", "first", (F.col("first") + length).alias("last"))


def _union(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of spans (first, last) that overlap or touch."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    heads = np.flatnonzero(new)
    return np.stack([spans[heads, 0], reach[np.append(heads[1:], len(spans)) - 1]], axis=1)


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(ids: list, texts: list[bytes], marks: list) -> pa.RecordBatch:
    removed, spans, digests = [], [], []
    for text, own in zip(texts, marks, strict=True):
        cut = _union(np.array([(m["first"], m["last"]) for m in own or ()], np.int64).reshape(-1, 2))
        at, digest = 0, hashlib.sha256()
        for a, b in cut:
            digest.update(text[at:a])
            at = b
        digest.update(text[at:])
        removed.append(int((cut[:, 1] - cut[:, 0]).sum()) if len(cut) else 0)
        spans.append(len(cut))
        digests.append(digest.hexdigest())
    return _batch({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(list(map(len, texts)), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def _keyed(length: int, held, marked: bool):
    """Texts with marks as (doc_id, key, bytes), or the finished rows of those without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = received(held)
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                found = Chunk(rows.column(0), data, offsets, length, anchors=False)
                keep = np.flatnonzero(in_filter(table, found.keys) == marked)
                blob = data.tobytes()
                texts = [blob[offsets[i] : offsets[i + 1]] for i in keep]
                ids = rows.column(0).take(pa.array(keep))
                if marked:
                    yield _batch({"doc_id": ids.cast(pa.int64()), "key": found.keys[keep], "bytes": pa.array(texts, pa.binary())})
                else:
                    yield _kept(ids.to_pylist(), texts, [None] * len(keep))

    return run


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            yield _kept(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist())


def repeated_spans(docs: DataFrame, length: int = LENGTH, share: int = SHARE) -> DataFrame:
    """(key, first, last): byte spans that repeated strings of ``length`` bytes cover; see Chunk for the key."""
    spark, texts = docs.sparkSession, docs.select("doc_id", "text")
    sides = map_texts(texts, _fingerprints(length), "h long").groupBy("h").count().where("count > 1").select("h")
    table = bit_filter(checkpoint(sides), "h")
    anchors = checkpoint(map_texts(texts, _anchors(length, send(spark, table)), ANCHOR))
    # Contexts: those that occur again are marked as they are; one copy of each stands for all.
    copies = checkpoint(anchors.groupBy("fp", "ctx").agg(F.count("*").alias("n"), F.min("place").alias("place")))
    total = copies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    marks = semi_join(anchors, copies.where("n > 1").select("fp", "ctx", "n"), ["fp", "ctx"], total).select("key", "first", "last")
    several = copies.groupBy("fp").agg(F.count("*").alias("contexts"), F.min("n").alias("fewest")).where("contexts > 1 and fewest = 1").select("fp", F.ceil(F.col("contexts") / share).cast("long").alias("shares"))
    several = checkpoint(several)
    chosen = checkpoint(copies.join(several, "fp", "left_semi").select("fp", "place"))
    if chosen.isEmpty():
        return marks
    contexts = chosen_contexts(texts, chosen, anchors, table, length)
    spread = several.where("shares > 1")
    some = not spread.isEmpty()
    dealt = contexts.join(maybe_broadcast(spread), "fp", "left").withColumn("shares", F.coalesce("shares", F.lit(1).cast("long"))) if some else contexts.withColumn("shares", F.lit(1).cast("long"))
    dealt = dealt.select("fp", F.pmod(F.xxhash64("place"), "shares").alias("share"), "key", "first", "at", "bytes", "place", "shares")
    made = dealt.repartition("fp", "share").sortWithinPartitions("fp", "share", "place").mapInArrow(_indexer(length), MADE)
    if some:
        made = checkpoint(made)
        marks = marks.union(_between(made.where("bytes is not null"), length))
    return marks.union(made.where("bytes is null").select("key", "first", "last"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, share: int = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark, texts = docs.sparkSession, docs.select("doc_id", "text")
    marks = checkpoint(repeated_spans(docs, length, share).groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("marks")))
    held = send(spark, bit_filter(marks, "key"))
    clean = map_texts(texts, _keyed(length, held, False), OUT)
    touched = map_texts(texts, _keyed(length, held, True), "doc_id long, key long, bytes binary")
    cut = map_texts(touched.join(marks, "key", "left").select("doc_id", "bytes", "marks"), _cutter, OUT)
    return clean.union(cut)
