"""Quality rules on repetition: suffix array, longest-common-prefix intervals, covered fraction and longest repeat.

Each text's words get a suffix array (prefix doubling over the suffixes that are still tied, many texts of a chunk at
once, words being told apart by their text so that no repeat crosses texts). Neighbours in it share their longest
repeats: a position's repeat length is the larger of its two LCP values, and where it can't be extended to the
left it begins a maximal repeated substring. Spans of at least MIN_REPEAT words are united; a document is rejected when
they cover more than MAX_COVERED of its words or one repeat is longer than MAX_LONGEST words, or when it fails a base rule.

Null and empty texts have no words and fail the base rule of 50 words. Rows are judged one by one, whatever their ids;
further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyguard.llm.common import map_texts
from tallyguard.llm.textops import IS_SPACE, chunks, prefix_hash, span_hash, words

MIN_REPEAT = 8
MAX_COVERED = 0.30
MAX_LONGEST = 150
MIN_WORDS = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_covered_words long, longest_repeat long"


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


def _repeated(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is this (text, value) there twice or more; is it not the first)."""
    order = np.lexsort((np.arange(len(value)), value, doc))
    d, v = doc[order], value[order]
    same = np.zeros(len(v), bool)
    same[1:] = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    more, later = np.zeros(len(v), bool), np.zeros(len(v), bool)
    later[order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    more[order] = either
    return more, later


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of a sequence of numbers, and for each power of two the ranks of the windows of that length.

    Equal ranks at level l mean that 2**l symbols agree. The order of symbols is that of the numbers.
    """
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    slot = np.arange(n)

    def ranked(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        return np.maximum.accumulate(np.where(first, at, 0))

    rank = np.empty(n, np.int64)
    rank[sa] = ranked(symbols[sa], slot)
    levels, step = [rank.copy()], 1
    while step < n:
        by_slot = rank[sa]
        tied = np.zeros(n, bool)
        tied[1:] = by_slot[1:] == by_slot[:-1]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        follow = sa[at] + step
        key = by_slot[at] * (n + 1) + np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sa[at] = sa[at][order]
        rank[sa[at]] = ranked(key[order], at)
        levels.append(rank.copy())
        step *= 2
    return sa, levels


def common_prefix(i: np.ndarray, j: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many symbols agree from positions i and j on."""
    n = len(levels[0])
    length = np.zeros(len(i), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = i + length, j + length
        inside = (a < n) & (b < n)
        same = inside & (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)])
        length += same << level
    return length


def repeat_lengths(symbols: np.ndarray) -> np.ndarray:
    """For each position the length of the longest string from there on that also starts elsewhere."""
    best = np.zeros(len(symbols), np.int64)
    if len(symbols) > 1:
        sa, levels = suffix_array(symbols)
        lcp = common_prefix(sa[:-1], sa[1:], levels)
        best[sa[1:]] = lcp
        best[sa[:-1]] = np.maximum(best[sa[:-1]], lcp)
    return best


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a chunk."""
    starts, ends, bounds = words(data, offsets)
    texts = len(offsets) - 1
    counts = np.diff(bounds)
    sums = prefix_hash(data)
    hashes, doc = span_hash(sums, starts, ends), np.repeat(np.arange(texts), counts)
    points, inside = (data & 0xC0) != 0x80, ~IS_SPACE[data]
    out = {"n_words": counts, "word_chars": _per_text(points & inside, offsets), "n_symbols": _per_text(SYMBOLS[data], offsets)}

    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data)) if len(line_start) else line_start
    if len(line_start):
        line_end = line_end - (data[line_end - 1] == 10)
        filled = np.diff(np.concatenate([[0], np.cumsum(inside)])[np.stack([line_start, line_end])], axis=0)[0] > 0
        line_start, line_end = line_start[filled], line_end[filled]
    line_doc = np.searchsorted(offsets, line_start, "right") - 1
    later = _repeated(line_doc, span_hash(sums, line_start, line_end))[1]
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=texts)

    marked = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= 3:
        own = doc[:-2] == doc[2:]
        window = (hashes[:-2] * np.uint64(3) ^ hashes[1:-1]) * np.uint64(5) ^ hashes[2:]
        at = np.flatnonzero(own)
        at = at[_repeated(doc[:-2][own], window[own])[0]]
        np.add.at(marked, at, 1)
        np.add.at(marked, at + 3, -1)
    out["n_repeat_words"] = _per_text(np.cumsum(marked[:-1]) > 0, bounds)

    # Suffix arrays over words that are told apart by their text.
    lengths = repeat_lengths(hashes ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    maximal = lengths >= MIN_REPEAT
    maximal[1:] &= (lengths[:-1] != lengths[1:] + 1) | (doc[1:] != doc[:-1])
    cover = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(maximal)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + lengths[at], -1)
    out["n_covered_words"] = _per_text(np.cumsum(cover[:-1]) > 0, bounds)
    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, doc, lengths)
    out["longest_repeat"] = longest
    out["base_failed"] = (counts < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * counts)
    out["kept"] = ~out["base_failed"] & (out["n_covered_words"] <= MAX_COVERED * counts) & (longest <= MAX_LONGEST)
    return out


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        for rows, data, offsets in chunks(batch):
            found = measure(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), *(pa.array(found[c], pa.bool_() if found[c].dtype == bool else pa.int64()) for c in names[1:])], names=names)


def repetition_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the counts and the verdict; see the module's text."""
    return map_texts(docs.select("doc_id", "text"), _judge, SCHEMA)
