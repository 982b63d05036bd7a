"""Near-duplicates by fast similarity sketching, banding and exact verification.

Sketch (Dahlgaard, Knudsen, Thorup, "Fast Similarity Sketching"): round after round every shingle is hashed to one random
bin, and a bin keeps the least value of the first round that reached it; after BINS rounds, round BINS + i hashes
all shingles to bin i, so that every bin fills. The agreeing share of two sketches estimates the sets' Jaccard similarity
with the concentration of independent coordinates, at about n + BINS log BINS steps.

Banding: BANDS keys of BINS / BANDS coordinates; a pair of similarity 0.85 shares none with probability 5e-11 (0.8: 5e-8).

Verification is on the full shingle sets (64-bit hashes of the words' hashes), never on estimates:

1. Texts with equal sets (by a SHA-256 digest of the whole set) are one class; its least id stands for it from here on.
2. In every bucket of a key each member is compared with the least member. Verified links are joined into components.
3. Buckets of up to BLOCK members that are still in several components are compared in full: one matrix
   product gives all intersections, and only a spanning forest of the links leaves the task. Buckets with
   the same members count once.
4. Larger ones that overlap are merged, and split by an exact prefix filter: of two sets that a link joins, each has a value in common
   with the other among its rarest ones, as many as it may lack of the other and one more. Rare is what few members of the group hold (by
   a table of bounded size; any order would be exact), so texts that merely share a passage don't meet again, and their sets
   aren't moved. Those that do meet are compared as in 3, in pairs of blocks of BLOCK_SETS sets: a set of a group of c travels c / BLOCK_SETS times.
   A group whose members share nearly all, so that they would meet under very many rare values, is compared whole in the same way if that moves fewer sets.
5. The components of all links are the classes.

No group meets in one task: buckets are counted by combined aggregation, hot pivots are salted, large buckets split
by rare values and into block pairs. Texts stay where they are: bit filters of bounded size tell which keys and ids go on, and joins
behind them are exact. Only the sets of documents in shared buckets are shuffled: once by id, which every later step
finds them by, and once to each group that they are compared in.

A text without words has an empty set and no links; with fewer words than a shingle, its whole sequence is the one shingle.
Null texts are empty. Rows that repeat an id are one document; where their texts differ, what the id links to is decided by the
one with the least set (compared as bytes), and each row has the size of its own. A row without an id is never kept over one that has an id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import bit_filter, checkpoint, in_filter, kept, map_texts, maybe_broadcast, received, send
from tallyguard.llm.components import connected_components
from tallyguard.llm.textops import LOWER, chunks, mix, prefix_hash, shingles, span_hash, words

BINS = 128
BANDS = 32
BLOCK = 256
#: A block of a group that is compared in full holds about so many sets, and so many bytes of them; one larger set is a block of its own.
BLOCK_SETS, BLOCK_BYTES = 1024, 16 << 20
#: Columns of a presence matrix that are held at once.
COLUMNS = 4096
#: The table of how many members hold a value has 2 to this power cells: 8 MB, whatever the corpus.
RARE_BITS = 20
_NONE = np.uint64(2**64 - 1)


def sketch(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sketches of several sets at once: one row of BINS numbers for each; an empty set's are all the same."""
    docs = len(bounds) - 1
    sizes = np.diff(bounds)
    filled = np.full(docs * BINS, _NONE, np.uint64)
    owner = np.repeat(np.arange(docs), sizes)
    open_ = sizes > 0
    for step in range(2 * BINS):
        mine = open_[owner]
        if not mine.any():
            break
        values, owner = values[mine], owner[mine]
        x = mix(values ^ mix(np.array([step + 1], np.uint64)))
        to = (x >> np.uint64(57)).astype(np.int64) if step < BINS else np.full(len(x), step - BINS)
        least = np.full(docs * BINS, _NONE, np.uint64) if step == 0 else least
        at = owner * BINS + to
        free = filled[at] == _NONE
        at = at[free]
        np.minimum.at(least, at, x[free] & np.uint64((1 << 57) - 1))
        at = np.unique(at)
        filled[at] = mix(least[at] + (np.uint64(step) << np.uint64(57)))
        least[at] = _NONE
        open_ &= (filled.reshape(docs, BINS) == _NONE).any(1)
    return filled.reshape(docs, BINS)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One row of BANDS keys for each sketch; a key tells its band."""
    rows = sketches.reshape(len(sketches), BANDS, BINS // BANDS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sketches), BANDS)).copy()
    for i in range(rows.shape[2]):
        key = mix(key * np.uint64(5) + rows[:, :, i])
    return key


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): each text's distinct shingles of ``k`` words, A to Z lower-cased."""
    lower = LOWER[data]
    starts, ends, bounds = words(data, offsets)
    return shingles(span_hash(prefix_hash(lower), starts, ends), bounds, k)


def _sketcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                values, bounds = shingle_sets(data, offsets, k)
                blob = memoryview(values.tobytes())
                digests = [hashlib.sha256(blob[8 * a : 8 * b]).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                keys = band_keys(sketch(values, bounds)).astype(np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(bounds)), pa.array(digests, pa.binary()), flat], names=["doc_id", "n", "digest", "keys"])

    return run


def _slots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two hashes of each value that a bit filter holds: about one in 250 others passes both at most, until the filter is at its largest."""
    x = mix(values.view(np.uint64))
    return x.view(np.int64), mix(x + np.uint64(1)).view(np.int64)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_slots(batch.column(0).to_numpy())))], names=["h"])


def filter_of(values: DataFrame) -> np.ndarray:
    """A bit filter over a column of longs without nulls, for passing()."""
    return bit_filter(values.mapInArrow(_hashed, "h long"), "h")


def passing(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    a, b = _slots(values)
    return in_filter(table, a) & in_filter(table, b)


def _keyed(held):
    """Of (rep, n, keys): (rep, n, key) for the keys that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(held)
        for batch in batches:
            keys = batch.column(2).flatten().to_numpy()
            at = np.flatnonzero(passing(table, keys))
            own = pa.array(at // BANDS)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(keys[at])], names=["rep", "n", "key"])

    return run


def _setter(k: int, held):
    """Of (doc_id, text): the sets of the ids that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(held)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            for rows, data, offsets in chunks(batch.filter(pa.array(passing(table, batch.column(0).to_numpy())))):
                values, bounds = shingle_sets(data, offsets, k)
                blobs = pa.array([values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), blobs], names=["doc_id", "set"])

    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of one partition, sorted by their first ``keys`` columns, as one table for each key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and any(held[-1].column(i)[-1] != part.column(i)[0] for i in range(keys)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _star(threshold: int):
    """Of groups (a, salt, side, doc, set), the row of side 0 being a's own: the members that a links to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 2):
            side, docs, sets = group["side"].to_numpy(), group["doc"].to_numpy(), _sets(group["set"])
            pivot = [s for s, x in zip(sets, side, strict=True) if x == 0]
            members = [(d, s) for d, s, x in zip(docs, sets, side, strict=True) if x]
            if not pivot or not members:
                continue
            flat = np.concatenate([s for _, s in members])
            ends = np.cumsum([len(s) for _, s in members])
            place = np.minimum(np.searchsorted(pivot[0], flat), len(pivot[0]) - 1)
            hits = np.concatenate([[0], np.cumsum(pivot[0][place] == flat)])
            both = hits[ends] - hits[ends - [len(s) for _, s in members]]
            union = len(pivot[0]) + np.array([len(s) for _, s in members]) - both
            linked = np.array([d for d, _ in members])[100 * both >= threshold * union]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(linked), docs[side == 0][0])), pa.array(linked)], names=["a", "b"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets share, by matrix products over the values that more than one holds."""
    m = len(sets)
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    shared = count[at] > 1
    column = (np.cumsum(count > 1) - 1)[at[shared]]
    owner, total = owner[shared], np.zeros((m, m), np.int32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((m, COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        total += (part @ part.T).astype(np.int32)  # at most COLUMNS, exact in 32 bits
    return total


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the symmetric matrix connects: at most one less than its rows."""
    left, edges = np.ones(len(linked), bool), []
    for root in np.flatnonzero(linked.any(1)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            near = np.flatnonzero(linked[queue[-1]] & left)
            edges += [(queue[-1], x) for x in near]
            left[near] = False
            queue = queue[:-1] + near.tolist()
    return edges


def _blocks(threshold: int):
    """Of groups (gid, i, j, block, doc, part, set): links between documents of different parts, across the two blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, 3):
            i, j = group["i"][0].as_py(), group["j"][0].as_py()
            docs, part, block, sets = group["doc"].to_numpy(), group["part"].to_numpy(), group["block"].to_numpy(), _sets(group["set"])
            if len(docs) < 2:
                continue
            sizes = np.array([len(s) for s in sets])
            both, linked = intersections(sets), np.zeros((len(docs), len(docs)), bool)
            for a in range(0, len(docs), BLOCK):  # few rows at a time: numbers of 64 bits
                own = slice(a, a + BLOCK)
                linked[own] = (100 + threshold) * both[own].astype(np.int64) >= threshold * (sizes[own, None] + sizes[None, :])
                linked[own] &= part[own, None] != part[None, :]
                if i != j:
                    linked[own] &= block[own, None] != block[None, :]
            edges = np.array(_forest(linked), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(docs[edges[:, 0]]), pa.array(docs[edges[:, 1]])], names=["a", "b"])

    return run


def _cells(gid: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Cells of the table of rare values for values of groups."""
    return (mix(values ^ mix(gid.view(np.uint64))) >> np.uint64(64 - RARE_BITS)).astype(np.int64)


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (gid, doc, part, set): how many sets of a batch have a value in each cell."""
    for batch in batches:
        sets = _sets(batch.column(3))
        gid = np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])
        cell, count = np.unique(_cells(gid, np.concatenate(sets) if sets else np.zeros(0, np.uint64)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(count)], names=["cell", "n"])


def _prefixes(threshold: int, held):
    """Of (gid, doc, part, set): the rarest values of each set, one more than it may lack of a set that it links to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = received(held)
        for batch in batches:
            out = [[], [], [], [], []]
            for gid, doc, part, own in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), _sets(batch.column(3)), strict=True):
                size = len(own) - -(-threshold * len(own) // 100) + 1
                rare = own[np.lexsort((own, table[_cells(np.full(len(own), gid), own)]))[:size]].view(np.int64)
                for column, x in zip(out, (np.full(len(rare), gid), rare, np.full(len(rare), doc), np.full(len(rare), part), np.full(len(rare), len(own))), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in out], names=["gid", "value", "doc", "part", "n"])

    return run


def rare_buckets(members: DataFrame, threshold: int) -> DataFrame:
    """(gid, value, doc, part, n): buckets of members (gid, doc, part, set) of n values in which any two of one gid that link meet."""
    table = np.zeros(1 << RARE_BITS, np.int64)
    counted = members.mapInArrow(_holders, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # a row for each cell
    table[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return members.mapInArrow(_prefixes(threshold, send(members.sparkSession, table)), "gid long, value long, doc long, part long, n long")


def _unsettled(members: DataFrame, *keys: str) -> DataFrame:
    """Buckets (``keys``) of (doc, part) with several parts, with their size and a hash of their members."""
    who = F.sum(F.xxhash64("doc").cast("decimal(38,0)"))
    return members.groupBy(*keys).agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("c"), who.alias("who"), F.min("doc").alias("least")).where("low <> high")


def _once(buckets: DataFrame, *keys: str) -> DataFrame:
    """One of the buckets with the same members, and their number ``c``."""
    return buckets.groupBy("who", "c", "least").agg(F.min(F.struct(*keys)).alias("k")).select("k.*", "c")


def _compared(groups: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links between members of different parts of groups (gid, doc, part, n), each compared in full, in block pairs."""
    size = F.greatest(F.count("*") / BLOCK_SETS, 8 * F.sum("n") / BLOCK_BYTES)
    blocks = groups.groupBy("gid").agg(F.ceil(size).cast("int").alias("blocks"))
    dealt = groups.join(maybe_broadcast(checkpoint(blocks)), "gid").withColumn("block", F.expr("cast(pmod(hash(doc), blocks) as int)")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("gid", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc", "part").join(sets, "doc").select("gid", "i", "j", "block", "doc", "part", "set")
    return _by(dealt, "gid", "i", "j").mapInArrow(_blocks(threshold), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * (shared shingles of ``k`` words) >= ``threshold`` * (shingles of either).
    """
    spark, texts = docs.sparkSession, docs.select("doc_id", "text")
    rows = checkpoint(map_texts(texts, _sketcher(k), "doc_id long, n long, digest binary, keys array<long>"))
    classes = checkpoint(rows.where("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")))
    # Buckets with more than one class, and their members.
    known = classes.where("rep is not null").select("rep", "n", "keys")
    bands = known.select("rep", "n", F.explode("keys").alias("key"))
    shared = checkpoint(bands.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct("rep", "n")).alias("p")).where("c > 1").select("key", "c", F.col("p.rep").alias("pivot"), F.col("p.n").alias("pivot_n")))
    kept_keys = known.mapInArrow(_keyed(send(spark, filter_of(shared.select("key")))), "rep long, n long, key long")
    members = checkpoint(kept_keys.join(maybe_broadcast(shared), "key"))
    # The sets of every document that shares a bucket, by id: joins with them move the other side only.
    wanted = filter_of(checkpoint(members.select("rep").distinct()))
    sets = map_texts(texts, _setter(k, send(spark, wanted)), "doc_id long, set binary").withColumnRenamed("doc_id", "doc")
    sets = sets.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc").groupBy("doc").agg(F.min("set").alias("set")).persist(StorageLevel.DISK_ONLY)
    sets.count()  # plans use how it is partitioned only once it is there
    fit = 100 * F.least("n", "pivot_n") >= threshold * F.greatest("n", "pivot_n")
    pairs = checkpoint(members.where(F.col("rep") != F.col("pivot")).where(fit).select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct())
    salts = checkpoint(pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("salts")))
    right = pairs.join(maybe_broadcast(salts), "a").select("a", F.expr("cast(pmod(hash(b), salts) as int)").alias("salt"), F.lit(1).alias("side"), F.col("b").alias("doc"))
    left = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("a").alias("doc"))
    star = right.union(left).join(sets, "doc").select("a", "salt", "side", "doc", "set")
    links = checkpoint(_by(star, "a", "salt").mapInArrow(_star(threshold), "a long, b long"))
    found = connected_components(links)
    # Buckets that one component does not cover: compare their members in full.
    parted = members.select("key", "c", "rep", "n").join(maybe_broadcast(found.select(F.col("node").alias("rep"), "component")), "rep", "left").select("key", "c", F.col("rep").alias("doc"), "n", F.coalesce("component", "rep").alias("part"))
    parted = checkpoint(parted)
    unsettled = checkpoint(_unsettled(parted, "key").where("c > 2"))
    small = _once(unsettled.where(F.col("c") <= BLOCK), "key")
    groups = checkpoint(parted.join(maybe_broadcast(checkpoint(small)), "key", "left_semi").select(F.col("key").alias("gid"), "doc", "part", "n"))
    more = [] if groups.isEmpty() else [_compared(groups, sets, threshold)]
    large = unsettled.where(F.col("c") > BLOCK).select("key", "least")
    spread = checkpoint(parted.join(maybe_broadcast(checkpoint(large)), "key").select("doc", "part", "n", "least"))
    if not spread.isEmpty():
        merged = connected_components(spread.select("doc", "least"))
        members = checkpoint(spread.groupBy("doc", "part").agg(F.max("n").alias("n")).join(maybe_broadcast(merged), F.col("doc") == F.col("node")).select(F.col("component").alias("gid"), "doc", "part", "n"))
        rare = checkpoint(rare_buckets(members.join(sets, "doc").select("gid", "doc", "part", "set"), threshold))
        meet = checkpoint(_once(_unsettled(rare, "gid", "value"), "gid", "value"))
        # Texts that share nearly all meet under many rare values. Where that would move more sets than the whole group, it is compared whole.
        moved = lambda c: c * F.ceil(c / BLOCK_SETS)
        split = meet.groupBy("gid").agg(F.sum(moved(F.col("c"))).alias("split"))
        whole = checkpoint(members.groupBy("gid").agg(F.count("*").alias("c")).join(maybe_broadcast(checkpoint(split)), "gid").where(moved(F.col("c")) < F.col("split")).select("gid"))
        apart = checkpoint(meet.join(maybe_broadcast(whole), "gid", "left_anti").select("gid", "value"))
        for groups in (
            members.join(maybe_broadcast(whole), "gid", "left_semi").select("gid", "doc", "part", "n"),
            rare.join(maybe_broadcast(apart), ["gid", "value"], "left_semi").select(F.xxhash64("gid", "value").alias("gid"), "doc", "part", "n"),
        ):
            groups = checkpoint(groups)
            if not groups.isEmpty():
                more.append(_compared(groups, sets, threshold))
    if more:
        for found_links in more:
            links = links.union(found_links)
        links = checkpoint(links)
        found = connected_components(links)
    sets.unpersist()
    classes = classes.select("digest", "n", "rep").join(maybe_broadcast(found.select(F.col("node").alias("rep"), "component")), "rep", "left").select("digest", "n", F.coalesce("component", "rep").alias("class"))
    out = rows.select("doc_id", "digest", "n").join(maybe_broadcast(checkpoint(classes)), ["digest", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class", "doc_id").alias("component_id"))
    return out.select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def _by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key together in one partition, partitions' keys one after the other."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def drop_near_duplicates(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each component: that with the least id."""
    gone = checkpoint(near_duplicates(docs, k, threshold).where("not kept").select("doc_id").distinct())
    return docs.join(maybe_broadcast(gone), "doc_id", "left_anti")
