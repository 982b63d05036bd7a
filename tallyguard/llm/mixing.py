"""Mixing sources to target weights by entropy balancing.

Among all document rates between 0 and MOST that meet every source's token target, the one closest to "take
everything once" (in relative entropy) has the form min(MOST, exp(lambda * size)), with one dual variable for each
source. Newton steps on the convex dual find it; each step is one aggregation over the (source, size) histogram,
combined before its shuffle. A source's documents are then rounded to whole copies: a document takes its c-th copy
once a common threshold of its source passes c - rate - u, with u drawn from the id's hash. The threshold is
read off two levels of histograms: the first copies, in that order, that stay under the target. Of the copies behind it (about NEXT
of each source) every one that still fits is taken, in the same order, so that a large document at the threshold doesn't keep
smaller ones out.

Everything after the histogram has a row for each source; documents themselves are never shuffled, and no task holds all
sources: they are ranked by ranges, and the level of the targets is found by a few sums. Sources are
ranked by code point, a null source last; its weight and share follow the same rule as any other's. A null text has
size 0, and a document of size 0 is taken once: it costs nothing. An empty table gives an empty mix. Rows that
repeat count and are taken one by one. Columns whose names clash with the operator's own are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import WORD, checkpoint, maybe_broadcast

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Newton steps after which an unsettled source is an error; halving alone settles any within about a hundred.
MAX_STEPS = 200
TOLERANCE = 1e-9
#: Cells of one level of the rounding histogram, over thresholds from -2 to 2.
CELLS = 4096
#: Documents of a source, on average, that are looked at behind its threshold.
NEXT = 1000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target, mean) from (source, size): weighted shares of ``share`` of all sizes, filled up to
    ``most`` times each source.

    The level starts where it shares everything; sources over their caps leave with them, the rest shares again, until none is
    over. Each round is one sum over the sources.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    by = checkpoint(ranked(by, F.col("source").asc_nulls_last()).withColumn("weight", weight).withColumn("cap", most * F.col("source_size")).drop("rank"))
    level = None
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > F.col("cap") * (1 + 1e-12)
        row = by.agg(F.sum("source_size").alias("all"), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("weight"), F.count_if(over).alias("n")).first()
        if row["weight"] is None or (level is not None and row["n"] == capped):
            break
        level, capped = (share * row["all"] - row["full"]) / row["weight"], row["n"]
    return by.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"), (F.greatest("source_size", F.lit(1)) / F.col("rows")).alias("mean"))


def ranked(rows: DataFrame, order: Column) -> DataFrame:
    """``rows`` with their ``rank`` from 0 on: ranges are sorted one by one and begin where the ranges before them end."""
    dealt = checkpoint(rows.repartitionByRange(order).withColumn("__part", F.spark_partition_id()))
    starts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))  # a row for each partition
    starts = starts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return dealt.withColumn("__at", within).join(F.broadcast(starts), "__part").withColumn("rank", F.col("__start") + F.col("__at") - 1).drop("__part", "__at", "__start")


def _rate(size: Column) -> Column:
    """The tilted rate, to six places, so that sums in another order cannot change a copy."""
    tilted = F.exp(F.least(F.col("dual") * size / F.col("mean"), F.lit(50.0)))
    rate = F.when(F.col("target") >= MOST * F.col("source_size"), MOST).when(F.col("target") <= 0, 0.0).otherwise(F.least(F.lit(MOST), tilted))
    return F.round(F.when(size == 0, 1.0).otherwise(rate), 6)


def _dual(histogram: DataFrame, by: DataFrame, sources: int) -> DataFrame:
    """``by``, a row for each of ``sources``, with each source's dual variable."""
    state = by.select("*", F.lit(0.0).alias("dual"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), ((F.col("target") <= 0) | (F.col("target") >= MOST * F.col("source_size"))).alias("done"))
    state = checkpoint(state)
    x, w = F.col("size") / F.col("mean"), F.exp(F.least(F.col("dual") * F.col("size") / F.col("mean"), F.lit(50.0)))
    for step_ in range(MAX_STEPS + 1):
        if state.where("not done").isEmpty():
            break
        if step_ == MAX_STEPS:
            raise ValueError(f"{state.where('not done').count()} sources have no dual variable after {MAX_STEPS} steps")
        held = histogram.join(maybe_broadcast(state.where("not done"), sources), histogram["source"].eqNullSafe(state["source"])).drop(histogram["source"])
        mass = held.groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * F.least(F.lit(MOST), w)).alias("value"),
            F.sum(F.when(w < MOST, F.col("n") * F.col("size") * w * x).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("value") - F.col("target")
        low, high = F.when(gap < 0, F.col("dual")).otherwise(F.col("low")), F.when(gap > 0, F.col("dual")).otherwise(F.col("high"))
        newton = F.col("dual") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        # Outside the bracket: halve it, or double the step while one end is still open.
        halved = F.when((low <= -1e6) | (high >= 1e6), F.when(gap < 0, 2 * F.abs("dual") + 1).otherwise(-2 * F.abs("dual") - 1)).otherwise((low + high) / 2)
        at_end = F.abs(gap) <= TOLERANCE * F.col("target")
        step = F.when(at_end, F.col("dual")).when(inside, newton).otherwise(halved)
        joined = state.alias("s").join(maybe_broadcast(mass, sources).alias("m"), F.col("s.source").eqNullSafe(F.col("m.source")), "left").select("s.*", "value", "slope")
        moved = F.col("done") | F.col("value").isNull()
        state = checkpoint(joined.select(*by.columns, F.when(moved, F.col("dual")).otherwise(step).alias("dual"), F.when(moved, F.col("low")).otherwise(low).alias("low"), F.when(moved, F.col("high")).otherwise(high).alias("high"), (moved | at_end).alias("done")))
    return state.select(*by.columns, F.round("dual", 7).alias("dual"))


def _points(size: Column, u: Column) -> list[Column]:
    """Where each copy of a document stands in its source's order."""
    return [F.round(c - _rate(size) - u, 9) for c in range(1, int(MOST) + 1)]


def _thresholds(docs: DataFrame, by: DataFrame, sources: int) -> DataFrame:
    """``by``, a row for each of ``sources``, with the threshold of each source, from two histogram levels of its copies' points, and the points behind it
    whose copies still fit."""
    limited = by.select("*", F.lit(-2.0).alias("start"), F.lit(0).cast("long").alias("taken"), F.lit(4.0).alias("width"))
    spread = lambda state: docs.join(maybe_broadcast(state, sources), docs["source"].eqNullSafe(state["source"])).drop(docs["source"]).withColumn("point", F.explode(F.array(*_points(F.col("size"), F.col("u")))))
    for _ in range(2):
        limited = checkpoint(limited)
        cell = F.floor((F.col("point") - F.col("start")) / (F.col("width") / CELLS))
        cells = spread(limited).where(cell.between(0, CELLS - 1)).groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("cell_size"))
        run = cells.withColumn("upto", F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell")))
        run = run.join(maybe_broadcast(limited.select("source", "taken", "target"), sources).alias("l"), run["source"].eqNullSafe(F.col("l.source"))).drop(F.col("l.source"))
        whole = run.where(F.col("taken") + F.col("upto") <= F.col("target") + 1e-6).groupBy("source").agg(F.max("cell").alias("cell"), F.max("upto").alias("upto"))
        moved = limited.alias("a").join(maybe_broadcast(whole, sources).alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.*", "b.cell", "b.upto")
        step = F.col("width") / CELLS
        limited = moved.select(*by.columns, (F.col("start") + (F.coalesce("cell", F.lit(-1)) + 1) * step).alias("start"), (F.col("taken") + F.coalesce("upto", F.lit(0))).alias("taken"), step.alias("width"))
    limited = checkpoint(limited.select(*by.columns, F.col("start").alias("threshold"), (F.col("target") - F.col("taken")).alias("left")))
    # Points are uniform for documents of one size, so a source has about NEXT documents in this stretch. Equal points go together.
    behind = spread(limited).where((F.col("size") > 0) & (F.col("size") <= F.col("left")) & (F.col("point") >= F.col("threshold")) & (F.col("point") < F.col("threshold") + NEXT / F.col("rows")))
    behind = behind.groupBy("source", "left", "point").agg(F.sum("size").alias("size")).where(F.col("size") <= F.col("left"))
    order = behind.groupBy("source").agg(F.first("left").alias("left"), F.array_sort(F.collect_list(F.struct("point", "size"))).alias("next"))
    start = F.struct(F.col("left").alias("left"), F.expr("array()").cast("array<double>").alias("points"))
    fitting = F.aggregate("next", start, lambda s, x: F.when(x["size"] <= s["left"], F.struct((s["left"] - x["size"]).alias("left"), F.concat(s["points"], F.array(x["point"])).alias("points"))).otherwise(s))
    filled = checkpoint(order.select(F.col("source").alias("s"), fitting["points"].alias("fill")))
    joined = limited.join(_sent(filled), F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.select(*by.columns, "threshold", F.coalesce("fill", F.expr("array()").cast("array<double>")).alias("fill"))


def _sent(by: DataFrame) -> DataFrame:
    """Rows with a ``fill`` of up to about NEXT numbers each: broadcast if their numbers, all counted, are few enough."""
    return maybe_broadcast(by, by.agg(F.coalesce(F.sum(F.size("fill") + 8), F.lit(0))).first()[0] // 2)


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """(each document's id, source, size and draw; each source's size, target, dual variable, threshold and fill)."""
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "size"), 11) / F.lit(float(1 << 53))
    sizes = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"))
    sizes = checkpoint(sizes.select("doc_id", "source", "size", draw.alias("u")))
    histogram = checkpoint(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))
    by = checkpoint(targets(histogram.select("source", F.expr("size * n").alias("size")), weights, share).drop("mean"))
    rows = histogram.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("rows"))
    sources = by.count()
    by = by.join(maybe_broadcast(rows, sources), F.col("source").eqNullSafe(F.col("s"))).select("source", "source_size", "target", "rows", (F.greatest("source_size", F.lit(1)) / F.col("rows")).alias("mean"))
    by = checkpoint(_thresholds(sizes, checkpoint(_dual(histogram, checkpoint(by), sources)), sources))
    return sizes, by


def _copies(size: Column, u: Column) -> Column:
    """Points under the source's threshold, or among those that fit behind it; a source at its cap takes all."""
    under = sum((F.when((p < F.col("threshold")) | F.array_contains("fill", p), 1).otherwise(0) for p in _points(size, u)), F.lit(0))
    full = F.col("target") >= MOST * F.col("source_size")
    return F.when(size == 0, 1).when(full, int(MOST)).otherwise(under).cast("int")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken and copies."""
    sizes, by = plan(docs, weights, share)
    joined = sizes.join(_sent(by), sizes["source"].eqNullSafe(by["source"])).drop(by["source"])
    copies = _copies(F.col("size"), F.col("u"))
    return joined.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"))


def take(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mixed corpus: rows of ``docs`` as often as the mix takes them, all columns as they were.

    Only the sources' few numbers are joined to the documents, so their texts stay where they are.
    """
    _, by = plan(docs, weights, share)
    by = by.select(F.col("source").alias("__source"), "source_size", "target", "mean", "dual", "threshold", "fill")
    inner = docs.select(F.struct(*docs.columns).alias("__row"), F.col("source").alias("__own"), F.col("doc_id"), words_in(F.col("text")).alias("size"))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "size"), 11) / F.lit(float(1 << 53))
    joined = inner.withColumn("u", draw).join(_sent(by), F.col("__own").eqNullSafe(F.col("__source")))
    return joined.select("__row", F.explode(F.array_repeat(F.lit(1), _copies(F.col("size"), F.col("u"))))).select("__row.*")
