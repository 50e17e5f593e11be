"""Ordered prefix and order statistics: exact, at any scale.

Ranks, running sums, precision/recall curves and ``LEAD`` within a group need a full order.
A window with no (or a skewed) partition key sorts everything in one task.  Beyond
``ROWS_PER_BUCKET`` rows :func:`ordered_prefix` therefore lets Spark range-partition the rows
by group, order keys and a hash of the row (so that a value held by a third of all rows
spreads over tasks), writes them with their partition number to the shared checkpoint
folder, and adds the totals of the earlier partitions as offsets: at most groups +
partitions rows, joined back on the same keys.

Order statistics (exact percentiles, the cut of a top share) need no order at all.  The
rows are counted in ``CELLS`` equal-width cells between the least and the largest value, the
cells that hold a wanted rank are counted again between their own least and largest
values, and only the last ``CELL_ROWS`` rows around a rank are looked at one by one.  Rows are
scanned with partial aggregates and never shuffled or sorted; nothing is sampled.

Up to ``ROWS_PER_BUCKET`` rows (a caller-supplied ``row_bound`` or a count) the plain window,
or Spark's exact ``percentile`` aggregate, is used: their memory is bounded by that row
count.  Ties that must stay together (RANGE semantics, ranks, curves) are pre-aggregated to
one row per distinct key by the callers, which also shrinks them before the shuffle.
NaN order keys are expected to be NULL already (inputs convert NaN at ingest).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.columns import col_of
from staylens.session import materialize

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 65_536
# Cells of one counting pass, and rows around a rank that are looked at one by one.
CELLS = 4096
CELL_ROWS = 10_000
FEW_RANKS = 1_000


@dataclass(frozen=True)
class OrderKey:
    """One sort key; ``nulls_first`` defaults to Spark's (first when ascending)."""

    column: str
    ascending: bool = True
    nulls_first: bool | None = None

    @property
    def nulls_go_first(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first

    def sort_col(self) -> Column:
        c = F.col(self.column)
        if self.ascending:
            return c.asc_nulls_first() if self.nulls_go_first else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nulls_go_first else c.desc_nulls_last()


def _keys(order_by: Sequence[OrderKey | str]) -> list[OrderKey]:
    return [k if isinstance(k, OrderKey) else OrderKey(k) for k in order_by]


def plan_buckets(n: int, rows_per_bucket: int | None = None, max_buckets: int | None = None) -> int:
    per = rows_per_bucket or ROWS_PER_BUCKET
    cap = max_buckets or MAX_BUCKETS
    return max(1, min(cap, math.ceil(n / per))) if n > 0 else 1


def ordered_prefix(
    df: DataFrame,
    partition_by: Iterable[str] = (),
    order_by: Sequence[OrderKey | str] = (),
    sums: Mapping[str, str | Column] | None = None,
    *,
    rows_per_bucket: int | None = None,
    max_buckets: int | None = None,
    n_rows: int | None = None,
    row_bound: int | None = None,
) -> DataFrame:
    """Add ``_pos`` (1-based row position within the partition, in ``order_by`` order)
    and ``_cum_<name>`` (inclusive running sum) for each entry of ``sums``.

    Rows with equal order keys get distinct, arbitrary positions (ROWS semantics);
    make the order total, or pre-aggregate ties, when that matters.  ``row_bound`` (an
    upper bound on the rows, e.g. the count of the persisted input) replaces the count
    job that otherwise sizes the buckets.
    """
    part = list(partition_by)
    keys = _keys(order_by)
    if not keys:
        raise ValueError("order_by needs at least one key")
    measures = {name: col_of(c) for name, c in (sums or {}).items()}
    base = df.withColumns({f"_m_{name}": c for name, c in measures.items()}) if measures else df
    n = n_rows if n_rows is not None else row_bound if row_bound is not None else base.count()
    buckets = plan_buckets(n, rows_per_bucket, max_buckets)
    order_cols = [k.sort_col() for k in keys]
    running = (Window.unboundedPreceding, Window.currentRow)

    if buckets > 1:
        return _bucketed_prefix(ranged(base, part, keys, buckets), part, order_cols, measures)
    window = Window.partitionBy(*part).orderBy(*order_cols)
    out = base.withColumn("_pos", F.row_number().over(window).cast("long"))
    for name in measures:
        out = out.withColumn(f"_cum_{name}", F.sum(f"_m_{name}").over(window.rowsBetween(*running)))
    return out.drop(*[f"_m_{name}" for name in measures])


def ranged(df: DataFrame, part: Sequence[str], keys: Sequence[OrderKey], buckets: int) -> DataFrame:
    """``df`` range-partitioned by group, keys and row hash, with ``_gk`` (struct of the
    partition columns, when any) and ``_bucket``, the number of the row's range, written to
    the shared folder: whatever reads it sees one assignment, also after a lost executor."""
    gk = [F.struct(*[F.col(c) for c in part]).alias("_gk")] if part else []
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])
    order = [F.col(c).asc() for c in part] + [k.sort_col() for k in keys] + [tie]
    return materialize(df.repartitionByRange(buckets, *order).select("*", *gk, F.spark_partition_id().alias("_bucket")))


def _bucketed_prefix(bucketed, part, order_cols, measures) -> DataFrame:
    group = ["_gk"] if part else []
    local_w = Window.partitionBy(*group, "_bucket").orderBy(*order_cols)
    local = bucketed.withColumn("_lpos", F.row_number().over(local_w).cast("long"))
    for name in measures:
        local = local.withColumn(
            f"_lcum_{name}",
            F.sum(f"_m_{name}").over(local_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
    totals = bucketed.groupBy(*group, "_bucket").agg(
        F.count(F.lit(1)).alias("_bcnt"), *[F.sum(f"_m_{name}").alias(f"_bsum_{name}") for name in measures]
    )
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "_bucket",
        F.coalesce(F.sum("_bcnt").over(before), F.lit(0)).alias("_opos"),
        *[F.sum(f"_bsum_{name}").over(before).alias(f"_osum_{name}") for name in measures],
    )
    if part:
        # (group, bucket) keys match the window's hash partitioning, so only the small
        # offsets table moves; AQE broadcasts it when it is small at runtime.
        joined = local.join(offsets, on=["_gk", "_bucket"], how="left")
    else:
        joined = local.join(F.broadcast(offsets), on="_bucket", how="left")  # <= buckets rows
    out = joined.withColumn("_pos", F.col("_opos") + F.col("_lpos"))
    for name in measures:
        local_sum = F.col(f"_lcum_{name}")
        out = out.withColumn(f"_cum_{name}", F.when(F.col(f"_osum_{name}").isNull(), local_sum).otherwise(F.col(f"_osum_{name}") + local_sum))
    drop = ["_gk", "_bucket", "_lpos", "_opos"] if part else ["_bucket", "_lpos", "_opos"]
    for name in measures:
        drop += [f"_m_{name}", f"_lcum_{name}", f"_osum_{name}"]
    return out.drop(*drop)


def exact_percentiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    group_by: Iterable[str] = (),
    **prefix_kw,
) -> DataFrame:
    """Exact PERCENTILE_CONT (linear interpolation) per group, long form.

    Returns ``group_by..., _pidx (int), percentile (double), value (double)``.  NULL
    values are ignored; groups without values produce no rows.  Up to ``rows_per_bucket``
    rows (a known ``row_bound`` or a count) Spark's exact ``percentile`` aggregate is used;
    beyond that the ranks are found by counting (:func:`_values_at_ranks`).
    """
    g = list(group_by)
    v = col_of(value).cast("double")
    per = prefix_kw.get("rows_per_bucket") or ROWS_PER_BUCKET
    row_bound = prefix_kw.get("row_bound")
    if row_bound is None:
        row_bound = df.where(v.isNotNull()).count()
    if row_bound <= per:
        # Known small input: Spark's exact percentile keeps a value -> count map of at
        # most row_bound entries per group; one aggregation, same interpolation.
        agg = df.where(v.isNotNull()).groupBy(*g).agg(F.percentile(v, [float(p) for p in probs]).alias("_vals"))
        rows = F.arrays_zip(F.sequence(F.lit(0), F.lit(len(probs) - 1)).alias("i"), F.array(*[F.lit(float(p)) for p in probs]).alias("p"), F.col("_vals").alias("v"))
        return agg.where(F.col("_vals").isNotNull()).select(*g, F.inline(rows)).select(
            *g, F.col("i").cast("int").alias("_pidx"), F.col("p").alias("percentile"), F.col("v").alias("value")
        )
    gk = F.struct(*[F.col(c) for c in g]).alias("_gk") if g else F.lit(0).alias("_gk")
    raw = df.where(v.isNotNull()).select(gk, v.alias("_v"))
    stats = raw.groupBy("_gk").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = F.array(*[F.struct(F.lit(i).alias("_pidx"), F.lit(float(p)).alias("percentile")) for i, p in enumerate(probs)])
    wanted = materialize(stats.select("*", F.inline(wanted)).withColumn("_h", F.col("percentile") * (F.col("_n") - 1).cast("double")))
    ends = F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))
    ranks = wanted.select("_gk", "_lo", "_hi", F.col("_n").alias("_cnt"), F.lit(0).cast("long").alias("_before"), F.explode(ends).alias("_k")).distinct()
    at = _values_at_ranks(raw, ranks, min(CELL_ROWS, per))
    low = at.select(F.col("_gk").alias("_gl"), F.col("_k").alias("_kl"), F.col("_v").alias("_low"))
    high = at.select(F.col("_gk").alias("_gh"), F.col("_k").alias("_kh"), F.col("_v").alias("_high"))
    out = wanted.join(low, F.col("_gk").eqNullSafe(F.col("_gl")) & (F.floor("_h") == F.col("_kl")))
    out = out.join(high, F.col("_gk").eqNullSafe(F.col("_gh")) & (F.ceil("_h") == F.col("_kh")))
    frac = F.col("_h") - F.floor("_h")
    between = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * frac)
    return out.select(
        *[F.col(f"_gk.{c}").alias(c) for c in g], "_pidx", "percentile", between.alias("value")
    )


def cell_of(v: Column, lo: Column, hi: Column, by_ratio: bool = False) -> Column:
    """The cell of ``v`` between ``lo`` and ``hi``, which never falls as ``v`` grows: of equal
    width, or ``by_ratio`` of equal ratio of the distance from ``lo`` (e^0.36, over all
    magnitudes of a double).  Passes take turns, so that neither a few far values nor values
    crowded at one end keep a cell full.  Halves keep the width finite; where it is too small
    to divide by, all is one cell.  Infinite values count as the largest finite ones."""
    v, lo, hi = (F.greatest(F.least(x, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max)) for x in (v, lo, hi))
    if by_ratio:
        away = v / 2 - lo / 2
        cell = F.floor((F.log(away) + F.lit(746.0)) * F.lit((CELLS - 1) / 1456.0)) + F.lit(1)
        return F.when(away > 0, F.greatest(F.least(cell, F.lit(CELLS - 1)), F.lit(1))).otherwise(F.lit(0)).cast("int")
    scale = F.lit(CELLS / 2.0) / (hi / 2 - lo / 2)
    cell = F.floor((v / 2 - lo / 2) * scale * 2)
    usable = (hi > lo) & (scale < F.lit(1e300))
    return F.when(usable, F.greatest(F.least(cell, F.lit(CELLS - 1)), F.lit(0))).otherwise(F.lit(0)).cast("int")


def _values_at_ranks(raw: DataFrame, ranks: DataFrame, cell_rows: int) -> DataFrame:
    """(_gk, _k, _v): the value of rank ``_k`` (from 0) among the rows (_gk, _v) of its group.

    ``ranks`` has, per wanted rank, the interval [_lo, _hi] known to hold it, the rows before
    the interval and in it.  Each pass counts the rows of all open intervals by cells and
    shrinks every interval to the values in one cell; intervals of a group never overlap, so
    a row belongs to one at most.  The tables of ranks and intervals have at most two rows
    per group and percentile."""
    ranks = materialize(ranks)
    # Few ranks are sent to the rows; rows meet many by a join on the group.
    few = _ungrouped(raw) or ranks.count() <= FEW_RANKS

    def inside(intervals: DataFrame) -> DataFrame:
        """Rows with their interval: a join on the group, or with a few rows."""
        at = intervals.withColumnRenamed("_gk", "_ig")
        at = F.broadcast(at) if few else at
        return raw.join(at, F.col("_gk").eqNullSafe(F.col("_ig")) & F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop("_ig")

    sizes: list[int] = []
    while True:
        open_ = ranks.where((F.col("_cnt") > cell_rows) & (F.col("_lo") < F.col("_hi")))
        size = open_.agg(F.max("_cnt")).first()[0]  # one row
        if size is None or sizes[-2:] == [size, size]:  # nothing open, or only values too close for cells
            break
        sizes.append(size)
        cell = cell_of(F.col("_v"), F.col("_lo"), F.col("_hi"), by_ratio=len(sizes) % 2 == 0)
        rows = inside(open_.select("_gk", "_lo", "_hi", "_before").distinct())
        cells = rows.groupBy("_gk", F.col("_lo").alias("_l"), F.col("_hi").alias("_h"), "_before", cell.alias("_cell")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_clo"), F.max("_v").alias("_chi")
        )
        earlier = Window.partitionBy("_gk", "_l", "_h").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))  # CELLS rows an interval
        cells = cells.select(F.col("_gk").alias("_cg"), "_l", "_h", "_start", "_n", "_clo", "_chi")
        met = open_.join(cells, F.col("_gk").eqNullSafe(F.col("_cg")) & (F.col("_lo") == F.col("_l")) & (F.col("_hi") == F.col("_h")))
        met = met.where((F.col("_k") >= F.col("_start")) & (F.col("_k") < F.col("_start") + F.col("_n")))
        narrowed = met.select("_gk", F.col("_clo").alias("_lo"), F.col("_chi").alias("_hi"), F.col("_n").alias("_cnt"), F.col("_start").alias("_before"), "_k")
        ranks = materialize(ranks.where(~((F.col("_cnt") > cell_rows) & (F.col("_lo") < F.col("_hi")))).unionByName(narrowed))
    single = ranks.where(F.col("_lo") == F.col("_hi")).select("_gk", "_k", F.col("_lo").alias("_v"))
    last = ranks.where(F.col("_lo") < F.col("_hi"))
    values = inside(last.select("_gk", "_lo", "_hi", "_before").distinct()).groupBy("_gk", "_lo", "_hi", "_before", "_v").agg(F.count(F.lit(1)).alias("_w"))
    upto = Window.partitionBy("_gk", "_lo", "_hi").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("_end", F.col("_before") + F.sum("_w").over(upto)).select(  # about cell_rows rows an interval
        F.col("_gk").alias("_cg"), F.col("_lo").alias("_l"), F.col("_hi").alias("_h"), "_v", "_w", "_end"
    )
    met = last.join(values, F.col("_gk").eqNullSafe(F.col("_cg")) & (F.col("_lo") == F.col("_l")) & (F.col("_hi") == F.col("_h")))
    met = met.where((F.col("_k") < F.col("_end")) & (F.col("_k") >= F.col("_end") - F.col("_w")))
    return materialize(single.unionByName(met.select("_gk", "_k", "_v")))


def _ungrouped(raw: DataFrame) -> bool:
    return not isinstance(raw.schema["_gk"].dataType, T.StructType)


def percentile_columns(
    df: DataFrame,
    value: str | Column,
    named_probs: Mapping[str, float],
    group_by: Iterable[str] = (),
    **prefix_kw,
) -> DataFrame:
    """Wide form of :func:`exact_percentiles`: one row per group, one column per name.

    With no group columns this is a one-row aggregate (NULLs when there are no values).
    """
    g = list(group_by)
    names = list(named_probs)
    long = exact_percentiles(df, value, [named_probs[k] for k in names], g, **prefix_kw)
    return long.groupBy(*g).agg(
        *[F.max(F.when(F.col("_pidx") == i, F.col("value"))).alias(name) for i, name in enumerate(names)]
    )


def value_ranks(df: DataFrame, value: str | Column, **prefix_kw) -> DataFrame:
    """Global ``DENSE_RANK() OVER (ORDER BY v DESC)`` and ``PERCENT_RANK() OVER (ORDER BY v)``
    for every distinct non-NULL value: ``_v, dense_rank_desc, percent_rank, n_at_or_above``.
    """
    v = col_of(value)
    vc = df.where(v.isNotNull()).groupBy(v.alias("_v")).agg(F.count(F.lit(1)).alias("_w"))
    return _ranked(vc, vc.agg(F.sum("_w").alias("_n")), **prefix_kw)


def _ranked(vc: DataFrame, total: DataFrame, **prefix_kw) -> DataFrame:
    """Ranks of the distinct values ``vc`` (_v, _w), the largest ones of ``total`` rows."""
    pref = ordered_prefix(vc, [], [OrderKey("_v", ascending=False)], {"w": "_w"}, **prefix_kw)
    ranked = pref.crossJoin(F.broadcast(total))  # one-row global aggregate
    n_less = F.col("_n") - F.col("_cum_w")
    pct = F.when(F.col("_n") > 1, n_less.cast("double") / (F.col("_n") - 1).cast("double")).otherwise(F.lit(0.0))
    return ranked.select(
        "_v",
        F.col("_pos").cast("long").alias("dense_rank_desc"),
        pct.alias("percent_rank"),
        F.col("_cum_w").alias("n_at_or_above"),
    )


def top_value_ranks(
    df: DataFrame,
    value: str | Column,
    top_n: int,
    min_percent_rank: float,
    **prefix_kw,
) -> DataFrame:
    """:func:`value_ranks` restricted to a superset of the values with
    ``dense_rank_desc <= top_n`` or ``percent_rank >= min_percent_rank``.

    At scale the rows are counted by cells of their value.  Every cell that is not empty
    holds a distinct value, so the top ``top_n`` dense ranks lie in the top ``top_n`` of them;
    a value qualifies by percent rank only if the rows above it number at most
    ``(1 - min_percent_rank) * (n - 1)``.  The cell that both conditions end in is counted
    again until it is small; only values from there on are ranked."""
    v = col_of(value)
    per = prefix_kw.get("rows_per_bucket") or ROWS_PER_BUCKET
    row_bound = prefix_kw.get("row_bound")
    if row_bound is not None and row_bound <= per:
        return value_ranks(df, value, **prefix_kw)
    raw = df.where(v.isNotNull()).select(v.cast("double").alias("_v"))
    n, lo, hi = raw.agg(F.count(F.lit(1)), F.min("_v"), F.max("_v")).first()  # one row
    if not n:
        return value_ranks(df, value, **{**prefix_kw, "n_rows": 0})
    slack = (1.0 - float(min_percent_rank)) * (n - 1)
    # Rows and distinct cells above the interval that is being counted, and its own rows.
    above, found, size = 0, 0, n
    sizes: list[int] = []
    while size > min(CELL_ROWS, per) and lo < hi and sizes[-2:] != [size, size]:
        sizes.append(size)
        cell = cell_of(F.col("_v"), F.lit(lo), F.lit(hi), by_ratio=len(sizes) % 2 == 0)
        rows = raw.where(F.col("_v").between(lo, hi)).groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        for c in sorted(rows.collect(), key=lambda r: -r.c):  # at most CELLS rows
            lo, hi, size = c.lo, c.hi, c.n
            if found + 1 >= top_n and above + c.n > slack:
                break
            above, found = above + c.n, found + 1
    kept = raw.where(F.col("_v") >= lo).groupBy("_v").agg(F.count(F.lit(1)).alias("_w"))
    total = df.sparkSession.range(1).select(F.lit(n).alias("_n"))
    return _ranked(kept, total, **{**prefix_kw, "n_rows": above + size})


def lead_within(
    df: DataFrame,
    partition_by: Iterable[str],
    order_by: Sequence[OrderKey | str],
    value: str,
    offset: int,
    out_col: str,
    **prefix_kw,
) -> DataFrame:
    """``LEAD(value, offset) OVER (PARTITION BY ... ORDER BY ...)`` without putting a
    hot partition in one task.

    Groups of at most ``ROWS_PER_BUCKET`` rows take the plain window.  The rows of the larger
    ones (fewer groups than buckets) are range-partitioned as in :func:`ordered_prefix` and
    the window runs per (group, bucket).  Only the last ``offset`` rows of a bucket whose group continues in a later
    bucket need a value from elsewhere: the first ``offset`` rows of each later bucket of
    the group.  At most ``buckets - 1`` (group, bucket) pairs are continued, so both
    boundary tables hold at most ``offset * (buckets - 1)`` rows; they are cut with
    ``row_number() <= offset`` (limited before their shuffle) and the fix-up is broadcast
    onto the main window by (group, bucket, local position)."""
    part = list(partition_by)
    keys = _keys(order_by)
    n = prefix_kw.get("row_bound")
    n = df.count() if n is None else n
    buckets = plan_buckets(n, prefix_kw.get("rows_per_bucket"), prefix_kw.get("max_buckets"))
    order_cols = [k.sort_col() for k in keys]
    plain = F.lead(F.col(value), offset).over(Window.partitionBy(*part).orderBy(*order_cols))
    if buckets == 1:
        return df.withColumn(out_col, plain)
    if part:
        most = prefix_kw.get("rows_per_bucket") or ROWS_PER_BUCKET
        sizes = df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(part)]).agg(F.count(F.lit(1)).alias("_n"))
        large = sizes.where(F.col("_n") > most).collect()  # fewer groups than buckets
        if not large:
            return df.withColumn(out_col, plain)
        hot = F.broadcast(df.sparkSession.createDataFrame(large, sizes.schema).drop("_n"))
        same = F.lit(True)
        for i, c in enumerate(part):
            same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
        rest = df.join(hot, same, "left_anti").withColumn(out_col, plain)
        df = df.join(hot, same, "left_semi")
        large_rows = sum(r["_n"] for r in large)
        return rest.union(_lead_ranged(df, part, keys, value, offset, out_col, plan_buckets(large_rows, most, prefix_kw.get("max_buckets"))))
    return _lead_ranged(df, part, keys, value, offset, out_col, buckets)


def _lead_ranged(df: DataFrame, part: list[str], keys: list[OrderKey], value: str, offset: int, out_col: str, buckets: int) -> DataFrame:
    order_cols = [k.sort_col() for k in keys]
    keyed = ranged(df, part, keys, buckets)
    grp = ["_gk"] if part else []
    on = [*grp, "_bucket"]
    local_w = Window.partitionBy(*grp, "_bucket").orderBy(*order_cols)
    local = keyed.withColumns({"_lpos": F.row_number().over(local_w).cast("long"), out_col: F.lead(F.col(value), offset).over(local_w)})
    counts = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("_bc"))  # <= groups + buckets rows
    by_group = Window.partitionBy(*grp).orderBy("_bucket")
    counts = counts.withColumns(
        {
            "_off": F.coalesce(F.sum("_bc").over(by_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_more": F.lead("_bucket").over(by_group).isNotNull(),
        }
    )
    # A group crosses each bucket boundary at most once: <= buckets - 1 pairs in each table.
    continued = F.broadcast(counts.where(F.col("_more")).select(*on, "_off", "_bc"))
    preceded = F.broadcast(counts.where(F.col("_off") > 0).select(*on, "_off"))
    # First / last `offset` rows of those buckets; row_number() <= k is limited before the shuffle.
    desc_cols = [k.sort_col() for k in _reversed(keys)]
    tails = keyed.join(continued, on=on, how="inner").withColumn(
        "_rd", F.row_number().over(Window.partitionBy(*on).orderBy(*desc_cols))
    ).where(F.col("_rd") <= F.lit(offset))
    tails = tails.select(*on, (F.col("_bc") - F.col("_rd") + 1).alias("_lpos"), (F.col("_off") + F.col("_bc") - F.col("_rd") + 1 + F.lit(offset)).alias("_tpos"))
    heads = keyed.join(preceded, on=on, how="inner").withColumn(
        "_ra", F.row_number().over(Window.partitionBy(*on).orderBy(*order_cols))
    ).where(F.col("_ra") <= F.lit(offset))
    heads = heads.select(*grp, (F.col("_off") + F.col("_ra")).alias("_tpos"), F.col(value).alias("_hv"))
    fix = tails.join(heads, on=[*grp, "_tpos"], how="inner").select(*on, "_lpos", "_hv")  # <= offset * (buckets - 1) rows
    out = local.join(F.broadcast(fix), on=[*on, "_lpos"], how="left")
    out = out.withColumn(out_col, F.coalesce(F.col(out_col), F.col("_hv")))
    return out.drop(*grp, "_bucket", "_lpos", "_hv")


def _reversed(keys: Sequence[OrderKey]) -> list[OrderKey]:
    """The same total order, descending (NULL placement flipped accordingly)."""
    return [OrderKey(k.column, not k.ascending, not k.nulls_go_first) for k in keys]
