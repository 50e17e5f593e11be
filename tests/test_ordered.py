"""Bucketed ordering equals plain windows: hot group, heavy ties, many bucket counts."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from staylens.operators import ordered as O
from staylens.operators.ordered import OrderKey, exact_percentiles, lead_within, ordered_prefix, percentile_columns, value_ranks


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 3000
    # group 0 holds a third of all rows; values have heavy ties
    g = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 40, n))
    v = np.round(rng.gamma(2.0, 3.0, n), 1)
    v[rng.random(n) < 0.1] = 5.0
    w = rng.integers(0, 2, n)
    rows = [(int(i), int(gi), float(vi), int(wi)) for i, (gi, vi, wi) in enumerate(zip(g, v, w))]
    return spark.createDataFrame(rows, "id long, g long, v double, w int")


@pytest.mark.parametrize("per", [40, 250, 100000])
def test_prefix_matches_window(data, per):
    out = ordered_prefix(data, ["g"], [OrderKey("v", ascending=False), OrderKey("id")], {"w": "w"}, rows_per_bucket=per)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))
    ref = data.select(
        "id",
        F.row_number().over(w).alias("rn"),
        F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cw"),
    )
    got = {r["id"]: (r["_pos"], r["_cum_w"]) for r in out.select("id", "_pos", "_cum_w").collect()}
    exp = {r["id"]: (r["rn"], r["cw"]) for r in ref.collect()}
    assert got == exp


@pytest.mark.parametrize("per", [30, 100000])
def test_global_prefix(data, per):
    out = ordered_prefix(data, [], [OrderKey("v"), OrderKey("id")], rows_per_bucket=per)
    got = {r["id"]: r["_pos"] for r in out.select("id", "_pos").collect()}
    order = sorted(((r["v"], r["id"]) for r in data.collect()))
    assert got == {i: k + 1 for k, (_, i) in enumerate(order)}


@pytest.mark.parametrize("per,bound", [(25, None), (100000, None), (100000, 3000)])
def test_percentiles_match_numpy(data, per, bound):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    kw = {"rows_per_bucket": per}
    if bound:
        kw["row_bound"] = bound
    res = exact_percentiles(data, "v", probs, ["g"], **kw).collect()
    pdf = data.toPandas()
    for r in res:
        vals = pdf.loc[pdf.g == r["g"], "v"].to_numpy()
        assert r["value"] == pytest.approx(float(np.percentile(vals, r["percentile"] * 100)), abs=1e-9)
    assert len(res) == pdf.g.nunique() * len(probs)


def test_percentile_columns_empty(spark):
    empty = spark.createDataFrame([], "v double")
    row = percentile_columns(empty, "v", {"p50": 0.5}, rows_per_bucket=10).collect()
    assert len(row) == 1 and row[0]["p50"] is None


@pytest.mark.parametrize("per", [20, 100000])
def test_value_ranks_match_windows(data, per):
    ranks = {r["_v"]: (r["dense_rank_desc"], r["percent_rank"]) for r in value_ranks(data, "v", rows_per_bucket=per).collect()}
    ref = data.select(
        "v",
        F.dense_rank().over(Window.orderBy(F.col("v").desc())).alias("dr"),
        F.percent_rank().over(Window.orderBy("v")).alias("pr"),
    ).distinct()
    for r in ref.collect():
        dr, pr = ranks[r["v"]]
        assert dr == r["dr"]
        assert pr == pytest.approx(r["pr"], abs=1e-12)


@pytest.mark.parametrize("per", [35, 100000])
def test_lead_matches_window(data, per):
    got = lead_within(data, ["g"], [OrderKey("v"), OrderKey("id")], "id", 3, "nid", rows_per_bucket=per)
    w = Window.partitionBy("g").orderBy("v", "id")
    exp = data.select("id", F.lead("id", 3).over(w).alias("nid"))
    assert {r["id"]: r["nid"] for r in got.select("id", "nid").collect()} == {r["id"]: r["nid"] for r in exp.collect()}


def test_lead_ranges_the_rows_of_large_groups_only(data, monkeypatch):
    """All rows were range-partitioned and written as soon as they were many."""
    seen = []
    plain = O.ranged
    monkeypatch.setattr(O, "ranged", lambda df, *a: (seen.append({r["g"] for r in df.select("g").distinct().collect()}), plain(df, *a))[1])
    exp = {r["id"]: r["nid"] for r in data.select("id", F.lead("id", 3).over(Window.partitionBy("g").orderBy("v", "id")).alias("nid")).collect()}
    for per, large in ((200, [{0}]), (1500, [])):  # group 0 has 1,000 rows, the others below 100
        seen.clear()
        got = lead_within(data, ["g"], [OrderKey("v"), OrderKey("id")], "id", 3, "nid", rows_per_bucket=per)
        assert {r["id"]: r["nid"] for r in got.select("id", "nid").collect()} == exp and seen == large


def test_row_order_does_not_matter(data):
    a = exact_percentiles(data, "v", [0.5, 0.9], ["g"], rows_per_bucket=50).collect()
    b = exact_percentiles(data.repartition(7).orderBy(F.rand(3)), "v", [0.5, 0.9], ["g"], rows_per_bucket=50).collect()
    key = lambda r: (r["g"], r["_pidx"])
    assert sorted(a, key=key) == sorted(b, key=key)


def test_percentiles_extreme_ties(spark):
    rows = [(0, 5.0)] * 900 + [(1, float(i % 7)) for i in range(300)] + [(2, 1.0)]
    df = spark.createDataFrame(rows, "g long, v double")
    got = {(r["g"], r["percentile"]): r["value"] for r in exact_percentiles(df, "v", [0.0, 0.5, 0.9, 1.0], ["g"], rows_per_bucket=50).collect()}
    pdf = df.toPandas()
    for (g, p), val in got.items():
        assert val == pytest.approx(float(np.percentile(pdf.loc[pdf.g == g, "v"], p * 100)))
    assert len(got) == 12


@pytest.mark.parametrize("per", [20, 100000])
def test_top_value_ranks(data, per):
    from staylens.operators.ordered import top_value_ranks

    full = {r["_v"]: (r["dense_rank_desc"], r["percent_rank"]) for r in value_ranks(data, "v").collect()}
    top = {r["_v"]: (r["dense_rank_desc"], r["percent_rank"]) for r in top_value_ranks(data, "v", 10, 0.95, rows_per_bucket=per).collect()}
    qualifying = {v for v, (d, p) in full.items() if d <= 10 or p >= 0.95}
    assert qualifying <= set(top)
    for v in top:
        assert top[v][0] == full[v][0] and top[v][1] == pytest.approx(full[v][1])


def test_outlier_review_bucketed_equals_plain(spark):
    import numpy as np

    from staylens.operators.outliers import long_stay_outlier_review

    rng = np.random.default_rng(9)
    los = np.round(rng.gamma(2.0, 3.0, 2000), 2)
    rows = [(i, float(x)) for i, x in enumerate(los)]
    df = spark.createDataFrame(rows, "hadm_id long, los_days double")
    a = sorted(map(tuple, long_stay_outlier_review(df, top_n=15, min_percent_rank=0.98, rows_per_bucket=40).collect()))
    b = sorted(map(tuple, long_stay_outlier_review(df, top_n=15, min_percent_rank=0.98).collect()))
    c = sorted(map(tuple, long_stay_outlier_review(df, top_n=15, min_percent_rank=0.98, row_bound=2000).collect()))
    assert len(a) == len(b) == len(c) and len(a) >= 40
    for x, y in list(zip(a, b)) + list(zip(c, b)):
        assert x[0] == y[0] and x[3:6] == y[3:6]
        assert x[1:3] + x[6:] == pytest.approx(y[1:3] + y[6:], rel=1e-12)


@pytest.mark.parametrize("per", [33, 100000])
def test_global_lead_matches_window(data, per):
    got = lead_within(data, [], [OrderKey("v", ascending=False), OrderKey("id")], "v", 5, "nv", rows_per_bucket=per)
    exp = data.select("id", F.lead("v", 5).over(Window.orderBy(F.col("v").desc(), "id")).alias("nv"))
    assert {r["id"]: r["nv"] for r in got.select("id", "nv").collect()} == {r["id"]: r["nv"] for r in exp.collect()}


def test_lead_with_null_group(spark):
    rows = [(i, None if i % 4 == 0 else i % 3, float(i % 17)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g long, v double")
    got = lead_within(df, ["g"], [OrderKey("v"), OrderKey("id")], "id", 2, "nid", rows_per_bucket=30)
    exp = df.select("id", F.lead("id", 2).over(Window.partitionBy("g").orderBy("v", "id")).alias("nid"))
    assert {r["id"]: r["nid"] for r in got.select("id", "nid").collect()} == {r["id"]: r["nid"] for r in exp.collect()}


@pytest.mark.parametrize("top_n,r", [(10_000, 0.5), (1, 1.0)])
def test_top_value_ranks_extremes(data, top_n, r):
    from staylens.operators.ordered import top_value_ranks

    full = {x["_v"]: (x["dense_rank_desc"], x["percent_rank"]) for x in value_ranks(data, "v").collect()}
    top = {x["_v"]: x["dense_rank_desc"] for x in top_value_ranks(data, "v", top_n, r, rows_per_bucket=20).collect()}
    assert {v for v, (d, p) in full.items() if d <= top_n or p >= r} <= set(top)
    assert all(full[v][0] == d for v, d in top.items())


def test_hot_value_spreads_over_ranges(spark):
    from staylens.operators.ordered import ranged

    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(1) * 10).alias("v"))
    sizes = [r["count"] for r in ranged(rows, [], [OrderKey("v")], 20).groupBy("_bucket").count().collect()]
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 8  # a third of all rows has one value
    tied = ordered_prefix(rows, [], [OrderKey("v"), OrderKey("id")], rows_per_bucket=450).orderBy("_pos").collect()
    assert [r["_pos"] for r in tied] == list(range(1, 9001))
    assert [(r["v"], r["id"]) for r in tied] == sorted((r["v"], r["id"]) for r in tied)


def test_ranks_by_counting_at_the_ends_of_double(spark):
    values = [0.0, 5e-324, 1e-310, -1e-310, 1.7e308, -1.7e308, float("inf"), float("-inf"), 1.0, 1.0, 1.0 + 2**-52, 3.5] * 9
    values += [2.0**k for k in range(-1000, 1000, 100)]
    df = spark.createDataFrame([(i % 2, x) for i, x in enumerate(values)], "g long, v double")
    probs = [0.0, 0.25, 0.6, 0.9, 1.0]
    got = {(r["g"], r["percentile"]): r["value"] for r in exact_percentiles(df, "v", probs, ["g"], rows_per_bucket=12).collect()}
    for g in (0, 1):
        own = sorted(x for i, x in enumerate(values) if i % 2 == g)
        for p in probs:
            h = p * (len(own) - 1)
            lo, hi = own[int(np.floor(h))], own[int(np.ceil(h))]
            if lo == hi or np.isfinite(hi - lo):
                assert got[g, p] == pytest.approx(lo + (0.0 if lo == hi else (hi - lo) * (h - np.floor(h))), nan_ok=True)
    assert len(got) == 10


def test_ungrouped_percentiles_by_counting(spark, data):
    pdf = data.toPandas()
    got = exact_percentiles(data, "v", [0.0, 0.333, 0.9], rows_per_bucket=10).collect()
    assert [r["value"] for r in sorted(got, key=lambda r: r["_pidx"])] == pytest.approx([float(np.percentile(pdf.v, 100 * p)) for p in (0.0, 0.333, 0.9)])
