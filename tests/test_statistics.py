"""Bins, histograms, quantiles and scaling statistics."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.operators import binning, histograms as h, quantiles, scaling
from evenkeel.operators.quantiles import exact_quantiles, quantile_arrays

NAN, INF = float("nan"), float("inf")


def column(spark, values, name="x"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def test_edges():
    assert binning.linspace_edges([-4, 8, 7]) == [-4.0, -2.0, 0.0, 2.0, 4.0, 6.0, 8.0]
    assert binning.linspace_edges([[0, 10, 3], [10, 40, 4]]) == [0.0, 5.0, 10.0, 10.0, 20.0, 30.0, 40.0]
    assert binning.step_edges([2, 10, 2], "number_of_lines") == [1.5, 3.5, 5.5, 7.5]
    assert binning.step_edges([2, 10, 2], "weight") == [2.0, 4.0, 6.0, 8.0]
    assert len(binning.step_edges(None, "weight", 3.0, 9.0)) == 101 and binning.step_edges(3, "weight", 3.0, 9.0) == [3.0, 5.0, 7.0, 9.0]


@pytest.mark.parametrize("edges", [list(np.linspace(0, 1, 11)), list(np.arange(0, 0.1, 0.01)), [0.0, 0.1, 0.5, 0.5, 1.0], [0.0, 2.0]])
def test_bin_numbers_follow_the_edges(spark, edges):
    values = sorted({*edges, *np.nextafter(edges, -9), *np.nextafter(edges, 9), *np.linspace(-0.1, 1.1, 77), NAN}, key=str)
    got = column(spark, values).select("x", binning.bin_number(F.col("x"), edges).alias("b")).collect()
    for r in got:
        x = r["x"]
        inside = not math.isnan(x) and edges[0] <= x <= edges[-1]
        expected = min(int(np.searchsorted(edges, x, side="right")) - 1, len(edges) - 2) if inside else None
        if inside and x == edges[-1]:
            expected = len(edges) - 2
        assert r["b"] == expected, x


def test_histogram_matches_numpy(spark):
    values = [0.5, -3.0, 7.0, 7.5, 11.0, 12.0, 7.0, 0.0, 30.0, 3.0]
    edges = [-2.0, 0.0, 3.0, 7.0, 7.25, 12.0]
    counts, n = np.histogram(values, edges)[0], len(values)
    got = {r["bin"]: r for r in h.histogram(column(spark, values), F.col("x"), edges).collect()}
    assert [got[i]["hist"] for i in range(5)] == pytest.approx(list(counts / n))
    assert [got[i]["unc"] for i in range(5)] == pytest.approx(list(np.sqrt(counts) / n))
    assert [got[i]["band"] for i in range(5)] == pytest.approx(list((counts - np.sqrt(counts)) / n))


def test_histogram_ratio_propagates_both_uncertainties(spark):
    a, b = np.array([8.0, 1.5, 40.0, 9.0]), np.array([2.0, 4.5, 16.0, 90.0])
    da, db = np.array([2.4, 0.3, 10.0, 0.0]), np.array([0.8, 0.9, 2.0, 27.0])

    def hist(values, unc):
        return spark.createDataFrame([(i, float(v), float(u)) for i, (v, u) in enumerate(zip(values, unc))], "bin int, hist double, unc double")

    got = {r["bin"]: r for r in h.histogram_ratio(hist(a, da), hist(b, db), ["bin"]).collect()}
    expected, spread = a / b, a / b * np.hypot(da / a, db / b)
    assert [got[i]["ratio"] for i in range(-1, 4)] == pytest.approx([expected[0], *expected])
    assert [got[i]["ratio_unc"] for i in range(-1, 4)] == pytest.approx([spread[0], *spread])


@pytest.mark.parametrize("accuracy", [50, 20_000])
def test_quantiles_match_linear_interpolation(spark, accuracy):
    """Small accuracy forces the bracket path; one group holds almost everything, one has heavy ties."""
    rng = np.random.default_rng(1)
    groups = {"hot": rng.normal(size=20_000), "ties": rng.integers(0, 5, 3000).astype(float), "one": np.array([3.0]), "two": np.array([1.0, 2.0])}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(data, "g string, x double").repartition(13)
    probs = [0.0, 0.23, 0.5, 0.999, 1.0, 0.2300001]
    got = {}
    for r in exact_quantiles(df, "x", probs, ["g"], 4, accuracy).collect():
        got[r["g"], r["prob_no"]] = r["quantile"]
    for g, vs in groups.items():
        expected = np.percentile(vs, [100 * p for p in probs])
        assert [got[g, i] for i in range(len(probs))] == pytest.approx(list(expected), abs=1e-12), g


def test_brackets_are_narrowed(spark):
    """Continuous values, heavy ties and an outlying value: no bracket keeps more values than stated, ranks stay exact."""
    rng = np.random.default_rng(1)
    groups = {"hot": rng.normal(size=30_000), "ties": np.where(rng.random(9000) < 0.4, 0.25, rng.normal(size=9000)), "end": np.where(rng.random(5000) < 0.5, -1e9, rng.random(5000))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, x double").repartition(7)
    probs = [0.0, 0.01, 0.31, 0.3101, 0.5, 0.77, 0.999, 1.0]
    for names in ([], ["g"]):
        got = {(r["g"] if names else "", r["prob_no"]): r["quantile"] for r in exact_quantiles(df, "x", probs, names, 3, 100, bracket_values=20).collect()}
        for g, vs in (groups if names else {"": np.concatenate(list(groups.values()))}).items():
            assert [got[g, i] for i in range(len(probs))] == list(np.quantile(vs, probs)), g
    rows = df.select("g", F.col("x").alias("__x"))
    wide = rows.groupBy("g").agg(F.count(F.lit(1)).alias("__n")).select(
        "g", "__n", F.array(F.lit(-INF), F.lit(-INF)).alias("__lo"), F.array(F.lit(INF), F.lit(INF)).alias("__hi"))
    frame = quantiles.narrowed(rows, wide, ["g"], [0.3, 0.9], 3, 100, 20)
    for j in (0, 1):
        between = rows.join(frame, "g").filter((F.col("__x") > F.get("__lo", F.lit(j))) & (F.col("__x") < F.get("__hi", F.lit(j))))
        assert all(r["count"] <= 20 for r in between.groupBy("g").count().collect())


def test_quantile_arrays_keep_the_order(spark):
    df = spark.range(101).withColumn("x", F.col("id").cast("double"))
    assert quantile_arrays(df, "x", [0.9, 0.1]).first()["quantiles"] == pytest.approx([90.0, 10.0])


def as_dict(df):
    return {r["variable"]: r for r in df.collect()}


def test_row_statistics_match_numpy(spark):
    values = np.random.default_rng(4).gamma(2.0, 30.0, 333)
    df = column(spark, values, "a").withColumn("a_isDefaults", F.lit(0.0))
    got = as_dict(scaling.row_statistics(df, ["a", "a_isDefaults", "weight"]))
    assert (got["a"]["shift"], got["a"]["scale"]) == (pytest.approx(values.mean()), pytest.approx(values.std()))
    assert got["a"]["default"] == pytest.approx(values.mean()) and set(got) == {"a", "a_isDefaults"}


@pytest.mark.parametrize("defaults", [None, {"a": 1.0}])
def test_row_statistics_fill_missing_values(spark, defaults):
    values = [1.0, 5.0, 9.0, NAN, INF, -INF]
    filled = np.array([1.0, 5.0, 9.0] + [1.0 if defaults else 5.0] * 3)
    got = as_dict(scaling.row_statistics(column(spark, values, "a"), ["a"], defaults))["a"]
    assert (got["shift"], got["scale"], got["n"]) == (pytest.approx(filled.mean()), pytest.approx(filled.std()), 6)


def test_column_without_finite_values_is_all_default(spark):
    df = column(spark, [NAN, INF, NAN], "a")
    given = as_dict(scaling.row_statistics(df, ["a"], {"a": 2.0}))["a"]
    assert (given["shift"], given["scale"], given["n"]) == (2.0, 0.0, 3)
    assert as_dict(scaling.row_statistics(df, ["a"]))["a"]["shift"] is None


def test_merged_statistics_are_those_of_all_values(spark):
    draw = np.random.default_rng(7)
    values = {"depth": [draw.normal(m, 3.0, n) for m, n in ((100.0, 40), (2.0, 7), (-5.0, 1))], "width": [draw.normal(0, s, 25) for s in (0.1, 50.0)]}
    parts = [(name, float(x.mean()), float(x.std()), len(x)) for name, each in values.items() for x in each]
    got = as_dict(scaling.merge_statistics(spark.createDataFrame(parts, "variable string, shift double, scale double, n long")))
    for name, each in values.items():
        every = np.concatenate(each)
        assert (got[name]["shift"], got[name]["scale"], got[name]["n"]) == (pytest.approx(every.mean()), pytest.approx(every.std()), len(every))


def test_row_scaling(spark):
    df = spark.createDataFrame([(7.0, -30.0, 1.0)], "depth double, width double, width_isDefaults double")
    stats = {"depth": {"shift": 3.0, "scale": 16.0, "default": 3.0}, "width": {"shift": -10.0, "scale": 0.5, "default": -10.0}}
    scaled = [(7.0 - 3.0) / 16.0, (-30.0 + 10.0) / 0.5, 1.0]  # flags of defaults stay as they are
    assert list(scaling.apply_row_scaling(df, ["depth", "width", "width_isDefaults"], stats).first()) == scaled
    with pytest.raises(KeyError):
        scaling.apply_row_scaling(df, ["depth", "height"], stats)
    with pytest.raises(ValueError):
        scaling.apply_row_scaling(df, ["depth"], {"depth": {**stats["depth"], "scale": 0.0}})


ITEM = "items array<struct<frac:float,hits:int,d0:float,valid:boolean>>"


def test_item_scaling(spark):
    items = [(0.5, 11, -2.0, True), (8.0, 3, 0.25, True), (NAN, 0, NAN, False), (32.0, 7, 6.0, True)]
    stats = {"frac": {"shift": 1.5, "scale": 0.25}, "hits": {"shift": 7, "scale": 4}}
    got = spark.createDataFrame([(items,)], ITEM).select(scaling.scaled_items(F.col("items"), ["d0"], ["frac"], ["hits"], stats)).first()[0]
    for row, (frac, hits, d0, valid) in zip(got, items, strict=True):
        assert list(row) == (pytest.approx([d0, (math.log(frac) - 1.5) / 0.25, (hits - 7) / 4]) if valid else [0.0, 0.0, 0.0])
    bad = spark.createDataFrame([([(0.0, 5, 1.0, True)],)], ITEM)
    with pytest.raises(Exception, match="must be positive"):
        bad.select(scaling.scaled_items(F.col("items"), ["d0"], ["frac"], ["hits"], stats)).collect()


def test_item_statistics_count_valid_items_only(spark):
    draw = np.random.default_rng(3)
    rows = [[(float(np.float32(draw.exponential(5.0))), int(draw.integers(0, 30)), 0.0, bool(draw.random() < 0.7)) for _ in range(k)] for k in (0, 1, 17, 60)]
    got = as_dict(scaling.item_statistics(spark.createDataFrame([(r,) for r in rows], ITEM), "items", ["frac", "hits"]))
    for place, name in enumerate(("frac", "hits")):
        valid = np.array([x[place] for r in rows for x in r if x[3]], np.float64)
        assert (got[name]["shift"], got[name]["scale"], got[name]["n"]) == (pytest.approx(valid.mean()), pytest.approx(valid.std()), len(valid))


def test_unusable_statistics_are_errors(spark):
    stats = spark.createDataFrame([("a", 0.0, 0.0)], "variable string, shift double, scale double")
    with pytest.raises(Exception, match="unusable scaling statistics"):
        scaling.check_statistics(stats).collect()


def test_outliers_use_every_column(spark):
    data = [(float(i % 10), float(i % 7)) for i in range(200)] + [(1e3, 1.0), (1.0, -1e3), (NAN, 1.0)]
    kept = h.drop_outliers(spark.createDataFrame(data, "a double, b double"), ["a", "b"], 3.0)
    assert kept.count() == 200


def test_leading_item_puts_missing_last(spark):
    df = spark.createDataFrame([([(NAN, 1, 0.0, True), (2.0, 2, 0.0, True), (5.0, 3, 0.0, True)],)], ITEM)
    order = [df.select(h.nth_item(F.col("items"), "frac", n)).first()[0][0]["hits"] for n in range(3)]
    assert order == [3, 2, 1]
