"""Invariants of the resampling methods, also under skew and repartitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.functions.keys import row_key, shuffled
from evenkeel.operators import density, events, fractions as fr, ranking, resampling as rs
from evenkeel.operators.binning import flat_bin, n_bins
from evenkeel.plans.resample import pdf_resample, run_resampling

CLASSES = ["heavy", "medium", "light"]
AXES = {"x": [float(v) for v in np.linspace(0, 5e5, 20)], "y": [0.0, 0.3125, 0.625, 0.9375, 1.25]}
SHARES = {"a": 0.7, "b": 0.3}


@pytest.fixture(scope="module")
def rows(spark):
    """Six samples; one origin and class holds most rows, and most of those sit in one bin."""
    n = 24_000
    df = spark.range(n, numPartitions=5).select(
        row_key(F.col("id")).alias("row_key"), F.rand(1).alias("u"), F.rand(2).alias("v"), F.rand(3).alias("w"), F.randn(4).alias("g"), F.randn(5).alias("k"))
    df = df.select(
        "row_key", F.when(F.col("u") < 0.5, "light").when(F.col("u") < 0.8, "medium").otherwise("heavy").alias("class"),
        F.when(F.col("v") < 0.75, "a").otherwise("b").alias("origin"),
        F.when((F.col("w") < 0.5) & (F.col("u") < 0.5), 2.2e5).otherwise(F.abs(2.5e5 + 6e4 * F.col("g"))).alias("x"),
        F.abs(1.0 + 0.5 * F.col("k")).alias("y"))
    path = __import__("evenkeel.session", fromlist=["x"]).shared_dir(spark) + "/resampling-rows"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def count_options(total, **extra):
    return rs.ResamplingOptions("count", CLASSES, AXES, total, SHARES, **extra)


@pytest.mark.parametrize("counts, shares, expected", [
    ([1000, 6000, 3000], [0.2, 0.6, 0.2], [1000, 3000, 1000]), ([2000, 6000, 2000], [0.2, 0.6, 0.2], [2000, 6000, 2000]),
    ([3000, 6000, 3000], [0.3, 0.5, 0.2], [3000, 5000, 2000]), ([10000, 6000, 7000], [0.4, 0.5, 0.1], [4800, 6000, 1200]),
])
def test_corrected_fractions_known_values(spark, counts, shares, expected):
    df = spark.createDataFrame(list(zip(range(3), counts, shares)), "i int, n long, fraction double")
    assert [r["target"] for r in fr.correct_fractions(df).orderBy("i").collect()] == expected


def test_fraction_errors(spark):
    with pytest.raises(ValueError):
        fr.check_fractions({"a": 0.5, "b": 0.6})
    df = spark.createDataFrame([(0, 0.5), (5, 0.5)], "n long, fraction double")
    with pytest.raises(Exception, match="above zero"):
        fr.correct_fractions(df).collect()


def test_options_are_checked():
    with pytest.raises(ValueError):
        rs.ResamplingOptions("count", CLASSES, AXES, -1, SHARES)
    with pytest.raises(ValueError):
        rs.ResamplingOptions("pdf", CLASSES, AXES, -1)
    with pytest.raises(ValueError):
        rs.ResamplingOptions("importance", CLASSES, AXES, 100, target_class="other")


def test_count_undersampling(rows):
    out = run_resampling(rows, count_options(900)).cache()
    assert {r["class"]: r["count"] for r in out.groupBy("class").count().collect()} == dict.fromkeys(CLASSES, 300)
    assert out.join(rows, ["row_key", "class", "origin"], "left_semi").count() == 900
    assert out.select("row_key").distinct().count() == 900


def test_bins_are_balanced_before_the_total(rows):
    binned = rs.with_hash(rs.with_bins(rows, AXES), count_options(900))
    step = rs.bin_selection(binned, count_options(900), lambda c: c.groupBy("bin").agg(F.min("n").alias("limit")))
    got = step.apply(binned).groupBy("bin").pivot("class", CLASSES).count().collect()
    assert got and all(len({r[c] for c in CLASSES}) == 1 for r in got)


def keys(df):
    return sorted(r["row_key"] for r in df.select("row_key").collect())


def test_selection_does_not_depend_on_partitions(rows):
    picked = [keys(run_resampling(rows.repartition(n), count_options(600))) for n in (1, 17)]
    assert picked[0] == picked[1] and len(picked[0]) == 600


@pytest.mark.parametrize("target, total", [("light", 600), ("medium", -1)])
def test_importance_undersampling(rows, target, total):
    options = rs.ResamplingOptions("importance", CLASSES, AXES, total, target_class=target)
    out = run_resampling(rows, options).groupBy("class").count().collect()
    assert len({r["count"] for r in out}) == 1 and len(out) == 3
    if total > 0:
        assert out[0]["count"] == total // 3


def test_weights_give_the_target_shape(rows):
    options = rs.ResamplingOptions("weighting", CLASSES, AXES, target_class="medium")
    out = run_resampling(rows, options)
    assert out.count() == rows.count()
    sums = out.filter("bin IS NOT NULL").groupBy("bin").pivot("class", CLASSES).agg(F.sum("weight")).collect()
    for r in sums:
        if r["medium"] and r["light"]:
            assert r["light"] == pytest.approx(r["medium"])


@pytest.mark.parametrize("sigmas", [8.0, 0.0])
def test_smallest_rows_are_exact(spark, rows, sigmas):
    """With no bracket at all the range counts have to find the same rows."""
    hashed = rows.withColumn("_hash", shuffled(F.col("row_key"), 1))
    limits = spark.createDataFrame([("a", 7000), ("b", 10**9), ("c", 5)], "origin string, limit long")
    thresholds = ranking.smallest_thresholds(hashed, ["origin"], limits, 3, sigmas=sigmas)
    got = keys(ranking.below_thresholds(hashed, ["origin"], thresholds, 3))
    local = hashed.select("row_key", "origin", "_hash").toPandas().sort_values("_hash")
    expected = [*local[local.origin == "a"].row_key[:7000], *local[local.origin == "b"].row_key]
    assert got == sorted(expected)
    assert ranking.first_n(hashed, 0, "_hash").count() == 0 and ranking.first_n(hashed, 123, "_hash").count() == 123


def test_ranks_and_running_sums(rows):
    hashed = rows.withColumn("_hash", shuffled(F.col("row_key"), 1)).withColumn("w", F.length("class"))
    local = hashed.select("row_key", "origin", "_hash", "w").toPandas().sort_values("_hash").reset_index(drop=True)
    ranked = ranking.global_rank(hashed).select("row_key", "rank_no").toPandas().set_index("row_key")["rank_no"]
    assert (ranked[local.row_key].to_numpy() == np.arange(1, len(local) + 1)).all()
    summed = ranking.running_sum(hashed, ["origin"], F.col("w"), "c", 2).select("row_key", "c").toPandas().set_index("row_key")["c"]
    assert (summed[local.row_key].to_numpy() == local.groupby("origin")["w"].cumsum().to_numpy()).all()


@pytest.mark.parametrize("range_rows", [200, 3])
def test_ranges_follow_the_rows(rows, range_rows, monkeypatch):
    """No range holds more rows than stated, offsets of many ranges are added up in steps."""
    monkeypatch.setattr(ranking, "OFFSET_DIGITS", 1)
    hashed = rows.withColumn("_hash", shuffled(F.col("row_key"), 1)).withColumn("w", F.length("class"))
    totals, digits = ranking.range_totals(hashed, ["origin"], "_hash", F.col("w"), range_rows, least=1)
    assert totals.agg(F.max("__n")).first()[0] <= range_rows and digits >= 2
    offsets = ranking.range_offsets(totals, ["origin"], digits)
    assert offsets.count() == totals.count()
    local = hashed.select("row_key", "origin", "_hash", "w").toPandas().sort_values("_hash")
    summed = ranking.running_sum(hashed, ["origin"], F.col("w"), "c", 2, range_rows=range_rows).select("row_key", "c").toPandas().set_index("row_key")["c"]
    assert (summed[local.row_key].to_numpy() == local.groupby("origin")["w"].cumsum().to_numpy()).all()


def test_equal_hashes_end_the_splitting(spark):
    df = spark.range(40).select(F.lit("0" * 32).alias("_hash"), "id")
    assert ranking.range_totals(df, [], "_hash", F.lit(1), range_rows=10)[1] == ranking.MOST_DIGITS
    assert sorted(r["rank_no"] for r in ranking.global_rank(df, range_rows=10).collect()) == list(range(1, 41))


def test_draws_are_exact_and_proportional(spark, rows):
    weighted = rows.withColumn("weight", F.when(F.col("class") == "heavy", 3.0).otherwise(1.0))
    numbers = spark.createDataFrame([("a", 50_000), ("b", 100)], "origin string, n_draw long")
    out = density.draw_with_replacement(weighted, numbers, ["origin"], 2).cache()
    got = {r["origin"]: r["n"] for r in out.groupBy("origin").agg(F.sum("multiplicity").alias("n")).collect()}
    assert got == {"a": 50_000, "b": 100}
    rate = {r["class"]: r["m"] for r in out.filter("origin = 'a'").groupBy("class").agg(F.avg("multiplicity").alias("m")).collect()}
    assert rate["heavy"] / rate["light"] == pytest.approx(3.0, rel=0.02)
    assert density.repeat_rows(out).count() == 50_100


def test_drawn_rows_meet_the_rows_without_a_shuffle_of_them(spark, rows):
    weighted = rows.withColumn("weight", F.lit(1.0))
    numbers = spark.createDataFrame([("a", 100), ("b", 50)], "origin string, n_draw long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = density.draw_with_replacement(weighted, numbers, ["origin"], 2)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert out.agg(F.sum("multiplicity")).first()[0] == 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sums_of_wanted_ranges_are_those_of_all(rows):
    hashed = rows.withColumn("_hash", shuffled(F.col("row_key"), 3)).withColumn("w", F.length("class").cast("bigint"))
    whole = ranking.running_sum(hashed, ["origin"], F.col("w"), "c", 2).select("row_key", "_hash", "c")
    some = ranking.running_sum_in(hashed, ["origin"], F.col("w"), "c", lambda ranges: ranges.filter("__s > 0 AND __range < '08'"), 10_000)
    want = {tuple(r) for r in whole.filter("_hash < '08'").select("row_key", "c").collect()}
    assert want and {tuple(r) for r in some.select("row_key", "c").collect()} == want
    # ranges get short where marks are few among many rows, and stay as they are otherwise
    assert [ranking.sparse_digits(*x) for x in ((172_000_000, 40, 8_000), (1_000, 4, 100), (10**9, 1, 10**10))] == [4, 3, 3]


def test_weights_of_any_size_are_drawn_in_proportion(spark):
    """One row as heavy as a thousand million others; a floor under small weights would halve its draws."""
    rows = spark.range(1_000_001).select(
        F.md5(F.col("id").cast("string")).alias("row_key"), F.lit("a").alias("origin"), F.when(F.col("id") == 0, 1.0).otherwise(1e-9).alias("weight"))
    out = density.draw_with_replacement(rows, spark.createDataFrame([("a", 1000)], "origin string, n_draw long"), ["origin"], 1).cache()
    heavy = out.filter("weight = 1").first()["multiplicity"]
    assert heavy == 999 and out.agg(F.sum("multiplicity")).first()[0] == 1000


def test_weights_over_many_orders_of_magnitude(spark):
    weights = [10.0**k for k in range(-12, 3)] + [5e-324, 1e-300]
    rows = spark.createDataFrame([(f"{i:032x}", "a", w) for i, w in enumerate(weights)], "row_key string, origin string, weight double")
    n = 10**15
    out = density.draw_with_replacement(rows, spark.createDataFrame([("a", n)], "origin string, n_draw long"), ["origin"], 1)
    got = {r["weight"]: r["multiplicity"] for r in out.collect()}
    assert sum(got.values()) == n
    for w in weights[:-2]:
        assert got[w] == pytest.approx(n * w / sum(weights), rel=1e-6, abs=2)
    with pytest.raises(Exception, match="infinite weight"):
        density.draw_with_replacement(
            rows.withColumn("weight", F.lit(float("inf"))), spark.createDataFrame([("a", 1)], "origin string, n_draw long"), ["origin"], 1).collect()


def test_powers_of_two_are_exact(spark):
    values = [v for e in range(-1074, 1024, 7) for v in (2.0**e, np.nextafter(2.0**e, np.inf)) if v < np.inf] + [np.nextafter(2.0**e, 0) for e in range(-1000, 1024, 13)]
    got = spark.createDataFrame([(float(v),) for v in values], "x double").select("x", density.power_of_two(F.col("x")).alias("e")).collect()
    assert all(r["e"] == np.frexp(r["x"])[1] - 1 for r in got)


def test_small_weights_are_drawn(spark):
    rows = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("row_key"), F.lit("a").alias("origin"), F.lit(4e-7).alias("weight"))
    out = density.draw_with_replacement(rows, spark.createDataFrame([("a", 100)], "origin string, n_draw long"), ["origin"], 1)
    assert out.agg(F.sum("multiplicity")).first()[0] == 100
    empty = spark.createDataFrame([("a", 100), ("b", 5)], "origin string, n_draw long")
    with pytest.raises(Exception, match="without weight: b"):
        density.draw_with_replacement(rows, empty, ["origin"], 2).collect()


def test_density_resampling_follows_the_target(rows):
    options = rs.ResamplingOptions("pdf", CLASSES, AXES, 30_000, SHARES, target_class="heavy")
    out = pdf_resample(rows, options, ["a", "b"], smooth=False)
    sizes = {(r["origin"], r["class"]): r["count"] for r in out.groupBy("origin", "class").count().collect()}
    assert len({n for (o, _), n in sizes.items() if o == "a"}) == 1 and abs(sum(sizes.values()) / 3 - 30_000) < 3
    shapes = out.withColumn("bin", flat_bin(AXES)).groupBy("origin", "bin").pivot("class", CLASSES).count().na.fill(0).collect()
    for r in shapes:
        if min(r[c] for c in CLASSES) > 400:
            assert r["light"] == pytest.approx(r["heavy"], rel=0.1)


def test_spline_goes_through_the_centres_and_keeps_cubics(spark):
    axes = {"x": [float(v) for v in range(0, 9)], "y": [0.0, 1.0, 2.5, 3.0, 4.5, 6.0]}
    (xs, ys) = (np.array(e) for e in axes.values())
    cx, cy = (xs[:-1] + xs[1:]) / 2, (ys[:-1] + ys[1:]) / 2

    def f(x, y):
        return 200 + x**3 - 4 * x**2 * y + 0.3 * y**3 + x * y

    ratios = spark.createDataFrame(
        [("a", "heavy", int(i * len(cy) + j), float(f(x, y))) for i, x in enumerate(cx) for j, y in enumerate(cy)],
        "origin string, class string, bin int, ratio double")
    points = [(float(x), float(y)) for x in np.linspace(0, 8, 23) for y in np.linspace(0, 6, 19)] + list(zip(cx[:5].tolist(), cy.tolist()))
    df = spark.createDataFrame([("a", "heavy", x, y) for x, y in points], "origin string, class string, x double, y double")
    for r in density.smooth_weights(df, ratios, axes).collect():
        assert r["weight"] == pytest.approx(max(f(r["x"], r["y"]), 0.0), abs=1e-6)
    outside = spark.createDataFrame([("a", "heavy", -5.0, 99.0)], "origin string, class string, x double, y double")
    assert density.smooth_weights(outside, ratios, axes).first()["weight"] == pytest.approx(f(0.0, 6.0), abs=1e-6)


def test_small_grids_are_refused_a_smooth_ratio(spark):
    axes = {"x": [0.0, 1.0, 2.0], "y": [0.0, 1.0, 2.0]}
    ratios = spark.createDataFrame([("a", "heavy", b, float(b)) for b in range(4)], "origin string, class string, bin int, ratio double")
    df = spark.createDataFrame([("a", "heavy", 1.5, 0.5), ("a", "heavy", 9.0, 0.5)], "origin string, class string, x double, y double")
    with pytest.raises(ValueError, match="4 x 4"):
        density.smooth_weights(df, ratios, axes)
    assert n_bins(axes) == 4 and {r["x"]: r["weight"] for r in density.step_weights(df, ratios, axes).collect()} == {1.5: 2.0, 9.0: 0.0}


def test_event_merge(spark):
    a = spark.createDataFrame([(e, float(i)) for i, e in enumerate([0, 1, 2, 3, 4, 4])], "event int, pt double")
    assert [r["event"] for r in events.distinct_events(a).orderBy("event").collect()] == [0, 1, 2, 3, 4]
    chosen = spark.createDataFrame([(0,), (4,)], "event int")
    assert events.rows_of_events(a, chosen).count() == 3
    with pytest.raises(ValueError):
        events.merge_events(a, a, 0.5)
    assert events.merge_events(a, a, 1.0).count() == 12


def test_even_files(rows):
    hashed = rows.select("origin", "row_key", shuffled(F.col("row_key"), 1).alias("_hash"))
    out = events.assign_files(hashed, 7, ["origin"], "_hash", 2).groupBy("origin", "file_no").count().toPandas()
    for _, part in out.groupby("origin"):
        sizes = part.sort_values("file_no")["count"].tolist()
        assert len(sizes) == 7 and sizes == [len(x) for x in np.array_split(np.arange(sum(sizes)), 7)]
