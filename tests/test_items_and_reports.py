"""Item arrays, Shapley values, stored records, shards and size reports."""

import math
import warnings
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenkeel.functions.keys import shuffled
from evenkeel.functions.numeric import to_precision
from evenkeel.operators import evaluation as ev, inference, ranking, resampling as rs
from evenkeel.operators.item_arrays import ItemFeatures, item_arrays
from evenkeel.operators.labels import label_agreement
from evenkeel.sources import writers

NAN = float("nan")
ITEM = "id int, total double, items array<struct<frac:float,hits:int,d0:float,kind:int,valid:boolean>>"
STATS = {"frac": {"shift": 1.5, "scale": 0.25}, "hits": {"shift": 7, "scale": 4}}


def collection(spark):
    return spark.createDataFrame([
        (1, 10.0, [(0.5, 11, -2.0, 3, True), (8.0, 3, 0.25, None, True), (NAN, 0, NAN, 1, False), (None, None, None, None, None)]),
        (2, 20.0, []), (3, 30.0, None), (4, 40.0, [(32.0, 7, 6.0, 2, True)])], ITEM)


def test_item_arrays(spark):
    """Real items are scaled, others keep what they have and lose what is missing; no array stays none."""
    spec = ItemFeatures(["d0"], ["frac"], ["hits"], STATS, ["kind", "hits"])
    out = item_arrays(collection(spark), "items", spec)
    assert out.columns == ["id", "total", "items_inputs", "items_valid", "items_labels"]
    got = {r["id"]: r for r in out.collect()}
    want = [[-2.0, (math.log(0.5) - 1.5) / 0.25, 1.0], [0.25, (math.log(8.0) - 1.5) / 0.25, -1.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    assert [pytest.approx(w) for w in want] == got[1]["items_inputs"] and got[1]["items_valid"] == [True, True, False, False]
    assert got[1]["items_labels"] == [[3, 11], [0, 3], [1, 0], [0, 0]]
    assert (got[2]["items_inputs"], got[2]["items_valid"], got[2]["items_labels"]) == ([], [], [])
    assert got[3]["items_inputs"] is None and got[3]["items_valid"] is None
    headed = {r["id"]: r for r in item_arrays(collection(spark), "items", spec, "x", [F.col("total")], keep=["id"]).collect()}
    assert [v[0] for v in headed[1]["x_inputs"]] == [10.0, 10.0, 0.0, 0.0] and headed[4]["x_inputs"][0][0] == 40.0
    assert item_arrays(collection(spark).limit(0), "items", spec).count() == 0


def test_strict_and_lenient_items(spark):
    bad = spark.createDataFrame([(1, 0.0, [(0.0, 5, 1.0, 0, True), (2.0, 5, NAN, 0, True)])], ITEM)
    with pytest.raises(Exception, match="must be positive"):
        item_arrays(bad, "items", ItemFeatures([], ["frac"], [], STATS)).collect()
    with pytest.raises(Exception, match="not finite"):
        item_arrays(bad, "items", ItemFeatures(["d0"])).collect()
    with pytest.raises(KeyError):
        item_arrays(bad, "items", ItemFeatures([], [], ["d0"]))
    with pytest.raises(ValueError):
        item_arrays(bad, "items", ItemFeatures([], [], ["hits"], {"hits": {"shift": 0.0, "scale": 0.0}}))
    lenient = ItemFeatures(["d0"], ["frac"], ["hits"], {"frac": {"mean": 1.0, "std": 2.0}}, strict=False)
    assert item_arrays(bad, "items", lenient).first()["items_inputs"] == [[1.0, 0.0, 5.0], [0.0, pytest.approx((math.log(2.0) - 1.0) / 2.0), 5.0]]


def test_half_precision_of_arrays(spark):
    rows = [(1, [0.1, 1234.567, None]), (2, None), (3, []), (4, [NAN, 65504.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>").repartition(2)
    got = {r["id"]: r["y"] for r in df.select("id", to_precision(F.col("x"), "float16", array=True).alias("y")).collect()}
    assert got[1] == [float(np.float16(0.1)), float(np.float16(1234.567)), None] and got[2] is None and got[3] == []
    assert math.isnan(got[4][0]) and got[4][1] == 65504.0


def enumerated(k, value):
    """Shapley values by their definition."""
    phi = np.zeros(k)
    for j in range(k):
        others = [i for i in range(k) if i != j]
        for size in range(k):
            for chosen in combinations(others, size):
                weight = math.factorial(size) * math.factorial(k - size - 1) / math.factorial(k)
                phi[j] += weight * (value({*chosen, j}) - value(set(chosen)))
    return phi


def test_shapley_values_equal_the_enumeration(spark):
    rng = np.random.default_rng(5)
    weights, bias = rng.normal(size=(4, 3)), rng.normal(size=3)
    model = inference.softmax_model(weights, bias)
    x, background = rng.normal(size=(9, 4)), rng.normal(size=(5, 4))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id int, x array<double>").repartition(3)
    names, outputs = ["a", "b", "c", "d"], ["p", "q", "r"]
    out = inference.shapley_values(df, "x", names, model, outputs, background, ["id"])
    assert out.rdd.getNumPartitions() == 3 and out.columns == ["id", "feature", "output", "value"]
    got = {(r["id"], r["feature"], r["output"]): r["value"] for r in out.collect()}
    for i, row in enumerate(x):
        for o, output in enumerate(outputs):
            def value(chosen):
                mixed = background.copy()
                mixed[:, sorted(chosen)] = row[sorted(chosen)]
                return model(mixed)[:, o].mean()

            assert [got[i, n, output] for n in names] == pytest.approx(enumerated(4, value))
    table = {(r["feature"], r["output"]): r for r in inference.shapley_importance(out).collect()}
    values = [got[i, "b", "q"] for i in range(9)]
    assert table["b", "q"]["mean_size"] == pytest.approx(np.abs(values).mean()) and table["b", "q"]["n"] == 9


def test_sampled_coalitions_come_near_and_add_up():
    k = 13
    rng = np.random.default_rng(2)
    linear, pairs = rng.normal(size=k), rng.normal(size=(k, k)) * 0.1

    def value(masks):
        return masks @ linear + np.einsum("mi,ij,mj->m", masks, pairs, masks)

    masks, matrix = inference.shapley_operator(k, most=1000)
    assert len(masks) <= 1001 and inference.shapley_operator(k, most=1000)[0].tolist() == masks.tolist()
    phi = matrix @ value(masks.astype(float))
    exact = linear + np.diag(pairs) + (pairs + pairs.T).sum(axis=1) / 2 - np.diag(pairs)
    assert phi.sum() == pytest.approx(value(np.ones((1, k)))[0]) and np.abs(phi - exact).max() < 0.05


def test_background_means(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k"), F.array(F.col("id").cast("double"), F.lit(2.0)).alias("x"))
    means = inference.background_means(df, "x", 2, 4, "k")
    assert means.shape == (4, 2) and (means[:, 1] == 2.0).all() and abs(means[:, 0].mean() - 499.5) < 30


def test_stored_records_replace_only_their_part(spark, tmp_path):
    path = str(tmp_path / "epochs")

    def frame(rows):
        return spark.createDataFrame(rows, "epoch int, split string, loss double, accuracy double")

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "epochs").rglob("*.parquet")}

    ev.store_records(frame([(1, "train", 1.0, 0.1), (1, "test", 1.5, 0.1), (2, "train", 0.9, 0.2), (3, "train", 0.8, 0.3)]), path, "epoch", ["split"], ["loss", "accuracy"])
    before = files()
    ev.store_records(frame([(2, "train", 0.5, None), (2, "test", 0.7, 0.4)]), path, "epoch", ["split"], ["loss", "accuracy"])
    after = files()
    assert {f for f in before if "epoch=2" not in f} == {f for f in after if "epoch=2" not in f} and all(after[f] == before[f] for f in after if f in before)
    got = {(r["epoch"], r["split"]): (r["loss"], r["accuracy"]) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "train"): (1.0, 0.1), (1, "test"): (1.5, 0.1), (2, "train"): (0.5, 0.2), (2, "test"): (0.7, 0.4), (3, "train"): (0.8, 0.3)}


@pytest.mark.parametrize("shards, per_shard", [(3, 1), (4, 3)])
def test_shards_have_equal_files(spark, tmp_path, shards, per_shard):
    path = str(tmp_path / "shards")
    df = spark.range(1003).select("id", shuffled(F.col("id").cast("string"), 1).alias("_hash"))
    writers.write_shards(df, path, shards, "_hash", per_shard)
    stored = spark.read.parquet(path)
    files = stored.groupBy("shard", F.input_file_name().alias("file")).count().collect()
    assert len(files) == shards * per_shard and {r["shard"] for r in files} == set(range(shards))
    sizes = [r["count"] for r in files]
    assert max(sizes) - min(sizes) <= 1 and stored.select("id").distinct().count() == 1003


CLASSES, AXES = ["a", "b"], {"x": [0.0, 1.0, 2.0], "y": [0.0, 1.0]}


def balanced(spark):
    return spark.range(400).select(
        F.md5(F.col("id").cast("string")).alias("row_key"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("class"),
        F.lit("s").alias("origin"), (F.col("id") % 20 / 10).alias("x"), F.lit(0.5).alias("y"))


def test_size_reports(spark):
    """What was asked, what there is and what was taken; a warning if it is too little."""
    def run(n):
        return rs.count_undersample_reported(balanced(spark), rs.ResamplingOptions("count", CLASSES, AXES, n, {"s": 1.0}))

    with warnings.catch_warnings():
        warnings.simplefilter("error")
        few = run(40)
    assert {tuple(r) for r in few.report.collect()} == {("a", 20, 100, 20), ("b", 20, 100, 20)} and few.rows.count() == 40
    with pytest.warns(UserWarning, match="1000 rows were asked for, 200 are available"):
        many = run(1000)
    assert {tuple(r) for r in many.report.collect()} == {("a", 500, 100, 100), ("b", 500, 100, 100)} and many.rows.count() == 200
    weighed = rs.importance_undersample_reported(balanced(spark), rs.ResamplingOptions("importance", CLASSES, AXES, 30, target_class="a"))
    assert {tuple(r) for r in weighed.report.collect()} == {("a", 15, 100, 15), ("b", 15, 100, 15)}
    assert rs.importance_undersample_reported(balanced(spark), rs.ResamplingOptions("importance", CLASSES, AXES, target_class="a")).report is None


def test_capped_rows(spark):
    df = balanced(spark)
    got = ranking.capped_rows(df, 50, "row_key").select("requested", "available").distinct().collect()
    assert [tuple(r) for r in got] == [(50, 400)]
    with pytest.warns(UserWarning, match="500 rows were asked for, 400 are available"):
        assert ranking.capped_rows(df, 500, "row_key").count() == 400


def test_label_agreement(spark):
    a = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, None), (5, 1)], "k int, label int")
    b = spark.createDataFrame([(1, 0), (2, 2), (3, None), (4, 1), (6, 1)], "k int, label int")
    assert tuple(label_agreement(a, b, "k").first()) == (4, 2, 2)


def test_agreement_stops_at_nothing_and_counts_few_items(spark):
    """0.004 % rounds to 0.00 %: the ladder ends there, though one row is above."""
    df = spark.range(25_000).select(
        F.when(F.col("id") == 0, 1.0).when(F.col("id") < 5000, 0.15).otherwise(0.0).alias("a"), F.lit(0.0).alias("b"), (F.col("id") % 2).alias("n"))
    got = [(r["threshold"], r["n_above"]) for r in ev.score_agreement(df, "a", "b", [0.1, 0.2, 0.3]).collect()]
    assert got == [(0.1, 5000), (0.2, 1)]
    few = ev.score_agreement(df, "a", "b", [0.1, 0.9], "n", 1).first()
    assert few["n_above"] == 2500 and few["share"] == 0.2


def test_pooled_items(spark):
    from evenkeel.operators.item_arrays import pooled_items

    rows = [(1, [[1.0, 2.0], [3.0, 4.0]], [0.0, math.log(3.0)]), (2, [], []), (3, None, None), (4, [[5.0, 6.0]], [700.0])]
    df = spark.createDataFrame(rows, "id int, v array<array<double>>, s array<double>").repartition(2)
    got = {r["id"]: r for r in pooled_items(df, F.col("v"), 2, F.col("s"), ["id"]).collect()}
    assert got[1]["sum_pool"] == [4.0, 6.0] and got[1]["mean_pool"] == [2.0, 3.0] and got[1]["attention_pool"] == pytest.approx([2.5, 3.5])
    assert all(got[i][p] == [0.0, 0.0] for i in (2, 3) for p in ("sum_pool", "mean_pool", "attention_pool"))
    assert got[4]["attention_pool"] == [5.0, 6.0]
    assert pooled_items(df, F.col("v"), 2, keep=["id"]).filter("id = 1").first()["attention_pool"] == [2.0, 3.0]


def test_written_tables_can_be_removed(spark, tmp_path):
    from evenkeel import session

    session.remove_written(spark)
    kept = session.cut_lineage(spark.range(5).toDF("id"))
    place = kept.inputFiles()[0]
    assert kept.count() == 5 and session.remove_written(spark) == 1 and session.remove_written(spark) == 0
    assert not __import__("os").path.exists(place.removeprefix("file://"))


def test_json_tables_come_back(spark, tmp_path):
    from evenkeel.sources import readers

    table = spark.createDataFrame([("a", 1.5, None, 3), ("b", NAN, float("inf"), None)], "variable string, shift double, scale double, n long")
    writers.write_json(table, str(tmp_path / "stats"))
    back = readers.read_json(spark, str(tmp_path / "stats"), table)
    assert back.schema == table.schema and back.exceptAll(table).count() == 0 and back.count() == 2
    assert len(list((tmp_path / "stats").glob("*.json"))) == 1


def test_block_order_keeps_other_columns(spark):
    from evenkeel.operators.features import in_block_order

    df = spark.range(95).select(F.format_string("%03d", F.col("id")).alias("key"), (F.col("id") * 2).alias("x"))
    rows = in_block_order(df, "key", 4, 10).collect()
    place = {int(r["key"]): r["position"] for r in rows}
    assert sorted(place.values()) == list(range(95)) and all(r["x"] == 2 * int(r["key"]) for r in rows)
    starts = {b: min(place[i] for i in range(10 * b, min(95, 10 * b + 10))) for b in range(10)}
    assert all({place[i] - starts[b] for i in range(10 * b, min(95, 10 * b + 10))} == set(range(min(10, 95 - 10 * b))) for b in range(10))


def test_fitted_model_learns_and_repeats(spark):
    """Two classes apart by one feature: far better than guessing, the same on a second fit, probabilities add up to 1."""
    from evenkeel.operators.features import training_rows

    df = spark.range(2000).select(
        F.md5(F.col("id").cast("string")).alias("row_key"), (F.col("id") % 2).cast("int").alias("label"),
        ((F.col("id") % 2) * 2 - 1 + (F.col("id") % 7 - 3) / 2.5).alias("x"), (F.col("id") % 5 / 5).alias("noise"))
    training = training_rows(df, [F.col("x"), F.col("noise")], 2, ["row_key"])
    tables = []
    for _ in range(2):
        fitted = inference.apply_probability_model(training, inference.fit_probability_model(training), "m", ["a", "b"])
        tables.append(ev.quality(fitted, [F.col("m_a"), F.col("m_b")]).first())
    assert fitted.filter(F.abs(F.col("m_a") + F.col("m_b") - 1) > 1e-9).count() == 0
    assert tables[0] == tables[1] and tables[0]["n"] == 2000 and tables[0]["accuracy"] > 0.85 and tables[0]["loss"] < 0.4


def test_broadcasts_are_bounded_by_rows_and_width(spark):
    from evenkeel import session

    wide = spark.createDataFrame([(1, [[1.0]])], "id int, x array<array<double>>")
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(session.small(wide, 1000)) and not hinted(session.small(wide, 100_000)) and not hinted(session.small(spark.range(1), 3_000_000))
    assert hinted(session.small(spark.range(5), 2_000_000)) and hinted(session.small_counted(wide)) and session.small_counted(wide).count() == 1
