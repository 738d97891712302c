"""Whole stages: reading, preparation, batches, inference, streams."""

import datetime as dt

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from evenkeel.functions.arrays import above
from evenkeel.functions.keys import shuffled
from evenkeel.operators import evaluation as ev, inference, items as it
from evenkeel.operators.features import batches
from evenkeel.operators.labels import ClassDef, label_classes, select_features
from evenkeel.operators.scaling import row_statistics
from evenkeel.plans.evaluate import evaluate
from evenkeel.plans.prepare import Sample, extract_sample
from evenkeel.queries import QUERIES
from evenkeel.queries.base import MAIN, NET, TREE, records, rows_of, scored, table
from evenkeel.sources import readers, writers
from evenkeel.streaming import incremental as inc

SF = "/root/testdata/sf0.001"


def test_natural_file_order():
    names = ["p/10.parquet", "p/2.parquet", "p/1.parquet"]
    assert sorted(names, key=readers.natural_key) == ["p/1.parquet", "p/2.parquet", "p/10.parquet"]


def test_schema_comparison(spark):
    def frame(cols):
        return spark.createDataFrame([tuple(range(len(cols)))], list(cols))

    one, two, three = frame("abcd"), frame("abef"), frame("abcdg")
    assert readers.common_columns([one, two]) == (["a", "b"], ["c", "d", "e", "f"])
    assert readers.common_columns([one, two, three]) == (["a", "b"], ["c", "d", "e", "f", "g"])
    assert readers.union_common([one, two]).columns == ["a", "b"]
    with pytest.raises(ValueError):
        readers.strict_union({"one": one, "two": two})


def test_strict_union_checks_array_widths(spark):
    a = spark.createDataFrame([([1, 2],)], "v array<int>")
    b = spark.createDataFrame([([1, 2, 3],)], "v array<int>")
    with pytest.raises(ValueError, match="different widths"):
        readers.strict_union({"a": a, "b": b}, ["v"])
    merged = readers.strict_union({"a": a, "b": a, "c": a}, ["v"])
    ranges = readers.source_ranges(merged, ["c", "a", "b"], totals={"s": F.sum(F.size("v"))})
    assert {tuple(r) for r in ranges.collect()} == {("c", 0, 1, 2), ("a", 1, 2, 2), ("b", 2, 3, 2)}


def test_missing_columns_are_reported(spark):
    with pytest.warns(UserWarning, match="not_there"):
        df = readers.scan(spark, f"{SF}/orders.parquet", ["o_orderkey", "not_there"])
    assert df.columns == ["o_orderkey"]
    with pytest.raises(KeyError):
        readers.scan(spark, f"{SF}/orders.parquet", ["o_orderkey"], ["no_label"])


def test_later_classes_win_and_unlabelled_rows_go(spark):
    classes = [ClassDef("small", ({"x": {"operator": "<", "condition": 5}},)), ClassDef("tiny", ({"x": {"operator": "<", "condition": 2}},))]
    df = spark.createDataFrame([(float(i),) for i in range(8)], "x double")
    got = {r["x"]: r["class"] for r in label_classes(df, classes).collect()}
    assert got == {0.0: "tiny", 1.0: "tiny", 2.0: "small", 3.0: "small", 4.0: "small"}
    assert label_classes(df, classes, keep_unlabelled=True).filter("label IS NULL").count() == 3


def test_feature_groups():
    assert select_features(["a", "b", "c"], ["g"], {"g": ["a", "c"]}) == (["b"], ["a", "c"], [0, 2])
    with pytest.raises(KeyError):
        select_features(["a"], ["b"])


def test_sample_extraction_is_capped(spark):
    rows = rows_of(table(spark, SF, "lineitem"))
    sample = Sample("s", "F", ClassDef("heavy", ({"truth": {"operator": "==", "condition": 5}},)), [{"event": {"operator": "mod_10_<=", "condition": 7}}], 50)
    out = extract_sample(rows, sample)
    assert out.count() == 50 and out.filter("truth <> 5 OR origin <> 'F' OR event % 10 > 7").count() == 0


def test_hot_key_sends_few_items(spark):
    """A key with too many items is an error, or truncated if asked; the plan limits before the shuffle."""
    flat = spark.range(20_000).select(F.when(F.col("id") < 15_000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    nested = it.nest_items(flat, "k", ["n"], ["n"], 8, truncate=True)
    assert [x["n"] for x in nested.filter("k = 0").first()["items"]] == list(range(8))
    assert nested.count() == 5001 and "WindowGroupLimit" in nested._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="more than 8 items at key 0"):
        it.nest_items(flat, "k", ["n"], ["n"], 8).collect()
    assert it.nest_items(flat.filter("k > 0"), "k", ["n"], ["n"], 8).count() == 5000
    whole = {r["k"]: [x["n"] for x in r["items"]] for r in it.nest_items(flat.repartition(5), "k", ["n"], ["n"]).collect()}
    assert len(whole) == 5001 and whole[0] == list(range(15_000)) and whole[15_000] == [15_000]


def test_batches_are_full_and_repeatable(spark):
    df = spark.range(1003).select(F.md5(F.col("id").cast("string")).alias("row_key"))
    out = batches(df, "row_key", 3, 100, 950).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in out] == [100] * 9 + [50]
    again = batches(df.repartition(9), "row_key", 3, 100, 950)
    assert again.exceptAll(batches(df, "row_key", 3, 100, 950)).count() == 0


def test_model_is_applied_to_batches(spark):
    model = inference.softmax_model(np.eye(2), np.zeros(2))
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [50.0, 0.0])], "id int, x array<double>")
    got = {r["id"]: (r["m_a"], r["m_b"]) for r in inference.predict(df, "x", model, "m", ["a", "b"]).collect()}
    assert got[1] == (0.5, 0.5) and got[2][0] == pytest.approx(1.0)


def test_permuted_features_keep_the_column(spark):
    df = spark.range(200).select(F.md5(F.col("id").cast("string")).alias("k"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    out = inference.permuted_features(df, "x", ["a", "b"], "k").withColumn("first", F.get("x", F.lit(0)))
    sums = {r["feature"]: r["s"] for r in out.groupBy("feature").agg(F.sum("first").alias("s")).collect()}
    assert sums == {"a": 19900.0, "b": 19900.0, "none": 19900.0}
    moved = out.filter("feature = 'a'").join(df.select("k", F.get("x", F.lit(0)).alias("own")), "k").filter("own <> first").count()
    assert moved > 150


def test_evaluation_tables(spark):
    df = scored(spark, SF)
    tables = evaluate(df, [NET, TREE], MAIN, [0.6, 0.8], ev.fraction_grid(["medium", "light"], 0.1, 0.9, 0.2), keep=["row_key"])
    assert tables["scores"].columns[:2] == ["row_key", "label"]
    assert tables["rejection_per_efficiency"].count() == 2 * 2 * 2
    local = df.toPandas()
    score = np.log((local.net_ph + 1e-10) / (0.3 * local.net_pm + 0.7 * local.net_pl + 1e-10))
    cut = np.percentile(score[local["class"] == "heavy"], 100 * (1 - 0.6))
    passed = int((score[local["class"] == "light"] > cut).sum())
    row = tables["rejection_per_efficiency"].filter("classifier = 'net' AND class = 'light' AND eff = 0.6").first()
    assert row["cut"] == pytest.approx(cut) and row["n_pass"] == passed


def test_streamed_statistics_equal_the_batch_result(spark, tmp_path):
    folder = str(tmp_path / "rows")
    # the last file holds missing masses only
    source = table(spark, SF, "lineitem")
    source.filter("l_linenumber <> 7").repartition(5).write.parquet(folder)
    source.filter("l_linenumber = 7").coalesce(1).write.mode("append").parquet(folder)
    stream = inc.open_stream(spark, folder, "*.parquet", max_files=1)
    names = ["price", "mass", "energy"]
    got = {r["variable"]: r for r in inc.streamed_statistics(stream, rows_of, names, {"energy": 0.03}).collect()}
    for r in row_statistics(rows_of(table(spark, SF, "lineitem")), names, {"energy": 0.03}).collect():
        mine = got[r["variable"]]
        assert (mine["shift"], mine["scale"], mine["n"]) == (pytest.approx(r["shift"]), pytest.approx(r["scale"]), r["n"])


def _events(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), k, v) for m, k, v in rows], "ts timestamp, kind string, value double")


def test_drift_monitor_drops_late_rows(spark, tmp_path):
    """Several micro-batches; a row whose window was closed is dropped, one within the delay counts."""
    parts = [
        _events(spark, [(5, "a", 1.0), (20, "a", 9.0), (70, "b", 9.0), (110, "a", float("nan"))]),
        _events(spark, [(130, "a", 9.0), (300, "a", 1.0), (50, "b", 9.0)]),
        _events(spark, [(310, "b", 9.0)]),
        _events(spark, [(10, "a", 9.0), (301, "a", 9.0), (295, "a", 9.0)]),  # the first is late
    ]
    stream = inc.open_stream(spark, inc.replay(parts, str(tmp_path / "in")), "*.parquet", max_files=1)
    out = inc.drift_monitor(stream, "ts", "1 hour", "30 minutes", ["kind"], above(F.col("value"), F.lit(5.0)), str(tmp_path / "out"))
    got = {(r["window_start"].hour, r["kind"]): (r["n"], r["n_passed"], r["pass_fraction"]) for r in out.collect()}
    assert got == {(0, "a"): (2, 1, 0.5), (1, "b"): (1, 1, 1.0), (1, "a"): (1, 0, 0.0), (2, "a"): (1, 1, 1.0), (5, "a"): (2, 1, 0.5),
                   (0, "b"): (1, 1, 1.0), (5, "b"): (1, 1, 1.0), (4, "a"): (1, 1, 1.0)}
    # the same folder again: nothing new arrives, nothing is counted twice
    again = inc.drift_monitor(stream, "ts", "1 hour", "30 minutes", ["kind"], above(F.col("value"), F.lit(5.0)), str(tmp_path / "out"))
    assert again.exceptAll(out).count() == 0 and again.count() == 8


def test_drift_monitor_equals_the_batch_result(spark, tmp_path):
    events = table(spark, "/root/testdata/sf0.01", "events").select("event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    marks = [r[0] for r in events.select(F.expr("percentile_approx(unix_micros(ts), array(0.0, 0.3, 0.6, 1.0))").alias("m")).selectExpr("explode(m)").collect()]
    at = F.unix_micros("ts")
    parts = [events.filter((at >= lo if i else F.lit(True)) & (at < hi if i < 2 else F.lit(True))) for i, (lo, hi) in enumerate(zip(marks, marks[1:]))]
    stream = inc.open_stream(spark, inc.replay(parts, str(tmp_path / "in")), "*.parquet", max_files=1)
    out = inc.drift_monitor(stream, "ts", "1 day", "1 hour", ["event_type"], above(F.col("value"), F.lit(50.0)), str(tmp_path / "out"))
    batch = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum((F.col("value") > 50).cast("int")).alias("n_passed"))
    own = out.select("window_start", "event_type", "n", "n_passed")
    assert own.count() > 100 and own.exceptAll(batch.select("w.start", "event_type", "n", "n_passed")).count() == 0
    assert own.agg(F.sum("n")).first()[0] == events.count()


def test_training_set_takes_one_pass(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            seen.add(len(part))
            yield part

    df = spark.range(4000, numPartitions=4).mapInPandas(count, "id long").withColumn("_order", shuffled(F.col("id").cast("string"), 8))
    writers.write_training_set(df, str(tmp_path / "set"), "_order")
    assert seen.value == 4000
    stored = [x for f in sorted((tmp_path / "set").glob("*.parquet")) for x in pq.read_table(f)["_order"].to_pylist()]
    assert len(stored) == 4000 and stored == sorted(stored)
    plain = spark.range(3).withColumn("_order", F.col("id").cast("string"))
    with pytest.raises(Exception, match="not a hash"):
        writers.write_training_set(plain, str(tmp_path / "plain"), "_order")


@pytest.mark.parametrize("name", ["f09_item_scaling", "g02_item_training_inputs", "h26_selected_rows", "h28_feature_importance"])
def test_what_is_read_several_times_is_written_first(spark, name):
    files = QUERIES[name](spark, SF).inputFiles()
    assert files and not any("lineitem" in f for f in files)


def test_records_nest_only_the_fields_asked_for(spark):
    nested = records(spark, SF, ["tax", "kind"])
    assert nested.schema["items"].dataType.elementType.names == ["tax", "kind"]
    whole = records(spark, SF).select("event", F.transform("items", lambda x: F.struct(x["tax"].alias("tax"), x["kind"].alias("kind"))).alias("all"))
    assert nested.join(whole, "event").filter(F.col("items") != F.col("all")).count() == 0
