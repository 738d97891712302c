"""A: sources, sinks and schemas."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from evenkeel.functions.arrays import one_hot
from evenkeel.functions.keys import shuffled
from evenkeel.operators import features, scaling
from evenkeel.operators.evaluation import rejection_per_efficiency, scores_long
from evenkeel.operators.item_arrays import ItemFeatures, item_arrays
from evenkeel.operators.items import row_onto_items
from evenkeel.operators.labels import rows_per_class
from evenkeel.operators.ranking import capped_rows, global_rank
from evenkeel.plans.prepare import TRAIN_SPLIT, requested_plan, tag_split
from evenkeel.queries.base import (
    BASE, CLASSES, ITEMS, LAB, MAIN, NAMES, NET, ORIGINS, REJECTION, SCORES, TREE, labelled, r, cuts_sql, records, rounded, rows, scored,
    scratch, table,
)
from evenkeel.queries.registry import query
from evenkeel.sources import readers, writers


@query("a01_scan_projection", """
SELECT l_orderkey, l_extendedprice, l_quantity, l_returnflag FROM lineitem""")
def _(spark, sf):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return readers.scan(
            spark, f"{sf}/line*.parquet", ["l_orderkey", "l_extendedprice", "l_quantity", "not_there"], ["l_returnflag"])


@query("a02_nested_scan", f"""WITH {ITEMS}
SELECT o.event, count(i.event)::INTEGER AS n_items, {r("coalesce(sum(i.price), 0)", 2)} AS items_price
FROM ord o LEFT JOIN it i ON i.event = o.event WHERE o.status = 'F' GROUP BY o.event""")
def _(spark, sf):
    kept = records(spark, sf).filter(F.col("status") == "F")
    total = F.aggregate("items", F.lit(0.0), lambda a, x: a + x["price"])
    return kept.select("event", F.size("items").alias("n_items"), rounded(total, 2).alias("items_price"))


@query("a03_row_cap", f"""WITH {BASE}, f AS (SELECT * FROM base WHERE quantity <= 40)
SELECT row_key, price, 1000::BIGINT AS requested, (SELECT count(*) FROM f) AS available
FROM f ORDER BY row_key LIMIT 1000""")
def _(spark, sf):
    kept = rows(spark, sf).filter(F.col("quantity") <= 40)
    return capped_rows(kept, 1000, "row_key").select("row_key", "price", "requested", "available")


@query("a04_row_range", f"""WITH {BASE}, n AS (SELECT *, row_number() OVER (ORDER BY row_key) - 1 AS row_no FROM base)
SELECT row_key, event, price, row_no FROM n WHERE row_no >= 500 AND row_no < 1500""")
def _(spark, sf):
    ranked = global_rank(rows(spark, sf).select("row_key", "event", "price"), "rank_no", "row_key")
    return readers.row_range(ranked, 500, 1500).select("row_key", "event", "price", (F.col("rank_no") - 1).alias("row_no"))


@query("a05_schema_comparison", """
WITH c AS (
  SELECT 'doc_id' AS "column", count(doc_id) AS n FROM documents UNION ALL SELECT 'text', count(text) FROM documents
  UNION ALL SELECT 'lang', count(lang) FROM documents UNION ALL SELECT 'source', count(source) FROM documents
  UNION ALL SELECT 'n_chars', count(n_chars) FROM documents UNION ALL SELECT 'doc_id', count(doc_id) FROM labels
  UNION ALL SELECT 'quality', count(quality) FROM labels UNION ALL SELECT 'toxic', count(toxic) FROM labels)
SELECT "column", count(*)::INTEGER AS n_present, count(*) = 2 AS common, sum(n)::BIGINT AS n_values FROM c GROUP BY "column" """)
def _(spark, sf):
    return readers.compare_columns({n: table(spark, sf, n) for n in ("documents", "labels")})


@query("a06_common_column_union", f"""WITH {BASE}
SELECT row_key, truth, price, quantity FROM base""")
def _(spark, sf):
    base = rows(spark, sf)
    first = base.filter(F.col("origin") == "F").select("row_key", "truth", "price", "quantity", "mass")
    second = base.filter(F.col("origin") == "O").select("row_key", "energy", "price", "quantity", "truth")
    return readers.union_common([first, second])


@query("a07_strict_append", """
WITH s AS (SELECT CASE WHEN label < 4 THEN 'a' WHEN label < 7 THEN 'b' ELSE 'c' END AS source, embedding FROM embeddings),
c AS (SELECT source, count(*) AS n, sum(len(embedding))::BIGINT AS n_values FROM s GROUP BY source)
SELECT source, (sum(n) OVER (ORDER BY source) - n)::BIGINT AS first_row, (sum(n) OVER (ORDER BY source))::BIGINT AS last_row, n_values FROM c""")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    parts = {
        "a": vectors.filter("label < 4"), "b": vectors.filter("label >= 4 AND label < 7"), "c": vectors.filter("label >= 7"),
    }
    merged = readers.strict_union(parts, arrays=["embedding"])
    return readers.source_ranges(merged, ["a", "b", "c"], totals={"n_values": F.sum(F.size("embedding")).cast("bigint")})


@query("a08_add_label_column", f"""WITH {LAB}
SELECT b.row_key, b.price, l.label FROM base b JOIN lab l ON l.row_key = b.row_key""")
def _(spark, sf):
    left = rows(spark, sf).select("row_key", "price")
    return left.join(labelled(spark, sf).select("row_key", "label"), "row_key")


@query("a09_label_by_source", """
WITH u AS (
  SELECT 'c' || c_custkey AS id, c_acctbal AS balance, 0 AS label FROM customer
  UNION ALL SELECT 's' || s_suppkey, s_acctbal, 1 FROM supplier)
SELECT id, balance, label, row_number() OVER (ORDER BY md5('7|' || id)) - 1 AS position FROM u""")
def _(spark, sf):
    parts = {
        0: table(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("id"), F.col("c_acctbal").alias("balance")),
        1: table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("id"), F.col("s_acctbal").alias("balance")),
    }
    return features.in_random_order(readers.label_by_source(parts), "id", 7)


@query("a10_bounded_files", """
SELECT count(*) AS n_rows, true AS bounded, round(sum(l_extendedprice), 2) AS price FROM lineitem""")
def _(spark, sf):
    path = scratch(spark, "bounded")
    writers.write_bounded(rows(spark, sf).select("row_key", "price"), path, 5000)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))
    return per_file.agg(
        F.sum("n").cast("bigint").alias("n_rows"), (F.max("n") <= 5000).alias("bounded"), rounded(F.sum("price"), 2).alias("price"))


_TRAIN_SQL = f"""WITH {LAB}, t AS (SELECT * FROM lab WHERE event % 10 <= 7)"""


@query("a11_training_set_sink", _TRAIN_SQL + """, v AS (
  SELECT row_key, label, item_no AS label_item_no, unnest([0, 1, 2]) AS feature_no, unnest([price, quantity, tax]) AS value FROM t)
SELECT row_key, label, label_item_no, feature_no, value, (label = 0)::INTEGER AS is_heavy, 1.0::DOUBLE AS weight FROM v""")
def _(spark, sf):
    chosen = tag_split(labelled(spark, sf), "event").filter(F.col("split") == TRAIN_SPLIT)
    training = features.training_rows(
        chosen, [F.col("price"), F.col("quantity"), F.col("tax")], len(CLASSES), ["row_key"], ["item_no"])
    path = scratch(spark, "training")
    writers.write_training_set(training, path)
    return spark.read.parquet(path).select(
        "row_key", "label", "label_item_no", F.get("label_one_hot", F.lit(0)).alias("is_heavy"), "weight",
        F.posexplode("inputs").alias("feature_no", "value"))


def _record_training(spark, sf):
    """Orders as training rows with row features on top of item features."""
    df = records(spark, sf)
    inputs = F.transform("items", lambda x: F.struct(F.array(x["quantity"], x["tax"]).alias("inputs"), x["valid"].alias("valid")))
    joined = row_onto_items([F.col("total")], inputs)
    flags = F.transform("items", lambda x: x["valid"])
    return features.training_rows(df, [F.col("total"), F.size("items").cast("double")], 3, ["event"], (),
                                  {"items": (joined, flags, None)})


_ITEM_SPEC = {"tax": {"shift": 0.04, "scale": 0.025}, "price": {"shift": 10.0, "scale": 0.9}, "quantity": {"shift": 25.0, "scale": 14.0}}
#: Item features in the sink: as they are, after a logarithm, scaled; 0 for what is missing where an item is not real.
_ITEM_VALUES = """unnest([0, 1, 2]) AS feature_no, unnest([tax, CASE WHEN isnan(frac) THEN ln(price) ELSE (ln(price) - 10.0) / 0.9 END,
  CASE WHEN isnan(frac) THEN quantity ELSE (quantity - 25.0) / 14.0 END]) AS value"""


def _item_features(strict: bool = True) -> ItemFeatures:
    return ItemFeatures(["tax"], ["price"], ["quantity"], _ITEM_SPEC, ["kind", "item_no"], strict=strict)


def _masked_records(spark, sf):
    """Records whose items are real where their probe field is there."""
    items = F.transform("items", lambda x: x.withField("valid", ~F.isnan(x["frac"])))
    return records(spark, sf, ["item_no", "quantity", "price", "tax", "frac", "kind"]).withColumn("items", items)


def _long_collection(df, *keys):
    """One row per item feature of a stored collection."""
    zipped = F.arrays_zip("items_inputs", "items_valid", "items_labels")
    return df.select(*keys, F.posexplode(zipped).alias("pos", "i")).select(
        *keys, "pos", F.col("i.items_valid").alias("valid"), F.get("i.items_labels", F.lit(0)).alias("kind"), F.get("i.items_labels", F.lit(1)).alias("number"),
        F.posexplode("i.items_inputs").alias("feature_no", "value")).withColumn("value", rounded("value"))


@query("a11_item_training_sink", f"""WITH {ITEMS}, v AS (SELECT event, label, total, (pos - 1)::INTEGER AS pos, NOT isnan(frac) AS valid, kind, item_no::INTEGER AS number, {_ITEM_VALUES} FROM oi)
SELECT event, label, {r('total / 1000')} AS total, pos, valid, kind, number, feature_no, {r('value')} AS value FROM v""")
def _(spark, sf):
    arrays = item_arrays(_masked_records(spark, sf), "items", _item_features())
    collection = {"items": tuple(F.col(f"items_{part}") for part in ("inputs", "valid", "labels"))}
    training = features.training_rows(arrays, [F.col("total") / 1000], 3, ["event"], (), collection)
    path = scratch(spark, "item-training")
    writers.write_training_set(training.withColumn("_order", shuffled(F.col("event").cast("string"), 8)), path, "_order")
    stored = spark.read.parquet(path).withColumn("total", rounded(F.get("inputs", F.lit(0))))
    return _long_collection(stored, "event", "label", "total")


@query("a16_scaled_item_file", f"""WITH {ITEMS}, s AS (SELECT avg(total) AS m, stddev_pop(total) AS d FROM ord),
v AS (SELECT event, label, (total - m) / d AS total, (pos - 1)::INTEGER AS pos, NOT isnan(frac) AS valid, kind, item_no::INTEGER AS number, {_ITEM_VALUES} FROM oi, s)
SELECT event, {r('total')} AS total, (label = 0)::INTEGER AS is_first, pos, valid, kind, number, feature_no, {r('value')} AS value FROM v""")
def _(spark, sf):
    df = _masked_records(spark, sf)
    stats = scaling.collect_statistics(scaling.check_statistics(scaling.row_statistics(df.select("total"), ["total"])))
    arrays = item_arrays(df, "items", _item_features())
    path = scratch(spark, "item-test-file")
    arrays.select(
        "event", scaling.scaled_columns(["total"], stats)["total"].alias("total"), one_hot(F.col("label"), 3).alias("one_hot"),
        "items_inputs", "items_valid", "items_labels").write.parquet(path)
    stored = spark.read.parquet(path).withColumns({"total": rounded("total"), "is_first": F.get("one_hot", F.lit(0))})
    return _long_collection(stored, "event", "total", "is_first")


@query("a12_dimensions", f"""WITH {ITEMS}, c AS (SELECT o.event, count(i.event) AS n FROM ord o LEFT JOIN it i USING (event) GROUP BY o.event)
SELECT count(*) AS n_rows, 2 AS n_features, 3 AS n_classes, max(n)::INTEGER AS n_items, 3 AS n_item_features FROM c""")
def _(spark, sf):
    return features.dimensions(_record_training(spark, sf), "items")


@query("a13_flat_records", f"""WITH {ITEMS}
SELECT o.event, (3 * count(i.event))::INTEGER AS n_values,
  {r("coalesce(sum(i.quantity), 0)", 3)} AS quantity, (o.status = 'F')::INTEGER AS is_first
FROM ord o LEFT JOIN it i USING (event) GROUP BY o.event, o.status""")
def _(spark, sf):
    path = scratch(spark, "flat")
    flat = features.flat_record(_record_training(spark, sf), "items", ["event"]).withColumn("_hash", shuffled(F.col("event").cast("string"), 3))
    writers.write_shards(flat, path, 4, "_hash", per_shard=2)
    every_third = F.aggregate(
        F.filter("item_values", lambda _, i: i % 3 == 1), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return spark.read.parquet(path).select(
        "event", F.size("item_values").alias("n_values"), rounded(every_third, 3).alias("quantity"),
        F.get("label_one_hot", F.lit(0)).alias("is_first"))


@query("a13_shard_sizes", """WITH n AS (SELECT count(*) AS n FROM orders), f AS (SELECT n, unnest(range(0, 8)) AS file_no FROM n)
SELECT (file_no // 2)::INTEGER AS shard, 2 AS n_files, sum(n // 8 + (file_no < n % 8)::INTEGER)::BIGINT AS n_rows, max(n // 8 + (file_no < n % 8)::INTEGER) - min(n // 8 + (file_no < n % 8)::INTEGER) AS spread FROM f GROUP BY file_no // 2""")
def _(spark, sf):
    path = scratch(spark, "shards")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", shuffled(F.col("o_orderkey").cast("string"), 3).alias("_hash"))
    writers.write_shards(orders, path, 4, "_hash", per_shard=2)
    per_file = spark.read.parquet(path).groupBy("shard", F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("shard").agg(
        F.count(F.lit(1)).cast("int").alias("n_files"), F.sum("n").alias("n_rows"), (F.max("n") - F.min("n")).alias("spread"))


@query("a14_sample_plan", f"""WITH {LAB}, tagged AS (
  SELECT CASE WHEN event % 10 <= 7 THEN 'train' WHEN event % 10 = 8 THEN 'validation' ELSE 'test' END AS step, origin, class FROM lab),
plan AS (SELECT * FROM (VALUES ('train', 10000), ('validation', 4000), ('test', 4000)) s(step, requested),
  (VALUES ('F'), ('O')) o(origin), (VALUES ('heavy'), ('medium'), ('light')) c(class))
SELECT p.step, p.origin, p.class, p.requested::BIGINT AS requested, count(t.class) AS available
FROM plan p LEFT JOIN tagged t ON t.step = p.step AND t.origin = p.origin AND t.class = p.class GROUP BY ALL""")
def _(spark, sf):
    tagged = tag_split(labelled(spark, sf), "event")
    return requested_plan(tagged, {"train": 10000, "validation": 4000, "test": 4000}, ORIGINS, NAMES)


@query("a15_result_tables", f"""WITH {SCORES},
{cuts_sql([0.6, 0.77])},
rej AS (SELECT s.classifier, s.class, c.eff, count(*) AS n, count(*) FILTER (score > cut) AS n_pass FROM scores s JOIN cuts c USING (classifier) WHERE class <> 'heavy' GROUP BY ALL)
SELECT classifier, class, round(eff, 6) AS eff, n, n_pass, {REJECTION} AS rejection FROM rej""")
def _(spark, sf):
    df = scored(spark, sf)
    folder = scratch(spark, "results")
    scores = scores_long(df, [NET, TREE], MAIN)
    writers.write_results({
        "rejection_per_efficiency": rejection_per_efficiency(scores, [0.6, 0.77], MAIN), "counts": rows_per_class(df)}, folder)
    counts = spark.read.parquet(f"{folder}/counts").withColumnRenamed("n", "n_rows")
    table_ = spark.read.parquet(f"{folder}/rejection_per_efficiency").join(counts, "class")
    return table_.select(
        "classifier", "class", rounded("eff").alias("eff"), F.col("n_rows").alias("n"), "n_pass", rounded("rejection").alias("rejection"))


@query("a16_scaled_test_file", f"""WITH {LAB}, f AS (
  SELECT avg(discount) FILTER (item_no <> 7) AS dm, avg(tax) FILTER (item_no <> 6) AS de, avg(price) AS mp, stddev_pop(price) AS sp FROM lab),
g AS (SELECT lab.*, CASE WHEN isnan(mass) THEN dm ELSE mass END AS m2, CASE WHEN isinf(energy) THEN de ELSE energy END AS e2, mp, sp FROM lab, f),
st AS (SELECT avg(m2) AS mm, stddev_pop(m2) AS sm, avg(e2) AS me, stddev_pop(e2) AS se FROM g)
SELECT row_key, label, {r("(price - mp) / sp")} AS price, {r("(m2 - mm) / sm")} AS mass, {r("(e2 - me) / se")} AS energy FROM g, st""")
def _(spark, sf):
    df = labelled(spark, sf)
    names = ["price", "mass", "energy"]
    stats = scaling.collect_statistics(scaling.check_statistics(scaling.row_statistics(df, names)))
    path = scratch(spark, "test-file")
    scaling.apply_row_scaling(df, names, stats, ["row_key", "label"]).write.parquet(path)
    return spark.read.parquet(path).select("row_key", "label", *[rounded(n).alias(n) for n in names])
