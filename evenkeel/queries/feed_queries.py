"""G: batches, training inputs and pooled item sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions import arrays
from evenkeel.operators import features, items as it, scaling
from evenkeel.operators.item_arrays import ItemFeatures, pooled_items
from evenkeel.operators.resampling import ResamplingOptions
from evenkeel.plans.training_set import training_feed
from evenkeel.queries.base import BASE, ITEMS, LAB, NAMES, labelled, r, records, rounded, rows, sql_bin
from evenkeel.queries.merge_queries import AXES, BIN_SQL
from evenkeel.queries.registry import query
from evenkeel.session import cut_lineage


@query("g01_batches", f"""WITH {LAB}, n AS (SELECT row_key, row_number() OVER (ORDER BY md5('11|' || row_key)) - 1 AS n FROM lab)
SELECT row_key, n // 500 AS batch, (n % 500)::INTEGER AS step FROM n WHERE n < 20000""")
def _(spark, sf):
    return features.batches(labelled(spark, sf).select("row_key"), "row_key", 11, 500, 20000)


@query("g02_training_inputs", f"""WITH {LAB}, b AS (SELECT *, {BIN_SQL} AS bin FROM lab), h AS (SELECT class, bin, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY ALL),
w AS (SELECT h.class, h.bin, coalesce(t.n, 0)::DOUBLE / h.n AS w FROM h LEFT JOIN h t ON t.bin = h.bin AND t.class = 'heavy'),
s AS (SELECT avg(price) AS m, stddev_pop(price) AS d FROM lab)
SELECT b.row_key, b.label, {r('coalesce(nullif(w, 0), 1)', 9)} AS weight, unnest([0, 1]) AS feature_no, round(unnest([(price - m) / d, CASE WHEN isnan(mass) THEN 0.0::DOUBLE ELSE mass END]), 6) + 0.0 AS value
FROM b LEFT JOIN w ON w.class = b.class AND w.bin = b.bin, s""")
def _(spark, sf):
    df = labelled(spark, sf)
    stats = scaling.collect_statistics(scaling.row_statistics(df, ["price"]))
    options = ResamplingOptions("weighting", NAMES, AXES, target_class="heavy")
    feed = training_feed(df, ["price", "tax", "mass"], stats, options, excluded=["tax"])
    return feed.select(
        "row_key", "label", rounded("weight", 9).alias("weight"), F.posexplode("inputs").alias("feature_no", "value")
    ).withColumn("value", rounded("value"))


_RECORD_AXES = {"total": [0.0, 50000.0, 150000.0, 300000.0, 1e7], "n_items": [0.0, 2.0, 4.0, 100.0]}
_RECORD_BIN = " * 3 + ".join(f"({sql_bin(name, edges)})" for name, edges in _RECORD_AXES.items())
_RECORD_STATS = {"total": {"mean": 150000.0, "std": 90000.0}}


@query("g02_item_training_inputs", f"""WITH {ITEMS}, k AS (SELECT event, count(*) AS n_items FROM it GROUP BY event),
o AS (SELECT ord.event, total, status, label, coalesce(n_items, 0) AS n_items FROM ord LEFT JOIN k USING (event)), b AS (SELECT *, {_RECORD_BIN} AS bin FROM o),
h AS (SELECT status, bin, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY ALL),
w AS (SELECT h.status, h.bin, coalesce(t.n, 0)::DOUBLE / h.n AS w FROM h LEFT JOIN h t ON t.bin = h.bin AND t.status = 'O')
SELECT b.event, b.label, {r('coalesce(nullif(w, 0), 1)', 9)} AS weight, {r('(b.total - 150000.0) / 90000.0')} AS total, (pos - 1)::INTEGER AS pos, NOT isnan(frac) AS valid, kind,
  unnest([0, 1]) AS feature_no, round(unnest([CASE WHEN tax > 0 THEN (CASE WHEN isnan(frac) THEN ln(tax) ELSE (ln(tax) + 3.0) / 0.5 END) ELSE 0.0::DOUBLE END, CASE WHEN isnan(frac) THEN 0.0::DOUBLE ELSE (frac - 0.05) / 0.03 END]), 6) + 0.0 AS value
FROM b JOIN it USING (event) LEFT JOIN w ON w.status = b.status AND w.bin = b.bin""")
def _(spark, sf):
    items = F.transform("items", lambda x: x.withField("valid", ~F.isnan(x["frac"])))
    nested = records(spark, sf, ["tax", "frac", "kind"])
    # written, as weights and inputs both read the nested items
    df = cut_lineage(nested.withColumns({"items": items, "class": F.col("status"), "n_items": F.size("items")}))
    options = ResamplingOptions("weighting", ["F", "O", "P"], _RECORD_AXES, target_class="O")
    spec = ItemFeatures([], ["tax"], ["frac"], {"tax": {"mean": -3.0, "std": 0.5}, "frac": {"shift": 0.05, "scale": 0.03}}, ["kind"], strict=False)
    feed = training_feed(df, ["total"], _RECORD_STATS, options, keys=["event"], items={"items": spec})
    zipped = F.arrays_zip("items_inputs", "items_valid", "items_labels")
    return feed.select(
        "event", "label", rounded("weight", 9).alias("weight"), rounded(F.get("inputs", F.lit(0))).alias("total"), F.posexplode(zipped).alias("pos", "i")).select(
        "event", "label", "weight", "total", "pos", F.col("i.items_valid").alias("valid"), F.get("i.items_labels", F.lit(0)).alias("kind"),
        F.posexplode("i.items_inputs").alias("feature_no", "value")).withColumn("value", rounded("value"))


@query("g03_pooled_items", f"""WITH {ITEMS}, v AS (SELECT * FROM oi WHERE NOT isnan(frac)), m AS (SELECT event, max(discount * 10) AS top FROM v GROUP BY event),
p AS (SELECT v.event, sum(quantity) AS sq, avg(tax) AS mt, sum(tax * exp(discount * 10 - top)) / sum(exp(discount * 10 - top)) AS at FROM v JOIN m USING (event) GROUP BY v.event)
SELECT o.event, {r('coalesce(sq, 0)')} AS sum_quantity, {r('coalesce(mt, 0)')} AS mean_tax, {r('coalesce(at, 0)')} AS attention_tax FROM ord o LEFT JOIN p USING (event)""".replace(" AS at FROM", " AS att FROM").replace("coalesce(at, 0)", "coalesce(att, 0)"))
def _(spark, sf):
    real = arrays.valid_items(F.col("items"), flag=None, probe="frac")
    df = records(spark, sf).select("event", real.alias("items"))
    vectors = F.transform("items", lambda x: F.array(x["quantity"], x["tax"]))
    scores = F.transform("items", lambda x: x["discount"] * 10)
    pooled = pooled_items(df, vectors, 2, scores, ["event"])
    return pooled.select(
        "event", rounded(F.get("sum_pool", F.lit(0))).alias("sum_quantity"), rounded(F.get("mean_pool", F.lit(1))).alias("mean_tax"),
        rounded(F.get("attention_pool", F.lit(1))).alias("attention_tax"))


@query("g04_non_zero_items", f"""WITH {ITEMS}, n AS (SELECT o.event, o.label, count(i.event) FILTER (discount + tax <> 0) AS n FROM ord o LEFT JOIN it i USING (event) GROUP BY ALL)
SELECT label, n::INTEGER AS n_items, count(*) AS n_rows, n = 4 AS selected FROM n GROUP BY ALL""")
def _(spark, sf):
    counted = records(spark, sf).select(
        "label", it.non_zero_items(F.transform("items", lambda x: F.array(x["discount"], x["tax"]))).alias("n_items"))
    return counted.groupBy("label", "n_items").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("selected", F.col("n_items") == 4)
