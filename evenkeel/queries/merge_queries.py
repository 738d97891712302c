"""C: semi joins, gathers, lookups and checks across tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from evenkeel.functions.keys import shuffled
from evenkeel.operators import density, events, resampling
from evenkeel.operators.inference import predict, softmax_model
from evenkeel.operators.items import row_onto_items
from evenkeel.operators.labels import classes_per_origin, label_agreement
from evenkeel.queries.base import (
    BASE, CLASSES, ITEMS, LAB, NAMES, ORIGINS, labelled, r, records, rounded, rows, sql_bin, table,
)
from evenkeel.queries.registry import query

AXES = {"price": [900.0 + 5250.0 * i for i in range(21)], "quantity": [1.0 + 4.9 * i for i in range(11)]}
BINS = 200
BIN_SQL = f"({sql_bin('price', AXES['price'])}) * 10 + ({sql_bin('quantity', AXES['quantity'])})"


def _big_orders(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_totalprice") > 250000).select(F.col("o_orderkey").alias("event"))


@query("c01_semi_join", f"WITH {BASE} SELECT row_key, event, price FROM base WHERE event IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 250000)")
def _(spark, sf):
    return events.rows_of_events(rows(spark, sf), _big_orders(spark, sf)).select("row_key", "event", "price")


@query("c02_distinct_events", f"WITH {BASE} SELECT origin, count(DISTINCT event) AS n_events, count(*) AS n_rows FROM base GROUP BY origin")
def _(spark, sf):
    return events.event_summary(rows(spark, sf), "origin")


@query("c03_event_merge", f"""WITH {BASE}, a AS (SELECT * FROM base WHERE truth = 5), b AS (SELECT * FROM base WHERE truth <> 5),
na AS (SELECT CAST(floor(count(DISTINCT event) / 0.8) AS BIGINT) AS n FROM a),
pick AS (SELECT event FROM (SELECT event, row_number() OVER (ORDER BY md5('42|' || event)) AS rn FROM (SELECT DISTINCT event FROM b)), na WHERE rn <= n)
SELECT row_key, event, truth FROM a UNION ALL SELECT row_key, event, truth FROM b WHERE event IN (SELECT event FROM pick)""")
def _(spark, sf):
    df = rows(spark, sf).select("row_key", "event", "truth")
    a, b = df.filter("truth = 5"), df.filter("truth <> 5")
    return events.merge_events(a, b, 0.8).select("row_key", "event", "truth")


@query("c04_even_files", f"""WITH {BASE} SELECT row_key, origin, ntile(7) OVER (PARTITION BY origin ORDER BY md5('3|' || row_key))::INTEGER - 1 AS file_no FROM base""")
def _(spark, sf):
    hashed = rows(spark, sf).select("row_key", "origin", shuffled(F.col("row_key"), 3).alias("_hash"))
    return events.assign_files(hashed, 7, ["origin"], "_hash", 2).select("row_key", "origin", "file_no")


@query("c05_weight_lookup", f"""WITH {LAB}, b AS (SELECT *, {BIN_SQL} AS bin FROM lab),
h AS (SELECT class, bin, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY ALL),
w AS (SELECT h.class, h.bin, coalesce(t.n, 0)::DOUBLE / h.n AS w FROM h LEFT JOIN h t ON t.bin = h.bin AND t.class = 'heavy')
SELECT row_key, {r("coalesce(nullif(w, 0), 1)")} AS weight FROM b LEFT JOIN w ON w.class = b.class AND w.bin = b.bin""")
def _(spark, sf):
    options = resampling.ResamplingOptions("weighting", NAMES, AXES, target_class="heavy")
    return resampling.weight_rows(labelled(spark, sf), options).select("row_key", rounded("weight").alias("weight"))


@query("c06_rows_onto_items", f"""WITH {ITEMS}, v AS (SELECT event, pos - 1 AS pos, unnest([0, 1, 2]) AS feature_no,
  unnest(CASE WHEN quantity >= 5 THEN [total, price, tax] ELSE [0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE] END) AS value FROM oi)
SELECT event, pos::INTEGER AS pos, feature_no, {r("value", 2)} AS value FROM v""")
def _(spark, sf):
    inputs = F.transform("items", lambda x: F.struct(F.array(x["price"], x["tax"]).alias("inputs"), (x["quantity"] >= 5).alias("valid")))
    joined = row_onto_items([F.col("total")], inputs)
    return records(spark, sf).select("event", F.posexplode(joined).alias("pos", "v")).select(
        "event", "pos", F.posexplode("v").alias("feature_no", "value")).withColumn("value", rounded("value", 2))


@query("c07_gather_with_copies", f"""WITH {BASE}, i AS (SELECT row_key, item_no % 3 AS multiplicity FROM base)
SELECT b.row_key, b.price, unnest(range(1, multiplicity::BIGINT + 1)) AS copy FROM base b JOIN i USING (row_key)""")
def _(spark, sf):
    df = rows(spark, sf)
    index = df.select("row_key", (F.col("item_no") % 3).cast("bigint").alias("multiplicity"))
    return density.gather_rows(df.select("row_key", "price"), index).select("row_key", "price", "copy")


@query("c08_index_per_sample", f"""WITH {LAB} SELECT origin || '_' || class AS sample, count(*) AS n, min(row_key) AS first_key, max(row_key) AS last_key FROM lab GROUP BY 1""")
def _(spark, sf):
    return labelled(spark, sf).groupBy(F.concat_ws("_", "origin", "class").alias("sample")).agg(
        F.count(F.lit(1)).alias("n"), F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"))


# The label of an order by its own status, and by that of its items: all F, all O, or mixed.
@query("c09_label_alignment", f"""WITH {ITEMS}, i AS (SELECT event, CASE WHEN max(origin) = 'F' THEN 0 WHEN min(origin) = 'O' THEN 1 ELSE 2 END AS other FROM base GROUP BY event)
SELECT count(*) FILTER (ord.event IS NOT NULL AND i.event IS NOT NULL) AS n,
  count(*) FILTER (ord.event IS NOT NULL AND i.event IS NOT NULL AND label IS DISTINCT FROM other) AS n_different,
  count(*) FILTER (ord.event IS NULL OR i.event IS NULL) AS n_missing FROM ord FULL JOIN i USING (event)""")
def _(spark, sf):
    of_rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event"), (F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("o_orderstatus")) - 1).cast("int").alias("label"))
    of_items = rows(spark, sf).groupBy("event").agg(
        F.when(F.max("origin") == "F", 0).when(F.min("origin") == "O", 1).otherwise(2).alias("label"))
    return label_agreement(of_rows, of_items, "event")


MODEL_WEIGHTS = np.array([[0.03137, -0.01093, -0.02041], [4.0171, -3.0349, 1.0577], [-2.0291, 5.0113, 3.0733]])
MODEL_BIAS = np.array([0.1013, 0.2029, -0.1031])


def model_sql(source: str) -> str:
    """The linear soft-max model over quantity, discount and tax."""
    z = [
        " + ".join(f"{float(MODEL_WEIGHTS[i, j])!r}::DOUBLE * {f}" for i, f in enumerate(("quantity", "discount", "tax")))
        + f" + {float(MODEL_BIAS[j])!r}::DOUBLE" for j in range(3)
    ]
    e = [f"exp({x})" for x in z]
    total = " + ".join(e)
    return f"SELECT *, {e[0]} / ({total}) AS m_ph, {e[1]} / ({total}) AS m_pm, {e[2]} / ({total}) AS m_pl FROM {source}"


@query("c10_append_predictions", f"""WITH {LAB}, p AS ({model_sql('lab')})
SELECT row_key, {r("m_ph")} AS m_ph, {r("m_pm")} AS m_pm, {r("m_pl")} AS m_pl FROM p""")
def _(spark, sf):
    df = labelled(spark, sf).select("row_key", F.array("quantity", "discount", "tax").alias("x"))
    out = predict(df, "x", softmax_model(MODEL_WEIGHTS, MODEL_BIAS), "m", [c.suffix for c in CLASSES])
    return out.select("row_key", *[rounded(f"m_{s}").alias(f"m_{s}") for s in ("ph", "pm", "pl")])


@query("c11_concatenate_samples", f"WITH {LAB} SELECT row_key, class, origin FROM lab")
def _(spark, sf):
    df = labelled(spark, sf)
    parts = [df.filter(F.col("origin") == o).select("row_key", "class", F.lit(o).alias("origin")) for o in ORIGINS]
    return parts[0].unionByName(parts[1])


@query("c12_class_consistency", f"""WITH {LAB}, c AS (SELECT origin, string_agg(DISTINCT class, ',' ORDER BY class) AS classes FROM lab GROUP BY origin)
SELECT origin, classes, (SELECT count(DISTINCT classes) = 1 FROM c) AS consistent FROM c""")
def _(spark, sf):
    return classes_per_origin(labelled(spark, sf))
