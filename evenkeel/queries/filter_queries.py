"""B: cuts, class labels and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions import arrays, cuts
from evenkeel.functions.numeric import derived, missing_to
from evenkeel.functions.score import probability_columns
from evenkeel.operators.evaluation import Classifier, scores_long
from evenkeel.operators.labels import (
    ClassDef, label_classes, label_columns, probability_names, rows_per_class, select_features,
)
from evenkeel.plans.prepare import Sample, extract_sample, tag_split
from evenkeel.queries.base import (
    BASE, CLASSES, LAB, MAIN, NET, PROBS, labelled, r, rounded, rows, scored, table, with_probabilities,
)
from evenkeel.queries.registry import query

COMPLETE = ("quantity", "price")


@query("b01_scalar_cut", f"WITH {BASE} SELECT row_key, price FROM base WHERE price <= 50000 AND quantity > 10 AND truth <> 4")
def _(spark, sf):
    return cuts.apply_cuts(rows(spark, sf), [
        {"price": {"operator": "<=", "condition": 50000}}, {"quantity": {"operator": ">", "condition": 10}},
        {"truth": {"operator": "!=", "condition": 4}},
    ], COMPLETE).select("row_key", "price")


@query("b02_list_cut", f"""WITH {BASE} SELECT row_key, truth, item_no FROM base
WHERE truth IN (5, 4) AND item_no NOT IN (2, 3) AND (quantity > 45 OR quantity > 30)""")
def _(spark, sf):
    return cuts.apply_cuts(rows(spark, sf), [
        {"truth": {"operator": "==", "condition": [5, 4]}}, {"item_no": {"operator": "!=", "condition": [2, 3]}},
        {"quantity": {"operator": ">", "condition": [45, 30]}},
    ]).select("row_key", "truth", "item_no")


@query("b03_modulo_cut", f"""WITH {BASE}, s AS (SELECT *, CASE WHEN event % 10 <= 7 THEN 'train' WHEN event % 10 = 8 THEN 'validation' ELSE 'test' END AS split,
  ((-event % 7) + 7) % 7 = 3 AS negative_hit FROM base)
SELECT split, negative_hit, count(*) AS n, min(event) AS first_event FROM s GROUP BY ALL""")
def _(spark, sf):
    df = tag_split(rows(spark, sf), "event").withColumn("minus", -F.col("event"))
    hit = cuts.cut_predicate([{"minus": {"operator": "mod_7_==", "condition": 3}}], df.schema)
    return df.groupBy("split", hit.alias("negative_hit")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event").alias("first_event"))


@query("b04_missing_values", f"""WITH {BASE}
SELECT count(*) FILTER (isnan(mass) OR mass > 0.05) AS above, count(*) FILTER (isnan(mass) OR mass <= 0.05) AS at_most,
  count(*) FILTER (isnan(mass) OR mass <> 0.05) AS other, count(*) FILTER (NOT isnan(mass) AND mass = 0.05) AS equal,
  count(*) FILTER (isnan(mass) OR mass = 0.05) AS equal_or_missing FROM base""")
def _(spark, sf):
    df = rows(spark, sf)

    def passing(op, **extra):
        return F.count(F.when(cuts.cut_predicate([{"mass": {"operator": op, "condition": 0.05, **extra}}], df.schema), 1))

    return df.agg(
        passing(">").alias("above"), passing("<=").alias("at_most"), passing("!=").alias("other"),
        passing("==").alias("equal"), passing("==", NaNcheck=True).alias("equal_or_missing"))


@query("b05_cut_list", f"""WITH {BASE} SELECT row_key, price, quantity FROM base
WHERE event % 2 = 0 AND price <= 80000 AND (isnan(mass) OR mass >= 0.02) AND truth IN (5, 0)""")
def _(spark, sf):
    nested = [
        {"event": {"operator": "mod_2_==", "condition": 0}}, None,
        [{"price": {"operator": "<=", "condition": 80000}}, [{"mass": {"operator": ">=", "condition": 0.02}}]],
        {"truth": {"operator": "==", "condition": [5, 0]}},
    ]
    return cuts.apply_cuts(rows(spark, sf), nested, COMPLETE).select("row_key", "price", "quantity")


@query("b06_category_cut", f"WITH {BASE} SELECT truth, count(*) AS n, round(sum(price), 2) AS price FROM base WHERE truth NOT IN (5, 4) OR truth = 5 GROUP BY truth")
def _(spark, sf):
    rest = cuts.cut_predicate(cuts.category_cut("truth", [5, 4], "!="))
    return rows(spark, sf).filter(rest | cuts.cut_predicate(cuts.category_cut("truth", 5))).groupBy("truth").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("price"), 2).alias("price"))


@query("b07_text_predicate", f"""WITH {BASE}
SELECT 'heavy' AS class, count(*) AS n FROM base WHERE truth = 5 UNION ALL
SELECT 'mixed', count(*) FROM base WHERE truth IN (0, 4) UNION ALL
SELECT 'soft', count(*) FROM base WHERE truth = 0 AND quantity < 20""")
def _(spark, sf):
    texts = {"heavy": "truth == 5", "mixed": "truth in [0, 4]", "soft": "truth == 0 and quantity < 20"}
    df = rows(spark, sf)
    matched = F.array_compact(F.array(*[F.when(cuts.text_predicate(t), F.lit(n)) for n, t in texts.items()]))
    return rows_per_class(df.select(F.explode(matched).alias("class")))


@query("b08_class_labels", f"WITH {LAB} SELECT row_key, label, class FROM lab")
def _(spark, sf):
    return labelled(spark, sf).select("row_key", "label", "class")


@query("b09_class_columns", f"""WITH {PROBS}
SELECT row_key, truth, quantity, {r("net_ph")} AS net_ph, {r("net_pm")} AS net_pm, {r("net_pl")} AS net_pl FROM probs""")
def _(spark, sf):
    probs = probability_names(CLASSES, ["net"])
    return scored(spark, sf).select("row_key", *label_columns(CLASSES), *[rounded(p).alias(p) for p in probs])


@query("b10_sample_extraction", f"""WITH {BASE}
SELECT row_key, event, price FROM base WHERE origin = 'F' AND event % 10 <= 7 AND truth = 0 AND quantity < 20
ORDER BY md5('42|' || row_key) LIMIT 2000""")
def _(spark, sf):
    sample = Sample("train_F_light", "F", CLASSES[2], [{"event": {"operator": "mod_10_<=", "condition": 7}}], 2000)
    return extract_sample(rows(spark, sf), sample).select("row_key", "event", "price")


@query("b11_feature_selection", f"""WITH {BASE}
SELECT 'price' AS feature, 0 AS position, {r("avg(price)", 5)} AS mean FROM base
UNION ALL SELECT 'discount', 2, {r("avg(discount)", 9)} FROM base""")
def _(spark, sf):
    names = ["price", "quantity", "discount", "tax", "item_no"]
    kept, _, gone = select_features(names, ["counts", "tax"], {"counts": ["quantity", "item_no"]})
    assert [names[i] for i in gone] == ["quantity", "tax", "item_no"]
    digits = {"price": 5}
    row = rows(spark, sf).agg(*[rounded(F.avg(k), digits.get(k, 9)).alias(k) for k in kept])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("feature"), F.lit(names.index(k)).alias("position"), F.col(k).alias("mean")) for k in kept])))


@query("b12_drop_positions", """
WITH e AS (SELECT vec_id, unnest(range(1, 65)) AS i, unnest(embedding) AS v FROM embeddings),
k AS (SELECT vec_id, v, row_number() OVER (PARTITION BY vec_id ORDER BY i) - 1 AS position FROM e WHERE i NOT IN (1, 6, 64))
SELECT vec_id, position::INTEGER AS position, round(v::DOUBLE, 6) + 0.0 AS value FROM k""")
def _(spark, sf):
    kept = arrays.drop_positions(F.col("embedding"), [0, 5, 63])
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(kept).alias("position", "v")).select(
        "vec_id", "position", rounded(F.col("v").cast("double")).alias("value"))


@query("b13_leading_features", """
SELECT vec_id, 3 AS n, round(embedding[1]::DOUBLE + embedding[2]::DOUBLE + embedding[3]::DOUBLE, 6) + 0.0 AS total FROM embeddings""")
def _(spark, sf):
    head = arrays.first_k(F.col("embedding"), 3)
    total = F.aggregate(head, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", F.size(head).alias("n"), rounded(total).alias("total"))


@query("b14_derived_variable", f"""WITH {BASE}, v AS (SELECT *, CASE WHEN isnan(mass) THEN 0.0::DOUBLE ELSE mass END AS m FROM base)
SELECT row_key, {r("m + tax")} AS added, {r("m - tax - discount")} AS reduced, {r("price * quantity", 2)} AS product,
  {r("CASE WHEN tax <> 0 THEN m / tax ELSE 0.0::DOUBLE END")} AS share, {r("ln(price)")} AS log_price
FROM v WHERE NOT isnan(mass)""")
def _(spark, sf):
    wanted = {
        "added": (["mass", "tax"], "+", 6), "reduced": (["mass", "tax", "discount"], "-", 6),
        "product": (["price", "quantity"], "*", 2), "share": (["mass", "tax"], "/", 6), "log_price": (["price"], "log", 6),
    }
    _, present = derived(["mass"], "+")
    return rows(spark, sf).filter(present).select(
        "row_key", *[rounded(derived(names, op)[0], d).alias(n) for n, (names, op, d) in wanted.items()])


@query("b15_extra_labels", f"""WITH {BASE} SELECT row_key, {r("CASE WHEN isnan(mass) THEN 0.0::DOUBLE ELSE mass END")} AS mass, item_no FROM base""")
def _(spark, sf):
    return rows(spark, sf).select("row_key", rounded(missing_to(F.col("mass"))).alias("mass"), "item_no")


@query("b16_extra_classes", f"""WITH {BASE}, x AS (SELECT *, CASE WHEN truth = 0 AND quantity >= 40 THEN 3 WHEN truth = 0 AND quantity < 20 THEN 2 WHEN truth = 4 THEN 1 WHEN truth = 5 THEN 0 END AS label FROM base),
p AS (SELECT *, 0.5 + 0.02 * quantity + CASE WHEN truth = 5 THEN 0.3 ELSE 0.0 END AS nh, 0.5 + 0.00001 * price + CASE WHEN truth = 4 THEN 0.2 ELSE 0.0 END AS nm,
  0.5 + 5.0 * tax + CASE WHEN truth = 0 THEN 0.3 ELSE 0.0 END AS nl FROM x WHERE label IS NOT NULL)
SELECT CASE label WHEN 0 THEN 'heavy' WHEN 1 THEN 'medium' WHEN 2 THEN 'light' ELSE 'extra' END AS class, count(*) AS n,
  {r("avg(ln((nh / (nh + nm + nl) + 1e-10) / (0.3 * (nm / (nh + nm + nl)) + 0.6 * (nl / (nh + nm + nl)) + 0.1 * 0.0 + 1e-10)))")} AS mean_score FROM p GROUP BY label""")
def _(spark, sf):
    extra = ClassDef("extra", (
        {"truth": {"operator": "==", "condition": 0}}, {"quantity": {"operator": ">=", "condition": 40}}), "px")
    classes = [*CLASSES, extra]
    net = Classifier("net", {c.name: c.suffix for c in classes}, {"medium": 0.3, "light": 0.6, "extra": 0.1})
    df = with_probabilities(label_classes(rows(spark, sf), classes))
    return scores_long(df, [net], MAIN).groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("score")).alias("mean_score"))
