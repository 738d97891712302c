"""F: scaling statistics, their application, encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions import arrays
from evenkeel.functions.numeric import to_precision
from evenkeel.operators import scaling
from evenkeel.operators.features import training_rows
from evenkeel.operators.item_arrays import ItemFeatures, item_arrays
from evenkeel.queries.base import BASE, ITEMS, LAB, labelled, r, records, rounded, rows, scratch, table
from evenkeel.queries.registry import query
from evenkeel.session import cut_lineage
from evenkeel.sources import readers, writers

VARIABLES = ["price", "mass", "energy"]
_FILLED = """fin AS (SELECT count(*) AS n, avg(price) AS mp, avg(mass) FILTER (NOT isnan(mass)) AS dm FROM base),
filled AS (SELECT base.*, price AS p1, CASE WHEN isnan(mass) THEN dm ELSE mass END AS m1, CASE WHEN isinf(energy) OR isnan(energy) THEN 0.03::DOUBLE ELSE energy END AS e1, dm FROM base, fin),
stats AS (SELECT 'price' AS variable, avg(p1) AS shift, stddev_pop(p1) AS scale, avg(p1) AS "default", count(*) AS n FROM filled UNION ALL
 SELECT 'mass', avg(m1), stddev_pop(m1), any_value(dm), count(*) FROM filled UNION ALL
 SELECT 'energy', avg(e1), stddev_pop(e1), 0.03::DOUBLE, count(*) FROM filled)"""


def _stats(spark, sf):
    return scaling.row_statistics(rows(spark, sf), VARIABLES, {"energy": 0.03})


def _rounded_stats(df, *more):
    return df.select(
        "variable", rounded("shift", 5).alias("shift"), rounded("scale", 5).alias("scale"),
        *[rounded(m, 5).alias(m) for m in more], F.col("n").cast("bigint").alias("n"))


@query("f01_widen", f"WITH {BASE} SELECT row_key, {r('price::FLOAT::DOUBLE', 2)} AS price, {r('tax::FLOAT::DOUBLE')} AS tax FROM base")
def _(spark, sf):
    narrow = rows(spark, sf).select("row_key", F.col("price").cast("float"), F.col("tax").cast("float"))
    return narrow.select("row_key", rounded(F.col("price").cast("double"), 2).alias("price"), rounded(F.col("tax").cast("double")).alias("tax"))


@query("f02_item_mask", f"WITH {ITEMS} SELECT event, (pos - 1)::INTEGER AS pos, NOT isnan(frac) AS valid FROM oi")
def _(spark, sf):
    mask = F.transform("items", lambda x: ~F.isnan(x["frac"]))
    return records(spark, sf).select("event", F.posexplode(mask).alias("pos", "valid"))


@query("f03_row_statistics", f"""WITH {BASE}, {_FILLED} SELECT variable, {r('shift', 5)} AS shift, {r('scale', 5)} AS scale, {r('"default"', 5)} AS "default", n FROM stats
UNION ALL SELECT 'price_isDefaults', 0.0::DOUBLE, 1.0::DOUBLE, NULL, count(*) FROM base""")
def _(spark, sf):
    df = rows(spark, sf).withColumn("price_isDefaults", F.lit(0))
    return _rounded_stats(scaling.row_statistics(df, [*VARIABLES, "price_isDefaults"], {"energy": 0.03}), "default")


@query("f04_merged_statistics", f"""WITH {BASE} SELECT 'price' AS variable, {r('avg(price)', 5)} AS shift, {r('stddev_pop(price)', 5)} AS scale, count(*) AS n FROM base UNION ALL
SELECT 'quantity', {r('avg(quantity)', 5)}, {r('stddev_pop(quantity)', 5)}, count(*) FROM base""")
def _(spark, sf):
    df = rows(spark, sf).withColumn("part_no", F.pmod(F.xxhash64("row_key"), F.lit(5)))
    long = df.select("part_no", F.inline(F.array(
        F.struct(F.lit("price").alias("variable"), F.col("price").alias("x")),
        F.struct(F.lit("quantity").alias("variable"), F.col("quantity").alias("x")))))
    parts = long.groupBy("part_no", "variable").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("shift"), F.stddev_pop("x").alias("scale"))
    return _rounded_stats(scaling.merge_statistics(parts))


_ITEM_STATS = """ist AS (SELECT 'quantity' AS variable, avg(quantity) AS shift, stddev_pop(quantity) AS scale, count(*) AS n FROM oi WHERE NOT isnan(frac)
UNION ALL SELECT 'price', avg(ln(price + 1e-8)), stddev_pop(ln(price + 1e-8)), count(*) FROM oi WHERE NOT isnan(frac)
UNION ALL SELECT 'tax', avg(tax), stddev_pop(tax), count(*) FROM oi WHERE NOT isnan(frac))"""


def _masked(spark, sf):
    """Records whose items are valid where their probe field is there."""
    items = F.transform("items", lambda x: F.struct(
        x["quantity"].alias("quantity"), x["price"].alias("price"), x["tax"].alias("tax"), x["frac"].alias("frac"),
        x["kind"].alias("kind"), (~F.isnan(x["frac"])).alias("valid")))
    return records(spark, sf, ["quantity", "price", "tax", "frac", "kind"]).withColumn("items", items)


def _item_stats(df):
    return scaling.item_statistics(df, "items", ["quantity", "price", "tax"], ["price"])


@query("f05_item_statistics", f"WITH {ITEMS}, {_ITEM_STATS} SELECT variable, {r('shift')} AS shift, {r('scale')} AS scale, n FROM ist")
def _(spark, sf):
    return _item_stats(_masked(spark, sf)).select(
        "variable", rounded("shift").alias("shift"), rounded("scale").alias("scale"), "n")


@query("f06_label_weights", f"""WITH {ITEMS}, c AS (SELECT CASE WHEN isnan(frac) THEN -1 ELSE kind END AS value, count(*) AS n FROM oi GROUP BY 1)
SELECT value, n, {r('sum(n) OVER () / n::DOUBLE')} AS weight FROM c WHERE value <> -1""")
def _(spark, sf):
    items = _masked(spark, sf).select(F.explode("items").alias("i"))
    label = F.when(F.col("i.valid"), F.col("i.kind")).otherwise(-1)
    return scaling.label_weights(items, label).withColumn("weight", rounded("weight"))


@query("f07_checked_statistics", f"WITH {BASE}, {_FILLED} SELECT variable, {r('shift', 5)} AS shift, {r('scale', 5)} AS scale, n FROM stats")
def _(spark, sf):
    return _rounded_stats(scaling.check_statistics(_stats(spark, sf)))


_S = "(SELECT shift FROM stats WHERE variable = '{0}')", "(SELECT scale FROM stats WHERE variable = '{0}')"


def _scaled_sql(column: str, name: str) -> str:
    return r(f"({column} - {_S[0].format(name)}) / {_S[1].format(name)}")


@query("f08_row_scaling", f"""WITH {BASE}, {_FILLED} SELECT row_key, {_scaled_sql('p1', 'price')} AS price, {_scaled_sql('m1', 'mass')} AS mass, {_scaled_sql('e1', 'energy')} AS energy,
item_no AS n_isDefaults FROM filled""")
def _(spark, sf):
    stats = scaling.collect_statistics(_stats(spark, sf))
    df = rows(spark, sf).withColumn("n_isDefaults", F.col("item_no"))
    out = scaling.apply_row_scaling(df, [*VARIABLES, "n_isDefaults"], stats, ["row_key"])
    return out.select("row_key", *[rounded(v).alias(v) for v in VARIABLES], "n_isDefaults")


_SCALED_ITEMS = f"""{_ITEM_STATS}, st AS (SELECT max(shift) FILTER (variable = 'price') AS ps, max(scale) FILTER (variable = 'price') AS pc,
 max(shift) FILTER (variable = 'quantity') AS qs, max(scale) FILTER (variable = 'quantity') AS qc FROM ist),
sc AS (SELECT event, pos - 1 AS pos, unnest([0, 1, 2]) AS feature_no, unnest([tax, CASE WHEN isnan(frac) THEN ln(price) ELSE (ln(price) - ps) / pc END,
 CASE WHEN isnan(frac) THEN quantity ELSE (quantity - qs) / qc END]) AS value FROM oi, st)"""


def _long_items(df, column):
    return df.select("event", F.posexplode(column).alias("pos", "v")).select(
        "event", "pos", F.posexplode("v").alias("feature_no", "value")).withColumn("value", rounded("value"))


@query("f09_item_scaling", f"WITH {ITEMS}, {_SCALED_ITEMS} SELECT event, pos::INTEGER AS pos, feature_no, {r('value')} AS value FROM sc")
def _(spark, sf):
    # written, as statistics and scaling both read the nested items
    df = cut_lineage(_masked(spark, sf).select("event", "items"))
    stats = scaling.collect_statistics(scaling.check_statistics(_item_stats(df)))
    return _long_items(item_arrays(df, "items", ItemFeatures(["tax"], ["price"], ["quantity"], stats), keep=["event"]), F.col("items_inputs"))


@query("f10_lenient_scaling", f"""WITH {BASE}, s AS (SELECT avg(price) AS m, stddev_pop(price) AS d FROM base)
SELECT row_key, {r('(price - m) / d')} AS price, {r('CASE WHEN isnan(mass) THEN 0.0::DOUBLE ELSE mass END')} AS mass, {r('(CASE WHEN isinf(energy) THEN 0.05::DOUBLE ELSE energy END - 0.04) / 0.02')} AS energy FROM base, s""")
def _(spark, sf):
    df = rows(spark, sf)
    price = scaling.collect_statistics(scaling.row_statistics(df, ["price"]))["price"]
    stats = {"price": {"mean": price["shift"], "std": price["scale"]}, "energy": {"shift": 0.04, "scale": 0.02, "default": 0.05}}
    columns = scaling.lenient_scaled_columns(VARIABLES, stats)
    return df.select("row_key", *[rounded(c).alias(n) for n, c in columns.items()])


@query("f11_lenient_item_scaling", f"""WITH {ITEMS}, v AS (SELECT event, pos - 1 AS pos, unnest([0, 1]) AS feature_no,
 unnest([CASE WHEN tax > 0 THEN (CASE WHEN isnan(frac) THEN ln(tax) ELSE (ln(tax) + 3.0) / 0.5 END) ELSE 0.0::DOUBLE END, CASE WHEN isnan(frac) THEN 0.0::DOUBLE ELSE (frac - 0.05) / 0.03 END]) AS value FROM oi)
SELECT event, pos::INTEGER AS pos, feature_no, {r('value')} AS value FROM v""")
def _(spark, sf):
    stats = {"tax": {"shift": -3.0, "scale": 0.5}, "frac": {"shift": 0.05, "scale": 0.03}}
    return _long_items(_masked(spark, sf), scaling.scaled_items(F.col("items"), [], ["tax"], ["frac"], stats, strict=False))


@query("f12_one_hot", f"WITH {LAB} SELECT row_key, unnest([0, 1, 2]) AS position, unnest([(label = 0)::INTEGER, (label = 1)::INTEGER, (label = 2)::INTEGER]) AS value FROM lab")
def _(spark, sf):
    return labelled(spark, sf).select("row_key", F.posexplode(arrays.one_hot(F.col("label"), 3)).alias("position", "value"))


@query("f13_undo_scaling", f"WITH {BASE}, {_FILLED} SELECT row_key, {r('p1', 4)} AS price, {r('m1')} AS mass FROM filled")
def _(spark, sf):
    stats = scaling.collect_statistics(_stats(spark, sf))
    out = scaling.apply_row_scaling(rows(spark, sf), ["price", "mass"], stats, ["row_key"])
    return out.select(
        "row_key", rounded(scaling.unscaled(F.col("price"), stats["price"]), 4).alias("price"),
        rounded(scaling.unscaled(F.col("mass"), stats["mass"])).alias("mass"))


@query("f14_exported_statistics", f"""WITH {BASE}, {_FILLED} SELECT CASE variable WHEN 'price' THEN 'log_cost' ELSE variable END AS name, {r("CASE WHEN variable = 'mass' THEN 0.0::DOUBLE ELSE -shift END", 5)} AS "offset",
{r("CASE WHEN variable = 'mass' THEN 1.0::DOUBLE ELSE 1 / scale END", 7)} AS scale, {r('"default"', 5)} AS "default" FROM stats""")
def _(spark, sf):
    out = scaling.export_statistics(_stats(spark, sf), {"price": "cost"}, ["price"], ["mass"])
    return out.select("name", rounded("offset", 5).alias("offset"), rounded("scale", 7).alias("scale"), rounded("default", 5).alias("default"))


@query("f14_statistics_file", f"WITH {BASE}, {_FILLED} SELECT variable, {r('shift', 5)} AS shift, {r('scale', 5)} AS scale, {r('\"default\"', 5)} AS \"default\", n FROM stats")
def _(spark, sf):
    stats, path = _stats(spark, sf), scratch(spark, "statistics")
    writers.write_json(stats, path)
    return readers.read_json(spark, path, stats).select(
        "variable", *[rounded(c, 5).alias(c) for c in ("shift", "scale", "default")], "n")


# Half precision by hand: eleven significant binary digits, ties to even.
_HALF = "(CASE WHEN {x} = 0 THEN 0.0::DOUBLE ELSE round_even({x} / pow(2, floor(log2({x})) - 10), 0) * pow(2, floor(log2({x})) - 10) END)"


@query("f15_output_precision", f"WITH {BASE} SELECT row_key, {r('quantity::FLOAT::DOUBLE', 4)} AS quantity, {r(_HALF.format(x='(price / 100)'), 8)} AS price, {r('tax::FLOAT::DOUBLE', 8)} AS tax FROM base")
def _(spark, sf):
    return rows(spark, sf).select(
        "row_key", rounded(to_precision(F.col("quantity"), "float32").cast("double"), 4).alias("quantity"),
        rounded(to_precision(F.col("price") / 100, "float16").cast("double"), 8).alias("price"),
        rounded(to_precision(F.col("tax"), "float32").cast("double"), 8).alias("tax"))


@query("f15_array_precision", f"WITH {BASE} SELECT row_key, unnest([0, 1]) AS feature_no, round(unnest([{_HALF.format(x='(price / 100)')}, {_HALF.format(x='quantity')}]), 8) + 0.0 AS value FROM base")
def _(spark, sf):
    narrowed = to_precision(F.array(F.col("price") / 100, F.col("quantity")), "float16", array=True)
    return rows(spark, sf).select("row_key", F.posexplode(narrowed).alias("feature_no", "value")).withColumn("value", rounded(F.col("value").cast("double"), 8))


@query("f16_weight_column", f"WITH {LAB} SELECT row_key, {r('quantity / 10')} AS weight, 1.0::DOUBLE AS plain, 2 AS n_features FROM lab")
def _(spark, sf):
    df = labelled(spark, sf).withColumn("w", F.col("quantity") / 10)
    features = [F.col("price"), F.col("tax")]
    given = training_rows(df, features, 3, ["row_key"], weight="w")
    plain = training_rows(df, features, 3, ["row_key"], weight="not_there").select("row_key", F.col("weight").alias("plain"))
    return given.join(plain, "row_key").select("row_key", rounded("weight").alias("weight"), "plain", F.size("inputs").alias("n_features"))


@query("f17_item_labels", f"WITH {ITEMS}, v AS (SELECT event, pos - 1 AS pos, unnest([0, 1]) AS label_no, unnest([kind, CASE WHEN isnan(frac) THEN 0 ELSE trunc(frac * 100 + 1e-6) END::INTEGER]) AS value FROM oi) SELECT event, pos::INTEGER AS pos, label_no, value FROM v")
def _(spark, sf):
    items = F.transform("items", lambda x: F.struct(x["kind"].alias("kind"), (x["frac"] * 100 + 1e-6).alias("level")))
    labels = scaling.item_labels(items, ["kind", "level"])
    return records(spark, sf).select("event", F.posexplode(labels).alias("pos", "v")).select(
        "event", "pos", F.posexplode("v").alias("label_no", "value"))


@query("f18_padded_items", f"""WITH {ITEMS}, g AS (SELECT event, unnest(range(1, 9)) AS pos FROM ord)
SELECT g.event, (g.pos - 1)::INTEGER AS pos, coalesce(it.price, 0.0::DOUBLE) AS price, it.event IS NOT NULL AS valid FROM g LEFT JOIN it ON it.event = g.event AND it.pos = g.pos""")
def _(spark, sf):
    df = records(spark, sf)
    items = F.transform("items", lambda x: F.struct(x["price"].alias("price"), x["valid"].alias("valid")))
    filler = F.struct(F.lit(0.0).alias("price"), F.lit(False).alias("valid"))
    return df.select("event", F.posexplode(arrays.pad_items(items, 8, filler)).alias("pos", "i")).select("event", "pos", "i.price", "i.valid")
