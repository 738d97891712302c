"""H: scores, working points, rejections, grids and comparisons."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from evenkeel.functions.score import discriminant
from evenkeel.operators import evaluation as ev
from evenkeel.operators import histograms as h
from evenkeel.operators import inference, items as it, scaling
from evenkeel.operators.features import training_rows
from evenkeel.operators.labels import rows_per_class
from evenkeel.plans.evaluate import evaluate, flagship
from evenkeel.plans.prepare import tag_split
from evenkeel.queries.base import (
    CLASSES, ITEMS, LAB, MAIN, NAMES, NET, NET_SCORE, PROBS, REJECTION, SCORES, SUFFIXES, TREE, TREE_SCORE, cuts_sql,
    labelled, r, records, rounded, rows, scored, scratch, sql_bin,
)
from evenkeel.queries.binning_queries import _hist_sql
from evenkeel.queries.merge_queries import MODEL_BIAS, MODEL_WEIGHTS, model_sql
from evenkeel.queries.registry import query
from evenkeel.sources import writers

BOTH = [NET, TREE]
EFFS = ev.efficiency_grid()
NET_PROBS = ["net_ph", "net_pm", "net_pl"]


def _probs(names=NET_PROBS):
    return [F.col(n) for n in names]


@query("h01_discriminant", f"WITH {PROBS} SELECT row_key, {r(NET_SCORE)} AS score FROM probs")
def _(spark, sf):
    df = scored(spark, sf)
    return df.select("row_key", rounded(NET.score(df.columns, MAIN)).alias("score"))


@query("h02_several_main_classes", f"WITH {PROBS} SELECT row_key, {r('ln((net_ph + net_pm + 1e-10) / (1.0 * net_pl + 1e-10))')} AS score FROM probs")
def _(spark, sf):
    df = scored(spark, sf)
    return df.select("row_key", rounded(NET.score(df.columns, ["heavy", "medium"], {"light": 1.0})).alias("score"))


@query("h03_class_scores", f"WITH {PROBS} SELECT class, {r(TREE_SCORE)} AS score FROM probs WHERE class IN ('medium', 'light')")
def _(spark, sf):
    return ev.class_scores(scored(spark, sf), TREE, MAIN, ["medium", "light"]).withColumn("score", rounded("score"))


def _scores(spark, sf, *keys):
    return ev.scores_long(scored(spark, sf), BOTH, MAIN, ["class", *keys])


@query("h04_working_point_cut", f"WITH {SCORES}, {cuts_sql([0.77])} SELECT classifier, {r('cut', 7)} AS cut FROM cuts")
def _(spark, sf):
    return ev.working_points(_scores(spark, sf), [0.77], MAIN).select("classifier", rounded("cut", 7).alias("cut"))


_REJ = "rej AS (SELECT s.classifier, s.class, c.eff, any_value(c.cut) AS cut, count(*) AS n, count(*) FILTER (score > cut) AS n_pass FROM scores s JOIN cuts c USING (classifier) WHERE class <> 'heavy' GROUP BY ALL)"


@query("h05_rejection", f"WITH {SCORES}, {cuts_sql([0.77])}, {_REJ} SELECT classifier, class, {r('cut')} AS cut, n, n_pass, {REJECTION} AS rejection FROM rej")
def _(spark, sf):
    return ev.rejection_at(_scores(spark, sf), 0.77, MAIN).select(
        "classifier", "class", rounded("cut").alias("cut"), "n", "n_pass", rounded("rejection").alias("rejection"))


@query("h05_flagship", f"""WITH {SCORES.replace('FROM lineitem)', "FROM lineitem WHERE l_extendedprice <= 90000 AND (l_linenumber = 7 OR l_discount >= 0.01))")}, {cuts_sql([0.77])}, {_REJ}
SELECT classifier, class, {r('cut')} AS cut, n, n_pass, {REJECTION} AS rejection FROM rej""")
def _(spark, sf):
    return flagship(spark, sf)


@query("h06_absent_outputs", f"WITH {PROBS} SELECT class, 'part' AS classifier, count(*) AS n, {r('avg(ln((net_ph + 1e-10) / (0.3 * 0.0::DOUBLE + 0.7 * net_pl + 1e-10)))')} AS mean_score FROM probs GROUP BY class")
def _(spark, sf):
    df = scored(spark, sf).withColumnsRenamed({"net_ph": "part_ph", "net_pl": "part_pl"})
    part = ev.Classifier("part", SUFFIXES, NET.fractions)
    gone = ev.Classifier("gone", SUFFIXES, NET.fractions)
    return ev.scores_long(df, [part, gone], MAIN).groupBy("class", "classifier").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("score")).alias("mean_score"))


@query("h07_rejection_per_efficiency", f"WITH {SCORES}, {cuts_sql(EFFS)}, {_REJ} SELECT classifier, class, {r('eff')} AS eff, {r('cut')} AS cut, n, n_pass, {REJECTION} AS rejection FROM rej")
def _(spark, sf):
    out = ev.rejection_per_efficiency(_scores(spark, sf), EFFS, MAIN)
    return out.select("classifier", "class", rounded("eff").alias("eff"), rounded("cut").alias("cut"), "n", "n_pass", rounded("rejection").alias("rejection"))


GRID = ev.fraction_grid(["medium", "light"], 0.1, 1.0, 0.1)
_GRID_SQL = ", ".join(f"({i}, {g['medium']!r}::DOUBLE, {g['light']!r}::DOUBLE)" for i, g in enumerate(GRID))
_COMBOS = f"""combos AS (SELECT * FROM (VALUES {_GRID_SQL}) g(combo, f_medium, f_light))"""


@query("h08_fraction_grid", f"""WITH {PROBS}, steps AS (SELECT unnest(range(1, 11)) AS s),
g AS (SELECT a.s / 10.0::DOUBLE AS f_medium, b.s / 10.0::DOUBLE AS f_light FROM steps a, steps b WHERE a.s <> b.s AND a.s + b.s = 10)
SELECT {r('f_medium', 4)} AS f_medium, {r('f_light', 4)} AS f_light, {r('avg(ln((net_ph + 1e-10) / (f_medium * net_pm + f_light * net_pl + 1e-10)))')} AS mean_score FROM probs, g GROUP BY f_medium, f_light""")
def _(spark, sf):
    df = scored(spark, sf)
    long = ev.scores_per_fraction(df, [NET], MAIN, GRID)
    mean = long.groupBy("combo").agg(rounded(F.avg("score")).alias("mean_score"))
    at = {c: F.get(F.array(*[F.lit(g[c]) for g in GRID]), F.col("combo")) for c in ("medium", "light")}
    return mean.select(*[rounded(x, 4).alias(f"f_{c}") for c, x in at.items()], "mean_score")


def _grid_scores(classifiers=("net", "tree")) -> str:
    parts = [
        f"SELECT class, '{c}' AS classifier, combo, ln(({c}_ph + 1e-10) / (f_medium * {c}_pm + f_light * {c}_pl + 1e-10)) AS score FROM probs, combos"
        for c in classifiers
    ]
    return "gs AS (" + " UNION ALL ".join(parts) + ")"


_FRACTION_REJ = f"""{_COMBOS}, {_grid_scores()}, {cuts_sql([0.77], 'classifier, combo', 'gs')},
rej AS (SELECT s.classifier, s.class, s.combo, any_value(cut) AS cut, count(*) AS n, count(*) FILTER (score > cut) AS n_pass FROM gs s JOIN cuts c USING (classifier, combo) WHERE class <> 'heavy' GROUP BY ALL)"""


@query("h09_rejection_per_fraction", f"WITH {PROBS}, {_FRACTION_REJ} SELECT classifier, class, combo, {r('f_medium', 4)} AS f_medium, {r('f_light', 4)} AS f_light, {r('cut')} AS cut, n, n_pass, {REJECTION} AS rejection FROM rej JOIN combos USING (combo)")
def _(spark, sf):
    out = ev.rejection_per_fraction(scored(spark, sf), BOTH, MAIN, GRID, 0.77)
    return out.select(
        "classifier", "class", "combo", rounded("f_medium", 4).alias("f_medium"), rounded("f_light", 4).alias("f_light"),
        rounded("cut").alias("cut"), "n", "n_pass", rounded("rejection").alias("rejection"))


@query("a15_all_tables", f"""WITH {SCORES}, {cuts_sql([0.6, 0.77])}, {_FRACTION_REJ.replace('rej AS', 'frej AS').replace('cuts AS', 'fcuts AS').replace('JOIN cuts', 'JOIN fcuts')},
rej AS (SELECT s.classifier, s.class, c.eff, count(*) AS n, count(*) FILTER (score > cut) AS n_pass FROM scores s JOIN cuts c USING (classifier) WHERE class <> 'heavy' GROUP BY ALL)
SELECT 'scores' AS name, (SELECT count(*) FROM probs) AS n, {r('sum(score)', 4)} AS total FROM scores UNION ALL SELECT 'counts', count(DISTINCT class), count(*)::DOUBLE FROM probs
UNION ALL SELECT 'rejection_per_efficiency', count(*), sum(n_pass)::DOUBLE FROM rej UNION ALL SELECT 'rejection_per_fraction', count(*), sum(n_pass)::DOUBLE FROM frej""")
def _(spark, sf):
    folder = scratch(spark, "evaluation")
    writers.write_results(evaluate(scored(spark, sf), BOTH, MAIN, [0.6, 0.77], GRID, 0.77, ["row_key"]), folder)
    totals = {
        "scores": F.sum(F.col("disc_net") + F.col("disc_tree")), "counts": F.sum("n"),
        "rejection_per_efficiency": F.sum("n_pass"), "rejection_per_fraction": F.sum("n_pass")}
    parts = [
        spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n"), rounded(total.cast("double"), 4).alias("total")).withColumn("name", F.lit(name))
        for name, total in totals.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("h10_score_table", f"WITH {PROBS} SELECT row_key, price, label, {', '.join(f'{r(p)} AS {p}' for p in ('net_ph', 'net_pm', 'net_pl', 'tree_ph', 'tree_pm', 'tree_pl'))}, {r(NET_SCORE)} AS disc_net, {r(TREE_SCORE)} AS disc_tree, truth FROM probs")
def _(spark, sf):
    out = ev.score_table(scored(spark, sf), BOTH, MAIN, ["row_key", "price", "truth"])
    plain = ["row_key", "price", "truth", "label"]
    return out.select(*plain, *[rounded(c).alias(c) for c in out.columns if c not in plain])


@query("h11_recomputed_score", f"WITH {PROBS} SELECT row_key, {r('ln((net_ph + 1e-10) / (0.05 * net_pm + 0.95 * net_pl + 1e-10))')} AS score FROM probs")
def _(spark, sf):
    stored = ev.score_table(scored(spark, sf), [NET], MAIN, ["row_key"])
    again = discriminant(NET.probabilities(stored.columns), MAIN, {"medium": 0.05, "light": 0.95})
    return stored.select("row_key", rounded(again).alias("score"))


@query("h12_comparison_classifiers", f"WITH {SCORES}, {cuts_sql([0.7])}, {_REJ} SELECT classifier, class, {REJECTION} AS rejection FROM rej WHERE classifier = 'tree'")
def _(spark, sf):
    return ev.rejection_at(ev.scores_long(scored(spark, sf), [TREE], MAIN), 0.7, MAIN).select(
        "classifier", "class", rounded("rejection").alias("rejection"))


WPS = [0.6, 0.7, 0.77, 0.85]


@query("h13_working_points", f"WITH {SCORES}, {cuts_sql(WPS)} SELECT classifier, eff, {r('cut')} AS cut FROM cuts")
def _(spark, sf):
    return ev.working_points(_scores(spark, sf), WPS, MAIN).select("classifier", "eff", rounded("cut").alias("cut"))


@query("h14_confusion_matrix", f"""WITH {PROBS}, p AS (SELECT label, CASE WHEN net_ph >= net_pm AND net_ph >= net_pl THEN 0 WHEN net_pm >= net_pl THEN 1 ELSE 2 END AS predicted FROM probs)
SELECT label, predicted, count(*) AS n, {r('count(*) / sum(count(*)) OVER (PARTITION BY label)', 9)} AS share FROM p GROUP BY label, predicted""")
def _(spark, sf):
    return ev.confusion_matrix(scored(spark, sf), _probs(), 3).withColumn("share", rounded("share", 9))


V_EDGES = [900.0, 10000.0, 20000.0, 35000.0, 50000.0, 75000.0, 105000.0]


def _versus(cut: str, per_bin: bool = False) -> str:
    return f"""v AS (SELECT class, {sql_bin('price', V_EDGES)} AS bin, {NET_SCORE} AS score FROM probs), {cut},
e AS (SELECT class, v.bin, cut, count(*) AS n, count(*) FILTER (score > cut) AS n_pass FROM v{' JOIN k ON k.bin = v.bin' if per_bin else ', k'} WHERE v.bin IS NOT NULL GROUP BY ALL)
SELECT class, bin, {r('cut')} AS cut, n, n_pass, {r('n_pass / n', 9)} AS efficiency, {r('sqrt(n_pass / n * (1.0 - n_pass / n) / n)', 9)} AS error, {REJECTION} AS rejection FROM e"""


def _versus_out(df):
    return df.select(
        "class", "bin", rounded("cut").alias("cut"), "n", "n_pass", rounded("efficiency", 9).alias("efficiency"),
        rounded("error", 9).alias("error"), rounded("rejection").alias("rejection"))


def _net_scored(spark, sf):
    df = scored(spark, sf)
    return df.withColumn("score", NET.score(df.columns, MAIN))


@query("h15_efficiency_vs_variable", f"WITH {PROBS}, " + _versus(f"k AS (SELECT quantile_cont(score, {1.0 - 0.77!r}) AS cut FROM v WHERE class = 'heavy')"))
def _(spark, sf):
    return _versus_out(ev.efficiency_vs_variable(_net_scored(spark, sf), "score", "price", V_EDGES, MAIN, eff=0.77))


@query("h16_constant_efficiency", f"WITH {PROBS}, " + _versus(f"k AS (SELECT bin, quantile_cont(score, {1.0 - 0.7!r}) AS cut FROM v WHERE class = 'heavy' AND bin IS NOT NULL GROUP BY bin)", True))
def _(spark, sf):
    return _versus_out(ev.efficiency_vs_variable(_net_scored(spark, sf), "score", "price", V_EDGES, MAIN, eff=0.7, per_bin=True))


ROC_EFFS = ev.efficiency_grid(0.5, 0.95, 10)


@query("h17_roc", f"""WITH {SCORES}, {cuts_sql(ROC_EFFS)}, {_REJ}, q AS (SELECT *, CASE WHEN n_pass > 0 THEN 1.0::DOUBLE / (n_pass / (n + 1e-10)) ELSE 'NaN'::DOUBLE END AS rejection FROM rej)
SELECT a.classifier, a.class, {r('a.eff')} AS eff, {r('a.rejection')} AS rejection, {r('a.rejection ** 2 * sqrt(abs(a.n_pass / a.n * (1.0 - a.n_pass / a.n)) / a.n)')} AS rejection_err, {r('a.rejection / b.rejection')} AS ratio
FROM q a JOIN q b ON b.classifier = 'net' AND b.class = a.class AND b.eff = a.eff""")
def _(spark, sf):
    rej = ev.rejection_per_efficiency(_scores(spark, sf), ROC_EFFS, MAIN)
    out = ev.roc_table(rej, "net")
    return out.select("classifier", "class", *[rounded(c).alias(c) for c in ("eff", "rejection", "rejection_err", "ratio")])


S_EDGES = [-2.0 + 0.1 * i for i in range(51)]


@query("h18_score_histograms", f"""WITH {SCORES}, {_hist_sql('scores', 'score', S_EDGES, {'classifier': ['net', 'tree'], 'class': NAMES}, 'h')}, {cuts_sql([0.77])}
SELECT classifier, class, bin, count, {r('hist', 9)} AS hist, {r('unc', 9)} AS unc, {sql_bin('cut', S_EDGES)} AS cut_bin FROM h JOIN cuts USING (classifier)""")
def _(spark, sf):
    from evenkeel.operators.binning import bin_number

    scores = _scores(spark, sf)
    hist = ev.score_histograms(scores, ["net", "tree"], NAMES, S_EDGES)
    cuts = ev.working_points(scores, [0.77], MAIN).select("classifier", bin_number(F.col("cut"), S_EDGES).alias("cut_bin"))
    return hist.join(F.broadcast(cuts), "classifier").select(
        "classifier", "class", "bin", "count", rounded("hist", 9).alias("hist"), rounded("unc", 9).alias("unc"), "cut_bin")


P_EDGES = [0.02 * i for i in range(51)]


@query("h19_probability_histograms", f"""WITH {PROBS}, v AS (SELECT class, unnest(['net_ph', 'net_pm', 'net_pl']) AS variable, unnest([net_ph, net_pm, net_pl]) AS p FROM probs),
{_hist_sql('v', 'p', P_EDGES, {'class': NAMES, 'variable': ['net_ph', 'net_pm', 'net_pl']}, 'h')} SELECT class, variable, bin, count, {r('hist', 9)} AS hist FROM h""")
def _(spark, sf):
    out = h.variable_histograms(scored(spark, sf), {"class": NAMES}, {p: (F.col(p), P_EDGES) for p in NET_PROBS})
    return out.select("class", "variable", "bin", "count", rounded("hist", 9).alias("hist"))


@query("h20_fraction_contour", f"""WITH {PROBS}, {_FRACTION_REJ}, q AS (SELECT *, {REJECTION} AS rejection FROM rej JOIN combos USING (combo) WHERE classifier = 'tree')
SELECT {r('f_medium', 4)} AS f_medium, max(rejection) FILTER (class = 'medium') AS rej_x, max(rejection) FILTER (class = 'light') AS rej_y, round(f_medium, 4) = 0.3 AS marked FROM q GROUP BY f_medium""")
def _(spark, sf):
    rej = ev.rejection_per_fraction(scored(spark, sf), [TREE], MAIN, GRID, 0.77)
    out = ev.fraction_contour(rej, "tree", "medium", {}, "medium", "light", 0.3)
    return out.select(rounded("f_medium", 4).alias("f_medium"), rounded("rej_x").alias("rej_x"), rounded("rej_y").alias("rej_y"), "marked")


_QUALITY = "avg(-ln(least(greatest(CASE label WHEN 0 THEN {0} WHEN 1 THEN {1} ELSE {2} END, 1e-7), 1.0 - 1e-7)))"
_HIT = "avg((CASE WHEN {0} >= {1} AND {0} >= {2} THEN 0 WHEN {1} >= {2} THEN 1 ELSE 2 END = label)::INTEGER)"


@query("h21_model_quality", f"""WITH {SCORES}, {cuts_sql([0.77])}, {_REJ}, q AS (SELECT 'net' AS classifier, count(*) AS n, {_QUALITY.format(*NET_PROBS)} AS loss, {_HIT.format(*NET_PROBS)} AS accuracy FROM probs
UNION ALL SELECT 'tree', count(*), {_QUALITY.format('tree_ph', 'tree_pm', 'tree_pl')}, {_HIT.format('tree_ph', 'tree_pm', 'tree_pl')} FROM probs)
SELECT q.classifier, q.n, {r('loss')} AS loss, {r('accuracy', 9)} AS accuracy, class, {r('cut')} AS cut, {REJECTION.replace('n_pass / (n ', 'n_pass / (rej.n ')} AS rejection FROM q JOIN rej USING (classifier)""")
def _(spark, sf):
    df = scored(spark, sf)
    entries = F.array(*[
        F.struct(F.lit(c.name).alias("classifier"), F.array(*c.probabilities(df.columns).values()).alias("p")) for c in BOTH])
    long = df.select("label", F.inline(entries))
    table = ev.quality(long, [F.get("p", F.lit(i)) for i in range(3)], ["classifier"])
    rej = ev.rejection_at(_scores(spark, sf), 0.77, MAIN).drop("n", "n_pass")
    return table.join(F.broadcast(rej), "classifier").select(
        "classifier", "n", rounded("loss").alias("loss"), rounded("accuracy", 9).alias("accuracy"), "class",
        rounded("cut").alias("cut"), rounded("rejection").alias("rejection"))


def _epochs(spark, sf):
    """Stored predictions of four epochs: sharper from epoch to epoch, per data set."""
    df = tag_split(scored(spark, sf), "event")
    raised = [F.pow(F.col(p), F.col("epoch") / 2.0) for p in NET_PROBS]
    long = df.select("label", "split", *NET_PROBS, F.explode(F.sequence(F.lit(1), F.lit(4))).alias("epoch"))
    total = raised[0] + raised[1] + raised[2]
    return long.select("label", "split", "epoch", *[(x / total).alias(p) for x, p in zip(raised, NET_PROBS)])


_SPLIT = "CASE WHEN event % 10 <= 7 THEN 'train' WHEN event % 10 = 8 THEN 'validation' ELSE 'test' END"
_EPOCHS = f"""ep AS (SELECT label, {_SPLIT} AS split, epoch::INTEGER AS epoch, pow(net_ph, epoch / 2.0::DOUBLE) AS a, pow(net_pm, epoch / 2.0::DOUBLE) AS b, pow(net_pl, epoch / 2.0::DOUBLE) AS c FROM probs, (SELECT unnest(range(1, 5)) AS epoch)),
en AS (SELECT label, split, epoch, a / (a + b + c) AS x, b / (a + b + c) AS y, c / (a + b + c) AS z FROM ep),
eq AS (SELECT split, epoch, count(*) AS n, {_QUALITY.format('x', 'y', 'z')} AS loss, {_HIT.format('x', 'y', 'z')} AS accuracy FROM en GROUP BY split, epoch)"""


@query("h22_epoch_upsert", f"""WITH {PROBS}, {_EPOCHS}, old AS (SELECT split, epoch + 2 AS epoch, loss * 2 AS loss, 0.5::DOUBLE AS accuracy FROM eq)
SELECT split, epoch, {r('coalesce(eq.loss, old.loss)')} AS loss, {r('coalesce(eq.accuracy, old.accuracy)', 9)} AS accuracy FROM eq FULL JOIN old USING (split, epoch)""")
def _(spark, sf):
    new = ev.quality(_epochs(spark, sf), _probs(), ["split", "epoch"])
    stored = new.select("split", (F.col("epoch") + 2).alias("epoch"), (F.col("loss") * 2).alias("loss"), F.lit(0.5).alias("accuracy"))
    path = scratch(spark, "epochs")
    for records_ in (stored, new):
        ev.store_records(records_, path, "epoch", ["split"], ["loss", "accuracy"])
    out = spark.read.parquet(path)
    return out.select("split", "epoch", rounded("loss").alias("loss"), rounded("accuracy", 9).alias("accuracy"))


@query("h23_epoch_series", f"""WITH {PROBS}, {_EPOCHS} SELECT split, epoch, unnest(['loss', 'accuracy', 'tree_accuracy']) AS metric, round(unnest([loss, accuracy, 0.4::DOUBLE]), 6) + 0.0 AS value FROM eq""")
def _(spark, sf):
    table = ev.quality(_epochs(spark, sf), _probs(), ["split", "epoch"])
    out = ev.metric_series(table, ["split", "epoch"], ["loss", "accuracy"], {"tree": {"accuracy": 0.4}})
    return out.withColumn("value", rounded("value"))


FEATURES = ["quantity", "discount", "tax"]
MODEL = inference.softmax_model(MODEL_WEIGHTS, MODEL_BIAS)


def _features(spark, sf):
    return labelled(spark, sf).select("row_key", "label", F.array(*FEATURES).alias("x"))


@query("h24_batch_inference", f"WITH {LAB}, p AS ({model_sql('lab')}) SELECT label, count(*) AS n, {r('avg(m_ph)')} AS m_ph, {r('avg(m_pm)')} AS m_pm, {r('avg(m_pl)')} AS m_pl FROM p GROUP BY label")
def _(spark, sf):
    out = inference.predict(_features(spark, sf), "x", MODEL, "m", ["ph", "pm", "pl"])
    return out.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), *[rounded(F.avg(f"m_{s}")).alias(f"m_{s}") for s in ("ph", "pm", "pl")])


_LADDER = ", ".join(f"{t!r}::DOUBLE" for t in ev.DIFFERENCE_LADDER)
_GAP = f"abs({NET_SCORE} - {TREE_SCORE}) * CASE WHEN item_no < 5 THEN 1e-3 ELSE 1e-5 END"


@query("h25_score_agreement", f"""WITH {PROBS}, k AS (SELECT event, count(*) AS n_items FROM base GROUP BY event), d AS (SELECT {_GAP} AS gap FROM probs JOIN k USING (event) WHERE n_items < 6),
l AS (SELECT unnest([{_LADDER}]) AS threshold),
c AS (SELECT threshold, count(*) FILTER (gap > threshold) AS n_above, count(*) AS n FROM d, l GROUP BY threshold),
s AS (SELECT *, coalesce(min(round(n_above * 100 / n::DOUBLE, 2)) OVER (ORDER BY threshold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS before FROM c)
SELECT {r('threshold', 9)} AS threshold, n_above, {r('n_above / n::DOUBLE', 9)} AS share FROM s WHERE before > 0""")
def _(spark, sf):
    counts = rows(spark, sf).groupBy("event").agg(F.count(F.lit(1)).alias("n_items"))
    df = scored(spark, sf).join(counts, "event")
    gap = F.abs(NET.score(df.columns, MAIN) - TREE.score(df.columns, MAIN)) * F.when(F.col("item_no") < 5, 1e-3).otherwise(1e-5)
    out = ev.score_agreement(df.select(gap.alias("a"), F.lit(0.0).alias("b"), "n_items"), "a", "b", n_items="n_items", below_items=6)
    return out.select(rounded("threshold", 9).alias("threshold"), "n_above", rounded("share", 9).alias("share"))


@query("h25_worst_rows", f"WITH {PROBS} SELECT row_key, {r(f'abs({NET_SCORE} - {TREE_SCORE})')} AS difference FROM probs ORDER BY abs({NET_SCORE} - {TREE_SCORE}) DESC, row_key LIMIT 20")
def _(spark, sf):
    table = ev.score_table(scored(spark, sf), BOTH, MAIN, ["row_key"])
    return ev.worst_rows(table, "disc_net", "disc_tree", "row_key", 20).select("row_key", rounded("difference").alias("difference"))


@query("h26_selected_rows", f"""WITH {PROBS}, n AS (SELECT event, count(*) AS n_items FROM base GROUP BY event), v AS (SELECT *, {NET_SCORE} AS score FROM probs JOIN n USING (event)),
q AS (SELECT class, unnest([0.6::DOUBLE, 0.8::DOUBLE]) AS eff, unnest(quantile_cont(score, [{1.0 - 0.6!r}, {1.0 - 0.8!r}])) AS cut FROM v GROUP BY class)
SELECT class, eff, score > cut AS passed, count(*) AS n, {r('avg(price)', 6)} AS mean_price, {r('avg(tax)', 8)} AS mean_tax FROM v JOIN q USING (class) WHERE n_items = 4 AND score <> cut GROUP BY class, eff, score > cut""")
def _(spark, sf):
    counts = rows(spark, sf).groupBy("event").agg(F.count(F.lit(1)).alias("n_items"))
    df = _net_scored(spark, sf).join(counts, "event")
    out = ev.selection_summary(df, "score", "n_items", 4, [0.6, 0.8], NAMES, ["price", "tax"])
    return out.select("class", "eff", "passed", "n", rounded("mean_price", 6).alias("mean_price"), rounded("mean_tax", 8).alias("mean_tax"))


@query("h27_rows_per_class", f"WITH {LAB} SELECT class, class = 'heavy' AS is_main, count(*) AS n FROM lab GROUP BY class")
def _(spark, sf):
    return rows_per_class(labelled(spark, sf)).withColumn("is_main", F.col("class").isin(MAIN))


def _permuted_sql() -> str:
    parts = []
    for j, name in enumerate([*FEATURES, "none"]):
        cols = ", ".join(f"{'o' if i == j else 'a'}.{f} AS {f}" for i, f in enumerate(FEATURES))
        parts.append(f"SELECT '{name}' AS feature, a.label, {cols} FROM a JOIN a o ON o.r2 = a.r1")
    return " UNION ALL ".join(parts)


@query("h28_feature_importance", f"""WITH {LAB}, a AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || row_key)) AS r1, row_number() OVER (ORDER BY md5('43|' || row_key)) AS r2 FROM lab),
mixed AS ({_permuted_sql()}), p AS ({model_sql('mixed')}), q AS (SELECT feature, count(*) AS n, {_QUALITY.format('m_ph', 'm_pm', 'm_pl')} AS loss, {_HIT.format('m_ph', 'm_pm', 'm_pl')} AS accuracy FROM p GROUP BY feature)
SELECT feature, n, {r('loss')} AS loss, {r('accuracy', 9)} AS accuracy, {r("(SELECT accuracy FROM q WHERE feature = 'none') - accuracy", 9)} AS accuracy_drop FROM q WHERE feature <> 'none'""")
def _(spark, sf):
    out = inference.feature_importance(_features(spark, sf), "x", FEATURES, MODEL, ["ph", "pm", "pl"], "row_key")
    return out.select("feature", "n", rounded("loss").alias("loss"), rounded("accuracy", 9).alias("accuracy"), rounded("accuracy_drop", 9).alias("accuracy_drop"))


def _shapley_sql() -> str:
    """Every coalition of the three features, absent ones at their mean, weighted as the values' definition says."""
    cols = ", ".join(f"CASE WHEN (m >> {i}) & 1 = 1 THEN {f} ELSE m_{f} END AS {f}" for i, f in enumerate(FEATURES))
    means = ", ".join(f"avg({f}) AS m_{f}" for f in FEATURES)
    size = " + ".join(f"((m >> {i}) & 1)" for i in range(3))
    value = f"CASE ({size}) - ((m >> j) & 1) WHEN 1 THEN 1 / 6.0::DOUBLE ELSE 1 / 3.0::DOUBLE END * CASE WHEN (m >> j) & 1 = 1 THEN 1 ELSE -1 END"
    return f"""mn AS (SELECT {means} FROM lab), mixed AS (SELECT row_key, class, m, {cols} FROM (SELECT row_key, class, {', '.join(FEATURES)} FROM lab), mn, (SELECT unnest(range(8)) AS m)),
p AS ({model_sql('mixed')}), t AS (SELECT unnest([0, 1, 2]) AS j, unnest(['quantity', 'discount', 'tax']) AS feature),
v AS (SELECT row_key, class, feature, unnest(['ph', 'pm', 'pl']) AS output, unnest([sum(({value}) * m_ph), sum(({value}) * m_pm), sum(({value}) * m_pl)]) AS value FROM p, t GROUP BY row_key, class, feature)"""


@query("h28_shapley", f"""WITH {LAB}, {_shapley_sql()}
SELECT class, feature, output, count(*) AS n, {r('avg(value)', 7)} AS mean_value, {r('avg(abs(value))', 7)} AS mean_size FROM v GROUP BY class, feature, output""")
def _(spark, sf):
    df = labelled(spark, sf).select("row_key", "class", F.array(*FEATURES).alias("x"))
    background = inference.background_means(df, "x", 3, 1, "row_key")
    values = inference.shapley_values(df, "x", FEATURES, MODEL, ["ph", "pm", "pl"], background, ["class"])
    return inference.shapley_importance(values, ["class"]).select(
        "class", "feature", "output", "n", rounded("mean_value", 7).alias("mean_value"), rounded("mean_size", 7).alias("mean_size"))


@query("h29_fitted_model")
def _(spark, sf):
    df = labelled(spark, sf)
    stats = scaling.collect_statistics(scaling.row_statistics(df, FEATURES))
    scaled = list(scaling.scaled_columns(FEATURES, stats).values())
    training = training_rows(df, scaled, 3, ["row_key"])
    model = inference.fit_probability_model(training)
    fitted = inference.apply_probability_model(training, model, "fit", ["ph", "pm", "pl"])
    return ev.quality(fitted, [F.col(f"fit_{s}") for s in ("ph", "pm", "pl")])
