"""E: balancing the classes."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import functions as F

from evenkeel.operators import binning, density, features, fractions as fr, resampling as rs
from evenkeel.plans.prepare import tag_split
from evenkeel.plans.resample import pdf_resample, run_resampling
from evenkeel.queries.base import LAB, NAMES, ORIGINS, labelled, r, rounded
from evenkeel.queries.binning_queries import _COUNTS
from evenkeel.queries.merge_queries import AXES, BINS, BIN_SQL
from evenkeel.queries.registry import query
from evenkeel.session import cut_lineage

SHARES = {"F": 0.6, "O": 0.4}
SHARES_SQL = "CASE origin WHEN 'F' THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END"


def _hash_sql(step: str, seed: int = 42) -> str:
    turn = {"bin": 0, "origin": 10, "size": 20}[step]
    h = f"md5('{seed}|' || row_key)"
    return h if turn == 0 else f"(substr({h}, {turn + 1}) || substr({h}, 1, {turn}))"


@query("e01_fraction_correction", f"""WITH {LAB}, c AS (SELECT class, origin, count(*) AS n, {SHARES_SQL} AS fraction FROM lab GROUP BY ALL),
k AS (SELECT *, min(n / fraction) OVER (PARTITION BY class) AS k FROM c)
SELECT class, origin, n, fraction, floor(k * fraction + 1e-9)::BIGINT AS target FROM k""")
def _(spark, sf):
    counts = labelled(spark, sf).groupBy("class", "origin").agg(F.count(F.lit(1)).alias("n"))
    return fr.correct_fractions(fr.with_fraction(counts, "origin", SHARES), ["class"])


def count_sql(source: str, total: int, seed: int = 42) -> str:
    """Count undersampling with global windows."""
    return f"""cb AS (SELECT * FROM (SELECT *, {BIN_SQL} AS bin FROM {source}) WHERE bin IS NOT NULL),
cm AS (SELECT bin, CASE WHEN count(DISTINCT class) = 3 THEN min(n) ELSE 0 END AS m FROM (SELECT class, bin, count(*) AS n FROM cb GROUP BY ALL) GROUP BY bin),
c1 AS (SELECT * FROM (SELECT cb.*, m, row_number() OVER (PARTITION BY class, cb.bin ORDER BY {_hash_sql('bin', seed)}) AS rn FROM cb JOIN cm ON cm.bin = cb.bin) WHERE rn <= m),
ct AS (SELECT origin, floor(k * fraction + 1e-9)::BIGINT AS target FROM (SELECT origin, fraction, min(n / fraction) OVER () AS k FROM
  (SELECT origin, count(*) AS n, {SHARES_SQL} AS fraction FROM c1 WHERE class = 'heavy' GROUP BY ALL))),
c2 AS (SELECT * FROM (SELECT c1.* EXCLUDE (rn, m), target, row_number() OVER (PARTITION BY class, c1.origin ORDER BY {_hash_sql('origin', seed)}) AS rn2 FROM c1 JOIN ct ON ct.origin = c1.origin) WHERE rn2 <= target),
picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_hash_sql('size', seed)}) AS rn3 FROM c2) WHERE rn3 <= {total // 3})"""


def _count_options(total: int, **extra) -> rs.ResamplingOptions:
    return rs.ResamplingOptions("count", NAMES, AXES, total, SHARES, **extra)


@query("e02_count_undersampling", f"WITH {LAB}, {count_sql('lab', 12000)} SELECT row_key, class, origin, bin FROM picked")
def _(spark, sf):
    return run_resampling(labelled(spark, sf), _count_options(12000)).select("row_key", "class", "origin", "bin")


_RATIOS = f"""{_COUNTS}, ratios AS (SELECT c.class, c.bin, c.n, t.n AS n_target, CASE WHEN c.n <> 0 THEN t.n / c.n::DOUBLE ELSE 0.0::DOUBLE END AS ratio FROM counts c JOIN counts t ON t.bin = c.bin AND t.class = 'TARGET')"""


@query("e03_importance_undersampling", f"""WITH {LAB}, {_RATIOS.replace('TARGET', 'light')},
sc AS (SELECT *, CASE WHEN peak <> 0 THEN n / peak ELSE 0.0::DOUBLE END * ratio AS scaled FROM (SELECT *, max(ratio) OVER (PARTITION BY class) AS peak FROM ratios)),
m AS (SELECT bin, floor(min(scaled))::BIGINT AS m FROM sc GROUP BY bin),
p1 AS (SELECT * FROM (SELECT b.*, m, row_number() OVER (PARTITION BY class, b.bin ORDER BY {_hash_sql('bin')}) AS rn FROM b JOIN m ON m.bin = b.bin) WHERE rn <= m),
p2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_hash_sql('size')}) AS rn2 FROM p1) WHERE rn2 <= 500)
SELECT row_key, class, bin FROM p2""")
def _(spark, sf):
    options = rs.ResamplingOptions("importance", NAMES, AXES, 1500, target_class="light")
    return run_resampling(labelled(spark, sf), options).select("row_key", "class", "bin")


@query("e04_sampling_ratios", f"WITH {LAB}, {_RATIOS.replace('TARGET', 'heavy')} SELECT class, bin, n, n_target, {r('ratio', 9)} AS ratio FROM ratios")
def _(spark, sf):
    counts = rs.bin_counts(binning.with_bins(labelled(spark, sf), AXES), NAMES, BINS)
    return rs.sampling_ratios(counts, "heavy", BINS).withColumn("ratio", rounded("ratio", 9))


@query("e05_bin_weights", f"WITH {LAB}, {_RATIOS.replace('TARGET', 'medium')} SELECT class, bin, {r('ratio', 9)} AS weight FROM ratios")
def _(spark, sf):
    counts = rs.bin_counts(binning.with_bins(labelled(spark, sf), AXES), NAMES, BINS)
    return rs.bin_weights(counts, "medium", BINS).withColumn("weight", rounded("weight", 9))


# ------------------------------------------------------------------------- density

_TARGET = f"""avail AS (SELECT origin, class, count(*) AS n FROM lab GROUP BY ALL),
tgt AS (SELECT origin, n AS available, fraction, floor(k * fraction + 1e-9)::BIGINT AS corrected FROM (SELECT *, min(n / fraction) OVER () AS k FROM (SELECT origin, n, {SHARES_SQL} AS fraction FROM avail WHERE class = 'heavy'))),
numbers AS (SELECT origin, available, fraction, floor(corrected * (ASKED.0::DOUBLE / sum(corrected) OVER ()))::BIGINT AS target FROM tgt)"""
_HISTS = f"""hb AS (SELECT origin, class, bin, count(*) AS n FROM (SELECT *, {BIN_SQL} AS bin FROM lab) WHERE bin IS NOT NULL GROUP BY ALL),
hg AS (SELECT origin, class, bin FROM (SELECT unnest(['F', 'O']) AS origin), (SELECT unnest(['heavy', 'medium', 'light']) AS class), (SELECT unnest(range(0, {BINS}))::INTEGER AS bin)),
hists AS (SELECT g.origin, g.class, g.bin, coalesce(n, 0) AS n FROM hg g LEFT JOIN hb USING (origin, class, bin)),
dr AS (SELECT a.origin, a.class, a.bin, a.n, t.n AS n_target, CASE WHEN a.n <> 0 THEN t.n / a.n::DOUBLE ELSE 0.0::DOUBLE END AS ratio FROM hists a JOIN hists t ON t.origin = a.origin AND t.bin = a.bin AND t.class = 'heavy')"""


def _available(df):
    return df.groupBy("origin", "class").agg(F.count(F.lit(1)).alias("n"))


@query("e06_target_density", f"""WITH {LAB}, {_HISTS}, {_TARGET.replace('ASKED', '30000')}
SELECT h.origin, h.bin, h.n AS n_target, available, target FROM hists h JOIN numbers USING (origin) WHERE class = 'heavy'""")
def _(spark, sf):
    df = labelled(spark, sf)
    target = density.target_of_class(density.sample_histograms(df, ORIGINS, NAMES, AXES), "heavy")
    numbers = density.target_numbers(_available(df), "heavy", SHARES, 30000)
    return target.join(F.broadcast(numbers), "origin").select("origin", "bin", "n_target", "available", "target")


@query("e07_density_ratio", f"""WITH {LAB}, {_HISTS} SELECT origin, class, dr.bin, n, n_target, {r('ratio', 9)} AS ratio,
  {r(f"900.0::DOUBLE + 5250 * (dr.bin // 10) + 2625", 3)} AS x_centre FROM dr""")
def _(spark, sf):
    hists = density.sample_histograms(labelled(spark, sf), ORIGINS, NAMES, AXES)
    ratios = density.density_ratios(hists, density.target_of_class(hists, "heavy"))
    centres = density.bin_centres(spark, AXES).filter("axis = 'price'").select(F.col("bin").alias("ix"), rounded("centre", 3).alias("x_centre"))
    return ratios.withColumn("ratio", rounded("ratio", 9)).withColumn("ix", F.expr("bin div 10").cast("int")).join(
        F.broadcast(centres), "ix").drop("ix")


def _spline(edges) -> tuple[list[float], list[tuple[int, int, int, float]]]:
    """Breaks and (cell, power, bin, coefficient) of the not-a-knot spline through the bin centres.

    Solved for the second derivatives at the centres, apart from the operator's own B-splines.
    """
    e = np.asarray(edges, float)
    c, n = (e[:-1] + e[1:]) / 2, len(e) - 1
    h, unit = np.diff(c), np.eye(n)
    slope = np.diff(unit, axis=0) / h[:, None]
    left, right = np.zeros((n, n)), np.zeros((n, n))
    left[0, :3], left[-1, -3:] = (h[1], -h[0] - h[1], h[0]), (h[-1], -h[-2] - h[-1], h[-2])
    for i in range(1, n - 1):
        left[i, i - 1:i + 2] = h[i - 1] / 6, (h[i - 1] + h[i]) / 3, h[i] / 6
        right[i] = slope[i] - slope[i - 1]
    bend = np.linalg.solve(left, right)
    breaks = [e[0], *c[2:-2], e[-1]]
    table = []
    for cell, (a, b) in enumerate(zip(breaks, breaks[1:])):
        k = cell + 1 if cell else 0
        d, w = a - c[k], b - a
        p0, p1, p2, p3 = unit[k], slope[k] - h[k] * (2 * bend[k] + bend[k + 1]) / 6, bend[k] / 2, (bend[k + 1] - bend[k]) / (6 * h[k])
        powers = (p0 + p1 * d + p2 * d**2 + p3 * d**3, (p1 + 2 * p2 * d + 3 * p3 * d**2) * w, (p2 + 3 * p3 * d) * w**2, p3 * w**3)
        table += [(cell, p, i, float(v[i])) for p, v in enumerate(powers) for i in range(n)]
    return [float(b) for b in breaks], table


def _smooth_sql() -> str:
    """``sm``: rows with the smooth weight, as two small matrix products and a bicubic a row."""
    parts, located = [], []
    for axis, (name, edges) in zip("xy", AXES.items()):
        breaks, table = _spline(edges)
        values = ", ".join(f"({c}, {p}, {i}, {v!r}::DOUBLE)" for c, p, i, v in table)
        parts.append(f"s{axis}(cell, p, bin, coef) AS (VALUES {values})")
        listed = "[" + ", ".join(f"{b!r}::DOUBLE" for b in breaks) + "]"
        held = f"least(greatest({name}, {breaks[0]!r}::DOUBLE), {breaks[-1]!r}::DOUBLE)"
        cell = " + ".join(["0", *[f"({held} >= {b!r}::DOUBLE)::INTEGER" for b in breaks[1:-1]]])
        located.append(f"""l{axis} AS (SELECT *, ({held} - {axis}k[c{axis} + 1]) / ({axis}k[c{axis} + 2] - {axis}k[c{axis} + 1]) AS {axis}u FROM (
  SELECT *, {listed} AS {axis}k, ({cell})::INTEGER AS c{axis} FROM {'lab' if axis == 'x' else 'lx'}))""")
    powers = ", ".join(f"xu ** {p} * yu ** {q}" for p in range(4) for q in range(4))
    return f"""{", ".join(parts)},
half AS (SELECT origin, class, cell AS cx, p, dr.bin % 10 AS j, sum(coef * ratio) AS v FROM dr JOIN sx ON sx.bin = dr.bin // 10 GROUP BY ALL),
both_ AS (SELECT origin, class, cx, half.p, cell AS cy, sy.p AS q, sum(v * coef) AS v FROM half JOIN sy ON sy.bin = j GROUP BY ALL),
pieces AS (SELECT origin, class, cx, cy, list(v ORDER BY p, q) AS coefs FROM both_ GROUP BY ALL),
{", ".join(located)},
sm AS (SELECT ly.row_key, ly.origin, ly.class, ly.event, ly.item_no, ly.label, greatest(list_dot_product(coefs, [{powers}]), 0.0::DOUBLE) AS weight
  FROM ly JOIN pieces USING (origin, class, cx, cy))"""


@query("e08_smooth_weights", f"WITH {LAB}, {_HISTS}, {_smooth_sql()} SELECT row_key, class, {r('weight', 5)} AS weight FROM sm")
def _(spark, sf):
    df = labelled(spark, sf)
    hists = density.sample_histograms(df, ORIGINS, NAMES, AXES)
    ratios = density.density_ratios(hists, density.target_of_class(hists, "heavy"))
    return density.smooth_weights(df, ratios, AXES).select("row_key", "class", rounded("weight", 5).alias("weight"))


def draw_sql(weights: str, numbers: str, seed: int = 42) -> str:
    """Draws dealt to powers of two of the weight, then systematic in each, with global windows."""
    phase = f"{seed % 1000}"
    return f"""de AS (SELECT *, CASE WHEN pow(2.0, e0) > weight * 0.7::DOUBLE THEN e0 - 1 WHEN pow(2.0, e0 + 1) <= weight * 0.7::DOUBLE THEN e0 + 1 ELSE e0 END AS e
  FROM (SELECT *, floor(log2(weight * 0.7::DOUBLE))::INTEGER AS e0 FROM {weights} WHERE weight > 0)),
dw AS (SELECT *, round(weight / pow(2.0, e) * 1048576)::BIGINT AS w FROM de),
ds AS (SELECT origin, class, e, sum(w)::BIGINT AS total, n_draw FROM dw JOIN {numbers} USING (origin, class) GROUP BY ALL),
dm AS (SELECT *, total * pow(2.0, e - max(e) OVER (PARTITION BY origin, class)) AS mass FROM ds),
du AS (SELECT *, floor(n_draw * (sum(mass) OVER (PARTITION BY origin, class ORDER BY e DESC ROWS UNBOUNDED PRECEDING) / sum(mass) OVER (PARTITION BY origin, class)) + {phase} / 1000)::BIGINT AS upto FROM dm),
dn AS (SELECT *, upto - lag(upto, 1, 0) OVER (PARTITION BY origin, class ORDER BY e DESC) AS n_here FROM du),
dc AS (SELECT *, sum(w::HUGEINT) OVER (PARTITION BY origin, class, e ORDER BY md5('{seed}|' || row_key)) AS c FROM dw),
drawn AS (SELECT d.*, (n_here::HUGEINT * c + total::HUGEINT * {phase} // 1000) // total - (n_here::HUGEINT * (c - w) + total::HUGEINT * {phase} // 1000) // total AS multiplicity FROM dc d JOIN dn USING (origin, class, e))"""


_STEP_W = f"sw AS (SELECT l.row_key, l.origin, l.class, l.event, l.item_no, l.label, coalesce(ratio, 0.0::DOUBLE) AS weight FROM (SELECT *, {BIN_SQL} AS bin FROM lab) l LEFT JOIN dr ON dr.origin = l.origin AND dr.class = l.class AND dr.bin = l.bin)"


@query("e09_weighted_draws", f"""WITH {LAB}, {_HISTS}, {_STEP_W}, nd AS (SELECT origin, class, 15000::BIGINT AS n_draw FROM avail2), avail2 AS (SELECT DISTINCT origin, class FROM lab),
{draw_sql('sw', 'nd')} SELECT row_key, multiplicity::BIGINT AS multiplicity FROM drawn WHERE multiplicity > 0""".replace(
    "nd AS (SELECT origin, class, 15000::BIGINT AS n_draw FROM avail2), avail2 AS (SELECT DISTINCT origin, class FROM lab)",
    "nd AS (SELECT DISTINCT origin, class, 15000::BIGINT AS n_draw FROM lab)"))
def _(spark, sf):
    df = labelled(spark, sf)
    hists = cut_lineage(density.sample_histograms(df, ORIGINS, NAMES, AXES))
    ratios = density.density_ratios(hists, density.target_of_class(hists, "heavy"))
    numbers = binning.full_grid(spark, {"origin": ORIGINS, "class": NAMES}, 1).select("origin", "class", F.lit(15000).cast("bigint").alias("n_draw"))
    weighted = density.step_weights(df.select("row_key", "origin", "class", "price", "quantity"), ratios, AXES)
    return density.drawn_keys(weighted, numbers, ["origin", "class"], 6).select("row_key", "multiplicity")


_LIMITS = {("F", "light"): 1.5}
_SAMPLING = {("O", "medium"): 0.5}
_NUMBERS = f"""{_TARGET.replace('ASKED', '30000')},
asked AS (SELECT a.origin, a.class, a.n AS available, fraction, CASE WHEN a.class = 'light' AND a.origin = 'F' AND 1.5 < target / a.n::DOUBLE THEN floor(a.n * 1.5)::BIGINT ELSE target END AS asked FROM avail a JOIN numbers USING (origin)),
fixed AS (SELECT *, CASE WHEN class = 'light' THEN floor(min(asked / fraction) OVER (PARTITION BY class) * fraction + 1e-9)::BIGINT ELSE asked END AS n0 FROM asked),
draws AS (SELECT origin, class, available, asked, floor(n0 * CASE WHEN origin = 'O' AND class = 'medium' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)::BIGINT AS n_draw FROM fixed)"""


@query("e10_numbers_per_sample", f"WITH {LAB}, {_NUMBERS} SELECT * FROM draws")
def _(spark, sf):
    counts = _available(labelled(spark, sf))
    targets = density.target_numbers(counts, "heavy", SHARES, 30000)
    return density.numbers_per_sample(counts, targets, _LIMITS, _SAMPLING)


@query("e11_class_density", f"""WITH {LAB}, {_HISTS} SELECT origin, class, sum(n)::BIGINT AS n, sum(n_target)::BIGINT AS n_target, {r('avg(ratio)', 7)} AS mean_ratio, {r('max(ratio)', 7)} AS peak FROM dr GROUP BY origin, class""")
def _(spark, sf):
    hists = density.sample_histograms(labelled(spark, sf), ORIGINS, NAMES, AXES)
    ratios = density.density_ratios(hists, density.target_of_class(hists, "heavy"))
    return ratios.groupBy("origin", "class").agg(
        F.sum("n").alias("n"), F.sum("n_target").alias("n_target"), rounded(F.avg("ratio"), 7).alias("mean_ratio"), rounded(F.max("ratio"), 7).alias("peak"))


def _pdf_options(**extra):
    return rs.ResamplingOptions("pdf", NAMES, AXES, 30000, SHARES, target_class="heavy", **extra)


@query("e12_density_resampling", f"""WITH {LAB}, {_HISTS}, {_STEP_W}, {_NUMBERS}, {draw_sql('sw', 'draws')}
SELECT row_key, origin, class, unnest(range(1, multiplicity::BIGINT + 1)) AS copy FROM drawn WHERE multiplicity > 0""")
def _(spark, sf):
    return pdf_resample(
        labelled(spark, sf), _pdf_options(), ORIGINS, smooth=False, max_upsampling=_LIMITS, sampling_fraction=_SAMPLING,
    ).select("row_key", "origin", "class", "copy")


@query("e12_smooth_resampling", f"""WITH {LAB}, {_HISTS}, {_smooth_sql()}, {_NUMBERS}, {draw_sql('sm', 'draws')}
SELECT row_key, origin, class, unnest(range(1, multiplicity::BIGINT + 1)) AS copy FROM drawn WHERE multiplicity > 0""")
def _(spark, sf):
    return pdf_resample(
        labelled(spark, sf), _pdf_options(), ORIGINS, max_upsampling=_LIMITS, sampling_fraction=_SAMPLING,
    ).select("row_key", "origin", "class", "copy")


@query("e13_combine_samples", f"""WITH {LAB}, {_HISTS}, {_STEP_W}, {_NUMBERS}, {draw_sql('sw', 'draws')},
cp AS (SELECT row_key, label, unnest(range(1, multiplicity::BIGINT + 1)) AS copy FROM drawn WHERE multiplicity > 0)
SELECT row_key, label, copy, row_number() OVER (ORDER BY md5('5|' || row_key || '|' || copy)) - 1 AS position FROM cp""")
def _(spark, sf):
    drawn = pdf_resample(
        labelled(spark, sf), _pdf_options(), ORIGINS, smooth=False, max_upsampling=_LIMITS, sampling_fraction=_SAMPLING)
    keyed = drawn.select("row_key", "label", "copy", F.concat_ws("|", "row_key", F.col("copy").cast("string")).alias("copy_key"))
    # the drawn rows are written, as the shuffle reads them twice
    return features.in_random_order(cut_lineage(keyed), "copy_key", 5).drop("copy_key")


@query("e14_initial_caps", f"""WITH {LAB}, n AS (SELECT *, row_number() OVER (PARTITION BY origin, class ORDER BY md5('42|' || row_key)) AS rn FROM lab)
SELECT row_key, origin, class FROM n WHERE rn <= CASE WHEN class = 'light' THEN 3000 ELSE 5000 END""")
def _(spark, sf):
    caps = binning.full_grid(spark, {"origin": ORIGINS, "class": NAMES}, 1).select(
        "origin", "class", F.when(F.col("class") == "light", 3000).otherwise(5000).cast("bigint").alias("limit"))
    return rs.cap_samples(labelled(spark, sf), ["origin", "class"], caps, 6).select("row_key", "origin", "class")


@query("e15_final_size", f"""WITH {LAB}, n AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_hash_sql('size')}) AS rn FROM lab)
SELECT class, count(*) AS n, min(row_key) AS first_key, max(row_key) AS last_key FROM n WHERE rn <= {20000 // 3} GROUP BY class""")
def _(spark, sf):
    return rs.cap_classes(labelled(spark, sf), _count_options(20000)).groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"))


@query("e15_size_report", f"""WITH {LAB}, {count_sql('lab', 600000)}, {_RATIOS.replace('TARGET', 'light')},
sc AS (SELECT *, CASE WHEN peak <> 0 THEN n / peak ELSE 0.0::DOUBLE END * ratio AS scaled FROM (SELECT *, max(ratio) OVER (PARTITION BY class) AS peak FROM ratios)),
im AS (SELECT sum(m)::BIGINT AS n FROM (SELECT bin, floor(min(scaled))::BIGINT AS m FROM sc GROUP BY bin))
SELECT 'count' AS method, class, 200000::BIGINT AS requested, count(*) AS available, least(count(*), 200000)::BIGINT AS taken FROM c2 GROUP BY class
UNION ALL SELECT 'importance', class, 100::BIGINT, n, least(n, 100)::BIGINT FROM im, (SELECT unnest(['heavy', 'medium', 'light']) AS class)""")
def _(spark, sf):
    df = labelled(spark, sf)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        counted = rs.count_undersample_reported(df, _count_options(600000)).report
    weighed = rs.importance_undersample_reported(df, rs.ResamplingOptions("importance", NAMES, AXES, 300, target_class="light")).report
    return counted.withColumn("method", F.lit("count")).unionByName(weighed.withColumn("method", F.lit("importance")))


@query("e16_validation_resampling", f"WITH {LAB}, v AS (SELECT * FROM lab WHERE event % 10 = 8), {count_sql('v', 900)} SELECT row_key, class, origin, bin FROM picked")
def _(spark, sf):
    options = _count_options(900, split="validation")
    return run_resampling(tag_split(labelled(spark, sf), "event"), options).select("row_key", "class", "origin", "bin")


@query("e17_shuffles", f"""WITH {LAB}, a AS (SELECT row_key, row_number() OVER (ORDER BY md5('9|' || row_key)) - 1 AS position, row_number() OVER (ORDER BY row_key) - 1 AS ordinal FROM lab)
SELECT row_key, position, row_number() OVER (ORDER BY md5('9|' || (ordinal // 1000)) || md5('9|' || row_key)) - 1 AS block_position FROM a""")
def _(spark, sf):
    df = labelled(spark, sf).select("row_key")
    blocks = cut_lineage(features.in_block_order(df, "row_key", 9, 1000, "block_position"))
    return features.in_random_order(blocks, "row_key", 9).select("row_key", "position", "block_position")


@query("e18_custom_density", f"""WITH {LAB}, {_HISTS}, f AS (SELECT origin, class, bin, n,
  exp(-(900.0::DOUBLE + 5250 * (bin // 10) + 2625) / 40000.0) * (1.0::DOUBLE + 4.9 * (bin % 10) + 2.45) AS d FROM dr)
SELECT origin, class, bin, n, {r('CASE WHEN n <> 0 THEN d / n ELSE 0.0::DOUBLE END', 9)} AS ratio FROM f""")
def _(spark, sf):
    target = density.target_of_function(spark, AXES, ORIGINS, lambda x, y: F.exp(-x / 40000.0) * y)
    hists = density.sample_histograms(labelled(spark, sf), ORIGINS, NAMES, AXES)
    return density.density_ratios(hists, target).select("origin", "class", "bin", "n", rounded("ratio", 9).alias("ratio"))


@query("e19_weighting_run", f"""WITH {LAB}, {_RATIOS.replace('TARGET', 'heavy')}
SELECT l.row_key, l.class, {r('coalesce(nullif(ratio, 0), 1)', 9)} AS weight FROM (SELECT *, {BIN_SQL} AS bin FROM lab) l LEFT JOIN ratios ON ratios.class = l.class AND ratios.bin = l.bin""")
def _(spark, sf):
    options = rs.ResamplingOptions("weighting", NAMES, AXES, target_class="heavy")
    return run_resampling(labelled(spark, sf), options).select("row_key", "class", rounded("weight", 9).alias("weight"))
