"""D: bins, histograms and descriptive aggregates."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from evenkeel.functions.numeric import derived, missing_to, safe_divide
from evenkeel.operators import binning, histograms as h
from evenkeel.operators.resampling import bin_counts
from evenkeel.queries.base import (
    BASE, ITEMS, LAB, NAMES, ORIGINS, labelled, r, records, rounded, rows, sql_bin, sql_list, table,
)
from evenkeel.queries.merge_queries import AXES, BINS, BIN_SQL
from evenkeel.queries.registry import query
from evenkeel.session import cut_lineage

PRICE = AXES["price"]
PIECES = [[0, 20000, 11], [30000, 90000, 7], [90000, 105000, 4]]
PIECE_EDGES = [float(lo + (hi - lo) * i / (n - 1)) for lo, hi, n in PIECES for i in range(n)]


def _grid_sql(edges) -> str:
    return f"SELECT unnest(range(0, {len(edges) - 1}))::INTEGER AS bin, unnest({sql_list(edges[:-1])}) AS lo, unnest({sql_list(edges[1:])}) AS hi"


@query("d01_joined_edges", f"""WITH {BASE}, g AS ({_grid_sql(PIECE_EDGES)}), b AS (SELECT {sql_bin('price', PIECE_EDGES)} AS bin FROM base),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT g.bin, {r("lo", 3)} AS lo, {r("hi", 3)} AS hi, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (bin)""")
def _(spark, sf):
    edges = binning.linspace_edges(PIECES)
    counts = binning.with_bins(rows(spark, sf), {"price": edges}).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return binning.edge_table(spark, edges).join(F.broadcast(counts), "bin", "left").select(
        "bin", rounded("lo", 3).alias("lo"), rounded("hi", 3).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


NUMBER_EDGES = [i - 0.5 for i in range(0, 8)]


@query("d02_step_edges", f"""WITH {BASE},
a AS (SELECT 'number_item' AS variable, {sql_bin('item_no', NUMBER_EDGES)} AS bin FROM base UNION ALL
  SELECT 'quantity', {sql_bin('quantity', [float(x) for x in range(0, 50, 5)])} FROM base UNION ALL
  SELECT 'tax', CASE WHEN tax = hi THEN 99 ELSE len(list_filter(list_transform(range(0, 100), lambda i: i * ((hi - lo) / 100.0::DOUBLE) + lo), lambda e: e <= tax)) - 1 END::INTEGER
  FROM base, (SELECT min(tax) AS lo, max(tax) AS hi FROM base))
SELECT variable, bin, count(*) AS n FROM a WHERE bin IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    df = rows(spark, sf).withColumnRenamed("item_no", "number_item")
    lo, hi = df.agg(F.min("tax"), F.max("tax")).first()
    edges = {
        "number_item": binning.step_edges([0, 8, 1], "number_item"),
        "quantity": binning.step_edges([0, 50, 5], "quantity"),
        "tax": binning.step_edges(None, "tax", lo, hi),
    }
    entries = F.array(*[
        F.struct(F.lit(v).alias("variable"), binning.bin_number(F.col(v), e).alias("bin")) for v, e in edges.items()
    ])
    return df.select(F.inline(entries)).filter("bin IS NOT NULL").groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))


@query("d03_bin_number", f"WITH {BASE}, b AS (SELECT row_key, {BIN_SQL} AS bin, {sql_bin('price', PIECE_EDGES)} AS piece_bin FROM base) SELECT * FROM b")
def _(spark, sf):
    return rows(spark, sf).select(
        "row_key", binning.flat_bin(AXES).alias("bin"), binning.bin_number(F.col("price"), PIECE_EDGES).alias("piece_bin"))


_COUNTS = f"""b AS (SELECT *, {BIN_SQL} AS bin FROM lab), grid AS (SELECT class, bin FROM (SELECT unnest(['heavy', 'medium', 'light']) AS class), (SELECT unnest(range(0, {BINS}))::INTEGER AS bin)),
counts AS (SELECT g.class, g.bin, count(b.row_key) AS n FROM grid g LEFT JOIN b ON b.class = g.class AND b.bin = g.bin GROUP BY ALL)"""


@query("d04_bin_counts", f"WITH {LAB}, {_COUNTS} SELECT * FROM counts")
def _(spark, sf):
    return bin_counts(binning.with_bins(labelled(spark, sf), AXES), NAMES, BINS)


@query("d05_histogram_2d", f"""WITH {BASE}, b AS (SELECT {sql_bin('price', [5000.0 + 5000 * i for i in range(13)])} AS x, {sql_bin('quantity', [5.0 + 5 * i for i in range(9)])} AS y FROM base)
SELECT x AS bin_x, y AS bin_y, count(*) AS n FROM b WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    xs, ys = [5000.0 + 5000 * i for i in range(13)], [5.0 + 5 * i for i in range(9)]
    flat = binning.with_bins(rows(spark, sf), {"price": xs, "quantity": ys}).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return flat.select((F.col("bin") / 8).cast("int").alias("bin_x"), (F.col("bin") % 8).alias("bin_y"), "n")


NARROW = [10000.0 + 4000 * i for i in range(21)]


def _hist_sql(source: str, value: str, edges, keys: dict[str, list], name: str) -> str:
    """Histogram CTE with uncertainty, normalised by all entries of the key."""
    names = "".join(f"{k}, " for k in keys)
    lists = ", ".join(f"(SELECT unnest({v!r}) AS {k})" for k, v in keys.items())
    on = " AND ".join([f"c.{k} = g.{k}" for k in keys] + ["c.bin = g.bin"])
    total = " AND ".join(f"t.{k} = g.{k}" for k in keys) or "true"
    gnames = "".join(f"g.{k}, " for k in keys)
    group = f"GROUP BY {names[:-2]}" if keys else ""
    return f"""{name}_b AS (SELECT {names}{sql_bin(value, edges)} AS bin FROM {source}),
{name}_g AS (SELECT {names}bin FROM {lists + ', ' if keys else ''}(SELECT unnest(range(0, {len(edges) - 1}))::INTEGER AS bin)),
{name}_c AS (SELECT {names}bin, count(*) AS c FROM {name}_b GROUP BY ALL), {name}_t AS (SELECT {names}count(*) AS t FROM {name}_b {group}),
{name} AS (SELECT {gnames}g.bin, coalesce(c, 0) AS count, coalesce(c, 0) / t::DOUBLE AS hist, sqrt(coalesce(c, 0)) / t AS unc,
  coalesce(c, 0) / t::DOUBLE - sqrt(coalesce(c, 0)) / t AS band FROM {name}_g g LEFT JOIN {name}_c c ON {on} LEFT JOIN {name}_t t ON {total})"""


def _out(df, *names, digits: int = 9):
    return df.select(*[c for c in df.columns if c not in names], *[rounded(n, digits).alias(n) for n in names])


@query("d06_histogram_1d", f"""WITH {BASE}, {_hist_sql('base', 'price', NARROW, {'origin': ORIGINS}, 'h')}
SELECT origin, bin, count, {r("hist", 9)} AS hist, {r("unc", 9)} AS unc, {r("band", 9)} AS band FROM h""")
def _(spark, sf):
    return _out(h.histogram(rows(spark, sf), F.col("price"), NARROW, {"origin": ORIGINS}), "hist", "unc", "band")


@query("d07_histogram_ratio", f"""WITH {BASE}, {_hist_sql('base', 'price', NARROW, {'origin': ORIGINS}, 'h')},
j AS (SELECT a.bin, CASE WHEN b.hist <> 0 THEN a.hist / b.hist ELSE 1.0::DOUBLE END AS ratio,
  sqrt((CASE WHEN a.hist <> 0 THEN a.unc / a.hist ELSE 0.0::DOUBLE END) ** 2 + (CASE WHEN b.hist <> 0 THEN b.unc / b.hist ELSE 0.0::DOUBLE END) ** 2) AS rel
  FROM h a JOIN h b USING (bin) WHERE a.origin = 'F' AND b.origin = 'O'),
s AS (SELECT bin, ratio, rel FROM j UNION ALL SELECT -1, ratio, rel FROM j WHERE bin = 0)
SELECT bin, {r("ratio", 9)} AS ratio, {r("ratio * rel", 9)} AS ratio_unc FROM s""")
def _(spark, sf):
    hist = h.histogram(rows(spark, sf), F.col("price"), NARROW, {"origin": ORIGINS})
    return _out(h.histogram_ratio(hist.filter("origin = 'F'"), hist.filter("origin = 'O'"), ["bin"]), "ratio", "ratio_unc")


@query("d08_safe_divide", f"WITH {BASE} SELECT row_key, {r('CASE WHEN tax <> 0 THEN discount / tax ELSE 1.0::DOUBLE END')} AS ratio, {r('CASE WHEN discount <> 0 THEN price / discount ELSE -1.0::DOUBLE END', 3)} AS other FROM base")
def _(spark, sf):
    return rows(spark, sf).select(
        "row_key", rounded(safe_divide(F.col("discount"), F.col("tax"))).alias("ratio"),
        rounded(safe_divide(F.col("price"), F.col("discount"), -1.0), 3).alias("other"))


K_EDGES = [0.5 * i for i in range(211)]


@query("d09_before_resampling", f"""WITH {LAB}, v AS (SELECT origin, class, 'price' AS variable, {sql_bin('price / 1000', K_EDGES)} AS bin FROM lab
UNION ALL SELECT origin, class, 'quantity', {sql_bin('quantity', AXES['quantity'])} FROM lab)
SELECT origin, class, variable, bin, count(*) AS count FROM v WHERE bin IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    out = h.variable_histograms(labelled(spark, sf), {"origin": ORIGINS, "class": NAMES}, {
        "price": (F.col("price") / 1000, K_EDGES), "quantity": (F.col("quantity"), AXES["quantity"])}, normed=False)
    return out.filter("count > 0").select("origin", "class", "variable", "bin", "count")


M_EDGES = [-0.005 + 0.01 * i for i in range(13)]
_ITEM_CLASSES = [0, 1, 2]


@query("d10_variables_per_class", f"""WITH {ITEMS}, rowvals AS (
  SELECT label, unnest(['total']) AS variable, {sql_bin('total', [0.0, 100000.0, 200000.0, 300000.0, 400000.0, 500000.0])} AS bin FROM ord),
itemvals AS (SELECT label, 'item_quantity' AS variable, {sql_bin('quantity', AXES['quantity'])} AS bin FROM oi
  UNION ALL SELECT label, 'item_frac', {sql_bin('CASE WHEN isnan(frac) THEN 0.0::DOUBLE ELSE frac END', M_EDGES)} FROM oi),
u AS (SELECT * FROM rowvals UNION ALL SELECT * FROM itemvals), t AS (SELECT label, variable, count(*) AS t FROM u GROUP BY ALL),
c AS (SELECT label, variable, bin, count(*) AS count FROM u WHERE bin IS NOT NULL GROUP BY ALL)
SELECT c.label, c.variable, c.bin, c.count, {r("c.count / t.t::DOUBLE", 9)} AS hist FROM c JOIN t USING (label, variable)""")
def _(spark, sf):
    df = records(spark, sf)
    by_row = h.variable_histograms(df, {"label": _ITEM_CLASSES}, {
        "total": (F.col("total"), [0.0, 100000.0, 200000.0, 300000.0, 400000.0, 500000.0])})
    items = df.select("label", F.inline("items"))
    by_item = h.variable_histograms(items, {"label": _ITEM_CLASSES}, {
        "item_quantity": (F.col("quantity"), AXES["quantity"]), "item_frac": (F.col("frac"), M_EDGES)})
    return by_row.unionByName(by_item).filter("count > 0").select(
        "label", "variable", "bin", "count", rounded("hist", 9).alias("hist"))


S_EDGES = [-0.0051 + 0.01 * i for i in range(20)]


@query("d11_input_variables", f"""WITH {LAB}, v AS (SELECT origin, class, CASE WHEN isnan(mass) THEN 0.0::DOUBLE ELSE mass END + tax AS s FROM lab WHERE NOT (isnan(mass) AND isnan(tax))),
{_hist_sql('v', 's', S_EDGES, {'origin': ORIGINS, 'class': NAMES}, 'h')}
SELECT a.origin, a.class, a.bin, a.count, {r("a.hist", 9)} AS hist, {r("CASE WHEN b.hist <> 0 THEN a.hist / b.hist ELSE 1.0::DOUBLE END", 9)} AS ratio,
  {r("CASE WHEN b.hist <> 0 THEN a.hist / b.hist ELSE 1.0::DOUBLE END * sqrt(CASE WHEN a.hist <> 0 THEN (a.unc / a.hist) ** 2 ELSE 0.0::DOUBLE END + CASE WHEN b.hist <> 0 THEN (b.unc / b.hist) ** 2 ELSE 0.0::DOUBLE END)", 9)} AS ratio_unc FROM h a JOIN h b ON b.origin = 'F' AND b.class = a.class AND b.bin = a.bin""")
def _(spark, sf):
    value, present = derived(["mass", "tax"], "+")
    # the histograms are small and used three times
    hist = cut_lineage(h.histogram(labelled(spark, sf).filter(present), value, S_EDGES, {"origin": ORIGINS, "class": NAMES}))
    each = F.explode(F.array(*[F.lit(o) for o in ORIGINS])).alias("origin")
    first = hist.filter("origin = 'F'").select(each, "class", "bin", "hist", "unc")
    ratio = h.histogram_ratio(hist, first, ["origin", "class", "bin"], step=True).filter("bin >= 0")
    return hist.join(ratio, ["origin", "class", "bin"]).select(
        "origin", "class", "bin", "count", rounded("hist", 9).alias("hist"), rounded("ratio", 9).alias("ratio"),
        rounded("ratio_unc", 9).alias("ratio_unc"))


@query("d12_items_per_row", f"""WITH {ITEMS}, n AS (SELECT o.event, o.label, count(i.event) FILTER (NOT isnan(i.frac)) AS n_items,
  count(i.event) FILTER (NOT isnan(i.frac) AND kind IN (0, 1)) AS n_some FROM ord o LEFT JOIN it i USING (event) GROUP BY ALL)
SELECT label, n_items::INTEGER AS n_items, count(*) AS n, {r("avg(avg(n_items)) OVER (PARTITION BY label)", 0)} AS unused, sum(n_some)::BIGINT AS some_items FROM n GROUP BY label, n_items""".replace(
    f"{r('avg(avg(n_items)) OVER (PARTITION BY label)', 0)} AS unused", f"{r('sum(sum(n_items)) OVER (PARTITION BY label) / sum(count(*)) OVER (PARTITION BY label)', 9)} AS mean_items"))
def _(spark, sf):
    df = records(spark, sf)
    counted = df.select("label", h.real_items(F.col("items"), "frac").alias("n_items"), h.real_items(F.col("items"), "frac", "kind", [0, 1]).alias("n_some"))
    # one scan: the means follow from the small table of counts
    table_ = cut_lineage(counted.groupBy("label", "n_items").agg(F.count(F.lit(1)).alias("n"), F.sum("n_some").alias("some_items")))
    mean = table_.groupBy("label").agg((F.sum(F.col("n_items") * F.col("n")) / F.sum("n")).alias("mean_items"))
    return table_.join(F.broadcast(mean), "label").withColumn("mean_items", rounded("mean_items", 9))


@query("d13_leading_items", f"""WITH {ITEMS}, s AS (SELECT label, kind, price, frac, row_number() OVER (PARTITION BY event ORDER BY isnan(frac), frac DESC, price DESC, pos) - 1 AS lead FROM oi),
u AS (SELECT label, lead, kind, {sql_bin('ln(frac + 0.01)', [-5.0 + 0.25 * i for i in range(17)])} AS bin, count(*) AS n, {r("avg(frac)", 9)} AS mean_frac FROM s WHERE lead IN (0, 2) AND NOT isnan(frac) GROUP BY ALL)
SELECT label, lead::INTEGER AS lead, sum(n)::BIGINT AS n, {r("sum(mean_frac * n) / sum(n)")} AS mean_frac FROM u GROUP BY label, lead""")
def _(spark, sf):
    df = records(spark, sf)
    edges = [-5.0 + 0.25 * i for i in range(17)]

    def leading(n):
        return F.transform(h.nth_item(F.col("items"), "frac", n), lambda x: F.struct(F.lit(n).alias("lead"), x.alias("i")))

    picked = F.concat(leading(0), leading(2))
    long = df.select("label", F.inline(picked)).filter(~F.isnan("i.frac"))
    binned = long.select("label", "lead", "i.kind", "i.frac", binning.bin_number(F.ln(F.col("frac") + 0.01), edges).alias("bin"))
    cells = binned.groupBy("label", "lead", "kind", "bin").agg(F.count(F.lit(1)).alias("c"), F.sum("frac").alias("f"))
    return cells.groupBy("label", "lead").agg(F.sum("c").alias("n"), rounded(F.sum("f") / F.sum("c")).alias("mean_frac"))


_LEAD_EDGES = [-5.0 + 0.25 * i for i in range(17)]


@query("d13_item_histograms", f"""WITH {ITEMS}, s AS (SELECT label, kind, frac, row_number() OVER (PARTITION BY event ORDER BY isnan(frac), frac DESC, pos) - 1 AS lead FROM oi),
u AS (SELECT label, kind, frac, unnest([-1, lead]) AS lead FROM s WHERE NOT isnan(frac)),
k AS (SELECT *, {sql_bin('ln(frac + 0.01)', _LEAD_EDGES)} AS bin FROM u WHERE lead IN (-1, 0, 1))
SELECT label, lead::INTEGER AS lead, kind, bin, count(*) AS n, {r("avg(frac)", 9)} AS mean_frac FROM k WHERE bin IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    df = records(spark, sf)
    # the leading and the second item by frac, and (-1) all items; per class and kind, of a logarithm
    def leading(n):
        place = F.lit(-1 if n is None else n).alias("lead")
        return F.transform(h.nth_item(F.col("items"), "frac", n), lambda x: F.struct(place, x["kind"].alias("kind"), x["frac"].alias("frac")))

    picked = F.concat(*[leading(n) for n in (None, 0, 1)])
    long = df.select("label", F.inline(picked)).filter(~F.isnan("frac"))
    binned = long.withColumn("bin", binning.bin_number(F.ln(F.col("frac") + 0.01), _LEAD_EDGES)).filter("bin IS NOT NULL")
    return binned.groupBy("label", "lead", "kind", "bin").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("frac"), 9).alias("mean_frac"))


@query("d14_copies", f"""WITH {LAB}, k AS (SELECT class, event, item_no, count(*) AS copies FROM lab GROUP BY ALL)
SELECT class, copies, count(*) AS records, copies * count(*) AS total FROM k GROUP BY class, copies""")
def _(spark, sf):
    return h.copies_histogram(labelled(spark, sf), ["event", "item_no"])


@query("d15_correlations", f"""WITH {BASE}, c AS (SELECT corr(price, quantity) AS pq, corr(price, tax) AS pt, corr(quantity, tax) AS qt,
 corr(price, mass) FILTER (NOT isnan(mass)) AS pm, corr(quantity, mass) FILTER (NOT isnan(mass)) AS qm, corr(tax, mass) FILTER (NOT isnan(mass)) AS tm FROM base)
SELECT unnest(['price', 'price', 'quantity', 'quantity', 'tax', 'tax', 'price', 'quantity', 'tax', 'mass', 'price', 'quantity', 'tax', 'mass', 'mass', 'mass']) AS var_x,
 unnest(['quantity', 'tax', 'tax', 'price', 'price', 'quantity', 'price', 'quantity', 'tax', 'mass', 'mass', 'mass', 'mass', 'price', 'quantity', 'tax']) AS var_y,
 round(unnest([pq, pt, qt, pq, pt, qt, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, pm, qm, tm, pm, qm, tm]), 8) + 0.0 AS corr FROM c""")
def _(spark, sf):
    return _out(h.correlations(rows(spark, sf), ["price", "quantity", "tax", "mass"]), "corr", digits=8)


@query("d16_outliers", f"""WITH {BASE}, w AS (SELECT * FROM base WHERE NOT isnan(mass)),
s AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(mass) AS mm, stddev_pop(mass) AS sm FROM w)
SELECT row_key, price, mass FROM w, s WHERE abs(price - mp) < 1.5 * sp AND abs(mass - mm) < 1.5 * sm""")
def _(spark, sf):
    return h.drop_outliers(rows(spark, sf), ["price", "mass"], 1.5).select("row_key", "price", "mass")


_PAIR = {"price": [0.0 + 10500 * i for i in range(11)], "quantity": AXES["quantity"], "tax": [-0.005 + 0.01 * i for i in range(10)]}
_PAIR_SQL = " UNION ALL ".join(
    f"SELECT class, '{a}' AS var_x, '{b}' AS var_y, {sql_bin(a, _PAIR[a])} AS bin_x, {sql_bin(b, _PAIR[b])} AS bin_y FROM lab"
    for a, b in (("price", "quantity"), ("price", "tax"), ("quantity", "tax")))


@query("d17_pair_densities", f"WITH {LAB}, u AS ({_PAIR_SQL}) SELECT *, count(*) AS n FROM u WHERE bin_x IS NOT NULL AND bin_y IS NOT NULL GROUP BY ALL")
def _(spark, sf):
    return h.pair_densities(labelled(spark, sf), _PAIR)


@query("d18_duplicates", f"WITH {BASE}, c AS (SELECT event, item_no, count(*) AS c FROM base GROUP BY ALL) SELECT max(c) > 1 AS has_duplicates, sum(c - 1)::BIGINT AS surplus FROM c")
def _(spark, sf):
    return h.has_duplicates(rows(spark, sf), ["event", "item_no"])
