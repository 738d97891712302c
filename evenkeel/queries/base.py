"""The labelled records all queries use, derived from the given tables.

Every definition exists twice: as DataFrame code and as SQL common table expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.keys import row_key
from evenkeel.functions.numeric import INF, NAN
from evenkeel.operators.evaluation import Classifier
from evenkeel.operators.items import nest_items
from evenkeel.operators.labels import ClassDef, label_classes
from evenkeel.session import new_place

CLASSES = (
    ClassDef("heavy", ({"truth": {"operator": "==", "condition": 5}},), "ph"),
    ClassDef("medium", ({"truth": {"operator": "==", "condition": 4}},), "pm"),
    ClassDef("light", (
        {"truth": {"operator": "==", "condition": 0}}, {"quantity": {"operator": "<", "condition": 20}},
    ), "pl"),
)
NAMES = [c.name for c in CLASSES]
ORIGINS = ["F", "O"]
MAIN = ["heavy"]
SUFFIXES = {c.name: c.suffix for c in CLASSES}
NET = Classifier("net", SUFFIXES, {"medium": 0.3, "light": 0.7})
TREE = Classifier("tree", SUFFIXES, {"medium": 0.2, "light": 0.8})


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rows(spark: SparkSession, sf: str) -> DataFrame:
    return rows_of(table(spark, sf, "lineitem"))


def rows_of(lineitem: DataFrame) -> DataFrame:
    """lineitem as labelled records; -0.0 becomes 0.0, some values go missing.

    Quantity and price are complete, so cuts on them may reach the reader.
    """
    c = F.col
    return lineitem.select(
        row_key(c("l_orderkey"), c("l_partkey"), c("l_suppkey"), c("l_linenumber"), F.unix_date(F.to_date("l_shipdate"))).alias("row_key"),
        c("l_orderkey").alias("event"), c("l_linenumber").alias("item_no"), c("l_linestatus").alias("origin"),
        F.when(c("l_returnflag") == "A", 5).when(c("l_returnflag") == "N", 4).otherwise(0).alias("truth"),
        c("l_quantity").alias("quantity"), c("l_extendedprice").alias("price"),
        (c("l_discount") + 0.0).alias("discount"), (c("l_tax") + 0.0).alias("tax"),
        F.when(c("l_linenumber") == 7, F.lit(NAN)).otherwise(c("l_discount") + 0.0).alias("mass"),
        F.when(c("l_linenumber") == 6, F.lit(INF)).otherwise(c("l_tax") + 0.0).alias("energy"),
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return label_classes(rows(spark, sf), CLASSES)


def _shares(prefix: str, parts: dict[str, Column]) -> dict[str, Column]:
    total = parts["ph"] + parts["pm"] + parts["pl"]
    return {f"{prefix}_{k}": v / total for k, v in parts.items()}


def with_probabilities(df: DataFrame) -> DataFrame:
    """Closed-form class probabilities of two classifiers."""
    c = F.col

    def bonus(truth: int, amount: float) -> Column:
        return F.when(c("truth") == truth, amount).otherwise(0.0)

    net = {
        "ph": 0.5 + 0.02 * c("quantity") + bonus(5, 0.3),
        "pm": 0.5 + 0.00001 * c("price") + bonus(4, 0.2),
        "pl": 0.5 + 5.0 * c("tax") + bonus(0, 0.3),
    }
    tree = {
        "ph": 0.4 + 3.0 * c("discount") + bonus(5, 0.5),
        "pm": 0.6 + 0.01 * c("quantity") + bonus(4, 0.4),
        "pl": 0.5 + 0.000004 * c("price") + bonus(0, 0.5),
    }
    return df.withColumns({**_shares("net", net), **_shares("tree", tree)})


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return with_probabilities(labelled(spark, sf))


ITEM_FIELDS = ["item_no", "quantity", "price", "discount", "tax", "frac", "kind", "valid"]


def records(spark: SparkSession, sf: str, fields: Sequence[str] = ITEM_FIELDS) -> DataFrame:
    """Orders as rows, their line items as a nested array of ``fields``; others are not shuffled."""
    flat = rows(spark, sf).select(
        "event", "item_no", F.unhex("row_key").alias("tie"), "quantity", "price", "discount", "tax",
        F.col("mass").alias("frac"), F.when(F.col("truth") == 5, 0).when(F.col("truth") == 4, 1).otherwise(2).alias("kind"),
        F.lit(True).alias("valid"),
    )
    # the bytes of a key order as its digits do, in half the room
    nested = nest_items(flat, "event", ["item_no", "tie"], fields)
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status"),
        (F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("o_orderstatus")) - 1).cast("int").alias("label"),
    )
    empty = F.filter("items", lambda x: F.lit(False))
    return orders.join(nested, "event", "left").withColumn("items", F.coalesce("items", F.array().cast(nested.schema["items"].dataType)))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table."""
    return new_place(spark, name)


# ------------------------------------------------------------------------- SQL side

BASE = """base AS (SELECT
  md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate::DATE - DATE '1970-01-01')) AS row_key,
  l_orderkey AS event, l_linenumber AS item_no, l_linestatus AS origin,
  CASE l_returnflag WHEN 'A' THEN 5 WHEN 'N' THEN 4 ELSE 0 END AS truth,
  l_quantity + 0.0 AS quantity, l_extendedprice + 0.0 AS price, l_discount + 0.0 AS discount, l_tax + 0.0 AS tax,
  CASE WHEN l_linenumber = 7 THEN 'NaN'::DOUBLE ELSE l_discount + 0.0 END AS mass,
  CASE WHEN l_linenumber = 6 THEN 'Infinity'::DOUBLE ELSE l_tax + 0.0 END AS energy
  FROM lineitem)"""

LAB = BASE + """, lab AS (SELECT *, CASE label WHEN 0 THEN 'heavy' WHEN 1 THEN 'medium' ELSE 'light' END AS class FROM (
  SELECT *, CASE WHEN truth = 0 AND quantity < 20 THEN 2 WHEN truth = 4 THEN 1 WHEN truth = 5 THEN 0 END AS label FROM base)
  WHERE label IS NOT NULL)"""

PROBS = LAB + """, raw AS (SELECT *,
  0.5 + 0.02 * quantity + CASE WHEN truth = 5 THEN 0.3 ELSE 0.0 END AS nh,
  0.5 + 0.00001 * price + CASE WHEN truth = 4 THEN 0.2 ELSE 0.0 END AS nm,
  0.5 + 5.0 * tax + CASE WHEN truth = 0 THEN 0.3 ELSE 0.0 END AS nl,
  0.4 + 3.0 * discount + CASE WHEN truth = 5 THEN 0.5 ELSE 0.0 END AS th,
  0.6 + 0.01 * quantity + CASE WHEN truth = 4 THEN 0.4 ELSE 0.0 END AS tm,
  0.5 + 0.000004 * price + CASE WHEN truth = 0 THEN 0.5 ELSE 0.0 END AS tl FROM lab),
probs AS (SELECT *, nh / (nh + nm + nl) AS net_ph, nm / (nh + nm + nl) AS net_pm, nl / (nh + nm + nl) AS net_pl,
  th / (th + tm + tl) AS tree_ph, tm / (th + tm + tl) AS tree_pm, tl / (th + tm + tl) AS tree_pl FROM raw)"""

NET_SCORE = "ln((net_ph + 1e-10) / (0.3 * net_pm + 0.7 * net_pl + 1e-10))"
TREE_SCORE = "ln((tree_ph + 1e-10) / (0.2 * tree_pm + 0.8 * tree_pl + 1e-10))"

SCORES = PROBS + f""", scores AS (
  SELECT *, 'net' AS classifier, {NET_SCORE} AS score FROM probs
  UNION ALL SELECT *, 'tree' AS classifier, {TREE_SCORE} AS score FROM probs)"""

ITEMS = BASE + """, it AS (SELECT b.event, row_number() OVER (PARTITION BY b.event ORDER BY b.item_no, b.row_key) AS pos,
  b.item_no, b.row_key, b.quantity, b.price, b.discount, b.tax, b.mass AS frac,
  CASE WHEN b.truth = 5 THEN 0 WHEN b.truth = 4 THEN 1 ELSE 2 END AS kind FROM base b),
ord AS (SELECT o_orderkey AS event, o_totalprice AS total, o_orderstatus AS status,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label FROM orders),
oi AS (SELECT it.*, total, status, label FROM it JOIN ord USING (event))"""


def r(expr: str, digits: int = 6) -> str:
    """Rounded, with -0.0 turned into 0.0."""
    return f"(round({expr}, {digits}) + 0.0)"


def rounded(x, digits: int = 6) -> Column:
    return F.round(x, digits)


REJECTION = r("CASE WHEN n_pass > 0 THEN 1.0::DOUBLE / (n_pass / (n + 1e-10)) ELSE 'NaN'::DOUBLE END")


def sql_list(edges) -> str:
    return "[" + ", ".join(f"{float(e)!r}::DOUBLE" for e in edges) + "]"


def sql_bin(x: str, edges) -> str:
    """Bin number by counting edges: half open bins, the last one closed."""
    n = len(edges) - 1
    return (
        f"CASE WHEN {x} >= {float(edges[0])!r}::DOUBLE AND {x} <= {float(edges[-1])!r}::DOUBLE THEN "
        f"least(len(list_filter({sql_list(edges)}, lambda e: e <= {x})) - 1, {n - 1})::INTEGER END"
    )


def cuts_sql(effs, keys: str = "classifier", source: str = "scores", name: str = "cuts") -> str:
    """CTE with the main-class score cut of every efficiency."""
    probs = ", ".join(repr(1.0 - float(e)) for e in effs)
    names = ", ".join(f"{float(e)!r}::DOUBLE" for e in effs)
    return (
        f"{name} AS (SELECT {keys}, unnest([{names}]) AS eff, unnest(q) AS cut FROM "
        f"(SELECT {keys}, quantile_cont(score, [{probs}]) AS q FROM {source} WHERE class = 'heavy' GROUP BY {keys}))"
    )
