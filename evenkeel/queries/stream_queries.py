"""J: the incremental operators on streams over the given files."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenkeel.functions.arrays import above
from evenkeel.functions.cuts import apply_cuts
from evenkeel.operators.labels import label_classes
from evenkeel.operators.scaling import scaled_columns
from evenkeel.plans.prepare import tag_split
from evenkeel.queries.base import (
    CLASSES, LAB, MAIN, NET, NET_SCORE, PROBS, r, rounded, rows_of, table, with_probabilities,
)
from evenkeel.queries.registry import query
from evenkeel.queries.scaling_queries import _FILLED, BASE, VARIABLES
from evenkeel.streaming import incremental as inc


def _stream(spark, sf):
    return inc.open_stream(spark, sf, "lineitem.parquet")


@query("j01_streamed_statistics", f"""WITH {BASE}, {_FILLED} SELECT variable, {r('shift', 5)} AS shift, {r('scale', 5)} AS scale, {r('"default"', 5)} AS "default", n FROM stats""")
def _(spark, sf):
    out = inc.streamed_statistics(_stream(spark, sf), rows_of, VARIABLES, {"energy": 0.03})
    return out.select("variable", *[rounded(c, 5).alias(c) for c in ("shift", "scale", "default")], "n")


FIXED = {"price": {"shift": 38000.0, "scale": 23000.0, "default": 0.0}, "mass": {"shift": 0.05, "scale": 0.03, "default": 0.05}}
CUT = 0.35
_J02 = f"""WITH {PROBS} SELECT row_key, label, CASE WHEN event % 10 <= 7 THEN 'train' WHEN event % 10 = 8 THEN 'validation' ELSE 'test' END AS split,
{r('(price - 38000.0) / 23000.0')} AS price, {r('(CASE WHEN isnan(mass) THEN 0.05::DOUBLE ELSE mass END - 0.05) / 0.03')} AS mass, {r(NET_SCORE)} AS score, {NET_SCORE} > {CUT} AS passed FROM probs WHERE quantity > 5"""


@query("j02_continuous_preparation", _J02)
def _(spark, sf):
    steps = [
        rows_of,
        lambda df: apply_cuts(df, [{"quantity": {"operator": ">", "condition": 5}}]),
        lambda df: tag_split(label_classes(df, CLASSES), "event"),
        with_probabilities,
        lambda df: df.withColumn("score", NET.score(df.columns, MAIN)),
        lambda df: df.select(
            "row_key", "label", "split", *[c.alias(n) for n, c in scaled_columns(list(FIXED), FIXED).items()],
            "score", above(F.col("score"), F.lit(CUT)).alias("passed")),
    ]
    out = inc.run_to_table(inc.prepared_stream(_stream(spark, sf), steps))
    return out.select("row_key", "label", "split", *[rounded(c).alias(c) for c in ("price", "mass", "score")], "passed")


# The events of some days arrive file by file, every fiftieth only after all others.
DAYS = ("2024-01-08", "2024-01-15", "2024-01-22")
LATE = 50
_J03 = f"""WITH e AS (SELECT *, event_id % {LATE} = 0 AS late, time_bucket(INTERVAL '6 hours', ts) AS start FROM events WHERE ts IS NOT NULL),
-- when the last file comes, rows are late against the files before the one before it
mark AS (SELECT max(ts) - INTERVAL '12 hours' AS upto FROM e WHERE NOT late AND ts < TIMESTAMP '{DAYS[-1]}'),
k AS (SELECT start, event_type, count(*) AS n, count(*) FILTER (value > 50) AS n_passed FROM e, mark WHERE NOT late OR start + INTERVAL '6 hours' > upto GROUP BY ALL)
SELECT epoch(start)::BIGINT AS window_start, event_type, n, n_passed, {r('n_passed / n::DOUBLE')} AS pass_fraction FROM k"""


@query("j03_drift_monitor", _J03)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    late = F.col("event_id") % LATE == 0
    edges = [None, *[F.lit(d).cast("timestamp") for d in DAYS], None]
    parts = [
        events.filter(~late & (F.lit(True) if lo is None else F.col("ts") >= lo) & (F.lit(True) if hi is None else F.col("ts") < hi))
        for lo, hi in zip(edges, edges[1:])
    ]
    folder = inc.replay([*parts, events.filter(late)])
    stream = inc.open_stream(spark, folder, "*.parquet", max_files=1)
    seen = inc.drift_monitor(stream, "ts", "6 hours", "12 hours", ["event_type"], above(F.col("value"), F.lit(50.0)))
    return seen.select(
        F.unix_timestamp("window_start").alias("window_start"), "event_type", "n", "n_passed", rounded("pass_fraction").alias("pass_fraction"))
