"""Cuts, scores, arrays and arithmetic on small tables with known answers."""

import itertools
import math
import operator

import pytest
from pyspark.sql import functions as F

from evenkeel.functions import arrays, cuts, numeric
from evenkeel.functions.score import discriminant
from evenkeel.operators.evaluation import confusion_matrix, fraction_grid

NAN = float("nan")


# one row per (parity of the number, size or none, kind) that a cut has to tell apart
DATA = [
    (11, 120.0, 3, 31), (12, 7.5, 3, 3), (13, NAN, 8, 8), (14, 120.0, 8, 80), (15, 64.0, 1, 1), (16, NAN, 20, 20), (18, 7.5, 1, 31),
]
COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "!=": operator.ne, "==": operator.eq}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(DATA, "number int, size double, kind int, code int").cache()


def kept(rows, *specs):
    return sorted(r["number"] for r in cuts.apply_cuts(rows, list(specs)).collect())


def those(test):
    return [number for number, size, kind, code in DATA if test(number, size, kind, code)]


def test_cuts_hold_together(rows):
    common = [{"number": {"operator": "mod_2_==", "condition": 0}}, {"size": {"operator": "<=", "condition": 100}}]

    def small(n, s, k, c):
        return n % 2 == 0 and not s > 100

    assert kept(rows, *common, {"kind": {"operator": "==", "condition": 3}}) == those(lambda n, s, k, c: small(n, s, k, c) and k == 3)
    either = [{"code": {"operator": "==", "condition": [31, 3]}}]
    assert kept(rows, common, None, either) == those(lambda n, s, k, c: small(n, s, k, c) and c in (31, 3)) == [12, 18]


@pytest.mark.parametrize("op", COMPARE)
@pytest.mark.parametrize("bound", [7.5, 64.0, 500.0])
def test_missing_value_passes_all_but_equality(rows, op, bound):
    expected = those(lambda n, s, k, c: op != "==" if math.isnan(s) else COMPARE[op](s, bound))
    assert kept(rows, {"size": {"operator": op, "condition": bound}}) == expected


def test_missing_value_check_on_equality(rows):
    spec = {"operator": "==", "condition": 7.5, "NaNcheck": True}
    assert kept(rows, {"size": spec}) == those(lambda n, s, k, c: s == 7.5 or math.isnan(s))


def test_list_of_inequalities(rows):
    """A list of bounds passes if any does; a list of excluded values excludes each."""
    assert kept(rows, {"kind": {"operator": ">", "condition": [9, 2]}}) == those(lambda n, s, k, c: k > 9 or k > 2)
    assert kept(rows, {"kind": {"operator": "!=", "condition": [1, 8]}}) == those(lambda n, s, k, c: k not in (1, 8))


@pytest.mark.parametrize("cut, error", [
    ({"number": {"operator": ">", "condition": 11}, "kind": {"operator": "<", "condition": 4}}, KeyError),
    ({"number": {"operator": "mod_seven_<=", "condition": 3}}, RuntimeError),
    ({"kind": {"operator": "like", "condition": 3}}, KeyError),
])
def test_bad_cuts_are_errors(rows, cut, error):
    with pytest.raises(error):
        cuts.apply_cuts(rows, [cut])


def test_whole_number_cut_reaches_the_reader(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").cast("int").alias("truth")).write.parquet(path)
    plan = cuts.apply_cuts(spark.read.parquet(path), [{"truth": {"operator": "<=", "condition": 7}}])
    assert "LessThanOrEqual(truth,7)" in plan._jdf.queryExecution().toString()
    spark.range(10).select(F.col("id").cast("double").alias("pt")).write.parquet(path + "2")
    cut, table = [{"pt": {"operator": "<=", "condition": 7}}], spark.read.parquet(path + "2")
    assert "LessThanOrEqual(pt,7.0)" in cuts.apply_cuts(table, cut, ["pt"])._jdf.queryExecution().toString()
    assert "LessThanOrEqual(pt,7.0)" not in cuts.apply_cuts(table, cut)._jdf.queryExecution().toString()


def test_discriminant_is_the_log_of_the_weighted_ratio(spark):
    data = [(0.25, 0.15, 0.6), (0.0, 0.3, 0.7), (0.5, 0.3, 0.2), (0.9, 0.05, 0.05)]
    df = spark.createDataFrame(data, "l double, m double, h double")
    score = discriminant({x: F.col(x) for x in "lmh"}, ["h"], {"m": 0.3, "l": 0.7})
    got = [r[0] for r in df.select(score).collect()]
    assert got == pytest.approx([math.log(h / (0.3 * m + 0.7 * l)) for l, m, h in data], abs=1e-6)
    with pytest.raises(KeyError):
        discriminant({x: F.col(x) for x in "lmh"}, ["h"], {"m": 1.0})


@pytest.mark.parametrize("names, lo, hi, step", [("pq", 0.05, 1.0, 0.05), ("pq", 0.3, 0.8, 0.1), ("pqr", 0.1, 0.9, 0.1), ("p", 0.5, 1.0, 0.25)])
def test_fraction_grid_is_every_tuple_of_distinct_shares(names, lo, hi, step):
    shares = [round(100 * lo) + i * round(100 * step) for i in range(round((hi - lo) / step) + 1)]
    expected = {t for t in itertools.product(shares, repeat=len(names)) if sum(t) == 100 and len(set(t)) == len(t)}
    grid = [tuple(round(100 * g[n]) for n in names) for g in fraction_grid(names, lo, hi, step)]
    assert grid == sorted(expected)


def test_fraction_grid_has_one_step_beyond_a_range_that_step_does_not_divide():
    grid = [tuple(round(10 * g[n]) for n in "pqr") for g in fraction_grid("pqr", 0.1, 0.45, 0.1)]
    assert sorted(grid) == sorted([*itertools.permutations((1, 4, 5)), *itertools.permutations((2, 3, 5))])


def test_fraction_grid_without_a_tuple_is_an_error():
    with pytest.raises(ValueError):
        fraction_grid("pq", 0.7, 0.8, 0.1)


def test_fraction_grid_of_many_steps_is_fast():
    assert len(fraction_grid("pqr", 0.01, 1.0, 0.01)) == sum(len({a, b, 100 - a - b}) == 3 for a in range(1, 99) for b in range(1, 100 - a))


def test_first_largest_probability_wins(spark):
    df = spark.createDataFrame([(0, 0.4, 0.4, 0.2), (1, 0.1, 0.5, 0.4), (7, 1.0, 0.0, 0.0)], "label int, a double, b double, c double")
    got = {(r["label"], r["predicted"]): r["n"] for r in confusion_matrix(df, [F.col(x) for x in "abc"], 3).collect()}
    assert got == {(0, 0): 1, (1, 1): 1}


def test_count_below_matches_bisect(spark):
    import bisect

    edges = [0.0, 1.0, 1.0, 2.5, 7.0]
    df = spark.createDataFrame([(float(x) / 2,) for x in range(-2, 18)], "x double")
    table = F.array(*[F.lit(e) for e in edges])
    for r in df.select("x", arrays.count_below(table, F.col("x"), 5).alias("l"), arrays.count_below(table, F.col("x"), 5, True).alias("r")).collect():
        assert (r["l"], r["r"]) == (bisect.bisect_left(edges, r["x"]), bisect.bisect_right(edges, r["x"]))


def test_one_hot(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 2, 3, 2)], "label int")
    got = [r[0] for r in df.select(arrays.one_hot(F.col("label"), 4)).collect()]
    assert got == [[int(i == x) for i in range(4)] for x in (0, 1, 2, 3, 2)]
    with pytest.raises(Exception, match="label without a class"):
        df.select(arrays.one_hot(F.col("label"), 3)).collect()


def test_derived_variables(spark):
    df = spark.createDataFrame([(4.0, 2.0), (NAN, 3.0), (NAN, NAN)], "a double, b double")
    for op, expected in (("+", [6.0, 3.0]), ("-", [2.0, -3.0]), ("*", [8.0, 0.0]), ("/", [2.0, 0.0])):
        value, present = numeric.derived(["a", "b"], op)
        assert [r[0] for r in df.filter(present).select(value).collect()] == expected
    with pytest.raises(KeyError):
        numeric.derived(["a"], "^")


def test_half_precision(spark):
    import numpy as np

    data = [1.0, 0.1, 1234.567, 65504.0, 1e-7, -3.14159]
    df = spark.createDataFrame([(x,) for x in data], "x double").select(numeric.to_precision(F.col("x"), "float16"))
    assert [r[0] for r in df.collect()] == [float(np.float16(x)) for x in data]


def test_pooling_of_empty_and_filled_sets(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 6.0]], [0.0, 0.0]), ([], [])], "v array<array<double>>, s array<double>")
    got = df.select(
        arrays.sum_pool(F.col("v"), 2), arrays.mean_pool(F.col("v"), 2), arrays.attention_pool(F.col("v"), F.col("s"), 2)).collect()
    assert [list(map(list, r)) for r in got] == [[[4.0, 8.0], [2.0, 4.0], [2.0, 4.0]], [[0.0, 0.0]] * 3]
    assert math.isclose(got[0][2][0], 2.0)


def test_complete_columns_are_checked(spark):
    from evenkeel.functions.cuts import check_complete

    df = spark.createDataFrame([(1, 0.5, "a"), (2, float("nan"), None)], "i int, x double, s string")
    assert check_complete(df, ["i"]) is df
    with pytest.raises(ValueError, match="'x': 1, 's': 1"):
        check_complete(df, ["i", "x", "s"])


def test_shared_hashes_are_an_error(spark):
    from evenkeel.operators.ranking import first_n

    df = spark.range(100).select(F.md5(F.floor(F.col("id") / 4).cast("string")).alias("h"))
    assert first_n(df, 40, "h").count() == 40
    with pytest.raises(Exception, match="not unique"):
        first_n(df, 41, "h").count()
