import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seasonline.operators.robust import _sliced_again, iqr_fence, keep_within, midpoint_quantiles, quantile_name, std_fence
from seasonline.session import staged


def midpoint(values, q):
    v = sorted(values)
    h = (len(v) - 1) * q
    return (v[math.floor(h)] + v[math.ceil(h)]) / 2


def check(spark, groups, qs=(0.25, 0.75), **options):
    data = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in midpoint_quantiles(df, "v", qs, ["g"], **options).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g]["n"] == len(values)
        for q in qs:
            assert got[g][quantile_name(q)] == midpoint(values, q), (g, q)


def test_small_groups_ties_and_constants(spark):
    groups = {f"n{n}": list(range(n)) for n in range(1, 6)}
    groups |= {"ties": [1, 1, 1, 2, 2, 9, 9, 9, 9], "constant": [4.5] * 50, "negative": [-3, -2.5, 0, 7, -1e9]}
    check(spark, groups, (0.0, 0.1, 0.25, 0.5, 0.75, 1.0))


def test_a_group_with_most_rows_and_wild_values(spark):
    rnd = random.Random(5)
    groups = {
        "hot": [math.exp(rnd.gauss(0, 30)) for _ in range(6000)] + [0.0] * 1500,
        "copies": [rnd.choice([1.0, 2.0, 3.0]) for _ in range(3000)],
        "cold": [rnd.random() for _ in range(17)],
        "huge": [float("inf"), 1e308, -1e308, float("-inf"), 0.0],
    }
    check(spark, groups, (0.025, 0.25, 0.5, 0.75, 0.975))


def test_a_poor_sketch_changes_nothing(spark):
    rnd = random.Random(6)
    check(spark, {"a": [rnd.gauss(0, 1) ** 3 for _ in range(4000)], "b": list(range(999))}, accuracy=5, slices=3)


def test_one_far_outlier_is_sliced_off(spark):
    """Nearly all rows fall into the slice beside the outlier; it is sliced again until it is small."""
    rnd = random.Random(7)
    groups = {"far": [rnd.random() for _ in range(5000)] + [1e12], "both": [-1e15, *[rnd.gauss(0, 1) for _ in range(3000)], 1e9], "same": [2.0] * 4000 + [9e9]}
    for qs in ((0.001,), (0.0, 0.001, 0.5, 0.999, 1.0)):
        check(spark, groups, qs, slice_rows=20)
        check(spark, groups, qs, slice_rows=20, slices=3, accuracy=10)


def test_input_in_order_of_value(spark):
    values = [float(v) ** 2 for v in range(3000)]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double").repartitionByRange(9, "v")
    got = midpoint_quantiles(df, "v", (0.25, 0.5, 0.75), ["g"]).first()
    assert tuple(got) == ("a", 3000, *(midpoint(values, q) for q in (0.25, 0.5, 0.75)))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=32), min_size=1, max_size=60), st.sampled_from([1, 2, 64]))
def test_any_values(spark, values, slices):
    values = [v + 0.0 for v in values]
    finite = [v for v in values if math.isfinite(v)] or [0.0]
    check(spark, {"g": finite}, (0.25, 0.75), accuracy=10, slices=slices)


def test_values_that_no_equal_widths_tell_apart(spark):
    """A million values within 1e-12 beside one far away, and a value that a third of a group holds."""
    n = 1_000_000
    close = spark.range(n).select(F.lit("close").alias("g"), (F.col("id") * 1e-18).alias("v"))
    far = spark.createDataFrame([("close", 1e9), ("tied", -1e300)], "g string, v double")
    tied = spark.range(90_000).select(F.lit("tied").alias("g"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(0.5 + F.col("id") * 1e-15).alias("v"))
    got = {r["g"]: tuple(r)[1:] for r in midpoint_quantiles(close.union(far).union(tied), "v", (0.25, 0.75), ["g"], slice_rows=5_000).collect()}
    values = {
        "close": [i * 1e-18 for i in range(n)] + [1e9],
        "tied": sorted([-1e300, *(0.5 if i % 3 == 0 else 0.5 + i * 1e-15 for i in range(90_000))]),
    }
    assert got == {g: (len(vs), midpoint(vs, 0.25), midpoint(vs, 0.75)) for g, vs in values.items()}


def test_no_cut_holds_more_rows_than_asked_for(spark):
    """However far the outlier, cuts shrink until they fit; a slice of one value is left as it is."""
    df = staged(spark.range(200_000).select((F.col("id") * 1e-18).alias("_v")).union(spark.createDataFrame([(1e9,)], "_v double")))
    sliced = df.withColumn("_slice", F.lit(0).cast("long"))
    ranks = F.array(F.struct(F.lit(0).alias("q"), F.lit(50_000).cast("long").alias("rank")))
    whole = spark.range(1).select(F.lit(0).cast("long").alias("_slice"), F.lit(200_001).cast("long").alias("n"), F.lit(200_001).cast("long").alias("_in_slice"), F.lit(0).cast("long").alias("_before"), ranks.alias("_wanted"))
    rows, hits = _sliced_again(sliced, staged(whole), [], 1000)
    hit = hits.first()
    assert hits.count() == 1 and hit["_in_slice"] <= 200_001 / 32 and hit["_before"] <= 50_000 < hit["_before"] + hit["_in_slice"]
    assert rows.count() == hit["_in_slice"]


def test_without_groups_and_with_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (4.0,), (2.0,), (8.0,)], "v double")
    assert tuple(midpoint_quantiles(df, "v").first()) == (4, 1.5, 6.0)


def test_rows_without_a_group_are_left_out(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("a", 4.0)], "g string, v double")
    got = midpoint_quantiles(df, "v", (0.5,), ["g"]).collect()
    assert [tuple(r) for r in got] == [("a", 2, 3.0)]


@pytest.mark.parametrize("kind", ["width", "tukey"])
def test_fence_keeps_rows_up_to_the_limit(spark, kind):
    values = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, e double")
    fences = iqr_fence(df, "e", ["g"], kind=kind)
    row = fences.first()
    q25, q75 = midpoint(values, 0.25), midpoint(values, 0.75)
    limit = 1.5 * (q75 - q25) + (q75 if kind == "tukey" else 0.0)
    assert (row["iqr"], row["fence"]) == (q75 - q25, limit)
    kept = [r["e"] for r in keep_within(df, "e", fences, ["g"]).collect()]
    assert sorted(kept) == [v for v in values if v <= limit]


def test_fence_over_all_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in range(20)], "e double")
    assert keep_within(df, "e", iqr_fence(df, "e")).count() == sum(v <= 15.0 for v in range(20))


def test_std_fence(spark):
    values = [0.0, 1.0, 2.0, 9.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, e double")
    limit = 2 * np.std(values)
    assert std_fence(df, "e", ["g"]).first()["fence"] == pytest.approx(limit)
    assert keep_within(df, "e", std_fence(df, "e", ["g"]), ["g"]).count() == sum(v <= limit for v in values)


def test_unknown_fence(spark):
    with pytest.raises(ValueError):
        iqr_fence(spark.range(1).select(F.col("id").cast("double").alias("e")), "e", kind="box")
