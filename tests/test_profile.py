import math

import numpy as np
import pytest
from conftest import rows

from seasonline.operators.profile import error_report, histogram, skew_report


def test_error_report(spark):
    df = spark.createDataFrame([("a", 10.0, 8.0, 9.0), ("a", 4.0, 5.0, 4.0), ("b", 1.0, 1.0, 3.0)], "g string, y double, p double, q double")
    got = {r["g"]: r for r in error_report(df, "y", {"p": "p", "q": "q"}, ["g"]).collect()}
    errors = np.array([2.0, -1.0])
    assert got["a"]["n"] == 2
    assert got["a"]["p_mean_error"] == pytest.approx(errors.mean())
    assert got["a"]["p_std_error"] == pytest.approx(errors.std())
    assert got["a"]["p_rmse"] == pytest.approx(math.sqrt((errors**2).mean()))
    assert (got["b"]["q_mean_error"], got["b"]["q_std_error"], got["b"]["q_rmse"]) == (-2.0, 0.0, 2.0)


def skew_test(x):
    """D'Agostino (1970), as published: Z = delta * ln(Y / alpha + sqrt((Y / alpha)^2 + 1))."""
    x = np.asarray(x, dtype=float)
    n, d = len(x), x - x.mean()
    b1 = (d**3).mean() / (d**2).mean() ** 1.5
    y = b1 * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta, alpha = 1 / math.sqrt(math.log(math.sqrt(w2))), math.sqrt(2 / (w2 - 1))
    z = delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))
    return b1, z, math.erfc(abs(z) / math.sqrt(2))


def test_skew_report(spark):
    rng = np.random.default_rng(3)
    right, left = rng.exponential(size=40), -rng.exponential(size=40) ** 2
    df = spark.createDataFrame(
        [("a", float(r), float(s)) for r, s in zip(right, left)] + [("few", 1.0, float(i)) for i in range(7)],
        "g string, right double, left double",
    )
    got = {(r["g"], r["stat"]): r for r in skew_report(df, ["right", "left"], ["g"]).collect()}
    for name, values in (("right", right), ("left", left)):
        r = got["a", name]
        assert (r["n"], r["skewness"], r["z"], r["p_value"]) == pytest.approx((40, *skew_test(values)))
    # Known value: the textbook sample 2, 8, 0, 4, 1, 9, 9, 0.
    known = spark.createDataFrame([(float(v),) for v in (2, 8, 0, 4, 1, 9, 9, 0)], "x double")
    r = skew_report(known, ["x"]).first()
    assert (r["z"], r["p_value"]) == pytest.approx((0.44626385374196975, 0.6554066631275459))
    assert got["few", "left"]["z"] is None and got["few", "left"]["p_value"] is None
    assert got["few", "right"]["skewness"] is None


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    values = rng.normal(size=200)
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("same", 2.0)] * 3 + [("a", None)], "g string, x double")
    got = histogram(df, ["x"], ["g"], bins=30).collect()
    counts, edges = np.histogram(values, bins=30)
    mine = {r["bin"]: r for r in got if r["g"] == "a"}
    assert {b: r["n"] for b, r in mine.items()} == {b: c for b, c in enumerate(counts) if c}
    for b, r in mine.items():
        assert (r["low"], r["high"]) == pytest.approx((edges[b], edges[b + 1]))
    assert sum(r["density"] * (r["high"] - r["low"]) for r in mine.values()) == pytest.approx(1.0)
    assert [(r["bin"], r["n"], r["density"]) for r in got if r["g"] == "same"] == [(0, 3, None)]


def test_log_histogram_leaves_out_what_has_no_logarithm(spark):
    df = spark.createDataFrame([(1.0,), (math.e,), (math.e**2,), (0.0,), (-3.0,), (None,)], "x double")
    got = histogram(df, ["x"], bins=2, log=True)
    assert [(b, n) for _, b, _, _, n, _ in rows(got)] == [(0, 1), (1, 2)]
