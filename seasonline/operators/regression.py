"""One regression per group (and per seeded run), fitted for all groups in a single pass.

Each task adds up the cross products of its own rows; only those small sums are shuffled, so
a group that holds most of the rows is still fitted by all tasks together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.functions.attach import attach
from seasonline.session import staged

# The functions below travel with the tasks; workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The network's size, the number of repeated runs, the penalty of the linear model. --
HIDDEN_UNITS = 100
RUNS = 26
RIDGE_PENALTY = 0.5
# --------------------------------------------------------------------------------------------------

# An exactly solved output layer needs more than the 0.001 that suits an iterated network: with 10
# the scores of a held-out season beat the published forecasts, with 0.001 they do not.
PENALTY = 10.0

# Bytes of input that one task of a fit adds up, and rows that one task of a scoring takes with its models.
TASK_BYTES = 1 << 30
PLACE_ROWS = 250_000

Layer = tuple[np.ndarray, np.ndarray]


def ols_by_group(df: DataFrame, feature: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares on one feature: ``n, slope, intercept`` per group."""
    x, y = F.col(f"`{feature}`"), F.col(f"`{target}`")
    return df.groupBy(*by).agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


# --- ridge regression on the columns themselves ------------------------------------------------


def fit_ridge(
    df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = (), *, penalty: float = RIDGE_PENALTY
) -> DataFrame:
    """Ridge regression per group: ``n, intercept, coefficients``.

    Minimises the sum of squared errors plus ``penalty`` times the squared coefficients; the
    intercept is not penalised. Rows with a missing feature or target are left out.
    """
    x = [F.col(f"`{f}`").cast("double") for f in features]
    y = F.col(f"`{target}`").cast("double")
    sums = (
        df.dropna(subset=[*features, target])
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.sum(y).alias("_y"),
            F.array(*[F.sum(a) for a in x]).alias("_x"),
            F.array(*[F.sum(a * y) for a in x]).alias("_xy"),
            F.array(*[F.sum(a * b) for i, a in enumerate(x) for b in x[: i + 1]]).alias("_xx"),
        )
    )
    size = len(features)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = np.tril_indices(size)
        for sums_pdf in batches:
            out = sums_pdf[[*by, "n"]].copy()
            intercepts, coefficients = [], []
            for n, sy, sx, sxy, sxx in zip(*(sums_pdf[c] for c in ("n", "_y", "_x", "_xy", "_xx"))):
                sx, sxy = np.asarray(sx, dtype=float), np.asarray(sxy, dtype=float)
                cross = np.zeros((size, size))
                cross[low] = sxx
                cross = cross + np.tril(cross, -1).T - np.outer(sx, sx) / n
                w = np.linalg.pinv(cross + penalty * np.eye(size), hermitian=True) @ (sxy - sx * sy / n)
                intercepts.append(float((sy - sx @ w) / n))
                coefficients.append(w)
            yield out.assign(intercept=intercepts, coefficients=coefficients)

    fields = [df.schema[c] for c in by] + [
        T.StructField("n", T.LongType()),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    ]
    return sums.mapInPandas(solve, T.StructType(fields))


def linear_prediction(features: Sequence[str], intercept: str = "intercept", coefficients: str = "coefficients") -> Column:
    """The prediction of a model whose intercept and coefficients stand on the row."""
    total = F.col(intercept)
    for i, f in enumerate(features):
        total = total + F.get(F.col(coefficients), F.lit(i)) * F.col(f"`{f}`")
    return total


def score_ridge(
    df: DataFrame, models: DataFrame, features: Sequence[str], by: Sequence[str], *, name: str = "prediction"
) -> DataFrame:
    """``df`` with the prediction of its group's model; NULL where the group has none."""
    held = attach(df, models.select(*by, "intercept", "coefficients"), by)
    return held.withColumn(name, linear_prediction(features)).drop("intercept", "coefficients")


# --- one hidden layer of random ReLU units, repeated over seeds ---------------------------------


def hidden_layer(run: int, n_features: int, units: int) -> Layer:
    """Weights and biases of run ``run``; the same in every task."""
    draw = np.random.default_rng(run)
    return draw.standard_normal((n_features, units)) / np.sqrt(n_features), draw.uniform(-1.0, 1.0, units)


def sine_layer(run: int, n_features: int, units: int) -> Layer:
    """A layer by a formula that any engine can repeat: sines of run, feature and unit, all from 1."""
    f, u = np.arange(1, n_features + 1)[:, None], np.arange(1, units + 1)
    return np.sin(1.3 * (run + 1) + 2.1 * f + 3.7 * u), np.sin(0.7 * (run + 1) + 1.9 * u)


def _activations(x: np.ndarray, layer: Layer) -> np.ndarray:
    """A column of ones for the intercept, then the hidden units."""
    weights, bias = layer
    return np.hstack([np.ones((len(x), 1)), np.maximum(x @ weights + bias, 0.0)])


def _runs_of_keys(pdf: pd.DataFrame, by: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Stretches of rows with equal keys, in order; a missing key is None."""
    if not by:
        yield (), pdf
        return
    for key, rows in pdf.groupby(list(by), sort=False, dropna=False):
        yield tuple(None if pd.isna(k) else k for k in key), rows


def fit_tasks(rows: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """How many tasks a table read from files needs, by its size on disk."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, -(-size // task_bytes))


def fit_relu_runs(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    by: Sequence[str] = (),
    *,
    runs: int = RUNS,
    units: int = HIDDEN_UNITS,
    penalty: float = PENALTY,
    layer: Callable[[int, int, int], Layer] = hidden_layer,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Random-features regression per group and run: ``run, n, weights`` (intercept first).

    The hidden layer is ``layer(run, features, units)`` and only the output layer is fitted, by
    ridge normal equations. Features should be standardised. Rows with a missing feature or target, or
    without a group, are not fitted.

    All groups and runs share one pass over the rows. They are staged, so their size is known: a task takes about
    ``task_bytes`` of them, whatever the cluster, sorts them by group, sends each group's sums once and holds those of one
    group only. Sums of many tasks are added in two steps, each of about the square root of the number of tasks.
    """
    features, by = list(features), list(by)
    rows = df.dropna(subset=[*features, target, *by]).select(
        *by, *[F.col(f"`{c}`").cast("double").alias(c) for c in [*features, target]]
    )
    rows = staged(rows, "rows")
    tasks = fit_tasks(rows, task_bytes)
    addends = max(1, round(tasks**0.5))
    rows = rows.coalesce(tasks)
    if by:
        rows = rows.sortWithinPartitions(*by)
    upper = np.triu_indices(units + 2)
    sums_schema = T.StructType(
        [df.schema[c] for c in by]
        + [
            T.StructField("run", T.IntegerType()),
            T.StructField("addend", T.IntegerType()),
            T.StructField("sums", T.ArrayType(T.DoubleType())),
        ]
    )

    def cross_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layers = [layer(run, len(features), units) for run in range(runs)]
        addend = TaskContext.get().partitionId() % addends
        held_key, held = None, np.zeros((runs, units + 2, units + 2))

        def emit() -> pd.DataFrame:
            records = [(*held_key, run, addend, held[run][upper]) for run in range(runs)]
            held[:] = 0.0
            return pd.DataFrame(records, columns=sums_schema.names)

        for pdf in batches:
            for key, group in _runs_of_keys(pdf, by):
                if held_key is not None and key != held_key:
                    yield emit()
                held_key = key
                x, y = group[features].to_numpy(), group[[target]].to_numpy()
                for run, drawn in enumerate(layers):
                    h = np.hstack([_activations(x, drawn), y])
                    held[run] += h.T @ h
        if held_key is not None:
            yield emit()

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(sums=[np.sum(np.stack(pdf["sums"].to_list()), axis=0)])

    def solved(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((units + 2, units + 2))
        total[upper] = np.sum(np.stack(pdf["sums"].to_list()), axis=0)
        total = total + np.triu(total, 1).T
        ridge = penalty * np.eye(units + 1)
        ridge[0, 0] = 0.0
        weights = np.linalg.lstsq(total[:-1, :-1] + ridge, total[:-1, -1], rcond=None)[0]
        return pdf.iloc[:1][[*by, "run"]].assign(n=int(round(total[0, 0])), weights=[weights])

    partial = rows.mapInPandas(cross_products, sums_schema)
    # Two steps, so that no task holds the sums of all tasks for a model at once.
    partial = partial.groupBy(*by, "run", "addend").applyInPandas(added, sums_schema)
    models = T.StructType(
        [df.schema[c] for c in by]
        + [
            T.StructField("run", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("weights", T.ArrayType(T.DoubleType())),
        ]
    )
    return partial.groupBy(*by, "run").applyInPandas(solved, models)


def _placed(rows: DataFrame, models: DataFrame, groups: list[str], salts: int | None, place_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a place in ``_salt``, and a copy of its group's models for every place that a group has.

    A group has as many places as its counted rows need; groups that fit into one are not listed, so the table of
    places is no longer than all rows by ``place_rows``.
    """
    counts = rows.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / place_rows).cast("int").alias("_places")).where("_places > 1")
    if salts is not None:
        rows, models = (df.withColumn("_places", F.lit(salts)) for df in (rows, models))
    elif not groups:
        places = F.lit((counts.first() or {"_places": 1})["_places"])
        rows, models = (df.withColumn("_places", places) for df in (rows, models))
    else:
        large = staged(counts, "places")
        # Rows without a group have no models, and are spread by their number too.
        same = [F.col(f"a.`{g}`").eqNullSafe(F.col(f"b.`{g}`")) for g in groups]
        models = models.join(large, groups, "left")
        rows = rows.alias("a").join(large.alias("b"), same, "left").select("a.*", "b._places")
    places = F.coalesce("_places", F.lit(1))
    value = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c not in (*groups, "_places")])
    rows = rows.withColumn("_salt", F.pmod(value, places).cast("int"))
    return rows, models.withColumn("_salt", F.explode(F.sequence(F.lit(0), places - 1)))


def score_relu_runs(
    df: DataFrame,
    models: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    *,
    keep: Sequence[str],
    units: int = HIDDEN_UNITS,
    name: str = "prediction",
    salts: int | None = None,
    place_rows: int = PLACE_ROWS,
    layer: Callable[[int, int, int], Layer] = hidden_layer,
) -> DataFrame:
    """One row per scored row and run: ``by``, ``keep``, ``run`` and the prediction.

    The prediction is NULL where the row's group is missing or has no model, and where a feature is
    missing, as with :func:`score_ridge`. ``layer`` is the one the models were fitted with.

    The fitted models are staged, so scoring never repeats the fit. Rows and models meet by group in one
    shuffle; the rows of each group are counted first, and it gets a place for every ``place_rows`` of them, each with a copy of
    its models, which come before the rows; ``salts`` gives every group so many instead. A task holds the models of one group.
    """
    features, by = list(features), list(by)
    keep = [c for c in dict.fromkeys(keep) if c not in by]
    spark = df.sparkSession
    models = staged(models.select(*by, "run", "weights"), "models")
    runs = sorted(r["run"] for r in models.select("run").distinct().collect())
    x = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    names = {c: f"_{i}_{c}" for i, c in enumerate([*by, *keep])}  # the columns a model row lacks, under names of their own
    groups = [names[c] for c in by]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], x.alias("_x"))
    rows, held = _placed(rows, models.select(*[F.col(f"`{c}`").alias(names[c]) for c in by], "run", "weights"), groups, salts, place_rows)
    rows = rows.select(*names.values(), "_x", "_salt", F.lit(None).cast("int").alias("_run"), F.lit(None).cast("array<double>").alias("_weights"))
    held = held.select(
        *groups,
        *[F.lit(None).cast(df.schema[c].dataType).alias(names[c]) for c in keep],
        F.lit(None).cast("array<double>").alias("_x"),
        "_salt",
        F.col("run").alias("_run"),
        F.col("weights").alias("_weights"),
    )
    keys = [*groups, "_salt"]
    met = held.unionByName(rows).repartition(*keys).sortWithinPartitions(*keys, F.col("_run").asc_nulls_last())
    out = T.StructType(
        [df.schema[c] for c in [*by, *keep]]
        + [T.StructField("run", T.IntegerType()), T.StructField(name, T.DoubleType())]
    )

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layers = {run: layer(run, len(features), units) for run in runs}
        at, fitted = None, {}
        for pdf in batches:
            for key, group in _runs_of_keys(pdf, keys):
                if key != at:
                    at, fitted = key, {}
                is_model = group["_weights"].notna()
                for run, weights in zip(group.loc[is_model, "_run"], group.loc[is_model, "_weights"]):
                    fitted[int(run)] = np.asarray(weights)
                rest = group[~is_model]
                if not len(rest):
                    continue
                known = {} if any(k is None for k in key[:-1]) else fitted
                inputs = np.stack(rest["_x"].to_list()).astype(float)
                scores = np.full((len(rest), len(runs)), np.nan)
                for i, run in enumerate(runs):
                    if run in known:
                        scores[:, i] = _activations(inputs, layers[run]) @ known[run]
                repeated = rest[list(names.values())].loc[rest.index.repeat(len(runs))]
                repeated.columns = list(names)
                flat = scores.ravel()
                yield repeated.assign(
                    run=np.tile(np.array(runs, dtype="int32"), len(rest)),
                    **{name: pd.Series(np.where(np.isnan(flat), None, flat), index=repeated.index, dtype=object)},
                )

    return met.mapInPandas(scored, out)


def score_summary(scores: DataFrame, by: Sequence[str], score: str = "prediction") -> DataFrame:
    """Mean, sample deviation and number of a player's scores over the runs."""
    s = F.col(f"`{score}`")
    return scores.groupBy(*by).agg(
        F.avg(s).alias("score_mean"), F.stddev_samp(s).alias("score_std"), F.count(s).alias("n_runs")
    )


def full_results(scores: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The result columns under their published names."""
    return scores.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
