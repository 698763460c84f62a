"""Quality grades by ordinal regression over hashed text.

A cumulative-link model: P(grade >= k) is the logistic function of w.x - t_k, with one weight vector w
for all grades and ordered thresholds t_1 < t_2 < ... . Features are hashed: which words and beginnings
of words a text holds, and how often its tokens have a certain shape (letters, digits, signs).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonline.llm.common import free_name, hashed_sample, held_by_worker

WORD_BITS = 18
SHAPE_BITS = 10
STEM = 4  # letters of a word's beginning that are a feature of their own
N_WORDS, N_SHAPES = 1 << WORD_BITS, 1 << SHAPE_BITS
REPEATS, VARIETY, BIAS = N_WORDS + N_SHAPES, N_WORDS + N_SHAPES + 1, N_WORDS + N_SHAPES + 2
N_FEATURES = BIAS + 1

_LOWER, _UPPER, _DIGIT = re.compile(r"[^\W\d_]+"), re.compile(r"[A-Z]+"), re.compile(r"\d+")


class _Features(dict):
    """Token to the features of its word, of its word's first letters (both or -1), and of its shape, for
    the tokens met lately."""

    def __missing__(self, token: str) -> tuple[int, int, int]:
        from xxhash import xxh3_64_intdigest

        if len(self) > 200_000:
            self.clear()
        word = "".join(c for c in token.lower() if c.isalnum())
        shape = _DIGIT.sub("0", _LOWER.sub("a", _UPPER.sub("A", token)))[:16]
        of_word = xxh3_64_intdigest(word.encode()) & (N_WORDS - 1) if word else -1
        of_stem = xxh3_64_intdigest(word[:STEM].encode(), 2) & (N_WORDS - 1) if len(word) > STEM else -1
        found = (of_word, of_stem, N_WORDS + (xxh3_64_intdigest(shape.encode(), 1) & (N_SHAPES - 1)))
        if len(token) <= 64:
            self[token] = found
        return found


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a whole text's features; only the bias for a text without words."""
    tokens = (text or "").split()
    n = len(tokens)
    if not n:
        return np.array([BIAS], np.int32), np.ones(1, np.float32)
    of, times = held_by_worker("features", _Features), Counter(tokens)
    words: set[int] = set()
    shapes: Counter = Counter()
    for token, count in times.items():
        word, stem, shape = of[token]
        words.add(word)
        words.add(stem)
        shapes[shape] += count
    words.discard(-1)
    repeats = sum(map(eq, tokens, islice(tokens, 1, None))) if len(times) < n else 0
    index = [*words, *shapes, REPEATS, VARIETY, BIAS]
    value = [1.0] * len(words) + [(c / n) ** 0.5 for c in shapes.values()] + [repeats / n, (len(times) / n) ** 0.5, 1.0]
    return np.array(index, np.int32), np.array(value, np.float32)


@dataclass
class GradeModel:
    """Weights, thresholds and the grades in order; without weights every text has the only grade."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for every grade but the lowest, one column each."""
        return _logistic(score[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_grades(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: list[int], *, rounds: int = 250, penalty: float = 2e-5, least_z: float = 4.0
) -> GradeModel:
    """The model of maximum likelihood with a squared penalty, by full-batch gradients.

    Only words that tell grades apart get a weight: those whose share of better rows, at some threshold,
    lies ``least_z`` deviations or more off the share of all rows. The rest would add up to noise in long
    texts. Rows that are nearly copies, told by their smallest hashed words, count once. Rows weigh by
    the square root of their grade's rarity.
    """
    alike = {(g, *np.sort(i)[:4].tolist(), len(i) // 8): n for n, ((i, _), g) in reversed(list(enumerate(zip(rows, grades, strict=True))))}
    rows, grades = [rows[n] for n in sorted(alike.values())], [grades[n] for n in sorted(alike.values())]
    levels = sorted(set(grades))
    if len(levels) < 2:
        return GradeModel(np.zeros(0), np.zeros(0), levels)
    y = np.searchsorted(levels, grades)
    n, k = len(y), len(levels)
    index = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(n, dtype=np.int32), [len(r[0]) for r in rows])
    seen = np.bincount(index, minlength=N_FEATURES)
    used = np.zeros(N_FEATURES, dtype=bool)
    for j in range(1, k):
        better = (y >= j)[row]
        share = (y >= j).mean()
        off = np.bincount(index, better, minlength=N_FEATURES) - seen * share
        used |= np.abs(off) >= least_z * np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    used &= seen >= 3
    used[N_WORDS:] = True
    used[BIAS] = False  # the thresholds take its place
    keep = used[index]
    index, value, row = index[keep], value[keep].astype(np.float64), row[keep]
    weight = (1 / np.bincount(y, minlength=k)[y]) ** 0.5
    weight *= n / weight.sum()
    w, mean, square = np.zeros(N_FEATURES), np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    # Thresholds start at the grades' shares; their distances stay positive as exponentials.
    share = np.array([(weight * (y >= j)).sum() / n for j in range(1, k)]).clip(1e-3, 1 - 1e-3)
    t = -np.log(share / (1 - share))
    theta = np.concatenate([t[:1], np.log(np.maximum(np.diff(t), 1e-2))])
    t_mean, t_square = np.zeros(k - 1), np.zeros(k - 1)
    for step in range(1, rounds + 1):
        t = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        score = np.bincount(row, value * w[index], minlength=n)
        tail = np.ones((n, k + 1))
        tail[:, 1:k] = _logistic(score[:, None] - t[None, :])
        tail[:, k] = 0
        slope = tail * (1 - tail)
        upper, lower = np.take_along_axis(tail, y[:, None], 1)[:, 0], np.take_along_axis(tail, y[:, None] + 1, 1)[:, 0]
        likely = np.maximum(upper - lower, 1e-9)
        d_upper = np.take_along_axis(slope, y[:, None], 1)[:, 0] / likely * weight / n
        d_lower = np.take_along_axis(slope, y[:, None] + 1, 1)[:, 0] / likely * weight / n
        d_score = d_lower - d_upper  # of the mean negative log likelihood
        gradient = np.bincount(index, value * d_score[row], minlength=N_FEATURES) + penalty * w
        d_t = np.array([d_upper[y == j].sum() - d_lower[y == j - 1].sum() for j in range(1, k)])
        rest = np.cumsum(d_t[::-1])[::-1]
        d_theta = np.concatenate([rest[:1], rest[1:] * np.exp(theta[1:])])
        rate = 0.15 * min(1.0, 2 * (1 - step / (rounds + 1)))
        for at, g, m, s in ((w, gradient, mean, square), (theta, d_theta, t_mean, t_square)):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            at -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return GradeModel(w, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])])), levels)


_FEATURES = T.StructType([T.StructField("index", T.BinaryType()), T.StructField("value", T.BinaryType())])


def train_grades(
    docs: DataFrame, ratings: DataFrame, *, sample: int = 12_000, doc_id: str = "doc_id", text: str = "text", grade: str = "grade"
) -> GradeModel:
    """Fit on ``ratings`` (doc_id, integer grade) joined with the whole texts of ``docs``.

    At most about ``sample`` ratings are used, chosen by a hash of the id; so what is broadcast and
    gathered is bounded. A document rated differently several times counts with its lowest grade; ratings
    without id or grade, or of no document, are passed over.
    """
    rated = ratings.where(F.col(doc_id).isNotNull() & F.col(grade).isNotNull()).select(
        F.col(doc_id).cast("long").alias("rated_id"), F.col(grade).cast("int").alias("grade")
    )
    chosen = hashed_sample(rated, F.col("rated_id"), sample).groupBy("rated_id").agg(F.min("grade").alias("grade"))

    @F.pandas_udf(_FEATURES)
    def extracted(texts: pd.Series) -> pd.DataFrame:
        found = [features(t) for t in texts]
        return pd.DataFrame({"index": [i.tobytes() for i, _ in found], "value": [v.tobytes() for _, v in found]})

    slim = docs.select(F.col(doc_id).cast("long").alias("rated_id"), F.col(text).alias("text"))
    joined = slim.join(F.broadcast(chosen), "rated_id")  # at most 1.2 * sample + 100 rows of two numbers
    got = joined.select("rated_id", "grade", extracted("text").alias("f")).select("rated_id", "grade", "f.index", "f.value")
    got = got.limit(2 * sample + 200).collect()
    got.sort(key=lambda r: (r["rated_id"], r["index"]))
    rows = [(np.frombuffer(r["index"], np.int32), np.frombuffer(r["value"], np.float32)) for r in got]
    return fit_grades(rows, [r["grade"] for r in got])


def with_grades(
    docs: DataFrame, model: GradeModel, *, text: str = "text", expected: str = "expected_grade", tail: str = "p_top", least: int | None = None
) -> DataFrame:
    """``docs`` with the expected grade and the probability of grade ``least`` or better (None: the best).

    A null text counts as empty. If the ratings had one grade only, that is the expected grade and the
    probability is 1; if there were none, the expected grade is null and the probability 1. Columns of
    these names give way. No shuffle; the weights (2 MB at most) go to the executors once.
    """
    if len(model.grades) < 2:
        only = F.lit(float(model.grades[0]) if model.grades else None).cast("double")
        return docs.withColumns({expected: only, tail: F.lit(1.0)})
    column = len(model.grades) - 2 if least is None else model.grades.index(least) - 1
    sent = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.grades))

    @F.pandas_udf("expected double, tail double")
    def graded(texts: pd.Series) -> pd.DataFrame:
        weights, thresholds, grades = sent.value
        score = np.array([float(weights[i] @ v) for i, v in map(features, texts)])
        tails = GradeModel(weights, thresholds, grades).tails(score)
        steps = np.diff(np.array(grades, dtype=float))
        return pd.DataFrame({"expected": grades[0] + tails @ steps, "tail": tails[:, column]})

    hold = free_name(docs, "graded")
    return docs.withColumn(hold, graded(F.col(text))).select(
        *[c for c in docs.columns if c not in (expected, tail)],
        F.col(hold)["expected"].alias(expected),
        F.col(hold)["tail"].alias(tail),
    )


def grade_of_labels(quality: Column, toxic: Column) -> Column:
    """0: bad text; 1: good but toxic; 2: good. Null where the quality is unknown."""
    return F.when(quality == 0, 0).when((quality == 1) & F.coalesce(toxic == 1, F.lit(False)), 1).when(quality == 1, 2)
