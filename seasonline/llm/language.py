"""Language by a string kernel: blended-spectrum presence kernels, Nystroem landmarks, kernel ridge.

The kernel of two texts is the number of character n-grams, of every length up to ``longest``, that both
hold, over the root of the product of their own numbers. Landmark texts span the Nystroem features, a
ridge regression of one language against the rest is fitted on them, and texts are scored by matrix
products in batches. As the kernel is linear in the n-grams, landmarks and weights are multiplied first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonline.llm.common import free_name, unit_interval

BITS = 15
SIZE = 1 << BITS
LONGEST = 4
UNKNOWN = "und"
_BATCH = 64


def presence(text: str, longest: int = LONGEST) -> np.ndarray:
    """Which hashed n-grams a whole text holds; case and line ends do not count."""
    found = np.zeros(SIZE, dtype=bool)
    codes = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    gram = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, min(longest, len(codes)) + 1):
        gram = gram[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        mixed = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        found[mixed >> np.uint64(64 - BITS)] = True
    return found


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """Per n-gram the weight of each language, for texts scaled by the root of their n-gram count."""

    languages: list[str]
    weights: np.ndarray
    offset: np.ndarray


def _blocks(rows: list[bytes]) -> Iterator[np.ndarray]:
    """Presence vectors of unit length, a bounded number at a time."""
    for at in range(0, len(rows), _BATCH):
        bits = np.unpackbits(np.stack([np.frombuffer(r, np.uint8) for r in rows[at : at + _BATCH]]), axis=1)
        x = bits.astype(np.float32)
        yield x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def fit_languages(rows: list[bytes], languages: list[str], *, landmarks: int = 256, ridge: float = 1e-2) -> LanguageModel:
    """Kernel ridge regression on packed presence vectors, in the space of the landmarks.

    Landmarks are taken from every language in turn, so that a rare one has its share.
    """
    known = sorted(set(languages))
    if len(known) < 2:
        return LanguageModel(known, np.zeros((SIZE, 0)), np.zeros(0))
    places = {lang: [i for i, x in enumerate(languages) if x == lang] for lang in known}
    turns = [places[lang][t] for t in range(max(map(len, places.values()))) for lang in known if t < len(places[lang])]
    marks = np.concatenate(list(_blocks([rows[i] for i in turns[:landmarks]])))
    kernel = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel)
    kept = values > 1e-6 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    z = np.concatenate([x @ marks.T for x in _blocks(rows)]).astype(np.float64) @ whiten
    y = (np.array(languages)[:, None] == np.array(known)[None, :]).astype(np.float64)
    # Each language weighs the same, however many texts it has.
    weight = (1 / y.sum(axis=0))[y.argmax(axis=1)]
    weight *= len(weight) / weight.sum()
    z_mean, y_mean = np.average(z, axis=0, weights=weight), np.average(y, axis=0, weights=weight)
    zc, yc = z - z_mean, y - y_mean
    gram = (zc * weight[:, None]).T @ zc + ridge * len(z) * np.eye(z.shape[1]) * np.trace(zc.T @ zc) / zc.size
    beta = np.linalg.solve(gram, (zc * weight[:, None]).T @ yc)
    return LanguageModel(known, marks.T @ (whiten @ beta).astype(np.float32), (y_mean - z_mean @ beta).astype(np.float32))


def train_languages(
    docs: DataFrame, *, per_language: int = 800, text: str = "text", lang: str = "lang", key: Column
) -> LanguageModel:
    """Fit on the texts of ``docs`` that have letters and a language.

    About ``per_language`` texts of each language are used, chosen by a hash of ``key`` within exact
    counts; ``per_language`` times the number of languages bounds what is gathered.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {r[lang]: r["n"] for r in usable.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel([], np.zeros((SIZE, 0)), np.zeros(0))
    share = F.coalesce(
        *[F.when(F.col(lang) == name, F.lit(min(1.0, per_language / n))) for name, n in sorted(counts.items())]
    )

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([np.packbits(presence(t)).tobytes() for t in texts], dtype=object)

    chosen = usable.where(unit_interval(F.lit("languages"), key) < share)
    got = chosen.select(F.col(lang).alias("lang"), packed(F.col(text)).alias("grams"))
    got = got.limit(2 * per_language * len(counts)).collect()
    got.sort(key=lambda r: (r["lang"], r["grams"]))
    return fit_languages([bytes(r["grams"]) for r in got], [r["lang"] for r in got])


def with_language(docs: DataFrame, model: LanguageModel, *, text: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of each whole text and its score from 0 to 1.

    The score is the best language's value in a softmax of the regressions, sharpened tenfold. A text that is null or without
    letters is ``und`` with score 0, and so is every text if no language was learned; if one was, it is
    that with score 1. Columns of these names give way. No shuffle; the model (128 KB a language) goes to
    the executors once.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.offset))

    @F.pandas_udf("lang string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        languages, weights, offset = sent.value
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        places = [i for i, t in enumerate(texts) if has_letters(t)] if languages else []
        bodies = texts.tolist()
        for at in range(0, len(places), _BATCH):
            some = places[at : at + _BATCH]
            if len(languages) == 1:
                best, sure = np.zeros(len(some), int), np.ones(len(some))
            else:
                x = np.stack([presence(bodies[i]) for i in some]).astype(np.float32)
                f = (x @ weights) / np.sqrt(x.sum(axis=1, keepdims=True)) + offset
                e = np.exp(10.0 * (f - f.max(axis=1, keepdims=True)))
                best, sure = f.argmax(axis=1), 1.0 / e.sum(axis=1)
            for i, b, s in zip(some, best, sure, strict=True):
                names[i], scores[i] = languages[b], float(s)
        return pd.DataFrame({"lang": names, "score": scores})

    hold = free_name(docs, "predicted")
    return docs.withColumn(hold, predicted(F.col(text))).select(
        *[c for c in docs.columns if c not in (into, score)],
        F.col(hold)["lang"].alias(into),
        F.col(hold)["score"].alias(score),
    )
