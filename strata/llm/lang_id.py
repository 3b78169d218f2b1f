"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties and calibrated by a temperature.

Document frequencies are counted by Spark over all learning rows.  The weights
are fitted on a bounded sample of them (``sample_docs`` in all, shared out
evenly between the languages); a fifth of the sample is held back for the
temperature.  Prediction reads every whole text.

Defined results: a null text or one without a letter (Unicode categories L) is ``und`` with score 0;
without any learning row every text is ``und``; rows with a null ``lang`` teach
nothing; languages that tie go to the first in string order; equal rows count once in the
sample, each in the document frequencies, and get equal predictions; an empty table gives an empty result.  Only ``doc_id``,
``text`` and (for learning) ``lang`` are read, other columns may have any name but one
that begins with ``__li_``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze

BITS = 16
DIMS = 1 << BITS
CHUNK = 1 << 20  # characters hashed at once
LIKE_A_LETTER = re.compile(r"[^\W\d_]")  # also numbers that are no digits, such as fractions
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Whether a character is a letter (Unicode categories L)."""
    return any(m[0].isalpha() for m in LIKE_A_LETTER.finditer(text))


def decode(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the 1- to 3-character n-grams of the lower-cased
    whole text, and their counts."""
    total = np.zeros(DIMS, np.int64)
    text = text.lower()
    for at in range(0, len(text), CHUNK):
        # the next chunk's n-grams may start in the last two characters of this one
        part = np.frombuffer(text[max(0, at - 2) : at + CHUNK].encode("utf-32-le", "replace"), np.uint32)
        lead = min(2, at)
        gram = np.zeros(len(part), np.uint64)
        for n in range(1, 4):
            gram = gram[: len(part) - n + 1] * np.uint64(0x110000) + part[n - 1 :].astype(np.uint64)
            mixed = ((gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
            # n-grams that lie wholly in the lead were counted with the chunk before
            total += np.bincount(mixed[max(0, lead - n + 1) :].astype(np.int64), minlength=DIMS)
    found = np.flatnonzero(total)
    return found, total[found]


def tfidf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(counts)) * idf[found]
    return x / (np.sqrt(x @ x) or 1.0)


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Number of texts that hold each feature, over all rows of ``texts(text)``;
    its last entry is the number of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for t in batch.column(0):
                df[ngram_counts(decode(t.as_py()))[0]] += 1
                df[DIMS] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["feature", "n"])

    rows = texts.select(F.col("text").cast("binary")).mapInArrow(count, "feature long, n long")
    out = np.zeros(DIMS + 1, np.int64)
    found = rows.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # at most DIMS + 1 rows, as columns
    out[found["feature"].to_numpy()] = found["n"].to_numpy()
    return out


def least_orders(rows: DataFrame, each: int) -> DataFrame:
    """Of ``rows(lang, at)`` the ``each`` least different ``at`` of each language, or fewer.  Only
    rows below a language's bound are ranked, about ``each`` of it however many it has; a bound
    that leaves too few (many rows are equal) is raised until it does not."""
    counts = freeze(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    place = (F.col("at").cast("double") + 2.0**63) / 2.0**64
    wanted = 1.25 * each + 64
    while True:
        share = F.lit(wanted) / F.col("n")
        few = rows.join(F.broadcast(counts), "lang").filter(place <= share).select("lang", "at").distinct()
        few = freeze(few, "lang-least")
        found = few.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        short = counts.join(found, "lang", "left").filter((share < 1) & (F.coalesce("found", F.lit(0)) < each))
        if short.isEmpty():
            break
        wanted *= 8
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    return few.withColumn("rank", rank).filter(F.col("rank") <= each).drop("rank")


def training_sample(train: DataFrame, sample_docs: int) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """``sample_docs`` rows in all, or one of each language if these are more: of each language
    an equal number, the rows of smallest hash (equal rows count once), as (lang, order,
    features, counts)."""
    langs = train.select("lang").distinct().count()
    if not langs:
        return []
    hashed = train.select("lang", F.xxhash64("doc_id", "text").alias("at"), F.col("text").cast("binary").alias("text"))
    drawn = hashed.join(F.broadcast(least_orders(hashed.select("lang", "at"), -(-sample_docs // langs))), ["lang", "at"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [ngram_counts(decode(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    batch.column("at"),
                    pa.array([f.astype(np.uint32).tobytes() for f, _ in made], pa.binary()),
                    pa.array([c.astype(np.uint32).tobytes() for _, c in made], pa.binary()),
                ],
                ["lang", "at", "found", "counts"],
            )

    made = drawn.dropDuplicates(["lang", "at"]).mapInArrow(features, "lang string, at long, found binary, counts binary")
    rows = [(r[0], r[1], np.frombuffer(r[2], np.uint32), np.frombuffer(r[3], np.uint32)) for r in made.collect()]
    return sorted(rows, key=lambda r: (r[1], r[0]))


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # DIMS
    weights: np.ndarray  # DIMS x langs
    bias: np.ndarray
    temperature: float

    def predict(self, text: bytes | None) -> tuple[str, float]:
        line = decode(text)
        if not self.langs or not has_letter(line):
            return UNKNOWN, 0.0
        found, counts = ngram_counts(line)
        p = softmax((tfidf(found, counts, self.idf) @ self.weights[found] + self.bias) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    classes: int,
    epochs: int = 3,
    rate: float = 0.5,
    smooth: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by FTRL-proximal with one learning rate per coordinate;
    ``rows`` are (class, features, values).  The last coordinate is the bias and
    bears no penalty."""
    z, n = np.zeros((DIMS + 1, classes)), np.zeros((DIMS + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        one = np.where(at == DIMS, 0.0, l1)[:, None]
        two = np.where(at == DIMS, 0.0, l2)[:, None]
        w = -(z[at] - np.sign(z[at]) * one) / ((smooth + np.sqrt(n[at])) / rate + two)
        return np.where(np.abs(z[at]) <= one, 0.0, w)

    for _ in range(epochs):
        for label, found, x in rows:
            at, v = np.append(found, DIMS), np.append(x, 1.0)
            w = weights(at)
            p = softmax(v @ w)
            p[label] -= 1.0
            g = np.outer(v, p)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / rate * w
            n[at] += g * g
    w = weights(np.arange(DIMS + 1))
    return w[:DIMS], w[DIMS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log-loss."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(learn: DataFrame, sample_docs: int = 4000, **ftrl: float) -> Model:
    """Fit on ``learn(doc_id, text, lang)``; null texts and languages are left out."""
    learn = learn.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    sample = training_sample(learn, sample_docs)
    langs = sorted({r[0] for r in sample})
    if not langs:
        return Model([], np.zeros(DIMS), np.zeros((DIMS, 0)), np.zeros(0), 1.0)
    df = document_frequencies(learn)
    idf = np.log((1.0 + df[DIMS]) / (1.0 + df[:DIMS])) + 1.0
    rows = [(langs.index(lang), found, tfidf(found, counts, idf)) for lang, _, found, counts in sample]
    fit, held, taught = [], [], set()
    for i, r in enumerate(rows):
        (held if i % 5 == 4 and r[0] in taught else fit).append(r)  # no language is held back whole
        taught.add(r[0])
    w, b = fit_ftrl(fit, len(langs), **ftrl)
    logits = np.array([x @ w[found] + b for _, found, x in held]).reshape(len(held), len(langs))
    return Model(langs, idf, w, b, fit_temperature(logits, np.array([r[0] for r in held], int)))


def predict_column(df: DataFrame, model: Model, text: Column) -> Column:
    """A struct ``lang_pred, score, letter`` (whether the text has a letter); the model's
    size is bounded by DIMS and the number of languages."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, letter boolean")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t.as_py() for t in batch]
            made = [shared.value.predict(t) for t in texts]
            letter = [m[0] != UNKNOWN or has_letter(decode(t)) for m, t in zip(made, texts)]
            yield pa.StructArray.from_arrays(
                [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64()), pa.array(letter, pa.bool_())],
                ["lang_pred", "score", "letter"],
            )

    return language(text.cast("binary"))


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` without those that are ``und`` as their text is null or has no
    letter; the others stay, however low their score, and also without any learned language."""
    guess = docs.withColumn("__li_guess", predict_column(docs, model, F.col("text")))
    known = (F.col("__li_guess.lang_pred") != UNKNOWN) | F.col("__li_guess.letter")
    return guess.filter(known).drop("__li_guess")
