"""Operator 12: language identification by sparse multinomial logistic regression on character n-grams.

**Features.** Letters are lower-cased, every run of other characters is one word boundary, and all 1-, 2- and
3-grams of the whole text are hashed to 2^BITS numbers. A text's vector is (1 + ln count) * idf, scaled to length 1.
The idf is ln((1 + N) / (1 + df)) + 1 with document frequencies counted over all rows that may be learned from, one
partial count per task. Texts are read in pieces of PIECE characters, so a very long one needs little memory.

**Training.** Follow-the-regularised-leader (proximal, per-coordinate rates ALPHA, BETA) with elastic-net penalties
L1 and L2: weights whose accumulated gradient stays within L1 are exactly zero. Equal texts of a language count once;
of every language the texts with the smallest hashes are taken, ``TRAIN_ROWS`` over all languages (at least one for
each): the documented bound of what is fitted on. A fifth of them is left out of the weights and fits the temperature
that divides the logits (calibration). One task does this on the bounded sample and returns the non-zero weights; they
and the idf (2^BITS numbers) are broadcast: at most 2^BITS * languages floats.

**Prediction.** One map over the texts, no shuffle. The score is the calibrated probability of the predicted language.

Defined results: a null text and one without a letter get ``und`` with score 0, also when their language is learned;
rows without lang teach nothing; with no row to learn from every prediction is ``und``; with a single language it is
that one, with score 1. A null id is not held out. Repeated rows each come back. Other input columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 15
TRAIN_ROWS = 4096
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.1, 0.01
PIECE = 1 << 20
UNKNOWN = "und"

#: code point -> lower-case code point of a letter, 0 for everything else; made once per process
_FOLD: list[np.ndarray] = []
_FOLDED = 1 << 17


def folded(codes: np.ndarray) -> np.ndarray:
    if not _FOLD:
        chars = [chr(i) for i in range(_FOLDED)]
        _FOLD.append(np.array([0 if not c.isalpha() else ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars],
                              dtype=np.uint32))
    table = _FOLD[0]
    if len(codes) and codes.max() >= _FOLDED:
        return np.where(codes < _FOLDED, table[np.minimum(codes, _FOLDED - 1)], codes)
    return table[codes]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1-, 2- and 3-grams of a text: their numbers, ascending, and counts."""
    total, held = None, np.zeros(1, dtype=np.uint32)  # the last codes of the piece before
    for at in range(0, len(text) + 1, PIECE):
        piece = text[at:at + PIECE] + (" " if at + PIECE > len(text) else "")
        c = np.concatenate([held, folded(np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4"))])
        fresh = np.concatenate([np.zeros(len(held), dtype=bool), (c[len(held):] != 0) | (c[len(held) - 1:-1] != 0)])
        fresh[:len(held)] = True
        c = c[fresh]
        new = len(held)
        one = c[new:] * np.uint32(0x9E3779B1)
        two = one + c[new - 1:-1] * np.uint32(0x85EBCA77)
        three = (two[2 - new:] if new < 2 else two) + c[max(new - 2, 0):-2] * np.uint32(0xC2B2AE3D)
        h = np.concatenate([one[c[new:] != 0], two + np.uint32(0x27D4EB2F), three + np.uint32(0x165667B1)])
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        part = np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)
        total = part if total is None else total + part
        held = c[-2:]
    ids = np.flatnonzero(total)
    return ids, total[ids]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = gram_counts(text)
    x = (1 + np.log(counts)) * idf[ids]
    return ids, (x / max(np.sqrt(x @ x), 1e-12)).astype(np.float32)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df = np.zeros(1 << BITS, dtype=np.int64)
    for b in batches:
        for text in b["text"]:
            df[gram_counts(text)[0]] += 1
    ids = np.flatnonzero(df)
    yield pd.DataFrame({"gram": ids.astype(np.int32), "df": df[ids]})


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """How many texts hold each hashed n-gram, over all rows of ``texts`` (column text, not null)."""
    rows = texts.select("text").mapInPandas(_frequencies, "gram int, df long").groupBy("gram").agg(F.sum("df").alias("df"))
    df = np.zeros(1 << BITS, dtype=np.int64)
    got = rows.toPandas()  # at most 2^BITS rows
    df[got["gram"].to_numpy()] = got["df"].to_numpy()
    return df


def sample(texts: DataFrame, languages: int, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(lang, h, text): per language the distinct texts of smallest hash, ``train_rows`` in all languages together."""
    quota = max(1, train_rows // max(languages, 1))
    hashed = texts.select("lang", F.xxhash64("text").alias("h"), "text")
    first = hashed.select("lang", "h").distinct().withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("r") <= quota).drop("r")
    return hashed.join(F.broadcast(first), ["lang", "h"]).dropDuplicates(["lang", "h"])  # first: train_rows at most


class Leader:
    """Multinomial logistic regression by follow-the-regularised-leader (proximal)."""

    def __init__(self, classes: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(((1 << BITS) + 1, classes))  # the last row is the bias, free of L1
        self.n = np.zeros_like(self.z)

    def weights(self, ids: np.ndarray) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        l1 = np.where(ids == 1 << BITS, 0.0, self.l1)[:, None]
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, ids: np.ndarray, x: np.ndarray, y: int) -> None:
        ids, x = np.append(ids, 1 << BITS), np.append(x, np.float32(1))
        w = self.weights(ids)
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p
        n = self.n[ids]
        grown = n + g * g
        self.z[ids] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[ids] = grown


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest log loss on the calibration rows (golden section on its log)."""
    def loss(t: float) -> float:
        return -float(np.log(np.maximum(softmax(logits / math.exp(t))[np.arange(len(y)), y], 1e-300)).mean())
    lo, hi, r = math.log(1 / 64), math.log(64), (math.sqrt(5) - 1) / 2
    while hi - lo > 1e-4:
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def _train(classes: list[str], idf: np.ndarray, epochs: int, penalty: dict):
    """The bounded sample -> rows (gram, class, weight); the temperature is in the row of class -1."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(((int(h), classes.index(lang), *vector(text, idf)) for b in batches
                       for lang, h, text in zip(b["lang"], b["h"], b["text"])), key=lambda r: r[:2])
        if not rows:
            return
        fit, held = [r for r in rows if r[0] % 5], [r for r in rows if not r[0] % 5]
        if len({r[1] for r in fit}) < len(classes):
            fit, held = rows, rows  # too few texts to keep some apart
        model = Leader(len(classes), **penalty)
        for _ in range(epochs):
            for _, y, ids, x in fit:
                model.learn(ids, x, y)
        w = model.weights(np.arange((1 << BITS) + 1)).astype(np.float32)
        t = temperature(np.array([x @ w[ids] + w[-1] for _, _, ids, x in held]), np.array([r[1] for r in held])) if held else 1.0
        g, c = np.nonzero(w)
        yield pd.DataFrame({"gram": [*g, 0], "class": [*c, -1], "weight": [*w[g, c].astype(float), t]})
    return run


def fit(texts: DataFrame, train_rows: int = TRAIN_ROWS, epochs: int = EPOCHS, **penalty) -> dict | None:
    """The model learned from ``texts`` (lang, text; neither null), None if there is no row."""
    counts = {r.lang: r.n for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    classes = sorted(counts)
    idf = (np.log((1 + sum(counts.values())) / (1 + document_frequencies(texts))) + 1).astype(np.float32)
    chosen = sample(texts, len(classes), train_rows).coalesce(1)  # at most train_rows rows
    got = chosen.mapInPandas(_train(classes, idf, epochs, penalty), "gram int, class int, weight double").toPandas()
    w = np.zeros(((1 << BITS) + 1, len(classes)), dtype=np.float32)
    real = got[got["class"] >= 0]
    w[real["gram"].to_numpy(), real["class"].to_numpy()] = real["weight"].to_numpy()
    return {"classes": classes, "idf": idf, "weights": w, "temperature": float(got.loc[got["class"] < 0, "weight"].iloc[0])}


def _predict(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            lang, score = [], []
            for text in b.pop("text"):
                if text is None or m is None:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                ids, x = vector(text, m["idf"])
                p = softmax((x @ m["weights"][ids] + m["weights"][-1]).astype(float) / m["temperature"])
                lang.append(m["classes"][int(p.argmax())])
                score.append(float(p.max()))
            yield b.assign(lang_pred=lang, score=score)
    return run


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, held_out: Column, train_rows: int = TRAIN_ROWS, epochs: int = EPOCHS, **penalty) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang); held-out rows teach nothing."""
    text = F.when(has_letter(F.col("text")), F.col("text"))
    model = fit(docs.where(~held_out & F.col("lang").isNotNull()).select("lang", text.alias("text")).where("text is not null"),
                train_rows, epochs, **penalty)
    rows = docs.select("doc_id", held_out.alias("held_out"), text.alias("text"))
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInPandas(_predict(docs.sparkSession.sparkContext.broadcast(model)),
                            f"doc_id {fields['doc_id']}, held_out boolean, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))
