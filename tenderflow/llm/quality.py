"""Operator 1: quality classifier from weak labels.

1. Twelve overlapping heuristic labellers vote good, bad or abstain on every document,
   or stay silent where they cannot judge.
2. The corpus is reduced to counts of vote patterns (one group-by, partial sums before the
   shuffle). There are at most 4^12 patterns whatever the size of the corpus, so this table, and
   nothing else, goes to the driver, where expectation-maximisation estimates the class prior and each
   labeller's vote probabilities given the class. The posterior of a pattern is the posterior
   label of every document that shows it.
3. A hashed linear scorer is trained on documents weighted by posterior label: words, word shapes and
   pairs of neighbouring shapes hash to ``DIMS`` weights, fitted by logistic regression.
   The training rows are a bounded, seeded sample: at most ``PER_PATTERN`` documents per vote
   pattern and ``TRAIN_ROWS`` in all (smallest hash of the id first), a documented parameter. All other
   numbers, EM included, come from every document.
4. Every document is scored over its whole text; ``keep`` is score >= ``THRESHOLD``.

The weights (``DIMS`` floats, a fixed size) travel with the scoring function.

Defined results: null, empty and wordless texts get silence from every labeller, have score null and are not
kept. Null doc_id and repeated rows are scored like others and come back once per row. Languages the
labellers do not know change nothing: no labeller reads a word list. If all documents agree (one
class only) the scorer learns the posterior's constant. An empty table gives an empty result. Input
columns other than the id and text are ignored.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: a labeller that sees nothing clear abstains (an outcome of its own); one that cannot judge is silent
BAD, GOOD, ABSTAIN, SILENT = 0, 1, 2, 3
#: a labeller votes bad on at most this share of good documents: labellers are made to be precise
FALSE_ALARM = 0.01
DIMS = 1 << 15
TRAIN_ROWS = 6000
PER_PATTERN = 1500
#: a document goes when the odds are two to one or more against it
THRESHOLD = 1 / 3
SEED = 1


# ---- labellers ---------------------------------------------------------------------
def _vote(value: float, bad_from: float, good_to: float) -> int:
    return BAD if value >= bad_from else GOOD if value <= good_to else ABSTAIN


def _tail(word: str) -> str:
    """The word's last character if it ends in two equal symbols, else nothing."""
    return word[-1] if len(word) > 1 and word[-1] == word[-2] and not word[-1].isalnum() else ""


def votes(text: str | None) -> list[int]:
    """One vote per labeller; all silent on a text without words."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [SILENT] * len(LABELLERS)
    counts = Counter(words)
    # character kinds from the UTF-8 bytes: a lead byte stands for one letter of another alphabet
    at = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    chars = max(int(at[33:128].sum() + at[192:].sum()), 1)
    upper, lower = int(at[65:91].sum()), int(at[97:123].sum())
    letters = upper + lower + int(at[192:].sum())
    doubled = sum(c for w, c in counts.items() if _tail(w))
    bare = sum(c for w, c in counts.items() if len(w) < 4 and not w[0].isalnum() and not any(map(str.isalnum, w)))
    ends = sum(c for w, c in counts.items() if w[-1] in ".!?")
    plain = sum(c for w, c in counts.items() if w.isalpha() or w[:-1].isalpha())
    small = sum(c for w, c in counts.items() if len(w) < 4 and w.islower() and w.isalpha())
    follows = list(map(str.__eq__, words, words[1:]))
    again, runs = sum(follows) / n, sum(map(bool.__and__, follows, follows[1:])) / n
    pairs = len(set(zip(words, words[1:]))) / max(n - 1, 1)
    top = max(counts.values()) / n
    short = n < 15  # ratios of a few words say little
    return [
        _vote(1 - letters / chars, 0.30, 0.12),                       # symbols among all characters
        _vote(doubled / n, 0.30, 0.05),                               # words ending in a doubled symbol
        _vote(upper / max(upper + lower, 1), 0.50, 0.25),             # capitals among letters
        _vote(bare / n, 0.20, 0.05),                                  # words without a letter or digit
        _vote(again, 0.20, 0.05),                                     # word follows itself
        _vote(runs, 0.10, 0.02),                                      # word stands three times in a row
        _vote(1 - plain / n, 0.25, 0.10),                             # words with inner or doubled symbols
        SILENT if short else _vote(-small / n, -0.05, -0.12),        # short lower-case words
        SILENT if short else _vote(1 - pairs, 0.50, 0.25),           # repeated word pairs
        SILENT if short else _vote(top, 0.25, 0.12),                 # share of the commonest word
        SILENT if short else _vote(ends / n, 0.45, 0.30),            # words that end a sentence
        SILENT if short else _vote(abs(math.log(chars / n / 5)), 0.55, 0.35),  # usual word length
    ]


LABELLERS = ("symbols", "doubled", "capitals", "bare", "adjacent", "runs", "plain", "small", "pairs", "top_word", "sentences", "word_length")


# ---- label model -------------------------------------------------------------------
def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, tol: float = 1e-9) -> dict:
    """Prior and vote probabilities of the two classes from vote patterns (rows) and their counts.

    Labellers are independent given the class; good, bad and abstain are outcomes, silence is no evidence.
    Every class-vote table gets one pseudo-count, and no labeller is taken to vote bad on more than
    ``FALSE_ALARM`` of the good documents. Starts from the votes, any bad vote weighing more than
    the good ones, and runs until the log likelihood gains less than ``tol`` of itself.
    """
    good, bad = (patterns == GOOD).sum(axis=1), (patterns == BAD).sum(axis=1)
    post = (good + 1.0) / (good + bad + 2.0)
    post = np.where(bad >= 1, np.minimum(post, 0.45), np.maximum(post, 0.55))
    last = -math.inf
    while True:
        weight = np.stack([counts * (1 - post), counts * post])           # class x pattern
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        table = np.stack([[weight @ (patterns[:, j] == v) + 1 for v in (BAD, GOOD, ABSTAIN)]
                          for j in range(patterns.shape[1])])             # labeller x vote x class
        table = table / table.sum(axis=1, keepdims=True)
        # a defect that one class of junk shows must not become a habit of good documents
        alarm = table[:, BAD, 1]
        table[:, 1:, 1] *= ((1 - np.minimum(alarm, FALSE_ALARM)) / np.maximum(1 - alarm, 1e-12))[:, None]
        table[:, BAD, 1] = np.minimum(alarm, FALSE_ALARM)
        silent = np.concatenate([np.log(table), np.zeros_like(table[:, :1])], axis=1)
        logp = np.log(prior) + sum(silent[j][patterns[:, j]] for j in range(patterns.shape[1]))
        top = logp.max(axis=1, keepdims=True)
        total = np.log(np.exp(logp - top).sum(axis=1)) + top[:, 0]
        post = np.exp(logp[:, 1] - total)
        like = float(counts @ total)
        if like - last <= tol * abs(like):
            break
        last = like
    accuracy = {name: float(prior[1] * table[j][GOOD, 1] + prior[0] * table[j][BAD, 0])
                / float(prior @ (1 - table[j][ABSTAIN])) for j, name in enumerate(LABELLERS)}
    return {"prior": float(prior[1]), "posterior": post, "accuracy": accuracy}


# ---- hashed linear scorer ----------------------------------------------------------
def _shape(word: str) -> str:
    """Case of a word and how it ends: Word. -> Aa.  and  A1!! -> A!!"""
    end = word[-1]
    return ("A" if word.isupper() else "a" if word.islower() else "Aa" if word[0].isupper() else "x") \
        + ("" if end.isalnum() else end + _tail(word))


def features(text: str, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features (ids, values): L2-normalised blocks of words, shapes, pairs of shapes and repeats."""
    words = text.split()
    n = len(words)
    counts = Counter(words)
    kinds = {w: _shape(w) for w in counts}
    shapes = list(map(kinds.__getitem__, words))
    same = sum(map(str.__eq__, words, words[1:]))
    total: dict[int, float] = {}
    for tag, counted in (("", counts), ("s ", Counter(shapes)), ("p ", Counter(map("\t".join, zip(shapes, shapes[1:])))),
                         ("r ", Counter({"again": same, "moves": n - same}))):
        norm = math.sqrt(sum(c * c for c in counted.values())) or 1.0
        for key, c in counted.items():
            h = zlib.crc32((tag + key).encode("utf-8", "surrogatepass")) % dims
            total[h] = total.get(h, 0.0) + c / norm
    ids = np.fromiter(total, dtype=np.int64, count=len(total))
    return ids, np.fromiter(total.values(), dtype=np.float64, count=len(total))


def fit(texts: list[str], posterior: np.ndarray, weight: np.ndarray, dims: int = DIMS, rounds: int = 300,
        decay: float = 1e-4) -> dict:
    """Weighted logistic regression against soft labels. Full-batch, deterministic."""
    rows = [features(t, dims) for t in texts]
    at = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    ids = np.concatenate([i for i, _ in rows]) if rows else np.zeros(0, np.int64)
    val = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    weight = weight / max(weight.sum(), 1e-12)
    w, b = np.zeros(dims), 0.0
    gw, gb = np.zeros(dims), 0.0
    for _ in range(rounds if len(rows) else 0):  # per-weight step sizes from past gradients
        z = np.bincount(at, val * w[ids], minlength=len(rows)) + b
        err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - posterior)
        g, g0 = np.bincount(ids, val * err[at], minlength=dims) + decay * w, err.sum()
        gw += g * g
        gb += g0 * g0
        w -= 0.5 * g / (np.sqrt(gw) + 1e-8)
        b -= 0.5 * g0 / (math.sqrt(gb) + 1e-8)
    return {"weights": w.astype(np.float32), "bias": float(b), "dims": dims}


def score(text: str | None, model: dict) -> float | None:
    if not text or not text.split():
        return None
    ids, val = features(text, model["dims"])
    z = float(val @ model["weights"][ids]) + model["bias"]
    return 1 / (1 + math.exp(-max(min(z, 30.0), -30.0)))


# ---- Spark -------------------------------------------------------------------------
def vote_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, pattern, rank): the labellers' votes as digits, and a seeded order of the rows."""
    @F.pandas_udf("string")
    def pattern(texts: pd.Series) -> pd.Series:
        return pd.Series(["".join(map(str, votes(t))) for t in texts], dtype=object)
    return docs.select(F.col(doc_id).alias("doc_id"), pattern(F.col(text)).alias("pattern"))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS,
          per_pattern: int = PER_PATTERN, seed: int = SEED) -> dict:
    """Label model over all documents, then the scorer on the bounded sample."""
    table = vote_table(docs, doc_id, text).withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).checkpoint()
    counted = table.groupBy("pattern").count().orderBy("pattern").toPandas()  # at most 4^12 rows
    if not len(counted):
        return {"weights": np.zeros(DIMS, np.float32), "bias": 0.0, "dims": DIMS, "label_model": None}
    pats = np.array([[int(c) for c in p] for p in counted["pattern"]])
    lm = expectation_maximisation(pats, counted["count"].to_numpy(float))
    spark = docs.sparkSession
    post = spark.createDataFrame(pd.DataFrame({"pattern": counted["pattern"], "n": counted["count"], "posterior": lm["posterior"]}))
    # rows of a pattern are thinned by hash on the mapper to a small multiple of what is wanted before
    # they are ranked, so no window holds more than a bounded number of rows in expectation
    # 1/share is also the weight of a training row, so that the fit follows the corpus
    share = F.least(F.lit(4.0) * per_pattern / F.col("n"), F.lit(1.0))
    thin = table.join(F.broadcast(post), "pattern") \
        .where((F.shiftrightunsigned("h", 11).cast("double") / float(1 << 53) < share) & F.col("doc_id").isNotNull())
    rank = thin.withColumn("r", F.row_number().over(Window.partitionBy("pattern").orderBy("h", "doc_id"))) \
        .where(F.col("r") <= per_pattern)
    picked = rank.where(F.instr("pattern", "0") + F.instr("pattern", "1") > 0).orderBy("r", "h", "doc_id") \
        .limit(train_rows).select(F.col("doc_id").alias("_id"), "posterior", (1 / share).alias("weight")) \
        .dropDuplicates(["_id"])
    # bounded by train_rows: small enough to send to every task instead of moving all texts
    sample = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")) \
        .join(F.broadcast(picked), "_id").groupBy("_id").agg(F.min("posterior").alias("posterior"),
                                                             F.min("weight").alias("weight"),
                                                             F.min("_text").alias("_text")).orderBy("_id").toPandas()
    sample = sample[sample["_text"].notna()]
    model = fit(sample["_text"].tolist(), sample["posterior"].to_numpy(float),
                sample["weight"].to_numpy(float))
    return model | {"label_model": lm | {"patterns": counted["pattern"].tolist()}}


def classify(docs: DataFrame, model: dict | None = None, threshold: float = THRESHOLD, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(doc_id, score, keep) per row; trains on ``docs`` unless a model is given."""
    judged = docs.select(F.col(doc_id).alias("doc_id"), scorer(docs, model, doc_id, text).alias("score"))
    return judged.withColumn("keep", F.coalesce(F.col("score") >= threshold, F.lit(False)))


def scorer(docs: DataFrame, model: dict | None, doc_id: str, text: str) -> Column:
    """The score of ``docs``' texts as a column; the model (a fixed number of weights) is broadcast."""
    model = model or train(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("weights", "bias", "dims")})

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series([score(t, shared.value) for t in texts], dtype="float64")
    return judge(F.col(text))


def keep_good(docs: DataFrame, model: dict | None = None, threshold: float = THRESHOLD, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns, in one pass over the texts."""
    return docs.where(scorer(docs, model, doc_id, text) >= threshold)


def query(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
