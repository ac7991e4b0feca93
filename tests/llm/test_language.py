import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderflow.llm import language as M
from tests.conftest import SF

WORDS = {"en": "the and of with have this from they would there which their about people".split(),
         "de": "der und die nicht mit auch eine sich werden haben über können während schön".split(),
         "el": "και του της που από στην είναι για αυτό όπως μετά".split()}


def corpus(n=90, seed=1):
    rng = random.Random(seed)
    langs = sorted(WORDS)
    return [(i, " ".join(rng.choices(WORDS[langs[i % 3]], k=rng.randint(5, 30))), langs[i % 3], "src", 1.0) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")


def HELD():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def plain_counts(text):
    """n-grams of the folded text, one by one."""
    codes, prev = [0], 0
    for ch in text + " ":
        c = (ord(ch.lower()) if len(ch.lower()) == 1 else ord(ch)) if ch.isalpha() else 0
        if c or prev:
            codes.append(c)
        prev = c
    def mixed(parts, add):
        h = (sum(c * k for c, k in zip(reversed(parts), (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))) + add) & 0xFFFFFFFF
        h ^= h >> 15
        return (h * 0x2C1B3C6D & 0xFFFFFFFF) >> (32 - M.BITS)
    out = Counter(mixed([c], 0) for c in codes[1:] if c)
    out += Counter(mixed(codes[i - 1:i + 1], 0x27D4EB2F) for i in range(1, len(codes)))
    out += Counter(mixed(codes[i - 2:i + 1], 0x165667B1) for i in range(2, len(codes)))
    return out


@pytest.mark.parametrize("text", ["", "a", "Ab, c!!", "  İß 12 ǅ", "漢字𠀀 x𝔸", "über" * 50, "a" * 37])
def test_grams_equal_plain_count_whatever_the_piece(text, monkeypatch):
    want = plain_counts(text)
    for piece in (1, 2, 3, 7, 1 << 20):
        monkeypatch.setattr(M, "PIECE", piece)
        ids, n = M.gram_counts(text)
        assert dict(zip(ids.tolist(), n.tolist())) == dict(want)


def test_document_frequencies_cover_all_rows(spark):
    rows = corpus()
    df = M.document_frequencies(frame(spark, rows).repartition(5))
    want = Counter(g for r in rows for g in plain_counts(r[1]))
    assert {int(i): int(df[i]) for i in np.flatnonzero(df)} == dict(want)


def test_update_is_follow_the_regularised_leader():
    """One coordinate against the textbook recurrence."""
    m = M.Leader(2, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z = n = 0.0
    for step, y in enumerate([0, 1, 0, 0, 1, 0]):
        w = 0.0 if abs(z) <= 0.1 else -(z - math.copysign(0.1, z)) / ((1.0 + math.sqrt(n)) / 0.5 + 0.2)
        ids, x = np.array([7]), np.array([0.8], dtype=np.float32)
        assert abs(m.weights(ids)[0, 0] - w) < 1e-6
        both = m.weights(np.array([7, 1 << M.BITS]))
        g = float(x[0]) * (M.softmax(both[0] * float(x[0]) + both[1])[0] - (y == 0))
        z, n = z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5 * w, n + g * g
        m.learn(ids, x, y)
    assert np.count_nonzero(m.weights(np.arange(100))) == 2


def test_temperature_minimises_the_log_loss():
    rng = np.random.default_rng(0)
    logits = rng.standard_normal((4000, 3)) * 3
    y = np.array([rng.choice(3, p=M.softmax(v / 2.5)) for v in logits])
    assert abs(M.temperature(logits, y) - 2.5) < 0.25


def test_predicts_held_out_rows_and_states_odd_cases(spark):
    rows = corpus()
    rows += [(1000, None, "en", None, None), (1001, "", "en", None, None), (1002, "12 %% 34", "de", None, None),
             (None, "the people and their", "en", None, None), (1003, "und nicht auch über", None, None, None),
             (1004, "και του της " * 40_000, "el", None, None), rows[0], rows[0]]
    got = M.identify(frame(spark, rows).withColumn("held_out", F.lit("x")), HELD())
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = got.collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and sum(r.doc_id == rows[0][0] for r in got) == 3
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1000, 1001, 1002))
    assert by_id[None].lang_pred == "en" and by_id[None].held_out is False
    assert by_id[1003].lang_pred == "de" and by_id[1004].lang_pred == "el"
    assert all(by_id[r[0]].lang_pred == r[2] and 0 < by_id[r[0]].score <= 1 for r in rows[:90])
    assert any(by_id[r[0]].held_out for r in rows[:90])


def test_lang_source_and_id_are_no_inputs(spark):
    rows = corpus()
    learn, ask = [r for r in rows if r[0] < 60], [r for r in rows if r[0] >= 60]
    held = F.col("doc_id") >= 60
    one = {r.doc_id: (r.lang_pred, r.score) for r in M.identify(frame(spark, learn + ask), held).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in M.identify(frame(spark, learn + [(*r[:2], "zz", *r[3:]) for r in ask]), held).collect()}
    assert one == two


def test_nothing_or_one_language_to_learn(spark):
    rows = corpus(6)
    assert M.identify(frame(spark, []), HELD()).count() == 0
    assert {(r.lang_pred, r.score) for r in M.identify(frame(spark, [(*r[:2], None, *r[3:]) for r in rows]), HELD()).collect()} == {("und", 0.0)}
    assert {(r.lang_pred, round(r.score, 9)) for r in M.identify(frame(spark, [(*r[:2], "en", *r[3:]) for r in rows]), HELD()).collect()} == {("en", 1.0)}


def test_sample_is_bounded_and_counts_copies_once(spark):
    rows = corpus(60) + [(i, "copy of the people", "en", None, None) for i in range(100, 160)]
    got = M.sample(frame(spark, rows), 3, 30).collect()
    assert Counter(r.lang for r in got) == {k: 10 for k in WORDS}
    assert len({(r.lang, r.h) for r in got}) == 30


def test_held_out_accuracy_on_the_table(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = [r for r in M.query(spark, SF).collect() if r.held_out and r.lang_pred != "und"]
    assert sum(docs[r.doc_id] == r.lang_pred for r in got) >= 0.97 * len(got)
