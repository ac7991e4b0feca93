import random

import numpy as np

from tenderflow.llm import quality as Q


def natural(rng, n):
    vocab = "the of and to in is it that was for on are as with his they at be this from have or by one had not but what all were when we".split() \
        + [f"{a}{b}{c}" for a in ("gar", "mon", "tel", "sin") for b in ("da", "ri", "vo") for c in ("n", "st", "ble")]
    out = []
    for _ in range(n // 9 + 1):
        s = [rng.choice(vocab) for _ in range(9)]
        out.append(s[0].capitalize() + " " + " ".join(s[1:]) + ".")
    return " ".join(out)


def junk(rng, n):
    base = natural(rng, n).split()
    kind = rng.randrange(4)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in base)
    if kind == 1:
        return " | ".join(w for w in base)
    if kind == 2:
        return " ".join(w + rng.choice(["%%%", "$$$", "###"]) for w in base)
    return " ".join(w for w in rng.sample(base, 4) for _ in range(n // 4))


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(6000) < 0.8
    acc = [0.95, 0.9, 0.85, 0.8, 0.75] + [0.7] * (len(Q.LABELLERS) - 5)  # on bad documents; 0.99 on good ones
    votes = np.stack([np.where(rng.random(6000) < np.where(truth, 0.99, a), truth, ~truth).astype(int) for a in acc], axis=1)
    votes[rng.random(votes.shape) < 0.2] = Q.SILENT
    pats, counts = np.unique(votes, axis=0, return_counts=True)
    m = Q.expectation_maximisation(pats, counts.astype(float))
    assert abs(m["prior"] - 0.8) < 0.03
    assert all(abs(m["accuracy"][n] - (0.8 * 0.99 + 0.2 * a)) < 0.03 for n, a in zip(Q.LABELLERS, acc))


def test_held_out_accuracy(docs_of):
    rng = random.Random(1)
    rows = [(i, (junk if i % 6 == 0 else natural)(rng, rng.randint(20, 200))) for i in range(600)]
    model = Q.train(docs_of(rows[:400]))
    got = {r.doc_id: r.keep for r in Q.classify(docs_of(rows[400:]), model).collect()}
    wrong = [i for i, keep in got.items() if keep != (i % 6 != 0)]
    assert len(got) == 200 and len(wrong) <= 4


def test_odd_rows(docs_of):
    rng = random.Random(2)
    rows = [(i, (junk if i % 4 == 0 else natural)(rng, 60)) for i in range(80)]
    odd = [(100, None), (101, ""), (102, " \n"), (None, rows[1][1]), (1, rows[1][1]), (103, "word " * 30000)]
    docs = docs_of(rows + odd)
    got = Q.classify(docs).collect()
    assert len(got) == 86
    assert all(r.score is None and not r.keep for r in got if r.doc_id in (100, 101, 102))
    assert len({r.score for r in got if r.doc_id in (1, None)}) == 1
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)
    assert Q.classify(docs.where("false")).count() == 0
    assert Q.classify(docs_of([(1, None)])).collect()[0].keep is False
