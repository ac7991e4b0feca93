import random

import numpy as np

from tenderflow.llm import decontamination as D


def brute_score(item, part):
    """Textbook Smith-Waterman, cell by cell."""
    h = [[0] * (len(part) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(part) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (D.MATCH if item[i - 1] == part[j - 1] else D.MISMATCH), h[i - 1][j] + D.GAP,
                          h[i][j - 1] + D.GAP)
    return max(map(max, h))


def test_alignment_equals_textbook():
    rng = random.Random(5)
    for _ in range(60):
        item = np.array([rng.randrange(6) for _ in range(rng.randint(1, 12))])
        part = np.array([rng.randrange(6) for _ in range(rng.randint(1, 25))])
        score, a, e = D.align(item, part)
        assert score == brute_score(item.tolist(), part.tolist())
        if score:
            assert D.align(item, part[a:e])[0] == score


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


def corpus():
    rng = random.Random(6)
    items = [(k, " ".join(words(rng, rng.randint(15, 40)))) for k in range(12)]
    docs, leaks = [], set()
    for i in range(120):
        w = words(rng, rng.randint(60, 200))
        if i % 3 == 0:  # verbatim, edited and paraphrased copies; the first item is copied very often
            k = 0 if i % 2 else rng.randrange(12)
            copy = items[k][1].split()
            for _ in range((i % 4) * len(copy) // 20):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["new"], [copy[at], "extra"]])
            at = rng.randrange(len(w))
            w[at:at] = copy
            leaks.add((i, k))
        docs.append((i, " ".join(w).upper() + "."))
    return docs, items, leaks


def test_planted_copies_are_found_and_clean_documents_left(spark, docs_of):
    docs, items, leaks = corpus()
    df, bench = docs_of(docs), spark.createDataFrame(items, "item_id long, text string")
    for way in ({}, {"rare_items": 0}, {"rare_items": 0, "pair_keys": 0}):
        got = D.contaminations(df, bench, **way).collect()
        pairs = {(r.doc_id, r.item_id) for r in got}
        assert pairs == leaks
    text = dict(docs)
    for r in got:
        part = D.words_of(text[r.doc_id])[r.start_word:r.end_word]
        assert abs(brute_score(dict(items)[r.item_id].split(), part) / (2 * len(dict(items)[r.item_id].split())) - r.score) < 1e-9
    clean = D.keep_clean(df, bench)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in leaks}


def test_odd_rows(spark, docs_of):
    item = " ".join(f"b{k}" for k in range(20))
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, "too short"), (4, "")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "x " * 3000 + item), (None, item), (5, item), (5, item), (6, "too short")]
    got = D.contaminations(docs_of(rows), bench).collect()
    assert sorted(str(r.doc_id) for r in got) == ["3", "5", "5", "None"] and {r.item_id for r in got} == {1}
    assert all(r.score == 1.0 for r in got) and {r.start_word for r in got if r.doc_id == 3} == {3000}
    assert D.contaminations(docs_of(rows).where("false"), bench).count() == 0
    assert D.contaminations(docs_of(rows), bench.where("false")).count() == 0
    assert D.keep_clean(docs_of(rows), bench.where("false")).count() == len(rows)


def test_common_copies_are_found_like_single_ones(spark, docs_of):
    """One edited or truncated copy repeated over a corpus of under 10,000 documents: every seed it holds is frequent."""
    rng = random.Random(11)
    edited, cut, other = ([f"{c}{k}" for k in range(40)] for c in "ecx")
    bench = spark.createDataFrame([(1, " ".join(edited)), (2, " ".join(cut)), (3, " ".join(other))], "item_id long, text string")
    for at in (6, 13, 20, 27, 34):
        edited[at] = "changed"
    passage = {1: edited, 2: cut[:21], 3: other[:8] + ["else"] * 32}
    docs, want = [], set()
    for i in range(90):
        k = i % 3 + 1
        # a seed that no other document has must not draw the search away from the copy
        lone = other[20:24] if i == 6 else []
        docs.append((i, " ".join(words(rng, 50) + passage[k] + words(rng, 50) + lone)))
        want |= {(i, k)} - {(i, 3)}
    df = docs_of(docs)
    got = D.contaminations(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    for r in got:
        item = [f"{'ec'[r.item_id - 1]}{k}" for k in range(40)]
        assert abs(r.score - brute_score(item, dict(docs)[r.doc_id].split()) / 80) < 1e-9
    assert {r.doc_id for r in D.keep_clean(df, bench).collect()} == {i for i, _ in docs} - {i for i, _ in want}


def stem_corpus(rng, n_items, n_docs=60):
    """Items with a stem in common; documents with stems alone, whole and edited copies."""
    stem = "which of the following is the best known of all".split()
    items = [(k, " ".join(stem + words(rng, rng.randint(4, 30), 60))) for k in range(n_items)]
    docs = []
    for i in range(n_docs):
        w = words(rng, rng.randint(0, 80), 60)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(w))
            w[at:at] = stem
        if i % 3 == 0:
            copy = items[rng.randrange(n_items)][1].split()
            for _ in range(rng.randint(0, len(copy) // 4)):
                copy[rng.randrange(len(copy))] = "edit"
            at = rng.randint(0, len(w))
            w[at:at] = copy
        docs.append((i, " ".join(w)))
    return docs, items


def test_whole_query_equals_all_documents_by_all_items(spark, docs_of):
    """Every pair aligned around every seed, without rarity, keys or filter, gives the same rows."""
    docs, items = stem_corpus(random.Random(21), 40)
    items += [(100, items[0][1]), (0, items[1][1])]  # one text under two ids, one id with two texts
    want = sorted((i, k, round(m["score"], 9), m["start_word"], m["end_word"], m["seeds"])
                  for i, t in docs for k, item in items for m in D.matches(t, D.build_index([(k, item)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for way in ({}, {"rare_items": 0}, {"pair_keys": 0}):
        got = D.contaminations(docs_of(docs), bench, **way).collect()
        assert sorted((r.doc_id, r.item_id, round(r.score, 9), r.start_word, r.end_word, r.seeds) for r in got) == want
    assert len(want) > 20 and {i for i, *_ in want} != {i for i, _ in docs}
    clean = D.keep_clean(docs_of(docs), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, *_ in want}


def test_a_common_stem_does_not_meet_every_item(spark):
    """Keys of a document that holds the stem alone, twenty times: the same few at 50 items and at 800."""
    rng = random.Random(4)
    stem = "which of the following is".split()
    text = " ".join(x for _ in range(20) for x in stem + [f"plain{rng.randrange(10**6)}" for _ in range(95)])
    for size in (50, 800):
        items = [(k, " ".join(stem + [f"i{k}x{j}" for j in range(25)])) for k in range(size)]
        texts, _ = D.item_texts(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
        keys = D.item_keys(texts)
        bitmap, classes = D.key_filter(keys)
        found = D.document_keys([text], bitmap, classes)[0].view("int64").tolist()
        assert keys.where("k is not null").where(keys.key.isin(found or [0])).count() == 0
        whole = D.document_keys([items[7][1]], bitmap, classes)[0].view("int64").tolist()
        assert {r.k for r in keys.where("k is not null").where(keys.key.isin(whole)).select("k").distinct().collect()} == {
            r.k for r in texts.where(texts.t == items[7][1]).collect()}


def test_a_full_filter_loses_nothing():
    texts = ["a b c d e f", None, "", "x y z w v", "a b"]
    every = np.full(64, 2**64 - 1, dtype=np.uint64)
    got = D.document_keys(texts, every, [3])
    assert [len(g) > 0 for g in got] == [True, False, False, True, False]
    assert all(len(g) == 0 for g in D.document_keys(texts, np.zeros(64, np.uint64), [3]))
