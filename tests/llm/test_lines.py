import random
import re

from tenderflow.llm import lines as L


def brute(rows, min_words=2):
    """Kept text per (doc_id, text): every maximal run that occurs earlier is deleted, found by comparing all starts."""
    docs = sorted({(i if i is not None else 1 << 63, t) for i, t in rows if t is not None},
                  key=lambda d: (d[0], d[1]))
    seqs = [[(k, s) for k, s in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", s)] for _, t in docs]
    kept = {}
    for x, (d, t) in enumerate(docs):
        seq, gone = seqs[x], set()
        for s in range(len(seq)):
            best = 0
            for y in range(x + 1):
                other = seqs[y]
                for e in range(len(other) if y < x else s):
                    n = 0
                    while s + n < len(seq) and e + n < len(other) and seq[s + n][1] == other[e + n][1]:
                        n += 1
                    best = max(best, n)
            if best > 1 or best == 1 and len(seq[s][1].split()) >= min_words:
                gone |= set(range(s, s + best))
        lines, drop = t.split("\n"), {seq[g][0] for g in gone}
        for a in gone:
            if a + 1 in gone:
                drop |= set(range(seq[a][0], seq[a + 1][0]))
        kept[d, t] = ("\n".join(v for k, v in enumerate(lines) if k not in drop), len(gone))
    return kept


def check(docs_of, rows):
    got = L.dedup(docs_of(rows), deleted="lines_deleted")
    assert got.columns == [*docs_of(rows).columns, "lines_deleted"]
    want = brute(rows)
    expect = [(i, *(want[i if i is not None else 1 << 63, t] if t is not None else (None, 0))) for i, t in rows]
    assert sorted(map(str, [(r.doc_id, r.text, r.lines_deleted) for r in got.collect()])) == sorted(map(str, expect))


def test_random_documents_equal_brute_force(docs_of):
    rng = random.Random(4)
    vocab = ["one", "two words", "three of them", "", "  ", "x", "y z"]
    rows = [(i, "\n".join(rng.choice(vocab + [f"own line {i} {k}"] * 4) for k in range(rng.randint(0, 14)))) for i in range(25)]
    block = "\n".join(f"shared passage line {k}" for k in range(9))
    rows += [(30 + i, f"head {i}\n{block}\n\ntail {i}") for i in range(4)] + [(40, block), (41, "\n".join(block.split("\n")[2:7]))]
    check(docs_of, rows)


def test_odd_rows(docs_of):
    long = "\n".join(["same old line"] * 40)  # overlapping copies inside one document
    check(docs_of, [(1, None), (2, ""), (3, "\n\n"), (4, long), (5, long), (5, long), (None, "a b\nc"), (6, "a b\nc"), (7, "c")])


def test_empty(docs_of):
    assert L.dedup(docs_of([(1, "a")]).where("false")).count() == 0
    assert [r.text for r in L.dedup(docs_of([(1, None), (2, " ")])).collect()] == [None, " "]
