import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tenderflow.llm import manifest as M

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, add=0):
    doc_id, text, lang, source, n = r
    n = n + add if n is not None else None
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def fold(nodes, at, h):
    """(last node, siblings passed, folded hash) of the tree over ``nodes`` from position ``at`` with hash ``h``."""
    sibs = []
    while len(nodes) > 1:
        pair = nodes[at - at % 2:at - at % 2 + 2]
        sibs += [x for k, x in enumerate(pair) if k != at % 2]
        h = sha("".join(h if k == at % 2 else x for k, x in enumerate(pair)))
        nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        at //= 2
    return nodes[0], sibs, h


def brute(rows):
    def start(r):
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        return leaf(r, 1 if hit else 0)
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), start(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: x[:4])
    subs = [fold([x[2] for x in groups[g]], 0, "")[0] for g in names]
    out = []
    for k, g in enumerate(names):
        for at, (_, _, h, s, r) in enumerate(groups[g]):
            sub, one, folded = fold([x[2] for x in groups[g]], at, s)
            root, two, folded = fold(subs, k, folded)
            out.append((r[0], h, sub, root, sha("".join(one + two)), folded, folded == root))
    return sorted(map(str, out))


def run(spark, rows, stride=M.STRIDE):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], COLUMNS)
    fields = [F.col(c) for c in M.FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    n = F.when(hit, (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")).otherwise(F.col("n_chars").cast("string"))
    got = M.manifest(df, "doc_id", "lang", fields, [n if c == "n_chars" else F.col(c) for c in M.FIELDS], stride)
    return sorted(str(tuple(r)) for r in got.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                                    "verified").collect())


def rows_of(n, langs):
    return [(i, f"text {i} é", langs[i % len(langs)], f"s{i % 3}", i * 10) for i in range(n)]


EDGES = [(1, None, None, None, None), (None, "", "", "s", 5), (None, "x", "en", "s", 2**63 - 1), (5, "y" * 300_000, "en", "s", 1),
         (5, "other", "en", "s", 1), (6, "same", "en", "s", 3), (6, "same", "en", "s", 3), (7, "z", "é", None, None),
         (2**63 - 1, "big", "en", "s", 2**63 - 1), (-3, "neg", "en", "s", 0)]


@pytest.mark.parametrize("rows,stride", [(rows_of(1, ["en"]), 4), (rows_of(2, ["en", "de"]), 4), (rows_of(38, ["en"]), 2),
                                         (rows_of(70, ["en", "en", None, "de", "fr"]), 2), (rows_of(19, ["a"]) + EDGES, 4)])
def test_equals_brute_force(spark, rows, stride):
    assert run(spark, rows, stride) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_recursion_limit_is_put_back(spark):
    before = spark.conf.get(M.ROW_LIMIT, None)
    run(spark, rows_of(5, ["en"]))
    assert spark.conf.get(M.ROW_LIMIT, None) == before


def test_any_tampered_field_is_found(spark):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows_of(9, ["en", "de"])], COLUMNS)
    fields = [F.col(c) for c in M.FIELDS]
    for c in M.FIELDS:
        broken = [F.concat(F.col(f).cast("string"), F.lit("0")) if f == c else F.col(f) for f in M.FIELDS]
        assert {r.verified for r in M.manifest(df, "doc_id", "lang", fields, broken).collect()} == {False}
    assert {r.verified for r in M.manifest(df, "doc_id", "lang", fields).collect()} == {True}
