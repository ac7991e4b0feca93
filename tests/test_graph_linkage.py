import itertools

from pyspark.sql import functions as F

from tenderflow.functions.strings import damerau_levenshtein, jaro_winkler
from tenderflow.operators import linkage as LK
from tenderflow.operators.graph import match, optional, pattern, preferred_text, without, of_class
from tenderflow.sources.triples import Graph, parse_ntriples, to_ntriples

NT = [
    '<http://x/l1> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://x/Lot> .',
    '<http://x/l1> <http://x/title> "Titre"@fr .',
    '<http://x/l1> <http://x/title> "Title"@en .',
    '<http://x/l2> <http://x/title> "Tytul \\"A\\""@pl .',
    '<http://x/l2> <http://x/amount> "12.50"^^<http://www.w3.org/2001/XMLSchema#decimal> .',
    '_:b1 <http://x/p> <http://x/o> <http://x/g> .',
    '# comment',
    'this is not a triple',
]


def graph(spark):
    lines = spark.createDataFrame([(x,) for x in NT], "value string")
    t, rej = parse_ntriples(lines)
    return Graph(spark, triples=t), rej


def test_parse_ntriples(spark):
    g, rej = graph(spark)
    assert [r.line for r in rej.collect()] == ["this is not a triple"]
    t = {(r.s, r.o, r.lang, r.dtype, r.g) for r in g.triples().collect()}
    assert ("http://x/l2", 'Tytul "A"', "pl", None, None) in t
    assert ("http://x/l2", "12.50", None, "http://www.w3.org/2001/XMLSchema#decimal", None) in t
    assert ("_:b1", "http://x/o", None, None, "http://x/g") in t


def test_round_trip(spark):
    g, _ = graph(spark)
    t2, rej = parse_ntriples(to_ntriples(g.triples()))
    assert rej.count() == 0
    cols = ["s", "p", "o", "o_kind", "lang", "dtype", "g"]
    assert sorted(map(tuple, t2.select(cols).collect()), key=str) == \
        sorted(map(tuple, g.triples().select(cols).collect()), key=str)


def test_preferred_optional_without(spark):
    g, _ = graph(spark)
    pt = {r.s: r.t for r in preferred_text(g, "http://x/title", "s", "t").collect()}
    assert pt == {"http://x/l1": "Title", "http://x/l2": 'Tytul "A"'}
    assert preferred_text(g, "http://x/title", "s", "t", require_preferred=True).count() == 1
    lots = of_class(g, "http://x/Lot", name="s")
    am = pattern(g, "http://x/amount", "s", "a", cast="decimal(10,2)")
    assert optional(lots, am).first().a is None
    assert without(pattern(g, "http://x/title", "s", "t"), lots).select("s").distinct().count() == 1
    assert match(pattern(g, "http://x/title", "s", "t"), am).count() == 1


def test_string_distances():
    assert damerau_levenshtein("abcd", "abdc") == 1
    assert damerau_levenshtein("kitten", "sitting") == 3
    assert abs(jaro_winkler("MARTHA", "MARHTA") - 0.9611) < 1e-3
    assert jaro_winkler("abc", "abc") == 1.0 and jaro_winkler("", "x") == 0.0


def test_link_reference_fixture(spark):
    df = spark.createDataFrame([("John Doe", "123 Main St", "USA", "r1"), ("J. Doe", "47 Green St", "Canada", "r2"),
                                ("John Doe", "123 Main St", "USA", "r3"), ("J. Doe", "47 Green St", "Canada", "r4")],
                               "name string, address string, country string, test_unique_id string")
    out = LK.link(df, "test_unique_id").collect()
    assert sorted(r.unique_id_src for r in out) == ["r1", "r2", "r3", "r4"]
    assert all(0.8 <= r.match_probability <= 1.0 for r in out)
    assert {r.unique_id_src: r.unique_id_dst for r in out} == {"r1": "r1", "r2": "r2", "r3": "r1", "r4": "r2"}


def _brute_links(rows, threshold=0.8, model=LK.DEFAULT_MODEL):
    """src -> (dst, p) by comparing all pairs of a block."""
    norm = lambda v: (v or "").strip().lower() or None
    root, best = {r[0]: r[0] for r in rows}, {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (i, n1, a1, c1), (j, n2, a2, c2) in itertools.combinations(rows, 2):
        if c1 is not None and c1 == c2:
            p = LK.probability(LK.weight(model, LK.name_level(norm(n1), norm(n2)), LK.address_level(norm(a1), norm(a2))))
            if p >= threshold:
                best[i], best[j] = max(best.get(i, 0), p), max(best.get(j, 0), p)
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {r[0]: (find(r[0]), 1.0 if find(r[0]) == r[0] else best[r[0]]) for r in rows}


LINK_ROWS = [
    ("01", "Acme Ltd", "1 Main Street", "A"), ("02", "Acme Ltd", "77 Harbour Road", "A"), ("03", "Acme Ltd", "77 Harbour Roads", "A"),
    ("04", "Bolt Works", "5 Low Lane", "A"), ("05", "Bolt Work", "5 Low Lane", "A"), ("06", "Blot Work", "5 Low Lane", "A"),
    ("07", None, "9 Hill", "A"), ("08", None, "9 Hill", "A"), ("09", "Zed", None, "A"), ("10", "Zed", None, "A"),
    ("11", "acme ltd ", " 1 main street", "A"), ("12", "Acme Ltd", "1 Main Street", "B"), ("13", "Acme Ltd", "1 Main Street", None),
    ("14", "Acme Ltd", "1 Main Street", None), ("15", "", "", "A"), ("16", "Bolts Works", "5 Low Lane", "A"),
    ("17", "Q", "X", "A"), ("18", "", "X", "A"), ("19", "Acme Ltd", "77 Harbor Road", "A")]


def test_links_equal_all_pairs(spark):
    """Lost-match cases, nulls, transpositions and chains: the same links as comparing every pair of a block."""
    df = spark.createDataFrame(LINK_ROWS, "id string, name string, address string, country string")
    want = _brute_links(LINK_ROWS)
    for size in (LK.BLOCK, 2):
        got = {r.unique_id_src: (r.unique_id_dst, r.match_probability) for r in LK.link(df, "id", block_size=size).collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
    assert want["03"][0] == "02" and want["05"][0] == "04" and want["08"][0] == "08"


def test_long_chain_is_one_component(spark):
    from tenderflow.operators.components import connected
    edges = spark.createDataFrame([(i, i + 1) for i in range(120)], "u long, v long")
    assert {r.root for r in connected(edges).collect()} == {0}
    assert connected(edges).count() == 121
    assert connected(edges.where("false")).count() == 0


def test_reference_id_wins(spark):
    schema = "id string, name string, address string, country string"
    new = spark.createDataFrame([("0", "Acme", "1 Main St", "A"), ("1", "Solo", "2 Side St", "A")], schema)
    ref = spark.createDataFrame([("9", "Acme", "1 Main St", "A")], schema)
    got = {r.unique_id_src: r.unique_id_dst for r in LK.link_to_reference(new, ref, "id").collect()}
    assert got == {"0": "9", "1": "1"}


def test_model_without_shared_keys_is_refused(spark):
    import pytest
    model = {**LK.DEFAULT_MODEL, "name": {**LK.DEFAULT_MODEL["name"], "jw90": (0.9, 1e-9)}}
    prof = LK.profiles(spark.createDataFrame(LINK_ROWS, "id string, name string, address string, country string"),
                       "id", "name", "address", "country")
    with pytest.raises(ValueError):
        LK.links(prof, model)


def test_literal_escapes_round_trip(spark):
    texts = ["C:\\new\\table", "a\\\\b", "tab\there", "line\nbreak", "cr\rhere", 'quote"d', "\\u0041 stays", "é ü 漢 😀", ""]
    t = spark.createDataFrame([("http://s", "http://p", x, "literal", None, None, None) for x in texts],
                              "s string, p string, o string, o_kind string, lang string, dtype string, g string")
    back, rejected = parse_ntriples(to_ntriples(t))
    assert rejected.count() == 0
    assert sorted(r.o for r in back.collect()) == sorted(texts)
    raw = spark.createDataFrame([(r'<http://s> <http://p> "\u0041\U0001F600\uD83D\uDE00\\u0041" .',)], "value string")
    assert parse_ntriples(raw)[0].first().o == "A😀😀\\u0041"


def test_em_estimates_valid_model(spark):
    rows = [(str(i), n, a, "X") for i, (n, a) in enumerate(
        [("acme ltd", "1 main st"), ("acme ltd", "1 main st"), ("acme ltd.", "1 main st"), ("acne ltd", "9 side rd"),
         ("bolt co", "2 high st"), ("bolt co", "2 high st"), ("bolt co", "7 low st"), ("blot co", "2 high st")])]
    df = spark.createDataFrame(rows, "id string, name string, address string, country string")
    prof = LK.profiles(df, "id", "name", "address", "country")
    model = LK.em(LK.pattern_counts(prof))
    for comp in ("name", "address"):
        for m, u in model[comp].values():
            assert 0 < m < 1 and 0 < u < 1
    out = LK.link(df, "id", train=True).collect()
    assert sorted(r.unique_id_src for r in out) == [str(i) for i in range(8)]
    assert all(0.0 <= r.match_probability <= 1.0 for r in out)


def _words(seed, n):
    import random
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(letters) for _ in range(size)) for letters in ("ab", "abc é", "abcdefghij") for size in
            [*range(9)] * 2 + [25, 60]]
    edited = []
    for w in made:
        at = rnd.randrange(len(w) + 1)
        edited += [w[:at] + "z" + w[at:], w[:at] + w[at + 1:], w[:at] + w[at + 1:at + 2] + w[at:at + 1] + w[at + 2:]]
    return sorted({*made, *edited, "", "\U0001f600a", "a\U0001f600"})[:n]


def test_array_distances_equal_the_plain_ones(monkeypatch):
    import numpy as np

    from tenderflow.functions import strings as S
    words = _words(3, 120)
    i, j = map(np.ravel, np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    pool = S.Pool(words)
    want = [jaro_winkler(words[a], words[b]) for a, b in zip(i, j)]
    near = [damerau_levenshtein(words[a], words[b]) <= 1 for a, b in zip(i, j)]
    for cells in (S.CELLS, 500):
        monkeypatch.setattr(S, "CELLS", cells)
        assert (S.jaro_winkler_pairs(pool, i, j) == want).all()
        assert (S.one_edit(pool, i, j) == near).all()
    empty = np.zeros(0, dtype=int)
    assert len(S.jaro_winkler_pairs(S.Pool([]), empty, empty)) == len(S.one_edit(S.Pool([]), empty, empty)) == 0


def test_levels_of_tiles_equal_pair_by_pair(spark):
    """Counts of level patterns over tiles of several groups, nulls and cross blocks, against one comparison a pair."""
    from collections import Counter
    words = _words(5, 60)
    rows = [(f"{n:03d}", words[n % 60] or None, words[(n * 7 + n // 60) % 60] or None, "AB"[n % 2]) for n in range(150)]
    df = spark.createDataFrame(rows, "id string, name string, address string, country string")
    prof = LK.profiles(df, "id", "name", "address", "country").checkpoint()
    model, want = LK.DEFAULT_MODEL, Counter()
    keyed = LK.candidate_keys(prof, model, 0.8).collect()
    groups = {}
    for r in keyed:
        groups.setdefault(r.key, []).append((r.profile, r.name_n, r.address_n))
    for g in groups.values():
        for (p, n1, a1), (q, n2, a2) in itertools.combinations(sorted(g, key=lambda r: r[0]), 2):
            if p != q:
                want[LK.name_level(n1, n2), LK.address_level(a1, a2)] += 1
    for size in (LK.BLOCK, 2):
        got = {(r.gamma_name, r.gamma_address): r.n for r in LK.pattern_counts(prof, model, block=size).collect()}
        assert got == dict(want)
    brute = _brute_links(rows)
    got = {r.unique_id_src: (r.unique_id_dst, r.match_probability) for r in LK.link(df, "id", block_size=4).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in brute.items()}
    assert all(abs(got[k][1] - brute[k][1]) < 1e-12 for k in brute)
