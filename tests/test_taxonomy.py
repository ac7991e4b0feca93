from pyspark.sql import functions as F

from tenderflow.operators import taxonomy as TX

CODES = [("63712321", "Tunnel toll services"), ("63712000", "a"), ("63710000", "b"), ("63700000", "c"),
         ("63000000", "d"), ("60112000", "e"), ("60100000", "f"), ("60000000", "g"), ("10000000", "h"),
         ("33000000", "i"), ("30000000", "j")]


def dim(spark):
    return TX.cpv_dim(spark.createDataFrame(CODES, "code string, label string"))


def test_cpv_rank_parent_ancestors(spark):
    d = {r.code: r for r in dim(spark).collect()}
    assert d["63712321"].rank == 4 and d["60112000"].rank == 3
    assert [d["63712321"][f"anc{r}"] for r in range(5)] == ["63000000", "63700000", "63710000", "63712000", "63712321"]
    assert [d["60112000"][f"anc{r}"] for r in range(5)] == ["60000000", "60100000", "60100000", "60112000", None]
    assert d["63712321"].parent == "63712000"
    assert d["60112000"].parent == "60100000"       # 60110000 is not in the list
    assert d["10000000"].parent is None
    assert d["33000000"].parent == "30000000"       # k=1 candidate
    assert d["63712321"].label == "Tunnel toll services"


def test_cpv_list_operators(spark):
    lots = spark.createDataFrame([(1, ["63712321", "12345678", "60112000"]), (2, None)], "id int, codes array<string>")
    out = {r.id: r for r in TX.cpv_list_columns(lots, "id", "codes", dim(spark), labels=False).collect()}
    assert out[1].cpv_level == [4, None, 3]
    assert out[1].cpv_parent == ["60100000", "63712000"]
    assert out[1].cpv0 == ["60000000", "63000000"]
    assert out[1].codes == ["63712321", "12345678", "60112000"]
    assert out[2].cpv_level is None and out[2].cpv_parent is None


def test_unknown_code_scalar(spark):
    df = spark.createDataFrame([("12345678",), ("63712321",)], "c string")
    r = {x.c: x.p for x in TX.cpv_parent_by_rank(df, "c", dim(spark), 2, "p").collect()}
    assert r == {"12345678": None, "63712321": "63710000"}
    r = {x.c: x.p for x in TX.cpv_parent_by_rank(df, "c", dim(spark), 5, "p").collect()}
    assert r["63712321"] is None


def test_taxonomy_levels_missing_parent(spark):
    # parent-pointer taxonomy: X's parent is absent from the list -> one hop, then the walk ends
    tax = spark.createDataFrame([("A", None), ("B", "A"), ("C", "B"), ("D", "C"), ("X", "MISSING")],
                                "code string, parent string")
    lv = {r.code: r for r in TX.taxonomy_levels(tax, max_level=3).collect()}
    assert lv["A"].level == 0 and lv["D"].level == 3 and lv["X"].level == 1
    assert (lv["D"].lvl0, lv["D"].lvl1, lv["D"].lvl2, lv["D"].lvl3) == ("A", "B", "C", "D")
    assert lv["X"].lvl0 == "MISSING"


def test_nuts_code_by_level(spark):
    nuts = spark.createDataFrame([("FR",), ("FRK",), ("FRK26",)], "code string")
    df = spark.createDataFrame([("FRK26",), ("",), (None,)], "c string")
    r = [x.o for x in TX.nuts_code_by_level(df, "c", nuts, 1, "o").orderBy("c").collect()]
    r2 = {x.c: x.o for x in TX.nuts_code_by_level(df, "c", nuts, 2, "o").collect()}
    assert "FRK" in r and r2["FRK26"] is None     # FRK2 does not exist


def test_deep_taxonomy_and_cycle(spark):
    import pytest

    from tenderflow.operators.taxonomy import ancestor_closure, taxonomy_levels
    deep = spark.createDataFrame([(f"{i:03d}", f"{i - 1:03d}" if i else None, "x") for i in range(30)],
                                 "code string, parent string, label string")
    assert {r.code: r.level for r in taxonomy_levels(deep).collect()} == {f"{i:03d}": i for i in range(30)}
    loop = spark.createDataFrame([("a", "b", "x"), ("b", "c", "x"), ("c", "b", "x")], "code string, parent string, label string")
    with pytest.raises(ValueError):
        ancestor_closure(loop)
