import pytest
from conftest import rows

from cropledger.operators import lookup, reshape


def test_pivot_wider(make):
    df = make("k string, e string, v double", [("a", "x", 1.0), ("a", "y", None), ("b", "y", 2.0), ("c", "z", 3.0)])
    wide = reshape.pivot_wider(df, ["k"], "e", "v", ["x", "y", "z"])
    assert rows(wide) == [("a", 1.0, None, None), ("b", None, 2.0, None), ("c", None, None, 3.0)]
    assert rows(reshape.pivot_wider(df, ["k"], "e", "v", ["x", "y", "z"], fill=0.0).drop("z")) == [("a", 1.0, 0.0), ("b", 0.0, 2.0), ("c", 0.0, 0.0)]
    assert rows(reshape.pivot_wider(df, ["k"], "e", "v")) == rows(wide)
    with pytest.raises(Exception, match="more than one value"):
        reshape.pivot_wider(df.union(df), ["k"], "e", "v", ["x", "y", "z"]).collect()
    with pytest.raises(Exception, match="outside the listed members: z"):
        reshape.pivot_wider(df, ["k"], "e", "v", ["x", "y"]).collect()
    with pytest.raises(Exception, match="outside the listed members: NULL"):
        reshape.pivot_wider(make("k string, e string, v double", [("a", None, 1.0)]), ["k"], "e", "v", ["x"]).collect()


def test_pivot_longer_keeps_missing(make):
    df = make("k string, x double, y double", [("a", 1.0, None)])
    assert rows(reshape.pivot_longer(df, ["x", "y"])) == [("a", "x", 1.0), ("a", "y", None)]


def test_split_code(make):
    df = make("c string, v int", [("Corn_B1_IRR_hi", 1)])
    assert rows(reshape.split_code(df, "c", ["l", "b", "i", "m"])) == [(1, "Corn", "B1", "IRR", "hi")]
    assert reshape.split_code(df, "c", ["l", "b"], keep=True).columns == ["c", "v", "l", "b"]


def test_densify(make):
    df = make("Region string, Item string, Value double", [("A", "x", 1.0), ("A", "y", None), ("B", "x", 2.0)])
    assert rows(reshape.densify(df, "Item", "Value")) == [("A", "x", 1.0), ("A", "y", 0.0), ("B", "x", 2.0), ("B", "y", 0.0)]
    assert rows(reshape.densify(df, "Item", "Value", members=["x", "z"])) == [
        ("A", "x", 1.0), ("A", "z", 0.0), ("B", "x", 2.0), ("B", "z", 0.0)
    ]
    with pytest.raises(Exception, match="repeated key"):
        reshape.densify(df.union(df), "Item", "Value").collect()


def test_complete_grid(make):
    df = make(
        "region string, basin string, f string, year int, value double",
        [("r", "1", "p", 2015, 1.0), ("r", "1", "q", 2020, None), ("off", "9", "p", 2015, 5.0)],
    )
    grid = make("region string, basin string", [("r", "1"), ("r", "2")])
    assert rows(reshape.complete_grid(df, grid, ["region", "basin"], "value", "f")) == [
        ("r", "1", "p", 2015, 1.0), ("r", "1", "q", 2020, 0.0),
        ("r", "2", "p", 2015, 0.0), ("r", "2", "p", 2020, 0.0), ("r", "2", "q", 2015, 0.0), ("r", "2", "q", 2020, 0.0),
    ]
    assert reshape.complete_grid(df.drop("f"), grid, ["region", "basin"], "value").count() == 4


def test_union_all_and_key_difference(make):
    a, b = make("k string, v int", [("a", 1), ("b", 1)]), make("k string, w int", [("a", 2)])
    assert rows(reshape.union_all([a, b]), "k", "v", "w") == [("a", None, 2), ("a", 1, None), ("b", 1, None)]
    assert rows(reshape.key_difference(a, b, ["k"])) == [("b",)]


def test_members_in_blocks_give_the_same_rows(make, monkeypatch):
    df = make(
        "k string, item string, facet string, year int, v double",
        [(k, f"i{n}", f"f{n % 3}", 2015 + n % 2, None if n == 4 else float(n)) for n in range(9) for k in ("a", None, "c") if n % 3 or k != "c"],
    )
    grid = make("k string, item string", [("a", "i1"), ("a", "i77"), ("c", "i1"), ("z", "i2")])
    slim = df.select("k", "item", "v")

    def every(many):
        return [
            rows(reshape.densify(slim, "item", "v", many=many)), rows(reshape.densify(df.drop("facet"), "item", "v", many=many)),
            rows(reshape.complete_grid(df, grid, ["k", "item"], "v", "facet", many=many)),
            rows(reshape.complete_grid(df.drop("facet"), grid, ["k", "item"], "v", many=many)),
            rows(reshape.complete_grid(df.drop("year"), grid, ["k", "item"], "v", "facet", many=many)),
            rows(reshape.complete_grid(slim, grid, ["k", "item"], "v", many=many)),
            rows(lookup.replicate_over_observed(grid, "year", df, "year", many=many)),
        ]

    whole = every(False)
    assert all(whole) and len(whole[0]) == 27 and every(None) == whole
    for block in (1, 2, 100):
        monkeypatch.setattr(lookup, "BLOCK_MEMBERS", block)
        assert every(True) == whole
    monkeypatch.setattr(lookup, "MOST_MEMBERS", 1)
    assert every(None) == whole
    with pytest.raises(Exception, match="more than 1 members"):
        every(False)
    with pytest.raises(Exception, match="repeated key"):
        reshape.densify(slim.union(slim), "item", "v").collect()


def test_a_dimension_of_many_members(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MOST_MEMBERS", 1_000)
    monkeypatch.setattr(lookup, "BLOCK_MEMBERS", 100)
    cells = spark.range(5_000).selectExpr("id % 7 AS k", "concat('m', id) AS item", "CAST(id AS double) AS v")
    dense = reshape.densify(cells, "item", "v")
    assert dense.count() == 35_000 and dense.agg({"v": "sum"}).first()[0] == sum(range(5_000))
    plan = dense._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
