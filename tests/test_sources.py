import pytest
from conftest import rows

from cropledger.sources import catalog as cat
from cropledger.sources import fixed
from cropledger.sources.dims import check_dimension, default_dimensions, read_auxiliary, read_dimension
from cropledger.sources.exports import read_query, splits_of
from cropledger.sources.store import Store, load_exports

TITLE = "Agricultural production\n"
HEADER = "scenario,region,sector,2015,2020,Units,\n"


def put(root, version, scen, query, text):
    folder = root / "proj" / version / scen
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{query}.csv").write_text(text)


@pytest.fixture
def tree(tmp_path):
    put(tmp_path, "v1", "BAU", "prod", TITLE + HEADER
        + '"BAU,date=2024-3-1",USA,Corn,1,2,Mt,\n"BAU,date=2024-3-1",USA,Rice,,5,Mt,\n'
        + TITLE + HEADER + '"BAU,date=2024-3-1",Brazil,Corn,3,4,Mt,\n')
    put(tmp_path, "v1", "EL 2", "prod", TITLE + "scenario,region,sector,2015,2025,Units,\n" + '"EL2,date=x",USA,Corn,7,oops,Mt,\n')
    put(tmp_path, "v1", "EL 2", "broken", "no header here\n1,2\n")
    put(tmp_path, "v2", "BAU", "prod", TITLE + HEADER + "BAU,USA,Corn,9,9,Mt,\n")
    put(tmp_path, "v2", "BAU", "land", TITLE + "scenario,region,LandLeaf,2015,Units,X7,a..b\n" + "BAU,USA,CornC4,1.5,km2,drop,drop\n")
    return str(tmp_path)


def test_catalog(spark, tree):
    listed = cat.list_exports(spark, tree, "proj")
    assert rows(listed, "version", "scen", "query")[0] == ("v1", "BAU", "prod")
    assert listed.count() == 5
    assert rows(cat.versions(listed)) == [("v1",), ("v2",)]
    assert rows(cat.scenarios(listed, ["v2"])) == [("BAU",)]
    assert rows(cat.queries(listed, ["v1"], ["EL 2"])) == [("broken",), ("prod",)]


def test_selection_checks_names(spark, tree):
    listed = cat.list_exports(spark, tree, "proj")
    assert cat.select_exports(listed, in_versions=["v1"], in_queries=["prod"]).count() == 2
    for wrong in ({"in_versions": ["v9"]}, {"in_scens": ["EL 2"], "in_versions": ["v2"]}, {"in_queries": ["none"]}):
        with pytest.raises(cat.NotAvailable):
            cat.select_exports(listed, **wrong)
    with pytest.raises(cat.NotAvailable):
        cat.select_exports(listed, in_versions=[])


def test_read_query_cleans_and_gathers(spark, tree):
    paths = [r["path"] for r in cat.list_exports(spark, tree, "proj").where("query = 'prod' AND version = 'v1'").collect()]
    table = read_query(spark, paths)
    assert rows(table.rows, "scenario", "region", "sector", "Units", "year", "value", "ss") == [
        ("BAU", "Brazil", "Corn", "Mt", 2015, 3.0, "BAU"), ("BAU", "Brazil", "Corn", "Mt", 2020, 4.0, "BAU"),
        ("BAU", "USA", "Corn", "Mt", 2015, 1.0, "BAU"), ("BAU", "USA", "Corn", "Mt", 2020, 2.0, "BAU"),
        ("EL2", "USA", "Corn", "Mt", 2015, 7.0, "EL 2"),
    ]  # the row with a blank year, titles and repeated headers are gone
    assert rows(table.rejected_cells, "year", "text") == [(2025, "oops")]
    assert rows(table.rejected_rows, "text") == [('{"scenario":"BAU,date=2024-3-1","region":"USA","sector":"Rice","2015":null,"2020":"5","Units":"Mt"}',)]


def test_load_exports(spark, tree, tmp_path):
    store = Store(spark, str(tmp_path / "tables"))
    assert load_exports(spark, tree, "proj", store) == ["land", "prod"]
    assert rows(store.load("land"), "LandLeaf", "Units", "value") == [("CornC4", "km2", 1.5)]  # X7 and a..b dropped
    assert store.load("prod").count() == 7
    assert store.load("prod", versions=["v2"], scens=["BAU"]).count() == 2
    assert rows(store.load("rejected_files"), "query", "reason") == [("broken", "no readable export")]
    assert rows(store.load("rejected_cells"), "query", "year", "text") == [("prod", 2025, "oops")]
    load_exports(spark, tree, "proj", store, versions=["v2"], queries=["prod"])
    assert store.load("prod").count() == 7  # the other version's partitions stay
    assert all(store.load(f"rejected_{what}").count() == 0 for what in ("files", "rows", "cells"))


@pytest.mark.parametrize("scen", ["SSP2+CC", "a b", "50%25", "a[1]{2}", "proj", "100%"])
def test_paths_are_names_not_patterns(spark, tmp_path, scen):
    put(tmp_path, "v1", scen, "prod", TITLE + HEADER + "BAU,USA,Corn,1,2,Mt,\n")
    listed = cat.list_exports(spark, str(tmp_path), "proj")
    assert rows(listed, "version", "scen", "query") == [("v1", scen, "prod")]
    store = Store(spark, str(tmp_path / "tables"))
    assert load_exports(spark, str(tmp_path), "proj", store) == ["prod"]
    assert rows(store.load("prod"), "scen", "ss", "year", "value") == [(scen, scen, 2015, 1.0), (scen, scen, 2020, 2.0)]
    assert store.load("rejected_files").count() == 0


def test_blocks_with_different_headers(spark, tmp_path):
    put(tmp_path, "v1", "BAU", "prod", TITLE + HEADER + '"BAU,date=x",USA,Corn,1,2,Mt,\n\n'
        + TITLE + "scenario,region,sector,2025,2030,Units,\n" + '"BAU,date=x",USA,Corn,3,,Mt,\n"BAU,date=x",USA,Rice,4,5,Mt,\n')
    table = read_query(spark, [r["path"] for r in cat.list_exports(spark, str(tmp_path), "proj").collect()])
    assert rows(table.rows, "sector", "year", "value") == [("Corn", 2015, 1.0), ("Corn", 2020, 2.0), ("Rice", 2025, 4.0), ("Rice", 2030, 5.0)]
    assert table.rejected_files == [] and table.rejected_rows.count() == 1


def test_store_errors(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.load("nothing")
    with pytest.raises(TypeError):
        store.save("x", [1, 2])


def test_read_dimension(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("# File: ids\n# ----\nID,region\n1,USA\n2,\n")
    got = read_dimension(spark, str(path), {"region_id": "ID", "region": "region"}, ["region_id"], types={"region_id": "int"}, comment="#")
    assert rows(got) == [(1, "USA"), (2, None)]
    path.write_text("ID,region\n1,USA\n1,Brazil\n")
    with pytest.raises(ValueError, match="repeated key"):
        read_dimension(spark, str(path), {"region_id": "ID", "region": "region"}, ["region_id"])


def test_read_auxiliary(spark, tmp_path):
    path = tmp_path / "harvests.csv"
    path.write_text("region,tech,harvests.per.year\nUSA,Corn_B1,2\n")
    got = read_auxiliary(spark, str(path), "region string, technology string, harvests_per_year double",
                         {"technology": "tech", "harvests_per_year": "harvests.per.year"})
    assert rows(got) == [("USA", "Corn_B1", 2.0)]


def test_default_dimensions(spark, make):
    dims = default_dimensions(spark)
    assert [df.count() for df in (dims.regions, dims.leaves, dims.commodities, dims.gases, dims.region_ids)] == [32, 43, 26, 40, 32]
    assert set(fixed.REPORT_REGIONS) == {r[0] for r in rows(dims.regions.select("code").distinct())}
    for df, key in ((dims.regions, "region"), (dims.leaves, "LandLeaf"), (dims.commodities, "commodity"), (dims.gases, "GHG")):
        check_dimension(df, [key], key)
    own = dims.with_tables(regions=make("region string, code string", [("USA", "US")]))
    assert rows(own.regions) == [("USA", "US")]
    with pytest.raises(ValueError):
        dims.with_tables(regions=make("region string, code string", [("USA", "US"), ("USA", "XX")]))


def listed_paths(spark, tmp_path):
    return [r["path"] for r in cat.list_exports(spark, str(tmp_path), "proj").collect()]


def test_every_left_out_line_is_reported_with_its_reason(spark, tmp_path):
    put(tmp_path, "v1", "BAU", "prod", "Production, by crop\n\n" + HEADER + "BAU,USA,Corn,1,2,Mt,\n" + "BAU,USA,Rice,1,2,Mt,,,\n"
        + "BAU,USA,Oats,1,2,Mt,,9\n" + "BAU,USA,Rye\n" + "BAU,USA,,1,2,Mt,\n" + '"BAU",USA,"a, ""b"", c",1,2,Mt,\n' + TITLE + HEADER + "BAU,USA,Tea,x,2,Mt\n")
    table = read_query(spark, listed_paths(spark, tmp_path))
    assert {r[0]: r[1] for r in rows(table.rows.groupBy("sector").count())} == {"Corn": 2, "Rice": 2, "Tea": 1, 'a, "b", c': 2}
    assert [r[0] for r in rows(table.rejected_rows, "reason")] == ["blank cell", "too few cells", "too few cells", "too many cells"]
    assert rows(table.rejected_rows.where("reason = 'too many cells'"), "text") == [("BAU,USA,Oats,1,2,Mt,,9",)]
    assert rows(table.rejected_cells, "text", "year") == [("x", 2015)]


def test_headers_of_splits_without_one_come_from_above(spark, tmp_path):
    """A file of many splits, whose headers change far from where they are needed."""
    second = "scenario,sector,region,2030,Units\n"
    body = "".join(f"BAU,USA,item{k},{k},{k + 1},Mt,\n" for k in range(300))
    other = "".join(f"BAU,item{k},USA,{k},Mt\n" for k in range(400))
    put(tmp_path, "v1", "BAU", "prod", "lost,before,any header\n" + TITLE + HEADER + body + TITLE + second + other + TITLE + HEADER + body)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "700b")
        table = read_query(spark, listed_paths(spark, tmp_path))
        found = rows(table.rows.groupBy("year").agg({"value": "sum", "*": "count"}))
        assert splits_of(spark, listed_paths(spark, tmp_path)).count() > 20
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    whole = sum(range(300)) * 2.0
    assert found == [(2015, 600, whole), (2020, 600, whole + 600), (2030, 400, float(sum(range(400))))]
    assert rows(table.rejected_rows, "reason", "text") == [("no header above", "lost,before,any header")]


def test_second_load_reads_only_what_changed(spark, tree, tmp_path, monkeypatch):
    from cropledger.sources import store as stores

    read = []
    parse = stores.parse
    monkeypatch.setattr(stores, "parse", lambda spark, paths, *rest: (read.append(sorted(p.split("/proj/")[1] for p in paths)), parse(spark, paths, *rest))[1])
    store = Store(spark, str(tmp_path / "tables"))
    assert load_exports(spark, tree, "proj", store) == ["land", "prod"]
    before = rows(store.load("prod"))
    assert load_exports(spark, tree, "proj", store) == [] and rows(store.load("prod")) == before and len(read) == 1
    assert rows(store.left_out("rejected_cells"), "query", "year", "text") == [("prod", 2025, "oops")]

    put(tmp_path, "v1", "EL 2", "prod", TITLE + "scenario,region,Crop,2015,Units\n" + "EL2,USA,Corn,8,Mt\n")  # changed, other columns
    put(tmp_path, "v3", "BAU", "land", TITLE + "scenario,region,LandLeaf,2015,Units\n" + "BAU,USA,Wheat,2,km2\n")  # new
    (tmp_path / "proj" / "v2" / "BAU" / "prod.csv").unlink()  # gone
    assert load_exports(spark, tree, "proj", store) == ["land", "prod"]
    assert read[1] == ["v1/EL 2/prod.csv", "v3/BAU/land.csv"]
    assert rows(store.load("prod", scens=["EL 2"]), "sector", "Crop", "year", "value") == [(None, "Corn", 2015, 8.0)]
    assert rows(store.load("prod").select("version").distinct()) == [("v1",)] and store.load("prod").count() == 5
    assert rows(store.load("land"), "version", "LandLeaf") == [("v2", "CornC4"), ("v3", "Wheat")]
    assert rows(store.left_out("rejected_cells")) == []
    assert [r[0] for r in rows(store.left_out("rejected_files"), "query")] == ["broken"]
    folders = {p.name for p in (tmp_path / "tables" / "exports" / "kind=rows" / "query=prod").rglob("scen=*")}
    assert folders == {"scen=BAU", "scen=EL 2"}  # of v1: those of v2 went with their file


def test_rows_that_go_from_a_file_go_from_the_table(spark, tmp_path):
    put(tmp_path, "v1", "BAU", "prod", TITLE + HEADER + "BAU,USA,Corn,1,2,Mt,\n")
    store = Store(spark, str(tmp_path / "tables"))
    load_exports(spark, str(tmp_path), "proj", store)
    put(tmp_path, "v1", "BAU", "prod", TITLE + HEADER)
    load_exports(spark, str(tmp_path), "proj", store)
    assert store.load("prod").count() == 0 and set(store.load("prod").columns) >= {"scenario", "sector", "year", "value", "ss"}


def test_a_failed_load_leaves_the_tables_as_they_were(spark, tree, tmp_path, monkeypatch):
    from cropledger.sources import exports
    from cropledger.sources import store as stores

    store = Store(spark, str(tmp_path / "tables"))
    load_exports(spark, tree, "proj", store)
    before = rows(store.load("prod"))
    put(tmp_path, "v1", "BAU", "prod", TITLE + HEADER + "BAU,USA,Corn,5,6,Mt,\n")
    parse = stores.parse
    with monkeypatch.context() as m:
        m.setattr(stores, "parse", lambda *args: __import__("dataclasses").replace(parse(*args), lines=99))
        with pytest.raises(exports.LinesLost):
            load_exports(spark, tree, "proj", store)
    assert rows(store.load("prod")) == before
    assert load_exports(spark, tree, "proj", store) == ["prod"]
    assert store.load("prod", versions=["v1"], scens=["BAU"]).count() == 2
    named = {(r["query"], r["load"]) for r in store.ledger().collect()}
    left = {(p.parent.name[6:], p.name[5:]) for p in (tmp_path / "tables" / "exports").glob("kind=*/query=*/load=*")}
    assert left <= named and ("prod", max(load for _, load in left)) in left


def test_columns_that_differ_by_case_only(spark, tmp_path):
    put(tmp_path, "v1", "BAU", "a", TITLE + "scenario,Region,2015\nBAU,USA,1\n")
    put(tmp_path, "v1", "BAU", "b", TITLE + "scenario,region,2015\nBAU,Chad,2\n")
    store = Store(spark, str(tmp_path / "tables"))
    assert load_exports(spark, str(tmp_path), "proj", store) == ["a", "b"]
    assert rows(store.load("a"), "Region", "value") == [("USA", 1.0)] and "Region" in store.load("a").columns
    assert rows(store.load("b"), "region", "value") == [("Chad", 2.0)] and "region" in store.load("b").columns


def test_many_headers_and_files_of_one_load(spark, tmp_path, monkeypatch):
    """More headers than get a scan of their own; all queries in one write."""
    from cropledger.sources import exports

    monkeypatch.setattr(exports, "OWN_SCANS", 2)
    for k in range(6):
        for scen in ("BAU", "ELM"):
            put(tmp_path, "v1", scen, f"q{k}", TITLE + f"scenario,dim{k},{2015 + k},Units\n" + f"{scen},x,{k},Mt\n")
    store = Store(spark, str(tmp_path / "tables"))
    assert load_exports(spark, str(tmp_path), "proj", store) == [f"q{k}" for k in range(6)]
    for k in range(6):
        assert rows(store.load(f"q{k}"), "scenario", f"dim{k}", "year", "value") == [("BAU", "x", 2015 + k, float(k)), ("ELM", "x", 2015 + k, float(k))]
        assert f"dim{(k + 1) % 6}" not in store.load(f"q{k}").columns


def test_folders_that_are_not_chosen_are_not_listed(spark, tree, tmp_path):
    """A folder that leads back into itself can not be listed to its end."""
    for name in ("v2/BAU", "v1/BAU"):
        (tmp_path / "proj" / name / "loop.csv").symlink_to(tmp_path / "proj" / name)
    (tmp_path / "proj" / "v3").mkdir()
    (tmp_path / "proj" / "v3" / "again").symlink_to(tmp_path / "proj" / "v3")
    found = cat.find_exports(spark, tree, "proj", in_versions=["v1"], in_scens=["EL 2"], in_queries=["prod"])
    assert rows(found, "version", "scen", "query") == [("v1", "EL 2", "prod")]
    both = cat.find_exports(spark, tree, "proj", in_versions=["v1", "v2"], in_queries=["land", "prod"])
    assert rows(both, "version", "scen", "query") == [("v1", "BAU", "prod"), ("v1", "EL 2", "prod"), ("v2", "BAU", "land"), ("v2", "BAU", "prod")]
    for wrong in ({"in_versions": ["v9"]}, {"in_scens": ["EL 2"], "in_versions": ["v2"]}, {"in_queries": ["none"]}, {"in_versions": []}):
        with pytest.raises(cat.NotAvailable):
            cat.find_exports(spark, tree, "proj", **wrong)
