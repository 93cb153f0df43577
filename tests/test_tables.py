"""Tables are made when a query first reads them, by the same steps and with the same rows."""

import datetime as dt

from starmart.operators.keys import assign_dense_key
from starmart.plans import catalog
from starmart.plans import fact as FB
from starmart.plans import refresh as R
from starmart.plans import views
from starmart.sources import testdata
from starmart.sources.tables import Tables, replaced


def recording(monkeypatch, module):
    made, write = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label, *rest: (made.append(label), write(df, label, *rest))[1])
    return made


def test_a_query_stages_and_loads_only_what_it_reads(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_SOURCES", {})
    monkeypatch.setattr(catalog, "_MARTS", {})
    staged, loaded = recording(monkeypatch, catalog), recording(monkeypatch, FB)
    src, m = catalog.sources(spark, "/root/testdata/sf0.001"), catalog.mart(spark, "/root/testdata/sf0.001")
    assert R.calendar_extend(src, m).count() > 0
    assert staged == ["src_encounters"] and loaded == []
    assert views.sql(src, "SELECT COUNT(*) FROM {providers}").first()[0] > 0
    assert set(staged) == {"src_encounters", "src_providers"}
    keys = m["bridge_encounter_procedures"]
    assert keys.count() > 0 and "dim_diagnosis" not in loaded and "src_encounter_diagnoses" in staged
    before = list(staged)
    assert m["bridge_encounter_procedures"] is keys and m["dim_procedure"].count() > 0
    assert staged == before


def test_tables_on_demand_equal_the_whole_load(spark):
    src = testdata.stage_sources(spark, "/root/testdata/sf0.001")
    one = FB.mart_tables(src, dt.date(2002, 1, 1))
    last_first = {name: sorted(map(tuple, one[name].collect()), key=repr) for name in reversed(list(one))}
    for name, df in FB.build_all(src, dt.date(2002, 1, 1)).items():
        assert sorted(map(tuple, df.collect()), key=repr) == last_first[name], name


def test_replaced_leaves_the_tables_as_they_are(spark):
    a, b = spark.range(1), spark.range(2)
    t = Tables({"x": lambda: a, "y": lambda: a})
    r = replaced(t, {"x": lambda: b})
    r["z"] = b
    assert r["x"] is b and r["y"] is a and t["x"] is a and list(t) == ["x", "y"] and list(r) == ["x", "y", "z"]
    del r["z"]
    assert dict(r) == {"x": b, "y": a}


def test_dense_keys_are_a_projection_of_the_written_rows(spark):
    df = assign_dense_key(spark.range(1000).selectExpr("id * 7 % 1000 AS nk"), ["nk"], "k", num_partitions=7)
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.nk, r.k) for r in df.orderBy("nk").collect()] == [(i, i + 1) for i in range(1000)]
    assert assign_dense_key(spark.range(0).selectExpr("id AS nk"), ["nk"], "k").count() == 0
