"""Whole runs over small CSV files: the golden fact, reloads, audit rows, failures."""

import shutil
from uuid import uuid4

import pytest

from terrace import load_spec, run_all, run_gold, run_pipeline, table_spec
from terrace.plans import runs
from terrace.operators import store
from terrace.plans.credit_risk import credit_risk_specs, gold_sql_spec, ordered_by_risk
from tests.compare import collected

# Rows of our own: each branch of the valuation, the flag and the band is there.
SOURCES = {
    "clients": """client_id,name,city,annual_income_eur,credit_score
P7,Ada,Lyon,61000,812
P8,Bo,New Ulm,18500,640
P9,Cy,Oslo,40250,455
P10,Di,Kyiv,7300,700
""",
    "credits": """credit_id,client_id,credit_type,total_amount_eur,balance_amount_eur,status
L1,P7,Boat,9000,4200,active
L2,P8,House,150000,149000.5,active
L3,P9,Boat,800,20,closed
L4,P10,Studies,5000,5000,active
L5,P7,House,64000,64000,defaulted
""",
    "collaterals": """collateral_id,credit_id,collateral_type,numbers,valuation_eur,stock_id
G1,L1,Stocks,12,,Q2
G2,L2,Land,1,149000.5,
G3,L4,Stocks,100,,Q1
G4,L5,Land,1,63999.75,
G5,L5,Stocks,2,,Q2
""",
    "market": """market_id,stock_name,ticker,current_value_eur
Q1,Umbrella Works,umw,48.5
Q2,Quarry,qry,350
""",
}
# Worked out by hand: 12 x 350 covers 4200, 100 x 48.5 does not cover 5000; L3 has no
# collateral and a balance above 0; L5 is defaulted, and each of its two is tested alone.
GOLDEN = [
    ("L1", "STOCKS", 4200.0, "4200", "YES", "LOW"),
    ("L2", "LAND", 149000.5, "149000.5", "YES", "MEDIUM"),
    ("L3", None, 0.0, "20", "NO", "HIGH"),
    ("L4", "STOCKS", 4850.0, "5000", "NO", "LOW"),
    ("L5", "LAND", 63999.75, "64000", "NO", "HIGH"),
    ("L5", "STOCKS", 700.0, "64000", "NO", "HIGH"),
]
FACT_COLUMNS = [
    "client_id",
    "name",
    "city",
    "credit_id",
    "credit_type",
    "total_amount_eur",
    "balance_amount_eur",
    "credit_status",
    "collateral_type",
    "collateral_value_eur",
    "is_covered",
    "overall_risk",
]


class Lake:
    """A store of its own for each test, with the sample files as its sources."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.prefix = f"t{uuid4().hex}_"
        self.settings = {
            "catalog": "spark_catalog",
            "source_base": str(folder / "in"),
            "managed_base": str(folder / "lake"),
            "audit_database": f"{self.prefix}audit",
            "audit_table": "pipeline_run_log",
            "dq_table": "dq_results",
        }
        (folder / "in").mkdir()
        for name, text in SOURCES.items():
            self.source(name, text)
        self.specs = credit_risk_specs(self.prefix)

    def source(self, name, text):
        (self.folder / "in" / f"{name}.csv").write_bytes(text.replace("\n", "\r\n").encode())

    def run(self, *names):
        wanted = [s for s in self.specs if not names or s["pipeline_name"][:-9] in names]
        return run_all(wanted, self.settings, self.spark)

    def table(self, layer, name):
        return self.spark.table(f"{self.prefix}{layer}.{name}")

    def fact(self):
        columns = [
            "credit_id",
            "collateral_type",
            "round(collateral_value_eur, 2)",
            "balance_amount_eur",
            "is_covered",
            "overall_risk",
        ]
        return collected(self.table("gold", "credit_risk_fact").selectExpr(columns))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_golden_fact(lake):
    metas = lake.run()
    assert lake.fact() == GOLDEN
    gold = lake.table("gold", "credit_risk_fact")
    assert gold.columns == [*FACT_COLUMNS, "_pipeline", "_layer", "_loaded_at"]
    assert dict(gold.dtypes)["collateral_value_eur"] == "double"
    bands = [r.overall_risk for r in ordered_by_risk(gold).collect()]
    assert bands == sorted(bands)

    assert [(m["status"], m.get("silver_count"), m.get("gold_count")) for m in metas] == [
        ("SUCCESS", 2, None),
        ("SUCCESS", 4, None),
        ("SUCCESS", 5, None),
        ("SUCCESS", 5, None),
        ("SUCCESS", None, 6),
    ]
    rows = {r.pipeline_name: r for r in lake.table("audit", "pipeline_run_log").collect()}
    log = [rows.pop(s["pipeline_name"]) for s in lake.specs]
    assert not rows
    assert [(r.source_count, r.bronze_count, r.dq_passed, r.dq_failed) for r in log[:4]] == [
        (2, 2, 1, 0),
        (4, 4, 1, 0),
        (5, 5, 1, 0),
        (5, 5, 1, 0),
    ]
    assert log[4].source_count is None and all(r.duration_seconds > 0 for r in log)
    assert lake.table("audit", "dq_results").count() == 4

    clients = lake.table("silver", "clients")
    assert {t for c, t in clients.dtypes if c != "_loaded_at"} == {"string"}
    assert lake.table("bronze", "clients").where("city = 'New Ulm'").count() == 1
    assert clients.where("city = 'NEW ULM'").count() == 1


def test_cases_the_sample_does_not_reach(lake):
    lake.source(
        "clients",
        "client_id,name,city,annual_income_eur,credit_score\n"
        "C1,a,x,1,\nC2,b,y,1,500\nC2,b,y,1,500\n,nokey,z,1,1\nC3,lonely,z,1,1\n",
    )
    lake.source(
        "credits",
        "credit_id,client_id,credit_type,total_amount_eur,balance_amount_eur,status\n"
        "R1,C1,t,1,100,active\nR2,C2,t,1,100,active\nR3,C2,t,1,50,defaulted\nR4,C9,t,1,1,active\n",
    )
    lake.source(
        "collaterals",
        "collateral_id,credit_id,collateral_type,numbers,valuation_eur,stock_id\n"
        "K1,R1,home,1,60,\nK2,R1,home,1,120,\nK3,R2,stocks,3,,M9\nK4,,home,1,5,\nK5,R7,home,1,5,\n",
    )
    clients = lake.run()[1]
    assert (clients["source_count"], clients["silver_count"], clients["dq_failed"]) == (4, 3, 1)
    assert lake.fact() == [
        ("R1", "HOME", 120.0, "100", "YES", "LOW"),
        ("R1", "HOME", 60.0, "100", "NO", "LOW"),
        ("R2", "STOCKS", 0.0, "100", "NO", "MEDIUM"),
        ("R3", None, 0.0, "50", "NO", "HIGH"),
    ]
    failed = lake.table("audit", "dq_results").where("status = 'FAIL'").collect()
    assert [(r.rule, r.failed_rows, r.failed_ids) for r in failed] == [
        ("client_id_not_null", 1, "name=nokey")
    ]


def test_second_load_updates_adds_and_keeps(lake):
    lake.run("market")
    before = {r.market_id: r for r in lake.table("silver", "market").collect()}
    lake.source(
        "market",
        "market_id,stock_name,ticker,current_value_eur\nQ2,renamed,qry,1.5\nQ9,new,nw,2\n",
    )
    [meta] = lake.run("market")
    assert (meta["source_count"], meta["bronze_count"], meta["silver_count"]) == (2, 2, 3)
    after = {r.market_id: r for r in lake.table("silver", "market").collect()}
    assert (after["Q2"].stock_name, after["Q2"].current_value_eur) == ("RENAMED", "1.5")
    assert after["Q9"].ticker == "NW"
    assert after["Q1"] == before["Q1"]
    assert after["Q2"]._loaded_at > before["Q2"]._loaded_at
    assert lake.table("bronze", "market").count() == 2
    assert lake.table("audit", "pipeline_run_log").count() == 2


def test_whole_rerun_gives_the_same_fact(lake):
    lake.run()
    lake.run()
    assert lake.fact() == GOLDEN


def test_silver_comes_from_bronze_not_from_a_changed_file(lake, monkeypatch):
    write_bronze = runs.write_bronze

    def then_lose_the_file(spark, spec):
        observed = write_bronze(spark, spec)
        shutil.rmtree(lake.folder / "in")
        return observed

    monkeypatch.setattr(runs, "write_bronze", then_lose_the_file)
    [meta] = lake.run("clients")
    assert (meta["bronze_count"], meta["silver_count"]) == (4, 4)


def test_failure_is_logged_and_raised(lake):
    with pytest.raises(Exception, match="market"):
        lake.run("collaterals")  # market was not loaded before
    [row] = lake.table("audit", "pipeline_run_log").collect()
    assert row.status == "FAILED" and "market" in row.error_message
    assert (row.bronze_count, row.silver_count, row.dq_passed) == (5, None, 1)
    assert lake.table("audit", "dq_results").count() == 1


def test_failing_log_does_not_hide_the_error(lake):
    lake.settings["audit_table"] = "not a name"
    with pytest.raises(Exception, match="market"):
        lake.run("collaterals")


def test_failing_log_of_a_good_run_is_raised(lake):
    lake.settings["audit_table"] = "not a name"
    with pytest.raises(Exception, match="not a name|PARSE_SYNTAX_ERROR|INVALID"):
        lake.run("market")
    assert lake.table("silver", "market").count() == 2


def test_repeated_keys_in_a_reload_are_refused(lake):
    lake.run("market")
    lake.source(
        "market",
        "market_id,stock_name,ticker,current_value_eur\nQ1,a,b,1\nQ1,c,d,2\n",
    )
    with pytest.raises(ValueError, match="Q1"):
        lake.run("market")
    assert lake.table("silver", "market").count() == 2


def test_gold_without_sql_or_target(lake):
    spec = {"pipeline_name": "empty_gold", "targets": {}}
    assert run_gold(spec, lake.settings, lake.spark)["gold_count"] == 0


def test_gold_text_sees_the_catalog(lake):
    lake.run("market")
    spec = {
        "pipeline_name": "tickers",
        "targets": {"gold": {"database": f"{lake.prefix}gold", "table": "tickers"}},
        "gold_sql": f"SELECT upper(ticker) t FROM {{catalog}}.{lake.prefix}silver.market",
    }
    assert run_gold(spec, lake.settings, lake.spark)["gold_count"] == 2
    assert collected(lake.table("gold", "tickers").select("t")) == [("QRY",), ("UMW",)]


def test_spec_from_yaml_files(lake):
    yaml = pytest.importorskip("yaml")
    shared, market = lake.folder / "shared.yaml", lake.folder / "market.yaml"
    shared.write_text(yaml.safe_dump(lake.settings))
    market.write_text(yaml.safe_dump(lake.specs[0]))
    assert run_pipeline(market, shared, lake.spark)["silver_count"] == 2


def test_gold_sql_text_over_four_tables(lake):
    yaml = pytest.importorskip("yaml")
    lake.run("market", "clients", "credits", "collaterals")
    spec = yaml.safe_load(yaml.safe_dump(gold_sql_spec(lake.prefix)))
    assert run_gold(spec, lake.settings, lake.spark)["gold_count"] == 6
    assert lake.fact() == GOLDEN


def test_market_rows_that_repeat_count_as_often(lake):
    lake.run()
    market = lake.table("silver", "market")
    store.overwrite(lake.spark, market.union(market.where("market_id = 'Q2'")), f"{lake.prefix}silver.market", str(lake.folder / "again"))
    lake.run("gold")
    assert lake.fact() == sorted(GOLDEN + [g for g in GOLDEN if g[0] == "L1" or g[2] == 700.0], key=str)


def test_typed_and_partitioned_silver(lake):
    spec = lake.specs[1]
    spec["types"] = {"credit_score": "int", "annual_income_eur": "double"}
    spec["targets"]["silver"]["partition_by"] = 4
    lake.source("clients", SOURCES["clients"] + "P11,Ed,Rome,much,9\n")
    [meta] = lake.run("clients")
    assert (meta["silver_count"], meta["dq_passed"], meta["dq_failed"]) == (5, 2, 1)
    silver = lake.table("silver", "clients")
    assert dict(silver.dtypes)["credit_score"] == "int" and silver.where("annual_income_eur IS NULL").count() == 1
    lake.source("clients", "client_id,name,city,annual_income_eur,credit_score\nP8,Bo,Ghent,1,2\nP12,Flo,Bern,3,4\n")
    [meta] = lake.run("clients")
    assert meta["silver_count"] == 6
    assert {r.client_id: r.credit_score for r in lake.table("silver", "clients").collect()} == {
        "P7": 812, "P8": 2, "P9": 455, "P10": 700, "P11": 9, "P12": 4
    }


def test_a_typed_run_reads_bronze_once(lake, monkeypatch):
    """The counts of values that do not fit ride on the write; enrichment is computed once."""
    lake.run("market")
    spec = lake.specs[3]
    spec["types"] = {"stock_id": "int"}
    frames, first_load = [], store.first_load_or_upsert
    monkeypatch.setattr(store, "first_load_or_upsert", lambda s, df, *a, **k: frames.append(df) or first_load(s, df, *a, **k))
    for load in range(2):
        [meta] = lake.run("collaterals")
        assert (meta["silver_count"], meta["dq_failed"]) == (5, 1)
    assert all("Join" in f._jdf.queryExecution().optimizedPlan().toString() for f in frames)
    bad = lake.table("audit", "dq_results").where("rule = 'stock_id_is_int'").collect()
    assert [(r.status, r.failed_rows) for r in bad] == [("FAIL", 3)] * 2
    silver = lake.table("silver", "collaterals")
    assert dict(silver.dtypes)["stock_id"] == "int" and not [c for c in silver.columns if c.startswith("_unfit")]


def test_malformed_lines_are_counted_or_dropped(lake):
    spec = lake.specs[0]
    lake.source("market", SOURCES["market"] + "Q3,Short\nQ4,Long,lng,1,2,3\n")
    for action, rows, failed in (("report", 4, "report"), ("drop_row", 2, "drop_row")):
        spec["source"]["malformed"] = action
        spec["targets"]["silver"]["table"] = f"market_{action}"
        [meta] = lake.run("market")
        assert (meta["bronze_count"], meta["silver_count"], meta["dq_failed"]) == (4, rows, 1)
        row = lake.table("audit", "dq_results").where(f"rule = 'source_well_formed' AND action = '{failed}'").first()
        assert (row.status, row.failed_rows) == ("FAIL", 2)


def test_bucketed_silver(lake):
    lake.specs[1]["targets"]["silver"]["buckets"] = 4
    for _ in range(2):
        lake.run()
        assert lake.fact() == GOLDEN
        assert store.buckets_of(lake.spark, f"{lake.prefix}silver.clients") == 4


def test_gold_is_sorted_over_its_files(lake):
    lake.specs[4]["targets"]["gold"]["order_by"] = ["overall_risk", "client_id", "credit_id"]
    lake.run()
    assert lake.fact() == GOLDEN


def test_independent_tables_run_at_once(lake):
    metas = lake.run()
    assert [m["status"] for m in metas] == ["SUCCESS"] * 5 and lake.fact() == GOLDEN
    market, clients, credits, collaterals, gold = metas
    assert clients["start_time"] < market["end_time"] and market["start_time"] < clients["end_time"]
    assert collaterals["start_time"] >= market["end_time"]
    assert gold["start_time"] >= max(m["end_time"] for m in metas[:4])


def test_what_a_spec_needs(lake):
    loaded = [load_spec(s, lake.settings) for s in lake.specs]
    assert runs.needs(loaded) == [set(), set(), set(), {0}, {0, 1, 2, 3}]
    text = [load_spec(s, lake.settings) for s in [*lake.specs[:4], gold_sql_spec(lake.prefix)]]
    assert runs.needs(text) == [set(), set(), set(), {0}, {0, 1, 2, 3}]
    assert runs.needs([loaded[3], loaded[0], loaded[0]]) == [set(), {0}, {0, 1}]


def test_after_a_failure_nothing_new_starts(lake):
    (lake.folder / "in" / "market.csv").unlink()
    with pytest.raises(Exception, match="market"):
        lake.run()
    log = {r.pipeline_name: r.status for r in lake.table("audit", "pipeline_run_log").collect()}
    assert log["market_pipeline"] == "FAILED" and "collaterals_pipeline" not in log and "gold_pipeline" not in log


def test_views_in_a_spec(lake):
    lake.run("market")
    spec = {
        "pipeline_name": "viewed",
        "targets": {"gold": {"database": f"{lake.prefix}gold", "table": "viewed"}},
        "views": {
            "dear": {"sql": f"SELECT * FROM {{catalog}}.{lake.prefix}silver.market WHERE current_value_eur > 100.0"},
            "all_of_them": lambda spark, catalog: spark.table(f"{catalog}.{lake.prefix}silver.market").selectExpr("market_id"),
            "both": {"left_join": {"left": "all_of_them", "right": "dear", "key": "market_id"}},
        },
        "gold_sql": "SELECT market_id, ticker FROM both",
    }
    run_gold(spec, lake.settings, lake.spark)
    assert collected(lake.table("gold", "viewed").select("market_id", "ticker")) == [("Q1", None), ("Q2", "QRY")]
    assert not [t for t in lake.spark.catalog.listTables() if t.isTemporary and t.name in spec["views"]]
    with pytest.raises(ValueError, match="odd"):
        load_spec(spec | {"views": {"odd": {"right_join": {}}}}, lake.settings)


SHARED = {"catalog": "main", "source_base": "/in"}


def test_spec_needs_a_name_and_a_source_path():
    with pytest.raises(ValueError, match="pipeline_name"):
        load_spec({"source": {"path": "x"}}, SHARED)
    with pytest.raises(ValueError, match="source.path"):
        load_spec({"pipeline_name": "p", "source": {}}, SHARED)
    with pytest.raises(KeyError):
        load_spec({"pipeline_name": "p"}, {"catalog": "main"})


def test_spec_is_merged_filled_in_and_left_alone():
    spec = {
        "pipeline_name": "p",
        "catalog": "mine",
        "source": {"path": "{source_base}/a.csv"},
        "transformations": [{"join_table": "{catalog}.silver.t", "expression": "{catalog}"}],
        "gold_sql": "SELECT * FROM {catalog}.silver.t",
    }
    out = load_spec(spec, SHARED)
    assert out["source"]["path"] == "/in/a.csv"
    assert out["transformations"] == [{"join_table": "mine.silver.t", "expression": "{catalog}"}]
    assert out["gold_sql"] == "SELECT * FROM mine.silver.t"
    assert spec["source"]["path"] == "{source_base}/a.csv"


@pytest.mark.parametrize(
    "part",
    [
        {"source": {"path": "x", "format": "json"}},
        {"targets": {"silver": {"database": "s", "table": "t", "write_mode": "overwrite"}}},
        {"data_quality": [{"column": "a", "check": "unique"}]},
    ],
)
def test_spec_refuses_what_would_be_ignored(part):
    with pytest.raises(ValueError):
        load_spec({"pipeline_name": "p", **part}, SHARED)


def test_table_spec():
    spec = table_spec("p", "places", "id", "city", ["id", "city"], uppercase=["city"])
    assert spec["source"] == {"path": "{source_base}/places.csv", "columns": ["id", "city"]}
    assert spec["targets"]["silver"]["merge_key"] == "id"
    assert spec["transformations"] == [{"column": "city", "action": "uppercase"}]
    assert spec["data_quality"] == [{"column": "id", "action": "drop_row"}]
    assert table_spec("p", "places", "id", "city", ["id"], dq_rules=[])["data_quality"] == []
