import json
import uuid

from landfall.__main__ import main


def test_cli_init_list_and_switch(spark, root, capsys):
    z = uuid.uuid4().hex[:6]
    base = ["--ctr", f"c{z}", "--raw", f"r{z}", "--stg", f"s{z}", "--root", root]
    assert main(base + ["init"]) == 0
    assert main(base + ["deactivate", "Sales", "Store"]) == 0
    capsys.readouterr()
    assert main(base + ["list-control", "--page", "1", "--page-length", "10"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    rows = [json.loads(x) for x in lines[:-1]]
    info = json.loads(lines[-1])
    assert len(rows) == 9 and info == {"page": 1, "page_length": 10, "total_pages": 2,
                                       "total_results": 19}
    store = [r for r in rows if r["table_name"] == "Store"]
    assert store and store[0]["active"] is False


def test_cli_land_and_stage_with_the_seeds(spark, root, capsys):
    import datetime as dt

    from landfall.domains import sales
    z = uuid.uuid4().hex[:6]
    base = ["--ctr", f"c{z}", "--raw", f"r{z}", "--stg", f"s{z}", "--root", root]
    assert main(base + ["init"]) == 0
    for schema, table in sales.ROUTES:
        if table != "Store":
            main(base + ["deactivate", schema, table])
    url = f"jdbc:derby:memory:cli{z};create=true"
    doc = ("<StoreSurvey><AnnualRevenue>1.50</AnnualRevenue><NumberEmployees>3"
           "</NumberEmployees></StoreSurvey>")
    spark.createDataFrame([(1, "A", doc, dt.datetime(2024, 1, 1)),
                           (2, "B", None, dt.datetime(2024, 1, 2))],
                          "BusinessEntityID int, Name string, Demographics string, "
                          "ModifiedDate timestamp") \
        .write.format("jdbc").option("url", url).option("dbtable", "Sales.Store") \
        .mode("overwrite").save()
    assert main(base + ["land", "--run-date", "2024-01-03", "--url", url]) == 0
    assert main(base + ["--retain", "2", "stage", "--run-date", "2024-01-03"]) == 0
    stores = spark.table(f"s{z}_sales.stores")
    assert stores.columns == ["business_entity_id", "name", "modified_date"]
    demo = {r["business_entity_id"]: r for r in spark.table(f"s{z}_sales.store_demographics").collect()}
    assert demo[1]["number_of_employees"] == 3 and demo[2]["annual_revenue"] is None
    capsys.readouterr()
    assert main(base + ["list-log", "--page", "0", "--page-length", "10",
                        "--select", "target_table_name, movements, error"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    logged = [json.loads(x) for x in lines[:-1]]
    assert sorted(r["target_table_name"] for r in logged) == ["Store", "store_demographics", "stores"]
    assert all(r["movements"] == 2 and r["error"] is None for r in logged)


def test_init_twice_keeps_one_row_per_table(spark, root):
    from landfall.domains import sales
    from landfall.plans import control_table_name, deactivate, init, list_control
    from landfall.sources import Zones
    z = uuid.uuid4().hex[:6]
    zones = Zones(ctr=f"c{z}", raw=f"r{z}", stg=f"s{z}")
    init(spark, sales.seed_dicts(), zones=zones, root=root)
    deactivate(spark, "Sales", "Store", zones=zones, root=root)
    init(spark, sales.seed_dicts(), zones=zones, root=root)
    ctl = spark.table(control_table_name(zones))
    assert ctl.count() == 19 and ctl.where("NOT active").count() == 1
    rows_, _ = list_control(spark, 0, 5, zones=zones, select=["schema_name", "table_name"])
    assert rows_.columns == ["schema_name", "table_name"] and rows_.count() == 5
