"""End to end: init -> land (Derby source) -> stage -> changes -> incremental
land and stage -> a failing table -> audit log and listing.

The Derby tables keep mixed-case column names (quoted identifiers), so the
control filter quotes the column, and the session reads double-quoted text as
identifiers (as the source database does) for the raw -> staging predicate.
"""

import datetime as dt
import uuid
from decimal import Decimal

import pytest

from landfall.domains import sales
from landfall.plans import (IngestionFailed, activate, control_table_name, deactivate, init, land,
                            list_control, list_log, log_table_name, stage)
from landfall.sources import JdbcConnection, Zones, qualified

OLD = dt.datetime(2020, 1, 1)
DAY = dt.datetime(2024, 6, 2, 12, 0)

XML = ("<StoreSurvey xmlns=\"urn:example:survey\"><AnnualRevenue>{rev}</AnnualRevenue>"
       "<AnnualSales>800000</AnnualSales><BankName>Bank {n}</BankName><Brands>2</Brands>"
       "<BusinessType>BM</BusinessType><Internet>ISDN</Internet>"
       "<NumberEmployees>{emp}</NumberEmployees><Specialty>Touring</Specialty>"
       "<SquareFeet>7000</SquareFeet><YearOpened>1990</YearOpened></StoreSurvey>")


def _source(spark, changed: bool) -> dict:
    cc = [(1, "Vista", 1, 2025 if not changed else 2030, DAY if changed else OLD),
          (2, "Distinguish", 2, 2026, OLD)]
    if changed:
        cc.append((3, "Vista", 3, 2027, DAY))
    store_emp = 14 if changed else 13
    return {
        "SalesTerritory": spark.createDataFrame(
            [(1, "Northwest", OLD), (2, "Northeast", OLD)],
            "TerritoryID int, Name string, ModifiedDate timestamp"),
        "CreditCard": spark.createDataFrame(
            cc, "CreditCardID int, CardType string, ExpMonth int, ExpYear int, ModifiedDate timestamp"),
        "SalesOrderHeader": spark.createDataFrame(
            [(10, Decimal("1.50"), OLD), (11, Decimal("2.25"), OLD)],
            "SalesOrderID int, TaxAmt decimal(10,2), ModifiedDate timestamp"),
        "SalesOrderDetail": spark.createDataFrame(
            [(10, 1, 5, OLD), (10, 2, 1, OLD), (11, 1, 7, OLD)],
            "SalesOrderID int, SalesOrderDetailID int, OrderQty int, ModifiedDate timestamp"),
        "SalesPerson": spark.createDataFrame(
            [(274, Decimal("0.0150"), OLD)],
            "BusinessEntityID int, CommissionPct decimal(10,4), ModifiedDate timestamp"),
        "SpecialOffer": spark.createDataFrame(
            [(1, "No Discount", Decimal("0.00"), 0, 10, OLD)],
            "SpecialOfferID int, Description string, DiscountPct decimal(10,2), MinQty int, "
            "MaxQty int, ModifiedDate timestamp"),
        "Store": spark.createDataFrame(
            [(292, "Next-Door Bike Store", XML.format(rev="80000.00", n=1, emp=store_emp),
              DAY if changed else OLD),
             (294, "Professional Sales", None, OLD)],
            "BusinessEntityID int, Name string, Demographics string, ModifiedDate timestamp"),
        "SalesTerritoryHistory": spark.createDataFrame(
            [(275, dt.datetime(2011, 5, 31), 2, OLD), (275, dt.datetime(2012, 11, 30), 3, OLD)],
            "BusinessEntityID int, StartDate timestamp, TerritoryID int, ModifiedDate timestamp"),
        "CountryRegionCurrency": spark.createDataFrame(
            [("AE", "AED", OLD), ("AR", "ARS", OLD)],
            "CountryRegionCode string, CurrencyCode string, ModifiedDate timestamp"),
    }


def _derby(spark, tables: dict) -> JdbcConnection:
    url = f"jdbc:derby:memory:e2e{uuid.uuid4().hex[:8]};create=true"
    for name, df in tables.items():
        (df.write.format("jdbc").option("url", url).option("dbtable", f"Sales.{name}")
         .mode("overwrite").save())
    return JdbcConnection(url)


@pytest.fixture()
def quoted_identifiers(spark):
    key = "spark.sql.ansi.doubleQuotedIdentifiers"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    yield
    spark.conf.set(key, old)


def test_end_to_end(spark, root, quoted_identifiers):
    zones = Zones(ctr=f"c{uuid.uuid4().hex[:6]}", raw=f"r{uuid.uuid4().hex[:6]}",
                  stg=f"s{uuid.uuid4().hex[:6]}")
    seeds = [dict(r, filter='"ModifiedDate" >= :start_date') for r in sales.seed_dicts()]
    made = init(spark, seeds, zones=zones, root=root)
    assert sorted(made) == sorted([f"{zones.raw}_sales", f"{zones.stg}_sales"])
    present = set(_source(spark, False))
    for r in sales.seed_dicts():
        if r["table_name"] not in present:
            deactivate(spark, "Sales", r["table_name"], zones=zones, root=root)
    control = spark.table(control_table_name(zones))
    assert control.where("active").count() == 9

    # run 1: everything is a full load
    conn = _derby(spark, _source(spark, False))
    recs = land(spark, control, conn, "2024-06-02", zones=zones, root=root,
                log_table=log_table_name(zones))
    assert {r.target.table_name: r.movements for r in recs}["SalesOrderDetail"] == 3
    recs = stage(spark, control, sales.ROUTES, "2024-06-02", zones=zones, root=root,
                 log_table=log_table_name(zones))
    assert len(recs) == 10 and not any(r.failed for r in recs)

    stg = lambda t: spark.table(qualified(zones.stg, "sales", t))
    assert stg("credits_cards").columns == ["id", "card_type", "expiration_month",
                                            "expiration_year", "modified_date"]
    assert stg("territories").columns[0] == "id"
    assert stg("territory_history").columns[:3] == ["business_entity_id", "start_date",
                                                     "territory_id"]
    assert stg("stores").columns == ["business_entity_id", "name", "modified_date"]
    demo = {r["business_entity_id"]: r for r in stg("store_demographics").collect()}
    assert demo[292]["number_of_employees"] == 13 and demo[294]["bank_name"] is None

    # run 2: source changed; only the day's rows move
    conn = _derby(spark, _source(spark, True))
    recs = land(spark, control, conn, "2024-06-03", zones=zones, root=root,
                log_table=log_table_name(zones))
    moved = {r.target.table_name: r.movements for r in recs}
    assert moved["CreditCard"] == 2 and moved["Store"] == 1 and moved["SalesOrderDetail"] == 0
    recs = stage(spark, control, sales.ROUTES, "2024-06-03", zones=zones, root=root,
                 log_table=log_table_name(zones))
    assert {r.target.table_name: r.movements for r in recs}["store_demographics"] == 1
    cards = {r["id"]: r["expiration_year"] for r in stg("credits_cards").collect()}
    assert cards == {1: 2030, 2: 2026, 3: 2027}
    demo = {r["business_entity_id"]: r for r in stg("store_demographics").collect()}
    assert demo[292]["number_of_employees"] == 14 and len(demo) == 2
    raw_cards = spark.table(qualified(zones.raw, "Sales", "CreditCard"))
    assert raw_cards.count() == 3

    # run 3: a table that the source lacks fails alone, the log says so, then it raises
    activate(spark, "Sales", "Currency", zones=zones, root=root)
    control = spark.table(control_table_name(zones))
    with pytest.raises(IngestionFailed):
        land(spark, control, conn, "2024-06-04", zones=zones, root=root,
             log_table=log_table_name(zones))
    log = spark.table(log_table_name(zones))
    assert log.count() == 9 + 10 + 9 + 10 + 10
    failed = log.where("error IS NOT NULL").collect()
    assert [r["source_table_name"] for r in failed] == ["Currency"]

    rows, info = list_log(spark, 0, 5, zones=zones)
    newest = log.agg({"ingestion_date": "max"}).first()[0]
    got = rows.collect()
    assert len(got) == 5 and all(r["ingestion_date"] == newest for r in got)
    assert info.first()["total_results"] == 48 and info.first()["total_pages"] == 10
    ctl_rows, ctl_info = list_control(spark, 1, 10, zones=zones)
    assert ctl_rows.count() == 9 and ctl_info.first()["total_pages"] == 2
