"""The sales domain: per-table staging transforms, control seeds and routing."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.columns import drop_column, rename_columns

# Columns that staging renames, by staged table.
RENAMES = {
    "credits_cards": {"ExpMonth": "expiration_month", "ExpYear": "expiration_year"},
    "order_details": {"OrderQty": "order_quantity"},
    "order_headers": {"TaxAmt": "tax_amount"},
    "sales_people": {"CommissionPct": "commission_percentage"},
    "special_offers": {"MinQty": "min_quantity", "MaxQty": "max_quantity",
                       "DiscountPct": "discount_percentage"},
}

# Fields of the store survey XML document and their types.
SURVEY = """AnnualRevenue DECIMAL(18,2), AnnualSales INT, BankName STRING, Brands STRING, BusinessType STRING,
Internet STRING, NumberEmployees INT, Specialty STRING, SquareFeet INT, YearOpened INT"""


def survey_columns(df: DataFrame, key: str = "BusinessEntityID", document: str = "Demographics") -> DataFrame:
    """The survey document of each store as one column per field, beside the
    store's key (built-in ``from_xml``, JVM side). A NULL or malformed document
    gives NULL fields."""
    fields = df.select(key, F.from_xml(document, SURVEY).alias("survey")).select(key, "survey.*")
    return fields.withColumnRenamed("NumberEmployees", "number_of_employees")


#: Staged table -> transform; tables without one are staged as they are.
TRANSFORMS = {name: partial(rename_columns, mapping=pairs) for name, pairs in RENAMES.items()}
TRANSFORMS["stores"] = partial(drop_column, name="Demographics")
TRANSFORMS["store_demographics"] = survey_columns


# The control seeds, one row per source table, in this order:
# (schema_name, table_name, primary_key, selected, filter, active,
#  stg_primary_key, partition_column, num_partitions)
SEED_ROWS = [
    ("Sales", "SalesTerritory", "TerritoryID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "ShoppingCartItem", "ShoppingCartItemID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "SpecialOffer", "SpecialOfferID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "CurrencyRate", "CurrencyRateID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "Customer", "CustomerID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "SalesReason", "SalesReasonID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "CreditCard", "CreditCardID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "SalesTaxRate", "SalesTaxRateID", None, "ModifiedDate >= :start_date", True, "id", "ModifiedDate", 4),
    ("Sales", "PersonCreditCard", "BusinessEntityID, CreditCardID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "SalesTerritoryHistory", "BusinessEntityID, StartDate, TerritoryID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "SpecialOfferProduct", "SpecialOfferID, ProductID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "CountryRegionCurrency", "CountryRegionCode, CurrencyCode", None, "ModifiedDate >= :start_date", True, None, None, None),
    ("Sales", "Currency", "CurrencyCode", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "SalesOrderDetail", "SalesOrderID, SalesOrderDetailID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "SalesOrderHeader", "SalesOrderID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "SalesOrderHeaderSalesReason", "SalesOrderID, SalesReasonID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "SalesPerson", "BusinessEntityID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "SalesPersonQuotaHistory", "BusinessEntityID, QuotaDate", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
    ("Sales", "Store", "BusinessEntityID", None, "ModifiedDate >= :start_date", True, None, "ModifiedDate", 4),
]
SEED_COLUMNS = ["schema_name", "table_name", "primary_key", "selected", "filter", "active",
                "stg_primary_key", "partition_column", "num_partitions"]


def seed_dicts() -> list[dict]:
    return [dict(zip(SEED_COLUMNS, r)) for r in SEED_ROWS]


# Table of the Sales schema -> staged tables.
STAGED = {
    "CountryRegionCurrency": ["country_region_currencies"],
    "Currency": ["currencies"],
    "CurrencyRate": ["currency_rates"],
    "Customer": ["customers"],
    "PersonCreditCard": ["person_credit_cards"],
    "SalesOrderHeaderSalesReason": ["order_header_sales_reasons"],
    "SalesPersonQuotaHistory": ["sales_person_quota_history"],
    "SalesReason": ["sales_reasons"],
    "SalesTaxRate": ["tax_rates"],
    "SalesTerritory": ["territories"],
    "SalesTerritoryHistory": ["territory_history"],
    "ShoppingCartItem": ["shopping_cart_items"],
    "SpecialOfferProduct": ["special_offer_products"],
    "CreditCard": ["credits_cards"],
    "SalesOrderDetail": ["order_details"],
    "SalesOrderHeader": ["order_headers"],
    "SalesPerson": ["sales_people"],
    "SpecialOffer": ["special_offers"],
    "Store": ["stores", "store_demographics"],
}

ROUTES = {("Sales", table): [(name, TRANSFORMS.get(name)) for name in names] for table, names in STAGED.items()}
