"""Fund-flow inputs derived from the sample tables, whole tables throughout.

Joins carry no hints here: some of these tables grow with the data, and the
optimizer picks the join by their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowtide.functions.fixed_values import FLOW_COLUMNS, SHARE_CLASS_SUFFIXES
from flowtide.sources.settle import new_folder, settle
from workload.sample_values import (
    BRAND_CODES,
    CATEGORY_OF_TYPE,
    FUND_OF_TYPE,
    LINE_2_CYCLE,
    LINE_3_CYCLE,
    LINE_OF_SEGMENT,
    ORGANIZATIONS,
    PREFIX_OF_TYPE,
    YEAR_SHIFT,
)

MONEY = "decimal(18,2)"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table. Its schema is read from the file once, as a catalog would keep it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def one_of(values: list, position: Column) -> Column:
    """Value at a 0-based position of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int") + 1)


def coded(column: str, codes: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.create_map(*pairs)[F.col(column)]


def shifted_month(date: str) -> Column:
    return (F.year(date) + YEAR_SHIFT) * 100 + F.month(date)


def amount_where(test: Column, amount: Column) -> Column:
    return F.when(test, amount).otherwise(F.lit(0)).cast(MONEY)


def _flow_amounts() -> list[Column]:
    price = F.col("l_extendedprice").cast(MONEY)
    flag, odd = F.col("l_returnflag"), F.col("l_linenumber") % 2 == 1
    return [
        amount_where(flag == "N", price).alias("saleamount"),
        amount_where(flag == "R", -price).alias("redemptionamount"),
        amount_where((flag == "A") & odd, price).alias("exchangeinamount"),
        amount_where((flag == "A") & ~odd, -price).alias("exchangeoutamount"),
    ]


def funds_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund, share class, ticker, vehicle and category of every part.

    Worked out per part, ahead of the join with the far larger lineitem.
    """
    size = F.col("p_size")
    suffix = one_of(list(SHARE_CLASS_SUFFIXES), size % 6)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        coded("p_type", FUND_OF_TYPE).alias("fund"),
        F.concat(F.lit("R-"), (1 + size % 6).cast("string")).alias("share_class"),
        F.concat(coded("p_type", PREFIX_OF_TYPE), suffix).alias("ticker"),
        (100 + size % 4).cast("bigint").alias("vehicle"),
        coded("p_type", CATEGORY_OF_TYPE).alias("category"),
    )


def _sold_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.join(funds_of_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))


def fund_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard-named flows at fund level; needs only lineitem and part."""
    return (
        _sold_parts(spark, sf_dir)
        .select(
            shifted_month("l_shipdate").alias("month_number"),
            F.col("fund").alias("parent_fund_acronym_group"),
            F.col("share_class").alias("parent_share_class_name"),
            F.col("l_linenumber").alias("line_number"),
            *_flow_amounts(),
        )
        .withColumnsRenamed(FLOW_COLUMNS)
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as one history, numbered by order; the sale amount is known on first lines of every seventh order only."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice").cast(MONEY)
    return table(spark, sf_dir, "lineitem").select(
        F.lit("all").alias("ledger"),
        order.cast("bigint").alias("entry"),
        line.cast("int").alias("line_number"),
        F.when((order % 7 == 3) & (line == 1), price).alias("sale_amount"),
        F.when(F.col("l_returnflag") == "R", -price).alias("redemption_amount"),
    )


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets by fund and share class, reported in the third and ninth month of a year."""
    sold = _sold_parts(spark, sf_dir).select(
        shifted_month("l_shipdate").alias("month_number"),
        F.col("fund").alias("parent_fund_acronym_group"),
        F.col("share_class").alias("parent_share_class_name"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
    )
    reported = sold.where((F.col("month_number") % 100).isin(3, 9))
    return reported.groupBy("parent_fund_acronym_group", "parent_share_class_name", "month_number").agg(
        F.sum("price").alias("assets")
    )


def plan_class_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows of every line with its plan, year and category."""
    sold = _sold_parts(spark, sf_dir).join(plans_of_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    year = F.year("l_shipdate") + YEAR_SHIFT
    return sold.select("plan", year.alias("year"), "category", *_flow_amounts()).withColumnsRenamed(FLOW_COLUMNS)


def category_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price of every line with its category and month."""
    return _sold_parts(spark, sf_dir).select(
        "category", shifted_month("l_shipdate").alias("month_number"), F.col("l_extendedprice").cast(MONEY).alias("price")
    )


def plans_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan id and business line of every order."""
    key = F.col("o_custkey")
    plan = (
        F.when(key % 50 == 0, F.lit("#"))
        .when(key % 50 == 1, F.lit("0"))
        .when(key % 50 == 2, F.concat(F.lit("P"), key.cast("string")))
        .otherwise(key.cast("string"))
    )
    lines = table(spark, sf_dir, "customer").select(
        "c_custkey", coded("c_mktsegment", LINE_OF_SEGMENT).alias("line")
    )
    orders = table(spark, sf_dir, "orders").join(lines, key == F.col("c_custkey"))
    return orders.select("o_orderkey", plan.alias("plan"), "line")


def organizations_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(
        "n_nationkey", one_of(ORGANIZATIONS, F.col("n_nationkey")).alias("organization")
    )
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "organization"
    )


def raw_flows(spark: SparkSession, sf_dir: str, status: str, *, pascal_case: bool = False) -> DataFrame:
    """One raw flow source with its source-style column names."""
    rows = (
        _sold_parts(spark, sf_dir)
        .where(F.col("l_linestatus") == status)
        .join(plans_of_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(organizations_of_suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    raw = rows.select(
        shifted_month("l_shipdate").alias("monthnumber"),
        F.col("plan").alias("retirementplanid"),
        F.col("organization").alias("organizationname"),
        F.col("line").alias("businessline1"),
        F.col("fund").alias("parentfundacronymgroup"),
        F.col("share_class").alias("parentshareclassname"),
        *_flow_amounts(),
    )
    return raw.toDF(*_PASCAL) if pascal_case else raw


_PASCAL = [
    "MonthNumber", "RetirementPlanId", "OrganizationName", "BusinessLine1",
    "ParentFundAcronymGroup", "ParentShareClassName",
    "SaleAmount", "RedemptionAmount", "ExchangeInAmount", "ExchangeOutAmount",
]


def organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw organisation name of every supplier."""
    return organizations_of_suppliers(spark, sf_dir).select(
        F.col("organization").alias("organization_name")
    )


def supplier_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five digits of every supplier's name as a fragment of it."""
    return table(spark, sf_dir, "supplier").select(
        F.substring("s_name", -5, 5).alias("fragment"), F.col("s_name").alias("firm")
    )


def customer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("organization_name"))


def ticker_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker listing, several rows and two vehicles per ticker."""
    return funds_of_parts(spark, sf_dir).select(
        F.col("ticker").alias("TradingSymbol"), F.col("vehicle").alias("InvestmentVehicleId")
    )


def fund_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per month and ticker."""
    return (
        _sold_parts(spark, sf_dir)
        .select(
            shifted_month("l_shipdate").alias("month_number"),
            F.col("ticker").alias("ticker_symbol"),
            F.col("category").alias("morningstar_category_grouped"),
            F.col("l_discount").cast(MONEY).alias("discount"),
        )
        .groupBy("month_number", "ticker_symbol", "morningstar_category_grouped")
        .agg(F.sum("discount").cast("double").alias("return_1_month"))
    )


def daily_series(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Nine text series by order date. The dates are aggregated and kept once."""
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast(MONEY)
    pad = [F.lpad(f("o_orderdate").cast("string"), 2, "0") for f in (F.month, F.dayofmonth)]
    year = (F.year("o_orderdate") + YEAR_SHIFT).cast("string")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    daily = settle(
        orders.groupBy(
            F.concat(pad[0], F.lit("-"), pad[1], F.lit("-"), year).alias("AsOfDate"),
            F.month("o_orderdate").alias("month"),
            F.dayofmonth("o_orderdate").alias("day"),
        ).agg(
            F.sum(price).alias("total"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(urgent, 1).otherwise(0)).alias("urgent"),
        )
    )
    day, month = F.col("day"), F.col("month")

    def series(where: Column | None = None, **columns: Column) -> DataFrame:
        rows = daily if where is None else daily.where(where)
        named = [c.cast("string").alias(n.replace("__", " ")) for n, c in columns.items()]
        return rows.select("AsOfDate", *named)

    total, high, low, n, urgent = [F.col(c) for c in ("total", "high", "low", "n", "urgent")]
    dot = F.when(day % 7 == 0, F.lit("."))
    return {
        "consumersentimentindex": series(Sentiment=total),
        "gdp": series(month.isin(3, 6, 9, 12), GDP=n),
        "goldprice": series(GoldPrice=F.coalesce(dot, high.cast("string"))),
        "house_pricing_index": series(House__Price__Index=low),
        "market_volatility_vix": series(VIX_Open=low, VIX_High=high, VIX_Low=low, VIX_Close=n),
        "oilprice": series(urgent > 0, Oil__Price=urgent),
        "tdsp_fodsp": series(TDSP=n, FODSP=total),
        "ted_spread": series(TED__Spread=high),
        "treasury_yield": series(Treasury__Yield=F.coalesce(dot, n.cast("string"))),
    }


# File names of the series when they are written as delimited text.
SERIES_FILES = {
    "consumersentimentindex": "ConsumerSentimentIndex.csv",
    "gdp": "GDP.csv",
    "goldprice": "GoldPrice.csv",
    "house_pricing_index": "House Pricing-Index.csv",
    "market_volatility_vix": "Market Volatility-VIX.csv",
    "oilprice": "OilPrice.csv",
    "tdsp_fodsp": "TDSP-FODSP.csv",
    "ted_spread": "TED Spread.csv",
    "treasury_yield": "Treasury Yield.csv",
}


def series_folder(spark: SparkSession, sf_dir: str) -> str:
    """Write the series as delimited text into a new folder of the shared one."""
    folder = new_folder(spark, "series")
    for name, df in daily_series(spark, sf_dir).items():
        df.write.option("header", True).csv(f"{folder}/{SERIES_FILES[name]}")
    return folder


def _line_keys() -> list[Column]:
    return [
        F.col("l_partkey").alias("INV_VEH_ID"),
        F.col("l_returnflag").alias("RK_SOLTN_CD"),
        (F.col("l_linenumber") % 3).alias("FUND_SHARE_CLASS_ID"),
        F.col("l_linestatus").alias("INVSR_ACCT_TYP_CD"),
    ]


def _advisor_facts(spark: SparkSession, sf_dir: str, *amounts: Column) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        shifted_month("l_shipdate").alias("MO_NUM"),
        F.col("l_suppkey").alias("FINCL_ITRMY_PRSON_ID"),
        *_line_keys(),
        F.when(F.col("l_linenumber") == 7, F.lit("Y")).otherwise(F.lit("N")).alias("TEAM_IND"),
        *amounts,
    )


def _team_part() -> Column:
    """Quantity, unknown above 45."""
    return F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).cast(MONEY)


def advisor_asset_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets; small quantities cancel against the team part."""
    quantity = F.col("l_quantity")
    value = F.when(quantity < 3, -quantity).otherwise(F.col("l_extendedprice")).cast(MONEY)
    return _advisor_facts(
        spark, sf_dir, value.alias("ASSET_VAL_AMT"), _team_part().alias("TEAM_ALLOC_ASSET_VAL_AMT")
    )


def advisor_sales_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, redeemed = F.col("l_extendedprice").cast(MONEY), F.col("l_returnflag") == "R"
    return _advisor_facts(
        spark,
        sf_dir,
        amount_where(~redeemed, price).alias("SLS_AMT"),
        amount_where(~redeemed, _team_part()).alias("TEAM_ALLOC_SLS_AMT"),
        amount_where(redeemed, -price).alias("RDMPT_AMT"),
        amount_where(redeemed, -_team_part()).alias("TEAM_ALLOC_RDMPT_AMT"),
    )


def vehicle_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund code of every vehicle."""
    brand = F.substring_index("p_brand", "#", -1).cast("int")
    return (
        table(spark, sf_dir, "part")
        .select(
            F.col("p_partkey").alias("InvestmentVehicleID"),
            one_of(BRAND_CODES, brand - 1).alias("ParentFundAcronymCode"),
        )
    )


def business_line_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business lines by vehicle, solution, share class and account type, for the combinations that occur."""
    keys = table(spark, sf_dir, "lineitem").select(*_line_keys()).distinct()
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("INV_VEH_ID"), "p_size")
    size, share = F.col("p_size"), F.col("FUND_SHARE_CLASS_ID")
    return keys.join(parts, "INV_VEH_ID").select(
        "INV_VEH_ID",
        "RK_SOLTN_CD",
        "FUND_SHARE_CLASS_ID",
        "INVSR_ACCT_TYP_CD",
        F.when(size % 3 == 0, F.lit("PC")).otherwise(F.lit("IR")).alias("BusinessLine1"),
        one_of(LINE_2_CYCLE, (size + share) % len(LINE_2_CYCLE)).alias("BusinessLine2"),
        one_of(LINE_3_CYCLE, (size + share) % len(LINE_3_CYCLE)).alias("BusinessLine3"),
    )
