"""Comparison SQL for DuckDB, written independently of the operators.

The inputs are common table expressions over the sample tables; the fixed lists
come from the same value modules the Spark side reads.
"""

from __future__ import annotations

from flowtide.functions import fixed_values as V
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


def quoted(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def sql_list(values) -> str:
    return f"[{', '.join(quoted(v) for v in values)}]"


def in_list(values) -> str:
    return f"({', '.join(quoted(v) for v in values)})"


def coded(column: str, codes: dict[str, str]) -> str:
    branches = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items())
    return f"CASE {column} {branches} END"


def month(date: str) -> str:
    return f"CAST((year({date}) + {YEAR_SHIFT}) * 100 + month({date}) AS INTEGER)"


MONEY = "DECIMAL(18,2)"
PRICE = f"CAST(l_extendedprice AS {MONEY})"
CLASS = "concat('R-', 1 + p_size % 6)"
SUFFIX = f"({sql_list(V.SHARE_CLASS_SUFFIXES)})[p_size % 6 + 1]"
TICKER = f"concat({coded('p_type', PREFIX_OF_TYPE)}, {SUFFIX})"


def amount(test: str, value: str) -> str:
    return f"CAST(CASE WHEN {test} THEN {value} ELSE 0 END AS {MONEY})"


AMOUNTS = f"""
  {amount("l_returnflag = 'N'", PRICE)} AS sale_amount,
  {amount("l_returnflag = 'R'", "-" + PRICE)} AS redemption_amount,
  {amount("l_returnflag = 'A' AND l_linenumber % 2 = 1", PRICE)} AS exchange_in_amount,
  {amount("l_returnflag = 'A' AND l_linenumber % 2 = 0", "-" + PRICE)} AS exchange_out_amount"""

FLOWS = f"""
flows AS (
  SELECT {month('l_shipdate')} AS month_number,
         {coded('p_type', FUND_OF_TYPE)} AS parent_fund_acronym_group,
         {CLASS} AS parent_share_class_name,
         l_linenumber AS line_number,
         {AMOUNTS}
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

RAW = f"""
raw AS (
  SELECT {month('l_shipdate')} AS month_number,
         CASE WHEN o_custkey % 50 = 0 THEN '#' WHEN o_custkey % 50 = 1 THEN '0'
              WHEN o_custkey % 50 = 2 THEN concat('P', o_custkey)
              ELSE CAST(o_custkey AS VARCHAR) END AS retirement_plan_id,
         ({sql_list(ORGANIZATIONS)})[n_nationkey + 1] AS organization_name,
         {coded('c_mktsegment', LINE_OF_SEGMENT)} AS business_line_1,
         {coded('p_type', FUND_OF_TYPE)} AS parent_fund_acronym_group,
         {CLASS} AS parent_share_class_name,
         l_linestatus AS status,
         {AMOUNTS}
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)"""

PATTERNS = f"""
patterns(organization_name_standard, fragment) AS (
  VALUES {', '.join(f"('{firm}', '{p}')" for firm, ps in V.FIRM_PATTERNS.items() for p in ps)})"""


def firms(distinct: bool) -> str:
    return f"""
names AS (
  SELECT DISTINCT ({sql_list(ORGANIZATIONS)})[n_nationkey + 1] AS organization_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
firms AS (
  SELECT {'DISTINCT' if distinct else ''} organization_name, organization_name_standard
  FROM names JOIN patterns ON contains(lower(organization_name), lower(fragment)))"""


FUNDS = f"""
symbols(ticker_symbol, parent_fund_acronym_group, parent_share_class_name) AS (
  VALUES {', '.join(
      f"('{prefix}{end}', '{fund}', '{label}')"
      for fund, prefix in V.FUND_PREFIXES.items()
      for end, label in V.SHARE_CLASS_SUFFIXES.items())}),
listing AS (
  SELECT DISTINCT {TICKER} AS ticker_symbol, CAST(100 + p_size % 4 AS BIGINT) AS investment_vehicle_id
  FROM part),
funds AS (
  SELECT ticker_symbol, parent_fund_acronym_group, investment_vehicle_id, parent_share_class_name
  FROM listing JOIN symbols USING (ticker_symbol))"""

FLOW_KEYS = """month_number, retirement_plan_id, organization_name_standard, business_line_1,
         parent_fund_acronym_group, parent_share_class_name, ticker_symbol, investment_vehicle_id"""


def source(name: str, status: str, tag: str, line: str | None = None) -> str:
    sums = ", ".join(f"sum({m}) AS {m}" for m in V.FLOW_MEASURES)
    return f"""
{name} AS (
  SELECT {FLOW_KEYS}, {sums}, '{tag}' AS data_source
  FROM raw JOIN firms USING (organization_name)
           JOIN funds USING (parent_fund_acronym_group, parent_share_class_name)
  WHERE status = '{status}' AND TRY_CAST(retirement_plan_id AS BIGINT) <> 0
    AND month_number > {V.MONTH_NUMBER_START}
    {f"AND business_line_1 = '{line}'" if line else ""}
  GROUP BY {FLOW_KEYS})"""


SOURCE_A = source("source_a", "F", V.SOURCE_A_TAG)
SOURCE_B = source("source_b", "O", V.SOURCE_B_TAG, V.SOURCE_B_LINE)
ALL_FLOWS = """
all_flows AS (SELECT * FROM source_a UNION ALL SELECT * FROM source_b)"""
FLOW_CTES = [RAW, PATTERNS, firms(True), FUNDS, SOURCE_A, SOURCE_B, ALL_FLOWS]

RETURNS = f"""
returns AS (
  SELECT {month('l_shipdate')} AS month_number, {TICKER} AS ticker_symbol,
         {coded('p_type', CATEGORY_OF_TYPE)} AS morningstar_category_grouped,
         CAST(sum(CAST(l_discount AS {MONEY})) AS DOUBLE) AS return_1_month
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY ALL)"""

DAILY = f"""
daily AS (
  SELECT concat(lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), '-',
                lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0'), '-',
                year(o_orderdate) + {YEAR_SHIFT}) AS AsOfDate,
         {month('o_orderdate')} AS month_number,
         month(o_orderdate) AS m, day(o_orderdate) AS d,
         sum(CAST(o_totalprice AS {MONEY})) AS total,
         max(CAST(o_totalprice AS {MONEY})) AS high,
         min(CAST(o_totalprice AS {MONEY})) AS low,
         count(*) AS n,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent
  FROM orders GROUP BY ALL),
s1 AS (SELECT AsOfDate, month_number, d, CAST(total AS VARCHAR) AS "Sentiment" FROM daily),
s2 AS (SELECT AsOfDate, CAST(n AS VARCHAR) AS "GDP" FROM daily WHERE m IN (3, 6, 9, 12)),
s3 AS (SELECT AsOfDate, CASE WHEN d % 7 = 0 THEN '.' ELSE CAST(high AS VARCHAR) END AS "GoldPrice" FROM daily),
s4 AS (SELECT AsOfDate, CAST(low AS VARCHAR) AS "House_Price_Index" FROM daily),
s5 AS (SELECT AsOfDate, CAST(low AS VARCHAR) AS "VIX_Open", CAST(high AS VARCHAR) AS "VIX_High",
              CAST(low AS VARCHAR) AS "VIX_Low", CAST(n AS VARCHAR) AS "VIX_Close" FROM daily),
s6 AS (SELECT AsOfDate, CAST(urgent AS VARCHAR) AS "Oil_Price" FROM daily WHERE urgent > 0),
s7 AS (SELECT AsOfDate, CAST(n AS VARCHAR) AS "TDSP", CAST(total AS VARCHAR) AS "FODSP" FROM daily),
s8 AS (SELECT AsOfDate, CAST(high AS VARCHAR) AS "TED_Spread" FROM daily),
s9 AS (SELECT AsOfDate, CASE WHEN d % 7 = 0 THEN '.' ELSE CAST(n AS VARCHAR) END AS "Treasury_Yield" FROM daily),
series AS (
  SELECT * FROM s1 LEFT JOIN s2 USING (AsOfDate) LEFT JOIN s3 USING (AsOfDate)
    LEFT JOIN s4 USING (AsOfDate) LEFT JOIN s5 USING (AsOfDate) LEFT JOIN s6 USING (AsOfDate)
    LEFT JOIN s7 USING (AsOfDate) LEFT JOIN s8 USING (AsOfDate) LEFT JOIN s9 USING (AsOfDate))"""

MEASURES = [
    "Sentiment", "GDP", "GoldPrice", "House_Price_Index", "VIX_Open", "VIX_High", "VIX_Low",
    "VIX_Close", "Oil_Price", "TDSP", "FODSP", "TED_Spread", "Treasury_Yield",
]


def number(name: str) -> str:
    return f'TRY_CAST("{name}" AS DOUBLE)'


MACRO_DAILY = f"SELECT month_number, {', '.join(f'{number(m)} AS {m}' for m in MEASURES)} FROM series"
MACRO_LAST = f"""
SELECT month_number,
       {', '.join(f'max_by({number(m)}, d) FILTER ({number(m)} IS NOT NULL) AS {m}' for m in MEASURES)}
FROM series GROUP BY month_number"""

KEPT_MEASURES = [m for m in MEASURES if m not in V.MACRO_DROPPED]
BASE = f"""
macro AS ({MACRO_LAST}),
base AS (
  SELECT month_number, ticker_symbol, all_flows.* EXCLUDE (month_number, ticker_symbol),
         {', '.join(KEPT_MEASURES)}, morningstar_category_grouped, return_1_month
  FROM all_flows JOIN macro USING (month_number) JOIN returns USING (month_number, ticker_symbol))"""
BASE_CTES = [*FLOW_CTES, RETURNS, DAILY, BASE]
BASE_VALUES = [*V.FLOW_MEASURES, *KEPT_MEASURES, "return_1_month"]

DAILY_BASE = BASE.replace(MACRO_LAST, MACRO_DAILY)
DAILY_FILLED = f"""
peers AS (
  SELECT *, {', '.join(f'max({c}) OVER same AS high_{c}, min({c}) OVER same AS low_{c}' for c in BASE_VALUES)}
  FROM base WINDOW same AS (PARTITION BY {', '.join(V.FILL_KEYS)}, month_number)),
filled AS (
  SELECT * EXCLUDE ({', '.join(f'high_{c}, low_{c}' for c in BASE_VALUES)}) REPLACE (
    {', '.join(f'coalesce({c}, last_value(high_{c} IGNORE NULLS) OVER past, first_value(low_{c} IGNORE NULLS) OVER ahead) AS {c}' for c in BASE_VALUES)})
  FROM peers
  WINDOW past AS (PARTITION BY {', '.join(V.FILL_KEYS)} ORDER BY month_number
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY {', '.join(V.FILL_KEYS)} ORDER BY month_number
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

FILLED = f"""
ff AS (
  SELECT * EXCLUDE ({', '.join(BASE_VALUES)}),
         {', '.join(f'last_value({c} IGNORE NULLS) OVER past AS {c}' for c in BASE_VALUES)}
  FROM base
  WINDOW past AS (PARTITION BY {', '.join(V.FILL_KEYS)} ORDER BY month_number, ticker_symbol
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filled AS (
  SELECT * EXCLUDE ({', '.join(BASE_VALUES)}),
         {', '.join(f'first_value({c} IGNORE NULLS) OVER ahead AS {c}' for c in BASE_VALUES)}
  FROM ff
  WINDOW ahead AS (PARTITION BY {', '.join(V.FILL_KEYS)} ORDER BY month_number, ticker_symbol
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

FIRST_SEEN = f"""
filled AS (
  SELECT * EXCLUDE ({', '.join(BASE_VALUES)}),
         {', '.join(f'first_value({c} IGNORE NULLS) OVER past AS {c}' for c in BASE_VALUES)}
  FROM base
  WINDOW past AS (PARTITION BY {', '.join(V.FILL_KEYS)} ORDER BY month_number, ticker_symbol
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def doubles(columns) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def as_doubles(table: str, columns=V.FLOW_MEASURES) -> str:
    return f"SELECT * REPLACE ({doubles(columns)}) FROM {table}"


def with_(ctes, query: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + query


# Money in motion: shares by the largest remainder, then units left over along two lines


def _split(value: str, total: str, name: str) -> str:
    whole, rest = f"{value} * moved // nullif({total}, 0)", f"coalesce({value} * moved % nullif({total}, 0), 0)"
    return (
        f"coalesce({whole}, 0) + CASE WHEN row_number() OVER (PARTITION BY plan, year ORDER BY {rest} DESC, category) "
        f"<= moved - sum(coalesce({whole}, 0)) OVER (PARTITION BY plan, year) THEN 1 ELSE 0 END AS {name}"
    )


MOTION = f"""
lines AS (
  SELECT CASE WHEN o_custkey % 50 = 0 THEN '#' WHEN o_custkey % 50 = 1 THEN '0'
              WHEN o_custkey % 50 = 2 THEN concat('P', o_custkey) ELSE CAST(o_custkey AS VARCHAR) END AS plan,
         CAST(year(l_shipdate) + {YEAR_SHIFT} AS INTEGER) AS year, {coded('p_type', CATEGORY_OF_TYPE)} AS category, {AMOUNTS}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
sides AS (
  SELECT plan, year, coalesce(category, 'unknown') AS category,
         CAST(100 * sum(sale_amount + exchange_in_amount) AS HUGEINT) AS a,
         CAST(-100 * sum(redemption_amount + exchange_out_amount) AS HUGEINT) AS b
  FROM lines GROUP BY ALL),
signed AS (
  SELECT plan, year, category, greatest(a, 0) + greatest(-b, 0) AS came, greatest(b, 0) + greatest(-a, 0) AS went FROM sides),
totals AS (
  SELECT *, sum(came) OVER w AS all_came, sum(went) OVER w AS all_went,
         least(sum(came) OVER w, sum(went) OVER w) AS moved FROM signed WINDOW w AS (PARTITION BY plan, year)),
shares AS (SELECT *, {_split("went", "all_went", "gone")}, {_split("came", "all_came", "entered")} FROM totals),
cells AS (
  SELECT x.plan, x.year, x.category AS from_class, y.category AS to_class, x.gone, y.entered,
         x.gone * y.entered // x.moved AS part
  FROM shares x JOIN shares y ON x.plan = y.plan AND x.year = y.year WHERE x.gone > 0 AND y.entered > 0),
short AS (
  SELECT *, gone - sum(part) OVER (PARTITION BY plan, year, from_class) AS r,
         entered - sum(part) OVER (PARTITION BY plan, year, to_class) AS c FROM cells),
lines_of AS (
  SELECT *, sum(r) OVER (PARTITION BY plan, year, to_class ORDER BY from_class) AS r_to,
         sum(c) OVER (PARTITION BY plan, year, from_class ORDER BY to_class) AS c_to FROM short),
moves AS (
  SELECT plan, year, from_class, to_class, part + greatest(0, least(r_to, c_to) - greatest(r_to - r, c_to - c)) AS units FROM lines_of
  UNION ALL SELECT plan, year, category, NULL, went - gone FROM shares
  UNION ALL SELECT plan, year, NULL, category, came - entered FROM shares)"""

MOTION_ROWS = (
    "SELECT plan, year, from_class, to_class, CAST(CAST(units AS DECIMAL(28,0)) / 100 AS DOUBLE) AS amount FROM moves WHERE units > 0"
)

NUMBERS_IN_NAMES = (
    "SELECT DISTINCT c_name AS organization_name, s_name AS organization_name_standard "
    "FROM customer JOIN supplier ON contains(lower(c_name), lower(right(s_name, 5)))"
)


# Windows


def average(value: str, window: str) -> str:
    return f"CAST(sum({value}) OVER {window} AS DOUBLE) / nullif(count({value}) OVER {window}, 0)"


ROW_FRAMES = {n: f"w{n}" for n in V.WINDOW_SIZES}


def moving(value: str, table: str, extra: str = "") -> str:
    windows = ", ".join(
        f"w{n} AS (PARTITION BY parent_fund_acronym_group ORDER BY month_counter "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in V.WINDOW_SIZES
    )
    averages = ", ".join(f"{average(value, f'w{n}')} AS moving_average_{n}" for n in V.WINDOW_SIZES)
    return f"SELECT * REPLACE (CAST({value} AS DOUBLE) AS {value}), {averages} {extra} FROM {table} WINDOW {windows}"


RANK = "CAST(dense_rank() OVER (ORDER BY month_number) AS INTEGER) AS month_counter"


def totals(expression: str, name: str, where: str = "") -> str:
    return f"""
totals AS (
  SELECT month_number, parent_fund_acronym_group, {expression} AS {name}, {RANK}
  FROM flows {where} GROUP BY month_number, parent_fund_acronym_group)"""


REDEEMED = totals("abs(sum(redemption_amount))", "abs_tot_rdmpt_amt")
NET = totals("sum(redemption_amount) + sum(sale_amount)", "net_cash_flow")
PLACED = f"""
placed AS (
  SELECT *, row_number() OVER (ORDER BY month_number DESC NULLS LAST, {', '.join(f'{c} NULLS FIRST' for c in (
      'parent_fund_acronym_group', 'parent_share_class_name', 'line_number', *V.FLOW_MEASURES))}) AS position
  FROM flows)"""
GFA = "WHERE parent_fund_acronym_group = 'GFA'"
GFA_REDEEMED = totals("abs(sum(redemption_amount))", "abs_tot_rdmpt_amt", GFA)

LABEL = (
    ", CASE "
    + " ".join(
        f"WHEN abs_tot_rdmpt_amt * count(*) OVER w{n} > sum(abs_tot_rdmpt_amt) OVER w{n} THEN '{text}'"
        for n, text in V.ANOMALY_LEVELS.items()
    )
    + f" ELSE '{V.ANOMALY_NONE}' END AS period_anomaly_type"
)

SERIES_SUMS = {
    "abs_redemption_amount": "abs(redemption_amount)",
    "redemption_amount": "redemption_amount",
    "sale_amount": "sale_amount",
    "exchange_in_amount": "exchange_in_amount",
    "exchange_out_amount": "exchange_out_amount",
    "out_amount": "redemption_amount + exchange_out_amount",
    "net_flow_amount": "redemption_amount + sale_amount",
    "exchange_net_flow_amount": "exchange_in_amount + exchange_out_amount",
    "total_net_flow_amount": "redemption_amount + sale_amount + exchange_in_amount + exchange_out_amount",
}


def flow_series(names: dict[str, str]) -> str:
    sums = ", ".join(
        f"CAST(sum({e}) AS DOUBLE) AS {names.get(n, n)}" for n, e in SERIES_SUMS.items()
    )
    m, f = "month_number", "parent_fund_acronym_group"
    return with_(
        [FLOWS],
        f"SELECT {m} AS {names.get(m, m)}, {f} AS {names.get(f, f)}, {sums}, {RANK} "
        f"FROM flows {GFA} GROUP BY month_number, parent_fund_acronym_group",
    )


PEERS = "parent_fund_acronym_group, parent_share_class_name"
GAPS = f"""
gaps AS (
  SELECT * REPLACE (CASE WHEN month_number % 100 <= 4 AND line_number = 1 THEN sale_amount END AS sale_amount)
  FROM flows),
peers AS (
  SELECT {PEERS}, month_number, max(sale_amount) AS top, min(sale_amount) AS low
  FROM gaps GROUP BY {PEERS}, month_number)"""


def fill_values(name: str, table: str, function: str, value: str, frame: str) -> str:
    return f"""
{name} AS (
  SELECT {PEERS}, month_number, {function}({value} IGNORE NULLS) OVER (
    PARTITION BY {PEERS} ORDER BY month_number ROWS BETWEEN {frame}) AS found
  FROM {table})"""


PAST = "UNBOUNDED PRECEDING AND CURRENT ROW"
AHEAD = "CURRENT ROW AND UNBOUNDED FOLLOWING"
LATEST = fill_values("latest", "peers", "last_value", "top", PAST)
NEXT = fill_values("following", "peers", "first_value", "low", AHEAD)
FIRST = fill_values("first_seen", "peers", "first_value", "low", PAST)


def replaced(rows: str, values: str, expression: str) -> str:
    return (
        f"SELECT {rows}.* REPLACE ({expression} AS sale_amount) "
        f"FROM {rows} JOIN {values} USING ({PEERS}, month_number)"
    )


FORWARD = replaced("gaps", "latest", "coalesce(sale_amount, found)")
FILLED_GAPS = f"""
forward AS ({FORWARD}),
rest AS (SELECT {PEERS}, month_number, min(sale_amount) AS low FROM forward GROUP BY {PEERS}, month_number)"""


def trailing(axis: str, reach: int, by: str, table: str, doubled) -> str:
    windows = ", ".join(
        f"w{p} AS (PARTITION BY {by} ORDER BY {axis} RANGE BETWEEN {p + reach} PRECEDING AND 1 PRECEDING)"
        for p in V.WINDOW_SIZES
    )
    means = ", ".join(
        f"{average('redemption_amount', f'w{p}')} AS avg_redemption_amount_lag_{p}_months"
        for p in V.WINDOW_SIZES
    )
    return f"SELECT * REPLACE ({doubles(doubled)}), {means} FROM {table} WINDOW {windows}"


INDEX = "(month_number // 100 * 12 + month_number % 100)"

# One history of any length

LEDGER = f"""
ledger AS (
  SELECT 'all' AS ledger, CAST(l_orderkey AS BIGINT) AS entry, CAST(l_linenumber AS INTEGER) AS line_number,
         CASE WHEN l_orderkey % 7 = 3 AND l_linenumber = 1 THEN {PRICE} END AS sale_amount,
         CASE WHEN l_returnflag = 'R' THEN -{PRICE} END AS redemption_amount
  FROM lineitem),
entries AS (SELECT entry, max(sale_amount) AS top, min(sale_amount) AS low FROM ledger GROUP BY entry),
known AS (
  SELECT entry, last_value(top IGNORE NULLS) OVER (ORDER BY entry ROWS BETWEEN {PAST}) AS before,
         first_value(low IGNORE NULLS) OVER (ORDER BY entry ROWS BETWEEN {AHEAD}) AS after,
         first_value(low IGNORE NULLS) OVER (ORDER BY entry ROWS BETWEEN {PAST}) AS first
  FROM entries)"""
LEDGER_FILLS = """
SELECT ledger, entry, line_number, CAST(sale_amount AS DOUBLE) AS sale_amount,
       CAST(redemption_amount AS DOUBLE) AS redemption_amount,
       CAST(coalesce(sale_amount, before) AS DOUBLE) AS forward, CAST(coalesce(sale_amount, after) AS DOUBLE) AS backward,
       CAST(first AS DOUBLE) AS first, CAST(coalesce(sale_amount, before, after) AS DOUBLE) AS nearest
FROM ledger JOIN known USING (entry)"""
LEDGER_TRAILING = f"""
SELECT ledger, entry, line_number, {doubles(["sale_amount", "redemption_amount"])},
       {', '.join(f"{average('redemption_amount', f'w{p}')} AS avg_redemption_amount_lag_{p}" for p in (3, 50, 1000))}
FROM ledger
WINDOW {', '.join(f"w{p} AS (PARTITION BY ledger ORDER BY entry RANGE BETWEEN {p} PRECEDING AND 1 PRECEDING)" for p in (3, 50, 1000))}"""

SHARE = f"""
monthly AS (
  SELECT month_number, {PEERS}, abs(sum(redemption_amount)) AS abs_tot_rdmpt_amt FROM flows GROUP BY ALL),
holdings AS (
  SELECT {month('l_shipdate')} AS assets_month, {coded('p_type', FUND_OF_TYPE)} AS parent_fund_acronym_group,
         {CLASS} AS parent_share_class_name, sum({PRICE}) AS assets
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE month(l_shipdate) IN (3, 9) GROUP BY ALL),
found AS (
  SELECT m.*, h.assets_month AS reported, h.assets AS reported_assets
  FROM monthly m ASOF LEFT JOIN holdings h
    ON m.parent_fund_acronym_group = h.parent_fund_acronym_group
    AND m.parent_share_class_name = h.parent_share_class_name AND m.month_number >= h.assets_month),
aged AS (
  SELECT *, {INDEX} - (reported // 100 * 12 + reported % 100) <= 4 AS fresh FROM found)"""
SHARE_ROWS = f"""
SELECT month_number, {PEERS}, CAST(abs_tot_rdmpt_amt AS DOUBLE) AS abs_tot_rdmpt_amt,
       CASE WHEN fresh THEN CAST(reported_assets AS DOUBLE) END AS assets, CASE WHEN fresh THEN CAST(reported AS DOUBLE) END AS assets_month,
       CASE WHEN fresh THEN CAST(abs_tot_rdmpt_amt AS DOUBLE) / nullif(CAST(reported_assets AS DOUBLE), 0) END AS redemption_share
FROM aged"""

PEER_RETURNS = """
SELECT *, percent_rank() OVER (PARTITION BY month_number, morningstar_category_grouped ORDER BY return_1_month) AS percent_rank
FROM returns"""
PEER_SALES = f"""
ranked AS (
  SELECT {coded('p_type', CATEGORY_OF_TYPE)} AS category, {month('l_shipdate')} AS month_number,
         percent_rank() OVER (PARTITION BY {coded('p_type', CATEGORY_OF_TYPE)} ORDER BY {PRICE}) AS percent_rank
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
PEER_SALES_ROWS = """
SELECT category, month_number, count(*) AS n_rows, max(percent_rank) AS highest, min(percent_rank) AS lowest
FROM ranked GROUP BY category, month_number"""

# Indicators of earlier months


def index_of(column: str) -> str:
    return f"({column} // 100 * 12 + {column} % 100)"


LAGGED = f"""
macro AS ({MACRO_LAST}),
ends AS (SELECT min({INDEX}) AS low, max({INDEX}) + 6 AS high FROM macro),
months AS (SELECT unnest(range(low, high + 1)) AS idx FROM ends)"""
LAGGED_ROWS = f"""
SELECT CAST((idx - 1) // 12 * 100 + (idx - 1) % 12 + 1 AS INTEGER) AS month_number,
       {', '.join(f'm{n}.{c} AS {c}_lag_{n}' for c in ('GDP', 'Oil_Price', 'Sentiment') for n in (1, 3, 6))}
FROM months {' '.join(f"LEFT JOIN macro m{n} ON idx - {n} = {index_of(f'm{n}.month_number')}" for n in (1, 3, 6))}"""

TRIED = [(c, n) for c in ("GoldPrice", "House_Price_Index", "TED_Spread", "GDP") for n in (0, 1, 3, 6)]
CORRELATED = f"""
labels AS ({moving("abs_tot_rdmpt_amt", "totals", LABEL)}),
macro AS ({MACRO_LAST}),
high AS (SELECT {INDEX} AS idx, CASE WHEN period_anomaly_type <> '{V.ANOMALY_NONE}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM labels)"""
CORRELATED_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS indicator, CAST({n} AS INTEGER) AS lag, count({c}) AS n_months, "
    f"round(corr({c}, y), 8) AS correlation FROM high LEFT JOIN macro ON idx - {n} = {INDEX}"
    for c, n in TRIED
)

# Advisor tables

ADVISOR = f"""
facts AS (
  SELECT {month('l_shipdate')} AS MO_NUM, l_suppkey AS PERSON, l_partkey AS INV_VEH_ID,
         l_returnflag AS RK_SOLTN_CD, l_linenumber % 3 AS FUND_SHARE_CLASS_ID,
         l_linestatus AS INVSR_ACCT_TYP_CD, CASE WHEN l_linenumber = 7 THEN 'Y' ELSE 'N' END AS TEAM_IND,
         CAST(CASE WHEN l_quantity < 3 THEN -l_quantity ELSE l_extendedprice END AS {MONEY}) AS asset_value,
         CAST(CASE WHEN l_quantity <= 45 THEN l_quantity END AS {MONEY}) AS team_value,
         {amount("l_returnflag <> 'R'", PRICE)} AS sold,
         {amount("l_returnflag = 'R'", "-" + PRICE)} AS redeemed
  FROM lineitem),
vehicles AS (
  SELECT p_partkey AS INV_VEH_ID,
         ({sql_list(BRAND_CODES)})[CAST(split_part(p_brand, '#', 2) AS INTEGER)] AS code
  FROM part),
lines AS (
  SELECT p_partkey AS INV_VEH_ID, RK_SOLTN_CD, FUND_SHARE_CLASS_ID, INVSR_ACCT_TYP_CD,
         CASE WHEN p_size % 3 = 0 THEN 'PC' ELSE 'IR' END AS line_1,
         ({sql_list(LINE_2_CYCLE)})[(p_size + FUND_SHARE_CLASS_ID) % {len(LINE_2_CYCLE)} + 1] AS line_2,
         ({sql_list(LINE_3_CYCLE)})[(p_size + FUND_SHARE_CLASS_ID) % {len(LINE_3_CYCLE)} + 1] AS line_3
  FROM (SELECT DISTINCT l_partkey, l_returnflag AS RK_SOLTN_CD, l_linenumber % 3 AS FUND_SHARE_CLASS_ID,
               l_linestatus AS INVSR_ACCT_TYP_CD FROM lineitem)
  JOIN part ON l_partkey = p_partkey),
joined AS (
  SELECT facts.*, code, line_1, line_2, line_3,
         asset_value + team_value AS assets,
         sold + CASE WHEN RK_SOLTN_CD <> 'R' THEN team_value ELSE 0 END AS sales,
         redeemed - CASE WHEN RK_SOLTN_CD = 'R' THEN team_value ELSE 0 END AS redemptions
  FROM facts LEFT JOIN vehicles USING (INV_VEH_ID)
  LEFT JOIN lines USING (INV_VEH_ID, RK_SOLTN_CD, FUND_SHARE_CLASS_ID, INVSR_ACCT_TYP_CD)
  WHERE MO_NUM >= {V.ADVISOR_MONTH_START} AND TEAM_IND = 'N' AND PERSON <> 0)"""

TARGET_DATE = "(" + " OR ".join(f"code LIKE '{p}%'" for p in V.TARGET_DATE_PREFIXES) + ")"
LINE_TESTS = {
    "IR": f"line_1 = '{V.LINE_1_ALL}'",
    "DCIO": f"line_2 = '{V.LINE_2_DCIO}'",
    "DCProp": f"line_3 IN {in_list(V.LINE_3_PROPRIETARY)}",
    "DCSmallRPSolution": f"line_2 = '{V.LINE_2_SMALL}'",
    "OtherIR": f"line_2 NOT IN ('{V.LINE_2_DCIO}', '{V.LINE_2_SMALL}')",
}


def bucket_test(bucket: str) -> str:
    return TARGET_DATE if bucket == V.TARGET_DATE_BUCKET else f"code = '{bucket}'"


def wide_sums(prefix: str, value: str, absolute: bool, all_lines: bool) -> list[str]:
    tests = dict(LINE_TESTS)
    if all_lines:
        tests["IR"] = "TRUE"
    named = {f"{prefix}_{n}": t for n, t in tests.items()}
    for suffix, line in (("DCIO", V.LINE_2_DCIO), ("SmallRP", V.LINE_2_SMALL)):
        for bucket in V.FUND_BUCKETS:
            named[f"Fund{prefix}{bucket}_{suffix}"] = f"{bucket_test(bucket)} AND line_2 = '{line}'"
    form = "abs(sum({}))" if absolute else "sum({})"
    return [
        f"CAST({form.format(f'CASE WHEN {t} THEN {value} ELSE 0 END')} AS DOUBLE) AS {n}"
        for n, t in named.items()
    ]


def advisor(columns: list[str], where: str) -> str:
    first = "make_date(MO_NUM // 100, MO_NUM % 100, 1)"
    return with_(
        [ADVISOR],
        f"SELECT CAST({first} + INTERVAL 1 MONTH AS DATE) AS MonthDate, "
        f"PERSON AS FinancialIntermediaryPersonID, {', '.join(columns)} "
        f"FROM joined WHERE {where} GROUP BY MO_NUM, PERSON",
    )


ASSETS_BY_BUCKET = ", ".join(
    f"CAST(sum(CASE WHEN {bucket_test(b)} AND INVSR_ACCT_TYP_CD = '{t}' THEN assets ELSE 0 END) AS DOUBLE) "
    f"AS assets_{b}_{t}"
    for t in ("F", "O")
    for b in V.FUND_BUCKETS
)
LINE_NAMES = {
    "IR": "assets_ir",
    "DCIO": "assets_dcio",
    "DCProp": "assets_prop",
    "DCSmallRPSolution": "assets_small",
    "OtherIR": "assets_other",
}
LINE_COLUMNS = ", ".join(
    f"CAST(sum(CASE WHEN {t} THEN assets ELSE 0 END) AS DOUBLE) AS {LINE_NAMES[n]}"
    for n, t in LINE_TESTS.items()
)
FIRM_TABLE_SOURCE = [RAW, PATTERNS, firms(False), FUNDS, SOURCE_A]
MONTHLY = """SELECT month_number, parent_fund_acronym_group,
  CAST(abs(sum(redemption_amount)) AS DOUBLE) AS abs_tot_rdmpt_amt
FROM flows GROUP BY month_number, parent_fund_acronym_group"""

ORACLE = {
    "month_counter": with_([FLOWS], f"SELECT month_number, {RANK} FROM flows GROUP BY month_number"),
    "fund_redemptions": with_([FLOWS, REDEEMED], as_doubles("totals", ["abs_tot_rdmpt_amt"])),
    "ordered_flows": with_([FLOWS, PLACED], as_doubles("placed")),
    "fund_detail": with_(
        [FLOWS],
        f"SELECT * REPLACE ({doubles(V.FLOW_MEASURES)}), "
        f"CAST(abs(redemption_amount) AS DOUBLE) AS abs_redemption_amount, {RANK} FROM flows {GFA}",
    ),
    "redemption_moving_avg": with_([FLOWS, REDEEMED], moving("abs_tot_rdmpt_amt", "totals")),
    "ncf_moving_avg": with_([FLOWS, NET], moving("net_cash_flow", "totals")),
    "anomaly_labels": with_([FLOWS, GFA_REDEEMED], moving("abs_tot_rdmpt_amt", "totals", LABEL)),
    "fund_flow_series": flow_series({}),
    "fund_flow_series_legacy_names": flow_series(V.LEGACY_SERIES_COLUMNS),
    "net_flow_two_ways": with_(
        [ADVISOR],
        "SELECT MO_NUM, CAST(sum(asset_value) + sum(team_value) AS DOUBLE) AS sum_of_sums, "
        "CAST(sum(asset_value + team_value) AS DOUBLE) AS sum_of_rows FROM facts GROUP BY MO_NUM",
    ),
    "firm_lookup": with_([PATTERNS, firms(True)], "SELECT * FROM firms"),
    "firm_lookup_indexed": with_([PATTERNS, firms(True)], "SELECT * FROM firms"),
    "names_with_numbers": NUMBERS_IN_NAMES,
    "money_in_motion": with_([MOTION], MOTION_ROWS),
    "firm_lookup_raw": with_([PATTERNS, firms(False)], "SELECT * FROM firms"),
    "fund_lookup": with_([FUNDS], "SELECT * FROM funds"),
    "flows_source_a": with_([*FLOW_CTES[:4], SOURCE_A], as_doubles("source_a")),
    "flows_source_b": with_([*FLOW_CTES[:4], SOURCE_B], as_doubles("source_b")),
    "flows_all": with_(FLOW_CTES, as_doubles("all_flows")),
    "flows_by_firm_table": with_(FIRM_TABLE_SOURCE, as_doubles("source_a")),
    "union_of_sources": with_(
        [RAW],
        "SELECT month_number AS monthnumber, CASE status WHEN 'F' THEN 'inst' ELSE 'iriis' END AS data_source, "
        "count(*) AS n_rows, CAST(sum(sale_amount) AS DOUBLE) AS sale_amount FROM raw GROUP BY ALL",
    ),
    "valid_plans": with_(
        [RAW],
        "SELECT month_number, business_line_1, count(*) AS n_rows FROM raw WHERE "
        f"TRY_CAST(retirement_plan_id AS BIGINT) <> 0 AND month_number > {V.MONTH_NUMBER_START} GROUP BY ALL",
    ),
    "share_classes": with_(
        [FUNDS],
        'SELECT ticker_symbol AS "TradingSymbol", investment_vehicle_id AS "InvestmentVehicleId", '
        f"{coded('right(ticker_symbol, 2)', V.SHARE_CLASS_SUFFIXES)} AS share_class FROM listing",
    ),
    "macro_monthly": with_([DAILY], MACRO_DAILY),
    "macro_last_of_month": with_([DAILY], MACRO_LAST),
    "macro_text": with_(
        [DAILY], f"SELECT month_number AS mo_num, {', '.join(MEASURES)} FROM series"
    ),
    "macro_from_files": with_([DAILY], MACRO_DAILY),
    "month_dates": with_(
        [DAILY],
        'SELECT AsOfDate AS "AsOfDate", month_number, '
        f"CAST({INDEX} AS INTEGER) AS month_index, "
        "CAST(make_date(month_number // 100, month_number % 100, 1) + INTERVAL 1 MONTH AS DATE) AS month_date "
        "FROM daily",
    ),
    "base_table": with_(BASE_CTES, as_doubles("base")),
    "base_filled": with_([*BASE_CTES, FILLED], as_doubles("filled")),
    "base_filled_daily": with_(
        [*FLOW_CTES, RETURNS, DAILY, DAILY_BASE, DAILY_FILLED],
        "SELECT month_number, ticker_symbol, count(*) AS n_rows, "
        f"{', '.join(f'CAST(sum(CAST({c} AS DECIMAL(28,2))) AS DOUBLE) AS {c}' for c in BASE_VALUES)} "
        "FROM filled GROUP BY ALL",
    ),
    "base_features": with_(
        [*BASE_CTES, FILLED], trailing(INDEX, 0, ", ".join(V.TRAILING_KEYS), "filled", V.FLOW_MEASURES)
    ),
    "base_features_literal": with_(
        [*BASE_CTES, FIRST_SEEN],
        trailing("month_number", 1, ", ".join(V.TRAILING_KEYS), "filled", V.FLOW_MEASURES),
    ),
    "forward_fill": with_([FLOWS, GAPS, LATEST, f"forward AS ({FORWARD})"], as_doubles("forward")),
    "back_fill": with_(
        [FLOWS, GAPS, NEXT, f"back AS ({replaced('gaps', 'following', 'coalesce(sale_amount, found)')})"],
        as_doubles("back"),
    ),
    "running_first": with_(
        [FLOWS, GAPS, FIRST, f"firsts AS ({replaced('gaps', 'first_seen', 'found')})"], as_doubles("firsts")
    ),
    "fill_gaps": with_(
        [FLOWS, GAPS, LATEST, FILLED_GAPS,
         fill_values("following", "rest", "first_value", "low", AHEAD),
         f"done AS ({replaced('forward', 'following', 'coalesce(sale_amount, found)')})"],
        as_doubles("done"),
    ),
    "trailing_avg": with_([FLOWS], trailing(INDEX, 0, PEERS, "flows", V.FLOW_MEASURES)),
    "trailing_avg_literal": with_([FLOWS], trailing("month_number", 1, PEERS, "flows", V.FLOW_MEASURES)),
    "ledger_fills": with_([LEDGER], LEDGER_FILLS),
    "ledger_trailing": with_([LEDGER], LEDGER_TRAILING),
    "trailing_avg_segments": with_([FLOWS], trailing(INDEX, 0, PEERS, "flows", V.FLOW_MEASURES)),
    "redemption_share": with_([FLOWS, SHARE], SHARE_ROWS),
    "peer_rank_returns": with_([RETURNS], PEER_RETURNS),
    "peer_rank_sales": with_([PEER_SALES], PEER_SALES_ROWS),
    "advisor_assets": advisor(wide_sums("Assets", "assets", False, False), "assets <> 0"),
    "advisor_sales": advisor(
        wide_sums("Sales", "sales", True, True) + wide_sums("Redemptions", "redemptions", True, True),
        "sales + redemptions <> 0",
    ),
    "line_sums": with_([ADVISOR], f"SELECT MO_NUM, {LINE_COLUMNS} FROM joined WHERE assets <> 0 GROUP BY MO_NUM"),
    "fund_line_pivot": with_(
        [ADVISOR], f"SELECT MO_NUM, {ASSETS_BY_BUCKET} FROM joined WHERE assets <> 0 GROUP BY MO_NUM"
    ),
    "advisor_dimensions": with_(
        [ADVISOR],
        'SELECT code AS "ParentFundAcronymCode", line_2 AS "BusinessLine2", count(*) AS n_rows, '
        "CAST(sum(assets) AS DOUBLE) AS assets FROM joined WHERE assets <> 0 GROUP BY ALL",
    ),
    "lagged_indicators": with_([DAILY, LAGGED], LAGGED_ROWS),
    "macro_correlation": with_([FLOWS, GFA_REDEEMED, DAILY, CORRELATED], CORRELATED_ROWS),
    "incremental_flows": with_(
        [FLOWS],
        f"SELECT parent_fund_acronym_group, month_number, {', '.join(f'CAST(sum({e}) AS DOUBLE) AS {n}' for n, e in SERIES_SUMS.items())}, "
        "CAST(month_number // 100 AS BIGINT) AS year FROM flows GROUP BY parent_fund_acronym_group, month_number",
    ),
    "snapshot_fund_lookup": with_([FUNDS], "SELECT * FROM funds"),
    "view_redemptions": with_([FLOWS], MONTHLY),
}
