"""The names, codes and patterns a result depends on.

They are data, not logic. Every operator takes them as parameters; these are
the defaults.
"""

# Raw column names of the flow sources and their standard names.
FLOW_COLUMNS = {
    "monthnumber": "month_number",
    "retirementplanid": "retirement_plan_id",
    "organizationname": "organization_name",
    "businessline1": "business_line_1",
    "parentfundacronymgroup": "parent_fund_acronym_group",
    "parentshareclassname": "parent_share_class_name",
    "saleamount": "sale_amount",
    "redemptionamount": "redemption_amount",
    "exchangeinamount": "exchange_in_amount",
    "exchangeoutamount": "exchange_out_amount",
}

# Raw column names of the ticker listing.
LISTING_COLUMNS = {
    "TradingSymbol": "ticker_symbol",
    "InvestmentVehicleId": "investment_vehicle_id",
}

# The older names some analyses use for the same columns.
LEGACY_FLOW_COLUMNS = {
    "month_number": "mo_num",
    "parent_fund_acronym_group": "fund_acrnm_cd",
    "redemption_amount": "rdmpt_amt",
    "sale_amount": "sls_amt",
    "exchange_in_amount": "exchg_in_amt",
    "exchange_out_amount": "exchg_out_amt",
    "abs_redemption_amount": "abs_rdmpt_amt",
    "out_amount": "out_amt",
    "net_flow_amount": "net_flow_amt",
    "exchange_net_flow_amount": "exchg_net_flow_amt",
    "total_net_flow_amount": "tot_net_flow_amt",
}

# The older names of the flow series' columns.
LEGACY_SERIES_COLUMNS = {
    **LEGACY_FLOW_COLUMNS,
    "redemption_amount": "_rdmpt_amt",
    "abs_redemption_amount": "_abs_rdmpt_amt",
}

# Keys and measures of the standard flow table.
PLAN_KEYS = [
    "month_number",
    "retirement_plan_id",
    "organization_name_standard",
    "business_line_1",
]
FUND_KEYS = ["parent_fund_acronym_group", "parent_share_class_name"]
VEHICLE_KEYS = ["ticker_symbol", "investment_vehicle_id"]
FLOW_MEASURES = [
    "sale_amount",
    "redemption_amount",
    "exchange_in_amount",
    "exchange_out_amount",
]

# First month (exclusive) of the history, tags of the two flow
# sources, and the only business line taken from the second one.
MONTH_NUMBER_START = 201700
SOURCE_A_TAG = "inst"
SOURCE_B_TAG = "iriis"
SOURCE_B_LINE = "IR"

# Firms and the name fragments that identify them.
FIRM_PATTERNS = {
    "edward_jones": ["Edward Jones"],
    "lpl": ["LPL"],
    "raymond_james": ["Raymond James"],
    "advisor_group": [
        "FSC Securities Corporation",
        "Royal Alliance Associates",
        "SagePoint Financial",
        "Woodbury Financial Services",
    ],
    "merrill": ["Merrill Lynch"],
    "morgan_stanley": ["Morgan Stanley"],
    "ubs": ["UBS Financial", "UBS Securities"],
    "wells_fargo": ["Wells Fargo"],
}

# Funds with their ticker prefix, and ticker suffix to share class.
FUND_PREFIXES = {"GFA": "RGA", "EUPAC": "RER", "WMIF": "RWM", "FI": "RFN", "ICA": "RIC"}
SHARE_CLASS_SUFFIXES = {
    "AX": "R-1",
    "BX": "R-2",
    "CX": "R-3",
    "EX": "R-4",
    "FX": "R-5",
    "GX": "R-6",
}

# Monthly indicator series, the spine first, and their date format.
MACRO_SERIES = [
    "consumersentimentindex",
    "gdp",
    "goldprice",
    "house_pricing_index",
    "market_volatility_vix",
    "oilprice",
    "tdsp_fodsp",
    "ted_spread",
    "treasury_yield",
]
MACRO_DATE = "AsOfDate"
MACRO_DATE_FORMAT = "MM-dd-yyyy"
MACRO_DROPPED = ["GoldPrice", "VIX_Open", "VIX_High", "VIX_Low"]

# Keys of a gap-filling group and of a trailing-mean group.
FILL_KEYS = [
    "parent_fund_acronym_group",
    "retirement_plan_id",
    "organization_name_standard",
    "business_line_1",
    "parent_share_class_name",
    "morningstar_category_grouped",
    "data_source",
    "investment_vehicle_id",
]
TRAILING_KEYS = [
    "parent_fund_acronym_group",
    "retirement_plan_id",
    "organization_name_standard",
    "business_line_1",
    "parent_share_class_name",
]

# Window sizes in months and the anomaly labels that go with them.
WINDOW_SIZES = [3, 6, 12]
ANOMALY_LEVELS = {3: "Strong Anomaly", 6: "Medium Anomaly", 12: "Weak Anomaly"}
ANOMALY_NONE = "Normal"

# Advisor facts start at this month; business-line names; join keys.
ADVISOR_MONTH_START = 201612
LINE_1_ALL = "IR"
LINE_2_DCIO = "DCIO"
LINE_2_SMALL = "Small RP Solutions"
LINE_3_PROPRIETARY = ["RKD", "PlanPremier"]
BUSINESS_LINE_KEYS = [
    "INV_VEH_ID",
    "RK_SOLTN_CD",
    "FUND_SHARE_CLASS_ID",
    "INVSR_ACCT_TYP_CD",
]

# Fund buckets of the advisor pivot in output order. The first is
# recognised by the prefixes below, the others by their exact code.
TARGET_DATE_BUCKET = "TD"
TARGET_DATE_PREFIXES = ["AFTD", "TCGTD"]
FUND_BUCKETS = [
    "TD", "EUPAC", "AMBAL", "GFA", "NPF", "WMIF", "BFA", "FI", "NWF", "WGI", "AMCAP",
    "AMF", "GVT", "SCWF", "ICA", "IFA", "CIB", "IBFA", "AHIT", "NEF", "SBF", "IGI",
    "PSG", "WBF", "PSGI", "STBF", "ILBF", "PSMGI", "GBAL", "AFMF", "MMF",
]
