"""Fixed values that turn the sample tables into fund-flow inputs.

The adapters (Spark) and the comparison SQL (DuckDB) both read them.
"""

# The sample history is moved by whole years, so that the default
# month filters cut off its beginning.
YEAR_SHIFT = 20

# Part types as funds (the last one is not a target fund), market
# segments as business lines.
FUND_OF_TYPE = {
    "ECONOMY": "GFA",
    "LARGE": "EUPAC",
    "MEDIUM": "WMIF",
    "PROMO": "FI",
    "SMALL": "ICA",
    "STANDARD": "AMCAP",
}
PREFIX_OF_TYPE = {
    "ECONOMY": "RGA",
    "LARGE": "RER",
    "MEDIUM": "RWM",
    "PROMO": "RFN",
    "SMALL": "RIC",
    "STANDARD": "RAF",
}
CATEGORY_OF_TYPE = {
    "ECONOMY": "growth",
    "LARGE": "foreign",
    "MEDIUM": "blend",
    "PROMO": "blend",
    "SMALL": "growth",
    "STANDARD": "growth",
}
LINE_OF_SEGMENT = {
    "BUILDING": "IR",
    "MACHINERY": "DCIO",
    "HOUSEHOLD": "Small RP Solutions",
    "FURNITURE": "IR",
    "AUTOMOBILE": "Other",
}

# Organisation names by nation key. Some hold no firm, some two
# fragments of one firm, some fragments of two firms.
ORGANIZATIONS = [
    "Edward Jones", "EDWARD JONES TRUST", "LPL Financial", "Lpl Advisors", "Raymond James",
    "raymond james bank", "FSC Securities Corporation", "Royal Alliance Associates",
    "SagePoint Financial", "Woodbury Financial Services", "Merrill Lynch", "merrill lynch life",
    "Morgan Stanley", "UBS Financial", "UBS Securities", "UBS Financial and UBS Securities",
    "Wells Fargo", "Wells Fargo via LPL", "Morgan Stanley / Merrill Lynch desk", "UBS Bank",
    "Independent 1", "Independent 2", "Edward Jonas", "WellsFargo", "Raymond James via LPL",
]

# Fund codes by brand number, 1 first. The last two are in no bucket.
BRAND_CODES = [
    "AFTD25", "TCGTD30", "EUPAC", "AMBAL", "GFA", "NPF", "WMIF", "BFA", "FI", "NWF", "WGI",
    "AMCAP", "AMF", "GVT", "SCWF", "ICA", "IFA", "CIB", "IBFA", "AHIT", "NEF", "SBF", "MMF",
    "UNLISTED", "ABSENT",
]

# Business line 2 and 3 by dimension row number.
LINE_2_CYCLE = ["DCIO", "Small RP Solutions", "Retail", None, "DCIO"]
LINE_3_CYCLE = ["RKD", "PlanPremier", "Other"]
