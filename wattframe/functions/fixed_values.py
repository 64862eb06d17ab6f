"""Code lists and label tables that published data uses.

All entries below are fixed values. They must read exactly so for results to be right.
"""

# Natural-gas trade processes.
GAS_TRADE_PROCESSES = {
    "EEI": "Exports (Intl)",
    "IMI": "Imports (Intl)",
    "IMB": "Net Intl Movements",
    "MID": "Interstate Deliveries",
    "MIN": "Net Interstate Receipts",
    "MIE": "Net Intl + Interstate",
}

# Petroleum movement processes.
PETROLEUM_MOVEMENTS = {
    "EEX": "Exports",
    "EIM": "Imports",
    "ENT": "Net Imports",
    "STK": "Stock Change",
    "VUA": "Supply Adjustment",
    "YPA": "Net Production",
}

# Electricity fuel types; ALL is the published aggregate member.
ELECTRICITY_FUELS = {
    "COL": "Coal",
    "NG": "Natural Gas",
    "NUC": "Nuclear",
    "HYC": "Conventional Hydroelectric",
    "WND": "Wind",
    "SUN": "Solar",
    "GEO": "Geothermal",
    "ALL": "All Fuels",
    "AOR": "All Renewables",
}

# State-energy prefixes as column labels of the fuel pivot.
FUEL_COLUMN_LABELS = {
    "AB": "Aviation Gasoline Blending Components",
    "AR": "Asphalt & Road Oil",
    "AV": "Aviation Gasoline",
    "CL": "Coal (All Sectors)",
    "CO": "Coal",
    "DF": "Distillate Fuel Oil",
    "EL": "Electricity (Retail Sales)",
    "EM": "Emissions (CO2)",
    "EN": "Energy Intensity",
    "ES": "Electricity (All Sectors)",
    "EX": "Expenditures",
    "FF": "Fossil Fuels (Total)",
    "GE": "Geothermal Energy",
    "HY": "Hydroelectric Power",
    "JF": "Jet Fuel",
    "KS": "Kerosene",
    "LG": "LPG (Liquefied Petroleum Gas)",
    "LU": "Lubricants",
    "MG": "Motor Gasoline",
    "NF": "Non-Fossil Fuels",
    "NG": "Natural Gas",
    "NU": "Nuclear Energy",
    "PA": "Petroleum (All Products)",
    "PC": "Petroleum Coke",
    "PQ": "Petroleum & Natural Gas (Combined)",
    "PR": "Prices",
    "RE": "Renewables (Total)",
    "RF": "Residual Fuel Oil",
    "SO": "Solar Energy",
    "TE": "Total Energy (All Sources)",
    "WD": "Wood & Wood Waste",
    "WS": "Waste Energy",
    "WY": "Wind Energy",
}

# What the last word of a column name says about the code before it.
COLUMN_UNITS = {
    "pct": "% of Total",
    "btu": "Billion BTU",
    "mbtu": "Million BTU",
}

# Numeric columns that are part of a key or count something else: never a metric by themselves.
NO_METRICS = ("year", "month", "week", "state", "state_abbrev", "num_series")

# Region codes.
REGIONS = {
    "NUS": "U.S. Total",
    "NUS-Z00": "U.S. Total",
    "R10": "PADD 1 (East Coast)",
    "R1X": "PADD 1A (New England)",
    "R1Y": "PADD 1B (Central Atlantic)",
    "R1Z": "PADD 1C (Lower Atlantic)",
    "R20": "PADD 2 (Midwest)",
    "R30": "PADD 3 (Gulf Coast)",
    "R40": "PADD 4 (Rocky Mountain)",
    "R50": "PADD 5 (West Coast)",
}

# Two-letter postal codes, 50 states and the federal district.
STATES = {
    "AK": "Alaska",
    "AL": "Alabama",
    "AR": "Arkansas",
    "AZ": "Arizona",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DC": "District of Columbia",
    "DE": "Delaware",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "IA": "Iowa",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "MA": "Massachusetts",
    "MD": "Maryland",
    "ME": "Maine",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MO": "Missouri",
    "MS": "Mississippi",
    "MT": "Montana",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "NE": "Nebraska",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NV": "Nevada",
    "NY": "New York",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VA": "Virginia",
    "VT": "Vermont",
    "WA": "Washington",
    "WI": "Wisconsin",
    "WV": "West Virginia",
    "WY": "Wyoming",
}

# Codes with a special meaning.
US_PUBLISHED_AREA = "NUS-Z00"  # the published national row of petroleum movements
ALL_FUELS = "ALL"  # aggregate member of electricity fuels
ALL_COUNTRIES = "TOT"  # aggregate member of coal countries
NATION_STATE_ID = "US"  # aggregate member of state ids
TOTAL_ENERGY_PREFIX = "TE"  # state-energy prefix of the all-source total
BTU_UNIT = "B"  # state-energy series measured in Btu
MARKETED_PRODUCTION = "VGM"  # natural-gas process kept by the production table
IMPORT_DESTINATION = "Refinery State"  # one of the levels at which crude imports repeat
IMPORT_ORIGIN = "CTY"
INTERNATIONAL_PROCESSES = {"EEI": "exports_mmcf", "IMI": "imports_mmcf", "IMB": "net_intl_mmcf"}
INTERSTATE_PROCESSES = {"MID": "interstate_delivered_mmcf", "MIN": "net_interstate_received_mmcf"}
MOVEMENT_COLUMNS = {"EEX": "exports_kbd", "EIM": "imports_kbd", "ENT": "net_imports_kbd"}
RANKING_COLUMNS = (
    "average-retail-price-rank",
    "carbon-dioxide-rank",
    "net-generation-rank",
    "nitrogen-oxide-rank",
    "sulfer-dioxide-rank",
)
MORE_RANKING_COLUMNS = ("direct-use-rank", "fsp-sales-rank", "generation-elect-utils-rank")
STATE_AREA_PATTERN = "^S[A-Z]{2}"
STATE_ID_PATTERN = "^[A-Z]{2}$"
