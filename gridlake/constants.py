"""Fixed values.

Names, codes and lists below have to be exactly these, since tables, file layouts and results are
keyed by them.  They are data, not logic.
"""

# Production types as they appear in the generation feed.
FUEL_TYPES = [
    "Biomass",
    "Fossil Brown coal/Lignite",
    "Fossil Coal-derived gas",
    "Fossil Gas",
    "Fossil Hard coal",
    "Fossil Oil",
    "Fossil Oil shale",
    "Fossil Peat",
    "Geothermal",
    "Hydro Pumped Storage",
    "Hydro Run-of-river and poundage",
    "Hydro Water Reservoir",
    "Marine",
    "Nuclear",
    "Other",
    "Other renewable",
    "Solar",
    "Waste",
    "Wind Offshore",
    "Wind Onshore",
]

# Which production types count as renewable and which as fossil.
RENEWABLE_FUELS = [
    "Biomass",
    "Geothermal",
    "Hydro Pumped Storage",
    "Hydro Run-of-river and poundage",
    "Hydro Water Reservoir",
    "Marine",
    "Solar",
    "Wind Offshore",
    "Wind Onshore",
]
FOSSIL_FUELS = [
    "Fossil Brown coal/Lignite",
    "Fossil Coal-derived gas",
    "Fossil Gas",
    "Fossil Hard coal",
    "Fossil Oil",
    "Fossil Oil shale",
    "Fossil Peat",
]

# Name parts that mark weather-driven feed-in.
WIND_MARK = "wind"
SOLAR_MARK = "solar"

# Direction label of produced (not consumed) energy in the generation feed.
GENERATION_DIRECTION = "Actual Aggregated"

# Commodity and currency series, with the symbol each is quoted under.
TICKERS = {
    "EURPLN": "EURPLN=X",
    "USDPLN": "USDPLN=X",
    "TTF_GAS": "TTF=F",
    "BRENT": "BZ=F",
    "NAT_GAS_HH": "NG=F",
}

# Bidding zones (code, country, region, timezone, primary fuel, zone name).
ZONE_COLUMNS = ["zone_code", "country", "region", "timezone", "primary_fuel", "zone_name"]
ZONES = [
    ("PL", "Poland", "Eastern", "Europe/Warsaw", "coal", "Poland"),
    ("CZ", "Czech Republic", "Eastern", "Europe/Prague", "nuclear_lignite", "Czech Republic"),
    ("HU", "Hungary", "Eastern", "Europe/Budapest", "nuclear_solar", "Hungary"),
    ("RO", "Romania", "Eastern", "Europe/Bucharest", "diversified", "Romania"),
    ("ES", "Spain", "Southern", "Europe/Madrid", "renewables", "Spain"),
    ("PT", "Portugal", "Southern", "Europe/Lisbon", "renewables", "Portugal"),
    ("GR", "Greece", "Southern", "Europe/Athens", "gas_solar", "Greece"),
    ("IT_NORD", "Italy", "Southern", "Europe/Rome", "gas", "Italy - North"),
    ("IT_CNOR", "Italy", "Southern", "Europe/Rome", "gas", "Italy - Centre-North"),
    ("IT_CSUD", "Italy", "Southern", "Europe/Rome", "gas", "Italy - Centre-South"),
    ("IT_SUD", "Italy", "Southern", "Europe/Rome", "solar_wind", "Italy - South"),
    ("IT_CALA", "Italy", "Southern", "Europe/Rome", "solar_wind", "Italy - Calabria"),
    ("IT_SICI", "Italy", "Southern", "Europe/Rome", "solar_gas", "Italy - Sicily"),
    ("IT_SARD", "Italy", "Southern", "Europe/Rome", "solar_gas", "Italy - Sardinia"),
]
REGIONS = ["Eastern", "Southern"]

# The demand feed.
DEMAND_SOURCE = "PSE"
DEMAND_TOPIC = "pse.demand.v1"
INTERVAL_MINUTES = 15
INTERVALS_PER_DAY = 96
STREAM_BATCH_ROWS = 200

# Months of the solar-heavy half-year.
SOLAR_MONTHS = [3, 4, 5, 6, 7, 8]

# Length of the price mean, as hours and as rows.
PRICE_WINDOW_HOURS = 168
PRICE_WINDOW_ROWS = 168
# Return horizons of the commodity mart, in quotes.
RETURN_STEPS = [5, 20]
# Rows of the smoothed intraday demand.
DEMAND_WINDOW_ROWS = 4
