"""Published thresholds, labels, value lists and lookup tables.

Every function that uses one of these takes it as a default argument, so a
caller can pass another list without touching the library.
"""

# Ladders. Each step is (operator, limit, label); the first step
# that holds wins and a NULL input falls through to the final label.
WEATHER_DESCRIPTION = [
    ("==", 0, "Clear Sky"),
    ("<=", 3, "Partly Cloudy"),
    ("<=", 48, "Foggy"),
    ("<=", 67, "Rainy"),
    ("<=", 77, "Snowy"),
    ("<=", 82, "Rain Showers"),
    ("<=", 99, "Thunderstorm"),
]
WEATHER_DESCRIPTION_ELSE = "Unknown"

OPS_RISK_LABEL = [("==", 0, "Normal Operations"), ("==", 1, "Monitor"), ("==", 2, "Elevated Risk")]
OPS_RISK_LABEL_ELSE = "High Alert"

LOAD_TIER = [(">=", 6500, "Critical Peak"), (">=", 5500, "High Load"), (">=", 4500, "Moderate Load")]
LOAD_TIER_ELSE = "Normal Load"

GENERATOR_SIZE_TIER = [
    (">=", 500, "Utility Scale (500+ MW)"),
    (">=", 100, "Large (100-499 MW)"),
    (">=", 10, "Medium (10-99 MW)"),
]
GENERATOR_SIZE_TIER_ELSE = "Small (< 10 MW)"

CRITICALITY_TIER = [(">=", 0.5, "Critical"), (">=", 0.2, "Important"), (">=", 0.05, "Standard")]
CRITICALITY_TIER_ELSE = "Peripheral"

VOLTAGE_CLASS = [(">=", 345, "Extra High Voltage"), (">=", 230, "High Voltage"), (">=", 115, "Medium Voltage")]
VOLTAGE_CLASS_ELSE = "Low Voltage"

LINE_CAPACITY_TIER = [(">=", 1000, "High Capacity"), (">=", 500, "Medium Capacity")]
LINE_CAPACITY_TIER_ELSE = "Low Capacity"

LINE_DISTANCE_BUCKET = [("<=", 10, "Local"), ("<=", 40, "Regional")]
LINE_DISTANCE_BUCKET_ELSE = "Interstate"

SPEND_TIER = [("<", 5000, "Low"), ("<", 15000, "Medium"), ("<", 30000, "High")]
SPEND_TIER_ELSE = "Very High"

DURATION_BUCKET = [
    ("<", 1, "Under 1 Hour"),
    ("<", 4, "1-4 Hours"),
    ("<", 8, "4-8 Hours"),
    ("<", 16, "8-16 Hours"),
]
DURATION_BUCKET_ELSE = "Over 16 Hours"

CUSTOMER_IMPACT_TIER = [("<", 500, "Low"), ("<", 2000, "Medium"), ("<", 5000, "High")]
CUSTOMER_IMPACT_TIER_ELSE = "Critical"

CLOSURE_SPEED = [("<=", 5, "Fast"), ("<=", 14, "Normal"), ("<=", 30, "Slow")]
CLOSURE_SPEED_ELSE = "Overdue"

COST_TIER = [("<", 400, "Low Cost"), ("<", 700, "Medium Cost"), ("<", 1000, "High Cost")]
COST_TIER_ELSE = "Premium Cost"

SHIFT_LENGTH_BUCKET = [(">=", 12, "Extended Shift"), (">=", 8, "Full Shift")]
SHIFT_LENGTH_BUCKET_ELSE = "Partial Shift"

GRID_DEPENDENCY_LABEL = [
    (">=", 25, "Critical Dependency"),
    (">=", 10, "Significant Dependency"),
    (">=", 5, "Moderate Dependency"),
]
GRID_DEPENDENCY_LABEL_ELSE = "Low Dependency"

PRICE_TIER = [(">=", 15, "Premium Rate"), (">=", 12, "Standard Rate"), (">=", 9, "Discounted Rate")]
PRICE_TIER_ELSE = "Industrial Rate"

CITY_RISK_LABEL = [(">=", 1.5, "High Risk"), (">=", 1.0, "Elevated Risk"), (">=", 0.5, "Moderate Risk")]
CITY_RISK_LABEL_ELSE = "Low Risk"

# Paired ladder (customers below, hours below, score); otherwise 5.
OUTAGE_SEVERITY = [(500, 2, 1), (2000, 4, 2), (5000, 8, 3), (8000, 16, 4)]
OUTAGE_SEVERITY_ELSE = 5

# Severity allowed to stay open for this many days before it is overdue.
OVERDUE_DAYS = {"Critical": 14, "High": 30}

# Seasons by month number.
SEASONS = [("Winter", [12, 1, 2]), ("Spring", [3, 4, 5]), ("Summer", [6, 7, 8]), ("Fall", [9, 10, 11])]

MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Weather flag limits (strict comparisons).
FREEZE_BELOW_F = 32
HEAT_ABOVE_F = 95
WIND_ABOVE_MPH = 45
PRECIP_ABOVE = 0.5
DEGREE_DAY_BASE_F = 65

# Energy source codes.
FUEL_BY_CODE = {
    "COL": "Coal",
    "NG": "Natural Gas",
    "NUC": "Nuclear",
    "WAT": "Hydro",
    "WND": "Wind",
    "SUN": "Solar PV",
    "GEO": "Geothermal",
    "PET": "Petroleum",
    "OTH": "Other",
    "DFO": "Diesel",
    "BIT": "Bituminous Coal",
    "SUB": "Subbituminous Coal",
    "MWH": "Battery Storage",
    "OG": "Other Gas",
}
CLEAN_FUELS = ["Wind", "Solar PV", "Hydro", "Battery Storage", "Geothermal"]
DISPATCHABLE_FUELS = ["Natural Gas", "Coal", "Petroleum", "Diesel", "Battery Storage"]
FUEL_CATEGORIES = [
    ("Renewables", ["Wind", "Solar PV", "Hydro", "Geothermal"]),
    ("Storage", ["Battery Storage"]),
    ("Gas", ["Natural Gas", "Other Gas"]),
    ("Coal", ["Coal", "Subbituminous Coal", "Bituminous Coal"]),
    ("Oil", ["Petroleum", "Diesel"]),
]
FUEL_CATEGORY_ELSE = "Other"

# Retail sectors and metrics.
SECTOR_DISPLAY = {
    "RES": "Residential 🏠",
    "COM": "Commercial 🏢",
    "IND": "Industrial 🏭",
    "TRA": "Transportation 🚗",
    "OTH": "Other",
}
SALES_METRICS = ["sales", "revenue", "customers", "price"]
ALL_SECTORS = "ALL"

# Demand scoring.
DEMAND_REFERENCE_MW = 10642
HEAT_WAVE_F = 85
COLD_SNAP_F = 20
STRESSED_PEAK_MWH = 5500

# Field work.
WEATHER_CAUSES = [
    "Wind Damage", "Tree Contact", "Downed Line", "Ice on Lines",
    "Frozen Equipment", "Lightning Strike", "Flooding", "Pipe Burst",
]
EMERGENCY_WORDS = ["emergency", "storm", "restoration"]
PLANNED_WORDS = ["planned"]
INCIDENT_TYPES = ["Incident", "Near Miss"]
SEVERITY_SCORE = {"Low": 1, "Medium": 2, "High": 3, "Critical": 4}
INFRASTRUCTURE_ASSETS = ["Transformer", "Substation", "Underground Cable"]
HIGH_SPEND_ABOVE_USD = 20000

# Expectations by weather risk score 0..4 and by city.
EXPECTED_OUTAGES = {0: 1.5, 1: 3.0, 2: 6.0, 3: 10.0, 4: 15.0}
EXTRA_CREWS = {0: 0, 1: 1, 2: 3, 3: 5, 4: 8}
EXPECTED_OBSERVATIONS = {0: 1, 1: 2, 2: 4, 3: 6, 4: 9}
BASE_CREWS = {"Denver": 8, "Colorado_Springs": 5, "Boulder": 3, "Fort_Collins": 3, "Pueblo": 2}

# Spend multipliers.
ASSET_MULTIPLIER = {
    "Transformer": 1.8,
    "Power Line": 1.5,
    "Substation": 2.0,
    "Smart Meter": 0.6,
    "Distribution Panel": 1.2,
    "Underground Cable": 1.7,
}
CATEGORY_MULTIPLIER = {"Labor": 1.0, "Materials": 0.8, "Contractor": 1.3, "Equipment Rental": 0.6}
RISK_COST_STEP = 0.25
OVERTIME_FACTOR = 1.5

# Order in which weather flags decide the regime of a day.
OUTAGE_REGIME_ORDER = ["wind", "freeze", "precip", "heat"]
SAFETY_REGIME_ORDER = ["wind", "freeze", "heat", "precip"]

# Cross-domain scoring.
STRESS_RISK_WEIGHT = 1.5
HIGH_STRESS_DAY = 2
DASHBOARD_HIGH_STRESS = 7
MAJOR_HUB_DEGREE = 0.3
IMPORTANCE_WEIGHT = 50
