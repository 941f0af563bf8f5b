"""Fixed values that results depend on. Stated as data, no logic."""

# --- fixed values: bucket edges and labels (left-closed) ---
SIZE_EDGES = (50_000.0, 100_000.0, 200_000.0)
SIZE_LABELS = ("Small", "Medium", "Large", "XLarge")
AMOUNT_EDGES = (50_000_000.0, 100_000_000.0, 200_000_000.0)
AMOUNT_LABELS = ("Medium", "Large", "XLarge", "XXLarge")
SEVERITY_EDGES = (7, 30, 60, 120, 180)
SEVERITY_LABELS = ("minimal", "small", "moderate", "major", "large", "severe")
PROGRESS_EDGES = (0.2, 0.4, 0.6, 0.8)
PROGRESS_LABELS = ("0-20", "20-40", "40-60", "60-80", "80-100")
POSITION5_EDGES = (0.2, 0.4, 0.6, 0.8)
POSITION5_LABELS = ("early", "early_mid", "mid", "mid_late", "late")
POSITION4_EDGES = (0.25, 0.5, 0.75)
POSITION4_LABELS = ("early", "early_mid", "mid_late", "late")
POSITION3_EDGES = (0.33, 0.67)
POSITION3_LABELS = ("early", "mid", "late")
COMPLETION_EDGES = (10.0, 50.0, 95.0)
COMPLETION_LABELS = ("not_started", "in_progress", "mostly_done", "completed")
SPI_EDGES = (0.85, 0.92, 1.0, 1.08)

# --- fixed values: vocabularies ---
TRADES = (
    "A SUBSTRUCTURE",
    "B SHELL",
    "C INTERIORS",
    "D SERVICES",
    "E EQUIPMENT AND FURNISHINGS",
    "F SPECIAL CONSTRUCTION AND DEMOLITION",
    "G SITEWORK",
    "Z GENERAL",
)
MANDATORY_DIVISIONS = ("01", "98", "99")
CLOSED_STATUSES = ("closed", "closed_draft", "closed_with_revision")
TIMING_LABELS = ("Pre-SOW", "During", "Post-SOW")
BUSINESS_UNITS = (
    "commercial", "healthcare", "education", "mission critical", "life sciences", "aviation", "federal",
)
CODE_PATTERN = "^[A-Z][0-9]"
CODE_FORBIDDEN = "[?!@#$%]"
CODE_MAX_LENGTH = 60

# --- fixed values: yearly construction cost index; 2026-2030 grow 4 % a year from 2025 ---
COST_INDEX_BASE_YEAR = 2024
COST_INDEX = {
    2012: 830.0, 2013: 864.0, 2014: 902.0, 2015: 943.0, 2016: 989.0, 2017: 1038.0, 2018: 1096.0,
    2019: 1156.0, 2020: 1177.0, 2021: 1199.0, 2022: 1295.0, 2023: 1373.0, 2024: 1426.0, 2025: 1476.0,
    **{2025 + k: 1476.0 * 1.04**k for k in range(1, 6)},
}

# --- fixed values: delay category shares and fall-back midpoints (days) ---
DELAY_SHARES = {
    "minimal": 0.093, "small": 0.313, "moderate": 0.232, "major": 0.179, "large": 0.081, "severe": 0.102,
}
DELAY_MIDPOINTS = {"minimal": 4, "small": 17, "moderate": 41, "major": 81, "large": 149, "severe": 275}
TIMING_DEFAULTS = {1: 0.49, 2: 0.68, 3: 0.74, 4: 0.70, 5: 0.70}
MEDIAN_DELAY_DAYS = 41.0

# --- fixed values: event rules ---
DUE_DAY_OPTIONS = (5, 7, 7, 7, 10, 14, 21)
DEFAULT_STATUS_SHARES = {"closed": 0.92, "open": 0.06, "draft": 0.02}
DEFAULT_ZONE_SHARES = {"pre_sow": 0.20, "during_sow": 0.70, "post_sow": 0.10}
DEFAULT_COUNT_BOUNDS = {"p25": 50.0, "median": 200.0, "p75": 500.0, "p90": 1000.0}
DEFAULT_RESOLUTION_BOUNDS = {"p25": 4.0, "median": 10.0, "p75": 21.0, "p90": 49.0}
DEFAULT_SPIKE_BOUNDS = {"p25": 0.79, "median": 1.08, "p75": 1.58}
DEFAULT_FLAG_RATE = 0.35
TRADE_TO_SOW = {
    "A SUBSTRUCTURE": ("(13) Below Grade Structure", "(13) Foundations"),
    "B SHELL": ("(14) Superstructure", "(17) Facade", "(18) Roofing"),
    "C INTERIORS": ("(25) Interior Rough", "(26) Interior Finishes", "(27) Worklist"),
    "D SERVICES": ("(29) Fire Life Safety", "(30) Systems Start-up", "(08) Permanent Power"),
    "E EQUIPMENT AND FURNISHINGS": ("(24) Remaining Elevator", "(21) Hoist"),
    "F SPECIAL CONSTRUCTION AND DEMOLITION": ("(12) Initial Site Work", "(12C) Demo & Abatement"),
    "G SITEWORK": ("(28) Final Site Work", "(12) Initial Site Work"),
    "Z GENERAL": ("(10) All Submittals", "(33) NO CODE", "(09) Buys"),
}
PHASE_PREFIXES = {
    "early": (
        "(01)", "(03)", "(04)", "(05)", "(06)", "(07)", "(08)", "(09)", "(10)", "(10B)",
        "(11)", "(12)", "(12B)", "(13)",
    ),
    "mid": (
        "(14)", "(14C)", "(15)", "(16)", "(17)", "(18)", "(18B)", "(19)", "(20)", "(21)",
        "(22)", "(23)", "(24)", "(25)",
    ),
    "late": ("(26)", "(27)", "(28)", "(29)", "(30)", "(31)", "(32)", "(33)", "(9BX)"),
}

# --- fixed values: work-package minimum days, anchored positions, overrun (probability, median, p75, p90) ---
MIN_DURATION_DEFAULT = 7
MIN_DURATIONS = {
    "(13) Below Grade Structure + Foundations": 30,
    "(14) Superstructure (Concrete Structure)": 21,
    "(14A) Steel Erection": 21,
    "(14B) Deck & Detail Steel": 14,
    "(14C) Concrete on Metal Decks": 14,
    "(14D) Spray Fireproofing": 14,
    "(14E) Structural Wood Framing": 14,
    "(17) Facade (Weathertight)": 21,
    "(17B) Facade - Complete": 21,
    "(18) Roofing (Weathertight)": 14,
    "(18B) Roofing (After Weathertight)": 14,
    "(25) Interior Rough": 30,
    "(26) Interior Finishes": 30,
    "(29) Fire Life Safety": 14,
    "(30) Systems Start-up & Testing": 14,
    "(08) Permanent Power Distributed": 14,
    "(07) Permanent Power to Site": 14,
    "(12) Initial Site Work": 14,
    "(12A) Enabling": 14,
    "(12B) Initial Site Work Remaining": 14,
    "(12C) Demo & Abatement": 14,
    "(28) Final Site Work": 14,
    "(19) Hoist 1-  Install & Usage Duration": 14,
    "(21) Hoist 1 - Infill Duration": 14,
    "(22) Hoist 2 - Infill Duration": 14,
    "(15) Tower Crane 1 - Usage Duration": 14,
    "(16) Tower Crane 2 - Usage Duration": 14,
    "(31) Final Inspections & Close-out": 7,
    "(27) Worklist & Punch list": 7,
    "(01) Notice to Proceed (Start Construction)": 7,
}
ANCHOR_POSITIONS = {
    "(01) Notice to Proceed (Start Construction)": -100.0,
    "(00) GMP Execution Date": -50.0,
    "(02) Substantial Completion (TCO or 1st Turnover Milestone)": 999.0,
}
OVERRUNS = {
    "(31) Final Inspections & Close-out": (0.5714, 62.0, 169.0, 443.0),
    "(33) NO CODE (All remaining activities)": (0.5619, 77.0, 184.0, 471.0),
    "(27) Worklist & Punch list": (0.5083, 66.0, 168.0, 316.0),
    "(26) Interior Finishes": (0.3333, 90.0, 244.0, 567.0),
    "(30) Systems Start-up & Testing": (0.3301, 79.0, 234.0, 462.0),
    "(28) Final Site Work": (0.2695, 118.0, 269.0, 751.0),
    "(22) Hoist 2 - Infill Duration": (0.2667, 78.0, 273.0, 442.0),
    "(32) Weather Contingency": (0.2602, 43.0, 257.0, 556.0),
    "(29) Fire Life Safety": (0.2414, 151.0, 304.0, 795.0),
    "(11) All Mat/Equip Deliveries": (0.2149, 136.0, 305.0, 718.0),
    "(21) Hoist 1 - Infill Duration": (0.1954, 271.0, 437.0, 700.0),
    "(25) Interior Rough": (0.1814, 174.0, 408.0, 831.0),
    "(17B) Facade - Complete": (0.1400, 62.0, 421.0, 819.0),
    "(24) Remaining Elevator Install Duration": (0.1319, 82.0, 270.0, 868.0),
}
DRIFT_CAP_DEFAULT_DAYS = 180.0

# --- fixed values: place of a work package in the order where nothing is known of it, by what its label holds ---
LABEL_POSITIONS = (
    (("Foundation", "Below Grade"), 6),
    (("Finishes", "Punch", "Close"), 18),
    (("Precon", "Buys", "Submittals"), 3),
)
LABEL_POSITION_DEFAULT = 10

# --- fixed values: spend windows by division and shifts by category (shares of the lifecycle) ---
DIVISION_WINDOWS = {
    "01": (0.0, 1.0), "02": (0.0, 0.3), "03": (0.0, 0.5), "04": (0.0, 0.5), "05": (0.1, 0.5),
    "06": (0.3, 0.8), "07": (0.2, 0.6), "08": (0.2, 0.6), "09": (0.4, 1.0), "10": (0.5, 1.0),
    "11": (0.3, 0.8), "12": (0.5, 1.0), "13": (0.0, 0.4), "14": (0.3, 0.8), "21": (0.2, 0.8),
    "22": (0.2, 0.8), "23": (0.2, 0.8), "26": (0.2, 0.8), "27": (0.3, 0.9), "28": (0.3, 0.9),
    "31": (0.0, 0.3), "32": (0.0, 0.3), "33": (0.0, 0.4), "95": (0.0, 1.0), "98": (0.0, 1.0),
    "99": (0.0, 1.0),
}
CATEGORY_SHIFTS = {
    "materials": -0.16, "labor": -0.12, "lit": -0.09, "glpd": -0.01, "subcontractor": 0.0, "other": 0.0,
    "ccip": 0.08, "subguard": 0.10, "contingency": 0.05, "fee": 0.0, "allowance": 0.41,
}

# --- fixed values: root-entity ratio rules ---
RATIO_TARGET = 0.985
RATIO_PULL = 0.25
RATIO_SIGMA = 0.010
RATIO_BAND = (0.93, 1.02)
OPEN_END = "2099-12-31"
