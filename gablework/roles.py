"""Column roles, rule sets, feature sets and other fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ColumnRoles:
    """Which column plays which part; the frame itself stays in one piece."""

    row_id: str = "listing_id"
    numeric: tuple[str, ...] = ("area", "bedrooms", "bathrooms", "age_years", "has_garage")
    categorical: tuple[str, ...] = ("district",)
    target: str = "price"
    prediction: str = "predicted"


ROLES = ColumnRoles()


@dataclass(frozen=True)
class Rule:
    """A bound on one column.  ``strict`` bounds exclude the limit itself."""

    column: str
    low: float | None = None
    high: float | None = None
    strict: bool = False
    allowed: tuple[int, ...] | None = None


# Cleaning limits of the batch flow.
RANGE_RULES = (
    Rule("area", 30, 500, strict=True),
    Rule("price", 50_000, 2_000_000, strict=True),
    Rule("age_years", None, 50, strict=True),
    Rule("bedrooms", 1),
    Rule("bathrooms", 1),
)

# The three-rule cleaning of the exploratory analysis.
THREE_RULES = (
    Rule("area", 30, None, strict=True),
    Rule("price", 50_000, None, strict=True),
    Rule("age_years", None, 50, strict=True),
)

# Bounds a single record must keep to be scored.
RECORD_RULES = (
    Rule("area", 0, None, strict=True),
    Rule("bedrooms", 1, 10),
    Rule("bathrooms", 1, 6),
    Rule("age_years", 0, 100),
    Rule("has_garage", 0, 1),
)

# Conformance rules of the data schema.
SCHEMA_RULES = (
    Rule("area", 30, 500),
    Rule("bedrooms", 1, 10),
    Rule("bathrooms", 1, 6),
    Rule("age_years", 0, 50),
    Rule("has_garage", allowed=(0, 1)),
    Rule("price", 50_000, 2_000_000),
)

# The two feature lists, in the order models expect.
FEATURES_9 = (
    "area",
    "bedrooms",
    "bathrooms",
    "age_years",
    "has_garage",
    "district_code",
    "area_per_room",
    "bathroom_ratio",
    "age_squared",
)
FEATURES_11 = FEATURES_9 + ("total_rooms", "is_new")

# Weights of the data-quality score.
QUALITY_WEIGHTS = {"completeness": 0.3, "validity": 0.4, "consistency": 0.15, "accuracy": 0.15}
QUALITY_THRESHOLD = 0.95

# Additive price rules (weight per column).
PRICE_WEIGHTS_V1 = {
    "area": 2000,
    "bedrooms": 50_000,
    "bathrooms": 30_000,
    "age_years": -5000,
    "has_garage": 25_000,
}
PRICE_WEIGHTS_V2 = {
    "area": 3000,
    "bedrooms": 15_000,
    "bathrooms": 10_000,
    "has_garage": 25_000,
    "age_years": -1000,
}
PRICE_FLOOR = 50_000
PRICE_CEILING = 2_000_000

# Price factor per district of the derived listings.
DISTRICT_FACTORS = {
    "AFRICA": 1.2,
    "AMERICA": 1.5,
    "ASIA": 0.9,
    "EUROPE": 1.0,
    "MIDDLE EAST": 0.8,
}

# Price bands [low, high) of the evaluation.
PRICE_BANDS = (
    ("0k-200k", 0, 200_000),
    ("200k-400k", 200_000, 400_000),
    ("400k-600k", 400_000, 600_000),
    ("600k+", 600_000, None),
)

# Age scenarios [low, high).
AGE_SCENARIOS = (("new", 0, 5), ("modern", 5, 20), ("old", 20, 100))

# Edge rows (name, area, bedrooms, bathrooms, age, garage).
EDGE_ROWS = (
    ("minimum_values", 30, 1, 1, 0, 0),
    ("maximum_values", 500, 5, 4, 50, 1),
    ("average_values", 120, 3, 2, 10, 1),
)
EDGE_ROWS_WIDE = (
    ("smallest home", 30, 1, 1, 0, 0),
    ("luxury home", 500, 5, 4, 0, 1),
    ("very old home", 100, 1, 1, 50, 0),
    ("more bathrooms than bedrooms", 50, 1, 2, 5, 1),
    ("few bathrooms for many bedrooms", 200, 4, 1, 10, 1),
)

# Grade limits of the overall score, best first.
GRADES = (("A+", 0.9), ("A", 0.8), ("B+", 0.7), ("B", 0.6), ("C", 0.5))
LOWEST_GRADE = "F"

# Quality gates and monitoring limits.
QUALITY_GATES = {"min_r2": 0.70, "max_rmse": 100_000.0, "max_mape": 15.0}
ROBUSTNESS_THRESHOLD = 0.7
NOISE_LEVELS = (0.01, 0.05, 0.1)
ALERT_LIMITS = {
    "response_time_ms": 1000.0,
    "error_rate": 0.05,
    "cpu_percent": 80.0,
    "memory_percent": 85.0,
    "disk_percent": 90.0,
}
REQUESTS_PER_MINUTE = 100
BATCH_SIZE_LIMIT = 100
CANARY_SUCCESS = 0.99
CANARY_ERROR = 0.01
AB_MIN_SAMPLES = 1000

# Environment presets.
PRESETS = {
    "development": {
        "n_samples": 500,
        "tuning": False,
        "max_trials": 10,
        "num_trees": 50,
        "folds": 3,
        "min_r2": 0.70,
        "max_rmse": 100_000.0,
    },
    "staging": {
        "n_samples": 1000,
        "tuning": True,
        "max_trials": 25,
        "num_trees": 100,
        "folds": 5,
        "min_r2": 0.70,
        "max_rmse": 100_000.0,
    },
    "production": {
        "n_samples": 2000,
        "tuning": True,
        "max_trials": 50,
        "num_trees": 200,
        "folds": 5,
        "min_r2": 0.75,
        "max_rmse": 80_000.0,
    },
}
