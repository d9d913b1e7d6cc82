"""Settings of a price-modelling run.

Every operator takes its columns as arguments; the dataclass below only gathers
the defaults that describe the auction-sales schema, so another table needs
another ``Settings`` and no code change.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: must stay as they are for results to be comparable ---------

TARGET = "Sales Price"
LOG_TARGET = "Log_Sales_Price"
SPLIT_RATIOS = (0.70, 0.15, 0.15)
SEED = 42

PRICE_BOUNDS = (6100.0, 107500.0)
PLACEHOLDER_YEAR = 1000
MIN_YEAR = 1950
RARE_BELOW = 10
FILL_TEXT = "Unknown"
RARE_TEXT = "Other"

TEXT_PATTERNS = {
    "Horsepower": r"(\d+\.?\d*)\s+to\s+\d+\.?\d*\s+Horsepower",
    "Weight_Tons": r"(\d+\.?\d*)\s+to\s+\d+\.?\d*\s+Metric Tons",
    "Digging_Depth_Ft": r"(\d+\.?\d*)\s+to\s+\d+\.?\d*\s+Ft Standard Digging Depth",
}

DROPPED = (
    "Unnamed: 0", "Sales ID", "Machine ID", "Model ID", "datasource", "Auctioneer ID",
    "Sales date", "Product Group Description",
    "Extra features", "Machine Width", "Clean Room", "Engine Horsepower", "Push Block",
    "Scarifier", "Tip Control",
    "Touchpad Type", "Turbo Charged", "Couple System", "Grouser Tracks", "Hydraulics Flow",
    "Backhoe Mounting", "Blade Type", "Travel Possibilities", "Differential Type",
    "Steering Controls",
)

GROUP_IMPUTED = ("MachineHours CurrentMeter", "Horsepower", "Weight_Tons", "Year Made")

TARGET_ENCODED = (
    "Model Description", "Base Model", "Secondary Description", "Product Class Description",
    "State of Usage", "Hydraulics", "Screen Size", "Screen Size.1", "Stick Length",
)

ONE_HOT = (
    "Usage Band", "Machine Size", "Product Group", "Driver System", "Enclosure", "Control",
    "Control Type", "Version", "Transmission", "Ripper", "Coupler", "Thumb",
    "Pattern Changer", "Grouser Type",
)

# Columns read as text whatever they hold.
FORCED_TEXT = ("Model Series", "Couple System", "Grouser Tracks", "Hydraulics Flow")

# Strings that mean "missing" in a sales CSV.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

PRICE_SEGMENTS = ("Very Low", "Low", "Medium", "High", "Very High")
PRICE_BINS = 80
RESIDUAL_BINS = 70
KDE_POINTS = 500
YEARLY_SALES = 10_000
MODEL_METRIC = "R2"

RIDGE_PARAMS = {"alpha": 1.0}

# Published boosting settings. The two leaf penalties have no counterpart in
# MLlib; see ``operators.train.boosting_arguments``.
BOOSTING_PARAMS = {
    "n_estimators": 20000, "learning_rate": 0.0927, "num_leaves": 137, "max_depth": 15,
    "min_child_samples": 20, "subsample": 0.779, "colsample_bytree": 0.943,
    "reg_alpha": 0.482, "reg_lambda": 2.29e-06,
}
PATIENCE = 150

# name -> (low, high, kind); "log" draws uniformly on the log scale.
SEARCH_SPACE = {
    "learning_rate": (0.005, 0.1, "log"),
    "num_leaves": (20, 300, "int"),
    "max_depth": (5, 15, "int"),
    "min_child_samples": (10, 100, "int"),
    "subsample": (0.5, 1.0, "float"),
    "colsample_bytree": (0.5, 1.0, "float"),
    "reg_alpha": (1e-8, 10.0, "log"),
    "reg_lambda": (1e-8, 10.0, "log"),
}
SEARCH_TREES = 2000
SEARCH_PATIENCE = 50
SEARCH_TRIALS = 50

# --- End of fixed values -------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Column roles and thresholds of one modelling run."""

    target: str = TARGET
    log_target: str = LOG_TARGET
    group: str = "Product Group"
    year: str = "Year Made"
    hours: str = "MachineHours CurrentMeter"
    class_text: str = "Product Class Description"
    sale_date: str = "Sales date"
    date_formats: tuple[str, ...] = (
        "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy H:mm", "M/d/yyyy",
        "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX",
        "yyyy-MM-dd HH:mm[:ss][.SSSSSSSSS]", "M/d/yyyy H:mm:ss[.SSSSSSSSS]",
        "d-MMM-yyyy[ H:mm[:ss]]", "d MMM yyyy[ H:mm[:ss]]", "MMM d, yyyy[ H:mm[:ss]]", "yyyyMMdd",
    )
    text_patterns: dict[str, str] = field(default_factory=lambda: dict(TEXT_PATTERNS))
    dropped: tuple[str, ...] = DROPPED
    group_imputed: tuple[str, ...] = GROUP_IMPUTED
    target_encoded: tuple[str, ...] = TARGET_ENCODED
    one_hot: tuple[str, ...] = ONE_HOT
    price_bounds: tuple[float, float] = PRICE_BOUNDS
    placeholder_year: int = PLACEHOLDER_YEAR
    min_year: int = MIN_YEAR
    rare_below: int = RARE_BELOW
    null_as: str = "reference"
    split_key: str = "Sales ID"
    split_ratios: tuple[float, float, float] = SPLIT_RATIOS
    seed: int = SEED

    def __post_init__(self):
        if self.null_as not in ("reference", "unknown"):
            raise ValueError("null_as must be 'reference' or 'unknown'")
