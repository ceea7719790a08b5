"""Parameters of the jobs, with their default values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Descriptions that are never recommended.
EXCLUDED_DESCRIPTIONS = (
    "BOLSA PLASTICA",
    "BOLSA RECUPERADA",
    "MENU EMPLEADOS EURO",
)

# Columns the purchase model reads, in model order.
MODEL_FEATURES = (
    "dow",
    "dom",
    "month",
    "is_weekend",
    "is_quincena",
    "days_since_last",
    "cnt_3d",
    "cnt_7d",
    "cnt_30d",
    "avg_amount_7d",
    "avg_amount_30d",
    "avg_skus_7d",
    "avg_skus_30d",
)

# Days of the month around payday.
PAYDAYS = (28, 29, 30, 31, 1, 2, 13, 14, 15, 16)


@dataclass(frozen=True)
class WindowParams:
    months_to_keep: int = 6
    recent_months: int = 3


@dataclass(frozen=True)
class PatternParams:
    min_purchase_days: int = 10
    max_median_days: float = 35
    max_std_days: float = 3
    min_products: int | None = 5


@dataclass(frozen=True)
class CalendarParams:
    future_days: int = 5
    paydays: tuple[int, ...] = PAYDAYS
    no_purchase_days: int = 365
    count_windows: tuple[int, ...] = (3, 7, 30)
    mean_windows: tuple[int, ...] = (7, 30)


@dataclass(frozen=True)
class ModelParams:
    features: tuple[str, ...] = MODEL_FEATURES
    target: str = "purchased"
    split_days: int = 30
    model_type: str = "gradient_boosting"
    seed: int = 42
    # logistic regression
    lr_max_iter: int = 100
    # Newton steps end when no coefficient moves by more than this.
    lr_tol: float = 1e-9
    lr_c: float = 1.0
    # gradient boosting
    trees: int = 200
    depth: int = 6
    learning_rate: float = 0.1
    min_leaf: int = 50
    l2: float = 0.1
    max_leaves: int = 31
    max_bins: int = 255
    # Boosting stops early on tables of more rows than this.
    early_stopping_rows: int = 10_000
    hold_out: float = 0.1
    patience: int = 10
    stop_tol: float = 1e-7
    # evaluation
    calibration: str = "sigmoid"
    bins: int = 10
    threshold: float = 0.5
    # None: every row; a number samples, as a quick look may do.
    shap_rows: int | None = None
    permutation_rows: int | None = None
    permutation_repeats: int = 10


@dataclass(frozen=True)
class RecommendParams:
    n_recs: int = 5
    months: int = 3
    products_per_client: int = 5
    top_quantile: float = 0.90
    excluded: tuple[str, ...] = EXCLUDED_DESCRIPTIONS
    top_fraction: float = 0.75
    history_months: int = 1
    score_decimals: int = 6


@dataclass(frozen=True)
class SegmentParams:
    recent_months: int = 1
    n_clusters: int | None = 5
    k_min: int = 4
    k_max: int = 7
    features: tuple[str, ...] = ("tickets_per_month", "ticket_median", "months_active_ratio")
    seed: int = 42
    max_iter: int = 300
    tol: float = 1e-4


@dataclass(frozen=True)
class VipParams:
    min_weeks: int = 10
    n_clusters: int = 4
    restarts: int = 10
    seed: int = 42
    # First centres on the scaled features, instead of drawn ones.
    starts: tuple[tuple[tuple[float, ...], ...], ...] | None = None
    max_iter: int = 300
    tol: float = 1e-4


@dataclass(frozen=True)
class DeclineParams:
    early_months: tuple[int, ...] = field(default=tuple(range(1, 8)))
    late_months: tuple[int, ...] = field(default=tuple(range(8, 13)))
    top_n: int = 15
