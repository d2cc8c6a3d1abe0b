"""Job parameters as frozen dataclasses, so that a job's thresholds are one comparable value."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Axis:
    """How a frame is laid out in time.

    ``keys`` name the series, ``ts`` the timestamp column and ``step`` the grid distance in seconds. ``bucket`` is the
    number of grid steps in one time bucket: ordered operators work per (series, bucket), so no task ever holds a
    whole series.
    """

    keys: tuple[str, ...] = ("series_id",)
    ts: str = "ts"
    step: int = 3600
    phase: int = 0
    bucket: int = 4096


# Default thresholds of the forecasting workflow.
@dataclass(frozen=True)
class QualityParams:
    timestamp: str = "utc_timestamp"
    load: str = "DE_load_actual_entsoe_transparency"
    wind: str = "DE_wind_generation_actual"
    solar: str = "DE_solar_generation_actual"
    min_load: float = 20000.0
    max_load: float = 90000.0
    min_wind: float = 0.0
    max_wind: float = 60000.0
    max_null_fraction: float = 0.02
    mostly: float = 0.99
    min_rows: int = 8760


@dataclass(frozen=True)
class CleanParams:
    max_gap: int = 6
    refill_limit: int = 24
    mode: str = "reference"  # "reference" | "strict"
    outlier_method: str = "iqr"  # "iqr" | "isolation_forest"
    iqr_multiplier: float = 3.0
    contamination: float = 0.01
    columns: tuple[str, ...] = ("load_mw", "wind_mw", "solar_mw")
    non_negative: tuple[str, ...] = ("wind_mw", "solar_mw")
    fence_until: str | None = None
    causal: bool = False


@dataclass(frozen=True)
class FeatureParams:
    target: str = "load_mw"
    lags: tuple[int, ...] = (1, 2, 3, 6, 12, 24, 48, 168)
    windows: tuple[int, ...] = (6, 12, 24, 168)
    fourier_periods: tuple[int, ...] = (24, 168)
    fourier_order: int = 3
    country: str = "DE"
    holidays: str = "calendar"  # "calendar" | "compat" (always 0)
    drop_nulls: bool = True


@dataclass(frozen=True)
class SplitParams:
    train_end: str = "2018-12-31 23:00:00"
    val_end: str = "2019-12-31 23:00:00"


@dataclass(frozen=True)
class BoostParams:
    trees: int = 500
    learning_rate: float = 0.05
    max_depth: int = 6  # 2**6 leaves, one more than 63
    min_leaf: int = 20
    column_share: float = 0.8
    row_share: float = 1.0
    tolerance: float = 0.0
    seed: int = 42


@dataclass(frozen=True)
class TrainParams:
    target: str = "load_mw"
    season: int = 168
    folds: int = 4
    lower_alpha: float = 0.1
    upper_alpha: float = 0.9
    boost: BoostParams = field(default_factory=BoostParams)
    changepoints: int = 25
    ridge: float = 0.05
    multiplicative: bool = True
    require_improvement: bool = False  # promote only a model that beats the one in production
    explain_rows: int | None = None  # attributions for a hash sample of that many validation rows; None: for all


@dataclass(frozen=True)
class AdaptiveParams:
    target_coverage: float = 0.8
    gamma: float = 0.005


@dataclass(frozen=True)
class DriftWindow:
    label: str
    start: str
    end: str
    note: str = ""


@dataclass(frozen=True)
class DriftParams:
    """A reference period, the windows compared with it, and the period left out of the monthly error baseline."""

    reference: DriftWindow
    windows: tuple[DriftWindow, ...]
    perturb_start: str | None = None
    perturb_end: str | None = None
    flag_ratio: float = 1.5
    end_inclusive_day: bool = False
    test: str = "distance"  # "distance" | "p_value"
