"""Default parameters of every stage. Pass a changed copy (``dataclasses.replace``) to override."""

from __future__ import annotations

from dataclasses import dataclass, field

# Codes, thresholds and scenario settings that results depend on.


@dataclass(frozen=True)
class QualityLimits:
    core_master: tuple = ("loan_id", "fico_orig", "ltv_orig", "upb_orig", "int_rate_orig",
                          "state", "vintage")
    core_monthly: tuple = ("loan_id", "reporting_period", "upb_current", "delq_status", "loan_age")
    max_null_pct: float = 5.0
    numeric_ranges: dict = field(default_factory=lambda: {
        "fico_orig": (300, 850), "ltv_orig": (1, 200), "cltv_orig": (1, 250), "dti_orig": (0, 80),
        "int_rate_orig": (0, 20), "int_rate_current": (0, 20), "number_of_units": (1, 4),
        "loan_age": (0, 480)})
    non_negative: tuple = ("upb_orig", "upb_current", "total_principal_current")
    date_bounds: dict = field(default_factory=lambda: {
        "reporting_period": ("2000-01-01", "2027-01-01"),
        "origination_date": ("1999-01-01", "2027-01-01")})
    outlier_columns: tuple = ("fico_orig", "ltv_orig", "dti_orig", "int_rate_orig", "upb_orig")
    drift_features: tuple = ("fico_orig", "ltv_orig", "dti_orig", "int_rate_orig")
    psi_warn: float = 0.10
    psi_alert: float = 0.25
    psi_bins: int = 10


@dataclass(frozen=True)
class EventCodes:
    default: tuple = ("02", "03", "09", "15")
    prepay: str = "01"
    prepay_loose: tuple = ("01", "1")
    default_loose: tuple = ("02", "03", "09", "15", "2", "3", "9")
    dpd30_months: int = 1
    dpd90_months: int = 3
    max_age: int = 60


@dataclass(frozen=True)
class FeatureSettings:
    balance_months: int = 3
    delq_months: int = 3
    windows: tuple = (6, 12)
    dpd30_months: int = 1


@dataclass(frozen=True)
class PdSettings:
    horizon: int = 12
    default_dpd: int = 3
    split_date: str = "2022-01-01"
    max_train_rows: int | None = 750_000  # None: all rows
    woe_bins: int = 8
    seed: int = 42
    features: tuple = (
        "fico_orig", "ltv_orig", "dti_orig", "int_rate_orig", "current_ltv", "upb_paydown_ratio",
        "rate_spread_vs_orig", "loan_age", "months_on_book", "delq_num", "max_delq_6m",
        "max_delq_12m", "count_30dpd_12m", "delq_change_3m", "balance_change_3m",
        "vintage_avg_fico")


@dataclass(frozen=True)
class PrepaySettings:
    horizon: int = 12
    split_date: str = "2022-01-01"
    max_train_rows: int = 750_000
    seed: int = 42
    use_macro: bool = True
    features: tuple = (
        "fico_orig", "ltv_orig", "dti_orig", "int_rate_orig", "current_ltv", "upb_paydown_ratio",
        "loan_age", "months_on_book", "delq_num", "count_30dpd_12m", "balance_change_3m",
        "vintage_avg_fico")
    macro_features: tuple = ("mortgage_30y", "refi_incentive", "incentive_burnout", "treasury_10y")


@dataclass(frozen=True)
class PitSettings:
    rho: float = 0.15
    min_n: int = 500
    macro_features: tuple = ("unemployment", "hpi_yoy", "gdp_yoy", "treasury_10y")


@dataclass(frozen=True)
class LgdSettings:
    features: tuple = ("mtm_ltv", "loan_age_years")
    buckets: tuple = (0, 60, 70, 80, 90, 100, 110, 999)
    floor: float = 0.05
    hpi_shock: float = -0.20
    benchmark: float = 0.35
    window_months: int = 24
    min_obs: int = 100


@dataclass(frozen=True)
class EadSettings:
    horizons: tuple = (3, 6, 12, 24)
    sample_mod: int = 1  # 1: all loans; n: one loan in n
    apply_curtailment: bool = False


@dataclass(frozen=True)
class StagingSettings:
    default_dpd: int = 3
    backstop_dpd: int = 1
    pd_rel: float = 2.0
    pd_abs: float = 0.01


@dataclass(frozen=True)
class ScenarioSettings:
    horizon: int = 60
    ramp: int = 12
    mode: str = "macro"  # "macro" shocks the macro series, "z_overlay" shifts Z
    enforce_monotonic: bool = True
    weights: dict = field(default_factory=lambda: {"base": 0.50, "upside": 0.25, "downside": 0.25})
    shocks: dict = field(default_factory=lambda: {
        "base": {"unemployment": 0.0, "hpi_yoy": 0.0, "gdp_yoy": 0.0, "treasury_10y": 0.0},
        "upside": {"unemployment": -1.0, "hpi_yoy": 3.0, "gdp_yoy": 1.0, "treasury_10y": 0.5},
        "downside": {"unemployment": 4.0, "hpi_yoy": -12.0, "gdp_yoy": -3.0,
                     "treasury_10y": -1.0}})
    z_overlay: dict = field(default_factory=lambda: {
        "base": 0.0, "upside": 0.5, "downside": -1.0})


@dataclass(frozen=True)
class LossSettings:
    horizon: int = 60
    annual_cpr: float = 0.10
    downside: str = "downside"


@dataclass(frozen=True)
class ValidationSettings:
    min_auc: float = 0.70
    coverage_range_pct: tuple = (0.05, 2.0)
    stage3_tolerance_pct: float = 0.5
    calibration_band: tuple = (0.3, 3.0)
    cpr_values: tuple = (0.0, 0.05, 0.10, 0.20)
    horizon_values: tuple = (36, 48, 60)
    downturn_lgd_values: tuple = (0.30, 0.35, 0.45)
    weight_variants: dict = field(default_factory=lambda: {
        "base": {"base": 0.50, "upside": 0.25, "downside": 0.25},
        "downside_heavy": {"base": 0.40, "upside": 0.20, "downside": 0.40},
        "severe": {"base": 0.30, "upside": 0.10, "downside": 0.60}})


@dataclass(frozen=True)
class MonitoringSettings:
    min_n: int = 500
    psi_bins: int = 10
    psi_amber: float = 0.10
    psi_red: float = 0.25
    backtest_amber: float = 0.50
    backtest_red: float = 1.00
    default_dpd: int = 3
