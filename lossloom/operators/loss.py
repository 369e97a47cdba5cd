"""Probability-weighted 12-month and lifetime loss of every loan, and its sensitivity.

The inner sum over scenarios and months is row-local, so loans stream through an Arrow-batch
NumPy kernel without a shuffle; higher-order functions would interpret 180 steps per loan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.functions.rates import monthly_prepay_value
from lossloom.operators.durable import durable
from lossloom.params import LossSettings, ValidationSettings

LOAN_COLUMNS = ["loan_id", "stage", "pd12", "upb", "rate", "term"]
CHUNK = 4096  # loans per block: a block of 60 months stays in cache


@dataclass(frozen=True)
class LossCase:
    """Everything but the loans: scenario paths (a few hundred numbers) and assumptions."""

    name: str
    multipliers: dict[str, tuple[float, ...]]
    weights: dict[str, float]
    lgd: dict[str, float]
    smm: float
    horizon: int

    @property
    def weighted_lgd(self) -> float:
        return sum(w * self.lgd[s] for s, w in self.weights.items())


def collect_paths(paths: DataFrame) -> dict[str, tuple[float, ...]]:
    """Scenario paths as parameters; scenarios x months numbers."""
    rows = paths.select("scenario", "month", "pit_pd").orderBy("scenario", "month").collect()
    found: dict[str, list[float]] = {}
    for r in rows:
        found.setdefault(r["scenario"], []).append(r["pit_pd"])
    return {name: tuple(values) for name, values in found.items()}


def anchored(paths: dict[str, tuple[float, ...]],
             weights: dict[str, float]) -> dict[str, tuple[float, ...]]:
    """Paths relative to their weighted month-1 level."""
    anchor = sum(weights[s] * paths[s][0] for s in weights)
    if anchor <= 0:
        raise ValueError("the weighted default probability of month 1 is not positive")
    return {s: tuple(p / anchor for p in path) for s, path in paths.items()}


def loss_case(name: str, paths: dict[str, tuple[float, ...]], weights: dict[str, float],
              base_lgd: float, downturn_lgd: float,
              s: LossSettings = LossSettings()) -> LossCase:
    """Downturn severity applies to the downside scenario only."""
    lgd = {k: downturn_lgd if k == s.downside else base_lgd for k in weights}
    horizon = min(s.horizon, min(len(p) for p in paths.values()))
    return LossCase(name, anchored(paths, weights), dict(weights), lgd,
                    monthly_prepay_value(s.annual_cpr), horizon)


def _discounted_balance(upb, rate, term, horizon: int) -> np.ndarray:
    """Scheduled balance after each month, discounted at the note rate (loans x months)."""
    t = np.arange(1, horizon + 1, dtype=float)
    r = (rate / 100.0 / 12.0)[:, None]
    n = term[:, None]
    paid = np.minimum(t[None, :], n)
    with np.errstate(all="ignore"):
        growth_n = (1.0 + r) ** n
        level = upb[:, None] * (growth_n - (1.0 + r) ** paid) / np.where(
            np.abs(growth_n - 1.0) < 1e-12, np.nan, growth_n - 1.0)
        line = upb[:, None] * (n - paid) / n
        balance = np.where(np.abs(r) < 1e-9, line, level)
        balance = np.where((upb[:, None] <= 0) | (n <= 0), 0.0, balance)
        return np.maximum(balance, 0.0) * (1.0 + r) ** -t[None, :]


def _unit_losses(hazard: np.ndarray, path: tuple[float, ...], smm: float,
                 value: np.ndarray) -> np.ndarray:
    """Running expected loss per month at 100% severity for one scenario."""
    horizon = value.shape[1]
    h = np.clip(hazard[:, None] * np.asarray(path[:horizon]), 0.0, 1.0)
    alive = np.cumprod((1.0 - h) * (1.0 - smm), axis=1)
    h[:, 1:] *= alive[:, :-1]
    h *= value
    return np.cumsum(h, axis=1, out=h)


def _hazard(block: pd.DataFrame) -> np.ndarray:
    pd12 = np.clip(block["pd12"].to_numpy(dtype=float), 0.0, 0.999999)
    return 1.0 - (1.0 - pd12) ** (1.0 / 12.0)


def _block_value(block: pd.DataFrame, horizon: int) -> np.ndarray:
    return _discounted_balance(*(block[c].to_numpy(dtype=float) for c in ("upb", "rate", "term")),
                               horizon)


def _losses(block: pd.DataFrame, cases: list[LossCase]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """12-month and lifetime loss of each loan for each case, sharing equal scenario paths."""
    upb = block["upb"].to_numpy(dtype=float)
    hazard = _hazard(block)
    value = _block_value(block, max(c.horizon for c in cases))
    in_default = block["stage"].to_numpy() >= 3
    known: dict[tuple, np.ndarray] = {}
    for case in cases:
        near, life = np.zeros(len(block)), np.zeros(len(block))
        for s, w in case.weights.items():
            key = (case.multipliers[s], case.smm)
            if key not in known:
                known[key] = _unit_losses(hazard, *key, value)
            share = w * case.lgd[s]
            near += share * known[key][:, min(12, case.horizon) - 1]
            life += share * known[key][:, case.horizon - 1]
        certain = case.weighted_lgd * upb
        yield np.where(in_default, certain, near), np.where(in_default, certain, life)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), CHUNK):
            yield batch.iloc[start:start + CHUNK]


def loan_losses(loans: DataFrame, case: LossCase) -> DataFrame:
    """``loan_id, stage, upb, ecl_12m, ecl_lifetime, ecl``; stage 1 uses the 12-month figure."""
    loans = loans.select(*LOAN_COLUMNS)

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches):
            near, life = next(_losses(block, [case]))
            yield pd.DataFrame({
                "loan_id": block["loan_id"], "stage": block["stage"], "upb": block["upb"],
                "ecl_12m": near, "ecl_lifetime": life,
                "ecl": np.where(block["stage"] == 1, near, life)})

    kinds = dict(loans.dtypes)
    return loans.mapInPandas(
        kernel, f"loan_id {kinds['loan_id']}, stage int, upb double, "
                "ecl_12m double, ecl_lifetime double, ecl double")


def monthly_profile(loans: DataFrame, case: LossCase) -> DataFrame:
    """Expected loss per scenario and month over all loans, before the stage rule.

    ``scenario, month, n, loss, n_without_loss``; each block of loans emits scenarios x months partial
    sums. Loans whose loss is unknown (an input is missing) count in ``n`` and ``n_without_loss``.
    """
    loans = loans.select(*LOAN_COLUMNS[1:])

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches):
            hazard, value = _hazard(block), _block_value(block, case.horizon)
            for s in case.weights:
                total = _unit_losses(hazard, case.multipliers[s], case.smm, value)
                step = np.diff(np.nansum(total, axis=0), prepend=0.0) * case.lgd[s]
                yield pd.DataFrame({"scenario": s, "month": range(1, case.horizon + 1),
                                    "n": len(block), "loss": step,
                                    "n_without_loss": np.isnan(total).sum(axis=0)})

    partial = loans.mapInPandas(
        kernel, "scenario string, month int, n bigint, loss double, n_without_loss bigint")
    return partial.groupBy("scenario", "month").agg(
        *[F.sum(c).alias(c) for c in ("n", "loss", "n_without_loss")])


def loss_summary(losses: DataFrame) -> DataFrame:
    """Totals per stage plus the portfolio row (null stage): balance, losses and coverage.

    Loans without a loss (an input is missing) count in the balance only; ``n_without_loss`` and
    ``ead_without_loss`` say how many and how much, so that low coverage cannot hide them.
    """
    missing = F.col("ecl").isNull() | F.isnan("ecl")
    return losses.rollup("stage").agg(
        F.count_if(missing).alias("n_without_loss"),
        F.coalesce(F.sum(F.when(missing, F.col("upb"))), F.lit(0.0)).alias("ead_without_loss"),
        F.count(F.lit(1)).alias("n_loans"), F.sum("upb").alias("ead"), F.sum("ecl").alias("ecl"),
        F.sum("ecl_12m").alias("ecl_12m"), F.sum("ecl_lifetime").alias("ecl_lifetime"),
    ).withColumn("coverage_pct", F.col("ecl") / F.greatest("ead", F.lit(1.0)) * 100)


def attach_exposure(staged: DataFrame, exposure: DataFrame) -> DataFrame:
    """Loans with a stage and exposure inputs: the kernel's input."""
    return staged.select("loan_id", F.col("pd_now").alias("pd12"), "stage").join(
        exposure, "loan_id")


def sensitivity_cases(paths: dict[str, tuple[float, ...]], weights: dict[str, float],
                      base_lgd: float, downturn_lgd: float, s: LossSettings = LossSettings(),
                      v: ValidationSettings = ValidationSettings()) -> list[tuple]:
    """``(lever, value, case)`` rows, the base case first; new weights re-anchor the paths."""
    longest = min(len(p) for p in paths.values())
    s = replace(s, horizon=min(s.horizon, longest))

    def case(lever, value, w=weights, down=downturn_lgd, **changes):
        return lever, str(value), loss_case(f"{lever}|{value}", paths, w, base_lgd, down,
                                            replace(s, **changes))

    rows = [case("BASE CASE", f"cpr={s.annual_cpr}, H={s.horizon}")]
    rows += [case("annual_cpr", c, annual_cpr=c) for c in v.cpr_values]
    rows += [case("horizon_months", min(h, longest), horizon=min(h, longest))
             for h in v.horizon_values]
    rows += [case("downturn_lgd", d, down=d) for d in v.downturn_lgd_values]
    rows += [case("scenario_weights", name, w=w) for name, w in v.weight_variants.items()]
    return rows


def sensitivity_grid(loans: DataFrame, cases: list[tuple]) -> DataFrame:
    """Portfolio loss under every case in one pass over the loans.

    ``position, lever, value, total_ecl, coverage_pct, delta_vs_base_pct, n_without_loss,
    ead_without_loss``. Loans whose loss is unknown are in the balance, not in the loss; the last two
    columns say how many and how much. Each block emits one partial sum per case, so only blocks x
    cases rows are shuffled.
    """
    loans = loans.select(*LOAN_COLUMNS[1:])
    bare = [c for _, _, c in cases]

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches):
            first = block["stage"].to_numpy() == 1
            upb = block["upb"].to_numpy(dtype=float)
            each = [np.where(first, near, life) for near, life in _losses(block, bare)]
            lost = [np.isnan(e) for e in each]
            yield pd.DataFrame({"position": range(len(bare)), "ecl": [np.nansum(e) for e in each],
                                "ead": np.nansum(upb), "n": [m.sum() for m in lost],
                                "out": [np.nansum(upb[m]) for m in lost]})

    partial = loans.mapInPandas(kernel, "position int, ecl double, ead double, n bigint, out double")
    # One row per case, stored: the base case is read from it too, without a second pass over the loans.
    totals = durable(partial.groupBy("position").agg(
        F.sum("ecl").alias("total_ecl"), F.sum("ead").alias("_ead"),
        F.sum("n").alias("n_without_loss"), F.sum("out").alias("ead_without_loss")))
    names = F.array(*[F.struct(F.lit(lever).alias("lever"), F.lit(value).alias("value"))
                      for lever, value, _ in cases])
    base = totals.filter("position = 0").select("total_ecl").scalar()
    return totals.withColumn("_name", F.get(names, F.col("position"))).select(
        "position", "_name.lever", "_name.value", "total_ecl",
        (F.col("total_ecl") / F.greatest("_ead", F.lit(1.0)) * 100).alias("coverage_pct"),
        ((F.col("total_ecl") / base - 1) * 100).alias("delta_vs_base_pct"), "n_without_loss",
        "ead_without_loss")
