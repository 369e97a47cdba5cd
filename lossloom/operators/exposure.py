"""Exposure panel, amortisation back-test and exposure inputs of the current book."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.functions.amortization import balance_path, monthly_growth, not_below_zero, unpaid
from lossloom.operators import ranks
from lossloom.operators.durable import durable
from lossloom.operators.sampling import sample_one_in
from lossloom.operators.windows import by_loan

INPUTS = ["upb_current", "note_rate", "remaining_term"]


def exposure_columns(monthly: DataFrame) -> DataFrame:
    """Note rate and remaining term from whichever columns the table has, performing rows only."""
    rate = "int_rate_current" if "int_rate_current" in monthly.columns else "int_rate_orig"
    terms = [c for c in ("remaining_months_to_maturity", "remaining_months_to_legal_maturity")
             if c in monthly.columns]
    if not terms:
        raise ValueError("no remaining-term column in the monthly table")
    return monthly.select(
        "loan_id", "reporting_period", F.col("upb_current").cast("double").alias("upb_current"),
        F.col(rate).cast("double").alias("note_rate"),
        F.col(terms[0]).cast("double").alias("remaining_term"),
    ).filter((F.col("upb_current") > 0) & (F.col("remaining_term") > 0))


def exposure_panel(monthly: DataFrame, one_in: int = 1) -> DataFrame:
    """Rows with positive balance and term and a known rate; of one loan in ``one_in`` if over 1.

    Rows without a loan id belong to no loan and stay out: they would meet in one window.
    """
    rows = exposure_columns(monthly)
    return (sample_one_in(rows, one_in) if one_in > 1 else rows).na.drop(
        subset=["loan_id", *INPUTS])


def schedule_backtest(panel: DataFrame, horizons: tuple = (3, 6, 12, 24)) -> DataFrame:
    """Scheduled against actual balance ``h`` rows ahead, all horizons in one pass.

    ``horizon, n, mean_pred, mean_actual, mae, median_abs_pct_err, actual_to_scheduled``.
    """
    b, r, n = F.col("upb_current"), F.col("note_rate"), F.col("remaining_term")
    known = panel.select(b, r, n, *[F.lead(b, h).over(by_loan()).alias(f"actual{h}") for h in horizons])
    # Powers are dear: each is taken once per row, and none for a horizon past the last row of the loan.
    paid = {h: F.least(F.lit(float(h)), n) for h in horizons}
    growth = monthly_growth(r)
    powers = known.withColumns({"_full": F.pow(growth, n), **{
        f"_part{h}": F.when(F.col(f"actual{h}").isNotNull(), F.pow(growth, k)) for h, k in paid.items()}})
    left = powers.withColumns({f"pred{h}": unpaid(b, r, n, k, F.col("_full"), F.col(f"_part{h}"))
                               for h, k in paid.items()})
    # One flat row per loan-month is stored, with all horizons beside each other: one aggregate over it
    # gives the means and the sketches of the medians, one more pass the medians.
    wide = durable(left.select(*[c for h in horizons for c in (
        f"actual{h}", not_below_zero(F.col(f"pred{h}")).alias(f"pred{h}"))]))
    errors = {h: {"pct_err": F.abs(pred - actual) / F.greatest(actual, F.lit(1.0)),
                  "ratio": actual / F.greatest(pred, F.lit(1.0))}
              for h in horizons for actual, pred in [(F.col(f"actual{h}"), F.col(f"pred{h}"))]}
    counted = {h: F.col(f"actual{h}").isNotNull() & (F.col(f"pred{h}") > 0) for h in horizons}
    series = [(h, kind) for h in horizons for kind in errors[h]]
    terms = []
    for h, ok in counted.items():
        actual, pred = F.col(f"actual{h}"), F.col(f"pred{h}")
        terms += [F.count_if(ok).alias(f"n{h}")]
        terms += [F.avg(F.when(ok, x)).alias(f"{name}{h}") for name, x in (
            ("mean_pred", pred), ("mean_actual", actual), ("mae", F.abs(pred - actual)))]
    kept = wide.select(*wide.columns, *[F.when(counted[h], errors[h][kind]).alias(f"_{i}")
                                        for i, (h, kind) in enumerate(series)])
    totals = durable(kept.agg(*terms, *[ranks.sketch_of(f"_{i}", [0.5]).alias(f"_q{i}")
                                        for i in range(len(series))]))
    means = totals.select(F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), *[
        F.col(f"{c}{h}").alias(c) for c in ("n", "mean_pred", "mean_actual", "mae")])
        for h in horizons])).alias("v")).select("v.*").filter("n > 0")
    sketch = totals.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("series"), F.col(f"_q{i}").alias("_q")) for i in range(len(series))]))
        .alias("v")).select("v.*").withColumn("_few", F.lit(False))
    long = kept.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("series"), F.col(f"_{i}").alias("x")) for i in range(len(series))]))
        .alias("v")).select("v.*").filter(F.col("x").isNotNull())
    mid = ranks.exact_quantiles(long, ["series"], "x", [0.5], sketch)
    middle = F.get("quantiles", F.lit(0))
    of = {name: F.get(F.array(*[F.lit(x) for x in values]), F.col("series"))
          for name, values in zip(("horizon", "kind"), zip(*series))}
    medians = mid.withColumns(of).groupBy("horizon").agg(
        F.max(F.when(F.col("kind") == "pct_err", middle)).alias("median_abs_pct_err"),
        F.max(F.when(F.col("kind") == "ratio", middle)).alias("actual_to_scheduled"))
    return means.join(medians, "horizon")


def curtailment_factor(backtest: DataFrame, at_horizon: int = 12) -> DataFrame:
    """Actual/scheduled at the horizon, else at the longest one, else 1 (one row)."""
    ratio = F.col("actual_to_scheduled")
    return backtest.agg(F.coalesce(
        F.max(F.when(F.col("horizon") == at_horizon, ratio)),
        F.max_by(ratio, "horizon"), F.lit(1.0)).alias("curtailment_factor"))


def projected_exposure(loans: DataFrame, horizon: int, curtailment: float = 1.0) -> DataFrame:
    """One row per loan and future month: ``loan_id, month, ead``."""
    path = balance_path("upb_current", "note_rate", "remaining_term", horizon, curtailment)
    return loans.select("loan_id", F.posexplode(path).alias("_i", "ead")).select(
        "loan_id", (F.col("_i") + 1).alias("month"), "ead")


def latest_exposure(monthly: DataFrame, period: str | None = None) -> DataFrame:
    """Most recent row per loan with positive balance and term: ``loan_id, upb, rate, term``."""
    rows = exposure_columns(monthly)
    if period:
        rows = rows.filter(F.col("reporting_period") == F.lit(period).cast("date"))
    newest = rows.filter(F.col("loan_id").isNotNull()).groupBy("loan_id").agg(
        F.max(F.struct("reporting_period", *INPUTS)).alias("r"))
    return newest.select("loan_id", F.col("r.upb_current").alias("upb"),
                         F.col("r.note_rate").alias("rate"),
                         F.col("r.remaining_term").alias("term")).na.drop(
        subset=["upb", "rate", "term"])
