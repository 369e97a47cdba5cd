"""Data-quality checks that share one scan: each check adds aggregates and turns them to rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions.bounds import no_nan
from lossloom.operators import ranks
from lossloom.operators.durable import durable
from lossloom.params import QualityLimits
from lossloom.schema import CHECK_RESULT

SPARSE_PCT = 50.0
MIN_FOR_OUTLIERS = 20
WARN_WEIGHT = 0.5


def _row(table, check_type, column, metric, value, threshold, status, message) -> Column:
    def lit(x, kind):
        return (x if isinstance(x, Column) else F.lit(x)).cast(kind)

    return F.struct(
        lit(table, "string").alias("table"), lit(check_type, "string").alias("check_type"),
        lit(column, "string").alias("column"), lit(metric, "string").alias("metric"),
        lit(value, "double").alias("value"), lit(threshold, "double").alias("threshold"),
        lit(status, "string").alias("status"), lit(message, "string").alias("message"))


@dataclass
class Checks:
    """Aggregates to compute in one pass and the result rows built from them."""

    table: str
    aggregates: dict[str, Column] = field(default_factory=dict)
    rows: list[Column] = field(default_factory=list)

    def _measure(self, expr: Column) -> Column:
        name = f"_a{len(self.aggregates)}"
        self.aggregates[name] = expr.alias(name)
        return F.col(name)

    def _share(self, bad: Column) -> Column:
        return F.coalesce(F.round(F.try_divide(F.lit(100.0) * bad, F.col("_rows")), 4),
                          F.lit(0.0))

    def completeness(self, df: DataFrame, core: tuple, max_null_pct: float) -> Checks:
        nulls = {c: self._measure(F.count_if(F.col(c).isNull())) for c in df.columns}
        for c in core:
            if c not in nulls:
                self.rows.append(_row(self.table, "completeness", c, "exists", 0, None, "FAIL",
                                      f"core column {c} is missing"))
                continue
            pct = self._share(nulls[c])
            self.rows.append(_row(
                self.table, "completeness", c, "null_pct", pct, max_null_pct,
                F.when(pct > max_null_pct, "FAIL").otherwise("PASS"),
                F.concat(F.lit(f"{c}: "), nulls[c], F.lit(" null value(s)"))))
        sparse = sum((self._share(n) > SPARSE_PCT).cast("int") for n in nulls.values())
        self.rows.append(_row(self.table, "completeness", None, "sparse_columns", sparse, None,
                              "INFO", F.concat(sparse, F.lit(" column(s) mostly null"))))
        return self

    def non_negative(self, df: DataFrame, columns: tuple) -> Checks:
        for c in (c for c in columns if c in df.columns):
            n = self._measure(F.count_if(F.col(c) < 0))
            self.rows.append(_row(
                self.table, "non_negative", c, "negative_count", n, 0,
                F.when(n > 0, "FAIL").otherwise("PASS"),
                F.concat(F.lit(f"{c}: "), n, F.lit(" negative value(s)"))))
        return self

    def ranges(self, df: DataFrame, limits: dict) -> Checks:
        for c, (lo, hi) in limits.items():
            if c not in df.columns:
                continue
            n = self._measure(F.count_if((F.col(c) < lo) | (F.col(c) > hi)))
            self.rows.append(_row(
                self.table, "range", c, "out_of_range_pct", self._share(n), None,
                F.when(n > 0, "WARN").otherwise("PASS"),
                F.concat(F.lit(f"{c}: "), n, F.lit(f" value(s) outside {lo} to {hi}"))))
        return self

    def dates(self, df: DataFrame, limits: dict) -> Checks:
        for c, (lo, hi) in limits.items():
            if c not in df.columns:
                continue
            day = F.col(c)
            first, last = F.lit(lo).cast("date"), F.lit(hi).cast("date")
            nulls = self._measure(F.count_if(day.isNull()))
            outside = self._measure(F.count_if((day < first) | (day > last)))
            bad = nulls + outside
            self.rows.append(_row(
                self.table, "date_validity", c, "invalid_date_pct", self._share(bad), None,
                F.when(bad > 0, "WARN").otherwise("PASS"),
                F.concat(F.lit(f"{c}: "), nulls, F.lit(" unreadable, "), outside,
                         F.lit(f" outside {lo} to {hi}"))))
        return self

    def schema(self, df: DataFrame, expected: list[str]) -> Checks:
        missing = sorted(set(expected) - set(df.columns))
        extra = sorted(set(df.columns) - set(expected))
        self.rows.append(_row(
            self.table, "schema", None, "missing_columns", len(missing), 0,
            "FAIL" if missing else "PASS",
            f"missing: {', '.join(missing)}" if missing else "all expected columns present"))
        if extra:
            self.rows.append(_row(self.table, "schema", None, "extra_columns", len(extra), None,
                                  "WARN", f"unexpected: {', '.join(extra)}"))
        return self

    def _totals(self) -> list[Column]:
        return [F.count(F.lit(1)).alias("_rows"), *self.aggregates.values()]

    def run(self, df: DataFrame) -> DataFrame:
        return self._result(df.agg(*self._totals()))

    def _result(self, totals: DataFrame) -> DataFrame:
        return totals.select(F.explode(F.array(*self.rows)).alias("r")).select("r.*")

    def while_storing(self, df: DataFrame,
                      columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """``df`` (or some of its columns) stored, and the check rows, taken from the rows on their way:
        the data is read and derived once. Write a table from what comes back.

        The figures, one number per check, are those of the named observation in the plan that was
        stored. (An Observation object would make the session unfit for MLlib's closures.)
        """
        name = f"checks-{uuid4().hex}"
        seen = df.observe(name, *self._totals())
        if columns is not None:
            seen = seen.select(*columns)
        kept = durable(seen)
        row = seen._jdf.queryExecution().observedMetrics().apply(name)
        figures = [row.get(i) for i in range(row.length())]
        totals = df.sparkSession.createDataFrame(
            [tuple(figures)], ", ".join(f"{n} bigint" for n in ("_rows", *self.aggregates)))
        return kept, self._result(totals)


def duplicate_check(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys count as equal, as in a distinct."""
    keys = [c for c in keys if c in df.columns]
    if not keys:
        return df.sparkSession.createDataFrame([], CHECK_RESULT)
    dupes = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
             .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("d")))
    d = F.col("d")
    return dupes.select(_row(
        table, "uniqueness", "+".join(keys), "duplicate_rows", d, 0,
        F.when(d > 0, "FAIL").otherwise("PASS"),
        F.concat(d, F.lit(" duplicate row(s)"))).alias("r")).select("r.*")


def long_values(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns stacked to ``(keep..., feature, x)``; NaN and null values stay null."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                      for c in columns])
    return df.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.feature", "p.x")


def outlier_check(df: DataFrame, table: str, columns: list[str],
                  interpolation: str = "linear") -> DataFrame:
    """Share outside 1.5 interquartile ranges, all columns in one job; report only.

    Quartiles interpolate linearly (or are the "nearest" value) and come from compacted counts; then
    one aggregate without a shuffle of rows counts what lies outside. The checked columns are stored
    once, as they are read three times; their limits, two numbers each, pass through the driver.
    """
    columns = [c for c in columns if c in df.columns]
    df = durable(df.select(*columns))
    quartiles = ranks.exact_quantiles(long_values(df, columns), ["feature"], "x", [0.25, 0.75],
                                      interpolation=interpolation)
    limits = {r["feature"]: r["quantiles"] for r in
              quartiles.filter(F.col("n_total") >= MIN_FOR_OUTLIERS).collect()}
    if not limits:
        return df.sparkSession.createDataFrame([], CHECK_RESULT)

    def outside(column: str) -> Column:
        q1, q3 = limits[column]
        x, reach = no_nan(F.col(column).cast("double")), 1.5 * (q3 - q1)
        return F.count_if((x < q1 - reach) | (x > q3 + reach)).alias(f"_out_{column}")

    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *map(outside, limits))
    return counted.select(F.explode(F.array(*[_row(
        table, "outlier", F.lit(c), "outlier_pct",
        F.round(F.lit(100.0) * F.col(f"_out_{c}") / F.col("_rows"), 4), None, "INFO",
        F.concat(F.lit(f"{c}: "), F.col(f"_out_{c}"), F.lit(" outlier(s)"))) for c in limits
    ])).alias("r")).select("r.*")


def master_pass(master: DataFrame, expected: list[str],
                q: QualityLimits = QualityLimits()) -> Checks:
    """Checks of the loan table that share one pass."""
    return (Checks("loan_master").schema(master, expected)
            .completeness(master, q.core_master, q.max_null_pct)
            .non_negative(master, q.non_negative)
            .ranges(master, q.numeric_ranges)
            .dates(master, q.date_bounds))


def monthly_pass(monthly: DataFrame, q: QualityLimits = QualityLimits()) -> Checks:
    """Checks of the monthly table that share one pass."""
    return (Checks("loan_monthly")
            .completeness(monthly, q.core_monthly, q.max_null_pct)
            .non_negative(monthly, q.non_negative)
            .dates(monthly, q.date_bounds))


def grade(score: Column) -> Column:
    return (F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C")
            .when(score >= 60, "D").otherwise("F"))


def scorecard(results: DataFrame) -> DataFrame:
    """Status counts, 0-100 score and grade per table; the row with a null table is overall."""
    def count(status):
        return F.count_if(F.col("status") == status)

    counts = results.rollup("table").agg(
        F.grouping("table").alias("is_overall"),
        count("PASS").alias("n_pass"), count("WARN").alias("n_warn"),
        count("FAIL").alias("n_fail"), count("INFO").alias("n_info"),
        F.count(F.lit(1)).alias("total_checks"))
    scored = F.col("n_pass") + F.col("n_warn") + F.col("n_fail")
    score = F.coalesce(
        F.try_divide(100.0 * (F.col("n_pass") + WARN_WEIGHT * F.col("n_warn")), scored),
        F.lit(100.0))
    return counts.withColumn("score", F.round(score, 1)).withColumn("grade", grade(score))


def by_severity(results: DataFrame) -> DataFrame:
    """FAIL first, then WARN, INFO and PASS."""
    rank = F.array_position(F.array(*[F.lit(s) for s in ("FAIL", "WARN", "INFO", "PASS")]),
                            F.col("status"))
    return results.orderBy(rank, "table", "check_type", "column", "metric")
