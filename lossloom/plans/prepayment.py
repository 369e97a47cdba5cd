"""Prepayment model stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.operators import labels, models, sampling
from lossloom.operators.durable import durable
from lossloom.params import PrepaySettings
from lossloom.sources.results import Results

KEY = ("loan_id", "reporting_period")


def prepay_features(s: PrepaySettings) -> list[str]:
    return [*s.features, *(s.macro_features if s.use_macro else ())]


def prepay_dataset(features: DataFrame, monthly: DataFrame, macro: DataFrame | None,
                   s: PrepaySettings = PrepaySettings()) -> DataFrame:
    """Labelled rows with ``split``; the train part is thinned to its cap at unchanged rates.

    The rows are stored once, as the cut counts them before it picks; all test rows stay.
    """
    rows = labels.label_prepayments(features, labels.terminal_events(monthly), s.horizon)
    if s.use_macro:
        rows = labels.with_refi_incentive(rows, macro)
    rows = durable(labels.with_split(rows, s.split_date))
    train = sampling.keep_class_rates(rows.filter(F.col("split") == "train"), s.max_train_rows,
                                      sampling.row_key(*KEY), s.seed)
    return train.unionByName(rows.filter(F.col("split") == "test"))


def fit_prepay_models(features: DataFrame, monthly: DataFrame, macro: DataFrame | None,
                      s: PrepaySettings = PrepaySettings(), trees: dict | None = None,
                      results: Results | None = None) -> models.Contest:
    rows = prepay_dataset(features, monthly, macro, s)
    chosen = prepay_features(s)
    rows = durable(rows.select(*chosen, "target", "split"))
    contest = models.train_and_compare(rows.filter("split = 'train'"),
                                       rows.filter("split = 'test'"), chosen, trees=trees)
    if results is not None:
        results.replace(contest.metrics, "prepay_metrics")
    return contest
