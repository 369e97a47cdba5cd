"""All stages one after the other on the smallest derived panel."""

from dataclasses import replace

from lossloom import params
from lossloom.operators import features, models
from lossloom.operators.durable import durable
from lossloom.plans import default_model, oversight, prepayment, quality, risk
from lossloom.sources import results
from lossloom.sources.warehouse import Warehouse
from workload import common, tables

SF = "/root/testdata/sf0.001"
TREES = {"boosted": models.TreeSettings(trees=3, depth=3)}


def test_every_stage_runs(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "warehouse"))
    out = results.Results(spark, str(tmp_path / "results"))
    store.replace_vintages(tables.monthly(spark, SF), "loan_monthly")
    store.replace_vintages(tables.master(spark, SF), "loan_master")
    store.replace(common.macro_table(spark, SF), "macro_data")
    monthly, master, macro = (store.read(t) for t in ("loan_monthly", "loan_master", "macro_data"))

    card = quality.run(store, out, "run-1")
    assert card.filter("is_overall = 1").first()["total_checks"] > 50

    feats = durable(features.feature_table(monthly, master))
    pd_settings = params.PdSettings(split_date="1999-01-01", max_train_rows=20_000)
    contest = default_model.fit_default_models(feats, pd_settings, TREES, out)
    assert contest.metrics.count() == 2 and contest.metrics.filter("auc > 0.5").count() == 2
    prepay = prepayment.fit_prepay_models(
        feats, monthly, macro, params.PrepaySettings(split_date="1999-01-01", max_train_rows=5_000), TREES, out)
    assert prepay.best in ("scorecard", "boosted")

    pit = params.PitSettings(min_n=50)
    anchor = default_model.calibrate_point_in_time(
        feats, macro, contest.models["scorecard"], pd_settings, pit, out)
    assert 0 < anchor.ttc_pd < 0.2 and anchor.fit.n > 20
    summary = anchor.summary.first()
    assert abs(summary["mean_calibrated_pd"] - summary["observed_default_rate"]) < 1e-3
    scorer = models.model_scorer(contest.models["scorecard"], anchor.calibrator)

    stats, downturn, _ = risk.severity_stage(
        tables.monthly_with_amounts(spark, SF), master.join(
            tables.master(spark, SF).select("loan_id"), "loan_id"), macro,
        params.LgdSettings(min_obs=5), out)
    base_lgd, down_lgd = stats.first()["mean"], downturn.first()["downturn_lgd"]
    assert 0 < base_lgd <= down_lgd
    risk.exposure_stage(monthly, params.EadSettings(sample_mod=2), out)

    columns = list(pd_settings.features)
    staged = risk.staging_stage(feats, columns, scorer, results=out,
                                migration=("1998-01-01", "1998-06-01"))
    assert staged.count() == master.count()
    scenario = risk.scenario_stage(macro, anchor.fit, anchor.ttc_pd, pit.rho, results=out)
    assert scenario.ordering.first()["ordering_ok"]
    weights = params.ScenarioSettings().weights
    book = risk.loss_stage(staged, monthly, scenario.paths, weights, base_lgd, down_lgd, results=out)
    total = book.summary.filter("stage is null").first()
    assert total["n_loans"] == master.count() and 0 < total["ecl"] < total["ead"]

    checks, grid = oversight.validation_stage(
        book, staged, scenario.paths, scenario.ordering, contest.metrics, out.get("pd_calibration"),
        anchor.ttc_pd, weights, base_lgd, down_lgd, results=out)
    assert checks.count() == 7 and grid.count() == 14
    base = grid.filter("position = 0").first()
    assert abs(base["total_ecl"] / total["ecl"] - 1) < 1e-9
    oversight.monitoring_stage(feats, scorer, pd_settings,
                               replace(params.MonitoringSettings(), min_n=50), out)

    view = results.overview(spark, out.get("ecl_summary"), out.get("stages"),
                            out.get("monitoring_status"), out.get("ecl_run")).first()
    assert view["n_loans"] == master.count() and view["monitoring_status"] in ("RED", "AMBER", "GREEN")
    model = results.model_view(
        spark, out.get("pd_metrics"), out.get("pd_information_values"), out.get("pd_calibration"),
        out.get("pd_roc"), out.get("pd_ks"), out.get("lgd_stats"), out.get("lgd_downturn"),
        out.get("lgd_window"), out.get("lgd_fit"), out.get("ead"), out.get("pit")).first()
    assert model["pd_best_model"] and model["lgd_downturn"] == down_lgd and len(model["pd_iv"]) > 5
    validation = results.validation_view(
        spark, out.get("validation_checks"), out.get("validation_tally"), out.get("pd_metrics"),
        out.get("sensitivity"), out.get("validation_run")).first()
    assert validation["n_error_checks"] == 6 and len(validation["sensitivity"]) == 14


def test_registered_queries_have_reference_sql():
    from workload.catalog import FLAGSHIP, ORACLE, QUERIES

    assert FLAGSHIP in QUERIES and set(ORACLE) == set(QUERIES)
