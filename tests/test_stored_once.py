"""What a query reads more than once is computed and stored once."""

SF = "/root/testdata/sf0.001"


def test_samples_are_cut_from_stored_rows(spark):
    """The labelled windows were computed anew for every pass of the cut."""
    from workload.catalog import QUERIES

    for name in ("t6_keep_rare_class", "t7_keep_class_rates"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "o_orderkey" not in plan and "months_on_book" in plan


def test_stability_does_not_store_the_panel_again(spark, monkeypatch):
    """Its callers pass stored columns; it used to write them a second time."""
    from lossloom.operators import monitoring

    panel = spark.range(400).selectExpr("id % 4 as period", "(id * 37 % 101) / 101e0 as pred_pd")
    stored, plain = [], type(panel).checkpoint
    monkeypatch.setattr(type(panel), "checkpoint",
                        lambda df, *a, **k: stored.append(set(df.columns)) or plain(df, *a, **k))
    rows = monitoring.score_stability(panel).collect()
    assert len(rows) == 3 and all(r["psi"] is not None for r in rows)
    assert {"period", "feature", "x"} not in stored


def test_overview_stages_the_loans_once(spark, monkeypatch):
    """Losses and stage counts each computed the features of the whole panel."""
    from workload import common, q_oversight

    calls, plain = [], common.staged

    def counted(*a):
        calls.append(a)
        return plain(*a)

    monkeypatch.setattr(common, "staged", counted)
    monkeypatch.setattr(q_oversight, "staged", counted)
    row = q_oversight.s17(spark, SF).first()
    assert len(calls) == 1 and row["stages"] == 3 and row["n_loans"] > 0
