"""Driver contract: entry, queries and oracle keys."""

import __spark_entry__ as E


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert 0 < len(rows) <= 20
    assert [f.name for f in E.entry(spark).schema.fields] == ["itemId", "plays", "users", "name"]


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


#: Queries that fit models while they are built.
FITTING = {"als_grid_search", "gbt_auc", "rf_auc", "mlp_classifier", "prob_export", "glm_logistic", "glm_poisson", "glm_predict",
           "glm_poisson_means", "glm_logit_rates", "als_fit_predict", "als_score_pairs", "als_pairs_report", "gbt_tuning", "rf_grid",
           "ols_two_normal", "glm_logistic_scores", "glm_poisson_scores", "prob_export_report", "tree_auc_agreement", "mlp_report",
           "als_factor_equations", "als_pairs_scores"}


def test_every_query_builds_on_smoke_data(spark):
    # building (not running) every registered plan catches analysis errors;
    # the corpus operators' queries have tests of their own in tests/llm
    for key, fn in E.queries().items():
        if key in FITTING or key == "pipeline" or key.startswith("op"):
            continue
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.schema is not None, key
