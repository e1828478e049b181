from pyspark.sql import functions as F

from stormlake.operators.features import model_table
from stormlake.plans.gold import gold_base2
from stormlake.plans.runs import run_table
from stormlake.plans.silver import silver_base2, silver_disaster
from stormlake.plans.search import Study
from stormlake.plans.training import anova_f_scores, train_matrix, train_one
from stormlake.session import scratch_path
from stormlake.sources import fixtures as X
from tests.conftest import SF_SMALL


def _table(spark):
    g = gold_base2(silver_base2(X.raw_base2_daily(spark, SF_SMALL)),
                   silver_disaster(X.storm_events_raw(spark, SF_SMALL)))
    return model_table(g, ["city_id"]).checkpoint(eager=True)


def test_train_one_with_smote_and_run_table(spark):
    t = _table(spark).where(F.col("city_id") == 0)
    path = scratch_path(spark, "models")
    run = train_one(spark, t, "decision_tree", "base_2", "dallas", "SMOTE", n_trials=2, models_path=path)
    r = run.first()
    assert r.status == "FINISHED" and r.params["balancing_method"] == "SMOTE"
    assert 0.0 <= r.metrics["recall"] <= 1.0 and "training_time" in r.metrics
    assert 2 <= int(r.params["max_depth"]) <= 50 and 2 <= int(r.params["min_samples_split"]) <= 10
    pred = spark.read.parquet(f"{path}/predictions").collect()
    positives = [p for p in pred if p.label == 1]
    assert len(pred) == r.metrics["n_test"] and len(positives) == r.metrics["pos_test"]
    assert r.metrics["recall"] == sum(p.prediction for p in positives) / len(positives)
    nodes = spark.read.parquet(f"{path}/models").where(F.col("run_id") == r.run_id).collect()
    assert {n.feature for n in nodes} - {None} <= set(t.columns) and any(n.feature is None for n in nodes)
    flat = run_table(run, "DataBase_base_2").first()
    assert flat["balancing_method"] == "SMOTE" and flat["recall"] == r.metrics["recall"]


def test_feature_scores_rank(spark):
    t = _table(spark)
    feats = ["precipitation", "snow_depth", "average_temperature", "year"]
    out = anova_f_scores(t, feats, group_cols=["city_id"], k=2).where("city_id = 0").collect()
    assert sorted(r["rank"] for r in out) == [1, 2, 3, 4]
    assert sum(r.selected for r in out) == 2


FEW = {m: {"n_estimators": ("choice", [3])} for m in ("boosted_trees_a", "boosted_trees_b")}


def test_matrix_in_one_job_equals_its_runs_alone(spark):
    t = _table(spark)
    tables = {("base_2", "albuquerque"): t.where(F.col("city_id") == 6), ("base_2", "dallas"): t.where(F.col("city_id") == 0),
              ("base_2", "nobody"): t.where((F.col("city_id") == 0) & (F.col("disaster_occurred") == 0))}
    rows = train_matrix(spark, tables, balancers=[None, "RandomUnderSampler", "SMOTE"], n_trials=3, spaces=FEW, batch=2).collect()
    assert len(rows) == 27
    by = {(r.params["city"], r.params["balancing_method"], r.params["model"]): r for r in rows}
    assert {k for k, r in by.items() if r.status == "FAILED"} == {("nobody", "SMOTE", m) for m in (
        "decision_tree", "boosted_trees_a", "boosted_trees_b")}
    assert "two classes" in by["nobody", "SMOTE", "decision_tree"].params["error"]
    for model in ("boosted_trees_a", "boosted_trees_b", "decision_tree"):
        alone = train_one(spark, tables["base_2", "albuquerque"], model, "base_2", "albuquerque", "RandomUnderSampler",
                          n_trials=3, spaces=FEW, batch=2).first()
        together = by["albuquerque", "RandomUnderSampler", model]
        assert alone.params == together.params
        assert {k: v for k, v in alone.metrics.items() if k != "training_time"} == {
            k: v for k, v in together.metrics.items() if k != "training_time"}


def test_search_finds_a_known_optimum():
    space = {"x": ("float", -5.0, 5.0), "n": ("int", 0, 30), "c": ("choice", ["a", "b", None])}

    def run(seed):
        study = Study(space, seed)
        for _ in range(12):
            for p in study.suggest(5):
                assert -5 <= p["x"] <= 5 and 0 <= p["n"] <= 30 and isinstance(p["n"], int) and p["c"] in ("a", "b", None)
                study.tell(p, -(p["x"] - 2) ** 2 - ((p["n"] - 21) / 5) ** 2 + (p["c"] is None))
        return study

    studies = [run(s) for s in range(8)]
    assert run(3).trials == studies[3].trials
    late = [s for st in studies for _, s in st.trials[30:]]
    early = [s for st in studies for _, s in st.trials[:10]]
    assert sorted(late)[len(late) // 2] > sorted(early)[len(early) // 2] + 5
    assert sum(st.best()[0]["c"] is None for st in studies) >= 6 and sorted(st.best()[1] for st in studies)[4] > 0.5
