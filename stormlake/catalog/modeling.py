"""Model-side queries: model table, split, balancers, kNN, metrics, series, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormlake import config as C
from stormlake import oracles as O
from stormlake.catalog import register
from stormlake.catalog.layers import silver_base2_df, silver_disaster_df
from stormlake.functions.scalars import uniform_sql
from stormlake.operators import metrics, sampling, trees
from stormlake.operators.features import model_table
from stormlake.operators.knn import knn
from stormlake.plans import gold
from stormlake.plans.runs import run_table
from stormlake.session import materialize, scratch_path
from stormlake.sources import fixtures as X
from stormlake.sources.series import expand_series

_FEATS = ["precipitation", "snow_depth", "average_temperature", "maximum_temperature",
          "minimum_temperature"]
_SEASONS = [C.SEASON_WINTER, C.SEASON_AUTUMN, C.SEASON_SPRING, C.SEASON_SUMMER]


def gold2(spark, sf):
    return gold.gold_base2(silver_base2_df(spark, sf), silver_disaster_df(spark, sf))


def _model_table_sql() -> str:
    def sc(c):
        sd = f"stddev_pop({c}) OVER w"
        return f"({c} - avg({c}) OVER w) / CASE WHEN {sd} IS NULL OR {sd} = 0 THEN 1.0::DOUBLE ELSE {sd} END AS {c}"
    hot = [f"CASE WHEN season = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"season_{s}\"" for s in _SEASONS]
    hot.append("CASE WHEN season IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS season_nan")
    return f"""
SELECT city_id, disaster_occurred, {', '.join(sc(c) for c in _FEATS)}, {', '.join(hot)},
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day
FROM ({O.gold_base2()}) g WINDOW w AS (PARTITION BY city_id)"""


@register("model_table", _model_table_sql)
def q_model_table(spark, sf):
    """PL10: per-city standard scaling (FN10), season one-hot (FN11), date parts (FN3)."""
    return model_table(gold2(spark, sf), ["city_id"])


_SPLIT_U = uniform_sql("concat_ws('|', city_id, date, eventType)")


@register("train_test_split", lambda: f"""
SELECT city_id, date, eventType, disaster_occurred,
  CASE WHEN rn <= n - ceil(n * {C.TEST_SIZE}::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY disaster_occurred
                                   ORDER BY u, city_id, date NULLS FIRST, eventType NULLS FIRST) AS rn,
             count(*) OVER (PARTITION BY disaster_occurred) AS n
      FROM (SELECT city_id, date, eventType, disaster_occurred, {_SPLIT_U} AS u
            FROM ({O.gold_base2()}) g) a) b""")
def q_train_test_split(spark, sf):
    """SM1: stratified 70/30 split of the gold rows, seeded."""
    g = gold2(spark, sf).select("city_id", "date", "eventType", "disaster_occurred")
    return sampling.stratified_split(g, "disaster_occurred", ["city_id", "date", "eventType"])


def _u(key: str) -> str:
    return uniform_sql(key)


@register("random_under_sample", lambda: f"""
WITH v AS ({X.VECTORS_SQL}),
m AS (SELECT min(n) AS n_min FROM (SELECT count(*) AS n FROM v GROUP BY disaster_occurred) c)
SELECT id, features, disaster_occurred FROM (
  SELECT *, row_number() OVER (PARTITION BY disaster_occurred ORDER BY {_u('id')}, id) AS rn FROM v) x, m
WHERE rn <= m.n_min""")
def q_random_under_sample(spark, sf):
    """SM4: every class cut to the minority size."""
    return sampling.random_under_sample(X.vectors(spark, sf), "disaster_occurred", ["id"])


def _dist2(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), "
            f"lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])), lambda p, q: p + q)")


def _knn_sql(q: str, p: str, k: int, idc: str = "id", extra: str = "") -> str:
    return f"""SELECT qid, nid, dist2, rank{extra} FROM (
  SELECT a.{idc} AS qid, b.{idc} AS nid, {_dist2('a.features', 'b.features')} AS dist2,
         row_number() OVER (PARTITION BY a.{idc} ORDER BY {_dist2('a.features', 'b.features')}, b.{idc}) AS rank
         {', b.disaster_occurred' if extra else ''}
  FROM ({q}) a JOIN ({p}) b ON a.{idc} <> b.{idc}) x WHERE rank <= {k}"""


@register("knn_vectors", lambda: _knn_sql(X.VECTORS_SQL, X.VECTORS_SQL, C.SMOTE_K))
def q_knn_vectors(spark, sf):
    """SM6: exact 5 nearest neighbours of every embedding row."""
    v = X.vectors(spark, sf)
    return knn(v, v, C.SMOTE_K)


def _synth_sql(base: str, quota: str, nn: str, mset: str, mino: str) -> str:
    """Generation shared by SMOTE and ADASYN (mirror of sampling._synthesise)."""
    return f"""
have AS (SELECT qid, count(*) AS kk FROM {nn} GROUP BY qid),
gen AS (SELECT b.id AS qid, b.features AS x, t.seq FROM {base} b, generate_series(1, b.{quota}) t(seq)
        WHERE b.{quota} > 0),
g2 AS (SELECT gen.*, CAST(floor({_u("concat_ws('|', gen.qid, gen.seq, 'nn')")} * have.kk) + 1 AS INTEGER) AS rank,
              {_u("concat_ws('|', gen.qid, gen.seq, 'gap')")} AS gap
       FROM gen JOIN have ON gen.qid = have.qid),
g3 AS (SELECT g2.*, {mset}.features AS xn FROM g2 JOIN {nn} n ON g2.qid = n.qid AND g2.rank = n.rank
       JOIN {mset} ON {mset}.id = n.nid)
SELECT 's:' || CAST(qid AS VARCHAR) || ':' || CAST(seq AS VARCHAR) AS sample_id,
       list_transform(range(1, len(x) + 1), lambda i: x[i] + gap * (xn[i] - x[i])) AS features,
       {mino} AS disaster_occurred FROM g3
UNION ALL SELECT 'o:' || CAST(id AS VARCHAR), features, disaster_occurred FROM v"""


def _smote_sql() -> str:
    return f"""
WITH v AS ({X.VECTORS_SQL}),
cnt AS (SELECT disaster_occurred AS lbl, count(*) AS n FROM v GROUP BY 1),
mm AS (SELECT (SELECT lbl FROM cnt ORDER BY n, CAST(lbl AS VARCHAR) LIMIT 1) AS mino,
              min(n) AS n_min, max(n) AS n_maj FROM cnt),
M AS (SELECT v.* FROM v, mm WHERE v.disaster_occurred = mm.mino),
nn AS ({_knn_sql('SELECT * FROM M', 'SELECT * FROM M', C.SMOTE_K)}),
base AS (SELECT M.*, (mm.n_maj - mm.n_min) // mm.n_min
                 + CASE WHEN row_number() OVER (ORDER BY {_u("concat_ws('|', M.id, 'base')")}, M.id)
                             <= (mm.n_maj - mm.n_min) % mm.n_min THEN 1 ELSE 0 END AS quota
         FROM M, mm),
{_synth_sql('base', 'quota', 'nn', 'M', '(SELECT mino FROM mm)')}"""


@register("smote_vectors", _smote_sql)
def q_smote_vectors(spark, sf):
    """SM2: SMOTE on the embedding rows (minority = disaster rows)."""
    return sampling.smote(X.vectors(spark, sf), "disaster_occurred")


def _adasyn_sql() -> str:
    k = C.ADASYN_K
    return f"""
WITH v AS ({X.VECTORS_SQL}),
cnt AS (SELECT disaster_occurred AS lbl, count(*) AS n FROM v GROUP BY 1),
mm AS (SELECT (SELECT lbl FROM cnt ORDER BY n, CAST(lbl AS VARCHAR) LIMIT 1) AS mino,
              min(n) AS n_min, max(n) AS n_maj FROM cnt),
M AS (SELECT v.* FROM v, mm WHERE v.disaster_occurred = mm.mino),
around AS ({_knn_sql('SELECT * FROM M', 'SELECT * FROM v', k, extra=', disaster_occurred')}),
ratio AS (SELECT qid, sum(CASE WHEN disaster_occurred <> (SELECT mino FROM mm) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
                      / {float(k)}::DOUBLE AS r FROM around GROUP BY qid),
tot AS (SELECT sum(r) AS rs FROM ratio),
base AS (SELECT M.*, CAST(CASE WHEN tot.rs > 0 THEN round_even(ratio.r / tot.rs * CAST(mm.n_maj - mm.n_min AS DOUBLE), 0)
                          ELSE 0.0 END AS INTEGER) AS quota
         FROM M JOIN ratio ON M.id = ratio.qid, tot, mm),
nn AS ({_knn_sql('SELECT * FROM M', 'SELECT * FROM M', k)}),
{_synth_sql('base', 'quota', 'nn', 'M', '(SELECT mino FROM mm)')}"""


@register("adasyn_vectors", _adasyn_sql)
def q_adasyn_vectors(spark, sf):
    """SM3: ADASYN on the embedding rows."""
    return sampling.adasyn(X.vectors(spark, sf), "disaster_occurred")


def _smote_enn_sql() -> str:
    s = _smote_sql()
    return f"""
WITH s AS ({s}),
nn AS (SELECT qid, nid, rank, disaster_occurred FROM (
  SELECT a.sample_id AS qid, b.sample_id AS nid, b.disaster_occurred,
         row_number() OVER (PARTITION BY a.sample_id ORDER BY {_dist2('a.features', 'b.features')}, b.sample_id) AS rank
  FROM s a JOIN s b ON a.sample_id <> b.sample_id) x WHERE rank <= {C.ENN_K}),
keep AS (SELECT nn.qid FROM nn JOIN s ON s.sample_id = nn.qid GROUP BY nn.qid
         HAVING bool_and(nn.disaster_occurred = s.disaster_occurred))
SELECT s.* FROM s WHERE sample_id IN (SELECT qid FROM keep)"""


@register("smote_enn_vectors", _smote_enn_sql)
def q_smote_enn_vectors(spark, sf):
    """SM5: SMOTE then edited nearest neighbours (k=3, all classes)."""
    return sampling.smote_enn(X.vectors(spark, sf), "disaster_occurred")


@register("classification_metrics", lambda: f"""
SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
       CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score
FROM (SELECT CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
             CAST(sum(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
             CAST(sum(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn
      FROM ({X.SCORED_SQL}) s) c""")
def q_classification_metrics(spark, sf):
    """AG12: precision, recall and F1 of class 1."""
    return metrics.binary_metrics(X.scored(spark, sf))


@register("roc_auc", lambda: f"""
WITH per AS (SELECT score, count(*) AS n, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos
             FROM ({X.SCORED_SQL}) s WHERE score IS NOT NULL GROUP BY score),
r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM per),
t AS (SELECT sum(pos * (CAST(below AS DOUBLE) + (n + 1) / 2.0::DOUBLE)) AS rsum, sum(pos) AS np,
             sum(n) - sum(pos) AS nn FROM r)
SELECT CASE WHEN np > 0 AND nn > 0 THEN (rsum - np * (np + 1) / 2.0::DOUBLE) / CAST(np * nn AS DOUBLE) END
       AS auc_roc FROM t""")
def q_roc_auc(spark, sf):
    """AG13: exact ROC AUC (ties at half)."""
    return metrics.roc_auc(X.scored(spark, sf))


@register("confusion_matrix", lambda: f"""
SELECT a.actual, a.predicted, coalesce(c.count, 0) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) a(actual, predicted)
LEFT JOIN (SELECT label, prediction, count(*) AS count FROM ({X.SCORED_SQL}) s GROUP BY ALL) c
  ON a.actual = c.label AND a.predicted = c.prediction""")
def q_confusion_matrix(spark, sf):
    """AG14: the 2 x 2 matrix, absent cells 0."""
    return metrics.confusion_matrix(X.scored(spark, sf))


@register("series_expand", lambda: f"""
SELECT e.vec_id AS response_id, e.city_id, e.start + to_hours(i - 1) AS date,
       e.vals[i] AS relative_humidity_2m, list_reverse(e.vals)[i] AS pressure_msl
FROM (SELECT vec_id, CAST(vec_id % {X.N_CITIES} AS INTEGER) AS city_id,
             TIMESTAMP '1973-01-01' + to_days(vec_id) AS start, CAST(embedding AS DOUBLE[]) AS vals
      FROM embeddings) e, generate_series(1, len(e.vals)) t(i)""")
def q_series_expand(spark, sf):
    """SC12: API-shaped responses -> one row per hour."""
    r = X.api_responses(spark, sf)
    return expand_series(r, ["relative_humidity_2m", "pressure_msl"], ["response_id", "city_id"])


@register("run_comparison", lambda: """
SELECT CAST(s_suppkey AS VARCHAR) AS run_id, 'FINISHED' AS status, s_suppkey * 1000 AS start_time,
  s_suppkey * 1000 + s_nationkey AS end_time,
  'model_' || CAST(s_suppkey % 3 AS VARCHAR) AS model, CAST(s_nationkey % 7 + 2 AS VARCHAR) AS max_depth,
  s_acctbal / 10000.0::DOUBLE AS recall,
  CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal / 20000.0::DOUBLE END AS f1_score,
  CASE WHEN s_suppkey % 2 <> 0 THEN s_acctbal / 30000.0::DOUBLE END AS auc_roc
FROM supplier WHERE s_nationkey % 3 + 1 = 1""")
def q_run_comparison(spark, sf):
    """RN2 / PL12 / ST5: one experiment's runs, params and metrics as columns."""
    return run_table(X.runs(spark, sf), "DataBase_base_1")


# --------------------------------------------------------------------------
# ML6 / ML1-ML5 / RN1
# --------------------------------------------------------------------------
_MT_FEATS = _FEATS + [f"season_{s}" for s in sorted(_SEASONS)] + ["season_nan", "year", "month", "day"]


def _feature_scores_sql(k: int = 5) -> str:
    long = " UNION ALL ".join(
        f"SELECT city_id, disaster_occurred AS y, '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS x FROM t"
        for c in _MT_FEATS)
    return f"""
WITH t AS ({_model_table_sql()}),
long AS ({long}),
per AS (SELECT city_id, feature, y, count(*) AS n, avg(x) AS mu, var_pop(x) AS v
        FROM long WHERE x IS NOT NULL GROUP BY city_id, feature, y),
tot AS (SELECT city_id, feature, sum(n) AS N, sum(n * mu) / sum(n) AS grand, count(*) AS G
        FROM per GROUP BY city_id, feature),
ss AS (SELECT p.city_id, p.feature, t.N, t.G,
              sum(p.n * (p.mu - t.grand) * (p.mu - t.grand)) AS ssb, sum(p.n * p.v) AS ssw
       FROM per p JOIN tot t ON p.city_id = t.city_id AND p.feature = t.feature
       GROUP BY p.city_id, p.feature, t.N, t.G),
f AS (SELECT city_id, feature, CASE WHEN G > 1 AND N > G AND ssw > 0
                                    THEN (ssb / (G - 1)) / (ssw / (N - G)) END AS f_score FROM ss)
SELECT city_id, feature, f_score, rank, rank <= {k} AS selected FROM (
  SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY f_score DESC NULLS LAST, feature) AS rank
  FROM f) r"""


@register("feature_scores", _feature_scores_sql)
def q_feature_scores(spark, sf):
    """ML6: ANOVA F of every model-table feature against the label, per city; 5 best."""
    from stormlake.plans.training import anova_f_scores
    t = model_table(gold2(spark, sf), ["city_id"])
    return anova_f_scores(t, _MT_FEATS, "disaster_occurred", ["city_id"], k=5)


@register("decision_tree_runs")
def q_decision_tree_runs(spark, sf):
    """ML1 + ML4 + ML5 + RN1 (rows-only check): a decision tree per base_2
    training city -- split, 50 trials searched for recall, refit, test
    metrics -- one run row each."""
    from stormlake.plans.training import train_matrix
    out = train_matrix(spark, _city_tables(spark, {"base_2": gold2(spark, sf)}), ["decision_tree"], [None])
    return out.select("experiment", "status", F.col("params")["city"].alias("city"),
                      F.col("params")["max_depth"].alias("max_depth"),
                      F.col("metrics")["recall"].alias("recall"),
                      F.col("metrics")["auc_roc"].alias("auc_roc"))


def _city_tables(spark, golds):
    """(source, city) -> model table of the cities that the source trains on."""
    tables = {}
    for source, gold_rows in golds.items():
        t = materialize(model_table(gold_rows, ["city_id"]))
        for city in C.TRAINING_CITIES[source]:
            tables[source, city] = t.where(F.col("city_id") == C.CITIES.index(city))
    return tables


#: Boosted trees of the matrix query: few, as each is some jobs.
_FEW = {m: {"n_estimators": ("choice", [3])} for m in ("boosted_trees_a", "boosted_trees_b")}


def _matrix_sql() -> str:
    golds = " UNION ALL ".join(f"SELECT '{s}' AS base, city_id, disaster_occurred AS y FROM ({g()}) g{i}" for i, (s, g) in enumerate(
        {"base_1": O.gold_base1, "base_2": O.gold_base2, "base_3": O.gold_base3}.items()))
    pairs = ", ".join(f"('{s}', '{c}', {C.CITIES.index(c)})" for s, cities in C.TRAINING_CITIES.items() for c in cities)
    ways = ", ".join(f"('{b or 'None'}')" for b in C.BALANCING_METHODS)
    return f"""
WITH g AS ({golds}),
c AS (SELECT base, city_id, y, count(*) AS n, CAST(ceil(count(*) * {C.TEST_SIZE}::DOUBLE) AS BIGINT) AS test FROM g GROUP BY ALL),
s AS (SELECT base, city_id, sum(n - test) AS train, min(n - test) AS least, max(n - test) AS most, sum(test) AS n_test,
        sum(test) FILTER (WHERE y = 1) AS pos_test, sum(n - test) FILTER (WHERE y = 1) AS pos FROM c GROUP BY ALL)
SELECT p.base, p.city, w.balancing, m.model, 'FINISHED' AS status,
  CASE w.balancing WHEN 'None' THEN train WHEN 'SMOTE' THEN 2 * most WHEN 'RandomUnderSampler' THEN 2 * least END AS n_train,
  CASE w.balancing WHEN 'None' THEN pos WHEN 'SMOTE' THEN most WHEN 'RandomUnderSampler' THEN least END AS pos_train,
  n_test, pos_test, n_test AS n_predicted, true AS same_recall, true AS same_cells, true AS within_ranges
FROM (VALUES {pairs}) p(base, city, city_id) JOIN s USING (base, city_id),
  (VALUES {ways}) w(balancing), (VALUES ('decision_tree'), ('boosted_trees_a'), ('boosted_trees_b')) m(model)"""


@register("model_matrix", _matrix_sql)
def q_model_matrix(spark, sf):
    """PL11: nine (source, city) tables x five balancers x three families, two trials each, in the
    same jobs.  Exact parts: sizes and class counts of the splits and of balanced train, stored predictions,
    recall and confusion counts worked out again from them, parameters within their ranges."""
    from stormlake.catalog.layers import (silver_base1_daily_df, silver_base1_hourly_df, silver_base3_daily_df,
                                          silver_base3_hourly_df)
    from stormlake.plans.training import MODELS, train_matrix
    dis = materialize(silver_disaster_df(spark, sf))
    golds = {"base_1": gold.gold_base1(silver_base1_daily_df(spark, sf), silver_base1_hourly_df(spark, sf), dis),
             "base_2": gold.gold_base2(silver_base2_df(spark, sf), dis),
             "base_3": gold.gold_base3(silver_base3_daily_df(spark, sf), silver_base3_hourly_df(spark, sf), dis)}
    kept = scratch_path(spark, "matrix")
    runs = train_matrix(spark, _city_tables(spark, golds), n_trials=2, spaces=_FEW, models_path=kept)
    again = spark.read.parquet(f"{kept}/predictions").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_predicted"), *[F.count(F.when((F.col("label") == a) & (F.col("prediction") == p), 1)).alias(f"c{a}{p}")
                                                  for a in (0, 1) for p in (0, 1)])
    m, q = (lambda c: F.col("metrics")[c]), (lambda c: F.col("params")[c])
    whole = lambda c: m(c).cast("long").alias(c)
    recall = F.when(F.col("c11") + F.col("c10") > 0, F.col("c11") / (F.col("c11") + F.col("c10"))).otherwise(F.lit(0.0))
    within = F.lit(True)
    for model, (space, _) in MODELS.items():
        for name, (kind, *what) in {**space, **_FEW.get(model, {})}.items():
            ok = q(name).isin([str(v) for v in what[0]]) if kind == "choice" else q(name).cast("double").between(*what)
            within = within & ((q("model") != model) | F.coalesce(ok, F.lit(False)))
    exact = q("balancing_method").isin("ADASYN", "SMOTEENN")  # their sizes depend on neighbours
    return runs.join(again, "run_id", "left").select(
        q("base").alias("base"), q("city").alias("city"), q("balancing_method").alias("balancing"), q("model").alias("model"), "status",
        *[F.when(~exact, m(c).cast("long")).alias(c) for c in ("n_train", "pos_train")], whole("n_test"), whole("pos_test"), "n_predicted",
        (m("recall") == recall).alias("same_recall"),
        ((m("count_00") == F.col("c00")) & (m("count_01") == F.col("c01")) & (m("count_10") == F.col("c10")) & (m("count_11") == F.col("c11"))).alias("same_cells"),
        within.alias("within_ranges"))


def _pinned(spark, sf, run):
    """Scores of one fitted run on the embedding vectors, every row binned and scored."""
    v = X.vectors(spark, sf).select(F.lit(0).alias("dataset"), F.lit(0).alias("part"), F.col("id").cast("long").alias("rid"),
                                    F.col("disaster_occurred").alias("label"), "features")
    rows = materialize(trees.binned(v, trees.bin_edges(v)))
    return trees.predictions(rows, {0: trees.fit(rows, [run])[0]}, [0]).select("rid", "label", "score", "prediction")


@register("decision_tree_scores")
def q_decision_tree_scores(spark, sf):
    """ML1 (rows-only check; equal to a plain tree in tests): one tree with min split, min leaf and a feature share per node."""
    return _pinned(spark, sf, trees.Run(0, "tree", depth=40, min_split=4, min_leaf=2, max_features="sqrt", seed=C.SEED))


@register("boosted_a_scores")
def q_boosted_a_scores(spark, sf):
    """ML2 (rows-only check; equal to a plain booster in tests): rows and columns drawn per tree, pinned seed."""
    return _pinned(spark, sf, trees.Run(0, "depth", trees=6, depth=4, rate=0.3, row_share=0.8, col_share=0.7, l2=1.0, min_hessian=1.0, seed=C.SEED))


@register("boosted_b_scores")
def q_boosted_b_scores(spark, sf):
    """ML3 (rows-only check; equal to a plain booster in tests): best-first growth, leaf budget, least gain."""
    return _pinned(spark, sf, trees.Run(0, "leaf", trees=6, leaves=20, rate=0.1, min_leaf=5, min_hessian=1e-3, min_gain=0.01, prior=True, seed=C.SEED))
