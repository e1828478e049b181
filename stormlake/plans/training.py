"""Model training (ML1-ML6, RN1, PL11): many (source, city) tables, balancers and models in one job.

Each table is split (SM1) and its train part balanced (SM2-SM5); a stratified part of *train* is set
apart for the search (the source scored its trials on the test rows; that is deliberately not
copied).  All data sets are binned into one table, and all studies (data set x model) go on
together: a batch of trials of every study is grown by the same scans
(``operators.trees``), scored by recall of class 1, and told to its search (``plans.search``).  The best
parameters of each study are fitted again on all of train, all at once, and scored on
test (AG12-AG14); each study gives one run row (RN1).

The families, with the parameters that the source searches:

* decision tree: depth, min split, min leaf, feature share per node;
* boosted trees A: trees, depth, rate, row share and column share per tree;
* boosted trees B: leaf budget, depth (none if not above 0), rate, trees, least gain.
"""

from __future__ import annotations

import time
import traceback
from multiprocessing.pool import ThreadPool

from pyspark.errors import PySparkException
from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.operators import metrics, sampling, trees
from stormlake.operators.trees import Run
from stormlake.plans.runs import RUN_SCHEMA, run_rows
from stormlake.plans.search import Space, Study
from stormlake.session import materialize

LABEL = "disaster_occurred"
FIT, CHECK, TEST = 0, 1, 2
VALIDATION = 0.2
BATCH = 10


# --------------------------------------------------------------------------
# families and their search spaces; the ranges are fixed values
# --------------------------------------------------------------------------
TREE_SPACE: Space = {
    "max_depth": ("int", 2, 50), "min_samples_split": ("int", 2, 10), "min_samples_leaf": ("int", 1, 10),
    "max_features": ("choice", [None, "sqrt", "log2"])}
BOOST_A_SPACE: Space = {
    "n_estimators": ("choice", [100, 200, 300]), "max_depth": ("int", 3, 10), "learning_rate": ("float", 0.01, 0.3),
    "subsample": ("float", 0.3, 1.0), "colsample_bytree": ("float", 0.5, 1.0)}
BOOST_B_SPACE: Space = {
    "num_leaves": ("int", 20, 100), "max_depth": ("int", -1, 15), "learning_rate": ("float", 0.01, 0.3),
    "n_estimators": ("choice", [100, 200, 500]), "min_gain_to_split": ("float", 0.0, 0.1)}


def _tree(dataset: int, parts: tuple[int, ...], p: dict, seed: int) -> Run:
    return Run(dataset, "tree", parts, depth=p["max_depth"], min_split=p["min_samples_split"], min_leaf=p["min_samples_leaf"],
               max_features=p["max_features"], seed=seed)


def _boost_a(dataset: int, parts: tuple[int, ...], p: dict, seed: int) -> Run:
    return Run(dataset, "depth", parts, trees=p["n_estimators"], depth=p["max_depth"], rate=p["learning_rate"],
               row_share=p["subsample"], col_share=p["colsample_bytree"], l2=1.0, min_hessian=1.0, seed=seed)


def _boost_b(dataset: int, parts: tuple[int, ...], p: dict, seed: int) -> Run:
    return Run(dataset, "leaf", parts, trees=p["n_estimators"], depth=p["max_depth"] if p["max_depth"] > 0 else -1,
               rate=p["learning_rate"], leaves=p["num_leaves"], min_leaf=20, min_hessian=1e-3, min_gain=p["min_gain_to_split"],
               prior=True, seed=seed)


MODELS = {"decision_tree": (TREE_SPACE, _tree), "boosted_trees_a": (BOOST_A_SPACE, _boost_a),
          "boosted_trees_b": (BOOST_B_SPACE, _boost_b)}


# --------------------------------------------------------------------------
# features and balancing
# --------------------------------------------------------------------------
def feature_columns(table: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns that have a value in some row (a column without any has no mean to fill it with)."""
    ex = set(exclude or []) | {LABEL}
    cols = [c for c, t in table.dtypes if c not in ex and t in ("double", "int", "bigint", "float")]
    some = table.agg(*[F.count(c).alias(c) for c in cols]).first() if cols else {}
    return [c for c in cols if some[c] > 0]


def _assemble(train: DataFrame, test: DataFrame, feats: list[str]) -> tuple[DataFrame, DataFrame]:
    """Features as an array, nulls filled with the mean of train."""
    cast = {c: F.col(c).cast("double") for c in feats}
    train, test = train.withColumns(cast), test.withColumns(cast)
    imp = Imputer(inputCols=feats, outputCols=feats, strategy="mean").fit(train)
    return tuple(imp.transform(d).select(F.array(*feats).alias("features"), F.col(LABEL).cast("int").alias(LABEL))
                 for d in (train, test))


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Add an id made of the row's values and, for rows equal in all of them, their number among these."""
    h = rows.withColumn("__h", F.xxhash64("features", LABEL))
    w = Window.partitionBy("__h").orderBy(LABEL)
    return h.withColumn(name, F.xxhash64("__h", F.row_number().over(w))).drop("__h")


def _balance(rows: DataFrame, method: str | None, seed: int) -> DataFrame:
    """SM2-SM5 on rows (id, features, label)."""
    if method is None:
        return rows
    if method == "RandomUnderSampler":
        return sampling.random_under_sample(rows, LABEL, ["id"], seed)
    how = {"SMOTE": sampling.smote, "ADASYN": sampling.adasyn, "SMOTEENN": sampling.smote_enn}
    if method not in how:
        raise ValueError(method)
    return how[method](rows, LABEL, seed=seed)


def _parts(table: DataFrame, id_cols: list[str], seed: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test) of one table as rows (id, features, label), and the features' names."""
    feats = feature_columns(table, exclude=["city_id"])
    split = sampling.stratified_split(table, LABEL, id_cols, seed=seed)
    train, test = _assemble(split.where(F.col("split") == "train"), split.where(F.col("split") == "test"), feats)
    return materialize(_numbered(train, "id")), materialize(_numbered(test, "id")), feats


def _dataset(number: int, train: DataFrame, test: DataFrame, method: str | None, seed: int) -> DataFrame:
    """One data set's rows (dataset, part, rid, label, features): balanced train, part of it set apart, and test."""
    balanced = _numbered(_balance(train, method, seed).select("features", F.col(LABEL).cast("int").alias(LABEL)), "rid")
    parted = sampling.stratified_split(balanced, LABEL, ["rid"], test_size=VALIDATION, seed=seed)
    part = F.when(F.col("split") == "train", F.lit(FIT)).otherwise(F.lit(CHECK))
    cols = ["rid", F.col(LABEL).alias("label"), "features"]
    rows = parted.select(part.alias("part"), *cols).unionByName(
        test.select(F.lit(TEST).alias("part"), F.col("id").alias("rid"), *cols[1:]))
    return materialize(rows.select(F.lit(number).alias("dataset"), "part", *["rid", "label", "features"]))


# --------------------------------------------------------------------------
# search and scores, all studies at once
# --------------------------------------------------------------------------
def _recalls(rows: DataFrame, models: list[trees.Model], part: int) -> dict[int, float]:
    """Recall of class 1 of each model on a part of its data set (0 where that has no positives)."""
    pred = trees.predictions(rows, dict(enumerate(models)), [part])
    return {r["run"]: r["recall"] for r in metrics.binary_metrics(pred, group_cols=["run"]).collect()}  # a row a model


def search(rows: DataFrame, studies: dict[int, tuple[Study, int, str]], n_trials: int, batch: int = BATCH, seed: int = C.SEED) -> None:
    """ML4: studies: key -> (study, data set, model); a batch of trials of every study at a time."""
    done = 0
    while done < n_trials:
        n = min(batch, n_trials - done)
        asked = [(key, p) for key, (study, _, _) in studies.items() for p in study.suggest(n)]
        models = trees.fit(rows, [MODELS[studies[key][2]][1](studies[key][1], (FIT,), p, seed) for key, p in asked])
        recall = _recalls(rows, models, CHECK)
        for i, (key, p) in enumerate(asked):
            studies[key][0].tell(p, recall.get(i, 0.0))
        done += n


def _test_metrics(pred: DataFrame) -> dict[int, dict]:
    """AG12-AG14 of every run: a row a run."""
    m = metrics.binary_metrics(pred, group_cols=["run"]).join(metrics.roc_auc(pred, group_cols=["run"]), "run", "left")
    cells = metrics.confusion_matrix(pred, group_cols=["run"]).groupBy("run").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("count_"), F.col("actual").cast("string"), F.col("predicted").cast("string")),
                                                   F.col("count")))).alias("cells"))
    rows = m.join(cells, "run", "left").collect()
    return {r["run"]: {c: r[c] for c in ("precision", "recall", "f1_score", "auc_roc")} | (r["cells"] or {}) for r in rows}


def model_table_rows(models: dict[str, trees.Model], names: dict[int, list[str]], edges: dict[int, list]) -> list[tuple]:
    """Fitted trees as rows: run_id, tree, node, feature, threshold (<= goes left), left, right, value, base."""
    out = []
    for run_id, m in models.items():
        for no, t in enumerate(m.trees):
            for node, f in enumerate(t.feature):
                cuts = edges[m.run.dataset][f] if f >= 0 else ()
                out.append((run_id, no, node, names[m.run.dataset][f] if f >= 0 else None,
                            float(cuts[t.cut[node]]) if f >= 0 and t.cut[node] < len(cuts) else None,
                            t.left[node], t.right[node], float(t.value[node]), float(m.base)))
    return out


MODEL_SCHEMA = ("run_id string, tree int, node int, feature string, threshold double, left int, right int, "
                "value double, base double")


def train_matrix(spark: SparkSession, tables: dict[tuple[str, str], DataFrame], models: list[str] | None = None,
                 balancers: list[str | None] | None = None, n_trials: int = C.N_TRIALS, log=None,
                 models_path: str | None = None, seed: int = C.SEED, id_cols: list[str] | None = None,
                 spaces: dict[str, Space] | None = None, batch: int = BATCH, parallelism: int = 4) -> DataFrame:
    """PL11: every (source, city) table x balancer x model; one run row each.

    ``log`` gets the rows of all runs; runs whose data cannot be split or balanced are recorded with their
    error, and the others go on.  ``models_path``: fitted trees (``models``), as a table by run, and test predictions
    (``predictions``).  ``spaces`` replaces search ranges of a model by name."""
    t0 = time.time()
    models = models or list(MODELS)
    balancers = C.BALANCING_METHODS if balancers is None else balancers
    id_cols = id_cols or ["year", "month", "day"]
    jobs = [(pair, b) for pair in tables for b in balancers]
    failed: dict[tuple, str] = {}

    def prepare(pair):
        try:
            return _parts(tables[pair], id_cols, seed)
        except (ValueError, PySparkException):
            return traceback.format_exc(limit=0)

    def build(i):
        (pair, b), got = jobs[i], parts[jobs[i][0]]
        try:
            if isinstance(got, str):
                return got
            return _dataset(i, got[0], got[1], b, seed)
        except (ValueError, PySparkException):
            return traceback.format_exc(limit=0)

    with ThreadPool(parallelism) as pool:  # Spark runs the small jobs of several tables side by side
        parts = dict(zip(tables, pool.map(prepare, tables), strict=True))
        built = pool.map(build, range(len(jobs)))
    good = {i: d for i, d in enumerate(built) if not isinstance(d, str)}
    failed = {i: d for i, d in enumerate(built) if isinstance(d, str)}
    found: dict[tuple[int, str], tuple] = {}
    if good:
        every = list(good.values())
        rows = every[0]
        for d in every[1:]:
            rows = rows.unionByName(d)
        edges = trees.bin_edges(rows, (FIT, CHECK))
        rows = materialize(trees.binned(rows, edges))
        sizes = {(r["dataset"], r["part"]): (r["n"], r["pos"]) for r in rows.groupBy("dataset", "part").agg(
            F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).collect()}  # a row a part
        space = {m: {**MODELS[m][0], **(spaces or {}).get(m, {})} for m in models}
        studies = {(i, m): (Study(space[m], seed), i, m) for i in good for m in models}
        search(rows, studies, n_trials, batch, seed)
        best = {key: study.best() for key, (study, _, _) in studies.items()}
        fitted = dict(zip(best, trees.fit(rows, [MODELS[m][1](i, (FIT, CHECK), p, seed) for (i, m), (p, _) in best.items()]), strict=True))
        pred = materialize(trees.predictions(rows, dict(enumerate(fitted.values())), [TEST]))
        scored = _test_metrics(pred)
        found = {key: (best[key][0], scored.get(n, {}), n) for n, key in enumerate(fitted)}

    out, ids = [], {}
    for i, (pair, b) in enumerate(jobs):
        for m in models:
            params = {"balancing_method": b or "None", "collumn_target": LABEL, "base": pair[0], "city": pair[1], "model": m}
            if i in failed:
                out.append(run_rows(f"DataBase_{pair[0]}", params | {"error": failed[i]}, {}, t0, "FAILED"))
                continue
            used, mets, number = found[i, m]
            train = [sizes.get((i, p), (0, 0)) for p in (FIT, CHECK)]
            mets = mets | {"n_train": sum(n for n, _ in train), "pos_train": sum(p for _, p in train),
                           **dict(zip(("n_test", "pos_test"), sizes.get((i, TEST), (0, 0)), strict=True))}
            row = run_rows(f"DataBase_{pair[0]}", params | used, mets | {"training_time": time.time() - t0}, t0)
            ids[i, m] = (row[0], number)
            out.append(row)
    result = spark.createDataFrame(out, RUN_SCHEMA)
    if models_path and ids:
        names = {i: parts[jobs[i][0]][2] for i in good}
        kept = model_table_rows({ids[key][0]: fitted[key] for key in ids}, names, edges)
        spark.createDataFrame(kept, MODEL_SCHEMA).write.mode("append").parquet(f"{models_path}/models")
        numbers = spark.createDataFrame([(n, r) for r, n in ids.values()], "run int, run_id string")
        pred.join(numbers, "run").drop("run", "dataset").write.mode("append").parquet(f"{models_path}/predictions")
    if log:
        log(result)
    return result


def train_one(spark: SparkSession, table: DataFrame, model: str, base: str, city: str, balancing: str | None = None,
              n_trials: int = C.N_TRIALS, seed: int = C.SEED, models_path: str | None = None, **options) -> DataFrame:
    """One study: its run row.  A failure is raised."""
    row = train_matrix(spark, {(base, city): table}, [model], [balancing], n_trials, seed=seed, models_path=models_path, **options)
    r = row.first()
    if r["status"] == "FAILED":
        raise ValueError(r["params"]["error"])
    return row


# --------------------------------------------------------------------------
# ML6: univariate feature scores (ANOVA F), k best
# --------------------------------------------------------------------------
def anova_f_scores(table: DataFrame, feats: list[str], label: str = LABEL,
                   group_cols: list[str] | None = None, k: int = 5) -> DataFrame:
    """F statistic of each feature against the class, per group; top k flagged.

    Between / within sums of squares from per-class counts, means and
    population variances (stable forms); nulls are skipped per feature.
    """
    g = group_cols or []
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in feats)
    long = table.selectExpr(*[f"`{c}`" for c in g], f"`{label}` AS __y",
                            f"stack({len(feats)}, {stack}) AS (feature, x)").where("x IS NOT NULL")
    per = long.groupBy(*g, "feature", "__y").agg(
        F.count(F.lit(1)).alias("n_g"), F.avg("x").alias("mu"), F.var_pop("x").alias("v"))
    tot = per.groupBy(*g, "feature").agg(
        F.sum("n_g").alias("n_tot"),
        (F.sum(F.col("n_g") * F.col("mu")) / F.sum("n_g")).alias("grand"),
        F.count(F.lit(1)).alias("n_cls"))
    j = per.join(tot, [*g, "feature"])
    ss = j.groupBy(*g, "feature", "n_tot", "n_cls").agg(
        F.sum(F.col("n_g") * (F.col("mu") - F.col("grand")) * (F.col("mu") - F.col("grand"))).alias("ssb"),
        F.sum(F.col("n_g") * F.col("v")).alias("ssw"))
    N, G = F.col("n_tot"), F.col("n_cls")
    f = F.when((G > 1) & (N > G) & (F.col("ssw") > 0),
               (F.col("ssb") / (G - 1)) / (F.col("ssw") / (N - G)))
    out = ss.select(*g, "feature", f.alias("f_score"))
    w = Window.partitionBy(*g).orderBy(F.col("f_score").desc_nulls_last(), "feature")
    return out.withColumn("rank", F.row_number().over(w)).withColumn("selected", F.col("rank") <= k)
