"""Fits, segments, explanations, scoring and the whole pipeline, small and by
tolerance."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.operators import explain as E
from keepwell.operators import models as ML
from keepwell.operators import score as S
from keepwell.operators import segments as SG
from keepwell.operators import validate as V
from keepwell.plans import pipeline as PL
from keepwell.sources import star_schema, tables
from keepwell.streaming.scoring import account_stream, score_stream

TINY = ML.ForestSettings(trees=6, depth=4)


@pytest.fixture(scope="module")
def accounts(spark, sf):
    return star_schema.accounts(spark, sf).cache()


@pytest.fixture(scope="module")
def root(accounts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages"))
    PL.run(accounts, path, expected_rows=150, settings=TINY, restarts=2)
    return path


@pytest.fixture(scope="module")
def features(spark, root):
    return tables.read_table(spark, root, "features").cache()


@pytest.fixture(scope="module")
def split(features):
    train, test = ML.split_training_set(ML.churn_training_set(features), "label")
    return train.cache(), test.cache()


@pytest.fixture(scope="module")
def churn(split):
    return ML.fit_churn_models(split[0], settings=TINY)


def read(spark, root, name):
    return tables.read_table(spark, root, name)


# --- pipeline artifacts ------------------------------------------------------

def test_all_artifacts_and_gates(spark, root):
    assert tables.missing_artifacts(spark, root) == []
    gates = V.artifact_gates(spark, root, expected_rows=150).collect()
    assert [g.gate for g in gates if not g.passed] == []
    assert tables.publish(spark, root) and spark.table("priority_matrix").count() == 150


def test_gates_report_what_is_missing(spark, tmp_path):
    gates = V.artifact_gates(spark, str(tmp_path)).collect()
    assert len(gates) == 5 and not any(g.passed for g in gates)


def test_comparison_and_confusion(spark, root, split):
    table = {r.model: r for r in read(spark, root, "churn_model_comparison").collect()}
    assert set(table) == set(C.CHURN_MODEL_NAMES)
    for row in table.values():
        for metric in ("accuracy", "precision", "recall", "f1", "roc_auc"):
            assert 0 <= row[metric] <= 1 and round(row[metric], 4) == row[metric]
        assert row.roc_auc > 0.7
    cells = read(spark, root, "churn_confusion_matrix").collect()
    best = max(table.values(), key=lambda r: (r.roc_auc, r.f1)).model
    assert len(cells) == 4 and {c.model for c in cells} == {best}
    assert sum(c["count"] for c in cells) == split[1].count() == math.ceil(0.2 * 144)


def test_value_artifacts(spark, root):
    row = read(spark, root, "clv_metrics").first()
    assert row.rmse >= row.mae > 0 and 0.5 < row.r2 <= 1
    shares = read(spark, root, "clv_feature_importance").orderBy("position").collect()
    assert len(shares) == 43
    assert sum(s.importance for s in shares) == pytest.approx(1)
    assert all(a.importance >= b.importance for a, b in zip(shares, shares[1:]))


def test_segment_artifacts(spark, root):
    sweep = {r.k: r for r in read(spark, root, "segment_evaluation").collect()}
    assert sorted(sweep) == list(range(2, 9))
    assert all(-1 <= r.silhouette <= 1 for r in sweep.values())
    assert sweep[8].inertia < sweep[2].inertia
    profiles = read(spark, root, "segment_profiles").orderBy("cluster").collect()
    assert [p.cluster for p in profiles] == [0, 1, 2, 3]
    assert len({p.segment for p in profiles}) == 4
    assert sum(p.customers for p in profiles) == 150
    assert sum(p.share for p in profiles) == pytest.approx(1)
    # Numbers follow the tenure of the centroid.
    tenures = [p.Tenure_in_Months_centroid for p in profiles]
    assert tenures == sorted(tenures)


def test_matrix_follows_the_median_rule(spark, root):
    df = read(spark, root, "priority_matrix").toPandas()
    assert len(df) == 150 and df[C.ID].is_unique and not df.isna().any().any()
    risk = df[C.PROBABILITY] >= df[C.PROBABILITY].median()
    value = df[C.VALUE] >= df[C.VALUE].median()
    want = np.select([risk & value, risk, value], C.PRIORITY_LABELS[:3], C.PRIORITY_LABELS[3])
    assert (df[C.LABEL] == want).all()
    ordered = df.sort_values("rank")
    place = ordered[C.LABEL].map({n: i for i, n in enumerate(C.PRIORITY_LABELS)})
    assert place.is_monotonic_increasing and list(ordered["rank"]) == list(range(1, 151))


def test_stored_scores_equal_the_models(spark, root, features):
    churn = ML.FittedModel.load(f"{root}/churn_model")
    value = ML.FittedModel.load(f"{root}/clv_model")
    again = ML.score_base(features, churn, value).toPandas().set_index(C.ID).sort_index()
    stored = read(spark, root, "priority_matrix").toPandas().set_index(C.ID).sort_index()
    for c in (C.PROBABILITY, C.VALUE):
        assert np.allclose(again[c], stored[c], atol=1e-12)


def test_drift_guard(root, features):
    churn = ML.FittedModel.load(f"{root}/churn_model")
    value = ML.FittedModel.load(f"{root}/clv_model")
    with pytest.raises(V.AccountTableError):
        ML.score_base(features.withColumn("New_Signal", F.lit(1)), churn, value)
    with pytest.raises(V.AccountTableError):
        ML.score_base(features.drop("Senior_Citizen"), churn, value, exact_inputs=False)


def test_bad_table_stops_the_pipeline(accounts, tmp_path):
    with pytest.raises(V.AccountTableError, match="duplicate_id"):
        PL.features_stage(accounts.union(accounts.limit(1)), str(tmp_path))


def test_rejects_are_kept_apart(spark, accounts, tmp_path):
    damaged = accounts.withColumn("Tenure_in_Months", F.when(
        F.col("Customer_ID") == "C000000003", 0).otherwise(F.col("Tenure_in_Months")))
    with pytest.raises(V.AccountTableError, match="blanks"):
        PL.features_stage(damaged, str(tmp_path / "a"))
    kept = PL.features_stage(damaged, str(tmp_path / "b"), keep_rejects=True)
    assert kept.count() == 149
    assert read(spark, str(tmp_path / "b"), "rejected_accounts").count() == 1


# --- classifiers --------------------------------------------------------------

def test_needs_both_classes(features):
    stayed = ML.churn_training_set(features).where("label = 0")
    with pytest.raises(V.AccountTableError):
        ML.balanced(stayed)


def test_logistic_model_solves_the_penalised_problem(split, churn):
    """The fitted weights against Newton steps on the textbook objective."""
    df = split[0].toPandas()
    x = df[list(C.CHURN_PREDICTORS)].to_numpy(float)
    y = df["label"].to_numpy()
    std = x.std(axis=0)
    z = np.where(std > 0, (x - x.mean(axis=0)) / np.where(std > 0, std, 1), 0.0)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    a = np.c_[z, np.ones(len(y))]
    pen = np.r_[np.ones(z.shape[1]), 0.0]
    beta = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ beta))
        grad = a.T @ (w * (p - y)) + pen * beta
        hess = a.T @ (a * (w * p * (1 - p))[:, None]) + np.diag(pen + 1e-9)
        beta -= np.linalg.solve(hess, grad)
    want = 1 / (1 + np.exp(-a @ beta))
    got = ML.churn_scores(churn[ML.LOGISTIC], split[0]).select(C.ID, C.PROBABILITY).toPandas()
    got = got.set_index(C.ID).loc[df[C.ID], C.PROBABILITY].to_numpy()
    assert np.abs(got - want).max() < 5e-3


def test_forest_is_repeatable(split, churn):
    again = ML.fit_churn_models(split[0].repartition(3), settings=TINY)[ML.FOREST]
    a = ML.churn_scores(churn[ML.FOREST], split[1]).select(C.ID, C.PROBABILITY).toPandas()
    b = ML.churn_scores(again, split[1]).select(C.ID, C.PROBABILITY).toPandas()
    m = a.merge(b, on=C.ID)
    assert np.allclose(m.iloc[:, 1], m.iloc[:, 2], atol=1e-9)


def test_model_save_and_load(churn, split, tmp_path):
    model = churn[ML.LOGISTIC]
    model.save(str(tmp_path / "m"))
    back = ML.FittedModel.load(str(tmp_path / "m"))
    assert back.inputs == model.inputs and back.name == model.name
    a, b = (ML.churn_scores(m, split[1]).agg(F.sum(C.PROBABILITY)).first()[0] for m in (model, back))
    assert a == pytest.approx(b, abs=1e-12)


# --- explanations ---------------------------------------------------------------

def brute_shapley(x, leaves, n):
    """Shapley values straight from the definition over all feature subsets."""
    def value(subset):
        total = 0.0
        for v, feats, low, high, share in leaves:
            for f, lo, hi, s in zip(feats, low, high, share):
                v *= float(lo < x[f] <= hi) if f in subset else s
            total += v
        return total
    out = np.zeros(n)
    for j in range(n):
        rest = [i for i in range(n) if i != j]
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for subset in itertools.combinations(rest, size):
                out[j] += weight * (value({*subset, j}) - value(set(subset)))
    return out


def test_forest_contributions_are_shapley_values(spark, split, tmp_path):
    inputs = ("Tenure_in_Months", "Contract_One_Year", "Monthly_Charge", "Age", "Total_Services")
    model = ML.fit_churn_models(split[0], inputs, TINY)[ML.FOREST]
    leaves = E.forest_paths(model, str(tmp_path / "nodes"))
    x = split[1].select(*inputs).toPandas().to_numpy(float)
    got = E.shapley_values(x, leaves)
    for i in range(5):
        assert np.allclose(got[i], brute_shapley(x[i], leaves, len(inputs)), atol=1e-12)


def test_contributions_add_up_to_the_score(split, churn, tmp_path):
    model = churn[ML.FOREST]
    leaves = E.forest_paths(model, str(tmp_path / "nodes"))
    base = sum(v * np.prod(share) for v, _, _, _, share in leaves)
    total = (E.forest_contributions(model, split[1], str(tmp_path / "n2"))
             .groupBy(C.ID).agg(F.sum("contribution").alias("c")))
    both = total.join(ML.churn_scores(model, split[1]).select(C.ID, C.PROBABILITY), C.ID).toPandas()
    assert np.allclose(both["c"] + base, both[C.PROBABILITY], atol=1e-9)


def test_logistic_contributions_add_up(split, churn):
    model = churn[ML.LOGISTIC]
    total = (E.logistic_contributions(model, split[1]).groupBy(C.ID)
             .agg(F.sum("contribution").alias("c")))
    margin = model.pipeline.transform(split[1]).select(
        C.ID, vector_to_array("churn_margin")[1].alias("m"))
    both = total.join(margin, C.ID).toPandas()
    assert np.allclose(both["c"] + model.pipeline.stages[-1].intercept, both["m"], atol=1e-9)


# --- segments -------------------------------------------------------------------

def test_shared_names_get_the_service_word(spark):
    terciles = SG.Terciles({c: (10.0, 20.0) for c in C.SEGMENT_FEATURES})
    schema = "cluster int, customers bigint, share double, " + ", ".join(
        f"{c}_centroid double" for c in C.SEGMENT_FEATURES)
    df = spark.createDataFrame([(0, 1, .2, 5., 5., 5.), (1, 1, .2, 9., 10., 25.),
                                (2, 3, .6, 25., 15., 15.)], schema)
    named = SG.name_profiles(df, terciles)
    assert {r.cluster: r.segment for r in named.collect()} == {
        0: "New Budget Customers (Basic Services)",
        1: "New Budget Customers (Full-Service Services)",
        2: "Loyal Standard Customers"}
    SG.require_distinct_names(named)
    with pytest.raises(V.AccountTableError):
        SG.require_distinct_names(named.union(named))


# --- scoring ----------------------------------------------------------------------

def test_scoring_equals_the_stored_matrix(spark, root, accounts):
    bundle = S.Bundle.load(root)
    scored = S.score_accounts(accounts, bundle).toPandas().set_index("customer_id")
    stored = read(spark, root, "priority_matrix").toPandas().set_index(C.ID).loc[scored.index]
    assert np.allclose(scored["churn_probability"], stored[C.PROBABILITY], atol=1e-12)
    assert (scored["priority_label"] == stored[C.LABEL]).all()
    assert (scored["segment"] == stored[C.SEGMENT]).all()


def test_one_record_uses_stored_medians(root, accounts):
    bundle = S.Bundle.load(root)
    whole = {r.customer_id: r for r in S.score_accounts(accounts, bundle).collect()}
    single = S.score_accounts(accounts.where("Customer_ID = 'C000000004'"), bundle).first()
    assert single == whole["C000000004"]


def test_rejection_reasons(table):
    df = table({}, {"Age": 121}, {"Contract": "Monthly"}, {"Tenure_in_Months": 0},
               {"Online_Backup": None}, {"Married": None}, {"Total_Charges": -1.0},
               {"Monthly_Charge": -9.0})
    bad = {r[C.ID]: r["reasons"] for r in S.rejected(S.check_records(df)).collect()}
    assert bad == {
        "A1": ["Age: out of range"], "A2": ["Contract: unknown value"],
        "A3": ["Tenure_in_Months: zero, no referral rate"],
        "A4": ["Online_Backup: blank that cannot be repaired"], "A5": ["Married: missing"],
        "A6": ["Total_Charges: out of range"]}
    assert S.accepted(S.check_records(df)).count() == 2


def test_incomplete_bundle(tmp_path):
    with pytest.raises(FileNotFoundError):
        S.Bundle.load(str(tmp_path))


def test_stream_equals_batch(spark, root, accounts, tmp_path):
    bundle = S.Bundle.load(root)
    source = str(tmp_path / "in")
    accounts.repartition(3).write.parquet(source)
    stream = account_stream(spark, source, files_per_trigger=1)
    score_stream(stream, bundle, str(tmp_path / "out"), str(tmp_path / "bad"),
                 str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    want = S.score_accounts(accounts, bundle)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    rejects = spark.read.parquet(str(tmp_path / "bad"))
    assert got.count() + rejects.count() == 150


def test_every_record_is_answered(spark, root, table):
    bundle = S.Bundle.load(root)
    rows = {r.customer_id: r for r in S.score_records(
        table({}, {"Age": 121}, {"Tenure_in_Months": 0}), bundle).collect()}
    assert rows["A0"].accepted and rows["A0"].priority_label in C.PRIORITY_LABELS
    for bad, reason in (("A1", "Age: out of range"), ("A2", "Tenure_in_Months: zero, no referral rate")):
        assert not rows[bad].accepted and rows[bad].reasons == [reason]
        assert rows[bad].churn_probability is None and rows[bad].segment is None


def test_a_cluster_without_a_name_is_a_reason(root, table):
    import dataclasses
    bundle = dataclasses.replace(S.Bundle.load(root), names={})
    row = S.score_records(table({}), bundle).first()
    assert not row.accepted and row.reasons == ["cluster: no segment name"]


def test_names_come_from_the_full_centroids(spark):
    cuts = SG.Terciles({"Tenure_in_Months": (24.0, 48.0), "Monthly_Charge": (20.0, 80.0), "Total_Services": (2.0, 6.0)})
    model = SG.SegmentModel(None, (0,), ((24.004, 50.0, 3.0),))
    assigned = spark.createDataFrame([("a", 0)], "Customer_ID string, cluster int")
    row = SG.segment_profiles(assigned, model, cuts).first()
    assert row.tenure_level == "Mid" and row.Tenure_in_Months_centroid == 24.0


def test_the_better_auc_wins_below_four_places(spark):
    rows = [(C.CHURN_MODEL_NAMES[0], .9, .9, .9, .5, 0.90001), (C.CHURN_MODEL_NAMES[1], .9, .9, .9, .6, 0.90000)]
    compared = spark.createDataFrame(rows, "model string, accuracy double, precision double, recall double, f1 double, roc_auc double")
    assert ML.best_model(compared).first().model == C.CHURN_MODEL_NAMES[0]


def test_one_forest_for_any_shuffle_setting(spark, split):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    scores = []
    try:
        for setting in ("3", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", setting)
            model = ML.fit_churn_models(split[0], settings=TINY)[ML.FOREST]
            scores.append(sorted(map(tuple, ML.churn_scores(model, split[1]).select(C.ID, C.PROBABILITY).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert scores[0] == scores[1]


def test_shipped_settings_fit(split):
    models = ML.fit_churn_models(split[0])
    forest = models[ML.FOREST].pipeline.stages[-1]
    assert forest.getNumTrees == ML.ForestSettings().trees == 100
    assert ML.compare_models(ML.held_out_predictions(models, split[1])).where("roc_auc > 0.6").count() == 2
