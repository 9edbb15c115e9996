"""Named queries over the star-schema tables, one per operator.

Every query is a function (spark, sf_dir) -> DataFrame over whole tables.
Queries that need a model-like score without a model use the transparent risk
rule; queries named ``q_model_*`` and the other unverified ones fit models.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.functions import rules
from keepwell.operators import drift as D
from keepwell.operators import explain as E
from keepwell.operators import gates as G
from keepwell.operators import kpis as K
from keepwell.operators import lookup as LK
from keepwell.operators import lookup_index as LI
from keepwell.operators import metrics as M
from keepwell.operators import models as ML
from keepwell.operators import prepare as P
from keepwell.operators import priority as PR
from keepwell.operators import score as SC
from keepwell.operators import segments as SG
from keepwell.operators import validate as V
from keepwell.operators import versions as VS
from keepwell.operators.distances import euclidean_silhouettes
from keepwell.operators.ordering import rank_global
from keepwell.operators.quantiles import exact_quantiles
from keepwell.operators.sampling import exact_split, fixed_sample
from keepwell.operators.score import check_records, rejected
from keepwell.operators.standardise import standardise
from keepwell.plans import fitted
from keepwell.session import checkpoint_dir, materialise, tune
from keepwell.sources import accounts as A
from keepwell.sources import snapshots as S
from keepwell.sources import tables as T
from keepwell.sources.star_schema import accounts, load, raw_accounts
from keepwell.streaming.scoring import account_stream, score_stream

SEARCH_TEXT = " c0000001 "
SAMPLE_ROWS = 100      # below the smallest base, so that a cut is searched at every size
NO_ORDERS = tuple(c for c in C.COLUMNS if c not in
                  ("Number_of_Referrals", "Total_Refunds", "Total_Revenue",
                   "Total_Extra_Data_Charges"))


# --- shared inputs ----------------------------------------------------------

def features(spark: SparkSession, sf: str) -> DataFrame:
    return P.build_features(accounts(spark, sf))


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return A.blank_to_null(A.normalise_header(raw_accounts(spark, sf)))


def raw_features(spark: SparkSession, sf: str) -> DataFrame:
    return P.build_features(A.typed(raw(spark, sf)))


def rule_base(spark: SparkSession, sf: str) -> DataFrame:
    """Rule scores with the columns segments and KPIs need. Medians and
    terciles take further passes, so the narrow result is materialised once in
    the shared checkpoint folder instead of repeating the joins."""
    return materialise(features(spark, sf).select(*rule_columns()))


def rule_columns() -> list:
    return [C.ID, rules.risk_rule().alias(C.PROBABILITY), F.col(C.VALUE_TARGET).alias(C.VALUE),
            "Customer_Status", *C.SEGMENT_FEATURES]


def rule_level(feature: str, terciles: SG.Terciles):
    return terciles.level(F.col(feature), feature)


def rule_assigned(base: DataFrame, terciles: SG.Terciles) -> DataFrame:
    """``base`` with nine rule clusters from the tenure and charge thirds."""
    tenure, charge, _ = C.SEGMENT_FEATURES
    order = {"Low": 0, "Mid": 1, "High": 2}
    number = lambda level: F.when(level == "Low", order["Low"]).when(
        level == "Mid", order["Mid"]).otherwise(order["High"])
    t, c = rule_level(tenure, terciles), rule_level(charge, terciles)
    return base.withColumns({"Cluster": number(t) * 3 + number(c),
                             C.SEGMENT: rules.segment_name(t, c)})


def rule_assignments(base: DataFrame, terciles: SG.Terciles) -> DataFrame:
    """The clusters as a table of their own, as a fitted model stores them."""
    return rule_assigned(base, terciles).select(C.ID, "Cluster", C.SEGMENT)


def rule_matrix(spark: SparkSession, sf: str, keep=()) -> DataFrame:
    """Labels and segments by the rules."""
    base = rule_base(spark, sf)
    return matrix_of(base, keep)


def matrix_of(base: DataFrame, keep=()) -> DataFrame:
    """The rule segment is a projection of the same row, so nothing is joined;
    ``q_attach_segments`` joins a stored assignment table instead."""
    labelled = PR.label_accounts(base, PR.median_thresholds(base))
    return rule_assigned(labelled, SG.population_terciles(base)).select(
        C.ID, C.PROBABILITY, C.VALUE, C.LABEL, *keep, C.SEGMENT)


def rule_profiles(base: DataFrame, terciles: SG.Terciles, cluster) -> DataFrame:
    """Sizes and mean positions of rule clusters, named like fitted ones."""
    sums = base.groupBy(cluster.alias("cluster")).agg(
        F.count("*").alias("customers"),
        *[F.sum(F.col(f).cast("decimal(18,2)")).alias(f) for f in C.SEGMENT_FEATURES])
    total = sums.agg(F.sum("customers")).scalar()
    n = F.col("customers").cast("double")
    return SG.name_profiles(sums.select(
        "cluster", "customers", (n / total.cast("double")).alias("share"),
        *[(F.col(f).cast("double") / n).alias(f"{f}_centroid") for f in C.SEGMENT_FEATURES],
    ), terciles)


def rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled accounts with the rule as a classifier at 0.5."""
    f = features(spark, sf).where(F.col("Customer_Status").isin(*C.LABELLED_STATUSES))
    return f.select(
        F.lit("rule").alias("model"), C.ID,
        (F.col("Customer_Status") == "Churned").cast("int").alias("label"),
        rules.risk_rule().alias(C.PROBABILITY),
    ).withColumn("prediction", (F.col(C.PROBABILITY) >= 0.5).cast("int"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(n, digits).alias(n) if t == "double" else n for n, t in df.dtypes])


# --- scans and validation ---------------------------------------------------

def q_scan_accounts(spark, sf):
    return A.typed(raw(spark, sf))


def q_csv_round_trip(spark, sf):
    """The extract written as a CSV file and read back by the account reader."""
    root = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    raw_accounts(spark, sf).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(root)
    return A.typed(A.read_accounts(spark, root))


def q_stage_round_trip(spark, sf):
    """The feature table as a stage hands it to the next one."""
    root = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    T.write_table(features(spark, sf), root, "features")
    return T.read_table(spark, root, "features")


def q_validate_report(spark, sf):
    # The report scans its input twice; store the extract like the file it is.
    return V.validation_report(materialise(raw(spark, sf)))


def q_duplicate_ids(spark, sf):
    return V.duplicate_keys(raw(spark, sf))


def q_duplicate_count(spark, sf):
    return V.duplicate_count(raw(spark, sf))


def q_numeric_coercion(spark, sf):
    return V.numeric_coercion(raw(spark, sf))


def q_blank_profile(spark, sf):
    return V.blank_profile(raw(spark, sf))


def q_vocab_check(spark, sf):
    return V.vocabulary_check(raw(spark, sf))


def q_vocab_violations(spark, sf):
    return V.vocabulary_violations(raw(spark, sf))


def q_status_counts(spark, sf):
    return V.value_counts(accounts(spark, sf, [C.ID, "Customer_Status"]), "Customer_Status")


def q_feature_nulls(spark, sf):
    return V.feature_nulls(raw_features(spark, sf))


def q_target_check(spark, sf):
    return V.finite_check(raw_features(spark, sf), [C.VALUE_TARGET, *C.SEGMENT_FEATURES,
                                                    "Referrals_per_Tenure_Year"])


def q_score_range_check(spark, sf):
    return V.score_range_check(rule_base(spark, sf))


def q_assignment_contract(spark, sf):
    base = rule_base(spark, sf)
    terciles = SG.population_terciles(base)
    assigned = rule_assignments(base, terciles)
    return V.assignment_contract(assigned, rule_profile_table(base, terciles))


def q_label_contract(spark, sf):
    return V.label_contract(rule_matrix(spark, sf))


def q_contract_drift(spark, sf):
    """The raw extract and the feature table, each changed the way a careless
    delivery would, against what their readers expect."""
    sent = raw(spark, sf)
    sent = sent.select("Monthly_Charge", *[c for c in sent.columns if c not in ("Monthly_Charge", "Offer")],
                       F.col("Contract").alias("Loyalty_Tier")).withColumn("Is_Ok", F.col("Age") != "4x")
    built = features(spark, sf)
    built = built.drop("Offer_Offer_A").withColumn(
        "Age", F.when(F.col("Senior_Citizen") == 1, "senior").otherwise(F.col("Age").cast("string")))
    offered = built.select("Total_Services", *[c for c in C.CHURN_PREDICTORS if c in built.columns and c != "Total_Services"])
    return D.drift_table(sent, [D.account_reader()], texts_are_typed=False).unionByName(
        D.drift_table(offered, [D.model_reader("churn model", C.CHURN_PREDICTORS),
                                D.model_reader("value model", C.VALUE_PREDICTORS, exact=False)]))


def q_class_presence(spark, sf):
    """Are both outcomes there, per contract type?"""
    a = accounts(spark, sf, [C.ID, "Customer_Status", "Contract"])
    labelled = a.where(F.col("Customer_Status").isin(*C.LABELLED_STATUSES)).withColumn(
        "label", (F.col("Customer_Status") == "Churned").cast("int"))
    return D.class_presence(labelled).select("class", "expected", "members", "present")


def q_artifact_gates(spark, sf):
    """Two tables written with their gates: one made of clean accounts, one of the
    raw extract, whose repeated ids and damaged values leave blanks."""
    root = f"{checkpoint_dir(spark)}/gates-{uuid.uuid4().hex}"
    customers = load(spark, sf, "customer").count()
    out = None
    for name, table in (("features", features(spark, sf)), ("raw features", raw_features(spark, sf))):
        gates = G.rows_gate(customers) | G.blanks_gate(table) | G.finite_gates(C.SEGMENT_FEATURES)
        part = G.gate_rows(name, G.write_counted(table, root, gates).counts, spark)
        out = part if out is None else out.unionByName(part)
    return out


def q_artifact_refresh(spark, sf):
    """An artifact read through the cache, written anew by another run, read again."""
    root = f"{checkpoint_dir(spark)}/refresh-{uuid.uuid4().hex}"
    a = accounts(spark, sf, [C.ID, "Customer_Status", "Contract"])
    out = None
    for version, column in ((1, "Customer_Status"), (2, "Contract")):
        T.write_table(V.value_counts(a, column).toDF("value", "row_count"), root, "counts")
        for reading in (1, 2):
            part = materialise(S.cached_table(spark, root, "counts").select(
                F.lit(version).alias("version"), F.lit(reading).alias("reading"), "value", "row_count"))
            out = part if out is None else out.unionByName(part)
    return out


# --- projections and derived features --------------------------------------

def q_repair_blanks(spark, sf):
    return P.repair(accounts(spark, sf))


def q_encode_binary(spark, sf):
    a = accounts(spark, sf, NO_ORDERS)
    return P.encode_flags(P.repair(a)).select(C.ID, "Gender", *C.YES_NO_FIELDS)


def q_one_hot(spark, sf):
    a = accounts(spark, sf, NO_ORDERS)
    return P.one_hot(P.repair(a)).select(C.ID, *C.DUMMIES)


def q_derived_features(spark, sf):
    return features(spark, sf).select(C.ID, *C.DERIVED_COLUMNS)


def q_features(spark, sf):
    return features(spark, sf)


def q_complete_features(spark, sf):
    return P.split_rejected(raw_features(spark, sf))[0].select(C.ID, *C.DERIVED_COLUMNS)


def q_churn_predictors(spark, sf):
    return features(spark, sf).select(C.ID, *C.CHURN_PREDICTORS)


def q_clv_predictors(spark, sf):
    return features(spark, sf).select(C.ID, *C.VALUE_PREDICTORS)


def q_training_population(spark, sf):
    return ML.churn_training_set(features(spark, sf)).select(
        C.ID, "label", "Tenure_in_Months", "Total_Services")


def q_clv_training(spark, sf):
    return ML.value_training_set(features(spark, sf)).select(
        C.ID, "label", "Tenure_in_Months", "Monthly_Charge")


def q_score_input(spark, sf):
    a = accounts(spark, sf)
    # Records arrive with lower-case names and without identity or outcomes.
    sent = a.select(C.ID, *C.SCORE_INPUTS).toDF(*[c.lower() for c in (C.ID, *C.SCORE_INPUTS)])
    return P.score_frame(sent.drop("unlimited_data"))


def q_rejected_records(spark, sf):
    return rejected(check_records(raw(spark, sf))).select(
        C.ID, F.concat_ws("; ", "reasons").alias("reasons"))


# --- statistics -------------------------------------------------------------

def q_median_thresholds(spark, sf):
    base = rule_base(spark, sf)
    return K.threshold_row(base, PR.median_thresholds(base))


def q_terciles(spark, sf):
    base = rule_base(spark, sf)
    cuts = SG.population_terciles(base).cuts
    n = base.agg(*[F.count(c).alias(c) for c in C.SEGMENT_FEATURES])
    return rounded(n.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(cuts[c][0]).alias("lower_third"),
                 F.lit(cuts[c][1]).alias("upper_third"), F.col(c).alias("row_count"))
        for c in C.SEGMENT_FEATURES]))))


def q_tercile_levels(spark, sf):
    base = rule_base(spark, sf)
    t = SG.population_terciles(base)
    return base.select(C.ID, *[rule_level(f, t).alias(f"{f}_level") for f in C.SEGMENT_FEATURES])


def q_fixed_sample(spark, sf):
    a = accounts(spark, sf, [C.ID, "Tenure_in_Months"])
    return fixed_sample(a, SAMPLE_ROWS)


def q_stratified_split(spark, sf):
    a = accounts(spark, sf, [C.ID, "Customer_Status"])
    labelled = a.where(F.col("Customer_Status").isin(*C.LABELLED_STATUSES)).select(
        C.ID, (F.col("Customer_Status") == "Churned").cast("int").alias("label"))
    return exact_split(labelled, strata="label")


def q_plain_split(spark, sf):
    return exact_split(accounts(spark, sf, [C.ID]))


def q_standardize(spark, sf):
    base = rule_base(spark, sf)
    z = standardise(base, C.SEGMENT_FEATURES)
    return rounded(z.select(C.ID, *[f"{f}_z" for f in C.SEGMENT_FEATURES]))


def q_class_weights(spark, sf):
    a = accounts(spark, sf, [C.ID, "Customer_Status"])
    labelled = a.where(F.col("Customer_Status").isin(*C.LABELLED_STATUSES)).select(
        (F.col("Customer_Status") == "Churned").cast("int").alias("label"))
    return M.class_weights(labelled)


def q_classification_metrics(spark, sf):
    return rounded(M.classification_metrics(rule_predictions(spark, sf)))


def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(rule_predictions(spark, sf))


def q_roc_auc(spark, sf):
    return rounded(M.roc_auc(rule_predictions(spark, sf), C.PROBABILITY), 9)


def q_regression_metrics(spark, sf):
    f = features(spark, sf).select(
        C.VALUE_TARGET, (F.col("Monthly_Charge") * F.col("Tenure_in_Months")).alias("estimate"))
    return rounded(M.regression_metrics(f, C.VALUE_TARGET, "estimate"))


def q_silhouette(spark, sf):
    base = rule_base(spark, sf)
    clustered = rule_assigned(base, SG.population_terciles(base))
    return rounded(M.silhouette(clustered, list(C.SEGMENT_FEATURES), "Cluster"))


def q_silhouette_euclidean(spark, sf):
    """The same with plain distances, over all rows."""
    base = rule_base(spark, sf)
    clustered = rule_assigned(base, SG.population_terciles(base))
    return rounded(euclidean_silhouettes(clustered, list(C.SEGMENT_FEATURES), ["Cluster"]).select("silhouette"))


# --- priority matrix and KPIs ----------------------------------------------

def q_priority_labels(spark, sf):
    base = rule_base(spark, sf)
    return PR.label_accounts(base, PR.median_thresholds(base)).select(
        C.ID, C.PROBABILITY, C.VALUE, C.LABEL)


def q_attach_segments(spark, sf):
    """The join of scores with a table of assignments (J-1)."""
    base = rule_base(spark, sf)
    labelled = PR.label_accounts(base, PR.median_thresholds(base)).select(
        C.ID, C.PROBABILITY, C.VALUE, C.LABEL)
    assigned = materialise(rule_assignments(base, SG.population_terciles(base)))
    V.require_one_to_one(labelled, assigned)
    return PR.attach_segments(labelled, assigned)


def q_ranked_list(spark, sf):
    return PR.ranked_list(rule_matrix(spark, sf))


def q_label_counts(spark, sf):
    return K.label_counts(rule_matrix(spark, sf))


def q_value_at_risk(spark, sf):
    return K.value_at_risk(rule_matrix(spark, sf))


def q_immediate_save_by_segment(spark, sf):
    return K.immediate_save_by_segment(rule_matrix(spark, sf))


def rule_profile_table(base: DataFrame, terciles: SG.Terciles) -> DataFrame:
    tenure, charge, _ = C.SEGMENT_FEATURES
    name = rules.segment_name(rule_level(tenure, terciles), rule_level(charge, terciles))
    return rule_profiles(base, terciles, name)


def q_segment_overview(spark, sf):
    base = rule_base(spark, sf)
    profiles = rule_profile_table(base, SG.population_terciles(base))
    return rounded(K.segment_overview(matrix_of(base), profiles))


def q_segment_profiles_rule(spark, sf):
    base = rule_base(spark, sf)
    return rounded(rule_profile_table(base, SG.population_terciles(base)))


def q_segment_profiles_collision(spark, sf):
    """Clusters cut by tenure and service thirds share tenure+spend names, so
    every name needs the service word."""
    base = rule_base(spark, sf)
    t = SG.population_terciles(base)
    tenure, _, services = C.SEGMENT_FEATURES
    key = F.concat_ws("/", rule_level(tenure, t), rule_level(services, t))
    return rounded(rule_profiles(base, t, key))


def q_kpis(spark, sf):
    return K.kpis(rule_matrix(spark, sf, keep=["Customer_Status"]))


def q_kpi_formatted(spark, sf):
    return K.kpi_texts(K.kpis(rule_matrix(spark, sf, keep=["Customer_Status"])))


def q_business_summary(spark, sf):
    return K.business_summary(rule_matrix(spark, sf))


def q_score_range(spark, sf):
    return K.score_range(rule_base(spark, sf))


def q_target_stats(spark, sf):
    a = accounts(spark, sf, [C.ID, C.VALUE_TARGET])
    test = exact_split(a).where("is_test")
    return rounded(K.target_stats(test, C.VALUE_TARGET))


def q_id_coverage(spark, sf):
    """Accounts on one side only, both ways, between features and matrix."""
    ids = accounts(spark, sf, [C.ID])
    matrix = rule_matrix(spark, sf).select(C.ID)
    one_way = lambda a, b, name: a.join(b, C.ID, "left_anti").agg(
        F.lit(name).alias("side"), F.count("*").alias("unmatched"))
    return one_way(ids, matrix, "features only").unionByName(
        one_way(matrix, ids, "matrix only"))


# --- lookup -----------------------------------------------------------------

def q_search_accounts(spark, sf):
    return LK.search_accounts(rule_matrix(spark, sf), SEARCH_TEXT)


def q_filter_queue(spark, sf):
    return LK.filter_queue(rule_matrix(spark, sf), labels=C.AT_RISK_LABELS, segments=())


def q_priority_queue(spark, sf):
    base = rule_base(spark, sf)
    return rounded(LK.priority_queue(matrix_of(
        base, ["Customer_Status", "Tenure_in_Months", "Monthly_Charge"])))


def q_dossier(spark, sf):
    """The join of the matrix with the account records (J-2); the feature table
    is built once and stored, and both sides come from it."""
    stored = materialise(features(spark, sf))
    base = stored.select(*rule_columns())
    return LK.dossier(LK.join_records(matrix_of(base), stored))


def q_pick_account(spark, sf):
    return LK.pick_account(PR.ranked_list(rule_matrix(spark, sf)), SEARCH_TEXT, row=3)


def indexed_matrix(spark: SparkSession, sf: str) -> LI.LookupIndex:
    """The ranked list stored for look-ups."""
    ranked = PR.ranked_list(rule_matrix(spark, sf))
    return LI.write_index(ranked, f"{checkpoint_dir(spark)}/lookup-{uuid.uuid4().hex}")


def q_indexed_search(spark, sf):
    """The search by the trigram postings."""
    return indexed_matrix(spark, sf).search(SEARCH_TEXT)


def q_indexed_pick(spark, sf):
    return LK.pick_hit(indexed_matrix(spark, sf).search(SEARCH_TEXT), row=3)


def q_indexed_account(spark, sf):
    """Exact look-up of the account at the top of the list: one file is read."""
    index = indexed_matrix(spark, sf)
    top = index.search("").where("rank = 1").first()
    return index.account(top[C.ID])


def q_rule_explained(spark, sf):
    base = rule_base(spark, sf)
    thresholds = PR.median_thresholds(base)
    return LK.explain_rule(PR.label_accounts(base, thresholds), thresholds)


# --- the same operators on plain tables -------------------------------------

def t_order_quantiles(spark, sf):
    """Median and thirds of order and line prices."""
    out = None
    for table, column in (("orders", "o_totalprice"), ("lineitem", "l_extendedprice"),
                          ("customer", "c_acctbal")):
        df = load(spark, sf, table)
        low, mid, high = exact_quantiles(df, [column], [1 / 3, 0.5, 2 / 3])[column]
        part = df.agg(F.lit(column).alias("column"), F.count(column).alias("row_count"),
                      F.lit(low).alias("lower_third"), F.lit(mid).alias("median"),
                      F.lit(high).alias("upper_third"))
        out = part if out is None else out.unionByName(part)
    return rounded(out)


def t_line_status_counts(spark, sf):
    return V.value_counts(load(spark, sf, "lineitem"), "l_returnflag")


def t_repeat_buyers(spark, sf):
    return V.duplicate_keys(load(spark, sf, "orders"), "o_custkey")


def t_document_blanks(spark, sf):
    return V.blank_profile(load(spark, sf, "documents"))


def t_order_sample(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return fixed_sample(orders, SAMPLE_ROWS, id_column="o_orderkey")


def t_label_split(spark, sf):
    return exact_split(load(spark, sf, "labels").select("doc_id", "quality"),
                       strata="quality", id_column="doc_id")


def t_order_split(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return exact_split(orders, strata="o_orderstatus", id_column="o_orderkey")


def t_label_confusion(spark, sf):
    labels = load(spark, sf, "labels").select(
        F.lit("toxic as quality").alias("model"), F.col("quality").alias("label"),
        F.col("toxic").alias("prediction"))
    return M.confusion_matrix(labels)


def t_length_auc(spark, sf):
    """Does document length rank good documents first?"""
    docs = load(spark, sf, "documents").select("doc_id", "n_chars")
    return rounded(M.roc_auc(
        load(spark, sf, "labels").join(docs, "doc_id"), "n_chars", "quality"), 9)


def t_part_standardised(spark, sf):
    parts = load(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                           "p_retailprice")
    z = standardise(parts, ["p_size", "p_retailprice"])
    return rounded(z.select("p_partkey", "p_size_z", "p_retailprice_z"))


def t_order_ranking(spark, sf):
    """Global rank without a single-task window."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rank_global(orders, [F.asc("o_orderpriority"), F.desc("o_totalprice"),
                                F.asc("o_orderkey")])


# --- fitted models (no SQL twin) --------------------------------------------

def q_churn_lr_scores(spark, sf):
    return ML.churn_scores(fitted.churn(spark, sf)[ML.LOGISTIC], fitted.features(spark, sf)).select(
        C.ID, C.PROBABILITY)


def q_churn_rf_scores(spark, sf):
    return ML.churn_scores(fitted.churn(spark, sf)[ML.FOREST], fitted.features(spark, sf)).select(
        C.ID, C.PROBABILITY)


def q_clv_scores(spark, sf):
    return ML.value_scores(fitted.value(spark, sf), fitted.features(spark, sf)).select(C.ID, C.VALUE)


def q_model_comparison(spark, sf):
    return fitted.comparison(spark, sf)


def q_best_model(spark, sf):
    """Chosen at full precision, reported to 4 places."""
    return rounded(ML.best_model(fitted.full_comparison(spark, sf)), 4)


def q_clv_metrics(spark, sf):
    _, test = fitted.value_split(spark, sf)
    return ML.value_model_report(fitted.value(spark, sf), test)


def q_clv_importance(spark, sf):
    return ML.feature_importance(fitted.value(spark, sf))


def q_top_drivers(spark, sf):
    return ML.top_drivers(ML.feature_importance(fitted.value(spark, sf)))


def q_contrib_summary(spark, sf):
    return fitted.contributions(spark, sf)


def q_k_evaluation(spark, sf):
    return fitted.k_evaluation(spark, sf)


def q_best_k(spark, sf):
    return SG.best_k(fitted.k_evaluation(spark, sf))


def q_segment_profiles(spark, sf):
    return fitted.profiles(spark, sf)


def q_segment_assign(spark, sf):
    return SG.assign_segments(fitted.features(spark, sf), fitted.segments(spark, sf),
                              fitted.profiles(spark, sf))


def q_model_assignment_contract(spark, sf):
    return V.assignment_contract(q_segment_assign(spark, sf), fitted.profiles(spark, sf))


def q_scored_base(spark, sf):
    return fitted.scores(spark, sf)


def q_model_score_range_check(spark, sf):
    return V.score_range_check(fitted.scores(spark, sf))


def q_model_priority_matrix(spark, sf):
    scores = fitted.stored_scores(spark, sf)
    labelled = PR.label_accounts(scores, PR.median_thresholds(scores))
    return PR.ranked_list(PR.attach_segments(labelled, q_segment_assign(spark, sf)))


def q_score_new_accounts(spark, sf):
    return fitted.score_new(spark, sf)


# --- properties of the fitted models that hold whatever was fitted ------------

def _verdict(df: DataFrame, violated) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"),
                  F.count_if(F.coalesce(violated, F.lit(True))).alias("violations"))


def q_score_acceptance(spark, sf):
    """Every record of the raw extract is answered, with its reasons or scores."""
    judged = SC.score_records(raw(spark, sf), fitted.bundle(spark, sf))
    complete = F.lit(True)
    for name in SC.OUTPUTS:
        complete = complete & (F.col(name).isNotNull() == F.col("accepted"))
    return judged.select("customer_id", "accepted", F.concat_ws("; ", "reasons").alias("reasons"),
                         complete.alias("complete"))


def q_stream_scoring(spark, sf):
    """The same through a stream: a file source read in three batches, one
    sink for scores and one for rejects, put together again."""
    root = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    files = -(-spark.sparkContext.defaultParallelism // 3)      # of a batch: all cores write
    raw(spark, sf).repartition(3 * files).write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    stream = account_stream(spark, f"{root}/in", schema=schema, files_per_trigger=files)
    score_stream(stream, fitted.bundle(spark, sf), f"{root}/scores", f"{root}/rejects",
                 f"{root}/state").awaitTermination()
    good, bad = spark.read.parquet(f"{root}/scores"), spark.read.parquet(f"{root}/rejects")
    return good.select("customer_id", F.lit(True).alias("accepted"), F.lit("").alias("reasons")).unionByName(
        bad.select("customer_id", F.lit(False).alias("accepted"), F.concat_ws("; ", "reasons").alias("reasons")))


def q_bundle_round_trip(spark, sf):
    """Stored and loaded again, the bundle scores every account the same."""
    root = f"{checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    kept = fitted.bundle(spark, sf)
    kept.save(root)
    a = accounts(spark, sf)
    again = SC.score_records(a, SC.Bundle.load(root)).select(
        "customer_id", F.struct(*SC.OUTPUTS).alias("loaded"))
    both = SC.score_records(a, kept).select("customer_id", F.struct(*SC.OUTPUTS).alias("fitted")).join(
        again, "customer_id")
    return _verdict(both, ~F.col("loaded").eqNullSafe(F.col("fitted")))


def q_bundle_swap(spark, sf):
    """A stream over two deliveries. Between them a second version is put in force
    (one that calls every account worth an immediate save) and a third is begun
    but never finished; each delivery is scored by the version then in force."""
    root = f"{checkpoint_dir(spark)}/swap-{uuid.uuid4().hex}"
    first = fitted.bundle(spark, sf)
    second = replace(first, thresholds=PR.Thresholds(-1.0, float("-inf")))
    sent, half = raw(spark, sf), half_of(C.ID)
    VS.publish(first, f"{root}/bundles")
    current = VS.CurrentBundle(f"{root}/bundles")
    for delivery in (0, 1):
        sent.where(half == delivery).write.mode("append").parquet(f"{root}/in")
        stream = account_stream(spark, f"{root}/in", schema=spark.read.parquet(f"{root}/in").schema)
        score_stream(stream, current, f"{root}/scores", f"{root}/rejects", f"{root}/state").awaitTermination()
        VS.publish(second, f"{root}/bundles")
        second.save(f"{root}/bundles/versions/begun-{delivery}")
    scored = spark.read.parquet(f"{root}/scores").select(
        "customer_id", F.lit(True).alias("accepted"), "bundle_version",
        (F.col("priority_label") == "Immediate Save").alias("saved"))
    bad = spark.read.parquet(f"{root}/rejects").select(
        "customer_id", F.lit(False).alias("accepted"), "bundle_version", F.lit(None).cast("boolean").alias("saved"))
    answers = scored.unionByName(bad).withColumn("delivery", half_of("customer_id"))
    return answers.select(
        "customer_id", "accepted", (F.col("bundle_version") == F.col("delivery") + 1).alias("by_its_version"),
        F.when(F.col("delivery") == 1, F.coalesce("saved", F.lit(True))).otherwise(True).alias("as_the_version_says"))


def half_of(column: str):
    return F.pmod(F.xxhash64(column), F.lit(2))


def q_scored_base_check(spark, sf):
    """Stored scores equal the deployed models' answers, and both are in range."""
    again = fitted.scores(spark, sf).withColumnsRenamed({C.PROBABILITY: "p", C.VALUE: "v"})
    both = fitted.stored_scores(spark, sf).join(again, C.ID)
    return _verdict(both, (F.abs(F.col(C.PROBABILITY) - F.col("p")) > 1e-12)
                    | (F.abs(F.col(C.VALUE) - F.col("v")) > 1e-9) | ~F.col("p").between(0, 1))


def q_model_label_check(spark, sf):
    """Labels of the model matrix follow the medians Spark's percentile gives."""
    matrix = q_model_priority_matrix(spark, sf)
    mid = matrix.agg(F.percentile(C.PROBABILITY, 0.5).alias("p"), F.percentile(C.VALUE, 0.5).alias("v"))
    want = rules.priority_label(F.col(C.PROBABILITY) >= F.col("p"), F.col(C.VALUE) >= F.col("v"))
    return _verdict(matrix.join(F.broadcast(mid)), F.col(C.LABEL) != want)    # mid is one row


def q_segment_nearest_check(spark, sf):
    """Every account is in the cluster whose centroid is nearest in scaled units."""
    model = fitted.segments(spark, sf)
    scaler = model.fitted.pipeline.stages[-2]
    std = scaler.std.toArray()
    rows = model.assign(fitted.features(spark, sf).select(C.ID, *C.SEGMENT_FEATURES))

    def distance(centroid):
        return sum((((F.col(f) - c) / float(s)) ** 2 for f, c, s in zip(C.SEGMENT_FEATURES, centroid, std)), F.lit(0.0))

    own = F.lit(None).cast("double")
    for k, centroid in enumerate(model.centroids):
        own = F.when(F.col("cluster") == k, distance(centroid)).otherwise(own)
    nearest = F.least(*[distance(c) for c in model.centroids])
    return _verdict(rows, own > nearest + 1e-9)


def q_contribution_check(spark, sf):
    """Forest contributions of every held-out account add up to its score."""
    _, test = fitted.churn_split(spark, sf)
    model = fitted.churn(spark, sf)[ML.FOREST]
    scratch = f"{checkpoint_dir(spark)}/forest-nodes-{uuid.uuid4().hex}"
    total = E.forest_contributions(model, test, scratch).groupBy(C.ID).agg(F.sum("contribution").alias("total"))
    rest = materialise(ML.churn_scores(model, test).join(total, C.ID).select(
        C.ID, (F.col(C.PROBABILITY) - F.col("total")).alias("base")))
    base = rest.agg(F.min("base").alias("low"), F.max("base").alias("high"))
    return rest.agg(F.count("*").alias("row_count")).join(F.broadcast(base)).select(
        "row_count", (F.col("high") - F.col("low") < 1e-6).alias("one_base"),
        F.col("low").between(0, 1).alias("base_is_a_share"))


def q_logistic_gradient_check(spark, sf):
    """At the fitted weights the penalised gradient of every feature vanishes."""
    train, _ = fitted.churn_split(spark, sf)
    model = fitted.churn(spark, sf)[ML.LOGISTIC]
    last = model.pipeline.stages[-1]
    weighted, n = ML.balanced(train)
    scored = model.pipeline.transform(weighted)
    z, p = vector_to_array("churn_features"), vector_to_array("churn_class_shares")[1]
    error = F.col("weight") * (p - F.col("label"))
    sums = scored.select(error.alias("e"), z.alias("z")).agg(
        *[F.avg(F.col("e") * F.col("z")[i]).alias(f"g{i}") for i in range(len(model.inputs))])
    penalty = (n - 1) / n / n
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("feature"),
                 (F.abs(F.col(f"g{i}") + penalty * float(last.coefficients[i])) < 1e-3).alias("stationary"))
        for i, name in enumerate(model.inputs)])))


def q_importance_check(spark, sf):
    """Every predictor has a share, no share is negative, and they add to one."""
    shares = ML.feature_importance(fitted.value(spark, sf))
    total = shares.agg(F.sum("importance")).scalar()
    return shares.select("feature", ((F.col("importance") >= 0) & (F.abs(total - 1) < 1e-9)).alias("is_share"))


def q_comparison_check(spark, sf):
    """Both classifiers are compared with rates in range, and the deployed one
    has the largest AUC."""
    full = fitted.full_comparison(spark, sf)
    best = ML.best_model(full).select("roc_auc").scalar()
    inside = F.lit(True)
    for c in ("accuracy", "precision", "recall", "f1", "roc_auc"):
        inside = inside & F.col(c).between(0, 1)
    return full.select("model", inside.alias("in_range"), (F.col("roc_auc") <= best).alias("not_above_best"))


def q_k_sweep_check(spark, sf):
    """Every k is there, inertia falls, and the silhouette is one."""
    before = F.lag("inertia").over(Window.orderBy("k"))      # seven rows
    return fitted.k_evaluation(spark, sf).select(
        "k", F.coalesce(F.col("inertia") < before, F.lit(True)).alias("inertia_falls"),
        F.col("silhouette").between(-1, 1).alias("in_range"))


def q_k_sweep_recount(spark, sf):
    """Per k: all clusters are used, the inertia follows from the assignments, and
    the chosen k has the largest silhouette. Final centroids are within the
    tolerance of their clusters' means, hence the thousandth."""
    clusters, n = fitted.k_clusters(spark, sf), fitted.features(spark, sf).count()
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("c")) for k in C.K_RANGE]))
    spread = clusters.select(each.alias("e"), *SG.SCALED).groupBy("e.k", "e.c").agg(
        sum((F.var_pop(c) for c in SG.SCALED), F.lit(0.0)).alias("v"), F.count("*").alias("n"))
    again = spread.groupBy("k").agg(F.count("*").alias("used"), F.sum(F.col("v") * F.col("n") * n / (n - 1)).alias("again"))
    best = SG.best_k(fitted.k_evaluation(spark, sf)).select("silhouette").scalar()
    return fitted.k_evaluation(spark, sf).join(F.broadcast(again), "k").select(
        "k", (F.col("used") == F.col("k")).alias("all_used"),
        F.col("inertia").between(F.col("again") * (1 - 1e-9), F.col("again") * 1.001).alias("same_inertia"),
        (F.col("silhouette") <= best).alias("not_above_best"))


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark)}/forest-nodes-{uuid.uuid4().hex}"


def q_metrics_recount(spark, sf):
    """Both classifiers' rates from averages of the stored predictions, their AUC
    from mean ranks (Mann and Whitney), and the deployed one has the largest."""
    held = fitted.held_out(spark, sf)
    hit = (F.col("label") == F.col("prediction")).cast("double")
    rates = held.groupBy("model").agg(
        F.avg(hit).alias("a"), F.avg(F.when(F.col("prediction") == 1, F.col("label"))).alias("p"),
        F.avg(F.when(F.col("label") == 1, F.col("prediction"))).alias("r"),
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    aucs = None
    for name in C.CHURN_MODEL_NAMES:
        ranked = rank_global(held.where(F.col("model") == name), [F.asc(C.PROBABILITY), F.asc(C.ID)], "place")
        ties = ranked.groupBy(C.PROBABILITY).agg((F.avg("place") * F.sum("label")).alias("s"))
        part = ties.agg(F.lit(name).alias("model"), F.sum("s").alias("s"))
        aucs = part if aucs is None else aucs.unionByName(part)
    close = lambda x, y: F.abs(F.coalesce(x, F.lit(0.0)) - F.col(y)) < 1e-9
    auc = (F.col("s") - F.col("pos") * (F.col("pos") + 1) / 2) / (F.col("pos") * F.col("neg"))
    f1 = F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))
    best = ML.best_model(fitted.full_comparison(spark, sf)).select("model").scalar()
    top = fitted.full_comparison(spark, sf).agg(F.max("roc_auc")).scalar()
    both = fitted.full_comparison(spark, sf).join(rates, "model").join(aucs, "model")
    return both.select(
        "model", (close(F.col("a"), "accuracy") & close(F.col("p"), "precision") & close(F.col("r"), "recall")
                  & close(f1, "f1")).alias("same_rates"), close(auc, "roc_auc").alias("same_auc"),
        ((F.col("model") != best) | (F.col("roc_auc") == top)).alias("best_is_deployed"))


def q_forest_walk_check(spark, sf):
    """Every account's forest probability is that of the leaves its values lead to."""
    model, f = fitted.churn(spark, sf)[ML.FOREST], fitted.features(spark, sf)
    both = E.walked_scores(model, f, _scratch(spark)).join(ML.churn_scores(model, f).select(C.ID, C.PROBABILITY), C.ID)
    return _verdict(both, F.abs(F.col("walked") - F.col(C.PROBABILITY)) > 1e-9)


def q_importance_recount(spark, sf):
    """Reported importance of every predictor against the gains of the stored nodes,
    and the ten drivers are the largest of them."""
    model = fitted.value(spark, sf)
    again = E.counted_importance(model, _scratch(spark))
    top = ML.top_drivers(ML.feature_importance(model)).select("feature", F.lit(True).alias("top"))
    least = ML.top_drivers(ML.feature_importance(model)).agg(F.min("importance")).scalar()
    rows = ML.feature_importance(model).join(again, "feature", "left").join(top, "feature", "left")
    return rows.select("feature", (F.abs(F.col("importance") - F.coalesce("share", F.lit(0.0))) < 1e-9).alias("same"),
                       F.when(F.col("top"), F.col("importance") >= least).otherwise(
                           F.col("importance") <= least).alias("rightly_ranked"))


def q_value_fit_check(spark, sf):
    """Held-out accounts: the reported errors follow from the scores, the scores stay
    within what was learned from, and they beat the mean by far."""
    train, test = fitted.value_split(spark, sf)
    model = fitted.value(spark, sf)
    scored = ML.value_scores(model, test).select("label", C.VALUE)
    learned = train.agg(F.struct(F.min("label").alias("low"), F.max("label").alias("high"))).scalar()
    error = F.col("label") - F.col(C.VALUE)
    own = scored.agg(F.sqrt(F.avg(error * error)).alias("e"), F.avg(F.abs(error)).alias("m"), F.stddev_pop("label").alias("s"),
                     F.count_if(~F.col(C.VALUE).between(learned["low"] - 1e-6, learned["high"] + 1e-6)).alias("outside"))
    return ML.value_model_report(model, test).join(F.broadcast(own)).select(       # one row each
        ((F.abs(F.col("rmse") - F.col("e")) < 1e-6) & (F.abs(F.col("mae") - F.col("m")) < 1e-6)
         & (F.abs(F.col("r2") - (1 - F.col("e") * F.col("e") / (F.col("s") * F.col("s")))) < 1e-9)).alias("same_errors"),
        (F.col("outside") == 0).alias("within_range"), (F.col("e") < 0.5 * F.col("s")).alias("beats_the_mean"))


def q_profile_recount(spark, sf):
    """Sizes, shares and centroids of the fitted segments from the assignments. A
    centroid is within the fit's tolerance (and rounding) of its members' mean."""
    f = fitted.features(spark, sf)
    n = f.count()
    members = q_segment_assign(spark, sf).join(f.select(C.ID, *C.SEGMENT_FEATURES), C.ID)
    spread = f.agg(*[F.stddev(c).alias(c) for c in C.SEGMENT_FEATURES]).first()
    again = members.groupBy(F.col("Cluster").alias("cluster"), F.col(C.SEGMENT).alias("name")).agg(
        F.count("*").alias("m"), *[F.avg(c).alias(c) for c in C.SEGMENT_FEATURES])
    near = F.lit(True)
    for c in C.SEGMENT_FEATURES:
        near = near & (F.abs(F.col(c) - F.col(f"{c}_centroid")) <= 0.006 + 0.02 * float(spread[c]))
    return fitted.profiles(spark, sf).join(again, "cluster", "left").select(
        "cluster", (F.col("name") == F.col("segment")).alias("same_name"), (F.col("customers") == F.col("m")).alias("same_size"),
        (F.abs(F.col("share") - F.col("m") / F.lit(float(n))) < 1e-12).alias("same_share"), near.alias("same_centroid"))


def _tuned(query):
    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return query(tune(spark), sf)
    return run


QUERIES = {
    name: _tuned(fn) for name, fn in list(globals().items())
    if callable(fn) and name[:2] in ("q_", "t_") and getattr(fn, "__module__", "") == __name__
}
