"""Registered queries: every operator group over the star-schema tables.

A query takes a session and the folder of the tables and returns a frame over all their rows.
Aggregated doubles are rounded here, not in the operators, so that results compare equal
whatever the order of summation was.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart import constants as K
from creditmart.functions import cleaning as C
from creditmart.functions import features as X
from creditmart.functions.dates import any_date, feature_date, month_key
from creditmart.operators import entity_stats as E
from creditmart.operators import keys as Y
from creditmart.operators import metrics as M
from creditmart.operators import modeling as L
from creditmart.operators import monitoring as O
from creditmart.operators import preprocess as P
from creditmart.operators import profile as R
from creditmart.operators import projection as J
from creditmart.operators import quality as Q
from creditmart.operators import splits as S
from creditmart.plans import layers
from creditmart.plans.jobs import with_clickstream
from creditmart.plans.star import star_input, table
from creditmart.session import apply_settings, checkpoint_dir
from creditmart.sources.readers import months_in
from creditmart.sources.writers import remove_folder, shuffles_dropped

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(apply_settings(spark), folder)
    QUERIES[build.__name__] = run
    return run


def rounded(df: DataFrame, places: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded; adding zero turns a negative zero into a plain one."""
    return df.select(*[
        (F.round(c, places) + F.lit(0.0)).alias(c) if kind == "double" and c not in skip else F.col(c)
        for c, kind in df.dtypes
    ])


def widen(df: DataFrame) -> DataFrame:
    """32-bit floats as doubles, the same numbers."""
    return df.select(*[F.col(c).cast("double").alias(c) if kind == "float" else F.col(c) for c, kind in df.dtypes])


# ---- shared inputs ----------------------------------------------------------------------

def loans(spark, folder):
    return layers.silver_loans(star_input(spark, folder, "loan_daily"))


def label_rows(spark, folder):
    return layers.gold_labels(loans(spark, folder))


def attributes(spark, folder):
    return layers.silver_attributes(star_input(spark, folder, "attributes"))


def clean(spark, folder):
    """Cleaned financials with their row id, duplicates still in."""
    return layers.clean_financials(star_input(spark, folder, "financials"))


def financials(spark, folder):
    return layers.silver_financials(star_input(spark, folder, "financials"), [F.col("row_id").desc()])


def financials_by_row(spark, folder):
    """Like ``financials`` but with the row id kept."""
    return layers.latest_financials(star_input(spark, folder, "financials"), [F.col("row_id").desc()])


def lines(spark, folder):
    """Line items as a numeric modelling frame."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), "l_linestatus",
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))


NUMBERS = ["quantity", "price", "discount", "tax"]
STAR_SPLITS = {"Train": ("1995-01-01", "1997-12-31"), "Valid": ("1998-01-01", "1998-12-31"),
               "Test": ("1999-01-01", "2000-06-30"), "OOT": ("2000-07-01", "2002-12-31")}


def scored_long(spark, folder):
    scored = S.time_split(star_input(spark, folder, "scored"), STAR_SPLITS)
    return M.melt_models(scored, {"lr": "proba_lr", "xgb": "proba_xgb"}, ["split", "label"])


# ---- loans and labels -------------------------------------------------------------------

@query
def loan_ageing(spark, folder):
    """From text, as the raw file holds it."""
    raw = star_input(spark, folder, "loan_daily")
    return widen(layers.silver_loans(raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])))


@query
def label_store(spark, folder):
    return label_rows(spark, folder)


@query
def bad_rate_by_mob(spark, folder):
    done = J.completed_loans(loans(spark, folder), "2000-01-01").where("installment_num <= 10")
    return rounded(R.bad_rate_curve(done, X.arrears_flag("dpd", 30)))


# ---- cleaning ---------------------------------------------------------------------------

@query
def money_parse(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.money("Annual_Income").alias("annual_income"),
                      C.money("Outstanding_Debt").alias("outstanding_debt"),
                      C.two_decimals("Monthly_Inhand_Salary").alias("monthly_inhand_salary"))


@query
def digits_parse(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.digits_int("Num_of_Delayed_Payment").alias("num_of_delayed_payment"))


@query
def plain_casts(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.to_int("Delay_from_due_date").alias("delay_from_due_date"),
                      C.to_double("Changed_Credit_Limit").alias("changed_credit_limit"),
                      C.to_int("Num_Credit_Inquiries").alias("num_credit_inquiries"))


@query
def interest_percent(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.interest_percent("Interst_Rate").alias("interest_rate"))


@query
def history_months(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.history_months("Credit_History_Age").alias("credit_history_age"))


@query
def loan_count(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.loan_count("Type_of_Loan").alias("num_of_loan"),
                      Q.parsed_loan_count("Type_of_Loan").cast("int").alias("parsed_count"))


@query
def null_tokens(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.category_title("Credit_Mix").alias("credit_mix"),
                      C.behaviour_text("Payment_Behaviour").alias("payment_behaviour"))


@query
def id_keys(spark, folder):
    raw = star_input(spark, folder, "financials")
    return raw.select("row_id", C.id_norm("Customer_ID").alias("customer_id"),
                      C.id_key(F.concat(F.lit("#"), "Customer_ID", F.lit(" .x"))).alias("cid_key"))


@query
def multi_date(spark, folder):
    raw = star_input(spark, folder, "date_texts")
    return raw.select("row_id", any_date("snapshot_date").alias("snapshot_date"))


@query
def month_filter(spark, folder):
    return J.filter_month(star_input(spark, folder, "date_texts"), "2022-03").select("row_id", "snapshot_date")


@query
def snapshot_filter(spark, folder):
    return widen(J.filter_snapshot(loans(spark, folder), "1998-03-01"))


@query
def date_range(spark, folder):
    rows = J.filter_dates(loans(spark, folder), "1997-01-01", "1997-06-01")
    return R.count_by(rows, ["snapshot_date"])


@query
def month_and_feature_date(spark, folder):
    rows = clean(spark, folder)
    return rows.select("row_id", month_key(rows.columns).alias("month_key"),
                       feature_date(rows.columns).alias("feat_date"))


@query
def silver_financials(spark, folder):
    return financials(spark, folder)


@query
def silver_attributes(spark, folder):
    return attributes(spark, folder)


@query
def silver_clickstream(spark, folder):
    return layers.silver_clickstream(star_input(spark, folder, "clickstream"), [F.desc("fe_1"), F.desc("fe_3")])


@query
def dedupe_latest(spark, folder):
    return financials_by_row(spark, folder).select("customer_id", "snapshot_date", "row_id")


@query
def bronze_months(spark, folder):
    """Bronze rows per month with a given load date, from the raw date texts."""
    raw = star_input(spark, folder, "date_texts")
    rows = J.with_lineage(raw, "2024-01-01", J.row_month(raw), F.lit("date_texts")).where("snap_ym is not null")
    return R.count_by(rows, ["snap_ym", "ingest_dt", "source_file"])


@query
def expected_columns(spark, folder):
    """A schema contract: missing columns as typed nulls, fixed order."""
    rows = clean(spark, folder)
    return J.ensure_columns(rows, {"row_id": "bigint", "interest_rate": "double", "region_code": "string",
                                   "num_of_loan": "int", "risk_score": "double"})


@query
def prefix_columns(spark, folder):
    raw = star_input(spark, folder, "clickstream")
    return J.select_prefix(raw, "fe_", keep=["row_id"])


# ---- gold features ----------------------------------------------------------------------

@query
def ratios(spark, folder):
    return clean(spark, folder).select("row_id", *[c.alias(n) for n, c in X.ratios().items()])


@query
def util_features(spark, folder):
    pairs = {n: c for n, c in X.bucket_pairs().items() if n.startswith("util_")}
    cols = {**X.utilisation(), **pairs, **X.interactions()}
    return rounded(clean(spark, folder).select("row_id", *[c.alias(n) for n, c in cols.items()]))


@query
def hist_inq_buckets(spark, folder):
    pairs = {n: c for n, c in X.bucket_pairs().items() if not n.startswith("util_")}
    return clean(spark, folder).select("row_id", *[c.alias(n) for n, c in pairs.items()])


@query
def missing_flags(spark, folder):
    return clean(spark, folder).select("row_id", *[c.alias(n) for n, c in X.missing_flags().items()])


@query
def behaviour_class(spark, folder):
    return clean(spark, folder).select(
        "row_id", X.yes_no("payment_of_min_amount").alias("minpay_flag"),
        X.behaviour_class("payment_behaviour").alias("pay_behav_coarse"))


@query
def loan_mix(spark, folder):
    rows = clean(spark, folder).select("row_id", X.loan_types("type_of_loan").alias("types"))
    return rows.select("row_id", *[c.alias(n) for n, c in X.loan_mix("types").items()])


@query
def gold_financials(spark, folder):
    return rounded(layers.gold_financials(financials(spark, folder))[0])


@query
def gold_financials_wide(spark, folder):
    return rounded(layers.gold_financials(financials(spark, folder))[1])


@query
def occupation_ohe(spark, folder):
    return layers.gold_attributes(attributes(spark, folder))[0]


@query
def gold_attributes_wide(spark, folder):
    return layers.gold_attributes(attributes(spark, folder))[1]


# ---- joins ------------------------------------------------------------------------------

FIN_PICK = ["row_id", "interest_rate", "dti", "util_bucket", "hist_bucket_idx", "pay_behav_coarse", "has_AUTO"]
ATT_PICK = ["is_occupation_null", "occ_ENGINEER", "occ_TEACHER"]


def fin_features(spark, folder):
    wide = layers.engineer_financials(financials_by_row(spark, folder))
    return wide.select(*K.FEATURE_KEYS, *FIN_PICK)


def att_features(spark, folder):
    return layers.gold_attributes(attributes(spark, folder))[0].select(*K.FEATURE_KEYS, *ATT_PICK)


@query
def asof_dataset(spark, folder):
    """Labels with the latest financials known on the label date."""
    return layers.gold_model_dataset(label_rows(spark, folder), [fin_features(spark, folder)],
                                     [[F.col("row_id").desc()]])


@query
def asof_multi(spark, folder):
    """Labels with the latest financials and attributes, both found in one pass."""
    return layers.gold_model_dataset(
        label_rows(spark, folder), [fin_features(spark, folder), att_features(spark, folder)],
        [[F.col("row_id").desc()], [F.col("is_occupation_null")]])


@query
def exact_dataset(spark, folder):
    return layers.gold_model_dataset_exact(
        label_rows(spark, folder), fin_features(spark, folder), att_features(spark, folder))


@query
def month_key_join(spark, folder):
    base = J.rename_customer(label_rows(spark, folder)).select(*K.MODEL_KEYS)
    return Y.month_key_join(base, [fin_features(spark, folder), att_features(spark, folder).drop("snap_ym")])


@query
def wide_base_join(spark, folder):
    """Days of a customer with the clickstream features of the same day."""
    clicks = layers.silver_clickstream(star_input(spark, folder, "clickstream"), [F.desc("fe_1"), F.desc("fe_3")])
    days = star_input(spark, folder, "clickstream").select(
        C.id_norm("Customer_ID").alias("customer_id"), F.col("snapshot_date").cast("date")).distinct()
    shifted = days.withColumn("customer_id", F.lower("customer_id"))
    return shifted.join(J.select_prefix(clicks, "fe_", ["customer_id", "snapshot_date"]),
                        ["customer_id", "snapshot_date"], "left")


@query
def labels_with_clicks(spark, folder):
    """Labels with the clickstream features of the same customer and month, the events dealt over the labels' months."""
    month = F.add_months(F.lit("1995-01-01").cast("date"), (F.col("row_id") % 82).cast("int"))
    raw = star_input(spark, folder, "clickstream").withColumns({
        "snapshot_date": month.cast("string"), "snap_ym": F.date_format(month, "yyyy-MM")})
    clicks = layers.silver_clickstream(raw, [F.desc("fe_1"), F.desc("fe_3")]).withColumnRenamed("customer_id", "Customer_ID")
    rows = with_clickstream(label_rows(spark, folder), clicks)
    return rows.select("loan_id", "Customer_ID", "snapshot_date", "label", "fe_1", "fe_2", "fe_3")


def _keyed(spark, folder):
    """Label, financial and attribute rows with match keys."""
    base = J.rename_customer(label_rows(spark, folder))
    return {"label": Y.with_match_keys(base),
            "fin": Y.with_match_keys(clean(spark, folder)),
            "att": Y.with_match_keys(attributes(spark, folder))}


@query
def key_overlap(spark, folder):
    return Y.key_overlap(_keyed(spark, folder), ["cid_key", "ym_key"])


@query
def key_overlap_sketch(spark, folder):
    """The same overlap from one sketch per source and month."""
    sketches = Y.key_sketches(_keyed(spark, folder), ["cid_key", "ym_key"], "ym_key")
    return Y.sketched_overlap(sketches, list(_keyed(spark, folder)))


@query
def id_overlap(spark, folder):
    return Y.key_overlap(_keyed(spark, folder), ["cid_key"])


@query
def overlap_pairs(spark, folder):
    frames = _keyed(spark, folder)
    return Y.overlap_rows(frames["label"], frames["fin"], ["cid_key", "ym_key"])


@query
def missing_keys(spark, folder):
    frames = _keyed(spark, folder)
    return Y.missing_keys(frames["label"], frames["fin"], ["cid_key", "ym_key"])


@query
def coverage(spark, folder):
    frames = _keyed(spark, folder)
    return rounded(Y.coverage(frames["label"], frames["att"], ["cid_key"]))


@query
def covered_categories(spark, folder):
    base = loans(spark, folder).withColumn("snapshot_date", F.add_months("snapshot_date", -12))
    return Q.attribute_mix(base, attributes(spark, folder))


@query
def attribute_coverage(spark, folder):
    base = loans(spark, folder).withColumn("snapshot_date", F.add_months("snapshot_date", -12))
    return rounded(Q.attribute_coverage(base, attributes(spark, folder)))


@query
def month_key_nulls(spark, folder):
    return Y.month_key_nulls(clean(spark, folder))


# ---- entity statistics ------------------------------------------------------------------

@query
def entity_stats(spark, folder):
    return rounded(E.entity_stats(star_input(spark, folder, "clickstream")))


@query
def entity_stats_state(spark, folder):
    """The same statistics merged from states by month."""
    clicks = star_input(spark, folder, "clickstream")
    return rounded(E.stats_of_states(E.entity_month_states(clicks), J.prefixed(clicks, "fe_")))


@query
def top_entities(spark, folder):
    stats = E.entity_stats(star_input(spark, folder, "clickstream"))
    return rounded(E.busiest_entities(stats, K.PREVIEW_ROWS).select("Customer_ID", "n_rows", "fe_1_max"))


# ---- profiling --------------------------------------------------------------------------

@query
def class_share(spark, folder):
    return rounded(R.class_share(label_rows(spark, folder)))


@query
def null_rates(spark, folder):
    return rounded(R.null_rates(financials(spark, folder), K.NULL_RATE_COLUMNS))


@query
def null_rates_by_month(spark, folder):
    return rounded(R.null_rates_by(financials(spark, folder), "snap_ym", K.NULL_RATE_COLUMNS))


@query
def filled_rates(spark, folder):
    return rounded(R.filled_rates(clean(spark, folder), ["annual_income", "interest_rate", "credit_mix"]))


@query
def value_ranges(spark, folder):
    return rounded(R.value_ranges(clean(spark, folder), list(K.VALUE_RANGES)))


@query
def out_of_range(spark, folder):
    return Q.out_of_range_rows(clean(spark, folder), "interest_rate").select("row_id", "interest_rate")


@query
def neg_share(spark, folder):
    return rounded(R.negative_share(clean(spark, folder), [*K.NON_NEGATIVE_COLUMNS, K.EARLY_PAYMENT_COLUMN]))


@query
def two_dp(spark, folder):
    frame = lines(spark, folder).withColumn("unit_price", F.col("price") / F.col("quantity"))
    return rounded(R.two_dp_share(frame, ["price", "unit_price"]))


@query
def duplicates(spark, folder):
    return R.duplicate_keys(clean(spark, folder), ["customer_id", "snapshot_date"])


@query
def distinct_keys(spark, folder):
    return R.distinct_keys(clean(spark, folder), ["customer_id", "snapshot_date"])


@query
def value_counts(spark, folder):
    return R.value_counts(clean(spark, folder), "credit_mix")


@query
def rows_per_snapshot(spark, folder):
    return R.rows_per_snapshot(loans(spark, folder))


@query
def label_rate_by_month(spark, folder):
    return rounded(R.label_rate_by_month(label_rows(spark, folder)))


@query
def label_rate(spark, folder):
    return rounded(R.label_rate(label_rows(spark, folder)))


@query
def months_present(spark, folder):
    return months_in(loans(spark, folder))


@query
def length_profile(spark, folder):
    return R.length_profile(attributes(spark, folder), "occupation")


@query
def profile(spark, folder):
    return rounded(R.describe(lines(spark, folder), NUMBERS), 5)


@query
def histogram(spark, folder):
    return rounded(R.histogram(lines(spark, folder), NUMBERS))


@query
def var_rank(spark, folder):
    return rounded(R.variance_rank(lines(spark, folder), NUMBERS), 3)


@query
def corr_matrix(spark, folder):
    return rounded(R.correlation_matrix(lines(spark, folder), NUMBERS))


@query
def label_corr(spark, folder):
    return rounded(R.label_correlation(lines(spark, folder), NUMBERS))


# ---- quality suites ---------------------------------------------------------------------

@query
def financials_quality(spark, folder):
    rows = financials(spark, folder).withColumn("ds_token", F.col("snap_ym"))
    return rounded(Q.financials_suite(rows), 4)


@query
def financials_quality_parsed(spark, folder):
    rows = financials(spark, folder).withColumn("ds_token", F.col("snap_ym"))
    return rounded(Q.financials_suite(rows, rule="parsed"), 4)


@query
def loan_count_mismatch(spark, folder):
    rows = Q.loan_count_mismatches(clean(spark, folder), rule="parsed")
    return rows.select("row_id", "type_of_loan", "num_of_loan", "recount")


@query
def label_store_quality(spark, folder):
    return rounded(Q.label_store_suite(label_rows(spark, folder)))


@query
def labels_of_mob(spark, folder):
    silver = loans(spark, folder)
    both = J.union_months([layers.gold_labels(silver, 30, 6), layers.gold_labels(silver, 30, 0)])
    return Q.labels_of_mob(both, 0)


@query
def positive_sample(spark, folder):
    return Q.positive_sample(label_rows(spark, folder))


@query
def attributes_quality(spark, folder):
    return Q.attributes_suite(attributes(spark, folder))


@query
def top_occupations(spark, folder):
    return Q.top_occupations(attributes(spark, folder))


@query
def layer_counts(spark, folder):
    return Q.layer_counts({"loan_daily": loans(spark, folder), "label_store": label_rows(spark, folder),
                           "attributes": attributes(spark, folder), "financials": financials(spark, folder)})


@query
def files_per_layer(spark, folder):
    return Q.files_per_layer({name: table(spark, folder, name) for name in ("orders", "lineitem", "customer")})


@query
def model_dataset_check(spark, folder):
    return rounded(Q.model_dataset_check(asof_dataset(spark, folder), ["dti", "util_bucket"]))


@query
def union_months(spark, folder):
    """Two monthly slices with different columns, united by name."""
    rows = clean(spark, folder).select("row_id", "snap_ym", "interest_rate", "num_of_loan")
    early = rows.where("snap_ym < '1998-01'").drop("num_of_loan")
    late = rows.where("snap_ym >= '1998-01'").drop("interest_rate")
    return J.union_months([early, late])


# ---- splits -----------------------------------------------------------------------------

@query
def time_split(spark, folder):
    rows = S.time_split(lines(spark, folder), STAR_SPLITS)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_pos"),
                                     F.min("snapshot_date").alias("first_day"))


@query
def split_summary(spark, folder):
    # Labels are far from a rounding tie at two places; the oracle rounds the same ratio.
    return S.split_summary(S.time_split(lines(spark, folder), STAR_SPLITS))


def _windows(spark, folder, mode):
    rows = S.rolling_windows(label_rows(spark, folder), "1995-06-01", "2001-12-01", mode)
    return rows.groupBy("run_month", "split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_pos"))


@query
def rolling_windows(spark, folder):
    return _windows(spark, folder, "month")


@query
def rolling_windows_days(spark, folder):
    return _windows(spark, folder, "days")


@query
def training_split(spark, folder):
    rows = S.training_split(lines(spark, folder), "1999-09-01")
    return R.count_by(rows, ["split"])


def _stratified(spark, folder):
    return S.stratified_split(lines(spark, folder), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def strat_split(spark, folder):
    return _stratified(spark, folder).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "label", "part")


@query
def strat_sizes(spark, folder):
    return R.count_by(_stratified(spark, folder), ["label", "part"])


# ---- preprocessing ----------------------------------------------------------------------

@query
def impute(spark, folder):
    """Financials with medians and modes filled in."""
    rows = clean(spark, folder).select("row_id", "annual_income", "interest_rate", "num_credit_inquiries",
                                       "credit_mix", "payment_behaviour")
    fills = P.fill_values(rows, ["annual_income", "interest_rate", "num_credit_inquiries"],
                          ["credit_mix", "payment_behaviour"])
    return rounded(P.impute(rows, fills), 4)


@query
def medians(spark, folder):
    return rounded(P.medians(lines(spark, folder), NUMBERS), 5)


@query
def modes(spark, folder):
    return P.modes(clean(spark, folder), ["credit_mix", "payment_behaviour", "payment_of_min_amount"])


@query
def scale(spark, folder):
    """Prices and quantities scaled by the statistics of the training years."""
    rows = lines(spark, folder).select("l_orderkey", "l_partkey", "quantity", "price", "tax", "snapshot_date")
    fit_on = rows.where("snapshot_date < '1998-01-01'")
    return rounded(P.standardise(rows, ["quantity", "price", "tax"], fit_on), 6)


# ---- metrics ----------------------------------------------------------------------------

def _metrics(spark, folder):
    return M.ranking_metrics(M.score_curve(scored_long(spark, folder), ["model", "split"]), ["model", "split"])


@query
def roc_auc(spark, folder):
    return rounded(_metrics(spark, folder).select("model", "split", "n_pos", "n_neg", "roc_auc"))


@query
def avg_precision(spark, folder):
    return rounded(_metrics(spark, folder).select("model", "split", "pr_auc"))


@query
def gini(spark, folder):
    return rounded(_metrics(spark, folder).select(
        "model", "split", M.gini(F.col("roc_auc"), 6).alias("gini")))


@query
def score_curve(spark, folder):
    """Hits and false alarms at every distinct score."""
    return M.score_curve(scored_long(spark, folder), ["model", "split"]).select(
        "model", "split", "score", "pos", "neg", "tp", "fp")


@query
def confusion(spark, folder):
    return rounded(M.confusion(scored_long(spark, folder), ["model", "split"], threshold=0.5))


@query
def best_f1(spark, folder):
    curve = M.score_curve(scored_long(spark, folder), ["model", "split"])
    return rounded(M.best_threshold(curve, ["model", "split"]), 9, skip=("threshold",))


@query
def metric_grid(spark, folder):
    return rounded(M.metric_grid(scored_long(spark, folder)), skip=("threshold",))


@query
def compare_models(spark, folder):
    return rounded(M.compare_models(M.metric_grid(scored_long(spark, folder))), skip=("tuned_threshold",))


@query
def apply_thresholds(spark, folder):
    """Scored rows with the tuned threshold of their model, counted by decision."""
    long = scored_long(spark, folder)
    tuned = L.tuned_thresholds(M.metric_grid(long))
    return R.count_by(L.apply_thresholds(long, tuned), ["model", "split", "threshold", "pred"])


# ---- monitoring -------------------------------------------------------------------------

@query
def trend(spark, folder):
    return rounded(O.trend(star_input(spark, folder, "scored")))


@query
def trend_state(spark, folder):
    """The trend from the merged states of two halves of the rows, as a later run would add to an earlier one's."""
    scored = star_input(spark, folder, "scored")
    halves = [scored.where(F.pmod(F.xxhash64("loan_id", "line_no"), F.lit(2)) == half) for half in (0, 1)]
    sums = O.merge_sums(reduce(DataFrame.unionByName, [O.batch_sums(h) for h in halves]))
    counts = O.merge_counts(reduce(DataFrame.unionByName, [O.batch_counts(h) for h in halves]))
    return rounded(O.trend_of_state(sums, counts))


@query
def labels_join(spark, folder):
    """Scored rows with store labels by snapshot and loan; conflicting labels give two rows."""
    scored = star_input(spark, folder, "scored").drop("label")
    joined = O.join_labels(scored, label_rows(spark, folder))
    return joined.select("snapshot_date", "loan_id", "line_no", "proba_lr", "label")


@query
def trend_joined(spark, folder):
    scored = star_input(spark, folder, "scored").drop("label")
    return rounded(O.trend(scored, label_rows(spark, folder)))


@query
def primary_metrics(spark, folder):
    lines_ = O.primary_metrics(O.trend(star_input(spark, folder, "scored")))
    return rounded(O.enough_points(lines_))


# ---- models (no SQL counterpart) ----------------------------------------------------------

def _model_frame(spark, folder):
    return S.time_split(lines(spark, folder), STAR_SPLITS).select(
        "split", "snapshot_date", "label", *NUMBERS, "l_linestatus")


def _graded(parts, models):
    scored = L.score(parts, {n: (m, K.DEFAULT_THRESHOLD) for n, m in models.items()}, ["split", "label"])
    return M.metric_grid(M.melt_models(scored, {n: f"proba_{n}" for n in models}, ["split", "label"]))


def _features():
    return L.Features(tuple(NUMBERS), ("l_linestatus",))


@query
def train_score_lr(spark, folder):
    parts = _model_frame(spark, folder)
    model = L.fit_logistic(parts.where("split in ('Train', 'Valid')"), _features())
    return _graded(parts, {"lr": model})


@query
def train_score_gbt(spark, folder):
    parts = _model_frame(spark, folder)
    model = L.fit_boosted(parts.where("split = 'Train'"), parts.where("split = 'Valid'"), _features())
    # Every row goes down all trees, so all tasks share the rows, however few row groups their file has.
    tasks = max(spark.sparkContext.defaultParallelism, parts.rdd.getNumPartitions())
    return _graded(parts.repartition(tasks), {"xgb": model})


@query
def search(spark, folder):
    parts = _model_frame(spark, folder)
    _, tuned = L.search(parts.where("split = 'Train'"), NUMBERS, scoring="hard")
    rows = [(i, float(score)) for i, score in enumerate(tuned.avgMetrics)]  # one row per draw
    return spark.createDataFrame(rows, "draw int, mean_score double")


@query
def ingest_available_now(spark, folder):
    """Raw files written from the tables, streamed through all layers, counted per layer."""
    from creditmart.plans.jobs import Mart
    from creditmart.sources.readers import text_schema
    from creditmart.streaming.ingest import ingest_available

    root = f"{checkpoint_dir(spark).rstrip('/')}/creditmart-ingest-{spark.sql('select uuid()').first()[0]}"
    schemas = {}
    for name, target in (("loan_daily", "lms_loan_daily"), ("attributes", "feature_attributes"),
                         ("financials", "features_financials"), ("clickstream", "feature_clickstream")):
        # Many files: those with line breaks inside quotes are read by one task each.
        raw = star_input(spark, folder, name, spread=True).drop(*K.LINEAGE, "row_id")
        schemas[name] = text_schema(raw.columns)
        with shuffles_dropped(spark):
            raw.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{root}/raw/{target}")
    ingest_available(spark, root, f"{root}/raw", schemas, f"{root}/checkpoints", "2024-01-01")
    mart = Mart(spark, root)
    counts = Q.layer_counts({t: mart.all_months(t) for t in (
        "bronze/loan_daily", "silver/financials", "silver/clickstream", "gold/label_store", "gold/model_dataset")})
    rows = counts.collect()  # one row per table, taken before the scratch folder goes
    remove_folder(spark, root)
    return spark.createDataFrame(rows, counts.schema)


