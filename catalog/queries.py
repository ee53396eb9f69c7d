"""One entry per operator; each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as I
from tidemark import session, sources
from tidemark.functions import (
    edge_bin,
    exclude_patterns,
    matches_any,
    measure_family,
    month_flag,
    period_end,
    period_shift,
    period_start,
    round_even,
    trailing_windows,
)
from tidemark.operators import (
    audience,
    datasets,
    evaluation,
    features,
    metrics,
    prep,
    ranking,
    registry,
    resampling,
    scoring,
    selection,
    stages,
    target,
    training,
)
from tidemark.plans import campaign

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

KEY = campaign.KEY
MODEL, RUN, TRAIN_RUN = "1-URGENT", "20240201000000", "20240101000000"
NEXT_MONTH = date(2024, 2, 1)
PRICE_EDGES = [0, 50000, 100000, 200000, 300000, 400000, 1000000]
RANK_EDGES = list(range(11))


def query(fn: Query) -> Query:
    # A trailing underscore keeps a query's name apart from the function it exercises.
    _QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.withColumns({c: round_even(F.col(c), places) for c in cols})


def stored_pairs(spark, sf) -> DataFrame:
    """Rank operators read their input more than once: the join is computed once and kept."""
    return session.stored(I.regression_pairs(spark, sf), "pairs")


def stored_documents(spark, sf) -> DataFrame:
    return session.stored(I.scored_documents(spark, sf), "scored")


# --- sources and sinks -----------------------------------------------------------------------


@query
def scan_parquet(spark, sf):
    li = I.table(spark, sf, "lineitem")
    return li.where(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query
def sql_source(spark, sf):
    text = """
        SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top
        FROM {orders}
        WHERE o_orderdate >= :first AND o_orderdate < :next AND o_orderstatus <> :skipped
        GROUP BY o_orderpriority"""
    args = {"first": date(1998, 7, 1), "next": date(1998, 8, 1), "skipped": "P"}
    return sources.run_query(spark, text, args, {"orders": I.table(spark, sf, "orders")})


@query
def snapshot_roundtrip(spark, sf):
    """One month built and then reused as stored, another written and overwritten."""
    path = session.work_path(spark, "snapshot")
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sources.materialize(lambda: orders.where("o_orderstatus = 'P'"), spark, path, "199807")
    sources.write_snapshot(orders.where("o_orderstatus = 'F'"), path, "199808")
    sources.write_snapshot(orders.where("o_orderstatus = 'O'"), path, "199808")
    kept = sources.materialize(lambda: orders.where("o_orderstatus = 'F'"), spark, path, "199807")
    return kept.unionByName(sources.read_dataset(spark, path, "199808"))


@query
def append_roundtrip(spark, sf):
    """Three appends without a header, read back by position."""
    path = session.work_path(spark, "append")
    orders = I.table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    for status in ("F", "O", "P"):
        sources.append_rows(orders.where(F.col("o_orderstatus") == status), path, columns, "csv")
    return sources.read_rows(spark, path, orders.select(*columns).schema, "csv")


@query
def append_runs(spark, sf):
    """Appends keyed by run: one of them is tried again, and its rows are there once."""
    path = session.work_path(spark, "append")
    orders = I.table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice"]
    for status in ("F", "O", "P", "O"):
        sources.append_run(orders.where(F.col("o_orderstatus") == status), path, columns, f"run-{status}")
    return spark.read.parquet(path).select("append_run", *columns)


# --- projections and filters -----------------------------------------------------------------


@query
def audience_active(spark, sf):
    return campaign.active_customers(I.sources(spark, sf), I.RULES)


@query
def pattern_filter(spark, sf):
    n = I.notifications(spark, sf)
    return (
        n.where(exclude_patterns(F.col("batch_id"), ["%BLOCKED%", "%CG"]))
        .where(matches_any(F.col("campaign_id"), I.RULES.campaign_patterns))
        .groupBy("batch_id", "campaign_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def month_flag_(spark, sf):
    flag = month_flag(F.col("o_orderdate"), period_start("199807"), period_end("199807"))
    return I.table(spark, sf, "orders").select("o_orderkey", flag.alias("flag"))


@query
def presence_flag_(spark, sf):
    urgent = I.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return audience.presence_flag(I.table(spark, sf, "customer").select("c_custkey"), urgent, "c_custkey", "has_urgent")


@query
def drop_columns(spark, sf):
    return audience.drop_columns(I.table(spark, sf, "part"), ["p_name", "p_type"])


@query
def measure_families(spark, sf):
    a = I.monthly_activity(spark, sf)
    amount = measure_family([F.col("price"), F.col("tax"), F.col("discount")])
    count = measure_family([F.col("units"), F.col("odd_lines")])
    return a.groupBy(KEY, "month_id").agg(F.sum(amount).alias("tpv"), F.sum(count).alias("tpn"))


@query
def period_shift_(spark, sf):
    day = F.to_date("o_orderdate")
    return I.table(spark, sf, "orders").select(
        "o_orderkey",
        period_shift(F.date_format(day, "yyyyMM"), -3).alias("three_months_before"),
        period_shift(F.date_format(day, "yyyy-MM-dd"), 2, "week").alias("two_weeks_after"),
    )


@query
def edge_bin_(spark, sf):
    return I.table(spark, sf, "lineitem").groupBy(
        edge_bin(F.col("l_quantity"), [1, 10, 20, 30, 45]).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))


# --- joins -----------------------------------------------------------------------------------


@query
def star_join(spark, sf):
    src = I.sources(spark, sf)
    base = I.table(spark, sf, "customer").select(F.col("c_custkey").alias(KEY))
    return audience.star_join(
        base,
        [
            campaign.current_segments(src, I.RULES),
            campaign.balance_features(src, I.MONTH),
            campaign.consent_flags(src, I.RULES, I.MONTH),
            src.card_accounts.withColumnRenamed("status", "card_status"),
        ],
        KEY,
    )


@query
def exclude_members(spark, sf):
    src = I.sources(spark, sf)
    people = I.table(spark, sf, "customer").select(F.col("c_custkey").alias(KEY), "c_name")
    return audience.exclude_members(people, campaign.current_employees(src, I.RULES), KEY)


@query
def require_activity(spark, sf):
    people = I.table(spark, sf, "customer").select(F.col("c_custkey").alias(KEY), "c_name")
    window = trailing_windows(I.MONTH)[0]
    active = I.monthly_activity(spark, sf).where(window.holds_month_id(F.col("month_id")))
    return audience.require_activity(people, active, KEY)


@query
def unnest_limits(spark, sf):
    rows = target.unnest(I.external_cards(spark, sf), "limits")
    return rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("limits"), round_even(F.sum("amount"), 2).alias("amount"))


@query
def training_set(spark, sf):
    src = I.sources(spark, sf)
    pub = campaign.active_customers(src, I.RULES)
    feats = campaign.balance_features(src, I.MONTH)
    goal = campaign.customer_target(I.external_cards(spark, sf), as_of=F.col("since") < F.lit("1998-08-01").cast("date"))
    return datasets.training_set(pub, feats, goal, KEY, drop=["SALDO_EM_CONTA90"])


@query
def scoring_set(spark, sf):
    src = I.sources(spark, sf)
    ahead = "199809"
    return datasets.scoring_set(campaign.active_customers(src, I.RULES), campaign.balance_features(src, ahead), KEY)


@query
def evaluation_set(spark, sf):
    pub = campaign.campaign_audience(I.sources(spark, sf), I.RULES, "199809")
    return datasets.evaluation_set(pub, campaign.customer_target(I.external_cards(spark, sf)), KEY)


@query
def join_scores_labels(spark, sf):
    labels = I.table(spark, sf, "labels").select("doc_id", F.nullif("quality", F.lit(0)).alias("target"))
    scores = I.table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("SCORES"))
    return datasets.join_scores_labels(labels, scores, "doc_id")


# --- aggregates ------------------------------------------------------------------------------


@query
def event_counts(spark, sf):
    e = F.col("event_type")
    return I.notifications(spark, sf).where(e.isin("shown", "open")).groupBy(KEY).agg(
        F.sum(features.event_count(e == "shown").value).alias("shown"),
        F.sum(features.event_count(e == "open").value).alias("opened"),
    )


@query
def first_event_dates(spark, sf):
    e, day = F.col("event_type"), F.col("event_date")
    shown, opened = features.first_when(e == "shown", day), features.first_when(e == "open", day)
    return I.notifications(spark, sf).groupBy(KEY).agg(
        shown.agg(shown.value).alias("first_shown"), opened.agg(opened.value).alias("first_open")
    )


@query
def monthly_max_balance(spark, sf):
    return campaign.balance_features(I.sources(spark, sf), I.MONTH)


@query
def trailing_features(spark, sf):
    """Notification counts of three months and of the campaign to date, one scan."""
    return campaign.notification_counts(I.sources(spark, sf), I.RULES, I.MONTH)


@query
def trailing_weeks(spark, sf):
    e = F.col("event_type")
    measures = {
        "views": features.event_count(e == "view"),
        "clicks": features.event_count(e == "click"),
        "first_click": features.first_when(e == "click", F.to_date("ts")),
        "top_value": features.highest(F.col("value")),
    }
    windows = trailing_windows("2024-01-29", unit="week", suffixes=["_w1", "_w2", "_w3"])
    return features.trailing_features(I.table(spark, sf, "events"), "user_id", "ts", windows, measures)


@query
def history_to_date(spark, sf):
    e = F.col("event_type")
    measures = {"shown": features.event_count(e == "shown"), "first_open": features.first_when(e == "open", F.col("event_date"))}
    return features.history_to_date(I.notifications(spark, sf), KEY, "event_date", F.lit(period_end("199807")), measures)


@query
def distinct_members(spark, sf):
    return audience.distinct_members(I.consents(spark, sf), KEY, F.upper("consent_type") == "OUT")


@query
def capped_count_target(spark, sf):
    return campaign.customer_target(I.external_cards(spark, sf))


@query
def latest_per_key(spark, sf):
    return features.latest_per_key(I.table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_orderkey")


@query
def latest_scores(spark, sf):
    return scoring.latest_scores(I.score_history(spark, sf), MODEL, date(1998, 7, 1))


@query
def dataset_profile(spark, sf):
    return datasets.profile(I.model_rows(spark, sf), "target", "train")


@query
def null_profile(spark, sf):
    return datasets.null_profile(campaign.notification_counts(I.sources(spark, sf), I.RULES, I.MONTH))


# --- the campaign's own tables ---------------------------------------------------------------


@query
def campaign_audience(spark, sf):
    return campaign.campaign_audience(I.sources(spark, sf), I.RULES, I.MONTH)


@query
def customer_features(spark, sf):
    return campaign.customer_features(I.sources(spark, sf), I.RULES, I.MONTH)


@query
def customer_scoring_base(spark, sf):
    return campaign.customer_scoring_base(I.sources(spark, sf), I.RULES, I.MONTH)


# --- order -----------------------------------------------------------------------------------


@query
def global_rank(spark, sf):
    """Five levels, each a fifth of the rows: heavy ties, broken by the key."""
    return ranking.global_rank(I.scored_orders(spark, sf).select("id", "level"), "level", "id")


@query
def rank_timestamps(spark, sf):
    """Order times without a zone, many of them shared."""
    return ranking.global_rank(I.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query
def rank_decimal_ties(spark, sf):
    """Totals in steps of a hundred thousand: a few decimals hold almost all rows."""
    step = F.floor(F.col("o_totalprice") / 100000).cast("decimal(12,2)").alias("step")
    return ranking.global_rank(I.table(spark, sf, "orders").select("o_orderkey", step), "step", "o_orderkey")


@query
def rank_string_key(spark, sf):
    """Priorities as text, ties broken by a key that is text too."""
    key = F.concat(F.lit("order-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("key")
    return ranking.global_rank(I.table(spark, sf, "orders").select(key, "o_orderpriority"), "o_orderpriority", "key")


@query
def decile(spark, sf):
    return ranking.quantile_bin(I.scored_orders(spark, sf).select("id", "p0"), "p0", "id", 10, "decile")


@query
def decile_ties(spark, sf):
    return ranking.quantile_bin(I.scored_orders(spark, sf).select("id", "level"), "level", "id", 7, "bin")


@query
def percentile_bins(spark, sf):
    """More bins than a chain of comparisons should hold."""
    return ranking.quantile_bin(I.scored_orders(spark, sf).select("id", "p0"), "p0", "id", 100, "bin")


@query
def rank_edge_bins(spark, sf):
    """Fixed edges over the rank: rows beyond the last edge have no bin."""
    return ranking.rank_edge_bin(I.scored_orders(spark, sf).select("id", "p1"), "p1", "id", RANK_EDGES)


@query
def sample_n(spark, sf):
    return datasets.sample_n(I.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000, 7)


@query
def train_test_split(spark, sf):
    return datasets.split(I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 0.2, 42)


@query
def undersample(spark, sf):
    return datasets.undersample(I.model_rows(spark, sf).select("id", "status", "target"), "target", "id", 42)


@query
def sorted_series(spark, sf):
    out = metrics.sorted_series(stored_pairs(spark, sf), "y", "pred", "id")
    return rounded(out, 6, "log_actual", "log_predicted")


# --- preparation -----------------------------------------------------------------------------


@query
def impute_categorical(spark, sf):
    rows = I.app_devices(spark, sf).select(KEY, "token", "platform")
    return prep.impute_constant(rows, cats=["token", "platform"])


@query
def impute_numeric(spark, sf):
    """NULL where a customer has no rows, NaN where the discount is zero."""
    li = I.table(spark, sf, "lineitem")
    odd = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).when(F.col("l_tax") > 0, F.col("l_discount"))
    rows = prep.impute_constant(li.select("l_orderkey", odd.alias("x"), F.nullif("l_linenumber", F.lit(3)).alias("n")), nums=["x", "n"])
    per_order = rows.groupBy("l_orderkey").agg(F.sum("x").alias("x"), F.max("x").alias("top"), F.sum("n").alias("n"))
    return rounded(per_order, 4, "x")


@query
def target_encode(spark, sf):
    rows = I.model_rows(spark, sf).select("id", "priority", "status", "target")
    additive = prep.fit_target_encoder(rows, ["priority", "status"], "target", "additive", smoothing=20.0)
    sigmoid = prep.fit_target_encoder(rows, ["priority"], "target", "sigmoid", smoothing=500.0, min_samples=3000.0)
    out = sigmoid.transform(additive.transform(rows), "_sig")
    return rounded(out, 6, "priority_enc", "status_enc", "priority_sig")


@query
def minmax_scale(spark, sf):
    rows = I.table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price"), F.lit(3.0).alias("flat"))
    return rounded(prep.fit_minmax(rows, ["size", "price", "flat"]).transform(rows), 9, "size", "price", "flat")


@query
def variance_filter(spark, sf):
    rows = I.table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", F.lit(1.0).alias("flat"), "l_linenumber")
    table = prep.column_variances(rows, rows.columns).where(F.col("variance") > 0.00065)
    return rounded(table, 6, "variance")


@query
def prep_features(spark, sf):
    """Impute, encode and assemble as one fitted pipeline; the feature vector by position."""
    rows = I.model_rows(spark, sf).withColumn("status", F.nullif("status", F.lit("P")))
    model = prep.fit_prep(rows, ["priority", "status"], ["price", "month", "weekday"], "target", t=1e-8, smoothing=20.0)
    x = vector_to_array(F.col("features"))
    names = ["priority_enc", "status_enc", "price", "month", "weekday"]
    return model.transform(rows).select("id", *[round_even(x[i], 6).alias(n) for i, n in enumerate(names)])


# --- scores and evaluation -------------------------------------------------------------------


@query
def score_table_class(spark, sf):
    rows = I.scored_orders(spark, sf)
    return scoring.score_table_class(rows, "id", "p0", "p1", "propensity", NEXT_MONTH, RUN, TRAIN_RUN)


@query
def score_table_regr(spark, sf):
    rows = I.regression_pairs(spark, sf)
    return scoring.score_table_regr(rows, "id", "pred", PRICE_EDGES, "potential", NEXT_MONTH, RUN, TRAIN_RUN)


@query
def score_table_regr_rank(spark, sf):
    rows = stored_pairs(spark, sf)
    return scoring.score_table_regr(rows, "id", "pred", RANK_EDGES, "potential", NEXT_MONTH, RUN, TRAIN_RUN, on="rank")


@query
def binned_calibration(spark, sf):
    rows = I.scored_orders(spark, sf).select("id", "p1", "target")
    out = scoring.binned_calibration(rows, "p1", "target", 20, "id")
    return rounded(out, 6, "p1", "calibrated")


@query
def binned_calibration_edges(spark, sf):
    """Lower scores than those of the fit, in the bins of the fit."""
    rows = I.scored_orders(spark, sf).select("id", "p1", "target")
    new = rows.select("id", (F.col("p1") * F.lit(0.75)).alias("p1"))
    out = scoring.binned_calibration(rows, "p1", "target", 20, "id", new, edges="training")
    return rounded(out.select("id", "bin", "calibrated", "prediction"), 6, "calibrated")


@query
def optimal_threshold(spark, sf):
    out = metrics.optimal_threshold(stored_documents(spark, sf), "p1", "target")
    return rounded(out, 9, "threshold", "fpr", "tpr", "gmean")


@query
def apply_threshold(spark, sf):
    rows = I.scored_orders(spark, sf)
    return metrics.apply_threshold(rows, "p1", 0.55).groupBy("target", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query
def classification_report(spark, sf):
    rows = metrics.apply_threshold(I.scored_orders(spark, sf), "p1", 0.55)
    return rounded(metrics.classification_report(rows, "target", "prediction"), 9, "precision", "recall", "f1_score")


@query
def roc_points(spark, sf):
    out = metrics.roc_points(stored_documents(spark, sf), "p1", "target")
    return rounded(out, 9, "threshold", "fpr", "tpr")


@query
def roc_points_all(spark, sf):
    out = metrics.roc_points(I.scored_orders(spark, sf), "level", "target", drop_collinear=False)
    return rounded(out, 9, "fpr", "tpr")


@query
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(I.scored_orders(spark, sf), "p1", "target"), 10, "roc_auc")


@query
def calibration_curve(spark, sf):
    out = metrics.calibration_curve(I.scored_orders(spark, sf), "p1", "target")
    return rounded(out, 6, "prob_pred", "prob_true")


@query
def best_f1(spark, sf):
    rows = I.scored_orders(spark, sf)
    logs, linear = metrics.best_f1(rows, "p1", "target", 100), metrics.best_f1(rows, "p1", "target", 50, log_scale=False)
    both = logs.withColumn("cuts", F.lit("log")).unionByName(linear.withColumn("cuts", F.lit("linear")))
    return rounded(both, 9, "best_f1")


@query
def lift_table(spark, sf):
    return evaluation.lift_table(I.scored_orders(spark, sf), "p0", "target", 10, "id")


@query
def lift_ties(spark, sf):
    return evaluation.lift_table(I.scored_orders(spark, sf), "level", "target", 10, "id")


@query
def eval_table_class(spark, sf):
    lift = evaluation.lift_table(I.scored_orders(spark, sf), "p0", "target", 10, "id")
    return evaluation.eval_table_class(lift, "propensity", NEXT_MONTH, RUN, TRAIN_RUN)


@query
def confusion_bins(spark, sf):
    return metrics.confusion_bins(I.regression_pairs(spark, sf), "y", "pred", PRICE_EDGES)


@query
def confusion_bins_rank(spark, sf):
    edges = [0, 100, 1000, 5000, 9000]
    return metrics.confusion_bins(stored_pairs(spark, sf), "y", "pred", edges, on="rank", key="id")


@query
def confusion_pivot(spark, sf):
    cells = metrics.confusion_bins(I.regression_pairs(spark, sf), "y", "pred", PRICE_EDGES)
    return metrics.confusion_pivot(cells, PRICE_EDGES)


@query
def eval_table_regr(spark, sf):
    cells = metrics.confusion_bins(I.regression_pairs(spark, sf), "y", "pred", PRICE_EDGES)
    return evaluation.eval_table_regr(cells, "potential", NEXT_MONTH, RUN, TRAIN_RUN)


@query
def regression_metrics(spark, sf):
    out = metrics.regression_metrics(I.regression_pairs(spark, sf), "y", "pred")
    return rounded(out.withColumn("mse", F.col("mse") / 1e6), 6, "r2", "pearson", "mae", "mse")


@query
def spearman(spark, sf):
    return rounded(metrics.spearman(stored_pairs(spark, sf), "y", "pred", "id"), 8, "spearman")


@query
def score_histogram(spark, sf):
    out = metrics.score_histogram(I.scored_orders(spark, sf), "p1", "target", 20)
    return rounded(out, 6, "bin_start", "density")


# --- registry --------------------------------------------------------------------------------


@query
def best_model(spark, sf):
    return registry.best_model(I.registry(spark, sf), MODEL, date(1998, 8, 1))


@query
def latest_trained(spark, sf):
    return registry.latest_trained(I.registry(spark, sf), MODEL, date(1998, 8, 1))


@query
def champion_decision(spark, sf):
    """Every run from 1998 on against the champions of the years before."""
    runs = I.registry(spark, sf)
    before, after = runs.where("SAFRA < DATE '1998-01-01'"), runs.where("SAFRA >= DATE '1998-01-01'")
    return registry.champion_decision(before.where("MODEL_NAME <> '5-LOW'"), after, tolerance=15)


@query
def select_model(spark, sf):
    runs = I.registry(spark, sf)
    champions = runs.where("METRIC >= 40")
    picks = [registry.select_model(runs, c, MODEL, date(1998, 8, 1)) for c in (champions, None, champions.where("METRIC > 100"))]
    cases = ["in_use", "not_in_use", "none_yet"]
    first, *rest = [p.withColumn("case", F.lit(c)) for p, c in zip(picks, cases)]
    for p in rest:
        first = first.unionByName(p)
    return first


# --- models (no SQL counterpart) -------------------------------------------------------------

_TREES = {"maxIter": 20, "maxDepth": 3, "seed": 1}
_NUMBERS = ["price", "month", "weekday"]


def _prepared(spark, sf):
    rows = I.model_rows(spark, sf)
    model = prep.fit_prep(rows, ["priority", "status"], _NUMBERS, "target")
    return model, model.transform(rows).select("id", "target", "price", "month", "weekday", "features")


@query
def fit_classifier(spark, sf):
    _, rows = _prepared(spark, sf)
    model = training.fit_model(rows, "classification", _TREES, unbalanced=True)
    return scoring.batch_score(model, rows, "id")


@query
def fit_facts(spark, sf):
    """What must hold of any fitted classifier's scores: all rows, probabilities, and far better than chance."""
    _, rows = _prepared(spark, sf)
    model = training.fit_model(rows, "classification", _TREES, unbalanced=True)
    scored = session.stored(scoring.batch_score(model, rows, "id").join(rows.select("id", "target"), "id"), "scored")
    facts = scored.agg(F.count("*").alias("n_rows"), F.count_if(F.abs(F.col("p0") + F.col("p1") - 1) < 1e-9).alias("n_sum_one"), F.sum("target").alias("n_positive"))
    auc = metrics.roc_auc(scored, "p1", "target").first()["roc_auc"]
    return facts.withColumn("better_than_chance", F.lit(auc >= 0.9))


@query
def fit_regressor(spark, sf):
    _, rows = _prepared(spark, sf)
    model = training.fit_model(rows, "regression", _TREES, label="price")
    return scoring.batch_score(model, rows, "id", "regression")


@query
def model_roundtrip(spark, sf):
    """Fit, save, load, score."""
    prepared, rows = _prepared(spark, sf)
    from pyspark.ml import PipelineModel

    fitted = training.fit_model(rows, "classification", _TREES)
    uri = session.work_path(spark, "models")
    sources.save_model(PipelineModel(stages=[*prepared.stages, fitted]), uri, "propensity", "199808", RUN)
    return scoring.batch_score(sources.load_model(uri, "propensity", "199808", RUN), I.model_rows(spark, sf), "id")


@query
def model_roundtrip_differences(spark, sf):
    """Rows whose score differs between a model and the one read back."""
    from pyspark.ml import PipelineModel

    prepared, rows = _prepared(spark, sf)
    model = PipelineModel(stages=[*prepared.stages, training.fit_model(rows, "classification", _TREES)])
    uri = session.work_path(spark, "models")
    sources.save_model(model, uri, "propensity", "199808", RUN)
    raw = I.model_rows(spark, sf)
    before = scoring.batch_score(model, raw, "id").withColumnRenamed("p1", "before").drop("p0")
    after = scoring.batch_score(sources.load_model(uri, "propensity", "199808", RUN), raw, "id")
    return before.join(after, "id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("before") != F.col("p1")).alias("n_different"))


@query
def saved_threshold_differences(spark, sf):
    """Rows whose class from a saved, calibrated model is not what its threshold makes of its probability."""
    from pyspark.ml import PipelineModel

    prepared, rows = _prepared(spark, sf)
    fit, own = datasets.train_test(rows, "id", 0.3, 7)
    fitted = training.fit_model(fit, "classification", _TREES)
    last = stages.fit_score_calibration(fitted.transform(own), "target", "isotonic", threshold=True)
    uri = session.work_path(spark, "models")
    sources.save_model(PipelineModel(stages=[*prepared.stages, fitted, last]), uri, "calibrated", "199808", RUN)
    read = sources.load_model(uri, "calibrated", "199808", RUN)
    out = read.transform(I.model_rows(spark, sf)).select("prediction", vector_to_array("probability")[1].alias("p1"))
    told = metrics.apply_threshold(out, "p1", read.stages[-1].getOrDefault("threshold"), "told")
    return told.agg(F.count("*").alias("n_rows"), F.count_if(F.col("told") != F.col("prediction")).alias("n_different"))


@query
def isotonic_levels(spark, sf):
    """Returned lines by quantity, fitted by a function that never falls: its value at each quantity."""
    rows = I.table(spark, sf, "lineitem").select(F.col("l_quantity").alias("level"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    fitted = training.fit_calibration(rows, "level", "y", "isotonic")
    return rounded(fitted.transform(rows.select("level").distinct(), "value"), 9, "value")


@query
def hyperparameter_search(spark, sf):
    """27 trials on a tenth of the rows, 9 of them on four tenths, 3 on all."""
    return _searched(spark, sf, 27, (0.1, 0.4, 1.0), 10).trials


def _searched(spark, sf, trials, rungs, rounds):
    _, rows = _prepared(spark, sf)
    space = {"stepSize": ("loguniform", 0.01, 0.3), "maxDepth": ("categorical", [2, 3, 4]), "minInstancesPerNode": ("int", 1, 50)}
    fixed = {"maxIter": rounds, "seed": 1}
    return training.search(
        rows, "id", "classification", space, training.mean_squared_error, "minimize", trials, 42, params=fixed, rungs=rungs, parallel=4
    )


@query
def search_facts(spark, sf):
    """What must hold of any search: trials a rung, and one best, which none of the last rung beats."""
    found = _searched(spark, sf, 9, (0.3, 1.0), 3)
    last = F.col("rung") == 1
    facts = found.trials.agg(F.count_if(~last).alias("n_first"), F.count_if(last).alias("n_last"), F.count_if("is_best").alias("n_best"), F.min(F.when(last, F.col("metric"))).alias("least"))
    return facts.withColumn("best_is_least", F.col("least") == F.lit(found.best_metric)).drop("least")


@query
def calibrate(spark, sf):
    rows = I.scored_orders(spark, sf).select("id", "p1", "target")
    sigmoid = training.fit_calibration(rows, "p1", "target", "sigmoid")
    isotonic = training.fit_calibration(rows, "p1", "target", "isotonic")
    return isotonic.transform(sigmoid.transform(rows, "sigmoid"), "isotonic")


@query
def permuted_columns(spark, sf):
    """Five numbers of each line with the values that other lines send, in two groups."""
    lines = I.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_quantity", "l_extendedprice", "l_discount", "l_tax", F.col("l_partkey").cast("double").alias("l_partkey")
    )
    rows = lines.groupBy("id").agg(*[F.max(c).alias(c) for c in lines.columns[1:]])
    return training.permuted_columns(session.stored(rows, "lines"), "id", rows.columns[1:], 11, groups=2)


@query
def feature_importance(spark, sf):
    rows = I.model_rows(spark, sf).withColumn("open", (F.col("status") == "O").cast("double"))
    cols = ["price", "month", "weekday", "open"]
    model = prep.prep_stages([], cols, "target").fit(rows)
    fitted = training.fit_model(model.transform(rows), "classification", _TREES)
    return training.feature_importance(fitted, rows, "id", cols, "classification")


@query
def smote(spark, sf):
    """One embedding label against all others."""
    rows = I.table(spark, sf, "embeddings").select("vec_id", "embedding", F.when(F.col("label") == 3, 1).otherwise(0).alias("target"))
    return resampling.smote(rows, "vec_id", "embedding", "target", k=5, seed=42)


@query
def smote_classes(spark, sf):
    """Rows of each class, real and synthetic: both classes end up as large as the larger one."""
    rows = I.table(spark, sf, "embeddings").select("vec_id", "embedding", F.when(F.col("label") == 3, 1).otherwise(0).alias("target"))
    return resampling.smote(rows, "vec_id", "embedding", "target", k=5, seed=42).groupBy("target", "synthetic").agg(F.count("*").alias("n"))


@query
def smote_points_many(spark, sf):
    """As smote_points, for a smaller class of four labels: many cells."""
    rows = I.table(spark, sf, "embeddings").select("vec_id", "embedding", F.when(F.col("label") < 4, 1).otherwise(0).alias("target"))
    made = resampling.smote_rows(rows, "vec_id", "embedding", "target", k=5, seed=42)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return made.select("base", "neighbour", round_even(F.col("gap"), 9).alias("gap"), round_even(total, 5).alias("total"))


@query
def smote_points(spark, sf):
    """Where each synthetic point lies: its two rows, the share of the way, and its coordinates' sum."""
    rows = I.table(spark, sf, "embeddings").select("vec_id", "embedding", F.when(F.col("label") == 3, 1).otherwise(0).alias("target"))
    made = resampling.smote_rows(rows, "vec_id", "embedding", "target", k=5, seed=42)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return made.select("base", "neighbour", round_even(F.col("gap"), 9).alias("gap"), round_even(total, 5).alias("total"))


@query
def batch_score(spark, sf):
    """A fitted model's scores of the whole set, in the stored layout."""
    _, rows = _prepared(spark, sf)
    model = training.fit_model(rows, "classification", _TREES)
    scored = session.stored(scoring.batch_score(model, rows, "id"), "scored")
    return scoring.score_table_class(scored, "id", "p0", "p1", "propensity", NEXT_MONTH, RUN, TRAIN_RUN)


@query
def batch_score_deciles(spark, sf):
    """Rows of each decile of a fitted model's scores: as even as the number of rows allows."""
    return batch_score(spark, sf).groupBy("DECIL").agg(F.count("*").alias("n"))


@query
def shadow_selection(spark, sf):
    rows = I.model_rows(spark, sf)
    return selection.shadow_selection(rows, "id", _NUMBERS, "target", perc=50, alpha=0.5, rounds=3, trees=10)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
