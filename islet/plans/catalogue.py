"""Queries over the driver's tables, one per operator group of SURVEY §7.3.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built only from
the given tables.  Computed doubles are rounded to 6 decimals so a result can
be compared value for value with the SQL in ``islet.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from islet.functions import scalars as S
from islet.operators import cells, clean, joins, models, monitor, ordered, profile, ridge, rollup, sessions, stats, validate
from islet.operators.features import one_hot
from islet.plans import views
from islet.session import shared_path
from islet.sources import io
from islet.sources.stages import Stages

R = 6  # decimals kept on computed doubles

# Fixed parameters of the driver-table queries.
EVENT_GAP = 360
EVENT_PHASES = {"Pre-Processing": ["signup"], "Processing": ["view", "click"], "Post-Processing": ["purchase"]}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PART_CLASSES = {"Value": ["ECONOMY", "STANDARD"], "Promo": ["PROMO"], "Sized": ["LARGE", "MEDIUM", "SMALL"]}
PART_NAME_PATTERNS = [("%ring%", "Rings"), ("%red%widget%", "Red Widgets")]
PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ORDER_KEY = ["o_orderdate", "o_orderkey"]
CUTOFF = "1999-12-31"
SHIFT_DATE = "1998-01-01"
M1 = {"id": "m1", "intercept": 7.780522,
      "coefficients": {"f_tier": 4.448954, "f_new": 2.959246, "f_depth": 5.864206, "f_delivery": 3.422362}}
M2 = {"id": "m2", "intercept": 5.0, "coefficients": {"f_tier": 3.0, "f_new": 1.5, "f_depth": 4.0}}
ALPHAS = S.log_grid(1e-3, 1e4, 50)


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c):
    return F.round(c, R)


# ------------------------------------------------------------------ sessions

def _events(spark, sf):
    return T(spark, sf, "events").withColumn("dur", F.floor("value").cast("long"))


def _islands(spark, sf, keys):
    return sessions.with_islands(_events(spark, sf), keys, "ts", duration="dur", gap=EVENT_GAP, tie="event_id")


def q_sessionize_gap(spark, sf):
    isl = _islands(spark, sf, ["user_id"])
    return isl.groupBy("user_id", F.col("island_id").alias("session_id")).agg(
        F.count(F.lit(1)).alias("sessions_combined"), F.min("ts").alias("session_start"),
        F.max("ts_end_computed").alias("session_end"), F.sum("dur").alias("total_minutes"),
        F.min("event_id").alias("first_event_id"))


def q_islands_rows(spark, sf):
    return _islands(spark, sf, ["user_id"]).select(
        "event_id", "user_id", "ts", "ts_end_computed", "gap_from_prev_minutes", "island_id")


def q_sessionize_last_start(spark, sf):
    e = (_events(spark, sf).withColumn("date", F.to_date("ts")).withColumn("month_year", F.date_format("ts", "yyyy_MM"))
         .withColumn("time_start", F.date_format("ts", "HH:mm:ss")))
    out = sessions.sessionize(e, ["user_id", "event_type"], "ts", "dur", gap=EVENT_GAP, tie="event_id", date="date",
                              time_start="time_start", time_end="time_end", carry=["month_year"], end="last_start",
                              island="island_id")
    return out.select("user_id", "event_type", "island_id", "sessions_combined", "date", "month_year",
                      "time_start", "time_end", F.col("dur").alias("duration"))


def q_island_size_hist(spark, sf):
    h = sessions.island_size_hist(_islands(spark, sf, ["user_id"]), ["user_id"])
    total = F.sum("total_raw_sessions").over(Window.partitionBy(F.lit(0)))
    return h.withColumn("pct_of_total_sessions", r6(F.col("total_raw_sessions") * 100.0 / total))


def q_topk_islands_rows(spark, sf):
    top = sessions.topk_islands_rows(_islands(spark, sf, ["user_id"]), ["user_id"], k=10)
    return top.select("user_id", "island_id", "sessions_combined", "event_id", "ts", "gap_from_prev_minutes")


def q_entity_rollup(spark, sf):
    isl = _islands(spark, sf, ["user_id", "event_type"])
    sess = isl.groupBy("user_id", "event_type", "island_id").agg(
        F.min(F.to_date("ts")).alias("date_workflow"), F.sum("dur").alias("duration"))
    return rollup.entity_rollup(sess, key="user_id", category="event_type", descriptive=(),
                                phases=EVENT_PHASES, categories=EVENT_TYPES)


# ------------------------------------------------------- scalar / projection

def q_category_case(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", "p_type", S.classify("p_type", PART_CLASSES, "Other").alias("p_class"))


def q_like_normalise(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", S.canonical_media_type("p_name", PART_NAME_PATTERNS).alias("name_norm"))


def q_tier_encode(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", "p_size", S.length_tier("p_size").alias("length_tier"),
                    S.length_tier_ord("p_size").alias("length_tier_ord"))


def q_hash_key(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", S.hash_key("p_name", "p_brand", "p_type").alias("key_hash"))


def q_time_12h_roundtrip(spark, sf):
    e = T(spark, sf, "events").select("event_id", S.time_24h_to_12h("ts").alias("t12"))
    return e.withColumn("t24", S.time_12h_to_24h("t12"))


def q_duration_repair(spark, sf):
    e = T(spark, sf, "events").select("event_id", (F.floor("value").cast("long") - 50).alias("raw"))
    return e.withColumn("duration", S.repair_wrap("raw"))


def q_raw_filter_then_replace(spark, sf):
    o = T(spark, sf, "orders")
    pred = clean.not_in("o_orderpriority", ["5-LOW"]) & clean.trim_ne("o_orderstatus", "P")
    out = clean.filter_raw_then_rewrite(o, pred, {
        "o_orderpriority": F.lower(F.trim(F.substring("o_orderpriority", 3, 100)))})
    return out.select("o_orderkey", "o_orderpriority", "o_orderstatus")


# -------------------------------------------------------------- global order

def _docs_labels(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.join(T(spark, sf, "labels"), "doc_id", "left")


def q_forward_fill(spark, sf):
    dl = _docs_labels(spark, sf).select("doc_id", "quality")
    return ordered.forward_fill(dl, ["doc_id"], ["quality"], suffix="_filled")


def _rolling_orders(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    o = o.withColumn("x", F.col("o_totalprice") / 1000.0)
    return ordered.rolling(o, ORDER_KEY, "x", 5, 3, aggs=("mean", "rmse"), index="idx")


def q_rolling_mean(spark, sf):
    return _rolling_orders(spark, sf).select("o_orderkey", "idx", r6(F.col("rolling_mean")).alias("rolling_mean"))


def q_rolling_rmse(spark, sf):
    return _rolling_orders(spark, sf).select("o_orderkey", "idx", r6(F.col("rolling_rmse")).alias("rolling_rmse"))


def q_global_index(spark, sf):
    o = T(spark, sf, "orders").select(*ORDER_KEY)
    return ordered.with_global_index(o, ORDER_KEY, "idx").select("o_orderkey", "idx")


def q_order_violations(spark, sf):
    # events' ts never decreases in event_id order (0 rows), so the check
    # runs on value, where arrival-order violations do occur
    e = T(spark, sf, "events").select("event_id", "value")
    return ordered.order_violations(e, ["event_id"], "value")


def q_context_rows(spark, sf):
    e = T(spark, sf, "events").select("event_id", "event_type", "value")
    hit = (F.col("event_type") == "error") & (F.col("value") > 200)
    return ordered.context_rows(e, ["event_id"], hit).select("rn", "event_id", "event_type", "value")


# --------------------------------------------------------------------- joins

def q_label_left_join(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.label_join(d, T(spark, sf, "labels"), ["doc_id"])


def q_pending_left_join(spark, sf):
    lab = T(spark, sf, "labels").filter(F.col("quality") == 0).select("doc_id", "toxic")
    docs = T(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.pending_join(lab, docs, ["doc_id"])


def q_anti_key_list(spark, sf):
    c = T(spark, sf, "customer")
    keys = (T(spark, sf, "nation").filter(F.col("n_regionkey") == 0)
            .select(F.col("n_nationkey").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment")))
    return joins.anti(c, keys, ["c_nationkey", "c_mktsegment"]).filter(F.col("c_acctbal") >= 0).select(
        "c_custkey", "c_name")


def q_semi_join(spark, sf):
    n = T(spark, sf, "nation").join(T(spark, sf, "region").filter(F.col("r_name") == "ASIA"),
                                    F.col("n_regionkey") == F.col("r_regionkey"))
    keys = n.select(F.col("n_nationkey").alias("c_nationkey"))
    return joins.semi(T(spark, sf, "customer"), keys, ["c_nationkey"]).select("c_custkey", "c_name")


# -------------------------------------------------------------- aggregation

def q_dedupe_rows(spark, sf):
    # whole texts are reduced to a fixed-width digest before the shuffle
    d = T(spark, sf, "documents").select("lang", "source", S.text_digest("text").alias("_k"))
    return clean.dedupe(d, ["lang", "source", "_k"]).select(F.substring("_k", 1, 32).alias("text_md5"), "lang", "source")


def q_duplicate_groups(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", S.text_digest("text").alias("_k"))
    g = profile.duplicate_groups(d, ["_k"], firsts={"first_doc": "doc_id"})
    return g.select(F.substring("_k", 1, 32).alias("text_md5"), "n_copies", "first_doc")


def q_freq_table(spark, sf):
    return profile.freq(T(spark, sf, "events"), "event_type")


def q_freq_with_null(spark, sf):
    return profile.freq(_docs_labels(spark, sf), "quality", keep_null=True)


def q_month_rollup(spark, sf):
    return profile.monthly_counts(T(spark, sf, "orders"), "o_orderdate")


def q_coverage_span(spark, sf):
    o = T(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    return profile.coverage(o, "d")


def q_filtered_counts(spark, sf):
    e = T(spark, sf, "events")
    return e.agg(rollup.count_where(S.hour_at_most("ts", 4)).alias("midnight_starts"),
                 F.count(F.lit(1)).alias("total_rows"),
                 rollup.count_where(F.col("value") > 240).alias("long_rows"),
                 rollup.count_where(F.col("value") < 1).alias("short_rows")).withColumn(
        "pct_midnight", r6(F.col("midnight_starts") * 100.0 / F.col("total_rows")))


def q_group_summary(spark, sf):
    g = profile.group_summary(T(spark, sf, "events"), "event_type", "value")
    return g.select("event_type", r6(F.col("mean")).alias("mean"), r6(F.col("median")).alias("median"),
                    r6(F.col("std")).alias("std"), "count")


def q_quantiles_box(spark, sf):
    b = profile.box_stats(T(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return b.select("l_returnflag", *[r6(F.col(c)).alias(c) for c in ("q1", "median", "q3")])


def q_histogram(spark, sf):
    h = profile.histogram(T(spark, sf, "lineitem"), "l_extendedprice", 20)
    return h.select("bin", "count", r6(F.col("bin_lo")).alias("bin_lo"))


def q_crosstab(spark, sf):
    return profile.crosstab(T(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


def q_crosstab_norm(spark, sf):
    c = profile.crosstab_long(T(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "columns")
    return c.withColumn("share", r6(F.col("share")))


def q_crosstab_margins(spark, sf):
    return profile.crosstab_margins(T(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


def _events_hour(spark, sf):
    return T(spark, sf, "events").withColumn("hour", F.hour("ts")).withColumn("day_quarter", S.day_quarter("hour"))


def q_share_over_time(spark, sf):
    v = _events_hour(spark, sf).filter(F.col("event_type") == "view").drop("day_quarter")
    s = monitor.share_over_time(v, "ts", "hour", month_fmt="yyyy-MM-dd")
    return s.withColumn("proportion", r6(F.col("proportion")))


def q_day_quarter(spark, sf):
    g = profile.group_summary(_events_hour(spark, sf), "day_quarter", "value")
    return g.select("day_quarter", r6(F.col("mean")).alias("mean"), r6(F.col("median")).alias("median"),
                    r6(F.col("std")).alias("std"), "count")


def q_group_trend(spark, sf):
    t = profile.group_trend(T(spark, sf, "events"), "event_type", "ts", "value")
    return t.select("event_type", r6(F.col("slope")).alias("slope"), r6(F.col("intercept")).alias("intercept"), "n")


def q_argmin_per_group(spark, sf):
    li = T(spark, sf, "lineitem")
    return profile.argmin_rows(li, "l_returnflag", "l_extendedprice",
                               ["l_orderkey", "l_linenumber", "l_extendedprice"], tie=["l_orderkey", "l_linenumber"])


def q_pivot_heat(spark, sf):
    p = profile.pivot_wide(T(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "l_discount", ["F", "O"])
    return p.select("l_returnflag", r6(F.col("F")).alias("F"), r6(F.col("O")).alias("O"))


def q_range_stats(spark, sf):
    r = profile.range_stats(T(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return r.select("l_returnflag", "min", "max", r6(F.col("mean")).alias("mean"), r6(F.col("spread")).alias("spread"))


def q_one_hot(spark, sf):
    o = T(spark, sf, "orders")
    out, names = one_hot(o, o, "o_orderpriority")
    return out.select("o_orderkey", *[F.col(f"`{n}`") for n in names])


def q_winsorise(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    w = clean.winsorise(li, "l_extendedprice", "cap", q=0.99, out="price_capped")
    return w.select("l_orderkey", "l_linenumber", r6(F.col("price_capped")).alias("price_capped"))


def q_null_profile(spark, sf):
    return profile.null_profile(_docs_labels(spark, sf)).select("position", "column_name", "non_null", "nulls")


def q_dq_checks(spark, sf):
    lab = T(spark, sf, "labels")
    return profile.run_checks([
        profile.row_checks(lab, [
            profile.not_null("doc_id"),
            profile.not_null("quality"),
            profile.accepted("quality", [0, 1]),
            profile.accepted("toxic", [0, 1]),
            profile.not_null("toxic", where=F.col("quality") == 1),
        ]),
        profile.check_unique(lab, ["doc_id"]),
    ])


# ---------------------------------------------------------------- statistics

def q_pearson(spark, sf):
    p = stats.pearson(T(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return p.withColumn("r", r6(F.col("r")))


def q_spearman(spark, sf):
    s = stats.spearman(T(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", tie=["l_orderkey", "l_linenumber"])
    return s.withColumn("rho", r6(F.col("rho")))


def q_chi2_independence(spark, sf):
    c = stats.chi2(_events_hour(spark, sf), "event_type", "day_quarter")
    return c.select(r6(F.col("chi2")).alias("chi2"), "dof", "n")


def q_chi2_yates(spark, sf):
    """A 2 x 2 table with NULL levels, which take no part."""
    x = _docs_labels(spark, sf).select(F.when(F.col("lang").isNotNull(), F.col("lang") == "en").alias("is_en"), "toxic")
    c = stats.chi2(x, "is_en", "toxic")
    return c.select(r6(F.col("chi2")).alias("chi2"), r6(F.col("chi2_corrected")).alias("chi2_corrected"), "dof", "n")


def q_chi2_residuals(spark, sf):
    c = stats.chi2_cells(_events_hour(spark, sf), "event_type", "day_quarter")
    return c.select("event_type", "day_quarter", "observed", r6(F.col("expected")).alias("expected"),
                    r6(F.col("residual")).alias("residual"))


def q_normality(spark, sf):
    m = stats.moments(T(spark, sf, "orders"), "o_totalprice")
    return m.select("n", *[r6(F.col(c)).alias(c) for c in ("mean", "skewness", "kurtosis", "jarque_bera")])


def q_normality_distance(spark, sf):
    m = stats.normal_distance(T(spark, sf, "orders"), "o_totalprice")
    return m.select("n", *[r6(F.col(c)).alias(c) for c in ("mean", "std", "distance")])


def q_qq_points(spark, sf):
    return stats.qq_points(T(spark, sf, "orders"), "o_totalprice", tie=["o_orderkey"])


# ---------------------------------------------------------------- validation

def _orders_features(spark, sf):
    o = T(spark, sf, "orders")
    return o.withColumns({
        "f_tier": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 2)
                   .when(F.col("o_orderpriority") == "3-MEDIUM", 1).otherwise(0),
        "f_new": (F.col("o_orderstatus") == "O").cast("int"),
        "f_depth": (F.col("o_orderstatus") == "F").cast("int"),
        "f_delivery": (F.col("o_totalprice") > 250000).cast("int"),
        "y": F.col("o_totalprice") / 10000.0,
    })


def _split(spark, sf):
    return validate.time_split(T(spark, sf, "orders"), ORDER_KEY, frac_test=0.25)


def q_time_split(spark, sf):
    return _split(spark, sf).select("o_orderkey", "idx", "role")


def q_split_summary(spark, sf):
    s = _split(spark, sf).withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    out = validate.split_summary(s, "o_orderdate", "o_totalprice", flag="is_f", klass="o_orderpriority")
    return out.withColumn("target_mean", r6(F.col("target_mean"))).withColumn("flag_pct", r6(F.col("flag_pct")))


def q_rolling_folds(spark, sf):
    o = T(spark, sf, "orders").select(*ORDER_KEY)
    return validate.rolling_folds(o, ORDER_KEY).select("fold", "role", "o_orderkey", "idx")


def q_inner_folds(spark, sf):
    o = T(spark, sf, "orders").select(*ORDER_KEY)
    return validate.inner_folds(o, ORDER_KEY, k=3).select("fold", "role", "o_orderkey", "idx")


def q_baseline_global(spark, sf):
    b = models.baseline_rmse(_split(spark, sf), "o_totalprice", (), "B0")
    return b.withColumn("rmse", r6(F.col("rmse")))


def q_baseline_group(spark, sf):
    b = models.baseline_rmse(_split(spark, sf), "o_totalprice", ["o_orderpriority"], "B1")
    return b.withColumn("rmse", r6(F.col("rmse")))


def q_ridge_single(spark, sf, alpha: float = 10.0):
    """ML5 with one feature."""
    li = T(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    value = lambda term: F.max(F.when(F.col("term") == term, F.col("value")))
    fit = ridge.fit(li, ["x"], "y", alpha).agg(value("intercept").alias("intercept"), value("x").alias("coef"))
    res = joins.attach_scalar(li, fit.select("coef", "intercept"))
    d = F.col("y") - F.col("intercept") - F.col("coef") * F.col("x")
    rm = res.agg(F.sqrt(F.avg(d * d)).alias("rmse"))
    return joins.attach_scalar(fit.select("intercept", "coef"), rm).select(
        r6(F.col("intercept")).alias("intercept"), r6(F.col("coef")).alias("coef"), r6(F.col("rmse")).alias("rmse"))


FEATS = ["f_tier", "f_new", "f_depth", "f_delivery"]


def q_ridge_multi(spark, sf):
    return ridge.tuned(_orders_features(spark, sf), ORDER_KEY, FEATS, "y", ALPHAS)


def q_alpha_curve(spark, sf):
    return ridge.curve(_orders_features(spark, sf), ORDER_KEY, FEATS, "y", ALPHAS)


TWO = ["f_tier", "f_delivery"]  # two features, so that SQL can solve the system in closed form
TWO_ALPHAS = [0.01, 1.0, 100.0, 10000.0]


def q_ridge_two(spark, sf):
    m = ridge.fit(_orders_features(spark, sf), TWO, "y", 50.0)
    return m.select("term", r6(F.col("value")).alias("value"), "alpha")


def q_ridge_two_curve(spark, sf):
    c = ridge.curve(_orders_features(spark, sf), ORDER_KEY, TWO, "y", TWO_ALPHAS)
    return c.select("alpha", r6(F.col("mean_rmse")).alias("mean_rmse"), r6(F.col("std_rmse")).alias("std_rmse"))


def q_ridge_two_rolling(spark, sf):
    c = ridge.rolling_cv(_orders_features(spark, sf), ORDER_KEY, TWO, "y", TWO_ALPHAS)
    return c.withColumn("rmse", r6(F.col("rmse")))


ALL_FEATS = [*FEATS, "f_odd", "f_late"]


def _tree_features(spark, sf):
    """The six features of the tree models, all flags or ordinals."""
    return _orders_features(spark, sf).withColumns({"f_odd": (F.col("o_custkey") % 2).cast("int"), "f_late": (F.month("o_orderdate") > 6).cast("int")})


def _tree_split_all(spark, sf):
    return validate.time_split(_tree_features(spark, sf), ORDER_KEY, frac_test=0.25)


def _tree_train(split):
    return split.filter(F.col("role") == "train").select("o_orderkey", "o_orderdate", "o_orderpriority", *ALL_FEATS, "y")


FOREST_POINT, BOOSTED_POINT = ["n_trees", "depth", "min_leaf"], ["rounds", "depth", "rate", "subsample"]


def q_compare_models(spark, sf):
    """All seven variants by nested rolling CV over the train rows, full grids;
    the baseline's error is the holdout's."""
    split = _tree_split_all(spark, sf)
    tr = _tree_train(split)
    dummies, types = one_hot(tr, tr, "o_orderpriority", prefix="t")
    types = ["f_tier", *types]
    raw = lambda df, feats: [r.asDict() for r in ridge.rolling_cv(df, ORDER_KEY, feats, "y", ALPHAS).collect()]
    cv = {"M1-raw": raw(tr, FEATS),
          "M1-log": models.rolling_cv_ridge(tr, ORDER_KEY, FEATS, "y", ALPHAS, log=True),
          "M2-raw": raw(dummies, types),
          "M2-log": models.rolling_cv_ridge(dummies, ORDER_KEY, types, "y", ALPHAS, log=True)}
    for name, feats, kind, point in (("M3", ALL_FEATS, "forest", FOREST_POINT), ("M3b", FEATS, "forest", FOREST_POINT), ("M4", ALL_FEATS, "boosted", BOOSTED_POINT)):
        cv[name] = [r.asDict() for r in cells.nested_cv(cells.search(tr, ORDER_KEY, feats, "y", kind), point).collect()]
    b1 = models.baseline_rmse(split, "y", ["f_tier"], "B1").first()["rmse"]
    return models.compare_models(spark, cv, float(b1))


def q_tree_cells(spark, sf):
    """The cube behind all tree fits of the train rows."""
    rows, n, outer = cells.ranked(_tree_train(_tree_split_all(spark, sf)), ORDER_KEY, ALL_FEATS, "y")
    got = cells.cube(cells.with_segment(rows, cells.cuts_of([*outer, (n, n)])), ALL_FEATS, "y")
    return got.select("segment", *ALL_FEATS, "n", r6(F.col("sum_y")).alias("sum_y"), r6(F.col("sum_yy")).alias("sum_yy"))


def q_forest_stumps(spark, sf):
    """A bagged forest of 200 stumps from one scan of all orders."""
    rows = _tree_features(spark, sf).withColumn("segment", F.lit(0))
    got = cells.stumps(cells.replicate_cube(rows, ALL_FEATS, "y", ["o_orderkey"], 200), ALL_FEATS)
    return got.select("replicate", "feature", "threshold", *[r6(F.col(c)).alias(c) for c in ("left_mean", "right_mean")])


def _tree_split(spark, sf):
    s = validate.time_split(_orders_features(spark, sf), ORDER_KEY, frac_test=0.25)
    return s.filter(F.col("role") == "train"), s.filter(F.col("role") == "test")


def q_forest(spark, sf):
    tr, te = _tree_split(spark, sf)
    m = models.fit_forest(tr, FEATS, "y", n_trees=200, depth=2, min_leaf=2)
    return spark.createDataFrame([("forest", models.tree_rmse(m, te, FEATS, "y"))], "model string, holdout_rmse double")


def q_score_stump(spark, sf):
    """ML9 / ML16: one tree of depth 1 on all rows, scored like any model."""
    x = _orders_features(spark, sf)
    stump = models.fit_forest(x, FEATS, "y", n_trees=1, depth=1, min_leaf=1, bootstrap=False)
    out = monitor.score_many(x, [{"id": "stump", "model": stump, "features": FEATS}], "y")
    return out.select("o_orderkey", r6(F.col("pred_stump")).alias("pred_stump"), r6(F.col("resid_stump")).alias("resid_stump"))


def q_boosted(spark, sf):
    """M4: nested rolling CV over all 54 grid points."""
    return cells.nested_cv(cells.search(_tree_train(_tree_split_all(spark, sf)), ORDER_KEY, ALL_FEATS, "y", "boosted"), BOOSTED_POINT)


def q_search_landscape(spark, sf):
    """All 24 forest points on the whole train set, and for each cell of the
    heat map the point that wins it."""
    scores = cells.search(_tree_train(_tree_split_all(spark, sf)), ORDER_KEY, ALL_FEATS, "y", "forest", folds=0, whole=True)
    scape = cells.landscape(scores, FOREST_POINT)
    best = cells.best_per_cell(scape, ["depth", "min_leaf"]).select("depth", "min_leaf", F.col("n_trees").alias("best_n_trees"))
    return scape.join(best, ["depth", "min_leaf"])


def q_landscape_heat(spark, sf):
    """The heat map's data: depth down, least leaf across, best means."""
    scores = cells.search(_tree_train(_tree_split_all(spark, sf)), ORDER_KEY, ALL_FEATS, "y", "forest", folds=0, whole=True)
    best = cells.best_per_cell(cells.landscape(scores, FOREST_POINT), ["depth", "min_leaf"])
    return best.groupBy("depth").pivot("min_leaf", cells.FOREST_GRID["min_leaf"]).agg(F.first("mean_rmse").alias("mean"), F.first("std_rmse").alias("std"))


def q_importances(spark, sf):
    tr, _ = _tree_split(spark, sf)
    return models.importances(spark, models.fit_forest(tr, FEATS, "y", n_trees=200, depth=3, min_leaf=2), FEATS)


# ------------------------------------------------------------------- scoring

def q_score_linear(spark, sf):
    scored, _ = monitor.score_pending(_orders_features(spark, sf), M1, digits=1, name="predicted")
    return scored.select("o_orderkey", "predicted")


def _scored(spark, sf):
    f = monitor.era(_orders_features(spark, sf), "o_orderdate", CUTOFF)
    return monitor.score_many(f, [M1, M2], "y")


def q_score_many(spark, sf):
    s = _scored(spark, sf)
    return s.select("o_orderkey", "era", *[r6(F.col(c)).alias(c) for c in ("pred_m1", "resid_m1", "pred_m2", "resid_m2")])


def q_era_rmse(spark, sf):
    r = monitor.rmse_report(_scored(spark, sf), ["m1", "m2"])
    return r.withColumn("overall_rmse", r6(F.col("overall_rmse"))).withColumn("post_rmse", r6(F.col("post_rmse")))


def _drift(spark, sf):
    return monitor.drift_report(_scored(spark, sf), ORDER_KEY, "resid_m1")


def q_drift_report(spark, sf):
    d = _drift(spark, sf)
    return d.select("step", "o_orderkey", r6(F.col("rolling_mean_resid")).alias("rolling_mean_resid"),
                    r6(F.col("rolling_rmse")).alias("rolling_rmse"), "drift")


def q_retrain_signal(spark, sf):
    s = monitor.retrain_signal(_drift(spark, sf))
    return s.withColumn("latest_mean_resid", r6(F.col("latest_mean_resid"))).withColumn(
        "latest_rolling_rmse", r6(F.col("latest_rolling_rmse")))


def q_residuals_by_group(spark, sf):
    r = monitor.residuals_by(_scored(spark, sf), "o_orderpriority", "resid_m1", PRIORITY_ORDER)
    return r.select("o_orderpriority", "n", r6(F.col("mean")).alias("mean"), r6(F.col("rmse")).alias("rmse"), "rank")


def q_feature_shift(spark, sf):
    s = monitor.feature_shift(_scored(spark, sf), ["f_new", "f_depth", "f_delivery"])
    return s.select("feature", *[r6(F.col(c)).alias(c) for c in ("train_mean", "post_mean", "delta")], "shifted")


def q_tier_mix(spark, sf):
    t = monitor.tier_mix(_scored(spark, sf), "f_tier")
    return t.withColumn("pct", r6(F.col("pct")))


def q_regime_view(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    _, summary = monitor.regime_view(o, ORDER_KEY, "o_orderdate", "o_totalprice", "o_orderstatus", SHIFT_DATE)
    return summary.withColumn("mean", r6(F.col("mean")))


# ------------------------------------------------- more profile / sorts / QA

def q_top_k(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return profile.n_largest(li, "l_extendedprice", 10, tie=["l_orderkey", "l_linenumber"])


def q_head_tail(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return ordered.head_tail(o, ORDER_KEY, 5, tail=True)


def q_audit(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"),
                                      F.floor("value").cast("long").alias("dur"))
    return profile.audit(e, "d", "dur", ["user_id", "event_type", "d", "dur"], "event_id")


def q_group_means(spark, sf):
    g = profile.group_means(T(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_discount", "l_tax"])
    return g.select("l_returnflag", *[r6(F.col(c)).alias(c) for c in g.columns if c != "l_returnflag"])


def q_summary_with_without(spark, sf):
    s = profile.summary_with_without(T(spark, sf, "orders"), "o_totalprice", F.col("o_totalprice") > 400000)
    return s.select(*[r6(F.col(c)).alias(c) for c in ("mean_all", "median_all", "std_all", "mean_without", "median_without", "std_without")],
                    "n_outliers")


def q_describe_columns(spark, sf):
    d = profile.describe_many(T(spark, sf, "lineitem"), DESCRIBE_COLS, [0.1, 0.25, 0.5, 0.9])
    return d.select("column", "count", *[r6(F.col(c)).alias(c) for c in d.columns if c not in ("column", "count")])


DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_histogram_auto(spark, sf):
    h = profile.histogram_auto(T(spark, sf, "orders"), "o_totalprice")
    return h.withColumn("bin_lo", r6(F.col("bin_lo")))


def q_crosstab_all(spark, sf):
    c = profile.crosstab_long(T(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "all")
    return c.withColumn("share", r6(F.col("share")))


def q_chi2_p(spark, sf):
    c = stats.chi2(_events_hour(spark, sf), "event_type", "day_quarter")
    return c.select("dof", F.round("p", 9).alias("p"))


STATUS_LABELS = {"O": "open", "F": "filled"}


def q_relabel(spark, sf):
    o = clean.relabel(T(spark, sf, "orders"), "o_orderstatus", STATUS_LABELS, "label")
    return o.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def q_run_history(spark, sf):
    """Two runs, one of them logged twice, read back wide."""
    from uuid import uuid4

    path = shared_path(spark, f"runs-{uuid4().hex}")
    o = T(spark, sf, "orders")
    steps = o.groupBy(F.year("o_orderdate").alias("step")).agg(F.avg("o_totalprice").alias("value")).select(F.lit("mean_price").alias("key"), "step", r6(F.col("value")).alias("value"))
    for run, alpha in (("r1", 0.1), ("r2", 0.5), ("r1", 0.9)):
        io.append_run(spark, path, "orders", run, f"alpha {alpha}", {"alpha": alpha}, {"n_folds": 3}, steps)
    return io.read_runs(spark, path, ["alpha"], ["n_folds", "mean_price"])


def q_sparse_levels(spark, sf):
    return stats.sparse_levels(T(spark, sf, "part"), "p_brand", k=50)


def q_bias_std(spark, sf):
    b = stats.bias_std(_scored(spark, sf), "resid_m1", by="era")
    return b.select("era", r6(F.col("bias")).alias("bias"), r6(F.col("std")).alias("std"))


def q_share_where(spark, sf):
    s = profile.share_where(T(spark, sf, "orders"), "o_orderpriority", F.col("o_orderstatus") == "F")
    return s.withColumn("pct", r6(F.col("pct")))


def q_n_unique(spark, sf):
    return rollup.n_unique(T(spark, sf, "events"), ["event_type"], "user_id", "n_users")


def q_describe(spark, sf):
    d = profile.describe(T(spark, sf, "orders"), "o_totalprice")
    return d.select("count", *[r6(F.col(c)).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def q_evaluate(spark, sf):
    s = validate.time_split(_orders_features(spark, sf), ORDER_KEY, frac_test=0.25).filter(F.col("role") == "test")
    s = s.withColumn("pred", S.linear_score(M1["coefficients"], M1["intercept"]))
    e = models.evaluate(s, "pred", "y", by="o_orderpriority")
    return e.select("o_orderpriority", "n", *[r6(F.col(c)).alias(c) for c in ("rmse", "bias", "std")])


def q_distinct_values(spark, sf):
    return clean.distinct_values(T(spark, sf, "orders"), "o_orderpriority")


def q_drop_incomplete(spark, sf):
    kept, dropped = clean.drop_incomplete(_docs_labels(spark, sf), ["quality", "toxic"])
    return joins.attach_scalar(kept.agg(F.count(F.lit(1)).alias("n_kept")), dropped)


def q_forest_grid(spark, sf):
    """M3: nested rolling CV over all 24 grid points."""
    return cells.nested_cv(cells.search(_tree_train(_tree_split_all(spark, sf)), ORDER_KEY, ALL_FEATS, "y", "forest"), FOREST_POINT)


def q_spearman_matrix(spark, sf):
    m = stats.corr_matrix(T(spark, sf, "lineitem"), SPEARMAN_COLS, "spearman")
    return m.withColumn("r", r6(F.col("r")))


SPEARMAN_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


# ------------------------------------------ the log's view chain on events

# event type -> raw log categories, taken in turn by event_id: misspelled,
# padded, out of scope, missing and unknown ones
EVENT_RAW_CATEGORY = {"view": ["Editing Video", "Watching and Edits", "Editing", " Editing "],
                      "click": ["Writing Scriot", "Outline", "Video notes", "Processing Raw Video"],
                      "purchase": ["Pictures", "Picture", "Thumbnail", "Subtitles"],
                      "signup": ["Uploading Video", "Recording Audip", "Recordinng Video", "Recording  Video"],
                      "error": ["Stats", "SEO", None, "Dancing"]}
RAW_MEDIA_TYPES = [" Movies ", "Old MOVIE", "Video Games", " Books ", "my video  game", " Channel "]  # by user_id


def _in_turn(n, values) -> Column:
    """values[n mod their number]."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


def _every(n: int, value: str | None, otherwise) -> Column:
    """A fault in each n-th event."""
    return F.when(F.col("event_id") % n == 0, F.lit(value)).otherwise(otherwise)


def _raw_log(spark, sf):
    """A raw work log derived from events: 12-hour text times, raw spellings
    of categories and media types, rows out of scope by every rule, dates
    missing at the start and now and then later, and durations that wrap
    negative when the session crosses midnight (as in the hand-kept log)."""
    e = _events(spark, sf)
    end = S.plus_minutes("ts", "dur")
    title = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    raw = None
    for et, names in EVENT_RAW_CATEGORY.items():
        is_type, name = F.col("event_type") == et, _in_turn(F.col("event_id"), names)
        raw = F.when(is_type, name) if raw is None else raw.when(is_type, name)
    undated = (F.col("event_id") < 20) | (F.col("event_id") % 7 == 3)
    return e.select(
        F.col("event_id").alias("_seq"), _every(89, None, _in_turn(F.col("user_id"), RAW_MEDIA_TYPES)).alias("media_type"),
        _every(83, None, F.lit("S")).alias("media_series"),
        _every(53, "None", _every(59, "Entire Channel", _every(61, None, title))).alias("media_title"),
        _every(67, None, _in_turn(F.col("user_id"), ["Review", "Essay"])).alias("video_type"),
        _every(71, "Multiple", _every(73, "N/A", _every(79, None, _in_turn(F.col("event_id"), ["A", "B", "A"])))).alias("video_subtype"),
        raw.alias("creation_category"),
        F.when(~undated, F.to_date("ts")).alias("date"), S.time_24h_to_12h("ts").alias("time_start"),
        S.time_24h_to_12h(end).alias("time_end"),
        F.when(F.to_date(end) > F.to_date("ts"), F.col("dur") - 1440).otherwise(F.col("dur")).alias("duration"))


def _seed(spark, sf):
    """A label seed derived from customer: one row a natural key, lengths with
    and without a tier, a quarter of the rows planned."""
    c, key = T(spark, sf, "customer"), F.col("c_custkey")
    return c.select(
        F.concat(F.lit("u"), key.cast("string")).alias("media_title"), _in_turn(key, ["Review", "Essay"]).alias("video_type"),
        _in_turn(key, ["A", "A", "B"]).alias("video_subtype"),
        _in_turn(key, [7, 10, 15, 20, 25, 30, 12, None]).cast("int").alias("expected_length_mins"),
        (F.col("c_acctbal") > 0).cast("int").alias("complexity_new"),
        (F.col("c_nationkey") % 2).cast("int").alias("complexity_media_depth"),
        (F.col("c_nationkey") > 12).cast("int").alias("complexity_delivery_style"),
        (F.col("c_acctbal") > 5000).cast("int").alias("complexity_logistics"),
        F.when(F.col("c_nationkey") > 2, (F.col("c_nationkey") % 3 == 0).cast("int")).alias("complexity_worklife"),
        (key % 4 != 0).cast("int").alias("is_complete"))


def q_log_stg(spark, sf):
    return views.build_views(_raw_log(spark, sf), None, only=["stg_workload"])["stg_workload"]


def q_log_sessions(spark, sf):
    return views.build_views(_raw_log(spark, sf), None, only=["combined_sessions"])["combined_sessions"]


def q_log_dim(spark, sf):
    return views.build_views(_raw_log(spark, sf), None, only=["dim_videos"])["dim_videos"]


def q_log_ml(spark, sf):
    return views.build_views(_raw_log(spark, sf), _seed(spark, sf), only=["dim_videos_ml"])["dim_videos_ml"]


def q_log_pending(spark, sf):
    return views.build_views(_raw_log(spark, sf), _seed(spark, sf), only=["fct_videos_pending"])["fct_videos_pending"]


def q_log_dim_staged(spark, sf):
    """The chain twice through one handle: the second build reads the stages
    of the first."""
    stages = Stages(spark)
    for _ in range(2):
        out = views.build_views(_raw_log(spark, sf), None, only=["dim_videos"], stages=stages)
    if stages.reused != ["dim_videos"]:
        raise RuntimeError(f"built again: {stages.written}")
    return out["dim_videos"]


def q_load_report(spark, sf):
    """The raw log as CSV lines, some of them cut short and some with times
    that are none, loaded with counts; accepted and rejected rows by reason."""
    from uuid import uuid4

    raw = _raw_log(spark, sf)
    seq = F.col("_seq")
    times = {c: F.when(seq % m == 1, F.lit("25:99:00 XM")).otherwise(F.col(c)) for c, m in (("time_start", 101), ("time_end", 103))}
    fields = [F.coalesce(times.get(c, F.col(c)).cast("string"), F.lit("")) for c in io.RAW_LOG_SCHEMA.names]
    line = F.when(seq % 97 == 1, F.concat_ws(",", *fields[:4])).otherwise(F.concat_ws(",", *fields))
    to = shared_path(spark, f"load-{uuid4().hex}")
    raw.select(line.alias("value")).write.text(f"{to}/csv")
    load = io.load_log(spark, f"{to}/csv", f"{to}/table", header=False)
    got = load.rows.select(F.lit("accepted").alias("reason"), "duration").unionByName(load.rejects.select("reason", F.lit(None).cast("long").alias("duration")))
    seen = F.create_map(*[F.lit(x) for k in ("accepted", io.BAD_LINE, io.BAD_TIME) for x in (k, load.counts[k])])
    return got.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("duration").alias("minutes")).withColumn("observed", F.try_element_at(seen, F.col("reason")).cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# queries with no SQL equivalent (iterative fits, approximations) -> rows-only check
ROWS_ONLY = {"qq_points", "ridge_multi", "alpha_curve", "compare_models", "forest", "boosted",
             "search_landscape", "landscape_heat", "importances", "forest_grid"}
