"""One query per operator: (spark, sf_dir) -> DataFrame, over the whole tables.

Learned stages share one trained model per session and scale, so that their queries do not train again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens import jobs
from basketlens import schemas as S
from basketlens.functions import columns as C
from basketlens.operators import als as A
from basketlens.operators import evaluate as E
from basketlens.operators import features as FE
from basketlens.operators import lambdamart as LM
from basketlens.operators import marts as M
from basketlens.operators import metrics as ME
from basketlens.operators import training as PL
from basketlens.operators import popularity as P
from basketlens.operators import ranking as R
from basketlens.operators import sketches as SK
from basketlens.operators import split as SP
from basketlens.operators import staging as ST
from basketlens.operators import two_stage as TS
from basketlens.operators import validate as V
from basketlens.operators.membership import ArticleSets
from basketlens.plans.workspace import scratch_path, written
from basketlens.sources import fixtures as X
from basketlens.sources import marts as SM
from basketlens.sources import raw as RAW

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-12-31"
EXACT = "decimal(18,2)"
DATE_RANGE = {"min_date": "1996-01-01", "max_date": "2000-12-31"}
LATEST = 5000
SAMPLE = 500
SCORED = 20

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- inputs -------------------------------------------------------------------------------------------


def _split(spark: SparkSession, sf: str, cold: bool = False) -> SP.TemporalSplit:
    tx = X.cold_transactions(spark, sf) if cold else X.transactions(spark, sf)
    return SP.make_temporal_split(tx, X.VAL_START, X.TEST_START)


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return ST.stg_transactions(X.dirty_transactions(spark, sf), EXACT)


def _as_of():  # noqa: ANN202
    return F.lit(AS_OF).cast("date")


def _raw_ids(df: DataFrame, col: str) -> DataFrame:
    """Ids as a careless export writes them: white space around, upper case, leading zeros lost."""
    return df.withColumn(col, F.concat(F.lit("\t "), F.upper(F.regexp_replace(col, "^0+(?=.)", "")), F.lit(" \n")))


# ---- scans, sources, sinks ------------------------------------------------------------------------------


@query
def load_latest_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return RAW.latest_transactions(X.transactions(spark, sf), LATEST).withColumn(
        "price", F.col("price").cast("double")
    )


@query
def load_articles(spark: SparkSession, sf: str) -> DataFrame:
    return RAW.clean_articles(_raw_ids(X.articles(spark, sf), "article_id"))


@query
def load_customers(spark: SparkSession, sf: str) -> DataFrame:
    ids = X.customers(spark, sf).withColumn("customer_id", F.concat(F.lit("\tC"), "customer_id", F.lit(" ")))
    return RAW.clean_customers(ids)


@query
def raw_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "transactions": X.transactions(spark, sf),
        "articles": X.articles(spark, sf),
        "customers": X.customers(spark, sf),
    }
    counts = [(name, RAW.write_table(t, scratch_path(spark, f"raw-{name}"))) for name, t in tables.items()]
    return spark.createDataFrame(
        [(name, c["rows_in"], c["rows_out"]) for name, c in counts],
        "table_name string, rows_in bigint, rows_out bigint",
    )


@query
def mart_monthly_partitions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "interactions")
    dated = _staged(spark, sf).filter(F.col("transaction_date").isNotNull())
    mart = M.interactions_from(written(M.daily_purchases(dated), "daily"))
    SM.write_monthly(mart, path, "transaction_date", ["customer_id", "article_id"])
    return (
        spark.read.parquet(path)
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("purchase_count").alias("purchases"))
    )


def _text_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions as text, some with a day or a price that cannot be read."""
    key = F.col("l_orderkey")
    day = F.when(key % 1021 == 0, "some day").otherwise(F.col("t_dat").cast("string"))
    price = F.when(key % 1019 == 0, "free").otherwise(F.col("price").cast("string"))
    return X.order_lines(spark, sf).select(
        day.alias("t_dat"),
        "customer_id",
        "article_id",
        price.alias("price"),
        F.col("sales_channel_id").cast("string").alias("sales_channel_id"),
    )


@query
def clean_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return RAW.clean_transactions(RAW.split_unreadable(_text_transactions(spark, sf))[0])


@query
def unreadable_transactions(spark: SparkSession, sf: str) -> DataFrame:
    unreadable = RAW.split_unreadable(_text_transactions(spark, sf))[1]
    return unreadable.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def _marts_job(spark: SparkSession, sf: str) -> str:
    """The folder of the marts that the job writes from careless exports of all three tables."""
    out = scratch_path(spark, "marts-job")
    careless = F.concat(F.lit("\tC"), "customer_id", F.lit(" "))
    # Stored, as an export is: the job reads the rows of a table, and does not make them again wherever it uses an id.
    tx = written(_raw_ids(X.dirty_transactions(spark, sf), "article_id").withColumn("customer_id", careless), "export")
    customers = X.customers(spark, sf).withColumn("customer_id", careless)
    jobs.marts_from_raw(tx, _raw_ids(X.articles(spark, sf), "article_id"), customers, out, _as_of())
    return out


@query
def marts_job_items(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_marts_job(spark, sf)}/fct_item_features").select(
        "article_id", "unique_buyers", "total_purchases", "days_since_last_sold"
    )


@query
def marts_job_users(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_marts_job(spark, sf)}/fct_user_features").select(
        "customer_id", "age", "total_unique_items", "total_purchases", "active_days"
    )


# ---- staging and scalar functions ----------------------------------------------------------------------


@query
def stg_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return ST.stg_transactions(X.dirty_transactions(spark, sf))


@query
def stg_articles(spark: SparkSession, sf: str) -> DataFrame:
    return ST.stg_articles(X.dirty_articles(spark, sf))


@query
def stg_customers(spark: SparkSession, sf: str) -> DataFrame:
    return ST.stg_customers(X.dirty_customers(spark, sf))


@query
def normalize_article_id(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("\t"), F.col("p_partkey").cast("string"), F.lit(" "))
    long_id = F.concat(F.lit(" 99"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"))
    ids = X.table(spark, sf, "part").select("p_partkey", raw.alias("raw"), long_id.alias("long"))
    return ids.select(
        "p_partkey", C.article_key(F.col("raw")).alias("article_id"), C.article_key(F.col("long")).alias("long_id")
    )


@query
def normalize_customer_id(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("\n "), F.upper("c_name"), F.lit("\t"))
    return X.table(spark, sf, "customer").select("c_custkey", C.customer_key(raw).alias("customer_id"))


@query
def calendar_parts(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return X.table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(day).alias("transaction_year"),
        F.month(day).alias("transaction_month"),
        C.sunday_week(day).alias("transaction_week"),
    )


@query
def age_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return X.customers(spark, sf).select("customer_id", "age", C.age_bucket(F.col("age")).alias("age_bucket"))


# ---- validation ----------------------------------------------------------------------------------------


@query
def validate_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return V.validate_transactions(X.dirty_transactions(spark, sf), **DATE_RANGE)


@query
def invalid_channels(spark: SparkSession, sf: str) -> DataFrame:
    return V.invalid_channels(X.dirty_transactions(spark, sf))


@query
def transaction_stats(spark: SparkSession, sf: str) -> DataFrame:
    return V.transaction_stats(X.dirty_transactions(spark, sf))


@query
def month_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics per month from the days' sketches, their estimates held against exact ones: counts at six
    standard errors, the median by the ranks around it."""
    tx = X.dirty_transactions(spark, sf)
    # Half of the rows are sketched first, the others are added to the same days.
    early = F.pmod(F.xxhash64("customer_id", "article_id"), F.lit(2)) == 0
    days = written(SK.daily_sketches(tx.filter(early)), "sketches")
    days = written(SK.add_days(days, tx.filter(~early)), "sketches")
    month = F.trunc("day", "MM").alias("month")
    told = SK.statistics(SK.merge_sketches(days, month), [0.5]).withColumn("median", F.get("price_quantiles", F.lit(0)))
    rows = tx.select(F.trunc("t_dat", "MM").alias("_month"), "customer_id", "article_id", "price")
    rows = rows.join(F.broadcast(told.select(F.col("month").alias("_m"), "median")), F.col("_month").eqNullSafe(F.col("_m")))
    exact = rows.groupBy("_month").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("article_id").alias("articles"),
        F.count_if(F.col("price") < F.col("median")).alias("below"),
        F.count_if(F.col("price") <= F.col("median")).alias("reached"),
    )
    n = F.col("row_count") - F.col("null_price")
    near = lambda c: F.abs(F.col(f"unique_{c}") - F.col(c)) <= 6 * SK.COUNT_ERROR * F.col(c) + 0.5
    slack = 3 * SK.RANK_ERROR * n + 1
    return told.join(exact, F.col("month").eqNullSafe(F.col("_month"))).select(
        "month",
        *["row_count", "null_customer_id", "null_article_id", "null_price", "price_min", "price_max", "date_min", "date_max"],
        near("customers").alias("customers_near"),
        near("articles").alias("articles_near"),
        ((F.col("below") <= n / 2 + slack) & (F.col("reached") >= n / 2 - slack)).alias("median_near"),
    )


@query
def duplicate_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return V.duplicate_transactions(X.dirty_transactions(spark, sf))


@query
def validate_articles(spark: SparkSession, sf: str) -> DataFrame:
    return V.validate_articles(X.dirty_articles(spark, sf))


@query
def article_null_rates(spark: SparkSession, sf: str) -> DataFrame:
    return V.article_null_rates(X.dirty_articles(spark, sf))


@query
def validate_customers(spark: SparkSession, sf: str) -> DataFrame:
    return V.validate_customers(X.dirty_customers(spark, sf))


@query
def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    return V.validation_report(
        X.dirty_transactions(spark, sf), X.dirty_articles(spark, sf), X.dirty_customers(spark, sf), **DATE_RANGE
    )


# ---- split, users and items ----------------------------------------------------------------------------


@query
def temporal_split(spark: SparkSession, sf: str) -> DataFrame:
    """Cutoffs asked for lie before all data, so they are derived from the day range."""
    split = SP.make_temporal_split(X.transactions(spark, sf), "1990-01-01", "1990-06-01")
    return split.labelled.withColumn("price", F.col("price").cast("double"))


@query
def split_summary(spark: SparkSession, sf: str) -> DataFrame:
    return SP.split_summary(_split(spark, sf, cold=True))


@query
def ground_truth(spark: SparkSession, sf: str) -> DataFrame:
    return SP.ground_truth(_split(spark, sf), "test")


@query
def user_seen_items(spark: SparkSession, sf: str) -> DataFrame:
    return FE.user_seen_items(_split(spark, sf).train)


@query
def cold_start_users(spark: SparkSession, sf: str) -> DataFrame:
    return SP.cold_start_users(_split(spark, sf, cold=True), "test")


@query
def known_users(spark: SparkSession, sf: str) -> DataFrame:
    return SP.known_users(_split(spark, sf, cold=True), "test")


@query
def cold_start_rate(spark: SparkSession, sf: str) -> DataFrame:
    return SP.cold_start_rate(_split(spark, sf, cold=True), "test")


@query
def cold_start_items(spark: SparkSession, sf: str) -> DataFrame:
    out = SP.cold_start_items(_split(spark, sf, cold=True), "test")
    shares = ["cold_item_share", "all_cold_user_share", "mean_truth_size"]
    return out.withColumns({c: F.round(c, 9) for c in shares})


@query
def sample_users(spark: SparkSession, sf: str) -> DataFrame:
    return E.sample_users(SP.known_users(_split(spark, sf), "test"), SAMPLE)


# ---- marts and features --------------------------------------------------------------------------------


@query
def fct_user_item_interactions(spark: SparkSession, sf: str) -> DataFrame:
    out = M.fct_user_item_interactions(_staged(spark, sf))
    return out.withColumn("implicit_confidence", F.round("implicit_confidence", 9))


@query
def fct_user_features(spark: SparkSession, sf: str) -> DataFrame:
    customers = ST.stg_customers(X.customers(spark, sf))
    return M.fct_user_features(_staged(spark, sf), customers, _as_of())


@query
def fct_item_features(spark: SparkSession, sf: str) -> DataFrame:
    return M.fct_item_features(_staged(spark, sf), ST.stg_articles(X.articles(spark, sf)), _as_of())


@query
def item_features(spark: SparkSession, sf: str) -> DataFrame:
    return FE.item_features(_split(spark, sf).train)


@query
def user_features(spark: SparkSession, sf: str) -> DataFrame:
    return FE.user_features(_split(spark, sf).train)


# ---- popularity ----------------------------------------------------------------------------------------


@query
def popularity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.popularity_counts(_split(spark, sf).train)


@query
def popularity_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return P.top_k(P.popularity_counts(_split(spark, sf).train), 100)


@query
def popularity_recommend(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf, cold=True)
    buyers = split.transactions.select("customer_id").distinct()
    return P.PopularityModel.fit(split.train).recommend(buyers, 10)


def _popular_candidates(
    split: SP.TemporalSplit,
    users: DataFrame | None = None,
    exclude_seen: bool = True,
    stats: DataFrame | None = None,
) -> DataFrame:
    """The deterministic stand-in for ALS: unseen popular articles of every training customer, or of ``users``."""
    users = split.train.select("customer_id") if users is None else users
    recs = P.PopularityModel.fit(split.train, stats).recommend(users, S.N_CANDIDATES, exclude_seen)
    return recs.select("customer_id", "article_id", (F.col("rank") - 1).alias("als_rank"))


def _recommendations(split: SP.TemporalSplit, which: str, k: int) -> DataFrame:
    return P.PopularityModel.fit(split.train).recommend(SP.known_users(split, which), k)


# ---- candidate pairs and the ranking dataset -----------------------------------------------------------


def _stats(split: SP.TemporalSplit) -> DataFrame:
    return written(FE.interaction_stats(split.train), "stats")


def _pairs(split: SP.TemporalSplit, stats: DataFrame, exclude_seen: bool = True) -> DataFrame:
    candidates = _popular_candidates(split, exclude_seen=exclude_seen, stats=stats)
    return R.candidate_pairs(candidates, FE.seen_items_from(stats))


@query
def candidate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Bought articles stay among the candidates here, so that the flag takes both values."""
    split = _split(spark, sf)
    return _pairs(split, _stats(split), exclude_seen=False)


@query
def candidate_pairs_by_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """The same flags from stored bitmaps, those of the older half of training merged with those of the younger."""
    split = _split(spark, sf)
    stats = _stats(split)
    bought = FE.seen_items_from(stats)
    sets = ArticleSets.of(bought)
    middle = F.lit(split.val_start) - F.expr("INTERVAL 90 DAYS")
    older, younger = (
        ArticleSets.of(split.train.where(part), sets.numbers) for part in (F.col("t_dat") < middle, F.col("t_dat") >= middle)
    )
    return R.candidate_pairs(_popular_candidates(split, exclude_seen=False, stats=stats), older.merged(younger))


@query
def history_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Different articles per training customer, counted in bitmaps."""
    return ArticleSets.of(FE.seen_items_from(_stats(_split(spark, sf)))).sizes()


@query
def labelled_pairs(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    pairs = _pairs(split, _stats(split))
    return R.labelled_pairs(pairs, SP.ground_truth(split, "val")).select("customer_id", "article_id", "label")


@query
def negative_sampling(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    candidates = _popular_candidates(split, SP.known_users(split, "val"), stats=_stats(split))
    labelled = R.labelled_pairs(candidates, SP.ground_truth(split, "val"))
    return R.negative_sample(labelled).select("customer_id", "article_id", "als_rank", "label")


@query
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    stats = _stats(split)
    items = written(FE.item_features_from(stats), "item-features")
    return FE.feature_matrix(_pairs(split, stats), items, FE.user_features_from(stats))


@query
def feature_matrix_from_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same matrix from stored user features in buckets, which are joined without an exchange of their own."""
    split = _split(spark, sf)
    stats = _stats(split)
    items = written(FE.item_features_from(stats), "item-features")
    users = written(FE.user_features_from(stats), "user-features")
    n_buckets = SM.bucket_count(spark, users.count())
    path = scratch_path(spark, "user-buckets")
    return FE.feature_matrix(_pairs(split, stats), items, SM.write_bucketed(users, path, "customer_id", n_buckets))


def _dataset(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    stats = _stats(split)
    return R.ranking_dataset(
        _popular_candidates(split, SP.known_users(split, "val"), stats=stats),
        SP.ground_truth(split, "val"),
        written(FE.item_features_from(stats), "item-features"),
        FE.user_features_from(stats),
        seen=FE.seen_items_from(stats),
    )


@query
def ranking_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return _dataset(spark, sf)


@query
def ranking_dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.ranking_dataset_stats(_dataset(spark, sf))


@query
def ranker_group_split(spark: SparkSession, sf: str) -> DataFrame:
    return R.ranker_group_split(_dataset(spark, sf)).select("customer_id", "article_id", "label", "held_out")


@query
def lambda_gradients(spark: SparkSession, sf: str) -> DataFrame:
    """The gradients of the first boosting round."""
    rows = LM.lambda_gradients(_dataset(spark, sf))
    # Adding 0 turns -0.0 into 0.0.
    return rows.withColumns({c: F.round(F.col(c) + F.lit(0.0), 9) for c in ("lam", "weight")})


@query
def rerank_by_score(spark: SparkSession, sf: str) -> DataFrame:
    """Many equal scores, so that the candidate order decides among them."""
    split = _split(spark, sf)
    scored = _popular_candidates(split).withColumn("score", (F.col("als_rank") % 7).cast("double"))
    return LM.rank_by_score(scored, S.EVAL_K)


# ---- metrics and evaluation ----------------------------------------------------------------------------


def _scores(spark: SparkSession, sf: str, k: int = S.EVAL_K) -> DataFrame:
    split = _split(spark, sf)
    truth = SP.ground_truth(split, "test")
    scores = ME.per_user_metrics(_recommendations(split, "test", k), truth, k)
    return scores.join(SP.known_users(split, "test"), "customer_id", "left_semi")


def _metric(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _scores(spark, sf).select("customer_id", F.round(name, 9).alias(name))

    return run


_QUERIES["dcg_at_k"] = _metric("dcg")
_QUERIES["ndcg_at_k"] = _metric("ndcg")
_QUERIES["recall_at_k"] = _metric("recall")
_QUERIES["map_at_k"] = _metric("map")


@query
def hit_rate_at_k(spark: SparkSession, sf: str) -> DataFrame:
    means = ME.mean_metrics(_scores(spark, sf))
    return means.select(F.round("hit_rate", 9).alias("hit_rate"), "n_users")


@query
def candidate_recall(spark: SparkSession, sf: str) -> DataFrame:
    means = ME.mean_metrics(_scores(spark, sf, S.N_CANDIDATES))
    return means.select(F.round("recall", 9).alias("recall"), F.round("hit_rate", 9).alias("hit_rate"), "n_users")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 9) for n in names})


@query
def evaluate_popularity(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf, cold=True)
    report = E.evaluate(P.PopularityModel.fit(split.train), split, "test")
    return _rounded(report, "ndcg", "recall", "map", "cold_start_rate")


def _comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The popularity list with and without the articles already bought, on val and test."""
    split = _split(spark, sf, cold=True)
    model = P.PopularityModel.fit(split.train)
    truths, asked = {}, None
    for which in SP.EVAL_SPLITS:
        users = SP.known_users(split, which)
        truths[which] = SP.ground_truth(split, which).join(users, "customer_id", "left_semi")
        asked = users if asked is None else asked.unionByName(users)
    recs = {"popularity": model.recommend(asked), "popularity_seen": model.recommend(asked, exclude_seen=False)}
    return E.compare_models(recs, truths)


@query
def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_comparison(spark, sf), "ndcg", "recall", "map", "hit_rate")


@query
def metric_lift(spark: SparkSession, sf: str) -> DataFrame:
    comparison = _rounded(_comparison(spark, sf), "ndcg", "recall", "map", "hit_rate")
    lift = E.metric_lift(written(comparison, "comparison"), "popularity")
    return _rounded(lift, "ndcg_lift", "recall_lift", "map_lift", "hit_rate_lift")


@query
def promotion_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(E.promotion_gate(_comparison(spark, sf), 0.004), "ndcg")


@query
def eval_report(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison written as a report and read back."""
    from basketlens.sources.bundle import write_report

    path = scratch_path(spark, "eval-report")
    comparison = _rounded(_comparison(spark, sf), "ndcg", "recall", "map", "hit_rate")
    write_report(comparison, path)
    return spark.read.schema(comparison.schema).json(path)


# ---- cold start and batch output -----------------------------------------------------------------------


def _by_article(recs: DataFrame) -> DataFrame:
    """The lists in another order than popularity's, so that the two routes can be told apart."""
    return recs.withColumn("rank", F.row_number().over(Window.partitionBy("customer_id").orderBy("article_id")))


def _routed(spark: SparkSession, sf: str, k: int) -> DataFrame:
    split = _split(spark, sf, cold=True)
    model = P.PopularityModel.fit(split.train)
    ranked = written(_by_article(model.recommend(split.train.select("customer_id"), k)), "ranked")
    users = split.transactions.filter(F.col("customer_id").isNotNull()).select("customer_id")
    return TS.route_cold_start(users, ranked, model, k)


@query
def cold_start_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf, 10)


@query
def scored_items(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of 32, the length at which half-even and half-up rounding differ."""
    return TS.scored_items(_routed(spark, sf, 32))


@query
def batch_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer asks, some for too many articles, some twice; lists are flattened for the comparison."""
    top_n = (1 + F.col("c_custkey") % 60).cast("int")
    requests = X.table(spark, sf, "customer").select(
        "c_custkey",
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("customer_id"),
        top_n.alias("top_n"),
        F.lit("sized").alias("request"),
    )
    again = requests.filter(F.col("c_custkey") % 10 == 0).withColumns(
        {"top_n": F.lit(None).cast("int"), "request": F.lit("plain")}
    )
    requests = requests.unionByName(again).drop("c_custkey")
    good, _ = TS.split_requests(requests)
    split = _split(spark, sf, cold=True)
    model = P.PopularityModel.fit(split.train)
    asked = split.train.select("customer_id").join(good.select("customer_id"), "customer_id", "left_semi")
    ranked = written(_by_article(model.recommend(asked, S.MAX_TOP_N)), "ranked")
    response = TS.batch_response(good, TS.route_cold_start(good, ranked, model, S.MAX_TOP_N))
    items = F.posexplode("recommendations").alias("position", "item")
    return response.select("customer_id", "request", "source", items).select(
        "customer_id", "request", "source", "position", "item.article_id", "item.score"
    )


# ---- learned stages ------------------------------------------------------------------------------------


@query
def id_index(spark: SparkSession, sf: str) -> DataFrame:
    return A.id_index(_split(spark, sf).train, "customer_id", "customer_idx")


@query
def user_item_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return A.user_item_confidence(_split(spark, sf).train)


@query
def candidate_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates by small integer factors, hence with many ties, from one block of articles and from several."""
    split = _split(spark, sf)
    given = A.ALSInput.of(split.train)
    c, p = F.col("customer_id").cast("long"), F.col("article_id").cast("long")
    customers = given.users.withColumn("features", F.array(c % 3, c % 5 - 2, F.lit(1)).cast("array<float>"))
    factors = F.array(p % 4, p % 7 - 3, p % 2).cast("array<float>")
    items = given.items.select(F.col("article_idx").alias("id"), factors.alias("features"))
    n_items = given.items.count()
    parts = [
        A.rank_candidates(customers, items, given.counts, SCORED, block).withColumn("blocks", F.lit(name))
        for name, block in (("one", n_items), ("several", n_items // 3 + 1))
    ]
    return parts[0].unionByName(parts[1])


# The documented parameters: 64 factors, 40 iterations, up to 300 rounds, a patience of 50.
TRAINING = PL.TrainingParams(val_start=X.VAL_START, test_start=X.TEST_START, ranker=LM.RankerParams(n_rounds=300))
_first_stage: dict[tuple[str, str], PL.FirstStage] = {}
_trained: dict[tuple[str, str], PL.TrainedModels] = {}


def first_stage(spark: SparkSession, sf: str) -> PL.FirstStage:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _first_stage:
        _first_stage[key] = PL.train_first_stage(X.cold_transactions(spark, sf), TRAINING)
    return _first_stage[key]


def trained(spark: SparkSession, sf: str) -> PL.TrainedModels:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trained:
        _trained[key] = PL.train_ranker(first_stage(spark, sf), TRAINING)
    return _trained[key]


def _buyers(models: PL.TrainedModels | PL.FirstStage) -> DataFrame:
    return models.split.transactions.select("customer_id").distinct()


@query
def als_candidates(spark: SparkSession, sf: str) -> DataFrame:
    models = first_stage(spark, sf)
    return models.als.recommend(_buyers(models))


@query
def lambdamart_rank(spark: SparkSession, sf: str) -> DataFrame:
    models = trained(spark, sf)
    return models.ranker.rank(models.dataset).select(
        "customer_id", "article_id", "label", "held_out", "score", "rank"
    )


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    return trained(spark, sf).ranker.importance()


@query
def two_stage_recommend(spark: SparkSession, sf: str) -> DataFrame:
    models = trained(spark, sf)
    return models.two_stage.recommend(_buyers(models))


@query
def evidence_run(spark: SparkSession, sf: str) -> DataFrame:
    return PL.compare_trained(trained(spark, sf), TRAINING)


@query
def als_grid(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    grid = [A.ALSParams(), A.ALSParams(alpha=15.0)]
    return A.als_grid(split.train, SP.ground_truth(split, "val"), grid)


@query
def als_halving(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    grid = [A.ALSParams(factors=16, iterations=8, alpha=a, regularization=r) for a in (15.0, 40.0) for r in (0.01, 0.1)]
    return A.als_halving(split.train, SP.ground_truth(split, "val"), grid)


# What SQL can tell about the learned results, although it cannot learn them.


def _list_facts(recs: DataFrame, seen: DataFrame, rank: str) -> DataFrame:
    bought = seen.select("customer_id", "article_id", F.lit(1).alias("_bought"))
    return recs.join(bought, ["customer_id", "article_id"], "left").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_listed"),
        F.count_distinct("article_id").alias("n_different"),
        F.count("_bought").alias("n_bought"),
        F.max(rank).cast("long").alias("last_rank"),
        *([F.min("source").alias("source")] if "source" in recs.columns else []),
    )


@query
def als_candidate_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _list_facts(als_candidates(spark, sf), first_stage(spark, sf).two_stage.seen, "als_rank")


@query
def two_stage_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _list_facts(two_stage_recommend(spark, sf), trained(spark, sf).two_stage.seen, "rank")


@query
def importance_facts(spark: SparkSession, sf: str) -> DataFrame:
    return feature_importance(spark, sf).agg(
        F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 9).alias("total")
    )


@query
def evidence_facts(spark: SparkSession, sf: str) -> DataFrame:
    return evidence_run(spark, sf).select("model", "split", "n_users")


@query
def als_grid_facts(spark: SparkSession, sf: str) -> DataFrame:
    return als_grid(spark, sf).select("config", "factors", "alpha", "n_users")


@query
def als_halving_facts(spark: SparkSession, sf: str) -> DataFrame:
    tried = als_halving(spark, sf).groupBy("round", "fitted_iterations")
    return tried.agg(F.count(F.lit(1)).alias("n_points"), F.sum("n_users").alias("n_users"))


def popular_for_test_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship question: what would popularity, learned before the test window, recommend in it?"""
    return _recommendations(_split(spark, sf), "test", S.EVAL_K)
