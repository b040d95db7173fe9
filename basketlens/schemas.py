"""Column contracts and default parameters shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("t_dat", T.DateType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("article_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("sales_channel_id", T.IntegerType()),
    ]
)

# The columns each raw table must carry, and the ones its loader keeps.
REQUIRED_TRANSACTION_COLS = ["t_dat", "customer_id", "article_id", "price", "sales_channel_id"]
REQUIRED_ARTICLE_COLS = [
    "article_id",
    "product_type_name",
    "product_group_name",
    "colour_group_name",
    "department_name",
]
REQUIRED_CUSTOMER_COLS = ["customer_id"]
LOADED_ARTICLE_COLS = [*REQUIRED_ARTICLE_COLS, "detail_desc"]
LOADED_CUSTOMER_COLS = ["customer_id", "age", "club_member_status", "fashion_news_frequency"]
STAGED_ARTICLE_COLS = [
    "article_id",
    "product_type_name",
    "product_group_name",
    "graphical_appearance_name",
    "colour_group_name",
    "department_name",
    "index_group_name",
    "section_name",
    "garment_group_name",
    "detail_desc",
]

# The ranker's feature names, in training order.
ITEM_FEATURES = [
    "item_unique_buyers",
    "item_purchase_count",
    "item_avg_price",
    "item_popularity_score",
    "item_recency_days",
]
USER_FEATURES = [
    "user_purchase_count",
    "user_unique_items",
    "user_total_spend",
    "user_avg_spend",
    "user_active_days",
    "user_recency_days",
    "user_online_ratio",
]
PAIR_FEATURES = ["als_score", "als_rank", "ui_user_bought_item"]
FEATURE_COLS = ITEM_FEATURES + USER_FEATURES + PAIR_FEATURES

# Defaults of the cutoffs, sizes, domains and model parameters.
VAL_START = "2020-07-01"
TEST_START = "2020-08-12"
LATEST_ROWS = 2_000_000
VALID_CHANNELS = [1, 2]
MIN_DATE = "2018-01-01"
MAX_DATE = "2021-12-31"
MAX_NULL_SHARE = 0.05
ALS_FACTORS = 64
ALS_ITERATIONS = 20
ALS_REGULARIZATION = 0.01
ALS_ALPHA = 40.0
SEED = 42
N_CANDIDATES = 200
MAX_NEGATIVES = 50
EVAL_K = 10
TRAIN_GROUP_SHARE = 0.85
MAX_TRAIN_USERS = 8000
NDCG_THRESHOLD = 0.35
MAX_TOP_N = 50
