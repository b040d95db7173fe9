"""For each query that SQL can express: the same result over the same tables, by brute force."""

from __future__ import annotations

from basketlens import schemas as S

VAL, TEST = "DATE '1999-12-09'", "DATE '2000-10-05'"

TX = """tx AS (
  SELECT CAST(o_orderdate AS DATE) AS t_dat, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS customer_id,
         lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS article_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(1 + l_orderkey % 2 AS INTEGER) AS sales_channel_id,
         l_orderkey, l_linenumber, l_partkey, o_custkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

COLD = f"""ctx AS (
  SELECT * FROM tx WHERE NOT (t_dat < {VAL} AND (o_custkey % 6 = 0 OR l_partkey % 9 = 0)))"""

DIRTY = """dtx AS (
  SELECT CASE WHEN l_orderkey % 1021 = 0 THEN NULL ELSE t_dat END AS t_dat,
         CASE WHEN l_orderkey % 1009 = 0 THEN NULL ELSE customer_id END AS customer_id,
         CASE WHEN (l_orderkey + l_linenumber) % 1013 = 0 THEN NULL WHEN l_orderkey % 479 = 0 THEN 'x' || article_id
              ELSE article_id END AS article_id,
         CASE WHEN l_orderkey % 503 = 0 THEN NULL WHEN l_orderkey % 499 = 0 THEN 0
              WHEN l_orderkey % 509 = 0 THEN -price ELSE price END AS price,
         CASE WHEN l_orderkey % 487 = 0 THEN 9 ELSE sales_channel_id END AS sales_channel_id
  FROM tx)"""

ART = """art AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS article_id, p_type AS product_type_name,
         p_brand AS product_group_name, 'size ' || CAST(p_size AS VARCHAR) AS graphical_appearance_name,
         split_part(p_name, ' ', 1) AS colour_group_name, split_part(p_name, ' ', 2) AS department_name,
         p_type AS index_group_name, p_type AS section_name, p_type AS garment_group_name,
         p_brand || ' ' || p_name AS detail_desc, p_partkey
  FROM part)"""

_ART_COLS = ", ".join(S.STAGED_ARTICLE_COLS[1:])
_ART_REST = _ART_COLS.replace("department_name, ", "")

DART = f"""dart AS (
  SELECT CASE WHEN p_partkey % 101 <> 0 THEN article_id END AS article_id, {_ART_REST},
         CASE WHEN p_partkey % 7 <> 0 THEN department_name END AS department_name FROM art
  UNION ALL
  SELECT article_id, {_ART_REST}, department_name FROM art WHERE p_partkey % 97 = 0)"""

CUST = """cust AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id,
         CASE WHEN c_custkey % 23 <> 0 THEN 18 + c_custkey % 60 END AS age,
         c_mktsegment AS club_member_status,
         CASE c_custkey % 3 WHEN 0 THEN 'NONE' WHEN 1 THEN 'Regularly' ELSE 'Monthly' END AS fashion_news_frequency,
         c_acctbal > 0 AS active, c_custkey
  FROM customer)"""

DCUST = """dcust AS (
  SELECT CASE WHEN c_custkey % 89 <> 0 THEN customer_id END AS customer_id, age, club_member_status,
         fashion_news_frequency, active FROM cust
  UNION ALL
  SELECT customer_id, age, club_member_status, fashion_news_frequency, active FROM cust WHERE c_custkey % 97 = 0)"""

STG = """stg AS (
  SELECT t_dat AS transaction_date, customer_id, article_id, price, sales_channel_id FROM dtx
  WHERE customer_id IS NOT NULL AND article_id IS NOT NULL AND price > 0)"""

BUCKET = """CASE WHEN age < 25 THEN 'under_25' WHEN age < 35 THEN '25_34' WHEN age < 50 THEN '35_49'
         ELSE '50_plus' END AS age_bucket"""

# Sunday-start week of the year; days before the first Sunday are week 0.
WEEK = "CAST((dayofyear({d}) + 6 - dayofweek({d})) // 7 AS INTEGER)"

SCTX = [TX]


def _q(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _windows(src: str) -> str:
    return f"""train AS (SELECT * FROM {src} WHERE t_dat < {VAL}),
val AS (SELECT * FROM {src} WHERE t_dat >= {VAL} AND t_dat < {TEST}),
test AS (SELECT * FROM {src} WHERE t_dat >= {TEST}),
seen AS (SELECT DISTINCT customer_id, article_id FROM train),
train_users AS (SELECT DISTINCT customer_id FROM train),
known_val AS (SELECT DISTINCT customer_id FROM val WHERE customer_id IN (SELECT customer_id FROM train_users)),
known_test AS (SELECT DISTINCT customer_id FROM test WHERE customer_id IN (SELECT customer_id FROM train_users)),
truth_val AS (SELECT DISTINCT customer_id, article_id FROM val),
truth_test AS (SELECT DISTINCT customer_id, article_id FROM test),
counts AS (SELECT article_id, count(*) AS purchase_count FROM train GROUP BY article_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY purchase_count DESC, article_id) AS pop_rank FROM counts)"""


PLAIN = [TX, _windows("tx")]
COLDW = [TX, COLD, _windows("ctx")]


def _recs(name: str, users: str, k: int, exclude_seen: bool = True) -> str:
    """Every user against every article, bought ones removed, first k by popularity."""
    if not exclude_seen:
        return f"""{name} AS (SELECT u.customer_id, r.article_id, r.pop_rank AS rank
  FROM (SELECT DISTINCT customer_id FROM {users}) u CROSS JOIN ranked r WHERE r.pop_rank <= {k})"""
    return f"""{name} AS (SELECT customer_id, article_id, rank FROM (
  SELECT u.customer_id, r.article_id,
         row_number() OVER (PARTITION BY u.customer_id ORDER BY r.pop_rank) AS rank
  FROM (SELECT DISTINCT customer_id FROM {users}) u CROSS JOIN ranked r
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.customer_id = u.customer_id AND s.article_id = r.article_id))
  WHERE rank <= {k})"""


def _scores(name: str, recs: str, truth: str, known: str, k: int) -> str:
    """Per known user: DCG, NDCG, recall, average precision and hit flag."""
    return f"""{name} AS (
  SELECT t.customer_id, t.n_rel, coalesce(h.dcg, 0) AS dcg,
         coalesce(h.dcg, 0) / list_sum([1 / log2(i + 1) FOR i IN range(1, least(t.n_rel, {k}) + 1)]) AS ndcg,
         coalesce(h.hits, 0) / t.n_rel AS recall,
         coalesce(h.prec, 0) / least(t.n_rel, {k}) AS ap,
         CASE WHEN coalesce(h.hits, 0) > 0 THEN 1.0 ELSE 0.0 END AS hit
  FROM (SELECT customer_id, count(*) AS n_rel FROM {truth}
        WHERE customer_id IN (SELECT customer_id FROM {known}) GROUP BY customer_id) t
  LEFT JOIN (
    SELECT customer_id, sum(1 / log2(rank + 1)) AS dcg, count(*) AS hits, sum(nth / rank) AS prec
    FROM (SELECT r.customer_id, r.rank,
                 row_number() OVER (PARTITION BY r.customer_id ORDER BY r.rank) AS nth
          FROM {recs} r JOIN {truth} t USING (customer_id, article_id) WHERE r.rank <= {k})
    GROUP BY customer_id) h USING (customer_id))"""


_POPULAR = _recs("cand", "train", S.N_CANDIDATES)
_POPULAR_SEEN = _recs("cand", "train", S.N_CANDIDATES, exclude_seen=False)

_PAIRS = """pairs AS (
  SELECT c.customer_id, c.article_id, CAST(c.rank - 1 AS INTEGER) AS als_rank,
         CAST(count(*) OVER (PARTITION BY c.customer_id) - (c.rank - 1) AS DOUBLE) AS als_score,
         CASE WHEN s.customer_id IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ui_user_bought_item
  FROM cand c LEFT JOIN seen s USING (customer_id, article_id))"""

_LABELLED = """labelled AS (
  SELECT p.*, CASE WHEN t.customer_id IS NOT NULL THEN 1 ELSE 0 END AS label
  FROM pairs p LEFT JOIN truth_val t USING (customer_id, article_id))"""

_SAMPLED = f"""sampled AS (
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY customer_id, label
                 ORDER BY md5('{S.SEED}|' || customer_id || '|' || article_id), article_id) AS nth
    FROM labelled l WHERE customer_id IN (SELECT customer_id FROM labelled WHERE label = 1))
  WHERE label = 1 OR nth <= {S.MAX_NEGATIVES})"""

_ITEM_FEATS = """item_feats AS (
  SELECT article_id, CAST(count(DISTINCT customer_id) AS FLOAT) AS item_unique_buyers,
         CAST(count(*) AS FLOAT) AS item_purchase_count,
         CAST(CAST(sum(price) AS DOUBLE) / count(*) AS FLOAT) AS item_avg_price,
         CAST(CAST(count(DISTINCT customer_id) AS DOUBLE) / max(count(DISTINCT customer_id)) OVER () AS FLOAT)
           AS item_popularity_score,
         CAST((SELECT max(t_dat) FROM train) - max(t_dat) AS FLOAT) AS item_recency_days
  FROM train GROUP BY article_id)"""

_USER_FEATS = """user_feats AS (
  SELECT customer_id, CAST(count(*) AS FLOAT) AS user_purchase_count,
         CAST(count(DISTINCT article_id) AS FLOAT) AS user_unique_items,
         CAST(CAST(sum(price) AS DOUBLE) AS FLOAT) AS user_total_spend,
         CAST(CAST(sum(price) AS DOUBLE) / count(*) AS FLOAT) AS user_avg_spend,
         CAST(max(t_dat) - min(t_dat) AS FLOAT) AS user_active_days,
         CAST((SELECT max(t_dat) FROM train) - max(t_dat) AS FLOAT) AS user_recency_days,
         CAST(CAST(sum(CASE WHEN sales_channel_id = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS FLOAT)
           AS user_online_ratio
  FROM train GROUP BY customer_id)"""


def _features(src: str, *kept: str) -> str:
    cols = ", ".join(f"CAST(coalesce({c}, 0) AS FLOAT) AS {c}" for c in S.FEATURE_COLS)
    return f"""SELECT {', '.join(['customer_id', 'article_id', *kept])}, {cols}
FROM {src} LEFT JOIN item_feats USING (article_id) LEFT JOIN user_feats USING (customer_id)"""


_TX_CHECKS = """SELECT * FROM (
  SELECT 'transactions' AS table_name, 'error' AS severity, 'null_customer_id' AS check_name,
         count(*) FILTER (customer_id IS NULL) AS n_rows FROM dtx
  UNION ALL SELECT 'transactions', 'error', 'null_article_id', count(*) FILTER (article_id IS NULL) FROM dtx
  UNION ALL SELECT 'transactions', 'error', 'null_date', count(*) FILTER (t_dat IS NULL) FROM dtx
  UNION ALL SELECT 'transactions', 'error', 'invalid_channel',
         count(*) FILTER (sales_channel_id IS NULL OR sales_channel_id NOT IN (1, 2)) FROM dtx
  UNION ALL SELECT 'transactions', 'error', 'null_price', count(*) FILTER (price IS NULL) FROM dtx
  UNION ALL SELECT 'transactions', 'error', 'non_positive_price', count(*) FILTER (price <= 0) FROM dtx
  UNION ALL SELECT 'transactions', 'warning', 'date_out_of_range',
         count(*) FILTER (t_dat < DATE '1996-01-01' OR t_dat > DATE '2000-12-31') FROM dtx
  UNION ALL SELECT 'transactions', 'warning', 'non_numeric_article_id',
         count(*) FILTER (NOT regexp_full_match(article_id, '[0-9]+')) FROM dtx
  UNION ALL SELECT 'transactions', 'warning', 'duplicate_rows',
         (SELECT CAST(sum(n - 1) AS BIGINT) FROM
            (SELECT count(*) AS n FROM dtx GROUP BY customer_id, article_id, t_dat)))
WHERE n_rows > 0"""

_ART_ATTRS = [c for c in S.REQUIRED_ARTICLE_COLS if c != "article_id"]

_ART_CHECKS = (
    """SELECT * FROM (
  SELECT 'articles' AS table_name, 'error' AS severity, 'null_article_id' AS check_name,
         count(*) FILTER (article_id IS NULL) AS n_rows FROM dart
  UNION ALL SELECT 'articles', 'error', 'duplicate_article_id',
         (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM dart GROUP BY article_id))
"""
    + "\n".join(
        f"  UNION ALL SELECT 'articles', 'warning', 'nulls:{c}', CASE WHEN count(*) FILTER ({c} IS NULL) > "
        f"{S.MAX_NULL_SHARE} * count(*) THEN count(*) FILTER ({c} IS NULL) ELSE 0 END FROM dart"
        for c in _ART_ATTRS
    )
    + ")\nWHERE n_rows > 0"
)

_CUST_CHECKS = """SELECT * FROM (
  SELECT 'customers' AS table_name, 'error' AS severity, 'null_customer_id' AS check_name,
         count(*) FILTER (customer_id IS NULL) AS n_rows FROM dcust
  UNION ALL SELECT 'customers', 'error', 'duplicate_customer_id',
         (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM dcust GROUP BY customer_id)))
WHERE n_rows > 0"""


def _means(scores: str) -> str:
    return f"""SELECT round(avg(ndcg), 9) AS ndcg, round(avg(recall), 9) AS recall, round(avg(ap), 9) AS map,
       round(avg(hit), 9) AS hit_rate, count(*) AS n_users FROM {scores}"""


def _comparison() -> list[str]:
    ctes = [*COLDW]
    parts = []
    for which in ("val", "test"):
        for model, exclude in (("popularity", True), ("popularity_seen", False)):
            recs, scores = f"r_{model}_{which}", f"s_{model}_{which}"
            ctes.append(_recs(recs, f"known_{which}", S.EVAL_K, exclude))
            ctes.append(_scores(scores, recs, f"truth_{which}", f"known_{which}", S.EVAL_K))
            parts.append(
                f"""SELECT '{model}' AS model, '{which}' AS split, avg(ndcg) AS ndcg, avg(recall) AS recall,
       avg(ap) AS map, avg(hit) AS hit_rate, count(*) AS n_users FROM {scores}"""
            )
    ctes.append("comparison AS (" + "\nUNION ALL ".join(parts) + ")")
    return ctes


_COMPARED = """SELECT model, split, round(ndcg, 9) AS ndcg, round(recall, 9) AS recall, round(map, 9) AS map,
       round(hit_rate, 9) AS hit_rate, n_users FROM comparison"""


# Known customers get their list by article id, the others by popularity.
_ROUTED = """SELECT customer_id, article_id, CAST(CASE WHEN customer_id IN (SELECT customer_id FROM train_users)
    THEN row_number() OVER (PARTITION BY customer_id ORDER BY article_id) ELSE rank END AS INTEGER) AS rank,
  CASE WHEN customer_id IN (SELECT customer_id FROM train_users) THEN 'als+lgbm' ELSE 'popularity' END AS source"""

_GRADIENTS = f"""placed AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY als_rank) AS r FROM sampled),
ideal AS (SELECT customer_id, list_sum([1 / log2(i + 1) FOR i IN range(1, least(n, {S.EVAL_K}) + 1)]) AS best
  FROM (SELECT customer_id, count(*) FILTER (label = 1) AS n FROM sampled GROUP BY customer_id)),
swaps AS (SELECT p.customer_id, p.article_id AS up, n.article_id AS down,
  abs(1 / log2(p.r + 1) - 1 / log2(n.r + 1)) / best AS s
  FROM placed p JOIN placed n ON p.customer_id = n.customer_id AND p.label = 1 AND n.label = 0
  JOIN ideal i ON i.customer_id = p.customer_id WHERE least(p.r, n.r) <= 30),
pulls AS (SELECT customer_id, up AS article_id, s / 2 AS lam, s / 4 AS weight FROM swaps
  UNION ALL SELECT customer_id, down, -s / 2, s / 4 FROM swaps),
gradients AS (SELECT customer_id, article_id, sum(lam) AS lam, sum(weight) AS weight FROM pulls GROUP BY 1, 2)"""

_SMALL_SCORES = """numbered AS (SELECT article_id, CAST(article_id AS BIGINT) AS p,
  row_number() OVER (ORDER BY article_id) - 1 AS idx FROM counts),
products AS (SELECT customer_id, article_id, idx, c % 3 * (p % 4) + (c % 5 - 2) * (p % 7 - 3) + p % 2 AS score
  FROM (SELECT customer_id, CAST(customer_id AS BIGINT) AS c FROM train_users) CROSS JOIN numbered),
listed AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, idx) AS nth FROM products u
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.customer_id = u.customer_id AND s.article_id = u.article_id))"""

# How many articles each customer has not bought.
_UNSEEN = """unseen AS (SELECT customer_id, (SELECT count(*) FROM counts) - coalesce(n, 0) AS n, n IS NOT NULL AS known
  FROM (SELECT DISTINCT customer_id FROM ctx) LEFT JOIN
    (SELECT customer_id, count(*) AS n FROM seen GROUP BY customer_id) USING (customer_id))"""


def _routed(k: int) -> list[str]:
    return [
        *COLDW,
        _recs("listed", "ctx", k),
        f"routed AS ({_ROUTED} FROM listed)",
    ]


def _per_user(metric: str, name: str) -> str:
    return _q(
        f"SELECT customer_id, round({metric}, 9) AS {name} FROM scores",
        *PLAIN,
        _recs("recs", "known_test", S.EVAL_K),
        _scores("scores", "recs", "truth_test", "known_test", S.EVAL_K),
    )


def all_oracles() -> dict[str, str]:
    tx_cols = "t_dat, customer_id, article_id, CAST(price AS DOUBLE) AS price, sales_channel_id"
    art_cols = ", ".join(S.LOADED_ARTICLE_COLS)
    dataset = [*PLAIN, _POPULAR, _PAIRS, _LABELLED, _SAMPLED]
    return {
        "load_latest_transactions": _q(
            f"""SELECT {tx_cols} FROM tx
ORDER BY t_dat DESC, customer_id, article_id, price, sales_channel_id LIMIT 5000""",
            TX,
        ),
        "load_articles": _q(f"SELECT {art_cols} FROM art", ART),
        "load_customers": _q(
            "SELECT 'c' || customer_id AS customer_id, age, club_member_status, fashion_news_frequency FROM cust",
            CUST,
        ),
        "raw_table_roundtrip": _q(
            """SELECT 'transactions' AS table_name, count(*) AS rows_in, count(*) AS rows_out FROM tx
UNION ALL SELECT 'articles', count(*), count(*) FROM part
UNION ALL SELECT 'customers', count(*), count(*) FROM customer""",
            TX,
        ),
        "mart_monthly_partitions": _q(
            """SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS n_rows,
       CAST(sum(n) AS BIGINT) AS purchases
FROM (SELECT customer_id, article_id, transaction_date, count(*) AS n FROM stg
      WHERE transaction_date IS NOT NULL GROUP BY ALL) GROUP BY 1""",
            TX, DIRTY, STG,
        ),
        "stg_transactions": _q(
            f"""SELECT transaction_date, customer_id, article_id, CAST(price AS DOUBLE) AS price, sales_channel_id,
       CAST(year(transaction_date) AS INTEGER) AS transaction_year,
       CAST(month(transaction_date) AS INTEGER) AS transaction_month,
       {WEEK.format(d='transaction_date')} AS transaction_week FROM stg""",
            TX, DIRTY, STG,
        ),
        "stg_articles": _q(
            f"SELECT article_id, {_ART_COLS} FROM dart WHERE article_id IS NOT NULL", ART, DART
        ),
        "stg_customers": _q(
            f"""SELECT customer_id, age, club_member_status, fashion_news_frequency, active AS is_active,
       {BUCKET} FROM dcust WHERE customer_id IS NOT NULL""",
            CUST, DCUST,
        ),
        "normalize_article_id": """SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS article_id,
       '99' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS long_id FROM part""",
        "normalize_customer_id": "SELECT c_custkey, lower(c_name) AS customer_id FROM customer",
        "calendar_parts": f"""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS transaction_year,
       CAST(month(o_orderdate) AS INTEGER) AS transaction_month,
       CAST(strftime(o_orderdate, '%U') AS INTEGER) AS transaction_week FROM orders""",
        "age_bucket": _q(f"SELECT customer_id, age, {BUCKET} FROM cust", CUST),
        "validate_transactions": _q(_TX_CHECKS, TX, DIRTY),
        "invalid_channels": _q(
            """SELECT sales_channel_id, count(*) AS n_rows FROM dtx
WHERE sales_channel_id IS NULL OR sales_channel_id NOT IN (1, 2) GROUP BY 1""",
            TX, DIRTY,
        ),
        "transaction_stats": _q(
            """SELECT count(*) AS row_count, min(t_dat) AS date_min, max(t_dat) AS date_max,
       count(DISTINCT customer_id) AS unique_customers, count(DISTINCT article_id) AS unique_articles FROM dtx""",
            TX, DIRTY,
        ),
        "month_statistics": _q(
            """SELECT CAST(date_trunc('month', t_dat) AS DATE) AS month, count(*) AS row_count,
       count(*) FILTER (customer_id IS NULL) AS null_customer_id, count(*) FILTER (article_id IS NULL) AS null_article_id,
       count(*) FILTER (price IS NULL) AS null_price, min(price) AS price_min, max(price) AS price_max,
       min(CAST(t_dat AS DATE)) AS date_min, max(CAST(t_dat AS DATE)) AS date_max,
       TRUE AS customers_near, TRUE AS articles_near, TRUE AS median_near
FROM dtx GROUP BY 1""",
            TX, DIRTY,
        ),
        "duplicate_transactions": _q(
            """SELECT customer_id, article_id, t_dat, count(*) - 1 AS extra_rows FROM dtx
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
            TX, DIRTY,
        ),
        "validate_articles": _q(_ART_CHECKS, ART, DART),
        "article_null_rates": _q(
            "\nUNION ALL ".join(
                f"""SELECT '{c}' AS column_name, CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*) AS null_share,
       count(*) FILTER ({c} IS NULL) > {S.MAX_NULL_SHARE} * count(*) AS over_limit FROM dart"""
                for c in _ART_ATTRS
            ),
            ART, DART,
        ),
        "validate_customers": _q(_CUST_CHECKS, CUST, DCUST),
        "validation_report": _q(
            f"{_TX_CHECKS}\nUNION ALL {_ART_CHECKS}\nUNION ALL {_CUST_CHECKS}", TX, DIRTY, ART, DART, CUST, DCUST
        ),
        "temporal_split": _q(
            f"""SELECT {tx_cols}, CASE WHEN t_dat < v THEN 'train' WHEN t_dat < t THEN 'val' ELSE 'test' END AS split
FROM tx, (SELECT min(t_dat) + CAST(round_even((max(t_dat) - min(t_dat)) * 0.75, 0) AS INTEGER) AS v,
                 min(t_dat) + CAST(round_even((max(t_dat) - min(t_dat)) * 0.875, 0) AS INTEGER) AS t FROM tx)""",
            TX,
        ),
        "split_summary": _q(
            f"""SELECT 'train' AS split, count(*) AS n_rows, min(t_dat) AS first_day, {VAL} - 1 AS last_day,
       count(DISTINCT customer_id) AS n_users, 0 AS cold_start_users FROM train
UNION ALL SELECT 'val', count(*), {VAL}, {TEST} - 1, count(DISTINCT customer_id),
       count(DISTINCT customer_id) - (SELECT count(*) FROM known_val) FROM val
UNION ALL SELECT 'test', count(*), {TEST}, max(t_dat), count(DISTINCT customer_id),
       count(DISTINCT customer_id) - (SELECT count(*) FROM known_test) FROM test""",
            *COLDW,
        ),
        "ground_truth": _q("SELECT * FROM truth_test", *PLAIN),
        "user_seen_items": _q("SELECT * FROM seen", *PLAIN),
        "cold_start_users": _q(
            "SELECT DISTINCT customer_id FROM test EXCEPT SELECT customer_id FROM train_users", *COLDW
        ),
        "known_users": _q("SELECT * FROM known_test", *COLDW),
        "cold_start_rate": _q(
            """SELECT n - k AS cold_start_n, n AS n_users, CAST(n - k AS DOUBLE) / n AS cold_start_rate
FROM (SELECT count(DISTINCT customer_id) AS n, (SELECT count(*) FROM known_test) AS k FROM test)""",
            *COLDW,
        ),
        "cold_start_items": _q(
            """SELECT count(*) FILTER (cold) AS cold_items, count(*) AS n_items,
       round(avg(CASE WHEN cold THEN 1.0 ELSE 0.0 END), 9) AS cold_item_share,
       (SELECT round(avg(CASE WHEN all_cold THEN 1.0 ELSE 0.0 END), 9) FROM users) AS all_cold_user_share,
       (SELECT round(avg(n), 9) FROM users) AS mean_truth_size
FROM items""",
            *COLDW,
            """items AS (SELECT article_id, article_id NOT IN (SELECT article_id FROM train) AS cold
  FROM (SELECT DISTINCT article_id FROM test))""",
            """users AS (SELECT customer_id, count(*) AS n, bool_and(cold) AS all_cold
  FROM truth_test JOIN items USING (article_id) GROUP BY customer_id)""",
        ),
        "sample_users": _q(
            f"SELECT customer_id FROM known_test ORDER BY md5('{S.SEED}|' || customer_id), customer_id LIMIT 500", *PLAIN
        ),
        "fct_user_item_interactions": _q(
            """SELECT customer_id, article_id, transaction_date, count(*) AS purchase_count,
       CAST(sum(price) AS DOUBLE) AS total_spend, round(1 + ln(count(*)), 9) AS implicit_confidence
FROM stg GROUP BY 1, 2, 3""",
            TX, DIRTY, STG,
        ),
        "fct_user_features": _q(
            f"""SELECT customer_id, age, age_bucket, club_member_status, fashion_news_frequency, is_active,
       total_unique_items, total_purchases, total_spend, avg_item_price, active_days, last_purchase_date,
       first_purchase_date, CAST(DATE '2001-12-31' - last_purchase_date AS INTEGER) AS days_since_last_purchase
FROM (SELECT customer_id, count(DISTINCT article_id) AS total_unique_items, count(*) AS total_purchases,
             CAST(sum(price) AS DOUBLE) AS total_spend, CAST(sum(price) AS DOUBLE) / count(*) AS avg_item_price,
             count(DISTINCT transaction_date) AS active_days, max(transaction_date) AS last_purchase_date,
             min(transaction_date) AS first_purchase_date FROM stg GROUP BY customer_id)
LEFT JOIN (SELECT customer_id, age, {BUCKET}, club_member_status, fashion_news_frequency, active AS is_active
           FROM cust) USING (customer_id)""",
            TX, DIRTY, STG, CUST,
        ),
        "fct_item_features": _q(
            """SELECT article_id, product_type_name, product_group_name, colour_group_name, department_name,
       index_group_name, section_name, garment_group_name, coalesce(buyers, 0) AS unique_buyers,
       coalesce(purchases, 0) AS total_purchases, coalesce(mean_price, 0) AS avg_price, last_sold_date,
       CAST(DATE '2001-12-31' - last_sold_date AS INTEGER) AS days_since_last_sold,
       CAST(coalesce(buyers, 0) AS DOUBLE) / max(coalesce(buyers, 0)) OVER () AS popularity_score
FROM art LEFT JOIN (
  SELECT article_id, count(DISTINCT customer_id) AS buyers, count(*) AS purchases,
         CAST(sum(price) AS DOUBLE) / count(*) AS mean_price, max(transaction_date) AS last_sold_date
  FROM stg GROUP BY article_id) USING (article_id)""",
            TX, DIRTY, STG, ART,
        ),
        "item_features": _q("SELECT * FROM item_feats", *PLAIN, _ITEM_FEATS),
        "user_features": _q("SELECT * FROM user_feats", *PLAIN, _USER_FEATS),
        "popularity_counts": _q("SELECT * FROM counts", *PLAIN),
        "popularity_top_k": _q(
            "SELECT article_id, purchase_count, CAST(pop_rank AS INTEGER) AS pop_rank FROM ranked WHERE pop_rank <= 100",
            *PLAIN,
        ),
        "popularity_recommend": _q(
            "SELECT customer_id, article_id, CAST(rank AS INTEGER) AS rank FROM recs", *COLDW, _recs("recs", "ctx", 10)
        ),
        "candidate_pairs": _q("SELECT * FROM pairs", *PLAIN, _POPULAR_SEEN, _PAIRS),
        "candidate_pairs_by_bitmaps": _q("SELECT * FROM pairs", *PLAIN, _POPULAR_SEEN, _PAIRS),
        "history_sizes": _q("SELECT customer_id, count(*) AS n_articles FROM seen GROUP BY customer_id", *PLAIN),
        "labelled_pairs": _q(
            "SELECT customer_id, article_id, label FROM labelled", *PLAIN, _POPULAR, _PAIRS, _LABELLED
        ),
        "negative_sampling": _q("SELECT customer_id, article_id, als_rank, label FROM sampled", *dataset),
        "feature_matrix": _q(_features("pairs"), *PLAIN, _POPULAR, _PAIRS, _ITEM_FEATS, _USER_FEATS),
        "feature_matrix_from_buckets": _q(_features("pairs"), *PLAIN, _POPULAR, _PAIRS, _ITEM_FEATS, _USER_FEATS),
        "ranking_dataset": _q(_features("sampled", "label"), *dataset, _ITEM_FEATS, _USER_FEATS),
        "ranking_dataset_stats": _q(
            """SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_groups,
       count(*) FILTER (label = 1) AS n_positive, count(*) FILTER (label = 0) AS n_negative FROM sampled""",
            *dataset,
        ),
        "ranker_group_split": _q(
            f"""SELECT customer_id, article_id, label, pos >= floor(n * CAST({S.TRAIN_GROUP_SHARE} AS DOUBLE)) AS held_out
FROM sampled JOIN (SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS pos, count(*) OVER () AS n
                   FROM (SELECT DISTINCT customer_id FROM sampled)) USING (customer_id)""",
            *dataset,
        ),
        "lambda_gradients": _q(
            """SELECT customer_id, article_id, round(coalesce(lam, 0), 9) AS lam, round(coalesce(weight, 0), 9) AS weight
FROM sampled LEFT JOIN gradients USING (customer_id, article_id)""",
            *dataset,
            _GRADIENTS,
        ),
        "rerank_by_score": _q(
            f"""SELECT customer_id, article_id, CAST(als_rank AS INTEGER) AS als_rank, score, CAST(nth AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, als_rank) AS nth
      FROM (SELECT customer_id, article_id, rank - 1 AS als_rank, CAST((rank - 1) % 7 AS DOUBLE) AS score FROM cand))
WHERE nth <= {S.EVAL_K}""",
            *PLAIN,
            _POPULAR,
        ),
        "candidate_scoring": _q(
            """SELECT blocks, customer_id, CAST(idx AS INTEGER) AS article_idx, CAST(nth - 1 AS INTEGER) AS als_rank,
       CAST(count(*) OVER (PARTITION BY blocks, customer_id) AS INTEGER) AS list_size, CAST(score AS FLOAT) AS model_score
FROM listed CROSS JOIN (VALUES ('one'), ('several')) b(blocks) WHERE nth <= 20""",
            *PLAIN,
            _SMALL_SCORES,
        ),
        "als_candidate_facts": _q(
            f"""SELECT customer_id, least(n, {S.N_CANDIDATES}) AS n_listed, least(n, {S.N_CANDIDATES}) AS n_different,
       0 AS n_bought, least(n, {S.N_CANDIDATES}) - 1 AS last_rank FROM unseen WHERE known AND n > 0""",
            *COLDW,
            _UNSEEN,
        ),
        "two_stage_facts": _q(
            f"""SELECT customer_id, least(n, {S.EVAL_K}) AS n_listed, least(n, {S.EVAL_K}) AS n_different, 0 AS n_bought,
       least(n, {S.EVAL_K}) AS last_rank, CASE WHEN known THEN 'als+lgbm' ELSE 'popularity' END AS source
FROM unseen WHERE n > 0""",
            *COLDW,
            _UNSEEN,
        ),
        "importance_facts": f"SELECT {len(S.FEATURE_COLS)} AS n_features, CAST(1 AS DOUBLE) AS total",
        "evidence_facts": _q(
            """SELECT model, split, n_users FROM (VALUES ('popularity'), ('als_raw'), ('two_stage')) m(model), (
  SELECT 'val' AS split, count(*) AS n_users FROM known_val UNION ALL SELECT 'test', count(*) FROM known_test)""",
            *COLDW,
        ),
        "als_grid_facts": _q(
            f"""SELECT config, {S.ALS_FACTORS} AS factors, alpha, (SELECT count(*) FROM known_val) AS n_users
FROM (VALUES (0, CAST({S.ALS_ALPHA} AS DOUBLE)), (1, CAST(15 AS DOUBLE))) g(config, alpha)""",
            *PLAIN,
        ),
        "als_halving_facts": _q(
            """SELECT round, fitted_iterations, n_points, n_points * (SELECT count(*) FROM known_val) AS n_users
FROM (VALUES (0, 2, 2), (1, 4, 1), (2, 8, 1)) g(round, fitted_iterations, n_points)""",
            *PLAIN,
        ),
        "clean_transactions": _q(
            f"SELECT {tx_cols} FROM tx WHERE l_orderkey % 1021 <> 0 AND l_orderkey % 1019 <> 0", TX
        ),
        "unreadable_transactions": _q(
            """SELECT CASE WHEN l_orderkey % 1021 = 0 THEN 't_dat' ELSE 'price' END AS reason, count(*) AS n_rows
FROM tx WHERE l_orderkey % 1021 = 0 OR l_orderkey % 1019 = 0 GROUP BY 1""",
            TX,
        ),
        "marts_job_items": _q(
            """SELECT article_id, coalesce(buyers, 0) AS unique_buyers, coalesce(purchases, 0) AS total_purchases,
       CAST(DATE '2001-12-31' - last_sold AS INTEGER) AS days_since_last_sold
FROM art LEFT JOIN (SELECT article_id, count(DISTINCT customer_id) AS buyers, count(*) AS purchases,
                           max(transaction_date) AS last_sold FROM stg GROUP BY article_id) USING (article_id)""",
            TX, DIRTY, STG, ART,
        ),
        "marts_job_users": _q(
            """SELECT 'c' || customer_id AS customer_id, age, items AS total_unique_items, purchases AS total_purchases,
       days AS active_days
FROM (SELECT customer_id, count(DISTINCT article_id) AS items, count(*) AS purchases,
             count(DISTINCT transaction_date) AS days FROM stg GROUP BY customer_id) LEFT JOIN cust USING (customer_id)""",
            TX, DIRTY, STG, CUST,
        ),
        "dcg_at_k": _per_user("dcg", "dcg"),
        "ndcg_at_k": _per_user("ndcg", "ndcg"),
        "recall_at_k": _per_user("recall", "recall"),
        "map_at_k": _per_user("ap", "map"),
        "hit_rate_at_k": _q(
            "SELECT round(avg(hit), 9) AS hit_rate, count(*) AS n_users FROM scores",
            *PLAIN,
            _recs("recs", "known_test", S.EVAL_K),
            _scores("scores", "recs", "truth_test", "known_test", S.EVAL_K),
        ),
        "candidate_recall": _q(
            """SELECT round(avg(recall), 9) AS recall, round(avg(hit), 9) AS hit_rate, count(*) AS n_users
FROM scores""",
            *PLAIN,
            _recs("recs", "known_test", S.N_CANDIDATES),
            _scores("scores", "recs", "truth_test", "known_test", S.N_CANDIDATES),
        ),
        "evaluate_popularity": _q(
            """SELECT 'test' AS split, 10 AS k, round(avg(ndcg), 9) AS ndcg, round(avg(recall), 9) AS recall,
       round(avg(ap), 9) AS map, count(*) AS n_users, (SELECT n - k FROM total) AS cold_start_n,
       (SELECT round(CAST(n - k AS DOUBLE) / n, 9) FROM total) AS cold_start_rate FROM scores""",
            *COLDW,
            _recs("recs", "known_test", S.EVAL_K),
            _scores("scores", "recs", "truth_test", "known_test", S.EVAL_K),
            """total AS (SELECT count(DISTINCT customer_id) AS n, (SELECT count(*) FROM known_test) AS k FROM test)""",
        ),
        "compare_models": _q(_COMPARED, *_comparison()),
        "eval_report": _q(_COMPARED, *_comparison()),
        "metric_lift": _q(
            "SELECT c.model, c.split, "
            + ", ".join(f"round((c.{m} - b.{m}) / b.{m}, 9) AS {m}_lift" for m in ("ndcg", "recall", "map", "hit_rate"))
            + "\nFROM rounded c JOIN rounded b ON c.split = b.split AND b.model = 'popularity'",
            *_comparison(),
            f"rounded AS ({_COMPARED})",
        ),
        "promotion_gate": _q(
            """SELECT model, split, round(ndcg, 9) AS ndcg, CAST(0.004 AS DOUBLE) AS threshold,
       ndcg >= 0.004 AS promoted FROM comparison""",
            *_comparison(),
        ),
        "cold_start_fallback": _q("SELECT * FROM routed", *_routed(10)),
        "scored_items": _q(
            """SELECT *, round_even(1 - CAST(rank - 1 AS DOUBLE) / count(*) OVER (PARTITION BY customer_id), 4) AS score
FROM routed""",
            *_routed(32),
        ),
        "batch_recommendations": _q(
            """SELECT customer_id, request, source, CAST(rank - 1 AS INTEGER) AS position, article_id,
       round_even(1 - CAST(rank - 1 AS DOUBLE) / count(*) OVER (PARTITION BY customer_id, request), 4) AS score
FROM routed JOIN asked USING (customer_id) WHERE rank <= top_n""",
            *COLDW,
            """asked AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id, 1 + c_custkey % 60 AS top_n,
    'sized' AS request FROM customer WHERE 1 + c_custkey % 60 <= 50
  UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 10, 'plain' FROM customer WHERE c_custkey % 10 = 0)""",
            _recs("recs", "asked", S.MAX_TOP_N),
            f"routed AS ({_ROUTED} FROM recs)",
        ),
        "id_index": _q(
            "SELECT customer_id, CAST(row_number() OVER (ORDER BY customer_id) - 1 AS INTEGER) AS customer_idx FROM train_users",
            *PLAIN,
        ),
        "user_item_confidence": _q(
            f"""SELECT CAST(u.idx AS INTEGER) AS customer_idx, CAST(a.idx AS INTEGER) AS article_idx,
       CAST(1 + {S.ALS_ALPHA} * c.n AS FLOAT) AS confidence
FROM (SELECT customer_id, article_id, count(*) AS n FROM train GROUP BY 1, 2) c
JOIN (SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS idx FROM train_users) u USING (customer_id)
JOIN (SELECT article_id, row_number() OVER (ORDER BY article_id) - 1 AS idx FROM counts) a USING (article_id)""",
            *PLAIN,
        ),
    }
