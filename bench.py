"""Time the headline queries and the training stages; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every query
computes its full result, which is discarded by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from basketlens.operators import evaluate as E
from basketlens.operators import training as PL
from basketlens.operators.als import ALSCandidates
from basketlens.operators.features import interaction_stats
from basketlens.operators.lambdamart import fit_lambdamart
from basketlens.operators.popularity import PopularityModel
from basketlens.operators.ranking import ranker_group_split, ranking_dataset
from basketlens.operators.split import ground_truth, known_users, make_temporal_split
from basketlens.operators.two_stage import TwoStageRecommender
from basketlens.plans.workspace import written
from basketlens.registry.queries import TRAINING, all_queries
from basketlens.session import local_session
from basketlens.sources import fixtures as X

HEADLINE = [
    "load_latest_transactions",
    "stg_transactions",
    "validate_transactions",
    "mart_monthly_partitions",
    "fct_user_item_interactions",
    "fct_user_features",
    "fct_item_features",
    "temporal_split",
    "split_summary",
    "cold_start_items",
    "item_features",
    "user_features",
    "popularity_recommend",
    "candidate_pairs",
    "negative_sampling",
    "feature_matrix",
    "ranking_dataset",
    "ndcg_at_k",
    "candidate_recall",
    "evaluate_popularity",
    "compare_models",
    "batch_recommendations",
    "user_item_confidence",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    timings: dict[str, float] = {}

    def timed(name, fn):  # noqa: ANN001, ANN202
        start = time.time()
        out = fn()
        timings[name] = round(time.time() - start, 3)
        print(f"{name:32s} {timings[name]:8.2f}s", file=sys.stderr, flush=True)
        return out

    def consume(df) -> None:  # noqa: ANN001
        df.write.format("noop").mode("overwrite").save()

    timed("ingest_transactions", lambda: X.transactions(spark, sf_dir).count())
    catalogue = all_queries()
    for name in HEADLINE:
        timed(name, lambda fn=catalogue[name]: consume(fn(spark, sf_dir)))

    params = TRAINING
    split = make_temporal_split(X.cold_transactions(spark, sf_dir), params.val_start, params.test_start)
    stats = timed("train_stats", lambda: written(interaction_stats(split.train), "stats"))
    popularity = timed("train_popularity", lambda: PopularityModel.fit(split.train, stats))
    als = timed("train_als", lambda: ALSCandidates.fit(split.train, params.als, stats=stats))
    two = TwoStageRecommender(als, None, popularity, params.n_candidates)
    timed("train_features", lambda: two.fit_features(split.train, stats))
    users = E.sample_users(known_users(split, "val"), params.max_train_users, params.seed)
    candidates = timed("train_candidates", lambda: written(als.recommend(users, params.n_candidates), "candidates"))
    dataset = timed(
        "train_dataset",
        lambda: written(
            ranker_group_split(
                written(
                    ranking_dataset(candidates, ground_truth(split, "val"), two.item_feats, two.user_feats), "ranking"
                )
            ),
            "ranking-split",
        ),
    )
    two.ranker = timed(f"train_ranker_{params.ranker.n_rounds}_rounds", lambda: fit_lambdamart(dataset, params.ranker))
    history = two.ranker.history
    buyers = split.transactions.select("customer_id").distinct()
    timed("serve_all_customers", lambda: consume(two.recommend(buyers)))
    timed("compare_trained", lambda: consume(PL.compare_trained(PL.TrainedModels(split, two, dataset), params)))

    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries_and_training",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "ranker": {"rounds_fitted": max(len(history), two.ranker.best_iteration), "best_round": two.ranker.best_iteration},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
