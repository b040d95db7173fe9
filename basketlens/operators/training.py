"""The training run: validate, split, fit both stages, compare, gate, export."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens import schemas as S
from basketlens.operators.als import ALSCandidates, ALSParams
from basketlens.operators.evaluate import compare_models, promotion_gate, sample_users
from basketlens.operators.features import interaction_stats
from basketlens.operators.lambdamart import LambdaMartModel, RankerParams, fit_lambdamart
from basketlens.operators.popularity import PopularityModel
from basketlens.operators.ranking import ranker_group_split, ranking_dataset, ranking_dataset_stats
from basketlens.operators.split import EVAL_SPLITS, TemporalSplit, ground_truth, known_users, make_temporal_split
from basketlens.operators.two_stage import TwoStageRecommender
from basketlens.operators.validate import check_articles, check_customers, check_transactions
from basketlens.plans.workspace import written
from basketlens.sources.bundle import is_finished, write_json

log = logging.getLogger(__name__)
T = TypeVar("T")


class PromotionBlocked(RuntimeError):
    """The trained model did not reach the metric threshold; nothing was exported."""


@dataclass
class TrainingParams:
    """What a training run may choose.

    ``max_train_users`` bounds the customers whose labelled pairs the ranker is fitted on; nothing else is bounded by
    it. Models are compared, and the gate decides, on all known customers of a window, unless ``eval_users`` asks for a
    sample of so many.
    """

    val_start: str = S.VAL_START
    test_start: str = S.TEST_START
    n_candidates: int = S.N_CANDIDATES
    max_negatives: int = S.MAX_NEGATIVES
    max_train_users: int = S.MAX_TRAIN_USERS
    eval_users: int | None = None
    k: int = S.EVAL_K
    seed: int = S.SEED
    als: ALSParams = field(default_factory=lambda: ALSParams(iterations=40))
    ranker: RankerParams = field(default_factory=lambda: RankerParams(n_rounds=300))


@dataclass
class TrainedModels:
    split: TemporalSplit
    two_stage: TwoStageRecommender
    dataset: DataFrame

    @property
    def als(self) -> ALSCandidates:
        return self.two_stage.als

    @property
    def ranker(self) -> LambdaMartModel:
        return self.two_stage.ranker

    @property
    def popularity(self) -> PopularityModel:
        return self.two_stage.popularity


@dataclass
class FirstStage:
    """Everything but the ranker: the split, the purchase counts, and the recommender without its second stage."""

    split: TemporalSplit
    two_stage: TwoStageRecommender

    @property
    def als(self) -> ALSCandidates:
        return self.two_stage.als


def train_first_stage(
    tx: DataFrame, params: TrainingParams | None = None, stage_path: str | None = None
) -> FirstStage:
    """Fit popularity, ALS and the feature tables. Raw transactions are aggregated once, into ``stats``.

    With ``stage_path`` the fitted ALS is stored there, and taken from there if a run before has finished it.
    """
    params = params or TrainingParams()
    split = make_temporal_split(tx, params.val_start, params.test_start)
    stats = written(interaction_stats(split.train), "stats")
    popularity = PopularityModel.fit(split.train, stats)
    als = _stage(
        tx.sparkSession, stage_path, "als", ALSCandidates.load, lambda: ALSCandidates.fit(split.train, params.als, stats=stats)
    )
    two_stage = TwoStageRecommender(als, None, popularity, params.n_candidates).fit_features(split.train, stats)
    return FirstStage(split, two_stage)


def _stage(
    spark: SparkSession, path: str | None, name: str, load: Callable[[SparkSession, str], T], fit: Callable[[], T]
) -> T:
    """A fitted part: from its stage folder if that was finished, else fitted and stored there."""
    if path is None:
        return fit()
    if is_finished(spark, f"{path}/{name}-done"):
        log.info("taking up the finished stage %s", name)
        return load(spark, f"{path}/{name}")
    part = fit()
    part.save(f"{path}/{name}")
    write_json(spark, {"stage": name}, f"{path}/{name}-done")
    return part


def train_ranker(
    first: FirstStage, params: TrainingParams | None = None, stage_path: str | None = None
) -> TrainedModels:
    """Fit the second stage on labelled candidates of the validation window's known customers.

    With ``stage_path`` the ranker is stored there, and taken from there if a run before has finished it.
    """
    params = params or TrainingParams()
    split, two_stage = first.split, first.two_stage
    learners = sample_users(known_users(split, "val"), params.max_train_users, params.seed)
    candidates = written(two_stage.als.recommend(learners, params.n_candidates), "candidates")
    dataset = ranking_dataset(
        candidates,
        ground_truth(split, "val"),
        two_stage.item_feats,
        two_stage.user_feats,
        max_negatives=params.max_negatives,
        seed=params.seed,
    )
    dataset = written(ranker_group_split(written(dataset, "ranking")), "ranking-split")
    ranker = _stage(
        candidates.sparkSession, stage_path, "ranker", LambdaMartModel.load, lambda: fit_lambdamart(dataset, params.ranker)
    )
    ranked = replace(two_stage, ranker=ranker)
    return TrainedModels(split, ranked, dataset)


def train_models(tx: DataFrame, params: TrainingParams | None = None) -> TrainedModels:
    """Both stages, one after the other."""
    return train_ranker(train_first_stage(tx, params), params)


def compare_trained(models: TrainedModels, params: TrainingParams) -> DataFrame:
    """Popularity, ALS alone and both stages on the known customers of val and test."""
    truths, asked = {}, None
    for which in EVAL_SPLITS:
        users = known_users(models.split, which)
        if params.eval_users is not None:
            users = sample_users(users, params.eval_users, params.seed)
        users = written(users, f"{which}-users")
        truths[which] = ground_truth(models.split, which).join(users, "customer_id", "left_semi")
        asked = users if asked is None else asked.unionByName(users)
    asked = written(asked.distinct(), "asked")
    # One scoring serves both: the ranker's candidates are the front of the longer list, and so are the first k.
    n = models.two_stage.n_candidates
    lists = written(models.als.recommend(asked, max(n, params.k)), "als-lists")
    candidates = lists.filter(F.col("als_rank") < n).withColumn("list_size", F.least("list_size", F.lit(n)))
    recs = {
        "popularity": models.popularity.recommend(asked, params.k),
        "als_raw": lists.withColumn("rank", F.col("als_rank") + 1),
        "two_stage": models.two_stage.recommend(asked, params.k, candidates=candidates),
    }
    return compare_models(recs, truths, params.k)


def run_fingerprint(tx: DataFrame, params: TrainingParams) -> str:
    """A name for a run: its parameters, and the number and the hashes of the purchases, in whatever order."""
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in S.REQUIRED_TRANSACTION_COLS])
    # Equal rows cancel out in one of the two sums only.
    row = tx.agg(F.count(F.lit(1)), F.bit_xor(spread), F.sum(F.pmod(spread, F.lit(1 << 31)))).first()
    return hashlib.sha256(json.dumps([asdict(params), *map(str, row)]).encode()).hexdigest()[:20]


def retrain(
    tx: DataFrame,
    articles: DataFrame,
    customers: DataFrame,
    out_path: str,
    params: TrainingParams | None = None,
    threshold: float = S.NDCG_THRESHOLD,
    date_range: tuple[str, str] = (S.MIN_DATE, S.MAX_DATE),
) -> DataFrame:
    """All stages in order. Hard data errors or a metric below the threshold stop before the export.

    Fitted stages are kept under ``out_path``/stages by a fingerprint of parameters and purchases, so a run that was broken off and is
    started again takes up those that it finished. Returns the comparison of the models on the validation and test windows.
    """
    params = params or TrainingParams()
    reports = [check_transactions(tx, *date_range), check_articles(articles), check_customers(customers)]
    for report in reports:
        report.raise_on_errors()
    stages = f"{out_path}/stages/{run_fingerprint(tx, params)}"
    models = train_ranker(train_first_stage(tx, params, stages), params, stages)
    comparison = written(compare_trained(models, params), "comparison")
    gate = promotion_gate(comparison.filter("model = 'two_stage' AND split = 'val'"), threshold).first()
    if not gate["promoted"]:
        raise PromotionBlocked(f"NDCG@{params.k} {gate['ndcg']:.4f} is below {threshold:.4f}")
    log.info("promoted: NDCG@%d %.4f", params.k, gate["ndcg"])
    stats = ranking_dataset_stats(models.dataset).first().asDict()
    meta = {
        "n_candidates": params.n_candidates,
        "max_negatives": params.max_negatives,
        "seed": params.seed,
        "k": params.k,
        "best_iteration": models.ranker.best_iteration,
        "n_transactions": tx.count(),
        "feature_importance": {r["feature"]: r["importance"] for r in models.ranker.importance().collect()},
        **stats,
    }
    models.two_stage.save(out_path, meta, comparison)
    return comparison
