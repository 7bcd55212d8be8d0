"""Parameters of an analysis. Every operator takes what it needs from here or as plain arguments."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

# Model inputs by name.
NUMERIC_FEATURES = (
    "recency_days",
    "frequency_orders",
    "monetary_total",
    "monetary_avg_order",
    "spending_intensity",
    "trend_slope_30d",
    "category_diversity",
    "support_tickets_90d",
    "avg_delivery_days",
    "return_rate",
    "days_since_registration",
)
CATEGORICAL_FEATURES = ("preferred_category", "customer_segment")

# All numeric columns of the feature matrix; the satisfaction score is kept but is no model input.
MATRIX_NUMERIC = NUMERIC_FEATURES[:8] + ("avg_satisfaction_score",) + NUMERIC_FEATURES[8:]


@dataclass(frozen=True)
class Cleaning:
    null_threshold: float = 0.40
    iqr_factor: float = 1.5
    protected: tuple[str, ...] = ("order_id", "customer_id", "order_date", "delivery_date")


@dataclass(frozen=True)
class Boosting:
    trees: int = 500
    depth: int = 6
    learning_rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    # Least sum of hessians on either side of a split, least gain of a split, penalties of leaf values.
    min_hessian: float = 5.0
    gamma: float = 1.0
    l1: float = 0.1
    l2: float = 1.0
    bins: int = 256


@dataclass(frozen=True)
class Oversampling:
    ratio: float = 0.5
    neighbours: int = 5
    seed: int = 42
    # Up to so many rows neighbours are exact; beyond, they are found by ordered tables and refinement.
    exact_up_to: int = 1_000_000


@dataclass(frozen=True)
class ThresholdSearch:
    min_recall: float = 0.80
    min_precision: float = 0.30
    start: float = 0.20
    end: float = 0.60
    step: float = 0.01


@dataclass(frozen=True)
class Evaluation:
    bootstrap_iterations: int = 1000
    bootstrap_alpha: float = 0.05
    folds: int = 5
    top_share: float = 0.20


@dataclass(frozen=True)
class Params:
    cutoff: date = date(2023, 9, 30)
    observation_days: int = 90
    prediction_days: int = 30
    holdout_train_share: float = 0.80
    seed: int = 245573
    pipeline_version: str = "1.0.0"
    cleaning: Cleaning = field(default_factory=Cleaning)
    boosting: Boosting = field(default_factory=Boosting)
    oversampling: Oversampling = field(default_factory=Oversampling)
    threshold: ThresholdSearch = field(default_factory=ThresholdSearch)
    evaluation: Evaluation = field(default_factory=Evaluation)

    @property
    def observation_start(self) -> date:
        return self.cutoff - timedelta(days=self.observation_days)

    @property
    def prediction_end(self) -> date:
        return self.cutoff + timedelta(days=self.prediction_days)

    def at(self, **changes) -> "Params":
        return replace(self, **changes)

    @classmethod
    def from_config(cls, config: Mapping[str, Mapping]) -> "Params":
        """Parameters from a parsed configuration file; absent entries keep their defaults."""

        def section(name: str, *path: str) -> Mapping:
            part = config.get(name) or {}
            for step in path:
                part = part.get(step) or {}
            return part

        def known(part: Mapping, **names: str) -> dict:
            return {own: part[theirs] for own, theirs in names.items() if theirs in part}

        boosting = known(
            section("model", "hyperparams"),
            trees="n_estimators", depth="max_depth", learning_rate="learning_rate", row_share="subsample",
            column_share="colsample_bytree", min_hessian="min_child_weight", gamma="gamma", l1="reg_alpha", l2="reg_lambda",
        )
        oversampling = known(
            section("model", "smote"), ratio="sampling_strategy", neighbours="k_neighbors", seed="random_state"
        )
        threshold = known(
            section("model", "threshold"),
            min_recall="min_recall", min_precision="min_precision", start="grid_start", end="grid_end", step="grid_step",
        )
        evaluation = known(
            section("evaluation"),
            bootstrap_iterations="bootstrap_iterations", bootstrap_alpha="bootstrap_alpha", folds="cv_folds",
        )
        whole = known(
            section("temporal"),
            cutoff="cutoff_date", observation_days="observation_window_days", prediction_days="prediction_window_days",
        )
        whole |= known(section("project"), seed="random_seed", pipeline_version="version")
        whole |= {
            "cleaning": Cleaning(**known(section("etl"), null_threshold="null_threshold", iqr_factor="iqr_factor")),
            "boosting": Boosting(**boosting),
            "oversampling": Oversampling(**oversampling),
            "threshold": ThresholdSearch(**threshold),
            "evaluation": Evaluation(**evaluation),
        }
        if isinstance(whole.get("cutoff"), str):
            whole["cutoff"] = date.fromisoformat(whole["cutoff"])
        return cls(**whole)
