"""Run parameters of one experiment, validated on construction."""

from __future__ import annotations

from dataclasses import dataclass, field

# The labels a model may be trained on.
LABELS = ("target", "gender", "anchor_age", "race", "insurance")
MODELS = ("random_forest", "logistic_regression", "gbt", "mlp")
METRICS = ("accuracy", "f1", "precision", "recall", "balanced_accuracy", "roc_auc", "pr_auc")
FEATURE_SETS = ("V", "M", "MD", "VMD")


@dataclass(frozen=True)
class ExperimentConfig:
    window_days: int = 7
    bin_hours: int = 12
    label: str = "target"
    age_threshold: int = 30
    insurance_type: str = "Private"
    feature_set: str = "V"
    model: str = "random_forest"
    folds: int = 5
    inner_folds: int = 3
    test_size: float = 0.2
    seed: int = 42
    metrics: tuple[str, ...] = field(default=("recall", "f1", "roc_auc"))

    def __post_init__(self) -> None:
        if self.window_days <= 0:
            raise ValueError("window_days must be positive")
        if not 0 < self.bin_hours < 25:
            raise ValueError("bin_hours must be between 1 and 24")
        if self.label not in LABELS:
            raise ValueError(f"label must be one of {LABELS}")
        if self.label == "anchor_age" and not 18 <= self.age_threshold <= 90:
            raise ValueError("the age that splits the label has to lie in 18..90")
        if self.model not in MODELS:
            raise ValueError(f"model must be one of {MODELS}")
        if self.feature_set not in FEATURE_SETS:
            raise ValueError(f"feature_set must be one of {FEATURE_SETS}")
        if not 0 < self.test_size < 1:
            raise ValueError("test_size must be between 0 and 1")
        unknown = set(self.metrics) - set(METRICS)
        if unknown:
            raise ValueError(f"unknown metrics: {sorted(unknown)}")

    @property
    def last_bin(self) -> int:
        """Highest bin of the window; its far end is inclusive."""
        return self.window_days * 24 // self.bin_hours
