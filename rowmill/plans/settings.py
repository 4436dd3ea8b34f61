"""Settings of the jobs: one place for column lists and choices."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

from rowmill.operators.binning import CREDIT_SCORE_BINS, CREDIT_SCORE_CODES, CREDIT_SCORE_TOP


@dataclass(frozen=True)
class Settings:
    """Defaults describe the customer churn table."""

    key: str = "CustomerId"
    target: str = "Exited"
    drop_columns: tuple[str, ...] = ("RowNumber", "Firstname", "Lastname")
    critical_columns: tuple[str, ...] = ("Firstname",)
    imputer: str | None = None  # the name of a registered imputer, which runs before the fills
    fill_methods: Mapping[str, str] = field(default_factory=lambda: {"Age": "mean"})
    fill_labels: Mapping[str, str] = field(default_factory=lambda: {"Gender": "Unknown"})
    predict_labels: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    label_domain: tuple[str, ...] = ("Male", "Female")
    outlier_columns: tuple[str, ...] = ("CreditScore", "Age", "NumOfProducts")
    outlier_method: str = "remove"
    detection_method: str = "iqr"
    iqr_threshold: float = 1.5
    sigmas: float = 3.0
    min_outliers: int = 2
    bins: Mapping[str, Mapping] = field(
        default_factory=lambda: {"CreditScore": dict(CREDIT_SCORE_BINS)}
    )
    bin_exact: Mapping[str, Mapping] = field(
        default_factory=lambda: {"CreditScore": dict(CREDIT_SCORE_TOP)}
    )
    bin_otherwise: str | None = None
    nominal_columns: tuple[str, ...] = ("Geography", "Gender")
    ordinal_mappings: Mapping[str, Mapping[str, int]] = field(
        default_factory=lambda: {"CreditScoreBins": dict(CREDIT_SCORE_CODES)}
    )
    scaling: str = "minmax"
    scale_columns: tuple[str, ...] = ("Balance", "Age", "EstimatedSalary")
    split_method: str = "stratified"
    test_size: float = 0.2
    seed: int = 42
    fit_on: str = "train"  # 'all' takes statistics over both parts
    rebalance: str = "none"  # 'smote' makes the classes of the training part equal
    neighbors: int = 5

    def __post_init__(self):
        choices = {
            "outlier_method": ("remove", "cap"),
            "detection_method": ("iqr", "sigma"),
            "scaling": ("minmax", "standard"),
            "split_method": ("random", "stratified"),
            "fit_on": ("train", "all"),
            "rebalance": ("none", "smote"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} is one of {allowed}, not {getattr(self, name)!r}")

    def with_options(self, **options) -> Settings:
        unknown = set(options) - {f.name for f in fields(self)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **options)

    def to_json(self) -> str:
        """All settings as text, from which ``from_json`` makes them again."""
        return json.dumps({f.name: _plain(getattr(self, f.name)) for f in fields(self)}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Settings:
        return cls(**{name: _restored(value) for name, value in json.loads(text).items()})


def _plain(value):
    """Mappings as pairs, since a key of JSON is always text."""
    if isinstance(value, Mapping):
        return {"pairs": [[k, _plain(v)] for k, v in value.items()]}
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def _restored(value):
    if isinstance(value, dict):
        return {k: _restored(v) for k, v in value["pairs"]}
    return tuple(_restored(v) for v in value) if isinstance(value, list) else value
