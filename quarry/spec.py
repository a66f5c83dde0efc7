"""Feature specification and argument / schema guards (no Spark jobs)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of a feature table.

    Feature order is numeric + boolean + categorical; the preprocessing
    output order is numeric, categorical, boolean.
    """

    metadata: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    boolean: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    target: str = "label"
    event_time: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.boolean, *self.categorical]

    @property
    def scoring_columns(self) -> list[str]:
        return [*self.metadata, *self.features]

    @property
    def training_columns(self) -> list[str]:
        return [*self.metadata, *self.features, self.target]


def missing_columns(df: DataFrame, required) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required, context: str) -> None:
    """Schema-only check: raises with the missing names and the context."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{context}: missing required columns {sorted(missing)}")


def check_split_fractions(validation_fraction: float, test_fraction: float) -> None:
    if not 0 < validation_fraction < 1:
        raise ValueError("validation_fraction must be in (0, 1)")
    if not 0 <= test_fraction < 1:
        raise ValueError("test_fraction must be in [0, 1)")
    if validation_fraction + test_fraction >= 1:
        raise ValueError("validation_fraction + test_fraction must be < 1")
