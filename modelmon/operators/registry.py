"""The metric registry.

A metric is an expression over a *family*: a per-key table that one pass over the
observations produces. All metrics of a family come out of the same pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import KEYS


@dataclass(frozen=True)
class Metric:
    name: str
    family: str
    value: Callable[[], Column]
    baseline: Callable[[], Column] | None = None
    needs_baseline: bool = False  # no row without baseline rows
    relative: bool = False  # loses its thresholds without baseline rows


_METRICS: dict[str, Metric] = {}
_FAMILIES: dict[str, Callable[..., DataFrame]] = {}


def register(metric: Metric) -> Metric:
    """Add or replace a metric; its family must exist by the time it is measured."""
    _METRICS[metric.name] = metric
    return metric


def register_family(name: str, build: Callable[..., DataFrame]) -> None:
    """A family builds ``KEYS + n_base + measures`` from its inputs."""
    _FAMILIES[name] = build


def forget(metric: str, family_name: str | None = None) -> None:
    """Take back what was registered."""
    _METRICS.pop(metric, None)
    if family_name is not None:
        _FAMILIES.pop(family_name, None)


def get(name: str) -> Metric:
    _load()
    if name not in _METRICS:
        raise KeyError(f"metric not registered: {name}")
    return _METRICS[name]


def names() -> list[str]:
    _load()
    return sorted(_METRICS)


def family(name: str) -> Callable[..., DataFrame]:
    _load()
    return _FAMILIES[name]


def measure(table: DataFrame, metrics: list[Metric], keep_undefined: bool = False) -> DataFrame:
    """One row per key and metric from a family table.

    Metrics that need a baseline give no row where no baseline row exists. What cannot be worked out is 0, or null
    with ``keep_undefined``.
    """
    entries = []
    for metric in metrics:
        value = metric.value().cast("double")
        baseline = metric.baseline() if metric.baseline else F.lit(None)
        entry = F.struct(
            F.lit(metric.name).alias("metric_name"),
            (value if keep_undefined else F.coalesce(value, F.lit(0.0))).alias("metric_value"),
            baseline.cast("double").alias("baseline_value"),
        )
        entries.append(F.when(F.col("n_base") > 0, entry) if metric.needs_baseline else entry)
    return table.select(*KEYS, F.explode(F.array_compact(F.array(*entries))).alias("m")).select(
        *KEYS, "m.metric_name", "m.metric_value", "m.baseline_value"
    )


def _load() -> None:
    from modelmon.operators import conjugate, quality, score, stability, target  # noqa: F401
