"""Outcome metrics. Observations are those of target variables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from modelmon.functions.columns import KEYS
from modelmon.operators.bins import psi
from modelmon.operators.observations import sizes, value_counts
from modelmon.operators.registry import Metric, register, register_family
from modelmon.operators.stability import stored_psi


def target_psi(rows: DataFrame, bins: DataFrame | None = None) -> DataFrame:
    """PSI of the outcome on stored bins, else with one bin per distinct current value."""
    owner = ["model_id", "var_type", "variable"]
    loose = rows if bins is None else rows.join(bins.select(*owner).distinct(), owner, "left_anti")
    per_value = value_counts(loose)
    binned = per_value.where((F.col("n_cur") > 0) & F.col("value").isNotNull())
    own = sizes(per_value).drop("n_cur").join(psi(binned, "n_cur", "n_base"), KEYS, "left").fillna(0.0, ["psi"])
    if bins is None:
        return own
    stored = stored_psi(rows, bins).select(*KEYS, "n_base", "psi")
    return stored.unionByName(own)


register_family("target_psi", target_psi)


def _mean(side: str):
    return F.coalesce(F.col(f"mean_{side}"), F.lit(0.0))


EVENT_RATE = register(Metric(
    "event_rate", "counts",
    lambda: F.when(F.col("n_base") == 0, _mean("cur"))
    .when(_mean("base") != 0, F.try_divide(F.abs(_mean("cur") - _mean("base")), _mean("base")))
    .when(_mean("cur") > 0, 1.0)
    .otherwise(0.0),
    lambda: F.when(F.col("n_base") > 0, _mean("base")),
    relative=True,
))
PSI_TARGET = register(Metric("psi_target", "target_psi", lambda: F.col("psi"), lambda: F.lit(0.0)))
