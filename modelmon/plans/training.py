"""Training: development bins, category ranks and limits for all given models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from modelmon import schemas
from modelmon.functions.columns import union_all
from modelmon.functions.dates import run_day
from modelmon.functions.sizes import all_reliable, bounded, reliable, side_by_side
from modelmon.operators import bins, development, stability
from modelmon.operators.calendar import history_dates, period_dates
from modelmon.operators.observations import merged
from modelmon.operators.runs import retraining_list, untrained_models
from modelmon.plans.feeds import PARTITION_MODES, ConfigTables, Feeds
from modelmon.sources.config import latest_partition
from modelmon.sources.sinks import KeptTables, write_partition

OUTPUTS = ["csi_psi_table", "category_baseline_rank", "metric_threshold_auto"]


def reference_date(models: DataFrame, column: str = "process_date") -> DataFrame:
    """Run date of each model in the period of its process date (not moved to a business day)."""
    return models.withColumn(
        "reference_date",
        run_day(F.col(column).cast("date"), F.col("frequency"), F.col("execution_monthly_day"), F.col("execution_weekday")),
    )


def dev_dates(refs: DataFrame, calendar: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Dates of development data: adds ``read_date`` to (ref_date, history_months, lag, ...).

    First and last readers take the history date itself; the other modes read its period.
    """
    stepped = history_dates(refs)
    as_is = F.col("reading_mode").isin("each", *PARTITION_MODES)
    steps = stepped.withColumns(
        {"_mode": F.col("reading_mode"), "reading_mode": F.when(as_is, F.col("reading_mode")).otherwise("as_is")}
    )
    read = period_dates(steps, calendar, present, "history_date")
    return read.withColumn("reading_mode", F.col("_mode")).drop("_mode")


class Trainer:
    def __init__(
        self, spark: SparkSession, config: ConfigTables, models: list[str] | None = None,
        overrides: dict[str, DataFrame] | None = None,
    ) -> None:
        self.spark, self.config = spark, config
        self.feeds = Feeds(spark, config, models, overrides, skip_unknown=True)

    def _dates(self, process_date: str, information_date: str | None) -> DataFrame:
        models = self.feeds.summary.withColumn("process_date", F.lit(process_date))
        if information_date is None:
            refs = reference_date(models)
        else:
            refs = models.withColumn("reference_date", F.lit(information_date).cast("date"))
        refs = refs.select("model_id", F.col("reference_date").alias("ref_date"))
        expanded = refs.join(self.feeds.per_source(), "model_id")
        read = dev_dates(expanded, self.feeds.calendar, self.feeds.present_dates(PARTITION_MODES))
        named = self.feeds.with_source_date(read).withColumns(
            {"information_date": F.lit(process_date), "side": F.lit("current")}
        )
        return named.groupBy("model_id", "information_date", "source_table", "side", "source_date").agg(
            F.min("read_date").alias("read_date")
        )

    def run(self, process_date: str, information_date: str | None = None) -> dict[str, DataFrame]:
        """The three artefact tables. Variables without data give no rows.

        Sources are read once for their values, which are counted; bins, ranks and limits start from the counted values.
        """
        dates = reliable(self._dates(process_date, information_date))
        literals = self.feeds.read_dates(dates)
        numbers, texts = side_by_side([lambda: self._counted(dates, literals, True), lambda: self._counted(dates, literals, False)])
        bin_parts, limit_parts, rank = [], [], None
        if numbers is not None:
            kinds = self.feeds.metadata.where(F.col("data_type") == "numeric").select("model_id", "variable", "var_type")
            quartiles = stability.quartiles(reliable(stability.quantiles(numbers)))
            bin_parts.append(lambda: bins.numeric_bins(numbers).drop("freq_dev"))
            limit_parts.append(lambda: development.auto_thresholds(numbers, quartiles, bounded(kinds)))
        if texts is not None:
            bin_parts.append(lambda: bins.categorical_bins(texts))
            limit_parts.append(lambda: development.auto_thresholds(texts))
            policy = self.config.category_policy
            rank = development.with_policy(bins.category_rank(texts), None if policy is None else latest_partition(policy))
        stamp = {"process_date": F.lit(process_date)}
        owner = self._owners()
        built = union_all(all_reliable(bin_parts)).withColumnRenamed("var_type", "type")
        built = built.join(bounded(owner), ["model_id", "type", "variable"]).withColumns({**stamp, "woe": F.lit(0.0)})
        limits = union_all(all_reliable(limit_parts)).withColumns(stamp)
        out = {
            "csi_psi_table": schemas.conform(built, "csi_psi_table"),
            "metric_threshold_auto": schemas.conform(limits, "metric_threshold_auto"),
        }
        if rank is not None:
            out["category_baseline_rank"] = schemas.conform(rank.withColumns(stamp), "category_baseline_rank")
        return out

    def _counted(self, dates: DataFrame, literals: dict, numeric: bool) -> DataFrame | None:
        """All numeric (or all text) development values with their occurrences."""
        counts = self.feeds.date_counts(literals, numeric)
        if counts is None:
            return None
        serving, _ = self.feeds.serving(dates, numeric)
        if numeric:
            return self.feeds.served(reliable(counts), serving)
        return reliable(merged(self.feeds.served(counts, serving)))

    def _owners(self) -> DataFrame:
        rows = []
        for feed in self.feeds.feeds:
            for r in feed.rows:
                rows.append(
                    (r["model_id"], r["var_type"], r["variable"], feed.spec.schema or "", feed.spec.table_or_path, feed.spec.date_column)
                )
        ddl = "model_id string, type string, variable string, schema string, table_name string, information_date_column string"
        return self.spark.createDataFrame(rows, ddl)


def train_models(
    spark: SparkSession,
    config: ConfigTables,
    process_date: str,
    out_dir: str,
    execution_id: str,
    information_date: str | None = None,
    models: list[str] | None = None,
    overrides: dict[str, DataFrame] | None = None,
    store: KeptTables | None = None,
) -> dict[str, str]:
    """Train and write the three tables by (process_date, model_id). Returns their paths.

    With a ``store``, artefacts of the same configuration and dates are looked up before anything is trained.
    """
    version, artefacts = {}, {}
    if store is not None:
        version = {**config.version(), "models": sorted(models or []), "process_date": process_date, "information_date": information_date}
        found = {table: store.find(table, version) for table in OUTPUTS}
        # The last one is kept last; models without categories have no ranks.
        if found[OUTPUTS[-1]] is not None:
            artefacts = {table: df for table, df in found.items() if df is not None}
    if not artefacts:
        made = Trainer(spark, config, models, overrides).run(process_date, information_date)
        artefacts = {table: made[table] for table in OUTPUTS if table in made}
        if store is not None:
            artefacts = {table: store.keep(df, table, version) for table, df in artefacts.items()}
    paths = {}
    for table, df in artefacts.items():
        paths[table] = f"{out_dir}/{table}"
        write_partition(df, paths[table], ["process_date", "model_id"], execution_id=execution_id, table=table)
    return paths


def train_new_models(
    spark: SparkSession, config: ConfigTables, changelog: DataFrame, process_date: str, out_dir: str, execution_id: str
) -> DataFrame:
    """Train every model marked new on a date; returns marked models left without limits."""
    marked = retraining_list(changelog, F.lit(process_date))
    models = sorted(r["model_id"] for r in marked.collect())
    if not models:
        return marked
    paths = train_models(spark, config, process_date, out_dir, execution_id, models=models)
    schema = schemas.get("metric_threshold_auto")
    trained = spark.read.schema(schema).parquet(paths["metric_threshold_auto"])
    return untrained_models(changelog.where(F.col("process_date") == process_date), trained)
