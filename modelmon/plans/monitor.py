"""The monitoring run: all metrics of all models and dates as one set of DataFrames."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelmon import schemas
from modelmon.functions.columns import KEYS, clean_double, one_per_key, smallest_per_key, union_all
from modelmon.operators import conjugate, quality, registry, score, stability, summary, target, thresholds
from modelmon.operators.alerts import alert_aggregate
from modelmon.operators.availability import availability_done, data_availability, newest_dates
from modelmon.operators.bins import normalise_bins
from modelmon.operators.observations import merged
from modelmon.operators.runs import execution_log
from modelmon.functions.sizes import all_reliable, bounded, reliable, run_tables, side_by_side
from modelmon.plans import wide
from modelmon.plans.feeds import SINGLE_MODES, ConfigTables, Feed, Feeds, by_model
from modelmon.sources.config import latest_partition
from modelmon.sources.sinks import KeptTables, drop_partitions, is_there, replace_partitions

RUN = ["model_id", "information_date"]
PARTITION_ORDER = ["information_date", "model_id"]
SUMMARY_COLUMNS = [*KEYS, "data_type", "statistic", "statistic_value", "statistic_value_str"]

# The variable under which joint input metrics are stored.
INPUTS_VARIABLE, INPUTS_TYPE = "__INPUTS__", "input"
# Metrics that are measured on stored bins.
ON_BINS = ["psi_canonical", "psi_approved", "psi_rejected", "psi_target"]


@dataclass
class RunFrames:
    """Everything a run yields, as lazy DataFrames."""

    results: DataFrame
    summaries: DataFrame
    missing: DataFrame
    failed: DataFrame


class Monitor:
    """Monitoring of a set of models over a set of dates.

    Models share one job. The plan grows with the sources that are read, not with the models that read them, and never
    with the data.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: ConfigTables,
        models: list[str] | None = None,
        overrides: dict[str, DataFrame] | None = None,
    ) -> None:
        self.spark, self.config = spark, config
        self.feeds = Feeds(spark, config, models, overrides, isolate=True)

    # -- inputs ---------------------------------------------------------------------

    def _bins(self) -> DataFrame:
        if self.config.csi_bins is None:
            ddl = "model_id string, type string, variable string, bin int"
            return normalise_bins(self.spark.createDataFrame([], ddl))
        return normalise_bins(latest_partition(self.config.csi_bins))

    def _latest(self, table: DataFrame | None) -> DataFrame | None:
        return None if table is None else latest_partition(table)

    def _top_n(self) -> tuple[DataFrame | int, int | None]:
        policy = self._latest(self.config.category_policy)
        if policy is None:
            return quality.DEFAULT_TOP_N, None
        policy = one_per_key(policy.select("model_id", "variable", F.col("top_n_threshold").alias("top_n")), ["model_id", "variable"])
        largest = policy.agg(F.max("top_n").alias("m")).first()["m"]
        return policy, largest

    # -- run ------------------------------------------------------------------------

    def run(self, runs: DataFrame) -> RunFrames:
        """Metric results with lights, variable summaries, missing and failed runs.

        ``runs`` holds (model_id, information_date). An undefined metric has no value. Models whose configuration
        cannot be read are no part of the plan; they come out as ``failed``.

        Sources are read for one wide aggregate (plain counts and moments) and once for their values, which are counted by
        the date they are stored under and written, whatever runs and sides read that date; quantiles, bins, bands, categories
        and concentration start from the counted values.
        """
        failed = self._failed(runs)
        if not self.feeds.feeds:
            none = runs.select("model_id", F.col("information_date").cast("string").alias("information_date")).limit(0)
            return RunFrames(*(schemas.conform(none, t) for t in ("metric_result", "variable_summary")), none.select(
                "*", F.lit("").alias("error_message"), F.lit(0).alias("variables_missing")), failed)
        dates, lagged = self.resolved(runs)
        literals = self.feeds.read_dates(dates)
        numbers = self.feeds.observations(dates, literals, True)
        texts = self.feeds.observations(dates, literals, False)
        found = reliable(self._found(dates))
        bins = self._stored_bins()
        first: dict[str, Callable[[], DataFrame | None]] = {
            "missing": lambda: reliable(self._missing(runs, dates, found)),
            "wide": lambda: reliable(wide.measures(self.feeds, dates, literals)),
            "pairs": lambda: self.pairs(dates, lagged, literals),
            "numbers": lambda: None if numbers is None else self._counted(dates, literals),
            "texts": lambda: None if texts is None else reliable(self._counted_texts(dates, literals)),
        }
        fixed = dict(zip(first, side_by_side(list(first.values()))))
        counts, words = fixed["numbers"], fixed["texts"]
        independent = self._plain_measures(dates, literals, found, numbers, texts, fixed, bins)
        shared: list[Callable[[], DataFrame | None]] = [
            lambda: None if counts is None else stability.quantiles(self._ranked(counts)),
            lambda: None if words is None else stability.dynamic_categories(words),
        ]
        spread, dynamic, *measured = all_reliable([*shared, *independent])
        late = self._spread_measures(counts, words, spread, dynamic, bins)
        summaries = lambda: self._summaries(fixed["wide"], words, spread)
        *more, described = all_reliable([*late, summaries])
        results = union_all([*measured, *more])
        wanted = thresholds.applicable_metrics(self.feeds.metadata.select("model_id", "variable", "var_type", "data_type"))
        wanted = wanted.select("model_id", "variable", "var_type", "metric_name").unionByName(self._joint_wanted())
        results = results.join(wanted, ["model_id", "variable", "var_type", "metric_name"], "left_semi")
        missing = fixed["missing"]
        results = results.join(missing.select(*RUN), RUN, "left_anti")
        resolved = thresholds.resolve_thresholds(
            results, self._latest(self.config.auto_thresholds), self._latest(self.config.thresholds)
        )
        summaries_kept = described.join(missing.select(*RUN), RUN, "left_anti")
        return RunFrames(thresholds.with_status(self._with_baseline_date(resolved)), summaries_kept, missing, failed)

    def resolved(self, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The dates to read for the runs: at the sources' own lags, and all sources at the lag of the model's target."""
        resolved = reliable(self.feeds.resolve(runs, self._target_lags()))
        return resolved.where("NOT lagged").drop("lagged"), resolved.where("lagged").drop("lagged")

    def _counted(self, dates: DataFrame, literals: dict) -> DataFrame:
        """All numbers as counted values. Only counts by date are written; what reads several dates gets its values merged."""
        serving, once = self.feeds.serving(dates, True)
        counts = self.feeds.served(reliable(self.feeds.date_counts(literals, True)), serving)
        return counts if once else reliable(merged(counts))

    def _counted_texts(self, dates: DataFrame, literals: dict) -> DataFrame:
        serving, _ = self.feeds.serving(dates, False)
        return merged(self.feeds.served(self.feeds.date_counts(literals, False), serving))

    def _failed(self, runs: DataFrame) -> DataFrame:
        """(model_id, information_date, error_message) of the runs whose model cannot be measured as configured."""
        asked = runs.select("model_id", F.date_format(F.col("information_date").cast("date"), "yyyy-MM-dd").alias("information_date")).distinct()
        return asked.join(self.feeds.failures, "model_id")

    def _stored_bins(self) -> DataFrame | None:
        """The bins, if there are any."""
        if self.config.csi_bins is None:
            return None
        bins = reliable(self._bins())
        return None if bins.isEmpty() else bins

    def _with_baseline_date(self, results: DataFrame) -> DataFrame:
        """Results on stored bins carry the date these bins were made."""
        stored = self.config.csi_bins
        if stored is None or "process_date" not in stored.columns:
            return results.withColumn("baseline_process_date", F.lit(None).cast("string"))
        made = latest_partition(stored).groupBy("model_id", F.col("type").alias("var_type"), "variable").agg(
            F.max(F.col("process_date").cast("string")).alias("baseline_process_date")
        ).withColumn("metric_name", F.explode(F.array(*[F.lit(m) for m in ON_BINS])))
        return results.join(made, ["model_id", "var_type", "variable", "metric_name"], "left").select(*results.columns, "baseline_process_date")

    def _ranked(self, counts: DataFrame) -> DataFrame:
        """Numbers whose order statistics are asked for: targets only if one of them is numeric."""
        numeric_target = any(r["var_type"] == "target" and r["data_type"] == "numeric" for r in self.feeds.rows)
        return counts if numeric_target else counts.where(F.col("var_type") != "target")

    def _joint_wanted(self) -> DataFrame:
        rows = []
        for metric in registry.names():
            family = registry.get(metric).family
            if family in ("roc", "fit", "lift", "separation"):
                rows.append((conjugate.SCORE_VARIABLE, conjugate.SCORE_TYPE, metric))
            elif family == "correlation":
                rows.append((INPUTS_VARIABLE, INPUTS_TYPE, metric))
        names = ("variable", "var_type", "metric_name")
        each = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])
        return self.feeds.summary.select("model_id", F.explode(each).alias("m")).select("model_id", "m.*")

    def _found(self, dates: DataFrame) -> DataFrame:
        """Current read dates that the sources really hold."""
        return dates.where(F.col("side") == "current").join(
            self.feeds.held_texts(), ["source_table", "source_date"], "left_semi"
        )

    def _missing(self, runs: DataFrame, dates: DataFrame, found: DataFrame) -> DataFrame:
        """Runs in which some source has no current rows."""
        asked = runs.select("model_id", F.date_format(F.col("information_date").cast("date"), "yyyy-MM-dd").alias("information_date")).distinct()
        used = self.feeds.metadata.select("model_id", "source_table").distinct()
        absent = asked.join(used, "model_id").join(found.select(*RUN, "source_table").distinct(), [*RUN, "source_table"], "left_anti")
        return absent.groupBy(*RUN).agg(
            F.concat(F.lit("no data for "), F.concat_ws(", ", F.sort_array(F.collect_set("source_table")))).alias("error_message"),
            F.count("*").cast("int").alias("variables_missing"),
        )

    def _plain_measures(self, dates, literals, found, numbers, texts, fixed, bins) -> list[Callable[[], DataFrame]]:
        """One small job per family that needs no order statistics; each yields metric rows."""
        counts, pairs, get = fixed["numbers"], fixed["pairs"], registry.get
        tasks: list[Callable[[], DataFrame]] = []

        def add(names: list[str], table: Callable[[], DataFrame]) -> None:
            tasks.append(lambda: registry.measure(table(), [get(m) for m in names], True))

        for family, metrics in self._custom_families().items():
            add(metrics, lambda family=family: registry.family(family)(numbers if numbers is not None else texts))
        add(["null_rate", "population_variation", "range_violation", "approval_rate", "event_rate"], lambda: fixed["wide"])
        if counts is not None:
            scores = counts.where(F.col("var_type") == "score")
            add(["entropy"], lambda: score.entropy(scores))
            add(["concentration_gini"], lambda: score.concentration(scores))
            add(["psi_target"], lambda: target.target_psi(merged(counts.where(F.col("var_type") == "target")), bins))
            if bins is not None:
                add(["psi_approved", "psi_rejected"], lambda: score.split_psi(scores, bins, self.feeds.cutoffs()))
        if fixed["texts"] is not None:
            top_n, largest = self._top_n()
            add(
                ["dominant_category_rate", "category_composition_drift", "cardinality_ratio"],
                lambda: quality.categories(fixed["texts"], top_n, largest),
            )
        add(["completeness"], lambda: self._completeness(dates, found))
        if pairs is not None:
            for family, names in (
                ("roc", ["auc", "gini"]), ("fit", ["brier_score", "calibration_slope"]),
                ("lift", ["lift_top_decile"]), ("separation", ["ks_score_target"]),
            ):
                add(names, lambda family=family: registry.family(family)(pairs))
        for joint in self._correlations(dates, literals):
            add(["correlation_drift"], joint)
        return tasks

    def _spread_measures(self, counts, words, spread, dynamic, bins) -> list[Callable[[], DataFrame]]:
        """The families that start from quantiles or from the frequent categories."""
        tasks: list[Callable[[], DataFrame]] = []

        def add(names: list[str], table: Callable[[], DataFrame]) -> None:
            tasks.append(lambda: registry.measure(table(), [registry.get(m) for m in names], True))

        if counts is not None:
            features = counts.where(F.col("var_type").isin("raw", "input", "transformed"))
            graded = counts.where(F.col("var_type") != "target")
            add(["median_shift", "psi_dynamic", "ks_vs_dev", "tail_shift"], lambda: spread)
            add(["cardinality_ratio", "outlier_rate"], lambda: quality.values(features, stability.quartiles(spread)))
            add(["psi_canonical"], lambda: stability.canonical_psi(graded, bins, spread, True))
        if words is not None:
            add(["psi_dynamic"], lambda: dynamic)
            add(["psi_canonical"], lambda: stability.canonical_psi(words, bins, dynamic, False))
        return tasks

    # Families measured above; anything else registered by a user runs on all observations.
    BUILT_IN = {
        "counts", "distinct", "outliers", "categories", "completeness", "quantiles", "canonical", "correlation",
        "entropy", "concentration", "split_psi", "target_psi", "roc", "fit", "lift", "separation",
    }

    def _custom_families(self) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for name in registry.names():
            family = registry.get(name).family
            if family not in self.BUILT_IN:
                found.setdefault(family, []).append(name)
        return found

    def _completeness(self, dates: DataFrame, found: DataFrame) -> DataFrame:
        variables = self.feeds.metadata.select("model_id", "source_table", "variable", "var_type")
        current = dates.where(F.col("side") == "current")

        def keyed(df: DataFrame) -> DataFrame:
            return df.join(variables, ["model_id", "source_table"]).select(*KEYS, F.col("source_date").alias("date"))

        return quality.completeness(keyed(current), keyed(found))

    # -- score with target ----------------------------------------------------------

    def _feed_of(self, row) -> Feed:
        return next(f for f in self.feeds.feeds if f.source_table == row["source_table"] and row in f.rows)

    def _meeting(self, asked: list[tuple[Feed, DataFrame]], models: list[str]) -> DataFrame:
        """(RUN, side, read_date, s0, s1, ..., _meet): the dates under which sources that are joined store the same read date.

        ``_meet`` names one set of such dates. It is the same for all models, runs and sides that read them, so their rows are
        joined once.
        """
        on = [*RUN, "side", "read_date"]
        each = []
        for i, (feed, when) in enumerate(asked):
            mine = when.where(F.col("model_id").isin([m for m in models if m in feed.models])).select(*on).distinct()
            named = self.feeds.with_source_date(mine.withColumn("source_table", F.lit(feed.source_table)))
            each.append(named.select(*on, F.col("source_date").alias(f"s{i}")))
        together = reduce(lambda a, b: a.join(b, on), each)
        return reliable(together.withColumn("_meet", F.concat_ws("\x1f", *[f"s{i}" for i in range(len(each))])))

    def _meeting_rows(
        self, feed: Feed, number: int, meeting: DataFrame, columns: dict[str, str], read: list
    ) -> tuple[DataFrame, list[str]]:
        """One row of a source for each set of dates and keys, with the named columns as numbers, and the names of the keys."""
        served = meeting.select(F.col(f"s{number}").alias("source_date"), "_meet").distinct()
        rows = self.feeds.dated(feed, read, list(columns), keys=True).join(bounded(served), "source_date")
        keys = [c for c in (feed.spec.canonical_keys or feed.spec.key_columns) if c in rows.columns]
        plain = rows.select("_meet", *keys, *[clean_double(F.col(c)).alias(name) for c, name in columns.items()])
        return smallest_per_key(plain, ["_meet", *keys], list(columns.values())), keys

    def _score_targets(self) -> dict[tuple, list[tuple[str, int]]]:
        """(score source and column, target source and column) to the models read so and their target's lag."""
        groups: dict[tuple, list[tuple[str, int]]] = {}
        for model, rows in by_model(self.feeds.rows).items():
            scores = [r for r in rows if r["var_type"] == "score"]
            targets = [r for r in rows if r["var_type"] == "target"]
            if scores and targets:
                s, t = scores[-1], targets[-1]
                ends = tuple((self.feeds.feeds.index(self._feed_of(r)), r["source_column"]) for r in (s, t))
                groups.setdefault(ends, []).append((model, t["lag"] or 0))
        return groups

    def _target_lags(self) -> DataFrame | None:
        lags = [m for models in self._score_targets().values() for m in models]
        return self.spark.createDataFrame(lags, "model_id string, lag int") if lags else None

    def pairs(self, dates: DataFrame, lagged: DataFrame, literals: dict) -> DataFrame | None:
        """Score and outcome of the same customer and cohort: the score is read at the target's lag (``lagged``).

        Models that read their score and their target alike are one join, with the model and the cohort's date among its
        keys: the plan follows the sources, not the models.
        """
        groups = self._score_targets()
        if not groups:
            return None
        frames = []
        on = [*RUN, "side", "read_date"]
        for ((score_feed, score_column), (target_feed, target_column)), members in groups.items():
            models = [m for m, _ in members]
            s, t = self.feeds.feeds[score_feed], self.feeds.feeds[target_feed]
            cohort = dates.where((F.col("source_table") == t.source_table) & F.col("model_id").isin(models))
            aligned = lagged.where(F.col("source_table") == s.source_table).join(cohort.select(*on), on, "left_semi")
            read = sorted({d for m in models for d in literals.get((m, t.source_table), [])})
            meeting = self._meeting([(s, aligned), (t, cohort)], models)
            scores, score_keys = self._meeting_rows(s, 0, meeting, {score_column: "score"}, read)
            targets, target_keys = self._meeting_rows(t, 1, meeting, {target_column: "target"}, read)
            shared = [k for k in score_keys if k in target_keys]
            joined = conjugate.join_pairs(scores, targets, ["_meet", *shared])
            tie = conjugate.tie_order(shared) if shared else F.lit(None).cast("double")
            joined = reliable(joined.select("_meet", "score", "target", tie.alias("tie")))
            rows = joined.join(bounded(self._binary_only(joined, meeting)), "_meet")
            frames.append(conjugate.as_pairs(rows, F.col("tie") if shared else conjugate.tie_order(["read_date"])))
        return union_all(frames)

    def _binary_only(self, joined: DataFrame, meeting: DataFrame) -> DataFrame:
        """The dates of runs with a 0/1 outcome, which score-target metrics need; runs with any other value get none."""
        odd = joined.where(F.col("target").isNotNull() & ~F.col("target").isin(0.0, 1.0)).select("_meet").distinct()
        runs = meeting.join(odd, "_meet", "left_semi").select(*RUN).distinct()
        return reliable(meeting.join(runs, RUN, "left_anti").select(*RUN, "side", "read_date", "_meet"))

    # -- joint inputs ---------------------------------------------------------------

    def joint_inputs(self, dates: DataFrame, literals: dict) -> list[tuple[DataFrame, list[str], dict[str, list[str]]]]:
        """(joined inputs of some models, their columns, each model's own columns); one entry per set of sources.

        Inputs meet by one join per source table, at the anchor dates. Models that read the same sources share the joins,
        whatever columns they use: the plan follows the sources, not the models.
        """
        groups: dict[tuple, list[tuple[str, list]]] = {}
        for model, rows in by_model(self.feeds.rows).items():
            inputs = [r for r in rows if r["var_type"] in ("raw", "input") and r["data_type"] == "numeric"]
            if len(inputs) > 1:
                single = next((r for r in inputs if r["reading_mode"] in SINGLE_MODES), None)
                leader = self.feeds.feeds.index(self._feed_of(single or inputs[0]))
                sources = tuple(dict.fromkeys(self.feeds.feeds.index(self._feed_of(r)) for r in inputs))
                groups.setdefault((sources, leader, single is None), []).append((model, inputs))
        return [self._joined_inputs(key, members, dates, literals) for key, members in groups.items()]

    def _joined_inputs(self, key: tuple, members: list, dates: DataFrame, literals: dict):
        sources, leader, every_date = key
        models = [m for m, _ in members]
        on = [*RUN, "side", "read_date"]
        mine = dates.where(F.col("model_id").isin(models))
        anchor = mine.where(F.col("source_table") == self.feeds.feeds[leader].source_table).select(*on)
        if every_date:
            anchor = anchor.groupBy(*RUN, "side").agg(F.min("read_date").alias("read_date"))
        labels: dict[tuple[int, str], str] = {}
        own: dict[str, list[str]] = {}
        for model, inputs in members:
            columns = [(self.feeds.feeds.index(self._feed_of(r)), r["source_column"]) for r in inputs]
            own[model] = [labels.setdefault(c, f"x{len(labels)}") for c in columns]
        feeds = [self.feeds.feeds[source] for source in sources]
        meeting = self._meeting(
            [(f, mine.where(F.col("source_table") == f.source_table).join(anchor, on, "left_semi")) for f in feeds], models
        )
        tables: list[tuple[DataFrame, list[str]]] = []
        for i, (source, feed) in enumerate(zip(sources, feeds)):
            named = {c: x for (f, c), x in labels.items() if f == source}
            read = sorted({d for m in models for d in literals.get((m, feed.source_table), [])})
            tables.append(self._meeting_rows(feed, i, meeting, named, read))
        keys = reduce(lambda a, b: [k for k in a if k in b], [k for _, k in tables])
        joined = reduce(lambda a, b: a.join(b, ["_meet", *keys]), [df for df, _ in tables])
        served = meeting.select(*on, "_meet")
        keyed = joined.join(bounded(served), "_meet").withColumns({"var_type": F.lit(INPUTS_TYPE), "variable": F.lit(INPUTS_VARIABLE)})
        return keyed, list(labels.values()), own

    def _correlations(self, dates: DataFrame, literals: dict) -> list[Callable[[], DataFrame]]:
        found = self.joint_inputs(dates, literals)
        return [
            lambda rows=rows, names=names, own=own: stability.correlation(rows, names, own=own).where(F.col("n_cur") > 0)
            for rows, names, own in found
        ]

    # -- summaries ------------------------------------------------------------------

    def _summaries(self, measured: DataFrame, words: DataFrame | None, spread: DataFrame | None) -> DataFrame:
        owner = ["model_id", "variable", "var_type"]
        kinds = self.feeds.metadata.select(*owner, "data_type").distinct()
        plain = measured.where(F.col("n_cur") > 0).join(kinds, owner).select(
            *KEYS, "data_type", F.col("n_cur").alias("total"), F.col("known_cur").alias("non_null"), F.col("low_cur").alias("min"),
            F.col("high_cur").alias("max"), F.col("mean_cur").alias("mean"), F.col("std_cur").alias("std"),
        )
        parts = [summary.count_statistics(plain.where(~F.col("data_type").isin("numeric", "categorical")), F.col("data_type"))]
        if spread is not None:
            parts.append(summary.numeric_statistics(plain.where(F.col("data_type") == "numeric"), spread))
        if words is not None:
            parts.append(summary.categorical_summary(words))
        return union_all([p.select(*SUMMARY_COLUMNS) for p in parts])

    # -- roll-ups -------------------------------------------------------------------

    def availability(self, runs: DataFrame, as_of: Column | None = None) -> DataFrame:
        asked = runs.select("model_id", F.col("information_date").cast("date").alias("information_date")).distinct()
        configured = asked.join(self.feeds.tables.select("model_id", "source_schema", "source_table", "deadline_days"), "model_id")
        return data_availability(configured, newest_dates(self.feeds.present_dates()), as_of)


def measured(monitor: Monitor, runs: DataFrame, asked: DataFrame, store: KeptTables | None, models: list[str] | None) -> RunFrames:
    """The frames of the runs: those kept for this configuration, these sources and these runs if all are there, else
    measured and kept. A source that was corrected, file or row, is another version.
    """
    if store is None:
        return monitor.run(runs)
    hashed = F.xxhash64(*RUN).cast("decimal(38,0)")
    version = {
        **monitor.config.version(), **monitor.feeds.sources_version(), "models": sorted(models or []),
        "runs": tuple(asked.agg(F.count("*"), F.sum(hashed)).first()),
    }
    kept = {f.name: store.find(f.name, version) for f in fields(RunFrames)}
    if any(df is None for df in kept.values()):
        frames = monitor.run(runs)
        kept = {name: store.keep(getattr(frames, name), name, version) for name in kept}
    return RunFrames(**kept)


def run_models(
    spark: SparkSession,
    config: ConfigTables,
    runs: DataFrame,
    out_dir: str,
    execution_id: str,
    job: str = "monitoring",
    reason: str = "SCHEDULED",
    models: list[str] | None = None,
    overrides: dict[str, DataFrame] | None = None,
    store: KeptTables | None = None,
    as_of: Column | None = None,
) -> dict[str, str]:
    """The whole job: metrics, alerts, summaries, availability, scoring summary, log.

    Each table is fixed once and carried on as it is, so nothing is measured twice and no history is read; the log is
    written last. What a table held of a run that has no rows now is deleted: a rerun leaves nothing of the run before. With a ``store``, results
    of the same configuration and runs are looked up before anything is measured. Intermediate tables are gone when the run
    ends, also when it breaks off. Returns the paths.
    """
    with run_tables(spark):
        return _run_models(spark, config, runs, out_dir, execution_id, job, reason, models, overrides, store, as_of)


def _run_models(spark, config, runs, out_dir, execution_id, job, reason, models, overrides, store, as_of) -> dict[str, str]:
    begun = time.monotonic()
    monitor = Monitor(spark, config, models, overrides)
    asked = reliable(
        runs.select("model_id", F.date_format(F.col("information_date").cast("date"), "yyyy-MM-dd").alias("information_date")).distinct()
    )
    frames = measured(monitor, runs, asked, store, models)
    stamp = {
        "execution_id": F.lit(execution_id), "run_date": F.current_timestamp(), "dag_id": F.lit(job),
        "airflow_run_id": F.lit(execution_id),
    }
    paths = {t: f"{out_dir}/{t}" for t in (
        "metric_result", "alert_aggregate", "variable_summary", "data_availability", "scoring_summary", "execution_log",
    )}

    def stamped(df: DataFrame, table: str) -> DataFrame:
        return schemas.conform(df.withColumns({k: v for k, v in stamp.items() if k in schemas.columns(table)}), table)

    def put(rows: DataFrame, table: str) -> None:
        was_there = is_there(spark, paths[table])
        if not rows.isEmpty():
            replace_partitions(stamped(rows, table), paths[table], PARTITION_ORDER)
        if was_there:
            drop_partitions(asked.join(rows.select(*RUN).distinct(), RUN, "left_anti"), paths[table], PARTITION_ORDER)

    # Each table is fixed before it is written, which is its staged copy; undefined metrics have no value here.
    results, summaries, available = all_reliable(
        [lambda: frames.results, lambda: frames.summaries, lambda: monitor.availability(runs, as_of)]
    )
    # Stored, an undefined metric is 0, as its light says; the log counts it as failed.
    stored = results.fillna(0.0, ["metric_value"])
    policy = None if config.alert_policy is None else latest_partition(config.alert_policy)
    alerts, scoring, log = all_reliable([
        lambda: alert_aggregate(stored, policy),
        lambda: summary.scoring_summary(stored, summaries, availability_done(available), monitor.feeds.summary),
        lambda: execution_log(results, frames.missing, execution_id, job, reason, frames.failed),
    ])
    tables = {
        "metric_result": stored, "variable_summary": summaries, "alert_aggregate": alerts, "data_availability": available, "scoring_summary": scoring,
    }
    side_by_side([lambda df=df, table=table: put(df, table) for table, df in tables.items()])
    took = int(time.monotonic() - begun)
    put(log.withColumns({"end_date": F.current_timestamp(), "duration_seconds": F.lit(took)}), "execution_log")
    return paths
