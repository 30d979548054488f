"""From configuration to observations: which sources a set of runs reads, and how.

Configuration is small and is collected once to shape the plan. Source rows are not: every
source table becomes one scan, joined to the dates it serves and turned into long observations.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from modelmon.functions.columns import KEYS, clean_double, is_baseline, is_current, one_per_key, union_all
from modelmon.functions.dates import format_date, parse_date
from modelmon.functions.sizes import all_reliable, bounded, reliable
from modelmon.operators.calendar import resolve_dates
from modelmon.operators.observations import unpivot
from modelmon.sources import reader
from modelmon.sources.config import latest_partition, load_table_config

PARTITION_MODES = ["first_partition", "last_partition"]
SINGLE_MODES = ["first", "last", *PARTITION_MODES]


@dataclass
class ConfigTables:
    """Configuration as DataFrames; optional ones may be absent."""

    model_summary: DataFrame
    variable_metadata: DataFrame
    table_config: DataFrame
    calendar: DataFrame
    thresholds: DataFrame | None = None
    auto_thresholds: DataFrame | None = None
    category_policy: DataFrame | None = None
    csi_bins: DataFrame | None = None
    alert_policy: DataFrame | None = None

    def version(self) -> dict[str, str]:
        """Per table its columns, rows and a sum over the hashes of its rows: any change of configuration shows."""
        marks = {}
        for name in (f.name for f in fields(self)):
            table = getattr(self, name)
            if table is not None:
                hashed = F.xxhash64(*[table[c] for c in table.columns]).cast("decimal(38,0)")
                rows, total = table.agg(F.count("*"), F.sum(hashed)).first()
                marks[name] = f"{','.join(table.columns)}:{rows}:{total}"
        return marks


class MissingConfig(Exception):
    """A variable names a source table that has no configuration."""


@dataclass
class Feed:
    """One source table with everything some models read from it."""

    spec: reader.SourceSpec
    source_table: str
    rows: list[Row] = field(default_factory=list)

    @property
    def models(self) -> list[str]:
        return sorted({r["model_id"] for r in self.rows})

    def entries(self, numeric: bool) -> list[tuple[str, str, str]]:
        chosen = [r for r in self.rows if (r["data_type"] != "categorical") == numeric]
        return sorted({(r["source_column"], r["variable"], r["var_type"]) for r in chosen})


class Feeds:
    """The sources of a set of models."""

    def __init__(
        self,
        spark: SparkSession,
        config: ConfigTables,
        models: list[str] | None = None,
        overrides: dict[str, DataFrame] | None = None,
        skip_unknown: bool = False,
        isolate: bool = False,
    ) -> None:
        self.spark, self.config = spark, config
        self.overrides = overrides or {}
        summary = latest_partition(config.model_summary)
        metadata = latest_partition(config.variable_metadata)
        if models is not None:
            summary = summary.where(F.col("model_id").isin(models))
            metadata = metadata.where(F.col("model_id").isin(models))
        self.summary = summary.select(
            "model_id",
            *[
                (F.col(c) if c in summary.columns else F.lit(None)).cast(t).alias(c)
                for c, t in (
                    ("model_name", "string"), ("frequency", "string"), ("cut_off_probability", "double"),
                    ("execution_monthly_day", "int"), ("execution_weekday", "int"),
                )
            ],
        ).fillna({"frequency": "daily", "cut_off_probability": 0.5})
        # Configuration is worked out once; everything later reads these small tables.
        self.summary, self.tables, self.metadata, self.calendar = all_reliable([
            lambda: one_per_key(self.summary, ["model_id"]),
            lambda: load_table_config(config.table_config),
            lambda: metadata.select("model_id", "variable", "var_type", "data_type", "source_table", "source_column"),
            lambda: config.calendar,
        ])
        joined = self.metadata.join(self.tables.drop("process_date"), ["model_id", "source_table"], "left")
        self.rows = sorted(joined.collect(), key=lambda r: (r["model_id"], r["var_type"], r["variable"]))
        unknown = sorted({(r["model_id"], r["source_table"]) for r in self.rows if r["table_role"] is None})
        self.reasons: list[tuple[str, str]] = []
        if isolate:
            self.reasons = [(m, f"table metadata not found for {table}") for m, table in unknown]
            self._leave_out()
        elif unknown and not skip_unknown:
            raise MissingConfig(f"table metadata not found for {[f'{m}: {table}' for m, table in unknown]}")
        self.rows = [r for r in self.rows if r["table_role"] is not None]
        self.feeds = self._group()
        if isolate:
            before = len(self.reasons)
            self.reasons += [(m, reason) for feed in self.feeds for m, reason in self._unreadable(feed)]
            if len(self.reasons) > before:
                self._leave_out()
                self.feeds = self._group()
        self._held: DataFrame | None = None

    def _leave_out(self) -> None:
        """Models with a reason against them are no part of any plan."""
        broken = sorted({m for m, _ in self.reasons})
        if broken:
            self.rows = [r for r in self.rows if r["model_id"] not in set(broken)]
            self.summary, self.metadata, self.tables = (
                df.where(~F.col("model_id").isin(broken)) for df in (self.summary, self.metadata, self.tables)
            )

    def _unreadable(self, feed: Feed) -> list[tuple[str, str]]:
        """(model, reason) where a source cannot give what is asked of it. Only its schema is looked at."""
        name = feed.spec.table_or_path
        try:
            columns = set(self.load(feed).columns)
        except Exception as error:  # whatever a reader, a path or a transform raises is this source's fault
            first = str(error).strip().splitlines()[0] if str(error).strip() else type(error).__name__
            return [(m, f"cannot read {name}: {first}") for m in feed.models]
        if not feed.spec.date_column or feed.spec.date_column not in columns:
            return [(m, f"no date column {feed.spec.date_column or ''} in {name}") for m in feed.models]
        lacking: dict[str, set[str]] = defaultdict(set)
        for r in feed.rows:
            lacking[r["model_id"]] |= {r["source_column"], *feed.spec.key_columns} - columns
        return [(m, f"missing columns {sorted(c)} in {name}") for m, c in sorted(lacking.items()) if c]

    @property
    def failures(self) -> DataFrame:
        """(model_id, error_message): one row per reason why a model cannot be measured."""
        return self.spark.createDataFrame(sorted(set(self.reasons)), "model_id string, error_message string")

    def _group(self) -> list[Feed]:
        grouped: dict[tuple, Feed] = {}
        for r in self.rows:
            spec = reader.SourceSpec.from_config(r)
            key = (r["source_table"], spec.source_type, spec.sql_transform, spec.date_column, spec.date_format, tuple(spec.key_columns), tuple(spec.canonical_keys))
            grouped.setdefault(key, Feed(spec, r["source_table"])).rows.append(r)
        return list(grouped.values())

    def cutoffs(self) -> DataFrame:
        return self.summary.select("model_id", F.col("cut_off_probability").alias("cutoff"))

    def sources_version(self) -> dict[str, str]:
        """Per source what shows any change of it: its files with their sizes and times, or its rows where it has no files.

        Only file statistics are read of a source of files, whatever its size. Views and given frames are hashed row by row.
        """

        def marks(feed: Feed, number: int) -> DataFrame:
            spec, base = feed.spec, self.overrides.get(feed.source_table)
            if base is None and spec.source_type == "PARQUET":
                rows = reader.load(self.spark, spec).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
            else:
                rows = reader.load(self.spark, spec) if base is None else base
            hashed = F.xxhash64(*[rows[c] for c in rows.columns]).cast("decimal(38,0)")
            return rows.agg(F.lit(number).alias("source"), F.count("*").alias("n"), F.sum(hashed).cast("string").alias("mark"))

        found = union_all([marks(f, i) for i, f in enumerate(self.feeds)]).collect() if self.feeds else []
        return {f"source {r['source']} {self.feeds[r['source']].source_table}": f"{r['n']}:{r['mark']}" for r in found}

    # -- dates ----------------------------------------------------------------------

    def load(self, feed: Feed) -> DataFrame:
        base = self.overrides.get(feed.source_table)
        return reader.transform(base, feed.spec.sql_transform) if base is not None else reader.source(self.spark, feed.spec)

    def _dates_of(self, feed: Feed) -> DataFrame:
        """(source_table, source_date, date) of one source: every date it holds, as it stores it and as a date."""
        spec, df = feed.spec, self.load(feed)
        day = F.to_date("source_date") if reader.has_type(df, spec.date_column) else parse_date(F.col("source_date"), spec.date_format)
        if reader.has_type(df, spec.date_column) and spec.date_format:
            # The pattern may drop the day, so the day itself is looked at.
            both = df.select(reader.date_text(df, spec.date_column, spec.date_format).alias("source_date"), F.col(f"`{spec.date_column}`").cast("date").alias("date"))
            found = both.distinct()
        else:
            found = df.select(reader.date_text(df, spec.date_column, spec.date_format).alias("source_date")).distinct().withColumn("date", day)
        return found.select(F.lit(feed.source_table).alias("source_table"), "source_date", "date")

    def held(self) -> DataFrame:
        """(source_table, source_date, date) of all sources; each is looked at once for all that asks."""
        if self._held is None:
            self._held = reliable(union_all([self._dates_of(f) for f in self.feeds if f.spec.date_column]).distinct())
        return self._held

    def present_dates(self, modes: list[str] | None = None) -> DataFrame | None:
        """(source_table, date) held by the sources; with ``modes``, only of sources read so."""
        wanted = sorted({
            f.source_table for f in self.feeds
            if f.spec.date_column and (modes is None or any(r["reading_mode"] in modes for r in f.rows))
        })
        if not wanted:
            return None
        return self.held().where(F.col("source_table").isin(wanted) & F.col("date").isNotNull()).select("source_table", "date").distinct()

    def held_texts(self) -> DataFrame:
        """(source_table, source_date): every date a source holds, as it stores it."""
        return self.held().select("source_table", "source_date").distinct()

    def per_source(self) -> DataFrame:
        """(model, source) rows with what date resolution needs."""
        used = self.metadata.select("model_id", "source_table").distinct()
        return (
            used.join(self.tables, ["model_id", "source_table"])
            .join(self.summary.select("model_id", "frequency"), "model_id")
            .select("model_id", "source_table", "frequency", "lag", "reading_mode", "use_business_days", "history_months")
        )

    def resolve(self, runs: DataFrame, lags: DataFrame | None = None) -> DataFrame:
        """(model, date, source, side, read_date, lagged) for runs (model_id, information_date).

        With ``lags`` (model_id, lag) the dates at that lag in place of the sources' own come along, told by ``lagged``.
        """
        asked = runs.select("model_id", F.col("information_date").cast("date").alias("information_date")).distinct()
        per_source = self.per_source().drop("history_months").withColumn("lagged", F.lit(False))
        if lags is not None:
            per_source = per_source.unionByName(per_source.drop("lag", "lagged").join(lags, "model_id").withColumn("lagged", F.lit(True)))
        expanded = asked.join(per_source, "model_id")
        resolved = resolve_dates(expanded, self.calendar, self.present_dates(PARTITION_MODES))
        named = self.with_source_date(resolved).withColumn(
            "information_date", F.date_format("information_date", "yyyy-MM-dd")
        )
        # Dates that a source stores under one text are one date to read.
        return named.groupBy(
            "model_id", "information_date", "source_table", "reading_mode", "side", "source_date", "lagged"
        ).agg(F.min("read_date").alias("read_date"))

    def with_source_date(self, dates: DataFrame) -> DataFrame:
        """Add the text under which each source stores a date to read."""
        text = format_date(F.col("read_date"))
        for feed in self.feeds:
            if feed.spec.date_format:
                own = format_date(F.col("read_date"), feed.spec.date_format)
                text = F.when(F.col("source_table") == feed.source_table, own).otherwise(text)
        return dates.withColumn("source_date", text)

    # -- rows -----------------------------------------------------------------------

    @staticmethod
    def read_dates(dates: DataFrame) -> dict[tuple[str, str], list]:
        """Distinct dates to read per (model, source): calendar-sized, so they may be collected."""
        rows = dates.select("model_id", "source_table", "read_date").distinct().collect()
        out: dict[tuple[str, str], list] = defaultdict(list)
        for r in rows:
            out[r["model_id"], r["source_table"]].append(r["read_date"])
        return out

    def slices(
        self,
        feed: Feed,
        dates: DataFrame,
        literals: list,
        columns: list[str],
        keys: bool = False,
        base: DataFrame | None = None,
    ) -> DataFrame:
        """Rows of one source for every (model, date, side) they serve.

        The dates to read are few; they become literals, so source partitions are pruned. They
        meet the rows as the text the source stores, so no date is parsed per row. ``dates`` is a
        written table whose size Spark knows, so it is broadcast when small, and source rows are not shuffled here.
        """
        serving = dates.where(
            (F.col("source_table") == feed.source_table) & F.col("model_id").isin(feed.models)
        ).select("model_id", "information_date", "side", "source_date", "read_date")
        return self.dated(feed, literals, columns, keys, base).join(serving, "source_date").drop("source_date")

    def dated(self, feed: Feed, literals: list, columns: list[str], keys: bool = False, base: DataFrame | None = None) -> DataFrame:
        """Rows of one source on the given dates, each once, with ``source_date``: the date as the source stores it."""
        spec = feed.spec
        if not spec.date_column:
            raise ValueError(f"{spec.table_or_path} has no date column")
        df = self.load(feed) if base is None else base
        wanted = [*columns, spec.date_column, *(spec.key_columns if keys else [])]
        df = reader.project(df, wanted, spec.table_or_path)
        df = reader.on_dates(df, spec.date_column, sorted(literals), spec.date_format) if literals else df.where(F.lit(False))
        df = df.withColumn("source_date", reader.date_text(df, spec.date_column, spec.date_format))
        if keys:
            df = reader.canonical_keys(df, spec.key_columns, spec.canonical_keys)
        return df.drop(*[c for c in ("model_id", "information_date", "side") if c in df.columns])

    def _typed(self, feed: Feed, literals: dict, alias: dict[tuple[str, bool], str]) -> tuple[DataFrame, list]:
        """A source with the (column, numeric) of ``alias``, numbers as doubles and others as text, and the dates read of it."""
        spec, base = feed.spec, self.load(feed)
        missing = sorted({c for c, _ in alias} - set(base.columns))
        if missing:
            raise ValueError(f"missing columns {missing} in {spec.table_or_path}; available: {sorted(base.columns)}")
        typed = {a: clean_double(F.col(f"`{c}`")) if numeric else F.col(f"`{c}`").cast("string") for (c, numeric), a in alias.items()}
        when = sorted({d for m in feed.models for d in literals.get((m, feed.source_table), [])})
        return base.withColumns(typed), when

    def columns(self, feed: Feed, dates: DataFrame, literals: dict, alias: dict[tuple[str, bool], str]) -> DataFrame:
        """(model, date, side) rows of one source with the (column, numeric) of ``alias``: numbers as doubles, others as text."""
        base, when = self._typed(feed, literals, alias)
        return self.slices(feed, dates, when, list(alias.values()), base=base)

    def owned(self, feed: Feed, rows: DataFrame) -> DataFrame:
        """Only the variables that a model itself reads, where several models share a source."""
        if len(feed.models) == 1:
            return rows
        mine = self.metadata.where(F.col("source_table") == feed.source_table)
        return rows.join(mine.select("model_id", "variable", "var_type"), ["model_id", "variable", "var_type"], "left_semi")

    def observations(self, dates: DataFrame, literals: dict, numeric: bool) -> DataFrame | None:
        """Long observations of all numeric (or all text) variables."""
        frames = []
        for feed in self.feeds:
            entries = feed.entries(numeric)
            if not entries:
                continue
            alias = {(c, numeric): f"_v{i}" for i, c in enumerate(dict.fromkeys(e[0] for e in entries))}
            plain = self.columns(feed, dates, literals, alias)
            frames.append(self.owned(feed, unpivot(plain, [(alias[c, numeric], v, t) for c, v, t in entries], numeric)))
        return union_all(frames) if frames else None

    def date_counts(self, literals: dict, numeric: bool) -> DataFrame | None:
        """(source, column, source_date, value, n): every numeric (or text) value of a source, counted by the date it is stored under.

        A row is counted once, however many models, runs and sides read its date; ``served`` deals the counts out to them.
        """
        frames = []
        for source, feed in enumerate(self.feeds):
            alias = {(c, numeric): f"_v{i}" for i, c in enumerate(dict.fromkeys(e[0] for e in feed.entries(numeric)))}
            if alias:
                base, when = self._typed(feed, literals, alias)
                rows = self.dated(feed, when, list(alias.values()), base=base)
                long = rows.select("source_date", *alias.values()).unpivot(["source_date"], list(alias.values()), "column", "value")
                frames.append(long.withColumn("source", F.lit(source)))
        if not frames:
            return None
        return union_all(frames).groupBy("source", "column", "source_date", "value").agg(F.count("*").alias("n"))

    def serving(self, dates: DataFrame, numeric: bool) -> tuple[DataFrame, bool]:
        """Who reads the counts of ``date_counts``: (source, column, source_date, KEYS, side), and whether every key reads one
        date of one column at most per side, so that a value of it comes once.
        """
        readers = []
        for source, feed in enumerate(self.feeds):
            entries = feed.entries(numeric)
            labels = {c: f"_v{i}" for i, c in enumerate(dict.fromkeys(e[0] for e in entries))}
            own = {(r["model_id"], r["variable"], r["var_type"]) for r in self.rows if r["source_table"] == feed.source_table}
            readers += [
                (source, feed.source_table, labels[c], m, t, v)
                for m in feed.models for c, v, t in entries if len(feed.models) == 1 or (m, v, t) in own
            ]
        ddl = "source int, source_table string, column string, model_id string, var_type string, variable string"
        who = self.spark.createDataFrame(readers, ddl)
        served = dates.join(who, ["source_table", "model_id"]).select("source", "column", "source_date", *KEYS, "side")
        served = reliable(served)
        return served, served.groupBy(*KEYS, "side").count().where("count > 1").isEmpty()

    @staticmethod
    def served(counted: DataFrame, serving: DataFrame) -> DataFrame:
        """The counts of ``date_counts`` as observations ``KEYS + value + n_cur + n_base``, a row for each date and side."""
        n = F.col("n")
        return counted.join(bounded(serving), ["source", "column", "source_date"]).select(
            *KEYS, "value", F.when(is_current(), n).otherwise(0).alias("n_cur"), F.when(is_baseline(), n).otherwise(0).alias("n_base")
        )


def by_model(rows: list[Row]) -> dict[str, list[Row]]:
    out: dict[str, list[Row]] = defaultdict(list)
    for r in rows:
        out[r["model_id"]].append(r)
    return out
