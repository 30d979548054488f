"""Versioned configuration tables: latest versions and lenient parsing, as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelmon.functions.columns import one_per_key

# Text that means true.
TRUE_WORDS = ["true", "1", "t", "yes", "y"]
GLOBAL_MODEL = "global"


def parse_list(column: Column) -> Column:
    """JSON array, or comma-separated text, as array<string>. Empty text gives no entries."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    entries = F.transform(F.split(text, ","), lambda x: F.trim(x))
    loose = F.filter(entries, lambda x: x != "")
    is_json = F.trim(text).rlike(r"^(\[.*\]|\{.*\}|\".*\"|-?[0-9.]+|true|false|null)$")
    listed = F.from_json(text, "array<string>", {"mode": "PERMISSIVE"})
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(F.trim(text).rlike(r"^\[.*\]$") & listed.isNotNull(), listed)
        .when(is_json, F.array().cast("array<string>"))
        .otherwise(loose)
    )


def parse_int(column: Column) -> Column:
    """Whole number, or null where the text is none."""
    return F.trim(column.cast("string")).try_cast("int")


def parse_bool(column: Column) -> Column:
    """Lenient truth: missing is true, text must be one of the true words."""
    return F.when(column.isNull(), True).otherwise(F.lower(column.cast("string")).isin(TRUE_WORDS))


def text_or_null(column: Column) -> Column:
    return F.when(column.cast("string") != "", column.cast("string"))


def latest_partition(table: DataFrame, keys: list[str] | str = "model_id", version: str = "process_date") -> DataFrame:
    """Rows of the newest version of every model, for all models at once.

    The newest version per key is a plain aggregate; its rows come back by an equi-join, so a
    model with very many rows is never gathered in one task.
    """
    keys = [keys] if isinstance(keys, str) else keys
    newest = table.groupBy(*keys).agg(F.max(version).alias(version))
    return table.join(newest, [*keys, version], "left_semi")


def latest_global(table: DataFrame, status: str | None = "active", version: str = "process_date") -> DataFrame:
    """Rows of the table-wide newest version, optionally of one status."""
    newest = table.agg(F.max(version).alias(version))
    rows = table.join(newest, version, "left_semi")
    return rows.where(F.col("status") == status) if status else rows


def latest_global_config(table: DataFrame, default: dict[str, str]) -> DataFrame:
    """Newest row kept for model 'global'; the default row where the table has none."""
    current = latest_partition(table.where(F.col("model_id") == GLOBAL_MODEL))
    columns = list(default)
    # The largest row where the newest version has several: the same one in every run.
    row = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    current = current.agg(F.max(row).alias("row")).where("row IS NOT NULL").select("row.*")
    ddl = ", ".join(f"{c} string" for c in columns)
    fallback = table.sparkSession.createDataFrame([tuple(default.values())], ddl).withColumn("_n", F.lit(0).cast("long"))
    found = current.agg(F.count("*").alias("_n"))
    return current.unionByName(fallback.join(found, "_n", "left_semi").drop("_n"))


def parse_table_config(rows: DataFrame) -> DataFrame:
    """Typed table configuration: one row per configured source, inactive ones dropped."""

    def col(name: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit(None).cast("string")

    active = F.coalesce(col("active").cast("string").try_cast("boolean"), F.lit(True))
    return rows.select(
        "model_id",
        "process_date",
        F.lower(col("table_role")).alias("table_role"),
        F.lower(col("table_name")).alias("table_name"),
        F.upper(F.coalesce(col("source_type"), F.lit("HIVE"))).alias("source_type"),
        text_or_null(col("source_schema")).alias("source_schema"),
        col("source_table").cast("string").alias("source_table"),
        parse_list(col("entity_key_columns")).alias("entity_key_columns"),
        parse_list(col("canonical_key_columns")).alias("canonical_key_columns"),
        text_or_null(col("date_column")).alias("date_column"),
        text_or_null(col("date_format")).alias("date_format"),
        parse_int(col("history_months")).alias("history_months"),
        parse_int(col("lag")).alias("lag"),
        text_or_null(col("sql_transform")).alias("sql_transform"),
        parse_list(col("partition_columns")).alias("partition_columns"),
        F.coalesce(text_or_null(col("reading_mode")), F.lit("each")).alias("reading_mode"),
        parse_bool(col("use_business_days")).alias("use_business_days"),
        parse_int(col("deadline_days")).alias("deadline_days"),
        active.alias("active"),
    ).where("active")


def load_table_config(table: DataFrame) -> DataFrame:
    """Newest active table configuration of every model, one row per source table."""
    return one_per_key(parse_table_config(latest_partition(table)), ["model_id", "source_table"])


def metadata_join(metadata: DataFrame, tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(variables with their table configuration, variables whose table is not configured)."""
    keys = ["model_id", "source_table"]
    config = tables.drop("process_date") if "process_date" in metadata.columns else tables
    return metadata.join(config, keys, "inner"), metadata.join(tables, keys, "left_anti")
