"""Schemas of the result and configuration tables, and padding rows to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# The columns of each table, partition columns last.
TABLES = {
    "metric_result": """execution_id string, variable string, var_type string, metric_name string,
        metric_value double, baseline_value double, threshold_ambar double, threshold_red double, status string,
        baseline_process_date string, run_date timestamp, dag_id string, airflow_run_id string,
        information_date string, model_id string""",
    "alert_aggregate": """execution_id string, var_type string, total_metrics int, count_ambar int, count_red int,
        equivalent_yellow double, stress_ratio double, aggregate_status string, alert_sent boolean,
        alert_type string, red_equivalent_used int, alert_ambar_pct_used double, alert_red_pct_used double,
        run_date timestamp, information_date string, model_id string""",
    "execution_log": """execution_id string, dag_id string, airflow_run_id string, run_date timestamp,
        end_date timestamp, status string, error_message string, reason string, variables_expected int,
        variables_processed int, variables_missing int, metrics_calculated int, metrics_failed int,
        duration_seconds int, information_date string, model_id string""",
    "email_log": """email_id string, execution_id string, alert_type string, recipients_to string,
        recipients_bcc string, subject string, body_summary string, sent_timestamp timestamp, status string,
        smtp_response string, retry_count int, information_date string, model_id string""",
    "variable_summary": """execution_id string, variable string, var_type string, data_type string,
        statistic string, statistic_value double, statistic_value_str string, information_date string,
        model_id string""",
    "scoring_summary": """model_name string, scoring_date string, vintage string,
        control_data_availability string, control_pre_scoring string, psi double, psi_variation double,
        csi_max double, csi_status string, population_scored double, general_status string,
        execution_id string, run_date timestamp, information_date string, model_id string""",
    "data_availability": """schema_name string, source_table string, scoring_date string,
        deadline_data_ingestion string, vintage string, update_data_required string, control string,
        execution_id string, run_date timestamp, information_date string, model_id string""",
    "csi_psi_table": """schema string, table_name string, type string, variable string, bin int,
        bin_type string, category_value string, lb double, ub double, lower_bound_type string,
        upper_bound_type string, count_dev int, woe double, information_date_column string,
        process_date string, model_id string""",
    "category_baseline_rank": """variable string, category_value string, rank_dev int, freq_dev double,
        top_n_threshold int, critical_top_k int, process_date string, model_id string""",
    "metric_threshold_auto": """variable string, metric_name string, threshold_ambar double,
        threshold_red double, baseline_value double, baseline_std double, sample_size_dev int,
        calculation_method string, process_date string, model_id string""",
    "config_changelog": """change_timestamp timestamp, table_name string, change_type string,
        field_changed string, old_value string, new_value string, triggered_retraining boolean,
        error_message string, executed_by_dag_id string, run_id string, process_date string, model_id string""",
    "staging_control": """staging_id string, execution_id string, model_id string, target_table string,
        information_date string, temp_path string, final_path string, row_count_temp int, row_count_final int,
        status string, started_at timestamp, validated_at timestamp, promoted_at timestamp, process_date string""",
    "calendar": """calendar_date string, is_business_day boolean, is_holiday boolean, holiday_name string,
        sync_timestamp timestamp""",
    "model_summary": """model_name string, model_description string, model_type string, status string,
        cut_off_probability double, frequency string, window_value int, window_unit string,
        execution_monthly_day int, execution_weekday int, trigger_csi_ambar double, trigger_csi_red double,
        trigger_csi_variation_ambar double, trigger_csi_variation_red double, score_alert_ambar_pct double,
        score_alert_red_pct double, score_red_equivalent int, process_date string, model_id string""",
    "thresholds": """variable string, type string, psi_threshold_ambar double, psi_threshold_red double,
        psi_variation_threshold_ambar double, psi_variation_threshold_red double, process_date string,
        model_id string""",
    "alert_policy": """var_type string, red_equivalent int, alert_ambar_pct double, alert_red_pct double,
        process_date string, model_id string""",
    "category_policy": "variable string, top_n_threshold int, critical_top_k int, process_date string, model_id string",
    "variable_metadata": """variable string, var_type string, data_type string, source_table string,
        source_column string, is_monotonic boolean, process_date string, model_id string""",
    "model_table_config": """table_role string, table_name string, source_type string, source_schema string,
        source_table string, entity_key_columns string, canonical_key_columns string, date_column string,
        date_format string, history_months int, lag int, sql_transform string, data_type string,
        partition_columns string, reading_mode string, use_business_days boolean, active boolean,
        deadline_days int, process_date string, model_id string""",
    "email_config": """subject_prefix string, sender_email string, sender_name string, process_date string,
        model_id string""",
}

PARTITIONS = ("information_date", "process_date", "model_id")


def _name(table: str) -> str:
    return table.rsplit(".", 1)[-1]


def get(table: str) -> StructType:
    """Schema of a table, by bare or ``schema.table`` name."""
    if _name(table) not in TABLES:
        raise KeyError(f"no schema for table: {table}")
    return StructType.fromDDL(TABLES[_name(table)])


def columns(table: str) -> list[str]:
    return get(table).names


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order, cast, and null where the frame has none."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in get(table).fields
        ]
    )


def partition_columns(table: str) -> list[str]:
    return [c for c in columns(table) if c in PARTITIONS][-2:] if table != "calendar" else []


def create_tables(
    spark: SparkSession, database: str | None = None, tables: list[str] | None = None, location: str | None = None
) -> DataFrame:
    """Create the (partitioned) Parquet tables that do not exist yet; lists them."""
    made = []
    for table in tables or list(TABLES):
        name = f"{database}.{table}" if database else table
        parts = partition_columns(table)
        ddl = get(table).toDDL()
        by = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        where = f" LOCATION '{location}/{table}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{by}{where}")
        made.append((name, len(get(table)), ",".join(parts)))
    return spark.createDataFrame(made, "table_name string, n_columns int, partitions string")
