"""Fixed schemas of the batch, file and model catalogues and of the request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = """
    id string, object string, endpoint string, input_file_id string, completion_window string,
    status string, output_file_id string, error_file_id string, created_at bigint,
    in_progress_at bigint, completed_at bigint, failed_at bigint, cancelled_at bigint,
    cancelling_at bigint, request_counts struct<total: bigint, completed: bigint, failed: bigint>,
    metadata map<string, string>
"""
FILE = """
    id string, object string, bytes bigint, created_at bigint, filename string, purpose string,
    created_by_email string, context_name string, context_type string
"""
MODEL = """
    id string, model_name string, alias string, description string, model_type string,
    capabilities array<string>, created_at string, updated_at string, hosted_on string,
    requests_per_second float, burst_size int, capacity int, batch_capacity int
"""
REQUEST_LOG = """
    id bigint, timestamp string, method string, uri string, model string, status_code int,
    duration_ms bigint, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint,
    response_type string, batch_id string, input_price_per_token string,
    output_price_per_token string, custom_id string, ttfb_ms bigint
"""
SCHEMAS = {"batches": BATCH, "files": FILE, "models": MODEL, "requests": REQUEST_LOG}

_EPOCH = {
    "batches": ["created_at", "in_progress_at", "completed_at", "failed_at", "cancelled_at", "cancelling_at"],
    "files": ["created_at"],
    "models": [],
    "requests": [],
}


def typed(df: DataFrame, name: str) -> DataFrame:
    """Epoch seconds and timestamp text become timestamps, price text becomes decimals."""
    columns = {c: F.timestamp_seconds(c).alias(c) for c in _EPOCH[name]}
    if name == "requests":
        columns = {
            "timestamp": F.try_to_timestamp("timestamp"),
            "input_price_per_token": F.col("input_price_per_token").cast("decimal(18,15)"),
            "output_price_per_token": F.col("output_price_per_token").cast("decimal(18,15)"),
        }
    return df.withColumns(columns) if columns else df


def read_catalog(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a catalogue kept as JSON lines. Missing members are NULL, unknown ones ignored."""
    raw = spark.read.schema(SCHEMAS[name]).option("mode", "FAILFAST").json(path)
    return typed(raw, name)
