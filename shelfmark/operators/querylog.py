"""Query logs from audit records, and query executions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import substr_after
from shelfmark.functions.values import json_scalar


def query_log(records: DataFrame, column: str = "Records") -> DataFrame:
    """Started queries without an error, except SHOW statements, with user, session and time.

    An assumed role is named by what follows the colon in its principal. Each record is read on
    its own, so the same function serves batch and stream.
    """
    r = records.select("*", F.explode(column).alias("r")).where(
        "r.eventName = 'StartQueryExecution' and r.errorCode is null"
    )
    text = json_scalar("r.requestParameters", "$.queryString")
    user = F.when(
        F.col("r.userIdentity.type") == "AssumedRole",
        substr_after("r.userIdentity.principalId", ":"),
    ).otherwise(F.col("r.userIdentity.userName"))
    kept = [c for c in records.columns if c != column]
    return r.where(~text.rlike("^SHOW")).select(
        *kept,
        F.col("r.eventID").alias("event_id"),
        user.alias("user_name"),
        F.lit(" ").alias("default_databases"),
        json_scalar("r.responseElements", "$.queryExecutionId").alias("session_id"),
        F.col("r.eventTime").alias("session_start_time"),
        F.col("r.eventTime").alias("start_time"),
        text.alias("query_string"),
    )


def execution_flatten(sessions: DataFrame) -> DataFrame:
    """One row per execution event of nested sessions; empty levels stay as nulls."""
    batches = sessions.select("session_id", F.explode_outer("batches").alias("b"))
    events = batches.select(
        "session_id", F.col("b.id").alias("batch_id"), F.explode_outer("b.events").alias("e")
    )
    return events.select(
        "session_id",
        "batch_id",
        F.col("e.id").alias("event_id"),
        F.col("e.result.id").alias("result_id"),
        F.col("e.result.title").alias("title"),
        F.col("e.result.url").alias("url"),
    )


def apply_result_schema(df: DataFrame, rows: str, schema: str) -> DataFrame:
    """Rows of positional values as maps from column name to value.

    ``schema`` is an array of structs with ``name``; short rows are filled with nulls.
    """
    names = F.transform(F.col(schema), lambda c: c["name"])
    exploded = df.select(
        *[c for c in df.columns if c not in (rows, schema)],
        names.alias("_names"),
        F.posexplode(rows).alias("row_no", "_values"),
    )
    padded = F.transform(
        F.sequence(F.lit(0), F.size("_names") - 1), lambda i: F.get("_values", i)
    )
    return exploded.withColumn("row", F.map_from_arrays("_names", padded)).drop("_names", "_values")
