"""Outcome of one fetch, from its status, content type and page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subtlake.fixed_values import PAGE_PHRASES, REFUSAL_CODES


def classify_outcome(status: Column, content_type: Column, body: Column) -> Column:
    """ok, wait, not_found, takedown, quota, challenge, pause, blocked, retry, html or unknown.

    Rules in order: overload status; known page phrases on any page that is not a plain success; status
    404; other server errors; too many requests; refusals by their JSON code; then the content type.
    """
    text = F.coalesce(body, F.lit(""))
    kind = F.coalesce(content_type, F.lit(""))
    page = (status != 200) | F.startswith(kind, F.lit("text/html"))
    refused = status.isin(422, 403, 503)
    rules = F.when(status.isin(503, 520), F.lit("wait"))
    for phrase, outcome in PAGE_PHRASES:
        rules = rules.when(page & F.contains(text, F.lit(phrase)), F.lit(outcome))
    rules = (
        rules.when(status == 404, F.lit("not_found"))
        .when(status.isin(500, 520), F.lit("pause"))
        .when(status == 429, F.lit("retry"))
        .when(refused & (text == ""), F.lit("retry"))
    )
    code = F.get_json_object(F.when(refused, text), "$.code")
    for value, outcome in REFUSAL_CODES:
        rules = rules.when(refused & (code == value), F.lit(outcome))
    return (
        rules.when(refused, F.lit("pause"))
        .when((status == 200) & (kind == "application/zip"), F.lit("ok"))
        .when((status == 200) & F.lower(kind).isin("text/html", "text/html; charset=utf-8"), F.lit("html"))
        .otherwise(F.lit("unknown"))
    )


def outcome_flags(outcome: Column) -> Column:
    """Flags the work queue acts on."""
    return F.struct(
        (outcome == "ok").alias("ok"),
        outcome.isin("wait", "retry", "pause", "blocked", "html").alias("retry"),
        outcome.isin("pause", "blocked").alias("pause"),
        (outcome == "wait").alias("wait"),
        outcome.isin("not_found", "takedown").alias("not_found"),
        (outcome == "takedown").alias("takedown"),
        (outcome == "blocked").alias("change_address"),
    )
