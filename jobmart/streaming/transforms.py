"""Stream transformations, built from the same column functions as the batch jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart import rules
from jobmart.functions import dates, level, location, salary, skills

EVENT_TIME = "crawled_ts"


def enrich(messages: DataFrame, shared_parser: bool = True) -> DataFrame:
    """Event time, location, salary bounds, level, skills and processing time.

    ``shared_parser`` uses the batch salary parser; without it the stream parser is used.
    """
    parse = salary.salary_range if shared_parser else salary.stream_salary
    return messages.withColumn("_range", parse(F.col("salary"))).withColumns({
        EVENT_TIME: dates.parse_timestamp(F.col("crawled_at")),
        "location": location.city_stream(F.col("company_location")),
        "salary_min": F.col("_range.salary_min"),
        "salary_max": F.col("_range.salary_max"),
        "level": level.level_stream(F.col("job_title")),
        "skills": skills.extract_skills(
            F.col("job_description"), F.col("job_requirements"), keywords=rules.SKILLS_STREAM
        ),
        "processed_ts": F.current_timestamp(),
    }).drop("_range")


def enrich_listed(messages: DataFrame, shared_parser: bool = True) -> DataFrame:
    """Variant for messages that bring their own skill list; both field spellings are accepted."""
    posted = F.coalesce("post_date", "post_time")
    low = (
        salary.salary_range(F.col("salary"))["salary_min"]
        if shared_parser else salary.first_number_millions(F.col("salary"))
    )
    return messages.select(
        "job_title", "company_name",
        location.city_english(F.col("company_location")).alias("city"),
        F.coalesce("working_model", "woring_model").alias("working_model"),
        "skills_list",
        low.alias("salary_min"),
        dates.parse_timestamp(F.col("crawled_at")).alias(EVENT_TIME),
        dates.parse_date(posted).cast("timestamp").alias("post_ts"),
        "source", "url",
    )


def dedup_exact(rows: DataFrame, delay: str = "1 hour", keys: Sequence[str] = ("url",)) -> DataFrame:
    """One row per key and event time; state is dropped ``delay`` behind the newest event."""
    return rows.withWatermark(EVENT_TIME, delay).dropDuplicates([*keys, EVENT_TIME])


def dedup_within_delay(rows: DataFrame, delay: str = "1 hour", keys: Sequence[str] = ("url",)) -> DataFrame:
    """One row per key within ``delay``, whatever the event times."""
    return rows.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark(list(keys))


def sliding_counts(
    rows: DataFrame, by: str = "location", length: str = "30 minutes", slide: str = "10 minutes"
) -> DataFrame:
    """Rows per window and ``by``, bounds as plain columns."""
    return (
        rows.groupBy(F.window(EVENT_TIME, length, slide), by)
        .count()
        .select(
            F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time"), by,
            F.col("count").alias("n_jobs"),
        )
    )
