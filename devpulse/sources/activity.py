"""Archive events to monthly counts, and yearly totals to monthly estimates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.constants import (
    ARCHIVE_COMMITS_PATH,
    ARCHIVE_LANGUAGE_PATH,
    FORK_RATE,
    MIN_MONTHLY_EVENTS,
    PUSH_EVENT,
    PUSH_RATIO,
    PUSHES_PER_REPO,
    SHORT_YEAR,
    SHORT_YEAR_MONTHS,
    UNKNOWN_LANGUAGE,
    WATCH_RATIO,
)
from devpulse.functions import round_half_away
from devpulse.operators.aggregates import grouped_distinct_counts


def extract_event_fields(
    events: DataFrame,
    payload: str = "payload",
    created_at: str = "created_at",
    event_type: str = "type",
    repo: str = "repo.name",
    actor: str = "actor.login",
    unit: str = "month",
) -> DataFrame:
    """Month, kind, language and commit count of each archive event."""
    commits = F.json_array_length(F.get_json_object(payload, ARCHIVE_COMMITS_PATH))
    return events.select(
        F.date_trunc(unit, F.col(created_at)).cast("date").alias("activity_month"),
        F.col(event_type).alias("event_type"),
        F.coalesce(
            F.get_json_object(payload, ARCHIVE_LANGUAGE_PATH), F.lit(UNKNOWN_LANGUAGE)
        ).alias("repo_language"),
        F.col(repo).alias("repo_name"),
        F.col(actor).alias("actor_login"),
        F.when(F.col(event_type) == PUSH_EVENT, commits)
        .otherwise(F.lit(0))
        .cast("long")
        .alias("commit_count"),
    )


def monthly_events(
    fields: DataFrame, min_count: int = MIN_MONTHLY_EVENTS, approximate: float | None = None
) -> DataFrame:
    """Monthly counts by language and kind, groups below `min_count` left out.

    `approximate` (a relative error) swaps the two exact distinct counts for sketches, which
    removes the shuffle of the distinct values."""
    keys = ["activity_month", "repo_language", "event_type"]
    counted = {"unique_actors": "actor_login", "unique_repos": "repo_name"}
    totals = {"event_count": ("count", "*"), "total_commits": ("sum", "commit_count")}
    if approximate is None:
        found = grouped_distinct_counts(fields, keys, totals, counted)
    else:
        totals = [F.expr(f"{kind}({c}) AS {name}") for name, (kind, c) in totals.items()]
        sketches = [
            F.approx_count_distinct(c, approximate).alias(name) for name, c in counted.items()
        ]
        found = fields.groupBy(*keys).agg(*totals, *sketches)
    return found.where(F.col("event_count") >= min_count).select(
        *keys, "event_count", "unique_actors", "unique_repos", "total_commits"
    )


def expand_year_to_months(totals: DataFrame) -> DataFrame:
    """Spread yearly totals of a language over the months of the year and six event kinds.

    Pure row expansion: no shuffle, and the factor is at most 72."""
    pushed, created = F.col("repos_pushed"), F.col("repos_created")
    months = F.when(F.col("year") < SHORT_YEAR, 12).otherwise(SHORT_YEAR_MONTHS)
    pushes = pushed * PUSHES_PER_REPO

    def kind(name: str, total: Column) -> Column:
        return F.struct(F.lit(name).alias("event_type"), total.cast("long").alias("total"))

    kinds = F.array(
        kind("PushEvent", pushes),
        kind("CreateEvent", created),
        kind("PullRequestEvent", F.col("pr_count")),
        kind("IssuesEvent", F.col("issue_count")),
        kind("ForkEvent", F.floor(F.col("avg_forks") * created * F.lit(FORK_RATE))),
        kind("WatchEvent", F.floor(pushes * F.lit(WATCH_RATIO) / F.lit(PUSH_RATIO))),
    )

    def share(amount: Column, parts: Column | int) -> Column:
        """Whole-number share, at least one."""
        parts = parts if isinstance(parts, Column) else F.lit(parts)
        return F.greatest(F.lit(1).cast("long"), F.call_function("div", amount, parts))

    def by_kind(push: Column, pull: Column, create: Column, other: Column) -> Column:
        event = F.col("event_type")
        return (
            F.when(event == "PushEvent", push)
            .when(event == "PullRequestEvent", pull)
            .when(event == "CreateEvent", create)
            .otherwise(other)
        )

    count, nothing = F.col("event_count"), F.lit(0).cast("long")
    return (
        totals.withColumn("months", months)
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.col("months"))))
        .select("*", F.inline(kinds))
        .withColumn("event_count", share(F.col("total"), F.col("months")))
        .withColumn(
            "unique_actors",
            by_kind(share(count, 10), share(count, 5), share(count, 2), share(count, 8)),
        )
        .select(
            F.make_date("year", "month", F.lit(1)).alias("activity_month"),
            F.col("language").alias("repo_language"),
            "event_type",
            "event_count",
            "unique_actors",
            by_kind(
                share(pushed, F.col("months")),
                share(F.col("unique_actors"), 2),
                count,
                share(count, 12),
            ).alias("unique_repos"),
            F.when(F.col("event_type") == "PushEvent", count * 3)
            .otherwise(nothing)
            .alias("total_commits"),
            nothing.alias("total_additions"),
            nothing.alias("total_deletions"),
            round_half_away(F.col("avg_stars"), 1).alias("avg_repo_stars"),
        )
    )
