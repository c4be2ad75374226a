"""All derived tables from the three raw tables and a mapping seed."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from devpulse.functions import surrogate_key
from devpulse.operators.reshape import unpivot_survey_a, unpivot_survey_b
from devpulse.operators.staging import stage_activity, stage_survey_a, stage_survey_b
from devpulse.plans.activity import activity_yearly
from devpulse.plans.adoption import adoption_a, adoption_b, technology_adoption
from devpulse.plans.anomalies import adoption_anomalies
from devpulse.plans.compare import said_vs_did
from devpulse.plans.dimension import dim_technologies
from devpulse.plans.salary import salary_by_stack
from devpulse.plans.sentiment import technology_sentiment
from devpulse.plans.spine import technology_spine
from devpulse.sources.sinks import cut_lineage, materialize

NATURAL_KEY = ("response_id", "survey_year")
VIEWS = {
    "staged_survey_a",
    "staged_survey_b",
    "staged_activity",
    "technologies_a",
    "technologies_b",
}


@dataclass
class Marts:
    staged_survey_a: DataFrame
    staged_survey_b: DataFrame
    staged_activity: DataFrame
    technologies_a: DataFrame
    technologies_b: DataFrame
    spine: DataFrame
    yearly_a: DataFrame
    yearly_b: DataFrame
    yearly_activity: DataFrame
    dim_technologies: DataFrame
    technology_adoption: DataFrame
    said_vs_did: DataFrame
    salary_by_stack: DataFrame
    technology_sentiment: DataFrame
    adoption_anomalies: DataFrame

    def publish(self, as_tables: bool = False) -> None:
        """Register every table under its name: staging as views, the rest as tables when
        `as_tables`, and everything as views otherwise."""
        for name, df in vars(self).items():
            materialize(df, name, "table" if as_tables and name not in VIEWS else "view")


def _keyed(technologies: DataFrame) -> DataFrame:
    """Answers are grouped by the short natural key and get the hashed key afterwards, so the
    hash is neither shuffled nor computed once per answer."""
    key = surrogate_key(*NATURAL_KEY).alias("survey_response_id")
    return technologies.select(key, *technologies.columns)


def build_marts(
    raw_a: DataFrame, raw_b: DataFrame, raw_activity: DataFrame, seed: DataFrame
) -> Marts:
    """Wire the models.  Tables with several consumers are cut into the shared checkpoint
    folder where the session has one, so each is computed once."""
    survey_a = stage_survey_a(raw_a)
    survey_b = stage_survey_b(raw_b)
    activity = stage_activity(raw_activity)
    tech_a = cut_lineage(_keyed(unpivot_survey_a(survey_a, NATURAL_KEY)))
    tech_b = _keyed(unpivot_survey_b(survey_b, NATURAL_KEY))
    spine = technology_spine(seed)
    yearly_a = cut_lineage(adoption_a(tech_a, survey_a, spine, NATURAL_KEY))
    yearly_b = cut_lineage(adoption_b(tech_b, survey_b, spine, NATURAL_KEY))
    yearly = cut_lineage(activity_yearly(activity, spine))
    dim = cut_lineage(dim_technologies(spine, yearly_a, yearly_b, yearly))
    adoption = cut_lineage(technology_adoption(yearly_a, yearly_b, yearly, dim))
    return Marts(
        survey_a,
        survey_b,
        activity,
        tech_a,
        tech_b,
        spine,
        yearly_a,
        yearly_b,
        yearly,
        dim,
        adoption,
        said_vs_did(adoption, dim),
        salary_by_stack(survey_a, tech_a, spine, dim),
        technology_sentiment(yearly_a, dim),
        adoption_anomalies(adoption),
    )
