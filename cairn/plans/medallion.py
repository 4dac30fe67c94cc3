"""Layer builders: raw -> bronze -> silver -> gold / star schema.

Pure DataFrame functions; the pipeline materialises each layer to the lake
between stages, the registered queries chain them lazily. ``Layers`` builds
only the tables a query asks for (each DataFrame call is analysed eagerly on
the driver, so building unused tables costs planning time).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from cairn.operators import bronze, dims, gold, silver

SILVER_NAMES = ("silver_activities", "silver_heartrate", "silver_engagement", "silver_location", "silver_activity_fact")
GOLD_NAMES = ("gold_activity_summary", "gold_weekly_stats", "gold_monthly_stats", "gold_pb_efforts", "gold_training_load")
STAR_NAMES = ("dim_date", "dim_activity_type", "dim_athlete", "fact_activities")


class Layers:
    """Lazily built tables over one raw activity relation.

    ``single_source=True`` builds ``silver_activity_fact`` as one projection
    of the keyed raw records (valid because every bronze table here is a
    projection of that relation); ``False`` builds it with the four LEFT
    joins of the general form.
    """

    def __init__(self, raw: DataFrame, athletes=None, single_source: bool = True):
        """``athletes`` is a DataFrame or a no-argument callable returning
        one (read only when the athlete dimension is asked for)."""
        self.raw = raw
        self._athletes = athletes
        self.single_source = single_source
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def bronze(self, name: str) -> DataFrame:
        return self._get(name, lambda: bronze.project(self.records, name))

    def silver(self, name: str) -> DataFrame:
        builders = {
            "silver_activities": lambda: silver.activities(self.bronze("bronze_activities"), self.bronze("bronze_metrics")),
            "silver_heartrate": lambda: silver.heartrate(self.bronze("bronze_heartrate")),
            "silver_engagement": lambda: silver.engagement(self.bronze("bronze_engagement")),
            "silver_location": lambda: silver.location(self.bronze("bronze_location")),
            "silver_activity_fact": self._fact,
        }
        return self._get(name, builders[name])

    def _fact(self) -> DataFrame:
        if self.single_source:
            return silver.activity_fact_from_records(self.records)
        return silver.activity_fact(
            self.silver("silver_activities"),
            self.silver("silver_heartrate"),
            self.silver("silver_engagement"),
            self.silver("silver_location"),
        )

    @cached_property
    def athletes(self) -> DataFrame | None:
        return self._athletes() if callable(self._athletes) else self._athletes

    @cached_property
    def records(self) -> DataFrame:
        return bronze.records(self.raw)

    @property
    def fact(self) -> DataFrame:
        return self.silver("silver_activity_fact")

    def gold(self, name: str) -> DataFrame:
        return self._get(name, lambda: gold_tables_for(self.fact, [name])[name])

    def star(self, name: str) -> DataFrame:
        return self._get(name, lambda: star_table(name, self._star_fact(), self.bronze("bronze_activities"), self.athletes))

    def _star_fact(self) -> DataFrame:
        return silver.activity_fact_from_records(self.records, owner=True) if self.single_source else self.fact


_GOLD = {
    "gold_activity_summary": gold.activity_summary,
    "gold_weekly_stats": gold.weekly_stats,
    "gold_monthly_stats": gold.monthly_stats,
    "gold_pb_efforts": gold.pb_efforts,
    "gold_training_load": gold.training_load,
}


def silver_tables_from_records(records: DataFrame) -> dict[str, DataFrame]:
    """All silver tables from the wide keyed bronze records: projections
    only, no join and no shuffle (each side table is 1:1 with the key)."""
    return {
        "silver_activities": silver.activities_from_records(records),
        "silver_heartrate": silver.heartrate(records),
        "silver_engagement": silver.engagement(records),
        "silver_location": silver.location(records),
        "silver_activity_fact": silver.activity_fact_from_records(records),
    }


def gold_tables_for(fact: DataFrame, names=GOLD_NAMES) -> dict[str, DataFrame]:
    return {name: _GOLD[name](fact) for name in names}


def gold_tables(fact: DataFrame) -> dict[str, DataFrame]:
    return gold_tables_for(fact)


def star_table(name: str, fact: DataFrame, bronze_activities: DataFrame, athletes: DataFrame | None) -> DataFrame:
    if name == "dim_date":
        return dims.date_dim(fact)
    if name == "dim_activity_type":
        return dims.activity_type_dim(fact, bronze_activities)
    if name == "dim_athlete":
        return dims.athlete_dim(fact, bronze_activities, athletes)
    if name == "fact_activities":
        return dims.activity_fact(fact, bronze_activities)
    raise KeyError(name)


def star_tables(fact: DataFrame, bronze_activities: DataFrame, athletes: DataFrame) -> dict[str, DataFrame]:
    return {name: star_table(name, fact, bronze_activities, athletes) for name in STAR_NAMES}
