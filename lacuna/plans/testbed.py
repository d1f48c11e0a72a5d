"""The clinical roles (labs, patients, admissions, cohort) over the star-schema
test tables.  All frames are lazy; each reads only the columns it needs.

Admissions are exploded from customers, and Spark takes them for as small as a few
columns of the packed customer file: patients, admissions and cohort ask for merge
joins, as they would be broadcast through the driver otherwise."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators import cohort as co
from lacuna.session import tune

# Fixed values of the fixture definition.
ITEM_CODES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
ITEMS = (1, 2, 3, 4, 5)
FIRST_DAY = "2024-01-01"
PERIOD_DAYS = 10
STAY_DAYS = 9
RACES = (
    "WHITE",
    "BLACK/AFRICAN AMERICAN",
    "HISPANIC/LATINO - CUBAN",
    "ASIAN - CHINESE",
    "NATIVE HAWAIIAN OR OTHER PACIFIC ISLANDER",
    "AMERICAN INDIAN/ALASKA NATIVE",
    "UNKNOWN",
    "PORTUGUESE",
    None,
    "White - Brazilian",
)


class ClinicalTables:
    """Frames of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Each file is listed and its footer read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def events(self) -> DataFrame:
        period = f"floor(date_diff(date(ts), DATE '{FIRST_DAY}') / {PERIOD_DAYS})"
        return self.table("events").selectExpr("*", f"user_id * 10 + {period} AS hadm_id")

    @cached_property
    def labevents(self) -> DataFrame:
        items = " ".join(f"WHEN '{kind}' THEN {code}" for kind, code in ITEM_CODES.items())
        # every 50th event is charted twice, the copy one unit higher
        return (
            self.events.selectExpr(
                "*",
                "explode(CASE WHEN event_id % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
            )
            .selectExpr(
                "event_id + copy * 1000000000L AS labevent_id",
                "user_id AS subject_id",
                "hadm_id",
                f"CASE event_type {items} END AS itemid",
                "CASE WHEN hadm_id % 17 = 3 THEN ts - INTERVAL 10 DAYS"
                " WHEN event_id % 101 <> 0 THEN ts END AS charttime",
                "CASE WHEN event_id % 11 <> 0 THEN value + copy END AS valuenum",
            )
        )

    @cached_property
    def patients(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS subject_id",
            "CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
            "CASE WHEN c_custkey % 89 <> 7 THEN 18 + c_custkey % 73 END AS anchor_age",
        ).hint("merge")

    @cached_property
    def admissions(self) -> DataFrame:
        races = ", ".join("NULL" if race is None else f"'{race}'" for race in RACES)
        start = f"TIMESTAMP_NTZ '{FIRST_DAY} 00:00:00'"
        return (
            self.table("customer")
            .selectExpr("*", "explode(array(0, 1, 2)) AS p")
            .selectExpr(
                "c_custkey * 10 + p AS hadm_id",
                "c_custkey AS subject_id",
                f"{start} + make_dt_interval(p * {PERIOD_DAYS}) AS admittime",
                f"{start} + make_dt_interval(p * {PERIOD_DAYS} + {STAY_DAYS}) AS dischtime",
                f"get(array({races}), c_nationkey % 10) AS race",
                "CASE c_mktsegment WHEN 'BUILDING' THEN 'Private' ELSE c_mktsegment END AS insurance",
            )
            .hint("merge")
        )

    @cached_property
    def targets(self) -> DataFrame:
        return self.events.groupBy("hadm_id").agg(F.expr("int(max(value) > 220) AS target"))

    @cached_property
    def cohort(self) -> DataFrame:
        # every 13th admission is outside, so that labs without a cohort row exist
        return (
            self.admissions.filter("hadm_id % 13 <> 0")
            .join(self.targets, "hadm_id", "left")
            .selectExpr(
                "subject_id", "hadm_id", "admittime", "dischtime", "coalesce(target, 0) AS target"
            )
            .hint("merge")
        )

    @cached_property
    def extracted_list(self) -> DataFrame:
        """The extract's id list, in which either id may be missing."""
        return self.admissions.selectExpr(
            "CASE WHEN subject_id % 97 <> 5 THEN subject_id END AS subject_id",
            "CASE WHEN hadm_id % 89 <> 7 THEN hadm_id END AS hadm_id",
        )

    @cached_property
    def demographics(self) -> DataFrame:
        return co.build_cohort(self.cohort, self.admissions, self.patients)

    @cached_property
    def window_labs(self) -> DataFrame:
        """Cohort labs of the 7-day window with a chart time, duplicates resolved."""
        return co.dedupe_labs(co.labs_in_window(self.cohort, self.labevents))
