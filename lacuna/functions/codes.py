"""Recoding of demographic columns and feature names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper-case fragments and the group they stand for.  The first
# group with a matching fragment wins, so the order is part of the meaning.
RACE_GROUPS = (
    ("Hispanic or Latino", ("HISPANIC", "LATINO", "SOUTH AMERICAN")),
    ("White", ("WHITE",)),
    ("Black or African American", ("BLACK", "AFRICAN")),
    ("Asian", ("ASIAN",)),
    ("Native Hawaiian or Other Pacific Islander", ("PACIFIC ISLANDER", "NATIVE HAWAIIAN")),
    ("American Indian or Alaska Native", ("AMERICAN INDIAN", "ALASKA NATIVE")),
    ("Unknown or Not Reported", ("DECLINED", "UNABLE", "UNKNOWN")),
)
RACE_MISSING = "Unknown or Not Reported"
RACE_OTHER = "Other"


def race_group(race: Column) -> Column:
    """Coarse group of a free-text race column."""
    text = F.upper(race)
    grouped = F.when(race.isNull(), RACE_MISSING)
    for name, fragments in RACE_GROUPS:
        grouped = grouped.when(reduce(Column.__or__, [text.contains(f) for f in fragments]), name)
    return grouped.otherwise(RACE_OTHER)


def gender_code(gender: Column) -> Column:
    """M is 1, F is 0, anything else null."""
    return F.when(gender == "M", 1).when(gender == "F", 0)


def at_least(value: Column, threshold: int) -> Column:
    """1 when ``value >= threshold``; a null value counts as below."""
    return F.coalesce((value >= threshold).cast("int"), F.lit(0))


def insurance_code(insurance: Column, kind: str = "Private") -> Column:
    """1 for the named insurance kind (any letter case), else 0."""
    return F.coalesce((F.lower(insurance) == kind.lower()).cast("int"), F.lit(0))


def item_text(item: Column) -> Column:
    """Item id as text without a decimal point."""
    return item.cast("bigint").cast("string")


def feature_name(item: Column, time_index: Column) -> Column:
    return F.concat_ws("_", item_text(item), time_index.cast("string"))


def feature_name_verbose(item: Column, time_index: Column) -> Column:
    return F.concat(
        F.lit("itemid_"), item_text(item), F.lit("_last_"), time_index.cast("string"), F.lit("h")
    )


def pair_id(subject: Column, admission: Column) -> Column:
    return F.concat_ws("_", subject.cast("string"), admission.cast("string"))
