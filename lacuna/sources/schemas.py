"""Typed schemas of the source tables.

The dataset ships its table definitions as DDL.  ``schemas_from_ddl`` turns that
text into Spark schemas by a type rule, so the column lists are read, not
repeated here; only the keys needed by the constraint checks are listed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, types as T

# Schema names and which tables belong to them.
SCHEMAS = ("mimiciv_hosp", "mimiciv_icu")

# How database types read in Spark (longest spelling first).
TYPE_RULES = (
    (r"TIMESTAMP\s*(\(\d+\))?(\s+WITHOUT TIME ZONE)?", "TIMESTAMP_NTZ"),
    (r"DOUBLE\s+PRECISION", "DOUBLE"),
    (r"FLOAT", "DOUBLE"),
    (r"REAL", "FLOAT"),
    (r"(VARCHAR|CHARACTER VARYING|CHAR|CHARACTER|BPCHAR)\s*(\(\d+\))?", "STRING"),
    (r"TEXT", "STRING"),
    (r"SMALLINT|INT2", "SMALLINT"),
    (r"BIGINT|INT8", "BIGINT"),
    (r"INTEGER|INT4|INT", "INT"),
    (r"DATE", "DATE"),
)

# Primary keys.
PRIMARY_KEYS = {
    "admissions": ("hadm_id",),
    "d_hcpcs": ("code",),
    "diagnoses_icd": ("hadm_id", "seq_num", "icd_code", "icd_version"),
    "d_icd_diagnoses": ("icd_code", "icd_version"),
    "d_icd_procedures": ("icd_code", "icd_version"),
    "d_labitems": ("itemid",),
    "emar": ("emar_id",),
    "hcpcsevents": ("hadm_id", "hcpcs_cd", "seq_num"),
    "labevents": ("labevent_id",),
    "microbiologyevents": ("microevent_id",),
    "patients": ("subject_id",),
    "pharmacy": ("pharmacy_id",),
    "poe_detail": ("poe_id", "field_name"),
    "poe": ("poe_id",),
    "prescriptions": ("pharmacy_id", "drug_type", "drug"),
    "procedures_icd": ("hadm_id", "seq_num", "icd_code", "icd_version"),
    "services": ("hadm_id", "transfertime", "curr_service"),
    "transfers": ("transfer_id",),
    "datetimeevents": ("stay_id", "itemid", "charttime"),
    "d_items": ("itemid",),
    "icustays": ("stay_id",),
    "inputevents": ("orderid", "itemid"),
    "outputevents": ("stay_id", "charttime", "itemid"),
    "procedureevents": ("orderid",),
}

# Foreign keys as parent (column) -> child tables.
_ICU_EVENTS = (
    "chartevents",
    "datetimeevents",
    "inputevents",
    "outputevents",
    "procedureevents",
)
_STAY_TABLES = (
    "diagnoses_icd",
    "drgcodes",
    "emar",
    "hcpcsevents",
    "microbiologyevents",
    "pharmacy",
    "poe",
    "prescriptions",
    "procedures_icd",
    "services",
    "icustays",
)
_PATIENT_TABLES = ("admissions", "emar_detail", "labevents", "poe_detail", "transfers")
_REFERENCES = (
    ("subject_id", "patients", "subject_id", (*_PATIENT_TABLES, *_STAY_TABLES, *_ICU_EVENTS)),
    ("hadm_id", "admissions", "hadm_id", (*_STAY_TABLES, *_ICU_EVENTS)),
    ("stay_id", "icustays", "stay_id", _ICU_EVENTS),
    ("itemid", "d_items", "itemid", _ICU_EVENTS),
    ("emar_id", "emar", "emar_id", ("emar_detail",)),
    ("hcpcs_cd", "d_hcpcs", "code", ("hcpcsevents",)),
    ("itemid", "d_labitems", "itemid", ("labevents",)),
    ("poe_id", "poe", "poe_id", ("poe_detail",)),
)


def foreign_keys() -> list[tuple[str, str, str, str]]:
    """(child, child column, parent, parent column) of every declared reference."""
    return [
        (child, column, parent, key)
        for column, parent, key, children in _REFERENCES
        for child in children
    ]


def schemas_from_ddl(ddl: str) -> dict[str, T.StructType]:
    """Spark schema per ``CREATE TABLE schema.name (...)`` of the text."""
    text = re.sub(r"--[^\n]*", "", ddl)
    tables = {}
    for name, body in re.findall(
        r"CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?([\w.]+)\s*\((.*?)\)\s*;", text, re.S | re.I
    ):
        columns = []
        for line in re.split(r",(?![^(]*\))", body):
            column, _, rest = line.strip().partition(" ")
            if not column or column.upper() in ("CONSTRAINT", "PRIMARY", "FOREIGN", "UNIQUE"):
                continue
            kind = re.sub(r"\s+NOT\s+NULL.*", "", rest.strip(), flags=re.I).strip()
            not_null = re.search(r"NOT\s+NULL", rest, re.I) is not None
            for pattern, spark_type in TYPE_RULES:
                if re.fullmatch(pattern, kind, re.I):
                    columns.append(f"`{column}` {spark_type}{' NOT NULL' if not_null else ''}")
                    break
            else:
                raise ValueError(f"no rule for type {kind!r} of {name}.{column}")
        tables[name] = T.StructType.fromDDL(", ".join(columns))
    return tables


def required_columns(schema: T.StructType) -> list[str]:
    """Columns declared NOT NULL."""
    return [f.name for f in schema.fields if not f.nullable]


def matches(df: DataFrame, schema: T.StructType) -> bool:
    """Same column names and types, nullability aside."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]
