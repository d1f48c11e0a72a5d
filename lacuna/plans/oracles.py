"""DuckDB SQL for the registered queries, written from the definitions.

Each statement starts with the fixture views as common table expressions.
"""

from __future__ import annotations

from lacuna.plans.testbed import ITEMS

FIXTURE = """
WITH ev AS (
  SELECT *, user_id * 10 + CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10 AS BIGINT) AS hadm_id
  FROM events),
labs0 AS (
  SELECT event_id AS labevent_id, user_id AS subject_id, hadm_id,
         CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                         WHEN 'signup' THEN 4 ELSE 5 END AS itemid,
         CASE WHEN hadm_id % 17 = 3 THEN ts - INTERVAL 10 DAY
              WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS charttime,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS valuenum
  FROM ev),
labevents AS (
  SELECT * FROM labs0
  UNION ALL
  SELECT labevent_id + 1000000000, subject_id, hadm_id, itemid, charttime, valuenum + 1
  FROM labs0 WHERE labevent_id % 50 = 0),
patients AS (
  SELECT c_custkey AS subject_id,
         CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CASE WHEN c_custkey % 89 = 7 THEN NULL ELSE 18 + c_custkey % 73 END AS anchor_age
  FROM customer),
admissions AS (
  SELECT c_custkey * 10 + p AS hadm_id, c_custkey AS subject_id,
         TIMESTAMP '2024-01-01' + to_days(CAST(10 * p AS INTEGER)) AS admittime,
         TIMESTAMP '2024-01-01' + to_days(CAST(10 * p + 9 AS INTEGER)) AS dischtime,
         CASE c_nationkey % 10 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'BLACK/AFRICAN AMERICAN'
              WHEN 2 THEN 'HISPANIC/LATINO - CUBAN' WHEN 3 THEN 'ASIAN - CHINESE'
              WHEN 4 THEN 'NATIVE HAWAIIAN OR OTHER PACIFIC ISLANDER'
              WHEN 5 THEN 'AMERICAN INDIAN/ALASKA NATIVE' WHEN 6 THEN 'UNKNOWN'
              WHEN 7 THEN 'PORTUGUESE' WHEN 8 THEN NULL ELSE 'White - Brazilian' END AS race,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'Private' ELSE c_mktsegment END AS insurance
  FROM customer CROSS JOIN (SELECT unnest([0, 1, 2]) AS p) AS periods),
targets AS (
  SELECT hadm_id, CAST(max(value) > 220 AS INTEGER) AS target FROM ev GROUP BY hadm_id),
cohort AS (
  SELECT a.subject_id, a.hadm_id, a.admittime, a.dischtime, coalesce(t.target, 0) AS target
  FROM admissions AS a LEFT JOIN targets AS t ON a.hadm_id = t.hadm_id
  WHERE a.hadm_id % 13 <> 0),
people AS (
  SELECT DISTINCT c.*, p.gender, p.anchor_age, a.race
  FROM cohort c JOIN admissions a ON a.hadm_id = c.hadm_id
  JOIN patients p ON p.subject_id = a.subject_id)"""

# labs of the window, duplicates resolved, with hours before discharge
WINDOW = """,
raw_window AS (
  SELECT l.subject_id, l.hadm_id, l.itemid, l.charttime, l.valuenum, c.dischtime, c.target
  FROM labevents l JOIN cohort c ON l.subject_id = c.subject_id AND l.hadm_id = c.hadm_id
  WHERE l.charttime BETWEEN c.dischtime - INTERVAL 7 DAY AND c.dischtime),
wl AS (
  SELECT subject_id, hadm_id, itemid, charttime, min(valuenum) AS valuenum,
         (epoch_us(min(dischtime)) - epoch_us(charttime)) / 3.6e9 AS hours
  FROM raw_window GROUP BY subject_id, hadm_id, itemid, charttime)"""

EXTRACT = """,
joined AS (
  SELECT p.subject_id, p.hadm_id, p.dischtime, p.target, p.gender, p.anchor_age, p.race,
         l.itemid, l.charttime, l.valuenum
  FROM people p LEFT JOIN labevents l ON l.subject_id = p.subject_id AND l.hadm_id = p.hadm_id),
extract AS (
  SELECT DISTINCT * FROM joined
  WHERE charttime IS NULL OR charttime BETWEEN dischtime - INTERVAL 7 DAY AND dischtime)"""


def means(width: int = 12) -> str:
    return WINDOW + f""",
bm AS (
  SELECT hadm_id, itemid, CAST(floor(hours / {width}) AS INTEGER) AS bin, avg(valuenum) AS mean
  FROM wl GROUP BY 1, 2, 3)"""


def dense(width: int = 12) -> str:
    return means(width) + """,
bins AS (
  SELECT bin, CAST(row_number() OVER (ORDER BY bin) - 1 AS INTEGER) AS pos
  FROM (SELECT DISTINCT bin FROM bm)),
grid AS (
  SELECT s.hadm_id, s.itemid, b.pos, b.bin, m.mean
  FROM (SELECT DISTINCT hadm_id, itemid FROM bm) s CROSS JOIN bins b
  LEFT JOIN bm m ON m.hadm_id = s.hadm_id AND m.itemid = s.itemid AND m.bin = b.bin)"""


def filled(expression: str, axis: str = "pos", width: int = 12) -> str:
    """Neighbours found by correlated aggregates rather than ordered frames."""
    return dense(width) + f""",
known AS (SELECT bm.*, bins.pos FROM bm JOIN bins ON bins.bin = bm.bin WHERE mean IS NOT NULL),
spread AS (
  SELECT g.*,
    (SELECT max(x.{axis}) FROM known x WHERE x.hadm_id = g.hadm_id AND x.itemid = g.itemid AND x.pos <= g.pos) AS pp,
    (SELECT min(x.{axis}) FROM known x WHERE x.hadm_id = g.hadm_id AND x.itemid = g.itemid AND x.pos >= g.pos) AS np
  FROM grid g),
neighbours AS (
  SELECT s.hadm_id, s.itemid, s.pos, s.bin, s.mean, s.pp, s.np, s.{axis} AS here, b.mean AS pv, a.mean AS nv
  FROM spread s
  LEFT JOIN known b ON b.hadm_id = s.hadm_id AND b.itemid = s.itemid AND b.{axis} = s.pp
  LEFT JOIN known a ON a.hadm_id = s.hadm_id AND a.itemid = s.itemid AND a.{axis} = s.np),
filled AS (
  SELECT hadm_id, itemid, pos, bin, {expression} AS filled FROM neighbours)"""


LINEAR = "CASE WHEN mean IS NOT NULL THEN mean WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (here - pp) / (np - pp) END"
CHAIN = f"coalesce({LINEAR}, pv, nv)"
OUT_FILLED = " SELECT hadm_id, itemid, pos, bin, round(filled, 6) + 0.0 AS filled FROM filled"

RACE = """CASE WHEN race IS NULL THEN 'Unknown or Not Reported'
  WHEN regexp_matches(upper(race), 'HISPANIC|LATINO|SOUTH AMERICAN') THEN 'Hispanic or Latino'
  WHEN regexp_matches(upper(race), 'WHITE') THEN 'White'
  WHEN regexp_matches(upper(race), 'BLACK|AFRICAN') THEN 'Black or African American'
  WHEN regexp_matches(upper(race), 'ASIAN') THEN 'Asian'
  WHEN regexp_matches(upper(race), 'PACIFIC ISLANDER|NATIVE HAWAIIAN') THEN 'Native Hawaiian or Other Pacific Islander'
  WHEN regexp_matches(upper(race), 'AMERICAN INDIAN|ALASKA NATIVE') THEN 'American Indian or Alaska Native'
  WHEN regexp_matches(upper(race), 'DECLINED|UNABLE|UNKNOWN') THEN 'Unknown or Not Reported'
  ELSE 'Other' END"""

LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
)
ITEM_LIST = "(SELECT unnest([" + ", ".join(map(str, ITEMS)) + "]) AS itemid)"


def pivot(source: str, columns: list[tuple[str, str]], value: str, key: str = "hadm_id") -> str:
    """Conditional aggregation: ``columns`` are (name, condition)."""
    cells = ", ".join(f'{value.format(cond=cond)} AS "{name}"' for name, cond in columns)
    return f" SELECT {key}, {cells} FROM {source} GROUP BY {key}"


def matrix_columns(last_bin: int, prefix: str = "") -> list[tuple[str, str]]:
    return [
        (f"{prefix}{i}_{b}", f"itemid = {i} AND bin = {b}") for i in ITEMS for b in range(last_bin + 1)
    ]


WIDE = "round(max(CASE WHEN {cond} THEN filled END), 6) + 0.0"

HOLDOUT = """,
split AS (
  SELECT *, CAST(row_number() OVER (ORDER BY md5(hadm_id || '|0')) <= ceil(0.2 * count(*) OVER ()) AS INTEGER) AS is_test
  FROM {rows})"""

FOLDS = """,
dealt AS (
  SELECT subject_id, CAST(CASE WHEN turn < 5 THEN turn ELSE 9 - turn END AS INTEGER) AS fold
  FROM (SELECT subject_id, (row_number() OVER (
          ORDER BY sum(target) DESC, count(*) DESC, md5(subject_id || '|42')) - 1) % 10 AS turn
        FROM cohort GROUP BY subject_id)),
folded AS (SELECT c.hadm_id, c.subject_id, c.target, d.fold FROM cohort c JOIN dealt d ON d.subject_id = c.subject_id)"""

SIZES = """,
sizes AS (
  SELECT arg_min(target, n * 10 + target) AS minority, min(n) AS n_min, max(n) - min(n) AS deficit
  FROM (SELECT target, count(*) AS n FROM cohort GROUP BY target))"""

SCORED = WINDOW + """,
scored AS (
  SELECT c.hadm_id, c.target, round(least(coalesce(n, 0) / 20, 1.0), 3) AS score
  FROM cohort c LEFT JOIN (SELECT hadm_id, count(*) AS n FROM raw_window GROUP BY hadm_id) r ON r.hadm_id = c.hadm_id)"""

PR = SCORED + """,
cuts AS (SELECT DISTINCT score AS cut FROM scored),
points AS (
  SELECT cut, sum(target) / count(*) AS precision,
         sum(target) / (SELECT sum(target) FROM scored) AS recall
  FROM cuts JOIN scored ON score >= cut GROUP BY cut)"""

XMD_BINNED = WINDOW + """,
obs AS (
  SELECT subject_id, hadm_id, itemid, CAST(floor(hours / {w}) AS INTEGER) AS bin, valuenum,
         row_number() OVER (PARTITION BY hadm_id, itemid, floor(hours / {w})
                            ORDER BY charttime DESC, valuenum DESC NULLS LAST) AS rn
  FROM wl),
steps AS (
  SELECT subject_id, hadm_id, bin, row_number() OVER (PARTITION BY hadm_id ORDER BY bin DESC) - 1 AS step,
         max(bin) OVER (PARTITION BY hadm_id) AS first_bin
  FROM (SELECT DISTINCT subject_id, hadm_id, bin FROM obs)),
xgrid AS (
  SELECT s.*, i.itemid, o.hadm_id IS NOT NULL AS seen, o.valuenum
  FROM steps s CROSS JOIN {items} i
  LEFT JOIN obs o ON o.hadm_id = s.hadm_id AND o.bin = s.bin AND o.itemid = i.itemid AND o.rn = 1),
xmd AS (
  SELECT g.subject_id, g.hadm_id, g.subject_id || '_' || g.hadm_id AS stay, g.step, g.bin, g.itemid,
         CASE WHEN g.seen THEN g.valuenum ELSE 0.0 END AS x, CAST(g.seen AS INTEGER) AS m,
         CAST(coalesce((SELECT min(p.bin) FROM obs p WHERE p.hadm_id = g.hadm_id AND p.itemid = g.itemid AND p.bin > g.bin),
                       g.first_bin) - g.bin AS DOUBLE) * {w} AS delta
  FROM xgrid g)"""


VMD = (
    filled(CHAIN, width=12)
    + XMD_BINNED.format(w=12, items=ITEM_LIST).replace(WINDOW, "")
    + """,
cells AS (
  SELECT x.hadm_id, x.itemid, x.bin, f.filled AS v, x.m, x.delta AS d
  FROM xmd x LEFT JOIN filled f ON f.hadm_id = x.hadm_id AND f.itemid = x.itemid AND f.bin = x.bin)"""
)


def _last_n_columns(suffix: str = "") -> list[tuple[str, str]]:
    return [
        (f"itemid_{i}_last_{b}h{suffix}", f"itemid = {i} AND hour_bin = {b}") for i in ITEMS for b in range(1, 28)
    ]


LAST_N = WINDOW + """,
rows_n AS (
  SELECT hadm_id, itemid, valuenum, target,
         least(CAST(floor((epoch_us(dischtime) - epoch_us(charttime)) / 3.6e9 / 6) AS INTEGER) + 1, 27) AS hour_bin
  FROM raw_window WHERE valuenum IS NOT NULL)"""

MEDIAN_TRAIN = HOLDOUT.format(rows="(SELECT hadm_id FROM cohort)") + """,
med AS (
  SELECT itemid, median(valuenum) AS median FROM wl
  WHERE hadm_id IN (SELECT hadm_id FROM split WHERE is_test = 0) GROUP BY itemid)"""


def _declared() -> list[str]:
    keys = {
        "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
        "orders": "o_orderkey", "lineitem": "l_orderkey,l_linenumber", "labevents": "labevent_id", "patients": "subject_id",
        "admissions": "hadm_id",
    }
    references = (
        "admissions subject_id patients subject_id", "labevents subject_id patients subject_id",
        "labevents hadm_id admissions hadm_id", "nation n_regionkey region r_regionkey", "customer c_nationkey nation n_nationkey",
        "supplier s_nationkey nation n_nationkey", "orders o_custkey customer c_custkey", "lineitem l_orderkey orders o_orderkey",
        "lineitem l_partkey part p_partkey", "lineitem l_suppkey supplier s_suppkey",
    )
    required = ("labevents charttime", "labevents valuenum", "orders o_custkey", "patients gender")
    found = [
        f"""SELECT 'primary_key' AS check_name, '{t}' AS table_name, '{k}' AS column_names, '' AS refers_to,
 CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, CAST(coalesce(sum(CASE WHEN missing THEN n END), 0) AS BIGINT) AS null_rows,
 count(*) FILTER (WHERE n > 1 AND NOT missing) AS bad_keys,
 CAST(coalesce(sum(CASE WHEN n > 1 AND NOT missing THEN n END), 0) AS BIGINT) AS bad_rows
FROM (SELECT {k}, count(*) AS n, {" OR ".join(f"{c} IS NULL" for c in k.split(","))} AS missing FROM {t} GROUP BY {k})"""
        for t, k in keys.items()
    ]
    for child, column, parent, key in map(str.split, references):
        gone = f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"
        found.append(f"""SELECT 'foreign_key', '{child}', '{column}', '{parent}.{key}', count(*),
 count(*) FILTER (WHERE {column} IS NULL), count(DISTINCT CASE WHEN {gone} THEN {column} END),
 count(CASE WHEN {gone} THEN 1 END) FROM {child}""")
    for table, column in map(str.split, required):
        found.append(f"""SELECT 'not_null', '{table}', '{column}', '', count(*), count(*) FILTER (WHERE {column} IS NULL), 0, 0
FROM {table}""")
    return found


def _knn(k: int = 5, width: int = 12, last_bin: int = 14) -> str:
    names = [f"{i}_{b}" for i in ITEMS for b in range(last_bin + 1)]
    return means(width) + f""",
stays AS (SELECT DISTINCT hadm_id FROM bm),
{HOLDOUT.format(rows="stays").lstrip(", ").lstrip()},
cells AS (SELECT hadm_id, itemid || '_' || bin AS feature, mean AS v FROM bm WHERE mean IS NOT NULL),
donors AS (SELECT c.* FROM cells c JOIN split s ON s.hadm_id = c.hadm_id AND s.is_test = 0),
features AS (SELECT unnest([{", ".join(f"'{n}'" for n in names)}]) AS feature),
gaps AS (
  SELECT s.hadm_id, f.feature FROM stays s CROSS JOIN features f
  WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.hadm_id = s.hadm_id AND c.feature = f.feature)),
dist AS (
  SELECT a.hadm_id, b.hadm_id AS donor, round(sqrt(sum((a.v - b.v) * (a.v - b.v)) * {len(names)} / count(*)), 9) AS d
  FROM cells a JOIN donors b ON a.feature = b.feature
  WHERE a.hadm_id IN (SELECT hadm_id FROM gaps)
  GROUP BY a.hadm_id, b.hadm_id),
ranked AS (
  SELECT g.hadm_id, g.feature, n.v,
         row_number() OVER (PARTITION BY g.hadm_id, g.feature ORDER BY dist.d, dist.donor) AS rn
  FROM gaps g JOIN dist ON dist.hadm_id = g.hadm_id
  JOIN donors n ON n.hadm_id = dist.donor AND n.feature = g.feature),
fills AS (SELECT hadm_id, feature, avg(v) AS v FROM ranked WHERE rn <= {k} GROUP BY 1, 2)
SELECT s.hadm_id, f.feature, round(coalesce(c.v, x.v, m.v), 6) + 0.0 AS value
FROM stays s CROSS JOIN features f
LEFT JOIN cells c ON c.hadm_id = s.hadm_id AND c.feature = f.feature
LEFT JOIN fills x ON x.hadm_id = s.hadm_id AND x.feature = f.feature
LEFT JOIN (SELECT feature, avg(v) AS v FROM donors GROUP BY feature) m ON m.feature = f.feature"""


def _hidden(mode: str) -> str:
    hide = (
        f"CAST('0x' || substr(md5(hadm_id || '|' || itemid || '|' || bin || '|{mode}0'), 1, 8) AS BIGINT)"
        " / 4294967296.0 < 0.2"
    )
    return hide if mode == "overlay" else f"({hide} AND mean IS NOT NULL)"


def _imputation(mode: str) -> str:
    points = f"(SELECT * FROM marked_{mode} WHERE shown IS NOT NULL)"
    return f""",
marked_{mode} AS (
  SELECT *, {_hidden(mode)} AS hidden, CASE WHEN NOT {_hidden(mode)} THEN mean END AS shown FROM grid),
scored_{mode} AS (
  SELECT h.mean AS truth, b.pos AS pp, b.shown AS pv, a.pos AS np, a.shown AS nv, h.pos
  FROM marked_{mode} h
  LEFT JOIN {points} b ON b.hadm_id = h.hadm_id AND b.itemid = h.itemid AND b.pos =
    (SELECT max(x.pos) FROM {points} x WHERE x.hadm_id = h.hadm_id AND x.itemid = h.itemid AND x.pos < h.pos)
  LEFT JOIN {points} a ON a.hadm_id = h.hadm_id AND a.itemid = h.itemid AND a.pos =
    (SELECT min(x.pos) FROM {points} x WHERE x.hadm_id = h.hadm_id AND x.itemid = h.itemid AND x.pos > h.pos)
  WHERE h.hidden),
err_{mode} AS (
  SELECT coalesce(pv + (nv - pv) * (pos - pp) / (np - pp), pv, nv) - truth AS e FROM scored_{mode})"""


def _imputation_out(mode: str) -> str:
    return (
        f"SELECT '{mode}' AS mode, count(*) AS n_hidden, count(e) AS n_scored, "
        f"round(avg(abs(e)), 6) + 0.0 AS mae, round(sqrt(avg(e * e)), 6) + 0.0 AS rmse FROM err_{mode}"
    )


def _not_null(table: str, columns: str) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS null_rows FROM {table}"
        for c in columns.split()
    ]
    return " UNION ALL ".join(parts)


def _primary(name: str, table: str, keys: str) -> str:
    nulls = " OR ".join(f"{k} IS NULL" for k in keys.split(","))
    return (
        f"SELECT '{name}' AS table_name, '{keys}' AS key_columns, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {nulls}) AS null_rows, "
        f"(SELECT count(*) FROM (SELECT 1 FROM {table} WHERE NOT ({nulls}) GROUP BY {keys} HAVING count(*) > 1)) AS duplicate_keys "
        f"FROM {table}"
    )


def _foreign(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{name}' AS constraint_name, count(DISTINCT {key}) AS orphan_keys, count(*) AS orphan_rows "
        f"FROM {child} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})"
    )


def _by_group(name: str, expression: str) -> str:
    return f"""
SELECT g.group_value, i.itemid, g.admissions, coalesce(k.measured, 0) AS measured,
       round(1 - coalesce(k.measured, 0) / g.admissions, 6) + 0.0 AS missing_rate, '{name}' AS group_name
FROM (SELECT {expression} AS group_value, count(*) AS admissions FROM people GROUP BY 1) g
CROSS JOIN {ITEM_LIST} i
LEFT JOIN (SELECT {expression} AS group_value, wl.itemid, count(DISTINCT wl.hadm_id) AS measured
           FROM wl JOIN people ON people.hadm_id = wl.hadm_id GROUP BY 1, 2) k
  ON k.group_value IS NOT DISTINCT FROM g.group_value AND k.itemid = i.itemid"""


def all_sql() -> dict[str, str]:
    f = FIXTURE
    vmd = {
        "v": "round(max(CASE WHEN {cond} THEN v END), 6) + 0.0",
        "m": "max(CASE WHEN {cond} THEN m END)",
        "d": "round(max(CASE WHEN {cond} THEN d END), 6) + 0.0",
    }
    def vmd_set(letters: str) -> str:
        columns = ", ".join(
            f'{vmd[letter].format(cond=cond)} AS "{name}"'
            for letter in letters
            for name, cond in matrix_columns(14, f"{letter}_")
        )
        return VMD + f" SELECT hadm_id, {columns} FROM cells GROUP BY hadm_id"

    sql = {
        "cohort_build": " SELECT * FROM people",
        "extract_labs": EXTRACT + " SELECT * FROM extract",
        "extract_labs_keep_all": """
SELECT DISTINCT p.subject_id, p.hadm_id, p.dischtime, p.target, p.gender, p.anchor_age, p.race,
       l.itemid, l.charttime, l.valuenum
FROM people p LEFT JOIN labevents l ON l.subject_id = p.subject_id AND l.hadm_id = p.hadm_id
 AND (l.charttime IS NULL OR l.charttime BETWEEN p.dischtime - INTERVAL 7 DAY AND p.dischtime)""",
        "interval_join": WINDOW + " SELECT DISTINCT * FROM raw_window",
        "csv_rejects": """
SELECT 'row' AS kind, labevent_id, hadm_id, round(valuenum, 3) AS valuenum, '' AS reason FROM labevents
WHERE labevent_id % 97 <> 0 AND labevent_id % 89 <> 0 AND labevent_id % 83 <> 0
UNION ALL
SELECT 'reject', labevent_id, NULL, NULL,
       CASE WHEN labevent_id % 83 = 0 THEN 'number of fields' WHEN labevent_id % 97 = 0 THEN 'hadm_id is no bigint'
            ELSE 'valuenum is no double' END
FROM labevents WHERE labevent_id % 97 = 0 OR labevent_id % 89 = 0 OR labevent_id % 83 = 0""",
        "bucketed_labs": """
SELECT subject_id, hadm_id, count(*) AS n_labs, count(valuenum) AS n_values, max(charttime) AS last_time
FROM labevents WHERE (subject_id, hadm_id) IN (SELECT (subject_id, hadm_id) FROM cohort) GROUP BY subject_id, hadm_id""",
        "semi_join_cohort": " SELECT * FROM labevents WHERE (subject_id, hadm_id) IN (SELECT (subject_id, hadm_id) FROM cohort)",
        "dedupe_labs": """
SELECT subject_id, hadm_id, itemid, charttime, valuenum, n_merged FROM (
  SELECT l.*, row_number() OVER w AS rn, count(*) OVER (PARTITION BY l.subject_id, l.hadm_id, l.itemid, l.charttime) AS n_merged
  FROM labevents l JOIN cohort c ON c.subject_id = l.subject_id AND c.hadm_id = l.hadm_id
  WINDOW w AS (PARTITION BY l.subject_id, l.hadm_id, l.itemid, l.charttime ORDER BY l.valuenum NULLS LAST))
WHERE rn = 1""",
        "duplicate_rows": """
SELECT subject_id, hadm_id, itemid, charttime, count(*) AS n_rows FROM labevents
GROUP BY ALL HAVING count(*) > 1""",
        "admissions_without_labs": EXTRACT + " SELECT DISTINCT subject_id, hadm_id FROM extract WHERE itemid IS NULL",
        "filtered_out_admissions": EXTRACT + """
SELECT DISTINCT subject_id, hadm_id FROM cohort
WHERE (subject_id, hadm_id) NOT IN (SELECT (subject_id, hadm_id) FROM extract)""",
        "summary_counts": EXTRACT + """
SELECT count(DISTINCT (subject_id, hadm_id)) AS unique_admissions,
       count(DISTINCT (subject_id, hadm_id)) FILTER (WHERE itemid IS NOT NULL) AS with_labs,
       count(DISTINCT (subject_id, hadm_id)) FILTER (WHERE itemid IS NULL) AS without_labs,
       count(DISTINCT subject_id) AS subjects, count(*) AS extract_rows,
       (SELECT count(*) FROM cohort) AS cohort_size,
       (SELECT count(*) FROM cohort) - count(DISTINCT (subject_id, hadm_id)) AS missing
FROM extract""",
        "reconcile_missing": EXTRACT + """,
listed AS (
  SELECT CASE WHEN subject_id % 97 <> 5 THEN subject_id END AS subject_id,
         CASE WHEN hadm_id % 89 <> 7 THEN hadm_id END AS hadm_id FROM admissions)
SELECT subject_id, hadm_id, CAST(subject_id IS NOT NULL AND hadm_id IS NOT NULL AS INTEGER) AS valid FROM (
  SELECT subject_id, hadm_id FROM listed EXCEPT SELECT subject_id, hadm_id FROM extract)""",
        "first_missing_pairs": EXTRACT + """
SELECT subject_id, hadm_id FROM admissions
WHERE subject_id % 97 <> 5 AND hadm_id % 89 <> 7
  AND (subject_id, hadm_id) NOT IN (SELECT (subject_id, hadm_id) FROM extract)
ORDER BY subject_id, hadm_id LIMIT 10""",
        "subject_list": " SELECT DISTINCT subject_id FROM cohort ORDER BY subject_id",
        "coerce_types": """
SELECT subject_id, hadm_id, CASE WHEN hadm_id % 7 <> 0 THEN admittime END AS admittime,
       CASE WHEN hadm_id % 11 <> 0 THEN dischtime END AS dischtime,
       CAST(CASE WHEN hadm_id % 5 <> 0 THEN anchor_age END AS DOUBLE) AS anchor_age,
       CAST(target AS DOUBLE) AS target
FROM people""",
        "union_batches": EXTRACT + " SELECT * FROM extract",
        "csv_roundtrip": """
SELECT 'text' AS kind, CAST(doc_id AS VARCHAR) AS row_key, md5(nullif(text, '')) AS digest,
       CAST(NULL AS TIMESTAMP) AS charttime, CAST(NULL AS DOUBLE) AS valuenum FROM documents
UNION ALL
SELECT 'labs', CAST(labevent_id AS VARCHAR), md5(hadm_id || '|' || itemid), charttime, valuenum FROM labevents""",
        "parquet_roundtrip": means() + " SELECT hadm_id, itemid, bin, round(mean, 6) + 0.0 AS mean FROM bm",
        "window_filter": """
SELECT labevent_id, hadm_id, itemid, micros_before FROM (
  SELECT l.labevent_id, l.hadm_id, l.itemid, epoch_us(c.dischtime) - epoch_us(l.charttime) AS micros_before
  FROM labevents l JOIN cohort c ON c.subject_id = l.subject_id AND c.hadm_id = l.hadm_id)
WHERE micros_before BETWEEN 0 AND 168 * 3600000000""",
        "time_bins": WINDOW + """
SELECT subject_id, hadm_id, itemid, charttime, CAST(floor(h / 12) AS INTEGER) AS bin,
       floor(h / 6) * 6 AS bin_start, least(CAST(floor(h / 6) AS INTEGER) + 1, 27) AS capped_bin
FROM (SELECT *, (epoch_us(dischtime) - epoch_us(charttime)) / 3.6e9 AS h FROM raw_window)""",
        "time_units": """
SELECT labevent_id, CAST(floor(s / 60) AS INTEGER) AS minute, CAST(floor(s / 3600) AS INTEGER) AS hour,
       CAST(trunc(s / 86400) AS INTEGER) AS day, CAST(floor(s / 86400) AS INTEGER) AS day_floor,
       CAST(floor(floor(s / 3600) / 12) AS INTEGER) AS hour_bin
FROM (SELECT l.labevent_id, (epoch_us(c.dischtime) - epoch_us(l.charttime)) / 1e6 AS s
      FROM labevents l JOIN cohort c ON c.subject_id = l.subject_id AND c.hadm_id = l.hadm_id
      WHERE l.charttime IS NOT NULL)""",
        "feature_names": WINDOW + """
SELECT CAST(itemid AS VARCHAR) AS item, itemid || '_' || b AS name,
       'itemid_' || itemid || '_last_' || b || 'h' AS verbose_name, count(*) AS n_rows
FROM (SELECT itemid, CAST(floor(hours / 12) AS INTEGER) AS b FROM wl) GROUP BY itemid, b""",
        "bin_mean": means() + " SELECT hadm_id, itemid, bin, round(mean, 6) + 0.0 AS mean FROM bm",
        "window_sweep": WINDOW + """
SELECT width, hadm_id, itemid, CAST(floor(hours / width) AS INTEGER) AS bin, round(avg(valuenum), 6) + 0.0 AS mean
FROM wl CROSS JOIN (SELECT unnest([2, 6, 12, 24]) AS width) GROUP BY 1, 2, 3, 4""",
        "interpolate_inside": filled(LINEAR) + OUT_FILLED,
        "interpolate_time_axis": filled(LINEAR, "bin") + OUT_FILLED,
        "ffill": filled("pv") + OUT_FILLED,
        "ffill_chronological": filled("nv") + OUT_FILLED,
        "bfill": filled("nv") + OUT_FILLED,
        "fill_chain": filled(CHAIN) + OUT_FILLED,
        "zero_fill": dense() + " SELECT hadm_id, itemid, pos, bin, round(coalesce(mean, 0), 6) + 0.0 AS filled FROM grid",
        "ffill_median": filled("nv") + MEDIAN_TRAIN + """
SELECT f.hadm_id, f.itemid, f.bin, round(coalesce(f.filled, med.median), 6) + 0.0 AS filled
FROM filled f LEFT JOIN med ON med.itemid = f.itemid""",
        "xmd_binned": XMD_BINNED.format(w=12, items=ITEM_LIST) + """
SELECT subject_id, hadm_id, stay, step, CAST(bin AS DOUBLE) * 12 AS t, itemid,
       round(x, 6) + 0.0 AS x, m, round(delta, 6) + 0.0 AS delta FROM xmd""",
        "xmd_irregular": WINDOW + f""",
steps AS (
  SELECT *, row_number() OVER (PARTITION BY hadm_id ORDER BY t) - 1 AS step, min(t) OVER (PARTITION BY hadm_id) AS t0
  FROM (SELECT DISTINCT subject_id, hadm_id, charttime, -hours AS t FROM wl)),
igrid AS (
  SELECT s.*, i.itemid, w.valuenum, w.hadm_id IS NOT NULL AS seen
  FROM steps s CROSS JOIN {ITEM_LIST} i
  LEFT JOIN wl w ON w.hadm_id = s.hadm_id AND w.charttime = s.charttime AND w.itemid = i.itemid)
SELECT subject_id || '_' || hadm_id AS stay, step, charttime, itemid, CAST(round(t * 3.6e9) AS BIGINT) AS t_micros,
       round(CASE WHEN seen THEN valuenum ELSE 0.0 END, 6) + 0.0 AS x, CAST(seen AS INTEGER) AS m,
       CAST(round((t - coalesce(max(CASE WHEN seen THEN t END) OVER (
         PARTITION BY hadm_id, itemid ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), t0)) * 3.6e9) AS BIGINT) AS delta_micros
FROM igrid""",
        "feature_sets": vmd_set("vmd"),
        "feature_set_md": vmd_set("md"),
        "item_stats": WINDOW + """
SELECT itemid, count(*) AS count, round(count(*) / (SELECT count(DISTINCT hadm_id) FROM wl), 6) + 0.0 AS freq_ts,
       round(avg(n), 6) + 0.0 AS num_ts
FROM (SELECT hadm_id, itemid, count(*) AS n FROM wl GROUP BY 1, 2) GROUP BY itemid""",
        "select_items": WINDOW + """
SELECT hadm_id, itemid, charttime, valuenum FROM wl WHERE itemid IN (
  SELECT itemid FROM (SELECT hadm_id, itemid, count(*) AS n FROM wl GROUP BY 1, 2) GROUP BY itemid
  HAVING avg(n) >= 2 AND count(*) / (SELECT count(DISTINCT hadm_id) FROM wl) >= 0.75)""",
        "top_items": WINDOW + """
SELECT itemid, count(DISTINCT hadm_id) AS count FROM wl GROUP BY itemid ORDER BY 2 DESC, 1 LIMIT 3""",
        "item_index": """
SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) - 1 AS INTEGER) AS item_idx
FROM (SELECT DISTINCT itemid FROM labevents)""",
        "zscore_normalise": WINDOW + """
SELECT hadm_id, itemid, charttime,
       round((valuenum - avg(valuenum) OVER w) / nullif(stddev_samp(valuenum) OVER w, 0), 6) + 0.0 AS z_sample,
       round((valuenum - avg(valuenum) OVER w) / nullif(stddev_pop(valuenum) OVER w, 0), 6) + 0.0 AS z_population
FROM wl WINDOW w AS (PARTITION BY itemid)""",
        "label_select": f"""
SELECT p.hadm_id, p.target AS target_label, CASE p.gender WHEN 'M' THEN 1 WHEN 'F' THEN 0 END AS gender_label,
       CASE WHEN p.anchor_age >= 30 THEN 1 ELSE 0 END AS anchor_age_label,
       {RACE.replace("race", "p.race")} AS race_label,
       CASE WHEN lower(a.insurance) = 'private' THEN 1 ELSE 0 END AS insurance_label
FROM people p JOIN admissions a ON a.hadm_id = p.hadm_id""",
        "race_encode": f"""
SELECT hadm_id, race, race_group, CAST(dense_rank() OVER (ORDER BY race_group) - 1 AS INTEGER) AS race_code
FROM (SELECT hadm_id, race, {RACE} AS race_group FROM admissions)""",
        "label_align": means() + """
SELECT b.hadm_id, p.subject_id, p.target FROM (SELECT DISTINCT hadm_id FROM bm) b
LEFT JOIN people p ON p.hadm_id = b.hadm_id""",
        "pivot_wide": filled(CHAIN) + pivot("filled", matrix_columns(14), WIDE),
        "pivot_last_n": LAST_N
        + pivot("rows_n", _last_n_columns(), "round(avg(valuenum) FILTER (WHERE {cond}), 6) + 0.0"),
        "pivot_measured": LAST_N
        + pivot(
            "rows_n",
            [*_last_n_columns("_measured")],
            "CAST(count(*) FILTER (WHERE {cond}) > 0 AS INTEGER)",
        ).replace(" FROM rows_n", ", max(target) AS target FROM rows_n"),
        "knn_impute": _knn(),
        "imputation_score": dense()
        + _imputation("overlay")
        + _imputation("augmentation")
        + " "
        + _imputation_out("overlay")
        + " UNION ALL "
        + _imputation_out("augmentation"),
        "holdout_split": HOLDOUT.format(rows="(SELECT hadm_id, subject_id, target FROM cohort)") + " SELECT * FROM split",
        "group_kfold": FOLDS + " SELECT * FROM folded",
        "fold_balance": FOLDS + """
SELECT fold, count(*) AS n_rows, count(DISTINCT subject_id) AS n_groups, CAST(sum(target) AS BIGINT) AS positives,
       round(avg(target), 6) + 0.0 AS positive_rate FROM folded GROUP BY fold""",
        "oversample_minority": SIZES + """,
pool AS (
  SELECT c.hadm_id, c.subject_id, c.target, row_number() OVER (ORDER BY md5(c.hadm_id || '|42')) - 1 AS pick
  FROM cohort c JOIN sizes s ON c.target = s.minority),
draws AS (
  SELECT CAST(j AS BIGINT) AS draw, CAST('0x' || substr(md5(j || '|42'), 1, 8) AS BIGINT) % n_min AS pick
  FROM sizes, range((SELECT deficit FROM sizes)) AS r(j))
SELECT hadm_id, subject_id, target, CAST(-1 AS BIGINT) AS draw FROM cohort
UNION ALL SELECT p.hadm_id, p.subject_id, p.target, d.draw FROM draws d JOIN pool p ON p.pick = d.pick""",
        "undersample_majority": SIZES + """
SELECT hadm_id, subject_id, target FROM (
  SELECT hadm_id, subject_id, target, row_number() OVER (PARTITION BY target ORDER BY md5(hadm_id || '|42')) AS rn FROM cohort)
WHERE rn <= (SELECT n_min FROM sizes)""",
        "class_weights": """
SELECT hadm_id, target, CAST(1 AS DOUBLE) AS w_none,
       round(count(*) OVER () / (2 * count(*) OVER (PARTITION BY target)), 6) + 0.0 AS w_balanced,
       CAST(CASE target WHEN 0 THEN 0.5 ELSE 2 END AS DOUBLE) AS w_given FROM cohort""",
        "confusion_metrics": SCORED + """,
c AS (SELECT count(*) FILTER (WHERE target = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE target = 0 AND score >= 0.5) AS fp,
             count(*) FILTER (WHERE target = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE target = 0 AND score < 0.5) AS tn FROM scored)
SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) + 0.0 AS recall,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) + 0.0 AS precision,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) + 0.0 AS f1,
       round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) + 0.0 AS balanced_accuracy,
       round((tp + tn) / (tp + fp + fn + tn), 6) + 0.0 AS accuracy FROM c""",
        "roc_auc": SCORED + """,
ranks AS (SELECT target, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM scored)
SELECT round((sum(r) FILTER (WHERE target = 1) - count(*) FILTER (WHERE target = 1) * (count(*) FILTER (WHERE target = 1) + 1) / 2)
             / (count(*) FILTER (WHERE target = 1) * count(*) FILTER (WHERE target = 0)), 6) + 0.0 AS roc_auc FROM ranks""",
        "pr_auc": PR + """,
ends AS (SELECT 1e9 AS cut, 1.0 AS precision, 0.0 AS recall UNION ALL SELECT * FROM points),
lagged AS (SELECT precision, recall, lag(precision) OVER o AS pp, lag(recall) OVER o AS pr FROM ends WINDOW o AS (ORDER BY cut DESC))
SELECT round(sum((recall - pr) * (precision + pp) / 2), 6) + 0.0 AS pr_auc FROM lagged""",
        "pr_curve": PR + """
SELECT cut AS threshold, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall FROM points""",
        "calibration_table": SCORED + """
SELECT least(CAST(floor(score * 10) AS INTEGER), 9) AS score_bin, count(*) AS n, round(avg(score), 6) + 0.0 AS mean_score,
       round(avg(target), 6) + 0.0 AS observed_rate, round(avg((score - target) * (score - target)), 6) + 0.0 AS brier
FROM scored GROUP BY 1""",
        "conformal_sets": SCORED + """,
halves AS (
  SELECT *, CAST('0x' || substr(md5(hadm_id || '|calibrate'), 1, 8) AS BIGINT) / 4294967296.0 < 0.5 AS cal FROM scored),
ordered AS (
  SELECT 1 - CASE WHEN target = 1 THEN score ELSE 1 - score END AS s,
         row_number() OVER (ORDER BY 1 - CASE WHEN target = 1 THEN score ELSE 1 - score END) AS rn, count(*) OVER () AS n
  FROM halves WHERE cal),
cut AS (SELECT coalesce(min(s), CAST('inf' AS DOUBLE)) AS q FROM ordered WHERE rn = ceil((n + 1) * 0.9))
SELECT hadm_id, target, score, CAST(score <= q AS INTEGER) AS in_set_0, CAST(1 - score <= q AS INTEGER) AS in_set_1,
       CAST(CASE WHEN target = 1 THEN 1 - score <= q ELSE score <= q END AS INTEGER) AS covered
FROM halves, cut WHERE NOT cal""",
        "dq_primary_key": " UNION ALL ".join(
            [
                " " + _primary("orders", "orders", "o_orderkey"),
                _primary("lineitem", "lineitem", "l_orderkey"),
                _primary("labevents", "labevents", "labevent_id"),
                _primary("labevents_natural", "labevents", "subject_id,hadm_id,itemid,charttime"),
                _primary("admissions", "admissions", "hadm_id"),
                _primary("patients", "patients", "subject_id"),
                _primary("patients_gender", "patients", "gender"),
            ]
        ),
        "dq_foreign_key": " UNION ALL ".join(
            [
                " " + _foreign("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
                _foreign("lineitem_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
                _foreign("labevents_patients", "labevents", "subject_id", "patients", "subject_id"),
                _foreign("labevents_cohort", "labevents", "hadm_id", "cohort", "hadm_id"),
            ]
        ),
        "dq_declared": " " + " UNION ALL ".join(_declared()),
        "dq_not_null": " "
        + " UNION ALL ".join(
            [
                _not_null("lineitem", LINEITEM),
                _not_null("labevents", "labevent_id subject_id hadm_id itemid charttime valuenum"),
                _not_null("patients", "subject_id gender anchor_age"),
            ]
        ),
        "dq_invalid_ids": """,
listed AS (
  SELECT CASE WHEN subject_id % 97 <> 5 THEN subject_id END AS subject_id,
         CASE WHEN hadm_id % 89 <> 7 THEN hadm_id END AS hadm_id FROM admissions)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE subject_id IS NULL) AS null_subject_id,
       count(*) FILTER (WHERE hadm_id IS NULL) AS null_hadm_id,
       count(*) FILTER (WHERE subject_id IS NULL OR hadm_id IS NULL) AS invalid_rows,
       count(*) FILTER (WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL) AS valid_rows FROM listed""",
        "missingness_features": WINDOW + f""",
mask AS (
  SELECT s.hadm_id, i.itemid, b.bin, EXISTS (
    SELECT 1 FROM wl WHERE wl.hadm_id = s.hadm_id AND wl.itemid = i.itemid AND CAST(floor(wl.hours / 12) AS INTEGER) = b.bin) AS m
  FROM (SELECT DISTINCT hadm_id FROM wl) s CROSS JOIN {ITEM_LIST} i CROSS JOIN (SELECT unnest(range(15)) AS bin) b)
SELECT k.hadm_id, k.itemid, k.ever_measured, k.frequency, k.mask_sd,
       CAST(round(w.first_hours * 3.6e9) AS BIGINT) AS first_micros, CAST(round(w.last_hours * 3.6e9) AS BIGINT) AS last_micros
FROM (SELECT hadm_id, itemid, CAST(bool_or(m) AS INTEGER) AS ever_measured, round(avg(m::INTEGER), 6) + 0.0 AS frequency,
             round(stddev_samp(m::INTEGER), 6) + 0.0 AS mask_sd FROM mask GROUP BY 1, 2) k
LEFT JOIN (SELECT hadm_id, itemid, max(hours) AS first_hours, min(hours) AS last_hours FROM wl GROUP BY 1, 2) w
  ON w.hadm_id = k.hadm_id AND w.itemid = k.itemid""",
        "missingness_by_group": WINDOW
        + " UNION ALL ".join(
            [
                _by_group("gender", "gender"),
                _by_group("race", RACE),
                _by_group("age_65", "CASE WHEN anchor_age >= 65 THEN '1' ELSE '0' END"),
            ]
        ),
        "item_cooccurrence": WINDOW + """,
places AS (SELECT DISTINCT hadm_id, CAST(floor(hours / 12) AS INTEGER) AS bin, itemid FROM wl),
single AS (SELECT itemid, count(*) AS n FROM places GROUP BY itemid),
pairs AS (
  SELECT a.itemid AS item_a, b.itemid AS item_b, count(*) AS together
  FROM places a JOIN places b ON a.hadm_id = b.hadm_id AND a.bin = b.bin AND a.itemid < b.itemid GROUP BY 1, 2)
SELECT item_a, item_b, together, x.n AS n_a, y.n AS n_b,
       round(together * (SELECT count(*) FROM (SELECT DISTINCT hadm_id, bin FROM places)) / (x.n * y.n), 6) + 0.0 AS lift
FROM pairs JOIN single x ON x.itemid = item_a JOIN single y ON y.itemid = item_b""",
        "missingness_target_assoc": WINDOW + f""",
flags AS (
  SELECT i.itemid, c.target, NOT EXISTS (SELECT 1 FROM wl WHERE wl.hadm_id = c.hadm_id AND wl.itemid = i.itemid) AS missing
  FROM cohort c CROSS JOIN {ITEM_LIST} i),
tab AS (
  SELECT itemid, count(*) FILTER (WHERE missing AND target = 1) AS a, count(*) FILTER (WHERE missing AND target = 0) AS b,
         count(*) FILTER (WHERE NOT missing AND target = 1) AS c, count(*) FILTER (WHERE NOT missing AND target = 0) AS d
  FROM flags GROUP BY itemid),
dbl AS (SELECT *, a::DOUBLE AS fa, b::DOUBLE AS fb, c::DOUBLE AS fc, d::DOUBLE AS fd, (a + b + c + d)::DOUBLE AS n FROM tab)
SELECT itemid, a AS missing_pos, b AS missing_neg, c AS seen_pos, d AS seen_neg,
       round((fa / nullif(fa + fb, 0)) / nullif((fa + fc) / n, 0), 6) + 0.0 AS lift,
       round((fa + 0.5) * (fd + 0.5) / ((fb + 0.5) * (fc + 0.5)), 6) + 0.0 AS odds_ratio,
       round(n * (fa * fd - fb * fc) ** 2 / nullif((fa + fb) * (fc + fd) * (fa + fc) * (fb + fd), 0), 6) + 0.0 AS chi_square
FROM dbl""",
    }
    return {name: f + body for name, body in sql.items()}

