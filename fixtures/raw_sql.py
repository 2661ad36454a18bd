"""Raw linkage inputs derived from ``customer`` by arithmetic alone.

The text below runs unchanged on Spark and on DuckDB, so a query and its SQL
check start from the same rows.  ``{customer}`` is the only placeholder.
Every table grows with ``customer``; only the nickname list is a fixed lookup.
"""

from __future__ import annotations

import re

# --- fixed values: names, areas; also the column names and missing codes of the raw tables below ------------------------------------------------
FIRST_NAMES = (
    "CHARLES,JOHN,DAVID,ELIZABETH,STEPHEN,ROBERT,MARGARET,KATHERINE,ANDREW,WILLIAM,CATRIONA,THOMAS,"
    "SUSAN,DANIEL,REBECCA,JOSEPH,PATRICIA,EDWARD,VICTORIA,MICHAEL,ALEXANDRA,GEORGE,DOROTHY"
)
NICKNAMES = (
    "CHARLIE,JACK,DAVE,LIZ,STEVE,BOB,PEGGY,KATE,ANDY,BILL,CAT,TOM,"
    "SUE,DAN,BECKY,JOE,PAT,TED,VICKY,MIKE,ALEX,GEORGIE,DOT"
)
MIDDLE_NAMES = "ANNE,JAMES,LEE,MARIE,PAUL,ROSE,GRANT,JANE,HUGH,FAITH,OWEN"
SURNAMES = (
    "SMITH,JONES,WILLIAMSON,BROWNE,TAYLOR,DAVIES,EVANSON,WILSHIRE,THOMASON,ROBERTSON,JOHNSTON,WRIGHTSON,"
    "WALKER,WHITEHEAD,EDWARDSON,HUGHESDON,GREENWOOD,HALLIDAY,LEWISHAM,HARRISON,CLARKSON,PATELMAN,JACKSON,"
    "WOODHOUSE,TURNER,MARTINEZ,COOPER,MORRISON,BAKERLEY"
)
AREAS = "AB,CF,EH,PO,SW,NE,LS,TQ"
# -------------------------------------------------------------------------------

_CTES: list[tuple[str, str]] = []


def _cte(name: str, sql: str) -> None:
    _CTES.append((name, sql.strip()))


_cte("k0", """
SELECT CAST(c_custkey AS INT) AS k FROM {customer}
""")

_cte("k1", """
SELECT k, k % 41 AS v,
       CAST(floor(k / 3) AS INT) AS g, CAST(floor(k / 12) AS INT) AS st,
       CASE WHEN k % 60 = 17 THEN 1 ELSE 0 END AS ce
FROM k0
""")

# household: one, three or six people; hg is the household's group number
_cte("k2", """
SELECT k1.*,
       CASE WHEN g % 4 = 1 THEN k WHEN g % 8 IN (2, 3) THEN 3 * (g - g % 2) ELSE 3 * g END AS hh
FROM k1
""")

_cte("k3", """
SELECT k2.*, CAST(floor(hh / 3) AS INT) AS hg FROM k2
""")

# names get new endings and postcodes new areas as the files grow, so blocks stay as small as they are
_cte("k4", f"""
SELECT k3.*,
       CASE WHEN hh < 1200 THEN '' ELSE concat(
         substr('BDFGKLMNPRST', 1 + CAST(floor(hh / 1200) AS INT) % 12, 1), substr('AEIOU', 1 + CAST(floor(hh / 14400) AS INT) % 5, 1),
         substr('LMNRTXBDGKPS', 1 + CAST(floor(hh / 72000) AS INT) % 12, 1)) END AS ending,
       CASE WHEN st < 14400 THEN split_part('{AREAS}', ',', 1 + CAST(floor(st / 200) AS INT) % 8)
            ELSE concat(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 1 + CAST(floor(st / 14400) AS INT) % 26, 1),
                        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 1 + CAST(floor(st / 374400) AS INT) % 26, 1)) END AS area
FROM k3
""")

_cte("base", f"""
SELECT k, v, g, st, hh, hg, ce,
       CASE WHEN hg % 13 = 12 THEN 1 ELSE 0 END AS mv,
       CASE WHEN hg % 13 = 6 THEN 1 ELSE 0 END AS rm,
       split_part('{FIRST_NAMES}', ',', 1 + k % 23) AS fn,
       split_part('{NICKNAMES}', ',', 1 + k % 23) AS nn,
       concat(split_part('{MIDDLE_NAMES}', ',', 1 + CAST(floor(k / 23) AS INT) % 11), ending) AS mn,
       concat(split_part('{SURNAMES}', ',', 1 + (g * 7) % 29), ending) AS sn,
       1940 + (k * 37 + 3 * CAST(floor(k / 420) AS INT)) % 70 AS yr, 1 + (k * 5 + CAST(floor(k / 420) AS INT)) % 12 AS mo,
       1 + (k * 11 + CAST(floor(k / 420) AS INT)) % 28 AS dy, 1 + k % 2 AS sx, area,
       -- placeholder postcodes: some hundred households share one
       concat(CAST(1 + CAST(floor(hh / 900) AS INT) % 99 AS STRING), ' ', CAST(1 + CAST(floor(hh / 89100) AS INT) % 9 AS STRING)) AS dz,
       concat(area, CAST(10 + CAST(floor(st / 9) AS INT) % 80 AS STRING), ' ', CAST(1 + st % 9 AS STRING),
              substr('ABDEFGHJLN', 1 + st % 10, 1),
              substr('PQRSTUWXYZ', 1 + CAST(floor(st / 10) AS INT) % 10, 1)) AS pc,
       1 + hh % 12 AS hn, 100000 + hh AS up, CASE WHEN hh % 2 = 0 THEN 1 + hh % 6 ELSE 0 END AS fl
FROM k4
""")

# ------------------------------------------------------------------ left file
_cte("raw_left_people", """
SELECT concat('L', CAST(k AS STRING)) AS resident_id,
       concat('LQ', CAST(hh AS STRING)) AS qid,
       CASE WHEN ce = 1 THEN 'CE0' ELSE concat('A', CAST(hh AS STRING)) END AS response_id,
       CASE WHEN ce = 1 THEN 'CE' ELSE 'HH' END AS residence_type,
       CASE WHEN ce = 1 THEN 'CE0' ELSE '-9' END AS ce_id,
       CASE WHEN ce = 1 THEN '-9' ELSE CAST(hh AS STRING) END AS household_id,
       CASE WHEN k % 113 = 50 THEN NULL WHEN k % 5 = 0 THEN lower(fn) WHEN k % 19 = 6 THEN concat(fn, ' 2') ELSE fn END
         AS first_name,
       CASE WHEN k % 29 = 3 THEN concat(mn, '-JO') WHEN k % 31 = 9 THEN concat('  ', mn, ' ') ELSE mn END AS middle_name,
       CASE WHEN k % 127 = 60 THEN '-9' WHEN k % 17 = 4 THEN concat('O''', sn) WHEN k % 23 = 8 THEN concat(sn, '-HILL')
            ELSE sn END AS last_name,
       CASE WHEN k % 3 = 0 THEN '-9' ELSE '-4' END AS resident_first_name,
       CASE WHEN k % 3 = 0 THEN '-9' ELSE '-4' END AS resident_last_name,
       concat(CASE WHEN k % 71 = 9 THEN 'XX' ELSE lpad(CAST(dy AS STRING), 2, '0') END,
              lpad(CAST(mo AS STRING), 2, '0'), CAST(yr AS STRING)) AS full_dob,
       CASE WHEN k % 97 = 11 THEN '-9' ELSE CAST(2021 - yr AS STRING) END AS resident_age,
       CASE WHEN k % 89 = 3 THEN '-9' WHEN k % 89 = 4 THEN '-7' ELSE CAST(sx AS STRING) END AS sex,
       CASE WHEN k % 11 = 0 THEN '-9' ELSE CAST(1 + k % 6 AS STRING) END AS marital_status,
       CASE WHEN k % 13 = 0 THEN '-8' WHEN k % 13 = 1 THEN '' ELSE CAST(1 + k % 5 AS STRING) END AS ethnic5,
       CASE WHEN k % 13 = 0 THEN '-8' ELSE CAST(1 + k % 19 AS STRING) END AS ethnic19,
       CASE WHEN k % 410 = 34 THEN concat('Unit 3, ', CAST(hn AS STRING), ' Alt Road, Town') ELSE '-9' END
         AS alternative_address,
       CASE WHEN k % 410 = 34 THEN concat('XX', dz, 'XX') WHEN k % 410 = 75 THEN concat('AL', dz, 'TT')
            WHEN rm = 1 AND k % 20 = 7 THEN pc WHEN k % 410 = 35 THEN '' ELSE '-9' END AS alternative_address_postcode,
       CASE WHEN k % 410 = 34 THEN CAST(500000 + hh AS STRING) ELSE '-8' END AS alternative_address_uprn,
       CASE WHEN mv = 1 THEN lower(concat('ZE', dz, 'ZZ')) ELSE '-9' END AS one_year_ago_postcode,
       CASE WHEN k % 59 IN (7, 8, 9) THEN '1' WHEN k % 59 = 10 THEN '-9' ELSE '2' END AS in_full_time_education,
       CASE WHEN k % 59 = 7 THEN '2' WHEN k % 59 = 8 THEN '3' WHEN k % 59 = 9 THEN '1' ELSE '-8' END
         AS is_hh_term_time_address,
       CASE WHEN k % 2 = 0 THEN 'online' ELSE 'paper' END AS mode
FROM base
""")

_cte("raw_left_forms", """
SELECT DISTINCT concat('A', CAST(hh AS STRING)) AS response_id,
       concat('Ground Floor Flat ', CAST(hn AS STRING), ' Station Road, Town') AS display_address,
       CASE WHEN hh % 10 = 7 THEN '-8' ELSE concat(CAST(hn AS STRING), ' Mill Lane') END AS address_raw,
       CASE WHEN hh % 10 IN (3, 7) THEN '-9'
            WHEN fl > 0 THEN concat('Flat ', lpad(CAST(fl AS STRING), 2, '0'), ', ', CAST(hn AS STRING), ' Park Road, Town')
            ELSE concat(lpad(CAST(hn AS STRING), 2, '0'), ' High Street, Town') END AS address,
       CASE WHEN hh % 211 = 5 THEN '-8' WHEN hh % 6 = 0 THEN lower(pc) ELSE pc END AS address_postcode,
       CASE WHEN hh % 223 = 7 THEN '-9' ELSE CAST(up AS STRING) END AS uprn
FROM base
UNION ALL
SELECT DISTINCT 'CE0' AS response_id, '-9' AS display_address, '-9' AS address_raw,
       '1 College Walk, Town' AS address, 'CF10 1AA' AS address_postcode, '700001' AS uprn
FROM base WHERE ce = 1
""")

_cte("raw_left_households", """
SELECT concat('LQ', CAST(hh AS STRING)) AS qid, concat('A', CAST(hh AS STRING)) AS response_id,
       CAST(hh AS STRING) AS household_id,
       CASE WHEN hg % 61 = 9 THEN '-7' ELSE CAST(1 + hh % 3 AS STRING) END AS ownership_type,
       CASE WHEN hg % 67 = 9 THEN '-3' ELSE CAST(1 + hh % 4 AS STRING) END AS accommodation_type,
       CASE WHEN hg % 73 = 9 THEN '-5' ELSE CAST(count(*) AS STRING) END AS number_of_residents,
       'N' AS from_dummy
FROM base GROUP BY hh, hg
UNION ALL
SELECT concat('LQE', CAST(k AS STRING)) AS qid, concat('A', CAST(hh AS STRING)) AS response_id,
       concat('E', CAST(k AS STRING)) AS household_id, '1' AS ownership_type, '-9' AS accommodation_type,
       '0' AS number_of_residents, 'Y' AS from_dummy
FROM base WHERE k % 150 = 30
""")

# ----------------------------------------------------------------- right file
_cte("right_keys", """
SELECT base.*, concat('R', CAST(k AS STRING)) AS rid FROM base WHERE v <> 39
UNION ALL
SELECT base.*, concat('RD', CAST(k AS STRING)) AS rid FROM base WHERE v = 40
""")

_cte("raw_right_people", """
SELECT rid AS resident_id,
       concat('RQ', CAST(k AS STRING)) AS qid,
       CASE WHEN ce = 1 THEN 'CE' ELSE 'HH' END AS residence_type,
       CASE WHEN ce = 1 THEN 'CE0' ELSE '-9' END AS ce_id,
       CASE WHEN ce = 1 THEN '-9' ELSE CAST(hh AS STRING) END AS household_id,
       CASE WHEN v IN (4, 5, 34) THEN nn WHEN v IN (3, 13) THEN sn WHEN v IN (6, 16) THEN mn
            WHEN v IN (7, 10, 11) THEN concat('Q', substr(fn, 2))
            WHEN v = 8 THEN concat(substr(fn, 1, length(fn) - 1), 'E')
            WHEN v IN (12, 24, 25, 26, 27) THEN concat(fn, 'ES') WHEN v = 14 THEN 'XAVIER'
            WHEN v = 18 THEN concat(substr(fn, 1, 1), 'U', substr(fn, 3), 'X')
            WHEN v = 19 THEN concat(substr(fn, 1, 2), 'ZZZWWQQ') WHEN v = 23 THEN concat(fn, 'IE')
            WHEN v = 33 THEN 'BABY' WHEN k % 7 = 2 THEN lower(fn) ELSE fn END AS first_name,
       CASE WHEN v IN (0, 3, 7, 14, 15) OR v >= 35 THEN mn WHEN v = 16 THEN fn WHEN k % 9 = 1 THEN '' ELSE '-9' END
         AS middle_name,
       CASE WHEN k % 131 = 70 THEN NULL WHEN v = 3 THEN fn WHEN v = 13 THEN concat(substr(fn, 1, length(fn) - 1), 'O')
            WHEN v IN (11, 23) THEN concat(sn, 'E') WHEN v IN (12, 24, 25, 26, 27) THEN concat(sn, 'ES')
            WHEN v = 15 THEN 'OTHERNAME' WHEN v = 17 THEN 'MARRIED' WHEN v = 33 THEN 'BABYS'
            WHEN k % 17 = 4 THEN concat('O ', sn) ELSE sn END AS last_name,
       CASE WHEN v = 33 THEN fn WHEN v % 2 = 0 THEN '-4' ELSE '-9' END AS resident_first_name,
       CASE WHEN v = 33 THEN sn WHEN v % 2 = 0 THEN '-4' ELSE '-9' END AS resident_last_name,
       CASE WHEN v = 38 THEN 'XXXXXXXX' ELSE concat(
         CASE WHEN k % 71 = 9 THEN 'XX'
              WHEN v IN (5, 20, 22, 35) THEN lpad(CAST(CASE WHEN dy = 28 THEN 1 ELSE dy + 1 END AS STRING), 2, '0')
              WHEN v IN (23, 24) THEN concat(substr(lpad(CAST(dy AS STRING), 2, '0'), 1, 1),
                                             CASE WHEN dy % 10 = 9 THEN '8' ELSE '9' END)
              WHEN v IN (25, 26, 32) THEN '31' ELSE lpad(CAST(dy AS STRING), 2, '0') END,
         CASE WHEN v IN (22, 25, 26, 32) THEN lpad(CAST(CASE WHEN mo = 12 THEN 1 ELSE mo + 1 END AS STRING), 2, '0')
              ELSE lpad(CAST(mo AS STRING), 2, '0') END,
         CAST(CASE WHEN v = 21 THEN yr + 4 WHEN v IN (25, 26) THEN yr - 1 WHEN v = 32 THEN yr - 4 ELSE yr END AS STRING)
       ) END AS full_dob,
       CASE WHEN k % 9 IN (4, 5) THEN '-9' WHEN k % 27 = 6 THEN '' ELSE CAST(2021 - yr
         + CASE WHEN v = 21 THEN -4 WHEN v = 22 THEN 3 WHEN v IN (25, 26) THEN 1 WHEN v = 32 THEN 4 ELSE 0 END AS STRING) END
         AS resident_age,
       CASE WHEN k % 45 = 5 THEN '-8' WHEN k % 9 IN (4, 5) OR k % 27 = 6 THEN CAST(2021 - yr
         + CASE WHEN v = 21 THEN -4 WHEN v = 22 THEN 3 WHEN v IN (25, 26) THEN 1 WHEN v = 32 THEN 4 ELSE 0 END AS STRING)
         ELSE '-5' END AS resident_age_last_birthday,
       CASE WHEN k % 4 = 0 THEN '-8' WHEN k % 4 = 1 THEN '-4' ELSE '1' END AS estimate_age,
       CASE WHEN v = 9 THEN CAST(3 - sx AS STRING) WHEN v = 27 THEN '-9' ELSE CAST(sx AS STRING) END AS sex,
       CASE WHEN k % 11 = 0 THEN '-9' ELSE CAST(1 + k % 6 AS STRING) END AS marital_status,
       CASE WHEN k % 13 = 0 THEN '-8' ELSE CAST(1 + k % 5 AS STRING) END AS ethnic5,
       CASE WHEN k % 13 = 0 THEN '-8' ELSE concat(CAST(1 + k % 19 AS STRING), ' ') END AS ethnic19,
       CASE WHEN v = 34 THEN concat('Apartment 4, ', CAST(hn AS STRING), ' Alt Road, Town') ELSE '-9' END
         AS alternative_address,
       CASE WHEN k % 410 = 75 THEN concat('AL', dz, 'TT') WHEN v = 34 THEN pc ELSE '-9' END AS alternative_address_postcode,
       CASE WHEN v = 34 THEN CAST(up AS STRING) ELSE '-9' END AS alternative_address_uprn,
       CASE WHEN k % 59 IN (7, 8, 9) THEN '1' ELSE '2' END AS in_full_time_education,
       CASE WHEN k % 59 = 7 THEN '2' WHEN k % 59 = 8 THEN '3' ELSE '1' END AS is_hh_term_time_address,
       CASE WHEN k % 3 = 0 THEN 'online' ELSE 'field' END AS mode
FROM right_keys
""")

_cte("right_places", """
SELECT base.*,
       CASE WHEN ce = 1 THEN 'CF10 1AA' WHEN mv = 1 THEN concat('ZE', dz, 'ZZ') WHEN rm = 1 THEN concat('ZZ', dz, 'ZZ')
            WHEN v IN (1, 24, 25) THEN concat('YY', dz, 'YY') WHEN v = 29 THEN concat(substr(pc, 1, length(pc) - 1), 'V')
            WHEN v = 30 THEN concat(substr(pc, 1, length(pc) - 2), 'VV') WHEN v = 31 THEN concat(area, '99 9VV')
            WHEN v = 34 THEN concat('XX', dz, 'XX') ELSE pc END AS right_pc,
       CASE WHEN mv = 1 THEN hh % 90 ELSE hn END AS right_hn,
       CASE WHEN ce = 1 THEN '700001' WHEN mv = 1 THEN CAST(900000 + hh AS STRING)
            WHEN rm = 1 THEN CAST(950000 + hh AS STRING)
            WHEN v IN (2, 3, 4, 8, 9, 10, 11, 12, 13, 14, 15, 20, 21, 22, 26, 29, 30, 31, 32, 33, 34)
              THEN concat('8', CAST(up AS STRING))
            ELSE CAST(up AS STRING) END AS right_up
FROM base
""")

# a form per person and a form per household; some person forms come twice with another display line
_cte("raw_right_forms", """
SELECT concat('RQ', CAST(k AS STRING)) AS qid,
       concat(CAST(right_hn AS STRING), ' Station Road') AS display_address,
       CASE WHEN ce = 1 THEN '1 College Walk, Town' WHEN hh % 10 = 7 THEN '-9'
            WHEN fl > 0 THEN concat('Flat ', CAST(fl AS STRING), ', ', CAST(right_hn AS STRING), ' Park Road, Town')
            ELSE concat(CAST(right_hn AS STRING), ' High Street, Town') END AS address,
       right_pc AS address_postcode, right_up AS uprn
FROM right_places
UNION ALL
SELECT concat('RQ', CAST(k AS STRING)) AS qid,
       concat(CAST(right_hn AS STRING), ' Station Road Rear') AS display_address, '-9' AS address,
       right_pc AS address_postcode, right_up AS uprn
FROM right_places WHERE k % 43 = 7
UNION ALL
SELECT DISTINCT concat('RH', CAST(hh AS STRING)) AS qid,
       concat(CAST(hn AS STRING), ' Station Road') AS display_address,
       CASE WHEN hg % 11 <> 5 AND fl > 0 THEN concat('Apartment ', CAST(fl AS STRING), ', ', CAST(hn AS STRING), ' Park Road, Town')
            WHEN hh % 10 = 3 THEN '-8' ELSE concat(CAST(hn AS STRING), ' High Street, Town') END AS address,
       CASE WHEN rm = 1 THEN concat('ZZ', dz, 'ZZ') WHEN hg % 17 = 3 THEN concat(substr(pc, 1, length(pc) - 2), 'VV') ELSE pc END
         AS address_postcode,
       CASE WHEN rm = 1 THEN CAST(950000 + hh AS STRING)
            WHEN hg % 3 = 1 OR hg % 17 = 3 THEN concat('8', CAST(up AS STRING)) ELSE CAST(up AS STRING) END AS uprn
FROM base
""")

_cte("raw_right_households", """
SELECT concat('RH', CAST(hh AS STRING)) AS qid, CAST(hh AS STRING) AS household_id,
       CASE WHEN hg % 61 = 10 THEN '-8' ELSE CAST(1 + (hh + CASE WHEN hg % 5 = 1 THEN 1 ELSE 0 END) % 3 AS STRING) END
         AS ownership_type,
       CASE WHEN hg % 67 = 10 THEN '-9' ELSE CAST(1 + (hh + CASE WHEN hg % 5 = 2 THEN 1 ELSE 0 END) % 4 AS STRING) END
         AS accommodation_type,
       CASE WHEN hg % 73 = 10 THEN '-4' ELSE CAST(count(*) + CASE WHEN hg % 5 = 3 THEN 1 ELSE 0 END AS STRING) END
         AS resident_count,
       CASE WHEN rm = 1 THEN '1' ELSE '0' END AS refday_indicator,
       CASE WHEN hg % 13 = 8 THEN '-8'
            WHEN rm = 1 OR hg % 13 = 10 THEN
              CASE WHEN fl > 0 THEN concat('Flat ', CAST(fl AS STRING), ', ', CAST(hn AS STRING), ' Park Road, Town')
                   ELSE concat(CAST(hn AS STRING), ' High Street, Town') END
            ELSE '-9' END AS refday_address,
       CASE WHEN hg % 13 = 7 THEN '-8' WHEN hg % 13 = 9 THEN NULL WHEN rm = 1 OR hg % 13 IN (8, 10) THEN pc ELSE '-9' END
         AS refday_postcode,
       CASE WHEN rm = 1 OR hg % 13 IN (8, 10) THEN CAST(up AS STRING) ELSE '-9' END AS refday_uprn,
       CASE WHEN rm = 1 THEN 'A' ELSE '-9' END AS refday_country
FROM base GROUP BY hh, hg, rm, fl, hn, pc, up
""")

# -------------------------------------------------------------------- lookups
# nickname and first name both lead to the first name; two nicknames have a second meaning
_cte("raw_nicknames", f"""
SELECT DISTINCT split_part('{FIRST_NAMES}', ',', 1 + k % 23) AS in_name,
       split_part('{FIRST_NAMES}', ',', 1 + k % 23) AS out_name FROM k0
UNION ALL
SELECT DISTINCT split_part('{NICKNAMES}', ',', 1 + k % 23) AS in_name,
       split_part('{FIRST_NAMES}', ',', 1 + k % 23) AS out_name FROM k0
UNION ALL
SELECT DISTINCT CASE WHEN k % 2 = 0 THEN 'ALEX' ELSE 'PAT' END AS in_name,
       CASE WHEN k % 2 = 0 THEN 'ALEXANDER' ELSE 'PATRICK' END AS out_name FROM k0
""")

_cte("raw_areas", """
SELECT pc AS pcd, concat('LA', min(area)) AS laua, concat('RG', CAST(min(st) % 9 AS STRING)) AS rgn,
       concat('LS', CAST(min(st) % 50 AS STRING)) AS lsoa11
FROM base GROUP BY pc
""")

_cte("raw_willingness", """
SELECT DISTINCT concat('LS', CAST(st % 50 AS STRING)) AS lsoa_code, 1 + (st % 50) % 5 AS willingness FROM base
WHERE st % 50 < 45
""")

_cte("raw_removals", """
SELECT concat('L', CAST(k AS STRING)) AS id FROM base WHERE k % 101 = 13
""")

# decision loads: true pairs, a later change of mind, undecided pairs, a wrong pair, one repeated row
_cte("raw_decisions", """
SELECT 1 AS load_no, concat('R', CAST(k AS STRING)) AS right_id, concat('L', CAST(k AS STRING)) AS left_id,
       CASE WHEN k % 3 = 2 THEN NULL WHEN k % 3 = 1 THEN '1' ELSE '0' END AS match_status
FROM base WHERE v IN (14, 25, 31, 32, 40)
UNION ALL
SELECT 1 AS load_no, concat('R', CAST(k AS STRING)) AS right_id, concat('L', CAST(k + 41 AS STRING)) AS left_id,
       '0' AS match_status
FROM base WHERE v = 40
UNION ALL
SELECT 2 AS load_no, concat('R', CAST(k AS STRING)) AS right_id, concat('L', CAST(k AS STRING)) AS left_id,
       CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS match_status
FROM base WHERE v IN (14, 31) AND k % 5 < 3
UNION ALL
SELECT 2 AS load_no, concat('RD', CAST(k AS STRING)) AS right_id, concat('L', CAST(k AS STRING)) AS left_id,
       '0' AS match_status
FROM base WHERE v = 40
""")

RAW_TABLES = tuple(name for name, _ in _CTES if name.startswith("raw_"))


def needed_for(text: str, ctes: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Those CTEs that ``text`` builds on, directly or through others, in their order."""
    kept = []
    for name, sql in reversed(ctes):
        if re.search(rf"\b{name}\b", text):
            kept.append((name, sql))
            text += "\n" + sql
    return kept[::-1]


def spark_raw(spark, sf_dir: str, table: str):
    """One raw table as a DataFrame over the driver's ``customer`` Parquet file.

    The file is small for the work that follows from each key, so its keys are
    dealt to all shuffle partitions; read as they lie they are one task's work.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey").repartition(parts, "c_custkey")
    query = f"SELECT * FROM {table}"
    ctes = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in needed_for(query, _CTES))
    return spark.sql(f"WITH {ctes} {query}", customer=customer)


def raw_ctes(customer: str = "customer") -> list[tuple[str, str]]:
    """The raw tables as named queries."""
    return [(name, sql.replace("{customer}", customer)) for name, sql in _CTES]
