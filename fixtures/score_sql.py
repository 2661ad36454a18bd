"""DuckDB twins of m/u estimation, blocking, scoring, combining and the clerical loop."""

from __future__ import annotations

from fixtures.key_sql import household_links, person_links

VARIABLES = ("fn1", "sn1", "sex", "dob")

DECISIONS = """
  SELECT left_id AS id_l, right_id AS id_r, TRY_CAST(match_status AS INT) AS match_status, CAST(load_no AS INT) AS load_no
  FROM raw_decisions"""

GOLD = """
  SELECT id_l, id_r FROM (
    SELECT *, max(load_no) OVER (PARTITION BY id_l, id_r) AS newest FROM (
      SELECT id_l, id_r, 1 AS match_status, 0 AS load_no FROM links WHERE mkey NOT IN (14, 31, 32)
      UNION ALL SELECT id_l, id_r, match_status, load_no FROM decisions) g0) g1
  WHERE load_no = newest AND match_status = 1"""

M_VALUES = "\nUNION ALL\n".join(
    f"SELECT '{v}' AS variable, sum(CASE WHEN l.{v} = r.{v} THEN 1 ELSE 0 END)::DOUBLE / count(*) AS m_value "
    "FROM gold g JOIN l ON l.id = g.id_l JOIN r ON r.id = g.id_r"
    for v in VARIABLES
)

RANDOM_PAIRS = f"""
  SELECT a.id AS id_l, b.id AS id_r, {', '.join(f'a.{v} AS {v}_l, b.{v} AS {v}_r' for v in VARIABLES)}
  FROM (SELECT *, row_number() OVER (ORDER BY md5('u_l' || id), fn1_nickname) AS place FROM l) a
  JOIN (SELECT *, row_number() OVER (ORDER BY md5('u_r' || id), fn1_nickname) AS place FROM r) b ON a.place = b.place"""


def _known(i, sides=("_l", "_r")):
    return " AND ".join(f"{v}{s} IS NOT NULL" for v in VARIABLES[: i + 1] for s in sides)


U_VALUES = "\nUNION ALL\n".join(
    f"SELECT '{v}' AS variable, count(*) FILTER (WHERE {v}_l = {v}_r)::DOUBLE / count(*) AS u_value "
    f"FROM random_pairs WHERE {_known(i)}"
    for i, v in enumerate(VARIABLES)
)

EXACT_U = "\nUNION ALL\n".join(
    f"""SELECT '{v}' AS variable,
  coalesce((SELECT sum(a.n::DOUBLE * b.n) FROM (SELECT {v}, count(*) AS n FROM l WHERE {_known(i, ('',))} GROUP BY {v}) a
   JOIN (SELECT {v}, count(*) AS n FROM r WHERE {_known(i, ('',))} GROUP BY {v}) b ON a.{v} = b.{v}), 0)
  / ((SELECT count(*) FROM l WHERE {_known(i, ('',))})::DOUBLE * (SELECT count(*) FROM r WHERE {_known(i, ('',))})) AS u_value"""
    for i, v in enumerate(VARIABLES)
)



def _value(variable, column):
    return f"least(greatest(max({column}) FILTER (WHERE variable = '{variable}'), 1e-9::DOUBLE), 1 - 1e-9::DOUBLE)"


def _log_ratio(a, b):
    """log2(a / b), NULL where the ratio is not positive or has no value."""
    return f"log2(nullif(({a}) / nullif({b}, 0), 0))"


WEIGHTS = "SELECT " + ", ".join(
    f"{_log_ratio(_value(v, 'm_value'), _value(v, 'u_value'))} AS {v}_aw, "
    f"{_log_ratio('1 - ' + _value(v, 'm_value'), '1 - ' + _value(v, 'u_value'))} AS {v}_dw"
    for v in VARIABLES
) + " FROM m_values JOIN u_values USING (variable)"

CANDIDATES = "\nUNION\n".join(
    f"SELECT l.id AS id_l, r.id AS id_r FROM l JOIN r ON r.{right} = l.{left}"
    for right in ("pc_refday", "pc_intday", "pc_alt")
    for left in ("pc", "pc_alt")
)

_COLS = ("fn", "fn1", "sn", "sn1", "dob", "day", "mon", "year", "age", "sex")


def _lev(c):
    return f"(1 - levenshtein({c}_l, {c}_r) / greatest(length({c}_l), length({c}_r)))"


def _name(first, whole):
    best = f"CASE WHEN {_lev(whole)} > {_lev(first)} THEN {_lev(whole)} ELSE {_lev(first)} END"
    return f"CASE WHEN {best} > 0.9::DOUBLE THEN 1.0::DOUBLE ELSE {best} END"


AGREEMENTS = f"""
  SELECT * EXCLUDE (f0, s0, d0),
         CASE WHEN f0 <= 0.45::DOUBLE THEN 0 ELSE f0 END AS fn1_agreement, CASE WHEN s0 <= 0.45::DOUBLE THEN 0 ELSE s0 END AS sn1_agreement,
         CASE WHEN d0 <= 0.5::DOUBLE THEN 0 ELSE d0 END AS dob_agreement,
         CASE WHEN sex_l = sex_r THEN 1 ELSE 0 END::DOUBLE AS sex_agreement
  FROM (SELECT *, CASE WHEN (dob_l IS NULL OR dob_r IS NULL) AND f0 > 0.65::DOUBLE AND s0 > 0.65::DOUBLE AND sex_l = sex_r AND abs(age_r - age_l) < 2 THEN 0.7::DOUBLE
                       WHEN (dob_l IS NULL OR dob_r IS NULL) AND f0 > 0.65::DOUBLE AND s0 > 0.65::DOUBLE AND sex_l = sex_r AND abs(age_r - age_l) < 4 THEN 0.55::DOUBLE
                       ELSE (CASE WHEN day_l = day_r THEN 1.0::DOUBLE / 3 ELSE 0 END) + (CASE WHEN mon_l = mon_r THEN 1.0::DOUBLE / 3 ELSE 0 END)
                            + (CASE WHEN year_l = year_r THEN 1.0::DOUBLE / 3 ELSE 0 END) END AS d0
        FROM (SELECT *, CASE WHEN nick THEN 1.0::DOUBLE ELSE coalesce({_name('fn1', 'fn')}, 0) END AS f0,
                     coalesce({_name('sn1', 'sn')}, 0) AS s0
              FROM (SELECT c.id_l, c.id_r, bool_or(coalesce(l.fn1_nickname = r.fn1_nickname, FALSE)) AS nick,
                           {', '.join(f'any_value(l.{c}) AS {c}_l, any_value(r.{c}) AS {c}_r' for c in _COLS)}
                    FROM candidates c JOIN l ON l.id = c.id_l JOIN r ON r.id = c.id_r GROUP BY c.id_l, c.id_r) a0) a1) a2"""


def _weight(v):
    slope = f"greatest({v}_aw - ({v}_aw - {v}_dw) * (1 - {v}_agreement) * 2, {v}_dw)"
    return (
        f"CASE WHEN ({v}_l IS NULL OR {v}_r IS NULL) AND {v}_agreement = 0 THEN 0 WHEN {v}_agreement < 1 THEN {slope} "
        f"ELSE {v}_aw END AS {v}_weight"
    )


SCORED = f"""
  SELECT *, CASE WHEN coalesce(abs(age_r - age_l) > 5, FALSE) THEN 0 ELSE fn1_weight + sn1_weight + dob_weight + sex_weight END AS match_score
  FROM (SELECT a.*, w.*, {', '.join(_weight(v) for v in VARIABLES)} FROM agreements a, weights w) s0"""

BANDS = """
  SELECT b AS score_min, b + 0.5 AS score_max, count(*) AS total_pairs, count(k.mkey) AS matched_mkeys,
         count(*) - count(k.mkey) AS not_matched_mkeys
  FROM (SELECT CAST(range AS DOUBLE) / 2 AS b FROM range(0, 400)) bands
  JOIN scored s ON s.match_score BETWEEN b AND b + 0.5
  LEFT JOIN (SELECT * FROM links WHERE mkey NOT IN (14, 31, 32)) k ON k.id_l = s.id_l AND k.id_r = s.id_r
  GROUP BY b"""

COMBINED = """
  SELECT id_l, id_r, mkey, match_score, id_l_count, id_r_count,
         CASE WHEN mkey IN (14, 31, 32) THEN 1 WHEN id_l_count > 1 OR id_r_count > 1 THEN 1 WHEN mkey IS NOT NULL THEN 0
              ELSE flag END AS clerical
  FROM (SELECT *, count(*) OVER (PARTITION BY id_l) AS id_l_count, count(*) OVER (PARTITION BY id_r) AS id_r_count FROM (
    SELECT id_l, id_r, min(mkey) AS mkey, max(match_score) AS match_score, min(flag) AS flag FROM (
      SELECT id_l, id_r, mkey, NULL::DOUBLE AS match_score, 0 AS flag FROM links
      UNION ALL SELECT id_l, id_r, NULL, match_score, 0 FROM scored WHERE match_score > 40
      UNION ALL SELECT id_l, id_r, NULL, match_score, 1 FROM scored WHERE match_score BETWEEN 8.5 AND 40) c0
    GROUP BY id_l, id_r) c1) c2"""

DECIDED = "SELECT DISTINCT id_l, id_r FROM decisions WHERE match_status IS NOT NULL"

TO_REVIEW = """
  SELECT c.id_l, c.id_r FROM combined c LEFT JOIN decided d ON d.id_l = c.id_l AND d.id_r = c.id_r
  WHERE c.clerical = 1 AND d.id_l IS NULL"""

NEWEST = """
  SELECT * EXCLUDE (newest) FROM (SELECT *, max(load_no) OVER (PARTITION BY id_l, id_r) AS newest FROM decisions) n0
  WHERE load_no = newest"""

FINAL = """
  SELECT id_l, id_r, match_score, mkey, clerical FROM (
    SELECT *, row_number() OVER (PARTITION BY id_l, id_r ORDER BY clerical) AS rn FROM (
      SELECT id_l, id_r, match_score, mkey, clerical FROM combined WHERE clerical = 0
      UNION ALL SELECT id_l, id_r, 99::DOUBLE, NULL, 1 FROM newest WHERE match_status = 1) f0) f1
  WHERE rn = 1 AND (id_l, id_r) NOT IN (SELECT (id_l, id_r) FROM newest WHERE match_status = 0)"""


def clusters(pairs: str) -> list[tuple[str, str]]:
    """CTEs that number the connected components of a pair table as the library does."""
    return [
        (f"{pairs}_edges", f"""
  SELECT '1:' || id_l AS a, '2:' || id_r AS b FROM {pairs} UNION SELECT '2:' || id_r, '1:' || id_l FROM {pairs}"""),
        (f"{pairs}_reach", f"""
  SELECT DISTINCT a AS v, a AS w FROM {pairs}_edges UNION SELECT r.v, e.b FROM {pairs}_reach r JOIN {pairs}_edges e ON e.a = r.w"""),
        (f"{pairs}_least", f"SELECT v, min(w) AS component FROM {pairs}_reach GROUP BY v"),
        (f"{pairs}_clustered", f"""
  SELECT p.id_l, p.id_r, dense_rank() OVER (ORDER BY md5(c.component)) AS cluster_number
  FROM {pairs} p JOIN {pairs}_least c ON c.v = '1:' || p.id_l"""),
    ]


def ingest(clustered: str) -> str:
    return f"""
  SELECT DISTINCT id_l AS unique_id, cluster_number, 'left' AS dataset FROM {clustered}
  UNION ALL SELECT DISTINCT id_r, cluster_number, 'right' FROM {clustered}"""


# CTEs in order of need; each name stands for its table
CHAIN: list[tuple[str, str]] = [
    ("links", person_links()),
    ("household_links", household_links()),
    ("decisions", DECISIONS),
    ("gold", GOLD),
    ("m_values", M_VALUES),
    ("random_pairs", RANDOM_PAIRS),
    ("u_values", U_VALUES),
    ("exact_u", EXACT_U),
    ("weights", WEIGHTS),
    ("candidates", CANDIDATES),
    ("agreements", AGREEMENTS),
    ("scored", SCORED),
    ("bands", BANDS),
    ("combined", COMBINED),
    ("decided", DECIDED),
    ("to_review", TO_REVIEW),
    ("newest", NEWEST),
    ("final_links", FINAL),
    *clusters("to_review"),
    *clusters("links"),
]
