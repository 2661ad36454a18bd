"""DuckDB twins of the cleaning stages, written as CTEs over the raw tables."""

from __future__ import annotations

from fixtures.raw_sql import needed_for, raw_ctes

FLOOR_TERMS = [
    "FIRST FLOOR FLAT", "FLAT 1ST FLOOR", "SECOND FLOOR FLAT", "FLAT 2ND FLOOR", "FLAT 1ST AND 2ND FLOOR",
    "FLAT 1ST 2ND AND 3RD FLOOR", "THIRD FLOOR FLAT", "FLAT 2ND AND 3RD FLOOR", "FLAT 3RD AND 4TH FLOOR",
    "FLAT 4TH AND 5TH FLOOR", "GROUND FLOOR FLAT",
]


def nospace(x):
    return f"trim(regexp_replace({x}, '[^A-Z]+', '', 'g'))"


def az(x):
    return f"trim(regexp_replace({x}, '[^A-Z ]+', '', 'g'))"


def hyphens(x):
    return f"trim(regexp_replace({x}, '-+', ' ', 'g'))"


def spaces(x):
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def word(x, i):
    return f"nullif(string_split({az(spaces(hyphens(x)))}, ' ')[{i + 1}], '')"


def alpha(x):
    return f"list_aggregate(list_sort(string_split({x}, '')), 'string_agg', '')"


def codes(x, *values):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN {x} NOT IN ({listed}) THEN {x} END"


def blank(x, *values):
    listed = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN {x} IN ({listed}) THEN '' ELSE {x} END"


def digits(x):
    return f"TRY_CAST(regexp_replace({x}, '[^0-9]', '', 'g') AS INT)"


def coded(x):
    return digits(f"CASE WHEN contains({x}, '-') THEN '' ELSE {x} END")


def postcode(x):
    return f"nullif(upper(regexp_replace({x}, '[^0-9A-Za-z]+', '', 'g')), '')"


def house_number(x):
    s = f"regexp_replace(regexp_replace(upper({x}), '[^,]*$', ''), ',$', '')"
    for t in FLOOR_TERMS:
        s = f"trim(replace({s}, '{t}', ''))"
    for w in ("FLAT", "APARTMENT", "UNIT", "ROOM"):
        s = f"trim(regexp_replace({s}, '{w}\\s*\\d+', '', 'g'))"
    return f"ltrim(list_filter(regexp_extract_all({s}, '\\d+'), lambda n: n <> '0')[1], '0')"


def flat_number(x):
    flat = f"regexp_extract_all(upper({x}), 'FLAT (\\d+)', 1)[1]"
    apartment = f"regexp_extract_all(upper({x}), 'APARTMENT (\\d+)', 1)[1]"
    return f"ltrim(nullif(coalesce({flat}, {apartment}), '0'), '0')"


def sector(pc):
    return f"CASE WHEN length({pc}) >= 2 THEN substr({pc}, 1, length({pc}) - 2) WHEN {pc} IS NOT NULL THEN '' END"


def pc_parts(pc):
    s = sector(pc)
    return f"""{s} AS pc_sect,
       CASE WHEN length({s}) = 5 THEN substr({s}, 1, 4) WHEN length({s}) = 4 THEN substr({s}, 1, 3)
            ELSE substr({s}, 1, 2) END AS pc_dist,
       CASE WHEN substr({s}, 2, 1) IN ('1','2','3','4','5','6','7','8','9') THEN substr({s}, 1, 1)
            ELSE substr({s}, 1, 2) END AS pc_area,
       CASE WHEN {pc} = '' THEN '' ELSE substr({pc}, 1, length({pc}) - 1) END AS pc_substr"""


def masked(x, m):
    return f"CASE WHEN {x} NOT IN ('{m*4}-{m*2}-{m*2}', '{m*4}', '{m*2}', '') THEN {x} END"


def _standard(side: str) -> str:
    m = "X" if side == "left" else "Y"
    dob = "full_dob" if side == "left" else "replace(full_dob, 'X', 'Y')"
    if side == "left":
        age = f"TRY_CAST({blank('resident_age', '-9')} AS INT)"
        extra = f"response_id, {postcode(codes('one_year_ago_postcode', '-9', '-8'))} AS pc_1y"
    else:
        age = (
            f"TRY_CAST(coalesce(nullif({blank('resident_age', '-9')}, ''), "
            f"{blank('resident_age_last_birthday', '-9', '-8', '-5', '-4')}) AS INT)"
        )
        extra = f"residence_type, {codes('estimate_age', '-8', '-4')} AS estimate_age"
    return f"""
  SELECT *, CASE WHEN last_name IS NULL OR forenames0 IS NULL THEN NULL ELSE
           {spaces(f"{az(hyphens('forenames0'))} || ' ' || {az(hyphens('last_name'))}")} END AS fullname0
  FROM (SELECT *, CASE WHEN concat_ws(' ', first_name, middle_name) = ' ' THEN '' ELSE concat_ws(' ', first_name, middle_name) END
               AS forenames0
        FROM (SELECT resident_id AS id, household_id AS hh_id, qid, ce_id, mode, {extra},
               upper({blank('first_name', '-9')}) AS first_name, upper({blank('middle_name', '-9')}) AS middle_name,
               upper({blank('last_name', '-9')}) AS last_name,
               upper({blank('resident_first_name', '-9', '-4')}) AS rfn, upper({blank('resident_last_name', '-9', '-4')}) AS rsn,
               substr({dob}, 5, 4) || '-' || substr({dob}, 3, 2) || '-' || substr({dob}, 1, 2) AS iso,
               {age} AS age, {digits(codes('sex', '-9', '-7'))} AS sex,
               {codes('alternative_address', '-9', '-8')} AS address_alt,
               {postcode(codes('alternative_address_postcode', '-9', '-8'))} AS pc_alt,
               {codes('alternative_address_uprn', '-9', '-8')} AS uprn_alt,
               {house_number(codes('alternative_address', '-9', '-8'))} AS house_no_alt,
               {coded('marital_status')} AS marital_status, {coded('ethnic5')} AS ethnic5, {coded('ethnic19')} AS ethnic19,
               {coded('in_full_time_education')} AS fte, {coded('is_hh_term_time_address')} AS term
        FROM raw_{side}_people) p0) p1"""


def _named(side: str) -> str:
    m = "X" if side == "left" else "Y"
    extra = "response_id, pc_1y" if side == "left" else "residence_type, estimate_age"
    parts = ", ".join(
        f"{word(src, 0)} AS {p}1, {word(src, 1)} AS {p}2"
        for p, src in (("fn", "forenames0"), ("sn", "last_name"), ("res_fn", "rfn"), ("res_sn", "rsn"))
    )
    return f"""
  SELECT id, hh_id, qid, ce_id, mode, {extra}, age, sex, address_alt, pc_alt, uprn_alt, house_no_alt,
         marital_status, ethnic5, ethnic19, fte, term,
         nullif(forenames0, '') AS forenames, nullif(last_name, '') AS last_name, nullif(fullname0, '') AS fullname,
         nullif({nospace('forenames0')}, '') AS fn, nullif({nospace('last_name')}, '') AS sn,
         nullif({nospace('rfn')}, '') AS res_fn, nullif({nospace('rsn')}, '') AS res_sn,
         nullif({nospace('fullname0')}, '') AS fullname_ns,
         nullif({alpha(nospace('fullname0'))}, '') AS alphaname, {parts},
         {masked('iso', m)} AS dob, {masked('substr(iso, 1, 4)', m)} AS year,
         {masked('substr(iso, 6, 2)', m)} AS mon, {masked('substr(iso, 9, 2)', m)} AS day
  FROM ({_standard(side)}) p2"""


_CTES = [
    ("left_form", f"""
  SELECT response_id, address, pc, uprn, {house_number('address')} AS house_no, {flat_number('address')} AS flat_no,
         {pc_parts('pc')}
  FROM (SELECT response_id, coalesce({codes('address', '-9', '-8')}, {codes('address_raw', '-9', '-8')} || ',',
               {codes('display_address', '-9', '-8')}) AS address,
               {postcode(codes('address_postcode', '-9', '-8'))} AS pc, {codes('uprn', '-9', '-8')} AS uprn
        FROM (SELECT DISTINCT response_id, display_address, address_raw, address, address_postcode, uprn
              FROM raw_left_forms) q0) q1"""),
    ("left_all", f"""
  SELECT p.*, n.out_name AS fn1_nickname, f.address, f.pc, f.uprn, f.house_no, f.pc_sect, f.pc_dist, f.pc_area, f.pc_substr
  FROM ({_named('left')}) p LEFT JOIN raw_nicknames n ON n.in_name = p.fn1 LEFT JOIN left_form f ON f.response_id = p.response_id"""),
    ("left_students", """
  SELECT id, hh_id, 1 AS student_duplicate, pc, dob FROM left_all WHERE coalesce(fte = 1 AND term IN (2, 3), FALSE)"""),
    ("left_kept", "SELECT * FROM left_all WHERE NOT coalesce(fte = 1 AND term IN (2, 3), FALSE)"),
    ("left_removed", "SELECT id, hh_id, pc, dob FROM left_kept WHERE id IN (SELECT id FROM raw_removals)"),
    ("l", "SELECT * EXCLUDE (fte, term) FROM left_kept WHERE id NOT IN (SELECT id FROM raw_removals)"),
    ("right_form", f"""
  SELECT qid, address, pc, uprn, {house_number('address')} AS house_no, {flat_number('address')} AS flat_no
  FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY address NULLS FIRST, pc NULLS FIRST, uprn NULLS FIRST) AS rn
        FROM (SELECT qid, coalesce({codes('address', '-9', '-8')}, {codes('display_address', '-9', '-8')} || ',') AS address,
                     {postcode(codes('address_postcode', '-9', '-8'))} AS pc, {codes('uprn', '-9', '-8')} AS uprn
              FROM raw_right_forms) q0) q1 WHERE rn = 1"""),
    ("right_moves", f"""
  SELECT hh_id, address_refday, pc_refday, uprn_refday, {house_number('address_refday')} AS house_no_refday
  FROM (SELECT DISTINCT household_id AS hh_id, {codes('refday_address', '-9', '-8')} AS address_refday,
               replace(refday_postcode, ' ', '') AS pc_refday, {codes('refday_uprn', '-9', '-8')} AS uprn_refday
        FROM raw_right_households
        WHERE refday_postcode NOT IN ('-9', '-8') AND coalesce(refday_address, '') <> '-8') m0"""),
    ("right_all", f"""
  SELECT * EXCLUDE (mover), {pc_parts('pc')} FROM (
    SELECT * EXCLUDE (address, pc, uprn, house_no),
           address AS address_intday, pc AS pc_intday, uprn AS uprn_intday, house_no AS house_no_intday,
           CASE WHEN mover THEN address_refday ELSE address END AS address, CASE WHEN mover THEN pc_refday ELSE pc END AS pc,
           CASE WHEN mover THEN uprn_refday ELSE uprn END AS uprn, CASE WHEN mover THEN house_no_refday ELSE house_no END AS house_no
    FROM (
      SELECT p.*, n.out_name AS fn1_nickname, f.address, f.pc, f.uprn, f.house_no, m.address_refday, m.pc_refday, m.uprn_refday,
             m.house_no_refday, m.hh_id IS NOT NULL AND m.pc_refday IS DISTINCT FROM f.pc AS mover, a.laua AS la, a.rgn AS region,
             w.willingness AS htcw
      FROM ({_named('right')}) p LEFT JOIN raw_nicknames n ON n.in_name = p.fn1 LEFT JOIN right_form f ON f.qid = p.qid
           LEFT JOIN right_moves m ON m.hh_id = p.hh_id
           LEFT JOIN raw_areas a ON replace(a.pcd, ' ', '') = f.pc
           LEFT JOIN raw_willingness w ON w.lsoa_code = a.lsoa11) r0) r1"""),
    ("right_students", """
  SELECT id, hh_id, 1 AS student_duplicate, pc_intday, pc_refday, dob FROM right_all
  WHERE coalesce(fte = 1 AND term = 2, FALSE)"""),
    ("r", "SELECT * EXCLUDE (fte, term) FROM right_all WHERE NOT coalesce(fte = 1 AND term = 2, FALSE)"),
]


def _person_sets(side: str, name: str, dob: str, age: int) -> str:
    t = side[0]
    return f"""
  SELECT hh_id, CAST(count(DISTINCT id) AS INT) AS hh_size,
         list_sort(list(DISTINCT coalesce(fn1, '{name}'))) AS fn_set, list_sort(list(DISTINCT coalesce(sn1, '{name}'))) AS sn_set,
         list_sort(coalesce(list(DISTINCT d) FILTER (WHERE d IS NOT NULL), [])) AS dob_set,
         list_sort(list(DISTINCT coalesce(age, {age}))) AS age_set
  FROM (SELECT *, CASE WHEN dob IS NULL THEN DATE '{dob}' ELSE TRY_CAST(dob AS DATE) END AS d FROM {t} WHERE hh_id <> '-9') s0
  GROUP BY hh_id"""


def _set_columns(name: str, dob: str, age: int) -> str:
    return (
        f"coalesce(s.fn_set, ['{name}']) AS fn_set, coalesce(s.sn_set, ['{name}']) AS sn_set, "
        f"coalesce(s.dob_set, [DATE '{dob}']) AS dob_set, coalesce(s.age_set, [{age}]) AS age_set"
    )


_LEFT_DUMMY = ("XXXXX", "1800-08-08", 888)
_RIGHT_DUMMY = ("YYYYY", "1700-07-07", 777)
_PLACES = ("address", "pc", "uprn", "house_no", "flat_no")

_CTES += [
    ("left_sets", _person_sets("left", *_LEFT_DUMMY)),
    ("right_sets", _person_sets("right", *_RIGHT_DUMMY)),
    ("lh", f"""
  SELECT h.qid, h.response_id, h.household_id AS hh_id, TRY_CAST({codes('ownership_type', '-9', '-7')} AS INT) AS tenure,
         TRY_CAST({codes('accommodation_type', '-9', '-7', '-3')} AS INT) AS typaccom,
         TRY_CAST({codes('number_of_residents', '-9', '-5')} AS INT) AS no_resi,
         f.* EXCLUDE (response_id, pc_substr), s.hh_size, {_set_columns(*_LEFT_DUMMY)}
  FROM raw_left_households h LEFT JOIN left_form f ON f.response_id = h.response_id LEFT JOIN left_sets s ON s.hh_id = h.household_id"""),
    ("rh", f"""
  SELECT h2.* EXCLUDE (mover, pc_substr), s.hh_size, {_set_columns(*_RIGHT_DUMMY)} FROM (
    SELECT *, {pc_parts('pc')} FROM (
      SELECT qid, hh_id, CASE WHEN NOT mover THEN tenure END AS tenure, CASE WHEN NOT mover THEN typaccom END AS typaccom, no_resi,
             {', '.join(f'{p}_refday' for p in _PLACES)}, country_refday, {', '.join(f'{p} AS {p}_intday' for p in _PLACES)},
             {', '.join(f'CASE WHEN mover THEN {p}_refday ELSE {p} END AS {p}' for p in _PLACES)}, mover
      FROM (
        SELECT h0.*, {house_number('address_refday')} AS house_no_refday, {flat_number('address_refday')} AS flat_no_refday,
               f.address, f.pc, f.uprn, f.house_no, f.flat_no, moved AND h0.pc_refday IS DISTINCT FROM f.pc AS mover
        FROM (SELECT qid, household_id AS hh_id, TRY_CAST({codes('ownership_type', '-9', '-8', '-7')} AS INT) AS tenure,
                     TRY_CAST({codes('accommodation_type', '-9', '-8', '-7')} AS INT) AS typaccom,
                     TRY_CAST({codes('resident_count', '-9', '-5', '-4')} AS INT) AS no_resi,
                     refday_postcode IS NOT NULL AND refday_postcode NOT IN ('-9', '-8')
                       AND coalesce(refday_address, '') <> '-8' AS moved,
                     {codes('refday_address', '-9', '-8')} AS address_refday,
                     {postcode(codes('refday_postcode', '-9', '-8'))} AS pc_refday,
                     {codes('refday_uprn', '-9', '-8')} AS uprn_refday, {codes('refday_country', '-9', '-8')} AS country_refday
              FROM raw_right_households) h0 LEFT JOIN right_form f ON f.qid = h0.qid) h1) h1b) h2
  LEFT JOIN right_sets s ON s.hh_id = h2.hh_id"""),
]



def with_clause(extra=(), needed: str | None = None) -> str:
    """``WITH`` text of the raw and cleaned tables and ``extra`` CTEs.

    Given the text that follows (``needed``), only the CTEs it builds on are kept.
    """
    all_ctes = [(n, q) for n, q in (*raw_ctes(), *_CTES, *extra)]
    if needed is not None:
        all_ctes = needed_for(needed, all_ctes)
    if not all_ctes:
        return ""
    body = ",\n".join(f"{n} AS {'' if n.endswith('_reach') else 'MATERIALIZED '}({q})" for n, q in all_ctes)
    recursive = "RECURSIVE " if any(n.endswith("_reach") for n, _ in all_ctes) else ""
    return f"WITH {recursive}{body}"
