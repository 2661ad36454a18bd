"""DuckDB twins of the person, household and pre-search keys."""

from __future__ import annotations


def _lev(a, b, t):
    return f"(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))) > {t}::DOUBLE"


def _jaro(c, t):
    return f"CAST(jaro_winkler_similarity(l.{c}, r.{c}) AS FLOAT)::DOUBLE > {t}::DOUBLE"


def _eq(*cols):
    return " AND ".join(f"l.{c} = r.{c}" for c in cols)


def soundex(x):
    """Soundex of an A-Z word: H and W are skipped, vowels and Y separate equal codes."""
    digits = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    codes = f"substr({digits}, 1, 1) || replace(substr({digits}, 2), '7', '')"
    for d in "0123456":
        codes = f"regexp_replace({codes}, '{d}{d}+', '{d}', 'g')"
    return f"left({x}, 1) || left(replace(substr({codes}, 2), '0', '') || '000', 3)"


FN = "(l.fn1 = r.fn1 OR l.fn = r.fn)"
SN = "(l.sn1 = r.sn1 OR l.sn = r.sn)"
ADDR = "(l.uprn = r.uprn OR (l.pc = r.pc AND l.house_no = r.house_no))"
NICK = "l.fn1_nickname = r.fn1_nickname"
L60 = f"{_lev('l.fn1', 'r.fn1', 0.6)} AND {_lev('l.sn1', 'r.sn1', 0.6)}"
L80 = f"{_lev('l.fn1', 'r.fn1', 0.8)} AND {_lev('l.sn1', 'r.sn1', 0.8)}"
_WORDS = "list_filter(string_split({0}.fullname, ' '), lambda w: w <> '')"
_LW, _RW = _WORDS.format("l"), _WORDS.format("r")
CONTAINED = (
    f"least(len({_LW}), len({_RW})) > 1 AND len(list_distinct(list_intersect({_LW}, {_RW}))) = least(len({_LW}), len({_RW}))"
)

PERSON = {
    1: _eq("fullname_ns", "dob", "sex", "pc"),
    2: f"{_eq('dob', 'sex', 'uprn')} AND {FN} AND {SN}",
    3: f"{_eq('dob', 'sex', 'pc')} AND {FN} AND {SN}",
    4: _eq("alphaname", "dob", "sex", "pc"),
    5: f"{_eq('fn1_nickname', 'dob', 'sex', 'pc')} AND {SN}",
    6: f"{_eq('fn1_nickname', 'age', 'sex', 'uprn')} AND {SN}",
    7: f"{_eq('dob', 'sex')} AND {ADDR} AND l.fullname IS NOT NULL AND r.fullname IS NOT NULL AND {CONTAINED}",
    8: f"{_eq('dob', 'sex', 'pc')} AND levenshtein(l.fullname_ns, r.fullname_ns) < 3",
    9: f"{_eq('dob', 'sex', 'pc')} AND {soundex('l.fn1')} = {soundex('r.fn1')} AND {soundex('l.sn1')} = {soundex('r.sn1')}",
    10: f"{_eq('dob', 'pc')} AND {FN} AND {SN}",
    11: f"{_eq('dob', 'sex', 'pc')} AND {_jaro('fn1', 0.9)} AND {_jaro('sn1', 0.8)}",
    12: f"{_eq('dob', 'sex', 'pc')} AND {L60}",
    13: f"{_eq('dob', 'sex', 'pc')} AND {_lev('r.fn1', 'l.sn1', 0.6)} AND {_lev('r.sn1', 'l.fn1', 0.6)}",
    14: f"{_eq('fn2', 'dob', 'sex', 'pc')} AND {SN}",
    15: f"{_eq('dob', 'sex', 'pc')} AND {_lev('r.fn1', 'l.fn1', 0.6)} AND {_lev('r.fn2', 'l.fn2', 0.6)}",
    16: f"{_eq('dob', 'sex')} AND (r.fn1 = l.fn2 OR r.fn2 = l.fn1) AND {SN} AND {ADDR}",
    17: f"{_eq('dob', 'sex')} AND {FN} AND {ADDR}",
    18: f"{_eq('dob', 'sex')} AND {_lev('r.fn1', 'l.fn1', 0.6)} AND {SN} AND {ADDR}",
    19: f"{_eq('dob', 'sex')} AND substr(l.fn1, 1, 2) = substr(r.fn1, 1, 2) AND {SN} AND {ADDR}",
    20: f"{_eq('age', 'sex', 'pc')} AND {FN} AND {SN}",
    21: f"{_eq('sex', 'day', 'mon', 'pc')} AND {FN} AND {SN} AND abs(TRY_CAST(l.year AS INT) - TRY_CAST(r.year AS INT)) < 11",
    22: f"{_eq('sex', 'year', 'pc')} AND {FN} AND {SN}",
    23: f"{_eq('sex', 'uprn')} AND levenshtein(l.dob, r.dob) < 2 AND {_jaro('fn1', 0.8)} AND {_jaro('sn1', 0.8)}",
    24: f"{_eq('sex', 'uprn')} AND {L60} AND levenshtein(l.dob, r.dob) < 2",
    25: f"{_eq('sex', 'uprn')} AND {L60} AND abs(l.age - r.age) < 2",
    26: f"{_eq('sex', 'pc', 'house_no')} AND {L60} AND abs(l.age - r.age) < 2",
    27: f"{_eq('dob', 'uprn')} AND {L60} AND (l.sex = r.sex OR l.sex IS NULL OR r.sex IS NULL)",
    28: f"{_eq('dob', 'sex')} AND {FN} AND {SN}",
    29: _eq("fn1", "sn1", "dob", "sex", "pc_substr"),
    30: _eq("fn1", "sn1", "dob", "sex", "pc_sect", "house_no"),
    31: f"{_eq('dob', 'pc_area', 'sex')} AND {FN} AND {SN}",
    32: f"{_eq('pc', 'sex')} AND {L80} AND abs(l.age - r.age) < 6",
    33: f"{_eq('dob', 'sex', 'pc')} AND ((r.res_fn1 = l.fn1 AND r.res_sn1 = l.sn1) OR (l.res_fn1 = r.fn1 AND l.res_sn1 = r.sn1))",
    34: f"{_eq('dob', 'sex')} AND ({NICK} OR {_lev('l.fn1', 'r.fn1', 0.8)}) AND {_lev('l.sn1', 'r.sn1', 0.8)} "
        "AND (r.pc_alt = l.pc OR r.pc = l.pc_alt OR r.pc_alt = l.pc_alt)",
    35: f"{_eq('uprn', 'sex')} AND ({NICK} OR levenshtein(l.fn1, r.fn1) < 2) AND levenshtein(l.sn1, r.sn1) < 2 "
        "AND abs(l.age - r.age) < 2",
}


def person_pairs(n: int) -> str:
    if n != 28:
        return f"SELECT DISTINCT l.id AS id_l, r.id AS id_r FROM l JOIN r ON {PERSON[n]}"
    return f"""
  SELECT id_l, id_r FROM (
    SELECT *, count(*) OVER (PARTITION BY id_l) AS nl, count(*) OVER (PARTITION BY id_r) AS nr FROM (
      SELECT *, count(*) OVER (PARTITION BY pc_l, pc_r, house_no_l, house_no_r) AS n_house,
             count(*) OVER (PARTITION BY uprn_l, uprn_r) AS n_uprn
      FROM (SELECT l.id AS id_l, r.id AS id_r, l.pc AS pc_l, r.pc AS pc_r, l.house_no AS house_no_l, r.house_no AS house_no_r,
                   l.uprn AS uprn_l, r.uprn AS uprn_r FROM l JOIN r ON {PERSON[28]}) m0) m1
    WHERE (pc_l IS NOT NULL AND pc_r IS NOT NULL AND n_house > 1) OR (uprn_l IS NOT NULL AND uprn_r IS NOT NULL AND n_uprn > 1)) m2
  WHERE nl = 1 AND nr = 1"""


def person_links(numbers=range(1, 36)) -> str:
    union = "\nUNION ALL\n".join(f"SELECT id_l, id_r, {n} AS mkey FROM ({person_pairs(n)}) k{n}" for n in numbers)
    return f"SELECT id_l, id_r, min(mkey) AS mkey FROM ({union}) u GROUP BY id_l, id_r"


# ------------------------------------------------------------------------- households
def _common(s):
    return f"len(list_distinct(list_intersect(l.{s}_set, r.{s}_set)))"


def _share(s):
    return f"{_common(s)} >= 1"


def _best(s, score):
    return (
        f"list_max(flatten([[{score} for y in r.{s}_set] for x in l.{s}_set]))"
    )


def _max_lev(s, t):
    return f"CAST({_best(s, '1 - levenshtein(x, y) / greatest(length(x), length(y))')} AS FLOAT)::DOUBLE > {t}::DOUBLE"


def _max_jaro(s, t):
    return f"CAST({_best(s, 'jaro_winkler_similarity(x, y)')} AS FLOAT)::DOUBLE > {t}::DOUBLE"


CF, CS, CD = _share("fn"), _share("sn"), _share("dob")
CA = "len(list_filter(flatten([[abs(x - y) for y in r.age_set] for x in l.age_set]), lambda d: d <= 1)) >= 1"
TTR = _eq("tenure", "typaccom", "no_resi")
TWO = f"(({_eq('tenure', 'typaccom')}) OR ({_eq('tenure', 'no_resi')}) OR ({_eq('no_resi', 'typaccom')}))"
ONE = "l.hh_size = 1 AND r.hh_size = 1"
SIZE = "l.hh_size = r.hh_size"
NOFLAT = "l.flat_no IS NULL AND r.flat_no IS NULL"


def _small(n):
    return f"NOT ({_common('dob')} = 1 AND l.hh_size >= {n} AND r.hh_size >= {n})"


U, P = "l.uprn = r.uprn", "l.pc = r.pc"
LF, LS, JF, JS = (lambda t: _max_lev("fn", t)), (lambda t: _max_lev("sn", t)), (lambda t: _max_jaro("fn", t)), (
    lambda t: _max_jaro("sn", t))

HOUSEHOLD = {
    1: f"{U} AND {CF} AND {CS} AND {CD}",
    2: f"{U} AND {TTR} AND ({CF} OR {CS})",
    3: f"{U} AND {TWO} AND ({CF} OR {CS}) AND {CD}",
    4: f"{U} AND {CS} AND {CD}",
    5: f"{U} AND {LF(.8)} AND {LS(.8)} AND {CD}",
    6: f"{U} AND {JF(.8)} AND {JS(.8)} AND {CD}",
    7: f"{U} AND {TTR} AND {LF(.6)} AND {LS(.6)} AND {CD} AND {_small(4)}",
    8: f"{U} AND {TTR} AND {JF(.6)} AND {JS(.6)} AND {CD} AND {_small(4)}",
    9: f"{U} AND {TTR} AND ({LF(.8)} OR {LS(.8)}) AND {CD}",
    10: f"{U} AND ({LF(.5)} OR {LS(.5)}) AND {TWO} AND l.dob_set = r.dob_set AND {ONE}",
    11: f"{U} AND ({JF(.6)} OR {JS(.6)}) AND {TWO} AND l.dob_set = r.dob_set AND {ONE}",
    12: f"{U} AND ({LF(.8)} OR {LS(.8)}) AND {TWO} AND {ONE}",
    13: f"{U} AND ({JF(.9)} OR {JS(.9)}) AND {TWO} AND {ONE}",
    14: f"{P} AND {CF} AND {CS} AND {CD}",
    15: f"{P} AND {TTR} AND {CF} AND {CS}",
    16: f"{P} AND {TWO} AND ({CF} OR {CS}) AND {CD}",
    17: f"{P} AND {TTR} AND ({LF(.8)} OR {LS(.8)}) AND {CD} AND {_small(3)}",
    18: f"{P} AND {TTR} AND ({JF(.8)} OR {JS(.8)}) AND {CD} AND {_small(3)}",
    19: f"{P} AND l.sn_set = r.sn_set AND l.fn_set = r.fn_set",
    20: f"{P} AND l.house_no = r.house_no AND {TWO} AND {CF} AND {CS} AND {CA}",
    21: f"{U} AND (({CF} AND {CS}) OR ({CF} AND {CD}) OR ({CF} AND {CA}) OR ({CS} AND {CD}) OR ({CS} AND {_share('age')}))",
    22: f"{U} AND {JF(.8)} AND {JS(.8)} AND {SIZE}",
    23: f"l.pc_sect = r.pc_sect AND l.house_no = r.house_no AND {CF} AND {CS} AND {_common('dob')} >= 2 AND {SIZE}",
    24: f"{U} AND l.age_set = r.age_set AND {SIZE}",
    25: f"{P} AND l.flat_no = r.flat_no AND l.house_no = r.house_no AND {SIZE} AND ({CF} OR {CD} OR {CS})",
    26: f"{P} AND l.flat_no = r.flat_no AND {SIZE} AND {CF} AND {CD}",
    27: f"{P} AND l.flat_no = r.flat_no AND {SIZE} AND {CS} AND {CD}",
    28: f"{U} AND {ONE} AND ({CF} OR {CD} OR {CS})",
    29: f"{P} AND l.house_no = r.house_no AND {ONE} AND ({CF} OR {CD} OR {CS})",
    30: f"{U} AND {NOFLAT} AND {CA} AND {JF(.8)} AND {JS(.7)}",
    31: f"{P} AND l.house_no = r.house_no AND {NOFLAT} AND {CA} AND {JF(.8)} AND {JS(.7)}",
}


def household_pairs(n: int) -> str:
    return f"""SELECT DISTINCT l.hh_id AS hh_id_l, r.hh_id AS hh_id_r FROM lh l JOIN rh r ON {HOUSEHOLD[n]}
  WHERE l.hh_size IS NOT NULL AND r.hh_size IS NOT NULL"""


def household_links() -> str:
    union = "\nUNION ALL\n".join(f"SELECT hh_id_l, hh_id_r, {n} AS hkey FROM ({household_pairs(n)}) h{n}" for n in HOUSEHOLD)
    return f"SELECT hh_id_l, hh_id_r, min(hkey) AS hkey FROM ({union}) u GROUP BY hh_id_l, hh_id_r"


# ------------------------------------------------------------------------ pre-search passes
PRESEARCH = {
    1: f"{_eq('dob')} AND {L60}",
    2: f"{_eq('age')} AND {L60}",
    3: f"{_eq('fn1', 'dob')} AND {_lev('l.sn1', 'r.sn1', 0.4)}",
    4: f"{_eq('sn1', 'dob')} AND {_lev('l.fn', 'r.fn', 0.4)}",
    5: _eq("fn1", "sn1"),
    6: _eq("fn2", "sn1"),
    7: _eq("fn1", "fn2"),
    8: _eq("fn1", "dob"),
    9: _eq("fn2", "dob"),
    10: _eq("sn1", "dob"),
    11: _eq("fn1_nickname", "sn1", "age"),
    12: f"l.sn1 = r.sn1 AND r.pc = l.pc_1y AND {_lev('l.fn1', 'r.fn1', 0.6)}",
}


def presearch_pairs(n: int) -> str:
    return f"SELECT DISTINCT l.id AS id_l, r.id AS id_r FROM l JOIN r ON {PRESEARCH[n]}"


#: The columns whose values name a group of namesakes.
NAMESAKES = {5: ("fn1", "sn1"), 6: ("fn2", "sn1"), 7: ("fn1", "fn2")}


def namesake_groups(n: int) -> str:
    first, second = NAMESAKES[n]
    return f"""
  SELECT l.{first} AS name_1, l.{second} AS name_2, count(DISTINCT l.id) AS n_l, count(DISTINCT r.id) AS n_r,
         count(DISTINCT l.id) * count(DISTINCT r.id) AS n_pairs
  FROM l JOIN r ON {PRESEARCH[n]} GROUP BY l.{first}, l.{second}"""


def namesakes(n: int) -> str:
    first, second = NAMESAKES[n]
    sides = [f"""SELECT DISTINCT {s}.{first} AS name_1, {s}.{second} AS name_2, '{side}' AS side, {s}.id AS id
  FROM l JOIN r ON {PRESEARCH[n]}""" for s, side in (("l", "left"), ("r", "right"))]
    return " UNION ALL ".join(sides)
