"""Linking people by ordered keys: the lower the key number, the better the link.

The 35 keys are data; ``operators.keys`` runs them one by one or together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.similarity import contained_name, jaro_above, lev_above, lev_within
from pairloom.operators.blocks import block_join, celled_join, hot_blocks, hot_part, same
from pairloom.operators.columns import SUFFIX, count_by
from pairloom.operators.keys import Key, Route, block_keys, lowest_key, single_key
from pairloom.operators.pairs import PAIR, best_key
from pairloom.session import checkpoint_dir

CARRIED = [
    "id", "fullname_ns", "fullname", "fn", "fn1", "fn1_nickname", "fn2", "sn", "sn1", "res_fn1", "res_sn1",
    "dob", "day", "mon", "year", "age", "sex", "alphaname", "pc", "pc_area", "pc_sect", "uprn", "house_no", "pc_substr",
    "pc_alt",
]


def keyed(people: DataFrame, side: str) -> DataFrame:
    """The columns keys look at, with sound codes, prefixes and initials worked out once per person."""
    s = SUFFIX[side]

    def col(c: str) -> Column:
        return F.col(c + s)

    derived = {
        "fn1_sound": F.soundex(col("fn1")),
        "sn1_sound": F.soundex(col("sn1")),
        "fn1_start": F.left(col("fn1"), F.lit(2)),
        # equal first names (or whole forenames) always have equal initials
        "fn_initial": F.left(F.coalesce(col("fn1"), col("fn")), F.lit(1)),
        "sn_initial": F.left(F.coalesce(col("sn1"), col("sn")), F.lit(1)),
        "year_no": col("year").try_cast("int"),
        **near_births(col, side),
    }
    return people.select(*[c + s for c in CARRIED], *[c.alias(name + s) for name, c in derived.items()])


AGE_BAND = 3


def near_births(col, side: str) -> dict[str, Column]:
    """Signs of when a person was born, as sets: people too far apart for the keys of a block share none.

    ``birth_set`` has a sign in common if ages are at most a year apart or birth dates may be one edit
    apart; ``years_set`` if ages are at most five years apart, or year or day and month agree.
    """
    def sign(kind: str, *parts: Column) -> Column:
        return F.concat(F.lit(kind), *[p.cast("string") for p in parts])

    def ages(years: int, band: int) -> Column:
        def at(shift: int) -> Column:
            return F.floor((col("age") + shift) / band)

        bands = F.array(at(0)) if side == "left" else F.sequence(at(-years), at(years))
        signs = F.transform(F.when(col("age").isNotNull(), bands), lambda b: sign("a", b))
        return F.coalesce(signs, F.array().cast("array<string>"))

    dob, half = col("dob"), F.lit(5)
    # dates that miss characters meet all others
    short, own = F.when(F.length(dob) < 10, sign(f"short {side}")), "right" if side == "left" else "left"
    dates = (sign("s", F.left(dob, half)), sign("e", F.right(dob, half)), short, F.when(dob.isNotNull(), F.lit(f"short {own}")))
    days = (sign("y", col("year")), sign("d", col("day"), F.lit("-"), col("mon")))
    return {
        "birth_set": F.array_distinct(F.concat(ages(1, 1), F.array_compact(F.array(*dates)))),
        "years_set": F.array_distinct(F.concat(ages(5, AGE_BAND), F.array_compact(F.array(*days)))),
    }


def with_places(people: DataFrame, side: str) -> DataFrame:
    """A row per known postcode of a person, main or alternative."""
    s = SUFFIX[side]
    places = F.array(
        F.struct(F.col(f"pc{s}").alias("pc"), F.lit(True).alias("main")),
        F.struct(F.col(f"pc_alt{s}").alias("pc"), F.lit(False).alias("main")),
    )
    kept = F.explode(F.filter(places, lambda p: p["pc"].isNotNull()))
    return people.select("*", kept.alias("_place")).select(
        *people.columns, F.col("_place.pc").alias(f"place{s}"), F.col("_place.main").alias(f"place_main{s}")
    )


# ------------------------------------------------------------------------------ rules
def _l(c: str) -> Column:
    return F.col(c + "_l")


def _r(c: str) -> Column:
    return F.col(c + "_r")


def first_names_agree() -> Column:
    return same("fn1") | same("fn")


def last_names_agree() -> Column:
    return same("sn1") | same("sn")


def alike(column: str, threshold: float) -> Column:
    return lev_above(_r(column), _l(column), threshold)


def sounds_alike(column: str, threshold: float) -> Column:
    return jaro_above(f"{column}_l", f"{column}_r", threshold)


def ages_within(years: int) -> Column:
    return F.abs(_r("age") - _l("age")) <= years


def both_names() -> Column:
    return first_names_agree() & last_names_agree()


def both_alike(threshold: float) -> Column:
    return alike("fn1", threshold) & alike("sn1", threshold)


def agree_or_missing(column: str) -> Column:
    return same(column) | _l(column).isNull() | _r(column).isNull()


def at_one_uprn(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct pairs of people of one uprn whose sexes agree or one of which is missing.

    People meet under a sign of their sex, so those of different sexes don't.  Two people with one uprn and sex each share
    one sign; of others a pair is kept at the least uprn and sign it shares.  So the pairs are never shuffled.
    """
    def at_homes(people: DataFrame, side: str) -> DataFrame:
        s = SUFFIX[side]
        person, uprn, sex, sign = (c + s for c in ("id", "uprn", "sex", "sex_sign"))
        homes = people.dropna(subset=[uprn]).groupBy(person).agg(F.collect_set(F.struct(uprn, sex)).alias("homes"))
        rows = homes.select(person, (F.size("homes") == 1).alias(f"lone{s}"), F.explode("homes").alias("home")).select("*", "home.*")
        own, both = F.concat(F.lit("is "), F.col(sex).cast("string")), F.lit("unknown l")
        known, unknown = {
            "left": (F.array(own, F.lit("unknown r")), F.array(both)),
            "right": (F.array(own, both), F.array(F.lit("unknown r"), both)),
        }[side]
        signed = rows.select("*", F.explode(F.when(F.col(sex).isNull(), unknown).otherwise(known)).alias(sign))
        # a sign stands once for a person and uprn, whatever the sexes behind it
        once = signed.groupBy(person, f"lone{s}", uprn, sign).agg(F.min(sex).alias(sex))
        all_of_one = once.groupBy(person, f"lone{s}").agg(
            F.collect_list(F.struct(F.col(uprn).alias("uprn"), F.col(sign).alias("sign"))).alias(f"signs{s}"), F.collect_list(F.struct(uprn, sign, sex)).alias("rows")
        )
        return all_of_one.select(person, f"lone{s}", f"signs{s}", F.explode("rows").alias("row")).select(person, f"lone{s}", f"signs{s}", "row.*")

    least = F.array_min(F.array_intersect("signs_l", "signs_r"))
    kept = (F.col("lone_l") & F.col("lone_r")) | ((least["uprn"] == F.col("uprn_l")) & (least["sign"] == F.col("sex_sign_l")))
    sides = at_homes(left, "left"), at_homes(right, "right")
    return celled_join(*sides, ("uprn", "sex_sign"), agree_or_missing("sex") & kept).select(*PAIR)


def names_swapped() -> Column:
    return lev_above(_r("fn1"), _l("sn1"), 0.60) & lev_above(_r("sn1"), _l("fn1"), 0.60)


def forenames_crossed() -> Column:
    return (_r("fn1") == _l("fn2")) | (_r("fn2") == _l("fn1"))


def respondent_names() -> Column:
    right_answered = (_r("res_fn1") == _l("fn1")) & (_r("res_sn1") == _l("sn1"))
    left_answered = (_l("res_fn1") == _r("fn1")) & (_l("res_sn1") == _r("sn1"))
    return right_answered | left_answered


def dates_one_edit_apart() -> Column:
    """Birth dates at most one edit apart.

    One edit leaves the first or the last five of ten characters alone, which
    settles most pairs without computing a distance.
    """
    left, right = _l("dob"), _r("dob")
    half = F.lit(5)
    possible = (
        (F.left(left, half) == F.left(right, half))
        | (F.right(left, half) == F.right(right, half))
        | (F.least(F.length(left), F.length(right)) < 10)
    )
    return possible & lev_within(right, left, 1)


ADDRESS = (("dob", "sex", "uprn"), ("dob", "sex", "pc", "house_no"))

# Routes, rules and thresholds of the keys.
KEYS: tuple[Key, ...] = (
    Key(1, (("fullname_ns", "dob", "sex", "pc"),)),
    Key(2, (("dob", "sex", "uprn"),), both_names),
    Key(3, (("dob", "sex", "pc"),), both_names),
    Key(4, (("alphaname", "dob", "sex", "pc"),)),
    Key(5, (("fn1_nickname", "dob", "sex", "pc"),), last_names_agree),
    Key(6, (("fn1_nickname", "age", "sex", "uprn"),), last_names_agree),
    Key(7, ADDRESS, lambda: contained_name(_r("fullname"), _l("fullname")) == 1),
    Key(8, (("dob", "sex", "pc"),), lambda: lev_within(_r("fullname_ns"), _l("fullname_ns"), 2)),
    Key(9, (("fn1_sound", "sn1_sound", "dob", "sex", "pc"),)),
    Key(10, (("dob", "pc"),), both_names),
    Key(11, (("dob", "sex", "pc"),), lambda: sounds_alike("fn1", 0.90) & sounds_alike("sn1", 0.80)),
    Key(12, (("dob", "sex", "pc"),), lambda: both_alike(0.60)),
    Key(13, (("dob", "sex", "pc"),), names_swapped),
    Key(14, (("fn2", "dob", "sex", "pc"),), last_names_agree),
    Key(15, (("dob", "sex", "pc"),), lambda: alike("fn1", 0.60) & alike("fn2", 0.60)),
    Key(16, ADDRESS, lambda: forenames_crossed() & last_names_agree()),
    Key(17, ADDRESS, first_names_agree),
    Key(18, ADDRESS, lambda: last_names_agree() & alike("fn1", 0.60)),
    Key(19, tuple(("fn1_start", *route) for route in ADDRESS), last_names_agree),
    Key(20, (("age", "sex", "pc"),), both_names),
    Key(21, (("sex", "day", "mon", "pc"),), lambda: both_names() & (F.abs(_r("year_no") - _l("year_no")) <= 10)),
    Key(22, (("sex", "year", "pc"),), both_names),
    Key(23, (("sex", "uprn", "birth_member"),), lambda: dates_one_edit_apart() & sounds_alike("fn1", 0.80) & sounds_alike("sn1", 0.80)),
    Key(24, (("sex", "uprn", "birth_member"),), lambda: dates_one_edit_apart() & both_alike(0.60)),
    Key(25, (("sex", "uprn", "birth_member"),), lambda: ages_within(1) & both_alike(0.60)),
    Key(26, (("sex", "pc", "house_no", "years_member"),), lambda: ages_within(1) & both_alike(0.60)),
    Key(27, (("dob", "uprn"),), lambda: agree_or_missing("sex") & both_alike(0.60)),
    Key(28, (("dob", "sex", "fn_initial", "sn_initial"),), both_names),
    Key(29, (("fn1", "sn1", "dob", "sex", "pc_substr"),)),
    Key(30, (("fn1", "sn1", "dob", "sex", "pc_sect", "house_no"),)),
    Key(31, (("dob", "pc_area", "sex", "fn_initial", "sn_initial"),), both_names),
    Key(32, (("pc", "sex", "years_member"),), lambda: ages_within(5) & both_alike(0.80)),
    Key(33, (("dob", "sex", "pc"),), respondent_names),
    Key(34, (("dob", "sex", "place"),), lambda: ~(_l("place_main") & _r("place_main"))
        & (same("fn1_nickname") | alike("fn1", 0.80)) & alike("sn1", 0.80)),
    Key(35, (("uprn", "sex", "birth_member"),), lambda: ages_within(1)
        & (same("fn1_nickname") | lev_within(_r("fn1"), _l("fn1"), 1)) & lev_within(_r("sn1"), _l("sn1"), 1)),
)
BY_NUMBER = {k.number: k for k in KEYS}
MOVES_KEY = 28
ALT_KEY = 34
ALT_BLOCK = ("dob", "sex", "place")

# Blocks of the joint run.  A route is met in a block whose columns it contains.
BLOCKS: dict[Route, tuple[int, ...]] = {
    ("pc", "dob"): (1, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 33),
    ("uprn", "dob"): (2, 7, 16, 17, 18, 19, 27),
    ("pc", "sex", "years_member"): (20, 21, 22, 26, 32),
    ("uprn", "sex", "birth_member"): (6, 23, 24, 25, 35),
}


def _names_near() -> Column:
    """What the keys of the block of ages ask of the names, at the least: equal, or alike by more than 0.60."""
    return (first_names_agree() | alike("fn1", 0.60)) & (last_names_agree() | alike("sn1", 0.60))


#: Short conditions that all keys of a block imply.
GATES = {("pc", "sex", "years_member"): _names_near}
#: The keys of a block with such signs imply that one is shared.
NEAR = frozenset({"years_member", "birth_member"})
# Equal names imply equal initials: this block serves the keys that ask for equal names wherever a person lives.
NAMES_BLOCK = ("dob", "sex", "fn_initial", "sn_initial")
NAMES_KEYS = (29, 30, 31)
INITIALS = frozenset({"fn_initial", "sn_initial"})


# ------------------------------------------------------------------------------- one key
def key_pairs(left: DataFrame, right: DataFrame, number: int) -> DataFrame:
    """Distinct pairs that one key links.  ``left`` and ``right`` are cleaned people."""
    key = BY_NUMBER[number]
    left, right = keyed(left, "left"), keyed(right, "right")
    if number == MOVES_KEY:
        return moved_together(celled_join(left, right, key.routes[0], key.rule()))
    if "place" in key.routes[0]:
        left, right = with_places(left, "left"), with_places(right, "right")
    return single_key(left, right, key, PAIR)


HOUSE_MOVE = ["pc_l", "pc_r", "house_no_l", "house_no_r"]
UPRN_MOVE = ["uprn_l", "uprn_r"]


def moved_together(pairs: DataFrame) -> DataFrame:
    """Pairs whose two addresses are shared by another pair, each person met once only.

    Counts are aggregates joined back: an address pair shared by very many pairs
    is counted where its rows are, not gathered in one task.  A pair met twice
    (two nicknames) counts twice, so it is not unique for either person.
    """
    narrow = pairs.select(*PAIR, *HOUSE_MOVE, *UPRN_MOVE)

    def repeated(columns: list[str], known: list[str], flag: str) -> DataFrame:
        moves = count_by(narrow.dropna(subset=known), *columns).filter("n > 1")
        return moves.select(*[F.col(c).alias(f"{flag}_{c}") for c in columns], F.lit(True).alias(flag))

    def matching(columns: list[str], flag: str) -> Column:
        # a missing house number is a value here: two such moves count as alike
        return reduce(lambda a, b: a & b, [F.equal_null(F.col(c), F.col(f"{flag}_{c}")) for c in columns])

    flagged = narrow.join(repeated(HOUSE_MOVE, ["pc_l", "pc_r"], "house"), matching(HOUSE_MOVE, "house"), "left")
    flagged = flagged.join(repeated(UPRN_MOVE, UPRN_MOVE, "address"), matching(UPRN_MOVE, "address"), "left")
    met = flagged.filter(F.col("house") | F.col("address")).select(*PAIR)
    once_left = met.groupBy("id_l").agg(F.count(F.lit(1)).alias("n"), F.min("id_r").alias("id_r")).filter("n = 1")
    once_right = met.groupBy("id_r").agg(F.count(F.lit(1)).alias("n"), F.min("id_l").alias("id_l")).filter("n = 1")
    return once_left.select(*PAIR).join(once_right.select(*PAIR), PAIR, "inner")


# ------------------------------------------------------------------------------ all keys
def link_people(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(id_l, id_r, mkey)``: every pair any key links, with its lowest key."""
    left, right = keyed(left, "left"), keyed(right, "right")
    blocks = {block: [BY_NUMBER[n] for n in numbers] for block, numbers in BLOCKS.items()}
    hot = hot_blocks(left, right, [*blocks, NAMES_BLOCK])
    linked = block_keys(left, right, blocks, PAIR, "mkey", hot, NEAR, GATES)

    left_places, right_places = with_places(left, "left"), with_places(right, "right")
    hot_places = hot_blocks(left_places, right_places, [ALT_BLOCK])
    linked += block_keys(left_places, right_places, {ALT_BLOCK: [BY_NUMBER[ALT_KEY]]}, PAIR, "mkey", hot_places)

    # people of equal names, sex and birth date serve four keys, one of which looks at them as a whole
    checkpoint_dir(left.sparkSession)
    lowest, any_key = lowest_key(NAMES_BLOCK, [BY_NUMBER[n] for n in NAMES_KEYS], INITIALS)
    met = block_join(left, right, NAMES_BLOCK, both_names(), hot_part(hot, len(blocks)))
    namesakes = met.select(*PAIR, *HOUSE_MOVE, *UPRN_MOVE, F.when(any_key, lowest).alias("mkey")).checkpoint()
    linked.append(namesakes.filter("mkey IS NOT NULL").select(*PAIR, "mkey"))
    linked.append(moved_together(namesakes).select(*PAIR, F.lit(MOVES_KEY).alias("mkey")))
    return best_key(reduce(DataFrame.unionByName, linked))


def key_counts(links: DataFrame) -> DataFrame:
    """Pairs per key."""
    return count_by(links, "mkey")
