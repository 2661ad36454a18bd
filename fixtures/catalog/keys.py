"""K01-K35, H01-H31, X01-X12 and their joint runs."""

from __future__ import annotations

from fixtures import key_sql as ks
from fixtures.catalog.registry import households, people, query
from pairloom.plans import household_keys as hk, person_keys as pk, presearch as ps

for _n in pk.BY_NUMBER:
    query(f"k{_n:02d}_person_key", ks.person_pairs(_n))(
        lambda spark, sf, n=_n: pk.key_pairs(*people(spark, sf), n)
    )

for _n in hk.BY_NUMBER:
    query(f"h{_n:02d}_household_key", ks.household_pairs(_n))(
        lambda spark, sf, n=_n: hk.household_key_pairs(*households(spark, sf), n)
    )

for _n in ps.BY_NUMBER:
    query(f"x{_n:02d}_presearch", ks.presearch_pairs(_n))(
        lambda spark, sf, n=_n: ps.presearch_pairs(*people(spark, sf), n)
    )

for _n in ps.NAMESAKE_PASSES:
    query(f"x{_n:02d}_namesakes", ks.namesakes(_n))(
        lambda spark, sf, n=_n: ps.namesakes(*people(spark, sf), n)
    )
    query(f"x{_n:02d}_namesake_groups", ks.namesake_groups(_n))(
        lambda spark, sf, n=_n: ps.namesake_groups(ps.namesakes(*people(spark, sf), n))
    )


@query("k_all_min_key", "SELECT id_l, id_r, mkey FROM links")
def k_all(spark, sf):
    return pk.link_people(*people(spark, sf))


@query("h_all_min_key", "SELECT hh_id_l, hh_id_r, hkey FROM household_links")
def h_all(spark, sf):
    return hk.link_households(*households(spark, sf))


@query(
    "x_all_first_pass",
    "SELECT id_l, id_r, min(search_pass) AS search_pass FROM ("
    + " UNION ALL ".join(f"SELECT id_l, id_r, {n} AS search_pass FROM ({ks.presearch_pairs(n)}) x{n}" for n in ks.PRESEARCH)
    + ") u GROUP BY id_l, id_r",
)
def x_all(spark, sf):
    return ps.presearch(*people(spark, sf))
