"""Gates of blocks: they lose no pair, and the join holds them alone."""

import pytest

from fixtures.catalog.registry import people
from pairloom.operators.blocks import hot_blocks
from pairloom.operators.keys import block_keys
from pairloom.operators.pairs import PAIR
from pairloom.plans import person_keys as pk


@pytest.mark.parametrize("block", list(pk.GATES))
def test_gates_lose_no_pair_and_stand_alone_in_the_join(spark, block):
    left, right = (pk.keyed(p, side) for p, side in zip(people(spark, "/root/testdata/sf0.01"), ("left", "right"), strict=True))
    blocks = {block: [pk.BY_NUMBER[n] for n in pk.BLOCKS[block]]}
    hot = hot_blocks(left, right, [block])
    plain, gated = (block_keys(left, right, blocks, PAIR, "mkey", hot, pk.NEAR, gates)[0] for gates in (None, pk.GATES))
    want = sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, gated.collect())) == want and len({r[2] for r in want}) > 1

    def asked_in_joins(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return sum(line.count("house_no_l") for line in plan.splitlines() if "Join Inner" in line)

    assert asked_in_joins(plain) > 0 == asked_in_joins(gated)
