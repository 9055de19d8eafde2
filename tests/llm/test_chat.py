import random

import pytest
from shoalcast.llm import chat

ROLES = ["user", "assistant", "system", "Human", "tool", None]
SKEWED = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def conversations(spark):
    rnd = random.Random(8)
    rows = [(1, t, rnd.choice(ROLES), rnd.choice(["a", "b", "", None])) for t in range(-300, 900)]
    rows += [(2, 7, rnd.choice(ROLES), f"x{i}") for i in range(600)] + [(2, 3, "user", "first"), (2, 400, "system", "last")]
    rows += [(c, t, rnd.choice(ROLES), f"{c} {t}") for c in range(10, 60) for t in range(rnd.randrange(1, 5))]
    rows += [(3, t * 10**5, rnd.choice(ROLES), "far") for t in range(-40, 40)] + [(3, 10**9, "user", "end"), (3, None, "user", "none")]
    rows += [(None, 1, None, None), (None, 1, None, None)]
    return set(rows), spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def turns(df):
    rows = [tuple(r) for r in df.select("conv_id", "block", "part", "place", "turn", "role", "final_role", "action", "inserted", "rendered").collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:4]))


def whole_way(rows):
    """(role, final_role, action, inserted) of each turn of one conversation, found over all its turns at once."""
    numbers = {"user": 2, "assistant": 3, "system": 1, "Human": 2}
    coded = [(numbers.get(r[5], 0), r[-1]) for r in rows]
    best = {s: chat.cheapest(coded, 0, s) if reachable(coded, s) else None for s in range(1, 4)}
    cost = {s: total(coded, way) + chat.ENDS[s] for s, way in best.items() if way}
    return min(cost.values())


def reachable(coded, end):
    state = {0}
    for turn in coded:
        state = {after for s in state for _, after, _, _ in chat.choices(s, *turn)}
    return end in state


def total(coded, way):
    spent, state = 0.0, 0
    for turn, (after, action, inserted) in zip(coded, way):
        spent += min(c for c, a, act, ins in chat.choices(state, *turn) if (a, act, ins) == (after, action, inserted))
        state = after
    return spent


def test_blocks_and_levels_give_the_cheapest_way(conversations, spark, monkeypatch):
    rows, frame = conversations
    plain = turns(chat.format_chat(frame))
    assert len(plain) == len(rows)
    texts = {(c, t, r, x) for c, t, r, x in rows}
    for fan, block in ((3, 8), (8, 64)):
        monkeypatch.setattr(chat, "FAN", fan)
        monkeypatch.setattr(chat, "BUNDLE_ROWS", 50)
        cut = turns(chat.format_chat(frame, block))
        assert len(cut) == len(rows)
        for conv in (1, 3):
            # Same turns in the same order, and as cheap as over the whole conversation.
            mine = [r for r in cut if r[0] == conv]
            assert [r[4:6] for r in mine] == [r[4:6] for r in plain if r[0] == conv]
            empty = {(t, r): not (x or "").strip() for c, t, r, x in texts if c == conv}
            coded = [(*r, empty[r[4], r[5]]) for r in mine]
            names = {name: i for i, name in enumerate(chat.ROLES)}
            way = [(names[r[6]], r[7], names[r[8]] if r[8] else 0) for r in mine]
            numbers = {"user": 2, "assistant": 3, "system": 1, "Human": 2}
            spent = total([(numbers.get(r[5], 0), r[-1]) for r in coded], way) + chat.ENDS[way[-1][0]]
            assert spent == whole_way(coded)


def test_split_partitions_do_not_split_blocks(conversations, spark):
    _, frame = conversations
    plain = turns(chat.format_chat(frame))
    before = {k: spark.conf.get(k) for k in SKEWED}
    try:
        for key, value in SKEWED.items():
            spark.conf.set(key, value)
        assert turns(chat.format_chat(frame)) == plain
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len({r[:4] for r in plain}) == len(plain)
