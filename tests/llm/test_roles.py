"""Role repair against a search over all repairs, and conversations that fill many partitions."""

import itertools
import random

import pytest

from cohortspark.llm.load import QUERIES
from cohortspark.llm.roles import ASSISTANT, NEXT, START, SYSTEM, USER, Automaton, Costs, repair, role_state

FOLDER = "/root/testdata/sf0.01"


def cheapest(roles, costs):
    """Over all labels, merges and up to three insertions before each turn."""
    a = Automaton(costs)
    best = {START: 0}
    for role in roles:
        own, after = role_state(role), {}
        for s, c in best.items():
            if s != START:
                price = costs.merge if own in (s, None) else costs.merge_other
                after[s] = min(after.get(s, 10**9), c + price)
            for n in range(4):
                for put in itertools.product((SYSTEM, USER, ASSISTANT), repeat=n):
                    state, legal = s, True
                    for t in put:
                        legal &= t in NEXT[state]
                        state = t
                    for t in NEXT[state] if legal else ():
                        price = n * costs.insert + (0 if own == t else costs.relabel_unknown if own is None else costs.relabel)
                        after[t] = min(after.get(t, 10**9), c + price)
        best = after
    return min(c + a.end[s] for s, c in best.items())


def check(rows, costs):
    """Legal, at the stated cost, and that is the cheapest."""
    state, total = START, 0
    for r in rows:
        own = role_state(r.role)
        for t in r.inserted:
            t = role_state(t)
            assert t in NEXT[state]
            state, total = t, total + costs.insert
        t = role_state(r.new_role)
        if r.action == "merge":
            assert t == state != START
            total += costs.merge if own in (state, None) else costs.merge_other
        else:
            assert t in NEXT[state] and (r.action == "keep") == (own == t)
            total += 0 if own == t else costs.relabel_unknown if own is None else costs.relabel
            state = t
    total += costs.end.get(rows[-1].new_role, 0)
    assert total == rows[0].cost == cheapest([r.role for r in rows], costs)


def by_conversation(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.part, r.at)):
        out.setdefault(r.conv, []).append(r)
    return out


COSTS = Costs(end={"user": 2, "system": 4})


@pytest.mark.parametrize("costs", [COSTS, Costs(relabel=1, merge=5, merge_other=9, insert=2), Costs(relabel=9, merge_other=9, insert=1)])
def test_cheapest_repairs(spark, costs):
    rng = random.Random(6)
    names = ["user", "assistant", "system", "Human", "tool", None, ""]
    rows = [(c, i, rng.choice(names), f"t{i}") for c in range(60) for i in range(rng.randrange(1, 7))]
    rows += [(99, i, rng.choice(names), f"long {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = by_conversation(repair(df, costs=costs, partitions=7))
    assert sum(map(len, found.values())) == len(rows)
    assert len({r.part for r in found["99"]}) > 1  # one conversation over several partitions
    for conv, some in found.items():
        assert [r.turn for r in some] == sorted(r.turn for r in some)
        check(some, costs)


def test_rendering(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "A"), (1, 2, "user", "B"), (1, 3, "assistant", "C"), (2, 0, "assistant", "D")]
    found = by_conversation(repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), costs=Costs(insert=3)))
    text = {c: "".join(r.rendered for r in some) for c, some in found.items()}
    assert text["1"] == "<|system|>\nS<|end|>\n<|user|>\nA\nB<|end|>\n<|assistant|>\nC<|end|>\n"
    assert text["2"] == "<|user|>\n<|end|>\n<|assistant|>\nD<|end|>\n"


def test_defined_cases(spark):
    rows = [(None, 0, "user", "x"), (1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", "n"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (2, 0, None, ""), (3, 0, "user", "y" * 300_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, part string")
    found = by_conversation(repair(df, costs=COSTS))
    assert {c: len(v) for c, v in found.items()} == {None: 1, "1": 4, "2": 1, "3": 1}
    assert [(r.turn, r.text) for r in found["1"]] == [(None, "n"), (0, None), (1, "a"), (1, "b")]
    for some in found.values():
        check(some, COSTS)
    assert repair(df.limit(0)).count() == 0


def test_query(spark):
    rows = QUERIES["op9_roles"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/conversations.parquet").distinct().count()
