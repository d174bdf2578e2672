"""Repair of conversations against a walk over the states of the grammar."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from learnertrace.llm import conversations as repair

COLUMNS = "conv_id long, turn long, role string, text string, digest string, `a b` int"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(turns):
    """Least (cost, audit, repaired) of turns (role, text, may stay, truncated), by the last symbol made."""
    def inserted(best):
        for _ in range(3):
            for last, (cost, audit, made) in list(best.items()):
                symbol = NEXT[last]
                new = (cost + 2, audit + "I", made + ({"u": "user", "a": "assistant"}[symbol] + ":",))
                best[symbol] = min(best.get(symbol, new), new)
        return best

    best = inserted({"": (0, "", ())})
    for role, text, may_stay, truncated in turns:
        new = {}
        for last, (cost, audit, made) in best.items():
            found = [(last, (cost + 3, audit + "D", made))]
            if may_stay:
                symbol = NEXT[last]
                if last == "" and role[:1] == "s":
                    found.append(("s", (cost + truncated, audit + "K", made + (f"{role}:{text}",))))
                if role[:1] == symbol:
                    found.append((symbol, (cost + truncated, audit + "K", made + (f"{role}:{text}",))))
                else:
                    whole = {"u": "user", "a": "assistant"}[symbol]
                    found.append((symbol, (cost + truncated + 2, audit + "R", made + (f"{whole}:{text}",))))
            for symbol, value in found:
                new[symbol] = min(new.get(symbol, value), value)
        best = inserted(new)
    return min(best[last] for last in ("", "a") if last in best)


def codes_of(turns):
    initials = {"s": 0, "u": 1, "a": 2}
    return bytes(initials.get(role[:1], 3) | (0 if stays else 4) | (8 if stays and cut else 0)
                 for role, _, stays, cut in turns)


TURNS = st.lists(st.tuples(st.sampled_from(["system", "user", "user", "assistant", "assistant", "tool", ""]),
                           st.just("x"), st.sampled_from([True, True, True, False]), st.booleans()), max_size=14)


@settings(max_examples=1500, deadline=None)
@given(TURNS)
def test_audit_is_the_least(turns):
    cost, audit, _ = cheapest(turns)
    assert repair.cheapest_audit(codes_of(turns)) == (cost, audit)


def test_long_conversations_keep_few_rows(monkeypatch):
    chance = random.Random(3)
    roles = ["user" if k % 2 == 0 else "assistant" for k in range(700)]
    turns = [(role if chance.random() > .1 else chance.choice(["user", "system", "tool"]), "x",
              chance.random() > .05, chance.random() < .05) for role in roles]
    want = cheapest(turns)[:2]
    assert repair.cheapest_audit(codes_of(turns)) == want
    monkeypatch.setattr(repair, "CELLS", 100)
    assert repair.cheapest_audit(codes_of(turns)) == want


def plainly(rows):
    """What the query should give, from (conv_id, turn, role, text)."""
    space = " \t\n\x0b\f\r"
    found, groups = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv]
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        harm = zlib.crc32(key.encode()) % 20
        if harm == 1:
            text = ""
        elif harm == 2:
            text = re.sub("[.!?]", "", text)
        elif harm == 4:
            role = "user"
        groups[conv] += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(
            f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
        seen, judged, faults = set(), [], [0, 0, 0]
        for _, role, text in turns:
            rest = text.rstrip(space)
            blank, again = not rest, (role, text) in seen
            cut = not blank and rest[-1] not in ".!?"
            seen.add((role, text))
            for k, fault in enumerate((blank, again, cut)):
                if fault:
                    faults[k] += 1
                    break
            judged.append((role, text, not blank and not again, cut))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        starts = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))
        cost, audit, made = cheapest(judged)
        found[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return found


def answered(frame):
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (*(r[c] for c in repair.COUNTS), r.audit, r.repaired_sha256) for r in rows}


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert answered(repair.op11_conversation_repair(spark, folder)) == plainly(rows)


ODD = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (1, 2**40, "assistant", "no end"),
       (2, None, "user", "A"), (2, None, "assistant", "B!"), (2, 5, "x", " "), (2, 5, "", ""),
       (None, 1, "user", "Q?"), (None, 2, "assistant", "w " * 200_000 + "."), (3, -4, "system", "S."),
       (3, 7, "ünser", "A.\n"), (4, 1, "system", "only."), *[(5, k, "user", "same?") for k in range(40)],
       *[(6, k % 3, "assistant", f"{k}.") for k in range(30)], *[(k, 0, "user", "x.") for k in range(100, 140)]]


@pytest.fixture
def folder(spark, tmp_path):
    def stored(rows, partitions=3):
        frame = spark.createDataFrame([(*r, "d", 1) for r in rows], COLUMNS).repartition(partitions)
        frame.write.parquet(f"{tmp_path}/conversations.parquet")
        return str(tmp_path)
    return stored


def test_odd_rows(spark, folder):
    got = answered(repair.op11_conversation_repair(spark, folder(ODD)))
    assert got == plainly(ODD)
    # Some of the conversations of one turn have none left.
    assert ((0,) * 6 + ("", hashlib.sha256().hexdigest())) in got.values()


def test_empty_table(spark, folder):
    assert repair.op11_conversation_repair(spark, folder([], 1)).count() == 0


def test_repaired_turns(spark):
    turns = spark.createDataFrame(
        [("c", 1, "system", "S.", "", 0), ("c", 2, "user", "Q?", "", 0), ("c", 3, "user", "R?", "", 0),
         ("c", 3, "user", "R?", "", 0), ("c", 4, "tool", "A.", "", 0), ("d", 1, "user", " ", "", 0)],
        COLUMNS.replace("conv_id long", "conv_id string"))
    judged = repair.audits(turns).collect()
    assert {(r.conv_id, r.cost, r.audit) for r in judged} == {("c", 7, "KKIKDR"), ("d", 3, "D")}
    made = repair.repaired_turns(turns, repair.audits(turns)).orderBy("position").collect()
    assert [(r.edit, r.role, r.text) for r in made] == [
        ("K", "system", "S."), ("K", "user", "Q?"), ("I", "assistant", ""), ("K", "user", "R?"),
        ("R", "assistant", "A.")]
