"""Repair of conversations against a search that keeps whole strings, and against every sequence of edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from parcelscope.llm import conversation_repair
from parcelscope.llm.common import ship_package, table
from parcelscope.llm.conversation_repair import BEHIND, Search
from parcelscope.llm.queries import QUERIES, damaged

SF = "/root/testdata/sf0.001"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def plain(rows):
    """(cost, audit, turns) of rows (role, text, fault), the least way into each state kept as whole strings."""
    best = {0: (0, "", ())}

    def with_insertions(best):
        best = dict(best)
        for _ in range(4):
            for state, (cost, audit, turns) in list(best.items()):
                for letter, name in NAMES.items():
                    if letter in NEXT[state]:
                        way = (cost + 3, audit + "I", turns + ((name, ""),))
                        to = NEXT[state][letter]
                        if to not in best or way[:2] < best[to][:2]:
                            best[to] = way
        return best

    for role, text, fault in rows:
        after = {}
        more = 3 if fault == "truncated" else 0
        for state, (cost, audit, turns) in with_insertions(best).items():
            ways = [(state, (cost + 4, audit + "D", turns))]
            if fault in ("", "truncated"):
                if role[:1] in NEXT[state]:
                    ways.append((NEXT[state][role[:1]], (cost + more, audit + "K", turns + ((role, text),))))
                for letter, name in NAMES.items():
                    if letter in NEXT[state]:
                        ways.append((NEXT[state][letter], (cost + 3 + more, audit + "R", turns + ((name, text),))))
            for to, way in ways:
                if to not in after or way[:2] < after[to][:2]:
                    after[to] = way
        best = after
    best = with_insertions(best)
    return min(best[s] for s in (0, 3) if s in best)


def every(rows, insertions=3):
    """The same from all sequences of edits with at most so many insertions."""
    found = []

    def go(k, cost, audit, letters, left):
        if k == len(rows):
            if re.fullmatch("(s?(ua)+)?", letters):
                found.append((cost, audit))
        if left:
            for letter in "ua":
                go(k, cost + 3, audit + "I", letters + letter, left - 1)
        if k < len(rows):
            role, _, fault = rows[k]
            go(k + 1, cost + 4, audit + "D", letters, left)
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                if role[:1] in ("s", "u", "a"):
                    go(k + 1, cost + more, audit + "K", letters + role[:1], left)
                for letter in "ua":
                    go(k + 1, cost + 3 + more, audit + "R", letters + letter, left)

    go(0, 0, "", "", insertions)
    return min(found)


def searched(rows):
    out = []
    search = Search(lambda edit, times, role, text: out.append((edit, times, role, text)))
    for role, text, fault in rows:
        if fault in ("", "truncated"):
            search.row(role, text, bool(fault))
        else:
            search.delete()
    cost = search.end()
    return (cost, "".join(e * n for e, n, _, _ in out), tuple((r, t) for e, _, r, t in out if e != "D")), search


ROLES = (["user", "assistant", "system", "tool", ""], ["user", "assistant"], ["user"], ["assistant", "system"], ["assistant"])


def test_search_equals_whole_strings():
    rng = random.Random(3)
    for n in range(6000):
        roles, faults = rng.choice(ROLES), rng.choice((["", "truncated"], ["", "", "truncated", "blank", "duplicate"], [""]))
        rows = [(rng.choice(roles), f"t{k}", rng.choice(faults)) for k in range(rng.randrange(14))]
        assert searched(rows)[0] == plain(rows), rows


def test_search_equals_every_sequence():
    rng = random.Random(4)
    for roles in itertools.product(["user", "assistant", "system", "x"], repeat=3):
        rows = [(r, "t", rng.choice(["", "", "truncated", "blank"])) for r in roles]
        assert searched(rows)[0][:2] == every(rows), rows
    for n in range(60):
        rows = [(rng.choice(ROLES[0]), "t", rng.choice(["", "truncated", "duplicate"])) for _ in range(4)]
        assert searched(rows)[0][:2] == every(rows), rows


def test_no_survivor_that_is_dropped_could_win():
    """What BEHIND says, against all continuations of up to three rows from each state."""
    least = {}
    for rows in itertools.chain.from_iterable(itertools.product(["user", "assistant", "system", "x"], repeat=n) for n in range(4)):
        for faults in itertools.product(["", "truncated"], repeat=len(rows)):
            costs = []
            for state in range(4):
                search = Search(lambda *_: None)
                search.survivors = {state: (0, 0, search.root)}
                for role, fault in zip(rows, faults):
                    search.row(role, "", bool(fault))
                costs.append(search.end())
            for state, other in BEHIND:
                least[state, other] = max(least.get((state, other), -99), costs[state] - costs[other])
    assert all(least[pair] <= BEHIND[pair] for pair in BEHIND), least


def test_memory_is_what_is_open():
    rng = random.Random(5)
    rows = [(rng.choice(["user", "assistant", "system"]), "x" * 50, rng.choice(["", "", "truncated"])) for _ in range(20_000)]
    assert searched(rows)[1].most_open < 100
    clean = [(("user", "assistant")[k % 2], "x", "") for k in range(20_000)]
    assert searched(clean)[1].most_open < 10
    gone = [("system", "x", "")] + [("user", "x", "duplicate")] * 20_000 + [("user", "x", ""), ("assistant", "x", "")]
    assert searched(gone)[1].most_open < 20
    # Rows of one role tie to the end; all that is open is kept and compared whole.
    tied = [("user", f"t{k}", "") for k in range(301)]
    (cost, audit, turns), search = searched(tied)
    assert search.most_open > 300 and (cost, audit, turns) == plain(tied)


# --- the operator and the query -------------------------------------------------------------


def plain_repair(rows):
    """{conv_id: figures} of rows (conv_id, turn, role, text), damaged already; text None: the row is not there."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv and r[3] is not None), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for turn, role, text in mine:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role, text, fault))
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, kept = plain(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        fault = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if fault == 0:
            out.append((conv, turn, role, None))
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def got(frame):
    return {r[0]: tuple(r[1:]) for r in frame.collect()}


def conversations(seed, n=300):
    rng = random.Random(seed)
    texts = ["A b c.", "Why?", "no end", "", " \t\n", "A b c.", "x!", None, "née.", "end  ", "two\nlines."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            rows.append((rng.choice([conv, conv, conv, None, 7]), rng.choice([turn, turn, turn, None, turn * 3]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)))
    return rows


def test_query_on_odd_rows(spark):
    rows = conversations(6)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    more = frame.withColumn("kept", F.lit(1)).withColumn("said", F.lit("x")).withColumn("fault", F.lit(9))
    expected = plain_repair(plain_damage(rows))
    for source in (frame, more.repartition(7)):
        result = conversation_repair.digests(conversation_repair.repair(damaged(source), kept="there"))
        assert result.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert got(result) == expected
    assert any(v[0] for v in expected.values()) and any("I" in v[6] and "R" in v[6] for v in expected.values())


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    result = got(conversation_repair.digests(conversation_repair.repair(damaged(frame), kept="there")))
    assert result == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert got(conversation_repair.digests(conversation_repair.repair(damaged(frame.limit(0)), kept="there"))) == {}


def test_edits_hold_the_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Bye."), (2, 0, "user", "x" * 3_000_000 + ".")]
    edits = conversation_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    shown = {}
    for r in edits.collect():
        if r.edit is not None:
            shown.setdefault(r.conv_id, []).append((r.edit, r.times, r.role, (r.text or "")[:9]))
    assert shown[1] == [
        ("K", 1, "system", "Be kind."), ("I", 1, "user", ""), ("K", 1, "assistant", "Hello."), ("D", 1, None, ""),
        ("K", 1, "user", "Bye."), ("I", 1, "assistant", ""),
    ]
    assert shown[2] == [("K", 1, "user", "x" * 9), ("I", 1, "assistant", "")]


def test_one_conversation_with_a_third_of_the_rows(spark):
    rows = [(1, k // 3, "user", "Same words.") for k in range(3000)] + [(k, 0, "user", f"Hi {k}.") for k in range(10, 3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    result = got(conversation_repair.digests(conversation_repair.repair(frame)))
    assert result == plain_repair(rows)
    assert result[1][2] == 2999


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_conversation_repair"](spark, SF)) == plain_repair(plain_damage(rows))
