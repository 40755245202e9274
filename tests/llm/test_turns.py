"""Conversation repair against all edits of short conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from quillspark.llm import queries, turns

SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    """Faults of (role, text) rows, in order."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(SPACE)
        out.append(turns.BLANK if not body else turns.DUPLICATE if (role, text) in seen else turns.CUT_SHORT if body[-1] not in ".!?" else turns.SOUND)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired) by trying every edit of every row and up to three insertions at every place."""
    best = None
    limit = 2 * len(rows)  # all deleted

    def go(i, roles, cost, audit, said):
        nonlocal best
        if cost > limit or (best is not None and cost > best[0]):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, said)
        if roles.endswith("III"):
            return
        for r in ("user", "assistant"):
            if re.fullmatch("s?(ua)*u?", roles + r[0]):
                go(i, roles + r[0], cost + 5, audit + "I", [*said, f"{r}:"])
        if i == len(rows):
            return
        (role, text), fault = rows[i], faults[i]
        go(i + 1, roles, cost + 2, audit + "D", said)
        if fault in (turns.BLANK, turns.DUPLICATE):
            return
        more = 5 * (fault == turns.CUT_SHORT)
        if role and re.fullmatch("s?(ua)*u?", roles + role[0]):
            go(i + 1, roles + role[0], cost + more, audit + "K", [*said, f"{role}:{text}"])
        for r in ("user", "assistant"):
            if re.fullmatch("s?(ua)*u?", roles + r[0]):
                go(i + 1, roles + r[0], cost + 1 + more, audit + "R", [*said, f"{r}:{text}"])

    go(0, "", 0, "", [])
    return best


def damage(rows):
    """Rows (conv_id, turn, role, text) as the contract damages them, by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        slot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = out.setdefault(conv, [])
        if slot == 0:
            continue
        text = "" if slot == 1 else re.sub("[.!?]", "", text) if slot == 2 else text
        own += [(turn, "user" if slot == 4 else role, text)] * (2 if slot == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def plain(rows):
    out = []
    for conv, own in damage(rows).items():
        said = [(r, t) for _, r, t in own]
        faults = faults_of(said)
        cost, audit, repaired = cheapest(said, faults)
        numbers = {t for t, *_ in own if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        out.append((conv, gaps, *(faults.count(f) for f in (turns.BLANK, turns.DUPLICATE, turns.CUT_SHORT)), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def test_parse_is_the_cheapest_edit():
    rng = random.Random(3)
    cases = [list(c) for n in range(4) for c in itertools.product([("system", "s."), ("user", "u."), ("assistant", "a.")], repeat=n)]
    cases += [[(rng.choice(["system", "user", "assistant", "tool", "", "User"]), rng.choice(["x.", "y!", "z?", "cut", " ", "end. \n"]) + rng.choice(["", "", " w."])) for _ in range(rng.randrange(8))] for _ in range(400)]
    for rows in cases:
        faults = faults_of(rows)
        want = cheapest(rows, faults)
        assert turns.parse([(r[:1], f) for (r, _), f in zip(rows, faults, strict=True)]) == want[:2], rows
        own = turns.Repair(settle=2)
        for i, ((role, text), f) in enumerate(zip(rows, faults, strict=True)):
            own.add(i, role, text, f)
        assert own.done()[5:] == (*want[:2], hashlib.sha256("\n".join(want[2]).encode()).hexdigest()), rows


def test_long_conversations_are_forgotten_as_they_settle():
    rng = random.Random(4)
    rows = [(rng.choice(["user", "assistant", "assistant", "user", "system"]), rng.choice(["x.", "cut"]), rng.choice([0, 0, 0, 3, 2, 1])) for _ in range(20_000)]
    own, at_once, held = turns.Repair(settle=16), turns.Repair(settle=10**9), 0
    for i, row in enumerate(rows):
        own.add(i, *row)
        at_once.add(i, *row)
        held = max(held, len(own.held))
    assert held < 100 and own.done() == at_once.done()


def test_odd_rows(spark):
    rows = [(c, t, r, x) for c in range(60) for t, r, x in ((0, "system", "s."), (1, "user", "q?"), (2, "assistant", "a."), (3, "assistant", "b"), (5, None, None), (None, "user", "u u."), (5, "tool", "x!"))]
    rows += [(None, t, "user", f"n{t}.") for t in (None, None, 2, 9)] + [(1000 + c, 0, "user", "") for c in range(40)] + [(2000 + c, None, "assistant", "z.") for c in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({c: queries.F.lit(c) for c in ("gone", "slot", "fault", "digest", "copy", "again")})
    assert sorted((tuple(r) for r in turns.repaired(df).collect()), key=str) == plain(rows)
    assert turns.repaired(df.limit(0)).collect() == []
    assert {r["cost"] for r in turns.repaired(df.where("conv_id < 3 and turn in (1, 2)"), damage=False).collect()} == {0}


def test_no_rows_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = turns.repaired(spark.createDataFrame([(gone, 0, "user", "x.")], "conv_id long, turn long, role string, text string")).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("name", ["op11_conversation_repair"])
def test_query_against_all_edits(spark, sf_dir, name):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES[name](spark, sf_dir).collect()), key=str) == plain(rows)
