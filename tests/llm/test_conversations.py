"""Conversation repair: every edit sequence tried, long ones by dynamic programming."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from slantwise.llm import lattice
from slantwise.llm.conversations import damage, repair_conversations

GOOD = re.compile("(s?(ua)+)?")


def tried(codes, inserts=3):
    """Least (cost, audit) over all edit sequences with up to ``inserts`` inserts."""
    best = []

    def go(k, cost, audit, roles, left):
        if best and cost > best[0][0]:
            return
        if k == len(codes) and GOOD.fullmatch(roles):
            best[:] = [min([*best, (cost, audit)])]
        if left:
            for role in "ua":
                go(k, cost + 5, audit + "I", roles + role, left - 1)
        if k < len(codes):
            code, late = codes[k], 5 * codes[k].isupper()
            go(k + 1, cost + 2, audit + "D", roles, left)
            if code != "x":
                go(k + 1, cost + late, audit + "K", roles + code.lower(), left)
                for role in "ua":
                    go(k + 1, cost + late + 1, audit + "R", roles + role, left)

    go(0, 0, "", "", inserts)
    return best[0]


def planned(codes):
    """Least (cost, audit) by dynamic programming from the back; two inserts in a row at most."""

    def due(last):
        return "a" if last == "u" else "u"

    def after(step, tail):
        return (step[0] + tail[0], step[1] + tail[1])

    rest = {}
    for k in range(len(codes), -1, -1):
        read = {last: [(0, "")] if k == len(codes) and last in ("", "a") else [] for last in ("", "s", "u", "a")}
        for last in read if k < len(codes) else ():
            code, late = codes[k], 5 * codes[k].isupper()
            read[last].append(after((2, "D"), rest[last]))
            if code != "x":
                read[last].append(after((late + 1, "R"), rest[due(last)]))
                if code.lower() == due(last) or (code.lower() == "s" and last == ""):
                    read[last].append(after((late, "K"), rest[code.lower()]))
        once = {last: read[last] + [after((5, "I"), x) for x in read[due(last)]] for last in read}
        rest = {last: min(once[last] + [after((10, "II"), x) for x in read[due(due(last))]]) for last in read}
    return rest[""]


def test_searches_agree_with_all_sequences():
    rng = random.Random(1)
    for n in range(6):
        for _ in range(60 if n > 3 else 150):
            codes = "".join(rng.choice("suaoxSUA") for _ in range(n))
            assert lattice.cheapest(codes, lattice.EMPTY, lattice.ENDS) == tried(codes) == planned(codes), codes


@pytest.mark.parametrize("block", [1, 3, 7])
def test_chained_blocks_say_the_same(block):
    rng = random.Random(block)
    for _ in range(25):
        codes = "".join(rng.choice("suaoxSUAuaua") for _ in range(rng.randint(block + 1, 60)))
        tables = [lattice.block_table(codes[k : k + block], False) for k in range(0, len(codes), block)]
        half = len(tables) // 2
        joined = [lattice.chain(tables[:half], False), lattice.chain(tables[half:], False)] if half else tables
        (way,) = lattice.chain(joined, True)
        assert (way["cost"], way["audit"]) == lattice.cheapest(codes, lattice.EMPTY, lattice.ENDS) == planned(codes), codes


def brute(turns, originals):
    """Expected rows from damaged turns ``(conv, turn, role, text)``."""
    convs = defaultdict(list)
    for conv, turn, role, text in turns:
        convs[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = Counter()
    for conv in originals:
        rows = sorted(convs[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, codes, seen = Counter(), "", set()
        for turn, role, text in rows:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults[fault] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if fault in ("blank", "duplicate") else code.upper() if fault else code
        heads = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        known = [t for t, *_ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit = planned(codes) if len(codes) < 200 else lattice.cheapest(codes, 0, lattice.ENDS)
        left, lines, k = len(audit) - audit.count("D"), [], 0
        kept = 0
        for letter in audit:
            if letter != "D":
                due = ("ua" if left % 2 == 0 else "au")[kept % 2]
                name = {"u": "user", "a": "assistant"}[due]
                lines.append(f"{name}:" if letter == "I" else f"{rows[k][1] if letter == 'K' else name}:{rows[k][2]}")
                kept += 1
            k += letter != "I"
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha] += 1
    return out


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def odd_turns():
    rng = random.Random(7)
    says = ["Yes.", "No!", "Why?", "cut of", "", " \t", None, "é.\n", "long " * 5000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "usher", "tool", "", None]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(says)))
    rows += [(None, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(4)]
    rows += [(77, k, ("user", "assistant", "system")[k % 3], f"t{k % 50}" + "." * (k % 5 > 0)) for k in range(300)]
    return rows + rows[:5]


@pytest.mark.parametrize("block", [256, 7])
def test_repair_of_odd_conversations(spark, block):
    rows = odd_turns()
    data = [(*r, "clash", 1, "clash") for r in rows]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, g string, idx long, audit string").repartition(5)
    got = repair_conversations(df, block_turns=block)
    assert got.columns == list(COLUMNS)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, {r[0] for r in rows})


def test_damage_and_lost_conversations(spark):
    import zlib

    rows = [(k, t, "assistant" if t % 2 else "user", f"Said {t}. Done!") for k in range(40) for t in range(3)] + [(None, None, None, None)]
    drops = [k for k in range(2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][0]
    rows.append((drops, 0, "user", "gone"))
    hurt = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text or " ") if kind == 2 else text
        hurt += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = Counter(tuple(r) for r in repair_conversations(damage(df), among=df).collect())
    assert got == brute(hurt, {r[0] for r in rows})
    assert repair_conversations(damage(df.limit(0)), among=df.limit(0)).collect() == []
