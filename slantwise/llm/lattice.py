"""Cheapest edits of a run of turns: a two-ended search over the edit lattice.

A node is (turns read, state); the state says what the last kept turn was. Codes:
``s``, ``u``, ``a`` or ``o`` (any other role), upper case for a truncated turn, ``x``
for one that must go. An audit is the letters of the edits in order: K(eep),
R(erole), D(elete), I(nsert). In a legal result the next turn is always the user or
always the assistant, so an audit leads to one state only.
"""

from __future__ import annotations

from heapq import heappop, heappush

import pyarrow as pa

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (EMPTY, ASSISTANT)
LEGAL = {"su", "ua", "au"}

# State after a turn that the user or the assistant is due to take.
_NEXT = {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
_KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}

# Conversations of one shape have one answer; a worker keeps so many. A plain store,
# since a cache decorator would be sent to the workers by name.
SHAPES = 1 << 14
_ANSWERS: dict = {}

BLOCK = "from int, to int, cost long, audit string"


def _edges(code: str | None, state: int):
    """``(letter, cost, state, turns read)`` of the edits that leave a node."""
    yield "I", INSERT, _NEXT[state], 0
    if code is None:
        return
    yield "D", DELETE, state, 1
    if code == "x":
        return
    more = TRUNCATED if code.isupper() else 0
    yield "R", REROLE + more, _NEXT[state], 1
    kept = _KEPT[code.lower()].get(state)
    if kept is not None:
        yield "K", KEEP + more, kept, 1


def _back_edges(codes: str, at: int, state: int):
    """``(letter, cost, node)`` of the edits that enter a node."""
    for before in STATES:
        for letter, cost, after, read in _edges(codes[at - 1] if at else None, before):
            if after == state and read <= at:
                yield letter, cost, (at - read, before)


def cheapest(codes: str, start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost from ``start`` to one of ``goals`` past all turns, and its least audit.

    The two heaps go on past the first meeting until no crossing of that cost is
    left. Free edits (Keep) read a turn, so within a cost the forward heap takes
    early nodes first and the reverse heap late ones: a node's label, the least audit
    of its least cost, is final when it is taken.
    """
    ahead, back = {(0, start): (0, "")}, {(len(codes), goal): (0, "") for goal in goals}
    forward, reverse = [(0, 0, start)], [(0, -len(codes), goal) for goal in goals]
    taken_ahead, taken_back = set(), set()
    best = min((cost + ahead[node][0] for node, (cost, _) in back.items() if node in ahead), default=None)
    while forward and reverse and (best is None or forward[0][0] + reverse[0][0] <= best):
        if forward[0][0] <= reverse[0][0]:
            cost, at, state = heappop(forward)
            node = (at, state)
            if node in taken_ahead:
                continue
            taken_ahead.add(node)
            for letter, more, after, read in _edges(codes[at] if at < len(codes) else None, state):
                to, label = (at + read, after), (cost + more, ahead[node][1] + letter)
                if to not in ahead or label < ahead[to]:
                    ahead[to] = label
                    heappush(forward, (label[0], *to))
                    if to in back:
                        best = min(label[0] + back[to][0], best if best is not None else label[0] + back[to][0])
        else:
            cost, late, state = heappop(reverse)
            node = (-late, state)
            if node in taken_back:
                continue
            taken_back.add(node)
            for letter, more, to in _back_edges(codes, -late, state):
                label = (cost + more, letter + back[node][1])
                if to not in back or label < back[to]:
                    back[to] = label
                    heappush(reverse, (label[0], -to[0], to[1]))
                    if to in ahead:
                        best = min(label[0] + ahead[to][0], best if best is not None else label[0] + ahead[to][0])
    crossings = [(ahead[node][0] + back[node][0], ahead[node][1] + back[node][1]) for node in ahead.keys() & back.keys()]
    return min(crossings, default=None)


def remembered(codes: str, start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """``cheapest``, once per shape."""
    shape = (codes, start, goals)
    if shape not in _ANSWERS:
        if len(_ANSWERS) >= SHAPES:
            _ANSWERS.clear()
        _ANSWERS[shape] = cheapest(codes, start, goals)
    return _ANSWERS[shape]


def block_table(codes: str, whole: bool) -> list[dict]:
    """Cheapest ways through a block: of a whole conversation one, else one per pair of states."""
    if whole:
        cost, audit = remembered(codes, EMPTY, ENDS)
        return [{"from": EMPTY, "to": EMPTY, "cost": cost, "audit": audit}]
    ways = ((a, b, remembered(codes, a, (b,))) for a in STATES for b in STATES)
    return [{"from": a, "to": b, "cost": way[0], "audit": way[1]} for a, b, way in ways if way]


def chain(tables: list[list[dict]], whole: bool) -> list[dict]:
    """One table for blocks that follow each other."""
    known = {(w["from"], w["to"]): (w["cost"], w["audit"]) for w in tables[0]}
    for table in tables[1:]:
        longer: dict = {}
        for (a, b), (cost, audit) in known.items():
            for way in table:
                if way["from"] == b:
                    label = (cost + way["cost"], audit + way["audit"])
                    key = (a, way["to"])
                    if key not in longer or label < longer[key]:
                        longer[key] = label
        known = longer
    if whole:
        cost, audit = min(known[EMPTY, end] for end in ENDS if (EMPTY, end) in known)
        return [{"from": EMPTY, "to": EMPTY, "cost": cost, "audit": audit}]
    return [{"from": a, "to": b, "cost": cost, "audit": audit} for (a, b), (cost, audit) in known.items()]


def illegal_steps(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def roles_of(audit: str):
    """Ops per turn read, inserts first: ``u``/``a`` insert, ``K``, ``D``, ``U``/``A`` rerole.

    An odd number of turns begins with the system, an even one with the user.
    Inserts past the last turn stand behind its own letter.
    """
    left = len(audit) - audit.count("D")
    due = "a" if left % 2 else "u"  # an odd first turn is kept, then the user is due
    ops, ready = "", ""
    for letter in audit:
        if letter == "I":
            ops += due
        else:
            if ready:
                yield ready
            ready, ops = ops + (due.upper() if letter == "R" else letter), ""
        if letter != "D":
            due = "u" if due == "a" else "a"
    yield ready + ops


OPS_AT_ONCE = 1 << 13


def ops_rows(batches):
    """``(g, idx, ops)`` of every turn, from rows ``(g, audit)``."""
    for batch in batches:
        names, places, found = [], [], []
        for g, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for idx, ops in enumerate(roles_of(audit)):
                names.append(g)
                places.append(idx)
                found.append(ops)
                if len(names) >= OPS_AT_ONCE:
                    yield _ops_batch(names, places, found)
                    names, places, found = [], [], []
        yield _ops_batch(names, places, found)


def _ops_batch(names, places, found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(found, pa.string())], ["g", "idx", "ops"])
