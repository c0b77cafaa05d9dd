"""Repair of conversations: faults, the cheapest edits that mend them, and the result."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slantwise.llm import lattice
from slantwise.llm.ranks import ordered_index
from slantwise.session import materialize

SPACES = " \t\n\x0b\x0c\r"
BLOCK_TURNS = 256
CHAINED = 16
TABLE = f"array<struct<{', '.join(f'`{x.split()[0]}`:{x.split()[1]}' for x in lattice.BLOCK.split(', '))}>>"


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns with known faults, told by a checksum of conversation and turn.

    Out of 20 checksums 0 drops a turn, 1 empties it, 2 takes its sentence ends, 3 repeats it,
    4 makes it the user's. Null roles and texts, and nulls in the checksum, read as
    one space.
    """
    def known(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known(conv_col), F.lit(":"), known(turn_col)).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(known(text_col), "[.!?]", "")).otherwise(known(text_col))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias(conv_col),
        F.col(f"`{turn_col}`").alias(turn_col),
        F.when(kind == 4, "user").otherwise(known(role_col)).alias(role_col),
        text.alias(text_col),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("int"))).alias("_copy"),
    )
    return rows.drop("_copy")


def _faults(turns: DataFrame) -> DataFrame:
    """``turns`` with the first fault of each and its code in the lattice."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    ended = bare.endswith(".") | bare.endswith("!") | bare.endswith("?")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    slim = turns.select("g", "idx", "n", "turn", "role", "mark", initial.alias("initial"), (bare == "").alias("blank"), ended.alias("ended"))
    # A turn said very often is one row per task before the shuffle.
    said = slim.groupBy("g", "role", "mark").agg(F.min("idx").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    seen = slim.join(said, ["g", "role", "mark"], "left")
    duplicate = ~F.col("blank") & F.coalesce(F.col("idx") > F.col("first"), F.lit(False))
    seen = seen.withColumn("duplicate", duplicate).withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & ~F.col("ended"))
    code = F.when(F.col("blank") | F.col("duplicate"), "x").when(F.col("truncated"), F.upper("initial")).otherwise(F.col("initial"))
    return seen.select("g", "idx", "n", "turn", "initial", "blank", "duplicate", "truncated", code.alias("code"))


def _spelled(runs: str, name: str) -> Column:
    return F.array_join(F.transform(F.col(runs), lambda x: x[name]), "").alias(name)


def _solve(batches):
    for batch in batches:
        g, block, blocks, initials, codes = (batch.column(k).to_pylist() for k in range(5))
        tables = [lattice.block_table(c, b == 1) for c, b in zip(codes, blocks)]
        illegal = [lattice.illegal_steps(x) for x in initials]
        yield _solved(g, block, blocks, illegal, tables)


def _chain(batches):
    for batch in batches:
        g, block, blocks, runs = (batch.column(k).to_pylist() for k in range(4))
        tables = [lattice.chain([x["table"] for x in run], b == 1) for run, b in zip(runs, blocks)]
        yield _solved(g, block, blocks, [sum(x["illegal"] for x in run) for run in runs], tables)


def _solved(g, block, blocks, illegal, tables) -> pa.RecordBatch:
    way = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(way)]
    columns = [pa.array(x, k) for x, k in zip((g, block, blocks, illegal, tables), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["g", "block", "blocks", "illegal", "table"])


SOLVED = f"g string, block long, blocks long, illegal long, table {TABLE}"


def cheapest_edits(faults: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``(g, illegal, cost, audit)`` of every conversation.

    A conversation of up to ``block_turns`` turns is searched at once. A longer one is
    cut into blocks; each tells the cheapest way between any two states, and ways of
    blocks that follow each other are chained, ``CHAINED`` at a time.
    """
    count = F.expr(f"(n + {block_turns - 1}) div {block_turns}")
    placed = faults.withColumns({"block": F.expr(f"idx div {block_turns}"), "blocks": count})
    # The first role of a block is also read behind the block before.
    edge = (F.col("idx") > 0) & (F.col("idx") % block_turns == 0)
    own = F.struct(F.col("block").alias("block"), F.col("code").alias("code"))
    over = F.struct((F.col("block") - 1).alias("block"), F.lit("").alias("code"))
    read = placed.select("g", "idx", "blocks", "initial", F.explode(F.when(edge, F.array(own, over)).otherwise(F.array(own))).alias("at"))
    runs = read.groupBy("g", "at.block", "blocks").agg(F.sort_array(F.collect_list(F.struct("idx", "initial", "at.code"))).alias("run"))
    runs = runs.select("g", "block", "blocks", _spelled("run", "initial"), _spelled("run", "code"))
    solved = materialize(runs.mapInArrow(_solve, SOLVED), "edit-blocks")
    done = solved.where("blocks = 1")
    while (solved := solved.where("blocks > 1")).take(1):
        step = solved.withColumns({"up": F.expr(f"block div {CHAINED}"), "ups": F.expr(f"(blocks + {CHAINED - 1}) div {CHAINED}")})
        met = step.groupBy("g", "up", "ups").agg(F.sort_array(F.collect_list(F.struct("block", "illegal", "table"))).alias("run"))
        solved = materialize(met.mapInArrow(_chain, SOLVED), "edit-blocks")
        done = done.unionByName(solved.where("blocks = 1"))
    way = F.col("table")[0]
    return done.select("g", "illegal", way["cost"].alias("cost"), way["audit"].alias("audit"))


def _repaired_turns(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """``(g, idx, piece)``: what stands in the repaired conversation for each turn, inserts with it."""
    ops = edits.select("g", "audit").mapInArrow(lattice.ops_rows, "g string, idx long, ops string")

    def line(op: Column) -> Column:
        who = F.when(F.lower(op) == "u", "user:").when(F.lower(op) == "a", "assistant:").otherwise(F.concat("role", F.lit(":")))
        return F.concat(who, F.when(op.isin("u", "a"), "").otherwise(F.col("text")))

    kept = F.filter(F.split("ops", ""), lambda op: op.isin("u", "a", "K", "U", "A"))
    met = turns.select("g", "idx", "role", "text").join(ops, ["g", "idx"]).where(F.col("ops") != "D")
    return met.select("g", "idx", F.array_join(F.transform(kept, line), "\n").alias("piece"))


def _hashed(batches):
    """``(g, sha)`` of pieces sorted by conversation and place; one piece is held at a time."""
    name, running = None, None
    for batch in batches:
        names, shas = [], []
        for g, piece in zip(batch.column(0), batch.column(2)):
            g = g.as_py()
            if g != name:
                if running is not None:
                    names.append(name)
                    shas.append(running.hexdigest())
                name, running = g, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(piece.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(shas, pa.string())], ["g", "sha"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([running.hexdigest()], pa.string())], ["g", "sha"])


def repair_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    among: DataFrame | None = None,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """Faults, cheapest edits and checksum of the repaired text of every conversation.

    Returned are ``conv_col``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit`` and ``repaired_sha256``, once per conversation of ``turns``, or per
    distinct ``conv_col`` of ``among``; one without turns has zeros and the checksum of
    nothing. The faults and costs are those of ``lattice``.

    A conversation's turns are read by ``turn_col``, nulls first, then role, then the
    digest of the text; rows that agree in all of it are copies of each other. A null
    conversation is one like any other. Null and empty roles and texts
    are allowed: null reads as one space, without a word a turn is blank, and a role
    that does not begin with s, u or a is neither of them. Other columns are not
    read. An empty table gives an empty result.

    Turns are dealt by ranges of (conversation, turn), so a conversation of any length
    is spread until its codes, a letter a turn, are put together. The checksum needs the
    repaired turns in order: they stream through one task per conversation.
    """
    conv = F.col(f"`{conv_col}`")

    def known(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    def named(column: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))

    rows = turns.select(
        named(conv).alias("g"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        known(role_col).alias("role"),
        known(text_col).alias("text"),
        F.unhex(F.sha2(known(text_col), 256)).alias("mark"),
    )
    rows = ordered_index(materialize(rows, "turns"), "g", [F.col("turn"), F.col("role"), F.col("mark")], "turns")
    faults = materialize(_faults(rows), "turn-faults")
    edits = cheapest_edits(faults, block_turns)
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    sums = [F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")]
    counts = faults.groupBy("g").agg(F.coalesce(missing, F.lit(0)).alias("gaps"), *sums)
    pieces = _repaired_turns(rows, edits).repartition("g").sortWithinPartitions("g", "idx")
    shas = pieces.mapInArrow(_hashed, "g string, sha string")
    every = (turns if among is None else among).select(conv.alias(conv_col)).distinct().withColumn("g", named(F.col(f"`{conv_col}`")))
    out = every.join(counts, "g", "left").join(edits, "g", "left").join(shas, "g", "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha = F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return out.select(f"`{conv_col}`", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), sha)
