"""Array expressions evaluated inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Referring twice to a derived column invites the optimizer to inline its
    definition, also into a lambda that runs per element; a lambda variable
    over a one-element array cannot be inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(values: Column, kind: str, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Results of all elements before each; every step copies what stands before it."""
    start = F.struct(zero.alias("run"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(state: Column, value: Column) -> Column:
        return F.struct(join(state["run"], value).alias("run"), F.concat(state["out"], F.array(state["run"])).alias("out"))

    return F.aggregate(values, start, step, lambda state: state["out"])


def running(values: Column, kind: str, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each element, ``join`` over all before it, starting from ``zero``.

    ``join`` must be associative with ``zero`` as its neutral element, and the elements
    of the type ``kind``. The array is cut into as many blocks as a block has
    elements, so what is copied grows with the length to the power of one and a half.
    """

    def in_blocks(array: Column, side: Column) -> Column:
        places = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.floor((F.size(array) - 1) / side).cast("int")))
        blocks = F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda k: F.slice(array, k * side + 1, side))
        return let(blocks, joined)

    def joined(blocks: Column) -> Column:
        before = _scan(F.transform(blocks, lambda block: F.aggregate(block, zero, join)), kind, zero, join)
        scanned = F.zip_with(blocks, before, lambda block, base: F.transform(_scan(block, kind, zero, join), lambda x: join(base, x)))
        return F.flatten(scanned)

    def sized(array: Column) -> Column:
        return let(F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(array))).cast("int")), lambda side: in_blocks(array, side))

    return let(values, sized)


def contiguous_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams of ``low``..``high`` neighbouring tokens, joined by one space."""

    def of_size(items: Column, n: int) -> Column:
        if n == 1:
            return items

        def gram(last: Column, start: Column) -> Column:
            parts = [F.get(items, start + offset) for offset in range(n - 1)] + [last]
            spaced = [parts[0]]
            for part in parts[1:]:
                spaced += [F.lit(" "), part]
            return F.concat(*spaced)

        return F.transform(F.slice(items, F.lit(n), F.size(items)), gram)

    return let(tokens, lambda t: F.flatten(F.array(*[of_size(t, n) for n in range(low, high + 1)])))


def value_counts(values: Column) -> Column:
    """Array of ``(term, tf)`` structs, one per distinct value of an array.

    Sorting puts equal values next to each other; the length of each run is its
    count. The array never leaves its row, so counting terms needs no shuffle.
    """

    def runs(items: Column) -> Column:
        last = F.filter(
            F.transform(items, lambda x, i: F.when(F.get(items, i + 1) == x, F.lit(None)).otherwise(i)),
            lambda i: i.isNotNull(),
        )
        return let(
            last,
            lambda ends: F.transform(
                ends,
                lambda end, j: F.struct(
                    F.get(items, end).alias("term"),
                    (end - F.coalesce(F.get(ends, j - 1), F.lit(-1))).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(values), runs)


def dot(a: Column, b: Column) -> Column:
    """Dot product of two numeric arrays, in DOUBLE."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 when either has no length."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))
