"""Secrets in texts, with weak parts that only count when they belong together.

All of it is column expressions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slantwise.functions.arrays import let, running
from slantwise.llm.columns import apart

# Fixed patterns: kind, pattern, the group whose length counts, its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
# The same matches, with the least length inside the pattern: a run is taken whole
# either way, so short runs need not be listed first.
QUICK = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
# Parts that say little alone.
IDENTIFIER = r"""(?i)(?:access|client|account|user)[_-]?(?:key[_-]?)?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{6,}"""
SECRET = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""(?i)(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb)://[^\s"'<>]{4,}"""
WEAK = (("identifier", IDENTIFIER), ("key", SECRET), ("endpoint", ENDPOINT))
KINDS = tuple(k for k, *_ in BASE) + tuple(k for k, _ in WEAK)
SPAN = "array<struct<start:int,rank:int,end:int>>"
SCOPE = 256


def _length(x: Column) -> Column:
    return F.char_length(x)


def spans_of(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Matches from left to right as ``(start, rank, end)`` in code points.

    The pieces between the matches and the matches themselves add up to the
    position; a text without a match is not split.
    """
    between = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.zip_with(
        F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda a, b: F.struct(_length(a).alias("gap"), _length(b).alias("size"))),
        counted,
        lambda step, value: F.struct(step["gap"].alias("gap"), step["size"].alias("size"), _length(value).alias("value")),
    )
    rank = F.lit(KINDS.index(kind))

    def place(found: Column) -> Column:
        ahead = running(F.transform(found, lambda step: step["gap"] + step["size"]), "int", F.lit(0), lambda a, b: a + b)
        spans = F.zip_with(
            found,
            ahead,
            lambda step, at: F.struct(
                (at + step["gap"]).alias("start"), rank.alias("rank"), (at + step["gap"] + step["size"]).alias("end"), step["value"].alias("value")
            ),
        )
        kept = F.filter(spans, lambda x: x["value"] >= least)
        return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))

    return F.when(text.rlike(pattern), let(steps, place)).otherwise(F.array().cast(SPAN))


FAR = -(1 << 30)
ENDS = "struct<id:int,key:int>"


def _sweep(parts: Column, backward: bool) -> Column:
    """For every part in order: the nearest edge of an identifier and of a secret on one side."""
    ordered = F.reverse(parts) if backward else parts

    def own(part: Column) -> Column:
        edge = -part["start"] if backward else part["end"]
        is_id = part["rank"].isin(KINDS.index("access"), KINDS.index("identifier"))
        is_key = part["rank"].isin(KINDS.index("assign"), KINDS.index("hex"), KINDS.index("key"))
        return F.struct(F.when(is_id, edge).otherwise(FAR).alias("id"), F.when(is_key, edge).otherwise(FAR).alias("key"))

    def nearest(a: Column, b: Column) -> Column:
        return F.struct(F.greatest(a["id"], b["id"]).alias("id"), F.greatest(a["key"], b["key"]).alias("key"))

    none = F.struct(F.lit(FAR).alias("id"), F.lit(FAR).alias("key"))
    out = running(F.transform(ordered, own), ENDS, none, nearest)
    return F.reverse(out) if backward else out


def linked_parts(base: Column, weak: Column, scope: int = SCOPE) -> Column:
    """Weak parts whose complement stands within ``scope`` code points.

    An identifier needs a secret, a secret needs an identifier, an endpoint needs
    both. Running maxima in each direction over the sorted parts give the nearest end
    of either role, so no pairs are formed.
    """

    def link(parts: Column) -> Column:
        flagged = F.zip_with(
            F.zip_with(parts, _sweep(parts, False), lambda part, left: F.struct(part.alias("part"), left.alias("left"))),
            _sweep(parts, True),
            lambda x, right: F.struct(
                x["part"].alias("part"),
                ((x["part"]["start"] - x["left"]["id"] <= scope) | (-x["part"]["end"] - right["id"] <= scope)).alias("by_id"),
                ((x["part"]["start"] - x["left"]["key"] <= scope) | (-x["part"]["end"] - right["key"] <= scope)).alias("by_key"),
            ),
        )
        return F.transform(F.filter(flagged, belongs), lambda x: x["part"])

    def belongs(x: Column) -> Column:
        rank = x["part"]["rank"]
        return (
            F.when(rank < len(BASE), False)
            .when(rank == KINDS.index("identifier"), x["by_key"])
            .when(rank == KINDS.index("key"), x["by_id"])
            .otherwise(x["by_id"] & x["by_key"])
        )

    found = let(F.sort_array(F.concat(base, weak)), link)
    return F.when(F.size(weak) > 0, found).otherwise(F.array().cast(SPAN))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


@apart(("n_assign", "n_access", "n_hex", "base_sha256", "spans"), ("text_col",))
def find_secrets(docs: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Documents with the secrets in their whole text.

    New columns: ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` (digest of
    the base spans) and ``spans`` (all spans as ``kind:start:end``, code points, end
    exclusive). Base spans always stay; weak identifiers, secrets and endpoints are
    added when their complements stand within ``scope`` code points. Null or empty
    text has no spans; rows are independent. Columns named like a result are
    replaced.
    """
    results = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
    out = docs.drop(*[c for c in results if c in docs.columns])
    text = F.coalesce(F.col(text_col), F.lit(""))
    for kind, pattern, group, least in BASE:
        quick = QUICK.get(kind)
        out = out.withColumn(f"_{kind}", spans_of(text, kind, quick or pattern, 0 if quick else group, 0 if quick else least))
    base = F.concat(*[F.col(f"_{kind}") for kind, *_ in BASE])
    weak = F.concat(*[spans_of(text, kind, pattern) for kind, pattern in WEAK])
    out = out.withColumn("_base", base).withColumn("_weak", weak)
    out = out.withColumn("_all", F.concat("_base", linked_parts(F.col("_base"), F.col("_weak"), scope)))
    columns = {f"n_{kind}": F.size(f"_{kind}").cast("long") for kind, *_ in BASE}
    columns |= {"base_sha256": F.sha2(_joined(F.col("_base")).cast("binary"), 256), "spans": _joined(F.col("_all"))}
    return out.withColumns(columns).drop(*[f"_{kind}" for kind, *_ in BASE], "_base", "_weak", "_all")
