"""Scoring with a linear model held in tables, and explaining the scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise import constants as K
from slantwise.functions import leaveout
from slantwise.functions import scores as sc
from slantwise.functions import text as tx
from slantwise.functions.arrays import contiguous_ngrams, let, value_counts
from slantwise.operators.features import (
    DEFAULT_ANALYZER,
    ROUND,
    Analyzer,
    TermTable,
    joined_vectors,
    known_terms,
    table_rows,
    term_counts,
    top_per_group,
)
from slantwise.session import BROADCAST_ROWS, small_side


def wide_weights(vocab: DataFrame, weights: DataFrame, classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """One row per term: ``idf`` and one coefficient column per class."""
    coefs = weights.groupBy("term").agg(
        *[
            F.coalesce(F.max(F.when(F.col("class_idx") == i, F.col("coef"))), F.lit(0.0)).alias(f"coef_{i}")
            for i in range(len(classes))
        ]
    )
    names = [f"coef_{i}" for i in range(len(classes))]
    return (
        vocab.select("term", "idf")
        .join(coefs, "term", "left")
        .select("term", "idf", *[F.coalesce(name, F.lit(0.0)).alias(name) for name in names])
    )


def _intercept(intercepts: DataFrame, index: int) -> Column:
    value = intercepts.where(F.col("class_idx") == index).select(F.max("intercept")).scalar()
    return F.coalesce(value, F.lit(0.0))


def _weighted(counts: DataFrame, wide: DataFrame, analyzer: Analyzer, rows: int | None) -> DataFrame:
    return known_terms(counts, wide, rows).withColumn("w", analyzer.tf_weight(F.col("tf")) * F.col("idf"))


def _document_sums(
    docs: DataFrame, wide: DataFrame, k: int, analyzer: Analyzer, text_col: str, key_col: str, rows: int | None
) -> DataFrame:
    """Copies, squared norm and products with the coefficients, one row per text key.

    All are sums, so one aggregate gives them. It runs per partition first: what
    is shuffled is one small row per text, never its terms.
    """
    dots = [f"_dot_{i}" for i in range(k)]
    weighted = _weighted(term_counts(docs, analyzer, text_col, (key_col,)), wide, analyzer, rows).select(
        key_col,
        F.lit(0).alias("_copies"),
        (F.col("w") * F.col("w")).alias("_ss"),
        *[(F.col("w") * F.col(f"coef_{i}")).alias(name) for i, name in enumerate(dots)],
    )
    copies = docs.select(key_col, F.lit(1).alias("_copies"), *[F.lit(0.0).alias(name) for name in ("_ss", *dots)])
    both = weighted.unionByName(copies)
    return both.groupBy(key_col).agg(*[F.sum(name).alias(name) for name in ("_copies", "_ss", *dots)])


def _decisions(intercepts: DataFrame, k: int) -> list[Column]:
    """Decision values from the sums; without a known term only the intercept counts.

    Copies of a text multiply its sums; norm and product together take that out.
    """
    norm = F.sqrt(F.col("_ss") * F.col("_copies"))
    return [
        _intercept(intercepts, i) + F.coalesce(F.try_divide(F.col(f"_dot_{i}"), norm), F.lit(0.0)) for i in range(k)
    ]


def scoring_table(wide: DataFrame, k: int) -> TermTable:
    """The terms of a model of ``k`` classes with their coefficients, for at most ``BROADCAST_ROWS`` terms."""
    return TermTable(wide, [f"coef_{i}" for i in range(k)])


def linear_scores(
    docs: DataFrame,
    wide: DataFrame,
    intercepts: DataFrame,
    classes: Sequence[str] = K.CLASSES,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    id_col: str = "doc_id",
    rows: int | None = None,
    keep: Sequence[str] | None = None,
    normalize: bool = False,
    table: TermTable | None = None,
) -> DataFrame:
    """``(id, z_0, z_1, ...)``: intercept plus coefficient times tf-idf, per class.

    One row per input row, which scores by its own text, also with a repeated or
    null id. Null text scores by the intercepts. A model of at most ``BROADCAST_ROWS`` terms is
    met inside the row, without a shuffle; with a larger one sums are kept per text.
    ``keep`` lists the columns to carry instead of the id, and ``table`` is the ``scoring_table``
    of the model, for a caller that scores more than once.
    """
    k, text = len(classes), F.col(text_col)
    kept = [id_col] if keep is None else list(keep)
    rows = table_rows(wide, rows) if table is None else 0
    if rows <= BROADCAST_ROWS:
        table, base = table or scoring_table(wide, k), intercepts_of(intercepts, k)
        dots = table.vectors(analyzer, tx.normalize_text(text) if normalize else text, cells=False)["dots"]
        scored = docs.select(*kept, dots.alias("_dots"))
        return scored.select(*kept, *[(F.lit(base[i]) + F.get("_dots", F.lit(i))).alias(f"z_{i}") for i in range(k)])
    key = F.md5(text).alias("_key")
    clean = docs.select(key, (tx.normalize_text(text) if normalize else text).alias("_clean"))
    sums = _document_sums(clean, wide, k, analyzer, "_clean", "_key", rows)
    values = [z.alias(f"z_{i}") for i, z in enumerate(_decisions(intercepts, k))]
    return docs.select(*kept, key).join(sums, "_key", "left").select(*kept, *values)


def predict_proba(decisions: DataFrame, classes: Sequence[str] = K.CLASSES, id_col: str = "doc_id") -> DataFrame:
    """Softmax of the decision values as ``prob_<class>`` columns."""
    probs = sc.softmax([F.col(f"z_{i}") for i in range(len(classes))])
    return decisions.select(id_col, *[p.alias(name) for p, name in zip(probs, sc.prob_columns(classes))])


def with_score_columns(df: DataFrame, classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """Add ``pred_label``, ``polarity_score`` and ``entropy`` from the probabilities."""
    probs = sc.probabilities(classes)
    return df.select(
        *[c for c in df.columns if c not in ("pred_label", "polarity_score", "entropy")],
        sc.argmax_label(probs, classes).alias("pred_label"),
        sc.signed_score(probs).alias("polarity_score"),
        sc.entropy_eps(probs).alias("entropy"),
    )


def score_documents(
    docs: DataFrame,
    wide: DataFrame,
    intercepts: DataFrame,
    classes: Sequence[str] = K.CLASSES,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    id_col: str = "doc_id",
    normalize: bool = True,
    rows: int | None = None,
    table: TermTable | None = None,
) -> DataFrame:
    """Documents with probabilities, label, signed score and entropy.

    Only the columns used later are carried along: drop ``text`` after scoring and
    it is read once, and its tokens alone reach the Python workers.
    """
    k = len(classes)
    decided = linear_scores(docs, wide, intercepts, classes, analyzer, text_col, id_col, rows, docs.columns, normalize, table)
    probs = sc.softmax([F.col(f"z_{i}") for i in range(k)])
    scored = decided.select(*docs.columns, *[p.alias(name) for p, name in zip(probs, sc.prob_columns(classes))])
    return with_score_columns(scored, classes)


def score_text(spark, text: str, wide: DataFrame, intercepts: DataFrame, **options) -> DataFrame:
    """Score one text: a one-row table through the same plan."""
    return score_documents(spark.createDataFrame([("0", text)], "doc_id string, text string"), wide, intercepts, **options)


def top_coefficients(
    weights: DataFrame, classes: Sequence[str] = K.CLASSES, top_k: int = 50
) -> DataFrame:
    """Terms with the largest positive coefficients per class."""
    rows = weights.where(F.col("coef") > 0).select(
        sc.label_of(F.col("class_idx"), classes).alias("class_name"), "term", F.round("coef", ROUND).alias("coef")
    )
    return top_per_group(rows, "class_name", "coef", top_k).select("class_name", "rank", "term", "coef")


def explain_terms(
    docs: DataFrame,
    wide: DataFrame,
    intercepts: DataFrame | None,
    classes: Sequence[str] = K.CLASSES,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    top_k: int = 15,
    text_col: str = "text",
    id_col: str = "doc_id",
    rows: int | None = None,
) -> DataFrame:
    """Terms that contribute most to the predicted class of each document.

    The contribution is coefficient times tf-idf; without a model
    (``intercepts=None``) it is the tf-idf value alone. Every row explains its own
    text, inside the row: terms are neither shuffled nor sorted across rows, and
    ids may repeat or be null.
    """
    rows = table_rows(wide, rows)
    if rows <= BROADCAST_ROWS:
        return _explained(docs, wide, intercepts, classes, analyzer, top_k, text_col, id_col)
    found = joined_vectors(docs, wide, analyzer, text_col, (id_col,), rows).where(F.size("vector") > 0)
    if intercepts is None:
        chosen, label = F.lit(None).cast("int"), F.lit(None).cast("string")

        def worth(x: Column) -> Column:
            return x["w"] / F.col("norm")
    else:

        def dot(name: str) -> Column:
            return F.aggregate("vector", F.lit(0.0), lambda total, x: total + x["w"] * x["entry"][name])

        chosen = sc.argmax_index([F.round(_intercept(intercepts, i) + dot(f"coef_{i}") / F.col("norm"), 12) for i in range(len(classes))])
        label = sc.label_of(F.col("_pred"), classes)

        def worth(x: Column) -> Column:
            coefs = F.array(*[x["entry"][f"coef_{i}"] for i in range(len(classes))])
            return F.get(coefs, F.col("_pred")) * x["w"] / F.col("norm")

    def ranked(x: Column) -> Column:
        value = F.round(worth(x), ROUND)
        return F.struct((-F.abs(value)).alias("size"), x["entry"]["term"].alias("term"), value.alias("contribution"))

    best = F.slice(F.sort_array(F.transform("vector", ranked)), 1, top_k)
    listed = found.withColumn("_pred", chosen).select(id_col, label.alias("pred_label"), F.posexplode(best).alias("_at", "_best"))
    return listed.select(id_col, (F.col("_at") + 1).alias("rank"), "_best.term", "pred_label", "_best.contribution")


def _explained(
    docs: DataFrame, wide: DataFrame, intercepts: DataFrame | None, classes: Sequence[str], analyzer: Analyzer, top_k: int, text_col: str, id_col: str
) -> DataFrame:
    """``explain_terms`` inside the row: the few terms that may be listed leave the array code."""
    names = [] if intercepts is None else [f"coef_{i}" for i in range(len(classes))]
    base = np.array([] if intercepts is None else intercepts_of(intercepts, len(classes)))
    # Numbers follow the terms, so they break ties as these would.
    table = TermTable(wide.select("term", "idf", *names), names)
    found = table.vectors(analyzer, F.col(text_col), (base, top_k, 2 * 10.0**-ROUND))
    rows = docs.select(id_col, found.alias("_found"))

    def ranked(x: Column) -> Column:
        value = F.round(x["tfidf"], ROUND)
        return F.struct((-F.abs(value)).alias("size"), x["number"].alias("number"), value.alias("contribution"))

    best = F.slice(F.sort_array(F.transform("_found.terms", ranked)), 1, top_k)
    listed = rows.select(id_col, sc.label_of(F.col("_found.chosen"), classes).alias("pred_label"), F.posexplode(best).alias("_at", "_best"))
    named = listed.select("*", F.col("_best.number").alias("number")).join(table.rows.select("number", "term"), "number")
    return named.select(id_col, (F.col("_at") + 1).alias("rank"), "term", "pred_label", "_best.contribution")


def leave_one_out(
    docs: DataFrame,
    wide: DataFrame,
    intercepts: DataFrame,
    classes: Sequence[str] = K.CLASSES,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    top_k: int = 15,
    max_tokens: int | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
    rows: int | None = None,
) -> DataFrame:
    """How much the predicted probability falls when one token is left out.

    All content tokens, or the first ``max_tokens``, are tried in turn. Leaving a token
    out removes the n-grams that cover it and adds those that now bridge the
    gap; every other n-gram keeps its count. So a variant is described by the
    few terms it changes, and its decision values follow from the document's
    sums plus the changes, instead of rescoring the text once per token.

    Terms are looked up inside the row and go on as numbers; no token leaves its row,
    so ids may repeat or be null. A model of more than ``BROADCAST_ROWS`` terms is
    joined instead.
    """
    rows = table_rows(wide, rows)
    if rows > BROADCAST_ROWS:
        return _leave_one_out_joined(docs, wide, intercepts, classes, analyzer, top_k, max_tokens, text_col, id_col, rows)
    low, high = analyzer.ngram_range
    names = [f"coef_{i}" for i in range(len(classes))]
    table = TermTable(wide.select("term", "idf", *names), names)
    base = np.array(intercepts_of(intercepts, len(classes)))
    model, sublinear = table.model, analyzer.sublinear_tf
    tokens = docs.select(id_col, _content(analyzer, F.col(text_col)).alias("_tokens"))
    cell = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("token", T.StringType()), T.StructField("fall", T.DoubleType())])
    schema = T.StructType([tokens.schema.fields[0], T.StructField("falls", T.ArrayType(cell))])

    def tried(batches):
        parts, idf, coefs = model.value
        return leaveout.with_falls(batches, parts, (idf, coefs, base), low, high, sublinear, top_k, max_tokens, ROUND)

    def ranked(x: Column) -> Column:
        value = F.round(x["fall"], ROUND)
        importance = F.when(value == 0, F.lit(0.0)).otherwise(value)
        return F.struct((-F.abs(value)).alias("size"), x["position"].alias("position"), x["token"].alias("token"), importance.alias("importance"))

    best = F.slice(F.sort_array(F.transform("falls", ranked)), 1, top_k)
    listed = tokens.mapInArrow(tried, schema).select(id_col, F.posexplode(best).alias("_at", "_best"))
    return listed.select(id_col, (F.col("_at") + 1).alias("rank"), "_best.position", "_best.token", "_best.importance")


def intercepts_of(intercepts: DataFrame, k: int) -> list[float]:
    """Intercepts in class order, 0 where there is none; one row per class reaches the driver."""
    found = {r["class_idx"]: r["intercept"] for r in intercepts.where(F.col("class_idx").between(0, k - 1)).collect()}
    return [float(found.get(i) or 0.0) for i in range(k)]


def _content(analyzer: Analyzer, text: Column) -> Column:
    return analyzer.tokens(text)


def _spaced(parts: Sequence[Column]) -> Column:
    """One n-gram; null when a part lies outside the text."""
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(" "), part]
    return F.concat(*spaced)


def _leave_one_out_joined(
    docs: DataFrame,
    wide: DataFrame,
    intercepts: DataFrame,
    classes: Sequence[str],
    analyzer: Analyzer,
    top_k: int,
    max_tokens: int | None,
    text_col: str,
    name_col: str,
    rows: int,
) -> DataFrame:
    """``leave_one_out`` for a model too large to be a constant: terms meet it in joins."""
    docs = docs.withColumn("_row", F.monotonically_increasing_id())
    names_of_rows, id_col = docs.select("_row", name_col), "_row"
    low, high = analyzer.ngram_range
    tokens = _content(analyzer, F.col(text_col))
    joined = _spaced

    def changes(t: Column, i: Column) -> Column:
        """N-grams that start at token i, with the number of tokens whose removal
        takes them away, and those that bridge the gap that i leaves."""
        signed = []
        for n in range(low, high + 1):
            whole = joined([F.get(t, i + k) for k in range(n)])
            signed.append(F.struct(whole.alias("term"), F.lit(n).alias("span"), F.lit(-1).alias("step")))
            for before in range(1, n):
                bridged = [F.get(t, i - before + k) for k in range(before)]
                bridged += [F.get(t, i + 1 + k) for k in range(n - before)]
                signed.append(F.struct(joined(bridged).alias("term"), F.lit(1).alias("span"), F.lit(1).alias("step")))
        return F.filter(F.array(*signed), lambda s: s["term"].isNotNull())

    def variants(t: Column) -> Column:
        spots = F.transform(t, lambda token, i: F.struct(i.alias("start"), changes(t, i).alias("signed")))
        # A document of one token has nothing left to score.
        return F.when(F.size(t) > 1, spots).otherwise(F.slice(spots, F.lit(1), F.lit(0)))

    def tried(position: Column) -> Column:
        return F.lit(True) if max_tokens is None else position < max_tokens

    base = docs.select(id_col, tokens.alias("_tokens")).repartition(id_col)
    names = [f"coef_{i}" for i in range(len(classes))]
    side = small_side(wide, rows)

    known = _weighted(
        base.select(id_col, F.inline(value_counts(contiguous_ngrams(F.col("_tokens"), low, high)))), wide, analyzer, rows
    )
    full = known.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_terms"),
        F.sum(F.col("w") * F.col("w")).alias("_ss"),
        *[F.sum(F.col("w") * F.col(name)).alias(f"_dot_{i}") for i, name in enumerate(names)],
    )
    spots = base.select(id_col, F.inline(let(F.col("_tokens"), variants)))
    # Only the changed terms the model knows are kept; their weights follow once
    # equal steps have been added up.
    stepped = (
        spots.select(id_col, "start", F.inline("signed"))
        .join(small_side(wide.select("term"), rows), "term")
        .select(id_col, "term", "step", F.explode(F.sequence("start", F.col("start") + F.col("span") - 1)).alias("position"))
        .where(tried(F.col("position")))
        .groupBy(id_col, "position", "term")
        .agg(F.sum("step").alias("_step"))
        .where(F.col("_step") != 0)
    )
    new_tf = F.coalesce(F.col("tf"), F.lit(0)) + F.col("_step")
    moved = (
        stepped.join(known.select(id_col, "term", "tf"), [id_col, "term"], "left")
        .join(side, "term")
        .withColumn("_old", F.when(F.col("tf") > 0, analyzer.tf_weight(F.col("tf")) * F.col("idf")).otherwise(0.0))
        .withColumn("_new", F.when(new_tf > 0, analyzer.tf_weight(new_tf) * F.col("idf")).otherwise(0.0))
    )
    appears = (F.col("_old") == 0) & (F.col("_new") > 0)
    vanishes = (F.col("_old") > 0) & (F.col("_new") == 0)
    deltas = moved.groupBy(id_col, "position").agg(
        F.sum(F.col("_new") * F.col("_new") - F.col("_old") * F.col("_old")).alias("_d_ss"),
        *[F.sum((F.col("_new") - F.col("_old")) * F.col(name)).alias(f"_d_{i}") for i, name in enumerate(names)],
        F.sum(F.when(vanishes, -1).when(appears, 1).otherwise(0)).alias("_d_terms"),
    )
    places = base.where(F.size("_tokens") > 1).select(
        id_col, F.posexplode("_tokens").alias("position", "token")
    ).where(tried(F.col("position")))
    joined_sums = (
        places
        .join(full, id_col, "left")
        .join(deltas, [id_col, "position"], "left")
    )
    zero = F.lit(0.0)
    before_ss = F.coalesce(F.col("_ss"), zero)
    # The sum of squares of a variant without terms is exactly zero.
    left_terms = F.coalesce(F.col("_terms"), F.lit(0)) + F.coalesce(F.col("_d_terms"), F.lit(0))
    after_ss = F.when(left_terms > 0, before_ss + F.coalesce(F.col("_d_ss"), zero)).otherwise(zero)

    def logit(i: int, dot: Column, ss: Column) -> Column:
        return _intercept(intercepts, i) + F.when(ss > 0, dot / F.sqrt(ss)).otherwise(zero)

    k = len(classes)
    whole = [logit(i, F.coalesce(F.col(f"_dot_{i}"), zero), before_ss) for i in range(k)]
    reduced = [
        logit(i, F.coalesce(F.col(f"_dot_{i}"), zero) + F.coalesce(F.col(f"_d_{i}"), zero), after_ss)
        for i in range(k)
    ]
    with_logits = joined_sums.select(
        id_col,
        "position",
        "token",
        *[z.alias(f"_z{i}") for i, z in enumerate(whole)],
        *[z.alias(f"_r{i}") for i, z in enumerate(reduced)],
    )
    p_whole = sc.softmax([F.col(f"_z{i}") for i in range(k)])
    p_reduced = sc.softmax([F.col(f"_r{i}") for i in range(k)])
    scored = (
        with_logits.withColumn("_pred", sc.argmax_index([F.round(F.col(f"_z{i}"), 12) for i in range(k)]))
        .withColumn(
            "importance",
            F.round(F.get(F.array(*p_whole), F.col("_pred")) - F.get(F.array(*p_reduced), F.col("_pred")), ROUND),
        )
        .withColumn("importance", F.when(F.col("importance") == 0, zero).otherwise(F.col("importance")))
        .withColumn("_size", F.abs("importance"))
    )
    order = Window.partitionBy(id_col).orderBy(F.desc("_size"), "position")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
    return best.join(names_of_rows, "_row").select(name_col, "rank", "position", "token", "importance")
