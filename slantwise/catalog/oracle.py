"""DuckDB statements that compute what the queries compute, from the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from slantwise import constants as K
from slantwise.catalog import fixtures as fx
from slantwise.functions import text as tx
from slantwise.operators import language as lg
from slantwise.operators.splitting import SEED


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words: Sequence[str]) -> str:
    return ", ".join(_quote(w) for w in words)


def _replace(expr: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({expr}, {_quote(pattern)}, {by if by.startswith('chr(') else _quote(by)}, 'g')"


def _collapse(expr: str) -> str:
    return f"trim({_replace(expr, K.WS + '+')})"


def _normalize(expr: str) -> str:
    out = f"translate(nfc_normalize({expr}), '‘’“”', '''''\"\"')"
    out = f"replace(replace({out}, '—', ' -- '), '–', ' - ')"
    address = f"{K.NON_WS}+@{K.NON_WS}+\\.{K.NON_WS}+"
    for pattern in (K.URL, address, *K.BOILERPLATE):
        out = _replace(out, pattern)
    return _collapse(out)


STOP = _list(K.STOP_WORDS)
A, B, C = K.CLASSES


def _tokens(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), {_quote(K.TOKEN)})"


def _content(expr: str) -> str:
    return f"list_filter({_tokens(expr)}, lambda t: t NOT IN ({STOP}))"


def _grams(tokens: str, low: int = 1, high: int = 3) -> str:
    """All n-grams of the list ``tokens`` (a column name)."""
    parts = []
    for n in range(low, high + 1):
        gram = " || ' ' || ".join(f"{tokens}[i + {k}]" for k in range(n))
        parts.append(f"list_transform(range(1, len({tokens}) - {n - 1} + 1), lambda i: {gram})")
    return f"flatten([{', '.join(parts)}])"


REGION = "CASE doc_id % 5 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(fx.REGIONS)) + " END"

DOCS = f"""docs AS (
  SELECT doc_id, text, lang, source,
    CASE WHEN doc_id % 50 = 0 THEN 'n/a'
         ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER), '%Y-%m-%d') END AS date,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE {REGION} END AS region
  FROM documents)"""

SOURCE_LABELS = f"""source_labels AS (
  SELECT DISTINCT lower(source) AS outlet_name,
    CASE CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 3 WHEN 0 THEN '{A}' WHEN 1 THEN '{B}' ELSE '{C}' END AS label
  FROM documents WHERE CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) < {fx.LABELLED_SOURCES})"""

HUMAN = f"""human_labels AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN '{C}' ELSE '{A}' END AS label FROM labels WHERE toxic = 1 OR quality = 0)"""

LABELED = f"""{DOCS}, {SOURCE_LABELS}, {HUMAN}, labeled AS (
  SELECT d.*, s.label AS tier1_label, h.label AS tier2_label, coalesce(h.label, s.label) AS label
  FROM docs d LEFT JOIN source_labels s ON lower(d.source) = s.outlet_name
  LEFT JOIN human_labels h ON d.doc_id = h.doc_id)"""

CLEAN = f"""{LABELED}, clean AS (
  SELECT doc_id, source, lang, label, {_normalize('text')} AS text FROM labeled)"""


def _probs(step: str = "7") -> str:
    return f"""1 + (doc_id * {step}) % 97 AS a, 1 + (doc_id * 13) % 89 AS b, 1 + (doc_id * 29) % 83 AS c"""


def _argmax(a: str, b: str, c: str, values: Sequence[str]) -> str:
    return f"CASE WHEN {a} >= {b} AND {a} >= {c} THEN {values[0]} WHEN {b} >= {c} THEN {values[1]} ELSE {values[2]} END"


NAMES = [_quote(n) for n in K.CLASSES]
PA, PB, PC = (f"prob_{n}" for n in K.CLASSES)
EPS = "1e-10"

SHARES = f"""CAST(a AS DOUBLE) / CAST(a + b + c AS DOUBLE) AS {PA}, CAST(b AS DOUBLE) / CAST(a + b + c AS DOUBLE) AS {PB},
    CAST(c AS DOUBLE) / CAST(a + b + c AS DOUBLE) AS {PC}"""

EXACT = "-(" + " + ".join(f"CASE WHEN {p} > 0 THEN {p} * ln({p}) ELSE 0 END" for p in (PA, PB, PC)) + ")"

SCORED = f"""{LABELED}, raw AS (SELECT *, {_probs()} FROM labeled), shares AS (SELECT *, {SHARES} FROM raw),
scored AS (SELECT *, {_argmax(PA, PB, PC, NAMES)} AS pred_label, {PC} - {PA} AS polarity_score,
    -({' + '.join(f'{p} * ln({p} + {EPS})' for p in (PA, PB, PC))}) AS entropy,
    greatest({PA}, {PB}, {PC}) AS confidence FROM shares),
known AS (SELECT * FROM scored WHERE label IS NOT NULL)"""

COUNTS = f"""toks AS (SELECT doc_id, label, {_content('text')} AS t FROM clean),
counts AS (SELECT doc_id, label, term, count(*) AS tf FROM
  (SELECT doc_id, label, unnest({_grams('t')}) AS term FROM toks) GROUP BY ALL)"""

VOCAB = f"""{CLEAN}, {COUNTS},
n_fit AS (SELECT count(*) AS n FROM clean WHERE label IS NOT NULL),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM counts WHERE label IS NOT NULL GROUP BY term),
kept AS (SELECT * FROM stats, n_fit WHERE df >= {K.MIN_DF} AND df <= CAST({K.MAX_DF} AS DOUBLE) * n
  ORDER BY cf DESC, term LIMIT {K.MAX_FEATURES}),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf,
  ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf FROM kept)"""

TFIDF = f"""{VOCAB}, hits AS (SELECT c.doc_id, c.label, c.term, c.tf, v.idx, v.idf, (1.0::DOUBLE + ln(c.tf)) * v.idf AS w
  FROM counts c JOIN vocab v ON c.term = v.term),
tfidf AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM hits)"""


def _coef(index: int) -> str:
    return f"(((length(term) * ({index} + 2)) % 7 - 3) / CAST(10 AS DOUBLE))"


LINEAR = f"""{TFIDF}, sums AS (SELECT doc_id, sqrt(sum(w * w)) AS norm,
    {', '.join(f'sum(w * {_coef(i)}) AS d{i}' for i in range(3))} FROM hits GROUP BY doc_id),
linear AS (SELECT c.doc_id, {', '.join(f'CAST({v} AS DOUBLE) + coalesce(d{i} / norm, 0) AS z_{i}' for i, v in enumerate(fx.INTERCEPTS))}
  FROM clean c LEFT JOIN sums s ON c.doc_id = s.doc_id)"""


def _softmax(prefix: str = "z_") -> str:
    z = [f"{prefix}{i}" for i in range(3)]
    top = f"greatest({', '.join(z)})"
    mass = " + ".join(f"exp({x} - {top})" for x in z)
    return ", ".join(f"exp({x} - {top}) / ({mass}) AS prob_{n}" for x, n in zip(z, K.CLASSES))


PROBA = f"""{LINEAR}, proba AS (SELECT doc_id, {_softmax()} FROM linear),
predicted AS (SELECT *, {_argmax(PA, PB, PC, NAMES)} AS pred_label, {PC} - {PA} AS polarity_score,
  -({' + '.join(f'{p} * ln({p} + {EPS})' for p in (PA, PB, PC))}) AS entropy FROM proba)"""


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _quota(table: str, column: str, draws: str, out: str, extra: str = "") -> str:
    """CTEs that add the largest-remainder quota ``out`` to ``table``."""
    return f"""{out}_base AS (SELECT *, {column} * {draws} AS product, (SELECT sum({column}) FROM {table})::BIGINT AS total FROM {table}, sizes),
{out}_parts AS (SELECT *, product // total AS whole, product % total AS remainder FROM {out}_base),
{out}_ranked AS (SELECT *, row_number() OVER (ORDER BY remainder DESC, stratum) AS place,
  {draws} - (SELECT sum(whole) FROM {out}_parts) AS spare FROM {out}_parts),
{out}_quota AS (SELECT stratum, n {extra}, whole + CASE WHEN place <= spare THEN 1 ELSE 0 END AS {out} FROM {out}_ranked)"""


STRATIFIED = f"""{LABELED}, pool AS (SELECT doc_id, source, label, label || '_' || lower(source) AS combined FROM labeled WHERE label IS NOT NULL),
pool2 AS (SELECT doc_id, source, label,
  CASE WHEN (SELECT min(c) FROM (SELECT count(*) AS c FROM pool GROUP BY combined)) >= 2 THEN combined ELSE label END AS stratum FROM pool),
strata AS (SELECT stratum, count(*) AS n FROM pool2 GROUP BY stratum),
s0 AS (SELECT sum(n)::BIGINT AS all_rows FROM strata),
s1 AS (SELECT all_rows, all_rows - ceil(CAST(0.15 AS DOUBLE) * all_rows)::BIGINT AS n_fit FROM s0),
sizes AS (SELECT n_fit, n_fit - ceil(CAST(0.15 AS DOUBLE) / (1 - CAST(0.15 AS DOUBLE)) * n_fit)::BIGINT AS n_train FROM s1),
{_quota('strata', 'n', 'n_fit', 'fit')},
{_quota('fit_quota', 'fit', 'n_train', 'train', ', fit')},
placed AS (SELECT p.*, row_number() OVER (PARTITION BY p.stratum ORDER BY md5('{SEED}|' || doc_id), doc_id) AS place, fit, train
  FROM pool2 p JOIN train_quota q ON p.stratum = q.stratum),
split AS (SELECT doc_id, source, label,
  CASE WHEN place <= train THEN 'train' WHEN place <= fit THEN 'val' ELSE 'test' END AS split FROM placed)"""

TEMPORAL = f"""{LABELED}, dated AS (SELECT doc_id, date, label, TRY_CAST(date AS DATE) AS day FROM labeled WHERE label IS NOT NULL AND TRY_CAST(date AS DATE) IS NOT NULL),
past AS (SELECT *, label AS stratum FROM dated WHERE day < DATE '2024-06-01'),
strata AS (SELECT stratum, count(*) AS n FROM past GROUP BY stratum),
s0 AS (SELECT sum(n)::BIGINT AS n_fit FROM strata),
sizes AS (SELECT n_fit, n_fit - ceil(CAST(0.15 AS DOUBLE) * n_fit)::BIGINT AS n_train FROM s0),
{_quota('strata', 'n', 'n_train', 'train')},
placed AS (SELECT p.*, row_number() OVER (PARTITION BY p.stratum ORDER BY md5('{SEED}|' || doc_id), doc_id) AS place, train
  FROM past p JOIN train_quota q ON p.stratum = q.stratum)"""


def _report(fields: Sequence[str], where: str = "true", k: int = K.K_ANONYMITY) -> str:
    keys = {"source": "coalesce(source, 'unknown')", "region": "coalesce(region, 'unknown')", "lang": "coalesce(lang, 'unknown')"}
    stacked = " UNION ALL ".join(f"SELECT *, '{f}' AS field, {keys[f]} AS group_name FROM base" for f in fields)
    return f"""base AS (SELECT *, {EXACT} AS exact FROM scored WHERE {where}), stacked AS ({stacked}),
groups AS (SELECT field, group_name, count(*) AS size, avg(polarity_score) AS mean, median(polarity_score) AS median,
  stddev_pop(polarity_score) AS std, min(polarity_score) AS min, max(polarity_score) AS max,
  {', '.join(f"count(*) FILTER (pred_label = '{n}') AS count_{n}" for n in K.CLASSES)}, avg(exact) AS mean_entropy
  FROM stacked GROUP BY field, group_name),
report AS (SELECT field, group_name, size, {', '.join(f'round({c}, 6) AS score_{c}' for c in ('mean', 'median', 'std', 'min', 'max'))},
  {', '.join(f'count_{n}' for n in K.CLASSES)}, round(mean_entropy, 6) AS mean_entropy FROM groups WHERE size >= {k})"""


CONFUSION = f"""{SCORED}, names AS (SELECT unnest([{_list(K.CLASSES)}]) AS class_name),
cells AS (SELECT t.class_name AS true_label, p.class_name AS pred_label,
  (SELECT count(*) FROM known k WHERE k.label = t.class_name AND k.pred_label = p.class_name) AS count FROM names t, names p),
per_class AS (SELECT n.class_name,
  (SELECT sum(count) FROM cells WHERE true_label = n.class_name)::BIGINT AS support,
  (SELECT sum(count) FROM cells WHERE pred_label = n.class_name)::BIGINT AS predicted,
  (SELECT sum(count) FROM cells WHERE pred_label = n.class_name AND true_label = n.class_name)::BIGINT AS hits FROM names n),
measured AS (SELECT class_name, coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall,
  coalesce(2.0::DOUBLE * hits / nullif(support + predicted, 0), 0) AS f1, support, predicted, hits FROM per_class)"""

BINS = f"""{SCORED}, edges AS (SELECT i AS bin_no, i * CAST(0.1 AS DOUBLE) AS lo, CASE WHEN i = 9 THEN CAST(1 AS DOUBLE) ELSE (i + 1) * CAST(0.1 AS DOUBLE) END AS hi
  FROM range(0, 10) r(i)),
binned AS (SELECT lo, hi, count(*) AS count, avg(confidence) AS conf, avg(CASE WHEN label = pred_label THEN 1.0::DOUBLE ELSE 0 END) AS acc
  FROM known JOIN edges ON confidence > lo AND confidence <= hi GROUP BY lo, hi)"""


def _histogram(group: str) -> str:
    """``group`` is a column name or empty."""
    key = f"{group}, " if group else ""
    same = f"c.{group} = s.{group} AND " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""{SCORED}, placed AS (SELECT *, least(CAST(floor((polarity_score + 1) * CAST(20 AS DOUBLE)) AS INTEGER), 39) AS rough FROM scored),
fixed AS (SELECT *, rough - CASE WHEN polarity_score < -1 + rough * CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END
  + CASE WHEN rough < 39 AND polarity_score >= -1 + (rough + 1) * CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END AS bin FROM placed),
counts AS (SELECT {key}bin, count(*) AS count FROM fixed GROUP BY {key}bin),
stats AS (SELECT {key}avg(polarity_score) AS mean, median(polarity_score) AS med FROM scored {by}),
grid AS (SELECT s.*, i AS bin FROM stats s, range(0, 40) r(i))
SELECT {'s.' + group + ',' if group else ''} CAST(s.bin AS INTEGER) AS bin, round(-1 + s.bin * CAST(0.05 AS DOUBLE), 6) AS bin_lower,
  round(CASE WHEN s.bin = 39 THEN 1 ELSE -1 + (s.bin + 1) * CAST(0.05 AS DOUBLE) END, 6) AS bin_upper,
  coalesce(c.count, 0) AS count, round(s.mean, 6) AS mean_score, round(s.med, 6) AS median_score
FROM grid s LEFT JOIN counts c ON {same}c.bin = s.bin"""


CLASS_SUMS = f"""{TFIDF}, sizes AS (SELECT count(*) AS n, {', '.join(f"count(*) FILTER (label = '{c}') AS n{i}" for i, c in enumerate(K.CLASSES))}
  FROM clean WHERE label IS NOT NULL),
sums AS (SELECT term, sum(x) AS w, count(*) AS d, {', '.join(f"coalesce(sum(x) FILTER (label = '{c}'), 0) AS w{i}, count(*) FILTER (label = '{c}') AS d{i}" for i, c in enumerate(K.CLASSES))}
  FROM tfidf WHERE label IS NOT NULL GROUP BY term)"""


def _chi2() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS class_name, term, round(power(w{i} - (n{i} / n) * w, 2) / ((n{i} / n) * (1 - n{i} / n) * w), 6) AS score
  FROM sums, sizes WHERE n{i} > 0 AND n{i} < n"""
        for i, c in enumerate(K.CLASSES)
    )
    return f"""WITH {CLASS_SUMS}, rows AS ({parts}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY score DESC, term) AS rank FROM rows WHERE score > 0)
SELECT class_name, CAST(rank AS INTEGER) AS rank, term AS phrase, score FROM ranked WHERE rank <= 50"""


def _group_phrases(k: int = K.K_ANONYMITY, top_k: int = 20) -> str:
    return f"""WITH {TFIDF}, grouped AS (SELECT doc_id, coalesce(source, 'unknown') AS group_name FROM clean),
sizes AS (SELECT group_name, count(*) AS size FROM grouped GROUP BY group_name),
sums AS (SELECT group_name, term, sum(x) AS w FROM tfidf JOIN grouped USING (doc_id) GROUP BY group_name, term),
shares AS (SELECT group_name, size, size::DOUBLE / (SELECT sum(size) FROM sizes) AS p FROM sizes),
scored AS (SELECT group_name, term, w - p * sum(w) OVER (PARTITION BY term) AS gap, p * (1 - p) * sum(w) OVER (PARTITION BY term) AS scale, size
  FROM sums JOIN shares USING (group_name)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY group_name ORDER BY score DESC, term) AS rank
  FROM (SELECT group_name, term, round(gap * gap / scale, 6) AS score FROM scored WHERE gap > 0 AND scale > 0 AND size >= {k}) WHERE score > 0)
SELECT group_name, CAST(rank AS INTEGER) AS rank, term AS phrase, score FROM ranked WHERE rank <= {top_k}"""


def _mi() -> str:
    cells = []
    for i in range(3):
        for joint, side in ((f"d{i}", "d"), (f"(n{i} - d{i})", "(n - d)")):
            cells.append(
                f"CASE WHEN {joint} > 0 THEN ({joint} / n) * ln(({joint} / n) / (({side} / n) * (n{i} / n))) ELSE 0 END"
            )
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS class_name, term, round((w{i} / n{i}) * mi, 6) AS score FROM best, sizes WHERE n{i} > 0"
        for i, c in enumerate(K.CLASSES)
    )
    return f"""WITH {CLASS_SUMS}, info AS (SELECT sums.*, round({' + '.join(cells)}, 6) AS mi FROM sums, sizes),
best AS (SELECT * FROM info ORDER BY mi DESC, term LIMIT 150), rows AS ({parts}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY score DESC, term) AS rank FROM rows)
SELECT class_name, CAST(rank AS INTEGER) AS rank, term AS phrase, score FROM ranked WHERE rank <= 50"""


def _keywords(source: str, key: str, top_k: int) -> str:
    """``source`` is a CTE with the columns ``key`` and ``text``."""
    return f"""kt AS (SELECT {key}, {_tokens('text')} AS words, {_content('text')} AS t FROM {source}),
tf AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(words) AS term FROM kt) GROUP BY ALL),
cand AS (SELECT DISTINCT {key}, unnest({_grams('t')}) AS cand FROM kt),
n_cand AS (SELECT {key}, count(*) AS n FROM cand GROUP BY {key}),
cand_tf AS (SELECT {key}, cand, term, count(*) AS tf FROM (SELECT {key}, cand, unnest(string_split(cand, ' ')) AS term FROM cand) GROUP BY ALL),
dfs AS (SELECT {key}, term, count(*) AS dfc FROM cand_tf GROUP BY ALL),
idfs AS (SELECT tf.{key}, tf.term, tf.tf, ln((2.0::DOUBLE + n) / (2.0::DOUBLE + coalesce(dfc, 0))) + 1 AS idf
  FROM tf JOIN n_cand ON tf.{key} = n_cand.{key} LEFT JOIN dfs ON tf.{key} = dfs.{key} AND tf.term = dfs.term),
norms AS (SELECT {key}, sum(power(tf * idf, 2)) AS sq FROM idfs GROUP BY {key}),
sims AS (SELECT c.{key}, c.cand, sum(c.tf * i.idf * i.tf * i.idf) AS dot, sum(power(c.tf * i.idf, 2)) AS csq
  FROM cand_tf c JOIN idfs i ON c.{key} = i.{key} AND c.term = i.term GROUP BY ALL),
ks AS (SELECT sims.{key}, cand AS keyword, round(dot / sqrt(sq * csq), 6) AS score FROM sims JOIN norms ON sims.{key} = norms.{key}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, keyword) AS rank FROM ks)
SELECT {key}, CAST(rank AS INTEGER) AS rank, keyword, score FROM ranked WHERE rank <= {top_k}"""


CANDIDATES = """queries AS (SELECT label, min(vec_id) AS query_id, arg_min(embedding, vec_id) AS query FROM embeddings GROUP BY label),
cand AS (SELECT e.label AS group_id, vec_id AS cand_id, CAST(embedding AS DOUBLE[]) AS v,
  list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(query AS DOUBLE[])) AS rel
  FROM embeddings e JOIN queries q ON e.label = q.label WHERE vec_id <> query_id)"""


def _mmr(top_k: int, diversity: float) -> str:
    """Greedy selection unrolled: one pair of CTEs per pick."""
    if diversity == 0:
        return f"""WITH {CANDIDATES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY round(rel, 12) DESC, cand_id) AS pick FROM cand)
SELECT group_id, CAST(pick AS INTEGER) AS pick, cand_id, round(rel, 6) AS similarity FROM ranked WHERE pick <= {top_k}"""
    steps = ["s1 AS (SELECT *, round(rel, 12) AS worth, CAST(NULL AS DOUBLE) AS red FROM cand)"]
    for i in range(1, top_k + 1):
        steps.append(
            f"p{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY worth DESC, cand_id) AS place FROM s{i}) WHERE place = 1)"
        )
        if i < top_k:
            red = f"greatest(s.red, list_cosine_similarity(s.v, p.v))" if i > 1 else "list_cosine_similarity(s.v, p.v)"
            steps.append(
                f"""t{i} AS (SELECT s.group_id, s.cand_id, s.v, s.rel, {red} AS red FROM s{i} s JOIN p{i} p ON s.group_id = p.group_id WHERE s.cand_id <> p.cand_id),
s{i + 1} AS (SELECT *, round({1 - diversity} * rel - {diversity} * red, 12) AS worth FROM t{i})"""
            )
    picks = " UNION ALL ".join(f"SELECT group_id, {i} AS pick, cand_id, round(rel, 6) AS similarity FROM p{i}" for i in range(1, top_k + 1))
    return f"WITH {CANDIDATES}, {', '.join(steps)} {picks}"


def _leave_one_out() -> str:
    """Terms changed by each removal, found through token positions."""
    removed, added = [], []
    for n in (1, 2, 3):
        gram = " || ' ' || ".join(f"t[s + {k}]" for k in range(n))
        removed.append(f"SELECT doc_id, p, {gram} AS term, -1 AS step FROM (SELECT doc_id, t, p, unnest(range(greatest(p - {n - 1}, 1), least(p, len(t) - {n - 1}) + 1)) AS s FROM spots)")
        # n-grams of the shortened list that bridge the gap: they start before p and end after it.
        if n > 1:
            bridge = " || ' ' || ".join(f"t[s + {k} + CASE WHEN s + {k} >= p THEN 1 ELSE 0 END]" for k in range(n))
            added.append(f"SELECT doc_id, p, {bridge} AS term, 1 AS step FROM (SELECT doc_id, t, p, unnest(range(greatest(p - {n - 1}, 1), least(p - 1, len(t) - 1 - {n - 1}) + 1)) AS s FROM spots)")
    z0 = [f"CAST({v} AS DOUBLE)" for v in fx.INTERCEPTS]
    coefs = ", ".join(f"{_coef(i)} AS k{i}" for i in range(3))
    return f"""WITH {TFIDF}, spots AS (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS p FROM toks WHERE len(t) > 1),
steps AS ({' UNION ALL '.join(removed + added)}),
moved AS (SELECT s.doc_id, s.p, s.term, sum(step) AS step FROM steps s JOIN vocab v ON s.term = v.term GROUP BY ALL HAVING sum(step) <> 0),
changed AS (SELECT m.doc_id, m.p, {coefs}, coalesce(h.w, 0) AS old,
  CASE WHEN coalesce(h.tf, 0) + step > 0 THEN (1.0::DOUBLE + ln(coalesce(h.tf, 0) + step)) * v.idf ELSE 0 END AS new
  FROM (SELECT * FROM moved) m JOIN (SELECT term AS vterm, idf FROM vocab) v ON m.term = v.vterm
  LEFT JOIN (SELECT doc_id AS hdoc, term AS hterm, tf, w FROM hits) h ON h.hdoc = m.doc_id AND h.hterm = m.term),
delta AS (SELECT doc_id, p, sum(new * new - old * old) AS dss, {', '.join(f'sum((new - old) * k{i}) AS e{i}' for i in range(3))},
  sum(CASE WHEN old > 0 AND new = 0 THEN -1 WHEN old = 0 AND new > 0 THEN 1 ELSE 0 END) AS dn FROM changed GROUP BY doc_id, p),
base AS (SELECT doc_id, count(*) AS terms, sum(w * w) AS ss, {', '.join(f'sum(w * {_coef(i)}) AS d{i}' for i in range(3))} FROM hits GROUP BY doc_id),
both_sides AS (SELECT s.doc_id, s.p, s.t[s.p] AS token, coalesce(b.ss, 0) AS ss, {', '.join(f'coalesce(b.d{i}, 0) AS d{i}, coalesce(b.d{i}, 0) + coalesce(x.e{i}, 0) AS r{i}' for i in range(3))},
  CASE WHEN coalesce(b.terms, 0) + coalesce(x.dn, 0) > 0 THEN coalesce(b.ss, 0) + coalesce(x.dss, 0) ELSE 0 END AS rss
  FROM spots s LEFT JOIN base b ON s.doc_id = b.doc_id LEFT JOIN delta x ON s.doc_id = x.doc_id AND s.p = x.p),
logits AS (SELECT doc_id, p, token, {', '.join(f'{z} + CASE WHEN ss > 0 THEN d{i} / sqrt(ss) ELSE 0 END AS z{i}, {z} + CASE WHEN rss > 0 THEN r{i} / sqrt(rss) ELSE 0 END AS y{i}' for i, z in enumerate(z0))} FROM both_sides),
chosen AS (SELECT *, {_argmax('round(z0, 12)', 'round(z1, 12)', 'round(z2, 12)', ('0', '1', '2'))} AS pred FROM logits),
importances AS (SELECT doc_id, p, token, round(
  exp(CASE pred WHEN 0 THEN z0 WHEN 1 THEN z1 ELSE z2 END) / (exp(z0) + exp(z1) + exp(z2))
  - exp(CASE pred WHEN 0 THEN y0 WHEN 1 THEN y1 ELSE y2 END) / (exp(y0) + exp(y1) + exp(y2)), 6) AS importance FROM chosen),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(importance) DESC, p) AS rank FROM importances)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, CAST(p - 1 AS INTEGER) AS position, token,
  CASE WHEN importance = 0 THEN 0 ELSE importance END AS importance FROM ranked WHERE rank <= 15"""


def _language(expr: str) -> str:
    found = f"regexp_extract_all(lower({expr}), '[\\p{{L}}\\p{{N}}_]+')"
    hits = ", ".join(
        f"len(list_filter(found, lambda t: t IN ({_list(K.FUNCTION_WORDS[lang])}))) AS {lang}_hits" for lang in sorted(K.FUNCTION_WORDS)
    )
    top = f"greatest({', '.join(f'{lang}_hits' for lang in sorted(K.FUNCTION_WORDS))})"
    cases = " ".join(f"WHEN {lang}_hits = {top} THEN '{lang}'" for lang in sorted(K.FUNCTION_WORDS))
    return f"""sampled AS (SELECT *, {found} AS found FROM docs), hits_by_lang AS (SELECT *, {hits} FROM sampled),
detected AS (SELECT *, CASE WHEN {top} = 0 THEN 'unknown' {cases} END AS detected FROM hits_by_lang)"""


def _characters(sizes: Sequence[int] = lg.SIZES) -> str:
    """All character n-grams of the list ``c``."""
    parts = []
    for n in sizes:
        gram = " || ".join(f"c[i + {k}]" for k in range(n))
        parts.append(f"list_transform(range(1, len(c) - {n - 1} + 1), lambda i: {gram})")
    return f"flatten([{', '.join(parts)}])"


PROFILES = f"""letters AS (SELECT doc_id, lang, CASE WHEN words = '' THEN [] ELSE string_split(' ' || words || ' ', '') END AS c
  FROM (SELECT *, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}]+', ' ', 'g')) AS words FROM docs)),
char_tf AS (SELECT doc_id, lang, gram, count(*) AS tf FROM (SELECT doc_id, lang, unnest({_characters()}) AS gram FROM letters) GROUP BY ALL),
char_totals AS (SELECT lang, gram, sum(tf)::BIGINT AS n FROM char_tf WHERE lang IS NOT NULL GROUP BY lang, gram),
profiles AS (SELECT lang, gram, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rank FROM char_totals QUALIFY rank <= {lg.TOP}),
weighed AS (SELECT t.doc_id, p.lang AS code, sum(tf * ({lg.TOP} + 1 - rank)) AS weight FROM char_tf t JOIN profiles p ON t.gram = p.gram GROUP BY ALL),
chosen_lang AS (SELECT doc_id, code FROM weighed QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, code) = 1),
detected AS (SELECT d.*, coalesce(code, '{lg.UNKNOWN}') AS detected FROM docs d LEFT JOIN chosen_lang x ON d.doc_id = x.doc_id)"""


def _hash(expr: str) -> str:
    return f"sha256({_collapse(f'lower({expr})')})"


def _prepared(rows: str, where: str = "", before: str = "") -> str:
    """CTEs of the cleaned, de-duplicated corpus; ``before`` are CTEs it needs."""
    bounds = f">= {K.MIN_CHARS}"
    return f"""{before}long_enough AS (SELECT doc_id, source, lang, region, {_normalize('text')} AS text FROM {rows}
  WHERE length(text) {bounds} {where}),
first_copies AS (SELECT *, row_number() OVER (PARTITION BY {_hash('text')} ORDER BY doc_id) AS copy FROM long_enough),
prepared AS (SELECT * FROM first_copies WHERE copy = 1 AND length(text) {bounds})"""


JSON_VIEW = f"""WITH {DOCS} SELECT doc_id, md5(text) AS text_md5, source, date, region, lang FROM docs"""


def _html() -> str:
    """Depths as running sums with their running minimum, over one row per piece of a page."""
    counted = [tag for tag in K.DROPPED_TAGS if tag not in K.RAW_TAGS]
    mark = _quote(K.MARKUP)

    def decode(expr: str) -> str:
        """Each reference between one ``&`` and the next, looked up once."""
        number = "coalesce(TRY_CAST(nullif(regexp_extract(r, '^#([0-9]+)', 1), '') AS BIGINT), TRY_CAST('0x' || nullif(regexp_extract(r, '^#[xX]([0-9a-fA-F]+)', 1), '') AS BIGINT), 0)"
        point = f"CASE WHEN {number} BETWEEN 128 AND 159 THEN c1[{number} - 127] WHEN {number} BETWEEN {tx.FIRST_CHARACTER} AND 55295 OR {number} BETWEEN 57344 AND 1114111 THEN chr(CAST({number} AS INTEGER)) ELSE chr(65533) END"
        name = "named[regexp_extract(r, '^([A-Za-z][A-Za-z0-9]*)', 1)]"
        known = f"CASE WHEN regexp_matches(r, '^#([0-9]+|[xX][0-9a-fA-F]+)') THEN {point} ELSE {name} END"
        rest = "regexp_replace(r, '^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?', '')"
        return f"array_to_string(list_transform(string_split({expr}, '&'), lambda r, i: CASE WHEN i = 1 THEN r ELSE coalesce({known} || {rest}, '&' || r) END), '')"

    def strip(expr: str) -> str:
        return f"regexp_replace({expr}, {_quote(f'^{K.WS}+|{K.WS}+$')}, '', 'g')"

    def is_tag(name: str, slash: str = "") -> str:
        return f"regexp_matches(mark, '(?i)^<{slash}{name}[\\s/>]')"

    steps = ", ".join(
        f"CASE WHEN {is_tag(tag)} AND NOT ends_with(mark, '/>') THEN 1 WHEN {is_tag(tag, '/')} THEN -1 ELSE 0 END AS step_{tag}" for tag in counted
    )
    sums = ", ".join(f"sum(step_{tag}) OVER w AS sum_{tag}" for tag in counted)
    deep = " OR ".join(f"sum_{tag} > least(0, low_{tag})" for tag in counted)
    lows = ", ".join(f"min(sum_{tag}) OVER w AS low_{tag}" for tag in counted)
    symbol = f"CASE WHEN k = 1 THEN '' WHEN {is_tag('title')} THEN chr(2) WHEN {is_tag('title', '/')} THEN chr(3) ELSE chr(1) END"
    nodes = f"regexp_split_to_array({decode('pruned')}, '[' || chr(1) || chr(2) || chr(3) || ']')"
    inner = "regexp_extract(pruned, chr(2) || '([^' || chr(3) || ']*)', 1)"
    names = ", ".join(f"{_quote(name)}: {_quote(value)}" for name, value in tx.ENTITIES.items())
    return f"""WITH clean AS (SELECT page_id AS doc_id, translate(coalesce(html, ''), chr(1) || chr(2) || chr(3), '   ') AS html FROM pages),
cut AS (SELECT doc_id, list_prepend('', regexp_extract_all(html, {mark})) AS marks, regexp_split_to_array(html, {mark}) AS texts FROM clean),
pieces AS (SELECT doc_id, unnest(marks) AS mark, unnest(texts) AS piece, unnest(range(1, len(texts) + 1)) AS k FROM cut),
steps AS (SELECT *, {steps} FROM pieces),
sums AS (SELECT *, {sums} FROM steps WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
lows AS (SELECT *, {lows} FROM sums WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
p AS (SELECT doc_id, string_agg(CASE WHEN {deep} THEN chr(1) ELSE {symbol} || piece END, '' ORDER BY k) AS pruned FROM lows GROUP BY doc_id),
tables AS (SELECT MAP {{{names}}} AS named, [{_list(tx.C1_REFERENCES)}] AS c1)
SELECT doc_id, array_to_string(list_transform(regexp_split_to_array({decode(inner)}, '[' || chr(1) || chr(2) || ']'), lambda n: {strip('n')}), '') AS title,
  array_to_string(list_filter(list_transform({nodes}, lambda n: {strip('n')}), lambda n: n <> ''), ' ') AS text,
  'unknown' AS source FROM p, tables"""


def _digest(tokens: str) -> str:
    return f"""WITH {DOCS}, tk AS (SELECT doc_id, {tokens} AS t FROM docs), g AS (SELECT doc_id, {_grams('t')} AS g FROM tk)
SELECT doc_id, CAST(len(g) AS INTEGER) AS n_grams, CAST(len(list_distinct(g)) AS INTEGER) AS n_distinct,
  md5(array_to_string(list_sort(g), '|')) AS digest FROM g"""


def statements() -> dict[str, str]:
    simple = "list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9''\\-]+', ' ', 'g'), ' '), lambda t: t <> '')"
    prep_en = f"{DOCS}, " + _prepared("detected", "AND detected = 'en'", PROFILES + ", ")
    prep_all = _prepared("docs")
    report_lines = [
        "printf('%s | %d documents', group_name, size)",
        "printf('polarity %+.3f on average, %+.3f in the middle, spread %.3f', score_mean, score_median, score_std)",
        f"printf('labels {', '.join(f'{n} %d' for n in K.CLASSES)}', {', '.join(f'count_{n}' for n in K.CLASSES)})",
        "printf('uncertainty %.3f', mean_entropy)",
    ]
    agreed = f"""WITH {SCORED}, turns AS (SELECT doc_id, r AS round, {_probs('(CASE WHEN doc_id % 4 = 0 THEN 7 + 2 * r ELSE 7 END)')} FROM documents, range(0, {fx.ROUNDS}) t(r)),
votes AS (SELECT doc_id, count(DISTINCT {_argmax('a', 'b', 'c', ('0', '1', '2'))}) AS kinds FROM turns GROUP BY doc_id)"""
    group_counts = "SELECT field, group_name, count(*) AS size, avg(polarity_score) AS mean FROM stacked GROUP BY ALL"
    out: dict[str, str] = {
        "jsonl_scan": JSON_VIEW,
        "jsonl_dir_scan": JSON_VIEW,
        "jsonl_rejects": """SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN 'missing field: text' ELSE 'not one object' END AS reason
FROM documents WHERE doc_id % 5 <> 2""",
        "txt_dir_scan": """WITH f AS (SELECT doc_id, regexp_replace(text || chr(10), '\\r\\n?', chr(10), 'g') AS body FROM documents)
SELECT doc_id, md5(body) AS text_md5, CAST(length(body) AS INTEGER) AS n_chars, 'unknown' AS source, '' AS title FROM f""",
        "html_to_docs": _html(),
        "source_labels_scan": f"WITH {SOURCE_LABELS} SELECT outlet_name, label FROM source_labels",
        "human_labels_scan": f"WITH {HUMAN} SELECT doc_id, label FROM human_labels",
        "splits_scan": f"""WITH {STRATIFIED} SELECT doc_id, source, label, CASE label WHEN '{A}' THEN 0 WHEN '{B}' THEN 1 ELSE 2 END AS label_int
FROM split WHERE split = 'train'""",
        "split_sink": f"""WITH {STRATIFIED}, every AS (SELECT coalesce(s.split, 'unlabeled') AS split, l.label FROM labeled l LEFT JOIN split s ON l.doc_id = s.doc_id)
SELECT split, count(*) AS rows, count(label) AS labels FROM every GROUP BY split""",
        "label_template": f"""WITH {DOCS}, {HUMAN} SELECT doc_id, '' AS label, '' AS confidence, '' AS notes FROM docs
WHERE doc_id NOT IN (SELECT doc_id FROM human_labels)""",
        "scored_sink": f"""WITH {SCORED} SELECT doc_id, source, pred_label, {_r('polarity_score', 'entropy')},
  '{{"ids":[' || doc_id || ',null],"label":' || CASE WHEN label IS NULL THEN 'null,"labeled":false' ELSE '"' || label || '","labeled":true' END || '}}' AS meta FROM scored""",
        "errors_sink": f"""WITH {SCORED} SELECT doc_id, label AS true_label, pred_label, {_r('confidence')}, md5(text) AS snippet_md5
FROM known WHERE label <> pred_label""",
        "report_sink": f"""WITH {SCORED}, {_report(('source', 'region', 'lang'), k=120)}, sizes AS ({group_counts}),
shown AS (SELECT field, count(*) FILTER (size >= 120) AS up, count(*) FILTER (size < 120) AS down,
  round(min(mean) FILTER (size >= 120), 6) AS least, round(max(mean) FILTER (size >= 120), 6) AS most FROM sizes GROUP BY field)
"""
        + " UNION ALL ".join(f"SELECT 'groups' AS section, field, group_name, {i} AS line_no, {line} AS line FROM report" for i, line in enumerate(report_lines))
        + """ UNION ALL SELECT 'suppressed_groups', field, group_name, 0, printf('%s | not shown: Group size (%d) < k-anonymity threshold (120)', group_name, size) FROM sizes WHERE size < 120
UNION ALL SELECT 'summary', field, NULL, 0, printf('%s | %d groups shown, %d not shown, means from %+.3f to %+.3f', field, up, down, least, most) FROM shown WHERE up > 0""",
        "normalize_text": f"WITH {DOCS} SELECT doc_id, {_normalize('text')} AS text FROM docs",
        "text_hash": f"WITH {DOCS} SELECT doc_id, {_hash('text')} AS text_hash FROM docs",
        "filter_length": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents WHERE length(text) BETWEEN 50 AND 5000",
        "detect_language": f"WITH {DOCS}, {PROFILES} SELECT doc_id, lang, detected FROM detected",
        "detect_language_by_words": f"WITH {DOCS}, {_language('text')} SELECT doc_id, lang, detected FROM detected",
        "language_profiles": f"WITH {DOCS}, {PROFILES} SELECT lang, gram, n, CAST(rank AS INTEGER) AS rank FROM profiles",
        "language_confusion": f"WITH {DOCS}, {PROFILES} SELECT lang, detected, count(*) AS count FROM detected GROUP BY lang, detected",
        "filter_language": f"WITH {DOCS}, {PROFILES} SELECT doc_id, lang FROM detected WHERE detected = 'en'",
        "preprocess_docs": f"WITH {prep_en} SELECT doc_id, source, text FROM prepared",
        "label_encode": f"""WITH {LABELED} SELECT doc_id, label, CASE label WHEN '{A}' THEN 0 WHEN '{B}' THEN 1 WHEN '{C}' THEN 2 END AS label_int FROM labeled""",
        "tokenize_ngrams": _digest(_content("text")),
        "tokenize_simple": _digest(simple),
        "argmax_label": f"""WITH {SCORED} SELECT doc_id, {_argmax('a', 'b', 'c', ('0', '1', '2'))} AS pred_index,
  {_argmax('a', 'b', 'c', NAMES)} AS pred_label FROM scored""",
        "polarity_score": f"WITH {SCORED} SELECT doc_id, {_r('polarity_score')} FROM scored",
        "entropy_eps": f"WITH {SCORED} SELECT doc_id, {_r('entropy')} FROM scored",
        "entropy_exact": f"WITH {SCORED} SELECT doc_id, round({EXACT}, 6) AS entropy FROM scored",
        "confidence_note": f"""WITH {SCORED} SELECT doc_id, CASE WHEN entropy < 0.5 * ln(3) THEN 'Relatively confident'
  WHEN entropy < 0.8 * ln(3) THEN 'Moderate uncertainty' ELSE 'High uncertainty' END AS note FROM scored""",
        "subset_field": f"WITH {DOCS} SELECT doc_id, coalesce(source, 'unknown') AS source_key, coalesce(region, 'unknown') AS region_key FROM docs",
        "coerce_date": f"""WITH {DOCS} SELECT doc_id, strftime(TRY_CAST(date AS DATE), '%Y-%m-%d') AS day FROM docs WHERE TRY_CAST(date AS DATE) IS NOT NULL""",
        "assign_source_labels": f"WITH {LABELED} SELECT doc_id, source, tier1_label AS label FROM labeled",
        "assign_labels": f"WITH {LABELED} SELECT doc_id, source, label FROM labeled",
        "label_tier_counts": f"""WITH {LABELED} SELECT count(*) AS documents, count(tier1_label) AS tier1,
  round(100.0::DOUBLE * count(tier1_label) / greatest(count(*), 1), 6) AS tier1_percent, count(tier2_label) AS tier2,
  count(label) AS labeled, count(*) - count(label) AS unlabeled FROM labeled""",
        "labeled_unlabeled": f"WITH {LABELED} SELECT doc_id, label IS NOT NULL AS labeled FROM labeled",
        "tfidf_transform": f"WITH {TFIDF} SELECT doc_id, term, CAST(tf AS INTEGER) AS tf, round(x, 6) AS tfidf FROM tfidf",
        "linear_score": f"WITH {LINEAR} SELECT doc_id, {_r('z_0', 'z_1', 'z_2')} FROM linear",
        "dedup_exact": f"""WITH {DOCS}, c AS (SELECT doc_id, source, row_number() OVER (PARTITION BY {_hash('text')} ORDER BY doc_id) AS copy FROM docs)
SELECT doc_id, source FROM c WHERE copy = 1""",
        "label_distribution": f"WITH {LABELED} SELECT label, count(*) AS count FROM labeled WHERE label IS NOT NULL GROUP BY label",
        "vocabulary": f"WITH {VOCAB} SELECT term, idx, df, cf, {_r('idf')} FROM vocab",
        "tfidf_fit": f"""WITH {TFIDF} SELECT term, count(*) AS df, round(sum(x), 6) AS sum_tfidf, round(max(x), 6) AS max_tfidf
FROM tfidf WHERE label IS NOT NULL GROUP BY term""",
        "chi2_phrases": _chi2(),
        "mi_phrases": _mi(),
        "group_phrases": _group_phrases(),
        "confusion_matrix": f"WITH {CONFUSION} SELECT true_label, pred_label, count FROM cells",
        "accuracy": f"WITH {SCORED} SELECT count(*) AS n, round(avg(CASE WHEN label = pred_label THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM known",
        "per_class_metrics": f"WITH {CONFUSION} SELECT class_name, {_r('precision', 'recall', 'f1')}, support FROM measured",
        "macro_f1": f"WITH {CONFUSION} SELECT round(coalesce(avg(f1), 0), 6) AS macro_f1 FROM measured WHERE support + predicted > 0",
        "classification_report": f"""WITH {CONFUSION}, shares2 AS (SELECT sum(hits) / sum(support) AS share, sum(support)::BIGINT AS support FROM measured)
SELECT class_name AS row, {_r('precision', 'recall', 'f1')}, support FROM measured
UNION ALL SELECT 'accuracy', round(share, 6), round(share, 6), round(share, 6), support FROM shares2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM measured
UNION ALL SELECT 'weighted avg', {', '.join(f'round(sum({m} * support) / sum(support), 6)' for m in ('precision', 'recall', 'f1'))}, sum(support)::BIGINT FROM measured""",
        "ece": f"WITH {BINS} SELECT round(sum(count / (SELECT count(*) FROM known) * abs(acc - conf)), 6) AS ece FROM binned",
        "calibration_curve": f"""WITH {BINS} SELECT round(lo, 6) AS bin_lower, round(hi, 6) AS bin_upper, printf('(%.2f, %.2f]', lo, hi) AS bin,
  round(conf, 6) AS mean_confidence, round(acc, 6) AS mean_accuracy, count FROM binned""",
        "score_histogram": f"WITH {_histogram('')}",
        "score_histogram_by_group": f"WITH {_histogram('source')}",
        "topic_leakage": f"""WITH {SCORED}, tk AS (SELECT doc_id, pred_label, {_content('text')} AS t FROM scored),
tg AS (SELECT doc_id, pred_label AS class_name, unnest({_grams('t', 1, 2)}) AS term FROM tk),
totals AS (SELECT class_name, term, count(DISTINCT doc_id) AS df, count(*) AS count FROM tg GROUP BY ALL HAVING count(DISTINCT doc_id) >= 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY count DESC, term) AS rank FROM totals)
SELECT class_name, CAST(rank AS INTEGER) AS rank, term, count FROM ranked WHERE rank <= 10""",
        "subset_report": f"WITH {SCORED}, {_report(('source',))} SELECT * FROM report",
        "suppressed_groups": f"""WITH {SCORED}, {_report(('source', 'lang'), k=60)} SELECT field, group_name, size,
  printf('Group size (%d) < k-anonymity threshold (60)', size) AS reason FROM groups WHERE size < 60""",
        "subset_summary": f"""WITH {SCORED}, {_report(('source', 'region'))}, sizes AS ({group_counts})
SELECT field, count(*) FILTER (size >= {K.K_ANONYMITY}) AS groups_reported, count(*) FILTER (size < {K.K_ANONYMITY}) AS groups_suppressed,
  round(min(mean) FILTER (size >= {K.K_ANONYMITY}), 6) AS min_group_mean, round(max(mean) FILTER (size >= {K.K_ANONYMITY}), 6) AS max_group_mean
FROM sizes GROUP BY field HAVING count(*) FILTER (size >= {K.K_ANONYMITY}) > 0""",
        "multi_field_report": f"WITH {SCORED}, {_report(('source', 'region', 'lang'))} SELECT * FROM report",
        "score_summary": f"""WITH {SCORED} SELECT pred_label, count(*) AS count, (SELECT count(*) FROM scored) AS documents,
  (SELECT round(avg(polarity_score), 6) FROM scored) AS mean_score FROM scored GROUP BY pred_label""",
        "stratified_split": f"WITH {STRATIFIED} SELECT doc_id, source, label, split FROM split",
        "temporal_split": f"""WITH {TEMPORAL} SELECT doc_id, date, label, CASE WHEN place <= train THEN 'train' ELSE 'val' END AS split FROM placed
UNION ALL SELECT doc_id, date, label, 'test' FROM dated WHERE day >= DATE '2024-06-01'""",
        "top_coefficients": f"""WITH {VOCAB}, coefs AS ({' UNION ALL '.join(f"SELECT '{c}' AS class_name, term, {_coef(i)} AS coef FROM vocab" for i, c in enumerate(K.CLASSES))}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY coef DESC, term) AS rank FROM coefs WHERE coef > 0)
SELECT class_name, CAST(rank AS INTEGER) AS rank, term, coef FROM ranked WHERE rank <= 50""",
        "explain_terms": f"""WITH {LINEAR}, chosen AS (SELECT doc_id, {_argmax('round(z_0, 12)', 'round(z_1, 12)', 'round(z_2, 12)', ('0', '1', '2'))} AS pred FROM linear),
parts AS (SELECT t.doc_id, term, pred, round((CASE pred WHEN 0 THEN {_coef(0)} WHEN 1 THEN {_coef(1)} ELSE {_coef(2)} END) * x, 6) AS contribution
  FROM tfidf t JOIN chosen c ON t.doc_id = c.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(contribution) DESC, term) AS rank FROM parts)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, CASE pred WHEN 0 THEN '{A}' WHEN 1 THEN '{B}' ELSE '{C}' END AS pred_label, contribution
FROM ranked WHERE rank <= 15""",
        "leave_one_out": _leave_one_out(),
        "misclassified": f"""WITH {SCORED} SELECT doc_id, label AS true_label, pred_label, {_r('confidence', PA, PB, PC)}, source, text AS text_snippet
FROM known WHERE label <> pred_label""",
        "error_rate": f"""WITH {SCORED} SELECT count(*) AS n, count(*) FILTER (label <> pred_label) AS errors,
  round(100.0::DOUBLE * count(*) FILTER (label <> pred_label) / count(*), 6) AS percent FROM known""",
        "propose_labels": f"""{agreed} SELECT s.doc_id, pred_label AS proposed_label, {_r('confidence')}, round({EXACT}, 6) AS entropy, true AS consistent
FROM scored s JOIN votes v ON s.doc_id = v.doc_id WHERE label IS NULL AND confidence >= 0.5 AND kinds = 1""",
        "class_keywords": f"""WITH {CLEAN}, class_docs AS (SELECT label AS class_name, text FROM clean WHERE label IS NOT NULL),
{_keywords('class_docs', 'class_name', 20)}""",
        "doc_keywords": f"WITH {CLEAN}, {_keywords('clean', 'doc_id', 5)}",
        "mmr_select": _mmr(5, 0.5),
        "mmr_relevance_only": _mmr(5, 0.0),
        "union_files": f"""WITH {DOCS} SELECT doc_id, source, date, CAST(NULL AS VARCHAR) AS url FROM docs
UNION ALL SELECT page_id, NULL, NULL, url FROM pages""",
        # The steps by their closed form: the largest mean from the left of the least mean to the right.
        "isotonic_calibration": f"""WITH {SCORED}, points AS (SELECT round(confidence, 2) AS x, count(*) AS w,
  sum(CASE WHEN label = pred_label THEN 1.0::DOUBLE ELSE 0 END) AS t FROM known GROUP BY round(confidence, 2)),
placed AS (SELECT *, row_number() OVER (ORDER BY x) AS k, sum(w) OVER (ORDER BY x) AS cw, sum(t) OVER (ORDER BY x) AS ct FROM points),
means AS (SELECT a.k AS a, b.k AS b, (b.ct - a.ct + a.t) / (b.cw - a.cw + a.w) AS m FROM placed a JOIN placed b ON a.k <= b.k),
least AS (SELECT p.k, a, min(m) AS m FROM placed p JOIN means ON a <= p.k AND b >= p.k GROUP BY p.k, a),
fitted AS (SELECT k, round(max(m), 9) AS v FROM least GROUP BY k),
steps AS (SELECT min(x) AS lower, max(x) AS upper, sum(w)::DOUBLE AS weight, sum(t) / sum(w) AS value FROM placed JOIN fitted USING (k) GROUP BY v)
SELECT CAST(row_number() OVER (ORDER BY lower) AS INTEGER) AS step, {_r('lower', 'upper', 'weight', 'value')} FROM steps""",
        "predict_proba": f"WITH {PROBA} SELECT doc_id, {_r(PA, PB, PC)} FROM proba",
        "score_documents": f"""WITH {PROBA} SELECT p.doc_id, c.source, pred_label, {_r(PA, PB, PC, 'polarity_score', 'entropy')}
FROM predicted p JOIN clean c ON p.doc_id = c.doc_id""",
        "balanced_weights": f"""WITH {LABELED}, k AS (SELECT label, count(*) AS count FROM labeled WHERE label IS NOT NULL GROUP BY label)
SELECT label, count, round((SELECT sum(count) FROM k) / ((SELECT count(*) FROM k) * count), 6) AS weight FROM k""",
        "stream_score": f"WITH {PROBA} SELECT doc_id, pred_label, {_r(PA, PB, PC, 'polarity_score', 'entropy')} FROM predicted",
    }
    prepared_scores = f"""WITH {PROBA}, {prep_all},
scored AS (SELECT p.*, q.source, q.lang, q.region FROM predicted p JOIN prepared q ON p.doc_id = q.doc_id), {_report(('lang', 'source', 'region'))} SELECT * FROM report"""
    out["scored_group_report"] = prepared_scores
    return out
