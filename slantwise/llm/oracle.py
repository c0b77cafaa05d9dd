"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"'[^\x20\x09-\x0D]+'"
ALPHANUMERIC = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

NGRAM_JACCARD_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({FOLDED}, {SPACED}) AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) END AS grams
  FROM w
), sizes AS (SELECT doc_id, len(grams) AS n FROM s),
flat AS (SELECT doc_id, unnest(grams) AS gram FROM s),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM flat a JOIN flat b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
)
SELECT doc_id, n::BIGINT AS n_shingles, component_id
FROM sizes JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id
"""

MIX_SOURCES = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {SPACED}))::BIGINT AS size,
    ('0x' || left(md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(md5(text), '')), 15))::BIGINT AS mark
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM src
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM weighed
), level AS (
  SELECT r.*, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::BIGINT AS room,
    (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS units
  FROM ranked r WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), first_fit AS (
  SELECT k, room, units FROM level WHERE 3 * source_size * units >= room * weight ORDER BY k LIMIT 1
), targets AS (
  SELECT l.source, l.source_size,
    CASE WHEN l.k >= f.k THEN f.room::DOUBLE / f.units * l.weight ELSE 3.0 * l.source_size END::DOUBLE AS target
  FROM level l, first_fit f
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets
), placed AS (
  SELECT d.*, p.source_size, p.target, p.whole, floor(p.target)::BIGINT - p.whole * p.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (whole * size + greatest(0, least(size, rest - coalesce(before, 0))))::BIGINT AS taken
FROM placed
"""

HOST_QUALITY = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {SPACED}) AS words FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS pos, unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS gram
  FROM d WHERE len(words) >= 8
), twice AS (
  SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), hits AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n FROM twice, range(8) t(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d
), doubled AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE len(regexp_extract_all(line, {SPACED})) > 0 GROUP BY doc_id
), counted AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words, list_sum(list_transform(words, lambda x: length(x)))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(doubled.n, 0)::BIGINT AS n_dup_lines, coalesce(hits.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN doubled USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
), hosts AS (
  SELECT source, count(*) AS pages, count(*) FILTER (base_failed) AS failures FROM judged GROUP BY source
), moments AS (
  SELECT sum(failures) / sum(pages) AS mean, sum(failures * failures / pages) / sum(pages) - (sum(failures) / sum(pages)) ** 2 AS spread FROM hosts
), prior AS (
  SELECT mean, CASE WHEN spread > 1e-12 THEN greatest(mean * (1 - mean) / spread - 1, 0) END AS strength FROM moments
), rates AS (
  SELECT source, CASE WHEN strength IS NULL THEN mean ELSE (failures + strength * mean) / (pages + strength) END AS rate FROM hosts, prior
)
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate <= 0.5 AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

BENCHMARK_LEAKS = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({FOLDED}, {ALPHANUMERIC}) AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({FOLDED}, {ALPHANUMERIC}) AS words FROM benchmark
), items AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size,
    unnest(list_transform(range(1, len(words) - least(10, len(words)) + 2), lambda i: array_to_string(words[i:i + least(10, len(words)) - 1], ' '))) AS gram
  FROM b WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM items),
places AS (
  SELECT doc_id, size, unnest(range(1, len(words) - size + 2)) AS pos,
    unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS gram
  FROM d, sizes WHERE len(words) >= size
), found AS (SELECT doc_id, pos, size, item_id FROM places JOIN items USING (size, gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
  sha256(coalesce(named.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

BREAKING = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul|body|head|html"
SITE_LINES = rf"""
WITH read AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'),
      '(?is)</?(?:{BREAKING})(?:\s[^>]*)?/?>', chr(10), 'g'), '(?s)<[^>]*>', '', 'g') AS text
  FROM pages
), split AS (
  SELECT page_id, host, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
    lambda x: regexp_replace(x, '^[\x20\t\r]+|[\x20\t\r]+$', '', 'g')), lambda x: x <> '') AS lines FROM read
), totals AS (SELECT host, count(*) AS pages FROM read GROUP BY host),
marks AS (SELECT DISTINCT page_id, host, unnest(lines) AS line FROM split),
frequent AS (
  SELECT m.host, line FROM marks m JOIN totals t ON m.host IS NOT DISTINCT FROM t.host
  GROUP BY m.host, line, t.pages HAVING count(*) >= 3 AND count(*) > 0.1 * t.pages
), dropped AS (SELECT host, list(line) AS lines FROM frequent GROUP BY host),
stay AS (
  SELECT page_id, s.host, s.lines, list_filter(s.lines, lambda x: NOT list_contains(coalesce(d.lines, []), x)) AS kept
  FROM split s LEFT JOIN dropped d ON s.host IS NOT DISTINCT FROM d.host
)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM stay
"""

def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)"
    bit = "lambda c, k: xor(c >> 1, 3988292384::UBIGINT * (c & 1))"
    byte = f"lambda a, b: list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), {bit})"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), {byte}), 4294967295::UBIGINT)"


# Level 0 to 39 are the trees of the languages, 40 and up the tree of their roots.
MERKLE_MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT *, sha256(concat({', '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', 'text')))})) AS leaf,
    CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS found
  FROM documents
), leaves AS (
  SELECT doc_id, leaf, sha256(concat({', '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', 'found')))})) AS changed,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n
  FROM d
), lower_nodes AS (
  SELECT 0 AS level, tree, idx, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT level + 1, tree, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM lower_nodes WHERE n > 1 GROUP BY level, tree, idx // 8, n
), subroots AS (SELECT tree, hash, level FROM lower_nodes WHERE n = 1),
upper_nodes AS (
  SELECT 40 AS level, -1::BIGINT AS tree, tree AS idx, count(*) OVER () AS n, hash FROM subroots
  UNION ALL
  SELECT level + 1, tree, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM upper_nodes WHERE n > 1 GROUP BY level, tree, idx // 8, n
), nodes AS (SELECT * FROM lower_nodes UNION ALL SELECT * FROM upper_nodes),
runs AS (
  SELECT level, tree, idx // 8 AS run, list(hash ORDER BY idx) AS hashes FROM nodes WHERE n > 1 GROUP BY ALL
), folded AS (
  SELECT doc_id, level, tree, idx, n, changed AS hash, '' AS proof
  FROM (SELECT doc_id, changed, 0 AS level, tree, idx, n FROM leaves)
  UNION ALL
  SELECT doc_id,
    CASE WHEN f.n = 1 THEN 40 ELSE f.level + 1 END,
    CASE WHEN f.n = 1 THEN -1 ELSE f.tree END,
    CASE WHEN f.n = 1 THEN f.tree ELSE f.idx // 8 END,
    CASE WHEN f.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (f.n + 7) // 8 END,
    CASE WHEN f.n = 1 THEN f.hash ELSE sha256(array_to_string(hashes[:f.idx % 8], '') || f.hash || array_to_string(hashes[f.idx % 8 + 2:], '')) END,
    CASE WHEN f.n = 1 THEN f.proof ELSE f.proof || array_to_string(hashes[:f.idx % 8], '') || array_to_string(hashes[f.idx % 8 + 2:], '') END
  FROM folded f LEFT JOIN runs r ON r.level = f.level AND r.tree = f.tree AND r.run = f.idx // 8 AND f.n > 1
  WHERE NOT (f.n = 1 AND f.level >= 40)
)
SELECT l.doc_id, l.leaf, s.hash AS subroot, u.hash AS root, sha256(f.proof) AS proof_sha256, f.hash AS folded_root, f.hash = u.hash AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN folded f ON f.doc_id = l.doc_id AND f.level >= 40 AND f.n = 1
CROSS JOIN (SELECT hash FROM upper_nodes WHERE n = 1) u
"""

def _way(label: str, cost: str, letters: str) -> str:
    return f"struct_pack(c := {label}.c + {cost}, a := {label}.a || '{letters}')"


def _least(*ways: tuple[str, str, str]) -> str:
    return f"least({', '.join(_way(*w) for w in ways)})"


# Labels l0 to l3: nothing kept yet, system, user, assistant last; a closed way costs too much.
_KEEP = {k: f"CASE WHEN initial = '{k}' AND fault <> 'x' THEN late ELSE 1000000000 END" for k in "sua"}
_REROLE = "CASE WHEN fault <> 'x' THEN late + 1 ELSE 1000000000 END"
REPAIR_CONVERSATIONS = rf"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM base, (SELECT unnest([0, 1]) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    regexp_replace(text, '[ 	-]+$', '') AS bare, left(role, 1) AS initial
  FROM damaged
), met AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS step
  FROM placed
), turns AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS kind FROM met
), coded AS (
  SELECT *, CASE WHEN kind IN ('b', 'd') THEN 'x' ELSE '' END AS fault, CASE WHEN kind = 't' THEN 5 ELSE 0 END AS late FROM turns
), dp AS (
  SELECT conv_id, 0::BIGINT AS i, struct_pack(c := 0::BIGINT, a := '') AS l0, struct_pack(c := 1000000000::BIGINT, a := '') AS l1,
    struct_pack(c := 5::BIGINT, a := 'I') AS l2, struct_pack(c := 10::BIGINT, a := 'II') AS l3
  FROM (SELECT DISTINCT conv_id FROM coded)
  UNION ALL
  SELECT conv_id, i, l0, l1,
    least(l2, {_way('l0', '5', 'I')}, {_way('l1', '5', 'I')}, {_way('l3', '5', 'I')}),
    least(l3, {_way('l2', '5', 'I')}, {_way('l0', '10', 'II')}, {_way('l1', '10', 'II')})
  FROM (
    SELECT t.conv_id, t.i, {_way('l0', '2', 'D')} AS l0,
      {_least(('l1', '2', 'D'), ('l0', _KEEP['s'], 'K'))} AS l1,
      {_least(('l2', '2', 'D'), *((f'l{k}', cost, letter) for k in (0, 1, 3) for cost, letter in ((_KEEP['u'], 'K'), (_REROLE, 'R'))))} AS l2,
      {_least(('l3', '2', 'D'), ('l2', _KEEP['a'], 'K'), ('l2', _REROLE, 'R'))} AS l3
    FROM dp JOIN coded t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id AND t.i = dp.i + 1
  )
), sizes AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (kind = 'b') AS blank, count(*) FILTER (kind = 'd') AS duplicate, count(*) FILTER (kind = 't') AS truncated,
    count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id
), best AS (
  SELECT s.*, least(l0, l3).c AS cost, least(l0, l3).a AS audit FROM sizes s JOIN dp ON s.conv_id IS NOT DISTINCT FROM dp.conv_id AND i = n
), letters AS (
  SELECT conv_id, len(replace(audit, 'D', '')) % 2 AS odd, unnest(string_split(audit, '')) AS op, unnest(range(1, len(audit) + 1)) AS j
  FROM best WHERE audit <> ''
), read AS (
  SELECT *, sum(CASE WHEN op = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN op = 'D' THEN 0 ELSE 1 END) OVER w AS e
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)
), lines AS (
  SELECT r.conv_id, j, CASE WHEN op = 'K' THEN t.role WHEN (e + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN op = 'I' THEN '' ELSE t.text END AS line
  FROM read r LEFT JOIN coded t ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND t.i = r.i AND op <> 'I' WHERE op <> 'D'
), texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY j) AS text FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(texts.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM o.conv_id
"""

STATEMENTS: dict[str, str] = {
    "op2_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
    "op4_mix_sources": MIX_SOURCES,
    "op6_site_lines": SITE_LINES,
    "op8_host_quality": HOST_QUALITY,
    "op9_benchmark_leaks": BENCHMARK_LEAKS,
    "op11_merkle_manifest": MERKLE_MANIFEST,
    "op12_repair_conversations": REPAIR_CONVERSATIONS,
}


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
