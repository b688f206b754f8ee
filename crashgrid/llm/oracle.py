"""DuckDB SQL for the queries that SQL can express, written from their contracts.

Not here, since SQL cannot express them: op2 (XXH64), op4, op5 and op9 (trained
models), op6 and op13 (tokenizers) and the pipeline, which holds op4 and op6. Tests hold
those against brute force or held-out rows.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# The stop words, thresholds and patterns of op1 and op10 are written out here, not
# taken from the code they check.
_STOP_WORDS = (
    "the of and to in is that it for on was be with as by this are or an at from le la les de des du et en un une que qui pour par au aux est "
    "der die das und ist von zu mit den ein eine auf nicht dem für el los las y del se por con una su al es lo"
)
_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(_STOP_WORDS.split()))

OP1 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM documents),
pos AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
five AS (
  SELECT doc_id, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s
  FROM pos WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM five WHERE s IS NOT NULL),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(l)::BIGINT AS n_lines, len(list_filter(w, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_alpha_words,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{{C0}}-\x{{24F}}]')))::BIGINT AS n_latin_words,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x09-\x0D\x20]*[-*•‣◦·–]')))::BIGINT AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '([.][.][.]|…)[\x09-\x0D\x20]*$')))::BIGINT AS n_ellipsis_lines
  FROM d LEFT JOIN rep USING (doc_id)),
r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_words > 0 THEN n_alpha_words / n_words ELSE 0 END AS alpha_word_ratio,
         CASE WHEN n_lines > 0 THEN n_words / n_lines ELSE 0 END AS words_per_line,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
         CASE WHEN n_lines > 0 THEN n_bullet_lines / n_lines ELSE 0 END AS bullet_line_ratio,
         CASE WHEN n_lines > 0 THEN n_ellipsis_lines / n_lines ELSE 0 END AS ellipsis_line_ratio
  FROM m),
f AS (
  SELECT *, concat_ws(',',
    CASE WHEN n_words < 10 THEN 'n_words' END,
    CASE WHEN mean_word_chars < 2 OR mean_word_chars > 20 THEN 'mean_word_chars' END,
    CASE WHEN symbols_per_word > 0.1 THEN 'symbols_per_word' END,
    CASE WHEN stop_word_ratio < 0.01 AND n_words >= 30 AND 2 * n_latin_words >= n_words THEN 'stop_word_ratio' END,
    CASE WHEN alpha_word_ratio < 0.6 AND n_words >= 30 THEN 'alpha_word_ratio' END,
    CASE WHEN words_per_line < 2 AND n_words >= 30 THEN 'words_per_line' END,
    CASE WHEN dup_line_ratio > 0.5 THEN 'dup_line_ratio' END,
    CASE WHEN bullet_line_ratio > 0.9 AND n_words >= 30 THEN 'bullet_line_ratio' END,
    CASE WHEN ellipsis_line_ratio > 0.3 AND n_words >= 30 THEN 'ellipsis_line_ratio' END) AS failed_rules
  FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, n_lines, n_stop_words, n_alpha_words, n_latin_words, n_bullet_lines, n_ellipsis_lines, failed_rules
FROM f
"""

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP3 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i+m-1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM bs)),
ds AS (SELECT doc_id, w, m, unnest(range(1, greatest(len(w) - m + 2, 1))) AS i FROM d, (SELECT DISTINCT m FROM bs)),
h AS (SELECT doc_id, i, ds.m, item_id FROM ds JOIN bw ON bw.m = ds.m AND bw.win = array_to_string(w[i:i+ds.m-1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS l FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(l), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
q AS (SELECT *, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS last FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(h, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM q
"""

OP8 = """
WITH t AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
d AS (SELECT doc_id, x, length(x) // 2 AS n FROM t),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, greatest(n - 49, 0))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS b FROM (SELECT doc_id, i FROM w JOIN f USING (s) WHERE first < doc_id)),
r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE prev IS NULL OR prev < b - 1) AS n_spans
      FROM (SELECT doc_id, b, lag(b) OVER (PARTITION BY doc_id ORDER BY b) AS prev FROM c) GROUP BY doc_id),
g AS (SELECT doc_id, list(b) AS l FROM c GROUP BY doc_id),
a AS (SELECT doc_id, i, substr(x, 2 * i + 1, 2) AS y FROM (SELECT d.*, unnest(range(0, n)) AS i FROM d JOIN g USING (doc_id))),
k AS (SELECT a.doc_id, coalesce(string_agg(y, '' ORDER BY i) FILTER (WHERE c.b IS NULL), '') AS x
      FROM a LEFT JOIN c ON a.doc_id = c.doc_id AND a.i = c.b GROUP BY a.doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(from_hex(coalesce(k.x, d.x))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""

_KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")
_ROLES = ("secret", "access", "secret", "access", "secret", "endpoint")
_GIVEN = r"[\"']?\x20*[:=]\x20*[\"']?"
_PATTERNS = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    + _GIVEN + "([A-Za-z0-9+/_.=-]+)",
    "AKIA[A-Z0-9]{16,}",
    "[0-9a-f]{24,}",
    "A[KS]IA[A-Z0-9]{8,}|(user|username|login|client_id|access_key_id|account_id|USER|USERNAME|LOGIN|CLIENT_ID|ACCESS_KEY_ID|ACCOUNT_ID)"
    + _GIVEN + "[A-Za-z0-9_.@-]{3,}",
    "(pwd|pass|key|credential|signature|PWD|PASS|KEY|CREDENTIAL|SIGNATURE)" + _GIVEN + "[A-Za-z0-9+/_.=-]{4,}|[A-Za-z0-9+/]{32,}",
    "(http|https|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9_.:@/-]{4,}|(host|server|endpoint|HOST|SERVER|ENDPOINT)"
    + _GIVEN + "[A-Za-z0-9_.:/-]{4,}",
)


def _spans_sql(rank: int, pattern: str) -> str:
    p = pattern.replace("'", "''")
    value = f"regexp_extract_all(t, '{p}', 2)" if rank == 0 else "NULL::VARCHAR[]"
    drop = "WHERE length(value[k]) >= 6" if rank == 0 else ""
    return f"""
  SELECT doc_id, start, {rank} AS rank, start + length(m[k]) AS stop FROM (
    SELECT *, (list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0))::INT AS start
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM (
      SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS m, string_split_regex(t, '{p}') AS g, {value} AS value
      FROM d WHERE regexp_matches(t, '{p}')))) {drop}"""


def _case(values: tuple[str, ...]) -> str:
    return "CASE rank " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


OP10 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(_spans_sql(r, p) for r, p in enumerate(_PATTERNS))}),
parts AS (
  SELECT *, {_case(_ROLES)} AS role FROM s
  WHERE rank < 3 OR NOT EXISTS (
    FROM s AS o WHERE o.doc_id = s.doc_id AND o.rank < 3 AND s.start < o.stop AND o.start < s.stop)),
judged AS (
  SELECT w.doc_id, w.start, w.rank, w.stop, bool_or(p.role = 'access') AS access, bool_or(p.role = 'secret') AS secret
  FROM parts w JOIN parts p ON w.doc_id = p.doc_id AND greatest(p.start - w.stop, w.start - p.stop) <= 200
  WHERE w.rank >= 3 GROUP BY ALL),
linked AS (
  SELECT doc_id, start, rank, stop FROM judged
  WHERE CASE rank WHEN 3 THEN secret WHEN 4 THEN access ELSE access AND secret END),
every AS (SELECT doc_id, start, rank, stop FROM parts WHERE rank < 3 UNION ALL FROM linked),
told AS (
  SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS a, count(*) FILTER (WHERE rank = 1) AS c, count(*) FILTER (WHERE rank = 2) AS h,
         string_agg({_case(_KINDS)} || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
         string_agg({_case(_KINDS)} || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (doc_id)
"""

OP11 = """
WITH RECURSIVE
crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
d AS (
  SELECT doc_id, lang, n_chars, row_number() OVER () AS rid,
    CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END
    || CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END
    || CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END AS tail
  FROM documents),
e AS (
  SELECT rid, doc_id, lang,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END || tail) AS leaf,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen((n_chars + 1)::VARCHAR), ':', n_chars + 1) END || tail) AS bumped,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS struck
  FROM d, crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM e),
nodes AS (
  SELECT lang, 0 AS lvl, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, idx // 2, n),
subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, idx, n, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 2, n),
ways AS (
  SELECT l.rid, a.lvl AS step,
    CASE WHEN a.idx % 2 = 1 THEN s.digest || '|' ELSE '|' || coalesce(s.digest, '') END AS sibling
  FROM leaves l
  JOIN nodes a ON a.lang IS NOT DISTINCT FROM l.lang AND a.n > 1 AND a.idx = l.idx >> a.lvl
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM a.lang AND s.lvl = a.lvl AND s.idx = xor(a.idx, 1)
  UNION ALL
  SELECT l.rid, 1000 + a.lvl,
    CASE WHEN a.idx % 2 = 1 THEN s.digest || '|' ELSE '|' || coalesce(s.digest, '') END
  FROM leaves l
  JOIN subroots g ON g.lang IS NOT DISTINCT FROM l.lang
  JOIN tops a ON a.n > 1 AND a.idx = g.idx >> a.lvl
  LEFT JOIN tops s ON s.lvl = a.lvl AND s.idx = xor(a.idx, 1)),
proofs AS (SELECT rid, list(sibling ORDER BY step) AS way FROM ways GROUP BY rid),
folded AS (
  SELECT l.*, g.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root, coalesce(p.way, []) AS way,
    list_reduce(list_prepend(CASE WHEN struck THEN bumped ELSE leaf END, coalesce(p.way, [])),
      lambda c, x: sha256(split_part(x, '|', 1) || c || split_part(x, '|', 2))) AS folded_root
  FROM leaves l JOIN subroots g ON g.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs p USING (rid))
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(way, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""

OP12 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *,
    replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') AS escaped,
    replace(replace(replace(replace(role, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), ':', '\:') AS escaped_role
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || escaped_role || ':' || chr(10) || escaped || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op3_decontamination": OP3,
    "op7_warc": OP7,
    "op8_suffix_dedup": OP8,
    "op10_secret_scan": OP10,
    "op11_merkle_manifest": OP11,
    "op12_chat_format": OP12,
}
