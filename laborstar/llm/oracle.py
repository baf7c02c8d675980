"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS phrase FROM iw),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS phrase FROM dp, (SELECT DISTINCT n FROM win) AS lens WHERE p + n - 1 <= len(w)),
m AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN win ON dw.phrase = win.phrase AND dw.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

_ESCAPED = "replace({}, '\\', '\\\\')"
for _s in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
    _ESCAPED = f"replace({_ESCAPED}, '{_s}', '{_s[0]}\\{_s[1:]}')"

# Characters of the windows: every turn once, and the turns that later windows repeat.
OP4 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, '<|turn|>' || {_ESCAPED.format("role")} || '<|text|>' || {_ESCAPED.format("text")} || '<|end|>' || chr(10) AS f,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
n AS (SELECT *, len(regexp_extract_all(f, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\s]')) AS n, pos = 1 AND role = 'system' AS sys FROM f),
s AS (SELECT *, bool_or(sys) OVER (PARTITION BY conv_id) AS has, CASE WHEN sys THEN 0 ELSE n END AS c,
             greatest(1, floor((512 - 128 - sum(CASE WHEN sys THEN n ELSE 0 END) OVER (PARTITION BY conv_id)) / 2)) AS step,
             sum(CASE WHEN sys THEN length(f) ELSE 0 END) OVER (PARTITION BY conv_id) AS sys_chars FROM n),
p AS (SELECT *, 2 * sum(CAST(c > step AS INT)) OVER w - CAST(c > step AS INT) AS a, floor((sum(c) OVER w - c) / step) AS b,
             lag(n, 1) OVER w AS n1, lag(n, 2) OVER w AS n2, length(lag(f, 1) OVER w) AS l1, length(lag(f, 2) OVER w) AS l2
      FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
v AS (SELECT *, (NOT has OR pos > 2) AND pos > 1 AND (a, b) <> lag((a, b)) OVER (PARTITION BY conv_id ORDER BY pos) AS cut FROM p),
r AS (SELECT *, CASE WHEN cut THEN sys_chars + CASE WHEN n1 <= 128 AND NOT (has AND pos - 1 = 1) THEN l1 ELSE 0 END
                    + CASE WHEN n1 + n2 <= 128 AND NOT (has AND pos - 2 = 1) THEN l2 ELSE 0 END ELSE 0 END AS repeated FROM v)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(f) + repeated) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""

OP6 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM d WHERE len(w) >= 50),
k AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS key FROM p),
f AS (SELECT key, min(doc_id) AS first FROM k GROUP BY key),
g AS (SELECT DISTINCT doc_id, q FROM (SELECT k.doc_id, unnest(range(p, p + 50)) AS q FROM k JOIN f ON k.key = f.key WHERE k.doc_id > f.first)),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
m AS (SELECT e.*, g.q IS NOT NULL AS gone FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.q = g.q),
s AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY q) FILTER (WHERE NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""

OP10 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, {LOWER.format(f"trim(line, {BLANKS})")} AS key FROM l),
r AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= 3),
m AS (SELECT k.*, (r.key IS NOT NULL AND r.holder <> k.doc_id) AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

ORACLE = {"op2_benchmark_decontamination": OP2, "op4_chat_formatting": OP4, "op6_substring_dedup": OP6, "op10_line_dedup": OP10}
