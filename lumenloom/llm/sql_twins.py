"""SQL of the queries whose statements are long: checksums, a shortest path and near words in DuckDB."""

from __future__ import annotations

_CRC = r"""
bits AS (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS x FROM range(256) r(i)),
tab AS (SELECT list(x::BIGINT ORDER BY i) AS t FROM bits)"""


def _crc32(text: str) -> str:
    byte = f"('0x' || hex(encode({text}))[2 * j - 1:2 * j])::BIGINT"
    folded = f"list_reduce(list_prepend(4294967295, list_transform(range(1, strlen({text}) + 1), lambda j: {byte})), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))"
    return f"xor({folded}, 4294967295)"


VARIANTS_SQL = f"""
WITH {_CRC},
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT id, run, count(*) AS m FROM r WHERE length(run) >= 6 GROUP BY ALL),
h AS (SELECT run, m, {_crc32("id || ':' || run")} AS h FROM c, tab),
w AS (SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, m FROM h),
v AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
y AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM x),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM y a JOIN y b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT y.word, v.word, v.n FROM y JOIN v ON y.rest = v.word
  UNION SELECT v.word, y.word, y.n FROM y JOIN v ON y.rest = v.word),
b AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM v LEFT JOIN b USING (word)),
g AS (WITH RECURSIVE c AS (SELECT word, form, form AS root FROM f WHERE form IS NOT NULL UNION SELECT c.word, f.form, f.form FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
  SELECT c.word, c.root FROM c JOIN f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM f LEFT JOIN g USING (word)
"""


# A path of the repair is its cost in eight digits and its letters; the least string is the best path, "~" is none.
_NEXT = (2, 2, 3, 2)
_KEEP = (("s", 0, 1), ("u", 0, 2), ("u", 1, 2), ("a", 2, 3), ("u", 3, 2))


def _ahead(path: str, cost: str, letter: str) -> str:
    return f"CASE WHEN {path} = '~' THEN '~' ELSE lpad(CAST(CAST({path}[1:8] AS INT) + {cost} AS VARCHAR), 8, '0') || '{letter}' || {path}[9:] END"


def _row(state: int) -> str:
    stay = "CASE WHEN cut THEN 3 ELSE 0 END"
    kept = [f"CASE WHEN NOT gone AND initial = '{i}' THEN {_ahead(f'v{to}', stay, 'K')} ELSE '~' END" for i, at, to in _KEEP if at == state]
    rerole = f"CASE WHEN NOT gone THEN {_ahead(f'v{_NEXT[state]}', f'3 + {stay}', 'R')} ELSE '~' END"
    return f"least({', '.join([_ahead(f'v{state}', '4', 'D'), rerole, *kept])})"


_HERE = ", ".join(f"{_row(s)} AS h{s}" for s in range(4))
_ONCE = ", ".join(f"least(h{s}, {_ahead(f'h{_NEXT[s]}', '3', 'I')}) AS b{s}" for s in range(4))
_TWICE = ", ".join(f"least(h{s}, {_ahead(f'b{_NEXT[s]}', '3', 'I')}) AS v{s}" for s in range(4))

REPAIR_SQL = f"""
WITH RECURSIVE {_CRC},
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
q AS (SELECT c.*, {_crc32('k')} % 20 AS rule FROM c, tab),
d AS (SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role, CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN rule = 3 THEN 2 ELSE 1 END)) AS copy FROM q WHERE rule <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM d),
f AS (SELECT *, solid = '' AS blank, solid <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM o),
g AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS cut FROM f),
e AS (SELECT '00000000' AS h0, '~' AS h1, '~' AS h2, '00000000' AS h3),
z AS (SELECT {_TWICE} FROM (SELECT *, {_ONCE} FROM e)),
p AS (SELECT conv_id, max(i) + 1 AS i, v0, v1, v2, v3 FROM g, z GROUP BY conv_id, v0, v1, v2, v3
  UNION ALL SELECT conv_id, i, v0, v1, v2, v3 FROM (SELECT *, {_TWICE} FROM (SELECT *, {_ONCE} FROM (SELECT g.conv_id, g.i, {_HERE} FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.i = p.i - 1)))),
w AS (SELECT conv_id, CAST(v0[1:8] AS BIGINT) AS cost, v0[9:] AS audit FROM p WHERE i = 1),
l AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS nth, unnest(string_split(audit, '')) AS letter FROM w WHERE audit <> ''),
n AS (SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER r AS i, sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER r AS out FROM l WINDOW r AS (PARTITION BY conv_id ORDER BY nth)),
j AS (SELECT n.*, g.role, CASE WHEN letter = 'I' THEN '' ELSE g.text END AS text, CASE WHEN letter = 'K' THEN g.initial END AS kept FROM n LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM n.conv_id AND g.i = n.i WHERE letter <> 'D'),
y AS (SELECT *, CASE WHEN first_value(kept) OVER (PARTITION BY conv_id ORDER BY nth) = 's' THEN 1 ELSE 0 END AS lead FROM j),
x AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (out - 1 - lead) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY nth) AS repaired FROM y GROUP BY conv_id),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM k.conv_id
"""
