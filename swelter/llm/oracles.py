"""DuckDB SQL for the training-data queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[^\x20\x09-\x0D]+"

CHAT = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
    sized AS (SELECT *, length(regexp_replace(role, '(\\|<s>|</s>|\[INST\]|\[/INST\])', '\\\1', 'g')) + length(regexp_replace(text, '(\\|<s>|</s>|\[INST\]|\[/INST\])', '\\\1', 'g')) + length('<s>[INST][/INST]</s>') AS size FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_BLANK}') AS w FROM documents),
    s AS (SELECT DISTINCT rid, doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d),
    n AS (SELECT rid, doc_id, count(*) AS n FROM s GROUP BY 1, 2),
    p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
    c AS (SELECT r.a AS rid, min(d.doc_id) AS m FROM r JOIN d ON d.rid = r.b GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(c.m, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.rid = d.rid LEFT JOIN c ON c.rid = d.rid
"""

LEAKS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS w FROM benchmark) WHERE len(w) > 0),
    iw AS (SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(list_slice(w, k, k + n - 1), ' '))) AS g FROM i),
    dw AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS k, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(list_slice(w, k, k + n - 1), ' '))) AS g FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n),
    h AS (SELECT rid, k, dw.n, item FROM dw JOIN iw ON iw.n = dw.n AND iw.g = dw.g),
    c AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS place FROM h) GROUP BY 1),
    t AS (SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM h GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"
#: crc32 bit by bit over the digits; the first step only brings the start value in.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))))"""

MERKLE = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, lang, {_LEAF.format(n_chars="n_chars")} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_LEAF.format(n_chars="n_chars + 1")} END AS t FROM documents),
    p AS (SELECT rid, doc_id, leaf, t, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS j, count(*) OVER (PARTITION BY lang) AS c FROM d),
    n(l, g, j, c, h) AS (SELECT 0, g, j, c, leaf FROM p UNION ALL SELECT l + 1, g, j // 2, (max(c) + 1) // 2, sha256(string_agg(h, '' ORDER BY j)) FROM n WHERE c > 1 GROUP BY l, g, j // 2),
    s AS (SELECT g, l AS deep, h FROM n WHERE c = 1),
    u(l, j, c, h) AS (SELECT 0, g, count(*) OVER (), h FROM s UNION ALL SELECT l + 1, j // 2, (max(c) + 1) // 2, sha256(string_agg(h, '' ORDER BY j)) FROM u WHERE c > 1 GROUP BY l, j // 2),
    steps AS (SELECT p.rid, x.l, coalesce(n.h, '') AS h, (p.j >> x.l) & 1 = 1 AS before FROM p JOIN s USING (g) JOIN (SELECT DISTINCT l FROM n) x ON x.l < s.deep LEFT JOIN n ON n.l = x.l AND n.g = p.g AND n.j = xor(p.j >> x.l, 1)
        UNION ALL SELECT p.rid, s.deep + x.l, coalesce(u.h, ''), (p.g >> x.l) & 1 = 1 FROM p JOIN s USING (g) JOIN (SELECT DISTINCT l FROM u WHERE c > 1) x ON true LEFT JOIN u ON u.l = x.l AND u.j = xor(p.g >> x.l, 1)),
    proofs AS (SELECT rid, sha256(string_agg(h, '' ORDER BY l)) AS proof, max(l) AS top FROM steps GROUP BY 1),
    f(rid, l, h) AS (SELECT rid, 0, coalesce(t, leaf) FROM p UNION ALL SELECT f.rid, f.l + 1, sha256(CASE WHEN before THEN steps.h || f.h ELSE f.h || steps.h END) FROM f JOIN steps ON steps.rid = f.rid AND steps.l = f.l),
    e AS (SELECT rid, arg_max(h, l) AS h FROM f GROUP BY 1),
    r AS (SELECT h AS root FROM u WHERE c = 1)
SELECT doc_id, leaf, s.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = root AS verified
FROM p JOIN s USING (g) JOIN e USING (rid) LEFT JOIN proofs USING (rid) CROSS JOIN r
"""

ORACLES: dict[str, str] = {"op6_chat_format": CHAT, "op7_near_duplicates": NEAR, "op8_decontamination": LEAKS, "op13_merkle_manifest": MERKLE}
