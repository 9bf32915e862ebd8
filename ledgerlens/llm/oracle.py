"""DuckDB SQL for the queries that SQL can express; the others are tested
against brute force, a round trip or held-out accuracy (tests/llm)."""

from __future__ import annotations

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: CRC-32 in SQL: the table, and the checksum of a text column's bytes with the table as column t.
_CRC_TABLE = """(SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) t)"""


def _crc32(col: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({col}))),
    lambda i: ('0x' || substr(hex(encode({col})), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""


ORACLE_SQL = {
    "op2_poisson_mixing": """
WITH n AS (SELECT source s, count(*) n FROM documents GROUP BY source),
r AS (SELECT s, (1.0::DOUBLE / (SELECT count(*) FROM n)) * (SELECT sum(n) FROM n) / n rate FROM n),
q AS (SELECT s, rate, greatest(1, ceil(rate / 50.0))::INT pieces, rate / greatest(1, ceil(rate / 50.0)) m FROM r),
p AS (SELECT s, k, exp(k * ln(m) - m - lgamma(k + 1)) p FROM q, range(0, 151) t(k)),
c AS (SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) c FROM p),
d AS (SELECT documents.*, coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, ''))) who FROM documents),
u AS (SELECT d.*, ((('0x' || substr(md5('mix:' || i || ':' || who), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 u
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.s, unnest(range(1, pieces + 1)) t(i)),
k AS (SELECT who, u.source, sum((SELECT count(*) FROM c WHERE c.s IS NOT DISTINCT FROM u.source AND c.c < u.u)) copies
      FROM u GROUP BY who, u.source)
SELECT doc_id, text, lang, d.source, n_chars, copy, md5('mix:at:' || copy || ':' || d.who) AS position
FROM d JOIN k ON d.who = k.who AND d.source IS NOT DISTINCT FROM k.source, unnest(range(1, copies::BIGINT + 1)) t(copy)
""",
    "op4_warc_bundles": """
WITH p AS (SELECT page_id, coalesce(html, '') h, sha1(coalesce(html, '')) s FROM pages),
f AS (SELECT s, min(page_id) AS response FROM p GROUP BY s)
SELECT page_id, octet_length(encode(h)) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
           (((('0x' || substr(s, 1 + 5 * (k // 4)::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM p JOIN f USING (s)
""",
    "op7_benchmark_decontamination": rf"""
WITH b AS (SELECT item_id::VARCHAR item, {_WORDS} w FROM benchmark),
win AS (SELECT DISTINCT item, list_slice(w, i, i + least(len(w), 10) - 1) g
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} w FROM documents),
sizes AS (SELECT DISTINCT len(g) k FROM win),
dg AS (SELECT doc_id, k, i, list_slice(w, i, i + k - 1) g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) i FROM d, sizes WHERE len(w) >= k)),
m AS (SELECT doc_id, i, k, item FROM dg JOIN win USING (g)),
hit AS (SELECT doc_id, count(DISTINCT pos) n_hit
        FROM (SELECT doc_id, unnest(range(i, i + k)) pos FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id),
exact AS (SELECT DISTINCT doc_id, item FROM m),
items AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) list FROM exact GROUP BY doc_id),
terms AS (SELECT t, count(*) n FROM (SELECT unnest(w) t FROM d) GROUP BY t),
long_win AS (SELECT item, g, row_number() OVER () win FROM win WHERE len(g) = 10),
slot AS (SELECT win, o, g[o] t FROM long_win, range(1, 11) r(o)),
anchor AS (SELECT win, o, t FROM slot LEFT JOIN terms USING (t)
           QUALIFY row_number() OVER (PARTITION BY win ORDER BY coalesce(n, 0), o) <= 3),
place AS (SELECT doc_id, unnest(w) t, generate_subscripts(w, 1) pos FROM d),
cand AS (SELECT DISTINCT doc_id, win, pos - o + k AS b FROM anchor JOIN place USING (t), range(-1, 4) r(k)),
close AS (SELECT DISTINCT doc_id, item FROM cand JOIN long_win USING (win) JOIN d USING (doc_id)
          WHERE b >= 1 AND b <= len(w) - 9
          AND len(list_filter(range(1, 11), lambda o: list_contains(list_slice(w, greatest(b + o - 3, 1), b + o + 1), g[o]))) >= 8),
near AS (SELECT doc_id, count(*) n_near FROM close ANTI JOIN exact USING (doc_id, item) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near_items
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
""",
    "op10_line_dedup": """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) x, generate_subscripts(string_split(text, chr(10)), 1) i
           FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, i, trim(x, ' ' || chr(9) || chr(13)) l FROM l),
w AS (SELECT doc_id, i, l, lead(i, 1) OVER d i1, lead(l, 1) OVER d l1, lead(i, 2) OVER d i2, lead(l, 2) OVER d l2
      FROM t WHERE l <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
o AS (SELECT *, row_number() OVER (PARTITION BY l, l1, l2 ORDER BY doc_id NULLS FIRST, i) n FROM w WHERE i2 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest([i, i1, i2]) i FROM o WHERE n > 1),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) x FROM l ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) n FROM l GROUP BY doc_id),
g AS (SELECT doc_id, count(*) n FROM gone GROUP BY doc_id)
SELECT documents.doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept.x, '') END AS text,
       coalesce(n.n, 0) AS n_lines, coalesce(g.n, 0) AS n_removed
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id)
""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({_FOLDED}, '[a-z\x{{C0}}-\x{{FF}}]+')) run FROM documents),
g AS (SELECT doc_id, run, coalesce(doc_id::VARCHAR, 'null') || ':' || run k, count(*) c FROM r GROUP BY doc_id, run),
h AS (SELECT run, c, {_crc32("k")} h FROM g, {_CRC_TABLE} crc),
v AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
             ELSE run END word, sum(c)::BIGINT n FROM h GROUP BY 1 HAVING sum(c) >= 3 AND length(word) >= 5),
d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) x
      FROM (SELECT word, unnest(range(1, length(word) + 1))::INT i FROM v)),
p AS (SELECT a.word a, b.word b FROM d a JOIN d b USING (x, i) WHERE a.word <> b.word
      UNION SELECT word, x FROM d UNION SELECT x, word FROM d),
m AS (SELECT p.a word, v.n, w.word form, w.n form_n FROM p JOIN v ON p.a = v.word JOIN v w ON p.b = w.word),
f AS (SELECT word, count(*) n_near, first(form ORDER BY form_n DESC, form) form, first(form_n ORDER BY form_n DESC, form) form_n
      FROM m GROUP BY word),
o AS (SELECT v.word, n, coalesce(n_near, 0) n_near, CASE WHEN form_n >= 2 * n THEN form END form,
             CASE WHEN form_n >= 2 * n THEN form_n END form_n FROM v LEFT JOIN f USING (word)),
w AS (SELECT word, word top FROM o UNION ALL SELECT w.word, o.form FROM w JOIN o ON w.top = o.word WHERE o.form IS NOT NULL)
SELECT o.*, w.top AS root FROM o JOIN w USING (word) JOIN o last ON w.top = last.word WHERE last.form IS NULL
""",
    "op12_importance_resampling": rf"""
WITH a AS (SELECT doc_id, row_number() OVER () i, {_WORDS} w FROM documents),
u AS (SELECT i, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) x FROM a),
b AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) x
      FROM (SELECT {_WORDS} w FROM benchmark)),
f AS (SELECT i, x, count(*) c FROM u GROUP BY i, x),
x AS (SELECT x, {_crc32("x")} % 10000 bucket FROM (SELECT x FROM u UNION SELECT x FROM b), {_CRC_TABLE} crc),
s AS (SELECT bucket, sum(c) s FROM f JOIN x USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) t FROM b JOIN x USING (x) GROUP BY bucket),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE s_all, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE t_all),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT gain
         FROM s LEFT JOIN t USING (bucket), n),
d AS (SELECT i, sum(c)::BIGINT n_features, floor(sum(c * gain)::DOUBLE / sum(c))::BIGINT weight
      FROM f JOIN x USING (x) JOIN gain USING (bucket) GROUP BY i),
e AS (SELECT a.doc_id, i, len(w) n_words, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight,
             ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT h FROM a LEFT JOIN d USING (i)),
g AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT score FROM e),
k AS (SELECT i, row_number() OVER (ORDER BY score DESC, doc_id) place FROM g WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT count(*) FROM k) * 25 // 100 THEN place END AS rank
FROM g LEFT JOIN k USING (i)
""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
