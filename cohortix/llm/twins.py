"""DuckDB SQL of the opN queries whose method SQL can state."""

from __future__ import annotations

from .quality import VALUES, tightenings
from .spotsigs import ANCHORS

#: The words of a text, as in :data:`.common.WORD`.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D\x20]+')"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sh AS (
  SELECT DISTINCT r, array_to_string(w[p + 1:p + 5], ' ') AS s
  FROM (SELECT r, w, unnest(range(greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)),
named AS (SELECT r, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS cls FROM sh GROUP BY r),
classes AS (
  SELECT cls, min(r) AS rep, any_value(n) AS n, count(*) AS copies, min(doc_id) AS id
  FROM named JOIN d USING (r) GROUP BY cls),
x AS (SELECT cls, n, s FROM sh JOIN classes ON sh.r = classes.rep),
pairs AS (
  SELECT a.cls AS u, b.cls AS v FROM x a JOIN x b ON a.s = b.s AND a.cls < b.cls
  GROUP BY a.cls, b.cls, a.n, b.n HAVING count(*) / (a.n + b.n - count(*))::DOUBLE >= 0.8),
both_ways AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach AS (
  WITH RECURSIVE t(u, v) AS (
    SELECT cls, cls FROM classes UNION SELECT t.u, e.v FROM t JOIN both_ways e ON t.v = e.u)
  SELECT u, min(v) AS root FROM t GROUP BY u),
links AS (SELECT u, sum(copies) AS links FROM both_ways JOIN classes ON v = cls GROUP BY u),
per AS (
  SELECT cls, min(id) OVER (PARTITION BY root) AS class_id, copies - 1 + coalesce(links, 0) AS n_links
  FROM classes JOIN reach ON cls = reach.u LEFT JOIN links ON cls = links.u)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN named USING (r) LEFT JOIN per USING (cls)
"""

OP3 = """
WITH RECURSIVE steps(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS l FROM steps WHERE k = 8),
bytes AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(coalesce(text, '')) AS th,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents),
d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS src, len(b) + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, b),
      lambda a, x: xor(a >> 8, l[(xor(a, x) & 255) + 1])), 4294967295) AS crc,
    md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || th) AS h
  FROM bytes, crc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY none, src ORDER BY h, crc, size) - 1 AS rank,
    count(*) OVER (PARTITION BY none, src) AS n, count(*) OVER () AS total FROM d),
placed AS (SELECT *, (2 * rank + 1) / (2 * n)::DOUBLE AS f FROM ranked),
dealt AS (SELECT *, row_number() OVER (ORDER BY f, none, src, h, crc, size) - 1 AS pos FROM placed)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (pos * 24 // total)::INT AS shard,
  (pos - (pos * 24 // total * total + 23) // 24)::BIGINT AS slot, NULL::INT AS grown_shard
FROM dealt
"""

_VALUE = {r: v.replace(" /", "::DOUBLE /") for r, v in VALUES.items()}
_STEPS = ", ".join("(" + ", ".join([str(i), *("NULL" if c is None else f"{c}::DOUBLE" for c in s.values())]) + ")"
                   for i, s in enumerate(tightenings()))
_ABOVE = "(" + " OR ".join(f"coalesce({v} > c_{r}, false)" for r, v in _VALUE.items()) + ")"
_CUTS = ", ".join(f"c_{r}" for r in VALUES)

OP4 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '(none)') AS stratum, coalesce(text, '') AS t,
    {_WORDS} AS w FROM documents),
win AS (SELECT r, p, w[p + 1:p + 8] AS x FROM (SELECT r, w, unnest(range(len(w) - 7)) AS p FROM d)),
again AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p + k) AS n FROM again, range(8) AS t(k) GROUP BY r),
c AS (
  SELECT r, doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x09-\\x0D\\x20]')) AS lines
        FROM d) LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
steps AS (SELECT * FROM (VALUES {_STEPS}) AS v(step, {_CUTS})),
tests AS (
  SELECT stratum, step, {_CUTS}, count(*) AS n, count(*) FILTER ({_ABOVE}) AS k
  FROM f JOIN good USING (doc_id), steps WHERE NOT base_failed GROUP BY ALL),
p AS (
  SELECT *, CASE WHEN k >= 0.01 * n THEN 1.0 ELSE list_sum(list_transform(range(k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01::DOUBLE) + (n - i) * ln(0.99::DOUBLE)))) END AS pv
  FROM tests),
ends AS (
  SELECT stratum, min(step) FILTER (pv * (SELECT count(DISTINCT stratum) FROM tests) > 0.05) AS stop FROM p GROUP BY stratum),
cut AS (
  SELECT stratum, {_CUTS} FROM p JOIN ends USING (stratum) WHERE stop IS NULL OR step < stop
  QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY step DESC) = 1),
bad AS (SELECT r FROM f JOIN cut USING (stratum) WHERE {_ABOVE})
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND bad.r IS NULL AS kept
FROM f LEFT JOIN bad ON f.r = bad.r
"""

OP6 = f"""
WITH d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS src, len({_WORDS}) AS size,
    md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h FROM documents),
s AS (
  SELECT *, row_number() OVER (ORDER BY none, src) - 1 AS i FROM (
    SELECT none, src, sum(size)::BIGINT AS n FROM d GROUP BY none, src)),
w AS (SELECT *, [5, 2, 1][i % 3 + 1] AS w, 2 * n AS cap FROM s),
o AS (
  SELECT *, sum(n) OVER () AS every, row_number() OVER q AS j,
    coalesce(sum(cap) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
    sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_
  FROM w WINDOW q AS (ORDER BY cap::DOUBLE / w, i)),
v AS (SELECT *, (1.5::DOUBLE * every - full_) / left_ AS rate FROM o),
k AS (SELECT min(j) AS k, arg_min(rate, j) AS r FROM v WHERE cap::DOUBLE / w >= rate),
t AS (
  SELECT none, src, i, n, CASE WHEN k.k IS NULL OR j < k.k THEN cap::DOUBLE ELSE least(r * w, cap::DOUBLE) END AS target,
    ceil(n / 64.0)::BIGINT AS nb FROM v, k),
seats AS (
  SELECT none, src FROM (SELECT none, src, i, target, unnest(range(2 * nb)) AS q FROM t WHERE target > 0)
  ORDER BY target / (2 * q + 1) DESC, i LIMIT (SELECT coalesce(round(sum(target) / 64), 0)::BIGINT FROM t)),
q AS (
  SELECT t.none, t.src, n, target, greatest(nb, 1) AS nb, count(seats.src) AS q,
    ('0x' || substr(md5('42:first:' || t.src), 1, 12))::BIGINT % greatest(nb, 1) AS head
  FROM t LEFT JOIN seats ON t.none = seats.none AND t.src = seats.src GROUP BY ALL),
x AS (
  SELECT d.*, q.n, q.target, q.nb, q.q // q.nb AS full_, q.head, q.head + q.q % q.nb AS stop,
    coalesce(sum(size) OVER (PARTITION BY d.none, d.src ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      0) AS lo FROM d JOIN q ON d.none = q.none AND d.src = q.src)
SELECT doc_id, size::BIGINT AS size, n AS source_size, target,
  (full_ * size + greatest(0, least(lo + size, least(stop, nb) * 64) - greatest(lo, head * 64))
    + greatest(0, least(lo + size, greatest(stop - nb, 0) * 64) - lo))::BIGINT AS taken
FROM x
"""

OP7 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS ord, {_WORDS} AS w FROM documents),
win AS (
  SELECT r, ord, p, array_to_string(w[p + 1:p + 13], ' ') AS x
  FROM (SELECT r, ord, w, unnest(range(len(w) - 12)) AS p FROM d)),
hit AS (SELECT r, p FROM (SELECT r, p, ord, min(ord) OVER (PARTITION BY x) AS least_ord FROM win) WHERE least_ord < ord),
gone AS (SELECT DISTINCT r, p + k AS i FROM hit, range(13) AS t(k)),
word AS (SELECT r, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS x FROM d),
stay AS (
  SELECT r, string_agg(x, ' ' ORDER BY i) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN stay USING (r)
"""

OP10 = f"""
WITH d AS (
  SELECT doc_id, t, n, n // 4 AS k, coalesce(
    lead(t) OVER (ORDER BY doc_id NULLS LAST, md5(t)), first(t) OVER (ORDER BY doc_id NULLS LAST, md5(t))) AS nx,
    row_number() OVER (ORDER BY doc_id NULLS LAST, md5(t)) AS r
  FROM (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents)),
e AS (SELECT *, substr(t, 1, n - k) || substr(nx, 1, k) AS edited FROM d),
two AS (SELECT r, 0 AS v, t AS x FROM e UNION ALL SELECT r, 1, edited FROM e),
w AS (SELECT r, v, list_filter(regexp_split_to_array(lower(x), '[^\\p{{L}}\\p{{N}}]+'), lambda y: y <> '') AS w FROM two),
c AS (
  SELECT *, list_filter(w, lambda y: NOT list_contains(an, y)) AS c,
    list_filter(range(len(w)), lambda i: list_contains(an, w[i + 1])) AS a
  FROM w, (SELECT {list(dict.fromkeys(ANCHORS))} AS an)),
s AS (
  SELECT r, v, w, list_filter(list_transform(range(len(a)), lambda j: CASE WHEN a[j + 1] - j < len(c)
    THEN substr(md5(w[a[j + 1] + 1] || ' ' || array_to_string(c[a[j + 1] - j + 1:a[j + 1] - j + 3], ' ')), 1, 16) END),
    lambda y: y IS NOT NULL) AS s FROM c),
f AS (
  SELECT r, v, list_sort(list_distinct(CASE WHEN len(s) > 0 THEN s WHEN len(w) > 0 THEN list_transform(
    range(greatest(1, len(w) - 3)), lambda i: substr(md5(array_to_string(w[i + 1:i + 4], ' ')), 1, 16)) ELSE [] END)) AS s
  FROM s),
z AS (
  SELECT e.*, f.s AS s, g.s AS es, h.s AS ns FROM e JOIN f ON f.r = e.r AND f.v = 0 JOIN f g ON g.r = e.r AND g.v = 1
  JOIN f h ON h.v = 0 AND h.r = CASE WHEN e.r = (SELECT count(*) FROM e) THEN 1 ELSE e.r + 1 END),
j AS (SELECT *, len(list_intersect(s, es)) AS ie, len(list_intersect(s, ns)) AS i_n FROM z)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(s, '') AS fingerprint,
  array_to_string(es, '') AS edited_fingerprint,
  CASE WHEN len(s) + len(es) = 0 THEN 1.0 ELSE ie / (len(s) + len(es) - ie)::DOUBLE END AS near_edited,
  CASE WHEN len(s) + len(ns) = 0 THEN 1.0 ELSE i_n / (len(s) + len(ns) - i_n)::DOUBLE END AS near_next
FROM j
"""


def _codes(books: str) -> str:
    """Nearest entry of each part in a codebook table (ties: the lower entry)."""
    return f"""(
  SELECT rid, part, any_value(s) AS s, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM (
    SELECT x.rid, x.part, x.s, b.entry,
      list_sum(list_transform(list_zip(x.s, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM x JOIN {books} b ON x.part = b.part) GROUP BY rid, part)"""


def _moved(codes: str, books: str) -> str:
    """The codebooks after a round: floor(sum / count) of each entry's parts, unused entries as they were."""
    return f"""(
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM {books} b LEFT JOIN (
    SELECT part, entry, list(v ORDER BY i) AS e FROM (
      SELECT part, entry, i, floor(sum(s[i]) / count(*))::BIGINT AS v
      FROM (SELECT part, entry, s, unnest(range(1, len(s) + 1)) AS i FROM {codes}) GROUP BY part, entry, i)
    GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)"""


OP13 = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
x AS MATERIALIZED (
  SELECT rid, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS s
  FROM v, (SELECT unnest(range(16)) AS part)),
b0 AS (SELECT part, rid - 1 AS entry, s AS e FROM x WHERE rid <= 64),
c0 AS MATERIALIZED {_codes("b0")},
b1 AS MATERIALIZED {_moved("c0", "b0")},
c1 AS MATERIALIZED {_codes("b1")},
b2 AS MATERIALIZED {_moved("c1", "b1")},
c2 AS MATERIALIZED {_codes("b2")},
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM c2 GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM coded JOIN v USING (rid)
"""

SQL = {
    "op1_chosen_path_join": OP1,
    "op3_stratified_sharding": OP3,
    "op4_quality_rules": OP4,
    "op6_sainte_lague_mix": OP6,
    "op7_fm_index_dedup": OP7,
    "op10_spotsigs": OP10,
    "op13_gnat_codes": OP13,
}
