"""DuckDB SQL for the operators that SQL can express."""

from maskwright.llm import licenses, mixing, suffixes



def _license_rows() -> str:
    def quoted(x):
        return "'" + x.replace("'", "''") + "'"

    rows = []
    for name, text in sorted(licenses.TEMPLATES.items()):
        b = licenses.bigrams_of(text)
        lo, hi = licenses.bounds(len(b))
        rows.append(f"({quoted(name)}, [{', '.join(map(quoted, b))}], {lo}, {hi})")
    return ",\n".join(rows)


def _license_anchors() -> str:
    rows = []
    for name, text in sorted(licenses.TEMPLATES.items()):
        rows += [f"('{name}', '{pair}', {place}, {len(licenses.words_of(text))})" for pair, place in licenses.anchors_of(text)]
    return ", ".join(rows)


#: After a table l(a, b) of links both ways: for each linked row the rows that it reaches.
_REACH = """reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)"""


def _covered(name: str, length: int) -> str:
    """Tables <name>h, every start of a repeated string, and <name>, the maximal runs of what these cover."""
    return f"""{name}s AS (SELECT rn, unnest(range(0, n_bytes - {length - 1})) AS i, hx FROM d WHERE n_bytes >= {length}),
{name}m AS (SELECT rn, i, md5(substr(hx, 2 * i + 1, {2 * length})) AS m FROM {name}s),
{name}h AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY m) AS n FROM {name}m) WHERE n > 1),
{name}g AS (SELECT rn, i, sum(fresh) OVER (PARTITION BY rn ORDER BY i) AS run FROM (SELECT rn, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rn ORDER BY i) + {length} THEN 0 ELSE 1 END AS fresh FROM {name}h)),
{name} AS (SELECT rn, run, min(i) AS a, max(i) + {length} AS b FROM {name}g GROUP BY rn, run)"""


ORACLES = {
    "op1_ngram_jaccard": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rn, doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS sh FROM d),
n AS (SELECT rn, doc_id, len(sh)::BIGINT AS n_shingles, sh FROM g),
e AS (SELECT rn, n_shingles, unnest(sh) AS s FROM n),
p AS (SELECT x.rn AS a, y.rn AS b, any_value(x.n_shingles) AS na, any_value(y.n_shingles) AS nb, count(*) AS c FROM e x JOIN e y ON x.s = y.s AND x.rn < y.rn GROUP BY x.rn, y.rn),
k AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)), l AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
""" + _REACH + """
SELECT n.doc_id, n.n_shingles, least(n.doc_id, min(o.doc_id)) AS component_id FROM n LEFT JOIN reach r ON r.a = n.rn LEFT JOIN n o ON o.rn = r.b GROUP BY n.rn, n.doc_id, n.n_shingles""",
    # exact; the query's hashing finds nearly all links, those of equal vectors always
    "op2_embedding_neardup": """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS g FROM embeddings),
u AS (SELECT rn, g, sqrt(list_dot_product(g, g)) AS n FROM v WHERE g IS NOT NULL AND len(g) > 0 AND len(list_filter(g, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(g, lambda x: x <> 0)) > 0),
l AS (SELECT x.rn AS a, y.rn AS b FROM u x JOIN u y ON x.rn <> y.rn AND len(x.g) = len(y.g) WHERE list_dot_product(x.g, y.g) / (x.n * y.n) >= 0.9),
""" + _REACH + """,
c AS (SELECT v.rn, least(v.vec_id, min(o.vec_id)) AS component_id FROM v LEFT JOIN reach r ON r.a = v.rn LEFT JOIN v o ON o.rn = r.b GROUP BY v.rn, v.vec_id),
k AS (SELECT a AS rn, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(k.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (rn) LEFT JOIN k USING (rn)""",
    "op3_suffix_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, hex(encode(coalesce(text, ''))) AS hx, (length(hex(encode(coalesce(text, '')))) // 2)::BIGINT AS n_bytes FROM documents),
{_covered('f', suffixes.LENGTH)},
{_covered('p', suffixes.PASSAGE)},
z AS (SELECT rn, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM f GROUP BY rn),
q AS (SELECT rn, sum(b - a)::BIGINT AS n_shared FROM p GROUP BY rn),
e AS (SELECT rn, coalesce(lag(b) OVER (PARTITION BY rn ORDER BY a), 0) AS a, a AS b FROM (SELECT rn, a, b FROM f UNION ALL SELECT rn, n_bytes, n_bytes FROM d)),
t AS (SELECT rn, string_agg(substr(hx, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept FROM e JOIN d USING (rn) GROUP BY rn)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256, coalesce(n_shared, 0)::BIGINT AS n_shared
FROM d JOIN t USING (rn) LEFT JOIN z USING (rn) LEFT JOIN q USING (rn)""",
    "op7_chat_format": r"""
WITH c AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) x(turn, role)),
f AS (SELECT *, length('### ' || role || ': <turn> ' || text || ' </turn>' || chr(10)) + len(regexp_extract_all(role, '\\|### |</?turn>')) + len(regexp_extract_all(text, '\\|### |</?turn>')) AS n FROM c),
g AS (SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
 coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum(n)::BIGINT AS formatted_chars FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""",
    "op5_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
c AS (SELECT *, lpad(length(bin(size))::VARCHAR, 2, '0') || rpad(substr(bin(size), 2, 2), 2, '0') AS cls FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS weight FROM s),
q AS (SELECT *, (3 * source_size)::DOUBLE / weight::DOUBLE AS ratio FROM w),
f AS (SELECT *, coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
             (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open,
             (sum(source_size) OVER ())::BIGINT AS total
      FROM q WINDOW o AS (ORDER BY ratio, source IS NULL, source)),
l AS (SELECT *, (total - capped)::DOUBLE / open::DOUBLE AS lev FROM f),
m AS (SELECT *, (SELECT lev FROM l WHERE lev <= ratio ORDER BY ratio, lev LIMIT 1) AS level FROM l),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, coalesce(level * weight, (3 * source_size)::DOUBLE)) AS target FROM m),
j AS (SELECT c.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0::DOUBLE END AS r0,
             c.size * {mixing.LARGE} > t.source_size AS large FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, k, doc_id) AS n FROM j WHERE large),
bc AS (SELECT *, (floor(n * r0 + {mixing.offset()}::DOUBLE) - floor((n - 1) * r0 + {mixing.offset()}::DOUBLE))::BIGINT AS copies FROM b),
bs AS (SELECT source, sum(copies * size)::BIGINT AS taken, sum(size)::BIGINT AS large_size FROM bc GROUP BY source),
r AS (SELECT j.*, j.source_size - coalesce(bs.large_size, 0) AS words, coalesce(bs.taken, 0)::DOUBLE AS taken,
             row_number() OVER (PARTITION BY j.source ORDER BY cls, k, j.doc_id, j.size) AS n
      FROM j LEFT JOIN bs ON j.source IS NOT DISTINCT FROM bs.source WHERE NOT large),
q2 AS (SELECT *, CASE WHEN words > 0 THEN least(greatest((target - taken) / words::DOUBLE, 0.0::DOUBLE), 3.0::DOUBLE) ELSE r0 END AS r2 FROM r),
e AS (SELECT doc_id, size, source_size, target, copies FROM bc UNION ALL
      SELECT doc_id, size, source_size, target, (floor(n * r2 + {mixing.offset()}::DOUBLE) - floor((n - 1) * r2 + {mixing.offset()}::DOUBLE))::BIGINT AS copies FROM q2)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM e""",
    "op10_license_scan": f"""
WITH t(name, bg, lo, hi) AS (VALUES {_license_rows()}),
d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT rn, unnest(list_concat(string_split(text, chr(10)), CASE WHEN contains(text, chr(10)) THEN [text] ELSE [] END)) AS seg FROM d),
c AS (SELECT rn, string_split(trim(regexp_replace(translate(seg, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM g),
b AS (SELECT rn, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bg FROM c WHERE len(w) > 1),
x AS (SELECT rn, name, 2.0::DOUBLE * len(list_intersect(b.bg, t.bg)) / (len(b.bg) + len(t.bg))::DOUBLE AS dice FROM b, t WHERE len(b.bg) BETWEEN lo AND hi),
an(name, pair, place, n) AS (VALUES {_license_anchors()}),
wt AS (SELECT rn, string_split(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM d),
wp AS (SELECT rn, unnest(list_transform(range(1, len(w)), lambda i: {{'i': i - 1, 'p': w[i] || ' ' || w[i + 1]}})) AS x FROM wt),
ws AS (SELECT DISTINCT rn, name, greatest(x.i - place, 0) AS s, n FROM wp JOIN an ON x.p = an.pair),
wb AS (SELECT rn, name, list_distinct(list_transform(range(1, len(v)), lambda i: v[i] || ' ' || v[i + 1])) AS bg FROM (SELECT ws.rn, name, w[s + 1 : s + n] AS v FROM ws JOIN wt USING (rn))),
xw AS (SELECT rn, name, 2.0::DOUBLE * len(list_intersect(wb.bg, t.bg)) / (len(wb.bg) + len(t.bg))::DOUBLE AS dice FROM wb JOIN t USING (name) WHERE len(wb.bg) BETWEEN lo AND hi),
y AS (SELECT rn, arg_min(name, (-dice, name)) AS license, max(dice) AS dice, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, count(*)::INTEGER AS n_matches
      FROM (FROM x UNION ALL FROM xw) WHERE dice >= 0.75 GROUP BY rn)
SELECT d.doc_id, y.license, coalesce(y.dice, 0.0::DOUBLE) AS dice, coalesce(y.licenses, '') AS licenses, coalesce(y.n_matches, 0)::INTEGER AS n_matches
FROM d LEFT JOIN y USING (rn)""",
}
