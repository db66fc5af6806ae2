"""DuckDB statements for the document operators that SQL can express."""

from __future__ import annotations

_SIZES = r"""
sized AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0 AS u,
         greatest(0.05, 1.0 - 4.0 * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>!', '')))
           / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS quality
  FROM documents)
"""

OP7 = rf"""
WITH {_SIZES},
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0 * source_size / w AS r,
         (1.5 * sum(source_size) OVER ()
           - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
fill AS (SELECT min_by(level, r) FILTER (WHERE level <= r) AS level FROM levels),
aims AS (
  SELECT source, source_size,
         coalesce(least(2.0 * source_size, fill.level * w), 2.0 * source_size)::DOUBLE AS target
  FROM levels, fill),
ordered AS (
  SELECT s.doc_id, s.size, a.source_size, a.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY -ln(s.u) / s.quality, s.doc_id, s.text
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS before,
         CASE WHEN a.source_size > 0 THEN floor(a.target / a.source_size)::BIGINT ELSE 0 END AS epochs
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN target - epochs * source_size > 0
                               AND 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""

OP6 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, greatest(len(w) - 18, 1)::BIGINT)) AS s, w FROM words),
seen AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(w[s:s + 19], ' ') ORDER BY doc_id, s) > 1 AS again
  FROM starts),
gone AS (SELECT DISTINCT doc_id, s + i AS p FROM seen, range(20) t(i) WHERE again),
spread AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word FROM words),
kept AS (
  SELECT s.doc_id, count(*) FILTER (WHERE g.p IS NOT NULL) AS n_removed,
         string_agg(s.word, ' ' ORDER BY s.p) FILTER (WHERE g.p IS NULL) AS rest
  FROM spread s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.p = g.p GROUP BY s.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.rest, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

OP5 = r"""
WITH raw AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
plain AS (
  SELECT doc_id, pos, [t FOR t IN regexp_split_to_array(line, '[\x20\x09-\x0D]+') IF t <> ''] AS p FROM raw),
lines AS (
  SELECT doc_id, pos, p, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN p] AS w
  FROM plain WHERE len(p) > 0),
keyed AS (
  SELECT *, array_to_string(CASE WHEN len([t FOR t IN w IF t <> '<*>']) = 0 THEN p ELSE w END, ' ') AS key FROM lines),
equals AS (SELECT key FROM keyed GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
leaves AS (
  SELECT doc_id, pos, w, array_to_string(w, ' ') AS line, {'n': len(w), 'a': w[1], 'b': w[2], 'c': w[3]} AS leaf
  FROM lines WHERE len(w) > 3),
sizes AS (SELECT leaf, count(DISTINCT doc_id) AS size FROM leaves GROUP BY leaf HAVING count(DISTINCT doc_id) >= 5),
tokens AS (
  SELECT DISTINCT leaf, doc_id, line, generate_subscripts(w, 1) AS spot, unnest(w) AS token
  FROM leaves WHERE leaf IN (SELECT leaf FROM sizes)),
constant AS (
  SELECT leaf, spot, token FROM tokens JOIN sizes USING (leaf) WHERE token <> '<*>' AND spot > 3
  GROUP BY leaf, spot, token, size HAVING count(DISTINCT doc_id) >= 5 AND count(DISTINCT doc_id) >= 0.5 * size),
general AS (
  SELECT t.leaf, t.line, t.doc_id, count(c.token) AS constants, count(*) AS n,
         string_agg(CASE WHEN t.spot <= 3 THEN t.token ELSE coalesce(c.token, '<*>') END, ' ' ORDER BY t.spot) AS template
  FROM tokens t LEFT JOIN constant c ON t.leaf = c.leaf AND t.spot = c.spot AND t.token = c.token
  GROUP BY t.leaf, t.line, t.doc_id),
often AS (
  SELECT leaf, template FROM general WHERE constants >= 0.5 * (n - 3) GROUP BY leaf, template
  HAVING count(DISTINCT doc_id) >= 5),
gone AS (
  SELECT doc_id, pos FROM keyed WHERE key IN (SELECT key FROM equals)
  UNION
  SELECT l.doc_id, l.pos FROM leaves l JOIN general g ON l.leaf = g.leaf AND l.line = g.line AND l.doc_id IS NOT DISTINCT FROM g.doc_id
  JOIN often o ON g.leaf = o.leaf AND g.template = o.template WHERE g.constants >= 0.5 * (g.n - 3))
SELECT r.doc_id, (CASE WHEN bool_and(r.line = '') AND count(*) = 1 THEN 0 ELSE count(*) END)::BIGINT AS n_lines,
       count(g.pos)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(r.line, chr(10) ORDER BY r.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
FROM raw r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.pos = g.pos
GROUP BY r.doc_id
"""



def _lloyd(rounds: int = 4) -> str:
    """The rounds unrolled: assignments ``a0, a1, ...`` under codebooks ``c0, c1, ...``."""
    steps = [r"""
WITH kept AS (
  SELECT row_number() OVER () AS uid, vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
wide AS (SELECT (max(len(v)) + 3) // 4 AS w FROM kept),
parts AS (
  SELECT uid, j, [coalesce(v[i], 0) FOR i IN range(j * w + 1, (j + 1) * w + 1)] AS p
  FROM kept, wide, range(4) t(j)),
seeds AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS k, uid
  FROM (SELECT vec_id, min_by(uid, v) AS uid FROM kept GROUP BY vec_id)
  QUALIFY row_number() OVER (ORDER BY vec_id NULLS LAST) <= 256),
c0 AS (SELECT j, k, p AS c FROM seeds JOIN parts USING (uid))"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (
  SELECT uid, j, any_value(p) AS p, min(struct_pack(d := d, k := k)) AS best
  FROM (SELECT uid, j, p, k, list_inner_product(p, p) - 2 * list_inner_product(p, c) + list_inner_product(c, c) AS d
        FROM parts JOIN c{r} USING (j))
  GROUP BY uid, j)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT j, k, list(s / n ORDER BY i) AS means
  FROM (SELECT j, best.k AS k, i, floor(sum(p[i]) / count(*)) AS s, 1 AS n
        FROM a{r}, wide, range(1, w + 1) t(i) GROUP BY j, best.k, i)
  GROUP BY j, k),
c{r + 1} AS (SELECT j, k, coalesce(means, c) AS c FROM c{r} LEFT JOIN m{r} USING (j, k))""")
    return ",".join(steps) + f""",
codes AS (
  SELECT uid, string_agg(printf('%02x', best.k), '' ORDER BY j) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY uid),
books AS (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY j, k, i)) AS digest
  FROM (SELECT j, k, generate_subscripts(c, 1) AS i, unnest(c) AS x FROM c{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, digest AS codebooks_sha256
FROM kept JOIN codes USING (uid), books
"""


OP13 = _lloyd()


def _repair() -> str:
    """Least (cost, audit) by position and state, kept as text: twelve digits of cost, then the audit."""
    crc = """list_reduce(
      [xor(0, 4294967295)] || [ord(x)::BIGINT FOR x IN string_split(
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                            lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"""

    def then(state: str, cost: str, edit: str) -> str:
        return f"(printf('%012d', left({state}, 12)::BIGINT + {cost}) || substr({state}, 13) || {edit})"

    def closed(names: str) -> str:
        """Any inserts: after the start, ``s`` and ``a`` a user, after a user an assistant, twice at most."""
        return f"""
      SELECT {names}, s0, s1, s2, least(s3, {then('s2', '5', "'I'")}) AS s3 FROM (
       SELECT {names}, s0, s1, least(s2, {then('s3', '5', "'I'")}) AS s2, s3 FROM (
        SELECT {names}, s0, s1, s2, least(s3, {then('s2', '5', "'I'")}) AS s3 FROM (
         SELECT {names}, s0, s1, least(s2, {then('s0', '5', "'I'")}, {then('s1', '5', "'I'")}, {then('s3', '5', "'I'")}) AS s2, s3"""

    extra = "5 * truncated"
    gone = [f"{then(f's{q}', '2', chr(39) + 'D' + chr(39))}" for q in range(4)]

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN NOT goes AND initial = '{initial}' THEN {then(state, extra, chr(39) + 'K' + chr(39))} END"

    def reroled(state: str) -> str:
        return f"CASE WHEN NOT goes THEN {then(state, f'1 + {extra}', chr(39) + 'R' + chr(39))} END"

    return rf"""
WITH RECURSIVE hurt AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(coalesce(text, ' '), '.!?', '')
              ELSE coalesce(text, ' ') END AS text, fault
  FROM (SELECT *, xor({crc}, 4294967295) % 20 AS fault FROM conversations)
  WHERE fault <> 0),
twice AS (SELECT * FROM hurt UNION ALL SELECT * FROM hurt WHERE fault = 3),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         regexp_replace(text, '[ 	-
]+$', '') AS bare
  FROM twice),
seen AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, bare = '' AS is_blank,
         bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_again,
         right(bare, 1) NOT IN ('.', '!', '?') AS is_open,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS is_illegal
  FROM placed),
rows AS (
  SELECT conv_id, i, role, text, initial, is_blank OR is_again AS goes,
         (NOT is_blank AND NOT is_again AND is_open)::INT AS truncated
  FROM seen),
figures AS (
  SELECT s.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate,
         count(*) FILTER (NOT is_blank AND NOT is_again AND is_open) AS truncated,
         count(*) FILTER (is_illegal) AS illegal, count(*) AS n
  FROM seen s GROUP BY s.conv_id),
ways AS (
  {closed('conv_id, i')} FROM (
    SELECT conv_id, 0::BIGINT AS i, '000000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3
    FROM figures))))
  UNION ALL
  {closed('conv_id, i')} FROM (
    SELECT r.conv_id, r.i, {gone[0]} AS s0, least({gone[1]}, {kept('s0', 's')}) AS s1,
           least({gone[2]}, {kept('s0', 'u')}, {kept('s1', 'u')}, {kept('s3', 'u')},
                 {reroled('s0')}, {reroled('s1')}, {reroled('s3')}) AS s2,
           least({gone[3]}, {kept('s2', 'a')}, {reroled('s2')}) AS s3
    FROM ways w JOIN rows r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1))))),
plan AS (
  SELECT w.conv_id, left(least(s0, s3), 12)::BIGINT AS cost, substr(least(s0, s3), 13) AS audit
  FROM ways w JOIN figures f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.n),
steps AS (
  SELECT conv_id, t, audit[t] AS edit, len(replace(audit[1:t], 'I', '')) AS i, len(replace(audit[1:t], 'D', '')) AS o
  FROM plan, range(1, 1000000) r(t) WHERE t <= len(audit)),
made AS (
  SELECT s.conv_id, s.t, s.o, s.edit, r.role, r.text,
         max((s.o = 1 AND s.edit = 'K' AND r.initial = 's')::INT) OVER (PARTITION BY s.conv_id) AS led
  FROM steps s LEFT JOIN rows r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i AND s.edit <> 'I'
  WHERE s.edit <> 'D'),
texts AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                    || ':' || coalesce(text, ''), chr(10) ORDER BY t)) AS digest
  FROM made GROUP BY conv_id)
SELECT c.conv_id, coalesce(f.gaps, 0)::BIGINT AS gaps, coalesce(f.blank, 0)::BIGINT AS blank,
       coalesce(f.duplicate, 0)::BIGINT AS duplicate, coalesce(f.truncated, 0)::BIGINT AS truncated,
       coalesce(f.illegal, 0)::BIGINT AS illegal, coalesce(p.cost, 0)::BIGINT AS cost, coalesce(p.audit, '') AS audit,
       coalesce(t.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN plan p ON c.conv_id IS NOT DISTINCT FROM p.conv_id
LEFT JOIN texts t ON c.conv_id IS NOT DISTINCT FROM t.conv_id
"""


OP12 = _repair()

OP9 = r"""
WITH sized AS (
  SELECT doc_id, text, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
         ('0x' || substr(md5(coalesce(text, '')), 1, 9))::BIGINT * 16777216
           + ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 6))::BIGINT AS key
  FROM documents),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total
  FROM sized),
dealt AS (
  SELECT *, least(((2 * before + size) * 8) // (2 * total), 7)::INT AS shard FROM placed)
SELECT doc_id, size,
       xor(list_reduce([4294967295] || [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
         lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                                  lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS text_crc32,
       'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST) - 1 AS slot,
       NULL::INT AS grown_shard
FROM dealt
"""

ORACLES = {
    "op5_line_dedup": OP5,
    "op6_substring_dedup": OP6,
    "op7_mixing": OP7,
    "op9_sharding": OP9,
    "op12_conversation_repair": OP12,
    "op13_vector_codes": OP13,
}
