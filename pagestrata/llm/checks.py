"""DuckDB SQL that must give the same rows as the operators' queries."""

MIX = r"""
WITH d AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, source_size * 2.0::DOUBLE AS room,
    (sum(source_size) OVER () * 1.5::DOUBLE
     - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size * 2.0::DOUBLE / w,
         source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY source_size * 2.0::DOUBLE / w,
         source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s
), t AS (
  SELECT source, source_size, least(room, w * max(level) OVER ()) AS target FROM l
), b AS (
  SELECT *, length(bin(size)) AS bits,
    ('0x' || substr(md5(coalesce(doc_id, 0)::VARCHAR), 1, 8))::BIGINT AS hashed FROM d
), c AS (
  SELECT *, hashed % ceil(count(*) OVER (PARTITION BY source, bits) / 1000)::BIGINT AS chunk FROM b
), r AS (
  SELECT doc_id, source, size,
    row_number() OVER (PARTITION BY source ORDER BY bits DESC, chunk, size DESC, doc_id) AS k FROM c
), m AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, k,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
), n AS (
  SELECT *, least(floor(k * rate + 679126 / 1048576) - floor((k - 1) * rate + 679126 / 1048576),
                  ceil(rate))::INT AS copies FROM m
)
SELECT doc_id, size, source_size, target::DOUBLE AS target, copies,
  (copies * size)::BIGINT AS taken FROM n
"""

LINES = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e
), s AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
    FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN s USING (key) GROUP BY doc_id
"""

CHATS = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
    (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length(regexp_replace(regexp_replace(role || chr(0) || text,
    '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g')) - 1 AS n FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n + length('<s>[INST]  [/INST]</s>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

SECRETS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p(rank, pattern) AS (VALUES
  (0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'AKIA[A-Z0-9]+'), (2, '[0-9a-f]{32,}'),
  (3, '[0-9A-Fa-f]{24,}'), (4, '[A-Za-z0-9+/=_-]{24,}')
), x AS (
  SELECT doc_id, rank, text, unnest(regexp_extract_all(text, pattern)) AS hit,
    unnest(regexp_extract_all(text, pattern, CASE rank WHEN 0 THEN 1 ELSE 0 END)) AS val,
    generate_subscripts(regexp_extract_all(text, pattern), 1) AS i,
    string_split_regex(text, pattern) AS gaps
  FROM d, p WHERE regexp_matches(text, pattern)
), y AS (
  SELECT *, sum(length(gaps[i]) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop
  FROM x
), z AS (
  SELECT doc_id, rank, hit, gaps[i] AS gap, stop - length(hit) AS start, stop FROM y
  WHERE CASE rank WHEN 0 THEN length(val) >= 8 WHEN 1 THEN length(hit) >= 16 ELSE true END
), r AS (
  SELECT doc_id, rank, start, hit FROM z
  WHERE rank > 2 AND NOT regexp_matches(hit, '^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$'
    '|(?i:example|sample|placeholder|dummy|xxxxxxxx|qwertyuiop|asdfghjkl|abcdefghijkl)|0123456789')
  AND NOT regexp_matches(right(gap, 24),
    '(?i:sha1|sha256|sha384|sha512|md5|etag|integrity|;base64)[-:=,\x20"'']{1,3}$')
), w AS (
  SELECT doc_id, rank, start AS run, start + k AS start, substr(hit, k::INT + 1, 24) AS win
  FROM r, unnest(range(length(hit) - 23)) AS u(k)
), n AS (
  SELECT doc_id, rank, run, start, c, count(*) AS n
  FROM (SELECT *, unnest(string_split(win, '')) AS c FROM w) GROUP BY ALL
), h AS (
  SELECT doc_id, rank, run, start, sum(round(n * log2(n) * 1048576)::BIGINT) AS total FROM n GROUP BY ALL
), hot AS (
  SELECT * FROM h
  WHERE total <= floor((log2(24) - CASE rank WHEN 3 THEN 3.2 ELSE 4.0 END) * 24 * 1048576)
), isl AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id, rank, run ORDER BY start) AS island FROM (
    SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id, rank, run ORDER BY start) <= 24
      THEN 0 ELSE 1 END AS fresh FROM hot)
), sp AS (
  SELECT doc_id, rank, start, stop FROM z WHERE rank <= 2
  UNION ALL
  SELECT doc_id, rank, min(start), max(start) + 24 FROM isl GROUP BY doc_id, rank, run, island
), kept AS (
  SELECT * FROM sp WHERE rank <= 2 OR NOT EXISTS (
    SELECT 1 FROM z WHERE z.rank <= 2 AND z.doc_id = sp.doc_id AND z.start <= sp.start AND z.stop >= sp.stop)
), t AS (
  SELECT doc_id, rank, start, ['assign', 'access', 'hex', 'entropy_hex', 'entropy_base64'][rank + 1]
    || ':' || start::BIGINT || ':' || stop::BIGINT AS span FROM kept
)
SELECT d.doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign,
  count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank <= 2), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id
"""

REVISITS = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CASE WHEN parts[1] = '' THEN url ELSE
    lower(parts[1]) || CASE WHEN parts[2] = '' THEN '/' ELSE parts[2] END || parts[3] END AS url
  FROM (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#:]+)([^?#]*)(\\?[^#]*)?(?:#.*)?$',
    ['1', '2', '3']) AS m, [m['1'], m['2'], m['3']] AS parts FROM pages)
), r AS (
  SELECT page_id, page_id * 8 AS record_id, 'response' AS kind, url, 0 AS d, 0 AS v,
    '"' || page_id || '-1"' AS tag, 'day ' || page_id AS made, html AS payload FROM p
  UNION ALL
  SELECT page_id, page_id * 8 + 1, 'revisit', url, 1, 1,
    CASE WHEN page_id % 5 = 0 THEN '"other"' ELSE '"' || page_id || '-1"' END, NULL, NULL FROM p
  UNION ALL
  SELECT page_id, page_id * 8 + 2, 'response', url, 2, 0, '"' || page_id || '-2"',
    'day ' || page_id, html || '<!-- 2 -->' FROM p WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id, page_id * 8 + 3, 'revisit', url, 3, 1,
    CASE WHEN page_id % 13 = 0 OR page_id % 7 = 0 THEN NULL
      ELSE '"' || page_id || CASE WHEN page_id % 3 = 0 THEN '-2"' ELSE '-1"' END END,
    CASE WHEN page_id % 13 <> 0 AND page_id % 7 = 0 THEN 'day ' || page_id END, NULL FROM p
  UNION ALL
  SELECT page_id, page_id * 8 + 4, 'revisit', url, -1, 1, '"' || page_id || '-1"', NULL, NULL
  FROM p WHERE page_id % 11 = 0
), t AS (
  SELECT *, 1700000000 + page_id + d * 86400 AS at_time FROM r
), l AS (
  SELECT *, last_value(CASE WHEN kind = 'response' THEN record_id END IGNORE NULLS) OVER (
    PARTITION BY url ORDER BY at_time, v, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
  ) AS ref FROM t
), s AS (
  SELECT l.*, o.payload AS body, o.made AS old_made, o.tag AS old_tag, CASE WHEN ref IS NULL THEN 'no earlier response'
    WHEN l.tag IS NULL AND l.made IS NULL THEN 'no validator'
    WHEN coalesce(l.tag, l.made) = CASE WHEN l.tag IS NULL THEN o.made ELSE o.tag END THEN 'resolved'
    ELSE 'validators differ' END AS state
  FROM l LEFT JOIN (SELECT record_id AS o_id, tag, made, payload FROM t WHERE kind = 'response') o ON ref = o_id
  WHERE l.kind = 'revisit'
), f AS (
  SELECT *, chr(13) || chr(10) AS nl, CASE WHEN record_id % 8 = 3 THEN 'W/' ELSE '' END AS weak FROM s
)
SELECT record_id, url, state, CASE WHEN state = 'resolved' THEN ref END AS refers_to,
  CASE WHEN state = 'resolved' THEN 'HTTP/1.1 200 OK' || nl || 'Content-Type: text/html' || nl
    || 'Content-Length: ' || strlen(body) || nl
    || CASE WHEN tag IS NULL THEN 'ETag: ' || old_tag || nl ELSE '' END
    || CASE WHEN made IS NULL THEN 'Last-Modified: ' || old_made || nl ELSE '' END
    || 'Server: a' || nl
    || CASE WHEN tag IS NULL THEN '' ELSE 'etag: ' || weak || tag || nl END
    || CASE WHEN made IS NULL THEN '' ELSE 'Last-Modified: ' || made || nl END
    || 'Cache-Control: max-age=120' || nl || 'Date: now' || nl || nl END AS http,
  CASE WHEN state = 'resolved' THEN sha256(body) END AS payload_sha256
FROM f
"""

#: Rules of op11: verdict, host and path.
URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)

_DOUBLE_SUFFIXES = (
    "'ac.uk','co.uk','gov.uk','org.uk','com.au','net.au','org.au','co.jp','ne.jp','or.jp','co.kr',"
    "'co.nz','co.za','com.br','com.cn','com.mx','com.tr','co.in','com.sg','com.tw'"
)


def _variation(level: str) -> str:
    """What is left for the variation between the children of a level, and the strength of its prior."""
    spread = "parent * (1.0::DOUBLE - parent)"

    def whole(x: str) -> str:
        return f"sum(CAST(floor(({x}) / 0.00000095367431640625::DOUBLE + 0.5::DOUBLE) AS DECIMAL(38,0)))"

    return f"""
SELECT 1.0::DOUBLE / least(greatest(CASE WHEN coalesce(more, 0) = 0 THEN 0.1::DOUBLE
    ELSE (seen::DOUBLE - chance::DOUBLE) / more::DOUBLE END, 0.001::DOUBLE), 0.5::DOUBLE) - 1.0::DOUBLE AS strength
FROM (SELECT {whole('(k - n * parent) * (k - n * parent) / n')} AS seen, {whole(spread)} AS chance,
        {whole(spread + ' * (n - 1.0::DOUBLE)')} AS more FROM {level} WHERE n > 0)"""


URLS = rf"""
WITH a AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a
), c AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM b
), d AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS says FROM c
), h0 AS (
  SELECT host, count(says)::DOUBLE AS n, count(*) FILTER (WHERE says = 'allow')::DOUBLE AS k,
    regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM d GROUP BY host
), h1 AS (
  SELECT *, string_split(name, '.') AS labels,
    CASE WHEN array_to_string(string_split(name, '.')[-2:], '.') IN ({_DOUBLE_SUFFIXES}) THEN 2 ELSE 1 END AS s FROM h0
), h AS (
  SELECT host, n, k,
    CASE WHEN len(labels) <= s OR regexp_matches(name, '^[0-9.]+$|^\[') THEN name ELSE array_to_string(labels[-s - 1:], '.') END AS domain,
    CASE WHEN len(labels) <= s OR regexp_matches(name, '^[0-9.]+$|^\[') THEN name ELSE array_to_string(labels[-s:], '.') END AS suffix FROM h1
), root AS (SELECT (coalesce(sum(k), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS mean FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT mean FROM root) AS parent FROM h GROUP BY suffix),
sv AS ({_variation('s0')}),
s1 AS (SELECT suffix, (parent * strength + k) / (n + strength) AS mean FROM s0, sv),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k, max(mean) AS parent FROM h JOIN s1 USING (suffix) GROUP BY domain, suffix),
dv AS ({_variation('d0')}),
d1 AS (SELECT domain, (parent * strength + k) / (n + strength) AS mean FROM d0, dv),
e0 AS (SELECT host, n, k, mean AS parent FROM h JOIN d1 USING (domain)),
ev AS ({_variation('e0')}),
e1 AS (SELECT host, (parent * strength + k) / (n + strength) AS mean, n + strength AS strength FROM e0, ev)
SELECT page_id, host, path, rule,
  coalesce(says, CASE WHEN mean + sqrt(mean * (1.0::DOUBLE - mean) / (strength + 1.0::DOUBLE)) * 1.0::DOUBLE < 0.5 THEN 'block'
    ELSE 'allow' END) AS verdict
FROM d JOIN e1 USING (host)
"""

REPAIR = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
        concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda c: ascii(c)::BIGINT)),
      lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)),
        lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)),
      4294967295::BIGINT) % 20 AS kind
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER o AS k, lag(role) OVER o AS before,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    rtrim(text, E' \t\n\x0B\f\r') AS core
  FROM hurt WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)
), faulty AS (
  SELECT *, CASE WHEN core = '' THEN 'blank' WHEN seen THEN 'duplicate'
    WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS initial
  FROM placed
), put(s, n, t, new) AS (VALUES
  ('-', 0, '-', ''), ('-', 1, 'u', E'\nuser:'), ('-', 2, 'a', E'\nuser:\nassistant:'),
  ('s', 0, 's', ''), ('s', 1, 'u', E'\nuser:'), ('s', 2, 'a', E'\nuser:\nassistant:'),
  ('u', 0, 'u', ''), ('u', 1, 'a', E'\nassistant:'), ('u', 2, 'u', E'\nassistant:\nuser:'),
  ('a', 0, 'a', ''), ('a', 1, 'u', E'\nuser:'), ('a', 2, 'a', E'\nuser:\nassistant:')
), act(t, edit, initial, cost, to_state, role) AS (VALUES
  ('-', 'D', NULL, 2, '-', NULL), ('s', 'D', NULL, 2, 's', NULL), ('u', 'D', NULL, 2, 'u', NULL), ('a', 'D', NULL, 2, 'a', NULL),
  ('-', 'R', NULL, 1, 'u', 'user'), ('s', 'R', NULL, 1, 'u', 'user'), ('u', 'R', NULL, 1, 'a', 'assistant'),
  ('a', 'R', NULL, 1, 'u', 'user'),
  ('-', 'K', 's', 0, 's', NULL), ('-', 'K', 'u', 0, 'u', NULL), ('s', 'K', 'u', 0, 'u', NULL),
  ('u', 'K', 'a', 0, 'a', NULL), ('a', 'K', 'u', 0, 'u', NULL)
), moves AS (
  SELECT p.s, p.n, p.new, a.edit, a.initial, a.cost, a.to_state, a.role FROM put p JOIN act a ON p.t = a.t
), walk(conv_id, k, state, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '-', {'cost': 0::BIGINT, 'audit': '', 'text': ''} FROM faulty
  UNION ALL
  SELECT w.conv_id, w.k + 1, m.to_state,
    min({'cost': w.best.cost + 5 * m.n + m.cost + CASE WHEN f.fault = 'truncated' AND m.edit <> 'D' THEN 5 ELSE 0 END,
         'audit': concat(w.best.audit, repeat('I', m.n), m.edit),
         'text': concat(w.best.text, m.new, CASE WHEN m.edit <> 'D' THEN concat(E'\n', coalesce(m.role, f.role), ':', f.text) ELSE '' END)})
  FROM walk w
  JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1
  JOIN moves m ON m.s = w.state AND (m.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
    AND (m.initial IS NULL OR m.initial = f.initial)
  GROUP BY w.conv_id, w.k, m.to_state
), counts AS (
  SELECT conv_id, max(k) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE concat(left(before, 1), initial) NOT IN ('su', 'ua', 'au') AND before IS NOT NULL) AS illegal
  FROM faulty GROUP BY conv_id
), ended AS (
  SELECT c.conv_id, min({'cost': w.best.cost + 5 * p.n, 'audit': concat(w.best.audit, repeat('I', p.n)),
    'text': concat(w.best.text, p.new)}) AS best
  FROM counts c JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.k = c.n
  JOIN put p ON p.s = w.state AND (p.t = 'a' OR p.t = '-' AND p.n = 0)
  GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
  coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(substr(e.best.text, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

MIDDLE = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(concat('1:', coalesce(doc_id::VARCHAR, ''))) AS h FROM documents
), d AS (
  SELECT doc_id, text, length(text) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM h
), c AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN concat('<P>', substr(text, 1, a), '<S>', substr(text, b + 1), '<M>', substr(text, a + 1, b - a))
    ELSE concat('<S>', substr(text, b + 1), '<P>', substr(text, 1, a), '<M>', substr(text, a + 1, b - a)) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""
