"""DuckDB statements for the queries that SQL can express. They state the results plainly, pair by pair and string by string."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), runs AS (
    SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' ')))) AS g
    FROM d
), windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM runs
), again AS (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM windows WHERE n > 1
), covered AS (
    SELECT doc_id, sum(least(5, coalesce(next - i, 5))) AS n FROM again GROUP BY doc_id
), m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
           length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_upper, length(t) AS n_chars
    FROM d LEFT JOIN covered c USING (doc_id)
), f AS (
    SELECT *, (n_words < 10) AS r0, (100 * n_repeat_words > 20 * n_words) AS r1, (10 * n_symbols > n_words) AS r2,
           (n_lines >= 4 AND 2 * n_dup_lines > n_lines) AS r3, (word_chars < 2 * n_words) AS r4, (word_chars > 20 * n_words) AS r5,
           (n_words >= 10 AND 2 * n_upper > n_chars) AS r6, (n_words = 0) AS r7, (n_words < 50) AS r8, (n_dup_lines > 0) AS r9
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (r0 OR r1) AS base_failed,
       NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5 OR r6) AS kept,
       (r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT + 128 * r7::INT
        + 256 * r8::INT + 512 * r9::INT)::BIGINT AS failures
FROM f
"""

_ESCAPES = r"len(regexp_extract_all({}, '[<\[]\\*(?:\||/?s>|/?INST\]|</?SYS>>)'))"

OP7 = rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), a AS (
    SELECT *, len({WORDS}) + 4 AS cost, length(role) + length(text) + 12 + 1 + 11 + {_ESCAPES.format('role')} + {_ESCAPES.format('text')}
           + length(role) - length(replace(replace(role, '\', ''), chr(10), '')) AS chars,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
    FROM t
), b AS (
    SELECT *, coalesce(sum(cost) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
           min(pos) FILTER (role = 'system') OVER (PARTITION BY conv_id) AS sys_pos FROM a
), c AS (
    SELECT b.*, greatest((2048 - 256 - coalesce(s.cost, 0)) // 2, 1) AS size
    FROM b LEFT JOIN a s ON s.conv_id = b.conv_id AND s.pos = b.sys_pos
), e AS (
    SELECT *, start // size AS cell, cost > size AS big FROM c
), spans AS (
    SELECT conv_id, cell, big, min(start) AS span_start, min(pos) AS span_pos FROM e GROUP BY ALL
), items AS (
    SELECT conv_id, chars FROM e
    UNION ALL SELECT e.conv_id, e.chars FROM e JOIN spans s ON s.conv_id = e.conv_id AND s.span_start > e.start
        AND s.span_start - e.start <= least(256, e.size) AND e.pos IS DISTINCT FROM e.sys_pos
    UNION ALL SELECT e.conv_id, e.chars FROM e JOIN spans s ON s.conv_id = e.conv_id AND e.pos = e.sys_pos AND s.span_pos > e.pos
), formatted AS (
    SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM items GROUP BY conv_id
), whole AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS turns,
           coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '') AS targets
    FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(targets)::BIGINT AS loss_chars, sha256(targets) AS loss_sha256, formatted_chars
FROM whole JOIN formatted USING (conv_id)
"""

OP8 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, {WORDS} AS w FROM documents
), shingles AS (
    SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: md5(array_to_string(w[i:i + 4], ' '))))) AS g
    FROM d WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * pairs.n >= 4 * (x.n + y.n - pairs.n)
), reached(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), classes AS (
    SELECT a AS doc_id, min(least(a, b)) AS class_id FROM reached GROUP BY a
), counts AS (
    SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a
)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n, 0) AS n_links
FROM documents LEFT JOIN classes USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

_TWO = ("'ac.uk', 'co.in', 'co.jp', 'co.kr', 'co.nz', 'co.uk', 'co.za', 'com.ar', 'com.au', 'com.br', 'com.cn', 'com.mx', 'com.tr', "
        "'gov.uk', 'ne.jp', 'net.au', 'or.jp', 'org.au', 'org.uk'")


def _posterior(children: str, parents: str, key: str, parent: str) -> str:
    """Rows (key, parent, mean, weight): ``children`` (n, k) shrunk towards the mean of their parent."""
    return f"""
    SELECT c.{key}, c.{parent}, (c.k + s.strength * s.m) / (c.n + s.strength) AS mean, c.n + s.strength AS weight
    FROM {children} c JOIN (
        SELECT {parent}, m, least(greatest(CASE WHEN between_ > 0 THEN m * (1 - m) / between_ - 1 ELSE 1000 END, 1), 1000) AS strength
        FROM (
            SELECT c.{parent}, max(p.mean) AS m,
                   CASE WHEN sum(c.n - 1) > 0 THEN greatest(sum(c.n * pow(c.k / c.n - p.mean, 2)) - sum(p.mean * (1 - p.mean)), 0) / sum(c.n - 1) END AS between_
            FROM {children} c JOIN {parents} p ON c.{parent} = p.{parent} GROUP BY c.{parent})
    ) s ON c.{parent} = s.{parent}"""


OP9 = rf"""
WITH p AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), h AS (
    SELECT *, list_reverse(string_split(host, '.')) AS r FROM p
), named AS (
    SELECT page_id, host, path, CASE WHEN len(r) > 1 AND r[2] || '.' || r[1] IN ({_TWO}) THEN 2 ELSE 1 END AS tail, r FROM h
), u AS (
    SELECT page_id, host, path, array_to_string(list_reverse(r[1:tail + 1]), '.') AS domain, array_to_string(list_reverse(r[1:tail]), '.') AS suffix, 0 AS everything
    FROM named
), outcomes AS (
    SELECT u.*, bad FROM u JOIN (SELECT doc_id, max(greatest(1 - quality, toxic)) AS bad FROM labels GROUP BY doc_id) l ON page_id = doc_id
    WHERE bad IS NOT NULL AND host <> ''
), hosts AS (
    SELECT host, domain, suffix, everything, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS k FROM outcomes GROUP BY ALL
), domains AS (
    SELECT domain, suffix, everything, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL
), suffixes AS (
    SELECT suffix, everything, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL
), e AS (
    SELECT everything, (sum(k) + 0.5) / (sum(n) + 1) AS mean, sum(n) + 1 AS weight FROM suffixes GROUP BY everything
), by_suffix AS ({_posterior('suffixes', 'e', 'suffix', 'everything')}
), by_domain AS ({_posterior('domains', 'by_suffix', 'domain', 'suffix')}
), by_host AS ({_posterior('hosts', 'by_domain', 'host', 'domain')}
), judged AS (
    SELECT u.*, coalesce(h.mean, d.mean, s.mean, e.mean) AS mean, coalesce(h.weight, d.weight, s.weight, e.weight) AS weight,
           CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM u LEFT JOIN by_host h USING (host) LEFT JOIN by_domain d ON u.domain = d.domain LEFT JOIN by_suffix s ON u.suffix = s.suffix
    LEFT JOIN e ON u.everything = e.everything
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.3 THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

OP10 = """
WITH d AS (
    SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents
), runs AS (
    SELECT doc_id, unnest(range(0, n - 99)) AS i, unnest(list_transform(range(0, n - 99), lambda i: md5(substr(h, 2 * i + 1, 200)))) AS s FROM d
), strings AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM runs
), starts AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM strings WHERE nth > 1
), islands AS (
    SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM starts
), spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM islands GROUP BY doc_id, island
), gaps AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
    UNION ALL SELECT doc_id, max(b), max(d.n) FROM spans JOIN d USING (doc_id) GROUP BY doc_id
), kept AS (
    SELECT doc_id, coalesce(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) FILTER (b > a), '') AS h FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
), removed AS (
    SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), f AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM places, range(1, 5) AS ks(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cuts AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k >= 2 AND f >= 30
), halves AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ') AND x.k = c.cut
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ') AND y.k = c.k - c.cut
), candidates AS (
    SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, k, a, string_split(phrase, ' ') AS w FROM candidates WHERE k >= 3) c, range(2, 4) AS ms(m), range(1, 4) AS firsts(i)
    WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), kept AS (
    SELECT c.* FROM candidates c LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {"op5_quality": OP5, "op7_chat": OP7, "op8_jaccard": OP8, "op9_hosts": OP9, "op10_suffixes": OP10, "op12_collocations": OP12}
