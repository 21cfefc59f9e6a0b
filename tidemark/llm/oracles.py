"""DuckDB SQL for the queries it can express.

Suffix removal works on bytes, which SQL strings don't show; compression distances,
rank profiles and token ids have no SQL either. Those are tested against plain versions.
"""

from __future__ import annotations

from tidemark.llm.rules import STOP_WORDS
from tidemark.llm.text import LOWER, UPPER

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


def _split(text: str) -> str:
    return (
        f"list_filter(string_split_regex({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"
    )


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

_QUALITY = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_split("coalesce(text, '')")} AS w FROM documents
), windows AS (
  SELECT doc_id, i, w[i : i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, t, w, len(w)::BIGINT AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)
), f AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words, base_failed,
  NOT (base_failed
    OR 10 * n_symbols > n_words
    OR length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g'))
      > length(regexp_replace(t, '[^a-zß-öø-ÿ]', '', 'g'))
    OR 3 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
    OR word_chars < 3 * n_words OR word_chars > 12 * n_words
    OR 4 * length(regexp_replace(t, '[^0-9]', '', 'g')) > word_chars
    OR 10 * len(list_distinct(lines)) < 7 * len(lines)
    OR len(list_intersect([{_STOPS}], list_distinct({_split("lower(t)")}))) < 2) AS kept
FROM f
"""

_SUBSTRINGS = f"""
WITH d AS (
  SELECT doc_id, {_split("coalesce(text, '')")} AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM twice
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), rest AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(rest.text, '')) AS kept_sha256
FROM d LEFT JOIN rest USING (doc_id)
"""

_URLS = f"""
WITH rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), best AS (
  SELECT p.host, p.path, max_by({{'rule': r.host || r.path, 'verdict': r.verdict}}, length(r.host || r.path)) AS b
  FROM (SELECT DISTINCT host, path FROM p) p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY ALL
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict
FROM p LEFT JOIN best USING (host, path)
"""

_RUN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_BENCHMARK = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{_RUN}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '{_RUN}') AS w FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
    FROM b WHERE len(w) > 0
  )
), found AS (
  SELECT doc_id, i, n, item_id
  FROM (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
    FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM d CROSS JOIN (SELECT DISTINCT n FROM wanted)
    )
  ) JOIN wanted USING (n, g)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
  coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.list, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_NEAR = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_split(_LOWERED)} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": _QUALITY,
    "op5_substrings": _SUBSTRINGS,
    "op6_url_filters": _URLS,
    "op7_decontaminate": _BENCHMARK,
    "op8_minhash": _NEAR,
}

_AUDIT = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS part,
    coalesce(text, '') AS t, {_split("coalesce(text, '')")} AS w FROM documents
), f AS (
  SELECT d.*, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
    len(w) < 200 AS a,
    100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e
  FROM d LEFT JOIN (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
  ) l ON d.doc_id = l.doc_id
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS o
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
  SELECT o AS filter_order, unnest(range(1, 6))::INTEGER AS step FROM orders
), failed AS (
  SELECT part, list_sort(list_filter([
      CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
      CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END], lambda x: x IS NOT NULL)) AS fails,
    count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
  FROM f GROUP BY ALL
), applied AS (
  SELECT part, filter_order, step, n, good, bad,
    list_contains(fails, filter_order[step]) AS own, len(fails) AS all_fails,
    len(list_filter(fails, lambda x: instr(filter_order[1 : step - 1], x) > 0)) AS before
  FROM failed, steps
), counts AS (
  SELECT part, filter_order, step,
    coalesce(sum(n) FILTER (WHERE before = 0 AND NOT own), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE before = 0 AND own), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE before > 0 AND own), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE all_fails = 1 AND own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE before = 0 AND own), 0)::BIGINT AS good_lost,
    coalesce(sum(bad) FILTER (WHERE before = 0 AND own), 0)::BIGINT AS toxic_lost
  FROM applied GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley
FROM counts
"""

ORACLES["op11_filter_audit"] = _AUDIT

_TRIE = f"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))
    ) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT DISTINCT c, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT) AS b
  FROM own
), convs AS (
  SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda s, x: xor(s >> 8, tab[(xor(s, x) & 255) + 1]))) % 4 AS h
  FROM ids, crc_table
), parts AS (
  SELECT convs.c, 0 AS part, p, role, text
  FROM convs JOIN own ON own.c = convs.c - convs.c % 20 AND p <= h
  UNION ALL
  SELECT convs.c, 1, p, role, text FROM convs JOIN own ON own.c = convs.c AND p > h
), rebuilt AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d FROM parts
  UNION ALL SELECT c, NULL, NULL, 0 FROM convs
), named AS (
  SELECT c, d, coalesce(len({_split("text")}), 0) AS words,
    string_agg(coalesce(md5(role) || md5(text), '/'), '') OVER (PARTITION BY c ORDER BY d) AS k,
    d = max(d) OVER (PARTITION BY c) AS last
  FROM rebuilt
), up AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS above FROM named
), nodes AS (
  SELECT k, d AS depth, any_value(above) AS above, min(c) AS conv_id, count(*) AS n_convs,
    any_value(words) AS words, count(*) FILTER (WHERE last) AS n_ends,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last), '') AS ends
  FROM up GROUP BY k, d
), below AS (
  SELECT DISTINCT x.k, y.k AS other FROM named x JOIN named y ON x.c = y.c AND x.d <= y.d
), sums AS (
  SELECT below.k, count(*) FILTER (WHERE n_ends = n_convs) AS n_leaves,
    sum((n_convs - 1) * words) AS saved
  FROM below JOIN nodes ON nodes.k = below.other GROUP BY below.k
), children AS (
  SELECT above AS k, count(*) AS n FROM nodes GROUP BY above
)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id,
  nodes.n_convs::BIGINT AS n_convs, coalesce(children.n, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN sums ON sums.k = nodes.k
LEFT JOIN nodes parent ON parent.k = nodes.above
LEFT JOIN children ON children.k = nodes.k
"""

ORACLES["op12_prefix_trie"] = _TRIE
