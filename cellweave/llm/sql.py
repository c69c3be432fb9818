"""SQL for DuckDB that states the results of the operators' queries, where SQL can."""

from __future__ import annotations

from .url_filter import LOWER, RULES, UPPER

GAP = r"[\x20\x09-\x0D]+"

WEB_ARCHIVE = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS hex FROM p),
  m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((((('0x' || substr(hex, (1 + 10 * (k // 8))::INT, 10))::BIGINT) >> (35 - 5 * (k % 8))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM m"""

NEAR_DUPLICATES = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAP}'), lambda x: x <> '') AS w FROM documents),
  s AS MATERIALIZED (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS sh FROM w),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
  l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
  e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
  r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def _url_filter(rounds: int = 160) -> str:
    """Ranks after so many rounds that less than 1e-11 of either flow is unsettled (0.85 ** 160)."""
    rest = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"
    host = f"coalesce(translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '')"
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    when = lambda i: "CASE " + " ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{(h + p) if i else a}'" for a, h, p in ordered) + " END"
    link = "regexp_extract_all(html, '(?i)(?:href|src)\\s*=\\s*[\"'']?((?:[a-z][a-z0-9+.-]*:)?//[^\"''\\s<>]+)', 1)"
    full = "CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END"
    step = "SELECT i + 1, kind, dst AS node, 0.85::DOUBLE * score * share AS score FROM r JOIN shares USING (kind) WHERE src = node"
    back = "SELECT 0 AS i, kind, node, 0.15::DOUBLE * seed AS score FROM seeds"
    again = "SELECT i + 1, kind, node, 0.15::DOUBLE * seed FROM (SELECT DISTINCT i FROM r), seeds"
    return f"""WITH RECURSIVE u AS (SELECT page_id, html, {host.format("url")} AS host, coalesce(regexp_extract({rest.format("url")}, '^[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
  j AS MATERIALIZED (SELECT page_id, html, host, path, {when(1)} AS rule, {when(0)} AS act FROM u),
  k AS (SELECT CASE act WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host AS node, count(*) AS n FROM j WHERE act IS NOT NULL AND host <> '' GROUP BY ALL),
  seeds AS MATERIALIZED (SELECT kind, node, n / (sum(n) OVER (PARTITION BY kind))::DOUBLE AS seed FROM k),
  links AS (SELECT host AS src, unnest({link}) AS link FROM j WHERE host <> ''),
  ends AS (SELECT src, {host.format(full)} AS dst FROM (SELECT src, link FROM links)),
  edges AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM ends WHERE dst <> '' AND dst <> src GROUP BY ALL),
  ways AS (SELECT 'trust' AS kind, src, dst, n FROM edges UNION ALL SELECT 'distrust', dst, src, n FROM edges),
  shares AS MATERIALIZED (SELECT kind, src, dst, n / (sum(n) OVER (PARTITION BY kind, src))::DOUBLE AS share FROM ways),
  r AS ({back} UNION ALL SELECT i, kind, node, sum(score) FROM ({step} UNION ALL {again}) AS s(i, kind, node, score) WHERE i <= {rounds} GROUP BY ALL),
  hosts AS (SELECT node AS host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS d FROM r WHERE i = {rounds} GROUP BY 1)
SELECT page_id, j.host, path, rule, coalesce(act, CASE WHEN t + d > 0 AND d >= 0.5::DOUBLE * (t + d) THEN 'block' ELSE 'allow' END) AS verdict FROM j LEFT JOIN hosts ON hosts.host = j.host"""


URL_FILTER = _url_filter()

def _mixing_targets(rounds: int = 12) -> str:
    """Excess of full sources is shared out again, as often as there can be sources that fill up one after another."""
    steps = ["t0 AS (SELECT source, s, w, false AS filled FROM weighed)"]
    level = "(1.5::DOUBLE * (SELECT sum(s) FROM weighed) - coalesce((SELECT sum(2.0::DOUBLE * s) FROM t{0} WHERE filled), 0)) / (SELECT sum(w) FROM t{0} WHERE NOT filled)"
    for i in range(1, rounds + 1):
        steps.append(f"t{i} AS MATERIALIZED (SELECT source, s, w, filled OR coalesce({level.format(i - 1)} * w >= 2.0::DOUBLE * s, false) AS filled FROM t{i - 1})")
    return f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
  sums AS (SELECT source, sum(size)::BIGINT AS s FROM d GROUP BY 1), weighed AS MATERIALIZED (SELECT source, s, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM sums),
  {", ".join(steps)}
SELECT doc_id, size, s AS source_size, round(CASE WHEN filled THEN 2.0::DOUBLE * s ELSE {level.format(rounds)} * w END, 3) AS target FROM d JOIN t{rounds} ON d.source IS NOT DISTINCT FROM t{rounds}.source"""


MIXING_TARGETS = _mixing_targets()

FINGERPRINT_EDITS = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n FROM documents)
SELECT a.doc_id, length(a.t)::BIGINT AS n_chars, sha256(substr(a.t, 1, length(a.t) - length(a.t) // 2) || substr(b.t, 1, length(a.t) // 2)) AS edited_sha256 FROM d a JOIN d b ON b.i = a.i % a.n + 1"""

EXACT_COPIES = f"""WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{GAP}', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, h AS text_sha256 FROM t WINDOW w AS (PARTITION BY h)"""

DIVERGENCE = f"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
  t AS MATERIALIZED (SELECT i, lang, source, unnest(w) AS term FROM d), g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
  k AS MATERIALIZED (SELECT lang, term, count(*) AS ln FROM t GROUP BY ALL HAVING count(DISTINCT i) >= 30),
  s AS (SELECT lang, count(*) AS v, sum(ln) AS lt FROM k GROUP BY 1), c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
  z AS MATERIALIZED (SELECT g.lang, g.source, k.term, ln, v, lt, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang JOIN s ON s.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
  y AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total FROM z),
  p AS MATERIALIZED (SELECT lang, source, term, n, 1 + ((1000000000::HUGEINT * (n + 5)) // (total + 5 * v))::BIGINT AS p, 1 + ((1000000000::HUGEINT * (ln + 5)) // (lt + 5 * v))::BIGINT AS q FROM y),
  f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
  r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50"""

RANKED_SEARCH = f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
  q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
  l AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0), g AS MATERIALIZED (SELECT count(*) AS cn, sum(n)::BIGINT AS cl FROM l),
  t AS (SELECT doc_id, unnest(w) AS term FROM d), f AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
  s AS (SELECT term, floor(1000 * ln((2 * max(cn) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, g GROUP BY 1),
  m AS (SELECT doc_id, 10 + ((90 * n * cn) // cl) AS m FROM l, g),
  o AS (SELECT f.doc_id, f.term, s.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * m.m)) AS part FROM f JOIN s ON s.term = f.term JOIN m ON m.doc_id = f.doc_id),
  x AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM q JOIN o ON o.term = q.term GROUP BY ALL),
  r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
