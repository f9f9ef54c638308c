"""DuckDB SQL with the rows of the registered queries."""

from assayline.llm import quality_rules as rules

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS digest
  FROM documents
), r AS (
  SELECT doc_id, digest,
    row_number() OVER w AS place,
    first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY digest) AS n
  FROM n
  WINDOW w AS (PARTITION BY digest ORDER BY chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, n AS group_size, place = 1 AS kept, digest AS text_sha256 FROM r
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, nr, unnest(parts) AS line, unnest(range(len(parts))) AS place, len(parts) AS n_lines
  FROM (
    SELECT doc_id, row_number() OVER () AS nr,
      string_split(coalesce(text, ''), chr(10)) AS parts
    FROM documents
  )
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT nr) >= 3
), judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.top AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, CAST(max(n_lines) AS BIGINT) AS n_lines,
  CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY nr, doc_id
"""

SOURCE_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
      lambda x: x <> '')) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
      + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM sized GROUP BY source
), named AS (
  SELECT *, (source_size * 3)::DOUBLE AS cap,
    [5::DOUBLE, 2::DOUBLE, 1::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]
      AS weight
  FROM sizes
), levels AS (
  SELECT *, ((SELECT sum(source_size)::DOUBLE FROM named)
      - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM named WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)
), targets AS (
  SELECT *, least(cap, weight * (SELECT max(level) FROM levels WHERE level <= cap / weight))
    AS target FROM levels
), wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END
    AS whole FROM targets
), probs AS (
  SELECT s.doc_id, s.size, s.u, t.source_size, t.target, t.whole, t.source,
    t.target - t.whole * t.source_size AS need,
    CASE WHEN s.size > 0 THEN least(0.999999::DOUBLE, greatest(1e-9::DOUBLE,
      (t.target - t.whole * t.source_size) / t.source_size
      * least(2::DOUBLE, greatest(0.5::DOUBLE, sqrt((t.source_size / t.n) / s.size))))) END AS p
  FROM sized s JOIN wholes t ON s.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / (p / (1 - p)) NULLS LAST,
    doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM probs
)
SELECT doc_id, size, source_size, target,
  CAST((whole + CASE WHEN size > 0 AND need > 0 AND upto - size / 2 <= need THEN 1 ELSE 0 END)
    * size AS BIGINT) AS taken
FROM ranked
"""

_CANONICAL = r"""
CASE WHEN contains({url}, '://') THEN
  regexp_replace(translate(regexp_extract({url}, '://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\.|:(80|443)$', '', 'g')
  || regexp_replace(regexp_extract({url}, '://[^/?#]*([^?#]*)', 1), '/(index\.html?)?$', '')
  || CASE WHEN len({params}) > 0 THEN '?' || array_to_string(list_sort({params}), '&') ELSE '' END
END
""".replace(
    "{params}",
    r"list_filter(string_split(regexp_extract({url}, '^[^?#]*\?([^#]*)', 1), '&'), "
    r"lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))",
).replace("{url}", "url")

URL_FILTER = rf"""
WITH p AS (
  SELECT page_id, url, {_CANONICAL} AS canonical,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(action, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), listed AS (
  SELECT DISTINCT canonical FROM p
  WHERE regexp_matches(url, '[?&](utm_[a-z]+|ref)=') AND canonical IS NOT NULL
), best AS (
  SELECT hp.host, hp.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.action, length(r.host || r.path)) AS action
  FROM (SELECT DISTINCT host, path FROM p) hp JOIN rules r
    ON (hp.host = r.host OR ends_with(hp.host, '.' || r.host)) AND starts_with(hp.path, r.path)
  GROUP BY ALL
)
SELECT page_id, p.host, p.path, rule,
  coalesce(action, CASE WHEN l.canonical IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
  LEFT JOIN listed l ON p.canonical = l.canonical
"""

_COMMON = ", ".join(
    f"(octet_length(encode(spaced)) - octet_length(encode(replace(spaced, ' {w} ', ''))))"
    f" // {len(w.encode()) + 2}"
    for w in rules.COMMON
)
_CLASSES = ", ".join(
    "CAST(len(regexp_extract_all(text, '{}')) AS BIGINT)".format(pattern.replace("'", "''"))
    for _, pattern in rules.CLASSES
)


def _shares(counts: str, whole: str) -> str:
    return (
        f"list_transform(list_append({counts}, greatest(0, {whole} - list_sum({counts}))), "
        f"lambda x: CASE WHEN {whole} > 0 THEN x::DOUBLE / {whole} ELSE 0 END)"
    )


def _distance(p: str, q: str) -> str:
    return (
        "sqrt(greatest(0, list_sum(list_transform(list_zip("
        f"{p}, {q}), lambda z: CASE WHEN z[1] > 0 THEN z[1] * ln(z[1] / ((z[1] + z[2]) / 2)) "
        "ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * ln(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END))"
        f" / (2 * {rules.LN2})))"
    )


def _pool(column: str, n: int) -> str:
    return "[" + ", ".join(f"CAST(sum({column}[{i + 1}]) AS BIGINT)" for i in range(n)) + "]"


QUALITY_RULES = rf"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    '  ' || regexp_replace(lower(text), '[^\pL]+', '  ', 'g') || '  ' AS spaced
  FROM t
), c AS (
  SELECT k, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(text) AS BIGINT) AS chars, [{_CLASSES}] AS classes,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    [{_COMMON}] AS common
  FROM w
), grams AS (
  SELECT k, i, words[i] || chr(1) || words[i + 1] || chr(1) || words[i + 2] AS gram
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS n FROM grams) WHERE n > 1
), repeated AS (
  SELECT k, CAST(count(DISTINCT i + d) AS BIGINT) AS n
  FROM twice, (VALUES (0), (1), (2)) AS v(d) GROUP BY k
), b AS (
  SELECT c.*, coalesce(r.n, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed
  FROM c LEFT JOIN repeated r ON c.k = r.k
), sound AS (
  SELECT * FROM b WHERE NOT base_failed AND n_words >= {rules.LEAST_WORDS}
), sums AS (
  SELECT lang, grouping(lang) AS whole, {_pool("classes", len(rules.CLASSES))} AS cs, {_pool("common", len(rules.COMMON))}
    AS ws, CAST(sum(chars) AS BIGINT) AS cn, CAST(sum(n_words) AS BIGINT) AS wn
  FROM sound GROUP BY GROUPING SETS ((lang), ())
), refs AS (
  SELECT lang, whole, {_shares("cs", "cn")} AS ref_classes, {_shares("ws", "wn")} AS ref_words FROM sums
), judged AS (
  SELECT b.*,
    {_distance(_shares("classes", "chars"), "coalesce(r.ref_classes, p.ref_classes)")} AS by_class,
    {_distance(_shares("common", "n_words"), "coalesce(r.ref_words, p.ref_words)")} AS by_word
  FROM b LEFT JOIN refs r ON r.lang = b.lang AND r.whole = 0 LEFT JOIN refs p ON p.whole = 1
)
SELECT doc_id, n_words, chars - classes[4] AS word_chars, classes[5] AS n_symbols, n_dup_lines,
  n_repeat_words, base_failed,
  NOT base_failed AND (n_words < {rules.LEAST_WORDS} OR coalesce(
    by_class <= {rules.MOST_CLASSES} AND by_word <= {rules.MOST_WORDS}, true)) AS kept
FROM judged
"""
