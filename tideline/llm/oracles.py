"""DuckDB SQL of the queries that SQL can express on whole tables; the tests hold the others against
brute force."""

from __future__ import annotations

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     m AS (SELECT h, max(page_id) AS last FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM p LEFT JOIN m USING (h)
"""

OP13 = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_aggregate(ws[i:i + k - 1], 'string_agg', ' '))) AS phrase
      FROM w, range(1, 5) AS t(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
size AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1 AND f >= 30),
cut AS (SELECT lang, phrase, a, i, list_aggregate(ws[1:i], 'string_agg', ' ') AS first, list_aggregate(ws[i + 1:k], 'string_agg', ' ') AS rest
        FROM c, range(1, 4) AS t(i) WHERE i < k),
s AS (SELECT cut.lang, cut.phrase, cut.a, x.f AS l, y.f AS r, 2000000 * cut.a // (x.f + y.f) AS score, i,
             row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY 2000000 * cut.a // (x.f + y.f), i) AS nth
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.first JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rest),
inner_ AS (SELECT DISTINCT c.lang, c.a AS longer, list_aggregate(c.ws[i:i + m - 1], 'string_agg', ' ') AS phrase
           FROM c, range(2, 4) AS t(m), range(1, 4) AS u(i) WHERE m < c.k AND i + m - 1 <= c.k),
gone AS (SELECT lang, phrase, max(longer) AS longer FROM inner_ GROUP BY ALL),
kept AS (SELECT s.* FROM s LEFT JOIN gone ON gone.lang = s.lang AND gone.phrase = s.phrase
         WHERE nth = 1 AND (longer IS NULL OR 100 * longer < 80 * a)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM r JOIN size ON size.lang = r.lang WHERE rank <= 2000
"""

OP5 = """
WITH own AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
outcomes AS (SELECT doc_id, count(quality) AS n, sum(quality)::DOUBLE AS good FROM labels GROUP BY doc_id),
counts AS (SELECT host, sum(coalesce(n, 0))::DOUBLE AS n, sum(coalesce(good, 0)) AS good
           FROM own LEFT JOIN outcomes ON doc_id = page_id GROUP BY host),
split AS (SELECT *, string_split(host, '.') AS p FROM counts),
tails AS (SELECT *, array_to_string(p[greatest(len(p) - 1, 1):], '.') AS two, array_to_string(p[greatest(len(p) - 2, 1):], '.') AS three FROM split),
hosts AS (SELECT host, n, good, CASE WHEN two IN ({two}) THEN two ELSE p[len(p)] END AS suffix,
                 CASE WHEN two IN ({two}) THEN three ELSE two END AS domain FROM tails),
total AS (SELECT coalesce(sum(good), 0) + 1 AS a, coalesce(sum(n) - sum(good), 0) + 1 AS b FROM hosts),
suffix0 AS (SELECT suffix, n, good, a / (a + b) AS prior, a / (a + b) - sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) AS above
            FROM (SELECT suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY suffix), total),
{suffix},
domain0 AS (SELECT domain, d.n, d.good, s.mean AS prior, s.reputation AS above
            FROM (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL) d JOIN suffix2 s USING (suffix)),
{domain},
host0 AS (SELECT host, h.n, h.good, d.mean AS prior, d.reputation AS above FROM hosts h JOIN domain2 d USING (domain)),
{host},
ruled AS (SELECT *, CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                         WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM own)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/fr/', 'org/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN reputation >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
FROM ruled JOIN host2 USING (host)
"""


def _level(key: str) -> str:
    """Weight and posterior of one level of host reputation: key0 (n, good, prior, above) to key2 (mean, reputation)."""
    return f"""{key}w AS (
  SELECT least(greatest(coalesce(CASE WHEN many > 0 AND (spread - unit) / many > 0 THEN many / (spread - unit) - 1 END, 1000.0), 2.0), 1000.0) AS w
  FROM (SELECT sum(n * pow(good / n - prior, 2)) AS spread, sum(prior * (1 - prior)) AS unit, sum(prior * (1 - prior) * (n - 1)) AS many
        FROM {key}0 WHERE n > 0)),
{key}1 AS (SELECT *, (w * prior + good) / (w + n) AS m, w + n AS weight FROM {key}0, {key}w),
{key}2 AS (SELECT {key}, CASE WHEN n > 0 THEN m ELSE prior END AS mean,
                  CASE WHEN n > 0 THEN m - sqrt(m * (1 - m) / (weight + 1)) ELSE above END AS reputation FROM {key}1)"""


_TWO = "'co.uk', 'org.uk', 'ac.uk', 'com.au', 'com.br', 'co.jp', 'co.in', 'co.nz', 'com.cn'"
OP5 = OP5.format(two=_TWO, suffix=_level("suffix"), domain=_level("domain"), host=_level("host"))

ORACLES: dict[str, str] = {"op5_url_filters": OP5, "op10_warc": OP10, "op13_collocations": OP13}
