"""SQL equivalents of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

from tidewire.functions.profiles import CATEGORIES, LATIN, MAX_ARTICLES, MAX_PER_PUBLISHER_OUT, MIN_PUBLISHERS
from tidewire.plans.fixtures import FIXTURE_INJECTION

ORACLES: dict[str, str] = {}

CATEGORY_LIST = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"


def wall(ts: str) -> str:
    return f"({ts} + INTERVAL 9 HOUR)"


def slot_end(ts: str) -> str:
    w = wall(ts)
    return (
        f"(date_trunc('day', {w}) + CASE WHEN hour({w}) < 6 THEN INTERVAL 6 HOUR WHEN hour({w}) < 12 THEN INTERVAL 12 HOUR "
        f"WHEN hour({w}) < 18 THEN INTERVAL 18 HOUR ELSE INTERVAL 30 HOUR END)"
    )


def edition_id(end: str) -> str:
    return f"strftime({end}, '%Y-%m-%d-%H')"


def edition(ts: str) -> str:
    return edition_id(slot_end(ts))


def following(end: str) -> str:
    return f"({end} + CASE WHEN hour({end}) = 18 THEN INTERVAL 12 HOUR ELSE INTERVAL 6 HOUR END)"


def squash(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[\s\x{{00a0}}\p{{Z}}]+', ' ', 'g'))"


CAND = rf"""cand AS (
  SELECT doc_id AS ord, 'd' || doc_id AS id, regexp_extract(text, '^[^.\n]+') AS title, text AS description,
    'https://' || source || '.example.org/' || doc_id AS url, source AS source_name, source AS publisher_id,
    {CATEGORY_LIST}[doc_id % 9 + 1] AS category,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 300) AS published_at,
    CAST(1 + doc_id % 5 AS INT) AS priority, doc_id % 7 = 0 AS primary_source
  FROM documents)"""
ITEMS = rf"""{CAND}, items AS (
  SELECT * REPLACE ('https://news.example.org/' || md5(title) AS url), {edition('published_at')} AS edition_id FROM cand)"""


def title_norm(c: str) -> str:
    folded = f"lower(rtrim(substr({squash(c)}, 1, 300)))"
    bare = rf"regexp_replace({folded}, '[\s\p{{Z}}]*[|｜:：\-—–][\s\p{{Z}}]*[^|｜:：\-—–]{{1,28}}$', '')"
    return rf"regexp_replace({bare}, '[^0-9a-z\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}]+', '', 'g')"


def fold_key(c: str) -> str:
    return rf"regexp_replace(replace(lower(rtrim(substr({c}, 1, 500))), 'ß', 'ss'), '[^\p{{L}}\p{{N}}]+', '', 'g')"


ORACLES["edition_slot_counts"] = f"""
SELECT {edition('ts')} AS edition_id, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY 1, 2"""

ORACLES["window_assignment"] = f"""
WITH {CAND}, own AS (SELECT published_at, {slot_end('published_at')} AS e FROM cand),
all_ends AS (
  SELECT e AS window_end, false AS late FROM own
  UNION ALL
  SELECT {following('e')}, true FROM own WHERE published_at + INTERVAL 9 HOUR >= e - INTERVAL 90 MINUTE)
SELECT {edition_id('window_end')} AS edition_id, count(*) FILTER (NOT late) AS on_time, count(*) FILTER (late) AS from_grace
FROM all_ends GROUP BY 1"""

ORACLES["missing_windows"] = f"""
WITH p AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1),
q AS (SELECT user_id, {slot_end('a')} AS mark, date_trunc('day', {wall('b')}) + CASE
    WHEN hour({wall('b')}) >= 18 THEN INTERVAL 18 HOUR WHEN hour({wall('b')}) >= 12 THEN INTERVAL 12 HOUR
    WHEN hour({wall('b')}) >= 6 THEN INTERVAL 6 HOUR ELSE INTERVAL (-6) HOUR END AS target FROM p),
grid AS (SELECT user_id, unnest(generate_series(date_trunc('day', mark), target, INTERVAL 6 HOUR)) AS e, mark, target FROM q),
later AS (SELECT user_id, e, row_number() OVER (PARTITION BY user_id ORDER BY e) AS k FROM grid
  WHERE hour(e) IN (6, 12, 18) AND e > mark AND e <= target),
capped AS (SELECT user_id, e, row_number() OVER (PARTITION BY user_id ORDER BY e DESC) AS back FROM later WHERE k <= 61)
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY e) - 1 AS INT) AS run_order, {edition_id('e')} AS edition_id,
  CASE hour(e) WHEN 6 THEN '朝6時版' WHEN 12 THEN '昼12時版' ELSE '夕方6時版' END AS label
FROM capped WHERE back <= 9"""

ORACLES["rolling_context"] = f"""
WITH {CAND}, own AS (SELECT url, published_at, {slot_end('published_at')} AS e FROM cand),
ends AS (SELECT DISTINCT date_trunc('day', e) + to_hours(h) + to_days(d) AS window_end FROM own, (VALUES (6), (12), (18)) v(h), (VALUES (0), (1)) w(d))
SELECT {edition_id('window_end')} AS edition_id, {edition_id('e')} AS origin_edition_id, count(*) AS n,
  min('context-' || substr(sha256(url), 1, 20)) AS first_id
FROM own JOIN ends ON window_end > e AND window_end - INTERVAL 24 HOUR <= published_at + INTERVAL 9 HOUR
GROUP BY 1, 2"""

URL_PARTS = r"""parts AS (
  SELECT page_id, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS host,
    regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path,
    list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_') AND NOT starts_with(p, 'ref=')) AS query
  FROM pages),
canonical AS (
  SELECT page_id, scheme || '://' || host || CASE WHEN path IN ('', '/') THEN '/' ELSE rtrim(regexp_replace(path, '/+', '/', 'g'), '/') END
    || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical FROM parts)"""

ORACLES["canonical_urls"] = f"WITH {URL_PARTS} SELECT page_id, canonical FROM canonical"

ORACLES["digest_by_slot"] = f"""
WITH {URL_PARTS}, items AS (
  SELECT page_id, canonical, regexp_extract(url, '^https?://([^/]+)', 1) AS publisher,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id * 600) AS published_at FROM canonical JOIN pages USING (page_id)),
keyed AS (SELECT *, {edition('published_at')} AS edition_id FROM items),
firsts AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY edition_id, canonical ORDER BY published_at, page_id) = 1)
SELECT edition_id, publisher, count(*) AS n, min(published_at) AS first_at, max(published_at) AS last_at FROM firsts GROUP BY 1, 2"""

ORACLES["seen_url_antijoin"] = f"""
WITH {ITEMS} SELECT id, edition_id, url FROM items 
WHERE ord % 2 = 1 AND NOT EXISTS (FROM items AS s WHERE s.ord % 2 = 0 AND s.url = items.url AND s.edition_id < items.edition_id)"""

ORACLES["merge_evidence"] = f"""
WITH {ITEMS}, sided AS (SELECT *, ord % 3 = 0 AS context_only FROM items)
SELECT url, id, context_only FROM sided
QUALIFY row_number() OVER (PARTITION BY url ORDER BY context_only, length(description) DESC, ord) = 1"""

ORACLES["state_append_and_prune"] = f"""
WITH {ITEMS} SELECT ord AS seq, edition_id, {title_norm('title')} AS title, published_at, url AS urls FROM items
WHERE ord % 2 = 0 AND published_at >= TIMESTAMP '2024-01-02 00:00:00' QUALIFY row_number() OVER (ORDER BY ord DESC) <= 8000"""

BULLETINS = """b AS (SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS event_id, json_extract_string(props, '$.k') AS serial, ts AS published_at,
  ['0', '1', '2', '3', '4', '5-', '5+', '6-'][CAST(floor(value) AS BIGINT) % 8 + 1] AS max_intensity, length(event_type) AS richness,
  event_type AS product_title FROM events)"""

ORACLES["latest_bulletin"] = f"""
WITH {BULLETINS} SELECT event_id, ord AS bulletin, published_at, serial, max_intensity FROM b
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY published_at DESC, CAST(serial AS INT) DESC, richness DESC, ord) = 1"""

ORACLES["bulletin_severity_filter"] = f"""
WITH {BULLETINS}, r AS (SELECT *, product_title IN ('signup', 'error') OR max_intensity IN ('3', '4', '5-', '5+', '6-') AS k FROM b)
SELECT product_title, max_intensity, count(*) FILTER (k) AS kept, count(*) FILTER (NOT k) AS dropped FROM r GROUP BY 1, 2"""

ORACLES["bulletin_extraction"] = f"""
WITH {BULLETINS}, s AS (SELECT *, CASE max_intensity WHEN '5-' THEN '5弱' WHEN '5+' THEN '5強' WHEN '6-' THEN '6弱' ELSE max_intensity END AS shown,
  'region ' || ord % 47 AS place, strftime(published_at + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S+09:00') AS origin FROM b)
SELECT ord, place || 'で地震 最大震度' || shown AS title,
  '発生時刻: ' || origin || '。 震央・震源地域: ' || place || '。 最大震度: ' || shown || '。 報 ' || ord || '。 警報: ' || place || '。' AS description,
  '震度 ' || product_title AS product, max_intensity AS intensity, event_id AS event, serial FROM s"""

W = r"\p{L}\p{N}_"
STOPS = ".。！？!?"


def word(alternatives: str) -> str:
    """Whole-word search for an engine without Unicode word boundaries."""
    return rf"(?i)(?:^|[^{W}])(?:{alternatives})(?:$|[^{W}])"


FEEDS = f"""feeds AS (
  SELECT source, CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) AS n FROM (SELECT DISTINCT source FROM documents)),
usable AS (SELECT * FROM feeds WHERE n % 11 <> 10 AND n % 10 <> 9 AND (n % 13 <> 12 OR n % 4 = 2))"""

ORACLES["registry_problems"] = f"""
WITH {FEEDS}
SELECT source AS id, 'category' AS rule FROM feeds WHERE n % 11 = 10
UNION ALL SELECT source, 'maxFeedBytes' FROM feeds WHERE n % 10 = 9
UNION ALL SELECT source, 'excludeTitlePatterns' FROM feeds WHERE n % 13 = 12 AND n % 4 <> 2"""


def escaped(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


PAYLOADS = f"""{CAND}, {FEEDS}, sized AS (
  SELECT c.*, u.n, strlen('<rss><channel><title>feed</title><item><title>' || {escaped('title')} || '</title><link>' ||
      {escaped("CASE WHEN ord % 2 = 0 THEN 'http://' ELSE 'https://' END || source_name || '.example.org//doc/' || ord || '/?utm_source=feed&id=' || ord")}
      || '</link><pubDate>' || strftime(published_at, '%a, %d %b %Y %H:%M:%S') || ' GMT</pubDate><description>' || {escaped('description')}
      || '</description></item></channel></rss>') + CASE WHEN ord % 97 = 96 THEN 14 ELSE 0 END AS bytes
  FROM cand c JOIN usable u ON u.source = c.source_name),
judged AS (SELECT *, CASE WHEN bytes > (CASE WHEN n % 4 = 3 THEN 20000 ELSE 2000000 END) THEN 'too large'
    WHEN ord % 97 = 96 THEN 'document type not allowed' END AS reason FROM sized)"""

ORACLES["payload_outcomes"] = f"""
WITH {PAYLOADS}
SELECT u.source AS feed_id, coalesce(bool_or(j.ord IS NOT NULL AND reason IS NULL), false) AS ok,
  coalesce(string_agg(DISTINCT reason, ', ' ORDER BY reason), '') AS reasons
FROM usable u LEFT JOIN judged j ON j.source_name = u.source GROUP BY 1"""

# the text rules of the fixture profile, for an engine without Unicode word boundaries
TEXT_RULES = (
    ("スポーツ", rf"(?i)(?:^|[^{W}])(?:threed|ounon)"),
    ("エンタメ", word("avec|mit")),
    ("海外", word("dans|und")),
    ("テクノロジー", word("this")),
    ("経済", word("was")),
    ("科学", word("from")),
    ("社会", word("are|para")),
)
TITLE_RULES = (("スポーツ", word("with|mit")), ("エンタメ", word("are|avec")), ("テクノロジー", word("this|las")), ("海外", word("dans|und")))


def rules(c: str, table, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{rx}') THEN '{name}'" for name, rx in table) + f" ELSE {otherwise} END"


ORACLES["entry_conversion"] = f"""
WITH {PAYLOADS}, e AS (
  SELECT *, rtrim(substr({squash('title')}, 1, 260)) AS t, rtrim(substr({squash('description')}, 1, 900)) AS d,
    CASE WHEN ord % 2 = 0 AND n % 3 <> 0 THEN 'http' ELSE 'https' END || '://' || source_name || '.example.org/doc/' || ord || '?id=' || ord AS u
  FROM judged WHERE reason IS NULL),
kept AS (SELECT * FROM e WHERE t <> '' AND NOT (n % 4 = 2 AND regexp_matches(t, '{word("mit")}'))
  AND (n % 3 <> 1 OR regexp_matches(t, '{word("the")}') OR regexp_matches(t, '(?i)^[aeiou]')))
SELECT substr(sha256('Feed ' || source_name || '|' || u || '|' || strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00')), 1, 18) AS id,
  t AS title, CASE WHEN n % 6 = 5 THEN '' ELSE d END AS description, u AS url, 'Feed ' || source_name AS source_name, 'house' || n % 7 AS publisher_id,
  CASE WHEN n % 2 = 0 THEN {rules("t || ' ' || d || ' '", TEXT_RULES, f"{CATEGORY_LIST}[n % 9 + 1]")} ELSE {CATEGORY_LIST}[n % 9 + 1] END AS category,
  published_at, CAST(least(greatest(n % 8, 1), 5) AS INT) AS priority, n % 5 = 0 AS primary_source FROM kept"""

OPENED = r"^【\s*([^】]{1,180}?)\s*】"
BRACKETED = squash("CASE WHEN ord % 6 = 1 THEN '【No. ' || ord || ' ' || title || '】' ELSE '' END || description")
ORACLES["tagged_entries"] = f"""
WITH {CAND}, {FEEDS}, e AS (
  SELECT c.*, f.n, rtrim(substr({squash('title')}, 1, 260)) AS p, rtrim(substr({BRACKETED}, 1, 900)) AS d,
    CASE WHEN ord % 2 = 0 AND n % 3 <> 0 THEN 'http' ELSE 'https' END || '://' || source_name || '.example.org/doc/' || ord || '?id=' || ord AS u
  FROM cand c JOIN feeds f ON f.source = c.source_name
  WHERE ord % 97 <> 96 AND n % 11 <> 10 AND (n % 13 <> 12 OR n % 4 = 2) AND (n % 5 <> 1 OR ord % 4 IN (1, 3)) AND NOT (n % 5 = 2 AND ord % 4 = 1)),
b AS (SELECT *, CASE WHEN n % 2 = 1 AND regexp_matches(d, '{OPENED}') THEN regexp_extract(d, '{OPENED}', 1) ELSE p END AS t FROM e),
kept AS (SELECT * FROM b WHERE t <> '' AND NOT (n % 4 = 2 AND regexp_matches(t, '{word("mit")}'))
  AND (n % 3 <> 1 OR regexp_matches(t, '{word("the")}') OR regexp_matches(t, '(?i)^[aeiou]')) AND (n % 7 <> 3 OR regexp_matches(p, '{word("the")}')))
SELECT substr(sha256('Feed ' || source_name || '|' || u || '|' || strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00')), 1, 18) AS id,
  t AS title, p AS product_title, CASE WHEN n % 6 = 5 THEN '' ELSE d END AS description, u AS url,
  CASE WHEN n % 2 = 1 THEN {CATEGORY_LIST}[n % 9 + 1] WHEN ord % 4 = 0 THEN 'スポーツ' WHEN ord % 4 = 1 THEN '科学' WHEN ord % 4 = 3 THEN '経済'
    ELSE {rules("t || ' ' || d || ' '", TEXT_RULES, f"{CATEGORY_LIST}[n % 9 + 1]")} END AS category FROM kept"""

ORACLES["linked_pages"] = rf"""
WITH {CAND}, given AS (SELECT id, title, rtrim(substr({squash("unnest(string_split(description, chr(10)))")}, 1, 1500)) AS line,
    generate_subscripts(string_split(description, chr(10)), 1) AS i FROM cand WHERE ord % 2 = 0 AND ord % 5 <> 4),
firsts AS (SELECT *, regexp_replace(replace(lower(line), 'ß', 'ss'), '[\s\p{{Z}}]+', '', 'g') AS key FROM given
  WHERE line <> '' AND ({title_norm('title')} = '' OR {title_norm('line')} <> {title_norm('title')})
  QUALIFY row_number() OVER (PARTITION BY id, key ORDER BY i) = 1),
pages AS (SELECT id, string_agg(line, ' ' ORDER BY i) AS whole FROM firsts GROUP BY 1),
clipped AS (SELECT id, whole, substr(whole, 1, 900) AS head, regexp_extract(substr(whole, 1, 900), '^(.*[。！？])', 1) AS ended FROM pages),
detail AS (SELECT id, CASE WHEN length(whole) <= 900 THEN whole WHEN length(ended) > 160 THEN rtrim(ended) ELSE rtrim(head) END AS detail FROM clipped),
joined AS (SELECT c.id, url, description, ord, detail, coalesce(ord % 2 = 0 AND length(detail) >= 200 + 100 * (ord % 4), false) AS enough FROM cand c LEFT JOIN detail USING (id))
SELECT id, url, length(CASE WHEN enough THEN detail ELSE description END) AS n, md5(CASE WHEN enough THEN detail ELSE description END) AS digest
FROM joined WHERE ord % 2 = 1 OR enough OR ord % 3 <> 0"""

ORACLES["rule_filter"] = f"""
WITH {FEEDS} SELECT doc_id, d.source FROM documents d JOIN usable u USING (source)
WHERE NOT (n % 4 = 2 AND regexp_matches(text, '{word("mit")}'))
  AND (n % 3 <> 1 OR regexp_matches(text, '{word("the")}') OR regexp_matches(text, '(?i)^[aeiou]'))"""

ORACLES["category_inference"] = f"""
WITH {CAND} SELECT id, category, {rules("title || ' ' || description", TEXT_RULES, 'category')} AS inferred FROM cand"""


def spaced(c: str) -> str:
    """Trimmed sentences joined by single spaces."""
    return squash(rf"regexp_replace({squash(c)}, '([{STOPS}])', '\1 ', 'g')")


ORACLES["desk_category"] = f"""
WITH {CAND}, d AS (SELECT id, {rules(f"rtrim(substr({spaced('title')}, 1, 180))", TITLE_RULES, 'category')} AS desk FROM cand)
SELECT id, desk, CASE WHEN desk IN ('国内', '社会', '経済', '海外', '国際', 'その他') THEN 'public'
    WHEN desk IN ('テクノロジー', '科学', '文化', 'エンタメ') THEN 'technology_culture' ELSE desk END AS family,
  CASE desk WHEN '国内' THEN 'domestic' WHEN '海外' THEN 'world' WHEN '経済' THEN 'economy' WHEN '社会' THEN 'society' WHEN '科学' THEN 'science'
    WHEN 'テクノロジー' THEN 'technology' WHEN 'エンタメ' THEN 'entertainment' WHEN 'スポーツ' THEN 'sports' ELSE 'other' END AS category_id
FROM d"""

ORACLES["linked_page_rules"] = r"""
SELECT page_id, regexp_matches(url, '^https://([^/]*\.)?example\.(com|org)/(en|fr)/[^/?#.]*(\.html?)?/?([?#]|$)') AS allowed FROM pages"""

ORACLES["clean_documents"] = f"""
SELECT doc_id, length({squash('text')}) AS n, md5({squash('text')}) AS digest FROM documents"""

ORACLES["title_keys"] = f"""
WITH {CAND} SELECT id, {title_norm('title')} AS title_norm, {fold_key(squash('title'))} AS title_key,
  regexp_matches(title, '[A-Za-z]') AS readable FROM cand"""

INJECTED = rf"(?i)(?:^|[^{W}])(?:with|avec|mit|con)[^{W}](?:.{{0,58}}[^{W}])?(?:the|le|der|la)(?:$|[^{W}])"
ORACLES["injection_filter"] = rf"""
WITH parts AS (SELECT conv_id, turn, list_transform(regexp_extract_all({squash('text')}, '[^{STOPS}]*[{STOPS}]|[^{STOPS}]+'), lambda p: trim(p)) AS p FROM conversations),
safe AS (SELECT conv_id, turn, array_to_string(list_filter(p, lambda s: s <> '' AND NOT regexp_matches(s, '{INJECTED}')), ' ') AS t FROM parts)
SELECT conv_id, turn, length(t) AS n, md5(t) AS digest FROM safe"""

CUT = rf"(?: th| qu| ge)\s*[{STOPS}]"


def sentence_list(c: str) -> str:
    return rf"list_filter(list_transform(regexp_extract_all({c}, '[^{STOPS}]*[{STOPS}]|[^{STOPS}]+'), lambda p: trim(p)), lambda p: p <> '')"


ORACLES["complete_descriptions"] = rf"""
WITH {CAND}, c AS (SELECT id, rtrim(substr({squash('description')}, 1, 3600)) AS t FROM cand),
s AS (SELECT id, t, list_filter({sentence_list('t')}, lambda p: NOT regexp_matches(p, '{CUT}') AND length(p) <= 900) AS p FROM c),
r AS (SELECT id, CASE WHEN length(t) <= 900 AND NOT regexp_matches(t, '{CUT}') THEN t ELSE
  array_to_string(p[1:list_max(list_filter(range(0, len(p) + 1), lambda k: length(array_to_string(p[1:k], ' ')) <= 900))], ' ') END AS t FROM s)
SELECT id, length(t) AS n, md5(t) AS digest FROM r"""

ORACLES["excerpts"] = rf"""
WITH {CAND}, c AS (SELECT id, rtrim(substr({spaced(f"substr({squash('description')}, 1, 1320)")}, 1, 440)) AS t FROM cand),
s AS (SELECT id, list_filter(list_transform(regexp_extract_all(t, '[^{STOPS}]+[{STOPS}]?'), lambda p: trim(p)), lambda p: p <> '') AS p FROM c),
b AS (SELECT id, array_to_string(p[1:list_max(list_filter(range(0, least(len(p), 3) + 1), lambda k: length(array_to_string(p[1:k], '')) <= 280))], '') AS x FROM s)
SELECT id, CASE WHEN x = '' OR regexp_matches(x, '[{STOPS}]$') THEN x ELSE x || '.' END AS excerpt FROM b"""

ORACLES["clipped_titles"] = rf"""
WITH {CAND}, c AS (SELECT id, rtrim(substr({squash('title')}, 1, 260)) AS t FROM cand),
s AS (SELECT id, t, rtrim(substr(t, 1, 39)) AS a, regexp_extract(rtrim(substr(t, 1, 39)), '^(.*[。！？!?｜|：:])', 1) AS b FROM c),
p AS (SELECT id, t, CASE WHEN length(b) - 1 >= 20 THEN rtrim(b, '｜|：: ') ELSE a END AS a FROM s)
SELECT id, CASE WHEN length(t) <= 40 THEN t ELSE rtrim(a, '、,・/／｜|：:-') || '…' END AS clipped, true AS balanced FROM p"""

ORACLES["sentence_sections"] = rf"""
WITH {CAND}, s AS (
  SELECT id, unnest(list_transform(regexp_extract_all({spaced('description')}, '[^{STOPS}]+[{STOPS}]?'), lambda p: trim(p))) AS t,
    generate_subscripts(regexp_extract_all({spaced('description')}, '[^{STOPS}]+[{STOPS}]?'), 1) AS i FROM cand),
e AS (SELECT id, i, CASE WHEN regexp_matches(t, '[{STOPS}]$') THEN t ELSE t || '.' END AS t FROM s
  WHERE t <> '' AND length(t) <= 240 AND NOT regexp_matches(t, '{CUT}')),
k AS (SELECT id, i, t, {fold_key('t')} AS key FROM e),
d AS (SELECT * FROM k WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY id, key ORDER BY i) = 1),
c AS (SELECT id, t, key, CASE WHEN regexp_matches(t, '{word("will|by|sur|zu|por")}') THEN 'watch'
  WHEN regexp_matches(t, '{word("with|avec|mit|con")}') OR regexp_matches(t, '{word("this|dans|und|para")}') THEN 'impact'
  WHEN regexp_matches(t, '{word("was|from|du|das|del")}') THEN 'background' ELSE 'facts' END AS section FROM d)
SELECT id, section, count(*) AS n, sum(length(key)) AS key_chars, min(t) AS first_text FROM c GROUP BY 1, 2"""

ORACLES["event_identity"] = f"""
WITH e AS (SELECT event_id AS n, {wall('ts')} AS w, (event_id % 8) || '.' || (event_id % 10) AS size, event_id % 31 + 1 AS d, event_id % 12 + 1 AS m FROM events)
SELECT n AS event_id, CASE n % 5
  WHEN 0 THEN coalesce('earthquake:indonesia-flores:' || strftime(try_strptime(year(w) || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0'), '%Y-%m-%d'), '%Y-%m-%d') || ':m' || size, '')
  WHEN 1 THEN coalesce('earthquake:indonesia-flores:' || strftime(try_strptime(strftime(w, '%Y-%m-') || lpad(d::VARCHAR, 2, '0'), '%Y-%m-%d'), '%Y-%m-%d') || ':m' || size, '')
  WHEN 2 THEN 'earthquake:地点' || n % 47 || ':' || strftime(w, '%Y-%m-%dt%H:%M:%S+09:00')
  WHEN 3 THEN 'technology:claude-watermark' ELSE '' END AS signature FROM e"""


def trigrams(c: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({c}) - 2, 1) + 1), lambda i: substr({c}, i, 3)))"


ORACLES["text_overlap"] = rf"""
WITH t AS (SELECT conv_id, turn, regexp_replace(lower(text), '[^0-9a-z\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}]+', '', 'g') AS own FROM conversations),
p AS (SELECT *, coalesce(lag(own) OVER (PARTITION BY conv_id ORDER BY turn), '') AS ref FROM t)
SELECT conv_id, turn, length(own) AS n, own <> '' AND ref <> '' AND (own = ref OR CASE WHEN length(own) < 12 THEN contains(ref, own)
  ELSE len(list_intersect({trigrams('own')}, {trigrams('ref')})) / len({trigrams('own')}) >= 0.68 END) AS overlap FROM p"""

def bare(c: str) -> str:
    return rf"regexp_replace(lower({c}), '[^0-9a-z\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}]+', '', 'g')"


def repeated(c: str) -> str:
    """The text repeats one of refs, whose trigrams are seen."""
    return f"""({c} <> '' AND (list_contains(refs, {c}) OR CASE WHEN length({c}) < 12 THEN len(list_filter(refs, lambda r: contains(r, {c}))) > 0
  ELSE len(list_intersect({trigrams(c)}, seen)) / len({trigrams(c)}) >= 0.68 END))"""


ORACLES["said_before"] = rf"""
WITH t AS (SELECT conv_id, turn, replace(text, '.', '。') AS x FROM conversations),
r AS (SELECT *, {bare('x')} AS own, list_filter([{', '.join(bare(f"coalesce(lag(x, {k}) OVER o, '')") for k in (1, 2, 3))}], lambda v: v <> '') AS refs
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, list_distinct(flatten(list_transform(refs, lambda v: {trigrams('v')}))) AS seen,
  list_filter(list_transform(regexp_extract_all(trim(x), '[^。！？!?]+[。！？!?]?'), lambda p: trim(p)), lambda p: p <> '') AS parts FROM r),
s AS (SELECT conv_id, turn, refs, seen, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM g),
k AS (SELECT *, {bare('part')} AS c FROM s),
f AS (SELECT conv_id, turn, string_agg(part, '' ORDER BY i) AS rest, count(*) AS n_rest FROM k WHERE NOT {repeated('c')} GROUP BY 1, 2),
w AS (SELECT g.conv_id, g.turn, x, CASE WHEN trim(x) = '' OR {repeated('own')} THEN '' WHEN len(parts) <= 1 OR coalesce(n_rest, 0) = len(parts) THEN trim(x)
  ELSE coalesce(rest, '') END AS fresh FROM g LEFT JOIN f USING (conv_id, turn))
SELECT conv_id, turn, length(x) AS n, length(fresh) AS n_fresh, md5(fresh) AS digest FROM w"""

# ---- similarity and quotas -------------------------------------------------------------------------------

EDITIONED = f"{CAND}, ed AS (SELECT *, {edition('published_at')} AS edition_id FROM cand)"


def bigrams(c: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({c}) - 1, 1) + 1), lambda i: substr({c}, i, 2)))"


ORACLES["title_jaccard_pairs"] = f"""
WITH {EDITIONED}, t AS (SELECT DISTINCT edition_id, {title_norm('title')} AS t FROM ed), g AS (SELECT *, {bigrams('t')} AS s FROM t WHERE t <> ''),
p AS (SELECT edition_id, a.t AS left_title, b.t AS right_title, len(list_intersect(a.s, b.s)) AS k, len(a.s) + len(b.s) AS n
  FROM g a JOIN g b USING (edition_id) WHERE a.t < b.t)
SELECT edition_id, left_title, right_title, round(k / (n - k), 6) AS jaccard FROM p WHERE k / (n - k) >= 0.72"""

ORACLES["jaccard_seen_filter"] = f"""
WITH {EDITIONED}, b AS MATERIALIZED (SELECT id, ord, edition_id, published_at, primary_source, t, {bigrams('t')} AS s
  FROM (SELECT *, {title_norm('title')} AS t FROM ed)),
p AS MATERIALIZED (SELECT i.id, i.s AS own, p.s AS other FROM b i JOIN b p ON p.edition_id < i.edition_id
  AND p.published_at >= i.published_at - INTERVAL 36 HOUR AND p.published_at <= i.published_at + INTERVAL 36 HOUR
  WHERE i.ord % 2 = 1 AND p.ord % 2 = 0 AND NOT i.primary_source AND i.t <> '' AND p.t <> ''
  AND least(len(i.s), len(p.s)) >= 0.7 * greatest(len(i.s), len(p.s))),
k AS MATERIALIZED (SELECT id, len(list_intersect(own, other)) AS k, len(own) + len(other) AS n FROM p),
seen AS (SELECT DISTINCT id FROM k WHERE k / (n - k) >= 0.72)
SELECT id, edition_id, primary_source FROM b WHERE ord % 2 = 1 AND id NOT IN (SELECT id FROM seen)"""

QUOTA_ORDER = "priority DESC, published_at DESC, ord"
USABLE = f"{EDITIONED}, ok AS (SELECT * FROM ed WHERE regexp_matches(title, '[A-Za-z]'))"

ORACLES["publisher_quota"] = f"""
WITH {USABLE}, r AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY edition_id, source_name, category ORDER BY {QUOTA_ORDER}) <= 1),
h AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY edition_id, source_name ORDER BY {QUOTA_ORDER}) = 1),
top AS (SELECT edition_id, source_name FROM h QUALIFY row_number() OVER (PARTITION BY edition_id ORDER BY {QUOTA_ORDER}) <= 12)
SELECT edition_id, source_name AS publisher, category, ord FROM r JOIN top USING (edition_id, source_name)"""


def limiter(total: int = 24, per_publisher: int = 6) -> str:
    """The three passes of the limiter, one step per category."""
    steps = [
        f"u AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY {QUOTA_ORDER}) AS place FROM ok)",
        f"""s0 AS MATERIALIZED (SELECT edition_id, place, source_name, 0 AS pass FROM u
          QUALIFY row_number() OVER (PARTITION BY edition_id, source_name ORDER BY place) = 1),
        p0 AS MATERIALIZED (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY edition_id ORDER BY place) <= {total})""",
    ]
    for i, category in enumerate(CATEGORIES):
        steps.append(
            f"""n{i} AS MATERIALIZED (SELECT edition_id, count(*) AS taken FROM p{i} GROUP BY 1),
        c{i} AS MATERIALIZED (SELECT edition_id, source_name, count(*) AS used FROM p{i} GROUP BY 1, 2),
        f{i} AS MATERIALIZED (SELECT u.edition_id, u.place, u.source_name FROM u LEFT JOIN c{i} c ON c.edition_id = u.edition_id AND c.source_name = u.source_name
          WHERE u.category = '{category}' AND coalesce(used, 0) < {per_publisher}
            AND NOT EXISTS (SELECT 1 FROM p{i} p WHERE p.edition_id = u.edition_id AND p.place = u.place)
          QUALIFY row_number() OVER (PARTITION BY u.edition_id, u.source_name ORDER BY u.place) = 1),
        g{i} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY place) AS k FROM f{i}),
        p{i + 1} AS MATERIALIZED (SELECT * FROM p{i} UNION ALL SELECT g.edition_id, g.place, g.source_name, {i + 1}
          FROM g{i} g JOIN n{i} n ON n.edition_id = g.edition_id WHERE g.k <= least(4, {total} - n.taken))"""
        )
    last = len(CATEGORIES)
    steps.append(
        f"""nl AS MATERIALIZED (SELECT edition_id, count(*) AS taken FROM p{last} GROUP BY 1),
        cl AS MATERIALIZED (SELECT edition_id, source_name, count(*) AS used FROM p{last} GROUP BY 1, 2),
        rl AS MATERIALIZED (SELECT u.edition_id, u.place, u.source_name, row_number() OVER (PARTITION BY u.edition_id, u.source_name ORDER BY u.place) AS r
          FROM u WHERE NOT EXISTS (SELECT 1 FROM p{last} p WHERE p.edition_id = u.edition_id AND p.place = u.place)),
        fl AS MATERIALIZED (SELECT r.edition_id, r.place, r.source_name, row_number() OVER (PARTITION BY r.edition_id ORDER BY r.place) AS k
          FROM rl r JOIN cl c ON c.edition_id = r.edition_id AND c.source_name = r.source_name WHERE r.r <= {per_publisher} - c.used),
        taken AS (SELECT * FROM p{last} UNION ALL SELECT f.edition_id, f.place, f.source_name, {last + 1}
          FROM fl f JOIN nl n ON n.edition_id = f.edition_id WHERE f.k <= {total} - n.taken)"""
    )
    return ",\n".join(steps)


ORACLES["candidate_limiter"] = f"""
WITH {USABLE}, {limiter()}
SELECT t.edition_id, u.id, CAST(row_number() OVER (PARTITION BY t.edition_id ORDER BY t.pass, t.place) - 1 AS INT) AS pos
FROM taken t JOIN u ON u.edition_id = t.edition_id AND u.place = t.place"""

FRESH = "len(list_filter(publishers, lambda x: NOT list_contains(load, x)))"
FULL = f"len(list_filter(publishers, lambda x: len(list_filter(load, lambda y: y = x)) >= {MAX_PER_PUBLISHER_OUT}))"
ORACLES["draft_mix"] = f"""
WITH RECURSIVE {USABLE}, {limiter()},
placed AS MATERIALIZED (SELECT u.*, CAST(row_number() OVER (PARTITION BY t.edition_id ORDER BY t.pass, t.place) - 1 AS INT) AS pos
  FROM taken t JOIN u ON u.edition_id = t.edition_id AND u.place = t.place),
paired AS MATERIALIZED (SELECT *, lead(id) OVER o AS next_id, lead(source_name) OVER o AS next_source FROM placed WINDOW o AS (PARTITION BY edition_id ORDER BY pos)),
drafts AS MATERIALIZED (SELECT edition_id, pos, id, category, 1 + ord % 4 AS importance, priority, published_at, ord % 3 = 0 AS preferred,
    CASE WHEN next_id IS NULL THEN [id] ELSE [id, next_id] END AS ids,
    CASE WHEN next_source IS NULL OR next_source = source_name THEN [source_name] ELSE [source_name, next_source] END AS publishers FROM paired),
goals AS MATERIALIZED (SELECT edition_id, least({MIN_PUBLISHERS}, {MAX_ARTICLES}, count(DISTINCT publisher)) AS goal
  FROM (SELECT edition_id, unnest(publishers) AS publisher FROM drafts) GROUP BY 1),
chosen(edition_id, pick, place, load, spent, categories) AS (
  SELECT edition_id, 0, CAST(NULL AS INT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]) FROM goals
  UNION ALL
  (SELECT c.edition_id, c.pick + 1, d.pos, list_concat(c.load, d.publishers), list_concat(c.spent, d.ids), list_append(c.categories, d.category)
   FROM chosen c JOIN goals g ON g.edition_id = c.edition_id JOIN drafts d ON d.edition_id = c.edition_id
   WHERE c.pick < {MAX_ARTICLES} AND len(list_intersect(c.spent, d.ids)) = 0 AND {FULL} = 0
   QUALIFY row_number() OVER (PARTITION BY c.edition_id ORDER BY ({FRESH} > 0 AND len(list_distinct(load)) < goal) DESC, {FRESH} DESC,
     NOT list_contains(categories, category) DESC, preferred DESC, importance DESC, priority DESC, published_at DESC, d.pos) = 1))
SELECT c.edition_id, c.place, CAST(c.pick AS INT) AS pick, d.id, d.category, array_to_string(d.publishers, ' ') AS publishers
FROM chosen c JOIN drafts d ON d.edition_id = c.edition_id AND d.pos = c.place"""

# ---- articles of six documents ---------------------------------------------------------------------------

ISO = "strftime({} + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S+09:00')"
CITED = f"""{CAND}, cited AS (
  SELECT *, ord // 6 AS position, ord % 6 AS n, ord % 4 = 3 AS context_only, source_name AS publisher,
    {edition("(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((ord // 6) * 1800))")} AS edition_id,
    CASE WHEN ord % 4 = 3 THEN {edition('published_at')} ELSE '' END AS origin FROM cand)"""
ART = f"""{CITED}, grouped AS (
  SELECT position, edition_id, min(published_at) AS published_at, max(published_at) AS updated_at, list_sort(list(DISTINCT url)) AS urls,
    count(*) FILTER (NOT context_only) AS fresh, count(*) FILTER (context_only) AS continued,
    list_sort(list(DISTINCT origin) FILTER (origin <> '')) AS origins, list_sort(list(DISTINCT publisher)) AS publishers, bool_or(primary_source) AS has_primary,
    max(title) FILTER (n = 0) AS title, max(category) FILTER (n = 0) AS category, max(priority) FILTER (n = 0) AS importance, max(description) FILTER (n = 0) AS description
  FROM cited GROUP BY 1, 2),
art AS (SELECT *, substr(sha256(array_to_string(urls, '|')), 1, 16) AS id, len(publishers) AS publisher_count, len(urls) AS source_count,
    edition_id || '-' || substr(sha256(array_to_string(urls, '|')), 1, 8) AS slug,
    CASE WHEN position % 3 = 0 THEN 'feature' ELSE 'brief' END AS article_type,
    CASE WHEN position % 2 = 0 THEN '1月1日 10:50更新。' || title ELSE title END AS dek FROM grouped),
src AS (SELECT edition_id, position, publisher, min(published_at) AS first_at, bool_or(primary_source) AS is_primary, count(*) AS links,
    arg_min(url, published_at) AS first_url FROM cited GROUP BY 1, 2, 3)"""


def clip(c: str, limit: int) -> str:
    start = f"rtrim(substr({c}, 1, {limit - 1}))"
    bounded = f"regexp_extract({start}, '^(.*[。！？!?｜|：:])', 1)"
    cut = f"CASE WHEN length({bounded}) - 1 >= {max(12, limit // 2)} THEN rtrim({bounded}, '｜|：: ') ELSE {start} END"
    return f"CASE WHEN length({c}) <= {limit} THEN {c} ELSE rtrim({cut}, '、,・/／｜|：:-') || '…' END"


ORACLES["evidence_by_publisher"] = f"""
WITH {CITED}, c AS (SELECT *, {clip(squash('title'), 180)} AS label FROM cited),
k AS (SELECT *, replace(lower(label), 'ß', 'ss') AS key FROM c),
d AS (SELECT *, row_number() OVER (PARTITION BY position, publisher, key ORDER BY published_at) AS dup FROM k),
m AS (SELECT *, row_number() OVER (PARTITION BY position, publisher, dup = 1 AND key <> '' ORDER BY published_at) AS nth FROM d)
SELECT edition_id, position, min(published_at) AS first_at, publisher AS name,
  {ISO.format('max_by(published_at, struct_pack(a := primary_source, b := priority, c := length(description) > 0, d := published_at))')} AS published,
  CAST(count(*) AS INT) AS links, string_agg(url, ' ' ORDER BY published_at) AS urls,
  coalesce(string_agg(label, ' | ' ORDER BY published_at) FILTER (dup = 1 AND key <> '' AND nth <= 4), '') AS key_points,
  CASE WHEN bool_or(primary_source) THEN '一次情報' ELSE '報道' END AS type, bool_or(primary_source) AS is_primary
FROM m GROUP BY edition_id, position, publisher"""

ORACLES["article_measures"] = f"""
WITH {ART} SELECT edition_id, position, id, published_at, CAST(source_count AS INT) AS source_count, CAST(fresh AS INT) AS fresh_source_count,
  CAST(continued AS INT) AS continuation_source_count, coalesce(array_to_string(origins, ' '), '') AS origins, array_to_string(publishers, ' ') AS publishers, has_primary FROM art"""

ORACLES["importance_score"] = f"""
WITH {CITED}, g AS (SELECT edition_id, position, min(published_at) AS published_at, min(ord) AS first, count(DISTINCT publisher) AS pubs, bool_or(primary_source) AS prim,
  least(greatest(round_even(avg(priority), 0) + CASE WHEN count(DISTINCT publisher) >= 2 THEN 1 ELSE 0 END
    + CASE WHEN bool_or(regexp_matches(title, '{word("are|pas|ein|las")}')) THEN 1 ELSE 0 END, 1), 5) AS raw FROM cited GROUP BY 1, 2),
c AS (SELECT *, CASE WHEN raw >= 4 AND pubs < 2 AND NOT prim THEN 3 ELSE raw END AS imp FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY imp DESC, published_at DESC, position) AS k, max(imp) OVER (PARTITION BY edition_id) AS top FROM c),
f AS (SELECT *, min(CASE WHEN pubs >= 2 THEN k END) OVER (PARTITION BY edition_id) AS lead FROM o),
l AS (SELECT *, CASE WHEN top < 4 AND k = lead THEN 4 ELSE imp END AS final FROM f)
SELECT edition_id, first, CAST(final AS INT) AS importance, CAST(row_number() OVER (PARTITION BY edition_id ORDER BY final DESC, published_at DESC, k) - 1 AS INT) AS position FROM l"""


def json_counts(source: str, value: str, out: str, where: str = "") -> str:
    return f"""(SELECT edition_id, '{{' || string_agg('"' || v || '":' || n, ',' ORDER BY v) || '}}' AS {out}
    FROM (SELECT edition_id, {value} AS v, count(*) AS n FROM {source} {where} GROUP BY 1, 2) GROUP BY 1)"""


ORACLES["edition_stats"] = f"""
WITH {ART}, e AS (SELECT edition_id, count(*) AS article_count, count(*) FILTER (importance >= 4) AS important_count FROM art GROUP BY 1),
s AS (SELECT edition_id, count(DISTINCT url) AS source_count, count(DISTINCT publisher) AS publisher_count FROM cited GROUP BY 1),
j AS (SELECT * FROM e JOIN s USING (edition_id) JOIN {json_counts('art', 'category', 'categories')} c USING (edition_id)
  JOIN {json_counts('src', 'publisher', 'publishers')} p USING (edition_id) JOIN {json_counts('art', 'article_type', 'types')} t USING (edition_id))
SELECT *, CASE WHEN important_count > 0 THEN '対象時間帯の' || publisher_count || '配信元のニュースを' || article_count || '本に整理しました。うち重要ニュースは' || important_count || '本です。'
    ELSE '対象時間帯の' || publisher_count || '配信元の主なニュースを' || article_count || '本に整理しました。' END AS summary,
  CASE WHEN important_count > 0 THEN article_count || '件を掲載。特に注目度の高いニュースは' || important_count || '件です。'
    ELSE 'この時間帯の主なニュースを' || article_count || '件に整理しました。' END AS opening FROM j"""

CATEGORY_RANK = "CASE a.category " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CATEGORIES)) + " END"
ORACLES["digest_listing"] = f"""
WITH {ART}, s AS (SELECT *, CAST(row_number() OVER (PARTITION BY position ORDER BY first_at) - 1 AS INT) AS source_no FROM src)
SELECT a.edition_id, CAST({CATEGORY_RANK} AS INT) AS category_rank, a.category, a.position, s.source_no,
  CAST(row_number() OVER (PARTITION BY c.position, c.publisher ORDER BY c.published_at) - 1 AS INT) AS link_no,
  CASE WHEN s.links > 1 AND c.title <> '' THEN c.publisher || '：' || c.title ELSE c.publisher END AS label, c.url, {ISO.format('c.published_at')} AS published
FROM art a JOIN cited c ON c.position = a.position JOIN s ON s.position = c.position AND s.publisher = c.publisher"""


def index_rows(articles: str) -> str:
    return f"""(SELECT h.*, n, categories, CAST(row_number() OVER (ORDER BY h.edition_id DESC) - 1 AS INT) AS place
    FROM (SELECT edition_id, published_at, title AS headline FROM {articles} QUALIFY row_number() OVER (PARTITION BY edition_id ORDER BY position) = 1) h
    JOIN (SELECT edition_id, count(*) AS n FROM {articles} GROUP BY 1) c USING (edition_id) JOIN {json_counts(articles, 'category', 'categories')} k USING (edition_id))"""


def labels(end: str) -> str:
    start = f"({end} - CASE WHEN hour({end}) = 6 THEN INTERVAL 12 HOUR ELSE INTERVAL 6 HOUR END)"
    return f"""CASE hour({end}) WHEN 6 THEN '朝6時版' WHEN 12 THEN '昼12時版' ELSE '夕方6時版' END AS label,
    strftime({start}, '%m月%d日 %H:%M') || '〜' || strftime({end}, '%m月%d日 %H:%M') AS coverage_label"""


ORACLES["archive_upsert"] = f"""
WITH {ART}, big AS (SELECT * FROM art WHERE importance >= 3), old AS (SELECT *, 1 AS age FROM {index_rows('big')}),
new AS (SELECT *, 0 AS age FROM {index_rows('art')} WHERE place % 2 = 0),
one AS (SELECT * FROM (SELECT * FROM old UNION ALL SELECT * FROM new) QUALIFY row_number() OVER (PARTITION BY edition_id ORDER BY age, place) = 1),
e AS (SELECT *, {slot_end('published_at')} AS e FROM one)
SELECT edition_id, CAST(row_number() OVER (ORDER BY age, place) - 1 AS INT) AS place, {labels('e')}, headline, n AS article_count, categories FROM e
QUALIFY row_number() OVER (ORDER BY age, place) <= 540"""

ORACLES["feed_items"] = f"""
WITH {ART}, i AS (SELECT edition_id, place FROM {index_rows('art')} WHERE place < 20),
r AS (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY position) AS k FROM art)
SELECT place, position, title, 'https://digest.example.org/?article=' || slug AS link, id AS guid, description,
  strftime(published_at + INTERVAL 9 HOUR, '%a, %d %b %Y %H:%M:%S +0900') AS pub_date FROM r JOIN i USING (edition_id) WHERE k <= 5"""

ORACLES["source_mix_violations"] = f"""
WITH {ART}, e AS (SELECT DISTINCT edition_id FROM art), s AS (SELECT edition_id, count(DISTINCT publisher) AS p, bool_or(is_primary) AS prim FROM src
  WHERE publisher = 'src3' GROUP BY 1), j AS (SELECT edition_id, coalesce(p, 0) AS p, prim FROM e LEFT JOIN s USING (edition_id))
SELECT edition_id, CASE WHEN p = 0 THEN 'no sourced articles' ELSE 'single secondary publisher' END AS violation FROM j WHERE p = 0 OR (p = 1 AND NOT prim)"""

COMPACT = r"[\s\p{Z}]+"
ORACLES["feature_rule_violations"] = rf"""
WITH {ART}, f AS (SELECT *, {sentence_list(squash('description'))} AS facts, CASE WHEN has_primary THEN 1 ELSE 2 END AS least_sources, {squash('title')} AS t FROM art WHERE article_type = 'feature'),
v AS (SELECT edition_id, position, list_filter([
  CASE WHEN source_count < least_sources THEN 'sources' END, CASE WHEN fresh < 1 THEN 'fresh' END,
  CASE WHEN NOT has_primary AND publisher_count < 2 THEN 'publishers' END, CASE WHEN len(facts) < 3 THEN 'points' END,
  CASE WHEN length(regexp_replace(array_to_string(facts, ' '), '{COMPACT}', '', 'g')) < 180 THEN 'material' END,
  CASE WHEN length(regexp_replace(description, '{COMPACT}', '', 'g')) < 80 THEN 'summary' END,
  CASE WHEN NOT regexp_matches(dek, '\d月\d日 \d\d:\d\d') THEN 'time scope' END, CASE WHEN len(urls) < least_sources THEN 'links' END,
  CASE WHEN length(t) < 8 OR length(t) > 120 OR regexp_matches(t, '(\.\.\.|[/／｜|：:、,（(【「『\-])$') OR regexp_matches(t, '{CUT}') THEN 'title' END,
  CASE WHEN regexp_matches(title, '{CUT}') OR regexp_matches(description, '{CUT}') OR len(list_filter(facts, lambda x: regexp_matches(x, '{CUT}'))) > 0 THEN 'copy' END],
  lambda x: x IS NOT NULL) AS v FROM f)
SELECT edition_id, position, array_to_string(v, ', ') AS violations FROM v"""

ORACLES["shared_feature_events"] = f"""
WITH {ART} SELECT edition_id, 'event ' || position % 4 AS key FROM art WHERE article_type = 'feature' GROUP BY 1, 2 HAVING count(*) > 1"""

ORACLES["draft_ownership"] = f"""
WITH {EDITIONED}, p AS (SELECT edition_id, ord AS draft_no, unnest([0, 1, 2]) AS n, unnest(['d' || ord, 'd' || ord + 1, 'd' || ord * 2]) AS id FROM ed),
k AS (SELECT p.* FROM p JOIN ed ON ed.edition_id = p.edition_id AND ed.id = p.id)
SELECT edition_id, draft_no, n, id FROM k QUALIFY row_number() OVER (PARTITION BY edition_id, id ORDER BY draft_no, n) = 1"""

ORACLES["distinct_edition_articles"] = rf"""
WITH {ART}, listed AS (SELECT edition_id, title, CASE WHEN position % 3 <> 0 THEN id END AS id, 2 * position AS position FROM art),
both_lists AS (FROM listed UNION ALL SELECT edition_id, title, id, position + 1 FROM listed WHERE position % 4 = 0)
SELECT edition_id, position, id, title FROM both_lists
QUALIFY row_number() OVER (PARTITION BY edition_id, coalesce(id, lower(regexp_replace(title, '[\s\p{{Z}}]+', '', 'g'))) ORDER BY position) = 1"""

# ---- read side -------------------------------------------------------------------------------------------

BEST = "importance DESC, updated_at DESC, id"
COMPARED = r"regexp_replace(lower(title || ' ' || dek || ' ' || description), '[^0-9a-z\x{3040}-\x{30ff}\x{3400}-\x{9fff}]+', '', 'g')"

ORACLES["article_search"] = f"""
WITH {ART}, f AS (SELECT * FROM art WHERE contains({COMPARED}, 'en') AND contains({COMPARED}, 'le'))
SELECT edition_id, id, importance, CAST(row_number() OVER (PARTITION BY edition_id ORDER BY {BEST}) AS INT) AS rank FROM f"""

ORACLES["article_lookup"] = f"WITH {ART} SELECT edition_id, id, slug, title FROM art WHERE slug = (SELECT max(slug) FROM art)"

ORACLES["bulletin_list"] = f"""
WITH {ART}, lead AS (SELECT id FROM art WHERE article_type = 'feature' QUALIFY row_number() OVER (PARTITION BY edition_id ORDER BY {BEST}) = 1)
SELECT edition_id, CAST(row_number() OVER (PARTITION BY edition_id ORDER BY updated_at DESC, id) AS INT) AS rank, id, updated_at FROM art
WHERE id NOT IN (SELECT id FROM lead) QUALIFY row_number() OVER (PARTITION BY edition_id ORDER BY updated_at DESC, id) <= 8"""

ORACLES["desk_order"] = f"""
WITH {ART}, r AS (SELECT *, row_number() OVER (PARTITION BY edition_id, category ORDER BY article_type = 'feature' DESC, {BEST}) AS k FROM art)
SELECT edition_id, category, CAST(k AS INT) AS rank, id FROM r WHERE k <= 6"""

ORACLES["related_articles"] = f"""
WITH {ART}, p AS (SELECT a.edition_id, a.id, f.id AS related_id, row_number() OVER (PARTITION BY a.edition_id, a.id
    ORDER BY (f.category = a.category) DESC, f.importance DESC, f.updated_at DESC, f.id) AS k
  FROM art a JOIN art f ON f.edition_id = a.edition_id AND f.id <> a.id AND f.article_type = 'feature')
SELECT edition_id, id, CAST(k AS INT) AS rank, related_id FROM p WHERE k <= 3"""


def recent(source: str, visible: int) -> str:
    """Shared steps of the look back at earlier editions."""
    return f"""ft AS (SELECT *, lower(regexp_replace(title, '{COMPACT}', '', 'g')) AS title_key FROM {source} WHERE article_type = 'feature'),
times AS (SELECT DISTINCT edition_id, {slot_end('published_at')} AS made FROM art),
own AS (SELECT edition_id, count(*) AS n FROM ft GROUP BY 1),
needy AS (SELECT t.edition_id, t.made, coalesce(n, 0) AS n FROM times t LEFT JOIN own USING (edition_id) WHERE coalesce(n, 0) < {visible}),
near AS (SELECT d.edition_id, d.n, t.edition_id AS from_edition, t.made FROM needy d JOIN times t ON t.made < d.made AND d.made - t.made <= INTERVAL 48 HOUR
  QUALIFY row_number() OVER (PARTITION BY d.edition_id ORDER BY t.made DESC) <= 8),
offer AS (SELECT r.edition_id, r.n, r.from_edition, r.made, f.id, f.title, f.title_key, f.importance, f.updated_at FROM near r JOIN ft f ON f.edition_id = r.from_edition
  WHERE NOT EXISTS (SELECT 1 FROM ft o WHERE o.edition_id = r.edition_id AND o.title_key = f.title_key)
  QUALIFY row_number() OVER (PARTITION BY r.edition_id, f.title_key ORDER BY r.made DESC, f.importance DESC, f.updated_at DESC, f.id) = 1),
recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY made DESC, importance DESC, updated_at DESC, id) AS k FROM offer) WHERE k <= {visible} - n)"""


ORACLES["recent_features"] = f"""
WITH {ART}, few AS (SELECT * FROM art WHERE article_type = 'brief' OR position % 2 = 0), {recent('few', 9)}
SELECT edition_id, CAST(k AS INT) AS rank, from_edition, id FROM recent"""

ORACLES["front_page"] = f"""
WITH {ART}, {recent('art', 3)}, shelves AS (
  SELECT edition_id, edition_id AS from_edition, id, title, importance, updated_at, CASE WHEN article_type = 'feature' THEN 0 ELSE 2 END AS shelf, 0 AS k FROM art
  UNION ALL SELECT edition_id, from_edition, id, title, importance, updated_at, 1, k FROM recent),
u AS (SELECT * FROM shelves QUALIFY row_number() OVER (PARTITION BY edition_id, lower(regexp_replace(title, '{COMPACT}', '', 'g')) ORDER BY shelf, k, {BEST}) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY shelf, k, {BEST}) - 1 AS rank FROM u)
SELECT edition_id, CAST(rank AS INT) AS rank, from_edition, id FROM r WHERE rank <= 3"""

ORACLES["publisher_network"] = f"""
WITH {ART}, g AS (SELECT edition_id, publisher, arg_min(first_url, position) AS url, count(*) AS articles, count(*) FILTER (is_primary) AS primary_articles FROM src GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY edition_id ORDER BY primary_articles DESC, articles DESC, publisher) AS rank FROM g)
SELECT edition_id, CAST(rank AS INT) AS rank, publisher, publisher AS name, url, articles, primary_articles FROM r WHERE rank <= 10"""

ORACLES["distinct_originals"] = f"WITH {CITED} SELECT edition_id, url, bool_or(context_only) AS is_continuation FROM cited GROUP BY 1, 2"

ORACLES["edition_overview"] = f"""
WITH {ART}, a AS (SELECT edition_id, count(*) AS articles, count(*) FILTER (article_type = 'feature') AS features, count(*) FILTER (article_type = 'brief') AS briefs,
  count(DISTINCT category) AS categories FROM art GROUP BY 1),
c AS (SELECT edition_id, count(DISTINCT publisher) AS publishers, count(DISTINCT url) AS originals, count(DISTINCT url) FILTER (context_only) AS continued FROM cited GROUP BY 1)
SELECT * FROM a JOIN c USING (edition_id)"""

ORACLES["archive_list"] = f"""
WITH {ART}, t AS (SELECT DISTINCT edition_id, {slot_end('published_at')} AS generated_at FROM art) SELECT * FROM t ORDER BY generated_at DESC LIMIT 12"""

SAYS = "regexp_matches({}, '[^。！？!?\\s]')"
ORACLES["stored_article_forms"] = f"""
WITH {CAND}
SELECT ord, id, CASE WHEN title = '' THEN '無題の記事' ELSE title END AS title, CASE ord % 3 WHEN 2 THEN 'other' ELSE 'economy' END AS category,
  CAST(CASE ord % 3 WHEN 0 THEN priority WHEN 1 THEN least(priority + 3, 5) ELSE 3 END AS INT) AS importance,
  CASE ord % 3 WHEN 0 THEN 'feature' ELSE 'brief' END AS article_type, CAST(CASE ord % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INT) AS source_count,
  CAST(CASE ord % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 0 END AS INT) AS publisher_count, CAST(CASE ord % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INT) AS fresh_source_count,
  CAST(CASE WHEN ord % 3 = 2 THEN CASE WHEN {SAYS.format('title')} THEN 1 ELSE 0 END ELSE CASE WHEN {SAYS.format('description')} THEN 1 ELSE 0 END END AS INT) AS facts,
  CASE ord % 3 WHEN 0 THEN url WHEN 1 THEN url || ' ftp://nowhere/ ' || url ELSE '' END AS urls FROM cand"""

ORACLES["material_updates"] = """
SELECT conv_id, turn, CASE WHEN conv_id % 2 = 1 AND text = '' THEN false WHEN conv_id % 5 = 0 THEN turn = 1 WHEN turn % 3 = 0 THEN false
  WHEN turn % 3 = 1 THEN true ELSE conv_id % 2 = 1 END AS material FROM conversations"""

ORACLES["linked_bulletins"] = f"""
WITH {BULLETINS}, s AS (SELECT *, CASE max_intensity WHEN '5-' THEN '5弱' WHEN '5+' THEN '5強' WHEN '6-' THEN '6弱' ELSE max_intensity END AS shown,
  'region ' || ord % 47 AS place, strftime(published_at + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S+09:00') AS origin FROM b
  WHERE max_intensity IN ('3', '4', '5-', '5+', '6-') OR product_title IN ('signup', 'error')),
d AS (SELECT *, place || 'で地震 最大震度' || shown AS title,
  '発生時刻: ' || origin || '。 震央・震源地域: ' || place || '。 最大震度: ' || shown || '。 報 ' || ord || '。 警報: ' || place || '。' AS description FROM s)
SELECT event_id, ord, title, CAST(length(description) + 100 AS INT) AS richness, published_at FROM d
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY published_at DESC, CAST(serial AS INT) DESC, ord) = 1"""

ORACLES["archive_context"] = f"""
WITH {ART} SELECT a.edition_id AS origin_edition_id, c.url, rtrim(substr({squash('c.title')}, 1, 180)) AS title, 'point ' || c.publisher AS description, c.published_at, CAST(a.importance AS INT) AS priority,
  s.is_primary AS primary_source, a.category, 'context-' || substr(sha256(a.edition_id || '|' || c.url), 1, 20) AS id
FROM art a JOIN cited c ON c.position = a.position JOIN src s ON s.position = c.position AND s.publisher = c.publisher
WHERE a.position % 4 < 3 AND c.title <> ''"""

ORACLES["stream_slot_counts"] = f"SELECT {edition('ts')} AS edition_id, event_type, count(*) AS n FROM events GROUP BY 1, 2"
ORACLES["stream_url_dedup"] = f"WITH {ITEMS} SELECT DISTINCT url FROM items"

ORACLES["stream_unseen_urls"] = f"""
WITH {ITEMS} SELECT ord, url FROM items QUALIFY row_number() OVER (PARTITION BY url ORDER BY published_at, ord) = 1"""

ORACLES["stream_unseen_titles"] = f"""
WITH RECURSIVE {CAND}, o AS (SELECT ord, {title_norm('title')} AS title_norm, published_at, primary_source FROM cand),
n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY title_norm ORDER BY published_at, ord) AS r FROM o WHERE title_norm <> ''),
s AS (SELECT title_norm, r, ord, published_at, published_at AS last, true AS kept FROM n WHERE r = 1
  UNION ALL
  SELECT n.title_norm, n.r, n.ord, n.published_at,
    CASE WHEN n.primary_source OR n.published_at - s.last > INTERVAL 36 HOUR THEN n.published_at ELSE s.last END,
    n.primary_source OR n.published_at - s.last > INTERVAL 36 HOUR
  FROM s JOIN n ON n.title_norm = s.title_norm AND n.r = s.r + 1)
SELECT ord, title_norm, published_at FROM s WHERE kept"""

ORACLES["stream_closed_slots"] = """
WITH span AS (SELECT epoch(date_trunc('second', min(ts))) AS a, epoch(date_trunc('second', max(ts))) AS b FROM events),
landed AS (SELECT ts, event_type, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01 03:00:00') AS w,
    least(floor((epoch(date_trunc('second', ts)) - a) * 3 / (b - a + 1)) + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END, 2) AS landing FROM events, span),
marks AS (SELECT l.landing, (SELECT max(ts) FROM landed e WHERE e.landing < l.landing) - INTERVAL 90 MINUTE AS mark FROM (SELECT DISTINCT landing FROM landed) l),
judged AS (SELECT w, event_type, coalesce(w + INTERVAL 6 HOUR <= mark, false) AS late FROM landed JOIN marks USING (landing))
SELECT CASE WHEN late THEN 'late' ELSE 'closed' END AS kind, w AS window_start, event_type, count(*) AS n FROM judged
WHERE late OR w + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 90 MINUTE FROM events) GROUP BY ALL"""

STORED = f"""{EDITIONED}, ids AS (SELECT DISTINCT edition_id FROM ed ORDER BY edition_id DESC LIMIT 12),
doc AS (SELECT *, CASE WHEN ord % 50 = 7 OR ord % 51 = 11 THEN 1 ELSE 0 END AS broken FROM ed)"""

ORACLES["stored_documents"] = f"""
WITH {STORED}
SELECT edition_id, id, CASE WHEN title = '' THEN '無題の記事' ELSE title END AS title, CASE ord % 3 WHEN 2 THEN 'other' ELSE 'economy' END AS category,
  CAST(CASE ord % 3 WHEN 0 THEN priority WHEN 1 THEN least(priority + 3, 5) ELSE 3 END AS INT) AS importance,
  CASE ord % 3 WHEN 0 THEN 'feature' ELSE 'brief' END AS article_type FROM doc JOIN ids USING (edition_id) WHERE broken = 0"""

ORACLES["stored_document_counts"] = f"""
WITH {STORED}, idx AS (SELECT DISTINCT edition_id FROM ed ORDER BY edition_id DESC LIMIT 15),
c AS (SELECT edition_id, count(*) FILTER (broken = 0) AS documents, sum(broken) AS broken FROM doc JOIN ids USING (edition_id) GROUP BY 1)
SELECT edition_id, coalesce(documents, 0) AS articles, coalesce(documents, 0) AS documents, CAST(coalesce(broken, 0) AS BIGINT) AS broken FROM idx LEFT JOIN c USING (edition_id)"""

ORACLES["observed_run"] = f"""
WITH {PAYLOADS}, o AS (SELECT u.source, coalesce(bool_or(j.ord IS NOT NULL AND reason IS NULL), false) AS ok FROM usable u LEFT JOIN judged j ON j.source_name = u.source GROUP BY 1)
SELECT (SELECT count(*) FROM o) AS feeds, (SELECT count(*) FROM o WHERE NOT ok) AS failed_feeds, (SELECT count(*) FROM judged WHERE reason IS NULL) AS candidates,
  (SELECT count(DISTINCT ord // 6) FROM cand) AS published,
  (SELECT max({edition("(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((ord // 6) * 1800))")}) FROM cand) AS last_edition"""

SEARCH_TERMS = (("en", "le"), ("sch", "ein"), ("tion", "and", "the"), ("ouèon",), ("e",), ("wherever", "zzqx"), ("an", "anan"))
ORACLES["indexed_search"] = f"WITH {ART} " + " UNION ALL ".join(
    f"SELECT {n} AS search, edition_id, id FROM art WHERE " + " AND ".join(f"contains({COMPARED}, regexp_replace('{t}', '[^0-9a-z]+', '', 'g'))" for t in terms)
    for n, terms in enumerate(SEARCH_TERMS)
)
