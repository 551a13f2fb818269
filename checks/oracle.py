"""DuckDB SQL for the registered queries, written from the rules and not from the Spark plans."""

from __future__ import annotations

from . import inputs

SPACE = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"
WORD = r"'[\p{L}\p{N}]+'"


def _text(value: str) -> str:
    """A Python text as a SQL expression."""
    quoted = value.replace("'", "''")
    return "'" + quoted.replace("\r", "'||chr(13)||'").replace("\n", "'||chr(10)||'") + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {SPACE})"


def _unescape(x: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"),
                       ("&copy;", "©"), ("&nbsp;", "\xa0"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


BLOCK = "(?:h[1-6]|p|li|blockquote|pre)"
TAG = r"'</?[a-zA-Z][^>]*>|<[!?][^>]*>'"
HIDDEN = r"'(?is)<!--.*?(?:-->|\z)|<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)|<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)'"
NOISE = "'(?is)" + "|".join(
    rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>"
    for t in ("noscript", "header", "footer", "nav", "aside", "form", "svg", "iframe", "button")
) + "'"


def _inline(x: str) -> str:
    runs = f"string_split(regexp_replace({x}, {TAG}, chr(1), 'g'), chr(1))"
    return f"array_to_string(list_filter(list_transform({runs}, lambda t: {_strip(_unescape('t'))}), lambda t: t <> ''), ' ')"


def _root(tag: str) -> str:
    return rf"nullif(regexp_extract(bare, '(?is)<{tag}(?:\s[^>]*)?>.*?(?:</{tag}\s*>|\z)', 0), '')"


PIECE = rf"regexp_replace(p, '(?is)</{BLOCK}\s*>.*', '')"
EXTRACT = rf"""
clean AS (SELECT page_id, url, html, regexp_replace(html, {HIDDEN}, '', 'g') AS clean FROM pages),
titled AS (SELECT page_id, url, html,
  {_strip(_unescape("regexp_extract(clean, '(?is)<title[^>]*>(.*?)</title>', 1)"))} AS title,
  regexp_replace(clean, {NOISE}, '', 'g') AS bare FROM clean),
rooted AS (SELECT *, coalesce({_root('article')}, {_root('main')}, {_root('body')}, bare) AS root FROM titled),
blocks AS (SELECT *, array_to_string(list_filter(list_transform(
  list_slice(string_split_regex(root, '(?i)<{BLOCK}(?:\s[^>]*)?/?>'), 2, 1000000000),
  lambda p: {_inline(PIECE)}), lambda b: b <> ''), chr(10)) AS text FROM rooted)"""

TRUNCATED = f"CASE WHEN length(text) > 8000 THEN rtrim(left(text, 8000), {SPACE}) || '…' ELSE text END"

ROBOTS = f"""
hosts AS (SELECT DISTINCT regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
  regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS authority FROM pages),
robots AS (SELECT scheme, authority, CASE WHEN authority LIKE 'www.%.org' THEN 404 ELSE 200 END AS status,
  CASE WHEN authority LIKE '%.com' THEN {_text(inputs.ROBOTS_COM)}
       WHEN authority LIKE '%.net' THEN {_text(inputs.ROBOTS_NET)}
       ELSE {_text(inputs.ROBOTS_ORG)} END AS body FROM hosts),
lines AS (SELECT scheme, authority, unnest(string_split_regex(body, '\\r\\n|\\n|\\r')) AS line,
  generate_subscripts(string_split_regex(body, '\\r\\n|\\n|\\r'), 1) AS n FROM robots WHERE status = 200),
parts AS (SELECT *, trim(string_split(line, '#')[1]) AS content FROM lines),
keyed AS (SELECT *, lower(trim(string_split(content, ':')[1])) AS word,
  trim(regexp_extract(content, '^[^:]*:(.*)$', 1)) AS value FROM parts),
classed AS (SELECT *, CASE WHEN line = '' THEN 'blank' WHEN NOT contains(content, ':') THEN NULL
  WHEN word = 'user-agent' THEN 'ua'
  WHEN word IN ('allow', 'disallow', 'crawl-delay', 'request-rate') THEN 'rule' END AS class FROM keyed),
stepped AS (SELECT *, CASE WHEN class = 'blank' OR (class = 'ua' AND
  coalesce(lag(class) OVER w, 'blank') <> 'ua') THEN 1 ELSE 0 END AS step
  FROM classed WHERE class IS NOT NULL WINDOW w AS (PARTITION BY scheme, authority ORDER BY n)),
grouped AS (SELECT *, sum(step) OVER (PARTITION BY scheme, authority ORDER BY n) AS g FROM stepped),
groups AS (SELECT scheme, authority, g,
  bool_or(class = 'ua' AND value = '*') AS everyone,
  bool_or(class = 'ua' AND contains('webglean', lower(value))) AS named FROM grouped
  GROUP BY ALL HAVING bool_or(class = 'ua') AND bool_or(class = 'rule')),
chosen AS (SELECT scheme, authority, g FROM groups WHERE everyone OR named
  QUALIFY row_number() OVER (PARTITION BY scheme, authority ORDER BY everyone, g) = 1),
rules AS (SELECT scheme, authority,
  CAST(row_number() OVER (PARTITION BY scheme, authority ORDER BY n) - 1 AS INTEGER) AS rule_no,
  (word = 'allow' OR value = '') AS allow, value AS path
  FROM grouped JOIN chosen USING (scheme, authority, g) WHERE word IN ('allow', 'disallow')),
split AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
  regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS authority,
  regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) AS target FROM pages),
verdicts AS (SELECT page_id, url, coalesce(arg_min(allow, rule_no), true) AS allowed
  FROM split LEFT JOIN rules ON rules.scheme = split.scheme AND rules.authority = split.authority
  AND starts_with(split.target, rules.path) GROUP BY page_id, url)"""

RESPONSES = """
responses AS (SELECT page_id, url, url || '&seen=1' AS final_url,
  CASE WHEN url LIKE '%spam-farm%' THEN 403 WHEN url LIKE '%?page=%' THEN 500 ELSE 200 END AS status,
  CASE WHEN url LIKE '%.html%' THEN 'text/html; charset=utf-8' WHEN url LIKE '%utm_source%' THEN 'application/PDF'
    WHEN url LIKE '%/es/%' THEN 'application/xhtml+xml' WHEN url LIKE '%#top' THEN 'text/plain' END AS content_type,
  octet_length(encode(html)) AS body_bytes,
  CASE WHEN url LIKE '%cheap-pills%' THEN 'connect timeout' END AS transport_error,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS fetched_at FROM pages),
checked AS (SELECT r.*, allowed, CASE WHEN NOT allowed THEN 'blocked by robots.txt'
  WHEN transport_error IS NOT NULL THEN transport_error
  WHEN status >= 400 THEN 'HTTP ' || status
  WHEN content_type IS NOT NULL AND NOT regexp_matches(lower(content_type), 'text/html|application/xhtml|text/plain')
    THEN 'unsupported content-type: ' || lower(content_type) END AS error
  FROM responses r JOIN verdicts USING (page_id))"""

# A page URL with '!gone' has no snapshot. Its robots verdict is that of the page: no rule's path is
# longer than the page's own target.
ARTICLES = f"""
records AS (
  SELECT c.url, CASE WHEN allowed AND transport_error IS NULL THEN final_url END AS "finalUrl",
    CASE WHEN allowed AND transport_error IS NULL THEN status END AS status,
    CASE WHEN error IS NULL THEN title END AS title,
    CASE WHEN error IS NULL THEN {TRUNCATED} ELSE '' END AS text,
    CAST(CASE WHEN error IS NULL THEN length({TRUNCATED}) ELSE 0 END AS INTEGER) AS chars,
    CASE WHEN allowed AND transport_error IS NULL THEN fetched_at END AS "fetchedAt", error
  FROM checked c JOIN blocks b USING (page_id)
  UNION ALL
  SELECT url || '!gone', CASE WHEN allowed THEN url || '!gone' END, CASE WHEN allowed THEN 404 END, NULL, '', 0, NULL,
    CASE WHEN allowed THEN 'HTTP 404' ELSE 'blocked by robots.txt' END FROM verdicts)"""

PAGE_URLS = """
asked AS (SELECT url, page_id AS position FROM pages
  UNION ALL SELECT ' ' || chr(9) || url || chr(10), page_id + 1000000000 FROM pages
  UNION ALL SELECT url || '!gone', page_id + 2000000000 FROM pages)"""

CORPUS = """corpus AS (SELECT doc_id, text, 'doc://' || md5(text) AS url, 'doc ' || doc_id AS title FROM documents)"""
QUERIES = "asks AS (SELECT item_id AS query_idx, text AS query FROM benchmark WHERE length(text) <= 200)"


def _ranked(k: int, docs: str = "corpus") -> str:
    """CTEs ending in ``ranked(query_idx, doc_id, score, rank)`` from ``asks`` and a corpus."""
    return f"""
words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {WORD})) AS term FROM {docs}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lens AS (SELECT doc_id, len(regexp_extract_all(lower(text), {WORD})) AS n FROM {docs}),
size AS (SELECT CAST(count(*) AS DOUBLE) AS docs, CAST(sum(n) AS DOUBLE) / count(*) AS mean FROM lens),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
terms AS (SELECT DISTINCT query_idx, unnest(regexp_extract_all(lower(query), {WORD})) AS term FROM asks),
scored AS (SELECT query_idx, doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) *
  tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 6) AS score
  FROM terms JOIN tf USING (term) JOIN dfs USING (term) JOIN lens USING (doc_id), size GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_idx ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored QUALIFY rank <= {k})"""


BATCH = f"""{CORPUS}, {QUERIES}, {_ranked(10)},
hits AS (SELECT query_idx, rank, url, title, CAST(NULL AS VARCHAR) AS "publishedDate", text, score
  FROM ranked JOIN corpus USING (doc_id))"""
MERGED = """
merged AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY url ORDER BY query_idx, rank) = 1)"""

# Search over extracted page text; the hit joined with the article of its URL.
RESEARCH = f"""{EXTRACT}, {ROBOTS}, {RESPONSES}, {ARTICLES}, {QUERIES},
page_corpus AS (SELECT page_id AS doc_id, text, url, CASE WHEN url LIKE 'https%' THEN title END AS title FROM blocks),
{_ranked(5, 'page_corpus')},
sources AS (SELECT query_idx AS topic, rank, p.url, coalesce(p.title, CASE WHEN error IS NULL THEN nullif(r.title, '') END) AS title,
  '2024' AS "publishedDate", p.text AS snippet, CASE WHEN error IS NULL THEN r.text END AS text, error AS "fetchError"
  FROM ranked JOIN page_corpus p USING (doc_id) JOIN records r ON r.url = p.url)"""

CHAT = """
chat AS (SELECT conv_id AS query_idx, turn + 1 AS rank,
  CASE WHEN role <> 'assistant' THEN 'https://chat.example/' || conv_id || '/' || turn END AS url,
  CASE WHEN role <> 'user' THEN role END AS title, CASE WHEN turn = 0 THEN '2024-01-01' END AS "publishedDate", text
  FROM conversations)"""


def _query_error(x: str) -> str:
    return (f"CASE WHEN {_strip(x)} = '' THEN 'query is empty' WHEN length({x}) > 200 "
            f"THEN 'query must be <= 200 characters (got ' || length({x}) || ')' END")


_VALUE = "CAST(value AS VARCHAR)"
_K = "(props->>'k')"


def _clamp_text(x: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"THEN CAST(greatest(1, least(25, CAST(trim({x}) AS HUGEINT))) AS INTEGER) ELSE 10 END")


def _parameter(name: str) -> str:
    form = f"nullif(regexp_extract(form, '(?:^|&){name}=([^&]+)', 1), '')"
    query = f"nullif(regexp_extract(qs, '(?:^|&){name}=([^&]+)', 1), '')"
    text = f"url_decode(replace(coalesce({form}, {query}), '+', ' '))"
    json = f"nullif(nullif(CAST(json->'$.{name}' AS VARCHAR), 'null'), '\"\"')"
    return f"CASE WHEN {json} IS NOT NULL THEN nullif({json}, '[]') ELSE CAST(to_json({text}) AS VARCHAR) END"


def _first(names: tuple[str, ...]) -> str:
    return "coalesce(" + ", ".join(_parameter(n) for n in names) + ")"


REQUESTS = f"""
log AS (SELECT event_id AS req_id, event_type AS kind,
  CASE event_type WHEN 'view' THEN 'http://s.example/search?q=view+' || {_K} || '%20x&count=' || {_VALUE}
    WHEN 'click' THEN '/search?search=old&limit=' || {_K} WHEN 'purchase' THEN '/search?n=7'
    WHEN 'error' THEN '/search?q=&keyword=caf%C3%A9&exclude=a.com,%20b.com' ELSE '/search' END AS url,
  CASE event_type WHEN 'click' THEN '{{"search": "new ' || {_K} || '", "max_results": ' || {_VALUE} || ', "exclude": ["a.com", " b.org "]}}'
    WHEN 'purchase' THEN 'query=form+' || {_K} || '&exclude=x.com+y.com' WHEN 'error' THEN '{{"q": broken'
    WHEN 'signup' THEN '{{"input": "sign up", "num": "' || {_K} || '", "blacklist": "p.com, q.com"}}' END AS body
  FROM events),
read AS (SELECT req_id, regexp_extract(url, '\\?(.*)$', 1) AS qs,
  CASE WHEN kind = 'purchase' THEN body END AS form,
  CASE WHEN kind <> 'purchase' AND json_valid(body) THEN CAST(body AS JSON) END AS json FROM log),
picked AS (SELECT req_id,
  {_first(('q', 'query', 'search', 'keyword', 'text', 'input'))} AS q,
  {_first(('maxResults', 'max_results', 'count', 'limit', 'num', 'n'))} AS m,
  {_first(('exclude', 'excludeDomains', 'exclude_domains', 'blacklist'))} AS x FROM read)"""


def _items(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[,\\s]+'), lambda i: i <> '')"


CONTENT = f"""
answers AS (SELECT event_id AS query_idx,
  CASE event_type WHEN 'view' THEN '{{"results":[{{"url":"u' || {_K} || '","title":"T","publishedDate":null,"text":"é ' || {_VALUE} || '"}},{{"url":null}}]}}'
    WHEN 'purchase' THEN '{{"other":1}}' WHEN 'error' THEN '{{"results":null}}' END AS structured,
  CASE WHEN event_type = 'click' THEN ['not json', '{{"results":[{{"url":"b' || {_K} || '"}}]}}']
    WHEN event_type IN ('purchase', 'error') THEN ['{{"results":[5,{{"url":"x' || {_K} || '"}}]}}', '{{"results":[{{"url":"late"}}]}}']
    ELSE CAST([] AS VARCHAR[]) END AS content FROM events),
fit AS (SELECT query_idx, list_filter(list_prepend(structured, content),
  lambda b: b IS NOT NULL AND json_valid(b) AND list_contains(json_keys(CASE WHEN json_valid(b) THEN b ELSE '{{}}' END), 'results'))[1] AS chosen FROM answers),
items AS (SELECT query_idx, unnest(CAST(CAST(chosen AS JSON)->'$.results' AS JSON[])) AS item,
  generate_subscripts(CAST(CAST(chosen AS JSON)->'$.results' AS JSON[]), 1) AS rank FROM fit WHERE chosen IS NOT NULL)"""

_SNIPPET = f"replace({_strip('text')}, chr(10), ' ')"

SQL = {
    "o01_load_queries": """
SELECT conv_id, turn, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS query_idx,
  unnest(string_split(text, chr(10))) AS query FROM conversations""",
    "o02_parse_payloads": f"""WITH {CONTENT}
SELECT query_idx, CAST(rank AS INTEGER) AS rank, item->>'$.url' AS url, item->>'$.title' AS title,
  item->>'$.publishedDate' AS "publishedDate", item->>'$.text' AS text FROM items""",
    "o03_load_responses": """
SELECT url, url AS final_url, 200 AS status, CAST(octet_length(encode(html)) AS INTEGER) AS body_bytes FROM pages""",
    "o04_write_report": """
SELECT CAST(to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'text': text, 'publishedDate': NULL}) AS VARCHAR) AS json
FROM documents""",
    "o05_validate_queries": f"""
SELECT item_id AS query_idx, CAST(-1 AS BIGINT) AS turn, {_query_error('text')} AS error FROM benchmark
UNION ALL SELECT conv_id, turn, {_query_error('text')} FROM conversations""",
    "o06_validate_max_results": """
SELECT event_id, CASE WHEN event_type <> 'signup' THEN CAST(floor(value) AS INTEGER) END AS max_results,
  CASE WHEN event_type <> 'signup' AND NOT floor(value) BETWEEN 1 AND 25
    THEN 'max_results must be between 1 and 25' END AS error FROM events""",
    "o07_clamp_max_results": f"""
SELECT event_id, {_clamp_text(_K)} AS from_text, {_clamp_text(_VALUE)} AS from_fraction,
  CAST(greatest(1, least(25, trunc(value))) AS INTEGER) AS from_number FROM events""",
    "o08_normalize_requests": f"""WITH {REQUESTS}
SELECT req_id, q->>'$' AS query,
  CASE WHEN m IS NULL THEN 10 WHEN json_type(m) = 'VARCHAR' THEN {_clamp_text("(m->>'$')")}
    ELSE CAST(greatest(1, least(25, trunc(CAST(m AS DOUBLE)))) AS INTEGER) END AS max_results,
  array_to_string(CASE WHEN x IS NULL THEN CAST([] AS VARCHAR[])
    WHEN json_type(x) = 'ARRAY' THEN list_transform(CAST(x AS JSON)->>'$[*]', lambda i: trim(i))
    ELSE {_items("(x->>'$')")} END, '|') AS exclude,
  CASE WHEN q IS NULL THEN 'no query found; send ?q=... or JSON {{"query":...}}' END AS error FROM picked""",
    "o09_split_exclude": f"""
SELECT conv_id, turn, CAST(len({_items('text')}) AS INTEGER) AS n, array_to_string({_items('text')}, '|') AS items
FROM conversations""",
    "o10_exclude_domains": """
SELECT page_id AS rank, url FROM pages WHERE NOT (contains(lower(url), 'spam-farm') OR contains(lower(url), 'example.net')
  OR contains(lower(url), 'utm_') OR contains(lower(url), '/9'))""",
    "o10_exclude_domains_table": """
SELECT page_id AS rank, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM
  (SELECT DISTINCT regexp_extract(url, '^http://([^/?#]*)', 1) AS host FROM pages) h
  WHERE host <> '' AND contains(lower(p.url), lower(host)))""",
    "o10_exclude_domains_long": """WITH
numbered AS (SELECT page_id, CASE WHEN page_id % 4 < 2 THEN page_id ELSE -page_id - 1 END AS n FROM pages),
hits AS (SELECT page_id AS rank, CASE WHEN page_id % 10 = 3 THEN NULL
  WHEN page_id % 2 = 0 THEN 'HTTPS://é.com/' || repeat('a', 500) || '/ITEM/' || n || '/x'
  ELSE 'https://b.com/' || page_id || 'e' || n || '-' END AS url FROM numbered),
patterns AS (SELECT DISTINCT lower(p) AS p FROM (SELECT 'Item/' || doc_id || '/x' AS p FROM documents
  UNION ALL SELECT 'e' || event_id || '-' FROM events UNION ALL SELECT right(url, 9) FROM pages WHERE length(url) >= 9))
SELECT rank, url FROM hits WHERE NOT EXISTS (SELECT 1 FROM patterns WHERE contains(lower(url), p))""",
    "o11_drop_urlless": f"WITH {CHAT} SELECT query_idx, rank, url FROM chat WHERE url IS NOT NULL",
    "o12_to_compat_rows": f"""WITH {CHAT}
SELECT query_idx, rank, coalesce(title, '') AS title, coalesce(url, '') AS url, text AS content, text AS snippet, text,
  coalesce("publishedDate", '') AS "publishedDate" FROM chat""",
    "o13_to_display_lines": f"""WITH {CHAT},
shown AS (SELECT query_idx, rank, list_filter([
  rank || '. ' || coalesce(title, '(untitled)') || CASE WHEN "publishedDate" IS NULL THEN '' ELSE '  (' || "publishedDate" || ')' END,
  '   ' || url,
  CASE WHEN {_strip('text')} <> '' THEN '   ' || CASE WHEN length({_SNIPPET}) > 280 THEN left({_SNIPPET}, 277) || '...' ELSE {_SNIPPET} END END,
  ''], lambda l: l IS NOT NULL) AS lines FROM chat)
SELECT query_idx, rank, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no, unnest(lines) AS line FROM shown
UNION ALL SELECT -item_id - 1, 0, 0, 'No results.' FROM benchmark""",
    "o14_allow_hosts": r"""
SELECT page_id, url, nullif(regexp_extract(url, '\.example\.([a-z0-9-]+)', 1), '') AS host_part,
  CASE WHEN url NOT LIKE 'https:%' THEN 'endpoint URL must use https, got ''' || regexp_extract(url, '^([a-z]+):', 1) || '://...'''
    WHEN NOT regexp_full_match(regexp_extract(url, '^https://([^/?#:]*)', 1), '[a-z0-9-]+\.[a-z0-9-]+\.example\.(?:com|net)')
    THEN 'endpoint URL host is not allowed: ' || regexp_extract(url, '^https://([^/?#:]*)', 1) END AS error FROM pages""",
    "o15_check_fetch_urls": f"""WITH {PAGE_URLS}, {CORPUS},
trimmed AS (SELECT {_strip('url')} AS url FROM (SELECT url FROM asked UNION ALL SELECT url FROM corpus))
SELECT url, CASE WHEN NOT regexp_matches(lower(url), '^https?://') THEN 'only http(s) URLs are supported: ' || url END AS error
FROM trimmed""",
    "o16_search": f"""WITH {CORPUS}, asks AS (SELECT 0 AS query_idx, 'the and of their inside' AS query), {_ranked(25)}
SELECT rank, url, title, text, score FROM ranked JOIN corpus USING (doc_id)""",
    "o17_search_batch": f"WITH {BATCH} SELECT * FROM hits",
    "o17_search_batch_bounded": f"WITH {BATCH} SELECT * FROM hits",
    "o18_fetch_snapshot": f"""WITH {PAGE_URLS}, {ROBOTS}, {RESPONSES},
wanted AS (SELECT {_strip('url')} AS url, min(position) AS position FROM asked GROUP BY 1)
SELECT w.url, position, coalesce(final_url, w.url) AS final_url, coalesce(status, 404) AS status, content_type,
  CAST(body_bytes AS INTEGER) AS body_bytes FROM wanted w LEFT JOIN responses r ON r.url = w.url""",
    "o19_research": f"WITH {RESEARCH} SELECT * FROM sources",
    "o20_merge_results": f"WITH {BATCH}, {MERGED} SELECT query_idx, rank, url, title FROM merged",
    "o20_merge_keep_urlless": f"""WITH {CHAT},
hits AS (SELECT query_idx, rank, url FROM chat
  UNION ALL SELECT -1, page_id, regexp_extract(url, '^(https?://[^/]*)', 1) FROM pages)
SELECT * FROM hits WHERE url IS NULL
UNION ALL (SELECT * FROM hits WHERE url IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY query_idx, rank) = 1)""",
    "o21_dedupe_urls": f"""WITH {PAGE_URLS}
SELECT {_strip('url')} AS url, min(position) AS position FROM asked GROUP BY 1""",
    "o22_query_stats": f"""WITH {BATCH}
SELECT item_id AS query_idx, text AS query, (SELECT count(*) FROM hits WHERE hits.query_idx = item_id) AS count,
  {_query_error('text')} AS error FROM benchmark""",
    "o23_batch_summary": f"""WITH {BATCH}, {MERGED}
SELECT (SELECT count(*) FROM merged) AS total, count(*) AS "queryCount",
  count({_query_error('text')}) AS "errorCount" FROM benchmark""",
    "o24_fetch_summary": f"""WITH {EXTRACT}, {ROBOTS}, {RESPONSES}, {ARTICLES}
SELECT count(*) AS total, count(error) AS "errorCount", count(*) AS requested FROM records""",
    "o25_research_summary": f"""WITH {RESEARCH}
SELECT query_idx AS topic, count(s.rank) AS "sourceCount", count(s.text) AS fetched, count("fetchError") AS "errorCount"
FROM asks LEFT JOIN sources s ON s.topic = query_idx GROUP BY query_idx""",
    "o26_nest_report": f"""WITH {CHAT}
SELECT query_idx, CAST(count(*) AS INTEGER) AS n,
  string_agg(text, '|' ORDER BY rank) AS texts FROM chat GROUP BY ALL""",
    "o26_batch_lines": f"""WITH {BATCH}, {MERGED}
SELECT 'queries' AS section, row_number() OVER (ORDER BY item_id) AS position,
  CAST(to_json({{'query': text, 'count': (SELECT count(*) FROM hits WHERE hits.query_idx = item_id), 'error': {_query_error('text')}}}) AS VARCHAR) AS json FROM benchmark
UNION ALL SELECT 'results', row_number() OVER (ORDER BY query_idx, rank),
  CAST(to_json({{'url': url, 'title': title, 'publishedDate': "publishedDate", 'text': text}}) AS VARCHAR) FROM merged
UNION ALL SELECT 'summary', 1, CAST(to_json({{'total': (SELECT count(*) FROM merged), 'queryCount': count(*),
  'errorCount': count({_query_error('text')})}}) AS VARCHAR) FROM benchmark""",
    "o26_fetch_lines": f"""WITH {PAGE_URLS}, {EXTRACT}, {ROBOTS}, {RESPONSES}, {ARTICLES},
firsts AS (SELECT {_strip('url')} AS url, min(position) AS first FROM asked GROUP BY 1)
SELECT 'results' AS section, row_number() OVER (ORDER BY first) AS position,
  CAST(to_json({{'url': r.url, 'finalUrl': "finalUrl", 'status': status, 'title': title, 'text': text, 'chars': chars,
    'fetchedAt': "fetchedAt", 'error': error}}) AS VARCHAR) AS json FROM records r JOIN firsts f ON f.url = r.url
UNION ALL SELECT 'summary', 1, CAST(to_json({{'total': count(*), 'errorCount': count(error), 'requested': count(*)}}) AS VARCHAR) FROM records""",
    "o26_bridge_documents": f"""WITH {CORPUS},
asks AS (SELECT conv_id * 1000 + turn AS query_idx, text AS query FROM conversations WHERE {_query_error('text')} IS NULL),
{_ranked(3)},
kept AS (SELECT query_idx, rank, title, url, text FROM ranked JOIN corpus USING (doc_id)
  WHERE NOT contains(url, 'doc://0') AND NOT contains(url, 'doc://f'))
SELECT conv_id * 1000 + turn AS req_id, CAST(to_json({{'query': nullif(c.text, ''), 'total': count(rank),
  'results': coalesce(list({{'title': title, 'url': url, 'content': k.text, 'snippet': k.text, 'text': k.text, 'publishedDate': ''}}
    ORDER BY rank) FILTER (rank IS NOT NULL), [])}}) AS VARCHAR) AS json
FROM conversations c LEFT JOIN kept k ON query_idx = conv_id * 1000 + turn GROUP BY conv_id, turn, c.text""",
    "o26_research_documents": f"""WITH {RESEARCH}
SELECT CAST(to_json({{'topic': query_idx, 'sourceCount': count(s.rank), 'fetched': count(s.text), 'errorCount': count("fetchError"),
  'sources': coalesce(list({{'url': url, 'title': title, 'publishedDate': "publishedDate", 'snippet': snippet, 'text': s.text,
    'fetchError': "fetchError"}} ORDER BY s.rank) FILTER (s.rank IS NOT NULL), [])}}) AS VARCHAR) AS json
FROM asks LEFT JOIN sources s ON s.topic = query_idx GROUP BY query_idx""",
    "o27_parse_robots": f"WITH {ROBOTS} SELECT scheme, authority, rule_no, allow, path FROM rules",
    "o28_robots_allowed": f"WITH {ROBOTS} SELECT page_id, url, allowed FROM verdicts",
    "o29_classify_response": f"WITH {ROBOTS}, {RESPONSES} SELECT url, error FROM checked",
    "o30_cap_and_decode": "SELECT page_id, html FROM pages",
    "o30_decode_kinds": r"""
SELECT page_id, CASE page_id % 5 WHEN 0 THEN html || '�' WHEN 1 THEN regexp_replace(html, '[^\x00-\x7F]', '', 'g') || '€'
  WHEN 4 THEN left(regexp_replace(html, '[^\x00-\x7F]', '', 'g'), 1000) ELSE html END AS html FROM pages""",
    "o31_extract_title": f"WITH {EXTRACT} SELECT page_id, title FROM titled",
    "o32_strip_noise": f"WITH {EXTRACT} SELECT page_id, bare FROM titled",
    "o33_pick_root": f"WITH {EXTRACT} SELECT page_id, root FROM rooted",
    "o34_block_text": f"WITH {EXTRACT} SELECT page_id, text FROM blocks",
    "o35_strip_tags_fallback": rf"""
SELECT page_id, {_strip(r"regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')")} AS text FROM pages""",
    "o36_truncate_text": f"""
SELECT doc_id, {TRUNCATED} AS cut_default,
  CASE WHEN length(text) > 120 THEN rtrim(left(text, 120), {SPACE}) || '…' ELSE text END AS cut_short, text AS uncut
FROM documents""",
    "o37_article_record": f"WITH {EXTRACT}, {ROBOTS}, {RESPONSES}, {ARTICLES} SELECT * FROM records",
    "o37_latest_capture": f"""WITH {EXTRACT}, {ROBOTS}, {RESPONSES}, {ARTICLES}
SELECT r.url, "finalUrl", status,
  CASE WHEN title IS NOT NULL AND page_id <= 100 THEN 'second' ELSE title END AS title, text, chars,
  CASE WHEN "fetchedAt" IS NOT NULL THEN strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id)
    + (CASE WHEN page_id <= 100 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END), '%Y-%m-%dT%H:%M:%SZ') END AS "fetchedAt", error
FROM records r LEFT JOIN pages p ON p.url = r.url
UNION ALL SELECT 'ftp://' || page_id, NULL, NULL, NULL, '', 0, NULL, 'only http(s) URLs are supported: ftp://' || page_id FROM pages""",
    "o38_rate_schedule": """WITH
numbered AS (SELECT event_id, event_type, date_trunc('hour', ts) AS t, epoch_us(date_trunc('hour', ts)) AS us,
  row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts), event_id) AS i FROM events),
carried AS (SELECT *, max(us - i * 400000.0::DOUBLE) OVER (PARTITION BY event_type ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM numbered),
waits AS (SELECT *, CAST(round(greatest(0, coalesce(m + (i - 1.5) * 400000.0::DOUBLE - us, 0))) AS BIGINT) AS wait_us FROM carried)
SELECT event_id, event_type, wait_us, t + to_microseconds(wait_us) AS granted_at FROM waits""",
    "o38_rate_schedule_split": """WITH
numbered AS (SELECT event_id, event_type, date_trunc('hour', ts) AS t, CAST(epoch_us(date_trunc('hour', ts)) AS HUGEINT) * 7 AS us,
  row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts), event_id) AS i FROM events),
carried AS (SELECT *, max(us - i * 1000000) OVER (PARTITION BY event_type ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM numbered),
waits AS (SELECT *, CAST((2 * greatest(0, coalesce(m + (i - 6) * 1000000 - us, 0)) + 7) // 14 AS BIGINT) AS wait_us FROM carried)
SELECT event_id, event_type, wait_us, t + to_microseconds(wait_us) AS granted_at FROM waits""",
    "o39_peak_in_flight": """WITH
moments AS (SELECT user_id, ts AS t, 1 AS step FROM events
  UNION ALL SELECT user_id, ts + to_milliseconds(CAST(round(value * 60000) AS BIGINT)), -1 FROM events),
open AS (SELECT user_id, sum(step) OVER (PARTITION BY user_id ORDER BY t, step ROWS UNBOUNDED PRECEDING) AS n FROM moments)
SELECT user_id, CAST(greatest(max(n), 0) AS BIGINT) AS peak, max(n) <= 3 AS within_cap FROM open GROUP BY user_id""",
    "answer_log": f"""WITH {CORPUS},
asks AS (SELECT conv_id * 1000 + turn AS query_idx, text AS query FROM conversations WHERE {_query_error('text')} IS NULL),
{_ranked(3)}
SELECT query_idx AS req_id, rank, url, title, '' AS "publishedDate" FROM ranked JOIN corpus USING (doc_id)
WHERE NOT contains(url, 'doc://0') AND NOT contains(url, 'doc://f')""",
}
