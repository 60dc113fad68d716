"""The registered queries once more, as SQL for another engine.

Written from the definitions, not from the Spark code: text windows by substring, pages by GROUP BY, search by joins.
"""

from __future__ import annotations

from millrace.functions.markup import BLOCK_TAGS, CHARACTER_NAMES, FRAME_TAGS
from millrace.functions.text import ENTITY_RULES, WHITESPACE
from millrace.plans.derived import (
    DOCUMENT_FIELDS,
    FEATURE_CUT,
    FRESHNESS_AS_OF,
    LABEL_SHIFT_YEARS,
    LANGUAGE_WORDS,
)
from millrace.sources.tables import TABLES

WS = "'" + WHITESPACE + "'"
EMAIL, PHONE = ENTITY_RULES["email"], ENTITY_RULES["phone number"]


def _replace(text: str, *rules: tuple[str, str]) -> str:
    for pattern, mark in rules:
        text = f"regexp_replace({text}, '{pattern}', '{mark}', 'g')"
    return text


def _redact(text: str) -> str:
    return _replace(f"coalesce({text}, '')", EMAIL, PHONE)


# --- orders ------------------------------------------------------------------------------------------------------

DIRTY = """
dirty AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 20000 THEN NULL ELSE o_orderkey END AS o_orderkey,
         o_custkey,
         CASE WHEN o_orderpriority = '2-HIGH' AND o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 60000 THEN -o_totalprice
              WHEN o_totalprice > 495000 THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders)"""
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' ELSE 'Unknown' END"


def _silver(source: str = "orders") -> str:
    return f"""
silver AS (
  SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice), {STATUS} AS order_status
  FROM {source} WHERE o_totalprice > 0 AND o_orderkey IS NOT NULL)"""


# Rounds half up, like the exact decimal average; a plain avg() would go through doubles.
MEAN = (
    "CAST(CAST((2 * CAST(sum(o_totalprice * 100) AS HUGEINT) + count(*)) // (2 * count(*)) AS DECIMAL(18,0)) / 100"
    " AS DECIMAL(18,2))"
)


def _features(source: str = "silver", high_value: int = 500) -> str:
    return f"""
  SELECT o_custkey AS customer_key, count(o_orderkey) AS total_orders, {MEAN} AS avg_order_value,
         count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS months_active,
         avg(CASE WHEN o_totalprice > {high_value} THEN 1.0 ELSE 0.0 END) AS high_value_ratio
  FROM {source} GROUP BY o_custkey"""


def _plain_features(name: str) -> str:
    return (
        f"SELECT customer_key, total_orders, CAST(avg_order_value AS DOUBLE) AS avg_order_value, months_active, "
        f"high_value_ratio FROM {name}"
    )


FEATURE_JSON = (
    "to_json({'total_orders': total_orders, 'avg_order_value': avg_order_value, 'months_active': months_active, "
    "'high_value_ratio': high_value_ratio})"
)
VERSIONS = f"""
older AS (SELECT * FROM silver WHERE o_orderdate < TIMESTAMP '{FEATURE_CUT}'),
newer AS (SELECT * FROM silver WHERE o_orderdate >= TIMESTAMP '{FEATURE_CUT}'),
f_old AS ({_features("older")}), f_new AS ({_features("newer")}),
f_all AS (SELECT * FROM f_new UNION ALL SELECT * FROM f_old WHERE customer_key NOT IN (SELECT customer_key FROM f_new))"""


def _rule_counts(dataset: str) -> str:
    rules = {
        "valid_price": "o_totalprice > 0",
        "valid_order_key": "o_orderkey IS NOT NULL",
        "known_status": "o_orderstatus IN ('F','O','P')",
    }
    return f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT '{name}' AS name, '{dataset}' AS dataset, count(*) FILTER (WHERE {cond}) AS passed_records, "
        f"count(*) - count(*) FILTER (WHERE {cond}) AS failed_records FROM dirty"
        for name, cond in rules.items()
    )


def _sales(group: str) -> str:
    by = f"GROUP BY {group}" if group else ""
    columns = {"": "", "order_status": "order_status,", "order_status, o_orderdate": "order_status, o_orderdate AS order_date,"}
    return f"""WITH {_silver()}
SELECT {columns[group]} CAST(sum(o_totalprice) AS DOUBLE) AS total_revenue, CAST({MEAN} AS DOUBLE) AS avg_order_value
FROM silver {by}"""


DAILY = f"""WITH {_silver()}
SELECT year(o_orderdate) AS order_year, month(o_orderdate) AS order_month, day(o_orderdate) AS order_day,
       CAST(CAST(sum(o_totalprice) AS DECIMAL(18,2)) AS DOUBLE) AS total_sales, count(o_orderkey) AS order_count
FROM silver GROUP BY 1, 2, 3"""

# --- documents ---------------------------------------------------------------------------------------------------

PLAIN = "documents_v1 AS (SELECT 'documents/' || doc_id AS path, text, source, lang FROM documents)"
PLAIN_2 = """documents_v2 AS (
  SELECT 'documents/' || (CASE WHEN source = 'src5' THEN doc_id + 1000000000000 ELSE doc_id END) AS path,
         CASE WHEN lang = 'fr' THEN text || chr(10) || 'This sentence was added later.' ELSE text END AS text
  FROM documents WHERE source <> 'src3')"""


def _plain_pages(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT path, 0 AS page, '' AS title, {_redact("text")} AS text FROM {source} WHERE trim(text) <> '')"""


def _chunks(name: str, pages: str) -> str:
    """Windows of 1000 characters that overlap by 150, at least 50 long."""
    return f"""
{name}_w AS (
  SELECT path, page, title, list_filter(list_transform(
           range(CASE WHEN length(t) <= 1000 THEN 1 ELSE 1 + CAST(ceil((length(t) - 1000) / 850.0) AS BIGINT) END),
           lambda i: trim(substring(t, CAST(i * 850 + 1 AS BIGINT), 1000), {WS})), lambda w: length(w) >= 50) AS w
  FROM (SELECT path, page, title, trim(text, {WS}) AS t FROM {pages})),
{name}_p AS (
  SELECT path, page, title, unnest(w) AS chunk_content, unnest(range(len(w))) AS chunk_position FROM {name}_w),
{name} AS (
  SELECT sha1(path || '::' || page || '::' || chunk_position) AS chunk_id, chunk_content,
         {_redact("title || chr(10) || chunk_content")} AS chunk_to_embed,
         CAST(chunk_position AS INTEGER) AS chunk_position, path || ' (p.' || page || ')' AS source_uri, path
  FROM {name}_p)"""


DOC_CHUNKS = f"{PLAIN}, {_plain_pages('pages_v1', 'documents_v1')}, {_chunks('chunks', 'pages_v1')}"

_TEXT = "list_extract(string_split(b, chr(2)), -1)"
_CLEAN = f"regexp_replace({_TEXT}, '<[a-zA-Z/!?][^>]*(?:>|\\z)', ' ', 'g')"
for _name, _char in CHARACTER_NAMES.items():
    _quoted = _char.replace("'", "''")
    _CLEAN = f"replace({_CLEAN}, '{_name}', '{_quoted}')"


def _open(names: str) -> str:
    """One more or less open element of these names."""
    listed = names.split("|")
    return f"CASE WHEN tag IN ({', '.join(repr(n) for n in listed)}) THEN 1 WHEN tag IN ({', '.join(repr('/' + n) for n in listed)}) THEN -1 ELSE 0 END"


_SO_FAR = "OVER (PARTITION BY path ORDER BY g ROWS UNBOUNDED PRECEDING)"
ELEMENTS = rf"""
visible AS (
  SELECT url AS path, regexp_replace(translate(coalesce(html, ''), chr(1) || chr(2) || chr(3), ''),
           '(?is)<script.*?(?:</script>|\z)|<style.*?(?:</style>|\z)|<!--.*?(?:-->|\z)', '', 'g') AS v,
         CASE WHEN trim(coalesce(html, ''), {WS}) = '' THEN 'empty' END AS error_status
  FROM pages),
parts AS (
  SELECT path, error_status, unnest(l) AS s, unnest(range(len(l))) AS g
  FROM (SELECT path, error_status,
               string_split(chr(2) || regexp_replace(v, '(?i)<(/?(?:{FRAME_TAGS}))(?:\s[^>]*)?>', chr(3) || '\1' || chr(2), 'g'), chr(3)) AS l
        FROM visible)),
tagged AS (SELECT *, lower(split_part(s, chr(2), 1)) AS tag FROM parts),
summed AS (
  SELECT *, sum({_open('nav')}) {_SO_FAR} AS navs, sum({_open('footer')}) {_SO_FAR} AS footers,
         sum({_open('article|main')}) {_SO_FAR} AS bodies FROM tagged),
framed AS (
  SELECT path, error_status, g, substr(s, strpos(s, chr(2)) + 1) AS rest,
         CASE WHEN navs > least(0, min(navs) {_SO_FAR}) THEN 'navigation'
              WHEN footers > least(0, min(footers) {_SO_FAR}) AND bodies = least(0, min(bodies) {_SO_FAR}) THEN 'footer' END AS frame
  FROM summed),
blocks AS (
  SELECT path, error_status, g, frame, unnest(l) AS b, unnest(range(len(l))) AS n
  FROM (SELECT *, string_split('p' || chr(2) || regexp_replace(regexp_replace(rest, '(?i)<({BLOCK_TAGS})(\s[^>]*)?>', chr(1) || '\1' || chr(2), 'g'),
                    '(?i)</(?:{BLOCK_TAGS})\s*>', chr(1) || 'p' || chr(2), 'g'), chr(1)) AS l FROM framed)),
typed AS (
  SELECT path, error_status, g, n, frame, lower(split_part(b, chr(2), 1)) AS tag,
         trim(regexp_replace({_CLEAN}, '[ \n\t\r]+', ' ', 'g'), {WS}) AS text FROM blocks),
els AS (
  SELECT path, error_status, row_number() OVER (PARTITION BY path ORDER BY g, n) - 1 AS position, text,
         CASE WHEN frame IS NOT NULL THEN frame WHEN tag = 'title' THEN 'title' WHEN regexp_matches(tag, '^h[1-6]$') THEN 'heading'
              WHEN tag = 'li' THEN 'list_item' ELSE 'text' END AS type
  FROM typed WHERE text <> ''),
elements AS (
  SELECT path, error_status, CAST(position AS INTEGER) AS position, CAST(position // 10 AS INTEGER) AS page, type, text
  FROM els)"""


def _html_pages(name: str, keep: str) -> str:
    return f"""
{name}_k AS (SELECT * FROM elements WHERE error_status IS NULL AND {keep}),
{name}_d AS (
  SELECT path, arg_min(text, position) AS doc_title FROM {name}_k WHERE type IN ('title', 'heading') GROUP BY path),
{name}_g AS (
  SELECT path, page, arg_min(text, position) FILTER (WHERE type IN ('title', 'heading')) AS own_title,
         string_agg(text, chr(10) ORDER BY position) AS text FROM {name}_k GROUP BY path, page),
{name} AS (
  SELECT path, page, {_redact("coalesce(own_title, doc_title)")} AS title, {_redact("text")} AS text
  FROM {name}_g LEFT JOIN {name}_d USING (path))"""


def _language(words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(ts, lambda t: t IN ({listed})))"


_SCORES = {label: _language(words) for label, words in LANGUAGE_WORDS.items()}
_BEST = f"greatest({', '.join(f's_{label}' for label in _SCORES)})"
ENRICHED = f"""WITH {PLAIN},
counted AS (
  SELECT path, text, {', '.join(f'{score} AS s_{label}' for label, score in _SCORES.items())}
  FROM (SELECT path, text, string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+') AS ts
        FROM documents_v1 WHERE trim(text) <> ''))
SELECT path, CASE WHEN {_BEST} = 0 THEN NULL {' '.join(f"WHEN s_{label} = {_BEST} THEN '{label}'" for label in _SCORES)} END
         AS doc_type,
       {', '.join(f"nullif(regexp_extract(text, '{pattern}', 1), '') AS {name}" for name, pattern in DOCUMENT_FIELDS.items())}
FROM counted"""

# --- search ------------------------------------------------------------------------------------------------------


def _tokens(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


TERMS = f"""
tok AS (SELECT chunk_id, path, source_uri, chunk_position, chunk_content, {_tokens("chunk_to_embed")} AS ts FROM chunks),
post AS (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(ts) AS term FROM tok) GROUP BY ALL),
lens AS (SELECT chunk_id, len(ts) AS n FROM tok),
st AS (SELECT count(*) AS n, avg(n) AS mean FROM lens),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
q AS (SELECT item_id AS query_id, term, count(*) AS tf
      FROM (SELECT item_id, unnest({_tokens("text")}) AS term FROM benchmark) GROUP BY ALL)"""

BM25 = """
bm AS (
  SELECT query_id, chunk_id,
         round(sum(ln(1 + (st.n - df + 0.5) / (df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.n / mean))), 6)
           AS score
  FROM (SELECT DISTINCT query_id, term FROM q) JOIN post p USING (term) JOIN df USING (term) JOIN lens l USING (chunk_id), st
  GROUP BY query_id, chunk_id),
bm_rank AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM bm WHERE score > 0)"""


def _hex(term: str, start: int, digits: int) -> str:
    return f"CAST('0x' || substr(md5({term}), {start}, {digits}) AS BIGINT)"


def _vector(name: str, key: str, source: str) -> str:
    return f"""
{name}_raw AS (
  SELECT {key}, {_hex("term", 1, 8)} % 1024 AS dim,
         sum((CASE WHEN {_hex("term", 9, 1)} % 2 = 0 THEN 1.0 ELSE -1.0 END)::DOUBLE * tf
             * ln(1 + (st.n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5))) AS value
  FROM {source} LEFT JOIN df USING (term), st GROUP BY ALL),
{name} AS (
  SELECT {key}, dim, value / sqrt(sum(value * value) OVER (PARTITION BY {key})) AS value
  FROM {name}_raw WHERE abs(value) > 1e-12)"""


VECTORS = _vector("cv", "chunk_id", "post")
VECTOR_SEARCH = f"""{VECTORS}, {_vector("qv", "query_id", "q")},
vs AS (
  SELECT query_id, chunk_id, round(sum(qv.value * cv.value), 6) AS score FROM qv JOIN cv USING (dim) GROUP BY ALL),
vs_rank AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM vs WHERE score > 0)"""
HYBRID = """
fused AS (
  SELECT query_id, chunk_id, round(sum(CAST(1.0 AS DOUBLE) / (60 + rank)), 8) AS score
  FROM (SELECT query_id, chunk_id, rank FROM bm_rank WHERE rank <= 50
        UNION ALL SELECT query_id, chunk_id, rank FROM vs_rank WHERE rank <= 50)
  GROUP BY query_id, chunk_id),
hy_rank AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM fused)"""

_SEARCH = f"WITH {DOC_CHUNKS}, {TERMS}"
HIT_RATES = f"""{_SEARCH}, {BM25}, {VECTOR_SEARCH}, {HYBRID},
truth AS (SELECT item_id AS query_id, path FROM benchmark b JOIN documents_v1 d ON contains(d.text, b.text)),
tops AS (SELECT 'KEYWORD' AS method, query_id, chunk_id FROM bm_rank WHERE rank <= 5
         UNION ALL SELECT 'ANN', query_id, chunk_id FROM vs_rank WHERE rank <= 5
         UNION ALL SELECT 'HYBRID', query_id, chunk_id FROM hy_rank WHERE rank <= 5),
good AS (SELECT method, count(DISTINCT query_id) AS hits
         FROM tops JOIN tok USING (chunk_id) JOIN truth USING (query_id, path) GROUP BY method),
rates AS (
  SELECT method, coalesce(hits, 0) AS hits, (SELECT count(DISTINCT query_id) FROM truth) AS questions,
         coalesce(hits, 0) / (SELECT count(DISTINCT query_id) FROM truth) AS hit_rate
  FROM (SELECT unnest(['KEYWORD', 'ANN', 'HYBRID']) AS method) LEFT JOIN good USING (method))"""

CENTROIDS = """
xs AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
means AS (SELECT label AS query_id, i, avg(x) AS c FROM xs GROUP BY label, i),
norms AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM xs GROUP BY vec_id),
cnorms AS (SELECT query_id, sqrt(sum(c * c)) AS n FROM means GROUP BY query_id),
cosines AS (
  SELECT query_id, vec_id, round(sum(c * x) / (any_value(norms.n) * any_value(cnorms.n)), 6) AS score
  FROM xs JOIN means USING (i) JOIN norms USING (vec_id) JOIN cnorms USING (query_id) GROUP BY query_id, vec_id)"""

# 512 signs of each vector; a question's 100 nearest by differing signs are compared.
def _sketch(key: str, source: str, value: str) -> str:
    return f"""(SELECT {key}, b, sum({value} * s) >= 0 AS side FROM {source} JOIN planes ON d = i GROUP BY ALL)"""


SKETCHES = f"""
planes AS (
  SELECT b, d, CASE WHEN CAST('0x' || substr(md5('sketch:' || b || ':' || d), 1, 2) AS BIGINT) % 2 = 0 THEN 1.0::DOUBLE
                    ELSE -1.0::DOUBLE END AS s
  FROM range(512) AS bb(b), range(64) AS dd(d)),
apart AS (
  SELECT query_id, vec_id, count(*) FILTER (v.side <> m.side) AS n
  FROM {_sketch('vec_id', 'xs', 'x')} v JOIN {_sketch('query_id', 'means', 'c')} m USING (b) GROUP BY ALL),
near AS (
  SELECT query_id, vec_id
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n, vec_id) AS place FROM apart) WHERE place <= 100)"""
EXACT = "exact AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM cosines)"
APPROXIMATE = """
ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM cosines JOIN near USING (query_id, vec_id))"""

FORGET = "forgotten AS (SELECT DISTINCT 'documents/' || doc_id AS path FROM labels WHERE toxic = 1)"


def _forget_row(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS rows_before,
  count(*) FILTER (WHERE path IN (SELECT path FROM forgotten)) AS rows_removed,
  (SELECT count(*) FROM (SELECT path FROM {source} EXCEPT SELECT path FROM forgotten) SEMI JOIN forgotten USING (path)) AS rows_leftover
FROM {source}"""


def _held(state: str, source: str) -> str:
    return f"""SELECT '{state}' AS state, count(*) FILTER (WHERE path IN (SELECT path FROM forgotten)) AS rows_by_path,
  count(*) FILTER (WHERE chunk_id IN (SELECT chunk_id FROM gone)) AS rows_by_chunk_id,
  count(*) FILTER (WHERE chunk_to_embed IN (SELECT chunk_to_embed FROM gone)) AS rows_by_text_hash
FROM ({source})"""


ORACLES = {
    "orders_bronze": "SELECT *, 'tpch' AS source_system FROM orders",
    "orders_silver": f"""WITH {DIRTY}, {_silver("dirty")}
SELECT * REPLACE (CAST(o_totalprice AS DOUBLE) AS o_totalprice) FROM silver""",
    "expectation_metrics": _rule_counts("orders"),
    "quality_log": _rule_counts("orders_silver"),
    "daily_sales": DAILY,
    "daily_sales_first_days": f"SELECT * FROM ({DAILY}) ORDER BY order_year, order_month, order_day LIMIT 5",
    "sales_metrics_total": _sales(""),
    "sales_metrics_by_status": _sales("order_status"),
    "sales_metrics_by_status_date": _sales("order_status, o_orderdate"),
    "customer_features": f"WITH {_silver()}, f AS ({_features()}) {_plain_features('f')}",
    "customer_features_high_value": f"WITH {_silver()}, f AS ({_features(high_value=250000)}) {_plain_features('f')}",
    "features_lookup_json": f"""WITH {_silver()}, f AS ({_features()})
SELECT c_custkey AS customer_key, CASE WHEN f.customer_key IS NOT NULL THEN CAST({FEATURE_JSON} AS VARCHAR) END AS features_json
FROM customer LEFT JOIN f ON f.customer_key = c_custkey""",
    "features_lookup_smallest": f"""WITH {_silver()}, f AS ({_features()})
SELECT CAST({FEATURE_JSON} AS VARCHAR) AS features_json FROM f WHERE customer_key = (SELECT min(customer_key) FROM f)""",
    "features_upsert": f"WITH {_silver()}, {VERSIONS} {_plain_features('f_all')}",
    "features_publish_changes": f"""WITH {_silver()}, {VERSIONS}
SELECT a.customer_key, a.total_orders, CAST(a.avg_order_value AS DOUBLE) AS avg_order_value, a.months_active,
       a.high_value_ratio, CASE WHEN o.customer_key IS NULL THEN 'insert' ELSE 'update' END AS change_type
FROM f_all a LEFT JOIN f_old o USING (customer_key)
WHERE o.customer_key IS NULL OR (a.total_orders, a.avg_order_value, a.months_active, a.high_value_ratio)
      <> (o.total_orders, o.avg_order_value, o.months_active, o.high_value_ratio)""",
    "features_publish_snapshot": f"""WITH {_silver()}, {VERSIONS}
SELECT *, 'snapshot' AS change_type FROM ({_plain_features('f_all')})""",
    "features_as_of": f"""WITH {_silver()},
history AS (
  SELECT o_custkey AS customer_key, o_orderdate AS feature_time, count(o_orderkey) AS day_orders,
         CAST(sum(o_totalprice) AS DOUBLE) AS day_spent FROM silver GROUP BY 1, 2),
asked AS (SELECT event_id, user_id AS customer_key, ts - INTERVAL {LABEL_SHIFT_YEARS} YEARS AS label_time FROM events)
SELECT event_id, a.customer_key, label_time, feature_time, day_orders, day_spent
FROM asked a ASOF LEFT JOIN history h ON a.customer_key = h.customer_key AND a.label_time >= h.feature_time""",
    "docs_binary_ingest": "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest FROM documents",
    # Pages that are empty, and those that were cut off.
    "parse_errors": f"""SELECT count(*) FILTER (WHERE trim(coalesce(html, ''), {WS}) = ''
  OR NOT ends_with(lower(trim(html, {WS})), '</html>')) AS parse_errors FROM pages""",
    "doc_elements": f"WITH {ELEMENTS} SELECT path, position, page, type, text FROM elements",
    "element_walk": f"""WITH {ELEMENTS},
counts AS (SELECT path, (SELECT count(*) FROM elements e WHERE e.path = m.path) AS n FROM visible m)
SELECT path, position, page, type, text FROM elements
UNION ALL SELECT path, CAST(n AS INTEGER), 3, '', path FROM counts""",
    "event_properties": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "doc_pages": f"WITH {ELEMENTS}, {_html_pages('assembled', 'TRUE')} SELECT path, page, title, text FROM assembled",
    "docs_redacted": f"SELECT doc_id, {_redact('text')} AS text FROM documents",
    "docs_masked_entities": f"""SELECT doc_id, {_replace("coalesce(text, '')", *ENTITY_RULES.values())} AS text FROM documents""",
    "doc_chunks": f"WITH {DOC_CHUNKS} SELECT * FROM chunks",
    "page_chunks": f"""WITH {ELEMENTS}, {_html_pages('assembled', "type NOT IN ('navigation', 'footer')")},
{_chunks('chunks', 'assembled')} SELECT * FROM chunks""",
    "prechunked": f"""WITH lines AS (
  SELECT 'documents/' || doc_id AS path, source, lang, unnest(l) AS line, unnest(range(len(l))) AS i
  FROM (SELECT doc_id, source, lang, string_split(text, chr(10)) AS l FROM documents))
SELECT path || '#' || i AS chunk_id, {_redact('line')} AS chunk_content,
       {_redact("lang || chr(10) || line")} AS chunk_to_embed, CAST(i AS INTEGER) AS chunk_position,
       source AS source_uri, path FROM lines""",
    "docs_enriched": ENRICHED,
    "index_changes": f"""WITH {DOC_CHUNKS}, {PLAIN_2}, {_plain_pages('pages_v2', 'documents_v2')}, {_chunks('chunks2', 'pages_v2')}
SELECT chunk_id, CASE WHEN a.chunk_to_embed IS NULL THEN 'insert' WHEN b.chunk_to_embed IS NULL THEN 'delete' ELSE 'update' END
         AS change_type
FROM chunks a FULL JOIN chunks2 b USING (chunk_id) WHERE a.chunk_to_embed IS DISTINCT FROM b.chunk_to_embed""",
    "index_synced": f"""WITH {PLAIN_2}, {_plain_pages('pages_v2', 'documents_v2')}, {_chunks('chunks2', 'pages_v2')}
SELECT chunk_id, md5(chunk_to_embed) AS digest FROM chunks2""",
    "bm25_topk": f"{_SEARCH}, {BM25} SELECT query_id, chunk_id, score, rank FROM bm_rank WHERE rank <= 5",
    "hashed_vectors": f"{_SEARCH}, {VECTORS} SELECT chunk_id, dim, round(value, 6) AS value FROM cv",
    "vector_topk": f"{_SEARCH}, {VECTOR_SEARCH} SELECT query_id, chunk_id, score, rank FROM vs_rank WHERE rank <= 5",
    "hybrid_topk": f"""{_SEARCH}, {BM25}, {VECTOR_SEARCH}, {HYBRID}
SELECT query_id, rank, score, chunk_id, chunk_content, source_uri, chunk_position
FROM hy_rank JOIN tok USING (chunk_id) WHERE rank <= 5""",
    "reranked_topk": f"""{_SEARCH}, {BM25}, {VECTOR_SEARCH},
second AS (
  SELECT query_id, chunk_id, coalesce(vs.score, 0.0) AS score
  FROM (SELECT query_id, chunk_id FROM bm_rank WHERE rank <= 20) LEFT JOIN vs USING (query_id, chunk_id)),
second_rank AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM second)
SELECT query_id, chunk_id, score, rank FROM second_rank WHERE rank <= 5""",
    "cosine_topk": f"""WITH {CENTROIDS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM cosines)
SELECT query_id, vec_id, score, rank FROM ranked WHERE rank <= 5""",
    "ann_topk": f"WITH {CENTROIDS}, {SKETCHES}, {APPROXIMATE} SELECT query_id, vec_id, score, rank FROM ranked WHERE rank <= 5",
    "ann_recall": f"""WITH {CENTROIDS}, {SKETCHES}, {APPROXIMATE}, {EXACT}
SELECT count(*) AS wanted, count(r.vec_id) AS found, round(count(r.vec_id) / count(*), 6) AS recall
FROM (SELECT * FROM exact WHERE rank <= 5) e LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) r USING (query_id, vec_id)""",
    "search_after_sync": f"""WITH {PLAIN_2}, {_plain_pages('pages_v2', 'documents_v2')}, {_chunks('chunks', 'pages_v2')}, {TERMS}, {BM25}
SELECT query_id, chunk_id, score, rank FROM bm_rank WHERE rank <= 5""",
    "hit_rate_at_k": f"{HIT_RATES} SELECT method, hits, questions, hit_rate FROM rates",
    "retrieval_gate": f"""{HIT_RATES}
SELECT 'hit_rate_hybrid' AS metric, hit_rate AS value, 0.8::DOUBLE AS minimum, hit_rate >= 0.8 AS passed
FROM rates WHERE method = 'HYBRID'
UNION ALL SELECT 'groundedness', NULL, 0.8::DOUBLE, FALSE""",
    "failures_24h": """
SELECT event_type AS name, 'events' AS dataset, CAST(sum(f) AS BIGINT) AS failed_24h, CAST(sum(p) AS BIGINT) AS passed_24h
FROM (SELECT date_trunc('hour', ts) AS h, event_type, count(*) FILTER (WHERE value > 150) AS f,
             count(*) FILTER (WHERE value <= 150) AS p FROM events GROUP BY ALL)
WHERE h > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS
GROUP BY event_type HAVING sum(f) > 0""",
    "freshness_hours": f"""
SELECT event_type, max(ts) AS last_commit, date_sub('hour', max(ts), TIMESTAMP '{FRESHNESS_AS_OF}') AS hours_since_change
FROM events GROUP BY event_type""",
    "table_health": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {t}"
        for t in TABLES
    ),
    "retrieval_canary": f"""WITH {DOC_CHUNKS}, {_silver()}
SELECT (SELECT count(*) FROM chunks) AS chunk_count, (SELECT count(DISTINCT o_custkey) FROM silver) AS feature_count""",
    "forget_documents": f"""WITH {DOC_CHUNKS}, {FORGET}
{_forget_row('parsed', 'documents_v1')} UNION ALL {_forget_row('enriched', "documents_v1 WHERE trim(text) <> ''")}
UNION ALL {_forget_row('chunks', 'chunks')}""",
    # After the sync the log holds the deletions, with their ids alone.
    "forget_proof": f"""WITH {DOC_CHUNKS}, {FORGET}, gone AS (SELECT * FROM chunks SEMI JOIN forgotten USING (path)),
kept AS (SELECT * FROM chunks ANTI JOIN forgotten USING (path))
{_held('indexed', 'FROM chunks')} UNION ALL
{_held('synced', 'SELECT path, chunk_id, chunk_to_embed FROM chunks UNION ALL SELECT NULL, chunk_id, NULL FROM gone')} UNION ALL
{_held('purged', 'FROM kept')}""",
    "docs_classified": f"""WITH said AS (
  SELECT doc_id, lang, unnest(ts) AS term FROM (SELECT doc_id, lang, {_tokens("text")} AS ts FROM documents)),
counted AS (SELECT lang, term, count(DISTINCT doc_id) AS n FROM said WHERE lang IS NOT NULL GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
rules AS (SELECT c.term, lang AS label, 1000 * n // total AS weight
          FROM counted c JOIN (SELECT lang, count(*) AS total FROM documents GROUP BY lang) USING (lang)),
sums AS (SELECT doc_id, label, sum(weight) AS s FROM said JOIN rules USING (term) GROUP BY ALL),
best AS (SELECT doc_id, label FROM sums QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, label) = 1)
SELECT 'documents/' || doc_id AS path, lang, label AS doc_type FROM documents LEFT JOIN best USING (doc_id)""",
    "forget_search": f"""WITH {DOC_CHUNKS.replace("chunks AS (", "all_chunks AS (")}, {FORGET},
chunks AS (SELECT * FROM all_chunks WHERE path NOT IN (SELECT path FROM forgotten)), {TERMS}, {BM25}
SELECT query_id, chunk_id, path, rank FROM bm_rank JOIN tok USING (chunk_id) WHERE rank <= 5""",
}
ORACLES["features_lookup_function"] = ORACLES["features_lookup_json"]
ORACLES["element_walk_deep"] = ORACLES["element_walk"]
ORACLES["doc_chunks_stream"] = ORACLES["doc_chunks"]
