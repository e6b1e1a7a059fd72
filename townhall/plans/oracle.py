"""The same questions in SQL for an independent engine, over the same tables.

The SQL says what the answer is; it shares no code with the Spark side.
"""

from __future__ import annotations

from townhall.operators.terms import ENGLISH_STOPWORDS, REPORT_STOPWORDS

ORACLE: dict[str, str] = {}

_POSTS = """
WITH responses AS (
  SELECT l_orderkey, count(*) AS n, max(l_shipdate) AS last_response,
         count(*) FILTER (l_returnflag = 'R') AS reactions, count(*) FILTER (l_linestatus = 'F') AS answers
  FROM lineitem GROUP BY l_orderkey),
posts AS (
  SELECT o_orderkey AS id,
         'Post ' || o_orderkey || ' by customer ' || o_custkey || ' with priority ' || o_orderpriority || ' on the community board' AS title,
         'Handled by clerk of customer ' || o_custkey || ' in status ' || o_orderstatus AS body,
         'Customer ' || o_custkey AS author, o_orderpriority AS channel,
         CASE o_orderstatus WHEN 'F' THEN 'Help / Question' WHEN 'O' THEN 'Share / Resource'
              WHEN 'P' THEN 'Live Session' END AS type_label,
         CAST(floor(o_totalprice) AS BIGINT) AS view_count, o_orderdate AS created_date,
         strftime(o_orderdate, '%Y-%m') AS month, last_response,
         coalesce(n, 0) AS response_count, coalesce(reactions, 0) AS reaction_count,
         coalesce(answers, 0) > 0 AS has_answer, o_custkey % 10 = 0 AS is_anonymous,
         date_diff('microsecond', o_orderdate, last_response) AS micros,
         date_diff('microsecond', o_orderdate, last_response) / 3600000000.0::DOUBLE AS hours,
         coalesce(n, 0) > 0 AS has_responses
  FROM orders LEFT JOIN responses ON l_orderkey = o_orderkey)
"""
_SHORT = "CASE WHEN length(title) > 55 THEN substr(title, 1, 55) || '…' ELSE title END"


def _on_posts(**queries: str) -> None:
    ORACLE.update({name: _POSTS + sql for name, sql in queries.items()})


_on_posts(
    kpi_overview="""
SELECT count(*) AS posts, CAST(sum(view_count) AS BIGINT) AS total_views, avg(view_count) AS mean_views,
       CAST(sum(response_count) AS BIGINT) AS total_responses, count(*) FILTER (has_answer) AS answered,
       count(DISTINCT author) AS authors,
       CAST(sum(micros) AS DOUBLE) / count(micros) / 3600000000.0::DOUBLE AS mean_response_hours,
       median(view_count) AS median_views
FROM posts""",
    kpi_text="""
SELECT format('{:,}', CAST(sum(view_count) AS BIGINT)) AS total_views, printf('%.0f', avg(view_count)) AS mean_views,
       printf('%.0f', median(view_count)) AS median_views,
       (count(*) FILTER (has_answer)) || ' / ' || count(*) AS answered,
       (count(*) FILTER (has_answer)) || '/' || count(*) AS answered_short,
       printf('%.1f', CAST(sum(micros) AS DOUBLE) / count(micros) / 3600000000.0::DOUBLE) || ' hours'
         AS mean_response_time
FROM posts""",
    kpi_support="""
SELECT posts, total_views, questions, responded, channels, response_rate, 100 - response_rate AS unanswered_rate,
       median_response_hours
FROM (SELECT count(*) AS posts, CAST(sum(view_count) AS BIGINT) AS total_views,
             count(*) FILTER (type_label = 'Help / Question') AS questions,
             count(*) FILTER (type_label = 'Help / Question' AND has_responses) AS responded,
             count(DISTINCT channel) AS channels,
             CAST(trunc((count(*) FILTER (type_label = 'Help / Question' AND has_responses))::DOUBLE
               / greatest(count(*) FILTER (type_label = 'Help / Question'), 1) * 100) AS INT) AS response_rate,
             coalesce(median(micros) FILTER (micros > 0) / 3600000000.0::DOUBLE, 0) AS median_response_hours
      FROM posts)""",
    response_lines="""
SELECT CAST(sum(micros) AS DOUBLE) / count(micros) / 3600000000.0::DOUBLE AS mean_hours,
       median(micros) / 3600000000.0::DOUBLE AS median_hours FROM posts""",
    response_lines_positive="""
SELECT CAST(sum(micros) AS DOUBLE) / count(micros) / 3600000000.0::DOUBLE AS mean_hours,
       median(micros) / 3600000000.0::DOUBLE AS median_hours FROM posts WHERE micros > 0""",
    anonymous_posts="SELECT count(*) FILTER (is_anonymous) AS anonymous FROM posts",
    top_posts="""
SELECT id, title, view_count, response_count FROM posts ORDER BY view_count DESC, id LIMIT 10""",
    top_posts_listing="""
SELECT id, CASE WHEN length(format('{:,}', view_count)) < 5 THEN lpad(format('{:,}', view_count), 5, ' ')
                ELSE format('{:,}', view_count) END || '  ' || substr(title, 1, 50) AS line
FROM posts ORDER BY view_count DESC, id LIMIT 10""",
    top_unanswered=f"""
SELECT id, {_SHORT} AS short_title, channel, view_count FROM posts
WHERE type_label = 'Help / Question' AND NOT has_responses ORDER BY view_count DESC, id LIMIT 10""",
    top_questions=f"""
SELECT id, {_SHORT} AS short_title, channel, view_count FROM posts
WHERE type_label = 'Help / Question' ORDER BY view_count DESC, id LIMIT 12""",
    top_shares=f"""
SELECT id, {_SHORT} AS short_title, reaction_count, view_count FROM posts
WHERE type_label = 'Share / Resource' ORDER BY reaction_count DESC, id LIMIT 5""",
    hardest_question="""
SELECT coalesce(max(title), '—') AS title, coalesce(max(view_count), 0) AS view_count
FROM (SELECT substr(title, 1, 55) AS title, view_count FROM posts
      WHERE type_label = 'Help / Question' AND NOT has_responses ORDER BY view_count DESC, id LIMIT 1)""",
    top_authors="""
SELECT author, posts, views, reactions, channels,
       CAST(row_number() OVER (ORDER BY posts DESC, author) AS INT) AS rank
FROM (SELECT author, count(id) AS posts, CAST(sum(view_count) AS BIGINT) AS views,
             CAST(sum(reaction_count) AS BIGINT) AS reactions, count(DISTINCT channel) AS channels
      FROM posts GROUP BY author ORDER BY posts DESC, author LIMIT 15)""",
    author_views_nested_topk="""
SELECT * FROM (
  SELECT author, count(id) AS posts, CAST(sum(view_count) AS BIGINT) AS views,
         CAST(sum(reaction_count) AS BIGINT) AS reactions, count(DISTINCT channel) AS channels
  FROM posts GROUP BY author ORDER BY posts DESC, author LIMIT 15)
ORDER BY views DESC, author LIMIT 12""",
    answered_by_channel="""
SELECT channel, count(id) AS questions, count(*) FILTER (NOT has_responses) AS unanswered,
       count(*) FILTER (has_responses) AS answered
FROM posts WHERE type_label = 'Help / Question' GROUP BY channel""",
    median_response_by_channel="""
SELECT channel, round_even(median(micros) / 3600000000.0::DOUBLE, 1) AS median_hours
FROM posts WHERE micros > 0 GROUP BY channel""",
    channel_summary="""
SELECT channel, posts, total_views, questions, unanswered, authors,
       CAST(round_even((questions - unanswered)::DOUBLE
         / CASE WHEN questions = 0 THEN 1 ELSE questions END * 100, 0) AS INT) || '%' AS response_rate,
       CAST(trunc(responded::DOUBLE / greatest(questions, 1) * 100) AS INT) AS question_response_rate
FROM (SELECT channel, count(id) AS posts, CAST(sum(view_count) AS BIGINT) AS total_views,
             count(*) FILTER (type_label = 'Help / Question') AS questions,
             count(*) FILTER (NOT has_responses) AS unanswered,
             count(*) FILTER (type_label = 'Help / Question' AND has_responses) AS responded,
             count(DISTINCT author) AS authors
      FROM posts GROUP BY channel)""",
    channel_sizes="SELECT channel, count(*) AS posts FROM posts GROUP BY channel",
    type_share="""
SELECT type_label, count(*) AS posts, count(*)::DOUBLE / (SELECT count(*) FROM posts) * 100 AS share
FROM posts GROUP BY type_label""",
    monthly_posts="SELECT month, count(*) AS posts FROM posts WHERE month IS NOT NULL GROUP BY month",
    monthly_by_type="SELECT month, type_label, count(*) AS posts FROM posts GROUP BY month, type_label",
    monthly_pivot="""
SELECT month, count(*) FILTER (type_label = 'Help / Question') AS questions,
       count(*) FILTER (type_label = 'Share / Resource') AS shares,
       count(*) FILTER (type_label = 'Live Session') AS live_sessions
FROM posts GROUP BY month""",
    author_activity="""
SELECT author, count(title) AS posts, CAST(sum(view_count) AS BIGINT) AS total_views,
       CAST(sum(response_count) AS BIGINT) AS total_responses
FROM posts GROUP BY author""",
    poster_frequency="""
SELECT count(*) AS authors, count(*) FILTER (n = 1) AS one_time, count(*) FILTER (n > 1) AS repeat
FROM (SELECT author, count(*) AS n FROM posts GROUP BY author)""",
    response_histogram="""
, r AS (SELECT min(hours) AS lo, max(hours) AS hi FROM posts),
e AS (SELECT lo, hi, (hi - lo) / 10 AS w FROM r),
b AS (SELECT (SELECT count(*) FROM range(1, 10) t(i) WHERE hours >= lo + i * w) + 1 AS bin
      FROM posts, e WHERE hours IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(i AS INT) AS bin, lo + (i - 1) * w AS left_edge,
       CASE WHEN i = 10 THEN hi ELSE lo + i * w END AS right_edge, coalesce(n, 0) AS n
FROM e, range(1, 11) t(i) LEFT JOIN c ON bin = i""",
    response_histogram_rounded="""
, r AS (SELECT min(hours) AS lo, max(hours) AS hi, (max(hours) - min(hours)) / 10 AS w FROM posts),
s AS (SELECT *, power(10.0::DOUBLE, floor(log10(w))) AS p FROM r),
e AS (SELECT lo, hi, p * CASE WHEN w / p <= 1 THEN 1 WHEN w / p <= 2 THEN 2 WHEN w / p <= 5 THEN 5 ELSE 10 END AS step
      FROM s),
c AS (SELECT floor(hours / step) AS k, count(*) AS n FROM posts, e WHERE hours IS NOT NULL GROUP BY 1)
SELECT i * step AS left_edge, (i + 1) * step AS right_edge, coalesce(n, 0) AS n
FROM e, range(CAST(floor(lo / step) AS BIGINT), CAST(floor(hi / step) AS BIGINT) + 1) t(i) LEFT JOIN c ON k = i""",
    views_vs_responses="""
SELECT id, response_count, view_count, reaction_count, substr(title, 1, 25) AS label FROM posts""",
    views_by_response_count="""
SELECT response_count, count(*) AS posts, avg(view_count) AS mean_views FROM posts GROUP BY response_count""",
    views_response_correlation="SELECT round(corr(response_count, view_count), 6) AS correlation FROM posts",
    filtered_dashboard="""
SELECT id, title, month, view_count, response_count FROM posts
WHERE channel = '1-URGENT' AND type_label = 'Help / Question'
  AND month IN ('1996-01', '1996-02', '1997-05', '1998-11')""",
    filter_options="""
SELECT DISTINCT 'channel' AS filter, channel AS option FROM posts
UNION ALL SELECT DISTINCT 'type_label', type_label FROM posts
UNION ALL SELECT DISTINCT 'month', month FROM posts""",
    month_options="SELECT DISTINCT month AS option FROM posts WHERE month IS NOT NULL",
    full_table="""
SELECT id, title, author, view_count, response_count, reaction_count, has_answer, channel, created_date
FROM posts""",
    typed_report="""
SELECT id, view_count, response_count, hours AS latest_response_hours, month, type_label,
       CASE WHEN length(title) > 50 THEN substr(title, 1, 50) || '…' ELSE title END AS short_title,
       has_responses, is_anonymous
FROM posts""",
    month_partitions="""
SELECT id, view_count, month FROM posts WHERE month IN ('1996-01', '1996-02', '1997-05', '1998-11')""",
)

_CHOSEN = """
, chosen AS (
  SELECT * FROM posts WHERE channel = '1-URGENT' AND type_label = 'Help / Question'
    AND month IN ('1996-01', '1996-02', '1997-05', '1998-11'))
"""
ORACLE["report_overview"] = ORACLE["kpi_overview"]
ORACLE["empty_histogram"] = """
SELECT count(DISTINCT channel) AS bins FROM (SELECT o_orderpriority AS channel FROM orders)
WHERE channel = 'no such channel'"""
for _name, _from in {
    "support_figures": "kpi_support", "channel_summary": "channel_summary", "top_questions": "top_questions",
    "answered_by_channel": "answered_by_channel", "median_response": "median_response_by_channel",
}.items():
    ORACLE[f"chosen_{_name}"] = _POSTS + _CHOSEN + ORACLE[_from].removeprefix(_POSTS).replace("FROM posts", "FROM chosen")
ORACLE["chosen_support_text"] = _POSTS + _CHOSEN + """
SELECT format('{:,}', count(*)) AS posts, format('{:,}', CAST(sum(view_count) AS BIGINT)) AS total_views,
       format('{:,}', count(*)) AS questions,
       CAST(trunc((count(*) FILTER (has_responses))::DOUBLE / greatest(count(*), 1) * 100) AS INT) || '%' AS response_rate,
       printf('%.0f', coalesce(median(micros) FILTER (micros > 0) / 3600000000.0::DOUBLE, 0)) || ' hrs'
         AS median_response_time,
       count(DISTINCT channel) || ' / ' || (SELECT count(DISTINCT channel) FROM posts) AS channels
FROM chosen"""
ORACLE["kept_report"] = _POSTS + """
SELECT channel, posts, questions, unanswered, answered
FROM (SELECT channel, count(*) AS posts FROM posts GROUP BY channel)
JOIN (SELECT channel, count(id) AS questions, count(*) FILTER (NOT has_responses) AS unanswered,
             count(*) FILTER (has_responses) AS answered
      FROM posts WHERE type_label = 'Help / Question' GROUP BY channel) USING (channel)"""

# -- typing ------------------------------------------------------------------

ORACLE["type_labels"] = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 11 = 0 THEN 'pollPost' WHEN o_orderstatus = 'F' THEN 'Help / Question'
            WHEN o_orderstatus = 'O' THEN 'Share / Resource' ELSE 'Live Session' END AS type_label
FROM orders"""
ORACLE["flags"] = """
SELECT o_orderkey AS id, o_orderkey % 10 <> 9 AND o_orderkey % 9 <= 4 AS flag,
       o_orderkey % 10 <> 9 AND o_orderkey % 9 IN (0, 1, 3, 4) AS spelled_out,
       CASE WHEN year(o_orderdate) >= 2000 THEN o_orderdate END AS real_date
FROM orders"""
ORACLE["coerce_numbers"] = """
SELECT o_orderkey AS id,
       CAST(CASE o_orderkey % 12 WHEN 0 THEN trunc(o_totalprice) WHEN 1 THEN trunc(o_totalprice)
            WHEN 2 THEN trunc(-o_totalprice) WHEN 3 THEN o_orderkey * 100 WHEN 4 THEN o_orderkey
            ELSE 0 END AS BIGINT) AS n
FROM orders"""
ORACLE["parse_dates"] = """
WITH p AS (
  SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 123 MILLISECOND
         WHEN 2 THEN o_orderdate - INTERVAL 2 HOUR WHEN 3 THEN date_trunc('day', o_orderdate)
         WHEN 7 THEN TIMESTAMP '1999-12-31 23:59:59' END AS t
  FROM orders)
SELECT o_orderkey AS id, CAST(t AS TIMESTAMP) AS parsed,
       CAST(CASE WHEN year(t) >= 2000 THEN t END AS TIMESTAMP) AS real, strftime(t, '%Y-%m') AS month
FROM p"""

# -- texts -------------------------------------------------------------------

_SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]+"


def _tidy(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '{_SPACE}', ' ', 'g'))"


def _decode(c: str) -> str:
    """The references that occur in the pages; & last, so nothing is decoded twice."""
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        c = f"replace({c}, '&{name};', '{char}')"
    return c


ORACLE["short_text"] = f"""
SELECT doc_id, CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '…' ELSE text END AS short,
       substr(text, 1, 25) AS label, rpad(substr(text, 1, 40), 44, ' ') AS padded,
       trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) <> '' AS filled,
       CAST(length(text || ' ' || coalesce(lang, '') || ' ') AS INT) AS joined_length
FROM documents"""
ORACLE["clean_html"] = f"SELECT page_id, {_tidy('html')} AS text FROM pages"
ORACLE["clean_html_full"] = f"SELECT page_id, {_tidy(_decode('html'))} AS text FROM pages"
ORACLE["strip_tags"] = "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages"

# -- links and channels ------------------------------------------------------

# the pages' anchors are all of one plain form, so they are cut out at fixed marks
_LINKS = f"""
WITH pieces AS (
  SELECT page_id, url AS page_url, unnest(string_split(html, '<a ')[2:]) AS piece,
         CAST(generate_subscripts(string_split(html, '<a ')[2:], 1) - 1 AS INT) AS pos
  FROM pages),
links AS (
  SELECT page_id, pos, {_decode("split_part(split_part(piece, 'href=\"', 2), '\"', 1)")} AS href,
         regexp_extract(page_url, '^[a-z]+://[^/?#]+') || split_part(split_part(piece, 'href="', 2), '"', 1) AS address,
         substr({_tidy(_decode("split_part(substr(piece, strpos(piece, '>') + 1), '</a>', 1)"))}, 1, 60) AS text
  FROM pieces),
slugged AS (
  SELECT *, 'https://community.example.org/channels' || href || '?tab=all' AS url,
         nullif(regexp_extract('https://community.example.org/channels' || href || '?tab=all',
                               '/channels/([^/?#\\s]+)', 1), '') AS slug
  FROM links),
dimension AS (
  SELECT slug, coalesce(nullif(trim(text), ''), slug) AS name, url AS href FROM slugged WHERE slug IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY slug ORDER BY page_id, pos) = 1)
"""
ORACLE["page_links"] = _LINKS + "SELECT * FROM links"
ORACLE["url_slugs"] = _LINKS + "SELECT page_id, pos, slug FROM slugged WHERE slug IS NOT NULL"
ORACLE["link_dimension"] = _LINKS + "SELECT * FROM dimension"
ORACLE["channel_dimension"] = _LINKS + """
, listed AS (
  SELECT lower(c_mktsegment) AS slug,
         arg_min(CASE WHEN c_custkey % 2 = 0 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:])
                      ELSE lower(c_mktsegment) END, c_custkey) AS name
  FROM customer GROUP BY 1
  UNION ALL SELECT 'de', 'never shown')
SELECT * FROM dimension
UNION ALL SELECT slug, name, '' FROM listed WHERE slug NOT IN (SELECT slug FROM dimension)"""
ORACLE["channel_urls"] = """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url
       ELSE 'https://community.example.org/p ' || page_id || '/all-content' END AS channel_url
FROM pages"""
ORACLE["short_link_texts"] = _LINKS + """
SELECT page_id, pos, text FROM links WHERE length(trim(text)) BETWEEN 1 AND 59"""

# -- payloads ----------------------------------------------------------------

_CAPTURES = """
WITH captures AS (
  SELECT o_orderkey AS capture_ord, o_orderpriority AS channel_name, o_orderkey % 6 AS shape,
         'https://community.example.org/' || CASE WHEN o_orderkey % 6 = 1 THEN 'search/data'
           ELSE 'views/mainLayout/data' END || '?channelSlugName=' || lower(substr(o_orderpriority, 1, 3)) AS head,
         (o_orderkey // 6) % 3 + 1 AS batch, o_custkey, o_orderstatus, o_orderdate,
         CAST(floor(o_totalprice) AS BIGINT) AS views
  FROM orders),
addressed AS (SELECT *, head || '&contentId=0&batchNumber=' || batch || '&tz=UTC' AS url FROM captures),
items AS (
  SELECT *, 0 AS pos, capture_ord AS id, views AS view_count FROM addressed
  UNION ALL SELECT *, 1, capture_ord // 2, views + 1 FROM addressed)
"""
_TYPE = "CASE o_orderstatus WHEN 'F' THEN 'helpQuestion' WHEN 'O' THEN 'sharePost' ELSE 'liveSession' END"
_EXTRACTED = _CAPTURES + f"""
, extracted AS (
  SELECT capture_ord, pos, id, 'Post &amp; ' || id AS title, 'Priority ' || channel_name AS body,
         'Customer ' || o_custkey AS author, {_TYPE} AS type,
         CASE WHEN capture_ord % 4 <> 0 THEN channel_name ELSE '' END AS channel,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_date, '' AS last_response, '' AS last_responder,
         view_count, capture_ord % 7 AS response_count, CAST(0 AS BIGINT) AS reply_count,
         CASE WHEN capture_ord % 3 <> 0 THEN capture_ord % 5 ELSE 0 END AS reaction_count,
         o_orderstatus = 'F' AS has_answer, false AS is_anonymous, false AS is_archived, o_orderdate
  FROM items WHERE shape IN (0, 5)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY capture_ord, pos) = 1)
"""
_CHANNEL_EXTRACTED = _CAPTURES + f"""
, extracted AS (
  SELECT id, channel_name AS channel, 'Post & ' || id AS title, 'Priority ' || channel_name AS body,
         'Customer ' || o_custkey AS author, {_TYPE} AS type,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_date, '' AS last_response, '' AS last_responder,
         view_count, capture_ord % 7 AS response_count, CAST(0 AS BIGINT) AS reply_count,
         CASE WHEN capture_ord % 3 <> 0 THEN capture_ord % 5 ELSE 0 END AS reaction_count,
         o_orderstatus = 'F' AS has_answer, false AS is_anonymous
  FROM items WHERE shape <> 4 AND id <> 0
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY channel_name, capture_ord, pos) = 1)
"""
_FIRST_PAGES = _CAPTURES + """
, firsts AS (
  SELECT channel_name, arg_min(head, capture_ord) || '&contentId=0&tz=UTC' AS url
  FROM addressed WHERE shape <> 1 AND batch = 1 GROUP BY channel_name)
"""
ORACLE["page_templates"] = _FIRST_PAGES + "SELECT * FROM firsts"
ORACLE["next_pages"] = _FIRST_PAGES + """
SELECT channel_name, CAST(b AS INT) AS batch, url || '&batchNumber=' || b AS url
FROM firsts JOIN (SELECT channel_name, max(batch) AS last FROM addressed WHERE shape <> 1 GROUP BY 1) USING (channel_name),
     LATERAL (SELECT unnest(range(2, last + 1)) AS b)"""
ORACLE["json_path"] = """
SELECT event_type, count(*) AS n, CAST(sum(CAST(props::JSON->>'$.k' AS BIGINT)) AS BIGINT) AS total
FROM events GROUP BY event_type"""
ORACLE["payload_keys"] = _CAPTURES + """
SELECT CASE shape WHEN 0 THEN 'enrichedContentResources' WHEN 1 THEN 'list' WHEN 2 THEN 'data,items'
       WHEN 3 THEN (SELECT string_agg('extra' || lpad(i::VARCHAR, 2, '0'), ',' ORDER BY i) FROM range(1, 13) t(i)) || ',page,total' WHEN 4 THEN 'str' ELSE 'enrichedContentResources,items' END AS keys, count(*) AS n
FROM addressed GROUP BY 1"""
ORACLE["content_types"] = _CAPTURES + """
SELECT CASE WHEN shape = 1 THEN 'application/javascript' ELSE 'application/json; charset=utf-8' END AS ct,
       count(*) AS n
FROM addressed WHERE shape <> 4 GROUP BY 1"""
ORACLE["list_discovery"] = _CAPTURES + """
SELECT capture_ord, url, CAST(pos AS INT) AS pos, id FROM items WHERE shape = 1"""
ORACLE["nested_list_discovery"] = _CAPTURES + """
SELECT capture_ord, channel_name, CAST(pos AS INT) AS pos, id FROM items WHERE shape <> 4 AND id <> 0"""
ORACLE["usable_ids"] = """
SELECT o_orderkey AS ord,
       CASE o_orderkey % 8 WHEN 1 THEN '0' WHEN 5 THEN 'k' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS id
FROM orders WHERE o_orderkey % 8 IN (1, 5, 7) AND o_orderkey % 16 <> 15"""
ORACLE["capture_counts"] = _CAPTURES + "SELECT url, count(*) AS n FROM items WHERE shape = 1 GROUP BY url"
ORACLE["capture_posts"] = _EXTRACTED + "SELECT * EXCLUDE (capture_ord, pos, o_orderdate) FROM extracted"
ORACLE["capture_preview"] = _EXTRACTED + """
SELECT capture_ord, CAST(pos AS INT) AS pos, type, substr(title, 1, 60) AS title, view_count, response_count
FROM extracted ORDER BY capture_ord, pos LIMIT 5"""
ORACLE["channel_posts"] = _CHANNEL_EXTRACTED + "SELECT * FROM extracted"
ORACLE["channel_post_counts"] = _CHANNEL_EXTRACTED + "SELECT channel, count(*) AS n FROM extracted GROUP BY channel"
ORACLE["channel_top_posts"] = _CHANNEL_EXTRACTED + """
SELECT id, channel, substr(title, 1, 55) AS title, view_count FROM extracted ORDER BY view_count DESC, id LIMIT 5"""
_FLAT = """
SELECT o_orderkey AS id, o_custkey AS order_owner_id, o_orderpriority AS order_owner_tier, o_orderstatus AS order_status,
       '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags
FROM orders"""
ORACLE["flatten_nested"] = _FLAT
ORACLE["flat_csv_round_trip"] = _FLAT
ORACLE["flatten_union"] = """
SELECT o_orderpriority AS _source, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS by_n, o_orderkey AS id,
       CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS status,
       CASE WHEN o_orderkey % 3 = 2 THEN '["' || o_orderstatus || '","' || o_orderpriority || '"]' END AS tags
FROM orders"""
ORACLE["flatten_union_csv"] = ORACLE["flatten_union"]
ORACLE["key_union"] = _CAPTURES + """
, found AS (
  SELECT json_object('id', id, 'title', 0, 'bodyHTML', 0, 'authorName', 0, 'conversationType', 0, 'channel', 0,
                     'createdDate', 0, 'viewCount', 0, 'responseCount', 0, 'reactionSummary', 0,
                     'hasModeratorOrEndorsedResponse', 0) AS item
  FROM items WHERE shape = 1)
SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(item)) AS key FROM found) GROUP BY key"""
ORACLE["load_counts"] = _CAPTURES + """
SELECT count(DISTINCT capture_ord) AS captured, count(DISTINCT capture_ord) FILTER (shape <> 4) AS with_list,
       count(*) FILTER (shape <> 4) AS exploded, count(*) FILTER (shape <> 4 AND id <> 0) AS guarded,
       CAST(0 AS BIGINT) AS rejected, count(DISTINCT id) FILTER (shape <> 4 AND id <> 0) AS projected
FROM items"""
ORACLE["capture_rejects"] = """
SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 8 = 5 OR o_orderkey % 8 IN (2, 4) AND o_orderkey % 16 <> 15
                               THEN 'id type' ELSE 'id' END AS problems
FROM orders WHERE o_orderkey % 16 = 15 OR o_orderkey % 8 IN (2, 3, 4, 5, 6)"""
ORACLE["batch_addresses"] = """
SELECT page_id, 'https://community.example.org/views/mainLayout/data?org=org&comm=comm&channelSlugName=c%20' || page_id
         || '&contentId=0&batchNumber=' || (page_id % 5 + 1) || '&preferredTimezone=America%2FDenver' AS address,
       CAST(page_id % 5 + 1 AS INT) AS batch
FROM pages"""

# -- identity ----------------------------------------------------------------

ORACLE["dedupe_first"] = """
SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"""
ORACLE["dedupe_across_channels"] = """
SELECT source, count(*) AS n
FROM (SELECT source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY source, doc_id) = 1)
GROUP BY source"""
ORACLE["incremental_new"] = """
SELECT doc_id, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents s WHERE s.source = 'src0' AND s.text = d.text)"""
ORACLE["accumulate"] = """
SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (
  PARTITION BY user_id ORDER BY CASE WHEN event_type = 'click' THEN 0 ELSE 1 END, event_id) = 1"""
ORACLE["conversation_posts"] = """
SELECT *, response_count > 0 AS has_responses,
       CASE WHEN length(title) > 55 THEN substr(title, 1, 55) || '…' ELSE title END AS short_title
FROM (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS title,
             count(*) FILTER (role = 'assistant') AS response_count, count(*) AS turns
      FROM conversations GROUP BY conv_id)"""

# -- terms -------------------------------------------------------------------

_WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_'']*"


def _listed(stopwords) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in stopwords) + ")"


def _fold(source: str, name: str) -> str:
    """Spellings to terms: plurals added to their singular, most frequent spelling shown."""
    return f"""
{name}_keys AS (SELECT DISTINCT key FROM {source}),
{name}_merged AS (
  SELECT s.key, coalesce(k.key, s.key) AS term_key,
         CASE WHEN k.key IS NULL THEN s.form ELSE s.form[:-2] END AS form, s.n
  FROM {source} s LEFT JOIN {name}_keys k
    ON s.key LIKE '%s' AND s.key NOT LIKE '%ss' AND k.key = s.key[:-2]),
{name}_spelled AS (SELECT term_key, form, sum(n) AS n FROM {name}_merged GROUP BY ALL),
{name} AS (
  SELECT term_key, first(form ORDER BY n DESC, form) AS term, CAST(sum(n) AS BIGINT) AS n
  FROM {name}_spelled GROUP BY term_key),
{name}_lookup AS (
  SELECT DISTINCT m.key, t.term, t.n FROM {name}_merged m JOIN {name} t USING (term_key))"""


def _vocabulary(stopwords, source: str = "documents") -> str:
    listed = _listed(stopwords)
    return f"""
WITH row_words AS MATERIALIZED (
  SELECT list_filter(
    list_transform(regexp_extract_all(text, '{_WORD}'),
                   lambda w: CASE WHEN lower(w) LIKE '%''s' THEN w[:-3] ELSE w END),
    lambda w: NOT regexp_full_match(w, '\\p{{Nd}}+')) AS w
  FROM {source}),
single_forms AS MATERIALIZED (
  SELECT lower(form) AS key, form, count(*) AS n FROM (SELECT unnest(w) AS form FROM row_words)
  WHERE lower(form) NOT IN {listed} GROUP BY ALL),
neighbours AS MATERIALIZED (SELECT unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM row_words),
pair_forms AS MATERIALIZED (
  SELECT lower(a || ' ' || b) AS key, a || ' ' || b AS form, count(*) AS n FROM neighbours
  WHERE lower(a) NOT IN {listed} AND lower(b) NOT IN {listed} GROUP BY ALL),
{_fold('single_forms', 'single')},
{_fold('pair_forms', 'pair')},
total AS MATERIALIZED (SELECT CAST(sum(n) AS DOUBLE) AS t FROM single),
counted AS MATERIALIZED (
  SELECT p.term AS bigram, p.n AS n_bigram, a.term AS term_1, a.n AS n_1, b.term AS term_2, b.n AS n_2, t,
         b.n / t AS p, p.n / a.n AS p1, (b.n - p.n) / (t - a.n) AS p2
  FROM pair p JOIN single_lookup a ON a.key = split_part(p.term_key, ' ', 1)
  JOIN single_lookup b ON b.key = split_part(p.term_key, ' ', 2), total),
scored AS MATERIALIZED (
  SELECT *, CASE WHEN t <= n_1 OR t <= n_2 THEN 0 ELSE -2 * (
      ln(greatest(p, 1e-10)) * n_bigram + ln(greatest(1 - p, 1e-10)) * (n_1 - n_bigram)
    + ln(greatest(p, 1e-10)) * (n_2 - n_bigram) + ln(greatest(1 - p, 1e-10)) * (t - n_1 - (n_2 - n_bigram))
    - ln(greatest(p1, 1e-10)) * n_bigram - ln(greatest(1 - p1, 1e-10)) * (n_1 - n_bigram)
    - ln(greatest(p2, 1e-10)) * (n_2 - n_bigram) - ln(greatest(1 - p2, 1e-10)) * (t - n_1 - (n_2 - n_bigram))
    ) END AS score
  FROM counted),
kept AS MATERIALIZED (SELECT * FROM scored WHERE score > 30),
cloud AS (
  SELECT term, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT term, n FROM single
    UNION ALL SELECT term_1, -n_bigram FROM kept
    UNION ALL SELECT term_2, -n_bigram FROM kept
    UNION ALL SELECT bigram, n_bigram FROM kept)
  GROUP BY term HAVING sum(n) > 0)
"""


ORACLE["term_counts"] = _vocabulary(ENGLISH_STOPWORDS) + "SELECT term, n FROM single"
ORACLE["bigram_counts"] = _vocabulary(REPORT_STOPWORDS) + "SELECT term, n FROM pair"
ORACLE["collocations"] = _vocabulary(REPORT_STOPWORDS) + """
SELECT bigram, n_bigram, n_1, n_2, round(score, 4) AS score FROM kept"""
ORACLE["pruned_collocations"] = ORACLE["collocations"]
ORACLE["top_terms"] = _vocabulary(REPORT_STOPWORDS) + """
SELECT term, n, n / max(n) OVER () AS frequency FROM (SELECT * FROM cloud ORDER BY n DESC, term LIMIT 80)"""
ORACLE["top_terms_overview"] = _vocabulary(ENGLISH_STOPWORDS) + """
SELECT term, n, n / max(n) OVER () AS frequency FROM (SELECT * FROM cloud ORDER BY n DESC, term LIMIT 60)"""

_ASKED = "(" + _POSTS + """
SELECT title || ' ' || body AS text FROM posts WHERE type_label = 'Help / Question')"""
ORACLE["question_terms"] = _vocabulary(REPORT_STOPWORDS, _ASKED) + "SELECT term, n FROM single"
_ASKED_CHOSEN = "(" + _POSTS + _CHOSEN + "SELECT title || ' ' || body AS text FROM chosen)"
ORACLE["chosen_terms"] = _vocabulary(REPORT_STOPWORDS, _ASKED_CHOSEN) + """
SELECT term, n, n / max(n) OVER () AS frequency FROM (SELECT * FROM cloud ORDER BY n DESC, term LIMIT 80)"""

# -- sets of ids, the cube, sketches -----------------------------------------

ORACLE["bitmap_new_posts"] = """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))"""
ORACLE["bitmap_load"] = """
SELECT id, part FROM (
  SELECT l_orderkey AS id, l_linenumber % 3 AS part, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber % 3, l_linenumber) AS nth
  FROM lineitem WHERE l_returnflag <> 'R') WHERE nth = 1"""
ORACLE["stored_loads"] = """
SELECT doc_id, CAST(doc_id % 3 AS INT) AS part FROM documents
QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id % 3, doc_id) = 1"""
ORACLE["stored_lookup"] = """
SELECT o_orderkey AS id, any_value(o_orderstatus) AS status, count(l_orderkey) AS responses, max(l_shipdate) AS latest
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
ORACLE["bitmap_members"] = """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y') AS year, o_custkey FROM orders)
SELECT month AS period, count(DISTINCT o_custkey) AS members FROM m GROUP BY month
UNION ALL SELECT year, count(DISTINCT o_custkey) FROM m GROUP BY year
UNION ALL SELECT 'all', count(DISTINCT o_custkey) FROM m"""
_MONTHS = "month IN ('1996-01', '1996-02', '1997-05', '1998-11')"
_on_posts(
    cube_choices="""
, offered AS (
  SELECT 'All' AS c, 'All' AS t UNION ALL SELECT DISTINCT channel, 'All' FROM posts
  UNION ALL SELECT DISTINCT 'All', type_label FROM posts UNION ALL SELECT DISTINCT channel, type_label FROM posts),
each AS (
  SELECT c, t, author, count(*) AS n, sum(view_count) AS views, count(*) FILTER (type_label = 'Help / Question') AS asked,
         count(*) FILTER (type_label = 'Help / Question' AND has_responses) AS responded,
         count(*) FILTER (NOT has_responses) AS unanswered
  FROM offered JOIN posts ON (c = 'All' OR c = channel) AND (t = 'All' OR t = type_label) GROUP BY ALL)
SELECT c AS channel, t AS type_label, CAST(sum(n) AS BIGINT) AS posts, CAST(sum(views) AS BIGINT) AS total_views,
       CAST(sum(asked) AS BIGINT) AS questions, CAST(sum(responded) AS BIGINT) AS responded,
       CAST(sum(unanswered) AS BIGINT) AS unanswered, count(author) AS authors,
       count(*) FILTER (n = 1) AS one_time, count(*) FILTER (n > 1) AS repeat
FROM each GROUP BY ALL""",
    sketched_members="""
SELECT channel, count(DISTINCT author) AS authors, true AS agrees FROM posts GROUP BY channel
UNION ALL SELECT 'All', count(DISTINCT author), true FROM posts""",
    cube_channel_summary=ORACLE["channel_summary"].removeprefix(_POSTS).replace("FROM posts", "FROM posts WHERE " + _MONTHS),
    cube_poster_frequency=_CHOSEN + ORACLE["poster_frequency"].removeprefix(_POSTS).replace("FROM posts", "FROM chosen"),
    cube_support_figures=_CHOSEN + "SELECT * EXCLUDE (median_response_hours) FROM ("
    + ORACLE["kpi_support"].removeprefix(_POSTS).replace("FROM posts", "FROM chosen") + ")",
)
ORACLE["cube_answered_by_channel"] = ORACLE["answered_by_channel"]
ORACLE["bracketed_median_by_channel"] = ORACLE["median_response_by_channel"]

# -- sinks -------------------------------------------------------------------

ORACLE["csv_round_trip"] = """
SELECT doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source, nullif(text, '') AS text FROM documents"""
ORACLE["json_round_trip"] = _EXTRACTED + """
SELECT id, title, channel, view_count, reaction_count, strftime(o_orderdate, '%Y-%m') AS month, has_answer
FROM extracted"""
ORACLE["raw_round_trip"] = _CAPTURES + """
SELECT channel_name, capture_ord, CAST(pos AS INT) AS pos, id,
       CASE WHEN capture_ord % 4 <> 0 THEN channel_name END AS channel
FROM items WHERE shape <> 4 AND id <> 0"""

ORACLE["variant_round_trip"] = _CAPTURES + """
SELECT channel_name, capture_ord, CAST(pos AS INT) AS pos, id,
       CASE WHEN capture_ord % 4 <> 0 THEN channel_name END AS channel
FROM items WHERE shape <> 4 AND id <> 0"""
ORACLE["damaged_captures"] = _CAPTURES + """
SELECT 'items' AS what, count(*) AS n FROM items WHERE shape <> 4 AND id <> 0 AND capture_ord % 5 <> 0
UNION ALL SELECT CASE WHEN capture_ord % 5 = 0 THEN 'damaged' ELSE 'captures' END, count(*)
FROM addressed WHERE shape <> 4 GROUP BY 1"""
ORACLE["json_array_round_trip"] = ORACLE["json_round_trip"]
ORACLE["lines_csv"] = """
SELECT doc_id AS id, nullif(source, '') AS channel, nullif(text, '') AS title FROM documents"""

ORACLE["channel_csv"] = _CHANNEL_EXTRACTED + """
SELECT id, channel, title, author,
       CASE type WHEN 'helpQuestion' THEN 'Help / Question' WHEN 'sharePost' THEN 'Share / Resource'
            ELSE 'Live Session' END AS type_label,
       created_date[:7] AS month, view_count, response_count, response_count > 0 AS has_responses,
       '' AS last_responder, title AS short_title, false AS is_anonymous
FROM extracted"""
ORACLE["capture_files"] = _CAPTURES + """
SELECT url, count(*) AS n FROM items WHERE shape <> 4 AND id <> 0 GROUP BY url"""

ORACLE["capture_array_files"] = ORACLE["capture_files"]

# -- streams (each against the batch answer) ---------------------------------

ORACLE["stream_ingest"] = _CAPTURES + """
SELECT id, 'Post &amp; ' || id AS title, CASE WHEN capture_ord % 4 <> 0 THEN channel_name ELSE '' END AS channel,
       view_count, CASE WHEN capture_ord % 3 <> 0 THEN capture_ord % 5 ELSE 0 END AS reaction_count
FROM items WHERE shape IN (0, 5)"""
ORACLE["stream_dedupe"] = "SELECT event_id, user_id, event_type, value FROM events"
ORACLE["stream_first_copies"] = """
SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type,
       arg_min(value, event_id) AS value
FROM events GROUP BY user_id"""
ORACLE["stream_late_rows"] = """
WITH m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 DAY AS mark FROM events WHERE event_id % 2 = 0),
e AS (SELECT event_type, event_id % 2 = 1 AND date_trunc('day', ts) + INTERVAL 1 DAY <= mark AS late FROM events, m)
SELECT event_type, count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late FROM e GROUP BY event_type"""
ORACLE["stream_corrections"] = """
SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type,
       CAST(coalesce(min(event_id) FILTER (event_id % 3 = 1) < min(event_id) FILTER (event_id % 3 = 2), false) AS BIGINT)
       + CAST(coalesce(min(event_id) FILTER (event_id % 3 = 0) < min(event_id) FILTER (event_id % 3 > 0), false) AS BIGINT)
         AS corrections
FROM events GROUP BY user_id"""
ORACLE["stream_new_posts"] = """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1"""
ORACLE["stream_stored_posts"] = ORACLE["stream_new_posts"]
ORACLE["stream_windows"] = """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events
GROUP BY ALL"""
ORACLE["stream_months"] = """
SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start, event_type, count(*) AS n FROM events GROUP BY ALL"""
ORACLE["stream_kpis"] = """
SELECT event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total,
       round(avg(CAST(round(value * 100) AS BIGINT)), 6) AS mean, count(*) FILTER (value > 50) AS answered,
       true AS members_near, true AS median_near
FROM events GROUP BY event_type"""
ORACLE["stream_top_posts"] = """
SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 10"""
