"""DuckDB oracle SQL for every registered query.

The fixture recipes and operators are restated in SQL over the driver views
(``pages``, ``documents``, ``embeddings`` …).  Where it helps, the SQL takes a
different route from the Spark plan (a recursive CTE for the packing fold and
the sitemap expansion, a plain nested-loop scoring for top-k) so that the two
engines check each other rather than one algorithm twice.
"""

from __future__ import annotations

import re

from webcorpus.functions import patterns as P
from webcorpus.functions import text as T
from webcorpus.functions.patterns import sql_str
from webcorpus.operators.packing import MAX_TOKENS, TARGET_TOKENS
from webcorpus.sources.fixtures import (AGENT, AS_OF, PREVIOUS_AS_OF, SITEMAP_MAX_URLS,
                                        ZERO_HASH)

NL = "chr(10)"


def tok(e: str) -> str:
    return T.token_count_sql(e)


def strip(e: str) -> str:
    return T.strip_sql(e)


def host(e: str) -> str:
    return T.authority_sql(e)


def hex_bucket(e: str, n: int) -> str:
    return f"(('0x' || substr(sha256({e}), 1, 8))::BIGINT % {n})"


def raw_key(ds: str, url: str) -> str:
    return f"({ds} || '/raw/' || substr(sha256({url}), 1, 16) || '.html')"


def state_key(ds: str, url: str) -> str:
    return f"({ds} || '#' || sha256({url}))"


def vector_id(ds: str, text: str) -> str:
    return f"substr(sha256({ds} || ':' || {text}), 1, 32)"


def xml_escape(e: str) -> str:
    return f"replace(replace(replace({e}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


# ------------------------------------------------------------------ fixtures
CTES: dict[str, str] = {}

CTES["web_pages"] = """
SELECT page_id, 'site' || CAST(page_id % 2 AS VARCHAR) AS dataset, url, html FROM pages"""

CTES["fetched_pages"] = """
SELECT *, CASE WHEN page_id % 10 = 0 THEN 'application/pdf'
               WHEN page_id % 10 = 1 THEN 'Text/HTML; charset=utf-8'
               ELSE 'text/html' END AS content_type
FROM web_pages"""

CTES["clean_pages"] = f"""
SELECT page_id, dataset, url, html,
       {T.clean_html_sql('html')} AS text,
       {T.html_title_sql('html')} AS title,
       {T.html_description_sql('html')} AS description
FROM web_pages"""

CTES["sdocs"] = f"""
SELECT doc_id, array_to_string(list_transform(string_split(text, {NL}), lambda l, i:
         CASE (i - 1) % 7 WHEN 1 THEN '# ' || l WHEN 2 THEN '- ' || l WHEN 3 THEN '1. ' || l
              WHEN 4 THEN 'a) ' || l WHEN 5 THEN l || ' | ' WHEN 6 THEN {NL} || l ELSE l END),
       {NL}) AS text
FROM documents"""


def line_kinds_sql(src: str, key: str) -> str:
    """Every line of ``src(key, text)`` with ``pos, line, kind, section_no``."""
    s = strip("line")
    return f"""
(WITH lines AS (
   SELECT {key}, unnest(generate_series(0, len(parts) - 1)) AS pos, unnest(parts) AS line
   FROM (SELECT {key}, string_split(text, {NL}) AS parts FROM {src})),
 k1 AS (
   SELECT *, CASE
       WHEN pos > 0 AND (starts_with({s}, '#')
            OR coalesce(regexp_matches(nxt, {sql_str(P.UNDERLINE_EQ)}), false)
            OR coalesce(regexp_matches(nxt, {sql_str(P.UNDERLINE_DASH)}), false)) THEN 'H'
       WHEN regexp_matches({s}, {sql_str(P.LIST_ITEM)}) THEN 'L'
       WHEN contains({s}, '|') THEN 'T' ELSE 'N' END AS kind
   FROM (SELECT *, lead(line) OVER (PARTITION BY {key} ORDER BY pos) AS nxt FROM lines)),
 k2 AS (
   SELECT *, coalesce(last_value(CASE WHEN kind IN ('L', 'N') THEN kind = 'L' END IGNORE NULLS)
             OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             false) AS in_list
   FROM k1),
 k3 AS (
   SELECT *, CASE WHEN pos > 0 AND (kind = 'H' OR (kind = 'L' AND NOT in_list)
                  OR (kind = 'N' AND in_list)) THEN 1 ELSE 0 END AS nb FROM k2),
 k4 AS (
   SELECT *, sum(nb) OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
   FROM k3),
 k5 AS (
   SELECT *, last_value(CASE WHEN contains(line, '|') THEN c END IGNORE NULLS)
             OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cp
   FROM k4),
 k6 AS (
   SELECT *, CASE WHEN nb = 1 OR (pos > 0 AND kind = 'T' AND (cp IS NULL OR c - nb > cp))
                  THEN 1 ELSE 0 END AS st FROM k5),
 k7 AS (
   SELECT *, CAST(sum(st) OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS section_no
   FROM k6)
 SELECT {key}, pos, line, kind, section_no FROM k7)"""


def sections_sql(src: str, key: str) -> str:
    """Sections of ``src(key, text)`` by the window formulation."""
    return f"""
(SELECT {key}, section_no, string_agg(line, {NL} ORDER BY pos) AS text
 FROM {line_kinds_sql(src, key)} GROUP BY {key}, section_no
 HAVING {T.has_text_sql(f"string_agg(line, {NL} ORDER BY pos)")})"""


def chunks_sql(sections: str, key: str, target: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS) -> str:
    """Greedy packing of ``sections(key, section_no, text)`` as a recursive CTE."""
    ovf = f"(f.open AND f.tok + o.n > {max_tokens})"
    cls = f"(NOT o.is_para AND f.tok + o.n >= {target})"
    return f"""
(WITH RECURSIVE secs AS (SELECT *, {tok('text')} AS n FROM {sections}),
 items AS (
   SELECT {key}, section_no AS sec, 0 AS para, n, false AS is_para, text FROM secs WHERE n <= {max_tokens}
   UNION ALL
   SELECT {key}, sec, para, {tok('p')} AS n, true AS is_para, p AS text FROM (
     SELECT {key}, section_no AS sec, unnest(generate_series(0, len(ps) - 1)) AS para, unnest(ps) AS p
     FROM (SELECT {key}, section_no, {T.paragraphs_sql('text')} AS ps FROM secs WHERE n > {max_tokens}))),
 ordered AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY sec, para) AS k FROM items),
 fold AS (
   SELECT DISTINCT {key}, CAST(0 AS BIGINT) AS k, 0 AS c, CAST(0 AS BIGINT) AS tok, false AS open,
          CAST(NULL AS INTEGER) AS no FROM items
   UNION ALL
   SELECT o.{key}, o.k,
          CASE WHEN {ovf} OR {cls} THEN f.c + 1 ELSE f.c END,
          CASE WHEN {ovf} THEN o.n WHEN {cls} THEN 0 ELSE f.tok + o.n END,
          CASE WHEN {ovf} THEN true WHEN {cls} THEN false ELSE true END,
          CASE WHEN {ovf} THEN f.c + 1 ELSE f.c END
   FROM fold f JOIN ordered o ON o.{key} = f.{key} AND o.k = f.k + 1)
 SELECT {key}, CAST(no AS BIGINT) AS chunk_index,
        string_agg(text, {NL} || {NL} ORDER BY k) AS text,
        CAST(sum(n) AS BIGINT) AS n_tokens, count(*) AS n_items
 FROM fold JOIN ordered USING ({key}, k) GROUP BY {key}, no)"""


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` the named fixtures (and what they use) in front of ``body``."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for other in CTES:
            if other != name and re.search(rf"\b{other}\b", CTES[name]):
                need(other)
        order.append(name)

    for n in names:
        need(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body


# ------------------------------------------------------------------ step 2 fixtures
CTES["hosts_n"] = f"""
SELECT {host('url')} AS host, count(*) AS n,
       CAST(greatest(1, ceil(count(*) / {SITEMAP_MAX_URLS})) AS BIGINT) AS files
FROM web_pages GROUP BY 1"""

CTES["placed"] = f"""
SELECT p.dataset, p.url, h.host, {hex_bucket('p.url', 'h.files')} AS part
FROM web_pages p JOIN hosts_n h ON {host('p.url')} = h.host"""

CTES["url_seeds"] = """
SELECT dataset, 'urls' AS source_type, url AS source FROM web_pages
UNION ALL
SELECT dataset, 'url' AS source_type, url AS source FROM web_pages WHERE page_id % 5 = 0"""

CTES["base_urls"] = """
SELECT dataset, arg_min(url, page_id) AS base_url FROM web_pages GROUP BY dataset"""


def _robots_values() -> str:
    from webcorpus.sources.fixtures import ROBOTS_TEMPLATES

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, int):
            return str(v)
        return sql_str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in ROBOTS_TEMPLATES)


CTES["robots_rules"] = f"""
SELECT h.host, t.agent, t.seq, t.allow, t.path_prefix, t.outcome
FROM (SELECT DISTINCT {host('url')} AS host FROM web_pages) h
JOIN (VALUES {_robots_values()}) AS t(bucket, agent, seq, allow, path_prefix, outcome)
  ON {hex_bucket('h.host', 8)} = t.bucket"""

CTES["raw_store"] = f"""
SELECT page_id, dataset, url, html, {raw_key('dataset', 'url')} AS raw_key, sha256(html) AS raw_hash
FROM web_pages"""

CTES["raw_probe_keys"] = f"""
SELECT raw_key FROM raw_store
UNION ALL
SELECT {raw_key("'site' || CAST(1 - page_id % 2 AS VARCHAR)", 'url')} AS raw_key FROM web_pages"""


def robots_allowed_sql(urls: str, agent: str = AGENT) -> str:
    """``urls(dataset, url)`` + ``allowed`` by a correlated first-match lookup."""
    path = T.robots_path_sql("u.url")
    return f"""
(SELECT u.*, CASE WHEN o.outcome IS NULL OR o.outcome IN ('unreachable', 'denied') THEN false
                  WHEN o.outcome = 'missing' THEN true
                  ELSE coalesce((SELECT arg_min(r.allow, r.seq) FROM robots_rules r
                                 WHERE r.host = o.host AND r.path_prefix IS NOT NULL
                                   AND starts_with({path}, r.path_prefix)
                                   AND CASE WHEN o.has_own THEN lower(r.agent) = {sql_str(agent.lower())}
                                            ELSE r.agent = '*' END), true) END AS allowed
 FROM {urls} u
 LEFT JOIN (SELECT host, max(outcome) AS outcome,
                   coalesce(bool_or(lower(agent) = {sql_str(agent.lower())}), false) AS has_own
            FROM robots_rules GROUP BY host) o ON o.host = {host('u.url')})"""


# ------------------------------------------------------------------ step 3 fixtures
CTES["prev_crawl"] = f"""
SELECT {state_key('dataset', 'url')} AS key, dataset, url,
       CASE WHEN page_id % 3 = 0 THEN sha256(html) ELSE '{ZERO_HASH}' END AS raw_hash
FROM web_pages WHERE page_id % 3 <> 2"""

CTES["clean_keyed"] = f"""
SELECT page_id, dataset, url, {raw_key('dataset', 'url')} AS raw_key, sha256(text) AS text_hash
FROM clean_pages"""

CTES["process_state"] = f"""
SELECT {state_key('c.dataset', 'c.url')} AS key, c.dataset, c.url, sha256(c.url) AS url_hash,
       sha256(w.html) AS raw_hash,
       CASE WHEN c.page_id % 3 IN (0, 1) THEN c.text_hash END AS text_hash,
       c.raw_key, CASE WHEN c.page_id % 3 = 0 THEN 'processed' ELSE 'scraped' END AS status,
       TIMESTAMP '{PREVIOUS_AS_OF}' AS updated_at
FROM clean_keyed c JOIN web_pages w USING (page_id)"""

CTES["probe_outcomes"] = """
SELECT k.raw_key, split_part(k.raw_key, '/', 1) AS dataset, s.url,
       CASE WHEN r.html IS NULL OR s.key IS NULL THEN 'failed'
            WHEN s.status = 'processed' AND s.text_hash = c.text_hash THEN 'skipped'
            ELSE 'processed' END AS outcome,
       c.text_hash AS new_text_hash
FROM raw_probe_keys k
LEFT JOIN raw_store r USING (raw_key)
LEFT JOIN clean_keyed c USING (raw_key)
LEFT JOIN (SELECT dataset, raw_key, arg_min(key, key) AS key, arg_min(url, key) AS url,
                  arg_min(status, key) AS status, arg_min(text_hash, key) AS text_hash
           FROM process_state GROUP BY dataset, raw_key) s
  ON s.raw_key = k.raw_key AND s.dataset = split_part(k.raw_key, '/', 1)"""


# ------------------------------------------------------------------ step 4 fixtures
CTES["vectors"] = f"""
SELECT CASE WHEN e.vec_id % 2 = 0 THEN 'production' ELSE 'staging' END AS namespace,
       substr(sha256('d' || CAST(e.label % 3 AS VARCHAR) || ':' || CAST(e.vec_id AS VARCHAR)), 1, 32) AS id,
       e.vec_id, e.embedding, coalesce(d.text, '') AS text, 'd' || CAST(e.label % 3 AS VARCHAR) AS dataset,
       CASE WHEN e.vec_id % 17 = 0 THEN '' ELSE 'https://example.org/' || CAST(e.vec_id AS VARCHAR) END AS url,
       'Doc ' || CAST(e.vec_id AS VARCHAR) AS title, 0 AS chunk_index, d.lang,
       TIMESTAMP '{PREVIOUS_AS_OF}' AS updated_at
FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id"""

CTES["questions"] = """
SELECT vec_id AS qid, 'd' || CAST(label % 3 AS VARCHAR) AS dataset,
       'what about item ' || CAST(vec_id AS VARCHAR) || ' & more?' AS query, 5 AS top_k,
       'production' AS namespace, embedding
FROM embeddings"""

CTES["golden"] = """
SELECT vec_id AS qid, 'd' || CAST(label % 3 AS VARCHAR) AS dataset, 'golden ' || CAST(vec_id AS VARCHAR) AS query,
       CASE WHEN vec_id % 3 = 0 THEN [own, 'https://example.org/missing/' || CAST(vec_id AS VARCHAR)]
            ELSE [own] END AS expected_citations,
       CASE WHEN vec_id % 4 = 0 THEN 1.01 ELSE CAST(NULL AS DOUBLE) END AS min_score, embedding
FROM (SELECT *, CASE WHEN vec_id % 17 = 0 THEN '' ELSE 'https://example.org/' || CAST(vec_id AS VARCHAR) END AS own
      FROM embeddings)"""


def cosine(a: str, b: str) -> str:
    return (f"(list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) / "
            f"sqrt(list_dot_product(CAST({a} AS DOUBLE[]), CAST({a} AS DOUBLE[])) * "
            f"list_dot_product(CAST({b} AS DOUBLE[]), CAST({b} AS DOUBLE[]))))")


def topk_sql(queries: str, vectors: str, k: int = 5, cols: str = "v.url, v.title, v.text") -> str:
    """Every (query, vector) pair of the same namespace and dataset scored, then
    ranked — the brute-force form of the top-k search."""
    return f"""
(SELECT * FROM (
   SELECT q.qid, v.id, {cosine('q.embedding', 'v.embedding')} AS score, {cols},
          CAST(row_number() OVER (PARTITION BY q.qid ORDER BY {cosine('q.embedding', 'v.embedding')} DESC, v.id)
               AS INTEGER) AS rank,
          coalesce(q.top_k, {k}) AS _k
   FROM {queries} q JOIN {vectors} v ON v.namespace = q.namespace AND v.dataset = q.dataset)
 WHERE rank <= _k)"""


def hashed_embedding_rows(src: str, key: str, dim: int = 64) -> str:
    """``key, dim, value`` of the non-zero buckets of the hashed embedding."""
    return f"""
(WITH toks AS (SELECT {key}, unnest(regexp_extract_all(lower(text), {sql_str(P.TOKEN)})) AS t FROM {src}),
 cnt AS (SELECT {key}, {hex_bucket('t', dim)} AS dim, count(*) AS c FROM toks GROUP BY ALL),
 nrm AS (SELECT {key}, sqrt(sum(c * c)) AS n FROM cnt GROUP BY ALL)
 SELECT {key}, CAST(dim AS BIGINT) AS dim, c / n AS value FROM cnt JOIN nrm USING ({key}))"""


def n_set(embedding: str) -> str:
    """Entries of an embedding that are not 0."""
    return f"CAST(len(list_filter({embedding}, lambda x: x <> 0)) AS BIGINT)"


def n_buckets(text: str, dim: int = 64) -> str:
    """The same of a text's hashed embedding: its tokens' distinct buckets."""
    tokens = f"regexp_extract_all(lower({text}), {sql_str(P.TOKEN)})"
    return f"CAST(len(list_distinct(list_transform({tokens}, lambda t: {hex_bucket('t', dim)}))) AS BIGINT)"


# ------------------------------------------------------------------ step 5
def golden_checks_sql(golden: str, hits: str) -> str:
    """Checks of ``golden(qid, dataset, query, expected_citations, min_score)``
    against ``hits(qid, rank, score, url)``."""
    return f"""
(WITH h AS (SELECT qid, count(*) AS n, max(CASE WHEN rank = 1 THEN score END) AS top,
                   list_filter(list(coalesce(url, '') ORDER BY rank), lambda u: u <> '') AS found
            FROM {hits} GROUP BY qid),
 j AS (SELECT g.*, coalesce(h.n, 0) AS n, coalesce(h.top, 0.0) AS top,
              coalesce(h.found, []::VARCHAR[]) AS found,
              coalesce(g.expected_citations, []::VARCHAR[]) AS expected
       FROM {golden} g LEFT JOIN h USING (qid)),
 m AS (SELECT *, list_sort(list_distinct(list_filter(expected, lambda x: NOT list_contains(found, x)))) AS missing
       FROM j)
 SELECT qid, dataset, query, found AS citations_found, top AS top_score,
        list_filter([CASE WHEN n = 0 THEN {sql_str('No results found for query')}
                          WHEN top < coalesce(min_score, 0.7)
                          THEN printf('Top result score %.3f below minimum %s', top,
                                      CAST(coalesce(min_score, 0.7) AS VARCHAR)) END,
                     CASE WHEN len(expected) > 0 AND len(missing) > 0
                          THEN 'Missing expected citations: [' ||
                               array_to_string(list_transform(missing, lambda x: '''' || x || ''''), ', ')
                               || ']' END], lambda x: x IS NOT NULL) AS issues
 FROM m)"""


CTES["golden_hits"] = f"""
SELECT qid, rank, score, url FROM {topk_sql(
    "(SELECT qid, dataset, 'staging' AS namespace, 5 AS top_k, embedding FROM golden)", 'vectors', 5, 'v.url')}"""

CTES["checks"] = f"""
SELECT *, len(issues) = 0 AS passed FROM {golden_checks_sql('golden', 'golden_hits')}"""

CTES["page_vectors"] = f"""
SELECT 'staging' AS namespace, {vector_id('p.dataset', 'c.text')} AS id, p.dataset, p.url, c.chunk_index,
       TIMESTAMP '{AS_OF}' AS updated_at
FROM {chunks_sql(sections_sql('clean_pages', 'page_id'), 'page_id')} c JOIN clean_pages p USING (page_id)"""

CTES["report"] = f"""
SELECT d.dataset, coalesce(c.ok, true) AS passed,
       CASE WHEN c.ok IS NULL THEN {sql_str('No golden queries defined for dataset')} END AS warning,
       coalesce(c.total, 0) AS total_queries, coalesce(c.np, 0) AS passed_queries
FROM (SELECT dataset FROM vectors UNION SELECT dataset FROM page_vectors UNION SELECT dataset FROM checks) d
LEFT JOIN (SELECT dataset, bool_and(passed) AS ok, count(*) AS total, count(*) FILTER (WHERE passed) AS np
           FROM checks GROUP BY dataset) c USING (dataset)"""


# ------------------------------------------------------------------ step 6
def _facts(e: str, n: int) -> str:
    from webcorpus.functions.facts import facts_sql
    return facts_sql(e, n)


def _summary(e: str) -> str:
    from webcorpus.functions.facts import summary_sql
    return summary_sql(e)


CTES["q_hits"] = f"SELECT * FROM {topk_sql('questions', 'vectors', 5)}"

CTES["q_cards"] = f"""
SELECT qid, rank, coalesce(url, '') AS source, coalesce(title, '') AS title,
       unnest(generate_series(1, len(f))) AS fact_no, unnest(f) AS fact
FROM (SELECT qid, rank, url, title, {_facts('text', 3)} AS f FROM q_hits)"""

CTES["q_answers"] = f"""
SELECT q.qid, q.dataset, q.query, substr(sha256(q.query), 1, 16) AS query_hash,
       {_summary("coalesce(c.facts, []::VARCHAR[])")} AS summary,
       CAST(least(coalesce(len(c.facts), 0), 10) AS BIGINT) AS n_cards,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_citations,
       '/dataset/' || q.dataset || '/query?q=' || q.query AS handoff_url,
       '/dataset/' || q.dataset || '/query?q=' || q.query AS qr_url
FROM questions q
LEFT JOIN (SELECT qid, list(fact ORDER BY rank, fact_no) AS facts FROM q_cards GROUP BY qid) c USING (qid)
LEFT JOIN (SELECT qid, count(DISTINCT url) AS n FROM q_hits WHERE coalesce(url, '') <> '' GROUP BY qid) t
  USING (qid)"""


CTES["q_answer_struct"] = """
SELECT a.qid, a.dataset, a.query_hash, a.query, a.summary,
       coalesce(c.cards, []) AS fact_cards, coalesce(t.cites, []) AS citations, a.handoff_url, a.qr_url
FROM q_answers a
LEFT JOIN (SELECT qid, list({'fact': fact, 'source': source, 'title': title, 'type': 'statement'}
                            ORDER BY rank, fact_no)[1:10] AS cards
           FROM q_cards GROUP BY qid) c USING (qid)
LEFT JOIN (SELECT qid, list({'url': url, 'title': title} ORDER BY first_rank) AS cites
           FROM (SELECT qid, url, min(rank) AS first_rank, arg_min(coalesce(title, ''), rank) AS title
                 FROM q_hits WHERE coalesce(url, '') <> '' GROUP BY qid, url)
           GROUP BY qid) t USING (qid)"""
