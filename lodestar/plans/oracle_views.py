"""DuckDB twins of the fixture views, used as CTEs by the oracle SQL.

Written independently of the Spark code in ``lodestar.sources.fixtures`` so the
oracle checks the derivation as well as the operators. Output columns are flat.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-07-15 12:00:00'"

VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], body: str) -> None:
    VIEWS[name] = (deps, body)


view("listings", [], """
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS property_id, p_partkey,
         p_name AS title, p_brand AS city, p_type AS ward,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS rent,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST((p_partkey % 7) * 1000 AS BIGINT) END AS management_fee,
         CASE p_partkey % 4 WHEN 0 THEN '1K' WHEN 1 THEN '1LDK' WHEN 2 THEN '2LDK' ELSE '3LDK' END AS layout,
         CAST(p_size AS DOUBLE) * 2.5 AS area_m2,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_partkey % 60 - 3 AS BIGINT) END AS age_years,
         CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) - 2 END AS walk_min,
         CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS pet_ok,
         TIMESTAMP '2001-01-01 00:00:00' AS created_at, TIMESTAMP '2001-01-01 00:00:00' AS updated_at
  FROM part""")

view("properties", ["listings"], """
  SELECT l.property_id, l.title, d.text AS description, l.city, l.ward, l.rent, l.management_fee,
         l.layout, l.area_m2, l.age_years, l.walk_min, l.pet_ok, l.created_at, l.updated_at
  FROM listings l LEFT JOIN documents d ON d.doc_id = l.p_partkey""")

view("pairs", [], """
  SELECT l.l_orderkey, l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, o.o_custkey, o.o_orderdate, o.o_totalprice, o.o_orderpriority
  FROM (SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice,
               l_discount + CAST(0 AS DOUBLE) AS l_discount, l_tax + CAST(0 AS DOUBLE) AS l_tax,
               l_returnflag, l_linestatus,
               row_number() OVER (PARTITION BY l_orderkey, l_partkey
                                  ORDER BY l_linenumber, l_extendedprice, l_suppkey, l_quantity,
                                           l_discount + CAST(0 AS DOUBLE), l_tax + CAST(0 AS DOUBLE),
                                           l_shipdate, l_returnflag, l_linestatus) AS rn
        FROM lineitem) l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE l.rn = 1""")

view("rl_ranked", ["pairs"], """
  SELECT p.*,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey) AS lexical_rank,
         CASE WHEN l_quantity <= 45
              THEN row_number() OVER (PARTITION BY l_orderkey, l_quantity <= 45 ORDER BY l_discount, l_partkey)
              ELSE 10000 END AS semantic_rank
  FROM pairs p""")

view("rl_rrf", ["rl_ranked"], """
  SELECT r.*,
         row_number() OVER (PARTITION BY l_orderkey
            ORDER BY CAST(1 AS DOUBLE) / (60 + lexical_rank)
                     + CASE WHEN semantic_rank < 10000 THEN CAST(1 AS DOUBLE) / (60 + semantic_rank) ELSE CAST(0 AS DOUBLE) END DESC,
                     lexical_rank, semantic_rank) AS rrf_rank
  FROM rl_ranked r""")

view("ranking_log", ["rl_rrf", "listings"], """
  SELECT 'R' || CAST(r.l_orderkey AS VARCHAR) AS request_id, r.o_orderdate AS ts,
         'P' || CAST(r.l_partkey AS VARCHAR) AS property_id,
         CAST(CASE WHEN r.l_orderkey % 13 = 0 THEN 1 ELSE 2 END AS BIGINT) AS schema_version,
         CAST(r.lexical_rank AS BIGINT) AS lexical_rank, CAST(r.semantic_rank AS BIGINT) AS semantic_rank,
         CAST(r.rrf_rank AS BIGINT) AS rrf_rank,
         CAST(row_number() OVER (PARTITION BY r.l_orderkey ORDER BY r.l_tax DESC, r.rrf_rank) AS BIGINT) AS final_rank,
         r.l_tax AS score, 1 - 5 * r.l_discount AS me5_score,
         CAST(li.rent AS DOUBLE) AS f_rent, CAST(li.walk_min AS DOUBLE) AS f_walk_min,
         CAST(li.age_years AS DOUBLE) AS f_age_years, li.area_m2 AS f_area_m2,
         CASE WHEN r.l_partkey % 11 = 0 THEN NULL ELSE CAST(r.l_partkey % 50 AS DOUBLE) / 100 END AS f_ctr,
         CAST(r.l_partkey % 20 AS DOUBLE) / 200 AS f_fav_rate,
         CASE WHEN r.l_partkey % 9 = 0 THEN NULL ELSE CAST(r.l_partkey % 10 AS DOUBLE) / 500 END AS f_inquiry_rate,
         1 - 5 * r.l_discount AS f_me5_score,
         CAST(r.lexical_rank AS DOUBLE) AS f_lexical_rank, CAST(r.semantic_rank AS DOUBLE) AS f_semantic_rank,
         'models/ranker-v2' AS model_path
  FROM rl_rrf r LEFT JOIN listings li ON li.p_partkey = r.l_partkey""")

view("feedback_events", ["pairs"], """
  SELECT 'R' || CAST(l_orderkey AS VARCHAR) AS request_id, 'P' || CAST(l_partkey AS VARCHAR) AS property_id,
         'click' AS action, o_orderdate AS ts FROM pairs WHERE l_returnflag IN ('A', 'R')
  UNION ALL
  SELECT 'R' || CAST(l_orderkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR), 'favorite', o_orderdate
  FROM pairs WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'R' || CAST(l_orderkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR), 'inquiry', o_orderdate
  FROM pairs WHERE l_returnflag = 'R' AND l_linestatus = 'O'
  UNION ALL
  SELECT 'R' || CAST(l_orderkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR), 'view', o_orderdate
  FROM pairs WHERE l_returnflag = 'N' AND l_linestatus = 'F'""")

view("search_requests", [], """
  SELECT 'R' || CAST(o_orderkey AS VARCHAR) AS request_id, o_orderpriority AS query,
         CAST(20 AS BIGINT) AS top_k, o_totalprice / 1000 AS latency_ms, o_orderdate AS requested_at
  FROM orders""")

view("search_logs", ["ranking_log", "search_requests"], """
  SELECT r.request_id, min(r.ts) AS ts, q.query, q.top_k, q.latency_ms,
         list(r.property_id ORDER BY r.shown) AS result_property_ids,
         string_agg(r.property_id, ',' ORDER BY r.shown) AS result_ids,
         count(*) AS n_results
  FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY final_rank, rrf_rank) AS shown FROM ranking_log) r
  JOIN search_requests q ON q.request_id = r.request_id
  WHERE r.shown <= q.top_k
  GROUP BY r.request_id, q.query, q.top_k, q.latency_ms
  UNION ALL
  SELECT q.request_id, q.requested_at, q.query, q.top_k, q.latency_ms, [], '', 0
  FROM search_requests q WHERE q.request_id NOT IN (SELECT request_id FROM ranking_log)""")

view("training_runs", [], """
  SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS started_at,
         CASE WHEN o_orderkey % 500 = 0 THEN NULL ELSE o_orderdate + INTERVAL 2 HOUR END AS finished_at,
         'models/ranker-' || CAST(o_orderkey AS VARCHAR) AS model_path,
         CAST(o_orderkey % 500 AS BIGINT) AS best_iteration,
         CAST(0.5 AS DOUBLE) + CAST(o_orderkey % 400 AS DOUBLE) / 1000 AS ndcg_at_10,
         CAST(0.3 AS DOUBLE) + CAST(o_orderkey % 300 AS DOUBLE) / 1000 AS map,
         CAST(0.6 AS DOUBLE) + CAST(o_orderkey % 200 AS DOUBLE) / 1000 AS recall_at_20
  FROM orders""")

view("job_audit", [], """
  SELECT o_orderkey AS job_id, o_orderdate AS creation_time,
         'user' || CAST(o_custkey AS VARCHAR) || '@example.com' AS user_email,
         CAST(round(o_totalprice * 1000000) AS BIGINT) AS total_bytes_processed
  FROM orders""")

view("access_log", [], """
  SELECT 'E' || CAST(event_id AS VARCHAR) AS request_id, ts,
         CASE event_type WHEN 'view' THEN '/properties' WHEN 'click' THEN '/feedback'
              WHEN 'purchase' THEN '/feedback' WHEN 'signup' THEN '/healthz' ELSE '/search' END AS path,
         CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS BIGINT) AS status,
         value * 5 AS latency_ms,
         CASE WHEN event_type = 'error' AND user_id % 4 = 0 THEN 'CRITICAL' WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity,
         CAST(user_id AS VARCHAR) || ':' || event_type AS fingerprint, user_id, event_type
  FROM events""")

view("feedback_stream", [], """
  SELECT 'U' || CAST(user_id AS VARCHAR) AS request_id, 'P' || CAST(event_id % 1000 AS VARCHAR) AS property_id,
         CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'inquiry'
              WHEN 'signup' THEN 'favorite' ELSE event_type END AS action, ts, event_id
  FROM events""")

view("text_queries", [], """
  SELECT 'Q' || CAST(item_id AS VARCHAR) AS query_id, text AS query_text,
         CASE WHEN item_id % 2 = 0 THEN NULL ELSE CAST(95000 AS BIGINT) END AS max_rent,
         CASE WHEN item_id % 3 = 0 THEN '1LDK' ELSE NULL END AS layout,
         CASE WHEN item_id % 4 = 1 THEN CAST(40 AS BIGINT) ELSE NULL END AS max_walk_min,
         CASE WHEN item_id % 5 = 0 THEN TRUE ELSE NULL END AS pet_ok,
         CASE WHEN item_id % 7 = 0 THEN CAST(40 AS BIGINT) ELSE NULL END AS max_age,
         CAST(20 AS BIGINT) AS top_k
  FROM benchmark""")

view("query_vectors", [], """
  SELECT 'Q' || CAST(vec_id AS VARCHAR) AS query_id, CAST(embedding AS DOUBLE[]) AS query_vector
  FROM embeddings WHERE vec_id IN (SELECT item_id FROM benchmark)""")

view("property_embeddings", ["properties"], """
  SELECT 'P' || CAST(e.vec_id AS VARCHAR) AS property_id, CAST(e.embedding AS DOUBLE[]) AS embedding,
         CASE WHEN e.vec_id % 10 = 0 THEN sha256('stale' || CAST(e.vec_id AS VARCHAR))
              ELSE sha256('e5-base' || chr(31) || regexp_replace(
                     coalesce(p.title, '') || '。' || coalesce(p.description, ''), '^\\s+|\\s+$', '', 'g')) END AS text_hash,
         'e5-base' AS model_name, TIMESTAMP '2001-07-01 00:00:00' AS generated_at
  FROM embeddings e LEFT JOIN properties p ON p.property_id = 'P' || CAST(e.vec_id AS VARCHAR)""")


def with_views(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# ---- feature mart ---------------------------------------------------------------
view("fm_bounds", [], """
  SELECT CAST(TIMESTAMP '2001-07-15 12:00:00' + INTERVAL 9 HOUR AS DATE) AS event_date,
         CAST(CAST(TIMESTAMP '2001-07-15 12:00:00' + INTERVAL 9 HOUR AS DATE) - INTERVAL 28 DAY AS TIMESTAMP) AS window_start""")

view("fm_exploded", ["search_logs", "fm_bounds"], """
  SELECT request_id, unnest(result_property_ids) AS property_id
  FROM search_logs, fm_bounds
  WHERE ts >= window_start AND ts <= TIMESTAMP '2001-07-15 12:00:00'""")

view("fm_impressions", ["fm_exploded"], """
  SELECT property_id, count(*) AS impression_count FROM fm_exploded GROUP BY property_id""")

view("fm_actions", ["feedback_events", "fm_bounds"], """
  SELECT property_id, count_if(action = 'click') AS click_count, count_if(action = 'favorite') AS favorite_count,
         count_if(action = 'inquiry') AS inquiry_count
  FROM feedback_events, fm_bounds
  WHERE ts >= window_start AND ts <= TIMESTAMP '2001-07-15 12:00:00'
  GROUP BY property_id""")

view("cleaned", ["properties"], """
  SELECT property_id, title, description, city, ward, coalesce(rent, 0) AS rent,
         coalesce(management_fee, 0) AS management_fee, layout, CAST(area_m2 AS DOUBLE) AS area_m2,
         greatest(coalesce(age_years, 0), 0) AS age_years, greatest(coalesce(walk_min, 0), 0) AS walk_min,
         coalesce(pet_ok, FALSE) AS pet_ok, created_at, updated_at
  FROM properties WHERE property_id IS NOT NULL""")

_FM = """
  SELECT event_date, property_id, rent, walk_min, age_years, area_m2, ctr, fav_rate, inquiry_rate,
         0.4 * coalesce(ctr, 0) + 0.2 * coalesce(fav_rate, 0) + 0.2 * coalesce(inquiry_rate, 0) AS popularity_score,
         impression_count, click_count, favorite_count, inquiry_count
  FROM (
    SELECT b.event_date, c.property_id, c.rent, c.walk_min, c.age_years, c.area_m2,
           CASE WHEN i.impression_count = 0 THEN NULL ELSE CAST(a.click_count AS DOUBLE) / i.impression_count END AS ctr,
           CASE WHEN i.impression_count = 0 THEN NULL ELSE CAST(a.favorite_count AS DOUBLE) / i.impression_count END AS fav_rate,
           CASE WHEN i.impression_count = 0 THEN NULL ELSE CAST(a.inquiry_count AS DOUBLE) / i.impression_count END AS inquiry_rate,
           i.impression_count, a.click_count, a.favorite_count, a.inquiry_count
    FROM ({src}) c CROSS JOIN fm_bounds b
    LEFT JOIN fm_impressions i ON i.property_id = c.property_id
    LEFT JOIN fm_actions a ON a.property_id = c.property_id)"""

view("feature_mart", ["listings", "fm_bounds", "fm_impressions", "fm_actions"], _FM.format(src="""
      SELECT property_id, coalesce(rent, 0) AS rent, greatest(coalesce(walk_min, 0), 0) AS walk_min,
             greatest(coalesce(age_years, 0), 0) AS age_years, CAST(area_m2 AS DOUBLE) AS area_m2
      FROM listings WHERE property_id IS NOT NULL"""))

view("feature_mart_raw", ["listings", "fm_bounds", "fm_impressions", "fm_actions"], _FM.format(src="""
      SELECT property_id, rent, walk_min, age_years, CAST(area_m2 AS DOUBLE) AS area_m2 FROM listings"""))


# ---- retrieval ----------------------------------------------------------------------
D = "CAST({} AS DOUBLE)".format
_FACETS = """coalesce((q.max_rent IS NULL OR d.rent <= q.max_rent) AND (q.layout IS NULL OR d.layout = q.layout)
          AND (q.max_walk_min IS NULL OR d.walk_min <= q.max_walk_min) AND (q.pet_ok IS NULL OR d.pet_ok = q.pet_ok)
          AND (q.max_age IS NULL OR d.age_years <= q.max_age), FALSE)"""


def tokens(text: str) -> str:
    """The token list of a text expression: full-width forms folded, letters and digits, CJK bigrams."""
    wide, narrow = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)), "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''")
    folded = f"lower(translate({text}, '{wide}', '{narrow}'))"
    cjk = "'[\\p{Han}\\p{Hiragana}\\p{Katakana}ー]+'"
    words = f"regexp_extract_all(regexp_replace({folded}, {cjk}, ' ', 'g'), '[\\p{{L}}\\p{{N}}]+')"
    pairs = f"list_transform(regexp_extract_all({folded}, {cjk}), lambda r: CASE WHEN length(r) < 2 THEN [r] ELSE list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) END)"
    return f"list_concat({words}, flatten({pairs}))"


view("docs", ["cleaned"], """
  SELECT property_id, rent, layout, walk_min, pet_ok, age_years, area_m2,
         concat_ws(' ', title, description, layout) AS searchable_text FROM cleaned""")

view("doc_tokens", ["docs"], f"""
  SELECT property_id, {tokens('searchable_text')} AS tokens FROM docs""")

view("q_terms", ["text_queries"], f"""
  SELECT DISTINCT query_id, term FROM (
    SELECT query_id, unnest({tokens('query_text')}) AS term FROM text_queries)""")

view("bm25_tf", ["doc_tokens", "q_terms"], """
  SELECT property_id, dl, term, count(*) AS tf
  FROM (SELECT property_id, len(tokens) AS dl, unnest(tokens) AS term FROM doc_tokens)
  WHERE term IN (SELECT term FROM q_terms)
  GROUP BY property_id, dl, term""")

view("bm25_scores", ["bm25_tf", "doc_tokens", "q_terms"], f"""
  SELECT q.query_id, t.property_id,
         sum(ln({D(1)} + ({D('s.n')} - d.df + {D(0.5)}) / (d.df + {D(0.5)})) * t.tf * {D(2.2)}
             / (t.tf + {D(1.2)} * ({D(0.25)} + {D(0.75)} * t.dl / s.avgdl))) AS bm25
  FROM bm25_tf t
  JOIN (SELECT term, count(*) AS df FROM bm25_tf GROUP BY term) d ON d.term = t.term
  JOIN q_terms q ON q.term = t.term
  CROSS JOIN (SELECT count(*) AS n, avg(len(tokens)) AS avgdl FROM doc_tokens) s
  GROUP BY q.query_id, t.property_id""")

view("facet_pass", ["bm25_scores", "docs", "text_queries"], f"""
  SELECT s.query_id, s.property_id, s.bm25
  FROM bm25_scores s LEFT JOIN docs d ON d.property_id = s.property_id
  JOIN text_queries q ON q.query_id = s.query_id
  WHERE {_FACETS}""")

view("lexical", ["facet_pass"], """
  SELECT * FROM (
    SELECT query_id, property_id, bm25,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(bm25, 9) DESC, property_id) AS BIGINT) AS lexical_rank
    FROM facet_pass)
  WHERE lexical_rank <= 200""")

view("vec_dist", ["query_vectors"], """
  SELECT q.query_id, 'P' || CAST(e.vec_id AS VARCHAR) AS property_id,
         1 - list_dot_product(q.query_vector, CAST(e.embedding AS DOUBLE[]))
             / (sqrt(list_dot_product(q.query_vector, q.query_vector))
                * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))) AS cosine_distance
  FROM query_vectors q CROSS JOIN embeddings e""")

view("vec_top", ["vec_dist"], """
  SELECT query_id, property_id, cosine_distance FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine_distance, 9), property_id) AS r FROM vec_dist)
  WHERE r <= 200""")

view("semantic", ["vec_top", "docs", "text_queries"], f"""
  SELECT v.query_id, v.property_id, v.cosine_distance,
         CAST(row_number() OVER (PARTITION BY v.query_id ORDER BY round(v.cosine_distance, 9), v.property_id) AS BIGINT) AS semantic_rank,
         1 - v.cosine_distance AS me5_score
  FROM vec_top v LEFT JOIN docs d ON d.property_id = v.property_id
  JOIN text_queries q ON q.query_id = v.query_id
  WHERE {_FACETS}""")

view("merged", ["lexical", "semantic"], """
  SELECT coalesce(l.query_id, s.query_id) AS query_id, coalesce(l.property_id, s.property_id) AS property_id,
         l.lexical_rank, s.semantic_rank, s.me5_score
  FROM lexical l FULL OUTER JOIN semantic s ON l.query_id = s.query_id AND l.property_id = s.property_id""")

view("fused", ["merged", "text_queries"], """
  SELECT f.* FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, lexical_rank ASC NULLS LAST,
                                      semantic_rank ASC NULLS LAST) AS BIGINT) AS rrf_rank
    FROM (SELECT *, coalesce(CAST(1 AS DOUBLE) / (60 + lexical_rank), 0) + coalesce(CAST(1 AS DOUBLE) / (60 + semantic_rank), 0) AS rrf_score
          FROM merged)) f
  LEFT JOIN text_queries q ON q.query_id = f.query_id
  WHERE f.rrf_rank <= greatest(coalesce(q.top_k, 0), 100)""")

view("enriched", ["fused", "docs", "feature_mart"], """
  SELECT f.query_id, f.property_id, f.rrf_rank, f.rrf_score,
         CAST(coalesce(f.lexical_rank, 10000) AS BIGINT) AS lexical_rank,
         CAST(coalesce(f.semantic_rank, 10000) AS BIGINT) AS semantic_rank,
         coalesce(f.me5_score, 0) AS me5_score,
         d.rent, d.walk_min, d.age_years, d.area_m2, m.ctr, m.fav_rate, m.inquiry_rate
  FROM fused f LEFT JOIN docs d ON d.property_id = f.property_id
  LEFT JOIN (SELECT * FROM feature_mart WHERE event_date = (SELECT max(event_date) FROM feature_mart)) m
    ON m.property_id = f.property_id""")

view("scored", ["enriched"], f"""
  SELECT e.*, round(((({D(0)} + {D(0.5)} * coalesce(ctr, 0)) + {D(1.0)} * me5_score)
                 + {D(-0.001)} * {D('lexical_rank')}) + {D(-0.0005)} * {D('semantic_rank')}, 9) AS score
  FROM enriched e""")


# ---- embeddings ----------------------------------------------------------------------
view("text_hashes", ["properties"], """
  SELECT property_id, sha256('e5-base' || chr(31) || text) AS text_hash, text
  FROM (SELECT property_id, regexp_replace(coalesce(title, '') || '。' || coalesce(description, ''), '^\\s+|\\s+$', '', 'g') AS text
        FROM properties WHERE title IS NOT NULL)""")

view("changed", ["text_hashes", "property_embeddings"], """
  SELECT t.property_id, t.text_hash FROM text_hashes t
  LEFT JOIN property_embeddings e ON e.property_id = t.property_id
  WHERE e.text_hash IS DISTINCT FROM t.text_hash""")
