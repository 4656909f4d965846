"""DuckDB text of the canonical inputs, used only by the oracle queries.

Written independently of the Spark code (windows and joins where Spark uses
aggregations and scalar subqueries), so a match is a real cross-check.
"""

INTERACTIONS = """
inter AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(ceil(l.l_quantity / 10.0) AS DOUBLE) AS rating,
         CASE l.l_returnflag WHEN 'N' THEN 'purchase' WHEN 'A' THEN 'view'
              WHEN 'R' THEN 'rating' ELSE 'other' END AS interaction_type,
         CAST(epoch(o.o_orderdate) AS DOUBLE) AS "timestamp",
         'session_' || CAST(l.l_orderkey AS VARCHAR) AS session_id,
         l.l_orderkey, l.l_linenumber, l.l_suppkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

DEDUP = """
dedup AS (
  SELECT user_id, item_id, "timestamp", l_orderkey, l_linenumber, l_suppkey,
         rating, interaction_type, session_id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
              ORDER BY "timestamp" DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
                       rating DESC, interaction_type DESC, session_id DESC) AS rn
        FROM inter) WHERE rn = 1)"""

SPLIT = """
train AS (SELECT * FROM dedup WHERE "timestamp" < 946684800.0),
test AS (SELECT * FROM dedup WHERE "timestamp" >= 946684800.0),
truth AS (SELECT user_id, item_id FROM test WHERE rating >= 4.0)"""

RECS = """
item_cnt AS (SELECT item_id, count(*) AS cnt FROM train GROUP BY item_id),
pool AS (SELECT item_id, cnt, row_number() OVER (ORDER BY cnt DESC, item_id) AS prank
         FROM item_cnt),
seen AS (SELECT DISTINCT user_id, item_id FROM train),
cand AS (SELECT u.user_id, p.item_id, p.cnt, p.prank
         FROM (SELECT DISTINCT user_id FROM truth) u CROSS JOIN pool p
         WHERE NOT EXISTS (SELECT 1 FROM seen s
                           WHERE s.user_id = u.user_id AND s.item_id = p.item_id)),
recs AS (SELECT user_id, item_id, CAST(cnt AS DOUBLE) AS score,
                CAST(row_number() OVER (PARTITION BY user_id ORDER BY prank) AS INTEGER) AS rank
         FROM cand QUALIFY rank <= 20),
popularity AS (SELECT item_id, cnt, CAST(cnt AS DOUBLE) / max(cnt) OVER () AS popularity
               FROM item_cnt)"""

SCORED = """
mu AS (SELECT avg(rating) AS mu FROM train),
ub AS (SELECT user_id, avg(rating) AS um FROM train GROUP BY user_id),
ib AS (SELECT item_id, avg(rating) AS im FROM train GROUP BY item_id),
scored AS (
  SELECT t.user_id, t.item_id, t.rating,
         greatest(1.0::DOUBLE, least(5.0::DOUBLE,
           mu.mu + coalesce(ub.um - mu.mu, 0.0) + coalesce(ib.im - mu.mu, 0.0))) AS pred
  FROM test t CROSS JOIN mu LEFT JOIN ub ON t.user_id = ub.user_id
       LEFT JOIN ib ON t.item_id = ib.item_id)"""

HITS = """
hits AS (
  SELECT r.user_id, r.item_id, r.rank,
         CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END AS hit
  FROM recs r LEFT JOIN truth t ON r.user_id = t.user_id AND r.item_id = t.item_id),
tsize AS (SELECT user_id, count(*) AS n_truth, count(DISTINCT item_id) AS n_truth_distinct
          FROM truth GROUP BY user_id),
hits_c AS (
  SELECT *, sum(CASE WHEN rank <= 10 THEN hit ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY rank
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_hits,
            row_number() OVER (PARTITION BY user_id ORDER BY
                               CASE WHEN rank <= 10 THEN hit ELSE 0 END DESC, rank) AS ipos
  FROM hits),
per_user AS (
  SELECT h.user_id,
    CASE WHEN sum(CASE WHEN rank <= 10 AND hit = 1 THEN 1.0 / log2(ipos + 1) ELSE 0 END) > 0
         THEN sum(CASE WHEN rank <= 10 THEN hit / log2(rank + 1) ELSE 0 END)
              / sum(CASE WHEN rank <= 10 AND hit = 1 THEN 1.0 / log2(ipos + 1) ELSE 0 END)
         ELSE 0.0 END AS ndcg,
    sum(CASE WHEN rank <= 10 AND hit = 1 THEN cum_hits / rank ELSE 0 END)
      / least(max(s.n_truth), 10) AS ap,
    CAST(max(CASE WHEN rank <= 20 THEN hit ELSE 0 END) AS DOUBLE) AS hit,
    sum(CASE WHEN rank <= 10 THEN hit ELSE 0 END) / 10.0 AS precision,
    CASE WHEN max(s.n_truth_distinct) > 0 THEN
      count(DISTINCT CASE WHEN rank <= 10 AND hit = 1 THEN h.item_id END)
        / max(s.n_truth_distinct) ELSE 0.0 END AS recall
  FROM hits_c h JOIN tsize s ON h.user_id = s.user_id
  GROUP BY h.user_id)"""

INTERACTIONS_ONLY = "WITH " + INTERACTIONS
BASE = "WITH " + ",".join([INTERACTIONS, DEDUP])
SPLIT_BASE = "WITH " + ",".join([INTERACTIONS, DEDUP, SPLIT])
FULL = "WITH " + ",".join([INTERACTIONS, DEDUP, SPLIT, RECS, SCORED])
WITH_HITS = "WITH " + ",".join([INTERACTIONS, DEDUP, SPLIT, RECS, SCORED, HITS])
