"""DuckDB SQL equivalents of the registered queries (independent of Spark).

Each statement reads the driver tables directly (pre-registered views) and
computes the same answer as the Spark job, which goes through the JSON
document log instead.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2026-01-01 00:00:00'"
ENDPOINT = "'/v3/prices_for_dates'"

# Offers (one per line item) -> calls -> pages -> documents.
OFFER_DOCS = """
geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
offers AS (
  SELECT go.r_name AS origin, go.n_name AS origin_airport, gd.r_name AS destination,
         gd.n_name AS destination_airport, p_brand AS airline,
         CAST(l_partkey AS VARCHAR) AS flight_number,
         CAST(floor(l_extendedprice / 5) AS INTEGER) AS price,
         l_linenumber - 1 AS transfers, CAST(l_quantity AS INTEGER) * 10 AS duration,
         l_shipdate AS departure_at, CAST(o_orderdate AS DATE) AS search_date,
         l_returnflag <> 'R' AS one_way, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN geo go ON c_nationkey = go.n_nationkey
  JOIN geo gd ON s_nationkey = gd.n_nationkey),
calls AS (
  SELECT *, strftime(departure_at, '%Y-%m') AS dep_month,
         count(*) OVER (PARTITION BY origin, destination, strftime(departure_at, '%Y-%m'), one_way) AS call_n
  FROM offers),
paged AS (
  SELECT *, CAST(((l_orderkey * 8 + l_linenumber) % CAST(ceil(call_n / 100.0) AS BIGINT)) + 1 AS INTEGER) AS page
  FROM calls),
docs AS (
  SELECT *,
         'o-' || origin || '-' || destination || '-' || dep_month || '-'
           || CASE WHEN one_way THEN 'ow' ELSE 'rt' END || '-' || page AS doc_id,
         CAST(min(search_date) OVER d AS TIMESTAMP) AS first_search,
         CAST(max(search_date) OVER d AS TIMESTAMP) AS last_search,
         count(*) OVER d AS n_offers
  FROM paged
  WINDOW d AS (PARTITION BY origin, destination, dep_month, one_way, page))
"""

ODS_SELECT = f"""
  SELECT doc_id, {ENDPOINT} AS endpoint, first_search AS batch_started_at, 200 AS status_code,
         false AS error, first_search AS created_at, last_search AS updated_at,
         last_search AS processed_src_dttm, {RUN_TS} AS processed_at,
         origin AS req_origin, destination AS req_destination,
         CAST(dep_month || '-01' AS DATE) AS req_departure_month, 'RUB' AS req_currency,
         'true' AS req_one_way, 'rub' AS resp_currency,
         '/o?id=' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
           || '&search_date=' || strftime(search_date, '%d%m%Y') AS link,
         price AS price_rub, origin, origin_airport, destination, destination_airport, airline,
         flight_number, duration AS duration_min, transfers AS transfers_cnt,
         duration AS duration_to_min, CAST(NULL AS INTEGER) AS duration_back_min,
         CAST(NULL AS INTEGER) AS return_transfers_cnt, departure_at AS departure_at_utc,
         search_date
  FROM docs WHERE one_way
"""

FACT_CTE = f"""
WITH {OFFER_DOCS},
ods AS ({ODS_SELECT}),
fact AS (
  SELECT doc_id, link, batch_started_at, endpoint, status_code, error, created_at, updated_at,
         processed_src_dttm, processed_at, req_departure_month, resp_currency AS currency,
         price_rub, origin, origin_airport, destination, destination_airport, airline,
         flight_number, duration_min, transfers_cnt, duration_to_min, duration_back_min,
         return_transfers_cnt, departure_at_utc, search_date,
         CASE WHEN transfers_cnt = 0 THEN true ELSE false END AS is_direct,
         CASE WHEN price_rub < 5000 THEN 'cheap'
              WHEN price_rub BETWEEN 5000 AND 15000 THEN 'medium'
              ELSE 'expensive' END AS price_bucket,
         CAST(departure_at_utc AS DATE) AS departure_date,
         CAST(date_trunc('month', departure_at_utc) AS DATE) AS departure_month,
         strftime(departure_at_utc, '%a') AS departure_weekday_short,
         strftime(departure_at_utc, '%A') AS departure_weekday_full,
         strftime(search_date, '%a') AS search_weekday_short,
         strftime(search_date, '%A') AS search_weekday_full
  FROM ods)
"""

ORACLE: dict[str, str] = {}

ORACLE["stage_current"] = f"""
WITH {OFFER_DOCS}
SELECT DISTINCT doc_id, {ENDPOINT} AS endpoint, 200 AS status_code, false AS error,
       first_search AS created_at, last_search AS updated_at, first_search AS batch_started_at,
       dep_month AS req_departure_at, page AS req_page, CAST(n_offers AS INTEGER) AS n_offers
FROM docs
"""

ORACLE["scan_log"] = ORACLE["stage_current"]

ORACLE["ods_flatten"] = f"WITH {OFFER_DOCS} {ODS_SELECT}"

ORACLE["fact_offers"] = FACT_CTE + "SELECT * FROM fact"

ORACLE["agg_route"] = FACT_CTE + """
SELECT origin, destination, round(avg(price_rub), 6) AS avg_price_rub
FROM fact GROUP BY origin, destination
"""

ORACLE["agg_dep_route"] = FACT_CTE + """
SELECT departure_date, any_value(departure_weekday_short) AS departure_weekday, origin, destination,
       round(avg(price_rub), 6) AS avg_price_rub
FROM fact GROUP BY departure_date, origin, destination
"""

ORACLE["agg_search_dep_route"] = FACT_CTE + """
SELECT search_date, any_value(search_weekday_short) AS search_weekday, departure_date,
       any_value(departure_weekday_short) AS departure_weekday, origin, destination,
       round(avg(price_rub), 6) AS avg_price_rub
FROM fact GROUP BY search_date, departure_date, origin, destination
"""

ORACLE["first_offer"] = FACT_CTE + """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (
      PARTITION BY departure_date, destination, origin
      ORDER BY created_at ASC NULLS LAST, processed_src_dttm ASC NULLS LAST,
               doc_id ASC NULLS LAST, link ASC NULLS LAST) AS INTEGER) AS rn
  FROM fact) WHERE rn = 1
"""

ORACLE["latest_cheapest"] = FACT_CTE + """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (
      PARTITION BY departure_date, destination, origin
      ORDER BY created_at DESC NULLS LAST, price_rub ASC NULLS LAST,
               doc_id ASC NULLS LAST, link ASC NULLS LAST) AS INTEGER) AS rn
  FROM fact) WHERE rn = 1
"""

ORACLE["airports"] = FACT_CTE + """
SELECT origin_airport AS airport_code, origin AS city_code FROM fact
UNION
SELECT destination_airport AS airport_code, destination AS city_code FROM fact
"""

LEAD_CTE = FACT_CTE + """,
lead AS (
  SELECT search_date, departure_date,
         CAST(departure_date - search_date AS INTEGER) AS days_before_departure,
         price_rub, origin, destination
  FROM fact
  WHERE departure_date IS NOT NULL AND search_date IS NOT NULL
    AND (departure_date - search_date) BETWEEN 0 AND 365)
"""

MONTHLY_CTE = FACT_CTE + """,
monthly AS (
  SELECT departure_month,
         CAST(extract(month FROM departure_month) AS INTEGER) AS month_num,
         CAST(extract(year FROM departure_month) AS INTEGER) AS year,
         count(*) AS ticket_count, avg(price_rub) AS avg_price,
         quantile_cont(price_rub, 0.5) AS median_price,
         min(price_rub) AS min_price, max(price_rub) AS max_price,
         stddev_samp(price_rub) AS price_stddev
  FROM fact WHERE departure_month IS NOT NULL
  GROUP BY departure_month),
rollup_m AS (
  SELECT month_num, avg(avg_price) AS avg_price, CAST(sum(ticket_count) AS BIGINT) AS ticket_count,
         avg(price_stddev) AS price_stddev
  FROM monthly GROUP BY month_num)
"""

WEEKLY_SELECT = """
  SELECT departure_weekday_short, departure_weekday_full, count(*) AS ticket_count,
         avg(price_rub) AS avg_price, quantile_cont(price_rub, 0.5) AS median_price,
         min(price_rub) AS min_price, quantile_cont(price_rub, 0.25) AS q1_price,
         CASE departure_weekday_short WHEN 'Mon' THEN 1 WHEN 'Tue' THEN 2 WHEN 'Wed' THEN 3
              WHEN 'Thu' THEN 4 WHEN 'Fri' THEN 5 WHEN 'Sat' THEN 6 WHEN 'Sun' THEN 7 END AS weekday_order
  FROM fact WHERE departure_weekday_short IS NOT NULL
  GROUP BY departure_weekday_short, departure_weekday_full
"""

BUCKETS_SELECT = """
  SELECT l.days_range, l.bucket_order, avg(b.price_rub) AS mean_price,
         count(b.price_rub) AS n_offers, stddev_samp(b.price_rub) AS std_price
  FROM (VALUES ('0-7', 1), ('8-14', 2), ('15-30', 3), ('31-60', 4), ('61-90', 5),
               ('91-180', 6), ('181-365', 7)) AS l(days_range, bucket_order)
  LEFT JOIN (
    SELECT CASE WHEN d > 0 AND d <= 7 THEN '0-7' WHEN d > 7 AND d <= 14 THEN '8-14'
                WHEN d > 14 AND d <= 30 THEN '15-30' WHEN d > 30 AND d <= 60 THEN '31-60'
                WHEN d > 60 AND d <= 90 THEN '61-90' WHEN d > 90 AND d <= 180 THEN '91-180'
                WHEN d > 180 AND d <= 365 THEN '181-365' END AS days_range, price_rub
    FROM (SELECT days_before_departure AS d, price_rub FROM lead)) b
  ON l.days_range = b.days_range
  GROUP BY l.days_range, l.bucket_order
"""

ORACLE["stats_month"] = MONTHLY_CTE + """
SELECT departure_month, month_num, year, ticket_count, round(avg_price, 6) AS avg_price,
       round(median_price, 6) AS median_price, min_price, max_price,
       round(price_stddev, 6) AS price_stddev
FROM monthly
"""

ORACLE["stats_weekday"] = FACT_CTE + f"""
SELECT departure_weekday_short, departure_weekday_full, ticket_count, round(avg_price, 6) AS avg_price,
       round(median_price, 6) AS median_price, min_price, round(q1_price, 6) AS q1_price,
       CAST(weekday_order AS INTEGER) AS weekday_order
FROM ({WEEKLY_SELECT})
"""

ORACLE["lead_time_offers"] = LEAD_CTE + "SELECT * FROM lead"

ORACLE["stats_lead_bucket"] = LEAD_CTE + f"""
SELECT days_range, CAST(bucket_order AS INTEGER) AS bucket_order, round(mean_price, 6) AS mean_price,
       n_offers, round(std_price, 6) AS std_price
FROM ({BUCKETS_SELECT})
"""

ORACLE["stats_lead_day"] = LEAD_CTE + """
SELECT days_before_departure, round(avg(price_rub), 6) AS avg_price
FROM lead GROUP BY days_before_departure
"""

ORACLE["smooth_lead_curve"] = LEAD_CTE + """,
s AS (SELECT days_before_departure, avg(price_rub) AS avg_price FROM lead GROUP BY 1),
p AS (SELECT *, row_number() OVER (ORDER BY days_before_departure) - 1 AS i,
             count(*) OVER () AS n FROM s),
kern AS (SELECT range AS k, exp(-0.5 * (range / 2.0) * (range / 2.0)) AS w FROM range(-8, 9)),
kn AS (SELECT k, w / sum(w) OVER () AS w FROM kern),
taps AS (
  SELECT p.i, kn.w, ((p.i + kn.k) % (2 * p.n) + 2 * p.n) % (2 * p.n) AS m, p.n
  FROM p CROSS JOIN kn),
sm AS (
  SELECT t.i, sum(t.w * q.avg_price) AS smoothed_price
  FROM taps t JOIN p q ON q.i = CASE WHEN t.m < t.n THEN t.m ELSE 2 * t.n - 1 - t.m END
  GROUP BY t.i)
SELECT p.days_before_departure, round(p.avg_price, 6) AS avg_price,
       round(sm.smoothed_price, 6) AS smoothed_price
FROM p JOIN sm ON p.i = sm.i
"""

ORACLE["month_rollup"] = MONTHLY_CTE + """
SELECT month_num, round(avg_price, 6) AS avg_price, ticket_count, round(price_stddev, 6) AS price_stddev
FROM rollup_m
"""

ORACLE["pivot_month_year"] = MONTHLY_CTE + """
SELECT month_num, year, round(avg(avg_price), 6) AS avg_price FROM monthly GROUP BY month_num, year
"""

ORACLE["cheapest_months"] = MONTHLY_CTE + """
SELECT month_num, round(avg_price, 6) AS avg_price
FROM rollup_m WHERE avg_price IS NOT NULL
ORDER BY avg_price, month_num LIMIT 3
"""

ORACLE["cheapest_weekdays"] = FACT_CTE + f"""
SELECT departure_weekday_short, departure_weekday_full, round(avg_price, 6) AS avg_price
FROM ({WEEKLY_SELECT}) w WHERE avg_price IS NOT NULL
ORDER BY avg_price, weekday_order LIMIT 2
"""

ORACLE["price_extremes"] = MONTHLY_CTE.replace("WITH ", "WITH ", 1) + """,
lead AS (
  SELECT CAST(departure_date - search_date AS INTEGER) AS days_before_departure, price_rub
  FROM fact
  WHERE departure_date IS NOT NULL AND search_date IS NOT NULL
    AND (departure_date - search_date) BETWEEN 0 AND 365),
wk AS (""" + WEEKLY_SELECT + """),
bk AS (""" + BUCKETS_SELECT + """),
dd AS (SELECT days_before_departure AS d, avg(price_rub) AS v FROM lead GROUP BY 1),
rm AS (SELECT * FROM rollup_m WHERE avg_price IS NOT NULL),
w2 AS (SELECT * FROM wk WHERE avg_price IS NOT NULL),
b2 AS (SELECT * FROM bk WHERE mean_price IS NOT NULL),
f AS (
  SELECT 'most_expensive_month' AS finding, CAST((SELECT month_num FROM rm ORDER BY avg_price DESC, month_num LIMIT 1) AS VARCHAR) AS label,
         (SELECT max(avg_price) FROM rm) AS value
  UNION ALL SELECT 'month_spread', NULL, (SELECT max(avg_price) - min(avg_price) FROM rm)
  UNION ALL SELECT 'best_weekday', (SELECT departure_weekday_full FROM w2 ORDER BY avg_price, weekday_order LIMIT 1),
         (SELECT min(avg_price) FROM w2)
  UNION ALL SELECT 'worst_weekday', (SELECT departure_weekday_full FROM w2 ORDER BY avg_price DESC, weekday_order LIMIT 1),
         (SELECT max(avg_price) FROM w2)
  UNION ALL SELECT 'weekday_saving', NULL, (SELECT max(avg_price) - min(avg_price) FROM w2)
  UNION ALL SELECT 'weekday_saving_pct', NULL, (SELECT (max(avg_price) - min(avg_price)) / max(avg_price) * 100 FROM w2)
  UNION ALL SELECT 'cheapest_lead_bucket', (SELECT days_range FROM b2 ORDER BY mean_price, bucket_order LIMIT 1),
         (SELECT min(mean_price) FROM b2)
  UNION ALL SELECT 'dearest_lead_bucket', (SELECT days_range FROM b2 ORDER BY mean_price DESC, bucket_order LIMIT 1),
         (SELECT max(mean_price) FROM b2)
  UNION ALL SELECT 'optimal_lead_day', CAST((SELECT d FROM dd WHERE d BETWEEN 30 AND 60 ORDER BY v, d LIMIT 1) AS VARCHAR),
         (SELECT min(v) FROM dd WHERE d BETWEEN 30 AND 60))
SELECT finding, label, round(CAST(value AS DOUBLE), 6) AS value FROM f
WHERE value IS NOT NULL OR label IS NOT NULL
"""

ORACLE["box_stats"] = FACT_CTE + """,
base AS (SELECT departure_weekday_short, price_rub FROM fact WHERE departure_weekday_short IS NOT NULL),
qs AS (
  SELECT departure_weekday_short, count(price_rub) AS n, min(price_rub) AS min_value,
         max(price_rub) AS max_value, quantile_cont(price_rub, 0.25) AS q1,
         quantile_cont(price_rub, 0.5) AS median, quantile_cont(price_rub, 0.75) AS q3
  FROM base GROUP BY 1),
tails AS (
  SELECT b.departure_weekday_short,
         min(CASE WHEN price_rub >= q1 - 1.5 * (q3 - q1) THEN price_rub END) AS whisker_low,
         max(CASE WHEN price_rub <= q3 + 1.5 * (q3 - q1) THEN price_rub END) AS whisker_high,
         count(CASE WHEN price_rub < q1 - 1.5 * (q3 - q1) OR price_rub > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
  FROM base b JOIN qs USING (departure_weekday_short) GROUP BY 1)
SELECT departure_weekday_short, n, min_value, round(q1, 6) AS q1, round(median, 6) AS median,
       round(q3, 6) AS q3, max_value, round(q3 - q1, 6) AS iqr, whisker_low, whisker_high, outliers
FROM qs JOIN tails USING (departure_weekday_short)
"""

ORACLE["stats_quantiles_exact"] = FACT_CTE + """,
probs AS (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS quantile),
prices AS (
  SELECT 'weekday' AS part, departure_weekday_short AS item, CAST(price_rub AS DOUBLE) AS x FROM fact
  WHERE departure_weekday_short IS NOT NULL
  UNION ALL
  SELECT 'return flag', l_returnflag, CAST(l_extendedprice AS DOUBLE) * (1.0::DOUBLE + l_orderkey / 1e9::DOUBLE) FROM lineitem),
sorted AS (
  SELECT part, item, x, row_number() OVER (PARTITION BY part, item ORDER BY x) - 1 AS r,
         count(*) OVER (PARTITION BY part, item) AS n
  FROM prices WHERE x IS NOT NULL),
wanted AS (SELECT DISTINCT part, item, n, quantile, quantile * (n - 1) AS p FROM sorted, probs)
SELECT w.part, w.item, w.quantile, w.n, round(a.x + (b.x - a.x) * (w.p - floor(w.p)), 6) AS value
FROM wanted w JOIN sorted a ON a.part = w.part AND a.item = w.item AND a.r = floor(w.p)
JOIN sorted b ON b.part = w.part AND b.item = w.item AND b.r = ceil(w.p)
"""

ORACLE["offers_bottom_k"] = FACT_CTE + """
SELECT departure_weekday_short,
       CAST(row_number() OVER (PARTITION BY departure_weekday_short
            ORDER BY md5(coalesce(doc_id, '') || '|' || coalesce(link, '')), price_rub NULLS LAST) AS INTEGER) AS sample_rank,
       doc_id, link, price_rub
FROM fact QUALIFY sample_rank <= 100
"""

ORACLE["offers_sample"] = FACT_CTE + """
SELECT doc_id, link, departure_weekday_short, price_rub FROM fact
WHERE departure_weekday_short IS NOT NULL
"""

# --- requests, code lists, collection log ------------------------------------

CODES_SELECT = """
  SELECT DISTINCT upper(trim(r_name)) AS code
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE upper(trim(r_name)) <> '' AND NOT starts_with(upper(trim(r_name)), '#')
"""

ORACLE["code_list"] = CODES_SELECT

PAIRS_CTE = f"""
WITH {OFFER_DOCS},
pairs AS (SELECT DISTINCT origin, destination FROM offers WHERE origin <> destination)
"""

ORACLE["ordered_pairs"] = PAIRS_CTE + "SELECT origin, destination FROM pairs"

ORACLE["request_grid"] = PAIRS_CTE + """,
start AS (SELECT date_trunc('month', CAST(max(o_orderdate) AS DATE)) AS m FROM orders)
SELECT origin, destination, strftime(start.m + to_months(i), '%Y-%m') AS departure_at,
       f.one_way, 100 AS "limit", 'price' AS sorting
FROM pairs, start, range(0, 13) t(i), (VALUES ('true'), ('false')) f(one_way)
"""

REQ_CTE = """
WITH req AS (
  SELECT c_custkey AS request_id,
         CASE WHEN c_custkey % 7 = 0 THEN '1X' ELSE lower(substr(c_mktsegment, 1, 3)) END AS origin,
         CASE WHEN c_nationkey = 3 THEN 'LONDON' ELSE 'PAR' END AS destination,
         ['RUB', 'USD', 'EUR', 'GBP'][c_nationkey % 4 + 1] AS currency,
         CASE WHEN c_custkey % 11 = 0 THEN '2025/1' ELSE '2025-12-01' END AS departure_at,
         CASE WHEN c_custkey % 3 = 0 THEN '2026-01-15' END AS return_at,
         CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS one_way,
         'false' AS direct, CAST(NULL AS VARCHAR) AS market,
         CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS "limit", '1' AS page,
         'price' AS sorting, 'false' AS "unique"
  FROM customer),
checked AS (
  SELECT *, list_filter([
    CASE WHEN origin IS NULL OR NOT regexp_matches(upper(origin), '^[A-Z]{2,3}$') THEN 'origin' END,
    CASE WHEN destination IS NULL OR NOT regexp_matches(upper(destination), '^[A-Z]{2,3}$') THEN 'destination' END,
    CASE WHEN currency IS NOT NULL AND currency NOT IN ('RUB', 'USD', 'EUR') THEN 'currency' END,
    CASE WHEN departure_at IS NOT NULL AND length(trim(departure_at)) NOT IN (7, 10) THEN 'departure_at' END,
    CASE WHEN return_at IS NOT NULL AND length(trim(return_at)) NOT IN (7, 10) THEN 'return_at' END,
    CASE WHEN coalesce(lower(one_way), 'true') = 'true' AND return_at IS NOT NULL THEN 'return_with_one_way' END,
    CASE WHEN market IS NOT NULL AND NOT regexp_matches(market, '^[a-z]{2}$') THEN 'market' END,
    CASE WHEN "limit" IS NOT NULL AND (TRY_CAST("limit" AS INTEGER) IS NULL
              OR TRY_CAST("limit" AS INTEGER) NOT BETWEEN 1 AND 1000) THEN 'limit' END,
    CASE WHEN page IS NOT NULL AND (TRY_CAST(page AS INTEGER) IS NULL OR TRY_CAST(page AS INTEGER) < 1) THEN 'page' END,
    CASE WHEN sorting IS NOT NULL AND sorting NOT IN ('price', 'route') THEN 'sorting' END,
    CASE WHEN NOT (one_way IS NULL OR lower(one_way) IN ('true', 'false')) THEN 'one_way' END,
    CASE WHEN NOT (direct IS NULL OR lower(direct) IN ('true', 'false')) THEN 'direct' END,
    CASE WHEN NOT ("unique" IS NULL OR lower("unique") IN ('true', 'false')) THEN 'unique' END
  ], lambda x: x IS NOT NULL) AS reasons
  FROM req)
"""

ORACLE["validate_requests"] = REQ_CTE + """
SELECT request_id, origin, destination, currency, departure_at, return_at, one_way, direct, market,
       "limit", page, sorting, "unique", array_to_string(reasons, ',') AS reject_reasons,
       len(reasons) = 0 AS is_valid
FROM checked
"""

ORACLE["normalize_requests"] = REQ_CTE + """
SELECT request_id, '{' || concat_ws(',',
    '"origin":"' || upper(origin) || '"',
    '"destination":"' || upper(destination) || '"',
    '"currency":"' || coalesce(currency, 'RUB') || '"',
    CASE WHEN departure_at IS NOT NULL THEN '"departure_at":"' || trim(departure_at) || '"' END,
    CASE WHEN return_at IS NOT NULL THEN '"return_at":"' || trim(return_at) || '"' END,
    '"one_way":"' || lower(coalesce(one_way, 'true')) || '"',
    '"direct":"' || lower(coalesce(direct, 'false')) || '"',
    CASE WHEN market IS NOT NULL THEN '"market":"' || market || '"' END,
    '"limit":' || coalesce(TRY_CAST("limit" AS INTEGER), 30),
    '"page":' || coalesce(TRY_CAST(page AS INTEGER), 1),
    '"sorting":"' || coalesce(sorting, 'price') || '"',
    '"unique":"' || lower(coalesce("unique", 'false')) || '"') || '}' AS query_json
FROM checked WHERE len(reasons) = 0
"""

EVENT_DOCS = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
docs AS (
  SELECT 'u' || user_id || '-' || event_type AS doc_id, event_id, {ENDPOINT} AS endpoint,
         CASE WHEN event_type = 'error' THEN NULL ELSE 200 END AS status_code,
         event_type = 'error' AS error, ts AS created_at, ts + to_minutes(k) AS updated_at,
         date_trunc('day', ts) AS batch_started_at,
         upper(substr(event_type, 1, 3)) AS req_origin, 'D' || (user_id % 10) AS req_destination,
         strftime(ts, '%Y-%m') AS req_departure_at,
         event_type NOT IN ('error', 'signup') AS is_success,
         CAST(CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE k % 5 END AS INTEGER) AS n_offers,
         event_type, k, value
  FROM ev)
"""

ORACLE["classify_responses"] = f"""
WITH {EVENT_DOCS}
SELECT doc_id, event_id, is_success,
       CASE WHEN event_type = 'error' THEN 'boom' WHEN event_type = 'signup' THEN 'quota' END AS error_message
FROM docs
"""

ORACLE["log_documents"] = f"""
WITH {EVENT_DOCS}
SELECT doc_id, event_id, endpoint, status_code, error, created_at, updated_at, batch_started_at,
       CASE WHEN event_type = 'error' THEN 'text' ELSE 'object' END AS response_kind, n_offers
FROM docs
"""

ORACLE["batch_summary"] = f"""
WITH {EVENT_DOCS}
SELECT batch_started_at,
       CAST(sum(CASE WHEN is_success THEN n_offers ELSE 0 END) AS BIGINT) AS number_tickets,
       count(*) FILTER (WHERE NOT is_success) AS number_missed,
       count(DISTINCT req_origin || '|' || req_destination) AS routes,
       count(DISTINCT req_departure_at) AS periods
FROM docs GROUP BY batch_started_at
"""

ORACLE["month_spine"] = f"""
WITH {EVENT_DOCS},
days AS (SELECT DISTINCT CAST(batch_started_at AS DATE) AS batch_date FROM docs)
SELECT batch_date, strftime(date_trunc('month', batch_date) + to_months(i), '%Y-%m') AS period
FROM days, range(0, 13) t(i)
"""

ORACLE["day_spine"] = f"""
WITH {EVENT_DOCS},
days AS (SELECT DISTINCT CAST(batch_started_at AS DATE) AS batch_date FROM docs)
SELECT batch_date, CAST(unnest(generate_series(CAST(batch_date AS TIMESTAMP),
       CAST(last_day(batch_date + INTERVAL 12 MONTH) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
FROM days
"""

HISTORY_CTE = f"""
WITH {EVENT_DOCS},
hist AS (
  SELECT doc_id, event_id, created_at AS valid_from_dttm,
         lead(created_at) OVER (PARTITION BY doc_id ORDER BY created_at, event_id) AS valid_to_dttm
  FROM docs)
"""

ORACLE["scd2_history"] = HISTORY_CTE + """
SELECT doc_id, event_id, valid_from_dttm, valid_to_dttm, valid_to_dttm IS NULL AS is_current FROM hist
"""

ORACLE["scd2_intervals"] = HISTORY_CTE + """,
moved AS (
  SELECT doc_id, valid_from_dttm AS f,
         CASE WHEN valid_to_dttm IS NULL AND event_id % 19 = 0 THEN valid_from_dttm + INTERVAL 1 DAY
              WHEN valid_to_dttm IS NULL THEN NULL
              WHEN event_id % 13 = 0 THEN valid_to_dttm + INTERVAL 30 HOUR
              WHEN event_id % 17 = 0 THEN valid_to_dttm - INTERVAL 1 HOUR
              WHEN event_id % 23 = 0 THEN NULL ELSE valid_to_dttm END AS t
  FROM hist),
sound AS (SELECT * FROM moved WHERE t IS NULL OR t >= f),
points AS (
  SELECT doc_id, p, sum(d) AS d
  FROM (SELECT doc_id, f AS p, 1 AS d FROM sound UNION ALL SELECT doc_id, t, -1 FROM sound WHERE t IS NOT NULL)
  GROUP BY doc_id, p HAVING sum(d) <> 0),
swept AS (
  SELECT doc_id, p, CAST(sum(d) OVER w AS BIGINT) AS n_open, lead(p) OVER w AS nxt FROM points
  WINDOW w AS (PARTITION BY doc_id ORDER BY p))
SELECT doc_id, CASE WHEN nxt IS NULL THEN 'open' WHEN n_open > 1 THEN 'overlap' ELSE 'gap' END AS kind,
       p AS from_dttm, nxt AS to_dttm, n_open
FROM swept WHERE CASE WHEN nxt IS NULL THEN n_open <> 1 ELSE n_open <> 1 END
UNION ALL SELECT doc_id, 'reversed', f, t, 0 FROM moved WHERE t < f
"""

ORACLE["scan_log_since"] = f"""
WITH {EVENT_DOCS},
cut AS (SELECT min(batch_started_at) + INTERVAL 15 DAY AS t FROM docs),
loaded AS (SELECT * FROM docs WHERE created_at < (SELECT t FROM cut)),
wm AS (SELECT coalesce(max(updated_at), TIMESTAMP '1970-01-01') - INTERVAL 1 DAY AS w FROM loaded)
SELECT doc_id, event_id, updated_at FROM docs WHERE updated_at > (SELECT w FROM wm)
"""

# --- incremental runs --------------------------------------------------------

EVENT_OFFERS = f"""
WITH {EVENT_DOCS},
cuts AS (SELECT min(batch_started_at) + INTERVAL 10 DAY AS c1,
                min(batch_started_at) + INTERVAL 20 DAY AS c2 FROM docs),
offers AS (
  SELECT doc_id, event_id, endpoint, batch_started_at, 200 AS status_code, false AS error,
         created_at, updated_at, created_at AS processed_src_dttm,
         req_origin, req_destination, CAST(date_trunc('month', created_at) AS DATE) AS req_departure_month,
         'RUB' AS req_currency, 'true' AS req_one_way, 'rub' AS resp_currency,
         '/e?id=' || event_id || '&search_date=' || strftime(created_at, '%d%m%Y') AS link,
         CAST(round(value * 100) AS INTEGER) AS price_rub, req_origin AS origin,
         req_origin || '1' AS origin_airport, req_destination AS destination,
         req_destination || 'A' AS destination_airport, 'A' || (event_id % 7) AS airline,
         CAST(event_id AS VARCHAR) AS flight_number, k * 10 AS duration_min,
         k % 3 AS transfers_cnt, k AS duration_to_min, CAST(NULL AS INTEGER) AS duration_back_min,
         CAST(NULL AS INTEGER) AS return_transfers_cnt,
         date_trunc('second', created_at + to_days(k)) AS departure_at_utc,
         CAST(created_at AS DATE) AS search_date,
         unnest(range(n_offers)) AS copy_no
  FROM docs WHERE is_success),
v1 AS (SELECT doc_id, event_id FROM docs WHERE created_at < (SELECT c1 FROM cuts)
       QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY created_at DESC, event_id DESC) = 1),
v2 AS (SELECT doc_id, event_id FROM docs WHERE created_at < (SELECT c2 FROM cuts)
       QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY created_at DESC, event_id DESC) = 1),
v3 AS (SELECT doc_id, event_id FROM docs
       QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY created_at DESC, event_id DESC) = 1),
o1 AS (SELECT o.*, 1 AS run FROM offers o JOIN v1 USING (doc_id, event_id)),
o2 AS (SELECT o.*, 2 AS run FROM offers o JOIN v2 USING (doc_id, event_id)
       WHERE o.created_at >= (SELECT max(created_at) - INTERVAL 1 HOUR FROM o1)),
o3 AS (SELECT o.*, 3 AS run FROM offers o JOIN v3 USING (doc_id, event_id)
       WHERE o.created_at >= (SELECT max(created_at) - INTERVAL 1 HOUR
                              FROM (SELECT created_at FROM o1 UNION ALL SELECT created_at FROM o2))),
allo AS (SELECT * FROM o1 UNION ALL SELECT * FROM o2 UNION ALL SELECT * FROM o3),
ods AS (SELECT *, TIMESTAMP '2026-01-01 00:00:00' + to_hours(run) AS processed_at FROM allo
        QUALIFY run = max(run) OVER (PARTITION BY doc_id, link)),
f1 AS (SELECT * FROM o1),
f2 AS (SELECT * FROM o2 WHERE created_at > (SELECT max(created_at) FROM f1)),
f3 AS (SELECT * FROM o3 WHERE created_at > (SELECT max(created_at)
                                            FROM (SELECT created_at FROM f1 UNION ALL SELECT created_at FROM f2))),
fact_raw AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3),
fact AS (
  SELECT doc_id, link, batch_started_at, endpoint, status_code, error, created_at, updated_at,
         processed_src_dttm, TIMESTAMP '2026-01-01 00:00:00' + to_hours(run) AS processed_at,
         req_departure_month, resp_currency AS currency, price_rub, origin, origin_airport,
         destination, destination_airport, airline, flight_number, duration_min, transfers_cnt,
         duration_to_min, duration_back_min, return_transfers_cnt, departure_at_utc, search_date,
         CASE WHEN transfers_cnt = 0 THEN true ELSE false END AS is_direct,
         CASE WHEN price_rub < 5000 THEN 'cheap' WHEN price_rub BETWEEN 5000 AND 15000 THEN 'medium'
              ELSE 'expensive' END AS price_bucket,
         CAST(departure_at_utc AS DATE) AS departure_date,
         CAST(date_trunc('month', departure_at_utc) AS DATE) AS departure_month,
         strftime(departure_at_utc, '%a') AS departure_weekday_short,
         strftime(departure_at_utc, '%A') AS departure_weekday_full,
         strftime(search_date, '%a') AS search_weekday_short,
         strftime(search_date, '%A') AS search_weekday_full,
         CAST(run AS INTEGER) AS run_id
  FROM fact_raw)
"""

ODS_OUT = """doc_id, endpoint, batch_started_at, status_code, error, created_at, updated_at,
  processed_src_dttm, processed_at, req_origin, req_destination, req_departure_month, req_currency,
  req_one_way, resp_currency, link, price_rub, origin, origin_airport, destination,
  destination_airport, airline, flight_number, duration_min, transfers_cnt, duration_to_min,
  duration_back_min, return_transfers_cnt, departure_at_utc, search_date"""

FACT_OUT = """doc_id, link, batch_started_at, endpoint, status_code, error, created_at, updated_at,
  processed_src_dttm, processed_at, req_departure_month, currency, price_rub, origin, origin_airport,
  destination, destination_airport, airline, flight_number, duration_min, transfers_cnt,
  duration_to_min, duration_back_min, return_transfers_cnt, departure_at_utc, search_date, is_direct,
  price_bucket, departure_date, departure_month, departure_weekday_short, departure_weekday_full,
  search_weekday_short, search_weekday_full"""

RANK = """CAST(row_number() OVER (PARTITION BY departure_date, destination, origin
      ORDER BY created_at ASC NULLS LAST, processed_src_dttm ASC NULLS LAST,
               doc_id ASC NULLS LAST, link ASC NULLS LAST) AS INTEGER)"""

ORACLE["scd2_apply"] = ORACLE["scd2_history"]

ORACLE["delete_insert"] = EVENT_OFFERS + f"SELECT {ODS_OUT} FROM ods"

ORACLE["incremental_append"] = EVENT_OFFERS + f"SELECT {FACT_OUT}, run_id FROM fact"

ORACLE["latest_upsert"] = EVENT_OFFERS + f"""
SELECT {FACT_OUT}, rn FROM (SELECT *, {RANK} AS rn FROM fact) WHERE rn = 1
"""

LATEST_RUNS = f""",
l1 AS (SELECT * FROM (SELECT *, {RANK} AS rn FROM fact WHERE run_id <= 1) WHERE rn = 1),
l2 AS (SELECT * REPLACE (CAST(2 AS INTEGER) AS run_id) FROM (SELECT *, {RANK} AS rn FROM fact
       WHERE run_id <= 2 AND processed_src_dttm > (SELECT max(processed_src_dttm) FROM l1)) WHERE rn = 1),
l3 AS (SELECT * REPLACE (CAST(3 AS INTEGER) AS run_id) FROM (SELECT *, {RANK} AS rn FROM fact
       WHERE run_id <= 3 AND processed_src_dttm > (SELECT max(processed_src_dttm)
             FROM (SELECT processed_src_dttm FROM l1 UNION ALL SELECT processed_src_dttm FROM l2))) WHERE rn = 1)
"""

ORACLE["latest_append"] = EVENT_OFFERS + LATEST_RUNS + f"""
SELECT {FACT_OUT}, rn, run_id FROM (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)
"""

# The models after three runs loaded at 01:00, 02:00 and 03:00, from the versions of each run.
LOADED_MODELS = """offers AS (
  SELECT doc_id, event_id, run, status_code, loaded_at,
         '/e?id=' || event_id || '&search_date=' || strftime(created_at, '%d%m%Y') AS link,
         CAST(round(value * 100) AS INTEGER) AS price_rub, unnest(range(n_offers)) AS copy_no
  FROM versions)
SELECT 'raw' AS model, doc_id, CAST(NULL AS VARCHAR) AS link, CAST(NULL AS INTEGER) AS price_rub,
       CAST(status_code AS INTEGER) AS status_code, loaded_at,
       lead(loaded_at) OVER (PARTITION BY doc_id ORDER BY run) AS closed_at
FROM versions
UNION ALL
SELECT 'ods', doc_id, link, price_rub, CAST(status_code AS INTEGER), loaded_at, NULL
FROM (SELECT * FROM offers QUALIFY run = max(run) OVER (PARTITION BY doc_id, event_id))
UNION ALL
SELECT 'fact', doc_id, link, price_rub, CAST(status_code AS INTEGER), loaded_at, NULL FROM offers
"""

ORACLE["late_updates"] = f"""
WITH {EVENT_DOCS},
cuts AS (SELECT min(batch_started_at) + INTERVAL 10 DAY AS c1,
                min(batch_started_at) + INTERVAL 20 DAY AS c2 FROM docs),
due AS (SELECT docs.*, CASE WHEN created_at < c1 THEN 1 WHEN created_at < c2 THEN 2 ELSE 3 END AS slice
        FROM docs, cuts),
landed AS (
  SELECT doc_id, event_id, created_at, updated_at, status_code, n_offers, value,
         least(3, slice + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) AS run FROM due
  UNION ALL
  SELECT doc_id, event_id, created_at, updated_at + INTERVAL 1 HOUR, 203, n_offers, value,
         least(3, slice + 1) FROM due WHERE event_id % 7 = 0),
versions AS (
  SELECT *, TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(run AS INTEGER)) AS loaded_at FROM landed
  QUALIFY row_number() OVER (PARTITION BY doc_id, run ORDER BY updated_at DESC, created_at DESC, event_id DESC) = 1),
{LOADED_MODELS}"""

ORACLE["marts_retract"] = f"""
WITH {EVENT_DOCS},
cuts AS (SELECT min(batch_started_at) + INTERVAL 10 DAY AS c1,
                min(batch_started_at) + INTERVAL 20 DAY AS c2 FROM docs),
due AS (SELECT docs.*, CASE WHEN created_at < c1 THEN 1 WHEN created_at < c2 THEN 2 ELSE 3 END AS slice,
               CAST(round(value * 100) AS INTEGER) AS price FROM docs, cuts),
landed AS (
  SELECT * EXCLUDE (slice), least(3, slice + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) AS run FROM due
  UNION ALL
  SELECT * EXCLUDE (slice) REPLACE (
    updated_at + INTERVAL 1 HOUR AS updated_at,
    CASE WHEN price >= 0 THEN CAST('1' || price AS INTEGER) ELSE price END AS price), least(3, slice + 1)
  FROM due WHERE event_id % 7 = 0),
versions AS (
  SELECT * FROM landed
  QUALIFY row_number() OVER (PARTITION BY doc_id, run ORDER BY updated_at DESC, created_at DESC, event_id DESC) = 1),
ods AS (
  SELECT * FROM (SELECT *, unnest(range(n_offers)) AS copy_no FROM versions
                 QUALIFY run = max(run) OVER (PARTITION BY doc_id, event_id))
  WHERE doc_id NOT IN (SELECT doc_id FROM docs WHERE event_id % 29 = 0)),
offers AS (
  SELECT CAST(created_at AS DATE) AS search_date, CAST(created_at + to_days(k) AS DATE) AS departure_date,
         req_origin AS origin, req_destination AS destination, price FROM ods)
SELECT 'airports' AS mart, '' AS search_date, '' AS departure_date,
       origin || '1' AS a, origin AS b, CAST(NULL AS DOUBLE) AS avg_price_rub FROM offers GROUP BY origin
UNION ALL SELECT 'airports', '', '', destination || 'A', destination, NULL FROM offers GROUP BY destination
UNION ALL SELECT 'agg_route', '', '', origin, destination, round(avg(price), 6) FROM offers GROUP BY origin, destination
UNION ALL SELECT 'agg_dep_route', '', CAST(departure_date AS VARCHAR), origin, destination, round(avg(price), 6)
  FROM offers GROUP BY departure_date, origin, destination
UNION ALL SELECT 'agg_search_dep_route', CAST(search_date AS VARCHAR), CAST(departure_date AS VARCHAR), origin, destination,
  round(avg(price), 6) FROM offers GROUP BY search_date, departure_date, origin, destination
"""

ORACLE["scd2_keyed_state"] = f"""
WITH {EVENT_DOCS},
cuts AS (SELECT min(batch_started_at) + INTERVAL 10 DAY AS c1,
                min(batch_started_at) + INTERVAL 20 DAY AS c2 FROM docs),
due AS (SELECT docs.*, CASE WHEN created_at < c1 THEN 1 WHEN created_at < c2 THEN 2 ELSE 3 END AS slice
        FROM docs, cuts),
landed AS (
  SELECT doc_id, event_id, created_at, updated_at, status_code, slice AS run FROM due
  UNION ALL
  SELECT doc_id, event_id, created_at, updated_at, CASE WHEN event_id % 2 = 0 THEN 203 ELSE status_code END, slice + 1
  FROM due WHERE event_id % 3 = 0 AND slice < 3),
loaded AS (
  SELECT *, TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(run AS INTEGER)) AS loaded_at FROM landed
  QUALIFY row_number() OVER (PARTITION BY doc_id, run ORDER BY updated_at DESC, created_at DESC, event_id DESC) = 1),
versions AS (
  SELECT * FROM loaded WINDOW w AS (PARTITION BY doc_id ORDER BY run)
  QUALIFY lag(event_id) OVER w IS DISTINCT FROM event_id OR lag(status_code) OVER w IS DISTINCT FROM status_code)
SELECT 'log' AS part, doc_id, event_id, loaded_at FROM versions
UNION ALL
SELECT 'state', doc_id, event_id, loaded_at FROM versions
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY run DESC) = 1
"""

EL_CTE = f"""
WITH {EVENT_DOCS},
cuts AS (SELECT min(batch_started_at) + INTERVAL 10 DAY AS c1,
                min(batch_started_at) + INTERVAL 20 DAY AS c2 FROM docs),
marks AS (SELECT max(updated_at) FILTER (WHERE updated_at < c1) - INTERVAL 1 DAY AS w1,
                 max(updated_at) FILTER (WHERE updated_at < c2) - INTERVAL 1 DAY AS w2 FROM docs, cuts),
landed AS (
  SELECT docs.*, 1 AS run FROM docs, cuts WHERE updated_at < c1
  UNION ALL SELECT docs.*, 2 FROM docs, cuts, marks WHERE updated_at < c2 AND updated_at > w1
  UNION ALL SELECT docs.*, 3 FROM docs, marks WHERE updated_at > w2),
loaded AS (
  SELECT *, TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(run AS INTEGER)) AS loaded_at FROM landed
  QUALIFY row_number() OVER (PARTITION BY doc_id, run ORDER BY updated_at DESC, created_at DESC, event_id DESC) = 1)
"""

ORACLE["faithful_cascade"] = EL_CTE + f""",
versions AS (SELECT * FROM loaded),
{LOADED_MODELS}"""

ORACLE["el_lookback"] = EL_CTE + f""",
versions AS (SELECT * FROM loaded
             QUALIFY lag(event_id) OVER (PARTITION BY doc_id ORDER BY run) IS DISTINCT FROM event_id),
{LOADED_MODELS}"""

ORACLE["el_matched"] = EL_CTE + """
SELECT run AS run_id, TIMESTAMP '2026-01-01 00:00:00' + to_hours(CAST(run AS INTEGER)) AS loaded_at,
       count(*) AS n_docs FROM landed GROUP BY run
"""

ORACLE["marts_increment"] = EVENT_OFFERS + """
SELECT search_date, strftime(search_date, '%a') AS search_weekday, departure_date,
       strftime(departure_date, '%a') AS departure_weekday, origin, destination,
       round(avg(price_rub), 6) AS avg_price_rub
FROM fact GROUP BY search_date, departure_date, origin, destination
"""

# Monthly, month-of-year and lead-time statistics in one pass over the fact of three runs.
_PRICES = "avg(price_rub), min(price_rub), max(price_rub), stddev_samp(price_rub)"
ORACLE["stats_increment"] = EVENT_OFFERS + f""",
lead AS (SELECT price_rub, CASE {" ".join(
    f"WHEN d > {lo} AND d <= {hi} THEN '{label}'" for label, lo, hi in (
        ("0-7", 0, 7), ("8-14", 7, 14), ("15-30", 14, 30), ("31-60", 30, 60), ("61-90", 60, 90),
        ("91-180", 90, 180), ("181-365", 180, 365)))} END AS days_range
  FROM (SELECT price_rub, departure_date - search_date AS d FROM fact)),
rows AS (
  SELECT 'month' AS part, CAST(departure_month AS VARCHAR) AS item, count(*) AS n, avg(price_rub) AS a, min(price_rub) AS lo,
         max(price_rub) AS hi, stddev_samp(price_rub) AS s FROM fact GROUP BY departure_month
  UNION ALL
  SELECT 'month of year', CAST(month(departure_month) AS VARCHAR), count(*), {_PRICES} FROM fact GROUP BY month(departure_month)
  UNION ALL
  SELECT 'lead', days_range, count(price_rub), avg(price_rub), NULL, NULL, stddev_samp(price_rub)
  FROM lead WHERE days_range IS NOT NULL GROUP BY days_range)
SELECT part, item, n, round(a, 6) AS avg_price, lo AS min_price, hi AS max_price, round(s, 6) AS price_stddev FROM rows
"""

ORACLE["stream_models"] = EVENT_OFFERS + """
SELECT 'ods' AS model, doc_id, link, price_rub, processed_src_dttm, processed_at FROM ods
UNION ALL SELECT 'fact', doc_id, link, price_rub, processed_src_dttm, processed_at FROM fact
"""

# --- data quality ---------------------------------------------------------------

CHECK_OUT = "test, model, \"column\", severity, tags, failures, status, detail"


def _check(test, model, column, severity, failures_sql, detail="CAST(NULL AS VARCHAR)"):
    status = (f"CASE WHEN ({failures_sql}) = 0 THEN 'pass' "
              f"WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END")
    return (f"SELECT '{test}' AS test, '{model}' AS model, '{column}' AS \"column\", "
            f"'{severity}' AS severity, 'dqc' AS tags, CAST(({failures_sql}) AS BIGINT) AS failures, "
            f"{status} AS status, {detail} AS detail")


DQ_CTE = FACT_CTE + f""",
stg AS (SELECT DISTINCT doc_id, last_search AS updated_at FROM docs),
latest AS (SELECT * FROM (SELECT *, {RANK} AS rn FROM fact) WHERE rn = 1)
"""

NOT_NULL_ROWS = [
    _check("not_null", "stg_ticket_offers", "response", "error", "SELECT 0"),
    _check("not_null", "stg_ticket_offers", "request", "error", "SELECT 0"),
    _check("not_null", "ods_ticket_offers", "search_date", "error",
           "SELECT count(*) FILTER (WHERE search_date IS NULL) FROM fact"),
    _check("not_null", "ods_ticket_offers", "origin", "error",
           "SELECT count(*) FILTER (WHERE origin IS NULL) FROM fact"),
    _check("not_null", "ods_ticket_offers", "destination", "error",
           "SELECT count(*) FILTER (WHERE destination IS NULL) FROM fact"),
    _check("not_null", "dm_fact_ticket_offers", "price_rub", "error",
           "SELECT count(*) FILTER (WHERE price_rub IS NULL) FROM fact"),
    _check("not_null", "dm_prices_latest", "price_rub", "error",
           "SELECT count(*) FILTER (WHERE price_rub IS NULL) FROM latest"),
    _check("not_null", "dm_prices_agg_route", "avg_price_rub", "warn",
           "SELECT count(*) FILTER (WHERE a IS NULL) FROM (SELECT avg(price_rub) AS a FROM fact "
           "GROUP BY origin, destination)"),
    _check("not_null", "dm_airports", "airport_code", "error",
           "SELECT count(*) FILTER (WHERE airport_code IS NULL) FROM (SELECT origin_airport AS airport_code "
           "FROM fact UNION SELECT destination_airport FROM fact)"),
]
UNIQUE_ROW = _check("unique", "stg_ticket_offers", "doc_id", "error",
                    "SELECT count(*) FROM (SELECT doc_id FROM stg WHERE doc_id IS NOT NULL "
                    "GROUP BY doc_id HAVING count(*) > 1)")
REL_ROW = _check("relationships", "dm_prices_latest", "doc_id", "error",
                 "SELECT count(*) FROM latest WHERE doc_id IS NOT NULL AND doc_id NOT IN "
                 "(SELECT doc_id FROM fact WHERE doc_id IS NOT NULL)")
RANGE_ROW = _check("accepted_range", "dm_fact_ticket_offers", "price_rub", "error",
                   "SELECT count(*) FILTER (WHERE NOT (price_rub >= 0)) FROM fact")
FRESH_ROW = f"""
SELECT 'freshness' AS test, 'raw_api_log' AS model, 'updated_at' AS "column",
       CASE WHEN m IS NULL OR {RUN_TS} - INTERVAL 2 DAY > m THEN 'error'
            WHEN {RUN_TS} - INTERVAL 1 DAY > m THEN 'warn' ELSE 'none' END AS severity,
       'dqc' AS tags,
       CAST(CASE WHEN m IS NULL OR {RUN_TS} - INTERVAL 1 DAY > m THEN 1 ELSE 0 END AS BIGINT) AS failures,
       CASE WHEN m IS NULL OR {RUN_TS} - INTERVAL 2 DAY > m THEN 'fail'
            WHEN {RUN_TS} - INTERVAL 1 DAY > m THEN 'warn' ELSE 'pass' END AS status,
       CAST(CAST(epoch({RUN_TS}) - epoch(m) AS BIGINT) AS VARCHAR) AS detail
FROM (SELECT max(updated_at) AS m FROM stg)
"""

ORACLE["dq_not_null"] = DQ_CTE + "\nUNION ALL\n".join(NOT_NULL_ROWS)
ORACLE["dq_unique"] = DQ_CTE + UNIQUE_ROW
ORACLE["dq_relationships"] = DQ_CTE + REL_ROW
ORACLE["dq_accepted_range"] = DQ_CTE + RANGE_ROW
ORACLE["dq_freshness"] = DQ_CTE + FRESH_ROW

METRIC_SRC = """
src AS (
  SELECT ts, event_type, value, user_id,
         ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS updated_ts
  FROM events)
"""


def _secs(period: str) -> int:
    n, unit = period.split()
    return int(n) * {"hour": 3600, "day": 86400, "minute": 60}[unit.rstrip("s")]


def anomaly_sql(name, test, metrics_cte, series_expr, ts_col, period, delay, detection,
                training=14, sensitivity=3.0, src="src"):
    """Scored anomaly rows: ``metrics_cte`` defines ``m(series, bucket_start, value)``
    over the complete buckets ``bc``; spine per series from its first bucket."""
    p = _secs(period)
    cut = f"max({ts_col})" + (f" - INTERVAL {_secs(delay)} SECOND" if delay else "")
    det = (f"WHERE bucket_start >= (SELECT c FROM cut) - INTERVAL {_secs(detection)} SECOND"
           if detection else "")
    return f"""
{name}_cut AS (SELECT {cut} AS c FROM {src}),
{name}_bc AS (
  SELECT *, to_timestamp(floor(epoch({ts_col}) / {p}) * {p})::TIMESTAMP AS bucket_start FROM {src}
  WHERE {ts_col} IS NOT NULL),
{name}_m AS ({metrics_cte.format(bc=f"(SELECT * FROM {name}_bc WHERE bucket_start + INTERVAL {p} SECOND <= (SELECT c FROM {name}_cut))")}),
{name}_first AS (SELECT series, min(bucket_start) AS f FROM {name}_m GROUP BY series),
{name}_last AS (SELECT to_timestamp(floor(epoch(c - INTERVAL {p} SECOND) / {p}) * {p})::TIMESTAMP AS l FROM {name}_cut),
{name}_sp AS (SELECT series, unnest(generate_series(f, (SELECT l FROM {name}_last), INTERVAL {p} SECOND)) AS bucket_start
              FROM {name}_first),
{name}_full AS (SELECT sp.series, sp.bucket_start, {series_expr} AS value
                FROM {name}_sp sp LEFT JOIN {name}_m m USING (series, bucket_start)),
{name}_sc AS (
  SELECT *, avg(value) OVER w AS training_mean, stddev_samp(value) OVER w AS training_stddev,
         count(value) OVER w AS training_n
  FROM {name}_full
  WINDOW w AS (PARTITION BY series ORDER BY bucket_start ROWS BETWEEN {training} PRECEDING AND 1 PRECEDING)),
{name} AS (
  SELECT '{test}' AS test, series, bucket_start, round(value, 6) AS value,
         round(training_mean, 6) AS training_mean, round(training_stddev, 6) AS training_stddev,
         training_n,
         round(CASE WHEN training_n >= 3 AND value IS NOT NULL AND training_stddev > 0
                    THEN (value - training_mean) / training_stddev END, 6) AS z_score,
         CASE WHEN training_n < 3 OR value IS NULL THEN false
              WHEN coalesce(training_stddev, 0) > 0 THEN abs(value - training_mean) > {sensitivity} * training_stddev
              ELSE abs(value - training_mean) > 0 END AS is_anomalous
  FROM {name}_sc {det.replace('(SELECT c FROM cut)', f'(SELECT c FROM {name}_cut)')})
"""


def _num_metrics(c):
    return [(f"{c}::min", f"CAST(min({c}) AS DOUBLE)"), (f"{c}::max", f"CAST(max({c}) AS DOUBLE)"),
            (f"{c}::average", f"avg({c})"), (f"{c}::standard_deviation", f"stddev_samp({c})"),
            (f"{c}::null_count", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"),
            (f"{c}::null_percent", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100"),
            (f"{c}::zero_count", f"CAST(count(*) FILTER (WHERE {c} = 0) AS DOUBLE)")]


def _text_metrics(c):
    return [(f"{c}::null_count", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"),
            (f"{c}::null_percent", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100"),
            (f"{c}::min_length", f"CAST(min(length({c})) AS DOUBLE)"),
            (f"{c}::max_length", f"CAST(max(length({c})) AS DOUBLE)"),
            (f"{c}::average_length", f"avg(length({c}))"),
            (f"{c}::missing_count", f"CAST(count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS DOUBLE)")]


def _long_metrics(metrics):
    return "\n  UNION ALL ".join(
        f"SELECT '{n}' AS series, bucket_start, {e} AS value FROM {{bc}} GROUP BY bucket_start"
        for n, e in metrics)


ANOMALY_PARTS = {
    "dq_volume": anomaly_sql(
        "vol", "volume_anomalies",
        "SELECT '' AS series, bucket_start, CAST(count(*) AS DOUBLE) AS value FROM {bc} GROUP BY bucket_start",
        "coalesce(m.value, 0)", "ts", "12 hours", "12 hours", "14 days"),
    "dq_freshness_anomaly": anomaly_sql(
        "frs", "freshness_anomalies",
        "SELECT '' AS series, bucket_start, max(coalesce(gap, 0)) AS value FROM ("
        "SELECT bucket_start, epoch_us(updated_ts) / 1e6 - lag(epoch_us(updated_ts) / 1e6) OVER (ORDER BY updated_ts) AS gap "
        "FROM (SELECT DISTINCT updated_ts, bucket_start FROM {bc})) GROUP BY bucket_start",
        "m.value", "updated_ts", "12 hours", "12 hours", "7 days"),
    "dq_event_freshness": anomaly_sql(
        "evf", "event_freshness_anomalies",
        "SELECT '' AS series, bucket_start, max((epoch_us(updated_ts) - epoch_us(ts)) / 1e6) AS value "
        "FROM {bc} GROUP BY bucket_start",
        "m.value", "ts", "12 hours", "12 hours", None),
    "dq_dimension": anomaly_sql(
        "dim", "dimension_anomalies",
        "SELECT coalesce(CAST(event_type AS VARCHAR), '<null>') AS series, bucket_start, "
        "CAST(count(*) AS DOUBLE) AS value FROM {bc} GROUP BY 1, 2",
        "coalesce(m.value, 0)", "ts", "12 hours", "12 hours", "14 days"),
    "dq_column": anomaly_sql(
        "col", "column_anomalies", _long_metrics(_num_metrics("value")),
        "m.value", "ts", "12 hours", "12 hours", "14 days"),
    "dq_all_columns": anomaly_sql(
        "alc", "all_columns_anomalies",
        _long_metrics(_text_metrics("event_type") + _num_metrics("value") + _num_metrics("user_id")),
        "m.value", "ts", "1 day", None, "14 days"),
}
ANOMALY_NAMES = {"dq_volume": "vol", "dq_freshness_anomaly": "frs", "dq_event_freshness": "evf",
                 "dq_dimension": "dim", "dq_column": "col", "dq_all_columns": "alc"}

for _k, _cte in ANOMALY_PARTS.items():
    ORACLE[_k] = f"WITH {METRIC_SRC}, {_cte} SELECT * FROM {ANOMALY_NAMES[_k]}"

_summaries = "\nUNION ALL\n".join(
    f"SELECT test, 'events' AS model, CAST(NULL AS VARCHAR) AS \"column\", 'warn' AS severity, "
    f"'dqc' AS tags, count(*) FILTER (WHERE is_anomalous) AS failures, "
    f"CASE WHEN count(*) FILTER (WHERE is_anomalous) = 0 THEN 'pass' ELSE 'warn' END AS status, "
    f"count(*) || ' buckets' AS detail FROM {n} GROUP BY test"
    for n in ANOMALY_NAMES.values())

ORACLE["dq_report"] = (DQ_CTE + ", " + METRIC_SRC + ", " + ", ".join(ANOMALY_PARTS.values())
                       + "\n" + "\nUNION ALL\n".join(
                           NOT_NULL_ROWS + [UNIQUE_ROW, REL_ROW, RANGE_ROW, f"SELECT * FROM ({FRESH_ROW})"])
                       + "\nUNION ALL\n" + _summaries)

# The checks declared on the models.
def _other_metrics(c):
    return [(f"{c}::null_count", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"),
            (f"{c}::null_percent", f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) * 100")]


LATEST_METRICS = {
    _num_metrics: "status_code price_rub duration_min transfers_cnt duration_to_min duration_back_min "
                  "return_transfers_cnt rn",
    _text_metrics: "doc_id link endpoint currency origin origin_airport destination destination_airport airline "
                   "flight_number price_bucket departure_weekday_short departure_weekday_full "
                   "search_weekday_short search_weekday_full",
    _other_metrics: "batch_started_at error updated_at processed_src_dttm processed_at req_departure_month "
                    "departure_at_utc search_date is_direct departure_date departure_month",
}
COUNT_M = "SELECT '' AS series, bucket_start, CAST(count(*) AS DOUBLE) AS value FROM {bc} GROUP BY bucket_start"
MODEL_ANOMALIES = [
    ("mvol", "dm_fact_ticket_offers", None, anomaly_sql(
        "mvol", "volume_anomalies", COUNT_M, "coalesce(m.value, 0)", "created_at", "12 hours", "12 hours", "14 days",
        src="fact")),
    ("mfrs", "dm_fact_ticket_offers", None, anomaly_sql(
        "mfrs", "freshness_anomalies",
        "SELECT '' AS series, bucket_start, max(coalesce(gap, 0)) AS value FROM ("
        "SELECT bucket_start, epoch_us(created_at) / 1e6 - lag(epoch_us(created_at) / 1e6) OVER (ORDER BY created_at) AS gap "
        "FROM (SELECT DISTINCT created_at, bucket_start FROM {bc})) GROUP BY bucket_start",
        "m.value", "created_at", "12 hours", "12 hours", "7 days", src="fact")),
    ("mevf", "dm_fact_ticket_offers", None, anomaly_sql(
        "mevf", "event_freshness_anomalies",
        "SELECT '' AS series, bucket_start, max((epoch_us(processed_src_dttm) - epoch_us(created_at)) / 1e6) AS value "
        "FROM {bc} GROUP BY bucket_start", "m.value", "created_at", "12 hours", "12 hours", None, src="fact")),
    ("mdim", "dm_fact_ticket_offers", None, anomaly_sql(
        "mdim", "dimension_anomalies",
        "SELECT concat_ws('|', " + ", ".join(
            f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in
            ("status_code", "endpoint", "currency", "price_bucket", "transfers_cnt", "is_direct"))
        + ") AS series, bucket_start, CAST(count(*) AS DOUBLE) AS value FROM {bc} GROUP BY 1, 2",
        "coalesce(m.value, 0)", "created_at", "12 hours", "12 hours", "14 days", src="fact")),
    ("mcol", "dm_fact_ticket_offers", "price_rub", anomaly_sql(
        "mcol", "column_anomalies", _long_metrics(_num_metrics("price_rub")), "m.value", "created_at",
        "12 hours", "12 hours", "14 days", src="fact")),
    ("malc", "dm_prices_latest", None, anomaly_sql(
        "malc", "all_columns_anomalies",
        _long_metrics([m for kind, names in LATEST_METRICS.items() for c in names.split() for m in kind(c)]),
        "m.value", "created_at", "1 day", None, "14 days", src="latest")),
    ("msea", "dm_prices_agg_search_dep_route", None, anomaly_sql(
        "msea", "volume_anomalies", COUNT_M, "coalesce(m.value, 0)", "search_date", "1 day", None, "7 days",
        src="search_mart")),
    ("mdep", "dm_prices_agg_dep_route", "avg_price_rub", anomaly_sql(
        "mdep", "column_anomalies", _long_metrics(_num_metrics("avg_price_rub")), "m.value", "departure_date",
        "1 day", None, "7 days", src="dep_mart")),
]

MODEL_MARTS = """,
search_mart AS (SELECT CAST(search_date AS TIMESTAMP) AS search_date, departure_date, origin, destination
                FROM fact GROUP BY ALL),
dep_mart AS (SELECT CAST(departure_date AS TIMESTAMP) AS departure_date, origin, destination,
                    avg(price_rub) AS avg_price_rub FROM fact GROUP BY departure_date, origin, destination),
""" + ", ".join(sql for *_, sql in MODEL_ANOMALIES)
MODEL_ANOMALY_ROWS = "\nUNION ALL\n".join(
    f"SELECT test, '{model}' AS model, CAST({repr(column) if column else 'NULL'} AS VARCHAR) AS \"column\", "
    f"'warn' AS severity, 'dqc' AS tags, count(*) FILTER (WHERE is_anomalous) AS failures, "
    f"CASE WHEN count(*) FILTER (WHERE is_anomalous) = 0 THEN 'pass' ELSE 'warn' END AS status, "
    f"count(*) || ' buckets' AS detail FROM {name} GROUP BY test"
    for name, model, column, _ in MODEL_ANOMALIES)

ORACLE["dq_models"] = DQ_CTE + MODEL_MARTS + MODEL_ANOMALY_ROWS

# The same checks on the models as three runs leave them.
ORACLE["dq_incremental"] = EVENT_OFFERS + LATEST_RUNS + """,
latest AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)""" + MODEL_MARTS + "\nUNION ALL\n".join(
    [row for row in NOT_NULL_ROWS if "'dm_fact_ticket_offers'" in row or "'dm_prices_latest'" in row]
    + [RANGE_ROW, MODEL_ANOMALY_ROWS])

_MISSES = [("response", r, f"SELECT count(*) FROM docs WHERE {cond}") for r, cond in (
    ("text", "event_type = 'error'"), ("no_data", "event_type = 'signup'"), ("not_array", "false"),
    ("empty", "is_success AND n_offers = 0"))]
_MISSES += [("cast", f, "SELECT 0") for f in (
    "price", "duration", "transfers", "duration_to", "duration_back", "return_transfers", "departure_at")]
ORACLE["dq_misses"] = f"WITH {EVENT_DOCS} " + "\nUNION ALL\n".join(
    _check(f"{column}_{reason}", "stg_ticket_offers", column, "warn", sql) for column, reason, sql in _MISSES)

ORACLE["stream_ingest"] = ORACLE["scd2_history"]
ORACLE["stream_lookback"] = ORACLE["el_lookback"]

ORACLE["compacted_since"] = f"""
WITH {EVENT_DOCS}
SELECT doc_id, event_id, created_at AS loaded_at FROM docs
WHERE created_at >= (SELECT max(created_at) FROM docs) - INTERVAL 1 DAY
"""
