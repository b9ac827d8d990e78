"""Independent SQL (DuckDB dialect) for every named query, over the raw test tables.

Written straight from the job's semantics, step by step, with window functions on one
node; it shares no code with the Spark plans. The fixture views of FIXTURES.md are the
first CTEs. Window: [19950103, 20010101).
"""

from __future__ import annotations

LO, HI = 19950103, 20010101

FIXTURE_CTES = f"""
hits AS (
  SELECT CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS visit_return_count,
         'V' || CAST(l_orderkey AS VARCHAR) AS post_visid_combined,
         l_shipdate AS time_stamp,
         year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS dt_key,
         CASE WHEN l_linenumber = 7 THEN 'P' || CAST(l_partkey AS VARCHAR) || ',shipping-handling'
              ELSE ' p' || CAST(l_partkey AS VARCHAR) || ' ,P' || CAST(l_partkey + 50 AS VARCHAR) || ', ,' END AS prod_list,
         CASE WHEN l_discount = 0 THEN 'NOACCT' ELSE ' A' || CAST(l_suppkey AS VARCHAR) || ' |x|y' END AS demandbase
  FROM lineitem),
visit_sessions AS (
  SELECT CAST(0 AS BIGINT) AS visit_return_count, 'V' || CAST(o_orderkey AS VARCHAR) AS post_visid_combined,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
              THEN -CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) ELSE o_orderkey * 2 END AS visit_session_key
  FROM orders
  UNION ALL
  SELECT CAST(1 AS BIGINT), 'V' || CAST(o_orderkey AS VARCHAR),
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
              THEN -CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) ELSE o_orderkey * 2 + 1 END
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')),
prod_feature AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS sku_nbr, 'G' || CAST(CAST(floor(p_partkey / 50) AS BIGINT) AS VARCHAR) AS size_grp
  FROM part WHERE p_size > 10
  UNION ALL
  SELECT 'P' || CAST(p_partkey AS VARCHAR), 'G' || CAST(CAST(floor(p_partkey / 50) AS BIGINT) + 1 AS VARCHAR)
  FROM part WHERE p_size > 10 AND p_type = 'PROMO' AND p_brand = 'Brand#1'
  UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), 'T' FROM part WHERE p_size = 3
  UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), NULL FROM part WHERE p_size = 4),
products AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS sku,
         CASE WHEN p_size = 50 THEN 'D' WHEN p_size = 49 THEN NULL ELSE 'S' END AS stk_type_cd
  FROM part),
invoices AS (
  SELECT 'P' || CAST(l_partkey AS VARCHAR) AS sku,
         year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS dt_key,
         CASE WHEN l_returnflag = 'R' AND l_linenumber <= 5
              THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * -3 AS DECIMAL(18,2))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amt
  FROM lineitem)"""

CLICK_CTES = f"""
pulled AS (
  SELECT vs.visit_session_key AS session_key, h.post_visid_combined AS visit_id,
         h.visit_return_count AS visit_number, upper(trim(h.prod_list)) AS prod_list, h.time_stamp,
         trim(regexp_extract(trim(h.demandbase), '^([^|]*)[|]', 1)) AS account_no
  FROM hits h LEFT JOIN visit_sessions vs
    ON vs.visit_return_count = h.visit_return_count AND vs.post_visid_combined = h.post_visid_combined
  WHERE h.dt_key < {HI} AND h.dt_key >= {LO}
    AND h.post_visid_combined IS NOT NULL AND h.prod_list IS NOT NULL
    AND h.prod_list NOT LIKE '%shipping-handling%'
    AND trim(regexp_extract(trim(h.demandbase), '^([^|]*)[|]', 1)) <> ''),
hits_parsed AS (
  SELECT DISTINCT session_key, visit_id, visit_number, time_stamp, account_no, trim(u.p) AS prod_id
  FROM pulled, unnest(string_split(prod_list, ',')) AS u(p)
  WHERE trim(u.p) IS NOT NULL AND trim(u.p) <> ''),
discontinued AS (SELECT sku AS prod_id FROM products WHERE stk_type_cd = 'D'),
clicks_active AS (
  SELECT * FROM hits_parsed c WHERE NOT EXISTS (SELECT 1 FROM discontinued d WHERE d.prod_id = c.prod_id)),
group_map AS (
  SELECT DISTINCT upper(sku_nbr) AS prod_id, size_grp AS coupon FROM prod_feature
  WHERE size_grp IS NOT NULL AND size_grp <> 'T'),
clicks_grouped AS (
  SELECT c.*, coalesce(g.coupon, c.prod_id) AS coupon FROM clicks_active c LEFT JOIN group_map g ON c.prod_id = g.prod_id),
group_keys AS (
  SELECT prod_id, coupon, dense_rank() OVER (ORDER BY coupon) AS coupon_key
  FROM (SELECT DISTINCT prod_id, coupon
        FROM (SELECT prod_id, coupon FROM group_map UNION ALL SELECT prod_id, coupon FROM clicks_grouped)
        WHERE prod_id IS NOT NULL)),
clicks_keyed AS (
  SELECT c.*, k.coupon_key FROM clicks_grouped c LEFT JOIN group_keys k ON c.prod_id = k.prod_id AND c.coupon = k.coupon),
session_stats AS (
  SELECT session_key, count(DISTINCT prod_id) AS prod_count, count(DISTINCT coupon) AS coupon_count
  FROM clicks_keyed GROUP BY session_key),
sessions_kept AS (SELECT * FROM session_stats WHERE coupon_count <= 30 AND coupon_count > 1 AND prod_count > 1),
baskets AS (
  SELECT c.session_key AS basket_key, c.visit_id, c.visit_number, c.time_stamp, c.account_no, c.prod_id,
         c.coupon, c.coupon_key, s.prod_count, s.coupon_count
  FROM clicks_keyed c JOIN sessions_kept s ON c.session_key = s.session_key)"""

SALES_CTES = f"""
sku_sales AS (
  SELECT upper(i.sku) AS prod_id, CAST(sum(i.amt) AS DECIMAL(38,2)) AS sales
  FROM invoices i JOIN products p ON p.sku = i.sku
  WHERE i.dt_key < {HI} AND i.dt_key >= {LO} AND i.sku IS NOT NULL AND p.stk_type_cd <> 'D'
  GROUP BY upper(i.sku)),
sku_sales_all AS (
  SELECT upper(sku) AS prod_id, CAST(sum(amt) AS DECIMAL(38,2)) AS sales FROM invoices
  WHERE dt_key < {HI} AND dt_key >= {LO} AND sku IS NOT NULL GROUP BY upper(sku)),
viewed AS (SELECT DISTINCT prod_id FROM clicks_grouped),
sales_viewed AS (SELECT * FROM sku_sales WHERE prod_id IN (SELECT prod_id FROM viewed)),
sales_grouped AS (
  SELECT s.prod_id, s.sales, coalesce(k.coupon, s.prod_id) AS coupon, k.coupon_key
  FROM sales_viewed s LEFT JOIN group_keys k ON s.prod_id = k.prod_id),
group_sales AS (
  SELECT coupon, coupon_key, CAST(sum(sales) AS DECIMAL(38,2)) AS coupon_sales FROM sales_grouped
  GROUP BY coupon, coupon_key HAVING sum(sales) > 0),
sales_all_viewed AS (SELECT * FROM sku_sales_all WHERE prod_id IN (SELECT prod_id FROM viewed)),
sales_grouped_inner AS (
  SELECT s.prod_id, s.sales, coalesce(k.coupon, s.prod_id) AS coupon, k.coupon_key
  FROM sales_all_viewed s JOIN group_keys k ON s.prod_id = k.prod_id),
group_sales_inner AS (
  SELECT coupon, coupon_key, CAST(sum(sales) AS DECIMAL(38,2)) AS coupon_sales FROM sales_grouped_inner
  GROUP BY coupon, coupon_key HAVING sum(sales) > 0)"""


def matrix_ctes(p: str, source: str, t: float = 20) -> str:
    """Pair-matrix CTEs named ``<p>...`` over a relation with basket_key, coupon, coupon_key."""
    return f"""
{p}coupon_data AS (SELECT DISTINCT coupon_key, coupon, basket_key FROM {source}),
{p}total AS (SELECT count(DISTINCT basket_key) AS n FROM {source}),
{p}group_basket_counts AS (
  SELECT coupon_key, coupon, count(DISTINCT basket_key) AS basket_count FROM {source} GROUP BY coupon_key, coupon),
{p}threshold AS (SELECT greatest(quantile_cont(basket_count, {t / 100.0}), 1.0) AS thr FROM {p}group_basket_counts),
{p}frequent_groups AS (
  SELECT g.* FROM {p}group_basket_counts g, {p}threshold t WHERE g.basket_count > t.thr),
{p}sides AS (
  SELECT c.coupon_key, c.coupon, c.basket_key, f.basket_count
  FROM {p}coupon_data c JOIN {p}frequent_groups f ON c.coupon_key = f.coupon_key),
{p}pair_counts AS (
  SELECT x.coupon_key AS coupon_key_X, x.coupon AS coupon_X, y.coupon_key AS coupon_key_Y, y.coupon AS coupon_Y,
         x.basket_count AS basket_count_X, y.basket_count AS basket_count_Y,
         count(DISTINCT x.basket_key) AS basket_count_XY
  FROM {p}sides x JOIN {p}sides y ON x.basket_key = y.basket_key AND x.coupon_key <> y.coupon_key
  GROUP BY x.coupon_key, x.coupon, y.coupon_key, y.coupon, x.basket_count, y.basket_count),
{p}pair_matrix AS (
  SELECT q.*, q.basket_count_XY / q.basket_count_X AS confidence,
         q.basket_count_XY / q.basket_count_X / q.basket_count_Y * t.n AS lift,
         q.basket_count_XY / t.n AS support
  FROM {p}pair_counts q, {p}total t)"""


RECOMMEND_CTES = """
pairs_confident AS (
  SELECT * FROM pair_matrix WHERE confidence >= 0.2
    AND coupon_key_X IN (SELECT coupon_key FROM group_sales) AND coupon_key_Y IN (SELECT coupon_key FROM group_sales)),
sku_basket_counts AS (
  SELECT prod_id, coupon_key, count(DISTINCT basket_key) AS sku_basket_count FROM baskets GROUP BY prod_id, coupon_key),
sku_pairs_scored AS (
  SELECT m.*, px.prod_id AS sku_X, coalesce(px.sku_basket_count, 0) AS sku_basket_count_X,
         py.prod_id AS sku_Y, coalesce(py.sku_basket_count, 0) AS sku_basket_count_Y,
         coalesce(sx.sales, CAST(0 AS DECIMAL(38,2))) AS sku_sales_X,
         coalesce(sy.sales, CAST(0 AS DECIMAL(38,2))) AS sku_sales_Y,
         coalesce(py.sku_basket_count, 0) * m.confidence AS cvm_score
  FROM pairs_confident m
  LEFT JOIN sku_basket_counts px ON m.coupon_key_X = px.coupon_key
  LEFT JOIN sku_basket_counts py ON m.coupon_key_Y = py.coupon_key
  LEFT JOIN sales_viewed sx ON px.prod_id = sx.prod_id
  LEFT JOIN sales_viewed sy ON py.prod_id = sy.prod_id),
sku_ranked AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY sku_X
                 ORDER BY cvm_score DESC, sku_basket_count_Y DESC, sku_sales_Y DESC) AS BIGINT) AS cvm_rank
  FROM sku_pairs_scored),
sku_topk AS (SELECT * FROM sku_ranked WHERE cvm_rank <= 35),
rec_lists AS (SELECT sku_X, string_agg(sku_Y, '|' ORDER BY cvm_rank, sku_Y) AS recs FROM sku_topk GROUP BY sku_X)"""


def detail_select(master_id: int) -> str:
    return f"""SELECT CAST({master_id} AS BIGINT) AS MASTER_ID,
       CAST(row_number() OVER (ORDER BY sku_X, cvm_rank, sku_Y, coupon_key_X, coupon_key_Y) AS BIGINT) AS RECORD_ID,
       -2190 AS TIME_PRD_VAL, 'CVM' AS MODEL_TYPE, 'CVM_v1.0' AS MODEL_NAME,
       sku_X AS SKU_X, coupon_X AS COUPON_X, sku_Y AS SKU_Y, coupon_Y AS COUPON_Y,
       basket_count_XY AS BASKET_COUNT_XY, basket_count_X AS BASKET_COUNT_X, basket_count_Y AS BASKET_COUNT_Y,
       sku_basket_count_X AS SKU_BASKET_COUNT_X, sku_basket_count_Y AS SKU_BASKET_COUNT_Y,
       sku_sales_X AS SKU_SALES_X, sku_sales_Y AS SKU_SALES_Y, confidence AS CONFIDENCE, cvm_rank AS CVM_RANK,
       '{HI}' AS START_DATE, '{LO}' AS END_DATE
FROM sku_topk"""


CCG_CTES = """
ccg_sales_sku AS (SELECT DISTINCT prod_id, sales FROM sales_grouped_inner),
ccg_pairs AS (
  SELECT * FROM pair_matrix WHERE confidence >= 0.2
    AND coupon_key_X IN (SELECT coupon_key FROM group_sales_inner)
    AND coupon_key_Y IN (SELECT coupon_key FROM group_sales_inner)),
ccg_scored AS (
  SELECT m.*, px.prod_id AS sku_X, coalesce(px.sku_basket_count, 0) AS sku_basket_count_X,
         py.prod_id AS sku_Y, coalesce(py.sku_basket_count, 0) AS sku_basket_count_Y,
         coalesce(sx.sales, CAST(0 AS DECIMAL(38,2))) AS sku_sales_X,
         coalesce(sy.sales, CAST(0 AS DECIMAL(38,2))) AS sku_sales_Y,
         coalesce(py.sku_basket_count, 0) * m.confidence AS cvm_score
  FROM ccg_pairs m
  LEFT JOIN sku_basket_counts px ON m.coupon_key_X = px.coupon_key
  LEFT JOIN sku_basket_counts py ON m.coupon_key_Y = py.coupon_key
  LEFT JOIN ccg_sales_sku sx ON px.prod_id = sx.prod_id
  LEFT JOIN ccg_sales_sku sy ON py.prod_id = sy.prod_id),
ccg_ranked AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY sku_X
                 ORDER BY cvm_score DESC, sku_basket_count_Y DESC, sku_sales_Y DESC) AS BIGINT) AS cvm_rank
  FROM ccg_scored)"""

def permutation_ctes(p: str, seed: int) -> str:
    return f"""
{p}left AS (SELECT basket_key, row_number() OVER (ORDER BY basket_key, prod_id, coupon_key) AS idx FROM baskets),
{p}right AS (
  SELECT prod_id, coupon_key, coupon,
         row_number() OVER (ORDER BY md5('{seed}|' || CAST(basket_key AS VARCHAR) || '|' || prod_id || '|' || CAST(coupon_key AS VARCHAR)),
                            basket_key, prod_id, coupon_key) AS idx
  FROM baskets),
{p}baskets AS (
  SELECT l.basket_key, r.prod_id, r.coupon_key, r.coupon FROM {p}left l JOIN {p}right r ON l.idx = r.idx)"""


ORDER_BRAND_CTES = """
ob_rows AS (
  SELECT l.l_orderkey AS basket_key, CAST(l.l_partkey AS VARCHAR) AS prod_id, p.p_brand AS coupon
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
ob_keys AS (SELECT coupon, dense_rank() OVER (ORDER BY coupon) AS coupon_key FROM (SELECT DISTINCT coupon FROM ob_rows)),
ob_baskets AS (SELECT r.basket_key, r.prod_id, r.coupon, k.coupon_key FROM ob_rows r JOIN ob_keys k ON r.coupon = k.coupon)"""

MONTH_PART_CTES = """
mp_baskets AS (
  SELECT CAST(l_suppkey * 1000000 + year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS basket_key,
         CAST(l_partkey AS VARCHAR) AS prod_id, 'P' || CAST(l_partkey AS VARCHAR) AS coupon, CAST(l_partkey AS BIGINT) AS coupon_key
  FROM lineitem)"""

DAY_PART_CTES = """
dp_baskets AS (
  SELECT CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS BIGINT) AS basket_key,
         CAST(l_partkey AS VARCHAR) AS prod_id, 'P' || CAST(l_partkey AS VARCHAR) AS coupon, CAST(l_partkey AS BIGINT) AS coupon_key
  FROM lineitem)"""

ALL_CTES = ",".join(
    [
        FIXTURE_CTES,
        CLICK_CTES,
        SALES_CTES,
        matrix_ctes("", "baskets"),
        RECOMMEND_CTES,
        CCG_CTES,
        permutation_ctes("perm_", 42),
        matrix_ctes("perm_", "perm_baskets"),
        *[x for k in (1, 2) for x in (permutation_ctes(f"perm{k}_", 42 + k), matrix_ctes(f"perm{k}_", f"perm{k}_baskets"))],
        MONTH_PART_CTES,
        matrix_ctes("mp_", "mp_baskets"),
        ORDER_BRAND_CTES,
        matrix_ctes("ob_", "ob_baskets"),
    ]
)


def _with(select: str) -> str:
    return f"WITH {ALL_CTES}\n{select}"


MATRIX_COLS = (
    "coupon_key_X, coupon_X, coupon_key_Y, coupon_Y, basket_count_X, basket_count_Y, basket_count_XY, "
    "confidence, lift, support"
)


def window_ctes(lo: int, hi: int) -> str:
    """The CTEs up to the pair matrix for another window."""
    clicks = CLICK_CTES.replace(str(HI), str(hi)).replace(str(LO), str(lo))
    return ",".join([FIXTURE_CTES, clicks, matrix_ctes("", "baskets")])


def oracle_sql() -> dict[str, str]:
    q = {
        name: _with(f"SELECT * FROM {name}")
        for name in (
            "hits_parsed",
            "clicks_active",
            "clicks_grouped",
            "group_keys",
            "session_stats",
            "sessions_kept",
            "baskets",
            "sku_sales",
            "sku_sales_all",
            "group_sales",
            "group_sales_inner",
            "group_basket_counts",
            "frequent_groups",
            "pair_matrix",
            "pairs_confident",
            "sku_basket_counts",
            "sku_pairs_scored",
            "sku_topk",
            "rec_lists",
            "ccg_ranked",
        )
    }
    q["pair_matrix_selfjoin"] = q["pair_matrix"]
    q["pairs_confident_pushed"] = q["pairs_confident"]
    q["sku_topk_full_expansion"] = q["sku_topk"]
    q["published_detail"] = _with(detail_select(1))
    q["published_csv_roundtrip"] = q["rec_lists"]
    q["archive_overwrite_roundtrip"] = _with(
        f"SELECT * FROM ({detail_select(1)}) UNION ALL SELECT * FROM ({detail_select(2)})"
    )
    q["run_registry"] = _with(
        f"""SELECT CAST(1 AS BIGINT) AS master_id, 'CVM' AS model_type, 'CVM_v1.0' AS model_subtype,
       -2190 AS time_prd_val, 'LSG' AS division, 'recommendations' AS table_name,
       180 AS train_period, 14 AS predict_period, '{HI}' AS start_predict_date,
       (SELECT count(*) FROM sku_topk) AS record_count"""
    )
    q["publish_after_failed_registry"] = _with(" UNION ALL ".join(f"SELECT * FROM ({detail_select(n)})" for n in (1, 2, 3)))
    # Stops: none, after the rows are written, after the version is named, after the files, after the
    # registry row. A run is read from the version's name on.
    stops = [(0, "none", 1), (1, "rows", 1), (2, "version", 3), (3, "files", 4), (4, "registry", 5)]
    q["publish_stopped_anywhere"] = _with(
        " UNION ALL ".join(
            f"SELECT {run} AS run, '{stop}' AS stopped_after, MASTER_ID, RECORD_ID, SKU_X, SKU_Y FROM ({detail_select(n)})" for run, stop, n in stops
        )
    )
    q["ccg_factorised"] = q["ccg_ranked"]
    q["publish_interleaved"] = q["archive_overwrite_roundtrip"]
    q["run_job"] = q["published_detail"]
    q["ccg_published_csv"] = _with("SELECT sku_X, coupon_X, sku_Y, coupon_Y, basket_count_XY, cvm_rank FROM ccg_ranked")
    q["sku_sales_fine"] = _with(
        f"""SELECT 'P' || CAST(l_partkey AS VARCHAR) AS prod_id,
       CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(5,2)) AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS sales
FROM lineitem JOIN products ON products.sku = 'P' || CAST(l_partkey AS VARCHAR)
WHERE stk_type_cd <> 'D' AND l_shipdate >= DATE '1995-01-03' AND l_shipdate < DATE '2001-01-01' GROUP BY 1"""
    )
    q["check_outcomes"] = _with(
        """SELECT check_name, CASE WHEN ok THEN 'passed' ELSE error END AS outcome FROM (
  SELECT 'group_map' AS check_name, EXISTS (SELECT 1 FROM group_map) AS ok, 'DataValidityError' AS error
  UNION ALL SELECT 'group_map_empty', EXISTS (SELECT 1 FROM prod_feature WHERE size_grp = 'T' AND size_grp <> 'T'), 'DataValidityError'
  UNION ALL SELECT 'sales', EXISTS (SELECT 1 FROM sales_viewed), 'OutputOutOfBoundError'
  UNION ALL SELECT 'sales_empty', false, 'OutputOutOfBoundError'
  UNION ALL SELECT 'coverage', (SELECT min(dt_key) <= 19950102 AND max(dt_key) >= 20001231 FROM hits), 'CoverageError'
  UNION ALL SELECT 'coverage_short', (SELECT min(dt_key) <= 19950102 FROM hits WHERE dt_key >= 19950103), 'CoverageError'
  UNION ALL SELECT 'division', 'XYZ' IN ('LSG', 'CCG'), 'InputNotValidError'
  UNION ALL SELECT 'start_date', try_cast('2001-13-01' AS DATE) IS NOT NULL, 'InputNotValidError')"""
    )
    q["guard_outcomes"] = _with(
        """SELECT check_name, CASE WHEN ok THEN 'passed' ELSE error END AS outcome, ok AS committed FROM (
  SELECT 'hits' AS check_name, (SELECT min(dt_key) <= 19950102 AND max(dt_key) >= 20001231 FROM hits) AND EXISTS (SELECT 1 FROM group_map) AS ok, 'CoverageError' AS error
  UNION ALL SELECT 'group_map_empty', EXISTS (SELECT 1 FROM prod_feature WHERE size_grp = 'T' AND size_grp <> 'T'), 'DataValidityError'
  UNION ALL SELECT 'hits_short', (SELECT min(dt_key) <= 19950102 FROM hits WHERE dt_key >= 19950103 AND dt_key < 20010101), 'CoverageError'
  UNION ALL SELECT 'invoices', (SELECT min(dt_key) <= 19950102 AND max(dt_key) >= 20001231 FROM invoices), 'CoverageError'
  UNION ALL SELECT 'invoices_none', false, 'CoverageError'
  UNION ALL SELECT 'sales', EXISTS (SELECT 1 FROM sales_viewed), 'OutputOutOfBoundError'
  UNION ALL SELECT 'sales_none', false, 'OutputOutOfBoundError'
  UNION ALL SELECT 'confidence', NOT EXISTS (SELECT 1 FROM pair_matrix WHERE confidence < 0 OR confidence > 1), 'OutputOutOfBoundError'
  UNION ALL SELECT 'confidence_high', NOT EXISTS (SELECT 1 FROM pair_matrix WHERE confidence + 1 > 1), 'OutputOutOfBoundError'
  UNION ALL SELECT 'confidence_low', NOT EXISTS (SELECT 1 FROM pair_matrix WHERE -confidence < 0), 'OutputOutOfBoundError')"""
    )
    q["run_report"] = _with(
        """SELECT (SELECT count(*) FROM pair_matrix) AS pairs, (SELECT count(*) FROM pair_matrix WHERE confidence > 1.0) AS confidence_above_1,
       (SELECT count(*) FROM pair_matrix WHERE confidence < 0.0) AS confidence_below_0, (SELECT count(*) FROM baskets) AS basket_rows,
       (SELECT count(*) FROM sales_viewed) AS sku_sales_rows, (SELECT count(*) FROM sku_topk) AS published_rows"""
    )
    q["window_positions"] = " UNION ALL ".join(
        f"SELECT {n} AS position, * FROM (WITH {window_ctes(lo, hi)}\nSELECT coupon_X, coupon_Y, basket_count_X, basket_count_Y, basket_count_XY, confidence, lift, support FROM pair_matrix)"
        for n, (lo, hi) in enumerate(((19950103, 20000103), (19950104, 20000104), (19950203, 20000203)))
    )
    q["window_clicks_by_day"] = f"""WITH {window_ctes(0, 99999999)}
SELECT CAST(year(time_stamp) * 10000 + month(time_stamp) * 100 + day(time_stamp) AS INTEGER) AS dt_key, count(DISTINCT (session_key, prod_id, coupon)) AS clicks,
       count(DISTINCT session_key) AS sessions
FROM clicks_grouped WHERE session_key IS NOT NULL AND time_stamp >= DATE '1995-02-03' AND time_stamp < DATE '1995-03-03' GROUP BY 1"""
    q["permutation_null_multi"] = _with(
        " UNION ALL ".join(f"SELECT {k} AS perm_id, {MATRIX_COLS} FROM perm{k or ''}_pair_matrix" for k in range(3))
    )
    q["month_part_matrix"] = _with("SELECT * FROM mp_pair_matrix")
    q["day_part_matrix"] = f"WITH {DAY_PART_CTES},{matrix_ctes('dp_', 'dp_baskets')}\nSELECT * FROM dp_pair_matrix"
    q["day_pairs_confident"] = f"WITH {DAY_PART_CTES},{matrix_ctes('dp_', 'dp_baskets')}\nSELECT * FROM dp_pair_matrix WHERE confidence >= 0.1"
    q["coverage_check"] = _with(
        """SELECT 'hits' AS table_name, CAST(min(dt_key) AS BIGINT) AS min_key, CAST(max(dt_key) AS BIGINT) AS max_key,
       CAST(19950102 AS BIGINT) AS required_lo, CAST(20001231 AS BIGINT) AS required_hi,
       coalesce(min(dt_key) <= 19950102 AND max(dt_key) >= 20001231, false) AS covered FROM hits
UNION ALL
SELECT 'invoices', CAST(min(dt_key) AS BIGINT), CAST(max(dt_key) AS BIGINT), CAST(19950102 AS BIGINT),
       CAST(20001231 AS BIGINT), coalesce(min(dt_key) <= 19950102 AND max(dt_key) >= 20001231, false) FROM invoices"""
    )
    q["quality_report"] = _with(
        """SELECT (SELECT count(*) FROM pair_matrix) AS pairs,
       (SELECT count(*) FROM pair_matrix WHERE confidence > 1.0) AS confidence_above_1,
       (SELECT count(*) FROM pair_matrix WHERE confidence < 0.0) AS confidence_below_0,
       (SELECT count(*) FROM group_map) AS group_map_rows,
       (SELECT count(*) FROM sales_viewed) AS sales_rows,
       (SELECT count(*) FROM hits_parsed) AS click_rows,
       (SELECT count(*) FROM baskets) AS basket_rows,
       (SELECT count(*) FROM sessions_kept) AS baskets_kept"""
    )
    q["permutation_null"] = _with(f"SELECT 0 AS perm_id, {MATRIX_COLS} FROM perm_pair_matrix")
    q["permutation_threshold"] = _with("SELECT quantile_cont(confidence, 0.95) AS sig_threshold FROM perm_pair_matrix")
    q["order_brand_matrix"] = _with("SELECT * FROM ob_pair_matrix")
    q["clicks_stream"] = q["hits_parsed"]
    return q
