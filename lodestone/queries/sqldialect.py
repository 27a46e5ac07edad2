"""The SQL dialect L1-L28 and native aggregations A1-A6."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators.dialect import SQLQuery
from lodestone.queries.filtering import TAGS, TOKENS, metres
from lodestone.queries.searching import COS, LEGS, hybrid_source
from lodestone.queries.tables import Q0, query_vector, source


def _s(table: str, sql: str, rounded: tuple[str, ...] = (), **params):
    def run(spark, d):
        values = {k: (v(spark, d) if callable(v) else v) for k, v in params.items()}
        out = SQLQuery(sql, values).run(source(spark, d, table))
        return out.withColumns({c: F.round(c, 6) for c in rounded}) if rounded else out

    return run


def _hybrid(sql: str):
    def run(spark, d):
        out = SQLQuery(sql, {"v": query_vector(spark, d)}).run(hybrid_source(spark, d))
        return out.withColumn("score", F.round("score", 6))

    return run


P = f"(' ' || array_to_string({TOKENS.format('p_name')}, ' ') || ' ')"
W = TOKENS.format("p_name")
TS = "TIMESTAMP"

QUERIES = {
    "l1_select": (_s("customer", "SELECT c_custkey, c_acctbal * 2 AS twice, c_name name FROM customer"), "SELECT c_custkey, c_acctbal * 2 AS twice, c_name AS name FROM customer"),
    "l2_tag_predicates": (_s("orders", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus != 'F' OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AND o_orderstatus = 'p'"), "SELECT o_orderkey FROM orders WHERE (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'F') OR (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AND o_orderstatus = 'P')"),
    "l3_numeric_predicates": (_s("lineitem", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45 AND l_discount IN (0.01, 0.02) AND NOT l_tax > 0.04"), "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45 AND l_discount IN (0.01, 0.02) AND NOT l_tax > 0.04"),
    "l4_precedence": (_s("part", "SELECT p_partkey FROM part WHERE (p_size = 1 OR p_size = 2) AND p_retailprice > 1000 OR p_size = 3"), "SELECT p_partkey FROM part WHERE ((p_size = 1 OR p_size = 2) AND p_retailprice > 1000) OR p_size = 3"),
    "l5_text_phrase": (_s("part", "SELECT p_partkey FROM part WHERE p_name = 'small ring'"), f"SELECT p_partkey FROM part WHERE contains({P}, ' small ring ')"),
    "l5_text_ne": (_s("part", "SELECT p_partkey FROM part WHERE p_name != 'small'"), f"SELECT p_partkey FROM part WHERE NOT contains({P}, ' small ')"),
    "l6_text_like": (_s("part", "SELECT p_partkey FROM part WHERE p_name LIKE 'sm%' OR p_name LIKE '%ng' OR p_name NOT LIKE '%r%'"), f"SELECT p_partkey FROM part WHERE len(list_filter({W}, lambda t: t LIKE 'sm%' OR t LIKE '%ng')) > 0 OR len(list_filter({W}, lambda t: t LIKE '%r%')) = 0"),
    "l7_fuzzy": (_s("part", "SELECT p_partkey FROM part WHERE fuzzy(p_name, 'rong')"), f"SELECT p_partkey FROM part WHERE len(list_filter({W}, lambda t: levenshtein(t, 'rong') <= 1)) > 0"),
    "l8_fulltext": (_s("documents", "SELECT doc_id FROM documents WHERE fulltext(text, 'cursor nightly') OR fulltext(text, 'tenant OR comma')"), f"SELECT doc_id FROM documents WHERE (list_contains({TOKENS.format('text')}, 'cursor') AND list_contains({TOKENS.format('text')}, 'nightly')) OR list_contains({TOKENS.format('text')}, 'tenant') OR list_contains({TOKENS.format('text')}, 'comma')"),
    "l9_text_in": (_s("part", "SELECT p_partkey FROM part WHERE p_name IN ('small ring', 'large')"), f"SELECT p_partkey FROM part WHERE contains({P}, ' small ring ') OR contains({P}, ' large ')"),
    "l10_order_by": (_s("customer", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal > 9000 ORDER BY c_nationkey ASC, c_acctbal DESC LIMIT 30"), "SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_acctbal > 9000 ORDER BY c_nationkey, c_acctbal DESC, c_custkey LIMIT 30"),
    "l11_limit_offset": (_s("customer", "SELECT c_custkey FROM customer ORDER BY c_acctbal LIMIT 25 OFFSET 50"), "SELECT c_custkey FROM customer ORDER BY c_acctbal, c_custkey LIMIT 25 OFFSET 50"),
    "l12_group_by": (_s("lineitem", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS q, AVG(l_discount) AS d, MIN(l_tax) AS lo, MAX(l_tax) AS hi FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY l_returnflag, l_linestatus", ("q", "d")), "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 6) AS q, round(avg(l_discount), 6) AS d, min(l_tax) AS lo, max(l_tax) AS hi FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-09-03' GROUP BY 1, 2"),
    "l13_count_distinct": (_s("orders", "SELECT o_orderstatus, COUNT_DISTINCT(o_custkey) AS a, COUNT(DISTINCT o_orderpriority) AS b FROM orders GROUP BY o_orderstatus"), "SELECT o_orderstatus, count(DISTINCT o_custkey) AS a, count(DISTINCT o_orderpriority) AS b FROM orders GROUP BY 1"),
    "l14_stddev": (_s("part", "SELECT p_brand, STDDEV(p_retailprice) AS s FROM part GROUP BY p_brand", ("s",)), "SELECT p_brand, round(stddev_samp(p_retailprice), 6) AS s FROM part GROUP BY 1"),
    "l15_quantile": (_s("part", "SELECT p_brand, QUANTILE(p_size, 0.9) AS q FROM part GROUP BY p_brand", ("q",)), "SELECT p_brand, round(quantile_cont(p_size, 0.9), 6) AS q FROM part GROUP BY 1"),
    "l16_array_agg": (_s("orders", "SELECT o_orderstatus, ARRAY_AGG(o_orderpriority) AS p FROM orders GROUP BY o_orderstatus"), "SELECT o_orderstatus, list_sort(list(DISTINCT o_orderpriority)) AS p FROM orders GROUP BY 1"),
    "l17_first_value": (_s("orders", "SELECT o_orderpriority, FIRST_VALUE(o_totalprice) AS v FROM orders GROUP BY o_orderpriority"), "SELECT o_orderpriority, arg_min(o_totalprice, o_orderkey) AS v FROM orders GROUP BY 1"),
    "l18_distinct": (_s("orders", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"), "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders"),
    "l19_vector_distance": (_s("embeddings", "SELECT vec_id, cosine_distance(embedding, :v) AS dist FROM embeddings WHERE label != 3 LIMIT 12", ("dist",), v=query_vector), f"SELECT vec_id, round({COS}, 6) AS dist FROM embeddings WHERE label <> 3 ORDER BY {COS}, vec_id LIMIT 12"),
    "l20_hybrid": (_hybrid("SELECT doc_id, hybrid_vector_search(cosine_distance(embedding, :v), fulltext(text, 'page cursor nightly run'), rrf(constant => 60, window => 20)) AS score FROM documents LIMIT 10"), f"{LEGS} SELECT k AS doc_id, round(coalesce(1.0 / (60 + tl.r), 0) + coalesce(1.0 / (60 + vl.r), 0), 6) AS score FROM tl FULL JOIN vl USING (k) ORDER BY coalesce(1.0 / (60 + tl.r), 0) + coalesce(1.0 / (60 + vl.r), 0) DESC, k LIMIT 10"),
    "l21_geo_distance": (_s("users", "SELECT user, geo_distance(location, POINT(-70.0, 40.0)) AS m FROM users WHERE geo_distance(location, POINT(-70.0, 40.0), 'km') < 4000", ("m",)), f"SELECT \"user\", round({metres('location.lon', 'location.lat', -70.0, 40.0)}, 6) AS m FROM users WHERE {metres('location.lon', 'location.lat', -70.0, 40.0)} / 1000 < 4000"),
    "l22_dates": (_s("events", "SELECT event_id FROM events WHERE ts BETWEEN '2024-01-03' AND '2024-01-04' OR ts > '2024-01-28'"), f"SELECT event_id FROM events WHERE (ts >= {TS} '2024-01-03' AND ts < {TS} '2024-01-05') OR ts >= {TS} '2024-01-29'"),
    "l23_date_parts": (_s("events", "SELECT YEAR(ts) AS y, MONTH(ts) AS m, DAY(ts) AS d, COUNT(*) AS n FROM events GROUP BY YEAR(ts), MONTH(ts), DAY(ts)"), "SELECT year(ts)::INTEGER AS y, (month(ts) - 1)::INTEGER AS m, day(ts)::INTEGER AS d, count(*) AS n FROM events GROUP BY 1, 2, 3"),
    "l23_date_format": (_s("events", "SELECT event_id, DATE_FORMAT(ts, '%Y-%m-%d %H') AS h FROM events WHERE MONTH(ts) = 0"), "SELECT event_id, strftime(ts, '%Y-%m-%d %H') AS h FROM events WHERE month(ts) = 1"),
    "l24_params": (_s("part", "SELECT p_partkey FROM part WHERE p_brand = :b AND p_size >= :n AND p_name = :t", b="Brand#2", n=20, t="it's ring"), f"SELECT p_partkey FROM part WHERE p_brand = 'Brand#2' AND p_size >= 20 AND contains({P}, ' ring ')"),
    "l25_double_quotes": (_s("events", 'SELECT event_id FROM events WHERE event_type = "click"'), "SELECT event_id FROM events WHERE event_type = 'click'"),
    "l_tag_like": (_s("users", "SELECT user FROM users WHERE credit_score LIKE 'l%' AND age IS NOT NULL"), f"SELECT \"user\" FROM users WHERE len(list_filter({TAGS.format('credit_score')}, lambda t: t LIKE 'l%')) > 0 AND age IS NOT NULL"),
    "a1_apply": (_s("lineitem", "SELECT l_returnflag, SUM(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY l_returnflag ORDER BY revenue DESC LIMIT 2", ("revenue",)), "SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 6) AS revenue FROM lineitem GROUP BY 1 ORDER BY 2 DESC LIMIT 2"),
    "a5_post_filter": (lambda spark, d: SQLQuery("SELECT o_custkey, COUNT(*) AS n, SUM(o_totalprice) AS a FROM orders GROUP BY o_custkey").run(source(spark, d, "orders")).where("n >= 12").withColumn("a", F.round("a", 2)), "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS a FROM orders GROUP BY 1 HAVING count(*) >= 12"),
}
