"""Filters F1-F23."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lodestone.functions.geo import EARTH_M
from lodestone.operators import filters as O
from lodestone.operators.filters import Geo, GeoRadius, Num, Tag, Text, Timestamp
from lodestone.queries.tables import schema, source

TOKENS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '')"
PADDED = f"(' ' || array_to_string({TOKENS}, ' ') || ' ')"


def _q(table: str, build, columns: list[str]):
    return lambda spark, d: (s := source(spark, d, table)).where(build(s)).select(*columns)


def metres(lon: str, lat: str, lon0: float, lat0: float) -> str:
    return (
        f"2 * {EARTH_M} * asin(sqrt(least(1.0, power(sin((radians({lat}) - radians({lat0})) / 2), 2) + "
        f"cos(radians({lat0})) * cos(radians({lat})) * power(sin((radians({lon}) - radians({lon0})) / 2), 2))))"
    )


TAGS = "list_transform(string_split({0}, ','), lambda x: lower(trim(x)))"
OC = ["o_orderkey", "o_totalprice"]
_INSIDE = metres("location.lon", "location.lat", -70.0, 40.0) + " <= 3000000"

QUERIES = {
    "f1_tag_eq": (_q("orders", lambda s: Tag("o_orderpriority") == ["1-URGENT", "5-low", ""], OC), "SELECT o_orderkey, o_totalprice FROM orders WHERE lower(o_orderpriority) IN ('1-urgent', '5-low')"),
    "f1_tag_list_field": (_q("users", lambda s: Tag("credit_score") == "LOW", ["user", "age"]), f"SELECT \"user\", age FROM users WHERE list_contains({TAGS.format('credit_score')}, 'low')"),
    "f2_tag_ne": (_q("users", lambda s: Tag("credit_score") != "high", ["user", "age"]), f"SELECT \"user\", age FROM users WHERE NOT coalesce(list_contains({TAGS.format('credit_score')}, 'high'), FALSE)"),
    "f3_tag_wildcard": (_q("orders", lambda s: Tag("o_orderpriority") % "*urg*|4*", OC), "SELECT o_orderkey, o_totalprice FROM orders WHERE lower(o_orderpriority) LIKE '%urg%' OR o_orderpriority LIKE '4%'"),
    "f4_num_eq_ne": (_q("part", lambda s: (Num("p_size") == 11) | ((Num("p_size") != 12) & (Num("p_size") <= 14)), ["p_partkey", "p_size"]), "SELECT p_partkey, p_size FROM part WHERE p_size = 11 OR (p_size <> 12 AND p_size <= 14)"),
    "f5_num_cmp": (_q("orders", lambda s: (Num("o_totalprice") > 100000) & (Num("o_totalprice") <= 150000.5), OC), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_totalprice <= 150000.5"),
    "f6_num_between": (_q("lineitem", lambda s: Num("l_quantity").between(10, 20, "left"), ["l_orderkey", "l_linenumber", "l_quantity"]), "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 20"),
    "f7_text_phrase": (_q("documents", lambda s: Text("text") == "the page cursor", ["doc_id", "n_chars"]), f"SELECT doc_id, n_chars FROM documents WHERE contains({PADDED.format('text')}, ' the page cursor ')"),
    "f8_text_ne": (_q("part", lambda s: Text("p_name") != "ring", ["p_partkey", "p_name"]), f"SELECT p_partkey, p_name FROM part WHERE NOT coalesce(contains({PADDED.format('p_name')}, ' ring '), FALSE)"),
    "f9_text_pattern": (_q("part", lambda s: Text("p_name") % "sma*|larg* %rinz%", ["p_partkey", "p_name"]), f"SELECT p_partkey, p_name FROM part WHERE len(list_filter({TOKENS.format('p_name')}, lambda t: starts_with(t, 'sma') OR starts_with(t, 'larg'))) > 0 AND len(list_filter({TOKENS.format('p_name')}, lambda t: levenshtein(t, 'rinz') <= 1)) > 0"),
    "f10_geo_radius": (_q("users", lambda s: Geo("location") == GeoRadius(-70.0, 40.0, 3000, "km"), ["user", "age"]), f"SELECT \"user\", age FROM users WHERE {_INSIDE}"),
    "f11_geo_outside": (_q("users", lambda s: Geo("location") != GeoRadius(-70.0, 40.0, 3000, "km"), ["user", "age"]), f"SELECT \"user\", age FROM users WHERE NOT coalesce({_INSIDE}, FALSE)"),
    "f12_timestamp_day": (_q("events", lambda s: Timestamp("ts") == "2024-01-05", ["event_id", "user_id"]), "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'"),
    "f12_timestamp_ne": (_q("events", lambda s: Timestamp("ts") != dt.date(2024, 1, 5), ["event_id"]), "SELECT event_id FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06')"),
    "f13_timestamp_cmp": (_q("events", lambda s: (Timestamp("ts") > "2024-01-10") & (Timestamp("ts") <= "2024-01-12"), ["event_id"]), "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-13'"),
    "f14_timestamp_between": (_q("orders", lambda s: Timestamp("o_orderdate").between("1996-01-01", "1996-03-31"), OC), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-04-01'"),
    "f15_timestamp_coercion": (_q("events", lambda s: (Timestamp("ts") >= dt.datetime(2024, 1, 20, 12)) & (Timestamp("ts") < 1705838400.5), ["event_id"]), "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' AND epoch_us(ts) < 1705838400500000"),
    "f16_is_missing": (_q("users", lambda s: Tag("credit_score").is_missing() | Num("age").is_missing(), ["user"]), 'SELECT "user" FROM users WHERE credit_score IS NULL OR age IS NULL'),
    "f17_and_or": (_q("customer", lambda s: ((Tag("c_mktsegment") == "building") & (Num("c_acctbal") > 5000)) | ((Num("c_nationkey") == 3) & (Tag("c_mktsegment") == [])), ["c_custkey"]), "SELECT c_custkey FROM customer WHERE (lower(c_mktsegment) = 'building' AND c_acctbal > 5000) OR c_nationkey = 3"),
    "f18_raw_string": (_q("customer", lambda s: "(@c_mktsegment:{machinery|household} @c_acctbal:[(0 +inf]) | -@c_nationkey:[1 24]", ["c_custkey"]), "SELECT c_custkey FROM customer WHERE (lower(c_mktsegment) IN ('machinery', 'household') AND c_acctbal > 0) OR NOT (c_nationkey BETWEEN 1 AND 24)"),
    "f20_escaping": (_q("events", lambda s: str(Tag("event_type") == ["click", "odd:name{}"]), ["event_id"]), "SELECT event_id FROM events WHERE event_type IN ('click', 'odd:name{}')"),
    "f21_json_dsl": (_q("part", lambda s: O.from_json({"and": [{"field": "p_brand", "op": "in", "value": ["Brand#2", "Brand#4"]}, {"not": {"or": [{"field": "p_size", "op": "lt", "value": 10}, {"field": "p_name", "op": "like", "value": "ring"}]}}]}, schema("part")), ["p_partkey"]), f"SELECT p_partkey FROM part WHERE p_brand IN ('Brand#2', 'Brand#4') AND NOT (p_size < 10 OR list_contains({TOKENS.format('p_name')}, 'ring'))"),
    "f22_exists": (_q("users", lambda s: Text("description").exists() & Num("age").exists(), ["user"]), 'SELECT "user" FROM users WHERE description IS NOT NULL AND age IS NOT NULL'),
    "f23_not": (_q("users", lambda s: ~((Num("age") > 40) & (Tag("credit_score") == "high")), ["user"]), f"SELECT \"user\" FROM users WHERE NOT coalesce(age > 40 AND list_contains({TAGS.format('credit_score')}, 'high'), FALSE)"),
    "f6_num_modes": (
        lambda spark, d: (s := source(spark, d, "lineitem")).df.select(*[F.sum(Num("l_quantity").between(10, 20, m).column(s.schema, s.dtypes).cast("long")).alias(m) for m in ("both", "neither", "left", "right")]),
        'SELECT sum((l_quantity BETWEEN 10 AND 20)::BIGINT)::BIGINT AS both, sum((l_quantity > 10 AND l_quantity < 20)::BIGINT)::BIGINT AS neither, sum((l_quantity >= 10 AND l_quantity < 20)::BIGINT)::BIGINT AS "left", sum((l_quantity > 10 AND l_quantity <= 20)::BIGINT)::BIGINT AS "right" FROM lineitem',
    ),
}
