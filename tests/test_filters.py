import datetime as dt

import pytest

from lodestone.operators.filters import Geo, GeoRadius, Num, Tag, Text, Timestamp, FilterError, escape, from_json, parse
from lodestone.operators.search import CountQuery
from lodestone.schema import IndexSchema
from tests.fixtures import AUTUMN, OSLO, SCHEMA, SPRING, SUMMER, crew

RENDERED = [
    (Tag("t") == "a", "@t:{a}"), (Tag("t") == ["a", "b"], "@t:{a|b}"), (Tag("t") != "a", "(-@t:{a})"), (Tag("t") == "a b&c/d*", "@t:{a\\ b\\&c\\/d\\*}"), (Tag("t") % "te*|x", "@t:{te*|x}"), (Tag("t") == [], "*"), (Tag("t") == ["", None, "a"], "@t:{a}"), (Tag("t") == None, "*"),  # noqa: E711
    (Num("n") == 5, "@n:[5 5]"), (Num("n") != 5, "(-@n:[5 5])"), (Num("n") > 5, "@n:[(5 +inf]"), (Num("n") >= 5, "@n:[5 +inf]"), (Num("n") < 5, "@n:[-inf (5]"), (Num("n") <= 5.5, "@n:[-inf 5.5]"), (Num("n") == 0, "@n:[0 0]"), (Num("n") == None, "*"),  # noqa: E711
    (Num("n").between(2, 5), "@n:[2 5]"), (Num("n").between(2, 5, "neither"), "@n:[(2 (5]"), (Num("n").between(2, 5, "left"), "@n:[2 (5]"), (Num("n").between(2, 5, "right"), "@n:[(2 5]"),
    (Text("x") == "t", '@x:("t")'), (Text("x") != "t", '(-@x:"t")'), (Text("x") % "tex*", "@x:(tex*)"), (Text("x") % "", "*"),
    (Geo("g") == GeoRadius(1.0, 2.0, 3.9, "km"), "@g:[1.0 2.0 3 km]"), (Geo("g") != GeoRadius(1.0, 2.0, 3, "m"), "(-@g:[1.0 2.0 3 m])"),
    (Timestamp("c") == "2023-03-17", "@c:[1679011200.0 1679097599.999999]"), (Timestamp("c") == dt.datetime(2023, 3, 17, 14, 10), "@c:[1679062200.0 1679062200.0]"), (Timestamp("c") > dt.date(2023, 3, 17), "@c:[(1679097599.999999 +inf]"), (Timestamp("c") < "2023-03-17", "@c:[-inf (1679011200.0]"), (Timestamp("c").between("2023-03-01", "2023-03-17"), "@c:[1677628800.0 1679097599.999999]"),
    (Tag("t").is_missing(), "ismissing(@t)"), (Tag("t").exists(), "(-ismissing(@t))"),
    ((Tag("t") == "a") & (Num("n") > 1), "(@t:{a} @n:[(1 +inf])"), ((Tag("t") == "a") | (Num("n") > 1), "(@t:{a} | @n:[(1 +inf])"), ((Tag("t") == []) | (Num("n") > 1), "@n:[(1 +inf]"), ((Tag("t") == []) & (Num("n") > 1), "@n:[(1 +inf]"), (~(Tag("t") == "a"), "(-(@t:{a}))"),
]


@pytest.mark.parametrize("f,text", RENDERED, ids=[t for _, t in RENDERED])
def test_rendering_and_reading_back(f, text):
    assert str(f) == text
    assert str(parse(str(parse(text)))) == str(parse(text))


def test_errors():
    for build in (lambda: Num("n") == "x", lambda: Num("n") == True, lambda: Tag("t") == 5, lambda: Text("x") == 5, lambda: Geo("g") == 5, lambda: Timestamp("c") == [1], lambda: escape(5), lambda: (Tag("t") == "a") & 5):  # noqa: E712
        with pytest.raises(TypeError):
            build()
    for build in (lambda: Tag("t") > "a", lambda: Text("x") < "a", lambda: Timestamp("c") == "no time", lambda: GeoRadius(1, 2, 3, "miles"), lambda: Num("n").between(1, 2, "some"), lambda: parse("@t:{a"), lambda: parse("nonsense")):
        with pytest.raises(ValueError):
            build()


COUNTS = [
    (Tag("grade") == "senior", 3), (Tag("grade") == ["senior", "junior"], 5), (Tag("grade") == [], 8), (Tag("grade") != "senior", 5), (Tag("grade") % "*nior", 5), (Tag("grade") % "*aste*", 3),
    (Num("years") >= 12, 5), ((Num("years") >= 7) & (Num("years") < 41), 4), ((Num("years") < 7) | (Num("years") > 41), 3), (Num("years") != 0, 7),
    (Geo("port") == GeoRadius(*OSLO, 1, "m"), 3), (Geo("port") != GeoRadius(*OSLO, 1, "m"), 5),
    (Text("trade") == "welder", 2), (Text("trade") != "welder", 6), (Text("trade") % "weld*", 2), (Text("trade") % "navig*|cook", 3), (Text("trade") % "%%weldr%%", 2), (Text("trade") % "", 8),
    (Text("note") == "climbs masts", 1), (Text("note") % "climbed", 2), (Text("note") % "charts", 2), (Text("note") != "tanks", 6),  # climbs and climbing, charts and charting share a stem
    (Timestamp("seen") == dt.datetime.fromtimestamp(SPRING, dt.UTC), 2), (Timestamp("seen") > SPRING, 6), (Timestamp("seen") >= SUMMER, 6), (Timestamp("seen") <= SUMMER, 5), (Timestamp("seen").between(SPRING, SUMMER, "right"), 3), (Timestamp("seen") == "2024-07-19", 3), (Timestamp("seen") < AUTUMN, 5),
    ("@grade:{senior} @years:[(7 +inf]", 2), ("-@trade:(navigator)", 6), ("*", 8),
]


def test_counts(spark):
    index = crew(spark)
    got = [index.query(CountQuery(f)) for f, _ in COUNTS]
    assert got == [n for _, n in COUNTS]


def test_complement(spark):
    index = crew(spark)
    for f, _ in COUNTS:
        f = parse(f) if isinstance(f, str) else f
        if not f.all:
            assert index.query(CountQuery(f)) + index.query(CountQuery(~f)) == 8


def test_missing_rows_match_negations(spark):
    index = crew(spark)
    index._df = index._df.selectExpr("* except (grade, years, trade)", "if(name = 'fumi', null, grade) grade", "if(name = 'fumi', null, years) years", "if(name = 'gil', '', trade) trade")
    assert index.query(CountQuery(Tag("grade") != "senior")) == 5
    assert index.query(CountQuery(Num("years") != 7)) == 7
    assert index.query(CountQuery(Num("years").is_missing())) == 1
    assert index.query(CountQuery(Text("trade").is_missing())) == 0


def test_json_language():
    s = IndexSchema.from_dict(SCHEMA)
    spec = {"and": [{"field": "grade", "op": "eq", "value": "master"}, {"or": [{"field": "years", "op": "gte", "value": 4.5}, {"not": {"field": "trade", "op": "like", "value": "rig*"}}]}]}
    assert str(from_json(spec, s)) == "(@grade:{master} (@years:[4.5 +inf] | (-(@trade:(rig*)))))"
    assert from_json("@a:{b}", s) == "@a:{b}"
    assert str(from_json({"field": "trade", "op": "exists"}, s)) == "(-ismissing(@trade))"
    for bad in ({}, {"and": []}, {"field": "no", "op": "eq", "value": 1}, {"field": "port", "op": "eq", "value": 1}, {"field": "years", "op": "like", "value": "x"}, {"field": "years", "op": "eq", "value": "x"}, {"field": "years", "op": "in", "value": []}, 5):
        with pytest.raises(FilterError):
            from_json(bad, s)


def test_bounds_reach_the_scan(spark, tmp_path):
    rows = [(k, dt.datetime(2024, 1, 1 + k, 12), dt.datetime(2024, 1, 1 + k, 12)) for k in range(9)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "n long, a timestamp, b timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for f, n in ((Num("n") > 3, 5), (Timestamp("b") == "2024-01-03", 1), (Timestamp("b") > "2024-01-03", 6), (Timestamp("b").between("2024-01-02", "2024-01-04"), 3)):
        got = df.where(f.column(None, kinds))
        assert got.count() == n
        assert "GreaterThan" in got._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1]
    assert df.where((Timestamp("a") >= "2024-01-05").column(None, kinds)).count() == 5
