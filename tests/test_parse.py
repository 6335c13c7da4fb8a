import conftest
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators import parse
from eventmart.plans import catalog
from eventmart.schemas import LONG, STRING, struct

SMALL = struct(a=STRING, n=LONG)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_unreadable_text_is_kept_for_quarantine(spark):
    rows = parse.parse_json(texts(spark, '{"a":"x","n":1}', '{"a":', '{"n":"no"}', "{}", None), SMALL)
    good, bad = parse.split_valid(rows, F.col("a").isNotNull())
    assert [tuple(r) for r in good.collect()] == [("x", 1)]
    assert bad.count() == 4
    # A number that cannot be read is set aside with its record; the record without `a` is readable; the null text is none at all.
    assert {r[parse.CORRUPT] for r in bad.collect()} == {'{"a":', '{"n":"no"}', "", None}


def test_parse_runs_once_under_a_filter(spark):
    rows = parse.parse_json(texts(spark, '{"a":"x","n":1}'), SMALL).where("n > 0 and a <> 'y'").select("a")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # Once as the layout says, and once more for the records that this cannot read.
    assert plan.count("from_json") == 2


def test_strict_parse_stops_on_absent_or_unreadable(spark):
    assert parse.parse_json_strict(texts(spark, '{"a":null,"n":2}'), SMALL).collect() == [(None, 2)]
    with pytest.raises(Exception, match="missing fields: n"):
        parse.parse_json_strict(texts(spark, '{"a":"x"}'), SMALL).collect()
    with pytest.raises(Exception):
        parse.parse_json_strict(texts(spark, '{"a":'), SMALL).collect()


def test_json_drops_null_members_and_keeps_order(spark):
    rows = spark.createDataFrame([("1", None, "z")], "b string, c string, a string")
    assert parse.to_json_value(rows, ["b", "c", "a"]).first()["value"] == '{"b":"1","a":"z"}'


def test_both_spellings_of_the_department_name(spark):
    rows = parse.parse_intent(texts(spark, '{"detpname":"one","lamount":5}', '{"deptname":"two"}'))
    assert [(r["dept_name"], r["amount"]) for r in rows.collect()] == [("one", 5), ("two", None)]


def test_event_time_rules(spark):
    rows = spark.createDataFrame([(0,), (5,), (None,)], "event_ms bigint")
    assert [r[0] for r in rows.where(parse.valid_event_time()).collect()] == [5]
    assert [r[0] for r in rows.where(parse.valid_event_time(allow_zero=True)).collect()] == [0, 5]


def test_explode_keeps_parents_and_skips_empty(spark):
    text = '{"dt":"d","countryCode":"PERU","data":[{"type":"fast","score":7.5,"level":"x"},{"type":"slow","score":"1.25","level":"y"}]}'
    rows = parse.parse_json(texts(spark, text, '{"dt":"e","data":[]}', '{"dt":"f"}'), schemas.NESTED_ITEMS)
    out = parse.explode_items(rows, ["dt", "countryCode"]).collect()
    assert [tuple(r) for r in out] == [("d", "PERU", "fast", 7.5, "x"), ("d", "PERU", "slow", 1.25, "y")]


def test_clean_json_without_readable_time(spark):
    rows = spark.createDataFrame(
        [("a", "f", None, "bad", "1", "", "u", "name")],
        "appId string, funcId string, funcName string, stropDate string, orgCode string, orgName string, "
        "userId string, userName string",
    )
    assert parse.clean_click_json(rows).first()["value"] == (
        '{"appId":"a","funcId":"f","stropDate":"bad","orgCode":"1","orgName":"","userId":"u","userName":"name"}'
    )


def test_no_text_is_invented_and_none_lost(spark):
    """Null, blank and broken texts are unreadable; numbers in quotes are numbers; an odd number sets its record aside."""
    lines = [None, "", "  ", "{", '{"lamount":"500","nstate":"9"}', '{"lamount":500,"nstate":"x"}', '{"success":"true"}']
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    good, bad = parse.split_valid(parse.parse_json(frame, schemas.FLAT_INTENT, keep=["i"]), F.lit(True))
    assert {r.i: (r.lamount, r.nstate) for r in good.collect()} == {4: (500, 9), 6: (None, None)}
    assert {r.i: r[parse.CORRUPT] for r in bad.collect()} == {0: "", 1: "", 2: "  ", 3: "{", 5: lines[5]}


def test_forms_of_whole_numbers(spark):
    """Decimals and powers of ten without a fraction are whole numbers; with one, or too large, they set the record aside."""
    forms = {"500.0": 500, "1e3": 1000, '"9.0"': 9, '"7"': 7, "-2.50e1": -25, "null": None, '""': None, '" "': None, "9223372036854775807": 2**63 - 1}
    odd = ["0.5", '"1e"', "9223372036854775808", "1e30", "true", "{}", "[1]"]
    lines = [f'{{"a":"k","n":{form}}}' for form in [*forms, *odd]]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    good, bad = parse.split_valid(parse.parse_json(frame, SMALL, keep=["i"]), F.lit(True))
    assert {r.i: r.n for r in good.collect()} == dict(enumerate(forms.values()))
    assert {r.i: r[parse.CORRUPT] for r in bad.collect()} == {i: lines[i] for i in range(len(forms), len(lines))}


def test_odd_numbers_in_nested_members(spark):
    """Nested numbers are held to the same rule, in records and in items of lists."""
    nested = struct(r=struct(n=LONG), data=T.ArrayType(struct(score=T.DoubleType())))
    lines = ['{"r":{"n":"4.0"},"data":[{"score":"1.5"}]}', '{"r":{"n":"x"}}', '{"data":[{"score":1},{"score":"y"}]}', '{"r":null,"data":null}']
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    good, bad = parse.split_valid(parse.parse_json(frame, nested, keep=["i"]), F.lit(True))
    assert {r.i: (r.r and r.r.n, r.data and [d.score for d in r.data]) for r in good.collect()} == {0: (4, [1.5]), 3: (None, None)}
    assert sorted(r.i for r in bad.collect()) == [1, 2]


def test_whole_numbers_as_by_plain_casts(spark):
    """Texts that are not cast, as their letters rule them out, are those whose cast fails."""
    texts = ["7", " 7 ", "+7", "-7", "7.0", "7.", ".0", "7.5", "1e3", "1E3", "1e-3", "1,5", "", " ", "n/a", "e", "--7", "0x7", "1/2", "٧", "7_0", "9" * 19, "1f", "NaN", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    kind, text = T.LongType(), F.col("t")
    exact = text.try_cast(T.DecimalType(38, 10))
    plain = F.coalesce(text.try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast(kind)))
    found = frame.select("t", parse._whole(text, kind).alias("a"), plain.alias("b")).collect()
    assert [r.a for r in found] == [r.b for r in found]


def test_decimals_are_parsed_once(spark):
    """Both sides of the split read what was parsed."""
    plan = catalog.QUERIES["parse_decimals"](spark, conftest.SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan
