import pytest
from pyspark.sql import functions as F

from eventmart.operators.lookup import Dimension, dimension, lookup
from eventmart.operators import enrich
from eventmart.sources import dims


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def facts(spark):
    # A third of the rows are exact copies on one key, some keys are null, some unknown.
    return spark.range(300).select(
        F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("n"),
        F.when(F.col("id") < 100, "k0").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
    )


@pytest.fixture
def names(spark):
    return spark.range(40).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("name"), "id").alias("name"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_large_dimension_gives_the_same_rows(facts, names, how, hot):
    small, large = Dimension(names, ("key",), True), Dimension(names, ("key",), False)
    expected = rows(facts.join(names, "key", how).select("n", "key", "name"))
    assert rows(lookup(facts, small, how=how)) == expected
    assert rows(lookup(facts, large, how=how, hot_keys=hot)) == expected


def test_two_column_keys(facts, names):
    dim = names.withColumn("n", F.lit(0).cast("bigint"))
    for small in (True, False):
        got = lookup(facts, Dimension(dim, ("key", "n"), small), how="inner", hot_keys=2)
        assert rows(got) == [(0, "k0", "name0")] * 100


def test_size_is_measured(names):
    assert dimension(names, "key").small
    assert not dimension(names, "key", max_rows=39).small
    assert not dimension(names, "key", max_bytes=100).small


def test_small_side_is_broadcast_and_large_side_is_not(facts, names):
    plan = lookup(facts, Dimension(names, ("key",), True))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_unknown_kind(facts, names):
    with pytest.raises(ValueError):
        lookup(facts, dimension(names, "key"), how="full")


def org_rows(spark, *pairs):
    return dims.org_dimension(spark.createDataFrame(list(pairs), "k string, v string"))


def test_attributes_of_an_organisation(spark):
    got = org_rows(spark, ("1", "n,a,b,c,d"), ("2", "n,a"), ("3", "n,a,,,"), ("4", ""), ("5", "n,a,b,c,d,e"))
    assert [(r["org_code"], r["dept_name"], r["admin_area_name"], r["n_attrs"]) for r in got.collect()] == [
        ("1", "n", "d", 5),
        ("2", "n", None, 2),
        ("3", "n", None, 2),
        ("4", "", None, 1),
        ("5", "n", "d", 6),
    ]


def test_default_bucket_for_unknown_and_incomplete(spark):
    orgs = dimension(org_rows(spark, ("1", "n,a,b,c,d"), ("2", "n,a"), ("3", "n,a,b,c,d,e")), "org_code")
    intents = spark.createDataFrame([("1",), ("2",), ("3",), ("9",), (None,)], "dept_code string")
    got = {r["dept_code"]: r["busi_area_code"] for r in enrich.org_default(intents, orgs).collect()}
    assert got == {"1": "a", "2": "9527404", "3": "9527404", "9": "9527404", None: "9527404"}


def test_strict_split_loses_nothing(spark):
    orgs = dimension(org_rows(spark, ("1", "n,a,b,c,d"), ("2", "n,a")), "org_code")
    intents = spark.createDataFrame([("1", 1), ("2", 2), (None, 3)], "dept_code string, id int")
    known, missed = enrich.org_strict(intents, orgs)
    assert [r["id"] for r in known.collect()] == [1]
    assert sorted(r["id"] for r in missed.collect()) == [2, 3] and missed.columns == intents.columns


def test_before_image_only_where_there_is_one(spark):
    orgs = dimension(org_rows(spark, ("1", "n,a,b,c,d")), "org_code")
    intents = spark.createDataFrame(
        [(1, "1", None), (2, "9", "1"), (3, "1", "9")], "id int, dept_code string, old_dept_code string"
    )
    got = enrich.before_after(intents, orgs).orderBy("id").collect()
    assert [(r["dept_name"], r["old_dept_name"], r["old_admin_area_name"]) for r in got] == [
        ("n", None, None),
        ("其他营业部", "n", "d"),
        ("n", "其他营业部", "其他区域"),
    ]


def test_fail_open(spark):
    orgs = dimension(org_rows(spark, ("1", "n,a,b,c,d")), "org_code")
    clicks = spark.createDataFrame([("1", "sent"), ("2", "sent")], "org_code string, org_name string")
    assert rows(enrich.org_fail_open(clicks, orgs, True)) == [("1", "n"), ("2", "")]
    assert rows(enrich.org_fail_open(clicks, orgs, False)) == [("1", "sent"), ("2", "sent")]


def test_snapshots(spark):
    old = org_rows(spark, ("1", "old"), ("2", "old"))
    new = org_rows(spark, ("1", "new"))
    names = lambda frame: {r["org_code"]: r["dept_name"] for r in frame.collect()}
    assert names(dims.replace_snapshot(old, new)) == {"1": "new"}
    assert names(dims.replace_snapshot(old, new.limit(0))) == {"1": "old", "2": "old"}
    assert names(dims.merge_snapshot(old, new, "org_code")) == {"1": "new", "2": "old"}


def test_area_inversion(spark):
    raw = spark.createDataFrame([("A", "US,CA"), ("B", "DE")], "k string, v string")
    assert rows(dims.area_dimension(raw)) == [("CA", "A"), ("DE", "B"), ("US", "A")]


def test_repeated_dimension_keys_multiply_no_fact(spark):
    """Both lookup paths give each fact one row, the same one."""
    raw = spark.createDataFrame([("A", "x,y,,"), ("B", "y,z")], "k string, v string")
    facts = spark.createDataFrame([("x",), ("y",), ("y",), ("",), (None,)], "country string")
    from eventmart.sources import dims

    for bound in (0, 1000):
        areas = dimension(dims.area_dimension(raw), "country", max_rows=bound)
        assert areas.small == (bound > 0)
        got = sorted(map(tuple, lookup(facts, areas).collect()), key=str)
        assert got == sorted([("x", "A"), ("y", "B"), ("y", "B"), ("", None), (None, None)], key=str)
