from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lumenloom.operators import predicates as p
from lumenloom.sources import files


@pytest.fixture(scope="module")
def people(spark):
    data = [("Alice", "30", "NYC"), ("Bob", "25", "LA"), ("Carol", "30.0", None), ("dave", "x", "nyc")]
    return spark.createDataFrame(data, "name string, age string, city string")


def names(df):
    return sorted(r.name for r in df.select(df.columns[0]).toDF("name").collect())


@pytest.mark.parametrize(
    ("test", "want"),
    [
        (lambda c: c("age").gt("26"), ["Alice", "Carol", "dave"]),  # 'x' > '26' as text
        (lambda c: c("AGE").ge(30), ["Alice", "Carol", "dave"]),
        (lambda c: c("_2").eq("30"), ["Alice", "Carol"]),
        (lambda c: c("age").in_(["30"]), ["Alice"]),
        (lambda c: c("age").between(24, 26), ["Bob"]),
        (lambda c: c("name").like("_a%"), ["Carol", "dave"]),
        (lambda c: c("name").like("a%"), []),
        (lambda c: c("city").is_null(), ["Carol"]),
        (lambda c: ~c("city").eq("LA"), ["Alice", "Carol", "dave"]),
        (lambda c: c("city").ne("LA"), ["Alice", "dave"]),
        (lambda c: c("nothing").is_null() & c("_9").is_null(), ["Alice", "Bob", "Carol", "dave"]),
        (lambda c: c("city").eq("NYC") | c("age").lt(26), ["Alice", "Bob"]),
        (lambda c: c("name").like("50\\%"), []),
    ],
)
def test_loose_predicates(people, test, want):
    assert names(p.where_loose(people, test)) == want


def test_numeric_columns_are_compared_in_the_scan(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    plan = p.where_loose(part, lambda c: c("p_size").gt(20))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThan(p_size,20)" in plan


def test_unknown_columns_are_empty(people):
    got = files.select_projection(people, "name, nope").collect()
    assert all(r.nope is None for r in got)


def test_like_takes_a_line_break_for_any_character(spark):
    df = spark.createDataFrame([("a\nb",)], "name string")
    assert p.where_loose(df, lambda c: c("name").like("a_b")).count() == 1


def test_partition_values(spark):
    data = [("2024", "01"), ("2024", "1"), ("2023", "12"), (None, "05"), ("2024", "a,b")]
    df = spark.createDataFrame(data, "year string, month string")
    keys = ["year", "month"]

    def run(test):
        return [tuple(r) for r in p.prune_partitions(df, keys, test).collect()]

    assert run(lambda c: c("month").eq("1")) == [("2024", "01"), ("2024", "1")]
    assert run(lambda c: c("month").in_(["1", "a,b"])) == [("2024", "1"), ("2024", "a,b")]
    assert run(lambda c: c("year").gt(2023) & c("month").lt(2)) == [("2024", "01"), ("2024", "1")]
    assert run(lambda c: c("day").eq("1")) == []
    assert run(None)[0] == (None, "05")


def test_a_typed_partition_predicate_prunes_folders(spark, tmp_path):
    spark.range(20).withColumn("day", (F.col("id") % 4).cast("int")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    kept = p.prune_partitions(df, ["day"], lambda c: c("day").ge("2"))
    assert kept.count() == 10
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan


def test_find_by_tags(spark):
    data = [
        ("arn:aws:ec2:eu:1:instance/a", {"team": "x", "env": "p"}),
        ("arn:aws:ec2:us:1:instance/b", {"team": "x"}),
        ("arn:aws:s3:::bucket", {"team": "y"}),
        ("arn:aws:sqs:eu:1:queue", {}),
    ]
    df = spark.createDataFrame(data, "resource string, tags map<string,string>")

    def run(*args, **kw):
        return [r.resource.rsplit(":", 1)[1] for r in p.find_by_tags(df, *args, **kw).collect()]

    assert run(region="eu") == ["instance/a", "bucket", "queue"]
    assert run({"team": ["x", "y"]}) == ["instance/a", "instance/b", "bucket"]
    assert run({"team": [], "env": []}) == ["instance/a"]
    assert run(types=["EC2:Instance", "sqs"]) == ["instance/a", "instance/b", "queue"]
    assert run(after="arn:aws:ec2:eu:1:instance/a", page_size=1) == ["instance/b"]


def test_account_filter(spark):
    df = spark.createDataFrame(
        [("ann", "CONFIRMED", {"email": "ann@x"}), ("bob", "CREATED", {})],
        "username string, status string, attributes map<string,string>",
    )
    assert p.where_attr(df, "email", "^=", "ann").count() == 1
    assert p.where_attr(df, "username", "=", "bob").count() == 1
    assert p.where_attr(df, "cognito:user_status", "=", "CONFIRMED").count() == 1
    assert p.where_attr(df, "phone", "=", "1").count() == 0
    with pytest.raises(ValueError):
        p.where_attr(df, "email", "~", "x")


def test_partition_numbers_of_any_size(spark):
    from lumenloom.operators.predicates import prune_partitions

    df = spark.createDataFrame([("0.1234567890123",), ("12345678901234567890123456789",), ("01",), ("x",)], "p string")
    found = lambda test: [r.p for r in prune_partitions(df, ["p"], test).collect()]
    assert found(lambda c: c("p").eq("0.1234567890124")) == []
    assert "12345678901234567890123456789" in found(lambda c: c("p").gt("9"))
    assert found(lambda c: c("p").eq("1")) == ["01"]
