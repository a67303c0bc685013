import random

import pytest
from pyspark.sql import functions as F

from featmart.functions.hashing import digest
from featmart.operators.numbering import number_by_digest, number_rows
from featmart.operators.staging import add_sample_ids, tag_source, union_by_name


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.fixture
def rows(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.randrange(3), i, float(rng.randrange(5))) for i in range(2000)]
    return spark.createDataFrame(data, "g string, t int, k long, v double").repartition(7)


def expected_numbers(df, order):
    """By plain sorting; nulls first, as Spark orders them."""
    data = [r.asDict() for r in df.collect()]
    data.sort(key=lambda r: [(r[c] is not None, r[c]) for c in order])
    return data


def test_number_rows_is_the_global_row_number(rows):
    numbered = number_rows(rows, ["g", "t", "k"], name="n")
    assert [(r["k"], r["n"]) for r in numbered.orderBy("n").collect()] == [
        (r["k"], i) for i, r in enumerate(expected_numbers(rows, ["g", "t", "k"]), 1)
    ]


def test_digest_numbers_equal_range_numbers(rows):
    tied = rows.withColumn("d", digest("k"))
    by_digest = number_by_digest(tied, ["g", "t"], "d", "n", bucket_rows=10)
    by_range = number_rows(tied, ["g", "t", "d"], name="n")
    assert sorted(values(by_digest, "k", "n")) == sorted(values(by_range, "k", "n"))


def test_many_groups_are_numbered_by_ranges(rows):
    tied = rows.withColumn("d", digest("k"))
    numbered = number_by_digest(tied, ["k"], "d", "n", max_buckets=100)
    assert sorted(values(numbered, "k", "n")) == [(i, i + 1) for i in range(2000)]


def test_copies_of_one_row_spread(spark):
    """A third of the rows are equal: they fill one bucket, so ranges take over, and the numbers stay a permutation."""
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k")).withColumn("d", digest("k"))
    numbered = number_by_digest(df, [], "d", "n", bucket_rows=50)
    assert sorted(r["n"] for r in numbered.select("n").collect()) == list(range(1, 3001))
    copies = sorted(r["n"] for r in numbered.filter("k = 0").select("n").collect())
    assert copies == list(range(copies[0], copies[0] + 1000))


def test_copies_use_several_partitions(spark):
    from featmart.operators.numbering import ordered_partitions

    df = spark.range(0, 100_000, 1, 8).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = ordered_partitions(df, ["k"], "copies").groupBy("_fm_part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 60_000


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, d string")
    assert number_rows(empty, ["d"]).count() == 0
    assert number_by_digest(empty, ["g"], "d").count() == 0


def test_sample_ids_do_not_depend_on_layout(spark):
    def staged(parts):
        emu = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("f")).repartition(parts)
        real = spark.range(30).select(F.col("id").alias("k")).repartition(parts)
        return union_by_name([tag_source(emu, "emulator", "2024-01-01"), tag_source(real, "real_device", "2024-01-01")])

    one = add_sample_ids(staged(1), stable_input=False)
    five = add_sample_ids(staged(5), stable_input=False)
    assert sorted(values(one, "data_source", "k", "sample_id")) == sorted(values(five, "data_source", "k", "sample_id"))
    assert sorted(r["sample_id"] for r in one.collect()) == list(range(1, 81))
    assert max(r["sample_id"] for r in one.filter("data_source = 'emulator'").collect()) == 50
