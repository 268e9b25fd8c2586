"""How often queries read their source: counted by a column that notes every row it is computed for."""

import pytest
from pyspark.sql import functions as F

from kerbcast.operators import cleaning, distribution
from kerbcast.plans import training
from kerbcast.plans.tables import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def counted(spark):
    """A frame whose rows pass an accumulator, and the number of passes over all of them so far."""
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = Tables.of(spark, SMALL).clean.cache()
    rows = source.count()
    return source.mapInArrow(pass_on, source.schema), lambda: round(seen.value / rows, 2)


def test_quartile_bounds_read_twice(counted):
    df, passes = counted
    cleaning.iqr_bounds(df, "fare_amount").collect()
    assert passes() <= 2


def test_describe_reads_three_times(counted):
    df, passes = counted
    distribution.describe(df, ["fare_amount", "trip_distance"], coarse_first=True).collect()
    assert passes() <= 3


def test_ecdf_reads_once(counted):
    df, passes = counted
    distribution.ecdf(df, "fare_amount").collect()
    assert passes() <= 1


def test_fare_model_reads_once(counted):
    df, passes = counted
    training.train_fare(df).errors.collect()
    assert passes() <= 1


def test_counting_works(counted):
    df, passes = counted
    df.agg(F.count(F.lit(1))).collect()
    df.agg(F.max("fare_amount")).collect()
    assert passes() == 2
