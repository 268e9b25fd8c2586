"""States per month that merge: exact parts against one pass, sketches against exact values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbcast.operators import profile_states as states
from kerbcast.plans.tables import Tables
from kerbcast.sources import readers

NUMBERS, NAMES = ["fare_amount", "trip_distance"], ["trip_id", "PULocationID"]


@pytest.fixture(scope="module")
def trips(spark):
    """Three months of skewed values; the second one is busy, the third shifted."""
    rng = np.random.default_rng(4)
    rows = []
    for month, n in ((1, 4000), (2, 30000), (3, 6000)):
        at = pd.Timestamp(2024, month, 1) + pd.to_timedelta(rng.integers(0, 28 * 1440, n), unit="min")
        rows.append(pd.DataFrame({
            "tpep_pickup_datetime": at, "file_year": 2024, "file_month": month, "fare_amount": rng.lognormal(2 + (month == 3), 1, n),
            "trip_distance": np.where(rng.random(n) < 0.1, np.nan, rng.normal(1e6, 1, n)), "PULocationID": rng.integers(1, 260, n)}))
    rows = pd.concat(rows, ignore_index=True)
    rows["trip_id"] = np.arange(len(rows))
    df = spark.createDataFrame(rows).withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
    return df.repartition(7), rows


def test_moments_merge_exactly(trips):
    df, rows = trips
    got = {r.feature: r for r in states.moments(states.month_states(df, NUMBERS, NAMES)).collect()}
    assert set(got) == {*NUMBERS, *NAMES}
    for c in NUMBERS:
        x = rows[c].dropna()
        r = got[c]
        assert (r.n, r.n_null) == (len(x), rows[c].isna().sum()) and (r.lowest, r.highest) == (x.min(), x.max())
        assert np.isclose(r["mean"], x.mean(), rtol=1e-12) and np.isclose(r["std"], x.std(), rtol=1e-9)
    assert got["trip_id"].n == len(rows) and got["trip_id"]["mean"] is None


def test_sketches_keep_their_error(trips):
    df, rows = trips
    shares = [0.01, 0.25, 0.5, 0.9, 0.99]
    got = {r.feature: r for r in states.sketched(states.month_states(df, NUMBERS, NAMES), shares).collect()}
    for c in NUMBERS:
        x = np.sort(rows[c].dropna())
        off = [abs(np.searchsorted(x, q, side="right") / len(x) - s) for q, s in zip(got[c].q, shares)]
        assert max(off) < 0.0133 and got[c].n_distinct is None
    assert abs(got["trip_id"].n_distinct / len(rows) - 1) < 3 * 0.016 and abs(got["PULocationID"].n_distinct - 259) < 13
    assert got["trip_id"].q is None


def test_merging_is_the_same_in_any_grouping(trips):
    df, _ = trips
    parts = states.month_states(df, NUMBERS, NAMES)
    early = states.merged(parts.where("file_month < 3"))
    late = parts.where("file_month = 3").drop(*states.MONTH)
    once = {r.feature: r for r in states.moments(parts).collect()}
    for r in states.moments(early.unionByName(late)).collect():
        assert (r.n, r.lowest, r.highest) == (once[r.feature].n, once[r.feature].lowest, once[r.feature].highest)
        if r["mean"] is not None:
            assert np.isclose(r["mean"], once[r.feature]["mean"], rtol=1e-12) and np.isclose(r["std"], once[r.feature]["std"], rtol=1e-9)


def test_psi_from_states(trips):
    df, rows = trips
    parts = states.month_states(df, NUMBERS, NAMES)
    psi = {(r.file_month, r.feature): r.psi for r in
           states.state_psi(parts.where("file_month = 1"), parts, "file_month").collect()}
    old = rows.loc[rows.file_month == 1, "fare_amount"]
    cuts = np.quantile(old, np.arange(1, 10) / 10)
    for month in (1, 2, 3):
        here = rows.loc[rows.file_month == month, "fare_amount"]
        share = np.bincount(np.searchsorted(cuts, here), minlength=10) / len(here)
        want = float(((share - 0.1) * np.log(np.maximum(share, 1e-6) / 0.1)).sum())
        assert abs(psi[month, "fare_amount"] - want) < 0.02 + 0.1 * want
        assert psi[month, "trip_distance"] < 0.02
    assert psi[3, "fare_amount"] > 0.5 and {f for _, f in psi} == set(NUMBERS)


def test_features_and_months_without_values(spark, trips):
    df, _ = trips
    empty = df.withColumn("fare_amount", F.lit(None).cast("double")).withColumn("trip_id", F.lit(None).cast("long"))
    parts = states.month_states(empty, NUMBERS, NAMES)
    got = {r.feature: r for r in states.moments(parts).collect()}
    assert got["fare_amount"].n == 0 and got["fare_amount"]["mean"] is None and got["fare_amount"]["std"] is None
    found = {r.feature: r for r in states.sketched(parts).collect()}
    assert found["fare_amount"].q is None and found["trip_id"].n_distinct == 0
    assert states.moments(states.month_states(df.limit(0), NUMBERS, NAMES)).count() == 0
    assert {r.feature for r in states.state_psi(parts, parts).collect()} == {"trip_distance"}
    one = states.moments(states.month_states(df.limit(1), NUMBERS)).where("feature = 'fare_amount'").first()
    assert one["n"] == 1 and one["std"] is None
    moved = df.withColumn("file_month", F.lit(12))
    assert states.month_states(moved, NUMBERS).count() == 0


def test_a_new_month_reads_its_own_files_and_replaces_its_own_state(spark, tmp_path):
    t = Tables.of(spark, "/root/testdata/sf0.001")
    store = str(tmp_path / "states")
    months = [(r.file_year, r.file_month) for r in
              readers.load_clean_trips(spark, t.trip_files).select(*states.MONTH).distinct().orderBy(*states.MONTH).collect()]
    whole = states.month_states(readers.load_clean_trips(spark, t.trip_files), NUMBERS, NAMES)
    for year, month in months:
        loaded = readers.load_clean_trips(spark, t.trip_files, year, month)
        assert all(f"{year:04d}-{month:02d}" in f for f in loaded.inputFiles())
        states.store_states(states.month_states(loaded, NUMBERS, NAMES), store)
    year, month = months[0]
    before = states.read_states(spark, store).count()
    states.store_states(states.month_states(readers.load_clean_trips(spark, t.trip_files, year, month), NUMBERS, NAMES), store)
    assert states.read_states(spark, store).count() == before
    keys = [*states.MONTH, "feature", "n", "n_null", "lowest", "highest"]
    assert states.read_states(spark, store).select(keys).exceptAll(whole.select(keys)).count() == 0 and before == whole.count()
