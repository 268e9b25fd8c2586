import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbcast.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in target]
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return target | share
        target |= {s: most * sizes[s] for s in above}


@pytest.fixture(scope="module")
def rows(odd, prose):
    sources = ["b", "a", "é", None, "z", "tiny", "none"]
    texts = [(100 + i, prose(i, 40 + i % 5 * 31 + 13 * i % 70), sources[i % 5]) for i in range(200)]
    return [*[(d, t, "odd") for d, t in odd], *texts, (900, "one two", "tiny"), (901, "", "none"), (None, "x y z", "b"),
            (100, "again the same id", "b"), (100, "again the same id", "b")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "doc_id long, text string, source string, key string, size string, start string, block string, taken string"
    return spark.createDataFrame([(*r, "k", "s", "s", "b", "t") for r in rows], schema).repartition(3)


@pytest.mark.parametrize("block", [1024, 7])
def test_targets_and_limits(docs, rows, block):
    got = mixing.mixed(docs, block=block).collect()
    size = {}
    for i, (d, t, s) in enumerate(rows):
        size[i] = len(re.findall(r"[^ \t-\r]+", t or ""))
    sizes = Counter()
    for i, (d, t, s) in enumerate(rows):
        sizes[s] += size[i]
    target = plain_targets(sizes)
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter(
        (d, size[i], sizes[s]) for i, (d, t, s) in enumerate(rows))
    found, taken = {}, Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        found[r.source_size] = r.target
        taken[r.source_size] += r.taken
    assert len(set(sizes.values())) == len(sizes)
    assert found == pytest.approx({sizes[s]: target[s] for s in sizes})
    assert all(abs(taken[k] - found[k]) <= 0.5 for k in found)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))


def test_blocks_do_not_change_what_is_taken(docs):
    one, other = (sorted(map(str, mixing.mixed(docs, block=b).collect())) for b in (1024, 5))
    assert one == other


def test_schedule_interleaves(spark):
    sources = spark.createDataFrame(
        [("a", 700, 700.0, 700, 70, 70, 0), ("b", 100, 300.0, 300, 10, 30, 70), ("c", 45, 25.0, 25, 5, 3, 100)],
        "key string, source_size long, target double, goal long, blocks long, slots long, first long")
    mix = mixing.schedule(sources, block=10).orderBy("slot").collect()
    assert Counter(r.key for r in mix) == {"a": 70, "b": 30, "c": 3}
    for key, blocks in (("a", 70), ("b", 10), ("c", 5)):
        mine = [r for r in mix if r.key == key]
        assert [r["rank"] for r in mine] == list(range(len(mine)))
        assert [r.block for r in mine] == [i % blocks for i in range(len(mine))]
    assert [r.words for r in mix if r.key == "c"] == [10, 10, 5]
    for n in range(10, 104):  # every stretch from the start holds the shares, up to a few slots
        assert abs(sum(r.key == "a" for r in mix[:n]) - n * 70 / 103) < 4


def test_reversed_bits_and_points(spark):
    bits = 6
    rows = mixing.with_reversed_bits(spark.range(1 << bits), "id", "v", bits).withColumns(
        {"a": F.lit(37).cast("long"), "b": F.lit(64).cast("long")})
    for end in "ab":
        rows = mixing.with_reversed_bits(rows, end, f"{end}_digits", bits)
    rows = rows.select(
        "id", "v", mixing.points_below(F.col("id"), F.col("a"), F.col("a_digits"), bits).alias("n"),
        mixing.points_below(F.col("id"), F.col("b"), F.col("b_digits"), bits).alias("all")).orderBy("id").collect()
    points = [int(f"{i:06b}"[::-1], 2) for i in range(64)]
    assert [r.v for r in rows] == points
    assert [r.n for r in rows] == [sum(p < 37 for p in points[:i]) for i in range(64)]
    assert [r["all"] for r in rows] == list(range(64))


def test_empty_table_and_no_words(documents):
    docs = documents([(1, None), (2, " \n")])
    assert [(r.size, r.target, r.taken) for r in mixing.mixed(docs).select(
        F.col("size").alias("size"), "target", "taken").collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mixed(docs.limit(0)).count() == 0
