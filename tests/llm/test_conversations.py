import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbcast.llm import conversations
from kerbcast.llm.conversations import cheapest

WANTED = re.compile(r"(s?(ua)+)?")


def every_edit(pattern):
    """Least (cost, audit) by trying all edits of all rows and up to two insertions in every gap."""
    gaps = [("", 0), ("u", 3), ("a", 3), ("ua", 6), ("au", 6)]
    best = (10**9, "")
    options = []
    for sign in pattern:
        extra = 3 if sign.isupper() else 0
        role = sign.lower()
        stay = [(role, extra, "K"), ("u", 3 + extra, "R"), ("a", 3 + extra, "R")] if sign != "d" else []
        options.append([("", 4, "D"), *stay])
    for edits in itertools.product(*options):
        for filled in itertools.product(gaps, repeat=len(pattern) + 1):
            roles, audit, cost = "", "", 0
            for i, (text, price) in enumerate(filled):
                roles, audit, cost = roles + text, audit + "I" * len(text), cost + price
                if i < len(edits):
                    r, c, e = edits[i]
                    roles, audit, cost = roles + r, audit + e, cost + c
            if (cost, audit) < best and WANTED.fullmatch(roles):
                best = (cost, audit)
    return best


def plain(pattern):
    """The same from the end of the rows to their start, keeping the best rest of every node."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def rest(i, role, inserted):
        ways = []
        if i == len(pattern):
            if role in ("", "a"):
                ways.append((0, ""))
        else:
            sign, extra = pattern[i].lower(), 3 if pattern[i].isupper() else 0
            ways.append(add(4, "D", rest(i + 1, role, 0)))
            if sign != "d":
                if sign == after[role] or (sign == "s" and role == ""):
                    ways.append(add(extra, "K", rest(i + 1, sign, 0)))
                ways.append(add(3 + extra, "R", rest(i + 1, after[role], 0)))
        if inserted < 2:
            ways.append(add(3, "I", rest(i, after[role], inserted + 1)))
        return min(ways, default=(10**9, ""))

    def add(cost, edit, found):
        return (cost + found[0], edit + found[1])

    return rest(0, "", 0)


def test_cheapest_edits_of_all_short_patterns():
    for n in range(3):
        for pattern in itertools.product("suaxSUAXd", repeat=n):
            assert cheapest("".join(pattern)) == every_edit(pattern), pattern
    rng = random.Random(2)
    for pattern in (rng.choices("suaxUAd", k=3) for _ in range(12)):
        assert cheapest("".join(pattern)) == every_edit(pattern) == plain(tuple(pattern))


def test_cheapest_edits_of_longer_patterns():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choices("suaxSUAXd", weights=[2, 6, 6, 1, 1, 2, 2, 1, 3], k=rng.randrange(4, 40)))
        assert cheapest(pattern) == plain(pattern)


def brute(rows):
    """{conv_id: result} of (conv_id, turn, role, text) rows after damage, by the contract."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine, places = [], []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = (" " if x is None else x for x in (role, text))
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        mine.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, pattern, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for known, turn, role, text in mine:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not marks else "duplicate" if (role, text) in seen else
                     "truncated" if marks[-1] not in ".!?" else None)
            seen.add((role, text))
            sign = role[:1] if role[:1] in ("s", "u", "a") else "x"
            pattern.append("d" if fault in ("blank", "duplicate") else sign.upper() if fault else sign)
            if fault:
                faults[fault] += 1
            if known:
                places.append(turn)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = plain(tuple(pattern))
        lines, i, last = [], 0, ""
        for edit in audit:
            following = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
            if edit == "I":
                lines.append(following + ":")
                last = following[0]
                continue
            _, _, role, text = mine[i]
            i += 1
            if edit in "KR":
                role = role if edit == "K" else following
                lines.append(f"{role}:{text}")
                last = role[0]
        gaps = max(places) - min(places) + 1 - len(set(places)) if places else 0
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            text = rng.choice(["Yes.", "no", "", " \t\x0b", None, "é 日本!", "What?", "a b. ", f"t{rng.random()}."])
            out.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
    long = [(1000, i // 2, ("user", "assistant")[i % 2], rng.choice(["Same.", f"{i}.", f"{i}", ""])) for i in range(240)]
    late = [(1001, None, "user", "Hello.")] * 90 + [(1001, 5, "assistant", "x" * 60_000 + ".")]
    return [*out, *long, *late, (None, 1, "user", "No id."), (None, 2, "user", "No id."), (-5, 7, "user", "Alone.")]


@pytest.fixture(scope="module")
def table(spark, rows):
    schema = ("conv_id long, turn long, role string, text string, present string, row string, kind string, "
              "long_id string, part string, found string, copy string")
    return spark.createDataFrame([(*r, *"abcdefg") for r in rows], schema).repartition(4)


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("long_rows", [64, 5])
def test_equals_brute_force(table, rows, long_rows):
    got = result(conversations.repaired(conversations.damaged(table), F.col("present"), long_rows))
    wanted = brute(rows)
    assert set(got) == set(wanted)
    assert got == wanted


def test_conversations_without_rows(spark, table):
    gone = conversations.repaired(table.where("conv_id = 3"), F.lit(False))
    assert result(gone) == {3: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert conversations.repaired(table.limit(0)).count() == 0


def test_given_table(spark):
    path = "/root/testdata/sf0.01/conversations.parquet"
    given = [tuple(r.values()) for r in pq.read_table(path, columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    rows = conversations.damaged(spark.read.parquet(path))
    assert result(conversations.repaired(rows, F.col("present"))) == brute(given)
