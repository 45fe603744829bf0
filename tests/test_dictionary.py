"""Stored id codes over several loads."""

import os
import random

import pytest

from reviewscope.operators import dictionary as dic
from reviewscope.operators.encode import apply_codes

SCHEMA = "row int, user string, shop string, code string"


def _codes(spark, folder):
    rows = dic.read_codes(spark, folder).collect()
    assert len({(r["kind"], r["key"]) for r in rows}) == len(rows)
    return {(r["kind"], r["key"]): r["code"] for r in rows}


def _gapless(codes, kind):
    numbers = sorted(n for (k, _), n in codes.items() if k == kind)
    return numbers == list(range(len(numbers)))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "dictionary")


def _rows(seed, users):
    rng = random.Random(seed)
    return [(i, rng.choice([None, "hot", f"u{rng.randrange(users)}"]), f"s{rng.randrange(20)}", "extra") for i in range(200)]


def test_old_codes_stay_and_new_ones_follow_without_gaps(spark, folder):
    seen = {}
    for load in range(3):
        rows = _rows(load, 40 * (load + 1))
        df = spark.createDataFrame(rows, SCHEMA)
        codes = dic.extend(df, ["user", "shop"], folder)
        now = _codes(spark, folder)
        assert seen.items() <= now.items()
        assert all(n >= sum(k == kind for k, _ in seen) for (kind, key), n in now.items() if (kind, key) not in seen)
        added = sorted((kind, key) for kind, key in now if (kind, key) not in seen)
        assert [now[k] for k in added if k[0] == "user"] == sorted(now[k] for k in added if k[0] == "user")
        assert _gapless(now, "user") and _gapless(now, "shop")
        for small in (0, 1000):
            got = {r["row"]: r for r in apply_codes(df, codes, ["user", "shop"], "row", small=small).collect()}
            assert all(got[i]["user"] == now.get(("user", u)) and got[i]["shop"] == now["shop", s] for i, u, s, _ in rows)
        seen = now


def test_a_repeated_load_writes_nothing(spark, folder):
    df = spark.createDataFrame(_rows(1, 30), SCHEMA)
    dic.extend(df, ["user"], folder)
    before = _codes(spark, folder)
    again = dic.extend(df, ["user"], folder)
    assert _codes(spark, folder) == before and list(dic.complete_loads(spark, folder)) == [1]
    assert {r["key"]: r["code"] for r in again.table.collect()} == {key: n for (_, key), n in before.items()}


def test_a_lost_load_is_replaced(spark, folder):
    first, second = (spark.createDataFrame(_rows(seed, 60), SCHEMA) for seed in (1, 2))
    dic.extend(first, ["user"], folder)
    dic.extend(second, ["user"], folder)
    whole = _codes(spark, folder)
    os.remove(f"{folder}/load=2/_SUCCESS")
    assert len(_codes(spark, folder)) < len(whole)
    dic.extend(second, ["user"], folder)
    assert _codes(spark, folder) == whole


def test_a_new_column_starts_at_zero(spark, folder):
    df = spark.createDataFrame(_rows(1, 30), SCHEMA)
    dic.extend(df, ["user"], folder)
    dic.extend(df, ["shop", "code"], folder)
    codes = _codes(spark, folder)
    assert codes["code", "extra"] == 0 and _gapless(codes, "shop") and _gapless(codes, "user")


def test_empty_and_null(spark, folder):
    assert dic.extend(spark.createDataFrame([], SCHEMA), ["user"], folder).table.collect() == []
    assert dic.extend(spark.createDataFrame([(1, None, None, None)], SCHEMA), ["user"], folder).sizes == {"user": (0, 0)}
    assert dic.complete_loads(spark, folder) == {}
