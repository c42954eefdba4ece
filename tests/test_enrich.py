"""Rates and the table of answers."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rolodeck.operators import enrich as E


def logged(folder, dies=None):
    """A service that writes down each call, and the first time it gets a certain key stops its task."""

    def fn(key):
        import os
        import uuid

        open(f"{folder}/{key}~{uuid.uuid4().hex}", "w").close()
        if key == dies and not os.path.exists(f"{folder}/died"):
            open(f"{folder}/died", "w").close()
            raise SystemExit("killed")
        if key.endswith("3"):
            raise TimeoutError("no answer")
        if key.endswith("4"):
            raise E.FailFast("never")
        return None if key.endswith("5") else key.upper()

    return fn


def calls(folder):
    return Counter(p.name.split("~")[0] for p in folder.iterdir() if "~" in p.name)


def test_a_killed_attempt_repeats_nothing(tmp_path):
    """The second attempt of a task finds what the first had written."""
    log, answers = tmp_path / "log", tmp_path / "answers" / "0"
    log.mkdir()
    fn = logged(log, dies="k7")
    args = (lambda: iter([f"k{i}" for i in range(12)]), fn, str(answers), 1, 0.0)
    with pytest.raises(SystemExit):
        E.answer(args[0](), *args[1:], E.Pace(None), 1)
    assert E.answer(args[0](), *args[1:], E.Pace(None), 1) == 5
    assert calls(log) == Counter({f"k{i}": 1 for i in range(12)}) + Counter({"k7": 1})
    assert E.answer(args[0](), *args[1:], E.Pace(None), 1) == 0


def test_a_job_goes_on_where_one_died(spark, tmp_path):
    log, answers = tmp_path / "log", str(tmp_path / "answers")
    log.mkdir()
    keys = spark.createDataFrame([(f"k{i}",) for i in range(40)] + [("k1",), ("",), (None,)], "key string")
    fn = logged(log, dies="k17")
    with pytest.raises(Exception):
        E.looked_up(keys, "key", fn, tries=1, partitions=3, answers=answers, each=1).count()
    got = {r.key: (r.value, r.error) for r in E.looked_up(keys, "key", fn, tries=1, partitions=3, answers=answers, each=1).collect()}
    assert len(got) == 40 and got["k1"] == ("K1", None) and got["k5"] == (None, None) and got["k4"][1] == "failed: never" and got["k3"][1] == "TimeoutError: no answer"
    n = calls(log)
    assert all(n[f"k{i}"] == 1 for i in range(40) if i % 10 != 3 and i != 17) and n["k17"] == 2
    # Once more, with a new key: it and what failed are called, nothing else.
    before = n
    more = keys.unionByName(spark.createDataFrame([("new",)], "key string"))
    assert E.looked_up(more, "key", fn, tries=1, partitions=2, answers=answers).count() == 41
    assert calls(log) - before == Counter({"new": 1, "k3": 1, "k13": 1, "k23": 1, "k33": 1})


def test_rate(spark):
    """Two tasks together: twenty calls at forty a second take half a second at least."""
    keys = spark.createDataFrame([(f"k{i}",) for i in range(20)], "key string")
    start = time.time()
    assert E.looked_up(keys, "key", str.upper, partitions=2, rate=40).count() == 20
    assert time.time() - start > 0.2
    pace, start = E.Pace(50), time.monotonic()
    for _ in range(11):
        pace.wait()
    assert 0.19 < time.monotonic() - start < 1


def test_enriched_with_answers(spark, tmp_path):
    (log := tmp_path / "log").mkdir()
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", "had")], "ord int, key string, x string")
    for _ in range(2):
        got = E.enriched(df, F.col("x").isNull(), "key", "x", logged(log), "service", answers=str(tmp_path / "answers")).collect()
        assert sorted((r.ord, r.x, r.x_by) for r in got) == [(1, "A", "service"), (2, "A", "service"), (3, "had", None)]
    assert calls(log) == Counter({"a": 1})
