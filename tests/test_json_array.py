"""One JSON document read in byte ranges."""

import json

import pytest

from tessera.sources.json_array import _closed, _ends_within, read_json_array

ROWS = [{"id": i, "name": 'a "quoted" } { ] [ , \\ name é' * (i % 5), "tags": [str(j) for j in range(i % 4)],
         "sub": {"x": {"y": [[i], [i + 1]]}}} for i in range(400)]
SCHEMA = "id long, name string, tags array<string>, sub struct<x: struct<y: array<array<long>>>>"
DOCUMENTS = {
    "envelope": {"meta": {"date": "x", "data": [1, 2], "list": [{"a": [1]}]}, "data": ROWS, "after": [{"id": 9}, 5]},
    "bare": ROWS,
    "one huge element": {"data": [{"id": 1, "name": "long } [ " * 3000}, {"id": 2}]},
    "empty": {"data": [], "other": [1]},
    "key late": {"a": {"data": [{"id": 5}]}, "z": [[1], [2]], "data": [{"id": 7}]},
}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("name", list(DOCUMENTS))
def test_equal_to_reading_it_whole(spark, tmp_path, name, indent):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(DOCUMENTS[name], indent=indent, ensure_ascii=False))
    doc = DOCUMENTS[name]
    want = sorted(((r or {}).get("id") or -1, r.get("name")) for r in (doc if isinstance(doc, list) else doc["data"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        got = read_json_array(spark, str(path), SCHEMA).collect()
        tasks = spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.id or -1, r.name) for r in got) == want
    if name == "envelope":
        assert tasks > 10
        assert sorted(json.dumps(r.asDict(True)) for r in got) == sorted(json.dumps(r) for r in ROWS)


def test_string_ends():
    assert _closed(b'"a"') and _closed(b'"\\\\"') and not _closed(b'"a\\"') and not _closed(b'"')
    assert _ends_within(b'{"a": "b', False) and not _ends_within(b'{"a": "b"', False)
    assert _ends_within(b"still", True) and not _ends_within(b'end", 1', True) and _ends_within(b'end\\" on', True)
