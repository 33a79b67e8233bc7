"""S3-S5 normalisers and the predicate edge cases."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.sources import normalize as NZ


def test_csv_to_array_edges(spark):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "a"), (4, "a, b"), (5, "a,b"), (6, "a, ")],
                               "id int, tags string")
    out = {r["id"]: r["tags"] for r in NZ.csv_to_array(df).collect()}
    assert out == {1: [], 2: [], 3: ["a"], 4: ["a", "b"], 5: ["a,b"], 6: ["a", ""]}


def test_csv_columns_heuristic(spark):
    df = spark.createDataFrame([("x", "y", "z", "w")], "colors string, text string, name string, availability string")
    assert NZ.csv_columns(df, "cards") == ["availability", "colors"]
    assert NZ.csv_columns(df, None) == ["colors"]


def test_json_variant_bad_input(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{bad",), (None,)], "rulings string")
    out = NZ.json_to_variant(df).select(F.variant_get("rulings", "$.a", "int").alias("a")).collect()
    assert [r["a"] for r in out] == [1, None, None]


def test_unpivot_passthrough(spark):
    wide = spark.createDataFrame([("u1", "Legal", None), ("u2", None, "Banned")], "uuid string, modern string, vintage string")
    assert sorted(tuple(r) for r in NZ.unpivot_status(wide).collect()) == [("u1", "modern", "Legal"), ("u2", "vintage", "Banned")]
    long = spark.createDataFrame([("u1", "modern", "Legal")], "uuid string, format string, status string")
    assert NZ.unpivot_status(long).count() == 1
    only = spark.createDataFrame([("u1",)], "uuid string")
    assert NZ.unpivot_status(only).columns == ["uuid"]


def test_predicates(spark):
    df = spark.createDataFrame([("50% off",), ("a_b",), ("a\\b",), ("xyz",)], "s string")
    assert df.where(P.isin("s", [])).count() == 0
    assert P.any_of([]) is None
    assert df.where(P.like_ci("s", "%\\%")).count() == 1          # backslash is literal
    assert df.where(P.like_ci("s", "A_B")).count() == 2           # '_' stays a wildcard
    assert df.where(P.literal_contains_ci("s", "%")).count() == 1
    assert df.where(P.ascii_ci_eq("s", "XYZ")).count() == 1
    with pytest.raises(ValueError):
        P.filter_map(df, {"nope": 1})


def test_bare_array_document(spark, tmp_path):
    import json
    from tessera.sources.files import read_json_documents
    p = tmp_path / "decks.json"
    p.write_text(json.dumps([{"code": "A", "name": "x"}, {"code": "B", "name": "y"}]))
    assert sorted(r["code"] for r in read_json_documents(spark, str(p)).collect()) == ["A", "B"]


def test_named_sql_params(spark):
    from tessera.sources.sql import sql
    spark.range(10).createOrReplaceTempView("t_named")
    assert sql(spark, "SELECT count(*) AS n FROM t_named WHERE id >= :lo", {"lo": 7}).first()["n"] == 3


def test_explode_json_text_children(spark):
    from tessera.operators.nested import explode_tagged
    df = spark.createDataFrame([("A25", "Masters", '[{"uuid": "p1", "name": "Box"}, {"uuid": "p2", "name": "Pack"}]'),
                                ("MH2", "Horizons", "[]"), ("ZZZ", "None", None)],
                               "code string, name string, sealedProduct string")
    out = explode_tagged(df, "sealedProduct", {"code": "setCode", "name": "setName"},
                         element_schema="struct<uuid:string,name:string>", position="pos")
    assert sorted(tuple(r) for r in out.collect()) == [(0, "p1", "Box", "A25", "Masters"),
                                                        (1, "p2", "Pack", "A25", "Masters")]


def test_list_heuristic_overrides(spark):
    from tessera.sources.registry import Catalog
    df = spark.createDataFrame([("a, b", "x, y", "p, q")], "tags string, names string, owner string")
    c = Catalog(spark, overrides={"things": df}, list_columns={"things": {"extra": ["owner"], "ignore": ["names"]}})
    row = c.ensure_view("things").first()
    assert row["tags"] == ["a", "b"] and row["names"] == "x, y" and row["owner"] == ["p", "q"]


def test_shredding_types_every_field(spark):
    from tessera.sources.normalize import shred_json
    rows = [(1, '{"k": 1, "n": {"a": [1, 2]}, "m": "x"}'), (2, '{"k": 2.5, "m": 3, "a b": true}'), (3, "{bad"), (4, None),
            (5, "[1]"), (6, "{}")]
    out = {r.id: r for r in shred_json(spark.createDataFrame(rows[:4], "id int, props string"), "props").collect()}
    assert [float(out[1].k), float(out[2].k)] == [1.0, 2.5] and out[1].n.a == [1, 2] and out[2]["a b"] is True
    assert (out[1].m, out[2].m) == ('"x"', "3")                    # too different for one type
    assert out[3].k is None and out[4].m is None and out[1]["a b"] is None
    assert shred_json(spark.createDataFrame(rows[2:5], "id int, props string"), "props").columns == ["id"]
    assert shred_json(spark.createDataFrame(rows[:1], "id int, props string"), "props", prefix="p_").columns == [
        "id", "p_k", "p_m", "p_n"]


def test_a_table_written_anew_is_read_anew(spark, tmp_path):
    from tessera.sources.registry import load_table
    path = f"{tmp_path}/nation.parquet"
    spark.range(3).write.parquet(path)
    first = load_table(spark, str(tmp_path), "nation")
    assert first.count() == 3 and load_table(spark, str(tmp_path), "nation") is first
    spark.range(5).write.mode("overwrite").parquet(path)
    assert load_table(spark, str(tmp_path), "nation").count() == 5
    spark.range(2).write.mode("append").parquet(path)
    assert load_table(spark, str(tmp_path), "nation").count() == 7


def test_parts_of_a_nested_map_merge_again(spark):
    from tessera.operators import aggregates as A
    df = spark.range(3000).selectExpr("CAST(id % 3 = 0 AS INT) AS u", "CAST(id % 7 AS STRING) AS s",
                                      "CAST(id AS STRING) AS d", "CAST(id AS DOUBLE) AS p")
    parts = A.nested_map_parts(df, ["u"], ["s"], "d", "p", most=100)
    sizes = [sum(len(m) for m in r.prices.values()) for r in parts.collect()]
    assert sum(sizes) == 3000 and max(sizes) < 160 and len(sizes) >= 30
    whole = A.nested_map(df, ["u"], ["s"], "d", "p")
    merged = A.merge_parts(parts, ["u"], ["s"], "d", "p")
    assert {r.u: r.prices for r in merged.collect()} == {r.u: r.prices for r in whole.collect()}
