import pytest
from pyspark.sql import functions as F

from palmleaf.sources import jsonl, tables, xlsx
from palmleaf.streaming import cleaners


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_permissive_reader(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", '{"instruction": "a", "response": "b"}', "", "[1,2]", '"str"', "{bad", '{"instruction": null, "response": "x"}', '{"response": "x"}', '{"instruction": "i"}', '{"instruction": "1", "instruction": "2", "response": "r"}')
    records, bad = jsonl.read_permissive(spark, p)
    got = {r["line"]: (r["status"], r["instruction"]) for r in jsonl.route(records).collect()}
    assert got == {1: ("Validate", "a"), 3: ("Record is not a JSON object", None), 4: ("Record is not a JSON object", None), 6: ("Validate", None), 7: ("Missing instruction", None), 8: ("Missing response", "i"), 9: ("Validate", "2")}
    assert [r["line"] for r in bad.collect()] == [5]
    with pytest.raises(ValueError, match="line 5"):
        jsonl.read_checked(spark, p)


def test_other_readers(spark, tmp_path):
    p = write(tmp_path / "b.jsonl", '{"instruction": " a", "response": "b"}', "  ", '{"instruction": "c", "response": "ಕ"}')
    assert jsonl.read_skipping_blanks(spark, p).count() == 2 and jsonl.read_strict(spark, p).count() == 2
    assert [(r["line"], r["instruction"]) for r in jsonl.read_checked(spark, p).orderBy("line").collect()] == [(1, "a"), (3, "c")]
    with pytest.raises(Exception):
        jsonl.read_strict(spark, write(tmp_path / "c.jsonl", "{bad")).collect()
    with pytest.raises(ValueError, match="line 1"):
        jsonl.read_checked(spark, write(tmp_path / "d.jsonl", '{"instruction": "", "response": "b"}'))
    with pytest.raises(Exception):
        spark.read.text(str(tmp_path / "none")).count()


def test_write_routed(spark, tmp_path):
    df = spark.createDataFrame([("a", "Kept"), ("ಕ", "bad")], "instruction STRING, reason STRING")
    jsonl.write_routed(df, "reason", "Kept", (f"{tmp_path}/k", f"{tmp_path}/r"))
    assert spark.read.json(f"{tmp_path}/k").columns == ["instruction"] and "ಕ" in spark.read.text(f"{tmp_path}/r").first()[0]


def test_xlsx_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a <&> b", "ಕ\nಗ", 3, 2.5, True, "NA"), (None, " x ", None, 4.0, False, "7"), ("n/a", "y", 12, None, None, None)], "` English ` STRING, Tulu STRING, n INT, r DOUBLE, b BOOLEAN, m STRING")
    p = f"{tmp_path}/deep/er/t.xlsx"
    assert xlsx.write(df, p) == 3
    got = xlsx.read(spark, p)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("file", "string"), ("pos", "bigint"), ("English", "string"), ("Tulu", "string"), ("n", "bigint"), ("r", "double"), ("b", "boolean"), ("m", "string")]
    assert [tuple(r)[1:] for r in got.orderBy("pos").collect()] == [(0, "a <&> b", "ಕ\nಗ", 3, 2.5, True, None), (1, None, " x ", None, 4.0, False, "7"), (2, None, "y", 12, None, None, None)]
    assert [r["m"] for r in xlsx.read(spark, p, infer=False).orderBy("pos").collect()] == ["NA", "7", None]
    many = spark.range(25).selectExpr("id", "CASE WHEN id > 3 THEN id / 2 END AS half").repartition(3)
    assert xlsx.write_parts(many, f"{tmp_path}/parts", sheet_rows=4) == 25
    back = xlsx.read(spark, f"{tmp_path}/parts")
    assert back.count() == 25 and back.filter("id > 3 AND half = id / 2").count() == 21 and back.select("file").distinct().count() >= 7
    assert xlsx.write(df.limit(0), f"{tmp_path}/none.xlsx") == 0 and xlsx.read(spark, f"{tmp_path}/none.xlsx").count() == 0


def test_tables(spark, tmp_path):
    df = tables.trim_headers(spark.createDataFrame([(1,)], "` a ` INT"))
    assert df.columns == ["a"]
    with pytest.raises(ValueError, match="b"):
        tables.require(df, "a", "b")
    assert tables.Paths("r").cleaned == "r/cleaned"
    p = write(tmp_path / "s.jsonl", '{"instruction": "a", "response": "b"}')
    assert {r["split"] for r in tables.splits(spark, {"train": p, "test": p}).collect()} == {"train", "test"}
    assert tables.with_position(spark.range(3)).select("pos").distinct().count() == 3
    assert [r["pos"] for r in tables.first_rows(tables.literal(spark, list("abc")), 2).collect()] == [0, 1]


def test_streams(spark, tmp_path):
    src = spark.createDataFrame([("2024-01-01 00:00:00", "q", "ಮನೆ"), ("2024-01-01 00:10:00", "Q", "ಮನೆ"), ("2024-01-01 02:00:00", "z", "y")], "t STRING, instruction STRING, response STRING").withColumn("t", F.to_timestamp("t"))
    src.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(src.schema).parquet(f"{tmp_path}/in")
    for name, df in (("dedup", cleaners.dedup_stream(cleaners.clean_stream(stream), "t")), ("two", cleaners.clean_stream(stream, 2))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("dedup").count() == 2 and spark.table("two").count() == 3
    q = cleaners.counts_by_window(cleaners.clean_stream(stream), "t").writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {(r["reason"], r["pairs"]) for r in spark.table("counts").collect()} == {("Kept", 2), ("Empty or too short after cleaning", 1)}
