"""Stored indexes give the rows of the whole table and open only the parts they need."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import stored
from millrace.sources import jsonl

SLICES = [(0, 3), (0, 1000), (249, 251), (250, 500), (999, 1000), (400, 400), (700, 300), (5000, 6000)]


@pytest.fixture
def lines(spark, tmp_path):
    """Four compressed files of 250 lines, an empty one, and their texts in order."""
    texts = [f"line {i} " + "x" * (i % 29) for i in range(1000)]
    for k in range(4):
        df = spark.createDataFrame([(t,) for t in texts[250 * k : 250 * (k + 1)]], "value string")
        df.coalesce(1).write.option("compression", "gzip").text(str(tmp_path / f"in [a] b/{k}"))
    (tmp_path / "in [a] b" / "2" / "part-z.txt").write_text("")
    return str(tmp_path / "in \\[a\\] b" / "*"), texts


def spoil(folder, keep):
    """Make every data file but those under ``keep`` unreadable."""
    for file in folder.rglob("part-*"):
        if file.suffix != ".crc" and file.stat().st_size and not any(k in str(file) for k in keep):
            file.write_bytes(b"no archive, no table" * 20)
            for crc in file.parent.glob(f".{file.name}.crc"):
                crc.write_bytes(b"crc\x00")


def test_slices_of_lines(spark, lines):
    path, texts = lines
    index = jsonl.stored_lines(spark, path)
    assert index.n_rows() == 1000
    assert index.parts.count() == 4
    for start, stop in SLICES:
        rows = sorted(index.slice(start, stop).collect())
        assert [r.value for r in rows] == texts[start:stop] if start < stop else not rows
        assert [r.row_idx for r in rows] == list(range(start, min(stop, 1000)))
    assert [r.value for r in sorted(index.split("train[-3:]").collect())] == texts[-3:]


def test_a_slice_of_lines_opens_its_file_only(spark, lines, tmp_path):
    path, texts = lines
    index = jsonl.stored_lines(spark, path, str(tmp_path / "index"))
    spoil(tmp_path / "in [a] b", ["b/1/"])
    assert [r.value for r in sorted(index.slice(250, 253).collect())] == texts[250:253]
    wanted = spark.createDataFrame([(260,), (260,), (499,)], "row_idx bigint")
    assert sorted(r.row_idx for r in index.lookup(wanted).collect()) == [260, 260, 499]
    again = stored.StoredLines(spark.read.parquet(str(tmp_path / "index")), spark.read.text(path))
    assert again.slice(498, 500).count() == 2
    with pytest.raises(Exception):
        index.slice(0, 251).collect()


def test_a_file_that_changed_fails(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.jsonl").write_text("a\nb\n")
    index = jsonl.stored_lines(spark, str(tmp_path / "*.jsonl"))
    (tmp_path / "1.jsonl").write_text("a\nb\nc\n")
    spark.catalog.refreshByPath(str(tmp_path))
    with pytest.raises(Exception, match="changed since it was indexed"):
        jsonl.StoredLines(index.parts, spark.read.text(str(tmp_path / "*.jsonl"))).slice(2, 4).collect()


def test_rows_in_key_order(spark):
    keys = random.Random(5).sample(range(10**6), 1000)
    df = spark.createDataFrame([(k, -k, k % 7) for k in keys], "part int, place int, `a b` int")
    index = stored.store_rows(df, "part", part_rows=90)
    keys.sort()
    assert index.parts.count() > 5
    for start, stop in SLICES:
        rows = sorted(index.slice(start, stop).collect())
        expected = keys[start:stop] if start < stop else []
        assert [tuple(r) for r in rows] == [(start + i, k, -k, k % 7) for i, k in enumerate(expected)]
    wanted = [0, 0, 17, 400, 999]
    rows = index.lookup(spark.createDataFrame([(w,) for w in wanted], "row_idx bigint")).collect()
    assert sorted((r.row_idx, r.part) for r in rows) == [(w, keys[w]) for w in wanted]


def test_a_slice_of_rows_reads_one_folder_and_its_places(spark):
    df = spark.range(1000).withColumn("text", F.repeat(F.lit("x"), F.col("id").cast("int")))
    index = stored.store_rows(df, "id", part_rows=100)
    plan = index.slice(0, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(place,0), LessThan(place,3)" in plan
    assert "(part#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "Exchange" not in plan and "Join" not in plan
    narrow = index.slice(0, 3).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "struct<row:struct<id:bigint>,place:bigint>" in narrow


@pytest.mark.parametrize("named", [0, 1000])
def test_lookup_by_names_and_by_range(spark, monkeypatch, named):
    monkeypatch.setattr(stored, "NAMED_PARTS", named)
    index = stored.store_rows(spark.range(1000), "id", part_rows=50)
    rng = random.Random(named)
    wanted = [rng.randrange(1000) for _ in range(300)] + [7] * 200
    rows = index.lookup(spark.createDataFrame([(w,) for w in wanted], "row_idx bigint")).collect()
    assert sorted((r.row_idx, r.id) for r in rows) == sorted((w, w) for w in wanted)


def test_uneven_parts_are_found(spark):
    sizes = [1, 900, 1, 3, 95]
    firsts = [sum(sizes[:k]) for k in range(5)]
    parts = spark.createDataFrame(
        list(zip("abcde", firsts, sizes)), "part string, first_row bigint, n_rows bigint"
    )
    placed = stored.place(spark.range(1000).withColumnRenamed("id", "row_idx"), parts).collect()
    expected = [(i, p) for p, f, n in zip("abcde", firsts, sizes) for i in range(f, f + n)]
    assert sorted(tuple(r) for r in placed) == expected


@pytest.mark.parametrize("bad", [-1, 4, None])
def test_wrong_positions_fail(spark, bad):
    index = stored.store_rows(spark.range(4), "id")
    with pytest.raises(Exception, match="out of range"):
        index.lookup(spark.createDataFrame([(bad,)], "row_idx bigint")).collect()


def test_empty_tables(spark, tmp_path):
    index = stored.store_rows(spark.range(0), "id")
    assert index.n_rows() == 0
    assert index.split("train[:5]").columns == ["row_idx", "id"]
    assert index.split("train").count() == 0
    assert index.lookup(spark.createDataFrame([], "row_idx bigint")).count() == 0
    (tmp_path / "a.jsonl").write_text("")
    empty = jsonl.stored_lines(spark, str(tmp_path / "a.jsonl"))
    assert empty.split("train").count() == 0
    with pytest.raises(ValueError):
        stored.store_rows(spark.range(1).withColumnRenamed("id", "row_idx"), "row_idx")
