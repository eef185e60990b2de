import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import blocks, positions, slicing
from millrace.plans.skew import rank_with_sums
from millrace.sources import jsonl


def test_positions_over_many_files_and_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 37) if i % 11 else "" for i in range(5000)]
    for part, (a, b) in enumerate([(0, 2), (2, 2), (2, 3100), (3100, 5000)]):
        text = "\n".join(lines[a:b])
        # The last file has no final newline.
        (tmp_path / f"part-{part}.jsonl").write_text(text + ("\n" if b < 5000 and b > a else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = jsonl.scan_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.value for r in sorted(rows)] == lines
    assert sorted(r.row_idx for r in rows) == list(range(5000))


def test_empty_file_has_no_rows(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("")
    assert jsonl.scan_lines(spark, str(tmp_path)).count() == 0


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jsonl.scan_lines(spark, str(tmp_path / "absent.jsonl"))


def test_key_positions_survive_further_use(spark):
    keys = random.Random(3).sample(range(10**9), 4000)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    indexed = positions.index_by_key(df, "k", partitions=13)
    got = {r.k: r.row_idx for r in indexed.where("k % 2 = 0").collect()}
    expected = {k: i for i, k in enumerate(sorted(keys))}
    assert got == {k: i for k, i in expected.items() if k % 2 == 0}


def test_permutation_differs_by_epoch_and_repeats_by_seed(spark):
    rows = spark.range(500).select(F.col("id").alias("row_idx"))

    def orders(seed):
        got = {}
        for r in positions.permute(rows, 500, seed, 2).collect():
            got.setdefault(r.epoch, {})[r.position] = r.row_idx
        return [[got[e][i] for i in range(500)] for e in (0, 1)]

    first, again, other = orders(1), orders(1), orders(2)
    assert first == again
    assert first[0] != first[1] and first != other
    assert sorted(first[0]) == sorted(first[1]) == list(range(500))


@pytest.mark.parametrize(
    ("split", "rows"),
    [
        ("train", range(10)), ("train[]", range(10)), ("train[:]", range(10)),
        ("[0:3]", range(3)), ("[:3]", range(3)), ("[7:]", range(7, 10)), ("[-3:]", range(7, 10)),
        ("[:-3]", range(7)), ("[25%]", range(2)), ("[:10%]", range(1)), ("[5:2]", []),
        ("[20:30]", []), ("[-20:2]", range(2)), ("[0:4:2]", range(4)), ("[0%]", []),
        ("[100%]", range(10)), ("[12.5%]", range(1)),
    ],
)
def test_split_bounds(split, rows):
    start, stop = slicing.split_bounds(split, 10)
    assert list(range(start, stop)) == list(rows)


@pytest.mark.parametrize("split", ["[5]", "[x:2]", "[110%]", "[-1%]", "[1:10%]", "[a%]"])
def test_bad_splits(split):
    with pytest.raises(ValueError):
        slicing.split_bounds(split, 10)


def test_all_integer_slices_match_python_lists():
    data = list(range(7))
    for a in [None, *range(-9, 10)]:
        for b in [None, *range(-9, 10)]:
            body = f"[{'' if a is None else a}:{'' if b is None else b}]"
            start, stop = slicing.split_bounds(body, 7)
            assert data[start:stop] == data[a:b], body


def test_lookup_repeats_and_rejects(spark):
    indexed = spark.range(6).select(F.col("id").alias("row_idx"), (F.col("id") * 2).alias("v"))
    wanted = spark.createDataFrame([(4,), (0,), (4,)], "row_idx bigint")
    assert sorted(r.v for r in slicing.lookup(indexed, wanted).collect()) == [0, 8, 8]
    for bad in (-1, 6):
        with pytest.raises(Exception, match="out of range"):
            slicing.lookup(indexed, spark.createDataFrame([(bad,)], "row_idx bigint")).collect()


def test_blocks_hold_every_neighbour(spark):
    df = spark.range(50).select(F.col("id").alias("pos"))
    rows = blocks.with_blocks(df, "pos", before=3, after=2, size=7).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r._block, set()).add(r.pos)
    own = [r for r in rows if r._own]
    assert sorted(r.pos for r in own) == list(range(50))
    for r in own:
        needed = set(range(max(r.pos - 3, 0), min(r.pos + 3, 50)))
        assert needed <= seen[r._block]
    assert max(len(s) for s in seen.values()) <= 12


@pytest.mark.parametrize("partitions", ["1", "8", "61"])
def test_groups_of_any_size_rank_alike(spark, partitions):
    rng = random.Random(5)
    # One group holds most rows, half of them with the same value; some have none.
    rows = [
        (1, f"{i:04}", None if i % 50 == 7 else 0.5 if i % 2 else rng.randrange(60) / 60, float(i % 3))
        for i in range(3000)
    ]
    rows += [(2, f"{i:04}", (None, rng.random())[i % 2], 1.0) for i in range(5)]
    rows += [(None, f"{i:04}", float("nan") if i else 1.0, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "g int, c string, v double, w double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        ranked = rank_with_sums(df, ["g"], "v", "c", {"before": "w"}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {(r.g, r.c): (r.rank, r.before) for r in ranked}
    expected = {}

    def place(row):
        value = row[2]
        # NaN is the largest, null comes last.
        return (value is None, 0 if value is None else -1e9 if value != value else -value, row[1])

    for g in (1, 2, None):
        total = 0.0
        for nth, r in enumerate(sorted((r for r in rows if r[0] == g), key=place), 1):
            expected[(g, r[1])] = (nth, total)
            total += r[3]
    assert got == expected
