import itertools

import pytest
from pyspark.sql import functions as F

from millrace.operators import manifest
from millrace.sources.samples import write_samples


def in_order(spark, n, epochs=1):
    return spark.range(n * epochs).select(
        F.expr(f"cast(id div {n} as int)").alias("epoch"),
        (F.col("id") % n).alias("position"),
        (F.col("id") % n).alias("row_idx"),
    )


def shards(spark, n, world):
    got = {}
    for r in manifest.shard(in_order(spark, n), n, world).collect():
        got.setdefault(r.rank, {})[r.seq] = r.row_idx
    return [[got[r][i] for i in range(len(got[r]))] for r in range(world)]


def test_shards_wrap(spark):
    assert shards(spark, 10, 4) == [[0, 4, 8], [1, 5, 9], [2, 6, 0], [3, 7, 1]]
    assert shards(spark, 10, 1) == [list(range(10))]
    # More ranks than rows: rows repeat as often as needed.
    assert shards(spark, 2, 5) == [[0], [1], [0], [1], [0]]


def test_batches_and_skips(spark):
    rows = manifest.assign_batches(manifest.shard(in_order(spark, 10), 10, 1), 4)
    sizes = sorted((r.batch_id, r.n_rows) for r in manifest.batch_sizes(rows).collect())
    assert sizes == [(0, 4), (1, 4), (2, 2)]
    left = [manifest.batch_sizes(manifest.skip_batches(rows, k)).count() for k in range(5)]
    assert left == [3, 2, 1, 0, 0]


@pytest.mark.parametrize(("n", "size", "accumulation"), [(10, 1, 4), (7, 1, 3), (5, 2, 1), (3, 1, 8), (9, 2, 2)])
def test_update_groups(spark, n, size, accumulation):
    epochs, world = 3, 2
    rows = manifest.assign_batches(manifest.shard(in_order(spark, n, epochs), n, world), size)
    lengths = manifest.plan_lengths(rows)
    got = {
        (r.rank, r.epoch, r.batch_id): (r.update_id, r.applied)
        for r in manifest.update_groups(manifest.batch_sizes(rows), lengths, accumulation).collect()
    }
    per_epoch = lengths.first().n_batches
    assert per_epoch == -(-(-(-n // world)) // size)
    for rank in range(world):
        expected, pending, updates = {}, [], 0
        for epoch, batch in itertools.product(range(epochs), range(per_epoch)):
            pending.append((rank, epoch, batch))
            step = batch + 1
            if (step + 1) % accumulation == 0:
                expected |= {key: (updates, True) for key in pending}
                pending, updates = [], updates + 1
        expected |= {key: (updates, False) for key in pending}
        assert {k: v for k, v in got.items() if k[0] == rank} == expected


def test_sample_sink_is_in_reading_order(spark, tmp_path):
    rows = manifest.assign_batches(manifest.shard(in_order(spark, 50, 2), 50, 2), 4)
    path = str(tmp_path / "samples")
    write_samples(rows.repartition(7), path, files=3)
    read = [
        (r.epoch, r.rank, r.batch_id, r.pos_in_batch)
        for r in spark.read.parquet(path)
        .withColumn("f", F.col("_metadata.file_name"))
        .withColumn("i", F.col("_metadata.row_index"))
        .orderBy("f", "i")
        .collect()
    ]
    assert read == sorted(read) and len(read) == 100
