"""Versioned transcripts: ids stay, replay changes nothing, old folders are not read."""

import random

import pytest

from millrace.streaming import versions

EVENTS = "username string, seq bigint, kind string, content string"


def expected(batches):
    """Ids by batch, time and name of the first login; the last later update counts."""
    ids, first, last = {}, {}, {}
    for batch in batches:
        for name, seq, kind, content in batch:
            if kind == "login":
                first[name] = min(first.get(name, seq), seq)
            elif name is not None:
                last[name] = max(last.get(name, (seq, content)), (seq, content))
        logins = [(seq, name) for name, seq, kind, _ in batch if kind == "login"]
        for _, name in sorted(logins):
            ids.setdefault(name, len(ids) + 1)
    text = {n: last[n][1] if n in last and last[n][0] > first[n] else "" for n in ids}
    return sorted((i, n, text[n]) for n, i in ids.items())


def rows(spark, path):
    return sorted(tuple(r) for r in versions.current(spark, path).collect())


@pytest.mark.parametrize("merge_every", [1, 2, 16])
def test_ids_stay_whatever_is_merged(spark, tmp_path, merge_every):
    rng = random.Random(4)
    events = [
        (f"u{rng.randrange(9)}", seq, rng.choice(["login", "update", "update"]), f"c{seq}")
        for seq in rng.sample(range(100), 40)
    ] + [("ghost", 3, "update", "lost"), (None, 4, "update", "of nobody")]
    batches = [events[0:14], [], events[14:28], events[28:]]
    path = str(tmp_path / "table")
    versions._point(spark, path, "start", versions.Version(-1, -1), "ignore")
    assert rows(spark, path) == []
    for n, batch in enumerate(batches):
        versions.write_batch(path, spark.createDataFrame(batch, EVENTS), n, merge_every)
        assert rows(spark, path) == expected(batches[: n + 1])
    # A batch that is done changes nothing, whatever it holds by now.
    versions.write_batch(path, spark.createDataFrame([("x", 1, "login", "")], EVENTS), 3, merge_every)
    assert rows(spark, path) == expected(batches)
    with pytest.raises(ValueError, match="another checkpoint"):
        versions.write_batch(path, spark.createDataFrame([], EVENTS), 1, merge_every)


def test_a_cut_batch_is_written_again_and_old_folders_are_not_read(spark, tmp_path):
    path = str(tmp_path / "table")
    versions._point(spark, path, "start", versions.Version(-1, -1), "ignore")
    batches = [[(f"u{n}", n, "login", ""), (f"u{n}", 10 + n, "update", f"c{n}")] for n in range(4)]
    for n in range(3):
        versions.write_batch(path, spark.createDataFrame(batches[n], EVENTS), n, 3)
    # Batch 3 got as far as its delta; the pointer does not name it.
    half = spark.createDataFrame([], versions.STATE)
    half.write.parquet(f"{path}/delta/batch_id=3")
    assert rows(spark, path) == expected(batches[:3])
    for file in (tmp_path / "table" / "delta").rglob("part-*"):
        if "batch_id=3" not in str(file):
            file.write_bytes(b"not read any more")
    versions.write_batch(path, spark.createDataFrame(batches[3], EVENTS), 3, 3)
    assert rows(spark, path) == expected(batches)
    assert versions.newest(spark, path) == versions.Version(2, 3)


def test_a_login_without_a_name_fails(spark, tmp_path):
    path = str(tmp_path / "table")
    versions._point(spark, path, "start", versions.Version(-1, -1), "ignore")
    nameless = spark.createDataFrame([(None, 1, "login", "")], EVENTS)
    with pytest.raises(Exception, match="without a username"):
        versions.write_batch(path, nameless, 0, 2)
    assert rows(spark, path) == []
