import os

import pytest
from pyspark.sql import functions as F

from rollcall.sources.sinks import export_csv, layer_path, read_csv, read_layer, versions, write_layer, write_layer_if_any


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/layer"


def rows(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("n"), "id").alias("name"))


def broken(df, at):
    """``df``, whose last rows make their task fail."""

    def fail(batches):
        for batch in batches:
            if batch.num_rows and batch.column(0)[batch.num_rows - 1].as_py() >= at:
                raise RuntimeError("killed")
            yield batch

    return df.mapInArrow(fail, df.schema)


def test_the_last_commit_is_read(spark, path):
    for n in (3, 5, 2):
        assert write_layer(rows(spark, n), path).count() == n
        assert read_layer(spark, path).count() == n
    assert [v for v, _ in versions(spark, path)] == [2, 3]  # of older ones, nothing stays
    assert sum(x.startswith("version-") for x in os.listdir(path)) == 2
    with pytest.raises(FileNotFoundError):
        read_layer(spark, f"{path}/other")


def test_a_killed_write_leaves_the_old_layer(spark, path):
    write_layer(rows(spark, 4), path)
    before = layer_path(spark, path)
    with pytest.raises(Exception, match="killed"):
        write_layer(broken(rows(spark, 1000).repartition(4), 990), path)
    assert layer_path(spark, path) == before and read_layer(spark, path).count() == 4
    assert write_layer(rows(spark, 6), path).count() == 6


def test_a_commit_that_was_not_filled_counts_for_nothing(spark, path):
    write_layer(rows(spark, 4), path)
    open(f"{path}/_commits/000000002", "w").close()
    assert read_layer(spark, path).count() == 4
    with pytest.raises(RuntimeError, match="version 2"):
        write_layer(rows(spark, 5), path)
    assert read_layer(spark, path).count() == 4


def test_of_two_writers_the_second_fails(spark, path, monkeypatch):
    from rollcall.sources import sinks

    write_layer(rows(spark, 1), path)
    seen = versions(spark, path)
    write_layer(rows(spark, 2), path)
    with monkeypatch.context() as late:
        late.setattr(sinks, "versions", lambda *_: seen)  # as if it had looked before the first one's commit
        with pytest.raises(RuntimeError, match="version 2"):
            write_layer(rows(spark, 3), path)
    assert read_layer(spark, path).count() == 2


def test_an_empty_result_is_not_committed(spark, path):
    assert write_layer_if_any(rows(spark, 0), path).count() == 0
    assert write_layer_if_any(rows(spark, 3), path).count() == 3
    assert write_layer_if_any(rows(spark, 0), path).count() == 3
    assert read_layer(spark, path).count() == 3 and len(versions(spark, path)) == 2


def test_readers_under_way_keep_their_version(spark, path):
    old = write_layer(rows(spark, 3), path)
    write_layer(rows(spark, 9), path)
    assert old.count() == 3


def test_a_killed_export_leaves_the_old_one(spark, tmp_path):
    path = f"{tmp_path}/out"
    export_csv(rows(spark, 3), path)
    with pytest.raises(Exception, match="killed"):
        export_csv(broken(rows(spark, 1000).repartition(4), 990), path)
    assert read_csv(spark, path, "id long, name string").count() == 3
    export_csv(rows(spark, 7), path, order=("id",))
    assert read_csv(spark, path, "id long, name string").count() == 7
    assert os.listdir(tmp_path) == ["out"]
