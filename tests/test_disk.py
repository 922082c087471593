"""What a run leaves on the disks: no dumps that are loaded, no shuffle files of finished writes, no scratch tables of finished steps."""

import os
import time

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_incremental import FIRST, SECOND, raw_reviews, rebuilt, rows, started, stored

from strata import registry
from strata.operators.rules import clean
from strata.operators.silver import SPECS
from strata.plans import incremental, layers
from strata.plans.incremental import apply_checkins, apply_reviews
from strata.plans.layers import Layout, RunSpec, run_bronze, run_gold, run_layers
from strata.plans.session import checkpoint_root, scratch_folder, scratch_path
from strata.sources.fixtures import raw
from strata.sources.raw import PACKED_SHRINK, packed, read_raw, write_raw
from strata.sources.sinks import write_table
from strata.sources.versions import read_table


def local(path):
    return path.removeprefix("file:")


def scratch_folders(spark):
    return set(os.listdir(f"{local(checkpoint_root(spark))}/strata"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def left(spark, before, seconds=20):
    """New shuffle files; Spark removes those of a finished write in the background."""
    until = time.time() + seconds
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def dumped(spark):
    return registry.write_raw_files(spark, SMALL, f"{scratch_path(spark, 'test-disk')}/raw")


def test_a_run_leaves_no_shuffle_files(spark):
    layout = dumped(spark)
    before = shuffle_files(spark)
    run_layers(spark, layout)
    assert not left(spark, before)


def test_dumps_are_compressed_and_go_when_they_are_loaded(spark, monkeypatch):
    seen = []
    remove = registry.remove
    monkeypatch.setattr(registry, "remove", lambda s, path: (seen.extend(f for _, _, fs in os.walk(local(path)) for f in fs), remove(s, path))[1])
    layout = registry._full_run(spark, SMALL)
    dumps = [f for f in seen if f.startswith("part-")]
    assert dumps and all(f.endswith(".json.gz") for f in dumps)
    assert not os.path.exists(local(layout.raw))
    assert read_table(spark, layout.gold("weekly_stars")).count() > 0


def test_a_compressed_dump_has_the_same_rows(spark):
    root = scratch_path(spark, "test-disk")
    df = raw(spark, SMALL, "review")
    write_raw(df, f"{root}/plain")
    write_raw(df, f"{root}/packed", "gzip")
    assert packed(spark, f"{root}/packed") and not packed(spark, f"{root}/plain") and not packed(spark, f"{root}/none")
    assert rows(read_raw(spark, f"{root}/packed")) == rows(read_raw(spark, f"{root}/plain"))


def test_compressed_dumps_are_dealt_by_the_text_in_them(spark):
    """Tasks get an eighth of ``raw_split_bytes`` of a compressed dump; every row lands once."""
    layout = Layout(root=(root := scratch_path(spark, "test-disk")), raw=f"{root}/raw")
    n = 4 * spark.sparkContext.defaultParallelism
    write_raw(spark.range(n, numPartitions=n).select(F.col("id").cast("string").alias("review_id")), layout.raw_file("review"), "gzip")
    spec = RunSpec(datasets=("review",), raw_split_bytes=PACKED_SHRINK * 4 * 1024 * 1024)
    assert run_bronze(spark, layout, spec) == {"review": n}
    assert len([f for f in os.listdir(local(layout.bronze("review"))) if f.endswith(".parquet")]) == n


def test_a_long_compressed_dump_is_several_files(spark, monkeypatch):
    import strata.sources.raw as source

    monkeypatch.setattr(source, "PACKED_ROWS", 10)
    write_raw(spark.range(95, numPartitions=1), path := f"{scratch_path(spark, 'test-disk')}/dump", "gzip")
    assert len([f for f in os.listdir(local(path)) if f.startswith("part-")]) == 10
    assert read_raw(spark, path).count() == 95


def test_an_arrival_goes_when_the_next_one_comes(spark):
    root = scratch_path(spark, "test-disk")
    part = F.pmod(F.xxhash64("date"), F.lit(3))
    layout, later = registry._arrivals(spark, SMALL, "checkin", root, part == 0, part == 1)
    assert not os.path.exists(f"{local(root)}/arrivals") and not os.path.exists(local(layout.raw))
    parts = []
    for batch, df in later:
        assert os.listdir(f"{local(root)}/arrivals") == [batch]
        parts += [tuple(r) for r in df.select("business_id", "date").collect()]
    assert not os.listdir(f"{local(root)}/arrivals")
    assert sorted(parts, key=repr) == sorted((tuple(r) for r in raw(spark, SMALL, "checkin").where(part != 0).collect()), key=repr)


@pytest.mark.parametrize("staged_bytes", [0, None])
def test_a_batch_of_reviews_leaves_its_tables_only(spark, monkeypatch, staged_bytes):
    layout, _ = started(spark, FIRST)
    spec, read = RunSpec(staged_bytes=staged_bytes), []
    replace = incremental.replace_partitions
    monkeypatch.setattr(incremental, "replace_partitions", lambda df, *a: (read.extend(df.inputFiles()), replace(df, *a))[1])
    batch = raw_reviews(spark, SECOND)
    folders, before = scratch_folders(spark), shuffle_files(spark)
    for _ in range(2):
        apply_reviews(spark, layout, "one", batch, spec)
    assert stored(spark, layout) == rebuilt(spark, layout, FIRST + SECOND)
    assert any("/strata/weekly-" in f for f in read) == (staged_bytes == 0)
    assert scratch_folders(spark) == folders


def test_a_batch_of_reviews_leaves_no_shuffle_files(spark):
    layout, spec = started(spark, FIRST)
    write_table(raw_reviews(spark, SECOND), path := scratch_path(spark, "test-disk"))
    batch, before = spark.read.parquet(path), shuffle_files(spark)
    apply_reviews(spark, layout, "one", batch, spec)
    assert not left(spark, before)


def test_a_batch_of_checkins_leaves_its_tables_only(spark):
    layout = Layout(root=scratch_path(spark, "test-disk"), raw="")
    lists = lambda *data: spark.createDataFrame(list(data), "business_id string, date string")
    first, second = lists(("a", "2020-01-01 10:00:00, bad")), lists(("a", "2020-01-01 10:00:00, 2020-01-02 10:00:00"), (" b", "2020-01-01 10:00:00"))
    business = spark.createDataFrame([(b, b, "c", "s", 4.0, 1) for b in "abd"], "business_id string, business_name string, city string, state string, stars double, review_count int")
    write_table(business, layout.silver("business"))
    write_table(clean(first, SPECS["checkin"]), layout.silver("checkin"))
    write_table(second, path := scratch_path(spark, "test-disk"))
    second, folders, before = spark.read.parquet(path), scratch_folders(spark), shuffle_files(spark)
    apply_checkins(spark, layout, "one", second)
    assert not left(spark, before)
    assert scratch_folders(spark) == folders
    assert {r.business_id: r.total_checkins for r in read_table(spark, layout.gold("checkins_vs_stars")).collect()} == {"a": 2, "b": 1, "d": 0}


def test_weekly_figures_staged_before_the_join(spark, monkeypatch):
    layout = dumped(spark)
    run_layers(spark, layout, RunSpec(staged_bytes=None))
    want, read, folders = rows(read_table(spark, layout.gold("weekly_stars"))), [], scratch_folders(spark)
    write = layers.write_partitioned
    monkeypatch.setattr(layers, "write_partitioned", lambda df, *a, **k: (read.extend(df.inputFiles()), write(df, *a, **k))[1])
    for size, yes in ((0, True), (1 << 40, False)):
        read.clear()
        run_gold(spark, layout, RunSpec(staged_bytes=size))
        assert any("/strata/weekly-" in f for f in read) == yes
        assert rows(read_table(spark, layout.gold("weekly_stars"))) == want
    assert scratch_folders(spark) == folders


def test_a_scratch_folder_goes_with_its_block(spark):
    with pytest.raises(ValueError, match="lost"), scratch_folder(spark, "test-disk") as folder:
        write_table(spark.range(3), f"{folder}/t")
        raise ValueError("lost")
    assert not os.path.exists(local(folder))
