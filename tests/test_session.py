from types import SimpleNamespace

import pytest

from forgepulse.session import INITIAL_PARTITIONS, scratch_path, settings, sized_shuffles


def test_settings_are_put_back(spark):
    key, unset = "spark.sql.shuffle.partitions", "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with pytest.raises(KeyError), settings(spark, {key: "3", unset: "2"}):
        assert spark.conf.get(key) == "3"
        raise KeyError
    assert spark.conf.get(key) == before
    assert spark.conf.get(unset) == "0"


def test_shuffles_grow_with_the_input(spark):
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    for size, partitions in ((0, floor), (100 << 30, 400), (100 << 40, 50_000)):
        with sized_shuffles(spark, size) as n:
            assert n == partitions == int(spark.conf.get(INITIAL_PARTITIONS))
        assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def test_scratch_is_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


def test_scratch_without_a_shared_folder():
    def session(master):
        return SimpleNamespace(conf={"spark.master": master})

    assert "forgepulse-" in scratch_path(session("local[4]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn"), "x")
