"""Compaction beside a running sink."""

import os

import pytest

from tillwork.plans.feed import drain_feed
from tillwork.schemas import all_strings
from tillwork.sources.versions import VersionConflict, VersionedTables
from tillwork.streaming.compaction import committed_files, compact, read_compacted
from tillwork.streaming.endpoints import file_topic_stream, publish_to_files

SCHEMA = all_strings(["id", "name"])


class Feed:
    def __init__(self, spark, root):
        self.spark = spark
        self.topic, self.sink, self.root, self.state = (
            str(root / name) for name in ("topic", "sink", "large", "state")
        )

    def store(self, *ids):
        rows = self.spark.createDataFrame([(i, "x") for i in ids], SCHEMA).repartition(len(ids))
        publish_to_files(rows, self.topic)
        drain_feed(file_topic_stream(self.spark, self.topic, 2), SCHEMA, self.sink, self.state)

    def compact(self, **how):
        return compact(self.spark, self.sink, self.root, SCHEMA, **how)

    def ids(self):
        return sorted(r.id for r in read_compacted(self.spark, self.sink, self.root, SCHEMA).collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def parquet_files(root):
    return [f for _, _, names in os.walk(f"{root}/rows") for f in names if f.endswith(".parquet")]


def test_each_row_once_before_during_and_after(feed, spark):
    feed.store("a", "b", "c", "d")
    assert feed.ids() == ["a", "b", "c", "d"]
    small = len(committed_files(spark, feed.sink, SCHEMA))
    assert feed.compact() == small > 1
    assert len(parquet_files(feed.root)) == 1
    assert feed.ids() == ["a", "b", "c", "d"]
    assert feed.compact() == 0
    feed.store("e", "e")
    assert feed.ids() == ["a", "b", "c", "d", "e", "e"]
    feed.compact()
    assert feed.ids() == ["a", "b", "c", "d", "e", "e"]


def test_bins_follow_the_size(feed):
    feed.store("a", "b", "c", "d")
    feed.compact(target_bytes=40)
    assert len(parquet_files(feed.root)) > 1
    assert feed.ids() == ["a", "b", "c", "d"]


def test_an_interrupted_compaction_changes_nothing(feed, monkeypatch):
    feed.store("a", "b")

    def lost(self, version, listing):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTables, "commit", lost)
        with pytest.raises(RuntimeError):
            feed.compact()
    assert feed.ids() == ["a", "b"]
    feed.compact()
    assert feed.ids() == ["a", "b"]


def test_two_compactions_at_once(feed, monkeypatch):
    feed.store("a", "b")
    commit = VersionedTables.commit

    def late(self, version, listing):
        monkeypatch.setattr(VersionedTables, "commit", commit)
        feed.compact()
        return commit(self, version, listing)

    monkeypatch.setattr(VersionedTables, "commit", late)
    with pytest.raises(VersionConflict):
        feed.compact()
    assert feed.ids() == ["a", "b"]


def test_uncommitted_files_are_not_read(feed, spark):
    feed.store("a")
    with open(f"{feed.sink}/part-left-over.json", "w") as file:
        file.write('{"id":"z"}\n')
    assert feed.ids() == ["a"]
    feed.compact()
    assert feed.ids() == ["a"]
