"""Logged folders and publishing once."""

import pytest
from pyspark.sql import functions as F

from streamlens.functions.schemas import flat_schema
from streamlens.sinks.log import LoggedFolder
from streamlens.sinks.outbox import PublishOnce, TopicFolder

ROWS = flat_schema(k="long", v="string")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def batch(spark, i, n=3, mark="a"):
    return frame(spark, *((10 * i + j, f"{mark}{i}") for j in range(n)))


def seen(df):
    return sorted((r.run_id, r.batch_id, r.k, r.v) for r in df.collect())


def want(*batches, n=3, run="run"):
    return sorted((run, i, 10 * i + j, f"{mark}{i}") for i, mark in batches for j in range(n))


@pytest.fixture
def sink(tmp_path):
    return LoggedFolder(str(tmp_path / "table"), ROWS)


def test_a_batch_written_again_is_there_once(spark, sink):
    assert sink.read(spark).collect() == [] and sink.read(spark).columns == ["k", "v", "run_id", "batch_id"]
    for i in range(3):
        sink.write(batch(spark, i), i)
    sink.write(batch(spark, 1, mark="b"), 1)
    assert seen(sink.read(spark)) == want((0, "a"), (1, "b"), (2, "a"))
    sink.write(frame(spark).limit(0), 2)
    assert seen(sink.read(spark)) == want((0, "a"), (1, "b"))


def test_a_reader_sees_every_batch_once_whatever_is_written_meanwhile(spark, sink):
    for i in range(6):
        sink.write(batch(spark, i), i)
    before = sink.read(spark)
    sink.write(batch(spark, 2, mark="b"), 2)
    between = sink.read(spark)
    assert sink.compact(spark) == 6
    after = sink.read(spark)
    sink.write(batch(spark, 4, mark="c"), 4)
    old = want(*((i, "a") for i in range(6)))
    new = want(*((i, "b" if i == 2 else "a") for i in range(6)))
    assert seen(before) == old
    assert seen(between) == seen(after) == new
    last = want(*((i, {2: "b", 4: "c"}.get(i, "a")) for i in range(6)))
    assert seen(sink.read(spark)) == last
    # Compacted again, the replaced rows are gone for good.
    assert sink.compact(spark) == 2
    assert seen(sink.read(spark)) == last
    assert sink.read(spark).inputFiles()[0].count("folder=") == 1 and len(sink.read(spark).inputFiles()) == 1


def test_a_batch_that_runs_again_during_a_compaction_stays_new(spark, sink, monkeypatch):
    for i in range(4):
        sink.write(batch(spark, i), i)
    store = LoggedFolder._store

    def interrupted(self, rows):
        stored = store(self, rows)
        monkeypatch.setattr(LoggedFolder, "_store", store)
        sink.write(batch(spark, 1, mark="b"), 1)
        assert sink.compact(spark) == 4
        return stored

    monkeypatch.setattr(LoggedFolder, "_store", interrupted)
    sink.compact(spark)
    assert seen(sink.read(spark)) == want((0, "a"), (1, "b"), (2, "a"), (3, "a"))


def test_what_was_not_committed_is_not_there(spark, sink, monkeypatch):
    sink.write(batch(spark, 0), 0)

    def killed(self, entry):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(LoggedFolder, "_commit", killed)
        with pytest.raises(RuntimeError):
            sink.write(batch(spark, 0, mark="b"), 0)
    assert seen(sink.read(spark)) == want((0, "a"))
    sink.write(batch(spark, 0, mark="c"), 0)
    assert seen(sink.read(spark)) == want((0, "c"))


def test_vacuum_deletes_what_is_out_of_use(spark, sink):
    for i in range(4):
        sink.write(batch(spark, i), i)
    sink.compact(spark)
    sink.write(batch(spark, 3, mark="b"), 3)
    assert sink.vacuum(spark, older_than=3600) == 0
    # Four folders and the six entries.
    assert sink.vacuum(spark, older_than=-1) == 4 + 6
    expected = want((0, "a"), (1, "a"), (2, "a"), (3, "b"))
    assert seen(sink.read(spark)) == expected
    sink.write(batch(spark, 3, mark="c"), 3)
    sink.compact(spark)
    sink.vacuum(spark, older_than=-1)
    assert seen(sink.read(spark)) == want((0, "a"), (1, "a"), (2, "a"), (3, "c"))


def test_runs_do_not_replace_each_other(spark, sink):
    other = LoggedFolder(sink.path, ROWS, "other")
    sink.write(batch(spark, 0), 0)
    other.write(batch(spark, 0, mark="b"), 0)
    assert seen(sink.read(spark)) == want((0, "b"), run="other") + want((0, "a"))


# --- publishing ---------------------------------------------------------------


class Dying(TopicFolder):
    moment = None

    def send(self, records):
        if self.moment == "before":
            raise RuntimeError("killed")
        super().send(records)
        if self.moment == "after":
            raise RuntimeError("killed")


@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_record_is_sent_once_and_as_first_written_down(spark, tmp_path, moment):
    target = Dying(str(tmp_path / "topic"))
    publisher = PublishOnce.below(str(tmp_path / "outbox"), target)
    one, other = (spark.createDataFrame([(v,)], "value string") for v in ("first", "second"))
    object.__setattr__(target, "moment", moment)
    with pytest.raises(RuntimeError):
        publisher.write(one, 7)
    object.__setattr__(target, "moment", None)
    for _ in range(2):
        publisher.write(other, 7)
    publisher.write(other, 8)
    assert sorted(tuple(r) for r in target.read(spark).collect()) == [("run/7", "first"), ("run/8", "second")]
    assert {(r.batch_id, r.sent) for r in publisher.read(spark).collect()} == {(7, True), (8, True)}


def test_a_batch_without_a_record_sends_nothing(spark, tmp_path):
    target = TopicFolder(str(tmp_path / "topic"))
    publisher = PublishOnce.below(str(tmp_path / "outbox"), target)
    publisher.write(spark.createDataFrame([], "value string"), 0)
    assert not target.has(spark, "run/0")
    assert publisher.read(spark).collect() == []
