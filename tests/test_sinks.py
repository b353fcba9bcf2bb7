import pytest

from streamlens.__main__ import main
from streamlens.config import JobConfig
from streamlens.functions.schemas import flat_schema
from streamlens.sinks.batches import FolderSink, TableSink, run_name
from streamlens.sinks.messages import FolderPublisher, KafkaPublisher, kafka_write_options
from streamlens.sources.scratch import fresh_folder, settle, shared_folder
from streamlens.sources.streams import kafka_read_options, kafka_source
from streamlens.sources.tables import catalog_table, orc_table

ROWS = flat_schema(k="long", v="string")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def stored(sink, spark):
    return sorted((r.batch_id, r.k, r.v) for r in sink.read(spark).collect())


def test_folder_keeps_a_repeated_batch_once(spark, tmp_path):
    sink = FolderSink(str(tmp_path / "out"), ROWS)
    sink.write(frame(spark, (1, "a"), (2, "b")), 0)
    sink.write(frame(spark, (3, "c")), 1)
    sink.write(frame(spark, (1, "a"), (2, "b")), 0)
    assert stored(sink, spark) == [(0, 1, "a"), (0, 2, "b"), (1, 3, "c")]


def test_folder_forgets_a_batch_that_became_empty(spark, tmp_path):
    sink = FolderSink(str(tmp_path / "out"), ROWS)
    sink.write(frame(spark, (1, "a")), 0)
    sink.write(frame(spark, (3, "c")), 1)
    sink.write(frame(spark), 0)
    sink.write(frame(spark), 0)
    assert stored(sink, spark) == [(1, 3, "c")]


def test_table_replaces_a_batch(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    sink = TableSink("sinks.replaced")
    sink.write(frame(spark, (1, "a"), (2, "b")), 0)
    sink.write(frame(spark, (3, "c")), 1)
    sink.write(frame(spark, (1, "a")), 0)
    assert stored(sink, spark) == [(0, 1, "a"), (1, 3, "c")]
    sink.write(frame(spark), 1)
    assert stored(sink, spark) == [(0, 1, "a")]


def test_table_append_adds_rows_again(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    sink = TableSink("sinks.appended", "append")
    sink.write(frame(spark, (1, "a")), 0)
    sink.write(frame(spark, (1, "a")), 0)
    assert [tuple(r) for r in sink.read(spark).collect()] == [(1, "a"), (1, "a")]
    assert catalog_table(spark, "sinks.appended").count() == 2


def test_published_records_are_kept_per_batch(spark, tmp_path):
    publisher = FolderPublisher(str(tmp_path / "out"))
    publisher.write(spark.createDataFrame([("(1.0,2.0)",)], "value string"), 4)
    assert [tuple(r) for r in publisher.read(spark).collect()] == [("(1.0,2.0)", "run", 4)]


def test_runs_do_not_replace_each_other(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    for make in (
        lambda run: FolderSink(str(tmp_path / "out"), ROWS, run),
        lambda run: TableSink("sinks.two_runs", run_id=run),
    ):
        make("a").write(frame(spark, (1, "a")), 0)
        make("b").write(frame(spark, (2, "b")), 0)
        make("b").write(frame(spark, (3, "c")), 0)
        found = sorted((r.run_id, r.batch_id, r.k) for r in make("a").read(spark).collect())
        assert found == [("a", 0, 1), ("b", 0, 3)]


def test_a_run_has_one_name_as_long_as_its_checkpoint(spark, tmp_path):
    first = run_name(spark, str(tmp_path / "one"))
    assert run_name(spark, str(tmp_path / "one")) == first
    assert run_name(spark, str(tmp_path / "two")) != first


@pytest.mark.parametrize("semantics", ["replace_batch", "append"])
def test_a_table_that_is_there_unpartitioned_is_added_to(spark, semantics):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    name = f"sinks.plain_{semantics}"
    spark.sql(f"CREATE TABLE {name} (v STRING, k BIGINT) USING parquet")
    sink = TableSink(name, semantics, "a")
    sink.write(frame(spark, (1, "a")), 0)
    sink.write(frame(spark, (2, "b")), 1)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [("a", 1), ("b", 2)]


def test_a_cluster_needs_a_folder_that_all_executors_see(spark):
    class Context:
        master = "local-cluster[2,1,1024]"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda *_: None)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_orc_folder_and_view(spark, tmp_path):
    frame(spark, (1, "a")).write.orc(str(tmp_path / "t"))
    assert orc_table(spark, str(tmp_path / "t"), view="orc_view").count() == 1
    assert spark.table("orc_view").columns == ["k", "v"]


def test_empty_topics_at_the_end_are_none():
    assert JobConfig(topics="b,a,,").topic_list == ["a", "b"]
    assert kafka_read_options(JobConfig(topics="a,b,"))["subscribe"] == "a,b"


def test_kafka_options():
    cfg = JobConfig(brokers="h1:6667,h2:6667", topics="b,a,b", max_offsets_per_trigger=1000)
    assert kafka_read_options(cfg) == {
        "kafka.bootstrap.servers": "h1:6667,h2:6667",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_write_options(cfg) == {
        "kafka.bootstrap.servers": "h1:6667,h2:6667",
        "topic": "MyTest",
    }


def test_kafka_without_its_connector_says_so(spark):
    cfg = JobConfig(brokers="nowhere:1", topics="t")
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_source(spark, cfg)
    with pytest.raises(Exception, match="(?i)kafka"):
        KafkaPublisher(cfg).write(spark.createDataFrame([("x",)], "value string"), 0)


def test_scratch_lies_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert fresh_folder(spark, "a").startswith(named + "/")
    assert fresh_folder(spark, "a") != fresh_folder(spark, "a")
    df, rows = settle(spark.range(5))
    assert rows == 5 and df.count() == 5


class UnnamedSession:
    """A session without a checkpoint folder in its settings."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master = master
        self.folder = None

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_a_local_session_makes_its_own_folder():
    local = UnnamedSession("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(UnnamedSession("spark://host:7077"))


def test_command_line_without_settings_explains_them():
    with pytest.raises(SystemExit, match="usage: <brokers> <topics>"):
        main([])


ARGS = ["host:6667", "t1,t2,t1", "100", "0.01", "0.00001", "0", "0.0001", "5"]


def test_positional_arguments():
    cfg = JobConfig.from_args(ARGS)
    assert cfg == JobConfig(brokers="host:6667", topics="t1,t2,t1")
    assert cfg.topic_list == ["t1", "t2"]


@pytest.mark.parametrize("args", [[], ARGS[:7], ["h", "t", "x", *ARGS[3:]]])
def test_bad_arguments(args):
    with pytest.raises(ValueError):
        JobConfig.from_args(args)


@pytest.mark.parametrize(
    "setting",
    [
        {"on_malformed": "ignore"},
        {"solver": "magic"},
        {"semantics": "once"},
        {"tables_from": "csv"},
        {"half_width": 0.0},
        {"reg_param": -1.0},
    ],
)
def test_bad_settings(setting):
    with pytest.raises(ValueError):
        JobConfig(**setting)
