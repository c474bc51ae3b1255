import os

from pyspark.sql.datasource import DataSource, DataSourceReader

from weir.operators.config import merge_config
from weir.sinks import register_source, write_console
from weir.sources.config import load_config, read_property_files
from weir.sources.writes import heartbeat, heartbeat_stream


def test_property_files_extend_across_files(spark, scratch):
    conf = os.path.join(scratch, "conf")
    os.makedirs(conf)
    with open(os.path.join(conf, "a.properties"), "w") as f:
        f.write('# comment\nagent_directories=["/tmp/a"]\nagent_fields={"hostname": "test"}\n')
    with open(os.path.join(conf, "b.properties"), "w") as f:
        f.write('agent_directories=["/tmp/b", "/tmp/c"]\nagent_sleep=["/tmp/a"]\n')
    lines = read_property_files(spark, [os.path.join(conf, "*.properties")])
    entries = load_config(lines, file_ord="file_ord")
    merged = {}
    for r in merge_config(entries, order=("file_ord", "line_no", "idx")).orderBy("key", "pos").collect():
        merged.setdefault(r.key, []).append(r.value)
    assert merged["directories"] == ["/tmp/a", "/tmp/b", "/tmp/c"]
    assert merged["fields"] == ["hostname", "test"]
    assert merged["sleep"] == ["/tmp/a"]


def test_heartbeat_batch_and_stream(spark):
    b = spark.sql("SELECT TIMESTAMP'2024-01-01 00:59:58.5' AS s, TIMESTAMP'2024-01-01 01:00:02' AS e")
    got = heartbeat(spark, "s", "e", bounds=b).orderBy("ts").collect()
    assert [r.ts.second for r in got] == [58, 59, 0, 1, 2]
    assert {(r.path, r.message) for r in got} == {("/example", "ping")}
    s = heartbeat_stream(spark)
    assert s.isStreaming and s.columns == ["ts", "path", "message", "seq"]


def test_console_sink(spark, scratch, capsys):
    src = os.path.join(scratch, "c")
    os.makedirs(src)
    with open(os.path.join(src, "x.json"), "w") as f:
        f.write('{"line": "hello"}\n{"line": "world"}\n')
    stream = spark.readStream.schema("line string").json(src)
    q = write_console(stream, checkpoint=os.path.join(scratch, "ck"))
    q.processAllAvailable()
    q.stop()
    write_console(spark.createDataFrame([("foo",)], "line string"))
    assert "foo" in capsys.readouterr().out


def test_custom_source_by_name(spark):
    # Defined locally so the classes are pickled by value for the Python workers.
    class NumbersReader(DataSourceReader):
        def __init__(self, count):
            self.count = count

        def read(self, partition):
            for i in range(self.count):
                yield (i,)

    class Numbers(DataSource):
        @classmethod
        def name(cls):
            return "numbers_test"

        def schema(self):
            return "n int"

        def reader(self, schema):
            return NumbersReader(int(self.options.get("count", 3)))

    name = register_source(spark, Numbers)
    assert [r.n for r in spark.read.format(name).option("count", 4).load().collect()] == [0, 1, 2, 3]


def test_capture_job_writes_topics(spark, scratch):
    from weir.plans import fixtures as fx
    from weir.plans.jobs import capture

    sf = "/root/testdata/sf0.001"
    out = os.path.join(scratch, "wire")
    capture(spark, fx.writes(spark, sf), out, excludes=["./error/*"], rate=0.0001,
            users=fx.users(spark, sf), config_versions=fx.config_versions(spark))
    rows = spark.read.parquet(out)
    assert rows.where("rejected <> (reason IS NOT NULL)").count() == 0
    wire = rows.where("NOT rejected")
    topics = {r.topic for r in wire.select("topic").distinct().collect()}
    assert topics <= {"logs", "audit"} and "logs" in topics
    assert wire.count() > 0
