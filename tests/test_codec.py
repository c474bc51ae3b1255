import datetime as dt
import json

from pyspark.sql import functions as F


from weir.operators.codec import decode, deobfuscate, encode, render_event, select_fields
from weir.operators.enrich import with_static
from weir.schema import EVENT_KEYS

T0 = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)


def writes(spark, buf=b'say "hi"\n', size=None):
    size = len(buf) if size is None else size
    return spark.createDataFrame(
        [(1, T0, "/var/log", "./app.log", bytearray(buf), size, 0, 42, 7, 9)],
        "seq long, ts timestamp, prefix string, path string, buf binary, size long, offset long, "
        "pid int, uid int, gid int")


def test_base64_json_event_shape(spark):
    w = with_static(writes(spark), {"site": "eu"}, ["orders"])
    good, dead = encode(w)
    ev = json.loads(bytes(good.first().value).decode())
    assert list(ev) == EVENT_KEYS
    assert ev["path"] == "/var/log/app.log"
    assert ev["@message"] == "c2F5ICJoaSIK"
    assert ev["@timestamp"] == "2024-01-01T12:00:00.123+0000"
    assert ev["@version"] == "0.1.6" and ev["@fields"] == {"site": "eu"} and ev["@tags"] == ["orders"]
    assert ev["user"] == "" and ev["command"] == ""
    assert dead.count() == 0


def test_raw_json_escapes_and_cuts_at_nul(spark):
    good, _ = encode(writes(spark, b'a"b\x00rest'), "logstash")
    ev = json.loads(bytes(good.first().value).decode())
    assert ev["@message"] == 'a"b'


def test_message_is_cut_to_size(spark):
    good, _ = encode(writes(spark, b"abcdef", size=3), "logstash")
    assert json.loads(bytes(good.first().value).decode())["@message"] == "abc"


def test_text_encoder(spark):
    good, _ = encode(writes(spark, b"line"), "text")
    assert bytes(good.first().value).decode() == "2024-01-01T12:00:00.123+0000: ./app.log: line"


def test_unsupported_encoder_is_dead_letter(spark):
    for name in ["csv", "text_fpenzoyr"]:
        good, dead = encode(writes(spark), name)
        assert good.count() == 0
        assert dead.first().reason == f"unsupported encoder: {name}"


def test_obfuscation_round_trip(spark):
    good, _ = encode(writes(spark, "é\n".encode()), "logstash_base64_fpenzoyr")
    raw = bytes(good.first().value)
    assert raw[0] == ord("{") ^ 255
    plain = good.select(deobfuscate("value").alias("v")).first().v
    assert bytes(plain) == bytes(b ^ 255 for b in raw)
    events, dead = decode(good)
    assert events.first()["@message"] == "é\n" and dead.count() == 0


def test_decode_minimal_event(spark):
    df = spark.createDataFrame(
        [('{"command": "bXkgY29tbWFuZGU=", "@message": "bXkgbWVzc2FnZQ=="}',), ("not json",)], "value string")
    events, dead = decode(df, version_gate=False)
    r = events.first()
    assert (r.command, r["@message"], r["message_size-added"]) == ("my commande", "my message", 10)
    assert r.path is None and r["@tags"] is None
    assert dead.count() == 1


def test_decode_rejects_what_is_not_one_object(spark):
    good = '{"pid": 1, "@message": "bQ==", "@version": "0.1.6", "own": "x", "@tags": ["a]", "}],"]}'
    bad = [good + " trailing", good + good, good + "," + good, good + "]", "[" + good + "]", good + "],[" + good, '{"pid": 1',
           good + ',"x":' + good, "1", "null", "", '"x"']
    typed = ['{"pid": "abc"}', '{"@tags": 7}', '{"@fields": ["a"]}']
    rows = [(t,) for t in [good, good + " \n", "{}", *bad, *typed, None]]
    df = spark.createDataFrame(rows, "value string")
    events, dead = decode(df)
    assert [r["@message"] for r in events.collect()] == ["m", "m", None]
    reasons = {r.value: r.reason for r in dead.collect()}
    as_text = [t for t in bad if t.startswith("{")]         # other first bytes are taken for obfuscated
    assert {t: reasons[t] for t in as_text} == {t: "not a JSON event" for t in as_text}
    assert {t: reasons[t] for t in typed} == {t: "a key of another type" for t in typed}
    assert dead.count() == len(bad) + len(typed) + 1


def test_own_keys_and_only_wanted_keys(spark):
    df = spark.createDataFrame([('{"own": "x", "n": 5, "o": {"a": 1}, "pid": 3, "user": "u"}',)], "value string")
    events, _ = decode(df, columns=["own", "n", "o", "none", "pid"])
    assert tuple(events.first()) == ("x", "5", '{"a":1}', None, 3)
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert "user" not in plan


def test_null_values_stay_on_the_wire(spark):
    w = writes(spark).withColumn("pid", F.lit(None).cast("int"))
    good, _ = encode(w, "logstash")
    import json
    assert list(json.loads(bytes(good.first().value))) == EVENT_KEYS and json.loads(bytes(good.first().value))["pid"] is None


def test_version_gate_keeps_old_events_encoded(spark):
    df = spark.createDataFrame([('{"path": "/x", "@message": "bXkgbWVzc2FnZQ==", "@version": "0.1.1"}',)],
                               "value string")
    events, _ = decode(df)
    assert events.first()["@message"] == "bXkgbWVzc2FnZQ=="


def test_utf8_repair(spark):
    df = spark.createDataFrame([('{"path": "/x", "@message": "Qf9C", "@version": "0.1.6"}',)], "value string")
    events, _ = decode(df)
    assert events.first()["@message"] == "A�B"


def test_select_and_render(spark):
    w = with_static(writes(spark, b"m"), {"k": "v"}, ["t"])
    good, _ = encode(w)
    events, _ = decode(good)
    assert select_fields(events, "path nope @message").columns == ["path", "@message"]
    text = render_event(events.select("path", "@fields", "@tags")).first().text
    assert text == "event:\n  path: /var/log/app.log\n  @fields: \n     k: v\n  @tags: \n    -  t"


def test_render_lists_empty_and_null(spark):
    df = spark.createDataFrame([(["a", None, "b"],), ([],), (None,)], "t array<string>")
    got = [r.text for r in render_event(df).collect()]
    assert got == ["event:\n  t: \n    -  a\n    -  b", "event:\n  t: \n", "event:\n  t: "]
