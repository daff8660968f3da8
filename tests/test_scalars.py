"""Golden values of the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from ferrylog.functions import ackjson, body, hashing, ids, severity, zstd
from ferrylog.functions.numbers import floor_div
from ferrylog.operators import shape

CODES = {
    "0": "EMERGENCY",
    "1": "ALERT",
    "2": "CRITICAL",
    "3": "ERROR",
    "4": "WARNING",
    "5": "NOTICE",
    "6": "INFO",
    "7": "DEBUG",
    # decimal text of any length, nothing around it
    "0002": "CRITICAL",
    "+4": "WARNING",
    "12": "INFO",
    "-5": "INFO",
    "3\n": "INFO",
    "\t1": "INFO",
    "two": "INFO",
    "1e0": "INFO",
    "4.0": "INFO",
    "18446744073709551617": "INFO",
    "": "INFO",
}


def test_severity_of_text(spark):
    df = spark.createDataFrame([(c,) for c in CODES], "c string")
    got = df.select("c", severity.severity_name(F.col("c")).alias("n")).collect()
    assert {r.c: r.n for r in got} == CODES


@pytest.mark.parametrize(
    "value, name",
    [
        ("3", "ERROR"),
        ("06", "INFO"),
        ("07", "DEBUG"),
        ('"3"', "INFO"),
        ("3.0", "INFO"),
        ("null", "INFO"),
        ("true", "INFO"),
        ("[1]", "INFO"),
        ("-0", "EMERGENCY"),
    ],
)
def test_severity_of_json(entries_of, value, name):
    df = entries_of([("1-0", "s", f'{{"severity":{value}}}', "r")])
    line = shape.build_payload(df).first().line
    assert json.loads(line.split("\t", 2)[2]) == {"severity": name, "raw": "r"}


PAYLOADS = [
    (
        '{"site":"north","severity":2,"structured_data":{"pump@9":{"valve":"open","bar":"7.5"}}}',
        "pump 9 opened",
        {"site": "north", "valve": "open", "bar": "7.5", "severity": "CRITICAL", "raw": "pump 9 opened"},
    ),
    (
        '{"site":"south","severity":5,"note":"filter changed"}',
        "as it came",
        {"site": "south", "note": "filter changed", "severity": "NOTICE", "raw": "as it came"},
    ),
    ("", "", {"raw": "-"}),
    ('{"site":"w","severity":1}', "", {"site": "w", "severity": "ALERT", "raw": "-"}),
    ("plain words", "", {"raw": "-"}),
    ("[7]", "r", {"raw": "r"}),
    ('{"cut', "r", {"raw": "r"}),
    ('{"a":1} tail', "r", {"raw": "r"}),
    ('{"a":[1]}]', "r", {"raw": "r"}),
    ('{"a":1}}{', "r", {"raw": "r"}),
    (' {"a":["]"]}\n', "r", {"a": ["]"], "raw": "r"}),
    (
        '{"severity":4,"structured_data":{"hall":{"row":{"seat":"12b"}}}}',
        "r",
        {"seat": "12b", "severity": "WARNING", "raw": "r"},
    ),
    (
        '{"site":"e","severity":0,"count":41}',
        "x",
        {"site": "e", "count": 41, "severity": "EMERGENCY", "raw": "x"},
    ),
    # decisions: last of equal keys, own raw wins, structured data not an object
    ('{"a":1,"b":2,"a":3}', "r", {"a": 3, "b": 2, "raw": "r"}),
    ('{"raw":"inner","a":1}', "r", {"a": 1, "raw": "r"}),
    ('{"structured_data":{"x":{"raw":"inner"}}}', "r", {"raw": "r"}),
    ('{"structured_data":"-","a":1}', "r", {"a": 1, "raw": "r"}),
    ('{"k":1,"structured_data":{"m":{"k":2}}}', "r", {"k": 2, "raw": "r"}),
    ('{"structured_data":{"m":{"k":2}},"k":1}', "r", {"k": 1, "raw": "r"}),
    # arrays and nulls are leaves, empty objects vanish
    (
        '{"structured_data":{"a":[1,{"b":2}],"n":null,"e":{}}}',
        "r",
        {"a": [1, {"b": 2}], "n": None, "raw": "r"},
    ),
    # values pass through with their types; nested repeated keys keep the last
    (
        '{"i":1,"f":1.5,"t":true,"n":null,"o":{"x":1,"x":2},"s":"5","u":"é\\u0001"}',
        "r",
        {"i": 1, "f": 1.5, "t": True, "n": None, "o": {"x": 2}, "s": "5", "u": "é\x01", "raw": "r"},
    ),
]


def test_payload_lines(entries_of):
    rows = [(f"{i}-0", 'odd"name\\here', o, r) for i, (o, r, _) in enumerate(PAYLOADS)]
    got = shape.build_payload(entries_of(rows)).collect()
    assert len(got) == len(PAYLOADS)
    for row in got:
        id_, stream, text = row.line.split("\t", 2)
        assert (id_, stream) == (row.id, 'odd"name\\here')
        assert json.loads(text) == PAYLOADS[int(id_.split("-")[0])][2]
        assert text.rindex('"raw":') > text.rfind('":', 0, text.rindex('"raw":'))


def test_repeated_keys_appear_once_in_the_text(entries_of):
    line = shape.build_payload(entries_of([("1-0", "s", '{"a":1,"b":2,"a":3,"b":4}', "r")])).first().line
    assert line.count('"a"') == 1 and line.count('"b"') == 1


@pytest.mark.parametrize("depth", [1, 3, 4, 5, 6, 50, 400])
def test_flattening_has_no_depth(entries_of, depth):
    nested = '{"n":' * depth + '{"d":1.10,"e":{}}' + "}" * depth
    df = entries_of([("1-0", "s", f'{{"structured_data":{nested}}}', "r")])
    assert [(r.key, r.value) for r in shape.structured_data_fields(df).collect()] == [("d", "1.10")]
    assert shape.structured_data_fields(df, prefix="sd_").first().key == "sd_d"
    assert shape.build_payload(df).first().line == '1-0\ts\t{"d":1.10,"raw":"r"}'


#: Values that a parser would write in another way.
VERBATIM = [
    "1.10", "-0.0", "1E5", "1e400", "9" * 42, "0.1" + "0" * 30, "[1.0,  2]", '{"z":1,"a":[ ]}',
    '"caf\\u00e9\\/"', "007", '{"k":{"b":1,"a":{"c":2.50}}}', "null",
]


@pytest.mark.parametrize("sep", [":", " : "])
def test_values_pass_verbatim(entries_of, sep):
    rows = [(f"{k}-0", "s", f'{{"a"{sep}{v},"severity"{sep}3}}', "r") for k, v in enumerate(VERBATIM)]
    df = entries_of(rows)
    lines = {r.id: r.line for r in shape.build_payload(df).collect()}
    values = {r.id: r.value for r in shape.pass_through_fields(df).collect()}
    for k, v in enumerate(VERBATIM):
        assert values[f"{k}-0"] == v
        assert lines[f"{k}-0"] == f'{k}-0\ts\t{{"a":{v},"severity":"ERROR","raw":"r"}}'


def test_odd_spellings(entries_of):
    bodies = {
        "{'a':1}": '{"raw":"r"}',
        '{"sever\\u0069ty":1.0,"x":2}': '{"sever\\u0069ty":1.0,"x":2,"raw":"r"}',
        '{"severity": "3"}': '{"severity":"INFO","raw":"r"}',
        '{"severity": 3.0, "r\\u0061w": 1}': '{"severity":"INFO","raw":"r"}',
        '{"a":[\n1],"structured_data": [{"b":1}]}': '{"a":[ 1],"raw":"r"}',
        '{"":1.0,"structured_data":{"":{"":2.0}}}': '{"":2.0,"raw":"r"}',
        '{"a":"]}{[\\"","b":1.0}': '{"a":"]}{[\\"","b":1.0,"raw":"r"}',
    }
    df = entries_of([(f"{k}-0", "s", o, "r") for k, o in enumerate(bodies)])
    got = {r.object: r.line.split("\t")[2] for r in shape.build_payload(df).collect()}
    assert got == bodies


def test_object_ok_and_other_fields(entries_of):
    df = entries_of(
        [
            ("1-0", "s", "", "r"),
            ("2-0", "s", "nope", "r"),
            ("3-0", "s", '{"a":{"b":1},"severity":1}', "r"),
        ]
    )
    flags = {r.id: (r.object_ok, len(r.fields)) for r in shape.tolerate_bad_object(df).collect()}
    assert flags == {"1-0": (True, 0), "2-0": (False, 0), "3-0": (True, 2)}
    assert [(r.key, r.value) for r in shape.pass_through_fields(df).collect()] == [("a", '{"b":1}')]


#: Every character with a short escape, other control characters, and some to leave alone.
ESCAPES = {c + "~" + c: e + "~" + e for c, e in zip('"\\\b\f\n\r\t', [r"\"", r"\\", r"\b", r"\f", r"\n", r"\r", r"\t"])}
ESCAPES |= {chr(n): f"\\u{n:04X}" for n in (0, 2, 11, 14, 31)}
ESCAPES |= {t: t for t in ("", "/", "{'}", "ß漢😀", "\x7f")}


def test_json_escape(spark):
    df = spark.createDataFrame([(t,) for t in ESCAPES], "t string")
    got = df.select("t", body.json_escape(F.col("t")).alias("e")).collect()
    assert {r.t: r.e for r in got} == ESCAPES


def test_lines_hold_no_raw_newline(entries_of):
    df = entries_of([("1-0", "s", '{"m":"a\\nb"}', "x\ny\tz")])
    assert "\n" not in shape.build_payload(df).first().line


def test_ids_sort_as_numbers(spark):
    df = spark.createDataFrame([(i,) for i in ("10-0", "9-11", "9-2", "odd")], "id string")
    got = [r.id for r in df.orderBy(ids.id_pair("id")).collect()]
    assert got == ["odd", "9-2", "9-11", "10-0"]
    row = ids.parse_id(df.filter("id = '9-11'")).select("*", F.unix_millis("event_time").alias("t")).first()
    assert (row.id_ms, row.id_seq, row.t) == (9, 11, 9)


def fnv(data: bytes) -> int:
    h = 2166136261
    for b in data:
        h = (h ^ b) * 16777619 % 2**32
    return h


def test_stream_hash(spark):
    names = ["a", "foobar", "", "syslog:é日本", "x\ny", "z" * 300]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = df.select("s", hashing.fnv1a_32(F.col("s")).alias("h"), hashing.ack_shard(F.col("s"), 7).alias("n"))
    for r in got.collect():
        assert (r.h, r.n) == (fnv(r.s.encode()), fnv(r.s.encode()) % 7)
    assert (fnv(b"a"), fnv(b"foobar"), fnv(b"")) == (3826002220, 3214735720, 2166136261)


def test_floor_div(spark):
    df = spark.createDataFrame([(v,) for v in (-5, -4, -1, 0, 3, 4, 2**62)], "v bigint")
    got = df.select("v", floor_div(F.col("v"), 4).alias("q")).collect()
    assert all(r.q == r.v // 4 for r in got)


def test_magic_bytes(spark):
    frames = [bytes.fromhex("28b52ffd00"), b"{}", bytes.fromhex("28b52f"), b"", None]
    df = spark.createDataFrame([(f,) for f in frames], "b binary")
    got = [r[0] for r in df.select(zstd.is_compressed(F.col("b"))).collect()]
    assert got == [True, False, False, False, False]


def test_zstd_round_trip_and_cap(spark):
    import zstandard

    texts = ["", "x", "line\n" * 10_000, "é" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    frames = df.select("t", zstd.zstd_pack(F.col("t")).alias("f"))
    back = frames.select("t", zstd.zstd_unpack(F.col("f")).cast("string").alias("u")).collect()
    assert all(r.t == r.u for r in back)
    capped = frames.select("t", zstd.zstd_unpack(F.col("f"), 100).isNull().alias("cut")).collect()
    assert {r.t: r.cut for r in capped} == {t: len(t.encode()) > 100 for t in texts}
    good = zstandard.ZstdCompressor().compress(b"abc" * 1000)
    assert zstd.unpack(good + good, 10_000) == b"abc" * 2000
    assert zstd.unpack(good[:-1], 10_000) is None
    assert zstd.unpack(good + b"junk", 10_000) is None
    assert zstd.unpack(bytes.fromhex("28b52ffdffff"), 10_000) is None
    bomb = zstandard.ZstdCompressor().compress(bytes(50_000_000))
    assert zstd.unpack(bomb, 1_000_000) is None


def test_decoded_batches_are_cut(spark):
    """Frames that grow far beyond one batch: 60 values of 8 MB in one task."""
    big = spark.range(0, 60, 1, 1).select("id", F.repeat(F.lit("x"), 8_000_000).alias("t"))
    back = big.select("id", zstd.zstd_unpack(zstd.zstd_pack(F.col("t"))).alias("u"))
    got = back.select("id", F.octet_length("u").alias("n")).collect()
    assert sorted((r.id, r.n) for r in got) == [(i, 8_000_000) for i in range(60)]


def test_ack_fields(spark):
    cases = {
        '{"ids":["a"],"stream":"s","ack":true}': (["a"], "s", True, None),
        '{"ids":["a","b","c"],"stream":"s","ack":false,"x":{"y":1}}': (["a", "b", "c"], "s", False, None),
        '{"ids":["a"],"stream":"s"}': (["a"], "s", False, None),
        '{"ids":["a"],"stream":"s","ack":"true"}': (["a"], "s", False, None),
        '{"ids":["a"],"stream":"s","ack":false,"ack":true}': (["a"], "s", True, None),
        "ids=a": (None, None, False, ackjson.REJECT_MALFORMED),
        "": (None, None, False, ackjson.REJECT_MALFORMED),
        '{"ids":["a"],"stream":"s",': (None, None, False, ackjson.REJECT_MALFORMED),
        "[]": (None, None, False, ackjson.REJECT_MALFORMED),
        '{"ack":true}': (None, None, True, ackjson.REJECT_IDS),
        "{}": (None, None, False, ackjson.REJECT_IDS),
        '{"ids":[],"stream":"s","ack":true}': ([], "s", True, ackjson.REJECT_IDS),
        '{"ids":"a","stream":"s","ack":true}': (None, "s", True, ackjson.REJECT_IDS),
        '{"ids":["a"],"ack":true}': (["a"], None, True, ackjson.REJECT_STREAM),
        '{"ids":["a"],"stream":"","ack":true}': (["a"], "", True, ackjson.REJECT_STREAM),
        '{"ids":["a"],"stream":5,"ack":true}': (["a"], None, True, ackjson.REJECT_STREAM),
    }
    from ferrylog.operators.settle import parse_acks

    df = spark.createDataFrame([(c,) for c in cases], "payload string")
    got = {r.payload: (r.ids, r.stream, r.ack, r.reject_reason) for r in parse_acks(df).collect()}
    assert got == cases


def test_repeated_ack_keys(spark):
    from ferrylog.operators.settle import parse_acks

    text = '{"ids":["m"],"stream":"q","ids":["n","o"],"stream":4,"ack":true}'
    row = parse_acks(spark.createDataFrame([(text,), (text + " x",)], "payload string")).collect()
    assert (row[0].ids, row[0].stream, row[0].ack, row[0].reject_reason) == (["m", "n", "o"], "q", True, None)
    assert row[1].reject_reason == ackjson.REJECT_MALFORMED


def test_escape_of_null(spark):
    df = spark.createDataFrame([(None,), ('a"b',)], "t string")
    assert [r[0] for r in df.select(body.json_escape(F.col("t"))).collect()] == [None, 'a\\"b']
