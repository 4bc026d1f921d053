"""Parsing rules and the split of log records."""

import json

import pytest
from pyspark.sql import functions as F

from tidemart.operators import applog
from tidemart.operators.parse import app_log_rows, drop_bad, fail_on_bad, log_rows, route_bad
from tidemart.schemas import app_log

COMMON = {"mid": "m1", "is_new": "1"}
PAGE = {"page_id": "home"}
DISPLAYS = [{"item": "1", "pos_seq": 0}, {"item": "2", "pos_seq": 1}]
RECORDS = [
    {"common": COMMON, "page": PAGE, "displays": DISPLAYS, "actions": [{"action_id": "add"}], "ts": 1},
    {"common": COMMON, "start": {"entry": "icon"}, "ts": 2},
    {"common": COMMON, "start": {"entry": "icon"}, "err": {"error_code": 5}, "ts": 3},
    {"common": COMMON, "page": PAGE, "err": {"error_code": 6}, "ts": 4},
    {"common": COMMON, "start": {"entry": "icon"}, "displays": DISPLAYS, "ts": 5},
    {"common": COMMON, "page": PAGE, "displays": [], "ts": 6},
    {"common": COMMON, "ts": 7},
]
# per record: err, start, displays, actions, page
EXPECTED = [
    (0, 0, 2, 1, 1), (0, 1, 0, 0, 0), (1, 1, 0, 0, 0), (1, 0, 0, 0, 1),
    (0, 1, 0, 0, 0), (0, 0, 0, 0, 1), (0, 0, 0, 0, 1),
]


@pytest.fixture
def rows(spark):
    lines = [(i, json.dumps(r)) for i, r in enumerate(RECORDS)]
    return log_rows(spark.createDataFrame(lines, "seq int, value string")).drop("value")


def count_by(df):
    return {r.seq: r["count"] for r in df.groupBy("seq").count().collect()}


def test_split(rows):
    outputs = [
        applog.err_rows(rows, "seq"), applog.start_rows(rows, "seq"), applog.display_rows(rows, "seq"),
        applog.action_rows(rows, "seq"), applog.page_rows(rows, "seq"),
    ]
    counts = [count_by(df) for df in outputs]
    assert [tuple(c.get(i, 0) for c in counts) for i in range(len(RECORDS))] == EXPECTED


def test_fan_out_text(rows):
    got = {}
    for r in applog.fan_out(rows, {"err": "E"}, keep=("seq",)).collect():
        got.setdefault((r.seq, r.topic), []).append(json.loads(r.value))
    assert got[(0, "log_page")] == [{"common": COMMON, "page": PAGE, "ts": 1}]
    assert got[(0, "log_display")] == [{"common": COMMON, "page": PAGE, "display": d, "ts": 1} for d in DISPLAYS]
    assert got[(0, "log_action")] == [{"common": COMMON, "page": PAGE, "action": {"action_id": "add"}}]
    assert got[(2, "E")] == [{"error_code": 5}]
    assert got[(2, "log_start")] == [{"common": COMMON, "start": {"entry": "icon"}, "ts": 3}]
    assert got[(4, "log_start")] == [RECORDS[4]]
    assert got[(5, "log_page")] == [RECORDS[5]]
    assert got[(6, "log_page")] == [RECORDS[6]]
    assert sum(map(len, got.values())) == sum(map(sum, EXPECTED))


def test_unknown_fields_pass_on(spark):
    """Fields no schema names, and texts where a number is usual, reach the messages."""
    record = {
        "common": {"mid": "m", "is_new": "1", "net": "5g"}, "page": {"page_id": "p", "refer_id": "r", "during_time": "x1"},
        "displays": [{"item": "1", "rank": 3}], "actions": [{"action_id": "a", "way": ["w"]}],
        "err": {"error_code": "E7", "stack": {"at": [1, None]}}, "tag": {"deep": 1.25}, "ts": 9,
    }
    df = log_rows(spark.createDataFrame([(json.dumps(record),)], "value string")).drop("value")
    got = {r.topic: json.loads(r.value) for r in applog.fan_out(df).collect()}
    context = {"common": record["common"], "page": record["page"]}
    assert got == {
        "log_err": record["err"],
        "log_display": {**context, "display": record["displays"][0], "ts": 9},
        "log_action": {**context, "action": record["actions"][0]},
        "log_page": {**context, "tag": record["tag"], "ts": 9},
    }


def messages(spark, line):
    df = log_rows(spark.createDataFrame([(line,)], "value string")).drop("value")
    out = {}
    for r in applog.fan_out(df).collect():
        out.setdefault(r.topic, []).append(r.value)
    return out


EXACT = """ { "common" : {"mid":"m", "is_new":"1", "v":1.10, "none":null, "v":2.50}, "page":{"n":1e3,"t":"1.50, \\"x\\":null,"},
 "start":null, "tag":null, "big":12345678901234567890123456789012345678901234567890, "neg":[-0.00,null,{"a":null}],
 "displays":[{"p":7.70,"q":null}], "actions":[{"w":1E+2,"w":1E+3}], "err":{"c":0.10,"d":{"e":null,"f":1}}, "dup":1, "dup":2.0, "ts":5} """
CONTEXT = '"common":{"is_new":"1","mid":"m","v":2.50},"page":{"n":1e3,"t":"1.50, \\"x\\":null,"}'


def test_numbers_stay_as_written(spark):
    got = messages(spark, EXACT)
    assert got["log_err"] == ['{"c":0.10,"d":{"f":1}}']
    assert got["log_display"] == ['{' + CONTEXT + ',"display":{"p":7.70},"ts":5}']
    assert got["log_action"] == ['{' + CONTEXT + ',"action":{"w":1E+3}}']
    page = got["log_page"][0]
    for text in (CONTEXT.split(',"page"')[0], '"big":12345678901234567890123456789012345678901234567890', '"neg":[-0.00,null,{}]', '"dup":2.0'):
        assert text in page
    assert set(json.loads(page)) == {"common", "page", "big", "neg", "dup", "ts"}


@pytest.mark.parametrize(
    "line, page",
    [
        ('{"a":{"b":1,"b":{"c":2,"c":3}}}', '{"a":{"b":{"c":3}}}'),
        ('{"common":7,"k\\"ey":"v\\u0001","ts":1.5}', {"common": 7, 'k"ey': "v\x01", "ts": 1.5}),
        ('{"displays":[],"actions":"no list","x":"\ufdd0 1.5","y":2.50}', {"displays": [], "actions": "no list", "x": "\ufdd0 1.5", "y": 2.5}),
        ("{}", "{}"),
    ],
)
def test_odd_records_pass_on(spark, line, page):
    got = messages(spark, line)["log_page"]
    assert got == [page] if isinstance(page, str) else [json.loads(v) for v in got] == [page]


def test_many_strings_before_a_number(spark):
    line = json.dumps({"s": ["a\\\"b"] * 20_000, "n": 0}).replace('"n": 0', '"n": 1.50')
    page = messages(spark, line)["log_page"][0]
    assert '"n":1.50' in page and json.loads(page) == json.loads(line)


def test_times_and_flags(spark):
    df = log_rows(spark.createDataFrame([('{"ts":1.7e12}',), ('{"ts":"5"}',), ('{"ts":"x"}',)], "value string"))
    assert [r.ts for r in df.collect()] == [1_700_000_000_000, 5, None]
    lines = ['{"common":{"is_new":1,"mid":"a","f":1.0}}', '{"common":{"is_new":"1","f":1.0}}', '{"common":5}', '{"common":{"mid":"a"}}']
    for flag, want in (("0", ['"0"', '"0"', None, '"0"']), ("1", ["1", '"1"', None, '"1"'])):
        rows = log_rows(spark.createDataFrame([(v,) for v in lines], "value string"))
        rows = rows.select(applog.record_text(applog.set_flag(F.col("record"), F.lit(flag))).alias("t")).collect()
        for r, w in zip(rows, want):
            assert (f'"is_new":{w}' in r.t) if w else r.t == '{"common":5}'
        assert '"f":1.0' in rows[0].t


CASES = {
    '{"common":{"mid":"m"},"ts":5}': True,
    '  {"ts":5}  ': True,
    '{"ts":"5"}': True,
    '{"common":7,"ts":5}': True,  # sound text, unexpected type
    "{}": True,
    '{"ts":5': False,
    "[1]": False,
    '[{"ts":5}]': False,
    "plain": False,
    '{"ts":5} x': False,
    '{"ts":5}{"ts":6}': False,
    '{"ts":5},{"ts":6}': False,
    '{"ts":5}]': False,
    "null": False,
    "": False,
}


def test_bad_rows(spark):
    df = spark.createDataFrame([(k,) for k in [*CASES, None]], "value string")
    good, bad = route_bad(df, app_log())
    assert {r.value for r in good.collect()} == {k for k, ok in CASES.items() if ok}
    assert {r.value for r in bad.collect()} == {k for k, ok in CASES.items() if not ok} | {None}
    ts = {r.value: r.ts for r in app_log_rows(df, app_log()).collect()}
    assert ts['{"ts":"5"}'] == 5 and ts['{"common":7,"ts":5}'] == 5


def test_fail_on_bad(spark):
    df = spark.createDataFrame([('{"ts":"5"}',), (None,)], "value string")
    assert [r.ts for r in fail_on_bad(df, {"ts": "string"}).collect()] == ["5"]
    broken = spark.createDataFrame([('{"ts":',)], "value string")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        fail_on_bad(broken, {"ts": "string"}).collect()
    for text in ('{"ts":1} x', '{"ts":1}{"ts":2}', '{"ts":1},{"ts":2}', "", "[1]", "null"):
        with pytest.raises(Exception, match="(?i)malformed"):
            fail_on_bad(spark.createDataFrame([(text,)], "value string"), {"ts": "string"}).collect()


def test_one_parse_per_record(spark):
    df = spark.createDataFrame([('{"ts":"5"}',)], "value string")
    rows = drop_bad(df, {"ts": "string"}).filter("ts > 1").select((F.col("ts") + 1).alias("a"), "ts")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
