import pytest
from pyspark.sql import functions as F

from tidewater.functions.records import convert_record, decode_url, read_encoded_json, read_json

SCHEMA = "a int, b string"


@pytest.fixture()
def json_rows(spark):
    data = [
        (1, '{"a": 1, "b": "x"}'),
        (2, '{"a": 1, "b": '),
        (3, '{"a": 2}'),
        (4, '{"a": 3, "b": "y", "c": true}'),
        (5, '{"a": "not a number", "b": "z"}'),
        (6, None),
    ]
    return spark.createDataFrame(data, "id int, js string")


def parsed(df, col):
    return {r.id: (None if r.p is None else (r.p.a, r.p.b)) for r in df.select("id", col.alias("p")).collect()}


def test_lenient(json_rows):
    got = parsed(json_rows, read_json("js", SCHEMA))
    assert got == {1: (1, "x"), 2: None, 3: (2, None), 4: (3, "y"), 5: None, 6: None}


def test_strict_good_rows(json_rows):
    good = json_rows.filter("id in (1, 3, 6)")
    assert parsed(good, read_json("js", SCHEMA, strict=True)) == {1: (1, "x"), 3: (2, None), 6: None}


@pytest.mark.parametrize("bad_id", [2, 4, 5])
def test_strict_raises(json_rows, bad_id):
    with pytest.raises(Exception):
        json_rows.filter(F.col("id") == bad_id).select(read_json("js", SCHEMA, strict=True)).collect()


def test_url_encoded(spark):
    df = spark.createDataFrame(
        [(1, "%7B%22a%22%3A1%2C%22b%22%3A%22x+y%20z%22%7D"), (2, "%zz"), (3, None)], "id int, js string"
    )
    assert parsed(df, read_encoded_json("js", SCHEMA)) == {1: (1, "x y z"), 2: None, 3: None}
    with pytest.raises(Exception):
        df.filter("id = 2").select(decode_url("js", strict=True)).collect()


def test_convert_record(spark):
    df = spark.createDataFrame([(1, 2.5, 7)], "id long, price double, qty int")
    out = df.select(convert_record(F.struct("id", "price", "qty"), "id string, price decimal(5,2), qty long").alias("r"))
    r = out.collect()[0].r
    assert (r.id, float(r.price), r.qty) == ("1", 2.5, 7)


def test_convert_record_coerces_quoted_numbers(spark):
    df = spark.createDataFrame([("7", "true", "1.25"), ("x", "true", "1.25")], "qty string, ok string, p string")
    out = df.select(convert_record(F.struct("qty", "ok", "p"), "qty int, ok boolean, p decimal(5,2)").alias("r"))
    got = [r.r for r in out.collect()]
    assert (got[0].qty, got[0].ok, float(got[0].p)) == (7, True, 1.25)
    assert got[1] is None
    plain = df.select(convert_record(F.struct("qty"), "qty int", coerce=False).alias("r")).collect()
    assert plain[0].r is None


def test_strict_rejects_unconvertible_value(spark):
    good = spark.createDataFrame([('{"a": "7", "b": "x"}',)], "js string")
    bad = spark.createDataFrame([('{"a": "seven", "b": "x"}',)], "js string")
    assert good.select(read_json("js", SCHEMA, strict=True).alias("p")).collect()[0].p.a == 7
    with pytest.raises(Exception):
        bad.select(read_json("js", SCHEMA, strict=True)).collect()


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

_text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(recs=st.lists(st.tuples(st.one_of(st.none(), st.integers(-2**31, 2**31 - 1)), st.one_of(st.none(), _text)),
                     min_size=1, max_size=8))
def test_json_round_trip_property(spark, recs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(recs)], "id int, a int, b string")
    js = df.select("id", F.to_json(F.struct("a", "b")).alias("js"))
    enc = js.select("id", F.url_encode("js").alias("js"))
    for frame, fn in ((js, read_json), (enc, read_encoded_json)):
        got = {r.id: (r.p.a, r.p.b) for r in frame.select("id", fn("js", SCHEMA).alias("p")).collect()}
        assert got == {i: rec for i, rec in enumerate(recs)}


def test_coercion_in_nested_types(spark):
    df = spark.createDataFrame(
        [('{"ids": ["1", 2], "p": {"n": "3", "s": "x"}}',), ('{"ids": ["1", "two"], "p": {"n": 3, "s": "x"}}',)],
        "js string",
    )
    out = [r.r for r in df.select(read_json("js", "ids array<int>, p struct<n:int, s:string>").alias("r")).collect()]
    assert out[0].ids == [1, 2] and (out[0].p.n, out[0].p.s) == (3, "x")
    assert out[1] is None


@pytest.mark.parametrize(
    "js, want",
    [("7.0", 7), ("1e3", 1000), ("7.9", 7), ("-7.9", -7), ('"7"', 7), ("9223372036854775807", 9223372036854775807), ("1e30", None)],
)
def test_integer_fields_take_any_number(spark, js, want):
    df = spark.createDataFrame([(f'{{"k": {js}, "l": [{js}]}}',)], "js string")
    r = df.select(read_json("js", "k bigint, l array<bigint>").alias("r")).collect()[0].r
    assert (r and (r.k, r.l)) == (None if want is None else (want, [want]))


def test_convert_record_double_to_int(spark):
    df = spark.createDataFrame([(7.0,), (7.9,), (1e7,)], "v double")
    assert [r.r.v for r in df.select(convert_record(F.struct("v"), "v int").alias("r")).collect()] == [7, 7, 10000000]


def test_strict_finds_unknown_fields_at_any_depth(spark):
    schema = "id int, o struct<a int, deep struct<b string>>, items array<struct<n int>>, m map<string, struct<v int>>, free map<string, string>"
    good = '{"id": 1, "o": {"a": 2, "deep": {"b": "x"}}, "items": [{"n": 1}, {}, null], "m": {"any": {"v": 1}}, "free": {"z": "1"}}'
    bad = {
        '{"o": {"a": 2, "x": 1}}': "o.x", '{"o": {"deep": {"b": "x", "c": 1}}}': "o.deep.c", '{"items": [{"n": 1}, {"n": 2, "q": 3}]}': "items.q",
        '{"m": {"k": {"v": 1, "w": 2}}}': "m.*.w", '{"id": 1, "y": 2}': '"y"',
    }
    one = lambda text: spark.createDataFrame([(text,)], "j string").select(read_json("j", schema, strict=True).alias("r"))
    kept = one(good).first()["r"]
    assert kept["o"]["deep"]["b"] == "x" and kept["m"]["any"]["v"] == 1 and kept["free"] == {"z": "1"}
    assert one(None).first()["r"] is None
    for text, path in bad.items():
        with pytest.raises(Exception, match="unknown JSON fields") as error:
            one(text).collect()
        assert path in str(error.value)
        assert spark.createDataFrame([(text,)], "j string").select(read_json("j", schema).alias("r")).first()["r"] is not None  # lenient: left out
