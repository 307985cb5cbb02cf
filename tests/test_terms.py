import pytest
from pyspark.sql import functions as F

from quadrille.functions import aggregates as A
from quadrille.functions import compare as C
from quadrille.functions import strings as S
from quadrille.functions import terms as T

X = T.XSD


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def lit(lex, kind=None):
    return F.lit(f'"{lex}"' + (f"^^<{X}{kind}>" if kind else ""))


@pytest.mark.parametrize("text,want", [("", '""'), ("<http://a>", "<http://a>"), ("<a b>", '"<a b>"'), ("_:", '"_:"'), ("_:x", "_:x"), ('"a"@EN-us', '"a"@en-us'), ('"a"^^xsd:int', f'"a"^^<{X}int>'), ('"\\uD83D\\uDE00"', '"😀"'), ("12", '"12"'), ('"x" y', None)])
def test_canonical(spark, text, want):
    assert value(spark, T.canonical(F.lit(text))) == want


def test_equality_and_keys(spark):
    for a, b, want in [(lit("1", "int"), lit("01", "integer"), True), (lit("NaN", "float"), lit("NaN", "double"), False), (lit("a"), lit("a", "string"), True), (F.lit('"a"@en'), F.lit('"a"@EN'), True), (lit("P7D", "duration"), lit("P1W", "duration"), True), (lit("2020-01-01T00:00:00Z", "dateTime"), lit("2020-01-01T01:00:00+01:00", "dateTime"), True), (lit("2020-01-01T00:00:00Z", "dateTime"), lit("2020-01-01T00:00:00", "dateTime"), False)]:
        assert value(spark, C.term_eq(a, b)) is want
        assert not want or value(spark, C.join_key(a) == C.join_key(b))


def test_strict(spark):
    null = F.lit(None).cast("string")
    for made, want in [
        (C.term_lt(lit("2", "int"), lit("10", "integer"), "raise"), True),
        (C.term_ge(lit("2023-01-01T00:00:00Z", "dateTime"), lit("2023-01-01T01:00:00+01:00", "dateTime"), "raise"), True),
        (C.term_lt(null, lit("1", "int"), "raise"), None),
        (C.term_lt(lit("a"), lit("1", "int")), None),
        (C.term_eq(lit("0.1", "decimal"), lit("0.10000000000000000", "decimal"), "raise"), True),
        (C.term_eq(lit("9007199254740993", "long"), lit("9007199254740992", "long")), False),
        (C.term_gt(lit("9007199254740993", "long"), lit("9007199254740992", "long")), True),
        (C.native_compare(lit("42", "string"), "=", F.lit(42), "int", "raise"), True),
        (C.native_compare(lit("x", "date"), "<>", F.lit("2023-01-01").cast("date"), "date", "raise"), True),
    ]:
        assert value(spark, made) is want
    for bad in [C.term_lt(lit("a"), lit("1", "int"), "raise"), C.term_lt(F.lit('"a"@en'), F.lit('"b"@en'), "raise"), C.term_eq(lit("2011-10-08", "date"), lit("", "date"), "raise"), C.native_compare(lit("x"), "=", F.lit(42), "int", "raise")]:
        with pytest.raises(Exception, match="cannot (order|compare)"):
            value(spark, bad)


def test_functions(spark):
    for made, want in [(S.substr(F.lit('"hello"@en'), 2, 3), '"ell"@en'), (S.strafter(F.lit('"abc"@en'), lit("b")), '"c"@en'), (S.encode_for_uri(lit("a b*~é")), '"a%20b%2A~%C3%A9"'), (S.round_(lit("-2.5", "decimal")), f'"-2"^^<{X}decimal>'), (S.timezone(lit("2011-01-10T14:45:13.815-05:00", "dateTime")), f'"-PT5H"^^<{X}dayTimeDuration>'), (C.term_lt(F.lit('"a"@en'), F.lit('"b"@en')), None)]:
        assert value(spark, made) == want


def test_aggregates(spark):
    def agg(f, *terms):
        return spark.createDataFrame([(t,) for t in terms], "x string").select(f("x").alias("r")).first().r

    i = lambda x, t="integer": f'"{x}"^^<{X}{t}>'
    assert agg(A.rdf_sum, i(10), i(20), i(30), None) == i(60)
    assert agg(A.rdf_avg, i(10), i(20), i(30)) == i("20.0", "decimal")
    assert agg(A.rdf_sum, i(1), '"20"') is None
    assert agg(A.rdf_sum, None) is None
    assert agg(A.rdf_max, i(9), i("10.5", "double"), i(2)) == i("10.5", "double")
    assert agg(A.rdf_group_concat, None) == ""


N = lambda x, t="integer": f'"{x}"^^<{X}{t}>'


@pytest.mark.parametrize(
    "terms,total,mean",
    [
        ([N(10), N(20), N(30)], N(60), N("20.0", "decimal")),
        ([N("10.5", "decimal"), N(20), N("30.5", "decimal")], N("61.0", "decimal"), N("20.3333333333333333", "decimal")),
        ([N("10.0", "float"), N("10.5", "float"), N("15.3", "float")], N("35.8", "float"), N("11.9333333333333333", "float")),
        ([N(1), N(1), N(0)], N(2), N("0.66666666666666666667", "decimal")),
        ([N(-10), N(-5)], N(-15), N("-7.5000000000000000", "decimal")),
        ([N(0), N(0)], N(0), N("0.0", "decimal")),
        ([N("5" + "0" * 26)] * 2, N("1" + "0" * 27), N("5" + "0" * 26 + ".0", "decimal")),
        ([N("9" * 22), N("0.5", "decimal")], N("9" * 22 + ".5", "decimal"), N("4" + "9" * 21 + ".8", "decimal")),
        ([N("1.5", "decimal"), N(-3)], N("-1.5", "decimal"), N("-0.75000000000000000000", "decimal")),
        ([N(100000), N(1), N(0)], N(100001), N("33333.666666666667", "decimal")),
        ([N("INF", "double"), N("1.5", "double")], N("Infinity", "double"), N("Infinity", "double")),
        ([N("INF", "double"), N("-INF", "double")], N("NaN", "double"), N("NaN", "double")),
        ([N("NaN", "double"), N(1)], N("NaN", "double"), N("NaN", "double")),
        ([N(1), '"1"'], None, None),
        ([None], None, None),
    ],
)
def test_sums_and_means(spark, terms, total, mean):
    rows = spark.createDataFrame([(t,) for t in terms], "x string")
    assert tuple(rows.agg(A.rdf_sum("x"), A.rdf_avg("x")).first()) == (total, mean)


def test_wide_numbers(spark):
    for made, want in [(S.abs_(lit("-1e30", "double")), N("1E30", "double")), (S.floor(lit("INF", "double")), N("INF", "double")), (S.ceil(lit("1.2", "double")), N(2, "double")), (S.floor(lit("NaN", "float")), N("NaN", "float")), (S.abs_(lit("x", "double")), None)]:
        assert value(spark, made) == want


def test_times_with_offsets(spark):
    ten = F.struct(F.lit(36_000_000_000).alias("micros"), F.lit("Z").alias("offset"))
    east = lit("11:00:00+01:00", "time")
    for made, want in [
        (C.native_compare(lit("10:00:00Z", "time"), "=", ten, "timetz"), True),
        (C.native_compare(east, "=", ten, "timetz"), False),  # one moment, other offsets: ordered by these
        (C.native_compare(east, "<", ten, "timetz"), True),
        (C.native_compare(lit("11:30:00+01:00", "time"), ">", ten, "timetz"), True),
        (C.compare_native(ten, "<", lit("09:30:00-01:00", "time"), "timetz"), True),
    ]:
        assert value(spark, made) is want
    zoned = C.to_native(C.from_native(F.struct(F.lit(14_706_000_000).alias("micros"), F.lit("-08:00").alias("offset")), "timetz"), "timetz")
    assert tuple(value(spark, zoned)) == (14_706_000_000, "-08:00")


def test_functions_on_streams(spark, tmp_path):
    """Term functions are expressions, so a stream gives what a table does."""
    path = str(tmp_path / "in")
    spark.createDataFrame([('"abc"@en',), (N(3),), ("<http://x>",), (None,)], "x string").write.parquet(path)
    made = [T.lang("x").alias("lang"), S.strlen("x").alias("size"), C.term_gt("x", F.lit(N(2))).alias("more"), C.group_key("x").alias("key")]
    query = spark.readStream.schema("x string").parquet(path).select("x", *made).writeStream.format("memory").queryName("streamed").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert rows(spark.table("streamed")) == rows(spark.read.parquet(path).select("x", *made))
