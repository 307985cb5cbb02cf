import pytest

from quadrille.functions import sql_names

ROWS = ['"abc"@en', '"abc"', '"-12.5"^^<http://www.w3.org/2001/XMLSchema#decimal>', "<http://x/é>", "_:b1", '"2011-01-10T14:45:13.815-05:00"^^<http://www.w3.org/2001/XMLSchema#dateTime>', '""', None]


def test_names_say_what_the_functions_do(spark):
    names = sql_names.register(spark)
    assert len(names) == len(sql_names.FUNCTIONS)
    rows = spark.createDataFrame([(x, y, 2, 2) for x in ROWS for y in ('"b"', '"b"@en', None)], "x string, y string, start int, length int")
    rows.createOrReplaceTempView("terms")
    arguments = {k: [p.split()[0] for p in parameters.split(", ")] for k, (parameters, _) in sql_names.FUNCTIONS.items()}
    called = spark.sql("SELECT x, y, " + ", ".join(f"sparql_{k}({', '.join(a)}) AS {k}" for k, a in arguments.items()) + " FROM terms")
    made = rows.select("x", "y", *[body(*arguments[k]).alias(k) if k != "substr" else body("x", rows["start"], rows["length"]).alias(k) for k, (_, body) in sql_names.FUNCTIONS.items()])
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, called.collect())) == sorted(map(key, made.collect()))


def test_defaults(spark):
    sql_names.register(spark)
    assert spark.sql("""SELECT sparql_substr('"hello"@en', 3)""").first()[0] == '"llo"@en'
    with pytest.raises(Exception, match="(?i)argument|parameter"):
        spark.sql("SELECT sparql_lang()").collect()
