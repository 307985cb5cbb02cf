"""Queries over the driver's tables lifted to terms and triples, each with SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import aggregates as A
from ..functions import compare as C
from ..functions import sql_names
from ..functions import strings as S
from ..functions import terms as T
from ..operators import lift as L
from ..operators import patterns as P
from ..operators import relational as R
from ..operators import update as U

FLAGSHIP = "sum_by_flag"
X = T.XSD
#: Tables that grow with the scale factor fastest.
WIDE = ("lineitem", "orders")
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql.replace("{X}", X).replace("{B}", L.BASE)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lifted table. Term expressions cost more than reading, so of a file with few splits the rows are dealt to all
    cores; large inputs have splits enough and aren't shuffled."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if name in WIDE and rows.rdd.getNumPartitions() < cores else rows


def lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return t.select(L.node("lineitem", F.col("l_orderkey"), F.col("l_linenumber")).alias("s"), L.text(F.col("l_returnflag")).alias("flag"), L.text(F.col("l_linestatus")).alias("status"), L.integer(F.col("l_quantity")).alias("qty"), L.decimal(F.col("l_discount")).alias("discount"), L.date(F.col("l_shipdate")).alias("shipped"), L.date_time(F.col("l_shipdate")).alias("ship_time"))


def customer_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return L.triples(c, L.node("customer", F.col("c_custkey")), name=L.text(F.col("c_name")), nation=L.node("nation", F.col("c_nationkey")))


def nation_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return L.triples(n, L.node("nation", F.col("n_nationkey")), label=L.text(F.col("n_name")), region=L.node("region", F.col("n_regionkey")))


def order_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return L.triples(o, L.node("order", F.col("o_orderkey")), customer=L.node("customer", F.col("o_custkey")), ordered=L.date_time(F.col("o_orderdate")), priority=L.text(F.col("o_orderpriority")))


@query("""SELECT '"' || l_returnflag || '"' AS flag, '"' || CAST(sum(CAST(l_quantity AS BIGINT)) AS VARCHAR) || '"^^<{X}integer>' AS total FROM lineitem GROUP BY l_returnflag""")
def sum_by_flag(spark, sf_dir):
    return lineitems(spark, sf_dir).groupBy("flag").agg(A.rdf_sum("qty").alias("total"))


@query("""SELECT '"' || l_returnflag || '"' AS flag, '"' || CAST(sum(CAST(l_discount AS DECIMAL(20,2))) AS VARCHAR) || '"^^<{X}decimal>' AS total FROM lineitem GROUP BY l_returnflag""")
def sum_decimals(spark, sf_dir):
    return lineitems(spark, sf_dir).groupBy("flag").agg(A.rdf_sum("discount").alias("total"))


@query("""SELECT flag, '"' || CAST(s // n AS VARCHAR) || '.' || CASE WHEN s % n = 0 THEN '0' ELSE lpad(CAST((CAST(s % n AS HUGEINT) * 20000000000000000 + n) // (2 * n) AS VARCHAR), 16, '0') END || '"^^<{X}decimal>' AS mean FROM (SELECT '"' || l_returnflag || '"' AS flag, CAST(sum(CAST(l_quantity AS BIGINT)) AS HUGEINT) AS s, count(*) AS n FROM lineitem GROUP BY l_returnflag)""")
def avg_by_flag(spark, sf_dir):
    return lineitems(spark, sf_dir).groupBy("flag").agg(A.rdf_avg("qty").alias("mean"))


@query("""SELECT '"' || l_returnflag || '"' AS flag, '"' || CAST(min(CAST(l_quantity AS BIGINT)) AS VARCHAR) || '"^^<{X}integer>' AS least, '"' || CAST(max(CAST(l_quantity AS BIGINT)) AS VARCHAR) || '"^^<{X}integer>' AS most, '"' || strftime(max(l_shipdate), '%Y-%m-%d') || '"^^<{X}date>' AS latest, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def min_max_by_flag(spark, sf_dir):
    return lineitems(spark, sf_dir).groupBy("flag").agg(A.rdf_min("qty").alias("least"), A.rdf_max("qty").alias("most"), A.rdf_max("shipped").alias("latest"), F.count("*").alias("n"))


@query("""SELECT '<{B}region/' || r_regionkey || '>' AS region, '"' || string_agg(n_name, ', ' ORDER BY n_name) || '"' AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey""")
def group_concat(spark, sf_dir):
    rows = P.bgp(nation_triples(spark, sf_dir), ("?n", L.predicate("region"), "?region"), ("?n", L.predicate("label"), "?name"))
    return rows.groupBy("region").agg(A.rdf_group_concat("name", ", ").alias("nations"))


@query("""SELECT count(*) AS n, count(DISTINCT CAST(l_quantity AS BIGINT)) AS n_values FROM lineitem""")
def count_distinct(spark, sf_dir):
    return lineitems(spark, sf_dir).agg(F.count("qty").alias("n"), F.countDistinct(C.group_key("qty")).alias("n_values"))


@query("""SELECT '<{B}lineitem/' || l_orderkey || '-' || l_linenumber || '>' AS s, '"' || CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey) AS VARCHAR) || '"^^<{X}integer>' AS total, rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place FROM lineitem""")
def window_sum(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").withColumn("qty", L.integer(F.col("l_quantity")))
    w = Window.partitionBy("l_orderkey")
    return t.select(L.node("lineitem", F.col("l_orderkey"), F.col("l_linenumber")).alias("s"), A.rdf_sum("qty", w).alias("total"), F.rank().over(w.orderBy("l_linenumber")).cast("long").alias("place"))


@query("""SELECT '<{B}lineitem/' || l_orderkey || '-' || l_linenumber || '>' AS s FROM lineitem WHERE CAST(l_quantity AS BIGINT) >= 45 AND CAST(l_discount AS DECIMAL(20,2)) < 0.03 AND strftime(l_shipdate, '%Y-%m-%d') > '1996-06-30'""")
def filter_by_value(spark, sf_dir):
    return lineitems(spark, sf_dir).where(C.term_ge("qty", F.lit(f'"45.0"^^<{X}decimal>')) & C.term_lt("discount", F.lit(f'"0.03"^^<{X}decimal>')) & C.term_gt("shipped", F.lit(f'"1996-06-30"^^<{X}date>'))).select("s")


@query("""SELECT '<{B}lineitem/' || l_orderkey || '-' || l_linenumber || '>' AS s FROM lineitem WHERE CAST(l_quantity AS BIGINT) IN (1, 7, 50)""")
def filter_in(spark, sf_dir):
    return lineitems(spark, sf_dir).where(C.term_in("qty", F.lit(f'"01"^^<{X}int>'), F.lit(f'"7.0"^^<{X}decimal>'), F.lit(f'"5E1"^^<{X}double>'))).select("s")


@query("""SELECT '"' || p_size || '"^^<{X}int>' AS size, count(*) AS n FROM part JOIN lineitem ON p_size = CAST(l_quantity AS BIGINT) GROUP BY p_size""")
def value_join(spark, sf_dir):
    """All pairs of the whole tables, counted by size: each side is counted before the join, which then has a row a value."""
    parts = table(spark, sf_dir, "part").select(C.from_native(F.col("p_size"), "int").alias("size")).groupBy("size").agg(F.count("*").alias("parts"))
    items = lineitems(spark, sf_dir).groupBy("qty").agg(F.count("*").alias("items"))
    return R.value_join(parts, items, "size", "qty").groupBy("size").agg(F.sum(F.col("parts") * F.col("items")).alias("n"))


@query("""SELECT '<{B}customer/' || c_custkey || '>' AS s FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')""")
def anti_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(L.node("customer", F.col("c_custkey")).alias("s"))
    urgent = P.bgp(order_triples(spark, sf_dir), ("?o", L.predicate("customer"), "?c"), ("?o", L.predicate("priority"), "?p")).where(R.like(F.col("p"), "1%"))
    return R.value_not_in(c, "s", urgent, "c")


@query("""SELECT DISTINCT '<{B}customer/' || c_custkey || '>' AS s FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')""")
def semi_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(L.node("customer", F.col("c_custkey")).alias("s"))
    urgent = P.bgp(order_triples(spark, sf_dir), ("?o", L.predicate("customer"), "?c"), ("?o", L.predicate("priority"), "?p")).where(T.lex("p").like("1%"))
    return R.value_in(c, "s", urgent, "c")


@query("""SELECT '"' || c_name || '"' AS name, '"' || n_name || '"' AS label FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def basic_pattern(spark, sf_dir):
    people = P.bgp(customer_triples(spark, sf_dir), ("?c", L.predicate("name"), "?name"), ("?c", L.predicate("nation"), "?n"))
    return P.join(people, P.match(nation_triples(spark, sf_dir), "?n", L.predicate("label"), "?label")).select("name", "label")


@query("""SELECT '<{B}order/' || o_orderkey || '>' AS s, '<{B}customer/' || o_custkey || '>' AS customer, '"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"^^<{X}dateTime>' AS ordered, '"' || o_orderpriority || '"' AS priority FROM orders""")
def star_pattern(spark, sf_dir):
    return P.star(order_triples(spark, sf_dir), customer=L.predicate("customer"), ordered=L.predicate("ordered"), priority=L.predicate("priority"))


@query("""SELECT '<{B}customer/' || c_custkey || '>' AS c, '"' || c_name || '"' AS name, '<{B}order/' || o_orderkey || '>' AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def optional_pattern(spark, sf_dir):
    names = P.match(customer_triples(spark, sf_dir), "?c", L.predicate("name"), "?name")
    return P.optional(names, P.match(order_triples(spark, sf_dir), "?o", L.predicate("customer"), "?c")).select("c", "name", "o")


@query("""SELECT '"' || c_name || '"' AS name FROM customer UNION ALL SELECT '"' || n_name || '"' FROM nation""")
def union_pattern(spark, sf_dir):
    return P.union(P.match(customer_triples(spark, sf_dir), "?x", L.predicate("name"), "?name"), P.match(nation_triples(spark, sf_dir), "?x", L.predicate("label"), "?name")).select("name")


@query("""SELECT '<{B}nation/' || n_nationkey || '>' AS n FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)""")
def minus_pattern(spark, sf_dir):
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(L.node("nation", F.col("c_nationkey")).alias("n"))
    return P.minus(P.match(nation_triples(spark, sf_dir), "?n", L.predicate("label"), "?l").select("n"), rich)


@query("""SELECT '<{B}customer/7>' AS subject, '<{B}p/' || p || '>' AS predicate, o AS object FROM (SELECT 'name' AS p, '"' || c_name || '"' AS o FROM customer WHERE c_custkey = 7 UNION ALL SELECT 'nation', '<{B}nation/' || c_nationkey || '>' FROM customer WHERE c_custkey = 7)""")
def describe(spark, sf_dir):
    return P.describe(customer_triples(spark, sf_dir), f"<{L.BASE}customer/7>")


@query("""SELECT '"' || c_name || '"' AS name, '"' || upper(c_name) || '"' AS up, '"' || lower(c_name) || '"' AS low, length(c_name) AS size, '"' || substr(c_name, 3, 5) || '"' AS part, CASE WHEN strpos(c_name, '#') > 0 THEN '"' || split_part(c_name, '#', 1) || '"' ELSE '""' END AS before, CASE WHEN strpos(c_name, '#') > 0 THEN '"' || substr(c_name, strpos(c_name, '#') + 1) || '"' ELSE '""' END AS after, starts_with(c_name, 'Cust') AS starts, ends_with(c_name, '9') AS ends, contains(c_name, '00') AS has, '"' || md5(c_name) || '"' AS digest, '"' || replace(c_name, '0', 'o') || '"' AS replaced FROM customer""")
def string_functions(spark, sf_dir):
    x = lambda t: F.lit(f'"{t}"')
    c = table(spark, sf_dir, "customer").select(L.text(F.col("c_name")).alias("name"))
    return c.select("name", S.ucase("name").alias("up"), S.lcase("name").alias("low"), S.strlen("name").cast("long").alias("size"), S.substr("name", 3, 5).alias("part"), S.strbefore("name", x("#")).alias("before"), S.strafter("name", x("#")).alias("after"), S.strstarts("name", x("Cust")).alias("starts"), S.strends("name", x("9")).alias("ends"), S.contains("name", x("00")).alias("has"), S.md5("name").alias("digest"), S.replace("name", "0", "o").alias("replaced"))


@query("""SELECT '"' || replace(replace(text, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"@' || lang AS term, lang AS tag, lang = 'en' AS english, '"' || lang || '"' AS code, length(text) AS size FROM documents""")
def language_tags(spark, sf_dir):
    """All documents with their whole texts, escaped."""
    t = table(spark, sf_dir, "documents").select(L.tagged(F.col("text"), F.col("lang")).alias("term"), F.char_length("text").cast("long").alias("size"))
    return t.select("term", T.lang("term").alias("tag"), T.lang_matches(T.lang("term"), F.lit("en")).alias("english"), T.literal(T.lang("term")).alias("code"), "size")


@query("""SELECT '<{B}order/' || o_orderkey || '>' AS s, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d, CAST(hour(o_orderdate) AS INTEGER) AS h, CAST(minute(o_orderdate) AS INTEGER) AS mi FROM orders""")
def date_functions(spark, sf_dir):
    t = P.match(order_triples(spark, sf_dir), "?s", L.predicate("ordered"), "?t")
    return t.select("s", S.year("t").alias("y"), S.month("t").alias("m"), S.day("t").alias("d"), S.hours("t").alias("h"), S.minutes("t").alias("mi"))


@query("""SELECT '<{B}customer/' || c_custkey || '>' AS s, '"' || CAST(CAST(floor(v) AS BIGINT) AS VARCHAR) || '"^^<{X}decimal>' AS down, '"' || CAST(CAST(ceil(v) AS BIGINT) AS VARCHAR) || '"^^<{X}decimal>' AS up, '"' || CAST(CAST(floor(v + 0.5) AS BIGINT) AS VARCHAR) || '"^^<{X}decimal>' AS near FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(20,2)) AS v FROM customer)""")
def number_functions(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(L.node("customer", F.col("c_custkey")).alias("s"), L.decimal(F.col("c_acctbal")).alias("v"))
    return c.select("s", S.floor("v").alias("down"), S.ceil("v").alias("up"), S.round_("v").alias("near"))


@query("""SELECT '<{B}page/' || page_id || '>' AS s, '<' || url || '>' AS u, '"' || url || '"' AS text, true AS iri, false AS blank, false AS lit FROM pages""")
def term_functions(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(L.node("page", F.col("page_id")).alias("s"), T.iri(L.text(F.col("url"))).alias("u"))
    return p.select("s", "u", T.str_("u").alias("text"), T.is_iri("u").alias("iri"), T.is_blank("u").alias("blank"), T.is_literal("u").alias("lit"))


@query("""SELECT CAST(l_quantity AS BIGINT) AS n, CAST(l_quantity AS DOUBLE) AS x, CAST(l_shipdate AS DATE) AS d, CAST(l_discount AS DECIMAL(20,2)) > 0.05 AS big FROM lineitem""")
def casts(spark, sf_dir):
    return lineitems(spark, sf_dir).select(C.to_native("qty", "bigint").alias("n"), C.to_native("qty", "double").alias("x"), C.to_native("shipped", "date").alias("d"), C.native_compare("discount", ">", F.lit("0.05").cast("decimal(3,2)"), "decimal").alias("big"))


@query("""SELECT s, qty FROM (SELECT '<{B}lineitem/' || l_orderkey || '-' || l_linenumber || '>' AS s, '"' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '"^^<{X}integer>' AS qty FROM lineitem) ORDER BY qty DESC, s LIMIT 25""")
def top_k(spark, sf_dir):
    return lineitems(spark, sf_dir).select("s", "qty").orderBy(F.col("qty").desc_nulls_first(), "s").limit(25)


@query("""SELECT s FROM (SELECT '<{B}order/' || o_orderkey || '>' AS s FROM orders) ORDER BY s LIMIT 10 OFFSET 30""")
def offset_limit(spark, sf_dir):
    return R.page(R.ordered(P.match(order_triples(spark, sf_dir), "?s", L.predicate("priority"), "?p").select("s"), "s"), 10, 30)


@query("""SELECT DISTINCT '"' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '"^^<{X}integer>' AS qty, '"' || l_returnflag || '"' AS flag FROM lineitem""")
def distinct_values(spark, sf_dir):
    return R.distinct_by_value(lineitems(spark, sf_dir).select("qty", "flag"))


@query("""SELECT '<{B}order/' || o_orderkey || '>' AS o, '<{B}customer/' || o_custkey || '>' AS c FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders) WHERE k = 1""")
def distinct_on(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return R.distinct_on(o, ["o_custkey"], F.desc("o_orderdate"), F.asc("o_orderkey")).select(L.node("order", F.col("o_orderkey")).alias("o"), L.node("customer", F.col("o_custkey")).alias("c"))


@query("""(SELECT '<{B}nation/' || c_nationkey || '>' AS n FROM customer INTERSECT SELECT '<{B}nation/' || s_nationkey || '>' FROM supplier) EXCEPT SELECT '<{B}nation/3>'""")
def set_operations(spark, sf_dir):
    nation = lambda t, c: table(spark, sf_dir, t).select(L.node("nation", F.col(c)).alias("n"))
    return nation("customer", "c_nationkey").intersect(nation("supplier", "s_nationkey")).subtract(spark.createDataFrame([(f"<{L.BASE}nation/3>",)], "n string"))


@query("""SELECT coalesce('"' || l_returnflag || '"', 'all') AS flag, coalesce('"' || l_linestatus || '"', 'all') AS status, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup(spark, sf_dir):
    return lineitems(spark, sf_dir).rollup("flag", "status").agg(F.count("*").alias("n")).select(F.coalesce("flag", F.lit("all")).alias("flag"), F.coalesce("status", F.lit("all")).alias("status"), "n")


@query("""SELECT '<{B}nation/' || n_nationkey || '>' AS subject, '<{B}p/label>' AS predicate, '"' || CASE WHEN n_nationkey = 5 THEN 'renamed' ELSE n_name END || '"' AS object FROM nation WHERE n_nationkey <> 2 UNION ALL SELECT '<{B}nation/99>', '<{B}p/label>', '"NEW"'""")
def insert_delete_update(spark, sf_dir):
    labels = nation_triples(spark, sf_dir).where(F.col("predicate") == L.predicate("label"))
    row = lambda k, o: spark.createDataFrame([(f"<{L.BASE}nation/{k}>", L.predicate("label"), o)], "subject string, predicate string, object string")
    of = lambda k: labels.where(F.col("subject") == f"<{L.BASE}nation/{k}>")
    return U.update(U.delete(U.insert(labels, row(99, '"NEW"')), of(2)), of(5), row(5, '"renamed"'))


@query("""SELECT '"' || event_type || '"' AS kind, count(*) AS n, '"' || CAST(sum(CAST(value AS DECIMAL(20,2))) AS VARCHAR) || '"^^<{X}decimal>' AS total, '"' || strftime(max(ts), '%Y-%m-%dT%H:%M:%S') || '"^^<{X}dateTime>' AS latest FROM events GROUP BY event_type""")
def events_by_type(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(L.text(F.col("event_type")).alias("kind"), L.decimal(F.col("value")).alias("value"), L.date_time(F.col("ts")).alias("at"))
    return e.groupBy("kind").agg(F.count("*").alias("n"), A.rdf_sum("value").alias("total"), A.rdf_max("at").alias("latest"))


@query("""SELECT '<{B}customer/' || c_custkey || '>' AS s, true AS known, false AS unknown, true AS number, false AS no_number, true AS same, c_name = 'Customer#000000007' AS seven, '"' || c_name || '"' AS first, '<{X}decimal>' AS kind, '<{X}string>' AS plain_kind, '<http://www.w3.org/1999/02/22-rdf-syntax-ns#langString>' AS tagged_kind, '<{X}integer>' AS integer_kind, true AS fits, false AS fits_not FROM customer""")
def term_tests(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(L.node("customer", F.col("c_custkey")).alias("s"), L.text(F.col("c_name")).alias("name"), L.decimal(F.col("c_acctbal")).alias("v"), L.integer(F.col("c_custkey")).alias("k"), L.tagged(F.col("c_name"), F.lit("en")).alias("tagged"), F.lit(None).cast("string").alias("none"))
    return c.select("s", T.bound("name").alias("known"), T.bound("none").alias("unknown"), T.is_numeric("v").alias("number"), T.is_numeric("name").alias("no_number"), T.same_term("name", "name").alias("same"), T.same_term("name", F.lit('"Customer#000000007"')).alias("seven"), T.coalesce("none", "name").alias("first"), T.datatype("v").alias("kind"), T.datatype("name").alias("plain_kind"), T.datatype("tagged").alias("tagged_kind"), T.datatype("k").alias("integer_kind"), T.compatible("tagged", "name").alias("fits"), T.compatible("name", "tagged").alias("fits_not"))


@query("""SELECT '_:' || regexp_replace(p_name, '[^A-Za-z0-9]', '_', 'g') AS node, '"' || p_name || '"^^<{X}token>' AS typed, '"' || p_name || '"@en-US' AS tagged, '"' || p_name || '-' || p_size || '"' AS joined, '"' || p_name || '/' || p_name || '"@en' AS joined_tagged, '"' || url_encode(p_name || '/é ~*') || '"' AS encoded, '<http://x.example/' || p_partkey || '>' AS u FROM part""")
def term_makers(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(L.text(F.col("p_name")).alias("name"), L.tagged(F.col("p_name"), F.lit("en")).alias("tag"), F.col("p_size").cast("string").alias("size"), F.col("p_partkey").cast("string").alias("key"))
    x = lambda t: F.lit(f'"{t}"')
    return p.select(T.bnode("name").alias("node"), T.strdt("name", F.lit(f"<{X}token>")).alias("typed"), T.strlang("name", x("EN-US")).alias("tagged"), S.concat("name", x("-"), T.literal(F.col("size"))).alias("joined"), S.concat("tag", F.lit('"/"@en'), "tag").alias("joined_tagged"), S.encode_for_uri(S.concat("name", x("/é ~*"))).alias("encoded"), T.uri(T.literal(F.concat(F.lit("http://x.example/"), F.col("key")))).alias("u"))


@query("""SELECT '<{B}lineitem/' || l_orderkey || '-' || l_linenumber || '>' AS s, q = 17 AS int_eq, q <> 17 AS long_ne, q < 17 AS short_lt, q <= 17.5 AS double_le, q >= 17 AS float_ge, d > 0.05 AS decimal_gt, 17 < q AS int_back, 0.05 >= d AS decimal_back, day = DATE '1996-03-13' AS date_eq, day <> DATE '1996-03-13' AS date_ne, day < DATE '1996-03-13' AS date_lt, day >= DATE '1996-03-13' AS stamp_ge, day > DATE '1996-03-13' AS moment_gt, l_linenumber % 2 = 1 AS truth_eq FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(l_discount AS DECIMAL(20,2)) AS d, CAST(l_shipdate AS DATE) AS day FROM lineitem)""")
def native_operators(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    rows = t.select(L.node("lineitem", F.col("l_orderkey"), F.col("l_linenumber")).alias("s"), L.integer(F.col("l_quantity")).alias("q"), L.decimal(F.col("l_discount")).alias("d"), L.date(F.col("l_shipdate")).alias("day"), L.date_time(F.col("l_shipdate")).alias("at"), C.from_native(F.col("l_linenumber") % 2 == 1, "boolean").alias("odd"))
    day = F.lit("1996-03-13")
    return rows.select("s", C.native_compare("q", "=", F.lit(17), "int").alias("int_eq"), C.native_compare("q", "<>", F.lit(17).cast("bigint"), "bigint").alias("long_ne"), C.native_compare("q", "<", F.lit(17).cast("smallint"), "smallint").alias("short_lt"), C.native_compare("q", "<=", F.lit(17.5), "double").alias("double_le"), C.native_compare("q", ">=", F.lit(17.0).cast("float"), "float").alias("float_ge"), C.native_compare("d", ">", F.lit("0.05").cast("decimal(3,2)"), "decimal").alias("decimal_gt"), C.compare_native(F.lit(17), "<", "q", "int").alias("int_back"), C.compare_native(F.lit("0.05").cast("decimal(3,2)"), ">=", "d", "decimal").alias("decimal_back"), C.native_compare("day", "=", day.cast("date"), "date").alias("date_eq"), C.native_compare("day", "<>", day.cast("date"), "date").alias("date_ne"), C.compare_native(day.cast("date"), ">", "day", "date").alias("date_lt"), C.native_compare("at", ">=", day.cast("timestamp_ntz"), "timestamp_ntz").alias("stamp_ge"), C.native_compare("at", ">", F.timestamp_micros(F.unix_date(day.cast("date")).cast("long") * 86_400_000_000), "timestamp").alias("moment_gt"), C.native_compare("odd", "=", F.lit(True), "boolean").alias("truth_eq"))


@query("""SELECT k, CAST(k % 1000 AS SMALLINT) AS short, CAST(k AS INTEGER) AS mid, k * 1000003 AS long, CAST(k + 0.5 AS FLOAT) AS single, k / 4.0::DOUBLE AS twin, CAST(k AS DECIMAL(20,0)) / 100 = CAST(k AS DECIMAL(20,0)) / 100 AS exact, k % 3 = 0 AS truth, CAST(o_orderdate AS DATE) AS day, k * 1000003 % 86400000000 AS clock, k * 1000003 % 86400000000 AS clock_tz, '-08:00' AS zone, CAST(k % 40 AS BIGINT) AS months, CAST(k % 13 AS BIGINT) AS days, k * 7 % 100000 * 1000000 AS micros, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS moment FROM (SELECT *, CAST(o_orderkey AS BIGINT) AS k FROM orders)""")
def cast_round_trips(spark, sf_dir):
    """Every native type to a term and back."""
    k = F.col("o_orderkey").cast("bigint")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.pmod(k * 1000003, F.lit(86_400_000_000)).alias("us"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"), F.struct((k % 40).alias("months"), (k % 13).alias("days"), (k * 7 % 100000 * 1000000).alias("micros")).alias("span"))
    again = lambda c, kind: C.to_native(C.from_native(c, kind), kind)
    k, cents, span = F.col("k"), (F.col("k").cast("decimal(20,0)") / 100).cast("decimal(24,2)"), again(F.col("span"), "interval")
    zoned = again(F.struct(F.col("us").alias("micros"), F.lit("-08:00").alias("offset")), "timetz")
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return rows.select("k", again((k % 1000).cast("smallint"), "smallint").alias("short"), again(k.cast("int"), "int").alias("mid"), again(k * 1000003, "bigint").alias("long"), again((k + 0.5).cast("float"), "float").alias("single"), again(k / 4.0, "double").alias("twin"), (again(cents, "decimal") == cents).alias("exact"), again(k % 3 == 0, "boolean").alias("truth"), again(F.col("at").cast("date"), "date").alias("day"), again(F.col("us"), "time").alias("clock"), zoned["micros"].alias("clock_tz"), zoned["offset"].alias("zone"), span["months"].alias("months"), span["days"].alias("days"), span["micros"].alias("micros"), shown(again(F.col("at"), "timestamp_ntz")).alias("stamp"), shown(again(F.col("at").cast("timestamp"), "timestamp")).alias("moment"))


@query("""SELECT '<{B}event/' || event_id || '>' AS s, CAST(second(ts) AS DECIMAL(18,6)) AS sec, '"+05:30"' AS tz, '"PT5H30M"^^<{X}dayTimeDuration>' AS timezone, '"-02:00"' AS west, '"-PT2H"^^<{X}dayTimeDuration>' AS west_zone, '"Z"' AS utc, '"PT0S"^^<{X}dayTimeDuration>' AS utc_zone FROM events""")
def zone_functions(spark, sf_dir):
    text = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    at = lambda zone: T.typed(F.concat(text, F.lit(zone)), "dateTime")
    e = table(spark, sf_dir, "events").select(L.node("event", F.col("event_id")).alias("s"), at("+05:30").alias("east"), at("-02:00").alias("west_at"), at("Z").alias("utc_at"))
    return e.select("s", S.seconds("east").alias("sec"), S.tz("east").alias("tz"), S.timezone("east").alias("timezone"), S.tz("west_at").alias("west"), S.timezone("west_at").alias("west_zone"), S.tz("utc_at").alias("utc"), S.timezone("utc_at").alias("utc_zone"))


@query("""SELECT '<{B}lineitem/' || l_orderkey || '-' || l_linenumber || '>' AS s, q <> 17 AS ne, q <= 17 AS le, day <= DATE '1996-03-13' AS date_le, day <> DATE '1996-03-13' AS date_ne, '"' || l_returnflag || '"' < '"N"' AS text_lt, q BETWEEN 5 AND 20 AS between_two, CASE WHEN q > 25 THEN 'many' ELSE 'few' END AS size, NULLIF('"' || l_linestatus || '"', '"O"') AS status, NOT (q > 25) AS inverse, (q > 25) IS TRUE AS is_true, l_linestatus LIKE 'f%' AS like_it, l_linestatus ILIKE 'f%' AS ilike_it, l_linestatus NOT LIKE 'F%' AS unlike FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(l_shipdate AS DATE) AS day FROM lineitem)""")
def value_operators(spark, sf_dir):
    """Comparisons of terms with terms, and the conditions that the host has for them."""
    number = lambda n: F.lit(f'"{n}"^^<{X}integer>')
    day, many = F.lit(f'"1996-03-13"^^<{X}date>'), C.term_gt("qty", number(25))
    return lineitems(spark, sf_dir).select("s", C.term_ne("qty", number(17)).alias("ne"), C.term_le("qty", number(17)).alias("le"), C.term_le("shipped", day).alias("date_le"), C.term_ne("shipped", day).alias("date_ne"), C.term_lt("flag", F.lit('"N"')).alias("text_lt"), (C.term_ge("qty", number(5)) & C.term_le("qty", number(20))).alias("between_two"), F.when(many, "many").otherwise("few").alias("size"), F.nullif(F.col("status"), F.lit('"O"')).alias("status"), (~many).alias("inverse"), many.eqNullSafe(F.lit(True)).alias("is_true"), R.like(F.col("status"), "f%").alias("like_it"), R.like(F.col("status"), "f%", True).alias("ilike_it"), (~R.like(F.col("status"), "F%")).alias("unlike"))


@query("""SELECT '"' || r_name || '"' AS name, count(*) AS n, '"' || min(n_name) || '"' AS some, count(*) FILTER (n_name < 'G') AS early FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name HAVING count(*) > 2""")
def having_and_sample(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_regionkey", L.text(F.col("n_name")).alias("label"))
    r = table(spark, sf_dir, "region").select("r_regionkey", L.text(F.col("r_name")).alias("name"))
    first = n.groupBy("n_regionkey").agg(A.rdf_min("label").alias("least"), F.count("*").alias("k"), F.count_if(C.term_lt("label", F.lit('"G"'))).alias("early"))
    rows = first.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("name").agg(F.sum("k").alias("n"), A.rdf_sample("least").alias("some"), F.sum("early").alias("early")).where("n > 2")


@query("""SELECT coalesce('"' || l_returnflag || '"', 'all') AS flag, coalesce('"' || l_linestatus || '"', 'all') AS status, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube(spark, sf_dir):
    return lineitems(spark, sf_dir).cube("flag", "status").agg(F.count("*").alias("n")).select(F.coalesce("flag", F.lit("all")).alias("flag"), F.coalesce("status", F.lit("all")).alias("status"), "n")


@query("""SELECT '"' || a.n_name || '"' AS name, count(b.n_name) AS later FROM nation a LEFT JOIN nation b ON a.n_name < b.n_name GROUP BY a.n_name""")
def theta_join(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(L.text(F.col("n_name")).alias("name"))
    return n.join(n.withColumnRenamed("name", "other"), C.term_lt("name", "other"), "left").groupBy("name").agg(F.count("other").alias("later"))


@query("""SELECT '<{B}part/' || p_partkey || '>' AS part, '"' || q || '"^^<{X}integer>' AS qty FROM part FULL JOIN (SELECT DISTINCT CAST(l_quantity AS BIGINT) * 3 AS q FROM lineitem) ON p_size = q""")
def full_join(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(L.node("part", F.col("p_partkey")).alias("part"), C.from_native(F.col("p_size"), "int").alias("size"))
    sizes = table(spark, sf_dir, "lineitem").select(L.integer(F.col("l_quantity") * 3).alias("qty"))
    return R.value_join(parts, R.distinct_by_value(sizes), "size", "qty", "full").select("part", "qty")


@query("""(SELECT '"' || o_orderpriority || '"' AS p FROM orders INTERSECT ALL (SELECT '"' || o_orderpriority || '"' FROM orders WHERE o_orderpriority < '4')) EXCEPT ALL SELECT DISTINCT '"' || o_orderpriority || '"' FROM orders""")
def bag_operations(spark, sf_dir):
    p = P.match(order_triples(spark, sf_dir), "?s", L.predicate("priority"), "?p").select("p")
    return p.intersectAll(p.where(C.term_lt("p", F.lit('"4"')))).exceptAll(R.distinct_by_value(p))


@query("""SELECT c, name, o FROM (SELECT '<{B}customer/' || c_custkey || '>' AS c, '"' || c_name || '"' AS name, '<{B}order/' || o_orderkey || '>' AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey) ORDER BY o DESC NULLS FIRST, c DESC NULLS FIRST LIMIT 40""")
def nulls_first(spark, sf_dir):
    names = P.match(customer_triples(spark, sf_dir), "?c", L.predicate("name"), "?name")
    rows = P.optional(names, P.match(order_triples(spark, sf_dir), "?o", L.predicate("customer"), "?c")).select("c", "name", "o")
    return R.page(R.ordered(rows, "o", "c", descending=True), 40)


@query("""SELECT '"' || p_name || '"@en' AS name, '"' || substr(p_name, 2) || '"@en' AS rest, '"' || regexp_replace(p_name, '([a-z])([0-9])', '\\2\\1', 'g') || '"' AS swapped, '"' || regexp_replace(p_name, 'A', 'x', 'gi') || '"' AS folded, true AS any_tag, true AS this_tag, false AS other_tag, length(p_name) AS size, '"' || md5(p_name) || '"' AS digest FROM part""")
def tagged_strings(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(L.tagged(F.col("p_name"), F.lit("en")).alias("name"))
    matches = lambda r: T.lang_matches(T.lang("name"), F.lit(r))
    return p.select("name", S.substr("name", 2).alias("rest"), S.replace("name", "([a-z])([0-9])", "\\2\\1").alias("swapped"), S.replace("name", "A", "x", "i").alias("folded"), matches("*").alias("any_tag"), matches("EN").alias("this_tag"), matches("de").alias("other_tag"), S.strlen("name").cast("long").alias("size"), S.md5("name").alias("digest"))


@query("""SELECT '<{B}customer/' || c_custkey || '>' AS s, '"' || CAST(abs(v) AS VARCHAR) || '"^^<{X}decimal>' AS size, '"' || abs(c_custkey - 50) || '"^^<{X}integer>' AS whole, '"INF"^^<{X}double>' AS infinite, '"1.0E' || (30 + c_custkey % 5) || '"^^<{X}double>' AS large FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(20,2)) AS v FROM customer) WHERE CAST(v * 100 AS BIGINT) % 10 <> 0""")
def number_functions_wide(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("decimal(20,2)").alias("x")).where("cast(x * 100 as bigint) % 10 <> 0")
    large = T.typed(F.concat(F.lit("-1.0e"), (30 + F.col("c_custkey") % 5).cast("string")), "double")
    return c.select(L.node("customer", F.col("c_custkey")).alias("s"), S.abs_(L.decimal(F.col("x"))).alias("size"), S.abs_(L.integer(F.col("c_custkey") - 50)).alias("whole"), S.abs_(F.lit(f'"-INF"^^<{X}double>')).alias("infinite"), F.regexp_replace(S.abs_(large), "1E", "1.0E").alias("large"))


@query("""SELECT '"' || upper(p_name) || '"@en' AS up, '"' || substr(p_name, 3, 4) || '"@en' AS part, 'en' AS tag, length(p_name) AS size, '"' || p_name || '-' || p_size || '"' AS joined, '"' || md5(p_name) || '"' AS digest, '<{X}integer>' AS kind, starts_with(p_name, 'p') AS starts FROM part""")
def sql_functions(spark, sf_dir):
    """The functions under their SQL names."""
    sql_names.register(spark, names=["ucase", "substr", "lang", "strlen", "concat", "md5", "datatype", "strstarts"])
    p = table(spark, sf_dir, "part").select(L.tagged(F.col("p_name"), F.lit("en")).alias("tagged"), L.text(F.col("p_name")).alias("name"), T.literal(F.concat(F.lit("-"), F.col("p_size").cast("string"))).alias("size"), L.integer(F.col("p_size")).alias("n"))
    return p.selectExpr("sparql_ucase(tagged) AS up", "sparql_substr(tagged, 3, 4) AS part", "sparql_lang(tagged) AS tag", "CAST(sparql_strlen(tagged) AS BIGINT) AS size", "sparql_concat(name, size) AS joined", "sparql_md5(name) AS digest", "sparql_datatype(n) AS kind", "sparql_strstarts(name, '\"p\"') AS starts")


@query()
def fresh_identifiers(spark, sf_dir):
    return table(spark, sf_dir, "region").select(L.node("region", F.col("r_regionkey")).alias("s"), T.uuid().alias("u"), T.struuid().alias("t"), T.bnode().alias("b"), S.rand().alias("r"), S.now().alias("now"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
