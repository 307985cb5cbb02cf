import re
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, Not, StringStartsWith

from quadrille.plans.pushdown import Call, Const, Var, rewritable
from quadrille.sources import sparql as Q
from quadrille.sources import tables as T
from quadrille.sources.catalog import Server, Table, User, Variable

N = 7


@pytest.fixture
def endpoint():
    """An endpoint with rows ?s = <http://x/k>, ?o = "k", which knows OFFSET and LIMIT alone; `asked` are its requests."""
    asked = []

    class Stub(BaseHTTPRequestHandler):
        def do_POST(self):
            form = parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
            query = form.get("query", form.get("update", [""]))[0]
            asked.append((query, dict(self.headers)))
            if self.path == "/moved":
                self.send_response(307)
                self.send_header("Location", "/sparql")
                self.end_headers()
                return
            cut = lambda word, other: int(m[1]) if (m := re.search(rf"\n{word} (\d+)", query)) else other
            at = cut("OFFSET", 0)
            rows = "".join(f'<result><binding name="s"><uri>http://x/{k}</uri></binding><binding name="o"><literal>{k}</literal></binding></result>' for k in range(at, min(N, at + cut("LIMIT", N))))
            if self.path == "/slow":
                time.sleep(0.3)
            self.send_response(200)
            self.end_headers()
            self.wfile.write(f'<sparql xmlns="http://www.w3.org/2005/sparql-results#"><results>{rows}</results></sparql>'.encode())

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def table(url, **server):
    return Table(Server(f"{url}/sparql", **server), "SELECT ?s ?p ?o WHERE { ?s ?p ?o }", {"s": Variable("?s", nodetype="iri"), "o": Variable("?o")}, sparql_update_pattern="?s <p> ?o .", user=User("me", "pw"))


def test_load_prunes_and_rechecks(spark, endpoint):
    url, asked = endpoint
    wanted = (Call("=", (Var("o"), Const("3"))), F.col("o") == '"3"')
    assert [r[0] for r in T.load(spark, table(url), ["s"], [wanted], limit=1).collect()] == ["<http://x/3>"]
    query, headers = asked[-1]
    assert "SELECT ?s ?o\n" in query and 'FILTER(?o = "3")' in query and "LIMIT" not in query and headers["Authorization"].startswith("Basic ")
    assert T.load(spark, table(url), ["s"], order=[("s", True)], limit=2, offset=1).collect() == [("<http://x/1>",), ("<http://x/2>",)]
    assert "SELECT ?s\n" in asked[-1][0] and asked[-1][0].endswith("ORDER BY ASC (?s)\nLIMIT 3")
    local = (Call("or", ()), F.col("o") == '"4"')
    assert T.load(spark, table(url), ["o"], [local]).collect() == [('"4"',)] and "FILTER" not in asked[-1][0]
    assert T.load(spark, table(url, enable_pushdown=False), ["o"], order=[("o", False)], limit=2).collect() == [('"6"',), ('"5"',)]
    assert T.load(spark, table(url), ["o"], distinct=True, order=[("s", False)], limit=2).collect() == [('"6"',), ('"5"',)]
    assert "Order: endpoint" in T.explain(spark, table(url), order=[("s", True)])


def test_filters_reach_the_endpoint(spark, endpoint):
    url, asked = endpoint
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        assert T.load(spark, table(url)).where("o = '\"5\"' and s like '<http://x/%'").collect() == [("<http://x/5>", '"5"')]
        assert 'FILTER(STR(?o) = "5")' in asked[-1][0] and 'FILTER(isIRI(?s) && STRSTARTS(STR(?s), "http://x/"))' in asked[-1][0]
        assert T.load(spark, table(url, enable_pushdown=False)).where("o = '\"5\"'").count() == 1 and "FILTER" not in asked[-1][0]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_conditions():
    names = {"o": "o"}
    said = lambda f: Q.condition(f, names)
    assert said(EqualTo(("o",), '"a\\"b"@en')) == 'STR(?o) = "a\\"b"' and said(In(("o",), ("<i>", '"1"^^<d>'))) == 'STR(?o) IN ("i", "1")'
    assert said(IsNotNull(("o",))) == "BOUND(?o)" and said(StringStartsWith(("o",), '"ab')) == 'isLITERAL(?o) && STRSTARTS(STR(?o), "ab")'
    for f in (EqualTo(("o",), "_:b"), EqualTo(("o",), '"a\nb"'), EqualTo(("o",), "no term"), EqualTo(("other",), "<i>"), In(("o",), ("<i>", "_:b")), Not(IsNotNull(("o",))), StringStartsWith(("o",), '"a"')):
        assert said(f) is None
    for q in ("SELECT ?o { ?s ?p ?o } LIMIT 2", "SELECT ?o { ?s ?p ?o } VALUES ?s { <a> }", "SELECT (COUNT(?s) AS ?o) { ?s ?p ?x }", "SELECT ?o { { SELECT ?o { ?s ?p ?o } } }", "SELECT ?o { { ?o ?p ?s } UNION { ?s ?p ?o } }"):
        assert Q.with_conditions(q, ["BOUND(?o)"]) == q
    assert Q.with_conditions('SELECT ?o { ?s ?p ?o . # }\n }', ["BOUND(?o)"]).endswith("\n FILTER(BOUND(?o))\n}")
    assert rewritable("SELECT ?s { ?s ?p ?o . OPTIONAL { ?s ?q ?r } }") and not rewritable("SELECT ?s { ?s ?p ?o } VALUES ?s { <a> }")


@pytest.mark.parametrize("most, start, rows", [(0, 0, range(N)), (5, 0, range(5)), (0, 2, range(2, N)), (3, 6, range(6, N)), (0, 99, [])])
def test_clone_by_pages(spark, endpoint, tmp_path, most, start, rows):
    url, asked = endpoint
    got = T.clone_pages(spark, table(url), str(tmp_path / "c"), fetch_size=3, begin_offset=start, max_records=most)
    assert sorted(got.collect()) == [(f"<http://x/{k}>", f'"{k}"') for k in rows]
    assert all("ORDER BY ASC (?s)\nOFFSET" in q for q, _ in asked)


def test_clone_goes_on(spark, endpoint, tmp_path):
    url, _ = endpoint
    path = str(tmp_path / "c")
    assert T.clone_pages(spark, table(url), path, max_records=4).count() == 4
    assert T.clone_pages(spark, table(url), path, begin_offset=4, append=True).count() == N
    with pytest.raises(ValueError, match="no column x"):
        T.clone_pages(spark, table(url), path, ["x"])


def test_save(spark, endpoint):
    url, asked = endpoint
    T.save(spark.createDataFrame([("<a>", '"1"')], "s string, o string").coalesce(1), table(url), "delete")
    assert any('DELETE DATA { <a> <p> "1" . };' in q for q, _ in asked)
    with pytest.raises(Exception, match="read-only"):
        T.save(spark.createDataFrame([("<a>", '"1"')], "s string, o string"), table(url, readonly=True))


def test_redirects_time_and_size(endpoint):
    url, _ = endpoint
    ask = lambda path, **o: list(Q.results(Q.request({"endpoint": url + path, "connect_retry": "0", **o}, {"query": "q"}, "*/*")))
    with pytest.raises(Q.EndpointError, match="307"):
        ask("/moved")
    assert len(ask("/moved", request_redirect="true")) == N
    with pytest.raises(Q.EndpointError, match="more than 100 bytes"):
        ask("/sparql", max_response_size="100")
    with pytest.raises(Q.EndpointError):
        ask("/slow", request_timeout="0.1")
    assert len(ask("/slow", request_timeout="9")) == N
