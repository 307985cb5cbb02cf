import io
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs

import pytest
from pyspark.sql.types import StructType

from quadrille.operators import update as U
from quadrille.plans.pushdown import Call, Const, Var, plan, rewritable
from quadrille.sources import sparql as Q
from quadrille.sources.catalog import Prefixes, Server, Table, Variable

XML = b"""<sparql xmlns="http://www.w3.org/2005/sparql-results#"><results>
<result><binding name="s"><uri>http://a</uri></binding><binding name="o"><literal xml:lang="EN-us">x"y</literal></binding></result>
<result><binding name="s"><bnode>b0</bnode></binding><binding name="o"><literal/></binding></result>
<result><binding name="o"><literal datatype="http://d">1</literal></binding></result></results></sparql>"""


def test_results():
    assert list(Q.results(io.BytesIO(XML))) == [{"s": "<http://a>", "o": '"x\\"y"@en-US'.replace("US", "us")}, {"s": "_:b0", "o": '""'}, {"o": '"1"^^<http://d>'}]


def test_endpoint(spark):
    asked = []

    class Stub(BaseHTTPRequestHandler):
        def do_POST(self):
            form = parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
            asked.append(form)
            code = 401 if "bad" in form.get("query", [""])[0] else 200
            self.send_response(code)
            self.end_headers()
            self.wfile.write(XML)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/sparql"
    spark.dataSource.register(Q.SparqlSource)
    load = lambda q: spark.read.format("quadrille_sparql").schema("s string, o string").option("endpoint", url).option("query", q).load()
    assert load("SELECT ?s ?o {?s ?p ?o}").count() == 3
    with pytest.raises(Exception, match="401"):
        load("bad").collect()
    spark.createDataFrame([("<a>", '"1\n"')], "s string, o string").write.format("quadrille_sparql").option("endpoint", url).option("pattern", "?s <p> ?o .").mode("append").save()
    assert any("INSERT DATA { <a> <p> \"1\\n\" . };" in f.get("update", [""])[0] for f in asked)
    server.shutdown()


@pytest.mark.parametrize("most", [1, 9])  # rows that the endpoint gives at once
@pytest.mark.parametrize("n", [0, 3, 6, 7, 20])
def test_pages_cover_all_rows(monkeypatch, n, most):
    def answer(options, form, accept, endpoint=None):
        at, size = (int(x.split()[1]) for x in form["query"].split("\n")[1:])
        rows = "".join(f'<result><binding name="s"><uri>{k}</uri></binding></result>' for k in range(at, min(at + min(size, most), n)))
        return io.BytesIO(f'<sparql xmlns="http://www.w3.org/2005/sparql-results#"><results>{rows}</results></sparql>'.encode())

    monkeypatch.setattr(Q, "request", answer)
    reader = Q.SparqlReader({"endpoint": "x", "query": "SELECT ?s {?s ?p ?o} ORDER BY ?s", "pages": "3", "page_size": "2"}, StructType().add("s", "string"))
    parts = reader.partitions()
    assert len(parts) == 3 and [r[0] for p in parts for r in reader.read(p)] == [f"<{k}>" for k in range(n)]


def test_update_guards():
    with pytest.raises(ValueError):
        U.check_pattern("?s ?p", ["s", "p"])
    with pytest.raises(ValueError):
        U.check_pattern("?s ?p ?o", ["s", "p"])
    with pytest.raises(ValueError):
        list(U.statements([{"s": None, "p": "<p>", "o": "<o>"}], "?s ?p ?o"))
    assert list(U.statements([{"s": None, "p": "<p>", "o": "<o>"}], "?s ?p ?o", "delete")) == []
    assert len(list(U.statements([{"s": "<s>", "p": "<p>", "o": "<o>"}] * 5, "?s ?p ?o", batch=2))) == 3


def test_pushdown():
    t = Table(Server("http://x/sparql"), "SELECT ?s ?o WHERE { ?s ?p ?o }", {"s": Variable("?s"), "o": Variable("?o")})
    p = plan(t, ["o"], [Call("=", (Var("o"), Const('"a"@en', True))), Call("or", ())], [("o", False)], 5, 2)
    assert 'FILTER(?o = "a"@en)' in p.sparql and "LIMIT" not in p.sparql and len(p.local) == 1
    assert plan(t, ["o"], [], [("o", True)], 5, 2).sparql.endswith("ORDER BY ASC (?o)\nLIMIT 7")
    assert not rewritable("SELECT ?s { ?s ?p ?o } LIMIT 3")
    assert Prefixes().expand("default", "xsd:int") == "<http://www.w3.org/2001/XMLSchema#int>"


def test_nested_comparisons_have_parentheses():
    t = Table(Server("http://x/sparql"), "SELECT ?s ?o WHERE { ?s ?p ?o }", {"s": Variable("?s"), "o": Variable("?o")})
    inner = Call("<", (Var("o"), Const(3)))
    assert "FILTER((?o < 3) = " in plan(t, None, [Call("=", (inner, Const(True)))]).sparql


def test_writer_updates_and_deletes(monkeypatch):
    sent = []
    monkeypatch.setattr(Q, "request", lambda options, form, accept, endpoint=None: sent.append(form["update"]) or io.BytesIO())
    schema = StructType().add("s", "string").add("o", "string").add("old_s", "string").add("old_o", "string")
    options = {"endpoint": "http://x", "pattern": "?s <p> ?o .", "operation": "update"}
    Q.SparqlWriter(options, schema).write(iter([("<a>", '"2"', "<a>", '"1"')]))
    assert sent == ['DELETE DATA { <a> <p> "1" . }; INSERT DATA { <a> <p> "2" . };']
    with pytest.raises(ValueError, match="old_s"):
        Q.SparqlWriter(options, StructType().add("s", "string").add("o", "string"))
    Q.SparqlWriter(options | {"operation": "delete"}, StructType().add("s", "string").add("o", "string")).write(iter([("<a>", '"2"'), (None, '"3"')]))
    assert sent[1:] == ['DELETE DATA { <a> <p> "2" . };']
