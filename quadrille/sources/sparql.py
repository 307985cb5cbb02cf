"""SPARQL endpoints as DataFrames: a Python data source with readers for result and description documents, and a writer.

    spark.dataSource.register(SparqlSource)
    spark.read.format("quadrille_sparql").schema("s string, o string").option("endpoint", url).option("query", text).load()

A query is one partition, since an endpoint answers it as one document; `pages` splits it into that many with OFFSET and
LIMIT (`page_size` rows each, and the query must have an ORDER BY); the last one's task goes on page by page to an empty one. Documents are parsed as they arrive.
With `push_filters` (and spark.sql.python.filterPushdown.enabled) filters on columns go to the endpoint too.
"""

from __future__ import annotations

import base64
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator
from typing import BinaryIO

from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, Not, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from ..operators.update import BATCH, check_pattern, statements

RESULTS = "{http://www.w3.org/2005/sparql-results#}"
RDF_NS = "{http://www.w3.org/1999/02/22-rdf-syntax-ns#}"
XML_LANG = "{http://www.w3.org/XML/1998/namespace}lang"
# What a status says.
STATUS = {400: "bad request: the endpoint can't read the query", 401: "unauthorized: check user and password", 403: "forbidden", 404: "not found: check the endpoint's URL", 406: "not acceptable: check the format", 407: "proxy authentication required", 429: "too many requests", 500: "internal error of the endpoint", 503: "service unavailable"}


#: Where a filter at the end of the group would count before something else does, or not be in its scope.
OWN_GROUP = re.compile(r"\b(?:GROUP\s+BY|ORDER\s+BY|LIMIT|OFFSET|MINUS|UNION|HAVING|SERVICE|CONSTRUCT|ASK)\b", re.I)


class EndpointError(RuntimeError):
    pass


def _quoted(text: str) -> str:
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


def binding_term(node: ET.Element) -> str | None:
    """A binding's value as a canonical term; an empty literal isn't null."""
    kind, text = node.tag.removeprefix(RESULTS), node.text or ""
    if kind == "uri":
        return f"<{text}>"
    if kind == "bnode":
        return f"_:{text}"
    if kind != "literal":
        return None
    if tag := node.get(XML_LANG):
        head, _, rest = tag.partition("-")
        return f"{_quoted(text)}@{head.lower()}{'-' + rest if rest else ''}"
    return f"{_quoted(text)}^^<{kind}>" if (kind := node.get("datatype")) else _quoted(text)


def results(source: BinaryIO) -> Iterator[dict[str, str]]:
    """Rows of a SPARQL results document, one at a time."""
    for _, node in ET.iterparse(source):
        if node.tag == f"{RESULTS}result":
            yield {b.get("name"): t for b in node for v in b if (t := binding_term(v)) is not None}
            node.clear()


def description(source: BinaryIO, base: str = "") -> Iterator[tuple[str, str, str]]:
    """Triples of an RDF/XML document of flat descriptions."""
    for _, node in ET.iterparse(source):
        if node.tag != f"{RDF_NS}Description":
            continue
        about, label = node.get(f"{RDF_NS}about"), node.get(f"{RDF_NS}nodeID")
        subject = f"_:{label}" if label else f"<{urllib.parse.urljoin(base, about) if base else about}>"
        for p in node:
            predicate = "<" + p.tag.replace("{", "").replace("}", "") + ">"
            if (to := p.get(f"{RDF_NS}resource")) is not None:
                yield subject, predicate, f"<{urllib.parse.urljoin(base, to) if base else to}>"
            elif (to := p.get(f"{RDF_NS}nodeID")) is not None:
                yield subject, predicate, f"_:{to}"
            else:
                kind, tag = p.get(f"{RDF_NS}datatype"), p.get(XML_LANG)
                yield subject, predicate, _quoted(p.text or "") + (f"@{tag}" if tag else f"^^<{kind}>" if kind else "")
        node.clear()


def request(options: dict[str, str], form: dict[str, str], accept: str, endpoint: str | None = None) -> BinaryIO:
    """POST a form. Retried only where no answer came; an error status is raised with what it means."""
    url = endpoint or options["endpoint"]
    body = urllib.parse.urlencode(form) + (f"&{options['custom']}" if options.get("custom") else "")
    ask = urllib.request.Request(url, body.encode(), {"Accept": accept, "Content-Type": "application/x-www-form-urlencoded", "User-Agent": "quadrille"})
    if options.get("token"):
        ask.add_header("Authorization", f"Bearer {options['token']}")
    elif options.get("user"):
        ask.add_header("Authorization", "Basic " + base64.b64encode(f"{options['user']}:{options.get('password', '')}".encode()).decode())
    if proxy := options.get("https_proxy" if url.startswith("https:") else "http_proxy") or options.get("http_proxy"):
        ask.set_proxy(proxy.split("://")[-1].rstrip("/"), "http")
        if options.get("proxy_user"):
            ask.add_header("Proxy-Authorization", "Basic " + base64.b64encode(f"{options['proxy_user']}:{options.get('proxy_user_password', '')}".encode()).decode())
    opener = urllib.request.build_opener(_Redirects(str(options.get("request_redirect", "false")).lower() == "true", int(options.get("request_max_redirect", 10))))
    tries, whole = int(options.get("connect_retry", 3)) + 1, float(options.get("request_timeout", 0))
    for k in range(tries):
        try:
            answer = opener.open(ask, timeout=min(float(options.get("connect_timeout", 300)) or 300, whole or 1e9))
            return Answer(answer, url, whole, int(options.get("max_response_size", 0)))
        except urllib.error.HTTPError as e:
            raise EndpointError(f"{url}: {e.code}, {STATUS.get(e.code, 'a redirect that is not followed' if 300 <= e.code < 400 else 'error')}") from None
        except (urllib.error.URLError, OSError) as e:
            if k == tries - 1:
                raise EndpointError(f"{url}: no answer after {tries} tries ({e})") from None
            time.sleep(min(0.1 * 2**k, 5))
    raise AssertionError


class _Redirects(urllib.request.HTTPRedirectHandler):
    """Follows with the same form, if at all; credentials stay with the host they are for."""

    def __init__(self, follow: bool, most: int):
        self.follow, self.max_redirections = follow, most

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        if not self.follow:
            return None
        kept = {k: v for k, v in req.header_items() if k.lower() != "content-length" and (k.lower() != "authorization" or urllib.parse.urlsplit(newurl).netloc == urllib.parse.urlsplit(req.full_url).netloc)}
        return urllib.request.Request(newurl, req.data, kept, origin_req_host=req.origin_req_host, unverifiable=True)


class Answer:
    """A response's bytes, read up to a time (seconds from now; 0: none) and a size (bytes; 0: none)."""

    def __init__(self, body: BinaryIO, url: str, seconds: float, most: int):
        self.body, self.url, self.seconds, self.most = body, url, seconds, most
        self.end, self.got = time.monotonic() + seconds, 0

    def read(self, n: int = -1) -> bytes:
        if self.seconds and time.monotonic() > self.end:
            raise EndpointError(f"{self.url}: longer than {self.seconds:g} s")
        part = self.body.read(n)
        self.got += len(part)
        if self.most and self.got > self.most:
            raise EndpointError(f"{self.url}: more than {self.most} bytes")
        return part

    def close(self) -> None:
        self.body.close()


def _lexical(term: object) -> str | None:
    """A term's lexical form or IRI as a literal; None for blank nodes, for what isn't a term, and for texts with line
    ends, which documents may change."""
    if not isinstance(term, str) or re.search(r"[\r\n]", term):
        return None
    if m := re.fullmatch(r"<([^<>\"\\]*)>", term):
        return f'"{m[1]}"'
    m = re.fullmatch(r'("(?:[^"\\]|\\.)*")(?:@[A-Za-z0-9-]+|\^\^<[^<>]*>)?', term)
    return m and m[1]


def condition(f: Filter, names: dict[str, str]) -> str | None:
    """A SPARQL condition that is true wherever the filter on a column's terms is; None if there is none."""
    if isinstance(f, Not) or len(f.attribute) != 1 or f.attribute[0] not in names:
        return None
    var = f"?{names[f.attribute[0]]}"
    if isinstance(f, IsNotNull):
        return f"BOUND({var})"
    if isinstance(f, EqualTo) and (text := _lexical(f.value)):
        return f"STR({var}) = {text}"
    if isinstance(f, In) and f.value and all(texts := [_lexical(v) for v in f.value]):
        return f"STR({var}) IN ({', '.join(texts)})"
    if isinstance(f, StringStartsWith) and (m := re.fullmatch(r"([<\"])([^<>\"\\\r\n]+)", f.value)):
        return ("isIRI" if m[1] == "<" else "isLITERAL") + f"({var}) && STRSTARTS(STR({var}), \"{m[2]}\")"
    return None


def with_conditions(query: str, conditions: list[str]) -> str:
    """The query with filters at the end of its group. Unchanged where they'd mean something else there: in what can't be
    rewritten, with anything behind the group, and for variables that the group doesn't have or the head gives."""
    bare = re.sub(r'"(?:[^"\\]|\\.)*"|\'(?:[^\'\\]|\\.)*\'|<[^<>\s]*>|#[^\n]*', lambda m: " " * len(m[0]), query)
    if "{" not in bare or len(re.findall(r"\bSELECT\b", bare, re.I)) != 1 or OWN_GROUP.search(bare) or not bare.rstrip().endswith("}"):
        return query
    start, end, depth = bare.index("{"), bare.rindex("}"), 0
    for k in range(start, end):  # the group must be the one that ends last
        depth += {"{": 1, "}": -1}.get(bare[k], 0)
        if not depth:
            return query
    inside = set(re.findall(r"[?$](\w+)", bare[start:end])) - set(re.findall(r"\bAS\s+[?$](\w+)", bare[:start], re.I))
    said = [c for c in conditions if re.search(r"\?(\w+)", c)[1] in inside]
    return query[:end] + "".join(f"\n FILTER({c})" for c in said) + "\n" + query[end:] if said else query


class Page(InputPartition):
    def __init__(self, query: str, offset: int | None = None, size: int = 0, last: bool = True):
        self.query, self.offset, self.size, self.last = query, offset, size, last


class SparqlReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.schema = dict(options), schema
        for name in ("endpoint", "query"):
            if not self.options.get(name, "").strip():
                raise ValueError(f"option {name} is needed")

    def partitions(self) -> list[InputPartition]:
        query, pages = self.options["query"], int(self.options.get("pages", 1))
        if pages <= 1:
            return [Page(query)]
        size = int(self.options["page_size"])
        if size < 1:
            raise ValueError("option page_size must be 1 or more")
        return [Page(query, k * size, size, k == pages - 1) for k in range(pages)]

    def read(self, partition: Page) -> Iterator[Row]:
        if partition.offset is None:
            yield from self.page(partition.query)
            return
        at, end = partition.offset, partition.offset + partition.size
        triples = self.options.get("query_type", "select") == "describe"  # of which a solution has any number
        while partition.last or at < end:
            n, size = 0, partition.size if partition.last else end - at
            for row in self.page(f"{partition.query}\nOFFSET {at}\nLIMIT {size}"):
                n += 1
                yield row
            if not n:  # an endpoint may give fewer rows than asked for, so only an empty page is the end
                return
            at += size if triples else n

    def page(self, query: str) -> Iterator[Row]:
        form = {self.options.get("query_param", "query"): query}
        if self.options.get("query_type", "select") == "describe":
            if "describe" not in query.lower():
                raise ValueError("not a DESCRIBE query")
            yield from description(request(self.options, form, "application/rdf+xml"), self.options.get("base_uri", ""))
            return
        names = [self.options.get(f"variable.{f.name}".lower(), f.name).lstrip("?$") for f in self.schema]
        for row in results(request(self.options, form, self.options.get("format", "application/sparql-results+xml"))):
            yield tuple(row.get(n) for n in names)


class FilteringReader(SparqlReader):
    """For sessions with spark.sql.python.filterPushdown.enabled; Spark refuses such a reader in others."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Conditions on the terms' texts go to the endpoint as ones on lexical forms that let at least the same rows
        through; Spark checks every filter again."""
        names = {f.name: self.options.get(f"variable.{f.name}".lower(), f.name).lstrip("?$") for f in self.schema}
        if self.options.get("query_type", "select") != "describe":
            said = [c for f in filters if (c := condition(f, names))]
            self.options["query"] = with_conditions(self.options["query"], said)
        return filters


class SparqlWriter(DataSourceWriter):
    """Batches of updates from each task. Not transactional: a task that is run again repeats its (idempotent) statements."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.names = dict(options), schema.fieldNames()
        if str(self.options.get("readonly", "false")).lower() == "true":
            raise ValueError("the table is read-only")
        if not self.options.get("pattern"):
            raise ValueError("option pattern is needed")
        names = check_pattern(self.options["pattern"], self.names)
        if self.options.get("operation") == "update" and (missing := [n for n in names if f"old_{n}" not in self.names]):
            raise ValueError(f"no column old_{missing[0]} for ?{missing[0]} before the update")

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        o = self.options
        rows = (dict(zip(self.names, r)) for r in iterator)
        if o.get("operation") == "update":  # columns old_x have what ?x was
            rows = ({"old": {n.removeprefix("old_"): v for n, v in r.items() if n.startswith("old_")}, "new": r} for r in rows)
        for text in statements(rows, o["pattern"], o.get("operation", "insert"), int(o.get("batch_size", BATCH))):
            request(o, {"update": text}, "*/*", o.get("update_url") or o["endpoint"]).close()
        return WriterCommitMessage()


class SparqlSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quadrille_sparql"

    def schema(self) -> str:
        return "subject string, predicate string, object string"

    def reader(self, schema: StructType) -> SparqlReader:
        push = str(self.options.get("push_filters", "false")).lower() == "true"
        return (FilteringReader if push else SparqlReader)(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> SparqlWriter:
        return SparqlWriter(self.options, schema)
