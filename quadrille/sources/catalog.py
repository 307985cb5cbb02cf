"""Servers, tables, users and prefixes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

# The prefixes of the default context.
DEFAULT_PREFIXES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "owl": "http://www.w3.org/2002/07/owl#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "foaf": "http://xmlns.com/foaf/0.1/",
}


@dataclass(frozen=True)
class Server:
    endpoint: str
    update_url: str | None = None
    format: str = "application/sparql-results+xml"
    query_param: str = "query"
    custom: str | None = None
    http_proxy: str | None = None
    https_proxy: str | None = None
    connect_timeout: int = 300
    request_timeout: int = 0
    connect_retry: int = 3
    request_redirect: bool = False
    request_max_redirect: int = 10
    max_response_size: int = 0
    enable_pushdown: bool = True
    readonly: bool = False
    batch_size: int = 50
    fetch_size: int = 100
    prefix_context: str | None = None
    base_uri: str = ""

    def __post_init__(self):
        if not re.match(r"https?://", self.endpoint):
            raise ValueError("endpoint must be an http or https URL")
        if min(self.connect_timeout, self.request_timeout, self.connect_retry, self.request_max_redirect, self.max_response_size) < 0 or min(self.batch_size, self.fetch_size) < 1:
            raise ValueError("timeouts, retries, redirects and max_response_size must be 0 or more, other sizes 1 or more")


@dataclass(frozen=True)
class User:
    user: str | None = None
    password: str | None = None
    token: str | None = None
    proxy_user: str | None = None
    proxy_user_password: str | None = None


@dataclass(frozen=True)
class Variable:
    """A column's variable and how it is read: term, or a native type with the options of older tables."""

    variable: str
    kind: str = "term"
    expression: str | None = None
    language: str | None = None
    literal_type: str | None = None
    nodetype: str = "literal"

    def __post_init__(self):
        if not re.fullmatch(r"[?$][A-Za-z_]\w*", self.variable):
            raise ValueError(f"not a variable: {self.variable}")
        if self.kind == "term" and (self.expression or self.language or self.literal_type):
            raise ValueError("term columns take a variable only")


@dataclass(frozen=True)
class Table:
    server: Server
    sparql: str
    columns: dict[str, Variable]
    log_sparql: bool = False
    enable_pushdown: bool | None = None
    readonly: bool | None = None
    sparql_update_pattern: str | None = None
    user: User = User()

    @property
    def writable(self) -> bool:
        return not (self.server.readonly if self.readonly is None else self.readonly)

    @property
    def pushes_down(self) -> bool:
        return self.server.enable_pushdown if self.enable_pushdown is None else self.enable_pushdown


@dataclass
class Prefixes:
    """Contexts of prefixes; "default" is there from the start."""

    contexts: dict[str, dict[str, str]] = field(default_factory=lambda: {"default": dict(DEFAULT_PREFIXES)})

    def add_context(self, context: str, override: bool = False) -> None:
        if context in self.contexts and not override:
            raise ValueError(f"there is a context {context}")
        self.contexts.setdefault(context, {})

    def drop_context(self, context: str, cascade: bool = False) -> None:
        if self.contexts.get(context) and not cascade:
            raise ValueError(f"{context} has prefixes")
        if self.contexts.pop(context, None) is None:
            raise ValueError(f"no context {context}")

    def add_prefix(self, context: str, prefix: str, uri: str, override: bool = False) -> None:
        if context not in self.contexts:
            raise ValueError(f"no context {context}")
        if prefix in self.contexts[context] and not override:
            raise ValueError(f"{context} has a prefix {prefix}")
        self.contexts[context][prefix] = uri

    def drop_prefix(self, context: str, prefix: str) -> None:
        if self.contexts.get(context, {}).pop(prefix, None) is None:
            raise ValueError(f"no prefix {prefix} in {context}")

    def header(self, context: str) -> str:
        return "".join(f"PREFIX {p}: <{u}>\n" for p, u in sorted(self.contexts.get(context, {}).items()))

    def expand(self, context: str, name: str) -> str:
        prefix, _, local = name.partition(":")
        return f"<{self.contexts[context][prefix]}{local}>"

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(p, u, c) for c, ps in self.contexts.items() for p, u in ps.items()], "prefix string, uri string, context string")


def with_options(server: Server, **options) -> Server:
    return replace(server, **options)
