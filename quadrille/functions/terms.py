"""RDF terms as canonical text in string columns, and SPARQL's functions on terms; built-in expressions only.

`<iri>`, `_:label`, `"lex"`, `"lex"@tag`, `"lex"^^<datatype>`. Null is unbound. Escapes other than \\u and \\U stay as
they are written, so a lexical form is what stands between the quotes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Namespaces and the numeric types, integers first.
XSD = "http://www.w3.org/2001/XMLSchema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
INTEGERS = ("integer", "positiveInteger", "negativeInteger", "nonPositiveInteger", "nonNegativeInteger", "int", "long", "short", "byte", "unsignedLong", "unsignedInt", "unsignedShort", "unsignedByte")
NUMERICS = (*INTEGERS, "decimal", "float", "double")

#: Input: quoted, with escapes or doubled quotes inside.
QUOTED = r'(?s)^"((?:[^"\\]|\\.|"")*)"(?:@([A-Za-z]{1,8}(?:-[A-Za-z0-9]{1,8})*)|\^\^(?:<([^<>"]*)>|([^\s<>"]+)))?$'
IRI = r'^<[^"\s>][^"\s]*>$|^<>[^"\s]*>$'
Term = Column | str


def _col(x: Term) -> Column:
    return F.col(x) if isinstance(x, str) else x


def term(value: str) -> Column:
    """A constant term from its text form."""
    return canonical(F.lit(value))


def xsd(name: str) -> str:
    return XSD + name


def is_iri(x: Term) -> Column:
    return F.coalesce(_col(x).rlike(IRI), F.lit(False))


def is_blank(x: Term) -> Column:
    x = _col(x)
    return F.coalesce(x.startswith("_:") & (F.char_length(x) > 2), F.lit(False))


def is_literal(x: Term) -> Column:
    return F.coalesce(_col(x).startswith('"'), F.lit(False))


def _unescape(x: Column) -> Column:
    """\\uXXXX and \\UXXXXXXXX to characters, surrogate pairs joined; lone surrogates and too large numbers to U+FFFD."""
    pieces = F.regexp_extract_all(x, F.lit(r"(?s)(\\u[Dd][89ABab][0-9A-Fa-f]{2}\\u[Dd][C-Fc-f][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+|\\)"), F.lit(1))
    number = lambda s: F.conv(s, 16, 10).cast("long")

    def char(code: Column) -> Column:
        bad = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        return F.when(bad, F.lit("\ufffd")).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def one(p: Column) -> Column:
        pair = (number(F.substring(p, 3, 4)) - 0xD800) * 1024 + number(F.substring(p, 9, 4)) - 0xDC00 + 0x10000
        return F.when(p.rlike(r"^\\u.{4}\\u"), char(pair)).when(p.rlike(r"^\\[uU][0-9A-Fa-f]{4}"), char(number(F.substring(p, 3, 8)))).otherwise(p)

    return F.when(x.rlike(r"\\[uU]"), F.array_join(F.transform(pieces, one), "")).otherwise(x)


def datatype_iri(name: Column) -> Column:
    return F.when(name.startswith("xsd:"), F.concat(F.lit(XSD), F.substring(name, 5, 1 << 30))).otherwise(name)


def _tag(tag: Column) -> Column:
    """Primary subtag in lower case."""
    head = F.substring_index(tag, "-", 1)
    return F.concat(F.lower(head), F.substring(tag, F.char_length(head) + 1, F.lit(1 << 30)))


def literal(lex: Column, tag: Column | None = None, datatype: Column | None = None) -> Column:
    quoted = F.concat(F.lit('"'), lex, F.lit('"'))
    if tag is not None:
        return F.concat(quoted, F.lit("@"), tag)
    return quoted if datatype is None else F.concat(quoted, F.lit("^^<"), datatype, F.lit(">"))


def typed(lex: Column, name: str) -> Column:
    return literal(lex, datatype=F.lit(xsd(name)))


def canonical(x: Term, on_error: str = "null") -> Column:
    """Text input to a canonical term. Trailing content after a literal, or a bad tag: null, or an error with "raise"."""
    x = _col(x)
    part = lambda k: F.regexp_extract(x, QUOTED, k)
    lex = _unescape(part(1))
    quoted = F.when(part(2) != "", literal(lex, tag=_tag(part(2)))).when(part(3) != "", literal(lex, datatype=datatype_iri(part(3)))).when(part(4) != "", literal(lex, datatype=datatype_iri(part(4)))).otherwise(literal(lex))
    closed = x.rlike(r'(?s)^"(?:[^"\\]|\\.|"")*"')
    bad = F.raise_error(F.concat(F.lit("trailing content after RDF literal: "), x)).cast("string") if on_error == "raise" else F.lit(None).cast("string")
    plain = literal(F.regexp_replace(_unescape(x), r'(?<!\\)((?:\\\\)*)"', r'$1\\"'))
    return F.when(is_iri(x) | is_blank(x), x).when(x.rlike(QUOTED), quoted).when(closed, bad).when(x.isNotNull(), plain)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once. Written out, a comparison repeats its operands dozens of times, too much
    for one JVM method to be compiled and for plans that inline it again; bound, the expression stays small."""
    return F.transform(F.array(value), body).getItem(0)


def suffix(x: Term) -> Column:
    """What follows the closing quote: empty, `@tag` or `^^<datatype>`. Neither can hold a quote, so the last one closes."""
    return F.substring_index(_col(x), '"', -1)


def has_type(x: Term, *names: str) -> Column:
    """Whether the datatype is one of the XSD types named; a plain string test, so it folds for constant terms."""
    return F.coalesce(suffix(x).isin(*[f"^^<{xsd(n)}>" for n in names]), F.lit(False))


def lex(x: Term) -> Column:
    """Lexical form as it is written; an IRI with its brackets."""
    x = _col(x)
    return F.when(is_literal(x), F.substring(x, F.lit(2), F.char_length(x) - F.char_length(suffix(x)) - 2)).otherwise(x)


def lang(x: Term) -> Column:
    end = suffix(x)
    return F.when(end.startswith("@"), F.substring(end, 2, 1 << 30)).otherwise(F.when(_col(x).isNotNull(), F.lit("")))


def dt(x: Term) -> Column:
    """Datatype IRI as written, empty for plain and tagged literals, IRIs and blank nodes."""
    end = suffix(x)
    return F.when(end.startswith("^^<"), F.substring(end, F.lit(4), F.char_length(end) - 4)).otherwise(F.when(_col(x).isNotNull(), F.lit("")))


def datatype(x: Term) -> Column:
    """As an IRI term; null for IRIs and blank nodes."""
    x = _col(x)
    kind = F.when(lang(x) != "", F.lit(RDF + "langString")).when(dt(x) == "", F.lit(xsd("string"))).otherwise(dt(x))
    return F.when(is_literal(x), F.concat(F.lit("<"), kind, F.lit(">")))


def is_plain(x: Term) -> Column:
    """Plain, xsd:string or xsd:anyURI: compared as a string."""
    x = _col(x)
    return is_literal(x) & suffix(x).isin("", f"^^<{xsd('string')}>", f"^^<{xsd('anyURI')}>")


def has_numeric_type(x: Term) -> Column:
    return has_type(x, *NUMERICS)


def is_numeric(x: Term) -> Column:
    number = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?|0[xX][0-9a-fA-F]+|(?i:inf|infinity|nan))$"
    return has_numeric_type(x) & F.coalesce(lex(x).rlike(number), F.lit(False))


def bound(x: Term) -> Column:
    return _col(x).isNotNull()


def coalesce(*xs: Term) -> Column:
    return F.coalesce(*map(_col, xs))


def same_term(a: Term, b: Term) -> Column:
    return _col(a) == _col(b)


def string_form(x: Term) -> Column:
    """An IRI without brackets, a literal's lexical form."""
    x = _col(x)
    return F.when(is_iri(x), F.substring(x, 2, F.char_length(x) - 2)).otherwise(lex(x))


def str_(x: Term) -> Column:
    return literal(string_form(x))


def iri(x: Term) -> Column:
    x = _col(x)
    return F.when(is_iri(x), x).when(~is_blank(x), F.concat(F.lit("<"), lex(x), F.lit(">")))


uri = iri


def bnode(x: Term | None = None) -> Column:
    """Without an argument a fresh one for each row."""
    if x is None:
        return F.concat(F.lit("_:b"), F.replace(F.uuid(), F.lit("-"), F.lit("")))
    x = _col(x)
    label = F.regexp_replace(lex(x), r"[^\x00-\x7F]|[^A-Za-z0-9]", "_")
    return F.when(is_blank(x), x).when(is_literal(x) & (label != ""), F.concat(F.lit("_:"), label))


def strdt(x: Term, kind: Term) -> Column:
    x, kind = _col(x), _col(kind)
    name = datatype_iri(F.regexp_replace(string_form(kind), r"^<|>$", ""))
    return F.when(~is_blank(x) & ~is_blank(kind) & (name != "") & ~name.rlike(r"\s"), literal(string_form(x), datatype=name))


def strlang(x: Term, tag: Term) -> Column:
    x, tag = _col(x), string_form(tag)
    return F.when(~is_blank(x) & (tag != ""), literal(string_form(x), tag=_tag(tag)))


def uuid() -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))


def struuid() -> Column:
    return literal(F.uuid())


def lang_matches(tag: Term, wanted: Term) -> Column:
    """tag and range as text or plain literals."""
    text = lambda c: F.lower(string_form(c))
    t, r = text(tag), F.regexp_replace(text(wanted), r"-\*$", "")
    return F.when(t == "", F.lit(False)).otherwise((r == "*") | (t == r) | t.startswith(F.concat(r, F.lit("-"))))


def compatible(a: Term, b: Term) -> Column:
    """SPARQL's argument compatibility: both simple, or one tag, or a tag and a simple second."""
    a, b = _col(a), _col(b)
    simple = lambda x: is_literal(x) & (lang(x) == "") & dt(x).isin("", xsd("string"))
    return (simple(a) & simple(b)) | ((lang(a) != "") & ((lang(a) == lang(b)) | simple(b)))
