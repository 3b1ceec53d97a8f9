"""A small sandboxed template language, compiled to Python closures.

Syntax: ``{{ expression }}``, ``{% for x in xs %}``, ``{% if %}/{% elif %}/{% else %}``,
``{% set x = e %}`` and ``{% generation %} ... {% endgeneration %}``, which marks what a model
should learn to write.  Expressions: literals, names, ``a.b``, ``a['b']``, ``x | filter``,
``+ ~ == != < > <= >= in and or not`` and parentheses.

A template is parsed to a syntax tree (nested tuples), constants are folded, and the tree becomes
closures.  There are no calls, attributes reach only mapping keys, and names that begin with an
underscore are refused, so a template can reach nothing but the values it is given.  Output is
streamed: rendering yields pieces ``(text, span)``, where ``span`` numbers the generation block
that the piece lies in (None outside).
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping

Piece = tuple[str, int | None]

_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'[^']*'|"[^"]*")|(?P<num>\d+)|(?P<name>[A-Za-z]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|[-+~<>|().\[\]=,]))""")
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt,
            "<=": operator.le, ">=": operator.ge, "in": lambda a, b: a in b}
_BINARY = {**_COMPARE, "+": operator.add, "~": lambda a, b: text_of(a) + text_of(b)}
_WORDS = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    """The template can't be parsed, or it asks for what the sandbox refuses."""


def text_of(value) -> str:
    """A value as output text; None gives nothing."""
    return "" if value is None else value if isinstance(value, str) else str(value)


class _Expression:
    """Recursive descent over one tag's tokens."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens, self.filters, at = [], filters, 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected text in {source!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" else None

    def take(self, *values: str) -> str | None:
        if (now := self.peek()) in values and now is not None:
            self.at += 1
            return now
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError("unexpected text after an expression")
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        if self.take("not"):
            return ("not", self.negated())
        node = self.sum()
        if op := self.take(*_COMPARE):
            node = ("binary", op, node, self.sum())
        return node

    def sum(self):
        node = self.piped()
        while op := self.take("+", "~"):
            node = ("binary", op, node, self.piped())
        return node

    def piped(self):
        node = self.reached()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def reached(self):
        node = self.atom()
        while op := self.take(".", "["):
            if op == ".":
                node = ("key", node, ("const", self.name()))
            else:
                node = ("key", node, self.either())
                self.need("]")
        return node

    def atom(self):
        if self.take("("):
            node = self.either()
            self.need(")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", value[1:-1])
        if kind == "num":
            return ("const", int(value))
        if kind == "name":
            return ("const", _WORDS[value.lower()]) if value.lower() in _WORDS else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str, filters: Mapping[str, Callable]) -> tuple:
    """The syntax tree: a tuple of statements."""
    parts = [p for p in _TAG.split(source) if p]

    def block(at: int, ends: tuple[str, ...]):
        body = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{") and part.endswith("}}"):
                body.append(("out", _Expression(part[2:-2], filters).whole()))
                continue
            if not (part.startswith("{%") and part.endswith("%}")):
                body.append(("text", part))
                continue
            e = _Expression(part[2:-2], filters)
            word = e.name()
            if word in ends:
                return tuple(body), at, word, e
            if word == "set":
                name = e.name()
                e.need("=")
                body.append(("set", name, e.whole()))
            elif word == "generation":
                inner, at, _, _ = block(at, ("endgeneration",))
                body.append(("generation", inner))
            elif word == "for":
                name = e.name()
                e.need("in")
                over = e.whole()
                inner, at, _, _ = block(at, ("endfor",))
                body.append(("for", name, over, inner))
            elif word == "if":
                cases, test = [], e.whole()
                while True:
                    inner, at, word, e = block(at, ("elif", "else", "endif") if test else ("endif",))
                    cases.append((test or ("const", True), inner))
                    if word == "endif":
                        break
                    test = e.whole() if word == "elif" else None
                body.append(("if", tuple(cases)))
            else:
                raise TemplateError(f"unknown tag {word!r}")
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return tuple(body), at, "", None

    return block(0, ())[0]


def fold(node, filters: Mapping[str, Callable]):
    """An expression with its constant parts computed."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    parts = [fold(x, filters) if isinstance(x, tuple) else x for x in node[1:]]
    kids = [p for p in parts if isinstance(p, tuple)]
    node = (kind, *parts)
    if all(k[0] == "const" for k in kids):
        return ("const", _closure(node, filters)({}))
    if kind in ("and", "or") and kids[0][0] == "const":
        return kids[1] if bool(kids[0][1]) == (kind == "and") else kids[0]
    return node


def fold_body(body: tuple, filters: Mapping[str, Callable]) -> tuple:
    """Statements with constants folded, dead branches dropped and neighbouring texts joined."""
    out: list[tuple] = []
    for node in body:
        if node[0] == "out":
            e = fold(node[1], filters)
            node = ("text", text_of(e[1])) if e[0] == "const" else ("out", e)
        elif node[0] == "set":
            node = ("set", node[1], fold(node[2], filters))
        elif node[0] == "for":
            node = ("for", node[1], fold(node[2], filters), fold_body(node[3], filters))
        elif node[0] == "generation":
            node = ("generation", fold_body(node[1], filters))
        elif node[0] == "if":
            cases = []
            for test, inner in node[1]:
                test = fold(test, filters)
                if test[0] != "const" or test[1]:
                    cases.append((test, fold_body(inner, filters)))
                if test[0] == "const" and test[1]:
                    break
            if not cases:
                continue
            if cases[0][0][0] == "const":
                out.extend(cases[0][1])
                continue
            node = ("if", tuple(cases))
        out.append(node)
    joined: list[tuple] = []
    for node in out:
        if node[0] == "text" and joined and joined[-1][0] == "text":
            joined[-1] = ("text", joined[-1][1] + node[1])
        elif node != ("text", ""):
            joined.append(node)
    return tuple(joined)


def _closure(node, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        name = node[1]
        if name.startswith("_"):
            raise TemplateError(f"{name!r} is refused")
        return lambda scope: scope.get(name)
    if kind == "filter":
        f, inner = filters[node[1]], _closure(node[2], filters)
        return lambda scope: f(inner(scope))
    if kind == "not":
        inner = _closure(node[1], filters)
        return lambda scope: not inner(scope)
    if kind == "binary":
        f, left, right = _BINARY[node[1]], _closure(node[2], filters), _closure(node[3], filters)
        return lambda scope: f(left(scope), right(scope))
    left, right = _closure(node[1], filters), _closure(node[2], filters)
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)

    def key(scope):
        owner, name = left(scope), right(scope)
        if not isinstance(owner, Mapping):
            raise TemplateError("only keys of mappings can be reached")
        return owner.get(name)

    return key


def _body(body: tuple, filters: Mapping[str, Callable], spans: list[int],
          inside: bool = False) -> Callable[[dict], Iterator[Piece]]:
    """A generator function of the statements; ``spans[0]`` counts generation blocks."""
    steps = [_statement(node, filters, spans, inside) for node in body]

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def _statement(node, filters, spans, inside):
    kind = node[0]
    if kind == "text":
        text = node[1]

        def step(scope):
            yield text, spans[0] if inside else None
    elif kind == "out":
        value = _closure(node[1], filters)

        def step(scope):
            yield text_of(value(scope)), spans[0] if inside else None
    elif kind == "set":
        name, value = node[1], _closure(node[2], filters)

        def step(scope):
            scope[name] = value(scope)
            return iter(())
    elif kind == "generation":
        if inside:
            raise TemplateError("generation blocks can't be nested")
        inner = _body(node[1], filters, spans, True)

        def step(scope):
            spans[0] += 1
            yield from inner(scope)
    elif kind == "if":
        cases = [(_closure(test, filters), _body(inner, filters, spans, inside)) for test, inner in node[1]]

        def step(scope):
            for test, inner in cases:
                if test(scope):
                    yield from inner(scope)
                    return
    else:
        name, over, inner = node[1], _closure(node[2], filters), _body(node[3], filters, spans, inside)

        def step(scope):
            items: Iterable = over(scope) or ()
            for i, item in enumerate(items):
                yield from inner({**scope, name: item, "loop": {"index0": i, "index": i + 1, "first": i == 0}})
    return step


def compile_template(source: str, filters: Mapping[str, Callable]) -> Callable[[dict], Iterator[Piece]]:
    """A function from a scope (names to values) to the rendered pieces."""
    spans = [0]
    run = _body(fold_body(parse(source, filters), filters), filters, spans)

    def render(scope: dict) -> Iterator[Piece]:
        spans[0] = 0
        yield from run(dict(scope))

    return render
