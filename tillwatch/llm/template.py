"""A compiler for chat templates.

The language is sandboxed: text, `{{ expression }}`, `{% for x in list %}`, `{% if %}` with `elif` and
`else`, `{% set x = expression %}`, and `{% generation %}`, which marks what a model is trained to write.
Expressions have names, strings, whole numbers, true, false, none, fields (`x.role`), `==`, `!=`, `and`,
`or`, `not`, `+`, parentheses and the filters given by the caller. There are no calls, no indexes, no Python
attributes and no loops but over a given list, so a template can neither reach Python nor run on.

`compile_template` parses the text into a tree, folds what is constant (constant expressions become
values, branches that cannot run go, neighbouring texts become one), and turns the tree into Python
closures. The result yields pieces of output, each with whether it is generated, as it goes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any


class TemplateError(ValueError):
    """The template is not of the language, or asks a value for what it has not."""


# --- tree -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    name: str


@dataclass(frozen=True)
class Filtered:
    of: Any
    name: str


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Show:
    value: Any


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parsing --------------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[.|+()=]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_RESERVED = {"and", "or", "not", "in", "if", "for", *_WORDS}


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise TemplateError(f"cannot read {text[at:]!r}")
        kind = ("string", "number", "name", "sign")[m.lastindex - 1]
        out.append((kind, m[m.lastindex]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent: or, and, not, comparison, sum, filter, field."""

    def __init__(self, tokens: list[tuple[str, str]]):
        self.tokens, self.at = tokens, 0

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, *values: str) -> None:
        if not self.take(*values):
            raise TemplateError(f"{' or '.join(values)} is missing")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name" and not self.tokens[self.at][1].startswith("_"):
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing, or starts with an underscore")

    def whole(self):
        found = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def either(self):
        found = self.both()
        while self.take("or"):
            found = Op("or", (found, self.both()))
        return found

    def both(self):
        found = self.negated()
        while self.take("and"):
            found = Op("and", (found, self.negated()))
        return found

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        found = self.sum()
        while sign := self.take("==", "!="):
            found = Op(sign, (found, self.sum()))
        return found

    def sum(self):
        found = self.filtered()
        while self.take("+"):
            found = Op("+", (found, self.filtered()))
        return found

    def filtered(self):
        found = self.atom()
        while sign := self.take(".", "|"):
            found = Field(found, self.name()) if sign == "." else Filtered(found, self.name())
        return found

    def atom(self):
        if self.take("("):
            found = self.either()
            self.need(")")
            return found
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, value = self.tokens[self.at]
        if kind == "string":
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "number":
            self.at += 1
            return Const(int(value))
        if value in _WORDS:
            self.at += 1
            return Const(_WORDS[value])
        if value in _RESERVED:
            raise TemplateError(f"unexpected {value!r}")
        return Name(self.name())


def parse(text: str) -> tuple:
    """The tree of a template."""
    at, parts = 0, []
    for m in _TAG.finditer(text):
        parts += [("text", text[at : m.start()])] * (m.start() > at)
        if m[1] is not None:
            parts.append(("show", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    parts += [("text", text[at:])] * (at < len(text))
    body, rest = _block(parts, ())
    if rest:
        raise TemplateError(f"unexpected {rest[0][1]!r}")
    return body


def _block(parts: list, ends: tuple[str, ...]) -> tuple[tuple, list]:
    """Nodes up to a tag that starts with one of `ends`, and the parts from there."""
    out = []
    while parts:
        kind, value = parts[0]
        word = value.split(None, 1)[0] if kind == "tag" and value else ""
        if kind == "tag" and word in ends:
            return tuple(out), parts
        parts = parts[1:]
        if kind == "text":
            out.append(Show(Const(value)))
        elif kind == "show":
            out.append(Show(_Expression(_tokens(value)).whole()))
        else:
            node, parts = _tag(word, value[len(word) :], parts)
            out.append(node)
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return tuple(out), []


def _tag(word: str, rest: str, parts: list):
    e = _Expression(_tokens(rest))
    if word == "set":
        name = e.name()
        e.need("=")
        return Set(name, e.whole()), parts
    if word == "for":
        name = e.name()
        e.need("in")
        over = e.whole()
        body, parts = _block(parts, ("endfor",))
        return For(name, over, body), parts[1:]
    if word == "generation":
        body, parts = _block(parts, ("endgeneration",))
        return Generation(body), parts[1:]
    if word == "if":
        test = e.whole()
        then, parts = _block(parts, ("elif", "else", "endif"))
        head, parts = parts[0][1], parts[1:]
        other: tuple = ()
        if head.startswith("elif"):
            node, parts = _tag("if", head[4:], parts)
            return If(test, then, (node,)), parts
        if head == "else":
            other, parts = _block(parts, ("endif",))
            parts = parts[1:]
        return If(test, then, other), parts
    raise TemplateError(f"unknown tag {word!r}")


# --- folding --------------------------------------------------------------------------------


def _shown(value: Any) -> str:
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _add(a: Any, b: Any) -> Any:
    if isinstance(a, str) and isinstance(b, str) or type(a) is type(b) is int:
        return a + b
    raise TemplateError("+ takes two texts or two numbers")


def fold(node: Any, filters: Mapping[str, Callable[[str], str]]) -> Any:
    """The node with constants worked out; for a body (a tuple), the nodes that are left."""
    if isinstance(node, tuple):
        out: list = []
        for one in node:
            one = fold(one, filters)
            for n in one if isinstance(one, tuple) else (one,):
                shown = isinstance(n, Show) and isinstance(n.value, Const)
                if shown and out and isinstance(out[-1], Show) and isinstance(out[-1].value, Const):
                    out[-1] = Show(Const(_shown(out[-1].value.value) + _shown(n.value.value)))
                elif not (shown and not _shown(n.value.value)):
                    out.append(n)
        return tuple(out)
    if isinstance(node, Show | Set):
        return replace(node, value=fold(node.value, filters))
    if isinstance(node, Field):
        return replace(node, of=fold(node.of, filters))
    if isinstance(node, Filtered):
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        of = fold(node.of, filters)
        return Const(filters[node.name](_shown(of.value))) if isinstance(of, Const) else replace(node, of=of)
    if isinstance(node, Op):
        first = fold(node.args[0], filters)
        if node.kind in ("and", "or") and isinstance(first, Const):
            return first if bool(first.value) == (node.kind == "or") else fold(node.args[1], filters)
        args = (first, *(fold(a, filters) for a in node.args[1:]))
        if all(isinstance(a, Const) for a in args):
            return Const(_value(Op(node.kind, args), filters)({}))
        return Op(node.kind, args)
    if isinstance(node, If):
        test = fold(node.test, filters)
        if isinstance(test, Const):  # what can never run is not folded
            return fold(node.then if test.value else node.other, filters)
        then, other = fold(node.then, filters), fold(node.other, filters)
        return If(test, then, other) if then or other else ()
    if isinstance(node, For):
        body = fold(node.body, filters)
        return For(node.name, fold(node.over, filters), body) if body else ()
    if isinstance(node, Generation):
        body = fold(node.body, filters)
        return Generation(body) if body else ()
    return node


# --- closures -------------------------------------------------------------------------------

Piece = tuple[str, bool]


def _value(node: Any, filters: Mapping[str, Callable[[str], str]]) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Field):
        of, name = _value(node.of, filters), node.name

        def field(env: dict) -> Any:
            holder = of(env)
            if not isinstance(holder, dict):
                raise TemplateError(f"no field {name!r} here")
            return holder.get(name)

        return field
    if isinstance(node, Filtered):
        of, apply = _value(node.of, filters), filters[node.name]
        return lambda env: apply(_shown(of(env)))
    args = [_value(a, filters) for a in node.args]
    if node.kind == "not":
        return lambda env: not args[0](env)
    a, b = args
    return {
        "or": lambda env: a(env) or b(env),
        "and": lambda env: a(env) and b(env),
        "==": lambda env: a(env) == b(env),
        "!=": lambda env: a(env) != b(env),
        "+": lambda env: _add(a(env), b(env)),
    }[node.kind]


def _body(nodes: tuple, filters: Mapping, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_step(n, filters, generated) for n in nodes]

    def run(env: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(env)

    return run


def _step(node: Any, filters: Mapping, generated: bool) -> Callable[[dict], Iterable[Piece]]:
    if isinstance(node, Show):
        if isinstance(node.value, Const):
            piece = [(_shown(node.value.value), generated)]
            return lambda env: piece
        value = _value(node.value, filters)
        return lambda env: [(_shown(value(env)), generated)]
    if isinstance(node, Set):
        value, name = _value(node.value, filters), node.name

        def assign(env: dict) -> Iterable[Piece]:
            env[name] = value(env)
            return ()

        return assign
    if isinstance(node, If):
        test = _value(node.test, filters)
        then, other = _body(node.then, filters, generated), _body(node.other, filters, generated)
        return lambda env: then(env) if test(env) else other(env)
    if isinstance(node, Generation):
        if generated:
            raise TemplateError("generation within generation")
        return _body(node.body, filters, True)
    over, body, name = _value(node.over, filters), _body(node.body, filters, generated), node.name

    def loop(env: dict) -> Iterator[Piece]:
        items = over(env)
        if items is None or isinstance(items, str | int | dict):
            raise TemplateError("for goes over a list")
        for i, item in enumerate(items):
            inner = {**env, name: item, "loop": {"index": i + 1, "index0": i, "first": i == 0}}
            yield from body(inner)

    return loop


def compile_template(text: str, filters: Mapping[str, Callable[[str], str]]) -> Callable[[dict], Iterator[Piece]]:
    """A function from values to pieces of (text, generated); lists may be iterators and are read once."""
    body = _body(fold(parse(text), filters), filters, False)
    return lambda values: (piece for piece in body(dict(values)) if piece[0])
