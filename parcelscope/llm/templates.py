"""A small sandboxed template language, compiled to Python closures.

    text {{ expression }} {% for m in messages %} .. {% else %} .. {% endfor %}
    {% if a %} .. {% elif b %} .. {% else %} .. {% endif %} {% set x = expression %}
    {% generation %} .. {% endgeneration %} {# remark #}

A `-` inside a tag strips the white space beside it. Expressions know strings, numbers, true, false,
none, names, `a.b`, `a['b']`, `a | filter(x)`, `not and or`, comparisons, `in`, `+ - * / % ~` and
`x if c else y`. The sandbox has no calls and no attributes of Python objects: `a.b` reads keys of
mappings only, and filters are those handed to `compile_template`. What `generation` encloses is
marked as the model's part; its offsets in the rendered text are returned.

The source becomes a syntax tree, constants are folded (also neighbouring text), and each node
becomes one closure, so rendering does not look at the tree again.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

TAG = re.compile(r"\{\{-?|\{%-?|\{#")
TOKEN = re.compile(
    r"""\s*(?:(?P<number>\d+(?:\.\d+)?)|(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")"""
    r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+*/%~<>()\[\].,|=]))""",
    re.S,
)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
MAX_DEPTH = 50


class TemplateError(ValueError):
    """The template can't be parsed, or asks for what the sandbox does not give."""


# --- syntax tree ----------------------------------------------------------------------------


@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Item:
    base: Any
    key: Any


@dataclass
class Filter:
    name: str
    args: list


@dataclass
class Op:
    name: str
    args: list


@dataclass
class Choice:
    test: Any
    then: Any
    other: Any


@dataclass
class Show:
    value: Any


@dataclass
class For:
    name: str
    items: Any
    body: list
    empty: list


@dataclass
class If:
    branches: list  # (test, body)
    other: list


@dataclass
class Set:
    name: str
    value: Any


@dataclass
class Generation:
    body: list


# --- parser ---------------------------------------------------------------------------------


class _Expression:
    """Recursive descent over the tokens of one tag."""

    BINARY = [("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("~",), ("+", "-"), ("*", "/", "%")]

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:].strip()[:20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = self.depth = 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        return None if kind == "string" else text

    def take(self, text: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or text is not None and self.peek() != text:
            raise TemplateError(f"expected {text or 'a value'}")
        self.at += 1
        return self.tokens[self.at - 1]

    def name(self) -> str:
        kind, text = self.take()
        if kind != "name" or text.startswith("_"):
            raise TemplateError(f"not a name: {text}")
        return text

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]}")

    def whole(self) -> Any:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("too deeply nested")
        value = self.binary(0)
        if self.peek() == "if":
            self.take()
            test = self.binary(0)
            other = Const("")
            if self.peek() == "else":
                self.take()
                other = self.whole()
            value = Choice(test, value, other)
        self.depth -= 1
        return value

    def binary(self, level: int) -> Any:
        if level == len(self.BINARY):
            return self.postfix()
        names = self.BINARY[level]
        if names == ("not",):
            if self.peek() == "not":
                self.take()
                return Op("not", [self.binary(level)])
            return self.binary(level + 1)
        left = self.binary(level + 1)
        while True:
            sign = self.peek()
            if sign == "not" and "in" in names and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
                self.at += 2
                left = Op("not", [Op("in", [left, self.binary(level + 1)])])
            elif sign in names:
                self.take()
                left = Op(sign, [left, self.binary(level + 1)])
            else:
                return left

    def postfix(self) -> Any:
        kind, text = self.take()
        if kind == "number":
            value = Const(float(text) if "." in text else int(text))
        elif kind == "string":
            value = Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        elif kind == "name":
            lower = text.lower()
            known = {"true": True, "false": False, "none": None}
            self.at -= lower not in known
            value = Const(known[lower]) if lower in known else Name(self.name())
        elif text == "(":
            value = self.whole()
            self.take(")")
        elif text == "-":
            value = Op("-", [Const(0), self.postfix()])
        else:
            raise TemplateError(f"unexpected {text}")
        while self.peek() in (".", "[", "|"):
            sign = self.take()[1]
            if sign == ".":
                value = Item(value, Const(self.name()))
            elif sign == "[":
                value = Item(value, self.whole())
                self.take("]")
            else:
                name, args = self.name(), [value]
                if self.peek() == "(":
                    self.take()
                    while self.peek() != ")":
                        args.append(self.whole())
                        if self.peek() == ",":
                            self.take()
                    self.take(")")
                value = Filter(name, args)
        return value


def _pieces(source: str) -> list[tuple[str, str]]:
    """('text' or 'show' or 'tag', content) in order."""
    out, at, strip = [], 0, False
    while at <= len(source):
        m = TAG.search(source, at)
        text = source[at : m.start() if m else len(source)]
        if strip:
            text = text.lstrip()
        if m and m[0].endswith("-"):
            text = text.rstrip()
        if text:
            out.append(("text", text))
        if not m:
            break
        closing = {"{{": "}}", "{%": "%}", "{#": "#}"}[m[0][:2]]
        stop = source.find(closing, m.end())
        if stop < 0:
            raise TemplateError(f"{m[0]} is not closed")
        content = source[m.end() : stop]
        strip = content.endswith("-")
        content = content[:-1] if strip else content
        if closing != "#}":
            out.append(("show" if closing == "}}" else "tag", content))
        at = stop + 2
    return out


class _Parser:
    def __init__(self, source: str):
        self.pieces, self.at = _pieces(source), 0

    def body(self, *stops: str) -> tuple[list, str, _Expression | None]:
        """Nodes up to one of the stop words, that word, and the rest of its tag."""
        nodes: list = []
        while self.at < len(self.pieces):
            kind, content = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(Show(Const(content)))
                continue
            e = _Expression(content)
            if kind == "show":
                nodes.append(Show(e.whole()))
                e.end()
                continue
            word = e.take()[1]
            if word in stops:
                return nodes, word, e
            if word == "for":
                name = e.name()
                e.take("in")
                items = e.whole()
                e.end()
                inner, stop, _ = self.body("else", "endfor")
                empty = self.body("endfor")[0] if stop == "else" else []
                nodes.append(For(name, items, inner, empty))
            elif word == "if":
                branches, other, stop = [], [], "if"
                while stop in ("if", "elif"):
                    test = e.whole()
                    e.end()
                    inner, stop, e = self.body("elif", "else", "endif")
                    branches.append((test, inner))
                if stop == "else":
                    other = self.body("endif")[0]
                nodes.append(If(branches, other))
            elif word == "set":
                name = e.name()
                e.take("=")
                nodes.append(Set(name, e.whole()))
                e.end()
            elif word == "generation":
                nodes.append(Generation(self.body("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {word}")
        if stops:
            raise TemplateError(f"missing {stops[-1]}")
        return nodes, "", None


# --- meaning --------------------------------------------------------------------------------


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _item(base: Any, key: Any) -> Any:
    if isinstance(base, Mapping):
        return base.get(key)
    if isinstance(base, (list, tuple, str)) and isinstance(key, int):
        return base[key] if -len(base) <= key < len(base) else None
    return None


OPERATORS: dict[str, Callable] = {
    "not": operator.not_, "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le,
    ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b, "+": operator.add, "-": operator.sub,
    "*": operator.mul, "/": operator.truediv, "%": operator.mod, "~": lambda a, b: _text(a) + _text(b),
}

FILTERS: dict[str, Callable] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": lambda v: len(v) if v is not None else 0,
    "default": lambda v, other="": other if v is None else v,
    "join": lambda v, by="": _text(by).join(_text(x) for x in v),
}


def _fold(node: Any, filters: Mapping[str, Callable]) -> Any:
    """The node with constant parts computed. Only pure built-in operations are computed early."""
    if isinstance(node, list):
        out: list = []
        for n in (_fold(n, filters) for n in node):
            for part in n.other if isinstance(n, If) and not n.branches else [n]:
                before = out[-1] if out else None
                if all(isinstance(x, Show) and isinstance(x.value, Const) for x in (before, part)):
                    out[-1] = Show(Const(_text(before.value.value) + _text(part.value.value)))
                else:
                    out.append(part)
        return out
    match node:
        case Item(base, key):
            base, key = _fold(base, filters), _fold(key, filters)
            both = isinstance(base, Const) and isinstance(key, Const)
            return Const(_item(base.value, key.value)) if both else Item(base, key)
        case Filter(name, args):
            if name not in filters:
                raise TemplateError(f"unknown filter {name}")
            args = [_fold(a, filters) for a in args]
            if name in FILTERS and all(isinstance(a, Const) for a in args):
                return Const(filters[name](*(a.value for a in args)))
            return Filter(name, args)
        case Op(name, args):
            args = [_fold(a, filters) for a in args]
            if name in ("and", "or") and isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (name == "and") else args[0]
            if name in OPERATORS and all(isinstance(a, Const) for a in args):
                try:
                    return Const(OPERATORS[name](*(a.value for a in args)))
                except Exception as error:
                    raise TemplateError(f"{name}: {error}") from error
            return Op(name, args)
        case Choice(test, then, other):
            test, then, other = (_fold(x, filters) for x in (test, then, other))
            return (then if test.value else other) if isinstance(test, Const) else Choice(test, then, other)
        case Show(value):
            return Show(_fold(value, filters))
        case For(name, items, body, empty):
            return For(name, _fold(items, filters), _fold(body, filters), _fold(empty, filters))
        case If(branches, other):
            kept = []
            for test, body in branches:
                test = _fold(test, filters)
                if isinstance(test, Const):
                    if test.value:
                        return If(kept, _fold(body, filters))
                    continue
                kept.append((test, _fold(body, filters)))
            return If(kept, _fold(other, filters))
        case Set(name, value):
            return Set(name, _fold(value, filters))
        case Generation(body):
            return Generation(_fold(body, filters))
    return node


@dataclass
class Output:
    """What a template writes, and the spans of its generation blocks."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    match node:
        case Const(value):
            return lambda env: value
        case Name(name):
            return lambda env: env.get(name)
        case Item(base, key):
            base_of, key_of = _value(base, filters), _value(key, filters)
            return lambda env: _item(base_of(env), key_of(env))
        case Filter(name, args):
            call, of = filters[name], [_value(a, filters) for a in args]
            if len(of) == 1:
                only = of[0]
                return lambda env: call(only(env))
            return lambda env: call(*(f(env) for f in of))
        case Op("and", [a, b]):
            left, right = _value(a, filters), _value(b, filters)
            return lambda env: left(env) and right(env)
        case Op("or", [a, b]):
            left, right = _value(a, filters), _value(b, filters)
            return lambda env: left(env) or right(env)
        case Op(name, args):
            call, of = OPERATORS[name], [_value(a, filters) for a in args]
            return lambda env: call(*(f(env) for f in of))
        case Choice(test, then, other):
            test_of, then_of, other_of = (_value(x, filters) for x in (test, then, other))
            return lambda env: then_of(env) if test_of(env) else other_of(env)
    raise TemplateError(f"no value: {node}")


def _block(nodes: list, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    steps = [_step(n, filters) for n in nodes]

    def run(env: dict, out: Output) -> None:
        for step in steps:
            step(env, out)

    return run


def _step(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    match node:
        case Show(Const(value)):
            text = _text(value)
            return lambda env, out: out.write(text)
        case Show(value):
            of = _value(value, filters)
            return lambda env, out: out.write(_text(of(env)))
        case Set(name, value):
            of = _value(value, filters)
            return lambda env, out: env.__setitem__(name, of(env))
        case If(branches, other):
            tests = [(_value(t, filters), _block(b, filters)) for t, b in branches]
            otherwise = _block(other, filters)

            def choose(env: dict, out: Output) -> None:
                for test, body in tests:
                    if test(env):
                        return body(env, out)
                return otherwise(env, out)

            return choose
        case For(name, items, body, empty):
            items_of, inner, otherwise = _value(items, filters), _block(body, filters), _block(empty, filters)

            def loop(env: dict, out: Output) -> None:
                values = items_of(env) or []
                if not values:
                    return otherwise(env, out)
                own = dict(env)
                for i, value in enumerate(values):
                    own[name] = value
                    own["loop"] = {
                        "index": i + 1, "index0": i, "first": i == 0, "last": i == len(values) - 1, "length": len(values),
                    }
                    inner(own, out)
                return None

            return loop
        case Generation(body):
            inner = _block(body, filters)

            def mark(env: dict, out: Output) -> None:
                start = out.length
                inner(env, out)
                out.spans.append((start, out.length))

            return mark
    raise TemplateError(f"no statement: {node}")


Template = Callable[[dict], tuple[str, list[tuple[int, int]]]]


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Template:
    """A function from variables to (text, spans of generation in code points of the text)."""
    known = FILTERS | dict(filters or {})
    run = _block(_fold(_Parser(source).body()[0], known), known)

    def render(variables: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(variables), out)
        return "".join(out.parts), out.spans

    return render
