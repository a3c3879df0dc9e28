"""A small sandboxed template language, compiled to Python closures.

Syntax: ``{{ expression }}``, ``{% for x in messages %}``, ``{% if %}`` / ``elif`` /
``else``, ``{% set name = expression %}``, ``{% generation %}`` ... ``{% endgeneration %}``
(text that a model is trained to produce), ``{# comment #}``. Expressions: literals,
names, fields (``m.role``), ``== != < > <= >= in and or not + ~``, parentheses and filters
(``| escape``).

``compile_template`` parses the text into a syntax tree, folds constants (expressions of
literals, branches with a known test, names that are set once to a literal) and
returns a function ``render(names) -> iterator of (text, generated)`` that yields pieces as
it goes: a loop asks its sequence for one element at a time, so a conversation of any
length renders in constant memory.

The sandbox: no calls, no Python attributes (a field is a dictionary key), a bounded template
size and nesting (of blocks, parentheses, and chains of fields, filters and comparisons; chains
of ``and or + ~`` are flat and may be as long as the template), whole numbers of at most 18
digits, folded and joined texts of bounded size. What breaks these bounds, or applies an operator
to values it has no meaning for, is a ``TemplateError``: when compiling, or when rendering where
it depends on the data.
"""
from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

MAX_TEMPLATE_CHARS = 20_000
MAX_DEPTH = 40
MAX_FOLDED_CHARS = 100_000        # of a text that is computed when compiling
MAX_JOINED_CHARS = 64 << 20       # of a text that ``+`` or ``~`` makes when rendering
MAX_DIGITS = 18


class TemplateError(ValueError):
    """The template is not well-formed or leaves the sandbox."""


# --- syntax tree -----------------------------------------------------------------------
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
class Op:
    """``name`` applied to ``args``: an operator or ``|filter``."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    expr: Any


@dataclass(frozen=True)
class If:
    tests: tuple          # of (expression, body)
    otherwise: tuple


@dataclass(frozen=True)
class For:
    name: str
    of: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    expr: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- control strings -------------------------------------------------------------------
@dataclass(frozen=True)
class Controls:
    """Strings with a meaning of their own in the output, and their reversible escape: a
    backslash before each of them and before each backslash."""

    strings: tuple[str, ...]

    def pattern(self, also: str = "") -> re.Pattern[str]:
        longest_first = sorted(self.strings, key=len, reverse=True)
        return re.compile(also + "|".join(map(re.escape, longest_first)))

    def escape(self, text: str) -> str:
        return self.pattern(r"\\|").sub(lambda m: "\\" + m[0], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)


# --- parser ----------------------------------------------------------------------------
_PIECES = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_TOKENS = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                     r"""|(?P<op>==|!=|<=|>=|[<>+~().|=,]))""", re.S)
_LITERALS = {"true": True, "false": False, "none": None}
_COMPARE = ("==", "!=", "<", ">", "<=", ">=", "in")
_BACKSLASHED = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = _TOKENS.match(source, at)
            if not m:
                raise TemplateError(f"unexpected text in expression: {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup or "", m[m.lastgroup]))
            at = m.end()
        self.at = self.depth = 0

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" else ""

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted and self.peek():
            self.at += 1
            return True
        return False

    def whole(self) -> Any:
        out = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def chain(self, word: str, part: Callable[[], Any]) -> Any:
        """``part word part ...`` as one flat node."""
        args = [part()]
        while self.take(word):
            args.append(part())
        return Op(word, tuple(args)) if len(args) > 1 else args[0]

    def either(self) -> Any:
        return self.chain("or", self.both)

    def both(self) -> Any:
        return self.chain("and", self.negated)

    def negated(self) -> Any:
        times = 0
        while self.take("not"):
            times += 1
        left = self.joined()
        for _ in self.bounded(lambda: (op := self.peek()) in _COMPARE and bool(op)):
            op = self.peek()
            self.at += 1
            left = Op(op, (left, self.joined()))
        for _ in range(2 - times % 2 if times else 0):  # twice is a plain truth value
            left = Op("not", (left,))
        return left

    def joined(self) -> Any:
        return self.chain("~", self.added)

    def added(self) -> Any:
        return self.chain("+", self.filtered)

    def filtered(self) -> Any:
        out = self.primary()
        for _ in self.bounded(lambda: self.peek() in ("|", ".")):
            if self.take("|"):
                out = Op("|" + self.name(), (out,))
            elif self.take("."):
                out = Field(out, self.name())
        return out

    @staticmethod
    def bounded(more: Callable[[], bool]) -> Iterator[int]:
        """Steps of a chain that nests with its length."""
        step = 0
        while more():
            if step == MAX_DEPTH:
                raise TemplateError("nested too deeply")
            yield step
            step += 1

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def primary(self) -> Any:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            out: Any = Const(re.sub(r"\\(.)", lambda m: _BACKSLASHED.get(m[1], m[0]), text[1:-1], flags=re.S))
        elif kind == "int":
            if len(text) > MAX_DIGITS:
                raise TemplateError("a number is too long")
            out = Const(int(text))
        elif kind == "name":
            out = Const(_LITERALS[text]) if text in _LITERALS else Name(text)
        elif text == "(":
            out = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis is not closed")
        else:
            raise TemplateError(f"unexpected {text!r}")
        self.depth -= 1
        return out


class _Parser:
    def __init__(self, source: str) -> None:
        if len(source) > MAX_TEMPLATE_CHARS:
            raise TemplateError("the template is too long")
        self.pieces = [p for p in _PIECES.split(source) if p and not p.startswith("{#")]
        self.at = 0

    def body(self, until: tuple[str, ...], depth: int = 0) -> tuple[tuple, str, str]:
        """Nodes up to a tag in ``until``; that tag's word and the rest of the tag."""
        if depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        nodes: list[Any] = []
        while self.at < len(self.pieces):
            piece = self.pieces[self.at]
            self.at += 1
            if piece.startswith("{{"):
                nodes.append(Output(_Expression(piece[2:-2]).whole()))
            elif piece.startswith("{%"):
                word, _, rest = piece[2:-2].strip().partition(" ")
                if word in until:
                    return tuple(nodes), word, rest
                nodes.append(self.block(word, rest, depth))
            else:
                nodes.append(Text(piece))
        if until:
            raise TemplateError(f"{' or '.join(until)} is missing")
        return tuple(nodes), "", ""

    def block(self, word: str, rest: str, depth: int) -> Any:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError("for needs a name and a sequence")
            body, _, _ = self.body(("endfor",), depth + 1)
            return For(m[1], _Expression(m[2]).whole(), body)
        if word == "if":
            tests, otherwise, test = [], (), _Expression(rest).whole()
            while True:
                body, end, rest = self.body(("elif", "else", "endif"), depth + 1)
                tests.append((test, body))
                if end == "elif":
                    test = _Expression(rest).whole()
                    continue
                if end == "else":
                    otherwise, _, _ = self.body(("endif",), depth + 1)
                return If(tuple(tests), otherwise)
        if word == "set":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.+)", rest, re.S)
            if not m:
                raise TemplateError("set needs a name and a value")
            return Set(m[1], _Expression(m[2]).whole())
        if word == "generation":
            body, _, _ = self.body(("endgeneration",), depth + 1)
            return Generation(body)
        raise TemplateError(f"unknown tag {word!r}")


def parse(source: str) -> tuple:
    """Template text -> syntax tree (a tuple of nodes)."""
    return _Parser(source).body(())[0]


# --- constant folding ------------------------------------------------------------------
def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _plus(a: Any, b: Any) -> Any:
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("+ needs two texts or two numbers")
    return a + b


_APPLY: dict[str, Callable[..., Any]] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "in": lambda a, b: a in b, "+": _plus, "~": lambda a, b: _text(a) + _text(b), "not": operator.not_,
    "|trim": lambda a: _text(a).strip(), "|upper": lambda a: _text(a).upper(), "|lower": lambda a: _text(a).lower(),
    "|length": len,
}


def _functions(controls: Controls) -> dict[str, Callable[..., Any]]:
    escape = controls.pattern(r"\\|").sub
    named = _APPLY | {"|escape": lambda a: escape(lambda m: "\\" + m[0], _text(a))}

    def guarded(name: str, f: Callable[..., Any]) -> Callable[..., Any]:
        def apply(*args: Any) -> Any:
            if name in ("+", "~") and sum(len(a) for a in args if isinstance(a, str)) > MAX_JOINED_CHARS:
                raise TemplateError("a text becomes too long")
            try:
                return f(*args)
            except (TypeError, ValueError) as e:
                raise TemplateError(f"{name.strip('|')} does not apply: {e}") from e

        return apply

    return {name: guarded(name, f) for name, f in named.items()}


def _assigned(nodes: Iterable[Any]) -> list[str]:
    out: list[str] = []
    for n in nodes:
        if isinstance(n, Set):
            out.append(n.name)
        elif isinstance(n, For):
            out += [n.name, "loop", *_assigned(n.body)]
        elif isinstance(n, Generation):
            out += _assigned(n.body)
        elif isinstance(n, If):
            for _, body in n.tests:
                out += _assigned(body)
            out += _assigned(n.otherwise)
    return out


def fold(tree: tuple, functions: dict[str, Callable[..., Any]]) -> tuple:
    """The tree with everything computed that does not depend on the data."""
    names = _assigned(tree)
    once = {n for n in names if names.count(n) == 1}
    known: dict[str, Any] = {}

    def small(value: Any) -> Any:
        if isinstance(value, str) and len(value) > MAX_FOLDED_CHARS:
            raise TemplateError("a text becomes too long")
        return value

    def joined(name: str, args: list[Any]) -> Any:
        """Literals at the start of a chain are put together (for ``~`` anywhere in it)."""
        out: list[Any] = []
        for a in args:
            if out and isinstance(a, Const) and isinstance(out[-1], Const) and (name == "~" or len(out) == 1):
                out[-1] = Const(small(functions[name](out[-1].value, a.value)))
            else:
                out.append(a)
        return Op(name, tuple(out)) if len(out) > 1 else out[0]

    def expr(e: Any) -> Any:
        if isinstance(e, Name):
            return Const(known[e.name]) if e.name in known else e
        if isinstance(e, Field):
            return Field(expr(e.of), e.name)
        if isinstance(e, Op):
            if e.name not in ("and", "or") and e.name not in functions:
                raise TemplateError(f"unknown filter or operator {e.name!r}")
            args = list(map(expr, e.args))
            if e.name in ("and", "or"):
                while len(args) > 1 and isinstance(args[0], Const):
                    if bool(args[0].value) != (e.name == "and"):
                        return args[0]
                    args.pop(0)
                return Op(e.name, tuple(args)) if len(args) > 1 else args[0]
            if e.name in ("+", "~"):
                return joined(e.name, args)
            if all(isinstance(a, Const) for a in args):
                return Const(small(functions[e.name](*[a.value for a in args])))
            return Op(e.name, tuple(args))
        return e

    def add(out: list[Any], n: Any) -> None:
        if isinstance(n, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + n.value)
        elif not (isinstance(n, Text) and not n.value):
            out.append(n)

    def body(nodes: tuple, top: bool = False) -> tuple:
        out: list[Any] = []
        for n in nodes:
            if isinstance(n, Output):
                e = expr(n.expr)
                n = Text(_text(e.value)) if isinstance(e, Const) else Output(e)
            elif isinstance(n, Set):
                e = expr(n.expr)
                if top and isinstance(e, Const) and n.name in once:
                    known[n.name] = e.value
                    continue
                n = Set(n.name, e)
            elif isinstance(n, For):
                n = For(n.name, expr(n.of), body(n.body))
            elif isinstance(n, Generation):
                n = Generation(body(n.body))
            elif isinstance(n, If):
                tests, otherwise = [], body(n.otherwise)
                for test, b in n.tests:
                    test, b = expr(test), body(b)
                    if not isinstance(test, Const):
                        tests.append((test, b))
                    elif test.value:
                        otherwise = b
                        break
                if not tests:
                    for inner in otherwise:
                        add(out, inner)
                    continue
                n = If(tuple(tests), otherwise)
            add(out, n)
        return tuple(out)

    return body(tree, top=True)


# --- closures --------------------------------------------------------------------------
Names = dict[str, Any]
Piece = tuple[str, bool]


def _expr(e: Any, functions: dict[str, Callable[..., Any]]) -> Callable[[Names], Any]:
    if isinstance(e, Const):
        value = e.value
        return lambda names: value
    if isinstance(e, Name):
        name = e.name
        return lambda names: names.get(name)
    if isinstance(e, Field):
        of, key = _expr(e.of, functions), e.name

        def field(names: Names) -> Any:
            value = of(names)
            return value.get(key) if isinstance(value, Mapping) else None

        return field
    first, *rest = [_expr(a, functions) for a in e.args]
    if e.name in ("and", "or"):
        goes_on = e.name == "and"

        def decided(names: Names) -> Any:
            value = first(names)
            for part in rest:
                if bool(value) != goes_on:
                    break
                value = part(names)
            return value

        return decided
    apply = functions[e.name]
    if not rest:
        return lambda names: apply(first(names))

    def applied(names: Names) -> Any:
        value = first(names)
        for part in rest:
            value = apply(value, part(names))
        return value

    return applied


def _body(nodes: tuple, functions: dict[str, Callable[..., Any]], generated: bool = False) -> Callable[[Names], Iterator[Piece]]:
    steps = [_node(n, functions, generated) for n in nodes]

    def run(names: Names) -> Iterator[Piece]:
        for step in steps:
            yield from step(names)

    return run


def _node(n: Any, functions: dict[str, Callable[..., Any]], generated: bool) -> Callable[[Names], Iterable[Piece]]:
    if isinstance(n, Text):
        pieces = ((n.value, generated),)
        return lambda names: pieces
    if isinstance(n, Output):
        value = _expr(n.expr, functions)
        return lambda names: ((_text(value(names)), generated),)
    if isinstance(n, Set):
        value, name = _expr(n.expr, functions), n.name

        def assign(names: Names) -> Iterable[Piece]:
            names[name] = value(names)
            return ()

        return assign
    if isinstance(n, Generation):
        inner = _body(n.body, functions, True)

        def produced(names: Names) -> Iterator[Piece]:
            yield "", True  # marks the block even if it is empty
            yield from inner(names)

        return produced
    if isinstance(n, If):
        tests = [(_expr(t, functions), _body(b, functions, generated)) for t, b in n.tests]
        otherwise = _body(n.otherwise, functions, generated)
        return lambda names: next((b for t, b in tests if t(names)), otherwise)(names)
    of, name, inner = _expr(n.of, functions), n.name, _body(n.body, functions, generated)

    def loop(names: Names) -> Iterator[Piece]:
        end = object()
        elements = iter(of(names) or ())
        element, index = next(elements, end), 0
        while element is not end:
            following = next(elements, end)
            state = {"index0": index, "index": index + 1, "first": index == 0, "last": following is end}
            yield from inner({**names, name: element, "loop": state})
            element, index = following, index + 1

    return loop


def compile_template(source: str, controls: Controls) -> Callable[[Names], Iterator[Piece]]:
    """Template text -> ``render(names)``, an iterator of (text, generated) pieces."""
    functions = _functions(controls)
    run = _body(fold(parse(source), functions), functions)
    return lambda names: run(dict(names))
