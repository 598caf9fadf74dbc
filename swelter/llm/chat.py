"""Chat formatting with a template compiler.

The template language has text, ``{{ expression }}``, ``{% for x in y %}``, ``{% if %}/{% elif %}/{% else %}`` and
``{% generation %}`` blocks; expressions are literals, names, attributes, ``==``, ``!=``, ``and``, ``or``, ``not``, ``+`` and the
filters ``escape``, ``upper``, ``lower`` and ``trim``. It is sandboxed: a template reaches the given values and nothing else. A
template is parsed to a syntax tree, constants are folded, and the tree becomes Python closures that yield
(text, is it generated) pieces, so that a conversation is rendered as its rows stream by, whatever its length.

``{% generation %}`` marks what an assistant wrote: the loss mask. The ``escape`` filter puts a backslash before every control
string and every backslash of a text, so the turns can be read back from the output exactly.

Rows are one conversation per conv_id (null is one too), ordered by turn, role, text, nulls first. Null roles and texts count as
empty; repeated rows are turns of their own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swelter.llm.common import parallelism

#: Control strings of the default template (fixed values).
OPEN, ROLE, TEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (OPEN, ROLE, TEXT, CLOSE)

TEMPLATE = (
    "{% for message in messages %}{{ '<s>' + '[INST]' }}{{ message.role | escape }}{{ '[/INST]' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}{{ '</s>' }}{% endfor %}"
)

_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "upper": str.upper, "lower": str.lower, "trim": str.strip}

# --- syntax tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Call:
    """An operator or a filter on its arguments."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


class TemplateError(ValueError):
    pass


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+|.()]))")
_LITERALS = {"true": True, "false": False, "none": None}
_WRITTEN = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression, weakest operator first."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self):
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = Call("or", (node, self.both()))
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = Call("and", (node, self.negated()))
        return node

    def negated(self):
        return Call("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        while op := self.take("==", "!="):
            node = Call(op, (node, self.joined()))
        return node

    def joined(self):
        node = self.filtered()
        while self.take("+"):
            node = Call("+", (node, self.filtered()))
        return node

    def filtered(self):
        node = self.atom()
        while self.take("|"):
            name = self.word()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = Call(name, (node,))
        return node

    def word(self) -> str:
        if self.at == len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def atom(self):
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return node
        if self.at == len(self.tokens):
            raise TemplateError("a value is missing")
        kind, text = self.tokens[self.at]
        if kind == "op":
            raise TemplateError(f"unexpected {text!r}")
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _WRITTEN.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(text))
        if text in _LITERALS:
            return Const(_LITERALS[text])
        path = [text]
        while self.take("."):
            path.append(self.word())
        if any(p.startswith("_") for p in path):
            raise TemplateError("names that start with _ are not reachable")
        return Name(tuple(path))


def parse(source: str) -> tuple:
    """The statements of a template."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(source):
        parts += [("text", source[at : m.start()])] if m.start() > at else []
        parts.append(("value", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts += [("text", source[at:])] if at < len(source) else []
    position = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal position
        out: list[object] = []
        while position < len(parts):
            kind, text = parts[position]
            position += 1
            if kind == "text":
                out.append(Emit(Const(text)))
            elif kind == "value":
                out.append(Emit(_Expression(text).whole()))
            elif (word := (text.split() or [""])[0]) in ends:
                return tuple(out), text
            elif word == "for":
                m = re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", text, re.S)
                if not m:
                    raise TemplateError(f"cannot read {text!r}")
                out.append(For(m[1], _Expression(m[2]).whole(), block("endfor")[0]))
            elif word == "if":
                out.append(branch(text[2:]))
            elif word == "generation":
                out.append(Generation(block("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {text!r}")
        if ends:
            raise TemplateError(f"{ends[0]} is missing")
        return tuple(out), ""

    def branch(test: str) -> If:
        then, end = block("elif", "else", "endif")
        other: tuple = ()
        if end.startswith("elif"):
            other = (branch(end[4:]),)
        elif end == "else":
            other = block("endif")[0]
        return If(_Expression(test).whole(), then, other)

    return block()[0]


# --- constant folding

_OPS: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: a + b, "not": lambda a: not a} | FILTERS


def fold(node):
    """The same tree with constant expressions evaluated, decided branches taken and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list[object] = []
        for x in map(fold, node):
            for y in x if isinstance(x, tuple) else (x,):
                if isinstance(y, Emit) and isinstance(y.value, Const) and out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                    out[-1] = Emit(Const(_written(out[-1].value.value) + _written(y.value.value)))
                else:
                    out.append(y)
        return tuple(out)
    if isinstance(node, Emit):
        return Emit(fold(node.value))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    if isinstance(node, Call):
        args = tuple(map(fold, node.args))
        if node.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
        if node.op in _OPS and all(isinstance(a, Const) for a in args):
            return Const(_OPS[node.op](*(a.value for a in args)))
        return Call(node.op, args)
    return node


def _written(value: object) -> str:
    return "" if value is None else str(value)


# --- closures


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        first, *rest = node.path

        def look(scope: dict) -> object:
            v = scope.get(first)
            for key in rest:
                v = v.get(key) if isinstance(v, dict) else None
            return v

        return look
    args = [_value(a) for a in node.args]
    if node.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    f = _OPS[node.op]
    if node.op in FILTERS:
        return lambda scope: f(_written(args[0](scope)))
    return lambda scope: f(*(a(scope) for a in args))


Render = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def _statement(node) -> Render:
    if isinstance(node, Emit):
        value = _value(node.value)

        def emit(scope: dict, on: bool) -> Iterator[tuple[str, bool]]:
            if text := _written(value(scope)):
                yield text, on

        return emit
    if isinstance(node, Generation):
        inner = _block(node.body)
        return lambda scope, on: inner(scope, True)
    if isinstance(node, If):
        test, then, other = _value(node.test), _block(node.then), _block(node.other)
        return lambda scope, on: (then if test(scope) else other)(scope, on)
    over, body = _value(node.over), _block(node.body)

    def loop(scope: dict, on: bool) -> Iterator[tuple[str, bool]]:
        for k, item in enumerate(over(scope) or ()):
            yield from body(scope | {node.name: item, "loop": {"index": k + 1, "first": k == 0}}, on)

    return loop


def _block(nodes: tuple) -> Render:
    parts = [_statement(n) for n in nodes]

    def run(scope: dict, on: bool) -> Iterator[tuple[str, bool]]:
        for p in parts:
            yield from p(scope, on)

    return run


def compile_template(source: str = TEMPLATE) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """A function from the messages (any iterable, read once) to pieces of text and whether each is generated."""
    run = _block(fold(parse(source)))
    return lambda messages: run({"messages": messages}, False)


# --- reading back

_MARK = re.compile(r"\\.|" + "|".join(map(re.escape, CONTROL)), re.S)


class Reader:
    """Recovers the turns from formatted text that arrives in pieces; a piece never ends inside an escape or control string."""

    def __init__(self):
        self.state, self.role, self.text = CLOSE, [], []

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        at = 0
        for m in _MARK.finditer(piece):
            if m[0][0] == "\\":
                continue
            self._keep(piece[at : m.start()])
            at = m.end()
            self.state = m[0]
            if m[0] == OPEN:
                self.role, self.text = [], []
            elif m[0] == CLOSE:
                yield unescape("".join(self.role)), unescape("".join(self.text))
        self._keep(piece[at:])

    def _keep(self, part: str) -> None:
        if self.state == ROLE:
            self.role.append(part)
        elif self.state == TEXT:
            self.text.append(part)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """piece number, text and loss mask of every conversation: conv_id, piece, text, generated."""

    def run(render, rows):
        for conv, turns in rows:
            for k, (text, on) in enumerate(render(turns)):
                yield conv, k, text, on

    return _streamed(conversations, template, run, [("conv_id", pa.int64()), ("piece", pa.int64()), ("text", pa.string()), ("generated", pa.bool_())])


def digest_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """What the formatted conversations say when read back: one row each."""

    def run(render, rows):
        for conv, turns in rows:
            reader, n, all_turns, n_loss, loss, chars = Reader(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            for piece, on in render(turns):
                chars += len(piece)
                if on:
                    plain = unescape(piece)
                    n_loss += len(plain)
                    loss.update(plain.encode())
                for role, text in reader.feed(piece):
                    n += 1
                    all_turns.update(f"{role}\n{text}\n".encode())
            yield conv, n, all_turns.hexdigest(), n_loss, loss.hexdigest(), chars

    return _streamed(conversations, template, run, [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _streamed(conversations: DataFrame, template: str, run, fields) -> DataFrame:
    """Sort the rows of each conversation together and stream them through the compiled template; no conversation is held whole."""
    schema = pa.schema(fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        grouped = groupby(rows(batches), key=lambda r: r[0])
        out, size = [], 0
        for row in run(render, ((conv, ({"role": r[2] or "", "text": r[3] or ""} for r in own)) for conv, own in grouped)):
            out.append(row)
            size += 100 + sum(len(x) for x in row if isinstance(x, str))
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    kinds = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}
    dealt = turns.repartition(parallelism(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(stream, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))
