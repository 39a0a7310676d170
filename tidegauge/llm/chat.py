"""Chat formatting with compiled templates.

A template is text with ``{{ expression }}``, ``{% if test %} … {% elif test %} … {% else %} … {% endif %}``,
``{% for message in messages %} … {% endfor %}`` and ``{% generation %} … {% endgeneration %}``; the last marks what a
model learns to write. Expressions know the names ``message``, ``loop`` (index, index0, first, last) and the parameters,
attributes ``role``, ``content`` and ``turn`` of a message, literals, ``+ == != and or not ( )`` and the filters ``upper``,
``lower``, ``trim`` and ``escape``. Nothing else can be reached: there are no calls, no other attributes, no imports.

Compiling parses a template into a syntax tree, folds constant expressions, tests and neighbouring texts, and makes one
Python closure for each node. Messages are rendered one after the other, so a conversation of any length needs no more
memory than a message; ``loop.last`` looks one message ahead.

``escape`` puts a backslash before every backslash and before the first character of every control string in a text, so
no text can look like markup; ``unescape`` takes it back.

Defined cases: null text and null role are empty; rows of a conversation come in order of turn (null first), then role,
then text; equal rows are separate turns; a null conv_id is a conversation; texts of any length and with any run of
backslashes take time in proportion to their length; other columns, whatever their names, are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import ast
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved, bounded_batches

TEMPLATE = (
    "{% for message in messages %}<turn>### {{ message.role | escape }}: "
    "{% if message.role == 'assistant' %}{% generation %}{{ message.content | escape }}{% endgeneration %}"
    "{% else %}{{ message.content | escape }}{% endif %}</turn>\n{% endfor %}"
)
CONTROL = ("<turn>", "</turn>", "### ", ": ")


def escape(text: str, control: tuple[str, ...] = CONTROL) -> str:
    return _escaper(control).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


@lru_cache
def _escaper(control: tuple[str, ...]) -> re.Pattern:
    """A backslash, or the first character of a control string that starts here."""
    return re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in control)]))


class TemplateError(ValueError):
    pass


_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+|().]))""")
_WORDS = {"true": True, "false": False, "none": None}
_FIELDS = {"message": ("role", "content", "turn"), "loop": ("index", "index0", "first", "last")}
_FILTERS = ("upper", "lower", "trim", "escape")

# Nodes: ("const", value) ("name", n) ("field", n, f) ("not", x) ("bin", op, x, y) ("filter", f, x)
# ("text", s) ("out", x) ("if", [(test, body)], other) ("for", body) ("generation", body) ("seq", nodes)


class _Expression:
    """Recursive descent: or, and, not, comparison, sum, filter, value."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.tokens.append(("end", ""))
        self.k = 0

    def peek(self, *values: str) -> bool:
        kind, value = self.tokens[self.k]
        return kind != "string" and value in values

    def next(self) -> tuple[str, str]:
        self.k += 1
        return self.tokens[self.k - 1]

    def whole(self):
        out = self.either()
        if self.tokens[self.k][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[self.k][1]!r}")
        return out

    def _chain(self, ops: tuple[str, ...], below: Callable):
        out = below()
        while self.peek(*ops):
            op = self.next()[1]
            out = ("bin", op, out, below())
        return out

    def either(self):
        return self._chain(("or",), self.both)

    def both(self):
        return self._chain(("and",), self.negation)

    def negation(self):
        if self.peek("not"):
            self.next()
            return ("not", self.negation())
        return self.comparison()

    def comparison(self):
        return self._chain(("==", "!="), self.sum)

    def sum(self):
        return self._chain(("+",), self.filtered)

    def filtered(self):
        out = self.value()
        while self.peek("|"):
            self.next()
            name = self.next()[1]
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = ("filter", name, out)
        return out

    def value(self):
        kind, value = self.next()
        if kind == "string":
            return ("const", ast.literal_eval(value))
        if kind == "number":
            return ("const", int(value))
        if value == "(":
            out = self.either()
            if self.next()[1] != ")":
                raise TemplateError("a bracket isn't closed")
            return out
        if kind != "name" or value in ("or", "and", "not"):
            raise TemplateError(f"unexpected {value!r}")
        if value in _WORDS:
            return ("const", _WORDS[value])
        if value in _FIELDS:
            if not self.peek("."):
                raise TemplateError(f"{value} needs a field")
            self.next()
            field = self.next()[1]
            if field not in _FIELDS[value]:
                raise TemplateError(f"{value} has no field {field!r}")
            return ("field", value, field)
        if self.peek("."):
            raise TemplateError(f"{value} has no fields")
        return ("name", value)


def parse(source: str):
    """The syntax tree of a template."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def body(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes = []
        while at < len(pieces):
            p = pieces[at]
            at += 1
            if p.startswith("{{"):
                nodes.append(("out", _Expression(p[2:-2]).whole()))
            elif p.startswith("{%"):
                tag = p[2:-2].strip()
                word = tag.split(None, 1)[0] if tag else ""
                if word in ends:
                    return ("seq", nodes), tag
                nodes.append(block(word, tag))
            elif p:
                nodes.append(("text", p))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return ("seq", nodes), ""

    def block(word: str, tag: str):
        if word == "generation" and tag == word:
            return ("generation", body("endgeneration")[0])
        if word == "for":
            if tag.split() != ["for", "message", "in", "messages"]:
                raise TemplateError("the only loop is: for message in messages")
            return ("for", body("endfor")[0])
        if word == "if":
            cases, end = [], tag
            while True:
                test = _Expression(end.split(None, 1)[1] if " " in end else "").whole()
                inner, end = body("elif", "else", "endif")
                cases.append((test, inner))
                if not end.startswith("elif"):
                    break
            return ("if", cases, body("endif")[0] if end == "else" else ("seq", []))
        raise TemplateError(f"no tag {tag!r}")

    return body()[0]


def fold(node, control: tuple[str, ...] = CONTROL):
    """The tree with constant parts computed and neighbouring texts joined."""
    kind = node[0]
    if kind in ("not", "bin", "filter"):
        parts = tuple(fold(x, control) if isinstance(x, tuple) else x for x in node[1:])
        out = (kind, *parts)
        if all(x[0] == "const" for x in parts if isinstance(x, tuple)):
            return ("const", _expression(out, control)(None))
        return out
    if kind == "out":
        x = fold(node[1], control)
        return ("text", _text(x[1])) if x[0] == "const" else ("out", x)
    if kind in ("for", "generation"):
        return (kind, fold(node[1], control))
    if kind == "if":
        cases = []
        for test, inner in node[1]:
            test = fold(test, control)
            if test[0] == "const" and not test[1]:
                continue
            if test[0] == "const":
                return ("if", cases, fold(inner, control)) if cases else fold(inner, control)
            cases.append((test, fold(inner, control)))
        return ("if", cases, fold(node[2], control)) if cases else fold(node[2], control)
    if kind == "seq":
        out: list = []
        for x in node[1]:
            x = fold(x, control)
            for y in x[1] if x[0] == "seq" else [x]:
                if y[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + y[1])
                elif y != ("text", ""):
                    out.append(y)
        return ("seq", out)
    return node


def _text(x) -> str:
    return "" if x is None else str(x)


def _expression(node, control: tuple[str, ...]) -> Callable:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda s: value
    if kind == "name":
        name = node[1]
        return lambda s: s.parameters.get(name)
    if kind == "field":
        if node[1] == "message":
            k = ("role", "content", "turn").index(node[2])
            return lambda s: s.message[k]
        k = ("index", "index0", "first", "last").index(node[2])
        return lambda s: (s.index + 1, s.index, s.index == 0, s.last)[k]
    if kind == "not":
        x = _expression(node[1], control)
        return lambda s: not x(s)
    if kind == "filter":
        x = _expression(node[2], control)
        f = {"upper": str.upper, "lower": str.lower, "trim": str.strip, "escape": partial(escape, control=control)}[node[1]]
        return lambda s: f(_text(x(s)))
    op, x, y = node[1], _expression(node[2], control), _expression(node[3], control)
    if op == "and":
        return lambda s: x(s) and y(s)
    if op == "or":
        return lambda s: x(s) or y(s)
    if op == "==":
        return lambda s: x(s) == y(s)
    if op == "!=":
        return lambda s: x(s) != y(s)
    return lambda s: _text(x(s)) + _text(y(s))


class _State:
    __slots__ = ("index", "last", "learned", "message", "messages", "parameters")


def _closure(node, control: tuple[str, ...]) -> Callable[[_State], Iterator[tuple[str, bool]]]:
    kind = node[0]
    if kind == "text":
        text = node[1]

        def run(s):
            yield text, s.learned
    elif kind == "out":
        x = _expression(node[1], control)

        def run(s):
            yield _text(x(s)), s.learned
    elif kind == "generation":
        inner = _closure(node[1], control)

        def run(s):
            before, s.learned = s.learned, True
            yield from inner(s)
            s.learned = before
    elif kind == "if":
        cases = [(_expression(t, control), _closure(b, control)) for t, b in node[1]]
        other = _closure(node[2], control)

        def run(s):
            for test, inner in cases:
                if test(s):
                    yield from inner(s)
                    return
            yield from other(s)
    elif kind == "for":
        inner = _closure(node[1], control)

        def run(s):
            it, s.index = iter(s.messages), -1
            ahead = next(it, None)
            while ahead is not None:
                s.message, ahead = ahead, next(it, None)
                s.index, s.last = s.index + 1, ahead is None
                yield from inner(s)
    else:
        parts = [_closure(x, control) for x in node[1]]

        def run(s):
            for p in parts:
                yield from p(s)
    return run


class Template:
    def __init__(self, source: str = TEMPLATE, control: tuple[str, ...] = CONTROL):
        self.source, self.control = source, control
        self.tree = fold(parse(source), control)
        self._run = _closure(self.tree, control)

    def __reduce__(self):
        return Template, (self.source, self.control)

    def pieces(self, messages, **parameters) -> Iterator[tuple[str, bool]]:
        """``(text, under the loss mask)`` in order; messages are ``(role, content, turn)``."""
        s = _State()
        s.messages, s.parameters, s.learned, s.index, s.last, s.message = messages, parameters, False, -1, False, (None, None, None)
        yield from self._run(s)

    def render(self, messages, **parameters) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and the spans under the loss mask."""
        out, spans, n = [], [], 0
        for text, learned in self.pieces(messages, **parameters):
            if learned and text:
                if spans and spans[-1][1] == n:
                    spans[-1] = (spans[-1][0], n + len(text))
                else:
                    spans.append((n, n + len(text)))
            out.append(text)
            n += len(text)
        return "".join(out), spans


_START, _END = "<turn>### ", "</turn>\n"


def _plain(text: str, control: str, at: int, low: int = 0) -> int:
    """Where ``control`` stands first from ``at`` on without an odd number of backslashes before it, or -1.

    Each run of backslashes is counted once, so this is linear whatever the text holds.
    """
    while (at := text.find(control, at)) >= 0:
        k = at
        while k > low and text[k - 1] == "\\":
            k -= 1
        if (at - k) % 2 == 0:
            return at
        at += 1
    return -1


class Turns:
    """Reads turns back from pieces of a text that ``TEMPLATE`` rendered; it keeps no more than the turn at hand."""

    def __init__(self):
        self.held, self.seen = "", 0

    def add(self, text: str) -> Iterator[tuple[str, str]]:
        self.held += text
        start = 0
        while (end := _plain(self.held, _END, max(start, self.seen), start)) >= 0:
            colon = _plain(self.held, ": ", start + len(_START), start)
            if not self.held.startswith(_START, start) or not 0 <= colon < end:
                raise ValueError(f"not a turn: {self.held[start : start + 40]!r}")
            yield unescape(self.held[start + len(_START) : colon]), unescape(self.held[colon + 2 : end])
            start = end + len(_END)
        self.held = self.held[start:]
        self.seen = max(0, len(self.held) - len(_END) + 1)


def parse_back(text: str) -> list[tuple[str, str]]:
    """The turns of a text that ``TEMPLATE`` rendered."""
    turns = Turns()
    out = list(turns.add(text))
    if turns.held:
        raise ValueError(f"not a turn: {turns.held[:40]!r}")
    return out


def _ordered(conversations: DataFrame) -> DataFrame:
    """Each conversation's rows in one partition, in order; a long one streams through its task, batch by batch."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _by_conversation(batches) -> Iterator[tuple[int | None, Iterator]]:
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, group in groupby(rows, key=lambda r: r[0]):
        yield key, ((role or "", text or "", turn) for _, turn, role, text in group)


def _format(batches, template: Template):
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("text", pa.string()), ("learned", pa.bool_())])
    out: list = []
    for key, messages in _by_conversation(batches):
        held, mask, n = [], False, 0
        for text, learned in template.pieces(messages):
            if learned != mask and held or len(held) >= 4096:
                out.append((key, n, "".join(held), mask))
                n, held = n + 1, []
            mask = learned
            held.append(text)
        if held:
            out.append((key, n, "".join(held), mask))
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``(conv_id, seq, text, learned)``: the formatted text of each conversation in pieces, cut where the mask changes."""
    bounded_batches(conversations.sparkSession)
    return _ordered(conversations).mapInArrow(partial(_format, template=Template(template)), "conv_id long, seq long, text string, learned boolean")


class _Digest:
    """What is read back from one conversation's formatted pieces, without keeping them."""

    def __init__(self):
        self.turns, self.loss, self.reader = hashlib.sha256(), hashlib.sha256(), Turns()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, learned: bool) -> None:
        self.chars += len(text)
        if learned:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        for role, content in self.reader.add(text):
            self.turns.update(f"{role}\n{content}\n".encode())
            self.n_turns += 1


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches):
    names = [x.split()[0] for x in _DIGEST.split(", ")]
    out: list = []
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, pieces in groupby(rows, key=lambda r: r[0]):
        d = _Digest()
        for _, _, text, learned in pieces:
            d.add(text, learned)
        if d.reader.held:
            raise ValueError(f"conversation {key} doesn't end with a turn")
        out.append((key, d.n_turns, d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars))
        if len(out) >= 1000:
            yield _batch(out, names)
            out = []
    if out:
        yield _batch(out, names)


def _batch(rows: list, names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def digests(conversations: DataFrame) -> DataFrame:
    """Formats with ``TEMPLATE``, writes the pieces, reads turns and loss mask back from what was written, and digests them.

    A digest needs its conversation in order, so one task reads it; it streams through, a turn at a time.
    """
    pieces = Saved(format_conversations(conversations), "formatted").df
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_digest, _DIGEST)
