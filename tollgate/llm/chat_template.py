"""Chat formatting: a compiler for a small sandboxed template language, and the
streams that render conversations with it and read them back.

Template language::

    {{ expr }}                                   output
    {% for m in messages %} .. {% endfor %}      the conversation's rows, in order, once
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set name = e %}
    {% generation %} .. {% endgeneration %}      output that the loss covers
    {# comment #}

Expressions: string and whole-number literals, ``true``, ``false``, ``none``, variables,
``m.role``, ``m.text``, ``loop.first``, ``loop.last``, ``loop.index``, ``+`` and ``~``,
comparisons, ``and``, ``or``, ``not``, parentheses, and filters (``| upper``) out of a
fixed list.  A template can call nothing, reach no attribute beside those named, and loop
over nothing but the conversation, so its work is bounded by the rows.

``compile_template`` parses the source into a syntax tree, folds constants (operators
and filters of constants, branches of constant conditions, neighbouring texts) and turns
each node into a Python closure.  A rendered template is a generator of
``(text, generated)`` segments that takes the messages one by one, so a conversation of
any length is rendered, and read back, in memory bounded by a row and a part.

Rows are dealt by conversation and sorted by turn.  A conversation's digest runs over
its turns in order, so one task has to *stream* it, however long; no task holds one.

Defined results: a null text or role is an empty one; a null ``conv_id`` is a
conversation like others; rows that tie in ``turn`` are ordered by role, then text (nulls
first), repeated rows are turns each.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import byte_slices, ship_package, worker_turn

# ---------------------------------------------------------------------------
# The marks of the instruction format and its template
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]")
INSTRUCT = """{{ '<s>' }}
{%- for m in messages -%}
{%- if m.role == 'user' -%}
[INST] {{ m.text | guard }} [/INST]
{%- elif m.role == 'assistant' -%}
{{ ' ' }}{% generation %}{{ m.text | guard }}{% endgeneration %}</s>
{%- else -%}
[ROLE]{{ m.role | guard }}[TEXT]{{ m.text | guard }}[/ROLE]
{%- endif -%}
{%- endfor -%}"""
# ---------------------------------------------------------------------------

_GUARDED = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_MARKED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))


def guard(text: str) -> str:
    """No control string is left: a backslash goes behind the first character of each,
    and one more where there are some already.  Other text is as it was."""
    if "<" not in text and "[" not in text:
        return text
    return _GUARDED.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unguard(text: str) -> str:
    if "\\" not in text:
        return text
    return _MARKED.sub(lambda m: m[0][0] + m[0][2:], text)


FILTERS: dict[str, Callable[[str], str]] = {
    "guard": guard,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
    "length": len,
}
FIELDS = {"loop": ("first", "last", "index"), "message": ("role", "text")}


class TemplateError(ValueError):
    """The template is not one of the language."""


# -- syntax tree ---------------------------------------------------------------
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: str
    name: str


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Assign:
    name: str
    value: object


@dataclass(frozen=True)
class Branch:
    cases: tuple  # of (condition, body)


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# -- parser --------------------------------------------------------------------
_PART = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#-?.*?-?#\})", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<op>==|!=|<=|>=|[<>+~().|=])|(?P<bad>\S))""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_KEYWORDS = {"and", "or", "not", "in", "if", "for", *_WORDS}
COMPARE = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
}


def _tokens(source: str) -> list[tuple[str, str]]:
    out = []
    for m in _TOKEN.finditer(source):
        if m.lastgroup == "bad":
            raise TemplateError(f"unexpected {m['bad']!r} in {source!r}")
        if m.lastgroup:
            out.append((m.lastgroup, m[m.lastgroup]))
    return out


class _Expression:
    """Recursive descent over one expression: or, and, not, comparison, sum, filter."""

    def __init__(self, source: str, names: dict[str, str]):
        self.source, self.names = source, names
        self.left = _tokens(source)

    def take(self, *wanted: str) -> str | None:
        if self.left and self.left[0][0] in ("op", "name") and self.left[0][1] in wanted:
            return self.left.pop(0)[1]
        return None

    def whole(self):
        node = self.any_of()
        if self.left:
            raise TemplateError(f"unexpected {self.left[0][1]!r} in {self.source!r}")
        return node

    def any_of(self):
        node = self.all_of()
        while self.take("or"):
            node = Op("or", (node, self.all_of()))
        return node

    def all_of(self):
        node = self.negated()
        while self.take("and"):
            node = Op("and", (node, self.negated()))
        return node

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        node = self.added()
        while sign := self.take(*COMPARE):
            node = Op(sign, (node, self.added()))
        return node

    def added(self):
        node = self.filtered()
        while sign := self.take("+", "~"):
            node = Op(sign, (node, self.filtered()))
        return node

    def filtered(self):
        node = self.atom()
        while self.take("|"):
            kind, name = self.left.pop(0) if self.left else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = Op(f"|{name}", (node,))
        return node

    def atom(self):
        if not self.left:
            raise TemplateError(f"{self.source!r} ends too soon")
        kind, word = self.left.pop(0)
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(word))
        if kind == "op" and word == "(":
            node = self.any_of()
            if not self.take(")"):
                raise TemplateError(f"a parenthesis is open in {self.source!r}")
            return node
        if kind != "name":
            raise TemplateError(f"unexpected {word!r} in {self.source!r}")
        if word in _WORDS:
            return Const(_WORDS[word])
        what = self.names.get(word)
        if what is None or word in _KEYWORDS:
            raise TemplateError(f"no variable {word!r}")
        if what == "value":
            return Name(word)
        name = self.left.pop(0)[1] if self.take(".") and self.left else None
        if name not in FIELDS[what]:
            raise TemplateError(f"{word} has {', '.join(FIELDS[what])}, not {name!r}")
        return Field(word, name)


@dataclass
class _Parser:
    """Statements, nested by recursion on the list of parts."""

    parts: list[tuple[str, str]]  # (text | output | tag, source)
    names: dict[str, str] = field(default_factory=dict)
    looped: bool = False

    def body(self, *ends: str) -> tuple[tuple, str]:
        """Nodes up to a tag out of ``ends``, and that tag."""
        nodes = []
        while self.parts:
            kind, source = self.parts.pop(0)
            if kind == "text":
                nodes.append(Output(Const(source)))
            elif kind == "output":
                nodes.append(Output(_Expression(source, self.names).whole()))
            else:
                word, _, rest = source.partition(" ")
                if word in ends:
                    return tuple(nodes), source
                nodes.append(self.statement(word, rest.strip()))
        if ends:
            raise TemplateError(f"no {' or '.join(ends)}")
        return tuple(nodes), ""

    def statement(self, word: str, rest: str):
        if word == "set":
            name, sign, value = rest.partition("=")
            node = Assign(name.strip(), _Expression(value, self.names).whole())
            if not sign or not node.name.isidentifier() or self.names.get(node.name, "value") != "value":
                raise TemplateError(f"cannot set {rest!r}")
            self.names[node.name] = "value"
            return node
        if word == "if":
            cases, test = [], _Expression(rest, self.names).whole()
            while True:
                body, end = self.body("elif", "else", "endif")
                cases.append((test, body))
                if end == "endif":
                    return Branch(tuple(cases))
                if end == "else":
                    cases.append((Const(True), self.body("endif")[0]))
                    return Branch(tuple(cases))
                test = _Expression(end.partition(" ")[2], self.names).whole()
        if word == "for":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest)
            if not found or self.looped or found[1] in self.names:
                raise TemplateError("there is one loop, over the messages: they are taken once")
            self.looped = True
            outer, self.names = self.names, {**self.names, found[1]: "message", "loop": "loop"}
            node = Loop(found[1], self.body("endfor")[0])
            self.names = outer
            return node
        if word == "generation" and not rest:
            return Generation(self.body("endgeneration")[0])
        raise TemplateError(f"unknown tag {word!r}")


def parse(source: str) -> tuple:
    """The syntax tree: a tuple of statements.  ``-`` at a tag's edge drops the
    white space beside it."""
    pieces = _PART.split(source)
    parts = []
    for i, piece in enumerate(pieces):
        if i % 2 == 0:
            if i and pieces[i - 1][-3] == "-":
                piece = piece.lstrip()
            if i + 1 < len(pieces) and pieces[i + 1][2] == "-":
                piece = piece.rstrip()
            if piece:
                parts.append(("text", piece))
        elif piece[1] != "#":
            parts.append(("output" if piece[1] == "{" else "tag", piece[2:-2].strip("-").strip()))
    return _Parser(parts).body()[0]


# -- constants -------------------------------------------------------------------
def _apply(name: str, *values):
    if name == "not":
        return not values[0]
    if name in COMPARE:
        return COMPARE[name](*values)
    if name == "+":
        return values[0] + values[1]
    if name == "~":
        return "".join(map(_shown, values))
    return FILTERS[name[1:]](values[0])


def _shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def fold_expression(node):
    if not isinstance(node, Op):
        return node
    args = tuple(map(fold_expression, node.args))
    first = args[0]
    if node.name in ("and", "or") and isinstance(first, Const):
        return args[1] if bool(first.value) == (node.name == "and") else first
    if all(isinstance(a, Const) for a in args) and node.name not in ("and", "or"):
        return Const(_apply(node.name, *[a.value for a in args]))
    return Op(node.name, args)


def fold(nodes: tuple) -> tuple:
    """The same template with constant expressions worked out, branches that can't be
    taken left out, and neighbouring constant texts joined."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Output) and isinstance(node.value, Const):
            node = Output(Const(_shown(node.value.value)))
            if not node.value.value:
                return
            if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                node = Output(Const(out.pop().value.value + node.value.value))
        out.append(node)

    for node in nodes:
        if isinstance(node, Output):
            add(Output(fold_expression(node.value)))
        elif isinstance(node, Assign):
            add(Assign(node.name, fold_expression(node.value)))
        elif isinstance(node, Loop):
            add(Loop(node.name, fold(node.body)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body)))
        else:
            cases = []
            for test, body in node.cases:
                test = fold_expression(test)
                if isinstance(test, Const) and not test.value:
                    continue
                cases.append((test, fold(body)))
                if isinstance(test, Const):
                    break
            if cases and isinstance(cases[0][0], Const):
                for inner in cases[0][1]:
                    add(inner)
            elif cases:
                add(Branch(tuple(cases)))
    return tuple(out)


# -- closures ---------------------------------------------------------------------
def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Field):
        of, name = node.of, node.name
        return lambda scope: scope[of][name]
    args = tuple(map(_value, node.args))
    first = args[0]
    if node.name == "and":
        return lambda scope: first(scope) and args[1](scope)
    if node.name == "or":
        return lambda scope: first(scope) or args[1](scope)
    if len(args) == 1:
        one = (lambda v: not v) if node.name == "not" else FILTERS[node.name[1:]]
        return lambda scope: one(first(scope))
    if node.name in COMPARE:
        two = COMPARE[node.name]
    else:
        two = operator.add if node.name == "+" else lambda a, b: _shown(a) + _shown(b)
    second = args[1]
    return lambda scope: two(first(scope), second(scope))


Segments = Iterator[tuple[str, bool]]


def _sequence(nodes: tuple, generated: bool = False) -> Callable[[dict], Segments]:
    steps = [_statement(n, generated) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(scope):
        for step in steps:
            yield from step(scope)

    return run


def _statement(node, generated: bool) -> Callable[[dict], Segments]:
    if isinstance(node, Output):
        value = _value(node.value)

        def run(scope):
            yield _shown(value(scope)), generated

    elif isinstance(node, Assign):
        name, value = node.name, _value(node.value)

        def run(scope):
            scope[name] = value(scope)
            return iter(())

    elif isinstance(node, Branch):
        cases = [(_value(test), _sequence(body, generated)) for test, body in node.cases]

        def run(scope):
            for test, body in cases:
                if test(scope):
                    return body(scope)
            return iter(())

    elif isinstance(node, Loop):
        name, body = node.name, _sequence(node.body, generated)

        def run(scope):
            rows = iter(scope["messages"])
            ahead = next(rows, None)
            index = 0
            while ahead is not None:
                message, ahead = ahead, next(rows, None)
                index += 1
                scope[name] = message
                scope["loop"] = {"first": index == 1, "last": ahead is None, "index": index}
                yield from body(scope)

    else:
        return _sequence(node.body, True)
    return run


def compile_template(source: str) -> Callable[[Iterable[dict]], Segments]:
    """A renderer: messages (dicts of ``role`` and ``text``), taken one by one, to
    ``(text, generated)`` segments."""
    run = _sequence(fold(parse(source)))
    return lambda messages: run({"messages": messages})


# -- conversations -----------------------------------------------------------------
PART_CHARS = 1 << 16
PARTS = "part long, formatted string, loss array<struct<start: int, end: int>>"
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _python_rows(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple]:
    for batch in batches:
        for some in byte_slices(batch, text):
            yield from zip(*[c.to_pylist() for c in some.columns])


def _parts(segments: Segments, size: int) -> Iterator[tuple[str, list]]:
    """Segments joined to parts of at least ``size`` characters (the last may be
    shorter), never cut within a segment or a run of generated ones."""
    texts: list[str] = []
    loss: list[dict] = []
    chars, open_, first = 0, False, True
    for text, generated in segments:
        if chars >= size and not (open_ and generated):
            yield "".join(texts), loss
            texts, loss, chars, open_, first = [], [], 0, False, False
        if generated:
            if open_:
                loss[-1]["end"] += len(text)
            else:
                loss.append({"start": chars, "end": chars + len(text)})
        open_ = generated
        texts.append(text)
        chars += len(text)
    if texts or first:
        yield "".join(texts), loss


def format_conversations(rows: DataFrame, template: str = INSTRUCT, part_chars: int = PART_CHARS) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` to the parts of each conversation's text:
    ``conv_id, part, formatted, loss``, with the loss mask as spans of code points in the
    part.  A conversation's parts follow one another in one partition."""
    ship_package(rows.sparkSession)
    compile_template(template)  # a wrong template fails here

    def run(batches):
        worker_turn(__name__)
        render = compile_template(template)
        ready: list[tuple] = []
        size = 0
        rows = _python_rows(batches, "text")
        for conv_id, group in itertools.groupby(rows, key=lambda r: r[0]):
            messages = ({"role": r[1] or "", "text": r[2] or ""} for r in group)
            for part, (text, loss) in enumerate(_parts(render(messages), part_chars)):
                ready.append((conv_id, part, text, loss))
                size += len(text)
                if size > 16 * part_chars:
                    yield packed(ready)
                    ready, size = [], 0
        if ready:
            yield packed(ready)

    def packed(rows):
        ids, parts, texts, loss = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(parts, pa.int64()), pa.array(texts, pa.string()), pa.array(loss, _LOSS)],
            names=["conv_id", "part", "formatted", "loss"],
        )

    dealt = (
        rows.select(F.col("conv_id").cast("long").alias("conv_id"), "role", "text", "turn")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return dealt.select("conv_id", "role", "text").mapInArrow(run, f"conv_id long, {PARTS}")


def read_turns(pieces: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a conversation written with ``INSTRUCT``, from its
    text in pieces.  Holds a turn and a piece at most."""
    buffer, started = "", False
    for piece in pieces:
        buffer += piece
        if not started:
            if not buffer.startswith("<s>"):
                raise ValueError("not a formatted conversation")
            buffer, started = buffer[3:], True
        at = 0
        while (turn := _turn_at(buffer, at)) is not None:
            role, text, at = turn
            yield unguard(role), unguard(text)
        buffer = buffer[at:]
    if buffer:
        raise ValueError("a turn without an end")


def _turn_at(buffer: str, at: int) -> tuple[str, str, int] | None:
    """Role, guarded text and end of the turn that begins at ``at``, if it is whole."""
    if buffer.startswith("[INST] ", at):
        end = buffer.find(" [/INST]", at + 7)
        return None if end < 0 else ("user", buffer[at + 7 : end], end + 8)
    if buffer.startswith("[ROLE]", at):
        end = buffer.find("[/ROLE]", at)
        if end < 0:
            return None
        role, _, text = buffer[at + 6 : end].partition("[TEXT]")
        return role, text, end + 7
    if buffer.startswith(" ", at):
        end = buffer.find("</s>", at)
        return None if end < 0 else ("assistant", buffer[at + 1 : end], end + 4)
    return None


def read_back(parts: DataFrame, in_order: bool = False) -> DataFrame:
    """Parts of conversations written with ``INSTRUCT`` to ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``: turns as read from the text
    (role, line feed, text, line feed), and all text under the loss mask, unguarded.
    ``in_order`` says that the parts are as ``format_conversations`` gave them;
    otherwise (a stored table) they are dealt and sorted again."""
    if not in_order:
        parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def conversation(conv_id, group):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        count = [0, 0, 0]  # turns, characters under the mask, characters

        def pieces():
            for _, text, spans in group:
                count[2] += len(text)
                for span in spans:
                    covered = unguard(text[span["start"] : span["end"]])
                    count[1] += len(covered)
                    loss.update(covered.encode())
                yield text

        for role, text in read_turns(pieces()):
            count[0] += 1
            turns.update(f"{role}\n{text}\n".encode())
        return conv_id, count[0], turns.hexdigest(), count[1], loss.hexdigest(), count[2]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        worker_turn(__name__)
        ready = []
        for conv_id, group in itertools.groupby(_python_rows(batches, "formatted"), key=lambda r: r[0]):
            ready.append(conversation(conv_id, group))
            if len(ready) == 4096:
                yield packed(ready)
                ready = []
        if ready:
            yield packed(ready)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return parts.select("conv_id", "formatted", "loss").mapInArrow(run, schema)
