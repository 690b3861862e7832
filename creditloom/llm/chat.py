"""Chat formatting with a compiled template.

A template of text, ``{{ expression }}``, ``{% if %}``/``{% elif %}``/``{% else %}``, ``{% for x in xs %}`` and
``{% generation %}`` blocks is parsed into a tree, constants are folded, and the tree becomes nested Python closures.
Expressions know literals, names, keys of mappings (``m.role``), ``+ == != in and or not`` and the filters below; there are
no calls and no attributes of Python objects, so a template can reach nothing but the values it is given.

Conversations stream through: one turn at a time is rendered, so memory does not depend on the number of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Every control string begins with "<|". In texts a backslash is doubled and "<|" becomes "<\|", so none can occur there.
TEMPLATE = ("{% for m in messages %}<|turn|>{{ m.role | escape }}<|text|>"
            "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
            "{% else %}{{ m.text | escape }}{% endif %}<|end|>{% endfor %}")
_TURN, _TEXT, _END = "<|turn|>", "<|text|>", "<|end|>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


FILTERS: dict[str, Callable] = {"escape": escape, "trim": str.strip, "lower": str.lower, "upper": str.upper,
                                "length": len}


class TemplateError(ValueError):
    pass


# --- tree -----------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Constant:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    name: str


@dataclass(frozen=True)
class Apply:
    """Operator or filter ``name`` on ``args``."""
    name: str
    args: tuple


@dataclass(frozen=True)
class Print:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: a + b if isinstance(a, type(b)) else f"{a}{b}", "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b, "in": lambda a, b: a in b, "not": lambda a: not a}
_LEXEMES = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+.|()]))")
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.items, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _LEXEMES.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            kind = m.lastindex
            self.items.append((kind, m[kind]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.items[self.at][1] if self.at < len(self.items) and self.items[self.at][0] > 2 else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.items[self.at - 1][1]
        return None

    def whole(self):
        tree = self.either()
        if self.at != len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")
        return tree

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Apply("or", (left, self.both()))
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Apply("and", (left, self.negated()))
        return left

    def negated(self):
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        left = self.added()
        while sign := self.take("==", "!=", "in"):
            left = Apply(sign, (left, self.added()))
        return left

    def added(self):
        left = self.filtered()
        while self.take("+"):
            left = Apply("+", (left, self.filtered()))
        return left

    def filtered(self):
        value = self.atom()
        while sign := self.take(".", "|"):
            name = self.name()
            if sign == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Apply(name, (value,)) if sign == "|" else Key(value, name)
        return value

    def name(self) -> str:
        if self.at >= len(self.items) or self.items[self.at][0] != 3:
            raise TemplateError("a name is missing")
        self.at += 1
        return self.items[self.at - 1][1]

    def atom(self):
        if self.at >= len(self.items):
            raise TemplateError("the expression ends too early")
        if self.take("("):
            inside = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return inside
        kind, word = self.items[self.at]
        self.at += 1
        if kind == 1:
            return Constant(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        if kind == 2:
            return Constant(int(word))
        if kind == 3:
            return {"true": Constant(True), "false": Constant(False), "none": Constant(None)}.get(word) or Name(word)
        raise TemplateError(f"unexpected {word!r}")


def parse(source: str) -> tuple:
    """Tree of a template."""
    parts = re.split(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        out = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                out.append(Print(_Expression(part[2:-2]).whole()))
            elif part.startswith("{%"):
                words = part[2:-2].strip()
                head, _, rest = words.partition(" ")
                if head in ends:
                    return tuple(out), words
                out.append(statement(head, rest))
            elif part and not part.startswith("{#"):
                out.append(Print(Constant(part)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(out), ""

    def statement(head: str, rest: str):
        if head == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, flags=re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            return For(m[1], _Expression(m[2]).whole(), block("endfor")[0])
        if head == "generation":
            return Generation(block("endgeneration")[0])
        if head == "if":
            yes, stop = block("elif", "else", "endif")
            if stop.startswith("elif"):
                no = (statement("if", stop[4:]),)
            else:
                no = block("endif")[0] if stop == "else" else ()
            return If(_Expression(rest).whole(), yes, no)
        raise TemplateError(f"no statement {head!r}")

    return block()[0]


def fold(node):
    """The same tree with constant expressions worked out, dead branches gone and neighbouring text joined."""
    if isinstance(node, tuple):
        out = []
        for part in (x for n in node for x in _spread(fold(n))):
            if (out and isinstance(part, Print) and isinstance(part.value, Constant)
                    and isinstance(out[-1], Print) and isinstance(out[-1].value, Constant)):
                out[-1] = Print(Constant(_shown(out[-1].value.value) + _shown(part.value.value)))
            else:
                out.append(part)
        return tuple(out)
    if isinstance(node, Apply):
        args = tuple(fold(a) for a in node.args)
        if node.name in ("and", "or") and isinstance(args[0], Constant):
            return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
        if node.name not in ("and", "or") and all(isinstance(a, Constant) for a in args):
            return Constant((_OPERATORS.get(node.name) or FILTERS[node.name])(*(a.value for a in args)))
        return Apply(node.name, args)
    if isinstance(node, Key):
        return Key(fold(node.of), node.name)
    if isinstance(node, Print):
        return Print(fold(node.value))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Constant):
            return fold(node.yes if test.value else node.no)
        return If(test, fold(node.yes), fold(node.no))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


def _spread(node) -> tuple:
    return node if isinstance(node, tuple) else (node,)


def _shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# --- closures -------------------------------------------------------------------------------------------------------

@dataclass
class Part:
    """A stretch of output and its spans (start, end) under the loss mask."""
    text: str = ""
    loss: list[tuple[int, int]] = field(default_factory=list)


class _Sink:
    def __init__(self):
        self.pieces, self.size, self.loss = [], 0, []

    def put(self, text: str) -> None:
        self.pieces.append(text)
        self.size += len(text)

    def part(self) -> Part:
        out = Part("".join(self.pieces), self.loss)
        self.__init__()
        return out


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Constant):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name

        def look(scope):
            if name not in scope:
                raise TemplateError(f"no value {name!r}")
            return scope[name]
        return look
    if isinstance(node, Key):
        of, key = _value(node.of), node.name

        def pick(scope):
            owner = of(scope)
            if not isinstance(owner, dict):
                raise TemplateError(f"{key!r} is asked of something without keys")
            return owner.get(key)
        return pick
    parts = [_value(a) for a in node.args]
    if node.name == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if node.name == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    if node.name in FILTERS:
        run = FILTERS[node.name]
        return lambda scope: run(_shown(parts[0](scope)))
    run = _OPERATORS[node.name]
    return lambda scope: run(*(p(scope) for p in parts))


def _steps(nodes: tuple, outermost: bool) -> Callable[[dict, _Sink], Iterator[Part]]:
    """Closure that writes into the sink and gives a part out after each round of an outermost loop."""
    steps = [_step(n, outermost) for n in nodes]

    def run(scope, sink):
        for step in steps:
            yield from step(scope, sink) or ()
    return run


def _step(node, outermost: bool):
    if isinstance(node, Print):
        if isinstance(node.value, Constant):
            text = _shown(node.value.value)
            return lambda scope, sink: sink.put(text)
        value = _value(node.value)
        return lambda scope, sink: sink.put(_shown(value(scope)))
    if isinstance(node, If):
        test, yes, no = _value(node.test), _steps(node.yes, outermost), _steps(node.no, outermost)
        return lambda scope, sink: (yes if test(scope) else no)(scope, sink)
    if isinstance(node, Generation):
        body = _steps(node.body, False)

        def marked(scope, sink):
            start = sink.size
            for _ in body(scope, sink):
                pass
            sink.loss.append((start, sink.size))
        return marked
    over, body, name = _value(node.over), _steps(node.body, False), node.name

    def loop(scope, sink):
        rows = iter(over(scope))
        following = next(rows, None)
        index = 0
        while following is not None:
            current, following = following, next(rows, None)
            inner = {**scope, name: current, "loop": {"index": index + 1, "index0": index, "first": index == 0,
                                                      "last": following is None}}
            for _ in body(inner, sink):
                pass
            if outermost:
                yield sink.part()
            index += 1
    if outermost:
        return loop

    def drained(scope, sink):
        for _ in loop(scope, sink):
            pass
    return drained


class Template:
    """A compiled template; ``stream`` renders with any iterable of messages, one part per round of an outer loop."""

    def __init__(self, source: str = TEMPLATE):
        self.tree = fold(parse(source))
        self._run = _steps(_spread(self.tree), True)

    def stream(self, messages: Iterable[dict], **values) -> Iterator[Part]:
        sink = _Sink()
        yield from self._run({**values, "messages": messages}, sink)
        if sink.pieces:
            yield sink.part()

    def render(self, messages: Iterable[dict], **values) -> Part:
        whole = Part()
        for part in self.stream(messages, **values):
            whole.loss += [(a + len(whole.text), b + len(whole.text)) for a, b in part.loss]
            whole.text += part.text
        return whole


# --- Spark ----------------------------------------------------------------------------------------------------------

def _conversations(batches, columns: int) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, rows) of sorted batches; rows are drawn lazily."""
    rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(columns))))
    row = next(rows, None)
    while row is not None:
        key = row[0]

        def own():
            nonlocal row
            while row is not None and row[0] == key:
                yield row
                row = next(rows, None)
        yield key, own()
        for _ in own():
            pass


_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
                    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _formatter(source: str):
    def run(batches):
        template = Template(source)
        held, size = [], 0
        for key, rows in _conversations(batches, 4):
            messages = ({"role": r[2] or "", "text": r[3] or ""} for r in rows)
            for number, part in enumerate(template.stream(messages)):
                held.append({"conv_id": key, "part": number, "text": part.text,
                             "loss": [{"start": a, "end": b} for a, b in part.loss]})
                size += len(part.text)
                if size > 1 << 20 or len(held) >= 4096:
                    yield pa.RecordBatch.from_pylist(held, _PARTS)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, _PARTS)
    return run


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, text, loss: each conversation's output in parts, in order within one partition.

    ``turns`` has conv_id, turn, role, text; null texts and roles are empty, null turns come first, and turns of the same
    number follow role and text. Rows without conv_id make one conversation. Other columns are ignored.
    """
    Template(template)  # a faulty template fails before any job
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_formatter(template),
                        "conv_id long, part long, text string, loss array<struct<start: long, end: long>>"))


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of formatted turns."""
    turns = []
    for piece in text.split(_TURN)[1:]:
        role, _, rest = piece.partition(_TEXT)
        turns.append((unescape(role), unescape(rest.partition(_END)[0])))
    return turns


def _reader(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    out = []
    for key, rows in _conversations(batches, 4):
        turns, loss, n, lost, chars, rest = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
        for _, _, text, spans in rows:
            chars += len(text)
            for span in spans:
                own = unescape(text[span["start"]:span["end"]])
                lost += len(own)
                loss.update(own.encode())
            whole, end, tail = (rest + text).rpartition(_END)
            rest = tail
            for role, said in read_turns(whole + end):
                n += 1
                turns.update(f"{role}\n{said}\n".encode())
        out.append({"conv_id": key, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": lost,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": chars})
        if len(out) >= 2048:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss mask, read back from formatted output in its own partitions."""
    return formatted.mapInArrow(_reader, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                         "loss_sha256 string, formatted_chars long")
