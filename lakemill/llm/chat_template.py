"""Chat formatting: a small sandboxed template language compiled to Python closures.

The language has text, ``{{ expression }}``, ``{% for x in name %}``, ``{% if %} / {% elif %} / {% else %}``,
``{% set %}`` and ``{% generation %} ... {% endgeneration %}``, which marks what a model is to produce. Expressions
have strings, integers, names, ``a.b`` (lookup in a mapping, nothing else), ``+``, ``==``, ``!=``, ``not``, ``and``,
``or`` and filters from a fixed list. There are no calls, no attributes and no imports, so a template can only
combine what it is given. Constants are folded and neighbouring texts joined before closures are made.

Closures are generators of (text, under the loss mask) pieces and take messages from any iterator, so that a
conversation is rendered while its rows stream by and is never gathered as a whole.

Defined results: null role or text is empty; rows of equal turn are ordered by role, then text; rows with a null
conv_id form one conversation with that id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: markers of the default template; texts may hold them, and are then escaped
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}<s>{{ m.role | escape }}[INST]{% if m.role == 'assistant' %}"
    "{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}[/INST]</s>{% endfor %}"
)
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    """Doubles backslashes and puts one after the first character of each control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    pass


# ---- syntax tree: tuples whose first item names the node ------------------------------------------------------------

_TOKEN = re.compile(r"\s*(?:(?P<str>'[^']*'|\"[^\"]*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)|(?P<op>==|!=|\+|\||\(|\)))")
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise TemplateError(f"not understood: {text[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, text: str):
        self.left = _tokens(text)

    def tree(self) -> tuple:
        out = self.either()
        if self.left:
            raise TemplateError(f"left over: {self.left}")
        return out

    def take(self, *words: str) -> str | None:
        return self.left.pop(0)[1] if self.left and self.left[0][1] in words and self.left[0][0] != "str" else None

    def either(self) -> tuple:
        a = self.both()
        while self.take("or"):
            a = ("or", a, self.both())
        return a

    def both(self) -> tuple:
        a = self.negated()
        while self.take("and"):
            a = ("and", a, self.negated())
        return a

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        a = self.summed()
        op = self.take("==", "!=")
        return (op, a, self.summed()) if op else a

    def summed(self) -> tuple:
        a = self.filtered()
        while self.take("+"):
            a = ("+", a, self.filtered())
        return a

    def filtered(self) -> tuple:
        a = self.atom()
        while self.take("|"):
            name = self.left.pop(0)[1] if self.left else ""
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            a = ("filter", name, a)
        return a

    def atom(self) -> tuple:
        if self.take("("):
            a = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return a
        if not self.left:
            raise TemplateError("expression expected")
        kind, value = self.left.pop(0)
        if kind == "str":
            return ("const", value[1:-1])
        if kind == "int":
            return ("const", int(value))
        if kind == "name":
            return ("const", value == "true") if value in ("true", "false") else ("name", tuple(value.split(".")))
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list[tuple]:
    """The template as a list of nodes."""
    parts, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        parts.append(("show", m[1].strip()) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    body, end = _block(parts, ())
    return body


def _block(parts: list[tuple], ends: tuple[str, ...]) -> tuple[list[tuple], str]:
    out: list[tuple] = []
    while parts:
        kind, text = parts.pop(0)
        if kind == "text":
            out.append(("text", text))
            continue
        if kind == "show":
            out.append(("show", _Expression(text).tree()))
            continue
        word, _, rest = text.partition(" ")
        if word in ends:
            return out, text
        if word == "for":
            m = re.fullmatch(r"(\w+) in (\w+)", rest.strip())
            if not m:
                raise TemplateError(f"for what: {rest!r}")
            body, _ = _block(parts, ("endfor",))
            out.append(("for", m[1], m[2], body))
        elif word == "if":
            arms, test = [], _Expression(rest).tree()
            while True:
                body, end = _block(parts, ("elif", "else", "endif"))
                arms.append((test, body))
                if end == "endif":
                    break
                test = ("const", True) if end == "else" else _Expression(end[4:]).tree()
            out.append(("if", arms))
        elif word == "set":
            name, _, value = rest.partition("=")
            out.append(("set", name.strip(), _Expression(value).tree()))
        elif word == "generation":
            body, _ = _block(parts, ("endgeneration",))
            out.append(("generation", body))
        else:
            raise TemplateError(f"unknown tag {word!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return out, ""


# ---- folding --------------------------------------------------------------------------------------------------------


def _operate(op: str, *args):
    if op == "filter":
        return FILTERS[args[0]](str(args[1]))
    if op == "not":
        return not args[0]
    a, b = args
    if op == "+":
        return a + b if isinstance(a, int) and isinstance(b, int) else str(a) + str(b)
    return {"==": a == b, "!=": a != b, "and": a and b, "or": a or b}[op]


def fold_expression(node: tuple) -> tuple:
    if node[0] in ("const", "name"):
        return node
    args = [fold_expression(x) if isinstance(x, tuple) else x for x in node[1:]]
    if all(not isinstance(x, tuple) or x[0] == "const" for x in args):
        return ("const", _operate(node[0], *(x[1] if isinstance(x, tuple) else x for x in args)))
    return (node[0], *args)


def fold(nodes: list[tuple]) -> list[tuple]:
    """Constants evaluated, branches with constant tests resolved, neighbouring texts joined."""
    out: list[tuple] = []
    for node in nodes:
        kind = node[0]
        if kind == "show" and (e := fold_expression(node[1]))[0] == "const":
            new = [("text", str(e[1]))]
        elif kind == "show":
            new = [("show", e)]
        elif kind == "for":
            new = [("for", node[1], node[2], fold(node[3]))]
        elif kind == "generation":
            new = [("generation", fold(node[1]))]
        elif kind == "set":
            new = [("set", node[1], fold_expression(node[2]))]
        elif kind == "if":
            arms = []
            for test, body in node[1]:
                test = fold_expression(test)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, fold(body)))
                if test[0] == "const":
                    break
            new = arms[0][1] if arms and arms[0][0][0] == "const" else [("if", arms)] if arms else []
        else:
            new = [node]
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


# ---- closures -------------------------------------------------------------------------------------------------------

Scope = dict
Piece = tuple[str, bool]


def _value(node: tuple) -> Callable[[Scope], object]:
    kind = node[0]
    if kind == "const":
        const = node[1]
        return lambda scope: const
    if kind == "name":
        first, rest = node[1][0], node[1][1:]

        def look(scope: Scope):
            v = scope.get(first, "")
            for k in rest:
                v = v.get(k, "") if isinstance(v, dict) else ""
            return v

        return look
    if kind == "filter":
        f, inner = FILTERS[node[1]], _value(node[2])
        return lambda scope: f(str(inner(scope)))
    parts = [_value(x) for x in node[1:]]
    return lambda scope: _operate(kind, *(p(scope) for p in parts))


def _closure(nodes: list[tuple], marked: bool) -> Callable[[Scope], Iterator[Piece]]:
    steps = [_step(n, marked) for n in nodes]

    def run(scope: Scope) -> Iterator[Piece]:
        for s in steps:
            yield from s(scope)

    return run


def _step(node: tuple, marked: bool) -> Callable[[Scope], Iterable[Piece]]:
    kind = node[0]
    if kind == "text":
        pieces = ((node[1], marked),)
        return lambda scope: pieces
    if kind == "show":
        value = _value(node[1])
        return lambda scope: ((str(value(scope)), marked),)
    if kind == "generation":
        return _closure(node[1], True)
    if kind == "set":
        name, value = node[1], _value(node[2])

        def put(scope: Scope) -> tuple:
            scope[name] = value(scope)
            return ()

        return put
    if kind == "for":
        name, source, body = node[1], node[2], _closure(node[3], marked)

        def loop(scope: Scope) -> Iterator[Piece]:
            for i, x in enumerate(scope.get(source, ())):
                scope[name], scope["loop"] = x, {"index0": i, "index": i + 1, "first": i == 0}
                yield from body(scope)

        return loop
    arms = [(_value(t), _closure(b, marked)) for t, b in node[1]]

    def choose(scope: Scope) -> Iterable[Piece]:
        return next((b(scope) for t, b in arms if t(scope)), ())

    return choose


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (mappings with role and text) to (text, under the mask) pieces."""
    run = _closure(fold(parse(source)), False)
    return lambda messages: run({"messages": messages})


# ---- Spark ----------------------------------------------------------------------------------------------------------

PART = 1 << 20


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, part, formatted, loss_start, loss_end of each conversation of rows (conv_id, turn, role, text).

    A conversation's text comes as parts of about PART characters, nearly always one, in order in one partition;
    loss_start and loss_end are the spans under the mask within the part.
    """
    compile_template(template)  # errors show here and not in a task
    kind = rows.schema["conv_id"].dataType.simpleString()
    text = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # rows stream through in order
    dealt = text.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        first = next(batches, None)
        if first is None:
            return
        id_type = first.schema.field(0).type
        stream = (x for b in chain((first,), batches) for x in zip(*(c.to_pylist() for c in b.columns)))
        out: list[tuple] = []
        size = 0
        for conv, messages in groupby(stream, key=lambda x: x[0]):
            part, buf, n, spans = 0, [], 0, []
            for piece, marked in render({"role": r, "text": t} for _, r, t in messages):
                if n and n + len(piece) > PART:
                    out.append((conv, part, "".join(buf), [s for s, _ in spans], [e for _, e in spans]))
                    size, part, buf, n, spans = size + n, part + 1, [], 0, []
                    yield _batch(out, id_type)
                    out, size = [], 0
                if marked and piece:
                    if spans and spans[-1][1] == n:
                        spans[-1] = (spans[-1][0], n + len(piece))
                    else:
                        spans.append((n, n + len(piece)))
                buf.append(piece)
                n += len(piece)
            out.append((conv, part, "".join(buf), [s for s, _ in spans], [e for _, e in spans]))
            size += n
            if size > PART:
                yield _batch(out, id_type)
                out, size = [], 0
        if out:
            yield _batch(out, id_type)

    return dealt.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, part int, formatted string, loss_start array<int>, loss_end array<int>")


def _batch(out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    """Rows as Arrow: ids keep their type, with or without nulls."""
    types = [id_type, pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["conv_id", "part", "formatted", "loss_start", "loss_end"])


@dataclass
class _Reader:
    """Reads one conversation's parts back, a turn at a time."""

    def __post_init__(self) -> None:
        self.rest, self.turns, self.chars, self.loss = "", 0, 0, 0
        self.turn_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()
        self.masked = ""

    def feed(self, text: str, spans: list[tuple[int, int]]) -> None:
        self.chars += len(text)
        self.masked += "".join(text[a:b] for a, b in spans)
        self.rest += text
        *done, self.rest = self.rest.split("[/INST]</s>")
        for turn in done:
            role, body = turn.removeprefix("<s>").split("[INST]", 1)
            self.turns += 1
            self.turn_sha.update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
        # an escape may be cut in two by the end of a part; hold an unfinished one back
        tail = len(self.masked) - len(self.masked.rstrip("\\"))
        cut = len(self.masked) - tail % 2
        plain = unescape(self.masked[:cut])
        self.masked = self.masked[cut:]
        self.loss += len(plain)
        self.loss_sha.update(plain.encode("utf-8", "surrogatepass"))


def read_back(parts: DataFrame, ordered: bool = False) -> DataFrame:
    """n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from format_conversations' output alone.

    ordered: parts come straight from format_conversations, whose partitions hold whole conversations in order.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    # parts that come from files may lie in any order and place
    dealt = parts.select("conv_id", "part", "formatted", "loss_start", "loss_end")
    if not ordered:
        dealt = dealt.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        stream = (x for b in chain((first,), batches) for x in zip(*(c.to_pylist() for c in b.columns)))
        out: list[tuple] = []
        for conv, group in groupby(stream, key=lambda x: x[0]):
            r = _Reader()
            for _, _, text, start, end in group:
                r.feed(text, list(zip(start, end)))
            out.append((conv, r.turns, r.turn_sha.hexdigest(), r.loss, r.loss_sha.hexdigest(), r.chars))
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return dealt.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
