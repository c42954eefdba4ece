"""Chat formatting: a small sandboxed template language, compiled to Python closures.

A template is text with ``{{ expression }}``, ``{% if c %}..{% elif c %}..{% else %}..{% endif %}``, ``{% for x in xs %}..{% endfor %}``,
``{% set x = expression %}``, ``{% generation %}..{% endgeneration %}`` (text that the model is trained to produce) and ``{# remarks #}``.
Expressions have strings, whole numbers, true, false, none, names, ``a.b``, ``a[b]``, ``==  != < <= > >= in not and or + ~`` and the filters of
``FILTERS`` after ``|``. There are no calls, no assignments to attributes and no way to Python's own objects: a name stands for what
the caller passes, ``.`` and ``[]`` look into dicts and lists alone.

``compile_template`` parses the template into a syntax tree, folds what is constant (expressions of literals, branches never taken, adjacent
text) and builds one closure for each node. Rendering then runs closures only.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import row_slices

#: Strings with a meaning for the model in DEFAULT_TEMPLATE; inside texts they are escaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[ROLE]", "[/TURN]")
DEFAULT_TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}<s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% elif m.role == 'system' %}<<SYS>>{{ m.text | escape }}<</SYS>>"
    "{% else %}[TURN]{{ m.role | escape }}[ROLE]{{ m.text | escape }}[/TURN]{% endif %}"
    "{% endfor %}"
)
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """text with no control string in it: a backslash goes behind the first character of each, and doubles each backslash."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\")) if "\\" in text or _CONTROL.search(text) else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


FILTERS: dict[str, Callable] = {"escape": escape, "trim": str.strip, "lower": str.lower, "upper": str.upper, "length": len}
COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b}


class TemplateError(ValueError):
    """The template can't be parsed, or asks for what a sandboxed template may not have."""


# --- syntax tree


@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Look:
    base: object
    key: object


@dataclass
class Apply:
    what: Callable
    args: list


@dataclass
class Logic:
    kind: str  # and, or
    left: object
    right: object


@dataclass
class Text:
    text: str


@dataclass
class Show:
    expr: object


@dataclass
class If:
    arms: list  # of (condition, body)


@dataclass
class For:
    name: str
    over: object
    body: list


@dataclass
class Set:
    name: str
    expr: object


@dataclass
class Generation:
    body: list


_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-<>+~|.()\[\]]))""", re.DOTALL)
_PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.DOTALL)


@dataclass
class _Expression:
    """Recursive descent over one expression."""

    source: str
    tokens: list = field(default_factory=list)
    at: int = 0

    def __post_init__(self):
        pos, text = 0, self.source.strip()
        while pos < len(text):
            m = _TOKEN.match(text, pos)
            if not m:
                raise TemplateError(f"unexpected {text[pos:]!r} in {self.source!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            pos = m.end()

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"{kind} expected in {self.source!r}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = Logic("or", tree, self.both())
        return tree

    def both(self):
        tree = self.negated()
        while self.take("and"):
            tree = Logic("and", tree, self.negated())
        return tree

    def negated(self):
        return Apply(operator.not_, [self.negated()]) if self.take("not") else self.compared()

    def compared(self):
        tree = self.summed()
        while op := self.take(*COMPARE):
            tree = Apply(COMPARE[op], [tree, self.summed()])
        return tree

    def summed(self):
        tree = self.filtered()
        while op := self.take("+", "~"):
            tree = Apply(operator.add if op == "+" else _joined, [tree, self.filtered()])
        return tree

    def filtered(self):
        tree = self.looked()
        while self.take("|"):
            name = self.need("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = Apply(FILTERS[name], [tree])
        return tree

    def looked(self):
        tree = self.atom()
        while op := self.take(".", "["):
            if op == ".":
                name = self.need("name")
                if name.startswith("_"):
                    raise TemplateError(f"names may not start with an underscore: {name}")
                tree = Look(tree, Const(name))
            else:
                tree = Look(tree, self.either())
                if not self.take("]"):
                    raise TemplateError(f"] expected in {self.source!r}")
        return tree

    def atom(self):
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError(f") expected in {self.source!r}")
            return tree
        if self.take("-"):
            return Const(-int(self.need("int")))
        if self.at >= len(self.tokens):
            raise TemplateError(f"expression expected in {self.source!r}")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "int":
            return Const(int(value))
        if kind == "name":
            if value.startswith("_"):
                raise TemplateError(f"names may not start with an underscore: {value}")
            return Const({"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else Name(value)
        raise TemplateError(f"unexpected {value!r} in {self.source!r}")


def _joined(a, b) -> str:
    return str(a) + str(b)


def parse(template: str) -> list:
    """The template's syntax tree."""
    pieces, at = [], 0
    for m in _PART.finditer(template):
        if m.start() > at:
            pieces.append(("text", template[at : m.start()]))
        if m[1] is not None:
            pieces.append(("show", m[1]))
        elif m[2] is not None:
            pieces.append(("tag", m[2].strip().strip("-").strip()))
        at = m.end()
    if at < len(template):
        pieces.append(("text", template[at:]))
    pieces.reverse()

    def body(*ends: str) -> tuple[list, str]:
        out = []
        while pieces:
            kind, value = pieces.pop()
            if kind == "text":
                out.append(Text(value))
                continue
            if kind == "show":
                out.append(Show(_Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return out, value
            if word == "if":
                arms, condition = [], _Expression(rest).whole()
                while True:
                    inner, end = body("elif", "else", "endif")
                    arms.append((condition, inner))
                    if end.startswith("elif"):
                        condition = _Expression(end[4:]).whole()
                    elif end == "else":
                        condition = Const(True)
                    else:
                        break
                out.append(If(arms))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+(.+)", rest, re.DOTALL)
                if not m:
                    raise TemplateError(f"for x in xs expected: {value!r}")
                inner, _ = body("endfor")
                out.append(For(m[1], _Expression(m[2]).whole(), inner))
            elif word == "set":
                m = re.fullmatch(r"([A-Za-z]\w*)\s*=\s*(.+)", rest, re.DOTALL)
                if not m:
                    raise TemplateError(f"set x = value expected: {value!r}")
                out.append(Set(m[1], _Expression(m[2]).whole()))
            elif word == "generation":
                inner, _ = body("endgeneration")
                out.append(Generation(inner))
            else:
                raise TemplateError(f"unexpected {{% {value} %}}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return out, ""

    return body()[0]


def fold(tree):
    """The tree with all that is constant worked out."""
    if isinstance(tree, list):
        out: list = []
        for node in map(fold, tree):
            for x in node if isinstance(node, list) else [node]:
                if isinstance(x, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].text + x.text)
                elif not (isinstance(x, Text) and not x.text):
                    out.append(x)
        return out
    if isinstance(tree, Apply):
        args = [fold(a) for a in tree.args]
        if not all(isinstance(a, Const) for a in args):
            return Apply(tree.what, args)
        try:
            return Const(tree.what(*(a.value for a in args)))
        except TypeError as e:
            raise TemplateError(f"a constant can't be worked out: {e}") from e
    if isinstance(tree, Logic):
        left, right = fold(tree.left), fold(tree.right)
        if isinstance(left, Const):
            return right if bool(left.value) == (tree.kind == "and") else left
        return Logic(tree.kind, left, right)
    if isinstance(tree, Look):
        return Look(fold(tree.base), fold(tree.key))
    if isinstance(tree, Show):
        expr = fold(tree.expr)
        return Text(_shown(expr.value)) if isinstance(expr, Const) else Show(expr)
    if isinstance(tree, If):
        arms = []
        for condition, inner in tree.arms:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            arms.append((condition, fold(inner)))
            if isinstance(condition, Const):
                break
        return arms[0][1] if arms and isinstance(arms[0][0], Const) else If(arms) if arms else []
    if isinstance(tree, For):
        return For(tree.name, fold(tree.over), fold(tree.body))
    if isinstance(tree, Set):
        return Set(tree.name, fold(tree.expr))
    if isinstance(tree, Generation):
        return Generation(fold(tree.body))
    return tree


def _shown(value) -> str:
    return "" if value is None else str(value)


def _look(base, key):
    if isinstance(base, dict):
        return base.get(key)
    if isinstance(base, (list, str)) and isinstance(key, int):
        return base[key] if -len(base) <= key < len(base) else None
    return None


def _value(tree) -> Callable[[dict], object]:
    """A closure that works out an expression from the names' values."""
    if isinstance(tree, Const):
        value = tree.value
        return lambda env: value
    if isinstance(tree, Name):
        name = tree.name
        return lambda env: env.get(name)
    if isinstance(tree, Look):
        base, key = _value(tree.base), _value(tree.key)
        return lambda env: _look(base(env), key(env))
    if isinstance(tree, Logic):
        left, right = _value(tree.left), _value(tree.right)
        return (lambda env: left(env) and right(env)) if tree.kind == "and" else (lambda env: left(env) or right(env))
    what, args = tree.what, [_value(a) for a in tree.args]
    if len(args) == 1:
        only = args[0]
        return lambda env: what(only(env))
    first, second = args
    return lambda env: what(first(env), second(env))


class _Out:
    """Rendered text so far: pieces, their total length, and spans of generated text."""

    __slots__ = ("length", "pieces", "spans")

    def __init__(self):
        self.pieces, self.length, self.spans = [], 0, []

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _closure(tree) -> Callable[[dict, _Out], None]:
    if isinstance(tree, list):
        steps = [_closure(x) for x in tree]

        def run(env, out):
            for step in steps:
                step(env, out)

        return steps[0] if len(steps) == 1 else run
    if isinstance(tree, Text):
        text = tree.text
        return lambda env, out: out.add(text)
    if isinstance(tree, Show):
        expr = _value(tree.expr)
        return lambda env, out: out.add(_shown(expr(env)))
    if isinstance(tree, Set):
        name, expr = tree.name, _value(tree.expr)
        return lambda env, out: env.__setitem__(name, expr(env))
    if isinstance(tree, If):
        arms = [(_value(c), _closure(b)) for c, b in tree.arms]

        def choose(env, out):
            for condition, inner in arms:
                if condition(env):
                    inner(env, out)
                    return

        return choose
    if isinstance(tree, Generation):
        inner = _closure(tree.body)

        def marked(env, out):
            start = out.length
            inner(env, out)
            out.spans.append((start, out.length))

        return marked
    name, over, inner = tree.name, _value(tree.over), _closure(tree.body)

    def loop(env, out):
        items = list(over(env) or [])
        for i, item in enumerate(items):
            inner(env | {name: item, "loop": {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(items) - 1}}, out)

    return loop


def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages (dicts of role and text) to the rendered text and the spans (start, end) of generated text in it."""
    run = _closure(fold(parse(template)))

    def render(messages: list[dict], **names) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        run({"messages": messages, **names}, out)
        return "".join(out.pieces), out.spans

    return render


# --- over tables

SPANS = "array<struct<start:int,end:int>>"


def format_conversations(conversations: DataFrame, template: str = DEFAULT_TEMPLATE, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: id, ``formatted`` and ``spans``, the generated parts of it in code points.

    Turns go by turn, nulls first, ties by role and text; repeated rows are repeated turns. A null role or text counts as empty. Rows
    with a null id form one conversation of their own. Other columns are ignored; an empty table gives no rows. A conversation is one
    row of the result, so its turns must fit one task.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    gathered = conversations.groupBy(F.col(id).alias("id")).agg(F.sort_array(F.collect_list(F.struct(F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text")))).alias("messages"))
    kind = conversations.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in row_slices(batches, "messages"):
            texts, marks = [], []
            for messages in batch.column("messages").to_pylist():
                rendered, found = render(messages)
                texts.append(rendered)
                marks.append([{"start": a, "end": b} for a, b in found])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string()), pa.array(marks, spans)], names=["id", "formatted", "spans"])

    return gathered.mapInArrow(run, f"id {kind}, formatted string, spans {SPANS}").withColumnRenamed("id", id)


_PAIRS = {"[INST]": "[/INST]", "<s>": "</s>", "<<SYS>>": "<</SYS>>", "[ROLE]": "[/TURN]"}
_ROLES = {"[INST]": "user", "<s>": "assistant", "<<SYS>>": "system"}


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of what DEFAULT_TEMPLATE rendered."""
    marks = list(_CONTROL.finditer(formatted))
    turns, i = [], 0
    while i < len(marks):
        mark, end = marks[i], marks[i + 1]
        if mark[0] == "[TURN]":
            role = unescape(formatted[mark.end() : end.start()])
            mark, end, i = end, marks[i + 2], i + 1
        else:
            role = _ROLES[mark[0]]
        if end[0] != _PAIRS[mark[0]]:
            raise ValueError(f"{mark[0]} ends with {end[0]}")
        pad = mark[0] == "[INST]"
        turns.append((role, unescape(formatted[mark.end() + pad : end.start() - pad])))
        i += 2
    return turns


def conversation_digests(formatted: DataFrame, id: str = "conv_id") -> DataFrame:
    """What can be read back from ``format_conversations``' output: turns, and the text under the loss mask, as counts and SHA-256."""
    kind = formatted.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, "formatted"):
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                said = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                rows.append((len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select(F.col(id).alias("id"), "formatted", "spans").mapInArrow(run, schema).withColumnRenamed("id", id)
