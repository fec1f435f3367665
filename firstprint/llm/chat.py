"""Chat formatting with compiled templates.

A template is parsed into a syntax tree, constant parts are folded, and every node becomes a Python closure. There is no
access to attributes, calls of names or imports: a template sees its messages, their fields, the loop, and the filters
listed in FILTERS. The language:

    {{ expression }}   {% for m in messages %} ... {% endfor %}   {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% set name = expression %}   {% generation %} ... {% endgeneration %}   {# comment #}

Expressions have strings, whole numbers, names, m['field'] or m.field, + (joins), == != < <= > >=, and, or, not, in,
brackets, and filters after |.

Closures yield pieces of output one by one, and `messages` may be an iterator, so a conversation is rendered as a stream:
its length is bounded by nothing but its reader. The loop looks one message ahead, for loop.last.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from firstprint.llm.frames import frame

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[MSG]", "[AS]", "[/MSG]")
MARK = "\\"
CHUNK = "conv_id chunk text spans"
TEMPLATE = """<s>{% for m in messages %}
{%- if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]
{%- elif m.role == 'assistant' %} {% generation %}{{ m.text | escape }}{% endgeneration %}</s>
{%- elif m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]
{%- else %}[MSG] {{ m.role | escape }}[AS]{{ m.text | escape }} [/MSG]
{%- endif %}{% endfor %}"""


class TemplateError(ValueError):
    """A template that does not parse, or uses what the sandbox does not have."""


_BREAKS = re.compile(r"[\\<\[]")


def escape(text: str) -> str:
    """Put MARK before every character that could begin a control string, and before MARK itself."""
    return _BREAKS.sub(lambda found: MARK + found[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\([\\<\[])", r"\1", text)


FILTERS: dict[str, Callable[[Any], Any]] = {"escape": escape, "trim": lambda x: x.strip(), "upper": lambda x: x.upper(),
                                            "lower": lambda x: x.lower(), "length": len}

_TAG = re.compile(r"(?s)(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})")
_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"
                    r"|(?P<sign>==|!=|<=|>=|[<>+()|.\[\]=]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.joined()
        while sign := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
            tree = (sign, tree, self.joined())
        return tree

    def joined(self) -> tuple:
        tree = self.filtered()
        while self.take("+"):
            tree = ("+", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.plain()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def plain(self) -> tuple:
        if self.take("("):
            tree = self.either()
            self.need(")")
        elif self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        else:
            kind, value = self.tokens[self.at]
            self.at += 1
            if kind == "text":
                tree = ("value", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1]))
            elif kind == "number":
                tree = ("value", int(value))
            elif kind == "name":
                tree = ("value", {"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else ("name", value)
            else:
                raise TemplateError(f"unexpected {value!r}")
        while self.peek(".", "["):
            if self.take("."):
                tree = ("field", tree, ("value", self.name()))
            else:
                self.need("[")
                tree = ("field", tree, self.either())
                self.need("]")
        return tree


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template."""
    parts = _TAG.split(source)
    for i in range(1, len(parts), 2):  # '-' inside a tag eats the white space next to it
        if parts[i][2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if parts[i][-3] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
    blocks: list[tuple[str, Any, list]] = [("top", None, [])]
    for i, part in enumerate(parts):
        body = blocks[-1][2]
        if i % 2 == 0:
            if part:
                body.append(("out", ("value", part)))
        elif part.startswith("{#"):
            continue
        elif part.startswith("{{"):
            body.append(("out", _Expression(part[2:-2].strip("-")).whole()))
        else:
            words = _Expression(part[2:-2].strip("-"))
            key = words.name()
            if key == "for":
                name = words.name()
                words.need("in")
                blocks.append(("for", (name, words.whole()), []))
            elif key == "if":
                blocks.append(("if", [(words.whole(), [])], []))
                blocks[-1] = ("if", blocks[-1][1], blocks[-1][1][0][1])
            elif key in ("elif", "else"):
                if blocks[-1][0] != "if":
                    raise TemplateError(f"{key} outside if")
                arms = blocks[-1][1]
                arms.append((words.whole() if key == "elif" else ("value", True), []))
                blocks[-1] = ("if", arms, arms[-1][1])
            elif key == "generation":
                blocks.append(("generation", None, []))
            elif key == "set":
                name = words.name()
                words.need("=")
                body.append(("set", name, words.whole()))
            elif key in ("endfor", "endif", "endgeneration"):
                kind, head, inner = blocks.pop()
                if kind != key[3:]:
                    raise TemplateError(f"{key} closes {kind}")
                blocks[-1][2].append({"for": ("for", head, inner), "if": ("if", head), "generation": ("generation", inner)}[kind])
            else:
                raise TemplateError(f"no tag {key!r}")
    if len(blocks) > 1:
        raise TemplateError(f"{blocks[-1][0]} is not closed")
    return blocks[0][2]


def _apply(kind: str, a: Any, b: Any = None) -> Any:
    if kind == "+":
        return a + b if isinstance(a, int) and isinstance(b, int) else _shown(a) + _shown(b)
    if kind == "not":
        return not a
    return {"==": lambda: a == b, "!=": lambda: a != b, "<": lambda: a < b, "<=": lambda: a <= b, ">": lambda: a > b,
            ">=": lambda: a >= b, "in": lambda: a in b, "and": lambda: a and b, "or": lambda: a or b}[kind]()


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def fold(tree: tuple) -> tuple:
    """The expression with every part that depends on no name replaced by its value."""
    kind = tree[0]
    if kind in ("value", "name"):
        return tree
    if kind == "filter":
        inner = fold(tree[2])
        return ("value", FILTERS[tree[1]](inner[1])) if inner[0] == "value" else ("filter", tree[1], inner)
    parts = [fold(x) for x in tree[1:]]
    if kind != "field" and all(x[0] == "value" for x in parts):
        return ("value", _apply(kind, *[x[1] for x in parts]))
    return (kind, *parts)


def fold_body(body: list[tuple]) -> list[tuple]:
    """A body with folded expressions, without arms that cannot be reached, and with neighbouring constants joined."""
    out: list[tuple] = []
    for node in body:
        if node[0] == "out":
            tree = fold(node[1])
            if tree[0] == "value":
                text = _shown(tree[1])
                if out and out[-1][0] == "out" and out[-1][1][0] == "value":
                    text = out.pop()[1][1] + text
                if text:
                    out.append(("out", ("value", text)))
            else:
                out.append(("out", tree))
        elif node[0] == "if":
            arms = []
            for test, inner in node[1]:
                test = fold(test)
                if test[0] == "value" and not test[1]:
                    continue
                arms.append((test, fold_body(inner)))
                if test[0] == "value":
                    break
            if arms and arms[0][0][0] == "value":
                out.extend(arms[0][1])
            elif arms:
                out.append(("if", arms))
        elif node[0] == "for":
            out.append(("for", (node[1][0], fold(node[1][1])), fold_body(node[2])))
        elif node[0] == "generation":
            out.append(("generation", fold_body(node[1])))
        else:
            out.append(("set", node[1], fold(node[2])))
    return out


Piece = tuple[str, bool]
Render = Callable[[dict], Iterable[Piece]]


def _value(tree: tuple) -> Callable[[dict], Any]:
    kind = tree[0]
    if kind == "value":
        return lambda scope, value=tree[1]: value
    if kind == "name":
        def named(scope: dict, name: str = tree[1]) -> Any:
            if name not in scope:
                raise TemplateError(f"no name {name!r}")
            return scope[name]
        return named
    if kind == "filter":
        inner, change = _value(tree[2]), FILTERS[tree[1]]
        return lambda scope: change(inner(scope))
    first, second = _value(tree[1]), _value(tree[2]) if len(tree) > 2 else None
    if kind == "field":
        def field(scope: dict) -> Any:
            held, key = first(scope), second(scope)
            if not isinstance(held, dict):
                raise TemplateError("only messages and loops have fields")
            return held.get(key)
        return field
    if kind == "and":
        return lambda scope: first(scope) and second(scope)
    if kind == "or":
        return lambda scope: first(scope) or second(scope)
    if second is None:
        return lambda scope: _apply(kind, first(scope))
    return lambda scope: _apply(kind, first(scope), second(scope))


def _run(body: list[tuple], learned: bool = False) -> Render:
    steps = [_step(node, learned) for node in body]

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)
    return run


def _step(node: tuple, learned: bool) -> Render:
    kind = node[0]
    if kind == "out":
        value = _value(node[1])
        return lambda scope: ((_shown(value(scope)), learned),)
    if kind == "set":
        name, value = node[1], _value(node[2])

        def keep(scope: dict) -> Iterator[Piece]:
            scope[name] = value(scope)
            return iter(())
        return keep
    if kind == "generation":
        return _run(node[1], True)
    if kind == "if":
        arms = [(_value(test), _run(inner, learned)) for test, inner in node[1]]

        def choose(scope: dict) -> Iterator[Piece]:
            for test, inner in arms:
                if test(scope):
                    return inner(scope)
            return iter(())
        return choose
    (name, source), inner = (node[1][0], _value(node[1][1])), _run(node[2], learned)

    def each(scope: dict) -> Iterator[Piece]:
        rest, end = iter(source(scope)), object()
        now, index = next(rest, end), 0
        while now is not end:
            after = next(rest, end)
            yield from inner(scope | {name: now, "loop": {"index": index + 1, "index0": index, "first": index == 0, "last": after is end}})
            now, index = after, index + 1
    return each


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages to pieces of output: (text, whether it is under the generation mark)."""
    run = _run(fold_body(parse(source)))
    return lambda messages: run({"messages": messages})


def format_conversations(turns: DataFrame, template: str = TEMPLATE, chunk_chars: int = 1 << 20) -> DataFrame:
    """(conv_id, chunk, text, spans): the formatted text of every conversation, in chunks of about `chunk_chars`.

    `spans` holds [start, end) pairs of code points of the chunk that are under the generation mark. Chunks of one
    conversation lie in one partition, in order. Rows are ordered by turn (null first), then role and text; repeated rows are
    repeated turns. A null text or role is an empty one; a null conv_id is a conversation like any other; other columns are
    not read. A conversation is streamed: no task holds more of it than a chunk and two turns.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        flow = ((None if pd.isna(c) else int(c), {"role": r, "text": t}) for b in batches for c, r, t in zip(b["conv_id"], b["role"], b["text"]))
        ready, held = [], 0
        for conv_id, messages in _runs(flow):
            for chunk in _chunks(conv_id, render(messages), chunk_chars):
                ready.append(chunk)
                held += len(chunk[2])
                if len(ready) >= 1000 or held >= chunk_chars:
                    yield frame(CHUNK, ready)
                    ready, held = [], 0
            for _ in messages:  # a template need not read them all
                pass
        yield frame(CHUNK, ready)

    return ordered.mapInPandas(run, "conv_id bigint, chunk bigint, text string, spans array<bigint>")


def _runs(flow: Iterator[tuple]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Runs of rows with the same first field, each as a lazy iterator of the second."""
    end = object()
    held = [next(flow, end)]
    while held[0] is not end:
        key = held[0][0]

        def values() -> Iterator[dict]:
            while held[0] is not end and held[0][0] == key:
                value = held[0][1]
                held[0] = next(flow, end)
                yield value
        yield key, values()


def _chunks(conv_id: int | None, pieces: Iterable[Piece], limit: int) -> Iterator[tuple]:
    """Rows of about `limit` characters; a piece is never split."""
    number, parts, length, spans = 0, [], 0, []
    for text, learned in pieces:
        if learned and text:
            if spans and spans[-1] == length:
                spans[-1] = length + len(text)
            else:
                spans += [length, length + len(text)]
        parts.append(text)
        length += len(text)
        if length >= limit:
            yield conv_id, number, "".join(parts), spans
            number, parts, length, spans = number + 1, [], 0, []
    if parts or not number:
        yield conv_id, number, "".join(parts), spans


_BODY = r"((?:[^\\<\[]|\\.)*)"
_TURN = re.compile(rf"(?s)\[INST\] {_BODY} \[/INST\]| {_BODY}</s>|\[SYS\] {_BODY} \[/SYS\]|\[MSG\] {_BODY}\[AS\]{_BODY} \[/MSG\]")


def read_turns(texts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn in the chunks of one conversation that TEMPLATE formatted."""
    rest = None
    for text in texts:
        rest, at = text.removeprefix("<s>") if rest is None else rest + text, 0
        while found := _TURN.match(rest, at):
            user, assistant, system, role, other = found.groups()
            if role is not None:
                yield unescape(role), unescape(other)
            else:
                name, body = next((n, b) for n, b in (("user", user), ("assistant", assistant), ("system", system)) if b is not None)
                yield name, unescape(body)
            at = found.end()
        rest = rest[at:]
    if rest:
        raise ValueError(f"not a turn: {rest[:40]!r}")


def digests(chunks: DataFrame) -> DataFrame:
    """What can be read back from formatted chunks: one row per conversation.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed of each turn), loss_chars and loss_sha256 (of all text
    under the mask, unescaped), formatted_chars. Chunks of a conversation must follow each other, as format_conversations
    leaves them; they are read as a stream.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        flow = ((None if pd.isna(c) else int(c), {"text": t, "spans": s}) for b in batches
                for c, t, s in zip(b["conv_id"], b["text"], b["spans"]))
        for conv_id, held in _runs(flow):
            turns, loss, n_turns, loss_chars, formatted = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

            def texts() -> Iterator[str]:
                nonlocal loss_chars, formatted
                for chunk in held:
                    for start, end in zip(chunk["spans"][::2], chunk["spans"][1::2]):
                        learned = unescape(chunk["text"][start:end])
                        loss_chars += len(learned)
                        loss.update(learned.encode())
                    formatted += len(chunk["text"])
                    yield chunk["text"]
            for role, text in read_turns(texts()):
                turns.update(f"{role}\n{text}\n".encode())
                n_turns += 1
            rows.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted))
            if len(rows) >= 10_000:
                yield frame(names, rows)
                rows = []
        yield frame(names, rows)

    names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"
    return chunks.select("conv_id", "text", "spans").mapInPandas(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
