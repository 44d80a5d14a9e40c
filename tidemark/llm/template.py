"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                      output
    {% for m in messages %} ... {% endfor %}   loop.first, loop.last, loop.index0 inside
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}   marks what a model is trained to say
    {# remark #}

Expressions: names, ``a.b`` (a key of a mapping, never an attribute), quoted strings, integers,
true / false / none, ``~`` (join as text), ``== != in not and or``, parentheses and the filters
given to ``compile_template``. Nothing else can be reached from a template. ``-`` inside a tag
(``{%-``, ``-%}``) strips white space beside it.

A template is parsed to a syntax tree, constants are folded (joined constant text becomes one
node, branches that cannot run are removed), and each node becomes a closure that yields pieces
``(text, generated)``. Pieces are yielded while messages are read, so a conversation of any
length is rendered without being held.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

TAGS = re.compile(r"\{#.*?#\}|\{\{-?.*?-?\}\}|\{%-?.*?-?%\}", re.S)
TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<op>==|!=|[~|.()]))"
)
ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
WORDS = {"true": True, "false": False, "none": None}
KEYWORDS = {"and", "or", "not", "in", *WORDS}
Pieces = Iterator[tuple[str, bool]]


class TemplateError(ValueError):
    """The template is not in the language."""


def shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# --- parsing: nodes are tuples whose first member names the kind ---------------------------------


class _Expression:
    def __init__(self, source: str, filters: Mapping[str, Callable[[str], str]]):
        self.tokens: list[tuple[str, str]] = []
        self.filters, self.at, place = filters, 0, 0
        source = source.rstrip()
        while place < len(source):
            found = TOKEN.match(source, place)
            if not found:
                raise TemplateError(f"cannot read {source[place:]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            place = found.end()

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind in ("op", "name") and value in values:
                self.at += 1
                return value
        return None

    def whole(self) -> tuple:
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negation()
        while self.take("and"):
            node = ("and", node, self.negation())
        return node

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> tuple:
        node = self.joined()
        if op := self.take("==", "!=", "in"):
            return (op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while self.take("~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.member()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def member(self) -> tuple:
        node = self.atom()
        while self.take("."):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name":
                raise TemplateError("a key must follow the dot")
            self.at += 1
            node = ("key", node, name)
        return node

    def atom(self) -> tuple:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return ("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == "int":
            return ("const", int(value))
        if kind == "name" and value in WORDS:
            return ("const", WORDS[value])
        if kind == "name" and value not in KEYWORDS:
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str, filters: Mapping[str, Callable[[str], str]]) -> tuple:
    """The syntax tree of a template: ("block", [nodes])."""
    root: list[tuple] = []
    # (tag, argument, branches, nodes being filled)
    open_tags: list[tuple[str, Any, list, list]] = []
    nodes, place, strip = root, 0, False
    marks = [*TAGS.finditer(source), None]
    for mark in marks:
        text = source[place : mark.start() if mark else len(source)]
        text = text.lstrip() if strip else text
        tag = mark.group() if mark else ""
        if tag[2:3] == "-":
            text = text.rstrip()
        if text:
            nodes.append(("text", text))
        if not mark:
            break
        place, strip = mark.end(), tag[-3:-2] == "-"
        body = tag[2:-2].removeprefix("-").removesuffix("-").strip()
        if tag.startswith("{{"):
            nodes.append(("out", _Expression(body, filters).whole()))
        elif tag.startswith("{%"):
            word, _, rest = body.partition(" ")
            if word == "for":
                found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
                if not found or any(t[0] == "for" for t in open_tags):
                    raise TemplateError("a loop reads messages once and holds no other loop")
                open_tags.append(("for", found[1], [], nodes))
                nodes = []
            elif word == "generation" and not rest:
                if any(t[0] == word for t in open_tags):
                    raise TemplateError("a generation inside a generation")
                open_tags.append((word, None, [], nodes))
                nodes = []
            elif word == "if":
                open_tags.append(("if", _Expression(rest, filters).whole(), [], nodes))
                nodes = []
            elif word in ("elif", "else") and open_tags and open_tags[-1][0] == "if":
                _, test, branches, outer = open_tags.pop()
                if test is True or (word == "else" and rest):
                    raise TemplateError(f"{word} is out of place")
                branches.append((test, nodes))
                new = _Expression(rest, filters).whole() if word == "elif" else True
                open_tags.append(("if", new, branches, outer))
                nodes = []
            elif word in ("endif", "endfor", "endgeneration") and not rest:
                if not open_tags or open_tags[-1][0] != word[3:]:
                    raise TemplateError(f"{word} is out of place")
                kind, arg, branches, outer = open_tags.pop()
                if kind == "if":
                    outer.append(("if", [*branches, (("const", True) if arg is True else arg, nodes)]))
                else:
                    outer.append((kind, arg, nodes))
                nodes = outer
            else:
                raise TemplateError(f"unknown tag {body!r}")
    if open_tags:
        raise TemplateError(f"{open_tags[-1][0]} is not closed")
    return ("block", root)


# --- folding -------------------------------------------------------------------------------------


def fold_expression(node: tuple, filters: Mapping[str, Callable[[str], str]]) -> tuple:
    """The expression with every part that needs no message evaluated."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "key":
        return ("key", fold_expression(node[1], filters), node[2])
    if kind == "filter":
        inner = fold_expression(node[2], filters)
        return ("const", filters[node[1]](shown(inner[1]))) if inner[0] == "const" else (kind, node[1], inner)
    parts = [fold_expression(x, filters) for x in node[1:]]
    if all(x[0] == "const" for x in parts):
        return ("const", _expression((kind, *parts), filters)({}))
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    return (kind, *parts)


def fold(nodes: list[tuple], filters: Mapping[str, Callable[[str], str]]) -> list[tuple]:
    """Nodes with folded expressions, dead branches removed and neighbouring text joined."""
    out: list[tuple] = []
    for node in nodes:
        new: list[tuple] = [node]
        if node[0] == "out":
            inner = fold_expression(node[1], filters)
            new = [("text", shown(inner[1]))] if inner[0] == "const" else [("out", inner)]
        elif node[0] in ("for", "generation"):
            new = [(node[0], node[1], fold(node[2], filters))]
        elif node[0] == "if":
            branches: list[tuple] = []
            for test, body in node[1]:
                test = fold_expression(test, filters)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold(body, filters)))
                if test[0] == "const":
                    break
            certain = branches and branches[0][0][0] == "const"
            new = branches[0][1] if certain else [("if", branches)] if branches else []
        for x in new:
            if x[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + x[1])
            elif x != ("text", ""):
                out.append(x)
    return out


# --- closures ------------------------------------------------------------------------------------


def _expression(node: tuple, filters: Mapping[str, Callable[[str], str]]) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "key":
        inner, key = _expression(node[1], filters), node[2]
        return lambda env: held.get(key) if isinstance(held := inner(env), Mapping) else None
    if kind == "filter":
        call, inner = filters[node[1]], _expression(node[2], filters)
        return lambda env: call(shown(inner(env)))
    if kind == "not":
        inner = _expression(node[1], filters)
        return lambda env: not inner(env)
    a, b = (_expression(x, filters) for x in node[1:])
    return {
        "~": lambda env: shown(a(env)) + shown(b(env)),
        "==": lambda env: a(env) == b(env),
        "!=": lambda env: a(env) != b(env),
        "in": lambda env: shown(a(env)) in shown(b(env)),
        "and": lambda env: a(env) and b(env),
        "or": lambda env: a(env) or b(env),
    }[kind]


def _closure(nodes: list[tuple], filters, generated: bool) -> Callable[[dict, Iterable], Pieces]:
    steps = [_step(n, filters, generated) for n in nodes]

    def run(env: dict, messages: Iterable) -> Pieces:
        for step in steps:
            yield from step(env, messages)

    return run


def _step(node: tuple, filters, generated: bool) -> Callable[[dict, Iterable], Pieces]:
    kind = node[0]
    if kind == "text":
        piece = [(node[1], generated)]
        return lambda env, messages: iter(piece)
    if kind == "out":
        value = _expression(node[1], filters)
        return lambda env, messages: iter([(shown(value(env)), generated)])
    if kind == "generation":
        return _closure(node[2], filters, True)
    if kind == "if":
        branches = [(_expression(t, filters), _closure(b, filters, generated)) for t, b in node[1]]

        def choose(env: dict, messages: Iterable) -> Pieces:
            for test, body in branches:
                if test(env):
                    yield from body(env, messages)
                    return

        return choose
    name, body = node[1], _closure(node[2], filters, generated)

    def loop(env: dict, messages: Iterable) -> Pieces:
        after, place = iter(messages), 0
        last = object()
        here = next(after, last)
        while here is not last:
            following = next(after, last)
            state = {"first": place == 0, "last": following is last, "index0": place}
            yield from body({**env, name: here, "loop": state}, ())
            here, place = following, place + 1

    return loop


def compile_template(
    source: str, filters: Mapping[str, Callable[[str], str]] | None = None
) -> Callable[[Iterable[Mapping[str, Any]], Mapping[str, Any]], Pieces]:
    """A function of (messages, variables) that yields pieces ``(text, generated)``.

    ``messages`` may be an iterator: it is read once, one message ahead of what is rendered.
    """
    filters = dict(filters or {})
    kind, nodes = parse(source, filters)
    run = _closure(fold(nodes, filters), filters, False)
    return lambda messages, variables=(): run(dict(variables), messages)
