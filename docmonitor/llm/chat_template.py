"""A small sandboxed template language for conversations, compiled to closures.

    {% for m in messages %}...{% endfor %}        turns, once and in order
    {% if EXPR %}...{% elif EXPR %}...{% else %}...{% endif %}
    {% generation %}...{% endgeneration %}        text the model is to learn
    {{ EXPR }}        EXPR: 'text', m.role, m.text, loop.first, loop.last, ==, !=, and, or, not,
                      ~ (join), | filter, ( )

There are no calls, no other names or attributes and no loops but the one over the turns, so a
template can neither reach anything nor run longer than its conversation.  A template is
parsed into a tree, constants are folded, and each node becomes a closure that appends to the
output.  The turns are rendered one by one: what stands before and after the loop belongs to the
first and the last turn, so a conversation of any length needs no more memory than a turn.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

TOKENS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
WORDS = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?)|(==|!=|[~|()]))", re.S)
LOOP = re.compile(r"for\s+([A-Za-z_]\w*)\s+in\s+messages")
FIELDS = {"role": "role", "text": "text"}
FLAGS = ("loop.first", "loop.last")


class TemplateError(ValueError):
    pass


# -- control strings ----------------------------------------------------------------
def escape(text: str) -> str:
    """Text without ``<|``, so that no control string stands in it; reversible."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    """The same on one line: line ends become a backslash and an ``n``."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_line": escape_line, "trim": str.strip}


# -- tree -----------------------------------------------------------------------------
@dataclass(frozen=True)
class Const:
    value: str | bool


@dataclass(frozen=True)
class Name:
    name: str  # a field of the turn, or a flag


@dataclass(frozen=True)
class Apply:
    op: str  # "==", "!=", "and", "or", "not", "~", or "|name"
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "and": lambda a, b: a and b, "or": lambda a, b: a or b,
    "not": lambda a: not a, "~": lambda a, b: shown(a) + shown(b),
    **{f"|{name}": (lambda a, f=f: f(shown(a))) for name, f in FILTERS.items()},
}


def shown(value) -> str:
    return value if isinstance(value, str) else str(value).lower()


# -- parser ---------------------------------------------------------------------------
class _Expression:
    def __init__(self, source: str, variable: str | None):
        self.words, at = [], 0
        while at < len(source) and source[at:].strip():
            m = WORDS.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.words.append((m.lastindex, m[m.lastindex]))
            at = m.end()
        self.variable, self.at = variable, 0

    def next(self, *wanted: str) -> bool:
        if self.at < len(self.words) and self.words[self.at][0] != 1 and self.words[self.at][1] in wanted:
            self.at += 1
            return True
        return False

    def whole(self):
        tree = self.either()
        if self.at != len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.next("or"):
            tree = Apply("or", (tree, self.both()))
        return tree

    def both(self):
        tree = self.negated()
        while self.next("and"):
            tree = Apply("and", (tree, self.negated()))
        return tree

    def negated(self):
        return Apply("not", (self.negated(),)) if self.next("not") else self.compared()

    def compared(self):
        tree = self.joined()
        for op in ("==", "!="):
            if self.next(op):
                return Apply(op, (tree, self.joined()))
        return tree

    def joined(self):
        tree = self.filtered()
        while self.next("~"):
            tree = Apply("~", (tree, self.filtered()))
        return tree

    def filtered(self):
        tree = self.single()
        while self.next("|"):
            name = self.words[self.at][1] if self.at < len(self.words) else ""
            if name not in FILTERS:
                raise TemplateError(f"no such filter: {name!r}")
            self.at += 1
            tree = Apply(f"|{name}", (tree,))
        return tree

    def single(self):
        if self.next("("):
            tree = self.either()
            if not self.next(")"):
                raise TemplateError("missing )")
            return tree
        if self.at == len(self.words):
            raise TemplateError("expression ends early")
        kind, word = self.words[self.at]
        self.at += 1
        if kind == 1:
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), word[1:-1], flags=re.S))
        if word in FLAGS and self.variable:
            return Name(word)
        if word in ("true", "false"):
            return Const(word == "true")
        owner, _, field = word.partition(".")
        if kind == 2 and owner == self.variable and field in FIELDS:
            return Name(FIELDS[field])
        raise TemplateError(f"not allowed here: {word!r}")


def parse(source: str) -> tuple:
    """The template's tree: nodes of its top level."""
    pieces, at = [], 0
    for m in TOKENS.finditer(source):
        pieces.append(("text", source[at:m.start()]))
        pieces.append(("output", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", source[at:]))
    place = 0

    def block(ends: tuple[str, ...], variable: str | None, loops: bool, learned: bool):
        """Nodes up to one of ``ends``, and the tag that ended them."""
        nonlocal place
        nodes = []
        while place < len(pieces):
            kind, body = pieces[place]
            place += 1
            if kind == "text":
                nodes += [Output(Const(body))] if body else []
            elif kind == "output":
                nodes.append(Output(_Expression(body, variable).whole()))
            elif body.split(" ")[0] in ends:
                return tuple(nodes), body
            elif body.startswith("if "):
                nodes.append(branch(body[3:], variable, learned))
            elif body == "generation" and variable and not learned:
                nodes.append(Generation(block(("endgeneration",), variable, False, True)[0]))
            elif (m := LOOP.fullmatch(body)) and loops and m[1] != "loop":
                nodes.append(Loop(m[1], block(("endfor",), m[1], False, False)[0]))
            else:
                raise TemplateError(f"unexpected tag: {body!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(nodes), ""

    def branch(test: str, variable: str | None, learned: bool) -> If:
        condition = _Expression(test, variable).whole()
        then, tag = block(("elif", "else", "endif"), variable, False, learned)
        if tag.startswith("elif "):
            return If(condition, then, (branch(tag[5:], variable, learned),))
        if tag not in ("else", "endif"):
            raise TemplateError(f"unexpected tag: {tag!r}")
        return If(condition, then, block(("endif",), variable, False, learned)[0] if tag == "else" else ())

    nodes, _ = block((), None, True, False)
    if sum(isinstance(n, Loop) for n in nodes) != 1:
        raise TemplateError("a template has one loop over messages")
    return nodes


# -- folding ----------------------------------------------------------------------------
def fold(node):
    """A node without operations on constants, or (for a block) without needless nodes."""
    if isinstance(node, tuple):
        out = []
        for n in map(fold, node):
            for x in n if isinstance(n, tuple) else (n,):
                if isinstance(x, Output) and isinstance(x.value, Const):
                    text = shown(x.value.value)
                    if not text:
                        continue
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                        text = out.pop().value.value + text
                    x = Output(Const(text))
                out.append(x)
        return tuple(out)
    if isinstance(node, Apply):
        args = tuple(map(fold, node.args))
        if all(isinstance(a, Const) for a in args):
            return Const(OPERATIONS[node.op](*(a.value for a in args)))
        if node.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
        return Apply(node.op, args)
    if isinstance(node, Output):
        return Output(fold(node.value))
    if isinstance(node, If):
        test, then, other = fold(node.test), fold(node.then), fold(node.other)
        if isinstance(test, Const):
            return then if test.value else other
        return If(test, then, other) if then or other else ()
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return Loop(node.name, fold(node.body)) if isinstance(node, Loop) else node


# -- closures -----------------------------------------------------------------------------
class Sink:
    """Rendered text, and the spans of it that are to be learned."""

    def __init__(self):
        self.parts, self.size, self.spans = [], 0, []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda turn: value
    if isinstance(node, Name):
        name = node.name
        return lambda turn: turn[name]
    if node.op in ("and", "or"):
        a, b = map(_value, node.args)
        return (lambda turn: a(turn) and b(turn)) if node.op == "and" else (lambda turn: a(turn) or b(turn))
    run = OPERATIONS[node.op]
    if len(node.args) == 1:
        a = _value(node.args[0])
        return lambda turn: run(a(turn))
    a, b = map(_value, node.args)
    return lambda turn: run(a(turn), b(turn))


def _block(nodes: tuple) -> Callable[[dict, Sink], None]:
    steps = [_step(n) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(turn: dict, out: Sink) -> None:
        for step in steps:
            step(turn, out)

    return run


def _step(node) -> Callable[[dict, Sink], None]:
    if isinstance(node, Output):
        if isinstance(node.value, Const):
            text = node.value.value
            return lambda turn, out: out.write(text)
        value = _value(node.value)
        return lambda turn, out: out.write(shown(value(turn)))
    if isinstance(node, If):
        test, then, other = _value(node.test), _block(node.then), _block(node.other)
        return lambda turn, out: then(turn, out) if test(turn) else other(turn, out)
    body = _block(node.body)

    def learned(turn: dict, out: Sink) -> None:
        start = out.size
        body(turn, out)
        out.spans.append((start, out.size))

    return learned


class Template:
    """A compiled template; ``render`` writes one turn."""

    def __init__(self, source: str):
        tree = fold(parse(source))
        at = next(i for i, n in enumerate(tree) if isinstance(n, Loop))
        self.before, self.turn, self.after = _block(tree[:at]), _block(tree[at].body), _block(tree[at + 1:])

    def render(self, role: str, text: str, first: bool, last: bool, out: Sink) -> None:
        turn = {"role": role, "text": text, "loop.first": first, "loop.last": last}
        if first:
            self.before(turn, out)
        self.turn(turn, out)
        if last:
            self.after(turn, out)
