"""A small sandboxed template language for conversations.

    {{ expression }}                       output
    {% for name in name %} ... {% endfor %}
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}   marks what a model learns to write

Expressions: strings, names, ``row.field``, ``==``, ``!=``, ``and``, ``or``,
``not``, ``~`` (joins texts), ``| filter``. Names reach only the values given to
render and the fields of mappings; there are no calls, attributes, indices or
arithmetic, so a template can't reach Python objects.

``compile_template`` parses to a syntax tree, folds constants (joined literal
texts, constant filters, conditions that are known), and returns a closure that
yields (text, generated) pieces one by one, so a conversation of any length
renders in the memory of one row."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
TOKEN = re.compile(r"""\s*(?:("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|([A-Za-z_][\w.]*)|(==|!=|~|\||\(|\)))""")
WORDS = {"and", "or", "not", "true", "false"}


class TemplateError(ValueError):
    pass


class _Expression:
    """Recursive descent over one expression; nodes are tuples."""

    def __init__(self, source: str, filters: dict):
        self.filters, self.source, self.tokens, at = filters, source, [], 0
        source = source.strip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read expression at {source[at:]!r}")
            self.tokens.append(m.group(1) or m.group(2) or m.group(3))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self, *wanted):
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1]
        return None

    def parse(self):
        node = self.either()
        if self.peek() is not None:
            raise TemplateError(f"unexpected {self.peek()!r} in {self.source!r}")
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        if op := self.take("==", "!="):
            node = (op, node, self.joined())
        return node

    def joined(self):
        node = self.filtered()
        while self.take("~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self):
        node = self.atom()
        while self.take("|"):
            name = self.peek()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def atom(self):
        t = self.peek()
        if t is None:
            raise TemplateError(f"expression {self.source!r} ends early")
        self.at += 1
        if t == "(":
            node = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return node
        if t[0] in "\"'":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), t[1:-1], flags=re.S))
        if t in ("true", "false"):
            return ("const", t == "true")
        if t in WORDS or not re.fullmatch(r"[A-Za-z][\w]*(\.[A-Za-z][\w]*)?", t):
            raise TemplateError(f"{t!r} is not a name")
        return ("name", *t.split("."))


def _text(value) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def _fold(node, filters):
    """Constant folding of expressions, bottom up."""
    if node[0] in ("const", "name"):
        return node
    if node[0] == "filter":
        inner = _fold(node[2], filters)
        return ("const", filters[node[1]](_text(inner[1]))) if inner[0] == "const" else ("filter", node[1], inner)
    parts = [_fold(p, filters) for p in node[1:]]
    if all(p[0] == "const" for p in parts):
        return ("const", _closure((node[0], *parts), filters)({}))
    if node[0] in ("and", "or") and parts[0][0] == "const":
        return parts[0] if bool(parts[0][1]) == (node[0] == "or") else parts[1]
    if node[0] == "~" and parts[1][0] == "const" and parts[0][0] == "~" and parts[0][2][0] == "const":
        return ("~", parts[0][1], ("const", _text(parts[0][2][1]) + _text(parts[1][1])))
    return (node[0], *parts)


def _closure(node, filters) -> Callable:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        first, field = node[1], node[2] if len(node) > 2 else None

        def name(env):
            if first not in env:
                raise TemplateError(f"no value {first!r}")
            value = env[first]
            if field is None:
                return value
            if not isinstance(value, dict):
                raise TemplateError(f"{first!r} has no fields")
            return value.get(field)
        return name
    if kind == "filter":
        apply, inner = filters[node[1]], _closure(node[2], filters)
        return lambda env: apply(_text(inner(env)))
    a = _closure(node[1], filters)
    if kind == "not":
        return lambda env: not a(env)
    b = _closure(node[2], filters)
    return {"or": lambda env: a(env) or b(env), "and": lambda env: a(env) and b(env), "==": lambda env: a(env) == b(env),
            "!=": lambda env: a(env) != b(env), "~": lambda env: _text(a(env)) + _text(b(env))}[kind]


def parse_template(source: str, filters: dict) -> list:
    """Syntax tree: ("text", s), ("out", e), ("for", name, items, body),
    ("if", [(condition, body), ...]), ("generation", body)."""
    stack, body = [], []
    for part in TAG.split(source):
        if part.startswith("{{"):
            body.append(("out", _fold(_Expression(part[2:-2], filters).parse(), filters)))
        elif part.startswith("{%"):
            word, _, rest = part[2:-2].strip().partition(" ")
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+([A-Za-z]\w*)\s*", rest)
                if not m:
                    raise TemplateError(f"cannot read {part!r}")
                stack.append((body, ("for", m[1], m[2])))
                body = []
            elif word == "if":
                stack.append((body, ("if", [], _fold(_Expression(rest, filters).parse(), filters))))
                body = []
            elif word in ("elif", "else"):
                if not stack or stack[-1][1][0] != "if":
                    raise TemplateError(f"{word} without if")
                outer, (_, branches, condition) = stack.pop()
                following = ("const", True) if word == "else" else _fold(_Expression(rest, filters).parse(), filters)
                stack.append((outer, ("if", [*branches, (condition, body)], following)))
                body = []
            elif word == "generation":
                stack.append((body, ("generation",)))
                body = []
            elif word.startswith("end"):
                if not stack or stack[-1][1][0] != word[3:]:
                    raise TemplateError(f"{word} without {word[3:]}")
                outer, open_ = stack.pop()
                if open_[0] == "if":
                    node = ("if", [*open_[1], (open_[2], body)])
                else:
                    node = (*open_, body)
                outer.append(node)
                body = outer
            else:
                raise TemplateError(f"no tag {word!r}")
        elif part:
            body.append(("text", part))
    if stack:
        raise TemplateError(f"{stack[-1][1][0]} isn't closed")
    return body


def fold_constants(body: list) -> list:
    """Constant outputs become text, neighbouring texts one text, branches whose
    condition is known go or stay without a test."""
    out: list = []

    def add(node):
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        if node[0] == "out" and node[1][0] == "const":
            add(("text", _text(node[1][1])))
        elif node[0] == "if":
            branches = []
            for condition, inner in node[1]:
                if condition[0] == "const" and not condition[1]:
                    continue
                branches.append((condition, fold_constants(inner)))
                if condition[0] == "const":
                    break
            if branches and branches[0][0][0] == "const":
                for x in branches[0][1]:
                    add(x)
            elif branches:
                add(("if", branches))
        elif node[0] in ("for", "generation"):
            inner = fold_constants(node[-1])
            if inner or node[0] == "for":
                add((*node[:-1], inner))
        else:
            add(node)
    return out


def compile_template(source: str, filters: dict[str, Callable[[str], str]]) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    """A closure from values to (text, generated) pieces."""
    def block(body, generated):
        steps = [step(n, generated) for n in body]

        def run(env):
            for s in steps:
                yield from s(env)
        return run

    def step(node, generated):
        kind = node[0]
        if kind == "text":
            piece = (node[1], generated)
            return lambda env: (piece,)
        if kind == "out":
            value = _closure(node[1], filters)
            return lambda env: ((_text(value(env)), generated),)
        if kind == "generation":
            return block(node[1], True)
        if kind == "for":
            name, items, inner = node[1], node[2], block(node[3], generated)

            def loop(env):
                if items not in env:
                    raise TemplateError(f"no value {items!r}")
                for x in env[items]:
                    yield from inner({**env, name: x})
            return loop
        branches = [(_closure(c, filters), block(b, generated)) for c, b in node[1]]

        def choose(env):
            for condition, inner in branches:
                if condition(env):
                    yield from inner(env)
                    return
        return choose

    return block(fold_constants(parse_template(source, filters)), False)
