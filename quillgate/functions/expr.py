"""Expressions of the hardware language: reading, folding, size, wording."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rtl import lex

_PRECEDENCE = [["||"], ["&&"], ["|"], ["^", "~^", "^~"], ["&"], ["==", "!=", "===", "!==", "==?", "!=?"], ["<", "<=", ">", ">="], ["<<", ">>", "<<<", ">>>"], ["+", "-"], ["*", "/", "%"], ["**"]]
_RADIX = {"b": 2, "o": 8, "d": 10, "h": 16}
_UNARY = ("~", "!", "-", "+", "&", "|", "^", "~&", "~|", "~^", "^~", "++", "--")


def literal(token: str) -> int | None:
    """Value of a number; None for fill literals, digits x or z, and numbers with a fraction."""
    token = token.replace("_", "").replace(" ", "")
    if "'" not in token:
        return int(token) if token.isdigit() else None
    m = re.fullmatch(r"\d*'[sS]?([bodhBODH])([0-9a-fA-F]+)", token)
    try:
        return int(m[2], _RADIX[m[1].lower()]) if m else None
    except ValueError:
        return None


def has_xz(token: str) -> bool:
    """Whether a based number has digits that are no value."""
    return bool(re.fullmatch(r"\d*\s*'[sS]?[bodhBODH]?\s*[0-9a-fA-F_xXzZ?]*[xXzZ?][0-9a-fA-F_xXzZ?]*", token))


def literal_width(token: str) -> int | None:
    """Stated width of a sized number."""
    m = re.match(r"(\d+)\s*'", token.replace("_", ""))
    return int(m[1]) if m else None


class Reader:
    """Recursive descent over a token list; nodes are tuples (operator, children...)."""

    def __init__(self, text: str | list[str]):
        self.t = lex.tokens(text)[0] if isinstance(text, str) else text
        self.i = 0

    def peek(self, ahead: int = 0) -> str | None:
        i, t = self.i + ahead, self.t
        return t[i] if i < len(t) else None

    def take(self, *want: str) -> str:
        x = self.peek()
        if x is None or want and x not in want:
            raise ValueError(f"expected {' or '.join(want) or 'a token'}, found {x}")
        self.i += 1
        return x

    def have(self, *want: str) -> bool:
        if self.i < len(self.t) and self.t[self.i] in want:
            self.i += 1
            return True
        return False

    def ternary(self):
        c = self.binary(0)
        if self.have("?"):
            a = self.ternary()
            self.take(":")
            return ("?", c, a, self.ternary())
        return c

    def binary(self, level: int):
        """Operators by precedence climbing; all but the power bind to the left."""
        if level >= len(_PRECEDENCE):
            return self.unary()
        x = self.unary()
        return self._climb(x, level)

    def _climb(self, left, level: int):
        while True:
            op = self.peek()
            at = _LEVEL.get(op, -1)
            if at < level:
                if op == "inside" and level <= 6:
                    self.take()
                    left = ("inside", left, *self.listed("{", "}"))
                    continue
                return left
            self.take()
            right = self.unary()
            while _LEVEL.get(self.peek(), -1) > at:
                right = self._climb(right, _LEVEL[self.peek()])
            left = (op, left, right)

    def listed(self, first: str, last: str) -> list:
        self.take(first)
        out = []
        while not self.have(last):
            if self.have("["):  # a range of values
                a = self.ternary()
                self.take(":")
                out.append(("range", a, self.ternary()))
                self.take("]")
            else:
                out.append(self.ternary())
            if self.peek() != last:
                self.take(",")
        return out

    def unary(self):
        if self.peek() in _UNARY:
            return ("u" + self.take(), self.unary())
        return self.postfix()

    def braces(self, close: str = "}"):
        if self.have(close):
            return ("{}",)
        if self.peek() in ("<<", ">>"):  # streaming
            self.take()
            parts = self.listed("{", "}") if self.peek() == "{" else [self.ternary()] + self.listed("{", "}")
            self.take(close)
            return ("call", "$stream", *parts)
        first = self.pattern_item()
        if self.peek() == "{":
            inner = self.listed("{", "}")
            self.take(close)
            return ("{n}", first, ("{}", *inner))
        parts = [first]
        while self.have(","):
            parts.append(self.pattern_item())
        self.take(close)
        return ("{}", *parts)

    def pattern_item(self):
        x = ("ref", self.take()) if self.peek() == "default" else self.ternary()
        return ("key", x, self.ternary()) if self.have(":") else x

    def postfix(self):
        x = self.take()
        if x in ("(", "'("):
            node = self.ternary()
            self.take(")")
        elif x in ("{", "'{"):
            node = self.braces()
        elif x[0] == '"':
            node = ("str", x)
        elif x[0].isdigit() or x[0] == "'" and len(x) > 1:
            node = ("lit", x)
        elif x[0].isalpha() or x[0] in "_$\\`":
            while self.peek() == "::":
                self.take()
                x += "::" + self.take()
            node = ("ref", x)
            if self.peek() == "(" and (x[0] == "$" or self.calls):
                node = ("call", x, *self.listed("(", ")"))
        else:
            raise ValueError(f"unexpected {x}")
        while self.peek() in ("[", ".", "'("):
            op = self.take()
            if op == ".":
                node = (".", node, ("ref", self.take()))
            elif op == "'(":
                node = ("cast", node, self.ternary())
                self.take(")")
            else:
                a = self.ternary()
                if self.peek() in (":", "+:", "-:"):
                    node = ("[" + self.take() + "]", node, a, self.ternary())
                else:
                    node = ("[]", node, a)
                self.take("]")
        return node

    #: Whether a name before a parenthesis is a call.
    calls = True


_LEVEL = {op: k for k, ops in enumerate(_PRECEDENCE) for op in ops}


def read(text: str):
    r = Reader(text)
    node = r.ternary()
    if r.peek() is not None:
        raise ValueError(f"left over {r.peek()}")
    return node


def kids(node) -> list:
    return [c for c in node[1:] if isinstance(c, tuple)]


def size(node) -> int:
    return 1 + sum(map(size, kids(node)))


def depth(node) -> int:
    return 1 + max(map(depth, kids(node)), default=0)


def refs(node) -> list[str]:
    """Names an expression reads; field names and keys of patterns aren't read."""
    out: list[str] = []
    _refs(node, out)
    return out


def _refs(node, out: list[str]) -> None:
    op = node[0]
    if op == "ref":
        out.append(node[1])
    elif op == ".":
        _refs(node[1], out)
    elif op in ("key", "cast"):
        _refs(node[2], out)
    else:
        for c in node[1:]:
            if isinstance(c, tuple):
                _refs(c, out)


def fold(node, names: dict[str, int] | None = None) -> int | None:
    """Constant value of a tree, None where any part is unknown, at division by zero, shifts of 256 or more and exponents of 64 or more."""
    op = node[0]
    if op == "lit":
        return literal(node[1])
    if op == "ref":
        return (names or {}).get(node[1])
    if op == "cast":
        return fold(node[2], names)
    if op == "call":
        v = fold(node[2], names) if node[1] in ("$clog2", "$signed", "$unsigned") and len(node) == 3 else None
        return None if v is None else v if node[1] != "$clog2" else None if v < 0 else max(v - 1, 0).bit_length()
    if op in ("{}", "{n}", "[]", "[:]", "[+:]", "[-:]", ".", "str", "inside", "key", "range"):
        return None
    v = [fold(c, names) for c in kids(node)]
    if op == "?":
        return None if v[0] is None else v[1] if v[0] else v[2]
    if None in v:
        return None
    if op[0] == "u" and len(op) > 1:
        return {"~": lambda x: ~x, "!": lambda x: int(not x), "-": lambda x: -x, "+": lambda x: x, "|": lambda x: int(x != 0), "~|": lambda x: int(x == 0), "^": lambda x: x.bit_count() & 1 if x >= 0 else None}.get(op[1:], lambda x: None)(v[0])
    a, b = v
    if op in ("/", "%") and not b or op in ("<<", ">>", "<<<", ">>>") and not 0 <= b < 256 or op == "**" and not 0 <= b < 64:
        return None
    return {
        "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a // b, "%": lambda: a % b, "**": lambda: a**b, "<<": lambda: a << b, ">>": lambda: a >> b, "<<<": lambda: a << b, ">>>": lambda: a >> b,
        "&": lambda: a & b, "|": lambda: a | b, "^": lambda: a ^ b, "~^": lambda: ~(a ^ b), "^~": lambda: ~(a ^ b), "&&": lambda: int(bool(a and b)), "||": lambda: int(bool(a or b)), "==": lambda: int(a == b), "!=": lambda: int(a != b),
        "===": lambda: int(a == b), "!==": lambda: int(a != b), "==?": lambda: int(a == b), "!=?": lambda: int(a != b), "<": lambda: int(a < b), "<=": lambda: int(a <= b), ">": lambda: int(a > b), ">=": lambda: int(a >= b),
    }[op]()


# Comparisons in words, and the word of the opposite (fixed values).
COMPARISON = {"==": "is", "===": "is", "!=": "is not", "!==": "is not", "<": "is less than", "<=": "is at most", ">": "is greater than", ">=": "is at least"}
OPPOSITE = {"is": "is not", "is not": "is", "is less than": "is at least", "is at most": "is greater than", "is greater than": "is at most", "is at least": "is less than"}


def wording(node, negated: bool = False) -> str:
    """A condition in words; negation is pushed inwards. What has no words is a condition on its signals."""
    op = node[0]
    if op in ("&&", "||"):
        return f" {'or' if (op == '&&') == negated else 'and'} ".join(wording(c, negated) for c in kids(node))
    if op in ("u!", "u~"):
        return wording(node[1], not negated)
    if op in COMPARISON:
        a, b = (operand(c) for c in kids(node))
        if a and b:
            return f"{a} {OPPOSITE[COMPARISON[op]] if negated else COMPARISON[op]} {b}"
    x = operand(node) if op in ("ref", "lit", "[]", "[:]", ".") else None
    if x:
        return f"{x} is {0 if negated else 1}"
    names = sorted(set(refs(node)))
    return f"{'not ' if negated else ''}a condition on {', '.join(names)}" if names else "an unknown condition"


def operand(node) -> str | None:
    """A value in words: a number, a name, or an element, bits or a field of a name; None for anything else."""
    if node[0] == "lit":
        v = literal(node[1])
        return node[1] if v is None else str(v)
    if node[0] == "ref":
        return node[1]
    if node[0] == "[]" and operand(node[1]) and operand(node[2]):
        return f"element {operand(node[2])} of {operand(node[1])}"
    if node[0] == "[:]" and operand(node[1]) and operand(node[2]) and operand(node[3]):
        return f"bits {operand(node[2])} to {operand(node[3])} of {operand(node[1])}"
    if node[0] == "." and operand(node[1]):
        return f"field {node[2][1]} of {operand(node[1])}"
    return None


def show(node) -> str:
    """An expression as text again, with one way of writing it."""
    op = node[0]
    if op in ("lit", "ref", "str"):
        return node[1]
    k = [show(c) for c in kids(node)]
    if op == "?":
        return f"({k[0]} ? {k[1]} : {k[2]})"
    if op == "{}":
        return "{" + ", ".join(k) + "}"
    if op == "{n}":
        return "{" + k[0] + k[1] + "}"
    if op == "call":
        return f"{node[1]}({', '.join(k)})"
    if op == "cast":
        return f"{k[0]}'({k[1]})"
    if op == "[]":
        return f"{k[0]}[{k[1]}]"
    if op in ("[:]", "[+:]", "[-:]"):
        return f"{k[0]}[{k[1]}{op[1:-1]}{k[2]}]"
    if op == ".":
        return f"{k[0]}.{k[1]}"
    if op == "inside":
        return f"({k[0]} inside {{{', '.join(k[1:])}}})"
    if op in ("key", "range"):
        return f"{k[0]}:{k[1]}"
    if op[0] == "u" and len(k) == 1:
        return op[1:] + k[0]
    return f"({k[0]} {op} {k[1]})"


@F.pandas_udf(T.StructType([T.StructField("nodes", T.IntegerType()), T.StructField("depth", T.IntegerType()), T.StructField("value", T.StringType()), T.StructField("wording", T.StringType())]))
def expression_facts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Nodes, depth, folded value and wording of an expression; all null where it can't be read."""
    for texts in batches:
        rows = []
        for t in texts:
            try:
                n = read(t)
                v = fold(n)
                rows.append((size(n), depth(n), None if v is None else str(v), wording(n)))
            except (ValueError, AttributeError, TypeError, RecursionError):
                rows.append((None, None, None, None))
        yield pd.DataFrame(rows, columns=["nodes", "depth", "value", "wording"]).astype({"nodes": "Int32", "depth": "Int32"})


def nodes(node) -> Iterator:
    """A tree's nodes, the root first."""
    yield node
    for c in kids(node):
        yield from nodes(c)


@F.pandas_udf(T.ArrayType(T.StringType()))
def node_kinds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The operators of an expression's nodes, the root first; null where it can't be read."""
    for texts in batches:
        out = []
        for t in texts:
            try:
                out.append([n[0] for n in nodes(read(t))])
            except (ValueError, TypeError, RecursionError):
                out.append(None)
        yield pd.Series(out, dtype="object")
