"""Recursive descent over whole texts: modules with ports, parameters, declarations, assignments, processes and instances as plain records.

Statements are records with ``k``: assign, block, if, case, loop, timing, opaque, null; if, case and loop have an ``id`` unique in their module. What isn't known is
skipped to its end and counted in ``opaque``; a text that breaks off gives the modules that were whole.
"""

from __future__ import annotations

from ..functions.expr import Reader
from . import lex

_DIRECTIONS = ("input", "output", "inout", "ref")
_NETS = ("wire", "tri", "tri0", "tri1", "wand", "wor", "supply0", "supply1", "uwire")
_VARIABLES = ("reg", "logic", "bit", "byte", "shortint", "int", "longint", "integer", "time", "real", "realtime", "string", "genvar", "var")
_PROCESSES = ("always", "always_ff", "always_comb", "always_latch", "initial", "final")
_ENDS = {"function": "endfunction", "task": "endtask", "property": "endproperty", "sequence": "endsequence", "covergroup": "endgroup", "specify": "endspecify", "class": "endclass", "clocking": "endclocking", "checker": "endchecker", "primitive": "endprimitive", "table": "endtable", "config": "endconfig", "program": "endprogram"}
_OPS = ("+=", "-=", "*=", "/=", "%=", "&=", "|=", "^=", "<<=", ">>=", "<<<=", ">>>=")


class Parser(Reader):
    def __init__(self, text: str, defines: dict[str, str] | None = None):
        t, self.lines = lex.tokens(lex.preprocess(text, defines))
        super().__init__(t)
        self.packages: dict[str, dict] = {}

    def line(self) -> int:
        return self.lines[min(self.i, len(self.lines) - 1)] if self.lines else 0

    def name(self) -> str:
        x = self.take()
        if not (x[0].isalpha() or x[0] in "_\\"):
            raise ValueError(f"expected a name, found {x}")
        return x

    def is_name(self, ahead: int = 0) -> bool:
        x = self.peek(ahead)
        return x is not None and (x[0].isalpha() or x[0] in "_\\")

    def skip_to(self, *ends: str) -> None:
        """Past the next of ``ends`` that isn't inside brackets."""
        depth = 0
        while (x := self.peek()) is not None:
            self.i += 1
            if x in ("(", "[", "{", "'{", "'("):
                depth += 1
            elif x in (")", "]", "}"):
                depth -= 1
            elif depth <= 0 and x in ends:
                return

    # ------------------------------------------------------------ texts

    def modules(self) -> list[dict]:
        out = []
        while (x := self.peek()) is not None:
            start = self.i
            if x in ("module", "macromodule"):
                try:
                    out.append(self.module())
                except (ValueError, IndexError, RecursionError):
                    self.i = start + 1
                    while self.peek() not in (None, "endmodule", "module"):
                        self.i += 1
            elif x == "package":
                self.package()
            elif x in _ENDS:
                self.skip_past(_ENDS[x])
            elif x == "interface":
                self.skip_past("endinterface")
            else:
                self.i += 1
        return out

    def skip_past(self, end: str) -> None:
        while self.peek() not in (None, end):
            self.i += 1
        self.have(end)

    def package(self) -> None:
        self.take("package")
        held = _empty(self.name(), self.line())
        self.skip_to(";")
        while self.peek() not in (None, "endpackage"):
            self.item(held, False)
        self.have("endpackage")
        self.packages[held["name"]] = held

    def module(self) -> dict:
        line = self.line()
        self.take("module", "macromodule")
        self.have("automatic", "static")
        m = _empty(self.name(), line)
        while self.have("import"):
            self.skip_to(";")
        if self.have("#"):
            self.take("(")
            self.parameters(m, False, ")")
        if self.have("("):
            self.header(m)
        self.take(";")
        while self.peek() != "endmodule":
            if self.peek() is None:
                raise ValueError("no endmodule")
            self.item(m, False)
        self.take("endmodule")
        if self.have(":"):
            self.name()
        for p in self.packages.values():
            for c in p["params"] + p["enums"]:
                m["foreign"].append({**c, "package": p["name"]})
        return m

    def parameters(self, m: dict, local: bool, end: str, port: bool = True) -> None:
        """Comma lists of parameters up to ``end``."""
        kind = None
        while not self.have(end):
            while self.peek() in ("parameter", "localparam", "type"):
                local = self.take() == "localparam"
                kind = None
            line = self.line()
            signed = False
            dims: list[str] = []
            while not (self.is_name() and self.peek(1) in ("=", ",", end)):
                if self.peek() == "[":
                    dims.append(self.dimension())
                    if self.peek() == "=" or self.peek() is None:
                        break
                elif self.peek() == "signed":
                    signed = bool(self.take())
                elif self.peek() in ("unsigned", "::"):
                    self.take()
                else:
                    kind = self.take()
            name = self.name()
            while self.peek() == "[":
                dims.append(self.dimension())
            value = self.ternary() if self.have("=") else None
            m["params"].append({"name": name, "value": value, "local": local, "port": port, "type": kind, "signed": signed, "packed": dims, "line": line})
            if not self.have(",") and self.peek() != end:
                raise ValueError("parameter list")

    def dimension(self) -> str:
        self.take("[")
        out, depth = "[", 1
        while depth:
            x = self.take()
            depth += (x == "[") - (x == "]")
            out += x
        return out

    def header(self, m: dict) -> None:
        direction, kind, typ, signed, packed = None, None, None, False, []
        while not self.have(")"):
            line = self.line()
            if self.peek() == ".":  # an expression behind a port name
                self.skip_to(",") if self.peek() != ")" else None
                continue
            if self.peek() in _DIRECTIONS:
                direction, kind, typ, signed, packed = self.take(), None, None, False, []
                kind, typ, signed, packed = self.data_type()
            elif not (self.is_name() and self.peek(1) in (",", ")", "[", "=")) or self.peek() in _NETS + _VARIABLES:
                kind, typ, signed, packed = self.data_type()
            name = self.name()
            unpacked = []
            while self.peek() == "[":
                unpacked.append(self.dimension())
            if self.have("="):
                self.ternary()
            m["ports"].append({"name": name, "direction": direction, "kind": kind or "net", "type": typ, "signed": signed, "packed": packed, "unpacked": unpacked, "line": line})
            if not self.have(",") and self.peek() != ")":
                raise ValueError("port list")

    def data_type(self) -> tuple[str, str | None, bool, list[str]]:
        """Kind (net or variable), type, signed, packed dimensions; stops at the declared name."""
        kind, typ, signed, packed = "net", None, False, []
        while True:
            x = self.peek()
            if x in _NETS:
                typ = None if x == "wire" else x
                self.i += 1
            elif x in _VARIABLES:
                kind = "variable"
                typ = x
                self.i += 1
            elif x in ("signed", "unsigned"):
                signed = x == "signed"
                self.i += 1
            elif x == "[":
                packed.append(self.dimension())
            elif self.is_name() and (self.is_name(1) or self.peek(1) == "::" or self.peek(1) == "." and self.is_name(3)):
                typ = self.take()
                while self.peek() in ("::", "."):
                    typ += self.take() + self.take()
                kind = "variable"
            elif self.is_name() and self.peek(1) == "[" and typ is None and self.typed():
                typ, kind = self.take(), "variable"
            else:
                return kind, typ, signed, packed

    def typed(self) -> bool:
        """Whether a name is a type: behind its dimensions stands another name."""
        j = self.i + 1
        while j < len(self.t) and self.t[j] == "[":
            depth = 0
            while j < len(self.t):
                depth += (self.t[j] == "[") - (self.t[j] == "]")
                j += 1
                if not depth:
                    break
        return j < len(self.t) and (self.t[j][0].isalpha() or self.t[j][0] == "_")

    # ------------------------------------------------------------ items

    def item(self, m: dict, generate: bool) -> None:
        x, line = self.peek(), self.line()
        if x in (";", "generate", "endgenerate", "static", "automatic"):
            self.i += 1
        elif x in ("parameter", "localparam"):
            self.take()
            self.parameters(m, x == "localparam", ";", False)
        elif x in _DIRECTIONS:
            self.old_port(m)
        elif x in _PROCESSES:
            m["processes"].append(self.process(m, generate))
        elif x == "assign":
            self.take()
            self.delay()
            while True:
                lhs = self.postfix()
                self.take("=")
                m["assigns"].append({"lhs": lhs, "rhs": self.ternary(), "kind": "continuous", "line": line, "generate": generate})
                if not self.have(","):
                    break
            self.take(";")
        elif x == "typedef":
            self.typedef(m)
        elif x in ("enum", "struct", "union"):
            typ = self.aggregate(m)
            self.declare(m, "variable", typ, False, [], generate)
        elif x in _ENDS:
            m["subroutines"] += x in ("function", "task")
            m["opaque"] += x not in ("function", "task")
            self.skip_past(_ENDS[x])
            if self.have(":"):
                self.name()
        elif x in ("begin",):
            self.generated(m)
        elif x == "for":
            self.take()
            self.skip_group()
            self.generated(m)
        elif x == "if":
            self.take()
            self.skip_group()
            self.generated(m)
            if self.have("else"):
                self.generated(m)
        elif x == "case":
            self.take()
            self.skip_group()
            while not self.have("endcase"):
                self.skip_to(":")
                self.generated(m)
        elif x in ("import", "export", "timeunit", "timeprecision", "defparam", "alias", "assert", "assume", "cover", "bind", "let", "global", "default"):
            m["opaque"] += x not in ("import", "timeunit", "timeprecision")
            self.skip_to(";")
        elif x in _NETS + _VARIABLES or self.is_name() and (self.peek(1) == "::" or self.declares()):
            kind, typ, signed, packed = self.data_type()
            self.declare(m, kind, typ, signed, packed, generate)
        elif self.is_name() and (self.peek(1) == "#" or self.is_name(1)):
            self.instances(m, generate)
        else:
            m["opaque"] += 1
            before = self.i
            if self.is_name() and self.peek(1) == ":":  # a label
                self.i += 2
            else:
                self.skip_to(";")
            self.i = max(self.i, before + 1)

    def declares(self) -> bool:
        """Whether ``NAME [dims] NAME`` starts a declaration rather than an instance: no parenthesis follows the second name."""
        if self.is_name(1):
            j = self.i + 2
            while j < len(self.t) and self.t[j] == "[":
                while j < len(self.t) and self.t[j] != "]":
                    j += 1
                j += 1
            return j < len(self.t) and self.t[j] in (";", ",", "=")
        return self.peek(1) == "[" and self.typed()

    def generated(self, m: dict) -> None:
        if self.have("begin"):
            if self.have(":"):
                self.name()
            while not self.have("end"):
                if self.peek() in (None, "endmodule"):
                    raise ValueError("no end")
                self.item(m, True)
            if self.have(":"):
                self.name()
        else:
            self.item(m, True)

    def skip_group(self) -> None:
        self.take("(")
        depth = 1
        while depth:
            x = self.take()
            depth += (x in ("(", "'(")) - (x == ")")

    def delay(self) -> bool:
        if not self.have("#"):
            return False
        if self.peek() == "(":
            self.skip_group()
        else:
            self.take()
        return True

    def old_port(self, m: dict) -> None:
        """Directions behind the header."""
        direction = self.take()
        kind, typ, signed, packed = self.data_type()
        while True:
            line, name, unpacked = self.line(), self.name(), []
            while self.peek() == "[":
                unpacked.append(self.dimension())
            port = next((p for p in m["ports"] if p["name"] == name), None)
            new = {"name": name, "direction": direction, "kind": kind, "type": typ, "signed": signed, "packed": packed, "unpacked": unpacked, "line": line}
            if port is None:
                m["ports"].append(new)
            else:
                port.update(new)
            if self.have("="):
                self.ternary()
            if not self.have(","):
                break
        self.take(";")

    def declare(self, m: dict, kind: str, typ: str | None, signed: bool, packed: list[str], generate: bool) -> None:
        self.delay()
        while True:
            line, name, unpacked = self.line(), self.name(), []
            while self.peek() == "[":
                unpacked.append(self.dimension())
            port = next((p for p in m["ports"] if p["name"] == name), None)
            if port is not None:  # the type of a port that the header only names
                port.update(kind=kind, type=typ, signed=signed, packed=packed or port["packed"])
            elif typ != "genvar":
                m["signals"].append({"name": name, "kind": kind, "type": typ, "signed": signed, "packed": packed, "unpacked": unpacked, "line": line})
            if self.have("="):
                m["assigns"].append({"lhs": ("ref", name), "rhs": self.ternary(), "kind": "declaration", "line": line, "generate": generate})
            if not self.have(","):
                break
        self.take(";")

    def aggregate(self, m: dict, typedef: bool = False) -> str:
        """enum, struct or union; the members of an enum are constants."""
        word = self.take()
        if word == "enum":
            base = []
            while self.peek() != "{":
                base.append(self.dimension() if self.peek() == "[" else self.take())
            self.take("{")
            while not self.have("}"):
                line, name = self.line(), self.name()
                if self.peek() == "[":
                    self.dimension()
                m["enums"].append({"name": name, "value": self.ternary() if self.have("=") else None, "first": not m["enums"] or m["enums"][-1]["group"] != len(m["groups"]), "group": len(m["groups"]), "packed": [b for b in base if b[0] == "["], "line": line})
                self.have(",")
            m["groups"].append({"packed": [b for b in base if b[0] == "["], "name": None})
        else:
            while self.peek() != "{":
                self.take()
            self.take("{")
            depth = 1
            while depth:
                x = self.take()
                depth += (x == "{") - (x == "}")
        while self.peek() == "[":
            self.dimension()
        return word

    def typedef(self, m: dict) -> None:
        self.take("typedef")
        if self.peek() in ("enum", "struct", "union"):
            word = self.aggregate(m, True)
            name = self.name()
            packed = m["groups"][-1]["packed"] if word == "enum" else []
            if word == "enum":
                m["groups"][-1]["name"] = name
            m["typedefs"].append({"name": name, "kind": word, "packed": packed})
            self.skip_to(";")
        else:
            kind, typ, signed, packed = self.data_type()
            m["typedefs"].append({"name": self.name(), "kind": typ or kind, "packed": packed})
            self.skip_to(";")

    def instances(self, m: dict, generate: bool) -> None:
        child, params = self.name(), []
        if self.have("#"):
            params = self.bindings() if self.peek() == "(" else [{"port": None, "value": ("lit", self.take())}]
        while True:
            line, name = self.line(), self.name()
            while self.peek() == "[":
                self.dimension()
            m["instances"].append({"name": name, "module": child, "params": params, "connections": self.bindings(), "line": line, "generate": generate})
            if not self.have(","):
                break
        self.take(";")

    def bindings(self) -> list[dict]:
        """Connections by name or by order; ``.*`` is a port named *, an empty one has no value."""
        self.take("(")
        out = []
        while not self.have(")"):
            if self.have("."):
                if self.have("*"):
                    out.append({"port": "*", "value": None})
                else:
                    port = self.name()
                    value: tuple | None = ("ref", port)
                    if self.have("("):
                        value = None if self.peek() == ")" else self.ternary()
                        self.take(")")
                    out.append({"port": port, "value": value})
            else:
                out.append({"port": None, "value": None if self.peek() == "," else self.ternary()})
            if self.have(","):
                if self.peek() == ")" and out[-1]["port"] is None:  # an empty last one, by order
                    out.append({"port": None, "value": None})
            elif self.peek() != ")":
                raise ValueError("connections")
        return out

    # ------------------------------------------------------------ processes

    def process(self, m: dict, generate: bool) -> dict:
        line, word = self.line(), self.take()
        p = {"keyword": word, "events": [], "sensitivity": "none", "line": line, "generate": generate}
        if word.startswith("always") and self.have("@"):
            self.events(p)
        p["body"] = self.statement(m)
        return p

    def events(self, p: dict) -> None:
        if self.have("*"):
            p["sensitivity"] = "implicit"
            return
        if self.peek() != "(":
            p["sensitivity"] = "explicit"
            p["events"].append({"edge": "level", "expr": self.postfix()})
            return
        self.take("(")
        if self.have("*"):
            self.take(")")
            p["sensitivity"] = "implicit"
            return
        p["sensitivity"] = "explicit"
        while True:
            edge = self.take() if self.peek() in ("posedge", "negedge", "edge") else "level"
            e = self.ternary()
            if self.have("iff"):
                self.ternary()
            p["events"].append({"edge": edge, "expr": e})
            if not (self.have("or") or self.have(",")):
                break
        self.take(")")

    def number(self, m: dict) -> int:
        m["statements"] += 1
        return m["statements"]

    def statement(self, m: dict) -> dict:
        x, line = self.peek(), self.line()
        if x is None:
            raise ValueError("text ends in a statement")
        if self.have(";"):
            return {"k": "null"}
        if x in ("unique", "unique0", "priority"):
            q = self.take()
            s = self.statement(m)
            s["qualifier"] = q
            return s
        if self.is_name() and self.peek(1) == ":" and x not in ("default", "begin", "fork"):
            self.i += 2
            return self.statement(m)
        if x in ("begin", "fork"):
            self.take()
            if self.have(":"):
                self.name()
            body = []
            while self.peek() not in ("end", "join", "join_any", "join_none"):
                if self.peek() in (None, "endmodule"):
                    raise ValueError("no end")
                got = self.local(m)
                body += [self.statement(m)] if got is None else got
            self.take()
            if self.have(":"):
                self.name()
            return {"k": "block", "body": body} if x == "begin" else {"k": "opaque", "id": self.number(m)}
        if x == "if":
            self.take()
            sid = self.number(m)
            self.take("(")
            cond = self.ternary()
            self.take(")")
            then = self.statement(m)
            return {"k": "if", "id": sid, "cond": cond, "then": then, "else": self.statement(m) if self.have("else") else None, "line": line}
        if x in ("case", "casex", "casez"):
            return self.case(m)
        if x in ("for", "while", "repeat", "forever", "foreach"):
            self.take()
            sid, cond = self.number(m), None
            if x in ("while", "repeat"):
                self.take("(")
                cond = self.ternary()
                self.take(")")
            elif x != "forever":
                self.skip_group()
            return {"k": "loop", "id": sid, "cond": cond, "body": self.statement(m), "line": line}
        if x == "do":
            self.take()
            body = self.statement(m)
            self.skip_to(";")
            return {"k": "loop", "id": self.number(m), "cond": None, "body": body, "line": line}
        if x in ("@", "#", "wait"):
            self.take()
            if x == "#":
                self.skip_group() if self.peek() == "(" else self.take()
            elif x == "@":
                self.events({"events": [], "sensitivity": ""})
            else:
                self.skip_group() if self.peek() == "(" else None
            return {"k": "timing", "body": self.statement(m)}
        if x in ("assert", "assume", "cover", "disable", "return", "break", "continue", "->", "force", "release", "deassign", "expect", "void") or x[0] == "$" or self.is_name() and self.peek(1) in ("(", "::") and self.is_call():
            self.skip_to(";")
            return {"k": "null"} if x[0] == "$" or x in ("break", "continue", "return") else {"k": "opaque", "id": self.number(m)}
        if x in ("++", "--"):
            self.take()
            lhs = self.postfix()
            self.take(";")
            return self.write(lhs, (x[0], lhs, ("lit", "1")), "blocking", line)
        lhs = self.postfix()
        op = self.take()
        if op in ("++", "--"):
            rhs = (op[0], lhs, ("lit", "1"))
        else:
            if op not in ("=", "<=", *_OPS):
                raise ValueError(f"no statement begins with {x}")
            if self.peek() == "@":
                self.take()
                self.events({"events": [], "sensitivity": ""})
            else:
                self.delay()
            rhs = self.ternary()
            if op in _OPS:
                rhs = (op[:-1], lhs, rhs)
        if self.peek() != ")":
            self.take(";")
        return self.write(lhs, rhs, "nonblocking" if op == "<=" else "blocking", line)

    def write(self, lhs, rhs, kind: str, line: int) -> dict:
        return {"k": "assign", "lhs": lhs, "rhs": rhs, "kind": kind, "line": line}

    def is_call(self) -> bool:
        """Whether a name and its parenthesis are a whole statement."""
        j, depth = self.i + 1, 0
        while j < len(self.t):
            depth += (self.t[j] in ("(", "'(")) - (self.t[j] == ")")
            j += 1
            if not depth and self.t[j - 1] == ")":
                return j < len(self.t) and self.t[j] == ";"
        return False

    def local(self, m: dict) -> list[dict] | None:
        """Declarations inside a block; initial values are assignments."""
        if self.peek() in ("automatic", "static"):
            self.take()
        if self.peek() in ("localparam", "parameter"):
            self.take()
            self.parameters(m, True, ";", False)
            return []
        if not (self.peek() in _VARIABLES + _NETS or self.is_name() and self.declares()):
            return None
        kind, typ, signed, packed = self.data_type()
        out = []
        while True:
            line, name, unpacked = self.line(), self.name(), []
            while self.peek() == "[":
                unpacked.append(self.dimension())
            m["locals"].append({"name": name, "kind": kind, "type": typ, "signed": signed, "packed": packed, "unpacked": unpacked, "line": line})
            if self.have("="):
                out.append(self.write(("ref", name), self.ternary(), "blocking", line))
            if not self.have(","):
                break
        self.take(";")
        return out

    def case(self, m: dict) -> dict:
        line, word = self.line(), self.take()
        sid = self.number(m)
        self.take("(")
        e = self.ternary()
        self.take(")")
        self.have("inside") or self.have("matches")
        items, default = [], None
        while not self.have("endcase"):
            if self.have("default"):
                self.have(":")
                default = self.statement(m)
                continue
            labels = [self.label()]
            while self.have(","):
                labels.append(self.label())
            self.take(":")
            items.append({"labels": labels, "body": self.statement(m)})
        return {"k": "case", "id": sid, "kind": word, "expr": e, "items": items, "default": default, "line": line}

    def label(self):
        if self.have("["):
            a = self.ternary()
            self.take(":")
            node = ("range", a, self.ternary())
            self.take("]")
            return node
        return self.ternary()


def _empty(name: str, line: int) -> dict:
    lists = ("ports", "params", "signals", "enums", "typedefs", "assigns", "processes", "instances", "locals", "foreign", "groups")
    return {"name": name, "line": line, "statements": 0, "subroutines": 0, "opaque": 0, **{k: [] for k in lists}}


def modules(text: str, defines: dict[str, str] | None = None) -> list[dict]:
    """All whole modules of a text. A module name that is declared twice is given twice."""
    return Parser(text, defines).modules()
