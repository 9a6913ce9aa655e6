"""Deeply nested JSON texts to flat, linked rows by vectorised structural indexing.

A batch of payloads is one byte buffer. Bitmaps of quotes (without escaped ones), of brackets and of delimiters outside strings are built with numpy, the
nesting depth is a prefix sum of the brackets, every token finds its container by one search over (document, depth, position), and the grammar is checked on
all tokens at once. Only spans that are asked for become Python strings.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 2 << 20
OBJ, ARR, END_OBJ, END_ARR, COLON, COMMA, TEXT, SCALAR = range(8)
_CODE = np.full(256, -1, np.int8)
for _c, _k in zip(b"{[}]:,", (OBJ, ARR, END_OBJ, END_ARR, COLON, COMMA)):
    _CODE[_c] = _k
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r")] = True
_LITERAL = re.compile(rb"-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?|true|false|null")
_ESCAPE = re.compile(rb'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})')
_BOM = b"\xef\xbb\xbf"


def good_escapes(raw: bytes) -> bool:
    return not _ESCAPE.sub(b"", raw).count(b"\\")


class Index:
    """Structural index of a list of documents. A node is the number of a value token; ``root[d]`` is that of document d, -1 if it isn't whole JSON."""

    def __init__(self, docs: list[bytes]):
        docs = [d[3:] if d.startswith(_BOM) else d for d in docs]
        self.buf = buf = b"\0".join(docs) + b"\0"
        size = np.fromiter((len(d) for d in docs), np.int64, len(docs))
        start = np.concatenate(([0], np.cumsum(size + 1)[:-1])) if len(docs) else np.zeros(0, np.int64)
        self.n = len(docs)
        b = np.frombuffer(buf, np.uint8)
        slash = b == 92
        escaped = np.zeros(len(b) + 1, bool)
        if slash.any():
            at = np.flatnonzero(slash)
            first = at[np.concatenate(([True], np.diff(at) > 1))]
            last = at[np.concatenate((np.diff(at) > 1, [True]))]
            escaped[last[(last - first) % 2 == 0] + 1] = True
        quote = (b == 34) & ~escaped[:-1]
        seps = np.zeros(len(b), bool)
        if len(docs):
            seps[start + size] = True
        run = np.cumsum(quote, dtype=np.int32)
        base = np.zeros(len(docs), np.int32)
        if len(docs):
            base = run[start] - quote[start]
        odd = ((run - np.repeat(base, size + 1)) & 1).astype(bool) if len(docs) else np.zeros(0, bool)
        inside = odd & ~quote
        code = _CODE[b]
        struct = (code >= 0) & ~odd & ~quote
        other = ~odd & ~quote & ~struct & ~_SPACE[b] & ~seps
        begins = other.copy()
        begins[1:] &= ~other[:-1]
        opening = quote & odd
        pos = np.flatnonzero(struct | opening | begins)
        kind = np.where(struct[pos], code[pos], np.where(opening[pos], TEXT, SCALAR)).astype(np.int8)
        doc = np.searchsorted(start, pos, "right") - 1
        good = np.ones(len(docs), bool)
        if len(docs):
            good &= ~odd[start + size]  # a string that never ends
        bad_inside = inside & (b < 32)
        if bad_inside.any():
            good[np.searchsorted(start, np.flatnonzero(bad_inside), "right") - 1] = False
        step = np.where(kind <= ARR, 1, np.where(kind <= END_ARR, -1, 0))
        depth = np.cumsum(step)
        if len(pos):
            lead = np.flatnonzero(np.concatenate(([True], np.diff(doc) > 0)))
            offset = (depth[lead] - step[lead])
            depth = depth - np.repeat(offset, np.diff(np.concatenate((lead, [len(pos)]))))
        tail = np.zeros(len(docs), np.int64)
        tail[doc] = depth  # the last token of a document wins
        good &= tail == 0
        low = depth < 0
        good[doc[low]] = False
        level = np.where(kind <= ARR, depth - 1, depth)
        keep = good[doc]
        pos, kind, doc, level = pos[keep], kind[keep], doc[keep], level[keep].astype(np.int64)
        n = len(pos)
        idx = np.arange(n, dtype=np.int64)
        span = int(level.max(initial=0)) + 2
        opener = np.flatnonzero(kind <= ARR)
        okey = (doc[opener] * span + level[opener]) * (n + 1) + opener
        order = np.argsort(okey, kind="stable")
        okey, opener = okey[order], opener[order]

        def container(lv: np.ndarray, sel: np.ndarray) -> np.ndarray:
            return opener[np.searchsorted(okey, (doc[sel] * span + lv) * (n + 1) + sel) - 1]

        closer = np.flatnonzero((kind == END_OBJ) | (kind == END_ARR))
        self.end = np.full(n, -1, np.int64)
        if len(closer):
            mate = container(level[closer], closer)
            good[doc[closer[kind[mate] + 2 != kind[closer]]]] = False
            self.end[mate] = pos[closer] + 1
        member = idx[(kind != END_OBJ) & (kind != END_ARR)]
        parent = np.full(n, -1, np.int64)
        deep = member[level[member] > 0]
        if len(deep):
            parent[deep] = container(level[deep] - 1, deep)
        # members by container, in order: their place in it decides what may stand there
        top = level[member] == 0
        group = np.where(top, -1 - doc[member], parent[member])
        by = np.lexsort((member, group))
        m, g = member[by], group[by]
        if len(m):
            head = np.flatnonzero(np.concatenate(([True], np.diff(g) != 0)))
            count = np.diff(np.concatenate((head, [len(m)])))
            place = np.arange(len(m)) - np.repeat(head, count)
            many = np.repeat(count, count)
            value = (kind[m] <= ARR) | (kind[m] >= TEXT)
            in_obj = (g >= 0) & (kind[np.maximum(g, 0)] == OBJ)
            in_arr = (g >= 0) & ~in_obj
            r = place % 4
            ok = np.where(in_obj, np.select([r == 0, r == 1, r == 2], [kind[m] == TEXT, kind[m] == COLON, value], kind[m] == COMMA) & (many % 4 == 3), np.where(in_arr, np.where(place % 2 == 0, value, kind[m] == COMMA) & (many % 2 == 1), value & (many == 1)))
            good[doc[m[~ok]]] = False
            is_value = np.where(in_obj, r == 2, np.where(in_arr, place % 2 == 0, True))
            self.key_token = np.full(n, -1, np.int64)
            kv = np.flatnonzero(in_obj & (r == 2))
            self.key_token[m[kv]] = m[kv - 2]
            self.item = np.full(n, -1, np.int64)
            av = np.flatnonzero(in_arr & (place % 2 == 0))
            self.item[m[av]] = place[av] // 2
            vals = m[is_value]
        else:
            self.key_token = self.item = np.full(n, -1, np.int64)
            vals = m
        # ends of strings and scalars
        closing = np.flatnonzero(quote & ~odd)
        t = np.flatnonzero(kind == TEXT)
        if len(t) and len(closing):
            self.end[t] = closing[np.minimum(np.searchsorted(closing, pos[t]), len(closing) - 1)] + 1
        s = np.flatnonzero(kind == SCALAR)
        if len(s):
            stop = np.flatnonzero(~other)
            self.end[s] = stop[np.searchsorted(stop, pos[s])]
            seen: dict[bytes, bool] = {}
            for i in s.tolist():
                w = buf[pos[i] : self.end[i]]
                if w not in seen:
                    seen[w] = bool(_LITERAL.fullmatch(w))
                if not seen[w]:
                    good[doc[i]] = False
        if slash.any():
            lone = np.flatnonzero(slash & ~escaped[:-1])
            wrong = [p for p in lone.tolist() if not _ESCAPE.match(buf, p)]
            wrong += np.flatnonzero(slash & ~odd).tolist()
            if wrong:
                good[np.searchsorted(start, wrong, "right") - 1] = False
        self.pos, self.kind, self.doc, self.parent, self.good = pos, kind, doc, parent, good
        self.root = np.full(len(docs), -1, np.int64)
        tops = member[top]
        tops = tops[good[doc[tops]]]
        self.root[doc[tops]] = tops
        vals = vals[good[doc[vals]] & (parent[vals] >= 0)]
        # children by (container, key or item)
        keyed = vals[self.key_token[vals] >= 0]
        words: dict[bytes, int] = {}
        names: dict[str, int] = {}  # a key may be written with escapes

        def code(raw: bytes) -> int:
            if raw not in words:
                name = json.loads(b'"' + raw + b'"', strict=False) if 92 in raw and good_escapes(raw) else raw.decode("utf-8", "replace")
                words[raw] = names.setdefault(name, len(names))
            return words[raw]

        self.names = names
        codes = np.fromiter((code(buf[a:z]) for a, z in zip((pos[self.key_token[keyed]] + 1).tolist(), (self.end[self.key_token[keyed]] - 1).tolist())), np.int64, len(keyed))
        self.width = len(names) + 1
        ck = parent[keyed] * self.width + codes
        o = np.lexsort((keyed, ck))
        self.ckey, self.cval = ck[o], keyed[o]
        items = vals[self.item[vals] >= 0]
        o = np.lexsort((items, parent[items]))
        self.apar, self.aval = parent[items][o], items[o]

    def child(self, nodes: np.ndarray, key: str) -> np.ndarray:
        """For each node its member of that name (the last, if repeated), -1 if there is none."""
        code = self.names.get(key)
        if code is None or not len(nodes):
            return np.full(len(nodes), -1, np.int64)
        want = nodes * self.width + code
        at = np.searchsorted(self.ckey, want, "right") - 1
        hit = (nodes >= 0) & (at >= 0) & (self.ckey[np.maximum(at, 0)] == want) if len(self.ckey) else np.zeros(len(nodes), bool)
        return np.where(hit, self.cval[np.maximum(at, 0)] if len(self.cval) else -1, -1)

    def elements(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of nodes, element) of all elements of the arrays ``nodes``."""
        a, z = np.searchsorted(self.apar, nodes), np.searchsorted(self.apar, nodes, "right")
        n = z - a
        which = np.repeat(np.arange(len(nodes)), n)
        return which, self.aval[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)] if n.sum() else np.zeros(0, np.int64)

    def raw(self, node: int) -> bytes:
        return self.buf[self.pos[node] : self.end[node]]

    def text(self, node: int) -> str | None:
        """A scalar's or string's value as text; None for null, absent and containers."""
        if node < 0 or self.kind[node] <= ARR:
            return None
        w = self.raw(node)
        if self.kind[node] == TEXT:
            return json.loads(w, strict=False) if 92 in w else w[1:-1].decode("utf-8", "replace")
        return None if w == b"null" else w.decode()

    def is_null(self, nodes: np.ndarray) -> np.ndarray:
        if not len(self.pos):
            return np.ones(len(nodes), bool)
        first = np.frombuffer(self.buf, np.uint8)[self.pos[np.maximum(nodes, 0)]]
        return (nodes < 0) | ((self.kind[np.maximum(nodes, 0)] == SCALAR) & (first == 110))


class Nodes:
    """Nodes of one index, each with the rows it came from: ``up`` (row keys so far, one array per level)."""

    def __init__(self, index: Index, node: np.ndarray, up: tuple[np.ndarray, ...]):
        self.index, self.node, self.up = index, node, up

    def child(self, key: str) -> Nodes:
        return Nodes(self.index, self.index.child(self.node, key), self.up)

    def where(self, mask: np.ndarray) -> Nodes:
        return Nodes(self.index, self.node[mask], tuple(u[mask] for u in self.up))

    def items(self) -> list[Nodes]:
        """The items of each node, its position appended to ``up``: elements of an array, of a list written as JSON text, or the node itself at position 0. Null and absent: none."""
        x, out = self.index, []
        live = self.where(~x.is_null(self.node))
        if not len(live.node):
            return out
        kind = x.kind[live.node]
        arr = live.where(kind == ARR)
        if len(arr.node):
            which, el = x.elements(arr.node)
            got = Nodes(x, el, tuple(u[which] for u in arr.up) + (x.item[el],))
            out.append(got.where(~x.is_null(el)))
        first = np.frombuffer(x.buf, np.uint8)[np.minimum(x.pos[live.node] + 1, len(x.buf) - 1)]
        maybe = (kind == TEXT) & np.isin(first, list(b"[{ \\\t\n"))
        single = live.where((kind != ARR) & ~maybe)
        rest = live.where(maybe)
        if len(rest.node):
            texts = [x.text(i).encode("utf-8", "surrogatepass") for i in rest.node.tolist()]
            coded = np.fromiter((t.lstrip()[:1] in (b"[", b"{") for t in texts), bool, len(texts))
            inner = Index([t for t, c in zip(texts, coded) if c])
            held = rest.where(coded)
            out += Nodes(inner, inner.root, held.up).where(inner.root >= 0).items()
            alone = rest.where(~coded)
            if len(alone.node):
                out.append(Nodes(x, alone.node, alone.up + (np.zeros(len(alone.node), np.int64),)))
        if len(single.node):
            out.append(Nodes(x, single.node, single.up + (np.zeros(len(single.node), np.int64),)))
        return out

    def texts(self, key: str) -> list[str | None]:
        return [self.index.text(i) for i in self.index.child(self.node, key).tolist()]


def walk(frames: list[Nodes], key: str) -> list[Nodes]:
    return [n for f in frames for n in f.child(key).items()]


FIELDS = {
    "machine": ("state_register", "style", "status", "quality", "width"),
    "state": ("name", "reset", "value"),
    "transition": ("condition", "kind", "status", "from", "to"),
    "instance": ("name", "module", "status"),
    "connection": ("port", "direction"),
    "signal": (),
}
COLUMNS = ("name", "module", "status", "kind", "condition", "from_state", "to_state", "reset", "value", "state_register", "style", "quality", "width", "port", "direction", "signal")
_AS = {"from": "from_state", "to": "to_state"}
#: Keys under which a payload may hold the document itself.
ENVELOPES = ("document",)
SCHEMA = "raw_id long, item_kind string, pos1 int, pos2 int, pos3 int, " + ", ".join(f"{c} string" for c in COLUMNS)
_ARROW = pa.schema([("raw_id", pa.int64()), ("item_kind", pa.string()), ("pos1", pa.int32()), ("pos2", pa.int32()), ("pos3", pa.int32())] + [(c, pa.string()) for c in COLUMNS])


def documents(index: Index, envelopes: tuple[str, ...] = ENVELOPES) -> list[Nodes]:
    """The documents of each payload: bare, in a list, in an envelope, or written as JSON text; up = (payload,)."""
    rows = np.flatnonzero(index.root >= 0)
    frames, out = Nodes(index, index.root[rows], (rows,)).items(), []
    for f in frames:
        f = Nodes(f.index, f.node, f.up[:1])
        boxed = np.zeros(len(f.node), bool)
        for key in envelopes:
            c = f.index.child(f.node, key)
            hit = ~f.index.is_null(c) & ~boxed
            if hit.any():
                out += [Nodes(n.index, n.node, n.up[:1]) for n in Nodes(f.index, c[hit], tuple(u[hit] for u in f.up)).items()]
                boxed |= hit
        if not boxed.all():
            out.append(f.where(~boxed))
    return out


def _emit(ids: np.ndarray, kind: str, frames: list[Nodes], wanted: set[str] | None) -> Iterator[pa.RecordBatch]:
    for f in frames:
        n = len(f.node)
        if not n or (wanted and kind not in wanted):
            continue
        up = list(f.up[1:]) + [np.full(n, -1)] * (4 - len(f.up))
        cols = {_AS.get(k, k): f.texts(k) for k in FIELDS[kind]}
        if kind == "signal":
            cols["signal"] = [f.index.text(i) for i in f.node.tolist()]
        elif kind == "state":  # a state that is only a name
            cols["name"] = [c if c is not None else f.index.text(i) for c, i in zip(cols["name"], f.node.tolist())]
        arrays = [pa.array(ids[f.up[0]], pa.int64()), pa.array([kind] * n), *[pa.array(u.astype(np.int32)) for u in up], *[pa.array(cols.get(c, [None] * n), pa.string()) for c in COLUMNS]]
        yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def flatten_batch(ids: np.ndarray, docs: list[bytes], wanted: set[str] | None = None, envelopes: tuple[str, ...] = ENVELOPES) -> Iterator[pa.RecordBatch]:
    top = documents(Index(docs), envelopes)
    machines = walk(top, "fsms")
    yield from _emit(ids, "machine", machines, wanted)
    yield from _emit(ids, "state", walk(machines, "states"), wanted)
    yield from _emit(ids, "transition", walk(machines, "transitions"), wanted)
    instances = walk(top, "instances")
    yield from _emit(ids, "instance", instances, wanted)
    links = walk(instances, "connections")
    yield from _emit(ids, "connection", links, wanted)
    yield from _emit(ids, "signal", walk(links, "signals"), wanted)


def flatten_payloads(raw: DataFrame, *kinds: str, envelopes: tuple[str, ...] = ENVELOPES) -> DataFrame:
    """raw (raw_id, payload): one row per machine, state, transition, instance, connection and signal (or the ``kinds`` named), linked by raw_id and positions.

    A child's parent has the same raw_id and the leading positions: states and transitions belong to machine pos1, connections to instance pos1, signals to
    connection (pos1, pos2); unused positions are -1. Positions count from 0 in document order, also over null items, which give no row. An item that stands
    alone in place of a list has position 0, a list written as JSON text counts as that list. Absent and null fields are null. Null, empty, truncated or
    otherwise not whole payloads give no rows; a byte order mark is allowed. Payloads delivered twice give their rows once: repeats are dropped before they are
    read, which is the only shuffle. Keys may be written with escapes; ``envelopes`` are keys that may hold the document itself.
    """
    wanted = set(kinds) or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1)
            part: list[bytes] = []
            first, held = 0, 0
            for i in range(len(texts)):
                d = texts[i].as_buffer()
                part.append(d.to_pybytes() if d is not None else b"")
                held += len(part[-1])
                if held > CHUNK or i + 1 == len(texts):
                    yield from flatten_batch(ids[first : i + 1], part, wanted, envelopes)
                    part, first, held = [], i + 1, 0

    rows = raw.select("raw_id", "payload").where("raw_id is not null and payload is not null and payload <> ''").distinct()
    return rows.mapInArrow(run, SCHEMA)
