"""Parser, analyses and state machines of the hardware language on small modules with known answers, and their Spark forms."""

import json

import pytest

from quillgate.functions import expr as E
from quillgate.rtl import lex, machines, syntax
from quillgate.rtl.analysis import COND, FULL, NONE, PARTIAL, UNKNOWN, Module
from quillgate.sources import rtl

TWO = """// controller
module ctrl (input clk, input rst_n, input go, output reg busy, output wire done);
  localparam IDLE = 2'd0, RUN = 2'd1, STOP = 2'd2;
  reg [1:0] state;
  always @(posedge clk or negedge rst_n)
    if (!rst_n) state <= IDLE;
    else case (state)
      IDLE: if (go) state <= RUN;
      RUN: state <= STOP;
      STOP: state <= IDLE;
      default: state <= IDLE;
    endcase
  always @(posedge clk or negedge rst_n)
    if (!rst_n) busy <= 1'b0;
    else busy <= (state == RUN);
  assign done = (state == STOP);
endmodule
/* module fake (); endmodule */
module wrap #(parameter W = 8) (input clk, input rst_n, input go, input [W-1:0] din, output busy, output done, output reg [W-1:0] q);
  ctrl u_ctrl (.clk(clk), .rst_n(rst_n), .go(go), .busy(busy), .done(done));
  always @(posedge clk) if (go) q <= din;
endmodule
"""


def one(text, name=None):
    trees = syntax.modules(text)
    inventory = {t["name"]: t for t in trees}
    return Module(inventory[name] if name else trees[0], inventory)


def test_projections_of_a_controller_and_its_wrapper():
    c, w = one(TWO, "ctrl"), one(TWO, "wrap")
    assert [(p["name"], p["kind"], p["type"], p["width"]) for p in w.interface()["ports"]][3:] == [("din", "net", None, 8), ("busy", "net", None, 1), ("done", "net", None, 1), ("q", "variable", "reg", 8)]
    assert w.interface()["parameters"] == [{"name": "W", "default_text": "8", "port_param": True, "signed": False, "type": None, "width": None}]
    assert c.structure()["counts"] == {"dependencies": 9, "instances": 0, "processes": 2, "registers": 2, "signals": 6} and c.structure()["processes"] == {"sequential": 2}
    assert [(r["name"], r["enables"], r["hold"]) for r in c.structure()["registers"]] == [("busy", [], "none"), ("state", ["go"], "implicit")]
    inst = w.structure()["instances"][0]
    assert inst["status"] == "resolved" and {x["port"]: x["direction"] for x in inst["connections"]} == {"clk": "input", "rst_n": "input", "go": "input", "busy": "output", "done": "output"}
    t = {x["name"]: x for x in c.dependency()["targets"]}
    assert t["busy"]["role"] == "registered_output" and t["busy"]["inputs"] == ["clk", "rst_n"] and t["busy"]["registers"] == ["state"]
    assert t["done"] == {"name": "done", "role": "output", "inputs": [], "registers": ["state"], "sources": [{"kind": "data", "signal": "state"}]}
    assert {(s["kind"], s["signal"]) for s in t["state"]["sources"]} == {("clock", "clk"), ("enable", "go"), ("reset", "rst_n"), ("control", "state"), ("hold", "state")}
    f = machines.Extractor(c).projection()["fsms"][0]
    assert (f["status"], f["quality"], f["style"], f["encoding"]["style"], f["reset"]) == ("confirmed", "high", "one_process", "binary", {"kind": "async", "signal": "rst_n", "state": "IDLE"})
    assert [(x["from"], x["to"], x["kind"], x["condition"]) for x in f["transitions"]] == [("IDLE", "RUN", "explicit", "go is 1"), ("RUN", "STOP", "explicit", None), ("STOP", "IDLE", "explicit", None), ("IDLE", "IDLE", "implicit_hold", "go is 0")]
    assert f["outputs"] == [{"kind": "moore", "name": "busy", "registered": True}, {"kind": "moore", "name": "done", "registered": False}]
    assert [(s["name"], s["value"], s["reset"]) for s in f["states"]] == [("IDLE", 0, True), ("RUN", 1, False), ("STOP", 2, False)]


def test_syntax_of_many_kinds():
    t = """
`define W 4
`timescale 1ns/1ps
package p; localparam int K = 3; typedef enum logic [1:0] {PA, PB = 2, PC} e_t; endpackage
module old (a, b, c);
  input [`W-1:0] a; output b; inout c; reg b;
  wire #1 x = a[0], y;
  function f; input z; f = z; endfunction
  generate genvar i; for (i = 0; i < 2; i = i + 1) begin : g assign y = a[i]; sub #(.N(2)) u (.p(a), .q(), .*); end endgenerate
  initial begin b = 0; #5 b = 1; $display("endmodule"); end
  always @(a or x) begin : blk integer k; for (k = 0; k < 4; k = k + 1) b = a[k]; end
`ifdef NOT
  broken (((
`else
  assign c = a ? {2{x}} : '0;
`endif
endmodule
module top;
  logic [7:0] mem [0:3]; p::e_t st; (* keep *) wire w;
  old u1 (1, w, ), u2 (.a(4'b1x0z), .b(w), .c());
  typedef struct packed { logic a; logic [2:0] b; } s_t; s_t s;
  always_comb begin unique case (st) p::PA, p::PB: s.b = 1; default: ; endcase s.a += 1; end
  assign {w, s.b[1:0]} = mem[2][3 +: 2] inside {1, [2:3]};
endmodule
module broken (input a; endmodule
module last (input a, b, output logic signed [3:0] y [1:0]); endmodule"""
    ms = {m["name"]: m for m in syntax.modules(t)}
    assert list(ms) == ["old", "top", "last"]
    o = ms["old"]
    assert [(p["name"], p["direction"], p["kind"]) for p in o["ports"]] == [("a", "input", "net"), ("b", "output", "variable"), ("c", "inout", "net")] and o["subroutines"] == 1
    assert [i["name"] for i in o["instances"]] == ["u"] and o["instances"][0]["generate"] and Module(o).width("a") == 4
    assert len([a for a in o["assigns"] if a["kind"] == "continuous"]) == 2
    m = Module(ms["top"])
    assert m.consts["p::K"] == 3 and (m.consts["PA"], m.consts["PB"], m.consts["PC"]) == (0, 2, 3)
    assert [(i["module"], i["name"], len(i["connections"])) for i in ms["top"]["instances"]] == [("old", "u1", 3), ("old", "u2", 3)]
    assert {n for a in m.assigns for n in a["writes"]} == {"w", "s"}
    assert [(p["name"], p["signed"], p["unpacked"]) for p in ms["last"]["ports"]] == [("a", False, []), ("b", False, []), ("y", True, ["[1:0]"])]
    assert syntax.modules("") == [] and syntax.modules("module x (input a);") == [] and syntax.modules("module m; assign") == []


def test_numbers_and_folding():
    f = lambda t, **n: E.fold(E.read(t), n)
    assert [f(x) for x in ("8'hff", "4'b10_10", "'o17", "12", "4'bx", "'1", "1.5")] == [255, 10, 15, 12, None, None, None]
    assert E.has_xz("4'b1x") and E.has_xz("'z") and not E.has_xz("8'd12") and E.literal_width("12'd3") == 12 and E.literal_width("'d3") is None
    assert f("2**10 - 1") == 1023 and f("-7 / 2") == -4 and f("-7 % 4") == 1 and f("1 / 0") is None and f("1 << 256") is None and f("2 ** 64") is None
    assert f("W > 4 ? $clog2(W) : 1", W=9) == 4 and f("!0 + ~0") == 0 and f("|5") == 1 and f("X + 1") is None and f("1 - 1 - 1") == -1
    assert E.show(E.read("a<=b&&c[3:0]!={2{d}}")) == "((a <= b) && (c[3:0] != {2{d}}))"


def test_wording():
    w = lambda t, n=False: E.wording(E.read(t), n)
    assert w("a && !b") == "a is 1 and b is 0" and w("!(a || b == 2)") == "a is 0 and b is not 2"
    assert w("c < 3", True) == "c is at least 3" and w("a[0].f[3:1] >= W") == "bits 3 to 1 of field f of element 0 of a is at least W"
    assert w("a + b") == "a condition on a, b" and w("a + b", True) == "not a condition on a, b" and w("a[2]") == "element 2 of a is 1"


BODY = """module m (input clk, input rst, input a, input b, input [1:0] s, output reg q, output reg r, output reg t, output y, output z);
  reg k, l, n, o; wire v, w;
  {}
endmodule"""


@pytest.mark.parametrize(
    ("body", "name", "level"),
    [
        ("always @* if (a) q = 1; else q = 0;", "q", FULL), ("always @* if (a) q = 1;", "q", PARTIAL), ("always @* case (s) 0: q = 1; 1: q = 0; endcase", "q", COND), ("always @* case (s) 0: q = 1; default: q = 0; endcase", "q", FULL),
        ("always @* begin q = 0; if (a) q = 1; end", "q", FULL), ("always @* if (a) r = 1;", "q", NONE), ("always @* begin : x integer i; for (i = 0; i < 2; i = i + 1) q = a; end", "q", UNKNOWN), ("always @* if (a) case (s) 0: q = 1; endcase else q = 0;", "q", COND),
        ("always @* if (a) begin : x integer i; while (b) q = 1; end else q = 0;", "q", UNKNOWN), ("always @* case (s) 0: q = 1; 1: r = 0; endcase", "q", PARTIAL),
    ],
)
def test_coverage_of_statements(body, name, level):
    m = one(BODY.format(body))
    assert m.cover(m.procs[0]["body"], name) == level


def test_roles_latches_and_resets():
    def first(body):
        m = one(BODY.format(body))
        return m, m.processes[0]

    role = lambda body: (lambda p: (p["role"], p["confidence"]))(first(body)[1])
    assert role("always_ff @(posedge clk) q <= a;") == ("sequential", "high") and role("always @(posedge clk) q <= a;") == ("sequential", "medium") and role("always @(posedge clk) q = a;") == ("sequential", "low")
    assert role("always_comb q = a;") == ("combinational", "high") and role("always @(a or b) q = a & b;") == ("combinational", "medium") and role("always @(a) q = a & b;") == ("generic", "low")
    assert role("always @* if (a) q = b;") == ("latch", "medium") and role("always_latch if (a) q = b;") == ("latch", "high") and role("initial q = 0;") == ("initialization", "high")
    assert role("always_ff @(a) q <= b;") == ("ambiguous", "unknown") and role("always @(posedge clk or a) q <= a;") == ("ambiguous", "unknown") and role("always #5 q = ~q;") == ("generic", "low")
    m, p = first("always_comb case (s) 0: q = 1; 1: q = 0; endcase")
    assert p["completeness"] == {"q": "conditional"} and m.latch_status(p, "q") == "possible"
    assert first("always @(posedge clk or posedge rst) if (rst) q <= 0; else q <= a;")[1]["resets"][0] == {"signal": "rst", "kind": "async", "polarity": "active_high", "status": "confirmed", "stmt": 1, "priority": 0, "targets": ["q"]}
    assert first("always @(posedge clk or negedge rst) if (rst) q <= 0; else q <= a;")[1]["resets"][0]["status"] == "ambiguous"
    assert first("always @(posedge clk) if (rst == 1'b0) q <= 0; else q <= a;")[1]["resets"][0]["polarity"] == "active_low"
    assert not first("always @(posedge clk) if (rst) q <= a; else q <= b;")[1]["resets"]


def test_registers_holds_and_enables():
    r = one(BODY.format("always @(posedge clk) begin q <= q; if (a) q <= b; end always @(posedge clk) if (rst) r <= 0; else if (a) r <= b; else if (b) r <= a; always @(posedge clk) case (s) 0: t <= a; default: t <= t; endcase")).register_of
    assert (r["q"]["hold"], r["q"]["update"]) == ("explicit", "conditional") and (r["r"]["hold"], r["r"]["update"]) == ("implicit", "conditional") and (r["t"]["hold"], r["t"]["update"]) == ("explicit", "case")
    assert [e["signals"] for e in r["r"]["enables"]] == [["b"]] and [x["kind"] for x in r["r"]["leaves"]] == ["reset", "update", "update", "hold_implicit"]
    over = one(BODY.format("always @(posedge clk) begin if (a) q <= 0; q <= b; end")).registers[0]
    assert [a["overridden"]["q"] for a in over["assigns"]] == [[1], []]


def test_drivers_classes_loops_and_order():
    m = one(BODY.format("assign v = w | a; assign w = v & b; assign y = q; assign y = a; always_comb begin k = a; l = k; n = n | a; if (b) o = a; q = o; end sub u (.i(a), .o(z)); initial t = 0;"))
    s = {x["name"]: x for x in m.signal_facts}
    assert s["y"]["multiple"] == "confirmed" and s["z"]["driver_status"] == "unknown" and s["a"]["driver_status"] == "external" and s["t"]["driver_status"] == "driven" and s["r"]["driver_status"] == "undriven"
    assert [(x["signals"], x["status"]) for x in m.loops] == [(["n"], "confirmed"), (["v", "w"], "confirmed")]
    assert {x["signal"]: x["order"] for x in m.read_write} == {"k": "write_first", "n": "read_first", "o": "mixed"}
    assert s["a"]["classes"]["port_connection"] == "candidate" and s["r"]["classes"]["unknown"] == "ambiguous" and s["v"]["classes"]["driver"] == "confirmed"
    assert s["v"]["fan_in"]["expression"] == 2 and s["q"]["fan_in"]["direct"] == 1 and s["q"]["fan_out"]["outputs"] == 2
    kid = "module sub (input i, output o, inout p); endmodule module m (input a); sub u (a, made, .p(a)); endmodule"
    assert one(kid, "m").implicit_nets == ["made"]
    part = one(BODY.format("assign v = a; always_comb begin k = 0; end always @(posedge clk) q[0] <= k; always @(posedge clk) q[1] <= k;"))
    assert next(x for x in part.signal_facts if x["name"] == "q")["multiple"] == "candidate"
    c = m.cone("y")
    assert c["inputs"] == ["a", "b"] and c["depth"] >= 2


FSM = """module f (input clk, input rst, input go, input stop, output reg act, output lvl);
  typedef enum logic [1:0] {S0, S1, S2 = 3} st_t;
  st_t state, next;
  always_ff @(posedge clk or posedge rst) if (rst) state <= S0; else state <= next;
  always_comb begin
    next = state; act = 0;
    case (state)
      S0: if (go && !stop) next = S1;
      S1: begin act = 1; next = stop ? S2 : S1; end
      S2: next = S0;
    endcase
  end
  assign lvl = (state == S1) & go;
  reg [3:0] cnt; always @(posedge clk) if (cnt == 3) cnt <= 0; else cnt <= cnt + 1;
  reg [1:0] aux; always @(posedge clk) case (aux) 0: if (state == S1) aux <= 1; 1: aux <= 0; endcase
endmodule"""


def test_two_process_machine():
    x = machines.Extractor(one(FSM))
    f = next(m for m in x.machines if m["register"] == "state")
    assert (f["style"], f["next"], f["status"], f["quality"], f["encoding"]["style"], f["encoding"]["source"]) == ("two_process", "next", "confirmed", "high", "custom", "enum_member")
    t = {(a["from"], a["to"], a["kind"], a["condition"]) for a in f["transitions"]}
    assert ("S0", "S1", "explicit", "go is 1 and stop is 0") in t and ("S1", "S2", "explicit", "stop is 1") in t and ("S2", "S0", "explicit", None) in t and ("*reset", "S0", "reset", None) in t
    assert ("S0", "S0", "implicit_hold", None) in t and not any(a == "S2" and b == "S2" for a, b, *_ in t)  # the later, unconditional row wins
    assert {o["name"]: o["kind"] for o in f["outputs"]} == {"act": "moore", "lvl": "mealy"}
    assert {(a["state"], a["signal"], a["kind"]) for a in f["actions"]} >= {("S1", "act", "output")}
    assert [(s["name"], s["value"], s["reachability"]) for s in f["states"]] == [("S0", 0, "graph_reachable"), ("S1", 1, "graph_reachable"), ("S2", 3, "graph_reachable")]
    assert {r["register"]: r["reason"] for r in x.rejected} == {"cnt": "arithmetic_feedback"}
    assert {(c["from"], c["to"], c["kind"]) for c in x.couplings()} == {("state", "aux", "predicate")}


def test_encodings():
    e = machines.encoding_style
    assert e([0, 1, 3, 2], 2, {(0, 1), (1, 3), (3, 2), (2, 0)}) == "gray" and e([0, 1, 2], 2, {(0, 1), (1, 2)}) == "binary"
    assert e([1, 2, 4], 3, {(1, 2)}) == "one_hot" and e([1, 2, 4], 4, set()) == "custom" and e([], 1, set()) == "unknown"


def test_directives_and_strings():
    t = lex.preprocess('`ifdef A\nx\n`elsif B\ny\n`else\nz\n`endif\n`define N a \\\n + b\nq = `N; s = "/* no */"; // gone\n`undef N\n`N')
    assert "z" in t and "x" not in t and "q = a" in t and '"/* no */"' in t and "gone" not in t
    assert lex.tokens("a<=8'hF_f;\nb")[0] == ["a", "<=", "8'hF_f", ";", "b"] and lex.tokens("a\n\nb")[1] == [1, 3]


def test_rows_and_projections_in_spark(spark):
    df = spark.createDataFrame([("r1", TWO, 1), ("r2", None, 1), ("r3", "", 1), ("r4", "no module", 1), ("r5", (FSM + "\n") * 30, 1)], "record_id string, text string, name int")
    rows = rtl.read_rtl(df, "module", "register", "transition", "port")
    assert {(r["record_id"], r["name"]) for r in rows.where("section = 'module' and record_id = 'r1'").collect()} == {("r1", "ctrl"), ("r1", "wrap")}
    assert rows.where("record_id = 'r5' and section = 'module'").count() == 30 and rows.where("record_id in ('r2', 'r3', 'r4')").count() == 0
    reg = {r["name"]: r for r in rows.where("section = 'register' and record_id = 'r1'").collect()}
    assert (reg["state"]["clock"], reg["state"]["edge"], reg["state"]["reset"], reg["state"]["kind"]) == ("clk", "posedge", "rst_n", "asynchronous") and json.loads(reg["q"]["detail"]) == ["go"]
    p = {(r["module"], r["projection"]): r["value"] for r in rtl.read_projections(df.where("record_id = 'r1'"), "fsm-v1", "interface-v1").collect()}
    assert len(p) == 4 and p["wrap", "fsm-v1"] == '{"fsms":[],"module":"wrap"}'
    assert rtl.read_rtl(df.limit(0)).count() == 0
    m = spark.createDataFrame([("x", "m", 1, "a"), ("x", "m", 3, "b"), ("x", "n", 2, "c")], "ip string, module string, file int, v string")
    assert sorted((r["module"], r["v"], r["replaced"]) for r in rtl.last_modules(m, "file").collect()) == [("m", "b", 1), ("n", "c", 0)]


def test_pins_meet_ports(spark):
    ports = spark.createDataFrame([("x", "c", "a", "input"), ("y", "c", "a", "output")], "ip string, module string, name string, direction string")
    pins = spark.createDataFrame([("x", "p", "u", "c", "a", "s"), ("x", "p", "u", "c", "b", "s"), ("x", "p", "v", "d", "a", None)], "ip string, parent string, instance string, child string, port string, signal string")
    assert sorted((r["instance"], r["port"], r["direction"], r["status"]) for r in rtl.linked_pins(pins, ports).collect()) == [("u", "a", "input", "resolved"), ("u", "b", None, "no_such_port"), ("v", "a", None, "no_module")]


def test_expression_columns(spark):
    df = spark.createDataFrame([("a + b[2]",), ("(",), (None,)], "t string")
    r = df.select(E.expression_facts("t").alias("f"), E.node_kinds("t").alias("k")).collect()
    assert (r[0]["f"]["nodes"], r[0]["f"]["depth"], r[0]["k"]) == (5, 3, ["+", "ref", "[]", "ref", "lit"]) and r[1]["k"] is None and r[2]["f"]["nodes"] is None
