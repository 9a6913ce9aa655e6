"""Text and token functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reserved words of the token metric (fixed values).
KEYWORDS = """module endmodule input output inout wire reg logic integer parameter localparam assign always
always_ff always_comb always_latch begin end if else case casez casex endcase default posedge negedge or and not
for generate endgenerate genvar function endfunction task endtask initial typedef enum struct packed signed unsigned
bit byte int while repeat forever unique priority return import package endpackage interface endinterface
modport""".split()
# Reserved words of body shapes (fixed values).
SHAPE_KEYWORDS = """module endmodule input output inout wire reg logic bit byte int integer
parameter localparam assign always always_ff always_comb always_latch
posedge negedge or and not if else case casez casex endcase default begin
end for while generate endgenerate genvar function endfunction task endtask
typedef enum struct packed signed unsigned initial""".split()
#: sv-lex-v1 (fixed value): sized and unbased literals, numbers, identifiers, operators of several characters, any other character.
TOKEN = r"\d+'[sS]?[bBoOdDhH][0-9a-fA-FxXzZ_?]+|'[01xXzZ]|\d+(?:\.\d+)?|[A-Za-z_$][A-Za-z0-9_$]*|<<<|>>>|===|!==|<=|>=|==|!=|&&|\|\||<<|>>|->|\S"
#: Tokens of body shapes (fixed value).
SHAPE_TOKEN = r"[A-Za-z_][A-Za-z0-9_$]*|\d[\d_']*[bBoOdDhH]?[0-9a-fA-FxXzZ_]*|\S"
#: Tokens that no run counts (fixed values).
SEPARATORS = (",", ";")
# Wordings that mark a statement as uncertain, and the kind of uncertainty of each (fixed values).
MARKERS = {
    "[derived]": "derived",
    "[unknown]": "unknown",
    "(candidate)": "candidate",
    "(unresolved)": "unresolved",
    "an unknown state": "unknown",
    "unknown width": "unknown",
    "an unresolved value": "unresolved",
    "status candidate": "candidate",
    "status ambiguous": "ambiguous",
    "status unsupported": "unsupported",
    "States: unresolved": "unresolved",
    "a condition on": "unknown",
    "priority unknown": "unknown",
    "an unrendered value": "unknown",
    "an unknown condition": "unknown",
    "an unresolved signal": "unresolved",
}
#: Limits of the token metric (fixed values): shared share of 4-grams, longest shared run.
OVERLAP_MAX, RUN_MAX = 0.20, 6
ID_LEAK = r"(sem1|beh1|str1|fsm1|n1|grp1|pv2):[0-9a-f]{16}"
ABSOLUTE = r"(^|[\s\"'=:(\[,])/(home|tmp|mnt|Users|workspace)/"
#: Syntax of the hardware language that no prompt may hold (fixed values).
HDL_SYNTAX = r"(<=|==|!=|&&|\|\||\?|\b(always|always_ff|always_comb|always_latch|assign|begin|endmodule|endcase|posedge|negedge)\b)"
HDL_SELECT = r"[A-Za-z0-9_$\]]\["
PARSER_NOISE = r"\b(node_id|syntax_type|BufferID|SyntaxKind|SyntaxNode)\b|\b(offset|buffer)\s*[:=]\s*\d"
PROMPT_PATH = r"(^|[\s\"'=:(,])(/(home|tmp|mnt|Users|workspace|root|var)/|[A-Za-z]:\\)"


def normalize(t: Column) -> Column:
    """Line ends as \\n, no blanks (of any kind) before them, no blank lines around."""
    blank = r"[\t\x0b\x0c\x1c-\x1f\x85\p{Z}]+"
    t = F.regexp_replace(F.regexp_replace(t, "\r\n?", "\n"), f"{blank}\n", "\n")
    return F.regexp_replace(F.regexp_replace(t, rf"{blank}\z", ""), r"\A\n+|\n+\z", "")


def strip_comments(t: Column) -> Column:
    """Block comments, then line comments, each replaced by a blank."""
    return F.regexp_replace(F.regexp_replace(t, r"(?s)/\*.*?\*/", " "), r"//[^\n]*", " ")


def collapse(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def module_body(t: Column, name: Column) -> Column:
    """From the first ``module NAME`` to the next ``endmodule`` of the text without comments; null if there is none."""
    bare = strip_comments(t)
    tail = F.regexp_extract(bare, r"(?s)\bmodule\s.*", 0)
    named = F.filter(F.regexp_extract_all(tail, F.lit(r"(?s)(\bmodule\s+\w+\b.*?\bendmodule\b)"), F.lit(1)), lambda m: F.regexp_extract(m, r"^module\s+(\w+)", 1) == name)
    return F.get(named, F.lit(0))


def tokens(t: Column) -> Column:
    """sv-lex-v1 tokens of the text without comments."""
    return F.regexp_extract_all(strip_comments(t), F.lit(f"({TOKEN})"), F.lit(1))


def is_identifier(x: Column) -> Column:
    return x.rlike(r"^[A-Za-z_$]") & ~x.isin(*KEYWORDS)


def body_shape(t: Column) -> Column:
    """Names that aren't reserved as ID, numbers as N, everything else as it stands, joined by blanks; comments don't count."""
    toks = F.regexp_extract_all(strip_comments(t), F.lit(f"({SHAPE_TOKEN})"), F.lit(1))
    return F.array_join(F.transform(toks, lambda x: F.when(x.rlike(r"^[A-Za-z_]") & ~x.isin(*SHAPE_KEYWORDS), "ID").when(x.rlike(r"^[0-9]"), "N").otherwise(x)), " ")


def normalized(toks: Column, canon: Column) -> Column:
    """Tokens without reserved words and punctuation; names of the canonical vocabulary as ID."""
    return F.transform(F.filter(toks, lambda x: ~x.isin(*KEYWORDS) & x.rlike(r"^[A-Za-z0-9_$']")), lambda x: F.when(F.array_contains(canon, x), "ID").otherwise(x))


def telling(grams: Column, n: int = 4) -> Column:
    """The n-grams that aren't ID throughout."""
    return F.filter(grams, lambda g: g != "\x1f".join(["ID"] * n))


def unseparated(toks: Column) -> Column:
    return F.filter(toks, lambda x: ~x.isin(*SEPARATORS))


@F.pandas_udf(T.StringType())
def _renamed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    find, words = re.compile(TOKEN).findall, frozenset(KEYWORDS)
    for texts in batches:
        out = []
        for t in texts:
            order: dict[str, str] = {}
            out.append(None if t is None else " ".join(order.setdefault(x, f"v{len(order)}") if (x[0].isalpha() or x[0] in "_$") and x not in words else x for x in find(t)))
        yield pd.Series(out, dtype="object")


def renamed(t: Column) -> Column:
    """Tokens with identifiers as v0, v1, ... by first occurrence, joined by blanks. In Arrow batches: as nested array expressions the tokens would be cut again for every token."""
    return _renamed(strip_comments(t))


def ngrams(a: Column, n: int) -> Column:
    """Distinct n-grams of an array of strings, each joined by U+001F; none if it is shorter than n."""
    return F.when(F.size(a) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(a) - (n - 1)), lambda i: F.array_join(F.slice(a, i, n), "\x1f")))).otherwise(F.array().cast("array<string>"))


def overlap(p: Column, c: Column) -> Column:
    """Share of p's n-grams that c has too, six decimals; 0 where p has none."""
    return F.when(F.size(p) == 0, F.lit(0.0)).otherwise(F.round(F.size(F.array_intersect(p, c)) / F.size(p), 6))


def occurrences(t: Column, word: str) -> Column:
    """How often a string stands in a text, without overlaps."""
    return ((F.length(t) - F.length(F.replace(t, F.lit(word), F.lit("")))) / len(word)).cast("long")


def width_text(w: Column) -> Column:
    return F.when(w.isNull(), "unknown width").when(w == 1, "1 bit").otherwise(F.concat(w.cast("string"), F.lit(" bits")))
