"""Texts of the hardware language to tokens: comments, attributes and directives are gone, macros without arguments are replaced, conditional parts are chosen."""

from __future__ import annotations

import re

_DIRECTIVE = re.compile(r"`(\w+)[ \t]*((?:\\\n|[^\n])*)")
_NOISE = re.compile(r'"(?:\\.|[^"\\\n])*"|//[^\n]*|/\*.*?(?:\*/|\Z)', re.S)
_TOKEN = re.compile(
    r"""\s+|\(\*(?!\s*\)).*?\*\)
    |(?P<t>"(?:\\.|[^"\\])*"
    |\d[\d_]*\s*'[sS]?[bodhBODH]\s*[0-9a-fA-F_xXzZ?]+|'[sS]?[bodhBODH]\s*[0-9a-fA-F_xXzZ?]+|'[01xXzZ](?![\w'])|\d[\d_]*(?:\.\d[\d_]*)?
    |\\\S+|`?\$?[A-Za-z_][\w$]*
    |<<<=|>>>=|===|!==|<<<|>>>|<<=|>>=|==\?|!=\?|<=|>=|==|!=|&&|\|\||<<|>>|\*\*|\+\+|--|\+=|-=|\*=|/=|%=|&=|\|=|\^=|~&|~\||~\^|\^~|->|::|\+:|-:|'\{|'\(|.)""",
    re.S | re.X,
)


def without_comments(text: str) -> str:
    """Comments become blanks, lines stay where they are; strings are kept."""
    return _NOISE.sub(lambda m: m.group() if m.group()[0] == '"' else " " + "\n" * m.group().count("\n"), text)


def preprocess(text: str, defines: dict[str, str] | None = None) -> str:
    """The text that is left after directives: `ifdef and its kin choose by ``defines`` and the `define lines read so far; other directives are dropped."""
    known, live, out = dict(defines or {}), [], []
    lines = without_comments(text).split("\n")
    k = 0
    while k < len(lines):
        line = lines[k]
        while line.lstrip().startswith("`define") and line.endswith("\\") and k + 1 < len(lines):
            k += 1
            line = line[:-1] + " " + lines[k]
            out.append("")
        k += 1
        m = _DIRECTIVE.match(line.lstrip())
        word, rest = (m[1], m[2].split()) if m else ("", [])
        if word in ("ifdef", "ifndef"):
            hit = ((rest[0] if rest else "") in known) == (word == "ifdef")
            live.append([hit, hit])
            line = ""
        elif word in ("else", "elsif") and live:
            hit = not live[-1][1] and (word == "else" or (rest[0] if rest else "") in known)
            live[-1] = [hit, live[-1][1] or hit]
            line = ""
        elif word == "endif" and live:
            live.pop()
            line = ""
        elif not all(x[0] for x in live):
            line = ""
        elif word == "define" and rest:
            name = rest[0]
            if "(" not in name:
                known[name] = m[2].strip()[len(name) :].strip()
            line = ""
        elif word == "undef" and rest:
            known.pop(rest[0], None)
            line = ""
        elif word in ("include", "timescale", "default_nettype", "resetall", "line", "pragma", "celldefine", "endcelldefine"):
            line = ""
        for _ in range(8 if "`" in line else 0):  # macros in macros
            line = re.sub(r"`(\w+)", lambda m: known.get(m[1], m[0]), line)
        out.append(line)
    return "\n".join(out)


def tokens(text: str) -> tuple[list[str], list[int]]:
    """Tokens and the line of each, from 1."""
    out, lines, line = [], [], 1
    for m in _TOKEN.finditer(text):
        if t := m[1]:
            out.append(t)
            lines.append(line)
        if not t or len(t) > 1:
            line += m[0].count("\n")
    return out, lines
