"""Table functions for SQL: tokens, tree nodes and section rows of a text; ``register`` makes them known to a session."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="pos: int, token: string, line: int")
class RtlTokens:
    """rtl_tokens(text): the tokens of a text with their place."""

    def eval(self, text: str):
        from quillgate.rtl import lex

        toks, lines = lex.tokens(lex.preprocess(text or ""))
        for k, (t, n) in enumerate(zip(toks, lines)):
            yield k, t, n


@udtf(returnType="node: int, parent: int, depth: int, kind: string, value: string")
class TreeNodes:
    """tree_nodes(expression): one row per node, the root first; nothing for what can't be read."""

    def eval(self, text: str):
        from quillgate.functions import expr

        try:
            todo = [(expr.read(text or ""), -1, 0)]
        except (ValueError, RecursionError):
            return
        n = 0
        while todo:
            node, parent, depth = todo.pop()
            yield n, parent, depth, node[0], node[1] if len(node) > 1 and isinstance(node[1], str) else None
            todo += [(c, n, depth + 1) for c in reversed(expr.kids(node))]
            n += 1


@udtf(returnType="section: string, module: string, name: string, kind: string, target: string, value: string, n: long")
class RtlParse:
    """rtl_parse(text): section rows of all modules of a text."""

    def eval(self, text: str):
        from quillgate.sources import rtl

        for r in rtl.sections(text or ""):
            yield tuple(r.get(c) for c in ("section", "module", "name", "kind", "target", "value", "n"))


def register(spark: SparkSession) -> None:
    from ..sources.tables import ship
    from . import similarity

    ship(spark)
    spark.udtf.register("rtl_tokens", RtlTokens)
    spark.udtf.register("tree_nodes", TreeNodes)
    spark.udtf.register("rtl_parse", RtlParse)
    spark.udf.register("seq_ratio", similarity.seq_ratio)
    spark.udf.register("longest_run", similarity.longest_run)
