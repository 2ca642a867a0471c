"""Chat formatting: reply trees to training conversations.

Messages reply to messages. Self-joins that double their reach each round give every message its
depth and the score of its whole path, and jump tables with which the chosen leaves' ancestors are
found again, so a path of n messages takes log n joins and no row ever holds a path. Branches are
ranked by score; each chosen path becomes one text with the spans that a loss applies to.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake.session import materialize

# Control strings of public chat formats, escaped in every text.
CONTROL_STRINGS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)


@dataclass(frozen=True)
class Template:
    """How a turn is written: ``start`` role line feed text ``end``. All of ``controls`` are escaped.

    An escaped control string has a backslash behind its first character; one that is already
    written with backslashes there gets one more, so taking one away gives the text back.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    trained_role: str = "assistant"
    controls: tuple[str, ...] = CONTROL_STRINGS

    def _behind(self) -> dict[str, str]:
        """By first character: a pattern of what follows it in the control strings, after any backslashes."""
        rests: dict[str, list[str]] = {}
        for control in self.controls:
            rests.setdefault(control[0], []).append(rf"\Q{control[1:]}\E")
        return {first: rf"\\*+(?:{'|'.join(r)})" for first, r in rests.items()}

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, "|".join(rf"\Q{c}\E(?={r})" for c, r in self._behind().items()), r"$0\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, "|".join(rf"(?<=\Q{c}\E)\\(?={r})" for c, r in self._behind().items()), "")

    def write_turn(self, role: Column, text: Column) -> Column:
        return F.concat(self._opening(role), self.escape(text), F.lit(self.end))

    def _opening(self, role: Column) -> Column:
        """Roles are written URL-encoded, so they hold neither line feeds nor control strings."""
        return F.concat(F.lit(self.start), F.url_encode(role), F.lit("\n"))

    def text_start(self, role: Column) -> Column:
        return F.length(self._opening(role))

    def read_turns(self, formatted: Column) -> Column:
        """Array of (role, text) of a formatted conversation."""
        parts = F.split(formatted, rf"\Q{self.end}\E")
        written = F.slice(parts, F.lit(1), F.size(parts) - 1)
        inner = F.transform(written, lambda t: F.substring(t, F.lit(len(self.start) + 1), F.length(t)))
        return F.transform(inner, lambda t: F.struct(
            F.url_decode(F.substring_index(t, "\n", 1)).alias("role"),
            self.unescape(F.substring(t, F.locate("\n", t) + 1, F.length(t))).alias("text")))

    def read_trained(self, formatted: Column, spans: Column) -> Column:
        """Array of the texts under the loss spans, unescaped."""
        return F.transform(spans, lambda s: self.unescape(
            F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def linear_replies(
    turns: DataFrame, tree_column: str = "conv_id", order_column: str = "turn", role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Messages of conversations that are plain lists: each turn replies to the one before it.

    Rows of one turn number are ordered by role, then text; nulls come first and null text is empty.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_column).cast("string"), F.lit(""))
    rows = turns.select(F.col(tree_column).alias("tree"), F.col(order_column).alias("o"), role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("o", "role", "text")).cast("long")
    return rows.withColumn("node", place).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"))


def _on(left: str, right: str) -> Column:
    """Join condition of two message tables by tree and message."""
    return F.col("l.tree").eqNullSafe(F.col("r.tree")) & (F.col(f"l.{left}") == F.col(f"r.{right}"))


def _jump_tables(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depths and path scores of all messages that have a root, and (tree, node, ancestor) 1, 2, 4, … up."""
    known = messages.select("tree", "node")
    reach = materialize(
        messages.alias("l").join(known.alias("r"), _on("parent", "node"), "left")
        .select("l.tree", "l.node", F.col("r.node").alias("ancestor"), F.col("l.score").alias("total"),
                F.lit(1).cast("long").alias("depth")))
    most = math.ceil(math.log2(max(2, reach.count()))) + 1
    jumps = []
    for _ in range(most):
        jump = reach.filter("ancestor IS NOT NULL")
        if jump.isEmpty():
            break
        jumps.append(jump.select("tree", "node", "ancestor"))
        # only messages that have not reached their root take part
        further = (jump.alias("l").join(reach.alias("r"), _on("ancestor", "node"))
                   .select("l.tree", "l.node", F.col("r.ancestor").alias("ancestor"),
                           (F.col("l.total") + F.col("r.total")).alias("total"),
                           (F.col("l.depth") + F.col("r.depth")).alias("depth")))
        reach = materialize(reach.filter("ancestor IS NULL").unionAll(further))
    return reach.filter("ancestor IS NULL").drop("ancestor"), jumps


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, path, depth, role, text): the messages of each tree's ``branches`` best root-to-leaf paths.

    ``messages(tree, node, parent, role, text, score)``; null scores count zero. A path's score is
    the sum over its messages, equal ones go to the smaller leaf, which also names the path. A
    message whose parent isn't there is a root; one that replies to itself in a circle is in no
    path. Of rows with the same tree and node the first by parent, role and text counts, rows
    without a node do not. Null trees are one tree.
    """
    unique = materialize(
        messages.filter("node IS NOT NULL").groupBy("tree", "node")
        .agg(F.min(F.struct("parent", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m"))
        .select("tree", "node", "m.*"))
    reach, jumps = _jump_tables(unique.select("tree", "node", "parent", "score"))
    parents = unique.filter("parent IS NOT NULL").select("tree", "parent").distinct()
    leaves = reach.alias("l").join(parents.alias("r"), _on("node", "parent"), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    path = materialize(leaves.withColumn("rank", rank).filter(F.col("rank") <= branches).select(
        "tree", F.col("node").alias("path"), "node"))
    for jump in reversed(jumps):
        up = path.alias("l").join(jump.alias("r"), _on("node", "node")).select(
            "l.tree", "l.path", F.col("r.ancestor").alias("node"))
        path = materialize(path.unionAll(up))
    texts = unique.alias("l").join(reach.alias("r"), _on("node", "node")).select(
        "l.tree", "l.node", "l.role", "l.text", "r.depth")
    return path.alias("l").join(texts.alias("r"), _on("node", "node")).select(
        "l.tree", "l.path", "r.depth", "r.role", "r.text")


def format_conversations(paths: DataFrame, template: Template = Template()) -> DataFrame:
    """(tree, path, formatted, loss): one text for each path of ``paths(tree, path, depth, role, text)``.

    ``loss`` has the (start, length) of each trained text in ``formatted``, in code points, as
    escaped there. Null roles and texts are empty. A path is one row, since it is one training example.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = Window.partitionBy("tree", "path").orderBy("depth")
    rows = paths.select("tree", "path", "depth", role.alias("role"), template.write_turn(role, text).alias("turn"))
    before = F.coalesce(F.sum(F.length("turn").cast("long")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opening = template.text_start(F.col("role")).cast("long")
    span = F.when(F.col("role") == template.trained_role, F.struct(
        (before + opening).alias("start"),
        (F.length("turn") - opening - len(template.end)).alias("length")))
    turns = F.array_sort(F.collect_list(F.struct("depth", "turn", "span")))
    joined = rows.withColumn("span", span).groupBy("tree", "path").agg(turns.alias("turns"))
    return joined.select(
        "tree", "path", F.array_join("turns.turn", "").alias("formatted"), F.array_compact("turns.span").alias("loss"))


def format_trees(messages: DataFrame, branches: int = 1, template: Template = Template()) -> DataFrame:
    """The best paths of reply trees, formatted; see ``best_paths`` and ``format_conversations``."""
    return format_conversations(best_paths(messages, branches), template)
