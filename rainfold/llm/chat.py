"""Chat formatting with relational operators and built-in functions only.

A conversation's turns are collected as structs and sorted by turn. Adjacent turns of one role are
merged by array functions into a block with several texts, and blocks are concatenated:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

``<|im_sep|>`` stands between merged turns, so that they can be told apart again. Texts and roles are
escaped: a backslash more is put into every ``<``, backslashes, ``|``. No control string is left in
them, and taking one backslash out again gives the text back. A line break in a role becomes
``<|nl|>``. ``loss_spans`` are the ranges of the assistant's texts in the formatted string, in code
points: start, and end behind it. All steps are linear in the turns of a conversation; the pieces'
places are a window sum, in the partitioning that the collection left.

Nulls and oddities: a null role or text is empty; a null turn comes first. Turns with the same number
are ordered by role and text, and repeated rows are all kept. Rows with a null conv_id are one
conversation. An empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The template's control strings, and the role that is trained on.
START, SEPARATOR, END, BREAK = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"
LOSS_ROLE = "assistant"


def _escaped(column: str) -> str:
    return f"regexp_replace(coalesce({column}, ''), r'<(\\\\*)\\|', r'<\\\\$1|')"


def _unescaped(column: str) -> str:
    return f"regexp_replace({column}, r'<\\\\(\\\\*)\\|', '<$1|')"


def _quoted(text: str) -> str:
    return "'" + text.replace("\n", "\\n") + "'"


# Where a role differs from the one before, a block starts; it reaches to the next start.
_STARTS = """filter(sequence(0, size(turns) - 1), i -> i = 0 or turns[i].role <> turns[i - 1].role)"""
_MERGED = """transform(starts, (s, k) -> named_struct('role', turns[s].role, 'texts', transform(
  slice(turns, s + 1, coalesce(get(starts, k + 1), size(turns)) - s), t -> t.text)))"""

_PIECES = f"""flatten(transform(blocks, b -> flatten(array(
  array(struct(concat({_quoted(START)}, b.role, '\\n') as piece, false as loss)),
  flatten(transform(b.texts, (t, i) -> if(i = 0, array(struct(t as piece, b.role = '{LOSS_ROLE}' as loss)),
    array(struct({_quoted(SEPARATOR)} as piece, false as loss),
          struct(t as piece, b.role = '{LOSS_ROLE}' as loss))))),
  array(struct({_quoted(END)} as piece, false as loss))))))"""

# How many code points of a conversation stand before a piece.
_AT = (
    "coalesce(sum(length(piece)) over (partition by conv_id order by pos"
    " rows between unbounded preceding and 1 preceding), 0)"
)


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans of every conversation (conv_id, turn, role, text)."""
    role = f"replace({_escaped('role')}, '\\n', {_quoted(BREAK)})"
    return (
        turns.selectExpr(
            "conv_id", f"struct(turn, {role} as role, {_escaped('text')} as text) as turn"
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .selectExpr("conv_id", "turns", f"{_STARTS} as starts")
        .selectExpr("conv_id", f"{_MERGED} as blocks")
        .selectExpr("conv_id", f"posexplode({_PIECES}) as (pos, p)")
        .selectExpr("conv_id", "pos", "p.piece", "p.loss")
        .selectExpr("conv_id", f"struct(pos, piece, loss, {_AT} as at) as p")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("p")).alias("pieces"))
        .selectExpr(
            "conv_id",
            "array_join(transform(pieces, p -> p.piece), '') as formatted",
            "transform(filter(pieces, p -> p.loss), p ->"
            " named_struct('start', p.at, 'end', p.at + length(p.piece))) as loss_spans",
        )
    )


def parsed(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role and text, unescaped) and loss_texts, from the format."""
    block = _quoted(END.rstrip("\n"))
    return conversations.selectExpr(
        "conv_id",
        "formatted",
        "flatten(transform(filter(split(formatted, r'<\\|im_start\\|>'), (x, i) -> i > 0), block ->"
        " transform(split(substring_index(substr(block, locate('\\n', block) + 1),"
        f" {block}, 1), r'<\\|im_sep\\|>'), text -> named_struct('role', "
        + _unescaped(f"replace(substring_index(block, '\\n', 1), {_quoted(BREAK)}, '\\n')")
        + f", 'text', {_unescaped('text')})))) as turns",
        "transform(loss_spans, s -> "
        + _unescaped("substr(formatted, cast(s.start + 1 as int), cast(s.end - s.start as int))")
        + ") as loss_texts",
    )
