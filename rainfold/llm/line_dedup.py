"""Line dedup over a corpus, answered with run-length keep bitmaps instead of text.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. A key of at least
``least_length`` code points that occurs in at least ``least_documents`` documents keeps its lines
only in the largest doc_id that holds it.

Only built-in functions are used. Keys travel as 128 bits. They are range-partitioned by hash and
slice and sorted by hash, slice, document (largest first) and position; the first line of each run is
then the slice's survivor, and the running rank counts its documents. The slice comes from the
doc_id and spreads a key that holds a third of all lines over ``SLICES`` runs; one small row for each
run gives the whole key's count and survivor, at most ``SLICES`` rows for a key. The answer for a row
is ``keep_runs``: how many lines stay, how many go, how many stay and so on; ``[n]`` where all stay.

Nulls and oddities: a null or empty text has one empty line. A null doc_id counts as one document,
smaller than all others. Rows that repeat a doc_id count as one document; each row is decided by its
own text. Extra columns pass through ``without_repeats`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rainfold.llm.storage import row_key, stored

# Fixed value: the parts that the lines of one key are dealt to.
SLICES = 64
_TEXT = "coalesce(text, '')"


@dataclass(frozen=True)
class Rule:
    """Keys that are shorter, or in fewer documents, stay."""

    least_length: int = 40
    least_documents: int = 5


def _key(line: str) -> str:
    """SQL for the key; lower() changes A-Z only where all characters are ASCII."""
    key = f"btrim({line}, ' \\t\\n\\u000B\\u000C\\r')"
    return (
        f"if(length({line}) = octet_length({line}), lower({key}), translate({key},"
        " 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
    )


def line_hashes(docs: DataFrame, rule: Rule) -> DataFrame:
    """low, high, slice, doc_id, row and position of every line whose key is long enough."""
    lines = docs.selectExpr(
        "cast(doc_id as bigint) as doc_id",
        f"{row_key(_TEXT)} as row",
        f"posexplode(split({_TEXT}, '\\n')) as (position, line)",
    ).where(F.length("line") >= rule.least_length)
    keys = lines.selectExpr("doc_id", "row", "position", f"{_key('line')} as key")
    return keys.where(F.length("key") >= rule.least_length).selectExpr(
        "xxhash64(key) as low",
        "xxhash64(key, length(key)) as high",
        f"cast(pmod(xxhash64(doc_id), {SLICES}) as tinyint) as slice",
        "doc_id",
        "row",
        "position",
    )


def repeated_keys(lines: DataFrame, rule: Rule) -> DataFrame:
    """low, high and the surviving document of every key that is in enough documents."""
    ranged = lines.select("low", "high", "slice", "doc_id", "position").repartitionByRange(
        "low", "high", "slice"
    )
    runs = ranged.selectExpr(
        "low",
        "high",
        "dense_rank() over (partition by low, high, slice"
        " order by doc_id desc nulls last) as documents",
        "first_value(doc_id) over (partition by low, high, slice"
        " order by doc_id desc nulls last, position) as survivor",
        "lead(position) over (partition by low, high, slice"
        " order by doc_id desc nulls last, position) is null as last_line",
    )
    return (
        runs.where("last_line")
        .groupBy("low", "high")
        .agg(F.sum("documents").alias("documents"), F.max("survivor").alias("survivor"))
        .where(F.col("documents") >= rule.least_documents)
        .select("low", "high", "survivor")
    )


def keep_bitmaps(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, row (its text's key), dropped lines as sorted runs, for rows that lose lines."""
    lines = stored(line_hashes(docs, rule), "lines")
    repeated = stored(repeated_keys(lines, rule), "repeated-lines")
    gone = (
        lines.join(repeated, ["low", "high"])
        .where("not (doc_id <=> survivor)")
        .select("doc_id", "row", "position")
        .distinct()
    )
    islands = (
        gone.selectExpr(
            "doc_id",
            "row",
            "position",
            "position - row_number() over (partition by doc_id, row order by position) as island",
        )
        .groupBy("doc_id", "row", "island")
        .agg(F.min("position").alias("start"), F.count("*").cast("int").alias("length"))
    )
    spaced = islands.selectExpr(
        "doc_id",
        "row",
        "struct(start, start - coalesce(lag(start + length) over"
        " (partition by doc_id, row order by start), 0) as kept, length as dropped) as run",
    )
    return spaced.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("run")).alias("runs"))


def _decided(docs: DataFrame, rule: Rule) -> DataFrame:
    """``docs`` with rf_text, rf_lines and rf_keep_runs."""
    bitmaps = keep_bitmaps(docs, rule).selectExpr("doc_id as rf_id", "row as rf_row", "runs as rf_runs")
    with_key = docs.withColumns({"rf_text": F.expr(_TEXT), "rf_key": F.expr(row_key(_TEXT))})
    joined = with_key.join(
        bitmaps.hint("shuffle_hash"),
        (with_key["doc_id"].cast("long").eqNullSafe(F.col("rf_id")))
        & (F.col("rf_key") == F.col("rf_row")),
        "left",
    )
    return joined.withColumn(
        "rf_lines", F.expr("length(rf_text) - length(replace(rf_text, '\\n', '')) + 1")
    ).withColumn(
        "rf_keep_runs",
        F.expr(
            "case when rf_runs is null then array(rf_lines) else concat("
            "flatten(transform(rf_runs, r -> array(r.kept, r.dropped))),"
            " array(rf_lines - element_at(rf_runs, -1).start - element_at(rf_runs, -1).dropped)) end"
        ),
    )


# The kept lines, joined; a flag for each line stands beside it.
_KEPT = (
    "case when rf_runs is null then rf_text else array_join(transform(filter(zip_with("
    "split(rf_text, '\\n'), flatten(transform(rf_keep_runs, (n, i) -> array_repeat(i % 2 = 0, n))),"
    " (line, keep) -> struct(line, keep)), x -> x.keep), x -> x.line), '\\n') end"
)


def line_decisions(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_lines, keep_runs and the kept text of every row."""
    return _decided(docs, rule).selectExpr(
        "doc_id", "cast(rf_lines as bigint) as n_lines", "rf_keep_runs as keep_runs", f"{_KEPT} as kept"
    )


def without_repeats(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with the kept lines as text; a row that loses no line is unchanged.

    ``n_chars``, where there is such a column, follows the text.
    """
    changed = _decided(docs, rule).withColumn("text", F.expr(f"if(rf_runs is null, text, {_KEPT})"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn(
            "n_chars", F.expr("if(rf_runs is null, n_chars, length(text))").cast(kind)
        )
    return changed.select(*docs.columns)
