"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct word shingles. Documents whose sets have a Jaccard similarity of
at least ``similarity`` are linked; a document's class is the smallest doc_id it reaches.

Candidates come from the forest. Each tree is one order of the signature's values; all documents are
sorted by each order, range-partitioned by order, values and document, so that any number of equal
keys spreads over tasks. A document's candidates in a tree are its neighbours there that share at
least ``LEAST_PREFIX`` leading values. The depth is therefore adaptive: in a sparse region neighbours
share few values, in a crowded one only those with the longest common prefix stand next to each
other. Neighbours across the edge of two partitions are found from the partitions' first and last
rows.

Every candidate pair whose keys agree often enough is confirmed on the two full sets. It is done in
rounds, since in a group of copies most pairs are not needed to know the class: first each document's
best pairs, then all pairs between different classes, and for each of them the pairs with the other
class's centres, the member that agrees best with its neighbours and the one with the most links. The
centres link the documents of a group in which copies resemble their origin but not each other. A round
goes on with the pairs that are still between classes, until one finds no link.

A window of ``NEIGHBOURS`` that is full leaves neighbours out. Documents with a full window are crowded,
and a link that no round could see has a crowded document at both ends. These are completed exactly:
two similar sets of n shingles have one of the first n - ceil(similarity * n) + 1 shingles of each in
common, in any order that holds for all sets. The order puts shingles first that occur in one class
only, which cannot link two classes, and then the others by the number of crowded documents that hold
them. A document takes part with those of its first shingles that lie in several classes: none, if its
own class's shingles fill them. The pairs of a frequent shingle are dealt over tasks, and pairs of
different classes are confirmed on full sets if their sizes fit and enough shingles follow the common
one in both.

What remains is chance: two documents at the least similarity share ``LEAST_PREFIX`` values in some tree
but for one case in ten million, and 64-bit hashes may collide.

Nulls and oddities: null and empty texts and texts without words have no shingles and are linked with
nothing. Rows with a null doc_id are linked with nothing either and have a null class. Rows that repeat
a doc_id with other texts are searched under each of them, and are linked with each other; ids
below 2^62 are presumed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rainfold.llm import components
from rainfold.llm.hashing import (
    U64,
    mix,
    pieces_of,
    reduce_by_text,
    sequence_hashes,
    shingles_of,
    words_of,
)
from rainfold.llm.storage import discard, stored

# Signature values, trees, values in a tree's key, neighbours on each side, the values
# that a candidate must share at the front of the key, and those of the whole key that must agree: two
# similar documents that share the front fall short of these once in a million.
VALUES = 64
TREES = 16
KEY_VALUES = 16
NEIGHBOURS = 2
LEAST_PREFIX = 2
LEAST_AGREED = 6
_BYTES = 2
# The rows of a shingle that one task pairs with all others, and nodes whose sets are
# looked up by a broadcast.
SLICE = 2_000
_FEW = 100_000
_CROWDED = -2


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the similarity of a link in hundredths."""

    shingle: int = 5
    percent: int = 80


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """Set size, two hashes of the word sequence, and MinHash signature of each row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = mix(np.arange(1, VALUES + 1, dtype=U64) * U64(0x9FB21C651E98DF25)) | U64(1)
        for batch in batches:
            for first, last in pieces_of(batch.column("text")):
                part = batch.slice(first, last - first)
                words, _, _ = words_of(part.column("text"))
                shingles, bounds = shingles_of(words, rule.shingle)
                low, high = sequence_hashes(words)
                sizes = [len(np.unique(shingles[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(low),
                        pa.array(high),
                        pa.array(_signatures(shingles, bounds, factors), pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "low", "high", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sketch,
        "doc_id long, n_shingles long, low long, high long, signature binary",
    )


def _signatures(shingles: np.ndarray, bounds: np.ndarray, factors: np.ndarray) -> list[bytes]:
    """The smallest of each permutation's values in each text, sixteen bits of it."""
    out = np.zeros((len(bounds) - 1, VALUES), dtype=">u2")
    step = max(1, len(bounds) // max(1, len(shingles) // 50_000))
    for first in range(0, len(bounds) - 1, step):
        edges = bounds[first : first + step + 1]
        part = shingles[edges[0] : edges[-1]]
        for k in range(VALUES):
            least = reduce_by_text(part * factors[k], edges - edges[0], np.minimum, 0)
            out[first : first + step, k] = mix(least) & U64(0xFFFF)
    return [row.tobytes() for row in out]


def _keys(nodes: DataFrame) -> DataFrame:
    """Each node once for each tree, under the signature turned to the tree's own start."""
    shift = VALUES // TREES * _BYTES
    return nodes.select(
        "node",
        F.expr("concat(signature, signature)").alias("twice"),
        F.expr(f"explode(sequence(0, {TREES - 1}))").alias("tree"),
    ).select(
        "node",
        F.expr(
            f"concat(unhex(lpad(hex(tree), 2, '0')),"
            f" substring(twice, tree * {shift} + 1, {KEY_VALUES * _BYTES}))"
        ).alias("key"),
    )


def _neighbour_pairs(keys: np.ndarray, nodes: np.ndarray, fresh: int) -> pd.DataFrame:
    """Pairs of rows at most NEIGHBOURS apart, of which the later is at or after row ``fresh``.

    Rows whose window is full come as pairs with ``_CROWDED``.
    """
    found = [pd.DataFrame({"a": [], "b": [], "agreed": []}, dtype="int64")]
    for gap in range(1, NEIGHBOURS + 1):
        later = np.arange(max(fresh, gap), len(keys))
        if not len(later):
            continue
        same = keys[later] == keys[later - gap]
        values = same[:, 1:].reshape(len(later), KEY_VALUES, _BYTES).all(axis=2)
        near = same[:, 0] & values[:, :LEAST_PREFIX].all(axis=1)
        agreed = values.sum(axis=1)
        take = near & (agreed >= LEAST_AGREED) & (nodes[later] != nodes[later - gap])
        a, b = nodes[later - gap][take], nodes[later][take]
        found.append(
            pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "agreed": agreed[take]})
        )
        if gap == NEIGHBOURS:
            full = np.unique(np.concatenate([nodes[later][near], nodes[later - gap][near]]))
            found.append(pd.DataFrame({"a": full, "b": _CROWDED, "agreed": -1}))
    return pd.concat(found)


def candidates(nodes: DataFrame, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes (a < b) that are neighbours in a tree, with how well their keys agree (0 to 1),
    and the crowded nodes."""
    width = 1 + KEY_VALUES * _BYTES

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_keys, held_nodes = np.zeros((0, width), np.uint8), np.zeros(0, np.int64)
        edge_keys, edge_nodes = [], []
        seen = 0
        for frame in frames:
            keys = np.frombuffer(b"".join(frame["key"]), np.uint8).reshape(-1, width)
            nodes = frame["node"].to_numpy()
            if seen < NEIGHBOURS:
                edge_keys += list(frame["key"][: NEIGHBOURS - seen])
                edge_nodes += list(nodes[: NEIGHBOURS - seen])
            seen += len(nodes)
            fresh = len(held_nodes)
            keys = np.concatenate([held_keys, keys])
            nodes = np.concatenate([held_nodes, nodes])
            yield _neighbour_pairs(keys, nodes, fresh).assign(key=None)
            held_keys, held_nodes = keys[-NEIGHBOURS:], nodes[-NEIGHBOURS:]
        if seen:
            edge_keys += [row.tobytes() for row in held_keys]
            edge_nodes += list(held_nodes)
            yield pd.DataFrame({"a": edge_nodes, "b": -1, "agreed": -1, "key": edge_keys})

    found = stored(
        _keys(nodes)
        .repartitionByRange("key", "node")
        .sortWithinPartitions("key", "node")
        .mapInPandas(scan, "a long, b long, agreed long, key binary"),
        "forest",
        paths,
    )
    inner = found.where("key is null").select("a", "b", "agreed")

    def scan_edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_keys, held_nodes = np.zeros((0, width), np.uint8), np.zeros(0, np.int64)
        for frame in frames:
            keys = np.frombuffer(b"".join(frame["key"]), np.uint8).reshape(-1, width)
            fresh = len(held_nodes)
            keys = np.concatenate([held_keys, keys])
            nodes = np.concatenate([held_nodes, frame["a"].to_numpy()])
            yield _neighbour_pairs(keys, nodes, fresh)
            held_keys, held_nodes = keys[-NEIGHBOURS:], nodes[-NEIGHBOURS:]

    # 2 * NEIGHBOURS rows for each partition of the sort, whatever the number of documents.
    edges = (
        found.where("key is not null")
        .select("key", "a")
        .distinct()
        .coalesce(1)
        .sortWithinPartitions("key", "a")
        .mapInPandas(scan_edges, "a long, b long, agreed long")
    )
    every = inner.unionByName(edges)
    pairs = (
        every.where(f"b <> {_CROWDED}")
        .groupBy("a", "b")
        .agg((F.avg("agreed") / KEY_VALUES).alias("agreed"))
    )
    crowded = every.where(f"b = {_CROWDED}").select(F.col("a").alias("node")).distinct()
    return stored(pairs, "pairs", paths), stored(crowded, "crowded", paths)


def confirmed(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            take = np.zeros(len(frame), dtype=bool)
            for at, (x, y) in enumerate(zip(frame["set_a"], frame["set_b"])):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                take[at] = 100 * both >= rule.percent * (len(x) + len(y) - both)
            yield frame.loc[take, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .select("a", "b", "set_a", "set_b")
        .mapInPandas(compare, "a long, b long")
    )


def _sets(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The shingle set of each of ``nodes`` (with its doc_id and low), as sorted values."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in pieces_of(batch.column("text")):
                part = batch.slice(first, last - first)
                words, _, _ = words_of(part.column("text"))
                shingles, bounds = shingles_of(words, rule.shingle)
                low, _ = sequence_hashes(words)
                keep = np.flatnonzero(low == np.asarray(part.column("low")))
                sets = [np.unique(shingles[bounds[i] : bounds[i + 1]]).tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").take(pa.array(keep)), pa.array(sets, pa.binary())],
                    names=["node", "set"],
                )

    wanted = nodes.select("node", "doc_id", "low")
    few = wanted.limit(_FEW + 1).count() <= _FEW
    wanted = F.broadcast(wanted) if few else wanted.hint("shuffle_hash")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(wanted, "doc_id")
        .mapInArrow(collect, "node long, set binary")
        .dropDuplicates(["node"])
    )


def _best(pairs: DataFrame, count: int) -> DataFrame:
    """Each node's ``count`` pairs that agree best; ties to the smaller partner."""
    both = pairs.select("a", "b", "agreed", F.col("a").alias("node")).unionByName(
        pairs.select("a", "b", "agreed", F.col("b").alias("node"))
    )
    both.createOrReplaceTempView("rainfold_forest_pairs")
    return both.sparkSession.sql(
        "select distinct a, b from (select a, b, row_number() over"
        " (partition by node order by agreed desc, a, b) as place from rainfold_forest_pairs)"
        f" where place <= {count}"
    )


def _across(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different classes, with those (a node alone is its own)."""
    of_a = classes.select(F.col("node").alias("a"), F.col("component").alias("class_a"))
    of_b = classes.select(F.col("node").alias("b"), F.col("component").alias("class_b"))
    return (
        pairs.select("a", "b")
        .join(of_a, "a", "left")
        .join(of_b, "b", "left")
        .withColumn("class_a", F.coalesce("class_a", "a"))
        .withColumn("class_b", F.coalesce("class_b", "b"))
        .where("class_a <> class_b")
    )


def _centre_pairs(
    across: DataFrame, pairs: DataFrame, classes: DataFrame, links: DataFrame
) -> DataFrame:
    """For each pair between classes: each node with the centres of the other's class."""
    ends = pairs.select(F.col("a").alias("node"), "agreed").unionByName(
        pairs.select(F.col("b").alias("node"), "agreed")
    )
    # A mean of few neighbours is drawn towards a middling one.
    fit = ends.groupBy("node").agg(
        ((F.sum("agreed") + 4 * 0.5) / (F.count("*") + 4)).alias("fit")
    )
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(
        F.count("*").cast("double").alias("fit")
    )
    centres = [
        fit.join(classes, "node")
        .groupBy("component")
        .agg(F.max(F.struct("fit", (-F.col("node")).alias("minus"))).alias("best"))
        .select("component", (-F.col("best.minus")).alias("centre"))
        for fit in (fit, degree)
    ]
    asked = across.select(F.col("a").alias("node"), F.col("class_b").alias("component")).unionByName(
        across.select(F.col("b").alias("node"), F.col("class_a").alias("component"))
    )
    return asked.distinct().join(centres[0].union(centres[1]), "component").select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")
    )


def _rest(crowded: DataFrame, sets: DataFrame, classes: DataFrame, rule: Rule, paths: list[str]):
    """All pairs of crowded nodes of different classes that may be similar, by their first shingles."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = [np.frombuffer(x, "<i8") for x in batch.column("set").to_pylist()]
            sizes = np.array([len(x) for x in shingles], dtype=np.int64)
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            columns = [batch.column(c).take(rows) for c in ("node", "class")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.zeros(0, np.int64), *shingles])),
                    *columns,
                    pa.array(np.repeat(sizes, sizes)),
                ],
                names=["shingle", "node", "class", "n"],
            )

    classed = (
        sets.join(crowded, "node", "left_semi")
        .join(classes, "node", "left")
        .selectExpr("node", "coalesce(component, node) as class", "set")
    )
    rows = classed.mapInArrow(spread, "shingle long, node long, class long, n long")
    shared = (
        rows.groupBy("shingle")
        .agg(F.count("*").alias("held"), F.min("class").alias("x"), F.max("class").alias("y"))
        .where("x <> y")
        .select("shingle", "held")
    )
    # Of n shingles the first n - ceil(similarity * n) + 1 count; those of one class come before.
    first = stored(
        rows.join(stored(shared, "shared", paths), "shingle")
        .selectExpr(
            "*",
            "row_number() over (partition by node order by held, shingle) as place",
            "count(*) over (partition by node) as many",
        )
        .where(f"place <= n - ({rule.percent} * n + 99) div 100 + 1 - (n - many)")
        .selectExpr(
            "shingle", "node", "class", "n", "n - many + place as place",
            f"cast(ceil(held / {SLICE}) as int) as slices",
        ),
        "first",
        paths,
    )
    # The smaller set of a pair needs its first n - ceil(2 s / (1 + s) * n) + 1 shingles only.
    both = 100 + rule.percent
    left = first.where(f"place <= n - ({2 * rule.percent} * n + {both - 1}) div {both} + 1").selectExpr(
        "shingle", "cast(pmod(xxhash64(node), slices) as int) as slice", "node as x",
        "class as class_x", "n as n_x", "place as place_x",
    )
    right = first.selectExpr(
        "shingle", "explode(sequence(0, slices - 1)) as slice", "node as y", "class as class_y",
        "n as n_y", "place as place_y",
    )
    # If this is a pair's first common shingle, so many more can follow on both sides at most.
    follow = "least(n_x - place_x, n_y - place_y)"
    return (
        left.join(right, ["shingle", "slice"])
        .where("class_x <> class_y and (n_x < n_y or n_x = n_y and x < y)")
        .where(f"100 * n_x >= {rule.percent} * n_y")
        .where(f"{both} * (1 + {follow}) >= {rule.percent} * (n_x + n_y)")
        .selectExpr("least(x, y) as a", "greatest(x, y) as b")
        .distinct()
    )


def _nodes(named: DataFrame, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """One node for each text, known by the smallest doc_id that holds it; and links between the
    nodes of a doc_id that holds several texts, of which all but one are known by a number of their own.
    """
    texts = named.groupBy("low", "high").agg(F.min("doc_id").alias("doc_id"))
    numbered = texts.selectExpr(
        "*", "row_number() over (partition by doc_id order by low, high) as place"
    )
    own = f"(xxhash64(low, high, doc_id) & {2**62 - 1}L) | {2**62}L"
    nodes = stored(
        numbered.selectExpr("low", "high", "doc_id", f"if(place = 1, doc_id, {own}) as node"),
        "texts",
        paths,
    )
    held = named.select("doc_id", "low", "high").distinct().join(
        nodes.select("low", "high", "node"), ["low", "high"]
    )
    # A doc_id with one text adds nothing.
    links = (
        held.groupBy("doc_id")
        .agg(F.min("node").alias("a"), F.max("node").alias("most"))
        .where("a <> most")
        .select("doc_id", "a")
        .join(held, "doc_id")
        .where("a <> node")
        .select("a", F.col("node").alias("b"))
    )
    return nodes, stored(links, "same-id", paths)


def _linked(
    docs: DataFrame, nodes: DataFrame, signed: DataFrame, given: DataFrame, rule: Rule,
    paths: list[str],
) -> DataFrame:
    """The class of every node that is linked with another."""
    spark = docs.sparkSession
    pairs, crowded = candidates(signed, paths)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowded).distinct()
    sets = stored(_sets(docs, nodes.join(ends, "node"), rule), "sets", paths)
    links = stored(confirmed(_best(pairs, 2), sets, rule), "links", paths)
    classes = components.connected(links.unionByName(given), paths)
    across, tried, left = pairs, None, []
    while True:
        round_: list[str] = []
        across = stored(_across(across, classes), "across", round_)
        asked = across.select("a", "b").unionByName(_centre_pairs(across, pairs, classes, links))
        asked = asked.distinct()
        if tried is not None:
            asked = asked.join(tried, ["a", "b"], "left_anti")
        asked = stored(asked, "asked", paths)
        new = stored(confirmed(asked, sets, rule), "links", paths)
        discard(spark, *left)
        left = round_
        if new.isEmpty():
            break
        links = links.unionByName(new)
        classes = components.connected(components.as_links(classes).unionByName(new), paths)
        tried = asked if tried is None else tried.unionByName(asked)
    discard(spark, *left)
    rest = stored(_rest(crowded, sets, classes, rule, paths), "rest", paths)
    new = stored(confirmed(rest, sets, rule), "links", paths)
    if new.isEmpty():
        return classes
    return components.connected(components.as_links(classes).unionByName(new), paths)


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``."""
    paths: list[str] = []
    sketch = stored(sketches(docs, rule), "sketches", paths)
    named = sketch.where("n_shingles > 0 and doc_id is not null")
    nodes, given = _nodes(named, paths)
    signed = (
        named.join(nodes, ["doc_id", "low", "high"])
        .select("node", "signature")
        .dropDuplicates(["node"])
    )
    classes = _linked(docs, nodes, signed, given, rule, paths)
    named_classes = nodes.join(classes, "node", "left").select(
        "low", "high", F.coalesce("component", "node").alias("class")
    )
    found = (
        sketch.select("doc_id", "n_shingles", "low", "high")
        .join(named_classes, ["low", "high"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.expr(
                "case when doc_id is null then null when n_shingles = 0 then doc_id"
                " else coalesce(class, doc_id) end"
            ).alias("component_id"),
        )
        .withColumn("kept", F.expr("doc_id <=> component_id"))
    )
    found = stored(found, "near-duplicates")
    discard(docs.sparkSession, *paths)
    return found


def drop_near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id."""
    gone = near_duplicates(docs, rule).where("not kept").select(F.col("doc_id").alias("_gone_id"))
    return docs.join(gone.distinct(), docs["doc_id"] == F.col("_gone_id"), "left_anti")
