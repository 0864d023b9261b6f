"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit for each of 64 positions: 1 if the bit is
set in over half of the XXH64 values (seed 42) of its word shingles. To find
all fingerprints within ``max_distance`` bits, a fingerprint is cut into
segments; two that differ in at most k bits differ in at most k // segments
bits of some segment. Each distinct fingerprint is entered in a table under
every segment value and looks up every value in a small Hamming ball around
its own; matches are verified on all 64 bits.

Scale: only distinct fingerprints take part (copies share one), so a group
of equal documents costs one entry however large it is. A pair is looked up
from one side only: from the fingerprint whose lowest differing segment bit
is 0. With two segments of 32 bits a table value holds fingerprints that
agree in 32 bits, which for unrelated texts stays near one even at billions
of fingerprints. A group of many different near fingerprints is joined by
links to a few of them, not by all its pairs (``near_nodes``). Texts are read
once; everything after is 8 bytes a row.

Nulls and edge cases: a null text is empty; a text without words has
fingerprint 0 and links like any other; fewer words than a shingle make one
shingle of them all. A row with a null id has a fingerprint and can link
others, but never names a component (all-null components get null). Rows
that repeat an id are rows of their own. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import col, cut_lineage, ship_code
from shelfwise.llm.components import connected_components

SEED = 42
BITS = 64
_ROWS = 1 << 14  # shingles counted at once, which bounds the bit matrix of a long text


def shingle_hashes(text: str | None, shingle: int = 3) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words (of all words, if they are fewer)."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype="<u8")
    ends, at = [], 0
    for w in words:
        at += len(w)
        ends.append(at)
        at += 1
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])], dtype="<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text as an unsigned integer."""
    h = shingle_hashes(text, shingle)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(h), _ROWS):
        part = h[i:i + _ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id, fp): one row for each row of ``docs``; ``fp`` holds the 64 bits as a long."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)),
                              dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))],
                                             names=["id", "fp"])

    kind = docs.select(col(id_col)).schema[0].dataType.simpleString()
    return (docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, fp long"))


def _segments(count: int) -> list[tuple[int, int]]:
    """(shift, width) of ``count`` segments that cover the 64 bits."""
    cuts = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    """64 bits as Spark's long."""
    return x - (1 << 64) if x >> 63 else x


def _ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``width`` bits."""
    return [_signed(sum(1 << i for i in bits)) for r in range(radius + 1)
            for bits in combinations(range(width), r)]


def _entries(fps: DataFrame, max_distance: int, segments: int) -> tuple[DataFrame, DataFrame]:
    """(``b``, ``seg``, ``key``): where fingerprints are entered; (``a``, ``seg``, ``key``, ``same``): where
    they look, ``same`` under their own value."""
    radius = max_distance // segments
    tables, probes = [], []
    for n, (shift, width) in enumerate(_segments(segments)):
        key = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(_signed((1 << width) - 1)))
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])
        looked_up = F.transform(
            F.filter(masks, lambda m: key.bitwiseAND(m.bitwiseAND(-m)) == 0),
            lambda m: F.struct(F.lit(n).alias("seg"), key.bitwiseXOR(m).alias("key"), (m == 0).alias("same")))
        tables.append(F.struct(F.lit(n).alias("seg"), key.alias("key")))
        probes.append(looked_up)
    table = fps.select(F.col("fp").alias("b"), F.explode(F.array(*tables)).alias("e"))
    probe = fps.select(F.col("fp").alias("a"), F.explode(F.concat(*probes)).alias("e"))
    return table.select("b", "e.seg", "e.key"), probe.select("a", "e.seg", "e.key", "e.same")


def near_nodes(fps: DataFrame, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """(``node``, ``root``) of the fingerprints that have another one at ``max_distance`` bits or
    fewer: the components of all such pairs. ``fps`` has one column ``fp`` of distinct values.

    Every looked-up value is first verified against three of the fingerprints entered
    under it (the smallest, the largest, and one by hash), which joins a group of any size by
    as many links as it has lookups. Only where a value still holds several components are
    their fingerprints compared with one another, and only across components."""
    table, probe = _entries(fps, max_distance, segments)
    hubs = table.groupBy("seg", "key").agg(
        F.min("b").alias("h0"), F.max("b").alias("h1"), F.min_by("b", F.xxhash64("b")).alias("h2"),
        F.count(F.lit(1)).alias("n"))
    met = cut_lineage(probe.join(cut_lineage(hubs), ["seg", "key"]).where("n > 1 OR h0 <> a"))

    def near(a: str, b: str) -> Column:
        return (F.col(a) != F.col(b)) & (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_distance)

    links = met.select("a", F.explode(F.array("h0", "h1", "h2")).alias("b")).where(near("a", "b")).distinct()
    nodes = cut_lineage(connected_components(links, "a", "b"))

    def rooted(df: DataFrame, name: str) -> DataFrame:
        roots = nodes.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
        return df.join(roots, name, "left").withColumn(f"root_{name}", F.coalesce(f"root_{name}", name))

    # Values with several fingerprints; of them those that do not lie in one component.
    lookers = cut_lineage(rooted(met.where("n > 1").select("a", "seg", "key", "same"), "a"))
    full = lookers.select("seg", "key").distinct()
    entered = cut_lineage(rooted(table.join(full, ["seg", "key"], "left_semi"), "b"))
    all_roots = (lookers.select("seg", "key", F.col("root_a").alias("r"))
                 .unionAll(entered.select("seg", "key", F.col("root_b").alias("r"))))
    mixed = cut_lineage(all_roots.groupBy("seg", "key").agg(F.min("r").alias("x"), F.max("r").alias("y"))
                        .where("x <> y").select("seg", "key"))
    if mixed.isEmpty():
        return nodes
    left = cut_lineage(lookers.join(mixed, ["seg", "key"], "left_semi"))
    right = cut_lineage(entered.join(mixed, ["seg", "key"], "left_semi").withColumnsRenamed({"seg": "seg_b", "key": "key_b"}))
    on = ((F.col("seg") == F.col("seg_b")) & (F.col("key") == F.col("key_b")) & near("a", "b")
          & (F.col("root_a") != F.col("root_b")) & (~F.col("same") | (F.col("a") < F.col("b"))))
    more = cut_lineage(left.join(right, on).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct())
    if more.isEmpty():
        return nodes
    return connected_components(nodes.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more), "a", "b")


def _classes(fps: DataFrame, first: Column, max_distance: int, segments: int) -> DataFrame:
    """(``fp``, ``first``): the least ``first`` of the rows of ``fps`` in each fingerprint's component."""
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min(first).alias("first")))
    nodes = near_nodes(distinct.select("fp"), max_distance, segments)
    linked = distinct.join(nodes, distinct["fp"] == nodes["node"]).select("fp", "first", "root")
    named = linked.groupBy("root").agg(F.min("first").alias("of_all"))
    linked = linked.join(named, "root").select("fp", "of_all", F.lit(True).alias("linked"))
    # Written out, so that a join by ``fp`` is a plain one of two shuffles: a
    # fingerprint that many documents share is then split over tasks.
    return cut_lineage(distinct.join(linked, "fp", "left")
                       .select("fp", F.when(F.col("linked"), F.col("of_all")).otherwise(F.col("first")).alias("first")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``
    (the smallest id that can be reached over links, its own included)."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    return (fps.join(_classes(fps, F.col("id"), max_distance, segments), "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("first").alias("component_id")))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = 3, max_distance: int = 3, segments: int = 2) -> DataFrame:
    """The rows of ``docs``, whole, that stand for their component: of each the one with the
    smallest id (a null id comes last), of an id that repeats the text with the smallest digest.
    Rows equal in id and text are one document and stay or go together. Only ids and digests of
    the rows that go meet the texts again."""
    mark = F.md5(F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary"))
    who = F.struct(col(id_col).isNull().alias("none"), col(id_col).alias("id"), mark.alias("mark"))
    fps = cut_lineage(fingerprints(docs.select(who.alias("who"), col(text_col).alias("text")), "who", "text", shingle))
    classes = _classes(fps, F.col("id"), max_distance, segments)
    gone = "_gone"
    while any(c.lower().startswith(gone) for c in docs.columns):
        gone += "_"
    goes = (fps.join(classes, "fp").where(F.col("id") != F.col("first"))
            .select(F.col("id.id").alias(f"{gone}id"), F.col("id.mark").alias(f"{gone}mark")).distinct())
    same = (mark == F.col(f"{gone}mark")) & col(id_col).eqNullSafe(F.col(f"{gone}id"))
    return docs.join(cut_lineage(goes), same, "left_anti").select(*[col(c) for c in docs.columns])
