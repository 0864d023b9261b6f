"""Merkle dataset manifest with incremental witnesses.

Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and value. Per group (a language) the leaves stand in
the order of their ids; every two consecutive nodes become the hash of both,
a last odd one the hash of itself, until one is left, the group's subroot.
Subroots, in the order of their groups (null first, bytewise), give the root
in the same way.

Leaves come to an ``OpenTree`` as a stream. It keeps the roots of the complete
aligned subtrees so far (as a binary counter does) and for every leaf a
partial witness up to the subtree it is in; when a later sibling completes,
both sides are extended by each other's root. A group is cut into aligned
blocks, each of which is one such stream in a task of its own; the block roots
are themselves appended to a tree of the next level, and so on. A leaf's
witness is that of its block followed by its block root's.

Scale: whole texts are read once and not moved. Rows are dealt by ranges of
(group, id), so a group with a third of all rows is spread; a task holds
``block`` leaves and their witnesses. The driver decides on nothing but
whether some group has more than one node left: one step for each factor
``block`` of the rows.

Nulls and edge cases: a null field is hashed as ``-`` (an empty one as
``0:``); null ids come first, null groups are a group. Rows with the same id
stand in the order of their leaves, and equal rows are leaves of their own.
Texts are hashed whole. An empty table has no leaf, no root and gives an empty
result. Columns that are not fields are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import col, cut_lineage, ship_code
from shelfwise.llm.ordering import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = 4096  # nodes whose witnesses grow in one task
_STEP = T.StructType([T.StructField("left", T.BooleanType()), T.StructField("digest", T.BinaryType())])


def field(c: Column) -> Column:
    """One field as it enters a leaf."""
    value = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


class OpenTree:
    """A tree of digests (lowercase hex, as bytes) that grows at its right end.

    ``witnesses[i]`` lists leaf i's siblings so far, from the leaf upwards:
    (whether the sibling is on the left, its digest), or (None, None) where
    the node stands alone."""

    def __init__(self):
        self.witnesses: list[list[tuple[bool | None, bytes | None]]] = []
        self._open: list[tuple[int, bytes, int, int]] = []  # height, root, first and last leaf; heights fall

    def append(self, digest: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._add(0, digest, at, at + 1)

    def _add(self, height: int, digest: bytes, first: int, last: int) -> None:
        while self._open and self._open[-1][0] == height:
            _, other, start, end = self._open.pop()
            for w in self.witnesses[start:end]:
                w.append((False, digest))
            for w in self.witnesses[first:last]:
                w.append((True, other))
            height, digest, first = height + 1, _hash(other + digest), start
        self._open.append((height, digest, first, last))

    def close(self, height: int) -> bytes:
        """The root at ``height``, or higher if one node is left only there."""
        while len(self._open) > 1 or self._open[0][0] < height:
            h, digest, first, last = self._open.pop()
            for w in self.witnesses[first:last]:
                w.append((None, None))
            self._add(h + 1, _hash(digest), first, last)
        return self._open[0][1]


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def _grow(nodes: DataFrame, block: int) -> DataFrame:
    """``nodes`` (``key``, ``pos``, ``total``, ``digest`` and more) with ``block``, ``witness``
    (up to the root of the block) and ``top`` (that root)."""
    ship_code(nodes.sparkSession)
    nodes = nodes.withColumn("block", F.floor(F.col("pos") / block))
    schema = T.StructType([*nodes.schema.fields, T.StructField("witness", T.ArrayType(_STEP)),
                           T.StructField("top", T.StringType())])
    full = (block - 1).bit_length()

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("pos")
        tree = OpenTree()
        for digest in group.column("digest").to_pylist():
            tree.append(digest.encode())
        # Beside other blocks, the last one too ends at the height of a full block.
        top = tree.close(full if group.column("total")[0].as_py() > block else 0)
        ends, left, digests = [0], [], []
        for steps in tree.witnesses:
            for side, digest in steps:
                left.append(side)
                digests.append(bytes.fromhex(digest.decode()) if digest else None)
            ends.append(len(left))
        steps = pa.StructArray.from_arrays([pa.array(left, pa.bool_()), pa.array(digests, pa.binary())],
                                           names=["left", "digest"])
        witness = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
        return group.append_column("witness", witness).append_column(
            "top", pa.array([top.decode()] * group.num_rows, pa.string()))

    return nodes.groupBy("key", "block").applyInArrow(run, schema)


def _climb(nodes: DataFrame, block: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of blocks, lowest first, and each key's root: (``key``, ``digest``)."""
    levels = []
    while True:
        levels.append(cut_lineage(_grow(nodes, block)))
        tops = levels[-1].groupBy("key", "block").agg(F.min("top").alias("digest"), F.min("total").alias("total"))
        nodes = cut_lineage(tops.select("key", F.col("block").alias("pos"), "digest",
                                        F.ceil(F.col("total") / block).alias("total")))
        if nodes.where("total > 1").isEmpty():
            return levels, nodes.select("key", "digest")


def _descend(levels: list[DataFrame], above: DataFrame, roots: list[str]) -> DataFrame:
    """The lowest level with whole witnesses. ``above``: ``key``, ``witness`` and ``roots`` of each key's root."""
    above = above.select("key", F.lit(0).cast("long").alias("block"), F.col("witness").alias("_more"), *roots)
    for n, level in enumerate(reversed(levels)):
        above = (level.join(above, ["key", "block"])
                 .withColumn("witness", F.concat("witness", "_more")).drop("_more", "top", "block"))
        if n < len(levels) - 1:
            above = above.select("key", F.col("pos").alias("block"), F.col("witness").alias("_more"), *roots)
    return above


def fold(start: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""
    def step(digest: Column, s: Column) -> Column:
        other = F.lower(F.hex(s["digest"]))
        return F.sha2(F.when(s["left"].isNull(), digest).when(s["left"], F.concat(other, digest))
                      .otherwise(F.concat(digest, other)), 256)

    return F.aggregate(witness, start, step)


def proof_sha256(witness: Column) -> Column:
    """Hash of all siblings, from the leaf upwards."""
    siblings = F.filter(witness, lambda s: s["digest"].isNotNull())
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.lower(F.hex(s["digest"]))), ""), 256)


def manifest(docs: DataFrame, fields: list[str] = FIELDS, group_col: str = "lang", id_col: str = "doc_id",
             carry: dict[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: its id, ``leaf``, ``subroot``, ``root``, ``witness`` (array of
    ``left``, ``digest`` from the leaf upwards, both null where a node stands alone), and ``carry``.

    ``fold(leaf, witness)`` is ``root`` if nothing was tampered with."""
    carry = carry or {}
    # A null group first, the rest bytewise.
    key = F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit(""))
    rows = docs.select(col(id_col).alias("id"), key.alias("key"), leaf([col(c) for c in fields]).alias("digest"),
                       *[c.alias(f"carry_{n}") for n, c in carry.items()])
    levels, subroots = _climb(numbered(rows, ["key"], ["id", "digest"]), block)
    groups = subroots.select(F.col("key").alias("group"), F.lit("").alias("key"), "digest")
    over, roots = _climb(numbered(groups, ["key"], ["group"]), block)
    none = F.array().cast(T.ArrayType(_STEP))
    top = _descend(over, roots.select("key", none.alias("witness"), F.col("digest").alias("root")), ["root"])
    top = top.select(F.col("group").alias("key"), "witness", "root", F.col("digest").alias("subroot"))
    out = _descend(levels, top, ["root", "subroot"])
    return out.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "witness",
                      *[F.col(f"carry_{n}").alias(n) for n in carry])
