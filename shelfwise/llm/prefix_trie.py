"""The trie of all conversations' prefixes, by collapsing whole sequences.

A conversation is a sequence of turns; a node of the trie is a distinct
sequence of the first d turns of some conversation. Identical conversations
are first grouped into one weighted sequence with the list of those that end
there. A sequence that is a proper prefix of another one is an inner node;
an anti join against all proper prefixes leaves the leaves. Prefixes of the
sequences are then aggregated by their weights.

A prefix is known by its depth and two sums, over its turns, of 60 bits of
the SHA-256 of place, role and text, modulo 2 ** 60: sums can be taken piece
by piece, and taking the last turn away gives the parent. (Two different
prefixes of a depth agree with a chance of 2 ** -120.)

A subtree's total is taken without visiting pairs of nodes and ancestors:
every node belongs to the first leaf sequence below it, so along a leaf
sequence the nodes that belong to it are the last ones. The sum from a place
to the end of what belongs to the sequence, added up over all leaf sequences
through a node, is the total of the node's subtree.

Scale: texts are read once and become digests. Turns are numbered over ranges
and summed by blocks of a conversation, so one with a third of all turns is
spread over tasks; work is one row for each turn of each distinct sequence.
A node that all conversations share is combined on the map side. Ends are
joined into texts of ``CHUNK`` ids each, and hashed as a stream in order, so
no task holds a list of all of them.

Nulls and edge cases: null roles and texts are empty; a null turn number
comes first; turns of one number stand in the order of the digests of role
and text. Rows without a conversation id belong to no conversation and take
no part. Equal rows are turns of their own. Very long texts are hashed whole.
An empty table has no node, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import col, cut_lineage
from shelfwise.llm.ordering import numbered, running

CHUNK = 4096          # ids that are joined to one text
_WORD = 1 << 60       # prefix sums are taken modulo this
KEY = ["depth", "k1", "k2"]


def ordered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(``conv``, ``pos`` from 0, ``total``, ``digest``, ``bytes`` of the text) of all turns."""
    role_, text_ = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    rows = turns.where(col(conv).isNotNull()).select(
        col(conv).cast("long").alias("conv"), col(turn).alias("turn"), digest.alias("digest"),
        F.octet_length(text_).cast("long").alias("bytes"))
    return numbered(rows, ["conv"], ["turn", "digest"]).drop("turn")


def rebuilt(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with another one's head: the first ``head`` (at most ``most``) turns
    of conversation ``base``, then their own turns after as many. Both are columns over ``conv``.

    Returns all conversations (``conv``) and their turns (``conv``, ``pos``, ``digest``, ``bytes``)."""
    turns = cut_lineage(turns)
    convs = turns.groupBy("conv").agg(F.min("total").alias("total"))
    convs = convs.select("conv", "total", base.cast("long").alias("base"), head.cast("long").alias("head"))
    there = convs.select(F.col("conv").alias("base"), F.col("total").alias("base_total"))
    convs = cut_lineage(convs.join(there, "base", "left")
                        .withColumn("lent", F.least("head", F.coalesce("base_total", F.lit(0)))))
    lent = convs.select("conv", "base", "lent")
    first = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    heads = first.join(lent, "base").where("pos < lent").select("conv", "pos", "digest", "bytes")
    own = (turns.join(convs.select("conv", "head", "lent"), "conv").where("pos >= head")
           .select("conv", (F.col("pos") - F.col("head") + F.col("lent")).alias("pos"), "digest", "bytes"))
    return convs.select("conv"), heads.unionByName(own)


def _terms(pos: Column, digest: Column) -> list[Column]:
    """Two numbers of 60 bits for a turn in its place."""
    mixed = F.sha2(F.concat(pos.cast("string"), F.lit(":"), digest), 256)
    return [F.conv(F.substring(mixed, at, 15), 16, 10).cast("long") for at in (1, 16)]


def _wrapped(c: Column) -> Column:
    """``c`` modulo 2 ** 60, which is never negative."""
    return F.pmod(c, F.lit(_WORD).cast("decimal(38,0)")).cast("long")


def ends(members: DataFrame, key: list[str], id_col: str, chunk: int = CHUNK) -> DataFrame:
    """The list of each key's ids, ascending, as texts of ``chunk`` ids: ``key``, ``chunk``, ``ids``."""
    placed = numbered(members.select(*key, id_col), key, [id_col])
    return (placed.withColumn("chunk", F.floor(F.col("pos") / chunk)).groupBy(*key, "chunk")
            .agg(F.array_join(F.sort_array(F.collect_list(id_col)).cast("array<string>"), ",").alias("ids")))


def ends_sha256(lists: DataFrame, key: list[str]) -> DataFrame:
    """``key`` and ``ends_sha256``, the digest of all ids joined by commas. Chunks pass by in order; none is kept."""
    names = [*key, "ends_sha256"]
    schema = ", ".join(f"{k} {lists.schema[k].dataType.simpleString()}" for k in key) + ", ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for *k, ids in zip(*[batch.column(n).to_pylist() for n in [*key, "ids"]]):
                if k != now:
                    if state is not None:
                        done.append([*now, state.hexdigest()])
                    now, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in [*now, state.hexdigest()]], names=names)

    ordered = lists.repartition(*key).sortWithinPartitions(*key, "chunk")
    return ordered.select(*key, "ids").mapInArrow(run, schema)


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    ``convs`` holds every conversation once (``conv``), also those without turns; ``turns`` their
    turns (``conv``, ``pos`` from 0 without gaps, ``digest``, ``bytes``)."""
    t1, t2 = _terms(F.col("pos"), F.col("digest"))
    sums = running(turns.select("conv", "pos", "bytes", t1.alias("t1"), t2.alias("t2")), "conv", "pos",
                   {"s1": F.col("t1"), "s2": F.col("t2")})
    prefixes = cut_lineage(sums.select(
        "conv", (F.col("pos") + 1).cast("long").alias("depth"), _wrapped(F.col("s1")).alias("k1"),
        _wrapped(F.col("s2")).alias("k2"), "t1", "t2", "bytes"))

    # Identical conversations are one sequence; its ends are the conversations.
    last = prefixes.groupBy("conv").agg(F.max(F.struct("depth", "k1", "k2")).alias("last"))
    whole = cut_lineage(convs.join(last, "conv", "left").select(
        "conv", *[F.coalesce(F.col("last")[k], F.lit(0)).cast("long").alias(k) for k in KEY]))
    sequences = cut_lineage(whole.groupBy(*KEY).agg(F.min("conv").alias("seq"), F.count(F.lit(1)).alias("weight")))
    listed = cut_lineage(ends_sha256(ends(whole, KEY, "conv"), KEY))

    # Prefixes of the sequences, the textless root among them.
    root = sequences.select("seq", F.lit(0).cast("long").alias("depth"),
                            *[F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "t1", "t2", "bytes")],
                            F.col("depth").alias("length"), "weight")
    length = sequences.select("seq", F.col("depth").alias("length"), "weight")
    paths = cut_lineage(prefixes.withColumnRenamed("conv", "seq").join(length, "seq").unionByName(root))
    proper = paths.where("depth < length").select(*KEY).distinct()
    leaves = cut_lineage(sequences.join(proper, KEY, "left_anti").select("seq", F.lit(True).alias("leaf")))
    paths = cut_lineage(paths.join(leaves, "seq", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False))))

    up = [F.when(F.col("depth") > 0, F.pmod(F.col(k) - F.col(t), F.lit(_WORD))).alias(f"p{k}")
          for k, t in (("k1", "t1"), ("k2", "t2"))]
    nodes = cut_lineage(
        paths.select(*KEY, "seq", "weight", "leaf", "bytes", *up).groupBy(*KEY)
        .agg(F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count_if("leaf").alias("n_leaves"),
             F.min(F.when(F.col("leaf"), F.col("seq"))).alias("owner"), F.max("bytes").alias("bytes"),
             F.max("pk1").alias("pk1"), F.max("pk2").alias("pk2")))

    # What each node saves stands once, on the path of its first leaf sequence.
    saved = nodes.select(*KEY, "owner", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    own = F.when(F.col("owner") == F.col("seq"), F.col("saved")).otherwise(F.lit(0))
    walked = cut_lineage(paths.where("leaf").join(saved, KEY).select("seq", *KEY, "length", own.alias("own")))
    upto = running(walked, "seq", "depth", {"upto": F.col("own")})
    of_path = cut_lineage(walked.groupBy("seq").agg(F.sum("own").alias("all")))
    rest = upto.join(of_path, "seq").select(*KEY, (F.col("all") - F.col("upto") + F.col("own")).alias("rest"))
    below = rest.groupBy(*KEY).agg(F.sum("rest").cast("long").alias("saved_tokens"))

    parent = [(F.col("depth") - 1).alias("depth"), F.col("pk1").alias("k1"), F.col("pk2").alias("k2")]
    children = nodes.where("depth > 0").select(*parent).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"),
                         F.col("conv_id").alias("parent_conv_id"))
    nodes = cut_lineage(nodes.join(below, KEY).join(children, KEY, "left").join(listed, KEY, "left"))
    return nodes.join(above, ["depth", "pk1", "pk2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
