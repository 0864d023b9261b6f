"""Near-duplicate vectors by NN-descent.

Every vector keeps a list of neighbours. In a round, vectors that list each
other meet in groups; each group compares its members with one another, so a
vector sees the neighbours of its neighbours, and lists take what is better.
A list holds ``NEAR`` entries below the threshold; one that is saturated with
links (cosine at the threshold or more) is enlarged by every further link.
Linked vectors also meet under the smallest vector that two links reach, so a
group of near copies gathers in few rounds; pairs that met there before are
not compared again. Rounds end when they find no more links.

First lists come from random projections: vectors are sorted by the signs of
their projections and cut into runs of ``LEAF``, ``TREES`` times over. After
the rounds an audit compares ``AUDIT`` vectors, drawn by hash, with all others.
If less than ``RECALL`` of their links was found, by vector or in all, further
projections join in, and the rounds go on. Every link was verified in double
precision: none is below the threshold.

Scale: equal vectors are one node, with its number of copies. A round moves
each vector a dozen times, whatever the number of links. Groups of more than
2 * ``SPLIT`` vectors are cut into blocks, and every two blocks meet in a task
of their own; nothing is capped. A task holds one group. What grows faster
than the input is the links themselves: m different vectors that are all alike
have m * (m - 1) / 2 of them, which are found, stored once each and counted.
The driver gets the vectors of the audit, and counts.

Nulls and edge cases: a vector that is null, empty, zero or holds a null or
non-finite component, and one with a null id, links with nothing: it has no
links and is its own component. Vectors of different lengths never meet. Rows
that repeat an id are rows of their own. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import col, cut_lineage, ship_code
from shelfwise.llm.components import connected_components
from shelfwise.llm.ordering import numbered

NEAR = 6          # entries of a list below the threshold
TREES = 16        # sorted orders that seed the lists at a time
BITS = 40         # signs of projections that sort an order
LEAF = 1024       # vectors that meet first
PICKS = 3         # neighbours that a vector meets in a round, besides those that pick it
SPLIT = 512       # block of a large group
AUDIT = 1000      # vectors that are compared with all others
RECALL = 0.99     # share of their links that must have been found
SEED = 7
_LINKS = "v long, w long, sim double, link boolean"


def _prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(``id``, ``key``, ``d``, ``vec``): doubles scaled by a power of two, which cosines do not
    notice; ``key`` is a digest of the vector as it is, null for those that take no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(lists.flatten().cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False)
            start = np.cumsum(size) - size
            key, vec = [None] * len(size), [None] * len(size)
            for d in np.unique(size[size > 0]):
                at = np.flatnonzero(size == d)
                rows = flat[start[at][:, None] + np.arange(d)] + 0.0     # -0.0 is 0.0
                most = np.abs(rows).max(axis=1)
                good = np.isfinite(most) & (most > 0)
                for i, row, m in zip(at[good], rows[good], most[good]):
                    key[i] = hashlib.blake2b(row.tobytes(), digest_size=16).digest()
                    vec[i] = np.ldexp(row, -math.frexp(m)[1]).tobytes()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            key = pa.array([k if ok else None for k, ok in zip(key, known)], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, key, pa.array(size.astype(np.int32)), pa.array(vec, pa.binary())],
                                             names=["id", "key", "d", "vec"])

    return (vectors.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("vec"))
            .mapInArrow(run, "id long, key binary, d int, vec binary"))


def _unit(vecs: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(vecs)).reshape(len(vecs), -1)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosine(a: bytes, b: bytes) -> float:
    """The cosine of two vectors, every sum correctly rounded."""
    x, y = np.frombuffer(a), np.frombuffer(b)
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def _orders(nodes: DataFrame, first: int, trees: int) -> DataFrame:
    """(``tree``, ``d``, ``code``, ``node``) for ``trees`` sorted orders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = 1 << np.arange(BITS, dtype=np.int64)[::-1]
        for batch in batches:
            node, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vecs = batch.column(2).to_pylist()
            for d in np.unique(size):
                if d not in planes:
                    planes[d] = np.concatenate([np.random.default_rng([SEED, int(d), first + t])
                                                .standard_normal((d, BITS)) for t in range(trees)], axis=1)
                at = np.flatnonzero(size == d)
                signs = np.frombuffer(b"".join([vecs[i] for i in at])).reshape(len(at), d) @ planes[d] > 0
                code = (signs.reshape(len(at), trees, BITS) * weight).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(first, first + trees, dtype=np.int32), len(at))),
                     pa.array(np.full(len(at) * trees, d, dtype=np.int32)), pa.array(code.ravel()),
                     pa.array(np.repeat(node[at], trees))], names=["tree", "d", "code", "node"])

    return nodes.select("node", "d", "vec").mapInArrow(run, "tree int, d int, code long, node long")


def _compare(group: dict, threshold: float, near: int) -> tuple[np.ndarray, ...]:
    """(v, w, cosine, is a link) of one group: links once, and each member's best below the threshold."""
    node, vecs = group["node"], group["vec"]
    unit = _unit(vecs)
    sim = unit @ unit.T
    meet = group["new"][:, None] | group["new"][None, :]
    if group["a"] != group["b"]:                    # of two blocks, only what lies between them
        meet &= group["side"][:, None] != group["side"][None, :]
    np.fill_diagonal(meet, False)
    linked = sim >= threshold
    for i, j in zip(*np.nonzero(np.triu(np.abs(sim - threshold) < 1e-12, 1))):
        linked[i, j] = linked[j, i] = cosine(vecs[i], vecs[j]) >= threshold
    i, j = np.nonzero(np.triu(linked & meet, 1))
    out = [(np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), sim[i, j], np.ones(len(i), dtype=bool))]
    rest = np.where(meet & ~linked, sim, -3.0)
    if rest.shape[1] > near:
        best = np.argpartition(rest, -near, axis=1)[:, -near:]
    else:
        best = np.broadcast_to(np.arange(rest.shape[1]), rest.shape)
    value = np.take_along_axis(rest, best, axis=1)
    i, j = np.nonzero(value > np.maximum(group["tail"], -2.0)[:, None])
    out.append((node[i], node[best[i, j]], value[i, j], np.zeros(len(i), dtype=bool)))
    return tuple(np.concatenate(c) for c in zip(*out))


def _meet(members: DataFrame, nodes: DataFrame, near: DataFrame | None, threshold: float) -> DataFrame:
    """What groups (``kind``, ``g``) find whose members (``node``, ``new``) compare with one another."""
    members = cut_lineage(members)
    sizes = members.groupBy("kind", "g").agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("fresh"))
    sizes = cut_lineage(sizes.where("fresh and n > 1").drop("fresh"))
    blocks = F.when(F.col("n") > 2 * SPLIT, F.ceil(F.col("n") / SPLIT)).otherwise(1).cast("int")
    rows = members.join(sizes, ["kind", "g"]).withColumn("blocks", blocks)
    rows = (rows.withColumn("side", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("kind", "g", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"),
                    "side", "node", "new"))
    known = nodes.select("node", "vec")
    if near is None:
        known = known.withColumn("tail", F.lit(-2.0))
    else:
        tails = near.groupBy("v").agg(F.when(F.count(F.lit(1)) >= NEAR, F.min("sim")).alias("tail"))
        known = known.join(tails, known["node"] == tails["v"], "left").select(
            "node", "vec", F.coalesce("tail", F.lit(-2.0)).alias("tail"))
    rows = rows.join(cut_lineage(known), "node")
    keys = ["kind", "g", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(t: pa.Table) -> pa.RecordBatch:
            cols = {n: t.column(n).to_numpy() for n in ("node", "side", "tail", *keys)}
            cols["new"] = t.column("new").to_numpy().astype(bool)
            vecs = t.column("vec").to_pylist()
            cuts = np.flatnonzero(np.any([np.diff(cols[k]) != 0 for k in keys], axis=0)) + 1
            got = []
            for x, y in zip([0, *cuts], [*cuts, t.num_rows]):
                group = {n: c[x:y] for n, c in cols.items()} | {"vec": vecs[x:y], "a": cols["a"][x], "b": cols["b"][x]}
                got.append(_compare(group, threshold, NEAR))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*got)], names=["v", "w", "sim", "link"])

        held: list[pa.RecordBatch] = []           # the rows of the group that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            same = np.all([batch.column(k).to_numpy() == batch.column(k)[batch.num_rows - 1].as_py() for k in keys], axis=0)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut or held and any(held[0].column(k)[0] != batch.column(k)[0] for k in keys):
                yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield found(pa.Table.from_batches(held))

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "side", "node", "new", "tail", "vec").mapInArrow(run, _LINKS)


def _merge(links: DataFrame | None, near: DataFrame | None, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links (``v`` < ``w``), and the ``NEAR`` best others of every ``v``."""
    new = found.where("link").select("v", "w", "sim")
    links = cut_lineage((links.unionAll(new) if links is not None else new).groupBy("v", "w").agg(F.max("sim").alias("sim")))
    other = found.where("not link").select("v", "w", "sim")
    lists = (near.unionAll(other) if near is not None else other).groupBy("v", "w").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("sim"), "w"))
    return links, cut_lineage(lists.withColumn("rank", rank).where(F.col("rank") <= NEAR).drop("rank"))


def _both(links: DataFrame) -> DataFrame:
    return links.select("v", "w").unionAll(links.select(F.col("w").alias("v"), F.col("v").alias("w")))


def audited_recall(nodes: DataFrame, links: DataFrame, threshold: float, queries: int = AUDIT) -> float:
    """The share of links found, of ``queries`` nodes against all: the lesser of the mean over
    nodes and of the share of all their links. 1 if they have none."""
    asked = cut_lineage(nodes.orderBy(F.xxhash64("key"), "node").limit(queries).select("node", "d", "vec"))
    sample = asked.collect()            # at most ``queries`` vectors
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(r["d"], []).append((r["node"], bytes(r["vec"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = {d: (np.array([n for n, _ in rows]), _unit([v for _, v in rows])) for d, rows in by_size.items()}
        total = {d: np.zeros(len(ids), dtype=np.int64) for d, (ids, _) in units.items()}
        for batch in batches:
            size, vecs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for d in set(size.tolist()) & units.keys():
                at = np.flatnonzero(size == d)
                for part in np.array_split(at, -(-len(at) // 1024)):
                    total[d] += (units[d][1] @ _unit([vecs[i] for i in part]).T >= threshold).sum(axis=1)
        for d, (ids, _) in units.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[d])], names=["node", "n"])

    there = nodes.select("d", "vec").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    have = _both(links).join(asked, F.col("v") == F.col("node")).groupBy("node").agg(F.count(F.lit(1)).alias("found"))
    got = (there.withColumn("n", F.col("n") - 1).where("n > 0").join(have, "node", "left")
           .withColumn("found", F.least("n", F.coalesce("found", F.lit(0))))
           .agg(F.avg(F.col("found") / F.col("n")).alias("mean"), (F.sum("found") / F.sum("n")).alias("share")).first())
    return 1.0 if got["mean"] is None else min(got["mean"], got["share"])


def descend(nodes: DataFrame, threshold: float) -> DataFrame:
    """(``v``, ``w``, ``sim``): the links between ``nodes`` (``node``, ``key``, ``d``, ``vec``), each once with v < w."""
    links = near = lead = None
    turn = 0
    while True:
        placed = numbered(_orders(nodes, TREES * turn, TREES), ["tree", "d"], ["code"])
        # A group of its own for each order, length of vectors and run.
        run = F.floor(F.col("pos") / LEAF)
        seeds = placed.select(F.col("tree").alias("kind"), F.xxhash64("d", run).alias("g"), "node", F.lit(True).alias("new"))
        links, near = _merge(links, near, cut_lineage(_meet(seeds, nodes, near, threshold)))
        size = links.count()
        while True:
            turn += 1
            lists = _both(links).unionAll(near.select("v", "w"))
            picks = lists.groupBy("v").agg(*[F.min_by("w", F.xxhash64("v", "w", F.lit(turn), F.lit(i))).alias(f"w{i}")
                                             for i in range(PICKS)])
            picked = cut_lineage(picks.select("v", F.explode(F.array_distinct(F.array(*[f"w{i}" for i in range(PICKS)]))).alias("w")))
            around = (picked.select(F.col("w").alias("g"), F.col("v").alias("node"))
                      .unionAll(picked.select(F.col("v").alias("g"), F.col("w").alias("node")))
                      .unionAll(picked.select(F.col("v").alias("g"), F.col("v").alias("node")))
                      .unionAll(picked.select(F.col("w").alias("g"), F.col("w").alias("node"))).distinct())
            # The smallest vector that two links reach; it can only fall from round to round.
            linked = _both(links)
            least = cut_lineage(linked.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("least")))
            over = linked.join(least.withColumnRenamed("v", "w"), "w").groupBy("v").agg(F.min("least").alias("over"))
            now = least.join(over, "v").select("v", F.least("least", "over").alias("lead"))
            now = now.withColumn("was", F.lit(None).cast("long")) if lead is None else \
                now.join(lead.withColumnRenamed("lead", "was"), "v", "left")
            now = cut_lineage(now)
            led = now.select(F.lit(-1).alias("kind"), F.col("lead").alias("g"), F.col("v").alias("node"),
                             (~F.col("was").eqNullSafe(F.col("lead"))).alias("new"))
            lead = now.select("v", "lead")
            members = led.unionByName(around.select(F.lit(-2).alias("kind"), "g", "node", F.lit(True).alias("new")))
            links, near = _merge(links, near, cut_lineage(_meet(members, nodes, near, threshold)))
            before, size = size, links.count()
            if size - before <= size // 1000 and turn > 1:
                break
        if audited_recall(nodes, links, threshold) >= RECALL:
            return links


def near_components(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links`` (rows linked with it), ``component_id``
    (smallest id that links reach, its own included) and ``kept`` (whether that is its own)."""
    ship_code(vectors.sparkSession)
    rows = cut_lineage(_prepared(vectors, id_col, vector_col))
    usable = rows.where("key IS NOT NULL")
    classes = usable.groupBy("key").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("size"),
                                        F.min("d").alias("d"), F.min("vec").alias("vec"))
    nodes = cut_lineage(cut_lineage(classes).withColumn("node", F.monotonically_increasing_id()))
    links = descend(nodes.select("node", "key", "d", "vec"), threshold)
    sizes = nodes.select(F.col("node").alias("w"), "size")
    degree = _both(links).join(sizes, "w").groupBy("v").agg(F.sum("size").alias("others"))
    roots = connected_components(links, "v", "w")
    named = nodes.join(roots, "node").groupBy("root").agg(F.min("first_id").alias("smallest"))
    roots = cut_lineage(roots.join(named, "root").select("node", "smallest"))
    known = cut_lineage(
        nodes.select("node", "key", "first_id", "size").join(cut_lineage(degree), F.col("node") == F.col("v"), "left").drop("v")
        .join(roots, "node", "left")
        .select("key", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                F.coalesce("smallest", "first_id").alias("component_id")))
    linked = usable.select("id", "key").join(known, "key").select("id", "n_links", "component_id")
    alone = rows.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
