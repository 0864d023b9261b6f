"""Merkle manifest and prefix trie against brute force, and their helpers."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import merkle, prefix_trie
from shelfwise.llm.ordering import numbered, running

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """(root, siblings of each leaf from the leaf upwards), level by level."""
    proofs, under = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [digests[i:i + 2] for i in range(0, len(digests), 2)]
        groups = [under[i:i + 2] for i in range(0, len(under), 2)]
        for run, members in zip(runs, groups):
            for at, leaves in enumerate(members):
                for i in leaves:
                    proofs[i] += [d for j, d in enumerate(run) if j != at]
        digests, under = [H("".join(r)) for r in runs], [sum(g, []) for g in groups]
    return digests[0], proofs


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r[0]))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in langs}
    root, above = tree([trees[g][0] for g in langs])
    return sorted(str((x[3], x[2], trees[g][0], root, H("".join(p + up))))
                  for g, up in zip(langs, above) for x, p in zip(sorted(groups[g]), trees[g][1]))


def some_docs():
    rng = random.Random(3)
    rows = [(i, f"s{i % 3}", rng.choice(["en", "de", "é", "", None, "zz"]) if i % 3 else "en", i, "wörd " * (i % 7)) for i in range(150)]
    rows += [(None, None, None, None, None), (None, "s", "en", 1, "a"), (7, "again", "en", 0, ""), (9, "s0", "en", 9, "x"),
             (9, "s0", "en", 9, "x"), (200, "s", "only", 5, "long " * 60_000), (201, "", "", 0, "")]
    return rows


@pytest.mark.parametrize("block", [4, 64, 4096])
def test_manifest(spark, block):
    rows = some_docs()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", leaf string, witness int").repartition(7)
    got = merkle.manifest(df, carry={"n": F.col("n_chars")}, block=block).withColumn(
        "proof", merkle.proof_sha256(F.col("witness"))).withColumn("folded", merkle.fold(F.col("leaf"), F.col("witness"))).collect()
    assert sorted(str((r.doc_id, r.leaf, r.subroot, r.root, r.proof)) for r in got) == brute_manifest(rows)
    assert all(r.folded == r.root for r in got) and len(got) == len(rows)


def test_manifest_of_one_and_of_none(spark):
    one = [(5, "s", "en", 1, "a")]
    got = merkle.manifest(spark.createDataFrame(one, DOCS)).collect()
    assert [(r.leaf, r.subroot, r.root, r.witness) for r in got] == [(leaf_of(one[0]),) * 3 + ([],)]
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_tampering_breaks_the_proof(spark):
    df = spark.createDataFrame(some_docs(), DOCS)
    forged = merkle.leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    got = merkle.manifest(df, carry={"forged": forged}, block=16)
    bad = got.where(merkle.fold(F.col("forged"), F.col("witness")) == F.col("root"))
    assert bad.count() == 1                                    # the row whose n_chars is null stays as it is


def test_open_tree_extends_witnesses_of_both_sides():
    for n in (1, 2, 3, 5, 8, 13):
        t, digests = merkle.OpenTree(), [H(str(i)) for i in range(n)]
        for d in digests:
            t.append(d.encode())
        root, proofs = tree(digests)
        assert t.close(0).decode() == root
        assert [[d.decode() for _, d in w if d] for w in t.witnesses] == proofs
    t = merkle.OpenTree()
    for i in range(5):
        t.append(H(str(i)).encode())
    before = [len(w) for w in t.witnesses]                     # aligned subtrees of 4 and 1 are open
    for i in range(5, 8):
        t.append(H(str(i)).encode())
    assert before == [2, 2, 2, 2, 0] and [len(w) for w in t.witnesses] == [3] * 8


def test_numbered_and_running_spread_a_hot_group(spark):
    rows = [("hot", i % 50, i) for i in range(3000)] + [(None, i, i) for i in range(40)] + [("one", None, 1)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(9)
    got = numbered(df, ["g"], ["o"]).collect()
    assert len(got) == len(rows)
    for g in ("hot", None, "one"):
        mine = sorted((r.pos, r.o if r.o is not None else -1, r.total) for r in got if r.g == g)
        assert [p for p, _, _ in mine] == list(range(len(mine))) and {t for *_, t in mine} == {len(mine)}
        assert [o for _, o, _ in mine] == sorted(o for _, o, _ in mine)
    df = spark.createDataFrame([("hot", i, i * 3) for i in range(1000)] + [("b", 0, 5)], "g string, p long, v long")
    got = {(r.g, r.p): int(r.s) for r in running(df, "g", "p", {"s": F.col("v")}, block=64).collect()}
    assert got == {("hot", i): 3 * i * (i + 1) // 2 for i in range(1000)} | {("b", 0): 5}


def brute_trie(rows, base, head):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            said = (role or "", text or "")
            tie = H(str(len(said[0].encode())) + ":" + said[0] + said[1])
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, said))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    convs = {c: tuple(own.get(base(c), [])[:head(c)] + t[head(c):]) for c, t in own.items()}
    nodes = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            nodes.setdefault(t[:d], []).append(c)
    children = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        done = sorted(c for c in members if len(convs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children[p]),
                    sum(not children[q] for q in below), saved, H(",".join(map(str, done)))))
    return sorted(out, key=str)


def run_trie(spark, rows, schema=TURNS):
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, schema).repartition(5))
    c = F.col("conv")
    convs, turns = prefix_trie.rebuilt(turns, c - c % 5, F.crc32(c.cast("string")) % 9, most=8)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = prefix_trie.trie(convs, turns)
    assert got.columns == names and {t for _, t in got.dtypes[:-1]} == {"bigint"}
    return sorted((tuple(r) for r in got.collect()), key=str)


HEAD = {"base": lambda c: c - c % 5, "head": lambda c: zlib.crc32(str(c).encode()) % 9}


def test_trie(spark):
    rng = random.Random(11)
    rows = []
    for c in range(60):
        for t in range(rng.choice([0, 1, 2, 3, 6, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long " * 9])))
    rows += [(101, None, "user", "null turn"), (101, None, "user", "null turn"), (101, 3, "user", "b"), (101, 3, "user", "a"),
             (None, 0, "user", "of no conversation"), (130, 0, "user", "é" * 200_000), (131, 0, "user", "é" * 200_000)]
    assert run_trie(spark, rows) == brute_trie(rows, **HEAD)


def test_trie_of_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(200, 500) for t in range(3)]       # one sequence, many ends
    rows += [(1000, t, "user", f"turn {t}") for t in range(600)]                          # a path through them
    rows += [(c, 0, "user", "turn 0") for c in range(600, 640)]
    got = run_trie(spark, [(*r, "x", 1) for r in rows], TURNS + ", depth string, leaf int")
    convs = {}
    for c, t, _, text in rows:
        convs.setdefault(c, []).append(text)
    short = [r for r in rows if r[0] != 1000 or r[1] < 30]     # the brute force is quadratic in depth
    want = brute_trie(short, **HEAD)
    assert len(got) == len(want) + 570
    assert [r for r in got if r[1] < 3 and r[1] > 0 and r[4] != 1] == [r for r in want if r[1] < 3 and r[1] > 0 and r[4] != 1]
    assert max(r[1] for r in got) == 600


def test_ends_are_hashed_over_chunks_in_order(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(1000)], "k long, conv long").repartition(7)
    lists = prefix_trie.ends(df, ["k"], "conv", chunk=16)
    got = {r.k: r.ends_sha256 for r in prefix_trie.ends_sha256(lists, ["k"]).collect()}
    assert got == {k: H(",".join(str(i) for i in range(k, 1000, 3))) for k in range(3)}
    assert lists.count() == 3 * 21


def test_trie_of_nothing(spark):
    assert run_trie(spark, []) == []
    assert run_trie(spark, [(None, 0, "user", "x")]) == []
