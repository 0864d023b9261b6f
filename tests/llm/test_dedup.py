"""Exact de-duplication, SimHash and components against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfwise.llm import simhash
from shelfwise.llm.components import connected_components
from shelfwise.llm.exact_dedup import exact_groups, keep_one
from shelfwise.llm.simhash import fingerprint, keep_one_of_each, near_nodes, simhash_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, h string, fp int, kept string"
LONG = "Long Text " * 20_000


def docs(spark, rows):
    """Documents with columns that clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", None, 7, "x", 1, "y") for i, t in rows], SCHEMA)


EDGE = [(1, "Same text"), (2, "same TEXT"), (3, None), (4, ""), (5, " \t\n"), (6, "É same"), (7, "é same"),
        (8, LONG), (9, LONG.upper()), (10, "one"), (11, "one"), (11, "one"), (None, "one"), (None, None), (12, "İ K")]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, keep, weak):
    # A weak hash makes different texts collide: they must stay apart.
    how = {"hash_of": lambda n: F.char_length(n)} if weak else {}
    got = sorted(map(tuple, exact_groups(docs(spark, EDGE), keep=keep, **how).select(
        "doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    want = []
    for i, t in EDGE:
        group = [j for j, u in EDGE if lower(u) == lower(t)]
        ids = [j for j in group if j is not None]
        best = {"min": min, "max": max}[keep](ids) if ids else None
        want.append((i, best, len(group), i == best))
    assert got == sorted(want, key=str)


def test_exact_digest_and_empty(spark):
    import hashlib
    got = {r.doc_id: r.text_sha256 for r in exact_groups(docs(spark, EDGE[:9])).collect()}
    assert got == {i: hashlib.sha256(lower(t).encode()).hexdigest() for i, t in EDGE[:9]}
    assert exact_groups(docs(spark, [])).collect() == []
    assert keep_one(docs(spark, [])).collect() == []


@pytest.mark.parametrize("keep", ["min", "max"])
def test_keep_one(spark, keep):
    d = docs(spark, EDGE)
    out = keep_one(d, keep=keep)
    assert out.columns == d.columns and out.schema.simpleString() == d.schema.simpleString()
    rows = out.collect()
    assert len(rows) == len({lower(t) for _, t in EDGE})
    best = {"min": min, "max": max}[keep]
    for r in rows:
        ids = [j for j, u in EDGE if lower(u) == lower(r.text) and j is not None]
        assert r.doc_id == best(ids)


def slow_fingerprint(text, k):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("text", [None, "", "  \n", "one", "One two", "a b c", "a b a b a b a b", "Été ÉTÉ x y \x0bz\x1cq",
                                  "the quick brown fox jumps " * 40])
def test_fingerprint(text):
    assert fingerprint(text, 3) == slow_fingerprint(text, 3)
    assert fingerprint(text, 5) == slow_fingerprint(text, 5)


def near_roots(spark, fps, most, segments):
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    return {r.node: r.root for r in near_nodes(df, most, segments).collect()}, signed


@pytest.mark.parametrize("most,segments", [(3, 2), (3, 4), (5, 3), (0, 1), (4, 2)])
def test_near_nodes(spark, most, segments):
    rng = random.Random(most * 10 + segments)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, 2 ** 64 - 1}
    for f in list(fps):
        for _ in range(2):
            g = f
            for b in rng.sample(range(64), rng.randint(1, most + 2)):
                g ^= 1 << b
            fps.add(g)
    for f in list(fps)[:6]:           # groups that share a segment and lie apart: more than the first links must see
        for _ in range(12):
            g = f
            for b in rng.sample(range(22), rng.randint(1, 8)):
                g ^= 1 << b
            fps.add(g)
    got, signed = near_roots(spark, fps, most, segments)
    links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= most]
    linked = {x for pair in links for x in pair}
    assert got == {n: r for n, r in union_find(linked, links).items()}


def test_a_large_group_of_near_fingerprints_is_joined_by_few_links(spark, monkeypatch):
    """Rows of links grow with the group, not with its square."""
    rng = random.Random(2)
    seen = []
    plain = simhash.connected_components
    monkeypatch.setattr(simhash, "connected_components", lambda links, a, b: seen.append(links.count()) or plain(links, a, b))
    for size in (200, 800):
        centre, fps = rng.getrandbits(64), set()
        while len(fps) < size:
            g = centre
            for b in rng.sample(range(32), rng.randint(1, 3)):
                g ^= 1 << b
            fps.add(g)
        got, signed = near_roots(spark, fps | {centre}, 3, 2)
        assert len(got) == size + 1 and len(set(got.values())) == 1
    assert max(seen) < 800 * 3 * 35 and seen[-1] < 6 * seen[0]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)]                      # a chain
    links += [(7, i) for i in range(200, 260)]                         # a star
    links += [(rng.randint(300, 380), rng.randint(300, 380)) for _ in range(70)]
    links += [(5, 5), (3, 4), (4, 3), (3, 4)]
    got = {r.node: r.root for r in connected_components(
        spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long"), "a", "b").collect()}
    nodes = {x for l in links if l[0] != l[1] for x in l}
    assert got == {n: r for n, r in union_find(nodes, [l for l in links if l[0] != l[1]]).items()}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_components_of_a_hub_with_the_largest_id(spark):
    links = spark.range(100_000).select(F.lit(10 ** 9).alias("a"), F.col("id").alias("b"))
    got = connected_components(links, "a", "b")
    assert got.agg(F.count("*"), F.min("root"), F.max("root")).first()[:] == (100_001, 0, 0)


def test_simhash_components(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = list(EDGE[:-1])
    for i in range(20, 60):
        base = rng.choices(words, k=rng.randint(1, 300))
        rows.append((i * 10, " ".join(base)))
        if i % 2:
            base[rng.randrange(len(base))] = "changed"
            rows.append((i * 10 + 1, "  ".join(base)))
    rows = [(i, t) for i, t in rows if i is not None] + [(None, "one"), (None, "alone in this")]
    got = simhash_components(docs(spark, rows)).collect()
    fp = [slow_fingerprint(t, 3) for _, t in rows]
    n = range(len(rows))
    roots = union_find(n, [(a, b) for a in n for b in n if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    want = []
    for k in n:
        ids = [rows[j][0] for j in n if roots[j] == roots[k] and rows[j][0] is not None]
        want.append((rows[k][0], f"{fp[k]:016x}", min(ids) if ids else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash_components(docs(spark, [])).collect() == []


def test_one_of_each_stays(spark):
    rng = random.Random(9)
    word = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    rows = []
    for i in range(30):
        base = word(400)
        rows.append((i * 10, " ".join(base)))
        for k in range(1, 3):
            near = list(base)
            near[rng.randrange(400)] = f"y{k}"
            rows.append((i * 10 + k, " ".join(near)))
    a, b = " ".join(word(300)), " ".join(word(300))
    rows += [(9000, None), (9001, ""), (9002, "a b"), (9003, "a  B"), (9004, LONG), (9005, LONG), (None, "a b"),
             (5000, a), (5000, b), (4999, a), (None, "quite alone here")]          # one id on two texts
    fp = [slow_fingerprint(t, 3) for _, t in rows]
    n = range(len(rows))
    roots = union_find(n, [(x, y) for x in n for y in n if x < y and (fp[x] ^ fp[y]).bit_count() <= 3])
    want = []
    for root in set(roots.values()):
        want.append(min((rows[x][0] is None, rows[x][0] or 0, x) for x in n if roots[x] == root)[2])
    d = docs(spark, rows)
    kept = keep_one_of_each(d)
    assert kept.columns == d.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == sorted(
        rows[x] for x in want if rows[x][0] is not None)
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["quite alone here"]
    assert keep_one_of_each(docs(spark, [])).collect() == []
