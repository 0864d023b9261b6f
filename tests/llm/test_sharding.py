"""Sharding against a bit-by-bit split of the same hashes."""

import hashlib

from pyspark.sql import functions as F

from shelfwise.llm import sharding


def split(rows, limit, depth=0):
    """Extendible hashing, one bit at a time: {prefix: rows}."""
    if not rows:
        return {}
    if sum(b for _, b, _ in rows) <= limit or len(rows) == 1:
        return {rows[0][2][:depth]: rows}
    out = {}
    for bit in "01":
        out |= split([r for r in rows if r[2][depth] == bit], limit, depth + 1)
    return out


def bits(key):
    return bin(int(hashlib.md5(key.encode()).hexdigest(), 16))[2:].zfill(128)


def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({"path": F.lit("p"), "bytes": F.lit("b"), "shard": F.lit("s"), "row": F.lit(1)})


def test_equals_bit_by_bit_split(spark):
    rows = [(i, "é" * (i * 37 % 400)) for i in range(700)] + [(701, None), (702, "x" * 40_000), (703, "")]
    got = sharding.assign(docs(spark, rows), limit=3000).collect()
    want = split([(i, len((t or "").encode()), bits(str(i))) for i, t in rows], 3000)
    assert {r.doc_id: r.shard for r in got} == {i: s for s, rs in want.items() for i, _, _ in rs}
    for r in got:
        inside = want[r.shard]
        assert (r.shard_bytes, r.shard_docs) == (sum(b for _, b, _ in inside), len(inside))
        assert r.depth == len(r.shard) and r.oversize == (r.shard_bytes > 3000)
    assert [r.doc_id for r in got if r.oversize] == [702] and max(r.depth for r in got) > 5
    names = sorted({r.shard for r in got})
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))    # no shard lies inside another


def test_a_hot_key_is_split_too(spark):
    rows = [(5, "x" * 100)] * 600 + [(i, "y" * 100) for i in range(1000, 1400)] + [(None, "z" * 100)] * 30
    got = sharding.assign(docs(spark, rows), limit=5000).collect()
    assert len(got) == len(rows) and not any(r.oversize for r in got)
    by_shard = {}
    for r in got:
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.bytes
    assert max(by_shard.values()) <= 5000 and all(by_shard[r.shard] == r.shard_bytes for r in got)
    assert len({r.shard for r in got if r.doc_id == 5}) >= 12


def test_edges_and_files(spark, tmp_dir):
    assert sharding.assign(docs(spark, []), limit=10).collect() == []
    one = sharding.assign(docs(spark, [(1, "abc")]), limit=1).collect()
    assert [(r.shard, r.depth, r.oversize) for r in one] == [("", 0, True)]
    d = docs(spark, [(i, "x" * 50) for i in range(200)])
    table = sharding.write_shards(d, f"{tmp_dir}/shards", limit=1000)
    back = spark.read.option("basePath", f"{tmp_dir}/shards").schema(
        "doc_id long, text string, shard string").parquet(f"{tmp_dir}/shards")
    want = {r.shard: r.shard_docs for r in table.collect()}
    assert {r.shard: r.n for r in back.groupBy("shard").agg(F.count("*").alias("n")).collect()} == want
    assert sum(want.values()) == 200 and max(want.values()) <= 20


def test_files_hold_every_row_once(spark, tmp_dir):
    """Rows with a null or a repeated key are written, each once."""
    rows = [(i, "x" * 50) for i in range(60)] + [(5, "y" * 50)] * 40 + [(5, f"z{i:03}" * 10) for i in range(30)]
    rows += [(None, f"n{i:03}" * 10) for i in range(30)] + [(None, "n" * 50)] * 10 + [(None, None), (7, None)]
    table = sharding.write_shards(docs(spark, rows), f"{tmp_dir}/rows", limit=1000)
    got = spark.read.schema("doc_id long, text string, shard string").parquet(f"{tmp_dir}/rows").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    want = {r.shard: (r.shard_docs, r.shard_bytes) for r in table.collect()}
    for shard, (n, size) in want.items():
        inside = [r for r in got if r.shard == shard]
        assert (len(inside), sum(len(r.text or "") for r in inside)) == (n, size) and size <= 1000
