"""The registered queries against their SQL, and the pipeline stage by stage."""

import hashlib

import corpus_pipeline
import duckdb
import pytest

from shelfwise.llm import langid, mixing, queries
from shelfwise.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.ORACLE[name])
    names = [c[0] for c in cur.description]
    want = sorted(str([str(v) for _, v in sorted(zip(names, r))]) for r in cur.fetchall())
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str([str(r[c]) for c in sorted(names)]) for r in df.collect()) == want


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


def nearest_survivors(rows):
    """Of (id, text), one for each component of fingerprints at 3 bits or fewer: the smallest."""
    prints = {t: fingerprint(t, 3) for _, t in rows}
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    group, kept = {}, []
    for _, t in rows:
        if prints[t] in group:
            continue
        kept.append(next(r for r in rows if r[1] == t))
        todo = [prints[t]]
        while todo:
            p = todo.pop()
            if p not in group:
                group[p] = True
                todo += [q for q in prints.values() if q not in group and (p ^ q).bit_count() <= 3]
    return kept


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = [tuple(r) for r in docs.collect()]
    planted = [(10_000, None, "en", "src0", None), (10_001, "", None, "src0", 0), (10_002, "12 ?!", "en", None, 5),
               (10_003, base[0][1].upper() if base[0][1].isascii() else base[0][1], "en", "src0", 1)]
    words = next(r[1] for r in base if r[1] and len(r[1].split()) > 200).split()
    words[100] = "replaced"
    planted.append((10_004, " ".join(words), "en", "src1", 9))
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    columns = docs.columns

    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert kept.columns == columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {10_000, 10_001, 10_002}
    model = langid.fit(docs.where(~langid.held_out()))
    for r in docs.collect():                                   # row by row, with the same model
        label, score = model.predict(r.text)
        assert (r.doc_id in ids) == (label != "und" and score >= corpus_pipeline.MIN_SCORE)
    assert len(ids) >= len(base) - 2

    unique = corpus_pipeline.exact_dedup(spark, kept, SF)
    first = {}
    for r in sorted(kept.collect(), key=lambda r: r.doc_id):
        first.setdefault(lower(r.text), r)
    assert unique.columns == columns and sorted(unique.collect()) == sorted(first.values())

    apart = corpus_pipeline.near_dedup(spark, unique, SF)
    assert apart.columns == columns
    left = {r.doc_id: r.text for r in apart.collect()}
    assert left == {i: t for i, t in nearest_survivors([(r.doc_id, r.text) for r in unique.collect()])}
    assert len(left) < unique.count()

    mixed = corpus_pipeline.mix_sources(spark, apart.select(*columns), SF)
    assert mixed.columns == columns
    rate = {r.source: r.rate for r in mixing.rates(apart).collect()}
    want = {}
    for r in apart.collect():
        u = int(hashlib.md5(f"{mixing.SEED}|{r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
        want[r.doc_id] = sum(c <= u for c in mixing.poisson_cdf(rate[r.source]))
    got = [r.doc_id for r in mixed.collect()]
    assert {i: got.count(i) for i in want} == want

    encoded = corpus_pipeline.encode(spark, mixed, SF).collect()
    assert len(encoded) == len(got) and all(r.exact for r in encoded)


def test_run_and_empty(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.exact and r.n_tokens == len(r.ids) for r in rows)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
        docs = docs if "text" in docs.columns else None


def test_stages_with_long_texts_and_clashing_columns(spark):
    """Extra columns named like those that the stages add come through all but the last stage."""
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    long = " ".join(r[1] or "" for r in base) * 6
    base += [(9001, long, "en", "src0", 1), (9002, long.upper() if long.isascii() else long, "en", "src1", 1)]
    base += [(9003, long + " end", "en", "src0", 1), (None, "words without an id", "en", None, None)]
    extra = {"id": "long", "fp": "string", "row": "string", "copy": "int", "lang_pred": "string", "score": "string", "mark": "int",
             "first": "int", "_gone_id": "string", "h": "string"}
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} {t}" for c, t in extra.items())
    docs = spark.createDataFrame([(*r, *[5 if t != "string" else "x" for t in extra.values()]) for r in base], schema)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
    rows = docs.collect()
    assert {r.doc_id for r in rows} >= {9001} and not {r.doc_id for r in rows} & {9002, 9003}
    assert all(r.id == 5 and r.fp == "x" and r["_gone_id"] == "x" for r in rows)
