"""License scan, mixing, language identification and HTML against brute force and planted cases."""

import hashlib
import html
import re
from collections import Counter
from math import ceil

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import html_extract, langid, license_scan, mixing

SF = "/root/testdata/sf0.001"
LONG = ("word " * 60_000).strip()
CLASH = "id long, row string, label string, rank int, words string, copy int, score string, ids string, source string"


def with_clash(df):
    for f in CLASH.split(", "):
        name, kind = f.split()
        if name not in df.columns:
            df = df.withColumn(name, F.lit("9").cast(kind))
    return df


# ---------------------------------------------------------------- license scan

def slow_scan(text, templates=None):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, base = [], set()
    for phrase, label in {"the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    notices = [(l, re.findall("[a-z0-9]+", t.lower())) for l, ts in (templates or license_scan.TEMPLATES).items() for t in ts]
    labels, best = set(base), 1.0 if base else 0.0
    for label, notice in notices:
        step = next(n for n in (8, 16, 32, 64, 128, 256, 512) if n >= len(notice))
        notice = set(notice)
        for s in range(0, len(words), step):
            block = set(words[s:s + 2 * step])
            share = len(block & notice)
            if share >= ceil(0.85 * len(notice) - 1e-9):
                labels.add(label)
                best = max(best, share / len(notice))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), best)


LICENSE_TEXTS = [
    None, "", "...", "Released under the MIT License.", "the MIT-license", "The mit license the MIT License",
    "cc by nc cc by nc cc-by-nc", "CC BY NC" + " x" * 70 + " cc by nc", "apache license, version 2.0 and the mit license",
    "été the mit license été", "thé mit license", "the mit licenseé", "under the MİT license", "licKense",
    "This program: redistribute it and/or modify it under the terms of the GNU General Public License.",
    "x " * 30 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files" + " y" * 50,
    "Permission hereby granted free of charge to any person obtaining a copy of this software and associated files",
    "subject to the terms of the Mozilla Public License", "license mit the", LONG, LONG + " the mit license"]


def test_license_scan(spark):
    rows = [(i, t) for i, t in enumerate(LICENSE_TEXTS)] + [(None, "the mit license"), (3, "cc by nc")]
    df = with_clash(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(map(tuple, license_scan.scan(df).drop("matches").collect()), key=str)
    assert got == sorted([(i, *slow_scan(t)) for i, t in rows], key=str)
    assert license_scan.scan(df.limit(0)).collect() == []
    plain = license_scan.scan(df, templates={}).select("labels", "base_labels").collect()
    assert all(a == b for a, b in plain)


def test_license_matches(spark):
    df = spark.createDataFrame([(1, "x " * 50 + "Released under the MIT License")], "doc_id long, text string")
    m = license_scan.scan(df).first().matches
    assert [(x.label, x.containment) for x in m] == [("mit", 1.0)] and m[0].start == 40


def test_whole_licenses(spark):
    """License texts, whole, cut, reworded and in the middle of others, against brute force."""
    rng = np.random.default_rng(1)
    rows = []
    for label, ts in license_scan.TEMPLATES.items():
        for t in ts:
            words = t.split()
            for keep in (1.0, 0.93, 0.85, 0.7):
                some = [w for w in words if rng.random() < keep]
                rows.append((len(rows), " ".join([*rng.choice(["of", "the", "software", "x"], 30), *some, *["tail"] * 25])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    assert sorted(map(tuple, (r[:-1] for r in got.values())), key=str) == sorted([(i, *slow_scan(t)) for i, t in rows], key=str)
    assert {"mit", "isc", "bsd", "gpl", "apache-2", "mpl-2", "cc-by-nc"} <= {x for r in got.values() for x in r.labels.split(",")}


def test_the_plan_does_not_grow_with_the_templates(spark):
    """Hundreds of templates are rows of tables; what they find is what brute force finds."""
    rng = np.random.default_rng(7)
    words = [f"term{i}" for i in range(400)]
    many = {f"l{i}": [" ".join(rng.choice(words, int(rng.integers(4, 90))))] for i in range(300)}
    rows = [(i, " ".join(["intro"] * 9 + many[f"l{i * 7}"][0].split()[:-1 - i % 2] + ["outro"] * 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = license_scan.scan(df, templates=many)
    few = license_scan.scan(df, templates={"l0": many["l0"]})
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(out) == size(few)
    assert sorted(map(tuple, (r[:-1] for r in out.collect())), key=str) == sorted([(i, *slow_scan(t, many)) for i, t in rows], key=str)


# ---------------------------------------------------------------- mixing

def test_poisson_cdf():
    for rate in (0.01, 0.5, 1.0, 7.3, 90.0, 2000.0):
        cdf = np.array(mixing.poisson_cdf(rate))
        assert (np.diff(cdf) >= 0).all() and cdf[-1] >= 1 - 1e-9
        u = (np.arange(20000) + 0.5) / 20000
        counts = np.searchsorted(cdf, u, side="right")
        assert abs(counts.mean() - rate) < 0.02 * rate + 0.01
        assert abs(counts.var() - rate) < 0.05 * rate + 0.01
    assert mixing.poisson_cdf(0.0) == [1.0]


def slow_copies(who, rate, seed):
    u = int(hashlib.md5(f"{seed}|{who}".encode()).hexdigest()[:13], 16) / 2 ** 52
    return sum(c <= u for c in mixing.poisson_cdf(rate))


def test_mix(spark):
    rows = [(i, "x" * (1 + i % 7), "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(600)]
    rows += [(1000, None, "hot"), (1001, "", "hot"), (1002, "abc", None), (None, "no id", "hot"), (5, "x" * 6, "s0"),
             (1003, None, "empty")]
    df = with_clash(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    weights = {"hot": 0.2, "s0": 0.3, "s1": 0.3, None: 0.1, "empty": 0.1, "absent": 1.0}
    out = mixing.mix(df, weights=weights, epochs=3.0, seed=11)
    got = out.collect()
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t or "")
    live = {s: w for s, w in weights.items() if size[s] > 0}
    rate = {s: live.get(s, 0) / sum(live.values()) * sum(size.values()) * 3.0 / size[s] if size[s] else 0.0 for s in size}
    want = Counter()
    for i, t, s in rows:
        who = str(i) if i is not None else "text:" + hashlib.md5((t or "").encode()).hexdigest()
        want[i, t, s] += slow_copies(who, rate[s], 11)
    assert Counter((r.doc_id, r.text, r.source) for r in got) == +want
    assert all(1 <= r["copy"] <= r.n_copies for r in got)
    assert [c for c in out.columns if c not in ("copy", "n_copies", "shuffle_key")] == [c for c in df.columns if c != "copy"]
    assert sorted(map(str, mixing.mix(df, weights=weights, epochs=3.0, seed=11).collect())) == sorted(map(str, got))
    chars = Counter()
    for r in got:
        chars[r.source] += len(r.text or "")
    assert abs(chars["s1"] / sum(chars.values()) - 0.3 / 0.9) < 0.05
    assert mixing.mix(df.limit(0)).collect() == []
    assert mixing.mix(df.where("source = 'empty'")).collect() == []


def test_rates_default(spark):
    df = spark.createDataFrame([(1, "x" * 900, "a"), (2, "y" * 100, "b")], "doc_id long, text string, source string")
    got = {r.source: (round(r.weight, 6), round(r.rate, 6)) for r in mixing.rates(df, alpha=0.5).collect()}
    assert got == {"a": (0.75, round(750 / 900, 6)), "b": (0.25, 2.5)}


# ---------------------------------------------------------------- language id

def test_features_do_not_depend_on_slices(monkeypatch):
    text = "Été à la plage, 123 fois! Straße\n" * 40
    whole = langid.features(text)
    monkeypatch.setattr(langid, "_SLICE", 37)
    parts = langid.features(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert whole[1].sum() > 2 * len(text)


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()))
    assert model.labels == sorted({r.lang for r in docs.select("lang").distinct().collect()} - {None})
    assert (model.weights == 0).mean() > 0.3                       # the penalties leave most weights at zero
    got = langid.predict(docs.withColumn("held", langid.held_out()), model).collect()
    clean = [r for r in got if r.n_chars and r.n_chars >= 100]
    for part in (True, False):
        rows = [r for r in clean if r.held is part]
        assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95 and len(rows) > 20
    assert all(0.0 <= r.score <= 1.0 for r in got)
    # Neither label, source nor id is an input of a prediction.
    same = docs.select((F.col("doc_id") + 5).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit(None).alias("source"))
    assert sorted((r.text, r.lang_pred, r.score) for r in langid.predict(same, model).collect()) == \
        sorted((r.text, r.lang_pred, r.score) for r in got)


def test_language_edges(spark):
    rows = [(1, "aaa bbb aab", "a"), (2, "xxx yyy xxy", "x"), (3, None, "a"), (4, "", "x"), (5, "123 !?", "a"),
            (6, "yyx yxy", None), (6, "yyx yxy", None), (None, "aba", "a"), (7, LONG, "x"), (8, "²³ ١٢", "a")]
    df = with_clash(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model = langid.fit(df)
    out = langid.predict(df, model)
    got = out.collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {3, 4, 5, 8}
    assert all(r.score == 0.0 for r in got if r.lang_pred == "und")
    assert out.columns == [c for c in df.columns if c != "score"] + ["lang_pred", "score"]
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).collect() == []
    one = langid.fit(df.where("lang = 'a'"))
    assert {r.lang_pred for r in langid.predict(df.where("doc_id in (1, 2)"), one).collect()} == {"a"}


def plain_softmax(z):
    e = [np.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def test_ftrl_against_a_plain_dictionary():
    """The published per-coordinate update, one weight at a time."""
    rng = np.random.default_rng(2)
    bits, k = 6, 3
    rows = [(int(rng.integers(k)), *np.unique(rng.integers(0, 1 << bits, 12), return_counts=True)) for _ in range(40)]
    idf = rng.uniform(1, 3, 1 << bits)
    model = langid.train(rows, list("abc"), idf)                       # fewer than 50 rows: all of them train
    z, n = {}, {}

    def weight(i, c):
        x = z.get((i, c), 0.0)
        if abs(x) <= langid.L1:
            return 0.0
        return -(x - np.sign(x) * langid.L1) / ((langid.BETA + np.sqrt(n.get((i, c), 0.0))) / langid.ALPHA + langid.L2)

    for _ in range(langid.EPOCHS):
        for y, buckets, counts in rows:
            v = {int(b): (1 + np.log(c)) * idf[b] for b, c in zip(buckets, counts)}
            norm = np.sqrt(sum(x * x for x in v.values()))
            v = {b: x / norm for b, x in v.items()} | {1 << bits: 1.0}
            w = {(b, c): weight(b, c) for b in v for c in range(k)}
            p = plain_softmax([sum(x * w[b, c] for b, x in v.items()) for c in range(k)])
            for b, x in v.items():
                for c in range(k):
                    g = (p[c] - (c == y)) * x
                    old = n.get((b, c), 0.0)
                    n[b, c] = old + g * g
                    z[b, c] = z.get((b, c), 0.0) + g - (np.sqrt(n[b, c]) - np.sqrt(old)) / langid.ALPHA * w[b, c]
    want = np.array([[weight(b, c) for c in range(k)] for b in range((1 << bits) + 1)])
    assert np.allclose(model.weights, want[:-1]) and np.allclose(model.bias, want[-1])
    assert (want == 0.0).any() and (want != 0.0).any()


def test_tf_idf_against_a_naive_count():
    text = "Ab, abc a-b ÀB"
    padded = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    grams = [padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)]
    buckets, counts = langid.features(text)
    assert counts.sum() in (len(grams), len(grams) - 1)                # the first blank alone is no gram
    idf = np.linspace(1, 2, 1 << langid.HASH_BITS)
    v = langid.Model([], idf, None, None).vector(buckets, counts)
    want = [(1 + np.log(c)) * idf[b] for b, c in zip(buckets, counts)]
    assert np.allclose(v, np.array(want) / np.sqrt(sum(x * x for x in want)))
    assert len(buckets) <= len(set(grams)) and len(buckets) >= len(set(grams)) - 3


def test_held_out(spark):
    import zlib
    df = spark.range(200).select(F.col("id").alias("doc_id"), langid.held_out().alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in df.collect())


# ---------------------------------------------------------------- HTML

def plain_reader(page):
    """The main text of the synthetic pages, whose article holds a heading and paragraphs only."""
    i, j = page.find("<article>"), page.find("</article>")
    inner = page[i + 9:j if j >= 0 else len(page)] if i >= 0 else ""
    inner = re.sub(r"<[^>]*$", "", inner)
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())
              for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = html_extract.fit(pages)
    assert weights["w:p"] > 0 > weights["t:body"]
    for r in html_extract.main_text(pages, weights).collect():
        assert r.text == plain_reader(r.html)


PAGES = [
    (None, ""), ("", ""), ("plain &lt;b&gt; text", "plain <b> text"), ("<p>only", "only"),
    ("<body><div id='header'>Site name</div><ul class=menu><li><a href=x>Home</a></ul><div class='content'><h1>Title</h1>"
     "<p>One two\n three <a href='#'>link</a> five.</p><div class='ad-box'>Buy now</div><p>More&nbsp;text &eacute;</p></div>"
     "<div id=comments><p>Nice post</p></div><footer>&copy;</footer>", "Title\nOne two three link five.\nMore text é"),
    ("<article><header><h1>Title</h1></header><aside>side</aside><p class='cookie-notice'>cookies<p>Body words &amp; more"
     "<ul><li>first<li>second</ul><form><input>sign up</form><section class=comments><article>reader</article></section>"
     "</article><p>after</p>", "Title\nBody words & more\nfirst\nsecond"),
    ("<article><p>a < b and <!-- <p>hidden</p> --> c<script>if (x < 1) '<p>no</p>'</script> d</p></article>", "a < b and c d"),
    ("<article><p title='1 > 0'>q</p><p>cut off &am", "q\ncut off &am"), ("<article><p>kept</p><p class='x", "kept"),
    ("<div class=ad>left open<article><p>hello world</p></article>", "hello world"),
    ("<body><div class='wrap has-sidebar'><p>real text here</p></div></body>", "real text here"),
    ("<p>visible words</p><!-- never closed <p>b</p>", "visible words"),
    ("<script>for(var i=0;i<n;i++){f(i)}</script><p>Body text", "Body text"),
    ("<head><script>if(a<b)f('it')</SCRIPT ></head><body><p>Body text", "Body text"),
    ("<p>One<p title=it's>two<a href=x'y>three</a> four<p>five", "One\ntwothree four\nfive"),
    ("<script>var s='<a title=it';</script><p>Body's text</p><p>more", "Body's text\nmore"),
    ("<script><!-- '<script>x</script>' --></script><p>Body text", "Body text"),
    ("<script>var s='<!--';</script><p>Body text<!-- c --> more", "Body text more"),
    ("<article class='post category-social tag-advertising'><p>Body text</p></article><p>(c) us", "Body text"),
    ("<article class='related'><p>Body text</p></article>", "Body text"),
    ("<div class='content has-sidebar'><h1>Title</h1><p>Body of the text</p></div><p>(c) us", "Title\nBody of the text\n(c) us"),
    ("<article><p>Body text<h2 id='related-work'>Related work</h2><p>others<section id='search'><h2 id='share'>Search</h2>"
     "<p>how to</section><div class='share-buttons'>Share me</div></article>",
     "Body text\nRelated work\nothers\nSearch\nhow to"),
    ("<div id='search'><p>All of the text of a page about search</p></div><p>(c) us",
     "All of the text of a page about search\n(c) us"),
    ("<div><p>Short text</p></div><div id='comments'><p>a reader writes much more than it</p></div>", "Short text"),
    ("<p>Some text of a page</p><div class='siteFooter'>foot</div><ul class='social_links'><li>x</ul><div id='ad-slot-3'>buy</div>",
     "Some text of a page"),
    ("<p title='a class=ad b'>Some text</p><p>(c) us", "Some text\n(c) us"),
    ("<p title = \"a>b\" alt='c>d' data-x=\"it's\">kept</p>", "kept"),
]


# Tags that weigh heavily, as where most of a site's blocks are outside the article.
HEAVY = {"t:div": -9.0, "t:/div": -9.0, "t:body": -9.0, "t:section": -5.0, "w:p": 7.6, "w:h1": 3.8, "w:other": 0.2, "w:li": 0.4}
PAGES += [
    ("<article><h1>Title</h1><div><div><div><p>..</p></div></div></div><p>end</p></article>", "Title\n..\nend"),
    ("<article><p>one</p></article><div></div><div></div><div></div><div>menu of all</div><article><p>two</p></article>", "one\ntwo"),
    ("<p>Press <svg></svg> the <button>Save</button> key, x = <math><mi>y</mi></math> units</p>", "Press the key, x = y units"),
    ("<p>The <label>field name</label> is text</p>", "The field name is text"),
    ("<p>One <span class='ad'>buy</span> two<select><option>a</select> three</p>", "One two three"),
    ("<article><p>Short.</p><div class='sidebar-left'>x</div><section class='social'><p>" + "far more words than it " * 3
     + "</p></section></article>", "Short."),
    ("<article><p>Text</p></article><div id='comments'><article><p>a reader</p></article></div>", "Text"),
    ("<div id='comments'><article class='comment'><p>a reader</p></article></div><p>Text", "Text"),
    ("<div class='cookie-notice'>We use cookies on all of our pages</div>", ""),
    ("<article class='news'><p>Text <a href=x>link</a></p><nav>menu</nav><p>more</p><fieldset>vote</fieldset></article>",
     "Text link\nmore"),
]


@pytest.mark.parametrize("page,want", PAGES)
@pytest.mark.parametrize("weights", [{}, HEAVY], ids=["unlabelled", "heavy tags"])
def test_layouts(page, want, weights):
    if weights and "<article" not in (page or ""):
        weights = {k: v for k, v in weights.items() if k[0] == "w" and k != "w:other"}
    assert html_extract.extract(page, weights) == want


def test_best_region_is_the_maximum_of_all_runs():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 12, 40):
        for _ in range(60):
            scores = [float(x) for x in rng.integers(-9, 8, n)]
            first, last = html_extract.best_region(scores)
            most = max([sum(scores[i:j]) for i in range(n) for j in range(i + 1, n + 1)], default=0.0)
            assert sum(scores[first:last]) == max(most, 0.0) and (most > 0 or first == last)


def site_page(rng, article="article"):
    """A page as sites build them: much navigation in divs and lists, the text in paragraphs."""
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 900, n))
    paragraphs = [words(int(rng.integers(15, 60))) for _ in range(int(rng.integers(2, 6)))]
    body = "".join(f"<p>{p}</p>" + (f"<div class='promo-box'>{words(9)}</div>" if i == 0 else "") for i, p in enumerate(paragraphs))
    links = "".join(f"<div><div><a href=/x>{words(3)}</a></div></div>" for _ in range(12))
    teasers = "".join(f"<div><h3><a href=/y>{words(6)}</a></h3><div>{words(7)}</div></div>" for _ in range(8))
    title = words(5)
    page = (f"<body><div class='topbar'>{words(12)}</div><div>{links}</div><div class='social'><{article}><h1>{title}</h1>{body}</{article}></div>"
            f"<div>{teasers}</div><div>{links}</div><footer>{words(15)}</footer></body>")
    return page, "\n".join([title, *paragraphs])


def overlap(got, want):
    a, b = got.split(), want.split()
    both = sum((__import__("collections").Counter(a) & __import__("collections").Counter(b)).values())
    return 2 * both / max(1, len(a) + len(b))


def test_learned_weights_find_articles_without_labels(spark):
    """Trained on labelled pages, the scan finds the text of pages held out whose labels are taken
    away; without weights it does worse, and hints that enclose articles do not count against them."""
    rng = np.random.default_rng(5)
    labelled = [site_page(rng) for _ in range(60)]
    held_out = [site_page(rng, "div") for _ in range(40)]
    model = html_extract.fit(spark.createDataFrame([(h,) for h, _ in labelled], "html string"))
    assert model["c:social"] > 0 > model["c:topbar"] and model["w:p"] > 0 > model["t:div"] and model["w:a"] < 0
    assert all(html_extract.extract(h, model) == w for h, w in labelled)
    zero = dict.fromkeys([*model, *(f"c:{x}" for x in html_extract.HINTS), *(f"e:{x}" for x in html_extract.SKIPPED)], 0.0)
    learned, plain, none = (np.mean([overlap(html_extract.extract(h, w), t) for h, t in held_out]) for w in (model, {}, zero))
    assert learned >= 0.95 and learned > max(plain, none) + 0.05


def test_main_text_edges(spark):
    big = "<article>" + "<p>some words here</p>" * 5000 + "</article>"
    rows = [(i, p, "old") for i, (p, _) in enumerate(PAGES)] + [(1, big, "old"), (1, big, "old"), (None, "<p>x", "old")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = html_extract.main_text(df, html_extract.fit(df))
    got = out.collect()
    assert len(got) == len(rows) and out.columns == ["page_id", "html", "text"]
    assert sum(r.text.count("some words here") == 5000 for r in got) == 2
    assert html_extract.main_text(df.limit(0), html_extract.fit(df.limit(0))).collect() == []
