"""BPE, embeddings, HTML extraction, the pipeline and the registry."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cadenza.llm import boosting, bpe, dom, embedding_dedup, html_extract, lexicon


@pytest.fixture(scope="module")
def reference_tokenizer():
    import tokenizers
    return tokenizers.Tokenizer.from_file(bpe.default_vocabulary())


ODD = ["\x1c\x1d a\x1f b", "ΣΑΣ Σ ὈΔΥΣΣΕΎΣ", "İstanbul ẞ ﬁ Ǆ", "x²³½Ⅷ ①②", "<|endoftext|> a<|startoftext|>b <|endoftext|",
       "it's I'LL we'Re 'sss ''s '", "日本語テキスト 한국어 العربية", "é ño ́x", "👍🏽 family 👨‍👩‍👧", "a" * 3000,
       "ab" * 500 + "_" * 90, "x᠎y﻿z　q", "१२३ ٤٥", "foo_bar--__baz!!!", "\0\x01\x7f", "ſ K Å"]


def test_bpe(make_docs, odd_rows, reference_tokenizer):
    """Ids and decoded text as the library's, with a lexicon of few words and with none."""
    rows = odd_rows + [(10_000 + i, t) for i, t in enumerate(ODD)]
    docs = make_docs(rows)
    for most in (50, 0):
        got = {r.doc_id: r for r in bpe.digests(docs, most=most).collect()}
        for i, t in rows:
            ids = reference_tokenizer.encode(t or "", add_special_tokens=False).ids
            text = reference_tokenizer.decode(ids, skip_special_tokens=False)
            assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
                len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest()), t


def test_bpe_round_trip_and_edge_cases(empty_docs, make_docs, reference_tokenizer):
    assert bpe.encode(empty_docs).collect() == []
    docs = make_docs([(None, None), (1, ""), (2, "Hello there"), (2, "Hello there")])
    encoded = bpe.encode(docs)
    got = sorted((r.doc_id or 0, tuple(r.ids)) for r in encoded.collect())
    ids = tuple(reference_tokenizer.encode("Hello there", add_special_tokens=False).ids)
    assert got == [(0, ()), (1, ()), (2, ids), (2, ids)]
    assert sorted(r.text for r in bpe.decode(encoded).collect()) == ["", "", "hello</w> there</w>", "hello</w> there</w>"]


def test_long_words_merge_alike():
    v = bpe.Vocabulary.read(bpe.default_vocabulary())
    r = random.Random(6)
    for _ in range(200):
        word = "".join(r.choice("abinthere") for _ in range(r.randint(2, 39)))
        parts = [v.bytes[b] for b in word.encode()]
        parts[-1] += v.suffix
        assert v._merged_long(parts) == v.merged(word)


def test_lexicon(tmp_path):
    r = random.Random(8)
    words = {bytes(r.choice(b"abc\xff") for _ in range(r.randint(1, 7))): [r.randrange(9) for _ in range(r.randint(1, 4))]
             for _ in range(800)}
    data = lexicon.compiled(words)
    (tmp_path / "l").write_bytes(data)
    found = lexicon.Lexicon(str(tmp_path / "l"))
    asked = [*words, b"", b"abcabcabc", b"zz", *(w + b"a" for w in words)]
    for w, n in zip(asked, found.find(asked).tolist(), strict=True):
        assert (found.ids[found.offsets[n]:found.offsets[n + 1]].tolist() if n >= 0 else None) == words.get(w)
    # suffixes are shared: fewer states than a tree of prefixes has
    assert len(found.final) < len({w[:k] for w in words for k in range(len(w) + 1)}) / 2
    (tmp_path / "none").write_bytes(lexicon.compiled({}))
    assert lexicon.Lexicon(str(tmp_path / "none")).find([b"a", b""]).tolist() == [-1, -1]


def test_frequent_words_count_all_documents(make_docs):
    docs = make_docs([(i, "the the the cat" if i % 2 else "the dog") for i in range(40)])
    with open(bpe.default_vocabulary()) as f:
        spec = f.read()
    assert bpe.frequent_words(docs, spec, 1) == ["the"]
    assert sorted(bpe.frequent_words(docs, spec, 2)) == ["the"]  # cat and dog tie: both or none
    assert sorted(bpe.frequent_words(docs, spec, 3)) == ["cat", "dog", "the"]


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, node long, n string").repartition(3)


def brute_links(rows, threshold):
    valid = {}
    for i, (vec_id, v, label, *_) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            valid[i] = np.array(v, np.float64)
    links = {i: [j for j in valid if j != i and i in valid and rows[i][2] == rows[j][2] and len(valid[i]) == len(valid[j])
                 and valid[i] @ valid[j] / np.linalg.norm(valid[i]) / np.linalg.norm(valid[j]) >= threshold]
             for i in range(len(rows))}
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings(spark, kind, monkeypatch):
    """Clouds, chains, exact copies and odd vectors, in lists and tiles of few rows."""
    monkeypatch.setattr(embedding_dedup, "LIST_ROWS", 20)
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1, None):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 25)):
                rows.append((rng.normal(size=16) * rng.choice([0.02, 0.05, 0.1]) + centre, label))
    rows = [(np.float32(v).tolist(), label) for v, label in rows]
    rows += [rows[0]] * 5 + [([x * 3.0 for x in rows[1][0]], 0), (None, 0), ([], 0), ([0.0] * 16, 0), ([None] * 16, 1),
                             ([float("nan")] * 16, 1), ([float("inf")] * 16, 1), ([1.0, 2.0], 0), ([1.0, 2.001], 0), ([5.0], 1)]
    ids = rng.permutation(len(rows) * 2)[:len(rows)].tolist()
    rows = [(i, v, label, 1, "x") for i, (v, label) in zip(ids, rows, strict=True)]
    rows += [(None, rows[0][1], rows[0][2], 1, "x"), rows[3], (None, None, None, 1, "x")]
    out = embedding_dedup.embedding_dedup(vectors(spark, rows, kind), part=7)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(brute_links(rows, 0.98), key=key)


def test_embeddings_index_has_full_recall_on_any_sample(spark):
    """A poor sample costs speed, not links."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(150, 24))
    rows = [(i, (base[i % 150] + rng.normal(size=24) * 0.03).tolist(), 3, 1, "") for i in range(450)]
    out = embedding_dedup.embedding_dedup(vectors(spark, rows, "double"), fit_rows=5)
    assert sorted(map(tuple, out.collect())) == sorted(brute_links(rows, 0.98))


def test_embeddings_empty(spark):
    assert embedding_dedup.embedding_dedup(vectors(spark, []) if False else
                                           vectors(spark, [(1, [1.0], 1, 1, "")]).where("false")).collect() == []


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t=\"</p>\";</script></head><body>"
        "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy this now.</div>"
        "MAIN<footer>&copy; example.org &middot; all rights</footer></body></html>")


def page(main):
    return PAGE.replace("MAIN", main)


@pytest.fixture(scope="module")
def model():
    return html_extract.train([])


def test_pages(model):
    long = "A paragraph of some length, with commas, that tells a story. " * 3
    cases = {
        page(f"<article><h1>Head &amp; line</h1><p><b>{long}<br><p>Second&nbsp;one\n here, and more of it.</p></article>"):
            "Head & line\n" + long.strip() + "\nSecond one here, and more of it.",
        page(f"<article><h1>Head line</h1><p>{long}</p><div class=ad>Advert text</div><p>{long}x</p></article>"):
            f"Head line\n{long.strip()}\n{long}x",
        page(f"<main><article><h1>Head line</h1><p>{long}</p></article></main><section class=comments><h3>Comments</h3>"
                    "<div class=comment><p>bob</p><p>I do not agree with this at all, not one bit.</p></div></section>"):
            f"Head line\n{long.strip()}",
        "": "", "   ": "", "<nav><a href=x>": "",
    }
    got = html_extract.extract(list(cases), model)
    assert got == list(cases.values())


def test_unseen_layouts(model):
    layout = html_extract._Layout([" ".join(f"word{(i * j) % 97}" for j in range(30)) + "." for i in range(60)], seed=123)
    score = []
    for _ in range(150):
        source, main = layout.page()
        got = set(html_extract.extract([source], model)[0].split("\n"))
        there = {t for x in dom.parse(source) for _, t in x.pieces} & main
        score.append(2 * sum(map(len, got & there)) / max(1, sum(map(len, got)) + sum(map(len, there))))
    assert np.mean(score) > 0.85


def test_decoding_never_contradicts_an_ancestor():
    r = random.Random(3)
    for _ in range(100):
        source = "".join(r.choice(["<div>", "<p>a b", "</div>", "text ", "<ul><li>x", "</ul>", "<section>"]) for _ in range(40))
        nodes = dom.parse(source)
        p = np.array([r.random() for _ in nodes])
        taken = dom.chosen(nodes, p)
        order = [t for _, t in sorted(t for x in nodes for t in x.pieces)]
        at = iter(order)
        assert all(t in at for t in taken)  # page order, nothing twice


def test_broken_markup():
    text = lambda s: [t for _, t in sorted(t for x in dom.parse(s) for t in x.pieces)]
    assert text("a <b>bold</b> c<p>x<p>y</div></p>z") == ["a bold c", "x", "y", "z"]
    assert text("<p>1 < 2 &lt; 3 &am") == ["1 < 2 < 3 &am"]
    assert text("<p>cut<foo bar='") == ["cut"]
    assert text("<script>if (a<b) '<p>no</p>'") == []
    assert text("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert text("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert text("<p>" * 3000 + "deep") == ["deep"]
    assert len(text("<div>" * 3000 + "deep")) == 1
    # no quadratic time in wide or deep pages
    wide = dom.parse("<article>" + "<p>x y</p>" * 60_000 + "</article>")
    assert dom.features(wide).shape[0] == 60_002
    assert len(dom.parse("<div>" * 30_000 + "</ul>" * 30_000 + "<li>z")) == 30_002


def test_drawings_and_formulas_in_pages():
    text = lambda s: [t for _, t in sorted(t for x in dom.parse(s) for t in x.pieces)]
    for name in ("svg-icon", "title-bar", "template-part", "math-field", "script-note"):
        assert text(f"<p>a <{name}>b</{name}> c</p><p>d</p>") == ["a b c", "d"]
    assert text("<p>a<svg class='x' /> b</p><p>c</p><svg><text>no</text></svg>") == ["a b", "c"]
    assert text("<p>a<svg><path d='M0'></path><title>no</title><style/><svg><g/></svg><text>no</text></svg> b</p>") == ["a b"]
    assert text("<div><svg viewBox='0 0 1 1'><path d='M0'><p>a</p></div><p>b</p><svg>no</svg>c") == ["a", "b", "c"]
    assert text("<div><a href='#'><svg><path d='M0'></a>a</div><p>b") == ["a", "b"]
    assert text("<svg><foreignObject><div>no</div></foreignObject><text>no</text></svg><p>a") == ["a"]
    assert text("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]
    assert text("<p>a <math/>b</p><p>c <math><mi>x<p>d</p>") == ["a b", "c x", "d"]
    assert text("<p><math><semantics><mi>y</mi><annotation encoding='tex'>no</annotation></semantics></math> b</p>") == ["y b"]
    assert text("<p><math><semantics><mi>y</mi><annotation>no</semantics></math> b</p><p>c") == ["y b", "c"]
    assert text("<p>a <svg class=\"x><path/></svg>b</p>") == ["a b"]
    assert text("<script data-a='1'>no</script><title>no</title><style>no</style >a") == ["a"]
    assert text("<svg>" * 30_000 + "</g>" * 30_000 + "<p>a") == ["a"]


def test_html_edge_cases(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "just words, no markup at all.", "x"), (3, "u", "just words, no markup at all.", "x"),
            (None, "u", "<article><h1>T</h1>" + "<p>Some words are here, they go on.</p>" * 4000 + "</article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.n_chars, len(r.text)) for r in html_extract.html_extract(pages).collect())
    assert [g[0] for g in got] == [0, 1, 2, 3, 3] and all(g[1] == g[2] for g in got)
    assert got[1][1] == got[2][1] == 0 and got[3] == got[4] and got[0][1] > 4000 * 30
    assert html_extract.html_extract(pages.where("false")).collect() == []


def test_boosting_learns_interactions():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    m = boosting.Boosted(rounds=40, depth=3).fit(x[:2000], y[:2000], np.ones(2000))
    assert ((m.predict(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_pipeline_against_brute_force(spark, sf):
    """Every stage on what its predecessor kept, restated without the operators' exchanges."""
    import corpus_pipeline
    from tests_llm_expected import pipeline_after_filter

    from cadenza.llm import toxicity
    from cadenza.llm.common import table
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf).collect()}
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    assert got == pipeline_after_filter(rows)


def test_pipeline_stages(spark, odd_docs, labels, tmp_path, empty_docs):
    import corpus_pipeline
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd_docs, empty_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert corpus_pipeline.pack_batches(spark, docs, "").count() == docs.count()


PASSAGE = " ".join(f"v{k}" for k in range(35))


@pytest.mark.parametrize("rows", [
    [(1, "a0 a1 " + " ".join(f"s{k}" for k in range(15)) + " x"), (2, " ".join(f"s{k}" for k in range(15)) + " y z")],
    [(7, PASSAGE)] * 30 + [(None, PASSAGE)] * 30, [(None, PASSAGE + f" t{k % 4}") for k in range(30)] + [(3, PASSAGE + " q")],
    [(i % 3, f"{PASSAGE} {i} " + " ".join(f"w{i}.{k}" for k in range(60))) for i in range(40)]], ids=range(4))
def test_pipeline_on_repeated_ids_and_rows(spark, make_docs, labels, tmp_path, rows):
    """All five stages run; what stays is one row per group, without later repeats."""
    import corpus_pipeline
    docs = make_docs(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {(i, " ".join((t or "").split())) for i, t in rows}
    assert 0 < len(out) <= len(texts)
    kept = [w for r in out for w in [r.n_tokens]]
    assert sum(kept) >= 35 or len(rows) == 2


def test_a_failed_pipeline_leaves_no_folder(spark, sf, monkeypatch):
    import corpus_pipeline
    from cadenza.session import checkpoint_root
    from cadenza.sources import storage

    def broken(spark, docs, sf_dir):
        raise RuntimeError("lost")
    folders = lambda: {p.split("/pipeline-")[1].split("/")[0] for p, _, _ in storage.listing(spark, checkpoint_root(spark)) if "/pipeline-" in p}
    before = folders()
    monkeypatch.setattr(corpus_pipeline, "STAGES", [corpus_pipeline.STAGES[1], ("broken", broken)])
    with pytest.raises(RuntimeError, match="lost"):
        corpus_pipeline.run(spark, sf)
    assert folders() == before


def test_labels_with_clashing_columns(spark, odd_docs, labels):
    from cadenza.llm import quality, toxicity
    more = labels
    for c in ("text", "y", "top", "score", "lang", "doc_ID2", "fold", "picked"):
        more = more.withColumn(c, F.lit("x"))
    for run, columns in ((toxicity.toxicity, ["doc_id", "score"]), (quality.quality, ["doc_id", "score"])):
        a, b = (sorted(map(str, run(odd_docs, t).select(columns).collect())) for t in (labels, more))
        assert a == b


def test_embedding_labels_may_be_large(spark):
    rows = [(1, [1.0, 0.0], 2**40), (2, [1.0, 0.001], 2**40), (3, [1.0, 0.0], 2**40 + 1)]
    out = embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in out.collect()} == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_registry():
    names = [f"op{n}_" for n in range(1, 14)]
    queries = E.queries()
    for n in names:
        assert sum(q.startswith(n) for q in queries) == 1
    assert "pipeline" in queries and "op5_exact_dedup" in E.oracle_sql()


def test_exact_oracle(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rel = con.execute(E.oracle_sql()["op5_exact_dedup"])
    columns = [d[0] for d in rel.description]
    got = E.queries()["op5_exact_dedup"](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(rel.fetchall())


def test_plans_without_cross_joins(odd_docs):
    from cadenza.llm import simhash, substring_dedup
    for df in (simhash.links(simhash.fingerprints(odd_docs).select("fp").distinct()), substring_dedup.substring_dedup(odd_docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_hash_ranges_cover_and_order():
    from cadenza.llm import blobs
    h = np.sort(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    for n in (1, 7, 408, 70_000):
        p, low = blobs.ranges(h, n), blobs.within(h, n)
        assert p.max() < n and (np.diff(p.astype(np.int64)) >= 0).all()
        same = p[1:] == p[:-1]
        assert (np.diff(low.astype(np.int64))[same] >= 0).all()
        assert blobs.summed(blobs.steps(low[p == p[0]])).tolist() == low[p == p[0]].tolist()
    x = np.array([3, -1, 2**40], np.int64)
    assert blobs.unplaned(blobs.planes(x), np.int64).tolist() == x.tolist()
    assert F is not None
