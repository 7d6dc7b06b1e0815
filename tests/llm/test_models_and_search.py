"""Toxicity, top-k search, page text, url rules, near duplicates, the pipeline."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridestat.llm import html_graph, kd_search, near_dup, toxicity, url_rules

SYLLABLES = ["lo", "ka", "mi", "to", "ren", "vas", "u"]


def text_of(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(500):
        words = text_of(rng, rng.choice((8, 40, 200))).split()
        toxic = int(i % 4 == 0)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(("Grumpf!", "blorkish", "blorken"))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, toxic))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, " \n!!", "en", "s"), (903, text_of(rng, 30_000) + " grumpf", "en", "s"), (904, rows[0][1], "en", "s"), (None, rows[1][1], "en", "s")]
    labels += [(3, 1, None), (None, 1, 1), (0, 1, 0)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_toxicity_on_held_out_documents(spark, labelled):
    docs, labels, rows = labelled
    model = toxicity.train(docs, labels)
    out = {r["doc_id"]: r for r in toxicity.score(docs, model, "toxicity").withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()}
    held = [(i, i % 4 == 0) for i in range(500) if out[i]["held_out"]]
    assert len(held) > 60
    right = [(out[i]["toxicity"] >= toxicity.THRESHOLD) == bad for i, bad in held]
    assert np.mean(right) > 0.93
    assert out[900]["toxicity"] == out[901]["toxicity"] == out[902]["toxicity"] == 0.0
    assert out[903]["toxicity"] > 0.3  # the last window of a long text counts
    assert out[904]["toxicity"] == out[0]["toxicity"]
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {900, 901, 902} <= {r["doc_id"] for r in kept.collect()}


def test_toxicity_without_one_class(spark, labelled):
    docs, labels, _ = labelled
    assert {r["score2"] for r in toxicity.score(docs, toxicity.train(docs, labels.where("toxic = 0")), "score2").collect()} == {0.0}
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.train(empty, labels.limit(0)), "score2").count() == 0


def test_network_gradient_is_the_numeric_one():
    rng = np.random.default_rng(0)
    net = toxicity.Network(3, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask, y = rng.standard_normal((5, 4, 3)), np.ones((5, 4), bool), np.array([0, 1, 1, 0])
    mask[3:, 1] = False

    def loss():
        z = net.forward(x @ net.p["x"] + net.p["b"], mask)
        return float((np.logaddexp(0, z) - y * z).sum())

    kept, g = {}, {k: np.zeros_like(v) for k, v in net.p.items()}
    z = net.forward(x @ net.p["x"] + net.p["b"], mask, kept)
    d = net.backward(1 / (1 + np.exp(-z)) - y, kept, mask, g)
    g["x"] += np.tensordot(x, d, ((0, 1), (0, 1)))
    g["b"] += d.sum((0, 1))
    for k, v in net.p.items():
        for at in (0, v.size // 2, v.size - 1):
            old = v.flat[at]
            v.flat[at] = old + 1e-3
            up = loss()
            v.flat[at] = old - 1e-3
            down = loss()
            v.flat[at] = old
            assert g[k].flat[at] == pytest.approx((up - down) / 2e-3, abs=2e-2), k


def brute_top_k(rows, k=5):
    fine = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, vector) in enumerate(fine):
        if q % 50 == 0:
            best = sorted((-int(vector @ v), i) for j, (i, v) in enumerate(fine) if j != at)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 3, 900])
def test_top_k_against_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(kd_search, "SHARD_ROWS", 64)
    monkeypatch.setattr(kd_search, "QUERY_BLOCK", 5)
    monkeypatch.setattr(kd_search, "BOX_BYTES", 4 * 6 * 16)  # four cells of several shards each
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(6) * 0.1]) for i in range(n)]
    if n > 100:
        rows = [(i, rows[7][1] if i % 3 == 1 else v) for i, v in rows]  # a third are copies: ties and a hot cell
        rows += [(50, rows[3][1]), (50, rows[3][1]), (7, [0.9] * 6), (100, [0.9] * 6)]  # rows that share an id, with equal and other vectors
        rows += [(2000, None), (2050, [0.1, None, 0.1, 0.1, 0.1, 0.1]), (2100, [float("nan")] * 6), (2150, [float("inf")] + [0.0] * 5), (None, [0.1] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    floats = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = kd_search.search(df, F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute_top_k(floats)


def test_page_text_on_held_out_layouts():
    model = html_graph.Model.fit(html_graph.labelled_pages(300), steps=300)
    wrong = 0
    for html in html_graph.labelled_pages(80, seed=11):
        p = html_graph.Page(html)
        want = "\n".join(t for t, y, k in zip(p.texts, p.labels(), p.kind, strict=True) if t is not None and y and k == html_graph.LEAF)
        wrong += model.texts([html])[0] != want
    assert wrong <= 8
    pages = ["", "<", "<article><p>a &amp; b&nbsp; c &am", "<script>x", "<div>" * 3000 + "x", "<article><h1>A</h1>b <b>c</b>d<ul><li>1<li>2</ul></article>", "<nav><a href=x>no</a></nav><article><h1>T</h1><p><b>one<br><p>two\n three</p></article><footer>&copy; x</footer>"]
    texts = model.texts(pages)
    assert texts[2] == "a & b c &am" and texts[3] == "" and texts[5] == "A\nb cd\n1\n2" and texts[6] == "T\none\ntwo three"


def test_page_text_where_no_name_tells_the_article():
    models = html_graph.Layouts.fit(250, 250, (250, 200))
    told = html_graph.labelled_pages(60, seed=11)
    assert models.texts(told) == models.named.texts(told)  # names and tags that speak for content decide alone
    para = "Dies ist ein langer Absatz mit vielen Worten, der den Inhalt der Seite ausmacht. " * 4
    for html in (
        f'<body><div class="xq zz"><a href=/>Start</a> <a href=/b>Info</a></div><div class="qqv"><h1>Titel</h1><p>{para}</p><p>{para}</p></div><div class="hhj">2024</div></body>',
        f'<body><div class="kopf"><a href=/>Start</a></div><div class="inhalt"><p>{para}</p></div><div class="fusszeile"><a href=/i>Impressum</a></div></body>',
        f"<table><tr><td><a href=/>Start</a><br><a href=/b>B</a></td><td><h1>T</h1><p>{para}</p></td></tr></table>",
        f"<body><div><div><p>{para}</p></div></div></body>",
    ):
        assert para.strip() in models.texts([html])[0].split("\n")


@pytest.mark.parametrize("bad", ['<a x" ' * 6000, '<a x" ' * 6000 + '"', "<a x\"'" * 5001, "</a<" * 9000, "<!--" * 9000, "<a/" * 9000 + "'", "<script>" * 4000, "<" * 32_000])
def test_hard_markup_is_read_in_linear_time(bad):
    start = time.perf_counter()
    html_graph.Page(bad)
    assert time.perf_counter() - start < 1.0


def test_tags_with_quotes():
    text = lambda html: [t for t in html_graph.Page(html).texts if t]
    assert text("<p title='a>b'>x</p>") == ["x"]
    assert text('<p title="never closed>x') == ['<p title="never closed>x']
    assert text("<script>if (a<b && c=\"</script><p>y</p>") == ["y"]
    assert text("<!-- <p>no</p> --><p>z<!-- open") == ["z"]


def test_marginals_are_exact(monkeypatch):
    pages = [html_graph.Page("<article class=a><p>x y.</p><div id=b><p>z</p>w</div></article><nav>q</nav>"), html_graph.Page("")]
    columns = {f: i for i, f in enumerate(sorted({x for p in pages for f in p.features for x in f}))}
    rng = np.random.default_rng(1)
    forest = html_graph.Forest(pages, columns)
    weights, edges = rng.standard_normal(len(columns)), rng.standard_normal((3, 2, 2))
    p, _, z = forest.marginals(weights, edges)
    u, n = forest.unary(weights), len(forest.parent)
    total, mass = 0.0, np.zeros(n)
    for state in np.ndindex(*[2] * n):
        s = sum(u[i, state[i]] for i in range(n)) + sum(edges[forest.kind[i], state[forest.parent[i]], state[i]] for i in range(n) if i not in (forest.first[0], forest.first[1]))
        total += np.exp(s)
        mass += np.exp(s) * np.array(state)
    assert z == pytest.approx(np.log(total))
    assert p == pytest.approx(mass / total)


def test_page_text_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>" + "word " * 50_000 + "</p></article>"), (4, "u", "<article><p>x</p></article>"), (4, "u", "<article><p>x</p></article>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    out = [(r["page_id"], len(r["text"])) for r in html_graph.extract(df, html_graph.Model.fit(html_graph.labelled_pages(120), steps=150)).collect()]
    assert sorted(out) == [(1, 0), (2, 0), (3, 249_999), (4, 1), (4, 1)]
    assert html_graph.extract(df.limit(0), html_graph.Model({}, np.zeros(0), np.zeros((3, 2, 2)))).count() == 0


def brute_url(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


def test_url_rules_against_all_rules(spark):
    rng = random.Random(6)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "xample.org", "com", "exa.com", "example.org.com", "É.org", "net", ""]
    paths = ["", "/", "/e", "/es/", "/es/1", "/en/1", "/en/12", "/fr/", "/de/x"]
    rules = list({(h, p): (h, p, rng.choice(("allow", "block"))) for h in hosts[:8] for p in rng.sample(paths, 4)}.values())
    urls = [f"{rng.choice(('http', 'https'))}://{rng.choice(hosts).upper() if rng.random() < 0.3 else rng.choice(hosts)}{rng.choice(paths)}{rng.choice(('', '?q=/es/', '#x', '/tail'))}" for _ in range(800)]
    urls += [None, "", "example.org/es/", "://", "http://example.org?x", "a://b://c/d", "http://example.org/es/" + "y" * 50_000] + ["http://a.example.org/es/1"] * 400
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("", "/", "block"), ("com", None, "allow")], "host string, path string, verdict string")
    rules = [*rules, *([("com", "", "allow")] if ("com", "") not in {(h, p) for h, p, _ in rules} else [])]
    for r in url_rules.judge(df, table).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_url(urls[r["page_id"]], rules), urls[r["page_id"]]
    assert url_rules.judge(df.limit(0), table).count() == 0
    assert {r["verdict"] for r in url_rules.judge(df, table.limit(0)).collect()} == {"allow"}


def test_consistent_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    sampler = near_dup.Sampler()
    agree, exact = [], []
    for _ in range(150):
        h = np.unique(rng.integers(1, 1 << 62, 60).astype(np.uint64))
        a, b = np.sort(rng.choice(h, 50, replace=False)), np.sort(rng.choice(h, 50, replace=False))
        w = dict(zip(h.tolist(), rng.choice([1.0, 1.3, 2.5], len(h)), strict=True))
        both = [np.array([w[int(x)] for x in s], np.float32) for s in (a, b)]
        sig = sampler(np.r_[a, b], np.r_[np.zeros(50, int), np.ones(50, int)], np.r_[both[0], both[1]], 2)
        agree.append((sig[0] == sig[1]).mean())
        exact.append(near_dup.weighted_jaccard(*[s.astype("<u8").tobytes() + v.astype("<f4").tobytes() for s, v in zip((a, b), both, strict=True)]))
    assert np.mean(agree) == pytest.approx(np.mean(exact), abs=0.02)


def test_common_features_are_counted_exactly(spark):
    rng = random.Random(8)
    shared = text_of(rng, 6)
    texts = [text_of(rng, 30) + (" " + shared if i % 4 == 0 else "") for i in range(200)]
    keys, idf = near_dup.common_features(spark.createDataFrame([(t,) for t in texts], "text string").repartition(7))
    assert near_dup.RAREST_IDF > idf.min() > 1
    share = 0.25
    assert idf.min() == pytest.approx(1 + (near_dup.RAREST_IDF - 1) * np.log(1 / share) / np.log(1 / 0.01), rel=0.1)


def test_near_duplicates_against_all_pairs(spark, make_docs):
    rng = random.Random(7)
    rows, n = [], 0

    def add(t):
        nonlocal n
        rows.append((n, t, "en", "s"))
        n += 1

    for _ in range(25):
        base = text_of(rng, rng.choice((30, 80, 200))).split()
        add(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            w = list(base)
            for _ in range(rng.choice((0, 1, 1, 3))):
                w[rng.randrange(len(w))] = "changed"
            add(" ".join(w))
    for t in ("a b c", "a  b c", "a b d", "", None, " ", "one", text_of(rng, 20_000)):
        add(t)
    rows += [(None, rows[0][1], "en", "s"), rows[1], rows[1]]
    docs = make_docs(rows)
    keys, idf = near_dup.common_features(docs.select("text"))
    blobs = {r["doc_id"]: bytes(r["v"]) for r in near_dup.vectors(docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), keys, idf).collect()}
    parent = {i: i for i in blobs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in blobs:
        for b in blobs:
            if a < b and blobs[a] and blobs[b] and near_dup.weighted_jaccard(blobs[a], blobs[b]) >= 0.8 - 1e-9:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = near_dup.classes(docs).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == {i: root(i) for i in blobs}
    stay = near_dup.drop_near_copies(docs)
    assert stay.columns == docs.columns
    ids = [r["doc_id"] for r in stay.collect()]
    assert sorted(ids, key=lambda i: (i is None, i)) == [*sorted({root(i) for i in blobs}), None]
    assert near_dup.classes(docs.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from ridestat.llm.common import stored

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        assert docs.columns == columns, name
    out = pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert 0 < out.count() == docs.count() <= 3 * before
    assert out.where("not round_trip").isEmpty()
    assert out.count() == pipeline.run(spark, sf_dir).count()
