import numpy as np

import corpus_pipeline
from faultline.llm import main_text, vantage


def test_main_text_of_an_article():
    page = (
        "<html><head><title>T</title><script>var a='<p>x</p>'</script></head><body>"
        "<header>Site</header><nav><ul><li><a href=/a>Home</a></ul></nav>"
        "<div class='ad banner'>Buy <div>now</div></div><article><header><h1>Head &amp; tail</h1></header>"
        "<p>One\n two&nbsp;<b>three</b><!-- no --></p><p>Short.</p><form><p>Sign up</p></form>"
        "<section id=comments><p>First!</p></section></article><aside>More</aside>"
        "<div class='cookie-notice'>OK?</div><footer>&copy; me</footer></body></html>"
    )
    assert main_text.main_text(page) == "Head & tail\nOne two three\nShort."


def test_main_text_by_distribution():
    body = "".join(f"<p>{'words and more words ' * 8}{i}</p><p>Short {i}.</p>" for i in range(4))
    page = f"<div><a href=/>Home</a></div><p>Skip</p><br><div><a>x</a></div><div><a>y</a></div>{body}"
    got = main_text.main_text(page).split("\n")
    assert len([x for x in got if x.startswith("words")]) == 4
    assert [f"Short {i}." for i in range(3)] == [x for x in got if x.startswith("Short")][:3]
    assert main_text.main_text(None) == main_text.main_text("") == main_text.main_text("<nav>a</nav>") == ""
    assert main_text.main_text("<article>a < b &lt; c <p") == "a < b < c"


def test_pages_odd_rows(spark):
    rows = [(1, "u", "<article>a"), (1, "u", "<article>a"), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    got = sorted(map(str, main_text.extract_pages(pages).collect()))
    assert len(got) == 4 and "Row(page_id=None, url=None, text='', n_chars=0)" in got
    assert main_text.extract_pages(pages.limit(0)).count() == 0


def brute_nearest(rows, k):
    out = {}
    ok = [(i, np.array(x, float)) for i, x in rows if i is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    for q, x in ok:
        if q % 20 == 0:
            others = [(-float(np.cumsum(x * y)[-1]), i) for i, y in ok if i != q and len(y) == len(x)]
            out[q] = [i for _, i in sorted(others)[:k]]
    return out


def test_nearest_is_exact_at_factor_one(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(900)]
    rows += [(900 + i, rows[7][1]) for i in range(60)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (None, [1.0] * 8), (2060, [1.0, None])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    points = vantage.valid(frame).distinct()
    index = vantage.build_index(points, 5, shard_rows=200)
    found = vantage.search(index, points.where("vec_id % 20 = 0"), 5)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute_nearest(rows, 5)
    assert vantage.nearest(frame.limit(0)).count() == 0


def test_relaxed_search_keeps_recall(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    exact = {(r.query_id, r.vec_id) for r in vantage.nearest(vectors).collect()}
    near = {(r.query_id, r.vec_id) for r in vantage.nearest(vectors, relax=0.9).collect()}
    assert len(exact & near) >= 0.9 * len(exact)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialize(stage(spark, docs, sf_dir), f"test-{name}")
        kept.append(out)
        if name != "best_fit_packing":
            assert out.columns == columns
        docs = out
    language, lines, near, mixed, packed = kept
    assert lines.count() == language.count() and 0 < near.count() < lines.count()
    words = sum(len(r.text.split()) for r in mixed.collect())
    assert abs(words - sum(len((r.text or "").split()) for r in near.collect())) <= 40
    assert packed.agg({"words": "sum"}).first()[0] == words
