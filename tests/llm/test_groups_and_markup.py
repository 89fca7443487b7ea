"""Equal texts in shards, texts of formulas and fallbacks in pages, pages without markup, and the screen of the vector join."""

import random
import zlib
from collections import defaultdict

import numpy as np

from zpoints.llm import egojoin, htmlcrf, sharding


def shards_of_texts(docs, **options):
    out = sharding.kd_shards(docs, **options).collect()
    by_text = defaultdict(set)
    for r in out:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
    return out, by_text


def test_equal_texts_share_a_shard_where_they_fit(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(20, 400))) for _ in range(600)]
    rows = [(i, rng.choice(texts), rng.choice(["p", "q", None]), rng.choice(["en", "de"])) for i in range(1500)]
    rows += [(None, texts[0], "p", "en"), (7, texts[1], "q", "de"), (7, texts[2], "q", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    out, by_text = shards_of_texts(docs, n_shards=8)
    assert len(out) == len(rows) and all(len(s) == 1 for s in by_text.values())
    size = defaultdict(int)
    for r in out:
        size[r["shard"]] += r["size"]
    assert len(size) == 8 and max(size.values()) < 1.1 * min(size.values())
    want = sorted((zlib.crc32(t.encode()), len(t) + 16) for _, t, _, _ in rows)
    assert sorted((r["text_crc32"], r["size"]) for r in out) == want


def test_a_text_larger_than_a_shard_is_split_and_the_rest_kept_together(spark):
    rows = [(i, "hot text " * 10, "p", "en") for i in range(1000)] + [(5000 + i, f"text {i % 300} " * 8, "q", "en") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    out, by_text = shards_of_texts(docs, n_shards=10)
    hot = (zlib.crc32(("hot text " * 10).encode()), 106)
    assert len(by_text[hot]) >= 4 and all(len(s) == 1 for t, s in by_text.items() if t != hot)
    for s in range(10):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))


def test_text_of_formulas_objects_and_fallbacks_is_kept():
    page = ("<article><p>Let <math><mi>x</mi></math> be the value, and <object data='a'>inline text</object> stays.</p>"
            "<noscript><p>Plain text for all.</p></noscript><p>Film: <video src='v'>a film</video> and <canvas>a drawing</canvas>.</p>"
            "<script>no('<p>text</p>')</script><style>p{}</style><template><p>inert</p></template><p>End.</p></article>")
    assert [b.text for b in htmlcrf.leaf_blocks(page)] == [
        "Let x be the value, and inline text stays.", "Plain text for all.", "Film: a film and a drawing.", "End."]


PAGE = "<html><body><{0} class='{1}'><h1>Title {2}</h1><p>First sentence of the page numbered {2}, long enough to be text.</p>" \
       "<p>Second sentence, which also says something of interest, and ends.</p></{0}><footer>All rights reserved</footer></body></html>"


def test_labelled_pages_are_picked_among_those_with_markup(spark):
    """Three in a thousand pages have semantic markup: the field is fitted on them, not on the first by hash."""
    rows = [(i, f"u{i}", PAGE.format("article" if i % 333 == 5 else "div", "x", i)) for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    model = htmlcrf.learn(pages, max_pages=20)
    assert model.keep != htmlcrf.prior().keep
    assert htmlcrf.learn(pages.where("page_id % 333 <> 5")).keep == htmlcrf.prior().keep


def test_learning_reads_the_end_of_long_pages(spark):
    body = "".join(f"<p>Sentence number {i} of the article, which has some length to it.</p>" for i in range(150))
    rows = [(i, "u", f"<html><body><article>{body}</article><div class='zzz'><ul><li>Links at the end</li><li>{i}</li></ul></div></body></html>")
            for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = htmlcrf.extract_main_text(pages).first()
    assert "Links at the end" not in out["text"] and out["text"].count("\n") == 149


def test_screen_never_loses_a_link():
    rng = np.random.default_rng(3)
    u = rng.normal(size=(400, 30))
    u[200:] = u[:200] + rng.normal(size=(200, 30)) * rng.choice([0.05, 0.3, 0.45], size=(200, 1))
    u = egojoin._unit(u)
    axes = np.linalg.qr(rng.normal(size=(30, 6)))[0]
    head = egojoin.projected(u, axes)
    assert (head @ head.T >= u @ u.T - 1e-9).all()
    gap = np.sqrt(((head[:, None] - head[None]) ** 2).sum(2))
    assert (gap <= np.sqrt(np.maximum(2 - 2 * (u @ u.T), 0)) + 1e-6).all()


def test_interval_pairs_skip_what_is_far_apart(spark):
    rows = [(i, [float(3 * (i // 4)), 0.0], [float(3 * (i // 4)) + 1, 1.0]) for i in range(16)]
    boxes = spark.createDataFrame(rows, "id long, lo array<double>, hi array<double>")
    got = {(r["a"], r["b"]) for r in egojoin.interval_pairs(boxes, 16, 2, 1.5, 2).collect()}
    assert got == {(a, b) for a in range(16) for b in range(a, 16) if a // 4 == b // 4}
    shares = egojoin.pair_shares(boxes, 16, 2, 1.5, 2)
    assert len(shares) == 5 and shares[0] == 1 and shares[-1] == len(got) / 136 and shares == sorted(shares, reverse=True)


def test_groups_of_vectors_of_any_interval(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20, 12)).repeat(15, axis=0) + rng.normal(size=(300, 12)) * 0.1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = egojoin._unit(x)
    want = [int(n) - 1 for n in (u @ u.T >= 0.9).sum(1)]
    for size in (12 * 8 * 32, 8 << 20):
        out = egojoin.cosine_links(df, block=16, interval_bytes=size, screen=4).orderBy("vec_id").collect()
        assert [r["n_links"] for r in out] == want
