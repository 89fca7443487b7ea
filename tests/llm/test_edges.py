"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brute
from llm_fixtures import edge_docs, edge_labels, no_docs, no_labels  # noqa: F401
from zpoints.llm import bpe, egojoin, htmlcrf, mixing, probminhash, quality, queries, sharding, substring, toxicity, vptree

tokenizers = pytest.importorskip("public_tokenizers")
RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_score_every_row(module, edge_docs, edge_labels, no_docs, no_labels):
    n = edge_docs.count()
    for labels in (edge_labels, no_labels):
        out = module.score_documents(edge_docs, labels).collect()
        assert len(out) == n
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] in (True, False) for r in out)
        blank = {r["score"] for r in out if r["doc_id"] in (2, 3)}
        assert len(blank) == 1  # null counts as empty
    assert module.score_documents(no_docs, edge_labels).count() == 0


def test_grammar_arcs():
    scorer = toxicity.Scorer({"idiot": 4.0, "schlim*": 3.0})
    plain, aimed = scorer.clause("some idiot thing"), scorer.clause("you are an idiot")
    denied, told = scorer.clause("nobody is an idiot"), scorer.clause("she said idiot")
    assert denied < plain < aimed and told < aimed
    assert scorer.clause("schlimbo") == 3.0 and scorer.clause("idiotic") == 0
    assert scorer.clause("we will kill you") == 4.0 and scorer.clause("kill you will") == 0
    assert scorer.features("Idiot! not here. An idiot, idiot.")[2] == pytest.approx(np.log(3))
    assert scorer.features("") == (0.0, 0.0, 0.0, 0.0)


def test_toxic_stage_keeps_columns(edge_docs, edge_labels):
    out = toxicity.drop_toxic(edge_docs, edge_labels)
    assert out.schema == edge_docs.schema and out.count() <= edge_docs.count()


def test_near_duplicates(edge_docs, no_docs):
    want = brute.near_classes(texts_of(edge_docs))
    out = probminhash.near_duplicates(edge_docs).collect()
    assert len(out) == edge_docs.count()
    assert {(r["doc_id"], r["class_id"]) for r in out} == set(want.items()) | {(None, None)}
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in out)
    assert probminhash.near_duplicates(no_docs).count() == 0
    kept = probminhash.drop_near_duplicates(edge_docs)
    assert kept.schema == edge_docs.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert {i for i in ids if i is not None} == {i for i, c in want.items() if i == c} and ids.count(None) == 2


def test_buckets_with_several_components_are_compared_in_blocks(spark):
    """Documents around one shared passage: alike, but below the threshold, except for a chain of near copies."""
    import random
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shared = [word() for _ in range(70)]
    rows = [(i, " ".join([word() for _ in range(12)] + shared + [word() for _ in range(12)])) for i in range(60)]
    chain = rows[0][1].split(" ")
    for i in range(60, 75):
        chain = [*chain[2:], word(), word()]
        rows.append((i, " ".join(chain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_classes(dict(rows))
    assert 1 < len(set(want.values())) < 75
    got = {r["doc_id"]: r["class_id"] for r in probminhash.near_duplicates(docs, block=16).collect()}
    assert got == want


def test_sketch_estimates_probability_jaccard():
    a, b = " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(30, 330))
    at, element, weight = probminhash.weighted_sets([a, b], 5)
    who = probminhash.probminhash(at, element, weight, 2, 4096)
    assert abs((who[0] == who[1]).mean() - 266 / 326) < 0.03
    at, element, weight = probminhash.weighted_sets(["p q r s t u", "p q r s t u " * 9], 5)
    assert (weight > 1).any()


def test_near_duplicates_whose_difference_is_a_much_repeated_line(spark):
    """Plain similarity is 0.8 or a little more, however often the differing lines are repeated."""
    import random
    rng = random.Random(8)
    line = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    rows = []
    for i in range(12):
        common = line(104)
        rows += [(10 * i, common), (10 * i + 1, common + (" " + line(20)) * 1000)]
        shared = line(304)
        rows += [(10 * i + j, shared + (" " + line(30)) * 200) for j in (2, 3)]
        rows.append((10 * i + 4, shared + " " + line(150)))
    want = brute.near_classes(dict(rows))
    assert all(want[10 * i + 1] == 10 * i and want[10 * i + 3] == 10 * i + 2 for i in range(12))
    assert all(want[10 * i + 4] == 10 * i + 4 for i in range(12))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in probminhash.near_duplicates(docs).collect()}
    assert got == want


def test_bands_follow_the_weighted_floor():
    a = " ".join(f"w{i}" for i in range(104)) + (" " + " ".join(f"a{i}" for i in range(20))) * 1000
    b = " ".join(f"w{i}" for i in range(104))
    at, element, weight = probminhash.weighted_sets([a, b], 5)
    assert weight.max() == probminhash.MOST_WEIGHT
    who = probminhash.probminhash(at, element, weight, 2, 4096)
    assert (who[0] == who[1]).mean() > probminhash.weighted_floor(0.8) - 0.03
    assert probminhash.rows_of_band(0.8, 128) == 4
    with pytest.raises(ValueError):
        probminhash.rows_of_band(0.05, 128)


def test_substring_dedup(edge_docs, no_docs):
    want = brute.without_repeats(texts_of(edge_docs))
    out = substring.removal_digests(edge_docs).collect()
    assert len(out) == edge_docs.count()
    for r in out:
        if r["doc_id"] is not None:
            w, kept = want[r["doc_id"]]
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), len(w) - len(kept), brute.sha(" ".join(kept)))
        else:
            assert r["n_removed"] == 0
    assert substring.removal_digests(no_docs).count() == 0
    cut = substring.remove_repeats(edge_docs)
    assert cut.schema == edge_docs.schema and cut.count() == edge_docs.count()
    for r in cut.where("doc_id IS NOT NULL").collect():
        w, kept = want[r["doc_id"]]
        assert brute.words(r["text"]) == kept
        if len(kept) == len(w):
            assert (r["text"] or "") == (texts_of(edge_docs.where(F.col("doc_id") == r["doc_id"]))[r["doc_id"]] or "")


def test_substring_dedup_in_small_shards(edge_docs):
    candidates = substring.candidate_texts(edge_docs, size=20, gram=10)
    spans = substring.repeated_spans(candidates.cache(), shard_words=200, task_words=300).collect()
    gone = {}
    for r in spans:
        gone.setdefault(r["doc_id"], set()).update(range(r["lo"], r["hi"]))
    want = brute.without_repeats(texts_of(edge_docs))
    assert {i: len(g) for i, g in gone.items()} == {i: len(w) - len(k) for i, (w, k) in want.items() if len(w) > len(k)}


def test_automaton_matches_a_scan():
    import random
    rng = random.Random(1)
    seqs = [[rng.choice("ab") for _ in range(rng.randint(1, 40))] for _ in range(12)]
    automaton = substring.SuffixAutomaton()
    for i, s in enumerate(seqs):
        automaton.add(s, i, 0)
    seen = {}
    for i, s in enumerate(seqs):
        want = set()
        for p in range(len(s) - 3):
            if seen.setdefault(tuple(s[p:p + 4]), (i, p)) < (i, p):
                want.update(range(p, p + 4))
        got = {x for lo, hi in automaton.repeats(s, i, 0, 4) for x in range(lo, hi)}
        assert got == want


def test_mixing(edge_docs, no_docs):
    out = mixing.mix_sources(edge_docs).collect()
    rows = [(r["doc_id"], r["source"], len(brute.words(r["text"]))) for r in edge_docs.collect()]
    target, size = brute.mix(rows)
    assert sorted(map(repr, rows)) == sorted(repr((r["doc_id"], r["source"], r["size"])) for r in out)
    taken = dict.fromkeys(target, 0)
    most = dict.fromkeys(target, 0)
    for r in out:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == size[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        assert (r["position"] is None) == (r["copies"] == 0) and 0 <= (r["position"] or 0) <= 1
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6 for s in target)
    assert mixing.mix_sources(no_docs).count() == 0
    ordered = mixing.training_order(edge_docs, mixing.mix_sources(edge_docs))
    assert ordered.schema == edge_docs.schema
    again = {}
    for r in ordered.collect():
        again[r["doc_id"]] = again.get(r["doc_id"], 0) + 1
    once = {}
    for r in out:
        once.setdefault(r["doc_id"], []).append(r["copies"])
    assert all(again.get(i, 0) in (sum(c), len(c) * max(c), len(c) * min(c)) for i, c in once.items())


def test_training_order_keeps_each_row_its_own_plan(spark):
    """A third of the rows has no id, and ids are repeated in other sources with other texts."""
    import random
    rng = random.Random(9)
    rows = [(None if i % 3 == 0 else i // 2, " ".join(rng.choice("abcdef") for _ in range(i % 7)) + f" {i % 50}",
             ("p", "q", "r", None)[i % 4]) for i in range(1200)]
    rows += [(None, "same text again", "p")] * 200 + [(5, "", "q")] * 3 + [(None, None, "r")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    mixed = mixing.mix_sources(docs).collect()
    ordered = mixing.training_order(docs, mixing.mix_sources(docs))
    assert ordered.schema == docs.schema
    got, plan, given, taken, most = {}, {}, {}, {}, {}
    for r in ordered.collect():
        key = (r["doc_id"], r["source"], len(brute.words(r["text"])))
        got[key] = got.get(key, 0) + 1
        given.setdefault((r["doc_id"], r["source"], r["text"]), []).append(1)
        taken[r["source"]] = taken.get(r["source"], 0) + key[2]
    for r in mixed:
        key = (r["doc_id"], r["source"], r["size"])
        plan[key] = plan.get(key, 0) + r["copies"]
        most[r["source"]] = max(most.get(r["source"], 0), r["size"])
    assert got == {k: n for k, n in plan.items() if n}
    for source, want in brute.mix([(i, s, len(brute.words(t))) for i, t, s in rows])[0].items():
        assert abs(taken[source] - want) <= most[source] / 2 + 1e-6
    # no row is taken more often than the cap allows, whatever rows share its id
    assert all(len(n) <= 2 * rows.count((i, t, s)) for (i, s, t), n in given.items())


def test_position_inverts_demand(spark):
    t = spark.range(0, 101).select((F.col("id") / 100).alias("t")).crossJoin(
        spark.createDataFrame([(0.6,), (0.0,), (-0.6,), (1.0,), (-1.0,)], "a double"))
    demand = 50.0 * ((1 - F.col("a")) * F.col("t") + F.col("a") * F.col("t") * F.col("t"))
    got = t.select(F.max(F.abs(mixing.position(demand, F.lit(50.0), F.col("a")) - F.col("t"))).alias("e")).first()["e"]
    assert got < 1e-6


def test_curriculum_times_every_copy(spark):
    """In each tenth of the training the copies due then hold about the words that the schedule wants of each source."""
    rows = [(i, "w " * (1 + i % 9), "abc"[i % 3]) for i in range(3000)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(len(r.positions) == r.copies and r.positions == sorted(r.positions) for r in mixed)
    assert max(r.copies for r in mixed) > 1
    for source, slope in zip("abc", mixing.SLOPES):
        mine = [r for r in mixed if r.source == source]
        demand = lambda t: mine[0].target * ((1 - slope) * t + slope * t * t)  # noqa: E731, B023
        for k in range(10):
            due = sum(r.size for r in mine for t in r.positions if k / 10 <= t < (k + 1) / 10)
            assert abs(due - (demand((k + 1) / 10) - demand(k / 10))) <= 18


def test_digests_count_the_mix_that_was_run(spark, monkeypatch):
    """op4's words, copies and times come from the mix: its table of contents holds every copy, in training order."""
    rows = [(None if i % 5 == 0 else i // 2, None if i % 11 == 0 else "w " * (i % 9) + f"t{i}", ("a", "b", "c", None)[i % 4])
            for i in range(900)]
    rows += [(None, None, "a")] * 3 + [(7, "same text", "b")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    tables = {}
    kept = mixing.save
    monkeypatch.setattr(mixing, "save", lambda df, label: tables.setdefault(label, kept(df, label)))
    monkeypatch.setattr(queries, "table", lambda spark, sf, name: docs)
    got = queries.op4_curriculum_mix(spark, "").collect()
    nth = "regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1) * 10000000 + _metadata.row_index AS n"
    mix = [r for r in sorted(tables["mix-contents"].selectExpr("*", nth).collect(), key=lambda r: int(r["n"])) if r["at"] is not None]
    assert [r["at"] for r in mix] == sorted(r["at"] for r in mix) and len(mix) == sum(r["copies"] for r in got) > 900
    assert all(r["words"] == r["size"] for r in mix) and len(got) == len(rows)
    assert sum(r["words"] for r in mix) == sum(r["taken"] for r in got)
    monkeypatch.undo()
    plan = mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "position").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, plan)))


def test_sharding(edge_docs, no_docs, spark):
    out = sharding.kd_shards(edge_docs, n_shards=7).collect()
    assert len(out) == edge_docs.count()
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert sharding.kd_shards(no_docs, n_shards=7).count() == 0
    # one source holds nearly all rows, and all texts are equal: split all the same
    even = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"),
                                    F.lit("en").alias("lang"))
    got = [r["n"] for r in sharding.kd_shards(even, n_shards=40).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(got) == 40 and max(got) - min(got) <= 5


def test_bpe(edge_docs, no_docs):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.load_ranks(RANKS)
    gold = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((repr(r["doc_id"]), len(ids := gold.encode_ordinary(r["text"] or "")),
                   brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(r["text"] or "")) for r in edge_docs.collect())
    out = bpe.encode_digests(edge_docs, RANKS, tokenizers.PATTERN, cache_pieces=50, chars_at_once=2000).collect()
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out) == want
    round_trip = bpe.decode(bpe.encode(edge_docs.where("doc_id > 6"), RANKS, tokenizers.PATTERN), RANKS)
    texts = texts_of(edge_docs)
    assert all(bytes(r["decoded"]) == texts[r["doc_id"]].encode() for r in round_trip.collect())
    assert bpe.encode_digests(no_docs, RANKS, tokenizers.PATTERN).count() == 0


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("shard", T.StringType()),
                        T.StructField("v", T.StringType()), T.StructField("n", T.StringType())])


def vector_rows():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 16))
    rows = [(i, (centre[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.2, 1.0])).tolist()) for i in range(900)]
    hot = rng.normal(size=16).tolist()
    rows += [(1000 + i, hot) for i in range(150)] + [(2000 + i, [2 * x for x in hot]) for i in range(5)]
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(3000 + i, v) for i, v in enumerate(bad)] + [(3020, [1.0] * 5), (3021, [1.0] * 5), (None, hot)]
    return [(i, v, 0, "x", "x", "x") for i, v in rows]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), VECTORS).repartition(4).cache()


def good_vectors():
    out = {}
    for i, v, *_ in vector_rows():
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            out[i] = np.array(v, np.float32).astype(float)
    return out


def test_cosine_links(vectors, spark):
    good = good_vectors()
    ids = sorted(good)
    links = []
    degree = dict.fromkeys(ids, 0)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = good[a], good[b]
            if len(x) == len(y) and x.dot(y) / (np.sqrt(x.dot(x)) * np.sqrt(y.dot(y))) >= 0.9:
                links.append((a, b))
                degree[a] += 1
                degree[b] += 1
    comp = brute.components(ids, links)
    out = egojoin.cosine_links(vectors, block=16, interval_bytes=64 * 8 * 16, screen=10).collect()
    assert len(out) == vectors.count()
    for r in out:
        i = r["vec_id"]
        if i in good:
            assert (r["n_links"], r["component_id"], r["kept"]) == (degree[i], comp[i], comp[i] == i)
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, i, True)
    assert egojoin.cosine_links(spark.createDataFrame([], VECTORS)).count() == 0


def test_vantage_point_search(vectors, spark):
    good = good_vectors()
    query = F.col("vec_id") % 20 == 0
    exact = vptree.search(vectors, query, k=20, factor=1.0, shard_rows=100, query_rows=16, leaf=8).collect()
    got = {}
    for r in exact:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in (i for i in good if i % 20 == 0):
        dot = lambda i: float(np.cumsum(good[q] * good[i])[-1])  # noqa: E731, B023
        want = sorted(((-dot(i), i) for i in good if i != q and len(good[i]) == len(good[q])))[:20]
        assert [(k + 1, i) for k, (_, i) in enumerate(want)] == [x[:2] for x in sorted(got.get(q, []))]
        assert [-s for s, _ in want] == [x[2] for x in sorted(got.get(q, []))]
    some = vptree.search(vectors, query, k=20, factor=1.2, shard_rows=100, query_rows=16, leaf=8).collect()
    pairs = lambda rows: {(r["query_id"], r["vec_id"]) for r in rows}
    assert len(pairs(some) & pairs(exact)) >= 0.9 * len(exact)
    assert vptree.search(spark.createDataFrame([], VECTORS), query).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T %d</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">More</a></li></ul></nav><div class="ad">Buy things now.</div>
<article><h1>Title %d</h1><p><b>First &amp; foremost text of
 page %d.<br><p>Second   paragraph, with an <a href="x">inner link</a> and more.</p><p>Short.</p></article>
<footer>&copy; somebody &middot; All rights.</footer>"""


def test_html_extraction(spark):
    rows = [(i, f"u{i}", PAGE % (i, i, i), "x") for i in range(60)]
    odd = [(100, None, None, "x"), (101, "u", "", "x"), (None, "u", "<p>only <!-- open", "x"), (102, "u", "<div", "x"), (103, "u", "<script>x", "x"),
           (0, "u0", PAGE % (0, 0, 0), "x"),
           (104, "u", "<article><p>Body text of it.</p><section class='comments'><p>I agree with all of this. Well said.</p>"
                      "</section><aside><p>Related: another story that you may like to read.</p></aside></article>", "x")]
    pages = spark.createDataFrame(rows + odd, "page_id long, url string, html string, text string")
    out = {r["page_id"]: r for r in htmlcrf.extract_main_text(pages).collect()}
    for i in range(60):
        want = f"Title {i}\nFirst & foremost text of page {i}.\nSecond paragraph, with an inner link and more.\nShort."
        assert out[i]["text"] == want and out[i]["n_chars"] == len(want)
    assert all(out[i]["text"] == "" for i in (100, 101, 102, 103))
    assert out[104]["text"] == "Body text of it."
    assert htmlcrf.extract_main_text(pages.where("false")).count() == 0
    assert htmlcrf.extract_main_text(pages.where("page_id = 101")).first()["text"] == ""


def test_leaf_blocks():
    blocks = htmlcrf.leaf_blocks("<p>a &lt; b<i>c</i> d<p>e<br>f<ul><li>x<li>y</ul>tail &am <!-- no --> &#x41;")
    assert [b.text for b in blocks] == ["a < bc d", "e f", "x", "y", "tail &am A"]
    assert "li" not in blocks[-1].tags


def test_pruning_does_not_hang_on_norms(spark):
    """Neither one vector of 100 times the norm nor a query of a large or small norm may cost recall."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 24)) + 2 * rng.normal(size=(30, 24))[np.arange(3000) % 30]
    x /= np.sqrt((x**2).sum(1))[:, None]
    scales = {7: 100.0, 50: 30.0, 100: 0.01}
    x[list(scales)] *= np.array(list(scales.values()))[:, None]
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), 0, "x", "x", "x") for i, v in enumerate(x)]
    got = vptree.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, k=20, factor=1.2, leaf=16).collect()
    found = {(r["query_id"], r["vec_id"]) for r in got}
    x = x.astype(float)
    want = set()
    for i in range(0, 3000, 50):
        s = x @ x[i]
        s[i] = -np.inf
        want |= {(i, int(j)) for j in np.argsort(-s, kind="stable")[:20]}
    for i in (50, 100):
        assert len({p for p in found & want if p[0] == i}) >= 17
    assert len(found & want) > 0.97 * len(want)


def test_ties_of_many_copies_go_to_the_smaller_ids():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 64))
    x /= np.sqrt((x**2).sum(1))[:, None]
    copies = rng.permutation(4000)[:2000]
    x[copies] = x[copies[0]]
    ids = rng.permutation(4000)
    q = x[copies[0]] + 0.05 * rng.normal(size=(60, 64)) * np.linspace(0, 3, 60)[:, None]
    qi, xi, _ = vptree.search_shard(x, ids, q, -np.arange(1, 61), k=20, factor=1.0, leaf=64)
    for i in range(60):
        exact = np.cumsum(q[i] * x, axis=1)[:, -1]
        assert ids[xi[qi == i]].tolist() == ids[np.lexsort((ids, -exact))[:20]].tolist()
