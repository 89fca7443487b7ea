"""Patricia-trie dedup, whitening and token alignment against plain versions, with nulls, copies, long texts and empty tables."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm_fixtures import edge_docs, no_docs  # noqa: F401
from test_edges import VECTORS, vector_rows
from zpoints.llm import patricia, queries, tokenalign, whitening

tokenizers = pytest.importorskip("public_tokenizers")
A, B = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")
SF_SMALL = "/root/testdata/sf0.001"


# --------------------------------------------------------------------------- op13

def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_classes(rows, out):
    """rows: (doc_id, text); out: the operator's rows."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    want = collections.Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[i, min(known) if known else None, len(ids), brute.sha(t)] += 1
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == want
    kept = collections.Counter(r["text_sha256"] for r in out if r["kept"])
    assert kept == collections.Counter(dict.fromkeys(map(brute.sha, groups), 1))
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


@pytest.mark.parametrize("limits", [{}, {"chunk_rows": 3, "hot_entries": 2}, {"chunk_bytes": 500, "part_bytes": 100_000, "trie_bytes": 3000},
                                    {"chunk_rows": 2, "hot_entries": 3, "part_bytes": 1 << 20, "trie_bytes": 2000}])
def test_exact_duplicates(edge_docs, no_docs, limits):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check_classes(rows, patricia.exact_duplicates(edge_docs, **limits).collect())
    if not limits:
        assert patricia.exact_duplicates(no_docs).count() == 0


def test_exact_duplicates_of_close_texts(spark):
    """Prefixes of one another, white space of all kinds, a hot text, one id with several texts, ids without texts."""
    rng = random.Random(6)
    base = " ".join(rng.choice("abcdef") * rng.randint(1, 9) for _ in range(4000))
    rows = [(i, base[:rng.randrange(0, len(base), 7)]) for i in range(150)]
    rows += [(500 + i, rng.choice(["a b", "a  b", "a\tb", "a\n\x0b b", " a b", "a b ", "a\xa0b", "a\x85b"])) for i in range(100)]
    rows += [(i // 3, rng.choice(["hot text", "hot  text"])) for i in range(600)] + [(7, "one"), (7, "two"), (7, "one"), (None, "one")]
    rows += [(None, "lonely")] * 3 + [(None, None), (9, ""), (None, base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for limits in ({}, {"chunk_rows": 5, "hot_entries": 4, "trie_bytes": 20_000, "part_bytes": 1 << 20}):
        check_classes(rows, patricia.exact_duplicates(docs, **limits).collect())


def test_dropping_keeps_columns(edge_docs):
    out = patricia.drop_exact_duplicates(edge_docs, chunk_rows=4)
    assert out.schema == edge_docs.schema
    got = collections.Counter(normal(r["text"]) for r in out.collect())
    assert got == collections.Counter(dict.fromkeys((normal(r["text"]) for r in edge_docs.collect()), 1))


def test_trie_finds_and_spills():
    rng = random.Random(2)
    keys = list({bytes(rng.choice(b"ab") for _ in range(rng.randrange(30))) for _ in range(400)} | {b"", b"a" * 500, b"a" * 499 + b"b"})
    trie, out = patricia.Patricia(), {}
    for n, k in enumerate(keys):
        node = trie.place(k)
        assert node.held is None
        node.held = n
    assert {k: trie.place(k).held for k in keys} == {k: n for n, k in enumerate(keys)} == dict(trie.terminals())
    before = trie.size
    out = dict(trie.spill())
    left = dict(trie.terminals())
    assert out and left and out | left == {k: n for n, k in enumerate(keys)} and trie.size < 0.7 * before
    assert all(trie.place(k) is None for k in out) and all(trie.place(k).held == n for k, n in left.items())
    while dict(trie.spill()):
        pass
    assert dict(trie.terminals())


def test_shared_prefix():
    rng = random.Random(3)
    for _ in range(500):
        a, b = (bytes(rng.choice(b"xy") for _ in range(rng.randrange(1, 9))) * rng.randrange(1, 40) for _ in range(2))
        at = rng.randrange(len(a))
        same = next((i for i, (p, q) in enumerate(zip(a[at:], b)) if p != q), min(len(a) - at, len(b)))
        assert patricia.shared_prefix(a, at, b) == same


def test_patricia_query_matches_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(queries.OP13_SQL)
    names = [d[0] for d in want.description]
    assert sorted(want.fetchall()) == sorted(map(tuple, queries.op13_patricia_dedup(spark, SF_SMALL).select(names).collect()))


# --------------------------------------------------------------------------- op12

def whitened_rows(out):
    got = collections.defaultdict(dict)
    for r in out:
        got[r["vec_id"], r["deviation"]][r["component"]] = r
    return got


def plain_whitening(vectors, k):
    x = np.floor(64 * vectors) + 1_000_000
    n, centred = len(x), x - x.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    sums = x.astype(np.int64).sum(0)
    return centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum(), ((n * x.astype(np.int64) - sums)**2).sum(1)


def check_whitening(out, vectors, ids, k=32):
    want, explained, deviation = plain_whitening(vectors, k)
    assert len(out) == len(want) * len(explained)
    by_row = collections.defaultdict(list)
    for r in out:
        by_row[r["vec_id"]].append(r)
    sign = {}
    for row, i in enumerate(ids):
        for r in by_row[i]:
            c = r["component"] - 1
            if abs(want[row, c]) > 0.1:
                sign.setdefault(c, np.sign(want[row, c] * r["whitened"]))
            assert r["whitened"] * sign.get(c, 1) == pytest.approx(want[row, c], abs=1e-6) or abs(want[row, c]) <= 0.1
            assert r["explained"] == pytest.approx(explained[c], rel=1e-6) and r["n"] == len(ids)
            assert r["deviation"] == deviation[row] and r["identity_error"] < 1e-6


def test_whitening(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(700, 24)) @ np.diag(np.linspace(3, 0.2, 24)) + 5).astype(np.float32)
    rows = [(i, v.tolist(), 0, "x", "x", "x") for i, v in enumerate(vectors)]
    odd = [(9000 + i, v, 0, "x", "x", "x") for i, v in enumerate(
        [None, [], [float("nan")] * 24, [1.0] * 23 + [None], [float("-inf")] + [0.0] * 23, [1.0] * 5])]
    out = whitening.whiten(spark.createDataFrame(rows + odd, VECTORS).repartition(5)).collect()
    check_whitening(out, vectors.astype(float), range(700))
    few = whitening.whiten(spark.createDataFrame(rows, VECTORS), n_components=3).collect()
    check_whitening(few, vectors.astype(float), range(700), k=3)


def test_whitening_of_dependent_and_ill_scaled_dimensions(spark):
    """A constant dimension, one that repeats another, one that sums two, and scales that differ a thousandfold."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * np.array([1000.0, 300, 50, 8, 2, 1])
    x = np.floor(x * 64) / 64
    x = np.hstack([x, np.full((400, 1), 7.0), x[:, :1], x[:, 1:2] + x[:, 2:3]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in out} == set(range(1, 7))
    check_whitening(out, x, range(400))


def test_whitening_of_degenerate_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(make([])).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(make([(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    two = whitening.whiten(make([(1, [0.0, 0.0]), (None, [1.0, 0.0]), (1, [0.0, 0.0])])).collect()
    assert sorted((r["vec_id"] is None, r["component"]) for r in two) == [(False, 1), (False, 1), (True, 1)]
    assert sorted(abs(r["whitened"]) for r in two) == pytest.approx([0.5**0.5, 0.5**0.5, 2**0.5])


def test_whitening_query(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    out = queries.op12_cholesky_whitening(spark, SF_SMALL).collect()
    check_whitening(out, np.array([r["embedding"] for r in table], float), [r["vec_id"] for r in table])


# --------------------------------------------------------------------------- op11

def dense(m):
    out = np.zeros((m.n_rows, m.n_cols), np.int64)
    rows = m.row_of_entry()
    assert len(set(zip(rows.tolist(), m.indices.tolist()))) == len(rows)
    out[rows, m.indices] = 1 if m.data is None else m.data
    return out


def test_gustavson_product():
    rng = np.random.default_rng(7)

    def sparse(d):
        rows, cols = np.nonzero(d)
        return tokenalign.Incidence(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(d)))]), cols, d.shape[1], d[rows, cols])

    for _ in range(40):
        n, m, k = rng.integers(1, 9, 3)
        a, b = rng.integers(0, 3, (n, m)), rng.integers(0, 3, (m, k))
        assert (dense(sparse(a) @ sparse(b)) == a @ b).all() and (dense(sparse(a).transpose()) == a.T).all()
    with pytest.raises(ValueError):
        sparse(a) @ sparse(np.ones((a.shape[1] + 1, 2), int))


def plain_alignment(texts, both):
    """Per text: (a ids, b ids, links, groups) by comparing byte ranges."""
    out = []
    for t in texts:
        a, b = both.encode([t])[0]
        span_a = np.concatenate([[0], np.cumsum([len(both.a_bytes[i]) for i in a])]).astype(int)
        span_b = np.concatenate([[0], np.cumsum([len(both.b_bytes[i]) for i in b])]).astype(int)
        links, j = [], 0
        for i in range(len(a)):
            while span_b[j + 1] <= span_a[i]:
                j += 1
            k = j
            while k < len(b) and span_b[k] < span_a[i + 1]:
                links.append((i, k))
                k += 1
        groups, x, y = [], 0, 0
        for end in sorted(set(span_a[1:].tolist()) & set(span_b[1:].tolist())):
            p, q = int(np.searchsorted(span_a, end)), int(np.searchsorted(span_b, end))
            groups.append((a[x:p], b[y:q]))
            x, y = p, q
        out.append((a, b, links, groups))
    return out


def check_alignment(rows, out):
    """rows: (doc_id, text)."""
    both = tokenalign.Tokenizers(A, B)
    aligned = plain_alignment([t for _, t in rows], both)
    counts = collections.Counter()
    for a, b, links, _ in aligned:
        counts.update({(a[i], b[j]) for i, j in links})
    best = collections.Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    want = []
    for (doc_id, _), (a, b, links, groups) in zip(rows, aligned):
        pairs = [(a[i], b[j]) for i, j in links]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        want.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in pairs),
                     sum(counts[p] for p in pairs), brute.sha(text) if a else ""))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[n] for n in names)) for r in out)


ODD_TEXTS = ["<|endoftext|> and <s> </s> <unk> <0x0A>", "▁ low block", "tab\tand  two   spaces \n\n", " leading", "日本語のテキスト",
             "😀😀👍🏽 emoji", "a\x00b", "ﬁ ligature ｆｕｌｌ", "é combining", " nbsp ​ zero width", "x", "1234567890" * 5,
             "ÀÉÎ straße", "the the the the", "\r\n", "ab" * 300, "﻿bom"]


@pytest.mark.parametrize("limits", [{}, {"chunk_chars": 300, "slice_chars": 50}])
def test_alignment_digests(spark, edge_docs, no_docs, limits):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check_alignment(rows, tokenalign.alignment_digests(edge_docs, A, B, **limits).collect())
    odd = [(10**17 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, t) for t in ODD_TEXTS[:4]] + [(None, None)]
    docs = spark.createDataFrame(odd, "doc_id long, text string").repartition(3)
    check_alignment(odd, tokenalign.alignment_digests(docs, A, B, **limits).collect())
    if not limits:
        assert tokenalign.alignment_digests(no_docs, A, B).count() == 0


def test_some_texts_have_no_tokens():
    both = tokenalign.Tokenizers(A, B)
    tokens = dict(zip([None, "", *ODD_TEXTS], both.encode([None, "", *ODD_TEXTS])))
    assert [t for t, (a, _) in tokens.items() if not a] == [None, "", "▁ low block"]


def test_links_and_groups_as_rows(spark):
    texts = ["Tokenization of unbelievable words, 日本語 and 😀.", "", "plain words only", "aaaa bbbb <|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    both = tokenalign.Tokenizers(A, B)
    for (a, b, links, groups), r in zip(plain_alignment(texts, both),
                                        tokenalign.align_tokens(docs, A, B, shared_groups=True).orderBy("doc_id").collect()):
        assert (r["a_ids"], r["b_ids"]) == (a, b) and list(zip(r["link_a"], r["link_b"])) == links
        assert sum(r["link_bytes"]) == sum(len(both.a_bytes[i]) for i in a)
        assert sorted(set(r["group_a"])) == list(range(len(groups))) == sorted(set(r["group_b"]))
        for g, (p, q) in enumerate(groups):
            assert [i for i, n in zip(a, r["group_a"]) if n == g] == p and [i for i, n in zip(b, r["group_b"]) if n == g] == q
        want = {(i, j) for i, m in enumerate(r["group_a"]) for j, n in enumerate(r["group_b"]) if m == n}
        assert set(zip(r["shared_a"], r["shared_b"])) == want and len(r["shared_a"]) == len(want)


def test_alignment_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check_alignment(rows, queries.op11_token_alignment(spark, SF_SMALL).collect())
