"""Rows that share a doc_id with other texts: near-dedup, substring dedup and the pipeline stages that use them."""

import collections
import random

import pytest

import brute
from zpoints.llm import probminhash, queries, substring

WORDS = ["".join(random.Random(i).choice("aeioubcdfglmnprst") for _ in range(3 + i % 6)) for i in range(700)]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """The five rows of three texts, copies and near copies under shared ids, and a third of all rows of one near-copy group."""
    rng = random.Random(11)
    a, b, c = (text(rng, 40) for _ in range(3))
    out = [(1, a), (1, b), (2, b), (3, c), (3, a)]
    base = text(rng, 200).split(" ")
    for i in range(60):  # near copies of one text, two rows to an id
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(200)] = rng.choice(WORDS)
        out.append((100 + i // 2, " ".join(w)))
    out += [(300 + i % 7, text(rng, 60)) for i in range(40)] + [(400, None), (400, ""), (401, "few words"), (402, "few words"), (402, "few words")]
    out += [(None, a), (None, a), (0, text(rng, 15) + " " + " ".join(base[40:120]))]
    return out


def documents(rows):
    """The distinct (doc_id, text) with an id, in order."""
    return sorted({(i, t or "") for i, t in rows if i is not None})


def near_classes(rows, least=0.8):
    docs = documents(rows)
    sets = [brute.shingles(t) for _, t in docs]
    links = [(m, n) for n in range(len(docs)) for m in range(n)
             if docs[m][1] == docs[n][1] and sets[m] or (sets[m] and sets[n] and len(sets[m] & sets[n]) >= least * len(sets[m] | sets[n]))]
    comp = brute.components(range(len(docs)), links)
    return {docs[n]: docs[comp[n]][0] for n in range(len(docs))}, {docs[n]: comp[n] for n in range(len(docs))}


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates_of_repeated_ids(spark, rows, block):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ids, comp = near_classes(rows)
    got = collections.Counter((r["doc_id"], r["class_id"]) for r in probminhash.near_duplicates(docs, block=block).collect())
    assert got == collections.Counter((i, ids[i, t or ""] if i is not None else None) for i, t in rows)
    kept = probminhash.drop_near_duplicates(docs, block=block).collect()
    left = {(r["doc_id"], r["text"] or "") for r in kept if r["doc_id"] is not None}
    assert sum(r["doc_id"] is None for r in kept) == 2
    # exactly one document of every class stays, under its least id
    assert sorted(comp[d] for d in left) == sorted(set(comp.values())) and all(ids[d] == d[0] for d in left)
    assert (3, rows[3][1]) in left


def test_substring_dedup_of_repeated_ids(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = substring.removal_digests(docs).collect()
    assert len(out) == len(rows)
    cut = substring.remove_repeats(docs)
    assert cut.count() == len(rows) and cut.schema == docs.schema
    by_id = collections.defaultdict(list)
    for r in cut.collect():
        by_id[r["doc_id"]].append(brute.words(r["text"]))
    a, b, c = (brute.words(rows[n][1]) for n in (0, 1, 3))
    assert sorted(by_id[1]) == sorted([a, b]) and by_id[2] == [[]] and sorted(by_id[3]) == sorted([c, []])
    # without shared ids the order of documents is that of ids alone
    single = {}
    for i, t in rows:
        if i is not None:
            single.setdefault(i, t)
    plain = brute.without_repeats(single)
    docs = spark.createDataFrame(list(single.items()), "doc_id long, text string").repartition(4)
    want = {(i, len(w), len(w) - len(k), brute.sha(" ".join(k))) for i, (w, k) in plain.items()}
    assert {tuple(r) for r in substring.removal_digests(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()} == want


def test_no_window_repeats_after_removal(spark, rows):
    """Every window that is left whole within what a document keeps is the first of its kind."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    left = [brute.words(r["text"]) for r in substring.remove_repeats(docs).where("doc_id IS NOT NULL").collect()]
    first = {tuple(w[s:s + 20]) for i, t in documents(rows) for w in [brute.words(t)] for s in range(len(w) - 19)}
    seen = collections.Counter(tuple(w[s:s + 20]) for w in left for s in range(len(w) - 19))
    assert first and all(n == 1 for k, n in seen.items() if k in first)


@pytest.mark.parametrize("name", ["op7_automata_dedup", "op10_probminhash"])
def test_registered_queries_on_the_smallest_table(spark, name):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.QUERIES[name](spark, sf).collect()
    if name.startswith("op7"):
        want = {(i, len(w), len(w) - len(k), brute.sha(" ".join(k))) for i, (w, k) in brute.without_repeats(texts).items()}
        assert {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out} == want
    else:
        want = brute.near_classes(texts)
        assert {(r["doc_id"], r["class_id"], r["kept"]) for r in out} == {(i, c, i == c) for i, c in want.items()}
