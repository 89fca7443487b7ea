"""Substring dedup: suffix automata of reference shards, and matching statistics of the documents against them.

A window is ``size`` consecutive words of one document; it is a repeat if its
words also start earlier (a smaller doc_id, or earlier in the document). Every
word under a repeat is removed. The corpus is its own reference, so the work
is first narrowed without losing a window:

1. Anchors. Among the runs of ``gram`` words inside a window the one with the
   least hash is its anchor. Equal windows have equal anchors, so a window
   whose anchor hash occurs once in the corpus is no repeat. About one word in
   six is an anchor; only their hashes are shuffled, once per document.
2. Routing. The remaining windows are hashed whole; the first occurrence of
   each hash names the reference run that a later one must be held against.
3. Automata. Reference runs are dealt to shards of bounded size. A shard's
   suffix automaton over its words is built and sent to the tasks that hold
   runs routed to the shard; a shard with many of them is sent to several
   tasks (salts), each with a bounded number of words.
4. Matching statistics. Each run is streamed through its automaton; where the
   longest match reaches ``size`` words, the state of the last ``size`` words
   knows where they first ended. Windows that began earlier are marked, and
   overlapping ones join to maximal spans.

Hashes only choose what is compared; a span is removed on equal words alone.

Defined cases: a null text has no words; texts shorter than a window keep all
words; rows with a null doc_id take no part and keep all words; rows that
repeat a doc_id with the same text are one document (equal positions are not earlier
ones), with different texts they are documents of their own, in the order of a hash of their texts; an
empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BOOL, INT, LONG, STRING, WORD, fresh, rolling, save, schema, word_hashes, word_spans

WORDS = re.compile(WORD)
#: Windows that start in [c * CELL, (c + 1) * CELL) belong to cell c of their document.
CELL = 2048


def _chunks(texts: list[str], chars: int = 1_000_000):
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield at, i + 1
            at, size = i + 1, 0


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each word, hash of each word, index of each text's first word)."""
    raw = [t.encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    start, end = word_spans(data)
    doc = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), start, side="right")
    return doc, word_hashes(data, start, end), np.searchsorted(doc, np.arange(len(texts)))


def window_anchors(doc: np.ndarray, h: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each window inside one text, position of its anchor, hash of every run of ``gram`` words)."""
    grams = rolling(h, gram)
    if len(h) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    start = np.flatnonzero(doc[:len(h) - size + 1] == doc[size - 1:])
    width = size - gram + 1
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    anchor = np.empty(len(start), np.int64)
    for lo in range(0, len(start), 1 << 16):  # bounded copies
        part = start[lo:lo + (1 << 16)]
        anchor[lo:lo + (1 << 16)] = part + view[part].argmin(axis=1)
    return start, anchor, grams


def _once(value: np.ndarray, *where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries (value, where...): the index of the first of each distinct one, and whether there are several."""
    order = np.lexsort((*where[::-1], value))
    new = np.ones(len(order), bool)
    new[1:] = value[order][1:] != value[order][:-1]
    for w in where:
        new[1:] |= w[order][1:] != w[order][:-1]
    head = np.flatnonzero(new)
    return order[head], np.diff(np.concatenate([head, [len(order)]])) > 1


def _anchor_rows(size: int, gram: int):
    """(anchor, doc_id, several) once per anchor hash of a document; several: at more than one place of it."""
    def run(batches):
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in _chunks(texts):
                doc, h, _ = _hashed(texts[lo:hi])
                _, anchor, grams = window_anchors(doc, h, size, gram)
                at = np.unique(anchor)
                one, several = _once(grams[at], doc[at])
                at = at[one]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].astype(np.int64)), pa.array(ids[lo:hi][doc[at]]), pa.array(several)],
                    ["anchor", "doc_id", "several"])
    return run


def _runs(size: int, gram: int):
    """(doc_id, tkey, cell, start, n_windows, text of the words) of every run of windows with a repeated anchor."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            marked, tkeys = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for lo, hi in _chunks(texts):
                doc, h, first = _hashed(texts[lo:hi])
                start, anchor, grams = window_anchors(doc, h, size, gram)
                value, edge = grams[anchor].astype(np.int64), np.searchsorted(doc[start], np.arange(hi - lo + 1))
                hot = np.zeros(len(start), bool)
                for i, m in enumerate(marked[lo:hi]):
                    part = slice(edge[i], edge[i + 1])
                    hot[part] = np.isin(value[part], np.array(m, np.int64))
                start = start[hot]
                if not len(start):
                    continue
                local = start - first[doc[start]]
                new = np.concatenate([[True], (np.diff(start) != 1) | (np.diff(doc[start]) != 0)
                                      | (np.diff(local // CELL) != 0)])
                head = np.flatnonzero(new)
                count = np.diff(np.concatenate([head, [len(start)]]))
                out = []
                words, of = [], -1
                for k, n in zip(head, count):
                    d = int(doc[start[k]])
                    if d != of:
                        words, of = WORDS.findall(texts[lo + d]), d
                    s = int(local[k])
                    out.append((ids[lo + d], tkeys[lo + d], s // CELL, s, int(n), " ".join(words[s:s + int(n) + size - 1])))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.string())],
                    ["doc_id", "tkey", "cell", "start", "windows", "words"])
    return run


def _window_rows(size: int):
    """(hash, doc_id, tkey, start, several) once per window hash of the run at start; several: at more than one place of it."""
    def run(batches):
        for batch in batches:
            ids, starts = np.array(batch.column(0).to_pylist(), np.int64), np.array(batch.column(1).to_pylist(), np.int64)
            texts, tkeys = batch.column(2).to_pylist(), np.array(batch.column(3).to_pylist(), np.int64)
            for lo, hi in _chunks(texts):
                doc, h, first = _hashed(texts[lo:hi])
                if len(h) < size:
                    continue
                at = np.flatnonzero(doc[:len(h) - size + 1] == doc[size - 1:])
                value = rolling(h, size)[at]
                one, several = _once(value, doc[at])
                d = doc[at][one]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[one].astype(np.int64)), pa.array(ids[lo:hi][d]), pa.array(tkeys[lo:hi][d]),
                     pa.array(starts[lo:hi][d].astype(np.int32)), pa.array(several)],
                    ["hash", "doc_id", "tkey", "start", "several"])
    return run


class SuffixAutomaton:
    """Of several word sequences, given in order; each state knows where its strings first end.

    A document is any value that compares in the order of the sequences.
    """

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [(-1, -1)]

    def _state(self, step: dict[str, int], link: int, length: int, first: tuple[int, int]) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, word: str, q: int) -> int:
        """A copy of q for the shorter strings that reach it from p on."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: list[str], doc, start: int) -> None:
        last = 0
        for i, word in enumerate(words):
            p, q = last, self.next[last].get(word)
            if q is not None:  # this prefix is known from an earlier sequence
                last = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
                continue
            last = self._state({}, 0, self.length[p] + 1, (doc, start + i))
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = last
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)

    def repeats(self, words: list[str], doc, start: int, size: int) -> list[tuple[int, int]]:
        """Maximal spans [from, to) of words under windows that end earlier in a known sequence."""
        step, link, length, first = self.next, self.link, self.length, self.first
        spans: list[list[int]] = []
        v = matched = 0
        for i, word in enumerate(words):
            while v and word not in step[v]:
                v = link[v]
                matched = length[v]
            v = step[v].get(word, 0)
            matched = matched + 1 if v else 0
            if matched < size:
                continue
            while length[link[v]] >= size:  # to the state of the last ``size`` words
                v = link[v]
            matched = min(matched, length[v])
            end = start + i
            if first[v] < (doc, end):
                lo = end - size + 1
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = end + 1
                else:
                    spans.append([lo, end + 1])
        return [tuple(s) for s in spans]


def _match(size: int):
    def run(reference: pd.DataFrame, stream: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(reference) and len(stream):
            automaton = SuffixAutomaton()
            place = ["doc_id", "tkey", "start"]
            reference = reference.drop_duplicates(place).sort_values(place)
            for i, t, s, w in zip(*[reference[c].tolist() for c in [*place, "words"]]):
                automaton.add(w.split(" "), (i, t), s)
            for i, t, s, w in zip(*[stream[c].tolist() for c in [*place, "words"]]):
                out += [(i, t, lo, hi) for lo, hi in automaton.repeats(w.split(" "), (i, t), s, size)]
        return pd.DataFrame(out, columns=["doc_id", "tkey", "lo", "hi"]).astype(
            {"doc_id": "int64", "tkey": "int64", "lo": "int32", "hi": "int32"})
    return run


def candidate_texts(docs: DataFrame, *, size: int, gram: int) -> DataFrame:
    """(doc_id, text, anchors) of the documents that hold an anchor which occurs twice in the corpus.

    ``anchors`` are those of all texts under the doc_id, so none of its own is missing.
    """
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    anchors = rows.mapInArrow(_anchor_rows(size, gram), schema(anchor=LONG, doc_id=LONG, several=BOOL))
    again = (anchors.withColumn("n", F.count("*").over(Window.partitionBy("anchor"))).where("n > 1 OR several")
             .groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors")))
    return rows.join(again, "doc_id")


def repeated_spans(candidates: DataFrame, *, size: int = 20, gram: int = 10, shard_words: int = 60_000,
                   task_words: int = 400_000) -> DataFrame:
    """(doc_id, tkey, lo, hi): spans of words, possibly touching, that cover exactly the words to remove.

    ``tkey``, a hash of the text, tells apart texts that share a doc_id.
    """
    runs = save(candidates.select("doc_id", "text", "anchors", F.xxhash64("text").alias("tkey")).mapInArrow(
        _runs(size, gram), schema(doc_id=LONG, tkey=LONG, cell=INT, start=INT, windows=INT, words=STRING)), "sub-runs")
    windows = runs.select("doc_id", "start", "words", "tkey").mapInArrow(
        _window_rows(size), schema(hash=LONG, doc_id=LONG, tkey=LONG, start=INT, several=BOOL))
    cell = lambda c: F.floor(F.col(c) / CELL).cast("int")
    first = F.min(F.struct("doc_id", "tkey", "start")).over(Window.partitionBy("hash"))
    here, there = F.struct("doc_id", "tkey", "start"), F.struct("f.doc_id", "f.tkey", "f.start")
    # the run of a hash's first occurrence is its reference, also for a second one in the same run
    routes = (windows.withColumn("f", first).where(F.col("several") | (here != there))
              .select("doc_id", "tkey", cell("start").alias("cell"), F.col("f.doc_id").alias("ref_doc"),
                      F.col("f.tkey").alias("ref_key"), cell("f.start").alias("ref_cell")).distinct())
    routes = save(routes, "sub-routes")
    of = ["doc_id", "tkey", "cell"]
    wanted = routes.select(*[F.col(r).alias(c) for r, c in zip(("ref_doc", "ref_key", "ref_cell"), of)]).distinct()
    reference = runs.join(wanted, of, "left_semi")
    words = reference.agg(F.sum(F.col("windows") + size - 1).alias("n")).first()["n"] or 0
    shards = max(1, -(-words // shard_words))
    shard = lambda *c: F.pmod(F.xxhash64(*c), F.lit(shards)).alias("shard")
    routed = routes.select(*of, shard("ref_doc", "ref_key", "ref_cell")).distinct()
    streams = routed.join(runs, of)
    load = (routed.join(runs.groupBy(*of).agg(F.sum(F.col("windows") + size - 1).alias("n")), of)
            .groupBy("shard").agg(F.ceil(F.sum("n") / task_words).alias("salts")))
    load = save(load, "sub-load")
    streams = streams.join(load, "shard").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "tkey", "start", "cell"), "salts"))
    sent = (reference.withColumn("shard", shard(*of)).join(load, "shard")
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))))
    keep = ["shard", "salt", "doc_id", "tkey", "start", "words"]
    sent = sent.select(*[F.col(c).alias(c) for c in keep])  # columns of its own: both sides come from the same runs
    return (sent.groupBy("shard", "salt").cogroup(streams.select(*keep).groupBy("shard", "salt"))
            .applyInPandas(_match(size), schema(doc_id=LONG, tkey=LONG, lo=INT, hi=INT)))


def _kept(text: str, spans) -> tuple[list[str], int]:
    words = WORDS.findall(text)
    if spans is None or not len(spans):
        return words, 0
    gone = np.zeros(len(words), bool)
    for s in spans:
        gone[s["lo"]:s["hi"]] = True
    return [w for w, g in zip(words, gone) if not g], int(gone.sum())


_SPANS = T.ArrayType(T.StructType([T.StructField("lo", INT), T.StructField("hi", INT)]))


def _spans_by_document(spans: DataFrame) -> DataFrame:
    return spans.distinct().groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _digest(batches):
    for batch in batches:
        texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        n, removed, sha = [], [], []
        for t, s in zip(texts, spans):
            words, gone = _kept(t or "", s)
            n.append(len(words) + gone)
            removed.append(gone)
            sha.append(hashlib.sha256(" ".join(words).encode("utf-8")).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "tkey", "n_words", "n_removed", "kept_sha256"])


_DIGEST = schema(doc_id=LONG, tkey=LONG, n_words=LONG, n_removed=LONG, kept_sha256=STRING)


def removal_digests(docs: DataFrame, *, size: int = 20, gram: int = 10) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) of every row.

    Texts are shuffled once, to meet their repeated anchors; documents without any are digested where they lie.
    """
    candidates = save(candidate_texts(docs, size=size, gram=gram), "sub-candidates")
    spans = _spans_by_document(repeated_spans(candidates, size=size, gram=gram))
    tkey = F.xxhash64("text").alias("tkey")
    changed = (candidates.select("doc_id", "text", tkey).distinct().join(spans, ["doc_id", "tkey"])
               .select("doc_id", "text", "spans", "tkey").mapInArrow(_digest, _DIGEST))
    changed = changed.select(*[F.col(c).alias(f"_{c}") for c in _DIGEST.names])
    whole = docs.select("doc_id", "text", F.lit(None).cast(_SPANS).alias("spans"), tkey).mapInArrow(_digest, _DIGEST)
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col("tkey") == F.col("_tkey"))
    return whole.join(changed, same, "left").select(
        "doc_id", "n_words", F.coalesce("_n_removed", "n_removed").alias("n_removed"),
        F.coalesce("_kept_sha256", "kept_sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, *, size: int = 20, gram: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns kept, with repeats removed from ``text`` (kept words joined by one space).

    Texts without a repeat stay as they are. ``n_chars``, if it is a column, follows the new text.
    """
    candidates = save(candidate_texts(docs, size=size, gram=gram), "sub-candidates")
    key, tkey, found = fresh(docs, "id"), fresh(docs, "tkey"), fresh(docs, "spans")
    spans = (_spans_by_document(repeated_spans(candidates, size=size, gram=gram))
             .select(F.col("doc_id").alias(key), F.col("tkey").alias(tkey), F.col("spans").alias(found)))

    @F.pandas_udf(STRING)
    def kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else " ".join(_kept(t, s)[0]) for t, s in zip(texts, spans)], dtype=object)

    # at most one row of spans per document and text: matching rows are neither lost nor repeated
    out = docs.join(spans, (F.col("doc_id") == F.col(key)) & (F.xxhash64("text") == F.col(tkey)), "left")
    out = out.withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(kept(F.col("text"), F.col(found))))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text")).cast(kind))
    return out.select(*docs.columns)
