"""Exact duplicates by Patricia tries that own the texts of a length and content hash.

Texts are equal when they are identical after every run of ASCII white space
has become one space. Two kinds of tries decide this on full byte strings:

1. Chunk tries. A task inserts the texts of ``chunk_bytes`` at a time; equal
   texts of a chunk end in one terminal node and become one *entry* with their
   count and smallest identifier. So a text that fills a third of the table
   is shuffled once per chunk, not once per row.
2. Owner tries. Entries are partitioned by (length, content hash); a partition
   inserts them into its trie, whose terminal nodes keep the smallest
   identifier and the count over all chunks.

Where more than ``hot_entries`` entries share a length and hash, they are first
spread over several owners, which pass their few terminals on to the next
round. A trie that outgrows ``trie_bytes`` spills by subtree: the terminals of
its heaviest subtrees go to the next round, a marker stays in their place, and
texts that reach the marker follow them. Rounds are tables in the shared folder; every round settles at
least one text per partition, and one round is the usual number. Hashes only
choose the owner: texts of equal hash are still told apart by their bytes.

Of a group of equal texts the row with the smallest doc_id stays.

Defined cases: a null text counts as empty; a text of white space only is one
space, which differs from the empty text; rows with a null doc_id come after
all others, so they stay only where the whole group has none (keep_id is null
then); of rows equal in doc_id and normalised text exactly one stays, any of
them; an empty table gives an empty result; extra columns, whatever their
names, are carried by ``drop_exact_duplicates`` and ignored otherwise.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, INT, LONG, save, schema

#: A run of white space that is not already one space.
UNEVEN_SPACE = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
NODE_BYTES = 300  # what a node costs besides its label
TASK_BITS = 36    # numbers of rows and entries inside one task

DONE, LINK, AGAIN = 0, 1, 2


class Node:
    __slots__ = ("label", "kids", "held", "spilled")

    def __init__(self, label: bytes):
        self.label, self.kids, self.held, self.spilled = label, None, None, False


def shared_prefix(key: bytes, at: int, label: bytes) -> int:
    """Length of the common prefix of ``key[at:]`` and ``label``."""
    low, high = 0, min(len(label), len(key) - at)
    step = 32
    while low < high:  # doubling, then halving
        mid = min(low + step, high)
        if key[at + low:at + mid] == label[low:mid]:
            low, step = mid, step * 2
        elif mid - low == 1:
            return low
        else:
            high, step = mid - 1, max(1, (mid - low) // 2)
    return low


class Patricia:
    """A compressed radix trie over byte strings. A terminal node holds whatever the caller puts in ``held``."""

    def __init__(self):
        self.root, self.size = Node(b""), NODE_BYTES

    def place(self, key: bytes) -> Node | None:
        """The node at which ``key`` ends, made if need be; None where its subtree has been spilled."""
        node, at = self.root, 0
        while at < len(key):
            if node.kids is None:
                node.kids = {}
            kid = node.kids.get(key[at])
            if kid is None:
                kid = node.kids[key[at]] = Node(key[at:])
                self.size += NODE_BYTES + len(kid.label)
                return kid
            if key.startswith(kid.label, at):
                if kid.spilled:
                    return None
                at += len(kid.label)
                node = kid
                continue
            same = shared_prefix(key, at, kid.label)
            fork = node.kids[key[at]] = Node(kid.label[:same])
            kid.label = kid.label[same:]
            fork.kids = {kid.label[0]: kid}
            self.size += NODE_BYTES
            at += same
            node = fork
        return node

    def terminals(self, node: Node | None = None, prefix: bytes = b""):
        """(key, held) of every terminal below ``node``, itself included; ``prefix`` ends before its label."""
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label if node.label else prefix
            if node.held is not None:
                yield key, node.held
            if node.kids:
                stack.extend((kid, key) for kid in node.kids.values())

    def _weights(self) -> dict[int, int]:
        order, weight = [self.root], {}
        for node in order:
            order.extend((node.kids or {}).values())
        for node in reversed(order):
            weight[id(node)] = (NODE_BYTES + len(node.label)
                                + sum(weight[id(k)] for k in (node.kids or {}).values()))
        return weight

    def spill(self):
        """Take the heaviest subtrees out, at least half of the bytes where the shape allows it; their terminals.

        From the root, the walk follows a child that holds over half of all
        bytes; where it ends, whole children go, heaviest first, and at least
        one terminal stays in the trie.
        """
        weight = self._weights()
        node, prefix = self.root, b""
        while node.kids:
            heaviest = max(node.kids.values(), key=lambda k: weight[id(k)])
            if heaviest.spilled or 2 * weight[id(heaviest)] <= weight[id(self.root)]:
                break
            prefix += node.label
            node = heaviest
        kids = sorted((k for k in (node.kids or {}).values() if not k.spilled), key=lambda k: -weight[id(k)])
        if node.held is None:
            kids = kids[:-1]  # the lightest child stays
        prefix += node.label
        freed = 0
        for kid in kids:
            if 2 * freed >= weight[id(self.root)]:
                break
            yield from self.terminals(kid, prefix)
            freed += weight[id(kid)]
            self.size += NODE_BYTES + 1 - weight[id(kid)]
            kid.kids = kid.held = None
            kid.label, kid.spilled = kid.label[:1], True


def _chunk_run(chunk_bytes: int, chunk_rows: int):
    """Arrow batches (part, doc_id, text, row) -> one row per document, the first of every entry with the entry's text."""
    def run(batches):
        rid = eid = 0
        ids, rows, entries, shas = [], [], [], []  # of the open chunk
        trie, held, carried = Patricia(), [], []
        size = 0

        def close():
            first = {h[0]: h for h in held}
            mine = [first.pop(e, None) for e in entries]  # the entry at its first row, None at the others
            columns = [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(shas, pa.binary()),
                       pa.array(entries, pa.int64())]
            columns += [pa.array([h and h[i] for h in mine], t) for i, t in
                        ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.int64()), (5, pa.int64()),
                         (6, pa.binary()))]
            names = ["doc_id", "rid", "sha", "eid", "low_id", "low_rid", "n", "length", "hash", "text"]
            if carried:
                columns.append(pa.concat_arrays(carried))
                names.append("row")
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            base = batch.column(0)[0].as_py() << TASK_BITS if batch.num_rows else 0
            at = 0
            carry = batch.column(3) if batch.num_columns > 3 else None
            for i, (doc_id, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                node = trie.place(text)
                if node.held is None:
                    sha = hashlib.sha256(text).digest()
                    node.held = [base + eid, None, None, 0, len(text), int.from_bytes(sha[:8], "little", signed=True),
                                 text, sha]
                    held.append(node.held)
                    eid += 1
                    size += len(text)
                h = node.held
                if h[2] is None or (doc_id is not None and (h[1] is None or doc_id < h[1])):
                    h[1], h[2] = doc_id, base + rid
                h[3] += 1
                ids.append(doc_id)
                rows.append(base + rid)
                entries.append(h[0])
                shas.append(h[7])
                rid += 1
                if size >= chunk_bytes or len(ids) >= chunk_rows:
                    if carry is not None:
                        carried.append(carry.slice(at, i + 1 - at))
                    yield close()
                    ids, rows, entries, shas = [], [], [], []
                    trie, held, carried, size, at = Patricia(), [], [], 0, i + 1
            if carry is not None and at < batch.num_rows:
                carried.append(carry.slice(at))
        if ids:
            yield close()
    return run


def _owner_run(trie_bytes: int):
    """Arrow batches of entries -> rows of kind DONE (eid, keep, n), LINK (eid -> rep) and AGAIN (an entry of the next round)."""
    names = ["kind", "eid", "rep", "low_id", "low_rid", "n", "length", "hash", "text"]
    types = [pa.int32(), *[pa.int64()] * 7, pa.binary()]

    def run(batches):
        trie, limit = Patricia(), trie_bytes
        out: list[tuple] = []
        waiting = 0

        def flush():
            columns = list(zip(*out)) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        def settle(key, held):
            """A terminal leaves the trie: for good, or for the next round."""
            low_id, low_rid, n, length, hashed, salted, eids = held
            if salted is False:
                out.extend((DONE, e, e, low_id, low_rid, n, None, None, None) for e in eids)
                return
            out.append((AGAIN, eids[0], None, low_id, low_rid, n, length, hashed, key))
            out.extend((LINK, e, eids[0], None, None, None, None, None, None) for e in eids)

        for batch in batches:
            for eid, low_id, low_rid, n, length, hashed, salted, text in zip(
                    *[batch.column(i).to_pylist() for i in range(8)]):
                node = trie.place(text)
                if node is None:  # its subtree has been spilled
                    settle(text, [low_id, low_rid, n, length, hashed, True, [eid]])
                    waiting += len(text)
                elif node.held is None:
                    node.held = [low_id, low_rid, n, length, hashed, salted, [eid]]
                else:
                    h = node.held
                    if low_id is not None and (h[0] is None or (low_id, low_rid) < (h[0], h[1])):
                        h[0], h[1] = low_id, low_rid
                    h[2] += n
                    h[5] = h[5] or salted
                    h[6].append(eid)
                if trie.size > limit:
                    for key, held in trie.spill():
                        held[5] = True
                        settle(key, held)
                        waiting += len(key)
                    limit = max(trie_bytes, 2 * trie.size)  # more only where lone texts are that long
                if waiting > trie_bytes // 4 or len(out) > 50_000:
                    yield flush()
                    out, waiting = [], 0
        for key, held in trie.terminals():
            settle(key, held)
            waiting += len(key) if held[5] else 0
            if waiting > trie_bytes // 4 or len(out) > 50_000:
                yield flush()
                out, waiting = [], 0
        if out:
            yield flush()
    return run


_ENTRY = schema(doc_id=LONG, rid=LONG, sha=BINARY, eid=LONG, low_id=LONG, low_rid=LONG, n=LONG, length=LONG, hash=LONG,
                text=BINARY)
_SETTLED = schema(kind=INT, eid=LONG, rep=LONG, low_id=LONG, low_rid=LONG, n=LONG, length=LONG, hash=LONG, text=BINARY)

#: Keys with too many entries are broadcast up to this number of them (20 bytes each); beyond it they are joined by a shuffle.
HOT_KEYS_BROADCAST = 200_000


def _salted(entries: DataFrame, hot_entries: int) -> DataFrame:
    """Entries with ``salt`` and ``salted``: those of a (length, hash) with too many entries are spread by their eid."""
    hot = (entries.groupBy("length", "hash").agg(F.count("*").alias("here")).where(F.col("here") > hot_entries)
           .select("length", "hash", F.ceil(F.col("here") / hot_entries).alias("ways")))
    hot = save(hot, "patricia-hot")
    keys = hot.count()
    if not keys:
        return entries.withColumn("salt", F.lit(0).cast("long")).withColumn("salted", F.lit(False))
    marked = entries.join(F.broadcast(hot) if keys <= HOT_KEYS_BROADCAST else hot, ["length", "hash"], "left")
    return (marked.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("eid"), F.col("ways")), F.lit(0)))
            .withColumn("salted", F.col("ways").isNotNull()).drop("ways"))


def _verdicts(entries: DataFrame, part_bytes: int, trie_bytes: int, hot_entries: int, max_rounds: int = 40) -> DataFrame:
    """(eid, keep_id, keep_rid, group_size) for every entry: owner rounds until nothing is passed on."""
    rounds = []
    for _ in range(max_rounds):
        total = entries.agg(F.sum(F.col("length") + 64)).first()[0] or 0
        parts = max(1, math.ceil(total / part_bytes))
        dealt = _salted(entries, hot_entries).repartition(parts, "length", "hash", "salt")
        out = save(dealt.select("eid", "low_id", "low_rid", "n", "length", "hash", "salted", "text")
                   .mapInArrow(_owner_run(trie_bytes), _SETTLED), "patricia-round")
        rounds.append(out)
        entries = out.where(F.col("kind") == AGAIN).select("eid", "low_id", "low_rid", "n", "length", "hash", "text")
        if entries.select("eid").isEmpty():
            break
    else:
        raise RuntimeError(f"exact duplicates: texts are still passed on after {max_rounds} rounds")
    verdict = None
    for out in reversed(rounds):
        done = out.where(F.col("kind") == DONE).select("eid", F.col("low_id").alias("keep_id"),
                                                       F.col("low_rid").alias("keep_rid"), F.col("n").alias("group_size"))
        if verdict is not None:  # an entry passed on gets what its representative got in the next round
            passed = out.where(F.col("kind") == LINK).select(F.col("eid").alias("from"), F.col("rep").alias("eid"))
            done = done.union(passed.join(verdict, "eid").select(F.col("from").alias("eid"), "keep_id", "keep_rid",
                                                                 "group_size"))
        verdict = done
    return verdict


def _classes(docs: DataFrame, carry: bool, chunk_bytes: int, chunk_rows: int, part_bytes: int, trie_bytes: int,
             hot_entries: int) -> DataFrame:
    """(doc_id, row if carried, keep_id, group_size, kept, text_sha256), one row per row of ``docs``."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), UNEVEN_SPACE, " ").cast("binary")
    columns = [F.spark_partition_id().cast("long").alias("part"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")]
    out = _ENTRY
    if carry:
        columns.append(F.struct("*").alias("row"))
        out = T.StructType([*_ENTRY, T.StructField("row", docs.schema)])
    rows = save(docs.select(*columns).mapInArrow(_chunk_run(chunk_bytes, chunk_rows), out), "patricia-entries")
    entries = rows.where(F.col("text").isNotNull()).select("eid", "low_id", "low_rid", "n", "length", "hash", "text")
    members = rows.select("doc_id", "rid", "sha", "eid", *(["row"] if carry else []))
    return (members.join(_verdicts(entries, part_bytes, trie_bytes, hot_entries), "eid")
            .select("doc_id", *(["row"] if carry else []), "keep_id", "group_size",
                    (F.col("rid") == F.col("keep_rid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))


def exact_duplicates(docs: DataFrame, *, chunk_bytes: int = 16 << 20, chunk_rows: int = 50_000, part_bytes: int = 16 << 20,
                     trie_bytes: int = 96 << 20, hot_entries: int = 2_000) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``."""
    return _classes(docs, False, chunk_bytes, chunk_rows, part_bytes, trie_bytes, hot_entries)


def drop_exact_duplicates(docs: DataFrame, *, chunk_bytes: int = 16 << 20, chunk_rows: int = 50_000,
                          part_bytes: int = 16 << 20, trie_bytes: int = 96 << 20, hot_entries: int = 2_000) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each group of equal texts."""
    kept = _classes(docs, True, chunk_bytes, chunk_rows, part_bytes, trie_bytes, hot_entries).where("kept")
    return kept.select("row.*")
