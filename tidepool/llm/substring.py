"""Substring dedup with suffix automata (operator 2).

A span is removed where a document repeats ``span`` consecutive words that also
stand in a document of smaller id.

1. Every window of ``span`` words gets an anchor: the smallest hash of its runs
   of ``ANCHOR`` words.  Equal windows have equal anchors, and neighbours mostly
   share theirs, so about a fifth as many anchors as words are counted.  Anchors of two
   documents or more are repeated; only windows with such an anchor go on.
2. Neighbouring windows of one repeated anchor, ``span`` at most, form a passage, the
   words of all of them.  A task that extracts a passage again sends it on only under a
   smaller id (copies hardly meet).  Windows of an anchor with over ``HEAVY`` passages
   become passages of their own, routed by their own hash, so no route holds more than that.
3. Passages are dealt by route.  A task gathers whole routes up to
   ``SHARD_WORDS`` words, builds the suffix automaton of that reference shard
   over words, each state with the smallest id that its sequences stand in, and
   streams the shard's passages through it.  The matching statistics give, at
   each place, the longest match; where it reaches ``span`` the state of the
   last ``span`` words tells the smallest id that holds them.
4. Spans are joined back to all documents with the passage; a word goes if a window
   over it has a smaller id than the document's.

The automata hold words, not hashes; hashes only route, and name passages (128
bits).  A shard's automaton stays in its task, and every document's passages
come to the shards that can match them, so shards grow with the input and none is
sent to all tasks.

Null or empty texts, or fewer words than a span: nothing removed.  Rows with a null
id are left out.  Rows that repeat an id never remove from each other; each is judged on
its own text, and the result has a row for each.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import words as W
from tidepool.llm.common import scratch, stored

ANCHOR = 5
HEAVY = 4000
SHARD_WORDS = 40_000
#: Passages that a task remembers having sent on.
SENT = 200_000


class Automaton:
    """Suffix automaton of many word sequences, each with a document id."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.len = [0]
        self.doc: list[int] = [1 << 62]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.len.append(length)
        self.doc.append(1 << 62)
        return len(self.len) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The part of state ``q`` that ``p`` leads to, as a state of its own."""
        nxt, link, ln = self.next, self.link, self.len
        part = self._state(ln[p] + 1, link[q], dict(nxt[q]))
        link[q] = part
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = part
            p = link[p]
        return part

    def add(self, words: list, doc: int) -> None:
        nxt, link, ln = self.next, self.link, self.len
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:  # the sequence so far is known
                last = q if ln[q] == ln[last] + 1 else self._split(last, w, q)
            else:
                p, last = last, self._state(ln[last] + 1, 0, {})
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = last
                    p = link[p]
                if p >= 0:
                    q = nxt[p][w]
                    link[last] = q if ln[q] == ln[p] + 1 else self._split(p, w, q)
            if doc < self.doc[last]:
                self.doc[last] = doc

    def finish(self) -> None:
        """Smallest ids from every state to its suffixes' states."""
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            u = self.link[v]
            if self.doc[v] < self.doc[u]:
                self.doc[u] = self.doc[v]

    def first_docs(self, words: list, span: int) -> list[int]:
        """For every window of ``span`` words, the smallest id that holds it."""
        nxt, link, ln = self.next, self.link, self.len
        out = []
        v = size = 0
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                size = ln[v]
            q = nxt[v].get(w)
            if q is not None:
                v, size = q, size + 1
            while v and ln[link[v]] >= span:  # the state of the last ``span`` words
                v = link[v]
                size = ln[v]
            if i >= span - 1:
                out.append(self.doc[v] if size >= span else 1 << 62)
        return out


def _anchors(hashes: np.ndarray, span: int) -> np.ndarray:
    """The anchor of every window of the batch's words (of one text or not)."""
    grams = W.windows(hashes, ANCHOR)
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    low = grams[:n].copy()
    for i in range(1, span - ANCHOR + 1):
        np.minimum(low, grams[i : i + n], out=low)
    return low


def _texts(w: W.Words, n: int, span: int):
    """Each text's place, first word and number of windows."""
    for i in range(n):
        a, b = int(w.first[i]), int(w.first[i + 1])
        yield i, a, max(0, b - a - span + 1)


def _cut(opens: np.ndarray, span: int) -> np.ndarray:
    """Where passages begin: at each opening, and after each ``span`` windows of a run."""
    at = np.arange(len(opens))
    return (at - np.maximum.accumulate(np.where(opens, at, 0))) % span == 0


def anchors(rows: DataFrame, span: int) -> DataFrame:
    """``(anchor, id)``: a row for each passage that each text's anchors make."""

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.words(part.column(1))
                low = _anchors(w.hash, span)
                ids = part.column(0).to_numpy()
                first = w.first[:-1]
                counts = np.maximum(np.diff(w.first) - span + 1, 0)
                # Windows that lie in one text, and of those the ones that open a run.
                text = np.repeat(np.arange(len(ids)), counts)
                at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[text]
                mine = low[at]
                opens = np.ones(len(mine), bool)
                opens[1:] = (mine[1:] != mine[:-1]) | (text[1:] != text[:-1])
                opens = _cut(opens, span)
                yield pa.record_batch([pa.array(mine[opens].view(np.int64)), pa.array(ids[text[opens]])], ["anchor", "id"])

    return rows.mapInArrow(run, "anchor long, id long")


def _passages(docs: DataFrame, span: int) -> DataFrame:
    """``(id, mark, start, route, key, passage)`` of documents with their repeated anchors;
    the passage is null where the task has sent it on under an id as small."""

    def run(batches):
        sent: dict[bytes, int] = {}
        for batch in batches:
            for part in W.slices(batch, "text"):
                w = W.words(part.column(1))
                low = _anchors(w.hash, span).view(np.int64)
                whole = W.windows(w.hash, span).view(np.int64)
                ids, hits, marks = part.column(0).to_pylist(), part.column(2), part.column(3).to_pylist()
                out: list[list] = [[], [], [], [], [], []]
                for i, a, n in _texts(w, part.num_rows, span):
                    if not n or not hits[i].is_valid:
                        continue
                    known = np.array(hits[i].values.field(0).to_numpy())
                    heavy = np.array(hits[i].values.field(1).to_numpy(zero_copy_only=False))
                    order = np.argsort(known)
                    known, heavy = known[order], heavy[order]
                    mine = low[a : a + n]
                    at = np.searchsorted(known, mine).clip(max=len(known) - 1)
                    hit = known[at] == mine
                    big = hit & heavy[at]
                    opens = np.ones(n, bool)
                    opens[1:] = (mine[1:] != mine[:-1]) | big[1:]
                    starts = np.flatnonzero(_cut(opens, span))
                    stops = np.append(starts[1:], n)
                    text = w.data[w.start[a] : w.end[a + n + span - 2]].tobytes()
                    base = int(w.start[a])
                    for s, e in zip(starts[hit[starts]].tolist(), stops[hit[starts]].tolist()):
                        words = b" ".join(text[int(w.start[a + s]) - base : int(w.end[a + e + span - 2]) - base].split())
                        key = hashlib.blake2b(words, digest_size=16).digest()
                        new = sent.get(key, ids[i] + 1) > ids[i]
                        if new:
                            if len(sent) >= SENT:
                                sent.clear()
                            sent[key] = ids[i]
                        route = int(whole[a + s]) if big[s] else int(mine[s])
                        for column, x in zip(out, (ids[i], marks[i], s, route, key, words.decode() if new else None)):
                            column.append(x)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string())
                yield pa.record_batch([pa.array(x, kind) for x, kind in zip(out, kinds)], ["id", "mark", "start", "route", "key", "passage"])

    return docs.select("id", "text", "hits", "mark").mapInArrow(run, "id long, mark long, start int, route long, key binary, passage string")


def _first_docs(passages: DataFrame, span: int) -> DataFrame:
    """``(route, key, firsts)``: for each passage, the smallest id of each window."""

    def match(rows: list) -> pa.RecordBatch:
        automaton = Automaton()
        for _, _, words, doc in rows:
            automaton.add(words, doc)
        automaton.finish()
        firsts = [automaton.first_docs(words, span) for _, _, words, _ in rows]
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array(firsts, pa.list_(pa.int64()))], ["route", "key", "firsts"])

    def run(batches):
        shard: list = []
        size = 0
        for batch in batches:
            for route, key, text, doc in zip(*(c.to_pylist() for c in batch.columns)):
                if shard and shard[-1][:2] == [route, key]:  # of another task
                    shard[-1][3] = min(doc, shard[-1][3])
                    continue
                if size >= SHARD_WORDS and route != shard[-1][0]:
                    yield match(shard)
                    shard, size = [], 0
                words = text.split(" ")
                shard.append([route, key, words, doc])
                size += len(words)
        if shard:
            yield match(shard)

    dealt = passages.repartition("route").sortWithinPartitions("route", "key")
    return dealt.select("route", "key", "passage", "doc").mapInArrow(run, "route long, key binary, firsts array<long>")


def _kept(rows: DataFrame, span: int) -> DataFrame:
    """``(id, n_words, n_removed, kept)`` of documents with their removed windows."""

    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                gone = part.column(2)
                n, removed, kept = [], [], []
                for i, text in enumerate(texts):
                    words = (text or b"").split()
                    n.append(len(words))
                    if gone[i].is_valid:
                        change = np.zeros(len(words) + 1, np.int64)
                        starts = np.unique(gone[i].values.to_numpy())
                        starts = starts[starts + span <= len(words)]
                        change[starts] += 1
                        change[starts + span] -= 1
                        stays = np.cumsum(change[:-1]) == 0
                        removed.append(int((~stays).sum()))
                        words = [w for w, s in zip(words, stays.tolist()) if s]
                    else:
                        removed.append(0)
                    kept.append(b" ".join(words).decode())
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])

    return rows.select("id", "text", "gone").mapInArrow(run, "id long, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, span: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_removed, kept)`` for every row with an id: its kept words,
    joined by one space."""
    spark = docs.sparkSession
    base = scratch(spark, "substring")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    marked = rows.withColumn("mark", F.xxhash64("text"))  # tells rows of one id apart
    found = anchors(rows, span)
    repeated = found.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo < hi")
    repeated = stored(repeated.select("anchor", (F.col("n") > HEAVY).alias("heavy")), f"{base}/repeated")
    hits = found.join(repeated, "anchor").groupBy("id").agg(F.collect_set(F.struct("anchor", "heavy")).alias("hits"))
    passages = stored(_passages(marked.join(hits, "id"), span), f"{base}/passages")
    sent = passages.filter("passage is not null").withColumnRenamed("id", "doc")
    firsts = stored(_first_docs(sent, span), f"{base}/firsts")
    back = passages.select("id", "mark", "start", "route", "key").join(firsts, ["route", "key"])
    gone = back.select("id", "mark", F.expr("transform(filter(transform(firsts, (d, i) -> struct(d as d, i as i)), x -> x.d < id), x -> start + x.i)").alias("gone"))
    gone = gone.filter("size(gone) > 0").groupBy("id", "mark").agg(F.flatten(F.collect_list("gone")).alias("gone"))
    return _kept(marked.join(gone, ["id", "mark"], "left"), span).withColumnRenamed("id", id_col)
