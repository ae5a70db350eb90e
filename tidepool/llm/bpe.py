"""BPE encoding and decoding (operator 4).

Texts are encoded as the ``tokenizers`` library does with a given tokenizer
file.  Text is cut at ASCII white space, which no pre-token crosses, and
repeated stretches are encoded once per Python worker (a cache of bounded
size); what is not in the cache goes to the library in one batch.

A long stretch without white space is not encoded in one go.  It is normalised
and split into pre-tokens, and a pre-token of over ``leaf_symbols`` symbols is
encoded by tree concatenation: its leaves are merged apart, in parallel tasks
for texts of over ``segment_bytes``, then neighbours are joined pairwise.  To
join, a window of k tokens on either side of the seam is merged anew, k = 2, 4,
8, ..., until the new tokens begin with the left window's first token and end
with the right window's last one.  Merges left and right of two such agreeing
tokens are then those of the whole, so the join is exact.

Texts of over ``segment_bytes`` become segments, cut at white space where there
is any, each a row of its own, so one very long text is spread over tasks; its
tokens are put together by (row, segment).

Nulls count as empty texts: no tokens, empty decoded text.  Rows are encoded one
by one, so repeated rows and null ids keep theirs; other columns are not read.
Empty tables give empty results.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import text_of

#: Symbols of a pre-token that are merged in one go at most.
LEAF = 1024
#: Bytes of a text that are encoded in one task at most.
SEGMENT = 1 << 18
#: Stretches in each of the two generations of a Python worker's cache at most.
CACHED = 300_000
#: Bytes of the texts that are looked up together, about.
TOGETHER = 1 << 20


class Bpe:
    """One tokenizer file in one Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.special = [t["content"] for t in model["added_tokens"]]
        model = model["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.cache: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.old: dict[bytes, tuple[int, bytes, bytes]] = {}

    # -- merging ---------------------------------------------------------
    def merge(self, symbols: list[str]) -> list[str]:
        """Merge neighbours, lowest rank first, leftmost first among equals."""
        n = len(symbols)
        left, right, part = list(range(-1, n - 1)), list(range(1, n + 1)), list(symbols)
        heap = [(r, i) for i in range(n - 1) if (r := self.rank.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if part[i] is None or j >= n or self.rank.get((part[i], part[j])) != r:
                continue  # one of the two has been merged since
            part[i] += part[j]
            part[j] = None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                if (x := self.rank.get((part[i], part[right[i]]))) is not None:
                    heapq.heappush(heap, (x, i))
            if left[i] >= 0 and (x := self.rank.get((part[left[i]], part[i]))) is not None:
                heapq.heappush(heap, (x, left[i]))
        return [p for p in part if p is not None]

    def symbols(self, tokens: list[str]) -> list[str]:
        """The single symbols of tokens; the word end stays with its symbol."""
        out: list[str] = []
        for t in tokens:
            ends = bool(self.suffix) and t.endswith(self.suffix)
            out.extend(t[: -len(self.suffix)] if ends else t)
            if ends:
                out[-1] += self.suffix
        return out

    def join(self, a: list[str], b: list[str]) -> list[str]:
        """Tokens of two neighbouring runs, as if merged in one."""
        if not a or not b:
            return a + b
        k = 2
        while True:
            x, y = a[-k:], b[:k]
            new = self.merge(self.symbols(x + y))
            whole_a, whole_b = k >= len(a), k >= len(b)
            if (whole_a or new[0] == x[0]) and (whole_b or new[-1] == y[-1]):
                return a[: len(a) - len(x)] + new + b[len(y) :]
            k *= 2

    def tree(self, runs: list[list[str]]) -> list[str]:
        """Join the tokens of neighbouring runs pairwise, level by level."""
        while len(runs) > 1:
            runs = [self.join(runs[i], runs[i + 1]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
        return runs[0] if runs else []

    # -- texts -----------------------------------------------------------
    def pre_tokens(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, pre-token) of a text, in the model's own alphabet."""
        while text:
            found = min(((text.find(s), s) for s in self.special if s in text), default=(len(text), ""))
            head, special = text[: found[0]], found[1]
            if head:
                for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(head)):
                    yield False, piece
            if special:
                yield True, special
            text = text[found[0] + len(special) :]

    def units(self, text: str, leaf: int) -> Iterator[tuple[str, bool]]:
        """Leaves of the pre-tokens of a long stretch: (symbols, whether the
        leaf goes on from the one before).  The last symbol of a pre-token
        carries the word end."""
        for special, piece in self.pre_tokens(text):
            if special:
                yield piece, False
                continue
            for i in range(0, len(piece), leaf):
                end = self.suffix if i + leaf >= len(piece) else ""
                yield piece[i : i + leaf] + end, i > 0

    def unit_tokens(self, unit: str) -> list[str]:
        return [unit] if unit in self.special else self.merge(self.symbols([unit]))

    def ids(self, tokens: list[str]) -> list[int]:
        ids = [self.tokenizer.token_to_id(t) for t in tokens]
        return [i for i in ids if i is not None]

    def long(self, text: str, leaf: int) -> list[int]:
        """Ids of a stretch without white space by tree concatenation."""
        out: list[str] = []
        runs: list[list[str]] = []
        for unit, goes_on in self.units(text, leaf):
            if not goes_on:
                out += self.tree(runs)
                runs = []
            runs.append(self.unit_tokens(unit))
        return self.ids(out + self.tree(runs))

    def entry(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        return len(ids), " ".join(map(str, ids)).encode(), " ".join(self.names[i] for i in ids).encode()

    def encode(self, text: bytes, leaf: int = LEAF) -> tuple[int, bytes, bytes]:
        """Number of tokens, decimal ids and tokens, both joined by spaces."""
        return self.encode_all([text], leaf)[0]

    def encode_all(self, texts: list[bytes], leaf: int = LEAF) -> list[tuple[int, bytes, bytes]]:
        """``encode`` of several texts; what none of them has in the cache goes to the
        library at once."""
        parts = [text.split() for text in texts]  # at ASCII white space
        known = self._known({p for some in parts for p in some}, leaf)
        out = []
        for some in parts:
            full = [f for f in map(known.__getitem__, some) if f[0]]
            out.append((sum([f[0] for f in full]), b" ".join([f[1] for f in full]), b" ".join([f[2] for f in full])))
        return out

    def _known(self, parts: set[bytes], leaf: int) -> dict[bytes, tuple[int, bytes, bytes]]:
        found, missing = {}, []
        for p in parts:
            held = self.cache.get(p)
            if held is None:
                held = self.old.get(p)
                if held is None:
                    missing.append(p)
                    continue
                self.cache[p] = held  # what is still in use comes back from the old generation
            found[p] = held
        short = [p for p in missing if len(p) <= leaf]
        for at in range(0, len(short), 10_000):
            some = short[at : at + 10_000]
            coded = self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
            for p, e in zip(some, coded):
                found[p] = held = self.entry(e.ids)
                if len(p) <= 64:
                    self.cache[p] = held
            if len(self.cache) > CACHED:
                self.old, self.cache = self.cache, {}
        found.update((p, self.entry(self.long(p.decode(), leaf))) for p in missing if len(p) > leaf)
        return found


_loaded: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """The tokenizer of this Python worker, read once."""
    if path not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[path] = Bpe(path)
    return _loaded[path]


SCHEMA = "n_tokens long, ids string, decoded string"


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``TOGETHER`` bytes of text, a row at least."""
    at, size = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if i > at and size + (n or 0) > TOGETHER:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n or 0
    if at < batch.num_rows:
        yield batch.slice(at)


def _short(rows: DataFrame, path: str, leaf: int) -> DataFrame:
    """``(id, n_tokens, ids, decoded)`` of texts that one task encodes."""

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch):
                out = bpe.encode_all([t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()], leaf)
                yield pa.record_batch(
                    [part.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1].decode() for o in out]), pa.array([o[2].decode() for o in out])],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    return rows.select("id", "text").mapInArrow(run, f"id long, {SCHEMA}")


def _long(rows: DataFrame, path: str, leaf: int, segment: int) -> DataFrame:
    """The same for longer texts: segments to leaves, leaves to tokens, tokens
    to texts."""

    def cut(batches):
        """Segments of a text: white-space stretches gathered up to ``segment``
        bytes, or leaves of a stretch longer than that."""
        bpe = loaded(path)
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, held, size = 0, [], 0
                for part in [*text.encode().split(), None]:
                    if held and (part is None or size + len(part) > segment):
                        yield _segment(row, n, b" ".join(held).decode(), 0)
                        n, held, size = n + 1, [], 0
                    if part is None:
                        break
                    if len(part) <= segment:
                        held.append(part)
                        size += len(part) + 1
                        continue
                    for unit, goes_on in bpe.units(part.decode(), max(leaf, segment // 16)):
                        yield _segment(row, n, unit, 2 if goes_on else 1)
                        n += 1
                if n == 0:
                    yield _segment(row, 0, "", 0)

    def _segment(row, n, text, kind):
        return pa.record_batch([pa.array([row], pa.string()), pa.array([n], pa.int64()), pa.array([text]), pa.array([kind], pa.int32())], ["row", "n", "text", "kind"])

    def encode(batches):
        bpe = loaded(path)
        for batch in batches:
            for row, n, text, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    count, ids, names = bpe.encode(text.encode(), leaf)
                    tokens = names.decode()
                else:
                    tokens = " ".join(bpe.tree([bpe.merge(s) for s in _cut(bpe.symbols([text]), leaf)]) if text not in bpe.special else [text])
                yield pa.record_batch([pa.array([row], pa.string()), pa.array([n], pa.int64()), pa.array([tokens]), pa.array([kind], pa.int32())], ["row", "n", "tokens", "kind"])

    def put_together(key, table):
        """One text's tokens; leaves of one pre-token are joined by the tree."""
        bpe = loaded(path)
        table = table.sort_by("n")
        out: list[str] = []
        runs: list[list[str]] = []
        for tokens, kind in zip(table["tokens"].to_pylist(), table["kind"].to_pylist()):
            if kind != 2:
                out += bpe.tree(runs)
                runs = []
            runs.append(tokens.split(" ") if tokens else [])
        out += bpe.tree(runs)
        count, ids, decoded = bpe.entry(bpe.ids(out))
        return pa.table({"row": [key[0].as_py()], "n_tokens": pa.array([count], pa.int64()), "ids": [ids.decode()], "decoded": [decoded.decode()]})

    # A text's content names its row, so a lost and repeated task names it alike.
    named = rows.withColumn("row", F.sha2("text", 256))
    segments = named.dropDuplicates(["row"]).select("row", "text").mapInArrow(cut, "row string, n long, text string, kind int")
    spread = segments.repartition(F.xxhash64("row", "n"))
    tokens = spread.mapInArrow(encode, "row string, n long, tokens string, kind int")
    whole = tokens.groupBy("row").applyInArrow(put_together, f"row string, {SCHEMA}")
    return named.select("id", "row").join(whole, "row").select("id", "n_tokens", "ids", "decoded")


def _cut(symbols: list[str], leaf: int) -> list[list[str]]:
    return [symbols[i : i + leaf] for i in range(0, len(symbols), leaf)]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf_symbols: int = LEAF, segment_bytes: int = SEGMENT) -> DataFrame:
    """``(id_col, n_tokens, ids, decoded)`` for every row: the ids in decimal,
    joined by spaces, and the library's decoded text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    size = F.octet_length("text")
    short = _short(rows.filter(size <= segment_bytes), path, leaf_symbols)
    long = _long(rows.filter(size > segment_bytes), path, leaf_symbols, segment_bytes)
    return short.unionByName(long).withColumnRenamed("id", id_col)
