"""Token counts (operator 5).

Counts are those of ``sentencepiece`` for a given BPE model, without begin or
end tokens.  Two facts are proved from the vocabulary, once a Python worker:

* cuts: no piece holds a space mark behind another character, and none holds a
  line break, so no merge crosses from a word into the next one's space mark or
  over a line break.  A text is then cut there in pre-tokens;
* whole tokens: every piece of the shape of a pre-token is encoded alone, and
  those that come back as one token are kept as the shortcut.

A pre-token in the shortcut counts 1.  Only the rest are merged, by the library,
once a worker (a cache of bounded size).  If a model does not allow the cuts, or
a text holds what the cuts do not cover (runs of spaces, the space mark itself,
characters that the model's normaliser may change), the library counts that text
whole: same results, only slower.

Nulls count as empty texts: 0 bytes, 0 tokens.  Rows are counted one by one, so
repeated rows and null ids keep theirs; other columns are not read.  Empty
tables give empty results.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import text_of

MARK = "▁"
#: Pre-tokens in each of the two generations of a worker's cache at most.
CACHED = 300_000


class Counter:
    """One model in one Python worker."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        normal = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.byte_fallback = any(m.is_byte(i) for i in range(m.get_piece_size()))
        # The proofs.  Control strings in a text are ordinary text to the library.
        crossing = any(MARK in p.lstrip(MARK) or "\n" in p for p in normal)
        # One mark is put in front, a line break is one byte token, and the
        # normaliser changes nothing but spaces (tried on characters that the usual ones change).
        probe = "a\ufb01\u00b2\u212b\uff21\u1100\u1161b c"
        plain = m.encode("a\nb", out_type=str) == m.encode("a", out_type=str) + ["<0x0A>"] + m.encode("\nb", out_type=str)[2:] and m.normalize(probe) == MARK + probe.replace(" ", MARK)
        self.cuts = plain and not crossing
        inner = [p for p in normal if MARK not in p[1:] and p != MARK]
        spaced = [p[1:] for p in inner if p.startswith(MARK)]
        bare = [p for p in inner if not p.startswith(MARK)]
        self.whole = {w.encode(): 1 for w, n in zip(spaced, self.spaced(spaced)) if n == 1}
        self.whole_bare = {w.encode(): 1 for w, n in zip(bare, self.bare(bare)) if n == 1}
        self.caches = [[{}, {}], [{}, {}]]

    def spaced(self, words: list[str]) -> list[int]:
        """Tokens of words behind a space."""
        return [len(x) for x in self.model.encode(words, num_threads=1)]

    def bare(self, words: list[str]) -> list[int]:
        """Tokens of words behind a line break: less the mark and the break."""
        return [len(x) - 2 for x in self.model.encode(["\n" + w for w in words], num_threads=1)]

    def _sum(self, words: list[bytes], whole: dict, caches: list[dict], merge) -> int:
        found = list(map(whole.get, words))
        if None not in found:
            return sum(found)
        total = sum(filter(None, found))
        rest = [w for w, f in zip(words, found) if f is None]
        cache, old = caches
        counts = list(map(cache.get, rest))
        if None in counts:
            new = {w: old.get(w) for w, c in zip(rest, counts) if c is None}
            missing = [w for w, c in new.items() if c is None]
            new.update(zip(missing, merge([w.decode() for w in missing])))
            counts = [new[w] if c is None else c for w, c in zip(rest, counts)]
            if len(cache) + len(new) > CACHED:
                caches[:] = [{}, cache]
            if len(new) <= CACHED:
                caches[0].update((w, c) for w, c in new.items() if len(w) <= 64)
        return total + sum(counts)

    def count(self, text: bytes) -> int:
        if not text:
            return 0
        if not self.cuts or b"  " in text or MARK.encode() in text or text.startswith((b" ", b"\n")) or text.endswith(b" ") or b" \n" in text or b"\n " in text or b"\r" in text or b"\t" in text or b"\0" in text:
            return len(self.model.encode(text.decode()))
        lines = text.split(b"\n")
        spaced = lines[0].split(b" ")
        bare = []
        for line in lines[1:]:
            first, *others = line.split(b" ")
            if first:
                bare.append(first)
            spaced += others
        return len(lines) - 1 + self._sum(spaced, self.whole, self.caches[0], self.spaced) + self._sum(bare, self.whole_bare, self.caches[1], self.bare)


_loaded: dict[str, Counter] = {}


def loaded(path: str) -> Counter:
    """The model of this Python worker, read and proved once."""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` for every row."""

    def run(batches):
        counter = loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.record_batch([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([counter.count(t) for t in texts], pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    out = rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
