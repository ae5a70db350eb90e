"""Cross-tokenizer alignment (operator 13).

Two tokenizers cut the same bytes: A (a ``tokenizers`` file, byte-level BPE) reads
a space and the text, B (a ``sentencepiece`` model) the text, in front of which it
puts a space itself.  Where tokens of both end at one byte, the text is cut into
groups; the two tokens that end there are a link.

The coarse cuts are the libraries' own spans: character offsets of A's encoding,
``begin`` and ``end`` of the pieces in B's proto.  A span that does not end where a
character ends (several tokens of one character, byte-fallback pieces, whose proto
spans are empty) is refined by the lengths of the tokens' decoded bytes.

A text is worked on in stretches, from a space or line break that stands alone to
the next one: there both tokenizers must cut, which ``Pair`` proves from the
vocabulary and the pre-tokenizer.  Equal stretches are aligned once a worker (a
cache of bounded size).  Without the proof a text is one stretch.

Counting links takes the whole corpus, in chunks of bounded text: every chunk adds
its distinct pairs with their numbers, the numbers are summed by pair, and each
chunk gets back the totals of its own pairs, no more.  A pair that every chunk holds
is dealt over salts on its way back.  Texts do not move, nor do single links.

Null, empty or unequal texts (joined token bytes differ from a space and the text,
as for a text that holds U+2581) have no tokens: zeros and no groups.  Rows are
aligned one by one, so repeated rows and null ids keep theirs, and each repetition
counts in the totals; other columns are not read.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import scratch, stored, text_of

MARK = "▁"
#: Text of one chunk, in characters, and its rows, at most (a longer text is one alone).
CHUNK, CHUNK_ROWS = 2_000_000, 2_000
#: Stretches in each of the two generations of a worker's cache at most; longer ones are not kept.
CACHED, CACHED_LENGTH = 300_000, 64
#: Stretches that are encoded at once.
TOGETHER = 500
#: Chunks that one salt of a pair serves on the way back.
CHUNKS_A_SALT = 20_000

#: Where both tokenizers cut: in front of a lone space or line break.
_LONE = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: A stretch that may stand between others, and leaves no doubt about its bytes.
_WORD = re.compile(r"[ \n](?:(?!▁|<0x)\S)+")
#: White space that is not a lone space or line break within a text.
_UNEVEN = re.compile(r"\A\s|\s\s|\s\Z|[^\S \n]")
#: Fixed value: the type of pre-tokenizer whose rule is known to cut there.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def _byte_alphabet() -> dict[str, int]:
    """Character of the byte-level alphabet -> byte: printable bytes are themselves,
    the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _lines(part: str) -> list[str]:
    first, *others = part.split("\n")
    return [first, *["\n" + x for x in others]]


class Pair:
    """Both tokenizers in one Python worker."""

    def __init__(self, a_path: str, b_path: str):
        import json

        import sentencepiece
        import tokenizers
        from sentencepiece import sentencepiece_model_pb2

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for i, t in names.items()}
        m = self.b
        self.b_bytes = {}
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            self.b_bytes[i] = bytes([int(piece[1:-1], 16)]) if m.is_byte(i) else piece.replace(MARK, " ").encode()
        self.b_size = np.array([len(self.b_bytes[i]) for i in range(m.get_piece_size())])
        self.single = np.array([m.is_byte(i) for i in range(m.get_piece_size())])
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        for i, raw in self.a_bytes.items():
            self.a_size[i] = len(raw)
        # The proofs.  A cuts in front of a lone space or line break by its rule.  B does
        # where no piece holds a mark behind another character or a line break, its
        # normaliser has no table, keeps spaces and puts one in front, and line breaks are bytes.
        spec = sentencepiece_model_pb2.ModelProto.FromString(m.serialized_model_proto())
        plain = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        norm = spec.normalizer_spec
        simple = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.add_dummy_prefix and norm.escape_whitespaces
        settings = json.loads(self.a.to_str())
        self.cuts = (
            settings["pre_tokenizer"] == _BYTE_LEVEL
            and set(alphabet) <= set(names.values())
            and settings["normalizer"] is None
            and simple
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and not spec.trainer_spec.user_defined_symbols
            and self.single.sum() == 256
            and not any(MARK in p.lstrip(MARK) or "\n" in p for p in plain)
        )
        self.cache: dict = {}
        self.old: dict = {}

    def stretches(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers must cut."""
        if not self.cuts:
            return [" " + text]
        if _UNEVEN.search(text):
            return _LONE.split(" " + text)
        parts = [" " + w for w in text.split(" ")]
        if "\n" in text:
            parts = [x for w in parts for x in (_lines(w) if "\n" in w else (w,))]
        return parts

    def _a_ends(self, text: str, ids: np.ndarray, offsets: list) -> np.ndarray:
        """Byte offsets where A's tokens end: their character offsets, and where the next
        token's character begins before a token's ends, the decoded bytes so far."""
        spans = np.array(offsets, np.int64).reshape(-1, 2)
        if text.isascii():
            return spans[:, 1]
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate([[0], np.cumsum(sizes)])
        within = np.zeros(len(ids), bool)
        within[:-1] = spans[1:, 0] < spans[:-1, 1]
        return np.where(within, np.cumsum(self.a_size[ids]), at[spans[:, 1]])

    def _b_ends(self, ids: np.ndarray, ends: np.ndarray, lead: int) -> np.ndarray:
        """Byte offsets where B's pieces end: their spans (``lead``: 1 behind a space that B
        adds, else 0), and for byte pieces, which have none, the decoded bytes so far."""
        return np.where(self.single[ids], np.cumsum(self.b_size[ids]), ends + lead)

    def _encoded(self, text: str, a, b) -> tuple | None:
        """``(ids of A, ends of A, ids of B, ends of B)`` of a text that begins with a space
        or line break; None where the bytes differ."""
        a_ids = np.array(a.ids, np.int64)
        pieces = list(b.pieces)
        lead = 1 if text[0] == " " else 0
        if not lead:
            del pieces[0]  # the mark that B puts in front
        b_ids = np.fromiter((p.id for p in pieces), np.int64, len(pieces))
        ends = np.fromiter((p.end for p in pieces), np.int64, len(pieces))
        if self.cuts:
            # All bytes are tokens of A, and B's pieces are the text's own but for marks and
            # bytes' names, which are shorter when decoded.
            same = self.b_size[b_ids].sum() == (len(text) if text.isascii() else len(text.encode()))
        else:
            raw = text.encode()
            same = b"".join(self.a_bytes[i] for i in a.ids) == raw and b"".join(self.b_bytes[i] for i in b_ids.tolist()) == raw
        if not same:
            return None
        return a_ids, self._a_ends(text, a_ids, a.offsets), b_ids, self._b_ends(b_ids, ends, lead)

    def _align(self, texts: list[str], a, b) -> list[tuple] | None:
        """``(tokens of A, tokens of B, groups as text, links)`` of stretches that were encoded
        as one text, links as ids of A times 2^32 plus those of B; None where bytes differ."""
        joined = "".join(texts)
        encoded = self._encoded(joined, a, b)
        if encoded is None:
            return None
        a_ids, a_ends, b_ids, b_ends = encoded
        _, i, j = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        links = (a_ids[i] << 32 | b_ids[j]).tobytes()
        bounds = np.cumsum([len(t) if t.isascii() else len(t.encode()) for t in texts])
        a_upto = [0, *np.searchsorted(a_ends, bounds, "right").tolist()]
        b_upto = [0, *np.searchsorted(b_ends, bounds, "right").tolist()]
        upto = [0, *np.searchsorted(a_ends[i], bounds, "right").tolist()]
        a_names, b_names = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        groups, p, q = [], 0, 0
        for x, y in zip((i + 1).tolist(), (j + 1).tolist()):
            head = a_names[p] if x == p + 1 else ",".join(a_names[p:x])
            tail = b_names[q] if y == q + 1 else ",".join(b_names[q:y])
            groups.append(f"{head}|{tail}")
            p, q = x, y
        return [
            (a_upto[k + 1] - a_upto[k], b_upto[k + 1] - b_upto[k], ";".join(groups[upto[k] : upto[k + 1]]), links[8 * upto[k] : 8 * upto[k + 1]])
            for k in range(len(texts))
        ]

    def _each(self, texts: list[str]) -> list:
        a = self.a.encode_batch(texts, add_special_tokens=False)
        b = self.b.encode([s[1:] if s[0] == " " else s for s in texts], return_type="proto", num_threads=1)
        return [(self._align([s], x, y) or [None])[0] for s, x, y in zip(texts, a, b)]

    def _together(self, words: list[str]) -> list:
        """Stretches without white space inside, encoded as one text: both tokenizers cut
        between them as they do in theirs."""
        text = "".join(words)
        b = self.b.encode(text[1:] if text[0] == " " else text, return_type="proto")
        return self._align(words, self.a.encode(text, add_special_tokens=False), b) or self._each(words)

    def aligned(self, parts: set[str]) -> dict:
        """Alignment of every stretch of ``parts``."""
        found, missing = {}, []
        for s in parts:
            held = self.cache.get(s, self)
            if held is self:
                held = self.old.get(s, self)
                if held is self:
                    missing.append(s)
                    continue
                self.cache[s] = held
            found[s] = held
        words = [s for s in missing if self.cuts and _WORD.fullmatch(s)]
        others = [s for s in missing if not (self.cuts and _WORD.fullmatch(s))]
        for some, align in ((words, self._together), (others, self._each)):
            for at in range(0, len(some), TOGETHER):
                part = some[at : at + TOGETHER]
                for s, held in zip(part, align(part)):
                    found[s] = held
                    if len(s) <= CACHED_LENGTH:
                        self.cache[s] = held
                if len(self.cache) > CACHED:
                    self.cache, self.old = {}, self.cache
        return found


_loaded: dict[tuple[str, str], Pair] = {}


def loaded(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Pair(a_path, b_path)
    return _loaded[a_path, b_path]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (size + len(row[1]) > CHUNK or len(held) >= CHUNK_ROWS):
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[1])
    if held:
        yield held


_SPANS = "chunk long, doc boolean, id long, n_a long, n_b long, n_groups long, groups string, links binary"


def _packed(links: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    keys, counts = np.unique(links, return_counts=True)
    return keys.tobytes() + counts.astype(np.int64).tobytes(), keys, counts


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(raw, np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def spans(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for every document (``doc``): tokens, groups as text, distinct links with
    their numbers; and one for every chunk of documents, with the links of them all."""

    def run(batches):
        pair = loaded(a_path, b_path)
        for number, rows in enumerate(_chunks(batches)):
            chunk = (TaskContext.get().partitionId() << 32) + number
            cut = [pair.stretches(text) if text else [] for _, text in rows]
            known = pair.aligned({s for parts in cut for s in parts})
            out, every = [], []
            for (ident, _), parts in zip(rows, cut):
                got = [known[s] for s in parts]
                if not got or any(g is None for g in got):
                    out.append((chunk, True, ident, 0, 0, 0, "", b""))
                    continue
                links = np.frombuffer(b"".join([g[3] for g in got]), np.int64)
                every.append(links)
                out.append((chunk, True, ident, sum(g[0] for g in got), sum(g[1] for g in got), len(links), ";".join(g[2] for g in got), _packed(links)[0]))
            del known
            if every:
                out.append((chunk, False, None, 0, 0, 0, "", _packed(np.concatenate(every))[0]))
            for at in range(0, len(out), 256):
                columns = list(zip(*out[at : at + 256]))
                types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["chunk", "doc", "id", "n_a", "n_b", "n_groups", "groups", "links"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, _SPANS)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys, counts = _unpacked(raw)
            yield pa.record_batch([pa.array(np.full(len(keys), chunk)), pa.array(keys), pa.array(counts)], ["chunk", "link", "m"])


def link_counts(chunk_links: DataFrame) -> DataFrame:
    """``(link, a_id, b_id, count, best)`` of every linked pair of ids: ``best`` where
    no other pair of its B id has a greater count."""
    total = chunk_links.groupBy("link").agg(F.sum("m").alias("count"))
    total = total.select("link", F.shiftright("link", 32).cast("int").alias("a_id"), F.col("link").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"), "count")
    # One row a pair of ids: at most as many a B id as A has ids.
    top = total.groupBy("b_id").agg(F.max("count").alias("top"))
    return total.join(top, "b_id").select("link", "a_id", "b_id", "count", (F.col("count") == F.col("top")).alias("best"))


def _scored(documents: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    order = np.argsort(totals["link"].to_numpy())
    link = totals["link"].to_numpy()[order]
    count = totals["count"].to_numpy()[order]
    best = totals["best"].to_numpy()[order].astype(np.int64)
    n_best, count_sum = [], []
    for raw in documents["links"]:
        keys, m = _unpacked(raw)
        at = np.searchsorted(link, keys)
        n_best.append(int((best[at] * m).sum()) if len(keys) else 0)
        count_sum.append(int((count[at] * m).sum()) if len(keys) else 0)
    return documents.drop(columns=["links", "chunk"]).assign(n_best=n_best, count_sum=count_sum)


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every
    row: ``n_best`` links whose pair is the most frequent one of its B id, ``count_sum``
    the summed counts of its links, and the digest of the groups (``a1,a2|b1;a3|b2,b3``;
    empty without tokens).  ``with_groups`` adds their text, ``groups``."""
    spark = docs.sparkSession
    found = spans(docs, a_path, b_path, id_col, text_col)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    kept = ["groups"] if with_groups else []
    held = stored(found.select("chunk", "doc", "id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), *kept, "links"), scratch(spark, "alignment"))
    parts = held.filter(~F.col("doc")).select("chunk", "links").mapInArrow(_exploded, "chunk long, link long, m long")
    totals = stored(link_counts(parts), scratch(spark, "alignment-counts"))
    chunks = held.filter(~F.col("doc")).count()
    salts = 1 + chunks // CHUNKS_A_SALT
    dealt = totals.select("link", "count", "best", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    wanted = parts.select("chunk", "link", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int").alias("salt"))
    back = wanted.join(dealt, ["link", "salt"]).select("chunk", "link", "count", "best")
    documents = held.filter("doc").drop("doc")
    names = ", ".join(["id long", "n_a long", "n_b long", "n_groups long", "groups_sha256 string", *[f"{c} string" for c in kept], "n_best long", "count_sum long"])
    out = documents.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(_scored, names)
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256", *kept)
