"""Token-ID output in training order (operator 1).

1. Documents are encoded, and the tokens of each, behind each other with an
   end-of-text token, are stored once as 16-bit numbers (32-bit ones for a vocabulary
   that needs them) with the document's place in its part of the input.  Parts follow each other: the running sum over the
   parts' sizes gives every token its place in one stream, without a shuffle.
2. The stream is cut in sequences of ``length`` tokens (the last one padded).  A keyed
   Feistel network over the next even power of two, walked in cycles until it
   falls in range, permutes the sequence numbers: each sequence's slot in training order.
   Slots are never stored, and the order is known from the key and the number of
   sequences alone; ``unslot`` goes back.
3. Slots are cut in shards of ``per_shard``; a shard's range of slots is one
   partition.  A task gathers what it has for each shard up to ``GATHER`` bytes in all
   and sends one compressed block a shard; the shard's task lays the blocks' pieces out
   in one buffer of ``per_shard * stride`` bytes and writes it as one file of fixed-stride
   records: record i of shard s is slot s * per_shard + i, so a reader
   seeks to any step and goes on in sequence.  A shard is written under a name of its attempt
   and renamed when complete, so repeated or lost tasks leave whole files.
4. ``manifest.json`` beside the shards names what they were made from: the
   parameters, the tokenizer's hash and a digest of the tokens and their places.  A restart
   with ``resume`` keeps complete shards of an equal manifest only; otherwise the
   folder's shards are deleted before the first is written.

Null or empty texts: the end-of-text token alone.  Rows are encoded one by one, so repeated
rows and null ids keep their tokens; other columns are not read.  An empty table
gives no sequences and no files.  No text is cut or left out.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import scratch, stored, text_of

ROUNDS = 6
#: Bytes of tokens that a task gathers before it sends them to their shards.
GATHER = 32 << 20
#: Parts of the input whose places are broadcast (16 bytes a part); more are joined.
BROADCAST_PARTS = 1_000_000


# -- the permutation ------------------------------------------------------
def _keys(key: int) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little") for r in range(ROUNDS)]


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    x = half + np.uint64(key)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x >> np.uint64(64 - bits)) if bits < 64 else x


def _network(x: np.ndarray, keys: list[int], bits: int) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for k in keys:
        left, right = right, left ^ _round(right, k, bits)
    # Halves change sides once more, so that the same network, keys reversed, undoes it.
    return (right << np.uint64(bits)) | left


def _walk(x: np.ndarray, n: int, keys: list[int]) -> np.ndarray:
    bits = _half_bits(n)
    x = _network(np.asarray(x, np.uint64), keys, bits)
    while (out := x >= n).any():
        x[out] = _network(x[out], keys, bits)
    return x.astype(np.int64)


def slot(sequence: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of sequence numbers: a permutation of 0 .. n - 1."""
    return _walk(sequence, n, _keys(key))


def unslot(slots: np.ndarray, n: int, key: int) -> np.ndarray:
    """The sequence numbers of slots."""
    return _walk(slots, n, _keys(key)[::-1])


# -- tokens -----------------------------------------------------------------
_loaded: dict = {}


def _encoder(path: str, pattern: str):
    """The rank file's encoder of this Python worker."""
    if path not in _loaded:
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def token_type(path: str, end: int) -> str:
    """The number format that holds every id of the rank file and ``end``."""
    with open(path, "rb") as f:
        last = max((int(line.split()[1]) for line in f), default=0)
    return "<u2" if max(last, end) < 1 << 16 else "<u4"


def token_table(docs: DataFrame, path: str, pattern: str, end: int, text_col: str = "text", kind: str = "<u2") -> DataFrame:
    """``(part, place, at, n, tokens)``: each row's tokens as bytes, with its
    place, and the number of tokens before it, in its part of the input."""

    def run(batches):
        from pyspark import TaskContext

        encoder = _encoder(path, pattern)
        part = TaskContext.get().partitionId()
        place = at = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out: list[list] = [[], [], [], []]
                for text in batch.column(0).slice(low, 256).to_pylist():
                    ids = np.array([*encoder.encode_ordinary(text), end], kind)
                    for column, x in zip(out, (place, at, len(ids), ids.tobytes())):
                        column.append(x)
                    place, at = place + 1, at + len(ids)
                n = len(out[0])
                yield pa.record_batch(
                    [pa.array([part] * n, pa.int32()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                    ["part", "place", "at", "n", "tokens"],
                )

    return docs.select(text_of(text_col).alias("text")).mapInArrow(run, "part int, place long, at long, n long, tokens binary")


def _blocks(tokens: DataFrame, n: int, length: int, key: int, per_shard: int, width: int) -> DataFrame:
    """``(shard, size, block)``: pieces of a shard's sequences, compressed together.
    A block holds its number of pieces, each one's record, first token and tokens, and
    their bytes; ``size`` is what it holds unpacked."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=6)
        heads: list[np.ndarray] = []
        held: list[bytes] = []
        gathered = 0

        def sent():
            head = np.concatenate(heads)
            order = np.argsort(head[:, 0], kind="stable")
            cut = np.flatnonzero(np.diff(head[order, 0])) + 1
            for mine in np.split(order, cut):
                table = head[mine, 1:].astype(np.int32)
                block = b"".join([np.int32(len(mine)).tobytes(), table.T.tobytes(), *(held[i] for i in mine.tolist())])
                columns = [pa.array([head[mine[0], 0]], pa.int32()), pa.array([len(block)], pa.int32()), pa.array([codec.compress(block, asbytes=True)], pa.binary())]
                yield pa.record_batch(columns, ["shard", "size", "block"])
            heads.clear()
            held.clear()

        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                begin, size = part.column(0).to_numpy(), part.column(1).to_numpy()
                rows = part.column(2).to_pylist()
                first, last = begin // length, (begin + size - 1) // length
                count = last - first + 1
                row = np.repeat(np.arange(len(begin)), count)
                sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                slots = slot(sequence, n, key)
                a = np.maximum(sequence * length, begin[row])
                z = np.minimum((sequence + 1) * length, (begin + size)[row])
                lo, hi = width * (a - begin[row]), width * (z - begin[row])
                held += [rows[r][x:y] for r, x, y in zip(row.tolist(), lo.tolist(), hi.tolist())]
                heads.append(np.stack([slots // per_shard, slots % per_shard, a - sequence * length, z - a], axis=1))
                gathered += int((hi - lo).sum())
                if gathered >= GATHER:
                    yield from sent()
                    gathered = 0
        if heads:
            yield from sent()

    return tokens.select("begin", "n", "tokens").mapInArrow(run, "shard int, size int, block binary")


def _write(blocks: DataFrame, folder: str, length: int, per_shard: int, pad: int, n: int, key: int, kind: str) -> DataFrame:
    """Shard files, those left out that are there, and
    ``(slot, sequence, shard, offset, n_tokens, sha256)`` per record."""
    stride = np.dtype(kind).itemsize * length

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        codec = pa.Codec("zstd")
        shard, records, filled = None, None, None

        def done():
            name = f"{root}/shard-{shard:08d}.bin"
            whole = store.get_file_info(name)
            data = records.tobytes()
            if whole.type != fs.FileType.File or whole.size != len(data):
                temp = f"{root}/.shard-{shard:08d}-{uuid.uuid4().hex}"
                with store.open_output_stream(temp) as file:
                    file.write(data)
                store.move(temp, name)
            place = np.arange(len(filled), dtype=np.int64)
            slots = shard * per_shard + place
            hashes = [hashlib.sha256(data[i : i + stride]).hexdigest() for i in range(0, len(data), stride)]
            columns = [pa.array(slots), pa.array(unslot(slots, n, key)), pa.array(np.full(len(place), shard, np.int32)), pa.array(place * stride), pa.array(filled), pa.array(hashes, pa.string())]
            return pa.record_batch(columns, ["slot", "sequence", "shard", "offset", "n_tokens", "sha256"])

        for batch in batches:
            for i in range(batch.num_rows):
                s, size, packed = (batch.column(c)[i] for c in range(3))
                if s.as_py() != shard:
                    if shard is not None:
                        yield done()
                    shard = s.as_py()
                    filled = np.zeros(min(per_shard, n - shard * per_shard), np.int32)
                    records = np.full((len(filled), length), pad, kind)
                block = codec.decompress(packed.as_buffer(), size.as_py(), asbytes=True)
                pieces = int(np.frombuffer(block, np.int32, 1)[0])
                record, start, count = np.frombuffer(block, np.int32, 3 * pieces, 4).reshape(3, pieces)
                tokens = np.frombuffer(block, kind, offset=4 + 12 * pieces)
                at = 0
                for r, a, c in zip(record.tolist(), start.tolist(), count.tolist()):
                    records[r, a : a + c] = tokens[at : at + c]
                    at += c
                np.add.at(filled, record, count)
        if shard is not None:
            yield done()

    # One partition a shard, its blocks in any order.
    shards = max(1, -(-n // per_shard))
    dealt = blocks.repartitionById(shards, F.col("shard"))
    return dealt.mapInArrow(run, "slot long, sequence long, shard int, offset long, n_tokens int, sha256 string")


def _prepare(folder: str, made_from: dict, resume: bool) -> None:
    """Leave complete shards in the folder only if they were made from the same."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    name, text = f"{root}/manifest.json", json.dumps(made_from, sort_keys=True).encode()
    if resume and store.get_file_info(name).type == fs.FileType.File:
        with store.open_input_stream(name) as f:
            if f.read() == text:
                return
    # The manifest goes first: without one, a restart trusts no shard.
    old = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.base_name == "manifest.json" or f.base_name.startswith(("shard-", ".shard-"))]
    for path in sorted(old, key=lambda p: p != name):
        store.delete_file(path)
    with store.open_output_stream(f"{name}.new") as f:
        f.write(text)
    store.move(f"{name}.new", name)


def materialised(
    docs: DataFrame,
    folder: str,
    path: str,
    pattern: str,
    end: int = 50256,
    length: int = 2048,
    per_shard: int = 4096,
    key: int = 2026,
    text_col: str = "text",
    resume: bool = True,
) -> DataFrame:
    """Write the shards below ``folder`` (a URI of shared storage) and return a row for
    each record: its slot, sequence number, shard, byte offset, tokens before
    the padding, and the hash of its bytes."""
    spark = docs.sparkSession
    base = scratch(spark, "token-output")
    kind = token_type(path, end)
    tokens = stored(token_table(docs, path, pattern, end, text_col, kind), f"{base}/tokens")
    # One row a part: its size, and a digest of its tokens at their places.
    digest = F.sum(F.xxhash64("place", "at", "tokens").cast("decimal(38,0)")).alias("digest")
    sizes = tokens.groupBy("part").agg(F.sum("n").alias("size"), digest).orderBy("part").collect()
    before = dict(zip([r["part"] for r in sizes], np.cumsum([0, *[r["size"] for r in sizes]]).tolist()))
    total = sum(r["size"] for r in sizes)
    n = -(-total // length)
    offsets = spark.createDataFrame([(p, b) for p, b in before.items()], "part int, before long")
    placed = tokens.join(F.broadcast(offsets) if len(before) <= BROADCAST_PARTS else offsets, "part")
    placed = placed.withColumn("begin", F.col("before") + F.col("at"))
    with open(path, "rb") as f:
        tokenizer = hashlib.sha256(f.read() + pattern.encode()).hexdigest()
    text = hashlib.sha256(json.dumps([[r["part"], r["size"], str(r["digest"])] for r in sizes]).encode()).hexdigest()
    _prepare(folder, {"length": length, "per_shard": per_shard, "key": key, "end": end, "type": kind, "sequences": n, "tokenizer": tokenizer, "tokens": text}, resume)
    blocks = _blocks(placed, n, length, key, per_shard, np.dtype(kind).itemsize)
    return stored(_write(blocks, folder, length, per_shard, end, n, key, kind), f"{base}/records")
