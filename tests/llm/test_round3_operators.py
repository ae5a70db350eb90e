"""Whitening, sharding and alignment against brute force: nulls, empty and long texts,
ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidepool.llm import alignment, sharding, whitening
from tidepool.llm.common import ship
from tidepool.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def _code(spark):
    ship(spark)


# -- whitening -----------------------------------------------------------------


def _spectra(d):
    yield np.arange(1, d + 1) ** 2.0
    yield np.r_[np.zeros(d // 2), np.ones(d - d // 2)]
    yield 10.0 ** -np.arange(d).clip(0, 14)
    yield np.ones(d)


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_components_by_divide_and_conquer(d):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    for spectrum in _spectra(d):
        a = q @ np.diag(spectrum) @ q.T
        values, vectors = whitening.components((a + a.T) / 2)
        assert np.allclose(values, np.sort(spectrum)[::-1], atol=1e-13 * d * spectrum.max())
        assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-13 * d)
        assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-13 * d * np.linalg.norm(a)


def test_splits_need_no_other_eigensolver(monkeypatch):
    monkeypatch.setattr(np.linalg, "eigh", None)
    rng = np.random.default_rng(7)
    a = rng.normal(size=(80, 40))
    values, _ = whitening.components(a.T @ a)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(a.T @ a))[::-1])


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    signs = np.where(np.arange(30) < 11, 1.0, -1.0)
    a = q @ np.diag(signs * np.geomspace(1e-9, 1, 30)) @ q.T
    assert np.allclose(whitening.polar((a + a.T) / 2), q @ np.diag(signs) @ q.T, atol=1e-6)


def _whitened_by_hand(rows, k):
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    d = collections.Counter(len(x) for _, x in good).most_common(1)[0][0]
    good = [(i, x) for i, x in good if len(x) == d]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, x in good:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out.setdefault(i, []).append((n, dev, (np.array(x) - mean) @ vectors / np.sqrt(values), values / np.trace(cov)))
    return out


def _vectors():
    rng = np.random.default_rng(11)
    mix = rng.normal(size=(6, 6))
    rows = [(i, [float(c) for c in rng.normal(size=6) @ mix]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # one vector holds many rows
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[2][1]), (900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0, 5.0])]
    rows += [(903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [1.0, 2.0]), (906, [1e300] * 6)]
    return rows


def test_whitening_equals_numpy(spark):
    rows = _vectors()
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id long, embedding array<double>, component string, n int").repartition(5)
    got = whitening.whitened(df).collect()
    want = _whitened_by_hand([r for r in rows if r[0] != 906], 4)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["vec_id"]].append(r)
    assert set(by_id) == set(want) and len(got) == 4 * sum(map(len, want.values()))
    # Either sign, the same for all rows.
    sign = {c: np.sign(next(r["whitened"] for r in by_id[0] if r["component"] == c) * want[0][0][2][c - 1]) for c in range(1, 5)}
    for i, rows_ in by_id.items():
        deviations = collections.Counter((w[0], w[1]) for w in want[i])
        assert collections.Counter((r["n"], r["deviation"]) for r in rows_ if r["component"] == 1) == deviations
        if len(want[i]) == 1:
            for r in rows_:
                n, dev, w, e = want[i][0]
                assert r["whitened"] * sign[r["component"]] == pytest.approx(w[r["component"] - 1], rel=1e-9, abs=1e-9)
                assert r["explained"] == pytest.approx(e[r["component"] - 1], rel=1e-9)
    assert {r["identity_error"] for r in got} and max(r["identity_error"] for r in got) < 1e-9


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    one = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    line = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], schema)).collect()
    assert {(r["component"], None if r["whitened"] is None else round(abs(r["whitened"]), 9)) for r in line} == {(1, 1.0), (2, None)}


def test_large_entries_stay_exact(spark):
    # Beyond 64 bits a deviation is null; below, it is exact.
    rows = [(0, [1.0e15, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 3.0])]
    got = {(r["vec_id"], r["deviation"]) for r in whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(d is None for _, d in got)
    rows[0] = (0, [2.0e6, 0.0])
    want = {i: dev[0][1] for i, dev in _whitened_by_hand(rows, 2).items()}
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == want


# -- sharding ------------------------------------------------------------------


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _hash(text):
    return _signed(xxhash.xxh64_intdigest(text.encode(), seed=42))


def _shards_by_hand(texts, shards, slack=0.0):
    """Counts of rows by (arc, shard), placed arc by arc."""
    ring = sorted({(_hash(f"{s}#{v}"), s) for s in range(shards) for v in range(sharding.VIRTUAL)})
    load = collections.Counter()
    for t in texts:
        place = _hash(t or "")
        load[next((k for k, (p, _) in enumerate(ring) if p >= place), 0)] += 1
    total = len(texts)
    room = [total // shards + (s < total % shards) + math.ceil(total * slack / shards) for s in range(shards)]
    got = collections.Counter()
    left = {}
    for k, (_, s) in enumerate(ring):
        keep = min(room[s], load[k])
        room[s] -= keep
        got[k, s] += keep
        left[k] = load[k] - keep
    for k in range(len(ring)):
        for step in range(1, len(ring) + 1):
            s = ring[(k + step) % len(ring)][1]
            put = min(room[s], left[k])
            room[s] -= put
            left[k] -= put
            got[k, s] += put
    return +got, load


def _documents():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc é\n") for _ in range(rng.choice([1, 5, 30, 900]))) for _ in range(400)]
    texts += ["copy of one text"] * 300 + [None, "", "", "x" * 100_000]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (7, texts[7]), (7, texts[7]), (7, "another text")]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, 1, "s") for i, t in _documents()]
    return spark.createDataFrame(rows, "doc_id long, text string, shard int, size string").repartition(6)


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_shards_equal_placement_by_hand(spark, documents, slack):
    rows = _documents()
    got = sharding.sharded(documents, 7, slack=slack, block=40).collect()
    want, _ = _shards_by_hand([t for _, t in rows], 7, slack)
    assert collections.Counter(r["shard"] for r in got) == collections.Counter({s: sum(n for (_, q), n in want.items() if q == s) for s in range(7)})
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for s in range(7):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    if not slack:
        sizes = collections.Counter(r["shard"] for r in got).values()
        assert max(sizes) - min(sizes) <= 1


def test_equal_texts_meet_unless_their_arc_is_cut(spark, documents):
    got = sharding.sharded(documents, 7).collect()
    where = collections.defaultdict(set)
    for r in got:
        where[r["text_crc32"], r["size"]].add(r["shard"])
    # Only the large group and those that share a cut arc are split: not one a shard.
    assert sum(len(s) > 1 for s in where.values()) <= 7
    assert len(where[zlib.crc32(b"copy of one text"), 17]) > 1


def test_shards_by_bytes_are_near_equal(spark, documents):
    got = sharding.sharded(documents.filter("length(text) < 1000 OR text IS NULL"), 5, law="bytes").collect()
    load = collections.Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    even = sum(load.values()) / 5
    assert max(abs(load[s] - even) for s in range(5)) < 10 * 1801  # rows at cuts, each under 1,801 bytes
    for s in range(5):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_one_more_shard_moves_few_rows(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    at = {n: {r["doc_id"]: r["shard"] for r in sharding.sharded(rows, n, slack=0.1).collect()} for n in (10, 11)}
    moved = sum(at[10][i] != at[11][i] for i in at[10])
    modulo = sum(i % 10 != i % 11 for i in range(4000))
    assert moved < 0.25 * 4000 < modulo


def test_shards_of_nothing(spark):
    assert sharding.sharded(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        sharding.sharded(spark.createDataFrame([], "doc_id long, text string"), law="key")


def test_sharding_query_on_the_whole_table(spark):
    got = QUERIES["op12_sharding"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want, _ = _shards_by_hand([r["text"] for r in docs], 16)
    assert collections.Counter(r["shard"] for r in got) == collections.Counter({s: sum(n for (_, q), n in want.items() if q == s) for s in range(16)})
    assert {(r["doc_id"], r["size"]) for r in got} == {(r["doc_id"], len((r["text"] or "").encode()) + 1) for r in docs}
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


# -- alignment -----------------------------------------------------------------

ODD = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "\nword\n", "x\ty", "naïve café — 日本語 𐍈𐍉 🤷🏽‍♂️", "<s> </s> <unk> <0x0A> <|endoftext|>", "under▁score",
    "tail nbsp　wide", "don't we'll 12345 !!! ...", "é combining", "\x00nul\x1c", "\r\nwindows\r\n", "zero​width ﻿bom",
]


def _aligned_by_hand(texts):
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    alphabet = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}
    found = []
    for t in texts:
        if not t:
            found.append(None)
            continue
        e = a.encode(" " + t, add_special_tokens=False)
        a_raw = [bytes(alphabet[c] for c in x) for x in e.tokens]
        b_ids = b.encode(t)
        b_raw = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, b.encode(t, out_type=str))]
        if b"".join(a_raw) != (" " + t).encode() or b"".join(b_raw) != (" " + t).encode():
            found.append(None)
            continue
        a_at, b_at = {}, {}
        for ids, raw, ends in ((e.ids, a_raw, a_at), (b_ids, b_raw, b_at)):
            at = 0
            for k, x in enumerate(raw):
                at += len(x)
                ends[at] = k
        cuts = sorted(set(a_at) & set(b_at))
        groups, links, i, j = [], [], 0, 0
        for c in cuts:
            p, q = a_at[c], b_at[c]
            groups.append(",".join(map(str, e.ids[i : p + 1])) + "|" + ",".join(map(str, b_ids[j : q + 1])))
            links.append((e.ids[p], b_ids[q]))
            i, j = p + 1, q + 1
        found.append((len(e.ids), len(b_ids), ";".join(groups), links))
    count = collections.Counter(x for f in found if f for x in f[3])
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (f[0], f[1], len(f[3]), len(f[3]), sum(count[x] == top[x[1]] for x in f[3]), sum(count[x] for x in f[3]), hashlib.sha256(f[2].encode()).hexdigest()) if f else (0, 0, 0, 0, 0, 0, "")
        for f in found
    ]


def _rows(df):
    return sorted(tuple(r)[:8] for r in df.collect())


def test_alignment_equals_the_libraries(spark):
    rng = random.Random(8)
    words = ["the", "Überraschung", "naïve", "don't", "token", "𐍈", "日本", "x86_64", "…", "a"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 60, 60, 5000)]
    texts += [rng.choice([" ", "\n", "\t", "  "]).join(rng.choice(words) for _ in range(20)) for _ in range(30)]
    texts += ["y" * 20_000, "same text"] + ["same text"] * 40
    rows = [(i, t, 0, "g") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, groups string").repartition(5)
    want = sorted((i, *x) for i, x in enumerate(_aligned_by_hand(texts)))
    assert _rows(alignment.aligned(df, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))) == want


def test_alignment_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = sorted((r["doc_id"], *x) for r, x in zip(docs, _aligned_by_hand([r["text"] for r in docs])))
    assert _rows(QUERIES["op13_alignment"](spark, SF)) == want


def test_alignment_without_the_proof_takes_whole_texts(monkeypatch):
    pair = alignment.Pair(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    assert pair.cuts
    texts = [t for t in ODD if t] + ["one two\nthree  four"]
    cut = []
    for t in texts:
        parts = [pair.aligned({s})[s] for s in pair.stretches(t)]
        cut.append(None if None in parts else (sum(p[0] for p in parts), sum(p[1] for p in parts), ";".join(p[2] for p in parts), b"".join(p[3] for p in parts)))
    pair.cuts = False
    assert [pair.aligned({" " + t})[" " + t] for t in texts] != [] and all(pair.stretches(t) == [" " + t] for t in texts)
    pair.cache, pair.old = {}, {}
    assert [pair.aligned({" " + t})[" " + t] for t in texts] == cut


def test_alignment_keeps_a_small_cache(monkeypatch):
    monkeypatch.setattr(alignment, "CACHED", 10)
    pair = alignment.Pair(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    words = {f" w{k}" for k in range(300)}
    assert set(pair.aligned(words)) == words
    assert len(pair.cache) <= 10 + alignment.TOGETHER and set(pair.aligned(words)) == words


def test_alignment_repeats_null_ids_empty_tables_and_salts(spark, monkeypatch):
    a, b = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), a, b).count() == 0
    monkeypatch.setattr(alignment, "CHUNKS_A_SALT", 2)
    texts = ["one two three"] * 12 + [None]
    df = spark.createDataFrame([(3, t) for t in texts[:2]] + [(None, t) for t in texts[2:]], "doc_id long, text string").repartition(7)
    got = alignment.aligned(df, a, b, with_groups=True).collect()
    want = collections.Counter(_aligned_by_hand(texts))
    assert collections.Counter(tuple(r)[1:8] for r in got) == want
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in got if r["groups"])


# -- pipeline --------------------------------------------------------------------


def test_near_dup_stage_keeps_other_texts_of_an_id(spark):
    import corpus_pipeline

    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve thirteen", "some words that stand nowhere else here")
    rows = [(5, a, 1), (5, a, 1), (5, b, 2), (6, a, 3), (None, c, 4), (None, c, 4), (7, c, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = sorted((r["doc_id"] or -1, r["text"]) for r in corpus_pipeline.near_dup_stage(spark, docs, SF).collect())
    assert kept == sorted([(5, a), (5, b), (-1, c), (-1, c), (7, c)])


# -- secret scans ------------------------------------------------------------------


def test_many_secrets_in_one_text_take_time_in_proportion(spark):
    import time

    from tidepool.llm import secret_scan

    took = {}
    for n in (10_000, 40_000, 40_000):
        text = " ".join(f"{k:032x}" for k in range(n))
        df = spark.createDataFrame([(text,)], "text string")
        begin = time.perf_counter()
        row = df.select(secret_scan.findings(F.col("text")).alias("f")).select(F.transform("f", lambda x: x["start"]).alias("s"), F.size("f").alias("n")).first()
        took[n] = time.perf_counter() - begin
        assert row["n"] == n and row["s"] == [33 * k for k in range(n)]
    assert took[40_000] < 10 * max(took[10_000], 1.0)


def test_findings_reach_every_version_of_a_path(spark, tmp_path):
    from tidepool.llm import secret_scan

    ledger = str(tmp_path / "ledger")
    secret, other = "password=hunter22", "AKIA" + "A" * 16
    first = spark.createDataFrame([(1, secret), (2, "nothing"), (3, secret)], "doc_id long, text string")
    later = spark.createDataFrame([(1, "nothing"), (2, other), (3, secret)], "doc_id long, text string")
    for version, docs in (("v1", first), ("v2", later), ("v2", later)):
        secret_scan.scan(docs, ledger, version=version).count()
    found = {(r["path"], r["version"], secret_scan.RULES[r["findings"][0]["kind"]][0]) for r in secret_scan.historical(spark, ledger).collect()}
    assert found == {(1, "v1", "assign"), (3, "v1", "assign"), (2, "v2", "access"), (3, "v2", "assign")}
    assert spark.read.parquet(ledger).count() == 3 and secret_scan.historical(spark, ledger).count() == 4
