import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import rows
from tidemark.llm import packing, token_files, tokens

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
PIECES = st.text(alphabet=st.sampled_from(list(" \n\t\r ab'sT.,!?#1é́ß\U0001f600<|>İ")),
                 max_size=30)


def library(texts, name):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokens.default_path(name))
    return [e.ids for e in tok.encode_batch(list(texts), add_special_tokens=False)]


@pytest.mark.parametrize("name", NAMES)
def test_same_ids_as_the_library(name):
    @settings(max_examples=150, deadline=None, database=None, derandomize=True)
    @given(st.lists(PIECES, min_size=1, max_size=8))
    def check(texts):
        got = [x.tolist() for x in tokens.encoded(pa.array(texts), tokens.default_path(name))]
        assert got == library(texts, name)

    check()
    fixed = ["", " ", "don't stop, now...", "a  b   c\n\n\nd ", "<|endoftext|> x", " lead\n"]
    got = [x.tolist() for x in tokens.encoded(pa.array(fixed), tokens.default_path(name))]
    assert got == library(fixed, name)


def test_memory_of_words_is_bounded():
    enc = tokens.Encoder(tokens.default_path(NAMES[1]), limit=5)
    for k in range(6):
        texts = [f"word{k} again{j} and more of them {j * k}" for j in range(5)]
        ids, off = enc(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == library(texts, NAMES[1])
    assert len(enc.known) == len(enc.ids) < 60


def test_token_files_round_trip(odd, clashing, empty, spark):
    path = tokens.default_path(NAMES[1])
    manifest = token_files.write(odd, path, seq_len=64, file_tokens=5000)
    got = token_files.read(manifest).collect()
    src = sorted(((r["doc_id"], r["text"]) for r in odd.collect()),
                 key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    ids = [x + [2] for x in library([t or "" for _, t in src], NAMES[1])]
    start = np.cumsum([0] + [len(x) for x in ids])
    expected = [(d, int(s), np.array(x, "<u4").tobytes()) for (d, _), s, x in zip(src, start, ids)]
    key = lambda r: (r[1], len(r[2]))
    assert sorted(((r["doc_id"], r["start"], bytes(r["ids"])) for r in got), key=key) == sorted(
        expected, key=key)
    other = token_files.read(token_files.write(clashing, path, seq_len=64, file_tokens=5000))
    assert other.count() == len(src)
    assert token_files.read(token_files.write(empty, path)).count() == 0


def test_sequences_and_masks(odd):
    manifest = token_files.write(odd, tokens.default_path(NAMES[1]), seq_len=64)
    for r in manifest.collect():
        n = -(-r["n_tokens"] // 64)
        parts = [token_files.sequence(r["path"], k) for k in range(n)]
        parts = [(ids, np.unpackbits(mask, bitorder="little")) for ids, mask in parts]
        assert all(len(ids) == len(mask) == 64 for ids, mask in parts)
        assert [int(mask.sum()) for _, mask in parts] == [
            min(64, r["n_tokens"] - 64 * k) for k in range(n)]
        with pytest.raises(IndexError):
            token_files.sequence(r["path"], n)


def test_random_access_over_many_batches(frame):
    texts = [(i, "a b c d e f g h " * (i % 7 + 1)) for i in range(900)]
    manifest = token_files.write(frame(texts), tokens.default_path(NAMES[1]), seq_len=16)
    r = manifest.orderBy("part").first()
    reader = pa.ipc.open_file(pa.memory_map(r["path"].removeprefix("file://")))
    sizes = [reader.get_batch(k).num_rows for k in range(reader.num_record_batches)]
    assert len(sizes) > 1 and set(sizes[:-1]) == {token_files._BATCH}
    flat = np.concatenate([reader.get_batch(k).column("ids").flatten().to_numpy() for k in range(len(sizes))])
    for k in (0, 255, 256, sum(sizes) - 1):
        ids, mask = token_files.sequence(r["path"], k)
        assert ids.tolist() == flat[16 * k:16 * k + 16].tolist()
        assert not ids.flags.owndata and not mask.flags.owndata


def test_wide_ids_do_not_wrap(frame):
    """An end id beyond 16 bits makes the ids 32 bits wide."""
    manifest = token_files.write(frame([(1, "a b"), (2, None)]), tokens.default_path(NAMES[1]),
                                 end_id=70_000, seq_len=16)
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist()
           for r in token_files.read(manifest).collect()}
    assert got == {1: library(["a b"], NAMES[1])[0] + [70_000], 2: [70_000]}


def test_files_of_lost_attempts_are_not_read(odd):
    manifest = token_files.write(odd, tokens.default_path(NAMES[1]), seq_len=64)
    before = rows(token_files.read(manifest).select("doc_id", "start"))
    path = manifest.first()["path"].removeprefix("file:")
    with open(os.path.join(os.path.dirname(path), "part-000000-00000-lost.arrow"), "wb") as f:
        f.write(b"half a file")
    assert rows(token_files.read(manifest).select("doc_id", "start")) == before


def test_packing(odd, empty):
    path = tokens.default_path(NAMES[0])
    table = packing.pieces(odd, path, capacity=64)
    out = packing.pack(table, 64)
    src = [(r["doc_id"], r["text"]) for r in odd.collect()]
    ids = [x + [2] for x in library([t or "" for _, t in src], NAMES[0])]
    expected = []
    for (d, _), x in zip(src, ids):
        first = (len(x) - 1) % 64 + 1
        cuts = [0, *range(first, len(x) + 1, 64)]
        expected += [(d, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes()))
                     for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = out.select("doc_id", "piece", "start", "length", F.crc32("ids")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    by = {}
    for r in out.collect():
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], bytes(r["ids"])))
    for s in by.values():
        s.sort()
        assert [o for o, _, _ in s] == list(np.cumsum([0] + [n for _, n, _ in s])[:-1])
        assert sum(n for _, n, _ in s) <= 64
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(out).collect()}
    assert joined == {k: b"".join(i for _, _, i in s) for k, s in by.items()}
    total = sum(len(x) for x in ids)
    assert len(by) <= 1.05 * total / 64 + 2
    assert packing.pack(packing.pieces(empty, path)).count() == 0


@settings(max_examples=40, deadline=None, database=None, derandomize=True)
@given(st.dictionaries(st.integers(1, 48), st.integers(1, 400), max_size=20))
def test_plan_places_every_piece_once(counts):
    hist = np.zeros(49, np.int64)
    for k, n in counts.items():
        hist[k] = n
    back = np.zeros(49, np.int64)
    total = 0
    for pattern, n in packing.plan(hist, 48):
        assert n > 0 and sum(pattern) <= 48
        total += n
        for k in pattern:
            back[k] += n
    assert (back == hist).all()
    # Best-fit decreasing alone is near the optimum; the plan must stay close to it.
    assert total <= 1.1 * sum(n for _, n in packing.best_fit(hist, 48)) + 2


def test_nnls_fits_an_exact_histogram():
    pats = packing.patterns(np.array([10, 22, 16, 32]), 48)
    assert sorted(map(tuple, pats.tolist())) == [(16, 16, 16), (22, 16, 10), (32, 16, 0)]
    hist = np.zeros(49)
    hist[32], hist[16] = 100, 100 + 30
    x = packing.nnls(pats, hist)
    fit = dict(zip(map(tuple, pats.tolist()), x))
    assert fit[32, 16, 0] == pytest.approx(100, abs=0.5)
    assert fit[16, 16, 16] == pytest.approx(10, abs=0.5)


@pytest.mark.parametrize("n", [10_000, 60_000])
def test_patterns_place_most_pieces(n):
    """Long-tailed lengths: patterns do the packing, best fit the rest, in no more sequences."""
    lens = np.clip(np.exp(np.random.default_rng(n).normal(5.6, 1.0, n)), 2, None).astype(int)
    hist = np.bincount((lens - 1) % 1024 + 1, minlength=1025)
    hist[1024] += int(((lens - 1) // 1024).sum())
    out, left = packing.fitted(hist, 1024)
    assert left.sum() <= 0.15 * hist.sum()
    alone = sum(k for _, k in packing.best_fit(hist, 1024))
    assert sum(k for _, k in packing.plan(hist, 1024)) <= 1.001 * alone + 2
    assert sum(k for _, k in out) * 1024 >= sum(k * sum(p) for p, k in out)
