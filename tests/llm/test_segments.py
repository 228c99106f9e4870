from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from landfall.llm import common, pieces, prefixes, segments
from landfall.llm.common import text_slices

BPE = public_tokenizers.path("byte_bpe_50k.json")
SPM = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", " ", "  ", "\n", "\r\n", "\t", "'", "'ll", "'s", "é", " ", "　", " ", "😀", "1", "23", "!", "--", "<|endoftext|>", "<|end", "漢", "▁", " " * 17, "\x1c", "ab"]
texts = st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), st.text(max_size=12)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_ids_are_the_librarys(items):
    held = segments.encoder(BPE)
    for s in text_slices(pa.array([*items, None], pa.string())):
        ids, first = held.encode(s)
        for i, t in enumerate([*items, ""]):
            assert ids[first[i]:first[i + 1]].tolist() == held.tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(0, 8))
def test_counts_of_every_prefix(items, limit):
    held = prefixes.counter(BPE)
    count = lambda t: len(held.tokenizer.encode(t, add_special_tokens=False).ids)
    for s in text_slices(pa.array(items, pa.string())):
        flat, first = held.every_prefix(s)
        total, fits = held.longest_prefix(s, limit)
        for i, t in enumerate(items):
            want = [count(t[:k]) for k in range(1, len(t) + 1)]
            assert flat[first[i]:first[i + 1]].tolist() == want
            assert total[i] == (want[-1] if want else 0)
            assert fits[i] == max([0, *(len(t[:k].encode()) for k, c in enumerate(want, 1) if c <= limit)])


@settings(max_examples=150, deadline=None)
@given(texts)
def test_pieces_are_the_librarys(items):
    held, library = pieces.model(SPM), sentencepiece.SentencePieceProcessor(model_file=SPM)
    for s in text_slices(pa.array([*items, None], pa.string())):
        ids, first = held.encode(s)
        data, offsets = held.decode(ids.astype(np.int64), first)
        for i, t in enumerate([*items, ""]):
            want = library.encode(t)
            assert ids[first[i]:first[i + 1]].tolist() == want
            assert data[offsets[i]:offsets[i + 1]].tobytes().decode() == library.decode(want)


def all_ways(text, scores):
    if not text:
        yield 0.0, []
    for n in range(1, len(text) + 1):
        if text[:n] in scores:
            for s, rest in all_ways(text[n:], scores):
                yield s + scores[text[:n]], [text[:n], *rest]


@settings(max_examples=60, deadline=None)
@given(st.text("abc", max_size=9), st.dictionaries(st.text("abc", min_size=2, max_size=4), st.floats(-9, -1), max_size=8))
def test_unigram_takes_the_best_sum(text, scores):
    scores = {**{c: -5.0 for c in "abc"}, **scores}
    m = pieces.PieceModel([("<unk>", 0.0, pieces.UNKNOWN), *((p, s, pieces.NORMAL) for p, s in scores.items())], dummy_prefix=False)
    got = m.segment(text)
    assert "".join(got) == text
    best = max(s for s, _ in all_ways(text, scores))
    assert abs(sum(scores[p] for p in got) - best) < 1e-9


def test_unknown_characters():
    plain = [("<unk>", 0.0, pieces.UNKNOWN), ("a", -1.0, pieces.NORMAL)]
    m = pieces.PieceModel(plain, dummy_prefix=False)
    assert [i for p in m.segment("aé") for i in m.encode_piece(p)] == [1, 0]
    m = pieces.PieceModel([*plain, *((f"<0x{b:02X}>", 0.0, pieces.BYTE) for b in range(256))], dummy_prefix=False)
    assert [i for p in m.segment("aé") for i in m.encode_piece(p)] == [1, 2 + 0xC3, 2 + 0xA9]


def test_stores_forget_and_go_on(monkeypatch):
    monkeypatch.setattr(segments, "STORE_SEGMENTS", 5)
    held = segments.SegmentEncoder(BPE)
    for k in range(20):
        t = f"word{k} other{k} again"
        for s in text_slices(pa.array([t])):
            assert held.encode(s)[0].tolist() == held.tokenizer.encode(t, add_special_tokens=False).ids


def test_hash_store():
    rng = np.random.default_rng(0)
    store = segments.HashStore(5)
    key, check = rng.integers(1, 40, 300).astype(np.uint64), rng.integers(0, 2**60, 300).astype(np.uint64)   # keys collide
    key, check = map(np.array, zip(*dict.fromkeys(zip(key.tolist(), check.tolist()))))
    key, check = key.astype(np.uint64), check.astype(np.uint64)
    store.add(key, check, np.arange(len(key), dtype=np.int32))
    assert store.find(key, check).tolist() == list(range(len(key)))
    assert (store.find(key, check + np.uint64(1)) == -1).all()


def test_new_segments_reach_the_library_in_bounded_pieces():
    """What the library holds for a string while it encodes it is many times the string."""
    held, given_to = segments.SegmentEncoder(BPE), []

    class Library:
        def __init__(self, real):
            self.real = real

        def encode(self, text, **kw):
            given_to.append(len(text.encode()))
            return self.real.encode(text, **kw)

        def encode_batch_fast(self, texts, **kw):
            given_to.append(sum(len(x.encode()) for x in texts))
            return self.real.encode_batch_fast(texts, **kw)

    real, held.tokenizer = held.tokenizer, Library(held.tokenizer)
    text = " ".join(f"w{i * 7919}" + ("é" if i % 5 == 0 else "x") for i in range(40_000))
    (s,) = text_slices(pa.array([text], pa.string()))
    ids, first = held.encode(s)
    assert max(given_to) <= 1 << 17 and sum(given_to) == len(text.encode())
    assert ids[first[0]:first[1]].tolist() == real.encode(text, add_special_tokens=False).ids


def resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


def test_a_worker_gives_back_what_a_stage_held(monkeypatch):
    stage = [-1]
    monkeypatch.setattr(common, "_HELD", {"stage": None, "objects": {}})
    monkeypatch.setattr(common, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(stageId=lambda: stage[0])))
    # blocks too small to be mapped by themselves; the last one keeps the heap's top in place
    blocks = common.kept("blocks", lambda: [bytes([i % 255 + 1]) * 100_000 for i in range(1500)])
    top, full = blocks[-1], resident_mb()
    del blocks
    common.span_hash(np.zeros(10, np.uint8), np.array([0]), np.array([10]))
    assert common._POWERS
    stage[0] = -2
    common.kept("other", list)
    assert len(top) == 100_000 and full - resident_mb() > 100
    assert not common._POWERS


def test_powers_are_as_long_as_the_slices_need():
    common._POWERS.clear()
    for n in (1, 2, common.SLICE_BYTES // 4 + 1, common.SLICE_BYTES // 4 + 2, common.SLICE_BYTES + 1):
        up, down = common._powers(0, n)
        assert n <= len(up) == len(down) <= n + common.SLICE_BYTES // 4
        assert np.all(up[:n] * down[:n] == 1)
