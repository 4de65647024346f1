import gc
import weakref
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperflow.llm import packing
from paperflow.llm.tokens import Encoder, vocabulary_path

from .helpers import docs, sf_docs

ODD = ["", "  ", "a\x0bb\x85c\xa0d", "İstanbul's ΣΑΣ é it's 12³ <|endoftext|>x don'T", "漢字 かな\x00z", "ſt ﬁ K Å", "a" * 300 + " 'S'll'",
       "x\x1cy\x1fz \xadsoft", "É'S Ünï¼½", "\r\n\r", "Th!! th!! TH?"]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(vocabulary_path())


def library(encoder, text):
    return encoder.whole.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_library(spark, encoder):
    texts = ODD + [r["text"] for r in sf_docs(spark).select("text").collect()[:60]]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library(encoder, text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_encoder_equals_the_library_on_any_text(text):
    e = test_encoder_equals_the_library_on_any_text.e
    assert np.frombuffer(e.ids(text), "<u4").tolist() == library(e, text)


test_encoder_equals_the_library_on_any_text.e = Encoder(vocabulary_path(), cache_entries=50)


def test_an_encoder_lives_as_long_as_its_task(spark, monkeypatch):
    from paperflow.llm import common

    monkeypatch.setattr(common, "small_batches", lambda df: df)
    taken = []

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, fn, schema):
            taken.append(fn)

    monkeypatch.setattr(common, "_TABLES", {})
    packing.token_pieces(Rows(), vocabulary_path())
    batch = common.pa.RecordBatch.from_arrays([common.pa.array([1]), common.pa.array(["a b"])], names=["doc_id", "text"])
    assert [b.num_rows for b in taken[0](iter([batch]))] == [1] and not common._TABLES


def test_the_fullest_bin_closes_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 8, 5)] == [(0, 0), (1, 0), (2, 0)]  # 8 was the fullest and closed
    assert bins.place(2) == (0, 6)  # bin 1 would have fitted exactly
    assert bins.place(5) == (2, 5)
    assert bins.place(10) == (3, 0)


def check_packing(spark, frame, rows, encoder, capacity=4096, **options):
    out = packing.pack_documents(frame, capacity=capacity, **options).collect()
    got, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for key, text, *_ in rows:
        ids = library(encoder, text or "") + [packing.END_ID]
        for p, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[key].append((p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in out)


def test_pieces_and_sequences(spark, encoder):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs(spark).collect()]
    sequences, tokens = check_packing(spark, sf_docs(spark), rows, encoder)
    assert sequences <= -(-tokens // 4096) + 1


def test_packing_edges(spark, encoder):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x " * 90), (3, "x " * 90), (4, " ")]
    check_packing(spark, docs(spark, rows), rows, encoder, capacity=16)
    check_packing(spark, docs(spark, rows), rows, encoder, capacity=16, open_bins=1, group_rows=3)
    assert packing.pack_documents(docs(spark, [])).count() == 0


def test_windows_of_arrivals():
    lengths = np.array([3, 9, 5, 7, 1, 8, 8])
    assert packing.arrivals(lengths, 3).tolist() == [1, 2, 0, 5, 3, 4, 6] and packing.arrivals(lengths, 1).tolist() == list(range(7))
    assert packing.arrivals(lengths, 100).tolist() == [1, 5, 6, 3, 2, 0, 4]


def test_few_open_bins_lose_little_and_the_bound_binds():
    """Against all pieces longest first with as many open bins as there are pieces."""
    rng = np.random.default_rng(6)
    lengths = np.minimum(4096, rng.lognormal(6.3, 1.1, 30_000).astype(int) + 1)

    def made(order, most):
        bins, early = packing.OpenBins(4096, most), 0
        for n in lengths[order].tolist():
            full, before = bins.open == most, bins.made
            bins.place(n)
            early += full and bins.made > before
        return bins.made, early

    best, _ = made(np.argsort(-lengths), 1 << 30)
    ours, early = made(packing.arrivals(lengths, packing.LOOK_AHEAD), packing.OPEN_BINS)
    assert early > 100 and ours <= 1.003 * best


def test_words_that_come_again_outlive_a_full_cache(monkeypatch):
    """New words alone go to the model, however many others pass between; long chunks are not kept."""
    e, asked = Encoder(vocabulary_path(), cache_entries=60), []
    piece = e._piece
    monkeypatch.setattr(e, "_piece", lambda p: asked.append(p) or piece(p))
    lines = [f"often seen words {''.join(chr(97 + int(c)) for c in str(k))}x {'long' * 30}" for k in range(200)]
    for line in lines:
        assert np.frombuffer(e.ids(line), "<u4").tolist() == e.whole.encode(line, add_special_tokens=False).ids
    assert [asked.count(w) for w in ("often", "seen", "words")] == [1, 1, 1]
    assert len(e.known) + len(e.old) < 80 and not any(len(w) > 64 for w in [*e.known, *e.old])


def test_an_encoder_goes_without_the_garbage_collector():
    e = Encoder(vocabulary_path())
    e.ids("some words")
    gone = weakref.ref(e)
    gc.disable()
    try:
        del e
        assert gone() is None
    finally:
        gc.enable()
