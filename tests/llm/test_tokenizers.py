import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from streamkit.llm import bpe, packing, transducer

SF = "/root/testdata/sf0.01"
TEXT = st.text(st.sampled_from(list("ab \n\t'sdtreLK1०éŁ▁İΣ́̈\x00\x1c\x85　漢🙂<|>/_")) | st.characters(codec="utf-8"), max_size=60)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(bpe.RANKS)), special_tokens={})


@pytest.fixture(scope="module")
def piece():
    return sentencepiece.SentencePieceProcessor(model_file=P.path(transducer.MODEL))


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(P.path(packing.TOKENIZER))


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_byte_bpe_query(spark, tik):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op2_byte_bpe(spark, SF).collect()}
    want = {}
    for i, t in texts(spark).items():
        ids = packed(tik.encode_ordinary(t))
        want[i] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert got == want


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_byte_bpe_round_trip(text):
    codec = bpe.codec(bpe.RANKS)
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(bpe.RANKS)), special_tokens={}) if not hasattr(test_byte_bpe_round_trip, "t") else test_byte_bpe_round_trip.t
    test_byte_bpe_round_trip.t = tik
    ids = codec.encode(text)
    assert ids == packed(tik.encode_ordinary(text)) and codec.decode(ids) == text.encode()


def test_encode_decode_frames(spark, odd_docs, no_docs):
    both = bpe.decode(bpe.encode(odd_docs)).collect()
    want = sorted((r.text or "").encode() for r in odd_docs.collect())
    assert sorted(bytes(r.bytes) for r in both) == want
    assert bpe.encode(no_docs).count() == 0


def test_token_count_query(spark, piece):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in transducer.op10_token_counts(spark, SF).collect()}
    want = {i: (len(t.encode()), n := len(piece.encode(t)), n > 4096) for i, t in texts(spark).items()}
    assert got == want


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_chunk_maps_compose(text, size):
    machine = transducer.compiled(transducer.MODEL)
    piece = getattr(test_chunk_maps_compose, "p", None) or sentencepiece.SentencePieceProcessor(model_file=P.path(transducer.MODEL))
    test_chunk_maps_compose.p = piece
    whole = transducer.SPACE + text.replace(" ", transducer.SPACE) if text else ""
    maps = [machine.chunk_map(whole[i:i + size]) for i in range(0, max(1, len(whole)), size)]
    left = maps[0]
    for m in maps[1:]:
        left = machine.compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = machine.compose(m, right)
    assert machine.total(left) == machine.total(right) == len(piece.encode(text))


def test_state_table_may_start_anew(monkeypatch, piece):
    machine = transducer.Transducer(transducer.compiled(transducer.MODEL).score)
    monkeypatch.setattr(transducer, "STATES", 50)
    monkeypatch.setattr(transducer, "WORDS", 5)
    for text in ["some words that reach many states", "and then others reach more", "zzz 123 tion"] * 3:
        assert machine.count(transducer.SPACE + text.replace(" ", transducer.SPACE)) == len(piece.encode(text))


def test_one_long_segment_keeps_the_table_bounded(monkeypatch, piece):
    """A text of one word of 60,000 characters: the table starts anew inside it."""
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöü") for _ in range(60_000))
    machine = transducer.Transducer(transducer.compiled(transducer.MODEL).score)
    monkeypatch.setattr(transducer, "STATES", 3000)
    monkeypatch.setattr(transducer, "STRIDE", 500)
    assert machine.count(transducer.SPACE + text) == len(piece.encode(text))
    assert len(machine.known) < 3000 + 500 + 1 and len(machine.alike) < 40_000


def test_count_chunks_as_rows(spark, odd_docs, no_docs, piece):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in transducer.count_tokens(odd_docs, chunk=5000).collect())
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), len(piece.encode(r.text or ""))) for r in odd_docs.collect())
    assert got == want
    assert transducer.count_tokens(no_docs).count() == 0


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_word_tokenizer(text):
    word = getattr(test_word_tokenizer, "w", None) or Tokenizer.from_file(P.path(packing.TOKENIZER))
    test_word_tokenizer.w = word
    assert packing.tokenizer(packing.TOKENIZER).ids(text) == packed(word.encode(text, add_special_tokens=False).ids)


def test_only_new_runs_are_split_into_words():
    word, asked = packing.WordTokenizer(P.path(packing.TOKENIZER)), []
    plain = word.split
    word.split = lambda text: asked.append(text) or plain(text)
    text = "Some words, it's said; some more"
    first = [word.ids(text) for _ in range(2)]
    asked.clear()
    assert [word.ids(text), word.ids(text)] == first and not asked
    assert word.ids(text + " here") == packed(word.library.encode(text + " here", add_special_tokens=False).ids) and asked == ["here"]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_texts_encoded_together(texts):
    """Also when kept runs go all the time."""
    word = getattr(test_texts_encoded_together, "w", None) or packing.WordTokenizer(P.path(packing.TOKENIZER))
    test_texts_encoded_together.w = word
    kept, packing.KEPT = packing.KEPT, 8
    try:
        assert word.ids_of(texts) == [packed(word.library.encode(t, add_special_tokens=False).ids) for t in texts]
    finally:
        packing.KEPT = kept


def check_packing(rows, docs, word):
    left = sorted((i is None, i or 0, packed([*word.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in docs)
    got, bins = {}, {}
    for r in rows:
        got.setdefault((r.doc_id is None, r.doc_id or 0), []).append((r.piece, r.start, r.length, r.ids_crc32))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = {}
    for none, i, ids in left:
        for p, at in enumerate(range(0, len(ids), 4 * 4096)):
            part = ids[at:at + 4 * 4096]
            want.setdefault((none, i), []).append((p, at // 4, len(part) // 4, zlib.crc32(part)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    return len(bins), -(-sum(x[2] for v in want.values() for x in v) // 4096)


def test_packing_query(spark, word):
    made, least = check_packing(packing.op4_best_fit_packing(spark, SF).collect(), texts(spark).items(), word)
    assert made <= least + 1 + least // 100


def test_packing_odd_rows_and_shards(spark, odd_docs, no_docs, word):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = packing.pieces(odd_docs).cache()
    packed_rows = packing.pack(items, shard=5)
    check_packing(packed_rows.collect(), docs, word)
    whole = [bytes(r.ids) for r in packing.sequences(packed_rows).collect()]  # equal pieces of a text may fill several
    assert sum(len(x) for x in whole) // 4 == sum(r.length for r in items.collect())
    assert packing.packed_documents(no_docs).count() == 0


def test_sum_of_squares_rule():
    """Against the definition: try every gap, count the squares."""
    rng, capacity = np.random.default_rng(3), 50
    lengths = rng.integers(1, capacity + 1, 300)
    bins, offsets = packing.sum_of_squares(lengths, capacity)
    gaps: dict[int, int] = {}
    for n, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        def after(h):
            left = dict(gaps)
            if h is not None:
                left[h] -= 1
            rest = (capacity if h is None else h) - n
            if rest:
                left[rest] = left.get(rest, 0) + 1
            return sum(v * v for v in left.values())
        best = min([after(h) for h, c in gaps.items() if c and h >= n] + [after(None)])
        h = None if o == 0 else capacity - o
        assert after(h) == best
        if h is not None:
            gaps[h] -= 1
        rest = (capacity if h is None else h) - n
        if rest:
            gaps[rest] = gaps.get(rest, 0) + 1
