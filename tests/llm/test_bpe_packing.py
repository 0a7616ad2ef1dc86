import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from nearkin.llm import bpe, packing
from nearkin.session import stored

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


TEXTS = st.text(alphabet=st.one_of(
    st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 　'.!?aAzZ09éß日🙂<|>"), st.characters(exclude_categories=["Cs"])
), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_any_text_encodes_as_the_library_does(text):
    own = bpe.codec(PATH)
    raw = own.encode(text)
    assert np.frombuffer(raw, "<u4").tolist() == ids_of(text)
    words = own.words(text)
    assert "".join(words) == text
    assert b"".join(own.encode_words(words)) == raw


def test_special_tokens_inside_a_text():
    text = "a<|endoftext|> b  <|endoftext|>"
    assert np.frombuffer(bpe.codec(PATH).encode(text), "<u4").tolist() == ids_of(text)
    assert 50256 in ids_of(text)


def test_round_trip_of_awkward_rows(awkward, awkward_rows, monkeypatch):
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode_digests(awkward, PATH).collect())
    want = []
    for doc_id, text in awkward_rows:
        ids = ids_of(text)
        raw = np.array(ids, "<u4").tobytes()
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want)


def test_decode_is_what_encode_can_add(awkward):
    both = bpe.encode(awkward, PATH, decoded=True).collect()
    apart = bpe.decode(bpe.encode(awkward, PATH), PATH).collect()
    assert sorted(map(tuple, both)) == sorted(map(tuple, apart))


def test_texts_read_in_another_order_are_encoded_anyway(awkward, awkward_rows, monkeypatch):
    monkeypatch.setattr(bpe, "_encode_buckets", lambda path: lambda batches: iter(()))
    got = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in bpe.encode(awkward, PATH).collect())
    assert got == sorted((i, ids_of(t)) for i, t in awkward_rows)


def test_decode_replaces_what_is_no_text(spark):
    ids = np.array([LIBRARY.encode("é").ids[0], *LIBRARY.encode("日").ids[:1]], "<u4").tobytes()[:8]
    frame = spark.createDataFrame([(1, bytearray(ids)), (2, None)], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in bpe.decode(frame, PATH).collect()}
    assert got[2] == "" and got[1] == LIBRARY.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def check_layout(pieces, rows, end_id=1):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append([*ids_of(text), end_id])
    for doc_id, found in by_doc.items():
        flat = sorted((r.start, r.length, bytes(r.ids)) for r in found)
        want = texts[doc_id]
        assert sum(r.length for r in found) == sum(map(len, want))
        if len(want) == 1:
            at = 0
            for start, length, raw in flat:
                assert start == at and np.frombuffer(raw, "<u4").tolist() == want[0][start : start + length]
                at += length
    assert by_doc.keys() == texts.keys()
    ids = sorted(by_sequence)
    assert ids == list(range(len(ids)))
    for sequence in ids:
        at = 0
        for r in sorted(by_sequence[sequence], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == packing.SEQUENCE_TOKENS or sequence == ids[-1]
        assert all(at <= r.padded_to <= packing.SEQUENCE_TOKENS for r in by_sequence[sequence])


def test_pieces_cover_every_token_once(awkward, awkward_rows):
    check_layout(packing.pack_documents(awkward, PATH).collect(), awkward_rows)


def test_windows_hold_the_target_proportions(docs_of):
    texts = ["lorem ipsum dolor " * (20 + i % 7) for i in range(600)]
    docs = docs_of(texts, sources=["big" if i % 3 else "small" for i in range(600)]).repartition(5, "doc_id")
    tokens = stored(packing.tokenise(docs, PATH), "test-tokens")
    total = {r.source: r.n for r in tokens.groupBy("source").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "n").collect()}
    for weights in (None, {"big": 1.0, "small": 1.0}, {"small": 3.0}):
        pieces = packing.pack(tokens, weights, window_tokens=4096).collect()
        assert sum(r.length for r in pieces) == sum(total.values())
        held = defaultdict(lambda: defaultdict(int))
        for r in pieces:
            held[r.sequence_id // 2][r.source] += r.length
        shares = total if weights is None else {"big": weights.get("big", 0), "small": weights["small"]}
        # Until the first queue is empty.
        served = defaultdict(int)
        for window in sorted(held)[:-1]:
            for source in shares:
                served[source] += held[window][source]
            if weights and any(served[s] >= total[s] for s in shares):
                break
            for source, share in shares.items():
                assert abs(held[window][source] - 4096 * share / sum(shares.values())) <= 2
        check_layout(pieces, list(enumerate(texts)))


@pytest.mark.parametrize("totals", [{"a": 1}, {"a": 7, "b": 1000, "c": 1}, {"a": 333, "b": 333, "c": 334}, {str(i): i for i in range(40)}])
@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 1}])
def test_schedule_is_a_bijection(totals, weights):
    schedule = packing.Schedule(totals, weights, 64)
    places = []
    for source, n in totals.items():
        at = 0
        while at < n:
            for offset, place, length in schedule.pieces(source, at, min(5, n - at)):
                places += range(place, place + length)
            at += min(5, n - at)
    assert sorted(places) == list(range(sum(totals.values())))


def test_empty_table(empty):
    assert packing.pack_documents(empty, PATH).count() == 0
    assert bpe.encode_decode_digests(empty, PATH).count() == 0


def test_sources_beyond_the_largest_share_queues(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 6)
    monkeypatch.setattr(packing, "SHARED_QUEUES", 3)
    texts = ["lorem ipsum " * (1 + i % 5) for i in range(90)]
    docs = docs_of(texts, sources=["big" if i % 2 else f"rare{i % 31}" for i in range(90)]).repartition(4, "doc_id")
    for weights in (None, {"big": 1.0, "rare4": 2.0}):
        pieces = packing.pack_documents(docs, PATH, weights).collect()
        check_layout(pieces, list(enumerate(texts)))
    with pytest.raises(ValueError, match="sources"):
        packing.pack_documents(docs, PATH, {f"rare{i}": 1.0 for i in range(9)})


def test_long_words_are_not_kept(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHARS", 5)
    own = bpe.Codec(PATH)
    text = "short " + "x" * 300 + " 日本語日本語日本語 short " + "x" * 300
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids_of(text)
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids_of(text)
    assert max(map(len, own.cache)) <= 5 + 1
