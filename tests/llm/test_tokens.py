import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import packing, simple8b, token_files, tokens

TEXTS = [
    None, "", " ", "\n", "one", "a  b", "x\n\ny", " lead", "trail ", "a\tb", "it's 12 don't", "\nfoo", "foo\n", "a <|endoftext|> b", "é\nü x", "a b", "The the THE", "foo.\nBar!! ***",
    "word " * 5000,
]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60000) | st.integers(0, 1), max_size=700))
def test_round_trip(values):
    block = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(block).tolist() == values


def test_frames_decode_alone():
    values = np.random.default_rng(0).integers(0, 1 << 20, 20_000).astype(np.uint64)
    values[::5] = 0
    block = simple8b.encode(values)
    parts = [simple8b.decode(block, k, k + 1) for k in range(20)]
    assert np.concatenate(parts).tolist() == values.tolist()
    with pytest.raises(ValueError):
        simple8b.decode(b"x" * 64)


def test_small_ids_take_few_words():
    assert len(simple8b.encode(np.zeros(12_000, np.uint64))) < 1000
    assert len(simple8b.encode(np.full(6000, 1, np.uint64))) < 1200


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_cached_ids_are_the_tokenizers(name, kind):
    encoder = tokens.TextEncoder(tokens.vocabulary(name), kind)
    texts = [x or "" for x in TEXTS] * 2
    assert encoder.ids(texts) == [encoder.whole(x) for x in texts]


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_words_of_any_shape_get_the_tokenizers_ids(name, kind):
    encoder = tokens.TextEncoder(tokens.vocabulary(name), kind)
    letters = "abcdeghinorstuABCÀÉßØöÿŸœƒªºµ²Ⅷ0 189" + "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "' ' ,.,.  \n"

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.text(letters, max_size=40), max_size=4))
    def check(texts):
        assert encoder.ids(texts) == [encoder.whole(x) for x in texts]

    check()
    long = "".join(chr(97 + i * i % 26) for i in range(20_000))
    assert encoder.ids([long + ", x", long]) == [encoder.whole(long + ", x"), encoder.whole(long)]
    assert max(map(len, encoder.known)) <= tokens.CACHE_CHARS


def table_of(spark, texts=TEXTS):
    rows = [(i * 3, x) for i, x in enumerate(texts)]
    rows += [rows[4], (None, "nameless"), (6, "another text")]  # a repeated row, a null id, an id that comes twice
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "'x' AS payload").repartition(3)


def test_token_files(spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    vocabulary = tokens.vocabulary("byte_bpe_50k.json")
    docs = table_of(spark)
    token_files.write_tokens(docs, path, vocabulary, block_ids=500)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: -1 if x is None else x) and len(ids) == docs.count()
    encoder = tokens.TextEncoder(vocabulary, "byte")
    want = sorted((r.doc_id or -1, encoder.whole(r.text or "") + b"\0\0\0\0") for r in docs.collect())
    have = sorted((r.doc_id or -1, np.array(r.ids, "<u4").tobytes()) for r in got)
    assert have == want
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    digest = token_files.token_digest(spark, path).collect()
    assert sorted(str(tuple(r)) for r in digest) == sorted(str((r.doc_id, r.start, r.n_tokens, r.ids_crc32)) for r in got)


def test_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    vocabulary = tokens.vocabulary("word_bpe_49k.json")
    token_files.write_tokens(empty, f"file://{tmp_path}/none", vocabulary, kind="word")
    assert token_files.read_tokens(spark, f"file://{tmp_path}/none").count() == 0
    assert packing.packed_documents(empty, vocabulary).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.data())
def test_best_fit_is_best_fit_decreasing(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=60))
    bins, offsets, n = packing.best_fit(lengths, capacity)
    left: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [(x, k) for k, x in enumerate(left) if x >= length]
        if fits:
            left[min(fits)[1]] -= length
        else:
            left.append(capacity - length)
    assert n == len(left)
    full: dict[int, int] = {}
    for b, at, length in sorted(zip(bins, offsets, lengths, strict=True)):
        assert full.get(b, 0) == at
        full[b] = at + length
        assert full[b] <= capacity


@pytest.mark.parametrize("group_pieces", [1 << 17, 7])
def test_packed_documents(spark, group_pieces):
    docs = table_of(spark)
    vocabulary = tokens.vocabulary("word_bpe_49k.json")
    got = packing.packed_documents(docs, vocabulary, capacity=64, group_pieces=group_pieces).collect()
    encoder = tokens.TextEncoder(vocabulary, "word")
    want = []
    for r in docs.collect():
        ids = encoder.whole(r.text or "") + b"\1\0\0\0"
        want += [(r.doc_id, k, at // 4, len(ids[at : at + 256]) // 4, zlib.crc32(ids[at : at + 256])) for k, at in enumerate(range(0, len(ids), 256))]
    assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got) == sorted(map(str, want))
    places: dict[int, int] = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert places.get(r.sequence_id, 0) == r.offset
        places[r.sequence_id] = r.offset + r.length
    assert max(places.values()) <= 64
