import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from medallion.llm.packing import _Packer, best_fill, encode, encoder, pack
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=5), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_best_fill_is_the_best_of_all_multisets(counts, space):
    lengths = sorted(counts)
    best = max(
        total
        for used in product(*(range(counts[n] + 1) for n in lengths))
        if (total := sum(n * c for n, c in zip(lengths, used, strict=True))) <= space
    )
    taken = best_fill(lengths, counts, space)
    used = defaultdict(int)
    for length, count in taken:
        used[length] += count
    assert all(used[n] <= counts[n] for n in used)
    assert sum(n * c for n, c in used.items()) == best


@given(st.lists(st.integers(1, 200), max_size=60), st.sampled_from([16, 64]))
@settings(max_examples=60, deadline=None)
def test_every_id_lies_in_one_piece_and_sequences_are_full(sizes, capacity):
    packer = _Packer(capacity, 7, True)
    for doc, size in enumerate(sizes):
        packer.add(doc, np.arange(size, dtype=np.uint32))
        if doc % 7 == 0:
            packer.fill()
    packer.finish()
    docs, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, size, sequence, offset, ids in packer.out:
        assert size == sizes[doc] and list(ids) == list(range(start, start + length))
        assert crc == zlib.crc32(ids.astype("<u4").tobytes())
        docs[doc].append((start, length))
        sequences[sequence].append((offset, length))
    for doc, size in enumerate(sizes):
        end = 0
        for start, length in sorted(docs[doc]):
            assert start == end
            end += length
        assert end == size
    used = []
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        used.append(end)
    assert all(n == capacity or (n < capacity and n & (n - 1) == 0) for n in used)
    assert sum(n != capacity for n in used) <= capacity.bit_length()


@pytest.mark.parametrize("text", ["", "Hello, world's  end\n\n x", "äöü 中文 🙂", "<|endoftext|> a", "a" * 5000])
def test_ids_are_those_of_the_tokenizer_file(text):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    assert encoder(PATH).encode_ordinary(text) == plain.encode(text, add_special_tokens=False).ids


def test_added_tokens_and_long_white_space_are_as_in_the_tokenizer():
    plain = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|>", "a <|endoftext|><|endoftext|>\n b", "<|endoftext", "", " " * 1_200_000 + "a", "x" + "\n" * 1_000_001]
    texts += ["x \t" * 3 + " \n" * 600_000 + " y", "<|endoftext|>" + " " * 1_200_000]
    for text in texts:
        ids = encode(PATH)(text)
        assert ids.dtype == np.uint32 and ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_keeps_the_ids_of_added_tokens_and_long_white_space(texts):
    values = ["one <|endoftext|> two", " " * 1_200_000]
    plain = Tokenizer.from_file(PATH)
    pieces = pack(texts(*values), PATH, tokens=True).toPandas().sort_values("start")
    whole = pieces.groupby("doc_id")["input_ids"].agg(lambda x: [i for p in x for i in p])
    for doc, text in enumerate(values):
        assert whole[doc] == [*plain.encode(text, add_special_tokens=False).ids, 0]


def test_documents_round_trip(documents):
    pieces = pack(documents, PATH, tokens=True).toPandas()
    plain = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in documents.collect()}
    whole = pieces.sort_values("start").groupby("doc_id")["input_ids"].agg(lambda x: [i for p in x for i in p])
    for doc, ids in whole.items():
        assert ids == [*plain.encode(texts[doc], add_special_tokens=False).ids, 0]
    assert set(whole.index) == set(texts)
    assert pieces.groupby("sequence_id")["length"].sum().max() == 1024


def test_odd_rows(odd, nothing):
    pieces = pack(odd, PATH).toPandas()
    assert pieces[pieces.start == 0].shape[0] == 13
    assert pieces[pieces.doc_id.isin([3, 4])].doc_tokens.tolist() == [1, 1]
    assert pack(nothing, PATH).count() == 0
