import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldmill.llm import packing

TOOL = Tokenizer.from_file(packing.default_tokenizer())
TOOL.encode_special_tokens = True


def plain_ids(text):
    return TOOL.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab 's tlrevmd12.,\n\t'é 中<|>", max_size=40), max_size=6))
def test_ids_are_those_of_the_library(texts):
    got = packing.token_ids(texts, packing.default_tokenizer())
    assert [g.tolist() for g in got] == [plain_ids(t) for t in texts]


def test_long_texts_are_cut_without_changing_ids():
    text = "Some words  here, it's \n fine " * 400
    parts = packing.segments(text, 500)
    assert len(parts) > 10 and "".join(parts) == text
    ids = [i for p in parts for i in packing.token_ids([p], packing.default_tokenizer())[0].tolist()]
    assert ids == plain_ids(text)
    assert packing.segments("x" * 2000, 500) == ["x" * 2000]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_bins_hold_every_piece_once(lengths):
    lengths = np.array(lengths)
    bins, places = packing.fill_bins(lengths, 64)
    for number in range(bins.max() + 1):
        mine = bins == number
        order = np.argsort(places[mine])
        ends = np.cumsum(lengths[mine][order])
        assert ends[-1] <= 64 and places[mine][order].tolist() == [0, *ends[:-1].tolist()]
    assert bins.max() + 1 <= -(-11 * -(-lengths.sum() // 64) // 9) + 1 or lengths.max() > 21


def test_exact_fill_is_found():
    bins, _ = packing.fill_bins(np.array([60, 50, 40, 30, 20, 34, 14, 4, 4]), 64)
    assert bins.max() + 1 == 4


def test_pieces_cover_documents(spark, odd, empty):
    got = packing.packed(odd, size=64, with_ids=True).toPandas()
    assert packing.packed(empty).count() == 0
    longest = got[got["doc_id"] == 8].sort_values("piece")
    ids = plain_ids(odd.where("doc_id = 8").first().text) + [0]
    assert b"".join(longest["ids"]) == np.array(ids, "<u4").tobytes()
    assert (longest["length"].iloc[1:] == 64).all() and longest["start"].iloc[0] == 0
    assert all(zlib.crc32(i) == c for i, c in zip(got["ids"], got["ids_crc32"]))
    assert got[got["doc_id"] == 1]["length"].tolist() == [1]
    assert got["doc_id"].isna().sum() == 1 and (got["doc_id"] == 6).sum() == 2
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        ends = part["length"].cumsum()
        assert part["offset"].tolist() == [0, *ends.tolist()[:-1]] and ends.iloc[-1] <= 64
