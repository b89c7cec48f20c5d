"""Token files and piece codec against their libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import samples
from hypothesis import given, settings
from hypothesis import strategies as st

from rotorlake.llm import piece_codec, token_files
from rotorlake.llm.texts import flat

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'aAbé▁ x1  "), st.characters(exclude_categories=["Cs"])), max_size=40)


def pieces(values):
    import pyarrow as pa

    bounds, data = flat(pa.array(values, pa.string()))
    return bounds, data


def apart(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_parts_make_the_library_ids(values):
    code = token_files.encoder(TOKENIZER)
    known = [x.ids for x in code.tokenizer.encode_batch(values, add_special_tokens=False)]
    assert apart(*code.encode(*pieces(values))) == known


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_agenda_makes_the_library_pieces(values):
    code = piece_codec.codec(MODEL)
    got = apart(*code.encode(*pieces(values)))
    assert got == code.library.encode(values)
    assert [code.decode(x) for x in got] == [code.library.decode(x) for x in got]


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 31])
def test_bits_round_trip_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 999).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-999 * bits // 8)
    assert (token_files.unpack(packed, bits, 0, 999) == ids).all()
    assert (token_files.unpack(packed, bits, 37, 500) == ids[37:537]).all()
    assert token_files.width(50_257) == 16 and token_files.width(2) == 1 and token_files.width(65_537) == 17


def test_memo_starts_anew():
    code = piece_codec.Codec(MODEL)
    code.memo.max_parts = 3
    for _ in range(3):
        values = ["one two three four", "five six seven", "one two"]
        assert apart(*code.encode(*pieces(values))) == code.library.encode(values)


def test_files_give_back_all_ids_in_order(spark, tmp_path):
    data = samples.rows()
    token_files.write(samples.docs(spark, data), str(tmp_path / "t"), TOKENIZER, 2, block_ids=300, shard_docs=20)
    got = token_files.read(spark, str(tmp_path / "t")).orderBy("start").collect()
    code = token_files.encoder(TOKENIZER)
    known = {t: [*code.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in data}
    assert [r.doc_id for r in got] == sorted((i for i, _ in data), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    pairs = sorted((repr(r.doc_id), r.ids) for r in got)
    assert pairs == sorted((repr(i), known[t]) for i, t in data)
    blocks = spark.read.parquet(str(tmp_path / "t"))
    assert blocks.count() > 5 and blocks.select("bits").distinct().collect()[0][0] == 16


def test_codec_of_a_table(spark):
    data = samples.rows()
    got = piece_codec.encode(samples.docs(spark, data), MODEL).collect()
    lib = piece_codec.codec(MODEL).library
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for i, t in data:
        ids = lib.encode(t or "", add_eos=True)
        expected.append((repr(i), len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)), ids))
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got) == sorted(expected)


def test_empty_tables(spark, tmp_path):
    token_files.write(samples.docs(spark, []), str(tmp_path / "e"), TOKENIZER, 2)
    assert token_files.read(spark, str(tmp_path / "e")).collect() == []
    assert piece_codec.encode(samples.docs(spark, []), MODEL).collect() == []
