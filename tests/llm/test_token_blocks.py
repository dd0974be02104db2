"""Blocks coded side by side, and tokens of pieces kept in arrays."""

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lodestone.llm.hf_bpe import encoder
from lodestone.llm.rans import Decoder, Encoder, Table

HF = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n, size", [(0, 64), (1, 64), (64, 64), (70_001, 9_000), (300_000, 150_000)])
def test_blocks_side_by_side_are_those_coded_one_by_one(n, size):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_000).astype(np.uint32)
    table = Table.of(ids)
    blocks = Encoder(table).blocks(ids, size)
    assert blocks == [Encoder(table).block(ids[lo : lo + size]) for lo in range(0, n, size)]
    decoder = Decoder(table)
    assert (decoder.blocks(blocks) == ids).all() and decoder.blocks([]).size == 0
    if blocks:
        bad = [*blocks[:-1], blocks[-1] | {"crc32": blocks[-1]["crc32"] ^ 1}]
        with pytest.raises(ValueError):
            decoder.blocks(bad)


@pytest.mark.parametrize("offsets", [False, True])
def test_large_ids_and_pieces_met_again(offsets, monkeypatch):
    ids = np.array([0, 1 << 31, (1 << 32) - 1, 1 << 31, 5], np.uint32)
    assert (Table.of(ids).ranks(ids) == [0, 2, 3, 2, 1]).all()
    monkeypatch.setattr("lodestone.llm.hf_bpe.MOST_PIECES", 20)  # pieces are forgotten in between
    monkeypatch.setattr("lodestone.llm.hf_bpe.PIECES_AT_ONCE", 7)
    monkeypatch.setattr("lodestone.llm.common.worker_memory", lambda key, make: make())
    monkeypatch.setattr("lodestone.llm.hf_bpe.worker_memory", lambda key, make: make())
    coder, plain = encoder(HF, P.PATTERN, offsets, encode_special_tokens=False), Tokenizer.from_file(HF)
    rng = np.random.default_rng(2)
    for _ in range(6):
        texts = ["".join(rng.choice(["ab", "é", " ", "\n", "word,", "it's", " the", "!?", "42", "中", "\U0001f600"], 30)) for _ in range(20)] + [None, ""]
        got, many, *places = coder.rows(pa.array(texts))
        want = plain.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert got.tolist() == [i for e in want for i in e.ids] and many.tolist() == [len(e.ids) for e in want]
        if offsets:
            assert len(places[0]) == len(places[1]) == len(got)
