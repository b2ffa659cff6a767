import hashlib
import random
import zlib

import numpy as np
import pytest

import farebox.llm.bpe as bpe
import farebox.llm.tokenstore as ts
from farebox.llm.catalog import op1_bpe_round_trip, op7_token_store, vocabulary_path
from tests.llm.helpers import frame, rows, save


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("memo", [1, 50, 200_000])
def test_fragments_encode_like_the_whole(library, monkeypatch, memo):
    monkeypatch.setattr(bpe, "MEMO", memo)
    codec, rng = bpe.Codec(vocabulary_path()), random.Random(memo)
    alphabet = " \n\t'srevmldt LL'll <|endoftext|> 12éß—　 \x1c\x85日本!?.,-_$%\r\x0b\x00\x7f👍xq"
    for _ in range(4000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.1:
            s += "<|endoftext|>" + s[::-1]
        ids = codec.encode(s)
        assert ids.tolist() == ids_of(library, s), s
        assert codec.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_texts_without_a_certain_cut_are_one_step(library):
    codec = bpe.Codec(vocabulary_path())
    for text in ("日本語" * 2000, "a" * 9000):
        assert codec.fragments(text.encode()) == [text.encode()]
        assert codec.encode(text).tolist() == ids_of(library, text)
    assert len(codec.fragments(b"some words; (and more) " * 3000)) > 1


def test_cuts_hold_no_pair_of_any_token(library):
    codec = bpe.Codec(vocabulary_path())
    for token in codec.bytes_of:
        assert not any(codec.cut[256 * a + b] for a, b in zip(token, token[1:]))


def test_texts_are_cut_after_two_byte_characters_but_not_after_white_space(library):
    codec, rng = bpe.Codec(vocabulary_path()), random.Random(7)
    assert codec.fragments(" été ã ü".encode()) == [x.encode() for x in (" été", " ã", " ü")]
    for space in ("\x85", "\xa0", "\u2003", "\u3000"):
        assert codec.fragments(f"é{space} a".encode())[-1].decode().endswith(f"{space} a")
    alphabet = "éàüñçß×÷ſʼ\u0301\u0308ΩλЖяא\u07ff\x85\xa0\u2003 \t\n's,.1aEt"
    for _ in range(4000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert codec.encode(s).tolist() == ids_of(library, s), s


def test_decode_of_broken_bytes(library):
    codec = bpe.Codec(vocabulary_path())
    for ids in ([220, 156, 98], [121, 122], [], [50256]):
        assert codec.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_encode_and_decode_frames(spark, library):
    out = bpe.encode(frame(spark), vocabulary_path())
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "key", "score", "ids"]
    back = bpe.decode(out, vocabulary_path()).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(r[0]), r[1] or "") for r in rows())
    assert bpe.encode(frame(spark, []), vocabulary_path()).count() == 0


def test_op1_digests(spark, library, tmp_path):
    got = op1_bpe_round_trip(spark, save(spark, tmp_path, documents=frame(spark))).collect()
    want = []
    for doc, text, *_ in rows():
        ids = ids_of(library, text)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text or "")]
        want.append((str(doc), len(ids), *sha))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_code_lengths_are_complete_and_optimal():
    rng = np.random.default_rng(1)
    for n in (2, 3, 7, 100):
        counts = rng.integers(1, 1000, n)
        lengths = ts.code_lengths(counts, 16)
        assert (2.0 ** -lengths).sum() == pytest.approx(1)
        heap, cost = sorted(counts.tolist()), 0  # plain Huffman cost
        while len(heap) > 1:
            a, b, *heap = heap
            cost += a + b
            heap = sorted([a + b, *heap])
        assert (lengths * counts).sum() == cost
    skewed = 2 ** np.arange(30)
    limited = ts.code_lengths(skewed, 6)
    assert limited.max() <= 6 and (2.0 ** -limited).sum() <= 1
    with pytest.raises(ValueError):
        ts.code_lengths(np.ones(9, int), 3)


def test_pack_and_unpack_blocks():
    rng = np.random.default_rng(2)
    for n in (1, 2, ts.BLOCK, ts.BLOCK + 1, 5000):
        x = rng.zipf(1.4, n).clip(1, 3000)
        ids, counts = np.unique(x, return_counts=True)
        lengths = ts.code_lengths(counts)
        codes = ts.canonical(ids, lengths)
        at = np.searchsorted(ids, x)
        payload, marks = ts.pack(codes[at], lengths[at])
        assert ts.Table(ids, lengths).unpack(payload, marks, n).tolist() == x.tolist()


@pytest.mark.parametrize("segment", [50, 1 << 18])
def test_op7_reads_back_what_it_wrote(spark, library, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(ts, "SEGMENT", segment)
    got = op7_token_store(spark, save(spark, tmp_path, documents=frame(spark))).collect()
    ordered = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for doc, text, *_ in ordered:
        ids = [*ids_of(library, text), 0]
        want.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_op7_of_an_empty_table(spark, tmp_path):
    assert op7_token_store(spark, save(spark, tmp_path, documents=frame(spark, []))).count() == 0
