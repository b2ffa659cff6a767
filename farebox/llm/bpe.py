"""Operator 1: byte-pair encoding and decoding with forced boundaries.

No merge ever makes a token that holds a byte pair which occurs inside no token
of the vocabulary, so such a pair is a certain cut: what stands left and right
of it is encoded independently and the ids are concatenated.  Cuts are taken
where the left character is one of ASCII or U+00C0 to U+07FF and no white space and the right
byte starts a character other than an apostrophe.  There the splitting pattern of the tokenizer
(no look-behind; look-ahead only after white space; contractions only from an
apostrophe on) finds the same pieces in the parts as in the whole.

Every certain cut is taken; fragments are mostly words.  A fragment met again is not encoded again but copied from a memo, which a
worker keeps with the tables of the file (``codec``).  A fragment is as long as the text
allows, not bounded: a text without a certain cut, such as one without ASCII or a run of one
letter, is a single step of any length.  The merges of plain fragments are done by tiktoken
with the ranks of the same file, which gives the ids of the tokenizers library in a fifth of
its time (tested against it); all others by the tokenizers library itself.

Defined cases: a null text is empty and has no ids; added tokens inside a text
become their ids, as the library does; ids decode to UTF-8 with U+FFFD in place
of invalid bytes; equal rows give equal rows; extra columns pass through
``encode`` (a column already named like the output is replaced).
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from farebox.llm.common import slices

#: Fragments a worker remembers before it starts afresh, and the longest of them in bytes.
MEMO, MEMO_BYTES = 400_000, 64

#: Signs whose class may differ between Unicode versions; texts with them go to
#: the tokenizers library, as do those with an added token's first sign.
BEYOND = re.compile("[^\0-\u024f\u2010-\u2027\u2030-\u205e]")

# Fixed value: the splitting pattern of byte-level BPE files (public).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for
    themselves, the others for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memo(dict):
    """Fragment -> its ids as 32-bit bytes, worked out when first met."""

    def __init__(self, ids):
        super().__init__()
        self.ids = ids

    def __missing__(self, fragment: bytes) -> bytes:
        out = array("I", self.ids(fragment.decode())).tobytes()
        if len(fragment) <= MEMO_BYTES:
            if len(self) >= MEMO:
                self.clear()
            self[fragment] = out
        return out


class Codec:
    """Encoder and decoder for one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._spec = spec
        alphabet = byte_alphabet()
        vocab, added = spec["model"]["vocab"], spec["added_tokens"]
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in added)], default=-1))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(map(alphabet.__getitem__, token))
        for t in added:
            self.bytes_of[t["id"]] = t["content"].encode()
        # all tokens in one buffer; pairs over a token's end don't count
        flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        last = np.cumsum([len(t) for t in self.bytes_of if t]) - 1
        within = np.ones(max(len(flat), 1), bool)
        within[last] = False
        at = np.flatnonzero(within[:len(flat)])
        inside = np.zeros((256, 256), bool)
        inside[flat[at], flat[at + 1]] = True
        left, right = np.zeros(256, bool), np.ones(256, bool)
        left[0x21:0x7F] = True
        right[0x80:0xC0] = False
        right[ord("'")] = False
        #: pair (as 256 * left + right) -> certain cut
        self.cut = (~inside & left[:, None] & right[None, :]).ravel()
        last = np.zeros(256, bool)
        last[0x80:0xC0] = True
        #: the same for the last byte of a longer character, certain if that has two bytes and is no white space
        self.cut_long = (~inside & last[:, None] & right[None, :]).ravel()
        self.maybe = self.cut | self.cut_long
        self.merger = self._merger(spec["model"])
        self.memo = Memo(self._ids)

    @cached_property
    def tokenizer(self):
        """The tokenizers library's own; made when a fragment needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(json.dumps(self._spec | {"truncation": None, "padding": None}))

    def _merger(self, model: dict):
        """A faster merger with the same ranks, where the file's ids ascend with
        its merges, else None."""
        vocab = model["vocab"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged) or model.get("ignore_merges") or model.get("dropout"):
            return None
        import tiktoken

        known = set(vocab.values())
        return tiktoken.Encoding("pieces", pat_str=PATTERN, special_tokens={},
                                 mergeable_ranks={b: i for i, b in enumerate(self.bytes_of) if i in known})

    def fragments(self, raw: bytes) -> list[bytes]:
        """Bytes of a text, cut at every certain boundary."""
        b = np.frombuffer(raw, np.uint8)
        pair = (b[:-1].astype(np.uint16) << 8) | b[1:]
        at = np.flatnonzero(self.maybe[pair])
        lead = b[at - 1]  # of two-byte characters; those from 0xC3 to 0xDF hold no white space
        at = at[self.cut[pair[at]] | (lead >= 0xC3) & (lead <= 0xDF)]
        out = np.full(len(b) + len(at), 0xFF, np.uint8)  # a byte that no text holds, at every cut
        own = np.ones(len(out), bool)
        own[at + np.arange(1, len(at) + 1)] = False
        out[own] = b
        return out.tobytes().split(b"\xff")

    def _ids(self, text: str) -> list[int]:
        if self.merger and "<" not in text and (text.isascii() or not BEYOND.search(text)):
            return self.merger.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers: those of its fragments."""
        if not text:
            return np.empty(0, np.uint32)
        return np.frombuffer(b"".join(map(self.memo.__getitem__, self.fragments(text.encode()))), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file, built once for the life of a worker."""
    return Codec(path)


def id_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """Arrow list column of 32-bit ids."""
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([np.empty(0, np.uint32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _texts(batch: pa.RecordBatch, col: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(col)).to_pylist()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of token ids (array of int) in place of the text."""
    keep = [f for f in docs.schema.fields if f.name not in (text, ids)]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in slices(batches):
            got = id_lists([own.encode(t) for t in _texts(b, text)])
            kept = b.select(names)
            yield pa.RecordBatch.from_arrays([*kept.columns, got], names=[*names, ids])

    schema = T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return docs.select(*[f"`{n}`" for n in names], text).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text that its ids stand for in place of the ids; null ids
    give an empty text."""
    keep = [f for f in df.schema.fields if f.name not in (text, ids)]
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in slices(batches):
            got = [own.decode(np.array(i or [], np.uint32)) for i in _texts(b, ids)]
            kept = b.select(names)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(got, pa.string())], names=[*names, text])

    schema = T.StructType([*keep, T.StructField(text, T.StringType())])
    return df.select(*[f"`{n}`" for n in names], ids).mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode, decode the ids, and digest both in one pass over the texts:
    doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        name = [str(i) for i in range(len(own.bytes_of))]

        def sha(x: str) -> str:
            return hashlib.sha256(x.encode()).hexdigest()

        for b in slices(batches):
            n, of_ids, of_text = [], [], []
            for t in _texts(b, "text"):
                ids = own.encode(t)
                n.append(len(ids))
                of_ids.append(sha(",".join(map(name.__getitem__, ids.tolist()))))
                of_text.append(sha(own.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
