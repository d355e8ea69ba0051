"""Operator 6: byte-level BPE, backtracking encoder and offset-table decoder.

The encoder never replays merges. A sequence of tokens is the BPE result of
its text exactly if every two neighbours are compatible: no merge across
their border would have come before the merges that built the two sides.
One Aho-Corasick pass gives the longest token at every position of a piece;
the encoder takes the longest token that is compatible with the one before
it, tries the next shorter one if not, and steps back where none fits. A
prefix of a piece has only one valid encoding, so a position that failed once
never has to be tried again and the work is linear in the piece.

The compatibility table holds pairs of tokens, filled as pairs come up. For
left token a and right token b, the tokens that stood next to the border on
the way to a and b are a's right spine (a, its right part, that one's right
part, ...) and b's left spine. A merge of x and y across the border happens
before x's parent is made if its rank is lower than that parent's (an equal
rank goes to the merge further left), and likewise for y.

Decoding gathers from one byte string of all tokens by an offset table.

The vocabulary file is read once on the driver and broadcast: its size is
that of the file, whatever the input. Defined results: a null text is the
empty text, with no ids; strings of added tokens inside a text become their
ids, as the tokenizer's library has it; texts are read in pieces, so a very
long one needs memory for its ids only.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table, texts_of

# The byte-level pre-tokenizer's pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                       r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# The same pattern for texts of these characters only, which the standard
# library's engine splits faster: no separators U+001C to U+001F, no numbers but
# 0 to 9, letters up to U+017F.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
OTHER_CHARACTERS = re.compile("[^\x00-\x1b\x20-±´-¸º»¿-ſ]")
PLAIN_PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?(?:[{_LETTERS}]+|[0-9]+|[^\s{_LETTERS}0-9]+)|\s+(?!\S)|\s+")
CACHE_PIECES = 600_000     # encoded pieces kept by a worker, in two generations
CACHE_PAIRS = 1_000_000    # compatibility table entries kept by a worker
LONG_TEXT = 1 << 20        # code points above which a text's pieces are streamed
DECODE_IDS = 1 << 18       # ids decoded at a time


def byte_alphabet() -> dict[int, str]:
    """Byte -> the printable character that stands for it in the file:
    itself if it is printable Latin-1, else the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown, free = {b: chr(b) for b in plain}, itertools.count(256)
    return {b: shown.get(b) or chr(next(free)) for b in range(256)}


class _Pieces(dict):
    """piece -> its ids as little-endian 32-bit bytes, computed when missing."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES // 2:
            self.old = dict(self)
            self.clear()
        found = self.old.get(piece)
        if found is None:
            found = np.array(self.encode(piece), dtype="<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = found
        return found


class Codec:
    """Encoder and decoder of one vocabulary file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.shown = byte_alphabet()
        self.translate = {b: c for b, c in self.shown.items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.made: dict[str, int] = {}
        for n, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault((left, right), n)
            if left + right not in self.parts:
                self.parts[left + right], self.made[left + right] = (left, right), n
        self.automaton = ahocorasick.Automaton()
        for token in self.ids:
            self.automaton.add_word(token, token)
        self.automaton.make_automaton()
        self.spines: tuple[dict, dict] = ({}, {})
        self.fits: dict[tuple[str, str], bool] = {}
        self.next_shorter = {token: self._shorter(token) for token in self.ids}
        self.unsound = self._unsound()
        self.pieces = _Pieces(self._encode_piece)

        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.added = {text: np.array([i], dtype="<u4").tobytes() for text, i in added.items()}
        self.split_added = (regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
                            if added else None)
        back = {c: b for b, c in self.shown.items()}
        texts = {i: bytes(back[c] for c in token) for token, i in self.ids.items()}
        texts |= {i: text.encode() for text, i in added.items()}
        size = max(texts) + 1
        lengths = np.array([len(texts.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.blob = np.frombuffer(b"".join(texts.get(i, b"") for i in range(size)), dtype=np.uint8)

    # ------------------------------------------------------------ compatibility
    def _spine(self, token: str, side: int) -> list[tuple[str, float]]:
        """(token next to the border, rank of the merge that consumed it) from
        the whole token inwards; side 1: right spine, side 0: left spine."""
        if token not in self.spines[side]:
            out, above = [(token, float("inf"))], token
            while above in self.parts:
                out.append((self.parts[above][side], self.made[above]))
                above = self.parts[above][side]
            self.spines[side][token] = out
        return self.spines[side][token]

    def _crossed(self, left: str, right: str, but: tuple[str, str] | None = None) -> bool:
        """Whether some merge joins the two sides' borders before they are done."""
        rank = self.rank
        for x, until_x in self._spine(left, 1):
            for y, until_y in self._spine(right, 0):
                n = rank.get((x, y))
                if n is not None and n < until_x and n <= until_y and (x, y) != but:
                    return True
        return False

    def _fits(self, left: str, right: str) -> bool:
        if len(self.fits) >= CACHE_PAIRS:
            self.fits.clear()
        ok = self.fits[left, right] = not self._crossed(left, right)
        return ok

    def _unsound(self) -> set[str]:
        """Tokens that are not the encoding of their own text."""
        out: set[str] = set()
        for token in sorted(self.ids, key=len):
            if token in self.parts:
                left, right = self.parts[token]
                if left in out or right in out or self._crossed(left, right, (left, right)):
                    out.add(token)
            elif len(token) > 1:
                out.add(token)
        return out

    def _shorter(self, token: str) -> str | None:
        return next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ids), None)

    # ------------------------------------------------------------ encoding
    def _encode_piece(self, piece: str) -> list[int]:
        # bytes as Latin-1 characters, each shown by its stand-in
        text = piece.encode().decode("latin-1").translate(self.translate)
        if text in self.ids and text not in self.unsound:
            return [self.ids[text]]
        size = len(text)
        longest: list[str | None] = [None] * size
        for end, token in self.automaton.iter(text):
            longest[end + 1 - len(token)] = token  # ends come in ascending order
        fits, shorter, unsound = self.fits, self.next_shorter, self.unsound
        out, at, before, failed = [], 0, None, bytearray(size + 1)
        token = longest[0]
        while True:
            end = at + len(token)
            ok = not failed[end] and token not in unsound
            if ok and before is not None:
                ok = fits.get((before, token))
                if ok is None:
                    ok = self._fits(before, token)
            if ok:
                out.append(token)
                if end == size:
                    break
                before, at, token = token, end, longest[end]
                continue
            token = shorter[token]
            while token is None:  # nothing fits here: the token before was too long
                failed[at] = 1
                if not out:
                    raise ValueError(f"no encoding of {piece!r} in this vocabulary")
                last = out.pop()
                at -= len(last)
                before, token = out[-1] if out else None, shorter[last]
        return [self.ids[t] for t in out]

    def encoded(self, text: str) -> Iterator[bytes]:
        """The text's ids as runs of little-endian unsigned 32-bit integers."""
        parts = self.split_added.split(text) if self.split_added else [text]
        look_up = self.pieces.__getitem__
        for part in parts:
            if part in self.added:
                yield self.added[part]
            elif len(part) <= LONG_TEXT:
                yield b"".join(map(look_up, self._pattern(part).findall(part)))
            else:
                found = self._pattern(part).finditer(part)
                while block := list(itertools.islice(found, LONG_TEXT)):
                    yield b"".join(look_up(m.group()) for m in block)

    @staticmethod
    def _pattern(text: str):
        return PIECES if OTHER_CHARACTERS.search(text) else PLAIN_PIECES

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.encoded(text)), dtype="<u4")

    # ------------------------------------------------------------ decoding
    def token_bytes(self, ids: np.ndarray) -> bytes:
        starts = self.offsets[ids]
        lengths = self.offsets[ids + np.uint32(1)] - starts
        ends = np.cumsum(lengths)
        at = np.repeat(starts - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.blob[at].tobytes()

    def decoded(self, ids: np.ndarray) -> Iterator[str]:
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for k in range(0, len(ids), DECODE_IDS):
            yield decoder.decode(self.token_bytes(ids[k:k + DECODE_IDS]))
        yield decoder.decode(b"", True)

    def decode(self, ids: np.ndarray) -> str:
        return "".join(self.decoded(ids))


_CODECS: dict[str, Codec] = {}


def codec_of(source: str) -> Codec:
    """The codec of a vocabulary text, built once per worker."""
    key = hashlib.sha1(source.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(source)
    return _CODECS[key]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return os.path.realpath(public_tokenizers.path(name))


def _broadcast(spark: SparkSession, path: str | None):
    with open(path or vocabulary_path(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def round_trip_digests(spark: SparkSession, text: Column, path: str | None = None) -> Column:
    """struct<n_tokens, ids_sha256, decoded_sha256> of a text column."""
    source = _broadcast(spark, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = codec_of(source.value)
        for batch in batches:
            rows = []
            for t in texts_of(batch):
                raw = b"".join(codec.encoded(t))
                back = hashlib.sha256()
                for part in codec.decoded(np.frombuffer(raw, dtype="<u4")):
                    back.update(part.encode())
                rows.append((len(raw) // 4, hashlib.sha256(raw).hexdigest(), back.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(text)


def token_ids(spark: SparkSession, text: Column, path: str | None = None) -> Column:
    """array<int> of a text column's ids."""
    source = _broadcast(spark, path)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(source.value)
        for batch in batches:
            yield pd.Series([codec.encode(t).astype(np.int32) for t in texts_of(batch)], dtype=object)

    return encode(text)


def round_trip(spark: SparkSession, text: Column, path: str | None = None) -> Column:
    """struct<ids, exact> of a text column: the ids, and whether they decode to the text."""
    source = _broadcast(spark, path)

    @F.pandas_udf("ids array<int>, exact boolean")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = codec_of(source.value)
        for batch in batches:
            texts = texts_of(batch)
            ids = [codec.encode(t) for t in texts]
            yield pd.DataFrame({"ids": pd.Series([x.astype(np.int32) for x in ids], dtype=object),
                                "exact": [codec.decode(x) == t for x, t in zip(ids, texts)]})

    return encode(text)


def texts_of_ids(spark: SparkSession, ids: Column, path: str | None = None) -> Column:
    """The texts of an array<int> column (null: null); null ids are left out."""
    source = _broadcast(spark, path)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(source.value)
        for batch in batches:
            yield pd.Series([None if x is None else codec.decode(np.asarray(x, dtype=np.uint32)) for x in batch],
                            dtype=object)

    return decode(F.filter(ids, lambda i: i.isNotNull()))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (docs.withColumn("result", round_trip_digests(spark, F.col("text")))
            .select("doc_id", "result.n_tokens", "result.ids_sha256", "result.decoded_sha256"))
