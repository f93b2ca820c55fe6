"""SentencePiece models on the ``tokenizers`` library.

The model file is a protobuf message. Its fields are read here from the wire
format, so nothing but the ``tokenizers`` library is needed to encode and
decode:

* pieces with scores and types -> a Unigram model, or a BPE model whose merges
  are all pairs of pieces that make a piece, in the order of its score;
* the normaliser's compiled character map, dropped extra white space and the
  dummy prefix -> a normaliser sequence; white space becomes the marker U+2581;
* byte pieces -> byte fallback; user-defined pieces -> added tokens;
* the decoder turns marker and bytes back and drops the dummy prefix.

Where no piece has a marker behind another character, words are encoded
independently of one another. Then distinct words go through the library once
(batches of them, multithreaded) and are remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
CACHE_WORDS = 1_000_000  # bounds a worker's memory; a full cache starts anew


# -- protobuf wire format --------------------------------------------------------

def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message: integers, or bytes of 4, 8 or any length."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 5:
            value, at = data[at:at + 4], at + 4
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            raise ValueError(f"not a model file: wire type {kind}")
        yield tag >> 3, value


@dataclass
class ModelFile:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    char_map: bytes = b""
    dummy_prefix: bool = True
    drop_extra_spaces: bool = True
    escape_spaces: bool = True
    suffix_marker: bool = False

    @classmethod
    def parse(cls, data: bytes) -> ModelFile:
        out = cls()
        for number, value in fields(data):
            if number == 1:  # a piece
                text, score, kind = "", 0.0, NORMAL
                for n, v in fields(value):
                    if n == 1:
                        text = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                out.pieces.append((text, score, kind))
            elif number == 2:  # how it was trained
                for n, v in fields(value):
                    if n == 3:
                        out.kind = v
                    elif n == 24:
                        out.suffix_marker = bool(v)
            elif number == 3:  # the normaliser
                for n, v in fields(value):
                    if n == 2:
                        out.char_map = v
                    elif n == 3:
                        out.dummy_prefix = bool(v)
                    elif n == 4:
                        out.drop_extra_spaces = bool(v)
                    elif n == 5:
                        out.escape_spaces = bool(v)
        if out.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models have a counterpart")
        return out


# -- the backend ------------------------------------------------------------------

def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """All (left, right) that make a piece: the best score first, as the model merges."""
    known = {text: (i, score) for i, (text, score, kind) in enumerate(pieces)
             if kind in (NORMAL, USER)}
    found = []
    for text, (_, score) in known.items():
        found += [(-score, known[text[:i]][0], known[text[i:]][0], text[:i], text[i:])
                  for i in range(1, len(text)) if text[:i] in known and text[i:] in known]
    return [(left, right) for *_, left, right in sorted(found)]


class Backend:
    """A ``tokenizers`` tokenizer equal to a SentencePiece model."""

    def __init__(self, data: bytes):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        self.file = spec = ModelFile.parse(data)
        vocab = {text: i for i, (text, _, _) in enumerate(spec.pieces)}
        bytes_too = any(kind == BYTE for _, _, kind in spec.pieces)
        unknown = next(((i, t) for i, (t, _, k) in enumerate(spec.pieces) if k == UNKNOWN),
                       (0, None))
        if spec.kind == BPE:
            model = models.BPE(vocab=vocab, merges=merges(spec.pieces), unk_token=unknown[1],
                               fuse_unk=True, byte_fallback=bytes_too)
        else:
            model = models.Unigram([(t, s) for t, s, _ in spec.pieces], unknown[0], bytes_too)
        self.words = Tokenizer(model)  # a normalised word, as it is
        steps: list = []
        if spec.char_map:
            steps.append(normalizers.Precompiled(spec.char_map))
        if spec.drop_extra_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if spec.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if spec.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        self.normalizer = normalizers.Sequence(steps)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.normalizer = self.normalizer
        undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if spec.dummy_prefix:
            undo.append(decoders.Strip(" ", 1, 0))
        self.tokenizer.decoder = decoders.Sequence(undo)
        own = [t for t, _, k in spec.pieces if k == USER]
        for each in (self.tokenizer, self.words):
            each.add_tokens([AddedToken(t, normalized=False) for t in own])
        # words are independent unless a piece leads from one into the next
        self.by_word = not own and spec.escape_spaces and not spec.suffix_marker and not any(
            MARK in t.lstrip(MARK) for t, _, k in spec.pieces if k == NORMAL)
        self._word = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self._plain = not spec.char_map and not spec.drop_extra_spaces
        self._cache: dict[str, bytes] = {}
        self._bytes = [bytes([int(t[3:-1], 16)]) if k == BYTE else t.replace(MARK, " ").encode()
                       for t, _, k in spec.pieces]

    def normalise(self, text: str) -> str:
        if not self._plain:
            return self.normalizer.normalize_str(text)
        if text and self.file.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _learn(self, words: list[str]) -> None:
        if len(self._cache) + len(words) > CACHE_WORDS:
            self._cache.clear()
        for word, found in zip(words, self.words.encode_batch_fast(words, add_special_tokens=False)):
            self._cache[word] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, "<u4") for e in found]
        cut = [self._word.findall(self.normalise(t)) for t in texts]
        new = {w for words in cut for w in words if w not in self._cache}
        if len(self._cache) + len(new) > CACHE_WORDS:
            new = {w for words in cut for w in words}
        if new:
            self._learn(list(new))
        known = self._cache.__getitem__
        return [np.frombuffer(b"".join(map(known, words)), "<u4") for words in cut]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of id arrays. Pieces are joined as bytes; where byte pieces do not make
        valid UTF-8, the library's decoder says what they stand for."""
        out = []
        for each in ids:
            try:
                text = b"".join(map(self._bytes.__getitem__, each.tolist())).decode()
                out.append(text[1:] if self.file.dummy_prefix and text[:1] == " " else text)
            except (UnicodeDecodeError, IndexError):
                out.append(self.tokenizer.decode(each.tolist(), skip_special_tokens=False))
        return out
