"""Token ids of whole texts with a ``tokenizers`` file, faster by a word cache.

A BPE tokenizer maps each piece its pre-tokenizer cuts out independently of
the rest of the text, so ids may be cached by piece. For tokenizers whose
normaliser and pre-tokenizer are the known lower-casing pair below, texts of
plain Latin characters are cut by an equal regular expression and only pieces
not seen before go through the library, joined into one call. Any other text
(other scripts, control characters, combining marks, special tokens), and any
other tokenizer, is encoded by the library as it is.
"""

from __future__ import annotations

import json
import re

import numpy as np

# The pre-tokenizer's pattern for which the fast way is known to be equal (fixed value).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]

# Characters that NFC leaves alone, whose lower case is one such character,
# and of which the letters are exactly those of _PIECE.
_PLAIN = re.compile("[\t-\r\x20-\x7eÀ-ÖØ-öø-įı-ſ]*")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\\sa-z0-9ß-öø-ſ]+")

CACHE_PIECES = 1_000_000  # bounds a worker's memory; a full cache starts anew
_JOINED = 2_000  # new pieces to a call


class TokenIds:
    """``encode(texts)`` -> one little-endian id array per text, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self._cache: dict[str, bytes] = {}
        self._special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._fast = self._known(json.loads(self.tokenizer.to_str()))

    @staticmethod
    def _known(spec: dict) -> bool:
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        cuts = pre.get("pretokenizers") or [{}]
        return ([n.get("type") for n in norm.get("normalizers", [])] == _NORMALIZERS
                and cuts[0].get("pattern") == {"Regex": _PATTERN} and bool(cuts[0].get("invert"))
                and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
                and spec["model"]["type"] == "BPE")

    def _learn(self, pieces: list[str]) -> None:
        """Encode unseen pieces; a space between them keeps them apart."""
        if len(self._cache) + len(pieces) > CACHE_PIECES:
            self._cache.clear()
        for i in range(0, len(pieces), _JOINED):
            part = pieces[i:i + _JOINED]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, self.width)
            cuts = np.flatnonzero(np.diff(np.array(found.word_ids))) + 1
            if len(cuts) + 1 != len(part):
                raise ValueError("the tokenizer cuts pieces that it was expected to keep")
            self._cache.update(zip(part, (x.tobytes() for x in np.split(ids, cuts))))

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, self.width).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if not self._fast or not _PLAIN.fullmatch(text) or any(s in text for s in self._special):
                out.append(self._whole(text))
                continue
            pieces = _PIECE.findall(text.lower())
            try:
                out.append(b"".join(map(self._cache.__getitem__, pieces)))
            except KeyError:
                seen = set(pieces)
                new = [p for p in seen if p not in self._cache]
                if len(self._cache) + len(new) > CACHE_PIECES:
                    new = list(seen)
                self._learn(new)
                out.append(b"".join(map(self._cache.__getitem__, pieces)))
        return out


_loaded: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The encoder of a tokenizer file, loaded once a worker."""
    if path not in _loaded:
        _loaded[path] = TokenIds(path)
    return _loaded[path]
