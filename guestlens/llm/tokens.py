"""Token ids of whole texts with a public tokenizer file.

The word tokenizer never joins characters across ASCII white space, so a text's ids are
those of its white-space separated pieces, one after another. Pieces recur, hence every
Python worker keeps the ids of those it has met until its store is full; later ones are encoded
whenever they occur, which costs time but never changes an id.
"""

from __future__ import annotations

import unicodedata

import numpy as np

VOCABULARY = "word_bpe_49k.json"
CACHED_PIECES = 800_000
CACHED_BYTES = 32
TOGETHER = 2048
#: A character that stands between pieces which are encoded together.
_MARK = "\x01"

#: Never part of a letter or of its composed form, so that the tokenizer always parts a word from them.
SYMBOLS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())

_encoders: dict[str, PieceEncoder] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def is_word(piece: bytes) -> bool:
    """Whether a piece is letters alone, also when composed and lowered as the tokenizer does it."""
    if piece.isalpha():
        return True
    text = piece.decode("utf-8")
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


class PieceEncoder:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.mark = np.array(self.tokenizer.encode(_MARK, add_special_tokens=False).ids, "<u4")
        self.known: dict[bytes, bytes] = {}

    def _raw(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces of letters alone are one word each, so that word ends tell them apart; others get a mark between."""
        texts = [p.decode("utf-8") for p in pieces]
        if all(t.isalpha() for t in texts):
            (ids,) = self._raw([" ".join(texts)])
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
        else:
            (ids,) = self._raw([f" {_MARK} ".join(texts)])
            cuts = np.append(np.flatnonzero(ids == self.mark[0]), len(ids)) if len(self.mark) == 1 else np.zeros(0, int)
        if len(cuts) != len(pieces) or any(_MARK in t for t in texts):
            return [x.tobytes() for x in self._raw(texts)]
        skip = 0 if texts[0].isalpha() and all(t.isalpha() for t in texts) else 1
        ends, raw = (4 * cuts).tolist(), ids.tobytes()
        begins = [0, *(e + 4 * skip for e in ends[:-1])]
        return [raw[a:b] for a, b in zip(begins, ends, strict=True)]

    def _encoded(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """The ids of ``pieces``, and of the words in them that end before ASCII symbols."""
        out: dict[bytes, bytes] = {}
        letters, others, joined = set(), set(), []
        for piece in pieces:
            if is_word(piece):
                letters.add(piece)
                continue
            stem = piece.rstrip(SYMBOLS)
            if stem and stem != piece and is_word(stem):
                tail = piece[len(stem) :]
                joined.append((piece, stem, tail))
                for part, group in ((stem, letters), (tail, others)):
                    if part in self.known:
                        out[part] = self.known[part]
                    else:
                        group.add(part)
            else:
                others.add(piece)
        for group in (list(letters), list(others)):
            for low in range(0, len(group), TOGETHER):
                part = group[low : low + TOGETHER]
                out.update(zip(part, self._together(part), strict=True))
        out.update((piece, out[stem] + out[tail]) for piece, stem, tail in joined)
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text. ASCII letters are folded first, as the tokenizer folds all letters."""
        known = self.known
        found, gaps, missing = [], [], []
        for text in texts:
            pieces = text.lower().split()
            found.append(list(map(known.get, pieces)))  # the only look at the store, whose entries are far apart in memory
            gaps.append([k for k, ids in enumerate(found[-1]) if ids is None])
            missing.append([pieces[k] for k in gaps[-1]])
        fresh = self._encoded(list(set().union(*missing)))
        if len(known) < CACHED_PIECES:
            known.update((p, ids) for p, ids in fresh.items() if len(p) <= CACHED_BYTES)
        for own, places, pieces in zip(found, gaps, missing, strict=True):
            for k, piece in zip(places, pieces, strict=True):
                own[k] = fresh[piece]
        return [b"".join(own) for own in found]


def encoder(path: str) -> PieceEncoder:
    """The encoder of this Python worker for ``path``."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
