"""Exact token ids of whole texts, for operators that count or pack tokens."""

from __future__ import annotations

import os
import re
from array import array
from unicodedata import is_normalized

from moodlake.llm.common import per_process

DEFAULT_TOKENIZER = "word_bpe_49k.json"
# Words, and pieces of words, kept encoded per worker process (about 150 MB); beyond it the store is emptied.
MAX_CACHED_WORDS = 500_000


def tokenizer_file(name: str) -> str:
    """A path as given, or the place of a public vocabulary file."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)



def _words(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


# Words up to here in Unicode lower-case letter by letter in every library.
_PLAIN = 0x130


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if it is a visible Latin-1 character, else the next one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space, so a text's ids
    are its words' ids in a row: each distinct word is encoded once and kept.
    Words of plain letters go straight to the vocabulary model, piece by
    piece; any other word, and any tokenizer that does not agree with this on
    a probe, goes through the whole tokenizer."""

    PROBE = "Don't  stop,\n3 cafés\tà1b!! ÜBER a_b|c <x> 'tis we'll??"

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_file(name))
        # The word pattern of this vocabulary.
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.by_word = self._whole(self.PROBE) == b"".join(map(self._whole, _words(self.PROBE)))
        self.plain = self.by_word and all(self._plain(w) == self._whole(w) for w in _words(self.PROBE))

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, word: str) -> bytes:
        word, out = word.lower(), []
        if word.isalpha():
            cut = (word,)
        elif word[:-1].isalpha() and word[-1] in ".,":
            cut = (word[:-1], word[-1])
        else:
            cut = self.cut(word)
        for piece in cut:
            ids = self.pieces.get(piece)
            if ids is None:
                shown = piece if piece.isascii() and piece.isprintable() else "".join(map(self.letters.__getitem__, piece.encode()))
                ids = self.pieces[piece] = array("I", [t.id for t in self.tok.model.tokenize(shown)]).tobytes()
            out.append(ids)
        return b"".join(out)

    def _word(self, word: str) -> bytes:
        plain = word.isascii() or max(word) < chr(_PLAIN) and is_normalized("NFC", word)
        return self._plain(word) if self.plain and plain and "<|" not in word else self._whole(word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text, its ids as little-endian unsigned 32-bit numbers."""
        if not self.by_word:
            return list(map(self._whole, texts))
        out, known = [], self.words
        for text in texts:
            if len(known) > MAX_CACHED_WORDS or len(self.pieces) > MAX_CACHED_WORDS:
                known = self.words = {"": b""}
                self.pieces = {}
            words = _words(text)
            for w in words:
                if w not in known:
                    known[w] = self._word(w)
            out.append(b"".join(map(known.__getitem__, words)))
        return out


def encoder(name: str) -> WordEncoder:
    return per_process("encoder_" + re.sub(r"\W", "_", name), lambda: WordEncoder(name))
