"""Memo over words for slow tokenizers: a text is cut at white space where no
token can span, each distinct piece is encoded once per worker, and unseen
plain words are encoded many at a time in one string. Exactness rests on two
facts, both tested against the library on whole texts: pre-tokenizers never
put a cut's two sides into one token, and the tokens of a plain Latin word are
told apart in a joined string by the flag of a word's first (or last) token."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterator

import numpy as np

MEMO_WORDS = 400_000  # kept words of a worker, some 60 MB
HOT_WORDS = 20_000
JOIN_WORDS = 256
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # of a word's end; one token run in both vocabularies
LATIN_END = "İ"  # plain words hold letters below this code point only
_CUT = re.compile(r"(?<=\S) (?=\S)")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def segments(text: str, limit: int = 1 << 20) -> Iterator[str]:
    """Parts of a long text of about ``limit`` characters, cut in front of a
    single space or line feed between two characters that are no white space."""
    at = 0
    while len(text) - at > limit:
        cut = at + limit
        while cut < len(text) - 1:
            if text[cut] in " \n" and not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        else:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def spaced_pieces(text: str) -> list[str]:
    """Pieces of a text for a byte-level vocabulary, whose words carry their
    leading space: every cut stands before a single space between two
    non-space characters, which always starts a token."""
    plain = text.replace("\n", " ")
    if " ".join(plain.split()) == plain:
        parts = text.split(" ")
    else:
        parts = _CUT.split(text)
    return [parts[0], *(" " + p for p in parts[1:])]


def dropped_space_pieces(text: str) -> list[str]:
    """Pieces for a vocabulary that drops white space."""
    return text.replace("\n", " ").split(" ")


_PLAIN = (bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + b" \n"
          + bytes(range(0x80, 0xC0)) + b"\xc2\xc3")  # in UTF-8, code points under 256


def plain_words(text: str) -> list[str] | None:
    """Lower-case words and marks of a text that holds nothing but Latin
    letters, digits, spaces, line feeds and single full stops and commas;
    None for any other text. For a vocabulary that lower-cases, drops white
    space and takes runs of letters and of marks apart."""
    marks = text.encode().translate(None, _PLAIN)
    if marks.strip(b".,") or "\x85" in text or "\xa0" in text:
        return None
    if any(pair in text for pair in ("..", ".,", ",.", ",,")):
        return None
    return text.lower().replace(".", " . ").replace(",", " , ").split()


class WordMemo:
    """``values(pieces)`` gives a value per piece: ``direct(pieces)`` encodes
    any pieces one by one; ``joined(words)`` encodes plain words together (or
    returns None when their tokens can't be told apart)."""

    def __init__(self, direct: Callable[[list[str]], list], joined: Callable[[list[str]], list | None],
                 add: Callable, fold: Callable[[str], str] = str, lead: str = ""):
        self.memo: dict[str, object] = {}
        self.words: dict[str, object] = {}
        self.tails: dict[str, object] = {}
        self.hot: dict[str, object] = {}  # words met first, few enough to stay in a processor's cache
        self.direct, self.joined, self.add, self.fold, self.lead = direct, joined, add, fold, lead
        gc.disable()  # in this worker: the memo holds no cycles, and scanning it is slow

    def _learn(self, missing: set[str]) -> None:
        odd, pieces, words, tails = [], [], [], []
        lead = len(self.lead)
        for piece in missing:
            base = piece.rstrip(PUNCTUATION)
            word = base[lead:]
            if word.isalpha() and (word.isascii() or max(word) < LATIN_END) and base.startswith(self.lead):
                pieces.append(piece)
                words.append(word)
                tails.append(piece[len(base):])
            else:
                odd.append(piece)
        self.memo.update(zip(odd, self.direct(odd)))
        words = list(map(self.fold, words))
        self._encode(list(set(words).difference(self.words)))
        ends = list(set(tails).difference(self.tails))
        self.tails.update(zip(ends, self.direct(ends)))
        self.memo.update(zip(pieces, map(self.add, map(self.words.__getitem__, words),
                                         map(self.tails.__getitem__, tails))))
        while len(self.words) > MEMO_WORDS:
            self.words.popitem()
        while len(self.tails) > MEMO_WORDS:
            self.tails.popitem()

    def _encode(self, words: list[str]) -> None:
        for i in range(0, len(words), JOIN_WORDS):
            part = words[i:i + JOIN_WORDS]
            got = self.joined(part)
            if got is None:
                got = self.direct([self.lead + w for w in part])
            self.words.update(zip(part, got))

    def values(self, pieces: list[str]) -> list:
        """The value of every piece, in order."""
        return self._values(pieces, self.memo, self._learn)

    def word_values(self, words: list[str]) -> list:
        """The value of every word of ``plain_words``."""
        hot = self.hot
        out = list(map(hot.get, words))
        gaps = [i for i, v in enumerate(out) if v is None]
        if gaps:
            rare = [words[i] for i in gaps]
            values = self._values(rare, self.words, self._learn_words)
            for i, v in zip(gaps, values):
                out[i] = v
            if len(hot) < HOT_WORDS:
                hot.update(zip(rare, values))
        return out

    @staticmethod
    def _values(pieces: list[str], memo: dict, learn: Callable[[set[str]], None]) -> list:
        out = list(map(memo.get, pieces))
        if None in out:
            gaps = [i for i, v in enumerate(out) if v is None]
            learn({pieces[i] for i in gaps})
            for i in gaps:
                out[i] = memo[pieces[i]]
            while len(memo) > MEMO_WORDS:  # the newest go: frequent words were met early
                memo.popitem()
        return out

    def _learn_words(self, missing: set[str]) -> None:
        odd = [w for w in missing if not w.isalpha()]
        self.words.update(zip(odd, self.direct([self.lead + w for w in odd])))
        self._encode(list(missing.difference(odd)))


def split_flags(ids: np.ndarray, flags: np.ndarray, words: int, first: bool) -> np.ndarray | None:
    """Bounds of each word's tokens, by the flag of its first or last token."""
    at = np.flatnonzero(flags[ids])
    if at.size != words:
        return None
    return np.append(at, ids.size) if first else np.concatenate([[0], at + 1])
