"""Token ids of whole texts by the ``tokenizers`` library, with a bounded store of words already encoded.

The library needs 15 microseconds for a word of invented prose; most words of a corpus come again. A text is cut only
where the tokenizer's own pattern cuts too, so the ids are those of the whole text:

- ``spaced`` (byte-level pattern that puts one blank before a word): before each single blank and around each single
  line feed. A text in which two blanks meet, or that begins or ends with one, goes to the library whole.
- otherwise (a tokenizer that drops white space): at blanks and line feeds.
- before the punctuation marks (ASCII, no apostrophe) that end a word and follow an ASCII letter; both patterns make them
  one piece.

Without blanks in its pieces a call costs twice what the word itself does, so the words of a text that are not stored are
given to the library together, joined by blanks, and told apart by the places of their pieces, or, where a blank is part
of the word after it (``spaced``), by the ids that begin with one.

A tokenizer that works in lower case gives a word and its lower case the same ids, so it keeps the latter alone. A text
that holds the name of an added token, which the library finds anywhere, goes to it whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
import tokenizers  # noqa: E402

HELD_WORDS = 600_000  # in each of two generations
TOGETHER = 256  # unseen words in a call
SPACE = "\u0120"  # what stands for a blank in the vocabulary of a byte-level tokenizer
TAIL = re.compile(r"(?<=[A-Za-z])[!-&(-/:-@\[-`{-~]+\Z")


class _Odd(Exception):
    """The text cannot be cut here."""


class _Words(dict):
    """Ids by word, as bytes. Holds two generations: words that come again move to the younger one."""

    def __init__(self, encode, prefix: str, strict: bool, lower: bool, bare: _Words | None = None, feed: bytes = b"") -> None:
        super().__init__()
        self.feed = feed  # before a word that begins with a line feed
        self.encode, self.prefix, self.strict, self.lower = encode, prefix, strict, lower
        self.bare = self if bare is None else bare  # the same without a prefix
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word[:1] == "\n":
                self[word] = ids = self.feed + self.bare[word[1:]]
                return ids
            if self.strict and (not word or word[0].isspace() or word[-1].isspace()):
                raise _Odd
            tail = TAIL.search(word)
            if tail:
                ids = self[word[: tail.start()]] + self.bare[tail[0]]
            elif self.lower and word.isascii() and not word.islower() and word.lower() != word:
                ids = self[word.lower()]
            else:
                ids = self.encode(self.prefix + word)
        self[word] = ids
        return ids

    def stem(self, word: str) -> str:
        """What of a word goes to the library: without the marks at its end, in lower case where that is all the same."""
        tail = TAIL.search(word)
        word = word[: tail.start()] if tail else word
        return word.lower() if self.lower and word.isascii() else word

    def learn(self, words: set[str], encode_places) -> None:
        """Stores the stems that are new, all in one call; those whose letters might join with what is before go alone."""
        new = {self.stem(w) for w in words if w not in self and w not in self.older}
        new = [w for w in new if w and w not in self and w not in self.older and (w.isascii() or (
            unicodedata.is_normalized("NFC", w) and not unicodedata.combining(w[0])))]
        if len(new) < 2:
            return
        ids, places = encode_places(" ".join(new))
        starts = np.cumsum([0, *[len(w) + 1 for w in new]])
        cuts = np.searchsorted(places, starts).tolist()
        for word, low, high in zip(new, cuts, cuts[1:]):
            self[word] = ids[low:high].tobytes()

    def learn_spaced(self, words: set[str], encode, blank: np.ndarray) -> None:
        """The same for words behind one blank each, none of which is stored; ``blank`` tells by id which pieces begin with it."""
        new = [w for w in words if w[:1] != "\n" and w not in self.older]
        if len(new) < 2:
            return
        tails = map(TAIL.search, new)
        new = {w[: t.start()] if t else w for w, t in zip(new, tails, strict=True)}
        new = [w for w in new if w and not w[0].isspace() and not w[-1].isspace() and w not in self and w not in self.older]
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            raw = encode(" " + " ".join(some))
            starts = np.flatnonzero(blank[np.frombuffer(raw, "<u4")])
            if len(starts) == len(some):
                cuts = [*(4 * starts).tolist(), len(raw)]
                self.update((word, raw[low:high]) for word, low, high in zip(some, cuts, cuts[1:]))

    def trim(self) -> None:
        if len(self) > HELD_WORDS:
            self.older = dict(self)
            self.clear()


class Encoder:
    """``ids(text)``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, spaced: bool) -> None:
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.spaced = spaced
        self.names = [str(t.content).lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = {n[0] for n in self.names}
        lower = not spaced and self.library("A a.") == self.library("a a.")
        self.plain = _Words(self.library, "", spaced, lower)
        self.after = _Words(self.library, " ", spaced, lower, self.plain, self.library("\n"))
        if spaced:
            pieces = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
            self.blank = np.array([p.startswith(SPACE) for p in pieces])

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def quick(self, text: str) -> bytes:
        """The same ids; the library leaves out the places of the pieces, which cost it a fifth more."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4"), np.array([p[0] for p in found.offsets], np.int64)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(m in text for m in self.marks) and any(n in text.lower() for n in self.names):
            return self.library(text)
        if not self.spaced:
            words = text.replace("\n", " ").split(" ")
            self.plain.learn(set(words), self.places)
            return b"".join(map(self.plain.__getitem__, words))
        try:
            first, *words = text.replace("\n", " \n").split(" ")
            return self.plain[first] + b"".join(map(self.after.__getitem__, words))
        except _Odd:
            return self.library(text)

    def several(self, texts: pa.StringArray) -> list[bytes]:
        """``ids`` of each text, for a ``spaced`` tokenizer: each distinct word of them is looked up once."""
        lines = pc.replace_substring(texts, "\n", " \n")
        split = pc.split_pattern(pc.binary_join_element_wise("\n", lines, ""), " ")  # every first word behind a line feed
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.after.get, distinct))
        missing = [at for at, ids in enumerate(found) if ids is None]
        self.after.learn_spaced({distinct[at] for at in missing}, self.quick, self.blank)
        odd = np.zeros(len(distinct), bool)
        for at in missing:
            try:
                found[at] = self.after[distinct[at]]
            except _Odd:
                found[at], odd[at] = b"", True
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        code = words.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths[code])])
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(starts[code] - ends[:-1], lengths[code]) + np.arange(ends[-1])]
        cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        whole = np.diff(np.concatenate([[0], np.cumsum(odd[code])])[cuts]) > 0
        for mark in self.marks:
            whole |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        feed = len(self.after.feed) // 4
        return [self.ids(texts[i].as_py()) if alone else ids[low + feed : high].tobytes()
                for i, (alone, low, high) in enumerate(zip(whole.tolist(), ends[cuts[:-1]].tolist(), ends[cuts[1:]].tolist(), strict=True))]

    def trim(self) -> None:
        """To be called between batches: keeps the store within its bound."""
        self.plain.trim()
        self.after.trim()


def encoder(path: str, spaced: bool) -> Encoder:
    """The encoder of this worker process; what it has stored serves the next task too.

    Functions reach the workers by value, so it is kept on the library's module, which stays loaded.
    """
    kept = vars(tokenizers).setdefault("_vecferry_encoders", {})
    if (path, spaced) not in kept:
        kept.clear()
        kept[path, spaced] = Encoder(path, spaced)
    return kept[path, spaced]
