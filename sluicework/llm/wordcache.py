"""A bounded cache from words to bytes, for tokenizers whose result on a text is that of its words in a row."""

from __future__ import annotations

from collections.abc import Callable, Iterable

# Bytes of one generation, with what Python needs for an entry; two are kept. Longer words are worked out each time.
GENERATION = 48 << 20
ENTRY = 200
MAX_LENGTH = 64


class WordCache:
    """Looks words up; ``encode`` gets all missing ones of a call at once.

    When a generation is full it becomes the older one, and the one before it goes: words that keep coming are taken over
    into the new one, rare ones are forgotten.
    """

    def __init__(self, encode: Callable[[list], Iterable[bytes]]) -> None:
        self._encode = encode
        self._known: dict = {}
        self._older: dict = {}
        self._size = 0

    def join(self, words: list) -> bytes:
        """The bytes of all words in a row."""
        return b"".join(self.look_up(words))

    def look_up(self, words: list) -> list[bytes]:
        """The bytes of each word."""
        parts = list(map(self._known.get, words))
        if None not in parts:
            return parts
        needed = {w for w, part in zip(words, parts, strict=True) if part is None}
        found = {w: self._older[w] for w in needed if w in self._older}
        missing = [w for w in needed if w not in found]
        found.update(zip(missing, self._encode(missing), strict=True))
        for word, part in found.items():
            if len(word) > MAX_LENGTH:
                continue
            size = ENTRY + 4 * len(word) + len(part)
            if self._size + size > GENERATION:
                self._older, self._known, self._size = self._known, {}, 0
            self._known[word] = part
            self._size += size
        return [found[w] if part is None else part for w, part in zip(words, parts, strict=True)]
