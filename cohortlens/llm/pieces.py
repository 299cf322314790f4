"""Cutting text at white space, for tokenizers whose pre-tokens never span a word and the space after it."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: White space followed by the word it leads, or white space at the end.  A byte-level
#: pre-token never runs from a word into white space, so encoding piece by piece equals
#: encoding the text, as long as all white space of the text is ASCII.
_PIECE = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: White space for some definitions beyond space, tab, line feed, vertical tab, form feed, carriage return.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")


def pieces(text: str) -> list[str] | None:
    """The text cut before every run of white space; None when it holds other than ASCII white space."""
    if _OTHER_SPACE.search(text):
        return None
    return _PIECE.findall(text)


#: Characters worked on at once; longer texts are cut, so memory does not follow the longest text.
BLOCK = 1 << 21
_CUT = re.compile(r"(?<=\S)(?=[ \t-\r])")


def blocks(text: str) -> Iterator[str]:
    """The text in blocks of about BLOCK characters, cut between a word and the white space after it."""
    start = 0
    while len(text) - start > BLOCK and (cut := _CUT.search(text, start + BLOCK)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def by_blocks(texts: list[str], work: Callable[[list[str]], list]) -> list[list]:
    """Per text the results of ``work`` for its blocks; ``work`` gets blocks of at most about BLOCK characters in all."""
    out: list[list] = [[] for _ in texts]
    owners: list[int] = []
    held: list[str] = []
    size = 0

    def flush() -> None:
        for owner, result in zip(owners, work(held)):
            out[owner].append(result)

    for i, text in enumerate(texts):
        for block in blocks(text):
            owners.append(i)
            held.append(block)
            size += len(block)
            if size >= BLOCK:
                flush()
                owners, held, size = [], [], 0
    if held:
        flush()
    return out


class WorkerCache(dict):
    """Bounded memo of ``compute`` for one Python worker.

    Two generations of at most ``capacity`` entries: when the young one is full
    it becomes the old one, so entries in use survive and memory stays bounded.
    """

    def __init__(self, compute: Callable, capacity: int):
        super().__init__()
        self.compute, self.capacity, self.old = compute, capacity, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.remember(key, value)
        return value

    def remember(self, key, value) -> None:
        if len(self) >= self.capacity:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def held(self, key):
        """The key's value, which stays among the young; None when neither generation holds it."""
        value = self.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.remember(key, value)
        return value

    def unknown(self, keys: set) -> set:
        """Those keys that neither generation holds."""
        return keys.difference(self).difference(self.old)
