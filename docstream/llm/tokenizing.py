"""Shared by the operators that tokenise: tokenizer files as bytes, and bounded memories of distinct words."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct words that a worker remembers; the older half goes when twice as many have been seen.
REMEMBERED = 500_000


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary file of that name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_file(path: str) -> str:
    """The tokenizer's JSON, to be sent to the workers: of fixed size, whatever the corpus."""
    return Path(path).read_text(encoding="utf-8")


def load(json_text: str):
    """A tokenizer as the library gives it, without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json_text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Memory:
    """word -> value for the words seen lately; ``fill`` works out many missing ones at once."""

    def __init__(self, fill: Callable[[list], list], size: int = REMEMBERED):
        self.fill, self.size = fill, size
        self.new: dict = {}
        self.old: dict = {}

    def ready(self, words: set) -> dict:
        """A dict that holds all of ``words``, valid until the next call."""
        missing = words.difference(self.new)
        if missing:
            if len(self.new) >= self.size:
                self.old, self.new = self.new, {}
                missing = words
            known = missing.intersection(self.old)
            self.new.update((w, self.old[w]) for w in known)
            asked = list(missing.difference(known))
            self.new.update(zip(asked, self.fill(asked), strict=True))
        return self.new


_kept: dict = {}


def once(key: tuple, make: Callable):
    """What ``make`` gives, kept for the life of a worker; one thing for each kind of key."""
    if _kept.get(key[0], (None,))[0] != key:
        _kept[key[0]] = (key, make())
    return _kept[key[0]][1]
