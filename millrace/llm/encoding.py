"""Ids of whole texts by the tokenizers library, with one library call per distinct word.

A text is cut at white space into units whose pre-tokens do not depend on their neighbours,
so the ids of the text are the ids of its units in order. Most units are words that were
met before; their ids come from a bounded table of the worker. A new unit of plain Latin
letters with punctuation behind them is cut here and goes to the library's model; any other
new unit goes through the library's whole encoder.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np

ID = np.dtype("<u4")
#: Units that a worker remembers, and the longest one: some 100 MB a table.
REMEMBERED = 500_000
LONGEST = 48
# Unicode White_Space without the blank and the line feed.
_ODD_SPACE = "\\t\\x0b-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_ODD = re.compile(f"[{_ODD_SPACE}]")
_RUNS = re.compile(f"([ \\n{_ODD_SPACE}]+)|[^ \\n{_ODD_SPACE}]+")
# Letters whose lower case and composition are the same everywhere, then ASCII punctuation
# but for the apostrophe; a blank may stand before them.
_PLAIN = re.compile("( ?)([A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]+)([!-&(-/:-@\\[-`{-~]*)")


def load_tokenizer(path: str):
    """The tokenizer of a ``.json`` file, single-threaded: Spark uses the cores already."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Bytes that print stand for themselves, the others for the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_LETTERS = byte_letters()


def lettered(text: str) -> str:
    if text.isascii() and text.isprintable():
        return text.replace(" ", _LETTERS[0x20])
    return text.encode().decode("latin-1").translate(_LETTERS)


class Remembered(dict):
    """A bounded table from units to what ``make`` gives for them.

    When half of the room is full, the table starts anew and the full half stays to be
    asked once more, so units in use are kept.
    """

    def __init__(self, make: Callable[[str], object], prefix: str = "") -> None:
        super().__init__()
        self.make, self.prefix, self.old = make, prefix, {}

    def __missing__(self, unit: str):
        value = self.old.get(unit)
        if value is None:
            value = self.make(self.prefix + unit)
            if len(unit) > LONGEST:
                return value
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        self[unit] = value
        return value


class Units:
    """Values of the units of a text, for a byte-level tokenizer that keeps white space.

    A blank between two words belongs to the word after it; any other white space is a
    unit of its own. ``make`` gives the value of one unit. The library looks for special
    strings before anything else, so each ends a piece, and white space before it is one unit.
    """

    def __init__(self, make: Callable[[str], object], special: list[str]) -> None:
        self.bare = Remembered(make)
        self.spaced = Remembered(make, " ")
        self.special = special
        longest_first = sorted(map(re.escape, special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(longest_first)})")

    def __call__(self, text: str) -> list:
        for string in self.special:
            if string in text:
                break
        else:
            return self._piece(text)
        found = []
        # Every second piece is a special string.
        for place, piece in enumerate(self.cut.split(text)):
            if place % 2:
                found.append(self.bare[piece])
            else:
                found.extend(self._piece(piece))
        return found

    def _piece(self, text: str) -> list:
        if not text:
            return []
        lines = [line.split(" ") for line in text.split("\n")]
        if any("" in words for words in lines) or _ODD.search(text):
            return self._irregular(text)
        bare, spaced, found = self.bare, self.spaced.__getitem__, []
        for words in lines:
            if found:
                found.append(bare["\n"])
            found.append(bare[words[0]])
            found.extend(map(spaced, words[1:]))
        return found

    def _irregular(self, text: str) -> list:
        found, blank = [], False
        for run in _RUNS.finditer(text):
            unit = run[0]
            if run[1] is None:
                found.append((self.spaced if blank else self.bare)[unit])
                blank = False
            elif run.end() == len(text):
                found.append(self.bare[unit])
            else:
                # All but the last character stand alone; a last blank joins the word.
                if unit[:-1]:
                    found.append(self.bare[unit[:-1]])
                blank = unit[-1] == " "
                if not blank:
                    found.append(self.bare[unit[-1]])
        return found


class Words:
    """Values of the words of a text, for a tokenizer that drops white space."""

    def __init__(self, make: Callable[[str], object]) -> None:
        self.known = Remembered(make)

    def __call__(self, text: str) -> list:
        words = text.replace("\n", " ").split(" ")
        return list(map(self.known.__getitem__, filter(None, words)))


def id_bytes(path: str, keeps_space: bool) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers.

    ``keeps_space`` says which kind of file ``path`` is: byte-level pre-tokens with their
    blanks, or words in lower case without white space.
    """
    tokenizer = load_tokenizer(path)
    tokenize = tokenizer.model.tokenize
    little = sys.byteorder == "little" and array("I").itemsize == ID.itemsize

    def packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if little else np.array(ids, dtype=ID).tobytes()

    def by_model(part: str) -> bytes:
        return packed([token.id for token in tokenize(lettered(part))])

    parts = Remembered(by_model)

    def make(unit: str) -> bytes:
        plain = _PLAIN.fullmatch(unit)
        if plain is None or (plain[1] and not keeps_space):
            return packed(tokenizer.encode(unit, add_special_tokens=False).ids)
        blank, word, tail = plain.groups()
        if not keeps_space:
            word = word.lower()
        if tail:
            return parts[blank + word] + parts[tail]
        return by_model(blank + word)

    if not keeps_space:
        units = Words(make)
    else:
        added = tokenizer.get_added_tokens_decoder().values()
        if any(t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError("id_bytes takes added tokens only where they stand as written")
        units = Units(make, [t.content for t in added])
    return lambda text: b"".join(units(text))
