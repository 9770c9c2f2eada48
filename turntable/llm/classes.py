"""Character classes, folding and pieces as a tokenizer library has them, whatever Unicode versions are installed.

The `regex` module, Python's unicodedata and the libraries follow different versions of Unicode. What a library makes of each
code point is therefore asked of the library itself, once for each vocabulary. Texts without a code point on
which versions differ take the short way.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import regex

CLASSES = (r"\p{L}", r"\p{N}", r"\s")
_IN_ASCII = {r"\p{L}": "a-zA-Z", r"\p{N}": "0-9"}
_HIGH = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(maxsize=1)
def every_character() -> str:
    """All code points in order but surrogates, planes that are empty in every version, and those for private use."""
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xF0000)]))


def listed(characters: Iterable[str]) -> str:
    """Characters as the inside of a bracketed class, neighbours as ranges."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(rf"\U{low:08x}-\U{high:08x}" for low, high in runs)


def _search(characters: Iterable[str]) -> Callable[[str], object]:
    """Where a text holds one of some characters first, or None."""
    inside = listed(characters)
    return re.compile(f"[{inside}]").search if inside else lambda text: None


def holds_any(characters: Iterable[str]) -> Callable[[str], bool]:
    """Whether a text holds one of some characters, none of them ASCII.

    Python's expressions look a character up in a class of the first plane, but go through the ranges of a class that
    reaches beyond it one by one. Only characters beyond that plane are therefore asked of such a class, each once.
    """
    characters = set(characters)
    low = _search(one for one in characters if one < "\U00010000")
    high = _search(one for one in characters if one >= "\U00010000")

    def holds(text: str) -> bool:
        if text.isascii():
            return False
        return low(text) is not None or high("".join(set(_HIGH.findall(text)))) is not None

    return holds


def in_ascii(pattern: str) -> re.Pattern[str]:
    """What a pattern means in ASCII texts, for which Python's own expressions are faster."""
    out, at, inside = "", 0, False
    while at < len(pattern):
        name = next((name for name in _IN_ASCII if pattern.startswith(name, at)), None)
        if name:
            out += _IN_ASCII[name] if inside else f"[{_IN_ASCII[name]}]"
            at += len(name)
            continue
        step = 2 if pattern[at] == "\\" else 1
        if step == 1:
            inside = pattern[at] == "[" or (inside and pattern[at] != "]")
        out += pattern[at : at + step]
        at += step
    return re.compile(out, re.ASCII)


class Pieces:
    """Non-overlapping matches of a pattern, with the character classes of a library.

    `members` gives the characters of a text that the library puts into a class.
    """

    def __init__(self, pattern: str, members: Callable[[str, str], str]) -> None:
        exact, differing = pattern, set()
        for name in CLASSES:
            if name not in pattern and name.upper() not in pattern:
                continue
            theirs = set(members(name, every_character()))
            ours = set("".join(regex.findall(f"{name}+", every_character())))
            differing |= theirs ^ ours
            own = name + listed(theirs - ours)
            if ours - theirs:
                own += f"--[{listed(ours - theirs)}]"
            exact = exact.replace(name, f"[{own}]")
            if name == r"\s":
                exact = exact.replace(r"\S", f"[^[{own}]]")
        self.differing = frozenset(differing)
        self.differs = holds_any(differing)
        self._ascii = in_ascii(pattern)
        self._fast = regex.compile(pattern)
        self._exact = regex.compile(f"(?V1){exact}")

    def of(self, text: str) -> regex.Pattern | re.Pattern[str]:
        """The pattern that gives the library's matches in a text."""
        if text.isascii():
            return self._ascii
        return self._exact if self.differs(text) else self._fast


def tokenizers_members(name: str, text: str) -> str:
    """Characters of a class in the regular expressions of the tokenizers library."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return "".join(piece for piece, _ in Split(Regex(f"{name}+"), "removed", invert=True).pre_tokenize_str(text))


def tiktoken_members(name: str, text: str) -> str:
    """Characters of a class in the regular expressions of the tiktoken library."""
    from tiktoken import Encoding

    found = Encoding("class", pat_str=f"{name}+", mergeable_ranks={bytes([byte]): byte for byte in range(256)}, special_tokens={})
    return bytes(found.encode_ordinary(text)).decode()


class Folding:
    """Composition (NFC) and lower case by code point, as the normalizer of a library does both; white space is left as it is."""

    def __init__(self, library: Callable[[str], str]) -> None:
        self._library = library
        # Code points that Python's tables do not know yet may also compose with others in the library's.
        self.differs = holds_any(
            one
            for one in every_character()
            if not one.isascii() and (unicodedata.category(one) == "Cn" or (library(one) != self._plain(one) and not one.isspace()))
        )

    @staticmethod
    def _plain(text: str) -> str:
        # Python's lower() looks at what follows a sigma; the libraries' rule goes by characters.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def __call__(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        return self._library(text) if self.differs(text) else self._plain(text)
