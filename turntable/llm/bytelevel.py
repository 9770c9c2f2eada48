"""The reversible alphabet that byte-level vocabularies are written in, and the files that hold them."""

from __future__ import annotations

import json


def _alphabet() -> list[str]:
    """A printable character for each byte: itself where it shows, else the next code point from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return [chr(byte) if byte in shown else chr(256 + hidden.index(byte)) for byte in range(256)]


ALPHABET = _alphabet()
BYTE_OF = {character: byte for byte, character in enumerate(ALPHABET)}
_ALWAYS = float("inf")
_LATIN = str.maketrans({chr(byte): character for byte, character in enumerate(ALPHABET)})


def spelled(raw: bytes) -> str:
    """Bytes in the alphabet of the vocabulary."""
    return raw.decode("latin-1").translate(_LATIN)


class Merges:
    """A vocabulary and its merge list: which tokens exist, how each is put together, and which pairs merge.

    `rank[t]` is the place of the merge that makes token t (-1 for single symbols), `parts[t]` its
    two halves.
    """

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as source:
            loaded = json.load(source)
        model = loaded["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.id_of: dict[str, int] = model["vocab"]
        self.special = {entry["content"]: entry["id"] for entry in loaded["added_tokens"]}
        self.spelling = {number: token for token, number in self.id_of.items()}
        self.spelling.update({number: token for token, number in self.special.items()})
        self.rank = dict.fromkeys(self.id_of.values(), -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for place, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made = self.id_of[left + right]
            key = self.id_of[left], self.id_of[right]
            self.merge.setdefault(key, place)
            if made not in self.parts:
                self.parts[made] = key
                self.rank[made] = place
        self.known_beside: dict[tuple[int, int], bool] = {}
        self._left: dict[int, list[tuple[int, float]]] = {}
        self._right: dict[int, list[tuple[int, float]]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces that stand at one edge of a token while it is put together, each with the rank that ends it."""
        edge, ends = [], _ALWAYS
        while True:
            edge.append((token, ends))
            if token not in self.parts:
                return edge
            ends = self.rank[token]
            token = self.parts[token][side]

    def beside(self, left: int, right: int, below: float = _ALWAYS) -> bool:
        """Whether two tokens stay apart when their symbols stand side by side.

        They do unless some merge joins a piece at the right edge of `left` with a piece at the left
        edge of `right` while both stand. Of equal merges the leftmost comes first, so a piece of
        `left` is used up by a merge of the same rank, and a piece of `right` is not yet.
        """
        key = left, right
        if below is _ALWAYS and (known := self.known_beside.get(key)) is not None:
            return known
        if left not in self._right:
            self._right[left] = self._edge(left, 1)
        if right not in self._left:
            self._left[right] = self._edge(right, 0)
        apart = True
        for a, a_ends in self._right[left]:
            for b, b_ends in self._left[right]:
                place = self.merge.get((a, b))
                if place is not None and place < a_ends and place <= b_ends and place < below:
                    apart = False
        if below is _ALWAYS:
            if len(self.known_beside) > 200_000:
                self.known_beside.clear()
            self.known_beside[key] = apart
        return apart

    def whole(self) -> dict[str, int]:
        """The tokens that their own symbols merge into; others never come out of the merge list."""
        reached: dict[int, bool] = {}
        for token in sorted(self.id_of.values(), key=self.rank.__getitem__):
            if token in self.parts:
                left, right = self.parts[token]
                reached[token] = reached[left] and reached[right] and self.beside(left, right, self.rank[token])
            else:
                spelling = self.spelling[token].removesuffix(self.suffix) if self.suffix else self.spelling[token]
                reached[token] = len(spelling) == 1
        return {self.spelling[token]: token for token, ok in reached.items() if ok}
