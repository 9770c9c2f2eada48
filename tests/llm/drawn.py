"""Texts for comparing encoders with the libraries that define their vocabularies."""

import random

ALPHABETS = (
    "abcdefgh", "ABCxyz", "éüßñçøæ", "İıſΣσςK", "日本語漢字", "アイウあいう", "한국어", "абвгд", "0123456789", "²½Ⅷ٣৪", "'sdtrevml", " \t\n\r\x0b\x0c\x85\xa0 　​",
    "\x00\x1c\x1d\x1e\x1f\x7f", "!?.,-_#$%&()<>|", "́̈̃҈", "👍🏽❤️🇩🇪", "ՙ՚ऀ՘₏ᲉꟋ\U00016ea0\U00010d40", "가힣각", "�￿\U0010ffff",
)
STRINGS = ("<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "don't", "WE'RE", "it's", "'ll", "  ", "\n\n")


def drawn_texts(n, seed=1):
    draw = random.Random(seed)
    texts = ["", " ", "\n", "a", "The quick brown fox"]
    while len(texts) < n:
        parts = []
        for _ in range(draw.randint(1, 8)):
            if draw.random() < 0.15:
                parts.append(draw.choice(STRINGS))
            else:
                parts.append("".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(1, 7))))
        texts.append(draw.choice(["", " "]).join(parts))
    return texts


def all_code_points():
    """Texts that hold each code point alone, between letters, and before an elision.

    Planes 4 to 13 are empty and the last two for private use: of these, some at both ends stand for all.
    """
    codes = [*range(0x40000), *range(0xE0000, 0xF0000)]
    codes += [code for plane in (*range(4, 14), 15, 16) for end in (plane << 16, (plane << 16) + 0xFF00) for code in range(end, end + 256)]
    characters = [chr(code) for code in codes if not 0xD800 <= code < 0xE000]
    blocks = [characters[at : at + 20_000] for at in range(0, len(characters), 20_000)]
    return [text for block in blocks for text in ("\n".join(block), "".join(f"a{one}b " for one in block), "".join(f"{one}'re " for one in block))]
