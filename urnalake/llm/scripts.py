"""Character classes of the tokenizer libraries, which follow Unicode 16.0."""

from __future__ import annotations

import re
import unicodedata

import regex

# Code points that became letters after Unicode 16.0, first and last of each run.
NEWER_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3),
    (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191),
    (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
# The same for numbers.
NEWER_NUMBERS = ((0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6))

# Capitals that the libraries know and Python 3.13 does not, and how far their small letters are.
NEWER_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20),
    (0x16EA0, 0x16EB8, 0x1B),
)
# Marks that the tokenizer library's normal form takes for characters of their own.
MARKS_APART = (
    (0x7FD, 0x7FD), (0x899, 0x89B), (0x8CF, 0x8D3), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA), (0x1715, 0x1715),
    (0x1ABF, 0x1AC0), (0x1AC3, 0x1AC4), (0x1ACA, 0x1ACA), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10EFD, 0x10EFF),
    (0x10F46, 0x10F47), (0x10F4B, 0x10F4B), (0x10F4D, 0x10F50), (0x10F83, 0x10F83), (0x10F85, 0x10F85),
    (0x11070, 0x11070), (0x1133B, 0x1133B), (0x11839, 0x1183A), (0x1193D, 0x1193E), (0x11943, 0x11943),
    (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42),
    (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E4EC, 0x1E4EE),
)


def character_set(ranges) -> str:
    """Code point ranges as the inside of a character class."""
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


#: Finds a code point that the libraries take for a sign although Python's pattern module does not.
NEWER = re.compile(f"[{character_set((*NEWER_LETTERS, *NEWER_NUMBERS))}]")
#: Everything outside of Latin letters and common punctuation.
BEYOND_LATIN = re.compile("[^\u0000-ɏ -⁯]")


def with_older_classes(pattern: str) -> regex.Pattern:
    """``pattern`` with letters and numbers as in Unicode 16.0."""
    for name, newer in ((r"\p{L}", NEWER_LETTERS), (r"\p{N}", NEWER_NUMBERS)):
        pattern = pattern.replace(name, f"[{name}--[{character_set(newer)}]]")
    return regex.compile("(?V1)" + pattern)


def for_latin(pattern: str) -> re.Pattern:
    """``pattern`` for the faster pattern module, right where BEYOND_LATIN finds nothing."""
    known = [chr(c) for c in (*range(0x250), *range(0x2000, 0x2070))]
    classes = {name: "".join(re.escape(c) for c in known if regex.match(name, c)) for name in (r"\p{L}", r"\p{N}", r"\s")}
    inside = re.sub(r"\[\^?(?:\\s|\\p\{[LN]\})+\]", lambda m: _filled(m[0], classes), pattern)
    for name, members in classes.items():
        inside = inside.replace(name, f"[{members}]")
    return re.compile(inside.replace(r"\S", f"[^{classes[chr(92) + 's']}]"))


def _filled(character_class: str, classes: dict[str, str]) -> str:
    for name, members in classes.items():
        character_class = character_class.replace(name, members)
    return character_class


_APART = re.compile(f"([{character_set(MARKS_APART)}])")
_CAPITALS = {c: c + far for first, last, far in NEWER_CAPITALS for c in range(first, last + 1)}
_CAPITAL = re.compile(f"[{''.join(map(chr, _CAPITALS))}]")


def normal_form(text: str) -> str:
    """NFC as the tokenizer library has it: no mark moves across, or joins with, MARKS_APART."""
    if not _APART.search(text):
        return unicodedata.normalize("NFC", text)
    return "".join(unicodedata.normalize("NFC", part) for part in _APART.split(text))


def lower(text: str) -> str:
    """Lower case character by character: the final sigma is no exception."""
    if _CAPITAL.search(text):
        text = text.translate(_CAPITALS)
    return text.lower() if "Σ" not in text else "".join(map(str.lower, text))
