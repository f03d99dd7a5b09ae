"""Characters that look alike: one table, used as a JVM expression and in Python.

Folding keeps what a reader sees apart: superscripts, circled digits and letter case stay as they are.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters and the Greek, Cyrillic, Armenian and other letters drawn like them.
LOOKALIKES = {
    "A": "ΑАᎪ", "B": "ΒВᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ΕЕᎬ", "F": "Ϝ", "G": "ԌᏀ", "H": "ΗНᎻ", "I": "ΙІӀ", "J": "ЈᎫͿ", "K": "ΚКᏦ", "L": "Ꮮ",
    "M": "ΜМᎷϺ", "N": "Ν", "O": "ΟОՕ", "P": "ΡРᏢ", "Q": "Ԛ", "S": "ЅՏᏚ", "T": "ΤТᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ", "X": "ΧХ", "Y": "ΥҮ", "Z": "ΖᏃ",
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "іιı", "j": "јϳ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛ", "s": "ѕ", "u": "սυ", "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уүγ", "z": "ᴢ",
}
# Ranges of characters that are not displayed.
INVISIBLE_RANGES = [
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F),
    (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0),
]
# Ranges of blanks other than U+0020.
BLANK_RANGES = [(0x0009, 0x000D), (0x0085, 0x0085), (0x00A0, 0x00A0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
INVISIBLE = "".join(chr(c) for a, b in INVISIBLE_RANGES for c in range(a, b + 1))
BLANKS = "".join(chr(c) for a, b in BLANK_RANGES for c in range(a, b + 1))


def _compatible(ch: str) -> str | None:
    """What ``ch`` is drawn as, where Unicode calls it a wide, narrow, ligature or radical form of that."""
    kind = unicodedata.decomposition(ch)
    wide = kind.startswith(("<wide>", "<narrow>"))
    radical = kind.startswith("<compat>") and ("⺀" <= ch <= "⿕" or "ﬀ" <= ch <= "ﬆ" or "㄰" <= ch <= "㆏")
    return "".join(chr(int(x, 16)) for x in kind.split()[1:]) if wide or radical else None


@lru_cache(maxsize=65536)
def fold_char(ch: str) -> str:
    """The form one character is compared in; empty for an invisible one."""
    if " " < ch < "\x7f":
        return ch
    if ch in INVISIBLE:
        return ""
    if ch in BLANKS:
        return " "
    same = _compatible(ch)
    if same is not None:
        return "".join(map(fold_char, same))
    parts = unicodedata.normalize("NFD", ch)
    if parts != ch:
        return "".join(map(fold_char, parts))
    return FOLDED.get(ch, ch)


FOLDED = {alike: plain for plain, all_alike in LOOKALIKES.items() for alike in all_alike}


def skeleton(text: str) -> str:
    """``text`` in the form in which texts that display alike are equal."""
    if text.isascii() and text.isprintable():
        return text
    return unicodedata.normalize("NFC", "".join(map(fold_char, text)))


def _tables() -> tuple[str, str, dict[str, str]]:
    """For the JVM: characters to translate, what they become, and characters that become several."""
    one, several = {}, {}
    for code in [*range(0x80, 0x3400), *range(0xF900, 0xFB07), *range(0xFE00, 0xFE10), *range(0xFEFF, 0xFF00), *range(0xFF00, 0xFFEF)]:
        ch = chr(code)
        same = unicodedata.normalize("NFC", fold_char(ch))
        if same != ch and unicodedata.category(ch) != "Mn":
            (one if len(same) <= 1 else several)[ch] = same
    gone = [c for c, same in one.items() if not same]
    kept = [c for c, same in one.items() if same]
    return "".join(kept + gone), "".join(one[c] for c in kept), several


def fold_column(column: Column) -> Column:
    """JVM form of ``skeleton`` for precomposed text; combining marks are left as they are."""
    source, target, several = _tables()
    folded = F.translate(column, source, target)
    ligatures = {c: s for c, s in several.items() if "ﬀ" <= c <= "ﬆ"}
    for ch, same in ligatures.items():
        folded = F.replace(folded, F.lit(ch), F.lit(same))
    return folded
