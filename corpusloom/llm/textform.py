"""The one text form: tables and a scalar kernel.

Two texts a reader cannot tell apart get the same form. A code point is replaced by its
decomposition (canonical, or a compatibility decomposition that keeps the visible shape: width,
no-break, radical and presentation variants), look-alike letters become one letter, invisible
format characters vanish, every kind of blank becomes U+0020, marks are put in class order and
recomposed. Line breaks and tabs stay. Superscripts, circled numbers, fractions and styled letters
look different to a reader and keep their code points.

``fold_table`` is the single source of the mapping: the relational operator (``visual``) joins it as
a table, the Arrow kernels of the other operators use :func:`canonical` on whole batches.
"""

from __future__ import annotations

import functools
import re
import unicodedata

# Decomposition tags of the Unicode character database that keep the visible shape.
KEPT_TAGS = ("", "<wide>", "<narrow>", "<noBreak>", "<compat>", "<isolated>", "<initial>", "<medial>", "<final>", "<small>", "<vertical>")

# Look-alike letters, each string of the left written as the letter of the same place on the right.
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνο", "ABEZHIKMNOPTYXvo")
CYRILLIC = ("АВЕЅІЈКМНОРСТУХаеорсухѕіјԁһԛԝѵѴԌԚԜүҮ", "ABESIJKMHOPCTYXaeopcyxsijdhqwvVGQWyY")
ARMENIAN = ("օսոհզցյՏԼՕՍ", "ounhqgjSLOU")
CHEROKEE = ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᏔᏃ", "ABCDEGHJKLMPRSTVWZ")
DOTS = ("·‧∙⋅ᐧ᛫", "・・・・・・")
LATIN_FORMS = ("ıɡɑ", "iga")
HYPHENS = ("‐‑‒–−〜", "-----~")
KANA_HAN = ("一二八口力工夕卜丿ヘベペ", "ーニハロカエタトノへべぺ")

# Invisible format characters.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤﻿"

#: Common code points; those of them that fold to themselves make up the safe class, which only serves to skip work.
COMMON = ((0x09, 0x0A), (0x20, 0x7E), (0xC0, 0xFF), (0x3001, 0x3029), (0x3041, 0x3096), (0x30A1, 0x30FC), (0x4E00, 0x9FFF))


def _decompose(ch: str) -> str:
    tag, _, rest = unicodedata.decomposition(ch).rpartition("> ")
    tag = tag + ">" if tag else ""
    if not rest or tag not in KEPT_TAGS or "\u3131" <= ch <= "\u318e":  # letters of the Hangul alphabet must not join into syllables
        return ch
    return "".join(_decompose(chr(int(x, 16))) for x in rest.split())


@functools.cache
def lookalikes() -> dict[str, str]:
    pairs = (GREEK, CYRILLIC, ARMENIAN, CHEROKEE, LATIN_FORMS, DOTS, HYPHENS, KANA_HAN)
    return {a: b for left, right in pairs for a, b in zip(left, right, strict=True)}


@functools.cache
def fold_table() -> dict[str, str]:
    """Code point -> the code points it is replaced by, before marks are ordered and recomposed."""
    alike, out = lookalikes(), {}
    for cp in [*range(0x20, 0xAC00), *range(0xD7A4, 0xD800), *range(0xF900, 0x20000), *range(0x2F800, 0x2FA20)]:
        ch = chr(cp)
        if ch in INVISIBLE:
            out[ch] = ""
            continue
        parts = [" " if unicodedata.category(x) == "Zs" else alike.get(x, x) for x in _decompose(ch)]
        # a compatibility form of a blank can decompose to blank + mark (spacing accents): keep those as they are
        new = ch if len(parts) > 1 and parts[0] == " " else "".join(parts)
        new = "".join(_decompose(x) for x in new) if new != ch else new
        if new != ch:
            out[ch] = new
    return out


@functools.cache
def mark_classes() -> dict[str, int]:
    return {chr(c): k for c in [*range(0x300, 0x11000), *range(0x11000, 0x1F000)] if (k := unicodedata.combining(chr(c)))}


@functools.cache
def compositions() -> dict[str, str]:
    """Starter + mark -> composed code point, after folding."""
    out = {}
    for cp in [*range(0xA0, 0xAC00), *range(0xF900, 0x1E000)]:
        d = unicodedata.decomposition(chr(cp))
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", chr(cp)) == chr(cp):
            out["".join(chr(int(x, 16)) for x in d.split())] = chr(cp)
    return out


@functools.cache
def hangul_sequences() -> dict[str, str]:
    """Conjoining letters, or a syllable and a final letter, -> syllable."""
    out = {}
    for c in range(0xAC00, 0xD7A4):
        parts = unicodedata.normalize("NFD", chr(c))
        out[parts] = chr(c)
        if len(parts) == 3:
            out[unicodedata.normalize("NFC", parts[:2]) + parts[2]] = chr(c)
    return out


@functools.cache
def safe_class() -> str:
    """Body of a regex class (Python and Java) of code points whose form is themselves unless a mark follows."""
    fold, runs = fold_table(), []
    for low, high in COMMON:
        for cp in range(low, high + 1):
            if unicodedata.normalize("NFC", fold.get(chr(cp), chr(cp))) == chr(cp):
                if runs and runs[-1][1] == cp - 1:
                    runs[-1][1] = cp
                else:
                    runs.append([cp, cp])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


@functools.cache
def _kernel():
    codes = {ord(a): b for a, b in fold_table().items()}
    # most code points are safe ones: only the runs of others are looked up
    others = re.compile(f"[^{safe_class()}]+").sub
    return re.compile(f"[{safe_class()}]*\\Z").match, functools.partial(others, lambda m: m[0].translate(codes)), codes, unicodedata.normalize


def canonical(text: str) -> str:
    """The form of one text. Null is the caller's case; an empty text is its own form."""
    safe, folded, _, normalize = _kernel()
    if safe(text):
        return text
    return normalize("NFC", folded(text))


def canonical_plain(text: str) -> str:
    """The form by the plain definition, without the shortcuts."""
    return unicodedata.normalize("NFC", text.translate(_kernel()[2]))
