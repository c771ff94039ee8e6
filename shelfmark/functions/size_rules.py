"""Patterns of the free-text size attribute of the two feeds.

Each rule is one way a shop writes three lengths. ``groups`` names the capture
group of length, width and height (``None``: this rule leaves it NULL); ``scale``
is the factor to millimetres; ``comma`` says per dimension whether a decimal comma
counts as a dot (``d``) or ends the number (``c``). The first matching rule wins.

Without its numbers and spaces, a text that a rule matches is always the same few
letters, the rule's *letters*. They tell at once which few rules can match at all.
Rules that accept other text around their numbers are *open*: they name letters
that must occur.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

Dims = tuple[int | None, int | None, int | None]

# Number forms and, below, the size patterns of the two feeds.
N = r"([0-9.,]+)"  # digits with dots or commas
D = r"([0-9]+(?:\.[0-9]+)?)"  # decimal with a dot
C = r"([0-9]+(?:,[0-9]+)?)"  # decimal with a comma
B = r"[\t\n\f\r\p{Z}]"  # one white space, also no-break space
S = B + "*"
LEFT_TO_RIGHT_MARK = "\u200e"
# every character class Z, the other white space, digits and their separators
NOT_LETTERS = (
    "0123456789.,"
    "\t\n\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000" + LEFT_TO_RIGHT_MARK
)


def bare_letters(text: str) -> str:
    return text.translate({ord(c): None for c in NOT_LETTERS})


@dataclass(frozen=True)
class SizeRule:
    name: str
    pattern: str
    groups: Dims = (1, 2, 3)
    scale: tuple[int, int, int] = (1, 1, 1)
    comma: str = "ccc"
    text: str = "trimmed"  # trimmed | raw | unmarked
    exact: str = "nnn"  # per dimension: multiply before rounding to two places
    needs: str | None = None  # set for an open rule: letters that must occur

    def letters(self) -> set[str]:
        """What texts of this rule look like without numbers and spaces."""
        text = self.pattern
        for token in (N, D, C, S, B):
            text = text.replace(token, "")
        optional = re.compile(r"\(\?:([^()]*)\)\?")
        forms = {optional.sub("", text), optional.sub(r"\1", text)}
        return {bare_letters(re.sub(r"\\(.)", r"\1", form.strip("^$"))) for form in forms}


FEED_A_SIZES: tuple[SizeRule, ...] = (
    SizeRule("1", f"^{N} x {N} x {N} cm$", scale=(10, 10, 10), comma="ddd"),
    SizeRule("2", f"^Cao: {N} mm x Rộng: {N} mm x Dày: {N} mm$", groups=(1, 3, 3), comma="ddd"),
    SizeRule("3", f"^{N} x {N} x {N} mm$"),
    SizeRule("4", f"^{N} x {N} x {N}mm$", comma="ccd"),
    SizeRule("5", f"^Dài: {N}mm \\| Rộng: {N} mm \\| Cao: {N} mm$"),
    SizeRule("6", f"^{N} x {N} x {N} mm \\(Cao x Rộng x Dày\\)$"),
    SizeRule("7", f"^{N}x{N}x{N}mm$"),
    SizeRule("8", f"^Cao {N} mm x Rộng {N} mm x Dày {N} mm$"),
    SizeRule("9", f"^{N} mm x {N} mm x {N} mm$"),
    SizeRule("10", f"^{N} x {N} x {N}cm$", scale=(10, 10, 10)),
    SizeRule("11", f"^{N} x {N} x {N} mm \\(Dài x Rộng x Cao\\)$", comma="ddd"),
    SizeRule("12", f"^{N}mm \\* {N}mm \\* {N}mm$", comma="ddd"),
    SizeRule("13", f"^{N}mm \\* {N}mm \\* {N}mm.$", comma="ddd", needs="mm*mm*mm"),
    SizeRule("14", f"^{N} ×{N} ×{N} mm$", comma="ddd"),
    SizeRule(
        "15",
        f"^- Bàn phím: Dài {N} cm - ngang {N} cm - cao {N} cm"
        f" - Chuột: Dài {N} cm - ngang {N} cm - cao {N} cm$",
        groups=(4, 5, 6),
        scale=(10, 10, 1),
        comma="dcc",
    ),
    SizeRule("17", f"^{N} x {N} x{N} mm$"),
    SizeRule("18", f"^{N} × {N} × {N} mm$"),
    SizeRule("19", f"^{N}cm × {N}cm × {N}cm$", groups=(3, 2, 1), scale=(10, 10, 10)),
    SizeRule("20", f"^{N}\\*{N}\\*{N}mm$"),
    SizeRule("21", f"^{N} x{N} x {N} mm$"),
    SizeRule(
        "22", f"^Dài: {N}cm Cao : {N} cm Rộng : {N}cm$", groups=(1, 3, 2), scale=(10, 10, 1), comma="cdc"
    ),
    SizeRule(
        "23", f"^Dài {N} cm - ngang {N} cm - cao {N} cm Độ dài dây: {N} m$", scale=(10, 10, 10)
    ),
    SizeRule("24", f"^Cao {N} mm x Rộng {N} mm x Sâu {N} mm$", comma="ccd"),
    SizeRule("25", f"^{N} x {N} x {N} in \\({N} x {N} x {N} mm\\)$", groups=(4, 5, 6), comma="ddd"),
    SizeRule("26", f"^Cao {N}cm x Rộng {N}cm x Dày {N}cm$", scale=(10, 10, 10), comma="ddd"),
    SizeRule("27", f"^{N}x{N}x{N}cm$", scale=(10, 10, 10), comma="ddd"),
    SizeRule(
        "28", f"Chuột : Dài: {N}cm, Cao : {N} cm, Rộng : {N}cm", groups=(1, 3, 2), scale=(10, 10, 1), comma="ddd", needs="Chuột:Dài:cmCao:cmRộng:cm"),
    SizeRule("29", f"{N} x {N} x {N} cm \\({N} x {N} x {N} in\\)", scale=(10, 10, 10), needs="xxcm(xxin)"),
)

FEED_B_SIZES: tuple[SizeRule, ...] = (
    SizeRule("1", f"Dài{B}{D}{S}x{S}Rộng{B}{D}{S}x{S}Cao{B}{D}", text="raw", needs="xRộng"),
    SizeRule("2", f"^{D}{S}x{S}{D}{S}x{S}{D}{S}(?:mm)?$", text="raw"),
    # centimetres: length and width keep the digits beyond the second place, the
    # height is only read when the text is written with single spaces
    SizeRule("2+5", f"^{D} x {D} x {D} cm$", scale=(10, 10, 10), text="raw", exact="yyn"),
    SizeRule(
        "2 cm",
        f"^{D}{S}x{S}{D}{S}x{S}{D}{S}cm$",
        groups=(1, 2, None),
        scale=(10, 10, 10),
        text="raw",
        exact="yyn",
    ),
    # the same in millimetres with spaces around it: length and width need the
    # single-space form, the height does not
    SizeRule("2+6", f"^{D} x {D} x {D} mm$"),
    SizeRule("2 height", f"^{D}{S}x{S}{D}{S}x{S}{D}{S}(?:mm)?$", groups=(None, None, 3)),
    SizeRule("3", f"^{D}{S}mm{S}x{S}{D}{S}mm{S}x{S}{D}{S}mm$"),
    SizeRule("4", f"{D}\\*{D}\\*{D}mm", text="raw", needs="**mm"),
    SizeRule("5", f"^{N} x {N} x {N} cm$", scale=(10, 10, 10), comma="ddd"),
    SizeRule("6", f"^{N} x {N} x {N} mm$", comma="ddd"),
    SizeRule("7", f"^{N} x {N} x {N}mm, {N} x {N} x {N}mm$", groups=(1, 5, 6), comma="ddd"),
    SizeRule(
        "8",
        f"^Chiều cao: {N} mm, Chiều rộng: {N} mm, Chiều dày: {N} mm(?:, Trọng lượng: {N} g)?$",
        comma="ddd",
    ),
    SizeRule("9", f"^{N} x {N} x {N} \\( mm \\) \\( Dài x Rộng x Cao \\)$", comma="ddd"),
    SizeRule("10", f"^{N}\\(L\\)x{N}\\(w\\)x{N}\\(H\\) mm$", comma="ddd"),
    SizeRule("11", f"^{N}\\(L\\) x {N}\\(W\\) x {N}\\(H\\) mm$", comma="ddd"),
    SizeRule("12", f"^{N} x {N} x {N} cm$", scale=(10, 10, 10), comma="ddd", text="unmarked"),
    SizeRule(
        "13",
        f"^\\({N}\\) x {N} x {N} \\( mm \\) \\( Dài x Rộng x Cao \\)$",
        groups=(1, None, None),
        comma="ddd",
        text="unmarked",
    ),
    SizeRule("14", f"^\\({N} x {N} x {N} \\( mm \\) \\( Dài x Rộng x Cao \\)$"),
    SizeRule("15", f"^{D} x {D} x {D} \\(mm\\)$"),
    # a list of triples: length of the first, width and height of the last
    SizeRule("16", f"^{D} x (?:{D} x {D} mm, (?:{D} x {D} x {D} mm, )*{D} x )?{D} x {D} mm$", groups=(1, 8, 9), needs="xxmm"),
    SizeRule("17", f"^{C} mm x {C} mm x {C} mm$", comma="ddc"),
    SizeRule("18", f"^{D} \\(dài\\) x {D} \\(rộng\\) x {D} mm \\(cao\\)$"),
    SizeRule("19", f"Length: {D} mm / {D} in, Width: {D} mm / {D} in, Height: {D} mm / {D} in", groups=(1, 3, 5), needs="Length:mm/in"),
    SizeRule("20", f"Dài: {D} mm / {D} in, Rộng: {D} mm / {D} in, Cao: {D} mm / {D} in", groups=(1, 3, 5), needs="Dài:mm/in"),
    SizeRule(
        "21",
        f"Chiều dài: {C} mm / {C} inch Chiều rộng: {C} mm / {C} inch Chiều cao: {C} mm / {C} inch",
        groups=(1, 3, 5),
        comma="dcd", needs="Chiềudài:mm/inch"),
)
