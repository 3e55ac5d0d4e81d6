"""Look-alike characters: prototypes, skeletons and the usual form of a text."""

from __future__ import annotations

import re
import unicodedata

# Characters of other scripts (Cyrillic, Greek, Armenian, Coptic, Cherokee, Lisu and others) and the Latin letter that each looks like.
LOOKALIKE_GROUPS = {
    "a": "аαɑ", "b": "Ьƅ", "c": "сϲⲥ", "d": "ԁ", "e": "еҽ", "g": "ɡց", "h": "һհ", "i": "іιɩᎥ", "j": "јϳ", "k": "κ", "l": "ӏ", "n": "ոո",
    "o": "оοօσⲟ", "p": "рρⲣ", "q": "ԛ", "s": "ѕ", "u": "υսʋ", "v": "ѵν", "w": "ԝա", "x": "хχ", "y": "уγү",
    "A": "АΑⲀᎪꓮ", "B": "ВΒⲂᏴꓐ", "C": "СϹⲤᏟꓚ", "D": "Ꭰꓓ", "E": "ЕΕᎬꓰ", "F": "Ϝꓝ", "G": "ԌᏀꓖ", "H": "НΗⲎᎻꓧ", "I": "ІΙӀⲒꓲ", "J": "ЈͿᎫꓙ", "K": "КΚⲔᏦꓗ", "L": "Ꮮꓡ", "M": "МΜϺⲘᎷꓟ", "N": "ΝⲚꓠ",
    "O": "ОΟՕⲞꓳ", "P": "РΡⲢᏢꓑ", "Q": "Ԛ", "R": "Ꮢꓣ", "S": "ЅՏᏚꓢ", "T": "ТΤⲦᎢꓔ", "U": "Սꓴ", "V": "ѴᏙꓦ", "W": "ԜᏔꓪ", "X": "ХΧⲬꓫ", "Y": "УΥҮⲨꓬ", "Z": "ΖⲌᏃꓜ",
    "'": "ʼʹ՚",
}
# Latin letters that look like another Latin letter. They group values but are usual in their own languages.
WITHIN_LATIN = {"ı": "i", "ſ": "f", "ƒ": "f", "ɩ": "i"}
PROTOTYPE = {c: latin for latin, others in LOOKALIKE_GROUPS.items() for c in others}
INVERSE: dict[str, dict[str, str]] = {}
# Characters without a glyph that aren't of the category Cf, and compatibility kinds that change only the look.
UNSEEN = "͏ᅟᅠ឴឵ㅤﾠ"
LOOKS = ("<wide>", "<narrow>", "<font>", "<noBreak>")
JOINERS = "‌‍"
PLAIN = re.compile(r"[\x00-\x7f]*\Z")
WORD = re.compile(r"[^\W\d_]+(?:[̀-ͯ]*[^\W\d_]*)*")


def script(c: str) -> str:
    """The script of a letter, as the first word of its Unicode name; '' for what isn't a letter."""
    return unicodedata.name(c, " ").split(" ")[0] if c.isalpha() else ""


for _other, _latin in PROTOTYPE.items():
    INVERSE.setdefault(script(_other), {}).setdefault(_latin, _other)


def _unseen(text: str, at: int) -> bool:
    c = text[at]
    if c in JOINERS:  # they shape letters in Indic and Arabic scripts and are legitimate there
        near = text[at - 1 : at] + text[at + 1 : at + 2]
        return not (near and all(script(x) not in ("", "LATIN", "GREEK", "CYRILLIC") for x in near))
    return unicodedata.category(c) == "Cf" or c in UNSEEN or "︀" <= c <= "️"


def plain_look(text: str) -> str:
    """Composed letters, plain blanks and ordinary widths; nothing that can't be seen. Scripts stay."""
    if PLAIN.match(text):
        return text
    out = []
    for at, c in enumerate(text):
        if c < "\x80":
            out.append(c)
        elif _unseen(text, at):
            continue
        elif unicodedata.category(c) in ("Zs", "Zl", "Zp"):
            out.append(" ")
        elif unicodedata.decomposition(c).startswith(LOOKS) or "ﬀ" <= c <= "ﬆ":
            out.append(unicodedata.normalize("NFKC", c))
        else:
            out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def _one_script(word: str) -> str:
    letters = {c: script(c) for c in unicodedata.normalize("NFD", word) if c.isalpha()}
    scripts = set(letters.values())
    if len(scripts) < 2:
        return word
    decomposed = unicodedata.normalize("NFD", word)
    if all(s == "LATIN" or c in PROTOTYPE for c, s in letters.items()):
        return unicodedata.normalize("NFC", "".join(PROTOTYPE.get(c, c) for c in decomposed))
    for other in sorted(scripts - {"LATIN"}):
        table = INVERSE.get(other, {})
        if scripts == {"LATIN", other} and all(s != "LATIN" or c in table for c, s in letters.items()):
            return unicodedata.normalize("NFC", "".join(table.get(c, c) if letters.get(c) == "LATIN" else c for c in decomposed))
    return word


def usual_form(text: str) -> str:
    """plain_look with every word in one script: mixed words take the script all their letters can be shown in."""
    if PLAIN.match(text):
        return text
    return WORD.sub(lambda m: _one_script(m.group()), plain_look(text))


def latin_reading(text: str) -> str | None:
    """The same look in Latin letters where words of another script have no letter without a Latin look-alike; else None."""
    letters = [c for c in unicodedata.normalize("NFD", text) if c.isalpha()]
    if not any(script(c) != "LATIN" for c in letters) or not all(script(c) == "LATIN" or c in PROTOTYPE for c in letters):
        return None
    return unicodedata.normalize("NFC", "".join(PROTOTYPE.get(c, c) for c in unicodedata.normalize("NFD", text)))


def digit_reading(text: str) -> str | None:
    """The text with 0 and 1 between letters, or behind one, read as the letters they look like; None if there are none."""
    read = re.sub(r"(?<=[^\W\d_])[01](?![\d.,/])", lambda m: ("o" if m.group() == "0" else "l") if text[m.start() - 1].islower() or m.start() == 1 else ("O" if m.group() == "0" else "I"), text)
    return read if read != text else None


def skeleton(text: str) -> str:
    """Decompose, replace every character by its prototype, decompose again; equal skeletons look equal."""
    once = unicodedata.normalize("NFD", plain_look(digit_reading(text) or text))
    return unicodedata.normalize("NFD", "".join(WITHIN_LATIN.get(c) or PROTOTYPE.get(c, c) for c in once))
