"""Chains of wrong decodings: how a text comes out garbled, and back."""

from __future__ import annotations

import re
import unicodedata

LOST = "�"
# Character sets in which UTF-8 text is often read by mistake.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "gbk", "big5", "shift_jis", "euc_kr")
# Sets of one byte a character in which Western text is read by mistake.
WESTERN_AS = ("cp1251", "koi8_r", "mac_roman", "cp437", "cp850", "cp1250", "cp1253")
TWICE = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850")
NON_ASCII = re.compile(r"[^\x00-\x7f]")
RUN = re.compile(r"[^\x00-\x7f]+")


def read(data: bytes, charset: str) -> str:
    """Decode as lenient readers do: bytes without a meaning in cp125x stay control characters."""
    if charset.startswith("cp125"):
        return "".join(bytes([b]).decode(charset, "ignore") or chr(b) for b in data)
    return data.decode(charset, "replace")


def write(text: str, charset: str) -> bytes:
    """The inverse of read; raises UnicodeError where text can't have come out of read."""
    if charset.startswith("cp125"):
        return b"".join(bytes([ord(c)]) if 0x80 <= ord(c) < 0xA0 else c.encode(charset) for c in text)
    return text.encode(charset)


def garbled(text: str) -> list[tuple[str, str]]:
    """(chain, garbled form) under every chain that changes the text."""
    if not NON_ASCII.search(text):
        return []
    utf8, out = text.encode("utf-8", "surrogatepass"), {}
    for charset in READ_AS:
        out[f"utf8>{charset}"] = read(utf8, charset)
    for charset in TWICE:
        out[f"utf8>{charset}>utf8>{charset}"] = read(out[f"utf8>{charset}"].encode("utf-8", "surrogatepass"), charset)
    out["utf8>cp1252 thrice"] = read(out["utf8>cp1252>utf8>cp1252"].encode("utf-8", "surrogatepass"), "cp1252")
    out["utf8>ascii"] = "".join(chr(b) if b < 128 else LOST for b in utf8)
    for western in ("cp1252", "mac_roman"):
        try:
            one = text.encode(western)
        except UnicodeError:
            continue
        if western == "cp1252":
            for charset in WESTERN_AS:
                out[f"{western}>{charset}"] = read(one, charset)
            out["cp1252>utf8"] = one.decode("utf-8", "replace")
        else:
            out[f"{western}>cp1252"] = read(one, "cp1252")
    return [(chain, form) for chain, form in out.items() if form != text]


def by_byte(chain: str) -> bool:
    """Chains between sets of one byte a character: their forms are letters again and need a whole word as evidence."""
    return not chain.startswith("utf8>") and chain != "cp1252>utf8"


def _plausible(text: str) -> bool:
    """One script and no control, private or unassigned character: what a decoding by chance rarely gives."""
    kinds = {unicodedata.category(c) for c in text if c > "\x7f"}
    return not kinds & {"Cc", "Co", "Cn", "Cs"} and len({unicodedata.name(c, " ").split(" ")[0] for c in text if c.isalpha()}) <= 1


def restored(text: str) -> str | None:
    """The text before UTF-8 was read wrongly, up to three times, if every step inverts without loss; else None."""
    for charset in READ_AS:
        now = text
        for _ in range(3):
            try:
                before = write(now, charset).decode("utf-8")
            except (UnicodeError, ValueError):
                break
            if before == now:
                break
            now = before
        if now != text and _plausible(now):
            return now
    return None
