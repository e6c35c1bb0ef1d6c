"""Terms of a text, cut from its UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

_LONG = 1 << 20


def term_table(parting: str) -> bytes:
    """Translation of bytes: those in ``parting`` (ASCII) become blanks, A-Z become a-z."""
    return bytes(32 if chr(b) in parting else b + 32 if 65 <= b <= 90 else b for b in range(256))


#: All ASCII characters but letters part terms.
LETTERS = term_table("".join(map(chr, [*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])))
#: All ASCII characters but letters and digits do.
LETTERS_DIGITS = term_table("".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])))


def terms(text: str | None, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, in lists that come from about a megabyte each."""
    marked = (text or "").encode("utf-8", "surrogatepass").translate(table)
    at = 0
    while len(marked) - at > _LONG:
        cut = marked.find(b" ", at + _LONG)
        if cut < 0:
            break
        yield marked[at:cut].split()
        at = cut
    yield marked[at:].split()
