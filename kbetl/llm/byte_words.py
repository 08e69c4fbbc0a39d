"""Words of UTF-8 texts as bytes: one translation, one split, whatever the text's length."""

from __future__ import annotations

from collections.abc import Iterator

SLICE_BYTES = 1 << 20


def byte_table(kept: bytes) -> bytes:
    """A translation that lower-cases A-Z and blanks every ASCII byte that is not in ``kept`` then."""
    lower = bytes(range(256)).lower()
    return bytes(b if b >= 0x80 or b in kept else 0x20 for b in lower)


def words_of(text: bytes | None, translation: bytes, slice_bytes: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lists; a long text is cut into slices at blanks."""
    if not text:
        return
    plain = text.translate(translation)
    if len(plain) <= slice_bytes:
        yield plain.split()
        return
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + slice_bytes)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end
