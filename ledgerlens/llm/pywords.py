"""Words in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in lists, each of about ``size`` bytes of it, so that
    a very long text is never held as one list.

    ``bytes.split()`` separates at space and U+0009 to U+000D and nothing else.
    """
    carry = b""
    for at in range(0, len(data), size):
        chunk = carry + data[at : at + size]
        block = chunk.split()
        carry = b""
        if block and at + size < len(data) and not chunk[-1:].isspace():
            carry = block.pop()
        if block:
            yield block
    # the last chunk leaves no carry
