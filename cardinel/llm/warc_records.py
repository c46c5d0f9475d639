"""Records of a web archive file, as bytes: found by their lengths, whatever they contain."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

# Marks of the format.
VERSION = b"WARC/"
END = b"\r\n"
PIECE = 1 << 20


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def unpacked(data: bytes) -> Iterator[bytes]:
    """Pieces of the plain bytes of a file: gzip members one after another, or as they are.

    What follows the last whole member is passed over.
    """
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    at = 0
    while data[at : at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        while not member.eof and at < len(data):
            piece = data[at : at + PIECE]
            at += len(piece)
            try:
                yield member.decompress(piece)
            except zlib.error:
                return
        at -= len(member.unused_data)


class Reader:
    """Bytes that are read from pieces, holding one record and one piece at a time."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.data, self.at, self.passed = pieces, b"", 0, 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.passed += self.at
        self.data, self.at = self.data[self.at :] + piece, 0
        return True

    @property
    def offset(self) -> int:
        return self.passed + self.at

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None if it does not come."""
        start = self.at
        while (found := self.data.find(mark, start)) < 0:
            seen = len(self.data) - self.at
            if not self._more():
                return None
            start = self.at + max(0, seen - len(mark) + 1)
        got = self.data[self.at : found + len(mark)]
        self.at = found + len(mark)
        return got

    def take(self, n: int) -> bytes:
        """The next n bytes, fewer at the end."""
        have = [self.data[self.at : self.at + n]]
        self.at += len(have[0])
        left = n - len(have[0])
        while left > 0 and self._more():
            have.append(self.data[:left])
            self.at = len(have[-1])
            left -= len(have[-1])
        return b"".join(have)

    def skip(self, mark: bytes) -> bool:
        while len(self.data) - self.at < len(mark) and self._more():
            pass
        if self.data.startswith(mark, self.at):
            self.at += len(mark)
            return True
        return False


def fields(head: bytes) -> list[tuple[str, str]]:
    """Names in small letters and values; a line that begins with a blank goes on the last."""
    found: list[tuple[str, str]] = []
    for line in head.split(END):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            found.append((name.strip().lower(), value.strip()))
    return found


def records(data: bytes) -> Iterator[tuple[int, list[tuple[str, str]], bytes, bool]]:
    """Offset, header fields, block and wholeness of each record of a file.

    Bytes between records are passed over up to the next version mark. A record that is
    cut off by the end of the file comes with what is there, and is not whole.
    """
    reader = Reader(unpacked(data))
    while True:
        offset = reader.offset
        head = reader.until(END + END)
        if head is None:
            return
        start = head.find(VERSION)
        if start < 0:
            continue
        own = fields(head[start:])
        length = next((v for k, v in own if k == "content-length"), "")
        if not length.isdecimal():
            yield offset + start, own, b"", False
            continue
        block = reader.take(int(length))
        whole = len(block) == int(length)
        yield offset + start, own, block, whole
        while reader.skip(END):
            pass


def payload_of(block: bytes, content_type: str) -> tuple[bytes, bytes]:
    """Head and payload of a block: what follows the header of an HTTP message, or all."""
    if not content_type.lower().startswith("application/http"):
        return b"", block
    head, mark, payload = block.partition(END + END)
    return (head + mark, payload) if mark else (block, b"")
