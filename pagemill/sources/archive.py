"""Bytes of a WARC file from any place on: plain, or gzip of one or many members.

A stream keeps what it has read since the last record began, so a reader can go back within it.
``place`` is the offset in the file from which reading could begin anew just here: any position of a
plain file, the start of a member of a packed one, else None. ``jump`` goes to such a place.
A packed stream ends early (``broken``) where a member cannot be unpacked; ``recover`` goes on at the next member that begins a record.
"""

from __future__ import annotations

import re
import zlib

CHUNK = 1 << 18
MAGIC = b"\x1f\x8b\x08"
#: The first two lines of a record.
RECORD = re.compile(rb"WARC/[0-9]\.[0-9]+\r?\n[A-Za-z][A-Za-z0-9-]*:")
LONGEST_LINE = 1 << 20


class Stream:
    """Shared by both kinds: a buffer of unpacked bytes with the position in it."""

    def __init__(self, file, size: int):
        self.file, self.size, self.broken = file, size, False
        self.buf, self.at = bytearray(), 0

    def more(self) -> bool:
        raise NotImplementedError

    def drop(self) -> None:
        """Forgets what was read."""
        del self.buf[: self.at]
        self.at = 0

    def line(self) -> bytes:
        """Up to the next line feed, or what there is; long lines come in parts."""
        seen = self.at
        while (end := self.buf.find(b"\n", seen)) < 0 and len(self.buf) - self.at < LONGEST_LINE:
            seen = len(self.buf)
            if not self.more():
                break
        end = min(end + 1 if end >= 0 else len(self.buf), self.at + LONGEST_LINE)
        out = bytes(self.buf[self.at : end])
        self.at = end
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) - self.at < n and self.more():
            pass
        out = bytes(self.buf[self.at : self.at + n])
        self.at += len(out)
        return out

    def record_follows(self) -> bool:
        """Whether only line ends lie before the next record, or the end."""
        at = self.at
        while True:
            while at < len(self.buf) and self.buf[at] in b"\r\n":
                at += 1
            if len(self.buf) - at >= 5 or not self.more():
                return len(self.buf) == at or self.buf[at : at + 5] == b"WARC/"


class Plain(Stream):
    packed = False

    def __init__(self, file, size: int):
        super().__init__(file, size)
        self.jump(0)

    def jump(self, offset: int) -> None:
        self.file.seek(offset)
        self.buf.clear()
        self.at, self.read_to = 0, offset

    def more(self) -> bool:
        got = self.file.read(CHUNK)
        self.read_to += len(got)
        self.buf += got
        return bool(got)

    def place(self) -> int:
        return self.read_to - len(self.buf) + self.at

    def fits(self, n: int) -> bool:
        """Whether a block of n bytes ends where a record may follow; it is not read for that."""
        end = self.place() + n
        if end > self.size:
            return False
        if end - self.read_to > CHUNK:
            here, at = self.place(), end
            self.jump(at)
            ok = self.record_follows()
            self.jump(here)
            return ok
        at = self.at
        while len(self.buf) - at < n and self.more():
            pass
        self.at += n
        ok = self.record_follows()
        self.at = at
        return ok

    def skip(self, n: int) -> None:
        if len(self.buf) - self.at >= n:
            self.at += n
        else:
            self.jump(self.place() + n)

    def recover(self) -> bool:
        return False

    def entry(self, start: int, end: int) -> int | None:
        """The first place in a range where a record seems to begin, after a line end."""
        if start == 0:
            return 0
        at, held = start - 1, b""
        self.file.seek(at)
        while at - len(held) < end and (got := self.file.read(CHUNK)):
            window, origin = held + got, at - len(held)
            for m in re.finditer(rb"\n(?=WARC/)", window):
                if RECORD.match(window, m.end()) and start <= origin + m.end() < end:
                    return origin + m.end()
            held, at = window[-200:], at + len(got)
        return None


class Packed(Stream):
    packed = True

    def __init__(self, file, size: int):
        super().__init__(file, size)
        self.jump(0)

    def jump(self, offset: int) -> None:
        self.file.seek(offset)
        self.buf.clear()
        self.at, self.base, self.raw, self.offset, self.unpack, self.broken = 0, 0, b"", offset, None, False
        self.members: list[tuple[int, int]] = []  # position in what was unpacked, offset in the file
        self.member = offset

    def drop(self) -> None:
        self.base += self.at
        super().drop()
        self.members = [m for m in self.members if m[0] >= self.base]

    def place(self) -> int | None:
        if self.at == len(self.buf) and self.unpack is None and not self.broken:
            self.more()
        return next((offset for position, offset in self.members if position == self.base + self.at), None)

    def more(self) -> bool:
        if self.broken:
            return False
        if not self.raw:
            self.raw = self.file.read(CHUNK)
            self.offset += len(self.raw)
            if not self.raw:
                self.broken = self.unpack is not None
                return False
        if self.unpack is None:
            self.member = self.offset - len(self.raw)
            if len(self.raw) < 3:
                self.raw += (extra := self.file.read(CHUNK))
                self.offset += len(extra)
            if not self.raw.strip(b"\0"):
                self.raw = b""
                return self.more()
            if not self.raw.startswith(MAGIC[:2]):
                self.broken = True
                return False
            self.members.append((self.base + len(self.buf), self.member))
            self.unpack = zlib.decompressobj(31)
        before = self.unpack.copy()
        try:
            self.buf += self.unpack.decompress(self.raw)
        except zlib.error:
            self.broken = True
            for at in range(0, len(self.raw), 64):  # what comes before the damage
                try:
                    self.buf += before.decompress(self.raw[at : at + 64])
                except zlib.error:
                    break
            return True
        self.raw = self.unpack.unused_data if self.unpack.eof else b""
        if self.unpack.eof:
            self.unpack = None
        return True

    def fits(self, n: int) -> bool:
        at = self.at
        while len(self.buf) - at < n and self.more():
            pass
        self.at = min(at + n, len(self.buf))
        ok = len(self.buf) - at >= n and self.record_follows()
        self.at = at
        return ok

    def skip(self, n: int) -> None:
        self.at += n

    def recover(self) -> bool:
        """Goes to the next member after the broken one that begins a record."""
        to = self.entry(self.member + 1, self.size)
        if to is None:
            return False
        self.jump(to)
        return True

    def entry(self, start: int, end: int) -> int | None:
        if start == 0:
            return 0
        at, held = start, b""
        while True:
            self.file.seek(at)
            got = self.file.read(CHUNK)
            window, origin = held + got, at - len(held)
            k = window.find(MAGIC)
            while k >= 0 and origin + k < end:
                if self._begins_record(origin + k):
                    return origin + k
                k = window.find(MAGIC, k + 1)
            held, at = window[-2:], at + len(got)
            if not got or origin + len(window) - 2 >= end:
                return None

    def _begins_record(self, offset: int) -> bool:
        self.file.seek(offset)
        try:
            return zlib.decompressobj(31).decompress(self.file.read(2048), 64).lstrip(b"\r\n").startswith(b"WARC/")
        except zlib.error:
            return False


def opened(file, size: int | None = None) -> Plain | Packed:
    """A stream over a seekable file, packed or not by its first bytes, whatever its name says."""
    if size is None:
        size = file.seek(0, 2)
    file.seek(0)
    return (Packed if file.read(2) == MAGIC[:2] else Plain)(file, size)
