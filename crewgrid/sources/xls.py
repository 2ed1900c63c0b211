"""Old binary workbooks: compound files (sector chains, small streams) and their record streams, read by seeking, a record at a time."""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
_END = 0xFFFFFFFE
#: Fixed values of the record format.
BOF, EOF, FILEPASS, CODEPAGE, BOUNDSHEET, SST, CONTINUE = 0x809, 0x0A, 0x2F, 0x42, 0x85, 0xFC, 0x3C
LABELSST, LABEL, RSTRING, NUMBER, RK, MULRK, FORMULA, STRING, BOOLERR = 0xFD, 0x204, 0xD6, 0x203, 0x27E, 0xBD, 0x06, 0x207, 0x205
ERRORS = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A"}


class UnsupportedFormat(Exception):
    pass


class Compound:
    """The streams of a compound file by name."""

    def __init__(self, source):
        self.source = source
        head = self._at(0, 512)
        if head[:8] != MAGIC:
            raise UnsupportedFormat("not a compound file")
        shift, small_shift = struct.unpack_from("<2H", head, 30)
        self.size, self.small = 1 << shift, 1 << small_shift
        directory, self.least, first_small, _, first_more, n_more = (struct.unpack_from("<I", head, at)[0] for at in (48, 56, 60, 64, 68, 72))
        table = [s for s in struct.unpack_from("<109I", head, 76) if s < _END - 1]
        for _ in range(n_more):
            if first_more >= _END - 1:
                break
            *more, first_more = struct.unpack(f"<{self.size // 4}I", self._sector(first_more))
            table += [s for s in more if s < _END - 1]
        self.next = array("I", b"".join(map(self._sector, table)))
        self.small_next = array("I", b"".join(map(self._sector, self._chain(first_small, self.next))))
        self.entries: dict[str, tuple[int, int]] = {}
        raw, self.root = b"".join(map(self._sector, self._chain(directory, self.next))), []
        for at in range(0, len(raw), 128):
            length, kind = struct.unpack_from("<HB", raw, at + 64)
            start, size = struct.unpack_from("<IQ", raw, at + 116)
            if kind == 5:
                self.root = self._chain(start, self.next)
            elif kind == 2:
                self.entries[raw[at : at + max(0, length - 2)].decode("utf-16-le", "replace")] = start, size & 0xFFFFFFFF if self.size == 512 else size

    def _at(self, place: int, n: int) -> bytes:
        self.source.seek(place)
        return self.source.read(n)

    def _sector(self, s: int) -> bytes:
        return self._at((s + 1) * self.size, self.size).ljust(self.size, b"\0")

    @staticmethod
    def _chain(s: int, following: array) -> list[int]:
        out = []
        while s < _END - 1:
            if s >= len(following) or len(out) > len(following):
                raise ValueError("broken sector chain")
            out.append(s)
            s = following[s]
        return out

    def stream(self, *names: str) -> Stream | None:
        """The first of the named streams that is there."""
        name = next((n for n in names if n in self.entries), None)
        if name is None:
            return None
        start, size = self.entries[name]
        if size < self.least:
            places = [(self.root[s * self.small // self.size] + 1) * self.size + s * self.small % self.size for s in self._chain(start, self.small_next)]
            return Stream(self.source, places, self.small, size)
        return Stream(self.source, [(s + 1) * self.size for s in self._chain(start, self.next)], self.size, size)


class Stream:
    """A stream by its sectors' places; neighbouring sectors are read at once."""

    def __init__(self, source, places: list[int], sector: int, size: int):
        self.source, self.places, self.sector, self.size = source, places, sector, min(size, sector * len(places))
        self.begin, self.held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not self.begin <= at or at + n > self.begin + len(self.held):
            first, last = at // self.sector, min(len(self.places), (at + max(n, 1 << 16)) // self.sector + 1)
            out, i = [], first
            while i < last:
                j = i + 1
                while j < last and self.places[j] == self.places[j - 1] + self.sector:
                    j += 1
                self.source.seek(self.places[i])
                out.append(self.source.read((j - i) * self.sector).ljust((j - i) * self.sector, b"\0"))
                i = j
            self.begin, self.held = first * self.sector, b"".join(out)
        return self.held[at - self.begin : min(at + n, self.size) - self.begin]

    def records(self, at: int = 0) -> Iterator[tuple[int, bytes]]:
        while at + 4 <= self.size:
            kind, n = struct.unpack("<2H", self.read(at, 4))
            yield kind, self.read(at + 4, n)
            at += 4 + n


class _Parts:
    """A record's data with that of the records that continue it."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.at = parts, 0

    def bytes(self, n: int) -> bytes:
        out = b""
        while n and self.parts:
            got = self.parts[0][self.at : self.at + n]
            out, n, self.at = out + got, n - len(got), self.at + len(got)
            if n:
                self.parts, self.at = self.parts[1:], 0
        return out

    def text(self, n: int, wide: bool) -> str:
        """Characters; where they go on in the next record, a byte there says anew how wide they are."""
        out = []
        while n:
            if self.at >= len(self.parts[0]):
                self.parts, self.at = self.parts[1:], 1
                wide = bool(self.parts[0][0] & 1)
            take = min(n, (len(self.parts[0]) - self.at) >> wide)
            data = self.parts[0][self.at : self.at + (take << wide)]
            out.append(data.decode("utf-16-le" if wide else "latin-1", "replace"))
            n, self.at = n - take, self.at + len(data) if take else len(self.parts[0])
        return "".join(out)

    def string(self) -> str:
        n, flags = struct.unpack("<HB", self.bytes(3))
        runs = struct.unpack("<H", self.bytes(2))[0] if flags & 8 else 0
        more = struct.unpack("<I", self.bytes(4))[0] if flags & 4 else 0
        text = self.text(n, bool(flags & 1))
        self.bytes(4 * runs + more)
        return text


def _number(x: float) -> str:
    """As new workbooks write it."""
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def _rk(raw: int) -> str:
    x = float(raw - (raw >> 31 << 32) >> 2) if raw & 2 else struct.unpack("<d", struct.pack("<Q", (raw & 0xFFFFFFFC) << 32))[0]
    return _number(x / 100 if raw & 1 else x)


class XlsBook:
    """sheets: their names; cells(i, first, last): row, column and value of a sheet's filled cells."""

    def __init__(self, source):
        files = Compound(source)
        if "EncryptedPackage" in files.entries:
            raise UnsupportedFormat("an encrypted workbook; save it without a password")
        self.stream = files.stream("Workbook", "Book")
        if self.stream is None:
            raise UnsupportedFormat("a compound file without a workbook")
        self.sheets, self.begins, self.wide, self.codepage = [], [], True, "cp1252"
        self.strings: list[str] = []
        table, waiting = [], False
        for kind, data in self.stream.records():
            if kind == CONTINUE and waiting:
                table.append(data)
                continue
            waiting = kind == SST
            if kind == BOF:
                version = struct.unpack_from("<H", data)[0]
                if version not in (0x500, 0x600):
                    raise UnsupportedFormat(f"record version {version:#x}")
                self.wide = version == 0x600
            elif kind == FILEPASS:
                raise UnsupportedFormat("an encrypted workbook; save it without a password")
            elif kind == CODEPAGE:
                page = struct.unpack_from("<H", data)[0]
                self.codepage = {1200: "utf-16-le", 32768: "mac_roman", 32769: "cp1252"}.get(page, f"cp{page}")
            elif kind == SST:
                table = [data]
            elif kind == BOUNDSHEET and data[5] == 0:
                self.begins.append(struct.unpack_from("<I", data)[0])
                self.sheets.append(self._name(data))
            elif kind == EOF:
                break
        if table:
            parts = _Parts(table)
            self.strings = [parts.string() for _ in range(struct.unpack("<2I", parts.bytes(8))[1])]

    def _name(self, data: bytes) -> str:
        return data[8:].decode("utf-16-le" if data[7] & 1 else "latin-1", "replace") if self.wide else data[7:].decode(self.codepage, "replace")

    def _string(self, data: bytes) -> str:
        if self.wide:
            return _Parts([data]).string()
        return data[2 : 2 + struct.unpack_from("<H", data)[0]].decode(self.codepage, "replace")

    def cells(self, i: int, first: int = 0, last: int | None = None) -> Iterator[tuple[int, int, str]]:
        for row, col, value in self._cells(self.begins[i]):
            if row >= first and (last is None or row <= last) and value != "":
                yield row, col, value

    def _cells(self, at: int) -> Iterator[tuple[int, int, str]]:
        depth, awaited = 0, None
        for kind, data in self.stream.records(at):
            if kind == BOF:
                depth += 1
            elif kind == EOF:
                depth -= 1
                if not depth:
                    return
            elif kind == STRING and awaited:
                yield *awaited, self._string(data)
                awaited = None
            elif depth > 1 or kind not in (LABELSST, LABEL, RSTRING, NUMBER, RK, MULRK, FORMULA, BOOLERR):
                continue
            else:
                row, col = struct.unpack_from("<2H", data)
                if kind == LABELSST:
                    yield row, col, self.strings[struct.unpack_from("<I", data, 6)[0]]
                elif kind in (LABEL, RSTRING):
                    yield row, col, self._string(data[6:])
                elif kind == NUMBER:
                    yield row, col, _number(struct.unpack_from("<d", data, 6)[0])
                elif kind == RK:
                    yield row, col, _rk(struct.unpack_from("<I", data, 6)[0])
                elif kind == MULRK:
                    for k, place in enumerate(range(6, len(data) - 4, 6)):
                        yield row, col + k, _rk(struct.unpack_from("<I", data, place)[0])
                elif kind == BOOLERR:
                    yield row, col, ERRORS.get(data[6], "#N/A") if data[7] else str(data[6])
                elif data[12:14] == b"\xff\xff":
                    awaited = (row, col) if data[6] == 0 else None
                    if data[6] in (1, 2):
                        yield row, col, str(data[8]) if data[6] == 1 else ERRORS.get(data[8], "#N/A")
                else:
                    yield row, col, _number(struct.unpack_from("<d", data, 6)[0])
