"""Writers of old workbooks for tests: a compound file, and a record stream whose string table goes on over record ends."""

from __future__ import annotations

import struct


def record(kind: int, data: bytes) -> bytes:
    return struct.pack("<2H", kind, len(data)) + data


def string_table(strings: list[str], room: int) -> bytes:
    """The table in records of at most `room` bytes: characters go on in the next one after a byte that says how wide they are."""
    parts, now = [], bytearray(struct.pack("<2I", len(strings), len(strings)))

    def end() -> None:
        parts.append(bytes(now))
        now.clear()

    for k, s in enumerate(strings):
        wide = any(ord(c) > 255 for c in s) or k % 3 == 2
        rich, more = k % 4 == 1, b"\1\2\3\4\5" if k % 5 == 3 else b""
        head = struct.pack("<HB", len(s), wide | 8 * rich | 4 * bool(more)) + (struct.pack("<H", 2) if rich else b"") + (struct.pack("<I", len(more)) if more else b"")
        if len(now) + len(head) > room:
            end()
        now += head
        for c in s:
            data = c.encode("utf-16-le") if wide else c.encode("latin-1")
            if len(now) + len(data) > room:
                end()
                now.append(wide)
            now += data
        for b in b"\0" * 8 * rich + more:
            if len(now) >= room:
                end()
            now.append(b)
    end()
    return record(0xFC, parts[0]) + b"".join(record(0x3C, p) for p in parts[1:])


def _rk(v) -> int | None:
    if isinstance(v, int) and abs(v) < 1 << 28:
        return (v << 2 | 2) & 0xFFFFFFFF
    return None


def records(sheets: dict[str, list[list]], room: int = 200, locked: bool = False) -> bytes:
    """Texts shared or in a formula's result, whole numbers short, others as doubles."""
    strings = sorted({v for g in sheets.values() for row in g for v in row if isinstance(v, str)})
    bodies = []
    for g in sheets.values():
        out = record(0x809, struct.pack("<2H", 0x600, 0x10) + b"\0" * 12)
        for r, row in enumerate(g):
            c = 0
            while c < len(row):
                v, numbers = row[c], [_rk(x) for x in row[c:]]
                many = next((i for i, x in enumerate(numbers) if x is None), len(numbers))
                at = struct.pack("<3H", r, c, 0)
                if many > 1:
                    out += record(0xBD, struct.pack("<2H", r, c) + b"".join(struct.pack("<HI", 0, x) for x in numbers[:many]) + struct.pack("<H", c + many - 1))
                    c += many - 1
                elif numbers[0] is not None:
                    out += record(0x27E, at + struct.pack("<I", numbers[0]))
                elif isinstance(v, bool):
                    out += record(0x205, at + bytes([v, 0]))
                elif isinstance(v, float):
                    out += record(0x203, at + struct.pack("<d", v)) if r % 2 else record(0x06, at + struct.pack("<d", v) + b"\0" * 8)
                elif isinstance(v, str) and r % 3 == 2 and v:
                    out += record(0x06, at + b"\0\0\0\0\0\0\xff\xff" + b"\0" * 8) + record(0x207, struct.pack("<HB", len(v), 1) + v.encode("utf-16-le"))
                elif isinstance(v, str):
                    out += record(0xFD, at + struct.pack("<I", strings.index(v)))
                c += 1
        bodies.append(out + record(0x0A, b""))
    names = [n.encode("utf-16-le") for n in sheets]
    table = string_table(strings, room)
    head = record(0x809, struct.pack("<2H", 0x600, 5) + b"\0" * 12) + (record(0x2F, b"\0" * 6) if locked else b"")
    size = len(head) + sum(12 + len(n) for n in names) + len(table) + 4
    bounds = b""
    for name, body in zip(names, bodies, strict=True):
        bounds += record(0x85, struct.pack("<IHBB", size, 0, len(name) // 2, 1) + name)
        size += len(body)
    return head + bounds + table + record(0x0A, b"") + b"".join(bodies)


def compound(streams: dict[str, bytes], scatter: bool = True) -> bytes:
    """A compound file; streams under 4096 bytes lie in small sectors, the others' sectors in turn from the front and the back."""
    free, end = 0xFFFFFFFF, 0xFFFFFFFE
    small_data, small_next, entries, large = b"", [], [], []
    for name, data in streams.items():
        if len(data) < 4096:
            first, n = len(small_next), -(-len(data) // 64)
            small_next += [first + i + 1 for i in range(n - 1)] + ([end] if n else [])
            small_data += data.ljust(64 * n, b"\0")
            entries.append((name, first if n else end, len(data)))
        else:
            large.append((name, data))
    small_next += [free] * (-len(small_next) % 128)
    chains = [("", small_data)] + large if small_data else list(large)
    counts = [-(-len(d) // 512) for _, d in chains]
    n_small, n_dir = len(small_next) // 128, -(-(len(streams) + 1) // 4)
    total = sum(counts) + n_small + n_dir
    n_fat = 1
    while n_fat * 128 < total + n_fat:
        n_fat += 1
    assert n_fat <= 109
    free_at = list(range(n_fat, n_fat + total))
    following, sectors = [0xFFFFFFFD] * n_fat + [free] * total, {}

    def put(data: bytes, count: int) -> int:
        places = [free_at.pop(0 if i % 2 or not scatter else -1) for i in range(count)]
        for i, p in enumerate(places):
            sectors[p] = data[512 * i : 512 * i + 512].ljust(512, b"\0")
            following[p] = places[i + 1] if i + 1 < count else end
        return places[0] if places else end

    root, starts = end, {}
    for (name, data), count in zip(chains, counts, strict=True):
        at = put(data, count)
        root, starts = (at, starts) if not name else (root, starts | {name: at})
    small_at = put(struct.pack(f"<{len(small_next)}I", *small_next), n_small)
    entries += [(name, starts[name], len(data)) for name, data in large]

    def entry(name: str, kind: int, start: int, size: int) -> bytes:
        raw = name.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HB", len(raw), kind) + b"\1" + b"\xff" * 12 + b"\0" * 36 + struct.pack("<IQ", start, size)

    directory = entry("Root Entry", 5, root, len(small_data)) + b"".join(entry(n, 2, s, size) for n, s, size in entries)
    dir_at = put(directory.ljust(512 * n_dir, b"\0"), n_dir)
    fat = struct.pack(f"<{len(following)}I", *following).ljust(512 * n_fat, b"\xff")
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<5H", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 10
    head += struct.pack("<IIIIIIII", n_fat, dir_at, 0, 4096, small_at if n_small else end, n_small, end, 0)
    head = head[:44] + struct.pack("<8I", n_fat, dir_at, 0, 4096, small_at if n_small else end, n_small, end, 0) + struct.pack("<109I", *range(n_fat), *[free] * (109 - n_fat))
    return head.ljust(512, b"\0") + fat + b"".join(sectors.get(p, b"\0" * 512) for p in range(n_fat, n_fat + total))
