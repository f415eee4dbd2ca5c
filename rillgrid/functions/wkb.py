"""Well-known binary, and what GeoPackage and shapefiles wrap: small per-row helpers for Arrow batches.

A geometry is a list of parts, a part a list of rings or paths, a ring a list of {x, y}.
"""

from __future__ import annotations

import struct

KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
CODES = {v: k for k, v in KINDS.items()}


def _points(data: bytes, at: int, n: int, order: str, width: int) -> tuple[list, int]:
    values = struct.unpack_from(f"{order}{n * width}d", data, at)
    return [{"x": values[k], "y": values[k + 1]} for k in range(0, len(values), width)], at + 8 * n * width


def _read(data: bytes, at: int) -> tuple[str, list, int]:
    order = "<" if data[at] else ">"
    (code,) = struct.unpack_from(f"{order}I", data, at + 1)
    at += 5
    if code & 0x20000000:  # an id of its system stands before
        at += 4
    high = bool(code & 0x80000000) + bool(code & 0x40000000)
    code &= 0x0FFFFFFF
    width = 2 + (high or {0: 0, 1: 1, 2: 1, 3: 2}[code // 1000])
    kind = KINDS[code % 1000]
    if kind == "Point":
        points, at = _points(data, at, 1, order, width)
        return kind, [] if points[0]["x"] != points[0]["x"] else [[points]], at
    (n,) = struct.unpack_from(f"{order}I", data, at)
    at += 4
    if kind == "LineString":
        points, at = _points(data, at, n, order, width)
        return kind, [[points]] if points else [], at
    if kind == "Polygon":
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(f"{order}I", data, at)
            points, at = _points(data, at + 4, m, order, width)
            rings.append(points)
        return kind, [rings] if rings else [], at
    parts = []
    for _ in range(n):
        _, part, at = _read(data, at)
        parts += part
    return kind, parts, at


def decode(data: bytes | None) -> tuple[str | None, list | None]:
    """Type and geometry; heights and measures are dropped."""
    return (None, None) if data is None else _read(data, 0)[:2]


def encode(kind: str | None, geom: list | None) -> bytes | None:
    if kind is None or geom is None:
        return None
    path = lambda ring: struct.pack("<I", len(ring)) + b"".join(struct.pack("<2d", p["x"], p["y"]) for p in ring)
    head = lambda k: struct.pack("<BI", 1, CODES[k])
    one = {
        "Point": lambda part: head("Point") + struct.pack("<2d", part[0][0]["x"], part[0][0]["y"]),
        "LineString": lambda part: head("LineString") + path(part[0]),
        "Polygon": lambda part: head("Polygon") + struct.pack("<I", len(part)) + b"".join(map(path, part)),
    }
    if kind.startswith("Multi"):
        return head(kind) + struct.pack("<I", len(geom)) + b"".join(one[kind.removeprefix("Multi")](part) for part in geom)
    if not geom:
        return head(kind) + (struct.pack("<2d", float("nan"), float("nan")) if kind == "Point" else struct.pack("<I", 0))
    return one[kind](geom[0])


def from_geopackage(blob: bytes | None) -> tuple[str | None, list | None]:
    """A GeoPackage geometry: WKB after a header whose length its flags tell."""
    if blob is None:
        return None, None
    return decode(blob[8 + (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7] :])


def shapefile(data: bytes) -> list[tuple[int, str | None, list | None]]:
    """(record number, type, geometry) of a .shp file's points, lines and polygons; other shapes have no geometry."""
    out, at = [], 100
    while at + 12 <= len(data):
        number, words = struct.unpack_from(">2i", data, at)
        (shape,) = struct.unpack_from("<i", data, at + 8)
        body = at + 12
        flat = shape % 10
        if flat == 1:
            x, y = struct.unpack_from("<2d", data, body)
            out.append((number, "Point", [[[{"x": x, "y": y}]]]))
        elif flat in (3, 5):
            n_parts, n_points = struct.unpack_from("<2i", data, body + 32)
            starts = [*struct.unpack_from(f"<{n_parts}i", data, body + 40), n_points]
            points, _ = _points(data, body + 40 + 4 * n_parts, n_points, "<", 2)
            paths = [points[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            out.append((number, *(("MultiLineString", [[p] for p in paths]) if flat == 3 else ("MultiPolygon", _with_holes(paths)))))
        else:
            out.append((number, None, None))
        at += 8 + 2 * words
    return out


def _with_holes(rings: list) -> list:
    """Shells go clockwise in this format; a ring that does not is a hole of the shell before."""
    parts: list = []
    for ring in rings:
        turn = sum(p["x"] * q["y"] - q["x"] * p["y"] for p, q in zip(ring, ring[1:], strict=False))
        if turn > 0 and parts:
            parts[-1].append(ring)
        else:
            parts.append([ring])
    return parts
