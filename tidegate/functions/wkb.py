"""Well-known binary: points, lines, areas, their multiple forms and collections, on Arrow buffers.

A geometry is ``kind, srid, parts``: each part is a point (1), a line (2) or an area (3) with its rings, a ring being an
array of ``x, y``. Both byte orders, the flags for a reference system, and heights and measures (which are left out) are
read; what is written has two dimensions.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.geo import finite
from tidegate.functions.projections import by_system
from tidegate.functions.text import as_col

VERTEX = "struct<x:double,y:double>"
GEOMETRY = f"struct<kind:int,srid:int,parts:array<struct<kind:int,rings:array<array<{VERTEX}>>>>>"
POINT, LINE, AREA, POINTS, LINES, AREAS, COLLECTION = range(1, 8)
_PART_OF = {POINTS: POINT, LINES: LINE, AREAS: AREA}
_SRID, _HEIGHT, _MEASURE = 0x20000000, 0x80000000, 0x40000000


class _Flat:
    """Geometries of a batch laid flat: coordinates, and where rings, parts and geometries end."""

    def __init__(self) -> None:
        self.xy: list[np.ndarray] = []
        self.vertices, self.ring_ends, self.part_ends, self.ends = 0, [0], [0], [0]
        self.part_kinds: list[int] = []
        self.kinds: list[int | None] = []
        self.srids: list[int | None] = []

    def coordinates(self) -> np.ndarray:
        return np.concatenate(self.xy) if self.xy else np.zeros((0, 2))


def _read(data: bytes, at: int, flat: _Flat) -> tuple[int, int, int | None]:
    """Read one geometry from ``at`` on into ``flat``: (where it ends, kind, reference system)."""
    order = "<" if data[at] == 1 else ">"
    if data[at] > 1:
        raise ValueError("byte order")
    (head,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    beyond, kind = divmod(head & 0x0FFFFFFF, 1000)
    width = 2 + bool(head & _HEIGHT or beyond in (1, 3)) + bool(head & _MEASURE or beyond in (2, 3))
    srid = None
    if head & _SRID:
        (srid,) = struct.unpack_from(order + "I", data, at)
        at += 4
    if beyond > 3 or not POINT <= kind <= COLLECTION:
        raise ValueError(f"kind {head}")

    def count() -> int:
        nonlocal at
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        return n

    def ring(n: int) -> None:
        nonlocal at
        if at + 8 * n * width > len(data):
            raise ValueError("it ends early")
        xy = np.frombuffer(data, order + "f8", n * width, at).reshape(n, width)[:, :2].astype(float)
        at += 8 * n * width
        if kind == POINT and np.isnan(xy).all():  # an empty point
            return
        flat.xy.append(xy)
        flat.vertices += n
        flat.ring_ends.append(flat.vertices)

    if kind in (POINT, LINE, AREA):
        for n in [1] if kind == POINT else [count()] if kind == LINE else range(count()):
            ring(count() if kind == AREA else n)
        flat.part_kinds.append(kind)
        flat.part_ends.append(len(flat.ring_ends) - 1)
    else:
        for _ in range(count()):
            at, inner, _ = _read(data, at, flat)
            if kind != COLLECTION and inner != _PART_OF[kind]:
                raise ValueError(f"kind {inner} in kind {kind}")
    return at, kind, srid


def _flat_of(cells: pa.Array) -> _Flat:
    flat = _Flat()
    for cell in cells:
        data = cell.as_py()
        kind = srid = None
        if data is not None:
            try:
                end, kind, srid = _read(data, 0, flat)
                if end != len(data):
                    raise ValueError("it goes on after its end")
            except (ValueError, struct.error, IndexError) as problem:
                raise ValueError(f"not well-known binary: {problem}") from None
        flat.kinds.append(kind)
        flat.srids.append(srid)
        flat.ends.append(len(flat.part_kinds))
    return flat


def _nested(flat: _Flat) -> pa.Array:
    xy = flat.coordinates()
    vertex = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1)], ["x", "y"])
    lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    rings = lists(flat.part_ends, lists(flat.ring_ends, vertex))
    part = pa.StructArray.from_arrays([pa.array(flat.part_kinds, pa.int32()), rings], ["kind", "rings"])
    columns = [pa.array(flat.kinds, pa.int32()), pa.array(flat.srids, pa.int32()), lists(flat.ends, part)]
    missing = pa.array([k is None for k in flat.kinds], pa.bool_())
    return pa.StructArray.from_arrays(columns, ["kind", "srid", "parts"], mask=missing)


def _flat_from(cells: pa.StructArray) -> _Flat:
    """The inverse of ``_nested``; slices and nulls are allowed at every level."""
    flat = _Flat()
    for cell in cells.to_pylist():
        flat.kinds.append(None if cell is None or cell["parts"] is None else cell["kind"])
        flat.srids.append(None if cell is None else cell["srid"])
        for part in (cell or {}).get("parts") or []:
            for ring in part["rings"] or []:
                xy = np.array([(v["x"], v["y"]) for v in ring], float).reshape(-1, 2)
                flat.xy.append(xy)
                flat.vertices += len(xy)
                flat.ring_ends.append(flat.vertices)
            flat.part_kinds.append(part["kind"])
            flat.part_ends.append(len(flat.ring_ends) - 1)
        flat.ends.append(len(flat.part_kinds))
    return flat


def _packed(flat: _Flat, little: bool) -> pa.Array:
    order, mark = ("<", b"\1") if little else (">", b"\0")
    xy = flat.coordinates().astype(order + "f8")
    number = struct.Struct(order + "I").pack

    def part(p: int) -> bytes:
        kind, rings = flat.part_kinds[p], range(flat.part_ends[p], flat.part_ends[p + 1])
        body = [xy[flat.ring_ends[r] : flat.ring_ends[r + 1]] for r in rings]
        if kind == POINT:
            return body[0].tobytes() if body else np.full(2, np.nan, order + "f8").tobytes()
        if kind == LINE:
            return number(len(body[0]) if body else 0) + (body[0].tobytes() if body else b"")
        return number(len(body)) + b"".join(number(len(b)) + b.tobytes() for b in body)

    out = []
    for g, (kind, srid) in enumerate(zip(flat.kinds, flat.srids)):
        if kind is None:
            out.append(None)
            continue
        head = mark + (number(kind) if srid is None else number(kind | _SRID) + number(srid))
        own = range(flat.ends[g], flat.ends[g + 1])
        if kind in (POINT, LINE, AREA):
            out.append(head + part(own[0]))
        else:
            out.append(head + number(len(own)) + b"".join(mark + number(flat.part_kinds[p]) + part(p) for p in own))
    return pa.array(out, pa.binary())


def parsed(wkb: str | Column) -> Column:
    """The geometry of a binary column; null stays null, anything else that is no geometry is an error."""
    return F.arrow_udf(lambda cells: _nested(_flat_of(cells)), GEOMETRY)(as_col(wkb))


def packed(geometry: str | Column, little: bool = False) -> Column:
    """A geometry as well-known binary, with the flag for its reference system where it has one."""
    return F.arrow_udf(lambda cells: _packed(_flat_from(cells), little), "binary")(as_col(geometry).cast(GEOMETRY))


def to_lonlat(wkb: str | Column, crs: str | Column) -> Column:
    """A geometry of any kind moved from a coordinate system to degrees; big-endian, without a reference system."""

    def move(cells: pa.Array, names: pa.Array) -> pa.Array:
        flat, systems = _flat_of(cells), names.to_pylist()
        xy = flat.coordinates()
        sizes = np.diff(np.array(flat.ring_ends)[np.array(flat.part_ends)[flat.ends]])
        of = np.repeat(np.arange(len(systems)), sizes)
        moved = [by_system([systems[i] for i in of], xy[:, 0], xy[:, 1])] if len(xy) else []
        flat.xy = [np.stack(m, 1) for m in moved]
        flat.srids = [None] * len(systems)
        return _packed(flat, False)

    return F.arrow_udf(move, "binary")(as_col(wkb), as_col(crs))


def _bits(value: Column) -> Column:
    """The 64 bits of a double as 16 hex digits, without leaving the JVM."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value)
    return F.lpad(F.hex(bits.cast("bigint")), 16, "0")


def point(x: str | Column, y: str | Column) -> Column:
    """A point as big-endian well-known binary, null if a coordinate is missing."""
    x, y = finite(x), finite(y)
    made = F.unhex(F.concat(F.lit("0000000001"), _bits(x), _bits(y)))
    return F.when(x.isNotNull() & y.isNotNull(), made)


def _plain_points(cells: pa.Array) -> np.ndarray | None:
    """Coordinates of points in two dimensions and one byte order, all at once; None if there is anything else."""
    cells = cells.cast(pa.binary())
    ends = np.frombuffer(cells.buffers()[1], np.int32, len(cells) + 1, cells.offset * 4) if len(cells) else np.zeros(1, np.int32)
    if not len(cells) or cells.null_count or (np.diff(ends) != 21).any():
        return None
    rows = np.frombuffer(cells.buffers()[2], np.uint8, 21 * len(cells), ends[0]).reshape(-1, 21)
    for order, head in ((">", b"\0\0\0\0\1"), ("<", b"\1\1\0\0\0")):
        if (rows[:, :5] == np.frombuffer(head, np.uint8)).all():
            return np.ascontiguousarray(rows[:, 5:]).view(order + "f8").astype(float)
    return None


def _point_columns(cells: pa.Array) -> pa.Array:
    given = np.asarray(cells.is_valid())
    plain = _plain_points(cells.drop_null())
    if plain is not None:
        xy, full = np.zeros((len(given), 2)), given.copy()
        full[given] = ~np.isnan(plain).all(axis=1)
        xy[full] = plain[full[given]]
    else:
        flat = _flat_of(cells)
        if any(k not in (None, POINT) for k in flat.kinds):
            raise ValueError("not a point in well-known binary")
        full = np.diff(np.array(flat.ring_ends)[np.array(flat.part_ends)[flat.ends]]) > 0
        xy = np.zeros((len(full), 2))
        xy[full] = flat.coordinates()
    return pa.StructArray.from_arrays([pa.array(xy[:, k], mask=~full) for k in (0, 1)], ["x", "y"])


def point_xy(wkb: str | Column) -> Column:
    """``x, y`` of points, of either byte order; any other form is an error, an empty point has null for both."""

    return F.arrow_udf(lambda cells: _point_columns(cells), VERTEX)(as_col(wkb))


# Functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
