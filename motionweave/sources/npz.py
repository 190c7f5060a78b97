"""Array archives (.npz) as a Spark data source: frame ranges of files are read in parallel, rows are written back as archives.

``ArchiveSource`` reads and writes the artefact kinds of ``KINDS``. A file is dealt over tasks by its size, each task seeks to
its frames and decodes only the arrays that the asked columns need, straight into Arrow columns. The sink builds one archive
per value of ``path`` in a staging folder of its task and moves the archives of committed tasks into place, so a lost or
repeated task leaves nothing behind. Pickled arrays are refused. NaN becomes NULL when read, NULL becomes NaN when written.

Files are reached through Arrow's file systems (local paths and the URI schemes that Arrow knows); in a store that only Spark
reads, load the bytes with Spark and use ``unpack``.
"""

from __future__ import annotations

import io
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

NAME = "motion_archive"
TASK_BYTES = 64 << 20
OPENING = 1 << 20  # opening a range of an archive takes about as long as reading so much
BATCH_BYTES = 8 << 20
STAGING = "_staging"
CLEARINGS = 10  # times that a stage is cleared while tasks still put files into it
GLOB = "*?["

XYZ = "struct<x:double,y:double,z:double>"
BOX = "struct<x1:double,y1:double,x2:double,y2:double>"
TYPES = {"float": "double", "bool": "boolean", "int": "int", "long": "bigint", "point": XYZ, "points": f"array<{XYZ}>", "numbers": "array<double>",
         "matrices": "array<array<double>>", "box": BOX, "boxes": f"array<{BOX}>", "grid": "array<array<double>>"}
PARTS = {"point": ("x", "y", "z"), "points": ("x", "y", "z"), "box": ("x1", "y1", "x2", "y2"), "boxes": ("x1", "y1", "x2", "y2")}


@dataclass(frozen=True)
class Field:
    """One column of a row and the array that holds it. An open dimension of ``tail`` is taken from the data."""

    column: str
    array: str
    layout: str
    tail: tuple = ()
    required: bool = False
    wide: bool = False  # read only if asked for
    dtype: str = "f8"
    hidden: str = ""  # NULL where this array is false


@dataclass(frozen=True)
class Kind:
    """Rows of an artefact: one per index of its arrays, or two (one per side)."""

    fields: tuple[Field, ...]
    sided: bool = False
    index: str = "frame"
    window: bool = False  # has start and end; frames count from start

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.array for f in self.fields if f.required)

    def columns(self) -> dict[str, str]:
        """All columns with their types, in order."""
        head = {"path": "string"} | ({"start": "int", "end": "int"} if self.window else {}) | {self.index: "int"}
        return head | ({"side": "int"} if self.sided else {}) | {f.column: TYPES[f.layout] for f in self.fields if f.column}

    def default(self) -> list[str]:
        wide = {f.column for f in self.fields if f.wide}
        return [c for c in self.columns() if c not in wide]


MAT = (3, 3)
_POSE = (Field("rot", "rotation_c2w", "numbers", MAT, True), Field("trans", "translation_c2w", "point", (3,), True))
_HAND = (Field("joints", "joints_camera", "points", (21, 3), True, hidden="valid"), Field("valid", "valid", "bool", (), True, dtype="?"),
         Field("root_rot", "root_rot", "numbers", MAT), Field("betas", "betas", "numbers", (10,)),
         Field("vertices", "vertices_camera", "points", (None, 3), wide=True, dtype="f4", hidden="valid"))
KINDS = {
    "camera_window": Kind((*_POSE, Field("k", "intrinsics", "numbers", MAT, True), Field("pose_conf", "pose_confidence", "float"),
                           Field("depth", "depth", "grid", (None, None), True, True),
                           Field("depth_conf", "depth_confidence", "grid", (None, None), False, True)), window=True),
    "depth_samples": Kind((Field("depth", "depth", "float", (None, None), True), Field("depth_conf", "depth_confidence", "float", (None, None)))),
    "hand_window": Kind((*_HAND, Field("conf", "confidence", "float")), True, window=True),
    "hand": Kind((*_HAND, Field("conf", "confidence", "float", (), True)), True, window=True),
    "stitched_camera": Kind((*_POSE, Field("k", "intrinsics", "numbers", MAT), Field("valid", "valid", "bool", (), True, dtype="?"),
                             Field("weight", "weight", "float", (), True))),
    "sim3": Kind((Field("scale", "scales", "float", (), True), Field("rot", "rotations", "numbers", MAT, True),
                  Field("trans", "translations", "point", (3,), True)), index="win"),
    "detection": Kind((Field("box", "boxes", "box", (4,), True), Field("conf", "confidence", "float", (), True),
                       Field("valid", "valid", "bool", (), True, dtype="?"), Field("track_id", "track_id", "long", (), True, dtype="i8"),
                       Field("recovered", "recovered", "bool", (), True, dtype="?")), True),
    "raw_detections": Kind((Field("boxes", "boxes", "boxes", (None, 4), True), Field("confs", "confidence", "numbers", (None,), True),
                            Field("right_scores", "right_score", "numbers", (None,)), Field("left_scores", "left_score", "numbers", (None,)),
                            Field("count", "count", "int", (), dtype="i8"))),
    "trajectory": Kind((
        Field("joints_world", "hand_xyz_world", "points", (21, 3), True, hidden="hand_valid"), Field("valid", "hand_valid", "bool", (), True, dtype="?"),
        Field("rot", "camera_R_c2w", "numbers", MAT, True), Field("trans", "camera_t_c2w", "point", (3,), True), Field("ts", "timestamps", "float"),
        Field("joints_camera", "hand_xyz_camera", "points", (21, 3), hidden="hand_valid"), Field("conf", "hand_confidence", "float"),
        Field("interpolated", "hand_interpolated", "bool", dtype="?"), Field("k", "camera_K", "numbers", MAT), Field("box", "bbox", "box", (4,)),
        Field("track_id", "track_id", "long", dtype="i8"), Field("root_rot", "mano_root_rot", "numbers", MAT),
        Field("hand_pose", "mano_hand_pose", "matrices", (15, *MAT)), Field("betas", "mano_betas", "numbers", (10,)),
        Field("postprocess_valid", "postprocess_valid", "bool", dtype="?"), Field("", "frames", "long", dtype="i8")), True),
}
# Arrays of a sided kind that have one entry per frame all the same.
PER_FRAME = {"timestamps", "frames", "camera_R_c2w", "camera_t_c2w", "camera_K"}


def schema_of(kind: str, columns: list[str] | None = None) -> str:
    known = KINDS[kind].columns()
    if kind == "depth_samples":
        known = {"path": "string", "start": "int", "frame": "int", "row": "int", "col": "int", "depth": "double", "depth_conf": "double"}
    wanted = columns or (list(known) if kind == "depth_samples" else KINDS[kind].default())
    if unknown := sorted(set(wanted) - set(known)):
        raise ValueError(f"{kind} has no columns {unknown}")
    return ", ".join(f"`{c}` {known[c]}" for c in wanted)


# --- arrays to columns -------------------------------------------------------------------------------------------------

def _lists(values: pa.Array, n: int, absent: np.ndarray) -> pa.Array:
    each = len(values) // n if n else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * each), values, mask=pa.array(absent))


def _structs(a: np.ndarray, names: tuple) -> pa.Array:
    flat = np.ascontiguousarray(a.reshape(-1, len(names)), dtype=float)
    return pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(len(names))], names, mask=pa.array(~np.isfinite(flat).all(1)))


def decode(layout: str, a: np.ndarray, absent: np.ndarray) -> pa.Array:
    """Rows of an array as a column; NULL where absent or, by number, matrix, point or box, not finite."""
    n = len(a)
    if layout in ("bool", "int", "long"):
        return pa.array(a.astype({"bool": bool, "int": np.int32, "long": np.int64}[layout]), mask=absent)
    if layout == "float":
        a = a.astype(float)
        return pa.array(a, mask=absent | ~np.isfinite(a))
    if layout in ("point", "box"):
        flat = np.where(absent[:, None], np.nan, a.astype(float))
        return _structs(flat, PARTS[layout])
    if layout in ("points", "boxes"):
        return _lists(_structs(a, PARTS[layout]), n, absent)
    flat = a.astype(float)
    if layout == "numbers":
        flat = flat.reshape(n, -1)
        return _lists(pa.array(flat.ravel()), n, absent | ~np.isfinite(flat).all(1))
    if layout == "matrices":
        flat = flat.reshape(n * a.shape[1], -1) if n else flat.reshape(0, 1)
        return _lists(_lists(pa.array(flat.ravel()), len(flat), ~np.isfinite(flat).all(1)), n, absent)
    flat = flat.reshape(n * a.shape[1], -1) if n else flat.reshape(0, 1)
    return _lists(_lists(pa.array(flat.ravel(), mask=~np.isfinite(flat.ravel())), len(flat), np.zeros(len(flat), bool)), n, absent)


def _doubles(col: pa.Array) -> np.ndarray:
    return col.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _columns_of(col: pa.Array, names: tuple) -> np.ndarray:
    return np.column_stack([_doubles(pc.struct_field(col, i)) for i in range(len(names))]) if len(col) else np.empty((0, len(names)))


def _stack(col: pa.Array, tail: tuple, inner) -> np.ndarray:
    """Lists of one length as an array, NaN where a list is missing."""
    lengths = pc.list_value_length(col)
    each = pc.unique(lengths.drop_null()).to_pylist()
    if len(each) > 1:
        raise ValueError(f"lists of one archive have different lengths: {sorted(each)}")
    values = inner(col.flatten())
    count = each[0] if each else (tail[0] or 0)
    rest = values.shape[1:] if len(values) else tuple(t or 0 for t in tail[1:])
    out = np.full((len(col), count, *rest), np.nan)
    out[lengths.is_valid().to_numpy(zero_copy_only=False)] = values.reshape(-1, count, *rest)
    return out


def encode(field: Field, col: pa.Array) -> np.ndarray:
    """A column as rows of the field's array; NULL becomes NaN, false or -1."""
    layout, tail = field.layout, field.tail
    if layout == "bool":
        return pc.fill_null(col, False).to_numpy(zero_copy_only=False).astype(bool)
    if layout in ("int", "long"):
        return pc.fill_null(col, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    if layout == "float":
        return _doubles(col)
    if layout in ("point", "box"):
        return _columns_of(col, PARTS[layout])
    if layout in ("points", "boxes"):
        return _stack(col, tail, lambda x: _columns_of(x, PARTS[layout]))
    if layout == "numbers":
        flat = _stack(col, (int(np.prod(tail)) if None not in tail else None,), _doubles)
        return flat if None in tail else flat.reshape(len(col), *tail)
    inner = (int(np.prod(tail[1:])) if None not in tail[1:] else None,)
    out = _stack(col, (tail[0], *inner), lambda x: _stack(x, inner, _doubles))
    return out if None in tail else out.reshape(len(col), *tail)


# --- one archive -------------------------------------------------------------------------------------------------------

class Archive:
    """An open archive of which ranges of rows can be read; a stored array is sought, a compressed one read up to the range."""

    def __init__(self, handle, path: str):
        self.path = path
        try:
            self.zip = zipfile.ZipFile(handle)
            self.names = {n.removesuffix(".npy") for n in self.zip.namelist()}
        except (zipfile.BadZipFile, OSError, ValueError) as exc:
            raise ValueError(f"{path} is not a readable array archive: {exc}") from exc

    def _open(self, name: str):
        try:
            f = self.zip.open(f"{name}.npy")
            version = np.lib.format.read_magic(f)
            head = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
            shape, fortran, dtype = head(f)
        except (zipfile.BadZipFile, OSError, ValueError, KeyError) as exc:
            raise ValueError(f"{self.path} is not a readable array archive: {name}: {exc}") from exc
        if dtype.hasobject:
            raise ValueError(f"{self.path} is not a readable array archive: {name} holds pickled objects")
        return f, shape, fortran, dtype

    def shape(self, name: str) -> tuple:
        f, shape, _, _ = self._open(name)
        f.close()
        return shape

    def rows(self, name: str, low: int, high: int) -> np.ndarray:
        f, shape, fortran, dtype = self._open(name)
        with f:
            if fortran and len(shape) > 1:
                return np.frombuffer(f.read(), dtype).reshape(shape, order="F")[low:high]
            each = dtype.itemsize * int(np.prod(shape[1:]))
            f.seek(low * each, io.SEEK_CUR)
            return np.frombuffer(f.read((high - low) * each), dtype).reshape(high - low, *shape[1:])

    def number(self, name: str, default: int) -> int:
        if name not in self.names:
            return default
        f, shape, _, dtype = self._open(name)
        with f:
            return int(np.frombuffer(f.read(), dtype)[0])


def batches_of(archive: Archive, kind: str, columns: list[str], part: int = 0, parts: int = 1, side: int | None = None,
               stride: int = 1, pixels: int = 1) -> Iterator[pa.RecordBatch]:
    """Rows of one part of an archive. ``stride`` takes every so many frames from the archive's first, ``pixels`` every so
    many rows and columns of depth."""
    spec = KINDS[kind]
    if missing := sorted(set(spec.required) - archive.names):
        raise ValueError(f"{archive.path} lacks {missing}")
    first = archive.shape(spec.required[0])
    total = first[0]
    start = archive.number("start", 0)
    end = archive.number("end", start + total)
    schema = pa.schema([(c, _arrow(t)) for c, t in _typed(schema_of(kind, columns))])
    fields = [f for f in spec.fields if f.column in schema.names]
    need = {f.array for f in fields} | {f.hidden for f in fields if f.hidden}
    each = max(1, sum(8 * int(np.prod(archive.shape(n)[1:])) for n in need & archive.names))
    step = max(1, BATCH_BYTES // each)
    low, high = total * part // parts, total * (part + 1) // parts
    for a in range(low, high, step):
        b = min(high, a + step)
        at = np.arange(a, b)
        at = at[at % stride == 0]
        if len(at) == 0:
            continue
        data = {n: archive.rows(n, a, b)[at - a] for n in need & archive.names}
        frames = archive.rows("frames", a, b)[at - a] if kind == "trajectory" and "frames" in archive.names else at + start
        yield (_depth_batch if kind == "depth_samples" else _row_batch)(archive.path, spec, schema, data, frames, start, end, side, pixels)


def _depth_batch(path, spec, schema, data, frames, start, end, side, pixels) -> pa.RecordBatch:
    depth = data.get("depth")
    conf = data.get("depth_confidence")
    depth = depth[:, ::pixels, ::pixels]
    i, r, c = np.nonzero(np.isfinite(depth))
    made = {"path": pa.array([path] * len(i)), "start": pa.array(np.full(len(i), start, np.int32)), "frame": pa.array(frames[i].astype(np.int32)),
            "row": pa.array((r * pixels).astype(np.int32)), "col": pa.array((c * pixels).astype(np.int32)),
            "depth": pa.array(depth[i, r, c].astype(float))}
    if "depth_conf" in schema.names:
        made["depth_conf"] = pa.nulls(len(i), pa.float64()) if conf is None else decode(
            "float", conf[:, ::pixels, ::pixels][i, r, c], np.zeros(len(i), bool))
    return pa.RecordBatch.from_arrays([made[n] for n in schema.names], schema=schema)


def _row_batch(path, spec, schema, data, frames, start, end, side, pixels) -> pa.RecordBatch:
    sides = ([side] if side is not None else [0, 1]) if spec.sided else [None]
    n = len(frames) * len(sides)

    def per_row(name: str) -> np.ndarray:
        a = data[name]
        if not spec.sided:
            return a
        if name in PER_FRAME:
            return np.repeat(a, len(sides), axis=0)
        return a[:, sides].reshape(n, *a.shape[2:])

    made = {"path": pa.array([path] * n), "start": pa.array(np.full(n, start, np.int32)), "end": pa.array(np.full(n, end, np.int32)),
            spec.index: pa.array(np.repeat(frames, len(sides)).astype(np.int32)), "side": pa.array(np.tile(np.array([s or 0 for s in sides], np.int32), len(frames)))}
    for f in spec.fields:
        if f.column not in schema.names:
            continue
        if f.array not in data:
            made[f.column] = pa.array(np.zeros(n, bool)) if f.layout == "bool" else pa.nulls(n, schema.field(f.column).type)
            continue
        absent = ~per_row(f.hidden).astype(bool) if f.hidden else np.zeros(n, bool)
        made[f.column] = decode(f.layout, per_row(f.array), absent)
    return pa.RecordBatch.from_arrays([made[c].cast(schema.field(c).type) for c in schema.names], schema=schema)


def _typed(schema: str) -> list[tuple[str, str]]:
    out, depth, cur = [], 0, ""
    for ch in schema + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = cur.strip().split(" ", 1)
            out.append((name.strip("`"), kind))
            cur = ""
        else:
            cur += ch
    return out


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    if kind.startswith("struct<"):
        return pa.struct([(p.split(":")[0], pa.float64()) for p in kind[7:-1].split(",")])
    return {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind]


# --- the source --------------------------------------------------------------------------------------------------------

def store_of(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """Arrow's file system for a path or URI, and the path in it."""
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)


def listed(path: str, suffix: str = ".npz") -> list[tuple[str, int]]:
    """(path, bytes) of a file, of the files with a suffix below a folder, or of those that match a pattern."""
    store, inside = store_of(path)
    prefix = path[:len(path) - len(inside)] if "://" in path else ""
    fixed = PurePosixPath(*[p for p in _before_glob(PurePosixPath(inside).parts)])
    info = store.get_file_info(str(fixed))
    if info.type == arrow_fs.FileType.File:
        return [(prefix + info.path, info.size)]
    if info.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(f"nothing at {path}")
    match = (lambda p: PurePosixPath(p).full_match(inside)) if str(fixed) != inside.rstrip("/") else (lambda p: p.endswith(suffix))
    found = store.get_file_info(arrow_fs.FileSelector(str(fixed), recursive=True))
    return sorted((prefix + x.path, x.size) for x in found if x.type == arrow_fs.FileType.File and f"/{STAGING}/" not in x.path and match(x.path))


def _before_glob(parts: tuple) -> Iterator[str]:
    for p in parts:
        if any(c in p for c in GLOB):
            return
        yield p


@dataclass
class FileParts(InputPartition):
    """Ranges of archives that one task reads, each (path, part, parts): one of several equal ranges of an archive's rows."""

    ranges: list[tuple[str, int, int]]

    def __post_init__(self):
        super().__init__(tuple(self.ranges))


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.kind, self.path, self.columns = options["kind"], options["path"], columns
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))
        self.stride, self.pixels = int(options.get("stride", 1)), int(options.get("pixels", 1))
        self.side = int(options["side"]) if "side" in options else None

    def partitions(self) -> list[FileParts]:
        """Files are cut into ranges of ``task_bytes``, each of a file in another task; beyond that tasks are as many as their
        bytes and openings ask for, so they do not grow with small files."""
        ranges, most, cost = [], 1, 0
        for path, size in listed(self.path):
            parts = max(1, -(-size // self.task_bytes))
            ranges += [(path, i, parts) for i in range(parts)]
            most, cost = max(most, parts), cost + size + parts * OPENING
        n = min(len(ranges), max(most, -(-cost // TASK_BYTES)))
        return [FileParts(ranges[i::n]) for i in range(n)]

    def read(self, partition: FileParts) -> Iterator[pa.RecordBatch]:
        for path, part, parts in partition.ranges:
            store, inside = store_of(path)
            with store.open_input_file(inside) as handle:
                yield from batches_of(Archive(handle, path), self.kind, self.columns, part, parts, self.side, self.stride, self.pixels)


@dataclass
class Staged(WriterCommitMessage):
    """Archives that a task has finished: (where they are, where they belong)."""

    moves: list[tuple[str, str]]


class _Spool:
    """An array that grows by rows in a nameless scratch file."""

    def __init__(self, field: Field):
        self.field, self.file, self.rows, self.tail = field, tempfile.SpooledTemporaryFile(BATCH_BYTES), 0, None
        self.dtype = np.dtype(field.dtype)

    def add(self, a: np.ndarray) -> None:
        if self.tail is None:
            self.tail = a.shape[1:]
        if a.shape[1:] != self.tail:
            raise ValueError(f"{self.field.array} changes its shape from {self.tail} to {a.shape[1:]}")
        self.file.write(np.ascontiguousarray(a, self.dtype).tobytes())
        self.rows += len(a)

    def store(self, archive: zipfile.ZipFile, name: str, frame_tail: tuple) -> None:
        shape = (self.rows // (frame_tail[0] if frame_tail else 1), *frame_tail, *(self.tail or ()))
        with archive.open(f"{name}.npy", "w", force_zip64=True) as out:
            np.lib.format.write_array_header_1_0(out, {"descr": np.lib.format.dtype_to_descr(self.dtype), "fortran_order": False, "shape": shape})
            self.file.seek(0)
            shutil.copyfileobj(self.file, out)
        self.file.close()


class _Builder:
    """One archive in the making. Rows come by index and side; what is skipped is NaN, false or -1."""

    def __init__(self, kind: str, columns: list[str]):
        self.kind = KINDS[kind]
        self.sides = 2 if self.kind.sided else 1
        self.fields = [f for f in self.kind.fields if f.column in columns]
        self.spools = {f.array: _Spool(f) for f in self.fields}
        self.start: int | None = None
        self.end: int | None = None
        self.next = 0  # the first position (index and side) that is still missing

    def add(self, batch: pa.RecordBatch) -> None:
        index = batch.column(self.kind.index).to_numpy().astype(np.int64)
        if self.start is None:
            keep = self.kind.window or "frames" in {f.array for f in self.kind.fields}
            self.start = int(index[0]) if keep else 0
            if self.kind.window:
                self.start, self.end = int(batch.column("start")[0].as_py()), int(batch.column("end")[0].as_py())
        at = (index - self.start) * self.sides + (batch.column("side").to_numpy() if self.sides == 2 else 0)
        if (np.diff(at) <= 0).any() or at[0] < self.next or (self.end is not None and at[-1] >= (self.end - self.start) * self.sides):
            raise ValueError(f"rows of an archive must be unique by {self.kind.index}" + (" and side" if self.sides == 2 else ""))
        for f in self.fields:
            values = encode(f, batch.column(f.column))
            if f.array in PER_FRAME:
                continue
            self.spools[f.array].add(self._dense(f, values, at - self.next, int(at[-1]) + 1 - self.next))
        self._per_frame(batch, at)
        self.next = int(at[-1]) + 1

    def _dense(self, f: Field, values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        if len(values) == n:
            return values
        out = np.full((n, *values.shape[1:]), {"bool": False, "int": -1, "long": -1}.get(f.layout, np.nan), values.dtype)
        out[at] = values
        return out

    def _per_frame(self, batch: pa.RecordBatch, at: np.ndarray) -> None:
        """Arrays with one entry per frame take it from the frame's first row, which may lie in an earlier batch."""
        done = -(-self.next // self.sides)
        frames, first = np.unique(at // self.sides, return_index=True)
        new = frames >= done
        if not new.any():
            return
        for f in self.fields:
            if f.array in PER_FRAME:
                values = encode(f, batch.column(f.column).take(pa.array(first[new])))
                self.spools[f.array].add(self._dense(f, values, frames[new] - done, int(frames[-1]) + 1 - done))

    def finish(self, path: str, handle) -> None:
        n = -(-self.next // self.sides) if self.end is None else self.end - self.start
        short = n * self.sides - self.next
        for f in self.fields:
            spool = self.spools[f.array]
            missing = n - spool.rows if f.array in PER_FRAME else short
            if missing:
                blank = {"bool": False, "int": -1, "long": -1}.get(f.layout, np.nan)
                spool.add(np.full((missing, *(spool.tail or ())), blank, spool.dtype))
        if lacks := sorted(set(self.kind.required) - set(self.spools)):
            raise ValueError(f"{path} lacks {lacks}")
        with zipfile.ZipFile(handle, "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
            for f in self.fields:
                self.spools[f.array].store(archive, f.array, () if self.sides == 1 or f.array in PER_FRAME else (2,))
            extra = {"start": self.start, "end": self.end} if self.kind.window else {}
            if any(f.array == "frames" for f in self.kind.fields):
                extra["frames"] = np.arange(self.start, self.start + n)
            for name, value in extra.items():
                with archive.open(f"{name}.npy", "w") as out:
                    np.lib.format.write_array(out, np.asarray(value, np.int64).reshape(-1))


class ArchiveWriter(DataSourceArrowWriter):
    """Each task stages its archives; commit moves them into place, abort removes them.

    Tasks that still run when Spark aborts must not stage anything again: the driver makes the stage, and a task only
    makes folders in folders that exist.
    """

    def __init__(self, options: dict, columns: list[str]):
        self.kind, self.root, self.columns = options["kind"], options["path"].rstrip("/"), columns
        self.stage = f"{self.root}/{STAGING}/{uuid.uuid4().hex}"
        store, inside = store_of(self.stage)
        store.create_dir(inside, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        own = f"{self.stage}/{uuid.uuid4().hex}"
        moves: list[tuple[str, str]] = []
        path, builder, seen = None, None, set()
        for batch in iterator:
            names = batch.column("path").to_pylist()
            cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)] if names else [0]
            for a, b in zip(cuts, cuts[1:]):
                if names[a] != path:
                    if builder is not None:
                        moves.append(self._close(own, path, builder))
                    path, builder = names[a], _Builder(self.kind, self.columns)
                    if path in seen:
                        raise ValueError(f"rows of {path} are not next to each other: sort by path and index")
                    seen.add(path)
                builder.add(batch.slice(a, b - a))
        if builder is not None:
            moves.append(self._close(own, path, builder))
        return Staged(moves)

    def _close(self, own: str, path: str, builder: _Builder) -> tuple[str, str]:
        store, inside = store_of(f"{own}/{path}")
        made = len(PurePosixPath(store_of(self.stage)[1]).parts)
        for folder in reversed(PurePosixPath(inside).parents):
            if len(folder.parts) > made:
                store.create_dir(str(folder), recursive=False)
        with store.open_output_stream(inside) as out:
            builder.finish(path, out)
        return f"{own}/{path}", f"{self.root}/{path}"

    def commit(self, messages: list) -> None:
        made = set()
        for message in messages:
            for source, target in message.moves if message else ():
                store, inside = store_of(source)
                place = store_of(target)[1]
                if (folder := str(PurePosixPath(place).parent)) not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                store.move(inside, place)
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        store, inside = store_of(self.stage)
        for left in reversed(range(CLEARINGS)):
            if store.get_file_info(inside).type != arrow_fs.FileType.Directory:
                return
            try:
                store.delete_dir(inside)
            except OSError:  # a task that still runs has put a file into a folder that was just emptied
                if not left:
                    raise


class ArchiveSource(DataSource):
    """``spark.read.format("motion_archive").option("kind", ...)``; options stride, pixels, side and task_bytes when reading."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return schema_of(self.options["kind"])

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options), schema.names)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(dict(self.options), schema.names)


def read(spark: SparkSession, pattern: str, kind: str, columns: list[str] | None = None, **options) -> DataFrame:
    """Rows of all archives of a kind. ``columns`` decides which arrays are read; wide ones (vertices, depth maps) must be named."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format(NAME).schema(schema_of(kind, columns)).option("kind", kind)
    return reader.options(**options).load(pattern)


def write(rows: DataFrame, root: str, kind: str) -> None:
    """Write archives of a kind below ``root``, one per value of ``path`` (relative to it); other columns are left out.

    Rows are dealt by path and sorted, and a task holds a few arrays' worth of one batch; arrays grow in scratch files. A
    second run writes the same bytes again. The partition number is given, as many small archives take longer than their
    bytes tell adaptive execution.
    """
    rows.sparkSession.dataSource.register(ArchiveSource)
    spec = KINDS[kind]
    if kind == "depth_samples":
        raise ValueError("depth is written with its camera_window")
    known = [c for c in spec.columns() if c in rows.columns]
    if lacks := sorted({"path", spec.index, *(["start", "end"] if spec.window else []), *(["side"] if spec.sided else [])} - set(known)):
        raise ValueError(f"rows lack {lacks}")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*known).repartition(n, "path").sortWithinPartitions("path", spec.index, *(["side"] if spec.sided else []))
    dealt.write.format(NAME).mode("append").option("kind", kind).save(root)


def unpack(files: DataFrame, kind: str, columns: list[str] | None = None) -> DataFrame:
    """(path, content) rows -> typed rows of one artefact kind, in bounded batches; for stores that only Spark reads."""
    schema = schema_of(kind, columns)
    names = [c for c, _ in _typed(schema)]

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                yield from batches_of(Archive(io.BytesIO(content.as_py()), path.as_py()), kind, names)

    return files.select("path", "content").mapInArrow(run, schema)


def clip_from_path(path=None):
    """Clip folder of an artefact path <root>/<clip>/<stage>[/windows]/<file>."""
    c = F.col("path") if path is None else path
    return F.regexp_extract(c, r"([^/]+)/[^/]+/(?:windows/)?[^/]+$", 1)


def window_path(stage: str, clip: str = "clip", start: str = "start", end: str = "end") -> Column:
    """Place of a window's archive: clip, stage, first and last frame."""
    return F.format_string(f"%s/{stage}/windows/%06d_%06d.npz", F.col(clip).cast("string"), F.col(start), F.col(end) - 1)
