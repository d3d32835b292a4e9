"""Binary point clouds and camera models as Spark sources.

``PlySource`` and ``ColmapSource`` are Python data sources: one partition for
each file, Arrow batches of bounded size. Files are found on the driver and read
where a path is local to all workers; files in another store go through
``ply_rows``, which decodes what Spark's own ``binaryFile`` reader brings.
"""

from __future__ import annotations

import glob
import io
import os
import re
import struct
from collections.abc import Iterator
from functools import partial
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS = 100_000
_KINDS = {
    "char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2",
    "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8",
}
#: The next wider signed type holds each unsigned one.
_SPARK = {"i1": "smallint", "u1": "smallint", "i2": "smallint", "u2": "int", "i4": "int", "u4": "bigint", "f4": "float", "f8": "double"}
_ARROW = {"smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}


def ply_header(raw: bytes) -> tuple[str, int, list[tuple[str, int, list[tuple[str, str]]]]]:
    """Format, size of the header, and (element, rows, [(property, type)])."""
    end = raw.find(b"end_header")
    if not raw.startswith(b"ply") or end < 0:
        raise ValueError("not a PLY file")
    size = raw.index(b"\n", end) + 1
    kind, elements = "", []
    for line in raw[:size].decode("ascii").splitlines():
        words = line.split()
        if words[:1] == ["format"]:
            kind = words[1]
        elif words[:1] == ["element"]:
            elements.append((words[1], int(words[2]), []))
        elif words[:1] == ["property"]:
            if words[1] == "list":
                raise ValueError("list properties are not supported")
            elements[-1][2].append((words[2], _KINDS[words[1]]))
    return kind, size, elements


def ply_decode(raw: bytes, element: str = "vertex") -> np.ndarray:
    """The rows of one element as a structured array."""
    kind, at, elements = ply_header(raw)
    order = ">" if kind == "binary_big_endian" else "<"
    if kind == "ascii":
        words = raw[at:].split()
        k = 0
        for name, rows, props in elements:
            n = rows * len(props)
            if name == element:
                out = np.zeros(rows, [(p, "<" + t) for p, t in props])
                table = np.array(words[k : k + n], dtype=float).reshape(rows, len(props))
                for c, (p, _) in enumerate(props):
                    out[p] = table[:, c]
                return out
            k += n
        raise ValueError(f"no element {element}")
    for name, rows, props in elements:
        dtype = np.dtype([(p, order + t) for p, t in props])
        if name == element:
            return np.frombuffer(raw, dtype, rows, at)
        at += rows * dtype.itemsize
    raise ValueError(f"no element {element}")


def _batches(rows: np.ndarray, file: str, names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), ROWS):
        part = rows[a : a + ROWS]
        columns = [pa.array([file] * len(part)), pa.array(np.arange(a, a + len(part)))]
        columns += [pa.array(part[p].astype(part[p].dtype.newbyteorder("="))).cast(_ARROW[t]) for p, t in names]
        yield pa.record_batch(columns, names=["file", "i", *(p for p, _ in names)])


def ply_bytes(columns: dict[str, np.ndarray], element: str = "vertex") -> bytes:
    """A binary little-endian PLY file with one element."""
    name = {v: k for k, v in _KINDS.items() if k in ("char", "uchar", "short", "ushort", "int", "uint", "float", "double")}
    dtype = np.dtype([(c, v.dtype.newbyteorder("<")) for c, v in columns.items()])
    rows = np.zeros(len(next(iter(columns.values()), [])), dtype)
    for c, v in columns.items():
        rows[c] = v
    head = ["ply", "format binary_little_endian 1.0", f"element {element} {len(rows)}"]
    head += [f"property {name[v.dtype.str.lstrip('<>=|')]} {c}" for c, v in columns.items()]
    return "\n".join([*head, "end_header", ""]).encode() + rows.tobytes()


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _PlyReader(DataSourceReader):
    def __init__(self, paths: list[str], element: str, names: list[tuple[str, str]]):
        self.paths, self.element, self.names = paths, element, names

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as f:
            rows = ply_decode(f.read(), self.element)
        yield from _batches(rows, partition.path, self.names)


class _PlyWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, schema):
        self.folder, self.names = folder, [f.name for f in schema.fields if f.name not in ("file", "i")]

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        table = pa.Table.from_batches(list(batches))
        if table.num_rows:
            part = TaskContext.get().partitionId()
            columns = {c: table.column(c).to_numpy() for c in self.names}
            os.makedirs(self.folder, exist_ok=True)
            with open(f"{self.folder}/part-{part:05d}.ply", "wb") as f:
                f.write(ply_bytes(columns))
        return WriterCommitMessage()


class PlySource(DataSource):
    """``format("ply")``: option ``path`` (a file or glob), ``element`` (vertex). The schema comes from the first file."""

    @classmethod
    def name(cls) -> str:
        return "ply"

    def _paths(self) -> list[str]:
        paths = sorted(glob.glob(self.options["path"].removeprefix("file://")))
        if not paths:
            raise FileNotFoundError(self.options["path"])
        return paths

    def _names(self) -> list[tuple[str, str]]:
        with open(self._paths()[0], "rb") as f:
            _, _, elements = ply_header(f.read(1 << 20))
        element = self.options.get("element", "vertex")
        return [(p, _SPARK[t]) for p, t in next(e[2] for e in elements if e[0] == element)]

    def schema(self) -> str:
        return ", ".join(["file string", "i bigint", *(f"`{p}` {t}" for p, t in self._names())])

    def reader(self, schema) -> DataSourceReader:
        return _PlyReader(self._paths(), self.options.get("element", "vertex"), self._names())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _PlyWriter(self.options["path"].removeprefix("file://"), schema)


def ply_rows(spark: SparkSession, path: str, columns: str, element: str = "vertex") -> DataFrame:
    """Rows of PLY files in any store; ``columns`` is their schema as DDL."""
    names = [(c.split()[0], c.split()[1].lower()) for c in columns.split(",")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield from _batches(ply_decode(raw, element), file, names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(of, f"file string, i bigint, {columns}")


def gaussians(df: DataFrame) -> DataFrame:
    """Plain vertices with families folded into arrays, in order of their numbers."""
    def family(prefix: str):
        names = sorted((c for c in df.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()), key=lambda c: int(c[len(prefix) :]))
        return F.array(*names).cast("array<float>") if names else F.array().cast("array<float>")

    keep = [c for c in ("file", "i", "x", "y", "z", "nx", "ny", "nz", "opacity") if c in df.columns]
    return df.select(*keep, family("f_dc_").alias("f_dc"), family("f_rest_").alias("f_rest"), family("scale_").alias("scale"), family("rot_").alias("rot"))


#: Camera models by number: name and count of parameters; fixed values of the format.
CAMERA_MODELS = {
    0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5), 4: ("OPENCV", 8), 5: ("OPENCV_FISHEYE", 8),
    6: ("FULL_OPENCV", 12), 7: ("FOV", 5), 8: ("SIMPLE_RADIAL_FISHEYE", 4), 9: ("RADIAL_FISHEYE", 5), 10: ("THIN_PRISM_FISHEYE", 12),
}
SCHEMAS = {
    "cameras": "camera_id bigint, model string, width bigint, height bigint, params array<double>",
    "images": "image_id bigint, qvec array<double>, tvec array<double>, camera_id bigint, name string, xys array<struct<x:double,y:double>>, point3d_ids array<bigint>",
    "points3D": "point3d_id bigint, xyz array<double>, rgb array<int>, error double, image_ids array<bigint>, point2d_idxs array<bigint>",
}


#: Bytes of a camera model that are decoded at a time, or one record if that is longer.
SLICE = 2 << 20
_SEEN = np.dtype([("x", "<f8"), ("y", "<f8"), ("p", "<i8")])


def _camera_starts(f: BinaryIO) -> Iterator[int]:
    """Where each binary record starts, and the end of the last; so below. Only the heads of records are read."""
    (n,), at = struct.unpack("<Q", f.read(8)), 8
    for _ in range(n):
        yield at
        f.seek(at)
        _, model = struct.unpack("<ii", f.read(8))
        at += 24 + 8 * CAMERA_MODELS[model][1]
    yield at


def _image_starts(f: BinaryIO) -> Iterator[int]:
    (n,), at = struct.unpack("<Q", f.read(8)), 8
    for _ in range(n):
        yield at
        at += 64
        f.seek(at)
        while (end := (part := f.read(256)).find(b"\0")) < 0:
            if not part:
                raise ValueError("the file ends within a name")
            at += len(part)
        at += end + 1
        f.seek(at)
        (m,) = struct.unpack("<Q", f.read(8))
        at += 8 + _SEEN.itemsize * m
    yield at


def _point_starts(f: BinaryIO) -> Iterator[int]:
    (n,), at = struct.unpack("<Q", f.read(8)), 8
    for _ in range(n):
        yield at
        f.seek(at + 43)
        (m,) = struct.unpack("<Q", f.read(8))
        at += 51 + 8 * m
    yield at


def _line_starts(f: BinaryIO, lines: int) -> Iterator[int]:
    """The same of text with ``lines`` lines to a record; comments do not count."""
    at = k = 0
    for line in f:
        if not line.startswith(b"#"):
            if k % lines == 0:
                yield at
            k += 1
        at += len(line)
    yield at


def _slices(starts: Iterator[int]) -> Iterator[tuple[int, int]]:
    """(start, end) of whole records, ``SLICE`` bytes or just over."""
    a = z = next(starts)
    for z in starts:
        if z - a >= SLICE:
            yield a, z
            a = z
    if z > a:
        yield a, z


def _cameras(raw: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(raw):
        i, model, w, h = struct.unpack_from("<iiQQ", raw, at)
        name, count = CAMERA_MODELS[model]
        yield i, name, w, h, list(struct.unpack_from(f"<{count}d", raw, at + 24))
        at += 24 + 8 * count


def _images(raw: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(raw):
        v = struct.unpack_from("<i7di", raw, at)
        at += struct.calcsize("<i7di")
        end = raw.index(b"\0", at)
        name = raw[at:end].decode()
        (m,) = struct.unpack_from("<Q", raw, end + 1)
        seen = np.frombuffer(raw, _SEEN, m, end + 9)
        at = end + 9 + _SEEN.itemsize * m
        yield v[0], v[1:5], v[5:8], v[8], name, seen["x"], seen["y"], seen["p"]


def _points(raw: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(raw):
        v = struct.unpack_from("<Q3d3BdQ", raw, at)
        at += struct.calcsize("<Q3d3BdQ")
        track = np.frombuffer(raw, "<i4", 2 * v[8], at).reshape(-1, 2)
        at += 8 * v[8]
        yield v[0], list(v[1:4]), list(v[4:7]), v[7], track[:, 0].tolist(), track[:, 1].tolist()


def _lines(raw: bytes) -> list[str]:
    return [x for x in raw.decode().split("\n") if not x.startswith("#")]


def _cameras_text(raw: bytes) -> Iterator[tuple]:
    for w in (x.split() for x in _lines(raw) if x.strip()):
        yield int(w[0]), w[1], int(w[2]), int(w[3]), [float(p) for p in w[4:]]


def _images_text(raw: bytes) -> Iterator[tuple]:
    lines = _lines(raw)
    for head, seen in zip(lines[::2], [*lines[1::2], ""]):
        w, s = head.split(), seen.split()
        if len(w) >= 10:
            both = len(s[1::3])  # a last point without y is none
            yield int(w[0]), [float(q) for q in w[1:5]], [float(t) for t in w[5:8]], int(w[8]), " ".join(w[9:]), list(map(float, s[0::3][:both])), list(map(float, s[1::3])), list(map(int, s[2::3]))


def _points_text(raw: bytes) -> Iterator[tuple]:
    for w in (x.split() for x in _lines(raw) if x.strip()):
        yield int(w[0]), [float(v) for v in w[1:4]], [int(v) for v in w[4:7]], float(w[7]), [int(v) for v in w[8::2]], [int(v) for v in w[9::2]]


#: By table: what finds records and what decodes them, in binary and in text.
_DECODERS = {
    "cameras": ((_camera_starts, _cameras), (partial(_line_starts, lines=1), _cameras_text)),
    "images": ((_image_starts, _images), (partial(_line_starts, lines=2), _images_text)),
    "points3D": ((_point_starts, _points), (partial(_line_starts, lines=1), _points_text)),
}


def _listed(parts: list, kind: str) -> tuple[pa.Array, pa.Array]:
    """Offsets and values of a list array."""
    return pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32()), pa.array(np.concatenate([np.asarray(p, kind) for p in parts]))


def _model_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(map(list, zip(*rows)))
    if "xys" in schema.names:  # points of images are many and stay out of Python's objects
        *columns, x, y, p = columns
        (at, x), (_, y) = _listed(x, "f8"), _listed(y, "f8")
        columns += [pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([x, y], ["x", "y"])), pa.ListArray.from_arrays(*_listed(p, "i8"))]
    return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def colmap(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """``cameras``, ``images`` or ``points3D`` of the models in ``folder`` (a glob); ``.bin`` is preferred to ``.txt``.

    Records have lengths of their own, so one task for each file looks up where
    they start; slices of whole records are then read by all tasks. A file in a
    store that is not mounted comes in one piece from ``binaryFile`` (2 GB at
    most) and is decoded a slice at a time.
    """
    files = spark.read.format("binaryFile").load(f"{folder}/{table}.*").where(F.col("path").rlike(r"\.(bin|txt)$"))
    best = files.groupBy(F.regexp_extract("path", "^(.*)/", 1).alias("d")).agg(F.min("path").alias("path")).select("path")
    binary, text = _DECODERS[table]
    schema = StructType.fromDDL(SCHEMAS[table])

    def ways(path: str) -> tuple:
        return binary if path.endswith(".bin") else text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                with open(re.sub("^file:/*", "/", path), "rb", buffering=8192) as f:
                    found = list(_slices(ways(path)[0](f)))
                yield pa.record_batch([pa.array([path] * len(found), pa.string()), *(pa.array([s[k] for s in found], pa.int64()) for k in (0, 1))], names=["path", "a", "z"])

    def decode(f: BinaryIO, path: str, a: int, z: int) -> Iterator[pa.RecordBatch]:
        f.seek(a)
        if rows := list(ways(path)[1](f.read(z - a))):
            yield _model_batch(rows, to_arrow_schema(schema))

    def of_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, a, z in zip(*(c.to_pylist() for c in b.columns)):
                with open(re.sub("^file:/*", "/", path), "rb", buffering=0) as f:
                    yield from decode(f, path, a, z)

    def of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = io.BytesIO(raw)
                for a, z in list(_slices(ways(path)[0](f))):
                    yield from decode(f, path, a, z)

    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return files.join(best, "path").select("path", "content").mapInArrow(of_files, schema)
    # Few rows, dealt in turn: a hash of them would leave some tasks with several and others with none.
    slices = files.join(best, "path").select("path").mapInArrow(cut, "path string, a long, z long")
    return slices.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(of_slices, schema)


def dense_array(raw: bytes) -> np.ndarray:
    """A dense map: ``width&height&channels&`` and 32-bit floats in Fortran order."""
    fields, at = [], 0
    for _ in range(3):
        end = raw.index(b"&", at)
        fields.append(int(raw[at:end]))
        at = end + 1
    w, h, c = fields
    cells = np.frombuffer(raw, "<f4", w * h * c, at).reshape((w, h, c), order="F").transpose(1, 0, 2)
    return cells[:, :, 0] if c == 1 else cells


def dense_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, y, x, c, value): the cells of dense maps."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cells = dense_array(raw)
                cells = cells.reshape(cells.shape[0], -1, 1) if cells.ndim < 3 else cells
                y, x, c = (v.ravel() for v in np.indices(cells.shape))
                for a in range(0, cells.size, ROWS):
                    part = slice(a, a + ROWS)
                    yield pa.record_batch([pa.array([file] * len(y[part])), pa.array(y[part]), pa.array(x[part]), pa.array(c[part]), pa.array(cells.ravel()[part].astype("f4"))], names=["file", "y", "x", "c", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(of, "file string, y bigint, x bigint, c bigint, value float")


def poses(spark: SparkSession, path: str) -> DataFrame:
    """(file, i, pose): 3 x 4 poses of ``.npy`` buffers, those of zeros left out; pickled arrays are refused."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = np.load(io.BytesIO(raw), allow_pickle=False)
                for a in range(0, len(data), ROWS):
                    part = data[a : a + ROWS].astype(float)
                    set_ = np.flatnonzero(part.reshape(len(part), -1).any(axis=1))
                    yield pa.record_batch(
                        [pa.array([file] * len(set_)), pa.array(set_ + a), pa.array(part[set_].tolist(), pa.list_(pa.list_(pa.float64())))], names=["file", "i", "pose"]
                    )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(of, "file string, i bigint, pose array<array<double>>")
