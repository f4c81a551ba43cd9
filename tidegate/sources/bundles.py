"""Deliveries: ZIP files (or plain CSV files) decoded in Spark tasks.

A ZIP cannot be split, so one task inflates a file, looks for what is wrong with it and cuts its text into runs of
whole lines; other tasks parse the runs with Arrow. The decoder is the only Python that touches records.

Files are rows of ``(path, content)``, or, of any size, of ``(path, place, piece)``: a file is its pieces by place.
"""

from __future__ import annotations

import struct
import tempfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.text import NULL_TOKENS, bundle_from_path
from tidegate.operators.publish import EXPORT_COLUMNS

# Columns of a delivery besides the published ones, and the approval marker.
EXTRA_COLUMNS = ("namespace", "resultaatdatum", "analysecompartiment.code", "bemonsteringsapparaat.code")
DERIVED = ("geom",)
APPROVAL_FILE = "akkoord.txt"
BUNDLE_COLUMNS = tuple(
    c.replace(".", "_") for c in (*EXPORT_COLUMNS, *EXTRA_COLUMNS) if c not in DERIVED
)

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# What is known of a file as a whole stands in one row of its own, with this for its place.
FILE_ROW = -1
# Bytes of text in a run of lines, and of the longest line that a run may hold; bytes of text in a piece that is packed, and held by a task.
RUN, RUN_MOST = 4 << 20, 64 << 20
PACKED, PACKED_HELD = 1 << 20, 32 << 20
BATCH_BYTES, _BATCH = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def bundle_files(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """The files of a folder with their content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def _make_reader(encoding: str) -> Callable:
    """A function that looks through one file: (approved, header, number of records, error, what gives its records in batches).

    A file is inflated, decoded and parsed a piece at a time, so that a task never holds its text: once to count the
    records and find what is wrong with it, and again for the records. Built as a closure so that it travels to the
    executors by value.
    """
    tokens = list(NULL_TOKENS)
    marker, piece_size, rows_a_batch = APPROVAL_FILE, 1 << 20, 10000

    def read(path: str, content, only_header: bool = False):
        import codecs
        import csv
        import io
        import zipfile

        csv.field_size_limit(2**31 - 1)  # a cell may be as long as a file
        approved = False

        def packed():
            """The file from its beginning; ``content`` is a buffer, or a file of its own."""
            if isinstance(content, pa.Buffer):
                return pa.BufferReader(content)
            content.seek(0)
            return content

        class Decoded(io.RawIOBase):
            """The text of the file as UTF-8, and whether what has been read of it is blank."""

            def __init__(self, raw) -> None:
                self.raw, self.decoder = raw, codecs.getincrementaldecoder(encoding)()
                self.at, self.left, self.blank = 0, memoryview(b""), True
                plain = bytes(range(128))
                self.plain = plain.decode(encoding, "replace") == plain.decode("ascii")

            def readable(self) -> bool:
                return True

            def readinto(self, into) -> int:
                while not self.left:
                    piece = self.raw.read(piece_size)
                    if piece and not self.blank and self.plain and piece.isascii() and not self.decoder.getstate()[0]:
                        self.at += len(piece)
                        self.left = memoryview(piece)  # is the same in UTF-8
                        break
                    try:
                        text = self.decoder.decode(piece, not piece)
                    except UnicodeDecodeError as e:  # places are told from the beginning of the file
                        before = self.at + len(piece) - len(e.object)
                        what, place = f"bytes in position {before + e.start}-{before + e.end - 1}", e.start
                        if e.end - e.start == 1:
                            what = f"byte 0x{e.object[place]:02x} in position {before + place}"
                        raise ValueError(f"'{e.encoding}' codec can't decode {what}: {e.reason}") from None
                    self.at += len(piece)
                    self.blank = self.blank and not text.strip()
                    self.left = memoryview(text.encode("utf-8"))
                    if not piece and not self.left:
                        return 0
                n = min(len(into), len(self.left))
                into[:n] = self.left[:n]
                self.left = self.left[n:]
                return n

        def stream() -> Decoded:
            nonlocal approved
            if not path.lower().endswith(".zip"):
                return Decoded(packed())
            archive = zipfile.ZipFile(packed())
            names = archive.namelist()
            approved = marker in names
            member = next((n for n in names if n.endswith(".csv")), None)
            return Decoded(archive.open(member) if member else io.BytesIO())

        def lines() -> Iterator[list[str]]:
            return csv.reader(io.TextIOWrapper(io.BufferedReader(stream()), "utf-8", newline=""), delimiter=";")

        def parsed(names: list[str]) -> Iterator[pa.RecordBatch]:
            reader = arrow_csv.open_csv(
                stream(),
                read_options=arrow_csv.ReadOptions(column_names=names, skip_rows=0, use_threads=False),
                parse_options=arrow_csv.ParseOptions(delimiter=";", newlines_in_values=True),
                convert_options=arrow_csv.ConvertOptions(
                    column_types={n: pa.string() for n in names},
                    null_values=tokens,
                    strings_can_be_null=True,
                    quoted_strings_can_be_null=True,
                ),
            )
            header = 1
            for batch in reader:
                rest = batch.slice(header)
                header -= batch.num_rows - rest.num_rows
                for start in range(0, rest.num_rows, rows_a_batch):
                    yield rest.slice(start, rows_a_batch)

        def ragged(names: list[str]) -> Iterator[pa.RecordBatch]:
            # Short lines are filled up; a line with too many cells is an error.
            empty = set(tokens)
            found = lines()
            next(found)
            long, n = None, 0

            def batch(rows: list[list[str]]) -> pa.RecordBatch:
                cells = lambda i: [r[i] if i < len(r) and r[i] not in empty else None for r in rows]
                return pa.RecordBatch.from_arrays([pa.array(cells(i), pa.string()) for i in range(len(names))], names=names)

            rows: list[list[str]] = []
            for row in found:
                if not row:
                    continue
                if long is None and len(row) > len(names):
                    long = n
                n += 1
                rows.append(row)
                if len(rows) == rows_a_batch:
                    yield batch(rows)
                    rows = []
            if long is not None:
                raise ValueError(f"line {long + 2} has more cells than the header")
            if rows:
                yield batch(rows)

        try:
            named, n, wrong, parse = [], 0, None, parsed
            try:
                # Dots give way to underscores; a header spelled both ways keeps the second spelling.
                lowered = [c.strip().lower() for c in next(lines())]
                for position, name in enumerate(lowered):
                    inner = name.replace(".", "_")
                    clash = inner in named or (inner != name and inner in lowered)
                    named.append(f"{inner}#{position}" if clash else inner)
                if only_header:
                    return approved, named, stream()
                try:
                    n = sum(batch.num_rows for batch in parse(named))
                except pa.ArrowInvalid:
                    parse = ragged
                    n = sum(batch.num_rows for batch in parse(named))
            except Exception as problem:
                wrong, n = problem, 0
            if not n:  # what can't be decoded, and a blank file, come before all else
                whole = stream()
                while whole.read(piece_size):
                    pass
                if whole.blank:
                    named, wrong = [], None
                if wrong is not None:
                    raise wrong
                return approved, named, 0, "No CSV content found in ZIP file", None
            return approved, named, n, None, lambda: parse(named)
        except Exception as problem:  # whatever is wrong with one file, the others go on
            return approved, [], 0, str(problem) or type(problem).__name__, None

    return read


def _make_cutter(encoding: str) -> Callable:
    """A function that cuts the text of a file into runs of whole lines: (approved, header, runs, number of records in each).

    It gives up (None) on a file whose lines are not told apart by looking for quotes, one without records, and one that
    Arrow does not parse as it stands: these are left to the reader. ``keep`` takes each run.
    """
    read = _make_reader(encoding)
    options, size, longest = _parsing(), RUN, RUN_MOST

    def line_end(text: bytes) -> int:
        """Where the last whole line ends; -1 if quotes don't tell what is a cell and what is not."""
        import numpy as np

        a = np.frombuffer(text, np.uint8)
        ends = np.flatnonzero((a == 10) | (a == 13))
        quotes = np.flatnonzero(a == 34)
        if len(quotes):
            # Counted from the beginning of a line, every other quote opens a cell if each of these stands
            # at the beginning of one, or makes a doubled quote with the one before.
            opening = quotes[::2]
            before = a[opening[opening > 0] - 1]
            if not np.isin(before, np.frombuffer(b';\r\n"', np.uint8)).all():
                return -1
            ends = ends[np.searchsorted(quotes, ends) % 2 == 0]
        return int(ends[-1]) + 1 if len(ends) else 0

    def cut(path: str, content, keep: Callable | None = None):
        names, counts = [], []
        try:
            approved, names, stream = read(path, content, True)
            if not names:
                return None
            held, looked = b"", 0

            def take(run: bytes) -> None:
                n = options(run, names, names[:1]).num_rows - (not counts) if run.strip(b"\r\n") else 0
                counts.append(n)
                if keep is not None:
                    keep(run)

            while piece := stream.read(size):
                held += piece
                if len(held) < max(size, 2 * looked):
                    continue
                end = line_end(held)
                looked = 0 if end else len(held)
                if end < 0 or looked > longest:
                    return None
                if end:
                    take(held[:end])
                    held = held[end:]
            if held:
                if line_end(held) < 0 or held.count(b'"') % 2:
                    return None
                take(held)
        except Exception:  # whatever it is, the reader tells
            return None
        return (approved, names, counts) if sum(counts) else None

    return cut


def _parsing() -> Callable:
    """A function that parses a run of whole lines, some columns of it or all."""
    tokens = list(NULL_TOKENS)

    def parse(run, names: list[str], some: list[str] | None = None) -> pa.Table:
        return arrow_csv.read_csv(
            pa.BufferReader(run),
            read_options=arrow_csv.ReadOptions(column_names=names, skip_rows=0, use_threads=False, block_size=len(run) + 1),
            parse_options=arrow_csv.ParseOptions(delimiter=";", newlines_in_values=True),
            convert_options=arrow_csv.ConvertOptions(
                column_types={n: pa.string() for n in names},
                null_values=tokens,
                strings_can_be_null=True,
                quoted_strings_can_be_null=True,
                include_columns=some or [],
            ),
        )

    return parse


def _files(files: DataFrame) -> DataFrame:
    """The files, with the pieces of each one after the other in one partition, and handed to tasks some at a time."""
    spark = files.sparkSession
    size = spark.conf.get(_BATCH).rstrip("bB")
    if not size.isdigit() or not 0 < int(size) <= BATCH_BYTES:  # unless the session asks for less
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    if "piece" not in files.columns:
        return files.select("path", "content")
    return files.select("path", "place", "piece").repartition("path").sortWithinPartitions("path", "place")


def _make_opener() -> Callable:
    """A function that gives the path and content of each file in turn; pieces are put together on the task's own disk."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        path, whole = None, None
        for batch in batches:
            if "content" in batch.schema.names:
                for path, content in zip(batch.column("path"), batch.column("content")):
                    yield path.as_py(), content.as_buffer() or pa.py_buffer(b"")
                continue
            for name, piece in zip(batch.column("path"), batch.column("piece")):
                if whole is None or name.as_py() != path:
                    if whole is not None:
                        yield path, whole
                        whole.close()
                    path, whole = name.as_py(), tempfile.TemporaryFile()
                whole.write(piece.as_buffer() or b"")
        if whole is not None:
            yield path, whole
            whole.close()

    return opened


# What is known of a file, and a run of its records: as text with the names of its columns, or as an Arrow stream.
ABOUT = "path string, approved boolean, header array<string>, n_rows bigint, error string"
RUNS = f"{ABOUT}, place bigint, first bigint, names array<string>, size bigint, packed binary"


def _look(encoding: str, runs: bool) -> Callable:
    """The task that looks through files: a row about each, and one for each run of its records if these are wanted."""
    read, cut, opened = _make_reader(encoding), _make_cutter(encoding), _make_opener()
    file_row = FILE_ROW

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about = [("path", pa.string()), ("approved", pa.bool_()), ("header", pa.list_(pa.string())), ("n_rows", pa.int64()), ("error", pa.string())]
        run = [("place", pa.int64()), ("first", pa.int64()), ("names", pa.list_(pa.string())), ("size", pa.int64()), ("packed", pa.binary())]
        schema = pa.schema(about + (run if runs else []))
        codec = pa.Codec("zstd", 1)

        def row(*values):
            arrays = [pa.array([v], f.type) for v, f in zip(values, schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for path, content in opened(batches):
            # runs are kept aside until it is known that the whole file can be read
            with tempfile.TemporaryFile() as aside:
                kept = []

                def keep(text: bytes) -> None:
                    packed = codec.compress(text, asbytes=True)
                    kept.append((len(text), len(packed)))
                    aside.write(packed)

                found = cut(path, content, keep if runs else None)
                if found is not None:
                    approved, names, counts = found
                    yield row(path, approved, names, sum(counts), None, *([file_row, None, None, None, None] if runs else []))
                    aside.seek(0)
                    first = 0
                    for place, (n, (size, length)) in enumerate(zip(counts, kept)):
                        packed = aside.read(length)
                        if n:
                            yield row(path, None, None, n, None, place, first, names, size, packed)
                        first += n
                    continue
            approved, header, n, error, parts = read(path, content)
            yield row(path, approved, header, n, error, *([file_row, None, None, None, None] if runs else []))
            first = 0
            for place, part in enumerate(parts() if runs and parts is not None else ()):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, part.schema) as stream:
                    stream.write_batch(part)
                text = out.getvalue()
                yield row(path, None, None, part.num_rows, None, place, first, None, text.size, codec.compress(text, asbytes=True))
                first += part.num_rows

    return look


def bundle_contents(files: DataFrame, encoding: str = "cp1252") -> DataFrame:
    """Files decoded once: a row about each file (``row_ord`` = FILE_ROW) and a row for each record.

    Known columns are columns; all others that a file has are in the map ``extras``. The rows of a file that are in
    one partition follow each other.
    """
    columns, file_row, parse, rows_a_batch = list(BUNDLE_COLUMNS), FILE_ROW, _parsing(), 10000

    def decode(batches: Iterator) -> Iterator:
        texts = pa.map_(pa.string(), pa.string())
        about = [("approved", pa.bool_()), ("header", pa.list_(pa.string())), ("n_rows", pa.int64()), ("error", pa.string())]
        schema = pa.schema([("path", pa.string()), ("row_ord", pa.int64()), *about, ("extras", texts), *[(c, pa.string()) for c in columns]])
        codec = pa.Codec("zstd")

        def rest(part, names):
            n = part.num_rows
            keys = pa.array(names * n, pa.string())
            cells = [part.column(c).to_pylist() for c in names]
            items = pa.array([cell for row in zip(*cells) for cell in row], pa.string())
            return pa.MapArray.from_arrays(pa.array(range(0, n * len(names) + 1, len(names)), pa.int32()), keys, items)

        def parts(run: dict) -> Iterator[pa.RecordBatch]:
            text = codec.decompress(run["packed"], run["size"])
            if run["names"] is None:
                yield from pa.ipc.open_stream(text)
                return
            table = parse(text, run["names"])
            table = table.slice(table.num_rows - run["n_rows"])  # without the header
            for batch in table.to_batches(max_chunksize=rows_a_batch):
                yield batch

        for batch in batches:
            for number in range(batch.num_rows):
                run = batch.slice(number, 1).to_pylist()[0]
                path, start = run["path"], run["first"]
                if run["place"] == file_row:
                    first = [path, file_row, *[run[name] for name, _ in about], None, *[None] * len(columns)]
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(first, schema)], schema=schema)
                    continue
                for part in parts(run):
                    n = part.num_rows
                    have = set(part.schema.names)
                    others = [c for c in part.schema.names if c not in set(columns)]
                    arrays = [pa.array([path] * n, pa.string()), pa.array(range(start, start + n), pa.int64())]
                    arrays += [pa.nulls(n, kind) for _, kind in about]
                    arrays.append(rest(part, others) if others else pa.nulls(n, texts))
                    arrays += [part.column(c) if c in have else pa.nulls(n, pa.string()) for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                    start += n

    schema = (
        "path string, row_ord bigint, approved boolean, header array<string>, n_rows bigint, error string, "
        "extras map<string,string>, " + ", ".join(f"`{c}` string" for c in columns)
    )
    runs = _files(files).mapInArrow(_look(encoding, True), RUNS).repartition("path", "place").sortWithinPartitions("path", "place")
    return runs.mapInArrow(decode, schema).withColumn("bundle", bundle_from_path("path"))


def info_of(contents: DataFrame) -> DataFrame:
    """One row per file: bundle, approval marker, header, number of rows, and why it cannot be read."""
    return contents.where(F.col("row_ord") == FILE_ROW).select("path", "approved", "header", "n_rows", "error", "bundle")


def records_of(contents: DataFrame) -> DataFrame:
    """All records of all readable files: ``bundle``, ``row_ord``, the known columns as text, and ``extras``."""
    rows = contents.where(F.col("row_ord") != FILE_ROW)
    return with_coordinates(rows.drop("path", "approved", "header", "n_rows", "error"))


def bundle_info(files: DataFrame, encoding: str = "cp1252") -> DataFrame:
    return _files(files).mapInArrow(_look(encoding, False), ABOUT).withColumn("bundle", bundle_from_path("path"))


def bundle_records(files: DataFrame, encoding: str = "cp1252") -> DataFrame:
    return records_of(bundle_contents(files, encoding))


def with_coordinates(records: DataFrame) -> DataFrame:
    """Longitude and latitude as numbers; a decimal comma is read as a point."""
    number = lambda c: F.translate(c, ",", ".").try_cast("double")
    return records.withColumns({"lon": number(F.col("geometriepunt_x")), "lat": number(F.col("geometriepunt_y"))})


def pack_pieces(records: DataFrame, columns: list[str], approved: bool = False, encoding: str = "cp1252") -> DataFrame:
    """A ZIP file for each bundle made from records, in pieces, as ``(path, place, piece)``; the inverse of reading.

    Records are deflated where they are, in blocks that end with a byte, so that a file is the blocks of its bundle one
    after the other. No task holds a file, or all records of one.
    """
    marker, packed_size, held_size = APPROVAL_FILE, PACKED, PACKED_HELD
    block = "bundle string, place bigint, size bigint, crc bigint, piece binary"

    def lines(batch: pa.RecordBatch, header: bool = False) -> bytes:
        text = pa.BufferOutputStream()
        arrow_csv.write_csv(batch, text, arrow_csv.WriteOptions(include_header=header, delimiter=";"))
        return text.getvalue().to_pybytes().decode().encode(encoding)

    def deflated(text: bytes) -> bytes:
        packing = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -15)
        return packing.compress(text) + packing.flush(zlib.Z_FULL_FLUSH)

    def deflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        place, held, sizes = TaskContext.get().partitionId() << 32, {}, {}

        def flush(bundle: str | None) -> pa.RecordBatch:
            nonlocal place
            text = b"".join(held.pop(bundle))
            del sizes[bundle]
            place += 1
            values = ([bundle], pa.string()), ([place], pa.int64()), ([len(text)], pa.int64()), ([zlib.crc32(text)], pa.int64()), ([deflated(text)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in values], ["bundle", "place", "size", "crc", "piece"])

        for batch in batches:
            names = batch.column("bundle").dictionary_encode(null_encoding="encode")
            rows = batch.select(columns)
            for code, bundle in enumerate(names.dictionary.to_pylist()):
                text = lines(rows.filter(pc.equal(names.indices, code)))
                held.setdefault(bundle, []).append(text)
                sizes[bundle] = sizes.get(bundle, 0) + len(text)
                if sizes[bundle] >= packed_size:
                    yield flush(bundle)
            while sum(sizes.values()) > held_size:
                yield flush(max(sizes, key=sizes.get))
        for bundle in list(held):
            yield flush(bundle)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What stands around the blocks of a file: the headers, a last block without text, and the directory."""
        powers = [1 << 30]  # x to the powers of two, modulo the polynomial of CRC-32

        def times(a: int, b: int) -> int:
            bit, product = 1 << 31, 0
            while a:
                if a & bit:
                    product ^= b
                    a ^= bit
                bit >>= 1
                b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
            return product

        while len(powers) < 64:
            powers.append(times(powers[-1], powers[-1]))

        def joined(crc: int, other: int, size: int) -> int:
            """The CRC-32 of two texts, the second of which has the given size."""
            shift, n, power = 1 << 31, size * 8, 0
            while n:
                if n & 1:
                    shift = times(powers[power], shift)
                n, power = n >> 1, power + 1
            return times(shift, crc) ^ other

        day = (2020 - 1980) << 9 | 1 << 5 | 1
        members: list[tuple] = []
        at = place = 0
        name = None

        def piece(data: bytes) -> pa.RecordBatch:
            nonlocal at, place
            at, place = at + len(data), place + 1
            return pa.RecordBatch.from_arrays([pa.array([f"{name}.zip"]), pa.array([place - 1]), pa.array([data], pa.binary())], ["path", "place", "piece"])

        def member(file: bytes, method: int) -> bytes:
            """Its header; sizes, of eight bytes, follow behind the data."""
            unknown = struct.pack("<HHQQ", 1, 16, 0, 0)
            return struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 8, method, 0, day, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(file), len(unknown)) + file + unknown

        def end(file: bytes, method: int, start: int, crc: int, packed: int, size: int) -> bytes:
            members.append((file, method, start, crc, packed, size))
            return struct.pack("<4sIQQ", b"PK\x07\x08", crc, packed, size)

        def directory() -> bytes:
            entries = b""
            for file, method, start, crc, packed, size in members:
                large = struct.pack("<HHQQQ", 1, 24, size, packed, start)
                entries += struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 8, method, 0, day, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(file), len(large), 0, 0, 0, 0o600 << 16, 0xFFFFFFFF)
                entries += file + large
            n = len(members)
            found = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, len(entries), at)
            found += struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(entries), 1)
            return entries + found + struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, n, n, 0xFFFFFFFF, 0xFFFFFFFF, 0)

        def rest() -> Iterator[pa.RecordBatch]:
            last = b"\x03\x00"
            yield piece(last + end(b"data.csv", 8, start, crc, packed + len(last), size))
            yield piece(directory())

        begun = False
        for batch in batches:
            for values in zip(*[batch.column(c) for c in ("bundle", "size", "crc", "piece")]):
                bundle, length, check, data = (v.as_py() for v in values)
                if not begun or bundle != name:
                    if begun:
                        yield from rest()
                    begun, name, at, place, members = True, bundle, 0, 0, []
                    if approved:
                        file = marker.encode()
                        yield piece(member(file, 0) + end(file, 0, 0, 0, 0, 0))
                    start = at
                    empty = pa.RecordBatch.from_arrays([pa.array([], pa.string())] * len(columns), columns)
                    header = lines(empty, True)
                    first = deflated(header)
                    size, crc, packed = len(header), zlib.crc32(header), len(first)
                    yield piece(member(b"data.csv", 8) + first)
                yield piece(data)
                size, crc, packed = size + length, joined(crc, check, length), packed + len(data)
        if begun:
            yield from rest()

    wanted = records.select("bundle", *[F.col(c).cast("string").alias(c) for c in columns])
    blocks = wanted.mapInArrow(deflate, block).repartition("bundle").sortWithinPartitions("bundle", "place")
    return blocks.mapInArrow(put_together, "path string, place bigint, piece binary")


def pack_bundles(records: DataFrame, columns: list[str], approved: bool = False, encoding: str = "cp1252") -> DataFrame:
    """The same with a file as one value, as ``(path, content)``, which a task holds as a whole."""
    opened = _make_opener()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, file in opened(batches):
            size = file.tell()
            file.seek(0)
            content = pa.allocate_buffer(size)
            file.readinto(memoryview(content))
            ends = pa.py_buffer(struct.pack("=ii", 0, size))
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.Array.from_buffers(pa.binary(), 1, [None, ends, content])], ["path", "content"])

    return _files(pack_pieces(records, columns, approved, encoding)).mapInArrow(whole, "path string, content binary")
