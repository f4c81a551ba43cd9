"""Delimited lists read side by side from parts of one file, with every record numbered in file order.

A record may hold line breaks in quotes, so whether a line starts a record depends on all lines before it. What a
part of the file does to that is little: for either state at its first line (outside or inside of quotes) the state
after its last line, and the number of records that start in it. One pass over the file finds this for each part,
states and numbers are carried along the parts, and a second pass cuts the records. Only records that reach over the
edge of a part are put together in a shuffle.

Lines are taken as bytes and decoded here, so any charset that keeps ASCII will do, whatever Spark accepts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _tools(sep: str) -> tuple[Callable, Callable]:
    """Functions that cut a line and that go through a task's lines; closures, so that they travel by value."""
    mark = sep.encode("ascii")

    def quotes_open(piece: bytes, inside: bool) -> bool:
        if b'"' not in piece:
            return inside
        at = 0
        if not inside and piece.startswith(b'"'):
            inside, at = True, 1
        while True:
            if inside:
                end = piece.find(b'"', at)
                if end < 0:
                    return True
                at = end + 1
                if piece[at : at + 1] == b'"':  # a doubled quote stands for itself
                    at += 1
                    continue
            # the rest of a cell: a quote in it is text, only one at the start of a cell opens
            after = piece.find(mark, at)
            if after < 0:
                return False
            at = after + 1
            inside = piece[at : at + 1] == b'"'
            at += inside

    def cut(line: bytes, inside: bool) -> tuple[list[tuple[bool, bytes]], bool]:
        """Pieces of records as (starts a record, bytes), and whether quotes are open after the line."""
        found: list[tuple[bool, bytes]] = []
        for number, piece in enumerate(line.split(b"\r")):  # outside of quotes a carriage return ends a record too
            if not inside:
                if piece.strip():
                    found.append((True, piece))
            elif number:
                found[-1] = (found[-1][0], found[-1][1] + b"\r" + piece)
            else:
                found.append((False, piece))
            inside = quotes_open(piece, inside)
        return found, inside

    def parts(batches: Iterator) -> Iterator[tuple[int, Iterator[bytes]]]:
        """(where the part begins, its lines) for the parts of the file that a task reads one after the other."""
        from itertools import groupby

        rows = ((b, v.as_py()) for batch in batches for b, v in zip(batch.column(0).to_pylist(), batch.column(1)))
        for block, group in groupby(rows, key=lambda row: row[0]):
            yield block, (line for _, line in group)

    return cut, parts


def numbered_records(spark: SparkSession, path: str, sep: str = ";", encoding: str = "cp1252") -> DataFrame:
    """``record, cells``: the records of one file, numbered from 0 in file order, and their cells as text.

    Quotes enclose cells that hold separators, line breaks or doubled quotes. Blank lines outside of quotes
    are no records. Bytes that the charset does not know become the replacement character.
    """
    if "\n\r\"".encode(encoding) != b"\n\r\"" or len(sep.encode("ascii")) != 1:
        raise ValueError(f"{encoding}, {sep!r}: line breaks, quotes and separators must be single ASCII bytes")
    raw = spark.read.text(path, lineSep="\n")
    if len(raw.inputFiles()) != 1:
        raise ValueError(f"{path}: an ordered list must be one file")
    lines = raw.select(F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    cut, parts = _tools(sep)

    def look(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for block, part in parts(batches):
            state, starts = [False, True], [0, 0]
            for line in part:
                # once both states are the same the part goes on alike
                both = [cut(line, s) for s in (state[:1] if state[0] == state[1] else state)] * 2
                starts = [n + sum(begins for begins, _ in found) for n, (found, _) in zip(starts, both)]
                state = [now for _, now in both[:2]]
            columns = [pa.array([v], t) for v, t in ((block, pa.int64()), (state, pa.list_(pa.bool_())), (starts, pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, ["block", "after", "starts"])

    begin: dict[int, tuple[bool, int]] = {}
    inside, records = False, 0
    # one row for each part of the file
    for block, after, starts in sorted(tuple(r) for r in lines.mapInArrow(look, "block long, after array<boolean>, starts array<long>").collect()):
        begin[block] = (inside, records)
        inside, records = after[inside], records + starts[inside]

    def split(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("record", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("data", pa.binary())])
        rows: list[tuple] = []

        def batch_of_rows():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for block, part in parts(batches):
            inside, before = begin[block]
            number, whole, held = before - 1, False, [] if inside else None
            for line in part:
                found, now = cut(line, inside)
                for place, (begins, data) in enumerate(found):
                    if begins:
                        number, whole, held = number + 1, True, []
                    held.append(data)
                    if place < len(found) - 1 or not now:
                        rows.append((number, block, whole, b"\n".join(held)))
                        held = None
                inside = now
                if len(rows) >= 10000:
                    yield batch_of_rows()
                    rows.clear()
            if held is not None:
                rows.append((number, block, False, b"\n".join(held)))
        if rows:
            yield batch_of_rows()

    pieces = lines.mapInArrow(split, "record long, block long, whole boolean, data binary")
    over_edges = pieces.where(~F.col("whole")).groupBy("record").agg(
        F.array_sort(F.collect_list(F.struct("block", F.hex("data").alias("data")))).alias("p")
    )
    joined = F.unhex(F.array_join(F.transform("p", lambda p: p["data"]), "0A"))
    records_ = pieces.where("whole").select("record", "data").unionByName(over_edges.select("record", joined.alias("data")))

    def cells(batches: Iterator) -> Iterator:
        import csv

        import pyarrow as pa

        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            texts = (v.as_py().decode(encoding, "replace") for v in batch.column(1))
            made = [next(csv.reader([t], delimiter=sep), []) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.string()))], ["record", "cells"])

    return records_.mapInArrow(cells, "record long, cells array<string>")


def header_names(cells: list[str]) -> list[str]:
    """Column names of a header line: without a byte order mark, empty ones named by place, repeated ones numbered."""
    names: list[str] = []
    for place, cell in enumerate(cells):
        name = cell.removeprefix("﻿").removeprefix("ï»¿") if place == 0 else cell
        name = name if name.strip() else f"Unnamed: {place}"
        found, n = name, 0
        while found in names:
            n += 1
            found = f"{name}.{n}"
        names.append(found)
    return names


def read_numbered(spark: SparkSession, path: str, sep: str = ";", encoding: str = "cp1252") -> DataFrame:
    """A delimited file with a header as text columns, and ``new_index`` 1..N in file order.

    A record with fewer cells than the header has null for the others; further cells are left out.
    """
    records = numbered_records(spark, path, sep, encoding)
    first = records.where("record = 0").first()
    names = header_names(first["cells"]) if first else []
    columns = [F.get("cells", F.lit(place)).alias(name) for place, name in enumerate(names)]
    return records.where("record > 0").select(*columns, F.col("record").alias("new_index"))
