"""Fill-in-the-middle arrangement of documents by piece tables.

A document's bytes are an immutable buffer and the three sentinels are another;
neither is ever copied or changed. A piece table is a list of descriptors
(buffer, start, length). Cutting splits descriptors at byte places, an
arrangement permutes the cut parts and puts a sentinel's descriptor before each,
and the inverse permutation gives the document back. Hashes run over the
descriptors' bytes in order, so they need no joined text; a text is joined only
where its column is asked for.

Places are counted in code points: both ends of the middle come from the
document's id alone, so a retried task makes the same cut.

``restored`` reads nothing but ``output`` and ``form``: it makes a piece table
over the output, cuts it at the sentinels, drops them and permutes back. This
is exact since an arranged text holds no sentinel of its own, and none can come
about where two parts meet.

Work is one pass without a shuffle; a task holds a few megabytes of texts, or
one longer text. Defined cases: null text is empty, and empty text is ``plain``;
a null ``doc_id`` counts as no digits at all; rows with equal ids are cut by the
same numbers, each in its own text; an empty table gives an empty result; only
``doc_id`` and ``text`` are used, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.textkit import slices, workers_ready

#: The sentinels of prefix, middle and suffix, one buffer.
SENTINELS = b"<P><M><S>"
_MARKS = [SENTINELS[i:i + 3] for i in (0, 3, 6)]
#: Order in which an arrangement takes prefix (0), middle (1) and suffix (2).
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: Documents of a hundred that stay plain, and that put the suffix first.
PLAIN_SHARE, SPM_SHARE = 10, 20

TEXT, MARK = 0, 1
_BLOCK = 1 << 16

Piece = tuple[int, int, int]


class PieceTable:
    """Descriptors (buffer, start, length) over immutable buffers."""

    def __init__(self, *buffers: bytes):
        self.buffers = [memoryview(b) for b in buffers]
        self.pieces: list[Piece] = [(0, 0, len(buffers[0]))]

    def cut(self, places: list[int]) -> list[list[Piece]]:
        """The descriptors between ascending byte places: one run more than
        places, some of them empty."""
        runs, run, at, left = [], [], 0, list(places)
        for buffer, start, length in self.pieces:
            while left and left[0] < at + length:
                part = left.pop(0) - at
                run.append((buffer, start, part))
                runs.append(run)
                run, at, start, length = [], at + part, start + part, length - part
            run.append((buffer, start, length))
            at += length
        for _ in left:
            runs.append(run)
            run = []
        return [*runs, run]

    def chunks(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            if length:
                yield self.buffers[buffer][start:start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for chunk in self.chunks():
            digest.update(chunk)
        return digest.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.chunks())


def code_points(data: bytes) -> int:
    raw = np.frombuffer(data, np.uint8)
    return int(((raw & 0xC0) != 0x80).sum())


def byte_place(data: bytes, n: int, k: int) -> int:
    """Byte at which code point k of the n in ``data`` begins."""
    if k >= n:
        return len(data)
    if n == len(data):
        return k
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw), _BLOCK):
        begins = np.flatnonzero((raw[at:at + _BLOCK] & 0xC0) != 0x80)
        if k < len(begins):
            return at + int(begins[k])
        k -= len(begins)
    raise ValueError("fewer code points than said")


def draws(doc_id) -> list[int]:
    """Four 32-bit numbers that belong to an id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def arrangement(doc_id, data: bytes) -> tuple[int, str, int | None, int | None, PieceTable]:
    """(code points, form, those of prefix and middle, the arranged table)."""
    n = code_points(data)
    h1, h2, h3, h4 = draws(doc_id)
    table = PieceTable(data, SENTINELS)
    if not data or h3 % 100 >= 100 - PLAIN_SHARE or any(mark in data for mark in _MARKS):
        return n, "plain", None, None, table
    form = "spm" if h4 % 100 < SPM_SHARE else "psm"
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = table.cut([byte_place(data, n, first), byte_place(data, n, last)])
    table.pieces = [x for part in ORDERS[form] for x in ((MARK, 3 * part, 3), *parts[part])]
    return n, form, first, last - first, table


def restoration(output: bytes, form: str) -> PieceTable:
    """The document's table over the buffer of an output."""
    table = PieceTable(output)
    if form == "plain":
        return table
    order, places, at = ORDERS[form], [], 0
    for part in order:
        at = output.index(_MARKS[part], at)
        places += [at, at + 3]
        at += 3
    runs = table.cut(places)
    held = dict(zip(order, (runs[2], runs[4], runs[6]), strict=True))
    table.pieces = [x for part in sorted(held) for x in held[part]]
    return table


def _strings(values: list[bytes]) -> pa.Array:
    """A string column of UTF-8 bytes, unchecked, as the bytes came in."""
    held = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(held), held.buffers(), held.null_count)


_PIECE = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])


def arranged(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (the arranged text),
    pieces (its descriptors: buffer 0 is the text, 1 the sentinels) and
    output_sha256, one row per document."""
    workers_ready(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, "
              "pieces array<struct<buffer:int,start:bigint,length:bigint>>, output_sha256 string")

    def run(batches):
        for batch in batches:
            for ids, texts in slices(batch):
                rows = [arrangement(i, t) for i, t in zip(ids.to_pylist(), texts, strict=True)]
                counts = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 2, 3)]
                tables = [r[4] for r in rows]
                yield pa.RecordBatch.from_arrays([
                    ids, counts[0], pa.array([r[1] for r in rows], pa.string()), counts[1], counts[2],
                    _strings([t.joined() for t in tables]),
                    _piece_lists(tables),
                    pa.array([t.sha256() for t in tables], pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "pieces", "output_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _piece_lists(tables: list[PieceTable]) -> pa.Array:
    flat = [x for t in tables for x in t.pieces]
    fields = [pa.array([x[k] for x in flat], f.type) for k, f in enumerate(_PIECE)]
    offsets = np.cumsum([0, *(len(t.pieces) for t in tables)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_PIECE)))


def restored(outputs: DataFrame, keep_text: bool = False) -> DataFrame:
    """The rows of ``outputs`` (output, form) with restored_sha256 and, on
    demand, restored: the document that the output was made from."""
    workers_ready(outputs.sparkSession)
    more = ", restored string" if keep_text else ""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema) + ", restored_sha256 string" + more

    def run(batches):
        for batch in batches:
            forms = batch.column("form")
            at = 0
            for _, texts in slices(batch, "form", "output"):
                part = batch.slice(at, len(texts))
                tables = [restoration(t, f) for t, f in zip(texts, forms.slice(at, len(texts)).to_pylist(), strict=True)]
                at += len(texts)
                made = [pa.array([t.sha256() for t in tables], pa.string())]
                if keep_text:
                    made.append(_strings([t.joined() for t in tables]))
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "restored_sha256", "restored"][:len(part.columns) + len(made)])

    return outputs.mapInArrow(run, schema)
