"""Postings packed for a shuffle: a row per receiving task and some 10^5 postings, in place of a row per posting.

A pack holds its postings in the order of term, field and document. A term is written once, document numbers as
distances, and every column as planes of bytes that are compressed together: some four to seven bytes per posting, where a row of
its own takes sixteen.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Postings that a task holds while it packs them.
PACKED_ROWS = 2**18
# Rows that are handed on at once where packs are opened.
OPENED_ROWS = 2**16
# Numbers given out by one task share the bits above this one.
TASK_BITS = 33

PACKS = "part int, pack binary"
POSTINGS = "field string, term string, doc long, tf long, dl int, opens boolean"
_OPENED = pa.schema([("field", pa.string()), ("term", pa.string()), ("doc", pa.int64()), ("tf", pa.int64()), ("dl", pa.int32()), ("opens", pa.bool_())])


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers from 0 in as many bytes as the largest takes: the first bytes of all, then the second ones, ..."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(numbers) or int(numbers.max()) < 256 ** w)
    return numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _numbers(planes: memoryview, n: int) -> np.ndarray:
    width = len(planes) // max(n, 1) or 1
    rows = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return np.ascontiguousarray(rows).view(f"<u{width}").ravel().astype(np.int64)


def _steps(numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distances from the number before; at `starts` the number itself."""
    out = np.diff(numbers, prepend=0)
    out[starts] = numbers[starts]
    return out


def _summed(steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The numbers of such distances."""
    sums = np.cumsum(steps)
    return sums - np.repeat(sums[starts] - steps[starts], np.diff(starts, append=len(steps)))


def _joined(chunks: list[bytes]) -> bytes:
    raw = struct.pack(f"<{len(chunks)}q", *map(len, chunks)) + b"".join(chunks)
    return struct.pack("<q", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)


def _chunks(pack: bytes, n: int) -> list[memoryview]:
    raw = memoryview(pa.decompress(memoryview(pack)[8:], struct.unpack_from("<q", pack)[0], codec="zstd", asbytes=True))
    ends = 8 * n + np.cumsum([0, *struct.unpack_from(f"<{n}q", raw)])
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]


def pack(rows: pa.Table, parts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Postings as one pack per value of `parts`, which has the receiving task of every row."""
    if not rows.num_rows:
        return
    terms, fields = (rows.column(c).combine_chunks().dictionary_encode() for c in ("term", "field"))
    words, names = terms.dictionary.cast(pa.large_binary()), "\0".join(fields.dictionary.to_pylist()).encode()
    term, field = terms.indices.to_numpy().astype(np.int64), fields.indices.to_numpy()
    group, doc = term * len(fields.dictionary) + field, rows.column("doc").to_numpy()
    order = np.lexsort((doc, group, parts))
    parts, group, term, field, doc = parts[order], group[order], term[order], field[order], doc[order]
    tf, dl, opens = (rows.column(c).to_numpy()[order] for c in ("tf", "dl", "opens"))
    cuts = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
    for a, b in zip(cuts, np.append(cuts[1:], len(parts))):
        new = np.append(True, group[a + 1:b] != group[a:b - 1])
        starts = np.flatnonzero(new)
        word = words.take(pa.array(term[a:b][starts]))
        offsets = np.frombuffer(word.buffers()[1], np.int64)[:len(word) + 1]
        text = word.buffers()[2].to_pybytes()[offsets[0]:offsets[-1]] if word.buffers()[2] else b""
        task, place = doc[a:b] >> TASK_BITS, doc[a:b] & (2**TASK_BITS - 1)
        by_task = _steps(task, starts)
        places = np.flatnonzero(new | (by_task > 0))
        yield int(parts[a]), _joined([
            struct.pack("<qq", b - a, len(starts)), names, _planes(np.diff(starts, append=b - a)), _planes(field[a:b][starts]),
            _planes(np.diff(offsets)), text, _planes(by_task), _planes(_steps(place, places)),
            _planes(tf[a:b]), _planes(dl[a:b]), np.packbits(opens[a:b]).tobytes()])


def opened(pack: bytes) -> pa.RecordBatch:
    """The postings of a pack, in the order of field and document for each term."""
    sizes, names, counts, field, lengths, text, by_task, places, tf, dl, opens = _chunks(pack, 11)
    n, groups = struct.unpack("<qq", sizes)
    counts = _numbers(counts, groups)
    starts = np.cumsum(counts) - counts
    rows = pa.array(np.repeat(np.arange(groups), counts))
    offsets = np.append(0, np.cumsum(_numbers(lengths, groups))).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), groups, [None, pa.py_buffer(offsets), pa.py_buffer(bytes(text))])
    fields = pa.array(bytes(names).decode().split("\0")).take(pa.array(_numbers(field, groups)))
    by_task = _numbers(by_task, n)
    new = by_task > 0
    new[starts] = True
    doc = (_summed(by_task, starts) << TASK_BITS) + _summed(_numbers(places, n), np.flatnonzero(new))
    return pa.RecordBatch.from_arrays([
        fields.take(rows), words.take(rows), pa.array(doc), pa.array(_numbers(tf, n)), pa.array(_numbers(dl, n).astype(np.int32)),
        pa.array(np.unpackbits(np.frombuffer(opens, np.uint8), count=n).astype(bool))], schema=_OPENED)


def packs(batches: Iterator[pa.RecordBatch], part_of: Callable[[pa.Table], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of postings as (part, pack); `part_of` gives the receiving tasks."""
    held, n = [], 0

    def sent() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        made = list(pack(rows, part_of(rows)))
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in made], pa.int32()), pa.array([x for _, x in made], pa.binary())], ["part", "pack"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= PACKED_ROWS:
            yield sent()
            held, n = [], 0
    if n:
        yield sent()


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of postings again, in no order."""
    held, n = [], 0
    for batch in batches:
        for packed in batch.column("pack"):
            held.append(opened(packed.as_py()))
            n += held[-1].num_rows
            if n >= OPENED_ROWS:
                yield pa.concat_batches(held)
                held, n = [], 0
    if n:
        yield pa.concat_batches(held)
