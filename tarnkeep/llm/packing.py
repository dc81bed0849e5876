"""Best-fit packing of documents into sequences by hierarchical residual packing.

Round 0 packs the pieces of each input partition by best fit, longest first. Bins that lack
``SLACK`` tokens or fewer are done. All others are items of the next round, where ``FAN`` tasks'
leftovers meet in one: whole bins are packed again by best fit, so pieces only ever move together
with their bin. The last round has one task, whose input is what little no round before it could
fill: after each round a task leaves full bins only, but for at most a few.

A bin's items are rows with their place in the bin, so no step holds more than one task's share of
leftovers. Each round is written to the shared folder before the next one reads it.

A null text counts as empty and is one token long. Repeated rows are packed as often as they occur. An
empty table gives an empty result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import as_bytes, doc_columns, materialize
from tarnkeep.llm.tokens import FILE, encoder

LENGTH = 2048
END = 0
SLACK = 8
FAN = 16
_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long,"
    " bin long, offset long, size long"
)


def best_fit(sizes: list[int], capacity: int = LENGTH) -> list[int]:
    """The bin of each item; items are taken longest first, each to the fullest bin that fits."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    open_at: dict[int, list[int]] = {}  # room left: bins
    rooms: list[int] = []
    out = [0] * len(sizes)
    bins = 0
    for i in order:
        size = sizes[i]
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            held = open_at[room]
            number = held.pop()
            if not held:
                del open_at[room]
                rooms.pop(at)
        else:
            room, number = capacity, bins
            bins += 1
        out[i] = number
        if room := room - size:
            if room not in open_at:
                open_at[room] = []
                insort(rooms, room)
            open_at[room].append(number)
    return out


def pieces(docs: DataFrame, capacity: int = LENGTH, file: str = FILE) -> DataFrame:
    """Pieces of documents, packed within each partition."""
    end = END.to_bytes(4, "little")

    def pack(frames):
        rows: list[tuple] = []
        for frame in frames:
            ids = encoder(file).encode(as_bytes(frame["text"]))
            for doc, known, data in zip(frame["id"], frame["known"], ids, strict=True):
                data += end
                for k, at in enumerate(range(0, len(data) // 4, capacity)):
                    part = data[4 * at : 4 * (at + capacity)]
                    rows.append((
                        int(doc) if known else None, k, at, len(part) // 4, zlib.crc32(part)
                    ))
        yield _binned(rows, [r[3] for r in rows], 0, capacity)

    docs = doc_columns(docs).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNotNull().alias("known"),
        "text",
    )
    return docs.mapInPandas(pack, _PIECES)


def _number(level: int, count: int) -> np.ndarray:
    """Numbers for bins that no other task of this or another round gives."""
    task = TaskContext.get().partitionId() if TaskContext.get() else 0
    return (level << 58) + (task << 34) + np.arange(count, dtype=np.int64)


def _binned(rows: list[tuple], sizes: list[int], level: int, capacity: int) -> pd.DataFrame:
    bins = np.array(best_fit(sizes, capacity), dtype=np.int64)
    length = np.array(sizes, dtype=np.int64)
    frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(length[order]) - length[order]
    count = int(bins.max()) + 1 if len(bins) else 0
    first = np.searchsorted(bins[order], np.arange(count))
    offset = np.empty(len(bins), dtype=np.int64)
    offset[order] = before - before[first][bins[order]] if count else before
    size = np.bincount(bins, weights=length, minlength=count).astype(np.int64)
    frame["bin"] = _number(level, count)[bins] if count else bins
    frame["offset"] = offset
    frame["size"] = size[bins] if count else bins
    return frame.astype({"piece": "int32", "start": "int64", "length": "int64", "ids_crc32": "int64"})


def _repacked(frame: pd.DataFrame, level: int, capacity: int) -> pd.DataFrame:
    """Rows of whole bins with their bins packed into new ones."""
    frame = frame.sort_values(["bin", "offset"], kind="stable")
    old, first = np.unique(frame["bin"].to_numpy(), return_index=True)
    sizes = frame["size"].to_numpy()[first]
    bins = np.array(best_fit(sizes.tolist(), capacity), dtype=np.int64)
    order = np.argsort(bins, kind="stable")
    count = int(bins.max()) + 1 if len(bins) else 0
    before = np.cumsum(sizes[order]) - sizes[order]
    start = np.searchsorted(bins[order], np.arange(count))
    base = np.empty(len(bins), dtype=np.int64)
    if count:
        base[order] = before - before[start][bins[order]]
    size = np.bincount(bins, weights=sizes, minlength=count).astype(np.int64)
    at = np.searchsorted(old, frame["bin"].to_numpy())
    return frame.assign(
        bin=_number(level, count)[bins][at] if count else frame["bin"],
        offset=frame["offset"].to_numpy() + base[at],
        size=size[bins][at] if count else frame["size"],
    )


def pack(docs: DataFrame, capacity: int = LENGTH, file: str = FILE) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    tasks = docs.rdd.getNumPartitions()
    rows = materialize(pieces(docs, capacity, file))
    done = []
    level = 0
    while True:
        full = F.col("size") >= capacity - SLACK
        done.append(rows.filter(full))
        left = rows.filter(~full)
        if level and tasks == 1:
            done.append(left)
            break
        tasks = max(1, -(-tasks // FAN))
        level += 1
        # neighbouring tasks of the round before meet; a bin's rows stay together
        group = F.shiftright(F.col("bin"), 34).bitwiseAND((1 << 24) - 1)
        near = left.withColumn("__task", (F.floor(group / FAN) % tasks).cast("int"))

        def again(frames, level=level):
            held = [f.drop(columns="__task") for f in frames]
            if held:
                frame = pd.concat(held, ignore_index=True)
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield _repacked(frame, level, capacity)

        rows = materialize(
            near.repartitionById(tasks, "__task").mapInPandas(again, _PIECES)
        )
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"),
        "offset",
    )
