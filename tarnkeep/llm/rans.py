"""Token-ID files coded by a static range asymmetric numeral system (rANS).

Format. Documents go in ascending doc_id order (nulls first, rows with one doc_id by a hash of their
text). They are cut, at document ends, into segments of about ``SEGMENT`` ids. A segment is one
record of a Parquet table, which Spark's own committed writers put on any store:

- ``part``, ``number``, ``start``: its range of documents, its place there, ids of the range before it;
- ``doc_ids``, ``known``, ``lengths``: its documents;
- ``table``: the frequency table that its blocks share: ids and scaled counts, deflated;
- ``blocks``: independent blocks of ``BLOCK`` ids or fewer. Each has the checkpoint a decoder starts
  from (its first id's place in the segment and the final state of every lane) and a crc32 of its ids.

In a block, ``LANES`` interleaved coders take the ids in turn; each keeps a 63-bit state and moves 32
bits at a time, so all lanes are coded by whole-array operations. Blocks decode in any order and
on any task. A wrong checksum raises.

A null text counts as empty and has the end id alone. Repeated rows are written as often as they occur.
An empty table gives no segment. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkeep.llm.common import as_bytes, doc_columns, materialize, part_count
from tarnkeep.llm.tokens import FILE, encoder

END = 2
#: Bits of the scaled counts: more than ids in the vocabulary, for each needs one.
SCALE = 20
LOWEST = 1 << 31  # states stay at or above it, below it times 2**32
LANES = 1024
#: Ids below it are counted and looked up by place rather than by sorting.
COUNTED = 1 << 22
BLOCK = 1 << 18
SEGMENT = 1 << 20


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and counts scaled to a sum of 2**SCALE, each at least 1."""
    if len(ids) and ids.max() < COUNTED:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
    else:
        symbols, counts = np.unique(ids, return_counts=True)
    total = 1 << SCALE
    if not len(symbols):
        return symbols, counts
    if len(symbols) > total:
        raise ValueError("more distinct ids than the scale has room for")
    scaled = np.maximum(1, counts * (total - len(symbols)) // counts.sum())
    scaled[np.argmax(scaled)] += total - scaled.sum()
    return symbols, scaled


def encode_block(places: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> tuple:
    """(payload, lane states) of the table places of a block's ids."""
    n = len(places)
    steps = -(-n // LANES)
    state = np.full(LANES, LOWEST, dtype=np.uint64)
    words = []
    shift, scale = np.uint64(32), np.uint64(SCALE)
    limit = counts.astype(np.uint64) << np.uint64(63 - SCALE)
    counts, starts = counts.astype(np.uint64), starts.astype(np.uint64)
    for step in range(steps - 1, -1, -1):
        p = places[step * LANES : (step + 1) * LANES]
        x = state[: len(p)]
        out = x >= limit[p]
        if out.any():
            words.append((x[out] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            x = np.where(out, x >> shift, x)
        f = counts[p]
        q = x // f
        state[: len(p)] = (q << scale) + (x - q * f) + starts[p]
    # a decoder reads what was written last first
    words = np.concatenate([np.zeros(0, np.uint32), *words])
    payload = words[::-1].astype("<u4").tobytes()
    return payload, state.astype("<u8").tobytes()


def decode_block(
    payload: bytes, states: bytes, n: int, slots: np.ndarray, counts: np.ndarray, starts: np.ndarray
) -> np.ndarray:
    """Table places of the ``n`` ids of a block."""
    words = np.frombuffer(payload, "<u4").astype(np.uint64)
    state = np.frombuffer(states, "<u8").astype(np.uint64)
    out = np.empty(n, dtype=np.int64)
    counts, starts = counts.astype(np.uint64), starts.astype(np.uint64)
    mask, scale, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    lowest = np.uint64(LOWEST)
    at = 0
    for step in range(0, n, LANES):
        width = min(LANES, n - step)
        x = state[:width]
        slot = x & mask
        p = slots[slot]
        out[step : step + width] = p
        x = counts[p] * (x >> scale) + slot - starts[p]
        low = np.flatnonzero(x < lowest)
        if len(low):
            if at + len(low) > len(words):
                raise ValueError("a payload ends early: no checksum can hold")
            # within a step the encoder wrote its lanes in ascending order, read here backwards
            x[low] = (x[low] << shift) | words[at : at + len(low)][::-1]
            at += len(low)
        state[:width] = x
    return out


def encode_segment(ids: np.ndarray) -> tuple[bytes, list[dict]]:
    symbols, counts = frequency_table(ids)
    starts = np.cumsum(counts) - counts
    head = np.stack([symbols, counts]).astype("<u4").tobytes()
    if len(symbols) and symbols[-1] < COUNTED:
        place_of = np.zeros(int(symbols[-1]) + 1, dtype=np.int64)
        place_of[symbols] = np.arange(len(symbols))
        places = place_of[ids]
    else:
        places = np.searchsorted(symbols, ids)
    blocks = []
    for at in range(0, len(ids), BLOCK):
        part = ids[at : at + BLOCK]
        payload, states = encode_block(places[at : at + BLOCK], counts, starts)
        blocks.append({
            "start": at, "length": len(part), "states": states, "payload": payload,
            "crc32": zlib.crc32(part.astype("<u4").tobytes()),
        })
    return zlib.compress(head), blocks


def decode_segment(table: bytes, blocks) -> np.ndarray:
    symbols, counts = np.frombuffer(zlib.decompress(table), "<u4").reshape(2, -1).astype(np.int64)
    starts = np.cumsum(counts) - counts
    slots = np.repeat(np.arange(len(symbols)), counts)
    parts = [np.zeros(0, dtype="<u4")]
    for b in blocks:
        places = decode_block(b["payload"], b["states"], b["length"], slots, counts, starts)
        ids = symbols[places].astype("<u4")
        if zlib.crc32(ids.tobytes()) != b["crc32"]:
            raise ValueError(f"block at {b['start']}: checksum differs")
        parts.append(ids)
    return np.concatenate(parts)


_SEGMENTS = (
    "part int, number int, start long, total long, doc_ids array<long>, known array<boolean>,"
    " lengths array<long>, table binary,"
    " blocks array<struct<start:long,length:long,states:binary,payload:binary,crc32:long>>"
)


def _segment_schema() -> pa.Schema:
    block = pa.struct([
        ("start", pa.int64()), ("length", pa.int64()), ("states", pa.binary()), ("payload", pa.binary()),
        ("crc32", pa.int64()),
    ])
    return pa.schema([
        ("part", pa.int32()), ("number", pa.int32()), ("start", pa.int64()), ("total", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("known", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())),
        ("table", pa.binary()), ("blocks", pa.list_(block)),
    ])


def encode(docs: DataFrame, file: str = FILE, segment: int = SEGMENT) -> DataFrame:
    """Segments of the format, by ranges of documents.

    Texts are shuffled and sorted by Spark, and tokenized where their segment is written. A range ends
    anywhere, also among rows with one doc_id.
    """
    order = [F.asc_nulls_first("doc_id"), F.col("h"), F.col("r")]
    sorted_docs = doc_columns(docs).select(
        "*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("r")
    ).repartitionByRange(part_count(docs.sparkSession), *order).sortWithinPartitions(*order)
    schema = _segment_schema()

    def write(batches):
        part, encoder_ = TaskContext.get().partitionId(), encoder(file)
        number, start, held, size = 0, 0, [], 0
        end = END.to_bytes(4, "little")

        def flush():
            nonlocal number, start, held, size
            table, blocks = encode_segment(np.frombuffer(b"".join(h[1] for h in held), "<u4"))
            row = {
                "part": part, "number": number, "start": start, "total": size,
                "doc_ids": [h[0] or 0 for h in held], "known": [h[0] is not None for h in held],
                "lengths": [len(h[1]) // 4 for h in held], "table": table, "blocks": blocks,
            }
            number, start, held, size = number + 1, start + size, [], 0
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = encoder_.encode(as_bytes(batch.column("text").to_pylist()))
            for doc, data in zip(ids, texts, strict=True):
                held.append((doc, data + end))
                size += len(data) // 4 + 1
                if size >= segment:
                    yield flush()
        if held:
            yield flush()

    return sorted_docs.select("doc_id", "text").mapInArrow(write, _SEGMENTS)


def decode(segments: DataFrame) -> DataFrame:
    """doc_id, start (in its range), n_tokens, ids_crc32 and part of each document of a file."""
    schema = "id long, known boolean, start long, n_tokens long, ids_crc32 long, part int"

    def read(batches):
        for batch in batches:
            column = batch.column
            for i in range(batch.num_rows):
                data = decode_segment(column("table")[i].as_py(), column("blocks")[i].as_py()).tobytes()
                lengths = column("lengths")[i].values
                n = lengths.to_numpy()
                ends = np.cumsum(n)
                view = memoryview(data)
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                starts = column("start")[i].as_py() + ends - n
                yield pa.RecordBatch.from_arrays([
                    column("doc_ids")[i].values, column("known")[i].values, pa.array(starts), lengths,
                    pa.array(crc, pa.int64()), pa.array(np.full(len(n), column("part")[i].as_py(), np.int32)),
                ], names=["id", "known", "start", "n_tokens", "ids_crc32", "part"])

    return segments.mapInArrow(read, schema)


def round_trip(docs: DataFrame, file: str = FILE) -> DataFrame:
    """Write the file, read it back, and tell what each document is in it."""
    segments = materialize(encode(docs, file))
    # one row a range, of which there are as many as shuffle partitions
    sizes = sorted(
        (r["part"], r["n"]) for r in segments.groupBy("part").agg(F.sum("total").alias("n")).collect()
    )
    before, total = {}, 0
    for part, n in sizes:
        before[part] = total
        total += n
    base = F.lit(0).cast("long")
    if before:
        base = F.create_map(*[
            x for p, n in before.items() for x in (F.lit(p).cast("int"), F.lit(n).cast("long"))
        ])[F.col("part")]
    return decode(segments).select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"), (F.col("start") + base).alias("start"),
        "n_tokens", "ids_crc32",
    )
