"""Best-fit packing of token sequences by hierarchical residual packing.

A document is its ids and an end id; only one longer than ``capacity`` is cut, into pieces of that length.  Blocks of
pieces are packed by best fit, longest first.  Nearly full sequences are done.  All others become items, with their
fill as length, of the next round, in which fewer tasks pack what several blocks left, again a block of items each.  The
rounds end with one task, or when a round joined fewer than one item in ``GAIN`` (what is left then hardly fits together).
Null and empty texts are an end id alone.  Equal rows are packed each for itself.  An empty table gives no rows.
"""

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from roadstream.llm.texts import keyed_texts, split_rows
from roadstream.llm.vocabulary import File, WordTokens
from roadstream.shared import freeze

CAPACITY = 2048
GAIN = 50


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): what is packed, documents cut only where they have to be."""
    file = File(docs.sparkSession, tokenizer)
    rows = keyed_texts(docs, key, text)
    end = end_id.to_bytes(4, "little")
    step = 4 * capacity

    def cut(batches):
        vocabulary = file.open(WordTokens)
        for batch in batches:
            for part, texts in split_rows(batch):
                row, piece, start, length, crc = [], [], [], [], []
                for number, ids in enumerate(vocabulary.encode(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        body = ids[at:at + step]
                        row.append(number)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(body) // 4)
                        crc.append(zlib.crc32(body))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """(sequence, offset) of each length and the fills, by best fit in decreasing order."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a sequence has exactly r places left
    sequence, offset, fills = [0] * len(lengths), [0] * len(lengths), []
    for item in sorted(range(len(lengths)), key=lambda x: -lengths[x]):
        length = lengths[item]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = open_at[room].pop()
            if not open_at[room]:
                rooms ^= 1 << room
        else:
            room, number = capacity, len(fills)
            fills.append(0)
        sequence[item], offset[item] = number, fills[number]
        fills[number] += length
        if room > length:
            open_at[room - length].append(number)
            rooms |= 1 << (room - length)
    return sequence, offset, fills


def _packer(level: int, capacity: int, slack: int):
    """Pack a task's rows; adds sequence, offset, fill, and whether the next round takes the sequence up."""
    def run(batches):
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        number, offset, fills = best_fit(rows["length"].to_pylist(), capacity)
        first = level << 56 | TaskContext.get().partitionId() << 32
        for name, kind, values in (("_sequence", pa.int64(), [first + x for x in number]), ("_offset", pa.int64(), offset),
                                   ("_fill", pa.int64(), [fills[x] for x in number]), ("_passed", pa.bool_(), [fills[x] < capacity - slack for x in number])):
            rows = rows.append_column(name, pa.array(values, kind))
        yield from rows.to_batches()
    return run


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = 50_000, slack: int = 8) -> DataFrame:
    """``items`` with ``length`` (1 to ``capacity``), placed: adds sequence_id and offset, without gaps.

    Other columns stay; their names are free but for those two and names with a leading underscore.
    ``items`` is read twice and has to be stable, such as a written table.  block: rows packed together; slack: places
    that a finished sequence may lack.
    """
    tasks = -(-items.count() // block)
    if tasks < 1:
        return items.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    added = "_sequence long, _offset long, _fill long, _passed boolean"
    columns = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in items.schema)
    placed = freeze(items.repartition(tasks).mapInArrow(_packer(0, capacity, slack), f"{columns}, {added}"), "packed")

    def left(rows):
        return rows.filter("_passed and _offset = 0").select(F.col("_sequence").alias("_bin"), F.col("_fill").alias("length"))

    moves, bins, level = None, left(placed), 0
    while tasks > 1:
        held = bins.count()
        tasks, level = max(1, -(-held // block)), level + 1
        merged = freeze(bins.repartition(tasks).mapInArrow(_packer(level, capacity, slack), f"_bin long, length long, {added}"), "merged")
        step = merged.select(F.col("_bin").alias("_sequence"), F.col("_sequence").alias("_upper"), F.col("_offset").alias("_shift"))
        moves = step if moves is None else moves.withColumnsRenamed({"_sequence": "_bin", "_upper": "_sequence", "_shift": "_base"}).join(
            step, "_sequence", "left").select(F.col("_bin").alias("_sequence"), F.coalesce("_upper", "_sequence").alias("_upper"),
                                              (F.col("_base") + F.coalesce("_shift", F.lit(0))).alias("_shift"))
        bins = left(merged)
        joined = merged.filter("_offset > 0").count()
        if GAIN * joined < held:
            break
    if moves is None:
        return placed.withColumnsRenamed({"_sequence": "sequence_id", "_offset": "offset"}).drop("_fill", "_passed")
    return placed.join(moves, "_sequence", "left").select(
        *items.columns, F.coalesce("_upper", "_sequence").alias("sequence_id"),
        (F.col("_offset") + F.coalesce("_shift", F.lit(0))).alias("offset"))
