"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Documents become token ids and one end id. Longer ones than a sequence are cut into full pieces and
a rest. Pieces are packed best-fit, longest first, within each partition. Nearly full bins are
final. The others become items of a further round, in which the bins of several partitions meet in
one: bins are put into bins, and so on until one group remains or bins stop merging. A round's input
is one row per open bin; pieces are not moved. At the end each piece finds its sequence through the
bin it was first put in.

Defined cases: a NULL text is empty and gives one piece with the end id; repeated rows are packed
each; an empty table gives no piece. Other columns of the input are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common

END_ID = 0
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: How the tokenizer's file cuts a normalised text into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Texts with these go to the tokenizer whole: names of special tokens, and characters on which
#: Python and the tokenizer may differ about white space.
WHOLE = regex.compile(r"<\||[\x1c-\x1f\x85]")
#: A worker remembers the ids of at least so many strings, and of at most twice as many.
REMEMBERED = 250_000


class Remembered(dict):
    """Values of a function. When full, the values not used since the last time are forgotten."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found


class TokenBytes:
    """Ids of texts as little-endian 32-bit bytes.

    No token crosses white space, so the ids of a text are those of its parts one after another.
    Texts come many at a time, and of their parts each different one is looked at once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.normalize = self.tokenizer.normalizer.normalize_str
        # The byte-level alphabet: printable bytes stand for themselves, others follow from 256 on.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in printable]
        self.alphabet = {b: 256 + k for k, b in enumerate(rest)}
        self.words = Remembered(self._word)

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii() or not word.isprintable():
            raw = word.encode("utf-8", "surrogatepass")
            word = raw.decode("latin-1").translate(self.alphabet)
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(word)])

    def _part(self, part: str) -> bytes:
        # Below U+0300 texts are normalised, and lower case does not depend on what follows.
        plain = part.lower() if part.isascii() or max(part) < "\u0300" else self.normalize(part)
        words = self.words
        if plain.isalpha():
            return words[plain]
        if plain[-1] in ".," and plain[:-1].isalpha():
            return words[plain[:-1]] + words[plain[-1]]
        return b"".join([words[w] for w in WORD.findall(plain)])

    def of_texts(self, texts: list[str]) -> list[bytes]:
        whole = {i for i, text in enumerate(texts) if WHOLE.search(text)}
        column = pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.large_string())
        lists = pc.utf8_split_whitespace(column)
        parts = lists.flatten().dictionary_encode()
        ids = [self._part(part) if part else b"" for part in parts.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        codes = parts.indices.to_numpy()
        each = sizes[codes]
        ends = np.cumsum(each)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - ends + each, each)
        flat = np.frombuffer(b"".join(ids), "<u4")[places]
        upto = np.concatenate([[0], ends])[lists.offsets.to_numpy()]
        return [
            self.encode(texts[i]) if i in whole else flat[upto[i] : upto[i + 1]].tobytes()
            for i in range(len(texts))
        ]


@functools.cache
def token_bytes(path: str) -> TokenBytes:
    """One per worker process and tokenizer, so that what it remembers outlives a task."""
    return TokenBytes(path)


def cut(ids: bytes, size: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Pieces of a document's ids: number, start, length, bytes."""
    for number, start in enumerate(range(0, len(ids), 4 * size)):
        part = ids[start : start + 4 * size]
        yield number, start // 4, len(part) // 4, part


def tokenize(docs: DataFrame, tokenizer: str, size: int, with_ids: bool = False) -> DataFrame:
    """A row per piece; with ``with_ids`` also its ids."""
    types = dict(docs.dtypes)
    schema = PIECE_SCHEMA.replace("doc_id long", f"doc_id {types['doc_id']}")
    schema += ", ids array<long>" * with_ids
    end = np.array([END_ID], "<u4").tobytes()

    def work(rows: list[dict]) -> Iterator[tuple]:
        encoder = token_bytes(tokenizer)
        for chunk in common.chunks(rows):
            encoded = encoder.of_texts([row["text"] or "" for row in chunk])
            for row, ids in zip(chunk, encoded, strict=True):
                for number, start, length, part in cut(ids + end, size):
                    own = (np.frombuffer(part, "<u4").tolist(),) * with_ids
                    yield (row["doc_id"], number, start, length, zlib.crc32(part), *own)

    return common.map_rows(docs.select("doc_id", "text"), schema, work)


class Packer:
    """Best fit, longest first. Open bins are stacked by the room they have left."""

    def __init__(self, size: int) -> None:
        self.size = size

    def pack(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Bin and offset of each item, and the fill of each bin."""
        bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        fills: list[int] = []
        open_bins: list[list[int]] = [[] for _ in range(self.size + 1)]
        rooms = 0  # bit r: some open bin has r places left
        for i in np.argsort(-lengths, kind="stable").tolist():
            need = int(lengths[i])
            fitting = rooms >> need
            if fitting:
                room = need + (fitting & -fitting).bit_length() - 1
                b = open_bins[room].pop()
                if not open_bins[room]:
                    rooms ^= 1 << room
            else:
                room, b = self.size, len(fills)
                fills.append(0)
            bins[i], offsets[i] = b, fills[b]
            fills[b] += need
            if room > need:
                open_bins[room - need].append(b)
                rooms |= 1 << (room - need)
        return bins, offsets, fills


def _packed(df: DataFrame, size: int, block: int) -> DataFrame:
    """Adds ``bin``, ``offset`` and the bin's ``fill`` to items with an ``item`` and a ``length``.

    A task packs up to ``block`` items at a time, so its memory is bounded.
    """
    schema = pa.schema(
        [("item", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64())]
    )

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, held, count
            table = pa.Table.from_batches(held)
            bins, offsets, fills = Packer(size).pack(table["length"].to_numpy())
            fill = np.array(fills, np.int64)[bins]
            columns = [table["item"].combine_chunks(), bins + first, offsets, fill]
            out = pa.table(dict(zip(schema.names, map(pa.array, columns), strict=True)))
            yield from out.to_batches(10_000)
            first, held, count = first + len(fills), [], 0

        for batch in source:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
                if count >= block:
                    yield from flush()
        if held:
            yield from flush()

    common.ship(df.sparkSession)
    ddl = "item long, bin long, offset long, fill long"
    return df.select("item", "length").mapInArrow(batches, ddl)


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = 2048,
    slack: int = 8,
    block: int = 500_000,
    fan_in: int = 8,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece of a document with its ``sequence_id`` and ``offset``.

    Bins with at most ``slack`` places left are final after each round. Rounds bring ``fan_in``
    groups into one, until one is left or a round over one group's worth of bins is done.
    """
    spark = docs.sparkSession
    ws = common.Workspace(spark, "packing")
    pieces = ws.store(
        tokenize(docs, tokenizer, size, with_ids).withColumn("item", F.monotonically_increasing_id()),
        "pieces",
    )
    # Full pieces are bins already. Their numbers are the items' own, below zero.
    alone = pieces.where(F.col("length") > size - slack).select(
        *pieces.columns, (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    parts = pieces.where(F.col("length") <= size - slack)
    first = ws.store(_packed(parts, size, block), "round-0")
    level = first.groupBy("bin").agg(F.max("fill").alias("length")).where(
        F.col("length") < size - slack
    ).withColumnRenamed("bin", "item")
    moves: list[DataFrame] = []
    groups = max(1, first.rdd.getNumPartitions())
    count = level.count()
    number = 0
    while count > 1:
        number += 1
        groups = max(-(-groups // fan_in), -(-count // block))
        merged = ws.store(_packed(level.repartition(groups), size, block), f"round-{number}")
        moves.append(merged)
        level = merged.groupBy("bin").agg(F.max("fill").alias("length")).where(
            F.col("length") < size - slack
        ).withColumnRenamed("bin", "item")
        left = level.count()
        if groups == 1 or left > 0.98 * count and groups <= -(-left // block):
            break
        count = left

    placed = first.select("item", F.lit(0).alias("round"), "bin", "offset")
    for number, merged in enumerate(moves, 1):
        # Bins are numbered anew in every round; those of the round before are its items.
        up = merged.select(
            F.lit(number - 1).alias("round"), F.col("item").alias("bin"),
            F.col("bin").alias("next"), F.col("offset").alias("by"),
        )
        placed = placed.join(up, ["round", "bin"], "left").select(
            "item",
            F.when(F.col("next").isNull(), F.col("round")).otherwise(number).alias("round"),
            F.coalesce("next", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"),
        )
    # A bin's number holds its partition from bit 40 on; the round goes on top of it.
    named = placed.select(
        "item", (F.col("round") * (1 << 58) + F.col("bin")).alias("sequence_id"), "offset"
    )
    return alone.unionByName(parts.join(named, "item")).drop("item")
