"""Similarity join on word n-grams: a sparse product of documents by their rarest n-grams.

A document is the set of its distinct ``n``-word shingles, as 64-bit digests. Two link when their
Jaccard similarity reaches ``percent``. Equal sets are one row of the product, and of documents with
the same words one sends its columns. Columns are dealt out by ranges of their digests, packed, so a
task counts in how many sets each of its columns is, and those of several sets go back to their
documents.

Bounds from the set sizes keep the product small:

- A set links only if as many of its columns as ``percent`` of its size are in other sets too. Most
  sets have too few and go no further. The others keep these columns, rarest first.
- A pair that links has a first common column in this order, and there both rows have enough columns
  left for what the sizes ask. So a row is multiplied by its first columns only, and by those that
  are rare: rows of a family that share common columns but do not link hardly meet.
- Those left are compared on all their repeated columns, as no other is shared.

Before the product, rows that share several of their first columns by digest with the least row of
these are compared with it, and rows of a column of more than ``hot`` rows with a few of them. That
links the bulk of large groups of near copies to a few rows each, and pairs inside a known component
are left out of the product. So no group is expanded into its pairs; pairs of rows that are close but
do not link are made if their first columns meet.

Defined cases: a text that is NULL or has no word has an empty set and links with nothing; fewer
words than ``n`` are one shingle; equal texts link; rows repeated with their ``doc_id`` are each
returned; ``component_id`` is the smallest ``doc_id`` that is not NULL; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shotmarts.llm import common
from shotmarts.llm.graphs import components

#: Odd multiplier of the rolling hash over words.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


#: Every separator of words as a space, and ASCII letters in lower case.
_LINE = bytes.maketrans(common.SPACES, b" " * len(common.SPACES)).lower()

#: Columns that name a row, where a caller needs them.
OWN = ("row_id", "key_a", "key_b")


@dataclass(frozen=True)
class Join:
    n: int = 5
    percent: int = 75
    #: Rows of a column with more rows than this first meet a few of them only.
    hot: int = 64
    #: Without effect since rows are multiplied by their rarest columns; kept for callers that set it.
    whole: int = 160
    #: Columns at the head of a row by which it first looks for the least row like it, and the rows
    #: of the largest component of a column that the others meet before the product.
    head: int = 8

    def least(self, size: int) -> int:
        """Overlap without which a set of this size links with none."""
        return -(-self.percent * size // 100)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The sorted distinct shingle digests of each text."""
    raw = pa.array([(t or "").encode("utf-8", "surrogatepass") for t in texts], pa.large_binary())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(raw.view(pa.large_utf8())))
    words = lists.flatten().dictionary_encode()
    known = words.dictionary.cast(pa.large_binary()).to_pylist()
    digests = np.array([xxhash.xxh3_64_intdigest(w) for w in known], np.uint64)
    blank = np.array([not w for w in known], bool)
    codes = words.indices.to_numpy()
    real = ~blank[codes] if len(codes) else np.zeros(0, bool)
    upto = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy()]
    ids = digests[codes[real]]
    rolled = ids[: max(0, len(ids) - n + 1)]
    for k in range(1, n):
        rolled = rolled * MULTIPLIER + ids[k : k + len(rolled)]
    rolled = _mixed(rolled).view(np.int64)
    sets = []
    for start, end in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
        if end - start >= n:
            sets.append(np.unique(rolled[start : end - n + 1]))
        elif end > start:
            whole = xxhash.xxh3_64_intdigest(ids[start:end].tobytes(), seed=end - start)
            sets.append(np.array([whole], np.uint64).view(np.int64))
        else:
            sets.append(np.zeros(0, np.int64))
    return sets


def set_digest(columns: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(columns.tobytes())


def short_id(digest: bytes) -> int:
    """Identifies a set inside the product; what it yields is compared on the sets' columns."""
    return int.from_bytes(digest[:8], "little", signed=True)


# --- repeated columns ---------------------------------------------------------------------------


def _packed(s: np.ndarray, *numbers: np.ndarray) -> list[bytes]:
    """Ascending columns as gaps and small numbers beside them. Each byte of them is compressed on its
    own, as some are random and most are zero."""
    gaps = np.diff(s, prepend=np.uint64(0))
    parts = [gaps, *(x.astype(np.uint32) for x in numbers)]
    planes = [plane.tobytes() for p in parts for plane in p.view(np.uint8).reshape(len(s), -1).T]
    return [pa.compress(p, codec="zstd", asbytes=True) for p in planes]


def _unpacked(packed: list[bytes], n: int) -> list[np.ndarray]:
    raw = [np.frombuffer(pa.decompress(p, decompressed_size=n, codec="zstd", asbytes=True), np.uint8) for p in packed]
    gaps = np.stack(raw[:8], axis=1).view(np.uint64)[:, 0]
    numbers = [np.stack(raw[k : k + 4], axis=1).view(np.uint32)[:, 0] for k in range(8, len(raw), 4)]
    return [np.cumsum(gaps, dtype=np.uint64), *numbers]


def _joined(table: pa.Table) -> list[np.ndarray]:
    """The packed records of a table one after the other, and the place in it that each is from."""
    counts = table.column("n").to_pylist()
    packed = zip(table.column("packed").to_pylist(), counts, strict=True)
    parts = [_unpacked(p, n) for p, n in packed]
    owner = np.repeat(np.arange(len(counts)), counts)
    return [*(np.concatenate(x) for x in zip(*parts, strict=True)), owner]


def one_line(text: str | None) -> bytes:
    """The words of a text, in lower case and one space apart."""
    line = (text or "").encode("utf-8", "surrogatepass").translate(_LINE)
    while b"  " in line:
        line = line.replace(b"  ", b" ")
    return line.strip(b" ")


def _content(texts: list[str | None]) -> int:
    told = xxhash.xxh3_64()
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        told.update(len(raw).to_bytes(8, "little"))
        told.update(raw)
    return told.intdigest() - (1 << 63)


def _copies(docs: DataFrame, ws: common.Workspace) -> dict[int, tuple[int, bytes]]:
    """For each block with documents whose words another document has, of which that one will do: the
    block's content, and as bits the places in it of such documents. Of the documents with the same
    words one has no bit."""

    def work(batch: list[dict]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        for chunk in common.chunks(batch):
            block = (part << 32) + next(numbers)
            content = _content([r["text"] for r in chunk])
            for place, r in enumerate(chunk):
                words = one_line(r["text"])
                if words:
                    digest = xxhash.xxh3_128_digest(words)
                    high, low = (int.from_bytes(d, "little", signed=True) for d in (digest[:8], digest[8:]))
                    yield block, content, place, high, low

    def bits(table: pa.Table) -> pa.Table:
        marked = np.zeros(pc.max(table.column("place")).as_py() + 1, bool)
        marked[table.column("place").to_numpy()] = True
        packed = {"block": table.column("block")[:1], "content": table.column("content")[:1], "bits": [np.packbits(marked).tobytes()]}
        return pa.table([pa.array(packed[f.name], f.type) if f.name == "bits" else packed[f.name] for f in given], schema=given)

    numbers = iter(range(1 << 32))
    given = pa.schema([("block", pa.int64()), ("content", pa.int64()), ("bits", pa.binary())])
    known = common.map_rows(docs, "block long, content long, place int, high long, low long", work)
    known = ws.store(known, "known")
    first = known.groupBy("high", "low").agg(F.min(F.struct("block", "place")).alias("first")).select("first.*")
    copies = known.join(first, ["block", "place"], "left_anti").select("block", "content", "place")
    found = copies.groupBy("block").applyInArrow(bits, "block long, content long, bits binary").collect()
    ws.drop("known")
    return {r.block: (r.content, bytes(r.bits)) for r in found}


def _rows(docs: DataFrame, join: Join, ws: common.Workspace) -> DataFrame:
    """A row per document, with its repeated columns, rarest first, if these could be enough for a
    link; of documents with the same words, and of equal sets in a block of documents, only one has
    them. Columns ``OWN`` that ``docs`` brings are kept.

    Documents with the same words are found first, as the columns of each would else count as repeated.
    A block that is not read again as it was then sends all its documents, so one always does.

    A block of documents sends its columns packed, by range of their digests. Of each range the
    columns that several sets have go back to their block.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    own = [c for c in OWN if c in docs.columns]
    fields = f"{''.join(f'{c}: long, ' for c in own)}doc_id: {kind}, digest: binary, size: long, place: int"
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(*own, "doc_id", "text")
    copies = spark.sparkContext.broadcast(_copies(read, ws))

    def single(block: int, texts: list[str | None]) -> np.ndarray:
        """Whether each document sends its columns, or another one with the same words does."""
        content, bits = copies.value.get(block, (0, b""))
        copied = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(texts)).astype(bool)
        return ~copied if bits and content == _content(texts) else np.ones(len(texts), bool)

    def work(batch: list[dict]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        for chunk in common.chunks(batch):
            texts = [r["text"] for r in chunk]
            sets = shingle_sets(texts, join.n)
            digests = [set_digest(s) if len(s) else None for s in sets]
            number = next(numbers)
            block = (part << 32) + number
            sent_by = single(block, texts).tolist()
            different = {d: s for d, s, own_set in zip(digests, sets, sent_by, strict=True) if d and own_set}
            places = {d: i for i, d in enumerate(different)}
            yield block, (part + number) % ranges, 0, None, [
                {**{c: r[c] for c in own}, "doc_id": r["doc_id"], "digest": d, "size": len(s), "place": places.get(d)}
                for r, d, s in zip(chunk, digests, sets, strict=True)
            ]
            if not different:
                continue
            s = np.concatenate(list(different.values())).view(np.uint64)
            place = np.repeat(np.arange(len(different)), [len(x) for x in different.values()])
            order = np.argsort(s, kind="stable")
            s, place = s[order], place[order]
            at = ((s >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(s)]
            for lo, hi in zip(cuts, cuts[1:]):
                yield block, int(at[lo]), hi - lo, _packed(s[lo:hi], place[lo:hi]), None

    numbers = iter(range(1 << 32))
    sent = f"block long, range long, n long, packed array<binary>, docs array<struct<{fields}>>"
    blocks = common.map_rows(read, sent, work, rows=64)
    schema = to_arrow_schema(StructType.fromDDL(sent))

    def several(table: pa.Table) -> pa.Table:
        """The columns of a range that several sets have, with their number; and the documents."""
        table = table.select(schema.names).cast(schema)
        told, table = (table.filter(f(table.column("packed"))) for f in (pc.is_null, pc.is_valid))
        if not len(table):
            return told
        s, place, owner = _joined(table)
        order = np.argsort(s, kind="stable")
        s, place, owner = s[order], place[order], owner[order]
        run = np.cumsum(np.concatenate([[True], s[1:] != s[:-1]])) - 1
        often = np.bincount(run)[run]
        kept = np.flatnonzero(often > 1)
        kept = kept[np.argsort(owner[kept], kind="stable")]
        s, place, owner, often = s[kept], place[kept], owner[kept], often[kept]
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(owner) > 0, [True]])) if len(s) else np.zeros(1, int)
        spans = list(zip(cuts.tolist(), cuts[1:].tolist()))
        blocks, at = (table.column(c).to_numpy()[owner[cuts[:-1]]] for c in ("block", "range"))
        packed = [_packed(s[lo:hi], place[lo:hi], often[lo:hi]) for lo, hi in spans]
        back = [blocks, at, np.diff(cuts), packed, [None] * len(spans)]
        return pa.concat_tables([told, pa.table([pa.array(c, f.type) for c, f in zip(back, schema)], schema=schema)])

    found = blocks.groupBy("range").applyInArrow(several, sent)
    given = f"{''.join(f'{c} long, ' for c in own)}doc_id {kind}, digest binary, vid long, size long, given array<long>"
    target = to_arrow_schema(StructType.fromDDL(given))

    def lists(table: pa.Table) -> pa.Table:
        """The documents of a block with their repeated columns."""
        known = table.column("docs").combine_chunks().drop_null().flatten()
        names = [known.type.field(i).name for i in range(known.type.num_fields)]
        about = dict(zip(names, known.flatten(), strict=True))
        table = table.filter(pc.is_valid(table.column("packed")))
        places = pc.fill_null(about["place"], -1).to_numpy()
        size = about["size"].to_numpy()
        columns: list[np.ndarray | None] = [None] * len(places)
        if len(table):
            s, place, often, _ = _joined(table)
            order = np.lexsort((s, often, place))
            s, place = s[order].view(np.int64), place[order]
            first = np.flatnonzero(places >= 0)
            first = first[np.unique(places[first], return_index=True)[1]]
            lo, hi = (np.searchsorted(place, places[first], side) for side in ("left", "right"))
            for i, start, end in zip(first.tolist(), lo.tolist(), hi.tolist(), strict=True):
                if end - start >= join.least(int(size[i])):
                    columns[i] = s[start:end]
        digest = about["digest"]
        vids = [short_id(d) if d else None for d in digest.to_pylist()]
        more = {"vid": vids, "given": columns}
        return pa.table(
            [pa.array(more[f.name], f.type) if f.name in more else about[f.name].cast(f.type) for f in target],
            schema=target,
        )

    return found.groupBy("block").applyInArrow(lists, given)


# --- pairs --------------------------------------------------------------------------------------


def _head_pairs(rows: DataFrame, join: Join) -> DataFrame:
    """Each row with the least row that shares several of their first columns by digest."""
    heads = rows.select("vid", "size", F.explode(F.slice(F.array_sort("given"), 1, join.head)).alias("s"))
    # Short rows have few first columns; a third of these must be shared.
    enough = F.greatest(F.lit(1), F.floor(F.least(F.lit(join.head), F.col("size")) * 0.4))
    heads = heads.select("s", "vid", "size", enough.cast("int").alias("enough"))
    least = heads.groupBy("s").agg(
        F.min("vid").alias("hub"), F.min_by("size", "vid").alias("hub_size"), F.count("*").alias("n")
    ).where("n > 1")
    met = heads.join(least, "s").where("vid != hub")
    lo, hi = F.least("size", "hub_size"), F.greatest("size", "hub_size")
    return (
        met.where(100 * lo >= join.percent * hi)
        .groupBy("hub", "vid", "enough")
        .agg(F.count("*").alias("shared"))
        .where("shared >= enough")
        .select(F.col("hub").alias("a"), F.col("vid").alias("b"))
    )


def _columns(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Sorted records in parts that do not cut a column, with the first place of each and the end."""
    held: list[np.ndarray] | None = None
    for batch in source:
        part = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            part = [np.concatenate(x) for x in zip(held, part, strict=True)]
        if not len(part[0]):
            continue
        starts = np.flatnonzero(np.concatenate([[True], part[0][1:] != part[0][:-1]]))
        yield [x[: starts[-1]] for x in part], starts
        held = [x[starts[-1] :] for x in part]
    if held is not None:
        yield held, np.array([0, len(held[0])])


def _close(part: list[np.ndarray], starts: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """The pairs of rows of one column that may link, over all columns of a part at once: each row
    with the first, second, ... row after it by size, as long as any is left that is not too large."""
    mixed = np.minimum.reduceat(part[2], starts[:-1]) != np.maximum.reduceat(part[2], starts[:-1])
    column = np.repeat(np.arange(len(mixed)), np.diff(starts))
    order = np.lexsort((part[3], column))
    order = order[mixed[column[order]]]
    column, (vids, comps, sizes, left) = column[order], (x[order] for x in part[1:])
    end = np.searchsorted(column, column, "right")
    # What both rows need, 75 (a + b) / 175 at 75 percent, bounds the larger row by the smaller one.
    largest = np.minimum(100 * sizes // percent, (100 + percent) * left // percent - sizes)
    i, after = np.arange(len(vids)), 0
    while len(i):
        after += 1
        i = i[i + after < end[i]]
        i = i[sizes[i + after] <= largest[i]]
        j = i + after
        kept = (comps[i] != comps[j]) & ((100 + percent) * left[j] >= percent * (sizes[i] + sizes[j]))
        yield _ends(vids[i[kept]], vids[j[kept]])


def _ends(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), [("a", np.int64), ("b", np.int64)])
    out["a"], out["b"] = np.minimum(x, y), np.maximum(x, y)
    return out


def _product(rows: DataFrame, join: Join, stars: int = 0) -> DataFrame:
    """Pairs ``a`` < ``b`` of different components that could link, of rows ``vid``, ``comp``, ``size``
    and ``given``.

    A pair that links has a first common column, and there both rows still have as many columns as
    their sizes ask for. Pairs are made of such places only. With ``stars``, only of columns with more
    than ``hot`` rows, and each row there meets so many rows of the largest component and one other.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def met(part: list[np.ndarray]) -> Iterator[np.ndarray]:
        """The pairs of a column's rows with a few of them that may link."""
        _, vids, comps, sizes, left = part
        if (comps == comps[0]).all():
            return
        order = np.argsort(sizes, kind="stable")
        vids, comps, sizes, left = vids[order], comps[order], sizes[order], left[order]

        def may(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            needed = -(-join.percent * (sizes[i] + sizes[j]) // (100 + join.percent))
            near = (100 * sizes[i] >= join.percent * sizes[j]) & (comps[i] != comps[j])
            return near & (np.minimum(left[i], left[j]) >= needed)

        groups, at, counts = np.unique(comps, return_inverse=True, return_counts=True)
        bulk = np.flatnonzero(at == np.argmax(counts))
        every = np.arange(len(vids))
        spread = bulk[(2 * np.arange(stars) + 1) * len(bulk) // (2 * stars)]
        for centre in {*spread.tolist(), len(every) // 2}:
            i, j = np.minimum(every, centre), np.maximum(every, centre)
            kept = may(i, j)
            yield _ends(vids[i[kept]], vids[j[kept]])

    def of_part(part: list[np.ndarray], starts: np.ndarray) -> Iterator[np.ndarray]:
        if not len(part[0]):
            return
        if not stars:
            yield from _close(part, starts, join.percent)
            return
        for k in np.flatnonzero(np.diff(starts) > join.hot).tolist():
            yield from met([x[starts[k] : starts[k + 1]] for x in part])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                pairs = np.unique(np.concatenate(held))
                yield from pa.table([pa.array(pairs[c]) for c in "ab"], schema=schema).to_batches(100_000)
                held.clear()

        for part, starts in _columns(source):
            for pairs in of_part(part, starts):
                if len(pairs):
                    held.append(pairs)
                    total += len(pairs)
                if total > 500_000:
                    yield from flush()
                    total = 0
        yield from flush()

    common.ship(rows.sparkSession)
    found = F.size("given")
    first = F.slice("given", F.lit(1), (found - F.ceil(join.percent * F.col("size") / 100) + 1).cast("int"))
    records = rows.select("vid", "comp", "size", found.alias("found"), F.posexplode(first).alias("at", "s"))
    records = records.select("s", "vid", "comp", "size", (F.col("found") - F.col("at")).cast("long").alias("left"))
    dealt = records.repartition("s").sortWithinPartitions("s")
    return dealt.mapInArrow(batches, "a long, b long").distinct()


def _compared(pairs: DataFrame, rows: DataFrame, join: Join, ws: common.Workspace, name: str) -> DataFrame:
    """The links among ``pairs`` of row ids, as pairs of set digests, from all repeated columns."""
    of = lambda x: rows.select(
        F.col("vid").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("digest", "size", "given"))
    )
    met = ws.store(pairs, f"{name}-pairs").join(of("b"), "b").join(of("a"), "a")
    shared = F.size(F.array_intersect("given_a", "given_b"))
    link = 100 * shared >= join.percent * (F.col("size_a") + F.col("size_b") - shared)
    links = met.where(link).select(F.col("digest_a").alias("a"), F.col("digest_b").alias("b"))
    return ws.store(links.where("a != b").distinct(), f"{name}-links")


# --- the join -----------------------------------------------------------------------------------


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with their component as a number."""
    joined = rows.join(components(links), F.col("digest") == F.col("vertex"), "left")
    comp = F.xxhash64(F.coalesce("component", "digest")).alias("comp")
    return joined.select("vid", comp, "size", "given")


def similarity_components(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row."""
    placed = _placed(docs.select("doc_id", "text"), join)
    least = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "component", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _placed(docs: DataFrame, join: Join) -> DataFrame:
    """``doc_id``, ``size`` and ``component``, NULL for empty sets, of every row, and its
    columns ``OWN``."""
    own = [c for c in OWN if c in docs.columns]
    ws = common.Workspace(docs.sparkSession, "ngram-join")
    sets = ws.store(_rows(docs, join, ws), "sets")
    rows = sets.where("given is not null").dropDuplicates(["digest"])
    rows = ws.store(rows.select("vid", "digest", "size", "given"), "rows")
    placed = ws.store(sets.select(*own, "doc_id", "size", "digest"), "placed")
    ws.drop("sets")
    links = _compared(_head_pairs(rows, join), rows, join, ws, "head")
    for name, stars in (("star", 1), ("stars", join.head), ("product", 0)):
        pairs = _product(_labelled(rows, links), join, stars)
        links = links.unionByName(_compared(pairs, rows, join, ws, name))

    found = components(links)
    placed = placed.join(found, F.col("digest") == F.col("vertex"), "left").select(
        *own, "doc_id", "size", F.coalesce("component", "digest").alias("component")
    )
    placed = ws.store(placed, "labelled")
    steps = [f"{step}-{what}" for step in ("head", "star", "stars", "product") for what in ("pairs", "links")]
    ws.drop("rows", "placed", *steps)
    return placed


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The whole rows of the documents that rank first in their component, and of those without
    one, in the input's columns. NULL ``doc_id`` ranks last; rows repeated with their ``doc_id`` rank
    in the order in which they were read. ``docs`` is read four times and must give the same rows,
    in any order; they are known again by 128 bits of all their columns."""
    told = [c for name in docs.columns for c in (F.col(name), F.col(name).isNull())]
    keys = ["key_a", "key_b"]
    keyed = docs.withColumns({k: F.xxhash64(F.lit(k), *told) for k in keys})
    row_id = F.monotonically_increasing_id().alias("row_id")
    placed = _placed(keyed.select(row_id, *keys, "doc_id", "text"), join)
    filled = placed.where("component is not null")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    least = filled.groupBy("component").agg(F.min(rank).alias("first"))
    gone = filled.join(least, "component").where("row_id != first.row_id").select(*keys, "component")
    # Rows equal in all columns go together, so of a first row's equals one has to come back.
    first = filled.join(least, "component").where("row_id = first.row_id").select(*keys, "component")
    equal = first.join(gone, [*keys, "component"], "left_semi").select(*keys).distinct()
    left = keyed.join(gone.select(*keys).distinct(), keys, "left_anti")
    back = keyed.join(equal, keys, "left_semi").dropDuplicates(keys)
    return left.unionByName(back).select(*docs.columns)
