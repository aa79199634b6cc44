"""Substring deduplication by line or paragraph hashing.

Texts are cut into units, lines or paragraphs, and units into pieces: of the joints between two
words, those go that hash lowest among their ``REACH`` neighbours on either side within the unit, so
equal runs of words are cut alike wherever they stand (about every seven words). Words are normalised
(white space to one blank, A-Z to lower case) and hashed. Digests of pieces that are a whole unit, and
of pairs of neighbouring pieces, are grouped over all documents; of equal ones the one that ranks
first, by ``doc_id`` and place in its text, is kept. A unit of several pieces is repeated if all pairs
in it are. Digests have 64 bits.

A repeated unit of ``min_words`` words or more goes by itself. Shorter ones, such as headings and
dialogue, repeat without being copies, so they go in company only: if those of a run of repeated
units have ``min_words`` words together, or if they belong to a repeated passage of
``passage_words`` words or more. A passage is a run in which each two neighbours are neighbours in
an earlier place too. A passage that begins or ends inside a unit takes that part of the unit with
it, if its whole pieces have ``min_words`` words, and the units between two such parts. Blank units
neither end a run nor go. The first place of a unit always stays.

Defined cases: a NULL text has no units; NULL ``doc_id`` ranks last; rows repeated with their
``doc_id`` rank in the order in which they were read, so one of them keeps its units; a text that
loses all units becomes empty; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Joints on either side with which one is compared.
REACH = 3
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BORDERS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n(?:[\x20\x09-\x0D]*\n)+")}


def units(text: str | None, border: re.Pattern[str]) -> Iterator[tuple[int, int]]:
    """Start and end of each unit, borders left out."""
    at = 0
    for found in border.finditer(text or ""):
        yield at, found.start()
        at = found.end()
    if text:
        yield at, len(text)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less its removed spans, each with the line break after it, or before the last. The
    break after a line that keeps its beginning stays."""
    kept, at = [], 0
    for start, end in sorted(spans):
        kept.append(text[at:start])
        whole = start == 0 or text[start - 1] == "\n"
        at = end + 1 if whole and text[end : end + 1] == "\n" else end
    kept.append(text[at:])
    joined = "".join(kept)
    lost_last = spans and max(e for _, e in spans) == len(text) and not text.endswith("\n")
    return joined[:-1] if lost_last and joined.endswith("\n") else joined


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Pieces:
    """Pieces of a text in order: its units that are not blank with the number of their first piece
    (and of all, last), words and digest of each piece."""

    units: list[tuple[int, int]]
    first: list[int]
    sizes: np.ndarray
    digests: np.ndarray

    def pairs(self) -> np.ndarray:
        """Digests of the pairs of neighbours."""
        return _mixed(self.digests[:-1] * MULTIPLIER + self.digests[1:])

    def alone(self) -> np.ndarray:
        """Numbers of the pieces that are a whole unit."""
        first = np.array(self.first)
        return first[:-1][np.diff(first) == 1]


def pieces(text: str | None, border: re.Pattern[str], known: dict[bytes, int]) -> Pieces:
    """``known`` keeps the digests of words from text to text."""
    placed, ids, begins = [], [], []
    for start, end in units(text, border):
        words = common.split_words(text[start:end])
        if words:
            placed.append((start, end))
            begins.append(len(ids))
            for word in words:
                digest = known.get(word)
                if digest is None:
                    if len(known) > 200_000:
                        known.clear()
                    digest = known[word] = xxhash.xxh3_64_intdigest(word.lower())
                ids.append(digest)
    if not ids:
        return Pieces([], [0], np.zeros(0, np.int64), np.zeros(0, np.uint64))
    ids = np.array(ids, np.uint64)
    new = np.zeros(len(ids), bool)
    new[begins] = True
    of = np.cumsum(new)
    # The joint before each word; there is none before the first word of a unit.
    joint = np.full(len(ids), np.iinfo(np.uint64).max, np.uint64)
    joint[1:] = _mixed(ids[:-1] * MULTIPLIER + ids[1:])
    joint[new] = np.iinfo(np.uint64).max
    low = ~new
    for d in range(1, REACH + 1):
        near = of[d:] == of[:-d]
        low[d:] &= ~near | (joint[d:] < joint[:-d])
        low[:-d] &= ~near | (joint[:-d] <= joint[d:])
    starts = np.flatnonzero(new | low)
    sizes = np.diff(np.append(starts, len(ids)))
    within = (np.arange(len(ids)) - np.repeat(starts, sizes)).astype(np.uint64)
    digests = np.add.reduceat(_mixed(ids + within * MULTIPLIER), starts)
    first = np.searchsorted(starts, np.append(begins, len(ids)))
    return Pieces(placed, first.tolist(), sizes, _mixed(digests))


def find(docs: DataFrame, unit: str = "line") -> DataFrame:
    """A row per repeated piece that is a whole unit, and per repeated pair of neighbouring pieces:
    its place, and that of the first.

    ``row_id``, ``doc_id``, ``pair``, ``unit``, ``kept`` (whether it is the first itself),
    ``keep_id``, ``keep_unit``, ``copies``. The pieces of a text are numbered from 0 in ``unit``; a
    pair has the number of its earlier piece. ``docs`` has ``row_id``, ``doc_id`` and ``text``.
    """
    border = BORDERS[unit]
    types = dict(docs.dtypes)
    names = ["row_id", "doc_id", "pair", "unit", "digest"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in source:
            held: list[tuple[np.ndarray, ...]] = []

            def flush() -> pa.RecordBatch:
                owner, pair, number, digest = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                owner = pa.array(owner)
                columns = [batch.column("row_id").take(owner), batch.column("doc_id").take(owner)]
                columns += [pa.array(pair), pa.array(number.astype(np.int32)), pa.array(digest.view(np.int64))]
                return pa.RecordBatch.from_arrays(columns, names=names)

            count = 0
            for at, text in enumerate(batch.column("text").to_pylist()):
                cut = pieces(text, border, known)
                if not len(cut.digests):
                    continue
                both, alone = cut.pairs(), cut.alone()
                n = len(both) + len(alone)
                held.append((
                    np.full(n, at), np.arange(n) < len(both), np.concatenate([np.arange(len(both)), alone]),
                    np.concatenate([both, cut.digests[alone]]),
                ))
                count += n
                if count > 200_000:
                    yield flush()
                    count = 0
            if held:
                yield flush()

    common.ship(docs.sparkSession)
    schema = f"row_id long, doc_id {types['doc_id']}, pair boolean, unit int, digest long"
    found = docs.select("row_id", "doc_id", "text").mapInArrow(batches, schema)
    ws = common.Workspace(docs.sparkSession, "units")
    found = ws.store(found, "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id", "unit")
    # Most pairs differ, so combining before the exchange would only sort them twice.
    found = found.repartition("digest", "pair")
    firsts = found.groupBy("digest", "pair").agg(
        F.count("*").alias("copies"), F.min(rank).alias("first")
    ).where("copies > 1")
    same = (F.col("row_id") == F.col("first.row_id")) & (F.col("unit") == F.col("first.unit"))
    return found.join(firsts, ["digest", "pair"]).select(
        "row_id", "doc_id", "pair", "unit", same.alias("kept"),
        F.col("first.doc_id").alias("keep_id"), F.col("first.unit").alias("keep_unit"), "copies",
    )


def chosen(
    sizes: list[int], repeated: set[int], pairs: set[int], min_words: int, passage_words: int
) -> list[int]:
    """Numbers of the repeated units that go, by the words of all units."""
    gone = {u for u in repeated if sizes[u] >= min_words}
    for run in runs(sorted(repeated), repeated):
        short = [u for u in run if sizes[u] < min_words]
        if sum(sizes[u] for u in short) >= min_words:
            gone.update(short)
    for run in runs(sorted(repeated), pairs):
        if sum(sizes[u] for u in run) >= passage_words:
            gone.update(run)
    return sorted(gone)


def removed_pieces(
    cut: Pieces, alone: set[int], pairs: set[int], min_words: int, passage_words: int
) -> list[tuple[int, int, int]]:
    """Unit, first and end of the pieces that go, by the numbers of the repeated pieces and pairs."""
    bounds = list(zip(cut.first, cut.first[1:], strict=False))
    sizes = [int(cut.sizes[lo:hi].sum()) for lo, hi in bounds]
    repeated = {
        u for u, (lo, hi) in enumerate(bounds)
        if (lo in alone if hi - lo == 1 else all(k in pairs for k in range(lo, hi - 1)))
    }
    linked = {u for u, (_, hi) in enumerate(bounds) if hi - 1 in pairs}
    gone = set(chosen(sizes, repeated, linked, min_words, passage_words))
    of = np.repeat(np.arange(len(bounds)), np.diff(cut.first))
    parts: dict[int, list[tuple[int, int]]] = {}
    for run in runs(sorted(pairs | {k + 1 for k in pairs}), pairs):
        if sum(int(cut.sizes[k]) for k in run) < min_words:
            continue
        about = range(of[run[0]], of[run[-1]] + 1)
        partly = [u for u in about if u not in repeated]
        for u in partly:
            lo, hi = bounds[u]
            parts.setdefault(u, []).append((max(lo, run[0]), min(hi, run[-1] + 1)))
        if len(partly) > 1:
            gone.update(range(partly[0] + 1, partly[-1]))
    spans = [(u, *bounds[u]) for u in gone - parts.keys()]
    return sorted(spans + [(u, *part) for u, found in parts.items() for part in found])


def runs(numbers: list[int], linked: set[int]) -> Iterator[list[int]]:
    """Numbers in order, cut wherever one is not the next after one of ``linked``."""
    run: list[int] = []
    for number in numbers:
        if run and not (number == run[-1] + 1 and run[-1] in linked):
            yield run
            run = []
        run.append(number)
    if run:
        yield run


def _span(text: str, cut: Pieces, unit: int, lo: int, hi: int) -> tuple[int, int]:
    """Start and end in the text of the pieces ``lo`` to ``hi`` of a unit, all of it if they are all."""
    start, end = cut.units[unit]
    first, last = cut.first[unit], cut.first[unit + 1]
    if (lo, hi) == (first, last):
        return start, end
    words = [m.span() for m in WORD.finditer(text, start, end)]
    before = int(cut.sizes[first:lo].sum())
    return words[before][0], words[before + int(cut.sizes[lo:hi].sum()) - 1][1]


def remove(
    docs: DataFrame, unit: str = "line", min_words: int = 20, passage_words: int = 50
) -> DataFrame:
    """``doc_id``, ``n_removed`` units and parts of units, their ``removed`` spans in the original text with the
    ``doc_id`` that keeps each, and the ``clean_text``, for every row."""
    ws = common.Workspace(docs.sparkSession, "lines")
    rows = ws.store(
        docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text"), "rows"
    )
    border = BORDERS[unit]
    place = F.struct("unit", "keep_id")
    later = find(rows, unit).where("not kept").groupBy("row_id").agg(
        F.collect_list(F.when(~F.col("pair"), place)).alias("repeated"),
        F.collect_list(F.when(F.col("pair"), place)).alias("pairs"),
    )
    types = dict(rows.dtypes)

    def work(batch: list[dict]) -> Iterator[tuple]:
        known: dict[bytes, int] = {}
        for row in batch:
            text, removed = row["text"], []
            if row["repeated"] or row["pairs"]:
                cut = pieces(text, border, known)
                alone, pairs = ({u["unit"]: u["keep_id"] for u in row[c]} for c in ("repeated", "pairs"))
                for u, lo, hi in removed_pieces(cut, set(alone), set(pairs), min_words, passage_words):
                    # The pair within the part, or over its end or beginning, or the unit itself.
                    keeper = next(
                        found[k] for found, k in ((alone, lo), (pairs, lo), (pairs, lo - 1)) if k in found
                    )
                    removed.append((*_span(text, cut, u, lo, hi), keeper))
            clean = text and without(text, [r[:2] for r in removed])
            yield (row["doc_id"], len(removed), removed, clean)

    kind = types["doc_id"]
    schema = (
        f"doc_id {kind}, n_removed int, "
        f"removed array<struct<start: int, end: int, keep_id: {kind}>>, clean_text string"
    )
    joined = rows.join(later, "row_id", "left").select("doc_id", "text", "repeated", "pairs")
    return common.map_rows(joined, schema, work, rows=2000)
