"""Line deduplication by winnowing over line hashes.

The non-blank lines of a text are normalised and hashed. Its windows are the shortest runs of whole
lines with ``min_words`` words or more that start at a line, and those that end at one. Every window
has its smallest line hash as fingerprint, so windows that two texts share have a common one.
Windows whose fingerprint occurs nowhere else are left there. The others are joined, by a digest of
all their lines, with the first place of equal lines anywhere, by ``doc_id`` and line, and the lines
of later windows are deleted.

So exactly the lines go that lie in a run of ``min_words`` words or more that an earlier place has as
well: of any such run, one line or many, each line is in the window that starts at it or in the one
that ends the run. As a window meets only its first place, the join has one row per window however
many texts hold it. A run that continues past the text of that first place is covered by its further
windows, which have first places of their own.

Defined cases: a NULL or blank text has no lines; a passage repeated within one text is deleted at
its later place; NULL ``doc_id`` ranks last; rows repeated with their ``doc_id`` rank in the order
in which they were read; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common
from shotmarts.llm.repeated_lines import without


def line_digests(text: str | None) -> tuple[list[bytes], list[int], list[tuple[int, int]]]:
    """Digests, words and spans of the non-blank lines."""
    digests, sizes, spans, at = [], [], [], 0
    for line in (text or "").split("\n"):
        words = common.split_words(line)
        if words:
            digests.append(xxhash.xxh3_128_digest(b" ".join(words).lower()))
            sizes.append(len(words))
            spans.append((at, at + len(line)))
        at += len(line) + 1
    return digests, sizes, spans


def smallest(hashes: list[int], first: int, end: int) -> int:
    """Place of the smallest hash of a window, the last of equal ones."""
    part = hashes[first:end]
    return end - 1 - part[::-1].index(min(part))


def winnow(lines: list[int], gram: int, window: int) -> Iterator[tuple[int, int]]:
    """Fingerprints over windows of a fixed number of runs of ``gram`` lines: hash and first line.
    ``windows`` has those measured in words."""
    n = len(lines) - gram + 1
    if n < 1:
        return
    raw = np.array(lines, np.int64)
    grams = [xxhash.xxh3_64_intdigest(raw[i : i + gram].tobytes()) - (1 << 63) for i in range(n)]
    last = -1
    for at in range(max(1, n - window + 1)):
        least = smallest(grams, at, min(at + window, n))
        if least != last:
            yield grams[least], least
            last = least


def windows(sizes: list[int], min_words: int) -> list[tuple[int, int]]:
    """First line and end of the shortest runs with ``min_words`` words from each line on, and of
    the shortest up to each line."""
    found, first, held = set(), 0, 0
    for end, size in enumerate(sizes, 1):
        held += size
        # The run from ``first`` on has the words only now, so this is its shortest end.
        while first < end and held >= min_words:
            found.add((first, end))
            held -= sizes[first]
            first += 1
    last, held = len(sizes), 0
    for first in range(len(sizes) - 1, -1, -1):
        held += sizes[first]
        while last > first and held >= min_words:
            found.add((first, last))
            last -= 1
            held -= sizes[last]
    return sorted(found)


def remove(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """``doc_id``, the number and spans of the ``removed`` runs with the ``doc_id`` each repeats, and
    the ``clean_text``, for every row. Repeats below ``min_words`` words stay."""
    ws = common.Workspace(docs.sparkSession, "winnowing")
    types = dict(docs.dtypes)
    kind = types["doc_id"]
    rows = ws.store(
        docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text"), "rows"
    )

    def prints(batch: list[dict]) -> Iterator[tuple]:
        for row in batch:
            digests, sizes, _ = line_digests(row["text"])
            hashes = [int.from_bytes(d[:8], "big", signed=True) for d in digests]
            held: dict[int, list[tuple]] = {}
            for first, end in windows(sizes, min_words):
                digest = xxhash.xxh3_128_digest(b"".join(digests[first:end]))
                held.setdefault(smallest(hashes, first, end), []).append((digest, first, end))
            for at, found in held.items():
                yield (row["row_id"], row["doc_id"], hashes[at], found)

    schema = (
        f"row_id long, doc_id {kind}, h long, windows array<struct<digest: binary, at: int, end: int>>"
    )
    marks = ws.store(common.map_rows(rows, schema, prints), "prints")
    again = marks.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    # Few windows are left from here on.
    found = marks.join(again, "h", "left_semi").select("row_id", "doc_id", F.explode("windows").alias("w"))
    found = ws.store(found.select("row_id", "doc_id", "w.digest", "w.at", "w.end"), "windows")
    ws.drop("prints")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id", "at")
    firsts = found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = found.join(firsts, "digest").where("row_id != first.row_id or at != first.at").select(
        "row_id", "at", "end", F.col("first.row_id").alias("there_id"),
        F.col("first.at").alias("there"), F.col("first.doc_id").alias("keep_id"),
    )
    per_row = later.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "end", "there_id", "there", "keep_id"))).alias("runs")
    )

    def cleaned(batch: list[dict]) -> Iterator[tuple]:
        for row in batch:
            text = row["text"]
            spans = line_digests(text)[2] if row["runs"] else []
            gone: list[list] = []
            upto, along = 0, None
            for run in row["runs"] or []:
                # Windows that go on along the same earlier text are one run.
                same = (run["there_id"], run["there"] - run["at"])
                first, end = max(run["at"], upto), run["end"]
                if first >= end:
                    continue
                if same == along and run["at"] <= upto:
                    gone[-1][1] = spans[end - 1][1]
                else:
                    gone.append([spans[first][0], spans[end - 1][1], run["keep_id"]])
                upto, along = end, same
            clean = text and without(text, [(g[0], g[1]) for g in gone])
            yield (row["doc_id"], len(gone), [tuple(g) for g in gone], clean)

    out = (
        f"doc_id {kind}, n_removed int, "
        f"removed array<struct<start: int, end: int, keep_id: {kind}>>, clean_text string"
    )
    joined = rows.join(per_row, "row_id", "left").select("doc_id", "text", "runs")
    return common.map_rows(joined, out, cleaned, rows=2000)
