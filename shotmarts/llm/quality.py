"""Quality rules with cross-document line frequency.

Normalised lines are hashed and the distinct documents that hold them are counted per host. Lines
above the limit are removed, and documents left with too little are rejected, as are those that
fail the base rules on their own text.

Equal texts count as one document, else a good text that was crawled often would make all its own
lines look like boilerplate. A line is above the limit when more than ``min_docs`` distinct texts
of its host hold it and they are more than ``max_share`` of the host's distinct texts.

Defined cases: a NULL text has no words and fails the base rules; a NULL host is a host of its own;
repeated rows are judged alike; blank lines are neither counted nor removed; an empty table gives
an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shotmarts.llm import common

BASE_SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "text_hash long, h long, words int"
)
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 20
    max_share: float = 0.01
    #: A document is depleted when less than this share of its words is left.
    min_left: float = 0.2


def normal_line(words: list[bytes]) -> bytes:
    return b" ".join(words).lower()


def repeat_words(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur twice or more in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    grams = ids[:n]
    for k in range(1, size):  # pairs of small numbers are numbered anew, so nothing can collide
        _, grams = np.unique(grams * len(number) + ids[k : n + k], return_inverse=True)
    often = (np.bincount(grams) > 1)[grams]
    covered = np.zeros(len(words), bool)
    for k in range(size):
        covered[k : n + k] |= often
    return int(covered.sum())


def base_row(text: str | None) -> tuple:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    repeated, lines = 0, []
    for line in raw.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        repeated += line in seen
        seen.add(line)
        lines.append((xxhash.xxh3_64_intdigest(normal_line(parts)) - (1 << 63), len(parts)))
    spaces = len(raw) - len(raw.translate(None, common.SPACES))
    return (
        len(words),
        len(text or "") - spaces,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        repeated,
        repeat_words(words),
        xxhash.xxh3_64_intdigest(raw) - (1 << 63),
        lines,
    )


def _base(rows: list[dict]) -> Iterator[tuple]:
    """Flat rows: one per document (``h`` NULL) with its counts, then one per line with a word
    (counts NULL) with the line's hash and words."""
    for row in rows:
        *counts, text_hash, lines = base_row(row["text"])
        key = (row["id"], row["doc_id"], row["host"])
        yield (*key, *counts, text_hash, None, None)
        for h, words in lines:
            yield (*key, None, None, None, None, None, text_hash, h, words)


def judge(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """One row per document: ``row_id``, ``doc_id``, the base counts, ``n_removed_lines``,
    ``n_left_words``, ``base_failed``, ``kept``. ``docs`` may bring a ``row_id`` of its own.
    """
    spark = docs.sparkSession
    ws = common.Workspace(spark, "quality")
    own = F.col("row_id") if "row_id" in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(own.alias("id"), "doc_id", F.col(host).alias("host"), "text")
    types = dict(rows.dtypes)
    schema = f"id long, doc_id {types['doc_id']}, host {types['host']}, {BASE_SCHEMA}"
    flat = ws.store(common.map_rows(rows, schema, _base, rows=2_000), "flat")
    base = flat.where(F.col("h").isNull())
    lines = flat.where(F.col("h").isNotNull()).select("id", "host", "text_hash", "h", "words")

    per_host = base.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("n_texts"))
    held = lines.select("host", "text_hash", "h").distinct()
    counts = held.groupBy("host", "h").agg(F.count("*").alias("n")).where(
        F.col("n") > rules.min_docs
    )
    frequent = counts.alias("c").join(per_host.alias("p"), F.expr("c.host <=> p.host")).where(
        F.col("n") > rules.max_share * F.col("n_texts")
    ).select(F.col("c.host").alias("host"), "h")

    removed = lines.alias("l").join(
        frequent.alias("f"), F.expr("l.h = f.h and l.host <=> f.host")
    ).groupBy("l.id").agg(
        F.count("*").alias("n_removed_lines"), F.sum("l.words").alias("removed_words")
    )
    none = F.lit(0).cast("long")
    judged = base.drop("host", "text_hash", "h", "words").join(removed, "id", "left")
    left = F.col("n_words") - F.coalesce("removed_words", none)
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    return judged.select(
        F.col("id").alias("row_id"), "doc_id", "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words",
        F.coalesce("n_removed_lines", none).alias("n_removed_lines"),
        left.alias("n_left_words"),
        failed.alias("base_failed"),
        (~failed & (left >= rules.min_left * F.col("n_words"))).alias("kept"),
    )


def keep_good(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The whole rows of the documents that are not rejected, in the input's columns."""
    ws = common.Workspace(docs.sparkSession, "good")
    row_id = F.monotonically_increasing_id().alias("row_id")
    stored = ws.store(docs.select(row_id, F.struct(*docs.columns).alias("row")), "rows")
    judged = judge(stored.select("row_id", "row.doc_id", "row.text", f"row.{host}"), host, rules)
    return stored.join(judged.where("kept"), "row_id", "left_semi").select("row.*")
