"""Exact substring dedup: bytes covered by a repeated string of ``length`` bytes are removed.

Texts are UTF-8 bytes (NULL: empty); matches never cross documents. A byte is removed when it lies in
a ``length``-byte string (a window) that also starts anywhere else, in the same document or another.
Windows are judged on the input, so overlapping repeated windows all count.

How repeats are found (the method, a distributed suffix sort cut at ``length`` bytes):

0. Distinct texts. Texts are keyed by SHA-256 and dealt into buckets by it; of copies one per task
   travels. Every window of a text with a copy starts elsewhere, so such texts lose all bytes. Texts
   below ``length`` bytes have no window and stay where they are.
1. Anchors. Winnowing gives each window the least of its ``k``-byte grams as its anchor, so equal
   windows have it at the same place. An anchor has its windows in a row. A bucket sends its grams
   with their number, and those that occur twice or more in the table come back to it.
2. Stretches. Each occurrence of a repeated gram becomes one record: the bytes that the windows with
   this anchor cover, its text and place. Records with the same gram meet in one partition, sorted; of
   equal ones a bucket sends one with their number, as the others are known to repeat.
   Grams of more than ``hot`` occurrences are cut finer: runs of windows meet by the string that all
   windows of the run have in common.
3. Sort and compare. Windows can only equal windows of the same gram. Equal stretches repeat whole;
   the different ones of a gram are unfolded into the suffixes that start there, by fingerprint, which
   are sorted and compared with their neighbours.
4. Spans. Runs of repeated window starts go back to their bucket, are merged per text into maximal
   removed spans, and the remaining bytes are hashed.

The shuffle of the texts is one and the same in steps 1, 2 and 4 (Spark reuses it); no copy of them is
stored. Equality of unfolded windows is decided on their leading 8 bytes and 128 bits of fingerprint;
two different windows would have to agree in all of them. Long texts are cut into slices that overlap
by ``length - 1`` bytes, so no task holds more than one slice's arrays.

Odd rows: NULL or empty text: 0 bytes, nothing removed, the SHA-256 of nothing. Texts shorter than
``length`` have no window and keep all bytes. NULL ``doc_id``: a row like any other. Repeated rows: each copy's
windows start elsewhere, so every byte of a text of ``length`` bytes or more goes. Other columns of
the input are not read and not returned. Empty table: no rows. ``docs`` is read twice and must give
the same rows, in any order.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shotmarts.llm import common

#: Buckets of texts for each shuffle partition; a bucket is held by one task as a whole.
BUCKETS = 16
#: Suffixes that are unfolded and sorted at once, unless one place of one gram has more.
UNFOLDED = 2_000_000


def _constants(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers from the splitmix64 sequence."""
    out, x = [], seed
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        z = x
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        out.append((z ^ (z >> 31)) | 1)
    return np.array(out, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words8(b: np.ndarray) -> np.ndarray:
    """Little-endian 64-bit word of the 8 bytes from each place (n - 7 of them)."""
    n = len(b) - 7
    out = np.zeros(max(n, 0), np.uint64)
    for t in range(8):
        out |= b[t : t + n].astype(np.uint64) << np.uint64(8 * t)
    return out


def grams(w8: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k``-byte gram (``k`` a multiple of 8); equal grams, equal hashes."""
    parts = k // 8
    n = len(w8) - 8 * (parts - 1)
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = _constants(parts, 11)
    acc = np.zeros(n, np.uint64)
    for m in range(parts):
        acc += w8[8 * m : 8 * m + n] * c[m]
    return _mix(acc)


def window_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values (van Herk / Gil-Werman, linear)."""
    n = len(values) - w + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    blocks = -(-len(values) // w)
    padded = np.full(blocks * w, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    shaped = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(shaped, axis=1).reshape(-1)
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def owned(b: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(gram hash, place, first and last window start) of each anchor that winnowing picks: the least
    gram of the windows that start there.

    Ties go to the leftmost place, so two equal windows pick the same place relative to their start.
    """
    if len(b) < length:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    g = grams(words8(b), k)
    places = np.arange(len(g), dtype=np.uint64)
    keyed = ((g >> np.uint64(24)) << np.uint64(24)) | places  # slices stay below 2^24 bytes
    least = (window_min(keyed, length - k + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.append(first[1:], len(least)) - 1
    return g[least[first]], least[first], first, last


def fingerprints(b: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(leading 8 bytes as a big-endian long, two 64-bit fingerprints) of each window."""
    w8 = words8(b)
    parts = length // 8
    tail = length - 8 * parts
    c1, c2 = _constants(parts + 1, 21), _constants(parts + 1, 37)
    f1 = np.zeros(len(starts), np.uint64)
    f2 = np.zeros(len(starts), np.uint64)
    for m in range(parts):
        w = w8[starts + 8 * m]
        f1 += w * c1[m]
        f2 += _mix(w + c2[m]) * c2[m]
    if tail:
        w = w8[starts + length - 8] >> np.uint64(8 * (8 - tail))
        f1 += w * c1[parts]
        f2 += _mix(w + c2[parts]) * c2[parts]
    lead = w8[starts].byteswap().view(np.int64)
    return lead, _mix(f1).view(np.int64), _mix(f2 ^ np.uint64(0x5BD1E995)).view(np.int64)


def slices(n: int, length: int, most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of slices of at most ``most`` bytes overlapping by ``length - 1``: every window of
    ``length`` bytes lies whole in one of them."""
    start = 0
    while True:
        end = min(n, start + most)
        yield start, end
        if end >= n:
            return
        start = end - (length - 1)


# --- texts --------------------------------------------------------------------------------------


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def _key(t: Column) -> Column:
    return F.unhex(F.sha2(t, 256))


_TEXTS = "bucket int, key binary, t binary, more long"


def _texts(docs: DataFrame, length: int) -> DataFrame:
    """The distinct texts that have a window, once for each task that read them; rows without a text
    count the ``more`` copies a task has seen."""
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = docs.select(_text().alias("t")).where(F.octet_length("t") >= length)
    keyed = t.select(_key(F.col("t")).alias("key"), "t")
    dealt = keyed.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), "key", "t")
    schema = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("t", pa.binary()), ("more", pa.int64())])

    def firsts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}

        def copies() -> pa.RecordBatch:
            rows = [(bucket, key, None, more) for key, (bucket, more) in seen.items() if more]
            seen.clear()
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in source:
            new = []
            told = zip(batch.column("bucket").to_pylist(), batch.column("key").to_pylist(), strict=True)
            for i, (bucket, key) in enumerate(told):
                if key in seen:
                    seen[key][1] += 1
                else:
                    seen[key] = [bucket, 0]
                    new.append(i)
            columns = [batch.column(c).take(pa.array(new, pa.int64())).cast(schema.field(c).type) for c in ("bucket", "key", "t")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(len(new), np.int64))], schema=schema)
            if len(seen) > 200_000:
                yield copies()
        yield copies()

    return dealt.mapInArrow(firsts, _TEXTS)


def _distinct(bucket: pa.Table) -> list[tuple[bytes, bytes, int]]:
    """Key, text and number of copies of the distinct texts of a bucket, in order of their keys: a
    text has the same place whenever the bucket is read."""
    texts: dict[bytes, bytes] = {}
    copies: dict[bytes, int] = {}
    columns = (bucket.column(c).to_pylist() for c in ("key", "t", "more"))
    for key, t, more in zip(*columns, strict=True):
        copies[key] = copies.get(key, 0) + more + (t is not None)
        if t is not None:
            texts[key] = t
    return [(key, texts[key], copies[key]) for key in sorted(texts)]


# --- repeated windows ---------------------------------------------------------------------------


def _groups(source: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches sorted by ``h`` in parts that do not cut a group."""
    held: list[pa.RecordBatch] = []
    for batch in source:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        cut = int(np.searchsorted(h, h[-1]))
        if cut:
            yield [*held, batch.slice(0, cut)]
            held = []
        elif held and held[0].column("h")[0].as_py() != h[0]:
            yield held
            held = []
        held.append(batch.slice(cut))
    if held:
        yield held


def _repeated(h: np.ndarray, d: np.ndarray, stretches: list[bytes], length: int) -> np.ndarray:
    """Which windows of different stretches, one stretch after the other, equal one of another
    stretch (or place) of the same group. ``d``: how far the first window starts before its anchor."""
    count = np.fromiter(map(len, stretches), np.int64, len(stretches)) - length + 1
    begin = np.cumsum(count) - count
    marks = np.zeros(int(count.sum()), bool)
    _, group, size = np.unique(h, return_inverse=True, return_counts=True)
    some = np.flatnonzero(size[group] > 1)
    if not len(some):
        return marks
    flat = np.frombuffer(b"".join(stretches[i] for i in some.tolist()), np.uint8)
    at = np.cumsum(count[some] + length - 1) - (count[some] + length - 1)
    # Equal windows start equally far before their anchor: they are unfolded for some distances at once.
    far, near = d[some], d[some] - count[some] + 1
    total, span = int(count[some].sum()), int(far.max()) - int(near.min()) + 1
    step = max(1, span * UNFOLDED // max(total, UNFOLDED))
    for low in range(int(near.min()), int(far.max()) + 1, step):
        # Places in each stretch of its windows at distances from low to low + step - 1.
        start = np.maximum(far - (low + step - 1), 0)
        n = np.maximum(np.minimum(far - low, count[some] - 1) - start + 1, 0)
        place = np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)
        if not len(place):
            continue
        lead, f1, f2 = fingerprints(flat, place + np.repeat(at, n), length)
        order = np.lexsort((lead, f2, f1))
        lead, f1, f2 = lead[order], f1[order], f2[order]
        same = (lead[1:] == lead[:-1]) & (f1[1:] == f1[:-1]) & (f2[1:] == f2[:-1])
        equal = np.zeros(len(order), bool)
        equal[order[1:]] = same
        equal[order[:-1]] |= same
        marks[place + np.repeat(begin[some], n)] |= equal
    return marks


def _ranges(texts: DataFrame, length: int, k: int, most_slice: int, hot: int) -> DataFrame:
    """``bucket``, ``place`` of the text in it, ``lo`` and ``hi``: runs of repeated window starts."""
    width = max(1, (length - k) // 8)

    def counted(bucket: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for _, t, _ in _distinct(bucket):
            b = np.frombuffer(t, np.uint8)
            found += [owned(b[lo:hi], length, k)[0] for lo, hi in slices(len(b), length, most_slice)]
        g, n = np.unique(np.concatenate(found), return_counts=True)
        own = np.full(len(g), bucket.column("bucket")[0].as_py(), np.int32)
        return pa.table({"g": g.view(np.int64), "bucket": own, "n": n.astype(np.int64)})

    sent = texts.groupBy("bucket").applyInArrow(counted, "g long, bucket int, n long")
    n = F.sum("n").over(Window.partitionBy("g"))
    repeated = sent.select("g", "bucket", n.alias("n")).where("n > 1")
    names = ["h", "bucket", "place", "first", "last", "d", "n", "stretch"]
    kinds = [pa.int64(), *[pa.int32()] * 6, pa.binary()]

    def stretches(bucket: pa.Table, given: pa.Table) -> pa.Table:
        out: list[tuple] = []
        known = given.column("g").to_numpy().view(np.uint64)
        often = given.column("n").to_numpy()
        order = np.argsort(known)
        known, often = known[order], often[order]
        for place, (_, t, _) in enumerate(_distinct(bucket) if len(known) else []):
            b = np.frombuffer(t, np.uint8)
            for begin, end in slices(len(b), length, most_slice):
                g, at, first, last = owned(b[begin:end], length, k)
                i = np.minimum(np.searchsorted(known, g), len(known) - 1)
                hit = known[i] == g
                columns = (g[hit].view(np.int64), often[i[hit]], at[hit], first[hit], last[hit])
                for h, n, anchor, lo, hi in zip(*(c.tolist() for c in columns), strict=True):
                    if n <= hot:
                        out.append((h, place, begin + lo, begin + hi, anchor - lo, t[begin + lo : begin + hi + length]))
                        continue
                    while lo <= hi:
                        # Windows that start in the same of the widths before the anchor.
                        near = begin + anchor - (anchor - lo) // width * width
                        to = min(hi, near - begin)
                        h = xxhash.xxh3_64_intdigest(t[near : near - width + 1 + length]) - (1 << 63)
                        out.append((h, place, begin + lo, begin + to, anchor - lo, t[begin + lo : begin + to + length]))
                        lo = to + 1
        here = Counter(x[-1] for x in out)
        own = bucket.column("bucket")[0].as_py() if out else None
        rows: list[tuple] = []
        settled: list[list[int]] = []
        for h, place, lo, hi, d, stretch in out:
            n = here[stretch]
            if n != 1:
                # Known to repeat whole; one of them goes on as the partner of others.
                if settled and settled[-1][0] == place and lo <= settled[-1][2] + 1:
                    settled[-1][2] = hi
                else:
                    settled.append([place, lo, hi])
                here[stretch] = 0
            if n:
                rows.append((h, own, place, lo, hi, d, n, stretch))
        for place, lo, hi in settled:
            spread = xxhash.xxh3_64_intdigest(f"{own}:{place}") - (1 << 63)
            rows.append((spread, own, place, lo, hi, 0, 1, None))
        columns = zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)
        return pa.table([pa.array(c, kind) for c, kind in columns], names=names)

    cut = "h long, bucket int, place int, first int, last int, d int, n int, stretch binary"
    records = texts.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(stretches, cut)
    sorted_records = records.repartition("h").sortWithinPartitions("h")

    def compared(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(source):
            rows = pa.Table.from_batches(part)
            settled = rows.filter(pc.is_null(rows.column("stretch")))
            yield _runs(*(settled.column(c).to_numpy() for c in ("bucket", "place", "first", "last")))
            rows = rows.filter(pc.is_valid(rows.column("stretch")))
            if not len(rows):
                continue
            numbers: dict[bytes, int] = {}
            of = np.array([numbers.setdefault(x, len(numbers)) for x in rows.column("stretch").to_pylist()], np.int64)
            h, bucket, place, first, last, d, n = (rows.column(c).to_numpy() for c in names[:-1])
            different, row = list(numbers), np.unique(of, return_index=True)[1]
            count = np.fromiter(map(len, different), np.int64, len(different)) - length + 1
            several = np.bincount(of, n) > 1
            whole = several[of]
            yield _runs(bucket[whole], place[whole], first[whole], last[whole])
            marks = _repeated(h[row], d[row].astype(np.int64), different, length)
            owner = np.repeat(np.arange(len(different)), count)
            marks &= ~several[owner]
            edge = np.concatenate([[True], owner[1:] != owner[:-1]])
            begins = np.flatnonzero(marks & (edge | np.concatenate([[True], ~marks[:-1]])))
            ends = np.flatnonzero(marks & np.concatenate([edge[1:] | ~marks[1:], [True]]))
            own = row[owner[begins]]
            shift = first[own] - (np.cumsum(count) - count)[owner[begins]]
            yield _runs(bucket[own], place[own], begins + shift, ends + shift)

    return sorted_records.mapInArrow(compared, "bucket int, place int, lo int, hi int")


def _runs(*columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(c.astype(np.int32)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "place", "lo", "hi"])


# --- spans --------------------------------------------------------------------------------------


def _judged(docs: DataFrame, length: int, k: int, most_slice: int, hot: int) -> DataFrame:
    """``key``, ``copied``, the removed ``spans`` (start, end; end exclusive), ``n_removed`` and
    ``kept_sha256`` of the distinct texts that lose bytes."""
    assert k % 8 == 0 and k <= length, "grams are whole 8-byte words and fit a window"
    common.ship(docs.sparkSession)
    texts = _texts(docs, length)
    ranges = _ranges(texts, length, k, most_slice, hot)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([
        ("key", pa.binary()), ("copied", pa.bool_()), ("spans", pa.list_(span)),
        ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ])

    def judged(bucket: pa.Table, given: pa.Table) -> pa.Table:
        runs: dict[int, list[tuple[int, int]]] = {}
        columns = (given.column(c).to_pylist() for c in ("place", "lo", "hi"))
        for place, lo, hi in zip(*columns, strict=True):
            runs.setdefault(place, []).append((lo, hi + length))
        out: list[tuple] = []
        for place, (key, t, copies) in enumerate(_distinct(bucket)):
            spans: list[list[int]] = []
            for lo, hi in [(0, len(t))] if copies > 1 else sorted(runs.get(place, [])):
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
            if spans:
                listed = [{"start": lo, "end": hi} for lo, hi in spans]
                _, _, removed, _, digest = next(_kept([{"doc_id": None, "t": t, "spans": listed}]))
                out.append((key, copies > 1, listed, removed, digest))
        columns = zip(*out, strict=True) if out else [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    told = "key binary, copied boolean, spans array<struct<start: long, end: long>>, n_removed long, kept_sha256 string"
    return texts.groupBy("bucket").cogroup(ranges.groupBy("bucket")).applyInArrow(judged, told)


def find_spans(
    docs: DataFrame, length: int = 200, k: int = 32, most_slice: int = 8 << 20, hot: int = 50_000
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, spans, copied): texts (doc_id, t binary, key) of all rows; spans (key, start, end) of
    removed bytes of each distinct text without copies, maximal, end exclusive; copied (key) the texts
    with an exact copy, all of whose windows repeat."""
    judged = _judged(docs, length, k, most_slice, hot)
    texts = docs.select("doc_id", _text().alias("t")).withColumn("key", _key(F.col("t")))
    spans = judged.where("not copied").select("key", F.explode("spans").alias("span")).select("key", "span.*")
    return texts, spans, judged.where("copied").select("key")


def remove(docs: DataFrame, length: int = 200, k: int = 32, hot: int = 50_000) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (long), kept_sha256 (of the remaining bytes)."""
    t = _text()
    rows = docs.select("doc_id", F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t, 256).alias("sha"))
    rows = rows.withColumn("key", F.unhex("sha"))
    none = F.lit(0).cast("long")
    return rows.join(_judged(docs, length, k, 8 << 20, hot), "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce(F.array_size("spans").cast("long"), none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def joined_spans(texts: DataFrame, spans: DataFrame, copied: DataFrame, length: int) -> DataFrame:
    """Each text with its removed spans; a text with a copy is one span from 0 if it has a window."""
    whole = copied.select("key", F.lit(True).alias("copied"))
    listed = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = texts.join(whole, "key", "left").join(listed, "key", "left")
    n = F.octet_length("t").cast("long")
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("start"), n.alias("end")))
    spans_of = F.when(F.coalesce("copied", F.lit(False)) & (n >= length), all_of).otherwise(F.col("spans"))
    return joined.select("doc_id", "t", spans_of.alias("spans"))


def _kept(rows: list[dict]) -> Iterator[tuple]:
    for row in rows:
        t, spans = row["t"] or b"", row["spans"] or []
        digest, at, removed = hashlib.sha256(), 0, 0
        view = memoryview(t)
        for span in spans:
            digest.update(view[at : span["start"]])
            removed += span["end"] - span["start"]
            at = span["end"]
        digest.update(view[at:])
        yield row["doc_id"], len(t), removed, len(spans), digest.hexdigest()
