"""Benchmark decontamination by greedy string tiling.

Every whole text is one pass of Arrow batches against blocks of benchmark items:

1. Seeds: each run of ``MIN_MATCH`` words of an item is hashed (Karp-Rabin over
   word numbers); the rolling hashes of a document are joined with them.
   The item words that a document's seeds cover bound what tiles can cover, so
   a pair below the threshold there is dropped without loss.
2. Tiles: for the pairs left, the longest unmarked common run is found by
   Karp-Rabin, all runs of that length are marked without overlap, and so on
   down to ``MIN_MATCH`` words. Order does not matter, so reordered passages
   still add up.
3. A document is contaminated by an item if its tiles cover ``THRESHOLD`` of it.

Items are taken in blocks of bounded size, one pass over the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, fresh, map_arrow, powers, staged, word_chunks

MIN_MATCH = 5
THRESHOLD = 0.8
#: Bytes of item text that a block of items may hold (sent to every executor).
BLOCK_BYTES = 32 << 20
#: Blocks that one task holds at a time, each with a worker and an index of its own.
BLOCKS_AT_ONCE = 4


def _windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2**64) of all runs of ``size`` word numbers."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * np.uint64(BASE) + ids[j:j + n]
    return h


def _run_hashes(ids: np.ndarray, size: int, prefix: np.ndarray, power: np.ndarray) -> np.ndarray:
    """The same hashes from prefix sums, for any size in a few operations."""
    n = len(ids) - size + 1
    return prefix[size:size + n] - prefix[:n] * power[size]


def _prefix(ids: np.ndarray) -> np.ndarray:
    out = np.zeros(len(ids) + 1, np.uint64)
    h, base, full = 0, BASE, (1 << 64) - 1
    for i, x in enumerate(ids.tolist()):
        h = (h * base + x) & full
        out[i + 1] = h
    return out


def _spans(lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The numbers low..high-1 of every span, one span after the other."""
    sizes = highs - lows
    return np.arange(sizes.sum()) + np.repeat(lows - (np.cumsum(sizes) - sizes), sizes)


def _free_run(marked: np.ndarray) -> np.ndarray:
    """For each position, how many unmarked positions follow from it on."""
    n = len(marked)
    stops = np.flatnonzero(marked)
    at = np.searchsorted(stops, np.arange(n))
    ends = np.append(stops, n)
    return ends[at] - np.arange(n)


def greedy_tiles(item: np.ndarray, doc: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """(item start, document start, words) of the greedy string tiling of two
    sequences of word numbers. Longest matches first; of equally long ones the
    earliest in the document, then in the item. 0 in ``doc`` never matches."""
    item, doc = item.astype(np.uint64), doc.astype(np.uint64)
    power = powers(max(len(item), len(doc)) + 2)
    item_prefix, doc_prefix = _prefix(item), _prefix(doc)
    item_marked, doc_marked = np.zeros(len(item), bool), doc == 0
    tiles: list[tuple[int, int, int]] = []

    def candidates(size: int) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]]]:
        """Document starts and hashes of unmarked runs of ``size`` words whose hash
        an unmarked run of the item has; the item's starts by hash."""
        a = np.flatnonzero(_free_run(item_marked)[:len(item) - size + 1] >= size)
        b = np.flatnonzero(_free_run(doc_marked)[:len(doc) - size + 1] >= size)
        ha, hb = _run_hashes(item, size, item_prefix, power)[a], _run_hashes(doc, size, doc_prefix, power)[b]
        both = np.isin(hb, ha)
        starts: dict[int, list[int]] = {}
        for at, h in zip(a.tolist(), ha.tolist()):
            starts.setdefault(h, []).append(at)
        return b[both], hb[both], starts

    def same(i: int, j: int, size: int) -> bool:
        return np.array_equal(item[i:i + size], doc[j:j + size])

    def common(size: int) -> bool:
        at, hashes, starts = candidates(size)
        return any(same(i, j, size) for j, h in zip(at.tolist(), hashes.tolist()) for i in starts[h])

    top = min(len(item), len(doc))
    while top >= min_match:
        low, high = min_match - 1, top  # if a run of some length is left, so are shorter ones
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if common(mid) else (low, mid - 1)
        if low < min_match:
            break
        at, hashes, starts = candidates(low)
        free = 0
        for j, h in zip(at.tolist(), hashes.tolist()):
            if j < free:
                continue
            starts[h] = [i for i in starts[h] if not item_marked[i:i + low].any()]
            for i in starts[h]:
                if same(i, j, low):
                    item_marked[i:i + low] = doc_marked[j:j + low] = True
                    tiles.append((i, j, low))
                    free = j + low
                    break
        top = low
    return tiles


class Seeds:
    """The seeds of ``size`` words of some items (id, word numbers), by hash, and where they occur."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], size: int):
        self.items, self.size = items, size
        hashes = [_windows(ids, size) for _, ids in items]
        self.sizes = np.array([len(ids) for _, ids in items], np.int64)
        self.seeds = np.concatenate(hashes)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds = self.seeds[order]
        self.owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])[order]
        self.start = np.concatenate([np.arange(len(h)) for h in hashes])[order]

    def found(self, ids: np.ndarray, threshold: float) -> Iterator[tuple[int | None, int, int, list[tuple[int, int, int]]]]:
        """The same as ``Items.found``, of a document's word numbers."""
        if len(ids) < self.size:
            return
        known = np.concatenate(([0], np.cumsum(ids != 0)))
        at = np.flatnonzero(known[self.size:] - known[:-self.size] == self.size)
        if not len(at):
            return
        h = _windows(ids, self.size)[at]
        left, right = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
        hit = right > left
        if not hit.any():
            return
        at, left, right = at[hit], left[hit], right[hit]
        h = h[hit]
        # Distinct seeds decide the bound; a seed repeated in the document adds nothing to it.
        ranges = np.unique(np.stack([left, right], 1), axis=0)
        seeds = _spans(ranges[:, 0], ranges[:, 1])
        seeds = seeds[np.argsort(self.owner[seeds], kind="stable")]
        owners, first, count = np.unique(self.owner[seeds], return_index=True, return_counts=True)
        enough = count * self.size >= threshold * self.sizes[owners]
        by_hash = np.argsort(h, kind="stable")
        ordered = h[by_hash]
        for k, begin, size in zip(owners[enough].tolist(), first[enough].tolist(), count[enough].tolist()):
            item_id, item = self.items[k]
            covered = np.zeros(len(item), bool)
            own = seeds[begin:begin + size]
            covered[self.start[own][:, None] + np.arange(self.size)] = True
            if covered.sum() < threshold * len(item):
                continue
            # Only words below this item's seeds can be in a tile.
            mine = np.unique(self.seeds[own])
            mine = by_hash[_spans(np.searchsorted(ordered, mine, "left"), np.searchsorted(ordered, mine, "right"))]
            keep = np.unique(at[mine][:, None] + np.arange(self.size))
            gaps = np.flatnonzero(np.diff(keep) > 1) + 1
            doc = np.insert(ids[keep], gaps, 0)
            where = np.insert(keep, gaps, -1)
            tiles = [(i, int(where[j]), size) for i, j, size in greedy_tiles(item, doc, self.size)]
            total = sum(size for _, _, size in tiles)
            if total >= threshold * len(item):
                yield item_id, len(item), total, tiles


class Items:
    """A block of benchmark items: word numbers, and seeds of ``min_match`` words or, of
    a shorter item, all its words."""

    def __init__(self, rows: list[tuple[int | None, bytes]], min_match: int = MIN_MATCH):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        by_size: dict[int, list] = {}
        for item_id, data in rows:
            words = data.lower().split()
            if words:
                ids = np.array([number.setdefault(w, len(number) + 1) for w in words], np.uint64)
                by_size.setdefault(min(min_match, len(words)), []).append((item_id, ids))
        self.seeds = [Seeds(items, size) for size, items in sorted(by_size.items(), reverse=True)]

    def found(self, data: bytes, threshold: float) -> Iterator[tuple[int | None, int, int, list[tuple[int, int, int]]]]:
        """(item id, item words, words covered, tiles) of each item that contaminates a text."""
        number = self.vocabulary.get
        parts = [np.fromiter(map(number, words, repeat(0)), np.uint64, len(words)) for words in word_chunks(data.lower())]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        for seeds in self.seeds:
            yield from seeds.found(ids, threshold)


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "item_id",
                text_col: str = "text") -> Iterator[list[tuple[int | None, bytes]]]:
    """The benchmark's items in blocks of at most about ``block_bytes``: items are
    dealt to blocks by a hash, and one block at a time is on the driver."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"),
                             F.col(text_col).cast("string").cast("binary").alias("text"))
    items = items.where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield sorted(((r.id, bytes(r.text)) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str], min_match: int = MIN_MATCH,
                 threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and item whose tiles cover ``threshold`` of the
    item's words: ``keep`` of the document, item_id long, item_words int,
    covered_words int, coverage double, tiles (item word, document word, words).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. An item of fewer than
    ``min_match`` words must stand in the document as a whole, so one of a single word
    is found wherever the word is; items without an id have a null item_id; null items and
    items without a word take no part. Null and empty texts give no row; a document
    repeated in full gives its rows again.
    """
    spark = docs.sparkSession
    text = fresh(keep, "document_text")
    rows = docs.select(*keep, F.col("text").cast("string").cast("binary").alias(text))
    own = ["item_id", "item_words", "covered_words", "coverage", "tiles"]
    tile = "array<struct<item_word:int,document_word:int,words:int>>"
    types = ["long", "int", "int", "double", tile]
    schema = rows.select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in zip(own, types)]).schema
    out = None
    for block in item_blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            items = Items(sent.value, min_match)
            for batch in batches:
                data = batch.column(batch.num_columns - 1)
                found = [(i, *x) for i, t in enumerate(data) if t.is_valid for x in items.found(t.as_py(), threshold)]
                at = pa.array([x[0] for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).take(at) for i in range(batch.num_columns - 1)] + [
                        pa.array([x[1] for x in found], pa.int64()),
                        pa.array([x[2] for x in found], pa.int32()),
                        pa.array([x[3] for x in found], pa.int32()),
                        pa.array([x[3] / x[2] for x in found], pa.float64()),
                        pa.array([[dict(zip(("item_word", "document_word", "words"), t)) for t in x[4]] for x in found],
                                 pa.list_(pa.struct([("item_word", pa.int32()), ("document_word", pa.int32()),
                                                     ("words", pa.int32())])))],
                    names=[*keep, *own])

        part = map_arrow(rows, run, schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (all columns) that no benchmark item contaminates, by the
    rules of ``contaminated``: a filter in the scan, one pass for each block of items.
    A task runs ``BLOCKS_AT_ONCE`` of them, one after the other; between so many the rows
    that are left are written."""
    spark = docs.sparkSession
    text = fresh(docs.columns, "document_text")
    out, chained = docs, []
    for block in item_blocks(benchmark, block_bytes):
        if len(chained) == BLOCKS_AT_ONCE:
            out = staged(out, "decontaminated")
            for old in chained:
                old.destroy()
            chained = []
        sent = spark.sparkContext.broadcast(block)
        chained.append(sent)

        def run(batches, sent=sent):
            items = Items(sent.value, min_match)
            for batch in batches:
                data = batch.column(batch.num_columns - 1)
                clean = [not (t.is_valid and any(True for _ in items.found(t.as_py(), threshold))) for t in data]
                yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(clean, pa.bool_()))

        asked = out.withColumn(text, F.col("text").cast("string").cast("binary"))
        out = map_arrow(asked, run, out.schema)
    return out
