"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

1. Each document gets a 64-bit SimHash of its word shingles (one pass, Arrow
   batches, no shuffle).
2. Distinct fingerprints are the keys of a binary trie. Pairs of trie nodes at
   an anchor depth are dealt out as groups: a fingerprint goes to the groups of
   the anchor nodes within the error budget of its own.
   The keys of a group too large for one task are dealt out by deeper nodes.
3. In a group the node pairs are walked together from the anchor down: the bits
   in which two nodes differ add up, a pair over the budget is pruned, and the
   compressed tail of a leaf pair is compared at once. Work runs in bounded
   chunks, and a group hands on a spanning forest of its links, not all pairs.
4. Links become components (``components``), and components the smallest id.

Exact copies share a fingerprint and so cost one trie key however many there are.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_arrow, staged, word_chunks
from .components import components

SEED = 42
BITS = 64
#: Bytes of text hashed at a time, so that a very long text needs bounded memory.
CHUNK = 1 << 18
#: Node pairs walked at a time.
PAIRS = 1 << 18
#: Fingerprints that a trie node at the anchor depth should hold about.
NODE_ROWS = 50_000
#: Fingerprints of a group beyond which it is dealt out by deeper nodes, and the
#: depth at which no group can be large (256 keys a node).
GROUP_ROWS = 1 << 23
MAX_DEPTH = 56


def fingerprint(data: bytes | None, width: int = 3) -> int:
    """SimHash of the ``width``-word shingles of a text in UTF-8.

    A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, repeats count. Fewer
    words than ``width`` form one shingle; null or no words give 0. A bit is set
    if it is set in over half of the shingles' XXH64 values.
    """
    counts, n, carry = np.zeros(BITS, np.int64), 0, []
    for part in word_chunks((data or b"").lower(), CHUNK):
        words = carry + part
        if len(words) >= width:
            n += _count(words, width, counts)
            carry = words[len(words) - width + 1:]
        else:
            carry = words
    if not n:
        if not carry:
            return 0
        n = _count(carry, len(carry), counts)
    bits = np.packbits((counts * 2 > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def _count(words: list[bytes], width: int, counts: np.ndarray) -> int:
    """Adds the bits of the shingles of a list of words to ``counts``; the number of shingles."""
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist())], "<u8")
    counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return len(h)


def fingerprints(docs: DataFrame, keep: list[str], width: int = 3, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, and ``fp``: its fingerprint as a signed long."""
    text = fresh(keep, "text")
    rows = docs.select(*keep, F.col(text_col).cast("string").cast("binary").alias(text))
    schema = rows.select(*keep).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            data = batch.column(batch.num_columns - 1)
            fps = np.array([fingerprint(x.as_py(), width) for x in data], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(fps.view(np.int64))],
                names=[*keep, "fp"])

    return map_arrow(rows, run, schema)


def _fold(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union of the classes of i and j: labels stay the least index of a class."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def trie_links(keys: np.ndarray, home: int, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links (at most ``budget`` differing bits) between
    ``keys`` below the anchor node ``home``, and from those to the other anchors
    in the group. keys: distinct uint64, each within the budget of ``home`` in
    its first ``depth`` bits."""
    keys = np.sort(keys)
    labels = np.arange(len(keys))
    anchor = (keys >> np.uint64(BITS - depth)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    ends = np.r_[starts[1:], len(keys)]
    own = np.flatnonzero(anchor[starts] == home)
    if not len(own):
        return keys[:0], keys[:0]
    lo, hi = int(starts[own[0]]), int(ends[own[0]])
    apart = np.bitwise_count((anchor[starts] ^ home).astype(np.uint64)).astype(np.int64)
    near = apart <= budget
    n = int(near.sum())
    stack = [(depth, np.full(n, lo), np.full(n, hi), starts[near], ends[near], apart[near])]
    while stack:
        level, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > PAIRS:  # walked in bounded chunks
            half = len(alo) // 2
            stack.append((level, *(x[:half] for x in (alo, ahi, blo, bhi, diff))))
            stack.append((level, *(x[half:] for x in (alo, ahi, blo, bhi, diff))))
            continue
        na, nb = ahi - alo, bhi - blo
        leaf = (na * nb <= 16) if level < BITS else np.ones(len(alo), bool)
        if leaf.any():
            size = (na * nb)[leaf]
            which = np.repeat(np.flatnonzero(leaf), size)
            k = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            i, j = alo[which] + k // nb[which], blo[which] + k % nb[which]
            hit = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
            labels = _fold(labels, i[hit], j[hit])
            go = ~leaf
            alo, ahi, blo, bhi, diff = alo[go], ahi[go], blo[go], bhi[go], diff[go]
        if not len(alo):
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - level)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if level else np.uint64(0)
        amid = np.searchsorted(keys, (keys[alo] & above) | bit)
        bmid = np.searchsorted(keys, (keys[blo] & above) | bit)
        amid, bmid = np.clip(amid, alo, ahi), np.clip(bmid, blo, bhi)
        same = alo == blo
        children = (
            (alo, amid, blo, bmid, diff, None),
            (amid, ahi, bmid, bhi, diff, None),
            (alo, amid, bmid, bhi, diff + 1, None),
            (amid, ahi, blo, bmid, diff + 1, ~same),  # of a node with itself, the mirror image
        )
        parts = []
        for al, ah, bl, bh, d, also in children:
            ok = (ah > al) & (bh > bl) & (d <= budget)
            ok = ok if also is None else ok & also
            parts.append(tuple(x[ok] for x in (al, ah, bl, bh, d)))
        merged = tuple(np.concatenate(x) for x in zip(*parts))
        if len(merged[0]):
            stack.append((level + 1, *merged))
    linked = np.flatnonzero(labels != np.arange(len(keys)))
    return keys[linked], keys[labels[linked]]


def _anchors(depth: int, budget: int) -> list[int]:
    """Every pattern of 1 to ``budget`` differing bits among ``depth``."""
    return [sum(1 << b for b in bits) for n in range(1, budget + 1) for bits in combinations(range(depth), n)]


def _dealt(rows: DataFrame, depth: int, budget: int) -> DataFrame:
    """``rows`` (fp and other columns) once for each anchor node at ``depth``
    (home) whose group they belong to: their own and part of those within the budget."""
    masks = " ".join(map(str, _anchors(depth, budget)))
    # The pair of nodes p and p^m belongs to the one whose lowest differing bit
    # equals the parity of their common bits; the other's keys are sent there.
    others = F.expr(
        f"transform(filter(cast(split('{masks}', ' ') as array<bigint>), m -> "
        "((node & (m & -m)) = 0) = ((bit_count(node & ~m) & 1) = 1)), m -> node ^ m)") if masks else F.array()
    return (rows.withColumn("node", F.shiftrightunsigned("fp", BITS - depth))
            .withColumn("home", F.explode(F.concat(F.array("node"), others))).drop("node"))


def _walk(depth: int, budget: int):
    """The function that finds the links of one group of fingerprints."""

    def run(group: pa.Table) -> pa.Table:
        home = group.column("home")[0].as_py()
        keys = group.column("fp").to_numpy().view(np.uint64)
        a, b = trie_links(keys, home, depth, budget)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def fingerprint_links(fps: DataFrame, budget: int = 2, depth: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``fps`` (fp long)
    at most ``budget`` bits apart: a spanning forest of each group's links.

    The anchor depth follows the number of fingerprints, so a node holds about
    ``NODE_ROWS`` at any size. Where fingerprints crowd below one node, those of
    groups of more than ``group_rows`` are dealt out anew by nodes deeper in the
    trie: two of them within the budget meet there too. Nothing is left out.
    """
    n = fps.count()
    if depth is None:
        depth = max(8, int(np.ceil(np.log2(max(1, n) / NODE_ROWS))))
    rows, out = fps.select("fp"), None
    while True:
        dealt = _dealt(rows, depth, budget)
        if out is not None:  # deep nodes are sparse: only those that hold a key are walked
            nodes = rows.select(F.shiftrightunsigned("fp", BITS - depth).alias("home")).distinct()
            dealt = dealt.join(nodes, "home", "left_semi")
        crowded = None
        if n > group_rows and depth < MAX_DEPTH:  # a group holds a fingerprint once at most
            crowded = staged(dealt.groupBy("home").count().where(F.col("count") > group_rows).select("home"), "crowded_groups")
            crowded = None if crowded.isEmpty() else F.broadcast(crowded)  # one row for group_rows rows at least
        ready = dealt if crowded is None else dealt.join(crowded, "home", "left_anti")
        links = ready.groupBy("home").applyInArrow(_walk(depth, budget), "a long, b long")
        out = links if out is None else out.union(links)
        if crowded is None:
            return out
        rows = staged(dealt.join(crowded, "home", "left_semi").select("fp").distinct(), "crowded_fingerprints")
        depth = min(MAX_DEPTH, depth + 8)


def simhash_components(docs: DataFrame, keep: list[str], width: int = 3, budget: int = 2) -> DataFrame:
    """``keep`` of every row, ``fp``, and ``group``: the least member (a struct of
    ``keep``, nulls last) of the rows linked to it, itself included.

    Null and empty texts have fingerprint 0 and are linked like any other; rows
    repeated in full stay separate rows of one group; an empty table gives none.
    """
    fps = staged(fingerprints(docs, keep, width), "fingerprints")
    # Of a struct the first difference counts; a flag before each column puts nulls last.
    member = F.struct(*[x for c in keep for x in (F.col(c).isNull().alias(f"null_{c}"), F.col(c).alias(c))])
    firsts = staged(fps.groupBy("fp").agg(F.min(member).alias("least")), "distinct_fingerprints")
    found = staged(components(fingerprint_links(firsts.select("fp"), budget)), "components")
    of_class = found.join(firsts, found.node == firsts.fp).groupBy("component").agg(F.min("least").alias("group_least"))
    linked = found.join(of_class, "component").select(F.col("node").alias("fp"), "group_least")
    # A table of its own, so that both sides of the next join are plain shuffles: a
    # fingerprint that a third of all rows share is then split over many tasks.
    classes = staged(firsts.join(linked, "fp", "left").select("fp", F.coalesce("group_least", "least").alias("least")), "classes")
    group = F.struct(*[F.col(f"least.{c}").alias(c) for c in keep]).alias("group")
    return fps.join(classes, "fp").select(*keep, "fp", group)


def simhash_dedup(docs: DataFrame, width: int = 3, budget: int = 2, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the
    smallest id stays (null ids last, ties by a hash of the row); of rows
    repeated in full, one. All columns are kept."""
    key = fresh(docs.columns, "row_hash")
    keyed = docs.withColumn(key, F.xxhash64(*docs.columns))
    rows = keyed.select(F.col(id_col).alias("id"), F.col(key).alias("hash"), "text")
    groups = simhash_components(rows, ["id", "hash"], width, budget)
    kept = groups.where(F.col("id").eqNullSafe(F.col("group.id")) & (F.col("hash") == F.col("group.hash")))
    kept = kept.select(F.col("hash").alias(key), F.col("id").alias(fresh(keyed.columns, "kept_id"))).distinct()
    kept_id = kept.columns[1]
    out = keyed.join(kept, key).where(F.col(id_col).eqNullSafe(F.col(kept_id)))
    return out.dropDuplicates([key, id_col]).select(*docs.columns)


def simhash_report(docs: DataFrame, width: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable;
    null only where a group has no row with an id) of every row."""
    out = simhash_components(docs.select("doc_id", "text"), ["doc_id"], width, budget)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("group.doc_id").alias("component_id"))
