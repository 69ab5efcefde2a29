"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes into tokens A and B. Every token points to its
farthest-right overlapping token of the other kind; a B token that ends where an
A token ends points to itself. Doubling all successors at once (succ = succ[succ])
until nothing moves takes every token to the terminal of its component of
overlapping tokens, and the terminal labels the group.

Texts are cut once, in Arrow batches, and the result is written to the shared
folder. Link counts of the corpus are pre-aggregated in each task. The
``HOT_PAIRS`` most frequent id pairs, a fixed bound, go to every task; what is
left, if anything, is joined with the links of the documents by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_arrow, staged

#: The folder of the vocabulary files, read by the driver alone.
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Id pairs whose counts are sent to every task (17 bytes each).
HOT_PAIRS = 1 << 18
#: Characters tokenized at a time (a longer text goes alone), and links counted before they are handed on.
CHUNK, LINKS = 1 << 18, 1 << 22


def byte_chars() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable
    Latin-1 for itself, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Fixed value: how byte-level vocabularies without settings of their own part a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_encoder(spec: dict):
    """An encoder that merges bytes by rank, several times as fast as the general one and
    with the same ids, for a byte-level vocabulary whose ids follow its merges and that sets
    nothing else; None for others."""
    model, pre, chars = spec["model"], spec.get("pre_tokenizer") or {}, byte_chars()
    plain = (model.get("type") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and not any(model.get(k) for k in (
                 "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")))
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", [])]
    if not plain or any(model["vocab"].get(m) != 256 + k for k, m in enumerate(merges)) or len(model["vocab"]) < 256 + len(merges):
        return None
    import tiktoken

    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(chars[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merges) else None


class Pair:
    """Both tokenizers and the bytes of their tokens; made in each worker from the files' content."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b)
        self.bytes = byte_encoder(json.loads(a))
        chars = byte_chars()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            if all(c in chars for c in token):
                self.a_bytes[i] = bytes(chars[c] for c in token)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_size = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_size = np.array(list(map(len, self.b_bytes)), np.int64)
        # An id with what follows it in the text of the groups: the next id, or the end of its side.
        self.a_text = np.array([f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))], object)
        self.b_text = np.array([f"{i}{end}" for end in ",;" for i in range(len(self.b_bytes))], object)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """The ids of A. Texts beyond ``CHUNK`` take the general encoder: the other one's
        pattern runs out of stack on some hundred thousand blanks in a row, and ends the worker."""
        if self.bytes:
            return [self.bytes.encode_ordinary(t) if len(t) <= CHUNK else self.a.encode(t, add_special_tokens=False).ids for t in texts]
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """The ids of A and B of every text; none if it is null, empty, or the bytes of
        either side are not a space and the text."""
        some = [t for t in texts if t]
        cut = zip(self.encode_a([" " + t for t in some]), self.b.encode(some, num_threads=1))
        out = []
        for text in texts:
            ids = ([], [])
            if text:
                a, b = next(cut)
                whole = b" " + text.encode()
                if b"".join([self.a_bytes[i] for i in a]) == whole == b"".join([self.b_bytes[i] for i in b]):
                    ids = (a, b)
            out.append(ids)
        return out


def successors(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """The farthest-right overlapping token of each token, A's then B's, by their ends
    (each token begins where the one before it ends, and none is empty)."""
    to_b = len(a_end) + np.searchsorted(b_end, a_end)
    to_a = np.searchsorted(a_end, b_end)
    own = np.arange(len(a_end), len(a_end) + len(b_end))
    return np.concatenate([to_b, np.where(a_end[to_a] == b_end, own, to_a)]) if len(a_end) else to_b


def terminals(succ: np.ndarray) -> np.ndarray:
    """Where each pointer ends, by doubling."""
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            return succ
        succ = further


def align(pair: Pair, ids: list[tuple[list[int], list[int]]]) -> dict[str, list]:
    """Tokens, groups and links of several texts at once; their bytes follow one another,
    so no group crosses a text. Per text: n_a, n_b, n_groups, the text of its groups,
    and its distinct linked pairs (ids a and b) with how often each is linked."""
    n_a, n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
    a, b = (np.fromiter((i for x in ids for i in x[side]), np.int64, n.sum()) for side, n in ((0, n_a), (1, n_b)))
    a_end, b_end = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    label = terminals(successors(a_end, b_end))
    group_of_a, group_of_b = label[:len(a)] - len(a), label[len(a):] - len(a)
    last_b = group_of_b == np.arange(len(b))  # terminals
    rank = np.cumsum(last_b) - 1
    a_rank, b_rank = rank[group_of_a], rank[group_of_b]
    last_a = np.append(a_rank[1:] != a_rank[:-1], True)[:len(a)]
    # A's tokens of a group, then B's, and so on: each token's place in that order.
    a_before, b_before = np.searchsorted(b_rank, a_rank), np.searchsorted(a_rank, b_rank, "right")
    parts = np.empty(len(a) + len(b), object)
    parts[np.arange(len(a)) + a_before] = pair.a_text[a + last_a * len(pair.a_bytes)]
    parts[np.arange(len(b)) + b_before] = pair.b_text[b + last_b * len(pair.b_bytes)]
    # The tokens that end a group end together.
    doc = np.repeat(np.arange(len(ids)), n_b)[last_b]
    link = a[last_a] << 32 | b[last_b]
    out = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc, minlength=len(ids)), "groups": [], "a": [], "b": [], "n": []}
    part_to, link_to = np.cumsum(n_a + n_b), np.cumsum(out["n_groups"])
    for k in range(len(ids)):
        out["groups"].append("".join(parts[part_to[k] - n_a[k] - n_b[k]:part_to[k]].tolist())[:-1])
        keys, n = np.unique(link[link_to[k] - out["n_groups"][k]:link_to[k]], return_counts=True)
        out["a"].append((keys >> 32).astype(np.int32))
        out["b"].append((keys & 0xFFFFFFFF).astype(np.int32))
        out["n"].append(n.astype(np.int32))
    return out


TOKENS = "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
LINKED = "link_a array<int>, link_b array<int>, link_n array<int>"


def _tokenized(docs: DataFrame, keep: list[str], a_file: str, b_file: str) -> tuple[DataFrame, list[str]]:
    """``keep`` of every row with the columns of ``TOKENS`` and ``LINKED``, and the names these
    have here. ``row`` numbers the rows as this one run writes them."""
    names = [c.split()[0] for c in f"{TOKENS}, {LINKED}".split(", ")]
    named = []
    for name in names:
        named.append(fresh([*keep, *named], name))
    with open(a_file, "rb") as fa, open(b_file, "rb") as fb:
        files = docs.sparkSession.sparkContext.broadcast((fa.read(), fb.read()))
    rows = docs.select(*keep, F.col("text").cast("string").alias(fresh(keep, "document_text")))
    kinds = [c.split()[1] for c in f"{TOKENS}, {LINKED}".split(", ")]
    schema = rows.select(*keep, *(F.lit(None).cast(k).alias(n) for n, k in zip(named, kinds))).schema

    def run(batches: Iterator[pa.RecordBatch]):
        pair, row = Pair(*files.value), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            at = 0
            while at < len(texts):
                part, size, start = [], 0, at
                while at < len(texts) and (not part or size + len(texts[at].as_py() or "") <= CHUNK):
                    part.append(texts[at].as_py())
                    size += len(part[-1] or "")
                    at += 1
                got = align(pair, pair.encode(part))
                sha = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got["groups"]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(start, at - start) for i in range(batch.num_columns - 1)]
                    + [pa.array(np.arange(row, row + len(part))), pa.array(got["n_a"]), pa.array(got["n_b"]), pa.array(got["n_groups"]), pa.array(got["n_groups"]), pa.array(sha)]
                    + [pa.array(got[k], pa.list_(pa.int32())) for k in "abn"], names=[*keep, *named])
                row += len(part)

    return map_arrow(rows, run, schema), named


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document in the batch, pair of ids as one number, links) of the last three columns."""
    a, b, n = (batch.column(batch.num_columns - k) for k in (3, 2, 1))
    length = n.value_lengths().to_numpy(zero_copy_only=False)
    a, b, n = (x.flatten().to_numpy().astype(np.int64) for x in (a, b, n))
    return np.repeat(np.arange(len(length)), length), a << 32 | b, n


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sum of their n."""
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, n, best) of the corpus: each linked pair of ids (a * 2**32 + b), its number of
    links, and whether no pair with the same b has more. Columns: those of ``LINKED``."""

    def run(batches: Iterator[pa.RecordBatch]):
        keys, n, more = np.empty(0, np.int64), np.empty(0, np.int64), []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

        for batch in batches:
            _, new, m = _flat(batch)
            more.append(_summed(new, m))
            if sum(len(x[0]) for x in more) > LINKS:
                keys, n = _summed(np.concatenate([keys, *(x[0] for x in more)]), np.concatenate([n, *(x[1] for x in more)]))
                more = []
                if len(keys) > LINKS:  # a task holds no more than this
                    yield out()
                    keys, n = keys[:0], n[:0]
        keys, n = _summed(np.concatenate([keys, *(x[0] for x in more)]), np.concatenate([n, *(x[1] for x in more)]))
        yield out()

    sums = map_arrow(linked, run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    sums = staged(sums, "pairs").withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    top = sums.groupBy("b").agg(F.max("n").alias("top"))
    return sums.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def aligned(docs: DataFrame, keep: list[str], a_file: str = f"{TOKENIZERS}/{BYTE_BPE}", b_file: str = f"{TOKENIZERS}/{PIECE_BPE}",
            hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``keep`` of every row, then n_a, n_b, n_groups, n_links, n_best, count_sum (long)
    and groups_sha256 (string); a name that ``keep`` holds gets a ``_`` behind it.

    A (``a_file``, a byte-level vocabulary) encodes a space and the text, B (``b_file``,
    a piece model that adds the space) the text, both without special tokens. Texts that
    are null, empty or not given back byte for byte have no tokens: zeros and ''. A link is
    an occurrence of an A and a B token that end together; n_best counts the links
    whose pair of ids has the most links of all pairs with its B id (ties included),
    count_sum sums up the corpus-wide links of each link's pair. Repeated rows and ids
    stay apart; an empty table gives no rows.
    """
    tokenized, named = _tokenized(docs, keep, a_file, b_file)
    cut = staged(tokenized, "tokens")
    row, *counts, sha, a, b, n = named
    pairs = staged(pair_counts(cut.select(a, b, n)), "counts")
    hot = pairs.orderBy(F.desc("n"), "pair").limit(hot_pairs).toArrow()
    order = np.argsort(hot.column("pair").to_numpy())
    table = cut.sparkSession.sparkContext.broadcast(tuple(hot.column(c).to_numpy()[order] for c in ("pair", "n", "best")))
    best, total = (fresh([*keep, *named], c) for c in ("n_best", "count_sum"))
    out = _looked_up(cut, table, [*keep, row, *counts, sha], best, total)
    if hot.num_rows == hot_pairs:
        more = _rest(cut.select(row, a, b, n), table).join(pairs, "pair").groupBy("row").agg(
            F.sum(F.col("m") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("m"))).alias("more_best"))
        added = lambda c, x: (F.col(c) + F.coalesce(x, F.lit(0))).alias(c)
        out = out.join(more, out[row] == more["row"], "left").select(
            *keep, *counts, sha, added(best, more["more_best"]), added(total, more["more_sum"]))
    return out.select(*keep, *counts, best, total, sha)


def _looked_up(cut: DataFrame, table, carried: list[str], best: str, total: str) -> DataFrame:
    """``carried`` of every row with the sums over its links whose pairs are in ``table``."""
    schema = cut.select(*carried, F.lit(0).cast("long").alias(best), F.lit(0).cast("long").alias(total)).schema
    rows = cut.select(*carried, *cut.columns[-3:])

    def run(batches: Iterator[pa.RecordBatch]):
        pair, count, is_best = table.value
        for batch in batches:
            doc, key, n = _flat(batch)
            at, found = _places(pair, key)
            n = n * found
            sums = [np.bincount(doc, weights=x, minlength=batch.num_rows).astype(np.int64)
                    for x in ((n * is_best[at], n * count[at]) if len(pair) else (n, n))]
            yield pa.RecordBatch.from_arrays(batch.columns[:len(carried)] + [pa.array(x) for x in sums], names=[*carried, best, total])

    return map_arrow(rows, run, schema)


def _rest(linked: DataFrame, table) -> DataFrame:
    """(row, pair, m) of the links whose pairs are not in ``table``."""

    def run(batches: Iterator[pa.RecordBatch]):
        pair = table.value[0]
        for batch in batches:
            doc, key, n = _flat(batch)
            rare = ~_places(pair, key)[1]
            row = batch.column(0).to_numpy()[doc[rare]]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(key[rare]), pa.array(n[rare])], names=["row", "pair", "m"])

    return map_arrow(linked, run, "row long, pair long, m long")


def _places(pair: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in the sorted ``pair``, and whether it does."""
    at = np.minimum(np.searchsorted(pair, key), max(0, len(pair) - 1))
    return at, pair[at] == key if len(pair) else np.zeros(len(key), bool)
