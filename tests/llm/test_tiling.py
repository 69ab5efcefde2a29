import random

import numpy as np

from labrelay.llm import tiling


def slow_tiles(item, doc, least):
    """Greedy string tiling by looking at every pair of positions."""
    used_i, used_d, tiles = [False] * len(item), [d == 0 for d in doc], []
    while True:
        best, matches = least - 1, []
        for j in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not used_i[i + n] and not used_d[j + n]:
                    n += 1
                if n > best:
                    best, matches = n, []
                if n == best and n >= least:
                    matches.append((i, j, n))
        if not matches:
            return tiles
        for i, j, n in matches:
            if not any(used_i[i:i + n]) and not any(used_d[j:j + n]):
                used_i[i:i + n], used_d[j:j + n] = [True] * n, [True] * n
                tiles.append((i, j, n))


def test_tiles_equal_the_definition():
    rng = random.Random(4)
    for trial in range(150):
        item = [rng.randint(1, 4) for _ in range(rng.randint(1, 25))]
        doc = [rng.randint(0, 4) for _ in range(rng.randint(1, 40))] + item[rng.randrange(len(item)):]
        assert tiling.greedy_tiles(np.array(item), np.array(doc), 3) == slow_tiles(item, doc, 3), trial


def test_contaminated_documents(spark, documents):
    words = [f"q{i}" for i in range(30)]
    item = " ".join(words)
    mixed = " ".join(words[15:] + ["gap"] + words[:15])  # reordered
    part = " ".join(words[:23]) + " something else"
    rows = [(1, "before " + item.upper() + " after", "s"), (2, mixed, "s"), (3, part, "s"), (4, None, "s"), (5, "", "s"), (6, "q1 q2", "s"),
            (7, "clean text of no item at all", "s"), (None, item, "s"), (8, item, "s"), (8, item, "s"),
            (9, "word " * 30000 + item, "s"), (10, " ".join(words[::-1]), "s")]
    items = spark.createDataFrame([(1, item), (2, None), (3, "too few words"), (None, item), (4, "other words that are nowhere here")],
                                  "item_id long, text string").selectExpr("*", "0 as doc_id")
    docs = documents(rows)
    for size in (tiling.BLOCK_BYTES, 60):  # one block of items, several blocks
        got = tiling.contaminated(docs, items, ["doc_id"], block_bytes=size).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(["1", "2", "8", "8", "9", "None"] * 2)  # the item is there without an id too
        assert {(r.item_id, r.item_words, r.covered_words, r.coverage) for r in got} == {(1, 30, 30, 1.0), (None, 30, 30, 1.0)}
        assert [tuple(t) for r in got if r.doc_id == 2 and r.item_id for t in r.tiles] == [(15, 0, 15), (0, 16, 15)]
        clean = tiling.decontaminated(docs, items, block_bytes=size)
        assert clean.columns == docs.columns
        assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6, 7, 10]
    assert tiling.decontaminated(docs, items.limit(0)).count() == len(rows)
    assert tiling.contaminated(docs.limit(0), items, ["doc_id"]).count() == 0
    assert tiling.contaminated(docs, items.limit(0), ["doc_id"]).count() == 0


def test_short_items_and_items_without_ids_count(spark, documents, monkeypatch):
    items = spark.createDataFrame([(1, "One two three"), (None, "four words stand here"), (None, " "), (2, "Xyzzy"), (3, "a b c d e f")],
                                  "item_id long, text string")
    docs = documents([(1, "one TWO three", "s"), (2, "one three two", "s"), (3, "so four words stand here now", "s"), (4, "four words stand", "s"),
                      (5, "x xyzzy", "s"), (6, "xyzzys", "s"), (7, "a b c d e", "s"), (8, "a b c d", "s"), (9, "two three one two three", "s")])
    monkeypatch.setattr(tiling, "BLOCKS_AT_ONCE", 2)
    for size in (tiling.BLOCK_BYTES, 12):  # with several blocks what is left is written in between
        got = tiling.contaminated(docs, items, ["doc_id"], block_bytes=size).collect()
        assert sorted((r.doc_id, r.item_id, r.covered_words) for r in got if r.item_id) == [(1, 1, 3), (5, 2, 1), (7, 3, 5), (9, 1, 3)]
        assert [(r.doc_id, r.item_id, r.item_words) for r in got if not r.item_id] == [(3, None, 4)]
        assert sorted(r.doc_id for r in tiling.decontaminated(docs, items, block_bytes=size).collect()) == [2, 4, 6, 8]


def test_found_equals_tiling_every_pair():
    rng = random.Random(9)
    for _ in range(60):
        items = [(k, " ".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))).encode()) for k in range(6)]
        text = " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30)))
        got = {i: total for i, _, total, _ in tiling.Items(items).found(text.encode(), 0.8)}
        want = {}
        for i, data in items:
            words = data.decode().split()
            tiles = slow_tiles(words, [w if w in words else 0 for w in text.split()], min(5, len(words)))
            if (total := sum(t[2] for t in tiles)) >= 0.8 * len(words):
                want[i] = total
        assert got == want
