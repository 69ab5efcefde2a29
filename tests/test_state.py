"""State tables: buckets, commit records, replays, races."""

import hashlib
import os
import random

import pytest
from conftest import raw_frame

import samples as S
from labrelay import parse_messages
from labrelay.sinks import commit_log
from labrelay.sinks.bucket_table import BucketTable
from labrelay.sinks.commit_log import Commit, CommitLog, write_once
from labrelay.sinks.table_sink import SnapshotTable


def acks(spark, keys, tag):
    """One ack for each key, in order; ``tag`` is in its message id."""
    texts = [S.ACK.replace("ord-0001", f"key{k}").replace("ack-0001", f"{tag}-{i}") for i, k in enumerate(keys)]
    return parse_messages(raw_frame(spark, texts), "ack")


def current(table, spark):
    rows = table.read(spark).collect()
    assert len({r.ack_message_id for r in rows}) == len(rows)
    return {r.ack_message_id: r.message_id for r in rows}


def files(path):
    out = {}
    for d, _, names in os.walk(path):
        if "_commits" not in d:
            out.update({os.path.relpath(f"{d}/{n}", path): hashlib.md5(open(f"{d}/{n}", "rb").read()).hexdigest() for n in names})
    return out


def test_a_batch_leaves_other_buckets_alone(spark, scratch_dir):
    t = BucketTable(f"{scratch_dir}/t", "ack", buckets=8)
    t.upsert(acks(spark, range(60), "a"), 0)
    before = files(t.path)
    old = t.log.newest(spark).state["pieces"]
    assert len(old) == 8
    t.upsert(acks(spark, [3], "b"), 1)
    after = files(t.path)
    new = t.log.newest(spark).state["pieces"]
    assert [b for b in new if new[b] != old[b]] and sum(new[b] != old[b] for b in new) == 1
    assert {f: h for f, h in after.items() if f in before} == before  # not even the touched bucket's first piece
    assert current(t, spark) == {f"key{k}": "b-0" if k == 3 else f"a-{k}" for k in range(60)}


@pytest.mark.parametrize("table", [BucketTable, SnapshotTable])
def test_replays_are_known_after_pruning_with_two_runs_in_turn(spark, scratch_dir, table):
    t = table(f"{scratch_dir}/t", "ack", **({"keep_commits": 1} if table is BucketTable else {"keep_versions": 1}))
    want = {}
    for n in range(3):
        for run in ("first", "second"):
            t.upsert(acks(spark, [0, n], f"{run}{n}"), n, run)
            want |= {"key0": f"{run}{n}-{int(n == 0)}", f"key{n}": f"{run}{n}-1"}
    for n, run in ((0, "first"), (2, "first"), (1, "second"), (2, "second")):
        t.upsert(acks(spark, [0, 1, 2, 9], "replay"), n, run)
    assert current(t, spark) == want
    t.upsert(acks(spark, [9], "third"), 0, "third")
    assert current(t, spark) == want | {"key9": "third-0"}


@pytest.mark.parametrize("table", [BucketTable, SnapshotTable])
def test_the_slower_writer_builds_on_the_other(spark, scratch_dir, table, monkeypatch):
    t, other = table(f"{scratch_dir}/t", "ack"), table(f"{scratch_dir}/t", "ack")
    t.upsert(acks(spark, [1, 2], "a"), 0, "one")
    append, raced = CommitLog.append, []

    def late(self, spark_, commit):
        if not raced:  # another run commits between this writer's data and its commit
            raced.append(1)
            other.upsert(acks(spark, [2, 3], "b"), 0, "two")
        return append(self, spark_, commit)

    monkeypatch.setattr(CommitLog, "append", late)
    t.upsert(acks(spark, [1, 4], "c"), 1, "one")
    assert raced and current(t, spark) == {"key1": "c-0", "key2": "b-0", "key3": "b-1", "key4": "c-1"}
    assert t.__class__(t.path, "ack").read(spark).count() == 4


def test_pieces_grow_geometrically_and_equal_the_last_write(spark, scratch_dir):
    rng = random.Random(2)
    t = BucketTable(f"{scratch_dir}/t", "ack", buckets=3, keep_commits=2)
    want = {}
    for n in range(14):
        keys = [rng.randrange(40) for _ in range(rng.choice([1, 2, 15]))]
        t.upsert(acks(spark, keys, f"n{n}"), n)
        want |= {f"key{k}": f"n{n}-{i}" for i, k in enumerate(keys)}
        if n % 6 == 5:
            assert current(t, spark) == want
    pieces = t.log.newest(spark).state["pieces"]
    assert all(older[1] > 2 * newer[1] for p in pieces.values() for older, newer in zip(p, p[1:]))
    assert t.compact(spark) and all(len(p) == 1 for p in t.log.newest(spark).state["pieces"].values())
    assert current(t, spark) == want
    t.upsert(acks(spark, [], "none"), 14)
    t.upsert(acks(spark, [1], "last"), 15)
    assert current(t, spark) == want | {"key1": "last-0"}
    kept = {f.split("/")[0] for n in t.log.numbers(spark)[-2:] for p in t.log.read(spark, n).state["pieces"].values() for f, _ in p}
    assert {d for d in os.listdir(t.path) if d.startswith("write=")} == kept


def test_lost_writers_leave_nothing_that_is_read(spark, scratch_dir, monkeypatch):
    t = BucketTable(f"{scratch_dir}/t", "ack", keep_commits=1)
    with pytest.raises(FileNotFoundError):
        t.read(spark)
    t.upsert(acks(spark, [1], "a"), 0)
    monkeypatch.setattr(CommitLog, "append", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        t.upsert(acks(spark, [1, 2], "b"), 1)
    monkeypatch.undo()
    assert current(t, spark) == {"key1": "a-0"}
    t.upsert(acks(spark, [1, 2], "b"), 1)  # the restarted driver replays the batch
    t.upsert(acks(spark, [3], "c"), 2)
    assert current(t, spark) == {"key1": "b-0", "key2": "b-1", "key3": "c-0"}
    assert len([d for d in os.listdir(t.path) if d.startswith("write=")]) == 2  # the lost one's folder is gone


def test_commit_files_are_written_once(spark, scratch_dir, monkeypatch):
    path = f"{scratch_dir}/x/000.json"
    assert write_once(spark, path, "one") and not write_once(spark, path, "two")
    assert commit_log.read_file(spark, path) == "one" and sorted(n for n in os.listdir(f"{scratch_dir}/x") if not n.endswith(".crc")) == ["000.json"]
    monkeypatch.setattr(commit_log, "KEPT", 3)
    log = CommitLog(f"{scratch_dir}/t")
    commit = log.newest(spark)
    for n in range(6):
        assert log.append(spark, commit := commit.next("r", n, {"n": n}))
    assert log.numbers(spark) == [3, 4, 5] and log.newest(spark) == Commit(5, {"r": 5}, {"n": 5})
    assert not log.append(spark, Commit(2)) and not log.append(spark, Commit(5)) and not log.append(spark, Commit(7))
