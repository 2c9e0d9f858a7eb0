"""Batches and streams of commits against a sequential fold."""

import datetime as dt
import random

import pytest

from conftest import rows
from recspark.operators import commits as cm
from recspark.operators import versions as ver
from recspark.streaming.commits import read_rejects, read_versions, stream_apply_commits

T0 = dt.datetime(2024, 1, 1)
CHANGE = "change_id long, vo_id long, ehr_id long, change_type string, preceding_version int, committed_at timestamp_ntz"
HEAD = "vo_id long, ehr_id long, change_id long, sys_version int, sys_period_lower timestamp_ntz"
HISTORY = HEAD + ", sys_period_upper timestamp_ntz, sys_deleted boolean"


def sequential(states, changes):
    """Accepted versions by the batch rules, one object after the other."""
    out = {}
    for vo in {c[1] for c in changes}:
        v, deleted, lower, owner = states.get(vo, (0, False, None, None))
        mine = [c for c in changes if c[1] == vo and (owner is None or c[2] == owner)]
        while True:
            fits = []
            for c in mine:
                p = c[4] or 0
                ok = (c[3] == "creation" and p == 0) or (c[3] in ("modification", "amendment", "deleted") and p > 0)
                if ok and p == v and not (c[3] == "deleted" and deleted):
                    fits.append(c)
            if not fits:
                break
            c = min(fits, key=lambda x: (x[5], x[0]))
            start = c[5] if lower is None or c[5] > lower else lower + dt.timedelta(microseconds=1)
            v, deleted, lower = v + 1, c[3] == "deleted", start
            out[c[0]] = (vo, v, start, deleted)
    return out


def random_changes(rnd, n, objects, first_id=0):
    kinds = ["creation", "modification", "amendment", "deleted", "deleted", "synthesis"]
    out = []
    for i in range(n):
        vo = rnd.choice([1, 1, *range(1, objects)])
        p = rnd.choice([None, 0, *range(1, 12)])
        kind = "creation" if not p and rnd.random() < 0.8 else rnd.choice(kinds)
        out.append((first_id + i, vo, vo % 3, kind, p, T0 + dt.timedelta(seconds=rnd.randrange(50))))
    return out


def empty(spark):
    return spark.createDataFrame([], HEAD), spark.createDataFrame([], HISTORY)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_the_fold(spark, seed):
    rnd = random.Random(seed)
    head, history = empty(spark)
    states, first, all_versions = {}, 0, {}
    for _ in range(2):
        changes = random_changes(rnd, 250, 12, first)
        first += 1000
        expected = sequential(states, changes)
        done = cm.apply_commits(head, history, spark.createDataFrame(changes, CHANGE))
        got = {r.change_id: (r.vo_id, r.sys_version, r.sys_period_lower, r.sys_deleted) for r in done.accepted.collect()}
        assert got == expected
        refused = [r.change_id for r in done.rejects.select("change_id").collect()]
        assert sorted(refused + list(got)) == sorted(c[0] for c in changes)
        for vo, v, start, deleted in sorted(expected.values(), key=lambda x: x[1]):
            states[vo] = (v, deleted, start, vo % 3)
            all_versions[(vo, v)] = (start, deleted)
        head, history = spark.createDataFrame(done.head.collect(), HEAD), spark.createDataFrame(done.history.collect(), HISTORY)
        table = ver.all_versions(head, history)
        assert {(r.vo_id, r.sys_version): (r.sys_period_lower, r.sys_deleted) for r in table.collect()} == all_versions
        for r in table.collect():
            nxt = all_versions.get((r.vo_id, r.sys_version + 1))
            assert r.sys_period_upper == (nxt[0] if nxt else None)


def test_stream_equals_the_fold_over_batches(spark, tmp_path):
    rnd = random.Random(5)
    states, expected, total = {}, {}, 0
    arriving, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = spark.createDataFrame([], CHANGE).schema
    for i in range(3):
        changes = random_changes(rnd, 120, 8, i * 1000)
        total += len(changes)
        spark.createDataFrame(changes, CHANGE).coalesce(1).write.mode("append").parquet(arriving)
        stream_apply_commits(spark.readStream.schema(schema).parquet(arriving), state, buckets=4)
        for cid, (vo, v, start, deleted) in sorted(sequential(states, changes).items(), key=lambda x: x[1][1]):
            states[vo] = (v, deleted, start, vo % 3)
            expected[cid] = (vo, v, start, deleted)
    got = read_versions(spark, state, schema)
    assert {r.change_id: (r.vo_id, r.sys_version, r.sys_period_lower, r.sys_deleted) for r in got.collect()} == expected
    assert got.count() + read_rejects(spark, state, schema).count() == total


def test_deltas_add_up(spark):
    """Batch by batch, the deltas lead to the same table as applying to the whole one; the history is never read."""
    rnd = random.Random(9)
    head, history = spark.createDataFrame([], HEAD), spark.createDataFrame([], HISTORY)
    latest = spark.createDataFrame([], head.select("vo_id", "ehr_id", "sys_version", "sys_period_lower").schema.add("sys_deleted", "boolean"))
    kept = {}
    for i in range(3):
        changes = spark.createDataFrame(random_changes(rnd, 80, 6, i * 1000), CHANGE)
        delta = cm.commit_delta(head, latest, changes, history.columns)
        done = cm.apply_commits(head, history, changes, latest)
        for r in delta.ended.collect():
            kept[r.vo_id, r.sys_version] = r.sys_period_upper
        for r in [*delta.closed.collect(), *delta.history.collect()]:
            kept[r.vo_id, r.sys_version] = r.sys_period_upper
        whole = cm.apply_commits(head, history, changes)
        assert rows(done.head) == rows(whole.head) and rows(done.history) == rows(whole.history) and rows(done.rejects) == rows(whole.rejects)
        newest = {r.vo_id: r for r in latest.collect()} | {r.vo_id: r for r in delta.latest.collect()}
        head, history = spark.createDataFrame(whole.head.collect(), HEAD), spark.createDataFrame(whole.history.collect(), HISTORY)
        latest = spark.createDataFrame(list(newest.values()), latest.schema)
        assert {(r.vo_id, r.sys_version): r.sys_period_upper for r in history.collect()} == kept
        assert rows(latest) == rows(ver.latest_version(ver.all_versions(head, history)).select(*latest.columns))


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    """A micro-batch on one object leaves the files of the other buckets alone and drops no generation still in use."""
    import os

    arriving, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = spark.createDataFrame([], CHANGE).schema
    batches = [[(i, i, 1, "creation", None, T0) for i in range(1, 40)]] + [[(100 + v, 7, 1, "modification", v, T0 + dt.timedelta(days=v))] for v in (1, 2, 3)]
    seen = []
    for batch in batches:
        spark.createDataFrame(batch, CHANGE).coalesce(1).write.mode("append").parquet(arriving)
        stream_apply_commits(spark.readStream.schema(schema).parquet(arriving), state, buckets=8)
        seen.append({b: sorted(os.listdir(f"{state}/latest/{b}")) for b in os.listdir(f"{state}/latest") if b.startswith("bucket=")})
    changed = {b for b in seen[0] if seen[0][b] != seen[-1][b]}
    assert len(seen[0]) == 8 and len(changed) == 1 and seen[-1][changed.pop()] == ["upto=2", "upto=3"]
    got = read_versions(spark, state, schema)
    assert got.count() == 42 and got.filter("is_head").count() == 39


def test_late_commits_are_refused(spark, tmp_path):
    arriving, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = spark.createDataFrame([], CHANGE).schema
    day = dt.timedelta(days=1)
    for batch in (
        [(1, 1, 1, "creation", None, T0 + 10 * day), (2, 2, 1, "creation", None, T0)],
        [(3, 1, 1, "modification", 1, T0 + 9 * day), (4, 2, 1, "modification", 1, T0 + day)],
    ):
        spark.createDataFrame(batch, CHANGE).coalesce(1).write.mode("append").parquet(arriving)
        stream_apply_commits(spark.readStream.schema(schema).parquet(arriving), state, max_delay="2 DAYS")
    got = {r.change_id: r.sys_period_lower for r in read_versions(spark, state, schema).collect()}
    # the second version of object 1 is older than the first: it starts one microsecond after it
    assert got == {1: T0 + 10 * day, 2: T0, 3: T0 + 10 * day + dt.timedelta(microseconds=1)}
    assert [(r.change_id, r.reason) for r in read_rejects(spark, state, schema).collect()] == [(4, "too late")]


def test_optimistic_check_cases(spark):
    head = spark.createDataFrame([(1, 7, 0, 3, T0)], HEAD)
    owners = spark.createDataFrame([(7,), (8,)], "ehr_id long")
    cases = [
        ("unknown owner", 1, 99, 3, "s", 1), ("unknown object", 2, 7, 3, "s", 2), ("wrong id", 1, 7, 3, "s", 5),
        ("wrong system", 1, 7, 3, "x", 1), ("not the latest version", 1, 7, 2, "s", 1), (None, 1, 7, 3, "s", 1),
    ]
    df = spark.createDataFrame([(i, c[1], c[2], c[3], c[4], c[5]) for i, c in enumerate(cases)],
                               "change_id long, vo_id long, ehr_id long, preceding_version int, preceding_system string, preceding_vo_id long")
    got = dict(rows(cm.reject_stale(df, head, owners, "s").select("change_id", "reason")))
    assert got == {i: c[0] for i, c in enumerate(cases)}


def test_modifiable_gate(spark):
    status = spark.createDataFrame([(1, True), (2, False)], "ehr_id long, is_modifiable boolean")
    data = [
        (10, 1, 1, "composition", None, True), (10, 2, 1, "status", False, True), (10, 3, 1, "composition", None, False),
        (20, 1, 2, "composition", None, False), (20, 2, 2, "status", True, True), (20, 3, 2, "folder", None, True),
        (30, 1, 9, "composition", None, False),
    ]
    df = spark.createDataFrame([d[:5] for d in data], "contribution_id long, position int, ehr_id long, kind string, new_modifiable boolean")
    for limit in (None, 1):
        got = rows(cm.reject_unmodifiable(df, status, limit).select("contribution_id", "position", "allowed"))
        assert got == sorted([(d[0], d[1], d[5]) for d in data], key=repr)


def test_strict_times_is_the_fold(spark):
    rnd = random.Random(11)
    data = [(vo, v, T0 + dt.timedelta(microseconds=rnd.randrange(3000))) for vo, n in ((1, 2500), (2, 3)) for v in range(1, n + 1)]
    got = {(r[0], r[1]): r[2] for r in ver.strict_times(spark.createDataFrame(data, "vo_id int, sys_version int, sys_period_lower timestamp_ntz")).collect()}
    for vo in (1, 2):
        last = None
        for _, v, t in sorted(x for x in data if x[0] == vo):
            last = t if last is None or t > last else last + dt.timedelta(microseconds=1)
            assert got[(vo, v)] == last


def test_version_at_keys_with_small_groups(spark, tables):
    v = tables.versions.limit(200).cache()
    keys = v.selectExpr("audit_id AS asked", "vo_id", "sys_period_lower + INTERVAL 20 HOURS AS at")
    plain = ver.version_at_keys(v, keys).select("asked", "sys_version")
    sliced = ver.version_at_keys(v, keys, limit=5).select("asked", "sys_version")
    assert rows(plain) == rows(sliced)
