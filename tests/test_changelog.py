"""STR-01: the change log survives a death at any point and costs a batch no more than its rows."""

import random

import pytest
from pyspark.sql import functions as F

from mercato.streaming import jobs as S
from mercato.streaming.changelog import ChangeLog

SCHEMA = "key long, seq long, value string, _deleted boolean"


def _batches(n, size, seed=3):
    r, seq = random.Random(seed), list(range(n * size))
    r.shuffle(seq)  # late changes too
    return [[(r.randrange(40), seq.pop(), f"v{i}", r.random() < 0.2) for i in range(size)] for _ in range(n)]


def _log(spark, path, **how):
    return ChangeLog(spark, str(path), spark.createDataFrame([], SCHEMA).schema, **how)


def _want(batches):
    last = {}
    for key, seq, value, deleted in sorted((c for b in batches for c in b), key=lambda c: c[1]):
        last[key] = (seq, value, deleted)
    return {k: v[:2] for k, v in last.items() if not v[2]}


def _rows(log):
    rows = log.current().collect()
    assert len({r.key for r in rows}) == len(rows)
    return {r.key: (r.seq, r.value) for r in rows}


class Death(Exception):
    pass


@pytest.mark.parametrize("dies_in", ["log", "base", "before commit", "while committing"])
def test_a_death_loses_no_key(spark, tmp_path, monkeypatch, dies_in):
    batches = _batches(6, 30)
    log = _log(spark, tmp_path, most_logs=2)
    for i, b in enumerate(batches[:4]):
        log.apply(spark.createDataFrame(b, SCHEMA), i)
    before = _rows(log)
    assert before == _want(batches[:4])
    with monkeypatch.context() as m:
        if dies_in in ("log", "base"):
            written = ChangeLog._written

            def broken(self, rows, folder):
                if folder.startswith(dies_in):
                    # part of the folder is there when the job dies
                    rows.limit(3).write.mode("overwrite").parquet(f"{self.path}/{folder}")
                    raise Death
                return written(self, rows, folder)

            m.setattr(ChangeLog, "_written", broken)
        elif dies_in == "before commit":
            m.setattr(ChangeLog, "_commit", lambda self, state: (_ for _ in ()).throw(Death))
        else:
            def cut(spark, path, text):
                with open(f"{path}.part", "w") as f:
                    f.write(text[:5])
                raise Death
            m.setattr("mercato.streaming.changelog.folders.put_text", cut)
        with pytest.raises(Death):
            for i in (4, 5):
                log.apply(spark.createDataFrame(batches[i], SCHEMA), i)
    after_death = _rows(_log(spark, tmp_path))
    done = log.state()["batch"]
    assert after_death == _want(batches[:done + 1])  # the last commit, whole
    restarted = _log(spark, tmp_path, most_logs=2)
    for i in range(done, 6):  # the last committed batch is replayed too
        restarted.apply(spark.createDataFrame(batches[i], SCHEMA), i)
    assert _rows(restarted) == _want(batches)


def test_a_small_batch_leaves_the_base_alone(spark, tmp_path):
    log = _log(spark, tmp_path)
    log.apply(spark.range(1000).select(F.col("id").alias("key"), F.col("id").alias("seq"), F.lit("x").alias("value"), F.lit(False).alias("_deleted")), 0)
    base = log.state()["base"]
    stamp = {f: f.stat().st_mtime_ns for f in (tmp_path / base).iterdir()}
    for i in range(1, 6):
        log.apply(spark.createDataFrame([(i, 10_000 + i, "new", i == 3)], SCHEMA), i)
    s = log.state()
    assert s["base"] == base and len(s["logs"]) == 5 and s["log_rows"] == 5
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / base).iterdir()} == stamp
    rows = _rows(log)
    assert len(rows) == 999 and rows[2] == (10_002, "new") and 3 not in rows


def test_rewrites_grow_with_the_rows_not_with_the_batches(spark, tmp_path, monkeypatch):
    written, sizes = ChangeLog._written, []

    def counted(self, rows, folder):
        n = written(self, rows, folder)
        if folder.startswith("base"):
            sizes.append(n)
        return n

    monkeypatch.setattr(ChangeLog, "_written", counted)
    log = _log(spark, tmp_path)
    for i in range(24):
        log.apply(spark.createDataFrame([(20 * i + j, 20 * i + j, "v", False) for j in range(20)], SCHEMA), i)
    assert _rows(log).keys() == set(range(480)) and len(sizes) < 12 and sum(sizes) < 4 * 480


def test_vacuum_drops_what_no_late_commit_lists(spark, tmp_path):
    batches = _batches(6, 20)
    log = _log(spark, tmp_path, most_logs=1)
    for i, b in enumerate(batches):
        log.apply(spark.createDataFrame(b, SCHEMA), i)
    (tmp_path / "log" / "batch=000000000009").mkdir()  # of a batch under way
    gone = log.vacuum()
    assert gone and _rows(log) == _want(batches)
    assert len(log._commits()) == 2 and (tmp_path / "log" / "batch=000000000009").exists()
    assert log.vacuum() == []


def test_stream_equals_the_batch_semantics(spark, tmp_path):
    d, target = tmp_path / "feed", str(tmp_path / "t")
    schema = "seq long, op string, key long, value string"
    for i, b in enumerate(_batches(5, 25)):
        spark.createDataFrame([(s, "delete" if x else "upsert", k, v) for k, s, v, x in b], schema).coalesce(1).write.parquet(f"{d}/b={i}")
    feed = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(d)).select("key", "seq", "op", "value")
    for _ in range(2):  # the second run finds nothing new
        S.cdc_apply_stream(feed(), target, most_logs=2)
        want = S.cdc_state(spark.read.schema(schema).parquet(str(d)).select("key", "seq", "op", "value"))
        assert sorted(S.cdc_current(spark, target).collect()) == sorted(want.collect())
