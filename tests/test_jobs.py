"""Parse jobs: each batch once, also after it was broken off; actions, progress, missing and damaged files."""

import json

import pytest
from pyspark.sql import functions as F

from pagemill.sources import warc
from pagemill.streaming import jobs

WHEN = "2024-01-01"


def message(tmp_path, name, files, **more):
    lines = [json.dumps({"id": f"{name}{k}", "source": s, "crawl_id": "c", "user_id": "u", "actions": [{"type": "index", "queue": "q1"}, {"type": "store", "queue": "q2"}]} | more) for k, s in enumerate(files)]
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / f"{name}.json").write_text("\n".join(lines))


def files(tmp_path):
    page = lambda i: warc.write_record(f"http://h/{i}", b"<title>t%d</title><p>text</p>" % i)
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc").write_bytes(page(1) + page(2) + warc.write_record("http://h/x.bin", b"\x00\x01", mime="application/zip"))
    (tmp_path / "w/b.warc").write_bytes(page(3) + b"rubbish\r\n\r\n" + page(4))
    return [str(tmp_path / "w/a.warc"), str(tmp_path / "w/b.warc")]


def run(spark, tmp_path):
    jobs.start(jobs.messages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "checkpoint"), F.lit(WHEN).cast("timestamp")).awaitTermination()


def test_a_batch_that_breaks_off_is_done_once(spark, tmp_path, monkeypatch):
    a, b = files(tmp_path)
    message(tmp_path, "m", [a, b, str(tmp_path / "w/none.warc"), None])
    whole = jobs.follow_ups

    def broken(*args):
        raise OSError("killed")

    monkeypatch.setattr(jobs, "follow_ups", broken)
    with pytest.raises(Exception):
        run(spark, tmp_path)
    assert not (tmp_path / "out/actions").exists() and (tmp_path / "out/index").exists()
    monkeypatch.setattr(jobs, "follow_ups", whole)
    for _ in range(2):  # the second start finds nothing new
        run(spark, tmp_path)
    out = str(tmp_path / "out")
    actions = spark.read.json(f"{out}/actions").collect()
    assert sorted((r.id, r.position, r.type, r.queue) for r in actions) == [(f"m{k}", p, t, q) for k in range(3) for p, (t, q) in enumerate((("index", "q1"), ("store", "q2")))]
    assert all(spark.read.text(r["index"]).count() == 8 and spark.read.text(r["graph"]).count() == 4 for r in actions[:1])
    assert jobs.statuses(spark, out).count() == 4
    assert {(r.source, r.error) for r in spark.read.json(f"{out}/failed").collect()} == {(warc.FALLBACK, "damaged record")}
    assert [r.source for r in spark.read.json(f"{out}/missing").collect()] == [f"file://{tmp_path}/w/none.warc"]
    p = jobs.progress(spark, out, waiting_bytes=1000).first()
    assert (p.batches, p.files, p.records, p.damaged) == (1, 2, 6, 1) and p.bytes > 0 and p.remaining_seconds > 0


def test_files_in_several_steps(spark, tmp_path, monkeypatch):
    a, b = files(tmp_path)
    message(tmp_path, "m", [a, b, a])
    monkeypatch.setattr(jobs, "FILES_AT_ONCE", 1)
    run(spark, tmp_path)
    message(tmp_path, "n", [b], actions=None)
    run(spark, tmp_path)
    out = str(tmp_path / "out")
    assert spark.read.parquet(f"{out}/raw").groupBy("batch").count().orderBy("batch").collect()[0]["count"] == 6
    p = jobs.progress(spark, out).first()
    assert (p.batches, p.files, p.records) == (2, 3, 9)
    assert spark.read.json(f"{out}/actions").count() == 6
    assert jobs.statuses(spark, out).count() == 4
