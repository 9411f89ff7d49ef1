"""Job snapshots: a plain state machine, the batch form and the streaming form."""

import random

import pytest
from sievework.operators.progress import job_snapshots
from sievework.streaming.progress import EVENT_SCHEMA, latest_snapshots, start_job_snapshots


def by_hand(events):
    jobs = {}
    for job, seq, kind, total, processed, stage, summary, message in sorted(events, key=lambda e: e[1]):
        s = jobs.setdefault(job, dict(status="queued", stage="", processed=0, total=0, summary="", error=""))
        if kind == "total":
            s["total"] = total
        elif kind == "progress":
            s.update(status="running", stage=stage, processed=processed)
        elif kind == "done":
            s.update(status="done", processed=s["total"], summary=summary)
        else:
            s.update(status="error", error=message)
    for s in jobs.values():
        s["pct"] = round(s["processed"] / s["total"] * 100, 1) if s["total"] else 0.0
    return jobs


def random_events(n, jobs, seed, hot_share=0.4):
    rng = random.Random(seed)
    events = []
    for seq in range(n):
        job = 0 if rng.random() < hot_share else rng.randrange(jobs)
        kind = rng.choices(["total", "progress", "done", "error"], [2, 8, 1, 1])[0]
        events.append(
            (
                job,
                seq,
                kind,
                rng.randint(0, 300) if kind == "total" else None,
                rng.randint(0, 300) if kind == "progress" else None,
                f"Stage {rng.randint(1, 2)}" if kind == "progress" else None,
                f"sum {seq}" if kind == "done" else None,
                f"err {seq}" if kind == "error" else None,
            )
        )
    return events


def as_dicts(rows):
    return {r["job_id"]: {k: v for k, v in r.asDict().items() if k != "job_id"} for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_form(spark, seed):
    events = random_events(900, 60, seed)
    df = spark.createDataFrame(random.Random(seed).sample(events, len(events)), EVENT_SCHEMA).repartition(5)
    assert as_dicts(job_snapshots(df).collect()) == by_hand(events)


def test_total_after_done_does_not_count(spark):
    events = [(1, 0, "total", 10, None, None, None, None), (1, 1, "done", None, None, None, "s", None), (1, 2, "total", 20, None, None, None, None),
              (2, 0, "done", None, None, None, "s", None), (2, 1, "total", 5, None, None, None, None), (3, 0, "total", 4, None, None, None, None)]
    found = as_dicts(job_snapshots(spark.createDataFrame(events, EVENT_SCHEMA)).collect())
    assert found == by_hand(events)
    assert (found[1]["processed"], found[2]["processed"], found[3]["status"]) == (10, 0, "queued")


def test_optional_columns(spark):
    df = spark.createDataFrame([(1, 0, "error", None, None, None)], "job_id long, seq long, kind string, total long, processed long, stage string")
    assert job_snapshots(df).first()["error"] == ""


def stream(spark, parts, folder):
    """Snapshots after each part, which the query meets as one micro-batch after a restart; the first part as several."""
    source, checkpoint, out = (str(folder / n) for n in ("events", "checkpoint", "out"))
    for i, part in enumerate(parts):
        spark.createDataFrame(part, EVENT_SCHEMA).coalesce(2).write.mode("append").parquet(source)
        start_job_snapshots(spark.readStream.schema(EVENT_SCHEMA).parquet(source), out, checkpoint).awaitTermination()
        yield as_dicts(latest_snapshots(spark, out).collect()), spark.read.parquet(out + "/snapshots").filter(f"batch = {i}").count()


@pytest.mark.parametrize("seed", [5, 6])
def test_streaming_form_equals_the_batch_form_for_any_split_and_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    events = random_events(500, 15, seed)
    rng.shuffle(events)  # late events of every kind, late 'done' between totals already seen
    cuts = sorted(rng.sample(range(1, 500), 3))
    parts = [events[a:b] for a, b in zip([0, *cuts], [*cuts, 500], strict=True)]
    seen = []
    for part, (found, written) in zip(parts, stream(spark, parts, tmp_path), strict=True):
        seen += part
        assert found == by_hand(seen)
        assert written == len({e[0] for e in part})  # touched jobs only


def test_a_done_event_that_comes_late_finds_its_total(spark, tmp_path):
    def event(seq, kind, total=None):
        return (1, seq, kind, total, None, None, "s" if kind == "done" else None, None)

    parts = [[event(2, "total", 100), event(4, "total", 200)], [event(3, "done")], [event(1, "total", 7)], [event(5, "done"), event(9, "total", 50)], [event(7, "total", 60)]]
    found = [f[1] for f, _ in stream(spark, parts, tmp_path)]
    assert [(r["processed"], r["total"], r["pct"]) for r in found] == [(0, 200, 0.0), (100, 200, 50.0), (100, 200, 50.0), (200, 50, 400.0), (200, 50, 400.0)]
