"""A queue loses and repeats nothing, whatever fails and whatever comes twice."""

import json
import random

import pytest
from helpers import rows, tokens

from tagloom.operators.features import FeatureConfig
from tagloom.plans import training as tr
from tagloom.sources import message_queue as mq
from tagloom.streaming import annotate as sa
from tagloom.streaming import delivery as dl


def put(queue, name, records):
    """A producer's segment."""
    lines = "".join(json.dumps({"id": i, "body": b}) + "\n" for i, b in records)
    mq.Folder(str(queue)).write(f"messages/{name}.jsonl", lines.encode())


def sent(spark, queue):
    return rows(mq.waiting(spark, str(queue)), "message_id", "body")


def upper(batch):
    return batch.selectExpr("message_id", "upper(body) AS value")


def run_once(spark, tmp_path, answer=upper, state="state", files=1, delay="1 hour"):
    stream = mq.receive(spark, str(tmp_path / "in"), 0, files)
    query = dl.deliver_once(stream, answer, str(tmp_path / "out"), str(tmp_path / state), delay=delay, poll_seconds=0)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_messages_are_deleted_after_their_answer(spark, tmp_path):
    put(tmp_path / "in", "b", [("1", "x"), ("2", "ü\nline"), (None, "n"), ("3", None)])
    put(tmp_path / "in", "a", [("4", "y")])
    run_once(spark, tmp_path)
    run_once(spark, tmp_path)  # Spark commits a batch to its source when it plans the next one
    assert sorted(sent(spark, tmp_path / "out"), key=str) == sorted([("1", "X"), ("2", "Ü\nLINE"), (None, "N"), ("3", None), ("4", "Y")], key=str)
    put(tmp_path / "in", "c", [("5", "z")])
    run_once(spark, tmp_path)
    run_once(spark, tmp_path)
    assert len(sent(spark, tmp_path / "out")) == 6
    assert not {"a.jsonl", "b.jsonl"} & set(mq.Folder(str(tmp_path / "in")).names("messages"))


@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_replayed_and_reordered(spark, tmp_path, delay):
    rng = random.Random(3)
    records = [(f"r{i}", json.dumps({"t": 1000 + i, "v": i})) for i in range(60)]
    stream = records + rng.sample(records, 40) + rng.sample(records, 25)
    for k in range(0, len(stream), 20):
        part = stream[k : k + 20]
        rng.shuffle(part)
        put(tmp_path / "in", f"{rng.random()}", part)
    run_once(spark, tmp_path, delay=delay)
    assert sent(spark, tmp_path / "out") == sorted((i, b.upper()) for i, b in records)
    # the state is lost and everything comes once more, with one new record
    put(tmp_path / "in", "again", [*records, ("new", json.dumps({"t": 1}))])
    run_once(spark, tmp_path, state="other", delay=delay)
    assert len(sent(spark, tmp_path / "out")) == 61


def test_old_copies_reach_the_ledger(spark, tmp_path):
    """The watermark has passed an id that comes again; state no longer knows it, the ledger does."""
    for name, ids in (("a", ["old"]), ("b", ["new"]), ("c", ["old", "last"])):
        put(tmp_path / "in", name, [(i, i) for i in ids])
        run_once(spark, tmp_path, delay="1 millisecond")
    assert [i for i, _ in sent(spark, tmp_path / "out")] == ["last", "new", "old"]


@pytest.mark.parametrize("where", ["answer", "ids", "commit", "publish", "after"])
def test_killed_anywhere(spark, tmp_path, monkeypatch, where):
    put(tmp_path / "in", "a", [("1", "x"), ("2", "y")])
    put(tmp_path / "in", "b", [("2", "y"), ("3", "z")])
    failed = []

    def failing(original):
        def run(*args, **named):
            if failed:
                return original(*args, **named)
            failed.append(1)
            raise RuntimeError("killed here")

        return run

    answer = upper
    if where == "answer":
        answer = failing(upper)
    elif where == "ids":
        monkeypatch.setattr(dl.mq, "send", failing(mq.send))
    elif where == "commit":
        monkeypatch.setattr(dl, "run_id", failing(dl.run_id))
    elif where == "publish":  # the writer commits in a process of its own: undo its move, then fail
        original = mq.send

        def send(*args, **named):
            original(*args, **named)
            if not failed:
                failed.append(1)
                folder = mq.Folder(str(tmp_path / "out"))
                for name in folder.names("messages"):
                    folder.move(f"messages/{name}", f"staging/{name}")
                raise RuntimeError("killed here")

        monkeypatch.setattr(dl.mq, "send", send)
    else:
        commit = dl.Ledger.commit

        def late(self, *args, **named):
            commit(self, *args, **named)
            if not failed:
                failed.append(1)
                raise RuntimeError("killed here")

        monkeypatch.setattr(dl.Ledger, "commit", late)
    with pytest.raises(Exception, match="killed here"):
        run_once(spark, tmp_path, answer)
    assert len(mq.Folder(str(tmp_path / "in")).names("messages")) == 2  # nothing is deleted before it is answered
    run_once(spark, tmp_path, answer)
    assert sent(spark, tmp_path / "out") == [("1", "X"), ("2", "Y"), ("3", "Z")]


def test_a_reservation_outlives_its_reader(spark, tmp_path):
    options = {"path": str(tmp_path), "wait": "0", "filesperbatch": "2"}
    for name in ("a", "b", "c"):
        put(tmp_path, name, [(name, name)])
    first = mq.QueueReader(options)
    start = first.initialOffset()
    end = first.latestOffset()
    names = [p.name for p in first.partitions(start, end)]
    put(tmp_path, "0", [("0", "0")])  # arrives before the restart and sorts first
    second = mq.QueueReader(options)
    assert [p.name for p in second.partitions(start, end)] == names == ["a.jsonl", "b.jsonl"]
    later = second.latestOffset()
    assert [p.name for p in second.partitions(end, later)] == ["0.jsonl", "c.jsonl"]
    assert second.latestOffset() == later  # nothing new
    second.commit(end)
    second.commit(end)
    assert mq.Folder(str(tmp_path)).names("messages") == ["0.jsonl", "c.jsonl"]
    third = mq.QueueReader(options)
    assert third.initialOffset() == end and [p.name for p in third.partitions(end, later)] == ["0.jsonl", "c.jsonl"]
    third.commit(later)
    assert mq.QueueReader(options).latestOffset() == later


def test_long_poll_waits_for_a_message(tmp_path):
    import threading
    import time

    reader = mq.QueueReader({"path": str(tmp_path), "wait": "20"})
    timer = threading.Timer(0.6, put, (tmp_path, "a", [("1", "x")]))
    began = time.monotonic()
    timer.start()
    assert reader.latestOffset() == {"reserved": 1} and 0.5 < time.monotonic() - began < 10


def test_an_entry_is_sent_once(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "message_id string, body string").repartition(2)
    for _ in range(3):
        mq.send(df, str(tmp_path), "message_id", "body", "w/7")
    assert sent(spark, tmp_path) == [("1", "a"), ("2", "b")]
    assert mq.Folder(str(tmp_path)).names("staging") == []
    mq.send(df.limit(0), str(tmp_path), "message_id", "body")
    assert len(sent(spark, tmp_path)) == 2 and sent(spark, tmp_path / "none") == []


def test_compacted_ledger(spark, tmp_path, monkeypatch):
    ledger = dl.Ledger(str(tmp_path), "w")

    def known():
        return rows(ledger.answered(spark), "id")

    for k in range(5):
        df = spark.createDataFrame([(f"{k}", f"{k}")], "message_id string, value string")
        ledger.commit(df, df.select("message_id"), ledger.entry("run", k))
    everything = [(f"{k}",) for k in range(5)]
    assert known() == everything
    with monkeypatch.context() as m:  # killed before the replaced entries are deleted
        m.setattr(ledger.folder, "delete", lambda name: None)
        ledger.compact(spark)
        assert known() == everything and len(ledger.entries()) == 6
    ledger.compact(spark)
    assert known() == everything and len(ledger.entries()) <= 6 and mq.committed(ledger.folder, ledger.entry("run", 4))
    df = spark.createDataFrame([("5", "5")], "message_id string, value string")
    ledger.commit(df, df.select("message_id"), ledger.entry("run", 5))
    ledger.compact(spark)
    assert known() == [*everything, ("5",)] and len(sent(spark, tmp_path)) == 6
    ledger.commit(df, df.select("message_id"), ledger.entry("run", 6))
    ledger.compact(spark, keep_days=0)  # forgets all but the last entry's
    assert known() == [("5",)]


def test_annotated_between_queues(spark, tmp_path):
    people = [[("Ann", "U-PPL"), ("met", "O"), ("Acme", "O"), (".", "O")], [("Bob", "U-PPL"), ("ran", "O"), (".", "O")]]
    tagger = tr.train(tokens(spark, people * 10), FeatureConfig(), name="PPL", buckets=1 << 10, max_iter=20)
    schema = "id LONG, DETAIL STRUCT<content: STRING>"
    texts = ["Ann met Acme.", "Bob ran.", "", "Ann met Acme."]
    records = [(f"m{i}", json.dumps({"id": i, "DETAIL": {"content": t}})) for i, t in enumerate(texts)]
    put(tmp_path / "in", "a", records[:3])
    put(tmp_path / "in", "b", records[1:])
    put(tmp_path / "in", "c", [("bad", "no json")])
    for delay, out in (("1 day", "out"), (None, "out2")):
        source = tmp_path / "in"
        if out == "out2":  # the first run took the messages
            source = tmp_path / "in2"
            put(source, "a", records), put(source, "b", [*records[2:], ("bad", "no json")])
        query = sa.annotate_queue(
            spark, str(source), str(tmp_path / out), tagger, schema, str(tmp_path / f"state-{out}"), delay=delay, available_now=True
        )
        query.awaitTermination()
        batch = spark.createDataFrame(records, "_message_id string, body string").selectExpr("_message_id", f"from_json(body, '{schema}') AS r").select("_message_id", "r.*")
        want = rows(tr.annotate_records(batch, tagger, keep=["_message_id"]))
        got = sent(spark, tmp_path / out)
        assert [g for g in got if g[0] != "bad"] == want and len(got) == 5
