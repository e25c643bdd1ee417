"""Stores of replies, queues, walked chapters and gated streams over outages, restarts and failures, by counting calls."""

import json
import pathlib
import uuid

import pytest

from polyglossa.operators import replies

DONE = {n: [1] for n in ("zh", "en", "ru")}


@pytest.fixture
def service(tmp_path):
    """A responder that counts its calls a prompt in a folder, and fails while a file named after the prompt's mark stands."""
    at = tmp_path / "calls"
    at.mkdir()

    class Service:
        down = at / "down"

        def __call__(self, prompts):
            pathlib.Path(at, f"call-{uuid.uuid4().hex}").write_text(prompts[0])
            if self.down.exists() and any(mark in prompts[0] for mark in self.down.read_text().split()):
                raise TimeoutError("late")
            return [self.answer(p) for p in prompts]

        @staticmethod
        def answer(prompt):
            return f"re: {prompt}"

        @staticmethod
        def calls():
            return sorted(f.read_text() for f in at.glob("call-*"))

    return Service()


def test_failed_requests_are_asked_again(spark, tmp_path, service):
    rows, path = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, prompt string"), f"file://{tmp_path}/replies"
    ask = lambda rows, **o: {r["id"]: (r["reply"], len(r["failures"])) for r in replies.stored_replies(rows, service, path, ["id"], **o).collect()}
    service.down.write_text("b")
    assert ask(rows) == {1: ("re: a", 0), 2: (None, 3), None: ("re: c", 0)}
    service.down.unlink()
    assert ask(rows, in_flight=2) == {1: ("re: a", 0), 2: ("re: b", 0), None: ("re: c", 0)} == ask(rows)
    assert service.calls() == ["a", "b", "b", "b", "b", "c"]
    assert ask(spark.createDataFrame([(1, "changed")], rows.schema)) == {1: ("re: changed", 0)}  # another prompt is another request
    assert ask(rows.where("id = 1"), model="m") == {1: ("re: a", 0)} and service.calls().count("a") == 2  # and so is another model
    assert replies.stored_replies(rows.limit(0), service, f"{path}-none", ["id"]).count() == 0


def test_batches_of_prompts_fall_back_to_single_ones(spark, tmp_path, service):
    service.down.write_text("a")
    rows = spark.createDataFrame([(i, p) for i, p in enumerate("abcd")], "id int, prompt string").coalesce(1)
    got = {r["prompt"]: r["reply"] for r in replies.stored_replies(rows, service, f"file://{tmp_path}/replies", ["id"], batch=2).collect()}
    assert got == {"a": None, "b": "re: b", "c": "re: c", "d": "re: d"}
    assert service.calls() == ["a", "a", "a", "a", "b", "c"]


def test_queue_stops_at_a_failure_and_goes_on_from_there(spark, tmp_path, service):
    rows = spark.createDataFrame([(j, k, f"{j}{k}") for j in "xyz" for k in range(5)], "job string, at int, prompt string").repartition(4)
    run = lambda: replies.queued_replies(rows, service, f"file://{tmp_path}/replies", ["job", "at"], "job", ["at"])
    service.down.write_text("x1 z0")
    states = {r["prompt"]: r["state"] for r in run().collect()}
    assert [states[f"x{k}"] for k in range(5)] == ["done", "failed", "held", "held", "held"]
    assert [states[f"z{k}"] for k in range(5)] == ["failed"] + ["held"] * 4 and {states[f"y{k}"] for k in range(5)} == {"done"}
    assert service.calls() == ["x0", "x1", "x1", "x1", "y0", "y1", "y2", "y3", "y4", "z0", "z0", "z0"]
    service.down.unlink()
    report = {r["job"]: (r["done"], r["held"], r["failed_attempts"], r["status"]) for r in replies.queue_report(run(), "job").collect()}
    assert report == {j: (5, 0, 0, "complete") for j in "xyz"}
    assert len(service.calls()) == 12 + 4 + 5 and service.calls().count("x0") == 1


def paragraphs(spark, chapters, n=5):
    return spark.createDataFrame([(c, lang, p, f"{c}.{lang}{p}") for c in chapters for lang in ("zh", "en", "ru") for p in range(1, n + 1)], "chapter int, lang string, p int, paragraph string")


def test_sequential_alignment_resumes(spark, tmp_path, service):
    service.answer = lambda prompt: json.dumps({"alignments": [DONE, {n: [2] for n in DONE}] if "2: " in prompt else [DONE]})
    p, path = paragraphs(spark, (1, 2)), f"file://{tmp_path}/replies"
    run = lambda p: sorted((r["chapter"], r["g"], r["zh"], r["en"], r["ru"]) for r in replies.sequential_alignment(p, service, path, size=2).collect())
    service.down.write_text("2.zh3")
    whole = [(1, g, [g], [g], [g]) for g in range(1, 6)]
    assert run(p) == whole + [(2, 0, [], [], []), (2, 1, [1], [1], [1]), (2, 2, [2], [2], [2])]
    assert len(service.calls()) == 3 + 1 + 3
    service.down.unlink()
    assert run(p) == whole + [(2, g, [g], [g], [g]) for g in range(1, 6)] == run(p)
    assert len(service.calls()) == 7 + 2  # only what had not been answered
    assert run(paragraphs(spark, (1,), 2)) == whole[:2] and len(service.calls()) == 10  # a changed chapter starts anew


def test_sequential_alignment_of_wrong_replies_and_uneven_sides(spark, tmp_path, service):
    service.answer = lambda prompt: json.dumps({"alignments": [{"zh": [1, 2], "en": [1], "ru": [3]}]})
    run = lambda p, name: sorted((r["chapter"], r["g"]) for r in replies.sequential_alignment(p, service, f"file://{tmp_path}/{name}").collect())
    assert run(paragraphs(spark, (1,)), "wrong") == [(1, 0)] and len(service.calls()) == 3
    service.answer = lambda prompt: "[]"
    assert run(paragraphs(spark, (1,)), "list") == [(1, 0)]
    service.answer = lambda prompt: json.dumps({"alignments": [{n: [1, 2] for n in DONE}, {"zh": [3], "en": [3], "ru": [], "note": "unmatched: none"}]})
    assert run(paragraphs(spark, (1,), 3).where("NOT (lang = 'ru' AND p = 3)"), "note") == [(1, 1), (1, 2)]
    assert run(paragraphs(spark, (1,)).where("lang <> 'ru'"), "missing") == [(1, 0)]
    assert run(paragraphs(spark, (1,)).limit(0), "none") == []


def test_stream_gate_holds_what_follows_a_failure(spark, tmp_path, service):
    schema, told = "job string, seq long, prompt string", []

    def step(rows, mark, pause=None):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in-{pause}")
        service.down.write_text(mark)
        before = len(service.calls())
        stream = replies.gated_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in-{pause}"), service, pause)
        stream.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/state-{pause}").trigger(availableNow=True).foreachBatch(lambda df, i: told.extend(map(tuple, df.collect()))).start().awaitTermination()
        out = sorted(r[:3] for r in told)
        told.clear()
        return out, len(service.calls()) - before

    assert step([("a", 1, "a1"), ("a", 2, "a2"), ("a", 3, "a3"), ("b", 1, "b1")], "a2") == ([("a", 1, "done"), ("a", 2, "failed"), ("a", 3, "held"), ("b", 1, "done")], 5)
    assert step([("a", 4, "a4"), ("b", 2, "b2")], "-") == ([("a", 4, "held"), ("b", 2, "done")], 1)  # the job stays stopped over a restart
    assert step([("a", 0, None)], "-") == ([("a", 2, "done"), ("a", 3, "done"), ("a", 4, "done")], 3)
    assert step([("a", 5, "a5")], "-") == ([("a", 5, "done")], 1)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # else a pause alone starts batch after batch
    try:
        assert step([("c", 1, "c1")], "c1", 1)[0] == [("c", 1, "failed")]
        assert step([("d", 1, "d1")], "-", 1)[0] == [("c", 1, "done"), ("d", 1, "done")]  # asked again after the pause
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
