"""Every command of the command line once, on small folders, with a made responder, recogniser and site."""

import json

import pytest
from pyspark.sql import functions as F

from polyglossa import __main__ as cli
from polyglossa.functions import images
from polyglossa.operators import requests
from polyglossa.sources import web
from tests.test_sources import archive


def answer(prompts):
    """A reply that fits any of the commands' prompts."""
    one = {"zh": [1], "en": [1], "ru": [1], "note": ""}
    return [json.dumps({"alignments": [one], "findings": [{"unit": 1, "type": "omission", "severity": "low", "reason": "r"}], "items": [{"id": 1, "verdict": "leave_as_is"}]}) for _ in prompts]


@pytest.fixture
def run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(requests, "http_responder", lambda *a, **o: answer)
    at = tmp_path / "data"
    at.mkdir()

    def command(name, **options):
        out = options.setdefault("out", f"file://{tmp_path}/{name}") if "out" in str(cli.COMMANDS[name][1]) else None
        cli.main([name, *(x for k, v in options.items() if v is not None for x in (f"--{k.replace('_', '-')}", str(v)))])
        return [r.asDict() for r in spark.read.parquet(f"{out}/result").collect()] if out else None

    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"file://{at}/{name}")
        return f"file://{at}/{name}"

    command.table, command.at, command.ran = table, at, set()
    return command


def test_commands_on_archives_texts_and_pages(spark, run, capsys):
    (run.at / "e").mkdir()
    (run.at / "e" / "x.epub").write_bytes(archive())
    run("inspect", path=f"file://{run.at}/e")
    assert "One" in capsys.readouterr().out
    assert [r["title"] for r in run("extract", path=f"file://{run.at}/e", count=1, start=2)] == ["Two"]
    for n in ("zh", "en", "ru"):
        (run.at / n).mkdir()
        (run.at / n / "0001_a.txt").write_text(f"Chapter 1: x\n\n{n} text [1].\n")
    assert run("import-text", path=f"file://{run.at}/en", language="en", label="l")[0]["chapter_count"] == 1
    folders = {n: f"file://{run.at}/{n}" for n in ("zh", "en", "ru")}
    assert [r["chapter"] for r in run("align-chapters", **folders)] == [1]
    (run.at / "glossary.json").write_text(json.dumps([{"zh": "甲", "en": "a", "ru": "б"}]))
    assert "alignments" in run("translate-sample", zh=folders["zh"], en=folders["en"], glossary=f"file://{run.at}/glossary.json", model="m")[0]["translation"]
    (run.at / "img").mkdir()
    (run.at / "img" / "p1.png").write_bytes(images.write_png(images.np.full((40, 40), 255, "uint8")))
    tool = run.at / "tool"
    tool.write_text("#!/bin/sh\ncat > /dev/null\necho Привет мир\n")
    tool.chmod(0o755)
    assert run("ocr", path=f"file://{run.at}/img", executable=tool)[0]["body"] == "Привет мир\n"
    pages = run.table("pages", [("p1.txt", "p1", "а\nб\n"), ("p2.txt", "p2", "в\n")], "page string, stem string, body string")
    assert [r["draft_line"] for r in sorted(run("assemble-ocr-chapter", path=pages, first="p1", last="p2", title="t"), key=lambda r: r["draft_line"])] == [3, 4, 6]
    drafts = run.table("drafts", [(1, "KOT-\nа\nPas")], "chapter int, body string")
    found = run("clean-ocr-chapter", path=drafts)
    assert found and all(r["reasons"] for r in found)
    told = run("review-ocr-candidates", path=drafts, model="m")
    assert len(told) == len(found) and told[0]["verdict"] in ("leave_as_is", None)
    candidates = run.table("candidates", [(1, 1, "x")], "chapter int, id int, cleaned string")
    replies = run.table("replies", [(1, answer([""])[0])], "chapter int, reply string")
    decisions = run.table("ocr-decisions", [(1, 1, "approved", 1)], "chapter int, id int, decision string, at int")
    assert [(r["verdict"], r["decision"]) for r in run("review-ocr", candidates=candidates, replies=replies, decisions=decisions)] == [("leave_as_is", "approved")]


def test_commands_on_paragraphs_and_units(spark, run):
    rows = [(1, n, p, f"{n} {p} word") for n in ("zh", "en", "ru") for p in (1, 2)]
    paragraphs = run.table("paragraphs", rows, "chapter int, lang string, p int, paragraph string")
    left, right = (run.table(n, [r for r in rows if r[1] == n], "chapter int, lang string, p int, paragraph string") for n in ("en", "ru"))
    assert {tuple(r["left"]) for r in run("embed-align-pair", left=left, right=right)} <= {(1,), (2,), (1, 2)}
    assert sum(len(r["left"]) for r in run("gap-align-pair", left=left, right=right)) == 2
    assert run("window-align", paragraphs=paragraphs, model="m")[0]["alignment"][0]["zh"] == [1]
    assert sorted(r["g"] for r in run("sequential-align", paragraphs=paragraphs, model="m")) == [1, 2]
    groups = run.table("groups", [(1, 1, [1], [1], 0.9), (1, 2, [2], [2], 0.1)], "chapter int, g int, left array<int>, right array<int>, similarity double")
    gates = run("validate-pair", groups=groups)
    assert [(r["status"], r["first_suspect_group"]) for r in gates] == [("review_required", 2)]
    gate = run.table("gates", [(1, "review_required", 2)], "chapter int, status string, first_suspect_group int")
    verdict = run.table("verdicts", [(1, '{"status":"confirmed"}')], "chapter int, reply string")
    assert run("review-boundary", gates=gate, replies=verdict)[0]["verdict"] == "confirmed"
    zh_en = run.table("zh_en", [(1, 1, [1], [1]), (1, 2, [2], [2])], "chapter int, g int, left array<int>, right array<int>")
    for name in ("audit-units", "audit-units-with-extras"):
        assert run(name, zh_en=zh_en, en_ru=zh_en, paragraphs=paragraphs, model="m")[0]["type"] == "omission"
    flat = run.table("windows", [(1, 0, 1, [{"zh": [1], "en": [1], "ru": [1]}])], "chapter int, window int, offset int, alignment array<struct<zh:array<int>,en:array<int>,ru:array<int>>>")
    assert run("audit-windows", windows=flat, paragraphs=paragraphs, model="m")[0]["type"] == "omission"
    assert run("audit-paragraphs", paragraphs=paragraphs, model="m")[0]["type"] == "omission"
    findings = run.table("findings", [(1, 0, 1), (1, 0, 2)], "chapter int, window int, unit int")
    decided = run.table("decisions", [(1, 0, 1, "approved", 1)], "chapter int, window int, unit int, decision string, at int")
    assert [r["unit"] for r in run("pending", findings=findings, decisions=decided)] == [2]


def test_commands_on_the_net_and_on_progress(spark, run, monkeypatch, capsys):
    monkeypatch.setattr(web.crawl, "__defaults__", (lambda url: f'<article class="reeder_chapter_article"><p>{"word " * 150}</p></article>', *web.crawl.__defaults__[1:]))
    assert [r["url"] for r in run("download", url="https://a.b/chapter-1", count=1)] == ["https://a.b/chapter-1"]
    for wrong in (["--count", "0"], ["--delay", "1", "--count", "1"]):
        with pytest.raises(SystemExit):
            cli.main(["download", "--url", "u", "--out", "o", *wrong])
    (run.at / "job").mkdir()
    (run.at / "job" / "progress.json").write_text('{"status":"running"}')
    run("monitor", path=f"file://{run.at}")
    assert '"status":"running"' in capsys.readouterr().out
    assert len(cli.COMMANDS) == 23


def test_service_health(monkeypatch):
    import io
    import urllib.request

    monkeypatch.setattr(urllib.request, "urlopen", lambda *a, **o: io.BytesIO(b'{"models":[{"name":"m"}]}'))
    assert requests.service_health() == {"models": ["m"]}

    def down(*a, **o):
        raise OSError("refused")

    monkeypatch.setattr(urllib.request, "urlopen", down)
    assert requests.service_health() == {"error": "refused"}


def test_batch_sink_replays_a_batch_without_change(spark, tmp_path):
    from polyglossa.sources import files

    sink, rows = files.batch_sink(f"file://{tmp_path}/out"), spark.createDataFrame([("a", 1), ("b", 2)], "job string, seq int")
    for batch in (0, 1, 1, 0):
        sink(rows.withColumn("seq", F.col("seq") + batch), batch)
    out = spark.read.json(f"file://{tmp_path}/out").drop("batch")
    assert sorted((r["job"], r["seq"]) for r in out.collect()) == [("a", 1), ("a", 2), ("b", 2), ("b", 3)]
    assert {(r["job"], r["seq"]) for r in files.latest_progress(out).collect()} == {("a", 2), ("b", 3)}


def test_admission_and_context(spark):
    from polyglossa.operators import review

    glossary = spark.createDataFrame([("甲", "Klein", "Клейн")], "zh string, en string, ru string")
    rows = [(1, "Klein left.", "Клейн ушёл."), (2, "Klein left.", "Он ушёл"), (3, "x", "Он [1] ушёл. «Да"), (None, None, " "), (4, "Klein", "«Клейн».\n"), (5, "Klein", "Кто?")]
    got = {r["chapter"]: (r["reasons"], r["terms"], r["admitted"]) for r in review.admission(spark.createDataFrame(rows, "chapter int, en_text string, ru_text string"), glossary).collect()}
    assert got == {
        1: ([], [], True), 2: (["truncated", "names"], ["Klein"], False), 3: (["footnotes", "truncated", "quotes"], [], False),
        None: (["no_chapter", "no_source", "empty"], [], False), 4: ([], [], True), 5: (["names"], ["Klein"], False),
    }
    findings = spark.createDataFrame([(i, "omission", f"r{i}") for i in range(4)], "id int, type string, reason string")
    decisions = spark.createDataFrame([(0, "approved", 1), (1, "rejected", 1), (2, "deferred", 1), (3, "approved", 2)], "id int, decision string, at int")
    told = review.decision_context(decisions, findings, ["id"], 1)
    assert told.first()["context"] == review.CONTEXT_HEADS[0] + "- omission: r3\n\n" + review.CONTEXT_HEADS[1] + "- omission: r1"
    asked = spark.createDataFrame([(1, "p")], "chapter int, prompt string")
    assert review.with_context(asked, told).first()["prompt"].endswith("r1\n\np")
    assert review.with_context(asked, review.decision_context(decisions.limit(0), findings, ["id"])).first()["prompt"] == "p"


def test_candidate_requests_with_english_and_errors(spark):
    from polyglossa.operators import review

    c = spark.createDataFrame([(1, i, f"c{i}", ["r"]) for i in range(1, 10)], "chapter int, id int, cleaned string, reasons array<string>")
    asked = {r["batch"]: r["prompt"] for r in review.candidate_requests(c, english=spark.createDataFrame([(1, "whole text")], "chapter int, english string")).collect()}
    assert sorted(asked) == [0, 1] and all(p.endswith("\nwhole text") for p in asked.values()) and "9: c9 [r]" in asked[1]
    told = spark.createDataFrame([(1, 0, '{"items":[]}', []), (1, 1, "[]", []), (1, 2, None, ["a", "b"]), (1, 3, None, [])], "chapter int, batch int, reply string, failures array<string>")
    assert {tuple(r)[1:] for r in review.candidate_errors(told).collect()} == {(1, "the reply has no list of items"), (2, "b"), (3, "no reply")}
