"""Joins, alignment, bridges, requests, audits and reviews on small cases."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyglossa.operators import alignment, audit, corpus, requests, review


def scalar_total(left, right, most=3):
    """The best total by plain recursion over cells."""
    unit = lambda x: x / np.linalg.norm(x)
    best = {(0, 0): 0.0}
    for i in range(1, len(left) + 1):
        for j in range(1, len(right) + 1):
            found = [best[i - a, j - b] + float(unit(left[i - a : i].mean(0)) @ unit(right[j - b : j].mean(0))) - 0.025 * (a + b - 2) for a in range(1, most + 1) for b in range(1, most + 1) if (i - a, j - b) in best]
            if found:
                best[i, j] = max(found)
    return best.get((len(left), len(right)))


def test_align_equals_plain_recursion():
    rng = np.random.default_rng(0)
    for n, m in [(1, 3), (2, 2), (5, 7), (9, 4), (1, 4), (6, 6)]:
        x, y = rng.normal(size=(n, 8)), rng.normal(size=(m, 8))
        found, want = alignment.align(x, y), scalar_total(x, y)
        assert (found is None) == (want is None)
        if found:
            assert found[0] == pytest.approx(want)
            assert sum(g[1] for g in found[1]) == n and sum(g[3] for g in found[1]) == m


def test_align_cases():
    one = np.ones((1, 4))
    assert alignment.align(one, np.ones((3, 4)))[1] == [(0, 1, 0, 3, pytest.approx(1.0))]
    assert alignment.align(one, np.ones((3, 4)))[0] == pytest.approx(0.95)
    assert alignment.align(np.ones((2, 4)), np.ones((2, 4)))[0] == pytest.approx(2.0)
    assert alignment.align(one, np.ones((4, 4))) is None
    gapped = alignment.align(one, np.ones((4, 4)), gap=0.2)
    assert sum(g[3] for g in gapped[1]) == 4


def groups(spark, rows, schema="chapter int, g int, left array<int>, right array<int>"):
    return spark.createDataFrame(rows, schema)


def units(df):
    return [(r["zh"], r["en"], r["ru"]) for r in df.orderBy("unit").collect()]


def test_bridges(spark):
    a = groups(spark, [(1, 1, [1], [1, 2]), (1, 2, [2], [3])])
    b = groups(spark, [(1, 1, [1], [1]), (1, 2, [2, 3], [2])])
    want = [([1, 2], [1, 2, 3], [1, 2])]
    assert units(alignment.bridge(a, b)) == want == units(alignment.bridge_by_cuts(a, b))
    a = groups(spark, [(1, 1, [1], [1]), (1, 2, [2], [2])])
    b = groups(spark, [(1, 1, [1], [1]), (1, 2, [2], [2]), (1, 3, [], [3])])
    assert units(alignment.bridge(a, b)) == [([1], [1], [1]), ([2], [2], [2])]
    assert units(alignment.bridge(a, b, extras=True))[2] == ([], [], [3])
    a, b = groups(spark, [(1, 1, [1], [1])]), groups(spark, [(1, 1, [1], [1]), (1, 2, [9], [5])])
    assert units(alignment.bridge(a, b, extras=True))[1] == ([], [], [5])
    assert units(alignment.bridge(a, b, extras=True, keep_en=True))[1] == ([], [9], [5])


def test_gate(spark):
    rows = [(1, i, [i], [i], s) for i, s in enumerate([0.9, 0.8, 0.6, 0.9, 0.5], 1)] + [(2, 1, [1], [1], None), (3, 1, [1], [1], 0.9)]
    g = groups(spark, rows, "chapter int, g int, left array<int>, right array<int>, similarity double")
    assert {tuple(r) for r in alignment.gate(g).select("chapter", "status", "first_suspect_group").collect()} == {(1, "review_required", 3), (2, "review_required", 1), (3, "passed", None)}
    assert sorted(r["g"] for r in alignment.weak_context(g).where("chapter = 1").collect()) == [1, 2, 3, 4, 5]
    verdicts = requests.boundary_verdicts(alignment.gate(g), spark.createDataFrame([(1, '{"status":"ok"}'), (2, "x")], "chapter int, reply string"))
    assert dict(verdicts.select("chapter", "verdict").collect()) == {1: "ok", 2: "uncertain", 3: "not_needed"}


def test_page_range_and_assembly(spark):
    pages = spark.createDataFrame([("IMG_1.txt", "IMG_1", "КНИГА\n\nа\nб\n"), ("IMG_2.txt", "IMG_2", "в\n"), ("IMG_3.txt", "IMG_3", "")], "page string, stem string, body string")
    lines = corpus.assemble_chapter(pages, "IMG_1", "IMG_3", "T", ["книга"], [])
    assert [tuple(r) for r in lines.orderBy("draft_line").collect()] == [(3, "IMG_1.txt", 1, "а"), (4, "IMG_1.txt", 2, "б"), (6, "IMG_2.txt", 1, "в")]
    with pytest.raises(Exception, match="not complete"):
        corpus.page_range(pages, "IMG_1", "IMG_4").collect()


def test_replies(spark):
    rows = spark.createDataFrame([(1, "{}"), (2, "boom")], "id int, prompt string")

    def responder(prompts):
        if prompts[0] == "boom":
            raise TimeoutError("late")
        return ['{"findings":[{"unit":2,"type":"addition"}]}']

    told = requests.respond(rows, responder)
    got = {r["id"]: r for r in told.collect()}
    assert got[1]["failures"] == [] and got[2]["reply"] is None and len(got[2]["failures"]) == 3
    assert {(r["id"], r["type"]) for r in requests.findings(told, ["id"]).collect()} == {(1, "addition"), (2, "review_required")}
    with pytest.raises(Exception, match="review required"):
        requests.stop_on_failure(told).collect()


def test_audit_requests(spark):
    p = spark.createDataFrame([(1, n, i, f"{n}{i}") for n in ("zh", "en", "ru") for i in range(1, 8)], "chapter int, lang string, p int, paragraph string")
    u = spark.createDataFrame([(1, i, [i], [i], [i] if i < 7 else []) for i in range(1, 8)], "chapter int, unit int, zh array<int>, en array<int>, ru array<int>")
    asked = {r["window"]: r for r in audit.unit_requests(audit.unit_texts(u, p)).collect()}
    assert asked[1]["units"] == 2 and asked[1]["prompt"].endswith("UNIT 7 (zh [7]; en [7]; ru [])\nZH: zh7\nEN: en7\nRU: ")
    assert audit.paragraph_requests(p).count() == 2
    flat = spark.createDataFrame([(1, 2, 9, [{"zh": [1], "en": [2], "ru": []}])], "chapter int, window int, offset int, alignment array<struct<zh:array<int>,en:array<int>,ru:array<int>>>")
    assert tuple(audit.flatten_window_units(flat).first()) == (1, 2, 1, [9], [10], [])


def test_reviews(spark):
    found = spark.createDataFrame([(i,) for i in range(1, 5)], "id int")
    decided = spark.createDataFrame([(1, 1, "approved"), (2, 1, "rejected"), (3, 1, "approved"), (3, 2, "deferred")], "id int, at int, decision string")
    assert sorted(r["id"] for r in review.pending(found, decided, ["id"]).collect()) == [3, 4]
    d = spark.createDataFrame([("manual_fix", ""), ("manual_fix", "x"), ("leave_as_is", None), ("other", "x")], "decision string, replacement string")
    assert review.valid_ocr_decisions(d).count() == 2
    photos = spark.createDataFrame([("/a/p1.png",), ("/a/p1.jpg",)], "path string")
    pages = spark.createDataFrame([("p1",), ("p2",)], "stem string")
    assert {tuple(r) for r in review.pages_with_photos(pages, photos).collect()} == {("p1", "/a/p1.jpg"), ("p2", None)}
    drafts = spark.createDataFrame([(1, "KOT-\nа\nPas")], "chapter int, body string")
    c = review.ocr_candidates(drafts)
    assert review.candidate_requests(c).count() == 1
    reviews = review.candidate_reviews(c, spark.createDataFrame([(1, '{"items":[{"id":1,"verdict":"ok"}]}')], "chapter int, reply string"))
    assert reviews.where("verdict = 'ok'").count() == 1
    assert review.cleaned_drafts(drafts).first()["lines"] == 3


def test_chapters(spark):
    f = spark.createDataFrame([("zh", "b/0001_a.txt", "# Chapter 7: x\n"), ("zh", "b/0007_z.txt", "y"), ("zh", "b/none.txt", "")], "source string, file string, body string")
    assert [tuple(r) for r in corpus.numbered_chapters(f).collect()] == [("zh", 7, "b/0007_z.txt")]


def test_window_alignment_stops_and_reports(spark):
    """Windows of a chapter range, three attempts with the service's state beside each failure, and the gate."""
    import pytest

    from polyglossa.operators import requests

    rows = [(c, lang, p, f"{lang}{p}") for c in (1, 2, 3) for lang in ("zh", "en", "ru") for p in range(1, 10) if not (c == 3 and lang == "ru")]
    asked = requests.window_requests(spark.createDataFrame(rows, "chapter int, lang string, p int, paragraph string"), first=2)
    assert [(r["chapter"], r["window"], r["offset"], r["window_size"]) for r in asked.orderBy("window").collect()] == [(2, 0, 1, 8), (2, 1, 9, 8)]
    assert "1: zh9" in asked.where("window = 1").first()["prompt"]
    reply = '[{"zh":[1],"en":[1],"ru":[1]}]'
    told = requests.respond(asked, lambda ps: [reply if "zh9" in p else "oops" for p in ps], requests.is_json, health=lambda: {"models": []})
    failed = told.where("window = 0").first()
    assert failed["reply"] is None and len(failed["failures"]) == 3 and '{"models": []}' in failed["failures"][0]
    report = requests.window_report(told).first()
    assert (report["status"], report["first_failed_window"], report["failed_attempts"], report["zh_count"]) == ("review_required", 0, 3, 9)
    assert requests.window_alignments(told).where("window = 1").first()["alignment"][0]["zh"] == [1]
    with pytest.raises(Exception, match="review required"):
        requests.stop_on_failure(told).collect()


def test_glossary_terms_inside_words(spark):
    from polyglossa.operators import review

    units = spark.createDataFrame([(1, "cat", "x"), (2, "concatenate", "кот"), (3, None, "x"), (4, "a", None)], "unit int, en_text string, ru_text string")
    terms = spark.createDataFrame([("甲", "cat", "кот"), ("乙", "on", "на"), ("丙", "", "z"), ("甲", "cat", "кот")], "zh string, en string, ru string")
    assert sorted((r["unit"], r["en"]) for r in review.glossary_violations(units, terms).collect()) == [(1, "cat"), (2, "on")]
    assert review.glossary_violations(units, terms.limit(0)).count() == 0


def test_positional_join_counts(spark):
    from polyglossa.operators import corpus

    a = spark.createDataFrame([(1, i, f"a{i}") for i in range(5)], "g int, i int, value string")
    b = spark.createDataFrame([(1, i, f"b{i}") for i in range(4)], "g int, i int, value string")
    assert corpus.match_by_rank([a, b], ["x", "y"], ["g"], ["i"], 2).count() == 2 and corpus.match_by_rank([a, b], ["x", "y"], ["g"], ["i"]).count() == 4


def test_running_totals_need_no_single_task(spark):
    """Sums over the rows before each, by ranges: as one window per group would give, without a window of a group in the plan."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 3001).alias("o"), (F.col("id") % 11).alias("v")).repartition(5)
    got = corpus.running_totals(rows, ["g"], ["o"], {"total": F.col("v"), "rank": F.lit(1)})
    before = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select("g", "o", "v", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("total"), F.count("*").over(before).alias("rank"))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert corpus.running_totals(rows, [], ["o", "g"], {"rank": F.lit(1)}).agg(F.sum("rank"), F.count_distinct("rank")).first()[:] == (3000 * 2999 // 2, 3000)
    assert corpus.running_totals(rows.limit(0), ["g"], ["o"], {"rank": F.lit(1)}).count() == 0


def test_bridge_by_links_equals_bridge(spark):
    """Random groups, a chain of a thousand links in one chapter, and groups that share nothing."""
    import random

    r = random.Random(3)
    schema = "chapter int, g int, left array<int>, right array<int>"
    rows = [[(c, g, [g], sorted(r.sample(range(30), r.randint(0, 3)))) for c in range(6) for g in range(1, 12)] for _ in range(2)]
    a = spark.createDataFrame(rows[0] + [(99, g, [g], [2 * g, 2 * g + 1]) for g in range(1, 500)], schema)
    b = spark.createDataFrame([(c, g, en, own) for c, g, own, en in rows[1]] + [(99, g, [2 * g + 1, 2 * g + 2], [g]) for g in range(1, 499)], schema)
    flat = lambda df: sorted((u["chapter"], u["unit"], u["zh"], u["en"], u["ru"]) for u in df.collect())
    got = flat(alignment.bridge_by_links(a, b))
    assert got == flat(alignment.bridge(a, b)) and [u[1] for u in got if u[0] == 99] == [1]
    assert alignment.bridge_by_links(a.limit(0), b.limit(0)).count() == 0


def test_bridge_by_links_computes_its_groupings_once(spark):
    """However many rounds follow; a group that many smaller ones share, and one between two chains, too."""
    computed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            computed.add(len(pdf))
            yield pdf

    schema = "chapter int, g int, left array<int>, right array<int>"
    a = [(1, g, [g], [g]) for g in range(1, 40)] + [(2, g, [g], [2 * g, 2 * g + 1]) for g in range(1, 60)] + [(3, 1, [1], [5, 6]), (3, 2, [2], None)]
    b = [(1, 99, list(range(1, 40)), [99])] + [(2, g, [2 * g + 1, 2 * g + 2], [g]) for g in range(1, 60) if g != 30] + [(3, 1, [6, None], [1])]
    once = [spark.createDataFrame(rows, schema).mapInPandas(counted, schema) for rows in (a, b)]
    got = alignment.bridge_by_links(*once).collect()
    assert computed.value == len(a) + len(b)
    assert sorted((u["chapter"], u["unit"], len(u["zh"]), len(u["ru"])) for u in got) == [(1, 1, 39, 1), (2, 1, 30, 29), (2, 2, 29, 29), (3, 1, 1, 1), (3, 2, 1, 0)]


def test_scores_of_tiles_equal_those_of_whole_chapters(spark):
    rng = np.random.default_rng(7)
    sides = {("a", "left"): 9, ("a", "right"): 11, ("b", "left"): 4, ("b", "right"): 1, ("c", "left"): 1, ("c", "right"): 6, ("d", "left"): 5}
    x = {k: rng.normal(size=(n, 3)) for k, n in sides.items()}
    rows = [(c, s, p + 1, v.tolist()) for (c, s), own in x.items() for p, v in enumerate(own)]
    vectors = spark.createDataFrame(rows, "chapter string, side string, p int, embedding array<double>")
    for a, b in ((2, 1), (1, 3), (2, 2)):
        want = {}
        for c in "abc":
            left, right = x[c, "left"], x[c, "right"]
            if len(left) >= a and len(right) >= b:
                want |= {(c, i + 1, j + 1): s for (i, j), s in np.ndenumerate(alignment.block_scores(left, right, a, b))}
        found = alignment.score_blocks(vectors, a=a, b=b, tile=4).collect()
        assert len(found) == len(want)
        assert {(r["chapter"], r["i"], r["j"]): pytest.approx(r["score"]) for r in found} == want


def test_candidate_lines_are_cleaned_once(spark):
    drafts = spark.createDataFrame([(1, "а#б\nпросто\nкто-то.Да\n"), (2, None), (3, "")], "chapter long, body string")
    found = review.ocr_candidates(drafts)
    assert [(r["chapter"], r["id"], r["line"], r["raw"], r["reasons"]) for r in found.orderBy("chapter", "id").collect()] == [
        (1, 1, 1, "а#б", ["ocr_symbols_remain"]),
        (1, 2, 3, "кто-то.Да", ["missing_space_after_sentence", "hyphenated_word_requires_photo_check"]),
    ]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("|©") == 1


def test_few_terms_need_no_python(spark, monkeypatch):
    texts = [("the cat", "foo"), ("the cat", "no"), ("THE", "x"), (None, "x"), ("the", None), ("and the", "bar")]
    units = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "chapter int, en_text string, ru_text string")
    glossary = spark.createDataFrame([("a", "the", "foo"), ("b", "and", None), ("c", "cat", ""), ("d", "", "x"), ("a", "the", "bar")], "zh string, en string, ru string")
    few = review.glossary_violations(units, glossary)
    assert "MapIn" not in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(review, "FEW", 0)
    many = review.glossary_violations(units, glossary)
    assert few.columns == many.columns
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    assert few.count() == 4
