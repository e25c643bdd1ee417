"""The text, OCR and web rules on literal cases."""

import pytest
from pyspark.sql import functions as F

from polyglossa.functions import ocr, text, web


def of(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("A. [12]\n\n…\n\nPS: hi\n\n  x \n  y ", "A.\n\nx\ny\n"),
        ("A\n\n[1] note", "A note\n"),
        ("", ""),
        ("Discord link\n\nTRANSLATOR'S NOTE: q\n\nok", "ok\n"),
        (" x \n \ny", "x\n\ny\n"),
        (None, None),
    ],
)
def test_clean_story(spark, given, want):
    assert of(spark, given, text.clean_story) == want


def test_clean_story_drops_given_openers(spark):
    assert of(spark, "Once\n\nThis is a proverb about X.", lambda c: text.clean_story(c, dropped=["(?iu)^this is a proverb"])) == "Once\n"


@pytest.mark.parametrize(("given", "want"), [("# T\n\na\n\n b ", ["a", "b"]), ("x\n\n\n# T\n\na", ["x", "# T", "a"]), ("# T\nbody\n\na", ["a"]), ("", [])])
def test_paragraphs(spark, given, want):
    assert of(spark, given, text.paragraphs) == want


@pytest.mark.parametrize(("given", "want"), [("漢x", "zh"), ("Ёж", "ru"), ("Ё", "en"), ("cat", "en")])
def test_language(spark, given, want):
    assert of(spark, given, text.detect_language) == want


@pytest.mark.parametrize(("given", "want"), [('A: "B"?.', "A_ _B__"), (" . ", "untitled"), ("x" * 150, "x" * 100)])
def test_filename(spark, given, want):
    assert of(spark, given, text.safe_filename) == want


def test_names_and_numbers(spark):
    row = spark.range(1).select(
        text.normalized_href(F.lit("OEBPS/toc.ncx"), F.lit("t/a.xhtml#s")).alias("href"),
        text.chapter_number(F.lit("# Chapter 7: Z"), F.lit("0011_z")).alias("heading"),
        text.chapter_number(F.lit("Z"), F.lit("ch_0042_ru")).alias("stem"),
        text.chapter_number(F.lit("Z"), F.lit("none")).alias("none"),
        text.window_size(F.lit(80), F.lit(1)).alias("a"),
        text.window_size(F.lit(79), F.lit(1200)).alias("b"),
        text.window_size(F.lit(79), F.lit(1199)).alias("c"),
        text.texts_by_number(F.array(F.lit("a"), F.lit("b")), F.array(*map(F.lit, (2, 9, 1, 2)))).alias("texts"),
        text.numbered(F.array(F.lit("x"), F.lit("y")), 4).alias("numbered"),
        text.drop_leading_lines(F.lit("\nT\na.x\n\nbody\nT"), F.lit("T"), F.lit("a.x")).alias("body"),
        text.first_paragraphs(F.lit("# T\n\na\n\nb\n\nc"), 2).alias("first"),
    ).first()
    assert row.asDict() == {"href": "OEBPS/t/a.xhtml", "heading": 7, "stem": 42, "none": None, "a": 5, "b": 5, "c": 8, "texts": "b\n\na\n\nb", "numbered": "4: x\n5: y", "body": "body\nT", "first": "a\n\nb"}


def test_ocr_page(spark):
    assert of(spark, "| Привет, сло- |\nво мир\n~~ ab ~~\n\nДа\n", ocr.clean_page) == "Привет, слово мир\nДа\n"


def test_ocr_page_strips_as_sql_does(spark):
    assert of(spark, "привет |\r", ocr.clean_page) == "привет |\n"
    assert of(spark, "\u2003\t| раз \t два  три- \n\t четыре~\n\n\n \nпять\u00a0", ocr.clean_page) == "| раз два тричетыре\nпять\n"


def test_ocr_lines(spark):
    assert of(spark, "OH сказал|нет.Да кто-то", ocr.clean_line) == "ОН сказалнет.Да кто-то"
    assert of(spark, "ОН сказалнет.Да кто-то", ocr.review_reasons) == ["missing_space_after_sentence", "hyphenated_word_requires_photo_check"]
    assert [of(spark, t, ocr.repair_lookalikes) for t in ("KOT", "Pas", "Мaма")] == ["КОТ", "Pas", "Мaма"]
    assert of(spark, "а-\nб-\nв", ocr.dehyphenate) == "абв"
    once = of(spark, "KOT на CEHO", ocr.repair_lookalikes)
    assert of(spark, once, ocr.repair_lookalikes) == once


def test_web(spark):
    row = spark.range(1).select(
        web.next_url(F.lit("<a href='x'>"), F.lit("https://a.b/chapter-9")).alias("raised"),
        web.next_url(F.lit('<a class=x href="/c/2?a=1&amp;b">Следующая <b>глава</b></a>'), F.lit("https://a.b/c/1")).alias("linked"),
        web.next_url(F.lit(""), F.lit("https://a.b/9/chapter-9/x")).alias("middle"),
        web.next_url(F.lit(""), F.lit("https://a.b/x")).alias("none"),
        web.story_container(F.lit('<article class="a reeder_chapter_article">A<div class="advert">x</div>B</article>')).alias("story"),
        web.story_container(F.lit("<p>no</p>")).alias("no_story"),
        web.story_text(F.lit("<h1>Том 1</h1><p>One<br>two</p><p>(обновлено)</p><p>&lt;x&gt; &amp;</p>")).alias("text"),
    ).first()
    assert row.asDict() == {"raised": "https://a.b/chapter-10", "linked": "https://a.b/c/2?a=1&b", "middle": "https://a.b/9/chapter-10/x", "none": None, "story": "AB", "no_story": None, "text": "One\ntwo\n\n<x> &\n"}


def test_html_text(spark):
    html = "<p>a<b>b</p><script>x</p></script><div title='a>b'>c&amp; d &mdash; &amp;lt;</div><!-- no\n --><STYLE x>y</style >e<br/>f<style>rest"
    rows = spark.createDataFrame([(html,), (None,), ("plain\u00a0 text",), ("a < b",)], "h string")
    assert [r[0] for r in rows.select(web.html_text(F.col("h"))).collect()] == ["ab\n\nc& d — &lt;\ne\nf", None, "plain text", "a < b"]
