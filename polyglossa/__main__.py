"""python -m polyglossa COMMAND ...: the engine's jobs on folders of Parquet, text, archives or images."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import text
from .operators import alignment, audit, corpus, replies, requests, review
from .sources import epub, files, recognition, web

#: command: (help, arguments)
COMMANDS = {
    "inspect": ("table of contents of archives", ["path"]),
    "extract": ("chapters of archives as text", ["path", "out", "count:int", "start:int=1"]),
    "import-text": ("clean a folder of texts", ["path", "out", "language", "label"]),
    "align-chapters": ("match chapters of three folders by number", ["zh", "en", "ru", "out"]),
    "translate-sample": ("prompts for a sample translation, answered", ["zh", "en", "glossary", "out", "model", "n:int=3"]),
    "ocr": ("recognise page images", ["path", "out", "executable="]),
    "assemble-ocr-chapter": ("join recognised pages", ["path", "first", "last", "title", "out"]),
    "clean-ocr-chapter": ("candidates of a draft", ["path", "out"]),
    "review-ocr-candidates": ("ask about candidates", ["path", "out", "model"]),
    "download": ("crawl chapter pages", ["url", "out", "count:int", "delay:float=3"]),
    "embed-align-pair": ("align two paragraph tables by vectors", ["left", "right", "out"]),
    "gap-align-pair": ("the same in two passes, rows may stand alone", ["left", "right", "out"]),
    "window-align": ("align paragraphs by replies, a fixed window a request", ["paragraphs", "out", "model", "first:int=1", "last:int=1000000000"]),
    "sequential-align": ("align paragraphs by replies", ["paragraphs", "out", "model"]),
    "validate-pair": ("first weak group of an alignment", ["groups", "out", "minimum:float=0.65"]),
    "review-boundary": ("verdicts about weak groups", ["gates", "replies", "out"]),
    "audit-units": ("audit bridged units", ["zh_en", "en_ru", "paragraphs", "out", "model"]),
    "audit-units-with-extras": ("the same, with unmatched Russian groups", ["zh_en", "en_ru", "paragraphs", "out", "model"]),
    "audit-windows": ("audit window alignments", ["windows", "paragraphs", "out", "model"]),
    "audit-paragraphs": ("audit without alignment", ["paragraphs", "out", "model"]),
    "pending": ("findings without a decision", ["findings", "decisions", "out"]),
    "review-ocr": ("candidates with the latest decisions", ["candidates", "replies", "decisions", "out"]),
    "monitor": ("progress of jobs and recent files", ["path"]),
}


def _answered(asked: DataFrame, args: argparse.Namespace, key: list[str]) -> DataFrame:
    return replies.stored_replies(asked, requests.http_responder(args.model, json_mode=True), f"{args.out}/replies", key, model=args.model)


def _vectors(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    side = lambda p, name: spark.read.parquet(p).select("chapter", F.lit(name).alias("side"), "p", recognition.embedded(F.col("paragraph"), recognition.hashing_encoder(256)).alias("embedding"))
    return side(args.left, "left").unionByName(side(args.right, "right"))


def run(spark: SparkSession, command: str, args: argparse.Namespace) -> DataFrame:
    read = spark.read.parquet
    if command == "inspect":
        return epub.epub_chapters(spark, args.path).drop("markup")
    if command == "extract":
        return epub.extract(epub.epub_chapters(spark, args.path), args.count, args.start)
    if command == "import-text":
        return files.import_text(spark, args.path, f"{args.out}/texts", args.language, args.label)
    if command == "align-chapters":
        return corpus.match_chapters(*(corpus.numbered_chapters(files.text_files(spark, p, n)) for p, n in ((args.zh, "zh"), (args.en, "en"), (args.ru, "ru"))))
    if command == "translate-sample":
        zh, en = (files.text_files(spark, p, "s").select("rank", F.col("body").alias(n)) for p, n in ((args.zh, "zh"), (args.en, "en")))
        terms = spark.read.json(args.glossary, multiLine=True).agg(text.glossary_lines(F.collect_list(F.struct("zh", "en", "ru"))).alias("g"))
        asked = zh.join(en, "rank").crossJoin(F.broadcast(terms)).select("rank", requests.translation_requests(F.col("zh"), F.col("en"), F.col("g"), args.n).alias("prompt"))
        return requests.translations(replies.stored_replies(asked, requests.http_responder(args.model, temperature=0.2, timeout=300), f"{args.out}/replies", ["rank"], model=args.model))
    if command == "ocr":
        tool = recognition.find_executable(args.executable or None)
        return recognition.recognised_pages(files.images(spark, args.path), recognition.tesseract(tool))
    if command == "assemble-ocr-chapter":
        return corpus.assemble_chapter(read(args.path), args.first, args.last, args.title, [], [])
    if command == "clean-ocr-chapter":
        return review.ocr_candidates(read(args.path))
    if command == "review-ocr-candidates":
        found = review.ocr_candidates(read(args.path))
        return review.candidate_reviews(found, _answered(review.candidate_requests(found), args, ["chapter", "batch"]))
    if command == "download":
        return web.crawl(spark, args.url, args.count, f"{args.out}/pages", delay=args.delay)
    if command in ("embed-align-pair", "gap-align-pair"):
        return alignment.align_blocks(_vectors(spark, args), two_pass=command.startswith("gap"))
    if command == "window-align":
        asked = requests.window_requests(read(args.paragraphs), args.first, args.last)
        told = replies.queued_replies(asked, requests.http_responder(args.model, json_mode=True), f"{args.out}/replies", ["chapter", "window"], "chapter", ["window"], model=args.model, accept=requests.is_json, health=requests.service_health)
        requests.window_report(told).write.mode("overwrite").json(f"{args.out}/report")
        return requests.window_alignments(requests.stop_on_failure(told))
    if command == "sequential-align":
        return replies.sequential_alignment(read(args.paragraphs), requests.http_responder(args.model, json_mode=True), f"{args.out}/replies", model=args.model)
    if command == "validate-pair":
        return alignment.gate(read(args.groups), minimum=args.minimum)
    if command == "review-boundary":
        return requests.boundary_verdicts(read(args.gates), read(args.replies))
    if command.startswith("audit-units"):
        units = alignment.bridge(read(args.zh_en), read(args.en_ru), extras=command.endswith("extras"))
        return requests.findings(_answered(audit.unit_requests(audit.unit_texts(units, read(args.paragraphs))), args, ["chapter", "window"]), ["chapter", "window"])
    if command == "audit-windows":
        flat = audit.flatten_window_units(read(args.windows)).drop("window").withColumn("unit", F.row_number().over(Window.partitionBy("chapter").orderBy("zh", "en", "ru", "unit")))
        return requests.findings(_answered(audit.unit_requests(audit.unit_texts(flat, read(args.paragraphs))), args, ["chapter", "window"]), ["chapter", "window"])
    if command == "audit-paragraphs":
        return requests.findings(_answered(audit.paragraph_requests(read(args.paragraphs)), args, ["chapter", "window"]), ["chapter", "window"])
    if command == "pending":
        return review.pending(read(args.findings), read(args.decisions), ["chapter", "window", "unit"])
    if command == "review-ocr":
        return review.candidate_reviews(read(args.candidates), read(args.replies), read(args.decisions))
    files.recent_files(spark, args.path).show(truncate=False)
    return files.progress_files(spark, args.path).select("job", "at", F.to_json("report").alias("report"))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="polyglossa")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (told, arguments) in COMMANDS.items():
        p = sub.add_parser(name, help=told)
        for a in arguments:
            a, has, default = a.partition("=")
            a, _, kind = a.partition(":")
            convert = {"int": int, "float": float}.get(kind, str)
            p.add_argument(f"--{a.replace('_', '-')}", required=not has, type=convert, default=convert(default) if default else "" if has else None)
    args = parser.parse_args(argv)
    if getattr(args, "count", 1) < 1:
        parser.error("count must be at least 1")
    if getattr(args, "delay", 3.0) < web.LEAST_DELAY:
        parser.error(f"delay must be at least {web.LEAST_DELAY}")
    spark = SparkSession.builder.getOrCreate()
    out = run(spark, args.command, args)
    if getattr(args, "out", None):
        out.write.mode("overwrite").parquet(f"{args.out}/result")
    else:
        out.show(1000, truncate=False)


if __name__ == "__main__":
    main()
