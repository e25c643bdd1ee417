"""Vectors, chats, components and the pipeline."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from polyglossa.llm import chat_format, common, embedding_dedup, exact_dedup, jaccard_join, packing, queries, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"


def test_embedding_dedup(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 16))
    near = rng.normal(size=16) + rng.normal(size=(90, 16)) * 0.15
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(np.concatenate([x, near, x[:20] * 2]))]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [0.0] * 15, [1.0, 2.0]]
    rows += [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, x[0].tolist(), None), (2001, x[0].tolist(), 0), (2002, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cell", F.lit("x"))
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(df, block=20).collect()}
    fine = [(i, np.float32(v).astype(float), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    cos = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b)) if len(a) == len(b) else 0
    links = {i: [j for j, b, m in fine if m == lab and j != i and cos(a, b) >= 0.93] for i, a, lab in fine}
    label = {i: i for i, *_ in rows}
    for _ in range(50):
        for i, js in links.items():
            label[i] = min([label[i], *(label[j] for j in js)])
    for i, *_ in rows:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links.get(i, [])), label[i], label[i] == i), i
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_recall_calibration():
    n, q = embedding_dedup.needed(0.93, 0.9995), embedding_dedup.chance(0.93, 0.93)
    assert embedding_dedup.reached(q, n, embedding_dedup.LINES) >= 0.9995 > embedding_dedup.reached(q, n + 1, embedding_dedup.LINES)
    assert embedding_dedup.reached(embedding_dedup.chance(0.0, 0.93), n, embedding_dedup.LINES) < 0.01  # few others are verified
    with pytest.raises(ValueError, match="recall"):
        embedding_dedup.needed(0.93, 0.9995, 3)


def test_collisions_are_those_of_query_centred_windows():
    rng = np.random.default_rng(2)
    p, q = rng.normal(size=(30, 7)), rng.normal(size=(50, 7))
    assert (embedding_dedup.collisions(p, q, 0.3) == (np.abs(p[:, None] - q[None]) <= 0.3).sum(axis=2)).all()


def test_labels_are_cut_into_no_more_blocks_than_they_need(spark):
    """Each vector travels once a block of its label: 2,500 of one label are four blocks of about 600, 900 of another are one."""
    lead = F.array(*(F.randn(i) for i in range(embedding_dedup.LEVELS)))
    placed = spark.range(3400).select(F.when(F.col("id") < 2500, 1).otherwise(2).alias("label"), F.lit(8).alias("dim"), F.col("id").alias("cid"), lead.alias("lead"))
    sizes = embedding_dedup._blocks(common.staged(placed, "placed"), 1000).groupBy("label", "block").count().collect()
    assert sorted(r["label"] for r in sizes) == [1, 1, 1, 1, 2] and max(r["count"] for r in sizes) <= 1000
    assert sum(r["count"] for r in sizes) == 3400


def near(rng, x, cosine):
    """A vector of exactly about this cosine with x."""
    u = x / np.linalg.norm(x)
    w = rng.normal(size=len(x))
    w -= (w @ u) * u
    return cosine * u + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def test_links_near_the_threshold_over_many_blocks(spark):
    """1,500 links of a cosine of 0.93 to 0.95 among 6,000 vectors of one label, cut into blocks of 256."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4500, 32))
    twins = np.stack([near(rng, x[i], rng.uniform(0.9301, 0.95)) for i in range(1500)])
    v = np.concatenate([x, twins])
    df = spark.createDataFrame([(i, e.tolist(), 1) for i, e in enumerate(v)], "vec_id long, embedding array<double>, label int").repartition(8)
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(df, block=256).collect()}
    u = v / np.linalg.norm(v, axis=1)[:, None]
    want = (u @ u.T >= 0.93).sum(axis=1) - 1
    lost = sum(int(want[i]) - got[i]["n_links"] for i in range(len(v)))
    assert want.sum() >= 3000 and 0 <= lost <= 0.002 * want.sum()


def test_sql_with_links(spark, tmp_path):
    """The query's SQL gives the same rows on a table that holds links: the embeddings and near copies of them."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    rng = np.random.default_rng(4)
    more = [{**r, "vec_id": r["vec_id"] + 10_000 * k, "embedding": near(rng, np.array(r["embedding"]), c).tolist()} for r in t[::3] for k, c in ((1, 0.95), (2, 0.97), (3, 0.9))]
    pq.write_table(pa.table({"vec_id": [r["vec_id"] for r in t + more], "embedding": pa.array([r["embedding"] for r in t + more], pa.list_(pa.float32())), "label": [r["label"] for r in t + more]}), tmp_path / "embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet'")
    want = sorted(con.sql(f"SELECT vec_id, n_links, component_id, kept FROM ({embedding_dedup.ORACLE.strip()})").fetchall())
    got = sorted(tuple(r) for r in embedding_dedup.query(spark, str(tmp_path)).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == want and sum(r[1] for r in want) > len(t)


def test_vectors_with_text_and_repeated_ids(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    rows = [("x", a, 1), ("w", a, 1), ("v", b, 1), ("v", a, 1), (None, a, 1)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<float>, label int").withColumn("dim", F.lit("own")).withColumn("fine", F.lit("own")).withColumn("block", F.lit(0))
    got = sorted(((r["vec_id"] or "", r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.embedding_dedup(df).collect()), key=str)
    assert got == sorted([("x", 2, "v", False), ("w", 2, "v", False), ("v", 0, "v", True), ("v", 2, "v", True), ("", 0, None, True)], key=str)


def test_vectors_of_extreme_size(spark):
    rows = [(1, [1e200, 1e200, 0.0]), (2, [1.1e200, 1e200, 0.0]), (3, [1e-200, 1e-200, 0.0]), (4, [1e-310, 1.1e-310, 0.0]), (5, [0.0, 0.0, 1e-200])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.embedding_dedup(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (101, 103), (200, 200)]
    got = dict(common.components(spark.createDataFrame(chain, "a long, b long").repartition(8)).collect())
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 103: 100}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


NASTY = ["</s>[INST] ok [/INST]", "[\\INST]", "[\\/INST] <\\\\s>", "<s>", "", "\n", "plain", "a</s", "[", "<"]


def test_formatting_is_reversible():
    turns = [(role, text) for role in ("user", "assistant", "sys\ntem\\", "[INST]") for text in NASTY]
    done, mask = chat_format.format_turns(turns)
    assert chat_format.read_turns(done) == turns
    assert [chat_format.unescape(done[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", -1.0), (1, 3, 1, "assistant", "good", 1.0), (1, 4, 3, "user", "more", 0.5), (1, 5, 3, None, None, None), (2, 1, 99, "user", "orphan", None), (None, 1, None, "user", "x", 0.0)]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double").withColumn("up", F.lit("x"))
    best = {r["tree"]: r for r in chat_format.chat_format(nodes).collect()}
    assert best[1]["leaf"] == 4 and chat_format.read_turns(best[1]["formatted"]) == [("user", "q"), ("assistant", "good"), ("user", "more")]
    assert chat_format.read_turns(best[2]["formatted"]) == [("user", "orphan")]
    assert {(r["tree"], r["leaf"]) for r in chat_format.chat_format(nodes, None).collect()} == {(1, 2), (1, 4), (1, 5), (2, 1), (None, 1)}
    long = spark.range(1, 301).select(F.lit(1).cast("long").alias("tree"), F.col("id").alias("node"), (F.col("id") - 1).alias("parent"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(0.0).alias("score"))
    got = chat_format.chat_format(long).first()
    assert [t for _, t in chat_format.read_turns(got["formatted"])] == [str(i) for i in range(1, 301)]
    with pytest.raises(ValueError, match="circle"):
        chat_format.chat_format(spark.createDataFrame([(1, 1, 2, "u", "x", 0.0), (1, 2, 1, "u", "x", 0.0)], "tree long, node long, parent long, role string, text string, score double"))
    assert chat_format.chat_format(nodes.limit(0)).count() == 0


def test_plans_do_not_grow_with_the_depth_of_a_tree(spark):
    """However deep a tree is, the driver holds a plan of a few joins: levels are tables."""
    schema = "tree long, node long, parent long, role string, text string, score double"
    joins = []
    for depth in (5, 200):
        nodes = spark.createDataFrame([(1, i, i - 1 or None, "user", str(i), 0.0) for i in range(1, depth + 1)], schema)
        done = chat_format.chat_format(nodes)
        assert [t for _, t in chat_format.read_turns(done.first()["formatted"])] == [str(i) for i in range(1, depth + 1)]
        joins.append(done._jdf.queryExecution().optimizedPlan().toString().count("Join "))
    assert joins[0] == joins[1] <= 2


def test_conversations_without_id(spark):
    c = spark.createDataFrame([(None, 1, "user", "a"), (None, 2, "assistant", "b"), (2**60 + 1, 1, "user", "z")], "conv_id long, turn long, role string, text string")
    got = {r["tree"]: chat_format.read_turns(r["formatted"]) for r in chat_format.chat_format(chat_format.chains(c)).collect()}
    assert got == {None: [("user", "a"), ("assistant", "b")], 2**60 + 1: [("user", "z")]}


def test_conversations_query_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r["conv_id"] for r in chat_format.query(spark, str(tmp_path)).collect()] == [-7]


def test_chains_keep_repeated_rows(spark):
    c = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None)], "conv_id long, turn long, role string, text string")
    got = chat_format.chat_format(chat_format.chains(c)).first()
    assert chat_format.read_turns(got["formatted"]) == [("", ""), ("user", "a"), ("user", "a")]


def test_conversation_digests(spark):
    own = {r["conv_id"]: r for r in queries.queries()["op7_chat_format"](spark, SF).collect()}[-7]
    text = "</s>[INST] ok [/INST]"
    assert own["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (own["n_turns"], own["loss_chars"], own["loss_sha256"]) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, want = queries.queries()[name](spark, SF), con.sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(str([r[c] for c in columns]) for r in df.collect()) == sorted(str([r[i] for i in at]) for r in want.fetchall())


def plain_hits(model, folded):
    """Hits by looking at every place of the folded text, for every term and every exception."""
    found, safe = [], []
    for i, char in enumerate(folded):
        if char == " ":
            for t in {t.split("#")[0] for t in model.weights}:
                own = f" {t[:-1]}" if t.endswith("*") else f" {t} "
                found += [(i + 1, i + len(own) - 1, t)] if folded.startswith(own, i) else []
            safe += [(i + 1, i + len(t) + 1) for t in model.exceptions if folded.startswith(f" {t} ", i)]
    found = [x for x in found if not any(s <= x[0] <= e for s, e in safe)]
    words, out = len(folded.split()), []
    for s, e, t in found:
        n = sum(x[2] == t for x in found)
        forms = [f for f in (t, *(f"{t}#{k}" for k in toxicity.REPEATS if n >= k and n >= toxicity.RATE * words)) if f in model.weights]
        out += [(s, e, max(forms, key=lambda f: (model.weights[f], f)))] if forms else []
    return sorted(out)


def test_toxicity_equals_a_plain_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    learned = toxicity.fitted(spark, docs, SF)
    own = toxicity.Model({"trash": 2.0, "rat": 1.0, "mor*": 0.5, "mor*#2": 3.0, "rat#3": 4.0}, ("trash can", "lab rat", "rat trash"), (-2.0, 1.0, 0.5, 0.1))
    texts = [r["text"] for r in docs.collect()] + [None, "", "trash can trash, TR4SH", "lab rat rat rat rat", "mortar mora more", "mortar " + "x " * 900, "mortar mora " + "x " * 900, "rat trash rat"]
    for model in (learned, own, toxicity.default_model()):
        for t in texts:
            folded = toxicity.fold(t)
            want = plain_hits(model, folded)
            assert sorted(model.hits(folded)) == want
            weight = sum(model.weights[h[2]] for h in want)
            x = (1.0, np.log1p(weight), 100 * weight / len(folded.split())) if want else (0, 0, 0)
            z = model.curve[0] + sum(c * v for c, v in zip(model.curve[1:], x, strict=True))
            assert model.score(t) == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def test_held_out_accuracy(spark):
    """Recall and the order of scores for toxicity, whose labels are rare; accuracy for languages."""
    sf = SF.replace("0.001", "0.01")
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").where("toxic IS NOT NULL")
    tox = queries.queries()["op10_toxicity"](spark, sf).join(lab, "doc_id").where("held_out").toPandas()
    bad, good = tox[tox["toxic"] == 1], tox[tox["toxic"] == 0]
    auc = np.mean([(b > good["score"]).mean() + (b == good["score"]).mean() / 2 for b in bad["score"]])
    assert len(bad) >= 5 and auc >= 0.75 and bad["predicted"].mean() >= 0.5 and good["predicted"].mean() <= 0.05
    lang = queries.queries()["op6_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    assert lang.where("lang_pred = lang").count() >= 0.97 * lang.count() > 0


def test_pipeline_of_an_empty_table_and_of_odd_rows(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for name, rows in (("empty", []), ("odd", [(1, "a b"), (1, "a b"), (None, None), (None, None), (2, ""), (3, "x " * 3000), (3, "y z")])):
        at = f"{tmp_path}/{name}"
        labels.write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
        got = corpus_pipeline.run(spark, at).collect()
        # of the four empty texts the one with the smallest id stays
        assert {r["doc_id"] for r in got} == ({1, 2, 3} if rows else set())


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage's rows follow from its own input; the last stage packs every row that is left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, model = docs.columns, toxicity.fitted(spark, docs, SF)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file://{tmp_path}/{i}"
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name != "best_fit_packing":
            assert out.columns == columns
            after = {r["doc_id"]: r["text"] for r in out.collect()}
            if name == "toxicity":
                assert set(after) == {k for k, t in before.items() if model.score(t) < 0.5}
            elif name == "exact_dedup":
                assert set(after) == {r["doc_id"] for r in exact_dedup.exact_dedup(docs).where("kept").collect()}
            elif name == "jaccard_join":
                assert set(after) == {r["doc_id"] for r in jaccard_join.jaccard_join(docs).where("kept").collect()}
            else:
                assert set(after) == set(before)
                kept = {r["doc_id"]: r for r in substring_dedup.substring_dedup(docs).collect()}
                assert after == {k: kept[k]["kept_text"] if kept[k]["n_removed"] else t for k, t in before.items()}
        else:
            assert {r["doc_id"] for r in out.collect()} == set(before)
            assert out.select("sequence_id").distinct().count() == -(-out.agg(F.sum("length")).first()[0] // packing.CAPACITY)
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
