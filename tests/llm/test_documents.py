"""Operators on documents against brute force, with nulls, empty, long and repeated texts, ties and clashing columns."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyglossa.llm import byte_bpe, exact_dedup, jaccard_join, language_id, license_scan, packing, substring_dedup, toxicity

SPACE = re.compile(r"[\x20\x09-\x0D]")


@pytest.fixture
def texts(words):
    base, other, passage = words(120), words(60), words(50)
    near = base.split()
    near[40] = "changed"
    return [
        None, "", " \n", "one", "one", "o ne", "a b c d e f", base, base, base + " ", " ".join(near), f"{words(20)} {passage} {words(3)}", f"{words(9)} {passage}\n{words(30)}",
        f"{passage} {passage}", other, words(9000), "ñandú über ÉTÉ 漢字 🙂 it's don't x", "x" * 3000, "a\x1fb c",
    ]


def groups(texts, norm):
    out = collections.defaultdict(list)
    for i, t in enumerate(texts):
        out[norm(t or "")].append(i)
    return out


def test_exact_dedup(docs, texts):
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(docs(texts)).collect()}
    assert len(got) == len(texts)
    for text, ids in groups(texts, lambda t: SPACE.sub("", t)).items():
        keep = min(ids, key=lambda i: (-len(texts[i] or ""), i))
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest())


def test_exact_dedup_hot_repeated_and_null_ids(spark, docs):
    hot = docs(["same"] * 3000 + ["u"] * 2 + [f"t{i}" for i in range(500)], ids=[*range(2999), 2998, None, 7000, *range(8000, 8500)])
    out = exact_dedup.exact_dedup(hot, tracked=50)
    assert out.count() == 3502 and out.where("kept").count() == 502
    assert out.where("group_size = 3000 AND keep_id = 0").count() == 3000
    assert out.where("keep_id = 7000 AND group_size = 2").count() == 2


@pytest.mark.parametrize("operator", [exact_dedup.exact_dedup, packing.pack, jaccard_join.jaccard_join, substring_dedup.substring_dedup, byte_bpe.encode, license_scan.license_scan])
def test_empty_table(docs, operator):
    assert operator(docs(["x"]).limit(0)).count() == 0


def shingles(t):
    w = (t or "").encode().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_substring_dedup_carries_columns_of_any_name(docs, words):
    w = words(60)
    out = substring_dedup.substring_dedup(docs([w, w, "a b"])).collect()
    assert all(r[c] == "x" for r in out for c in ("_key", "_text", "_pos", "_role", "kept", "digest")) and [r["n_words"] for r in sorted(out, key=lambda r: r["doc_id"])] == [60, 60, 2]


def test_jaccard_join(docs, texts, words):
    base = words(200).split()
    for k in range(60):  # a large group of near copies, in several blocks
        w = list(base)
        w[3 * k] = f"v{k}"
        texts.append(" ".join(w))
    sets = [shingles(t) for t in texts]
    links = [[10 * len(a & b) >= 8 * len(a | b) and i != j for j, b in enumerate(sets) if True] if a else [False] * len(sets) for i, a in enumerate(sets)]
    links = np.array(links) & np.array([bool(s) for s in sets])[None, :]
    reach = links | np.eye(len(sets), dtype=bool)
    for _ in range(8):
        reach = reach @ reach
    got = {r["doc_id"]: r for r in jaccard_join.jaccard_join(docs(texts), block=16).collect()}
    for i in range(len(texts)):
        root = int(np.flatnonzero(reach[i])[0])
        assert (got[i]["n_links"], got[i]["group_id"], got[i]["kept"]) == (links[i].sum(), root, i == root), i
    stays = jaccard_join.dedup_rows(docs(texts))
    assert sorted(r["doc_id"] for r in stays.select("doc_id").collect()) == sorted({int(np.flatnonzero(r)[0]) for r in reach})


def test_dedup_rows_with_null_and_repeated_ids(docs, words):
    a, b = words(30), words(30)
    near = f"{a} more"
    texts, ids = [a, a, b, near, a, b, near, "", None], [4, 4, 4, 3, None, None, 3, 5, 5]
    exact = exact_dedup.dedup_rows(docs(texts, ids=ids).withColumn("_row", F.lit("own")))
    got = collections.Counter((r["doc_id"], r["text"] or "") for r in exact.collect())
    assert got == {(4, a): 1, (4, b): 1, (3, near): 1, (5, ""): 1} and exact.first()["_row"] == "own"
    close = jaccard_join.dedup_rows(docs(texts, ids=ids))
    got = collections.Counter((r["doc_id"], r["text"] or "") for r in close.collect())
    assert got == {(3, near): 1, (4, b): 1, (5, ""): 2} and close.columns == docs(texts).columns


def test_prefix_is_shortened_to_the_recall():
    k, trees = jaccard_join.shortest_prefix(0.8)
    assert (k, trees) == (4, jaccard_join.TREES)
    assert jaccard_join.met(0.8, k) >= jaccard_join.RECALL > jaccard_join.met(0.8, k + 1)
    k, trees = jaccard_join.shortest_prefix(0.2)
    assert k == 1 and jaccard_join.met(0.2, k, trees) >= jaccard_join.RECALL
    assert jaccard_join.measured_recall({1000: 50}, 6) == 1 and jaccard_join.measured_recall({}, 6) == 0
    assert jaccard_join.measured_recall({800: 1000}, 6) == pytest.approx(jaccard_join.met(0.8, 6))


def test_forest_stops_at_the_measured_recall(docs, words, monkeypatch):
    """Where every link is nearly equal, deep prefixes find all and shorter ones are not tried."""
    base, texts = words(400).split(), []
    for k in range(40):
        w = list(base)
        w[9 * k] = f"v{k}"
        texts.append(" ".join(w))
    tried = []
    needed = jaccard_join._needed
    monkeypatch.setattr(jaccard_join, "_needed", lambda trees, level: tried.append(level) or needed(trees, level))
    got = jaccard_join.jaccard_join(docs(texts), measured=700).collect()
    assert all(r["n_links"] == 39 and r["group_id"] == 0 for r in got) and tried == [2]
    tried.clear()
    assert all(r["n_links"] == 39 for r in jaccard_join.jaccard_join(docs(texts)).collect()) and tried == [2, 1, 0]


def test_recall_near_the_threshold(docs, words):
    """600 pairs of a similarity of little more than 0.8 are all found (expected: less than one lost)."""
    texts = []
    for _ in range(600):
        w = words(49).split()
        texts += [" ".join(w), " ".join([*w[:46], "x", *w[47:]])]  # 45 shingles, of which 3 to 5 differ
    links = sum(r["n_links"] for r in jaccard_join.jaccard_join(docs(texts)).collect())
    sets = [shingles(t) for t in texts]
    want = 2 * sum(10 * len(a & b) >= 8 * len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True))
    assert want == 1200 and links >= want - 2


def test_text_ids(spark, docs, words):
    a, b = words(60), words(60)
    texts, ids = [a, a + " x", b, None, a, None], ["q", "p", "z", "y", None, None]
    d = docs(texts).drop("doc_id").withColumn("text", F.col("text"))
    d = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id string, text string")
    got = {r["doc_id"]: r for r in jaccard_join.jaccard_join(d).collect() if r["doc_id"]}
    assert [(got[i]["class_id"], got[i]["n_links"], got[i]["group_id"], got[i]["kept"]) for i in "qpzy"] == [("q", 1, "p", False), ("p", 1, "p", True), ("z", 0, "z", True), ("y", 0, "y", True)]
    cut = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in substring_dedup.substring_dedup(d).collect()}
    assert cut == {("q", 60): 60, ("p", 61): 60, ("z", 60): 0, ("y", 0): 0, (None, 60): 60, (None, 0): 0}


def cut(texts, n=35):
    ws = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = collections.Counter(tuple(w[i : i + n]) for w in ws for i in range(len(w) - n + 1))
    for w in ws:
        gone = {i + j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(n)}
        yield len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


def test_substring_dedup(docs, texts, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 500)
    got = {r["doc_id"]: r for r in substring_dedup.substring_dedup(docs(texts)).collect()}
    for i, want in enumerate(cut(texts)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_text"]) == want, i
        assert got[i]["text"] == texts[i] and got[i]["label"] == "x"


def test_substring_dedup_with_equal_ids(docs, words):
    texts = [words(40), words(50), words(40)]
    same = docs([texts[0], texts[0], texts[1], texts[2]], clash=False, ids=[1, 1, 1, None])
    got = sorted((r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(same).collect())
    assert got == [(40, 0), (40, 40), (40, 40), (50, 0)]
    kept = substring_dedup.dedup_text(docs(["a  b", None], clash=False)).orderBy("doc_id").collect()
    assert [r["text"] for r in kept] == ["a  b", None]


def test_difference_cover():
    for period in (7, 13, 21):
        d = substring_dedup.cover(period)
        assert {(a - b) % period for a in d for b in d} == set(range(period))
    assert len(substring_dedup.cover(21)) == 5


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(docs(texts), keep_ids=True).toPandas()
    filled = got.sort_values(["sequence_id", "offset"])
    assert ((filled.groupby("sequence_id")["length"].cumsum() - filled["length"]) == filled["offset"]).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= 4096
    assert got["sequence_id"].nunique() == -(-got["length"].sum() // 4096)
    by = got.set_index(["doc_id", "piece"])
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096].tobytes()
            r = by.loc[(i, k)]
            assert (r["start"], r["length"], r["ids_crc32"], r["ids"]) == (at, len(own) // 4, zlib.crc32(own), own)


def test_word_ids_equal_those_of_whole_texts():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    r = random.Random(2)
    some = [*"abcXYZÀÉßÿ×÷µªº.,;:!?%&$*#|'’<>_-019 \t\n\x0b\x0c\r\x1c\x85\xa0 \u0301éǅİıſ中文кот👍", "<|endoftext|>", "<|startoftext|>", "'s", "</w>", " ", " "]
    texts = ["".join(r.choices(some, k=r.randint(0, 40))) for _ in range(3000)] + [None, "", " ", "word " * 9000]
    ids = packing.WordIds(packing.tokenizer_path())
    ids.LIMIT, ids.STEP = 400, 5000  # known words are forgotten, and batches end, many times
    want = Tokenizer.from_file(packing.tokenizer_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    for _ in range(2):
        for t, got, e in zip(texts, ids.ids(pa.array(texts, pa.string())), want, strict=True):
            assert got.tolist() == [*e.ids, 1], t
    assert list(ids.ids(pa.array([], pa.string()))) == []


def test_packing_plan_covers_every_piece():
    rng = np.random.default_rng(3)
    for counts in (rng.integers(0, 50, 101), np.eye(1, 101, 100, dtype=int)[0] * 7, np.zeros(101, int), rng.integers(0, 2, 101)):
        counts[0] = 0
        runs, n = packing.plan(counts)
        room = np.zeros(n, int)
        seen = {length: 0 for length in range(101)}
        for length, first, k, seq, step, offset in sorted(runs.tolist(), key=lambda r: (r[0], r[1])):
            assert first == seen[length]
            seen[length] += k
            for i in range(k):
                room[seq + i * step] += length
        assert all(seen[v] == counts[v] for v in range(101)) and (room <= 100).all()
        assert n <= -(-(np.arange(101) * counts).sum() // 100) * 1.2 + 1


def test_byte_bpe(docs, texts, words):
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.rank_path(), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*texts, "<|endoftext|>", "\n\n  \t x  ", "ab" * 700, words(300).replace(" ", ""), "漢" * 400, "=" * 777]
    for r in byte_bpe.encode(docs(texts)).collect():
        want = own.encode_ordinary(texts[r["doc_id"]] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert bytes(r["decoded"]) == (texts[r["doc_id"]] or "").encode()
        assert r["ids_sha256"] == hashlib.sha256(r["ids"]).hexdigest()


def license_brute(text, templates):
    """Greatest containment over all stretches, by sets of words."""
    w = license_scan.words_of(text).split()
    for name, template in templates.items():
        t = license_scan.words_of(template).split()
        n = min(5, len(t))
        k, own = len(t) - n + 1, {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}
        at = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        shares = [len(own & set(at[i : i + k])) for i in range(len(at))]
        enough = [i for i, s in enumerate(shares) if at[i] in own and s * license_scan.share_of(len(own), 0.8).denominator >= license_scan.share_of(len(own), 0.8).numerator * len(own)]
        if enough:
            yield name, max(shares) / len(own), enough[0]


def test_byte_bpe_long_runs(tmp_path, monkeypatch):
    """A run of 200,000 letters equals the library's result, and no folder is spilled to."""
    import base64
    import random

    import public_tokenizers
    import tiktoken

    monkeypatch.chdir(tmp_path)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.rank_path(), "rb"))}
    own, encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), byte_bpe.Encoder(byte_bpe.rank_path(), public_tokenizers.PATTERN)
    r = random.Random(4)
    runs = ["".join(r.choices(al, k=n)) for al, n in (("abcdefghijklmnopqrstuvwxyz", 200_000), ("ab", 5_000), ("etaoins", 3_000), ("a", 50_000), ("0123456789", 70))]
    for text, (ids, raw) in zip(runs, encoder.encoded(runs), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text) and bytes(raw) == text.encode()
    assert not list(tmp_path.iterdir())
    assert byte_bpe.joined([(0, np.array([1, 2], "<u4").tobytes()), (1, np.array([3], "<u4").tobytes())], np.array([0, 1, 1, 1])) is None
    assert not any(len(w) > byte_bpe.LONG for w in encoder.new)


def test_caches_are_bounded_by_bytes(monkeypatch):
    import pyarrow as pa

    from polyglossa.llm.common import WordHashes

    h = WordHashes()
    h.of([b"x" * 1000, b"short"])
    assert set(h) == {b"short"}
    ids = packing.WordIds(packing.tokenizer_path())
    ids.BYTES = 5_000
    for k in range(4):
        list(ids.ids(pa.array([" ".join(f"é{k}{'z' * 1000}{i}" for i in range(3))])))
    assert ids.words.names.nbytes < 10_000


def test_license_scan(docs, words):
    mit, apache = license_scan.TEMPLATES["mit"], license_scan.TEMPLATES["apache-2.0-header"]
    changed = mit.split()
    for i in (20, 60, 100):
        changed[i] = "changed"
    broken = mit.split()
    broken[::9] = ["broken"] * len(broken[::9])
    texts = [
        None, "", "x", f"{words(33)} Released under the MIT  license! {words(50)}", f"{words(90)} {mit} {words(5)} {mit}", f"{words(7)} {' '.join(changed)}", mit[:300], words(500),
        f"{words(3)}. ALL RIGHTS reserved", f"{apache}\n{words(40)} {' '.join(changed)}", " ".join(broken), "SPDX-License-Identifier: Apache-2.0", "licensed under the GNU General Public License, version 3",
    ]
    got = {(r["doc_id"], r["license"]): (r["containment"], r["first_word"]) for r in license_scan.license_scan(docs(texts)).collect()}
    assert got == {(i, name): (share, at) for i, t in enumerate(texts) for name, share, at in license_brute(t, license_scan.TEMPLATES)}
    assert {(3, "mit:released-0"), (4, "mit"), (5, "mit"), (8, "all-rights-reserved"), (9, "apache-2.0-header"), (9, "mit"), (11, "apache-2.0:spdx"), (12, "gpl-3.0:licensed-0")} <= set(got)
    assert not {i for i, _ in got} & {0, 1, 2, 6, 7, 10} and (12, "gpl-2.0:licensed-0") not in got and got[5, "mit"][0] < 1


def test_whole_licenses(docs, words):
    """Bodies of long licenses with every 40th word changed, in the midst of other words and without their last tenth."""
    long = {n: license_scan.TEMPLATES[n] for n in ("gpl-2.0-text", "gpl-3.0-text", "lgpl-2.1-text", "apache-2.0-text", "mpl-2.0-text", "cc0-1.0-text")}
    texts = []
    for text in long.values():
        own = text.split()
        own[::40] = ["changed"] * len(own[::40])
        texts.append(f"{words(700)} {' '.join(own[: len(own) * 19 // 20])} {words(300)}")
    texts.append(" ".join(long["gpl-3.0-text"].split()[:3000]))
    got = {(r["doc_id"], r["license"]): (r["containment"], r["first_word"]) for r in license_scan.license_scan(docs(texts)).collect() if r["license"].endswith("-text")}
    assert set(enumerate(long)) <= set(got) and 6 not in {i for i, _ in got}
    assert all(0.8 <= got[i, n][0] < 1 and 700 <= got[i, n][1] < 760 for i, n in enumerate(long))


def test_license_bands(words):
    b = license_scan.bands_for(100, 120, 0.8, 0.999)
    s = 80 / 140
    assert 1 - (1 - s**2) ** b >= 0.999 > 1 - (1 - s**2) ** (b - 1)
    # bands, not the verification, decide what is compared
    scanner, texts = license_scan.Scanner({"mit": license_scan.TEMPLATES["mit"]}), [license_scan.words_of(license_scan.TEMPLATES["mit"])]
    assert [m[1] for m in scanner.matches(texts)] == ["mit"]
    scanner.classes[0].flags[:] = False
    assert not list(scanner.matches(texts))
    with pytest.raises(ValueError):
        license_scan.Scanner({"none": " .. "})


def plain_probabilities(model, text):
    """The softmax of the mean over all subwords, one after another: runs of three and four bytes of every bounded word."""
    m, ids = 2**32, []
    raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode())
    for word in raw.split(b" "):
        p = b" " + word + b" "
        for i in range(len(p) - 2 if word else 0):
            code = p[i] | p[i + 1] << 8 | p[i + 2] << 16
            ids.append((code * 2654435761 % m) >> 17)
            if i + 3 < len(p):
                ids.append((((code ^ 0x9E3779B9) * 0x85EBCA6B + p[i + 3]) % m * 2654435761 % m) >> 17)
    z = (np.mean([model.logits[i].astype(float) for i in ids], axis=0) if ids else 0) + model.bias
    e = np.exp((z - z.max()) / model.temperature)
    return e / e.sum()


def test_language_id_equals_plain_means(spark):
    sf = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").collect()
    model = language_id.train([r["text"] for r in sf if r["lang"]], [r["lang"] for r in sf if r["lang"]])
    texts = [r["text"] for r in sf][:60] + [None, "", "a", "1 2 -", "é", "日本 語", "x" * 500, "A1b2 c\u0000d"]
    assert np.allclose(model.probabilities(texts), [plain_probabilities(model, t) for t in texts], atol=1e-6)


def test_language_id(spark, docs):
    en, de = "the thing that was there and then the others", "der hund und die katze nicht über ungewöhnlich"
    model = language_id.train([f"{en} {i}" for i in range(40)] + [f"{de} {i}" for i in range(40)], ["en"] * 40 + ["de"] * 40)
    texts = [None, "", "123 !?", "the others and then", "die katze über und nicht", "THE THING THAT", "the " * 50_000]
    got = {r["doc_id"]: r for r in language_id.language_id(docs(texts), model).collect()}
    assert [got[i]["lang_pred"] for i in range(7)] == ["und", "und", "und", "en", "de", "en", "en"]
    assert all(0 <= r["lang_score"] <= 1 for r in got.values()) and got[0]["lang_rejected"] and got[0]["lang_score"] == 0
    clash = language_id.language_id(docs(["the others"]).withColumn("_told", F.lit("own")).withColumn("lang_pred", F.lit("z")), model).first()
    assert clash["_told"] == "own" and clash["lang_pred"] == "en"
    assert language_id.language_id(docs(["x"]).limit(0), model).count() == 0
    nothing = language_id.train([], [])
    assert nothing.predict(["x", None])[0] == ["und", "und"]
    one = language_id.train(["only text"], ["xx"])
    assert one.predict(["a b"])[0] == ["xx"]


def test_language_features_of_long_texts(monkeypatch):
    text = "the quick brown fox jumps over them " * 300
    whole = language_id.features(text)
    monkeypatch.setattr(language_id, "PIECE", 1000)
    assert all(np.allclose(a, b) for a, b in zip(whole, language_id.features(text), strict=True))
    assert "".join(language_id.pieces("x" * 2500 + " y")) == "x" * 2500 + " y"


def test_language_fit_counts_repeated_ids_once(docs):
    d = docs(["the thing"] * 6 + [None], ids=[1, 1, 1, 2, 3, 4, 5])
    model = language_id.fit(d, F.lit(True), rows=2)
    assert model.languages == ("en",)
    assert d.select(language_id.held_out().alias("h")).where("h IS NULL").count() == 0


def test_language_model_ignores_other_columns(spark, docs):
    a = language_id.train(["aa bb cc"] * 10 + ["dd ee ff"] * 10, ["x"] * 10 + ["y"] * 10)
    assert a.predict(["aa bb"])[0] == ["x"] and a.predict(["dd"])[0] == ["y"]


def test_toxicity(spark, docs):
    bad = [f"you {w} number {i}" for i, w in enumerate(["blarg", "idiot"] * 30)]
    good = [f"you fine words number {i} trash can" for i in range(60)]
    d = docs(bad + good + [None, "", "bl4rg", "іdiоt", "iDIoT!", "blargs", "a trash can"])
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(121, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels)
    got = {r["doc_id"]: (r["toxic_predicted"], r["toxic_score"]) for r in toxicity.toxicity(d, model).collect()}
    assert [got[i][0] for i in range(120)] == [1] * 60 + [0] * 60
    assert [got[i][0] for i in range(120, 127)] == [0, 0, 1, 1, 1, 0, 0]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert toxicity.fit(d, labels.limit(0)).weights == toxicity.default_model().weights
    assert toxicity.Model({}, ()).score("x") < 0.5


def test_toxicity_learns_stems(spark, docs):
    bad, good = [f"x{i} glorbu{'abcdefghij'[i % 10]}{i // 10}z y" for i in range(40)], [f"x{i} plain words" for i in range(80)]
    d = docs([t.replace("0", "n").replace("1", "m").replace("2", "k").replace("3", "p") for t in bad] + good)
    model = toxicity.fit(d, spark.createDataFrame([(i, int(i < 40)) for i in range(120)], "doc_id long, toxic int"))
    assert any(t.endswith("*") for t in model.weights) and model.score("some glorbuqq here") > 0.5 and model.score("plain") < 0.5
