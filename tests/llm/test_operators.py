"""The operators on small tables with nulls, ties, repeats, clashing names and nothing at all; the queries beside SQL or brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
import corpus_pipeline
from matchmill.llm import decontaminate, near_dedup, passages
from matchmill.llm import queries as llm
from matchmill.llm.bpe import Vocabulary, encode_documents
from matchmill.llm.components import components
from matchmill.llm.language import identify, train
from matchmill.llm.licenses import scan_licenses
from matchmill.llm.op1_queries import RULES
from matchmill.llm.quality import score_quality
from matchmill.llm.quality import train as train_quality
from matchmill.llm.toxicity import score_toxicity
from matchmill.llm.toxicity import train as train_toxicity
from matchmill.llm.url_filter import Rule, judge_urls, prior_strength
from matchmill.llm.vector_search import top_k

SF = "/root/testdata/sf0.001"
#: Names that operators use inside or return.
CLASHES = ("n_words", "spans", "items", "id", "key", "score", "_text", "label", "host", "verdict", "rule", "component", "doc", "first", "_cut", "c0")


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    assert check.compare(spark, SF, name, duck).startswith("ok")


def test_all_queries_are_registered():
    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op") and n[2].isdigit()}
    assert numbers == {f"op{n}" for n in range(1, 14)} and "pipeline" in entry.queries()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls in every column, empty and long texts, repeated rows and clashing columns."""
    texts = [None, "", "  \n", "one two three", "One two THREE", "é", "word " * 20_000, "The MIT License <|endoftext|>", None, "7 . 7"]
    rows = [(k if k != 8 else None, t, "en" if k % 2 else None, None, len(t or "")) for k, t in enumerate(texts)] + [(3, "one two three", "en", "s", 13)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.lit(f"old {c}") for c in CLASHES})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.filter("doc_id = -1")


def test_urls(spark, rows):
    urls = [None, "no host", "http://A.EXAMPLE.org/en/12", "x://example.org/es/?q", "http://b.com/fr/#x", "http://b.com", "http://b.com/de/", "http://b.com/de/",
            "://c.net:80/x", "http://u@10.0.0.1/p"]
    frame = spark.createDataFrame([(k, u, "old") for k, u in enumerate(urls)], "page_id long, url string, verdict string").withColumn("host", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(frame, RULES).collect()}
    assert len(got) == len(urls)
    assert got[0][:3] == got[1][:3] == ("", "", None)
    assert got[2] == ("a.example.org", "/en/12", "example.org/en/1", "block") and got[3] == ("example.org", "/es/", "example.org/es/", "block")
    assert got[4] == ("b.com", "/fr/", "com/fr/", "allow") and got[5][:3] == ("b.com", "", None) and got[8][:2] == ("c.net:80", "/x")
    assert judge_urls(frame.limit(0), RULES).count() == 0
    # A host with many bad pages is blocked, one with a single bad page among good relatives is not.
    pages = spark.createDataFrame([(k, f"http://{h}.site.org/p") for k, h in enumerate(["bad", "one", "new"])], "page_id long, url string")
    seen = [("bad.site.org", 1)] * 60 + [("one.site.org", 1)] + [(f"h{k}.site.org", 0) for k in range(40)]
    judged = judge_urls(pages, [Rule("allow", "nothing.at/")], spark.createDataFrame(seen, "host string, bad int"))
    assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {0: "block", 1: "allow", 2: "allow"}


def test_prior_strength_of_thin_levels():
    assert prior_strength(1, 10, 5, 100, 0) == prior_strength(5, 10, 0, 100, 0) == prior_strength(0, 0, 0, 0, 0) == 9.0


def test_odd_rows_of_scoring_operators(spark, odd, empty):
    languages = train(odd)
    assert train(empty).languages == []
    found = {r["doc_id"]: r for r in identify(odd, languages).collect()}
    assert found[0]["lang_pred"] == found[2]["lang_pred"] == found[9]["lang_pred"] == "und" and found[3]["lang_pred"] == "en"
    assert all(r["lang_pred"] == "und" for r in identify(odd, train(empty)).collect())
    licensed = {r["doc_id"]: r for r in scan_licenses(odd).collect()}
    assert licensed[7]["base_labels"] == "mit" and licensed[0]["n_words"] == 0 and licensed[6]["n_words"] == 20_000
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, None), (4, 0, 1), (5, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for trainer, scorer, label in ((train_quality, score_quality, "quality"), (train_toxicity, score_toxicity, "toxic")):
        for known in (labels, labels.limit(0)):
            model = trainer(odd, known, F.lit(True), label)
            got = scorer(odd, model).collect()
            assert len(got) == 11 and all(0.0 <= r["score"] <= 1.0 for r in got)
        assert scorer(empty, model).count() == 0
    for made in (identify(empty, languages), scan_licenses(empty), encode_documents(empty, Vocabulary(public_tokenizers.path("byte_bpe_50k.json")))):
        assert made.count() == 0


def test_odd_rows_of_encoding(odd):
    got = encode_documents(odd, Vocabulary(public_tokenizers.path("byte_bpe_50k.json")), keep=["doc_id", "score"]).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert len(got) == 11
    for r in got:
        assert bytes(r["decoded"]).decode() == (texts[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"]) // 4 and r["score"] == "old score"


def test_search(spark, rows):
    big = 3.0e38
    vectors = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [2.0, 4.0]), (4, [2.0, 4.0]), (5, [0.5]), (None, [9.0, 9.0]),
               (6, [float("inf"), 0.0]), (7, []), (200, [big, 1.0]), (8, [-1.0, 0.25])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = top_k(frame, F.col("vec_id") % 100 == 0, k=3, block=2)
    first = [tuple(r) for r in got.filter("query_id = 0").orderBy("rank").collect()]
    top = 2**63 - 1
    assert [r[2] for r in first] == [200, 4, 4] and first[0][3] == top and first[1][3] == 1024 * 1024 * 10
    assert [tuple(r)[2] for r in got.filter("query_id = 200").orderBy("rank").collect()] == [0, 4, 4]
    assert top_k(frame, F.col("vec_id") == -1).count() == 0


def test_search_is_exact(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 24)).round(2) * np.linspace(0.1, 3, 400)[:, None]
    frame = spark.createDataFrame([(k, [float(x) for x in row]) for k, row in enumerate(base)], "vec_id long, embedding array<float>").repartition(5)
    whole = np.floor(base.astype(np.float32).astype(np.float64) * 1024).astype(np.int64)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k(frame, F.col("vec_id") % 10 == 0, block=7).collect()}
    for q in range(0, 400, 10):
        scores = whole @ whole[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:10]
        assert [got[q, k + 1] for k in range(10)] == [(i, scores[i]) for i in order]


def test_components(spark, rows):
    rng = random.Random(4)
    links = [(a, a + 1) for a in range(100, 160)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(None, 1), (5, None), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert rows(got) == sorted(((x, find(x)) for x in parent), key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_group(n=60, seed=8):
    """Near copies at many distances, exact copies and short texts, with ids in an order of their own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    base = [word() for _ in range(120)]
    docs = []
    for k in range(n):
        own = list(base if k % 3 else docs[-1][1].split() if docs else base)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
            own[rng.randrange(len(own))] = word()
        docs.append((k, " ".join(own)))
    docs += [(200 + k, t) for k, t in enumerate(["a b c", "A b  c", "a b", "", None, "a"])]
    rng.shuffle(docs)
    return docs


def plain_components(docs, percent=85):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [(i, shingles(t)) for i, t in docs]
    label = {i: i for i, _ in docs}
    while True:
        before = dict(label)
        for i, s in sets:
            for j, t in sets:
                if s and t and 100 * len(s & t) >= percent * len(s | t):
                    label[i] = min(label[i], label[j])
        if label == before:
            return {i: (len(s), label[i], label[i] == i) for i, s in sets}


@pytest.mark.parametrize("block", [4, 128])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    docs = near_group()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in CLASHES})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(frame).collect()}
    assert got == plain_components(docs)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(odd).collect()}
    assert got[0, 0] == (0, True) and got[3, 1] == (3, True) and got[4, 1] == (3, False) and got[None, 0] == (None, True)
    assert near_dedup.near_duplicates(odd).count() == 11 and near_dedup.near_duplicates(empty).count() == 0


def test_passages(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    prose = lambda n: [word() for _ in range(n)]
    shared, line = prose(51), prose(12)
    close = list(shared)
    close[25] = "zzzz"
    bodies = {0: prose(30) + shared + prose(9), 1: prose(80) + shared, 2: shared + prose(3), 3: prose(70), 4: line + prose(60), 5: line + prose(60), 6: prose(20) + close, 7: shared[:49]}
    frame = spark.createDataFrame([(k, " ".join(v)) for k, v in bodies.items()] + [(8, None), (9, ""), (None, " ".join(shared)), (2, " ".join(bodies[2]))], "doc_id long, text string")
    frame = frame.withColumns({c: F.lit("old") for c in CLASHES if c != "_cut"})
    got = {r["doc_id"]: (r["first_word"], r["n_words"], r["class_id"], r["kept"]) for r in passages.repeated_passages(frame).collect()}
    assert got == {0: (30, 51, 0, True), 1: (80, 51, 0, False), 2: (0, 51, 0, False), 6: (20, 51, 0, False)}
    cut = {r["doc_id"]: (r["text"], r["_cut"]) for r in passages.remove_repeated(frame).collect() if r["doc_id"] is not None}
    assert cut[0] == (" ".join(bodies[0]), 0) and cut[1][0].split() == bodies[1][:80] and cut[2] == (" ".join(bodies[2][51:]), 51)
    assert cut[4] == (" ".join(bodies[4]), 0) and cut[8] == (None, 0) and cut[9] == ("", 0)
    assert passages.repeated_passages(frame.limit(0)).count() == 0
    assert passages.remove_repeated(frame.limit(0)).count() == 0


def test_passages_after_a_difference_at_one_distance(spark):
    """Words of two documents at one distance of places are found again after any difference."""
    rng = random.Random(16)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    whole = [word() for _ in range(600)]
    other = list(whole)
    other[40:45] = [f"z{k}" for k in range(5)]
    other[300:340] = [f"y{k}" for k in range(40)]
    frame = spark.createDataFrame([(1, " ".join(whole)), (2, " ".join(other))], "doc_id long, text string")
    cut = {r["doc_id"]: r["text"].split() for r in passages.remove_repeated(frame).collect()}
    assert cut[1] == whole and set(cut[2]) <= {*other[:45], *other[300:340]} and set(cut[2]) >= {*other[300:340]}


def test_near_passages_with_words_put_in_left_out_and_replaced(spark):
    rng = random.Random(26)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    prose = lambda n: [word() for _ in range(n)]
    short, brief, long, many = prose(60), prose(60), prose(100), prose(200)
    near = {
        1: (short, short[:30] + ["zz"] + short[30:]), 2: (brief, brief[:29] + brief[30:]),
        3: (long, long[:48] + prose(5) + long[53:]), 4: (many, many[:45] + ["zz"] + many[45:90] + many[92:140] + ["yy", "xx"] + many[141:]),
    }
    frame, ends = [], {}
    for k, (one, two) in near.items():
        lead = rng.randrange(40)
        frame += [(k, " ".join(prose(33) + one + prose(20))), (k + 10, " ".join(prose(lead) + two + prose(25)))]
        ends[k] = (33, len(one), k, True)
        ends[k + 10] = (lead, len(two), k, False)
    got = passages.repeated_passages(spark.createDataFrame(frame, "doc_id long, text string")).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == ends and len(got) == len(ends)


def test_first_occurrences_stay_beside_repeats(spark):
    """A document whose repeat overlaps a first occurrence: query and removal say the same of every word."""
    rng = random.Random(46)
    prose = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    body = prose(340)
    texts = {1: prose(30) + body[100:160] + prose(30), 2: body, 3: prose(20) + body[130:300] + prose(20)}
    frame = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id long, text string")
    got = sorted(tuple(r) for r in passages.repeated_passages(frame).collect())
    assert got == [(1, 30, 60, 1, True), (2, 100, 60, 1, False), (2, 160, 140, 1, True), (3, 20, 170, 1, False)]
    cut = {r["doc_id"]: r["text"].split() for r in passages.remove_repeated(frame).collect()}
    assert cut == {1: texts[1], 2: body[:100] + body[160:], 3: texts[3][:20] + texts[3][190:]}


def test_passages_of_documents_against_all_windows(spark):
    """After removal hardly a run of fifty words is left that two documents share."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")

    def shared(texts):
        owners = {}
        for i, body in texts:
            words = (body or "").lower().split()
            for k in range(len(words) - 49):
                run = tuple(words[k : k + 50])
                if len(set(run)) > 12:
                    owners.setdefault(run, set()).add(i)
        return sum(len(o) > 1 for o in owners.values())

    before = shared([tuple(r) for r in docs.collect()])
    after = shared([(r["doc_id"], r["text"]) for r in passages.remove_repeated(docs).collect()])
    assert before > 5000 and after <= before / 100


def test_windows_over_passes(spark, odd, empty, monkeypatch):
    items = spark.createDataFrame([(1, "one two"), (2, "THREE"), (None, "word word word"), (3, None), (2, "three")], "item_id long, text string")
    whole = decontaminate.find_windows(odd, items, keep=["doc_id", "n_chars"]).collect()
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 1)
    parts = decontaminate.find_windows(odd, items, keep=["doc_id", "n_chars"]).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, parts))
    found = {r["doc_id"]: (r["n_hit"], r["items"]) for r in whole}
    assert found[3] == found[4] == (3, ["1", "2"]) and found[6] == (20_000, []) and found[0] == (0, []) and len(whole) == 11
    assert decontaminate.find_windows(empty, items).count() == 0
    assert {r["n_hit"] for r in decontaminate.find_windows(odd, items.limit(0)).collect()} == {0}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    sf = "/root/testdata/sf0.1"
    got = llm.queries()["op2_language_id"](spark, sf).join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.98
    for name, label, least in (("op5_quality", "quality", 0.98), ("op7_toxicity", "toxic", 0.95)):
        held = llm.queries()[name](spark, sf).join(labels, "doc_id").filter("held_out")
        assert held.agg(F.avg((F.col(label) == F.col("predicted")).cast("int"))).first()[0] > least


def test_folds_follow_the_contract(spark):
    got = llm.queries()["op7_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_pipeline_against_brute_force(spark):
    """Each stage on what its predecessor kept, judged by plain Python where the stage is exact."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    seen = {}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        kept = apply(spark, kept, SF)
        assert kept.columns == columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        seen[name] = {r["doc_id"]: r["text"] for r in kept.collect()}
    plain = plain_components(sorted(seen["language_id"].items()), corpus_pipeline.NEAR_PERCENT)
    assert set(seen["near_dedup"]) == {i for i, (_, _, stays) in plain.items() if stays}
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    from test_units import plain_windows

    assert set(seen["decontamination"]) == {i for i, t in seen["substring_dedup"].items() if not plain_windows(t, items, 10)[1]}
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(last) == set(seen["decontamination"])
    for i, body in seen["decontamination"].items():
        assert np.frombuffer(bytes(last[i]["ids"]), "<u4").tolist() == library.encode(body, add_special_tokens=False).ids
        assert last[i]["decoded_sha256"] == hashlib.sha256(body.encode()).hexdigest()


def test_stages_of_odd_rows(spark, odd, empty):
    for frame in (odd, empty):
        docs = frame
        for _, apply in corpus_pipeline.STAGES[:-1]:
            docs = apply(spark, docs, SF)
            assert docs.columns == odd.columns
        assert corpus_pipeline.encoding(spark, docs, SF).count() <= 11
