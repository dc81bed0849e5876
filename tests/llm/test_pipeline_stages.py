"""The language stage and the pipeline against brute force, with and without labels."""

import hashlib

import corpus_pipeline
import pytest

from tarnkeep.llm import common, decontaminate, tokens

ROWS = [
    (1, "One plain text of words."), (2, "Ein Wort"), (3, None), (4, ""), (5, "12 !? ²"), (6, "日本"),
    (None, "null id"), (2, "Ein Wort"), (7, "plain other words, quite different from the first"),
]


@pytest.mark.parametrize("lang", [None, "en"])
def test_run_keeps_every_text_with_a_letter(spark, tmp_path, lang):
    common.prepare(spark)
    rows = [(i, t, lang, "s", len(t or "")) for i, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "no item of these words")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    kept = corpus_pipeline.keep_languages(spark, docs, str(tmp_path))
    want = [(i, t) for i, t in ROWS if any(c.isalpha() for c in t or "")]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(got, key=str) == sorted(want, key=str)
    # after it only the exact copy goes: no secrets, no items; all pieces fit in one sequence
    plain = tokens.Encoder()._tokenizer
    sizes = [len(plain.encode(t, add_special_tokens=False).ids) + 1 for t in {t for _, t in want}]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.length for r in packed.collect()) == sorted(sizes)


CLASHING = ("lang", "row", "hits", "__id", "__h", "__block_0", "text_", "found", "r", "bin", "piece")
PASSAGE = [f"w{i}x" for i in range(60)]
KEY = "0123456789abcdef" * 3


def documents():
    filler = [f"f{i}" for i in range(1200)]
    return [
        (1, "plain words of the first text, which nothing else repeats at all"),
        (2, "a copy " * 20), (3, "a copy " * 20), (2, "a copy " * 20), (None, "a copy " * 20),
        (4, None), (5, ""), (6, "12 !? ²"), (7, "é" * 30000), (8, " ".join(PASSAGE)),
        (9, " ".join([*filler, *PASSAGE])), (10, " ".join([*filler[:200], *PASSAGE[:12], *filler[200:]])),
        (11, f"the token = {KEY} is secret"), (None, None), (12, "token=abcdef and tail"),
    ]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    items = [("p", " ".join(PASSAGE)), ("q", None), (None, "short item"), ("p", " ".join(PASSAGE))]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def table_of(spark, rows):
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    return common.prepare(spark).createDataFrame(
        [(i, t, *(f"{c}{i}" for c in CLASHING)) for i, t in rows], schema
    ).repartition(3)


def pairs(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def staged(spark, folder, name, rows):
    docs = table_of(spark, rows)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    assert out.columns == docs.columns
    got = out.collect()
    # further columns keep their own row's values
    assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in CLASHING)
    return pairs(out)


def test_near_duplicates_stage(spark, folder):
    rows = documents()
    got = staged(spark, folder, "near_duplicates", rows)
    # one of each text stays; null, empty and white space are one class
    classes = {}
    for i, t in rows:
        classes.setdefault((t or "").strip(), []).append((i is None, i or 0, t))
    want = [min(c) for c in classes.values()]
    assert [i for i, _ in got] == sorted((i for _, i, _ in want), key=lambda i: str((i, dict(rows)[i])))
    assert staged(spark, folder, "near_duplicates", []) == []


def test_decontamination_stage(spark, folder):
    rows = documents()
    got = staged(spark, folder, "decontamination", rows)
    # 60 of 60 words are hit; 60 of 1260 are under a twentieth; 12 words are no window; the short item does not occur
    assert got == sorted(((i, t) for i, t in rows if i != 8), key=str)
    assert staged(spark, folder, "decontamination", []) == []


def test_passages_over_a_limit_are_removed(spark, folder):
    rows = documents()
    docs = table_of(spark, rows)
    blocks = decontaminate.automata(spark.read.parquet(f"{folder}/benchmark.parquet"))
    found = dict(pairs(decontaminate.without_passages(docs, blocks)))
    assert found[8] == "" and found[9].split() == [f"f{i}" for i in range(1200)]
    assert found[10] == dict(rows)[10] and found[4] is None
    longer = dict(pairs(decontaminate.without_passages(docs, blocks, longest=61)))
    assert longer[9] == dict(rows)[9] and longer[8] == ""
    report = {r.doc_id: r for r in decontaminate.report(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    for i in (8, 9, 10, 4):
        assert report[i].kept_sha256 == hashlib.sha256((found[i] or "").encode()).hexdigest()


def test_secret_stage(spark, folder):
    rows = documents()
    got = dict(staged(spark, folder, "secret_scan", rows))
    # the whole finding goes, its name included
    assert got[11] == "the [SECRET] is secret" and got[12] == "[SECRET] and tail"
    same = [i for i, _ in rows if i not in (None, 2, 11, 12)]
    assert all(got[i] == dict(rows)[i] for i in same)
    assert staged(spark, folder, "secret_scan", []) == []


def test_packing_stage(spark, folder):
    rows = documents()
    out = dict(corpus_pipeline.STAGES)["packing"](spark, table_of(spark, rows), folder).collect()
    plain = tokens.Encoder()._tokenizer
    sizes = [len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows]
    assert sum(r.length for r in out) == sum(sizes)
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)


def test_language_stage_goes_by_the_model(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tarnkeep.llm import language

    common.prepare(spark)
    rows = [(1, "one plain text", "en"), (2, "ein Wort", "de"), (3, None, "en"), (4, "12 !?", None),
            (5, "another plain text", None), (None, "null id text", None), (5, "another plain text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = []
    report = language.report

    def judged(frame, *args, **kwargs):
        # the model's verdict decides: a text it calls und goes, even with letters
        asked.append(kwargs.get("key"))
        out = report(frame, *args, **kwargs)
        return out.withColumn("lang_pred", F.when(F.col("doc_id") == 2, language.UNKNOWN).otherwise(F.col("lang_pred")))

    monkeypatch.setattr(language, "report", judged)
    kept = corpus_pipeline.keep_languages(spark, docs, str(tmp_path))
    assert asked and kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 5, 5]
    # nothing learned: the model calls all und, and texts with a letter stay
    monkeypatch.setattr(language, "report", report)
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.keep_languages(spark, bare, str(tmp_path)).collect()) == [0, 1, 2, 5, 5]
