"""Readers and writers with files."""

import gzip
import json
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.functions import langs, text
from corpusmill.operators import inference, joins, layout, shards as byte_shards
from corpusmill.plans import extended, publish, synthetic
from corpusmill.sinks import writers
from corpusmill.sources import bitext, corpus, lines, normalize


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if str(path).endswith(".gz") else open
    with opener(path, "wt", encoding="utf-8", newline="") as f:
        f.write(content)
    return str(path)


def put_parquet(path, **columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)
    return str(path)


@pytest.mark.parametrize("split_bytes", ["64", "128m"])
def test_line_numbers(spark, tmp_path, split_bytes):
    rng = random.Random(1)
    expected = {}
    for lang in ("aa", "bb"):
        written = [f"{lang} {i} " + "x" * rng.randint(0, 40) for i in range(300)]
        put(tmp_path / lang / "f_0.txt", "\n".join(written[:120]) + "\n")
        put(tmp_path / lang / "f_1.txt", "\n".join(written[120:]))
        expected[lang] = written
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = lines.read_lines(spark, f"{tmp_path}/*/*.txt").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {lang: [r.value for r in sorted((r for r in rows if r.lang == lang), key=lambda r: r.line)] for lang in expected}
    assert got == expected
    assert sorted(r.line for r in rows if r.lang == "aa") == list(range(300))


def test_chunks_of_json_lines_keep_their_line_numbers(spark, tmp_path):
    put(tmp_path / "sw" / "sw_clean_0000.jsonl.gz", '{"text": "a"}\nbad\n\n{"other": 1}\n')
    put(tmp_path / "sw" / "sw_clean_0001.jsonl.gz", '["no"]\n{"text": "ü\\nb"}\n')
    rows = normalize.normalize_json_lines(lines.read_lines(spark, f"{tmp_path}/*/*_clean_*.jsonl.gz"))
    got = sorted((r.meta.id, r.text) for r in rows.collect())
    assert got == [("madlad400_sw_0", "a"), ("madlad400_sw_3", ""), ("madlad400_sw_5", "ü\nb")]


def test_passages(spark, tmp_path):
    path = put(tmp_path / "yor_Latn" / "yor_wura.txt", "7\ta\tb\nbare\n\tc\n")
    rows = normalize.normalize_passages(lines.read_lines(spark, path)).collect()
    assert [(r.meta.id, r.text) for r in rows] == [("7", "a\tb"), ("wura_yor_Latn_1", "bare"), ("", "c")]


def test_web_defaults(spark):
    df = spark.createDataFrame([("af", "t", None, ["x"])], "lang string, text string, dump string, top_langs array<string>")
    row = normalize.normalize_web(df).first()
    assert row.meta.dump == row.meta.date == row.meta.url == ""
    assert (row.meta.language, row.meta.language_score, row.meta.minhash_cluster_size) == ("af", 0.0, 0)
    assert row.meta.top_langs == ["x"] and row.meta.dataset == "fw2"
    with pytest.raises(ValueError):
        normalize.normalize_web(df.drop("text"))


def test_text_fallback_of_a_row_without_text(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert json.loads(normalize.text_fallback(df).first().text) == {"x": "a", "y": 1}


def test_headline_and_content(spark):
    df = spark.createDataFrame([(" H ", None, 1), (None, "c\n", 2), ("h", "c", 3)], "headline string, content string, n int")
    assert [(r.text, r.rest.n) for r in normalize.build_documents(df).collect()] == [("H", 1), ("c", 2), ("h c", 3)]


def test_rows_of_all_formats(spark, tmp_path):
    records = [{"text": "a", "source": "s"}, {"text": " "}, {"text": "b"}, {"text": "c"}]
    jsonl = put(tmp_path / "x.jsonl", "\n".join(map(json.dumps, records[:2])) + "\n\n" + "\n".join(map(json.dumps, records[2:])))
    array = put(tmp_path / "x.json", json.dumps(records, indent=1))
    one = put(tmp_path / "one.json", json.dumps(records[0]))
    plain = put(tmp_path / "x.txt", "a\n \nb\nc\n")
    parquet = put_parquet(tmp_path / "x.parquet", text=[r["text"] for r in records])
    for path in (jsonl, array, plain, parquet):
        assert [r.text for r in corpus.read_rows(spark, path).collect()] == ["a", "b", "c"]
        assert sorted(r.text for r in corpus.read_rows(spark, path, max_samples=2).collect()) == ["a", "b"]
    assert corpus.read_rows(spark, one).first().source == "s"
    assert corpus.read_rows(spark, jsonl, schema="text string").columns == ["text"]


def moses(tmp_path, pair, src, tgt, scores):
    a, b = pair.split("-")
    for end, content in ((a, src), (b, tgt), ("scores", scores)):
        put(tmp_path / f"NLLB.{pair}.{end}", "".join(f"{line}\n" for line in content))


def test_aligned_files(spark, tmp_path):
    moses(tmp_path, "en-sw", [" a\r", "b"], ["x", "y "], ["1.25", "0.5"])
    moses(tmp_path, "en-so", ["a", "b"], ["x"], ["1", "2"])
    moses(tmp_path, "en-xh", ["a"], ["x"], ["high"])
    rows = bitext.read_moses(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [(r.pair, r.row_id, r.sentence1, r.sentence2, r.score) for r in rows] == [
        ("en-sw", 0, "a", "x", 1.25), ("en-sw", 1, "b", "y", 0.5)]


def test_bitext_and_scores_meet_by_row(spark, tmp_path):
    for pair, n in (("en-sw", 40), ("en-fr", 3)):
        put_parquet(tmp_path / "b" / f"{pair}.parquet", sentence1=[f"s{i}" for i in range(n)], sentence2=["t"] * n, score=[1.0] * n)
        put_parquet(tmp_path / "s" / f"{pair}.parquet", **{"comet-score": [i / 100 for i in range(n)]})
    joined = joins.join_scores(bitext.read_bitext(spark, f"{tmp_path}/b"), bitext.read_scores(spark, f"{tmp_path}/s"))
    assert all(r.sentence1 == f"s{round(r.comet_score * 100)}" for r in joined.collect()) and joined.count() == 43


def test_merged_shards(spark, tmp_path):
    for i in (1, 2, 10):
        put_parquet(tmp_path / "en-fr" / f"en-fr{i}.parquet", score=[i + j / 10 for j in range(3)])
    shards = bitext.read_scored_shards(spark, str(tmp_path))
    manifest = spark.createDataFrame([("en-fr", i, 3) for i in (10, 2, 1)], "pair string, index long, num_rows long")
    rows = bitext.merge_scored_shards(shards, manifest).orderBy("row_id").collect()
    assert [r.comet_score for r in rows] == [1.0, 1.1, 1.2, 2.0, 2.1, 2.2, 10.0, 10.1, 10.2]
    more = manifest.unionByName(spark.createDataFrame([("en-fr", 3, 1)], manifest.schema))
    with pytest.raises(PySparkException, match="en-fr3"):
        bitext.merge_scored_shards(shards, more).collect()


def test_many_shards_are_checked_without_the_driver(spark, monkeypatch):
    from corpusmill.operators import shards as byte_shards

    rows = spark.createDataFrame([(p, i, "x" * 9) for p in ("en-fr", "de-de") for i in range(300)], "source string, row_id long, text string")
    fetched = []
    monkeypatch.setattr(type(rows), "toArrow", lambda df: fetched.append(df))
    sharded, manifest = byte_shards.assign_shards(rows, 20, byte_shards.row_bytes(["text"]), block_rows=1)
    scored = sharded.select(F.col("source").alias("pair"), F.col("shard").alias("index"), (F.col("row_id") % 2).alias("row_id"), F.col("row_id").cast("double").alias("comet_score"))
    manifest = manifest.withColumnRenamed("source", "pair")
    merged = bitext.merge_scored_shards(scored, manifest)
    assert sorted((r.pair, r.row_id, r.comet_score) for r in merged.collect()) == [(p, i, float(i)) for p in ("de-de", "en-fr") for i in range(300)]
    assert bitext.complete_shards(scored, manifest).count() == 600 and not fetched
    for shards in (scored.where("pair = 'de-de' or index < 150"), scored.where("false")):
        with pytest.raises(PySparkException, match="missing scored shard"):
            bitext.complete_shards(shards, manifest).collect()


def test_checked_shards_are_not_joined_again(spark, tmp_path):
    put_parquet(tmp_path / "s.parquet", pair=["a", "a", "b"], index=[1, 2, 1], row_id=[0, 0, 0])
    shards = spark.read.parquet(f"{tmp_path}/s.parquet")
    manifest = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1)], "pair string, index long, num_rows long")
    whole = bitext.complete_shards(shards, manifest)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert whole.count() == 3 and "Join" not in plan and "Exchange" not in plan


def test_sizes_of_the_bitext_come_without_its_sentences(spark, tmp_path):
    from corpusmill import queries

    put_parquet(tmp_path / "documents.parquet", doc_id=[0, 1, 1, 2, 4], lang=["en", "fr", "de", None, "en"], text=["\u00e9a", None, "", "abc", "d"])
    sized, rows = (f(spark, str(tmp_path)) for f in (queries.sized_bitext, queries.bitext))
    size = byte_shards.row_bytes(["sentence1", "sentence2"])
    found = sorted(map(tuple, sized.select("pair", "row_id", F.col("bytes1") + F.col("bytes2")).collect()))
    assert found == sorted(map(tuple, rows.select("pair", "row_id", size).collect())) and len(found) == 4


def test_odd_shards_only(spark, tmp_path):
    for i in range(4):
        put(tmp_path / f"shard-{i:05d}.jsonl.gz", json.dumps({"query": f"q{i}", "document": "d"}) + "\n")
    assert sorted(r.query for r in corpus.read_code_shards(spark, str(tmp_path)).collect()) == ["q1", "q3"]


def test_mixture_config_from_csv(spark, tmp_path):
    path = put(tmp_path / "mix.csv", 'subset,token_count,split\na,100,"x, y"\nb,,x\nc,7,\n')
    rows = sorted(map(tuple, corpus.read_mixture_config(spark, path, "1/3").collect()))
    assert rows == [("a", "x", 0, 33), ("a", "y", 1, 33), ("b", "x", 0, 0)]
    assert corpus.read_mixture_config(spark, path, subsets=["a"]).count() == 2
    with pytest.raises(ValueError):
        corpus.read_mixture_config(spark, put(tmp_path / "no.csv", "subset,split\na,x\n"))


def raw_folder(tmp_path):
    put_parquet(tmp_path / "raw" / "af" / "af_0001_fw2.parquet", text=["w"], url=["u"])
    put_parquet(tmp_path / "raw" / "eng_Latn" / "eng_Latn_0001_fw2.parquet", text=["e"])
    put(tmp_path / "raw" / "af" / "afr_wura_documentLevel.jsonl", '{"text": "doc"}\n')
    put(tmp_path / "raw" / "af" / "afr_wura.txt", "p1\tpassage\n")
    put(tmp_path / "raw" / "af" / "af_ml400.jsonl", 'bad\n{"text": "m"}\n')
    put(tmp_path / "raw" / "af" / "af_extra.jsonl", '{"text": "x", "source": "s", "source-category": "c"}\n')
    put(tmp_path / "raw" / "af" / "notes.md", "nothing\n")
    return str(tmp_path / "raw")


def test_raw_folder_to_corpus_and_back(spark, tmp_path):
    rows = publish.normalize_folder(spark, raw_folder(tmp_path))
    got = {(r.lang, r.split, r.dataset_origin, r.text, r.meta.id) for r in rows.collect()}
    assert got == {
        ("af", "fineweb2", "fw2", "w", ""), ("eng_Latn", "finewebEdu", "fw2", "e", ""),
        ("af", "wura_documentLevel", "wuraDocumentLevel", "doc", "wura_af_0"),
        ("af", "wura", "wura", "passage", "p1"), ("af", "madlad400", "madlad400", "m", "madlad400_af_1"),
        ("af", "extraData", "extra", "x", "extra_af_0"),
    }
    assert publish.normalize_folder(spark, raw_folder(tmp_path), ["eng_Latn"]).count() == 1
    assert rows.select("lang", "split", "ord").distinct().count() == 6
    root = str(tmp_path / "corpus")
    writers.write_corpus(rows, root)
    config = spark.createDataFrame([("af", "wura", 0, 5), ("af", "fineweb2", 1, 5), ("zz", "wura", 0, 1)], "lang string, split string, split_pos int, target long")
    back = corpus.scan_corpus(spark, root, config)
    assert sorted((r.split_pos, r.text) for r in back.collect()) == [(0, "passage"), (1, "w")]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "lang" in plan.split("PartitionFilters: [")[1]


def test_positions_run_over_the_files_of_a_split(spark, tmp_path):
    put(tmp_path / "af" / "b_ml400.jsonl", '{"text": "3"}\nbad\n{"text": "4"}\n')
    put(tmp_path / "af" / "a_ml400.jsonl", '{"text": "1"}\n{"text": "2"}\n')
    put_parquet(tmp_path / "af" / "b_fw2.parquet", text=["y", "z"])
    put_parquet(tmp_path / "af" / "a_fw2.parquet", text=["x"])
    put(tmp_path / "af" / "a_wura.jsonl", '{"text": "d"}\n')
    put(tmp_path / "af" / "a_wura.txt", "p\n")
    rows = publish.normalize_folder(spark, str(tmp_path)).orderBy("split", "ord").collect()
    assert [(r.split, r.text) for r in rows] == [
        ("fineweb2", "x"), ("fineweb2", "y"), ("fineweb2", "z"), ("madlad400", "1"), ("madlad400", "2"),
        ("madlad400", "3"), ("madlad400", "4"), ("wura", "d"), ("wura", "p")]
    assert {r.meta.id for r in rows if r.text in "34"} == {"madlad400_af_0", "madlad400_af_2"}
    assert len({(r.split, r.ord) for r in rows}) == len(rows)


def test_files_and_missing_splits(spark, tmp_path):
    for lang, stem in (("af", "a_fw2"), ("af", "b_fw2"), ("af", "a_wura"), ("sw", "a_ml400"), ("sw", "odd")):
        put_parquet(tmp_path / lang / f"{stem}.parquet", text=["x"])
    config = spark.createDataFrame([("af", "madlad400"), ("af", "wura"), ("zz", "wura")], "lang string, split string")
    found, missing = publish.check_splits(spark, str(tmp_path), config)
    assert sorted(map(tuple, found.collect())) == [("af", "fineweb2", 2), ("af", "wura", 1), ("sw", "madlad400", 1)]
    assert [tuple(r) for r in missing.collect()] == [("af", "madlad400")]


def jsonl_below(path):
    out = {}
    for folder, _, names in os.walk(path):
        for name in sorted(names):
            if name.endswith(".json"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    out.setdefault(os.path.basename(folder), []).append([json.loads(line) for line in f])
    return out


def test_json_by_language_and_pending_work(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", "ü"), ("a", "b"), ("b", "c")], "lang string, text string")
    writers.write_jsonl(df.where("lang = 'a'"), path)
    changed = df.withColumn("text", F.upper("text"))
    writers.write_pending(changed, path)
    got = {k: sorted(r["text"] for file in v for r in file) for k, v in jsonl_below(path).items()}
    assert got == {"lang=a": ["b", "ü"], "lang=b": ["C"]}
    with open(next(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".json") and "lang=a" in d), encoding="utf-8") as f:
        assert "\\u" not in f.read()


def test_parts(spark, tmp_path):
    df = spark.createDataFrame([(i, str(i)) for i in range(23)], "ord long, text string").repartition(5)
    writers.write_parts(df, str(tmp_path / "parts"), 10)
    got = jsonl_below(tmp_path / "parts")
    assert {k: sorted(int(r["text"]) for f in v for r in f) for k, v in got.items()} == {
        "part_id=1": list(range(10)), "part_id=2": list(range(10, 20)), "part_id=3": [20, 21, 22]}
    writers.write_capped(df.select("text"), str(tmp_path / "capped"), 4)
    assert max(len(f) for v in jsonl_below(tmp_path / "capped").values() for f in v) <= 4


def test_shards_and_statistics_on_disk(spark, tmp_path):
    from corpusmill.operators import shards

    df = spark.createDataFrame([("en-fr", i, "x" * 10) for i in range(9)], "source string, row_id long, text string")
    rows, manifest = shards.assign_shards(df, 30, shards.row_bytes(["text"]), block_rows=1)
    writers.write_shards(rows, manifest, str(tmp_path / "s"))
    assert spark.read.parquet(f"{tmp_path}/s/rows").groupBy("shard").count().count() == 3
    assert spark.read.json(f"{tmp_path}/s/manifest").count() == 3
    stats = spark.createDataFrame([("a", 1)], "pair string, n long")
    writers.append_stats(stats, str(tmp_path / "stats"))
    writers.append_stats(stats, str(tmp_path / "stats"))
    assert spark.read.parquet(str(tmp_path / "stats")).count() == 2


def test_splits_of_further_languages(spark):
    df = spark.createDataFrame([("twi_Latn", "zeta", 0, "t"), ("twi_Latn", "alpha", 0, "u")], "lang string, split string, ord long, text string")
    rows = extended.repeated_languages(df, times=2).collect()
    assert sorted((r.split, r.split_pos, r.epoch) for r in rows) == [("alpha", 0, 0), ("alpha", 0, 1), ("zeta", 1, 0), ("zeta", 1, 1)]
    assert len(extended.FALLBACK_SPLITS) == 32


def test_translation(spark):
    df = spark.createDataFrame([("hi", None), ("yo", "web")], "text string, source string")

    def load():
        return lambda prompts: [f" {p.splitlines()[-3]}! " for p in prompts]

    rows = synthetic.translate(df, ["eng_Latn", "swa_Latn"], load, "stem").collect()
    assert sorted((r.text, r.target_language, r.source, r.domain) for r in rows) == [
        ("hi", "eng_Latn", "stem", None), ("hi!", "swa_Latn", "stem", None),
        ("yo", "eng_Latn", "web", None), ("yo!", "swa_Latn", "web", None)]


def test_strip_is_that_of_python(spark):
    samples = [chr(i) + "a" + chr(i) for i in range(0x3001) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(s,) for s in samples + [" \t  ", "", "　x y\n"]], "s string")
    assert all(r.t == r.s.strip() for r in df.select("s", text.strip("s").alias("t")).collect())


def test_tokens_are_runs_of_non_space(spark):
    samples = ["", " ", "a", " a  b\n\tc ", "ü x y", "\x0b"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.n for r in df.select(text.count_tokens("s").alias("n")).collect()]
    assert got == [0, 0, 1, 3, 2, 0]


@pytest.mark.parametrize("lang, stem, split, origin", [
    ("eng_Latn", "eng_Latn_0001_fw2", "finewebEdu", "fw2"),
    ("afr_Latn", "afr_wura_documentLevel", "wura_documentLevel", "wuraDocumentLevel"),
    ("afr_Latn", "afr_wura", "wura", "wura"),
    ("afr_Latn", "afr_Latn_ml400", "madlad400", "madlad400"),
    ("afr_Latn", "madlad_x", "madlad400", None),
    ("afr_Latn", "foo", None, None),
])
def test_names_of_files(spark, lang, stem, split, origin):
    df = spark.createDataFrame([(lang, stem)], "lang string, stem string")
    assert tuple(df.select(layout.infer_split("lang", "stem"), layout.infer_origin("stem")).first()) == (split, origin)


@pytest.mark.parametrize("code, plain, special", [
    ("sw", "swa_Latn", "swa_Latn"), ("xx", "xx", "xx"), ("hau_Latn", "hau_Latn", "hau_Latn"),
    ("zh_TW", "zh_TW", "zh_Hant"), ("ace", "ace", "ace_Arab"),
])
def test_codes(spark, code, plain, special):
    df = spark.createDataFrame([(code,)], "c string")
    assert tuple(df.select(langs.long_code("c"), langs.long_code("c", specials=True)).first()) == (plain, special)


def test_names_from_a_table(spark, tmp_path):
    path = put(tmp_path / "names.csv", "code,name\nqq_Latn,Q\n")
    assert langs.read_language_names(spark, path) == {"qq_Latn": "Q"}


def test_answers_of_a_model_keep_their_rows(spark):
    df = spark.createDataFrame([(i, f"p{i}" if i % 3 else None, f"t{i}") for i in range(50)], "i int, prompt string, text string").repartition(3)
    rows = inference.generate(df, lambda: lambda prompts: [p.upper() for p in prompts], batch_rows=7).collect()
    assert all(r.translation == (f"P{r.i}" if r.i % 3 else f"t{r.i}") for r in rows) and len(rows) == 50


def test_a_large_language_goes_to_many_files(spark, tmp_path):
    one = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one.repartition(8).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))  # many tasks write, as at scale
    writers.write_jsonl(docs, str(tmp_path / "o"), shard_bytes=200_000)
    files = {k: len(v) for k, v in jsonl_below(tmp_path / "o").items()}
    assert files["lang=en"] > 2 and files["lang=es"] <= 2
    writers.write_jsonl(docs, str(tmp_path / "p"), order=["doc_id"], columns=["doc_id"], max_rows=100)
    ids = [[r["doc_id"] for r in f] for f in jsonl_below(tmp_path / "p")["lang=en"]]
    assert all(f == sorted(f) and len(f) <= 100 for f in ids) and len(ids) >= 7
    spans = sorted((f[0], f[-1]) for f in ids)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_more_splits_than_a_filter_lists(spark, tmp_path, monkeypatch):
    rows = [(f"l{i % 7}", f"s{i % 3}", i, "x") for i in range(210)]
    spark.createDataFrame(rows, "lang string, split string, ord long, text string").write.partitionBy("lang", "split").parquet(str(tmp_path / "c"))
    wanted = spark.createDataFrame([("l1", "s0", 0, 9), ("l1", "s2", 1, 9), ("l5", "s1", 0, 9), ("zz", "s1", 0, 9)], "lang string, split string, split_pos int, target long")
    few = sorted(map(tuple, corpus.scan_corpus(spark, str(tmp_path / "c"), wanted).select("ord", "split_pos").collect()))
    monkeypatch.setattr(corpus, "MAX_LISTED", 2)
    many = corpus.scan_corpus(spark, str(tmp_path / "c"), wanted)
    assert "dynamicpruning" in many._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, many.select("ord", "split_pos").collect())) == few and len(few) == 30
