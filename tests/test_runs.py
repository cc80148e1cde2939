"""The commands, from files to files."""

import json

import pytest

from corpusmill.__main__ import main
from tests.test_sources import jsonl_below, moses, put, put_parquet, raw_folder


@pytest.fixture
def run(spark, monkeypatch):
    import corpusmill.__main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda: spark)
    return lambda *args: main([str(a) for a in args])


def texts(path):
    return {k: [r.get("text") for f in v for r in f] for k, v in jsonl_below(path).items()}


def test_corpus_and_mixture(run, tmp_path, capsys):
    raw = raw_folder(tmp_path)
    put(tmp_path / "raw" / "af" / "b_ml400.jsonl", '{"text": "second file"}\n')
    config = put(tmp_path / "mix.csv", 'subset,token_count,split\naf,12,"wura,madlad400"\neng_Latn,9,finewebEdu\n')
    run("normalize", "--input", raw, "--output", tmp_path / "corpus")
    run("check-splits", "--input", raw, "--mixture_config", config)
    run("mixture", "--config", config, "--corpus", tmp_path / "corpus", "--output", tmp_path / "out", "--fraction", "1/3")
    told = capsys.readouterr().out.splitlines()
    assert "af: 3 rows, 4 tokens" in told and "eng_Latn: 3 rows, 3 tokens" in told and "total: 6 rows, 7 tokens" in told
    got = texts(tmp_path / "out" / "mix_f1-3")
    assert sorted(got["lang=af"]) == ["m", "passage", "second file"] and got["lang=eng_Latn"] == ["e"] * 3


def test_further_languages(run, spark, tmp_path):
    rows = spark.createDataFrame([("twi_Latn", "s", f"t{i}") for i in range(9)], "lang string, split string, text string")
    rows.repartition(3).write.partitionBy("lang", "split").parquet(str(tmp_path / "corpus"))
    run("extended", "--corpus", tmp_path / "corpus", "--output", tmp_path / "out", "--sample_times", 2)
    got = texts(tmp_path / "out")["lang=twi_Latn"]
    assert sorted(got) == sorted([f"t{i}" for i in range(9)] * 2)


def test_bitext_from_lines_to_records(run, tmp_path, capsys):
    n = 40
    moses(tmp_path / "m", "en-sw", [f"an english sentence {i:03d}" for i in range(n)], [f"sentensi ya kiswahili {i:03d}" for i in range(n)], ["1"] * n)
    run("align", "--input", tmp_path / "m", "--output", tmp_path / "bitext")
    bitext = put_parquet(tmp_path / "files" / "en-sw.parquet", sentence1=["x" * i for i in range(n)], sentence2=["y"] * n)
    run("score", "--input", tmp_path / "files", "--output", tmp_path / "scores", "--model", "tests.stand_in_models:scorer")
    config = put(tmp_path / "c.json", json.dumps({
        "languages": ["eng_Latn", "swa_Latn"], "task": "sft",
        "pipeline": {"single": [{"name": "FilterbyScore", "kargs": {"strategy": "absolute", "threshold": 0.3}}]},
    }))
    args = ("bitext", "--bitext", tmp_path / "bitext", "--scores", tmp_path / "scores", "--output", tmp_path / "out", "--config", config)
    run(*args)
    records = [r for f in jsonl_below(tmp_path / "out")["pair=en-sw"] for r in f]
    assert len(records) == 10 and records[0]["system"] == "Translate the English content to Swahili."
    assert [t["from"] for t in records[0]["conversations"]] == ["human", "gpt"]
    capsys.readouterr()
    run(*args)  # everything is there already
    assert "en-sw" not in capsys.readouterr().out
    assert len([r for f in jsonl_below(tmp_path / "out")["pair=en-sw"] for r in f]) == 10
    names = put(tmp_path / "names.csv", "code,name\nswa_Latn,Kiswahili\n")
    run(*args[:-4], "--output", tmp_path / "named", "--config", config, "--names", names)
    assert jsonl_below(tmp_path / "named")["pair=en-sw"][0][0]["system"].endswith("to Kiswahili.")
    run("split", "--input", tmp_path / "files", "--output", tmp_path / "shards", "--target_gb", 1)
    assert bitext and jsonl_below(tmp_path / "shards" / "manifest")


def test_merge_of_scored_shards(run, spark, tmp_path):
    for i in (1, 2):
        put_parquet(tmp_path / "s" / "en-fr" / f"en-fr{i}.parquet", score=[float(i)] * 2)
    put(tmp_path / "manifest.json", "\n".join(json.dumps({"source": "en-fr", "index": i, "num_rows": 2}) for i in (1, 2)))
    run("merge", "--shards", tmp_path / "s", "--manifest", tmp_path / "manifest.json", "--output", tmp_path / "out")
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("row_id").collect()
    assert [(r.pair, r.row_id, r.comet_score) for r in rows] == [("en-fr", i, 1.0 + i // 2) for i in range(4)]


def test_recipes(run, tmp_path):
    put_parquet(tmp_path / "m" / "a.parquet", text=[f"t{i}" for i in range(30)], token_count=[1] * 30)
    run("recipe", "math", "--input", tmp_path / "m", "--output", tmp_path / "math", "--max_tokens", 12, "--part_size", 5)
    assert sorted(map(len, texts(tmp_path / "math").values())) == [2, 5, 5]
    for i in (1, 2):
        put(tmp_path / "c" / f"shard-{i:05d}.jsonl.gz", "".join(json.dumps({"query": f"q{i}", "document": f"d{j}"}) + "\n" for j in range(4)))
    run("recipe", "code", "--input", tmp_path / "c", "--output", tmp_path / "code", "--max_samples", 3)
    got = texts(tmp_path / "code")["part_id=1"]
    assert len(got) == 3 and all(t.startswith("q1\n\nd") for t in got)


def test_sources_and_translation(run, tmp_path):
    put_parquet(tmp_path / "w" / "a.parquet", text=["x" * 300] * 6, top_choice_prob=[0.9] * 6, top_choice_index=[2, 2, 4, 5, 2, 4])
    run("sources", "web", "--input", tmp_path / "w", "--output", tmp_path / "web", "--samples", 2)
    assert {k: len(v) for k, v in texts(tmp_path / "web").items()} == {"domain=Software_Dev": 2, "domain=Education_Jobs": 2}
    put_parquet(tmp_path / "m" / "a.parquet", problem=["p", " "], generated_solution=["s", "s"])
    run("sources", "math", "--input", tmp_path / "m", "--output", tmp_path / "math")
    assert texts(tmp_path / "math") == {"domain=Math": ["<problem>p</problem>\ns"]}
    source = put(tmp_path / "in.jsonl", '{"text": "hello"}\n')
    args = ("translate", "--input", source, "--output", tmp_path / "tr", "--model", "tests.stand_in_models:generator")
    run(*args, "--targets", "eng_Latn", "swa_Latn")
    got = texts(tmp_path / "tr")
    assert got["target_language=eng_Latn"] == ["hello"] and "HELLO" in got["target_language=swa_Latn"][0]
    run(*args, "--targets", "swa_Latn", "hau_Latn")
    assert len(texts(tmp_path / "tr")) == 3


def test_what_was_left_out_is_told(run, tmp_path, capsys):
    put(tmp_path / "raw" / "af" / "af_clean_0000.jsonl.gz", '{"text": "a"}\nbad\n[1]\n')
    put(tmp_path / "raw" / "af" / "af_clean_0001.jsonl.gz", '{"text": "b"}\n{"text"\n')
    run("normalize", "--input", tmp_path / "raw", "--output", tmp_path / "corpus")
    assert "json_lines_chunks: skipped 3 of 5 lines\n" in capsys.readouterr().out
    moses(tmp_path / "m", "en-sw", ["a", "b"], ["x", "y"], ["1", "2"])
    moses(tmp_path / "m", "en-so", ["a", "b"], ["x"], ["1", "2"])
    moses(tmp_path / "m", "en-xh", ["a"], ["x"], ["high"])
    run("align", "--input", tmp_path / "m", "--output", tmp_path / "b")
    told = capsys.readouterr().out.splitlines()
    assert [line for line in told if line.startswith("left out")] == [
        "left out en-so: 2 and 1 lines, 2 scores, 2 of them numbers", "left out en-xh: 1 and 1 lines, 1 scores, 0 of them numbers"]


def test_published_chunks_are_one_split(run, spark, tmp_path):
    put(tmp_path / "raw" / "af" / "af_clean_0000.jsonl.gz", '{"text": "a"}\n')
    put(tmp_path / "raw" / "af" / "af_clean_0001.jsonl.gz", 'bad\n{"text": "b"}\n')
    run("normalize", "--input", tmp_path / "raw", "--output", tmp_path / "corpus")
    rows = spark.read.parquet(str(tmp_path / "corpus")).orderBy("ord")
    assert [(r.split, r.text, r.meta.id, r.dataset_origin) for r in rows.collect()] == [
        ("madlad400", "a", "madlad400_af_0", "madlad400"), ("madlad400", "b", "madlad400_af_2", "madlad400")]


def test_web_texts_in_parts(run, spark, tmp_path):
    for k in range(3):
        put_parquet(tmp_path / "w" / f"f{k}.parquet", text=[" " if i == 3 else f" file {k} row {i} " for i in range(10)])
    run("web-sample", "--input", tmp_path / "w", "--output", tmp_path / "o", "--max_tokens", 50, "--part_size", 5)
    rows = spark.read.parquet(str(tmp_path / "o")).collect()
    want = [f"file {k} row {i}" for k in range(3) for i in range(10) if i != 3][:13]  # four tokens each
    assert {p: sorted(r.text for r in rows if r.part_id == p) for p in (1, 2, 3)} == {1: want[:5], 2: want[5:10], 3: want[10:]}


def test_texts_of_other_rows(run, tmp_path):
    source = put(tmp_path / "d.jsonl", '{"headline": " H", "content": "c ", "url": "u"}\n{"headline": null, "content": "x"}\n')
    run("texts", "documents", "--input", source, "--output", tmp_path / "o")
    records = sorted((r for files in jsonl_below(tmp_path / "o").values() for f in files for r in f), key=lambda r: r["text"])
    assert [(r["text"], r["hyperparam"].get("url")) for r in records] == [("H c", "u"), ("x", None)]
    source = put_parquet(tmp_path / "s.parquet", sentence=["one", "two"], x=[1, 2])
    run("texts", "rows", "--input", source, "--output", tmp_path / "p")
    assert sorted(r["text"] for files in jsonl_below(tmp_path / "p").values() for f in files for r in f) == ["one", "two"]
