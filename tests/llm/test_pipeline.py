"""The registered queries, and the pipeline from a folder of tables."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests import oracle
from tests.llm.test_duplicates import edited, expected_groups, prose

SMALL = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert set(entry.oracle_sql()) <= set(names)


def test_top_k_equals_sql(spark):
    own = entry.queries()["op1_top_k"](spark, SMALL)
    assert oracle.difference(own, oracle.connect(SMALL), entry.oracle_sql()["op1_top_k"]) is None


@pytest.fixture(scope="module")
def folder(spark, make_docs, make_labels, tmp_path_factory):
    rng = random.Random(11)
    texts, labels = [], []
    for i in range(160):
        words = prose(rng, rng.randrange(60, 150)).split()
        toxic, junk = i % 8 == 1, i % 8 == 2
        if toxic:
            words[7:7] = rng.sample(["scum", "clown", "moron", "idiot"], 3)
        if junk:
            words = [w.upper() + "!!" for w in words]
        texts.append(" ".join(words))
        labels.append((i, int(not junk), int(toxic)))
    passage = prose(rng, 70)
    texts += [edited(rng, texts[8], 1), texts[16], texts[24] + " " + passage, prose(rng, 80) + "\n" + passage, "", None]
    path = str(tmp_path_factory.mktemp("tables"))
    make_docs(texts).drop("cuts", "own").write.parquet(f"{path}/documents.parquet")
    make_labels(labels).write.parquet(f"{path}/labels.parquet")
    return path, texts, labels


def test_stages_take_effect(spark, folder):
    path, texts, labels = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, left = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), docs.schema)
        assert docs.columns == columns
        left.append({r["doc_id"]: r["text"] for r in docs.collect()})
    toxic = {i for i, _, t in labels if t}
    junk = {i for i, q, _ in labels if not q}
    assert len(toxic & set(left[0])) <= 2 and set(left[0]) >= set(range(len(texts))) - toxic
    assert len(junk & set(left[1])) <= 4, sorted(junk & set(left[1]))
    assert set(left[1]) >= set(range(164)) - toxic - junk
    groups, _ = expected_groups([left[1].get(i) for i in range(len(texts))])
    assert set(left[2]) == {i for i in left[1] if groups[i] == i}
    assert 160 not in left[2] and 161 not in left[2]
    assert left[3][162] == texts[162][len(texts[24]) :].strip()  # what it shares with 24 is long enough
    assert left[3][163] == texts[163].split("\n")[0]
    assert {i: t for i, t in left[3].items() if i < 160} == {i: t for i, t in left[2].items() if i < 160}


def test_run_packs_what_is_left(spark, folder):
    path, texts, _ = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"] for r in rows} >= {0, 8, 163} and not {r["doc_id"] for r in rows} & {160, 161}
    totals = {}
    for r in rows:
        totals[r["sequence_id"]] = totals.get(r["sequence_id"], 0) + r["length"]
    assert max(totals.values()) <= 4096


def test_pipeline_of_empty_tables(spark, make_docs, make_labels, tmp_path):
    make_docs([]).drop("cuts", "own").write.parquet(f"{tmp_path}/documents.parquet")
    make_labels([]).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_dedup_stage_links_from_80(spark, make_docs):
    text = prose(random.Random(19), 204).split()
    other = ["changed" if i in (20, 70, 120, 170) else w for i, w in enumerate(text)]  # 180 of 220 shingles
    docs = make_docs([" ".join(text), " ".join(other), prose(random.Random(20), 80)])
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {0, 2}
