import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=10):
    """Every document against every item, straight from the definition."""
    terms = [(i, TERM.findall((t or "").translate(FOLD))) for i, t in docs]
    terms = [(i, Counter(t), len(t)) for i, t in terms if t]
    n_docs, n_all = len(terms), sum(n for *_, n in terms)
    df = Counter(t for _, own, _ in terms for t in own)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, []).extend(TERM.findall((t or "").translate(FOLD)))
    out = []
    for i, own in wanted.items():
        scored = []
        for doc_id, held, n in terms:
            m = 100 - 75 + (75 * n * n_docs) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * held[t]) // (1000 * held[t] + 8 * m))
                for t in own if t in held
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(i, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture
def make_items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string, doc_id string, score int, n int").repartition(2)


def random_texts(rng, n, words):
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("block_queries", [1024, 3])
def test_ranks_are_those_of_the_definition(make_docs, make_items, block_queries):
    rng = random.Random(3)
    words = ["Alpha", "beta", "x1", "Éa", "éa", "long-er", "the", "of", "zz", "Straße", "日本"] + [f"w{i}" for i in range(40)]
    texts = random_texts(rng, 60, words) + [None, "", " .,- ", "beta " * 300_000]
    texts += texts[:8] * 3  # ties and copies
    ids = list(range(len(texts)))
    ids[3], ids[5] = None, 4  # no id, repeated id
    items = [(i, t, "d", 1, 2) for i, t in enumerate(random_texts(rng, 12, words))]
    items += [(20, items[0][1], "d", 1, 2), (21, None, "d", 1, 2), (22, "", "d", 1, 2), (23, "never seen", "d", 1, 2)]
    items += [(None, "beta", "d", 1, 2), (1, "beta beta x1", "d", 1, 2)]
    found = lexical.ranked_documents(make_docs(texts, ids), make_items(items), block_queries=block_queries)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(zip(ids, texts), [(i[0], i[1]) for i in items])


def test_empty_tables(make_docs, make_items):
    some, no_docs, no_items = make_items([(0, "a b", "", 0, 0)]), make_docs([]), make_items([])
    assert lexical.ranked_documents(no_docs, some).count() == 0
    assert lexical.ranked_documents(make_docs(["a b"]), no_items).count() == 0
    assert lexical.ranked_documents(make_docs([None, ""]), some).count() == 0


def test_shared_sums_add_up_to_every_query():
    rng = random.Random(5)
    common = [f"c{i}".encode() for i in range(30)]
    queries = [
        Counter(rng.sample(common, 12) + [f"q{q}{i}".encode() for i in range(3)] + [common[0]] * rng.randint(0, 2)) for q in range(40)
    ] + [Counter({f"v{i}".encode(): 1 for i in range(3000)})] * 2 + [Counter()]
    sharing = lexical.shared_sums(queries)
    sums = lexical.Accumulators(sharing)
    values = np.array([[rng.randint(0, 99) for _ in range(5)] for _ in sharing.terms])
    term, doc = np.nonzero(values)
    found = sums.scores(term, doc, values[term, doc], 5)
    place = {t: i for i, t in enumerate(sharing.terms)}
    for own, query in zip(found, queries):
        assert own.tolist() == sum((values[place[t]] * n for t, n in query.items()), np.zeros(5, np.int64)).tolist()
    # fewer additions than one for every term of every query
    assert len(sharing.left) + sum(map(len, sharing.parts)) < 0.8 * sum(q.total() for q in queries)
    assert len(sharing.parts[-2]) < 200  # two equal queries share everything


def test_terms_of_long_texts_are_cut_at_gaps(monkeypatch):
    text = ("Ünï-Code 日本 a1 " * 50).encode()
    whole = Counter(t.encode() for t in TERM.findall(text.decode().translate(FOLD)))
    assert lexical.term_counts(text) == whole
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert lexical.term_counts(text) == whole
