"""Search, tokens, language model, packing, classifiers and extraction against plain versions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
import tiktoken
from tokenizers import Tokenizer

from corpusmill.llm import byte_bpe, extraction as ex, hashing, lattice, packing, quality as ql, topk, toxicity as tx

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    "", None, " ", "\n\n \t", "Hello World", "it's WE'RE 12345 ***!!", "a" * 5000, "naïve café 中文 😀 é",
    "<|endoftext|> <|startoftext|>", "x y z \x1c\x85", "ha" * 300,
]


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


# search


def test_top_k_equals_brute_force(spark):
    rng = random.Random(1)
    vectors = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(150)]
    vectors += [vectors[0]] * 60 + [[0.0] * 6] * 5 + [[1.0, 2.0]] * 3  # ties, and another length
    rows = [(i, v) for i, v in enumerate(vectors)] + [
        (300, None), (320, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (340, [math.nan] * 6), (360, [math.inf] * 6), (None, [1.0] * 6),
        (0, vectors[0]), (-20, [-1.0] * 6),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q, v in good.items():
        if q % 20 == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v)
            )
            want |= {(q, n, i, -s) for n, (s, i) in enumerate(scored[:20], 1)}
    vectors = topk.integer_vectors(df)
    queries = vectors.where("vec_id % 20 = 0")
    assert set(map(tuple, topk.top_k(queries, vectors, 20).collect())) == want
    assert set(map(tuple, topk.top_k(queries, vectors, 20, query_block=3, block=40).collect())) == want
    assert topk.similar_vectors(df.where("false")).count() == 0


@pytest.mark.parametrize("scale", [30, 10**6, 10**9])
def test_block_top_k_stops_early_and_is_exact(scale):
    rng = np.random.default_rng(2)
    vectors, ids = rng.integers(-scale, scale, (500, 8)), rng.permutation(10_000)[:500]
    queries = vectors[:20]
    row, name, score = topk.block_top_k(queries, ids[:20], vectors, ids, 7, depths=(0.1, 0.3, 0.5, 0.8, 1.0), list_block=90)
    products = queries @ vectors.T
    for q in range(20):
        order = [i for i in np.lexsort([ids, -products[q]]) if i != q][:7]
        mine = sorted(zip(-score[row == q], name[row == q]))
        assert mine == [(-products[q, i], ids[i]) for i in order]


# tokens


def test_byte_tokens_equal_the_library(make_docs):
    ranks = byte_bpe.Vocabulary.read(BYTE_RANKS).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = ODD_TEXTS + ["".join(rng.choices("abcdefé中 \n'strx19.", k=rng.randrange(200))) for _ in range(60)]
    own = byte_bpe.encoder(BYTE_RANKS, public_tokenizers.PATTERN)
    for text in filter(None, texts):
        ids = library.encode_ordinary(text)
        assert own.encode(text) == ids and own.decode(ids) == text.encode()
    rows = byte_bpe.byte_tokens(make_docs(texts), BYTE_RANKS, public_tokenizers.PATTERN).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {
        i: len(library.encode_ordinary(t or "")) for i, t in enumerate(texts)
    }


def test_prefix_encoder_appends_and_edits():
    vocabulary = byte_bpe.encoder(BYTE_RANKS, public_tokenizers.PATTERN).vocabulary
    rng = random.Random(4)
    text = bytearray(b"the quick brown fox jumps over the lazy dog and its internationalisation " * 4)
    own = byte_bpe.PrefixEncoder(vocabulary, bytes(text))
    for _ in range(60):
        i = rng.randrange(len(text) + 1)
        j, new = min(len(text), i + rng.randrange(6)), bytes(rng.choices(b"abcdefgh the", k=rng.randrange(8)))
        own.replace(i, j, new)
        text[i:j] = new
        assert own.last == byte_bpe.PrefixEncoder(vocabulary, bytes(text)).last
    before = list(own.last)
    own.append(b" more")
    assert own.last[: len(before)] == before
    assert [vocabulary.tokens[t] for t in own.tokens(5)] == [
        vocabulary.tokens[t] for t in byte_bpe.PrefixEncoder(vocabulary, bytes(text[:5])).tokens()
    ]


def own_ids(tokenizer, text):
    (chunk,) = hashing.chunks(pa.array([text]))
    return tokenizer.ids(chunk)[0]


def test_word_cache_survives_new_generations(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 5)
    monkeypatch.setattr(packing, "CACHED", 5)
    own = byte_bpe.Encoder(byte_bpe.encoder(BYTE_RANKS, public_tokenizers.PATTERN).vocabulary, public_tokenizers.PATTERN)
    words = packing.WordTokenizer(WORD_FILE)
    library = Tokenizer.from_file(WORD_FILE)
    for k in range(6):
        text = " ".join(f"word{n} other{n % 3}" for n in range(k, k + 5))
        assert own.digests([text])[0][0] == len(own.encode(text))
        assert np.frombuffer(own_ids(words, text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("joined", [1, 7, 100])
def test_plain_words_are_merged_without_normalising(monkeypatch, joined):
    monkeypatch.setattr(packing, "JOINED", joined)
    rng = random.Random(4)
    letters = "aZ09 |_-.,éÉßÿÃ¡\n"
    texts = ["".join(rng.choice(letters + odd) for _ in range(rng.randrange(40))) for odd in ("", "'<>×÷\u0301İ中\U0001f600\x00\x7f\xa0") for _ in range(300)]
    own, whole = packing.WordTokenizer(WORD_FILE), Tokenizer.from_file(WORD_FILE)
    slow, encoded = [], own._encoded
    monkeypatch.setattr(own, "_encoded", lambda spelt: slow.extend(spelt) or encoded(spelt))
    found = [ids for chunk in hashing.chunks(pa.array(texts)) for ids in own.ids(chunk)]
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == [i for w in text.split() for i in whole.encode(w, add_special_tokens=False).ids]
    assert slow and all(set(word) - set(letters) or "¡" in word for word in slow)


def test_half_a_million_words_are_encoded_once(monkeypatch):
    texts = pa.array([" ".join(f"w{n}" for n in range(at, at + 5000)) for at in range(0, 500_000, 5000)])
    own, calls = packing.WordTokenizer(WORD_FILE), []
    first = [ids for chunk in hashing.chunks(texts) for ids in own.ids(chunk)]
    merged = own._merged
    monkeypatch.setattr(own, "_merged", lambda *found: calls.append(len(found[2])) or merged(*found))
    assert [ids for chunk in hashing.chunks(texts) for ids in own.ids(chunk)] == first and not calls
    monkeypatch.setattr(packing, "CACHED", 1000)
    assert [ids for chunk in hashing.chunks(pa.array(["w1 new w499999"])) for ids in own.ids(chunk)] and calls == [1]
    assert len(own.known.keys) == 3


# packing


def test_packing_is_exact(make_docs):
    library = Tokenizer.from_file(WORD_FILE)
    rng = random.Random(5)
    texts = ODD_TEXTS + [" ".join(rng.choices("alpha beta gamma de la".split(), k=rng.choice([3, 50, 900, 9000]))) for _ in range(40)]
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in enumerate(texts)}
    rows = packing.pack(make_docs(texts), WORD_FILE, group_windows=4).collect()
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        at[r["doc_id"]] += r["length"]
    assert all(at[i] == len(own) for i, own in ids.items())
    end = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == end[r["sequence_id"]]
        end[r["sequence_id"]] += r["length"]
    assert max(end.values()) <= 4096
    assert packing.pack(make_docs([]), WORD_FILE).count() == 0


@pytest.mark.parametrize("texts, n", [(["alpha beta"] * 20_000, 3), ([None] * 100_000, 1)])
def test_equal_rows_are_dealt_into_many_groups(make_docs, texts, n):
    rows = packing.pack(make_docs(texts, [None] * len(texts)), WORD_FILE, group_windows=4, group_pieces=20_000).toPandas()
    assert len(rows) == len(texts) and (rows["length"] == n).all()
    assert (rows["sequence_id"] // (1 << 24)).value_counts().max() < 25_000
    ends = rows.sort_values("offset").groupby("sequence_id")["length"].sum()
    assert ends.max() <= 4096
    assert not rows.duplicated(["sequence_id", "offset"]).any()


@pytest.mark.parametrize("n, windows", [(3, 5), (50, 1), (400, 30), (1000, 64)])
def test_differencing_balances(n, windows):
    sizes = np.random.default_rng(n).integers(1, 1024, n)
    place = packing.karmarkar_karp(sizes, windows)
    sums = np.bincount(place, sizes, windows)
    assert place.min() >= 0 and place.max() < windows and sums.sum() == sizes.sum()
    if n >= 10 * windows:
        assert sums.max() - sums.min() <= 30
    full = packing.balanced_windows(sizes, 4096)
    assert np.bincount(full, sizes).max() <= 4096
    assert full.max() + 1 <= -(-sizes.sum() // 4096) + 2


# language model


def brute_probability(model, word):
    spelt = lattice.WORD_BEGIN + word
    weights = {p: w for p, w in model.tree.items() if w is not None}

    def rest(i):
        if i == len(spelt):
            return math.exp(model.end)
        total = 0 if spelt[i] in weights else math.exp(sum(model.bytes[b] for b in spelt[i].encode())) * rest(i + 1)
        return total + sum(math.exp(weights[spelt[i:j]]) * rest(j) for j in range(i + 1, len(spelt) + 1) if spelt[i:j] in weights)

    return rest(0)


def test_lattice_sums_all_segmentations():
    scores = lattice.piece_scores(PIECES)
    assert abs(sum(map(math.exp, scores.values())) - 1) < 1e-9
    model = lattice.Lattice(scores)
    for word in ("a", "there", "über", "日本x", "abc1"):
        assert math.isclose(model.log_probability(word), math.log(brute_probability(model, word)), rel_tol=1e-9)
        found = Counter()
        model.expect(word, found)
        assert found[lattice.WORD_END] == 1
        slow = Counter()
        model._expect_long(lattice.WORD_BEGIN + word, slow)
        assert set(slow) == set(found) and all(math.isclose(slow[p], n, rel_tol=1e-6) for p, n in found.items())
        letters = sum(n * (1 if p.startswith("<0x") else len(p.encode())) for p, n in found.items() if p != lattice.WORD_END)
        assert math.isclose(letters, len((lattice.WORD_BEGIN + word).encode()), rel_tol=1e-6)
    assert math.isfinite(model.log_probability("z" * 3000))
    found = Counter()
    model.expect("z" * 3000, found)
    assert sum(n * len(p) for p, n in found.items() if p != lattice.WORD_END) > 2999


@pytest.mark.parametrize("hot", [0, 10, 10**6])
def test_scores_of_texts(make_docs, monkeypatch, hot):
    monkeypatch.setattr(lattice, "HOT_WORDS", hot)
    rng = random.Random(6)
    texts = ["", None, "one", "A a b", "new" * 500] + [
        " ".join(rng.choices(["the", "of", "Rain", "é", *[f"w{i}" for i in range(60)]], k=rng.randrange(1, 60))) for _ in range(60)
    ]
    ids = [None, *range(1, len(texts))]
    split = [(t or "").encode().lower().split() for t in texts]
    train = Counter()
    for i, own in zip(ids, split):
        if crc(i) % 10:
            train.update([*own, "end"])
    total, types = sum(train.values()), len(train)
    rows = {r["doc_id"]: r for r in lattice.score_texts(make_docs(texts, ids), PIECES, rounds=1).collect()}
    for i, own in zip(ids, split):
        r = rows[i]
        want = sum(math.log10((train[w] + 0.1) / (total + 0.1 * (types + 1))) for w in [*own, "end"])
        assert math.isclose(r["base_score"], want, rel_tol=1e-9)
        assert (r["n_tokens"], r["train_tokens"]) == (len(own) + 1, total)
        assert r["n_known"] == sum(train[w] > 0 for w in [*own, "end"])
        assert r["held_out"] == (crc(i) % 10 == 0)
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert len(rows) == len(texts)


def test_scores_without_texts(make_docs):
    assert lattice.score_texts(make_docs([]), PIECES, rounds=1).count() == 0
    (row,) = lattice.score_texts(make_docs(["all held out"], [next(i for i in range(99) if crc(i) % 10 == 0)]), PIECES, rounds=1).collect()
    assert row["train_tokens"] == row["n_known"] == 0 and math.isfinite(row["score"]) and row["base_score"] == 0


# classifiers


def labelled_corpus(rng, n):
    texts, toxic, quality = [], [], []
    plain = [f"word{i}" for i in range(300)]
    for _ in range(n):
        bad, junk = rng.random() < 0.2, rng.random() < 0.2
        words = rng.choices(plain, k=rng.randrange(30, 120))
        if bad:
            words[5:5] = [rng.choice(["scum", "clown", "stenka", "stenko", "stenki"]) for _ in range(3)]
        if junk:
            words = [w + "%%%" for w in words]
        texts.append(" ".join(words))
        toxic.append(int(bad))
        quality.append(int(not junk))
    return texts, toxic, quality


def test_classifiers_hold_out_and_learn(make_docs, make_labels):
    texts, toxic, quality = labelled_corpus(random.Random(7), 500)
    odd = ["", None, "x " * 20_000]
    docs = make_docs(texts + odd)
    labels = make_labels([(i, q, t) for i, (q, t) in enumerate(zip(quality, toxic))] + [(None, 1, None), (9_999, None, 1)])
    for rows, want, modulus, rest in (
        (tx.toxicity(docs, labels), toxic, 3, 1), (ql.quality(docs, labels), quality, 5, 0)
    ):
        got = {r["doc_id"]: r for r in rows.collect()}
        assert set(got) == set(range(len(texts) + len(odd)))
        assert all(r["held_out"] == (crc(i) % modulus == rest) and 0 <= r["score"] <= 1 for i, r in got.items())
        held = [i for i in range(len(texts)) if got[i]["held_out"]]
        assert np.mean([got[i]["predicted"] == want[i] for i in held]) > 0.95


def test_classifiers_do_not_see_held_out_labels(make_docs, make_labels):
    texts, toxic, quality = labelled_corpus(random.Random(8), 200)
    docs = make_docs(texts)
    for make, modulus, rest in ((tx.toxicity, 3, 1), (ql.quality, 5, 0)):
        own = [(i, q, t) for i, (q, t) in enumerate(zip(quality, toxic))]
        turned = [(i, 1 - q, 1 - t) if crc(i) % modulus == rest else (i, q, t) for i, q, t in own]
        one, two = (sorted((r["doc_id"], round(r["score"], 6)) for r in make(docs, make_labels(x)).collect()) for x in (own, turned))
        assert one == two


def test_classifiers_without_labels_or_texts(make_docs, make_labels):
    none = make_labels([])
    for make in (tx.toxicity, ql.quality):
        assert make(make_docs([]), none).count() == 0
        rows = make(make_docs(["a b", None, ""], [1, 1, None]), none).collect()
        assert len(rows) == 3 and all(0 <= r["score"] <= 1 for r in rows)


def test_filters_keep_rows_as_they_are(make_docs, make_labels):
    texts, toxic, quality = labelled_corpus(random.Random(9), 300)
    docs = make_docs(texts)
    labels = make_labels([(i, q, t) for i, (q, t) in enumerate(zip(quality, toxic))])
    kept = tx.without_toxic(docs, tx.train(docs, labels)).collect()
    assert set(map(tuple, kept)) <= set(map(tuple, docs.collect()))
    assert sum(1 - toxic[r["doc_id"]] for r in kept) == toxic.count(0)
    model, _ = ql.train(docs, labels)
    good = ql.of_quality(docs, model).collect()
    assert set(map(tuple, good)) <= set(map(tuple, docs.collect()))
    assert {r["doc_id"] for r in good} >= {i for i, q in enumerate(quality) if q}


def test_quality_is_learnt_from_few_texts(make_docs, make_labels, monkeypatch):
    for seed, most in ((4, ql.SUMMED), (5, 1)):  # the sums of the tasks are added up on the driver, or in the cluster
        monkeypatch.setattr(ql, "SUMMED", most)
        texts, _, quality = labelled_corpus(random.Random(seed), 300)
        model, _ = ql.train(make_docs(texts), make_labels([(i, q, 0) for i, q in enumerate(quality)]))
        assert np.mean((model.scores(texts) >= ql.THRESHOLD) == quality) >= 0.99


def test_label_model_finds_accurate_voters():
    rng = np.random.default_rng(10)
    y = rng.random(4000) < 0.2
    votes = np.stack([np.where(rng.random(4000) < a, y, rng.random(4000) < 0.02) for a in (0.9, 0.8, 0.7, 0.1)], 1).astype(int)
    votes = np.concatenate([votes, votes[:, :1]], 1)  # a copy of the first voter
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = tx.LabelModel(patterns, counts.astype(float))
    assert abs(model.prior - 0.2) < 0.05
    assert np.mean((model.posterior(patterns)[inverse] > 0.5) == y) > 0.95
    assert model.parent[4] == 0 or model.parent[0] == 4


# extraction


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("just text &amp; more", "just text & more"),
    ("<nav>Menu</nav><article><h1>A&nbsp; b</h1><p>One<p>two <b>three</b>four<br>five</article><footer>F</footer>",
     "A b One two threefour five"),
    ("<body><main><div class='ad'>Buy</div><p>Text&#233;</p><aside>Side</aside><form>Name</form></main>", "Texté"),
    ("<article><header><h1>Title</h1></header><p>x</p><footer>by me</footer><section id='comments'>c</section></article>", "Title x"),
    ("<article>a</article><article class='comment'>no</article>", "a"),
    ("<article><script>var t='</p>';</script><style>p{}</style><p>ok<!-- no --></p><ul><li>1<li>2</ul></article>", "ok 1 2"),
    ("<div hidden>no</div><div class='cookie-notice'>no</div><p>yes</p>", "yes"),
])
def test_main_text_of_single_pages(page, text):
    assert ex.extract(page, []) == text


def test_wrapper_is_learnt_from_pages_of_the_host():
    def page(k):
        body = "".join(f"<p>story {k} part {n} " + "words " * 20 + "</p>" for n in range(k % 5 + 1))
        return f"<body><div><span>Home</span><span>News</span></div><div><h2>Title {k}</h2>{body}</div><div>All of it by us</div>"

    others = [ex.parse(page(k)) for k in range(4)]
    assert ex.extract(page(9), others).startswith("Title 9 story 9 part 0 words")
    assert "Home" not in ex.extract(page(9), others) and "by us" not in ex.extract(page(9), others)
    assert ex.extract(page(9), [ex.parse(page(9))]).startswith("HomeNews Title 9")  # a copy tells nothing
    assert ex.extract("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after</p>", others) == "deep after"


def test_template_inside_marked_articles():
    def page(k, tag="article", more="<div class='box'>Keep up with us every week</div>"):
        return f"<body><{tag}><header>Our paper</header><h1>Title {k}</h1>{more}<p>story {k} of the day</p></{tag}></body>"

    for tag in ("article", "main"):
        others = [ex.parse(page(k, tag)) for k in range(4)]
        assert ex.extract(page(9, tag), others) == "Title 9 story 9 of the day"
        assert ex.extract(page(9, tag), others, [ex.said_key(ex.parse("<header>Our paper</header>").children[0])]) == (
            "Title 9 Keep up with us every week story 9 of the day")
        # two pages that agree, and versions of one article, tell nothing about what stands in it
        assert ex.extract(page(9, tag), others[:1]).startswith("Our paper Title 9 Keep up")
        assert ex.extract(page(3, tag) + "<div>other</div>" * 9, others[3:] * 3).startswith("Our paper Title 3 Keep up")


def test_main_around_articles_is_text():
    page = ("<nav>Menu</nav><main><h1>Head</h1><p>Lead</p><article><p>Story</p><article class='comment'>no</article></article>"
            "<section><p>Later</p></section><aside>Side</aside></main><article>Other</article><footer>F</footer>")
    assert ex.extract(page, []) == "Head Lead Story Later Other"


def test_articles_are_judged_by_all_pages_of_the_host(spark):
    ids = spark.range(20).select("id", F.concat(F.lit("https://h.example.org/"), "id").alias("url"))
    # the pages of smallest hash, which the others are aligned with, share a line; few others have it
    chosen = {r["id"] for r in ids.orderBy(F.xxhash64("id", "url")).limit(ex.SAMPLES).collect()}
    lines = chosen | set([i for i in range(20) if i not in chosen][:4])
    rows = [
        (r["id"], r["url"], f"<article><h1>Title {r['id']}</h1><p>story {r['id']}</p>" + "<p>As we said</p>" * (r["id"] in lines)
         + "<div>Keep up with us</div></article>")
        for r in ids.collect()
    ]
    got = {r["page_id"]: r["text"] for r in ex.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Title {i} story {i}" + " As we said" * (i in lines) for i in range(20)}


def test_tree_matching_counts_nodes():
    one, two = ex.parse("<ul><li>a</li><li>b</li></ul><p>x</p>"), ex.parse("<ul><li>a</li></ul><div></div><p>y</p>")
    assert ex.tree_matching(one, one) == one.size == 6  # the page, the list, its items and their texts, p and its text
    assert ex.tree_matching(one, two) == 6
    pairs = []
    assert ex.tree_matching(one, ex.parse("<ul><li><b>a</b></li></ul>"), pairs) == 3
    assert [x.tag for x, _ in pairs] == ["#page", "ul", "li"]


def test_main_texts_of_a_table(spark):
    rows = [(i, f"https://h{i % 3}.example.org/x?{i}", f"<nav>m</nav><article><p>text {i}</p></article>", "z") for i in range(60)]
    rows += [(60, None, "<p>alone</p>", "z"), (61, "nonsense", None, "z"), (61, "", "", "z"), (None, "http://H1.example.org", "<p>k</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, samples string")
    got = sorted((r["page_id"] if r["page_id"] is not None else -1, r["text"], r["n_chars"]) for r in ex.main_texts(pages).collect())
    want = [(-1, "k", 1), (60, "alone", 5), (61, "", 0), (61, "", 0)] + [(i, f"text {i}", len(f"text {i}")) for i in range(60)]
    assert got == sorted(want)
    assert ex.main_texts(pages.where("false")).count() == 0
