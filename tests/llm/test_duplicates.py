"""Near-duplicates, repeated passages and fingerprints against plain loops."""

import hashlib
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import fingerprints as fp, hashing, passages as ps
from corpusmill.llm import near_dedup as nd
from corpusmill.llm.near_dedup import near_duplicates
from corpusmill.llm.tables import components


def words_of(text):
    return (text or "").encode().lower().split()


def sets(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def prose(rng, n, size=4000):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def expected_groups(texts):
    own = [sets(t) for t in texts]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(own)):
        for j in range(i):
            inside = len(own[i] & own[j])
            if inside and 100 * inside >= 85 * len(own[i] | own[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(own))], [len(s) for s in own]


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_words_are_those_of_the_contract():
    texts = ["", "One  two\tTWO\x0bé x", " lead", "trail ", None, "\n", "ÀB a"]
    got = []
    for chunk in hashing.chunks(pa.array(texts), limit=4):
        own = hashing.words(chunk)
        for i in range(chunk.last - chunk.first):
            lo, hi = own.first[i], own.first[i + 1]
            got.append([chunk.data[a:b].tobytes().lower() for a, b in zip(own.begin[lo:hi], own.end[lo:hi])])
    assert got == [words_of(t) for t in texts]
    one, two = (hashing.words(next(hashing.chunks(pa.array([t])))).hashes for t in ("Abc x ABC", "zz abc"))
    assert one[0] == one[2] == two[1] != one[1]


def test_near_duplicates_equal_brute_force(spark, make_docs):
    rng = random.Random(1)
    base = [prose(rng, n) for n in (120, 300, 60, 40)]
    shared = prose(rng, 80)
    texts = ["", None, "one two", "ONE two", " \n", "a b c d e", "a b c d e f"]
    texts += [edited(rng, b, rng.randrange(0, 5)) for b in base for _ in range(25)]
    texts += base + base  # exact copies
    texts += [shared + " " + prose(rng, 60) for _ in range(30)]  # a passage, no duplicates
    texts += [prose(rng, 12_000, 100_000)]
    groups, sizes = expected_groups(texts)
    got = {r["doc_id"]: r for r in near_duplicates(make_docs(texts)).collect()}
    assert len(got) == len(texts)
    assert [got[i]["component_id"] for i in range(len(texts))] == groups
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_links_between_80_and_85_are_all_found(make_docs):
    rng = random.Random(18)
    texts, linked = [], []
    for _ in range(60):
        text = prose(rng, 204).split()
        other = list(text)
        for place in (20, 70, 120, 170):  # 20 of 200 shingles: 180 / 220
            other[place] = "changed"
        linked.append((len(texts), len(texts) + 1))
        texts += [" ".join(text), " ".join(other)]
    assert all(0.8 <= len(sets(texts[a]) & sets(texts[b])) / len(sets(texts[a]) | sets(texts[b])) < 0.85 for a, b in linked)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(make_docs(texts), threshold=80).collect()}
    assert [(a, b) for a, b in linked if got[b] != a] == []
    assert (nd.as_sure(64, 40, 85), nd.as_sure(512, 400, 85)) == (40, 400)


def test_near_duplicates_odd_rows(make_docs):
    text = "a b c d e f g"
    rows = near_duplicates(make_docs([text, text, text, "", None], [None, 5, 5, None, 7])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in rows) == [
        (-1, -1, True), (-1, -1, True), (5, 5, True), (5, 5, True), (7, 7, True)
    ]
    assert near_duplicates(make_docs([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(300, 330)] + [(310, 5), (9, 8)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 100 for i in range(100, 141))
    assert all(got[i] == 5 for i in [5, 7, *range(300, 330)])
    assert got[8] == got[9] == 8
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pivots_are_the_minima_of_runs():
    rng = np.random.default_rng(3)
    for n, width in ((5, 8), (8, 8), (200, 8), (300, 46)):
        values = rng.integers(1, 50, n).astype(np.uint64)
        ends = np.where(np.arange(n) < n // 2, n // 2, n)
        want = {
            i + k for i in range(n - width + 1) if i + width <= ends[i]
            for k in np.flatnonzero(values[i : i + width] == values[i : i + width].min())
        }
        assert set(ps.pivots(values, ends, width)) == want


def test_extents_reach_to_smaller_values():
    values = np.array([5, 3, 8, 1, 9, 2, 7, 4], np.uint64)
    lows, highs = np.array([0] * 4 + [4] * 4), np.array([4] * 4 + [8] * 4)
    left, right = ps.extents(np.arange(8), values, lows, highs)
    assert left == [0, 0, 2, 0, 4, 4, 6, 6] and right == [1, 3, 3, 4, 5, 8, 7, 8]


def test_near_duplicates_store_a_node_once_and_shuffle_no_texts_for_few(make_docs, monkeypatch):
    rng = random.Random(31)
    texts = [text + end for text in (prose(rng, 120) for _ in range(8)) for end in ("", " one", " two more")]
    docs, stored, write = make_docs(texts), [], nd.materialize
    monkeypatch.setattr(nd, "materialize", lambda df: stored.append(write(df)) or stored[-1])
    assert {r["component_id"] for r in near_duplicates(docs).collect()} == set(range(0, 24, 3))
    prefixes = next(df for df in stored if "keys" in df.columns)
    nodes = [r["node"] for r in prefixes.collect()]
    assert nodes and len(set(nodes)) == len(nodes)
    plan = nd.full_sets(docs, prefixes)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_extents_take_pivots_together():
    rng = np.random.default_rng(3)
    n, texts = 20_000, 40
    values = rng.integers(1, 5_000, n).astype(np.uint64)  # with ties
    lows = np.arange(n) // (n // texts) * (n // texts)
    highs, steps = lows + n // texts, []
    sys.setprofile(lambda frame, event, arg: steps.append(event))
    try:
        left, right = ps.extents(np.arange(n), values, lows, highs)
    finally:
        sys.setprofile(None)
    assert len(steps) < 1_000  # a loop over pivots takes several calls for each
    for i in range(0, n, 7):
        smaller = np.flatnonzero(values[lows[i] : i] <= values[i])
        assert left[i] == (lows[i] + smaller[-1] + 1 if len(smaller) else lows[i])
        smaller = np.flatnonzero(values[i : highs[i]] < values[i])
        assert right[i] == (i + smaller[0] if len(smaller) else highs[i])


def test_buckets_never_ask_for_more_than_similar_windows_share():
    rng = np.random.default_rng(4)
    names = rng.integers(0, 900, (60, 91))
    names[20:40] = rng.integers(0, 30, (20, 91))  # shingles that repeat
    names[50:, 60:] = 0
    bits, needed = ps._buckets(names, names > 0, 41)
    for _ in range(300):
        i = rng.integers(60)
        held = np.flatnonzero(names[i])
        hit = rng.choice(held, min(41, len(held)), replace=False)
        filled = len(set((names[i, hit] % ps.BUCKETS).tolist()))
        assert needed[i] <= filled and needed[i] >= 1
    assert np.bitwise_count(bits).sum(axis=1).tolist() == [len(set((r[r > 0] % ps.BUCKETS).tolist())) for r in names]


def test_repeated_passages_cover_all_exact_repetitions(make_docs):
    rng = random.Random(5)
    passages = [prose(rng, n) for n in (51, 60, 200)]
    texts = ["", None, "short"]
    for i in range(40):
        parts = [prose(rng, rng.randrange(1, 90)), rng.choice(passages), prose(rng, rng.randrange(1, 90))]
        texts.append(" ".join(parts if i % 4 else [parts[0], parts[2]]))
    texts += [" ".join(passages[0].split()[:40]) + " " + prose(rng, 60), passages[1]]
    texts[3:3] = [" ".join(passages[2].split()[:45]) + " " + prose(rng, 60)]  # an early part of a passage
    found = defaultdict(list)
    for r in ps.repeated_passages(make_docs(texts)).collect():
        found[r["doc_id"]].append((r["start_word"], r["end_word"], r["source_ids"]))
    seen, repeated = {}, set()
    for i, text in enumerate(texts):
        w = words_of(text)
        grams = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        for k, gram in enumerate(grams):
            if gram in seen:
                repeated.add(i)
                assert any(s <= k and k + 50 <= e for s, e, _ in found[i]), (i, k)
        seen.update((g, i) for g in grams if g not in seen)
    assert {i for i, v in found.items() if v} == repeated
    assert all(max(sources) < i for i, spans in found.items() for _, _, sources in spans)


def test_windows_of_four_hash_functions_with_wide_contexts(make_docs):
    rows = ps.compact_windows(make_docs([prose(random.Random(17), 400)])).collect()
    assert {r["value"] & 3 for r in rows} == {0, 1, 2, 3}
    assert sum(abs(r["context"]) >> 32 > 0 for r in rows) == len({r["context"] for r in rows}) == len(rows)


def test_windows_that_lead_to_nothing_are_not_stored(make_docs, monkeypatch):
    rng = random.Random(23)
    passage = prose(rng, 200)
    docs = make_docs([passage, *(prose(rng, 60) for _ in range(3)), passage])
    stored, write = [], ps.materialize
    monkeypatch.setattr(ps, "materialize", lambda df: stored.append(write(df)) or stored[-1])
    rows = ps.repeated_passages(docs).collect()
    assert [(r["doc_id"], r["start_word"], r["end_word"], r["source_ids"]) for r in rows] == [(4, 0, 200, [0])]
    assert {r["doc_id"] for r in stored[0].collect()} == {4} and len(stored[0].columns) == 7


def test_passages_that_open_with_a_shorter_common_one(make_docs):
    rng = random.Random(15)
    texts, pairs = [], []
    for i in range(30):
        common, more = prose(rng, 44), prose(rng, 7 + i % 10)
        texts += [f"{prose(rng, 20)} {common} {prose(rng, 20)}" for _ in range(3)]
        texts += [f"{prose(rng, 20)} {common} {more} {prose(rng, 20)}" for _ in range(2)]
        pairs.append((len(texts) - 1, len(texts) - 2, 51 + i % 10))
    got = {r["doc_id"]: r for r in ps.repeated_passages(make_docs(texts)).collect()}
    assert [p for p in pairs if p[0] not in got] == []
    for doc, source, n in pairs:
        assert got[doc]["source_ids"] == [source] and got[doc]["start_word"] == 20 and got[doc]["n_words"] >= n


def test_a_passage_that_stands_twice_in_a_text_is_found_twice(make_docs):
    rng = random.Random(16)
    passage = prose(rng, 60)
    docs = make_docs([passage, f"{passage} {prose(rng, 30)} {passage}"]).repartition(1)
    rows = ps.repeated_passages(docs.where("doc_id = 0").union(docs.where("doc_id = 1"))).collect()
    assert sorted((r["start_word"], r["end_word"]) for r in rows) == [(0, 60), (90, 150)]


def test_inexact_passages_are_found(make_docs):
    rng = random.Random(6)
    misses = 0
    for _ in range(3):
        passage = prose(rng, 100)
        texts = [prose(rng, 50) + " " + passage, edited(rng, passage, 1) + " " + prose(rng, 50)]
        misses += not ps.repeated_passages(make_docs(texts)).count()
    assert misses <= 1


def similar_runs(x, y, width=46, least=0.8):
    """Places of shingles of `x` within runs of `width` that are similar to a run of `y`, straight from the definition."""
    covered = set()
    for i in range(len(x) - width + 1):
        a = set(x[i : i + width])
        for size in range(int(width * least), int(width / least) + 1):
            if any(len(a & set(b)) >= least * len(a | set(b)) for b in (y[j : j + size] for j in range(len(y) - size + 1))):
                covered.update(range(i, i + width))
                break
    return covered


def shingles_of(text):
    w = words_of(text)
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]


def test_sentences_in_another_order_are_no_passage(make_docs):
    rng = random.Random(18)
    ends = prose(rng, 60), prose(rng, 60)
    one, two = prose(rng, 27), prose(rng, 27)
    texts = [f"{ends[0]} {one} {prose(rng, 300)} {two} {ends[1]}", f"{ends[0]} {prose(rng, 30)} {one} {two} {prose(rng, 30)} {ends[1]}"]
    core, parts = prose(rng, 60), [prose(rng, 25) for _ in range(12)]
    texts += [f"{core} {prose(rng, 40)} {' '.join(parts)}"]
    texts += [f"{core} {prose(rng, 40)} {' '.join(parts[::-1])}"]
    got = defaultdict(list)
    for r in ps.repeated_passages(make_docs(texts)).collect():
        got[r["doc_id"]].append((r["start_word"], r["end_word"], r["similarity"]))
    assert sorted(got[1]) == [(0, 60, 1.0), (174, 234, 1.0)] and got[3] == [(0, 60, 1.0)] and len(got) == 2


def test_every_span_lies_in_similar_passages(make_docs):
    rng = random.Random(19)
    checked = found = 0
    for share in (0.02, 0.04, 0.08):
        passage = prose(rng, 90)
        sentences = [prose(rng, rng.randrange(10, 30)) for _ in range(6)]
        texts = [" ".join([prose(rng, 40), passage, *sentences]), " ".join([*rng.sample(sentences, 6), edited(rng, passage, int(90 * share)), prose(rng, 20)])]
        x, y = shingles_of(texts[1]), shingles_of(texts[0])
        allowed = similar_runs(x, y)
        for r in ps.repeated_passages(make_docs(texts)).collect():
            checked += 1
            assert set(range(r["start_word"], r["end_word"] - 4)) <= allowed
            assert r["similarity"] >= 0.8
        found += bool(allowed)
    assert checked and found


def test_blocks_follow_the_places_of_both():
    y = np.array([1, 2, 3, 4, 9, 9, 3, 4, 5, 6, 7, 8], np.uint32)
    assert ps.common_blocks(np.array([3, 4, 5, 6], np.uint32), y) == [(0, 4, 6)]
    assert ps.common_blocks(np.array([0, 1, 2, 3, 4, 0, 7], np.uint32), y) == [(1, 5, 0), (6, 7, 10)]
    assert ps.common_blocks(np.array([0], np.uint32), y) == []
    # a passage whose parts all stand in other places as well
    a, b, c = (list(range(k, k + 30)) for k in (100, 200, 300))
    other = np.array(a + b + [1] + b + c + [2] + a + b + c, np.uint32)
    assert ps.matched_segments(np.array(a + b + c, np.uint32), other, 46, 0.8) == [(0, 89, 1.0)]


def plain_covered(hits, width, share):
    sums, n = np.concatenate([[0], np.cumsum(hits - share)]), len(hits)
    places = set()
    for b in np.flatnonzero(hits):
        for e in np.flatnonzero(hits):
            if e + 1 - b >= width and sums[e + 1] + 1e-9 >= sums[b]:
                places.update(range(b, e + 1))
    return places


@pytest.mark.parametrize("least, n", [(0.7, 23), (0.85, 23), (0.97, 23), (0.85, 15)])
def test_covered_places_equal_plain_loops(least, n):
    rng = np.random.default_rng(2)
    hits = rng.random((300, n)) < least
    for own, found in zip(hits, ps.covered(hits, 12, 0.8)):
        assert set(np.flatnonzero(found).tolist()) == plain_covered(own, 12, 8 / 9)


def cell_of(windows, second=None):
    n = len(windows)
    return pa.table({
        "cell": pa.array([7] * n), "doc_id": pa.array(range(n)), "place": pa.array(range(n)),
        "second": pa.array(second or [False] * n), "whole": pa.array([second is None] * n),
        "own": pa.array([np.array(w, "<u4").tobytes() for w in windows], pa.binary()),
    })


def plain_similar(windows, second, width, least):
    """Pairs that cover more of the later window than the pairs before them, of windows that share enough with any."""
    seen, out, left = Counter(), set(), list(range(len(windows)))
    for _ in range(3):
        held = Counter(x for i in left for x in windows[i] if x)
        shared = {i: np.array([held[x] > 1 for x in windows[i]]) for i in left}
        left = [i for i in left if shared[i].sum() >= least]
    left = [i for i in left if plain_covered(shared[i], width, 8 / 9)]
    for i in left:
        one = windows[i]
        for j in [j for j in left if j > i]:
            hits = np.isin(windows[j], one) & (np.array(windows[j]) != 0)
            if (second is None or second[i] != second[j]) and hits.sum() >= least:
                places = plain_covered(hits, width, 8 / 9)
                if any(not seen[j, p] for p in places):
                    out.add((j, i))
                    seen.update({(j, p): 1 for p in places})
    return out


@pytest.mark.parametrize("n, halves", [(5, False), (5, True), (60, False), (60, True), (300, False)])
def test_similar_windows_equal_plain_loops(n, halves):
    rng = random.Random(n)
    base = [[rng.randrange(1, 1 << 32) for _ in range(23)] for _ in range(6)]
    windows = []
    for _ in range(n):
        kind, own = rng.randrange(4), list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            own[rng.randrange(23)] = rng.choice([rng.randrange(1, 1 << 32), rng.choice(own), 0])
        if kind == 0:  # shared places far apart
            own = [x if k % 2 else rng.randrange(1, 1 << 32) for k, x in enumerate(own)]
        if kind == 1:  # few shingles again and again
            own = (own[:5] * 5)[:23]
        windows.append(own)
    second = [rng.random() < 0.5 for _ in range(n)] if halves else None
    found = ps.compared(cell_of(windows, second), 12, 0.8).to_pylist()
    assert {(r["doc_id"], r["p_doc"]) for r in found} == plain_similar(windows, second, 12, 11)


def test_windows_that_share_places_far_apart_are_compared_many_at_once(monkeypatch):
    rng = random.Random(5)
    bases = [[rng.randrange(1, 1 << 32) for _ in range(23)] for _ in range(2)]
    windows = [[rng.choice(both) for both in zip(*bases)] for _ in range(200)]
    covered, calls = ps.covered, []
    monkeypatch.setattr(ps, "covered", lambda *given: calls.append(1) or covered(*given))
    found = ps.compared(cell_of(windows), 12, 0.8).to_pylist()
    assert {(r["doc_id"], r["p_doc"]) for r in found} == plain_similar(windows, None, 12, 11)
    assert len(calls) < 60


def test_places_shared_are_counted_pair_by_pair():
    rng = np.random.default_rng(3)
    xs, ys = ([rng.integers(0, 50, rng.integers(0, 40), dtype=np.uint32) for _ in range(200)] for _ in range(2))
    want = [int(np.isin(x, y).sum()) for x, y in zip(xs, ys)]
    assert ps.places_shared(xs, ys).tolist() == ps.places_shared(xs, ys, 50).tolist() == want
    assert ps.places_shared([], []).tolist() == []


def test_rows_that_share_an_id_are_not_harmed(make_docs):
    rng = random.Random(20)
    passage = prose(rng, 60)
    texts = [f"{passage} {prose(rng, 30)}", f"{passage} {prose(rng, 200)}", "a b c", prose(rng, 80), f"{passage} end", f"{passage} end", passage, None]
    ids = [1, 2, 2, 2, 3, 3, None, None]
    docs = make_docs(texts, ids)
    spans = ps.repeated_passages(docs)
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in spans.collect()} == {(3, 0, 60)}
    kept = sorted((str(r["doc_id"]), r["text"] or "") for r in ps.without_passages(docs, spans).collect())
    assert kept == sorted((str(i), "end" if i == 3 else t or "") for i, t in zip(ids, texts))
    with pytest.raises(Exception, match="after the last word"):
        far = docs.sparkSession.createDataFrame([(1, 0, 900)], "doc_id long, start_word long, end_word long")
        ps.without_passages(docs, far).collect()


def test_passages_are_cut(make_docs):
    rng = random.Random(7)
    passage = prose(rng, 60)
    texts = ["Start\n" + passage + "\nEnd", "Another  one. " + passage + " tail é", passage, None, "keep  this "]
    docs = make_docs(texts)
    cut = {r["doc_id"]: r for r in ps.without_passages(docs, ps.repeated_passages(docs)).collect()}
    assert cut[0]["text"] == texts[0] and cut[4]["text"] == texts[4] and cut[3]["text"] is None
    assert cut[1]["text"] == "Another  one. tail é" and cut[1]["n_chars"] == len(cut[1]["text"])
    assert 2 not in cut and len(cut) == 4 and cut[1]["cuts"] == "x"
    assert ps.repeated_passages(make_docs([])).count() == 0


def test_fingerprints_follow_the_order_of_ids(make_docs):
    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(0, 400)) for _ in range(60)] + ["", None, "é" * 2000, "ab"]
    ids = rng.sample(range(-50, 10_000), len(texts))
    rows = {r["doc_id"]: r for r in fp.fingerprints(make_docs(texts, ids)).collect()}
    order = sorted(zip(ids, [t or "" for t in texts]))
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        new = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = rows[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == fp.fingerprint(text.encode())
        assert r["edited_fingerprint"] == fp.fingerprint(new.encode())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert len(rows) == len(texts)
    assert [r["near_next"] for r in fp.fingerprints(make_docs(["only one"])).collect()] == [1.0]
    assert fp.fingerprints(make_docs([])).count() == 0
    repeated = fp.fingerprints(make_docs(["a b c"] * 3 + ["x"], [1, 1, 1, None])).collect()
    assert len(repeated) == 4


def test_common_lengths_are_those_of_the_textbook():
    def textbook(x, y):
        row = [0] * (len(y) + 1)
        for a in x:
            last = row
            row = [0]
            for k, b in enumerate(y):
                row.append(last[k] + 1 if a == b else max(row[-1], last[k + 1]))
        return row[-1]

    rng = random.Random(9)
    pairs = [("".join(rng.choices("abcd", k=rng.randrange(65))), "".join(rng.choices("abcd", k=rng.randrange(65)))) for _ in range(80)]
    assert fp.common_lengths(pairs).tolist() == [textbook(x, y) for x, y in pairs]


def test_likeness_tells_edits_from_strangers():
    rng = random.Random(10)
    text = prose(rng, 500).encode()
    near = [fp.fingerprint(text), fp.fingerprint(text[:1500] + b"changed " + text[1500:]), fp.fingerprint(prose(rng, 500).encode())]
    one, other = fp.likenesses([near[0], near[0]], near[1:])
    assert one > 0.8 and other < 0.2
    assert all(len(s) <= fp.PIECES for n in (0, 1, 50, 10_000, 200_000) for s in fp.fingerprint(b"abcdefg hij" * n).split(":")[1:])
