import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from corpusmill.llm import spelling

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(docs, damage):
    counted = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counted[run] += 1
    return counted


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(docs, damage=False, least=5, factor=5):
    counted = {w: n for w, n in plain_counts(docs, damage).items() if n >= least}
    near = defaultdict(list)
    for a in counted:
        for b in counted:
            if one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-counted[v], v))
        if counted[best] >= factor * counted[w]:
            form[w] = best
    out = []
    for w, n in counted.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counted.get(form.get(w))))
    return sorted(out)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def edited(rng, word, letters):
    place, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:place] + (rng.choice(letters) if kind else "") + word[place + (kind < 2) :]


@pytest.mark.parametrize("letters", ["ab", "abcdefghijé÷ß", "aé"])
def test_words_of_all_kinds(make_docs, letters):
    rng = random.Random(len(letters))
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 11))) for _ in range(30)]
    base += ["a" * k for k in range(5, 16)] + ["ab" * k for k in range(3, 7)]
    words = []
    for w in base:
        words += [w.upper() if rng.random() < 0.1 else w] * rng.choice([5, 6, 30, 160])
        for _ in range(4):
            v = edited(rng, w, letters)
            words += [v] * rng.choice([4, 5, 6, 7])
            words += [edited(rng, v, letters)] * 5 if len(v) > 1 else []
    rng.shuffle(words)
    docs = [" ".join(words[i : i + 40]) for i in range(0, len(words), 40)]
    # upper-case letters beyond ASCII keep their case in words, so fold as the operator does
    assert result(spelling.spelling_variants(make_docs(docs))) == plain(enumerate(docs))


def test_damage_nulls_repeats_and_long_words(make_docs):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 9))) for _ in range(40)]
    texts = [" ".join(rng.choice(base) for _ in range(200)) for _ in range(60)] + [None, "", "--- 12 ?"]
    texts += ["x" * 5000 + " " + "x" * 5001 + " " + "x" * 4999 + "y"] * 6
    ids = list(range(len(texts)))
    ids[0], ids[1], ids[2] = None, 7, 7
    found = result(spelling.spelling_variants(make_docs(texts, ids), damage=True))
    assert found == plain(zip(ids, texts), damage=True)
    assert sum(r[1] is not None for r in found) > 0


def test_forms_lead_to_roots(make_docs):
    chain = [("abcdefghi", 700), ("abcdefgh", 130), ("abcdefg", 25), ("abcdef", 5)]
    text = " ".join(w for w, n in chain for _ in range(n))
    found = {r["word"]: r for r in spelling.spelling_variants(make_docs([text])).collect()}
    assert {r["root"] for r in found.values()} == {"abcdefghi"}
    assert [found[w]["form"] for w, _ in chain] == [None, "abcdefghi", "abcdefgh", "abcdefg"]


def test_nothing_to_find(make_docs):
    assert spelling.spelling_variants(make_docs([])).count() == 0
    assert spelling.spelling_variants(make_docs([None, "", "short words here"])).count() == 0
    assert result(spelling.spelling_variants(make_docs(["lonely " * 5]))) == [("lonely", None, "lonely", 5, 0, None)]


def test_runs_of_long_texts_are_cut_between_words(monkeypatch):
    text = "Abc déf-ghi×jkl 12mno " * 30
    whole = spelling.run_counts(text)
    monkeypatch.setattr(spelling, "PIECE", 5)
    assert spelling.run_counts(text) == whole and whole["ghi×jkl"] == 30
