"""Budgets and samples against the plain loops they stand for."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import budget, prefix, sampling, shards
from corpusmill.plans.mixture import build_mixture
from tests.test_plans import plan_of


def frame(spark, rows, schema, parts=4):
    return spark.createDataFrame(rows, schema).repartition(parts)


def cyclic(tokens, target):
    """Row numbers as they are written, walking round and round."""
    out, total, i = [], 0, 0
    while total < target:
        out.append(i % len(tokens))
        total += tokens[i % len(tokens)]
        i += 1
    return out


def mix(spark, groups, targets, **options):
    rows = [(g, i, w, f"{g}{i}") for g, ws in groups.items() for i, w in enumerate(ws)]
    df = frame(spark, rows, "lang string, ord long, w long, text string")
    wanted = spark.createDataFrame(list(targets.items()), "lang string, target long")
    out = budget.mix_to_budget(df, wanted, F.col("w"), **options)
    return Counter((r.lang, r.ord) for r in out.collect())


def test_cyclic_budget_equals_loop(spark):
    rng = random.Random(1)
    groups, targets, expected = {}, {}, Counter()
    for g in range(120):
        ws = [rng.choice([0, 1, 2, 5, 9]) for _ in range(rng.randint(1, 7))] + [rng.randint(1, 4)]
        rng.shuffle(ws)
        target = rng.choice([1, sum(ws), sum(ws) * 2, rng.randint(1, 60)])
        groups[f"g{g}"], targets[f"g{g}"] = ws, target
        expected.update((f"g{g}", i) for i in cyclic(ws, target))
    assert mix(spark, groups, targets) == expected


@pytest.mark.parametrize("target, copies", [(12, [2, 1, 1]), (4, [1, 1, 0]), (0, [0, 0, 0])])
def test_cyclic_budget_by_hand(spark, target, copies):
    got = mix(spark, {"a": [3, 4, 2]}, {"a": target})
    assert [got[("a", i)] for i in range(3)] == copies


def test_cyclic_budget_without_tokens_gives_nothing(spark):
    assert not mix(spark, {"a": [0, 0]}, {"a": 5})


def test_head_changes_nothing(spark):
    rng = random.Random(2)
    groups = {g: [rng.randint(0, 5) + 1 for _ in range(40)] for g in "abcd"}
    targets = {"a": 10, "b": 100_0, "c": 35, "d": 60}
    whole = mix(spark, groups, targets)
    # a and c are done within their head, b and d are not; d's head is all of it
    head = F.when(F.col("lang") == "d", True).otherwise(F.col("ord") < 12)
    assert mix(spark, groups, targets, head=head, headed=["a", "b", "c"]) == whole


def corpus_of(spark, rows, parts):
    return frame(spark, rows, "lang string, split string, ord long, text string", parts)


def test_mixture_is_the_same_with_and_without_early_stop(spark, monkeypatch):
    from corpusmill.plans import mixture

    rng = random.Random(3)
    rows = [
        (lang, split, i, " ".join(["word"] * rng.randint(1, 9)))
        for lang in ("a", "b'q") for split in ("s1", "s2") for i in range(120)
    ]
    config = spark.createDataFrame(
        [(lang, s, p, t) for lang, t in (("a", 90), ("b'q", 5000)) for p, s in enumerate(("s2", "s1"))],
        "lang string, split string, split_pos int, target long",
    )

    def run(parts):
        out = build_mixture(corpus_of(spark, rows, parts), config)
        return Counter((r.lang, r.split, r.ord, r.epoch, r.n_tokens) for r in out.collect())

    plain = run(3)
    monkeypatch.setattr(mixture, "HEAD_ROWS", 20)
    monkeypatch.setattr(mixture, "RATIO_CHARS", 200)
    monkeypatch.setattr(mixture.token_char_ratio, "__defaults__", ("lang", None, 200, *mixture.token_char_ratio.__defaults__[3:]))
    early = run(5)
    monkeypatch.setattr(mixture, "MAX_EXTENTS", 0)
    assert early == run(1)
    for lang, target in (("a", 90), ("b'q", 5000)):
        total = sum(k[4] * n for k, n in plain.items() if k[0] == lang)
        assert target <= total < target + 10


def test_stored_blocks_replace_the_scan_of_positions(spark, tmp_path, monkeypatch):
    from corpusmill.plans import mixture
    from corpusmill.sinks.writers import write_corpus
    from corpusmill.sources import corpus as source

    rng = random.Random(4)
    rows = [
        (lang, split, i, " ".join(["word"] * rng.randint(1, 9)))
        for lang in ("a", "b'q") for split in ("s1", "s/2") for i in range(120)
    ]
    config = spark.createDataFrame(
        [(lang, s, p, t) for lang, t in (("a", 90), ("b'q", 5000)) for p, s in enumerate(("s/2", "s1", "none"))],
        "lang string, split string, split_pos int, target long",
    )
    root = str(tmp_path / "corpus")
    monkeypatch.setattr(source, "BLOCK_BITS", 4)
    monkeypatch.setattr(mixture, "HEAD_ROWS", 20)
    defaults = ("lang", None, 200, *mixture.token_char_ratio.__defaults__[3:])
    monkeypatch.setattr(mixture, "RATIO_CHARS", 200)
    monkeypatch.setattr(mixture.token_char_ratio, "__defaults__", defaults)

    def run(blocks):
        out = build_mixture(source.scan_corpus(spark, root, config), config, blocks=blocks)
        return Counter((r.lang, r.split, r.ord, r.epoch, r.n_tokens) for r in out.collect())

    write_corpus(corpus_of(spark, rows, 3), root)
    assert source.read_block_sizes(spark, root, config) is None  # none stored yet
    plain = run(None)
    source.store_block_sizes(spark, root)
    source.store_block_sizes(spark, root)  # nothing left to add
    blocks = source.read_block_sizes(spark, root, config)
    assert blocks.count() == 4 * 8 and blocks.agg(F.sum("n_rows")).first()[0] == len(rows)
    with monkeypatch.context() as patch:
        patch.setattr(mixture, "_extents", None)
        assert run(blocks) == plain

    # another split is written: its blocks are others now, and are not used until they are stored
    write_corpus(corpus_of(spark, [("a", "s/2", i, "one more word") for i in range(50)], 2), root)
    assert source.read_block_sizes(spark, root, config) is None
    source.store_block_sizes(spark, root)
    blocks = source.read_block_sizes(spark, root, config)
    assert blocks.where("lang = 'a' AND split = 's/2'").agg(F.sum("n_rows")).first()[0] == 50
    assert run(blocks) == run(None) != plain


def test_a_split_may_be_named_twice(spark, monkeypatch):
    from corpusmill.plans import mixture

    monkeypatch.setattr(mixture, "HEAD_ROWS", 1)
    rows = [("l", s, i, "w w") for s in "ab" for i in range(4)]
    config = spark.createDataFrame(
        [("l", "a", 0, 21), ("l", "b", 1, 21), ("l", "a", 2, 21)], "lang string, split string, split_pos int, target long")
    got = build_mixture(corpus_of(spark, rows, 2), config).orderBy("epoch", "split_pos", "ord").collect()
    assert [(r.split, r.split_pos) for r in got] == [("a", 0)] * 4 + [("b", 1)] * 4 + [("a", 2)] * 3


def test_shuffled_mixture_meets_its_budget(spark):
    rows = [("a", "s", i, "one two three") for i in range(300)]
    config = spark.createDataFrame([("a", "s", 0, 100)], "lang string, split string, split_pos int, target long")
    got = build_mixture(corpus_of(spark, rows, 4), config, shuffle_seed=5).collect()
    assert sum(r.n_tokens for r in got) >= 100 and max(r.ord for r in got) > 60


def loop_prefix(rows, max_tokens, max_samples):
    out, total = [], 0
    for i, (name, text, w) in enumerate(rows):
        if not text:
            continue
        total += w
        out.append(name)
        if max_samples and i + 1 >= max_samples:
            break
        if max_tokens and total >= max_tokens:
            break
    return out


@pytest.mark.parametrize("seed", range(6))
def test_prefix_equals_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["", "x", "x"]), rng.randint(0, 4)) for i in range(40)]
    df = frame(spark, rows, "ord long, text string, w long")
    order = prefix.source_order("ord")
    for max_tokens, max_samples in [(7, None), (None, 5), (20, 9), (9, 30), (None, 1), (0, 0), (10**6, 10**6)]:
        got = budget.take_token_budget(df, F.col("w"), max_tokens, max_samples, order)
        assert sorted(r.ord for r in got.collect()) == loop_prefix(rows, max_tokens, max_samples)


def test_blocks_of_positions(spark):
    """Positions far apart, so that a group has many blocks."""
    rng = random.Random(4)
    positions = sorted(rng.sample(range(1 << 40), 300))
    rows = [(g, p, rng.randint(1, 9)) for g in "ab" for p in positions]
    df = frame(spark, rows, "lang string, ord long, w long")
    cut = prefix.prefix_cut(df, ["lang"], prefix.source_order("ord"), F.col("w"), F.lit(400))
    got = Counter(r.lang for r in cut.attach(df).where(cut.within).collect())
    for g in "ab":
        total, n = 0, 0
        for _, _, w in [r for r in rows if r[0] == g]:
            if total >= 400:
                break
            total, n = total + w, n + 1
        assert got[g] == n
    sums = prefix.running_sum(df, ["lang"], prefix.source_order("ord"), F.col("w"), "s")
    last = sums.orderBy(F.desc("ord")).where("lang = 'a'").first()
    assert last.s == sum(w for g, _, w in rows if g == "a") - last.w


def test_many_groups_take_the_way_without_broadcast(spark, monkeypatch):
    from corpusmill.operators import lookup

    monkeypatch.setattr(lookup, "MAX_SMALL_ROWS", 3)
    test_cyclic_budget_equals_loop(spark)
    rows = [(f"p{i % 6}", i) for i in range(600)]
    df = frame(spark, rows, "pair string, row_id long")
    got = Counter(r.pair for r in sampling.bounded_sample(df, max_n=40).collect())
    assert got == {f"p{i}": 40 for i in range(6)}


@pytest.mark.parametrize("n, expected, copies", [(30, 90, 3), (50, 50, 1), (3000, 2000, 1), (100, 100, 1), (49, 98, 2)])
def test_bounded_sample_sizes(spark, n, expected, copies):
    df = frame(spark, [("p", i) for i in range(n)], "pair string, row_id long")
    got = sampling.bounded_sample(df, max_n=2000, min_n=100).collect()
    assert len(got) == expected
    assert set(Counter(r.row_id for r in got).values()) == {copies}


def test_samples_of_nothing_are_empty(spark):
    df = frame(spark, [("p", i) for i in range(9)], "pair string, ord long")
    assert sampling.take(df, 0).count() == sampling.take(df, 0, ["pair"]).count() == 0
    assert sampling.bounded_sample(df, max_n=0, key=["ord"]).count() == 0
    assert sampling.take(df.where("ord < 0"), 3).count() == 0


def test_unknown_sampling_is_an_error_at_any_size(spark):
    df = frame(spark, [("p", 1)], "pair string, row_id long")
    with pytest.raises(ValueError):
        sampling.bounded_sample(df, strategy="best")


def test_results_do_not_depend_on_partitions(spark):
    def run(parts, shuffle):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
        try:
            df = frame(spark, [("p", i, f"t{i}") for i in range(500)], "lang string, ord long, text string", parts)
            taken = sampling.take(df, 70, ["lang"], prefix.hash_order(1, "ord")).collect()
            kept = budget.take_token_budget(df, F.lit(3), max_tokens=200).collect()
            parted = sampling.assign_parts(df, 33).collect()
            return [sorted(map(tuple, rows)) for rows in (taken, kept, parted)]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert run(1, 1) == run(7, 4) == run(3, 64)


def test_epochs_have_their_own_order(spark):
    df = frame(spark, [("a", "s", i, "" if i == 3 else "x") for i in range(20)], "lang string, split string, ord long, text string")
    rows = sampling.repeat_epochs(df, 3).collect()
    assert len(rows) == 3 * 19
    orders = [tuple(r.ord for r in sorted((r for r in rows if r.epoch == e), key=lambda r: r.order_key)) for e in range(3)]
    assert len(set(orders)) == 3
    assert sampling.repeat_epochs(df, 2, seed=None).where("order_key is not null").count() == 0


def test_shuffle_is_a_permutation(spark):
    df = frame(spark, [(i,) for i in range(50)], "ord long")
    rows = [r.ord for r in sampling.shuffle_order(df, 1).collect()]
    placed = {r.position: r.ord for r in sampling.shuffle_position(df, 1).collect()}
    assert sorted(rows) == list(range(50)) and rows != sorted(rows)
    assert [placed[i] for i in range(50)] == rows


def test_shards(spark):
    sizes = [4, 4, 4, 9, 1]
    df = frame(spark, [("s", i, n, "x" * n) for i, n in enumerate(sizes)], "source string, row_id long, n long, text string")
    rows, manifest = shards.assign_shards(df, 8, shards.row_bytes(["text"]), block_rows=1)
    assert [r.shard for r in rows.orderBy("row_id").collect()] == [1, 1, 2, 3, 4]
    found = manifest.orderBy("index").collect()
    assert [(r.path, r.num_rows, r.estimated_bytes) for r in found] == [
        ("s1.parquet", 2, 8), ("s2.parquet", 1, 4), ("s3.parquet", 1, 9), ("s4.parquet", 1, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_shards_equal_loop(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.randint(0, 9) for _ in range(60)]
    df = frame(spark, [("s", i, n) for i, n in enumerate(sizes)], "source string, row_id long, n long")
    rows, _ = shards.assign_shards(df, 20, F.col("n"), block_rows=1)
    shard, filled, expected = 1, 0, []
    for i, n in enumerate(sizes):
        if i and rows_in and filled + n > 20:
            shard, filled, rows_in = shard + 1, 0, 0
        filled += n
        rows_in = 1
        expected.append(shard)
    assert [r.shard for r in rows.orderBy("row_id").collect()] == expected


def test_ratio_cuts_the_row_at_the_border(spark):
    df = frame(spark, [("a", 0, "aa bb"), ("a", 1, "cc dd ee"), ("b", 0, "")], "lang string, ord long, text string")
    got = {r.lang: r for r in budget.token_char_ratio(df, sample_chars=7).collect()}
    assert (got["a"].chars, got["a"].tokens) == (7, 3)
    assert math.isclose(got["a"].ratio, 3 / 7) and got["b"].ratio == 0


def test_budget_in_source_order_tries_the_head_first(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(10_000 + i, rng.choice(["", "x"]), rng.randint(0, 4)) for i in range(400)]
    df = frame(spark, rows, "ord long, text string, w long")
    monkeypatch.setattr(budget, "BLOCK_BITS", 3)
    for limit in (1, 30, 200, 10**5):
        got = budget.take_token_budget(df, F.col("w"), limit, order=prefix.source_order("ord"))
        assert sorted(r.ord for r in got.collect()) == loop_prefix(rows, limit, None)


@pytest.mark.parametrize("walked", [4096, 2])
def test_pointers_lead_to_the_shards_of_a_plain_loop(spark, monkeypatch, walked):
    monkeypatch.setattr(shards, "WALKED_UNITS", walked)
    rng = random.Random(6)
    sizes = {"a": [rng.choice([0, 0, 1, 5, 9, 30]) for _ in range(300)], "b": [50], "c": [0, 0], "d": [3] * 64}
    rows = [(s, i, 1, n) for s, own in sizes.items() for i, n in enumerate(own)]
    table = frame(spark, rows, "source string, unit long, n_rows long, n_bytes long")
    want = {}
    for source, own in sizes.items():
        number, filled = 0, 0
        for i, n in enumerate(own):
            if number == 0 or filled + n > 20 and not (filled == 0 and i == opened):
                number, filled, opened = number + 1, 0, i
            filled += n
            want[source, i] = number
    packed = shards.pack_units(table, 20)
    assert packed.columns == ["source", "unit", "n_rows", "n_bytes", "shard"]
    assert {(r.source, r.unit): r.shard for r in packed.collect()} == want
    assert "Python" not in plan_of(packed) and "Pandas" not in plan_of(packed)


@pytest.mark.parametrize("walked", [4096, 3])
def test_segments_lead_to_the_shards_of_a_plain_loop(spark, monkeypatch, walked):
    monkeypatch.setattr(shards, "WALKED_UNITS", walked)
    monkeypatch.setattr(shards, "SEGMENT", 2)
    monkeypatch.setattr(shards, "CHUNK_UNITS", 7)
    monkeypatch.setattr(shards, "_jumped", None)
    rng = random.Random(7)
    sizes = {
        "a": [rng.choice([0, 0, 1, 5, 9, 30]) for _ in range(900)], "b": [70] * 40, "c": [0] * 9, "d": [3] * 64,
        "e": [0, 0, 45, 0, 0, 0, 21, 20, 0, 1, 0], "f": [4] * 5 + [10**6] + [2] * 31,
    }
    rows = [(s, 5 * i - 60, 1, n) for s, own in sizes.items() for i, n in enumerate(own)]
    table = frame(spark, rows + [(None, 4, 1, 30), (None, 5, 1, 30)], "source string, unit long, n_rows long, n_bytes long")
    want = {(None, 4): 0, (None, 5): 0}
    for source, own in sizes.items():
        number, filled = 0, 0
        for i, n in enumerate(own):
            fits = number and filled + n <= 20
            number, filled = (number, filled + n) if fits else (number + 1, n)
            want[source, 5 * i - 60] = number
    fetched = []
    monkeypatch.setattr(type(table), "toArrow", lambda df: fetched.append(df))
    packed = shards.pack_units(table, 20)
    assert packed.columns == ["source", "unit", "n_rows", "n_bytes", "shard"]
    found = [((r.source, r.unit), r.shard) for r in packed.collect()]
    assert dict(found) == want and len(found) == len(want) and not fetched
    assert "Python" not in plan_of(packed) and "Pandas" not in plan_of(packed)


def test_units_after_the_last_segment_with_an_opener_are_in_the_last_shard(spark, monkeypatch):
    monkeypatch.setattr(shards, "WALKED_UNITS", 3)
    monkeypatch.setattr(shards, "SEGMENT", 2)
    monkeypatch.setattr(shards, "CHUNK_UNITS", 7)
    # segments of 42 bytes; in each of these lengths the last shard may begin in one and end in the next
    sizes = {f"s{n}": [3] * n for n in range(1, 80)} | {f"z{n}": [7] * n + [0, 0] for n in range(1, 40)}
    rows = [(s, i, i + 1, n) for s, own in sizes.items() for i, n in enumerate(own)]
    table = frame(spark, rows, "source string, row_id long, rows long, size long")
    counts = table.select("source", F.col("row_id").alias("unit"), F.lit(1).cast("long").alias("n_rows"), F.col("size").alias("n_bytes"))
    want = {(s, i): 1 + i // (20 // max(own)) for s, own in sizes.items() for i, n in enumerate(own) if n}
    want |= {(s, i): want[s, max(j for j, m in enumerate(own) if m)] for s, own in sizes.items() for i, n in enumerate(own) if not n}
    found = [((r.source, r.unit), r.shard) for r in shards.pack_units(counts, 20).collect()]
    assert dict(found) == want and len(found) == len(want)
    sharded, manifest = shards.assign_shards(table, 20, F.col("size"), block_rows=1)
    assert sharded.count() == len(rows) == manifest.agg(F.sum("num_rows")).first()[0]


def test_part_numbers_move_no_rows(spark):
    rng = random.Random(8)
    rows = [(rng.choice("aab"), i, "text") for i in rng.sample(range(400_000), 3000)]
    df = frame(spark, rows, "lang string, ord long, text string")
    for order, key in ((prefix.source_order("ord"), lambda r: r[1]), (prefix.hash_order(3, "ord"), lambda r: hashlib.md5(f"3:{r[1]}".encode()).hexdigest())):
        for by in ([], ["lang"]):
            for size in (1, 7, 400, 5000):
                parted = sampling.assign_parts(df, size, order, by)
                got = {r.ord: r.part_id for r in parted.collect()}
                want, seen = {}, {}
                for r in sorted(rows, key=key):
                    n = seen[r[0] if by else ""] = seen.get(r[0] if by else "", 0) + 1
                    want[r[1]] = (n - 1) // size + 1
                assert got == want, (by, size)
    assert parted.columns == ["lang", "ord", "text", "part_id"] and "Exchange hashpartitioning" not in plan_of(parted)


def test_bitmaps_hold_the_rows_that_are_kept(spark):
    from corpusmill.operators import joins

    rng = random.Random(9)
    rows = [(p, i, f"{p}{i}") for p in ("en-sw", "en-so", "fr-ha") for i in (*range(300), *rng.sample(range(300, 10**6), 200))]
    kept = [(p, i, c) for p, i, _ in rows if p != "fr-ha" and rng.random() < 0.07 for c in (0, 1)] + [("xx-yy", 1, 0)]
    df, some = frame(spark, rows, "pair string, row_id long, text string"), frame(spark, kept, "pair string, row_id long, copy int")
    found = joins.only_rows(df, some, "pair", "row_id")
    assert {(r.pair, r.row_id) for r in found.collect()} == {(p, i) for p, i, _ in kept} - {("xx-yy", 1)}
    assert found.columns == df.columns and "Exchange hashpartitioning" not in plan_of(found)
    assert joins.only_rows(df, some, "pair", "row_id", max_bitmaps=3).count() == len(rows)
