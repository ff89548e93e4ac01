"""N-gram join, exact dedup and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from branchledger.llm.common import collided, components, told_apart
from branchledger.llm.exact_dedup import deduplicated, equal_classes
from branchledger.llm.ngram_join import Join, boundary, jaccard_classes, one_of_each
from branchledger.llm.substring_dedup import Repeats, common, deep_shallow, group_keys, without_repeats
from pyspark.sql import functions as F


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()


def linked_classes(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    degree = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                degree[i] += 1
                degree[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            low[find(i)] = min(low.get(find(i), id_), id_)
    return Counter((id_, len(sets[i]), low.get(find(i)), degree[i]) for i, (id_, _) in enumerate(rows))


@pytest.mark.parametrize("p", [Join(4, 85, 100), Join(5, 80, 100), Join(2, 60, 100, short_list=3, block=300)])
def test_join_of_odd_texts(odd, odd_rows, p):
    got = Counter(map(tuple, jaccard_classes(odd, p).collect()))
    assert got == linked_classes(odd_rows, p.words, p.num, p.den)


@pytest.mark.parametrize("p", [Join(1, 80, 100), Join(2, 70, 100, short_list=4, block=200, most_light=9)])
def test_join_of_small_sets(spark, p):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 14))] if i % 3 or not rows else rows[rng.randrange(len(rows))][1].split()
        if i % 3 == 0 and len(words) > 2:
            words[rng.randrange(len(words))] = f"n{i}"
        rows.append((i, " ".join(words)))
    got = Counter(map(tuple, jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), p).collect()))
    assert got == linked_classes(rows, p.words, p.num, p.den)


def test_join_counts_links_once_in_groups_of_few_large_sets(spark):
    # Two sets a group and two blocks: in some groups both fall to one block and the other is empty.
    p, rows = Join(1, 80, 100, block=100), []
    for i in range(24):
        words = [f"w{i}x{j}" for j in range(90)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-1], f"n{i}"]))]
    got = Counter(map(tuple, jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), p).collect()))
    assert got == linked_classes(rows, p.words, p.num, p.den)


def test_join_of_very_many_equal_texts_and_a_star(spark):
    """20,000 copies of a text and a hub that links to sets that do not link to each other."""
    hub = [f"h{i}" for i in range(103)]
    rows = spark.range(20_000).selectExpr("id + 1000 doc_id", f"'{' '.join(f'c{i}' for i in range(50))}' text")
    star = [(0, " ".join(hub))] + [(i, " ".join([*hub, *(f"{i}x{k}" for k in range(9))])) for i in range(1, 60)]
    got = jaccard_classes(rows.union(spark.createDataFrame(star, "doc_id long, text string")), Join(4, 90, 100))
    counts = Counter((r.component_id, r.n_links) for r in got.collect())
    assert counts == {(1000, 19_999): 20_000, (0, 59): 1, (0, 1): 59}


def test_hashes_that_collide_are_told_apart(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (2, 21), (3, 30)], "k long, c long")
    assert collided(df, "k", "c") == [2]
    assert sorted(r[0] for r in df.select(told_apart("k", "c", [2])).collect()) == [1, 1, 3, 20, 21]
    assert sorted(r[0] for r in df.select(told_apart("k", "c", [])).collect()) == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError, match="collide"):
        collided(df, "k", "c", most=0)


def test_boundary_follows_cost():
    p = Join(4, 85, 100)
    sizes = dict.fromkeys(range(1, 17), 100)
    assert boundary(sizes, 0.0, p) < boundary(sizes, 50.0, p) <= p.most_light


def test_one_of_each_keeps_one_row_of_each_component(odd, odd_rows):
    p = Join(5, 80, 100)
    classes = linked_classes(odd_rows, p.words, p.num, p.den)
    got = Counter(r.doc_id for r in one_of_each(odd, p).collect())
    # Alone, or the smallest id; rows equal in id and text stay together.
    want = Counter()
    for (id_, _, low, degree), n in classes.items():
        if degree == 0 or id_ == low:
            want[id_] += n
    assert got == want
    assert one_of_each(odd, p).columns == odd.columns


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def tables(spark, name):
    """Folders of that name in the shared folder, with the number of part files in each."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    return {p.name: len(list(p.glob("part-*"))) for p in folder.glob(f"{name}-*")}


def test_components_of_few_edges_take_no_rounds(spark):
    edges = [(i, i + 1) for i in range(400)] + [(1000 + i, 1000) for i in range(1, 60)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    want = {**dict.fromkeys(range(401), 0), **dict.fromkeys(range(1000, 1060), 1000)}
    assert {r.node: r.root for r in components(df, "few-edges").collect()} == want
    assert len(tables(spark, "few-edges")) == 2
    # More edges than a task holds go through the rounds.
    assert {r.node: r.root for r in components(df, "more-edges", most=16).collect()} == want
    assert len(tables(spark, "more-edges")) > 3
    assert components(df.where("a = b"), "no-edges").collect() == []


def test_rounds_of_few_rows_are_written_by_few_tasks(spark):
    before = tables(spark, "radix-groups-1")
    rows = [(i, "x" * 100 + str(i // 2) * 100) for i in range(60)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = equal_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, i // 2 * 2, 2) for i in range(60)}
    assert [n for name, n in tables(spark, "radix-groups-1").items() if name not in before] == [1]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("digit", [1, 64])
def test_equal_classes(odd, odd_rows, digit):
    got = equal_classes(odd, first_digit=digit).collect()
    groups = {}
    for id_, text in odd_rows:
        groups.setdefault(normal(text), []).append(id_)
    want = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_deduplicated_rows(odd, odd_rows):
    got = deduplicated(odd)
    assert got.columns == odd.columns
    assert Counter(normal(r.text) for r in got.collect()) == Counter({normal(t) for _, t in odd_rows})


def cut(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = Counter()
    for (id_, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        out[id_, len(d), bytes(gone).count(1), len(re.findall(b"\x01+", bytes(gone))), bytes(c for c, g in zip(d, gone) if not g)] += 1
    return out


@pytest.mark.parametrize("p", [Repeats(), Repeats(length=40, gram=16, few=2, chunk=1000), Repeats(hot=0), Repeats(length=40, gram=16, hot=0, parts=7)])
def test_repeated_passages(odd, odd_rows, p):
    rows = [(i, t) for i, t in odd_rows if t is None or len(t) < 100_000]
    few = odd.where("text is null or length(text) < 100000")
    got = without_repeats(few, p).select("own.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("gone"), F.size("spans").alias("s"), "kept").collect()
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == cut(rows, p.length)


@pytest.mark.parametrize("p", [Repeats(60, 20, hot=5), Repeats(60, 20, hot=5, parts=1), Repeats(60, 20, hot=5, parts=40)])
def test_a_line_in_ever_different_surroundings(spark, p):
    """The same line with neighbours that agree for a few bytes, many or all, on either side."""
    rng = random.Random(8)
    line = "the common line of all documents, always the same"
    sides = ["".join(rng.choice("abc ") for _ in range(90)) for _ in range(4)]
    rows = []
    for i in range(150):
        left, right = rng.choice(sides), rng.choice(sides)
        i_own, j_own = rng.randrange(91), rng.randrange(91)
        own = "".join(rng.choice("xyz ") for _ in range(100))
        rows.append((i, own[:50] + left[i_own:] + line + right[:j_own] + own[50:]))
    got = without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), p)
    got = got.select("own.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("gone"), F.size("spans").alias("s"), "kept").collect()
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == cut(rows, p.length)


def test_pairs_that_share_a_window_meet_in_a_group():
    p, rng = Repeats(30, 10, parts=3), random.Random(9)
    gram = b"0123456789"
    for _ in range(3000):
        def context():
            left, right = ("".join(rng.choice("ab") for _ in range(rng.randrange(21))).encode() for _ in range(2))
            return left, right
        (l1, r1), (l2, r2) = context(), context()
        if min(len(l1) + len(r1), len(l2) + len(r2)) < 20:
            continue
        i, j = common(l1[::-1], l2[::-1]), common(r1, r2)
        one, two = (set(group_keys(5, len(x), x + gram + y, p)) for x, y in ((l1, r1), (l2, r2)))
        assert one and two and (i + j < 20 or one & two)


def test_rows_that_repeat_very_often(spark):
    import time

    text = " ".join(f"w{i * 7919 % 997}" for i in range(400))
    rows = spark.range(5000).selectExpr("7L doc_id", f"'{text}' text").union(spark.createDataFrame([(8, "head " + text), (9, "own " * 10)], "doc_id long, text string"))
    start = time.time()
    got = Counter((r.doc_id, len(r.kept)) for r in without_repeats(rows).select("own.doc_id", "kept").collect())
    assert got == {(7, 0): 5000, (8, 5): 1, (9, 40): 1}
    assert time.time() - start < 90


def test_cut_text_drops_broken_characters(spark):
    docs = spark.createDataFrame([(1, "é" + "b" * 50), (2, "ÿ" * 3 + "b" * 50)], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in without_repeats(docs, Repeats(length=20, gram=8), as_text=True).select("own.doc_id", "kept").collect()}
    assert got == {1: "é", 2: "ÿÿÿ"}


def test_deep_shallow_orders_and_measures():
    rng = random.Random(5)
    texts = [b"ab" + bytes(rng.choice(b"ab") for _ in range(rng.randrange(30))) for _ in range(300)]
    order, shared = deep_shallow(texts, 2, 4)
    assert [texts[i] for i in order] == sorted(texts) and sorted(order) == list(range(300))
    assert all(shared[k] == common(texts[order[k - 1]], texts[order[k]]) for k in range(1, 300))


def test_empty_tables(empty):
    assert jaccard_classes(empty, Join()).collect() == []
    assert equal_classes(empty).collect() == [] and deduplicated(empty).collect() == []
    assert without_repeats(empty).collect() == [] and one_of_each(empty, Join()).collect() == []
