"""Exact duplicates and the n-gram join, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lotledger.llm import exactdedup, hashing, ngramjoin
from lotledger.llm.common import components, forest


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def grams_of(text, n):
    w = words_of(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def joined_by_force(rows, n, t):
    sets = [(i, grams_of(x, n)) for i, x in rows]
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x & y and 100 * len(x & y) >= t * len(x | y):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return sorted(((i, len(s), top(i) if i is not None else None) for i, s in sets), key=repr)


def corpus(seed, families, members, words, edits):
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, words))]
        for _ in range(rng.randint(1, members)):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(400)}"
            texts.append(" ".join(own))
    return texts


EDGES = [None, "", " \t\n", "one", "One", "two words", "two  WORDS", "İ ſ K", "a b c", "a b c a b c a b c", "É é"]


@pytest.mark.parametrize("n, t, block", [(3, 90, 512), (5, 80, 4), (2, 50, 6)])
def test_join(spark, n, t, block):
    texts = EDGES + corpus(n, 25, 7, 60, 5) + corpus(n + 1, 1, 40, 60, 3)
    rows = [(i * 3 - 20, x) for i, x in enumerate(texts)] + [(None, texts[-1]), (1, texts[-2]), (1, texts[-9])]
    frame = spark.createDataFrame([(i, x, 1, "s") for i, x in rows], "doc_id long, text string, a int, comp string").repartition(5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngramjoin.joined(frame, n, t, block).collect()), key=repr)
    assert got == joined_by_force(rows, n, t)


def test_join_of_large_group_of_near_copies(spark):
    """A third of the rows are near copies; all three passes run."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(60):
        own = list(base)
        own[rng.randrange(200)] = f"x{rng.randrange(9)}"
        texts.append(" ".join(own))
    texts += [" ".join(f"z{rng.randrange(9999)}" for _ in range(50)) for _ in range(100)] + [" ".join(base)] * 20
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngramjoin.joined(frame, 5, 90, 8).collect()), key=repr)
    assert got == joined_by_force(rows, 5, 90)


def test_join_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngramjoin.joined(empty).count() == 0 and ngramjoin.deduplicated(empty).count() == 0


def test_linked_sets_share_a_prefix():
    """For every allowed size and difference the bound holds, also at its edge and in any order."""
    rng = np.random.default_rng(3)
    level = rng.integers(0, 9, 1 << 10).astype(np.uint8)
    for t in (80, 90):
        for size in [*range(1, 60), 100, 333, 1000]:
            x = rng.integers(0, 2**63, size, dtype=np.uint64)
            for extra in {0, 1, size * (100 - t) // t}:
                both = size * t // 100 if extra == 0 else size
                y = np.concatenate((x[:both], rng.integers(0, 2**63, max(extra, size - both), dtype=np.uint64)))
                union = size + len(y) - both
                if both and 100 * both >= t * union:
                    assert set(ngramjoin.prefix(np.sort(x), level, t)) & set(ngramjoin.prefix(np.sort(y), level, t))


def test_overlaps():
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 300, rng.integers(0, 200))).astype(np.uint64) for _ in range(70)]
    counts = ngramjoin.overlaps(rows)
    for i in range(70):
        for j in range(i):
            assert counts[i, j] == counts[j, i] == len(np.intersect1d(rows[i], rows[j]))


def test_shingles_of_long_texts():
    rng = random.Random(2)
    text = "".join(rng.choice(["ab ", "Cd\n", "é\t", "  ", "xyz"]) for _ in range(80_000))
    assert len(hashing.shingles(text, 3)) == len(grams_of(text, 3))
    assert len(hashing.shingles("q" * 300_000 + " r", 5)) == 1


def test_components(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "p long, q long"), "p", "q").collect()}
    up = {i: i for p in pairs if None not in p for i in p}
    for _ in range(500):
        for a, b in pairs:
            if a is not None and b is not None:
                up[a] = up[b] = min(up[a], up[b])
    alone = {a for a, b in pairs if a == b}
    assert {k: v for k, v in got.items()} == {k: v for k, v in up.items() if k in got}
    assert set(up) - set(got) <= alone


def test_exact(spark):
    long = "x" * 100_000
    texts = ["a", "a", "A", None, "", long, long + "b", long + "b", "é", "é", "same start " + "p" * 80 + "1", "same start " + "p" * 80 + "2"]
    rows = list(enumerate(texts)) + [(None, "a"), (None, "only null"), (None, "only null"), (5, long), (3, None), (7, "b")]
    frame = spark.createDataFrame([(i, x, 0, "k") for i, x in rows], "doc_id long, text string, kept int, head string")
    groups = Counter(x or "" for _, x in rows)
    best = {}
    for i, x in rows:
        best[x or ""] = max((j for j, y in rows if (y or "") == (x or "") and j is not None), default=None)
    for hash_all in (True, False):
        got = exactdedup.classes(frame, hash_all).collect()
        assert len(got) == len(rows)
        seen = Counter()
        for r in got:
            if r.text_sha256 is not None:
                seen[r.text_sha256] += r.kept
        assert all(v == 1 for v in seen.values())
        if hash_all:
            sha = {hashlib.sha256(x.encode()).hexdigest(): x for x in groups}
            assert {sha[r.text_sha256] for r in got} == set(groups)
            assert sorted(repr((r.doc_id, r.keep_id, r.group_size)) for r in got) == sorted(
                repr((i, best[x or ""], groups[x or ""])) for i, x in rows)
    kept = exactdedup.deduplicated(frame).collect()
    assert sorted(r.text or "" for r in kept) == sorted(groups)
    assert all(r.doc_id == best[r.text or ""] for r in kept) and kept[0].head == "k"
    assert exactdedup.classes(frame.limit(0)).count() == 0 and exactdedup.deduplicated(frame.limit(0)).count() == 0


def test_exact_with_full_buckets(spark):
    """Buckets that also hold lone texts change nothing."""
    rows = [(i, f"text {i % 70}") for i in range(100)]
    got = exactdedup.classes(spark.createDataFrame(rows, "doc_id long, text string"), bits=1).collect()
    assert sorted(r.doc_id for r in got if r.kept) == list(range(30, 100))


@pytest.mark.parametrize("block", [8, 24])
def test_large_groups_of_several_classes(spark, block):
    """Chains of near copies and templates that share rare passages: groups beyond a block that stay open."""
    rng = random.Random(block)
    shared = [" ".join(f"s{k}x{j}" for j in range(60)) for k in range(4)]
    texts = [f"{shared[k % 4]} {shared[(k + k // 4) % 4]} " + " ".join(f"u{k}v{j}" for j in range(rng.choice([2, 5, 12, 30]))) for k in range(70)]
    for chain in range(3):
        own = [f"c{chain}w{j}" for j in range(60)]
        for step in range(30):  # each links with its neighbours, the ends do not
            own[(7 * step) % 60] = f"c{chain}n{step}"
            texts.append(" ".join(own))
    texts += texts[100:110]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[50]), (4, None)]
    frame = spark.createDataFrame([(i, x, 1, 2, "y") for i, x in rows], "doc_id long, text string, label int, units int, comp string")
    got = ngramjoin.joined(frame.repartition(6), 3, 80, block=block, buckets=3)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == joined_by_force(rows, 3, 80)


def test_contested_documents_are_those_of_open_pairs(spark):
    """Exactly what shares a prefix n-gram with another label at a possible size, by what connects it."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(25)}" for _ in range(rng.randint(1, 14))) for _ in range(120)]
    rows = [(i, rng.randrange(6), x) for i, x in enumerate(texts)]
    levels, total = ngramjoin.counted(spark.createDataFrame([(x,) for x in texts], "text string"), 2, bits=12)
    assert total == sum(len(grams_of(x, 2)) for x in texts)
    level = spark.sparkContext.broadcast(levels)
    got = {r.node for r in ngramjoin._contested(spark.createDataFrame(rows, "doc_id long, label long, text string"), 2, 50, level, 4).collect()}
    heads = [(i, label, len(g), set(ngramjoin.prefix(g, levels, 50).tolist())) for i, label, x in rows for g in [hashing.shingles(x, 2)]]
    assert got == {i for i, p, m, x in heads for j, q, n, y in heads if p != q and x & y and 100 * min(m, n) >= 50 * max(m, n)}


def test_done_documents_cannot_link(spark):
    """No document with a link to another label is taken out; ids that repeat stay."""
    rng = random.Random(21)
    texts = corpus(31, 20, 8, 60, 4)
    rows = [(i, i if rng.random() < 0.7 else i // 3, x) for i, x in enumerate(texts)] + [(5, 5, "lone words of a repeated id " * 4)]
    left = [r.doc_id for r in ngramjoin._possible(spark.createDataFrame(rows, "doc_id long, label long, text string"), 2, 80, 3).collect()]
    sets = [(i, label, grams_of(x, 2)) for i, label, x in rows]
    linked = {i for i, p, x in sets for j, q, y in sets if p != q and x & y and 100 * len(x & y) >= 80 * len(x | y)}
    assert linked <= set(left) and left.count(5) == 2 and len(left) < len(rows)


def test_forest_is_stars():
    chain = [(i + 1, i) for i in range(50)]
    assert sorted(forest(*zip(*chain))) == [(i, 0) for i in range(1, 51)]
    assert sorted(forest([5, 9, 3, 7, 4], [3, 8, 4, 7, 5])) == [(4, 3), (5, 3), (9, 8)]
    assert forest([], []) == []


def test_scratch_files_are_packed_tightly(spark, tmp_path):
    """Scratch tables stay on disk beside the shuffles, whatever codec the session writes results in."""
    import pyarrow.parquet as pq

    from lotledger.llm.common import written

    path = str(tmp_path / "kept")
    assert sorted(r.id for r in written(spark.range(50), path).collect()) == list(range(50))
    parts = [pq.ParquetFile(f).metadata for f in (tmp_path / "kept").glob("*.parquet")]
    assert {m.row_group(0).column(0).compression for m in parts if m.num_row_groups} == {"ZSTD"}
