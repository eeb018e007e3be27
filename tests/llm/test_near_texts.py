"""The pipeline's near-dedup against brute force over whole texts."""

import random

import numpy as np

import corpus_pipeline
from lendloom.llm import near_texts
from tests.llm.fixtures import SF
from tests.llm.test_text_operators import WORD, components

STAGE = corpus_pipeline.STAGES[2][1]


def plain_set(text):
    words = WORD.findall((text or "").lower())
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or {" ".join(words)}


def alike(a, b):
    both = len(a & b)
    return 10 * both >= 8 * (len(a) + len(b) - both)


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def families():
    """Texts with 0 to 12 changed words of 200 (Jaccard 1 to about 0.55), in families of which some chain."""
    rng = random.Random(21)
    texts = []
    for _ in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        texts += [" ".join(words), *(edited(rng, words, k) for k in (1, 2, 3, 4, 4, 5, 6, 12))]
    return texts


def kept_by_brute_force(rows):
    """rows: (id, text). The index of the row that stays of each component."""
    found = components([plain_set(t) for _, t in rows], alike)
    least = {}
    for i, c in enumerate(found):
        least[c] = min(least.get(c, i), i, key=lambda x: (rows[x][0] is None, rows[x][0] or 0, x))
    return sorted(least.values())


def test_near_copies_are_found_as_by_brute_force(spark):
    rows = list(enumerate(families()))
    random.Random(2).shuffle(rows)
    want = sorted(rows[i][0] for i in kept_by_brute_force(rows))
    got = STAGE(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), SF)
    assert sorted(r.doc_id for r in got.collect()) == want and 25 <= len(want) < 120


def test_groups_that_a_star_does_not_join(spark, monkeypatch):
    """A family without a centre: pairs of it are mostly below the similarity; its buckets are dealt into small blocks."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, edited(rng, words, 2 + i % 3)) for i in range(40)]
    want = sorted(rows[i][0] for i in kept_by_brute_force(rows))
    for bucket in (4, 1024):
        monkeypatch.setattr(near_texts, "BUCKET", bucket)
        assert sorted(r.doc_id for r in STAGE(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()) == want


def test_recall_of_candidates_at_the_similarity():
    """Sets of 100 and of 10 hashes that are exactly similar enough have a chain within its budgets as often as promised."""
    equal = near_texts.equal_segments(10**6)
    rings = near_texts.rings_needed(0.8, 0.99, equal)
    rng, missed = np.random.default_rng(3), 0
    for size in (90, 9) * 500:
        x = rng.integers(0, 1 << 63, size * 10 // 9, np.uint64)
        fps = [near_texts.ring_fingerprints(x[part], rings) for part in (slice(0, size), slice(len(x) - size, None))]
        both = np.concatenate(fps)
        found = False
        for start in range(8):
            turned = (both >> np.uint64(8 * start)) | (both << np.uint64(64 - 8 * start) if start else np.uint64(0))
            for a, b in zip(turned[:rings], turned[rings:], strict=True):
                gid = np.zeros(2, np.int64)
                same = int(a ^ b) & ((1 << 8 * equal) - 1) == 0
                found |= same and any(True for _ in near_texts._within_budgets(gid, np.array([a, b]).view(np.int64), near_texts.chain_budgets(near_texts.ring_budget(0.8), equal)))
        missed += not found
        assert (np.bitwise_count(fps[0] ^ fps[1]).sum() <= near_texts.full_budget(0.8, rings)) or size == 9
    assert missed <= 20


def test_longer_fingerprints_for_more_rows():
    assert [near_texts.equal_segments(n) for n in (0, 1 << 26, (1 << 26) + 1, 4 * 10**10)] == [2, 2, 3, 4]
    rings = [near_texts.rings_needed(0.8, 0.99, k) for k in (2, 3, 4)]
    assert rings == sorted(rings) and 5 < rings[0] < 20 and near_texts.rings_needed(1.0, 0.99, 2) == 1


def test_ring_fingerprints_are_majorities():
    rng = np.random.default_rng(8)
    for n in (1, 2, 25, 26, 1000, 70_001):
        hashes = rng.integers(0, 1 << 63, n, np.uint64)
        x = hashes[:, None] + np.arange(1, 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        plain = [sum(1 << b for b in range(64) if 2 * int((column >> np.uint64(b) & np.uint64(1)).sum()) > n) for column in x.T]
        assert near_texts.ring_fingerprints(hashes, 3).tolist() == plain


def test_rows_without_or_with_repeated_ids_are_grouped_by_their_texts(spark):
    rng = random.Random(9)
    a, b, c = ([f"{k}{rng.randrange(900)}" for _ in range(100)] for k in "abc")
    rows = [(1, " ".join(a), "p"), (1, " ".join(b), "q"), (1, " ".join(b), "q"), (2, edited(rng, b, 1), "r"), (None, " ".join(c), "s"), (None, edited(rng, c, 1), "t"), (None, edited(rng, a, 1), "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = STAGE(spark, docs, SF).collect()
    assert sorted(r.source for r in got if r.doc_id) == ["p", "q"]
    assert len(got) == 3 and [r.doc_id for r in got].count(None) == 1
    assert sorted(map(str, got)) == sorted(map(str, STAGE(spark, docs.repartition(3), SF).collect()))


def hot_group(n, seed=6):
    """n texts with 0 to 8 changed words of one of 100 words: most pairs are near, many are similar only over others."""
    rng = random.Random(seed)
    words = [f"h{i}" for i in range(100)]
    return [(i, edited(rng, words, rng.randrange(9))) for i in range(n)]


def test_rows_of_a_large_group_are_not_linked_in_every_bucket(spark, monkeypatch):
    """What goes into the components stays in proportion to a group's rows, not to the buckets and blocks they meet in."""
    given, plain = [], near_texts.connected_components

    def counted(links):
        given.append(links.distinct().count())
        return plain(links)

    monkeypatch.setattr(near_texts, "connected_components", counted)
    rows = hot_group(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    texts = len({t for _, t in rows})
    want = [rows[i][0] for i in kept_by_brute_force(rows)]
    for bucket in (1024, 60):
        given.clear()
        monkeypatch.setattr(near_texts, "BUCKET", bucket)
        assert sorted(r.doc_id for r in STAGE(spark, docs, SF).collect()) == want
        assert sum(given) < 8 * texts, given


def test_rows_that_meet_in_large_buckets_only_keep_their_links(spark, monkeypatch):
    """Two families of equal fingerprints but for a few bits; with buckets of one row all links are found in blocks."""
    monkeypatch.setattr(near_texts, "BUCKET", 1)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, (3, 11))
    rows = [(i, [100, *(int(x) for x in base[i % 3] ^ (1 << (i % 40)))]) for i in range(30)]
    got = near_texts.candidate_groups(spark.createDataFrame(rows, "cid long, rings array<long>"), 11, 2, 0.8).collect()
    assert {r.cid: r.grp for r in got} == {i: i % 3 for i in range(30)}
