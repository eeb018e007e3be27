"""Filter audit, positional index and resampling against plain versions on small fixtures."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendloom.llm import audit, positional, resampling, words
from tests.llm.fixtures import docs_frame, empty_docs, odd_texts

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(A_TO_Z, A_TO_Z.lower())
LOWER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_words(text):
    return LOWER_WORD.findall((text or "").translate(LOWER))


def test_words_of_blocks_are_those_of_each_text():
    texts = [t for _, t in odd_texts()] + ["Ab", "cD", "x-9y É", "\x7f\x00", "a" * 5]
    column = pa.array([None if t is None else t.encode() for t in texts], pa.binary())
    for part in (column, column[3:9], column[:0]):
        got, counts = words.words_of(part)
        want = [lower_words((t or b"").decode()) for t in part.to_pylist()]
        assert [w.decode() for w in got.to_pylist()] == [w for ws in want for w in ws]
        assert counts.tolist() == [len(ws) for ws in want]


def test_blocks_hold_about_their_size_and_every_row_once():
    batch = pa.RecordBatch.from_pydict({"text": pa.array([b"x" * n for n in (3, 4, 50, 0, 1, 2, 9)], pa.binary())})
    parts = [p.column("text").to_pylist() for p in words.in_blocks(iter([batch]), step=10)]
    assert [x for p in parts for x in p] == batch.column("text").to_pylist()
    assert all(sum(map(len, p)) <= 10 or len(p) == 1 for p in parts)


# the audit


def plain_audit(docs, labels):
    """docs: (id, text, part); labels: {id: (quality, toxic)}."""
    first = defaultdict(list)
    for i, text, _ in docs:
        if i is not None:
            first[text or ""].append(i)
    parts = defaultdict(list)
    for i, text, part in docs:
        t = text or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum(c in A_TO_Z for c in t) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > min(first[t])}
        parts[part or ""].append(({k for k, v in fails.items() if v}, *labels.get(i, (0, 0))))
    out = []
    for part, rows in parts.items():
        total = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                total[f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(f in r[0] for r in rows) - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] == 1 for r in gone), sum(r[2] == 1 for r in gone)])
        for r in out:
            if r[0] == part:
                r.append(total[r[1][r[2] - 1]])
    return sorted(map(tuple, out))


def labels_frame(spark, labels):
    rows = [(i, q, t) for i, (q, t) in labels.items()] + [(None, 1, 1), (10**6, 1, 1), (0, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_audit_is_what_counting_each_order_gives(spark):
    docs = docs_frame(spark).withColumn("lang", F.when(F.col("n") % 7 != 0, F.when(F.col("n") % 3 == 0, "de").otherwise("en")))
    labels = {i: (i % 2, int(i % 5 == 0)) for i in range(0, 60, 3)}
    want = plain_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    got = audit.audit_filters(docs, labels_frame(spark, labels))
    assert sorted(map(tuple, got.collect())) == want
    assert {r[0] for r in want} == {"", "de", "en"} and len(want) == 3 * 600
    assert sum(r[4] for r in want if "E" == r[1][r[2] - 1]) > 0


def test_audit_with_other_filters_and_of_nothing(spark):
    docs = docs_frame(spark)
    labels = labels_frame(spark, {})
    assert audit.audit_filters(empty_docs(spark), labels).count() == 0
    got = audit.audit_filters(docs, labels, {"x": F.col("v") == 9, "y": F.col("v") == 8}, repeats=None).collect()
    n = docs.count()
    assert {(r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got} == {("xy", 1, 0, n, 0, n, 2 * n), ("xy", 2, 0, 0, 0, 0, 0), ("yx", 1, n, 0, 0, 0, 0), ("yx", 2, 0, n, 0, n, 2 * n)}
    with pytest.raises(ValueError):
        audit.audit_filters(docs, labels, {"E": F.lit(True)})


def test_polynomial_has_exact_shares():
    rng = random.Random(5)
    counts = {m: rng.randint(0, 10**15) for m in range(32)}
    p = audit.RemovalPolynomial(counts, 5)
    for corner in range(32):
        assert p.at(corner) == sum(n for m, n in counts.items() if m & corner)
    for i in range(5):
        marginal = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            marginal += p.at(before | 1 << i) - p.at(before)
        assert p.shapley(i) * 120 == marginal


def test_a_large_group_of_copies_is_split(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same text").otherwise(F.concat(F.lit("other "), F.col("id"))).alias("text"), F.lit("en").alias("lang"))
    rows = audit.mask_counts(docs, labels_frame(spark, {}), {}, True).collect()
    assert {(r["mask"], r.n) for r in rows} == {(0, 2001), (1, 999)}


# the positional index


def plain_hits(text, items):
    w = lower_words(text)
    hit, names = set(), set()
    for item, t in items:
        iw = lower_words(t)
        size = min(10, len(iw))
        windows = {tuple(iw[k : k + size]) for k in range(len(iw) - size + 1)} if iw else set()
        for k in range(len(w) - size + 1) if iw else ():
            if tuple(w[k : k + size]) in windows:
                hit.update(range(k, k + size))
                if item is not None:
                    names.add(str(item))
    return len(w), len(hit), sorted(names)


def items_for(texts):
    body = [t for t in texts if t and 15 < len(lower_words(t)) < 200]
    made = [" ".join(lower_words(b)[2:16]) for b in body[:6]]
    return [(1, made[0]), (2, made[1].upper()), (10, made[2]), (None, made[3]), (4, None), (5, "  -- "), (6, "the"), (7, "an an"), (8, body[5]), (9, "no such words here at all, never"), (11, "So so so so so so so so so so"), (1, made[4]), (12, made[0]), (13, "É ß")]


def test_contamination_is_what_a_scan_of_all_windows_gives(spark):
    docs = docs_frame(spark)
    items = items_for([t for _, t in odd_texts()])
    benchmark = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, n_words int")
    got = positional.contamination(docs, benchmark)
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got.collect())
    assert found == sorted((str(r.doc_id), *plain_hits(r.text, items)) for r in docs.collect())
    assert sum(n > 0 for _, _, n, _ in found) > 20
    assert {"1", "12"} <= {x for _, _, _, names in found for x in names}
    assert positional.contamination(empty_docs(spark), benchmark).count() == 0
    assert all(r.n_hit == 0 and r["items"] == [] for r in positional.contamination(docs, benchmark.limit(0)).collect())


def plain_near(words, item, slop):
    """Places covered by spans of up to 10 + slop words that hold all words of a window of the item."""
    size, covered = min(10, len(item)), set()
    for k in range(len(item) - size + 1):
        need = Counter(item[k : k + size])
        for a in range(len(words)):
            for n in range(size, size + slop + 1):
                if a + n <= len(words) and not need - Counter(words[a : a + n]) and words[a] in need and words[a + n - 1] in need:
                    covered.update(range(a, a + n))
                    break
    return covered


def test_proximity_matches(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(25)]
    item = rng.sample(vocabulary, 10)
    texts = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(30)]
    texts += [" ".join(["x", *item[:4], "between", *item[4:], "y"]), " ".join(reversed(item)), " ".join(item), " ".join([*item[:5], "a b c d e", *item[5:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = {r.doc_id: r for r in positional.contamination(docs, benchmark, slop=3).collect()}
    assert [rows[n].near_items for n in (30, 31, 33)] == [["1"], ["1"], []] and rows[32]["items"] == ["1"] and rows[32].near_items == []
    assert [(m.position, m.length, m.exact) for m in rows[30].matches] == [(1, 11, False)]
    for n, text in enumerate(texts):
        near = plain_near(text.split(), item, 3)
        assert bool(near) == bool(rows[n].matches)
        assert {p for m in rows[n].matches for p in range(m.position, m.position + m.length)} <= near


def test_a_common_word_is_spread_over_blocks(spark):
    docs = spark.range(0, 4000, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("the the other "), F.col("id")).alias("text"))
    index = positional.build_index(docs, block_bytes=4096)
    lists = index.postings.where(F.col("term") == F.lit(b"the")).select("n").collect()
    assert sum(r.n for r in lists) == 8000 and len(lists) > 10
    phrases = spark.createDataFrame([(1, bytearray(b"the other")), (2, bytearray(b"7 the"))], "item long, words binary")
    assert positional.find_items(index, phrases).groupBy("item").count().collect() == [(1, 4000)]
    benchmark = spark.createDataFrame([(1, "the other"), (2, "other 7"), (3, "7 the")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in positional.contamination(docs, benchmark).collect()}
    assert got[7] == (3, ["1", "2"]) and got[8] == (2, ["1"]) and len(got) == 4000


# resampling


def plain_sample(docs, target, shortest=1, longest=1, buckets=10_000, percent=10, seed=2024):
    def runs(text):
        w = lower_words(text)
        return [" ".join(w[k : k + n]) for n in range(shortest, longest + 1) for k in range(len(w) - n + 1)]

    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    s, t = Counter(bucket(f) for _, x in docs for f in runs(x)), Counter(bucket(f) for x in target for f in runs(x))
    own, aimed = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (own + buckets) / ((s[b] + 1) * (aimed + buckets)))) for b in map(bucket, runs(text))]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(gains), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(lower_words(text))])
    may = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    drawn = len(may) * percent // 100
    ranks = {id(r): n for n, r in enumerate(may[:drawn], 1)}
    return sorted((str(tuple((*r[:4], ranks.get(id(r))))) for r in rows))


def odd_target(spark):
    return spark.createDataFrame([(1, "The one an ing, the Est."), (2, None), (3, ""), (4, "so so re")], "item_id long, text string")


@pytest.mark.parametrize(("shortest", "longest"), [(1, 1), (1, 2), (2, 3)])
def test_resampling_is_the_plain_one(spark, shortest, longest):
    docs, target = docs_frame(spark), odd_target(spark)
    want = plain_sample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], shortest, longest)
    got = resampling.resample(docs, target, shortest=shortest, longest=longest)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_resampling_of_nothing_and_towards_nothing(spark):
    docs, target = docs_frame(spark), odd_target(spark)
    assert resampling.resample(empty_docs(spark), target).count() == 0
    got = resampling.resample(docs, target.limit(0))
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_sample([(r.doc_id, r.text) for r in docs.collect()], [])


def test_ranks_are_gapless_over_tasks_and_ties_go_to_the_smaller_id(spark):
    text = " ".join(f"w{k}" for k in range(25))
    docs = spark.range(0, 5000, 1, 8).select((F.col("id") % 3000).alias("doc_id"), F.lit(text).alias("text"))
    rows = resampling.resample(docs, odd_target(spark), percent=100).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 5001))
    by_rank = sorted(rows, key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id) for r in by_rank] == sorted((-r.score, r.doc_id) for r in rows)


def test_postings_of_a_common_bucket_are_split(spark):
    docs = spark.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the").otherwise(F.col("id").cast("string")).alias("text"))
    held = resampling.postings(docs).where((F.col("kind") == resampling.POSTING) & (F.col("bucket") == zlib.crc32(b"the") % 10_000)).collect()
    assert len(held) == 6 and sum(r.total for r in held) >= 1000
