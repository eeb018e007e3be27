"""Vectors, shards, mixes, the classifier and the pipeline against plain versions on small fixtures."""

import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendloom.llm import catalogue, embeddings, mixing, sharding, toxicity
from lendloom.llm.common import repeated
from lendloom.llm.components import connected_components
from tests.llm.fixtures import SF, docs_frame, empty_docs
from tests.llm.test_near_texts import edited, kept_by_brute_force
from tests.llm.test_text_operators import WORD, check_pieces, components


def test_components_of_paths_stars_and_hubs(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    links = [*path, *star, (7, 7), (3, 2), (2, 3), (None, 4)]
    random.Random(1).shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {2: 2, 3: 2}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, v int, n int, cid int"


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 16))
    x = np.concatenate([rng.standard_normal((150, 16)), *(c + 0.12 * rng.standard_normal((k * 3, 16)) for k, c in enumerate(centres, 1))]).astype(np.float32)
    rows = [(i, v.tolist(), 1, 1, 1, 1) for i, v in enumerate(x)]
    rows += [(1000 + i, x[200].tolist(), None, 1, 1, 1) for i in range(30)] + [(2000, (2 * x[200]).tolist(), None, 1, 1, 1)]
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(3000 + i, v, None, 1, 1, 1) for i, v in enumerate(odd)]
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, VECTORS), window=32).collect()}
    assert len(got) == len(rows)
    good = [(r[0], np.array(r[1], float)) for r in rows if r[0] < 3000]
    unit = [(i, v / np.linalg.norm(v)) for i, v in good]
    links = {i: sum(float(v @ w) >= 0.95 for j, w in unit if j != i) for i, v in unit}
    assert {i: got[i].n_links for i in links} == links
    found = components([v for _, v in unit], lambda a, b: float(a @ b) >= 0.95)
    assert [got[i].component_id for i, _ in unit] == [unit[c][0] for c in found]
    for i in range(len(odd)):
        assert tuple(got[3000 + i]) == (3000 + i, 0, 3000 + i, True)
    assert embeddings.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_large_components_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    rng = np.random.default_rng(4)
    x = (rng.standard_normal(16) + 0.1 * rng.standard_normal((300, 16))).astype(np.float32)
    got = embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id int, embedding array<float>"), window=16).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert [r.n_links for r in sorted(got)] == want.tolist()


def off_centre(n, background, share, rng, dim=64):
    """n vectors of which a share has this cosine with one another, and 500 pairs among these at cosine 0.955."""
    mean = np.eye(dim)[0]
    x = rng.standard_normal((n, dim))
    own = int(n * share)
    x[:own, 0] = 0
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:own] = math.sqrt(background) * mean + math.sqrt(1 - background) * x[:own]
    for i in range(0, 1000, 2):
        away = rng.standard_normal(dim)
        away -= (away @ x[i]) * x[i]
        x[i + 1] = 0.955 * x[i] + math.sqrt(1 - 0.955**2) * away / np.linalg.norm(away)
    return x


@pytest.mark.parametrize(("background", "share", "n"), [(0.85, 1.0, 100_000), (0.85, 1 / 3, 30_000)])
def test_recall_where_vectors_are_dense(spark, background, share, n):
    x = off_centre(n, background, share, np.random.default_rng(5))
    unit = x[:1000] / np.linalg.norm(x[:1000], axis=1, keepdims=True)
    table = pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))})
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(table)).where("vec_id < 1000").collect()}
    assert min(float(unit[i] @ unit[i + 1]) for i in range(0, 1000, 2)) > 0.95
    met = [got[i].component_id == got[i + 1].component_id for i in range(0, 1000, 2)]
    assert np.mean(met) >= 0.95
    linked = (unit @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T >= 0.95).sum(axis=1) - 1
    assert all(got[i].n_links <= linked[i] for i in range(1000))
    assert sum(r.n_links for r in got.values()) >= 0.95 * linked.sum()


def test_pairs_at_the_threshold_and_null_ids(spark):
    at, below = [0.95, math.sqrt(1 - 0.95**2)], [0.95 - 1e-9, math.sqrt(1 - (0.95 - 1e-9) ** 2)]
    unit = [np.array(v) / np.linalg.norm(v) for v in (at, below)]
    rows = [(1, [1.0, 0.0]), (2, at), (None, [0.0, -1.0]), (None, [0.0, -2.0]), (4, [-1.0, 0.0]), (5, [-below[0], below[1]])]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    of = {r.vec_id: r for r in got if r.vec_id is not None}
    assert of[1].n_links == of[2].n_links == int(unit[0][0] >= 0.95)
    assert of[4].n_links == of[5].n_links == int(unit[1][0] >= 0.95) == 0
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 1, None, True)] * 2


def test_shards_are_even_gapless_and_repeatable(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(0, 300)) for i in range(3000)] + [(i, None) for i in range(3000, 3100)] + [(7, "again")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit(99))
    got = sharding.shard_documents(docs, shards=10).collect()
    assert len(got) == len(rows)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    share = sum(sizes.values()) / 10
    assert set(sizes) == set(range(10)) and all(0.98 * share < s < 1.02 * share for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(got) == sorted(sharding.shard_documents(docs.repartition(5), shards=10).collect())
    assert sharding.shard_documents(empty_docs(spark)).count() == 0
    assert sharding.shard_documents(docs_frame(spark)).count() == docs_frame(spark).count()


def plain_ring(cells, nodes, shards):
    """cells {cell: size} on a ring with nodes {cell: shard}: each goes clockwise until a shard takes it."""
    share, used, at = sum(cells.values()) / shards, [0] * shards, {}

    def one_round(waiting, open_, fitting):
        ring = sorted((c, s) for c, s in nodes.items() if s in open_)
        by_shard, full = defaultdict(list), set()
        for c in waiting:
            by_shard[next((s for p, s in ring if p >= c), ring[0][1])].append(c)
        for s, own in by_shard.items():
            before = used[s]
            for c in sorted(own, key=lambda c: (-waiting[c], c)):
                if (before + waiting[c] <= share or before == 0) if fitting else (before < share or share == 0):
                    at[c] = s
                    used[s] += waiting[c]
                else:
                    full.add(s)
                before += waiting[c]
        return {c: n for c, n in waiting.items() if c not in at}, full

    def class_of(size):
        n, edge = 0, max(share / 64, 1)
        while size >= edge * (1 - 1e-12):
            n, edge = n + 1, edge * 4
        return n

    left = {}
    for own in sorted({class_of(n) for n in cells.values()}, reverse=True):
        waiting, fitting = {c: n for c, n in cells.items() if class_of(n) == own}, set(range(shards))
        while waiting and fitting:
            waiting, full = one_round(waiting, fitting, True)
            fitting -= full
        left |= waiting
    while left:
        left, _ = one_round(left, {s for s in range(shards) if used[s] < share} or set(range(shards)), False)
    return at


def test_few_documents_are_spread_evenly(spark):
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/documents.parquet")
    loads = [r.n for r in sharding.shard_documents(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    share = sum(loads) / 40
    assert len(loads) == 40 and 0.95 * share < min(loads) and max(loads) < 1.05 * share


@pytest.mark.parametrize(("shards", "most"), [(3, 5), (10, 40)])
def test_cells_are_placed_as_on_a_plain_ring(spark, shards, most):
    rng = random.Random(shards)
    cells = {c: rng.randint(1, most) ** 2 for c in rng.sample(range(1 << 16), 400)}
    nodes = {r.cell: r.shard for r in sharding.virtual_nodes(spark, shards, 16).collect()}
    frame = spark.createDataFrame([(c, n, 1) for c, n in cells.items()], "cell int, size long, rows long")
    assert {r.cell: r.shard for r in sharding.place_cells(frame, shards, 16).collect()} == plain_ring(cells, nodes, shards)


def test_few_cells_move_when_a_shard_is_added(spark):
    """An eleventh shard must take a eleventh of the cells; not much more than that moves."""
    cells = spark.range(1 << 16).select(F.col("id").cast("int").alias("cell"), (F.pmod(F.xxhash64("id"), F.lit(90)) + 50).cast("long").alias("size"), F.lit(1).cast("long").alias("rows"))
    at = [{r.cell: r.shard for r in sharding.place_cells(cells, n, 128).collect()} for n in (10, 11)]
    moved = sum(at[0][c] != at[1][c] for c in at[0])
    assert moved < 0.15 * (1 << 16)


def test_copies_of_a_hot_row_are_made_by_many_tasks(spark):
    rows = spark.createDataFrame([(1, 333_333), (2, 1), (3, 10_000), (4, 10_001), (5, 1)], "id long, n long")
    out = repeated(rows, "n", "number")
    found = {r.id: (r.c, r.d, r.least, r.most) for r in out.groupBy("id").agg(F.count("*").alias("c"), F.count_distinct("number").alias("d"), F.min("number").alias("least"), F.max("number").alias("most")).collect()}
    assert found == {r.id: (r.n, r.n, 1, r.n) for r in rows.collect()}
    tasks = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(tasks) < 0.6 * 353_336


def test_one_row_repeated_many_times_is_spread_over_the_shards(spark):
    docs = spark.range(100_000).selectExpr("cast(7 as long) as doc_id", "'the same' as text").unionByName(spark.range(50_000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text"))
    got = sharding.shard_documents(docs, shards=10).groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last")).collect()
    share = sum(r.bytes for r in got) / 10
    assert sum(r.n for r in got) == 150_000 and all(r.n == r.slots == r.last + 1 for r in got)
    assert all(0.98 * share < r.bytes < 1.02 * share for r in got)


def plain_mix(rows):
    """rows: (doc_id, source, size). Targets by the stated rule, step by step."""
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        for s in over or list(open_):
            target[s] = 2.0 * sizes[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    return sizes, target


def test_mix_reaches_its_targets(spark):
    rng = random.Random(6)
    texts = [(i, " ".join(["w"] * rng.randint(0, 60)) if i % 50 else None, rng.choice(["b", "a", "Z", "é", None]) if i % 3 else "hot") for i in range(2000)]
    docs = spark.createDataFrame([*texts, *texts[:5]], "doc_id long, text string, source string").withColumn("size", F.lit(1)).withColumn("target", F.lit("x"))
    got = mixing.mix(docs).collect()
    rows = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]
    sizes, target = plain_mix(rows)
    source = {d: s for d, s, _ in rows}
    assert sorted((r.doc_id, r.size) for r in got) == sorted((d, n) for d, _, n in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert sorted(got) == sorted(mixing.mix(docs.repartition(7)).collect())
    assert mixing.mix(empty_docs(spark)).count() == 0
    assert {r.taken for r in mixing.mix(docs.withColumn("text", F.lit(" "))).collect()} == {0}


def test_taken_documents_come_as_often_as_they_are_taken(spark):
    docs = docs_frame(spark)
    rows = mixing.take_mix(docs)
    assert rows.columns == docs.columns
    want = defaultdict(int)
    for r in mixing.mix(docs).collect():
        if r.taken:
            want[r.doc_id] += r.taken // r.size
    got = defaultdict(int)
    for r in rows.collect():
        got[r.doc_id] += 1
    assert dict(got) == dict(want)


def test_mix_of_one_row_repeated_many_times(spark):
    """A third of all rows are one row; the cut falls between them. The texts are taken as often as the plain list says."""
    repeated = spark.range(20_000).selectExpr("cast(7 as long) as doc_id", "'a b c' as text", "'hot' as source")
    others = spark.range(40_000).selectExpr("id + 100 as doc_id", "concat('w ', id % 7) as text", "if(id % 2 = 0, 'hot', 'cold') as source")
    docs = repeated.unionByName(others)
    mixed = mixing.mix(docs).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.expr("taken div size")).alias("times"), F.max("taken").alias("most"))
    got = {r.doc_id: (r.n, r.times) for r in mixed.collect()}
    assert got[7][0] == 20_000 and len(got) == 40_001
    hot = mixing.mix(docs).where("source_size = 100000").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).first()
    assert abs(hot.t - hot.target) <= 4
    taken = {r.doc_id: r.n for r in mixing.take_mix(docs.repartition(7)).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert taken == {d: t for d, (_, t) in got.items() if t}


def test_first_rows_of_equal_ones_are_found_by_counts(spark):
    rows = spark.range(0, 1000, 1, 7).select(F.when(F.col("id") % 2 == 0, "a").alias("source"), F.lit("h").alias("h"), F.monotonically_increasing_id().alias("number"))
    wanted = F.when(F.col("source").isNull(), F.array(F.lit(0), F.lit(1 << 62))).otherwise(F.array(F.lit(123), F.lit(1)))
    limits = {r.source: r.limits for r in mixing._numbers_of_first(rows.withColumn("wanted", wanted)).collect()}
    for source, counts in (("a", (123, 1)), (None, (0, 500))):
        numbers = [r.number for r in rows.collect() if r.source == source]
        assert [sum(n <= limit for n in numbers) for limit in limits[source]] == list(counts)


def plain_taken(docs):
    """{doc_id: how often the mix takes it}: sort every copy of every document by finish time, stop at the budget."""
    keyed = docs.select("doc_id", "source", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("size"), mixing.shuffle_key("doc_id", "text", mixing.SEED).alias("h")).collect()
    sizes, target = plain_mix([(r.doc_id, r.source, r.size) for r in keyed])
    copies, words = [], defaultdict(int)
    for r in sorted(keyed, key=lambda r: (str(r.source), r.h, r.doc_id, r.size)):
        words[r.source] += r.size
        if r.size and target[r.source]:
            copies += [((words[r.source] + k * sizes[r.source]) / target[r.source], r.size, r.doc_id) for k in (0, 1)]
    taken, held, copies = defaultdict(int), 0, sorted(copies)
    for finish in sorted({c[0] for c in copies}):
        group = [c for c in copies if c[0] == finish]
        held += sum(c[1] for c in group)
        if held > 1.5 * sum(sizes.values()):
            break
        for _, _, doc in group:
            taken[doc] += 1
    return dict(taken)


def test_mix_takes_what_sorting_all_copies_by_finish_time_takes(spark):
    rng = random.Random(12)
    rows = [(i % 700, " ".join(["w"] * rng.randint(0, 9)), rng.choice(["a", "b", None])) for i in range(900)]
    docs = spark.createDataFrame([*rows, *rows[:40]], "doc_id long, text string, source string")
    got = mixing.mix(docs).where("taken > 0").groupBy("doc_id").agg(F.sum(F.expr("taken div size")).alias("times")).collect()
    assert {r.doc_id: r.times for r in got} == plain_taken(docs)


def sentences(spark):
    """Toxic sentences mention a group more often than others do, but what makes them toxic is the insult."""
    rng = random.Random(8)
    filler = ["tree", "river", "lamp", "window", "garden", "letter", "stone", "paper", "music", "road"]
    rows = []
    for i in range(3000):
        toxic = i % 4 == 0
        words = [rng.choice(filler) for _ in range(12)]
        if toxic and rng.random() < 0.85:
            words[3] = rng.choice(["scum", "moron"])
        if rng.random() < (0.9 if toxic else 0.02):
            words[5] = "muslims"
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_swap_penalty_lowers_false_alarms_on_neutral_mentions(spark):
    rows = sentences(spark)
    training = rows.select(F.col("text").cast("binary").alias("text"), F.col("toxic").alias("label"))
    neutral = spark.createDataFrame([("the muslims sat by the river with a lamp",), ("muslims in the garden",), ("a letter for the muslims",)], "text string")
    score = {p: toxicity.with_score(neutral, toxicity.fit(training, swap_penalty=p)).agg(F.avg("score")).first()[0] for p in (0.0, 5.0)}
    assert score[5.0] < 0.5 * score[0.0]
    insults = toxicity.with_score(spark.createDataFrame([("you moron tree",)], "text string"), toxicity.fit(training, swap_penalty=5.0)).first().score
    assert insults > 0.5


def test_insults_behind_long_unspaced_runs_count(spark):
    training = sentences(spark).select(F.col("text").cast("binary").alias("text"), F.col("toxic").alias("label"))
    texts = [("_".join(["tree"] * 20) + "_moron_" + "_".join(["lamp"] * 20),), ("/".join(["river"] * 5000) + "/moron",), ("_".join(["tree"] * 200),), ("moron",)]
    inner, last, clean, _ = (r.score for r in toxicity.with_score(spark.createDataFrame(texts, "text string").coalesce(1), toxicity.fit(training)).collect())
    assert inner > 0.5 and last > 0.5 and clean < 0.1


def plain_features(text):
    out = set()
    for token in text.lower().split():
        word = token.strip(".,;:!?()[]'\"_-")
        marked = f"^{word}$"
        if word:
            out |= {marked} | {marked[i : i + n] for n in (4, 5, 6) for i in range(len(marked) - n + 1)}
    return out


def test_features_and_scores_are_those_of_a_plain_version(spark):
    rows = [(r.text, r.toxic) for r in sentences(spark).where("doc_id < 600").collect()] + [("A (moron)! tree.", 1), ("", 0), ("lamp, lamp; MORON", 1)]
    frame = spark.createDataFrame(rows, "text string, label int").select(F.col("text").cast("binary").alias("text"), "label").repartition(3)
    count = [defaultdict(int), defaultdict(int)]
    for text, label in rows:
        for f in plain_features(text):
            count[label][f] += 1
    toxic = sum(label for _, label in rows)
    odds = {f: (n / toxic) / ((count[0][f] + 1) / (len(rows) - toxic + 1)) for f, n in count[1].items() if n >= max(3, 0.005 * toxic)}
    worth = {f: count[1][f] * math.log(x) for f, x in odds.items() if x >= 8}
    assert len(worth) > 20 and toxicity.choose_features(frame, 10_000) == tuple(sorted(worth))
    best = sorted(worth, key=lambda f: (-worth[f], f))
    assert toxicity.choose_features(frame, 7) == tuple(sorted(best[:7]))
    model = toxicity.fit(frame)
    weight = dict(zip(model.features, model.weights, strict=True))
    for r in toxicity.with_score(spark.createDataFrame([(t,) for t, _ in rows], "text string"), model).collect():
        z = model.bias + sum(weight.get(f, 0.0) for f in plain_features(r.text))
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)


def test_classifier_holds_out_and_generalises(spark):
    docs, labels = spark.read.parquet(f"{SF}/../sf0.1/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    held = toxicity.with_score(docs, model).join(labels, "doc_id").where(toxicity.held_out("doc_id")).select("score", "toxic").collect()
    toxic, other = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    assert np.mean([a > b for a in toxic for b in other]) > 0.9
    assert np.mean([s >= 0.3 for s in other]) < 0.03
    assert np.mean([s >= 0.3 for s in toxic]) > 0.8


def test_classifier_over_odd_rows(spark):
    docs = docs_frame(spark)
    labels = spark.createDataFrame([(5, 1, None), (6, None, 1), (None, 1, 1), (8, 0, 0), (8, 1, 1)], "doc_id long, quality int, toxic int")
    scored = toxicity.with_score(docs, toxicity.train(docs, labels))
    assert scored.where("score between 0 and 1").count() == docs.count()
    none = toxicity.train(empty_docs(spark), labels.limit(0))
    assert toxicity.with_score(empty_docs(spark), none).count() == 0
    assert toxicity.with_score(docs, none).where("score < 0.01").count() == docs.count()


def test_identity_terms_are_swapped():
    assert toxicity.swap_identity("Muslims and WOMEN, not womenfolk") == "christians and men, not womenfolk"


@pytest.fixture(scope="module")
def pipeline():
    import corpus_pipeline

    return corpus_pipeline


def test_stages_over_odd_rows(spark, pipeline):
    for _, stage in pipeline.STAGES[:-1]:
        for docs in (docs_frame(spark), empty_docs(spark)):
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
            out.collect()
    assert pipeline.STAGES[-1][1](spark, empty_docs(spark), SF).count() == 0


def test_every_stage_decides_as_a_plain_version(spark, pipeline, tmp_path):
    """Planted toxic, poor and copied documents: what each stage keeps against SQL, brute force and sorting."""
    rng = random.Random(30)
    clean = [[f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 140))] for _ in range(220)]
    rows = [(" ".join(w), 0) for w in clean]
    rows += [(edited(rng, w, k % 6), 0) for k, w in enumerate(clean[:60])]
    rows += [(" ".join([*w[:30], rng.choice(["scum", "moron"]), *w[30:]]), 1) for w in clean[60:120]]
    rows += [(" ".join([*w[:20], "$ # | & %", *w[20:40]]), 0) for w in clean[120:150]] + [("too short", 0), (None, 0), ("", 0), ("so " * 60, 0)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, text, rng.choice(["a", "b", "b", None])) for i, (text, _) in enumerate(rows)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, 1, toxic) for i, (_, toxic) in enumerate(rows)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    def plain_stage(k, held):
        if k == 0:
            return {r.doc_id: 1 for r in held if not rows[r.doc_id][1]}
        if k == 1:
            connection = duckdb.connect()
            documents = pa.table({"doc_id": [r.doc_id for r in held], "text": [r.text for r in held]})  # noqa: F841
            return dict.fromkeys((d for d, kept in connection.sql(f"select doc_id, kept from ({catalogue.OP2})").fetchall() if kept), 1)
        if k == 2:
            texts = [(r.doc_id, r.text) for r in held]
            return {texts[i][0]: 1 for i in kept_by_brute_force(texts)}
        return plain_taken(docs)

    for k, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        want = plain_stage(k, docs.collect())
        docs = spark.read.parquet(str(tmp_path / str(k)))
        got = {r.doc_id: r.n for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
        assert got == want, pipeline.STAGES[k][0]
        assert len(got) > 100


def test_pipeline_does_what_its_stages_say(spark, pipeline, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = pipeline.run(spark, SF).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], tokenizer)
