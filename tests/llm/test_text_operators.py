"""Quality rules, token counts, packing, fingerprints and licences against plain versions on small fixtures."""

import random
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendloom.llm import catalogue, licences, packing, quality, simhash, tokens
from tests.llm.fixtures import SF, docs_frame, empty_docs, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def fuzz_texts(n, seed):
    rng = random.Random(seed)
    parts = list(" \n ab.,!?;:'sé１2ßʹªↅ漢か한👍🏽؀　͸𐍈") + ["<|endoftext|>", "  ", "\n\n", "'ll", "word ", "Word.\n", "don't.", " \n", "\t", "\r\n", "aaaa", "2."]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_counts_and_ids_are_the_library_s(tokenizer):
    texts = fuzz_texts(4000, 3) + [t or "" for _, t in odd_texts()]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    raw = [t.encode() for t in texts]
    assert tokens.token_counter(PATH)(raw) == [len(w) for w in want]
    encode = tokens.token_encoder(PATH)
    assert [encode(r).tolist() for r in raw] == want


def test_a_full_cache_changes_nothing(tokenizer):
    words = tokens.vocabulary(PATH)
    small = tokens.ChunkedEncoder(words, lambda t: tokens.merged_counts(t, words), lambda _: 1, sum, size=8)
    texts = fuzz_texts(300, 4)
    for i in range(0, 300, 50):
        assert small([t.encode() for t in texts[i : i + 50]]) == [len(e.ids) for e in tokenizer.encode_batch(texts[i : i + 50], add_special_tokens=False)]


def test_count_tokens_over_odd_rows(spark, tokenizer):
    docs = docs_frame(spark)
    got = tokens.count_tokens(docs, PATH).collect()
    assert len(got) == docs.count()
    assert all(r.n_tokens == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in got)
    assert tokens.count_tokens(empty_docs(spark), PATH).count() == 0


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    found, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if found[w] > 1:
            covered.update(range(i, i + 5))
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""), "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered)}


def test_quality_counts_and_verdicts(spark):
    docs = docs_frame(spark)
    got = quality.with_verdict(docs).select("text", "quality.*").collect()
    assert len(got) == docs.count()
    for r in got:
        want = plain_counts(r.text)
        assert {k: r[k] for k in want} == want
        assert r.base_failed == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert r.kept == (r.first_failed is None)
    assert quality.with_verdict(empty_docs(spark)).count() == 0


def test_order_of_rules_never_changes_the_verdict(spark):
    docs = docs_frame(spark)
    verdicts = [[r.kept for r in quality.with_verdict(docs, order=o).orderBy("n").select("quality.kept").collect()] for o in ([0, 1, 2, 3], [3, 2, 1, 0])]
    assert verdicts[0] == verdicts[1]


def test_cheap_selective_rules_come_first(spark):
    slow = quality.Rule("slow", lambda c: sum(i * i for i in range(20_000)) < 0)
    always = quality.Rule("always", lambda c: True)
    assert quality.rule_order(docs_frame(spark), (slow, always)) == [1, 0]


def check_pieces(rows, texts, tokenizer, window=2048):
    """texts: list of (doc_id, text)."""
    want = Counter()
    for d, t in texts:
        want[d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    by_doc = {}
    for (d, ids), n in want.items():
        by_doc.setdefault(d, []).append((np.array(ids, "<u4"), n))
    held = Counter()
    for r in rows:
        held[r.doc_id] += r.length
        assert any(len(ids) == r.doc_tokens and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for ids, _ in by_doc[r.doc_id])
    assert held == Counter({d: sum(len(i) * n for i, n in x) for d, x in by_doc.items()})
    in_sequence = {}
    for r in rows:
        in_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in in_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0


@pytest.mark.parametrize(("most_open", "task_tokens"), [(4096, 1 << 24), (2, 1 << 24), (1 << 14, 10_000)])
def test_packing_loses_nothing_and_pads_nothing(spark, tokenizer, most_open, task_tokens):
    docs = docs_frame(spark).repartition(3)
    rows = packing.pack_online(docs, PATH, most_open=most_open, task_tokens=task_tokens).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert packing.pack_online(empty_docs(spark), PATH).count() == 0


def test_no_more_windows_than_allowed_are_open():
    """Remainders of which no two fit a window: each opens another one."""
    rng = random.Random(2)
    pieces = [(n, 0, np.full(33 + rng.randint(0, 3), n, "<u4"), 36) for n in range(3000)]
    taken, left = 0, []

    def counted():
        nonlocal taken
        for piece in pieces:
            taken += 1
            yield piece

    for full, items in packing._packed(counted(), 64, 20):
        assert not full and len(items) == 1
        left += items
        assert taken - len(left) <= 21
    assert sorted(p[0] for p in left) == list(range(3000))


@pytest.mark.parametrize("partitions", [4, 8])
def test_most_windows_are_filled_by_the_sum_of_squares(spark, partitions):
    """Windows that are poured hold a cut piece, or are the last of a stream; few do, however many partitions there are."""
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.1')}/documents.parquet").repartition(partitions, "doc_id")
    rows = packing.pack_online(docs, PATH)
    poured = F.count_if(F.col("cut") > 0)
    cut = F.count_if((F.col("start") % 2048 != 0) | ((F.col("start") + F.col("length") != F.col("doc_tokens")) & (F.col("length") != 2048)))
    n = rows.groupBy("sequence_id").agg(cut.alias("cut")).agg(F.count("*").alias("all"), poured.alias("poured")).first()
    assert n["all"] > 3000 and n.poured < 0.1 * n["all"]


def test_sum_of_squares_picks_the_least_growth():
    packer, rng = packing.SumOfSquares(64), random.Random(1)
    for _ in range(400):
        size = rng.randint(1, 64)
        count = packer.count.copy()

        def growth(level, count=count, size=size):
            after = count.copy()
            if level:
                after[level] -= 1
            if level + size < 64:
                after[level + size] += 1
            return int((after**2).sum())

        options = [h for h in range(1, 64 - size + 1) if count[h]] + [0]
        assert growth(packer.level_for(size)) == min(map(growth, options))
        packer.place((0, 0, np.zeros(size), size), size)


def test_best_fit_decreasing_is_best_fit():
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(300)]
    windows = packing.best_fit_decreasing(sizes, 100)
    free = []
    for i in sorted(range(300), key=lambda i: -sizes[i]):
        fits = [k for k, f in enumerate(free) if f >= sizes[i]]
        k = min(fits, key=lambda k: free[k]) if fits else len(free)
        free += [100] * (not fits)
        free[k] -= sizes[i]
    assert sorted(100 - sum(sizes[i] for i in w) for w in windows) == sorted(free)
    assert sorted(i for w in windows for i in w) == list(range(300))


def test_matrices_hold_every_id(spark, tokenizer, tmp_path):
    docs = docs_frame(spark)
    rows = packing.pack_matrices(docs, PATH, block_tokens=5000)
    packing.write_matrices(rows, str(tmp_path / "m"))
    assert all(m.shape == (2048,) for m in packing.read_matrix(spark, str(tmp_path / "m")))
    pieces = Counter()
    for r in spark.read.parquet(str(tmp_path / "m")).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[:-1] + ([r.n_tokens] if r.n_tokens < 2048 else [])
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            pieces[d, s, tuple(ids[a:b].tolist())] += 1
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.update((r.doc_id, s, tuple(ids[s : s + 2048])) for s in range(0, len(ids), 2048))
    assert pieces == want
    assert packing.pack_matrices(empty_docs(spark), PATH).count() == 0


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, near):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints_and_groups(spark):
    docs = docs_frame(spark).where("doc_id is not null")
    got = simhash.simhash_groups(docs).select("doc_id", simhash.hex_digits().alias("f"), "component_id").collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(f"{plain_fingerprint(r.text):016x}")
    assert sorted((d, f) for d, fs in texts.items() for f in fs) == sorted((r.doc_id, r.f) for r in got)
    rows = sorted(((r.doc_id, r.f, r.component_id) for r in got))
    found = components([int(f, 16) for _, f, _ in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (d, _, _), c in zip(rows, found, strict=True):
        least[c] = min(d, least.get(c, d))
    assert [c for _, _, c in rows] == [least[c] for c in found]
    assert simhash.simhash_groups(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("bucket", [2048, 8, 2])
def test_split_buckets_lose_no_link(spark, bucket):
    rng = random.Random(bucket)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(20)} | set(base) | {rng.getrandbits(64) for _ in range(50)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    links = simhash.near_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket).collect()
    mask = (1 << 64) - 1
    assert all(((r.a ^ r.b) & mask) in range(mask + 1) for r in links)
    want = components(signed, lambda a, b: ((a ^ b) & mask).bit_count() <= 2)
    place = {f: i for i, f in enumerate(signed)}
    pairs = {(place[r.a], place[r.b]) for r in links}
    joined = components(range(len(signed)), lambda a, b: (a, b) in pairs or (b, a) in pairs)
    assert [want.index(x) for x in want] == [joined.index(x) for x in joined]


def test_licences(spark):
    mit = next(t for n, t in licences.NOTICES if n == "MIT" and len(t) > 500)
    rows = [(1, "MIT License text".replace("MIT License text", "Copyright (c) 2020 Somebody\n" + mit.upper().replace(", ", " ,\n"))), (2, "first line\nLicenced under CC BY-NC 4.0!\nRELEASED under the MIT licence\n"), (3, None), (4, ""), (5, "nothing of the kind")]
    got = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text_licence == "MIT"
    assert (got[2].text_licence, got[2].n_licence_lines, got[2].line_licences) == (None, 2, "CC-BY-NC-4.0,MIT")
    assert {got[i].n_licence_lines for i in (3, 4, 5)} == {0} and got[3].text_digest == got[4].text_digest
    odd = licences.scan_licences(docs_frame(spark)).collect()
    assert sorted(str(r.doc_id) for r in odd) == sorted(str(r.doc_id) for r in docs_frame(spark).collect())
    assert all((r.text_licence, r.n_licence_lines, r.line_licences, r.block_licences) == (None, 0, "", "") for r in odd)
    assert licences.scan_licences(empty_docs(spark)).count() == 0


def test_what_follows_a_claim_stays(spark):
    notice = "Permission to use, copy, modify, and/or distribute this software"
    rows = {
        1: "Copyright (c) 2020 Foo Inc. The river ran past the mill and on.",
        2: "(c) one whole long prose line",
        3: "",
        4: "Copyright 2019-2024 by the many people who made this and never came to an end of it in one line",
        5: "Copyright (c) 1999, 2001 Jane Doe. All rights reserved. Released under the MIT License.",
        6: "The river ran past the mill and on.",
        7: "Copyright (c) 2020 Foo Inc.",
        8: "© 2020 Foo\n" + notice + "\n(c) 2021 Bar. " + notice,
        9: "Copyright (c) 2020 Foo. A story about the word copyright. It was " + "long and " * 40 + "licensed under the MIT License.",
    }
    got = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    digests = {i: got[i].text_digest for i in rows}
    assert len({digests[i] for i in (1, 2, 3, 4, 5, 8, 9)}) == 7
    assert digests[1] == digests[6] and digests[7] == digests[3]
    assert got[5].text_licence == "MIT"
    both = licences.scan_licences(spark.createDataFrame([(1, f"{notice}\n{notice}")], "doc_id long, text string")).first()
    assert both.text_digest == digests[8]


def test_published_licences_are_found_as_people_write_them(spark):
    texts = dict(reversed(licences.published_texts()))
    assert {"MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "LGPL-2.0", "MPL-2.0", "Unlicense"} <= texts.keys()
    curly = texts["MIT"].replace('"AS IS"', "“AS\u00a0IS”").replace("without limitation", "without\u00a0limitation").replace("and/or", "and / or")
    wrapped = "\n".join(" * " + line for line in textwrap.wrap(next(t for n, t in licences.NOTICES if n == "LGPL-2.1-or-later"), 60))
    gpl = next(t for n, t in licences.published_texts() if n == "GPL-3.0")
    rows = {
        1: texts["MIT"].replace("MIT License", "The MIT License (MIT)").replace("<year> <copyright holders>", "2021 Jane Doe <jane@example.org>\nAll rights reserved."),
        2: curly,
        3: "\n\n".join(textwrap.fill(p, 70) for p in texts["BSD-3-Clause"].split("\n\n")).replace("COPYRIGHT HOLDER ", "COPYRIGHT OWNER ").replace("1. ", "   * ").replace("2. ", "   * "),
        4: texts["Apache-2.0"].upper(),
        5: texts["GPL-3.0"],
        6: re.sub(r"\bLicense\b", "Licence", gpl),
        7: f"/*\n * widget.c\n *\n{wrapped}\n */\nint main() {{}}",
        8: "Our package holds a part by others.\n\n" + texts["MIT"] + "\n\nThe end of the story.",
        9: "Copyright 2020 Some Body. Licensed under the MIT License.",
        10: texts["MIT"].replace("free of charge", "for a small fee"),
        11: texts["MIT-0"],
    }
    got = {r.doc_id: r for r in licences.scan_licences(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert [got[i].text_licence for i in range(1, 12)] == ["MIT", "MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "GPL-3.0", None, None, "MIT", None, "MIT-0"]
    assert got[7].block_licences == "LGPL-2.1-or-later" and got[8].block_licences == "MIT" and got[9].line_licences == "MIT"
    assert got[10].block_licences == "" and got[11].block_licences == "MIT-0"


@pytest.mark.parametrize("name", catalogue.ORACLE_SQL)
def test_query_gives_what_its_sql_gives(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df, want = catalogue.QUERIES[name](spark, SF), connection.sql(catalogue.ORACLE_SQL[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    assert sorted(tuple(map(str, r)) for r in df.select(*order).collect()) == sorted(tuple(map(str, r)) for r in want.select(*order).fetchall())
