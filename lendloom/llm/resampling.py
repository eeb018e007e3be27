"""Importance resampling towards a target corpus, over inverted postings of hashed features."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lendloom.llm.common import cut_lineage, stored, text_bytes
from lendloom.llm.words import block_ids, in_blocks, words_of

BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, 2024, 20, 10
#: A bucket's postings go to so many tasks, as a common word's bucket is in every block.
SPLIT = 16
POSTING, DOCUMENT = "posting", "document"


def features(texts: pa.Array, shortest: int, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All runs of consecutive words of a block of texts, the text's number of each, and how many words each text has."""
    words, counts = words_of(texts)
    of = np.repeat(np.arange(len(counts)), counts)
    runs, rows = [], []
    for n in range(shortest, longest + 1):
        whole = of[: len(of) - n + 1] == of[n - 1 :] if len(of) >= n else np.zeros(0, bool)
        parts = [words[k : k + len(whole)].filter(pa.array(whole)) for k in range(n)]
        runs.append(parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())))
        rows.append(of[: len(whole)][whole])
    return pa.concat_arrays(runs), np.concatenate(rows), counts


def postings(docs: DataFrame, buckets: int = BUCKETS, shortest: int = 1, longest: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:
    """An inverted index: for each block of documents and bucket a posting, the list of documents (by their place in the
    block) and how often features of the bucket come there; and for each document a row with its words and features."""
    kind = docs.schema[id].dataType
    schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int32()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("total", pa.int64()), ("place", pa.int32()), ("id", to_arrow_type(kind)), ("n_words", pa.int64()), ("n_features", pa.int64())])

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_block = block_ids()
        for batch in in_blocks(batches):
            n, block = batch.num_rows, new_block()
            runs, rows, n_words = features(batch.column("text"), shortest, longest)
            coded = runs.dictionary_encode()
            bucket_of = np.fromiter((zlib.crc32(x) % buckets for x in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
            keys, counts = np.unique(bucket_of[coded.indices.to_numpy()] * n + rows, return_counts=True) if len(runs) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            bucket, place = keys // n, (keys % n).astype(np.int32)
            found, starts = np.unique(bucket, return_index=True)
            ends = pa.array(np.r_[starts, len(keys)], pa.int32())
            totals = np.add.reduceat(counts, starts) if len(starts) else counts
            given = {"bucket": pa.array(found, pa.int32()), "places": pa.ListArray.from_arrays(ends, pa.array(place)), "counts": pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())), "total": pa.array(totals, pa.int64())}
            yield _batch(schema, POSTING, block, len(found), given)
            given = {"place": pa.array(range(n), pa.int32()), "id": batch.column("id").cast(schema.field("id").type), "n_words": pa.array(n_words, pa.int64()), "n_features": pa.array(np.bincount(rows, minlength=n), pa.int64())}
            yield _batch(schema, DOCUMENT, block, n, given)

    out = f"kind string, block long, bucket int, places array<int>, counts array<long>, total long, place int, id {kind.simpleString()}, n_words long, n_features long"
    return docs.select(F.col(id).alias("id"), text_bytes(text).alias("text")).mapInArrow(invert, out)


def _batch(schema: pa.Schema, kind: str, block: int, n: int, given: dict[str, pa.Array]) -> pa.RecordBatch:
    given |= {"kind": pa.array([kind] * n), "block": pa.array([block] * n, pa.int64())}
    return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


def gain(t: Column, target_total: Column, s: Column, own_total: Column, buckets: int) -> Column:
    """1000 times the log ratio of a bucket's smoothed shares in the target and here, rounded down."""
    t, target_total, s, own_total = (c.cast("double") for c in (t, target_total, s, own_total))
    return F.floor(1000 * F.log((t + 1) * (own_total + buckets) / ((s + 1) * (target_total + buckets))))


def weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, shortest: int = 1, longest: int = 1, id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(block, place, id, n_words, n_features, weight) of each document; weight is the mean of its features' gains.

    The postings of both corpora meet by bucket: the totals of a bucket, summed up before, stand beside each part of its
    postings, which gives the gain there. The contributions then go to the document's block, where they are added up.
    """
    own = stored(postings(docs, buckets, shortest, longest, id, text), "postings", "kind")
    posted, rows = own().where(F.col("kind") == POSTING), own().where(F.col("kind") == DOCUMENT)
    aimed = postings(target.select(F.lit(None).cast("long").alias("id"), F.col(target_text).alias("text")), buckets, shortest, longest, "id").where(F.col("kind") == POSTING)
    sums = posted.groupBy("bucket").agg(F.sum("total").alias("s"))
    sums = cut_lineage(sums.join(aimed.groupBy("bucket").agg(F.sum("total").alias("t")), "bucket", "full").na.fill(0, ["s", "t"]))
    both = sums.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    gains = sums.withColumn("gain", gain(F.col("t"), F.lit(both.t), F.col("s"), F.lit(both.s), buckets)).select("bucket", "gain", F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1))).alias("part"))
    dealt = posted.withColumn("part", F.pmod("block", F.lit(SPLIT)).cast("int")).join(gains.hint("merge"), ["bucket", "part"])
    given = dealt.select("block", "places", F.transform("counts", lambda c: c * F.col("gain")).alias("gains"))
    kind = docs.schema[id].dataType
    out = f"block long, place int, id {kind.simpleString()}, n_words long, n_features long, weight long"

    def add_up(documents: pa.Table, contributions: pa.Table) -> pa.Table:
        total = np.zeros(documents.num_rows, np.int64)
        places, gains = (contributions.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("places", "gains"))
        documents = documents.sort_by("place")
        np.add.at(total, places, gains)
        n = documents.column("n_features").to_numpy()
        return documents.append_column("weight", pa.array(np.where(n > 0, total // np.maximum(n, 1), 0), pa.int64()))

    rows = rows.select("block", "place", "id", "n_words", "n_features")
    return rows.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(add_up, out)


def with_rank(scored: DataFrame, drawn: int, order: list[Column]) -> DataFrame:
    """scored, whose rows `order` puts in a total order, with rank: 1, 2, 3... for the first `drawn` rows, else null.

    The rows are sorted by range over the tasks and kept so; a row's rank is its place in its partition plus the rows of
    the partitions before, of which there are few.
    """
    kept = cut_lineage(scored.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    kept = kept.withColumn("_part", F.shiftright("_at", 33))
    sizes = {r._part: r.n for r in kept.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    starts = scored.sparkSession.createDataFrame(starts, "_part long, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return kept.join(F.broadcast(starts), "_part").withColumn("rank", F.when(rank <= drawn, rank)).drop("_at", "_part", "_before")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, shortest: int = 1, longest: int = 1, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank): the documents drawn towards the target corpus without replacement.

    Features are runs of `shortest` to `longest` words, put in buckets by CRC-32; a document's weight is the mean log ratio
    of its buckets' shares in the target and in docs, in thousandths. Of the documents with at least least_words words the
    `percent` of highest score get a rank; the score is the weight plus Gumbel noise that id and seed decide. Ties go to the
    smaller id, a null id last.

    Null and empty texts have no features and weigh 0; long texts are taken whole, a text beyond a block's size being a
    block. Repeated rows are documents each; those equal in id and score have ranks next to each other. An empty table gives
    none, an empty target leaves the gains to smoothing. Other columns are not carried.
    """
    weighed = weights(docs, target, buckets, shortest, longest, id, text, target_text)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = cut_lineage(weighed.withColumn("score", F.col("weight") + noise))
    may = scored.where(F.col("n_words") >= least_words)
    columns = ["id", "n_features", "weight", "score"]
    ranked = with_rank(may, may.count() * percent // 100, [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("block"), F.asc("place")])
    others = scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionByName(others).withColumnRenamed("id", id)
