"""A toxicity classifier that is trained to give the same score when identity terms are swapped."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import cut_lineage, rows_of, text_bytes, values_of

#: Identity terms by kind; a term is swapped for the next one of its kind and language.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "natives", "refugees"),
    ("disabled", "blind", "deaf"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("ausländer", "deutsche"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)
SWAP = {term: terms[(i + 1) % len(terms)] for terms in IDENTITY_TERMS for i, term in enumerate(terms)}
IDENTITY = regex.compile(r"(?<![^\W_])(?:" + "|".join(sorted(map(regex.escape, SWAP), key=len, reverse=True)) + r")(?![^\W_])")
EDGES = regex.compile(r"^[\W_]+|[\W_]+$")
GRAMS = (4, 5, 6)
#: Tokens whose features a worker remembers: of chosen features, of which most tokens have none, and of all.
TOKENS_KEPT, WHOLE_TOKENS_KEPT = 400_000, 20_000
#: Longer tokens are taken apart each time.
LONGEST_KEPT = 64


def swap_identity(text: str) -> str:
    """The text, in lower case, with each identity term exchanged for the next of its kind."""
    return IDENTITY.sub(lambda m: SWAP[m[0]], text.lower())


def token_features(token: str) -> Iterator[str]:
    """Features of a lower-case token: itself and the character n-grams of all of it, with its edges marked; some come again."""
    word = EDGES.sub("", token)
    if word:
        marked = f"^{word}$"
        yield marked
        for n in GRAMS:
            for i in range(len(marked) - n + 1):
                yield marked[i : i + n]


class FeatureCache(dict):
    """Features of tokens that have been seen; of those in `chosen` if given (feature to column), as columns."""

    def __init__(self, chosen: dict[str, int] | None = None):
        super().__init__()
        self.chosen, self.size = chosen, WHOLE_TOKENS_KEPT if chosen is None else TOKENS_KEPT

    def __missing__(self, token: str) -> tuple:
        found = token_features(token)
        out = tuple(set(found) if self.chosen is None else {self.chosen[f] for f in found if f in self.chosen})
        if len(token) > LONGEST_KEPT:
            return out
        if len(self) >= self.size:
            self.clear()
        self[token] = out
        return out

    def of_text(self, text: str) -> list:
        """Distinct features of a text in lower case, sorted."""
        return sorted({f for token in set(text.split()) if (own := self[token]) for f in own})


@dataclass(frozen=True)
class Model:
    """Features with their weights, and the bias, of a logistic regression on which features a text holds."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float


def held_out(id: str) -> Column:
    """Rows that training never sees: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(text, label) of at most max_rows labelled documents that aren't held out: those with the least hash of their id.

    A document with several labels counts as toxic if one says so; labels that are null are left out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).select(F.col(id).alias("k"), F.col(label).cast("int").alias("label")).where(~held_out("k"))
    known = known.groupBy("k").agg(F.max("label").alias("label")).orderBy(F.xxhash64("k"), "k").limit(max_rows)
    own = docs.select(F.col(id).alias("k"), text_bytes(text).alias("text"))
    return own.join(F.broadcast(known), "k").select("text", "label")  # at most max_rows rows of two numbers


def _feature_counts(rows: DataFrame, most_held: int = 1 << 18) -> DataFrame:
    """(feature, toxic, other): in how many texts of either label each feature occurs. A task's counts go on when it holds
    over most_held of them, and are added up in Spark."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, counts = FeatureCache(), (Counter(), Counter())

        def found() -> pa.RecordBatch:
            features = list(counts[0] | counts[1])
            out = pa.RecordBatch.from_arrays([pa.array(features, pa.string()), *(pa.array([counts[label][f] for f in features], pa.int64()) for label in (1, 0))], schema=schema)
            for c in counts:
                c.clear()
            return out

        for text, label in rows_of(batches):
            counts[label == 1].update(cache.of_text(text.decode("utf-8", "replace").lower()))
            if len(counts[0]) + len(counts[1]) > most_held:
                yield found()
        yield found()

    return rows.select("text", "label").mapInArrow(count, "feature string, toxic long, other long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def choose_features(rows: DataFrame, most: int, support: float = 0.005, lift: float = 8.0) -> tuple[str, ...]:
    """The `most` features that mark toxic texts best: in at least this share of them, and this many times as often as in
    others. They are counted and ranked in Spark, by the number of toxic texts times the logarithm of the odds."""
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not other:
        return ()
    held = _feature_counts(rows).where(F.col("toxic") >= max(3, support * toxic))
    odds = (F.col("toxic") / toxic) / ((F.col("other") + 1) / (other + 1))
    best = held.withColumn("odds", odds).where(F.col("odds") >= lift).orderBy((F.col("toxic") * F.log("odds")).desc(), "feature").limit(most)
    return tuple(sorted(r.feature for r in best.select("feature").collect()))


def fit(rows: DataFrame, most_features: int = 2048, swap_penalty: float = 2.0, ridge: float = 1e-5, steps: int = 600) -> Model:
    """Logistic regression on `rows` (text, label), which are few enough for the driver once only chosen features are kept.

    The loss is the mean log loss, plus ridge times the squared weights, plus swap_penalty times the mean squared change
    of the logit when the identity terms of a training text that has any are swapped. Weights are never negative: a text
    doesn't get better by what it has besides. Without texts of both labels the model is a constant.
    """
    features = choose_features(rows, most_features)
    chosen = {f: i for i, f in enumerate(features)}

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = FeatureCache(chosen)
        own, swapped, label = [], [], []
        for raw, y in rows_of(batches):
            text = raw.decode("utf-8", "replace").lower()
            own.append(cache.of_text(text))
            swapped.append(cache.of_text(swap_identity(text)) if IDENTITY.search(text) else None)
            label.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.int32())), pa.array(label, pa.int32())], ["own", "swapped", "label"])

    found = rows.select("text", "label").mapInArrow(lists, "own array<int>, swapped array<int>, label int").groupBy("own", "swapped", "label").agg(F.count("*").alias("n")).orderBy("own", "swapped", "label").collect()
    n = np.array([r.n for r in found], float)
    y = np.array([r.label for r in found], float)
    if not len(n) or not 0 < (n @ y) < n.sum():
        rate = (n @ y + 0.5) / (n.sum() + 1) if len(n) else 0.0
        return Model((), (), float(np.log(max(rate, 1e-6) / (1 - rate))) if len(n) else -20.0)

    def sparse(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.fromiter((f for t in texts for f in t), np.int64)

    row, column = sparse([r.own for r in found])
    pairs = [r for r in found if r.swapped is not None and r.swapped != r.own]
    weight_of_pair = np.array([r.n for r in pairs], float)
    plus, minus = sparse([r.own for r in pairs]), sparse([r.swapped for r in pairs])
    w, bias, mean, square = np.zeros(len(features) + 1), -2.0, 0.0, 0.0
    for step in range(1, steps + 1):  # Adam
        z = np.bincount(row, w[column], len(found)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        error = (p - y) * n / n.sum()
        gradient = np.bincount(column, error[row], len(w)) + 2 * ridge * w
        if pairs:
            change = (np.bincount(plus[0], w[plus[1]], len(pairs)) - np.bincount(minus[0], w[minus[1]], len(pairs))) * weight_of_pair / weight_of_pair.sum()
            gradient += 2 * swap_penalty * (np.bincount(plus[1], change[plus[0]], len(w)) - np.bincount(minus[1], change[minus[0]], len(w)))
        gradient[-1] = error.sum()
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        bias -= move[-1]
        w = np.maximum(0, w - move)
        w[-1] = 0
    return Model(features, tuple(w[:-1].tolist()), float(bias))


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with the model's probability that the whole text is toxic. A null or empty text has no features.

    Only the text is looked at, all of it however long. Repeated rows each get their score, equal texts an equal one; an
    input column called `name` is replaced; other columns pass through. An empty table gives none.
    """
    chosen = {f: i for i, (f, w) in enumerate(zip(model.features, model.weights, strict=True)) if w > 0}
    weights, bias = np.array(model.weights), model.bias

    def batches(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = FeatureCache(chosen)
        for column in columns:
            z = [bias + weights[own].sum() if (own := cache.of_text(t.decode("utf-8", "replace").lower())) else bias for t in values_of(column)]
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30))))

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from batches(columns)

    score.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(name, F.arrow_udf(score, "double")(text_bytes(text)))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id: str = "doc_id", text: str = "text", **settings) -> Model:
    """The model fitted on at most max_rows labelled documents, none of them held out; each different text counts once."""
    rows = cut_lineage(training_rows(docs, labels, max_rows, id, text).groupBy("text").agg(F.max("label").alias("label")))
    return fit(rows, **settings)
