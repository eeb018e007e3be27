"""Small documents with every awkward case: nulls, empty and long texts, copies, repeated rows, clashing columns."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "n long, doc_id long, text string, lang string, source string, n_chars long, fp long, score double, quality string, _h string, _score string, cell int, size int, id string, taken int, rank int, h string, v int"


def odd_texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["an", "the", "ou", "re", "st", "ing", "ble", "é", "ß"]) for _ in range(rng.randint(1, 4)))
    body = [" ".join(word() for _ in range(rng.randint(3, 120))) + "." for _ in range(40)]
    long = " ".join(word() for _ in range(9000))
    texts = [None, "", "  \n\t ", "one", "One TWO", "a b c d e a b c d e a b c d e", "x\nx\nx\ny", "$$$ ### <b> | | | & & & a b c d e f g h", "so so so so so so so so so so so so", long, long + " more", "a" * 20000, "a\x85b c　d <|endoftext|> e", *body, *body[:10], *(b + " tail" for b in body[:10])]
    return list(enumerate(texts))


def with_odd_columns(docs):
    """docs with a map, an array of maps and a VARIANT beside its columns, which can't be hashed or compared."""
    return docs.withColumns({"m": F.create_map(F.lit("k"), F.col("doc_id")), "am": F.array(F.create_map(F.lit(1), F.lit("x"))), "va": F.parse_json(F.lit('{"a": [1, null]}'))})


def docs_frame(spark):
    rows = []
    for n, (i, text) in enumerate([*odd_texts(), *odd_texts()[5:9]]):
        rows.append((n, None if i == 7 else i, text, "en", None if i % 5 == 0 else f"s{i % 4 % 3}", None, 5, 0.5, "q", "hh", "s", 3, 4, "x", 1, 2, "h", 9))
    return with_odd_columns(spark.createDataFrame(rows, SCHEMA))


def empty_docs(spark):
    return with_odd_columns(spark.createDataFrame([], SCHEMA))
