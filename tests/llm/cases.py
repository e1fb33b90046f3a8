"""Small tables with the cases that every operator must stand."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

#: Column names that operators use inside are taken by the input.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _key string, _id string, score string, "
          "label string, spans string")


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    return spark.createDataFrame(
        [(d, t, "en", "src0", None if t is None else len(t), "k", None, "s", "l", "x") for d, t in rows], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts(seed: int, n: int = 40, vocabulary: int = 60, chunks: int = 12) -> list[tuple[int | None, str | None]]:
    """Random texts that share chunks, with copies, a null, empty ones, white space only, and odd characters."""
    rng = random.Random(seed)
    lexicon = [f"w{i}" for i in range(vocabulary)] + ["é", "日本", "Ünïcode", "don't", "x" * 50]
    shared = [" ".join(rng.choices(lexicon, k=rng.randint(5, 60))) for _ in range(chunks)]
    out: list[tuple[int | None, str | None]] = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices(lexicon, k=rng.randint(1, 40))))
        out.append((i * 3, rng.choice([" ", "\n", "\t "]).join(parts)))
    out += [(1000, out[0][1]), (1001, out[0][1]), (500, None), (501, ""), (502, " \n\t "), (503, "one"),
            (504, " ".join(["again"] * 300)), (505, " ".join(["again", "and"] * 150))]
    rng.shuffle(out)
    return out
