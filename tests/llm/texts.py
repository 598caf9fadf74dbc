"""Small corpora with the awkward cases every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, k long, anchor string, `_row` int"
VOCABULARY = [f"w{i}" for i in range(400)]


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choices(VOCABULARY, k=n))


def corpus(seed: int = 0) -> list[tuple[int | None, str | None]]:
    """Nulls, empty texts, exact and near copies, repeated rows, tied texts, non-ASCII, and one long text."""
    rng = random.Random(seed)
    base = [words(rng, rng.randint(20, 90)) for _ in range(12)]
    rows: list[tuple[int | None, str | None]] = list(enumerate(base))
    rows += [(100, base[0]), (101, base[0]), (101, base[0]), (102, base[1].upper()), (103, base[2].replace(" ", "  ")), (104, base[3] + " extra"), (105, " ".join(base[4].split()[1:]))]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "ONE"), (205, "é ü 漢字 \x00 end"), (206, "a" * 1500), (207, base[5] + "\n" + base[6]), (208, words(rng, 4000))]
    rows += [(None, base[7]), (None, None), (209, "<|endoftext|> and </s>[INST]")]
    return rows


def frame(spark, rows):
    """The rows as documents, with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", None, 0.5, 7, "x", 1) for i, t in rows], SCHEMA)


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
