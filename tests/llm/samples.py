"""Small document tables with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int = 60, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    out = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(vocabulary)]
    lines, line = [], []
    for _ in range(words):
        line.append(draw.choice(out).capitalize() if not line else draw.choice(out))
        if draw.random() < 0.1:
            lines.append(" ".join(line) + ".")
            line = []
    return "\n".join([*lines, " ".join(line)])


def rows(clean: int = 30) -> list[tuple]:
    """Clean texts, copies, near copies, a null and blank texts, a repeated row, null ids, a very long text, other scripts."""
    out = [(i, prose(i), "en", f"s{i % 3}", 0) for i in range(clean)]
    base = prose(3, 300)
    out += [(1000 + i, base + f"\nEnding{i}", "en", "s0", 0) for i in range(6)]
    out += [(2000, base, "en", "s1", 0), (2001, base, "de", "s2", 0), (2001, base, "de", "s2", 0)]
    out += [(3000, None, "en", "s0", None), (3001, "", None, None, 0), (3002, " \n\t ", "en", "s1", 4)]
    out += [(None, "Nameless text of a few words", "en", "s1", 0), (None, None, None, None, None)]
    out += [(4000, "Ünïcode 日本語 🎉 текст\x1c\x85 <|endoftext|> end\r\n\r\n  x", "xx", "s2", 0)]
    out += [(5000, prose(5, 30_000, 5_000), "en", "s0", 0)]
    return out


def table(spark, data=None, clash: bool = False):
    """The rows as documents; with ``clash`` with columns named like those that operators make."""
    docs = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if clash:
        for name in ("row", "bits", "words", "ids", "shard", "line", "key", "tokens", "epoch", "score", "part", "_id", "component_id", "kept"):
            docs = docs.selectExpr("*", f"'other' AS {name}")
    return docs
