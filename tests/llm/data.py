"""Small inputs with the cases that every operator must stand."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _id long, size string"


def words(rng: random.Random, n: int) -> str:
    syl = ["an", "the", "or", "tion", "st", "le", "qu", "ing", "er", "ha"]
    return " ".join("".join(rng.choice(syl) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_documents(seed: int = 3, n: int = 60) -> list[tuple]:
    """Documents with nulls, empties, copies, near copies, a repeated row, a long text and clashing columns."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " ", "a", "a b", "A B", "\n\t", "é" * 120, "x" * 5000, words(rng, 4000)]
    base = words(rng, 120)
    for k in range(6):
        w = base.split(" ")
        w[10 * k] = f"changed{k}"
        texts.append(" ".join(w))
    texts += [base, base, base + " " + base]
    while len(texts) < n:
        texts.append(words(rng, rng.randint(1, 150)))
    rows = [(i, t, "en", ["s1", "s2", None, "S0"][i % 4] if i % 5 else "s1", len(t or ""), 1.0, 7, "z")
            for i, t in enumerate(texts)]
    rows.append((None, base, None, None, None, None, None, None))  # no id
    rows.append((None, None, None, None, None, None, None, None))
    rows.append(rows[20])  # a repeated row
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_documents() if rows is None else rows, DOC_SCHEMA)


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
