"""Small documents that hold every awkward case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row int, score string"

EN = "the and that with from this have which their there about would other people".split()
DE = "der und die mit von nicht eine auch werden haben über nach zwischen schon".split()


def words(pool, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(pool) + rng.choice(["", "", "er", "ing", "lich"]) for _ in range(n))


def texts():
    base = words(EN, 60, 1).split()
    near = base[:]
    near[5] = "changedword"
    return [
        None, "", "   ", "!!! 123", "one", "One  two", "one\ttwo ", " ".join(base),
        "  ".join(base), " ".join(near), " ".join(base).upper(), words(DE, 80, 2),
        words(EN, 40, 3) + " " + words(DE, 40, 4), words(EN, 30_000, 5), "a\nb\r\nc\x0bd", "日本語 テスト",
        "x" * 50_000, " ".join(base),
    ]


def rows():
    """Awkward rows: a repeated row, a null id, null metadata, clashing extra columns."""
    out = [(i * 3, t, "de" if i in (11,) else "en", f"s{i % 3}", len(t or ""), "k", i, "s")
           for i, t in enumerate(texts())]
    out.append(out[7])
    out.append((None, "the only row without an id", None, None, None, None, None, None))
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
