from __future__ import annotations

import pytest

LONG = " ".join(f"long{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def documents(spark):
    """`documents((id, text), ...)` or with (id, text, source); columns clash with result names."""

    def make(*rows):
        full = [(*row, "s")[:3] for row in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, source string")
        return df.selectExpr(
            "doc_id", "text", "source", "'en' AS lang", "length(text) AS n_chars", "7 AS n_words", "'x' AS kept",
            "0.5D AS rate", "'y' AS class_id", "3 AS shard", "1 AS size", "'z' AS `a b`",
        )

    return make


def prose(seed: int, n: int) -> list[str]:
    """Different words, the same for the same seed."""
    return [f"w{(seed * 7919 + i * 104_729) % 1_000_003}" for i in range(n)]
