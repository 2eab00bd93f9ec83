"""Small tables with the awkward rows: nulls, empty and long texts, repeated rows, ties, extra columns."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, u string"

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(6000))
PLAIN = " ".join(f"alpha{i} beta{i}" for i in range(40))


def document_rows() -> list[tuple]:
    def row(i, text, lang="en", source="a"):
        return (i, text, lang, source, None if text is None else len(text), "clash", "clash", "clash")

    near = PLAIN.split()
    near[3] = "changed"
    return [
        row(1, PLAIN), row(2, PLAIN, source="b"), row(3, " ".join(near), source="b"), row(4, None, None, None), row(5, ""),
        row(6, " \t\n"), row(7, "One two"), row(8, "ONE TWO", source=None), row(9, LONG), row(10, LONG + " tail", source="c"),
        row(11, "mail a.b@c.example.org or 10.0.0.7, +1 (555) 010-2020; card 4111 1111 1111 1111, not 4111111111111112 or 300.1.1.1"),
        row(12, "x" * 50_000), row(12, "x" * 50_000), row(None, "no id here"), row(13, "ÄÖ 😀 d@e.de 😀 1.2.3.4"),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(document_rows() if rows is None else rows, SCHEMA)


def as_table(frame, path: str):
    """The frame as it is read from files."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)
