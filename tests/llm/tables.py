"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"

#: Columns that operators use for themselves, under names that a table may have too.
EXTRA = (
    "n_words", "kept", "row", "tie", "bucket", "removed", "size", "taken", "payload", "node", "words",
    "score", "token", "lines", "class", "range", "copies", "spans", "ids", "uid", "probability",
)

PROSE = (
    "the river ran slowly past the old mill and the children who lived there threw stones into it "
    "until the evening came and their mothers called them home across the dark fields where nothing "
    "moved except the wind and a dog that barked at every cloud that crossed the moon that night"
)

#: Null and empty texts, white space alone, a long text, a long word, ties, repeated and odd rows.
CASES = [
    (1, PROSE, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b\x0c\r ", "en", "b"),
    (5, PROSE, "en", "a"),
    (5, PROSE, "en", "a"),
    (6, "one two", "en", "b"),
    (7, "x" * 70_000, "en", "c"),
    (8, " ".join(f"w{k % 977}" for k in range(20_000)), "en", "c"),
    (9, "a  b\n\na  b\né ▁ 😀   <|endoftext|> </s>\r\nEND", "fr", "b"),
    (None, PROSE + " and more", "en", "a"),
    (None, None, None, None),
    (10, "\n".join(["the same line is here again and again, ten words"] * 40), "en", "d"),
]


def cases(spark, rows=CASES):
    """The rows as documents, with columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(*r, len(r[1]) if r[1] else 0) for r in rows]
    docs = spark.createDataFrame(full, schema).repartition(3)
    return docs.selectExpr("*", *[f"'{name}' as `{name}`" for name in EXTRA])


def small(columns="doc_id, text", table="documents"):
    path = Path(SMALL, f"{table}.parquet")
    return duckdb.sql(f"select {columns} from '{path}' order by 1").fetchall()


def connection():
    found = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        found.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return found


def pairs(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)
