"""Quality rules as weak supervision: rules vote good, bad or abstain on each document; how right they
are comes from expectation-maximisation over the votes of the table, without labels; a document is kept
when it passes the base rules and is more likely good than not.

Rules are sensitive: a single bad vote on a sound document is common, and rules that turn out to vote
alike on both classes weigh next to nothing. So a verdict is not that of all rules having to pass.

Only the pattern of votes enters the model, so the table is reduced to a count per pattern (3 to the
power of the number of rules at most, whatever the table's size) before anything reaches the driver,
and the posterior goes back as an expression over the votes. Documents that fail the base rules are not
learned from: their verdict is settled, and among them repetition would pass for quality.

Cases: a null or empty text has no words and fails the base rules; rules abstain on texts of fewer
than ten words; repeated rows are judged alike, each on its own; other columns are returned by
:func:`kept_documents` as they are. An empty table gives no rows; without votes, beliefs stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm.tables import pieces, stored, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: Base rules: fewest words, and the share of words in repeated windows, in hundredths.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: A document is kept with this posterior probability of being good, or more.
KEEP = 0.5

_MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_plain", "n_upper", "n_letters", "n_marks", "n_distinct", "n_ends", "n_digits",
)


class Rule(NamedTuple):
    """Votes good (1) where its ratio is within ``good``, bad (-1) outside ``fair``, and else abstains."""

    name: str
    ratio: str
    good: tuple[float, float]
    fair: tuple[float, float]


#: Words that a text needs for any rule to vote.
VOTED = 10
_ANY = 1e9
RULES = (
    Rule("plain", "n_plain / greatest(word_chars, 1)", (0.97, _ANY), (0.93, _ANY)),
    Rule("symbols", "n_symbols / n_words", (0, 0.02), (0, 0.10)),
    Rule("capitals", "n_upper / greatest(n_letters, 1)", (0.004, 0.10), (0.002, 0.30)),
    Rule("exclaims", "n_marks / n_words", (0, 0.02), (0, 0.10)),
    Rule("word_length", "word_chars / n_words", (4.5, 6.0), (4.2, 7.0)),
    Rule("ends", "n_ends / n_words", (0.05, 0.14), (0.03, 0.20)),
    Rule("repeats", "n_repeat_words / n_words", (0, 0.05), (0, 0.20)),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", (0, 0.05), (0, 0.30)),
    Rule("distinct", "n_distinct / n_words", (0.40, 1), (0.20, 1)),
    Rule("digits", "n_digits / greatest(word_chars, 1)", (0, 0.05), (0, 0.15)),
)


def _repeated(words: list[bytes]) -> tuple[int, int]:
    """Words in three-word windows that occur twice or more, and distinct words."""
    numbers: dict[bytes, int] = {}
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(words) < 4:
        return 0, len(numbers)
    pair = at[:-1] * len(numbers) + at[1:]
    if len(numbers) > 1 << 20:  # keeps the product below within 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(numbers) + at[2:]
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0, len(numbers)
    repeated = np.isin(window, twice)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(window)] |= repeated
    return int(covered.sum()), len(numbers)


_UPPER = np.zeros(256, bool)
_UPPER[range(ord("A"), ord("Z") + 1)] = True
_LOWER = np.zeros(256, bool)
_LOWER[range(ord("a"), ord("z") + 1)] = True
_STARTS = np.ones(256, bool)
_STARTS[0x80:0xC0] = False  # bytes within a code point
_PLAIN = _STARTS.copy()  # letters, digits and the marks of ordinary prose
_PLAIN[[b for b in range(128) if not chr(b).isalnum() and chr(b) not in ".,;:?'\"()-"]] = False


def measures(text: bytes) -> tuple[int, ...]:
    """The numbers that rules are made of, in the order of the table's columns."""
    words = text.split()
    repeated, distinct = _repeated(words)
    full = [line for line in text.split(b"\n") if line.strip(SPACES)]
    found = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return (
        len(words),
        int(found[_STARTS].sum() - found[list(SPACES)].sum()),
        int(found[list(SYMBOLS)].sum()),
        len(full) - len(set(full)),
        repeated,
        len(full),
        int(found[_PLAIN].sum()),
        int(found[_UPPER].sum()),
        int(found[_UPPER].sum() + found[_LOWER].sum()),
        int(found[ord("!")]),
        distinct,
        int(found[list(b".?")].sum()),
        int(found[list(b"0123456789")].sum()),
    )


def measured(docs: DataFrame) -> DataFrame:
    """``row``, with the columns of the input, and the measures of each whole text."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    at = docs.columns.index("text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays(
                [batch.column("row").field(at), pa.array(range(batch.num_rows))], ["text", "at"]
            )
            for piece in pieces([texts]):
                values = np.array([measures(t) for t in utf8(piece.column("text"))], np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(piece.column("at")[0].as_py(), piece.num_rows),
                        *map(pa.array, values),
                    ],
                    ["row", *_MEASURES],
                )

    schema = T.StructType(
        [T.StructField("row", rows.schema["row"].dataType)]
        + [T.StructField(m, T.LongType()) for m in _MEASURES]
    )
    return rows.mapInArrow(made, schema)


def vote(rule: Rule) -> Column:
    """1 for good, -1 for bad, 0 for neither."""
    ratio = F.expr(rule.ratio.replace("/ n_words", "/ greatest(n_words, 1)"))
    votes = F.when(ratio.between(*rule.good), 1).when(~ratio.between(*rule.fair), -1).otherwise(0)
    return F.when(F.col("n_words") >= VOTED, votes).otherwise(0).cast("byte")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


class Model(NamedTuple):
    """Share of good documents, and for each rule how often its votes are right on each class."""

    share: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def weights(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Log odds without votes, and what a good and a bad vote of each rule add to them."""
        return (
            float(np.log(self.share / (1 - self.share))),
            np.log(self.on_good / (1 - self.on_bad)),
            np.log((1 - self.on_good) / self.on_bad),
        )


#: Believed before the votes are seen: a good document draws a bad vote from one rule in twenty, a bad one
#: from three in ten. The belief is worth this share of the documents that a rule votes on.
BELIEF, WORTH = Model(0.7, 0.95, 0.3), 0.02


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 1000) -> Model:
    """Accuracies and class share by expectation-maximisation over vote patterns and their counts.

    Votes are independent given the class, abstaining says nothing. A rule's accuracy on a class is the
    share of its votes, over documents weighed by their probability of the class, that name this class.
    """
    good, bad = votes == 1, votes == -1
    cast = good | bad
    prior = WORTH * (counts @ cast) + 1
    whole = WORTH * counts.sum() + 1
    model = Model(BELIEF.share, *(np.full(votes.shape[1], b) for b in BELIEF[1:]))
    for _ in range(rounds):
        base, for_good, for_bad = model.weights()
        belongs = 1 / (1 + np.exp(-(base + good @ for_good + bad @ for_bad)))
        as_good, as_bad = counts * belongs, counts * (1 - belongs)
        new = Model(
            float(np.clip((as_good.sum() + BELIEF.share * whole) / (counts.sum() + whole), 0.001, 0.999)),
            np.clip((as_good @ good + BELIEF.on_good * prior) / (as_good @ cast + prior), 0.001, 0.999),
            np.clip((as_bad @ bad + BELIEF.on_bad * prior) / (as_bad @ cast + prior), 0.001, 0.999),
        )
        moved = max(np.abs(a - b).max(initial=0) for a, b in zip(map(np.atleast_1d, new), model))
        model = new
        if moved < 1e-10:
            break
    return model


def learned(votes: DataFrame) -> Model:
    """The model of a table with measures and a vote column for each rule."""
    names = [f"vote_{r.name}" for r in RULES]
    counts = votes.where(~base_failed()).groupBy(*names).count()
    rows = sorted(map(tuple, counts.collect()))  # 3 ** 10 rows at most
    patterns = np.array([r[:-1] for r in rows], np.int8).reshape(len(rows), len(RULES))
    return fit(patterns, np.array([r[-1] for r in rows], np.float64))


def probability(model: Model) -> Column:
    """Posterior probability that a document is good, from its votes."""
    base, for_good, for_bad = model.weights()
    terms = [
        F.when(F.col(f"vote_{rule.name}") == 1, float(g))
        .when(F.col(f"vote_{rule.name}") == -1, float(b))
        .otherwise(0.0)
        for rule, g, b in zip(RULES, for_good, for_bad)
    ]
    return 1 / (1 + F.exp(-reduce(add, terms, F.lit(base))))


def _voted(docs: DataFrame) -> DataFrame:
    return measured(docs).withColumns({f"vote_{r.name}": vote(r) for r in RULES})


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, measures, votes, ``base_failed``, ``probability`` and ``kept`` of each document.

    Texts are read once; their measures, a few numbers a document, are stored for the verdicts.
    """
    votes = _voted(docs.select(F.col("doc_id").cast("long"), "text"))
    rows = stored(votes.select("row.doc_id", *votes.columns[1:]), "measures")
    model = learned(rows)
    return (
        rows.withColumn("base_failed", base_failed())
        .withColumn("probability", probability(model))
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= KEEP))
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns and rows of the input.

    Texts are read twice, once for the votes' counts and once for the verdicts, and not shuffled.
    """
    model = learned(_voted(docs.select("text")))
    good = ~base_failed() & (probability(model) >= KEEP)
    return _voted(docs).where(good).select("row.*")
