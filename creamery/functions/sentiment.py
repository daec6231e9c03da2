"""Audit-note classification: Positive / Neutral / Negative plus a root cause.

The default scorer is a list of case-insensitive phrase rules compiled into one
``CASE WHEN text RLIKE ...`` chain: JVM-side, codegen, no Python, and every
rule scans the whole note. A user model can be plugged in instead through
:func:`model_scorer`, which runs as an Arrow-batched iterator pandas UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SENTIMENT_STRUCT = "struct<sentiment:string,root_cause:string>"


@dataclass(frozen=True)
class Rule:
    pattern: str  # Java regex, matched case-insensitively anywhere in the note
    sentiment: str
    root_cause: str | None = None


# Phrases of the audit-note vocabulary and their classification.
# The first matching rule wins; a note that matches none is Neutral.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("below tolerance", "Negative", "Volume"),
    Rule("exceeded limit", "Negative", "Microbial"),
    Rule("defect detected", "Negative", "Packaging"),
    Rule("within spec", "Positive"),
    Rule("passed, standard", "Positive"),
    Rule("nominal", "Positive"),
)
NEUTRAL = "Neutral"

# The instruction put in front of every note for a language model.
PROMPT_TEXT = (
    "Classify the sentiment of this quality audit note as Positive, "
    "Neutral, or Negative, and give a one-word root cause category "
    "if negative. Note: "
)


def with_prompt(text: Column, prompt: str = PROMPT_TEXT) -> Column:
    """``concat(prompt, note)``; a NULL note gives a NULL prompt (nothing to ask)."""
    return F.concat(F.lit(prompt), text)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rules_scorer(rules: Sequence[Rule] = DEFAULT_RULES) -> Callable[[Column], Column]:
    """Scorer built from phrase rules; NULL text gives a NULL result."""

    def score(text: Column) -> Column:
        chain = None
        for rule in rules:
            hit = text.rlike("(?i)" + rule.pattern)
            value = F.struct(
                F.lit(rule.sentiment).alias("sentiment"),
                F.lit(rule.root_cause).cast("string").alias("root_cause"),
            )
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
        neutral = F.struct(F.lit(NEUTRAL).alias("sentiment"), F.lit(None).cast("string").alias("root_cause"))
        body = neutral if chain is None else chain.otherwise(neutral)
        return F.when(text.isNotNull(), body)

    return score


ANSWER_STRUCT = "struct<answer:string,error:string>"
SCORED_STRUCT = "struct<sentiment:string,root_cause:string,error:string>"


def _isolated(model: Callable[[list[str]], Iterable], notes: list[str], retries: int) -> list[tuple[object, str | None]]:
    """(answer, error) of each note: a batch that fails is halved until the failing notes stand alone.

    A note alone is asked ``retries`` times more before its error counts.
    """
    try:
        found = list(model(notes))
        if len(found) != len(notes):
            raise ValueError(f"{len(found)} answers to {len(notes)} notes")
        return [(x, None) for x in found]
    except Exception as exc:  # any failure of a user's model is that note's own
        if len(notes) > 1:
            half = len(notes) // 2
            return _isolated(model, notes[:half], retries) + _isolated(model, notes[half:], retries)
        if retries > 0:
            return _isolated(model, notes, retries - 1)
        return [(None, f"{type(exc).__name__}: {exc}"[:500])]


def model_scorer(
    predict: Callable[[list[str]], Iterable] | None = None,
    prompt: str | None = None,
    load: Callable[[], Callable[[list[str]], Iterable]] | None = None,
    text: bool = False,
    isolate: bool = False,
    retries: int = 0,
) -> Callable[[Column], Column]:
    """Wrap a batch predictor ``list[str] -> [(sentiment, root_cause), ...]``.

    The predictor sees one Arrow batch at a time (``spark.sql.execution.arrow.
    maxRecordsPerBatch`` rows), never single rows. ``load`` builds the
    predictor once per task, before its first batch (for models that are
    costly to load). With ``text`` the predictor answers in free text, one
    string per note. NULL notes are not passed to it. With ``prompt`` (e.g.
    :data:`PROMPT_TEXT`) each note is prefixed in the JVM before it is shipped
    to Python.

    Without ``isolate`` a failing predictor fails the job. With it, the
    result also has a field ``error``: a failing batch is halved until the
    notes that fail stand alone (asked ``retries`` times more); these get
    the error and no answer, all others their answer.
    """
    if (predict is None) == (load is None):
        raise ValueError("give either predict or load")

    def answers(batches: Iterator[pd.Series]) -> Iterator[tuple[list, list]]:
        model = load() if load is not None else predict
        for notes in batches:
            mask = notes.notna()
            asked = notes[mask].tolist()
            if isolate:
                found = iter(_isolated(model, asked, retries) if asked else ())
            else:
                found = ((x, None) for x in (model(asked) if asked else ()))
            told = [next(found) if m else (None, None) for m in mask]
            yield [t[0] for t in told], [t[1] for t in told]

    def frame(columns: dict) -> pd.DataFrame:
        return pd.DataFrame(columns, dtype=object)

    @F.pandas_udf("string")
    def _say(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for out, _ in answers(batches):
            yield pd.Series(out, dtype=object)

    @F.pandas_udf(ANSWER_STRUCT)
    def _say_or_fail(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for out, errors in answers(batches):
            yield frame({"answer": out, "error": errors})

    @F.pandas_udf(SENTIMENT_STRUCT)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for out, _ in answers(batches):
            pairs = [a or (None, None) for a in out]
            yield frame({"sentiment": [a[0] for a in pairs], "root_cause": [a[1] for a in pairs]})

    @F.pandas_udf(SCORED_STRUCT)
    def _score_or_fail(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for out, errors in answers(batches):
            pairs = [a or (None, None) for a in out]
            yield frame({"sentiment": [a[0] for a in pairs], "root_cause": [a[1] for a in pairs], "error": errors})

    ask = (_say_or_fail if text else _score_or_fail) if isolate else (_say if text else _score)

    def score(notes: Column) -> Column:
        return ask(with_prompt(notes, prompt) if prompt is not None else notes)

    return score


def llm_analysis(result: Column) -> Column:
    """The free-text answer column: ``"<sentiment>"`` or ``"<sentiment>: <cause>"``."""
    sentiment = result.getField("sentiment")
    return F.when(sentiment.isNotNull(), F.concat_ws(": ", sentiment, result.getField("root_cause")))


def parse_answer(answer: Column) -> Column:
    """Label and root cause named in a free-text answer: the first label word, and the word after it."""
    found = r"(?i)\b(positive|neutral|negative)\b"
    label = F.initcap(F.nullif(F.regexp_extract(answer, found, 1), F.lit("")))
    cause = F.nullif(F.regexp_extract(answer, found + r"\W+(\w+)", 2), F.lit(""))
    return F.struct(label.alias("sentiment"), F.when(label == "Negative", cause).alias("root_cause"))


def with_sentiment(df, text_col: str, scorer: Callable[[Column], Column] | None = None):
    """Add ``llm_analysis``, ``sentiment``, ``root_cause`` and ``scoring_error`` for ``text_col``.

    A scorer that answers in text has its answer stored verbatim in
    ``llm_analysis``; label and cause are read from it. ``scoring_error`` is
    NULL for scorers that do not report errors per row.
    """
    scorer = scorer or rules_scorer()
    tmp = "__creamery_sentiment"
    scored = df.withColumn(tmp, scorer(_c(text_col)))
    kind = scored.schema[tmp].dataType
    fields = set(getattr(kind, "names", ()))
    answer = F.col(tmp).getField("answer") if "answer" in fields else F.col(tmp)
    as_text = "answer" in fields or kind.simpleString() == "string"
    result = parse_answer(answer) if as_text else F.col(tmp)
    return scored.withColumns(
        {
            "llm_analysis": answer if as_text else llm_analysis(result),
            "sentiment": result.getField("sentiment"),
            "root_cause": result.getField("root_cause"),
            "scoring_error": F.col(tmp).getField("error") if "error" in fields else F.lit(None).cast("string"),
        }
    ).drop(tmp)
