"""Tables to files.  Every sink is one committed Spark write."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docloom.operators import stats


def write_metadata_csv(documents: DataFrame, path: str) -> None:
    """All fields but the text, by document."""
    stats.metadata_table(documents).write.mode("overwrite").csv(path, header=True)


def write_errors_csv(documents: DataFrame, path: str) -> None:
    stats.error_rows(documents).write.mode("overwrite").csv(path, header=True)


def write_chunking_errors_csv(errors: DataFrame, path: str) -> None:
    """(doc_id, error) of the documents that could not be cut, by document."""
    errors.select("doc_id", "error").orderBy("doc_id").write.mode("overwrite").csv(path, header=True)


def write_summary(documents: DataFrame, path: str) -> None:
    """The summary as one JSON line."""
    stats.summary_record(documents).write.mode("overwrite").text(path)


def write_answers(answers: DataFrame, path: str) -> None:
    """One nested JSON line per query."""
    answers.write.mode("overwrite").json(path)
