"""Text expressions: author lists, tokens, term frequencies."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.columns import ColumnLike, as_column


def author_count(authors: ColumnLike = "authors", missing: int | None = None, clean: bool = False) -> Column:
    """Number of names in an author list.

    By default `` and `` counts as one more comma, so ``A, B, and C`` gives 4.
    ``clean`` reads an Oxford comma as one separator and ignores empty names.
    A NULL list gives ``missing`` (NULL unless set; -1 is what Spark 3 gave).
    """
    authors = as_column(authors)
    if clean:
        names = F.split(authors, r"\s*,\s*(?:and\s+)?|\s+and\s+")
        count = F.size(F.filter(names, lambda name: F.trim(name) != ""))
    else:
        count = F.size(F.split(F.replace(authors, F.lit(" and "), F.lit(",")), ","))
    otherwise = F.lit(missing).cast("int")
    return F.when(authors.isNull(), otherwise).otherwise(count)


def text_concat(title: ColumnLike = "title", abstract: ColumnLike = "abstract") -> Column:
    """Title and abstract as one text; never NULL, as NULL parts are skipped."""
    return F.concat_ws(" ", as_column(title), as_column(abstract))


def strip_parens(text: ColumnLike) -> Column:
    """Text without any run of round brackets at either end."""
    return F.btrim(as_column(text), F.lit("()"))


def tokens(text: ColumnLike = "text") -> Column:
    """Lower-case words: maximal runs of ASCII letters, digits and underscore."""
    return F.filter(F.split(F.lower(as_column(text)), r"\W"), lambda token: token != "")


def english_stop_words() -> list[str]:
    """Spark's own English stop-word list (needs a running session)."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def stop_words_removed(words: ColumnLike, stop_words: Sequence[str] | None = None) -> Column:
    stop_words = english_stop_words() if stop_words is None else list(stop_words)
    return F.filter(as_column(words), lambda word: ~F.lower(word).isin(stop_words))


def term_frequencies(words: ColumnLike) -> Column:
    """Distinct words of an array with their counts, as ``array<struct<term, tf>>``.

    Sorts the array and measures its runs, so each document is counted within
    its own row: no shuffle on (document, term) is needed, however long the
    document or frequent the term.
    """

    def count_runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return _bind(
            starts,
            lambda at: F.transform(
                at,
                lambda start, n: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(at, n + 1), F.size(ordered)) - start).alias("tf"),
                ),
            ),
        )

    words = as_column(words)
    return F.when(F.size(words) > 0, _bind(F.sort_array(words), count_runs))


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which may use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
