"""What several operators of this subpackage share."""

from pyspark.sql import functions as F

from ..operators.lookup import fits_broadcast
from ..operators.scratch import land

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words of letters and digits, once in lower case

__all__ = ["MARKS", "SPACES", "ascii_lower", "keyed_join", "land", "let", "others", "read_table", "split_words", "text_key", "word_count"]


def read_table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df, *results):
    """The columns of ``df`` apart from those that a result replaces."""
    return [c for c in df.columns if c.lower() not in results]


def ascii_lower(text):
    """``text`` with A-Z, and only these, in lower case.

    ``lower`` gives the same on pure ASCII and is much faster there.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def let(value, use):
    """``use(value)``, with ``value`` computed once per row.

    A column that a lambda refers to may be folded into the lambda by the optimizer, and is then computed anew
    for every element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), use), 0)


def split_words(text, separators):
    """The words of ``text`` between ``separators``; none for null.

    Splitting reads a text once; ``regexp_extract_all`` and ``regexp_count`` copy it for every match.
    """
    return F.coalesce(F.array_remove(F.split(text, separators, -1), ""), F.array().cast("array<string>"))


def word_count(text):
    """Number of words between ASCII white space; 0 for null."""
    return F.size(split_words(text, SPACES)).cast("long")


def text_key(text):
    """A 128-bit key of a text, null for null. Rows of equal text share one key, and so one computation."""
    return F.unhex(F.md5(text.cast("binary")))


def keyed_join(left, right, on, how="left", measured=True):
    """Join on the columns ``on``, null matching null; ``right`` is broadcast only if it was measured as small.

    Beyond that both sides are shuffled, and adaptive execution splits hot keys of ``left``. A ``right`` that has a row
    for most of ``left`` is not worth measuring: with ``measured`` false both sides are shuffled at every size, so that the
    plan, and what it writes for a row, is the same on small tables and on large ones.
    """
    small = measured and fits_broadcast(right, max_rows=200_000, max_bytes=16 << 20)
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    renamed = F.broadcast(renamed) if small else renamed if measured else renamed.hint("merge")
    condition = None
    for c in on:
        same = left[c].eqNullSafe(renamed[f"_r_{c}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*(f"_r_{c}" for c in on))
