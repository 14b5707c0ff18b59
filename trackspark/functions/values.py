"""Parsing of text fields and merging of parameter maps."""

from pyspark.sql import functions as F


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def whitespace_fields(line):
    """Fields separated by runs of blanks and tabs; leading and trailing ones are dropped."""
    text = F.btrim(_col(line), F.lit(" \t\r"))
    # Most lines hold single tabs only, which need no pattern matching.
    single_tabs = ~(text.contains(" ") | text.contains("\t\t"))
    return F.when(single_tabs, F.split(text, "\t")).otherwise(F.split(text, "[ \t]+"))


def tab_fields(line):
    line = _col(line)
    # Few lines end in a return; trimming a given character goes over the whole line.
    return F.split(F.when(line.endswith("\r"), F.rtrim(line, F.lit("\r"))).otherwise(line), "\t", -1)


def number(text, kind="bigint"):
    """The number in ``text``, or null where it holds none."""
    return _col(text).try_cast(kind)


def number_list(text, kind="bigint"):
    """Numbers of a comma-separated list, which may end in a comma."""
    text = F.regexp_replace(_col(text), r",\s*\z", "")
    return F.when(text == "", F.array().cast(f"array<{kind}>")).otherwise(
        F.transform(F.split(text, ","), lambda item: item.try_cast(kind))
    )


def joined_list(numbers):
    """A list in its text form: each number followed by a comma."""
    return F.array_join(F.transform(_col(numbers), lambda n: F.concat(n.cast("string"), F.lit(","))), "")


def json_map(text):
    """A JSON object as a map of strings, of repeated keys the last one; anything else is an empty map.

    This holds in every session, whatever its setting for repeated map keys.
    """
    parsed = F.from_json(_col(text), "map<string,string>")
    keys = F.map_keys(parsed)
    last = F.filter(
        F.map_entries(parsed), lambda entry, at: ~F.array_contains(F.slice(keys, at + 2, F.size(keys)), entry["key"])
    )
    single = F.when(F.size(F.array_distinct(keys)) == F.size(keys), parsed).otherwise(F.map_from_entries(last))
    return F.coalesce(single, F.create_map().cast("map<string,string>"))


def unreadable_json(text):
    """Whether ``text`` holds something, and that is no JSON object."""
    text = _col(text)
    return (F.trim(text) != "") & F.from_json(text, "map<string,string>").isNull()


def merge_maps(base, override):
    """Both maps in one; ``override`` wins where a key is in both."""
    base, override = _col(base), _col(override)
    kept = F.map_filter(base, lambda key, _: ~F.array_contains(F.map_keys(override), key))
    return F.map_concat(kept, override)
