"""GFF3 attributes and exon frames as column expressions."""

from pyspark.sql import functions as F


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def without_attribute(attributes, key):
    """Remove the first ``;key=...``; an attribute in first place has no leading ``;`` and stays."""
    attributes = _col(attributes)
    stripped = F.regexp_replace(attributes, f"(?s)^(.*?);\\Q{key}\\E=[^;]*", "$1")
    return F.when(attributes.contains(f";{key}="), stripped).otherwise(attributes)


def percent_decode(text):
    """Undo percent-encoding. ``+`` is a plain sign in GFF3; malformed text is kept as it is."""
    text = _col(text)
    decoded = F.try_url_decode(F.regexp_replace(text, r"\+", "%2B"))
    return F.when(text.contains("%"), F.coalesce(decoded, text)).otherwise(text)


def attribute_pairs(attributes):
    """Attributes as an array of (k, v) in file order; keys may repeat, so this is no map.

    Values stay encoded here, since their commas separate list items.
    """
    items = F.filter(F.split(_col(attributes), ";"), lambda item: item.contains("="))
    return F.transform(
        items,
        lambda item: F.struct(
            F.trim(F.substring_index(item, "=", 1)).alias("k"),
            F.regexp_replace(item, "(?s)^[^=]*=", "").alias("v"),
        ),
    )


def _searched(attributes, key):
    """The text to search for ``key``, empty where it cannot hold it.

    What is found in it is asked for first in the conditions on it, so Spark works it out once for all of them.
    """
    attributes = _col(attributes)
    return F.when(~attributes.contains(key), "").otherwise(attributes)


def _value_of(key):
    return f"(?:^|;)\\s*\\Q{key}\\E\\s*=([^;]*)"


def attribute(attributes, key):
    """Decoded value of the first attribute named ``key``, null where it is absent or empty.

    Read straight from the text: no array is built for each of the lines.
    """
    value = F.trim(F.regexp_extract(_searched(attributes, key), _value_of(key), 1))
    return F.when(value != "", percent_decode(value))


def attribute_list(attributes, key):
    """Decoded items of every attribute named ``key``."""
    values = F.array_join(F.regexp_extract_all(_searched(attributes, key), F.lit(_value_of(key)), F.lit(1)), ",")
    items = F.split(values, ",")
    return (
        F.when(values == "", F.array().cast("array<string>"))
        .when(values.contains("%"), F.transform(items, percent_decode))
        .otherwise(items)
    )


def frame_of_phase(phase):
    """Exon frame of a coding piece: the bases of its codon that came before it."""
    return F.pmod(F.lit(3) - phase, F.lit(3)).cast("int")


def exon_frames(exons, cds):
    """Frame of each exon: that of the first coding piece within it, -1 where none is."""

    def frame(exon):
        inside = F.filter(cds, lambda c: (c["start"] < exon["end"]) & (c["end"] > exon["start"]))
        frames = F.transform(inside, lambda c: frame_of_phase(F.coalesce(c["phase"], F.lit(0))))
        return F.coalesce(F.get(frames, F.lit(0)), F.lit(-1))

    return F.when(F.size(cds) == 0, F.array_repeat(F.lit(-1), F.size(exons))).otherwise(F.transform(exons, frame))
