"""Names, labels and file names as column expressions."""

import re

from pyspark.sql import functions as F

# Processing terms taken out of readable labels, in this order.
TECHNICAL_TERMS = [
    "sorted", "filtered", "trimmed", "dedup", "duplicates",
    "cleaned", "normalized", "processed", "final",
]

# File type of each recognised extension.
EXTENSION_TYPES = {
    "bed": "bed",
    "bedgraph": "bedgraph",
    "bg": "bedgraph",
    "bigbed": "bigbed",
    "bb": "bigbed",
    "bigwig": "bigwig",
    "bw": "bigwig",
    "gff3": "gff3",
}

# Assembly names that differ between the two browsers.
ENSEMBL_ASSEMBLIES = {"hg38": "GRCh38", "hg19": "GRCh37"}

SHORT_LABEL_LENGTH = 17
LONG_LABEL_LENGTH = 76
RUN_PREFIX = "ncORFs_"


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def chrize(name):
    """``chr`` before plain chromosome names, ``chrM`` for the mitochondrial ones."""
    name = _col(name)
    return (
        F.when(name.isin("M", "MT"), F.lit("chrM"))
        .when(name.rlike(r"^(X|Y|\d+)\z"), F.concat(F.lit("chr"), name))
        .otherwise(name)
    )


def header_key(name):
    """Column label in canonical form: trimmed, lower case, hyphens for blanks and underscores."""
    return F.translate(F.lower(F.regexp_replace(_col(name), r"^\s+|\s+\z", "")), " _", "--")


def basename(path):
    return F.element_at(F.split(_col(path), "/"), -1)


def without_extension(filename):
    """The name without its last extension; leading dots start no extension."""
    return F.regexp_replace(_col(filename), r"(?s)^(\.*[^.].*)\.[^.]*\z", "$1")


def sanitise(name):
    """Letters, digits and underscores only; dots and hyphens turn into underscores."""
    return F.regexp_replace(F.translate(_col(name), ".-", "__"), "[^a-zA-Z0-9_]", "")


def readable_label(name):
    """A label for people: technical terms removed, separators turned into single blanks."""
    label = _col(name)
    for separator in (".", "_"):
        for term in TECHNICAL_TERMS:
            label = F.regexp_replace(label, f"(?i)\\Q{separator}{term}\\E", "")
    label = F.regexp_replace(F.translate(label, "._", "  "), r"\s+", " ")
    return F.trim(label)


def named_group(pattern, group):
    """(Java pattern, position) of a named group, or None where it is absent.

    Java group names hold no underscore, so groups are addressed by position.
    """
    compiled = re.compile(pattern)
    if group not in compiled.groupindex:
        return None
    java = re.sub(
        r"\(\?P=(\w+)\)", lambda m: "\\" + str(compiled.groupindex[m.group(1)]), pattern
    )
    return re.sub(r"\(\?P<\w+>", "(", java), compiled.groupindex[group]


def _matched_or(filename, pattern, group, default):
    found = named_group(pattern, group) if pattern else None
    if found is None:
        return default
    java, position = found
    filename = _col(filename)
    return F.when(filename.rlike(java), F.regexp_extract(filename, java, position)).otherwise(default)


def sample_id(filename, clean_name, pattern=None):
    """Sample of a file: the ``sample_id`` group, else the clean name up to its first underscore."""
    first = F.split(_col(clean_name), "_")[0]
    return _matched_or(filename, pattern, "sample_id", first)


def annotation_type(filename, clean_name, pattern=None):
    """Annotation of a file: the ``annotation_type`` group, else the second part of the clean name."""
    second = F.coalesce(F.get(F.split(_col(clean_name), "_"), F.lit(1)), F.lit("default"))
    return _matched_or(filename, pattern, "annotation_type", second)


def short_label(label):
    return F.substring(_col(label), 1, SHORT_LABEL_LENGTH)


def long_label(label, hub_prefix=None):
    label = _col(label)
    if hub_prefix is not None:
        label = F.concat(hub_prefix, F.lit(" - "), label)
    return F.substring(label, 1, LONG_LABEL_LENGTH)


def track_name(clean_name, track_type, hub_prefix=None):
    lead = F.translate(hub_prefix, " -", "__") if hub_prefix is not None else _col(track_type)
    return F.concat(lead, F.lit("_"), _col(clean_name))


def ensembl_genome(genome):
    genome = _col(genome)
    renamed = genome
    for ours, theirs in ENSEMBL_ASSEMBLIES.items():
        renamed = F.replace(renamed, F.lit(ours), F.lit(theirs))
    return F.when(genome.startswith("hg"), renamed).otherwise(genome)


def file_type(filename):
    """File type by the text after the last dot, ``unknown`` where it is not recognised."""
    extension = F.element_at(F.split(_col(filename), r"\."), -1)
    result = F.lit("unknown")
    for known, kind in reversed(EXTENSION_TYPES.items()):
        result = F.when(extension == known, kind).otherwise(result)
    return result


def run_name(filename):
    name = F.regexp_replace(_col(filename), f"^{RUN_PREFIX}", "")
    return F.regexp_replace(name, r"\.[^.]*\z", "")
