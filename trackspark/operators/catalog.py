"""The track catalog: routing, sample metadata, display parameters and hubs."""

import logging

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.values import merge_maps
from ..schemas import FILE_TYPES
from .lookup import lookup_join

log = logging.getLogger(__name__)

# Display type, colour and visibility by track type.
DISPLAY_TYPES = {"bigwig": "bigWig", "bigbed": "bigBed"}
DEFAULT_COLORS = {"bigwig": "0,0,100", "bigbed": "0,100,0"}
DEFAULT_VISIBILITY = {"bigwig": "full", "bigbed": "pack"}

# Parameters a bigWig track has unless they are overridden.
BIGWIG_DEFAULTS = {"autoScale": "on", "alwaysZero": "on"}

# Composite track of each track type.
COMPOSITES = {"bigwig": "composite_all_bigwig", "bigbed": "composite_all_bigbed"}


class UnmatchedGenomeError(ValueError):
    """Raised when track files belong to genomes without chromosome sizes."""


class DuplicateTrackError(ValueError):
    """Raised when two tracks of a hub get the same name."""


def _by_type(values, default=None):
    kind = F.col("track_type")
    result = F.lit(default) if default is not None else F.lit(None).cast("string")
    for known, value in values.items():
        result = F.when(kind == known, value).otherwise(result)
    return result


def route_by_type(rows):
    """One frame per file type, by exact match, and ``unknown`` for all others."""
    routed = {kind: rows.filter(F.col("file_type") == kind) for kind in FILE_TYPES}
    routed["unknown"] = rows.filter(~F.coalesce(F.col("file_type").isin(FILE_TYPES), F.lit(False)))
    return routed


def attach_sizes(files, sizes, on="genome", on_unmatched="error"):
    """Track files with the number of contigs and the length of their assembly.

    Many files may share a genome. Files of a genome without sizes raise an
    error, or are left out with ``on_unmatched='drop'``.
    """
    assemblies = sizes.groupBy(on).agg(F.count("*").alias("contigs"), F.sum("size").alias("assembly_size"))
    if on_unmatched == "error":
        lost = lookup_join(files.select(on).distinct(), assemblies, [on], "left_anti").orderBy(on).limit(50).collect()
        if lost:
            raise UnmatchedGenomeError(f"no chromosome sizes for {', '.join(str(row[0]) for row in lost)}")
    return lookup_join(files, assemblies, [on], "inner")


def with_track_fields(files, sample_pattern=None, annotation_pattern=None):
    """Names, labels and defaults read from each file's path (``path``, ``track_type``)."""
    tracks = (
        files.withColumn("track_type", F.lower("track_type"))
        .withColumn("filename", N.basename("path"))
        .withColumn("_stem", N.without_extension("filename"))
        .withColumn("basename", N.sanitise("_stem"))
    )
    label = N.readable_label("_stem")
    annotation = N.annotation_type("filename", "basename", annotation_pattern)
    return tracks.select(
        *[F.col(c) for c in tracks.columns if c != "_stem"],
        N.sample_id("filename", "basename", sample_pattern).alias("sample_id"),
        F.when(F.col("track_type") == "bigbed", annotation).otherwise("").alias("annotation_type"),
        label.alias("short_label"),
        label.alias("long_label"),
        F.lit("").alias("color"),
        F.lit("").alias("visibility"),
        F.lit("1").alias("priority"),
        F.create_map().cast("map<string,string>").alias("additional_params"),
    )


def apply_sample_metadata(tracks, metadata):
    """Overlay sample metadata; tracks without any keep their own values.

    Labels are replaced; colour and visibility fill what is unset; a priority in
    the sheet wins; parameters are merged. ``has_metadata`` tells matched tracks.
    """
    ours = ["short_label", "long_label", "color", "visibility", "priority", "additional_params"]
    sheet = metadata.select("sample_id", *[F.col(c).alias(f"_{c}") for c in ours], F.lit(True).alias("_found"))
    joined = lookup_join(tracks, sheet, ["sample_id"], "left")
    found = F.coalesce("_found", F.lit(False))

    def unset(column, fallback):
        return F.coalesce(F.nullif(F.col(column), F.lit("")), F.nullif(F.col(fallback), F.lit("")), F.lit(""))

    values = {
        "short_label": F.when(found, F.col("_short_label")).otherwise(F.col("short_label")),
        "long_label": F.when(found, F.col("_long_label")).otherwise(F.col("long_label")),
        "color": unset("color", "_color"),
        "visibility": unset("visibility", "_visibility"),
        "priority": unset("_priority", "priority"),
        "additional_params": F.when(
            found, merge_maps("additional_params", "_additional_params")
        ).otherwise(F.col("additional_params")),
    }
    return joined.select(
        *[values[c].alias(c) if c in values else F.col(c) for c in tracks.columns],
        found.alias("has_metadata"),
    )


def track_params(tracks, hub_prefix=None, ensembl=False):
    """Add ``params``, the display parameters of each track as a map.

    ``hub_prefix`` is a column name or a Column. Additional parameters override
    every other one.
    """
    prefix = F.col(hub_prefix) if isinstance(hub_prefix, str) else hub_prefix
    display = F.coalesce(_by_type(DISPLAY_TYPES), F.col("track_type"))
    entries = {
        "name": N.track_name("basename", "track_type", prefix),
        "source": F.col("path"),
        "visibility": F.coalesce(
            F.nullif(F.col("visibility"), F.lit("")), _by_type(DEFAULT_VISIBILITY, "pack")
        ),
        "tracktype": display,
        "short_label": N.short_label("short_label"),
        "long_label": N.long_label("long_label", prefix),
        "color": F.coalesce(F.nullif(F.col("color"), F.lit("")), _by_type(DEFAULT_COLORS, "0,100,0")),
        "priority": F.col("priority"),
    }
    for key, value in BIGWIG_DEFAULTS.items():
        entries[key] = _by_type({"bigwig": value})
    if ensembl:
        entries["type"] = _by_type(DISPLAY_TYPES)
        entries["format"] = _by_type(DISPLAY_TYPES)
    pairs = [item for key, value in entries.items() for item in (F.lit(key), value)]
    base = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    return tracks.withColumn("params", merge_maps(base, "additional_params"))


def with_composite(tracks, ensembl=False):
    """Add ``composite``, the composite track a track belongs to; there is none for Ensembl."""
    return tracks.withColumn("composite", F.lit(None).cast("string") if ensembl else _by_type(COMPOSITES))


def with_hub_key(rows, hub_name=None):
    """Fill ``hub``: the row's own, else ``hub_name`` and genome, else the genome."""
    fallback = F.concat(F.lit(f"{hub_name}_"), F.col("genome")) if hub_name else F.col("genome")
    return rows.withColumn("hub", F.coalesce(F.nullif(F.col("hub"), F.lit("")), fallback))


def group_hubs(tracks):
    """The distinct bigBed and bigWig paths of each (hub, genome), one row per path and type; ``tracks`` counts its rows."""
    shown = tracks.filter(F.col("track_type").isin("bigbed", "bigwig"))
    return track_counts(shown, "hub", "genome", "track_type", "path")


def group_tracks(tracks, by="sample_id"):
    """The distinct paths of each sample, or the bigBed paths of each annotation type, one row per path."""
    if by == "annotation_type":
        tracks = tracks.filter(F.col("track_type") == "bigbed").withColumn(
            by, F.coalesce(F.nullif(F.col(by), F.lit("")), F.lit("default"))
        )
    return track_counts(tracks, by, "path")


def track_counts(rows, *by):
    return rows.groupBy(*by).agg(F.count("*").alias("tracks"))


def union_tracks(*frames):
    """All rows of all frames; a column a frame lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def duplicate_names(tracks):
    """Track names used more than once in a hub."""
    name = F.col("params")["name"].alias("name")
    return tracks.groupBy("hub", "genome", name).agg(F.count("*").alias("tracks")).filter("tracks > 1")


def check_unique_names(tracks, shown=50):
    clashes = duplicate_names(tracks).orderBy("hub", "genome", "name").limit(shown).collect()
    if clashes:
        raise DuplicateTrackError(
            "track names used twice: " + ", ".join(f"{c['hub']}/{c['genome']}/{c['name']}" for c in clashes)
        )
    return tracks


def multi_assembly(*catalogs):
    """Distinct (genome, path) entries of several catalogs, sorted."""
    entries = union_tracks(*[c.select("genome", "path") for c in catalogs])
    return entries.distinct().orderBy("genome", "path")
