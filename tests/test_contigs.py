import random

import pytest
from conftest import rows

from trackspark.operators import contigs
from trackspark.plans import jobs


def expected(contig, names):
    """The contig rule, one record at a time."""
    if contig in names:
        return contig
    longer = "chrM" if contig in ("M", "MT") else "chr" + contig
    if longer in names:
        return longer
    if contig.startswith("chr"):
        shorter = contig[3:]
        shorter = "MT" if shorter in ("M", "MT") else shorter
        if shorter in names:
            return shorter
    return None


POOL = ["M", "MT", "chrM", "chrMT", "1", "chr1", "chrchr1", "X", "chrX", "", "chr", "Un_1", "chrUn_1", "m", "Chr1"]


def test_alias_join_follows_the_rule(spark):
    rng = random.Random(7)
    sets = {f"g{i}": rng.sample(POOL, rng.randint(1, 6)) for i in range(120)}
    sizes = spark.createDataFrame(
        [(g, name, 10) for g, names in sets.items() for name in names], "genome string, name string, size bigint"
    )
    records = spark.createDataFrame([(g, c, c) for g in sets for c in POOL], "genome string, chrom string, was string")
    for limit in (10_000_000, 0):  # broadcast, and shuffled
        got = contigs.harmonise_contigs(records, sizes, max_rows=limit).collect()
        assert len(got) == len(records.collect())
        for row in got:
            want = expected(row["was"], set(sets[row["genome"]]))
            assert row["known"] == (want is not None)
            assert row["chrom"] == (want if want is not None else row["was"])


@pytest.fixture
def small(spark):
    sizes = spark.createDataFrame([("g", "chr1", 100), ("g", "MT", 50)], "genome string, name string, size bigint")
    records = spark.createDataFrame(
        [("g", "1", 0, 10), ("g", "chr1", 5, 5), ("g", "chrM", 10, 60), ("g", "7", 1, 2), ("g", "7", 3, 4),
         ("g", "1", -1, 4), ("g", "1", 9, 3), ("g", "1", None, 3)],
        "genome string, chrom string, start bigint, end bigint",
    )
    return records, sizes


def test_every_record_is_accounted_for(small):
    records, sizes = small
    track = jobs.clean_intervals(records, sizes)
    assert rows(track.clean, "chrom", "start", "end") == [("chr1", 0, 10), ("chr1", 5, 5)]
    assert rows(track.missing) == [("g", "7", 2)]
    assert rows(track.rejects, "start", "reject_reason") == [
        (-1, "negative_start"), (10, "end_past_contig"), (9, "end_before_start"), (None, "unreadable_position"),
    ]
    signal = jobs.clean_signal(records, sizes)
    assert rows(signal.clean, "chrom", "start", "end") == [("chr1", 0, 10)]


def test_error_mode_names_the_contigs(small):
    records, sizes = small
    with pytest.raises(contigs.MissingContigsError, match="g/7"):
        jobs.clean_intervals(records, sizes, on_missing="error")
    with pytest.raises(ValueError):
        jobs.clean_intervals(records, sizes, on_missing="skip")


def test_error_mode_passes_when_all_are_known(small):
    records, sizes = small
    known = records.filter("chrom != '7'")
    assert jobs.clean_intervals(known, sizes, on_missing="error").clean.count() == 2


def test_empty_sizes_raise(small):
    records, sizes = small
    with pytest.raises(contigs.EmptySizesError):
        contigs.harmonise_contigs(records, sizes.limit(0))


def test_plan_broadcasts_a_small_table_and_uses_no_python(small, capsys):
    records, sizes = small
    jobs.clean_intervals(records, sizes).clean.explain("formatted")
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan and "SortMergeJoin" not in plan
