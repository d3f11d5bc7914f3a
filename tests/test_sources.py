"""Scans and discovery over files written by the test."""

import pytest
from pyspark.sql import functions as F

from labmart.operators.audits import (
    access_report,
    first_complete_rows,
    glob_profile,
    patient_id_profile,
    scan_access_check,
)
from labmart.schemas import LAB_15, LAB_27
from labmart.session import MIB
from labmart.sources import (
    detect_separator,
    discover_files,
    filter_by_path,
    scan_glob,
    scan_lab,
    scan_vocab,
    union_batches,
    validate_structure,
    vocab_file_check,
    volume_report,
)


def write(path, header, *rows, sep=","):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(sep.join(r) for r in (header, *rows)) + "\n")


def row(patient, columns=LAB_15):
    return [patient if c == "patient_id" else "" for c in columns]


@pytest.fixture
def files(tmp_path):
    for i in range(7):
        write(tmp_path / f"lab_000{i}.csv", LAB_15, row(f"{i}0"), row(f"{i}1"))
    return tmp_path


def test_scan_and_globs(spark, files):
    assert scan_lab(spark, str(files), "15").count() == 14
    some = scan_glob(spark, f"{files}/lab_000[0-4].csv")
    assert some.count() == 10 and some.columns == list(LAB_15)
    profile = glob_profile(
        scan_glob(spark, f"{files}/lab_000[0-4].csv")
    ).first()
    assert profile["file_count"] == 5 and profile["rows_per_file"] == 2.0
    assert profile["first_file"] == "lab_0000.csv"
    assert profile["last_file"] == "lab_0004.csv"
    assert profile["sample_id"] == "41"


def test_path_filter_and_lineage(spark, files):
    kept = filter_by_path(scan_lab(spark, str(files), "15"), "%_0003.csv")
    assert sorted(r.patient_id for r in kept.collect()) == ["30", "31"]
    named = scan_lab(spark, str(files), "15", source_file=True)
    assert named.filter("source_file = 'lab_0005.csv'").count() == 2


def test_blank_modes_and_quotes(spark, tmp_path):
    write(tmp_path / "a.csv", LAB_15, ['""', "1", *[""] * 12, '"a ""b"", c"'])
    by_mode = {
        mode: scan_lab(spark, str(tmp_path), "15", blank=mode).first()
        for mode in ("null", "empty")
    }
    assert by_mode["null"]["patient_id"] is None and by_mode["null"]["normality"] is None
    assert by_mode["empty"]["patient_id"] == "" and by_mode["empty"]["normality"] == ""
    assert by_mode["null"]["laboratory_uuid"] == 'a "b", c'
    with pytest.raises(ValueError):
        scan_lab(spark, str(tmp_path), "15", blank="zero")


def test_wrong_layout_fails_instead_of_shifting(spark, tmp_path):
    write(tmp_path / "a.csv", LAB_27, row("1", LAB_27))
    with pytest.raises(Exception):
        scan_lab(spark, str(tmp_path), "15").collect()
    write(tmp_path / "other" / "b.csv", LAB_15[::-1], row("1"))
    with pytest.raises(Exception):
        scan_lab(spark, str(tmp_path / "other"), "15").collect()


def test_wrong_layout_fails_however_few_columns_are_read(spark, files):
    good = scan_lab(spark, str(files), "15")
    assert good.count() > 0 and access_report(spark, str(files), "15").first().accessible
    write(files / "renamed.csv", ["patient", *LAB_15[1:], "one_more"], [*row("1"), "x"])
    wrong = scan_lab(spark, str(files), "15")
    for narrow in (wrong.groupBy().count(), wrong.select("patient_id"), patient_id_profile(wrong)):
        with pytest.raises(Exception):
            narrow.collect()
    report = access_report(spark, str(files), "15").first()
    assert (report.accessible, report.failed_files, report.total_rows) == (False, 1, 0)


def test_structure_report(spark, files):
    write(files / "short.csv", LAB_15[:-1], row("1")[:-1])
    write(files / "swapped.csv", [*LAB_15[1:], LAB_15[0]], row("1"))
    write(files / "header_only.csv", LAB_15)
    (files / "bom.csv").write_bytes(b"\xef\xbb\xbf" + ",".join(LAB_15).encode() + b"\r\n")
    (files / "zero.csv").write_text("")
    report = {
        r["name"]: r
        for r in validate_structure(
            spark, str(files), LAB_15, expected_names=["zero.csv", "short.csv", "absent.csv"]
        ).collect()
    }
    assert report["short.csv"]["missing_columns"] == [LAB_15[-1]]
    assert report["swapped.csv"]["status"] == "FAILED"
    assert report["swapped.csv"]["missing_columns"] == []
    assert report["header_only.csv"]["status"] == report["bom.csv"]["status"] == "PASSED"
    assert report["zero.csv"]["status"] == "MISSING" == report["absent.csv"]["status"]
    assert report["lab_0001.csv"]["status"] == "PASSED"


def test_long_quoted_and_empty_headers(spark, tmp_path):
    wide = [f"column_{i}_" + "x" * 60 for i in range(2000)]
    names = [*wide, "a, b", 'say ""so""']
    header = ",".join(f'"{c}"' for c in names)
    assert len(header) > 100_000
    (tmp_path / "long.csv").write_text(header + "\n")
    (tmp_path / "cr lf.csv").write_bytes(header.encode() + b"\r\n")
    (tmp_path / "zero %20 é.csv").write_text("")
    manifest = {r.name: r for r in discover_files(spark, str(tmp_path)).collect()}
    assert len(manifest) == 3 and manifest["zero %20 é.csv"]["size"] == 0
    assert manifest["zero %20 é.csv"]["last_modified"] is not None
    found = validate_structure(spark, str(tmp_path), [*wide, "a, b", 'say "so"']).collect()
    assert {r.name: r.status for r in found} == {
        "long.csv": "PASSED", "cr lf.csv": "PASSED", "zero %20 é.csv": "EMPTY"
    }


def test_headers_through_a_path_that_only_spark_reads(spark, tmp_path):
    """A mount of Hadoop's view file system; a large file is one task of one line."""
    from labmart.sources.discovery import file_headers

    write(tmp_path / "a+b %41.csv", LAB_15, *[row(str(i)) for i in range(600_000)])
    write(tmp_path / "c.csv", LAB_15[:-1], row("1")[:-1])
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.files.link./in", f"file://{tmp_path}")
    mounted = "viewfs://files/in"
    assert (tmp_path / "a+b %41.csv").stat().st_size > 10_000_000
    found = {r.name: r.status for r in validate_structure(spark, mounted, LAB_15).collect()}
    assert found == {"a+b %41.csv": "PASSED", "c.csv": "FAILED"}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "")
    try:
        assert file_headers(spark, mounted).count() == 2
        jobs = tracker.getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
    # One task for each file.
    assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) == 2


def test_discovery_and_volume(spark, files):
    manifest = discover_files(spark, str(files))
    assert manifest.count() == 7
    sizes = {r["name"]: r["size"] for r in manifest.collect()}
    path = files / "lab_0000.csv"
    assert sizes[path.name] == path.stat().st_size
    big = spark.createDataFrame([(f"f{i}", 100 * MIB) for i in range(9)], "name string, size bigint")
    structure = spark.createDataFrame([("PASSED",), ("FAILED",)], "status string")
    report = volume_report(big, structure).first()
    assert report["files_count"] == 9 and report["total_size_mb"] == 900.0
    assert report["estimated_rows"] == 9_000_000 and report["estimated_patients"] == 450_000
    assert report["estimated_processing_time_minutes"] == 45
    assert report["recommended_chunk_size"] == 50_000
    assert report["first_files"] == ["f0", "f1", "f2", "f3", "f4"]
    assert report["validation_status"] == "FAILED"
    small = volume_report(spark.createDataFrame([("f", 10)], "name string, size bigint")).first()
    assert small["estimated_processing_time_minutes"] == 5
    assert small["recommended_chunk_size"] == 10_000


def test_access_check_and_sampling(spark, files):
    check = scan_access_check(scan_lab(spark, str(files), "15")).first()
    assert check["files_accessible"] == 7 and check["accessible"]
    (files / "extra.csv").write_text(
        ",".join(LAB_15) + "\n" + "1,2\n" + ",".join(["p", "x1", *["a"] * 13]) + "\n"
    )
    rows = first_complete_rows(spark, str(files / "extra.csv")).collect()
    assert [(r.patient_id, r.visit_id) for r in rows] == [("p", None)]


def test_union_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    assert sorted(map(str, union_batches([a, b]).select("i", "s", "d").collect())) == [
        "Row(i=1, s='x', d=None)",
        "Row(i=None, s='y', d=2.0)",
    ]


VOCAB = ["vocabulary_id", "vocabulary_name", "vocabulary_reference", "vocabulary_version", "vocabulary_concept_id"]


@pytest.mark.parametrize("sep", ["\t", ","])
def test_separator_detection(spark, tmp_path, sep):
    write(tmp_path / "VOCABULARY.csv", VOCAB, ["LOINC", "Codes", "ref", "1", "44"], sep=sep)
    write(tmp_path / "CONCEPT.csv", ["other"], ["1"])
    assert detect_separator(spark, str(tmp_path)) == sep
    rows = scan_vocab(spark, str(tmp_path), "VOCABULARY.csv", sep)
    assert rows.first()["vocabulary_name"] == "Codes"
    check = vocab_file_check(rows).first()
    size = (tmp_path / "VOCABULARY.csv").stat().st_size
    assert (check["total_rows"], check["total_file_size"], check["status"]) == (1, size, "OK")
    assert vocab_file_check(rows, max_bytes=1).first()["status"] == "TOO_LARGE"


def test_separator_not_found(spark, tmp_path):
    write(tmp_path / "VOCABULARY.csv", [";".join(VOCAB)], ["a;b;c;d;e"])
    with pytest.raises(ValueError):
        detect_separator(spark, str(tmp_path))


def test_bare_quotes_in_tab_files(spark, tmp_path):
    write(tmp_path / "VOCABULARY.csv", VOCAB, ["V", '5" scale', "", "", ""], sep="\t")
    row = scan_vocab(spark, str(tmp_path), "VOCABULARY.csv", "\t").first()
    assert row["vocabulary_name"] == '5" scale'
    empty = scan_vocab(spark, str(tmp_path), "VOCABULARY.csv", "\t").filter(F.lit(False))
    assert vocab_file_check(empty).first()["status"] == "NO_FILES"
