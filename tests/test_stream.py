"""Incremental loading of files."""

import datetime as dt

from labmart.schemas import LAB_15
from labmart.streaming import batch_progress, committed, ingest_stream, ledger_lines

RUN = dt.datetime(2024, 1, 1)


def put(folder, i):
    values = {"patient_id": f"{i}", "visit_id": "1", "value_as_number": "bad" if i == 3 else "2"}
    rows = [[values.get(c, "") for c in LAB_15], ["nan" if c == "patient_id" else "" for c in LAB_15]]
    lines = [",".join(r) for r in (LAB_15, *rows)]
    (folder / f"f{i:03}.csv").write_text("\n".join(lines) + "\n")


def run(spark, tmp_path, checkpoint="checkpoint"):
    query = ingest_stream(
        spark,
        str(tmp_path / "in"),
        str(tmp_path / "out"),
        str(tmp_path / checkpoint),
        layout="15",
        run_ts=RUN,
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_batches_of_ten_and_later_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(23):
        put(tmp_path / "in", i)
    loaded = run(spark, tmp_path)
    assert loaded.count() == 23
    names = {r.processing_batch: (r.rows, r.files) for r in batch_progress(loaded).collect()}
    progress = {name.rpartition("_")[2]: found for name, found in names.items()}
    assert progress == {"1": (10, 10), "2": (10, 10), "3": (3, 3)}
    assert loaded.filter("value_as_number is null").select("patient_id").first()[0] == "3"
    assert loaded.select("source_file").distinct().count() == 23
    put(tmp_path / "in", 99)
    again = run(spark, tmp_path)
    assert again.count() == 24
    assert again.filter("processing_batch LIKE '%/_4' ESCAPE '/'").count() == 1
    assert run(spark, tmp_path).count() == 24
    # Another stream, or the same after its checkpoint was lost, adds to what is there.
    assert run(spark, tmp_path, "other").count() == 48


def test_ledger_loads_each_content_once(spark, tmp_path):
    import shutil

    (tmp_path / "in").mkdir()
    for i in range(12):
        put(tmp_path / "in", i)

    def load(checkpoint):
        paths = [str(tmp_path / x) for x in ("in", "out", checkpoint)]
        ingest_stream(spark, *paths, layout="15", run_ts=RUN, ledger=str(tmp_path / "ledger")).awaitTermination()
        return committed(spark, str(tmp_path / "out"), str(tmp_path / "ledger"))

    assert ledger_lines(spark, str(tmp_path / "ledger")).count() == 0
    assert load("first").count() == 12
    # A new checkpoint, a copy under another name, copies within one batch, and two new files.
    shutil.copy(tmp_path / "in" / "f003.csv", tmp_path / "in" / "g.csv")
    put(tmp_path / "in", 50)
    shutil.copy(tmp_path / "in" / "f050.csv", tmp_path / "in" / "h.csv")
    put(tmp_path / "in", 51)
    loaded = load("second")
    assert loaded.count() == 14
    assert sorted(r.patient_id for r in loaded.collect()) == sorted(map(str, [*range(12), 50, 51]))
    lines = ledger_lines(spark, str(tmp_path / "ledger"))
    assert lines.count() == 14 and lines.agg({"rows": "sum"}).first()[0] == 28
    # A batch that broke before its line in the ledger leaves rows that do not count.
    left = spark.read.parquet(str(tmp_path / "out")).drop("processing_batch")
    left.write.parquet(str(tmp_path / "out" / "processing_batch=batch_broken_1"))
    assert load("third").count() == 14
