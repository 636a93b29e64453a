"""Files, sheets, documents and batches."""

import csv
import datetime as dt
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from kpiloom import plans, schemas, sources
from kpiloom.session import RUNTIME_CONF, materialise, scratch_path

d = dt.date


def test_csv_types_and_bad_dates(spark, tmp_path, rows):
    (tmp_path / "g.csv").write_text("Fecha,Compras,Ordenes,NMV,NMV_USD,NSI,TSIE_total\n2031-05-04,3,8,2.5E3,1.5,21.0,22\n")
    got = sources.scan_csv(spark, str(tmp_path / "g.csv"), schemas.GROWTH).collect()[0]
    assert (got.Fecha, got.NMV, got.TSIE_total) == (d(2031, 5, 4), 2500.0, 22)
    text = spark.createDataFrame([("2031-05-04",), ("05/31/2031",), (None,)], "Fecha string")
    assert rows(sources.coerce_dates(text, ["Fecha"])) == [(d(2031, 5, 4),)]


def test_latin1_and_na(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("a,b\n70 y más,NA\n".encode("latin-1"))
    row = sources.scan_csv(spark, str(tmp_path / "l.csv"), "a string, b string", "ISO-8859-1", "NA").collect()[0]
    assert tuple(row) == ("70 y más", None)


def test_optional_source(spark, tmp_path):
    missing = sources.optional_source(spark, str(tmp_path / "none.csv"), schemas.VISITS)
    assert missing.count() == 0 and missing.columns == ["Fecha", "Visitas"]


def test_fallback(spark):
    empty, full = spark.range(0), spark.range(3)
    assert sources.source_fallback(empty, full).count() == 3
    assert sources.source_fallback(None, full).count() == 3
    assert sources.source_fallback(full, empty).count() == 3


def test_write_csv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(d(2026, 1, 4), 5), (d(2026, 1, 11), None)], schemas.VISITS)
    path = sources.write_csv(df, str(tmp_path / "v"))
    sources.write_csv(df, path)
    assert rows(sources.scan_csv(spark, path, schemas.VISITS)) == rows(df)


def plan_lines():
    width = 50
    line = lambda cells: ",".join(f'"{cells[i]}"' if i in cells else "" for i in range(width))
    lines = [""] * 23
    lines[0] = line({1: "ene-26", 2: " Feb-26", 3: "mar-2026", 4: "FY"})
    lines[4] = line({0: "NMV", 1: "1.000,5", 2: "2.000", 3: "50%"})
    lines[6] = line({0: "4+8", 1: "900", 3: "x"})
    lines[22] = line({0: "Dia"})
    lines += [line({0: "Domingo", 1: "3", 2: "1-mar", 12: "4.000.200", 13: "2.100", 47: "3.000.000", 48: "2.050", 49: "64"}),
              line({0: "Total", 12: "1"}), line({0: "sábado", 1: "3", 2: "7-xyz", 12: "1,5"}), line({0: "lunes", 2: "40-mar"})]
    return lines


def test_plan_sheet(spark, tmp_path, rows):
    (tmp_path / "plan.csv").write_text("\r\n".join(plan_lines()) + "\r\n", encoding="utf-8")
    sheet = sources.scan_plan_sheet(spark, str(tmp_path / "plan.csv"))
    assert [r.row_no for r in sheet.orderBy("row_no").collect()] == list(range(27))
    assert rows(plans.plan_monthly(sheet, 2026)) == [
        (d(2026, 1, 1), 1000.5, 900.0), (d(2026, 2, 1), 2000.0, None), (d(2026, 3, 1), None, None)]
    assert rows(plans.plan_daily(sheet, 2026)) == [
        (d(2026, 3, 1), "Domingo", 4000200.0, 2100.0, 3000000.0, 2050.0, 64.0), (d(2026, 3, 7), "sábado", 1.5, None, None, None, None)]


def test_lines_are_numbered_across_splits(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"part-{part}.csv").write_text("".join(f"{part},{i}\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        sheet = sources.scan_block_sheet(spark, str(tmp_path))
        assert sheet.rdd.getNumPartitions() >= 1
        got = sheet.select("row_no", F.col("cells")[0].cast("int") * 2000 + F.col("cells")[1].cast("int")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 6000 and all(a == b for a, b in got)


BLOCKS = """,Alpha,,,
,Marzo,Abril,Tendencia,
Disponibilidad,"20,5%","30,0%",,
Gap (p.p.),"4,0","6,5",,
,,,,
Comentarios,"8,0","9,0",,
,Beta Sur,,,
,Marzo,Abril,Tendencia,
Profundidad,"40,25%",x,,
Gap (p.p.),"3,0",,,
"""


def test_assortment_sheet(spark, tmp_path):
    (tmp_path / "a.csv").write_text(BLOCKS)
    sheet = sources.scan_block_sheet(spark, str(tmp_path / "a.csv"))
    mar, apr = d(2031, 3, 1), d(2031, 4, 1)
    parsed = plans.assortment_parse(sheet, 2031, ["Alpha", "Beta"])
    got = {(r.Tienda, r.Mes, r.metric): r.value for r in parsed.collect()}
    assert got == pytest.approx({
        ("Alpha", mar, "Disponibilidad"): 0.205, ("Alpha", apr, "Disponibilidad"): 0.3, ("Alpha", mar, "Gap"): 4.0, ("Alpha", apr, "Gap"): 6.5,
        ("Beta", mar, "Profundidad"): 0.4025, ("Beta", apr, "Profundidad"): None, ("Beta", mar, "Gap"): 3.0, ("Beta", apr, "Gap"): None})
    month = plans.assortment_summary(parsed).filter(F.col("Mes") == mar).collect()[0]
    assert month.Gap == pytest.approx(3.5)
    assert (month.Gap_status, month.Disponibilidad_status) == ("good", "bad")


def test_sheets_keep_all_cells_and_quoted_line_breaks(spark, tmp_path):
    wide = ",".join(f"v{i}" for i in range(70))
    (tmp_path / "s.csv").write_text(f'{wide}\na,"two\nlines, and ""quotes""",\n"",z\n\nlast\n')
    for part in ("4", "1m"):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", part)
        try:
            got = [tuple(r) for r in sources.scan_plan_sheet(spark, str(tmp_path / "s.csv")).orderBy("row_no").collect()]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert got == [(0, [f"v{i}" for i in range(70)]), (1, ["a", 'two\nlines, and "quotes"', None]), (2, ["", "z"]), (3, [None]),
                       (4, ["last"])]


def read_sheet(spark, path, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        return [tuple(r) for r in sources.scan_plan_sheet(spark, str(path)).orderBy("row_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_stray_quote_is_a_character(spark, tmp_path):
    (tmp_path / "s.csv").write_text('a,b\n5" screen,2\nc,"3"\nd "x",4"\n"e" f,"g""h"" i"j"\n')
    for split in ("4", "1m"):
        assert read_sheet(spark, tmp_path, split) == [
            (0, ["a", "b"]), (1, ['5" screen', "2"]), (2, ["c", "3"]), (3, ['d "x"', '4"']), (4, ["e f", 'g"h" ij"'])]


@pytest.mark.parametrize("seed", range(2))
def test_sheets_are_read_as_the_csv_module_reads_them(spark, tmp_path, seed):
    rng, want = random.Random(seed), []
    for name in "abc":
        text = "".join(rng.choices('"",,\nxy', k=rng.choice([40, 150]))) + rng.choice(["", "\n", '"\n', ',"open\nto the end'])
        (tmp_path / f"{name}.csv").write_text(text)
        want += csv.reader(io.StringIO(text.removesuffix("\n"), newline=""))
    # a blank line and one with an empty cell read alike here
    plain = lambda rows: [[] if row in ([""], [None]) else [c or "" for c in row] for row in rows]
    for split in ("2", "1m"):
        got = read_sheet(spark, tmp_path, split)
        assert [k for k, _ in got] == list(range(len(want)))
        assert plain(row for _, row in got) == plain(want), split


def test_an_open_quote_ends_with_its_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,"open\nb,c\n')
    (tmp_path / "b.csv").write_text("d,e\n")
    assert read_sheet(spark, tmp_path, "3") == [(0, ["a", "open\nb,c"]), (1, ["d", "e"])]


def test_json_documents_per_period(spark, tmp_path):
    mart = spark.createDataFrame([(d(2026, 1, 4), "a", 1.0, None), (d(2026, 1, 4), None, 0.5, 1), (d(2026, 1, 4), "x/y~", 2.5, 2),
                                  (d(2026, 1, 11), 'q"', 2.0, 3), (None, "a", 9.0, 9)], "p date, s string, x double, y int")
    path = sources.write_json_doc({"m": (mart, ["p", "s"])}, str(tmp_path / "doc"))
    lines = [r.value for r in spark.read.text(f"{path}/mart=m").collect()]
    assert sorted((json.loads(t) for t in lines), key=lambda t: t["period"] or "") == [
        {"period": None, "rows": {"a": {"x": 9.0, "y": 9}}},
        {"period": "2026-01-04", "rows": {"a": {"x": 1.0, "y": None}, "~n": {"x": 0.5, "y": 1}, "x~1y~0": {"x": 2.5, "y": 2}}},
        {"period": "2026-01-11", "rows": {'q"': {"x": 2.0, "y": 3}}}]
    assert any('"x":1.0' in t for t in lines)


def test_batch_isolates_failures(spark, tmp_path):
    def broken():
        raise LookupError("no input")

    status = sources.run_batch(spark, {"good": lambda: spark.range(5), "bad": broken}, str(tmp_path), "csv")
    assert {r.job: (r.ok, r.rows) for r in status.collect()} == {"good": (True, 5), "bad": (False, None)}
    meta = sources.run_metadata(status).collect()[0]
    assert (meta.queries_ok, meta.queries_failed, meta.errors[0].job) == (1, 1, "bad")
    with pytest.raises(sources.BatchFailed, match="bad"):
        sources.raise_on_failure(status)
    assert sources.raise_on_failure(status.filter("ok")).count() == 1


def test_errors_are_kept_whole(spark, tmp_path):
    def broken():
        raise LookupError("x" * 5000)

    assert "x" * 5000 in sources.run_batch(spark, {"bad": broken}, str(tmp_path)).first().error


def test_scratch_needs_a_shared_folder(spark, tmp_path):
    class Session:
        conf = {"spark.checkpoint.dir": "/shared/somewhere/"}

    class Bare:
        conf = {}

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    assert scratch_path(Session, "x").startswith("/shared/somewhere/x-")
    assert "/x-" in scratch_path(spark, "x")
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_path(Bare, "x")
    kept = materialise(spark.range(4).selectExpr("id", "id % 2 AS half"), str(tmp_path / "m"), ["half"])
    assert kept.filter("half = 1").count() == 2


def test_queries_leave_the_session_as_it_was(spark):
    from __spark_entry__ import queries
    conf = lambda: {k: spark.conf.get(k, None) for k in (*RUNTIME_CONF, "spark.sql.shuffle.partitions",
                    "spark.sql.adaptive.coalescePartitions.initialPartitionNum")}
    before = conf()
    queries()["growth_weekly"](spark, "/root/testdata/sf0.001")
    assert conf() == before
