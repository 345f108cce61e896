from __future__ import annotations

import csv

import pytest

from monthlake import Zones, fixtures
from monthlake.cli import main, parser
from monthlake.plans import VerificationError, build_source, process_months
from monthlake.schema import INCIDENT_COLUMNS
from monthlake.sinks import empty_partitions
from monthlake.sources import count_months, read_curated, read_source

from core_records import GOOD, SMALL


@pytest.fixture
def landing(tmp_path):
    path = tmp_path / "landing.csv"
    with path.open("w", newline="") as file:
        out = csv.DictWriter(file, INCIDENT_COLUMNS)
        out.writeheader()
        for i in range(4):
            out.writerow(GOOD | {"ID": str(i // 2), "Case Number": f"A{i}"})
        out.writerow(GOOD | {"Date": "unknown"})
    return str(path)


def test_source_route(spark, landing, tmp_path, capsys):
    root, table = str(tmp_path / "lake"), "default.cli_incidents"
    main(["--root", root, "load", landing])
    assert "year=2001/month=5" in capsys.readouterr().out
    main(["--root", root, "month", "2001-05", "--explain"])
    shown = capsys.readouterr().out
    assert "PartitionFilters" in shown and "2001-05\t4\t2\t2" in shown
    main(["--root", root, "register", "--table", table])
    main(["--root", root, "verify", "2001-05", "--table", table])
    main(["--root", root, "verify", "--table", table])
    assert "0000-00" in capsys.readouterr().out
    main(["--root", root, "verify-source"])
    main(["--root", root, "sql", f"SELECT COUNT(*) AS n FROM {table}", "--table", table])
    assert "n\n2\n" in capsys.readouterr().out
    spark.sql(f"DROP TABLE {table}")


def test_raw_route(spark, landing, tmp_path, capsys):
    main(["--root", str(tmp_path / "lake"), "raw-month", landing, "2001-05"])
    assert "2001-05\t5\t2\t3" in capsys.readouterr().out
    main(["--root", str(tmp_path / "lake"), "verify-raw", "2001-05"])
    assert "2001-05\t5\t2\t3" in capsys.readouterr().out


def test_nothing_shown_is_cut(spark, tmp_path, capsys):
    names = [f"c{i}" for i in range(25)]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join("1" * 25) + "\n")
    main(["profile", str(tmp_path / "wide.csv")])
    shown = capsys.readouterr().out
    assert all(f"\t{name}\t" in shown for name in names)
    root, table = str(tmp_path / "lake"), "default.cli_wide"
    zones = Zones(root)
    build_source(fixtures.incidents(spark, SMALL), zones)
    months = sorted(m for m in count_months(read_source(spark, zones).where("year > 0")))
    process_months(spark, zones, months)
    main(["--root", root, "verify", "--table", table])
    shown = capsys.readouterr().out
    assert all(f"\n{m.label}\t" in shown for m in months) and len(months) == 80
    main(["--root", root, "sql", f"SELECT year, month, COUNT(*) FROM {table} GROUP BY ALL", "--table", table])
    assert len(capsys.readouterr().out.splitlines()) == 1 + 79
    main(["--root", root, "sql", f"SELECT * FROM {table}", "--table", table, "--rows", "3"])
    assert len(capsys.readouterr().out.splitlines()) == 1 + 3
    empty_partitions(read_curated(spark, zones).drop("year", "month"), [zones.curated_month(months[0])])
    with pytest.raises(VerificationError, match=months[0].label):
        main(["--root", root, "verify", "--table", table])
    spark.sql(f"DROP TABLE {table}")


def test_a_month_without_valid_rows_is_sound(spark, tmp_path, capsys, incidents):
    root, table = str(tmp_path / "lake"), "default.cli_rejected"
    build_source(incidents({"ID": None}, {"ID": None}), Zones(root))
    main(["--root", root, "month", "2001-05"])
    main(["--root", root, "verify", "2001-05", "--table", table])
    assert "2001-05\t2\t0\t2\t0" in capsys.readouterr().out
    spark.sql(f"DROP TABLE {table}")


def test_labs(spark, landing, tmp_path, capsys):
    (tmp_path / "text.txt").write_text("b a b\n")
    main(["words", str(tmp_path / "text.txt"), str(tmp_path / "out")])
    main(["profile", landing])
    shown = capsys.readouterr().out
    assert "Primary Type" in shown and "total_rows" in shown
    assert next((tmp_path / "out").glob("part-*")).read_text() == "word,count\nb,2\na,1\n"


@pytest.mark.parametrize("argv", [["month", "2001-13"], ["month"], ["unknown"], []])
def test_bad_arguments(argv):
    with pytest.raises(SystemExit):
        parser().parse_args(argv)
