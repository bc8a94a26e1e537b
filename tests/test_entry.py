import __spark_entry__ as entry
from quillgraph.__main__ import main

from .test_records import EXPORT


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["target", "file_number", "file_name", "reference_count"]


def test_command(spark, tmp_path, capsys):
    (tmp_path / "DD.zwr").write_text("\n".join(EXPORT))
    (tmp_path / "P.csv").write_text("Directory Name,Package Name,Prefixes,VDL ID,File Numbers Low,File Numbers High\nD1,P1,A,12,1,9\n")
    args = ["--dictionary", str(tmp_path / "DD.zwr"), "--packages", str(tmp_path / "P.csv"), "--roots", str(tmp_path / "DD.zwr"), "--output", str(tmp_path / "g")]
    assert main([*args, "--phase", "3"]) == 1
    assert main([*args, "--packages", str(tmp_path / "none")]) == 1
    assert main([*args, "--phase", "1"]) == 0
    assert main([*args, "--clear"]) == 0
    assert main([*args, "--validate-only"]) == 0
    out = capsys.readouterr().out
    assert "orphan_files" in out and "FAIL" in out  # too few edges for a whole dictionary
