"""The command line over page files and golden statements."""

import json

from tallyforge import cli
from tallyforge.sources import xlsx

PAGE = "SCHEDULE 6 inventories\nRaw materials 2,00,000 1,00,000\nFinished goods 60,000 50,000\nSundry debtors 30,000 20,000"


def test_extract_and_verify(spark, tmp_path, capsys):
    (tmp_path / "doc1").mkdir()
    (tmp_path / "doc1" / "page_1.txt").write_text(PAGE)
    out = str(tmp_path / "out")
    golden = {"company": "c", "block_d": [{"sl_no": 1, "opening_rs": 100000, "closing_rs": 200000}, {"sl_no": 6, "opening_rs": 50000, "closing_rs": 60000}]}
    (tmp_path / "doc1.json").write_text(json.dumps(golden))
    code = cli.main(["extract", "--pages", f"{tmp_path}/*/page_*.txt", "--out", out, "--golden", f"{tmp_path}/doc1.json"])
    assert code == 1 and "100.00% (4 of 4 fields, 0 missing)" in capsys.readouterr().out  # few rows are there: not publishable
    assert cli.main(["verify", "--cells", f"{out}/cells", "--golden", f"{tmp_path}/doc1.json"]) == 0
    book = xlsx.read_workbook(bytes(spark.read.parquet(f"{out}/workbooks").first().content))
    assert book["Block D"][4][2:] == [100000.0, 200000.0] and len(book["Block C"]) == 11
    golden["block_d"][0]["closing_rs"] = 1
    (tmp_path / "doc1.json").write_text(json.dumps(golden))
    assert cli.main(["verify", "--cells", f"{out}/cells", "--golden", f"{tmp_path}/doc1.json"]) == 1
