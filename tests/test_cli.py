import json

import pytest

from tests import reports as fixture
from tidemark.__main__ import main


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return fixture.write(tmp_path_factory.mktemp("cli") / "reports")


def test_reading_commands(spark, root, tmp_path, capfd):
    main(["index", "--reports", root, "--out", f"{tmp_path}/index"])
    assert "[[NVIDIA]]" in "".join(r.value for r in spark.read.text(f"{tmp_path}/index").collect())
    main(["graph", "--reports", root, "--min-weight", "1", "--out", f"{tmp_path}/graph"])
    assert json.loads(spark.read.text(f"{tmp_path}/graph/json").first().value)["links"]
    main(["themes", "--reports", root, "--theme", "HBM", "--out", f"{tmp_path}/themes"])
    main(["audit", "--reports", root, "--catalogue", root.rsplit("/", 1)[0] + "/task.md"])
    main(["discover", "--reports", root, "--out", f"{tmp_path}/linked", "--hits", f"{tmp_path}/hits", "AI"])
    assert spark.read.parquet(f"{tmp_path}/hits").filter("ticker = '1101' and bare > 0").count() == 1
    assert "[[AI]] 晶片" in spark.read.parquet(f"{tmp_path}/linked").filter("ticker = '1101'").first().content
    assert "HBM" in capfd.readouterr().out


def test_enrich_command(spark, root, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"1101": {"cust": "- new"}, "1102": {"cust": "- new"}}), encoding="utf-8")
    main(["enrich", "--reports", root, "--patches", f"{tmp_path}/p.json", "--out", f"{tmp_path}/v2", "1101"])
    got = {r.ticker: r.content for r in spark.read.parquet(f"{tmp_path}/v2").collect()}
    assert "- new" in got["1101"] and "- new" not in got["1102"] and len(got) == 4
