"""The commands, end to end over fixtures."""

import json

from harrow import cli

BASE = "https://catalog.test/"


def test_commands(spark, tmp_path, capsys):
    link = '<a class="search-list__item_link" href="/catalog/A/">x</a>'
    answers = [
        {"url": f"{BASE}search/?q=x", "status": 200, "body": f"Найдено 1 результатов {link}"},
        {"url": f"{BASE}search/?q=x&PAGEN_1=2", "status": 200, "body": ""},
        {"url": f"{BASE}catalog/A/", "status": 200, "body": "<h1>A</h1>"},
    ]
    fixtures, db = tmp_path / "f.jsonl", str(tmp_path / "db")
    fixtures.write_text("\n".join(map(json.dumps, answers)))
    out = tmp_path / "a.jsonl"
    assert cli.main(["crawl", "--db", db, "--base-url", BASE, "--query", "x", "--fixtures", str(fixtures), "--export-jsonl", str(out)]) == 0
    assert json.loads(out.read_text())["metadata"]["title"] == "A"
    assert cli.main(["validate-coverage", "--db", db, "--show-all"]) == 0
    assert cli.main(["report", "--db", db]) == 0
    assert cli.main(["enqueue-ids", "--db", db, "--id", "B", "--id", "A"]) == 0
    assert "enqueued 1" in capsys.readouterr().out
    assert cli.main(["crawl", "--db", db, "--base-url", BASE, "--no-discover", "--fixtures", str(fixtures)]) == 0
    assert cli.main(["retry-failed", "--db", db, "--http-status", "403"]) == 0
    assert cli.main(["stats", "--db", db]) == 0
    assert "'missing': 1" in capsys.readouterr().out
    assert cli.main(["export-jsonl", "--db", db, "--output", str(tmp_path / "b.jsonl.gz")]) == 0
    assert cli.main(["export-parquet", "--db", db, "--output", str(tmp_path / "b.parquet")]) == 0
    assert cli.main(["export-manifest", "--db", db, "--output", str(tmp_path / "m.json"), "--dataset-name", "d", "--file", str(out)]) == 0
    assert json.loads((tmp_path / "m.json").read_text())["outputs"][0]["bytes"] == out.stat().st_size
