import json

import pytest

from skyphrase.cli import main
from skyphrase.plans import generate
from skyphrase.progress import Progress


def test_version(capsys):
    assert main(["version"]) == 0 and capsys.readouterr().out.strip() == "0.1.0"


def test_sample(spark, capsys):
    assert main(["data", "sample", "-n", "2", "--seed", "9"], spark) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert len(rows) == 2 and rows[0]["region"] == "us" and "sid_star" in rows[0]


@pytest.mark.parametrize(
    "args",
    [["data", "sample", "--regions", ","], ["data", "sample", "--regions", "mars"], ["data", "sample", "--weighter", "odd"], ["data", "sample", "--weighter", "custom"], ["data", "sample", "--config", "nowhere"],
     ["data", "benchmark", "--model", "stub", "--concurrencies", "1,x"], ["data", "sample", "-n", "-1"], ["data", "generate", "--model", "stub", "--out", "/tmp/none", "--count", "-5"],
     ["data", "generate", "--model", "stub", "--out", "/tmp/none", "--count", "5", "--shard-size", "0"], ["voices", "build", "--out", "/tmp/none", "--target", "-1"],
     ["voices", "build", "--out", "/tmp/none", "--min-duration-s", "9", "--max-duration-s", "8"], ["data", "benchmark", "--model", "stub", "--per-point", "0"], ["voices", "build", "--out", "/tmp/none", "--sources", ","], ["voices", "build", "--out", "/tmp/none", "--sources", "odd"]],
)
def test_bad_arguments(spark, args, capsys):
    assert main(args, spark) == 2 and capsys.readouterr().err


def test_generate_resume_and_regenerate(spark, tmp_path, capsys):
    out = (tmp_path / "run").as_uri()
    base = ["data", "generate", "--model", "stub", "--out", out, "--concurrency", "4", "--shard-size", "10"]
    assert main([*base, "--count", "20"], spark) == 0
    first = json.loads((tmp_path / "run" / "manifest.json").read_text())
    failures = spark.read.text(f"{out}/failures.jsonl").count()
    assert first["total_rows"] + failures == 20 and failures > 0
    assert main([*base, "--count", "30"], spark) == 0
    second = json.loads((tmp_path / "run" / "manifest.json").read_text())
    assert second["total_rows"] + spark.read.text(f"{out}/failures.jsonl").count() == 30
    shards = spark.read.parquet(f"{out}/shard-*.parquet")
    assert shards.count() == shards.select("scenario_id").distinct().count() == second["total_rows"]
    assert main([*base, "--count", "30", "--seed", "1"], spark) == 2
    log = (tmp_path / "run" / "run.log").read_text().splitlines()
    assert len(log) >= 2 and all("done=" in line and "rate=" in line for line in log)
    capsys.readouterr()
    assert main(["data", "inspect", "--out", out], spark) == 0
    assert json.loads(capsys.readouterr().out)["rows"] == second["total_rows"]
    to = (tmp_path / "pushed").as_uri()
    assert main(["data", "push", "--out", out, "--to", to], spark) == 0
    sent = capsys.readouterr().out.split()
    assert sent[-1] == "manifest.json" and len(sent) > 2 and all(name.startswith("shard-") for name in sent[:-1])
    assert spark.read.parquet(f"{to}/shard-*.parquet").count() == second["total_rows"] and not (tmp_path / "pushed" / "failures.jsonl").exists()
    assert main(["data", "push", "--out", out, "--to", to], spark) == 0 and capsys.readouterr().out.split() == ["manifest.json"]
    assert main(["data", "push", "--out", (tmp_path / "nothing").as_uri(), "--to", to], spark) == 1
    assert main(["data", "regenerate", "--out", out], spark) == 0
    assert len(list((tmp_path / "run").glob("failures.2*"))) == 1
    assert main(["data", "regenerate", "--out", (tmp_path / "none").as_uri()], spark) == 1


def test_sweep(spark, tmp_path, capsys):
    path = tmp_path / "r.json"
    assert main(["data", "benchmark", "--model", "stub", "--concurrencies", "2,4", "--per-point", "10", "--results-json", str(path)], spark) == 0
    found = json.loads(path.read_text())
    assert [p["concurrency"] for p in found["points"]] == [2, 4] and all(p["ok"] + p["fail"] == 10 for p in found["points"]) and found["best"] in found["points"]
    assert generate.point(0, 0, 0.0, 1) == {"concurrency": 1, "ok": 0, "fail": 0, "wall_sec": 0.0, "rate_per_sec": 0.0, "fail_pct": 0.0}


def test_progress():
    lines, now = [], [0.0]
    log = Progress(100, lines.append, 5.0, started_at=20, clock=lambda: now[0])
    assert log.log(20) and not log.log(21)
    now[0] = 10.0
    assert log.log(40, ok=3) and lines[-1] == "done=40/100 pct=40.0 rate=2.00/s eta=30s ok=3"
    assert log.log(40, force=True)
