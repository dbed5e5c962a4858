"""The pointer's log: one of two racing writers wins, and retention keeps what is named."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from gridlark.plans.training import current_pointer, current_run_id, point_to, pointers, remove_expired
from gridlark.sources.metrics import write_json, write_metrics
from gridlark.sources.versions import Outdated, append, folders, latest, versions


def test_versions_are_created_once(spark, tmp_path):
    log = str(tmp_path / "log")
    assert latest(spark, log) is None and versions(spark, log) == []
    assert append(spark, log, {"run_id": "a"}, 0).number == 1
    with pytest.raises(Outdated):
        append(spark, log, {"run_id": "b"}, 0)
    with pytest.raises(Outdated):
        append(spark, log, {"run_id": "b"}, 5)
    append(spark, log, {"run_id": "b"}, 1)
    assert [v.entry["run_id"] for v in versions(spark, log)] == ["a", "b"] and latest(spark, log).number == 2
    # A version that is still being written doesn't count, but nobody else may take its number.
    open(f"{log}/000000000003.json", "w").close()
    assert latest(spark, log).number == 2
    with pytest.raises(Outdated):
        append(spark, log, {"run_id": "c"}, 2)


def test_racing_promotions(spark, tmp_path):
    folder = str(tmp_path / "runs")
    point_to(spark, folder, "r0", "2024-01-01")
    for turn in range(5):
        seen, _ = current_pointer(spark, folder)

        def promote(name, seen=seen):
            try:
                return point_to(spark, folder, name, "2024-01-02", seen)
            except Outdated:
                return None

        with ThreadPoolExecutor(8) as pool:
            won = [(n, v) for n, v in zip(range(8), pool.map(promote, [f"t{turn}-{k}" for k in range(8)])) if v]
        assert len(won) == 1 and current_run_id(spark, folder) == f"t{turn}-{won[0][0]}"
    assert pointers(spark, folder).count() == 6
    assert not [n for n in os.listdir(f"{folder}/pointers") if n.endswith(".part")]


def test_retention(spark, tmp_path):
    folder = str(tmp_path / "runs")
    metrics = spark.createDataFrame([("m", "r2_score", 0.5)], "model string, metric string, value double")
    for day in range(1, 9):
        home = f"{folder}/run_id=r{day}"
        write_json(spark.createDataFrame([(f"2024-01-0{day}",)], "run_at string"), f"{home}/stamp")
        if day != 2:
            write_metrics(metrics, f"{home}/metrics")
    for run in ("r7", "r1", "r3"):
        point_to(spark, folder, run, "2024-02-01")
    # r2 is incomplete, r1 and r3 are named last, r7 and r8 are the newest two.
    assert remove_expired(spark, folder, "2024-06-01", keep=2) == ["r4", "r5", "r6"]
    assert folders(spark, folder, "run_id=") == ["r1", "r2", "r3", "r7", "r8"]
    assert remove_expired(spark, folder, "2024-01-10", keep=0) == []
    assert remove_expired(spark, str(tmp_path / "none"), "2024-01-10") == []
