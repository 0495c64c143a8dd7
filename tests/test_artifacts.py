from __future__ import annotations

import json
import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from kinetable.operators import evaluate
from kinetable.plans.jobs import experiment_table
from kinetable.sources import artifacts
from kinetable.sources.staging import StageArea


def text_of(folder):
    (part,) = folder.glob("part-*")
    return part.read_text()


@pytest.mark.parametrize(
    "write",
    [
        artifacts.write_features,
        artifacts.write_record,
        artifacts.write_csv,
    ],
)
def test_writers_refuse_to_overwrite(spark, tmp_path, write):
    frame = spark.createDataFrame([("v",)], "name string")
    write(frame, f"{tmp_path}/out")
    before = sorted(path.name for path in (tmp_path / "out").iterdir())
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write(frame, f"{tmp_path}/out")
    assert sorted(path.name for path in (tmp_path / "out").iterdir()) == before


def test_record_is_one_object_with_sorted_keys(spark, tmp_path):
    frame = spark.createDataFrame([(2, None, {"k": 1})], "b int, a string, c map<string,int>")
    artifacts.write_record(frame, f"{tmp_path}/record")
    assert text_of(tmp_path / "record") == '{"a":null,"b":2,"c":{"k":1}}\n'


def test_metrics_are_read_back(spark, tmp_path):
    cells = evaluate.confusion_counts(
        spark.createDataFrame([("A", "A"), ("A", "B")], "actual string, predicted string")
    )
    record = evaluate.metrics_record(
        cells, ["A", "B"], model="m", split_counts={"test": 2}, training_seconds=1.0
    )
    artifacts.write_record(record, f"{tmp_path}/metrics_json")
    stored = artifacts.read_metrics(spark, f"{tmp_path}/metrics_json").first()
    for name in artifacts.read_metrics(spark, f"{tmp_path}/metrics_json").columns:
        assert stored[name] == record.first()[name], name


def test_pretty_printed_files_are_read_too(spark, tmp_path):
    metrics = {"model": "m", "accuracy": 0.5, "macro_f1": 0.25, "test_predictions": 4, "labels": ["A"]}
    (tmp_path / "metrics.json").write_text(json.dumps(metrics, indent=2, sort_keys=True))
    cells = [{"actual": "A", "predicted": p, "count": n} for p, n in (("A", 1), ("B", 3))]
    (tmp_path / "confusion.json").write_text(json.dumps(cells, indent=2))
    (tmp_path / "rows.json").write_text(json.dumps({"model": "m", "rows": cells}))
    assert artifacts.read_metrics(spark, f"{tmp_path}/metrics.json").first()["labels"] == ["A"]
    for name in ("confusion", "rows"):
        stored = artifacts.read_confusion(spark, f"{tmp_path}/{name}.json")
        assert sorted(map(tuple, stored.collect())) == [("A", "A", 1), ("A", "B", 3)]


def test_experiment_table_and_csv(spark, tmp_path):
    runs = {}
    for condition, accuracy in (("near", 0.5), ("far", 0.75)):
        path = f"{tmp_path}/{condition}.json"
        with open(path, "w") as out:
            json.dump({"model": "m", "accuracy": accuracy, "test_predictions": 9}, out)
        runs[condition] = [path]
    table = experiment_table(spark, runs, f"{tmp_path}/csv")
    assert table.columns == list(artifacts.SUMMARY_COLUMNS)
    assert text_of(tmp_path / "csv").splitlines() == [
        "condition,model,accuracy,macro_f1,training_seconds,inference_seconds,test_windows",
        "near,m,0.5,,,,9",
        "far,m,0.75,,,,9",
    ]


def test_an_experiment_table_needs_runs(spark, tmp_path):
    with pytest.raises(ValueError, match="no run"):
        experiment_table(spark, {})
    with pytest.raises(FileExistsError):
        experiment_table(spark, {"near": ["unread"]}, str(tmp_path))


def test_run_ids_are_utc_seconds():
    assert re.fullmatch(r"\d{8}T\d{6}Z", artifacts.new_run_id())


def session_with(**settings):
    """A stand-in with nothing but settings: the real ones are fixed at start."""
    named = {name.replace("_", "."): value for name, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=named.get))


def test_stage_area_uses_the_shared_folder():
    areas = [StageArea(session_with(spark_checkpoint_dir="/shared/")) for _ in range(2)]
    assert all(area.path.startswith("/shared/stage-") for area in areas)
    assert areas[0].path != areas[1].path
    without = session_with(spark_sql_warehouse_dir="/warehouse")
    assert StageArea(without).path.startswith("/warehouse/stage-")


def test_staged_tables_are_written_once_and_removed(spark):
    stage = StageArea(spark)
    stored = stage.table(spark.range(5), "numbers")
    assert stored.columns == ["id"]
    assert stored.count() == 5
    with pytest.raises(AnalysisException):
        stage.table(spark.range(5), "numbers")
    folder = Path(stage.path.removeprefix("file:"))
    assert folder.is_dir()
    stage.remove()
    assert not folder.exists()
