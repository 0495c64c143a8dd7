from __future__ import annotations

import json
import math
import os
import random
import subprocess
import sys
import zipfile
from pathlib import Path
from types import SimpleNamespace

import pytest

from kinetable import submit
from kinetable.operators.learn import ModelSettings
from kinetable.plans import jobs
from kinetable.plans.settings import JobSettings, partitions_for, session_options
from kinetable.sources.staging import StageArea
from kinetable.sources.text import input_bytes

SETTINGS = JobSettings(
    window_seconds=5,
    minimum_samples=70,
    models=ModelSettings(max_iter=5, num_trees=3, max_depth=3),
)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"train_fraction": 0.0, "test_fraction": 0.85}, "above zero"),
        ({"train_fraction": 0.8}, "add up"),
        ({"window_seconds": 0}, "window_seconds"),
        ({"minimum_samples": 1}, "minimum_samples"),
        ({"device": "tablet"}, "device"),
        ({"sensors": ()}, "sensors"),
        ({"sensors": ("light",)}, "sensors"),
        ({"sensors": ("accel", "accel")}, "twice"),
    ],
)
def test_settings_are_checked(change, message):
    with pytest.raises(ValueError, match=message):
        JobSettings(**change)


def test_session_options_never_choose_a_master():
    assert "spark.master" not in session_options("x")
    assert session_options("x", shuffle_partitions=8)["spark.sql.shuffle.partitions"] == "8"


def test_partitions_follow_the_input():
    assert partitions_for(0) == partitions_for(10 << 20) == 64
    assert partitions_for(100 << 30) == 400
    # 100 TB, and far more than that.
    assert partitions_for(10**14) == 100_000
    assert partitions_for(10**13) == 37_253
    assert partitions_for(10**18) == 100_000
    sizes = [partitions_for(1 << power) for power in range(20, 60)]
    assert sizes == sorted(sizes)


def test_input_size_comes_from_the_listing(spark, raw):
    files = list(Path(raw).glob("*/*/*.txt"))
    assert len(files) == 40
    assert input_bytes(spark, f"{raw}/*/*/*.txt") == sum(file.stat().st_size for file in files)


def test_stage_folder(spark, tmp_path, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir")
    assert StageArea(spark, below="/elsewhere").path.startswith(named)
    unset = SimpleNamespace(
        conf=SimpleNamespace(
            get=lambda name, *default: "file:/here" if "warehouse" in name else default[0]
        ),
        sparkContext=SimpleNamespace(master="local[2]"),
    )
    assert StageArea(unset, below="s3://out/run").path.startswith("s3://out/run/stage-")
    assert StageArea(unset).path.startswith("file:/here/stage-")
    unset.sparkContext.master = "spark://some:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        StageArea(unset)
    assert StageArea(unset, below="s3://out/run").path.startswith("s3://out/run/stage-")


def test_submit_arguments(capsys):
    given = submit.arguments(["run", "--raw", "r", "--output", "o", "--sensors", "accel"])
    assert (given.job, given.sensors, given.seed) == ("run", ["accel"], 42)
    with pytest.raises(SystemExit):
        submit.arguments(["train", "--output", "o"])
    assert "--features" in capsys.readouterr().err


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Two sensors of 20 subjects at 20 Hz, 20 s per activity; some lines are broken."""
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(1)
    for s, sensor in enumerate(("accel", "gyro")):
        (folder / "watch" / sensor).mkdir(parents=True)
        for subject in range(1600, 1620):
            lines = []
            for a, activity in enumerate("ABC"):
                for i in range(400):
                    time = 50_000_000 * i + a * 10**12
                    swing = (a + 1) * math.sin(i / 9)
                    x, y, z = (swing + rng.gauss(s, 0.1) for _ in range(3))
                    lines.append(f"{subject},{activity},{time},{x},{y},{z};")
            lines[10] = "broken"
            (folder / "watch" / sensor / f"data_{subject}.txt").write_text("\n".join(lines))
    return str(folder)


@pytest.fixture(scope="module")
def finished(spark, raw, tmp_path_factory):
    output = tmp_path_factory.mktemp("out") / "run"
    metrics = jobs.run(spark, f"{raw}/*/*/*.txt", str(output), SETTINGS)
    return output, metrics


def record(folder):
    (part,) = folder.glob("part-*")
    return json.loads(part.read_text())


def test_run_writes_the_whole_layout(finished):
    output, metrics = finished
    assert {path.name for path in output.iterdir()} == {
        "features",
        "data_summary_json",
        "logistic_regression",
        "random_forest",
        "comparison_json",
    }
    for model in ("logistic_regression", "random_forest"):
        assert {path.name for path in (output / model).iterdir()} == {
            "model",
            "metrics_json",
            "confusion_json",
        }
        assert (output / model / "model" / "metadata").is_dir()
    rows = {row["model"]: row for row in metrics.collect()}
    assert set(rows) == {"logistic_regression", "random_forest"}
    comparison = record(output / "comparison_json")
    for model, row in rows.items():
        assert comparison[model]["accuracy"] == row["accuracy"] > 0.8
        confusion = record(output / model / "confusion_json")
        assert confusion["model"] == model
        assert len(confusion["rows"]) == 9
        total = sum(cell["count"] for cell in confusion["rows"])
        hits = sum(c["count"] for c in confusion["rows"] if c["actual"] == c["predicted"])
        assert total == row["test_predictions"]
        assert hits / total == pytest.approx(row["accuracy"])
        assert len(row["feature_columns"]) == 36


def test_a_split_reads_its_own_files(spark, finished):
    output, _ = finished
    features = spark.read.parquet(f"{output}/features")
    assert features.columns[-2:] == ["subject_rank", "split"]
    plan = features.where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert {row["split"] for row in features.select("split").distinct().collect()} == {
        "train",
        "validation",
        "test",
    }


def test_summary_of_a_run(finished):
    output, _ = finished
    summary = record(output / "data_summary_json")
    assert summary["parse_counts"] == {"true": 2 * 20 * 1199, "false": 40}
    assert summary["feature_windows"] == 20 * 3 * 4
    assert (summary["subjects"], summary["activities"]) == (20, 3)
    # The cut after 0.85 of 20 subjects is int(17.0); 14 + 3 + 3.
    assert summary["split_subjects"] == {"train": 14, "validation": 3, "test": 3}
    assert summary["split_windows"] == {"train": 168, "validation": 36, "test": 36}
    assert summary["sensors"] == ["accel", "gyro"]
    assert summary["preprocessing_seconds"] > 0
    # Observed in the pass itself: all lines, good and bad.
    assert summary["lines"] == 2 * 20 * 1200
    seconds = summary["lines"] / summary["lines_per_second"]
    assert seconds == pytest.approx(summary["preprocessing_seconds"])


def test_an_existing_run_is_refused_before_any_work(spark, raw, finished, monkeypatch):
    output, _ = finished

    def never(*_):
        raise AssertionError("work was started")

    monkeypatch.setattr(jobs, "StageArea", never)
    features = spark.read.parquet(f"{output}/features")
    with pytest.raises(FileExistsError, match="refusing"):
        jobs.run(spark, f"{raw}/*/*/*.txt", str(output), SETTINGS)
    with pytest.raises(FileExistsError, match="refusing"):
        jobs.prepare(spark, f"{raw}/*/*/*.txt", str(output), SETTINGS)
    with pytest.raises(FileExistsError, match="logistic_regression"):
        jobs.compare_models(features, SETTINGS, str(output))
    with pytest.raises(FileExistsError, match="refusing"):
        jobs.train(spark, f"{output}/features", str(output), SETTINGS)


def test_train_from_stored_features(spark, finished, tmp_path):
    output, metrics = finished
    again = jobs.train(spark, f"{output}/features", f"{tmp_path}/again", SETTINGS)
    accuracy = {row["model"]: row["accuracy"] for row in metrics.collect()}
    repeated = {row["model"]: row["accuracy"] for row in again.collect()}
    assert repeated == pytest.approx(accuracy)
    summary = record(tmp_path / "again" / "data_summary_json")
    assert summary["prepared_feature_path"] == f"{output}/features"
    assert "parse_counts" not in summary
    assert summary["feature_windows"] == 240


def test_single_sensor_features(spark, raw, tmp_path):
    settings = JobSettings(sensors=("accel",), window_seconds=5, minimum_samples=70)
    features = jobs.prepare(spark, f"{raw}/watch/accel/*.txt", f"{tmp_path}/one", settings)
    assert "sensor" in features.columns
    assert "x_mean" in features.columns
    assert features.count() == 240


def test_no_window_with_enough_samples(spark, raw, tmp_path):
    settings = JobSettings(window_seconds=5, minimum_samples=1000)
    features = jobs.prepare(spark, f"{raw}/*/*/*.txt", f"{tmp_path}/none", settings)
    summary = record(tmp_path / "none" / "data_summary_json")
    assert (summary["feature_windows"], summary["subjects"]) == (0, 0)
    assert summary["split_windows"] == {}
    with pytest.raises(ValueError, match="no rows in split train"):
        jobs.compare_models(features, settings, f"{tmp_path}/none")


def test_lines_are_read_once(spark, raw):
    """The stored window table is all that later steps read."""
    from kinetable.sources.text import read_lines

    stage = StageArea(spark)
    prepared = jobs.prepare_features(read_lines(spark, f"{raw}/*/*/*.txt"), SETTINGS, stage)
    for frame in (prepared.features, prepared.quality):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan
    stage.remove()


@pytest.fixture
def session_as_before(spark):
    """Submitting sets options on the running session; put the old ones back."""
    before = {name: spark.conf.get(name, None) for name in session_options("x")}
    yield
    for name, value in before.items():
        if not spark.conf.isModifiable(name):
            continue
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def test_submitted_job(spark, raw, tmp_path, capsys, session_as_before):
    submit.main(
        [
            "prepare",
            "--raw",
            f"{raw}/*/*/*.txt",
            "--output",
            str(tmp_path),
            "--window-seconds",
            "5",
            "--minimum-samples",
            "70",
        ]
    )
    (run,) = tmp_path.iterdir()
    assert capsys.readouterr().out.strip().endswith(run.name)
    assert spark.read.parquet(f"{run}/features").count() == 240


def test_whole_run_from_the_zip(raw, tmp_path):
    """``spark-submit`` with the packaged library, in a process of its own."""
    root = Path(submit.__file__).resolve().parents[1]
    package = tmp_path / "kinetable.zip"
    with zipfile.ZipFile(package, "w") as packed:
        for module in sorted((root / "kinetable").rglob("*.py")):
            if "llm" not in module.parts:
                packed.write(module, module.relative_to(root))
    options = {
        "spark.master": "local[2]",
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.sql.warehouse.dir": f"file:{tmp_path}/warehouse",
    }
    launched = [sys.executable, "-c", "from pyspark.find_spark_home import _find_spark_home as f; print(f())"]
    home = subprocess.run(launched, capture_output=True, text=True, check=True).stdout.strip()
    command = [f"{home}/bin/spark-submit", "--py-files", str(package)]
    for name, value in options.items():
        command += ["--conf", f"{name}={value}"]
    command += [
        *(f"{root}/kinetable/submit.py", "run", "--raw", f"{raw}/*/*/*.txt"),
        *("--output", f"{tmp_path}/runs", "--window-seconds", "5", "--minimum-samples", "70"),
        *("--max-iter", "5", "--num-trees", "3", "--max-depth", "3"),
    ]
    # Elsewhere, and without this repository on the path: only the package is there.
    environment = {
        name: value for name, value in os.environ.items() if name not in ("PYTHONPATH", "SPARK_HOME")
    }
    environment["PYSPARK_PYTHON"] = environment["PYSPARK_DRIVER_PYTHON"] = sys.executable
    done = subprocess.run(
        command, cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-2000:]
    (run,) = (tmp_path / "runs").iterdir()
    assert done.stdout.strip().endswith(run.name)
    comparison = record(run / "comparison_json")
    assert set(comparison) == {"logistic_regression", "random_forest"}
    for metrics in comparison.values():
        assert metrics["split_counts"] == {"train": 168, "validation": 36, "test": 36}
        assert metrics["accuracy"] > 0.8
    assert {path.name for path in run.iterdir()} == {
        "features",
        "data_summary_json",
        "logistic_regression",
        "random_forest",
        "comparison_json",
    }
