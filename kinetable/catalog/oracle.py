"""The registered queries in SQL, over the same tables.

Each statement is a chain of named views; ``_sql`` puts the ones a query needs in
front of its final select.
"""

from __future__ import annotations

from ..operators.windows import FEATURE_NAMES
from .fixtures import LABELS, SENSORS, SETTINGS, TIE_BREAK

_WINDOW_NS = SETTINGS.window_seconds * 1_000_000_000
_TRAIN = f"cast({SETTINGS.train_fraction!r} as double)"
_VALIDATION = f"cast({SETTINGS.train_fraction + SETTINGS.validation_fraction!r} as double)"


def _round(expression: str) -> str:
    return f"round({expression} + cast({TIE_BREAK!r} as double), 6) + 0.0"


def _round_feature(name: str) -> str:
    return name if name.endswith(("_min", "_max")) else f"{_round(name)} as {name}"


_FUSED_NAMES = [f"{sensor}_{name}" for sensor in SENSORS for name in FEATURE_NAMES]
_FUSED_COUNTS = [f"{sensor}_sample_count" for sensor in SENSORS]
_FUSED_KEYS = "subject_id, activity, device, window_id"
_FUSED_ROUNDED = ", ".join([*_FUSED_COUNTS, *map(_round_feature, _FUSED_NAMES)])

_ACTIVITY = "translate(substring(event_type, 1, 1), 'cepsv', 'ABCDE')"
_SENSOR = "case when event_id % 2 = 0 then 'accel' else 'gyro' end"
_NANOS = "epoch_us(ts) * 1000"
_K = "json_extract_string(props, '$.k')"

_SAMPLES = f"""
    select cast(user_id as integer) as subject_id, {_ACTIVITY} as activity,
           {_NANOS} as timestamp_ns, 'watch' as device, {_SENSOR} as sensor,
           value as x, cast({_K} as double) as y, cast(event_id % 3 as double) as z
    from events
"""

_RAW_LINES = f"""
    select case event_id % 50
             when 4 then '/raw/tablet/accel/a.txt'
             when 8 then '/raw/watch/light/a.txt'
             else '/raw/Watch/' || {_SENSOR} || '/a.txt' end as source_file,
           case when event_id % 50 = 9 then '1.5' else cast(user_id as varchar) end || ',' ||
           case event_id % 50
             when 1 then 'N'
             when 7 then lower({_ACTIVITY})
             when 10 then ' ' || {_ACTIVITY} || ' '
             else {_ACTIVITY} end || ',' ||
           case event_id % 50
             when 2 then 'x'
             when 3 then '-5'
             else cast({_NANOS} as varchar) end || ',' ||
           case when event_id % 50 = 11 then '' else cast(value as varchar) end || ',' ||
           {_K} ||
           case event_id % 50
             when 0 then ''
             when 5 then ',' || cast(event_id % 3 as varchar) || ';  '
             when 6 then ',' || cast(event_id % 3 as varchar)
             else ',' || cast(event_id % 3 as varchar) || ';' end as value
    from events
"""

_FIELDS = r"""
    select value as raw_line, source_file, lower(source_file) as path,
           string_split(regexp_replace(trim(value), ';\s*$', ''), ',') as f
    from raw_lines
"""

_TYPED = """
    select raw_line, source_file,
           case when path like '%/phone/%' then 'phone'
                when path like '%/watch/%' then 'watch' else 'unknown' end as device,
           case when path like '%/accel/%' then 'accel'
                when path like '%/gyro/%' then 'gyro' else 'unknown' end as sensor,
           cast(len(f) as integer) as field_count,
           case when regexp_full_match(trim(f[1]), '[+-]?[0-9]+([.][0-9]*)?')
                then try_cast(regexp_extract(trim(f[1]), '^[+-]?[0-9]+') as integer)
                when regexp_full_match(trim(f[1]), '[+-]?[.][0-9]*') then 0 end as subject_id,
           trim(f[2]) as activity,
           case when regexp_full_match(trim(f[3]), '[+-]?[0-9]+([.][0-9]*)?')
                then try_cast(regexp_extract(trim(f[3]), '^[+-]?[0-9]+') as bigint)
                when regexp_full_match(trim(f[3]), '[+-]?[.][0-9]*') then 0 end as timestamp_ns,
           try_cast(f[4] as double) as x, try_cast(f[5] as double) as y,
           try_cast(f[6] as double) as z
    from fields
"""

_PARSED = """
    select *, coalesce(field_count = 6
             and regexp_full_match(activity, '[A-S]') and activity <> 'N'
             and subject_id is not null and timestamp_ns is not null
             and x is not null and y is not null and z is not null
             and timestamp_ns >= 0
             and device in ('phone', 'watch') and sensor in ('accel', 'gyro'),
             false) as _parse_ok
    from typed
"""

_VALID = """
    select subject_id, activity, timestamp_ns, device, sensor, x, y, z
    from parsed
    where _parse_ok and device = 'watch' and sensor in ('accel', 'gyro')
"""


def _defined(expression: str) -> str:
    value = f"({expression})"
    return f"case when {value} is null or isnan({value}) then 0.0 else {value} end"


def _windows(source: str) -> str:
    measures = []
    for axis in "xyz":
        measures += [f"avg({axis})", f"stddev_samp({axis})", f"min({axis})", f"max({axis})"]
    measures += [
        "avg(sqrt(x * x + y * y + z * z))",
        "stddev_samp(sqrt(x * x + y * y + z * z))",
        "avg(x * x + y * y + z * z)",
        "corr(x, y)",
        "corr(x, z)",
        "corr(y, z)",
    ]
    listed = ", ".join(
        f"{_defined(measure)} as {name}"
        for name, measure in zip(FEATURE_NAMES, measures, strict=True)
    )
    return f"""
        select subject_id, activity, device, sensor, timestamp_ns // {_WINDOW_NS} as window_id,
               count(*) as sample_count, {listed}
        from {source}
        group by subject_id, activity, device, sensor, timestamp_ns // {_WINDOW_NS}
        having count(*) >= {SETTINGS.minimum_samples}
    """


_FUSED = f"""
    select {_FUSED_KEYS},
           {", ".join(f"{s}.sample_count as {s}_sample_count" for s in SENSORS)},
           {", ".join(f"{s}.{n} as {s}_{n}" for s in SENSORS for n in FEATURE_NAMES)}
    from (select * from windows where sensor = 'accel') accel
    join (select * from windows where sensor = 'gyro') gyro
      using ({_FUSED_KEYS})
"""

_SPLITS = f"""
    select subject_id, cast(subject_rank as integer) as subject_rank,
           case when subject_rank < floor(subjects * {_TRAIN}) then 'train'
                when subject_rank < floor(subjects * {_VALIDATION}) then 'validation'
                else 'test' end as split
    from (
        select subject_id, count(*) over () as subjects,
               row_number() over (order by sha256('{SETTINGS.seed}:' || subject_id)) - 1
                   as subject_rank
        from (select distinct subject_id from fused) one_per_subject
    ) ranked
"""

_FEATURES = "select * from fused join splits using (subject_id)"

_PREDICTIONS = f"""
    select event_id, {_ACTIVITY} as actual,
           case when event_id % 3 <> 0 then {_ACTIVITY}
                else substring('ABCD', cast(event_id % 4 as integer) + 1, 1) end as predicted
    from events
"""

_LABELS = f"select unnest([{', '.join(repr(label) for label in LABELS)}]) as label"


def _evaluation(pairs: str) -> dict[str, str]:
    """Views from pairs of labels to metrics."""
    return {
        "cells": f"select actual, predicted, count(*) as n from {pairs} group by actual, predicted",
        "dense": """
            select a.label as actual, p.label as predicted, coalesce(n, 0) as n
            from labels a cross join labels p
            left join cells on cells.actual = a.label and cells.predicted = p.label
        """,
        "totals": """
            select label as activity,
                   (select coalesce(sum(n), 0) from cells where actual = label) as support,
                   (select coalesce(sum(n), 0) from cells where predicted = label) as guessed,
                   (select coalesce(sum(n), 0) from cells
                     where actual = label and predicted = label) as hits
            from labels
        """,
        "rates": """
            select activity, cast(support as bigint) as support, hits,
                   case when guessed = 0 then 0.0 else hits / cast(guessed as double) end
                       as precision,
                   case when support = 0 then 0.0 else hits / cast(support as double) end
                       as recall
            from totals
        """,
        "per_class": """
            select *, case when precision + recall = 0 then 0.0
                           else 2 * precision * recall / (precision + recall) end as f1
            from rates
        """,
        "overall": """
            select sum(hits) / cast(sum(support) as double) as accuracy,
                   sum(f1 * support) / sum(support) as weighted_f1,
                   avg(precision) as macro_precision, avg(recall) as macro_recall,
                   avg(f1) as macro_f1, cast(sum(support) as bigint) as test_predictions
            from per_class
        """,
    }


_PARSE_VIEWS = {
    "raw_lines": _RAW_LINES,
    "fields": _FIELDS,
    "typed": _TYPED,
    "parsed": _PARSED,
    "valid": _VALID,
}
_FEATURE_VIEWS = {"fused": _FUSED, "splits": _SPLITS, "features": _FEATURES}
_SAMPLE_VIEWS = {"samples": _SAMPLES, "windows": _windows("samples"), **_FEATURE_VIEWS}
_PREPARED_VIEWS = {**_PARSE_VIEWS, "windows": _windows("valid"), **_FEATURE_VIEWS}
_SINGLE_SENSOR_VIEWS = {**_PREPARED_VIEWS, "fused": "select * from windows where sensor = 'accel'"}
_LABEL_VIEWS = {
    **_SAMPLE_VIEWS,
    "label_index": """
        select activity, cast(dense_rank() over (order by activity) - 1 as double) as label
        from (select distinct activity from features where split = 'train') seen
    """,
}
_METRIC_VIEWS = {"predictions": _PREDICTIONS, "labels": _LABELS, **_evaluation("predictions")}
_TEST_ROWS = "from features join label_index using (activity) where split = 'test'"
_SPLIT_WINDOWS = ", ".join(
    f"(select count(*) from features where split = '{split}') as {split}_windows"
    for split in ("train", "validation", "test")
)


def _sql(views: dict[str, str], select: str) -> str:
    listed = ",\n".join(f"{name} as ({body})" for name, body in views.items())
    return f"with {listed}\n{select}"


_SPLIT_FEATURES = f"select {_FUSED_KEYS}, {_FUSED_ROUNDED}, subject_rank, split from features"

_SUMMARY = """
    select 'feature_windows' as metric, 'all' as key, count(*) as value from features
    union all select 'subjects', 'all', count(distinct subject_id) from features
    union all select 'activities', 'all', count(distinct activity) from features
    union all select 'split_windows', split, count(*) from features group by split
    union all select 'split_subjects', split, count(distinct subject_id)
              from features group by split
"""

_ACTIVITY_NAMES_USED = """
    case activity when 'A' then 'Walking' when 'B' then 'Jogging' when 'C' then 'Stairs'
                  when 'D' then 'Sitting' when 'E' then 'Standing' when 'F' then 'Typing'
                  else activity end
"""


def _scaled() -> str:
    statistics = ", ".join(
        f"avg({name}) as {name}_centre, stddev_samp({name}) as {name}_spread"
        for name in _FUSED_NAMES
    )
    scaled = ", ".join(
        f"case when {name}_spread = 0 then 0.0 else ({name} - {name}_centre) / {name}_spread end"
        f" as {name}"
        for name in _FUSED_NAMES
    )
    shown = ", ".join(f"{_round(name)} as {name}" for name in _FUSED_NAMES)
    views = {
        **_SAMPLE_VIEWS,
        "fitted": f"select {statistics} from features where split = 'train'",
        "scaled": f"select {_FUSED_KEYS}, {scaled} from features cross join fitted",
    }
    return _sql(views, f"select {_FUSED_KEYS}, {shown} from scaled")


def _run() -> str:
    selects = [
        """select 'features' as artifact, 'windows' as metric, split || '/' || activity as key,
                  count(*) as value from features group by split, activity""",
        "select 'data_summary', 'lines', 'all', count(*) from parsed",
        "select 'data_summary', 'windows', 'all', count(*) from features",
    ]
    of_class = """select activity, (select count(*) from features f where f.split = 'test'
                  and f.activity = label_index.activity) as n from label_index"""
    for model in ("logistic_regression", "random_forest"):
        selects.append(f"select '{model}/confusion', 'actual', activity, n from ({of_class}) c")
        for artifact in (f"{model}/metrics", f"{model}/comparison"):
            selects.append(f"select '{artifact}', 'support', activity, n from ({of_class}) c")
            selects.append(
                f"select '{artifact}', 'windows', split, count(*) from features group by split"
            )
    views = {**_PREPARED_VIEWS, "label_index": _LABEL_VIEWS["label_index"]}
    return _sql(views, " union all ".join(selects))


def _experiments() -> str:
    views = {"base_pairs": _PREDICTIONS, "labels": _LABELS}
    selects = []
    for c, (condition, kept) in enumerate((("all", "true"), ("no C", "actual <> 'C'"))):
        for m, (model, predicted) in enumerate((("guess", "predicted"), ("constant", "'A'"))):
            tag = f"_{c}_{m}"
            views[f"pairs{tag}"] = (
                f"select actual, {predicted} as predicted from base_pairs where {kept}"
            )
            chain = _evaluation(f"pairs{tag}")
            for name, body in chain.items():
                for other in chain:
                    body = body.replace(f"from {other}", f"from {other}{tag}")
                    body = body.replace(f"join {other} on", f"join {other}{tag} {other} on")
                views[f"{name}{tag}"] = body
            selects.append(
                f"select '{condition}' as condition, '{model}' as model,"
                f" {_round('accuracy')} as accuracy, {_round('macro_f1')} as macro_f1,"
                f" test_predictions as test_windows from overall{tag}"
            )
    return _sql(views, " union all ".join(selects))


ORACLE: dict[str, str] = {
    "parse_records": _sql(_PARSE_VIEWS, "select * from parsed"),
    "parse_text_files": _sql(_PARSE_VIEWS, "select * exclude (source_file) from parsed"),
    "parse_quality": _sql(
        _PARSE_VIEWS, "select _parse_ok, count(*) as count from parsed group by _parse_ok"
    ),
    "valid_records": _sql(_PARSE_VIEWS, "select * from valid"),
    "window_features": _sql(
        _SAMPLE_VIEWS,
        "select subject_id, activity, device, sensor, window_id, sample_count, "
        + ", ".join(map(_round_feature, FEATURE_NAMES))
        + " from windows",
    ),
    "fused_features": _sql(_SAMPLE_VIEWS, f"select {_FUSED_KEYS}, {_FUSED_ROUNDED} from fused"),
    "subject_splits": _sql(_SAMPLE_VIEWS, "select * from splits"),
    "split_features": _sql(_SAMPLE_VIEWS, _SPLIT_FEATURES),
    "split_counts": _sql(
        _SAMPLE_VIEWS, "select split, count(*) as windows from features group by split"
    ),
    "dataset_summary": _sql(_SAMPLE_VIEWS, _SUMMARY),
    "prepare_job_summary": _sql(
        _PREPARED_VIEWS,
        f"{_SUMMARY} union all select 'parse_counts', cast(_parse_ok as varchar), count(*)"
        " from parsed group by _parse_ok"
        " union all select 'lines', 'all', count(*) from parsed",
    ),
    "prepared_features": _sql(_PREPARED_VIEWS, _SPLIT_FEATURES),
    "prepare_job_single_sensor": _sql(
        _SINGLE_SENSOR_VIEWS,
        f"select {_FUSED_KEYS}, sensor, sample_count, subject_rank, split, "
        + ", ".join(map(_round_feature, FEATURE_NAMES))
        + " from features",
    ),
    "confusion": _sql(_METRIC_VIEWS, "select actual, predicted, n as count from cells"),
    "confusion_dense": _sql(_METRIC_VIEWS, "select actual, predicted, n as count from dense"),
    "confusion_normalized": _sql(
        _METRIC_VIEWS,
        f"""
        select actual, predicted,
               {_round("case when total = 0 then 0.0 else n / cast(total as double) end")}
                   as fraction
        from (select *, sum(n) over (partition by actual) as total from dense) totalled
        """,
    ),
    "per_class_metrics": _sql(
        _METRIC_VIEWS,
        f"select activity, {_round('precision')} as precision, {_round('recall')} as recall,"
        f" {_round('f1')} as f1, support from per_class",
    ),
    "macro_metrics": _sql(
        _METRIC_VIEWS,
        f"select {_round('macro_precision')} as macro_precision,"
        f" {_round('macro_recall')} as macro_recall, {_round('macro_f1')} as macro_f1 from overall",
    ),
    "overall_metrics": _sql(
        _METRIC_VIEWS,
        f"select {_round('accuracy')} as accuracy, {_round('weighted_f1')} as weighted_f1,"
        " test_predictions from overall",
    ),
    "class_f1_ranking": _sql(
        _METRIC_VIEWS,
        f"""
        select cast(row_number() over (order by f1, activity) as integer) as rank, activity,
               {_ACTIVITY_NAMES_USED} as activity_name, {_round("f1")} as f1
        from per_class
        """,
    ),
    "metrics_json_roundtrip": _sql(
        {**_SAMPLE_VIEWS, **_METRIC_VIEWS},
        f"""
        select 'fixture' as model, {_round("accuracy")} as accuracy,
               {_round("weighted_f1")} as weighted_f1,
               {_round("macro_precision")} as macro_precision,
               {_round("macro_recall")} as macro_recall, {_round("macro_f1")} as macro_f1,
               test_predictions, '{",".join(LABELS)}' as labels,
               '{",".join(_FUSED_NAMES)}' as feature_columns, {_SPLIT_WINDOWS},
               activity, {_round("precision")} as precision, {_round("recall")} as recall,
               {_round("f1")} as f1, support
        from overall cross join per_class
        """,
    ),
    "lr_predictions": _sql(
        _LABEL_VIEWS,
        f"""
        select {_FUSED_KEYS}, label, true as same_prediction, true as same_chances,
               true as at_optimum
        {_TEST_ROWS}
        """,
    ),
    # A leaf's shares add up to one, so the votes of a row to the number of trees.
    "rf_predictions": _sql(
        _LABEL_VIEWS,
        f"""
        select {_FUSED_KEYS}, label, true as same_prediction, true as same_votes,
               {SETTINGS.models.num_trees} as trees,
               cast({SETTINGS.models.num_trees} as double) as votes
        {_TEST_ROWS}
        """,
    ),
    "model_comparison": _sql(
        _LABEL_VIEWS,
        """
        select model, activity,
               (select count(*) from features f
                 where f.split = 'test' and f.activity = label_index.activity) as support,
               (select count(*) from features where split = 'test') as test_predictions,
               (select count(*) from features where split = 'train') as train_windows,
               true as same_accuracy, true as same_weighted_f1, true as same_precision,
               true as same_recall, true as same_f1, true as same_macro_f1
        from label_index
        cross join (select unnest(['logistic_regression', 'random_forest']) as model) models
        """,
    ),
    "run_job": _run(),
    "experiment_summary": _experiments(),
    "label_index": _sql(_LABEL_VIEWS, "select * from label_index"),
    "model_roundtrip": _sql(
        _LABEL_VIEWS,
        """
        select subject_id, device, window_id, activity, label,
               true as same_label, true as same_prediction
        from features join label_index using (activity)
        where split = 'test'
        """,
    ),
    "scaled_features": _scaled(),
}
ORACLE["fused_features_join"] = ORACLE["fused_features"]
ORACLE["feature_roundtrip"] = ORACLE["split_features"]
ORACLE["prepare_job"] = ORACLE["prepared_features"]
ORACLE["prepared_quality"] = ORACLE["parse_quality"]
ORACLE["confusion_json_roundtrip"] = ORACLE["confusion_dense"]
