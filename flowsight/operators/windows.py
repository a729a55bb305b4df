"""Features of event windows and of sessions, the same for batch tables and streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsight.operators.clean import one_per_key

WINDOW_SECONDS = 10
WATERMARK_SECONDS = 30
WEB_PORT = 8080
WEB_SERVICE = "http"

# Feature names, in the order of the feature vectors.
WINDOW_FEATURES = (
    "flow_count elapsed_seconds flow_rate mean_sbytes mean_dbytes mean_duration http_ratio port_scan_ratio".split()
)
SESSION_FEATURES = (
    "flow_count destination_port_count elapsed_seconds flow_rate mean_sbytes mean_dbytes mean_duration http_ratio".split()
)


def event_time(df: DataFrame, column: str = "timestamp") -> Column:
    """Time of an event: text that is no time gives NULL; zoneless times are taken as UTC sessions do."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column) if isinstance(kind, T.TimestampType) else F.col(column).cast("timestamp")


def recorded_flows(df: DataFrame, *modes: str) -> DataFrame:
    """Flow records of the given modes."""
    return df.where((F.col("record_type") == "flow") & F.col("lab_mode").isin(*modes))


def of_experiment(df: DataFrame, experiment: str) -> DataFrame:
    return df.where(F.col("experiment_id") == experiment)


def timed_events(flows: DataFrame, *, watermark_seconds: int | None = WATERMARK_SECONDS) -> DataFrame:
    """Events with a time, a source and an experiment.

    A stream gets its watermark here, unless ``watermark_seconds`` is None because it has one.
    """
    usable = F.col("event_time").isNotNull() & F.col("source_ip").isNotNull() & F.col("experiment_id").isNotNull()
    events = flows.withColumn("event_time", event_time(flows)).where(usable)
    if flows.isStreaming and watermark_seconds is not None:
        return events.withWatermark("event_time", f"{watermark_seconds} seconds")
    return events


# An aggregate in two steps: its name, the step over events, and how partial results merge.
Measure = tuple[str, Column, Callable[[Column], Column]]


def flow_measures() -> list[Measure]:
    def total(column: str) -> Measure:
        return f"{column}_total", F.sum(F.col(column).cast("double")), F.sum

    def known(column: str) -> Measure:
        return f"{column}_known", F.count(column), F.sum

    return [
        ("flows", F.count(F.lit(1)), F.sum),
        *[step(column) for column in ("sbytes", "dbytes", "dur") for step in (total, known)],
        ("web_flows", F.count_if(F.col("service") == WEB_SERVICE), F.sum),
        ("decoy_flows", F.count_if(F.col("destination_port") != WEB_PORT), F.sum),
    ]


def measured_features(elapsed: Column, rate_over: Column | None = None) -> dict[str, Column]:
    """The features of a window or session by name, from the sums of ``flow_measures`` and its seconds."""

    def mean(column: str) -> Column:
        return F.try_divide(F.col(f"{column}_total"), F.col(f"{column}_known"))

    return {
        "flow_count": F.col("flows").cast("double"),
        "elapsed_seconds": elapsed,
        "flow_rate": F.col("flows") / (elapsed if rate_over is None else rate_over),
        "mean_sbytes": mean("sbytes"),
        "mean_dbytes": mean("dbytes"),
        "mean_duration": mean("dur"),
        "http_ratio": F.col("web_flows") / F.col("flows"),
        "port_scan_ratio": F.col("decoy_flows") / F.col("flows"),
    }


def window_features(
    flows: DataFrame,
    *,
    seconds: int = WINDOW_SECONDS,
    watermark_seconds: int | None = WATERMARK_SECONDS,
    extra: Sequence[Measure] = (),
) -> DataFrame:
    """One row per experiment, source and tumbling window.

    The actor is the lowest actor id of the window. ``extra`` adds measures to the same pass.
    A lowest text cannot be kept by a hash aggregate, and sorting all events for it is dear, so a
    batch first sums up per actor; a stream, which allows one aggregate, goes there directly.
    """
    events = timed_events(flows, watermark_seconds=watermark_seconds)
    measures = [*flow_measures(), *extra]
    keys = ["experiment_id", "source_ip", F.window("event_time", f"{seconds} seconds").alias("span")]
    steps = [step.alias(name) for name, step, _ in measures]
    actor = F.min("actor_id").alias("actor_id")
    if flows.isStreaming:
        summed = events.groupBy(*keys).agg(actor, *steps)
    else:
        merged = [merge(F.col(name)).alias(name) for name, _, merge in measures]
        per_actor = events.groupBy(*keys, "actor_id").agg(*steps)
        summed = per_actor.groupBy("experiment_id", "source_ip", "span").agg(actor, *merged)

    features = measured_features(F.lit(float(seconds)))
    return summed.select(
        "experiment_id", "source_ip", "actor_id",
        F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
        *[features[name].alias(name) for name in WINDOW_FEATURES],
        *[name for name, _, _ in extra],
    )


def session_features(flows: DataFrame) -> DataFrame:
    """One row per run of recorded flows: the features of windows, over the time from its first to its last flow."""
    seen = F.col("event_time").cast("double")
    measures = [step.alias(name) for name, step, _ in flow_measures()]
    runs = flows.withColumn("event_time", event_time(flows)).where(
        F.col("run_id").isNotNull() & (F.col("record_type") == "flow")
    ).groupBy("run_id").agg(
        *measures,
        (F.max(seen) - F.min(seen)).alias("lasted"),
        F.count_distinct("destination_port").cast("double").alias("destination_port_count"),
    )
    # a run of one moment is given a short time, and no rate is taken over less than a second
    elapsed = F.greatest("lasted", F.lit(0.001))
    features = measured_features(elapsed, F.greatest(elapsed, F.lit(1.0)))
    features["destination_port_count"] = F.col("destination_port_count")
    return runs.select("run_id", *[features[name].alias(name) for name in SESSION_FEATURES])


def complete_sessions(flows: DataFrame, truth: DataFrame) -> DataFrame:
    """Labelled sessions whose recorded flows are as many as the run truth expects."""
    modes = ("training", "calibration")
    known = truth.where(F.col("lab_mode").isin(*modes)).select(
        "run_id", F.col("label").cast("int").alias("label"), "expected_flows", "lab_mode"
    )
    sessions = session_features(recorded_flows(flows, *modes)).join(known, "run_id")
    return sessions.where(F.col("flow_count") == F.col("expected_flows")).drop("expected_flows")


def truth_per_event(truth: DataFrame) -> DataFrame:
    """Event truth with one row per event, so a much repeated event stays one row in a join."""
    return truth.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("truth_rows"), F.min("label").alias("low_label"), F.max("label").alias("high_label")
    )


def windows_with_labels(flows: DataFrame, truth: DataFrame, *, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Window features of the distinct events, with what the event truth says about each window.

    Adds ``labelled_count``, ``low_label`` and ``high_label``; features and labels come from the
    same pass. Of events with one id the least row by its other columns counts (``clean.one_per_key``).
    """
    unique = one_per_key(flows, "event_id")
    marked = unique.join(truth_per_event(truth), "event_id", "left")
    labels: list[Measure] = [
        ("labelled_count", F.coalesce(F.sum("truth_rows"), F.lit(0)), F.sum),
        ("low_label", F.min("low_label"), F.min),
        ("high_label", F.max("high_label"), F.max),
    ]
    return window_features(marked, seconds=seconds, extra=labels)


def labelled_windows(flows: DataFrame, truth: DataFrame, *, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Windows that had ended by the last event, whose events are all labelled, with one label."""
    latest = flows.select(event_time(flows).alias("event_time")).agg(F.max("event_time")).scalar()
    windows = windows_with_labels(flows, truth, seconds=seconds)
    whole = (
        (F.col("window_end") <= latest)
        & (F.col("flow_count") == F.col("labelled_count"))
        & (F.col("low_label") == F.col("high_label"))
    )
    kept = [name for name in windows.columns if name not in ("labelled_count", "low_label", "high_label")]
    return windows.where(whole).select(*kept, F.col("high_label").alias("label"))


def rule_score(windows: DataFrame, *, scan_ratio: float = 0.5, rate: float = 10.0) -> DataFrame:
    """Baseline without a model: mostly decoy ports, or very many flows per second."""
    suspicious = (F.col("port_scan_ratio") >= scan_ratio) | (F.col("flow_rate") >= rate)
    return windows.withColumn("rule_score", F.when(suspicious, 1.0).otherwise(0.0))
