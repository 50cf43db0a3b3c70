"""Readers of observations, labels and traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OBSERVATION = "obs_id string, source string, raw_payload string, mac string, hostname string, open_ports string, ip_address string, site string"
LABEL = ", ".join(f"{c} string" for c in ("obs_id", "key_type", "key", "value", "status", "label_basis", "labeler_certainty", "blinded", "obs_hash", "labeled_by", "labeled_at"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A quoted CSV file with a header; blanks are empty strings."""
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True, emptyValue="").na.fill("")


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, OBSERVATION)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, LABEL)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of one JSON file with their number (``line``, from 1); a line that does not parse is kept in ``_corrupt_record``."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("at", "value")).filter(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return lines.select((F.col("at") + 1).alias("line"), parsed.alias("j")).select("line", "j.*")


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """step_id, op, parents and body of a trace file; many files, too. Lines that are no steps are left out (``read_jsonl`` shows them)."""
    body = F.col("value")
    parsed = F.from_json(body, "step_id string, op string, parents array<string>")
    return spark.read.text(path).select(parsed.alias("j"), body.alias("body")).filter("j.step_id is not null").select("j.*", "body")


def steps_of(trace: DataFrame, *ops: str) -> DataFrame:
    return trace.filter(F.col("op").isin(list(ops)))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document as one row."""
    return spark.read.json(path, multiLine=True)


def fields_of(columns: list[str]) -> list[str]:
    """A column is a field if there is one for its confidence."""
    return [c for c in columns if f"{c}_confidence" in columns]


def load_registry(path: str) -> dict[str, dict]:
    """The metrics that a run may give, with what is said of each."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def registered(metrics: DataFrame, registry: dict[str, dict], labels: bool) -> DataFrame:
    """Metrics of the registry; of a run without labels only those that need none."""
    names = [n for n, m in registry.items() if labels or not m.get("requires_labels")]
    return metrics.filter(F.col("metric").isin(names))
